"""Run a registered query over a folder of tables."""

from ...release_queries import QUERIES


def arguments(parser) -> None:
    parser.add_argument("name")
    parser.add_argument("tables")
    parser.add_argument("--out")


def run(given, context) -> int:
    df = QUERIES[given.name](context.spark, given.tables)
    df.write.mode("overwrite").parquet(given.out) if given.out else df.show(20, False)
    return 0
