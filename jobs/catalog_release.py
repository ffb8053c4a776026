"""Builds one release of the merged catalog out of its source tables: matches, one value a parameter, checks, grades, and the drift since the release before.

    python -m jobs.catalog_release --config jobs/catalog_release.json --tables DIR --out DIR

Below ``out``, each table has a folder ``release=<name>``: ``catalog`` (a row a planet, partitioned by grade), ``parameters`` (by parameter), ``sketches``
and, if there's an earlier release, ``drift`` against the last one before. A run replaces its own release's folders and reads no other but the sketches before it,
so a run that failed or is repeated gives the same again. Other releases stay as they are.

Every planet is in the catalog once for each of the table's rows. A planet without a match, a value or a position has nulls there.
An empty source gives no matches; an empty primary table a release without rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from jobs.common import log, main, stored
from skyloom.fixtures import view
from skyloom.functions.text import norm_name
from skyloom.operators import drift, joins, precedence, rules, sky


def matched(spark: SparkSession, tables: str, config: dict) -> DataFrame:
    """Planets with their star by id, the first candidate of their name, and the nearest position with how sure that is."""
    prim = view(spark, tables, "prim")
    df = joins.by_id(prim, view(spark, tables, "gaia"), "gaia", one_each=True)
    cand = view(spark, tables, "cand").select("tid", "planet_name").withColumn("_src_idx", F.col("tid"))
    df = joins.by_any_name(df, cand, "cand", one_each=True)
    near = sky.ambiguity(prim, view(spark, tables, "sec"), left_id="row_idx", right_id="src_idx", **config["positions"])
    near = near.select("row_idx", F.col("src_idx").alias("near_src_idx"), "reliability", F.col("ambiguous").alias("near_ambiguous"))
    return df.join(near, "row_idx", "left").withColumns({"planet_id": norm_name("pl_name"), "star_id": F.coalesce("gaia_gaia_dr3_source_id", "gaia_gaia_dr2_source_id")})


def resolved(spark: SparkSession, tables: str, config: dict) -> DataFrame:
    """One value a planet and parameter, from all the tables that the settings name."""
    parts = []
    for s in config["parameters"]["sources"]:
        told = [precedence.Measured(**m) for m in s["measured"]]
        rows = precedence.together(spark.read.parquet(f"{tables}/{s['table']}.parquet"), s["object"])
        parts.append(precedence.candidates(rows, F.expr(s["source"]), s["object"], told, s["tie"]))
    p = config["parameters"]
    return precedence.resolve(precedence.union(parts), p["order"], p["first_for"], p["sigmas"], p["share"])


def graded(df: DataFrame, checks: list[rules.Rule]) -> DataFrame:
    """Rules broken, and a grade: A without a fault, B with one broken rule, C with more or with a doubtful match or value."""
    df = rules.check(df, checks)
    doubt = F.coalesce(F.col("near_ambiguous"), F.lit(False)) | F.coalesce(F.col("price.conflict"), F.lit(False))
    broken = F.size("violations")
    return df.withColumn("grade", F.when(doubt | (broken > 1), "C").when(broken == 1, "B").otherwise("A"))


def run(spark: SparkSession, tables: str, out: str, config: dict) -> DataFrame:
    """Builds the release ``config["release"]`` of the tables below ``tables`` and returns it as read back."""
    release, checks = config["release"], [*rules.CONSISTENCY, *rules.from_config(config["rules"])]
    at = lambda name: f"{out}/{name}/release={release}"
    values = resolved(spark, tables, config)
    seen = Observation("parameters")
    values.observe(seen, F.count("*").alias("rows"), F.sum(F.col("conflict").cast("long")).alias("conflicts")).write.mode("overwrite").partitionBy("parameter").parquet(at("parameters"))
    log.info("read %s, wrote %s: %s", [s["table"] for s in config["parameters"]["sources"]], at("parameters"), seen.get)
    kept = spark.read.schema(values.schema).parquet(at("parameters"))
    wide = kept.groupBy(F.col("object_id").alias("_object")).agg(*(F.max(F.when(F.col("parameter") == p, F.struct("value", "source", "conflict"))).alias(p) for p in config["parameters"]["columns"]))
    df = matched(spark, tables, config).join(wide, F.col("row_idx") == F.col("_object"), "left")
    df = graded(df, checks).select(
        "row_idx", "planet_id", "star_id", F.col("cand_tid"), "near_src_idx", "near_ambiguous", *(F.col(f"{p}.{c}").alias(f"{p}_{c}") for p in config["parameters"]["columns"] for c in ("value", "source", "conflict")),
        *config["columns"], F.concat_ws(",", "violations").alias("violations"), "grade",
    )
    seen = Observation("catalog")
    grades = (F.sum((F.col("grade") == g).cast("long")).alias(g) for g in "ABC")
    df.observe(seen, F.count("*").alias("rows"), F.count("star_id").alias("stars"), F.count("cand_tid").alias("candidates"), F.count("near_src_idx").alias("positions"), *grades).write.mode("overwrite").partitionBy("grade").parquet(at("catalog"))
    log.info("read part, customer, orders, supplier, wrote %s: %s", at("catalog"), seen.get)
    made = spark.read.schema(df.schema).parquet(at("catalog"))
    drift.sketches(made, config["columns"], release).drop("release").write.mode("overwrite").parquet(at("sketches"))
    compared(spark, out, release)
    return stored(spark, f"{out}/catalog").filter(F.col("release") == release)


def compared(spark: SparkSession, out: str, release: str) -> None:
    """Writes how the columns have shifted since the last release before this one."""
    known = stored(spark, f"{out}/sketches").withColumn("release", F.col("release").cast("string"))
    before = known.filter(F.col("release") < release).agg(F.max("release")).first()[0]
    if before is None:
        log.info("no release before %s", release)
        return
    shift = drift.compare(known.filter(F.col("release") == before), known.filter(F.col("release") == release)).withColumn("before", F.lit(before))
    shift.write.mode("overwrite").parquet(path := f"{out}/drift/release={release}")
    log.info("read sketches of %s, wrote %s", before, path)


if __name__ == "__main__":
    main("catalog_release", run, {"tables": "folder of the source tables", "out": "folder of all releases"})
