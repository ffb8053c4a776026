"""Profiles, statistics and validation; each is one aggregation over the table, whatever the number of columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import filled, numeric_columns
from .normalize import PLANET_MEASURES
from .quality import KEY_PARAMETERS
from .quantiles import exact_quantiles


def profile_columns(df: DataFrame) -> DataFrame:
    """(column, n_rows, n_null, null_pct, n_distinct): one row a column; counts are exact.

    Distinct values of all columns in one aggregate would send every row once a column. Here a row is a list of (column, digest of the value), and equal
    ones are counted together before they're sent, so a column of few values sends few; rows, nulls and distinct values are then sums over these. A digest has 128 bits.
    """
    if not df.columns:
        return df.sparkSession.createDataFrame([], "column string, n_rows long, n_null long, null_pct double, n_distinct long")
    cells = F.array(*(F.struct(F.lit(k).alias("k"), F.when(F.col(f"`{c}`").isNotNull(), F.struct(F.xxhash64(F.lit(1), f"`{c}`"), F.xxhash64(F.lit(2), f"`{c}`"))).alias("v")) for k, c in enumerate(df.columns)))
    met = df.select(F.explode(cells).alias("x")).groupBy("x.k", "x.v").agg(F.count("*").alias("n"))
    one = met.groupBy("k").agg(F.sum("n").alias("n_rows"), F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("n_null"), F.count("v").alias("n_distinct"))
    # an empty table still has a row a column
    names = df.sparkSession.createDataFrame(list(enumerate(df.columns)), "k int, column string")
    out = F.broadcast(names).join(one, "k", "left").na.fill(0, ["n_rows", "n_null", "n_distinct"])
    return out.select("column", "n_rows", "n_null", F.coalesce(F.try_divide(F.col("n_null") * 100.0, F.col("n_rows")), F.lit(0.0)).alias("null_pct"), "n_distinct")


def value_counts(df: DataFrame, columns=None, most: int = 20) -> DataFrame:
    """(column, value, n) of text columns with up to ``most`` distinct values; the rule is a property of the report."""
    names = [c for c, t in df.dtypes if t == "string"] if columns is None else list(columns)
    if not names:
        return df.sparkSession.createDataFrame([], "column string, value string, n long")
    long = df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in names))).alias("x")).select("x.*")
    counts = long.groupBy("column", "value").agg(F.count("*").alias("n"))
    few = counts.groupBy("column").agg(F.count("value").alias("k")).filter(F.col("k") <= most).select("column")
    return counts.join(few, "column", "left_semi")


def describe(df: DataFrame, columns=None) -> DataFrame:
    """(column, n, mean, std, min, q25, q50, q75, max) of numeric columns; quartiles are exact."""
    names = numeric_columns(df) if columns is None else list(columns)
    quartiles, parts = exact_quantiles(df, names, [0.25, 0.5, 0.75]), []
    for c in names:
        x = F.col(c).cast("double")
        q = [F.lit(v).cast("double") for v in quartiles[c]]
        parts.append(F.struct(F.lit(c).alias("column"), F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"), q[0].alias("q25"), q[1].alias("q50"), q[2].alias("q75"), F.max(x).alias("max")))
    return df.agg(F.array(*parts).alias("p")).select(F.explode("p").alias("p")).select("p.*")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """(n_duplicates): rows beyond the first of each distinct row."""
    return df.groupBy(*df.columns).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates"))


def merge_statistics(merged: DataFrame, sources: dict[str, DataFrame], output_rows: int | None = None) -> dict:
    """Counts of the result (unless that's known) and of each source, and their ratio."""
    rows = {n: d.count() for n, d in sources.items()}
    out, total = merged.count() if output_rows is None else output_rows, sum(rows.values())
    return {"output_rows": out, "output_columns": len(merged.columns), "input_sources": rows, "total_input_rows": total, "merge_efficiency": out / total if total else 0}


def pipeline_statistics(df: DataFrame, parameters=KEY_PARAMETERS) -> DataFrame:
    """(name, value): rows, distinct entities, completeness, shares of missing parameters and of present derived features."""
    n = F.count("*")
    parts = [("total_records", n)]
    parts += [(name, F.count_distinct(c) if c in df.columns else n) for name, c in (("unique_stars", "star_id"), ("unique_planets", "planet_id"))]
    if "data_completeness_score" in df.columns:
        parts.append(("data_completeness_mean", F.avg("data_completeness_score")))
    parts += [(f"missing_{c}", F.avg(F.col(c).isNull().cast("double"))) for c in parameters if c in df.columns]
    parts += [(f"coverage_{c}", F.avg(F.col(c).isNotNull().cast("double"))) for c in PLANET_MEASURES if c in df.columns]
    one = df.agg(F.array(*(F.struct(F.lit(k).alias("name"), v.cast("double").alias("value")) for k, v in parts)).alias("p"))
    return one.select(F.explode("p").alias("p")).select("p.*")


def category_counts(df: DataFrame, column: str) -> DataFrame:
    """(value, n), null counted too."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def null_share(df: DataFrame) -> Column:
    """Aggregate: the share of null cells in per cent, 0 for a table without rows or columns."""
    nulls = reduce(lambda a, b: a + b, (F.col(f"`{c}`").isNull().cast("long") for c in df.columns), F.lit(0).cast("long"))
    return F.coalesce(F.try_divide(F.sum(nulls) * 100.0, F.count("*") * len(df.columns)), F.lit(0.0))


def validate(df: DataFrame, completeness: bool = True, data_types: bool = True, hz_columns: bool = True) -> DataFrame:
    """(check, passed, value): share of nulls below a half, counts of types, columns of the habitable zone."""
    pct, n_number, n_hz, rows = null_share(df), len(numeric_columns(df)), sum("hz" in c.lower() for c in df.columns), []
    if completeness:
        rows.append(F.struct(F.lit("completeness").alias("check"), (pct < 50).alias("passed"), pct.alias("value")))
    if data_types:
        rows.append(F.struct(F.lit("data_types").alias("check"), F.lit(True).alias("passed"), F.lit(float(n_number)).alias("value")))
    if hz_columns:
        rows.append(F.struct(F.lit("hz_columns").alias("check"), F.lit(n_hz > 0).alias("passed"), F.lit(float(n_hz)).alias("value")))
    return df.agg(F.array(*rows).alias("r")).select(F.explode("r").alias("r")).select("r.*")


def sample_rows(df: DataFrame, n: int = 3) -> DataFrame:
    """The first ``n`` rows as the scan gives them; the limit is the feature."""
    return df.limit(n)


def estimated_bytes(df: DataFrame) -> int:
    """What the optimizer takes the table's size to be; no job."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def report(tables: dict[str, DataFrame]) -> dict:
    """Across tables: rows each, columns that all share, columns that are mostly null, and advice on large tables."""
    rows, sparse, sizes = {}, {}, {}
    for name, df in tables.items():
        has = filled(df)
        rows[name], sizes[name] = (n := df.count()), estimated_bytes(df)
        shares = {c: (n - k) / n for c, k in has.items()} if n else {}
        sparse[name] = {"over_50": sorted(c for c, s in shares.items() if s > 0.5), "over_30": sorted(c for c, s in shares.items() if s > 0.3)}
    common = set.intersection(*(set(d.columns) for d in tables.values())) if tables else set()
    return {"rows": dict(sorted(rows.items(), key=lambda x: -x[1])), "total_rows": sum(rows.values()), "bytes": dict(sorted(sizes.items(), key=lambda x: -x[1])), "total_bytes": sum(sizes.values()), "common_columns": sorted(common), "sparse": sparse, "large": sorted(n for n, k in rows.items() if k > 100_000)}
