"""How a column's values shift between releases, told from quantile sketches that are kept as rows.

A sketch of a column is a few kilobytes whatever the number of rows, is built in one pass with the others, and sketches of parts merge into one of the
whole. Two releases are compared from their sketches alone: neither table is read again.

The sketches' rank error is at most about 1.9 / k ** 0.9 (0.4 % for the k here), and a comparison looks at
200 quantiles of each; so a distance is within twice the sum of the two, 0.02, of the exact one.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of a sketch; places at which two are compared.
K, STEPS = 1024, 200


def sketches(df: DataFrame, columns: Iterable[str], release: Column | str, by: Iterable[str] = (), k: int = K) -> DataFrame:
    """(release, by..., column, n, n_null, least, most, sketch): a row a column and group. NaN counts as null; a column without values has a null sketch."""
    by, release = list(by), release if isinstance(release, Column) else F.lit(release)
    columns = list(columns)
    known = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns}
    parts = [x for i, c in enumerate(columns) for x in (F.count(known[c]).alias(f"n{i}"), F.min(known[c]).alias(f"a{i}"), F.max(known[c]).alias(f"b{i}"), F.kll_sketch_agg_double(known[c], k).alias(f"s{i}"))]
    one = df.groupBy(release.alias("release"), *by).agg(F.count("*").alias("rows"), *parts)
    rows = F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("n"), (F.col("rows") - F.col(f"n{i}")).alias("n_null"), F.col(f"a{i}").alias("least"), F.col(f"b{i}").alias("most"), F.when(F.col(f"n{i}") > 0, F.col(f"s{i}")).alias("sketch")) for i, c in enumerate(columns)))
    return one.select("release", *by, F.explode(rows).alias("c")).select("release", *by, "c.*")


def merged(parts: DataFrame, by: Iterable[str] = ("release", "column"), k: int = K) -> DataFrame:
    """Sketches of parts as one of the whole, a row for each ``by``."""
    return parts.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("n_null").alias("n_null"), F.min("least").alias("least"), F.max("most").alias("most"), F.kll_merge_agg_double("sketch", k).alias("sketch"))


def compare(old: DataFrame, new: DataFrame, by: Iterable[str] = ("column",), steps: int = STEPS) -> DataFrame:
    """(by..., n_old, n_new, null_shift, largest_gap, mean_shift, stability): of each column in both.

    ``largest_gap``: the largest difference of the distribution functions (Kolmogorov-Smirnov); ``mean_shift``: the mean distance of equal quantiles
    (Wasserstein), in the column's unit; ``stability``: the population stability index over the old tenths; ``null_shift``: the change of the share of nulls.
    """
    by = list(by)
    a = old.select(*by, F.col("n").alias("n_old"), F.col("n_null").alias("_null_old"), F.col("sketch").alias("_old"))
    b = new.select(*by, F.col("n").alias("n_new"), F.col("n_null").alias("_null_new"), F.col("sketch").alias("_new"))
    both = a.join(b, by)
    known = both.filter("_old is not null and _new is not null")
    grid = F.array(*(F.lit(k / steps) for k in range(steps + 1)))
    told = known.withColumns({"qo": F.kll_sketch_get_quantile_double("_old", grid), "qn": F.kll_sketch_get_quantile_double("_new", grid)})

    def rank(grid: str, x: Column) -> Column:
        """Share of a grid's quantiles that aren't above ``x``."""
        return F.size(F.filter(grid, lambda v: v <= x)) / F.lit(float(steps + 1))

    gap = F.array_max(F.transform(F.array_distinct(F.concat("qo", "qn")), lambda x: F.abs(rank("qo", x) - rank("qn", x))))
    shift = F.aggregate(F.zip_with("qo", "qn", lambda x, y: F.abs(x - y)), F.lit(0.0), lambda s, x: s + x) / (steps + 1)
    # the old tenths as bins; where values repeat, fewer
    cuts = F.array_distinct(F.array(*(F.get("qo", F.lit(k * steps // 10)) for k in range(1, 10))))
    ends = lambda q: F.concat(F.array(F.lit(0.0)), F.transform("cuts", lambda x: rank(q, x)), F.array(F.lit(1.0)))
    told = told.withColumn("cuts", cuts).withColumns({"po": ends("qo"), "pn": ends("qn")})

    def part(c: str, i: Column) -> Column:
        # an empty tenth counts as a thousandth of a per cent, so that its logarithm exists
        return F.greatest(F.get(c, i) - F.get(c, i - 1), F.lit(1e-5))

    stability = F.aggregate(F.transform(F.sequence(F.lit(1), F.size("po") - 1), lambda i: (part("pn", i) - part("po", i)) * F.log(part("pn", i) / part("po", i))), F.lit(0.0), lambda s, x: s + x)
    nulls = F.try_divide(F.col("_null_new").cast("double"), F.col("_null_new") + F.col("n_new")) - F.try_divide(F.col("_null_old").cast("double"), F.col("_null_old") + F.col("n_old"))
    return told.select(*by, "n_old", "n_new", nulls.alias("null_shift"), gap.alias("largest_gap"), shift.alias("mean_shift"), stability.alias("stability"))
