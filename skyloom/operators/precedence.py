"""One value a parameter out of several catalogs: by precedence, then the smaller error, then the newer date; and whether the others agree with it.

Each source speaks by its own best candidate. That is one minimum a source, so all sources, the winner and the agreement of the rest come from a single
aggregate that is combined before the exchange, whatever the number of measurements of an object.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LONG = ("object_id", "source", "parameter", "value", "error", "date", "tie")


@dataclass(frozen=True)
class Measured:
    """Where a source keeps a parameter: columns, or SQL expressions of them, of the value, its error and its date."""

    parameter: str
    value: str
    error: str = "cast(null as double)"
    date: str = "cast(null as timestamp)"


def candidates(df: DataFrame, source: Column | str, object_id: str, measured: Iterable[Measured], tie: str = "_row_idx") -> DataFrame:
    """One row a value that is there: ``LONG``. ``source``: a name or a column that tells it; ``tie`` (an expression) orders what else is equal."""
    structs = [F.struct(F.lit(m.parameter).alias("parameter"), F.expr(m.value).cast("double").alias("value"), F.abs(F.expr(m.error).cast("double")).alias("error"), F.expr(m.date).cast("timestamp").alias("date")) for m in measured]
    told = source if isinstance(source, Column) else F.lit(source)
    rows = df.select(F.expr(object_id).alias("object_id"), told.alias("source"), F.expr(tie).cast("long").alias("tie"), F.explode(F.array(*structs)).alias("m"))
    return rows.filter("m.value is not null and not isnan(m.value)").select("object_id", "source", "m.*", "tie").select(*LONG)


def together(df: DataFrame, object_id: str) -> DataFrame:
    """A source's rows brought together by object, before :func:`candidates` makes several of each. Otherwise the partial aggregate of :func:`resolve` sorts, spills and exchanges
    nearly all candidates, wide as its buffers are, where an object's rows lie scattered over the input. It's dealt by a hash, not the object itself, so that the aggregate keeps its own
    exchange, of a row an object and parameter; adaptive execution can thus split the partition of an object with very many rows."""
    return df.withColumn("_at", F.xxhash64(F.expr(object_id))).hint("rebalance", "_at").drop("_at")


def union(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def _place(order: list[str], first_for: dict[str, list[str]]) -> Column:
    """A source's place for a parameter; unknown ones come last."""

    def of(names: list[str]) -> Column:
        at = F.array_position(F.array(*map(F.lit, names)), F.col("source"))
        return F.when(at > 0, at).otherwise(len(names) + 1)

    out = of(order)
    for parameter, names in first_for.items():
        out = F.when(F.col("parameter") == parameter, of([*names, *(n for n in order if n not in names)])).otherwise(out)
    return out.cast("int")


def resolve(rows: DataFrame, order: Iterable[str], first_for: dict[str, list[str]] | None = None, sigmas: float = 3.0, share: float = 0.05) -> DataFrame:
    """(object_id, parameter, value, error, date, source, n_sources, disagreeing, conflict) of rows as from :func:`candidates`.

    ``order``: sources by precedence; ``first_for``: those that come first for a parameter. Another source disagrees if its best value is
    more than ``sigmas`` joint errors off, or, where an error is unknown, more than ``share`` of the value kept. Sources that ``order`` doesn't name
    come last, and of them only the best candidate is compared. A null object has no values.
    """
    order = list(order)
    error, newest = F.coalesce("error", F.lit(float("inf"))), F.coalesce(-F.unix_micros("date"), F.lit(2**63 - 1))
    best = F.struct(_place(order, first_for or {}).alias("place"), error.alias("by_error"), newest.alias("by_date"), "tie", "value", "error", "date", "source")
    slots = [F.min(F.when(F.col("source") == s, best)).alias(f"s{k}") for k, s in enumerate(order)] + [F.min(F.when(~F.coalesce(F.col("source").isin(order), F.lit(False)), best)).alias("other")]
    kept = rows.filter("object_id is not null and parameter is not null and value is not null and not isnan(value)").groupBy("object_id", "parameter").agg(*slots)
    told = F.array_compact(F.array(*(F.col(f"s{k}") for k in range(len(order))), F.col("other")))
    kept = kept.select("object_id", "parameter", F.array_sort(told).alias("told")).withColumn("won", F.col("told")[0])
    won = F.col("won")

    def off(x: Column) -> Column:
        joint = sigmas * F.sqrt(x["error"] * x["error"] + won["error"] * won["error"])
        return F.abs(x["value"] - won["value"]) > F.coalesce(joint, share * F.abs(won["value"]))

    others = F.filter(F.slice("told", 2, len(order) + 1), off)
    out = kept.select("object_id", "parameter", "won.value", "won.error", "won.date", "won.source", F.size("told").cast("long").alias("n_sources"), F.transform(others, lambda x: x["source"]).alias("disagreeing"))
    return out.withColumn("conflict", F.size("disagreeing") > 0)
