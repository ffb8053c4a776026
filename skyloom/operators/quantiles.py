"""Exact quantiles and modes without an aggregate whose state holds a whole column.

Spark's exact percentile and mode keep every distinct value in one task. Here a column of up to ``FEW`` values uses them as they are. In larger ones all ranks of all columns
are narrowed together: a round is one job of bounded sketches and one of counts, and cuts each rank's band of values by some hundred times, until each band holds ``SMALL``
values at most. Modes of all columns are one job, counted by value with partial counts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEW, SMALL = 200_000, 1 << 15
#: Bands whose values one job gathers.
AT_ONCE = 32


@dataclass
class _Rank:
    """The k-th smallest value of a column, from 0: it's among ``m`` values of a band that ``below`` values lie under."""

    column: str
    k: int
    m: int
    low: float | None = None
    high: float | None = None
    below: int = 0
    value: float | None = None

    def inside(self) -> Column:
        x = F.col(self.column).cast("double")
        return F.when(x.isNotNull() if self.low is None else x.between(self.low, self.high), x)

    def place(self) -> Column:
        return F.sort_array(F.collect_list(self.inside()))[self.k - self.below]

    def ends(self) -> Column:
        # a margin above the sketch's own error, so that the rank stays inside
        at, margin = (self.k - self.below) / self.m, 2e-3
        return F.percentile_approx(self.inside(), [max(0.0, at - margin), min(1.0, at + margin)], 2000)

    def counts(self, low: float, high: float) -> Column:
        x = F.col(self.column).cast("double")
        return F.struct(*(F.count(F.when(c, 1)).alias(n) for n, c in (("below", x < low), ("low", x == low), ("inside", x.between(low, high)), ("under_high", x < high), ("high", x == high))))

    def narrow(self, low: float, high: float, n) -> None:
        if not n.below <= self.k < n.below + n.inside:
            raise ArithmeticError(f"rank {self.k} of {self.column} fell out of its band")
        # one value that fills the band's ends can't be narrowed further by ranks
        if self.k < n.below + n.low:
            self.value = low
        elif n.under_high <= self.k < n.under_high + n.high:
            self.value = high
        self.low, self.high, self.below, self.m = low, high, n.below, n.inside


def _resolve(df: DataFrame, ranks: list[_Rank], small: int) -> None:
    """Finds the values of all ranks."""
    while open_ := [r for r in ranks if r.value is None]:
        wide = [r for r in open_ if r.m > small]
        if wide:
            ends = df.agg(*(r.ends() for r in wide)).first()
            counts = df.agg(*(r.counts(*e) for r, e in zip(wide, ends, strict=True))).first()
            for r, e, n in zip(wide, ends, counts, strict=True):
                r.narrow(*e, n)
        ready = [r for r in open_ if r not in wide][:AT_ONCE]
        if ready:
            for r, v in zip(ready, df.agg(*(r.place() for r in ready)).first(), strict=True):
                r.value = v


def exact_quantiles(df: DataFrame, columns: list[str], probabilities: list[float], small: int = SMALL, few: int = FEW) -> dict[str, list[float | None]]:
    """By column, the quantiles by linear interpolation between neighbours; None for a column without values."""
    if not columns:
        return {}
    n = dict(zip(columns, df.agg(*(F.count(F.col(c)).alias(str(k)) for k, c in enumerate(columns))).first(), strict=True))
    plain, out = [c for c in columns if n[c] <= few], {}
    if plain:
        row = df.agg(*(F.percentile(F.col(c).cast("double"), F.array(*map(F.lit, probabilities))) for c in plain)).first()
        out = {c: list(row[k]) if row[k] is not None else [None] * len(probabilities) for k, c in enumerate(plain)}
    places = {c: [p * (n[c] - 1) for p in probabilities] for c in columns if c not in out}
    ranks = {(c, k): _Rank(c, k, n[c]) for c, ats in places.items() for at in ats for k in (math.floor(at), math.ceil(at))}
    _resolve(df, list(ranks.values()), small)
    for c, ats in places.items():
        pairs = [(ranks[c, math.floor(at)].value, ranks[c, math.ceil(at)].value, at - math.floor(at)) for at in ats]
        out[c] = [a + (b - a) * part for a, b, part in pairs]
    return {c: out[c] for c in columns}


def modes(df: DataFrame, columns: list[str]) -> dict:
    """By column, the most frequent value, the lowest among equals; None without values. Grouping sets count the values of all columns in one job."""
    if not columns:
        return {}
    df = df.select(*(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(columns)))
    names = df.columns
    counts = df.groupingSets([[F.col(c)] for c in names], *map(F.col, names)).agg(F.count("*").alias("n"), *(F.grouping(c).alias(f"g_{c}") for c in names))
    best = counts.agg(*(F.min(F.when((F.col(f"g_{c}") == 0) & F.col(c).isNotNull(), F.struct((-F.col("n")).alias("n"), F.col(c).alias("v")))).alias(c) for c in names)).first()
    return {c: best[k]["v"] if best[k] is not None else None for k, c in enumerate(columns)}
