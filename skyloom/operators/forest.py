"""Outliers by an isolation forest: trees that split at random over small samples; a row that few splits isolate is an outlier.

The forest is fitted on a bounded sample (``trees`` times ``sample`` rows, drawn by a hash of the row's key), every row is scored: a batch of rows goes through all trees
together, as matrices. Missing values take the sample's median.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TREES, SAMPLE = 100, 256


def expected_depth(n: np.ndarray | float) -> np.ndarray:
    """Mean depth at which a search in a random tree over ``n`` rows fails."""
    n = np.asarray(n, dtype=float)
    with np.errstate(divide="ignore", invalid="ignore"):
        h = np.log(n - 1) + np.euler_gamma
        return np.where(n > 2, 2 * h - 2 * (n - 1) / n, np.where(n == 2, 1.0, 0.0))


@dataclass(frozen=True)
class Forest:
    """Nodes of all trees side by side: feature (-1 at a leaf), cut, left child (the right one follows it), and at leaves the depth a row gets."""

    features: tuple[str, ...]
    medians: np.ndarray
    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    depth: np.ndarray
    levels: int
    norm: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Between 0 and 1 for each row of ``x`` (NaN: missing); above a half the more isolated."""
        x = np.where(np.isnan(x), self.medians, x)
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.levels):
            f = self.feature[at]
            inner = f >= 0
            # a leaf stays where it is
            at = np.where(inner, self.left[at] + (x[rows, np.maximum(f, 0)] >= self.cut[at]), at)
        return 2.0 ** (-self.depth[at].mean(axis=1) / self.norm)


def grow(x: np.ndarray, features: Iterable[str], trees: int = TREES, sample: int = SAMPLE, seed: int = 7) -> Forest:
    """A forest over the rows of ``x``; each tree takes ``sample`` of them."""
    draw, medians = np.random.default_rng(seed), np.zeros(x.shape[1])
    for c in range(x.shape[1]):
        some = x[~np.isnan(x[:, c]), c]
        medians[c] = np.median(some) if len(some) else 0.0
    x = np.where(np.isnan(x), medians, x)
    size = min(sample, len(x))
    deepest = max(1, int(np.ceil(np.log2(max(size, 2)))))
    feature, cut, left, depth, roots = [], [], [], [], []

    def node() -> int:
        for some, v in ((feature, -1), (cut, 0.0), (left, 0), (depth, 0.0)):
            some.append(v)
        return len(feature) - 1

    for _ in range(trees):
        roots.append(node())
        waiting = [(roots[-1], draw.choice(len(x), size=size, replace=False), 0)]
        while waiting:
            k, rows, d = waiting.pop()
            low, high = x[rows].min(axis=0), x[rows].max(axis=0)
            open_ = np.flatnonzero(high > low)
            if d == deepest or len(rows) < 2 or not len(open_):
                depth[k] = d + float(expected_depth(len(rows)))
                continue
            c = int(draw.choice(open_))
            at = float(draw.uniform(low[c], high[c]))
            side = x[rows, c] >= (at := at if at > low[c] else high[c])
            feature[k], cut[k], left[k] = c, at, node()
            waiting += [(left[k], rows[~side], d + 1), (node(), rows[side], d + 1)]
    return Forest(tuple(features), medians, np.array(roots), np.array(feature), np.array(cut), np.array(left), np.array(depth), deepest, float(expected_depth(size)) or 1.0)


def fit(df: DataFrame, features: Iterable[str], key: str, trees: int = TREES, sample: int = SAMPLE, seed: int = 7) -> Forest | None:
    """Fitted on at most ``trees * sample`` rows, however large the table and often a key is repeated; None for an empty table."""
    features, most = list(features), trees * sample
    total = df.count()
    share = min(1.0, 1.2 * most / max(total, 1))
    drawn = df.filter(F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1_000_000)) < int(share * 1_000_000) + 1).limit(most)
    rows = drawn.select(key, *(F.col(c).cast("double") for c in features)).toPandas().sort_values([key, *features], kind="stable")
    return grow(rows[features].to_numpy(dtype=float), features, trees, sample, seed) if len(rows) else None


def scored(df: DataFrame, forest: Forest, into: str = "anomaly_score") -> DataFrame:
    """``df`` with every row's score; a row without any feature scores as the medians do."""
    sent = df.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("double")
    def score(rows: pd.DataFrame) -> pd.Series:
        return pd.Series(sent.value.score(rows.to_numpy(dtype=float)))

    return df.withColumn(into, score(F.struct(*(F.col(c).cast("double").alias(c) for c in forest.features))))


def flagged(df: DataFrame, forest: Forest, contamination: float = 0.05, into: str = "is_outlier") -> DataFrame:
    """Scores, and whether a row is of the most isolated share; the border is a quantile of all scores with a rank error of a ten-thousandth."""
    out = scored(df, forest)
    border = out.agg(F.percentile_approx("anomaly_score", 1 - contamination, 10_000)).first()[0]
    return out.withColumn(into, F.col("anomaly_score") > F.lit(border))
