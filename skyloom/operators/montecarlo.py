"""Monte Carlo propagation of measurement errors, deterministic and the same for every row.

The generator starts anew at each row, and a missing parameter draws nothing. So the k-th parameter that is present always uses the k-th block
of one fixed vector of standard normals; it's drawn once a worker and rows are computed in Arrow batches, as matrices of rows by samples.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.astro import G, M_EARTH, R_EARTH
from .columns import dealt, require

PARAMETERS = ("st_teff", "st_lum", "st_rad", "pl_orbsmax", "pl_rade", "pl_masse")
METRICS = ("stellar_flux_s", "equilibrium_temperature", "surface_gravity", "escape_velocity")
#: Places of each metric's parameters.
_USED = ([1, 3], [0, 2, 3], [4, 5], [4, 5])
STATS = ("mean", "std", "median", "q16", "q84")
NAMES = [f"{m}_{s}" for m in METRICS for s in STATS]
#: Rows of a matrix: bounds a worker's memory at rows x samples doubles.
BLOCK = 64


@lru_cache(maxsize=4)
def normals(samples: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal(len(PARAMETERS) * samples).reshape(len(PARAMETERS), samples)


def sigma(err1, err2):
    """Both sides: their mean, unless the upper one is zero; one side: that one; none: zero."""
    upper, lower = F.coalesce(F.abs(err1), F.lit(0.0)), F.abs(err2)
    return F.when(upper == 0, F.coalesce(lower, F.lit(0.0))).otherwise(F.coalesce((upper + lower) / 2.0, upper))


def _summary(x: np.ndarray) -> np.ndarray:
    """Five statistics of each row without NaN; NaN for a row that has nothing else. One sort a row serves all quantiles."""
    y = np.sort(x, axis=1)  # NaN comes last
    n = x.shape[1] - np.isnan(x).sum(axis=1)
    out = np.full((len(x), 5), np.nan)
    some = np.flatnonzero(n)
    if not len(some):
        return out
    y, n = y[some], n[some]
    held = np.where(np.isnan(y), 0.0, y)
    mean = held.sum(axis=1) / n
    off = np.where(np.isnan(y), 0.0, y - mean[:, None])
    out[some, 0], out[some, 1] = mean, np.sqrt((off * off).sum(axis=1) / n)
    for k, q in enumerate((0.5, 0.16, 0.84)):
        at = q * (n - 1)
        low = np.floor(at).astype(np.int64)
        part = at - low
        a, b = (np.take_along_axis(y, i[:, None], 1)[:, 0] for i in (low, np.minimum(low + 1, n - 1)))
        out[some, 2 + k] = a + (b - a) * part
    return out


def propagate(mu: np.ndarray, sd: np.ndarray, albedo: np.ndarray, spread: np.ndarray, samples: int, seed: int) -> np.ndarray:
    """Rows x 20 statistics of rows x 6 means and sigmas (NaN: missing)."""
    z = normals(samples, seed)
    has = ~np.isnan(mu)
    block = np.cumsum(has, axis=1) - has  # parameters present before this one
    fixed = (sd == 0) | ~has
    out = np.empty((len(mu), len(NAMES)))
    for m, used in enumerate(_USED):
        # where none of a metric's parameters varies, all samples are one value, so a single one tells everything
        one = fixed[:, used].all(axis=1)
        for rows, width in ((np.flatnonzero(one), 1), (np.flatnonzero(~one), samples)):
            if not len(rows):
                continue
            x, s = mu[rows], sd[rows]
            draw = lambda k: x[:, k, None] if fixed[rows, k].all() else x[:, k, None] + s[:, k, None] * z[block[rows, k], :width]  # noqa: B023, E731
            with np.errstate(all="ignore"):
                out[rows, len(STATS) * m : len(STATS) * (m + 1)] = _summary(_metric(m, draw, albedo[rows], spread[rows]))
    return out


def _metric(m: int, draw, albedo: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Samples of a metric; ``draw`` gives those of a parameter by its place."""

    def positive(k: int) -> np.ndarray:
        x = draw(k)
        return np.where(x > 0, x, np.nan)

    if m == 0:
        lum = draw(1)
        return np.where(lum > 0, lum, 10**lum) / positive(3) ** 2
    if m == 1:
        return draw(0) * np.sqrt(draw(2) / (2.0 * positive(3))) * ((1.0 - albedo) ** 0.25 * spread**0.25)[:, None]
    rp, mp = positive(4), positive(5)
    if m == 2:
        return G * mp * M_EARTH / (rp * R_EARTH) ** 2
    return np.sqrt(2 * G * mp * M_EARTH / (rp * R_EARTH)) / 1000.0


def monte_carlo(df: DataFrame, samples: int = 1000, seed: int = 42, with_errors: bool = True) -> DataFrame:
    """Twenty columns ``<metric>_<statistic>``. ``with_errors=False`` sets all sigmas to zero. Rows are dealt evenly first, for a small file with very many rows is one task's."""
    require(df, *PARAMETERS)
    null = F.lit(None).cast("double")

    def error(p: str):
        one, two = (F.col(f"{p}err{k}") if f"{p}err{k}" in df.columns and with_errors else null for k in (1, 2))
        return sigma(one, two)

    given = [F.col(p).cast("double") for p in PARAMETERS] + [error(p).cast("double") for p in PARAMETERS]
    given += [F.coalesce(F.col(c), F.lit(v)).cast("double") if c in df.columns else F.lit(v) for c, v in (("albedo", 0.3), ("redistribution_factor", 1.0))]

    @F.pandas_udf(", ".join(f"{n} double" for n in NAMES))
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for columns in batches:
            a = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            parts = [propagate(x[:, :6], x[:, 6:12], x[:, 12], x[:, 13], samples, seed) for x in (a[k : k + BLOCK] for k in range(0, len(a), BLOCK))]
            made = np.concatenate(parts) if parts else np.empty((0, len(NAMES)))
            yield pd.DataFrame({n: made[:, k] for k, n in enumerate(NAMES)})

    out = dealt(df, times=1).withColumn("_mc", run.asNondeterministic()(*given))
    stats = {n: F.when(~F.isnan(f"_mc.{n}"), F.col(f"_mc.{n}")) for n in NAMES}
    return out.withColumns(stats).drop("_mc")
