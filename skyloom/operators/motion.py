"""Rigorous motion of stars on the sphere, with the covariance of position, parallax and proper motion carried to the new epoch.

A star moves uniformly in space. Its direction, parallax and proper motion at another epoch follow from unit vectors, so poles and the wrap of right
ascension need no care, and the covariance follows from the derivatives in the local frame (east, north) of both epochs. Rows are computed
as matrices in Arrow batches. The position's part of the covariance is an error ellipse; :func:`ellipse_pairs` matches within it, each row by its own radius.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import require
from .sky import within_radius

#: Parameters in the order of the covariance: degrees for the first two, mas, mas a year; errors of all in mas, that of right ascension along the circle.
PARAMETERS = ("ra", "dec", "parallax", "pmra", "pmdec")
PAIRS = [(i, j) for i in range(5) for j in range(i + 1, 5)]
MAS = math.pi / 180 / 3.6e6
#: km/s times mas of parallax in a mas a year (fixed value).
KM_S = 4.740470446
NEW = [*(f"{c}_epoch" for c in PARAMETERS), *(f"{c}_error_epoch" for c in PARAMETERS), *(f"{PARAMETERS[i]}_{PARAMETERS[j]}_corr_epoch" for i, j in PAIRS), "ellipse_major", "ellipse_minor", "ellipse_angle"]


def _frame(ra: np.ndarray, dec: np.ndarray) -> np.ndarray:
    """East, north and direction, by row: (rows, 3 vectors, 3)."""
    sa, ca, sd, cd, zero = np.sin(ra), np.cos(ra), np.sin(dec), np.cos(dec), np.zeros_like(ra)
    return np.stack([np.stack([-sa, ca, zero], 1), np.stack([-sd * ca, -sd * sa, cd], 1), np.stack([cd * ca, cd * sa, sd], 1)], 1)


def moved(x: np.ndarray, cov: np.ndarray, rv: np.ndarray, years: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parameters (rows x 5, degrees and mas) and covariance (rows x 5 x 5, mas) after ``years``; ``rv`` in km/s, taken as exact."""
    ra, dec, plx, pa, pd_ = np.radians(x[:, 0]), np.radians(x[:, 1]), x[:, 2] * MAS, x[:, 3] * MAS, x[:, 4] * MAS
    t, zeta = years, rv * x[:, 2] / KM_S * MAS
    p, q, r = np.moveaxis(_frame(ra, dec), 1, 0)
    pm = p * pa[:, None] + q * pd_[:, None]
    pm2, grow = pa**2 + pd_**2, 1 + zeta * t
    f = 1 / np.sqrt(grow**2 + pm2 * t**2)
    u = (r * grow[:, None] + pm * t[:, None]) * f[:, None]
    new_ra, new_dec = np.arctan2(u[:, 1], u[:, 0]), np.arctan2(u[:, 2], np.hypot(u[:, 0], u[:, 1]))
    pn, qn, _ = np.moveaxis(_frame(new_ra, new_dec), 1, 0)
    moving = (pm * grow[:, None] - r * (pm2 * t)[:, None]) * (f**3)[:, None]
    new = [(pn * moving).sum(1), (qn * moving).sum(1)]
    j = np.zeros((len(x), 5, 5))
    for k, e in enumerate((pn, qn)):
        ep, eq, er, pm_new = (e * p).sum(1), (e * q).sum(1), (e * r).sum(1), new[k]
        # along the new east or north: by the old position, and by the old motion
        j[:, k, 0] = (ep * grow - er * pa * t) * f
        j[:, k, 1] = (eq * grow - er * pd_ * t) * f
        j[:, k, 3], j[:, k, 4] = ep * t * f, eq * t * f
        j[:, 3 + k, 0] = -(ep * pm2 * t + er * pa * grow) * f**3
        j[:, 3 + k, 1] = -(eq * pm2 * t + er * pd_ * grow) * f**3
        j[:, 3 + k, 3] = (ep * grow - 2 * er * pa * t) * f**3 - 3 * pm_new * pa * t**2 * f**2
        j[:, 3 + k, 4] = (eq * grow - 2 * er * pd_ * t) * f**3 - 3 * pm_new * pd_ * t**2 * f**2
    j[:, 2, 2], j[:, 2, 3], j[:, 2, 4] = f, -plx * pa * t**2 * f**3, -plx * pd_ * t**2 * f**3
    # the radial motion in mas a year is rv times parallax, so a larger parallax is a nearer star
    if rv.any():
        slope = rv / KM_S
        df = -(f**3) * grow * t
        for k, e in enumerate((pn, qn)):
            er, em = (e * r).sum(1), (e * pm).sum(1)
            j[:, k, 2] = slope * (er * t * f)
            j[:, 3 + k, 2] = slope * (em * t * f**3 + 3 * df / f * new[k])
        j[:, 2, 2] = f + plx * df * slope
    out = np.stack([np.degrees(new_ra) % 360, np.degrees(new_dec), plx * f / MAS, new[0] / MAS, new[1] / MAS], 1)
    return out, j @ cov @ j.transpose(0, 2, 1)


def ellipse(cov: np.ndarray) -> np.ndarray:
    """Half axes of the one-sigma ellipse of the position, and the angle of the longer one from north over east in degrees."""
    a, b, c = cov[:, 0, 0], cov[:, 0, 1], cov[:, 1, 1]
    mean, half = (a + c) / 2, np.hypot((a - c) / 2, b)
    return np.stack([np.sqrt(mean + half), np.sqrt(np.maximum(mean - half, 0)), np.degrees(0.5 * np.arctan2(2 * b, c - a)) % 180], 1)


def propagated(df: DataFrame, years: Column | float, rv: str | None = None) -> DataFrame:
    """``df`` with the columns ``NEW``: parameters, errors, correlations and error ellipse after ``years``.

    Reads ra and dec; parallax and proper motion where there are such columns, else zero; ``<parameter>_error`` and ``<one>_<other>_corr``
    likewise. A null parallax, motion, radial velocity, error or correlation counts as zero, a null position or ``years`` gives nulls.
    """
    require(df, "ra", "dec")
    zero = F.lit(0.0)
    told = lambda c: F.coalesce(F.col(c).cast("double"), zero) if c in df.columns else zero
    given = [F.col("ra").cast("double"), F.col("dec").cast("double"), *map(told, PARAMETERS[2:]), *(told(f"{c}_error") for c in PARAMETERS), *(told(f"{PARAMETERS[i]}_{PARAMETERS[j]}_corr") for i, j in PAIRS), told(rv) if rv else zero, years if isinstance(years, Column) else F.lit(float(years))]

    @F.pandas_udf(", ".join(f"{c} double" for c in NEW))
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        v = rows.to_numpy(dtype=float)
        x, errors, corr, vel, t = v[:, :5], v[:, 5:10], np.broadcast_to(np.eye(5), (len(v), 5, 5)).copy(), v[:, 20], v[:, 21]
        for k, (i, j) in enumerate(PAIRS):
            corr[:, i, j] = corr[:, j, i] = v[:, 10 + k]
        new, cov = moved(x, corr * errors[:, :, None] * errors[:, None, :], vel, t)
        sd = np.sqrt(np.einsum("nii->ni", cov))
        with np.errstate(invalid="ignore", divide="ignore"):
            back = [np.where(sd[:, i] * sd[:, j] > 0, cov[:, i, j] / (sd[:, i] * sd[:, j]), 0.0) for i, j in PAIRS]
        out = np.concatenate([new, sd, np.stack(back, 1), ellipse(cov)], 1)
        out[~np.isfinite(out).all(1)] = np.nan
        return pd.DataFrame(out, columns=NEW).astype("Float64").mask(np.isnan(out))

    made = run(F.struct(*(c.alias(f"c{k}") for k, c in enumerate(given))))
    return df.withColumn("_moved", made).select(*(c for c in df.columns if c not in NEW), "_moved.*")


def ellipse_pairs(primary: DataFrame, moved_source: DataFrame, sigmas: float = 3.0, floor_mas: float = 0.0, left_id: str = "_row_idx", right_id: str = "_src_idx") -> DataFrame:
    """(left_id, right_id, sep, distance2): positions of ``primary`` within ``sigmas`` of the error ellipse of a :func:`propagated` source, whose axes are widened by
    ``floor_mas`` in quadrature. ``sep`` in radians, ``distance2`` the square of the distance in sigmas."""
    s = moved_source.select(right_id, F.col("ra_epoch").alias("ra"), F.col("dec_epoch").alias("dec"), *(F.expr(e).alias(n) for n, e in {
        "aa": f"pow(ra_error_epoch, 2) + {floor_mas**2!r}", "dd": f"pow(dec_error_epoch, 2) + {floor_mas**2!r}", "ad": "ra_dec_corr_epoch * ra_error_epoch * dec_error_epoch",
        "radius": f"{sigmas!r} * sqrt(pow(ellipse_major, 2) + {floor_mas**2!r}) * {MAS!r}"}.items()))
    both = within_radius(primary, s, "radius", left_id, right_id, carry=("aa", "dd", "ad")).withColumns({"a1": F.radians("p_ra"), "d1": F.radians("p_dec"), "ra": F.col("s_ra"), "dec": F.col("s_dec")})
    # offsets in the tangent plane at the source
    east = F.cos("d1") * F.sin(F.col("a1") - F.radians("ra")) / MAS
    north = (F.sin("d1") * F.cos(F.radians("dec")) - F.cos("d1") * F.sin(F.radians("dec")) * F.cos(F.col("a1") - F.radians("ra"))) / MAS
    det = F.col("aa") * F.col("dd") - F.col("ad") * F.col("ad")
    square = (east * east * F.col("dd") - 2 * east * north * F.col("ad") + north * north * F.col("aa")) / F.nullif(det, F.lit(0.0))
    return both.withColumn("distance2", square).filter(F.col("distance2") <= sigmas**2).select(left_id, right_id, "sep", "distance2")
