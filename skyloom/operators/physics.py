"""Derived columns of physics; formulas are in functions/astro.py."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import astro
from .columns import ending, filled, first, require


def add_hz_edges(df: DataFrame, optimistic: bool = False, prefix: str | None = None, teff: str = "st_teff", lum: str = "st_lum") -> DataFrame:
    """``<prefix>inner`` and ``<prefix>outer`` in AU."""
    require(df, teff, lum)
    prefix = prefix if prefix is not None else "hz_opt_" if optimistic else "hz_"
    inner, outer = ("RecentVenus", "EarlyMars") if optimistic else ("RunawayGreenhouse", "MaximumGreenhouse")
    return df.withColumns({f"{prefix}inner": astro.hz_distance(teff, lum, inner), f"{prefix}outer": astro.hz_distance(teff, lum, outer)})


def add_stellar_flux(df: DataFrame) -> DataFrame:
    require(df, "st_lum", "pl_orbsmax")
    return df.withColumn("stellar_flux_s", astro.stellar_flux("st_lum", "pl_orbsmax"))


def add_equilibrium_temperature(df: DataFrame) -> DataFrame:
    require(df, "st_teff", "st_rad", "pl_orbsmax")
    df = df.withColumns({c: F.lit(v) for c, v in (("albedo", 0.3), ("redistribution_factor", 1.0)) if c not in df.columns})
    return df.withColumn("equilibrium_temperature", astro.equilibrium_temperature("st_teff", "st_rad", "pl_orbsmax", "albedo", "redistribution_factor"))


def add_surface_gravity(df: DataFrame) -> DataFrame:
    require(df, "pl_masse", "pl_rade")
    return df.withColumn("surface_gravity", astro.surface_gravity("pl_masse", "pl_rade"))


def add_escape_velocity(df: DataFrame) -> DataFrame:
    require(df, "pl_masse", "pl_rade")
    return df.withColumn("escape_velocity", astro.escape_velocity("pl_masse", "pl_rade"))


def add_hz_position(df: DataFrame) -> DataFrame:
    if "pl_orbsmax" not in df.columns:
        return df
    require(df, "hz_inner", "hz_outer", "hz_opt_inner", "hz_opt_outer")
    return df.withColumns({"hz_position_conservative": astro.hz_position("pl_orbsmax", "hz_inner", "hz_outer"), "hz_position_optimistic": astro.hz_position("pl_orbsmax", "hz_opt_inner", "hz_opt_outer")})


def add_distance(df: DataFrame, zero_point: bool = False, offset: float = astro.ZERO_POINT) -> DataFrame:
    """Parsecs: the first geometric distance that has values (one counting job if there are several), else the inverse of the first parallax."""
    named = [c for c in df.columns if c.lower().endswith("distance_gspphot")]
    if len(named) > 1:
        has = filled(df, named)
        named = [c for c in named if has[c]]
    geometric = F.col(named[0]) if named else F.lit(None).cast("double")
    parallax = first(df, ending("parallax"))
    plx = F.col(parallax) - (offset if zero_point else 0.0) if parallax else F.lit(None).cast("double")
    inverse = F.when(plx > 0, F.try_divide(F.lit(1000.0), plx))
    return df.withColumns({
        "distance_pc": F.when(geometric.isNotNull(), geometric).otherwise(inverse),
        "distance_provenance": F.when(geometric.isNotNull(), F.lit("geometric")).when(inverse.isNotNull(), F.lit("inv_parallax")),
        "distance_units": F.lit("pc"),
    })


def derive_features(df: DataFrame) -> DataFrame:
    """Both habitable zones, flux, temperature, gravity, escape velocity and positions, in this order."""
    for step in (add_hz_edges, lambda d: add_hz_edges(d, optimistic=True), add_stellar_flux, add_equilibrium_temperature, add_surface_gravity, add_escape_velocity, add_hz_position):
        df = df.transform(step)
    return df
