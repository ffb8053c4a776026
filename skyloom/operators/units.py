"""Unit conversion, unit labels and physical range checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import filled

#: Jupiter's radius and mass in Earth's (fixed values).
R_JUP, M_JUP = 11.209, 317.83
#: Labels of columns that are in canonical units (fixed values); eccentricity has none.
LABELS = {"st_lum": "L_sun", "st_rad": "R_sun", "st_mass": "M_sun", "st_teff": "K", "pl_orbsmax": "AU", "pl_orbper": "days", "pl_orbeccen": None}
DAYS_A_YEAR = 365.25
LONG_PERIOD, LONGEST_PERIOD = 1.0e5, DAYS_A_YEAR * 1e6


def standardize_units(df: DataFrame, mode: str = "library") -> DataFrame:
    """Earth units for radius and mass, and ``<column>_units``.

    ``library``: a column counts if it holds any value (one counting job); a converted column is labelled with its original unit.
    ``pipeline``: a column counts if it exists; a converted column is labelled in Earth's units, and eccentricity and parallax get no label.
    Values of the two unit systems are never mixed row by row.
    """
    if mode not in ("library", "pipeline"):
        raise ValueError(f"unknown mode: {mode}")
    asked = [c for c in df.columns if c in LABELS or c in ("pl_rade", "pl_radj", "pl_masse", "pl_massj") or _is_parallax(c)]
    has = {c for c, n in filled(df, asked).items() if n} if mode == "library" else set(asked)
    made: dict = {}
    for earth, jupiter, factor, unit in (("pl_rade", "pl_radj", R_JUP, "R"), ("pl_masse", "pl_massj", M_JUP, "M")):
        if earth in has:
            made[f"{earth}_units"] = F.lit(f"{unit}_earth")
        elif jupiter in has:
            made[earth] = F.col(jupiter) * factor
            made[f"{earth}_units"] = F.lit(f"{unit}_jup" if mode == "library" else f"{unit}_earth")
    labels = LABELS if mode == "library" else {c: u for c, u in LABELS.items() if u and c != "pl_orbeccen"}
    made |= {f"{c}_units": F.lit(u).cast("string") for c, u in labels.items() if c in has}
    if mode == "library":
        made |= {f"{c}_units": F.lit("mas") for c in asked if _is_parallax(c) and c in has}
    return df.withColumns(made)


def _is_parallax(c: str) -> bool:
    return c.lower().endswith("parallax")


def range_checks(df: DataFrame, drop_empty: bool = True) -> DataFrame:
    """``<column>_flag_invalid`` from the original values, null for invalid ones, and periods corrected or capped.

    A null is valid. A period above 1e5 days is replaced by Kepler's third law where axis and stellar mass allow; one that is then above a million years
    becomes null and invalid. ``pl_orbper_corrected`` tells which.
    """
    c = F.col
    valid = {"pl_orbper": c("pl_orbper") > 0, "pl_orbsmax": c("pl_orbsmax") > 0, "pl_orbeccen": (c("pl_orbeccen") >= 0) & (c("pl_orbeccen") < 1), "pl_rade": c("pl_rade") > 0, "pl_masse": c("pl_masse") > 0}
    valid = {k: F.coalesce(v, F.lit(True)) for k, v in valid.items() if k in df.columns}
    df = df.withColumns({f"{k}_flag_invalid": ~v for k, v in valid.items()} | {k: F.when(v, c(k)) for k, v in valid.items()})
    note = F.lit("") if "pl_orbper_corrected" not in df.columns else c("pl_orbper_corrected")
    if "pl_orbper" not in df.columns:
        df = df.withColumn("pl_orbper_corrected", note)
    else:
        period = c("pl_orbper")
        if {"pl_orbsmax", "st_mass"} <= set(df.columns):
            a, m = c("pl_orbsmax"), c("st_mass")
            extreme = F.coalesce((c("pl_orbper") > LONG_PERIOD) & (a > 0) & (m > 0), F.lit(False))
            period = F.when(extreme, F.sqrt(F.when(extreme, a * a * a / m)) * DAYS_A_YEAR).otherwise(period)
            note = F.when(extreme, F.lit("kepler_third_law")).otherwise(note)
        df = df.withColumns({"_period": period, "_note": note})
        capped = F.coalesce(c("_period") > LONGEST_PERIOD, F.lit(False))
        df = df.withColumns({"pl_orbper": F.when(~capped, c("_period")), "pl_orbper_flag_invalid": c("pl_orbper_flag_invalid") | capped, "pl_orbper_corrected": F.when(capped, F.lit("capped_unphysical")).otherwise(c("_note"))}).drop("_period", "_note")
    if drop_empty and "pl_pubdate" in df.columns and not filled(df, ["pl_pubdate"])["pl_pubdate"]:
        df = df.drop("pl_pubdate")
    return df
