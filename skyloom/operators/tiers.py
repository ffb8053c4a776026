"""Tiered coverage of a target list from an astrometric catalog: by id, by position, by the older release; the first tier that has a target wins.

Remote lookups become joins with landed tables: ids are a semi-join, and what's left for the next tier is an anti-join.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.astro import ZERO_POINT
from ..functions.text import parse_id
from .quality import add_gaia_score
from .sky import around


def targets(primary: DataFrame, key: str = "gaia_id") -> DataFrame:
    """(target_id): distinct ids of the primary table."""
    return primary.select(parse_id(key).alias("target_id")).filter("target_id is not null").distinct()


def direct(wanted: DataFrame, catalog: DataFrame, id_col: str = "source_id") -> DataFrame:
    """Tier 1: the id itself, with parallax and magnitude; it counts as the id of both releases."""
    has = [F.col(c).isNotNull() for c in ("parallax", "phot_g_mean_mag") if c in catalog.columns]
    good = catalog.filter(has[0] & has[1] if len(has) == 2 else has[0]) if has else catalog
    return good.join(wanted, good[id_col] == wanted["target_id"], "left_semi").withColumns({"gaia_dr2_source_id": F.col(id_col), "gaia_dr3_source_id": F.col(id_col), "data_source": F.lit("DR3_direct"), "crossmatch_method": F.lit("direct"), "match_quality": F.lit(1.0)})


def by_position(wanted: DataFrame, older: DataFrame, catalog: DataFrame, arcsec: float = 1.0, magnitudes: float = 1.0, id_col: str = "source_id") -> DataFrame:
    """Tier 2: of the sources of like magnitude within an arc second of a target's older position, the nearest; the quality falls beyond half an arc second."""
    at = older.join(wanted, older[id_col] == wanted["target_id"], "left_semi").select(F.col(id_col).alias("_t"), "ra", "dec", F.col("phot_g_mean_mag").alias("_mag"))
    good = catalog.filter(F.col("parallax").isNotNull() & F.col(id_col).isNotNull())
    alike = around(at, good, arcsec).filter(F.abs(F.col("few._mag") - F.col("many.phot_g_mean_mag")) < magnitudes)
    best = alike.groupBy(F.col("few._t").alias("_t")).agg(F.min_by(F.struct("sep", "many"), F.struct("sep", f"many.{id_col}")).alias("b"))
    joined = best.select("_t", "b.sep", "b.many.*")
    quality = F.when(F.col("sep") < math.radians(0.5 / 3600), 0.8).otherwise(0.6)
    return joined.withColumns({"gaia_dr2_source_id": F.col("_t"), "gaia_dr3_source_id": F.col(id_col), "data_source": F.lit("DR3_crossmatch"), "crossmatch_method": F.lit("position"), "match_quality": quality}).drop("_t", "sep")


def fallback(wanted: DataFrame, older: DataFrame, id_col: str = "source_id") -> DataFrame:
    """Tier 3: the older release's own row, if its parallax is positive; there's no newer id."""
    good = older.filter("parallax > 0")
    return good.join(wanted, good[id_col] == wanted["target_id"], "left_semi").withColumns({"gaia_dr2_source_id": F.col(id_col), "gaia_dr3_source_id": F.lit(None).cast("bigint"), "data_source": F.lit("DR2_direct"), "crossmatch_method": F.lit("dr2_fallback"), "match_quality": F.lit(0.4)})


def unmatched(wanted: DataFrame, found: DataFrame, key: str = "gaia_dr2_source_id") -> DataFrame:
    return wanted.join(found.select(F.col(key).alias("target_id")), "target_id", "left_anti")


def combine(tiers: list[DataFrame], key: str = "gaia_dr2_source_id") -> DataFrame:
    """One row a target, from the first tier that has it."""
    ranked = [t.withColumn("_tier", F.lit(k)) for k, t in enumerate(tiers)]
    every = ranked[0]
    for t in ranked[1:]:
        every = every.unionByName(t, allowMissingColumns=True)
    rest = [c for c in every.columns if c != key]
    one = every.groupBy(key).agg(F.min_by(F.struct(*rest), "_tier").alias("v"))
    return one.select(key, *(F.col(f"v.{c}").alias(c) for c in rest if c != "_tier"))


def cascade(primary: DataFrame, catalog: DataFrame, older: DataFrame, key: str = "gaia_id") -> DataFrame:
    """All tiers, with the parallax corrected and an overall score. Positions are looked up for what the ids left; the last tier isn't told what they found, for
    :func:`combine` drops its rows of these, and they'd be computed twice."""
    wanted = targets(primary, key)
    one = direct(wanted, catalog)
    left = unmatched(wanted, one)
    two = by_position(left, older, catalog)
    three = fallback(left, older)
    return enhance(combine([one, two, three]))


def enhance(df: DataFrame, offset: float = ZERO_POINT) -> DataFrame:
    if "parallax" in df.columns:
        df = df.withColumns({"parallax_corrected": F.col("parallax") - offset, "parallax_correction_applied": F.lit(True)})
    return add_gaia_score(df)
