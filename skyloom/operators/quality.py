"""Quality scores and flags; all are expressions, and a null input gives the class that the rules say."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import to_number
from .columns import ending, first, require

#: Parameters of the completeness score (fixed values).
KEY_PARAMETERS = ("pl_rade", "pl_masse", "pl_orbsmax", "st_teff", "st_lum", "st_mass")


def count_present(names) -> Column:
    return reduce(lambda a, b: a + b, (F.col(c).isNotNull().cast("int") for c in names), F.lit(0))


def add_completeness(df: DataFrame, names=KEY_PARAMETERS, available_only: bool = False) -> DataFrame:
    """Share of parameters present. All must be columns, unless only those available count."""
    names = [c for c in names if c in df.columns] if available_only else list(names)
    require(df, *names)
    return df.withColumn("data_completeness_score", count_present(names) / F.lit(float(len(names)))) if names else df


def ruwe_class(ruwe: Column) -> Column:
    r = to_number(ruwe)
    return F.when(r <= 1.4, F.lit("good")).when(r <= 2.0, F.lit("suspect")).when(r.isNotNull(), F.lit("poor"))


def add_ruwe_class(df: DataFrame) -> DataFrame:
    found = first(df, ending("ruwe"))
    return df.withColumn("astrometry_quality_flag", ruwe_class(F.col(found)) if found else F.lit(None).cast("string"))


def add_crossmatch_quality(df: DataFrame, compat: bool = False) -> DataFrame:
    """Class and score of the cross-match.

    The prefix is what stands before ``ambiguity_flag``. In ``compat`` one word less is cut off it, so the ambiguity and the prefixed method,
    id and ruwe are never found, and only unprefixed ones count.
    """
    flag = first(df, lambda c: c.endswith("_ambiguity_flag") or c == "ambiguity_flag") or first(df, lambda c: "gaia_dr3" in c and "ambiguity" in c)
    if flag is None:
        return df.withColumns({"crossmatch_quality": F.lit("unmatched_dr2_only"), "crossmatch_score": F.lit(0.0)})
    prefix = flag.rsplit("_", 1)[0] + "_" if compat else flag[: flag.rindex("ambiguity")]
    null = F.lit(None)

    def some(*names: str) -> Column:
        there = [F.col(n).cast("string") for n in names if n in df.columns]
        return F.coalesce(*there) if there else null.cast("string")

    def number(*names: str) -> Column:
        there = [to_number(n) for n in names if n in df.columns]
        return F.coalesce(*there) if there else null.cast("double")

    names = lambda c: (f"{prefix}{c}", c)
    id_ = some(f"{prefix}gaia_dr3_source_id", "gaia_dr3_source_id", "gaia_id", "source_id_dr3")
    method = F.lower(F.coalesce(some(*names("crossmatch_method")), F.lit("")))
    ambiguous = F.coalesce(F.col(f"{prefix}ambiguity_flag").cast("boolean"), F.lit(False)) if f"{prefix}ambiguity_flag" in df.columns else F.lit(False)
    sep = number("angular_separation") if compat else number(*names("angular_separation"))
    ruwe = number("ruwe") if compat else number("ruwe", f"{prefix}ruwe")
    dr2, dr3 = number("gaia_dr2_parallax"), number("gaia_dr3_parallax")
    none = F.lit(0.0)  # least() passes over nulls, so they are told apart first
    far = F.when(sep.isNull(), none).otherwise(F.least(F.lit(1.0), sep * sep))
    off = F.abs(dr3 - dr2) / F.greatest(F.lit(1e-3), (F.abs(dr2) + F.abs(dr3)) / 2)
    apart = F.when(off.isNull(), none).otherwise(F.least(F.lit(1.0), off * off))
    rough = F.when(ruwe > 1.4, F.least(F.lit(1.0), ruwe - 1.4)).otherwise(none)
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1.0 - 0.3 * far - 0.3 * apart - 0.2 * rough))
    cone = method.contains("position") | method.contains("cone")
    kind = F.when(id_.isNull(), F.lit("unmatched_dr2_only")).when(ambiguous, F.lit("neighbourhood_tie")).when(cone, F.lit("pm_cone")).otherwise(F.lit("best_neighbour"))
    return df.withColumns({"crossmatch_quality": kind, "crossmatch_score": score})


def _good(test: Column, value: Column) -> Column:
    return F.when(value.isNull(), F.lit("unknown")).when(test, F.lit("good")).otherwise(F.lit("poor"))


def add_gaia_flags(df: DataFrame, name: str = "") -> DataFrame:
    """Astrometry and parallax classes of a joined catalog (``name`` in front of its columns)."""
    p = f"{name}_" if name else ""
    made = {}
    if f"{p}ruwe" in df.columns:
        made[f"{p}astrometry_quality"] = _good(F.col(f"{p}ruwe") < 1.4, F.col(f"{p}ruwe"))
    if {f"{p}parallax", f"{p}parallax_error"} <= set(df.columns):
        snr = F.try_divide(F.col(f"{p}parallax"), F.col(f"{p}parallax_error"))
        made |= {f"{p}parallax_snr": snr, f"{p}parallax_quality": _good(snr > 5.0, snr)}
    return df.withColumns(made)


def add_candidate_flags(df: DataFrame, name: str, mission: str | None = None, prefix: str | None = None) -> DataFrame:
    """Flags of a candidate catalog; ``mission`` is told from its name unless given, columns carry ``prefix`` (the name and '_', unless given)."""
    p = f"{name}_" if prefix is None else prefix
    mission = mission or ("toi" if "toi" in name.lower() else "koi" if "koi" in name.lower() else "")
    d = f"{p}tfopwg_disp"
    if mission == "toi" and d in df.columns:
        level = F.when(F.col(d).isin("PC", "CP"), F.lit("high")).when(F.col(d) == "APC", F.lit("medium")).when(F.col(d).isNotNull(), F.lit("low")).otherwise(F.lit("none"))
        return df.withColumns({"tess_candidate_flag": F.col(d).isNotNull(), "tess_disposition": F.col(d), "tess_candidate_confidence": level})
    d = f"{p}koi_disposition"
    if mission == "koi" and d in df.columns:
        flags = [c for c in df.columns if "fpflag" in c.lower()]
        made = {"kepler_candidate_flag": F.coalesce(F.col(d) == "CANDIDATE", F.lit(False)), "kepler_disposition": F.col(d)}
        return df.withColumns(made | ({"kepler_fp_flag_count": count_present(flags)} if flags else {}))
    return df


def add_gaia_score(df: DataFrame) -> DataFrame:
    """Product of a ruwe term and a parallax term; what's missing counts as one."""
    one = F.lit(1.0)
    r = F.coalesce(1.0 / (1.0 + (F.col("ruwe") - 1.0) * (F.col("ruwe") - 1.0)), one) if "ruwe" in df.columns else one
    p = one
    if {"parallax", "parallax_error"} <= set(df.columns):
        p = F.coalesce(F.when((F.col("parallax_error") > 0) & F.col("parallax").isNotNull(), F.greatest(F.lit(0.0), F.least(one, F.try_divide(F.col("parallax"), F.col("parallax_error")) / 10.0))), one)
    return df.withColumn("overall_quality_score", r * p)


def add_overall_quality(df: DataFrame) -> DataFrame:
    """Mean of the completeness score and of each of the Gaia quality columns being good."""
    parts = [F.col("data_completeness_score")] if "data_completeness_score" in df.columns else []
    parts += [F.coalesce((F.col(c) == "good").cast("double"), F.lit(0.0)) for c, t in df.dtypes if "gaia" in c.lower() and "quality" in c.lower() and t == "string"]
    if not parts:
        return df
    total = reduce(lambda a, b: a + b, (F.coalesce(x, F.lit(0.0)) for x in parts))
    n = reduce(lambda a, b: a + b, (x.isNotNull().cast("int") for x in parts))
    return df.withColumn("overall_quality_score", F.try_divide(total, n))
