"""Nearest neighbours on the sphere within a tolerance.

Two physical forms give the same rows: all pairs against a broadcast source, for a source of a few counted rows,
and a grid of declination bands and right-ascension cells, in which each source row is put into its cell's neighbours too.
The grid's equi-join grows with the rows, not with their product. It's always a sorted one, whose hot cells Spark splits: Spark judges a source by its file, before
it's put into nine cells, so a broadcast of it would be far larger than the limit says, and each task would hold it whole.

``compat`` compares the separation in radians with a tolerance in degrees, as the eager system does: a nominal
3 arc seconds then reach 172.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.astro import moved, separation
from .columns import coordinates, dealt, first, prefixed, with_row_index

#: Sources up to so many rows meet all rows of the primary table.
BROADCAST_ROWS = 64


def corrected(source: DataFrame, years: float | bool) -> DataFrame:
    """``<ra>_corrected`` and ``<dec>_corrected`` after proper motion, where the source has it and ``years`` isn't zero (True is one)."""
    at, years = coordinates(source), float(years)
    pm_ra = first(source, lambda c: "pmra" in c.lower() or "pm_ra" in c.lower())
    pm_dec = first(source, lambda c: "pmdec" in c.lower() or "pm_dec" in c.lower())
    if not (at and pm_ra and pm_dec and years):
        return source
    ra, dec = moved(at[0], at[1], pm_ra, pm_dec, years)
    return source.withColumns({f"{at[0]}_corrected": ra, f"{at[1]}_corrected": dec})


def within(primary: DataFrame, source: DataFrame, arcsec: float = 3.0, compat: bool = False, form: str = "auto", left_id: str = "_row_idx", right_id: str = "_src_idx") -> DataFrame:
    """(left_id, right_id, sep): all pairs within the tolerance.

    Rows without a position take no part. ``sep`` is in radians.
    """
    p_at, s_at = coordinates(primary), coordinates(source)
    s_at = tuple(f"{c}_corrected" if f"{c}_corrected" in source.columns else c for c in s_at)
    limit = arcsec / 3600 if compat else math.radians(arcsec / 3600)
    # a row that earlier joins have repeated is matched once
    p = primary.select(left_id, F.col(p_at[0]).alias("p_ra"), F.col(p_at[1]).alias("p_dec")).dropna().dropDuplicates([left_id])
    s = source.select(right_id, F.col(s_at[0]).alias("s_ra"), F.col(s_at[1]).alias("s_dec")).dropna()
    if form == "auto":
        form = "broadcast" if source.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else "grid"
    if form == "broadcast":
        pairs = p.join(F.broadcast(s), F.abs(F.col("p_dec") - F.col("s_dec")) <= math.degrees(limit) * (1 + 1e-9) + 1e-12)
    else:
        pairs = _grid_pairs(p, s, limit)
    near = pairs.withColumn("sep", separation("p_ra", "p_dec", "s_ra", "s_dec")).filter(F.col("sep") <= limit)
    return near.select(left_id, right_id, "sep")


def around(few: DataFrame, many: DataFrame, arcsec: float = 3.0) -> DataFrame:
    """(few, many, sep): all pairs :func:`within` the tolerance, with both rows as structs, so that pairs needn't be joined with their rows again.
    The few are put into their neighbours' cells, and each of the many goes through one exchange, once."""
    f_at, m_at = coordinates(few), coordinates(many)
    limit = math.radians(arcsec / 3600)
    p = many.select(F.struct(*many.columns).alias("many"), F.col(m_at[0]).alias("p_ra"), F.col(m_at[1]).alias("p_dec")).dropna(subset=["p_ra", "p_dec"])
    s = few.select(F.struct(*few.columns).alias("few"), F.col(f_at[0]).alias("s_ra"), F.col(f_at[1]).alias("s_dec")).dropna(subset=["s_ra", "s_dec"])
    near = _grid_pairs(p, s, limit).withColumn("sep", separation("p_ra", "p_dec", "s_ra", "s_dec")).filter(F.col("sep") <= limit)
    return near.select("few", "many", "sep")


def closest(pairs: DataFrame, left_id: str = "_row_idx", right_id: str = "_src_idx") -> DataFrame:
    """Of (left_id, right_id, sep), each left id's pair of least separation, ties to the smaller id."""
    best = pairs.groupBy(left_id).agg(F.min(F.struct("sep", right_id)).alias("b"))
    return best.select(left_id, f"b.{right_id}", "b.sep")


def nearest(primary: DataFrame, source: DataFrame, arcsec: float = 3.0, compat: bool = False, form: str = "auto", left_id: str = "_row_idx", right_id: str = "_src_idx") -> DataFrame:
    """(left_id, right_id, sep): each primary id's closest source row :func:`within` the tolerance."""
    return closest(within(primary, source, arcsec, compat, form, left_id, right_id), left_id, right_id)


def _grid_pairs(p: DataFrame, s: DataFrame, limit: float | Column, level: tuple[str, ...] = ()) -> DataFrame:
    """Candidate pairs that share a cell. A band is as high as the tolerance; the width of a band's cells is the right ascension that the tolerance
    can span in it and its neighbours, so a row's partners are in its own or an adjoining cell. ``limit`` may follow from columns ``level`` of both sides; only rows equal in these meet."""
    limit = limit if isinstance(limit, Column) else F.lit(float(limit))
    height = F.greatest(F.degrees(limit), F.lit(1e-6)) * 1.0001
    sin_limit = F.sin(F.least(limit, F.lit(math.pi / 2)))

    def band(dec):
        return F.floor((F.col(dec) + 90.0) / height)

    def cells_in(b):
        # the edge nearer to a pole of the band and its neighbours; there the span is widest
        far = F.least(F.lit(90.0), F.greatest(F.abs((b - 1) * height - 90.0), F.abs((b + 2) * height - 90.0)))
        span = F.when(F.cos(F.radians(far)) > 2 * sin_limit, F.degrees(F.asin(F.least(F.lit(1.0), sin_limit / F.cos(F.radians(far)))))).otherwise(F.lit(360.0))
        return F.greatest(F.floor(360.0 / (span * 1.0001)), F.lit(1))

    def cell(ra, n):
        return F.pmod(F.floor(F.pmod(F.col(ra), F.lit(360.0)) / (360.0 / n)), n)

    left = p.withColumn("band", band("p_dec")).withColumn("n", cells_in(F.col("band"))).withColumn("cell", cell("p_ra", F.col("n"))).drop("n")
    near = F.expr("sequence(-1, 1)")
    right = s.withColumn("band", F.explode(F.transform(near, lambda k: band("s_dec") + k))).withColumn("n", cells_in(F.col("band")))
    right = right.withColumn("cell", F.explode(F.array_distinct(F.transform(near, lambda k: F.pmod(cell("s_ra", F.col("n")) + k, F.col("n")))))).drop("n")
    if level:
        # cells of large radii make very many pairs of few bytes
        left, right = (dealt(df, *level, "band", "cell", times=1) for df in (left, right))
    return left.join(right.hint("merge"), [*level, "band", "cell"])


#: Radius of the finest grid, in radians; each level doubles it, up to the whole sphere.
FINEST, LEVELS = math.radians(0.01 / 3600), 27


def within_radius(primary: DataFrame, source: DataFrame, radius: str, left_id: str = "_row_idx", right_id: str = "_src_idx", carry: tuple[str, ...] = ()) -> DataFrame:
    """(left_id, right_id, sep): all pairs within the source row's own ``radius`` (radians); with ``carry``, also these columns of the source and both positions (p_ra, p_dec, s_ra, s_dec),
    so that pairs needn't be joined with their rows again. A row goes to the grid whose cells fit its radius; primary rows go to
    each grid that has rows, of which there are ``LEVELS`` at most."""
    p_at, s_at = coordinates(primary), coordinates(source)
    p = primary.select(left_id, F.col(p_at[0]).alias("p_ra"), F.col(p_at[1]).alias("p_dec")).dropna().dropDuplicates([left_id])
    s = source.select(right_id, F.col(s_at[0]).alias("s_ra"), F.col(s_at[1]).alias("s_dec"), F.col(radius).alias("radius"), *carry).dropna(subset=[right_id, "s_ra", "s_dec", "radius"]).filter("radius >= 0")
    s = s.withColumn("level", F.least(F.lit(LEVELS), F.greatest(F.lit(0), F.ceil(F.log2(F.greatest("radius", F.lit(FINEST)) / FINEST)))).cast("int"))
    used = sorted(r.level for r in s.select("level").distinct().collect())
    p = p.withColumn("level", F.explode(F.array(*map(F.lit, used)) if used else F.array().cast("array<int>")))
    # beyond a quarter of the sphere the cells are one, so the last level holds any radius
    limit = F.least(F.lit(FINEST) * F.pow(F.lit(2.0), F.col("level")), F.lit(math.pi))
    sep = separation("p_ra", "p_dec", "s_ra", "s_dec")
    return _grid_pairs(p, s, limit, ("level",)).withColumn("sep", sep).filter(F.col("sep") <= F.col("radius")).select(left_id, right_id, "sep", *(("p_ra", "p_dec", "s_ra", "s_dec", *carry) if carry else ()))


def k_nearest(pairs: DataFrame, k: int, left_id: str = "_row_idx", right_id: str = "_src_idx") -> DataFrame:
    """(left_id, near): of (left_id, right_id, sep), each left id's ``k`` pairs of least separation as an array of (sep, right_id), ties to the smaller id.
    Catalyst limits each group to ``k`` rows before the exchange too, so a left id with very many pairs sends few."""
    rank = F.row_number().over(Window.partitionBy(left_id).orderBy("sep", right_id))
    kept = pairs.withColumn("_rank", rank).filter(F.col("_rank") <= k)
    return kept.groupBy(left_id).agg(F.sort_array(F.collect_list(F.struct("sep", right_id))).alias("near"))


def cell_of(ra, dec, degrees: float) -> tuple[Column, Column, Column]:
    """Band, cell and area (in steradians) of the sky cell a position is in; cells are about ``degrees`` wide and high."""
    bands = math.ceil(180.0 / degrees)
    band = F.least(F.floor((dec + 90.0) / (180.0 / bands)), F.lit(bands - 1))
    south = F.radians(band * (180.0 / bands) - 90.0)
    n = F.greatest(F.floor(360.0 / degrees * F.cos(south + math.radians(90.0 / bands))), F.lit(1))
    area = (F.sin(south + math.radians(180.0 / bands)) - F.sin(south)) * 2 * math.pi / n
    return band, F.least(F.floor(F.pmod(ra, F.lit(360.0)) / (360.0 / n)), n - 1), area


def ambiguity(primary: DataFrame, source: DataFrame, arcsec: float = 3.0, sigma_arcsec: float = 0.5, close_arcsec: float = 0.05, least_reliability: float = 0.8, matched_share: float = 0.9, cell_degrees: float = 2.0, left_id: str = "_row_idx", right_id: str = "_src_idx") -> DataFrame:
    """(left_id, right_id, sep, second_id, second_sep, ratio, second_ratio, reliability, ambiguous): how sure each match is.

    A neighbour's likelihood ratio compares the chance that a true counterpart lies so far off, for a position error of ``sigma_arcsec``, with the chance of meeting an
    unrelated source there, from the density of sources in the primary row's sky cell. The reliability of the nearest is its share of all ratios and of the chance of no
    counterpart at all, 1 - ``matched_share``. A match is ambiguous below ``least_reliability``, or where the second neighbour is at most ``close_arcsec`` farther.
    """
    p_at, s_at = coordinates(primary), coordinates(source)
    near = k_nearest(within(primary, source, arcsec, left_id=left_id, right_id=right_id), 2, left_id, right_id)
    band, cell, area = cell_of(F.col(s_at[0]), F.col(s_at[1]), cell_degrees)
    counts = source.select(band.alias("band"), cell.alias("cell"), area.alias("area")).dropna().groupBy("band", "cell").agg((F.count("*") / F.max("area")).alias("density"))
    band, cell, area = cell_of(F.col(p_at[0]), F.col(p_at[1]), cell_degrees)
    placed = primary.select(left_id, band.alias("band"), cell.alias("cell"), area.alias("area")).dropna().dropDuplicates([left_id])
    # a cell without a source counts as one with a single one
    both = near.join(placed, left_id).join(counts, ["band", "cell"], "left").withColumn("density", F.coalesce("density", 1 / F.col("area")))
    sigma = math.radians(sigma_arcsec / 3600)

    def ratio(sep: Column) -> Column:
        return matched_share * F.exp(-sep * sep / (2 * sigma * sigma)) / (2 * math.pi * sigma * sigma) / F.col("density")

    first, second = F.get("near", F.lit(0)), F.get("near", F.lit(1))
    out = both.select(left_id, first[right_id].alias(right_id), first["sep"].alias("sep"), second[right_id].alias("second_id"), second["sep"].alias("second_sep"), ratio(first["sep"]).alias("ratio"), ratio(second["sep"]).alias("second_ratio"))
    out = out.withColumn("reliability", F.col("ratio") / (F.col("ratio") + F.coalesce("second_ratio", F.lit(0.0)) + (1 - matched_share)))
    close = F.coalesce(F.col("second_sep") - F.col("sep") <= math.radians(close_arcsec / 3600), F.lit(False))
    return out.withColumn("ambiguous", close | (F.col("reliability") < least_reliability))


def cone_join(primary: DataFrame, source: DataFrame, name: str, arcsec: float = 3.0, years: float | bool = 0.0, compat: bool = False, form: str = "auto") -> DataFrame:
    """All primary rows with their nearest source row's columns, separation and match quality; nulls where there's none."""
    if not coordinates(primary) or not coordinates(source):
        return primary
    p = with_row_index(primary)
    s = with_row_index(source, "_src_idx")
    found = nearest(p, corrected(s, years), arcsec, compat, form)
    # radians times 3600 in the eager system; arc seconds proper otherwise
    scale = 3600.0 if compat else 3600.0 * 180.0 / math.pi
    matched = found.join(prefixed(s, name, keep=("_src_idx",)), "_src_idx").withColumns({f"{name}_match_separation_arcsec": F.col("sep") * scale, f"{name}_match_quality": F.lit("coordinate_match")}).drop("_src_idx", "sep")
    out = p.join(matched, "_row_idx", "left")
    return out if "_row_idx" in primary.columns else out.drop("_row_idx")
