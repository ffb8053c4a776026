"""Queries by name over the driver's tables, each with DuckDB SQL for the same rows; doubles are rounded to six digits in both."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .fixtures import view, with_views
from .functions import text
from .functions.astro import separation
from .operators import columns, joins, missing, montecarlo, normalize, physics, profile, quality, sky, tiers, units
from .plans import merge, pipeline
from .sources import scan
from .streaming import enrich

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
_made: list[str] = []


def query(sql: str | None = None, name: str | None = None):
    """Register a query under its function's name, with its SQL; the adapter views that the SQL names are put in front."""

    def add(f):
        key = name or f.__name__
        QUERIES[key] = f
        if sql is not None:
            ORACLE_SQL[key] = with_views(sql)
        return f

    return add


def r(c, alias: str | None = None):
    """Rounded to six digits."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col, 6).alias(alias or (c if isinstance(c, str) else "value"))


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _scratch(spark: SparkSession, name: str) -> str:
    """A fresh path that all executors see; a local folder only where no shared one is set and all runs in this process (tests)."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="skyloom-")
    _made.append(f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _made[-1]


def clean(spark: SparkSession) -> None:
    """Deletes what queries wrote to folders of their own in this application. Frames that read them can't be used any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while _made:
        at = jvm.org.apache.hadoop.fs.Path(_made.pop())
        at.getFileSystem(conf).delete(at, True)


# scans and projections


@query("select l_orderkey, l_linenumber, l_quantity from lineitem where l_quantity > 45")
def scan_project(spark, d):
    return scan.scan_parquet(spark, f"{d}/lineitem.parquet", ["l_orderkey", "l_linenumber", "l_quantity"], "l_quantity > 45")


@query("select p_partkey, p_name, round(p_retailprice, 6) as p_retailprice from part")
def csv_roundtrip(spark, d):
    part = _table(spark, d, "part").select("p_partkey", "p_name", "p_retailprice")
    folder = _scratch(spark, "csv")
    path = scan.export(part, folder, "part", ["csv"])["csv"]
    kept = scan.keep(scan.scan_csv(spark, path, part.schema), ["p_partkey", "p_name", "p_retailprice", "absent"])
    return kept.select("p_partkey", "p_name", r("p_retailprice"))


@query("select * exclude (p_size, p_name) from part")
def drop_columns(spark, d):
    return columns.drop_listed(_table(spark, d, "part"), ["p_size", "p_name", "absent"])


@query("select p_partkey, p_size as cat_p_size, p_retailprice as cat_p_retailprice from part")
def prefix_rename(spark, d):
    return columns.prefixed(_table(spark, d, "part").select("p_partkey", "p_size", "p_retailprice"), "cat", keep=["p_partkey"])


@query("select row_idx, concat(cast(row_idx as varchar), '_', coalesce(pl_name, 'unknown')) as record_id from prim", "record_id")
def q_record_id(spark, d):
    return columns.record_id(view(spark, d, "prim"), "row_idx").select("row_idx", "record_id")


@query(r"select row_idx, lower(regexp_replace(pl_name, '(^\s+)|(\s+$)', '', 'g')) as name from prim", "norm_name")
def q_norm_name(spark, d):
    return view(spark, d, "prim").select("row_idx", text.norm_name("pl_name").alias("name"))


@query("select row_idx, try_cast(nullif(regexp_extract(gaia_id, '[0-9]{10,}'), '') as bigint) as id from prim", "parse_id")
def q_parse_id(spark, d):
    return view(spark, d, "prim").select("row_idx", text.parse_id("gaia_id").alias("id"))


@query("select p_partkey, try_cast(case when p_partkey % 3 = 0 then p_name else cast(p_size as varchar) end as double) as value from part")
def coerce_numeric(spark, d):
    mixed = F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")).otherwise(F.col("p_size").cast("string"))
    return _table(spark, d, "part").select("p_partkey", text.to_number(mixed).alias("value"))


# joins

_ID = "try_cast(nullif(regexp_extract(gaia_id, '[0-9]{10,}'), '') as bigint)"
_LEFT_ID = f"select row_idx, g.gaia_dr2_source_id as gaia_gaia_dr2_source_id, round(g.parallax, 6) as gaia_parallax from prim left join gaia g on {_ID} %s g.gaia_dr2_source_id"


@query(_LEFT_ID % "=")
def join_id(spark, d):
    return joins.by_id(view(spark, d, "prim"), view(spark, d, "gaia"), "gaia").select("row_idx", "gaia_gaia_dr2_source_id", r("gaia_parallax"))


@query(_LEFT_ID % "is not distinct from")
def join_id_nullsafe(spark, d):
    return joins.by_id(view(spark, d, "prim"), view(spark, d, "gaia"), "gaia", compat=True, exact=True).select("row_idx", "gaia_gaia_dr2_source_id", r("gaia_parallax"))


_NAMES = r"select row_idx, c.tid as cand_tid from prim p {how} join cand c on lower(regexp_replace(p.{left}, '(^\s+)|(\s+$)', '', 'g')) = lower(regexp_replace(c.{right}, '(^\s+)|(\s+$)', '', 'g'))"


@query(_NAMES.format(how="inner", left="pl_name", right="planet_name"))
def join_name(spark, d):
    return joins.by_name(view(spark, d, "prim"), view(spark, d, "cand"), "cand", "pl_name", "inner").select("row_idx", "cand_tid")


@query(_NAMES.format(how="inner", left="hostname", right="name"))
def join_host(spark, d):
    return joins.by_host(view(spark, d, "prim").select("row_idx", "hostname"), view(spark, d, "cand").select("tid", "name"), "cand", "inner").select("row_idx", "cand_tid")


@query(_NAMES.format(how="left", left="pl_name", right="planet_name"))
def join_generic(spark, d):
    return joins.by_any_name(view(spark, d, "prim"), view(spark, d, "cand"), "cand").select("row_idx", "cand_tid")


@query("select row_idx, c.tid as cand_tic_id from prim p left join cand c on cast(p.row_idx as double) = cast(c.tid as double)")
def join_stellar_id(spark, d):
    return joins.by_stellar_id(view(spark, d, "prim"), view(spark, d, "cand").select(F.col("tid").alias("tic_id")), "cand", "row_idx").select("row_idx", "cand_tic_id")


@query(_NAMES.format(how="left", left="pl_name", right="planet_name"))
def join_planet_name(spark, d):
    return joins.by_planet_name(view(spark, d, "prim"), view(spark, d, "cand"), "cand").select("row_idx", "cand_tid")


def _how(how: str):
    @query(f"select c_custkey, o_orderkey as o_o_orderkey from customer {how.replace('outer', 'full outer')} join orders on c_custkey = o_custkey", f"join_{how}")
    def run(spark, d):
        return joins.join_on(_table(spark, d, "customer"), _table(spark, d, "orders"), "o", lambda: F.col("c_custkey"), lambda: F.col("o_custkey"), how).select("c_custkey", "o_o_orderkey")


for _h in ("inner", "left", "right", "outer"):
    _how(_h)


@query("select o_orderkey, l_linenumber as l_l_linenumber, l_quantity as l_l_quantity from orders left join lineitem on o_orderkey = l_orderkey")
def join_fanout(spark, d):
    return joins.join_on(_table(spark, d, "orders"), _table(spark, d, "lineitem"), "l", lambda: F.col("o_orderkey"), lambda: F.col("l_orderkey")).select("o_orderkey", "l_l_linenumber", "l_l_quantity")


# the sphere

_HAVERSINE = "2 * asin(sqrt(least(1.0, power(sin((radians(s.decl) - radians(p.decl)) / 2), 2) + cos(radians(p.decl)) * cos(radians(s.decl)) * power(sin((radians(s.ra) - radians(p.ra)) / 2), 2))))"


@query("select src_idx, round(ra + pmra * 10.0 / 3.6e6 / cos(radians(decl)), 6) as ra_corrected, round(decl + pmdec * 10.0 / 3.6e6, 6) as decl_corrected from sec")
def pm_correction(spark, d):
    return sky.corrected(view(spark, d, "sec"), 10.0).select("src_idx", r("ra_corrected"), r("decl_corrected"))


@query(f"select row_idx, src_idx, round(sep, 6) as sep from (select row_idx, src_idx, {_HAVERSINE} as sep from prim p join sec s on abs(p.decl - s.decl) < 0.06) where sep <= 3.0 / 3600")
def angular_separation(spark, d):
    """The separation of every pair that the wide cone match considers."""
    return sky.within(view(spark, d, "prim"), view(spark, d, "sec"), 3.0, compat=True, left_id="row_idx", right_id="src_idx").select("row_idx", "src_idx", r("sep"))


def _cone(name: str, compat: bool, form: str):
    limit, scale = ("3.0 / 3600", "3600.0") if compat else ("radians(3.0 / 3600)", "3600.0 * 180.0 / pi()")
    sql = f"""select p.row_idx, m.src_idx as sec_src_idx, round(m.sep * {scale}, 6) as sec_match_separation_arcsec from prim p left join
     (select row_idx, src_idx, sep, row_number() over (partition by row_idx order by sep, src_idx) as k from (select row_idx, src_idx, {_HAVERSINE} as sep from prim p join sec s on abs(p.decl - s.decl) < 0.06) where sep <= {limit}) m on m.row_idx = p.row_idx and m.k = 1"""

    @query(sql, name)
    def run(spark, d):
        p = view(spark, d, "prim").withColumn("_row_idx", F.col("row_idx"))
        s = view(spark, d, "sec").withColumn("_src_idx", F.col("src_idx"))
        found = sky.cone_join(p, s, "sec", 3.0, compat=compat, form=form)
        return found.select("row_idx", "sec_src_idx", r("sec_match_separation_arcsec"))


_cone("cone_match_compat", True, "auto")
_cone("cone_match_strict", False, "auto")
_cone("cone_match_grid", False, "grid")
_cone("cone_match_grid_compat", True, "grid")

CATALOGS = (
    pipeline.Catalog("gaia", "gaia_source_id", "gaia_id", 1),
    pipeline.Catalog("toi_candidates", "exact_name", "pl_name", 2),
    pipeline.Catalog("sec", "multiple_identifiers", priority=3, arcsec=3.0, years=True),
)


def _sources(spark, d):
    sec = view(spark, d, "sec").withColumn("_src_idx", F.col("src_idx"))
    return {"gaia": view(spark, d, "gaia"), "toi_candidates": view(spark, d, "cand"), "sec": sec}


@query(rf"""select p.row_idx, g.gaia_dr2_source_id as gaia_gaia_dr2_source_id, c.tid as toi_candidates_tid, m.src_idx as sec_src_idx
 from prim p left join gaia g on {_ID} = g.gaia_dr2_source_id
 left join cand c on lower(trim(p.pl_name)) = lower(trim(c.planet_name))
 left join (select row_idx, src_idx, row_number() over (partition by row_idx order by sep, src_idx) as k from
   (select row_idx, src_idx, {_HAVERSINE} as sep from prim p join (select src_idx, ra + pmra / 3.6e6 / cos(radians(decl)) as ra, decl + pmdec / 3.6e6 as decl from sec) s on abs(p.decl - s.decl) < 0.06)
   where sep <= radians(3.0 / 3600)) m on m.row_idx = p.row_idx and m.k = 1""")
def multi_catalog_join(spark, d):
    p = view(spark, d, "prim").withColumn("_row_idx", F.col("row_idx"))
    return pipeline.join_all(p, _sources(spark, d), pipeline.Spec(CATALOGS)).select("row_idx", "gaia_gaia_dr2_source_id", "toi_candidates_tid", "sec_src_idx")


# distinct, union, difference


@query("select distinct l_returnflag, l_linestatus, l_quantity from lineitem")
def distinct_rows(spark, d):
    return _table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity").dropDuplicates()


@query("select l_orderkey, l_linenumber, l_quantity from (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_quantity) as k from lineitem) where k = 1")
def dedupe_first(spark, d):
    rows = _table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.struct("l_linenumber", "l_quantity").alias("place"))
    return missing.keep_first(rows, ["l_orderkey"], "place").drop("place")


@query("select o_orderkey, case when o_orderstatus = 'F' then 'filled' when o_orderpriority in ('1-URGENT', '2-HIGH') then 'urgent' else 'any' end as tier from orders")
def union_tiers(spark, d):
    """Filled orders, else urgent ones, else any: the tiers overlap, and together they hold every order."""
    o = _table(spark, d, "orders")
    parts = [o.filter(test).select("o_orderkey", F.lit(n).alias("tier")) for n, test in (("filled", "o_orderstatus = 'F'"), ("urgent", "o_orderpriority in ('1-URGENT', '2-HIGH')"), ("any", "true"))]
    return tiers.combine(parts, "o_orderkey")


@query("select c_custkey as target_id from customer where c_custkey not in (select o_custkey from orders)")
def anti_ids(spark, d):
    return tiers.unmatched(_table(spark, d, "customer").select(F.col("c_custkey").alias("target_id")), _table(spark, d, "orders"), "o_custkey")


# numbers of the older release's sources end in 0; the source after each second of them stands 0.3 or 0.7 arc seconds beside it, every third of these of unlike magnitude
_BASE = 4295076295112340000
_SKY = f"""(select gaia_dr2_source_id - {_BASE} as num, gaia_dr2_source_id, gaia_dr3_source_id, parallax, parallax_error, ruwe from gaia)"""


@query(f"""select gaia_dr2_source_id, gaia_dr3_source_id, data_source, match_quality, round(parallax - 0.017, 6) as parallax_corrected from (
 select o.gaia_dr2_source_id, case when one.num is not null then o.gaia_dr3_source_id else two.gaia_dr3_source_id end as gaia_dr3_source_id,
  case when one.num is not null then 'DR3_direct' when two.num is not null then 'DR3_crossmatch' else 'DR2_direct' end as data_source,
  case when one.num is not null then 1.0::double when two.num is not null then case when two.num % 40 = 1 then 0.8::double else 0.6::double end else 0.4::double end as match_quality,
  case when one.num is not null then one.parallax when two.num is not null then two.parallax else o.parallax end as parallax
 from {_SKY} o left join {_SKY} one on one.num = o.num and one.gaia_dr3_source_id is not null and one.parallax is not null
  left join {_SKY} two on o.gaia_dr3_source_id is null and o.num % 20 = 0 and two.num = o.num + 1 and two.num % 60 <> 1 and two.gaia_dr3_source_id is not null and two.parallax is not null
 where o.gaia_dr2_source_id in (select {_ID} from prim) and (one.num is not null or two.num is not null or (o.gaia_dr3_source_id is null and o.parallax > 0)))""")
def tier_cascade(spark, d):
    number = F.col("gaia_dr2_source_id") - _BASE
    beside = number % 20 == 1
    place = F.when(beside, number - 1).otherwise(number)
    at = {"ra": (place * 37 % 36000).cast("double") / 100, "dec": (place * 91 % 17800).cast("double") / 100 - 89 + F.when(beside, F.when(number % 40 == 1, 0.3).otherwise(0.7) / 3600).otherwise(0.0)}
    g = view(spark, d, "gaia").withColumns({"phot_g_mean_mag": F.when(number % 60 == 1, 14.0).otherwise(12.0), **at})
    newer = g.filter("gaia_dr3_source_id is not null").select(F.col("gaia_dr3_source_id").alias("source_id"), "ra", "dec", "parallax", "parallax_error", "ruwe", "phot_g_mean_mag")
    older = g.filter("gaia_dr3_source_id is null").select(F.col("gaia_dr2_source_id").alias("source_id"), "ra", "dec", "parallax", "parallax_error", "phot_g_mean_mag")
    return tiers.cascade(view(spark, d, "prim"), newer, older).select("gaia_dr2_source_id", "gaia_dr3_source_id", "data_source", "match_quality", r("parallax_corrected"))


@query(f"select distinct {_ID} as target_id from prim where gaia_id is not null")
def target_ids(spark, d):
    return tiers.targets(view(spark, d, "prim"))


# units and ranges


@query("select row_idx, round(pl_radj * 11.209, 6) as pl_rade, 'R_jup' as pl_rade_units, round(st_mass * 317.83, 6) as pl_masse, 'M_jup' as pl_masse_units from prim")
def units_jup_to_earth(spark, d):
    p = view(spark, d, "prim").drop("pl_rade", "pl_masse").withColumn("pl_massj", F.col("st_mass"))
    return units.standardize_units(p).select("row_idx", r("pl_rade"), "pl_rade_units", r("pl_masse"), "pl_masse_units")


@query("select row_idx, 'R_earth' as pl_rade_units, 'M_earth' as pl_masse_units, 'L_sun' as st_lum_units, 'K' as st_teff_units, 'AU' as pl_orbsmax_units, cast(null as varchar) as pl_orbeccen_units from prim")
def units_labels(spark, d):
    return units.standardize_units(view(spark, d, "prim")).select("row_idx", "pl_rade_units", "pl_masse_units", "st_lum_units", "st_teff_units", "pl_orbsmax_units", "pl_orbeccen_units")


@query("select row_idx, 'R_earth' as pl_rade_units, round(pl_radj * 11.209, 6) as pl_rade, 'M_earth' as pl_masse_units from prim")
def units_pipeline_labels(spark, d):
    return units.standardize_units(view(spark, d, "prim").drop("pl_rade"), "pipeline").select("row_idx", "pl_rade_units", r("pl_rade"), "pl_masse_units")


_EXTREME = "coalesce(pl_orbper > 1e5 and pl_orbsmax > 0 and st_mass > 0, false)"
_PERIOD = f"case when {_EXTREME} then sqrt(pl_orbsmax * pl_orbsmax * pl_orbsmax / st_mass) * 365.25 when pl_orbper > 0 then pl_orbper end"


@query("""select row_idx, not coalesce(pl_orbsmax > 0, true) as pl_orbsmax_flag_invalid, not coalesce(pl_orbeccen >= 0 and pl_orbeccen < 1, true) as pl_orbeccen_flag_invalid,
 not coalesce(pl_rade > 0, true) as pl_rade_flag_invalid, not coalesce(pl_masse > 0, true) as pl_masse_flag_invalid, case when pl_orbeccen >= 0 and pl_orbeccen < 1 then pl_orbeccen end as pl_orbeccen,
 case when pl_rade > 0 then pl_rade end as pl_rade from prim""")
def range_checks(spark, d):
    flags = [f"{c}_flag_invalid" for c in ("pl_orbsmax", "pl_orbeccen", "pl_rade", "pl_masse")]
    return units.range_checks(view(spark, d, "prim")).select("row_idx", *flags, "pl_orbeccen", "pl_rade")


@query(f"select row_idx, round({_PERIOD}, 6) as pl_orbper from prim where {_EXTREME}")
def kepler_fix(spark, d):
    return units.range_checks(view(spark, d, "prim")).filter("pl_orbper_corrected = 'kepler_third_law'").select("row_idx", r("pl_orbper"))


@query(f"""select row_idx, round(case when per <= 365.25e6 then per end, 6) as pl_orbper, bad or coalesce(per > 365.25e6, false) as pl_orbper_flag_invalid,
 case when per > 365.25e6 then 'capped_unphysical' when ext then 'kepler_third_law' else '' end as pl_orbper_corrected
 from (select row_idx, {_PERIOD} as per, {_EXTREME} as ext, not coalesce(pl_orbper > 0, true) as bad from prim)""")
def period_cap(spark, d):
    return units.range_checks(view(spark, d, "prim")).select("row_idx", r("pl_orbper"), "pl_orbper_flag_invalid", "pl_orbper_corrected")


# physics

_LUM = "case when st_lum > 0 then st_lum when st_lum <= 0 then power(10.0, st_lum) end"


def _flux(limit: str) -> str:
    from .functions.astro import HZ

    s0, a, b, c, e = HZ[limit]
    return f"({s0!r} + (st_teff - 5780.0) * ({a!r} + (st_teff - 5780.0) * ({b!r} + (st_teff - 5780.0) * ({c!r} + (st_teff - 5780.0) * {e!r}))))"


def _edge(limit: str) -> str:
    return f"case when {_flux(limit)} > 0 and {_LUM} > 0 then sqrt(({_LUM}) / {_flux(limit)}) end"


@query(f"select row_idx, round({_edge('RunawayGreenhouse')}, 6) as hz_inner, round({_edge('MaximumGreenhouse')}, 6) as hz_outer from prim")
def hz_edges_cons(spark, d):
    return physics.add_hz_edges(view(spark, d, "prim")).select("row_idx", r("hz_inner"), r("hz_outer"))


@query(f"select row_idx, round({_edge('RecentVenus')}, 6) as hz_opt_inner, round({_edge('EarlyMars')}, 6) as hz_opt_outer from prim")
def hz_edges_opt(spark, d):
    return physics.add_hz_edges(view(spark, d, "prim"), optimistic=True).select("row_idx", r("hz_opt_inner"), r("hz_opt_outer"))


@query(f"""select l_orderkey, l_linenumber, round({_edge('RunawayGreenhouse')}, 6) as hz_inner, round({_edge('MaximumGreenhouse')}, 6) as hz_outer
 from (select l_orderkey, l_linenumber, 2600.0 + l_quantity * 80 as st_teff, l_discount * 10 - 0.5 as st_lum from lineitem)""")
def hz_edges_lineitem(spark, d):
    rows = _table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (2600.0 + F.col("l_quantity") * 80).alias("st_teff"), (F.col("l_discount") * 10 - 0.5).alias("st_lum"))
    return physics.add_hz_edges(rows).select("l_orderkey", "l_linenumber", r("hz_inner"), r("hz_outer"))


@query(f"""select row_idx, round((pl_orbsmax - ci) / (co - ci), 6) as hz_position_conservative, round((pl_orbsmax - oi) / (oo - oi), 6) as hz_position_optimistic
 from (select row_idx, pl_orbsmax, {_edge('RunawayGreenhouse')} as ci, {_edge('MaximumGreenhouse')} as co, {_edge('RecentVenus')} as oi, {_edge('EarlyMars')} as oo from prim)""")
def hz_position(spark, d):
    return physics.add_hz_position(physics.add_hz_edges(physics.add_hz_edges(view(spark, d, "prim")), optimistic=True)).select("row_idx", r("hz_position_conservative"), r("hz_position_optimistic"))


@query(f"""select row_idx, pl_name, round(pl_orbsmax, 6) as pl_orbsmax from (select *, {_edge('RunawayGreenhouse')} as ci, {_edge('MaximumGreenhouse')} as co from prim) where pl_orbsmax between ci and co""")
def habitable_planets(spark, d):
    edges = physics.add_hz_edges(view(spark, d, "prim"))
    return edges.filter(F.col("pl_orbsmax").between(F.col("hz_inner"), F.col("hz_outer"))).select("row_idx", "pl_name", r("pl_orbsmax"))


@query(f"select row_idx, round(case when pl_orbsmax <> 0 then ({_LUM}) / (pl_orbsmax * pl_orbsmax) end, 6) as stellar_flux_s from prim")
def stellar_flux(spark, d):
    return physics.add_stellar_flux(view(spark, d, "prim")).select("row_idx", r("stellar_flux_s"))


_TEQ = "case when pl_orbsmax <> 0 then st_teff * sqrt(st_rad / (2.0 * pl_orbsmax)) * power(0.7, 0.25) end"
_GRAV = "case when pl_rade <> 0 then 6.67430e-11 * pl_masse * 5.972e24 / (pl_rade * 6.371e6 * (pl_rade * 6.371e6)) end"
_VESC = "case when pl_rade > 0 then sqrt(2 * 6.67430e-11 * pl_masse * 5.972e24 / (pl_rade * 6.371e6)) / 1000.0 end"


@query(f"select row_idx, round(case when t between 0 and 20000 then t end, 6) as equilibrium_temperature from (select row_idx, {_TEQ} as t from prim)")
def eq_temperature(spark, d):
    return physics.add_equilibrium_temperature(view(spark, d, "prim")).select("row_idx", r("equilibrium_temperature"))


@query(f"select row_idx, round(case when g between 0 and 2000 then g end, 6) as surface_gravity from (select row_idx, {_GRAV} as g from prim)")
def surface_gravity(spark, d):
    return physics.add_surface_gravity(view(spark, d, "prim")).select("row_idx", r("surface_gravity"))


@query(f"select row_idx, round(case when v <= 100 then v end, 6) as escape_velocity from (select row_idx, {_VESC} as v from prim)")
def escape_velocity(spark, d):
    return physics.add_escape_velocity(view(spark, d, "prim")).select("row_idx", r("escape_velocity"))


@query("""select gaia_dr2_source_id, round(case when distance_gspphot is not null then distance_gspphot when parallax - 0.017 > 0 then 1000.0 / (parallax - 0.017) end, 6) as distance_pc,
 case when distance_gspphot is not null then 'geometric' when parallax - 0.017 > 0 then 'inv_parallax' end as distance_provenance, 'pc' as distance_units from gaia""")
def distance_pc(spark, d):
    return physics.add_distance(view(spark, d, "gaia"), zero_point=True).select("gaia_dr2_source_id", r("distance_pc"), "distance_provenance", "distance_units")


_MC = {"stellar_flux_s": f"case when pl_orbsmax > 0 then ({_LUM}) / (pl_orbsmax * pl_orbsmax) end", "equilibrium_temperature": "case when pl_orbsmax > 0 then st_teff * sqrt(st_rad / (2.0 * pl_orbsmax)) * power(0.7, 0.25) end", "surface_gravity": "case when pl_rade > 0 and pl_masse > 0 then 6.67430e-11 * pl_masse * 5.972e24 / (pl_rade * 6.371e6 * (pl_rade * 6.371e6)) end", "escape_velocity": "case when pl_rade > 0 and pl_masse > 0 then sqrt(2 * 6.67430e-11 * pl_masse * 5.972e24 / (pl_rade * 6.371e6)) / 1000.0 end"}


@query("select row_idx, " + ", ".join(f"round({v}, 4) as {k}_{s}" if s != "std" else f"case when ({v}) is not null then 0.0::double end as {k}_std" for k, v in _MC.items() for s in montecarlo.STATS) + " from prim")
def mc_sigma0(spark, d):
    out = montecarlo.monte_carlo(view(spark, d, "prim"), with_errors=False)
    return out.select("row_idx", *((F.round(F.col(n), 4) + F.lit(0.0)).alias(n) for n in montecarlo.NAMES))


@query()
def mc_sigma(spark, d):
    return montecarlo.monte_carlo(view(spark, d, "prim")).select("row_idx", *montecarlo.NAMES)


#: The relative spread of each metric where only the temperature has errors.
_SPREAD = {"stellar_flux_s": "0", "equilibrium_temperature": "(abs(st_tefferr1) + coalesce(abs(st_tefferr2), abs(st_tefferr1))) / 2 / st_teff", "surface_gravity": "0", "escape_velocity": "0"}


@query("select row_idx, " + ", ".join(f"case when ({v}) is not null then true end as {k}" for k, v in _MC.items()) + " from prim")
def mc_sigma_bounds(spark, d):
    """Where a metric has a value, its median lies within a tenth of the spread (a millionth of the value, at least) of what no errors would give, its spread within a tenth of the
    expected one, and its quantiles are in order; SQL tells where there's a value."""
    known = {k: F.expr(v.replace("::double", "")) for k, v in _MC.items()}
    out = view(spark, d, "prim").withColumns({f"_{k}": v for k, v in known.items()} | {f"_{k}_spread": F.abs(known[k]) * F.expr(v) for k, v in _SPREAD.items()})
    out = montecarlo.monte_carlo(out)

    def bounded(k: str):
        centre, spread, slack = F.col(f"_{k}"), F.col(f"_{k}_spread"), F.abs(F.col(f"_{k}")) * 1e-6
        near = (F.abs(F.col(f"{k}_median") - centre) <= 0.1 * spread + slack) & (F.abs(F.col(f"{k}_std") - spread) <= 0.1 * spread + slack)
        return near & (F.col(f"{k}_q16") <= F.col(f"{k}_median")) & (F.col(f"{k}_median") <= F.col(f"{k}_q84")) & (F.abs(F.col(f"{k}_mean") - centre) <= 0.1 * spread + slack)

    return out.select("row_idx", *(bounded(k).alias(k) for k in _MC))


# quality, missingness


@query("select row_idx, round(((pl_rade is not null)::int + (pl_masse is not null)::int + (pl_orbsmax is not null)::int + (st_teff is not null)::int + (st_lum is not null)::int + (st_mass is not null)::int) / 6.0::double, 6) as data_completeness_score from prim")
def completeness(spark, d):
    return quality.add_completeness(view(spark, d, "prim")).select("row_idx", r("data_completeness_score"))


@query("select gaia_dr2_source_id, case when ruwe <= 1.4 then 'good' when ruwe <= 2.0 then 'suspect' when ruwe is not null then 'poor' end as astrometry_quality_flag from gaia")
def ruwe_class(spark, d):
    return quality.add_ruwe_class(view(spark, d, "gaia")).select("gaia_dr2_source_id", "astrometry_quality_flag")


_SCORE = "greatest(0.0, least(1.0, 1.0 - 0.3 * least(1.0, angular_separation * angular_separation) - 0.2 * coalesce(case when ruwe > 1.4 then least(1.0, ruwe - 1.4) end, 0.0)))"


@query(f"""select gaia_dr2_source_id, case when gaia_dr3_source_id is null then 'unmatched_dr2_only' when ambiguity_flag then 'neighbourhood_tie' when crossmatch_method like '%cone%' then 'pm_cone' else 'best_neighbour' end as crossmatch_quality,
 round({_SCORE}, 6) as crossmatch_score from gaia""")
def crossmatch_quality(spark, d):
    return quality.add_crossmatch_quality(view(spark, d, "gaia")).select("gaia_dr2_source_id", "crossmatch_quality", r("crossmatch_score"))


@query("""select gaia_dr2_source_id as x_gaia_dr2_source_id, 'unmatched_dr2_only' as crossmatch_quality, 1.0::double as crossmatch_score from gaia""")
def crossmatch_quality_compat(spark, d):
    return quality.add_crossmatch_quality(columns.prefixed(view(spark, d, "gaia"), "x"), compat=True).select("x_gaia_dr2_source_id", "crossmatch_quality", r("crossmatch_score"))


@query("""select gaia_dr2_source_id, round(case when parallax_error <> 0 then parallax / parallax_error end, 10) as parallax_snr,
 case when parallax is null or parallax_error = 0 then 'unknown' when parallax / parallax_error > 5.0 then 'good' else 'poor' end as parallax_quality,
 case when ruwe is null then 'unknown' when ruwe < 1.4 then 'good' else 'poor' end as astrometry_quality from gaia""")
def parallax_snr(spark, d):
    return quality.add_gaia_flags(view(spark, d, "gaia")).select("gaia_dr2_source_id", F.round("parallax_snr", 10).alias("parallax_snr"), "parallax_quality", "astrometry_quality")


@query("""select tid, tfopwg_disp is not null as tess_candidate_flag, tfopwg_disp as tess_disposition, case when tfopwg_disp in ('PC', 'CP') then 'high' when tfopwg_disp = 'APC' then 'medium' when tfopwg_disp is not null then 'low' else 'none' end as tess_candidate_confidence,
 coalesce(koi_disposition = 'CANDIDATE', false) as kepler_candidate_flag, (koi_fpflag_nt is not null)::int + (koi_fpflag_ss is not null)::int as kepler_fp_flag_count from cand""")
def candidate_flags(spark, d):
    df = quality.add_candidate_flags(quality.add_candidate_flags(view(spark, d, "cand"), "toi", prefix=""), "koi", prefix="")
    return df.select("tid", "tess_candidate_flag", "tess_disposition", "tess_candidate_confidence", "kepler_candidate_flag", "kepler_fp_flag_count")


@query("""select gaia_dr2_source_id, round(coalesce(1.0 / (1.0 + (ruwe - 1.0) * (ruwe - 1.0)), 1.0) * case when parallax is not null and parallax_error > 0 then greatest(0.0, least(1.0, parallax / parallax_error / 10.0)) else 1.0 end, 6) as overall_quality_score from gaia""")
def gaia_score(spark, d):
    return quality.add_gaia_score(view(spark, d, "gaia")).select("gaia_dr2_source_id", r("overall_quality_score"))


@query("""select row_idx, st_teff is null and st_lum is null and st_mass is null and st_rad is null as missing_pattern_missing_stellar_params, pl_masse is null as missing_pattern_missing_planetary_mass,
 pl_rade is null and pl_radj is null as missing_pattern_missing_planetary_radius, pl_orbsmax is null and pl_orbper is null and pl_orbeccen is null as missing_pattern_missing_orbital_params, true as missing_pattern_missing_candidate_info from prim""")
def missing_patterns(spark, d):
    return missing.add_missing_patterns(view(spark, d, "prim")).select("row_idx", *(f"missing_pattern_{n}" for n in missing.PATTERNS))


@query("select row_idx, st_lum is null as st_lum_missing, st_mass is null as st_mass_missing, pl_masse is null as pl_masse_missing, pl_rade is null as pl_rade_missing, pl_orbsmax is null as pl_orbsmax_missing from prim")
def missing_indicators(spark, d):
    return missing.add_missing_indicators(view(spark, d, "prim")).select("row_idx", *(f"{c}_missing" for c in ("st_lum", "st_mass", "pl_masse", "pl_rade", "pl_orbsmax")))


@query(f"select row_idx, false as nasa_source, false as phl_source, g.gaia_dr2_source_id is not null as gaia_source, false as sweet_source from prim left join gaia g on {_ID} = g.gaia_dr2_source_id")
def provenance_flags(spark, d):
    joined = joins.by_id(view(spark, d, "prim"), view(spark, d, "gaia"), "gaia_dr3_astrophysical_parameters")
    return missing.add_provenance(joined).select("row_idx", *missing.SOURCES)


@query(f"""select min(row_idx) as row_idx, star_id, planet_id from (select row_idx, cast(coalesce(g.gaia_dr3_source_id, g.gaia_dr2_source_id) as varchar) as star_id, lower(trim(hostname)) as planet_id
 from prim left join gaia g on {_ID} = g.gaia_dr2_source_id) group by star_id, planet_id""")
def canonical_ids(spark, d):
    p = view(spark, d, "prim").withColumn("pl_name", F.col("hostname"))
    return missing.add_canonical_ids(joins.by_id(p, view(spark, d, "gaia"), "g"), "row_idx").select("row_idx", "star_id", "planet_id")


def _impute(strategy: str, statistic: str):
    names = ("st_lum", "st_mass", "pl_orbsmax")
    sql = "select row_idx, " + ", ".join(f"round(coalesce({c}, {statistic.format(c)}), 6) as {c}" for c in names) + " from prim"

    @query(sql, f"impute_{strategy}")
    def run(spark, d):
        return missing.impute(view(spark, d, "prim"), strategy).select("row_idx", *(r(c) for c in names))


_impute("mean", "(select avg({0}) from prim)")
_impute("median", "(select median({0}) from prim)")
_impute("mode", "(select {0} from prim where {0} is not null group by {0} order by count(*) desc, {0} limit 1)")


@query("select gaia_dr2_source_id, gaia_dr3_source_id, round(parallax, 6) as parallax, round(ruwe, 6) as ruwe from gaia where gaia_dr3_source_id is not null and parallax is not null and ruwe is not null")
def drop_sparse(spark, d):
    return missing.drop_sparse(view(spark, d, "gaia")).select("gaia_dr2_source_id", "gaia_dr3_source_id", r("parallax"), r("ruwe"))


_NARROWED = {c: f"(select case when min({c}) >= -128 and max({c}) < 128 then 'tinyint' when min({c}) >= -32768 and max({c}) < 32768 then 'smallint' when min({c}) >= -2147483648 and max({c}) < 2147483648 then 'int' else 'bigint' end from lineitem)" for c in ("l_orderkey", "l_partkey", "l_suppkey")} | {
    c: f"(select case when bool_and(({c}::float)::double = {c}) then 'float' else 'double' end from lineitem)" for c in ("l_quantity", "l_extendedprice", "l_discount")}


@query("select l_linenumber, " + ", ".join(f"{c}{'::bigint' if c.endswith('key') else '::double'} as {c}, {t} as type_of_{c}" for c, t in _NARROWED.items()) + " from lineitem")
def downcast(spark, d):
    """Values and the type that each column was narrowed to."""
    narrow = missing.narrow_types(_table(spark, d, "lineitem").select("l_linenumber", *(F.col(c).cast("bigint" if c.endswith("key") else "double").alias(c) for c in _NARROWED)))
    kinds = dict(narrow.dtypes)
    return narrow.select(F.col("l_linenumber").cast(_table(spark, d, "lineitem").schema["l_linenumber"].dataType).alias("l_linenumber"), *(x for c in _NARROWED for x in (F.col(c).cast("bigint" if c.endswith("key") else "double").alias(c), F.lit(kinds[c]).alias(f"type_of_{c}"))))


@query(f"""select row_idx, round((((pl_rade is not null)::int + (pl_masse is not null)::int + (pl_orbsmax is not null)::int + (st_teff is not null)::int + (st_lum is not null)::int + (st_mass is not null)::int) / 6.0::double
 + coalesce((g.ruwe < 1.4)::int, 0) + coalesce((g.parallax_error <> 0 and g.parallax / nullif(g.parallax_error, 0) > 5.0)::int, 0)) / 3, 6) as overall_quality_score from prim left join gaia g on {_ID} = g.gaia_dr2_source_id""")
def overall_quality(spark, d):
    flagged = quality.add_gaia_flags(joins.by_id(view(spark, d, "prim"), view(spark, d, "gaia"), "gaia"), "gaia")
    return quality.add_overall_quality(quality.add_completeness(flagged)).select("row_idx", r("overall_quality_score"))


@query("select row_idx, true as has_st_data, true as has_pl_data, gaia_id is not null as has_gaia_data from prim")
def prefix_provenance(spark, d):
    return missing.add_prefix_provenance(view(spark, d, "prim")).select("row_idx", "has_st_data", "has_pl_data", "has_gaia_data")


@query("""select row_idx, round(case when st_tefferr2 is null then st_tefferr1 else (st_tefferr1 + abs(st_tefferr2)) / 2 end, 6) as sigma_mc,
 round(case when st_tefferr2 is not null then (st_tefferr1 + abs(st_tefferr2)) / 2 else st_tefferr1 end, 6) as err_measurement, round(abs(st_tefferr2) / 2, 6) as lower_only from prim""")
def error_rules(spark, d):
    one, two, null = F.col("st_tefferr1"), F.col("st_tefferr2"), F.lit(None).cast("double")
    return view(spark, d, "prim").select("row_idx", r(montecarlo.sigma(one, two), "sigma_mc"), r(normalize.err_measurement(one, two), "err_measurement"), r(normalize.err_measurement(null, two), "lower_only"))


# entity tables

_FIRST = "(select *, row_number() over (partition by {key} order by _row_idx) as k from wide)"


@query(f"select star_id, st_teff, st_tefferr1, st_tefferr2, st_lum, gaia_dr2_source_id, gaia_dr3_source_id, ruwe from {_FIRST.format(key='star_id')} where k = 1")
def tbl_stars(spark, d):
    return normalize.stars(view(spark, d, "wide"))


@query(f"select pl_name, pl_rade, pl_masse, star_id, planet_id from {_FIRST.format(key='planet_id')} where k = 1")
def tbl_planets(spark, d):
    return normalize.planets(view(spark, d, "wide"))


@query("select planet_id, toi_candidates_tfopwg_disp, toi_candidates_tid from (select *, row_number() over (partition by planet_id order by _row_idx) as k from wide where toi_candidates_tfopwg_disp is not null or toi_candidates_tid is not null) where k = 1")
def tbl_candidates(spark, d):
    return normalize.candidates(view(spark, d, "wide"), "toi")


_STAR_ALIASES = """select star_id, 'GAIA_DR2' as alias_type, cast(gaia_dr2_source_id as varchar) as alias_value, _row_idx, 0 as k from wide where gaia_dr2_source_id is not null
 union all select star_id, 'GAIA_DR3', cast(gaia_dr3_source_id as varchar), _row_idx, 1 from wide where gaia_dr3_source_id is not null
 union all select star_id, 'TIC', cast(tic_id as varchar), _row_idx, 2 from wide where tic_id is not null
 union all select star_id, 'TOI', cast(toi_candidates_tid as varchar), _row_idx, 3 from wide where toi_candidates_tid is not null"""
_PLANET_ALIASES = """select planet_id, 'PLANET_NAME' as alias_type, lower(trim(pl_name)) as alias_value, _row_idx, 0 as k from wide where pl_name is not null
 union all select planet_id, 'TIC', cast(tic_id as varchar), _row_idx, 1 from wide where tic_id is not null
 union all select planet_id, 'TOI_CANDIDATES_TFOPWG_DISP', lower(toi_candidates_tfopwg_disp), _row_idx, 2 from wide where toi_candidates_tfopwg_disp is not null
 union all select planet_id, 'TOI', cast(toi_candidates_tid as varchar), _row_idx, 3 from wide where toi_candidates_tid is not null"""


@query(f"select distinct star_id, alias_type, alias_value from ({_STAR_ALIASES})")
def tbl_star_aliases(spark, d):
    return normalize.star_aliases(view(spark, d, "wide"))


@query(f"select distinct planet_id, alias_type, alias_value from ({_PLANET_ALIASES})")
def tbl_planet_aliases(spark, d):
    return normalize.planet_aliases(view(spark, d, "wide"))


def _edges(aliases: str, key: str) -> str:
    first = f"(select {key}, alias_type, alias_value, min(_row_idx * 10 + k) as o from ({aliases}) where {key} is not null group by all)"
    return f"select a.alias_type as src_catalog, a.alias_value as src_id, b.alias_type as dst_catalog, b.alias_value as dst_id from {first} a join {first} b on a.{key} = b.{key} and a.o < b.o"


@query(f"select distinct * from ({_edges(_STAR_ALIASES, 'star_id')} union all {_edges(_PLANET_ALIASES, 'planet_id')})")
def tbl_edges(spark, d):
    w = view(spark, d, "wide")
    return normalize.edges([(normalize.star_aliases(w, with_order=True), "star_id"), (normalize.planet_aliases(w, with_order=True), "planet_id")])


def _measure(c: str, kind: str) -> str:
    unit = {"st_teff": "K", "st_tefferr1": "K", "st_tefferr2": "K", "st_lum": "L_sun", "pl_rade": "R_earth", "pl_masse": "M_earth"}[c]
    err = "case when st_tefferr2 is not null then (coalesce(abs(st_tefferr1), 0) + abs(st_tefferr2)) / 2 else abs(st_tefferr1) end" if c == "st_teff" else "cast(null as double)"
    method = "'spectroscopy'" if kind == "star" else "case when tran_flag = 1 then 'transit' else 'radial_velocity' end"
    return f"select {kind}_id as object_id, '{kind}' as object_type, '{c}' as name, cast({c} as double) as value, {err} as err, '{unit}' as units, '{normalize.DEFAULT_SOURCE}' as source, {method} as method, _row_idx from wide where {c} is not null"


@query("select object_id, object_type, name, round(value, 6) as value, round(err, 6) as err, units, source, method, concat(source, ':', method) as provenance from (select *, row_number() over (partition by object_id, object_type, name, value, units order by _row_idx) as k from ("
       + " union all ".join(_measure(c, "star" if c[:3] == "st_" else "planet") for c in ("st_teff", "st_tefferr1", "st_tefferr2", "st_lum", "pl_rade", "pl_masse")) + ")) where k = 1")
def tbl_measurements(spark, d):
    m = normalize.measurements(view(spark, d, "wide"))
    return m.select("object_id", "object_type", "name", r("value"), r("err"), "units", "source", "method", "provenance")


@query(f"""select planet_id as object_id, name, round(value, 6) as value, 'dimensionless' as units, 0.3::double as albedo_assumption, 'st_teff,st_lum,pl_orbsmax' as inputs from
 (select lower(trim(pl_name)) as planet_id, 'hz_position_conservative' as name, (pl_orbsmax - ci) / (co - ci) as value from (select *, {_edge('RunawayGreenhouse')} as ci, {_edge('MaximumGreenhouse')} as co from prim)
  union all select lower(trim(pl_name)), 'hz_position_optimistic', (pl_orbsmax - oi) / (oo - oi) from (select *, {_edge('RecentVenus')} as oi, {_edge('EarlyMars')} as oo from prim)) where value is not null""")
def tbl_derived(spark, d):
    df = physics.add_hz_position(physics.add_hz_edges(physics.add_hz_edges(view(spark, d, "prim")), optimistic=True)).withColumn("planet_id", text.norm_name("pl_name"))
    return normalize.derived_features(df).select("object_id", "name", r("value"), "units", "albedo_assumption", "inputs")


# profiles

_NUMERIC = ("o_orderkey", "o_custkey", "o_totalprice")


@query(" union all ".join(f"select '{c}' as \"column\", count(*) as n_rows, count(*) - count({c}) as n_null, round((count(*) - count({c})) * 100.0::double / count(*), 6) as null_pct, count(distinct {c}) as n_distinct from cand" for c in ("tid", "planet_name", "tfopwg_disp", "koi_disposition", "koi_fpflag_nt")))
def profile_columns(spark, d):
    return profile.profile_columns(view(spark, d, "cand").select("tid", "planet_name", "tfopwg_disp", "koi_disposition", "koi_fpflag_nt")).select("column", "n_rows", "n_null", r("null_pct"), "n_distinct")


@query("select 'tfopwg_disp' as \"column\", tfopwg_disp as value, count(*) as n from cand group by all union all select 'koi_disposition', koi_disposition, count(*) from cand group by all")
def value_counts(spark, d):
    return profile.value_counts(view(spark, d, "cand").select("planet_name", "tfopwg_disp", "koi_disposition"))


@query(" union all ".join(f"select '{c}' as \"column\", count({c}) as n, round(avg({c}::double), 4) as mean, round(stddev_samp({c}::double), 4) as std, min({c})::double as min, round(quantile_cont({c}::double, 0.25), 6) as q25, round(quantile_cont({c}::double, 0.5), 6) as q50, round(quantile_cont({c}::double, 0.75), 6) as q75, max({c})::double as max from orders" for c in _NUMERIC))
def describe(spark, d):
    out = profile.describe(_table(spark, d, "orders"), _NUMERIC)
    return out.select("column", "n", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"), "min", r("q25"), r("q50"), r("q75"), "max")


@query("select sum(n - 1)::bigint as n_duplicates from (select count(*) as n from lineitem group by l_returnflag, l_linestatus, l_quantity)")
def duplicate_rows(spark, d):
    return profile.duplicate_rows(_table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity"))


@query("""select 'total_records' as name, count(*)::double as value from wide union all select 'unique_stars', count(distinct star_id)::double from wide union all select 'unique_planets', count(distinct planet_id)::double from wide
 union all select 'missing_pl_rade', round(avg((pl_rade is null)::int), 6) from wide union all select 'missing_pl_masse', round(avg((pl_masse is null)::int), 6) from wide
 union all select 'missing_st_teff', round(avg((st_teff is null)::int), 6) from wide union all select 'missing_st_lum', round(avg((st_lum is null)::int), 6) from wide""")
def pipeline_stats(spark, d):
    return profile.pipeline_statistics(view(spark, d, "wide")).select("name", r("value"))


@query("select ruwe_class as value, count(*) as n from (select case when ruwe <= 1.4 then 'good' when ruwe <= 2.0 then 'suspect' when ruwe is not null then 'poor' end as ruwe_class from gaia) group by 1")
def category_counts(spark, d):
    return profile.category_counts(quality.add_ruwe_class(view(spark, d, "gaia")), "astrometry_quality_flag")


@query("""select 'completeness' as "check", pct < 50 as passed, round(pct, 6) as value from (select sum((gaia_dr3_source_id is null)::int + (parallax is null)::int + (ruwe is null)::int + (distance_gspphot is null)::int) * 100.0::double / (count(*) * 9) as pct from gaia)
 union all select 'data_types', true, 7.0::double union all select 'hz_columns', false, 0.0::double""")
def validate_completeness(spark, d):
    return profile.validate(view(spark, d, "gaia")).select("check", "passed", r("value"))


@query(f"""select row_idx, g.gaia_dr2_source_id as gaia_gaia_dr2_source_id, h.src_name as sweet_src_name, true as has_gaia_data, h.src_name is not null as has_sweet_data,
 case when g.parallax is null or g.parallax_error = 0 then 'unknown' when g.parallax / g.parallax_error > 5.0 then 'good' else 'poor' end as gaia_parallax_quality,
 round(((pl_rade is not null)::int + (pl_masse is not null)::int + (pl_orbsmax is not null)::int + (st_teff is not null)::int + (st_lum is not null)::int + (st_mass is not null)::int) / 6.0::double, 6) as data_completeness_score
 from prim p left join gaia g on {_ID} = g.gaia_dr2_source_id left join (select concat('host ', src_idx) as host, src_name from sec) h on lower(trim(p.hostname)) = h.host""")
def catalog_merge(spark, d):
    """Provenance follows the first word of a column's name, so the primary's gaia_id and the quality flags count as data of gaia."""
    stars = view(spark, d, "sec").select(F.concat(F.lit("host "), "src_idx").alias("hostname"), "src_name")
    merged = pipeline.catalog_merge({"nasa_exoplanet": view(spark, d, "prim"), "gaia": view(spark, d, "gaia"), "sweet": stars}, primary="nasa_exoplanet")
    return merged.select("row_idx", "gaia_gaia_dr2_source_id", "sweet_src_name", "has_gaia_data", "has_sweet_data", "gaia_parallax_quality", r("data_completeness_score"))


@query(f"""select row_idx, g.gaia_dr2_source_id as gaia_gaia_dr2_source_id, m.src_idx as toi_candidates_src_idx, coalesce(m.src_idx % 4 in (0, 1, 2), false) as tess_candidate_flag,
 case m.src_idx % 4 when 0 then 'high' when 1 then 'medium' when 2 then 'low' else 'none' end as tess_candidate_confidence
 from prim p left join gaia g on {_ID} = g.gaia_dr2_source_id
 left join (select row_idx as r, src_idx, row_number() over (partition by row_idx order by sep, src_idx) as k from (select row_idx, src_idx, {_HAVERSINE} as sep from prim p join sec s on abs(p.decl - s.decl) < 0.06) where sep <= radians(3.0 / 3600)) m on m.r = p.row_idx and m.k = 1""")
def catalog_merge_chosen(spark, d):
    """The primary is chosen by the catalogs' names; candidates are matched by position and bring their flags."""
    disposition = F.when(F.col("src_idx") % 4 == 0, "PC").when(F.col("src_idx") % 4 == 1, "APC").when(F.col("src_idx") % 4 == 2, "FP")
    found = view(spark, d, "sec").withColumn("tfopwg_disp", disposition).withColumn("_src_idx", F.col("src_idx"))
    merged = pipeline.catalog_merge({"gaia": view(spark, d, "gaia"), "toi_candidates": found, "nasa_exoplanet": view(spark, d, "prim")})
    return merged.select("row_idx", "gaia_gaia_dr2_source_id", "toi_candidates_src_idx", "tess_candidate_flag", "tess_candidate_confidence")


@query("""select 'output_rows' as name, count(*)::double as value from (select distinct * from (select c_custkey, o_orderkey from customer left join orders on c_custkey = o_custkey))
 union all select 'total_input_rows', ((select count(*) from customer) + (select count(*) from orders))::double
 union all select 'merge_efficiency', round((select count(*) from (select distinct c_custkey, o_orderkey from customer left join orders on c_custkey = o_custkey)) / ((select count(*) from customer) + (select count(*) from orders))::double, 6)""")
def merge_statistics(spark, d):
    """What a written merge tells of itself."""
    sources = {"customer": _table(spark, d, "customer").select("c_custkey"), "orders": _table(spark, d, "orders").select("o_orderkey", "o_custkey")}
    join = lambda s: joins.join_on(s["customer"], s["orders"], "o", lambda: F.col("c_custkey"), lambda: F.col("o_custkey"))
    told = merge.run_merge(sources, join, _scratch(spark, "merged"))
    if not told.success:
        raise RuntimeError(told.error)
    rows = [(k, float(told.statistics[k])) for k in ("output_rows", "total_input_rows", "merge_efficiency")]
    return spark.createDataFrame(rows, "name string, value double").select("name", r("value"))


@query("select s_suppkey, s_name from supplier")
def scan_landed(spark, d):
    """A landed CSV is ingested to Parquet, and read as whatever is there, with the listed columns that exist."""
    folder = _scratch(spark, "landed")
    path = scan.export(_table(spark, d, "supplier").select("s_suppkey", "s_name"), f"{folder}/s", "raw", ["csv"])["csv"]
    scan.ingest(spark, path, f"{folder}/s/s.parquet")
    kept = scan.scan_any(spark, folder, "s", ["s_suppkey", "s_name", "absent"], required=True)
    schema = _table(spark, d, "supplier").schema
    return kept.select(*(F.col(c).cast(schema[c].dataType).alias(c) for c in kept.columns))


@query("select s_suppkey, s_name from supplier")
def stage_roundtrip(spark, d):
    """Tables written to two stages; the newest of the last one is read, and exported."""
    folder, table = _scratch(spark, "interim"), _table(spark, d, "supplier").select("s_suppkey", "s_name")
    scan.write_stage(table.limit(0), folder, scan.STAGES[0], "t")
    scan.write_stage(table, folder, scan.STAGES[1], "t")
    return spark.read.parquet(scan.export(spark.read.parquet(scan.latest_stage(spark, folder)), f"{folder}/out", "t", ["parquet"])["parquet"])


@query(f"""select row_idx, round(hz_inner, 6) as hz_inner, round(case when t between 0 and 20000 then t end, 6) as equilibrium_temperature,
 round(((pl_rade is not null)::int + (pl_masse is not null)::int + (pl_orbsmax is not null)::int + (st_teff is not null)::int + (st_lum is not null)::int + (st_mass is not null)::int) / 6.0::double, 6) as data_completeness_score
 from (select *, {_edge('RunawayGreenhouse')} as hz_inner, {_TEQ} as t from prim)""")
def stream_enriched(spark, d):
    """Planets as a stream of files, enriched, and written until all files are read."""
    folder = _scratch(spark, "stream")
    view(spark, d, "prim").write.parquet(f"{folder}/in")
    rows = spark.read.parquet(f"{folder}/in")
    stream = enrich.enrich_stream(enrich.landed(spark, f"{folder}/in", rows.schema))
    stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out").select("row_idx", r("hz_inner"), r("equilibrium_temperature"), r("data_completeness_score"))


_CHECKED = """(select row_idx, lower(trim(pl_name)) as planet_id, gaia_id, st_teff, st_lum, st_mass, st_rad, case when pl_orbsmax > 0 then pl_orbsmax end as pl_orbsmax,
 case when pl_rade > 0 then pl_rade end as pl_rade, case when pl_masse > 0 then pl_masse end as pl_masse from prim)"""
_PARALLAX = "g.parallax - 0.017"


_VALUES = f"""select p.row_idx, cast(coalesce(g.gaia_dr3_source_id, g.gaia_dr2_source_id) as varchar) as star_id, planet_id, round(pl_rade, 6) as pl_rade, round(pl_masse, 6) as pl_masse, round(pl_orbsmax, 6) as pl_orbsmax,
 round({_edge('RunawayGreenhouse')}, 6) as hz_inner, round({_edge('EarlyMars')}, 6) as hz_opt_outer, round(case when {_TEQ} between 0 and 20000 then {_TEQ} end, 6) as equilibrium_temperature,
 round(((pl_rade is not null)::int + (pl_masse is not null)::int + (pl_orbsmax is not null)::int + (st_teff is not null)::int + (st_lum is not null)::int + (st_mass is not null)::int) / 6.0::double, 6) as data_completeness_score,
 pl_rade is null as pl_rade_missing, round(case when g.distance_gspphot is not null then g.distance_gspphot when {_PARALLAX} > 0 then 1000.0 / ({_PARALLAX}) end, 6) as distance_pc, m.src_idx as sec_src_idx
 from {_CHECKED} p left join gaia g on {_ID} = g.gaia_dr2_source_id
 left join (select row_idx, src_idx, row_number() over (partition by row_idx order by sep, src_idx) as k from
   (select row_idx, src_idx, {_HAVERSINE} as sep from prim p join (select src_idx, ra + pmra / 3.6e6 / cos(radians(decl)) as ra, decl + pmdec / 3.6e6 as decl from sec) s on abs(p.decl - s.decl) < 0.06)
   where sep <= radians(3.0 / 3600)) m on m.row_idx = p.row_idx and m.k = 1"""


@query(_VALUES)
def full_pipeline_values(spark, d):
    """All stages; of their columns, those that don't come from random draws or from one of several equal matches."""
    return full_pipeline(spark, d).select("row_idx", "star_id", "planet_id", r("pl_rade"), r("pl_masse"), r("pl_orbsmax"), r("hz_inner"), r("hz_opt_outer"), r("equilibrium_temperature"), r("data_completeness_score"), "pl_rade_missing", r("distance_pc"), "sec_src_idx")


@query(f"select planet_id, star_id, pl_rade, pl_masse, pl_orbsmax from ({_VALUES})")
def full_pipeline_planets(spark, d):
    """The planets of stage nine, with what the stages before made of their values."""
    out = pipeline.tables(full_pipeline(spark, d))["planets"]
    return out.select("planet_id", "star_id", r("pl_rade"), r("pl_masse"), r("pl_orbsmax"))


@query(f"select star_id, st_teff, round(st_mass, 6) as st_mass, round(st_rad, 6) as st_rad from (select v.star_id, p.*, row_number() over (partition by v.star_id order by p.row_idx) as k from ({_VALUES}) v join prim p on p.row_idx = v.row_idx) where k = 1")
def full_pipeline_stars(spark, d):
    """The stars of stage nine: of planets with the same star, the first one's columns."""
    return pipeline.tables(full_pipeline(spark, d))["stars"].select("star_id", "st_teff", r("st_mass"), r("st_rad"))


@query()
def full_pipeline_tables(spark, d):
    """(name, n): stage nine over the wide table, which is written once: rows of every entity table."""
    path = _scratch(spark, "wide")
    full_pipeline(spark, d).write.parquet(path)
    made = pipeline.tables(spark.read.parquet(path))
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, df in made.items()]
    return reduce(DataFrame.unionByName, counts)


@query()
def full_pipeline(spark, d):
    """The wide table, stages one to eight: joins with three catalogs, then ids, units, checks, quality, physics, Monte Carlo, missingness and distance."""
    p = view(spark, d, "prim").withColumn("_row_idx", F.col("row_idx"))
    return pipeline.merged(p, _sources(spark, d), pipeline.Spec(CATALOGS))
