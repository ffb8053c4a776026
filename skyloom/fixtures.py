"""Adapter views over the driver's tables: planets, positions, stars and candidates; the SQL is the same text in Spark and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PRIM = """select p_partkey as row_idx,
 concat('  Planet-', cast(p_partkey as varchar(20)), ' B ') as pl_name,
 concat('Host ', cast(p_partkey % 500 as varchar(20))) as hostname,
 case when p_partkey % 9 = 0 then null else concat('Gaia DR2 ', cast(4295076295112340000 + p_partkey % 400 as varchar(20))) end as gaia_id,
 cast(2600 + p_size * 80 as double) as st_teff, cast(p_size as double) as st_tefferr1,
 case when p_partkey % 4 = 0 then null else -cast(p_size as double) / 2 end as st_tefferr2,
 case when p_partkey % 7 = 0 then null else cast((p_partkey % 23) - 15 as double) / 10 end as st_lum,
 case when p_partkey % 6 = 0 then null else cast(p_partkey % 19 + 1 as double) / 10 end as st_mass,
 cast(p_partkey % 29 + 1 as double) / 15 as st_rad,
 case when p_partkey % 11 = 0 then null else cast(p_partkey % 97 + 1 as double) / 50 end as pl_orbsmax,
 case when p_partkey % 17 = 0 then 2.0e5 * (p_partkey % 3 - 1) when p_partkey % 101 = 0 then 5.0e8 else p_retailprice end as pl_orbper,
 cast(p_partkey % 13 - 1 as double) / 10 as pl_orbeccen,
 case when p_partkey % 13 = 0 then null else cast(p_partkey % 31 - 1 as double) / 4 end as pl_rade,
 cast(p_partkey % 31 as double) / 40 as pl_radj,
 case when p_partkey % 5 = 0 then null else p_retailprice / 300 end as pl_masse,
 cast(p_partkey % 2 as int) as tran_flag,
 cast((p_partkey * 37) % 36000 as double) / 100 as ra,
 cast((p_partkey * 91) % 17800 as double) / 100 - 89 as decl
from {part}"""
SEC = """select s_suppkey as src_idx, s_name as src_name,
 cast((s_suppkey * 740) % 36000 as double) / 100 + cast(3 * (s_suppkey % 5) as double) / 10000 as ra,
 cast((s_suppkey * 1820) % 17800 as double) / 100 - 89 + cast(2 * (s_suppkey % 3) as double) / 10000 as decl,
 cast(s_suppkey % 40 - 20 as double) as pmra, cast(s_suppkey % 30 - 15 as double) as pmdec
from {supplier}"""
GAIA = """select 4295076295112340000 + c_custkey as gaia_dr2_source_id,
 case when c_custkey % 10 = 0 then null else 4295076295112340000 + c_custkey end as gaia_dr3_source_id,
 case when c_custkey % 8 = 0 then null else c_acctbal / 500 end as parallax,
 cast(c_custkey % 20 as double) / 10 as parallax_error,
 case when c_custkey % 12 = 0 then null else cast(c_custkey % 30 as double) / 10 end as ruwe,
 case when c_custkey % 3 = 0 then cast(c_custkey as double) else null end as distance_gspphot,
 (c_custkey % 14 = 0) as ambiguity_flag,
 case when c_custkey % 5 = 0 then 'cone_search' else 'direct' end as crossmatch_method,
 cast(c_custkey % 25 as double) / 10 as angular_separation
from {customer}"""
CAND = """select o_orderkey as tid, concat('planet-', cast(o_orderkey % 3000 as varchar(20)), ' b') as planet_name,
 concat(' HOST ', cast(o_custkey % 700 as varchar(20)), ' ') as name,
 case o_orderkey % 6 when 0 then 'PC' when 1 then 'CP' when 2 then 'APC' when 3 then 'FP' when 4 then 'KP' else null end as tfopwg_disp,
 case o_orderkey % 4 when 0 then 'CANDIDATE' when 1 then 'CONFIRMED' when 2 then 'FALSE POSITIVE' else null end as koi_disposition,
 case when o_orderkey % 3 = 0 then null else cast(o_orderkey % 2 as int) end as koi_fpflag_nt,
 cast(o_orderkey % 2 as int) as koi_fpflag_ss
from {orders}"""
#: Planets with their star's row and canonical ids, for entity tables.
WIDE = """select p.row_idx as _row_idx, p.pl_name, p.st_teff, p.st_tefferr1, p.st_tefferr2, p.st_lum, p.pl_rade, p.pl_masse, p.tran_flag, p.row_idx as tic_id,
 g.gaia_dr2_source_id, g.gaia_dr3_source_id, g.ruwe, c.tfopwg_disp as toi_candidates_tfopwg_disp, c.tid as toi_candidates_tid,
 cast(coalesce(g.gaia_dr3_source_id, g.gaia_dr2_source_id) as varchar(20)) as star_id, lower(trim(p.pl_name)) as planet_id
from prim p left join gaia g on cast(substr(p.gaia_id, 10) as bigint) = g.gaia_dr2_source_id
left join (select min(tid) as tid, planet_name from cand group by planet_name) m on lower(trim(p.pl_name)) = m.planet_name
left join cand c on c.tid = m.tid"""

#: The same rows for Spark: a null key is never looked up, for all of them would be sorted and joined by one task.
_SPREAD = WIDE.replace("on cast(substr(p.gaia_id, 10) as bigint) =", "on coalesce(cast(substr(p.gaia_id, 10) as bigint), -1 - p.row_idx) =").replace(
    "m on lower(trim(p.pl_name)) = m.planet_name\nleft join cand c on c.tid = m.tid", "m left join cand c on c.tid = m.tid) c on lower(trim(p.pl_name)) = c.planet_name"
).replace("left join (select min(tid)", "left join (select m.planet_name, c.tid, c.tfopwg_disp from (select min(tid)")

_TABLES = {"prim": (PRIM, "part"), "sec": (SEC, "supplier"), "gaia": (GAIA, "customer"), "cand": (CAND, "orders")}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An adapter view; Spark 4's ANSI mode takes the same SQL."""
    if name == "wide":
        text = _SPREAD
        for n in ("prim", "gaia", "cand"):
            text = text.replace(f"from {n} ", f"from {{{n}}} ").replace(f"join {n} ", f"join {{{n}}} ")
        return spark.sql(text, **{n: view(spark, sf_dir, n) for n in ("prim", "gaia", "cand")})
    sql, table = _TABLES[name]
    return spark.sql(sql, **{table: spark.read.parquet(f"{sf_dir}/{table}.parquet")})


def with_views(sql: str) -> str:
    """DuckDB SQL with the views it names in front."""
    need = [n for n in _TABLES if n in sql or "wide" in sql]
    parts = [f"{n} as ({_TABLES[n][0].format(**{_TABLES[n][1]: _TABLES[n][1]})})" for n in need]
    parts += [f"wide as ({WIDE})"] if "wide" in sql else []
    return f"with {', '.join(parts)} {sql}" if parts else sql
