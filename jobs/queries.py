"""The jobs as queries: each is run twice into one new folder, and the whole output is returned as it then stands. With DuckDB SQL for the same rows."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs import catalog_release, text_intake
from skyloom.fixtures import with_views
from skyloom.operators import rules
from skyloom.queries import _scratch, r
from skyloom.release_queries import AMBIGUITY, PRIM_COLUMNS, RESOLVED, broken_sql


def _config(name: str) -> dict:
    """The settings file beside a job, as shipped with the code."""
    return json.loads((Path(__file__).parent / f"{name}.json").read_text())


_RELEASE, _INTAKE = _config("catalog_release"), _config("text_intake")


def job1_catalog_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _scratch(spark, "catalog-release")
    for _ in range(2):
        made = catalog_release.run(spark, sf_dir, out, _RELEASE)
    values = (x for p in _RELEASE["parameters"]["columns"] for x in (F.round(f"{p}_value", 9).alias(f"{p}_value"), f"{p}_source", f"{p}_conflict"))
    return made.select("release", "row_idx", "planet_id", "star_id", "cand_tid", "near_src_idx", "near_ambiguous", *values, *(r(c) for c in _RELEASE["columns"]), "violations", "grade")


def job2_text_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _scratch(spark, "text-intake")
    for _ in range(2):
        made = text_intake.run(spark, f"{sf_dir}/{{documents}}.parquet", f"{out}/out", f"{out}/marks", _INTAKE)
    return made.select("doc_id", "source", "lang", "n_chars", "counted_chars", "digest", "status", "first_id", "violations")


_CHECKS = [*rules.CONSISTENCY, *rules.from_config(_RELEASE["rules"])]
_JOB1 = f"""select '{_RELEASE["release"]}' as release, p.row_idx, lower(trim(p.pl_name)) as planet_id, coalesce(g.gaia_dr3_source_id, g.gaia_dr2_source_id) as star_id, c.tid as cand_tid, n.src_idx as near_src_idx, n.ambiguous as near_ambiguous,
 price.value as price_value, price.source as price_source, price.conflict as price_conflict, tax.value as tax_value, tax.source as tax_source, tax.conflict as tax_conflict, {", ".join(f"round({c}, 6) as {c}" for c in _RELEASE["columns"])},
 array_to_string(p.broken, ',') as violations, case when coalesce(n.ambiguous, false) or coalesce(price.conflict, false) or len(p.broken) > 1 then 'C' when len(p.broken) = 1 then 'B' else 'A' end as grade
 from (select *, {broken_sql(_CHECKS, PRIM_COLUMNS)} as broken from prim) p
 left join gaia g on try_cast(nullif(regexp_extract(p.gaia_id, '[0-9]{{10,}}'), '') as bigint) = g.gaia_dr2_source_id
 left join (select planet_name, min(tid) as tid from cand group by planet_name) c on lower(trim(p.pl_name)) = lower(trim(c.planet_name))
 left join ({AMBIGUITY}) n on n.row_idx = p.row_idx
 left join (select * from ({RESOLVED}) where parameter = 'price') price on price.object_id = p.row_idx left join (select * from ({RESOLVED}) where parameter = 'tax') tax on tax.object_id = p.row_idx"""
_TEXT_COLUMNS = {"doc_id", "text", "lang", "source", "n_chars", "counted_chars", "digest"}
_JOB2 = f"""with standard as (select doc_id, nullif(trim(lang), '') as lang, nullif(trim(source), '') as source, n_chars, text, length(text) as counted_chars,
  case when trim(regexp_replace(text, '[\\t\\n\\x0B\\f\\r ]+', ' ', 'g')) <> '' then sha256(trim(regexp_replace(text, '[\\t\\n\\x0B\\f\\r ]+', ' ', 'g'))) end as digest from documents),
 checked as (select *, {broken_sql(rules.from_config(_INTAKE["rules"]), _TEXT_COLUMNS)} as broken from standard),
 firsts as (select digest, min(doc_id) as own from checked where len(broken) = 0 and digest is not null group by digest)
 select doc_id, source, lang, n_chars, counted_chars, c.digest, case when len(broken) > 0 then 'rejected' when f.own <> doc_id then 'duplicate' else 'accepted' end as status,
 case when len(broken) = 0 and f.own <> doc_id then f.own end as first_id, array_to_string(broken, ',') as violations from checked c left join firsts f on f.digest = c.digest"""

QUERIES = {f.__name__: f for f in (job1_catalog_release, job2_text_intake)}
ORACLE_SQL = {"job1_catalog_release": with_views(_JOB1), "job2_text_intake": _JOB2}
