"""The jobs: against their SQL, run again, run over growing input, and run again after a failure. Everything lies in copies below a temporary folder."""

import json
import logging
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from jobs import catalog_release, text_intake
from jobs.common import settings
from jobs.queries import ORACLE_SQL, QUERIES

from .oracle import connect, rows

ROOT = Path(__file__).parent.parent
RELEASE, INTAKE = (str(ROOT / "jobs" / f"{n}.json") for n in ("catalog_release", "text_intake"))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_job_equals_its_sql(spark, sf_dir, name):
    df, cursor = QUERIES[name](spark, sf_dir), connect(sf_dir).execute(ORACLE_SQL[name])
    names = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, df.collect()) == rows(names, cursor.fetchall())


def test_jobs_import_nothing_of_the_optional_part():
    for f in (ROOT / "jobs").glob("*.py"):
        assert "skyloom.llm" not in f.read_text() and "corpus_pipeline" not in f.read_text()


def _all(df):
    return sorted(str(r) for r in df.collect())


def test_releases_stay_apart_and_tell_their_drift(spark, sf_dir, tmp_path, caplog):
    config = settings(spark, RELEASE)
    with caplog.at_level(logging.INFO, logger="jobs"):
        first = _all(catalog_release.run(spark, sf_dir, str(tmp_path / "out"), config | {"release": "r1"}))
    assert "no release before r1" in caplog.text and "'rows': 200" in caplog.text
    # the next release has other temperatures, so their distribution shifts and the others' don't
    for t in ("part", "customer", "supplier", "orders", "lineitem"):
        df = spark.read.parquet(f"{sf_dir}/{t}.parquet")
        (df.withColumn("p_size", F.col("p_size") + 30) if t == "part" else df).write.parquet(f"{tmp_path}/next/{t}.parquet")
    for _ in range(2):
        second = _all(catalog_release.run(spark, f"{tmp_path}/next", str(tmp_path / "out"), config | {"release": "r2"}))
        drifted = {r.column: r for r in spark.read.parquet(f"{tmp_path}/out/drift").collect()}
        assert set(drifted) == set(config["columns"]) and all(r.before == "r1" and r.release == "r2" for r in drifted.values())
        assert drifted["st_teff"].largest_gap > 0.4 and drifted["st_teff"].mean_shift == pytest.approx(2400, rel=0.05) and drifted["pl_rade"].largest_gap == 0
    assert second != first
    assert _all(spark.read.parquet(f"{tmp_path}/out/catalog").filter("release = 'r1'").select(spark.read.parquet(f"{tmp_path}/out/catalog").columns)) == first
    # a repeated run of the earlier release compares with none before it, and changes nothing
    assert _all(catalog_release.run(spark, sf_dir, str(tmp_path / "out"), config | {"release": "r1"})) == first


def test_release_without_matches(spark, sf_dir, tmp_path):
    for t in ("part", "customer", "supplier", "orders", "lineitem"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").limit(5 if t == "part" else 0).write.parquet(f"{tmp_path}/in/{t}.parquet")
    made = catalog_release.run(spark, f"{tmp_path}/in", f"{tmp_path}/out", settings(spark, RELEASE))
    assert made.count() == 5 and made.filter("star_id is not null or cand_tid is not null or near_src_idx is not null").count() == 0
    assert {r.price_source for r in made.collect()} == {"catalog"}


TEXTS = "doc_id long, text string, lang string, source string, n_chars long"


def _land(spark, folder, rows_):
    df = spark.createDataFrame([(k, t, lang, src, None if t is None else len(t)) for k, t, lang, src in rows_], TEXTS)
    df.coalesce(1).write.mode("append").parquet(str(folder))


def _intake(spark, at, **changed):
    return text_intake.run(spark, f"{at}/landing", f"{at}/out", f"{at}/marks", settings(spark, INTAKE) | changed)


def _plain(batches):
    """Brute force: doc_id: (batch, status, first_id) of batches of rows."""
    out, known = {}, {}
    for n, batch in enumerate(batches):
        good = {k: " ".join(t.split()) for k, t, lang, src in batch if t and 20 <= len(t) <= 100_000 and src and src.strip() and lang and t.strip()}
        own = {}
        for k, t in good.items():
            own[t] = min(own.get(t, k), k)
        for k, t, _, _ in batch:
            first = known.get(good.get(k), own.get(good.get(k)))
            out[k] = (n, "rejected", None) if k not in good else (n, "accepted", None) if first == k else (n, "duplicate", first)
        known = {**own, **known}
    return out


BATCHES = [
    [(5, "the same text, told twice over", "en", "a"), (3, "the same  text,\n told twice over ", "en", "b"), (8, "another text that is long enough", "de", "a"), (9, "short", "en", "a"), (10, None, "en", "a"), (11, "long enough, but of nobody here", "en", "  ")],
    [(20, "another text  that is long enough", "fr", "a"), (1, "the same text, told twice over", "en", "a"), (21, "a new text which comes two times", "en", "a"), (22, "a new text which comes two times", None, "a"), (23, "a new text which comes two times", "en", "c")],
    [(30, "a new text which comes two times", "en", "a"), (31, "short", "en", "a"), (32, "the last text to be taken in here", "es", "z")],
]


def test_intake_takes_only_what_is_new(spark, tmp_path, caplog):
    assert _intake(spark, tmp_path) is None
    for n, batch in enumerate(BATCHES):
        _land(spark, tmp_path / "landing", batch)
        with caplog.at_level(logging.INFO, logger="jobs"):
            caplog.clear()
            made = _intake(spark, tmp_path)
        assert f"read {len(batch)} new rows" in caplog.text
        got = {r.doc_id: (r.batch, r.status, r.first_id) for r in made.collect()}
        want = _plain([[r for r in b if r[2]] + [r for r in b if not r[2]] for b in BATCHES[: n + 1]])
        # a row without a language isn't judged by the rule for it
        assert {k: v for k, v in got.items() if k != 22} == {k: v for k, v in want.items() if k != 22}
    before = _all(made)
    with caplog.at_level(logging.INFO, logger="jobs"):
        caplog.clear()
        assert _all(_intake(spark, tmp_path)) == before and "read 0 new rows" in caplog.text
    profile = spark.read.parquet(f"{tmp_path}/out/profile").groupBy("batch").agg(F.max("n").alias("n")).collect()
    assert {r.batch: r.n for r in profile} == {n: sum(v[:2] == (n, "accepted") for v in got.values()) for n in range(3)}
    assert {r.batch for r in spark.read.parquet(f"{tmp_path}/out/drift").select("batch").distinct().collect()} == {1, 2}


def test_intake_ends_alike_after_a_failure(spark, tmp_path, monkeypatch):
    """A batch that fails after its records are written is run again from the mark, and replaces them."""
    for at in ("whole", "broken"):
        for n, batch in enumerate(BATCHES):
            _land(spark, tmp_path / at / "landing", batch)
            if at == "broken" and n == 1:
                with monkeypatch.context() as m:
                    m.setattr(text_intake.drift, "compare", lambda *a: 1 / 0)
                    with pytest.raises(Exception, match="division by zero"):
                        _intake(spark, tmp_path / at)
                assert spark.read.parquet(f"{tmp_path}/broken/out/records").select("batch").distinct().count() == 2
            made = _intake(spark, tmp_path / at)
        if at == "whole":
            want = _all(made.drop("batch"))
    assert _all(made.drop("batch")) == want


def test_intake_of_a_hot_text(spark, tmp_path):
    """A third of all rows have one text, others come twice or once: the hot one is looked up by broadcast, the rest by their digests."""
    batch = [(k, "the one text which so many records have" if k % 3 == 0 else f"a text of which there are two: {k // 6} {k % 3}", "en", "a") for k in range(6000)]
    _land(spark, tmp_path / "landing", batch)
    got = {r.doc_id: (r.batch, r.status, r.first_id) for r in _intake(spark, tmp_path).collect()}
    assert got == _plain([batch])
    groups = spark.read.parquet(f"{tmp_path}/out/groups")
    assert groups.count() == 2001 and groups.agg(F.max("n")).first()[0] == 2000


def test_intake_of_several_files_a_run_and_of_an_empty_one(spark, tmp_path):
    _land(spark, tmp_path / "landing", [])
    for batch in BATCHES:
        _land(spark, tmp_path / "landing", batch)
    made = _intake(spark, tmp_path, files_a_batch=1)
    assert made.count() == sum(map(len, BATCHES)) and made.select("batch").distinct().count() == 3
    assert made.filter("status = 'duplicate' and first_id = doc_id").count() == 0
    originals = made.filter("status = 'accepted'").groupBy("digest").count().filter("count > 1")
    assert originals.count() == 0


@pytest.mark.parametrize("job", ["catalog_release", "text_intake"])
def test_command_line(sf_dir, tmp_path, job):
    paths = {"catalog_release": {"tables": sf_dir}, "text_intake": {"landing": f"{sf_dir}/{{documents}}.parquet", "checkpoint": f"{tmp_path}/marks"}}[job] | {"out": f"{tmp_path}/out"}
    conf = ["--config", str(ROOT / "jobs" / f"{job}.json"), *(x for k, v in paths.items() for x in (f"--{k}", v))]
    told = subprocess.run([sys.executable, "-m", f"jobs.{job}", *conf], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert told.returncode == 0, told.stderr[-2000:]
    assert "wrote" in told.stderr and list(Path(f"{tmp_path}/out").glob("*"))
    assert json.loads(Path(conf[1]).read_text())
