"""Remote catalogs on the executors, time limits of tasks, and figures taken while writing."""

import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from skyloom.operators import profile
from skyloom.plans import dag, merge
from skyloom.sources import remote
from skyloom.sources.catalog import ID_LIST, Source


def answer(url, query, timeout):
    """A service that knows even ids only, tells who asked, and is down at the first request of each folder that the url names."""
    if url.startswith("flaky:"):
        mark = f"{url[6:]}/{query.count(',')}-{hash(query)}"
        if not os.path.exists(mark):
            open(mark, "w").close()
            raise ConnectionError("down")
    if url == "xml":
        return b"  <VOTABLE>error</VOTABLE>"
    ids = [int(x) for x in query.split("(")[1].rstrip(")").split(",")]
    rows = "".join(f"{i},{i / 8},{'x' if i % 4 else ''},{len(ids)},{os.getpid()}\n" for i in ids if i % 2 == 0)
    return f"source_id,parallax,name,asked,pid\n{rows}".encode()


SCHEMA = "source_id long, parallax double, name string, asked int, pid long, absent string"
QUERY = f"select * from t where source_id in ({ID_LIST})"


def test_data_source_asks_by_batches_on_the_executors(spark):
    remote.register(spark)
    options = {"transport": "tests.test_remote:answer", "query": QUERY, "ids": ",".join(map(str, range(230)))}
    df = spark.read.format("remote_catalog").schema(SCHEMA).options(**options).load()
    assert df.rdd.getNumPartitions() == 3
    got = {r.source_id: r for r in df.collect()}
    assert set(got) == set(range(0, 230, 2)) and {r.asked for r in got.values()} == {100, 30}
    assert got[4].parallax == 0.5 and got[4].name is None and got[6].name == "x" and got[6].absent is None
    assert all(r.pid != os.getpid() for r in got.values())
    with pytest.raises(Exception, match="XML"):
        spark.read.format("remote_catalog").schema(SCHEMA).options(**options, url="xml").load().collect()
    with pytest.raises(Exception, match="by_ids"):
        spark.read.format("remote_catalog").schema(SCHEMA).options(**options | {"ids": ",".join(["1"] * 100_001)}).load().collect()


def test_ids_of_a_table_are_asked_where_they_are(spark, tmp_path):
    targets = spark.range(1000).select(F.when(F.col("id") % 10 != 3, F.col("id")).alias("target_id")).union(spark.range(50))
    source = Source("gaia", query=QUERY, url=f"flaky:{tmp_path}")
    got = remote.by_ids(targets, source, "tests.test_remote:answer", SCHEMA, batch=50, requests=2, pause=0.01).collect()
    assert sorted(r.source_id for r in got) == [k for k in range(0, 1000, 2)]
    assert max(r.asked for r in got) == 50 and len({r.pid for r in got} - {os.getpid()}) >= 1
    assert len(os.listdir(tmp_path)) >= 900 / 50
    assert remote.by_ids(targets.limit(0), source, answer, SCHEMA).collect() == []
    with pytest.raises(ValueError, match="takes no ids"):
        remote.by_ids(targets, Source("gaia"), answer, SCHEMA)


def test_refused_and_broken_requests():
    calls = []

    def down(*a):
        calls.append(a)
        raise TimeoutError("slow")

    with pytest.raises(TimeoutError):
        remote.asked(down, "u", None, 1, 3, 0)
    assert len(calls) == 3


def _sleeps(spark, seconds):
    @F.udf("long")
    def slow(k):
        time.sleep(seconds)
        return k

    return spark.range(4).select(slow("id").alias("x")).agg(F.sum("x")).first()[0]


@pytest.mark.parametrize("mode", ["sequential", "parallel"])
def test_a_time_limit_ends_the_work(spark, mode):
    g = dag.Graph("limits")
    g.add(dag.Task("slow", "sleep", config={"s": 60}, timeout=3, retries=2, on_failure=dag.SKIP))
    g.add(dag.Task("quick", "sleep", config={"s": 0}, timeout=60))
    g.add(dag.Task("plain", "none", depends_on=["quick"], timeout=60))
    began = time.monotonic()
    runner = dag.Runner({"sleep": lambda t: _sleeps(spark, t.config["s"]), "none": lambda t: "done"}, spark=spark)
    told = runner.run(g, mode)
    assert time.monotonic() - began < 40
    assert g.tasks["slow"].status == "skipped" and "OutOfTime: over its limit of 3 s" in told["errors"]["slow"]
    assert g.tasks["quick"].result == 6 and g.tasks["plain"].result == "done"
    # the session works on, and no timer is left
    assert spark.range(3).count() == 3 and spark.sparkContext.getLocalProperty("spark.jobGroup.id") is None
    time.sleep(0.6)
    assert not [t for t in threading.enumerate() if isinstance(t, threading.Timer) and t.is_alive()]


def test_merge_figures_come_from_the_write(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "id long, name string")
    monkeypatch.setattr(type(spark.read), "parquet", lambda *a, **k: pytest.fail("the result is read again"))
    told = merge.run_merge({"one": df}, lambda s: s["one"], f"{tmp_path}/out")
    assert told.success and told.rows == 2 and told.statistics["null_pct"] == 25.0 and told.statistics["input_sources"] == {"one": 3}
    empty = merge.run_merge({"one": df.limit(0)}, lambda s: s["one"], f"{tmp_path}/empty")
    assert empty.rows == 0 and empty.statistics["null_pct"] == 0.0


def test_profile_of_odd_columns(spark):
    df = spark.createDataFrame([(1, "a", None, [1]), (1, "b", None, [1]), (None, "a", None, None)], "a int, `b.c` string, d double, e array<int>")
    got = {r.column: tuple(r)[1:] for r in profile.profile_columns(df).collect()}
    assert got == {"a": (3, 1, pytest.approx(100 / 3), 1), "b.c": (3, 0, 0.0, 2), "d": (3, 3, 100.0, 0), "e": (3, 1, pytest.approx(100 / 3), 1)}
    assert {tuple(r) for r in profile.profile_columns(df.limit(0)).collect()} == {(c, 0, 0, 0.0, 0) for c in df.columns}
    plan = profile.profile_columns(df)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
