"""Scans, sinks, graphs, registries and the chain of stages."""

import pytest
from pyspark.sql import functions as F

from skyloom.plans import cli, dag, merge, pipeline, settings
from skyloom.plans.registry import PREPROCESSORS, STRATEGIES, stage_of
from skyloom.sources import catalog, scan
from skyloom.streaming import enrich


def test_csv_parquet_and_fallback(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5, "2020-01-01"), (None, float("nan"), None)], "n string, x double, d string")
    path = scan.export(df, str(tmp_path), "t", ["csv", "parquet", "xlsx"])
    assert path["skipped"] == "xlsx"
    assert {tuple(r) for r in scan.scan_parquet(spark, path["parquet"]).collect()} == {("a", 1.5, "2020-01-01"), (None, None, None)}
    assert dict(scan.scan_csv(spark, path["csv"]).dtypes)["d"] == "string"
    df.write.csv(str(tmp_path / "raw/s/s.csv"), header=True)
    assert scan.scan_any(spark, str(tmp_path / "raw"), "s", ["n", "absent"]).columns == ["n"]
    assert scan.scan_any(spark, str(tmp_path / "raw"), "none") is None
    with pytest.raises(FileNotFoundError):
        scan.scan_any(spark, str(tmp_path / "raw"), "none", required=True)
    assert scan.parquet_to_csv(spark, path["parquet"], str(tmp_path / "out.csv"), "gzip").endswith("out.csv")
    with pytest.raises(ValueError):
        scan.parquet_to_csv(spark, path["parquet"], "x.csv", "zip")


def test_filter_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([(1, 50.0), (2, float("nan")), (3, None), (4, 1.0)], "k int, x double").write.parquet(str(tmp_path / "t"))
    df = scan.scan_parquet(spark, str(tmp_path / "t"), ["k", "x"], "x > 45")
    assert [tuple(r) for r in df.collect()] == [(1, 50.0)]
    assert "GreaterThan(x,45.0)" in df._jdf.queryExecution().toString()


def test_stages(spark, tmp_path):
    df = spark.range(3)
    assert scan.latest_stage(spark, str(tmp_path)) is None
    for stage in scan.STAGES[:2]:
        scan.write_stage(df, str(tmp_path), stage, "t")
    assert "02_quality_filtered" in scan.latest_stage(spark, str(tmp_path))
    assert scan.read_stage(spark, str(tmp_path), scan.STAGES[0], "t", ["id"]).count() == 3
    with pytest.raises(FileNotFoundError):
        scan.read_stage(spark, str(tmp_path), scan.STAGES[0], "absent")
    assert stage_of("feature_engineering") == "03_feature_engineered" and stage_of("other") == "02_quality_filtered"
    status = scan.data_status(spark, {"a": str(tmp_path / scan.STAGES[0] / "t"), "b": str(tmp_path / "absent")})
    assert status["a"] == {"status": "ok", "rows": 3} and status["b"]["status"] == "missing"


def test_fetch_lands_or_places_a_row(spark, tmp_path):
    raw = str(tmp_path / "raw.csv")
    with open(raw, "w") as f:
        f.write("pl_name,st_teff,extra\nx,5000,1\n")
    registry = catalog.Registry()
    registry.add(catalog.Source.of({"id": "good", "columns_to_keep": ["pl_name", "st_teff"], "primary_keys": ["pl_name"]}))
    registry.add(catalog.Source.of({"id": "bad", "url": "nowhere", "columns_to_keep": ["pl_name"], "primary_keys": ["pl_name"]}))
    registry.register("local", lambda s: s.id == "good", lambda s: raw)
    got = catalog.fetch_all(spark, registry, str(tmp_path / "out"))
    assert (got["good"].rows, got["good"].placeholder) == (1, False)
    assert got["bad"].placeholder and "LookupError" in got["bad"].error
    assert spark.read.parquet(got["bad"].path).first().pl_name == "dummy_bad"
    assert registry.find("go").id == "good" and registry.find("zz") is None
    with pytest.raises(KeyError):
        registry.get("absent")


def graph():
    g = dag.Graph("g")
    for i, need in (("fetch", []), ("clean", ["fetch"]), ("merge", ["clean"]), ("alone", [])):
        g.add(dag.Task(i, "t", need))
    return g


def test_graph_orders_and_errors():
    g = graph()
    assert g.order() == ["fetch", "alone", "clean", "merge"] and g.stats()["depth"] == 3
    assert g.ancestors("merge") == {"fetch", "clean"} and g.dependents("fetch") == ["clean"]
    with pytest.raises(ValueError):
        g.add(dag.Task("fetch", "t"))
    with pytest.raises(KeyError):
        g.depend("fetch", "nothing")
    g.depend("fetch", "merge")
    assert "cycle" in g.errors()[0]
    g.tasks["alone"].depends_on.append("lost")
    assert any("lost" in e for e in g.errors())


@pytest.mark.parametrize("mode", ["sequential", "parallel"])
def test_failure_policies(mode):
    def handler(task):
        if task.id == "clean":
            raise RuntimeError("no")
        return task.id

    for policy, want in (("fail", "pending"), ("skip", "done"), ("warn", "done" if mode == "sequential" else "pending")):
        g = graph()
        g.tasks["clean"].on_failure = policy
        said = dag.Runner({"t": handler}).run(g, mode)
        assert g.tasks["merge"].status == want and "clean" in said["errors"]


def test_retries_and_single_task():
    calls = []

    def handler(task):
        calls.append(task.id)
        if len(calls) < 3:
            raise RuntimeError("again")

    g = graph()
    g.tasks["fetch"].retries = 2
    said = dag.Runner({"t": handler}).run_one(g, "clean")
    assert calls == ["fetch"] * 3 + ["clean"] and set(said["tasks"]["done"]) == {"fetch", "clean"}
    with pytest.raises(ValueError):
        dag.Runner({}).run(graph(), "sideways")


def test_graph_round_trip(tmp_path):
    path = str(tmp_path / "g.yml")
    dag.save(graph(), path)
    assert dag.load(path).to_dict() == graph().to_dict()


def test_registries():
    assert {"gaia_source_id", "cone_search", "mission_data", "baseline"} <= set(STRATEGIES.listed())
    PREPROCESSORS.register("own", lambda d: d)
    assert PREPROCESSORS.info("own")["name"] == "own"
    PREPROCESSORS.unregister("own")
    with pytest.raises(KeyError):
        PREPROCESSORS.get("own")


def test_preprocessors_pass_other_tables_through(spark):
    df = spark.range(2)
    assert PREPROCESSORS.get("hz_edges")(df).columns == ["id"]


def test_merge_tells_of_failure(spark, tmp_path):
    df = spark.createDataFrame([(1,), (1,), (2,)], "a int")
    good = merge.run_merge({"x": df}, lambda s: s["x"], str(tmp_path / "m"))
    assert good.success and good.rows == 2 and good.statistics["merge_efficiency"] == pytest.approx(2 / 3)
    assert not merge.run_merge({}, lambda s: None, str(tmp_path / "n")).success
    assert "lacks" in merge.run_merge({"x": df}, lambda s: s["x"], str(tmp_path / "o"), {"x": ["b"]}).error


def test_catalog_merge_by_names(spark):
    planets = spark.createDataFrame([("P 1", "Host A", "Gaia DR2 1000000001", 1.0)], "pl_name string, hostname string, gaia_id string, pl_rade double")
    stars = spark.createDataFrame([("host a", 5000.0)], "hostname string, teff double")
    gaia = spark.createDataFrame([(1000000001, 1.0, 9.0, 1.0)], "gaia_id long, ruwe double, parallax double, parallax_error double")
    r = pipeline.catalog_merge({"nasa_exoplanet": planets, "sweet": stars, "gaia": gaia}).first()
    assert r.sweet_teff == 5000.0 and r.gaia_parallax_quality == "good" and r.has_gaia_data and r.data_completeness_score == 1.0


def test_cli_and_settings(spark, tmp_path, monkeypatch, capsys):
    dag.save(graph(), str(tmp_path / "g.json"))
    assert cli.main(["dag", "validate", str(tmp_path / "g.json")]) == 0
    assert cli.main(["dag", "info", str(tmp_path / "g.json")]) == 0
    assert cli.main(["merge", "--list-strategies"]) == 0 and "cone_search" in capsys.readouterr().out
    monkeypatch.setenv("SKYLOOM_WORKERS", "9")
    assert settings.load(root=str(tmp_path)).workers == 9


SOURCES = {
    "nasa_archive": {"columns_to_keep": ["pl_name", "hostname", "gaia_id", "ra", "dec", "st_teff", "st_lum", "st_mass", "st_rad", "pl_orbsmax", "pl_orbper", "pl_orbeccen", "pl_masse", "pl_rade"], "primary_keys": ["pl_name"]},
    "other_catalog": {"columns_to_keep": ["P_NAME", "P_ESI"], "primary_keys": ["P_NAME"]},
    "sweet_cat": {"columns_to_keep": ["Name", "Teff"], "primary_keys": ["Name"]},
    "gaia_dr3_parameters": {"adql": "-- by tiers", "columns_to_keep": ["gaia_dr2_source_id", "gaia_dr3_source_id", "parallax", "ruwe"], "primary_keys": ["gaia_dr3_source_id"]},
    "waiting": {"adql": "select x from t where id in (<GAIA_ID_LIST>)", "columns_to_keep": ["x", "y"], "primary_keys": ["x"]},
    "lost": {"download_url": "https://nowhere.example/x.csv", "columns_to_keep": ["k"], "primary_keys": ["k"]},
}
RAW = {
    "nasa_archive": "pl_name,hostname,gaia_id,ra,dec,st_teff,st_lum,st_mass,st_rad,pl_orbsmax,pl_orbper,pl_orbeccen,pl_masse,pl_rade,extra\nP 1 b,Host A,Gaia DR2 1000000001,10,20,5000,0.5,1,1,0.9,300,0.1,2,1.5,x\nP 2 b,Host B,Gaia DR2 1000000002,11,21,5200,0.7,1,1,1.1,400,0.1,3,2.5,x\n",
    "other_catalog": "P_NAME,P_ESI\np 1 b,0.8\n",
    "sweet_cat": "Name,Teff\nhost a,4900\n",
}


@pytest.fixture
def project(spark, tmp_path):
    """A root with configuration, landed raw files, both releases, and a graph in the mapping form."""
    import yaml

    for kind in ("sources", "mergers", "constants", "dags"):
        (tmp_path / "config" / kind).mkdir(parents=True)
    for name, told in SOURCES.items():
        if name in RAW:
            (tmp_path / f"{name}.csv").write_text(RAW[name])
            told = told | {"download_url": str(tmp_path / f"{name}.csv")}
        (tmp_path / "config/sources" / f"{name}.yml").write_text(yaml.safe_dump({"id": name, "name": name} | told))
    (tmp_path / "config/sources/broken.yml").write_text("name: without an id")
    (tmp_path / "config/constants/drop_columns.yml").write_text(yaml.safe_dump({"columns_to_drop": ["hostname"]}))
    catalogs = [
        {"id": "gaia_dr3_parameters", "priority": 1, "cross_match": {"method": "gaia_source_id", "primary_key": "gaia_id", "tolerance": None}},
        {"id": "sweet_cat", "priority": 2, "cross_match": {"method": "fuzzy_hostname", "primary_key": "hostname", "tolerance": 0.8}},
        {"id": "other_catalog", "priority": 3, "cross_match": {"method": "exact_name", "primary_key": "pl_name"}},
        {"id": "toi", "priority": 4, "cross_match": {"method": "multiple_identifiers", "primary_key": ["ra", "dec"], "tolerance": 2.0, "epoch_correction": True}},
    ]
    made = {"id": "own_merge", "sources": {"primary": "nasa_archive", "catalogs": catalogs}, "uncertainty_propagation": {"num_samples": 50, "random_seed": 7}}
    (tmp_path / "config/mergers/own_merge.yml").write_text(yaml.safe_dump(made))
    raw = str(tmp_path / "data/raw")
    spark.createDataFrame([(1000000001, 10.0, 20.0, 5.0, 0.1, 1.1, 12.0)], "source_id long, ra double, dec double, parallax double, parallax_error double, ruwe double, phot_g_mean_mag double").write.parquet(f"{raw}/gaia_dr3/gaia_dr3.parquet")
    spark.createDataFrame([(1000000002, 11.0, 21.0, 4.0, 0.1, 12.0)], "source_id long, ra double, dec double, parallax double, parallax_error double, phot_g_mean_mag double").write.parquet(f"{raw}/gaia_dr2/gaia_dr2.parquet")
    fetches = {f"fetch_{n}": {"task_type": "fetch", "config": {"source": n}, "dependencies": ["fetch_nasa_archive"] if n.startswith("gaia") else [], "retries": 1, "on_failure": "warn" if n == "lost" else "fail"} for n in SOURCES}
    rest = {
        "check_raw": {"task_type": "validate", "config": {"check_completeness": True}, "dependencies": list(fetches)},
        "ingest": {"task_type": "merge", "config": {"strategy": "unified_ingestion", "monte_carlo_samples": 20}, "dependencies": ["check_raw"]},
        "assess": {"task_type": "validate", "config": {"check_completeness": True, "check_hz_columns": True}, "dependencies": ["ingest"]},
        "export": {"task_type": "export", "config": {"formats": ["parquet", "csv"], "output_path": "final", "filename": "all"}, "dependencies": ["assess"]},
    }
    (tmp_path / "config/dags/all.yaml").write_text(yaml.safe_dump({"dag_id": "all", "tasks": fetches | rest}, sort_keys=False))
    return tmp_path


def test_ten_tasks_run_from_landed_files_to_the_export(spark, project, capsys):
    import json

    graph = str(project / "config/dags/all.yaml")
    root = ["--root", str(project)]
    assert cli.main([*root, "dag", "run", graph, "--dry-run"]) == 0 and not (project / "data/interim").exists()
    capsys.readouterr()
    assert cli.main([*root, "dag", "run", graph, "--mode", "parallel"]) == 0
    said = json.loads(capsys.readouterr().out)
    assert len(said["tasks"]["done"]) == 10 and not said["errors"]
    wide = {r.pl_name: r for r in spark.read.parquet(str(project / "data/processed/final/all.parquet")).collect()}
    assert wide["P 1 b"].star_id == "1000000001" and wide["P 2 b"].star_id == "1000000002"
    assert wide["P 1 b"].gaia_dr3_parameters_gaia_dr3_source_id == 1000000001 and wide["P 2 b"].gaia_dr3_parameters_gaia_dr3_source_id is None
    assert wide["P 1 b"].sweet_cat_Teff == 4900 and wide["P 2 b"].sweet_cat_Teff is None and wide["P 1 b"].other_catalog_P_ESI == 0.8
    assert wide["P 1 b"].hz_inner is not None and (project / "data/processed/final/all.csv").exists()
    assert spark.read.parquet(str(project / "data/raw/lost/lost.parquet")).first().k == "dummy_lost"
    empty = spark.read.parquet(str(project / "data/raw/waiting/waiting.parquet"))
    assert empty.columns == ["x", "y"] and empty.count() == 0


def test_commands(spark, project, capsys):
    import json

    def told(*args, code=0):
        assert cli.main(["--root", str(project), *args]) == code
        return json.loads(capsys.readouterr().out)

    assert told("fetch")["sources"] == sorted(SOURCES) and "unknown" in told("fetch", "none", code=1)["error"]
    assert told("fetch", "sweet_cat")["sweet_cat"]["rows"] == 1 and told("fetch", "all", "--sequential")["lost"]["placeholder"]
    assert "own_merge" in told("merge")["strategies"] and "nearest" in told("merge", "--info")["cone_search"]
    assert "unknown strategy" in told("merge", "none", code=1)["error"]
    assert told("merge", "own_merge", "--output", "own")["rows"] == 2
    assert told("data", "sources") == sorted(SOURCES) and told("data", "sources", "-d")["sweet_cat"]["columns"] == 2
    assert told("data", "config")["constants"] == ["drop_columns"]
    status = told("data", "status")
    assert status["raw"]["nasa_archive"] == {"status": "ok", "rows": 2} and status["interim"]["01_initial_merge"]["own"]["rows"] == 2
    valid = told("data", "validate")
    assert valid["total"] == 6 and valid["sources"]["lost"]["rows"] == 1
    assert told("config", "show")["workers"] == 4 and told("config", "dags") == ["all.yaml"]
    assert "unified" in told("info")["strategies"] and told("dag", "info", str(project / "config/dags/all.yaml"))["tasks"] == 10
    assert [x["id"] for x in told("dag", "validate", str(project / "config/dags/all.yaml"))["order"]][-1] == "export"


def test_preprocess_task_drops_what_the_constants_say(spark, project):
    from skyloom.plans.handlers import Handlers

    made = Handlers(spark, settings.load(root=str(project)))
    with pytest.raises(FileNotFoundError):
        made.preprocess(dag.Task("p", "preprocess", config={"preprocessor": "columns_pruner"}))
    scan.write_stage(spark.createDataFrame([("a", "h")], "pl_name string, hostname string"), made.settings.interim, scan.STAGES[0], "t")
    told = made.preprocess(dag.Task("p", "preprocess", config={"preprocessor": "columns_pruner"}))
    assert told["output_rows"] == 1 and spark.read.parquet(told["output_path"]).columns == ["pl_name"]
    for bad in (dag.Task("f", "fetch"), dag.Task("p", "preprocess")):
        with pytest.raises(ValueError):
            made.by_type()[bad.type](bad)


def test_commands_are_found_by_scan(tmp_path, monkeypatch):
    at = tmp_path / "own_commands"
    at.mkdir()
    (at / "__init__.py").write_text("")
    (at / "hello.py").write_text("def arguments(p):\n    p.add_argument('who')\ndef run(given, context):\n    return len(given.who)\n")
    (at / "broken.py").write_text("import nothing_of_that_name\n")
    monkeypatch.syspath_prepend(str(tmp_path))
    assert list(cli.commands("own_commands")) == ["hello"]
    assert cli.main(["hello", "abc"], (cli.COMMANDS, "own_commands")) == 3


def test_fetchers_ask_and_refuse(spark, tmp_path):
    asked = []

    def transport(url, query, timeout):
        asked.append((url, query, timeout))
        return b"  <VOTABLE>error</VOTABLE>" if query and "bad" in query else b"a,b\n1,2\n"

    registry = catalog.usual_fetchers(catalog.Registry(), spark, str(tmp_path / "raw"), transport, 5, 9)
    for told in ({"id": "q", "adql": "select good", "primary_keys": ["a"]}, {"id": "x", "adql": "select bad", "columns_to_keep": ["a"], "primary_keys": ["a"]}, {"id": "h", "download_url": "http://h/t.csv", "columns_to_keep": ["b"]}):
        registry.add(catalog.Source.of(told))
    got = catalog.fetch_all(spark, registry, str(tmp_path / "out"), workers=1)
    assert (got["q"].rows, got["h"].rows) == (1, 1) and got["x"].placeholder and "XML" in got["x"].error
    assert sorted(asked) == [("", "select bad", 9), ("", "select good", 9), ("http://h/t.csv", None, 5)]
    assert len(list((tmp_path / "raw/q").glob("q_*.csv"))) == 1 and spark.read.parquet(got["h"].path).columns == ["b"]
    assert catalog.with_ids(catalog.Source.of({"id": "w", "adql": f"in ({catalog.ID_LIST})"}), [3, 4]) == "in (3,4)"


def test_every_strategy_is_called_alike(spark):
    numbers = ("ra", "dec", "st_teff", "st_lum", "st_mass", "st_rad", "pl_orbsmax", "pl_orbper", "pl_orbeccen", "pl_masse", "pl_rade")
    planets = spark.createDataFrame([("P 1", "Host A", "Gaia DR2 1000000001", 1, 10.0, 20.0, 5000.0, 0.5, 1.0, 1.0, 1.0, 365.0, 0.0, 1.0, 1.0)], f"pl_name string, hostname string, gaia_id string, tic_id long, {', '.join(f'{c} double' for c in numbers)}")
    other = spark.createDataFrame([("p 1", "p 1", "host a", 1000000001, 1, 10.0, 20.0)], "name string, planet string, hostname string, gaia_id long, tic_id long, ra double, dec double")
    for name in STRATEGIES.listed():
        spec = pipeline.Spec((pipeline.Catalog("other", "exact_name", "pl_name"),), samples=10)
        got = STRATEGIES.get(name)({"planets": planets, "other": other}, spec, "planets")
        assert got.count() == 1 and any(c.startswith("other_") for c in got.columns), name
    assert STRATEGIES.get("hostname")({"only": planets}).count() == 1
    with pytest.raises(KeyError):
        STRATEGIES.get("hostname")({"only": planets}, primary="none")


def test_merge_by_name_reads_what_it_wrote(spark, tmp_path, caplog):
    a = spark.createDataFrame([("A",), ("A",)], "hostname string")
    assert merge.merge_by("hostname", {"a": a, "b": a.limit(0)}, str(tmp_path / "m"), primary="a").count() == 1
    assert "b has no rows" in caplog.text and merge.strategies() == STRATEGIES.listed()
    with pytest.raises(RuntimeError):
        merge.merge_by("none", {"a": a}, str(tmp_path / "n"))


def test_settings_take_the_environment(monkeypatch):
    for k, v in (("FORCE", "yes"), ("TIMEOUT", "7"), ("CONFIG", "/etc/x")):
        monkeypatch.setenv(f"SKYLOOM_{k}", v)
    made = settings.load(root="/r")
    assert made.force is True and made.timeout == 7 and made.config_folder == "/etc/x" and made.query_timeout == 300


def test_routes():
    import threading
    import urllib.error
    import urllib.request

    from skyloom.plans.api import server

    s = server(port=0)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{s.server_address[1]}"
    assert urllib.request.urlopen(f"{base}/health").read() == b'{"status": "ok"}'
    with pytest.raises(urllib.error.HTTPError):
        urllib.request.urlopen(f"{base}/nowhere")
    s.shutdown()


def test_stream(spark, tmp_path):
    schema = "pl_name string, at timestamp, st_teff double, st_lum double, st_rad double, pl_orbsmax double, pl_rade double, pl_masse double"
    rows = [(" A ", 5000.0), ("a", 5100.0), ("b", 5200.0)]
    df = spark.createDataFrame(rows, "pl_name string, st_teff double").select("pl_name", F.current_timestamp().alias("at"), "st_teff", *(F.lit(1.0).alias(c) for c in ("st_lum", "st_rad", "pl_orbsmax", "pl_rade", "pl_masse")))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = enrich.first_of_each(enrich.enrich_stream(enrich.landed(spark, str(tmp_path / "in"), schema)), "at")
    q = stream.writeStream.format("memory").queryName("enriched").option("checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.planet_id for r in spark.table("enriched").collect()) == ["a", "b"]
