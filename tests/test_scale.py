"""What keeps work in proportion at size: how rows are dealt, and what is sorted or exchanged."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from skyloom.fixtures import view
from skyloom.functions.astro import separation
from skyloom.operators import joins, montecarlo, motion, normalize, precedence, sky, tiers


def test_pairs_of_repeated_hosts_are_dealt_by_host(spark):
    p = spark.range(400).select(F.col("id").alias("row_idx"), F.concat(F.lit("Host "), (F.col("id") % 20).cast("string")).alias("hostname"))
    c = spark.range(600).select(F.col("id").alias("tid"), F.concat(F.lit(" HOST "), (F.col("id") % 30).cast("string")).alias("name"))
    for df in (joins.by_host(p, c, "cand", "inner"), joins.by_similar_host(p, c, "cand")):
        rows = df.select("hostname", F.spark_partition_id().alias("part")).collect()
        assert len(rows) == 400 * 20
        # each host's pairs are in one task, and hosts are spread over many
        at = {r.hostname: r.part for r in rows}
        assert {(r.hostname, r.part) for r in rows} == set(at.items()) and len(set(at.values())) > 8


def test_pairs_of_a_repeated_host_come_in_runs_and_short_cycles(spark):
    """Files store these in little space; all of a host's 600 planets or candidates in turn they store in full."""
    p = spark.range(600).select(F.col("id").alias("row_idx"), F.lit("Host 1").alias("hostname"))
    c = spark.range(600).select(F.col("id").alias("tid"), F.lit("host 1").alias("name"))
    for df in (joins.by_host(p, c, "cand", "inner"), joins.by_similar_host(p, c, "cand")):
        rows = df.select("row_idx", "cand_tid").take(10000)
        assert max(len({r[k] for r in rows}) for k in (0, 1)) <= 256
        assert df.count() == 360000 == df.select("row_idx", "cand_tid").distinct().count()


@pytest.mark.parametrize("how", ["inner", "left", "right", "outer"])
def test_joins_in_blocks_keep_what_matches_nothing(spark, how):
    left = [(k, None if k % 11 == 0 else f"Host {k % 7}", k * 0.5) for k in range(700)]
    right = [(k, None if k % 13 == 0 else f" HOST {k % 9 + 2}") for k in range(600)]
    made = joins.by_host(spark.createDataFrame(left, "row_idx long, hostname string, `st.mass` double"), spark.createDataFrame(right, "tid long, name string"), "cand", how)
    assert made.columns == ["row_idx", "hostname", "st.mass", "cand_tid", "cand_name"]
    norm = lambda n: n and n.strip().lower()
    want = Counter((*a, *b) for a in left for b in right if a[1] and b[1] and norm(a[1]) == norm(b[1]))
    names = [{norm(x[1]) for x in side} for side in (left, right)]
    want.update((*a, None, None) for a in left if how in ("left", "outer") and (not a[1] or norm(a[1]) not in names[1]))
    want.update((None, None, None, *b) for b in right if how in ("right", "outer") and (not b[1] or norm(b[1]) not in names[0]))
    assert Counter(tuple(r) for r in made.collect()) == want


def test_edges_are_distinct_without_an_exchange_of_all_pairs(spark):
    schema = "{} string, alias_type string, alias_value string, ord struct<row: long, k: int>"
    # s1, p1 and s2, p2 share two aliases, the latter in unlike order; h belongs to all; x has a null entity
    stars = [("s1", "T", "1", (1, 0)), ("s1", "U", "1", (1, 1)), ("s1", "T", "2", (2, 0)), ("s1", "H", "h", (3, 0)), ("s2", "T", "3", (4, 0)), ("s2", "U", "3", (4, 1)), ("s2", "H", "h", (5, 0)), (None, "X", "x", (6, 0)), (None, "X", "y", (6, 1))]
    planets = [("p1", "T", "1", (1, 0)), ("p1", "U", "1", (1, 1)), ("p1", "N", "a", (1, 2)), ("p1", "H", "h", (1, 3)), ("p2", "U", "3", (4, 0)), ("p2", "T", "3", (4, 1)), ("p2", "H", "h", (4, 2)), ("s1", "T", "1", (9, 0)), ("s1", "T", "2", (9, 1))]
    want = set()
    for table in (stars, planets):
        want |= {(a[1], a[2], b[1], b[2]) for a in table for b in table if a[0] is not None and a[0] == b[0] and a[3] < b[3]}
    made = normalize.edges([(spark.createDataFrame(stars, schema.format("star_id")), "star_id"), (spark.createDataFrame(planets, schema.format("planet_id")), "planet_id")])
    got = [tuple(x) for x in made.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    # the branch of most pairs ends in its join
    plan = made._jdf.queryExecution().optimizedPlan()
    assert plan.nodeName() == "Union" and "Aggregate" not in plan.children().head().nodeName()


def test_edges_of_many_aliases_come_in_blocks(spark):
    def table(key, parts):
        rows = [(entity, "T", f"{name}{v}", (k, 0)) for entity, name, values in parts for k, v in enumerate(values)]
        return spark.createDataFrame(rows, f"{key} string, alias_type string, alias_value string, ord struct<row: long, k: int>"), key

    # p1 has its star's aliases in turn, p2 in the same order; those of s3 are its own
    many = range(300)
    stars = table("star_id", [("s1", "x", many), ("s2", "y", many), ("s3", "z", range(600))])
    planets = table("planet_id", [("p1", "x", many[::-1]), ("p2", "y", many)])
    made = normalize.edges([stars, planets])
    got = Counter((r.src_id, r.dst_id) for r in made.collect())
    want = {(f"{n}{i}", f"{n}{j}") for n, size in (("x", 300), ("y", 300), ("z", 600)) for i in range(size) for j in range(size) if i < j or (n == "x" and i > j)}
    assert set(got) == want and set(got.values()) == {1}
    # either end is one of a block's for as long as its pairs last
    rows = normalize.edges([table("star_id", [("s3", "z", range(600))])]).take(10000)
    assert len(rows) == 10000 and max(len({r[k] for r in rows}) for k in ("src_id", "dst_id")) <= 256


def test_monte_carlo_rows_of_one_partition_are_dealt(spark):
    df = spark.range(0, 1000, 1, 1).select(*(F.lit(1.0 + k).alias(p) for k, p in enumerate(montecarlo.PARAMETERS)), (F.col("id") % 3).cast("double").alias("st_tefferr1"))
    rows = montecarlo.monte_carlo(df).select("stellar_flux_s_std", F.spark_partition_id().alias("part")).collect()
    n = [sum(r.part == p for r in rows) for p in {r.part for r in rows}]
    assert len(rows) == 1000 and len(n) == 4 and max(n) < 400
    assert {r.stellar_flux_s_std for r in rows} == {0.0}


def test_wide_has_no_exchange_by_a_null_key(spark, sf_dir):
    """Most planets have no candidate, so an exchange by the candidate's number would bring them all to one task."""
    made = view(spark, sf_dir, "wide")
    joins_of = [j for j in made._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join LeftOuter" in j]
    assert len(joins_of) == 3 and sum("tid#" in j for j in joins_of) == 1 and any("coalesce(" in j or "row_idx" in j or "_key" in j for j in joins_of)
    assert made.count() == view(spark, sf_dir, "prim").count()


def test_measurements_of_one_partition_are_dealt(spark):
    df = spark.range(0, 1000, 1, 1).select(F.col("id").alias("_row_idx"), F.lit("s").alias("star_id"), F.col("id").cast("string").alias("planet_id"), F.rand(1).alias("pl_rade"), F.lit(1.0).alias("st_teff"))
    made = normalize.measurements(df)
    assert made.count() == 1001
    assert "RoundRobinPartitioning" in made._jdf.queryExecution().executedPlan().toString()


def test_pairs_of_ellipses_are_not_joined_with_their_rows_again(spark):
    p = spark.range(50).select(F.col("id").alias("l"), (F.col("id") / 100).alias("ra"), F.lit(0.0).alias("dec"))
    s = spark.range(20).select(F.col("id").alias("r"), (F.col("id") / 50).alias("ra"), F.lit(0.0).alias("dec"), F.lit(1e5).alias("ra_error"), F.lit(1e5).alias("dec_error"))
    made = motion.ellipse_pairs(p, motion.propagated(s, 0.0), left_id="l", right_id="r")
    assert made._jdf.queryExecution().optimizedPlan().toString().count("Join Inner") == 1
    want = {(k, n) for k in range(50) for n in range(20) if abs(k / 100 - n / 50) <= 3e5 / 3.6e6}
    assert {(x.l, x.r) for x in made.collect()} == want


def test_candidates_are_made_after_the_rows_of_an_object_came_together(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("o"), F.col("id").cast("double").alias("v"), F.lit("unused").alias("x"))
    rows = precedence.candidates(precedence.together(df, "o"), "s", "o", [precedence.Measured("m", "v"), precedence.Measured("n", "v")], "cast(v as long)")
    out = precedence.resolve(rows, ["s"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("RebalancePartitions") and "unused" not in plan
    assert {(r.object_id, r.parameter, r.value) for r in out.collect()} == {(k, m, float(k)) for k in range(10) for m in "mn"}


def _crowded(spark, n, first):
    """Sources about 0.13 arc seconds apart at the wrap of right ascension, at both poles and elsewhere."""
    step = 0.13 / 3600
    place = F.col("id") % 4
    dec = F.element_at(F.array(*map(F.lit, (0.0, 90 - 12 * step, -90 + 12 * step, 41.0))), (place + 1).cast("int")) + (F.col("id") * 37 % 23 - 11) * step
    ra = F.when(place.isin(1, 2), F.col("id") * 6.1 % 360).otherwise(F.when(place == 0, 359.99999).otherwise(200.0) + (F.col("id") * 53 % 29 - 14) * step)
    return spark.range(n).select((F.col("id") + first).alias("source_id"), F.pmod(ra, F.lit(360.0)).alias("ra"), dec.alias("dec"), F.when(F.col("id") % 7 != 0, F.col("id") + 0.5).alias("parallax"), F.when(F.col("id") % 5 != 0, F.col("id") % 3 + 10.0).alias("phot_g_mean_mag"))


def test_tier_of_positions_exchanges_the_catalog_once_and_never_broadcasts_it(spark):
    older, newer = _crowded(spark, 60, 2000000000), _crowded(spark, 400, 3000000000)
    wanted = older.filter("source_id % 4 != 3 or source_id % 8 = 3").select(F.col("source_id").alias("target_id"))
    made = tiers.by_position(wanted, older, newer)
    at = older.join(wanted, F.col("source_id") == F.col("target_id")).select("target_id", F.col("ra").alias("a"), F.col("dec").alias("d"), F.col("phot_g_mean_mag").alias("m"))
    pairs = newer.filter("parallax is not null").crossJoin(at).withColumn("sep", separation("ra", "dec", "a", "d")).filter("degrees(sep) <= 1.0 / 3600 and abs(m - phot_g_mean_mag) < 1")
    want = {r.target_id: (r.b.source_id, r.b.parallax, 0.8 if r.b.sep * 206264.80624709636 < 0.5 else 0.6) for r in pairs.groupBy("target_id").agg(F.min(F.struct("sep", "source_id", "parallax")).alias("b")).collect()}
    rows = made.collect()
    assert len(rows) == len(want) > 20 and {r.gaia_dr2_source_id: (r.gaia_dr3_source_id, r.parallax, r.match_quality) for r in rows} == want
    # one join with the catalog, of sorted rows; the targets are put into several cells, not the catalog
    plan = made._jdf.queryExecution().optimizedPlan()
    join = plan
    while not join.toString().startswith("Join Inner"):
        join = join.children().head()
    assert plan.toString().count("Join Inner") == 1 and "strategy=merge" in plan.toString()
    assert "Generate" not in join.left().toString() and "Generate" in join.right().toString()


def test_cascade_looks_up_positions_once(spark):
    older, newer = _crowded(spark, 60, 2000000000), _crowded(spark, 400, 3000000000)
    primary = older.select(F.concat(F.lit("Gaia DR2 "), F.col("source_id").cast("string")).alias("gaia_id"))
    plan = tiers.cascade(primary, newer, older)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 1


def test_cells_of_the_sky_are_not_broadcast(spark):
    p, s = _crowded(spark, 60, 0).withColumnRenamed("source_id", "_row_idx"), _crowded(spark, 400, 0).withColumnRenamed("source_id", "_src_idx")
    made = sky.within(p, s, 1.0)
    assert "SortMergeJoin [band" in made._jdf.queryExecution().executedPlan().toString()
