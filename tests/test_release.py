"""What a release needs besides the merge: against brute force in plain Python or numpy."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.operators import drift, forest, joins, motion, names, precedence, rules, sky
from skyloom.plans import pipeline


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def _misspelt(draw, n):
    """Names with repeated grams, changed, cut and lengthened here and there."""
    base = ["kepler-22 b", "aaaaaaaaaa", "abababababab", "HD 189733", "é Eridani", "x", "xy", "GJ 1214", "proxima centauri", "trappist-1 " * 4]
    out = []
    for _ in range(n):
        s = list(draw.choice(base))
        for _ in range(draw.randrange(4)):
            k = draw.randrange(len(s) + 1)
            draw.choice([lambda: s.insert(k, draw.choice("ab1 é")), lambda: s and s.pop(min(k, len(s) - 1)), lambda: s.__setitem__(min(k, len(s) - 1), draw.choice("abc2")) if s else None])()
        out.append("".join(s))
    return [*out, None, "", "  ", "\t HD 189733 "]


@pytest.mark.parametrize("threshold, q", [(0.8, 2), (0.9, 2), (0.6, 2), (0.8, 3), (1.0, 2)])
def test_similar_names_are_those_of_brute_force(spark, threshold, q):
    draw = random.Random(4)
    left, right = _misspelt(draw, 150), _misspelt(draw, 120)
    norm = lambda names: {n.strip().lower() for n in names if n and n.strip()}
    want = {(a, b, levenshtein(a, b)) for a in norm(left) for b in norm(right) if max(len(a), len(b)) - levenshtein(a, b) >= threshold * max(len(a), len(b)) - 1e-9}
    one, two = (spark.createDataFrame([(n,) for n in x], "n string") for x in (left, right))
    got = names.similar_pairs(one, two, "n", "n", threshold, q)
    rows = [tuple(r)[:3] for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want
    assert "NestedLoop" not in got._jdf.queryExecution().toString() and "CartesianProduct" not in got._jdf.queryExecution().toString()


def test_names_too_unlike_for_grams_are_refused(spark):
    with pytest.raises(ValueError):
        names.similar_pairs(spark.range(1), spark.range(1), F.lit("a"), F.lit("a"), 0.5)


def test_hosts_meet_the_most_similar(spark):
    p = spark.createDataFrame([(1, "Kepler-22"), (2, "HD 18973"), (3, "nobody"), (4, None), (5, "HD 18973")], "row_idx long, hostname string")
    s = spark.createDataFrame([(10, "kepler-22 "), (11, "Kepler-2"), (12, "HD 189733"), (13, "HD 189734"), (14, None), (15, "HD 189733")], "sid long, hostname string")
    got = sorted(map(tuple, joins.by_similar_host(p, s, "s").select("row_idx", "s_sid", F.round("s_name_similarity", 3)).collect()), key=str)
    assert got == [(1, 10, 1.0), (2, 12, 0.889), (2, 15, 0.889), (3, None, None), (4, None, None), (5, 12, 0.889), (5, 15, 0.889)]
    merged = pipeline.join_all(p, {"s": s}, pipeline.Spec((pipeline.Catalog("s", "similar_hostname", similarity=0.95),)))
    assert merged.filter("s_sid is not null").count() == 1


def _best(rows, order, sigmas=3.0, share=0.05):
    """Plain version of the choice for one object and parameter; rows of (source, value, error, date, tie)."""
    place = lambda s: order.index(s) if s in order else len(order)
    key = lambda r: (place(r[0]), math.inf if r[2] is None else r[2], math.inf if r[3] is None else -r[3].timestamp(), r[4])
    spoken = {}
    for r in sorted(rows, key=key):
        spoken.setdefault(r[0] if r[0] in order else None, r)
    spoken = sorted(spoken.values(), key=key)
    won, off = spoken[0], []
    for s in spoken[1:]:
        limit = share * abs(won[1]) if s[2] is None or won[2] is None else sigmas * math.hypot(s[2], won[2])
        off += [s[0]] if abs(s[1] - won[1]) > limit else []
    return won[1], won[2], won[0], len(spoken), off


def test_precedence_chooses_and_tells_who_disagrees(spark):
    from datetime import datetime, timedelta

    draw, start = random.Random(5), datetime(2020, 1, 1)
    rows = [(draw.randrange(40), draw.choice(["a", "b", "c", "new", None]), draw.choice(["t", "m"]), draw.choice([10.0, 10.2, 14.0]), draw.choice([None, 0.1, 0.5]), draw.choice([None, start, start + timedelta(1)]), k) for k in range(900)]
    df = spark.createDataFrame([*rows, (None, "a", "t", 1.0, None, None, 0), (1, "a", "t", None, None, None, 0), (1, "a", "t", float("nan"), None, None, 0)], "object_id long, source string, parameter string, value double, error double, date timestamp, tie long")
    got = precedence.resolve(df, ["b", "a", "c"], {"m": ["c"]}).collect()
    assert len(got) == len({r[:1] + r[2:3] for r in rows})
    for r in got:
        own = [(x[1], *x[3:]) for x in rows if x[0] == r.object_id and x[2] == r.parameter]
        want = _best(own, ["c", "b", "a"] if r.parameter == "m" else ["b", "a", "c"])
        assert (r.value, r.error, r.source, r.n_sources, r.disagreeing) == want and r.conflict == bool(want[4])


def test_precedence_is_one_aggregate(spark):
    df = spark.createDataFrame([], "object_id long, source string, parameter string, value double, error double, date timestamp, tie long")
    plan = precedence.resolve(df, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hash") == 1 and "Join" not in plan and precedence.resolve(df, ["a"]).collect() == []


def test_equal_neighbours_are_ambiguous(spark):
    second = 1 / 3600
    p = spark.createDataFrame([(1, 10.0, 20.0), (2, 50.0, 89.9999), (3, 200.0, -30.0), (4, None, 1.0)], "row_idx long, ra double, dec double")
    s = spark.createDataFrame([(1, 10.0 + second / math.cos(math.radians(20)), 20.0), (2, 10.0 - second / math.cos(math.radians(20)), 20.0), (3, 50.0, 89.9999), (4, 230.0, 89.998), (5, 200.0, -30.0 + 0.1 * second), (6, 200.0, -30.0 + 2.5 * second), (7, 200.0, -30.0 - 2.9 * second)], "src_idx long, ra double, dec double")
    got = {r.row_idx: r for r in sky.ambiguity(p, s, left_id="row_idx", right_id="src_idx").collect()}
    assert got[1].ambiguous and (got[1].src_idx, got[1].second_id) == (1, 2) and got[1].sep == pytest.approx(got[1].second_sep)
    assert not got[3].ambiguous and (got[3].src_idx, got[3].second_id) == (5, 6) and got[3].reliability > 0.99
    assert not got[2].ambiguous and got[2].src_idx == 3 and got[2].second_id is None and 4 not in got
    pairs = spark.createDataFrame([(1, k, k % 7 / 10) for k in range(5000)], "l long, r long, sep double")
    assert [tuple(x) for x in sky.k_nearest(pairs, 3, "l", "r").first().near] == [(0.0, 0), (0.0, 7), (0.0, 14)]
    plan = sky.k_nearest(pairs, 3, "l", "r")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("degrees", [1.0, 7.0, 30.0])
def test_sky_cells_cover_the_sphere(spark, degrees):
    draw = np.random.default_rng(1)
    at = spark.createDataFrame([(float(a), float(d)) for a, d in zip(draw.uniform(-400, 800, 3000), np.degrees(np.arcsin(draw.uniform(-1, 1, 3000))), strict=True)] + [(0.0, 90.0), (359.999, -90.0), (360.0, 0.0)], "ra double, dec double")
    cells = at.select(*(c.alias(n) for c, n in zip(sky.cell_of(F.col("ra"), F.col("dec"), degrees), ("band", "cell", "area"), strict=True))).distinct().collect()
    assert len({(r.band, r.cell) for r in cells}) == len(cells) and all(r.area > 0 and r.cell >= 0 for r in cells)
    if degrees == 30.0:  # each cell was hit
        assert sum(r.area for r in cells) == pytest.approx(4 * math.pi)


def _stars(n=40, seed=2):
    draw = np.random.default_rng(seed)
    x = np.stack([draw.uniform(0, 360, n), np.degrees(np.arcsin(draw.uniform(-1, 1, n))), draw.uniform(1, 800, n), draw.normal(0, 5000, n), draw.normal(0, 5000, n)], 1)
    x[0, 1], x[1, 1], x[2, :2] = 90.0, -89.99999, (359.99999, 0.0)
    a = draw.normal(0, 1, (n, 5, 5))
    return x, a @ a.transpose(0, 2, 1), draw.normal(0, 100, n)


def _space(x, rv, t):
    """Direction, parallax and motion after ``t`` years by uniform motion in space, in plain vectors."""
    ra, dec, plx = math.radians(x[0]), math.radians(x[1]), x[2] * motion.MAS
    p, q, r = np.array([-math.sin(ra), math.cos(ra), 0]), np.array([-math.sin(dec) * math.cos(ra), -math.sin(dec) * math.sin(ra), math.cos(dec)]), np.array([math.cos(dec) * math.cos(ra), math.cos(dec) * math.sin(ra), math.sin(dec)])
    v = p * x[3] * motion.MAS + q * x[4] * motion.MAS + r * rv * x[2] / motion.KM_S * motion.MAS
    b = r + v * t
    far = np.linalg.norm(b)
    u = b / far
    return u, plx / far, (v - u * (u @ v)) / far, (p, q, r)


def test_motion_is_uniform_in_space_and_carries_its_covariance():
    x, cov, rv = _stars()
    t = np.linspace(-100, 400, len(x))
    new, out = motion.moved(x, cov, rv, t)
    for k in range(len(x)):
        u, plx, mu, _ = _space(x[k], rv[k], t[k])
        ra, dec = math.radians(new[k, 0]), math.radians(new[k, 1])
        east, north = np.array([-math.sin(ra), math.cos(ra), 0]), np.array([-math.sin(dec) * math.cos(ra), -math.sin(dec) * math.sin(ra), math.cos(dec)])
        assert np.allclose([math.cos(dec) * math.cos(ra), math.cos(dec) * math.sin(ra), math.sin(dec)], u, atol=1e-12)
        assert np.allclose(new[k, 2:], [plx / motion.MAS, east @ mu / motion.MAS, north @ mu / motion.MAS], rtol=1e-8, atol=1e-6)
        # derivatives by differences, the old position turned about the frame's axes so that poles are no exception
        jac = np.zeros((5, 5))
        for c, step in enumerate((1e-6, 1e-6, 1e-9, 1e-9, 1e-9)):
            ends = []
            for sign in (1, -1):
                _, _, _, (p, q, r) = _space(x[k], rv[k], 0.0)
                d, y = sign * step, x[k].copy()
                if c >= 2:
                    y[c] += d / motion.MAS
                vel = [y[3] * motion.MAS, y[4] * motion.MAS, rv[k] * y[2] / motion.KM_S * motion.MAS]
                if c == 0:
                    p, r = p * math.cos(d) - r * math.sin(d), r * math.cos(d) + p * math.sin(d)
                if c == 1:
                    q, r = q * math.cos(d) - r * math.sin(d), r * math.cos(d) + q * math.sin(d)
                v = p * vel[0] + q * vel[1] + r * vel[2]
                b = r + v * t[k]
                far = np.linalg.norm(b)
                w = b / far
                ends.append(np.array([east @ w, north @ w, y[2] * motion.MAS / far, east @ ((v - w * (w @ v)) / far), north @ ((v - w * (w @ v)) / far)]))
            jac[:, c] = (ends[0] - ends[1]) / (2 * step)
        assert np.allclose(out[k], jac @ cov[k] @ jac.T, rtol=2e-4, atol=1e-4 * np.abs(out[k]).max())


def test_propagated_columns(spark):
    rows = [(1, 10.0, 20.0, 100.0, 50.0, None, 1.0, 2.0), (2, None, 20.0, 100.0, 50.0, 1.0, 1.0, 2.0), (3, 0.0, 90.0, None, 0.0, 0.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "src_idx long, ra double, dec double, parallax double, pmra double, pmdec double, ra_error double, dec_error double")
    got = {r.src_idx: r for r in motion.propagated(df, 10.0).collect()}
    assert got[2].ra_epoch is None and got[2].ellipse_major is None
    assert got[3].dec_epoch == 90.0 and got[3].ellipse_major == 0.0
    assert got[1].ra_epoch == pytest.approx(10 + 500 / 3.6e6 / math.cos(math.radians(20)), abs=1e-9) and (got[1].ellipse_major, got[1].ellipse_minor) == pytest.approx((2.0, 1.0), rel=1e-6)
    assert got[1].ellipse_angle == pytest.approx(0.0, abs=1e-3) or got[1].ellipse_angle == pytest.approx(180.0, abs=1e-3)
    assert motion.propagated(df.limit(0), 1.0).collect() == []


def test_rows_match_within_their_own_ellipse(spark):
    draw = np.random.default_rng(6)
    n = 300
    ra, dec = draw.uniform(0, 360, n), np.concatenate([np.degrees(np.arcsin(draw.uniform(-1, 1, n - 40))), draw.uniform(89.9, 90, 20), draw.uniform(-90, -89.9, 20)])
    size = 10 ** draw.uniform(1, 8.6, n)  # from 10 mas to over 100 degrees
    s = spark.createDataFrame([(k, float(a), float(d), float(e), float(e * draw.uniform(0.2, 1)), float(draw.uniform(-0.9, 0.9))) for k, (a, d, e) in enumerate(zip(ra, dec, size, strict=True))], "src_idx long, ra double, dec double, ra_error double, dec_error double, ra_dec_corr double")
    off = draw.normal(0, 1.5, (n, 2)) * size[:, None] / 3.6e6
    p_dec = np.clip(dec + off[:, 1], -90, 90)
    p = spark.createDataFrame([(k, float(a), float(d)) for k, (a, d) in enumerate(zip(ra + off[:, 0] / np.maximum(np.cos(np.radians(dec)), 1e-3), p_dec, strict=True))], "row_idx long, ra double, dec double")
    told = motion.propagated(s, 0.0)
    got = {(r.row_idx, r.src_idx): r.distance2 for r in motion.ellipse_pairs(p, told, 2.0, left_id="row_idx", right_id="src_idx").collect()}
    want = {}
    at = [(r.row_idx, math.radians(r.ra), math.radians(r.dec)) for r in p.collect()]
    for r in told.collect():
        a0, d0, e1, e2, c = math.radians(r.ra_epoch), math.radians(r.dec_epoch), r.ra_error_epoch, r.dec_error_epoch, r.ra_dec_corr_epoch
        inverse = np.linalg.inv([[e1 * e1, c * e1 * e2], [c * e1 * e2, e2 * e2]])
        for k, a, d in at:
            sep = 2 * math.asin(min(1, math.sqrt(math.sin((d - d0) / 2) ** 2 + math.cos(d) * math.cos(d0) * math.sin((a - a0) / 2) ** 2)))
            v = np.array([math.cos(d) * math.sin(a - a0), math.sin(d) * math.cos(d0) - math.cos(d) * math.sin(d0) * math.cos(a - a0)]) / motion.MAS
            if sep <= 2.0 * r.ellipse_major * motion.MAS and v @ inverse @ v <= 4.0:
                want[k, r.src_idx] = v @ inverse @ v
    sure = {k for k, v in want.items() if v < 4 - 1e-6}
    assert sure <= set(got) <= set(want) and len(want) > 300 and all(got[k] == pytest.approx(want[k], rel=1e-5, abs=1e-6) for k in got)


def test_rules_tell_what_a_row_breaks(spark):
    cols = "pl_orbsmax double, pl_orbeccen double, pl_masse double, pl_rade double, st_mass double, st_rad double, st_teff double, st_lum double, pl_orbper double, st_age double, pl_radeerr1 double, pl_radeerr2 double"
    rows = [(1.0, 0.0, 1.0, 1.0, 1.0, 1.0, 5800.0, 0.0, 365.0, 4.6, 0.1, -0.1), (0.001, 0.0, 1.0, 10.0, 1.0, 1.0, 100.0, 3.0, 3.0, 4.6, 6.0, -0.1), (None,) * 12, (1.0, 0.9, -1.0, 1.0, 5.0, -2.0, 5800.0, 2.4, 2.0, 12.0, None, -0.9)]
    checks = [*rules.CONSISTENCY, *rules.from_config({"max_fractional_uncertainty": {"pl_rade": 0.5}, "min_required_columns": ["pl_rade"], "ranges": {"absent": [0, 1]}})]
    df = rules.check(spark.createDataFrame(rows, cols), checks)
    assert [r.violations for r in df.collect()] == [
        [],
        ["realistic_temperatures", "hill_sphere", "roche_limit", "main_sequence_consistency", "uncertainty_pl_rade"],
        ["required_pl_rade"],
        ["positive_masses", "positive_radii", "tidal_circularization", "age_mass_relation", "uncertainty_pl_rade"],
    ]
    told = {r.rule: (r.n_rows, r.n_broken) for r in rules.summary(df, rules.applicable(df, checks)).collect()}
    assert told["positive_masses"] == (4, 1) and told["required_pl_rade"] == (4, 1) and "range_absent" not in told
    assert rules.check(spark.range(1), checks).first().violations == []


def test_drift_is_near_the_exact_distances(spark):
    draw = np.random.default_rng(3)
    old = {"same": draw.normal(0, 1, 20_000), "moved": draw.normal(0, 1, 20_000), "few": draw.integers(0, 3, 20_000).astype(float)}
    new = {"same": draw.normal(0, 1, 30_000), "moved": draw.normal(0.5, 1, 30_000), "few": draw.integers(0, 2, 30_000).astype(float)}
    frame = lambda v: spark.createDataFrame(list(zip(*(c.tolist() for c in v.values()), strict=True)), ", ".join(f"{c} double" for c in v)).withColumn("part", F.pmod(F.hash("same"), F.lit(5)))
    parts = [drift.merged(drift.sketches(frame(v), v, name, ["part"])) for v, name in ((old, "old"), (new, "new"))]
    got = {r.column: r for r in drift.compare(*parts).collect()}
    for c in old:
        at = np.sort(np.concatenate([old[c], new[c]]))
        gap = np.abs(np.searchsorted(np.sort(old[c]), at, side="right") / 20_000 - np.searchsorted(np.sort(new[c]), at, side="right") / 30_000).max()
        assert got[c].largest_gap == pytest.approx(gap, abs=0.02) and (got[c].n_old, got[c].n_new) == (20_000, 30_000)
    assert got["moved"].mean_shift == pytest.approx(0.5, abs=0.05) and got["same"].stability < 0.01 < 0.1 < got["moved"].stability
    empty = drift.sketches(spark.createDataFrame([(None,), (float("nan"),)], "a double"), ["a"], "x")
    assert [(r.n, r.n_null, r.sketch) for r in empty.collect()] == [(0, 2, None)] and drift.compare(empty, empty).collect() == []


def test_forest_finds_planted_outliers_and_scores_as_a_plain_walk(spark):
    draw = np.random.default_rng(4)
    x = np.concatenate([draw.normal(0, 1, (3000, 4)), draw.normal(0, 1, (30, 4)) + 9])
    x[::50, 1] = np.nan
    df = spark.createDataFrame([(k, *(None if math.isnan(v) else float(v) for v in r)) for k, r in enumerate(x)], "id long, a double, b double, c double, d double")
    made = forest.fit(df, "abcd", "id")
    got = {r.id: r.anomaly_score for r in forest.scored(df, made).collect()}
    assert set(sorted(got, key=got.get)[-30:]) == set(range(3000, 3030)) and len(got) == 3030

    def walk(row, node):
        depth = 0
        while made.feature[node] >= 0:
            node = made.left[node] + int(row[made.feature[node]] >= made.cut[node])
            depth += 1
        return made.depth[node], depth

    for k in (0, 1, 50, 3001):
        row = np.where(np.isnan(x[k]), made.medians, x[k])
        ends = [walk(row, n) for n in made.roots]
        assert got[k] == pytest.approx(2 ** (-np.mean([d for d, _ in ends]) / forest.expected_depth(256))) and all(d >= steps for d, steps in ends)
    share = forest.flagged(df, made).filter("is_outlier").count() / 3030
    assert 0.04 < share < 0.06
    assert forest.fit(df.limit(0), "abcd", "id") is None
    same = forest.fit(spark.range(500).selectExpr("7 as id", "1.0 as a"), ["a"], "id")
    assert same.score(np.array([[1.0], [5.0]])).tolist() == [0.5, 0.5]
