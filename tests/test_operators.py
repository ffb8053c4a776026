"""Edge frames with results by hand, and forms of one operator against each other."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.functions import astro, text
from skyloom.operators import columns, joins, missing, montecarlo, normalize, physics, profile, quality, sky, tiers, units

from skyloom.operators.quantiles import exact_quantiles, modes


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def one(df):
    return df.collect()[0]


def test_names_and_ids(spark):
    df = frame(spark, [("\t Kepler-22 B  ", "Gaia DR2 4295076295112340001"), ("  ", "123"), (None, None)], "n string, i string")
    got = df.select(text.norm_name("n").alias("a"), text.norm_name("n", True).alias("b"), text.parse_id("i").alias("c")).collect()
    assert [tuple(r) for r in got] == [("kepler-22 b", "kepler-22 b", 4295076295112340001), ("", "", None), (None, "nan", None)]


def test_null_keys_meet_only_in_compat(spark):
    left = frame(spark, [(1, None), (2, "Gaia DR2 4295076295112340001")], "k int, gaia_id string")
    right = frame(spark, [(None, 10), (None, 11), (4295076295112340001, 12), (4295076295112340002, 13)], "gaia_source_id long, v int")
    strict = joins.by_id(left, right, "g")
    assert sorted((r.k, r.g_v) for r in strict.collect()) == [(1, None), (2, 12)] or {(r.k, r.g_v) for r in strict.collect()} == {(1, None), (2, 12)}
    safe = joins.by_id(left, right, "g", compat=True, exact=True)
    assert {(r.k, r.g_v) for r in safe.collect()} == {(1, 10), (1, 11), (2, 12)}
    loose = joins.by_id(left, right, "g", compat=True)
    assert {(r.k, r.g_v) for r in loose.collect()} == {(1, 10), (1, 11), (2, 12), (2, 13)}


def test_unknown_strategy_and_missing_columns(spark):
    df = frame(spark, [(1,)], "a int")
    with pytest.raises(ValueError):
        joins.fold(df, [("x", df)], "no_such")
    with pytest.raises(columns.MissingColumns):
        physics.add_stellar_flux(df)


def _sky(spark):
    p = frame(spark, [(1, 0.0001, 10.0), (2, 359.9999, 10.0), (3, 120.0, 89.95), (4, None, 1.0), (5, 45.0, -89.95), (6, 200.0, 0.0)], "_row_idx long, ra double, dec double")
    s = frame(spark, [(1, 359.9999, 10.0), (2, 0.0001, 10.0), (3, 300.0, 89.9999), (4, 120.2, 89.95), (5, 200.0001, 0.0), (6, 199.9999, 0.0), (7, 46.0, -89.9499)], "_src_idx long, ra double, dec double")
    return p, s


@pytest.mark.parametrize("compat", [False, True])
@pytest.mark.parametrize("arcsec", [0.5, 3.0, 100.0, 4000.0])
def test_grid_equals_all_pairs(spark, compat, arcsec):
    p, s = _sky(spark)
    a, b = (sorted(map(tuple, sky.nearest(p, s, arcsec, compat, form).collect())) for form in ("broadcast", "grid"))
    assert a == b


def test_nearest_tie_goes_to_the_smaller_id(spark):
    p, s = _sky(spark)
    assert {r._row_idx: r._src_idx for r in sky.nearest(p, s, 3.0, form="grid").collect()}[6] in (5, 6)
    q = frame(spark, [(9, 10.0, 0.0)], "_row_idx long, ra double, dec double")
    t = frame(spark, [(2, 10.0, 0.0001), (1, 10.0, 0.0001)], "_src_idx long, ra double, dec double")
    assert one(sky.nearest(q, t, 3.0, form="grid"))._src_idx == 1


def test_compat_reaches_further(spark):
    p = frame(spark, [(1, 10.0, 0.0)], "_row_idx long, ra double, dec double")
    s = frame(spark, [(1, 10.0, 0.02)], "_src_idx long, ra double, dec double")
    assert sky.nearest(p, s, 3.0).count() == 0 and sky.nearest(p, s, 3.0, compat=True).count() == 1


def test_luminosity_and_zone_order(spark):
    df = frame(spark, [(-0.3,), (0.0,), (0.3,), (None,)], "l double")
    assert [r[0] for r in df.select(astro.linear_luminosity("l")).collect()] == [pytest.approx(10**-0.3), 1.0, 0.3, None]
    star = frame(spark, [(5780.0, 1.0)], "st_teff double, st_lum double")
    r = one(physics.add_hz_edges(physics.add_hz_edges(star), optimistic=True))
    assert r.hz_opt_inner < r.hz_inner < r.hz_outer < r.hz_opt_outer
    assert r.hz_inner == pytest.approx(1 / math.sqrt(1.107))
    with pytest.raises(KeyError):
        astro.hz_flux("st_teff", "NoSuchLimit")


def test_physics_of_zero_and_negative(spark):
    df = frame(spark, [(0.0, 0.0, 0.0, 1.0), (1.0, 1.0, 1.0, 1.0), (-1.0, -1.0, -1.0, 1.0)], "pl_orbsmax double, pl_rade double, pl_masse double, st_lum double").withColumns({"st_teff": F.lit(5780.0), "st_rad": F.lit(1.0)})
    got = physics.add_escape_velocity(physics.add_surface_gravity(physics.add_equilibrium_temperature(physics.add_stellar_flux(df)))).collect()
    assert got[0].stellar_flux_s is None and got[0].surface_gravity is None and got[0].escape_velocity is None and got[0].equilibrium_temperature is None
    assert got[1].surface_gravity == pytest.approx(9.82, abs=0.01) and got[1].escape_velocity == pytest.approx(11.186, abs=0.01)
    assert got[2].equilibrium_temperature is None and got[2].surface_gravity is None


def test_range_checks(spark):
    rows = [(-1.0, 1.0, 1.0, -0.1), (2e5, 4.0, 1.0, 1.0), (2e5, 4.0, None, 0.5), (5e8, None, None, None), (10.0, 0.0, 0.0, 0.0)]
    got = units.range_checks(frame(spark, rows, "pl_orbper double, pl_orbsmax double, st_mass double, pl_orbeccen double")).collect()
    assert [r.pl_orbper for r in got] == [None, pytest.approx(8 * 365.25), 2e5, None, 10.0]
    assert [r.pl_orbper_flag_invalid for r in got] == [True, False, False, True, False]
    assert [r.pl_orbper_corrected for r in got] == ["", "kepler_third_law", "", "capped_unphysical", ""]
    assert [r.pl_orbeccen for r in got] == [None, None, 0.5, None, 0.0]


def test_errors(spark):
    df = frame(spark, [(2.0, -4.0), (2.0, None), (None, -4.0), (None, None), (0.0, -4.0)], "a double, b double")
    got = df.select(montecarlo.sigma(F.col("a"), F.col("b")), normalize.err_measurement(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [(3.0, 3.0), (2.0, 2.0), (4.0, 2.0), (0.0, None), (4.0, 2.0)]


def test_monte_carlo_against_a_generator_a_row(spark):
    rows = []
    for mask in range(64):
        values = [5000.0, 0.8, 1.1, 0.9, 1.5, 3.0]
        rows.append(tuple(v if mask >> k & 1 else None for k, v in enumerate(values)) + (100.0, -50.0, 0.4))
    df = frame(spark, rows, ", ".join(f"{p} double" for p in montecarlo.PARAMETERS) + ", st_tefferr1 double, st_tefferr2 double, pl_radeerr1 double")
    got = montecarlo.monte_carlo(df, samples=200).collect()
    for r in got:
        rng = np.random.default_rng(42)
        sd = {"st_teff": 75.0, "pl_rade": 0.4}
        d = [rng.normal(r[p], sd.get(p, 0.0), 200) if r[p] is not None else np.full(200, np.nan) for p in montecarlo.PARAMETERS]
        rp, mp = np.where(d[4] > 0, d[4], np.nan), np.where(d[5] > 0, d[5], np.nan)
        g = astro.G * mp * astro.M_EARTH / (rp * astro.R_EARTH) ** 2
        want = [np.mean, np.std, np.median, lambda x: np.quantile(x, 0.16), lambda x: np.quantile(x, 0.84)]
        g = g[~np.isnan(g)]
        for s, f in zip(montecarlo.STATS, want, strict=True):
            have = r[f"surface_gravity_{s}"]
            assert have is None if not len(g) else have == pytest.approx(float(f(g)), rel=1e-12)


def test_quality_boundaries(spark):
    df = frame(spark, [("1.4",), ("2.0",), ("2.0001",), (None,), ("text",)], "x_ruwe string")
    assert [r.astrometry_quality_flag for r in quality.add_ruwe_class(df).collect()] == ["good", "suspect", "poor", None, None]
    flags = quality.add_gaia_flags(frame(spark, [(1.4, 5.0, 1.0), (1.39, 5.1, 1.0), (None, 5.0, 0.0)], "ruwe double, parallax double, parallax_error double")).collect()
    assert [(r.astrometry_quality, r.parallax_quality) for r in flags] == [("poor", "poor"), ("good", "good"), ("unknown", "unknown")]
    none = one(quality.add_crossmatch_quality(frame(spark, [(1,)], "a int")))
    assert (none.crossmatch_quality, none.crossmatch_score) == ("unmatched_dr2_only", 0.0)
    null = one(quality.add_crossmatch_quality(frame(spark, [(True, 1, None, None)], "ambiguity_flag boolean, gaia_dr3_source_id long, angular_separation double, ruwe double")))
    assert (null.crossmatch_quality, null.crossmatch_score) == ("neighbourhood_tie", 1.0)
    assert one(quality.add_gaia_score(frame(spark, [(None, None, 1.0)], "ruwe double, parallax double, parallax_error double"))).overall_quality_score == 1.0


def test_imputation_and_sparse_columns(spark):
    df = frame(spark, [(1.0, None, "b"), (3.0, None, "a"), (None, 1.0, None)], "x double, y double, z string")
    assert [r.x for r in missing.impute(df, "mean").collect()][2] == 2.0
    assert [r.z for r in missing.impute(df, "mode").collect()][2] == "a"
    assert missing.impute(df, "no_such").collect() == df.collect()
    assert missing.drop_sparse(df).columns == ["x", "z"] and missing.drop_sparse(df).count() == 2
    assert missing.drop_sparse(df.limit(0)).columns == df.columns
    empty = missing.impute(df.select(F.lit(None).cast("double").alias("e")), "mode")
    assert {r.e for r in empty.collect()} == {0.0}


@pytest.mark.parametrize("small", [3, 40, 10**6])
def test_quantiles_are_exact_however_small_the_band(spark, small):
    draw = np.random.default_rng(1)
    x = np.concatenate([draw.standard_normal(500), np.full(300, 0.25), [1e9, -1e9]])
    df = frame(spark, [(float(v), None) for v in x], "x double, e double")
    got = exact_quantiles(df, ["x", "e"], [0.0, 0.16, 0.5, 0.75, 1.0], small, few=small)
    assert got["x"] == pytest.approx(list(np.quantile(x, [0.0, 0.16, 0.5, 0.75, 1.0])), rel=1e-12)
    assert got["e"] == [None] * 5 and modes(df, ["x", "e"]) == {"x": 0.25, "e": None}


def test_modes_of_mixed_types(spark):
    df = frame(spark, [("a", 1, None), ("b", 2, None), ("b", 1, None), ("a", (1 << 60) + 1, None), (None, (1 << 60) + 1, None), ("c", (1 << 60) + 1, None)], "s string, `n.x` long, e double")
    assert modes(df, ["s", "n.x", "e"]) == {"s": "a", "n.x": (1 << 60) + 1, "e": None} and modes(df, []) == {}


def test_narrowing_keeps_values(spark):
    df = frame(spark, [(1, 0.5, 1 << 40), (-128, 0.1, 0)], "a long, b double, c long")
    got = missing.narrow_types(df.select("a", "c", F.when(F.col("b") == 0.5, 0.25).otherwise(0.5).alias("b"), F.col("b").alias("d")))
    assert dict(got.dtypes) == {"a": "tinyint", "c": "bigint", "b": "float", "d": "double"}


def test_tables_without_aliases_are_empty_and_typed(spark):
    df = frame(spark, [(0, 1.0)], "_row_idx long, st_teff double")
    out = normalize.entity_tables(df)
    assert out["star_aliases"].count() == 0 and out["xmatch_edges"].columns == list(normalize.EDGE_COLUMNS) and out["xmatch_edges"].count() == 0
    assert out["measurements"].count() == 1 and out["derived_features"].count() == 0


def test_null_star_has_no_edges(spark):
    df = frame(spark, [(0, None, "p", 1, 2)], "_row_idx long, star_id string, planet_id string, tic_id long, kic_id long")
    assert normalize.stars(df).count() == 1
    assert normalize.edges([(normalize.star_aliases(df, with_order=True), "star_id")]).count() == 0
    assert [tuple(r) for r in normalize.edges([(normalize.planet_aliases(df, with_order=True), "planet_id")]).collect()] == [("TIC", "1", "KIC", "2")]


def test_tiers_prefer_the_first(spark):
    primary = frame(spark, [("Gaia DR2 1000000001",), ("Gaia DR2 1000000002",), ("Gaia DR2 1000000003",), (None,)], "gaia_id string")
    schema = "source_id long, ra double, dec double, parallax double, phot_g_mean_mag double"
    newer = frame(spark, [(1000000001, 1.0, 1.0, 5.0, 10.0), (77, 2.0, 2.0, 4.0, 11.2)], schema)
    older = frame(spark, [(1000000001, 1.0, 1.0, 5.0, 10.0), (1000000002, 2.0, 2.0001, 4.0, 11.0), (1000000003, 9.0, 9.0, 3.0, 9.0)], schema)
    got = {r.gaia_dr2_source_id: (r.gaia_dr3_source_id, r.match_quality) for r in tiers.cascade(primary, newer, older).collect()}
    assert got == {1000000001: (1000000001, 1.0), 1000000002: (77, 0.8), 1000000003: (None, 0.4)}


def test_tier_of_positions_takes_the_nearest_of_like_magnitude(spark):
    primary = frame(spark, [("Gaia DR2 1000000002",)], "gaia_id string")
    schema = "source_id long, ra double, dec double, parallax double, phot_g_mean_mag double"
    near = [(76, 0.1, None), (77, 0.2, 15.0), (78, 0.6, 11.3), (79, 0.7, 11.1), (80, 1.2, 11.0)]
    newer = frame(spark, [(k, 2.0, 2.0 + s / 3600, 4.0, m) for k, s, m in near], schema)
    older = frame(spark, [(1000000002, 2.0, 2.0, 4.0, 11.0)], schema)
    got = one(tiers.cascade(primary, newer, older))
    assert (got.gaia_dr3_source_id, got.data_source, got.match_quality) == (78, "DR3_crossmatch", 0.6)


def test_profiles_of_empty_tables(spark):
    df = frame(spark, [], "a string, b double")
    assert {r.column: r.n_rows for r in profile.profile_columns(df).collect()} == {"a": 0, "b": 0}
    assert one(profile.duplicate_rows(df)).n_duplicates == 0
    assert profile.report({"t": df})["total_rows"] == 0
    assert one(profile.validate(df, data_types=False, hz_columns=False)).passed
