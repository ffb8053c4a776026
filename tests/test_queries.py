import pytest

from skyloom.release_queries import ORACLE_SQL, QUERIES

from .oracle import connect, rows


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    cursor = connect(sf_dir).execute(ORACLE_SQL[name])
    names = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, df.collect()) == rows(names, cursor.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_without_sql_has_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry_has_a_stable_schema(spark):
    import __spark_entry__ as e

    first, again = e.entry(spark), e.entry(spark)
    assert first.schema == again.schema and first.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("how", ["inner", "left", "right", "outer"])
def test_whole_joins_keep_every_row(spark, tmp_path, how):
    spark.createDataFrame([(k,) for k in (1, 2, 3, 6)], "c_custkey long").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(1, 1), (2, 3), (3, 3), (4, 9), (5, 9)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    both, left, right = {(1, 1), (3, 2), (3, 3)}, {(2, None), (6, None)}, {(None, 4), (None, 5)}
    want = both | (left if how in ("left", "outer") else set()) | (right if how in ("right", "outer") else set())
    got = [tuple(r) for r in QUERIES[f"join_{how}"](spark, str(tmp_path)).collect()]
    assert len(got) == len(want) and set(got) == want


def test_separation_of_all_pairs_of_the_cone(spark, sf_dir):
    matched = {r.row_idx for r in QUERIES["cone_match_grid_compat"](spark, sf_dir).filter("sec_src_idx is not null").collect()}
    assert {r.row_idx for r in QUERIES["angular_separation"](spark, sf_dir).collect()} == matched and matched


def test_folders_of_queries_can_be_cleaned(spark, sf_dir):
    import os

    from skyloom import queries

    df = QUERIES["csv_roundtrip"](spark, sf_dir)
    path = queries._made[-1]
    assert df.count() and os.path.exists(path)
    queries.clean(spark)
    assert not os.path.exists(path) and not queries._made
