"""Queries of the subpackage that have SQL, against it."""

import pytest

from skyloom.llm.queries import ORACLE_SQL, QUERIES
from tests.oracle import connect, rows


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    folder = "/root/testdata/sf0.01"
    df, cursor = QUERIES[name](spark, folder), connect(folder).execute(ORACLE_SQL[name])
    names = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, df.collect()) == rows(names, cursor.fetchall())
