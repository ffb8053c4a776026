"""Comparison of a query with its DuckDB SQL."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def rows(names, values):
    """Sorted rows in the names' order, numbers as floats."""
    at = sorted(range(len(names)), key=lambda k: names[k])
    told = lambda v: v if v is None or isinstance(v, (str, bool)) else float(v) + 0.0
    return sorted(str([told(v[k]) for k in at]) for v in values)
