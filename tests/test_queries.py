"""Every query with SQL equals it on the smallest tables."""

import os

import duckdb
import pytest

from gridmill import queries

DATA = "/root/testdata/sf0.001"


def rows(columns, data):
    def norm(v):
        if isinstance(v, float):
            return f"{v:.9g}"
        return "null" if v is None else str(v)

    return sorted(tuple(norm(r[columns.index(c)]) for c in sorted(columns)) for r in data)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{DATA}/{f}')")
    df = queries.QUERIES[name](spark, DATA)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    want = con.execute(queries.ORACLE[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows(columns, want.fetchall())
