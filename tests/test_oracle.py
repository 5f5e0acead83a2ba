"""Every registered query against its DuckDB twin (the driver's gate), at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = ["documents", "pages"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(r[i] for i in order) for r in rows), key=repr)


SQL = E.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    a = canon(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(SQL[name])
    b = canon(rel.columns, rel.fetchall())
    assert a[0] == b[0]
    assert a[1] == b[1]


def test_every_query_without_oracle_runs(spark):
    for name in sorted(set(E.queries()) - set(SQL)):
        assert E.queries()[name](spark, SF_SMALL).count() > 0
