"""Every query with SQL against DuckDB, row by row."""

import math
import os

import duckdb
import pytest

from commitloom.plans import queries

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{name}'")
    return con


def rows(df):
    def plain(v):
        if v is None or isinstance(v, float) and math.isnan(v):
            return ""
        return f"{float(v):.6f}" if isinstance(v, (int, float)) or hasattr(v, "dtype") and v.dtype.kind in "if" else str(v)

    return sorted(tuple(plain(v) for v in r) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_same_rows(spark, tables, name):
    got, want = queries.QUERIES[name](spark, DATA).toPandas(), tables.execute(queries.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
    assert len(got)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE_SQL)))
def test_runs(spark, name):
    assert queries.QUERIES[name](spark, DATA).count() > 0
