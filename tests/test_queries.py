"""Every registered query against its DuckDB oracle on the smallest tables,
plus the driver entry smoke check."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tabula.fixtures import BASE_TABLES

from .conftest import SMALL

ORACLES = oracle_sql()


def _norm(rows):
    def v(x):
        if isinstance(x, float):
            return "nan" if math.isnan(x) else round(x, 6)
        return x
    return sorted((tuple(v(x) for x in r) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SMALL)
    cols = sorted(df.columns)
    got = [tuple(r[c] for c in cols) for r in df.collect()]
    rel = duck.execute(ORACLES[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    want = [tuple(r[i] for i in idx) for r in rel.fetchall()]
    assert _norm(got) == _norm(want)


@pytest.mark.parametrize("name", sorted(set(queries()) - set(ORACLES)))
def test_query_without_oracle_runs(spark, name):
    df = queries()[name](spark, SMALL)
    assert df.count() >= 0 and len(df.columns) > 0


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "PROPORCAO_OBITOS_CANCER" in df.columns
