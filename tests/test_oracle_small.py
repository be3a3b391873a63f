"""Every registered query equals its DuckDB oracle on the sf0.001 tables."""

import math

import duckdb
import pytest

from alertsieve.plans.oracle import oracle_sql
from alertsieve.plans.queries import Q
from conftest import SF001

TABLES = ["customer", "part", "events"]


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    return repr(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = Q[name](spark, SF001)
    res = con.execute(oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert canon(df.columns, df.collect()) == canon(dcols, res.fetchall())
