"""The driver contract and the DuckDB oracle at the smoke scale."""

import collections
import datetime as dt
import os

import duckdb
import pytest

import __spark_entry__ as entry

from .conftest import SF_SMOKE

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
RETAIL = {**entry.BATCH_QUERIES, **entry.CONNECTOR_QUERIES}


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["branch_id", "year", "month", "sales_count", "units_sold", "sales_total", "avg_ticket"]


def test_every_query_has_an_oracle():
    assert set(RETAIL) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMOKE}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _bag(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def norm(v):
        if isinstance(v, float):
            return repr(v)
        if isinstance(v, dt.datetime):
            return v.replace(tzinfo=None).isoformat()
        return v

    return collections.Counter(tuple(norm(r[i]) for i in order) for r in records)


@pytest.mark.parametrize("name", RETAIL)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMOKE)
    cur = duck.execute(entry.oracle_sql()[name])
    onames = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(onames)
    assert _bag(df.columns, df.collect()) == _bag(onames, cur.fetchall())


def test_every_oracle_statement_runs_in_duckdb(duck):
    for name in RETAIL:
        sql = entry.oracle_sql()[name]
        cur = duck.execute(sql)
        assert cur.fetchall() is not None, name
