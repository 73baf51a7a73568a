"""Every registered query against its DuckDB SQL, over whole tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_DIR, rows_of
from talkgauge.plans.oracle import oracle_sql
from talkgauge.plans.queries import QUERIES as OWN

QUERIES, SQL = entry.queries(), oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{os.path.join(SF_DIR, 'events.parquet')}'")
    return con


def test_names_match():
    assert set(SQL) == set(OWN)
    assert set(OWN) <= set(QUERIES) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(SQL[name])
    names = [c[0] for c in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    assert sorted(df.columns) == sorted(names)
    expected = sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=repr)
    assert rows_of(df) == expected


def test_entry(spark):
    assert entry.entry(spark).count() > 0
