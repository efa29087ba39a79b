"""Every registered query with SQL gives the rows that DuckDB gives for it."""

from __future__ import annotations

import os

import duckdb
import pytest

from ledgerline.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path if os.path.isfile(path) else path + '/*.parquet'}'")
    return con


def text(value):
    return repr(value) if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(name, spark, duck, sf_dir):
    frame = catalogue.QUERIES[name](spark, sf_dir)
    columns = sorted(frame.columns)
    rows = sorted(tuple(text(row[c]) for c in columns) for row in frame.collect())
    if name not in catalogue.ORACLES:
        assert rows
        return
    found = duck.sql(catalogue.ORACLES[name])
    assert sorted(found.columns) == columns
    places = [found.columns.index(c) for c in columns]
    assert rows == sorted(tuple(text(row[i]) for i in places) for row in found.fetchall())


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert {r["op"] for r in entry.entry(spark).collect()} == {"insert", "update", "delete", "unchanged"}
    assert set(catalogue.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
