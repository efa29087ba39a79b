"""Corpus queries that SQL can state give the rows that DuckDB gives."""

from __future__ import annotations

import os

import duckdb
import pytest

from ledgerline.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(name, spark, sf_dir):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        path = f"{sf_dir}/{table}.parquet"
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{path if os.path.isfile(path) else path + '/*.parquet'}'")
    frame, found = queries.QUERIES[name](spark, sf_dir), con.sql(queries.ORACLES[name])
    columns = sorted(found.columns)
    assert sorted(frame.columns) == columns
    places = [found.columns.index(c) for c in columns]
    assert sorted(tuple(r[c] for c in columns) for r in frame.collect()) == sorted(tuple(r[i] for i in places) for r in found.fetchall())


def test_all_operators_are_registered():
    numbers = {int(name[2:].split("_")[0]) for name in queries.QUERIES if name.startswith("op")}
    assert numbers == set(range(1, 14)) and "pipeline" in queries.QUERIES
