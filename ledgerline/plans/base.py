"""How queries are registered: a Spark callable, and SQL over the same tables that states the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query under its name, with its SQL if there is any."""

    def add(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return run

    return add


def derive(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A table that plain SQL derives from the driver tables named in braces."""
    names = set(re.findall(r"\{(\w+)\}", sql))
    return spark.sql(sql, **{name: table(spark, sf_dir, name) for name in names})


def plain(sql: str) -> str:
    """The same SQL with the tables' own names."""
    return re.sub(r"\{(\w+)\}", r"\1", sql)
