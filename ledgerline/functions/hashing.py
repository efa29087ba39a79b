"""Hashes and identifiers that are the same on every run and every retry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def content_hash(*columns: Column | str) -> Column:
    """A hash of row content.

    xxhash64 passes over nulls, so (null, a) would equal (a, null): the columns are hashed as one
    JSON object, which names each value and leaves nulls out by name.
    """
    return F.xxhash64(F.to_json(F.struct(*columns)))


def feature_id(*parts: Column | str) -> Column:
    """An identifier in UUID form (F6), derived from what names the row: uuid() would change when a task is retried."""
    digest = F.sha2(F.to_json(F.struct(*parts)), 256)
    cut = lambda a, n: F.substring(digest, a, n)
    return F.concat_ws("-", cut(1, 8), cut(9, 4), F.concat(F.lit("8"), cut(14, 3)), F.concat(F.lit("a"), cut(18, 3)), cut(21, 12))
