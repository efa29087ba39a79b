"""The registry of queries over the driver tables."""

from __future__ import annotations

from . import attachments, catalogs, diffs, documents, inventories, records, rulepacks, shapes  # noqa: F401
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
