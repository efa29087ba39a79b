"""Inventory, snapshot diff and incremental migration of feature tables as Spark jobs."""
