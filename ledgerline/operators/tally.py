"""One-pass tallies over rows and operations."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def row_tally(rows: DataFrame, layer: str, size: Column, largest: int, key: Column, shape: Column | None = None, writable: Column | None = None) -> DataFrame:
    """Per layer: read, written, shapeless, unwritable, oversized, largest oversized and unkeyed rows.

    Every row that is read is written, oversized or unkeyed; shapeless and unwritable ones are written with an
    empty geometry. Partial sums leave the tasks, so a layer with most of the rows is no matter.
    """
    over = F.coalesce(size, F.lit(0)) > largest
    shapeless = shape.isNull() if shape is not None else F.lit(False)
    unwritable = ~F.coalesce(writable, F.lit(True)) if writable is not None else F.lit(False)
    return rows.groupBy(F.col(layer).alias("layer")).agg(
        F.count("*").alias("read"),
        F.count_if(~over & key.isNotNull()).alias("written"),
        F.count_if(shapeless).alias("shapeless"),
        F.count_if(unwritable & ~shapeless).alias("unwritable"),
        F.count_if(over & key.isNotNull()).alias("oversized"),
        F.max(F.when(over & key.isNotNull(), size)).cast("long").alias("largest"),
        F.count_if(key.isNull()).alias("unkeyed"),
    )


def observed(rows: DataFrame, size: Column, largest: int, key: Column) -> tuple[DataFrame, Observation]:
    """rows, and what will be known of them when they are written (A3): read, written, oversized, largest and unkeyed, without a second read.

    The numbers are those of row_tally over all layers, taken in the tasks that write. Observation.get waits for the write.
    """
    over, keyed = F.coalesce(size, F.lit(0)) > largest, key.isNotNull()
    seen = Observation(f"rows-{uuid.uuid4().hex}")
    return rows.observe(
        seen, F.count(F.lit(1)).alias("read"), F.count_if(~over & keyed).alias("written"), F.count_if(over & keyed).alias("oversized"), F.max(F.when(over & keyed, size)).cast("long").alias("largest"), F.count_if(~keyed).alias("unkeyed")
    ), seen


def outcome_counts(items: DataFrame) -> DataFrame:
    """faithful, approximated, unsupported and not applicable items in one row (A1)."""
    count = lambda outcome: F.count_if(F.col("outcome") == outcome).alias(outcome)
    return items.agg(count("faithful"), count("approximated"), count("unsupported"), count("not_applicable"), F.count("*").alias("items"))


def log_counts(log: DataFrame) -> DataFrame:
    """carried, carried with loss and skipped entries in one row (A2)."""
    count = lambda state: F.count_if(F.col("state") == state).alias(state)
    return log.agg(count("carried"), count("carried_with_loss"), count("skipped"))


def composition(layers: DataFrame) -> DataFrame:
    """layers, tables, groups and rasters of each source."""
    count = lambda kind, name: F.count_if(F.col("kind") == kind).alias(name)
    return layers.groupBy("source").agg(count("layer", "layers"), count("table", "tables"), count("group", "groups"), count("raster", "rasters"))
