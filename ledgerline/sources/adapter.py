"""The extension point for sources: anything that can describe itself and list its catalogue."""

from __future__ import annotations

from typing import Protocol, runtime_checkable

from pyspark.sql import DataFrame, SparkSession

from ..operators import rules
from ..operators.tally import outcome_counts


@runtime_checkable
class SourceAdapter(Protocol):
    """A source of feature tables."""

    def describe(self, spark: SparkSession) -> dict[str, str]:
        """Format, location and, if there is one, a detail."""

    def items(self, spark: SparkSession) -> DataFrame:
        """The judged catalogue: location, kind, detail, outcome, target, losses, reason."""


def inspect(spark: SparkSession, source: SourceAdapter) -> tuple[dict[str, str], DataFrame, DataFrame]:
    """A source's description, its items and their counts by outcome; a source without items is an error."""
    items = rules.require_items(source.items(spark))
    return source.describe(spark), items, outcome_counts(items)


class TableSource:
    """Spark tables as a source: every table is a layer, judged by the rules for file databases."""

    def __init__(self, location: str, tables: dict[str, DataFrame]):
        self.location, self.tables = location, tables

    def describe(self, spark: SparkSession) -> dict[str, str]:
        return {"format": "tables", "location": self.location, "detail": f"{len(self.tables)} tables"}

    def items(self, spark: SparkSession) -> DataFrame:
        from pyspark.sql import functions as F

        from .definitions import table_fields

        fields = table_fields(spark, self.tables)
        own = F.array_sort(F.collect_list(F.struct("pos", "name", F.when(F.col("type").startswith("timestamp"), "DateTime").when(F.col("type") == "binary", "Binary").otherwise(F.col("type")).alias("type"), "alias")))
        layers = fields.groupBy("layer").agg(own.alias("fields")).withColumns({"role": F.lit("user"), "geometry_type": F.lit(None).cast("string"), "code": F.lit(None).cast("int"), "wkt": F.lit(None).cast("string")})
        return rules.judge(layers, "table", rules.FILE, "layer", "concat(cast(size(fields) as string), ' fields')")
