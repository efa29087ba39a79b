"""Sinks that commit in batches, keep originals and write reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.batches import greedy_batches
from .logs import report_documents, report_lines


def commit_batches(ops: DataFrame, path: str, shard: str = "dataset", order: str = "seq", most_rows: int = 500, most_bytes: int = 1 << 20) -> DataFrame:
    """Operations as one row per commit (K7): dataset, batch, n, bytes and the operations as JSON lines, written and read back.

    A commit holds at most so many rows and bytes, in order (of equal orders, by content); one larger operation is a
    commit of its own. The write is by Spark's committer, so a task that is tried again leaves nothing twice. A shard has no folder of
    its own: shards grow in number with the table, and a file for each would cost more than its rows.
    """
    sized = ops.select(shard, order, F.to_json(F.struct(*ops.columns)).alias("_line"))
    sized = sized.withColumn("_bytes", F.octet_length("_line").cast("long")).withColumn("_order", F.struct(order, "_line"))
    packed = greedy_batches(sized, shard, "_order", "_bytes", most_rows, most_bytes)
    lines = F.transform(F.array_sort(F.collect_list("_order")), lambda x: x["_line"])
    commits = packed.groupBy(shard, "batch").agg(F.count("*").alias("n"), F.sum("_bytes").alias("bytes"), F.array_join(lines, "\n").alias("body"))
    commits.write.parquet(path)
    return ops.sparkSession.read.parquet(path)


def each_commit(commits: DataFrame, send: Callable[[str, int, str], None], shard: str = "dataset") -> None:
    """send(dataset, batch, body) for every commit, in order inside a dataset; send must bear being called again."""

    def run(rows):
        for row in rows:
            send(row[shard], row["batch"], row["body"])

    commits.repartition(shard).sortWithinPartitions(shard, "batch").foreachPartition(run)


def each_commit_by_level(features: DataFrame, attachments: DataFrame, levels: DataFrame, send: Callable[[str, int, str], None]) -> int:
    """each_commit level by level (K7, T6): a dataset's features after those of all datasets that it depends on, attachments after all features.

    features, attachments: dataset, batch, body. levels: dataset, level (operators/ordering.py). Gives the number of steps; each
    is a job, and the next begins when it has ended. A dataset that has no level is an error: nothing is left out.
    """
    strays = features.select("dataset").unionByName(attachments.select("dataset")).distinct().join(levels, "dataset", "left_anti").limit(20).collect()
    if strays:
        raise ValueError(f"no level of {', '.join(str(r[0]) for r in strays)}")
    steps = sorted(r[0] for r in levels.select("level").distinct().collect())  # as many as the longest chain of relationships
    for level in steps:
        each_commit(features.join(levels.where(F.col("level") == level).select("dataset"), "dataset", "left_semi"), send)
    each_commit(attachments, send)
    return len(steps) + 1


def keep_originals(rows: DataFrame, path: str, key: str, geometry: str, srid: str, wkt: str) -> DataFrame:
    """The untransformed geometries beside the working copy (K8): key, native_geometry, native_srid, native_wkt of rows that have one."""
    own = rows.where(F.col(geometry).isNotNull()).select(key, F.col(geometry).alias("native_geometry"), F.col(srid).alias("native_srid"), F.col(wkt).alias("native_wkt"))
    own.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def write_report(items: DataFrame, path: str, as_json: bool = False) -> None:
    """A report in markdown or as JSON lines, one line per item, in order of seq (K6). The lines are sorted by range, not in one task."""
    lines = report_documents(items) if as_json else report_lines(items)
    lines.orderBy("seq").select("line").write.text(path)


def attachment_metadata(*columns: str):
    """The metadata object of an attachment as JSON (F15); what is null is left out."""
    return F.to_json(F.struct(*columns))


def payload_text(payload, as_hex: bool = False):
    """A binary payload as text (F7): base64, or lower-case hexadecimal."""
    return F.lower(F.hex(payload)) if as_hex else F.base64(payload)
