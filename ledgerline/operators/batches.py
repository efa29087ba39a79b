"""Greedy, ordered batch packing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored

#: Rows of a piece (about): a shard is cut into pieces, which go to tasks of their own.
PIECE = 1 << 18


def next_starts(ends: np.ndarray, most_rows: int, most_bytes: int) -> np.ndarray:
    """For a batch that begins at each row: where the next one begins (the number of rows: not in this piece). ends: running sums, from 0."""
    n = len(ends) - 1
    by_bytes = np.searchsorted(ends, ends[:-1] + most_bytes, "right") - 1
    return np.minimum(np.maximum(np.minimum(by_bytes, np.arange(n) + most_rows), np.arange(n) + 1), n)


def runs_from(following: np.ndarray, starts: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of the first rows as a start: the last batch that begins in the piece, and how many begin, by pointer doubling."""
    n = len(following)
    jump = np.append(following, n)
    count = np.append(np.ones(n, np.int64), 0)
    last = np.append(np.arange(n), -1)
    while (jump[:starts] < n).any():
        last = np.where(jump < n, last[jump], last)
        count, jump = count + count[jump], jump[jump]
    return last[:starts], count[:starts]


def entry(open_rows: int, open_bytes: int, ends: np.ndarray, most_rows: int, most_bytes: int) -> int:
    """Where the first batch of a piece begins, behind an open batch of so many rows and bytes (no rows: at once). ends: running sums of the piece's first rows."""
    if not open_rows:
        return 0
    return int(min(most_rows - open_rows, max(0, np.searchsorted(ends, most_bytes - open_bytes, "right") - 1), len(ends) - 1))


def greedy_batches(rows: DataFrame, shard: str, order: str, size: str, most_rows: int = 500, most_bytes: int = 1 << 20, piece: int = PIECE) -> DataFrame:
    """shard, order, size and batch (from 0 in each shard).

    In each shard rows are taken in order, and a batch closes before the row that would bring it over either
    limit; a row beyond the limit has a batch of its own. Where a batch ends decides where the next begins, so this
    is a fold, not a running sum. Null sizes count as 0. The order is to tell the rows of a shard apart.

    A shard is no task: rows are sorted by ranges into pieces of about `piece` rows. A batch has most_rows rows at most, so the first one that
    begins in a piece is among its first most_rows rows; each piece says for each of these where its batches then lead (pointer
    doubling over running sums). One short row a piece is then followed from piece to piece, and the pieces number their rows.
    """
    spark = rows.sparkSession
    needed = rows.select(F.col(shard).alias("shard"), F.col(order).alias("at"), F.col(size).alias("size"))
    pieces = max(1, -(-needed.count() // piece))
    dealt = needed.repartitionByRange(pieces, "shard", "at").sortWithinPartitions("shard", "at") if pieces > 1 else needed.repartition(1).sortWithinPartitions("shard", "at")
    placed = stored(dealt.select("*", F.spark_partition_id().alias("piece"), F.monotonically_increasing_id().alias("nth")), "pieces")
    own_kind = placed.schema["shard"].dataType

    def ends_of(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
        table = table.sort_by("nth")
        weights = np.nan_to_num(table.column("size").to_numpy().astype(np.float64)).astype(np.int64)
        return table, np.concatenate([[0], np.cumsum(weights)])

    def summary(table: pa.Table) -> pa.Table:
        table, ends = ends_of(table)
        n = len(ends) - 1
        last, count = runs_from(next_starts(ends, most_rows, most_bytes), min(n, most_rows))
        lists = {"ends": ends[: most_rows + 1], "open_rows": n - last, "open_bytes": ends[-1] - ends[last], "count": count}
        own = {"shard": table.column("shard").slice(0, 1), "piece": table.column("piece").slice(0, 1), "n": pa.array([n], pa.int64()), "total": pa.array([ends[-1]], pa.int64())}
        return pa.table(own | {name: pa.array([x.tolist()], pa.list_(pa.int64())) for name, x in lists.items()})

    def follow(table: pa.Table) -> pa.Table:
        found, batch, n, total = [], 0, 0, 0
        table = table.sort_by("piece")
        for row in table.to_pylist():
            start = entry(n, total, np.array(row["ends"]), most_rows, most_bytes)
            # rows before the start belong to the open batch, which is the one before `batch`
            found.append((row["piece"], start, batch))
            if start < row["n"] and start < len(row["count"]):
                batch += row["count"][start]
                n, total = row["open_rows"][start], row["open_bytes"][start]
            else:
                n, total = n + row["n"], total + row["total"]
        return pa.table([table.column("shard"), *(pa.array(x, pa.int64()) for x in zip(*found))], ["shard", "piece", "start", "first"])

    def number(left: pa.Table, right: pa.Table) -> pa.Table:
        table, ends = ends_of(left)
        n, start, batch = len(ends) - 1, right.column("start")[0].as_py(), right.column("first")[0].as_py()
        begins = np.zeros(n, np.int64)
        following = next_starts(ends, most_rows, most_bytes)
        at = start
        while at < n:  # one step a batch
            begins[at] = 1
            at = int(following[at])
        numbers = batch - 1 + np.cumsum(begins)
        return pa.table([table.column("shard"), table.column("at"), table.column("size"), pa.array(numbers, pa.int64())], ["shard", "at", "size", "batch"])

    kind = own_kind.simpleString()
    summaries = placed.groupBy("shard", "piece").applyInArrow(summary, f"shard {kind}, piece int, n bigint, total bigint, ends array<bigint>, open_rows array<bigint>, open_bytes array<bigint>, count array<bigint>")
    starts = summaries.groupBy("shard").applyInArrow(follow, f"shard {kind}, piece bigint, start bigint, first bigint")
    starts = stored(starts, "piece-starts").select(F.col("shard").alias("its_shard"), F.col("piece").cast("int").alias("its_piece"), "start", "first")
    schema = spark.createDataFrame([], placed.select("shard", "at", "size").schema).withColumn("batch", F.lit(0).cast("long")).schema
    packed = placed.groupBy("shard", "piece").cogroup(starts.groupBy("its_shard", "its_piece")).applyInArrow(number, schema)
    return packed.toDF(shard, order, size, "batch")


def batch_sizes(packed: DataFrame, shard: str, size: str) -> DataFrame:
    """Rows and bytes of each batch."""
    return packed.groupBy(shard, "batch").agg(F.count("*").alias("n_rows"), F.sum(size).cast("long").alias("n_bytes"))
