"""Best-fit-decreasing packing of documents into sequences of a fixed number of tokens.

Best fit decreasing needs only how many pieces there are of each length. That histogram has
at most `capacity` rows whatever the corpus, so the packing itself is planned from it exactly,
with a segment tree over remaining capacities, and the plan (ranges of pieces of one length
that go to ranges of sequences) is then applied to the pieces by a join on the length.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import give_back_memory, materialize, split_batches
from .vocabularies import word_encoder

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint"
#: Bytes of text encoded at once.
ENCODED_AT_ONCE = 1 << 20
PLAN = "length bigint, first bigint, n bigint, per_sequence bigint, sequence bigint, at bigint"


class OpenCapacities:
    """A segment tree over remaining capacities 0 ... top: how many open sequences have each."""

    def __init__(self, top: int):
        self.leaves = 1 << top.bit_length()
        self.counts = [0] * (2 * self.leaves)

    def add(self, capacity: int, n: int) -> None:
        node = self.leaves + capacity
        while node:
            self.counts[node] += n
            node >>= 1

    def tightest(self, length: int) -> int | None:
        """The smallest capacity of at least length that an open sequence has."""
        node = self.leaves + length
        if self.counts[node]:
            return length
        while node > 1:
            if not node & 1 and self.counts[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.counts[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None


def best_fit_decreasing(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """The packing that best fit decreasing gives for so many pieces of each length (1 ... capacity).

    Rows: length, first, n, per_sequence, sequence, at. Piece number first+i of that length (i < n)
    goes to sequence + i // per_sequence, at offset at + (i % per_sequence) * length. Pieces of one
    length that meet equal sequences are placed together: after one is placed, its sequence is the
    tightest again as long as it has room, so each sequence takes as many as it can hold.
    """
    tree = OpenCapacities(capacity)
    open_runs: dict[int, list[tuple[int, int]]] = {}  # capacity left -> runs (first sequence, how many)
    plan, sequences = [], 0

    def leave(left: int, sequence: int, n: int) -> None:
        if n and left:
            open_runs.setdefault(left, []).append((sequence, n))
            tree.add(left, n)

    for length in sorted((x for x in histogram if histogram[x]), reverse=True):
        placed, n = 0, histogram[length]
        while placed < n:
            left = tree.tightest(length)
            if left is None:
                left = capacity
                each = left // length
                sequence, run = sequences, -(-(n - placed) // each)
                sequences += run
            else:
                each = left // length
                sequence, run = open_runs[left].pop()
                tree.add(left, -run)
            used = min(run, -(-(n - placed) // each))
            now = min(n - placed, used * each)
            plan.append((length, placed, now, each, sequence, capacity - left))
            full, rest = divmod(now, each)
            leave(left - each * length, sequence, full)
            if rest:
                leave(left - rest * length, sequence + full, 1)
            leave(left, sequence + used, run - used)
            placed += now
    return plan


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """The pieces of all documents: ids of the whole text (null: empty) and end_id; longer ones cut every `capacity` ids.

    part and nth number the pieces of one length: nth counts them in the task named by part.
    Only documents longer than the capacity are cut. Nothing is shuffled; a row is a few numbers.
    """

    def encode(batches):
        give_back_memory()
        encoder = word_encoder(tokenizer)
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for whole in batches:
            for batch in split_batches(whole, "text", ENCODED_AT_ONCE):
                tokens, sizes = encoder.encode_column(batch.column("text"), end_id)
                encoder.trim()
                raw = memoryview(tokens.astype("<u4", copy=False)).cast("B")
                counts = -(-sizes // capacity)
                row = np.repeat(np.arange(len(sizes)), counts)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
                start = piece * capacity
                length = np.minimum(capacity, sizes[row] - start)
                first = (np.cumsum(sizes) - sizes)[row] + start
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(first.tolist(), (first + length).tolist())]
                order = np.argsort(length, kind="stable")
                groups, at, n = np.unique(length[order], return_index=True, return_counts=True)
                nth = np.empty(len(row), np.int64)
                nth[order] = np.arange(len(row)) - np.repeat(at - seen[groups], n)
                seen[groups] += n
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(np.full(len(row), part, np.int32)), pa.array(nth)],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(encode, PIECES)


def pack_pieces(pieces: DataFrame, capacity: int) -> DataFrame:
    """Add sequence_id and offset to numbered pieces (length, part, nth), by best fit decreasing over all of them.

    pieces must be a stored table: the numbering must not change between its readings. The driver
    sees one row per length, `capacity` at most; the plan that it broadcasts has a row for each
    (length, run of equal sequences), which the capacity bounds too. An empty table stays empty.
    """
    spark = pieces.sparkSession
    per_part = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    numbered = per_part.select("part", "length", before.alias("before"), "n")
    histogram = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = spark.createDataFrame(best_fit_decreasing(histogram, capacity), PLAN).withColumnRenamed("length", "plan_length")
    ranked = pieces.join(numbered.drop("n"), ["part", "length"]).withColumn("rank", F.col("before") + F.col("nth"))
    at = F.col("rank") - F.col("first")
    placed = ranked.join(F.broadcast(plan), (F.col("length") == F.col("plan_length")) & (at >= 0) & (at < F.col("n")))
    return placed.select(
        *[c for c in pieces.columns if c not in ("part", "nth")],
        (F.col("sequence") + F.floor(at / F.col("per_sequence"))).cast("long").alias("sequence_id"),
        (F.col("at") + (at % F.col("per_sequence")) * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048) -> DataFrame:
    """Pack all documents into as few sequences of at most `capacity` tokens as best fit decreasing finds.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Every piece of a
    longer document is full but the last. Rows that repeat (equal doc_id or text) are packed each; a null
    text is an empty document of one id; a null doc_id stays null. Other columns are not read.
    """
    pieces = materialize(cut_pieces(docs, tokenizer, end_id, capacity), "pieces")
    return pack_pieces(pieces, capacity)


def packed_sequences(docs: DataFrame, packed: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """The sequences themselves: sequence_id and the ids of its pieces, end to end, in order of offset.

    doc_id must be unique here. Each sequence holds one capacity of ids, so its group is small.
    """

    def encode(batches):
        encoder = word_encoder(tokenizer)
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("text", "start", "length", "sequence_id", "offset")))
            out = [(s, o, encoder.encode_column(pa.array([t], pa.string()), end_id)[0][a : a + n].tolist()) for t, a, n, s, o in rows]
            encoder.trim()
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.list_(pa.int64()))],
                ["sequence_id", "offset", "ids"],
            )

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(packed.select("doc_id", "start", "length", "sequence_id", "offset"), "doc_id")
    cut = own.mapInArrow(encode, "sequence_id bigint, offset bigint, ids array<bigint>")
    return cut.groupBy("sequence_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))
