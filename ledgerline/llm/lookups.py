"""Batches of documents that ask, by hash, what other batches hold: two small shuffles in place of a self join.

Documents are dealt once into batches by a hash of the row, so batches are even whatever the
sources or copies. A batch reduces its own rows first (one record per distinct hash), deals its
records into buckets by hash, and gets back only what concerns it. A hash that a third of all
documents share therefore reaches its bucket once per batch, not once per document, and no
pairs of documents are ever formed. Records travel as packed numpy arrays, one row per batch
and bucket. All stages belong to one plan in which the dealt documents are shuffled once
(Spark reuses that exchange), and a lost executor's part is computed again from the input.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vocabularies
from .common import give_back_memory, mix, shuffle_partitions

REQUESTS = "batch int, kind int, bucket int, data binary"
REQUESTS_ARROW = pa.schema([("batch", pa.int32()), ("kind", pa.int32()), ("bucket", pa.int32()), ("data", pa.binary())])
#: A reply row holds the data of several kinds, each behind its kind and length.
SEGMENT = "<iq"
REPLIES_ARROW_OUT = pa.schema([("batch", pa.int32()), ("data", pa.binary())])
REPLIES_ARROW = pa.schema([("batch", pa.int32()), ("kind", pa.int32()), ("data", pa.binary())])

#: Batches per shuffle partition, and shuffle partitions per bucket: more batches make the partitions more even,
#: fewer buckets keep the records of a batch and bucket large.
BATCHES_PER_PARTITION = 3
PARTITIONS_PER_BUCKET = 3
#: Bytes of text in a batch: beyond, there are more batches, partitions and buckets than the session's shuffle width asks for.
BATCH_BYTES = 8 << 20
#: Records that a task sorts at once.
RECORDS_AT_ONCE = 1 << 16

#: Doc ids in records; a null id counts as larger than any other.
NO_ID = np.iinfo(np.int64).max

SHARED = np.dtype([("a", "<u8"), ("many", "u1")])
KEYED = np.dtype([("a", "<u8"), ("b", "<u8"), ("n", "<u4")])
LEAST = np.dtype([("a", "<u8"), ("b", "<u8"), ("doc", "<i8"), ("many", "u1")])
FOUND = np.dtype([("a", "<u8"), ("b", "<u8"), ("doc", "<i8")])
#: Where a hash comes first: places are ordered by doc, batch, row and at.
FIRST = np.dtype([("a", "<u8"), ("b", "<u8"), ("doc", "<i8"), ("batch", "<i4"), ("row", "<i4"), ("at", "<i8"), ("n", "<u4")])


def in_batches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> tuple[DataFrame, int]:
    """doc_id, text and batch of all rows, dealt out by batch, and the number of buckets; columns to carry along are named carry_0, carry_1 ..."""
    held = docs.agg(F.coalesce(F.sum(F.octet_length(docs[f"`{text_col}`"])), F.lit(0))).first()[0]
    width = max(shuffle_partitions(docs.sparkSession), -(-held // (BATCH_BYTES * BATCHES_PER_PARTITION)))
    along = [docs[f"`{name}`"].alias(f"carry_{i}") for i, name in enumerate(carry or [])]
    rows = docs.select(docs[f"`{id_col}`"].cast("long").alias("doc_id"), docs[f"`{text_col}`"].alias("text"), *along)
    batch = F.pmod(F.xxhash64("doc_id", "text"), F.lit(width * BATCHES_PER_PARTITION)).cast("int")
    return rows.withColumn("batch", batch).repartition(width, "batch"), -(-width // PARTITIONS_PER_BUCKET)


def requests_of(batch: int, kind: int, records: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Records of one batch, dealt into buckets by their field a."""
    if not len(records):
        return
    bucket = ((records["a"] >> np.uint64(20)) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    records, bucket = records[order], bucket[order]
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    starts = np.concatenate([[0], cuts])
    data = [part.tobytes() for part in np.split(records, cuts)]
    n = len(starts)
    yield pa.RecordBatch.from_arrays(
        [pa.array([batch] * n, pa.int32()), pa.array([kind] * n, pa.int32()), pa.array(bucket[starts], pa.int32()), pa.array(data, pa.binary())], schema=REQUESTS_ARROW
    )


def replies_of(kind: int, who: np.ndarray, records: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Records for the batches that asked, one row per batch."""
    if not len(records):
        return
    order = np.argsort(who, kind="stable")
    who, records = who[order], records[order]
    cuts = np.flatnonzero(np.diff(who)) + 1
    starts = np.concatenate([[0], cuts])
    n = len(starts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(who[starts], pa.int32()), pa.array([kind] * n, pa.int32()), pa.array([part.tobytes() for part in np.split(records, cuts)], pa.binary())], schema=REPLIES_ARROW
    )


def answer(requests: DataFrame, buckets: int, answers: dict[int, Callable]) -> DataFrame:
    """Replies to requests: answers[kind](who, data) gets all requests of a kind that met in one task, as views of what came in."""

    def resolve(batches: Iterable[pa.RecordBatch]):
        vocabularies.forget()
        asked: dict[int, tuple[list, list]] = {}
        for batch in batches:
            for who, kind, data in zip(batch.column("batch").to_pylist(), batch.column("kind").to_pylist(), batch.column("data")):
                own = asked.setdefault(kind, ([], []))
                own[0].append(who)
                own[1].append(memoryview(data.as_buffer()))
        found: dict[int, list[bytes]] = {}  # one row a batch that is answered, whatever the kinds
        for kind in sorted(asked):
            for replies in answers[kind](kind, *asked.pop(kind)):
                for who, data in zip(replies.column("batch").to_pylist(), replies.column("data").to_pylist()):
                    found.setdefault(who, []).append(struct.pack(SEGMENT, kind, len(data)) + data)
        give_back_memory()
        for who in list(found):
            yield pa.RecordBatch.from_arrays([pa.array([who], pa.int32()), pa.array([b"".join(found.pop(who))], pa.binary())], schema=REPLIES_ARROW_OUT)

    return requests.repartition(buckets, "bucket").mapInArrow(resolve, "batch int, data binary")


def segments(data: bytes):
    """The (kind, data) that a reply row holds."""
    at = 0
    while at < len(data):
        kind, n = struct.unpack_from(SEGMENT, data, at)
        at += struct.calcsize(SEGMENT)
        yield kind, data[at : at + n]
        at += n


def per_batch(docs: DataFrame, run: Callable, schema: str) -> DataFrame:
    """run(batch, docs table, {}) on every batch."""

    def alone(table: pa.Table) -> pa.Table:
        return _together(run(table.column("batch")[0].as_py(), table, {}), target)

    target = _arrow(docs, schema)
    return docs.groupBy("batch").applyInArrow(alone, schema)


def with_replies(docs: DataFrame, replies: DataFrame, run: Callable, schema: str) -> DataFrame:
    """run(batch, docs table, {kind: data of its replies}) on every batch."""

    def both(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _together([], target)
        got: dict[int, list[bytes]] = {}
        for row in right.column("data"):
            for kind, data in segments(row.as_py()):
                got.setdefault(kind, []).append(data)
        return _together(run(left.column("batch")[0].as_py(), left, got), target)

    target = _arrow(docs, schema)
    return docs.groupBy("batch").cogroup(replies.groupBy("batch")).applyInArrow(both, schema)


def _arrow(docs: DataFrame, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(docs.sparkSession.createDataFrame([], schema).schema)


def _together(batches: Iterable[pa.RecordBatch], schema: pa.Schema) -> pa.Table:
    vocabularies.forget()  # what the last batch held goes back to the system
    out = pa.Table.from_batches([b.cast(schema) if b.schema != schema else b for b in batches], schema)
    give_back_memory()
    return out


def gather(data: list[bytes], kind: np.dtype) -> np.ndarray:
    return np.frombuffer(b"".join(data), kind)


def gathered(who: list[int], data: list[bytes], kind: np.dtype) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Who asked, and the records, in parts of about RECORDS_AT_ONCE by their hash a; all records of one hash are in one part."""
    asked = [np.frombuffer(x, kind) for x in data]
    parts = -(-sum(map(len, asked)) // RECORDS_AT_ONCE)
    for part in range(parts):
        own = asked if parts == 1 else [x[_part_of(x["a"], parts) == part] for x in asked]
        yield np.repeat(np.array(who, np.int32), [len(x) for x in own]), np.concatenate(own)


def _part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Parts by other bits of a hash than buckets are dealt by: those are the same in all records of a bucket."""
    return mix(hashes) % np.uint64(parts)


def groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that brings equal keys together, and where each group starts in it."""
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= np.diff(key[order]) != 0
    return order, np.flatnonzero(new)


def spread(values: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """A value per group, repeated for its members."""
    return np.repeat(values, np.diff(np.append(starts, n)))


def find(wanted_a: np.ndarray, wanted_b: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each wanted (a, b) its place in the pairs (a, b), or -1; pairs are distinct."""
    if not len(a):
        return np.full(len(wanted_a), -1)
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    low = np.searchsorted(a, wanted_a)
    out = np.full(len(wanted_a), -1)
    pending = np.arange(len(wanted_a))
    while len(pending):  # one round, but where different pairs have an equal a
        at = low[pending]
        inside = at < len(a)
        pending, at = pending[inside], at[inside]
        same = a[at] == wanted_a[pending]
        pending, at = pending[same], at[same]
        hit = b[at] == wanted_b[pending]
        out[pending[hit]] = order[at[hit]]
        pending = pending[~hit]
        low[pending] += 1
    return out


def least_records(a: np.ndarray, b: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """One LEAST record per distinct (a, b): the smallest doc, and whether there is more than one."""
    order, starts = groups(a, b)
    out = np.zeros(len(starts), LEAST)
    if len(starts):
        own = doc[order]
        out["a"], out["b"] = a[order][starts], b[order][starts]
        out["doc"] = np.minimum.reduceat(own, starts)
        out["many"] = np.maximum.reduceat(own, starts) != out["doc"]
    return out


def first_records(a: np.ndarray, b: np.ndarray, doc: np.ndarray, batch: int, row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One FIRST record per distinct (a, b): where it comes first in this batch, and how often it occurs."""
    order = np.lexsort((at, row, doc, b, a))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0)
    starts = np.flatnonzero(new)
    out = np.zeros(len(starts), FIRST)
    own = order[starts]
    out["a"], out["b"], out["doc"], out["batch"], out["row"], out["at"] = a[own], b[own], doc[own], batch, row[own], at[own]
    out["n"] = np.diff(np.append(starts, len(order)))
    return out


def answer_first(kind: int, who: list[int], data: list[bytes]):
    """The first place of each hash that occurs twice or more: FIRST records in, FIRST out (n: occurrences in all)."""
    for asker, records in gathered(who, data, FIRST):
        order = np.lexsort((records["at"], records["row"], records["batch"], records["doc"], records["b"], records["a"]))
        if len(order):
            own, own_asker = records[order], asker[order]
            new = np.ones(len(order), bool)
            new[1:] = (np.diff(own["a"]) != 0) | (np.diff(own["b"]) != 0)
            starts = np.flatnonzero(new)
            total = spread(np.add.reduceat(own["n"].astype(np.uint64), starts), starts, len(order))
            out = spread(own[starts], starts, len(order))
            out["n"] = np.minimum(total, 2**32 - 1)
            yield from replies_of(kind, own_asker[total > 1], out[total > 1])


def answer_shared(kind: int, who: list[int], data: list[bytes]):
    """Which hashes more than one document holds: SHARED records in, uint64 hashes out."""
    for asker, records in gathered(who, data, SHARED):
        order, starts = groups(records["a"])
        if len(starts):
            shared = (np.diff(np.append(starts, len(order))) > 1) | np.maximum.reduceat(records["many"][order], starts).astype(bool)
            hit = order[spread(shared, starts, len(order))]
            yield from replies_of(kind, asker[hit], records["a"][hit])


def answer_least(kind: int, who: list[int], data: list[bytes]):
    """The smallest doc of each hash, to the batches that have a larger one: LEAST records in, FOUND out."""
    for asker, records in gathered(who, data, LEAST):
        order, starts = groups(records["a"], records["b"])
        if len(starts):
            least = spread(np.minimum.reduceat(records["doc"][order], starts), starts, len(order))
            own = records[order]
            hit = (least < own["doc"]) | (own["many"] > 0)
            out = np.zeros(int(hit.sum()), FOUND)
            out["a"], out["b"], out["doc"] = own["a"][hit], own["b"][hit], least[hit]
            yield from replies_of(kind, asker[order][hit], out)


def answer_contested(kind: int, who: list[int], data: list[bytes]):
    """Hashes a that come with more than one b: KEYED records in (n: distinct b in the batch), KEYED out with n summed."""
    for asker, records in gathered(who, data, KEYED):
        order, starts = groups(records["a"])
        if len(starts):
            own = records[order]
            differ = (np.minimum.reduceat(own["b"], starts) != np.maximum.reduceat(own["b"], starts)) | (np.maximum.reduceat(own["n"], starts) > 1)
            total = np.minimum(np.add.reduceat(own["n"].astype(np.uint64), starts), 2**32 - 1).astype(np.uint32)
            hit = spread(differ, starts, len(order))
            out = own[hit].copy()
            out["n"] = spread(total, starts, len(order))[hit]
            yield from replies_of(kind, asker[order][hit], out)


def keyed_records(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One KEYED record per distinct a: its smallest b and how many distinct b it has."""
    order, starts = groups(a, b)
    pairs_a, pairs_b = a[order][starts], b[order][starts]
    cuts = np.flatnonzero(np.concatenate([[True], np.diff(pairs_a) != 0])) if len(pairs_a) else np.zeros(0, int)
    out = np.zeros(len(cuts), KEYED)
    out["a"], out["b"], out["n"] = pairs_a[cuts], pairs_b[cuts], np.diff(np.append(cuts, len(pairs_a)))
    return out
