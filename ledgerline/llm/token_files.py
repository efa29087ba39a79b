"""Token-id files: every id in the fewest bits that the vocabulary needs, in blocks that can be read alone.

Layout. A folder holds two Parquet tables. `blocks` has one row per block of documents:
shard, block (place in the shard), doc_ids, lengths (ids of each document), bits, n_tokens
and payload, the ids end to end, each in `bits` bits, highest bit first. `index` has one
row per block: shard, block, start (ids in all blocks before it) and n_tokens, so that a
reader finds the block of any id of the corpus and unpacks only the bits it needs.
Shards follow each other in ascending doc_id order, as do blocks and documents in them.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import give_back_memory, shuffle_partitions, split_batches
from .vocabularies import word_encoder

#: Ids gathered before a block is closed.
BLOCK_IDS = 1 << 19
#: Bytes of text encoded at once.
ENCODED_AT_ONCE = 4 << 20

BLOCKS = "shard int, block int, doc_ids array<bigint>, lengths array<bigint>, bits int, n_tokens bigint, payload binary"
BLOCKS_ARROW = pa.schema(
    [
        ("shard", pa.int32()),
        ("block", pa.int32()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
        ("bits", pa.int32()),
        ("n_tokens", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def bits_for(vocabulary: int) -> int:
    """The fewest bits that hold every id of a vocabulary."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as one bit string, `bits` bits each, highest first; the last byte is filled with zeros."""
    if bits in (8, 16, 32):
        return ids.astype(f">u{bits // 8}").tobytes()
    whole = np.unpackbits(ids.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)
    return np.packbits(whole[:, 32 - bits :].ravel()).tobytes()


def unpack(payload: bytes, bits: int, start: int, stop: int) -> np.ndarray:
    """The ids start ... stop-1 of a packed block, reading only the bytes that hold them."""
    if bits in (8, 16, 32):
        width = bits // 8
        return np.frombuffer(payload, f">u{width}", stop - start, start * width).astype(np.uint32)
    first = start * bits // 8
    raw = np.unpackbits(np.frombuffer(payload, np.uint8)[first : (stop * bits + 7) // 8])
    skip = start * bits - first * 8
    cells = raw[skip : skip + (stop - start) * bits].reshape(-1, bits)
    whole = np.zeros((len(cells), 32), np.uint8)
    whole[:, 32 - bits :] = cells
    return np.packbits(whole, axis=1).view(">u4").ravel().astype(np.uint32)


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", shards: int | None = None
) -> None:
    """Encode every whole text and write the ids under path, in ascending order of id_col.

    A null text is an empty one; every document gets end_id as its last id. Rows of equal id
    stand side by side, ordered by text; null ids come first. An empty table makes no block.
    Columns besides the two named are not read. The texts are dealt out once by ranges of ids
    (and of the texts' beginnings, so that different texts of a repeated id can be parted);
    each task then writes the blocks of its shard, so no task holds more than a block.
    """
    spark = docs.sparkSession
    shards = shards or shuffle_partitions(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ordered = rows.repartitionByRange(shards, "doc_id", F.substring("text", 1, 32)).sortWithinPartitions("doc_id", "text")

    def encode(batches):
        give_back_memory()
        encoder = word_encoder(tokenizer)
        bits = bits_for(max(encoder.size, end_id + 1))
        shard, block, ids, parts, lengths, total = TaskContext.get().partitionId(), 0, [], [], [], 0

        def close():
            payload = pack(np.concatenate(parts), bits)
            return pa.RecordBatch.from_pydict(
                {"shard": [shard], "block": [block], "doc_ids": [ids], "lengths": [lengths], "bits": [bits], "n_tokens": [total], "payload": [payload]}, BLOCKS_ARROW
            )

        for whole in batches:
            for batch in split_batches(whole, "text", ENCODED_AT_ONCE):
                tokens, sizes = encoder.encode_column(batch.column("text"), end_id)
                stops, doc_ids, at = np.cumsum(sizes), batch.column("doc_id").to_pylist(), 0
                while at < len(sizes):  # rows up to the one that fills the block
                    done = int(stops[at] - sizes[at])
                    till = min(len(sizes), int(np.searchsorted(stops, done + BLOCK_IDS - total)) + 1)
                    parts.append(tokens[done : stops[till - 1]])
                    ids += doc_ids[at:till]
                    lengths += sizes[at:till].tolist()
                    total += int(stops[till - 1]) - done
                    if total >= BLOCK_IDS:
                        yield close()
                        block, ids, parts, lengths, total = block + 1, [], [], [], 0
                    at = till
                encoder.trim()
        if ids:
            yield close()

    ordered.mapInArrow(encode, BLOCKS).write.parquet(f"{path}/blocks")
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks").select("shard", "block", "n_tokens")
    # one row per shard goes through one task here: their number is the shuffle width, not the corpus
    shards_before = (
        blocks.groupBy("shard")
        .agg(F.sum("n_tokens").alias("shard_tokens"))
        .select("shard", (F.sum("shard_tokens").over(Window.orderBy("shard")) - F.col("shard_tokens")).alias("before"))
    )
    in_shard = F.sum("n_tokens").over(Window.partitionBy("shard").orderBy("block")) - F.col("n_tokens")
    index = blocks.withColumn("in_shard", in_shard).join(shards_before, "shard")
    index.select("shard", "block", (F.col("before") + F.col("in_shard")).alias("start"), "n_tokens").write.parquet(f"{path}/index")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The blocks with the place of their first id in the corpus."""
    index = spark.read.schema("shard int, block int, start bigint, n_tokens bigint").parquet(f"{path}/index")
    return spark.read.schema(BLOCKS).parquet(f"{path}/blocks").drop("n_tokens").join(index, ["shard", "block"])


def documents_of(blocks: DataFrame) -> DataFrame:
    """One row per document from its file: doc_id, start, n_tokens and ids_crc32 of its ids."""

    def digest(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["payload"], row["bits"], 0, row["n_tokens"]).astype("<u4").tobytes()
                stops = np.cumsum(row["lengths"])
                starts = stops - row["lengths"]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(row["doc_ids"], pa.int64()),
                        "start": pa.array(starts + row["start"], pa.int64()),
                        "n_tokens": pa.array(row["lengths"], pa.int64()),
                        "ids_crc32": pa.array([zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(starts.tolist(), stops.tolist())], pa.int64()),
                    }
                )

    return blocks.mapInArrow(digest, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def tokens_between(blocks: DataFrame, first: int, last: int) -> DataFrame:
    """The ids at the places first ... last-1 of the corpus: only the blocks that hold them are read, only their bits unpacked."""

    def cut(batches):
        for batch in batches:
            for row in batch.to_pylist():
                a, b = max(first, row["start"]) - row["start"], min(last, row["start"] + row["n_tokens"]) - row["start"]
                ids = unpack(row["payload"], row["bits"], a, b)
                yield pa.RecordBatch.from_pydict({"place": pa.array(np.arange(a, b) + row["start"], pa.int64()), "id": pa.array(ids.astype(np.int64))})

    held = blocks.where((F.col("start") < last) & (F.col("start") + F.col("n_tokens") > first))
    return held.mapInArrow(cut, "place bigint, id bigint")
