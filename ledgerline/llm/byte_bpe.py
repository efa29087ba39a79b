"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import split_batches
from .vocabularies import byte_encoder


def encode_texts(docs: DataFrame, ranks: str, pattern: str, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """Add out_col, the ids of the whole text as little-endian unsigned 32-bit integers (binary).

    Each match of the pattern is encoded on its own by the ranks; strings of special tokens are
    ordinary text. A null text is an empty one and gets no ids. All columns stay; a column that
    has the name out_col already is replaced. Rows are independent: nothing is shuffled.
    """
    kept = docs.drop(out_col)
    schema = kept.select("*", F.lit(None).cast("binary").alias(out_col)).schema

    def encode(batches):
        encoder = byte_encoder(ranks, pattern)
        for whole in batches:
            for batch in split_batches(whole, text_col):
                ids = [encoder.encode(text or "") for text in batch.column(text_col).to_pylist()]
                encoder.trim()
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.binary())], [*batch.schema.names, out_col])

    return kept.mapInArrow(encode, schema)


def decode_ids(encoded: DataFrame, ranks: str, pattern: str, ids_col: str = "ids", out_col: str = "decoded", as_text: bool = False) -> DataFrame:
    """Add out_col, what the ids of ids_col spell: bytes, or text in which bytes of no whole character are U+FFFD.

    Null ids spell nothing (empty). All other columns stay; one that has the name out_col is replaced.
    """
    kept = encoded.drop(out_col)
    kind = "string" if as_text else "binary"
    schema = kept.select("*", F.lit(None).cast(kind).alias(out_col)).schema

    def decode(batches):
        encoder = byte_encoder(ranks, pattern)
        spell = encoder.decode if as_text else encoder.decode_bytes
        for whole in batches:
            for batch in split_batches(whole, ids_col):
                out = [spell(np.frombuffer(ids or b"", "<u4").tolist()) for ids in batch.column(ids_col).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string() if as_text else pa.binary())], [*batch.schema.names, out_col])

    return kept.mapInArrow(decode, schema)


def token_offsets(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its ids and the character span of each; tokens inside one character share its span. Null text: empty lists."""

    def spans(batches):
        encoder = byte_encoder(ranks, pattern)
        for batch in batches:
            both = [encoder.encode_with_offsets(text or "") for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([ids for ids, _ in both], pa.list_(pa.int64())),
                    pa.array([[a for a, _ in at] for _, at in both], pa.list_(pa.int64())),
                    pa.array([[b for _, b in at] for _, at in both], pa.list_(pa.int64())),
                ],
                ["doc_id", "ids", "starts", "stops"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(spans, "doc_id bigint, ids array<bigint>, starts array<bigint>, stops array<bigint>")


def round_trip_digest(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every whole text: encoded, then decoded from its ids."""
    encoded = encode_texts(docs.select(F.col("doc_id").cast("long"), "text"), ranks, pattern).select("doc_id", "ids")
    decoded = decode_ids(encoded, ranks, pattern)
    return decoded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def digest(data: bytes) -> str:
    """Lower-case hexadecimal SHA-256, as sha2() gives it."""
    return hashlib.sha256(data).hexdigest()
