"""The corpus pipeline: stages over documents, each written and read again as the next one's input.

1. quality: documents that the classifier rejects go.
2. near_dedup: of documents that are similar (five words, 0.8) the one with the least id stays.
3. suffix_dedup: text that repeats over REPEAT bytes or more goes from all places but its first; every document stays.
4. packing: what is left is packed into sequences of 2048 tokens; one row per piece.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import packing, quality, simhash, suffix_dedup
from ledgerline.llm.common import load, materialize

TOKENIZER = "word_bpe_49k.json"
#: Bytes from which a repeated passage goes: 50 words of four letters and a space.
REPEAT = 250


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """docs without the rows whose doc_id is among these; a null doc_id stays."""
    gone = ids.select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = quality.judge(docs, load(spark, sf_dir, "labels"))
    return without(docs, judged.where(~F.col("keep")))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    grouped = simhash.similar_documents(docs, words=5, similarity=0.8)
    return without(docs, grouped.where("doc_id <> component_id"))


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    cut = suffix_dedup.suffix_dedup(docs, carry=others, as_text=True, window=REPEAT, keep_first=True)
    cut = cut.select("doc_id", F.col("kept").alias("text"), F.length("kept").cast("long").alias("n_chars"), *[F.col(f"`{c}`") for c in others])
    return cut.select(*[F.col(f"`{c}`") for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER), end_id=0, capacity=2048)


STAGES = [("quality", quality_stage), ("near_dedup", near_dedup_stage), ("suffix_dedup", suffix_dedup_stage), ("packing", packing_stage)]

#: The classifier has no SQL; near-duplicates, repeats and packing are tested against brute force, the classifier on held-out labels.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is stored in the shared folder before the next one reads it."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
