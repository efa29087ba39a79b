"""The pipeline's stages, one after the other, against brute force and against cases planted in its documents."""

from __future__ import annotations

import random

import numpy as np
import pytest

import corpus_pipeline
from ledgerline.llm import packing
from ledgerline.llm.vocabularies import word_encoder
from .test_dedup import later_bytes_removed
from .test_similar_sets import by_brute_force, edited, word_text

STAGE = dict(corpus_pipeline.STAGES)


def near_and_repeats(texts):
    """Of texts by id: what near-dedup and suffix dedup leave, by brute force."""
    words = [(k, (t or "").lower().split()) for k, t in texts.items()]
    root, _ = by_brute_force(words)
    kept = {k: texts[k] or "" for k in sorted(texts) if root[k] == k}
    cut = later_bytes_removed([t.encode() for t in kept.values()], corpus_pipeline.REPEAT, characters=True)
    return kept, {k: raw.decode() for k, raw in zip(kept, cut)}


def check_packing(rows, texts):
    encoder = word_encoder(corpus_pipeline.public_tokenizers.path(corpus_pipeline.TOKENIZER))
    sizes = {k: len(encoder.encode(t)) // 4 + 1 for k, t in texts.items()}
    assert {k: sum(r["length"] for r in rows if r["doc_id"] == k) for k in sizes} == sizes
    lengths = [n for size in sizes.values() for n in [2048] * (size // 2048) + [size % 2048] * (size % 2048 > 0)]
    plan = packing.best_fit_decreasing({n: lengths.count(n) for n in set(lengths)}, 2048)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == [0, *np.cumsum([n for _, n in own])[:-1].tolist()] and sum(n for _, n in own) <= 2048
    assert len(sequences) == max(s + -(-n // per) for _, _, n, per, s, _ in plan)


def test_all_stages_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = STAGE["quality"](spark, docs, sf_dir).collect()
    kept = spark.createDataFrame(kept, docs.schema)
    texts = {r["doc_id"]: r["text"] for r in kept.collect()}
    unlike, cut = near_and_repeats(texts)
    near = spark.createDataFrame(STAGE["near_dedup"](spark, kept, sf_dir).collect(), docs.schema)
    assert {r["doc_id"]: r["text"] or "" for r in near.collect()} == unlike
    suffix = spark.createDataFrame(STAGE["suffix_dedup"](spark, near, sf_dir).collect(), docs.schema)
    assert {r["doc_id"]: r["text"] for r in suffix.collect()} == cut
    assert all(r["n_chars"] == len(r["text"]) for r in suffix.collect())
    rows = STAGE["packing"](spark, suffix, sf_dir).collect()
    check_packing(rows, cut)
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).select("doc_id", "piece", "start", "length", "ids_crc32").collect())) == sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)


@pytest.mark.parametrize("n", [51, 60, 90, 120])
def test_planted_passages_and_copies_are_caught_and_clean_documents_stay(spark, sf_dir, n):
    rnd = random.Random(n)
    passage = " ".join(word_text(rnd, n))
    clean = {k: " ".join(word_text(rnd, rnd.randint(80, 400))) for k in range(30)}
    planted = {100 + k: " ".join(word_text(rnd, 120)) + " " + passage + " " + " ".join(word_text(rnd, 120)) for k in range(8)}
    copies = {200 + k: clean[k] for k in range(5)} | {300 + k: " ".join(edited(rnd, clean[k].split(), 1)) for k in range(10, 20)}
    texts = clean | planted | copies
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in texts.items()], schema)
    unlike, cut = near_and_repeats(texts)
    near = STAGE["near_dedup"](spark, docs, sf_dir)
    found = {r["doc_id"]: r["text"] for r in STAGE["suffix_dedup"](spark, near, sf_dir).collect()}
    assert found == cut and set(found) == set(clean) | set(planted)
    assert all(found[k] == t for k, t in clean.items()) and passage in found[100]
    assert sum(passage in found[k] for k in planted) == 1 and all(len(found[k]) < len(planted[k]) - 0.9 * len(passage) for k in planted if k > 100)


def test_a_very_long_document_goes_through(spark, sf_dir):
    rnd = random.Random(3)
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    long = " ".join(word_text(rnd, 60_000))
    docs = spark.createDataFrame([(1, long, "en", "s", len(long)), (2, long, "en", "s", len(long)), (3, "short", "en", "s", 5)], schema)
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs, sf_dir).collect()
        if name != "packing":
            docs = spark.createDataFrame(rows, schema)
            assert {r["doc_id"] for r in rows} <= {1, 2, 3} and (name == "quality" or len(rows) <= 2)
    assert max(r["piece"] for r in rows) > 20
