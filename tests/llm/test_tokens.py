"""Tokenizers, token files and packing: against the libraries themselves, exact round trips, and naive packing."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerline.llm import byte_bpe, packing, queries, token_files
from ledgerline.llm.vocabularies import byte_encoder, read_ranks, word_encoder

WORDS, RANKS = public_tokenizers.path(queries.WORDS), public_tokenizers.path(queries.RANKS)
AWKWARD = [None, "", " ", "\n\n", "a  b", " a\n b ", "It's 12 o'clock!!", "ÉCOLE ΣΊΣΥΦΟΣ İstanbul ﬁ", "é  x\x85y\x1cz", "日本語 👩‍👩‍👧 text", "<|endoftext|> <|startoftext|>", "x" * 3000, "a\tb\r\nc \t\n d", "don't  we'll\n\n'S 'Re ", "﻿x​­"]


def library(path):
    out = Tokenizer.from_file(path)
    out.encode_special_tokens = True
    return out


def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={})


texts = st.text(st.one_of(st.sampled_from(" \n\t'aAeEsStT0.!é \x85Σ"), st.characters(exclude_categories=["Cs"])), max_size=60)


@settings(max_examples=150, deadline=None)
@given(texts)
def test_words_are_encoded_as_the_library_does(text):
    assert np.frombuffer(word_encoder(WORDS).encode(text), "<u4").tolist() == library_of_words().encode(text, add_special_tokens=False).ids


_kept = {}


def library_of_words():
    return _kept.setdefault("words", library(WORDS))


def library_of_bytes():
    return _kept.setdefault("bytes", reference())


@settings(max_examples=150, deadline=None)
@given(texts)
def test_bytes_are_encoded_as_by_the_ranks(text):
    encoder = byte_encoder(RANKS, public_tokenizers.PATTERN)
    ids = np.frombuffer(encoder.encode(text), "<u4").tolist()
    assert ids == library_of_bytes().encode_ordinary(text)
    assert encoder.decode(ids) == text and encoder.encode_with_offsets(text)[0] == ids


def test_runs_of_ids_may_split_characters():
    encoder = byte_encoder(RANKS, public_tokenizers.PATTERN)
    ids = np.frombuffer(encoder.encode("👩‍👩‍👧"), "<u4").tolist()
    assert b"".join(encoder.decode_bytes([i]) for i in ids).decode() == "👩‍👩‍👧"
    assert "�" in encoder.decode(ids[:1])


def frame(spark, rows):
    return spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, ids string")


def test_byte_bpe_round_trip(spark):
    rows = list(enumerate(AWKWARD)) + [(0, None), (None, "x")]
    found = byte_bpe.encode_texts(frame(spark, rows), RANKS, public_tokenizers.PATTERN)
    assert found.columns == ["doc_id", "text", "ids"]
    back = byte_bpe.decode_ids(found, RANKS, public_tokenizers.PATTERN, as_text=True).collect()
    assert [r["decoded"] for r in back] == [t or "" for _, t in rows]
    digests = byte_bpe.round_trip_digest(frame(spark, rows), RANKS, public_tokenizers.PATTERN).collect()
    for (_, text), row in zip(rows, digests):
        ids = library_of_bytes().encode_ordinary(text or "")
        assert (row["n_tokens"], row["ids_sha256"], row["decoded_sha256"]) == (len(ids), byte_bpe.digest(np.array(ids, "<u4").tobytes()), byte_bpe.digest((text or "").encode()))
    spans = byte_bpe.token_offsets(frame(spark, [(1, "héllo wörld")]), RANKS, public_tokenizers.PATTERN).first()
    assert spans["starts"][0] == 0 and spans["stops"][-1] == 11
    assert byte_bpe.round_trip_digest(frame(spark, []), RANKS, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("bits", [1, 3, 8, 11, 16, 17, 32])
def test_packed_bits_are_read_anywhere(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1001, dtype=np.uint64).astype(np.uint32)
    packed = token_files.pack(ids, bits)
    assert len(packed) == (1001 * bits + 7) // 8
    for a, b in [(0, 1001), (0, 0), (1, 2), (7, 1000), (999, 1001)]:
        assert token_files.unpack(packed, bits, a, b).tolist() == ids[a:b].tolist()
    assert token_files.bits_for(49408) == 16 and token_files.bits_for(1) == 1 and token_files.bits_for(257) == 9


def test_token_files_hold_the_corpus_in_order(spark, tmp_path, monkeypatch):
    rnd = random.Random(1)
    rows = [(k, rnd.choice([*AWKWARD, "word " * 500])) for k in rnd.sample(range(1000), 120)]
    path = str(tmp_path / "files")
    token_files.write_token_files(frame(spark, rows), path, WORDS, end_id=1, shards=5)
    blocks = token_files.read_token_files(spark, path)
    found = {r["doc_id"]: r for r in token_files.documents_of(blocks).collect()}
    ids = {k: library_of_words().encode(t or "", add_special_tokens=False).ids + [1] for k, t in rows}
    start, whole = 0, []
    for k in sorted(ids):
        own = np.array(ids[k], "<u4").tobytes()
        assert (found[k]["start"], found[k]["n_tokens"], found[k]["ids_crc32"]) == (start, len(ids[k]), zlib.crc32(own))
        start += len(ids[k])
        whole += ids[k]
    cut = token_files.tokens_between(blocks, 50, start - 7).orderBy("place").collect()
    assert [r["id"] for r in cut] == whole[50 : start - 7]


def test_token_files_of_awkward_tables(spark, tmp_path):
    token_files.write_token_files(frame(spark, []), str(tmp_path / "none"), WORDS, end_id=1)
    assert token_files.documents_of(token_files.read_token_files(spark, str(tmp_path / "none"))).count() == 0
    token_files.write_token_files(frame(spark, [(None, "a"), (3, None), (3, "b"), (3, "b")]), str(tmp_path / "some"), WORDS, end_id=1)
    found = token_files.documents_of(token_files.read_token_files(spark, str(tmp_path / "some"))).orderBy("start").collect()
    assert [(r["doc_id"], r["start"], r["n_tokens"]) for r in found] == [(None, 0, 2), (3, 2, 1), (3, 3, 2), (3, 5, 2)]


def naive_best_fit(lengths, capacity):
    left = []
    for length in sorted(lengths, reverse=True):
        fits = [i for i, room in enumerate(left) if room >= length]
        if fits:
            left[min(fits, key=lambda i: left[i])] -= length
        else:
            left.append(capacity - length)
    return sorted(left)


@pytest.mark.parametrize("seed", range(12))
def test_the_plan_is_best_fit_decreasing(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([7, 32, 100])
    lengths = [rnd.randint(1, rnd.choice([capacity, max(1, capacity // 3)])) for _ in range(rnd.randint(1, 300))]
    histogram = defaultdict(int)
    for length in lengths:
        histogram[length] += 1
    used = defaultdict(list)
    for length, first, n, each, sequence, at in packing.best_fit_decreasing(dict(histogram), capacity):
        for i in range(n):
            used[sequence + i // each].append((at + (i % each) * length, length))
    for own in used.values():
        end = 0
        for at, length in sorted(own):
            assert at == end
            end += length
        assert end <= capacity
    assert sum(map(len, used.values())) == len(lengths)
    assert sorted(capacity - sum(length for _, length in own) for own in used.values()) == naive_best_fit(lengths, capacity)


@pytest.mark.parametrize("most", [10, 10**4, 10**9])
def test_the_plan_that_is_broadcast_does_not_grow_with_the_pieces(most):
    draw = np.random.default_rng(most)
    plan = packing.best_fit_decreasing({n: int(draw.integers(1, most)) for n in range(1, 2049)}, 2048)
    assert len(plan) <= 2 * 2048


def test_packed_documents(spark):
    rnd = random.Random(3)
    rows = [(k, " ".join(["cat"] * rnd.choice([0, 1, 5, 60, 63, 64, 200]))) for k in range(80)] + [(90, None), (91, ""), (92, None)]
    docs = frame(spark, rows)
    packed = packing.pack_documents(docs, WORDS, end_id=0, capacity=64)
    found = packed.collect()
    ids = {k: library_of_words().encode(t or "", add_special_tokens=False).ids + [0] for k, t in rows}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        own = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["start"] == 64 * r["piece"] and len(own) == r["length"] and zlib.crc32(np.array(own, "<u4").tobytes()) == r["ids_crc32"]
        pieces[r["doc_id"]].append(r["length"])
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert {k: sum(v) for k, v in pieces.items()} == {k: len(v) for k, v in ids.items()}
    assert len(sequences) == len(naive_best_fit([n for v in pieces.values() for n in v], 64))
    for own in sequences.values():
        assert [a for a, _ in sorted(own)] == [sum(n for _, n in sorted(own)[:i]) for i in range(len(own))] and sum(n for _, n in own) <= 64
    whole = {r["sequence_id"]: r["ids"] for r in packing.packed_sequences(docs, packed, WORDS).collect()}
    assert all(len(whole[s]) == sum(n for _, n in own) for s, own in sequences.items())
    assert packing.pack_documents(frame(spark, []), WORDS).count() == 0
    assert packing.pack_documents(frame(spark, [(None, "a"), (1, "b"), (1, "b")]), WORDS).count() == 3


def test_packing_encodes_little_at_once():
    import tracemalloc

    import pyarrow as pa

    from ledgerline.llm.common import split_batches
    from ledgerline.llm.vocabularies import WordEncoder

    words = [f"w{i % 997}" for i in range(900)]
    whole = pa.record_batch({"text": [" ".join(words[i % 50 :]) for i in range(1000)]})
    encoder = WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    tracemalloc.start()
    for batch in split_batches(whole, "text", packing.ENCODED_AT_ONCE):
        encoder.encode_column(batch.column("text"), 0)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert whole.nbytes > 4_000_000 and most < 40_000_000, most
