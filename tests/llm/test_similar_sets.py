"""Similar documents against the Jaccard similarity of all pairs."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import similar_sets

SCHEMA = "doc_id long, text string"


def word_text(rnd, n, vocabulary=5000):
    return [f"w{rnd.randrange(vocabulary)}" for _ in range(n)]


def edited(rnd, words, edits):
    own = list(words)
    for at in rnd.sample(range(len(own)), edits):
        own[at] = f"e{rnd.randrange(10**9)}"
    return own


def shingles(words):
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def by_brute_force(rows):
    """The least id reachable over all pairs with a Jaccard similarity of 0.8 or more, and the similarities of all pairs that share a shingle."""
    sets = {k: shingles(words) for k, words in rows}
    root, seen = {k: k for k in sets}, []

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in combinations(sorted(sets), 2):
        shared, whole = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        if shared:
            seen.append(shared / whole)
        if 5 * shared >= 4 * whole:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {k: find(k) for k in sets}, seen


def components(spark, rows, **options):
    found = similar_sets.similar_documents(spark.createDataFrame([(k, " ".join(words)) for k, words in rows], SCHEMA), **options).collect()
    assert len(found) == len(rows)
    return {r["doc_id"]: r["component_id"] for r in found}


@pytest.mark.parametrize("crowd", [similar_sets.CROWD, 7])
def test_copies_inside_a_family_are_joined_whatever_its_least_member_is(spark, crowd):
    rnd = random.Random(1)
    boilerplate = word_text(rnd, 130)
    rows = []
    for k in range(60):  # members share most of their text, pairs of them nearly all
        own = boilerplate + word_text(rnd, 60)
        rows += [(2 * k, own), (2 * k + 1, edited(rnd, own, 2))]
    expected, _ = by_brute_force(rows)
    assert sorted(expected.values()) == sorted(2 * (k // 2) for k in range(120))
    assert components(spark, rows, crowd=crowd) == expected


@pytest.mark.parametrize("sample", [similar_sets.SAMPLE, 1])
def test_every_pair_of_the_similarity_is_found(spark, sample):
    rnd = random.Random(2)
    rows = []
    for k in range(150):  # five to ten edits: similarities from 0.6 to 0.9, half above 0.8
        own = word_text(rnd, rnd.choice([40, 120, 250, 400]))
        rows += [(2 * k, own), (2 * k + 1, edited(rnd, own, max(1, len(own) * rnd.randint(15, 30) // 1000)))]
    expected, seen = by_brute_force(rows)
    assert sum(0.8 <= j < 0.85 for j in seen) >= 10
    assert components(spark, rows, sample=sample) == expected


def test_pairs_just_below_and_above_the_similarity_are_told_apart(spark):
    rows = []
    for k in range(100):  # prefixes of a text of distinct words: the similarity is the share of the shingles kept
        own = [f"d{k}w{i}" for i in range(104)]
        rows += [(2 * k, own), (2 * k + 1, own[: 104 - 20 - k % 2])]
    expected = {i: 4 * (i // 4) if i % 4 < 2 else i for i in range(200)}  # shares of 0.80 and 0.79
    assert by_brute_force(rows)[0] == expected
    assert components(spark, rows) == expected


@pytest.mark.parametrize("gathered", [similar_sets.GATHERED, 3])
@pytest.mark.parametrize("rows_a_batch", [1, 2, 5, 1000])
def test_buckets_are_read_from_sorted_rows_whatever_the_batches(monkeypatch, gathered, rows_a_batch):
    monkeypatch.setattr(similar_sets, "GATHERED", gathered)
    rnd = random.Random(rows_a_batch)
    rows = sorted((rnd.randrange(-30, 30), rnd.randrange(-40, 40)) for _ in range(300))
    rows = sorted(rows + rows[:40])
    batches = [pa.record_batch({"key": [k for k, _ in part], "node": [n for _, n in part]}, pa.schema([("key", pa.int64()), ("node", pa.int64())])) for part in (rows[i : i + rows_a_batch] for i in range(0, len(rows), rows_a_batch))]
    buckets = {}
    for batch in similar_sets.shared_keys(batches):
        for r in batch.to_pylist():
            own = buckets.setdefault(r["bucket"], set())
            own |= {r["node"], r["low"]}
            assert r["low"] <= r["node"]
    expected = {frozenset(n for k, n in rows if k == key) for key in {k for k, _ in rows}}
    expected = {x for x in expected if len(x) > 1}
    found = {frozenset(x) for x in buckets.values() if len(x) > 1}
    assert expected <= found
    if gathered > 1000:
        assert found == expected and len(buckets) == len(expected)


def test_sketches_fold_and_bound_the_distance(spark):
    draw = np.random.default_rng(1)
    sets = [np.unique(draw.integers(0, 1 << 63, n).astype(np.uint64)) for n in (200, 256, 300, 2048, 2060, 5000)]
    sets += [np.union1d(own[len(own) // 10 :], draw.integers(0, 1 << 63, 5).astype(np.uint64)) for own in sets]
    fine = [similar_sets.fine_sketch(own) for own in sets]
    assert [x is None for x in fine[:4]] == [True, True, False, False]
    for own, x in zip(sets, fine):
        while x is not None and len(x) > similar_sets.WORDS:
            x = x[: len(x) // 2] ^ x[len(x) // 2 :]
        assert x is None or (x == similar_sets.sketch(own)).all()
    rows = [(i, j, fine[i].tolist(), fine[j].tolist()) for i in range(12) for j in range(12) if fine[i] is not None and fine[j] is not None and 0.5 <= len(fine[i]) / len(fine[j]) <= 2]
    table = spark.createDataFrame(rows, "i int, j int, a array<bigint>, b array<bigint>")
    for r in table.select("i", "j", similar_sets._fine_distance(table["a"], table["b"]).alias("apart")).collect():
        assert r["apart"] <= len(np.setxor1d(sets[r["i"]], sets[r["j"]]))
        if r["i"] != r["j"] and abs(r["i"] - r["j"]) != 6:
            assert r["apart"] > 0.222 * (len(sets[r["i"]]) + len(sets[r["j"]])) / 2


def test_long_documents_are_told_apart(spark):
    rnd = random.Random(9)
    rows = []
    for k in range(6):
        own = word_text(rnd, 6000, 10**6)
        rows += [(3 * k, own), (3 * k + 1, edited(rnd, own, 60)), (3 * k + 2, own[:3500] + word_text(rnd, 2500, 10**6))]
    expected, _ = by_brute_force(rows)
    assert len(set(expected.values())) == 12 and components(spark, rows) == expected


def test_no_pair_of_the_similarity_is_discarded_in_a_bucket():
    draw = np.random.default_rng(3)
    sets = []
    for _ in range(40):
        own = np.unique(draw.integers(0, 1 << 63, 400).astype(np.uint64) << np.uint64(1))
        sets += [own, np.union1d(own[30:], draw.integers(0, 1 << 63, 12).astype(np.uint64)), np.union1d(own[90:], draw.integers(0, 1 << 63, 60).astype(np.uint64))]
    side = np.array([len(x) for x in sets]), np.array([similar_sets.sketch(x) for x in sets]), np.arange(len(sets))
    a, b = similar_sets.open_pairs(side, side, similar_sets.Fraction("0.8"), True, True)
    linked = {(i, j) for i in range(120) for j in range(i + 1, 120) if 5 * len(np.intersect1d(sets[i], sets[j])) >= 4 * len(np.union1d(sets[i], sets[j]))}
    assert len(linked) == 40 and linked <= set(zip(a.tolist(), b.tolist())) and len(a) < 60


def test_pivots_and_fine_sketches_discard_in_a_bucket_without_loss(monkeypatch):
    draw = np.random.default_rng(4)
    sets = []
    for n in (60, 240, 300, 1000, 1900, 2100):  # of each size copies that link, and two families that nearly do
        base = draw.integers(0, 1 << 63, n).astype(np.uint64)
        for k in range(12):
            share = n * (3, 17, 25)[k % 3] // 100
            sets.append(np.unique(np.concatenate([base[share:], draw.integers(0, 1 << 63, share).astype(np.uint64)])))
    fine = [similar_sets.fine_sketch(x) for x in sets]
    plain = np.array([len(x) for x in sets]), np.array([similar_sets.sketch(x) for x in sets]), np.arange(len(sets))
    side = *plain, pa.array(fine, pa.list_(pa.int64()))
    share = similar_sets.Fraction("0.8")
    linked = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if 5 * len(np.intersect1d(sets[i], sets[j])) >= 4 * len(np.union1d(sets[i], sets[j]))}
    coarse = set(zip(*(x.tolist() for x in similar_sets.open_pairs(plain, plain, share, True, True))))
    found = set(zip(*(x.tolist() for x in similar_sets.open_pairs(side, side, share, True, True))))
    assert linked <= found <= coarse and len(found - linked) < len(coarse - linked) / 2
    for i in (0, 40):  # two blocks, one of longer sets
        cut = [tuple(x[k : k + 30] for x in side[:3]) + (side[3][k : k + 30],) for k in (i, 72 - 30)]
        pairs = {tuple(sorted((a + i, b + 42))) for a, b in zip(*(x.tolist() for x in similar_sets.open_pairs(*cut, share, False, True))) if a + i != b + 42}
        assert {(a, b) for a, b in found if i <= a < i + 30 and b >= 42} <= pairs
    monkeypatch.setattr(similar_sets, "PIVOTS", similar_sets.PIVOTS[:0])
    monkeypatch.setattr(similar_sets, "pivot_table", lambda x: np.zeros((0, len(x)), np.int32))
    assert set(zip(*(x.tolist() for x in similar_sets.open_pairs(side, side, share, True, True)))) == found


def test_fingerprints_link_near_copies_by_pivot_tables(spark, monkeypatch):
    calls = []
    own = similar_sets.fingerprint_links
    monkeypatch.setattr(similar_sets, "fingerprint_links", lambda *a: calls.append(a) or own(*a))
    sets = spark.createDataFrame([(5, 0), (6, 0), (7, 15), (8, 1 << 40), (9, -1)], "node long, fp long")
    assert {tuple(r) for r in similar_sets._fingerprint_pairs(sets).collect()} >= {(5, 6)}
    joined = {frozenset(r) for r in similar_sets._fingerprint_pairs(sets).collect()}
    assert {frozenset((5, 7)), frozenset((5, 8))} <= joined and not any(9 in pair for pair in joined)
    assert calls and calls[0][1] == similar_sets.BITS
