"""The mix against brute force: targets, budgets, counts a length, and documents by their hash."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import mixing, queries

SCHEMA = "doc_id long, text string, source string, size string, target double, key string, n int, nth int, slice int, taken int, part int, weight int"


def nearest_sum(lengths, counts, budget):
    sums = {0}
    for length, n in zip(lengths, counts):
        sums = {s + k * length for s in sums for k in range(n + 1)}
    return min(sums, key=lambda s: (abs(s - budget), s))


def targets(sizes, weights=(1, 2, 3), most=3):
    """By source: the budget, with what is above the limit shared again until none is."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        free = sum(w for s, w in weight.items() if s not in full)
        rest = total - sum(most * sizes[s] for s in full)
        above = {s for s in order if s not in full and weight[s] * rest > most * sizes[s] * free}
        if not above:
            return {s: float(most * sizes[s]) if s in full else weight[s] * rest / (free or 1) for s in order}
        full |= above


def check(rows, docs, slack=0):
    sizes = [(k, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for k, t, s in docs]
    by_source = Counter()
    for _, s, n in sizes:
        by_source[s] += n
    goal, taken, counts = targets(by_source), Counter(), defaultdict(Counter)
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in rows) == Counter(sizes)
    for r in rows:
        assert r["source_size"] == by_source[r["source"]] and r["target"] == pytest.approx(goal[r["source"]])
        assert r["taken"] == r["times"] * r["size"] and 0 <= r["times"] <= 3
        taken[r["source"]] += r["taken"]
        counts[r["source"]][r["size"]] += 1
    for s, n in by_source.items():
        passes = min(3, int(goal[s] // n)) if n else 0
        rest = min(n, round(goal[s] - passes * n)) if passes < 3 else 0
        lengths = [k for k in counts[s] if k]
        assert abs(taken[s] - passes * n - rest) <= slack, (s, taken[s], goal[s])
        if sum(counts[s].values()) <= 12:
            assert taken[s] - passes * n == nearest_sum(lengths, [counts[s][k] for k in lengths], rest)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(0, 6), max_size=6), st.floats(0, 1))
def test_subset_is_nearest(histogram, share):
    lengths, counts = np.array(list(histogram), np.int64), np.array(list(histogram.values()), np.int64)
    whole = int((lengths * counts).sum())
    budget = int(share * whole)
    for taken in (mixing.subset(lengths, counts, budget), mixing.fitted(lengths, counts, budget, most=10**9)):
        assert (taken >= 0).all() and (taken <= counts).all()
    assert int((mixing.subset(lengths, counts, budget) * lengths).sum()) == nearest_sum(lengths.tolist(), counts.tolist(), budget)
    narrow = mixing.fitted(lengths, counts, budget, most=20)
    assert (narrow >= 0).all() and (narrow <= counts).all() and abs(int((narrow * lengths).sum()) - budget) <= 40


def test_large_budgets_keep_the_mix_of_lengths():
    draw = np.random.default_rng(1)
    lengths = np.unique(draw.integers(1, 20_000, 4000))
    counts = draw.integers(1, 50_000, len(lengths))
    budget = int((lengths * counts).sum()) // 3
    taken = mixing.fitted(lengths, counts, budget)
    assert int((taken * lengths).sum()) == budget and (taken <= counts).all()
    rare = counts < 1000
    assert abs(taken[~rare] / counts[~rare] - 1 / 3).max() < 0.02 or np.count_nonzero(abs(taken[~rare] / counts[~rare] - 1 / 3) > 0.02) < 20


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source").collect()
    rows = mixing.mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()
    check(rows, [tuple(d) for d in docs], slack=60)
    assert sum(r["taken"] for r in rows) == pytest.approx(sum(r["size"] for r in rows), rel=0.01)
    first, again = (sorted(map(tuple, queries.op13_budget_mix(spark.newSession(), sf_dir).collect())) for _ in range(2))
    assert first == again == sorted((r["doc_id"], r["size"], r["source_size"], r["target"], r["taken"]) for r in rows)


def test_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANKED", 7)
    docs = [(i, "w " * 10, "hot") for i in range(60)] + [(100 + i, "one two", "é") for i in range(5)] + [(5, "a b c", None), (None, "a\x0bb\x1cc d", None), (None, None, None), (7, None, "none"), (7, "", "none"), (9, " \n", "Z"), (9, "x " * 5000, "Z"), (8, "x", "😀"), (8, "x", "😀")]
    frame = spark.createDataFrame([(k, t, s, "clash", 0.5, "clash", 1, 1, 1, 1, 1, 1) for k, t, s in docs], SCHEMA)
    rows = mixing.mix(frame).collect()
    check(rows, docs, slack=5000)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(frame.repartition(7)).collect()))
    assert mixing.mix(frame.limit(0)).count() == 0
    empty = mixing.mix(frame.where("text is null")).collect()
    assert len(empty) == 2 and all((r["size"], r["target"], r["taken"]) == (0, 0.0, 0) for r in empty)


def test_one_source_with_one_length_in_many_slices(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANKED", 10)
    docs = [(i, "a b c", "a") for i in range(500)] + [(1000 + i, "a b c d", "b") for i in range(500)]
    rows = mixing.mix(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()
    check(rows, docs, slack=3)
    assert len({r["times"] for r in rows if r["source"] == "a"}) == 2
