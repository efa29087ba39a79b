"""Vector searches against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest

from ledgerline.llm import exact_topk, projection_forest, queries


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 7, 0.5) for i, v in rows], "vec_id long, embedding array<float>, leaf int, score double")


def awkward(seed, n=700, width=8, equal=150):
    """Random vectors, one of them held by many ids, and rows that take no part."""
    draw = np.random.default_rng(seed)
    rows = [(i, draw.normal(size=width).astype(np.float32).tolist()) for i in range(n)]
    rows += [(n + i, rows[100][1]) for i in range(equal)]
    bad = [None, [], [0.0] * width, [math.nan] + [1.0] * (width - 1), [math.inf] + [1.0] * (width - 1), [None] + [1.0] * (width - 1), [1.0, 2.0]]
    return rows, [(10_000 + 100 * i, v) for i, v in enumerate(bad)]


def nearest(rows, k, every):
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    out = {}
    for q in np.flatnonzero(ids % every == 0):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        order = [j for j in np.lexsort((ids, d)) if j != q][:k]
        out[int(ids[q])] = [(r + 1, int(ids[j]), d[j]) for r, j in enumerate(order)]
    return out


def by_query(found):
    out = {}
    for r in found:
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(v) for q, v in out.items()}


def test_forest_searched_in_full_is_exact(spark):
    rows, bad = awkward(1)
    found = by_query(projection_forest.nearest(frame(spark, rows + bad), k=10, every=50, share=100.0).collect())
    expected = nearest(rows, 10, 50)
    assert found.keys() == expected.keys()
    for q, own in expected.items():
        assert [(r, i) for r, i, _ in found[q]] == [(r, i) for r, i, _ in own]
        assert np.allclose([s for *_, s in found[q]], [s for *_, s in own], rtol=1e-12, atol=1e-12)


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.1"])
def test_forest_recall(spark, folder):
    sf_dir = f"/root/testdata/{folder}"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    expected, found = nearest(rows, 10, 100), by_query(queries.op5_projection_forest(spark, sf_dir).collect())
    hits = sum(len({i for _, i, _ in own} & {i for _, i, _ in found[q]}) for q, own in expected.items())
    assert all(len(found[q]) == 10 for q in expected)
    assert hits >= 0.9 * sum(map(len, expected.values()))


def test_forest_with_few_or_no_vectors(spark):
    found = projection_forest.nearest(frame(spark, [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (100, [1.0, 0.0])]), k=10).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in found) == [(0, 1, 100), (0, 2, 1), (100, 1, 0), (100, 2, 1)]
    assert projection_forest.nearest(frame(spark, [(0, [1.0, 0.0])]), k=10).count() == 0
    assert projection_forest.nearest(frame(spark, []), k=10).count() == 0
    assert projection_forest.nearest(frame(spark, awkward(1)[1]), k=10).count() == 0


def test_equal_rows_are_one_query_and_one_candidate(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [0.0, 1.0]), (2, [2.0, 0.0]), (3, [-1.0, 0.5])]
    found = projection_forest.nearest(frame(spark, rows), k=10).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in found) == [(0, 1, 2), (0, 2, 1), (0, 3, 3)]
    found = exact_topk.top_by_inner_product(frame(spark, rows), k=10).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in found) == [(0, 1, 2), (0, 2, 1), (0, 3, 3)]
    found = exact_topk.top_by_inner_product(frame(spark, [*rows, (0, [0.0, 3.0])]), k=1).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in found) == [(0, 1, 1), (0, 1, 2)]


def test_vectors_meet_those_of_their_length(spark):
    draw = np.random.default_rng(8)
    rows = {w: [(1000 * w + i, draw.normal(size=w).astype(np.float32).tolist()) for i in range(n)] for w, n in ((4, 150), (6, 40), (3, 1))}
    every = [row for own in rows.values() for row in own]
    found = by_query(projection_forest.nearest(frame(spark, every), k=10, every=50, share=100.0).collect())
    expected = {q: own for w in rows for q, own in nearest(rows[w], 10, 50).items() if own}
    assert {q: [i for _, i, _ in own] for q, own in found.items()} == {q: [i for _, i, _ in own] for q, own in expected.items()}
    found = by_query(exact_topk.top_by_inner_product(frame(spark, every), k=10, every=50).collect())
    assert found == {q: own for w in rows for q, own in best(rows[w], 10, 50).items() if own}


def test_queries_of_a_leaf_are_split(spark, monkeypatch):
    monkeypatch.setattr(projection_forest, "QUERIES", 3)
    monkeypatch.setattr(projection_forest, "SEARCHED_AT_ONCE", 2)
    rows, _ = awkward(3)
    found = by_query(projection_forest.nearest(frame(spark, rows), k=10, every=50, share=100.0).collect())
    assert {q: [i for _, i, _ in own] for q, own in found.items()} == {q: [i for _, i, _ in own] for q, own in nearest(rows, 10, 50).items()}


def test_reading_stops_where_components_differ_in_weight():
    draw = np.random.default_rng(4)
    scale = np.array([1000, 30, 2, 1])
    rows, asked, read = np.floor(draw.normal(size=(4000, 4)) * scale).astype(np.int64), np.floor(draw.normal(size=(5, 4)) * scale).astype(np.int64), []
    q, found, score = exact_topk.block_top(asked, np.full(5, -1), rows, np.arange(4000), 10, read)
    assert read and read[-1][0] < 1 and read[-1][1] < 0.05
    for i in range(5):
        whole = rows @ asked[i]
        assert score[q == i].tolist() == sorted(whole.tolist(), reverse=True)[:10]


def best(rows, k, every):
    ids, x = np.array([i for i, _ in rows]), np.floor(1024 * np.array([v for _, v in rows], float)).astype(np.int64)
    out = {}
    for q in np.flatnonzero(ids % every == 0):
        score = x @ x[q]
        order = [j for j in np.lexsort((ids, -score)) if j != q][:k]
        out[int(ids[q])] = [(r + 1, int(ids[j]), int(score[j])) for r, j in enumerate(order)]
    return out


@pytest.mark.parametrize("block", [4096, 64])
def test_top_k_is_exact(spark, block, monkeypatch):
    monkeypatch.setattr(exact_topk, "CANDIDATES", block)
    monkeypatch.setattr(exact_topk, "QUERIES", max(4, block // 16))
    rows, bad = awkward(2)
    zero = [row for row in bad if row[1] and set(row[1]) == {0.0}]
    found = by_query(exact_topk.top_by_inner_product(frame(spark, rows + bad), k=10, every=50).collect())
    assert found == best(rows + zero, 10, 50)


def test_top_k_with_few_or_no_vectors(spark):
    found = exact_topk.top_by_inner_product(frame(spark, [(0, [1.0, 0.0]), (1, [0.5, 1.0])]), k=10).collect()
    assert [tuple(r) for r in found] == [(0, 1, 1, 1024 * 512)]
    assert exact_topk.top_by_inner_product(frame(spark, []), k=10).count() == 0


def test_bounds_never_lose_a_winner():
    draw = np.random.default_rng(0)
    for _ in range(20):
        rows, asked = draw.integers(-50, 50, (300, 6)), draw.integers(-50, 50, (9, 6))
        ids, own = draw.permutation(300), draw.permutation(300)[:9]
        q, found, score = exact_topk.block_top(asked, own, rows, ids, 5)
        for i in range(9):
            whole = rows @ asked[i]
            expected = [j for j in np.lexsort((ids, -whole)) if ids[j] != own[i]][:5]
            assert found[q == i].tolist() == ids[expected].tolist() and score[q == i].tolist() == whole[expected].tolist()
    with pytest.raises(OverflowError):
        exact_topk.block_top(np.full((1, 2), 1 << 40), np.array([-1]), np.full((3, 2), 1 << 40), np.arange(3), 1)
