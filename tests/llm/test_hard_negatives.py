"""Hard negatives against brute force, the curve, and bounds that prune."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pytest

from ledgerline.llm import hard_negatives as hn
from ledgerline.llm import queries

SCHEMA = "vec_id long, embedding array<float>, label int, block string, uid string, rank int, low int, score double"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "clash", "clash", 1, 1, 0.5) for i, v, label in rows], SCHEMA)


def brute(rows, every=100, scale=256):
    """From (id, vector, label): rows of the result, each vector length for itself."""
    rows = {(i, tuple(math.floor(scale * float(np.float32(x))) for x in v), label) for i, v, label in rows if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i, v, label in rows:
        if i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, other) for j, w, other in rows if j != i and len(w) == len(v)]
        for p, j, _ in sorted(s for s in scored if s[2] == label)[:5]:
            fit = sorted((s, k) for s, k, other in scored if other != label and 30 * -p <= 100 * -s <= 90 * -p)[:10]
            out += [(i, j, r + 1, k, -p, -s) for r, (s, k) in enumerate(fit)]
    return sorted(out)


def collected(df):
    return sorted((r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in df.collect())


@pytest.mark.parametrize("dimensions, bits", [(2, 4), (3, 3), (5, 2), (4, 1)])
def test_the_curve_goes_from_neighbour_to_neighbour(dimensions, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dimensions)))
    places = [p.tobytes() for p in hn.hilbert_places(cells, bits)]
    assert len(set(places)) == len(cells)
    along = cells[sorted(range(len(cells)), key=places.__getitem__)]
    assert (np.abs(np.diff(along, axis=0)).sum(1) == 1).all()


def clustered(seed, n, width=6, labels=4, groups=12, spread=0.03):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(groups, width))
    return [(k, (centres[k % groups] + spread * draw.normal(size=width)).astype(np.float32).tolist(), int(draw.integers(labels))) for k in range(n)]


@pytest.mark.parametrize("block, zones, anchors", [(512, 1024, 1024), (16, 5, 3)])
def test_equal_to_brute_force(spark, monkeypatch, block, zones, anchors):
    monkeypatch.setattr(hn, "BLOCK", block)
    monkeypatch.setattr(hn, "ZONES", zones)
    monkeypatch.setattr(hn, "ANCHORS", anchors)
    draw = np.random.default_rng(3)
    rows = clustered(1, 300) + [(400 + k, draw.normal(size=6).astype(np.float32).tolist(), int(draw.integers(4))) for k in range(300)]
    rows += [(1000 + k, rows[5][1], k % 3) for k in range(150)]  # one vector that many share
    rows += [(0, rows[1][1], 2), (0, rows[1][1], 2), (100, [1.0, 2.0], 1), (101, [1.0, 2.5], 1), (102, [0.5, 0.5], 2), (700, [0.0] * 6, 1), (701, [0.0] * 6, 0)]
    bad = [(800, None, 1), (900, [], 1), (1100, [math.nan] + [1.0] * 5, 1), (1200, [math.inf] + [1.0] * 5, 1), (1300, [None] + [1.0] * 5, 1), (1400, [1.0] * 6, None), (None, [1.0] * 6, 1)]
    assert collected(hn.hard_negatives(frame(spark, rows + bad))) == brute(rows + bad)


def test_bounds_leave_blocks_out_where_rows_lie_in_clusters(spark, monkeypatch):
    monkeypatch.setattr(hn, "BLOCK", 16)
    rows, read = clustered(2, 3000, groups=40), []
    assert collected(hn.hard_negatives(frame(spark, rows), read=read)) == brute(rows)
    (positive, every_own), (negative, every_other) = read
    assert 0 < positive < 0.4 * every_own and 0 < negative < 0.8 * every_other


def test_bounds_hold():
    draw = np.random.default_rng(0)
    rows, anchors = draw.integers(-50, 50, (40, 7)), draw.integers(-9, 9, (5, 7))
    low, high = hn.bounds(anchors, rows.min(0)[None], rows.max(0)[None])
    assert (low <= anchors @ rows.T).all() and (high >= anchors @ rows.T).all()
    with pytest.raises(OverflowError):
        hn.exact_product(np.full((1, 2), 1 << 40), np.full((1, 2), 1 << 40))


def test_few_or_no_rows(spark):
    assert hn.hard_negatives(frame(spark, [])).count() == 0
    assert hn.hard_negatives(frame(spark, [(0, [1.0, 0.0], 1)])).count() == 0
    assert collected(hn.hard_negatives(frame(spark, [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.5, 0.0], 2), (3, [0.95, 0.0], 2)]))) == [(0, 1, 1, 2, 65536, 32768)]


def test_other_names_and_registered_query(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"]) for r in table.collect()]
    assert collected(queries.op11_hard_negatives(spark, sf_dir)) == brute(rows)
