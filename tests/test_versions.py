"""Chains of runs in versions: rows that are too large, guards, writers that meet, readers during a swap."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ledgerline import runs
from ledgerline.versions import Conflict, Versions

SCHEMA = "dataset string, key long, v string"


def frame(spark, rows):
    return spark.createDataFrame([("d", k, v) for k, v in rows], SCHEMA)


def ops(found):
    return sorted((r["key"], r["op"]) for r in found.operations.collect())


def test_a_row_too_large_writes_nothing_and_keeps_its_entry(spark, tmp_path):
    chain, large = runs.Chain(spark, str(tmp_path)), "x" * 500
    first = chain.full(frame(spark, [(1, "a"), (2, "b"), (3, large), (4, "d"), (5, "e")]), ["v"], "run 1", largest=300)
    assert ops(first) == [(1, "insert"), (2, "insert"), (4, "insert"), (5, "insert")]
    counts = first.counts.first()
    assert (counts["oversized"], counts["inserted"]) == (1, 4) and counts["largest"] > 500
    entry = {r["key"]: (r["feature_id"], r["hash"]) for r in first.index.collect()}
    second = chain.next(frame(spark, [(1, large), (2, "b"), (3, "c"), (4, "D")]), ["v"], "run 2", largest=300)
    assert ops(second) == [(3, "insert"), (4, "update"), (5, "delete")]  # 1 grew: no update and no delete
    after = {r["key"]: (r["feature_id"], r["hash"]) for r in chain.index().collect()}
    assert after[1] == entry[1] and after[2] == entry[2] and set(after) == {1, 2, 3, 4}
    keys = spark.createDataFrame([("d", 1), ("d", 2), ("d", 9)], "dataset string, key long")
    third = chain.next(frame(spark, [(1, "small"), (2, large), (3, "c"), (4, "changed but not named")]), ["v"], "run 3", 300, keys, spark.createDataFrame([("d", 2), ("d", 3), ("d", 8)], "dataset string, key long"))
    assert ops(third) == [(1, "update"), (3, "delete")]  # 2 was consumed by the touch
    counts = third.counts.first()
    assert (counts["oversized"], counts["unknown"]) == (1, 2)
    assert {r["key"] for r in chain.index().collect()} == {1, 2, 4}
    assert {r["v"] for r in chain.target().collect()} == {"small", "b", "D"}
    assert {r["v"] for r in chain.target(1).collect()} == {"a", "b", "d", "e"} and {r["v"] for r in chain.target(2).collect()} == {"a", "b", "c", "D"}
    assert {r["feature_id"] for r in chain.target().collect()} == {r["feature_id"] for r in chain.index().collect()}
    assert chain.compact() == 4 and {r["v"] for r in chain.target().collect()} == {"small", "b", "D"}
    with pytest.raises(ValueError, match="needs the change feed"):
        chain.next(frame(spark, []), ["v"], "run 4")


def test_an_increment_needs_an_index(spark, tmp_path):
    with pytest.raises(ValueError, match="no index"):
        runs.Chain(spark, str(tmp_path)).next(frame(spark, [(1, "a")]), ["v"], "run 1")


def test_of_two_writers_one_wins(spark, tmp_path):
    versions = Versions(spark, str(tmp_path))
    assert versions.latest() == 0
    assert versions.commit(0, {"t": spark.range(3)}) == 1
    reader = versions.table("t")
    assert versions.commit(1, {"t": spark.range(5)}, facts={"who": "one"}) == 2
    with pytest.raises(Conflict):
        versions.commit(1, {"t": spark.range(7)}, facts={"who": "two"})
    assert versions.table("t").count() == 5 and reader.count() == 3 and versions.facts(2) == {"who": "one"}
    assert len(list((tmp_path / "data").iterdir())) == 2  # what lost is gone
    (tmp_path / "published" / "0000000003").write_text("")  # a pointer that is being written is no version yet
    assert versions.latest() == 2 and versions.table("t").count() == 5
    with pytest.raises(ValueError):
        versions.table("other")


def test_deltas_of_any_order_give_the_newest_state(spark, tmp_path):
    rnd = random.Random(4)
    state = {k: 0 for k in range(50)}
    versions = Versions(spark, str(tmp_path))
    versions.commit(0, {"t": spark.createDataFrame(list(state.items()), "k long, v long")})
    for number in range(1, 5):
        rows = []
        for k in rnd.sample(range(70), 25):
            op = "insert" if k not in state else rnd.choice(["update", "delete"])
            rows.append((op, k, number))
            if op == "delete":
                del state[k]
            else:
                state[k] = number
        versions.commit(number, {"t": spark.createDataFrame(rows, "op string, k long, v long")}, deltas=["t"])
        assert {r["k"]: r["v"] for r in versions.table("t", keys=["k"]).collect()} == state
    assert versions.table("t", 1, ["k"]).agg(F.sum("v")).first()[0] == 0


@pytest.mark.parametrize("seed", range(3))
def test_feeds_give_what_order_gives(spark, seed):
    rnd = random.Random(seed)
    before = {k: rnd.choice("ab") for k in range(60) if rnd.random() < 0.7}
    now = [(k, rnd.choice("ab") * rnd.choice([1, 1, 400])) for k in rnd.sample(range(60), 45)]
    touched, gone = rnd.sample(range(70), 30), rnd.sample(range(70), 20)
    index = runs.extract(frame(spark, list(before.items())), ["v"], "run 1").index
    keys = lambda xs: spark.createDataFrame([("d", k) for k in xs], "dataset string, key long")
    found = runs.increment(index, frame(spark, now), ["v"], "run 2", 300, keys(touched), keys(gone))
    expected, unknown, left, held = [], 0, set(before), dict(before)
    for k, v in now:
        if k in touched:
            there = k in left
            left.discard(k)
            if there and before[k] == v:
                continue
            if len(v) < 300:
                expected.append((k, "update" if there else "insert"))
                held[k] = v
    for k in gone:
        if k in left:
            expected.append((k, "delete"))
            del held[k]
        else:
            unknown += 1
    assert ops(found) == sorted(expected) and found.counts.agg(F.sum("unknown")).first()[0] == unknown
    assert {r["key"] for r in found.index.collect()} == set(held)
