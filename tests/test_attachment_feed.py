"""The feed's sets against its order: every dataset is a random case that is played edit by edit."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from ledgerline.operators import attachment_feed as feed

BASIS = "dataset long, pos long, global_id string, oid long, name string, feature_id string, size long, content_type string"
ADDS = BASIS.replace("pos", "seq")
UPDATES = "dataset long, seq long, global_id string, name string, size long, content_type string"
DELETES = "dataset long, seq long, global_id string"


def case(rnd, dataset):
    ids, names = [f"g{k}" for k in range(rnd.randint(1, 6))], ["n", "m"]
    size = lambda: rnd.choice([None, 1, 2])
    kind = lambda: rnd.choice([None, None, "t", "u"])
    unused = ids + [f"h{k}" for k in range(2)]
    rnd.shuffle(unused)
    basis = [(dataset, k, unused.pop() if unused and rnd.random() < 0.7 else None, rnd.choice([1, 1, 2, None]), rnd.choice(names), f"f{k}", size(), kind()) for k in range(rnd.randint(0, 5))]
    adds = [(dataset, k, rnd.choice([None, *ids]), rnd.choice([1, 1, 2, None]), rnd.choice([*names, None]), rnd.choice(["p", "p", "p", None]), size(), kind()) for k in range(rnd.randint(0, 7))]
    updates = [(dataset, k, rnd.choice([None, *ids]), rnd.choice(names), size(), kind()) for k in range(rnd.randint(0, 3))]
    deletes = [(dataset, k, rnd.choice([None, *ids])) for k in range(rnd.randint(0, 3))]
    return basis, adds, updates, deletes


def played(basis, adds, updates, deletes):
    index, used, out = {b[2]: b[2:] for b in basis if b[2]}, set(), []
    for dataset, seq, gid, oid, name, feature, size, kind in adds:
        said = name or gid or "unnamed"
        if feature is None:
            out.append((dataset, "adds", seq, "orphan", gid, None, said, False))
            continue
        found = next((b for b in basis if b[1] not in used and gid and b[2] == gid), None)
        if found is None and oid is not None and name is not None:
            same = [b for b in basis if b[1] not in used and (b[3], b[4]) == (oid, name)]
            if len(same) > 1:
                out.append((dataset, "adds", seq, "ambiguous", gid, feature, said, False))
                continue
            found = same[0] if same else None
        if found is None:
            out.append((dataset, "adds", seq, "add", gid, feature, said, False))
            entry = (gid, oid, said, feature, size, kind)
        else:
            used.add(found[1])
            _, _, g, o, n, f, s, t = found
            comparable = (size is not None and s is not None) or (kind is not None and t is not None)
            moved = (size is not None and size != s) or (kind is not None and kind != t)
            op = "replace_unseen" if not comparable else "replace" if moved else "repeat"
            out.append((dataset, "adds", seq, op, gid, f, n, said != n))
            entry = (gid or g, oid if oid is not None else o, n, f, s, t) if op == "repeat" else (gid or g, oid, n, f, size, kind)
            if g and g != entry[0]:
                index.pop(g, None)
        if entry[0]:
            index[entry[0]] = entry
    for dataset, seq, gid, name, size, kind in updates:
        if gid is None or gid not in index:
            out.append((dataset, "updates", seq, "no_id" if gid is None else "unknown", gid, None, None, False))
            continue
        g, o, n, f, s, t = index[gid]
        out.append((dataset, "updates", seq, "replace", gid, f, n, name != n))
        index[gid] = (g, o, n, f, size if size is not None else s, kind or t)
    for dataset, seq, gid in deletes:
        held = index.pop(gid, None) if gid else None
        out.append((dataset, "deletes", seq, "delete" if held else "unknown", gid, held and held[3], held and held[2], False))
    return out, [(dataset_of(basis, adds), *e) for e in index.values()]


def dataset_of(basis, adds):
    return (basis or adds)[0][0]


def test_sets_give_what_the_order_gives(spark):
    rnd = random.Random(11)
    cases = [case(rnd, k) for k in range(1500)]
    frames = [spark.createDataFrame([r for c in cases for r in c[i]], schema) for i, schema in enumerate((BASIS, ADDS, UPDATES, DELETES))]
    window = feed.attachment_feed(*frames)
    results, index = [], []
    for c in cases:
        a, b = played(*c)
        results += a
        index += b
    columns = ["dataset", "phase", "seq", "op", "global_id", "feature_id", "name", "renamed"]
    assert sorted(map(str, (tuple(r) for r in window.results.select(*columns).collect()))) == sorted(map(str, results))
    assert sorted(map(str, (tuple(r) for r in window.index.select(*feed.ENTRY).collect()))) == sorted(map(str, index))
    assert {op for _, _, _, op, *_ in results} == {"orphan", "ambiguous", "add", "replace", "replace_unseen", "repeat", "no_id", "unknown", "delete"}


def test_an_add_that_comes_late_for_its_row_is_found_by_name(spark):
    basis = [(1, 0, "g", 1, "n", "f0", 5, None), (1, 1, None, 1, "m", "f1", 5, None)]
    adds = [(1, 0, None, 1, "n", "p", 5, None), (1, 1, "g", 1, "m", "p", 6, None), (1, 2, None, 1, "m", "p", 5, None)]
    window = feed.attachment_feed(spark.createDataFrame(basis, BASIS), spark.createDataFrame(adds, ADDS), spark.createDataFrame([], UPDATES), spark.createDataFrame([], DELETES))
    found = {r["seq"]: (r["op"], r["feature_id"]) for r in window.results.collect()}
    assert found == {0: ("repeat", "f0"), 1: ("replace", "f1"), 2: ("add", "p")}
    assert [tuple(r) for r in window.index.collect()] == [(1, "g", 1, "m", "f1", 6, None)]


def test_datasets_without_global_ids_are_left_alone(spark):
    basis, adds, updates, deletes = (spark.createDataFrame(rows, schema) for rows, schema in (
        ([(1, 0, "g", 1, "n", "f", 5, None), (2, 0, "g", 1, "n", "f", 5, None)], BASIS), ([(1, 0, "g", 1, "n", "p", 6, None)], ADDS), ([(2, 0, "g", "n", 7, None)], UPDATES), ([(1, 1, "g")], DELETES)))
    window = feed.attachment_feed(basis, adds, updates, deletes, spark.createDataFrame([(1,)], "dataset long"))
    assert sorted((r["dataset"], r["phase"], r["op"]) for r in window.results.collect()) == [(1, "adds", "no_ids"), (1, "deletes", "no_ids"), (2, "updates", "replace")]
    assert sorted((r["dataset"], r["size"]) for r in window.index.collect()) == [(1, 5), (2, 7)]
    assert feed.attachment_feed(*(df.limit(0) for df in (basis, adds, updates, deletes))).results.count() == 0
    assert window.results.agg(F.count("*")).first()[0] == 3


def nothing(spark):
    return spark.createDataFrame([], UPDATES), spark.createDataFrame([], DELETES)


def test_a_chain_of_lost_rows_takes_as_many_rounds_as_it_has_bits(spark, monkeypatch):
    n, stores, own = 40, [], feed.stored
    monkeypatch.setattr(feed, "stored", lambda df, name: stores.append(name) or own(df, name))
    basis = [(1, k, f"g{k}", 1, f"n{k}", f"f{k}", 5, None) for k in range(n)]
    adds = [(1, k, f"g{k - 1}" if k else None, 1, f"n{k}", "p", 5, None) for k in range(n + 1)]
    window = feed.attachment_feed(spark.createDataFrame(basis, BASIS), spark.createDataFrame(adds, ADDS), *nothing(spark))
    found = {r["seq"]: (r["op"], r["feature_id"]) for r in window.results.collect()}
    assert found == {k: ("repeat", f"f{k}") for k in range(n)} | {n: ("add", "p")}
    assert len(stores) <= 20


def test_adds_meet_their_rows_unsorted_and_names_are_reduced_before_they_move(spark, monkeypatch):
    plans, own = {}, feed.stored
    monkeypatch.setattr(feed, "stored", lambda df, name: plans.update({name: df._jdf.queryExecution().executedPlan().toString()}) or own(df, name))
    basis, adds, updates, deletes = case(random.Random(1), 1)
    feed.attachment_feed(spark.createDataFrame(basis, BASIS), spark.createDataFrame(adds, ADDS), *nothing(spark))
    met = plans["adds"].split("ShuffledHashJoin")
    assert len(met) == 4 and "Sort" not in "".join(met[:3]) and "WindowGroupLimit" in plans["adds-met"]


def test_few_adds_meet_their_names_only(spark, monkeypatch):
    plans, own, frames = {}, feed.stored, [spark.createDataFrame([], BASIS), spark.createDataFrame([], ADDS)]
    monkeypatch.setattr(feed, "stored", lambda df, name: plans.update({name: df._jdf.queryExecution().optimizedPlan().toString()}) or own(df, name))
    feed.attachment_feed(*frames, *nothing(spark))
    few = plans["adds-met"]
    monkeypatch.setattr(feed, "FEW", -1)
    feed.attachment_feed(*frames, *nothing(spark))
    assert "LeftSemi" in few and few.index("WindowGroupLimit") < few.index("LeftSemi") and "LeftSemi" not in plans["adds-met"]
