"""Substring, suffix-array and near-duplicate operators against brute force on small corpora."""

from __future__ import annotations

import hashlib
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import types as T

from ledgerline.llm import lookups, queries, simhash, substring_dedup, suffix_dedup, suffix_sort

#: Documents with columns that are named as the operators' own.
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("kept", T.StringType()), T.StructField("batch", T.IntegerType()), T.StructField("fp", T.LongType())])
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus(spark, rows):
    return spark.createDataFrame([(k, t, "x", 1, 2) for k, t in rows], SCHEMA)


def word_text(rnd, n, vocabulary=400):
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n))


def documents(seed):
    """Copies, passages that several documents share, repeats inside one document, and awkward rows."""
    rnd = random.Random(seed)
    passages = [word_text(rnd, rnd.choice([49, 50, 51, 80, 200])) for _ in range(5)]
    rows = []
    for k in range(40):
        parts = [word_text(rnd, rnd.randrange(0, 60))]
        for _ in range(rnd.randrange(3)):
            parts += [rnd.choice(passages), word_text(rnd, rnd.randrange(0, 30))]
        rows.append((k, rnd.choice([" ", "\n", " \t"]).join(parts)))
    whole = word_text(rnd, 300)
    rows += [(40, whole), (41, whole), (42, whole + " tail"), (43, "head " + whole), (44, whole[:-40])]
    rows += [(45, None), (46, ""), (47, " \n "), (48, "é" * 5000), (49, " ".join(["same"] * 500)), (50, " ".join(["same"] * 500)), (51, word_text(rnd, 20000, 10**6))]
    rnd.shuffle(rows)
    return rows


def words_removed(rows):
    windows = {}
    split = {k: WORD.findall(t or "") for k, t in rows}
    for k in sorted(split):
        for i in range(len(split[k]) - 49):
            windows.setdefault(tuple(split[k][i : i + 50]), k)
    out = {}
    for k, own in split.items():
        gone = [False] * len(own)
        for i in range(len(own) - 49):
            if windows[tuple(own[i : i + 50])] < k:
                gone[i : i + 50] = [True] * 50
        out[k] = (len(own), sum(gone), " ".join(w for w, g in zip(own, gone) if not g))
    return out


@pytest.mark.parametrize("seed", range(2))
def test_substring_dedup_is_exact(spark, seed):
    rows = documents(seed)
    found = substring_dedup.substring_dedup(corpus(spark, rows)).collect()
    expected = words_removed(rows)
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in found} == expected
    assert all(sum(s["stop"] - s["first"] for s in r["spans"]) == r["n_removed"] for r in found)
    assert any(n for _, n, _ in expected.values())


def test_substring_dedup_with_null_and_equal_ids(spark):
    text = " ".join(f"w{i}" for i in range(60))
    found = substring_dedup.substring_dedup(corpus(spark, [(5, text), (5, text), (None, text), (None, None)])).collect()
    assert sorted((r["doc_id"] or -1, r["n_removed"]) for r in found) == [(-1, 0), (-1, 60), (5, 0), (5, 0)]
    assert substring_dedup.substring_dedup(corpus(spark, [])).count() == 0


def test_the_cover_has_every_difference():
    assert {(a - b) % substring_dedup.PERIOD for a in substring_dedup.COVER for b in substring_dedup.COVER} == set(range(substring_dedup.PERIOD))


def bytes_removed(texts):
    counts = {}
    for raw in texts:
        for i in range(len(raw) - 399):
            counts[raw[i : i + 400]] = counts.get(raw[i : i + 400], 0) + 1
    out = []
    for raw in texts:
        gone = np.zeros(len(raw) + 1, int)
        for i in range(len(raw) - 399):
            if counts[raw[i : i + 400]] > 1:
                gone[i] += 1
                gone[i + 400] -= 1
        gone = np.cumsum(gone[:-1]) > 0
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(raw), int(gone.sum()), spans, bytes(np.frombuffer(raw, np.uint8)[~gone])))
    return out


@pytest.mark.parametrize("hot_above", [suffix_dedup.HOT, 1])
def test_suffix_dedup_is_exact(spark, hot_above):
    rnd = random.Random(7)
    rows = documents(3)[:52] + [(60, "ab" * 700), (61, "ö" * 300 + "x"), (62, None)]
    passage = word_text(rnd, 90)
    rows += [(70 + i, word_text(rnd, 20) + passage[i : len(passage) - 3 * i] + word_text(rnd, 20)) for i in range(8)]
    found = suffix_dedup.suffix_dedup(corpus(spark, rows), carry=["kept", "fp"], hot_above=hot_above)
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "spans", "kept", "kept", "fp"]
    expected = dict(zip([k for k, _ in rows], bytes_removed([(t or "").encode() for _, t in rows])))
    assert {r[0]: (r[1], r[2], len(r[3]), bytes(r[4])) for r in found.collect()} == expected
    assert suffix_dedup.suffix_dedup(corpus(spark, [])).count() == 0


def later_bytes_removed(texts, window, characters=False):
    """Of texts in order: every byte covered by a window that also starts at an earlier place; of characters only whole ones."""
    seen, out = set(), []
    for raw in texts:
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - window + 1):
            if raw[i : i + window] in seen:
                gone[i : i + window] = True
            seen.add(raw[i : i + window])
        at = 0
        for c in raw.decode() if characters else "":
            stop = at + len(c.encode())
            gone[at:stop] = gone[at:stop].all()
            at = stop
        out.append(bytes(np.frombuffer(raw, np.uint8)[~gone]))
    return out


@pytest.mark.parametrize("hot_above", [suffix_dedup.HOT, 1])
@pytest.mark.parametrize("window", [100, 200])
def test_suffix_dedup_keeps_the_first_copy(spark, hot_above, window):
    rnd = random.Random(window)
    rows = documents(4)[:52] + [(60, "ab" * 700), (61, "ö" * 300 + "x"), (62, None), (63, "ab" * 60 + "y" + "ab" * 300)]
    passage = word_text(rnd, 90)
    rows += [(70 + i, word_text(rnd, 20) + passage[4 * (i % 3) : len(passage) - 3 * i] + word_text(rnd, 20) + passage[:300]) for i in range(12)]
    rnd.shuffle(rows)
    found = {r["doc_id"]: bytes(r["kept"]) for r in suffix_dedup.suffix_dedup(corpus(spark, rows), hot_above=hot_above, window=window, keep_first=True).collect()}
    rows.sort()
    assert found == dict(zip([k for k, _ in rows], later_bytes_removed([(t or "").encode() for _, t in rows], window)))


def test_suffix_dedup_keeps_the_first_copy_among_repeated_rows(spark):
    text = "".join(chr(0x4E00 + i) for i in range(200))
    rows = [(None, text), (1, text), (1, text), (1, "a" + text), (2, "b" + text + "c"), (None, text)]
    found = suffix_dedup.suffix_dedup(corpus(spark, rows), as_text=True, window=200, keep_first=True).collect()
    kept = sorted((r["doc_id"] or 9, r["kept"]) for r in found)
    assert sum(text in k for _, k in kept) == 1 and [d for d, k in kept if text in k] == [1]
    assert [k.replace(text, "") for _, k in kept] in (["", "", "a", "bc", "", ""], ["", "a", "", "bc", "", ""])
    assert suffix_dedup.suffix_dedup(corpus(spark, []), keep_first=True).count() == 0


def test_a_character_stays_with_any_of_its_bytes(spark):
    shared = "".join(chr(0x4E00 + i) for i in range(80))
    # the windows begin and end inside characters: their first and last bytes are those of others
    rows = [(1, chr(0x4DFF) + shared + chr(0x4E7F)), (2, chr(0x4DFE) + shared + chr(0x4E7E)), (3, None), (4, "é" * 300 + "ê")]
    found = {r["doc_id"]: r["kept"] for r in suffix_dedup.suffix_dedup(corpus(spark, rows), as_text=True, window=150, keep_first=True).collect()}
    cut = later_bytes_removed([(t or "").encode() for _, t in rows], 150, characters=True)
    assert found == {k: raw.decode() for (k, _), raw in zip(rows, cut)} and found[2] == chr(0x4DFE) + chr(0x4E7E)


def most_memory(run):
    """What run() gives, and the most bytes that it held at once."""
    tracemalloc.start()
    out = run()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return out, most


def test_a_cut_holds_a_few_copies_of_its_batch():
    rnd = random.Random(3)
    passage = "".join(rnd.choices("abcdé ", k=4000))
    texts = ["".join(rnd.choices("abcdé ", k=3000)) + passage[i % 7 :] for i in range(600)]
    table = pa.table({"doc_id": pa.array(range(600)), "text": texts})
    places = suffix_dedup.Places(table, 250)
    doc, row, at = places.order_of(places.place)
    asked = lookups.first_records(places.a, places.b, doc, 0, row, at).tobytes()
    got = {suffix_dedup.CLASSES: [r.column("data")[0].as_py() for r in lookups.answer_first(suffix_dedup.CLASSES, [0], [asked])]}
    cut, most = most_memory(lambda: list(suffix_dedup._cut(0, table, got, 250, True, suffix_dedup.HOT, True)))
    assert sum(cut[0].column("n_removed").to_pylist()) > 500 * len(passage) and most < 16 * len(places.raw)


def test_runs_are_united_within_documents():
    rnd = random.Random(5)
    for _ in range(200):
        sizes = [rnd.choice([0, 1, 7, 30]) for _ in range(6)]
        offsets = np.cumsum([0, *sizes])
        runs = [sorted(rnd.sample(range(a, b + 1), 2)) for a, b in zip(offsets.tolist(), offsets[1:].tolist()) if b > a for _ in range(rnd.randrange(4))]
        rnd.shuffle(runs)
        first, stop = suffix_dedup._united(np.array([a for a, _ in runs], np.int64), np.array([b for _, b in runs], np.int64), offsets)
        expected = []
        for a, b in zip(offsets.tolist(), offsets[1:].tolist()):
            covered = [any(x <= i < y for x, y in runs) for i in range(a, b)]
            expected += [(a + m.start(), a + m.end()) for m in re.finditer("1+", "".join("01"[c] for c in covered))]
        assert list(zip(first.tolist(), stop.tolist())) == expected


def test_answers_in_parts_are_those_of_one_part(monkeypatch):
    rnd = np.random.default_rng(7)
    asked = []
    for batch in range(40):
        a = rnd.integers(0, 150_000, 5000).astype(np.uint64)
        asked.append(lookups.first_records(a, a % np.uint64(3), np.arange(5000), batch, np.zeros(5000, np.int64), np.arange(5000)).tobytes())

    def told():
        out = {}
        for replies in lookups.answer_first(1, list(range(40)), asked):
            for who, data in zip(replies.column("batch").to_pylist(), replies.column("data").to_pylist()):
                out.setdefault(who, []).append(np.frombuffer(data, lookups.FIRST))
        return {who: np.sort(np.concatenate(x)).tolist() for who, x in out.items()}

    parts, most = most_memory(lambda: sum(r.num_rows for r in lookups.answer_first(1, list(range(40)), asked)))
    in_parts = told()
    monkeypatch.setattr(lookups, "RECORDS_AT_ONCE", 1 << 30)
    assert in_parts == told() and parts > 40 and most < 3 * sum(map(len, asked))


def test_suffix_dedup_takes_all_copies_and_torn_characters(spark):
    text = "".join(chr(0x4E00 + i) for i in range(200))
    rows = [(None, text), (1, text), (1, text), (2, "a" + text[:150] + "b" + text[:150])]
    found = suffix_dedup.suffix_dedup(corpus(spark, rows), as_text=True).collect()
    assert sorted((r["doc_id"] or -1, r["n_removed"]) for r in found) == [(-1, 600), (1, 600), (1, 600), (2, 900)]
    assert {r["kept"] for r in found} == {"", "ab"}


@pytest.mark.parametrize("seed", range(3))
def test_sorted_suffixes_and_shared_windows(seed):
    rnd = random.Random(seed)
    width, base = 20, bytes(rnd.choice(b"ab") for _ in range(60))
    rights = [base[rnd.choice([0, 0, 1]) :][: rnd.randint(1, width)] for _ in range(60)]
    lefts = [base[rnd.choice([0, 0, 5]) :][: rnd.randint(0, width - 1)] for _ in range(60)]
    group = np.array([rnd.randrange(3) for _ in range(60)])
    table = lambda strings: np.array([list(s.ljust(width, b"\0")) for s in strings], np.uint8)
    sizes = lambda strings: np.array([len(s) for s in strings])
    order = suffix_sort.deep_shallow_order(table(rights), sizes(rights), group)
    assert [(group[i], rights[i]) for i in order] == sorted(zip(group.tolist(), rights))
    least, most = suffix_sort.repeated_offsets(table(rights), sizes(rights), table(lefts), sizes(lefts), group, width)
    for i in range(60):
        own = []
        for j in range(60):
            if i != j and group[i] == group[j]:
                r, l = (suffix_sort.shared_prefix(x[i], x[j]) for x in (rights, lefts))  # noqa: E741
                if r and l >= width - r:
                    own.append((width - r, l))
        assert (least[i], most[i]) == ((min(a for a, _ in own), max(b for _, b in own)) if own else (width, -1))


def test_find_tells_equal_first_keys_apart():
    a, b = np.array([5, 5, 5, 9], np.uint64), np.array([3, 1, 2, 1], np.uint64)
    assert lookups.find(np.array([5, 5, 9, 9, 1], np.uint64), np.array([2, 4, 1, 2, 1], np.uint64), a, b).tolist() == [2, -1, 3, -1, -1]


def slow_fingerprint(text):
    own = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(own[i : i + 4]) for i in range(max(1, len(own) - 3))] if own else []
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for i in range(64):
            counts[i] += h >> i & 1
    return sum(1 << i for i in range(64) if 2 * counts[i] > len(shingles))


@pytest.mark.parametrize("crowd", [simhash.CROWD, 3])
def test_simhash_components_are_exact(spark, crowd):
    rnd = random.Random(5)
    base = [word_text(rnd, 150) for _ in range(6)]
    rows = []
    for k in range(120):
        own = rnd.choice(base).split()
        for _ in range(rnd.randrange(3)):
            own[rnd.randrange(len(own))] = "Edited"
        rows.append((k, " ".join(own)))
    rows += [(200, None), (201, ""), (202, "a b"), (203, "A  B"), (204, "one"), (205, rows[0][1]), (205, rows[0][1])]
    found = simhash.near_duplicates(corpus(spark, rows), crowd=crowd).collect()
    prints = [(k, slow_fingerprint(t)) for k, t in rows]
    parent = {f: f for _, f in prints}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for a in parent:
        for b in parent:
            if (a ^ b).bit_count() <= 4:
                parent[root(a)] = root(b)
    least = {}
    for k, f in prints:
        least[root(f)] = min(k, least.get(root(f), k))
    assert sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in found) == sorted((k, f"{f:016x}", least[root(f)]) for k, f in prints)


def test_simhash_without_rows_and_with_null_ids(spark):
    assert simhash.near_duplicates(corpus(spark, [])).count() == 0
    found = simhash.near_duplicates(corpus(spark, [(None, "a b c"), (3, "a b c"), (None, "d")])).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in found) == [(-1, -1), (-1, 3), (3, 3)]


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    found = {r["a"]: r["root"] for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(1, 21)}, **{100 + i: 100 for i in range(1, 30)}}


def test_similar_documents_link_and_others_do_not(spark):
    rnd = random.Random(9)
    rows, expected = [], {}
    for g in range(30):
        base = word_text(rnd, 200, 5000).split()
        for copy in range(3):
            own = list(base)
            if copy:
                own[rnd.randrange(200)] = f"edit{copy}"
            rows.append((10 * g + copy, " ".join(own)))
            expected[10 * g + copy] = 10 * g
    rows += [(1000 + i, word_text(rnd, 100, 5000)) for i in range(60)] + [(None, "x"), (2000, None), (2001, "")]
    expected |= {1000 + i: 1000 + i for i in range(60)} | {2000: 2000, 2001: 2000}
    found = simhash.similar_documents(corpus(spark, rows)).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == expected


def test_queries_give_the_contract_columns(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    sha = lambda x: hashlib.sha256(x).hexdigest()
    expected = words_removed(list(texts.items()))
    found = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in queries.op1_substring_dedup(spark, sf_dir).collect()}
    assert found == {k: (n, m, sha(kept.encode())) for k, (n, m, kept) in expected.items()}
    expected = dict(zip(texts, bytes_removed([(t or "").encode() for t in texts.values()])))
    found = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in queries.op6_suffix_dedup(spark, sf_dir).collect()}
    assert found == {k: (n, m, s, sha(kept)) for k, (n, m, s, kept) in expected.items()}
    found = queries.op9_simhash(spark, sf_dir).collect()
    assert {r["doc_id"]: int(r["fingerprint"], 16) for r in found} == {k: slow_fingerprint(t) for k, t in texts.items()}
