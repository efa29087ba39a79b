"""SimHash near-duplicates: fingerprints, links found with pivot distance tables, components.

Fingerprints link at `bits` or fewer differing bits. Pairs come from buckets, not from a cross
join: the 64 bits are cut into bits+3 blocks, of which a linked pair agrees in at least three,
so every linked pair meets in a bucket of three equal blocks. In a bucket the distances of each
fingerprint to fixed reference fingerprints (the pivots) are tabled; two fingerprints that link
differ by at most `bits` in every column of the table, so pairs with a larger difference are
discarded and only the survivors' own distance is computed. Buckets emit a spanning forest of
their links, never all of them, and a bucket that outgrows a task is split in the same way by
its remaining bits, which loses no link.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vocabularies
from .common import dealt_apart, dealt_by_count, dropped, materialize, mix, split_batches

#: Reference fingerprints: any fixed values serve.
PIVOTS = mix(np.arange(1, 17, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
#: Fingerprints of one bucket that a task compares; larger buckets are split.
CROWD = 4096
#: Rows of a bucket compared at once.
STRIPE = 256
#: Members of a crowd whose links are found first, so that the pairs among these need no look.
STARS = 64
#: Times that a crowded bucket is split; then the bits outside its mask bound its size.
MOST_LEVELS = 3


def shingle_hashes(text: bytes | None, words: int) -> np.ndarray:
    """XXH64 (seed 42) of every run of so many words, A-Z lower-cased, repeats included; of the whole text if it has fewer."""
    own = (text or b"").lower().split()
    if not own:
        return np.zeros(0, np.uint64)
    joined = b" ".join(own)
    if len(own) <= words:
        hashes = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        ends = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1)
        starts = np.concatenate([[0], ends[:-1]])
        hash64 = xxhash.xxh64_intdigest
        hashes = [hash64(joined[a:b], 42) for a, b in zip(starts[: len(own) - words + 1].tolist(), (ends[words - 1 :] - 1).tolist())]
    return np.array(hashes, np.uint64)


def majority_bits(hashes: np.ndarray) -> np.ndarray:
    """Which of the 64 bits are set in more than half of the hashes."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        counts += np.unpackbits(hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return 2 * counts > len(hashes)


def fingerprint(text: bytes | None, words: int) -> int:
    """The SimHash of a text's word shingles, as an unsigned integer (no word: zero)."""
    return int(np.packbits(majority_bits(shingle_hashes(text, words)), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp (the fingerprint's 64 bits as a long) of every row; nothing is shuffled."""

    def hashed(batches):
        vocabularies.forget()
        for whole in batches:
            for batch in split_batches(whole, "text"):
                texts = batch.column("text").cast(pa.large_binary()).to_pylist()
                own = np.array([fingerprint(text, words) for text in texts], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(own)], ["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(hashed, "doc_id bigint, fp bigint")


def block_masks(outer: int, blocks: int, equal: int) -> list[int]:
    """The outer mask with every choice of `equal` out of so many even blocks of the bits outside it."""
    outside = [p for p in range(64) if not outer >> p & 1]
    cut = [sum(1 << int(p) for p in part) for part in np.array_split(outside, blocks)]
    return [outer | sum(own) for own in combinations(cut, equal)]


def _long(value) -> Column:
    return F.lit(int(np.uint64(value).astype(np.int64))).cast("long")


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after the links (a, b): the least label over links, with pointer jumping."""
    while True:
        before = label
        label = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, before[a], low)
        np.minimum.at(label, before[b], low)
        label = label[label]
        if (label == before).all():
            return label


def _links_in(crowd: np.ndarray, bits: int) -> np.ndarray:
    """For each fingerprint of a bucket, the place of one member of its component there (a spanning forest of its links)."""
    order = np.argsort(np.bitwise_count(crowd ^ PIVOTS[0]), kind="stable")
    own = crowd[order]
    n = len(own)
    table = np.bitwise_count(own[:, None] ^ PIVOTS[None, :]).astype(np.int16)
    label = np.arange(n)
    for _ in range(min(STARS, n // 8)):  # dense crowds: first all links of a few members
        alone = np.flatnonzero(label == np.arange(n))
        centre = alone[len(alone) // 2]
        near = np.flatnonzero(np.bitwise_count(own ^ own[centre]) <= bits)
        label = _merge(label, np.full(len(near), centre), near)
    stops = np.searchsorted(table[:, 0], table[:, 0] + bits, "right")  # the first column bounds what a row can link to
    for at in range(0, n, STRIPE):
        rows = np.arange(at, min(at + STRIPE, n))
        last = int(stops[rows[-1]])
        others = np.arange(at, last)
        a, b = np.nonzero((others[None, :] < stops[rows][:, None]) & (others[None, :] > rows[:, None]) & (label[others][None, :] != label[rows][:, None]))
        a, b = a + at, b + at
        for pivot in range(1, len(PIVOTS)):
            near = np.abs(table[a, pivot] - table[b, pivot]) <= bits
            few = near.sum() > 0.9 * len(a)
            a, b = a[near], b[near]
            if few:  # what is left is close: the distance itself decides
                break
        near = np.bitwise_count(own[a] ^ own[b]) <= bits
        if near.any():
            label = _merge(label, a[near], b[near])
    out = np.empty(n, np.int64)
    out[order] = order[label]
    return out


def _bucket_links(members: DataFrame, bits: int) -> DataFrame:
    """Links (a, b) of a spanning forest of every bucket (which, key) of members."""

    def link(table: pa.Table) -> pa.Table:
        crowd = table.column("fp").combine_chunks().to_numpy().view(np.uint64)
        root = _links_in(crowd, bits)
        other = np.flatnonzero(root != np.arange(len(crowd)))
        signed = crowd.view(np.int64)
        return pa.table({"a": pa.array(signed[other]), "b": pa.array(signed[root[other]])})

    return members.select("which", "key", "fp").groupBy("which", "key").applyInArrow(link, "a bigint, b bigint")


def _pair_links(pairs: DataFrame, bits: int) -> DataFrame:
    """The pairs (a, b) that link: the pivot table discards, the distance itself verifies."""
    distances = [F.abs(F.bit_count(F.col("a").bitwiseXOR(_long(p))) - F.bit_count(F.col("b").bitwiseXOR(_long(p)))) for p in PIVOTS]
    near = reduce(lambda x, y: x & y, [d <= bits for d in distances])
    return pairs.where(near).where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits)


def links(prints: DataFrame, bits: int, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) between distinct fingerprints fp that join the same components as all links would."""
    found = None
    masks = block_masks(0, bits + 3, 3)
    members = prints.select("fp", F.array(*map(_long, masks)).alias("masks"), F.lit(0).alias("base"))
    for level in range(MOST_LEVELS + 1):
        dealt = members.select("fp", "base", F.posexplode("masks").alias("choice", "mask"))
        dealt = dealt.select("fp", (F.col("base") + F.col("choice")).alias("which"), F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
        sizes = materialize(dealt.groupBy("which", "key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1"), "buckets")
        most = crowd if level < MOST_LEVELS else 1 << 62
        again = dealt.join(sizes.where("n > 2").select("which", "key", "n"), ["which", "key"])
        own = _pair_links(sizes.where("n = 2").select("a", "b"), bits).unionByName(_bucket_links(again.where(F.col("n") <= most), bits))
        own = materialize(own.distinct(), "links")
        found = own if found is None else found.unionByName(own)
        # a row per mask at most
        crowded = sorted(r[0] for r in sizes.where(F.col("n") > most).select("which").distinct().collect())
        if not crowded:
            break
        # linked members of a bucket agree outside its mask but for `bits`: two of bits+2 blocks are equal again
        finer = {w: block_masks(masks[w], bits + 2, 2) for w in crowded}
        width = len(finer[crowded[0]])
        inner = prints.sparkSession.createDataFrame(
            [(w, [int(np.uint64(m).astype(np.int64)) for m in finer[w]], i * width) for i, w in enumerate(crowded)], "which int, masks array<bigint>, base int"
        )
        members = materialize(again.where(F.col("n") > most).select("which", "fp"), "crowded").join(F.broadcast(inner), "which").select("fp", "masks", "base")
        # buckets of different outer keys stay apart, for the new masks hold the outer ones
        masks = [m for w in crowded for m in finer[w]]
    return found


def _size(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(a, root): for every linked value the least value that it reaches, by alternating small and large stars.

    The small star comes first: it hangs what many values link to on the least of it, so a dense group of links
    shrinks to about one per value before edges are looked at from both ends. The edges of one value are dealt to several tasks.
    """
    edges = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _size(edges)
    while before[0]:
        least = edges.groupBy("a").agg(F.min("b").alias("least"), F.count("*").alias("n"))
        own = dealt_by_count(edges, least, "a", ["b"])
        small = own.select(F.col("a"), F.col("least").alias("b")).unionByName(own.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))).distinct()
        small = materialize(small, "edges")
        both = small.unionByName(small.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"), F.count("*").alias("n"))
        large = dealt_by_count(both, least, "a", ["b"]).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = materialize(large.distinct(), "edges")
        dropped(edges, small)
        edges, now = large, _size(large)
        if now == before:
            break
        before = now
    return edges.select("a", F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, words: int = 4, bits: int = 4, id_col: str = "doc_id", text_col: str = "text", crowd: int = CROWD) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id (the least doc_id reachable over links) of every row.

    Rows with equal fingerprints are linked; so are texts without a word (fingerprint zero), nulls included.
    A null doc_id keeps its row; a component of null ids only has a null component_id. Other columns are not read.
    """
    prints = materialize(fingerprints(docs, words, id_col, text_col), "fingerprints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = components(links(distinct.select("fp"), bits, crowd)).withColumnRenamed("a", "fp")
    grouped = distinct.join(rooted, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = grouped.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n"))
    named = dealt_by_count(grouped, names, "root", ["fp"]).select("fp", "component_id")
    return dealt_apart(prints, named, "fp", ["doc_id"]).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def similar_documents(docs: DataFrame, words: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and component_id of documents whose word shingles are similar: 64 bits are too few for that, so the sets themselves decide (similar_sets)."""
    from . import similar_sets

    return similar_sets.similar_documents(docs, words, similarity, id_col, text_col)
