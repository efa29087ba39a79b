"""Documents whose sets of word shingles are similar: every pair at the Jaccard similarity or above, exactly.

Prefix filtering finds the candidates: with one order of all shingles, two sets of similarity s share one
of the first n - ceil(s n) + 1 shingles of each, so every such pair meets in the bucket of a shingle.
Shingles that are common in a sample come last in the order; the sample moves work only, for any order is
exact. Sketches (the parity of the shingles in each of 1024 parts) differ in no more bits than the sets
differ in shingles, so they discard without loss; large sets have finer ones besides. What is left is decided by the sets themselves.

SimHash fingerprints of the documents come first, linked by their buckets and pivot tables (simhash.links): they find near copies, but
cannot decide a similarity. In the buckets of shingles the distances of each sketch to fixed reference sketches (the pivots) are
tabled in turn: two sets that link differ by no more in any column than their sketches may, so the table discards pairs before they are compared.

Buckets never emit all their pairs at once. First each member is paired with the least of its bucket, then,
in buckets that hold several components still, with its nearest of another component in each block, and last
all pairs of different components that their sketches, the finer ones included, leave open are looked at. So what joins is what all
links would join.
"""

from __future__ import annotations

from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vocabularies
from .common import BASE, BASE_2, RollingHash, dealt_apart, dropped, materialize, mix, split_batches
from .simhash import components, majority_bits, shingle_hashes
from .simhash import links as fingerprint_links

#: Documents whose shingles are counted for the order, the count from which one is common, and common ones kept.
SAMPLE = 4000
COMMON = 3
MOST_COMMON = 100_000
#: 64-bit words of a sketch.
WORDS = 16
#: Differing bits at which SimHash fingerprints make a candidate.
BITS = 4
#: Reference sketches: any fixed values serve.
PIVOTS = mix(np.arange(1, 16 * WORDS + 1, dtype=np.uint64) * BASE).reshape(16, WORDS)
#: Members of a block: a task compares two blocks of a bucket.
CROWD = 2048
#: Rows compared at once.
STRIPE = 64
#: Rounds of nearest members before all open pairs are looked at.
ROUNDS = 2
#: Rows of keys, ids or pairs that are broadcast at most.
FEW = 200_000
#: Rows of a bucket that a task holds before it passes them on.
GATHERED = 1 << 20

_PRINT = "doc_id bigint, node bigint, fp bigint, n int, sketch array<bigint>, fine array<bigint>, prefix array<bigint>"


def _node(own: np.ndarray) -> int:
    """A 64-bit name of a set of sorted hashes."""
    if not len(own):
        return 0
    one, two = (RollingHash(own, b).of(np.array([0]), np.array([len(own)])) for b in (BASE, BASE_2))
    return int(mix(one + mix(two + np.uint64(len(own)))).view(np.int64)[0])


def sketch(own: np.ndarray, level: int = 0) -> np.ndarray:
    """The parity of the hashes in each of 1024 * 2^level parts of the hash space, as 64-bit words; both halves of one level xor to the level below."""
    parts = 64 * WORDS << level
    parity = np.bincount((own & np.uint64(parts - 1)).astype(np.int64), minlength=parts) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").view("<i8")


def fine_sketch(own: np.ndarray) -> np.ndarray | None:
    """A sketch of four parts a hash at least, for sets that fill the plain one: of their hashes few share a part."""
    level = max(0, (len(own) - 1).bit_length() - 8)
    return sketch(own, level) if level else None


def _fine_distance(a: Column, b: Column) -> Column:
    """In how many bits two fine sketches differ, the longer one folded to the length of the other (null: one has none)."""

    def folded(x: Column, y: Column) -> Column:
        half = F.size(x) / 2
        return F.when(F.size(x) > F.size(y), F.zip_with(F.slice(x, 1, half.cast("int")), F.slice(x, (half + 1).cast("int"), half.cast("int")), lambda i, j: i.bitwiseXOR(j))).otherwise(x)

    return F.aggregate(F.zip_with(folded(a, b), folded(b, a), lambda i, j: F.bit_count(i.bitwiseXOR(j))), F.lit(0), lambda total, x: total + x)


def prefix(own: np.ndarray, common: np.ndarray, counts: np.ndarray, share: Fraction) -> np.ndarray:
    """The first n - ceil(share n) + 1 of sorted distinct hashes: those that are not common first, then by rising count."""
    n = len(own)
    if not n:
        return own
    length = n + (-share.numerator * n // share.denominator) + 1
    if len(common):
        at = np.minimum(np.searchsorted(common, own), len(common) - 1)
        own = own[np.lexsort((own, np.where(common[at] == own, counts[at], 0)))]
    return own[:length]


def _common(rows: DataFrame, words: int, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes that are common in a sample of the rows, sorted, and their counts there."""
    step = max(1, rows.count() // sample)

    def spread(batches):
        for whole in batches:
            for batch in split_batches(whole, "text"):
                for text in batch.column("text").cast(pa.large_binary()).to_pylist():
                    yield pa.RecordBatch.from_arrays([pa.array(np.unique(shingle_hashes(text, words)).view(np.int64))], ["h"])

    some = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(step)) == 0)
    counted = some.mapInArrow(spread, "h bigint").groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= COMMON)
    found = counted.orderBy(F.desc("n"), "h").limit(MOST_COMMON).toArrow()
    hashes, counts = (found.column(c).to_numpy() for c in ("h", "n"))
    hashes = hashes.view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], counts[order]


def keys_of_sets(batches):
    """(key, node) for every key of every set's prefix; of the equal sets that a task meets, one speaks for all."""
    seen: set[int] = set()
    for batch in batches:
        names, lists = batch.column("node").to_numpy(), batch.column("prefix")
        _, first = np.unique(names, return_index=True)
        new = np.array([i for i in np.sort(first).tolist() if names[i] not in seen], np.int64)
        seen.update(names[new].tolist())
        taken = lists.take(pa.array(new))
        sizes = np.diff(taken.offsets.to_numpy())
        yield pa.RecordBatch.from_arrays([taken.flatten(), pa.array(np.repeat(names[new], sizes))], ["key", "node"])


def _buckets_of(key: np.ndarray, node: np.ndarray, more: bool) -> pa.RecordBatch:
    """The members of the keys that several sets have, from rows sorted by key and node; buckets of the same members are one.

    bucket is a hash of the members, low the least of them, few: there are two. more: the only key has rows that are not here.
    """
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
    key, node = key[fresh], node[fresh]
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(key)))
    names = node.view(np.uint64)
    low = node[starts]
    if more:
        bucket = mix(key[starts].view(np.uint64))
    else:
        bucket = mix(np.add.reduceat(mix(names + np.uint64(1)), starts) + mix(sizes.astype(np.uint64))) if len(starts) else names
    several = (sizes > 1) | more
    inside = np.repeat(several, sizes)
    bucket, low, few = (np.repeat(x, sizes)[inside] for x in (bucket.view(np.int64), low, (sizes == 2) & (not more)))
    node = node[inside]
    order = np.lexsort((node, bucket))
    once = np.ones(len(order), bool)
    once[1:] = (np.diff(bucket[order]) != 0) | (np.diff(node[order]) != 0)
    own = order[once]
    own = own[(node[own] != low[own]) | ~few[own]]  # of two members the pair (low, other) says all
    return pa.RecordBatch.from_arrays([pa.array(bucket[own]), pa.array(node[own]), pa.array(low[own]), pa.array(few[own])], ["bucket", "node", "low", "few"])


def shared_keys(batches):
    """The buckets of rows that come sorted by key and node; a bucket beyond GATHERED rows is passed on in parts."""
    key, node, low = np.zeros(0, np.int64), np.zeros(0, np.int64), None
    for batch in batches:
        key = np.concatenate([key, batch.column("key").to_numpy()])
        node = np.concatenate([node, batch.column("node").to_numpy()])
        if not len(key):
            continue
        last = int(np.searchsorted(key, key[-1]))
        if low is not None and last:  # the rest of a bucket that was passed on in parts
            end = int(np.searchsorted(key, key[0], "right"))
            yield _part_of(key[:end], node[:end], low)
            key, node, last, low = key[end:], node[end:], last - end, None
        if last:
            yield _buckets_of(key[:last], node[:last], False)
            key, node = key[last:], node[last:]
        if len(key) > GATHERED:
            low = node[0] if low is None else low
            yield _part_of(key, node, low)
            key, node = key[-1:], node[-1:]
    if len(key):
        yield _part_of(key, node, low) if low is not None else _buckets_of(key, node, False)


def _part_of(key: np.ndarray, node: np.ndarray, low: int) -> pa.RecordBatch:
    part = _buckets_of(key, node, True)
    return part.set_column(2, "low", pa.array(np.full(part.num_rows, low, np.int64)))


def pivot_table(sketches: np.ndarray) -> np.ndarray:
    """The distances of sketches to the pivots, a row per pivot."""
    return np.stack([np.bitwise_count(sketches ^ pivot).sum(1, dtype=np.int32) for pivot in PIVOTS])


def _fine_apart(left: pa.ListArray, right: pa.ListArray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In how many bits the fine sketches of pairs differ, the longer one folded to the length of the other (0: one has none)."""
    apart = np.zeros(len(a), np.int64)
    sides = []
    for fine, at in ((left, a), (right, b)):
        sizes = np.asarray(fine.value_lengths().fill_null(0)).astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        sides.append((fine.flatten().to_numpy().view(np.uint64), starts[at], sizes[at]))
    (x, x_at, x_size), (y, y_at, y_size) = sides
    for i, j in {*zip(x_size.tolist(), y_size.tolist())}:
        words = min(i, j)
        mine = np.flatnonzero((x_size == i) & (y_size == j)) if words else np.zeros(0, np.int64)
        for part in np.array_split(mine, -(-len(mine) * max(i, j) // (1 << 18)) or 1):
            rows = [np.bitwise_xor.reduce(flat[at[part, None] + np.arange(size)].reshape(len(part), -1, words), 1) for flat, at, size in ((x, x_at, i), (y, y_at, j))] if len(part) else []
            if rows:
                apart[part] = np.bitwise_count(rows[0] ^ rows[1]).sum(1, dtype=np.int64)
    return apart


def open_pairs(left: tuple, right: tuple, share: Fraction, same: bool, every: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places (in left, in right) of pairs of different roots whose sizes, pivot tables and sketches leave open that they link.

    left, right: sizes, sketches, roots and, where there are any, fine sketches of two blocks (same: one block). Of each left row all such pairs, or the nearest only.
    """
    p, q = share.numerator, share.denominator
    (n, x, root, *x_fine), (m, y, other, *y_fine) = left, right
    x, y = x.view(np.uint64), y.view(np.uint64)  # bits of negative numbers would be counted without their sign
    x_table = pivot_table(x)
    y_table = x_table if same else pivot_table(y)
    out_a, out_b = [], []
    for at in range(0, len(n), STRIPE):
        rows = slice(at, at + STRIPE)
        near = (root[rows, None] != other[None, :]) & (q * np.minimum(n[rows, None], m[None, :]) >= p * np.maximum(n[rows, None], m[None, :]))
        if same and every:
            near &= np.arange(len(n))[rows, None] < np.arange(len(m))[None, :]
        a, b = np.nonzero(near)
        a += at
        for mine, its in zip(x_table, y_table):
            near = np.abs(mine[a] - its[b]) * (q + p) <= (n[a] + m[b]) * (q - p)
            few = near.sum() > 0.9 * len(a)
            a, b = a[near], b[near]
            if few:  # large sets fill their sketches, and their distances to all pivots are alike: the distance itself decides
                break
        apart = np.zeros(len(a), np.int64)
        for w in range(WORDS):
            apart += np.bitwise_count(x[a, w] ^ y[b, w])
        left_open = apart * (q + p) <= (n[a] + m[b]) * (q - p)
        a, b, apart = a[left_open], b[left_open], apart[left_open]
        if x_fine and y_fine:
            left_open = _fine_apart(x_fine[0], y_fine[0], a, b) * (q + p) <= (n[a] + m[b]) * (q - p)
            a, b, apart = a[left_open], b[left_open], apart[left_open]
        if not every:
            order = np.lexsort((apart / (n[a] + m[b]), a))
            a, b = a[order], b[order]
            first = np.concatenate([[True], a[1:] != a[:-1]]) if len(a) else np.zeros(0, bool)
            a, b = a[first], b[first]
        out_a.append(a)
        out_b.append(b)
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *out_a]), np.concatenate([empty, *out_b])


def _if_few(df: DataFrame) -> DataFrame:
    """df, to be broadcast where it has few rows."""
    return F.broadcast(df) if df.count() <= FEW else df


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _fingerprint_pairs(sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets (node, fp) whose SimHash fingerprints are equal or link: each with the least of its fingerprint, and these with each other."""
    least = materialize(sets.groupBy("fp").agg(F.min("node").alias("low")), "least-of-fingerprints")
    equal = dealt_apart(sets, least, "fp", ["node"]).select(F.col("low").alias("a"), F.col("node").alias("b"))
    sides = [least.select(F.col("fp").alias(f"fp_{c}"), F.col("low").alias(c)) for c in "ab"]
    near = fingerprint_links(least.select("fp"), BITS).select(F.col("a").alias("fp_a"), F.col("b").alias("fp_b"))
    return equal.where("a <> b").unionByName(near.join(sides[0], "fp_a").join(sides[1], "fp_b").select("a", "b"))


def similar_documents(
    docs: DataFrame, words: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text", crowd: int = CROWD, sample: int = SAMPLE
) -> DataFrame:
    """doc_id and component_id (the least doc_id reachable) of documents whose distinct word shingles have that Jaccard similarity or more.

    Every pair links that reaches the similarity, and no other; 64-bit hashes stand for shingles and for whole sets. Equal sets are one candidate.
    Rows with a null id are left out; texts without a word are linked to each other.
    """
    share = Fraction(str(similarity))
    p, q = share.numerator, share.denominator
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null")
    common, counts = _common(rows, words, sample)

    def hashed(batches):
        vocabularies.forget()
        for whole in batches:
            for batch in split_batches(whole, "text"):
                shingles = [shingle_hashes(t, words) for t in batch.column("text").cast(pa.large_binary()).to_pylist()]
                sets = [np.unique(own) for own in shingles]
                bits = np.array([majority_bits(own) for own in shingles]).reshape(-1, 64)
                long = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array([_node(own) for own in sets], pa.int64()),
                        pa.array(np.packbits(bits, axis=1, bitorder="little").view("<i8").ravel()),
                        pa.array([len(own) for own in sets], pa.int32()),
                        pa.array([sketch(own) for own in sets], long),
                        pa.array([fine_sketch(own) for own in sets], long),
                        pa.array([prefix(own, common, counts, share).view(np.int64) for own in sets], long),
                    ],
                    ["doc_id", "node", "fp", "n", "sketch", "fine", "prefix"],
                )

    prints = materialize(rows.mapInArrow(hashed, _PRINT), "prints")
    named = prints.select("doc_id", "node")
    distinct = materialize(prints.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min("fp").alias("fp"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("fine").alias("fine")), "sets")
    small = distinct.select("node", "n", "sketch", "fine")

    # the keys of all prefixes, sorted, so that a task reads bucket after bucket and keeps those of several sets
    dealt = prints.select("node", "prefix").mapInArrow(keys_of_sets, "key bigint, node bigint")
    met = dealt.repartition("key").sortWithinPartitions("key", "node").mapInArrow(shared_keys, "bucket bigint, node bigint, low bigint, few boolean")
    met = materialize(met.distinct(), "members")
    members = met.where(~F.col("few")).select(F.col("bucket").alias("key"), "node")

    def of_texts(batches):
        vocabularies.forget()
        for whole in batches:
            for batch in split_batches(whole, "text"):
                sets = [np.unique(shingle_hashes(t, words)) for t in batch.column("text").cast(pa.large_binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array([_node(own) for own in sets], pa.int64()), pa.array([own.view(np.int64) for own in sets], pa.list_(pa.int64()))], ["node", "own"])

    def verified(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that link: sizes and sketches discard, the sets decide."""
        sides = [distinct.select(F.col("node").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in ("n", "sketch", "fine")]) for c in "ab"]
        pairs = materialize(pairs, "pairs")
        both = sides[0].join(_if_few(pairs), "a").join(sides[1], "b")
        apart = reduce(lambda x, y: x + y, [F.bit_count(F.col("sketch_a")[i].bitwiseXOR(F.col("sketch_b")[i])) for i in range(WORDS)])
        both = both.where(q * F.least("n_a", "n_b") >= p * F.greatest("n_a", "n_b")).where(apart * (q + p) <= (F.col("n_a") + F.col("n_b")) * (q - p))
        both = both.where(F.coalesce(_fine_distance(F.col("fine_a"), F.col("fine_b")), F.lit(0)) * (q + p) <= (F.col("n_a") + F.col("n_b")) * (q - p))
        left_open = materialize(both.select("a", "b", "n_a", "n_b"), "open-pairs")
        both = left_open
        nodes = both.select(F.col("a").alias("node")).unionByName(both.select(F.col("b").alias("node"))).distinct()
        ids = materialize(distinct.select("node", "doc_id").join(nodes, "node", "left_semi").select("doc_id").distinct(), "open-ids")
        sets = rows.join(_if_few(ids), "doc_id", "left_semi").select("text").mapInArrow(of_texts, "node bigint, own array<bigint>")
        sets = materialize(sets.dropDuplicates(["node"]), "open-sets")
        both = both.join(sets.select(F.col("node").alias("a"), F.col("own").alias("own_a")), "a").join(sets.select(F.col("node").alias("b"), F.col("own").alias("own_b")), "b")
        shared = F.size(F.array_intersect("own_a", "own_b"))
        found = materialize(both.where(shared * (q + p) >= p * (F.col("n_a") + F.col("n_b"))).select("a", "b"), "links")
        dropped(pairs, left_open, ids, sets)
        return found

    def look(every: bool):
        def compare(key, table):
            first, second = key[1].as_py(), key[2].as_py()
            side = table.column("block").combine_chunks().to_numpy()
            node, n, root = (table.column(c).combine_chunks().to_numpy() for c in ("node", "n", "root"))
            flat = table.column("sketch").combine_chunks().flatten().to_numpy().reshape(-1, WORDS)
            fine = table.column("fine").combine_chunks() if every else None
            blocks = [(np.flatnonzero(side == b)) for b in (first, second)]
            left, right = ((n[i].astype(np.int64), flat[i], root[i], *([fine.take(pa.array(i))] if every else [])) for i in blocks)
            a, b = open_pairs(left, right, share, first == second, every)
            a, b = blocks[0][a], blocks[1][b]
            if not every and first != second:
                c, d = open_pairs(right, left, share, False, False)
                a, b = np.concatenate([a, blocks[1][c]]), np.concatenate([b, blocks[0][d]])
            return pa.table({"a": pa.array(node[a]), "b": pa.array(node[b])})

        return compare

    stars = met.select(F.col("low").alias("a"), F.col("node").alias("b"))
    links = verified(_ordered(stars.unionByName(_fingerprint_pairs(distinct.select("node", "fp")))))
    rooted = materialize(components(links), "roots")
    rounds = 0
    while True:
        labelled = members.select("key", "node").join(rooted.withColumnRenamed("a", "node"), "node", "left").withColumn("root", F.coalesce("root", "node"))
        labelled = materialize(labelled, "labelled")
        mixed = labelled.groupBy("key").agg(F.count("*").alias("size"), F.min("root").alias("r"), F.max("root").alias("s")).where("r < s")
        mixed = mixed.select("key", F.ceil(F.col("size") / crowd).cast("int").alias("blocks"))
        parts = labelled.join(mixed, "key").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")).cast("int"))
        parts = parts.join(small, "node").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        every = rounds >= ROUNDS
        own = ["node", "n", "sketch", "root", "block", *(["fine"] if every else [])]
        parts = parts.select("key", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"), *own)
        found = verified(_ordered(parts.groupBy("key", "first", "second").applyInArrow(look(every), "a bigint, b bigint")))
        some = not found.isEmpty()
        if some:
            links = links.unionByName(found)
            rooted = materialize(components(links), "roots")
        if every:
            break
        rounds = rounds + 1 if some else ROUNDS
    # a set, or a component, that holds a large share of the documents is dealt to several tasks
    grouped = dealt_apart(named, rooted.select(F.col("a").alias("node"), "root"), "node", ["doc_id"]).select("doc_id", F.coalesce("root", "node").alias("root"))
    grouped = materialize(grouped, "rooted")
    names = grouped.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return dealt_apart(grouped, names, "root", ["doc_id"]).select("doc_id", "component_id")
