"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

Rows of one label (and vector length) are laid along a Hilbert curve through all dimensions and cut
into blocks, written as Parquet: one row a block, with the rows' components as bytes and, in columns of
their own, the least and greatest value of each dimension. For an anchor, interval arithmetic over such a box bounds the
inner products that its rows can have. Only blocks whose bounds meet a window of scores are read for
it; planning reads the zone maps alone.

A search has two passes. The first reads for each window the block whose centre lies nearest to its
upper end, and raises the window's lower end to the k-th best score found. The second reads all blocks
that the raised windows still meet, and is exact: a block that it leaves out holds no better row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, shuffle_partitions
from .vectors import matrix

#: Rows of a block, blocks that a task reads one after the other, zone maps planned at once, and anchors that meet these at once.
BLOCK = 512
GATHERED = 16
ZONES = 1024
ANCHORS = 1024
#: Bits of each dimension that a place on the curve keeps.
CURVE_BITS = 4
LOWEST, HIGHEST = -(1 << 62), 1 << 62


# The curve. --------------------------------------------------------------------------------------


def hilbert_places(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places along the Hilbert curve of rows of non-negative cells below 2^bits, as big-endian bytes (rows of uint8).

    By Skilling's transform of the axes ("Programming the Hilbert curve", 2004): exchanges and inversions from the highest
    bit down, then a Gray code; the transposed bits, dimension by dimension within each level, are the place.
    """
    x = cells.astype(np.int64).T.copy()
    level = 1 << (bits - 1)
    while level > 1:
        low = level - 1
        for axis in range(len(x)):
            inverted = (x[axis] & level) != 0
            swapped = np.where(inverted, 0, (x[0] ^ x[axis]) & low)
            x[0] = np.where(inverted, x[0] ^ low, x[0] ^ swapped)
            x[axis] ^= swapped
        level >>= 1
    x = np.bitwise_xor.accumulate(x, axis=0)
    flips = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, 0, -1):
        flips ^= np.where((x[-1] >> bit) & 1, (1 << bit) - 1, 0)
    x ^= flips
    levels = np.stack([(x >> bit) & 1 for bit in range(bits - 1, -1, -1)])  # level, dimension, row
    return np.packbits(levels.transpose(2, 0, 1).reshape(x.shape[1], -1).astype(np.uint8), axis=1)


def _with_places(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places: list[bytes | None] = [None] * batch.num_rows
            widths = np.asarray(batch.column("width"))
            for width in np.unique(widths).tolist():
                at = np.flatnonzero(widths == width)
                own = batch.take(pa.array(at))
                v, low, high = (matrix(own.column(c), np.float64) for c in ("v", "least", "most"))
                cells = np.floor((v - low) / (high - low + 1) * (1 << bits)).astype(np.int64).clip(0, (1 << bits) - 1)
                for i, place in zip(at.tolist(), hilbert_places(cells, bits)):
                    places[i] = place.tobytes()
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("vec_id", "v", "label", "width")), pa.array(places, pa.binary())], ["vec_id", "v", "label", "width", "place"])

    return run


BLOCKS = "block bigint, label bigint, width int, n int, ids binary, components binary, least array<bigint>, most array<bigint>"
BLOCK_SCHEMA = pa.schema([("block", pa.int64()), ("label", pa.int64()), ("width", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()), ("components", pa.binary()), ("least", pa.list_(pa.int64())), ("most", pa.list_(pa.int64()))])


def _cut_into_blocks(most: int):
    """Sorted rows of one task as blocks of up to `most` rows of one label and width."""

    def block(nth: int, label: int, width: int, ids: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        name = (TaskContext.get().partitionId() << 32) + nth
        values = [[name], [label], [width], [len(ids)], [ids.tobytes()], [v.tobytes()], [v.min(0)], [v.max(0)]]
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(values, BLOCK_SCHEMA)], schema=BLOCK_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nth, now, ids, rows = 0, None, [], []
        for batch in batches:
            labels, widths, own = (np.asarray(batch.column(c)) for c in ("label", "width", "vec_id"))
            edges = np.flatnonzero((np.diff(labels) != 0) | (np.diff(widths) != 0)) + 1
            for at, stop in zip([0, *edges.tolist()], [*edges.tolist(), len(labels)]):
                if at == stop:
                    continue
                key = int(labels[at]), int(widths[at])
                if now is not None and now != key and ids:
                    yield block(nth, *now, np.concatenate(ids), np.concatenate(rows))
                    nth, ids, rows = nth + 1, [], []
                now = key
                v = matrix(batch.column("v").slice(at, stop - at), np.int64)
                while at < stop:
                    n = min(stop - at, most - sum(map(len, ids)))
                    ids.append(own[at : at + n])
                    rows.append(v[len(v) - (stop - at) :][:n])
                    at += n
                    if sum(map(len, ids)) == most:
                        yield block(nth, *now, np.concatenate(ids), np.concatenate(rows))
                        nth, ids, rows = nth + 1, [], []
        if ids:
            yield block(nth, *now, np.concatenate(ids), np.concatenate(rows))

    return run


def write_blocks(rows: DataFrame) -> DataFrame:
    """Rows (vec_id, v, label, width) as a stored table of blocks along the curve, of one label and width each.

    Rows go to tasks by ranges of (label, width, place, id), so a label that holds a large share of them is many tasks.
    """
    spans = rows.select("width", F.posexplode("v").alias("dimension", "x")).groupBy("width", "dimension").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    spans = spans.groupBy("width").agg(F.array_sort(F.collect_list(F.struct("dimension", "low", "high"))).alias("s")).select("width", F.col("s.low").alias("least"), F.col("s.high").alias("most"))
    # one row per vector length; rows of a length are not moved where that is broadcast, and there are as many rows as lengths
    placed = rows.join(F.broadcast(spans), "width").mapInArrow(_with_places(CURVE_BITS), "vec_id bigint, v array<bigint>, label bigint, width int, place binary")
    placed = materialize(placed, "curve")
    order = ["label", "width", "place", "vec_id"]
    dealt = placed.repartitionByRange(shuffle_partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    return materialize(dealt.mapInArrow(_cut_into_blocks(BLOCK), BLOCKS), "blocks")


# Bounds and reading. --------------------------------------------------------------------------------


def exact_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer products a b^T without rounding: in doubles below 2^53, else in 64-bit integers; beyond that they are an error."""
    limit = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if limit < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if limit >= 1 << 62:
        raise OverflowError("inner products beyond 62 bits")
    return a @ b.T


def bounds(anchors: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and greatest inner product of each anchor with anything in each box."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return exact_product(up, least) + exact_product(down, most), exact_product(up, most) + exact_product(down, least)


def _windows(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper ends of the anchors' windows, as matrices; short rows are filled with empty windows."""
    low, high = table.column("low").combine_chunks(), table.column("high").combine_chunks()
    sizes = np.diff(low.offsets.to_numpy())
    at = np.arange(max(1, sizes.max(initial=0)))[None, :] < sizes[:, None]
    lows, highs = np.full(at.shape, HIGHEST), np.full(at.shape, LOWEST)
    lows[at], highs[at] = low.flatten().to_numpy(), high.flatten().to_numpy()
    return lows, highs


def _meeting(anchors: pa.Table, zones: pa.Table, same_label: bool) -> tuple[np.ndarray, ...]:
    """Ends of windows, bounds, and which blocks each anchor's windows meet: by anchor, window and block."""
    lows, highs = _windows(anchors)
    lower, upper = bounds(matrix(anchors.column("v"), np.int64), matrix(zones.column("least"), np.int64), matrix(zones.column("most"), np.int64))
    labels, others = anchors.column("label").to_numpy(), zones.column("label").to_numpy()
    allowed = (labels[:, None] == others[None, :]) == same_label
    meets = allowed[:, None, :] & (upper[:, None, :] >= lows[:, :, None]) & (lower[:, None, :] <= highs[:, :, None])
    return lows, highs, lower, upper, meets


CHOSEN = "uid bigint, block bigint, nth int, away double"
CHOSEN_SCHEMA = pa.schema([("uid", pa.int64()), ("block", pa.int64()), ("nth", pa.int32()), ("away", pa.float64())])


def _chooser(same_label: bool, first: bool):
    """From anchors and zone maps: the blocks to read. First pass: one per window and group of zone maps, with how far its centre is."""

    def choose(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return CHOSEN_SCHEMA.empty_table()
        lows, highs, lower, upper, meets = _meeting(left, right, same_label)
        uids, blocks = left.column("uid").to_numpy(), right.column("block").to_numpy()
        if not first:
            a, b = np.nonzero(meets.any(1))
            return pa.table([uids[a], blocks[b], np.zeros(len(a), np.int32), np.zeros(len(a))], schema=CHOSEN_SCHEMA)
        centre = (lower / 2 + upper / 2)[:, None, :]
        away = np.where(meets, np.where(highs[:, :, None] == HIGHEST, -centre, np.abs(highs[:, :, None] - centre)), np.inf)
        best = away.argmin(2)
        a, w = np.nonzero(meets.any(2))
        return pa.table([uids[a], blocks[best[a, w]], w.astype(np.int32), away[a, w, best[a, w]]], schema=CHOSEN_SCHEMA)

    return choose


FOUND = "uid bigint, nth int, vec_id bigint, score bigint"
FOUND_SCHEMA = pa.schema([("uid", pa.int64()), ("nth", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _reader(k: int):
    """From some blocks and the anchors that read them: the k best rows of each window, ties to smaller ids."""

    def best(uid: np.ndarray, nth: np.ndarray, ids: np.ndarray, score: np.ndarray) -> list[np.ndarray]:
        order = np.lexsort((ids, -score, nth, uid))
        uid, nth, ids, score = uid[order], nth[order], ids[order], score[order]
        fresh = np.ones(len(uid), bool)
        fresh[1:] = (uid[1:] != uid[:-1]) | (nth[1:] != nth[:-1])
        starts = np.flatnonzero(fresh)
        rank = np.arange(len(uid)) - np.repeat(starts, np.diff(np.append(starts, len(uid))))
        return [x[rank < k] for x in (uid, nth, ids, score)]

    def read(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [np.zeros(0, np.int64)] * 4
        wanted = right.column("block").to_numpy()
        for block, name, components in zip(*(left.column(c) for c in ("b", "ids", "components"))):
            asking = right.take(pa.array(np.flatnonzero(wanted == block.as_py())))
            ids = np.frombuffer(name.as_py(), np.int64)
            rows = np.frombuffer(components.as_py(), np.int64).reshape(len(ids), -1)
            own, uids = asking.column("vec_id").to_numpy(), asking.column("uid").to_numpy()
            score = exact_product(matrix(asking.column("v"), np.int64), rows)
            lows, highs = _windows(asking)
            other = ids[None, :] != own[:, None]
            for w in range(lows.shape[1]):
                a, b = np.nonzero(other & (score >= lows[:, w : w + 1]) & (score <= highs[:, w : w + 1]))
                few = best(uids[a], np.full(len(a), w), ids[b], score[a, b])
                out = [np.concatenate([x, y]) for x, y in zip(out, few)]
        uid, nth, ids, score = best(*out)
        return pa.table([uid, nth.astype(np.int32), ids, score], schema=FOUND_SCHEMA)

    return read


def _best(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("uid", "nth").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k)


def search(anchors: DataFrame, blocks: DataFrame, k: int, same_label: bool, read: list | None = None) -> DataFrame:
    """The k best rows of each window: uid, nth (the window's place), rank, vec_id, score; ties go to smaller ids.

    anchors: uid, vec_id, v, label, width, low and high (ends of the windows, both inside). Rows with an anchor's own id are
    left out; with same_label only rows of its label are searched, else only those of other labels.
    read: gets the number of (anchor, block) pairs that the second pass reads, and of all of that kind.
    """
    counts = blocks.agg(F.count("*")).first()[0], anchors.count()
    zone_groups, anchor_groups = max(1, -(-counts[0] // ZONES)), max(1, -(-counts[1] // ANCHORS))
    dealt = lambda key, n: F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    zones = blocks.select("block", "label", F.col("width").alias("its_width"), "least", "most", dealt("block", zone_groups).alias("its_z"))
    zones = zones.withColumn("its_g", F.explode(F.sequence(F.lit(0), F.lit(anchor_groups - 1))))

    def chosen(windows: DataFrame, first: bool) -> DataFrame:
        asked = windows.withColumn("g", dealt("uid", anchor_groups)).withColumn("z", F.explode(F.sequence(F.lit(0), F.lit(zone_groups - 1))))
        return asked.groupBy("width", "z", "g").cogroup(zones.groupBy("its_width", "its_z", "its_g")).applyInArrow(_chooser(same_label, first), CHOSEN)

    def rows_of(windows: DataFrame, pairs: DataFrame) -> DataFrame:
        together = max(1, -(-counts[0] // GATHERED))
        needs = pairs.join(windows, "uid").withColumns({"g": dealt("uid", anchor_groups), "some": dealt("block", together)})
        held = pairs.select(F.col("block").alias("b"), dealt("uid", anchor_groups).alias("h"), dealt("block", together).alias("those")).distinct()
        held = held.join(blocks.select(F.col("block").alias("b"), "ids", "components"), "b")
        return held.groupBy("those", "h").cogroup(needs.groupBy("some", "g")).applyInArrow(_reader(k), FOUND)

    nearest = chosen(anchors, True).groupBy("uid", "nth").agg(F.min_by("block", F.struct("away", "block")).alias("block"))
    near = materialize(nearest.select("uid", "block").distinct(), "first-blocks")
    reached = _best(rows_of(anchors, near), k).where(F.col("rank") == k).groupBy("uid").agg(F.map_from_entries(F.collect_list(F.struct("nth", "score"))).alias("reached"))
    raised = F.transform("low", lambda x, i: F.greatest(x, F.coalesce(F.try_element_at("reached", i), x)))
    windows = materialize(anchors.join(reached, "uid", "left").withColumn("low", raised).drop("reached"), "windows")
    pairs = materialize(chosen(windows, False).select("uid", "block"), "blocks-to-read")
    if read is not None:
        whole = anchors.groupBy("label", "width").count().join(blocks.groupBy(F.col("label").alias("its"), "width").agg(F.count("*").alias("n")), "width")
        kind = F.col("label") == F.col("its") if same_label else F.col("label") != F.col("its")
        read.append((pairs.count(), whole.where(kind).agg(F.coalesce(F.sum(F.col("count") * F.col("n")), F.lit(0))).first()[0]))
    return _best(rows_of(windows, pairs), k)


def hard_negatives(
    table: DataFrame,
    every: int = 100,
    positives: int = 5,
    negatives: int = 10,
    lowest: int = 30,
    highest: int = 90,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    read: list | None = None,
) -> DataFrame:
    """Hard negatives of every vector whose id is divisible by `every`: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components become floor(scale * x); a score is the integer inner product with the anchor. An anchor's positives are
    its best other rows of its label, ties to smaller ids. For each of them, its negatives are the best rows of
    other labels with lowest * positive_score <= 100 * negative_score <= highest * positive_score; rank counts these.

    Rows with a null id or label, a null or empty vector, or a null or non-finite component take no part; zero vectors do. Rows
    that are equal in id, vector and label count once; rows of one id that differ are anchors and candidates each, and no
    row of an anchor's own id is its positive or negative. Vectors of different lengths have no inner product: each meets those of its length.
    Products beyond 62 bits are an error. Other columns are not read. read: see search().
    """
    own = lambda name: F.col(f"`{name}`")
    rows = table.select(own(id_col).cast("long").alias("vec_id"), own(vector_col).cast("array<double>").alias("x"), own(label_col).cast("long").alias("label"))
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where("vec_id is not null and label is not null and size(x) > 0").where(finite)
    rows = rows.select("vec_id", F.transform("x", lambda x: F.floor(x * scale)).alias("v"), "label", F.size("x").alias("width")).distinct()
    rows = materialize(rows, "integers")
    blocks = write_blocks(rows)
    uid = F.xxhash64("vec_id", "v", "label")
    anchors = rows.where(F.col("vec_id") % every == 0).withColumn("uid", uid)
    ends = lambda low, high: {"low": F.array(F.lit(low).cast("long")), "high": F.array(F.lit(high).cast("long"))}
    best = search(anchors.withColumns(ends(LOWEST, HIGHEST)), blocks, positives, True, read)
    best = materialize(best.select("uid", "rank", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # 100 * negative >= lowest * positive: the least whole number; windows of negative scores are empty and are left out
    low, high = _whole(lowest, up=True), _whole(highest, up=False)
    kept = best.select("uid", "rank", low.alias("low"), high.alias("high")).where("low <= high")
    ordered = kept.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("rank", "low", "high"))).alias("w"))
    windows = anchors.join(ordered.select("uid", F.col("w.low").alias("low"), F.col("w.high").alias("high"), F.col("w.rank").alias("ranks")), "uid")
    windows = materialize(windows, "score-windows")
    found = search(windows.drop("ranks"), blocks, negatives, False, read)
    found = found.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"})
    named = windows.select("uid", F.col("vec_id").alias("anchor_id"), F.posexplode("ranks").alias("nth", "which")).join(best.withColumnRenamed("rank", "which"), ["uid", "which"])
    return found.join(named, ["uid", "nth"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _whole(percent: int, up: bool) -> Column:
    """percent / 100 of positive_score as a whole number, rounded up or down."""
    share = F.col("positive_score") * percent
    remainder = F.pmod(share, F.lit(100).cast("long"))
    down = F.call_function("div", share - remainder, F.lit(100).cast("long"))
    return down + (remainder > 0).cast("long") if up else down
