"""Suffix-array dedup of bytes: a sparse suffix array of content-chosen places, sorted deep-shallow.

A string of `window` bytes (400) is removed everywhere it occurs, if it occurs at two places or
more, or (keep_first) everywhere but at its first place. Sorting all suffixes of a corpus would
move many times its size. Instead every window names one place in it, where a hash of 32 bytes
is least (the leftmost such); equal windows name the same place, so only the suffixes at named
places, about one in 185 bytes, need an order.

1. Classes: the windows that name one place form a stretch of at most 2 window - 32 bytes. A
   stretch that occurs twice is removed as a whole (but for its first copy). Places with the
   same 32 bytes but different stretches are contested.
2. One copy of each contested stretch is dealt out by its 32 bytes. There the suffixes at the
   places, and the prefixes before them read backwards, are sorted deep-shallow, and the longest
   shared bytes to both sides tell which windows of a stretch repeat (suffix_sort).
   32 bytes with more than HOT different stretches would not fit one task: their windows are
   hashed (128 bits) and counted one by one instead, which any number of tasks share.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import lookups, suffix_sort
from .common import BASE_2, RollingHash, flat_text

WINDOW = 400
GRAM = 32
#: Different stretches around the same 32 bytes that one task sorts; beyond, windows are counted by hash.
HOT = 4096
#: Bytes hashed at once, and stretches sorted at once.
SLICE = 1 << 18
SORTED_AT_ONCE = 2048

RESULT_NAMES = ["doc_id", "n_bytes", "n_removed", "spans", "kept"]
SPANS = pa.list_(pa.struct([("first", pa.int64()), ("stop", pa.int64())]))

CLASSES, CONTESTED, STRETCHES, COUNTED = 1, 2, 3, 4

STRETCH = np.dtype([("gram", "<u8"), ("a", "<u8"), ("b", "<u8"), ("doc", "<i8"), ("row", "<i4"), ("at", "<i8"), ("left", "<u2"), ("right", "<u2"), ("asks", "u1")])
REPEATS = np.dtype([("a", "<u8"), ("b", "<u8"), ("least", "<u2"), ("most", "<u2")])


def sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of `width` keys, from block minima to both sides."""
    n = len(keys)
    blocks = -(-n // width)
    whole = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    whole[:n] = keys
    whole = whole.reshape(blocks, width)
    ahead = np.minimum.accumulate(whole[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(whole, axis=1).ravel()
    return np.minimum(ahead[: n - width + 1], behind[width - 1 : n])


class Places:
    """The named places of a batch: where they are, the first and last window start that names each, and their hashes."""

    def __init__(self, table: pa.Table, window: int):
        self.window = window
        self.raw, self.offsets = flat_text(table.column("text"))
        parts = [np.zeros((6, 0), np.uint64)]
        at, n = 0, len(self.offsets) - 1
        while at < n:
            stop = max(at + 1, int(np.searchsorted(self.offsets, self.offsets[at] + SLICE, "right")) - 1)
            parts.append(self._named(at, stop))
            at = stop
        place, low, high, self.gram, self.a, self.b = np.concatenate(parts, axis=1)
        self.place, self.low, self.high = place.astype(np.int64), low.astype(np.int64), high.astype(np.int64)
        ids = table.column("doc_id").combine_chunks()
        self.doc, self.row = pc.fill_null(ids, lookups.NO_ID).to_numpy(), np.zeros(len(ids), np.int64)
        if len(np.unique(self.doc)) < len(self.doc):  # rows of an equal id come in the order of their texts
            self.row[pc.sort_indices(table.select(["doc_id", "text"]), [("doc_id", "ascending"), ("text", "ascending")]).to_numpy()] = np.arange(len(ids))

    def order_of(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """doc, row and place in the document of places in the bytes of the batch."""
        which = np.searchsorted(self.offsets, at, "right") - 1
        return self.doc[which], self.row[which], at - self.offsets[which]

    def _named(self, at: int, stop: int) -> np.ndarray:
        base = self.offsets[at]
        raw = self.raw[base : self.offsets[stop]]
        if len(raw) < self.window:
            return np.zeros((6, 0), np.uint64)
        symbols = raw.astype(np.uint64) + np.uint64(1)
        rolling = RollingHash(symbols)
        first = np.arange(len(raw) - GRAM + 1)
        gram = rolling.of(first, first + GRAM)
        least = sliding_least((gram >> np.uint64(32) << np.uint64(32)) | first.astype(np.uint64), self.window - GRAM + 1)
        named = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        # windows that lie in one document
        offsets = self.offsets[at : stop + 1] - base
        doc_end = np.repeat(offsets[1:], np.diff(offsets))[: len(named)]
        start = np.flatnonzero(np.arange(len(named)) + self.window <= doc_end)
        named, end = named[start], doc_end[start]
        new = np.ones(len(start), bool)
        new[1:] = (np.diff(named) != 0) | (np.diff(end) != 0)
        cuts = np.flatnonzero(new)
        low, high, place = start[cuts], start[np.append(cuts[1:], len(start)) - 1], named[cuts]
        out = np.empty((6, len(cuts)), np.uint64)
        out[0], out[1], out[2] = place + base, low + base, high + base
        out[3], out[4], out[5] = gram[place], rolling.of(low, high + self.window), RollingHash(symbols, BASE_2).of(low, high + self.window)
        return out


def _ask_classes(buckets: int, window: int):
    def run(batch, table, _):
        places = Places(table, window)
        doc, row, at = places.order_of(places.place)
        yield from lookups.requests_of(batch, CLASSES, lookups.first_records(places.a, places.b, doc, batch, row, at), buckets)
        yield from lookups.requests_of(batch, CONTESTED, lookups.keyed_records(places.gram, places.a), buckets)

    return run


def _roles(places: Places, batch: int, got: dict, hot_above: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each place: whether its stretch repeats, whether it is the first of those, whether it is to be compared, and whether its 32 bytes are hot."""
    n = len(places.place)
    twice = lookups.gather(got.get(CLASSES, []), lookups.FIRST)
    hit = lookups.find(places.a, places.b, twice["a"], twice["b"])
    repeats = hit >= 0
    leads = _is_first(places, batch, places.place, twice, hit)
    contested = lookups.gather(got.get(CONTESTED, []), lookups.KEYED)
    contested = contested[np.argsort(contested["a"], kind="stable")]
    compared, hot = np.zeros(n, bool), np.zeros(n, bool)
    if len(contested):
        at = np.minimum(np.searchsorted(contested["a"], places.gram), len(contested) - 1)
        mine = contested["a"][at] == places.gram
        compared = mine & (~repeats | leads)  # one copy of each stretch
        hot = mine & (contested["n"][at] > hot_above)
    return repeats, leads, compared, hot


def _is_first(places: Places, batch: int, at: np.ndarray, firsts: np.ndarray, hit: np.ndarray) -> np.ndarray:
    """Whether these places are the first ones told; hit: the place of each in firsts, or -1."""
    out = hit >= 0
    first = firsts[hit[out]]
    doc, row, place = (x[out] for x in places.order_of(at))
    out[out] = (first["doc"] == doc) & (first["batch"] == batch) & (first["row"] == row) & (first["at"] == place)
    return out


def _windows_of(places: Places, which: np.ndarray) -> np.ndarray:
    """All window starts that name these places."""
    sizes = places.high[which] - places.low[which] + 1
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(places.low[which] - (ends - sizes), sizes)


def _window_hashes(places: Places, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each window, hashed document slice by document slice."""
    a, b = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.uint64)
    at, n = 0, len(places.offsets) - 1
    while at < n:
        stop = max(at + 1, int(np.searchsorted(places.offsets, places.offsets[at] + SLICE, "right")) - 1)
        base = places.offsets[at]
        low, high = np.searchsorted(starts, [base, places.offsets[stop]])
        if high > low:
            symbols = places.raw[base : places.offsets[stop]].astype(np.uint64) + np.uint64(1)
            own = starts[low:high] - base
            a[low:high], b[low:high] = RollingHash(symbols).of(own, own + places.window), RollingHash(symbols, BASE_2).of(own, own + places.window)
        at = stop
    return a, b


def _ask_repeats(buckets: int, window: int, keep_first: bool, hot_above: int):
    def run(batch, table, got):
        if not got:
            return
        places = Places(table, window)
        repeats, _, compared, hot = _roles(places, batch, got, hot_above)
        which = np.flatnonzero(compared & ~hot)
        records = np.zeros(len(which), STRETCH)
        records["gram"], records["a"], records["b"] = places.gram[which], places.a[which], places.b[which]
        records["doc"], records["row"], records["at"] = places.order_of(places.place[which])
        records["left"] = places.place[which] - places.low[which]
        records["right"] = places.high[which] + window - places.place[which]
        records["asks"] = True if keep_first else ~repeats[which]
        bucket = ((records["gram"] >> np.uint64(20)) % np.uint64(buckets)).astype(np.int32)
        raw = places.raw.tobytes()
        for own in np.unique(bucket).tolist():
            mine = np.flatnonzero(bucket == own)
            stretches = b"".join([raw[x:y] for x, y in zip(places.low[which[mine]].tolist(), (places.high[which[mine]] + window).tolist())])
            data = struct.pack("<q", len(mine)) + records[mine].tobytes() + stretches
            yield pa.RecordBatch.from_arrays([pa.array([batch], pa.int32()), pa.array([STRETCHES], pa.int32()), pa.array([own], pa.int32()), pa.array([data], pa.binary())], schema=lookups.REQUESTS_ARROW)
        starts = _windows_of(places, np.flatnonzero(compared & hot))
        doc, row, at = places.order_of(starts)
        yield from lookups.requests_of(batch, COUNTED, lookups.first_records(*_window_hashes(places, starts), doc, batch, row, at), buckets)

    return run


def _answer_stretches(window: int, keep_first: bool):
    def answer(kind: int, who: list[int], data: list[bytes]):
        records, texts, asker = [], [], []
        for batch, blob in zip(who, data):
            (n,) = struct.unpack_from("<q", blob)
            records.append(np.frombuffer(blob, STRETCH, n, 8))
            texts.append(np.frombuffer(blob, np.uint8, offset=8 + n * STRETCH.itemsize))
            asker.append(np.full(n, batch, np.int32))
        if not records:
            return
        records, raw, asker = np.concatenate(records), np.concatenate(texts), np.concatenate(asker)
        left, right = records["left"].astype(np.int64), records["right"].astype(np.int64)
        place = np.cumsum(left + right) - right
        nth = np.empty(len(records), np.int64)
        nth[np.lexsort((records["at"], records["row"], asker, records["doc"]))] = np.arange(len(records))
        order, starts = lookups.groups(records["gram"])
        ends = np.append(starts[1:], len(order))
        least, most = np.full(len(records), window), np.full(len(records), -1)
        at = 0
        while at < len(starts):  # whole groups, about SORTED_AT_ONCE stretches at a time
            stop = max(at + 1, int(np.searchsorted(ends, starts[at] + SORTED_AT_ONCE, "right")))
            own = order[starts[at] : ends[stop - 1]]
            rows = suffix_sort.padded(raw, place[own], right[own], window)
            back = suffix_sort.padded(raw, place[own], left[own], window - GRAM, backwards=True)
            least[own], most[own] = suffix_sort.repeated_offsets(rows, right[own], back, left[own], records["gram"][own], window, nth[own] if keep_first else None)
            at = stop
        hit = (most >= 0) & (records["asks"] > 0)
        out = np.zeros(int(hit.sum()), REPEATS)
        out["a"], out["b"], out["least"], out["most"] = records["a"][hit], records["b"][hit], least[hit], most[hit]
        yield from lookups.replies_of(kind, asker[hit], out)

    return answer


def _cut_with(window: int, keep_first: bool, hot_above: int, as_text: bool):
    return lambda batch, table, got: _cut(batch, table, got, window, keep_first, hot_above, as_text)


def _removed(places: Places, batch: int, got: dict, keep_first: bool, hot_above: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the removed runs of bytes begin and end; they may overlap."""
    window = places.window
    repeats, leads, _, hot = _roles(places, batch, got, hot_above)
    whole = repeats & ~leads if keep_first else repeats
    found = lookups.gather(got.get(STRETCHES, []), REPEATS)
    hit = lookups.find(places.a, places.b, found["a"], found["b"])
    own = (hit >= 0) & ~whole
    begins = [places.low[whole], places.place[own] - found["most"][hit[own]]]
    ends = [places.high[whole] + window, places.place[own] - found["least"][hit[own]] + window]
    starts = _windows_of(places, np.flatnonzero(hot & ~whole))
    if len(starts):
        found = lookups.gather(got.get(COUNTED, []), lookups.FIRST)
        hit = lookups.find(*_window_hashes(places, starts), found["a"], found["b"])
        gone = hit >= 0
        if keep_first:
            gone &= ~_is_first(places, batch, starts, found, hit)
        begins.append(starts[gone])
        ends.append(starts[gone] + window)
    return np.concatenate(begins).astype(np.int64), np.concatenate(ends).astype(np.int64)


def _united(begins: np.ndarray, ends: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal runs that these runs of bytes cover; each lies in one document, and a run ends with its document."""
    order = np.argsort(begins, kind="stable")
    begins, reach = begins[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(begins), bool)
    opens = offsets[np.minimum(np.searchsorted(offsets, begins[1:]), len(offsets) - 1)] == begins[1:]
    new[1:] = (begins[1:] > reach[:-1]) | ((begins[1:] == reach[:-1]) & opens)
    starts = np.flatnonzero(new)
    return begins[starts], reach[np.append(starts[1:], len(begins)) - 1] if len(starts) else reach


def _whole_characters(first: np.ndarray, stop: np.ndarray, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs without the characters that they hold a part of; empty runs go."""
    first, stop = first.copy(), stop.copy()
    document_end = offsets[np.searchsorted(offsets, first, "right")]
    document = offsets[np.searchsorted(offsets, first, "right") - 1]
    torn = np.flatnonzero(first > document)
    while len(torn := torn[first[torn] < stop[torn]]) and len(torn := torn[(raw[first[torn]] & 0xC0) == 0x80]):
        first[torn] += 1
    torn = np.flatnonzero(stop < document_end)
    while len(torn := torn[first[torn] < stop[torn]]) and len(torn := torn[(raw[stop[torn]] & 0xC0) == 0x80]):
        stop[torn] -= 1
    whole = first < stop
    return first[whole], stop[whole]


def _cut(batch: int, table: pa.Table, got: dict, window: int, keep_first: bool, hot_above: int, as_text: bool):
    places = Places(table, window)
    begins, ends = _removed(places, batch, got, keep_first, hot_above) if got else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    first, stop = _united(begins, ends, places.offsets)
    if as_text:
        first, stop = _whole_characters(first, stop, places.raw, places.offsets)
    cuts = np.searchsorted(first, places.offsets)
    spans, kept, removed = [], [], []
    raw, offsets = places.raw.tobytes(), places.offsets.tolist()
    for doc in range(len(offsets) - 1):
        a, b = offsets[doc], offsets[doc + 1]
        pairs = list(zip(first[cuts[doc] : cuts[doc + 1]].tolist(), stop[cuts[doc] : cuts[doc + 1]].tolist()))
        spans.append([{"first": x - a, "stop": y - a} for x, y in pairs])
        removed.append(sum(y - x for x, y in pairs))
        if pairs:
            edges_of = [a, *(edge for pair in pairs for edge in pair), b]
            kept.append(b"".join([raw[x:y] for x, y in zip(edges_of[::2], edges_of[1::2])]))
        else:
            kept.append(raw[a:b])
    own = pa.array([x.decode("utf-8", "replace") for x in kept], pa.string()) if as_text else pa.array(kept, pa.binary())
    columns = [table.column("doc_id").combine_chunks(), pa.array(np.diff(places.offsets), pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, SPANS), own]
    along = [name for name in table.column_names if name.startswith("carry_")]
    yield pa.RecordBatch.from_arrays([*columns, *[table.column(name).combine_chunks() for name in along]], [*RESULT_NAMES, *along])


def suffix_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: list[str] | None = None,
    as_text: bool = False,
    hot_above: int = HOT,
    window: int = WINDOW,
    keep_first: bool = False,
) -> DataFrame:
    """Remove every byte covered by a string of `window` bytes (64 to 32,000) that also starts anywhere else.

    With keep_first: only where it also starts at an earlier place, so that its first occurrence stays. Places are
    ordered by id (null: last), rows of one id by batch and text, then by the place in the row.
    Texts are UTF-8 bytes (null: empty) and matches stay inside a document; both places of a match may lie
    in one document and may overlap. Strings are judged on the input. Per row: doc_id, n_bytes, n_removed,
    spans (maximal removed runs of bytes, from first up to stop) and kept (the other bytes, which may begin
    or end inside a character; as_text: a string, where a character goes only with all of its bytes), then the columns named in
    carry under their own names. Without keep_first every copy goes, so repeated rows of a window or more lose
    all their text. Other columns are not read.
    """
    carry = carry or []
    rows, buckets = lookups.in_batches(docs, id_col, text_col, carry)
    first = lookups.per_batch(rows, _ask_classes(buckets, window), lookups.REQUESTS)
    classes = lookups.answer(first, buckets, {CLASSES: lookups.answer_first, CONTESTED: lookups.answer_contested})
    second = lookups.with_replies(rows, classes, _ask_repeats(buckets, window, keep_first, hot_above), lookups.REQUESTS)
    repeats = lookups.answer(second, buckets, {STRETCHES: _answer_stretches(window, keep_first), COUNTED: lookups.answer_first})
    kept = "string" if as_text else "binary"
    result = rows.selectExpr("doc_id", "0L as n_bytes", "0L as n_removed", "cast(null as array<struct<first:bigint,stop:bigint>>) as spans", f"cast(null as {kept}) as kept").schema
    for field in rows.schema:
        if field.name.startswith("carry_"):
            result = result.add(field)
    cut = lookups.with_replies(rows, classes.unionByName(repeats), _cut_with(window, keep_first, hot_above, as_text), T.StructType([T.StructField(f.name, f.dataType, True) for f in result]))
    return cut.toDF(*RESULT_NAMES, *carry)
