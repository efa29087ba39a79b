"""Substring dedup of words by difference-cover anchors.

A window of 50 words is removed where the same words also start in a document of smaller id.
The cover {1, 5, 11, 24, 25, 27} modulo 31 has every difference modulo 31 among its members.
So of two equal windows, wherever they start, some offset below 31 puts both on cover places:
hashing the 20 words at cover places only (6 of 31) finds an anchor in every repeated window.

1. Anchors: which 20-word hashes does more than one document hold?
2. Extension: a shared anchor is hashed with up to 30 words to either side. Where a smaller
   document has the same context, all windows over the anchor are removed at once. An anchor
   whose occurrences have different contexts is contested.
3. Windows over contested anchors that are still there are hashed one by one (128 bits), and
   those that a smaller document holds are removed. The smallest holder of a window never
   loses it in step 2, so it takes part here, and the result is exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import lookups
from .common import BASE, BASE_2, RollingHash, flat_text

WINDOW = 50
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)
ANCHOR = WINDOW - PERIOD + 1
#: Bytes hashed at once, so that the arrays stay in the processor's cache.
SLICE = 1 << 19

RESULT = "doc_id bigint, n_words bigint, n_removed bigint, spans array<struct<first:bigint,stop:bigint>>, kept string"
RESULT_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.struct([("first", pa.int64()), ("stop", pa.int64())]))), ("kept", pa.string())]
)

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_ON_COVER = np.zeros(PERIOD, bool)
_ON_COVER[list(COVER)] = True

SHARED_ANCHORS, CONTEXTS, CONTESTED, WINDOWS = 1, 2, 3, 4


class Words:
    """The words of a batch end to end: their bytes, hashes, and the documents that they belong to."""

    def __init__(self, table: pa.Table):
        self.ids = table.column("doc_id").combine_chunks().fill_null(lookups.NO_ID).to_numpy(zero_copy_only=False)
        self.raw, self.offsets = flat_text(table.column("text"))
        starts, hashes = [], []
        at, n = 0, len(self.ids)
        counts = np.zeros(n, np.int64)
        while at < n:
            stop = max(at + 1, int(np.searchsorted(self.offsets, self.offsets[at] + SLICE, "right")) - 1)
            own = self._hash(at, stop)
            counts[at:stop] = own[0]
            starts.append(own[1])
            hashes.append(own[2])
            at = stop
        self.hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        self.doc = np.repeat(np.arange(n), counts)

    def _hash(self, at: int, stop: int):
        base = self.offsets[at]
        raw = self.raw[base : self.offsets[stop]]
        letter = np.zeros(len(raw) + 2, np.int8)
        letter[1:-1] = ~_SPACE[raw]
        # a word also ends where its document does
        edges = np.diff(letter)
        begins = edges[:-1] == 1
        ends = edges[1:] == -1
        inner = self.offsets[at + 1 : stop] - base
        inner = inner[(inner > 0) & (inner < len(raw))]
        joined = inner[(letter[inner] == 1) & (letter[inner + 1] == 1)]
        begins[joined] = True
        ends[joined - 1] = True
        begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        rolling = RollingHash(raw.astype(np.uint64) + np.uint64(1))
        counts = np.diff(np.searchsorted(begin, self.offsets[at : stop + 1] - base))
        return counts, begin, rolling.of(begin, end)

    def anchors(self) -> np.ndarray:
        """Cover places whose whole anchor lies in their document, if that holds a window at all."""
        place = np.arange(len(self.hashes)) - self.first[self.doc]
        at = np.flatnonzero(_ON_COVER[place % PERIOD])
        stop = self.first[self.doc[at] + 1]
        return at[(at + ANCHOR <= stop) & (stop - self.first[self.doc[at]] >= WINDOW)]

    def starts_over(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last start of the windows over each anchor; none where last < first."""
        doc = self.doc[at]
        return np.maximum(at - (PERIOD - 1), self.first[doc]), np.minimum(at, self.first[doc + 1] - WINDOW)


def _mark(n: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which of n places lie in any low ... high-1."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, low, 1)
    np.add.at(steps, high, -1)
    return np.cumsum(steps[:-1]) > 0


def _contexts(words: Words, at: np.ndarray, rolling, rolling_2):
    """The anchors that windows cover, with two hashes of all words of these windows and of the anchor's place in them."""
    low, high = words.starts_over(at)
    some = high >= low
    at, low, high = at[some], low[some], high[some]
    left = (at - low).astype(np.uint64)
    return at, low, high, rolling.of(low, high + WINDOW) ^ left, rolling_2.of(low, high + WINDOW) ^ left


def _ask_anchors(buckets: int):
    def run(batch, table, _):
        words = Words(table)
        at = words.anchors()
        hashes = RollingHash(words.hashes).of(at, at + ANCHOR)
        least = lookups.least_records(hashes, np.zeros(len(hashes), np.uint64), words.ids[words.doc[at]])
        records = np.zeros(len(least), lookups.SHARED)
        records["a"], records["many"] = least["a"], least["many"]
        yield from lookups.requests_of(batch, SHARED_ANCHORS, records, buckets)

    return run


def _ask_contexts(buckets: int):
    def run(batch, table, got):
        shared = np.sort(lookups.gather(got.get(SHARED_ANCHORS, []), np.dtype("<u8")))
        if not len(shared):
            return
        words = Words(table)
        rolling, rolling_2 = RollingHash(words.hashes), RollingHash(words.hashes, BASE_2)
        at = words.anchors()
        hashes = rolling.of(at, at + ANCHOR)
        place = np.minimum(np.searchsorted(shared, hashes), len(shared) - 1)
        at, _, _, c1, c2 = _contexts(words, at[shared[place] == hashes], rolling, rolling_2)
        hashes = rolling.of(at, at + ANCHOR)
        yield from lookups.requests_of(batch, CONTEXTS, lookups.least_records(c1, c2, words.ids[words.doc[at]]), buckets)
        yield from lookups.requests_of(batch, CONTESTED, lookups.keyed_records(hashes, c1), buckets)

    return run


def _after_extension(words: Words, got: dict, rolling, rolling_2):
    """Which window starts the contexts remove, and which are left to be judged one by one."""
    n = len(words.hashes)
    at, low, high, c1, c2 = _contexts(words, words.anchors(), rolling, rolling_2)
    found = lookups.gather(got.get(CONTEXTS, []), lookups.FOUND)
    hit = lookups.find(c1, c2, found["a"], found["b"])
    gone = hit >= 0
    gone[gone] = found["doc"][hit[gone]] < words.ids[words.doc[at[gone]]]
    removed = _mark(n, low[gone], high[gone] + 1)
    contested = np.sort(lookups.gather(got.get(CONTESTED, []), lookups.KEYED)["a"])
    if not len(contested):
        return removed, np.zeros(0, np.int64)
    hashes = rolling.of(at, at + ANCHOR)
    mine = contested[np.minimum(np.searchsorted(contested, hashes), len(contested) - 1)] == hashes
    return removed, np.flatnonzero(_mark(n, low[mine], high[mine] + 1) & ~removed)


def _ask_windows(buckets: int):
    def run(batch, table, got):
        if not got:
            return
        words = Words(table)
        rolling, rolling_2 = RollingHash(words.hashes, BASE), RollingHash(words.hashes, BASE_2)
        _, left = _after_extension(words, got, rolling, rolling_2)
        records = lookups.least_records(rolling.of(left, left + WINDOW), rolling_2.of(left, left + WINDOW), words.ids[words.doc[left]])
        yield from lookups.requests_of(batch, WINDOWS, records, buckets)

    return run


def _cut(batch, table, got):
    words = Words(table)
    n = len(words.hashes)
    starts = np.zeros(n, bool)
    if got:
        rolling, rolling_2 = RollingHash(words.hashes, BASE), RollingHash(words.hashes, BASE_2)
        starts, left = _after_extension(words, got, rolling, rolling_2)
        found = lookups.gather(got.get(WINDOWS, []), lookups.FOUND)
        hit = lookups.find(rolling.of(left, left + WINDOW), rolling_2.of(left, left + WINDOW), found["a"], found["b"])
        gone = hit >= 0
        gone[gone] = found["doc"][hit[gone]] < words.ids[words.doc[left[gone]]]
        starts[left[gone]] = True
    starts = np.flatnonzero(starts)
    covered = np.zeros(n + 2, np.int8)
    covered[1:-1] = _mark(n, starts, starts + WINDOW)
    # a span ends with its document
    edges = np.diff(covered)
    begins, ends = edges[:-1] == 1, edges[1:] == -1
    inner = words.first[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    joined = inner[(covered[inner] == 1) & (covered[inner + 1] == 1)]
    begins[joined] = True
    ends[joined - 1] = True
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    cuts = np.searchsorted(begin, words.first)
    spans, kept, removed = [], [], []
    raw, offsets = words.raw.tobytes(), words.offsets
    for doc in range(len(words.ids)):
        own = raw[offsets[doc] : offsets[doc + 1]].split()
        if cuts[doc] == cuts[doc + 1]:
            spans.append([])
            removed.append(0)
            kept.append(b" ".join(own))
            continue
        base = words.first[doc]
        pairs = [(int(a - base), int(b - base)) for a, b in zip(begin[cuts[doc] : cuts[doc + 1]], end[cuts[doc] : cuts[doc + 1]])]
        stay, at = [], 0
        for a, b in pairs:
            stay += own[at:a]
            at = b
        stay += own[at:]
        spans.append([{"first": a, "stop": b} for a, b in pairs])
        removed.append(sum(b - a for a, b in pairs))
        kept.append(b" ".join(stay))
    yield pa.RecordBatch.from_arrays(
        [
            table.column("doc_id").combine_chunks(),
            pa.array(np.diff(words.first), pa.int64()),
            pa.array(removed, pa.int64()),
            pa.array(spans, RESULT_ARROW.field("spans").type),
            pa.array(kept, pa.binary()).cast(pa.string()),
        ],
        schema=RESULT_ARROW,
    )


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove every word covered by a 50-word window whose words also start in a document of smaller id.

    Words are runs of anything but ASCII white space. Per row: doc_id, n_words, n_removed, spans (removed
    runs of words, from first up to stop) and kept (the other words joined by one space). Windows are judged
    on the input. A null text has no words; a null id counts as larger than any other, and rows of equal id
    do not remove each other's words; repeated rows each get a row. Other columns are not read.
    """
    rows, buckets = lookups.in_batches(docs, id_col, text_col)
    anchors = lookups.answer(lookups.per_batch(rows, _ask_anchors(buckets), lookups.REQUESTS), buckets, {SHARED_ANCHORS: lookups.answer_shared})
    contexts = lookups.answer(
        lookups.with_replies(rows, anchors, _ask_contexts(buckets), lookups.REQUESTS), buckets, {CONTEXTS: lookups.answer_least, CONTESTED: lookups.answer_contested}
    )
    windows = lookups.answer(lookups.with_replies(rows, contexts, _ask_windows(buckets), lookups.REQUESTS), buckets, {WINDOWS: lookups.answer_least})
    return lookups.with_replies(rows, contexts.unionByName(windows), _cut, RESULT)
