"""Exact top-k by inner product, with no random access to the candidates' components.

Every block of candidates keeps one sorted list per component. For a positive component of the
query a list is read from its largest value down, for a negative one from its smallest up. The
lists are read in steps; what a step reads is added to the candidates' partial scores, and gives
each a lower and an upper bound: an unread component contributes no more than the last value read
and no less than the list's end. A candidate whose upper bound is below the k-th best lower bound
is an outsider: it is not read on. Reading stops where few are left for every query or the lists
end; the entries that the few have not shown yet are then added, which resolves their scores.
All queries of a block read together.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize
from .vectors import matrix, usable

#: Candidates and queries of one block.
CANDIDATES = 4096
QUERIES = 512
#: Steps in which the lists are read: each reads half of what is left.
STEPS = 5
#: Reading stops when this many times k candidates are left.
FEW = 8


def _product(a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """Integer products a b^T without rounding: in doubles below 2^53, else in 64-bit integers."""
    if limit < 1 << 53:
        return a.astype(np.float64) @ b.astype(np.float64).T
    if limit >= 1 << 63:
        raise OverflowError("inner products beyond 64 bits")
    return a.astype(np.int64) @ b.astype(np.int64).T


def block_top(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int, read: list | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the query, id, score) of each query's k best rows of a block; ties go to smaller ids, a query's own id is left out.

    read: gets a row per step, the share of the lists read and the share of (query, candidate) that may still qualify.
    """
    n, width = rows.shape
    limit = int(np.abs(queries).max(initial=0)) * int(np.abs(rows).max(initial=0)) * width
    weights = np.concatenate([np.maximum(queries, 0), np.minimum(queries, 0)], axis=1)
    lists = np.sort(rows, axis=0)
    ends = np.concatenate([lists[0], lists[-1]])
    values = np.concatenate([rows, rows], axis=1)  # what the lists hold of each candidate: read downwards, and upwards
    shown = np.zeros(values.shape, bool)
    partial = _product(weights, np.zeros_like(values), limit)
    lowest = np.iinfo(np.int64).min // 2
    left = ids[None, :] != query_ids[:, None]  # candidates that may still qualify
    threshold = np.full(len(queries), lowest)
    for step in range(1, STEPS + 1):
        depth = n - (n >> step)
        last = np.concatenate([lists[n - depth], lists[depth - 1]])
        now = np.concatenate([values[:, :width] >= last[:width], values[:, width:] <= last[width:]], axis=1)
        partial += _product(weights, np.where(now & ~shown, values, 0), limit)
        shown = now
        if k < depth < n:
            lower = partial + _product(weights, np.where(shown, 0, ends), limit)
            lower[~left] = lowest
            if lower.shape[1] >= k:
                at = lower.shape[1] - k
                threshold = np.maximum(threshold, np.partition(lower, at, axis=1)[:, at])
            left &= partial + _product(weights, np.where(shown, 0, last), limit) >= threshold[:, None]
            if read is not None:
                read.append((depth / n, left.sum() / (len(queries) * n)))
            some = left.any(0)
            if not some.all():  # outsiders of all queries are not read on
                values, shown, partial, left, ids = values[some], shown[some], partial[:, some], left[:, some], ids[some]
            if left.sum(1).max(initial=0) <= FEW * k:
                break
    partial += _product(weights, np.where(shown, 0, values), limit)
    out_q, out_id, out_score = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for q in range(len(queries)):
        some = np.flatnonzero(left[q])
        score = partial[q, some].astype(np.int64)
        if len(some) > k:
            bound = np.partition(score, len(score) - k)[len(score) - k]
            some, score = some[score >= bound], score[score >= bound]
        by = np.lexsort((ids[some], -score))[:k]
        out_q.append(np.full(len(by), q))
        out_id.append(ids[some[by]])
        out_score.append(score[by])
    return np.concatenate(out_q), np.concatenate(out_id), np.concatenate(out_score)


def top_by_inner_product(table: DataFrame, k: int = 10, every: int = 100, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k highest inner products of floor(scale * x) for every vector whose id is divisible by `every`: query_id, rank, vec_id, score.

    Candidates are all rows but the query's own, ties go to the smaller id; with fewer than k, all are
    returned. Vectors that are null or hold null or non-finite components take no part (vectors.usable);
    zero vectors do. Equal rows (id and vector) count as one; rows of one id with different vectors are queries
    each (query_id and rank repeat then) and candidates each; vectors meet those of their own length. Products beyond 64 bits raise. Rows are dealt into even
    blocks by a hash of the row and each block of queries meets each block of rows once: a stated query set against all rows.
    """
    rows = usable(table, id_col, vector_col, zero=True)
    rows = rows.select("vec_id", F.transform("v", lambda x: F.floor(x * scale)).alias("v"), "width")
    rows = materialize(rows, "integers")
    counts = rows.agg(F.count("*"), F.count_if(F.col("vec_id") % every == 0)).first()
    row_blocks, query_blocks = max(1, -(-counts[0] // CANDIDATES)), max(1, -(-counts[1] // QUERIES))
    block = F.pmod(F.xxhash64("vec_id", "v"), F.lit(row_blocks)).cast("int")
    query_block = F.pmod(F.xxhash64("vec_id", "v"), F.lit(query_blocks)).cast("int")
    dealt = rows.select("vec_id", "v", "width", block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("query_block"))
    asked = rows.where(F.col("vec_id") % every == 0).select("vec_id", "v", "width", F.xxhash64("v").alias("query"), query_block.alias("query_block"), F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))).alias("block"))

    def top(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [np.zeros(0, np.int64)] * 4
        if left.num_rows and right.num_rows:
            query_ids = right.column("vec_id").combine_chunks().to_numpy()
            q, ids, score = block_top(matrix(right.column("v"), np.int64), query_ids, matrix(left.column("v"), np.int64), left.column("vec_id").combine_chunks().to_numpy(), k)
            out = [query_ids[q], right.column("query").combine_chunks().to_numpy()[q], ids, score]
        return pa.table({name: pa.array(x, pa.int64()) for name, x in zip(("query_id", "query", "vec_id", "score"), out)})

    pair = ["width", "block", "query_block"]
    best = dealt.groupBy(*pair).cogroup(asked.groupBy(*pair)).applyInArrow(top, "query_id bigint, query bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
