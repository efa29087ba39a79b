"""Approximate nearest neighbours with a forest of random-projection trees.

Every inner node of a tree has a random direction; vectors go left or right of the median of a
bounded sample there. A query searches all trees through one priority queue: whatever tree a
node is in, the one whose splitting planes are nearest to the query is opened next, until the
leaves opened hold `share` of all vectors (counted with repeats). The leaves are then read as
blocks, distances in them are exact, and the nearest of all blocks win.
"""

from __future__ import annotations

import heapq
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize
from .vectors import distinct_vectors, matrix, usable

#: Vectors that the trees are fitted on, at most.
SAMPLE = 20_000
TREES = 8
DEEPEST = 10
#: Vectors wanted in a leaf, and rows and queries of a leaf that one task reads (larger leaves are read in parts).
LEAF = 400
PART = 4096
QUERIES = 1024
#: Queries whose distances to all planes are computed at once.
SEARCHED_AT_ONCE = 64


def fit(sample: np.ndarray, depth: int, trees: int = TREES, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Directions (trees, 2^depth, width) and thresholds (trees, 2^depth); node k has the children 2k and 2k+1, the root is 1."""
    draw = np.random.default_rng(seed)
    width = sample.shape[1]
    directions, cuts = draw.normal(size=(trees, 1 << depth, width)), np.zeros((trees, 1 << depth))
    directions /= np.linalg.norm(directions, axis=2, keepdims=True)
    for tree in range(trees):
        node = np.ones(len(sample), np.int64)
        for level in range(depth):
            side = np.einsum("ij,ij->i", sample, directions[tree, node])
            for k in range(1 << level, 2 << level):
                own = side[node == k]
                cuts[tree, k] = np.median(own) if len(own) else 0.0
            node = 2 * node + (side > cuts[tree, node])
    return directions, cuts


def leaves_of(rows: np.ndarray, directions: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The leaf of each row in each tree, (trees, rows)."""
    trees, nodes, _ = directions.shape
    out = np.ones((trees, len(rows)), np.int64)
    for tree in range(trees):
        side = rows @ directions[tree].T
        at = np.arange(len(rows))
        for _ in range(nodes.bit_length() - 1):
            node = out[tree]
            out[tree] = 2 * node + (side[at, node] > cuts[tree, node])
    return out


def search(sides: np.ndarray, sizes: dict[tuple[int, int], int], budget: float) -> list[tuple[int, int]]:
    """The leaves (tree, leaf) that one query opens; sides: its signed distance to the plane of each node, (trees, nodes)."""
    trees, nodes = sides.shape
    sides = sides.tolist()
    queue = [(0.0, tree, 1) for tree in range(trees)]
    opened, held = [], 0
    while queue and held < budget:
        far, tree, node = heapq.heappop(queue)
        while node < nodes:
            side = sides[tree][node]
            near = 2 * node + (side > 0)
            heapq.heappush(queue, (max(far, abs(side)), tree, near ^ 1))
            node = near
        size = sizes.get((tree, node), 0)
        if size:
            opened.append((tree, node))
            held += size
    return opened


def nearest(
    table: DataFrame, k: int = 10, every: int = 100, share: float = 1.1, id_col: str = "vec_id", vector_col: str = "embedding", trees: int = TREES, sample: int = SAMPLE
) -> DataFrame:
    """The k nearest found of every vector whose id is divisible by `every`: query_id, rank, vec_id, score.

    score is the Euclidean distance in double precision; ties go to the smaller id; a query's own row is no
    candidate. Vectors that are null, zero or not finite take no part (see vectors.usable). Equal vectors are
    indexed once and answered for all their ids; with fewer candidates than k, all are returned. The trees are
    fitted on at most `sample` distinct vectors, but every vector is indexed. Equal rows (id and vector) count as
    one; rows of one id with different vectors are queries each (query_id and rank repeat then). Vectors of different lengths
    have no distance: each length has a forest of its own.
    """
    rows = usable(table, id_col, vector_col, zero=False)
    widths = sorted(r[0] for r in rows.select("width").distinct().collect())  # one row a vector length
    found = [_nearest(rows.where(F.col("width") == w).drop("width"), k, every, share, trees, sample) for w in widths]
    return reduce(DataFrame.unionByName, found) if found else table.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")


def _nearest(rows: DataFrame, k: int, every: int, share: float, trees: int, sample: int) -> DataFrame:
    """nearest() over usable rows of one length."""
    spark = rows.sparkSession
    vectors = materialize(distinct_vectors(rows, k + 1), "vectors")
    n = vectors.count()
    depth = max(0, min(DEEPEST, int(np.log2(max(1, n / LEAF))), int(np.log2(max(1, min(n, sample) / 16)))))
    step = -(-n // sample) if n else 1
    drawn = vectors.where(F.pmod(F.xxhash64("first"), F.lit(step)) == 0).select("v").limit(sample).toArrow()
    drawn = matrix(drawn.column("v"))
    if not len(drawn):
        drawn = matrix(vectors.select("v").limit(1).toArrow().column("v"))
    if not len(drawn):
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    directions, cuts = fit(drawn, depth, trees)

    def place(batches):
        for batch in batches:
            own = matrix(batch.column("v"))
            if len(own):
                at = leaves_of(own, directions, cuts)
                first = batch.column("first")
                for tree in range(trees):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), tree, np.int32)), pa.array(at[tree]), first, batch.column("v")], ["tree", "leaf", "first", "v"])

    placed = vectors.select("first", "v").mapInArrow(place, "tree int, leaf bigint, first bigint, v array<double>")
    placed = materialize(placed, "leaves")
    sizes = {(r["tree"], r["leaf"]): r["n"] for r in placed.groupBy("tree", "leaf").agg(F.count("*").alias("n")).collect()}  # trees * 2^depth rows at most
    budget = max(share * n, 2.0 * (k + 1))
    parts = spark.createDataFrame([(t, leaf, -(-size // PART)) for (t, leaf), size in sizes.items()], "tree int, leaf bigint, parts int")

    def opens(batches):
        for batch in batches:
            own = matrix(batch.column("v"))
            tree, leaf, which = [], [], []
            for at in range(0, len(own), SEARCHED_AT_ONCE):
                sides = np.einsum("qw,tnw->qtn", own[at : at + SEARCHED_AT_ONCE], directions) - cuts[None]
                for i, side in enumerate(sides):
                    for t, x in search(side, sizes, budget):
                        tree.append(t)
                        leaf.append(x)
                        which.append(at + i)
            taken = pa.array(which, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(tree, pa.int32()), pa.array(leaf, pa.int64()), batch.column("query").take(taken), batch.column("v").take(taken)], ["tree", "leaf", "query", "v"])

    queries = rows.where(F.col("vec_id") % every == 0).join(vectors.select("v", "first"), "v").select(F.col("vec_id").alias("query_id"), F.col("first").alias("query"))
    queries = materialize(queries, "queries")
    asked = vectors.join(queries.select(F.col("query").alias("first")).distinct(), "first", "left_semi")
    asked = materialize(asked.select(F.col("first").alias("query"), "v").repartition("query"), "asked")
    query_blocks = max(1, -(-asked.count() // QUERIES))
    opened = asked.mapInArrow(opens, "tree int, leaf bigint, query bigint, v array<double>").join(F.broadcast(parts), ["tree", "leaf"])
    opened = opened.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    opened = opened.withColumn("query_block", F.pmod(F.xxhash64("query"), F.lit(query_blocks)).cast("int"))
    blocks = placed.join(F.broadcast(parts), ["tree", "leaf"]).withColumn("part", F.pmod(F.xxhash64("first"), F.col("parts").cast("long")).cast("int")).drop("parts")
    blocks = blocks.withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))

    def rerank(left: pa.Table, right: pa.Table) -> pa.Table:
        query, first, score = [], [], []
        if left.num_rows and right.num_rows:
            own, ids = matrix(left.column("v")), left.column("first").combine_chunks().to_numpy()
            for q, x in zip(right.column("query").to_pylist(), matrix(right.column("v"))):
                gap = own - x
                square = np.einsum("ij,ij->i", gap, gap)
                if len(square) > k + 1:
                    bound = np.partition(square, k)[k]
                    some = np.flatnonzero(square <= bound)
                else:
                    some = np.arange(len(square))
                some = some[np.lexsort((ids[some], square[some]))][: k + 1]
                query += [q] * len(some)
                first += ids[some].tolist()
                score += np.sqrt(square[some]).tolist()
        return pa.table({"query": pa.array(query, pa.int64()), "first": pa.array(first, pa.int64()), "score": pa.array(score, pa.float64())})

    block = ["tree", "leaf", "part", "query_block"]
    found = blocks.groupBy(*block).cogroup(opened.groupBy(*block)).applyInArrow(rerank, "query bigint, first bigint, score double").distinct()
    best = found.withColumn("nth", F.row_number().over(Window.partitionBy("query").orderBy("score", "first"))).where(F.col("nth") <= k + 1)
    members = best.join(vectors.select("first", F.explode("ids").alias("vec_id")), "first").select("query", "vec_id", "score")
    answers = queries.join(members, "query").where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id", "query").orderBy("score", "vec_id"))
    return answers.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
