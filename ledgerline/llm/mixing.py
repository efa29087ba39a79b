"""Mixing sources to target weights: how often each document is taken, so that each source's words meet its budget.

A source's target is its share of all words by weight, at most MOST times what it has; what is above
that is shared again among the others. Whole passes over the source come first. What remains is a
subset-sum problem over the exact lengths: how many documents of each length are taken once more.
Every length first gives its share (rounded down), which keeps the mix of lengths; a bounded knapsack
over the counts that are left then fits the rest. Of a length, documents are taken by a seeded hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import dropped, materialize, shuffle_partitions

#: Words of a source that the knapsack fits; what is above goes to the longest documents left first.
FITTED = 1 << 16
#: Times that a document is taken at most.
MOST = 3
#: Documents of one source and length whose hashes are ranked in one group (about).
RANKED = 20_000
WORD = r"[^\x20\x09-\x0D]+"


def subset(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take (at most `counts`), so that their words come nearest to the budget.

    Exact: a bounded knapsack over sums up to twice the budget (beyond that, taking none is nearer). Counts are split
    into powers of two; each sum remembers the part that reached it first, so that walking back uses no part twice.
    Of two sums equally near, the smaller is taken.
    """
    taken = np.zeros(len(lengths), np.int64)
    top = 2 * budget
    reached, by = np.zeros(top + 1, bool), np.full(top + 1, -1, np.int64)
    reached[0] = True
    parts = []
    for at in np.argsort(-lengths, kind="stable").tolist():
        length, left, many = int(lengths[at]), int(counts[at]), 1
        left = min(left, top // length) if length else 0
        while left > 0 and not reached[budget]:
            many = min(many, left)
            weight = many * length
            if weight <= top:
                new = np.flatnonzero(reached[: top + 1 - weight] & ~reached[weight:]) + weight
                reached[new] = True
                by[new] = len(parts)
            parts.append((at, many, weight))
            left -= many
            many *= 2
    below, above = np.flatnonzero(reached[: budget + 1])[-1], budget + np.flatnonzero(reached[budget:])[:1]
    total = int(above[0]) if len(above) and above[0] - budget < budget - below else int(below)
    while total:
        at, many, weight = parts[by[total]]
        taken[at] += many
        total -= weight
    return taken


def fitted(lengths: np.ndarray, counts: np.ndarray, budget: int, most: int = FITTED) -> np.ndarray:
    """How many documents of each length to take for a budget of at most all their words."""
    whole = int((lengths * counts).sum())
    if budget <= 0 or not whole:
        return np.zeros(len(lengths), np.int64)
    taken = np.array([int(n) * budget // whole for n in counts.tolist()], np.int64)
    rest = budget - int((taken * lengths).sum())
    for at in np.argsort(-lengths, kind="stable").tolist():
        if rest <= most:
            break
        more = min(int(counts[at] - taken[at]), (rest - most) // int(lengths[at])) if lengths[at] else 0
        taken[at] += more
        rest -= more * int(lengths[at])
    return taken + subset(lengths, counts - taken, rest)


def numbered(sources: DataFrame, key: str) -> DataFrame:
    """sources with `nth`: its place (from 0) in the order of key, nulls last; rows are ranked by ranges, not in one task."""
    spark = sources.sparkSession
    order = F.col(key).asc_nulls_last()
    dealt = sources.repartitionByRange(shuffle_partitions(spark), order).withColumn("part", F.spark_partition_id())
    stored = materialize(dealt, "sources")
    sizes = stored.groupBy("part").count()
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = sizes.select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    nth = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1 + F.col("start")
    return stored.join(F.broadcast(starts), "part").withColumn("nth", nth.cast("long")).drop("part", "start")


def with_targets(sources: DataFrame, weight: Column, most: int = MOST) -> DataFrame:
    """sources (source_size) with `target`: its weight's share of all words, at most `most` times its own.

    What is above that is shared again by weight, in rounds, until none is above. A round is one sum over the sources;
    comparisons are in whole numbers.
    """
    rows = materialize(sources.withColumns({"weight": weight.cast("decimal(18,0)"), "full": F.lit(False)}), "weights")
    limit = (F.col("source_size") * most).cast("decimal(20,0)")
    total = rows.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    full_words = full_count = 0
    while True:
        free = rows.where("not full").agg(F.sum("weight")).first()[0] or 0
        shared = total - most * int(full_words)
        above = F.col("weight") * F.lit(shared).cast("decimal(18,0)") > limit * F.lit(int(free)).cast("decimal(18,0)")
        state = rows.withColumn("full", F.col("full") | above)
        n, full_words = state.where("full").agg(F.count("*"), F.coalesce(F.sum("source_size"), F.lit(0))).first()
        if n == full_count:
            break
        full_count, last = n, rows
        rows = materialize(state, "weights")
        dropped(last)
    target = F.when(F.col("full"), limit.cast("double")).otherwise(F.col("weight").cast("double") * F.lit(float(shared)) / F.lit(float(free or 1)))
    return rows.withColumn("target", target).drop("weight", "full")


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (1, 2, 3),
    seed: int = 7,
    most: int = MOST,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Per row of docs: doc_id, source, size (words), source_size, target (its source's, in words), times and taken = times * size.

    Sources in order of their code points, null last, have the weights in turn. All sources together get as many words as
    there are. A source without words has target 0; a document without words is taken 0 times over what the passes give,
    and takes 0 words. Sizes are counted over whole texts (null: 0). Rows of one id are documents each; which of equal
    rows is taken does not show. Other columns are not read. The choice follows from ids, sizes, sources and the seed only,
    so reruns agree.

    Texts are read once; the rest runs over (id, source, size). A source's histogram goes to one task: at most as many
    rows as its longest document has words. Documents of one source and length are ranked in groups of about RANKED, by ranges of their hash.
    """
    text, source = F.col(f"`{text_col}`"), F.col(f"`{source_col}`").cast("string")
    sized = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        source.alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )
    spark = docs.sparkSession
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("key")  # never null
    chance = F.xxhash64(F.lit(seed), F.col("doc_id")).alias("chance")
    sized = materialize(sized.select("*", key, chance), "sizes")
    groups = max(1, -(-sized.count() // RANKED))
    group = F.floor((F.col("chance").cast("double") / 2.0**64 + 0.5) * groups).cast("long").alias("slice")
    sized = sized.withColumn("slice", group)
    counts = materialize(sized.groupBy("key", "source", "size", "slice").agg(F.count("*").alias("n")), "length-counts")
    sources = counts.groupBy("key", "source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("nth") % len(weights) + 1).cast("int"))
    targets = with_targets(numbered(sources, "source"), weight, most)
    # whole passes, and the words that are left for one more choice
    passes = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most))).otherwise(0).cast("long")
    targets = targets.withColumn("passes", passes).withColumn("budget", F.round(F.col("target") - F.col("passes") * F.col("source_size")).cast("long"))
    plan = materialize(targets.select("key", "source_size", "target", "passes", F.least(F.greatest("budget", F.lit(0)), "source_size").alias("budget")), "targets")

    def fit(table: pa.Table) -> pa.Table:
        lengths, n = (table.column(c).combine_chunks().to_numpy() for c in ("size", "n"))
        chosen = fitted(lengths, n, table.column("budget")[0].as_py())
        return pa.table({"key": table.column("key"), "size": table.column("size"), "chosen": pa.array(chosen, pa.int64())})

    lengths = counts.where("size > 0").groupBy("key", "size").agg(F.sum("n").alias("n")).join(plan.where("passes < " + str(most)).select("key", "budget"), "key")
    chosen = lengths.groupBy("key").applyInArrow(fit, "key string, size bigint, chosen bigint")
    before = Window.partitionBy("key", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    cuts = counts.select("key", "size", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    cuts = cuts.join(chosen, ["key", "size"], "left").join(plan.drop("budget"), "key")
    cuts = materialize(cuts.withColumn("more", F.coalesce("chosen", F.lit(0)) - F.col("start")).drop("chosen", "start"), "cuts")
    nth = F.row_number().over(Window.partitionBy("key", "size", "slice").orderBy("chance", "doc_id"))
    times = F.col("passes") + (F.col("nth") <= F.col("more")).cast("long")
    found = sized.join(cuts, ["key", "size", "slice"]).withColumn("nth", nth).withColumn("times", times)
    return found.select("doc_id", "source", "size", "source_size", "target", "times", (F.col("times") * F.col("size")).alias("taken"))
