"""Snapshot and change-feed diffs, the index that they carry forward, and their application."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

#: Operations larger than this many bytes are left out and counted.
LARGEST = 1 << 20


def last_per_key(previous: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the last in order (W3). Rows without a key are left out."""
    keyed = previous.where(_complete(keys))
    window = Window.partitionBy(*keys).orderBy(*[_reverse(c) for c in order])
    return keyed.withColumn("_nth", F.row_number().over(window)).where("_nth = 1").drop("_nth")


def _reverse(column: Column) -> Column:
    return column.desc()


def _complete(keys: list[str]) -> Column:
    whole = F.lit(True)
    for key in keys:
        whole = whole & F.col(key).isNotNull()
    return whole


def _consumed(previous: DataFrame, current: DataFrame, keys: list[str], columns: list[str], previous_order: list[Column], current_order: list[Column]) -> DataFrame:
    """keys, ordinal, _new and _old: each previous row met once, by the first current row of its key.

    Both sides are dealt out by the key for their numbering, and the join is on the key alone (that only first rows
    meet is a residual condition), so it moves nothing again.
    """
    old = last_per_key(previous, keys, previous_order).select(*[F.col(k).alias(f"_old_{k}") for k in keys], F.struct(*columns).alias("_old"))
    ordinal = F.row_number().over(Window.partitionBy(*keys).orderBy(*current_order))
    new = current.where(_complete(keys)).select(*keys, F.struct(*columns).alias("_new"), ordinal.alias("_ordinal"))
    meets = F.col("_ordinal") == 1
    for k in keys:
        meets = meets & (F.col(k) == F.col(f"_old_{k}"))
    both = new.join(old, meets, "full_outer")
    return both.select(*[F.coalesce(k, f"_old_{k}").alias(k) for k in keys], F.coalesce("_ordinal", F.lit(1)).alias("ordinal"), "_new", "_old")


def _op() -> Column:
    return (
        F.when(F.col("_old").isNull(), "insert")
        .when(F.col("_new").isNull(), "delete")
        .when(F.col("_old").eqNullSafe(F.col("_new")), "unchanged")
        .otherwise("update")
    )


def snapshot_diff(previous: DataFrame, current: DataFrame, keys: list[str], columns: list[str], previous_order: list[Column], current_order: list[Column]) -> DataFrame:
    """keys, op and ordinal: insert, update, delete or unchanged.

    Of the previous rows of a key the last one counts, and it is consumed once: the first current row of
    the key meets it, later ones are inserts. Rows compare by all columns, nulls equal. Current rows without a
    key are unkeyed, previous ones are left out.
    """
    both = _consumed(previous, current, keys, columns, previous_order, current_order)
    unkeyed = current.where(~_complete(keys)).select(*keys, F.lit("unkeyed").alias("op"), F.lit(1).alias("ordinal"))
    return both.select(*keys, _op().alias("op"), "ordinal").unionByName(unkeyed)


def operations(previous: DataFrame, current: DataFrame, keys: list[str], columns: list[str], previous_order: list[Column], current_order: list[Column]) -> DataFrame:
    """The operation log of a snapshot diff: op, keys and, for inserts and updates, the full new state."""
    both = _consumed(previous, current, keys, columns, previous_order, current_order).withColumn("op", _op()).where("op <> 'unchanged'")
    return both.select("op", *keys, "ordinal", *[F.col(f"_new.{c}").alias(c) for c in columns])


def apply_operations(base: DataFrame, ops: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """The table after its operations (T7): deletes and updates replace the row of their key, inserts add theirs.

    ops is read twice; a run stores it anyway (session.stored), so that it is not made twice.
    """
    touched = ops.where("op in ('update', 'delete')").select(*keys)
    kept = base.select(*keys, *columns).join(touched, keys, "left_anti")
    return kept.unionByName(ops.where("op in ('insert', 'update')").select(*keys, *columns))


def change_feed_diff(previous: DataFrame, current: DataFrame, touched: DataFrame, deleted: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """key and op from a change feed (J2, U2, U4): only touched rows of the table are read.

    A touched row is an insert, update or unchanged against the previous state, and consumes its key even where
    unchanged. Named deletes of keys that are there and not consumed are deletes; of others they are unknown
    (T10). A touched key without a row yields nothing. previous and current have one row per key.
    """
    flagged = lambda df, mine: df.select(key, F.lit(mine).alias("_touched"), F.lit(not mine).alias("_named")).where(F.col(key).isNotNull())
    named = flagged(touched, True).unionByName(flagged(deleted, False)).groupBy(key).agg(F.bool_or("_touched").alias("_touched"), F.bool_or("_named").alias("_named"))
    # the names are used three times, and stored for it; the tables are reduced to the named keys where they lie, if these are few enough to be broadcast; no join outgrows them
    named = stored(named, "named-keys")
    own = lambda df, state: df.join(named.select(key), key, "left_semi").select(key, F.struct(*columns).alias(state))
    both = named.join(own(current, "_new"), key, "left").join(own(previous, "_old"), key, "left")
    read = F.col("_touched") & F.col("_new").isNotNull()
    state = F.when(read, F.when(F.col("_old").isNull(), "insert").when(F.col("_old").eqNullSafe(F.col("_new")), "unchanged").otherwise("update"))
    gone = F.when(F.col("_named"), F.when(F.col("_old").isNotNull() & ~read, "delete").otherwise("unknown"))
    return both.select(key, F.explode(F.array_compact(F.array(state, gone))).alias("op"))


def roll_index(index: DataFrame, ops: DataFrame, key: str) -> DataFrame:
    """The key index after the written operations (T3): key, feature_id and hash; what was not written keeps its entry.

    index: key, feature_id, hash. ops: op, key and, but for deletes, feature_id and hash; at most one per key. The index
    meets the written keys only, in an anti join that broadcasts them where they are few. ops is read twice: store it first.
    """
    columns = [key, "feature_id", "hash"]
    kept = index.select(*columns).join(ops.select(key), key, "left_anti")
    return kept.unionByName(ops.where("op <> 'delete'").select(*columns))


def split_oversize(ops: DataFrame, largest: int = LARGEST) -> tuple[DataFrame, DataFrame]:
    """Operations that fit, and the key columns and sizes of those that are too large as JSON."""
    sized = ops.withColumn("_bytes", F.octet_length(F.to_json(F.struct(*ops.columns))))
    return sized.where(F.col("_bytes") <= largest).drop("_bytes"), sized.where(F.col("_bytes") > largest)


def delta_counts(ops: DataFrame) -> DataFrame:
    """inserted, updated, deleted and unchanged in one row (A4)."""
    count = lambda op: F.count_if(F.col("op") == op)
    return ops.agg(count("insert").alias("inserted"), count("update").alias("updated"), count("delete").alias("deleted"), count("unchanged").alias("unchanged"))


def feed_path(layers: DataFrame) -> DataFrame:
    """Whether a service's changes can come from its feed: all its layers or none.

    layers: service, pos, tracked, oid_column, generation, previous_generation. The first layer that cannot, in
    order, gives the reason.
    """
    reason = (
        F.when(~F.coalesce(F.col("tracked"), F.lit(False)), "does not track changes")
        .when(F.col("oid_column").isNull(), "has no object id")
        .when(F.col("previous_generation").isNull(), "was not read before")
        .when(F.col("generation").isNull(), "states no generation")
        .when(F.col("generation") < F.col("previous_generation"), "went back in time")
    )
    judged = layers.withColumn("_reason", reason)
    return judged.groupBy("service").agg(
        F.when(F.count("_reason") == 0, "feed").otherwise("snapshot").alias("path"),
        F.min_by("_reason", F.when(F.col("_reason").isNotNull(), F.col("pos"))).alias("reason"),
    )


def missing_indexes(datasets: DataFrame, index: DataFrame) -> DataFrame:
    """Datasets of an incremental basis that have no index (A20); any of them forbids an increment on it (T5)."""
    return datasets.select("dataset").distinct().join(index.select("dataset").distinct(), "dataset", "left_anti")


def vanished(previous: DataFrame, current: DataFrame, key: str = "dataset") -> DataFrame:
    """Datasets that were there and are not any more."""
    return previous.select(key).distinct().join(current.select(key), key, "left_anti")


def reconcile(full: DataFrame, ops: DataFrame, served: DataFrame) -> DataFrame:
    """Per dataset: full + inserts - deletes against what is served (J24). full, served: dataset, n; ops: dataset, op."""
    moved = ops.groupBy("dataset").agg(F.count_if(F.col("op") == "insert").alias("inserted"), F.count_if(F.col("op") == "delete").alias("deleted"))
    both = full.select("dataset", F.col("n").alias("full_rows")).join(moved, "dataset", "full_outer").join(served.select("dataset", F.col("n").alias("served_rows")), "dataset", "full_outer")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    expected = zero("full_rows") + zero("inserted") - zero("deleted")
    return both.select("dataset", expected.alias("expected"), zero("served_rows").alias("served"), F.when(expected == zero("served_rows"), "OK").otherwise("MISMATCH").alias("state"))
