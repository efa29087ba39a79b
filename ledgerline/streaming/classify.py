"""Stateful classification of a stream of row states: insert, update, unchanged, delete or unknown."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: The state store that a stateful processor needs: it keeps states on disk and what changed in the checkpoint.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
KEY = ["dataset", "oid"]
STATE = "feature_id string, hash string"


class Classifier(StatefulProcessor):
    """What happened to one (dataset, oid) (T2): the state is the feature id and hash under which it is held, while it is there."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("held", STATE)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        """An entry of the key index; of several of one key the last one given counts."""
        self.held.update((initialState["feature_id"], initialState["hash"]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        was = self.held.get() if self.held.exists() else None
        known = tuple(was) if was is not None else None
        for row in sorted(rows, key=lambda r: r["seq"]):
            state, before = row["hash"], known
            if row["gone"]:
                op, known = ("unknown" if known is None else "delete"), None
            elif known is None:
                op, known = "insert", (row["new_id"], state)
            elif known[1] == state:
                op = "unchanged"  # also what a window that overlaps the last one replays (T4)
            else:
                op, known = "update", (known[0], state)
            yield Row(**dict(zip(KEY, key)), seq=row["seq"], op=op, feature_id=(known or before or (None,))[0])
        if known is None and was is not None:
            self.held.clear()
        elif known is not None and known != (tuple(was) if was is not None else None):
            self.held.update(known)

    def close(self) -> None:
        pass


def classify_stream(rows: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """dataset, oid, seq, op and feature_id of a stream of rows (dataset, oid, seq, hash, gone, new_id).

    The state is the whole key set by design, one entry per key in RocksDB, without a watermark: the index that an incremental
    run carries forward. index (dataset, oid, feature_id, hash) seeds a stream that starts anew; a checkpoint goes on from its own.
    A delete of a key that is not there is unknown, not fatal. An insert takes new_id, which is to be derived from what names the row.
    """
    spark = rows.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    kinds = rows.schema
    result = f"dataset {kinds['dataset'].dataType.simpleString()}, oid {kinds['oid'].dataType.simpleString()}, seq {kinds['seq'].dataType.simpleString()}, op string, feature_id string"
    initial = index.select(*KEY, "feature_id", "hash").groupBy(*KEY) if index is not None else None
    return rows.groupBy(*KEY).transformWithState(Classifier(), result, "Append", "None", initial)


def held_states(spark, checkpoint: str) -> DataFrame:
    """dataset, oid, feature_id and hash that a classifying stream holds, read from its checkpoint."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "held").load()
    return state.select(*[F.col(f"key.{k}").alias(k) for k in KEY], "value.feature_id", "value.hash")


def classify_batch(rows: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """The same answer from a table of all rows, by windows over each key's states; an index entry is the state before them all."""
    order = Window.partitionBy(*KEY).orderBy("seq")
    state = rows
    if index is not None:
        first = index.select(*KEY, F.lit(None).cast(rows.schema["seq"].dataType).alias("seq"), "hash", F.lit(False).alias("gone"), F.col("feature_id").alias("new_id"))
        state = rows.select(*first.columns).unionByName(first)
    before = F.lag(F.struct("hash", "gone")).over(order)  # a null seq comes first
    there = before.isNotNull() & ~before["gone"]
    op = F.when(F.col("gone"), F.when(there, "delete").otherwise("unknown")).when(~there, "insert").when(before["hash"] == F.col("hash"), "unchanged").otherwise("update")
    minted = F.last(F.when(F.col("op") == "insert", F.col("new_id")), ignorenulls=True).over(order)
    named = state.withColumn("op", op).withColumn("feature_id", F.when(F.col("op") != "unknown", minted))
    return named.where("seq is not null").select(*KEY, "seq", "op", "feature_id")


def write_deltas(stream: DataFrame, out_path: str, checkpoint: str):
    """Write the operations of every micro-batch as a delta of its own (T4, T6); no table is read or written again.

    A batch that is replayed writes the delta of its own number again, so a restart changes nothing.
    """

    def step(ops: DataFrame, number: int) -> None:
        ops.write.mode("overwrite").parquet(f"{out_path}/delta={number}")

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True)


def after_deltas(base: DataFrame, out_path: str, keys: list[str], columns: list[str], order: list[str]) -> DataFrame:
    """The table after all deltas (T6, T7): of the operations of a key the last one counts, by delta, order, and deletes last.

    The base meets the touched keys only. Writing the result as a new base and removing the deltas that it holds compacts them.
    """
    ops = base.sparkSession.read.option("basePath", out_path).parquet(out_path)
    at = F.struct("delta", *order, (F.col("op") == "delete").alias("last"))
    last = ops.groupBy(*keys).agg(F.max_by(F.struct("op", *columns), at).alias("_o"))
    kept = base.select(*keys, *columns).join(last.select(*keys), keys, "left_anti")
    return kept.unionByName(last.where("_o.op <> 'delete'").select(*keys, *[F.col(f"_o.{c}").alias(c) for c in columns]))
