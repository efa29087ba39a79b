"""The three runs of a migration: a full extraction, an increment on an earlier run, and their application."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions.hashing import content_hash, feature_id
from .operators import diff
from .session import stored
from .versions import Versions


@dataclass
class Extraction:
    """What a run leaves: operations (dataset, key, ordinal, op, feature_id, hash, columns), the key index after them, and counts per dataset."""

    operations: DataFrame
    index: DataFrame
    counts: DataFrame


def _keyed(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Keyed rows with a hash and their number among those of an equal key, by content."""
    hashed = rows.where("key is not null").withColumn("hash", content_hash(*columns))
    order = Window.partitionBy("dataset", "key").orderBy("hash", F.to_json(F.struct(*columns)))
    return hashed.withColumn("ordinal", F.row_number().over(order)).select("dataset", "key", "ordinal", "hash", *columns)


def _new_id(run: str) -> Column:
    """The id of a new row: later rows of a key have ids of their own."""
    first = feature_id(F.lit(run), "dataset", "key")
    return F.when(F.col("ordinal") == 1, first).otherwise(feature_id(F.lit(run), "dataset", "key", "ordinal"))


def _counts(judged: DataFrame, rows: DataFrame) -> DataFrame:
    """Per dataset: what became of the rows (A4), inserts of keys that occur again, and rows without a key, which are left out."""
    count = lambda op: F.count_if(F.col("op") == op)
    counted = judged.groupBy("dataset").agg(
        count("insert").alias("inserted"), count("update").alias("updated"), count("delete").alias("deleted"), F.count_if((F.col("op") == "insert") & (F.col("ordinal") > 1)).alias("repeated"),
        F.count_if(F.col("op").isNull()).alias("unchanged"), count("oversize").alias("oversized"), count("unknown").alias("unknown"), F.coalesce(F.max(F.when(F.col("op") == "oversize", F.col("bytes"))), F.lit(0)).cast("long").alias("largest"),
    )
    unkeyed = rows.groupBy("dataset").agg(F.count_if(F.col("key").isNull()).alias("unkeyed"))
    return unkeyed.join(counted, "dataset", "full_outer").na.fill(0)


def _sized(judged: DataFrame, columns: list[str], largest: int) -> DataFrame:
    """Rows whose operation is too large as JSON become oversize (P7): they consume their key and write nothing."""
    line = F.to_json(F.struct("op", "dataset", "feature_id", *columns))
    sized = judged.withColumn("bytes", F.when(F.col("op").isin("insert", "update"), F.octet_length(line).cast("long")))
    return sized.withColumn("op", F.when(F.col("bytes") > largest, "oversize").otherwise(F.col("op")))


def _extraction(judged: DataFrame, rows: DataFrame, columns: list[str]) -> Extraction:
    """judged (stored, since three results are made of it) as operations, index and counts; entries of rows that were not written stay as they were."""
    ops = judged.where("op in ('insert', 'update', 'delete')").select("dataset", "key", "ordinal", "hash", *columns, "op", "feature_id")
    kept = F.col("op").isNull() | (F.col("op") == "oversize")
    entry = judged.where("op is null or op in ('insert', 'update', 'oversize')")
    entry = entry.select("dataset", "key", "ordinal", F.when(kept, F.col("_id")).otherwise(F.col("feature_id")).alias("feature_id"), F.when(kept, F.col("_hash")).otherwise(F.col("hash")).alias("hash"))
    return Extraction(ops, entry.where("feature_id is not null"), _counts(judged, rows))


def _met(last: DataFrame, rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows and index entries by key: the first row of a key meets its entry. Both are dealt out by the key once; an index that lies in buckets of it stays where it is."""
    old = last.select(F.col("dataset").alias("_dataset"), F.col("key").alias("_key"), F.col("feature_id").alias("_id"), F.col("hash").alias("_hash"))
    meets = (F.col("dataset") == F.col("_dataset")) & (F.col("key") == F.col("_key")) & (F.col("ordinal") == 1)
    return _keyed(rows, columns).join(old, meets, "full_outer")


def extract(rows: DataFrame, columns: list[str], run: str, largest: int = diff.LARGEST) -> Extraction:
    """A full extraction: one insert per keyed row, all datasets in one plan. rows: dataset, key and columns.

    Rows whose operation is larger than `largest` bytes as JSON are counted and left out, of the index too.
    """
    ops = _keyed(rows, columns).withColumn("op", F.lit("insert")).withColumn("feature_id", _new_id(run))
    ops = ops.withColumns({"_id": F.lit(None).cast("string"), "_hash": F.lit(None).cast("long")})
    return _extraction(stored(_sized(ops, columns, largest), "extracted"), rows, columns)


def increment(index: DataFrame, rows: DataFrame, columns: list[str], run: str, largest: int = diff.LARGEST, touched: DataFrame | None = None, deleted: DataFrame | None = None, read_before: DataFrame | None = None) -> Extraction:
    """An increment on the key index of an earlier run (J1, J2, T3, P7): only what changed is an operation, ids stay.

    Of the entries of a key the last one counts, and the first row of the key consumes it; later rows are inserts.
    A row whose operation is larger than `largest` bytes consumes its key, writes nothing (no update and no delete) and leaves
    the index entry as it was. A dataset that has no index is an error (A20, T5): read it in full first. read_before names datasets
    (dataset) that were, whose index may be empty.

    With touched and deleted (dataset, key), as a change feed names them, only touched rows are read, and only named keys
    go: those that are there and were not consumed; others are counted as unknown. All other entries stay.
    """
    known = index.select("dataset")
    missing = diff.missing_indexes(rows, known if read_before is None else known.unionByName(read_before.select("dataset")))
    lost = [r[0] for r in missing.limit(20).collect()]
    if lost:
        raise ValueError(f"no index of {', '.join(map(str, lost))}")
    keys = ["dataset", "key"]
    last = diff.last_per_key(index, keys, [F.col("ordinal")])
    read, met, rest = rows, last, None
    if touched is not None:
        asked = touched.select(*keys).distinct()
        gone = (deleted if deleted is not None else touched.limit(0)).select(*keys).where("key is not null").distinct()
        named = stored(asked.unionByName(gone).distinct(), "named-keys")
        read, met, rest = rows.join(asked, keys, "left_semi"), last.join(named, keys, "left_semi"), index.join(named, keys, "left_anti")
    both = _met(met, read, columns)
    both = both.withColumns({"dataset": F.coalesce("dataset", "_dataset"), "key": F.coalesce("key", "_key"), "ordinal": F.coalesce("ordinal", F.lit(1))})
    op = F.when(F.col("_id").isNull(), "insert").when(F.col("hash").isNull(), "delete").when(F.col("hash") != F.col("_hash"), "update")
    judged = both.withColumn("op", op).withColumn("feature_id", F.coalesce("_id", _new_id(run))).drop("_dataset", "_key")
    if touched is not None:
        # a touched key without a row is no delete; a named one is, unless a row has consumed it
        marked = judged.join(gone.withColumn("_gone", F.lit(True)), keys, "full_outer").withColumn("ordinal", F.coalesce("ordinal", F.lit(1)))
        consumed, absent = F.col("hash").isNotNull() & F.col("_id").isNotNull(), F.col("hash").isNull() & F.col("_id").isNull()
        first = F.col("_gone") & (F.col("ordinal") == 1)
        named_op = F.when(absent, "unknown").when(F.col("op") == "delete", F.when(F.col("_gone"), "delete")).otherwise(F.col("op"))
        extra = marked.where(first & (consumed | (F.col("op") == "insert"))).select("dataset", "key", "ordinal", F.lit("unknown").alias("op"))
        judged = marked.withColumn("op", named_op).drop("_gone").unionByName(extra, allowMissingColumns=True)
    found = _extraction(stored(_sized(judged, columns, largest), "judged"), read, columns)
    if rest is not None:
        found.index = found.index.unionByName(rest.select(*found.index.columns))
    return found


def may_increment(basis_incremental: bool, has_index: bool, path: str) -> str | None:
    """Why an increment on a run is refused (T5), or None: one that is itself an increment needs an index and the feed path."""
    if not has_index:
        return "the basis has no index"
    if basis_incremental and path != "feed":
        return "an increment on an increment needs the change feed"
    return None


def load(base: DataFrame | None, operations: DataFrame, columns: list[str]) -> DataFrame:
    """The target table (dataset, feature_id, columns) after the operations of a run.

    Without a base only inserts are allowed: an increment needs the table that it changes.
    """
    if base is None:
        if not operations.where("op <> 'insert'").isEmpty():
            raise ValueError("an increment needs the table that it changes")
        return operations.select("dataset", "feature_id", *columns)
    return diff.apply_operations(base, operations, ["dataset", "feature_id"], columns)


class Chain:
    """Runs on runs, in one folder of versions (T3, T5, T7): a version has the index and the target after a run, and both appear at once.

    The target is kept as deltas over its last whole state; compact() makes them one.
    """

    TARGET = ["dataset", "feature_id"]

    def __init__(self, spark: SparkSession, folder: str):
        self.versions = Versions(spark, folder)

    def index(self, version: int | None = None) -> DataFrame:
        return self.versions.table("index", version)

    def target(self, version: int | None = None) -> DataFrame:
        return self.versions.table("target", version, self.TARGET)

    def full(self, rows: DataFrame, columns: list[str], run: str, largest: int = diff.LARGEST) -> Extraction:
        """A full run: it starts index and target anew."""
        found = extract(rows, columns, run, largest)
        tables = {"index": found.index, "target": load(None, found.operations, columns), "datasets": rows.select("dataset").distinct()}
        self.versions.commit(self.versions.latest(), tables, facts={"run": run, "incremental": False})
        return found

    def next(self, rows: DataFrame, columns: list[str], run: str, largest: int = diff.LARGEST, touched: DataFrame | None = None, deleted: DataFrame | None = None) -> Extraction:
        """An increment on the newest run; one that may not follow it is an error (T5)."""
        on = self.versions.latest()
        reason = may_increment(on > 0 and self.versions.facts(on)["incremental"], on > 0, "feed" if touched is not None else "snapshot")
        if reason:
            raise ValueError(reason)
        found = increment(self.index(on), rows, columns, run, largest, touched, deleted, self.versions.table("datasets", on))
        ops = found.operations.select("op", *self.TARGET, *columns)
        self.versions.commit(on, {"index": found.index, "target": ops}, deltas=["target"], facts={"run": run, "incremental": True})
        return found

    def compact(self) -> int:
        return self.versions.compact("target", self.TARGET)


def attachment_counts(results: DataFrame) -> DataFrame:
    """Added, replaced, deleted, unchanged and refused attachments in one row (A5)."""
    count = lambda *ops: F.count_if(F.col("op").isin(*ops))
    return results.agg(
        count("add").alias("added"), count("replace", "replace_unseen").alias("replaced"), count("delete").alias("deleted"),
        count("unchanged", "repeat").alias("unchanged"), count("ambiguous", "refused", "orphan", "unknown", "no_id", "no_ids", "incomparable").alias("refused"),
    )
