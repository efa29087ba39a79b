"""A window of attachment edits against what is held: adds that consume, then updates, then deletes.

Adds are judged in the order of their records. One takes the held row of its global id, if no add before it
took that; else it is found by (parent, name): where one row of that name is left it takes it, where none is it
is a first copy, and where two or more are it is refused. What is taken is gone for the adds behind it.

That order is stated in sets. A row is taken by its id at the first add of that id; of a name's rows all but
the one that is taken last this way are sure to go then. Between the last but one and the last, one row is left, and the
first nameless add in that gap takes it. The add that comes for it by id later is then found by its name in turn, and may
take a row from another. Each add can take a row from one other at most, which lies behind it, so these steps are known
before any is made: every add meets its rows once, and what follows from what is found by pointer doubling over the steps.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

NEVER = 1 << 62
#: Adds of which the names are broadcast, so that no other names are met.
FEW = 100_000
ENTRY = ["dataset", "global_id", "oid", "name", "feature_id", "size", "content_type"]
ID = ["dataset", "global_id"]
NAME = ["dataset", "oid", "name"]


@dataclass
class FeedWindow:
    """What a window comes to: one row per edit (dataset, phase, seq, op, global_id, feature_id, name, renamed), and the index after it."""

    results: DataFrame
    index: DataFrame


def moved_since(size: Column, content_type: Column, held_size: Column, held_type: Column) -> Column:
    """Whether what is stated now differs from what is held (J12); null where no size and no type is known on both sides."""
    comparable = (size.isNotNull() & held_size.isNotNull()) | (content_type.isNotNull() & held_type.isNotNull())
    differs = lambda now, held: now.isNotNull() & ~now.eqNullSafe(held)
    return F.when(comparable, differs(size, held_size) | differs(content_type, held_type))


def _hashed(rows: DataFrame) -> DataFrame:
    """rows of one to a key, to be joined by hashing: the many rows that meet them need no sorting, and no key fills a task's memory."""
    return rows.hint("shuffle_hash")


def _by_id(basis: DataFrame, adds: DataFrame, edits: DataFrame) -> DataFrame:
    """The last row held of each id that adds or edits name, with the first add that names it (`taken`; null: only edits do)."""
    named = adds.select(*ID, F.col("seq").alias("taken")).unionByName(edits.select(*ID, F.lit(None).cast("long").alias("taken")))
    named = named.where("global_id is not null").groupBy(*ID).agg(F.min("taken").alias("taken"))
    last = basis.where("global_id is not null").groupBy(*ID).agg(F.max_by(F.struct("pos", *ENTRY[2:]), "pos").alias("row"))
    return stored(last.join(_hashed(named), ID).select(*ID, "taken", "row.*"), "rows-by-id")


def _last_two(basis: DataFrame, taken: DataFrame, adds: DataFrame) -> DataFrame:
    """Per name (where adds are few, of theirs only): when its last row is taken by id, when the last but one is (-1: there is none), and that last row's place."""
    named, asked = (df.where("oid is not null and name is not null") for df in (basis, adds))
    if asked.count() <= FEW:
        named = named.join(F.broadcast(asked.select(*NAME).distinct()), NAME, "left_semi")
    rows = named.select(*NAME, "pos").join(taken.select("dataset", "pos", "taken"), ["dataset", "pos"], "left")
    rows = rows.withColumn("taken", F.coalesce("taken", F.lit(NEVER)))
    # a task passes on two rows of a name at most, however many it has
    two = rows.withColumn("nth", F.row_number().over(Window.partitionBy(*NAME).orderBy(F.desc("taken"), F.desc("pos")))).where("nth <= 2")
    pick = lambda n, c: F.max(F.when(F.col("nth") == n, F.col(c)))
    return two.groupBy(*NAME).agg(pick(1, "taken").alias("last"), F.coalesce(pick(2, "taken"), F.lit(-1)).alias("last_but_one"), pick(1, "pos").alias("pos"))


def _reached(start: DataFrame, steps: DataFrame) -> DataFrame:
    """start (dataset, seq) and all that steps (dataset, seq, next) lead to from there, in as many rounds as the longest way has bits."""
    reached, steps = start, stored(steps, "steps")
    while not steps.isEmpty():
        onward = reached.join(steps, ["dataset", "seq"]).select("dataset", F.col("next").alias("seq"))
        reached = stored(reached.unionByName(onward).distinct(), "reached")
        further = steps.select("dataset", F.col("seq").alias("next"), F.col("next").alias("then"))
        steps = stored(steps.join(further, ["dataset", "next"]).select("dataset", "seq", F.col("then").alias("next")), "steps")
    return reached


def _paired(basis: DataFrame, ids: DataFrame, adds: DataFrame) -> DataFrame:
    """adds (with a parent) with `held`, the row that each takes (pos and entry), and `refused`."""
    turn, row = ["dataset", "seq"], F.struct("pos", *ENTRY[1:])
    own = ids.where("taken is not null").withColumnRenamed("taken", "seq")
    groups = _last_two(basis, own.withColumnRenamed("seq", "taken"), adds)
    met = adds.select("seq", *NAME).join(_hashed(groups), NAME).withColumn("in_gap", (F.col("seq") > F.col("last_but_one")) & (F.col("seq") < F.col("last")))
    met = met.where("in_gap or seq < last_but_one").select(*turn, "in_gap", "last", "pos")
    met = met.join(_hashed(own.select(*turn, F.lit(True).alias("by_id"))), turn, "left").withColumn("by_id", F.col("by_id").isNotNull())
    met = stored(met, "adds-met")
    losing = met.where(f"in_gap and last < {NEVER}")
    start = losing.where("not by_id").select("dataset", F.col("last").alias("seq")).distinct()
    lost = stored(_reached(start, losing.where("by_id").select(*turn, F.col("last").alias("next"))), "found-taken")
    asking = met.where("not by_id").unionByName(met.where("by_id").join(lost, turn, "left_semi"))
    takers = asking.where("in_gap").groupBy("dataset", "pos").agg(F.min("seq").alias("seq"))
    found = basis.join(takers, ["dataset", "pos"]).select(*turn, row.alias("found"))
    refused = asking.where("not in_gap").select(*turn, F.lit(True).alias("refused"))
    by_name = found.unionByName(refused, allowMissingColumns=True)
    judged = adds.join(_hashed(own.select(*turn, row.alias("own"))), turn, "left").join(_hashed(by_name), turn, "left").join(_hashed(lost.withColumn("lost", F.lit(True))), turn, "left")
    held = F.coalesce(F.when(F.col("lost").isNull(), F.col("own")), F.col("found"))
    return judged.select("seq", *ENTRY, held.alias("held"), F.col("refused").isNotNull().alias("refused"))


def _last_entries(held: DataFrame, entries: DataFrame, columns: list[str]) -> DataFrame:
    """Per id what was written last, else what is held (the last of its id), unless it moved to another id."""
    before = held.where("global_id is not null").select(F.lit(0).alias("rank"), F.col("pos").alias("turn"), *ID, *columns)
    moved = entries.where("stale is not null").select(F.lit(1).alias("rank"), "dataset", F.col("stale").alias("global_id"))
    written = entries.where("global_id is not null").select(F.lit(2).alias("rank"), F.col("seq").alias("turn"), *ID, *columns)
    rows = before.unionByName(moved, allowMissingColumns=True).unionByName(written)
    last = rows.groupBy(*ID).agg(F.max_by(F.struct("rank", *columns), F.struct("rank", "turn")).alias("row"))
    return last.where("row.rank <> 1").select(*ID, *[f"row.{c}" for c in columns])


def attachment_feed(basis: DataFrame, adds: DataFrame, updates: DataFrame, deletes: DataFrame, without_ids: DataFrame | None = None) -> FeedWindow:
    """What a window of attachment edits comes to, and the index that it leaves.

    basis: dataset, pos (order), global_id, oid, name, feature_id, size, content_type; of rows with an equal global id the last is
    the one that the id means. adds: dataset, seq (order, one number per edit of a dataset), global_id, oid and feature_id of the parent (null: unknown), name, size,
    content_type. updates: dataset, seq, global_id, name, size, content_type. deletes: dataset, seq, global_id. without_ids: datasets that
    have no global ids: all their edits are `no_ids`.

    Adds: orphan (no known parent), ambiguous, add, and for those that take a held row repeat (nothing moved), replace, or
    replace_unseen (it cannot be told). Updates see what adds left: replace, no_id or unknown. Deletes see both, and each entry goes
    once: delete or unknown. A replace keeps the name that is held; renamed says that the edit has another.
    The index holds entries with a global id; one that moved to another id leaves no old entry. Edits that
    change nothing leave it as it was. Only held rows whose id or name the window has are paired; the others pass through.
    """
    refuse = lambda df, phase: df.select("dataset", F.lit(phase).alias("phase"), "seq", F.lit("no_ids").alias("op"), "global_id", _none("feature_id"), _none("name"), F.lit(False).alias("renamed"))
    refused = None
    if without_ids is not None:
        gone = without_ids.select("dataset").distinct()
        refused = refuse(adds.join(gone, "dataset", "left_semi"), "adds").unionByName(refuse(updates.join(gone, "dataset", "left_semi"), "updates")).unionByName(refuse(deletes.join(gone, "dataset", "left_semi"), "deletes"))
        adds, updates, deletes = (df.join(gone, "dataset", "left_anti") for df in (adds, updates, deletes))
    whole = basis.select("pos", *ENTRY)
    known = adds.where("feature_id is not null").select("seq", *ENTRY)
    edits = updates.select("dataset", F.lit("updates").alias("phase"), "seq", "global_id", "name").unionByName(deletes.select("dataset", F.lit("deletes").alias("phase"), "seq", "global_id", _none("name")))
    ids = _by_id(whole, known, edits)
    judged = _paired(whole, ids, known).select("*", *[F.col(f"held.{c}").alias(f"held_{c}") for c in ENTRY[1:]]).withColumn("took", F.col("held").isNotNull()).drop("held")
    moved = moved_since(F.col("size"), F.col("content_type"), F.col("held_size"), F.col("held_content_type"))
    op = F.when(F.col("refused"), "ambiguous").when(~F.col("took"), "add").when(moved.isNull(), "replace_unseen").when(moved, "replace").otherwise("repeat")
    judged = stored(judged.withColumn("op", op), "adds")
    said = F.coalesce("name", "global_id", F.lit("unnamed"))
    took, repeat = F.col("took"), F.col("op") == "repeat"
    keep = lambda c: F.when(took, F.col(f"held_{c}")).otherwise(F.col(c))
    name = F.when(took, F.col("held_name")).otherwise(said)
    added = judged.select("dataset", F.lit("adds").alias("phase"), "seq", "op", "global_id", keep("feature_id").alias("feature_id"), name.alias("name"), (took & (said != F.col("held_name"))).alias("renamed"))
    orphans = adds.where("feature_id is null").select("dataset", F.lit("adds").alias("phase"), "seq", F.lit("orphan").alias("op"), "global_id", _none("feature_id"), said.alias("name"), F.lit(False).alias("renamed"))

    entry = judged.where("op <> 'ambiguous'").select(
        "dataset", "seq", F.coalesce("global_id", "held_global_id").alias("global_id"), F.when(repeat, F.coalesce("oid", "held_oid")).otherwise(F.col("oid")).alias("oid"), name.alias("name"),
        keep("feature_id").alias("feature_id"), F.when(repeat, F.col("held_size")).otherwise(F.col("size")).alias("size"), F.when(repeat, F.col("held_content_type")).otherwise(F.col("content_type")).alias("content_type"),
        F.when(F.col("held_global_id") != F.coalesce("global_id", "held_global_id"), F.col("held_global_id")).alias("stale"),
    )

    entries = _last_entries(ids, entry, ["name", "feature_id"]).select(*ID, F.col("name").alias("held_name"), "feature_id", F.lit(True).alias("there"))
    update = F.col("phase") == "updates"
    nth = F.row_number().over(Window.partitionBy(*ID, "phase").orderBy("seq"))
    goes = F.col("there").isNotNull() & (update | (F.col("nth") == 1))
    op = F.when(~goes, "unknown").when(update, "replace").otherwise("delete")
    shown = lambda c: F.when(goes, F.col(c))
    met = edits.where("global_id is not null").join(_hashed(entries), ID, "left").withColumn("nth", nth)
    edited = met.select("dataset", "phase", "seq", op.alias("op"), "global_id", shown("feature_id").alias("feature_id"), shown("held_name").alias("name"), F.coalesce(goes & (F.col("name") != F.col("held_name")), F.lit(False)).alias("renamed"))
    unnamed = edits.where("global_id is null").select("dataset", "phase", "seq", F.when(update, "no_id").otherwise("unknown").alias("op"), "global_id", _none("feature_id"), _none("name"), F.lit(False).alias("renamed"))

    newest = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("seq"))).alias(f"new_{c}")
    fresh = updates.where("global_id is not null").groupBy("dataset", "global_id").agg(newest("size"), newest("content_type"))
    after = _last_entries(whole, entry, ENTRY[2:]).join(deletes.where("global_id is not null").select("dataset", "global_id").distinct(), ["dataset", "global_id"], "left_anti")
    after = after.join(fresh, ["dataset", "global_id"], "left").withColumns({c: F.coalesce(f"new_{c}", c) for c in ("size", "content_type")})
    results = added.unionByName(orphans).unionByName(edited).unionByName(unnamed)
    return FeedWindow(results if refused is None else results.unionByName(refused), after.select(*ENTRY))


def _none(name: str) -> Column:
    return F.lit(None).cast("string").alias(name)
