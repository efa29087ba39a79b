"""Forests of containers by pointer doubling (R1, R2): as many joins as the depth has bits, and no limit of levels.

Each round every open node takes over what the node that it points at knows, so pointers reach twice as far. A round
joins the open nodes only, and stores its result, so no plan grows with the rounds. In a forest each round
closes some node; where one closes none, what is open runs in cycles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored

CYCLE, LOST = "in or below a cycle", "below a parent that is not there"


def depths(nodes: DataFrame) -> DataFrame:
    """id, depth (1: a root) and reason (null: a root reaches it) of all nodes. nodes: id (unique), parent."""
    open_nodes = stored(nodes.select("id", F.col("parent").alias("up"), F.lit(1).alias("depth")), "nodes")
    closed = open_nodes.where("up is null").select("id", "depth", F.lit(None).cast("string").alias("reason"))
    known = open_nodes
    left = open_nodes.where("up is not null")
    n = left.count()
    first = True
    while n:
        above = known.select(F.col("id").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"), F.lit(True).alias("there"))
        if not first:  # nodes that are done: a pointer at them ends there
            above = above.unionByName(closed.select(F.col("id").alias("up"), F.lit(None).cast(nodes.schema["parent"].dataType).alias("next"), F.col("depth").alias("more"), F.lit(True).alias("there"), "reason"), allowMissingColumns=True)
        else:
            above = above.withColumn("reason", F.lit(None).cast("string"))
        reason = F.when(F.col("there").isNull(), LOST).otherwise(F.col("reason"))
        now = left.join(above, "up", "left").select("id", F.col("next").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), reason.alias("reason"))
        now = stored(now, "nodes")
        closed = stored(closed.unionByName(now.where("up is null").select("id", "depth", "reason")), "closed-nodes")
        known = left = now.where("up is not null").select("id", "up", "depth")
        before, n, first = n, left.count(), False
        if n == before:
            break
    return closed.unionByName(left.select("id", F.lit(None).cast("int").alias("depth"), F.lit(CYCLE).alias("reason"))).withColumn("depth", F.when(F.col("reason").isNull(), F.col("depth")))


def container_paths(nodes: DataFrame) -> DataFrame:
    """id, depth, path, such as A[x]/B[y], and reason of every node of a forest (R1, A21). nodes: id, parent, element, name.

    Nodes that no root reaches have a reason in place of depth and path. The paths are the result's own size: a chain of n nodes has
    n paths of up to n names.
    """
    found = stored(depths(nodes), "depths")
    label = F.concat(F.col("element"), F.lit("["), F.coalesce("name", F.lit("")), F.lit("]"))
    reached = nodes.join(found.where("reason is null").select("id"), "id", "left_semi")
    paths = stored(reached.select("id", F.col("parent").alias("up"), label.alias("path")), "paths")
    while not paths.where("up is not null").isEmpty():
        above = paths.select(F.col("id").alias("up"), F.col("up").alias("next"), F.col("path").alias("above"))
        longer = paths.where("up is not null").join(above, "up").select("id", F.col("next").alias("up"), F.concat_ws("/", "above", "path").alias("path"))
        paths = stored(paths.where("up is null").unionByName(longer), "paths")
    return found.join(paths.select("id", "path"), "id", "left").select("id", "depth", "path", "reason")


def ancestors(nodes: DataFrame) -> DataFrame:
    """id and ancestor, a row for each node above each node of a forest without faults. nodes: id, parent."""
    jumps = stored(nodes.where("parent is not null").select("id", F.col("parent").alias("up")), "jumps")
    pairs = jumps.withColumnRenamed("up", "ancestor")
    while True:
        onward = pairs.select(F.col("id").alias("up"), "ancestor")
        more = jumps.join(onward, "up").select("id", "ancestor")
        further = stored(jumps.join(jumps.select(F.col("id").alias("up"), F.col("up").alias("next")), "up").select("id", F.col("next").alias("up")), "jumps")
        if further.isEmpty():
            return pairs.unionByName(more).distinct()
        pairs = stored(pairs.unionByName(more).distinct(), "ancestors")
        jumps = further


def member_lists(layers: DataFrame) -> DataFrame:
    """Every group with all layers below it that are no groups (R2), whatever the groups between: group_id, members, n_members, reason.

    layers: id, parent, kind, pos, name. Members come in order of position; a group without any has an empty list, one that no root
    group reaches has a reason in place of a list.
    """
    groups = stored(layers.where("kind = 'group'").select("id", "parent"), "groups")
    found = stored(depths(groups), "depths")
    sound = groups.join(found.where("reason is null").select("id"), "id", "left_semi")
    held = ancestors(sound).select(F.col("id").alias("parent"), F.col("ancestor").alias("group_id")).unionByName(sound.select(F.col("id").alias("parent"), F.col("id").alias("group_id")))
    leaves = layers.where("kind <> 'group' and parent is not null").select("parent", "pos", "name").join(held, "parent")
    listed = leaves.groupBy("group_id").agg(F.array_sort(F.collect_list(F.struct("pos", "name"))).alias("_m"), F.count("*").alias("n_members"))
    both = found.select(F.col("id").alias("group_id"), "reason").join(listed, "group_id", "left")
    own = lambda column: F.when(F.col("reason").isNull(), column)
    members = F.coalesce(F.array_join(F.transform("_m", lambda m: m["name"]), ", "), F.lit(""))
    return both.select("group_id", own(members).alias("members"), own(F.coalesce("n_members", F.lit(0)).cast("long")).alias("n_members"), "reason")
