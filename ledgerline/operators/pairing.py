"""Pairings: relationship ends, parents and attachments, copies and their sources.

What does not pair, or pairs ambiguously, is a row of the result with its reason, never a guess.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def relationship_pairs(ends: DataFrame) -> DataFrame:
    """Origin ends with their destination ends (J4). ends: layer_id, rel_id, name, related_id, role, cardinality, key_field, composite.

    The destination end has the same relationship id and lies on the related layer. An origin end without one keeps nulls.
    """
    origin = ends.where("role = 'origin'")
    destination = ends.where("role = 'destination'").select(F.col("layer_id").alias("related_id"), "rel_id", F.col("key_field").alias("destination_key"), F.col("name").alias("destination_name"))
    return origin.join(destination, ["related_id", "rel_id"], "left").select("rel_id", "name", F.col("layer_id").alias("origin_id"), "related_id", "cardinality", F.col("key_field").alias("origin_key"), "destination_key", "destination_name", "composite")


#: Cardinalities that relationship classes can have at the target.
CARRIED_CARDINALITIES = ("one to one", "one to many")


def resolve_relationships(pairs: DataFrame, datasets: DataFrame) -> DataFrame:
    """Relationship classes by dataset name, or the reason that one cannot be made (J5, J21). datasets: layer_id, dataset."""
    side = lambda column, name: datasets.select(F.col("layer_id").alias(column), F.col("dataset").alias(name))
    named = pairs.join(side("origin_id", "origin"), "origin_id", "left").join(side("related_id", "destination"), "related_id", "left")
    reason = (
        F.when(F.col("origin").isNull(), "origin is not extracted")
        .when(F.col("destination").isNull(), "destination is not extracted")
        .when(~F.col("cardinality").isin(*CARRIED_CARDINALITIES), F.concat(F.lit("cannot be "), F.col("cardinality")))
        .when(F.col("destination_key").isNull(), "no key on the destination")
    )
    return named.select("rel_id", "name", "origin", "destination", F.col("destination_key").alias("key_field"), "cardinality", reason.alias("reason"))


def forward_relationships(relationships: DataFrame) -> DataFrame:
    """Relationships of a file database with many-to-one turned around: sides, keys and labels change places."""
    turned = F.col("cardinality") == "many to one"
    swap = lambda a, b: F.when(turned, F.col(b)).otherwise(F.col(a)).alias(a)
    both = [("origin", "destination"), ("origin_key", "destination_key"), ("forward_label", "backward_label")]
    columns = [c for a, b in both for c in (swap(a, b), swap(b, a))]
    return relationships.select("name", *columns, F.when(turned, "one to many").otherwise(F.col("cardinality")).alias("cardinality"))


def with_parents(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> tuple[DataFrame, DataFrame]:
    """Children that have a parent, and orphans (J7, J16). A null key is an orphan's."""
    known = parents.select(F.col(parent_key).alias("_parent")).distinct()
    on = children[child_key] == known["_parent"]
    return children.join(known, on, "left_semi"), children.join(known, on, "left_anti")


def orphan_blob_tables(tables: DataFrame, relationships: DataFrame) -> DataFrame:
    """Attachment tables that no media relationship points at."""
    media = relationships.where("is_media").select(F.col("destination").alias("name")).distinct()
    return tables.where("role = 'attachments'").join(media, "name", "left_anti")


def moved(a_size: Column, b_size: Column, a_type: Column, b_type: Column) -> Column:
    """Whether two states of an attachment differ (J12): null where neither sizes nor types can be compared."""
    sizes, types = a_size.isNotNull() & b_size.isNotNull(), a_type.isNotNull() & b_type.isNotNull()
    return F.when(sizes | types, (sizes & (a_size != b_size)) | (types & (a_type != b_type)))


def attachment_diff(basis: DataFrame, listed: DataFrame, parents: DataFrame) -> DataFrame:
    """What happened to attachments between two listings (J10): oid, name, global_id, op.

    basis and listed: pos (order of arrival), oid, name, global_id, size, content_type. parents: oid of the rows there are now.
    Stage 1 pairs by global id (of equal ones the last to arrive counts), stage 2 the rest by (oid, name): one on each side
    pairs, rows on one side only are adds or deletes, anything else is ambiguous. Unnamed rows that stage 1 does not
    pair are refused, as are adds to unknown parents (orphan). Pairs are replace where size or type moved, incomparable
    where they cannot be told, else unchanged.
    """
    rank = lambda df: df.withColumn("_n", F.row_number().over(Window.partitionBy("global_id").orderBy(F.desc("pos"))))
    keyed = lambda df: rank(df.where("global_id is not null")).where("_n = 1").drop("_n")
    old, new = keyed(basis).alias("old"), keyed(listed).alias("new")
    state = moved(F.col("old.size"), F.col("new.size"), F.col("old.content_type"), F.col("new.content_type"))
    verdict = F.when(state.isNull(), "incomparable").when(state, "replace").otherwise("unchanged")
    by_id = old.join(new, F.col("old.global_id") == F.col("new.global_id"))
    paired = by_id.select(F.col("new.oid").alias("oid"), F.col("new.name").alias("name"), F.col("new.global_id").alias("global_id"), verdict.alias("op"))
    ids = paired.select("global_id")
    rest = lambda df: df.join(ids, "global_id", "left_anti")
    old_rest, new_rest = rest(basis), rest(listed)
    refused = old_rest.where("name is null or oid is null").select("oid", "name", "global_id", F.lit("refused").alias("op")).unionByName(
        new_rest.where("name is null or oid is null").select("oid", "name", "global_id", F.lit("refused").alias("op"))
    )
    side = lambda df, p: df.where("name is not null and oid is not null").groupBy("oid", "name").agg(F.count("*").alias(f"{p}_n"), F.min("size").alias(f"{p}_size"), F.min("content_type").alias(f"{p}_type"), F.min("global_id").alias(f"{p}_id"))
    groups = side(old_rest, "old").join(side(new_rest, "new"), ["oid", "name"], "full_outer")
    known = parents.select("oid", F.lit(True).alias("_known")).distinct()
    groups = groups.join(known, "oid", "left")
    state = moved(F.col("old_size"), F.col("new_size"), F.col("old_type"), F.col("new_type"))
    op = (
        F.when(F.col("old_n").isNull() & F.col("_known").isNull(), "orphan")
        .when(F.col("old_n").isNull(), "add")
        .when(F.col("new_n").isNull(), "delete")
        .when((F.col("old_n") > 1) | (F.col("new_n") > 1), "ambiguous")
        .when(state.isNull(), "incomparable")
        .when(state, "replace")
        .otherwise("unchanged")
    )
    fallback = groups.select("oid", "name", F.coalesce("new_id", "old_id").alias("global_id"), op.alias("op"))
    return paired.unionByName(fallback).unionByName(refused)


def loaded_copies(ops: DataFrame, loaded: DataFrame) -> DataFrame:
    """Operations with the number of loaded copies they can mean (J23): none, one or many by (feature_id, name)."""
    held = loaded.groupBy("feature_id", "name").agg(F.count("*").alias("_n"))
    return ops.join(held, ["feature_id", "name"], "left").withColumn("copies", F.when(F.col("_n").isNull(), "none").when(F.col("_n") == 1, "one").otherwise("many")).drop("_n")


def apply_attachments(loaded: DataFrame, ops: DataFrame) -> DataFrame:
    """Attachments after replaces, deletes and adds (T8): a replace is a delete and an add, and both need exactly one copy.

    loaded: feature_id, name, payload. ops: op, feature_id, name, payload. Ambiguous and missing copies change nothing.
    """
    matched = loaded_copies(ops.where("op in ('replace', 'delete')"), loaded).where("copies = 'one'")
    kept = loaded.join(matched.select("feature_id", "name").distinct(), ["feature_id", "name"], "left_anti").select("feature_id", "name", "payload")
    return kept.unionByName(matched.where("op = 'replace'").select("feature_id", "name", "payload")).unionByName(ops.where("op = 'add'").select("feature_id", "name", "payload"))


def roll_attachment_index(index: DataFrame, results: DataFrame) -> DataFrame:
    """The attachment index after a window (T9): written entries win, deleted ones go, ids that moved leave no old key.

    index: global_id, feature_id, name, size, content_type. results: the same and op and previous_id (null unless it moved).
    """
    stale = results.where("previous_id is not null").select(F.col("previous_id").alias("global_id")).unionByName(results.select("global_id")).distinct()
    columns = ["global_id", "feature_id", "name", "size", "content_type"]
    return index.select(*columns).join(stale, "global_id", "left_anti").unionByName(results.where("op <> 'delete'").select(*columns))


def reconcile_names(expected: DataFrame, exported: DataFrame) -> DataFrame:
    """Which exported name each expected one has (J13): name, exported, state.

    An equal name matches. One expected name and one exported name left over match each other; in any other case what is
    left over is ambiguous, or missing where nothing is left to take.
    """
    names, there = expected.select("name").distinct(), exported.select(F.col("name").alias("exported")).distinct()
    exact = names.join(there, F.col("name") == F.col("exported"), "left")
    unmatched = exact.where("exported is null").select("name")
    unclaimed = there.join(names, F.col("name") == F.col("exported"), "left_anti")
    left = unclaimed.agg(F.count("*").alias("_free"), F.min("exported").alias("_only"))
    open_names = unmatched.agg(F.count("*").alias("_open"))
    fallback = unmatched.join(F.broadcast(left.crossJoin(open_names)), F.lit(True))  # one row of counts
    sole = (F.col("_free") == 1) & (F.col("_open") == 1)
    state = F.when(sole, "renamed").when(F.col("_free") == 0, "missing").otherwise("ambiguous")
    return exact.where("exported is not null").select("name", "exported", F.lit("exact").alias("state")).unionByName(
        fallback.select("name", F.when(sole, F.col("_only")).alias("exported"), state.alias("state"))
    )


def dropped_fields(source: DataFrame, copy: DataFrame) -> DataFrame:
    """Fields of the source that the copy does not have (J14): dataset, field."""
    return source.select("dataset", "field").join(copy.select("dataset", "field"), ["dataset", "field"], "left_anti")


def row_count_audit(source: DataFrame, copy: DataFrame) -> DataFrame:
    """Datasets whose copy has another number of rows (J15). Both: dataset, n."""
    both = source.select("dataset", F.col("n").alias("source_rows")).join(copy.select("dataset", F.col("n").alias("copy_rows")), "dataset", "full_outer")
    return both.where(~F.col("source_rows").eqNullSafe(F.col("copy_rows")))


def place_items(items: DataFrame, placements: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Items with their placements, each consumed once (J18, W2): equal items take equal placements in order."""
    window = Window.partitionBy(*keys).orderBy(order)
    numbered = lambda df: df.withColumn("_ordinal", F.row_number().over(window))
    taken = numbered(placements).drop(order)
    return numbered(items).join(taken, [*keys, "_ordinal"], "left").drop("_ordinal")


def original_geometry(rows: DataFrame, originals: DataFrame, key: str) -> DataFrame:
    """Rows with the untransformed geometry of their key (J3); missing says that a shape has no original."""
    own = originals.select(F.col(key), F.col("geometry").alias("native_geometry"))
    return rows.join(own, key, "left").withColumn("missing", F.col("geometry").isNotNull() & F.col("native_geometry").isNull())


def domain_ids(assignments: DataFrame, domains: DataFrame) -> DataFrame:
    """Subtype fields with the id of their domain (J20): dataset, code, field, domain, domain_id; unknown ones raise when read."""
    known = domains.select("dataset", "domain", F.col("domain_id").alias("_id"))
    both = assignments.join(known, ["dataset", "domain"], "left")
    check = F.when(F.col("_id").isNull(), F.raise_error(F.concat(F.lit("unknown domain "), F.col("domain"))).cast("long")).otherwise(F.col("_id"))
    return both.select("dataset", "code", "field", "domain", check.alias("domain_id"))


def relationship_ids(relationships: DataFrame, datasets: DataFrame) -> DataFrame:
    """name, origin_id and destination_id of relationships by the names of their datasets (J21); an unknown dataset raises when read."""
    side = lambda column: datasets.select(F.col("dataset").alias(column), F.col("dataset_id").alias(f"{column}_id"))
    both = relationships.join(side("origin"), "origin", "left").join(side("destination"), "destination", "left")
    known = lambda c: F.when(F.col(f"{c}_id").isNull(), F.raise_error(F.concat(F.lit("unknown dataset "), F.col(c))).cast("long")).otherwise(F.col(f"{c}_id")).alias(f"{c}_id")
    return both.select("name", known("origin"), known("destination"))


def missing_targets(datasets: DataFrame, branches: DataFrame) -> DataFrame:
    """dataset and reason for every dataset of an increment that the target cannot take (J22). branches: dataset, branch."""
    there = branches.groupBy("dataset").agg(F.bool_or(F.col("branch") == "main").alias("_main"))
    both = datasets.select("dataset").distinct().join(there, "dataset", "left")
    reason = F.when(F.col("_main").isNull(), "no such dataset").when(~F.col("_main"), "no main branch")
    return both.select("dataset", reason.alias("reason")).where("reason is not null")


def parents_by_global_id(adds: DataFrame, in_window: DataFrame, current: DataFrame) -> DataFrame:
    """adds with the oid of their parent (J16): from the rows of the window, else from the table, else none.

    adds: parent_global_id and others; in_window, current: global_id, oid. Only the table's rows that are asked for move.
    """
    asked = adds.select(F.col("parent_global_id").alias("global_id")).where("global_id is not null").distinct()
    own = lambda df, name: df.join(asked, "global_id", "left_semi").groupBy("global_id").agg(F.min("oid").alias(name))
    known = own(in_window, "_near").join(own(current, "_far"), "global_id", "full_outer").select(F.col("global_id").alias("parent_global_id"), F.coalesce("_near", "_far").alias("oid"))
    return adds.join(known, "parent_global_id", "left")


def blob_features(blobs: DataFrame, media: DataFrame, features: DataFrame) -> DataFrame:
    """Rows of blob tables as attachments of features (J8): table, row, name, dataset, feature_id and state.

    blobs: table, row, parent, name, data. media: destination (a blob table), dataset. features: dataset, key, feature_id.
    state is kept, empty (no bytes) or unresolved (no media relationship, or no such feature). An unnamed blob is called by its
    table and row.
    """
    led = media.select(F.col("destination").alias("table"), "dataset")
    own = features.select("dataset", F.col("key").alias("parent"), "feature_id")
    both = blobs.join(led, "table", "left").join(own, ["dataset", "parent"], "left")
    name = F.coalesce(F.nullif(F.trim("name"), F.lit("")), F.concat_ws("-", "table", F.col("row").cast("string")))
    state = F.when(F.coalesce(F.octet_length("data"), F.lit(0)) == 0, "empty").when(F.col("feature_id").isNull(), "unresolved").otherwise("kept")
    return both.select("table", "row", name.alias("name"), "dataset", "feature_id", state.alias("state"))
