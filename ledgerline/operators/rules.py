"""Verdicts by rules that are data: predicates over catalogue rows with what they mean for a move.

A rule is a kind of row, an effect, an SQL condition and an SQL message. A pack is compiled into one
projection per kind: the first unsupported or inapplicable rule that holds decides, else all losses
that hold are listed, and a row without losses is faithful. So an approximated item always has a loss.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pairing import place_items

LOSS, UNSUPPORTED, NOT_APPLICABLE = "loss", "unsupported", "not_applicable"


@dataclass(frozen=True)
class Rule:
    kind: str
    effect: str
    when: str
    message: str


#: What each kind of item becomes at the target.
TARGETS = {
    "layer": "dataset",
    "table": "dataset",
    "field": "schema",
    "domain": "domain",
    "subtype": "subtype",
    "relationship": "relationship",
    "attachments": "attachments",
    "style": "style",
    "metadata": "metadata",
    "document": "metadata",
    "hierarchy": "dataset",
    "container": "dataset",
    "track": "dataset",
    "service": "source",
    "tracking": "source",
    "archive": "source",
    "extended": "schema",
    "style_map": "style",
    "time": "dataset",
    "overlay": "raster",
    "region": "style",
}

#: Hosted services. layer rows: kind, fields (name, type, alias), geometry_type, code, wkt, ...
HOSTED = [
    Rule("group", UNSUPPORTED, "true", "'groups of layers have no counterpart; their layers are kept'"),
    Rule("raster", UNSUPPORTED, "true", "'pixels are not rows'"),
    Rule("annotation", LOSS, "true", "'placed text is kept as shapes without its drawing'"),
    Rule("layer", LOSS, "exists(fields, f -> f.alias is not null and f.alias <> f.name)", "'aliases are kept but never shown'"),
    Rule("layer", LOSS, "exists(fields, f -> f.type like '%Date%' or f.type like '%Time%')", "concat('dates and times become text: ', array_join(transform(filter(fields, f -> f.type like '%Date%' or f.type like '%Time%'), f -> f.name), ', '))"),
    Rule("layer", LOSS, "exists(fields, f -> f.type like '%Blob' or f.type like '%Raster')", "'binary values stay behind'"),
    Rule("layer", LOSS, "geometry_type is not null and code is null and wkt is null", "'no spatial reference is stated'"),
    Rule("layer", LOSS, "geometry_type is not null and code is not null and code <> 4326", "concat('shapes are transformed from ', cast(code as string))"),
    Rule("layer", LOSS, "geometry_type is not null and code is null and wkt is not null", "'shapes are transformed from a custom reference'"),
    Rule("layer", LOSS, "geometry_type is null", "'rows get an empty geometry'"),
    Rule("layer", LOSS, "coalesce(has_attachments, false) and not coalesce(can_list_attachments, false)", "'attachments have to be listed row by row'"),
    Rule("domain", UNSUPPORTED, "kind_of_domain not in ('coded', 'range')", "concat('domains of kind ', kind_of_domain, ' have no counterpart')"),
    Rule("domain", LOSS, "n_bindings > 0 and not in_subtypes", "concat('bound by ', cast(n_bindings as string), ' fields, and bindings outside subtypes are not kept')"),
    Rule("subtype", LOSS, "default_code is not null", "'the default code is not kept'"),
    Rule("subtype", LOSS, "size(domain_names) > 0", "concat('domains are assigned by name and need the ids of loaded ones: ', array_join(array_sort(array_distinct(domain_names)), ', '))"),
    Rule("relationship", UNSUPPORTED, "cardinality = 'many to many'", "'many to many needs a table between'"),
    Rule("relationship", UNSUPPORTED, "destination is null", "'the other side is not here'"),
    Rule("relationship", LOSS, "composite", "'parts do not go with their whole'"),
    Rule("relationship", LOSS, "origin_key is not null", "'the key on the origin side is implied'"),
    Rule("relationship", LOSS, "forward_label is not null or backward_label is not null", "'labels are not kept'"),
    Rule("attachments", LOSS, "keywords > 0", "'keywords are kept as metadata only'"),
    Rule("attachments", LOSS, "n_large > 0", "concat(cast(n_large as string), ' are larger than a request may be')"),
    Rule("metadata", NOT_APPLICABLE, "described is not null and not described", "'nothing is described'"),
    Rule("metadata", LOSS, "true", "'descriptions are kept as one text'"),
    Rule("metadata", LOSS, "n_sections > 0", "concat(cast(n_sections as string), ' other sections of the record have no place')"),
    Rule("versioning", NOT_APPLICABLE, "not coalesce(versioned, false)", "'there are no versions to carry'"),
    Rule("versioning", UNSUPPORTED, "gdb_version is not null", "concat('only version ', gdb_version, ' is read, not the tree that it is in')"),
    Rule("versioning", UNSUPPORTED, "true", "'only the default version is read, not the tree that it is in'"),
    Rule("tracking", NOT_APPLICABLE, "not coalesce(tracked, false)", "'changes are not tracked'"),
    Rule("tracking", LOSS, "true", "'the history of edits stays behind'"),
    Rule("style", NOT_APPLICABLE, "drawn is not null and not drawn", "'nothing says how it is drawn'"),
    Rule("style", LOSS, "true", "'the style is carried as it stands, not drawn'"),
    Rule("time", NOT_APPLICABLE, "timed is not null and not timed", "'there are no time settings'"),
    Rule("time", UNSUPPORTED, "true", "'time settings have no counterpart'"),
    Rule("service", LOSS, "versioned", "'only one version is read'"),
    Rule("service", NOT_APPLICABLE, "n_layers = 0", "'nothing to move'"),
]

#: File databases.
FILE = [
    Rule("table", NOT_APPLICABLE, "role = 'system'", "'a table of the database itself'"),
    Rule("table", LOSS, "exists(fields, f -> f.alias is not null and f.alias <> f.name)", "'aliases are kept but never shown'"),
    Rule("table", LOSS, "exists(fields, f -> f.type in ('Date', 'Time', 'DateTime'))", "'dates and times become text'"),
    Rule("table", LOSS, "exists(fields, f -> f.type = 'Binary')", "'binary values stay behind'"),
    Rule("table", LOSS, "exists(fields, f -> f.type in ('StringList', 'IntegerList', 'RealList'))", "'lists lose the type of their elements'"),
    Rule("table", UNSUPPORTED, "geometry_type is not null and code is null and wkt is null", "'shapes without a reference cannot be placed'"),
    Rule("table", LOSS, "geometry_type is not null and code is not null and code <> 4326", "concat('shapes are transformed from ', cast(code as string))"),
    Rule("table", LOSS, "geometry_type is null", "'rows get an empty geometry'"),
    Rule("domain", UNSUPPORTED, "kind_of_domain = 'glob'", "'patterns have no counterpart'"),
    Rule("domain", LOSS, "description is not null", "'the description is not kept'"),
    Rule("domain", LOSS, "split_policy is not null or merge_policy is not null", "'split and merge policies are not kept'"),
    Rule("domain", LOSS, "not coalesce(min_inclusive, true) or not coalesce(max_inclusive, true)", "'open ends become closed ends'"),
    Rule("domain", LOSS, "abs(coalesce(max_value, 0)) > 9007199254740992 or abs(coalesce(min_value, 0)) > 9007199254740992", "'ends beyond 53 bits are rounded'"),
    Rule("relationship", UNSUPPORTED, "cardinality = 'many to many'", "'many to many needs a table between'"),
    Rule("relationship", UNSUPPORTED, "origin is null or destination is null", "'one side is not here'"),
    Rule("relationship", LOSS, "cardinality = 'many to one'", "'sides are turned around'"),
    Rule("relationship", LOSS, "composite", "'parts do not go with their whole'"),
    Rule("relationship", LOSS, "forward_label is not null or backward_label is not null", "'labels are not kept'"),
    Rule("attachments", UNSUPPORTED, "not has_relationship", "'no relationship leads to these attachments'"),
    Rule("attachments", LOSS, "size(other_columns) > 0", "concat('columns beside the bytes are kept as metadata only: ', array_join(other_columns, ', '))"),
    Rule("attachments", LOSS, "n_large > 0", "concat(cast(n_large as string), ' are larger than a request may be')"),
    Rule("drawn", LOSS, "feature_type is null or feature_type <> 'esriFTDimension'", "'drawn text is kept as shapes'"),
    Rule("drawn", LOSS, "feature_type = 'esriFTDimension'", "'drawn measures are kept as shapes'"),
    Rule("subtype", LOSS, "default_code is not null", "'the default code is not kept'"),
    Rule("subtype", LOSS, "n_defaults > 0", "concat(cast(n_defaults as string), ' default values are not kept')"),
    Rule("metadata", NOT_APPLICABLE, "described is not null and not described", "'nothing is described'"),
    Rule("metadata", LOSS, "true", "'descriptions are kept as one text'"),
    Rule("metadata", LOSS, "n_sections > 0", "concat(cast(n_sections as string), ' other sections of the record have no place')"),
    Rule("group", NOT_APPLICABLE, "n_members = 0", "'the group is empty'"),
    Rule("group", LOSS, "true", "'the group is kept in names only'"),
    Rule("entry", UNSUPPORTED, "true", "'nothing reads this kind of entry'"),
]

#: Markup documents, over the facts that sources/markup_facts.py takes from their elements.
MARKUP = [
    Rule("document", UNSUPPORTED, "problem is not null", "concat('the document cannot be read: ', problem)"),
    Rule("document", LOSS, "described", "'the description is markup for a popup: its text is kept and not shown'"),
    Rule("hierarchy", LOSS, "true", "'nesting is kept as a path on every row: no group can be switched or moved'"),
    Rule("hierarchy", LOSS, "true", "'which folders are open or visible is not kept'"),
    Rule("container", LOSS, "without_shape > 0", "concat(without_shape, ' rows have no shape, and an empty shape means a deletion')"),
    Rule("container", LOSS, "size(hints) > 0", "concat('heights are kept, but nothing lifts or drapes shapes by ', array_join(hints, ', '))"),
    Rule("track", LOSS, "true", "'a track has points and a period only: values and style of its row stay on another row'"),
    Rule("track", LOSS, "true", "'speeds and positions are worked out only where the store has functions for moving points'"),
    Rule("track", LOSS, "multi", "'parts become tracks of their own, and the gaps between them are not stated'"),
    Rule("track", LOSS, "altitude", "'heights of samples are dropped'"),
    Rule("track", LOSS, "angles", "'headings and tilts of samples are dropped'"),
    Rule("track", LOSS, "arrays", "'values a sample have no column'"),
    Rule("track", LOSS, "partial", "'dates without a time become moments, and that they were dates is lost'"),
    Rule("schema", LOSS, "size(narrow) > 0", "concat('declared widths become plain numbers: ', array_join(narrow, ', '))"),
    Rule("schema", LOSS, "display_names > 0", "'display names are carried and not shown'"),
    Rule("style", LOSS, "array_contains(drawn, 'LabelStyle')", "'labels are scaled from a size that is not stated'"),
    Rule("style", LOSS, "remote", "concat('the icon lies on another server: ', icon)"),
    Rule("style", LOSS, "random_colour", "'random colours are picked at drawing and cannot be kept'"),
    Rule("chrome", UNSUPPORTED, "part = 'BalloonStyle'", "'popup templates are content, not symbols'"),
    Rule("chrome", UNSUPPORTED, "part = 'ListStyle'", "'list settings belong to a panel of layers'"),
    Rule("style_map", LOSS, "true", "'only the normal state becomes a symbol'"),
    Rule("style_map", LOSS, "not array_contains(states, 'normal')", "'no state is the normal one, so there is no symbol to begin with'"),
    Rule("time", LOSS, "instants > 0", "'a moment becomes a period that is open at its end'"),
    Rule("time", LOSS, "partial", "'dates without a time become moments, and that they were dates is lost'"),
    Rule("link", UNSUPPORTED, "true", "'what a link leads to is not read'"),
    Rule("overlay", LOSS, "true", "'the image is not fetched, so what it holds is not known'"),
    Rule("overlay", LOSS, "warped", "'an image between four corners needs to be warped'"),
    Rule("overlay", LOSS, "rotated", "'a turned image needs to be sampled again'"),
    Rule("overlay", LOSS, "tinted", "'tints are settings for drawing'"),
    Rule("overlay", LOSS, "stacked", "'the order of drawing is a rule of the viewer'"),
    Rule("screen", UNSUPPORTED, "true", "'what is fixed to the screen is no part of the map'"),
    Rule("region", LOSS, "true", "'levels of detail go by pixels, scales do not: the limits are to be chosen anew'"),
    Rule("region", LOSS, "true", "'that a region has to be in view cannot be said'"),
    Rule("archive", LOSS, "true", "'links to the members are to be written anew'"),
    Rule("element", UNSUPPORTED, "element = 'Model'", "'meshes are no shapes of rows'"),
    Rule("element", UNSUPPORTED, "element = 'PhotoOverlay'", "'images are laid on the ground, not before a camera'"),
    Rule("element", UNSUPPORTED, "element = 'Tour'", "'flights are presentation'"),
    Rule("element", UNSUPPORTED, "element = 'LookAt'", "'viewpoints have no place: maps open on their data'"),
    Rule("element", UNSUPPORTED, "element = 'Camera'", "'cameras have no place: maps open on their data'"),
    Rule("element", UNSUPPORTED, "element = 'NetworkLinkControl'", "'instructions for a live link mean nothing without its server'"),
]


def judge(rows: DataFrame, kind: str, rules: list[Rule], location: str, detail: str) -> DataFrame:
    """The items of one kind (A17): location, kind, detail, outcome, target, losses and reason."""
    own = [r for r in rules if r.kind == kind]
    refused = F.lit(None).cast("struct<outcome:string,reason:string>")
    for rule in reversed([r for r in own if r.effect != LOSS]):
        refused = F.when(F.coalesce(F.expr(rule.when), F.lit(False)), F.struct(F.lit(rule.effect).alias("outcome"), F.expr(rule.message).alias("reason"))).otherwise(refused)
    losses = F.array_compact(F.array(*[F.when(F.coalesce(F.expr(r.when), F.lit(False)), F.expr(r.message)) for r in own if r.effect == LOSS], F.lit(None).cast("string")))
    facts = rows.select(F.expr(location).cast("string").alias("location"), F.expr(detail).cast("string").alias("detail"), refused.alias("_no"), losses.alias("_losses"))
    outcome = F.when(F.col("_no").isNotNull(), F.col("_no.outcome")).when(F.size("_losses") > 0, "approximated").otherwise("faithful")
    return facts.select(
        "location",
        F.lit(kind).alias("kind"),
        "detail",
        outcome.alias("outcome"),
        F.when(F.col("_no").isNull(), F.lit(TARGETS.get(kind))).alias("target"),
        F.when(F.col("_no").isNull(), F.col("_losses")).otherwise(F.array().cast("array<string>")).alias("losses"),
        F.col("_no.reason").alias("reason"),
    )


def judge_all(kinds: dict[str, DataFrame], rules: list[Rule], location: str, detail: str) -> DataFrame:
    """The items of several kinds (V1): every kind's rows by the rules of that kind. Each table has the facts that its kind's rules name."""
    return reduce(DataFrame.unionByName, [judge(rows, kind, rules, location, detail) for kind, rows in kinds.items()])


def require_items(items: DataFrame) -> DataFrame:
    """The same items; an inventory without any is an error, not an empty result."""
    if items.isEmpty():
        raise ValueError("the inventory is empty")
    return items


#: Why an item is skipped where its verdict gives no reason.
LEFT_BEHIND = {
    "domain": "no dataset uses it",
    "relationship": "one of its sides stays behind",
    "attachments": "its rows stay behind",
    "style": "its dataset stays behind",
}


def log_items(items: DataFrame, placements: DataFrame) -> DataFrame:
    """The log of a run (V17, J18, O3): every item once, in order of seq, as its verdict says and never against it.

    items: seq, location, kind, outcome, losses, reason. placements: seq, location, kind, dataset; each serves one item.
    """
    placed = place_items(items, placements.select("seq", "location", "kind", "dataset"), ["location", "kind"], "seq")
    refused = F.col("outcome").isin(UNSUPPORTED, NOT_APPLICABLE)
    default = F.create_map(*[F.lit(x) for pair in LEFT_BEHIND.items() for x in pair])
    state = F.when(refused | F.col("dataset").isNull(), "skipped").when(F.col("outcome") == "approximated", "carried_with_loss").otherwise("carried")
    reason = F.when(refused, F.col("reason")).when(F.col("dataset").isNull(), F.coalesce(F.element_at(default, F.col("kind")), F.lit("it was not placed")))
    return placed.select("seq", "location", "kind", state.alias("state"), F.when(~refused, F.col("dataset")).alias("dataset"), F.when(state == "carried_with_loss", F.array_join("losses", "; ")).alias("loss"), reason.alias("reason"))
