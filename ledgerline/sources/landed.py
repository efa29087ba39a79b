"""Landed service documents: pages of rows, layer descriptions, change files, attachment listings.

Every schema is stated; nothing is inferred from data. Absent sections and explicit nulls read alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PAGE = "struct<features:array<struct<attributes:variant,geometry:variant>>,exceededTransferLimit:boolean>"
HEAD = "struct<serviceDescription:string,hasVersionedData:boolean,capabilities:string,changeTrackingInfo:struct<layerServerGens:array<struct<id:bigint,serverGen:bigint>>>>"
LAYER = (
    "struct<id:bigint,name:string,type:string,geometryType:string,hasZ:boolean,hasM:boolean,parentLayer:struct<id:bigint>,"
    "extent:struct<spatialReference:struct<wkid:int,latestWkid:int,wkt:string>>,objectIdField:string,globalIdField:string,maxRecordCount:bigint,"
    "hasAttachments:boolean,advancedQueryCapabilities:struct<supportsPagination:boolean,supportsQueryAttachments:boolean>,"
    "fields:array<struct<name:string,type:string,alias:string,nullable:boolean,domain:struct<type:string,name:string,range:array<double>,minValue:double,maxValue:double,codedValues:array<struct<code:string,name:string>>>>>,"
    "subtypeField:string,defaultSubtypeCode:string,subtypes:array<struct<code:string,name:string,domains:map<string,string>>>>"
)
CHANGES = (
    "struct<edits:array<struct<id:bigint,features:struct<adds:array<struct<attributes:variant>>,updates:array<struct<attributes:variant>>,deleteIds:array<string>>,"
    "attachments:struct<adds:array<struct<globalId:string,parentGlobalId:string,name:string,contentType:string,size:bigint>>,updates:array<struct<globalId:string,parentGlobalId:string,name:string,contentType:string,size:bigint>>,deleteIds:array<string>>>>,"
    "layerServerGens:array<struct<id:bigint,serverGen:bigint>>>"
)
LISTING = "struct<attachmentGroups:array<struct<parentObjectId:bigint,attachmentInfos:array<struct<id:bigint,globalId:string,name:string,contentType:string,size:bigint,keywords:string>>>>,attachmentInfos:array<struct<id:bigint,globalId:string,name:string,contentType:string,size:bigint,keywords:string>>>"

#: Pages without rows but with the flag, one after the other, that end a walk.
EMPTY_PAGES = 3


def page_rows(pages: DataFrame, body: str = "body") -> DataFrame:
    """layer, page, pos, attributes and geometry of every row of landed pages (S1). pages: layer, page, body."""
    parsed = pages.select("layer", "page", F.from_json(body, PAGE).alias("p"))
    return parsed.select("layer", "page", F.posexplode("p.features").alias("pos", "row")).select("layer", "page", "pos", "row.attributes", "row.geometry")


def page_completeness(pages: DataFrame) -> DataFrame:
    """layer, complete and reason (S2). pages: layer, page, n_rows, exceeded, can_page.

    A walk ends at the first page without the flag. EMPTY_PAGES flagged pages without rows in a row stop it, as does a
    flag on a layer that cannot page; both are losses, as are pages that end while the flag is still up.
    """
    order = Window.partitionBy("layer").orderBy("page")
    flagged_empty = F.col("exceeded") & (F.col("n_rows") == 0)
    run = F.sum(F.when(flagged_empty, 0).otherwise(1)).over(order)
    numbered = pages.withColumn("_empty", flagged_empty).withColumn("_run", run)
    in_run = F.sum(F.col("_empty").cast("int")).over(Window.partitionBy("layer", "_run").orderBy("page"))
    numbered = numbered.withColumn("_in_run", in_run)
    ends = numbered.groupBy("layer").agg(
        F.min(F.when(~F.col("exceeded"), F.col("page"))).alias("_end"),
        F.min(F.when(F.col("_in_run") >= EMPTY_PAGES, F.col("page"))).alias("_stuck"),
        F.min(F.when(F.col("exceeded") & ~F.col("can_page"), F.col("page"))).alias("_cannot"),
    )
    never = F.lit(1 << 60)
    end, stuck, cannot = (F.coalesce(c, never) for c in ("_end", "_stuck", "_cannot"))
    reason = (
        F.when((cannot < end) & (cannot <= stuck), "more rows on a layer that cannot page")
        .when(stuck < end, "empty pages that promise more")
        .when(end == never, "the last page promises more")
    )
    return ends.select("layer", reason.isNull().alias("complete"), reason.alias("reason"))


def service_heads(documents: DataFrame, body: str = "body") -> DataFrame:
    """service, description, versioned, tracked and generations (map of layer to generation) (S3)."""
    head = documents.select("service", F.from_json(body, HEAD).alias("h"))
    words = F.transform(F.split(F.coalesce("h.capabilities", F.lit("")), ","), lambda w: F.trim(w))
    gens = F.coalesce("h.changeTrackingInfo.layerServerGens", F.array().cast("array<struct<id:bigint,serverGen:bigint>>"))
    return head.select(
        "service", F.col("h.serviceDescription").alias("description"), F.coalesce("h.hasVersionedData", F.lit(False)).alias("versioned"), F.array_contains(words, "ChangeTracking").alias("tracked"), F.map_from_entries(gens).alias("generations")
    )


def key_field(declared: Column, fields: Column, kind: str) -> Column:
    """The declared key column, else the first field of that type."""
    return F.coalesce(F.nullif(F.trim(declared), F.lit("")), F.get(F.filter(fields, lambda f: f["type"] == kind), F.lit(0))["name"])


def layers(documents: DataFrame, body: str = "body") -> DataFrame:
    """One row per landed layer description (S4, S5, S6): explicit nulls and blanks equal absent ones."""
    l = documents.select("service", F.from_json(body, LAYER).alias("l"))  # noqa: E741
    blank = lambda c: F.when(F.trim(c) != "", F.col(c))
    kind = F.when(F.col("l.type").contains("Group"), "group").when(F.col("l.type").contains("Raster"), "raster").when(F.col("l.type").contains("Annotation"), "annotation").when(F.col("l.geometryType").isNull() | (F.col("l.geometryType") == "esriGeometryNull"), "table").otherwise("layer")
    reference = "l.extent.spatialReference"
    return l.select(
        "service",
        F.col("l.id").alias("id"),
        blank("l.name").alias("name"),
        kind.alias("kind"),
        F.col("l.parentLayer.id").alias("parent"),
        F.nullif(blank("l.geometryType"), F.lit("esriGeometryNull")).alias("geometry_type"),
        F.coalesce("l.hasZ", F.lit(False)).alias("has_z"),
        F.coalesce("l.hasM", F.lit(False)).alias("has_m"),
        F.coalesce(f"{reference}.latestWkid", f"{reference}.wkid").alias("code"),
        blank(f"{reference}.wkt").alias("wkt"),
        key_field(F.col("l.objectIdField"), F.col("l.fields"), "esriFieldTypeOID").alias("oid_column"),
        key_field(F.col("l.globalIdField"), F.col("l.fields"), "esriFieldTypeGlobalID").alias("global_id_column"),
        F.coalesce("l.maxRecordCount", F.lit(1000)).alias("page_size"),
        F.coalesce("l.hasAttachments", F.lit(False)).alias("has_attachments"),
        F.coalesce("l.advancedQueryCapabilities.supportsPagination", F.lit(False)).alias("can_page"),
        F.col("l.fields").alias("fields"),
        F.col("l.subtypes").alias("subtypes"),
    )


def domains(layer_rows: DataFrame) -> DataFrame:
    """service, id, field, domain, kind, codes, min and max of the coded and range domains of fields (S7); other kinds are passed over."""
    own = layer_rows.select("service", "id", F.explode("fields").alias("f")).select("service", "id", F.col("f.name").alias("field"), F.col("f.domain").alias("d")).where("d is not null")
    kind = F.when(F.col("d.codedValues").isNotNull(), "coded").when(F.col("d.range").isNotNull() | F.col("d.minValue").isNotNull() | F.col("d.maxValue").isNotNull(), "range")
    codes = F.transform("d.codedValues", lambda v: F.struct(v["code"].alias("code"), F.coalesce(v["name"], v["code"]).alias("name")))
    return own.select("service", "id", "field", F.col("d.name").alias("domain"), kind.alias("kind"), codes.alias("codes"), F.coalesce(F.get("d.range", F.lit(0)), "d.minValue").alias("min"), F.coalesce(F.get("d.range", F.lit(1)), "d.maxValue").alias("max")).where("kind is not null")


def subtype_domains(layer_rows: DataFrame) -> DataFrame:
    """service, id, code, field and domain (JSON) of subtypes (S8); markers that say inherited are passed over."""
    own = layer_rows.select("service", "id", F.explode("subtypes").alias("s"))
    return own.select("service", "id", F.col("s.code").alias("code"), F.explode("s.domains").alias("field", "domain")).where(F.get_json_object("domain", "$.type") != "inherited")


def changes(files: DataFrame, key: str, body: str = "body") -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """touched (layer, key), deleted (layer, key), attachment edits and generations of landed change files."""
    parsed = files.select(F.from_json(body, CHANGES).alias("c"))
    edits = parsed.select(F.explode("c.edits").alias("e")).select(F.col("e.id").alias("layer"), "e.features", "e.attachments")
    ids = lambda section: edits.select("layer", F.explode(f"features.{section}").alias("r")).select("layer", F.try_variant_get("r.attributes", f"$.{key}", "bigint").alias("key"))
    touched = ids("adds").unionByName(ids("updates")).where("key is not null").distinct()
    deleted = edits.select("layer", F.explode("features.deleteIds").alias("key")).select("layer", F.expr("try_cast(key as bigint)").alias("key")).distinct()
    records = lambda section: edits.select("layer", F.lit(section).alias("phase"), F.explode(f"attachments.{section}").alias("a")).select("layer", "phase", "a.*")
    gone = edits.select("layer", F.lit("deletes").alias("phase"), F.explode("attachments.deleteIds").alias("globalId"))
    attachments = records("adds").unionByName(records("updates")).unionByName(gone, allowMissingColumns=True)
    return touched, deleted, attachments, parsed.select(F.explode("c.layerServerGens").alias("g")).select(F.col("g.id").alias("layer"), F.col("g.serverGen").alias("generation"))


def attachment_listing(documents: DataFrame, body: str = "body") -> DataFrame:
    """oid and the facts of every attachment (S15), from grouped listings or from one listing per parent (column parent)."""
    parsed = documents.select("parent", F.from_json(body, LISTING).alias("l"))
    grouped = parsed.select(F.explode("l.attachmentGroups").alias("g")).select(F.col("g.parentObjectId").alias("oid"), F.explode("g.attachmentInfos").alias("a"))
    single = parsed.select(F.col("parent").alias("oid"), F.explode("l.attachmentInfos").alias("a"))
    return grouped.unionByName(single).select("oid", F.col("a.id").alias("number"), F.col("a.globalId").alias("global_id"), F.col("a.name").alias("name"), F.col("a.contentType").alias("content_type"), F.col("a.size").alias("size"), F.col("a.keywords").alias("keywords"))


def portal_items(listings: DataFrame, kind: str, owner: str | None = None, body: str = "body") -> DataFrame:
    """url, title and owner of landed portal listings (S16): rows without a url are passed over."""
    rows = listings.select(F.explode(F.from_json(body, "struct<results:array<struct<url:string,title:string,owner:string,type:string>>>")["results"]).alias("r")).select("r.*")
    rows = rows.where(F.col("url").isNotNull() & (F.col("type") == kind))
    return rows.where(F.col("owner") == owner) if owner else rows


def scoped(layer_rows: DataFrame, url: str) -> DataFrame:
    """The layers that a service url names (S22): one, if it ends in an id, else all. An unknown id is an error."""
    last = url.rstrip("/").rsplit("/", 1)[-1]
    if not last.isdigit():
        return layer_rows
    own = layer_rows.where(F.col("id") == int(last))
    if own.isEmpty():
        raise ValueError(f"no layer {last}")
    return own


def at_version(rows: DataFrame, version: str) -> DataFrame:
    """The rows of a named version (S23); an unknown name is an error."""
    own = rows.where(F.col("version") == version)
    if own.isEmpty():
        raise ValueError(f"no version {version}")
    return own


def pinned(version: str, rows: DataFrame, attachments: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows, attachments and counts per layer of one version (S23): the same filter holds for all three."""
    own = at_version(rows, version)
    return own, attachments.where(F.col("version") == version), own.groupBy("layer").agg(F.count("*").alias("n"))


def layer_flags(documents: DataFrame, body: str = "body") -> DataFrame:
    """service, id, has_style, has_time and can_edit out of raw layer descriptions (F16); what is absent or null is not there."""
    there = lambda path: F.coalesce(F.get_json_object(body, path), F.lit("null")) != "null"
    words = F.transform(F.split(F.coalesce(F.get_json_object(body, "$.capabilities"), F.lit("")), ","), lambda w: F.trim(w))
    return documents.select(
        "service", F.get_json_object(body, "$.id").cast("long").alias("id"), there("$.drawingInfo.renderer").alias("has_style"), there("$.timeInfo").alias("has_time"), F.arrays_overlap(words, F.array(F.lit("Editing"), F.lit("Update"))).alias("can_edit")
    )


def page_plan(layer_rows: DataFrame) -> DataFrame:
    """layer, page, offset, rows, order_by and loss of the requests that read each layer (O1, O2).

    layer_rows: layer, n, page_size, oid_column. A page holds page_size rows at most (1000 where none is stated), in order of
    the object id; without one the order is not stable, which is a loss. A layer without rows has one empty page.
    """
    size = F.coalesce(F.when(F.col("page_size") > 0, F.col("page_size")), F.lit(1000)).cast("long")
    pages = F.greatest(F.ceil(F.col("n") / size), F.lit(1))
    each = layer_rows.withColumn("_size", size).withColumn("page", F.explode(F.sequence(F.lit(0).cast("long"), pages - 1)))
    first = F.col("page") * F.col("_size")
    loss = F.when(F.col("oid_column").isNull(), "rows without an object id come in no stable order")
    return each.select("layer", "page", first.alias("offset"), F.least("_size", F.col("n") - first).alias("rows"), F.col("oid_column").alias("order_by"), loss.alias("loss"))
