"""What the markup rules ask for, from the elements of documents (V13 to V16, A13): one table of facts per kind of item.

Elements carry their place (seq, in the order of their starts) and the place of the last element inside them, so "inside a track" or
"inside a style" compares two numbers. Elements of one kind of scope do not overlap but by nesting, and the scope
around an element is the last one that began before it, where that has not ended. One sort per document gives all scopes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import has_altitude, is_partial_time
from ..operators import rules
from ..session import stored
from .markup import CONTAINERS

#: Elements that are looked for around others. Of these only tracks nest, in a multi-track.
SCOPES = ("Placemark", "Track", "MultiTrack", "Model", "Style", "StyleMap", "Schema", "NetworkLink", "GroundOverlay")
PLAIN_SHAPES = ("Point", "LineString", "Polygon", "LinearRing", "MultiGeometry")
OWN_ROWS = ("Model", "Track", "MultiTrack")
#: Declared types narrower than a number of the target, parts that dress a viewer, and elements that are counted only.
NARROW = ("int", "uint", "short", "ushort", "float")
CHROME = ("BalloonStyle", "ListStyle")
COUNTED = ("Model", "PhotoOverlay", "Tour", "LookAt", "Camera", "NetworkLinkControl")


def scoped(elements: DataFrame) -> DataFrame:
    """elements with in_<kind> for every scope: the seq of the one that an element lies in (a scope lies in itself), or null."""
    order = Window.partitionBy("doc_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opened = {f"_{k}": F.last(F.when(F.col("element") == k, F.struct("seq", "last")), ignorenulls=True).over(order) for k in SCOPES}
    around = elements.withColumns(opened)
    inside = {f"in_{k}": F.when(F.col("seq") <= F.col(f"_{k}.last"), F.col(f"_{k}.seq")) for k in SCOPES}
    return around.withColumns(inside).drop(*opened)


def _is(*names: str) -> Column:
    return F.col("element").isin(*names)


def _text(condition: Column) -> Column:
    """The text of the first element for which the condition holds."""
    return F.min_by("text", F.when(condition, F.col("seq")))


def _set(value: Column, condition: Column) -> Column:
    return F.array_sort(F.collect_set(F.when(condition, value)))


def _track() -> Column:
    return F.coalesce("in_MultiTrack", "in_Track")


def documents(inside: DataFrame) -> DataFrame:
    """Per document: name, described, folders, deepest, problem."""
    e = F.col("element")
    return inside.groupBy("doc_id").agg(
        _text((e == "name") & (F.col("parent") == "Document")).alias("name"),
        F.coalesce(F.bool_or((e == "description") & (F.col("parent") == "Document")), F.lit(False)).alias("described"),
        F.count_if(e == "Folder").alias("folders"), F.max(F.when(_is(*CONTAINERS), F.col("depth"))).alias("deepest"), F.max("problem").alias("problem"),
    )


def containers(inside: DataFrame) -> DataFrame:
    """Per container with rows of its own: seq, rows, shapes and own_rows (sets), without_shape, hints (set of settings for height)."""
    said = F.coalesce(F.trim("text"), F.lit(""))
    own = F.coalesce("in_Track", "in_MultiTrack", "in_Model").isNotNull()
    hint = ~own & (((F.col("element") == "altitudeMode") & (said != "clampToGround")) | (_is("extrude", "tessellate") & (said != "0")))
    direct = F.col("parent") == "Placemark"
    rows = inside.where("in_Placemark is not null").groupBy("doc_id", F.col("in_Placemark").alias("row")).agg(
        F.max(F.when(_is("Placemark"), F.col("parent_seq"))).alias("seq"),
        _set(F.col("element"), direct & _is(*PLAIN_SHAPES)).alias("shapes"), _set(F.col("element"), direct & _is(*OWN_ROWS)).alias("own_rows"), _set(F.col("element"), hint).alias("hints"),
    )
    every = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))).alias(c)
    bare = (F.size("shapes") == 0) & (F.size("own_rows") == 0)
    return rows.groupBy("doc_id", "seq").agg(F.count("*").alias("rows"), every("shapes"), every("own_rows"), F.count_if(bare).alias("without_shape"), every("hints"))


def tracks(inside: DataFrame) -> DataFrame:
    """Per track (a track inside a multi-track is a part of it): seq, multi, parts, samples, altitude, angles, arrays, partial."""
    said = F.coalesce("text", F.lit(""))
    timed = (F.col("element") == "when") & F.col("in_Track").isNotNull()
    some = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    return inside.where(_track().isNotNull()).groupBy("doc_id", _track().alias("seq")).agg(
        some(F.col("in_MultiTrack").isNotNull()).alias("multi"), F.count_if(_is("Track")).alias("parts"), F.count_if(timed).alias("samples"),
        some((F.col("element") == "coord") & has_altitude(said)).alias("altitude"), some(_is("angles")).alias("angles"), some(_is("SimpleArrayData")).alias("arrays"),
        some(timed & (said != "") & is_partial_time(said)).alias("partial"),
    )


def schemas(inside: DataFrame) -> DataFrame:
    """Per schema: seq, name, fields, narrow (declared types that become wide ones) and display_names."""
    field = F.col("element") == "SimpleField"
    kind = F.element_at("attributes", F.lit("type"))
    own = F.when(_is("Schema"), F.coalesce(F.element_at("attributes", F.lit("name")), F.element_at("attributes", F.lit("id"))))
    return inside.where("in_Schema is not null").groupBy("doc_id", F.col("in_Schema").alias("seq")).agg(
        F.coalesce(F.max(own), F.lit("unnamed")).alias("name"), F.count_if(field).alias("fields"), _set(kind, field & kind.isin(*NARROW)).alias("narrow"), F.count_if(_is("displayName")).alias("display_names")
    )


def extended_data(inside: DataFrame) -> DataFrame:
    """Per document: rows with extended data, distinct keys and schema blocks, outside tracks."""
    outside = inside.where(_track().isNull())
    return outside.groupBy("doc_id").agg(
        F.countDistinct(F.when(_is("ExtendedData"), F.col("in_Placemark"))).alias("rows"), F.countDistinct(F.when(_is("Data"), F.element_at("attributes", F.lit("name")))).alias("keys"), F.count_if(_is("SchemaData")).alias("blocks")
    ).where("rows > 0 or blocks > 0")


def styles(inside: DataFrame) -> DataFrame:
    """Per style: seq, parts (set), icon, remote (the icon lies elsewhere) and random_colour."""
    icon = _text(_is("href") & (F.col("parent") == "Icon"))
    random = F.coalesce(F.bool_or(_is("colorMode") & (F.col("text") == "random")), F.lit(False))
    found = inside.where("in_Style is not null").groupBy("doc_id", F.col("in_Style").alias("seq")).agg(_set(F.col("element"), F.col("parent") == "Style").alias("parts"), icon.alias("icon"), random.alias("random_colour"))
    return found.withColumns({"remote": F.coalesce(F.col("icon").rlike("^https?://"), F.lit(False)), "drawn": F.array_except("parts", F.array(*map(F.lit, CHROME)))})


def style_maps(inside: DataFrame) -> DataFrame:
    """Per style map: seq and states, in order."""
    key = F.when(_is("key") & (F.col("parent") == "Pair"), F.struct("seq", "text"))
    return inside.where("in_StyleMap is not null").groupBy("doc_id", F.col("in_StyleMap").alias("seq")).agg(F.transform(F.array_sort(F.collect_list(key)), lambda k: k["text"]).alias("states"))


def times(inside: DataFrame) -> DataFrame:
    """Per document with times: instants, spans, and partial (a date outside tracks without a time of day)."""
    said = F.coalesce("text", F.lit(""))
    partial = _is("when", "begin", "end") & F.col("in_Track").isNull() & (said != "") & is_partial_time(said)
    found = inside.groupBy("doc_id").agg(F.count_if(_is("TimeStamp")).alias("instants"), F.count_if(_is("TimeSpan")).alias("spans"), F.coalesce(F.bool_or(partial), F.lit(False)).alias("partial"))
    return found.where("instants > 0 or spans > 0")


def links(inside: DataFrame) -> DataFrame:
    """Per network link: seq, name, href and refresh (settings, in order)."""
    setting = F.when(_is("refreshMode", "viewRefreshMode"), F.struct("seq", F.concat_ws("=", "element", "text").alias("s")))
    return inside.where("in_NetworkLink is not null").groupBy("doc_id", F.col("in_NetworkLink").alias("seq")).agg(
        _text(_is("name") & (F.col("parent") == "NetworkLink")).alias("name"), _text(_is("href")).alias("href"), F.transform(F.array_sort(F.collect_list(setting)), lambda s: s["s"]).alias("refresh")
    )


def ground_overlays(inside: DataFrame) -> DataFrame:
    """Per image laid on the ground: seq, name, href, boxed, warped, rotated, tinted, stacked."""
    some = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    mine = F.col("parent") == "GroundOverlay"
    turned = F.coalesce(F.trim("text").try_cast("double") != 0, F.lit(False))
    return inside.where("in_GroundOverlay is not null").groupBy("doc_id", F.col("in_GroundOverlay").alias("seq")).agg(
        _text(_is("name") & mine).alias("name"), _text(_is("href")).alias("href"), some(_is("LatLonBox")).alias("boxed"), some(_is("LatLonQuad")).alias("warped"), some(_is("rotation") & turned).alias("rotated"),
        some(_is("color") & mine).alias("tinted"), some(_is("drawOrder")).alias("stacked"),
    )


def counted(inside: DataFrame) -> DataFrame:
    """Per document and element that is only counted: element and n; and the same of screen overlays."""
    return inside.where(_is(*COUNTED, "ScreenOverlay")).groupBy("doc_id", "element").agg(F.count("*").alias("n"))


def regions(inside: DataFrame) -> DataFrame:
    """Per document with regions: regions and levels of detail."""
    return inside.groupBy("doc_id").agg(F.count_if(_is("Region")).alias("regions"), F.count_if(_is("Lod")).alias("lods")).where("regions > 0")


def items(elements: DataFrame, archives: DataFrame | None = None) -> DataFrame:
    """All judged items of documents (A17, V13 to V16): location, kind, detail, outcome, target, losses, reason.

    The elements are sorted into their scopes and stored once; each kind of item is a grouped read of that table. archives: doc_id, others, bytes of members beside the document.
    A location is a document, or a document and the place of an element in it.
    """
    inside = stored(scoped(elements), "scoped-elements")
    style = styles(inside)
    counts = counted(inside)
    kinds = {
        "document": documents(inside).where("name is not null or described or problem is not null"), "hierarchy": documents(inside).where("folders > 0"), "container": containers(inside), "track": tracks(inside),
        "schema": schemas(inside), "extended": extended_data(inside), "style": style.where(F.size("drawn") > 0), "chrome": style.select("doc_id", "seq", F.explode(F.array_intersect("parts", F.array(*map(F.lit, CHROME)))).alias("part")),
        "style_map": style_maps(inside), "time": times(inside), "link": links(inside), "overlay": ground_overlays(inside), "screen": counts.where("element = 'ScreenOverlay'"), "region": regions(inside), "element": counts.where("element <> 'ScreenOverlay'"),
    }
    if archives is not None:
        kinds["archive"] = archives.where("others > 0")
    detail = {
        "document": "coalesce(name, problem, 'a description')", "hierarchy": "concat(folders, ' folders, ', greatest(deepest - 1, 1), ' deep')",
        "container": "concat(rows, ' rows', if(size(shapes) > 0, concat(' of ', array_join(shapes, ', ')), ''), if(size(own_rows) > 0, concat(', ', array_join(own_rows, ', '), ' apart'), ''))",
        "track": "concat(if(multi, concat(parts, ' parts, '), ''), samples, ' samples')", "schema": "concat(name, ', ', fields, ' fields')", "extended": "concat(rows, ' rows, ', keys, ' keys, ', blocks, ' blocks')",
        "style": "concat(array_join(drawn, ', '), coalesce(concat('; icon ', icon), ''))", "chrome": "part", "style_map": "array_join(states, ', ')", "time": "concat(instants, ' instants, ', spans, ' spans')",
        "link": "concat(coalesce(name, 'unnamed'), ' to ', coalesce(href, 'nowhere'), if(size(refresh) > 0, concat(' (', array_join(refresh, ', '), ')'), ''))",
        "overlay": "concat(coalesce(name, 'unnamed'), ' shows ', coalesce(href, 'nothing'), if(boxed, ', in a box', ''), if(warped, ', in a quadrangle', ''))",
        "screen": "concat(n, ' on the screen')", "region": "concat(regions, ' regions, ', lods, ' with levels')", "element": "concat(n, ' ', element)", "archive": "concat(others, ' members, ', bytes, ' bytes')",
    }
    judged = [rules.judge(rows, kind, rules.MARKUP, "concat_ws('#', doc_id, seq)" if "seq" in rows.columns else "cast(doc_id as string)", detail[kind]) for kind, rows in kinds.items()]
    whole = judged[0]
    for more in judged[1:]:
        whole = whole.unionByName(more)
    return whole
