"""Operators over catalogue tables: layers, fields, domains, subtypes."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Source field types, the declared type of each, and what is lost by it.
TYPE_MAP = [
    ("hosted", "esriFieldTypeOID", "integer", None),
    ("hosted", "esriFieldTypeSmallInteger", "integer", None),
    ("hosted", "esriFieldTypeInteger", "integer", None),
    ("hosted", "esriFieldTypeBigInteger", "integer", None),
    ("hosted", "esriFieldTypeSingle", "float", None),
    ("hosted", "esriFieldTypeDouble", "float", None),
    ("hosted", "esriFieldTypeString", "string", None),
    ("hosted", "esriFieldTypeGUID", "string", None),
    ("hosted", "esriFieldTypeGlobalID", "string", None),
    ("hosted", "esriFieldTypeDate", "string", "dates become text"),
    ("hosted", "esriFieldTypeDateOnly", "string", "dates become text"),
    ("hosted", "esriFieldTypeTimeOnly", "string", "times become text"),
    ("hosted", "esriFieldTypeTimestampOffset", "string", "timestamps become text"),
    ("hosted", "esriFieldTypeXML", "string", "markup becomes plain text"),
    ("hosted", "esriFieldTypeBlob", "string", "binary values stay behind"),
    ("hosted", "esriFieldTypeRaster", "string", "raster values stay behind"),
    ("file", "Integer", "integer", None),
    ("file", "Integer64", "integer", None),
    ("file", "Real", "float", None),
    ("file", "String", "string", None),
    ("file", "Date", "string", "dates become text"),
    ("file", "Time", "string", "times become text"),
    ("file", "DateTime", "string", "timestamps become text"),
    ("file", "Binary", "string", "binary values stay behind"),
    ("file", "StringList", "array", "the element type is not declared"),
    ("file", "IntegerList", "array", "the element type is not declared"),
    ("file", "RealList", "array", "the element type is not declared"),
    ("table", "bigint", "integer", None),
    ("table", "int", "integer", None),
    ("table", "smallint", "integer", None),
    ("table", "double", "float", None),
    ("table", "float", "float", None),
    ("table", "string", "string", None),
    ("table", "boolean", "boolean", None),
    ("table", "timestamp_ntz", "string", "timestamps become text"),
    ("table", "date", "string", "dates become text"),
    ("table", "array<float>", "array", "the element type is not declared"),
    ("table", "binary", "string", "binary values stay behind"),
]

#: Field types whose values never enter the properties (P5).
VALUELESS = ("esriFieldTypeGeometry", "esriFieldTypeBlob", "esriFieldTypeRaster", "Binary", "binary")


def declared_types(fields: DataFrame, namespace: str) -> DataFrame:
    """fields with declared and loss (P1, P2); types that are not known become strings with a loss."""
    types = fields.sparkSession.createDataFrame(TYPE_MAP, "namespace string, type string, declared string, loss string").where(F.col("namespace") == namespace).drop("namespace")
    known = types.withColumn("_known", F.lit(True))
    both = fields.join(F.broadcast(known), "type", "left")  # a fixed table
    unknown = F.concat(F.lit("unknown type "), F.coalesce(F.col("type"), F.lit("none")))
    return both.withColumn("loss", F.when(F.col("_known").isNull(), unknown).otherwise(F.col("loss"))).withColumn("declared", F.coalesce("declared", F.lit("string"))).drop("_known")


def schema_rows(fields: DataFrame, namespace: str) -> DataFrame:
    """The declared schema of each layer (P15, P5): layer, pos, name, declared, required, alias."""
    carried = declared_types(fields.where(~F.col("type").isin(*VALUELESS)), namespace)
    alias = F.nullif(F.when(F.trim("alias") != "", F.col("alias")), F.col("name"))
    return carried.select("layer", "pos", "name", "declared", (~F.coalesce(F.col("nullable"), F.lit(True))).alias("required"), alias.alias("alias"))


def row_holding(layers: DataFrame) -> DataFrame:
    """Layers that hold rows (P6): groups and rasters do not."""
    return layers.where(~F.col("kind").isin("group", "raster"))


def reference_class(code: Column, wkt: Column, working: int = 4326, largest_code: int = 33000) -> Column:
    """How a spatial reference can be named (P8): none, working, code, wkt or unstatable."""
    return (
        F.when(code.isNull() & wkt.isNull(), "none")
        .when(code == working, "working")
        .when((code > 0) & (code < largest_code), "code")
        .when(F.trim(wkt) != "", "wkt")
        .otherwise("unstatable")
    )


def projection_plan(code: Column, wkt: Column, has_geometry: Column) -> Column:
    """What becomes of a table's rows (P9): kept as they are, straight, through a transformation, or refused."""
    kind = reference_class(code, wkt)
    return F.when(~has_geometry, "rows only").when(kind == "working", "straight").when(kind.isin("code", "wkt"), "through").otherwise("refused")


def table_role(name: Column) -> Column:
    """system, attachments or user."""
    return F.when(F.startswith(F.upper(name), F.lit("GDB_")), "system").when(F.endswith(F.upper(name), F.lit("__ATTACH")), "attachments").otherwise("user")


def epsg_code(authority: Column, code: Column) -> Column:
    """The code, if EPSG gave it."""
    return F.when(F.upper(authority) == "EPSG", code)


def suffix_duplicates(layers: DataFrame, name: str = "name", key: str = "id", order: str = "pos") -> DataFrame:
    """dataset: the name, with the key behind it from the second layer of a name on."""
    nth = F.row_number().over(Window.partitionBy(name).orderBy(order, key))
    return layers.withColumn("dataset", F.when(nth > 1, F.concat_ws(" ", name, F.col(key).cast("string"))).otherwise(F.col(name)))


def first_domains(domains: DataFrame) -> DataFrame:
    """One definition per (layer, domain), the first by position."""
    return domains.groupBy("layer", "domain").agg(F.min_by(F.struct("kind", "pos"), "pos").alias("_first")).select("layer", "domain", "_first.kind", "_first.pos")


def domain_usage(fields: DataFrame, subtype_fields: DataFrame) -> DataFrame:
    """Who uses each domain, through fields first and then through subtypes, in order of position."""
    users = fields.where("domain is not null").select("domain", F.lit(0).alias("by"), "pos", F.col("name").alias("user"))
    users = users.unionByName(subtype_fields.where("domain is not null").select("domain", F.lit(1).alias("by"), "pos", F.col("name").alias("user")))
    listed = F.array_sort(F.collect_list(F.struct("by", "pos", "user")))
    return users.groupBy("domain").agg(F.array_join(F.transform(listed, lambda u: u["user"]), ", ").alias("users"), F.count("*").alias("n_users"))


def domain_fanout(domains: DataFrame, holders: DataFrame) -> DataFrame:
    """How many datasets hold each domain (A7): nowhere to live, one home, or a copy for each."""
    held = holders.where("domain is not null").groupBy("domain").agg(F.countDistinct("dataset").alias("_n"))
    n = F.coalesce(F.col("_n"), F.lit(0)).cast("long")
    return domains.select("domain").distinct().join(held, "domain", "left").select("domain", n.alias("holders"), F.when(n == 0, "nowhere to live").when(n == 1, "one home").otherwise("separate copies").alias("state"))


def domain_types(domains: DataFrame, fields: DataFrame, subtype_fields: DataFrame) -> DataFrame:
    """The value type of each domain (J25): of the first field that names it, else of the first subtype field, else string."""
    first = lambda df, name: df.where("domain is not null").groupBy("domain").agg(F.min_by("declared", "pos").alias(name))
    both = domains.select("domain").distinct().join(first(fields, "_field"), "domain", "left").join(first(subtype_fields, "_subtype"), "domain", "left")
    return both.select("domain", F.coalesce("_field", "_subtype", F.lit("string")).alias("declared"))


def group_members(layers: DataFrame) -> DataFrame:
    """The direct members of each group (A8, R2), in order of position."""
    listed = F.array_sort(F.collect_list(F.struct("pos", "name")))
    return layers.where("parent is not null").groupBy(F.col("parent").alias("group_id")).agg(F.array_join(F.transform(listed, lambda m: m["name"]), ", ").alias("members"), F.count("*").alias("n_members"))


def uninterpreted(catalogue: DataFrame, inventoried: DataFrame, kinds: list[str]) -> DataFrame:
    """Catalogue entries that nothing reads."""
    return catalogue.where(~F.col("kind").isin(*kinds)).join(inventoried.select("name"), "name", "left_anti")


def in_order(layers: DataFrame, tables: DataFrame) -> DataFrame:
    """Layers first, then tables, each in its own order (U1): the rows of both with seq, from 0. Both: pos and the same columns."""
    both = layers.withColumn("_part", F.lit(0)).unionByName(tables.withColumn("_part", F.lit(1)))
    # one service's layers, as its description lists them
    return both.withColumn("seq", F.row_number().over(Window.partitionBy("service").orderBy("_part", "pos")) - 1).drop("_part")


#: Declared types of the values of a domain, by the type of its field.
DOMAIN_TYPES = {
    "esriFieldTypeSmallInteger": "integer",
    "esriFieldTypeInteger": "integer",
    "esriFieldTypeBigInteger": "integer",
    "esriFieldTypeOID": "integer",
    "esriFieldTypeSingle": "float",
    "esriFieldTypeDouble": "float",
}


def domain_value_type(field_type: Column) -> Column:
    """string, integer or float: what the values of a domain on such a field are (P3); all that is no number is text."""
    known = F.create_map(*[F.lit(x) for pair in DOMAIN_TYPES.items() for x in pair])
    return F.coalesce(F.element_at(known, field_type), F.lit("string"))


#: Kinds of shapes and the type that a table of them is declared with.
SHAPE_NAMES = {
    "esriGeometryPoint": "Point",
    "esriGeometryMultipoint": "MultiPoint",
    "esriGeometryPolyline": "MultiLineString",
    "esriGeometryPolygon": "MultiPolygon",
}


def shape_name(kind: Column, has_z: Column, has_m: Column) -> Column:
    """name and losses of a table's shapes (P10): ordinates beyond x and y and kinds that are not known are losses."""
    known = F.create_map(*[F.lit(x) for pair in SHAPE_NAMES.items() for x in pair])
    name = F.element_at(known, kind)
    return F.struct(
        F.when(kind.isNotNull(), F.coalesce(name, F.lit("Geometry"))).alias("name"),
        F.array_compact(
            F.array(
                F.when(kind.isNotNull() & F.coalesce(has_z, F.lit(False)), "heights are kept in the shapes and not declared"),
                F.when(kind.isNotNull() & F.coalesce(has_m, F.lit(False)), "measures are kept in the shapes and not declared"),
                F.when(kind.isNotNull() & name.isNull(), F.concat(F.lit("shapes of kind "), kind, F.lit(" are not known"))),
            )
        ).alias("losses"),
    )


def delta_plan(datasets: DataFrame, incremental: Column) -> DataFrame:
    """The plan of a run (P16): an increment states no relationships and no style, for its base has them. datasets: relationships, style and others."""
    return datasets.withColumns({"relationships": F.when(~incremental, F.col("relationships")), "style": F.when(~incremental, F.col("style")), "incremental": incremental})


def fitting_values(variant: Column, declared: str) -> Column:
    """A value if it is of its declared type, else null (P4): integers only as integer, any number as float, text as string."""
    kind = F.schema_of_variant(variant)
    if declared == "integer":
        return F.when(kind == "BIGINT", F.try_variant_get(variant, "$", "bigint"))
    if declared == "float":
        return F.when((kind == "BIGINT") | (kind == "DOUBLE") | F.startswith(kind, F.lit("DECIMAL")), F.try_variant_get(variant, "$", "double"))
    if declared == "string":
        return F.when(kind == "STRING", F.try_variant_get(variant, "$", "string"))
    if declared == "boolean":
        return F.when(kind == "BOOLEAN", F.try_variant_get(variant, "$", "boolean"))
    raise ValueError(f"no declared type {declared!r}")


def typed_properties(rows: DataFrame, properties: str, declared: dict[str, str]) -> DataFrame:
    """rows with typed, a JSON object of the declared properties that hold a value of their type; nulls are left out."""
    parsed = F.try_parse_json(F.col(properties))
    fields = [fitting_values(F.try_variant_get(parsed, f"$.{name}", "variant"), kind).alias(name) for name, kind in declared.items()]
    return rows.withColumn("typed", F.to_json(F.struct(*fields)))
