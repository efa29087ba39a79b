"""Definition XML and catalogues of file databases."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import path_head, root_element

#: What is read of a definition; everything else is passed over.
DEFINITION = (
    "CatalogPath string, FeatureType string, SubtypeFieldName string, DefaultSubtypeCode string, AliasName string,"
    "Subtypes struct<Subtype:array<struct<SubtypeCode:string,SubtypeName:string,FieldInfos:struct<SubtypeFieldInfo:array<struct<FieldName:string,DomainName:string,DefaultValue:string>>>>>>"
)

#: Feature types whose rows are drawn text.
DRAWN = ("esriFTAnnotation", "esriFTDimension")


def definitions(entries: DataFrame, body: str = "definition") -> DataFrame:
    """What the definition of each catalogue entry says (S20, S21): name, root, group, drawn, subtype field, default and subtypes.

    XML that cannot be read says nothing: its columns are null, and the entry keeps its row.
    """
    parsed = entries.withColumn("_d", F.from_xml(F.col(body), F.lit(DEFINITION), {"mode": "PERMISSIVE"}))
    return parsed.select(
        "name",
        root_element(F.col(body)).alias("root"),
        path_head(F.col("_d.CatalogPath")).alias("group_name"),
        F.coalesce(F.col("_d.FeatureType").isin(*DRAWN), F.lit(False)).alias("drawn"),
        F.nullif(F.trim("_d.SubtypeFieldName"), F.lit("")).alias("subtype_field"),
        F.nullif(F.trim("_d.DefaultSubtypeCode"), F.lit("")).alias("default_code"),
        F.col("_d.Subtypes.Subtype").alias("subtypes"),
    )


def subtype_fields(defined: DataFrame) -> DataFrame:
    """name, code, subtype, field, domain and default of every field of every subtype."""
    each = defined.select("name", F.explode("subtypes").alias("s"))
    return each.select("name", F.col("s.SubtypeCode").alias("code"), F.col("s.SubtypeName").alias("subtype"), F.explode("s.FieldInfos.SubtypeFieldInfo").alias("f")).select(
        "name", "code", "subtype", F.col("f.FieldName").alias("field"), F.nullif(F.trim("f.DomainName"), F.lit("")).alias("domain"), F.nullif(F.trim("f.DefaultValue"), F.lit("")).alias("default")
    )


def table_fields(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """The field catalogue of Spark tables (S19): layer, pos, name, type, alias, nullable. Only schemas are read."""
    rows = [(layer, pos, f.name, f.dataType.simpleString(), f.metadata.get("alias"), f.nullable) for layer, df in tables.items() for pos, f in enumerate(df.schema)]
    return spark.createDataFrame(rows, "layer string, pos int, name string, type string, alias string, nullable boolean")


def table_catalogue(fields: DataFrame, uses: DataFrame, counts: DataFrame) -> DataFrame:
    """Tables with their fields and rows (S19): layer, fields (in order: name, type, alias, nullable, domain), n_fields, n_domains, n_rows.

    fields: layer, pos, name, type, alias, nullable. uses: layer, name, domain; counts: layer, n_rows (none: not known). A layer without
    fields has no row; a domain of a field that is not there is passed over.
    """
    named = fields.join(uses.select("layer", "name", "domain"), ["layer", "name"], "left")
    own = F.array_sort(F.collect_list(F.struct("pos", "name", "type", "alias", "nullable", "domain")))
    listed = named.groupBy("layer").agg(own.alias("fields"), F.count("*").alias("n_fields"), F.countDistinct("domain").alias("n_domains"))
    return listed.join(counts.select("layer", "n_rows"), "layer", "left").select("layer", "fields", "n_fields", "n_domains", "n_rows")


def counted_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """layer and n_rows of tables: one aggregate each, in one job, which reads no column where the source keeps counts."""
    each = [df.agg(F.count("*").alias("n_rows")).select(F.lit(layer).alias("layer"), "n_rows") for layer, df in tables.items()]
    return reduce(DataFrame.unionByName, each)
