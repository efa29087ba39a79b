"""Queries over written and read records: logs, indexes, manifests, cursors, definitions, plans. What is written goes to the shared folder and is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import runs
from ..functions import text
from ..operators import catalog, forest, ordering, pairing, tally
from ..session import own_place, table
from ..sources import definitions, landed, logs, sinks, windows
from .base import derive, plain, query


@query("domain_parse", """
SELECT p_partkey AS id, p_name AS field, p_type AS domain, CASE WHEN p_size % 4 = 0 THEN 'coded' ELSE 'range' END AS kind, CASE WHEN p_size % 4 = 0 THEN '1=one, 2=2' END AS codes,
  CASE p_size % 4 WHEN 1 THEN CAST(p_size AS DOUBLE) WHEN 2 THEN 0.5 END AS min, CASE p_size % 4 WHEN 1 THEN p_size + 1.0 WHEN 2 THEN 1.5 END AS max FROM part WHERE p_size % 4 < 3
""")
def domain_parse(spark, sf_dir):
    """A field per layer with a coded domain, a range as a pair, a range as two numbers, or a kind that is passed over."""
    kind, size = F.col("p_size") % 4, F.col("p_size").cast("double")
    codes = F.array(F.struct(F.lit("1").alias("code"), F.lit("one").alias("name")), F.struct(F.lit("2").alias("code"), F.lit(None).cast("string").alias("name")))
    domain = F.struct(
        F.col("p_type").alias("name"), F.when(kind == 3, "inherited").alias("type"), F.when(kind == 0, codes).alias("codedValues"), F.when(kind == 1, F.array(size, size + 1)).alias("range"), F.when(kind == 2, 0.5).alias("minValue"), F.when(kind == 2, 1.5).alias("maxValue")
    )
    body = F.struct(F.col("p_partkey").alias("id"), F.array(F.struct(F.col("p_name").alias("name"), F.lit("esriFieldTypeString").alias("type"), domain.alias("domain"))).alias("fields"))
    found = landed.domains(landed.layers(table(spark, sf_dir, "part").select(F.lit("s").alias("service"), F.to_json(body).alias("body"))))
    return found.select("id", "field", "domain", "kind", F.array_join(F.transform("codes", lambda c: F.concat_ws("=", c["code"], c["name"])), ", ").alias("codes"), "min", "max")


@query("subtype_parse", "SELECT p_partkey AS id, CAST(p_size AS VARCHAR) AS code, p_name AS field, p_type AS domain FROM part WHERE p_size % 3 > 0")
def subtype_parse(spark, sf_dir):
    domain = F.when(F.col("p_size") % 3 > 0, F.struct(F.lit("codedValue").alias("type"), F.col("p_type").alias("name"))).otherwise(F.struct(F.lit("inherited").alias("type"), F.lit(None).cast("string").alias("name")))
    body = F.struct(F.col("p_partkey").alias("id"), F.array(F.struct(F.col("p_size").cast("string").alias("code"), F.lit("s").alias("name"), F.create_map("p_name", domain).alias("domains"))).alias("subtypes"))
    found = landed.subtype_domains(landed.layers(table(spark, sf_dir, "part").select(F.lit("s").alias("service"), F.to_json(body).alias("body"))))
    return found.select("id", "code", "field", F.get_json_object("domain", "$.name").alias("domain"))


@query("layer_scope", "SELECT p_partkey AS id, p_name AS name FROM part WHERE p_partkey = (SELECT MAX(p_partkey) FROM part)")
def layer_scope(spark, sf_dir):
    """The layer that a service url names: the last one of all."""
    parts = table(spark, sf_dir, "part")
    last = parts.agg(F.max("p_partkey")).first()[0]
    return landed.scoped(parts.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name")), f"https://h/FeatureServer/{last}/")


@query("version_pinned", """
SELECT o_custkey % 97 AS layer, COUNT(*) AS n, (SELECT COUNT(*) FROM lineitem WHERE l_linestatus = 'F') AS attachments FROM orders WHERE o_orderstatus = 'F' GROUP BY 1
""")
def version_pinned(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 97).alias("layer"), F.col("o_orderstatus").alias("version"))
    _, attachments, counts = landed.pinned("F", rows, table(spark, sf_dir, "lineitem").select(F.col("l_linestatus").alias("version")))
    return counts.join(F.broadcast(attachments.agg(F.count("*").alias("attachments"))), F.lit(True))  # one row


@query("layer_flags", "SELECT s_suppkey AS id, s_suppkey % 2 = 0 AS has_style, s_suppkey % 3 = 0 AS has_time, s_suppkey % 5 = 0 AS can_edit FROM supplier")
def layer_flags(spark, sf_dir):
    key = F.col("s_suppkey")
    style = F.when(key % 2 == 0, '{"renderer":{"type":"simple"}}').when(key % 7 == 0, '{"renderer":null}').otherwise("null")
    body = F.concat(F.lit('{"id":'), key.cast("string"), F.lit(',"drawingInfo":'), style, F.lit(',"timeInfo":'), F.when(key % 3 == 0, '{"start":"a"}').otherwise("null"), F.lit(',"capabilities":"'), F.when(key % 5 == 0, "Query, Editing").otherwise("Query"), F.lit('"}'))
    return landed.layer_flags(table(spark, sf_dir, "supplier").select(F.lit("s").alias("service"), body.alias("body"))).drop("service")


@query("page_plan", """
WITH l AS (SELECT o_custkey % 97 AS layer, COUNT(*) AS n FROM orders GROUP BY 1), s AS (SELECT *, CASE layer % 3 WHEN 0 THEN 7 WHEN 1 THEN 1000 ELSE 25 END AS size FROM l)
SELECT layer, page, page * size AS "offset", LEAST(size, n - page * size) AS rows, CASE WHEN layer % 5 <> 0 THEN 'oid' END AS order_by, CASE WHEN layer % 5 = 0 THEN 'rows without an object id come in no stable order' END AS loss
FROM (SELECT *, unnest(range(0, CAST((n + size - 1) // size AS BIGINT))) AS page FROM s)
""")
def page_plan(spark, sf_dir):
    layers = table(spark, sf_dir, "orders").groupBy((F.col("o_custkey") % 97).alias("layer")).agg(F.count("*").alias("n"))
    number = F.col("layer") % 3
    layers = layers.withColumns({"page_size": F.when(number == 0, 7).when(number == 2, 25), "oid_column": F.when(F.col("layer") % 5 != 0, "oid")})
    return landed.page_plan(layers)


@query("attachment_operations", "SELECT event_id AS id, CASE event_id % 4 WHEN 0 THEN 'add' WHEN 1 THEN 'add' WHEN 2 THEN 'update' ELSE 'delete' END AS op FROM events")
def attachment_operations(spark, sf_dir):
    number = F.col("event_id") % 4
    op = F.when(number == 1, "add").when(number == 2, "update").when(number == 3, "delete")
    lines = table(spark, sf_dir, "events").select(F.to_json(F.struct(op.alias("op"), F.col("event_id").cast("string").alias("global_id"))).alias("value"))
    return logs.parse_attachment_operations(lines).select(F.col("global_id").cast("long").alias("id"), "op")


@query("operation_sink", "SELECT o_orderstatus AS dataset, o_orderkey AS id, CASE WHEN o_orderkey % 4 = 0 THEN 'delete' ELSE 'insert' END AS type FROM orders")
def operation_sink(spark, sf_dir):
    """Operations written as JSON lines in a folder per dataset, and read back by the strict reader."""
    path, key = own_place(spark, "operations"), F.col("o_orderkey")
    ops = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("dataset"), key.cast("string").alias("feature_id"), F.when(key % 4 == 0, "delete").otherwise("insert").alias("type"))
    logs.write_operations(ops, path)
    lines = spark.read.text(f"{path}/*").select("value", F.regexp_extract(F.col("_metadata.file_path"), "dataset=([^/]+)/", 1).alias("folder"))
    read = logs.parse_operations(lines.select("folder", "value").select("value"))
    folders = lines.select("folder", F.get_json_object("value", "$.feature_id").alias("feature_id"))
    return read.drop("dataset").join(folders, "feature_id").select(F.col("folder").alias("dataset"), F.col("feature_id").cast("long").alias("id"), "type")


@query("key_index_file", "SELECT CAST(o_orderkey AS VARCHAR) AS oid, 'f' || o_orderkey AS feature_id, CAST(o_custkey AS BIGINT) AS hash FROM orders")
def key_index_file(spark, sf_dir):
    path, key = own_place(spark, "index"), F.col("o_orderkey").cast("string")
    table(spark, sf_dir, "orders").select(key.alias("oid"), F.concat(F.lit("f"), key).alias("feature_id"), F.col("o_custkey").cast("long").alias("hash")).write.json(path)
    return logs.read_index(spark, path)


@query("key_index_bad_lines", "SELECT CAST(row_number() OVER (ORDER BY o_orderkey) AS BIGINT) AS line, 'bad ' || o_orderkey AS value FROM orders QUALIFY o_orderkey % 50 = 0")
def key_index_bad_lines(spark, sf_dir):
    """An index in one file, in order of key, with a line that is no entry for every fiftieth key and blank lines among the others."""
    path, key = own_place(spark, "index"), F.col("o_orderkey").cast("string")
    line = F.when(F.col("o_orderkey") % 50 == 0, F.concat(F.lit("bad "), key)).when(F.col("o_orderkey") % 7 == 0, " ").otherwise(F.to_json(F.struct(key.alias("oid"), key.alias("feature_id"), F.lit(1).alias("hash"))))
    table(spark, sf_dir, "orders").select("o_orderkey", line.alias("value")).orderBy("o_orderkey").coalesce(1).select("value").write.text(path)
    return logs.bad_index_lines(spark, path).select("line", "value")


@query("attachment_index_file", "SELECT CAST(event_id AS VARCHAR) AS global_id, event_type AS name, CAST(event_id % 97 AS BIGINT) AS size FROM events")
def attachment_index_file(spark, sf_dir):
    """An attachment index that is read back, with one that is not there."""
    path = own_place(spark, "attachment-index")
    table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("global_id"), F.col("event_type").alias("name"), (F.col("event_id") % 97).alias("size")).write.json(path)
    both = logs.read_attachment_index(spark, path).unionByName(logs.read_attachment_index(spark, f"{path}-none"))
    return both.select("global_id", "name", "size")


@query("manifest_file", "SELECT p_brand AS name, COUNT(*) AS n FROM part GROUP BY 1")
def manifest_file(spark, sf_dir):
    """The datasets of a manifest: a plan with a row per brand, written as one document and read by the strict reader."""
    path = own_place(spark, "manifest")
    datasets = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("name")).agg(F.count("*").alias("n")).withColumn("schema", F.lit("s"))
    none = spark.createDataFrame([], "name string"), spark.createDataFrame([], "seq long, item string")
    logs.manifest_row(datasets, *none, "part", False).write.text(path)
    manifest = logs.read_manifest(spark, path)
    return spark.createDataFrame([(d["name"], d["n"]) for d in manifest["datasets"]], "name string, n bigint")


CURSORS = "SELECT 's' AS service, o_orderstatus AS dataset, CAST(o_orderkey AS BIGINT) AS layer, CAST(o_custkey AS BIGINT) AS generation FROM {orders}"


@query("cursor_roll", f"""
WITH c AS ({plain(CURSORS)}), w AS (SELECT service, dataset, layer, CASE WHEN layer % 6 <> 0 THEN generation + 1 END AS generation FROM c WHERE layer % 3 = 0)
SELECT * FROM w WHERE generation IS NOT NULL UNION ALL SELECT * FROM c WHERE layer % 3 <> 0
""")
def cursor_roll(spark, sf_dir):
    before = derive(spark, sf_dir, CURSORS)
    window = before.where("layer % 3 = 0").withColumn("generation", F.when(F.col("layer") % 6 != 0, F.col("generation") + 1))
    return logs.next_cursor(before, window, "feed")


@query("commit_totals", """
WITH RECURSIVE r AS (SELECT user_id AS dataset, event_id, 100 + event_id % 300 AS bytes, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS nth FROM events),
walk AS (SELECT dataset, nth, bytes, 0 AS batch, 1 AS n, bytes AS total FROM r WHERE nth = 1
  UNION ALL SELECT r.dataset, r.nth, r.bytes, CASE WHEN w.n + 1 > 7 OR w.total + r.bytes > 1500 THEN w.batch + 1 ELSE w.batch END, CASE WHEN w.n + 1 > 7 OR w.total + r.bytes > 1500 THEN 1 ELSE w.n + 1 END,
    CASE WHEN w.n + 1 > 7 OR w.total + r.bytes > 1500 THEN r.bytes ELSE w.total + r.bytes END FROM walk w JOIN r ON r.dataset = w.dataset AND r.nth = w.nth + 1)
SELECT dataset, CAST(batch AS BIGINT) AS batch, COUNT(*) AS n_rows, CAST(SUM(bytes) AS BIGINT) AS n_bytes FROM walk GROUP BY 1, 2
""")
def commit_totals(spark, sf_dir):
    """Rows and bytes of every commit of a load: the events of a user are a shard."""
    from ..operators import batches

    ops = table(spark, sf_dir, "events").select(F.col("user_id").alias("dataset"), "event_id", (100 + F.col("event_id") % 300).cast("long").alias("bytes"))
    return batches.batch_sizes(batches.greedy_batches(ops, "dataset", "event_id", "bytes", 7, 1500), "dataset", "bytes")


@query("commit_bodies", "SELECT o_orderpriority AS dataset, CAST(o_orderkey AS BIGINT) AS seq, o_orderstatus AS status FROM orders")
def commit_bodies(spark, sf_dir):
    """Operations written in commits and read out of their bodies again: each is in one commit."""
    ops = table(spark, sf_dir, "orders").select(F.concat("o_orderpriority", F.lit("/"), F.floor(F.col("o_orderkey") / 5000).cast("string")).alias("shard"), F.col("o_orderpriority").alias("dataset"), F.col("o_orderkey").cast("long").alias("seq"), F.col("o_orderstatus").alias("status"))
    commits = sinks.commit_batches(ops, own_place(spark, "commits"), shard="shard", most_rows=50)
    line = commits.select(F.explode(F.split("body", "\n")).alias("line"))
    return line.select(F.from_json("line", "dataset string, seq bigint, status string").alias("o")).select("o.*")


@query("kept_originals", "SELECT s_suppkey AS oid, CAST(s_nationkey AS INTEGER) AS srid, s_name AS text FROM supplier WHERE s_suppkey % 3 <> 0")
def kept_originals(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("oid"), F.when(F.col("s_suppkey") % 3 != 0, F.col("s_name").cast("binary")).alias("shape"), F.col("s_nationkey").cast("int").alias("srid"), F.lit(None).cast("string").alias("wkt"))
    kept = sinks.keep_originals(rows, own_place(spark, "originals"), "oid", "shape", "srid", "wkt")
    return kept.select("oid", F.col("native_srid").alias("srid"), F.col("native_geometry").cast("string").alias("text"))


@query("blob_files", "SELECT p_brand || '/' || (row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1) || '-' || regexp_replace(p_name, '[^A-Za-z0-9._-]', '_', 'g') AS file, p_type AS payload FROM (SELECT replace(p_brand, '#', '_') AS p_brand, p_partkey, p_name, p_type FROM part)")
def blob_files(spark, sf_dir):
    blobs = table(spark, sf_dir, "part").select(F.replace("p_brand", F.lit("#"), F.lit("_")).alias("dataset"), F.col("p_partkey").alias("feature_id"), F.col("p_name").alias("name"), F.col("p_type").cast("binary").alias("payload"))
    return logs.write_blobs(blobs, own_place(spark, "blobs")).select("file", F.col("payload").cast("string").alias("payload"))


@query("report_json", "SELECT p_partkey AS seq, p_name AS location, p_brand AS kind, CASE WHEN p_size % 2 = 0 THEN 'none' END AS reason FROM part")
def report_json(spark, sf_dir):
    items = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("seq"), F.col("p_name").alias("location"), F.col("p_brand").alias("kind"), F.lit("d").alias("detail"), F.lit("faithful").alias("outcome"), F.array().cast("array<string>").alias("losses"), F.when(F.col("p_size") % 2 == 0, "none").alias("reason"))
    return logs.report_documents(items).select("seq", F.get_json_object("line", "$.location").alias("location"), F.get_json_object("line", "$.kind").alias("kind"), F.get_json_object("line", "$.reason").alias("reason"))


@query("definition_xml", """
SELECT p_partkey AS name, 'DETableInfo' AS root, CASE WHEN p_size % 2 = 0 THEN 'grp' END AS group_name, p_size % 3 = 0 AS drawn, CASE WHEN p_size % 5 <> 0 THEN p_type END AS subtype_field, CASE WHEN p_size % 7 = 0 THEN '1' END AS default_code FROM part
""")
def definition_xml(spark, sf_dir):
    xml = r"""concat('<?xml version="1.0"?><t:DETableInfo xmlns:t="u"><CatalogPath>', CASE WHEN p_size % 2 = 0 THEN '\\grp' ELSE '' END, '\\', p_brand, '</CatalogPath><FeatureType>',
      CASE WHEN p_size % 3 = 0 THEN 'esriFTAnnotation' ELSE 'esriFTSimple' END, '</FeatureType><SubtypeFieldName>', CASE WHEN p_size % 5 <> 0 THEN p_type ELSE ' ' END, '</SubtypeFieldName>',
      CASE WHEN p_size % 7 = 0 THEN '<DefaultSubtypeCode>1</DefaultSubtypeCode>' ELSE '' END, '</t:DETableInfo>')"""
    found = definitions.definitions(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("name"), F.expr(xml).alias("definition")))
    return found.select("name", "root", "group_name", "drawn", "subtype_field", "default_code")


@query("definition_subtypes", "SELECT p_partkey AS name, CAST(p_size AS VARCHAR) AS code, p_name AS subtype, p_type AS field, CASE WHEN p_size % 2 = 0 THEN p_brand END AS domain, CASE WHEN p_size % 3 = 0 THEN '0' END AS \"default\" FROM part")
def definition_subtypes(spark, sf_dir):
    xml = """concat('<D><Subtypes><Subtype><SubtypeCode>', p_size, '</SubtypeCode><SubtypeName>', p_name, '</SubtypeName><FieldInfos><SubtypeFieldInfo><FieldName>', p_type, '</FieldName>',
      CASE WHEN p_size % 2 = 0 THEN concat('<DomainName>', p_brand, '</DomainName>') ELSE '<DomainName> </DomainName>' END, CASE WHEN p_size % 3 = 0 THEN '<DefaultValue>0</DefaultValue>' ELSE '' END, '</SubtypeFieldInfo></FieldInfos></Subtype></Subtypes></D>')"""
    return definitions.subtype_fields(definitions.definitions(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("name"), F.expr(xml).alias("definition"))))


FILE_TYPES = "SELECT p_partkey AS pos, CASE p_size % 9 WHEN 0 THEN 'Integer' WHEN 1 THEN 'Integer64' WHEN 2 THEN 'Real' WHEN 3 THEN 'String' WHEN 4 THEN 'Date' WHEN 5 THEN 'Binary' WHEN 6 THEN 'StringList' WHEN 7 THEN 'DateTime' ELSE 'Odd' END AS type FROM {part}"


@query("file_type_map", f"""
SELECT pos, type, CASE WHEN type IN ('Integer', 'Integer64') THEN 'integer' WHEN type = 'Real' THEN 'float' WHEN type = 'StringList' THEN 'array' ELSE 'string' END AS declared,
  CASE type WHEN 'Date' THEN 'dates become text' WHEN 'DateTime' THEN 'timestamps become text' WHEN 'Binary' THEN 'binary values stay behind' WHEN 'StringList' THEN 'the element type is not declared' WHEN 'Odd' THEN 'unknown type Odd' END AS loss FROM ({plain(FILE_TYPES)})
""")
def file_type_map(spark, sf_dir):
    return catalog.declared_types(derive(spark, sf_dir, FILE_TYPES), "file").select("pos", "type", "declared", "loss")


@query("domain_value_types", """
SELECT p_partkey AS id, CASE p_size % 5 WHEN 0 THEN 'integer' WHEN 1 THEN 'float' WHEN 2 THEN 'string' WHEN 3 THEN 'string' ELSE 'integer' END AS declared FROM part
""")
def domain_value_types(spark, sf_dir):
    number = F.col("p_size") % 5
    kind = F.when(number == 0, "esriFieldTypeSmallInteger").when(number == 1, "esriFieldTypeDouble").when(number == 2, "esriFieldTypeDate").when(number == 4, "esriFieldTypeOID")
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), catalog.domain_value_type(kind).alias("declared"))


@query("shape_names", """
SELECT p_partkey AS id, CASE p_size % 6 WHEN 0 THEN 'Point' WHEN 1 THEN 'MultiLineString' WHEN 2 THEN 'MultiPolygon' WHEN 3 THEN 'MultiPoint' WHEN 4 THEN 'Geometry' END AS name,
  CASE WHEN p_size % 6 = 5 THEN '' ELSE concat_ws('; ', CASE WHEN p_partkey % 2 = 0 THEN 'heights are kept in the shapes and not declared' END, CASE WHEN p_partkey % 3 = 0 THEN 'measures are kept in the shapes and not declared' END, CASE WHEN p_size % 6 = 4 THEN 'shapes of kind esriGeometryBezier are not known' END) END AS losses FROM part
""")
def shape_names(spark, sf_dir):
    number, key = F.col("p_size") % 6, F.col("p_partkey")
    kind = F.when(number == 0, "esriGeometryPoint").when(number == 1, "esriGeometryPolyline").when(number == 2, "esriGeometryPolygon").when(number == 3, "esriGeometryMultipoint").when(number == 4, "esriGeometryBezier")
    named = table(spark, sf_dir, "part").select(key.alias("id"), catalog.shape_name(kind, F.when(key % 2 == 0, True), key % 3 == 0).alias("s"))
    return named.select("id", "s.name", F.array_join("s.losses", "; ").alias("losses"))


@query("row_holding_layers", "SELECT p_partkey AS id FROM part WHERE p_size % 4 < 2")
def row_holding_layers(spark, sf_dir):
    number = F.col("p_size") % 4
    return catalog.row_holding(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.when(number == 2, "group").when(number == 3, "raster").when(number == 1, "table").otherwise("layer").alias("kind"))).select("id")


@query("epsg_codes", "SELECT s_suppkey AS id, CASE WHEN s_suppkey % 3 < 2 THEN s_nationkey END AS code FROM supplier")
def epsg_codes(spark, sf_dir):
    authority = F.when(F.col("s_suppkey") % 3 == 0, "EPSG").when(F.col("s_suppkey") % 3 == 1, "epsg").otherwise("ESRI")
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), catalog.epsg_code(authority, F.col("s_nationkey")).alias("code"))


@query("delta_plans", "SELECT p_partkey AS id, p_size % 2 = 0 AS incremental, CASE WHEN p_size % 2 <> 0 THEN p_name END AS relationships, CASE WHEN p_size % 2 <> 0 THEN p_type END AS style FROM part")
def delta_plans(spark, sf_dir):
    datasets = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("relationships"), F.col("p_type").alias("style"), "p_size")
    return catalog.delta_plan(datasets, F.col("p_size") % 2 == 0).drop("p_size")


@query("layers_then_tables", """
SELECT p_brand AS service, p_partkey AS pos, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_size % 2, p_partkey) - 1 AS INTEGER) AS seq FROM part
""")
def layers_then_tables(spark, sf_dir):
    entries = table(spark, sf_dir, "part").select(F.col("p_brand").alias("service"), F.col("p_partkey").alias("pos"), (F.col("p_size") % 2).alias("odd"))
    return catalog.in_order(entries.where("odd = 0").drop("odd"), entries.where("odd = 1").drop("odd"))


@query("group_tree", """
WITH s AS (SELECT s_suppkey, s_nationkey, s_name, n_regionkey FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT 'n' || n_nationkey AS group_id, COALESCE((SELECT string_agg(s_name, ', ' ORDER BY s_suppkey, s_name) FROM s WHERE s_nationkey = n_nationkey), '') AS members, (SELECT COUNT(*) FROM s WHERE s_nationkey = n_nationkey) AS n_members, CAST(NULL AS VARCHAR) AS reason FROM nation
UNION ALL SELECT 'r' || r_regionkey, COALESCE((SELECT string_agg(s_name, ', ' ORDER BY s_suppkey, s_name) FROM s WHERE n_regionkey = r_regionkey), ''), (SELECT COUNT(*) FROM s WHERE n_regionkey = r_regionkey), NULL FROM region
""")
def group_tree(spark, sf_dir):
    """Suppliers are layers in groups of nations, which are in groups of regions: every group lists all layers below it."""
    layers = derive(
        spark,
        sf_dir,
        """SELECT concat('r', r_regionkey) AS id, CAST(NULL AS STRING) AS parent, 'group' AS kind, r_regionkey AS pos, r_name AS name FROM {region}
        UNION ALL SELECT concat('n', n_nationkey), concat('r', n_regionkey), 'group', n_nationkey, n_name FROM {nation}
        UNION ALL SELECT concat('s', s_suppkey), concat('n', s_nationkey), 'layer', s_suppkey, s_name FROM {supplier}""",
    )
    return forest.member_lists(layers)


@query("first_domain_definitions", "SELECT p_brand AS layer, p_type AS domain, arg_min(p_name, p_partkey) AS kind, MIN(p_partkey) AS pos FROM part GROUP BY 1, 2")
def first_domain_definitions(spark, sf_dir):
    return catalog.first_domains(table(spark, sf_dir, "part").select(F.col("p_brand").alias("layer"), F.col("p_type").alias("domain"), F.col("p_name").alias("kind"), F.col("p_partkey").alias("pos")))


@query("source_composition", """
SELECT p_brand AS source, COUNT(*) FILTER (p_size % 4 = 0) AS layers, COUNT(*) FILTER (p_size % 4 = 1) AS tables, COUNT(*) FILTER (p_size % 4 = 2) AS groups, COUNT(*) FILTER (p_size % 4 = 3) AS rasters FROM part GROUP BY 1
""")
def source_composition(spark, sf_dir):
    kind = F.element_at(F.array(*map(F.lit, ("layer", "table", "group", "raster"))), (F.col("p_size") % 4 + 1).cast("int"))
    return tally.composition(table(spark, sf_dir, "part").select(F.col("p_brand").alias("source"), kind.alias("kind")))


@query("attachment_delta_counts", """
SELECT COUNT(*) FILTER (k = 0) AS added, COUNT(*) FILTER (k IN (1, 2)) AS replaced, COUNT(*) FILTER (k = 3) AS deleted, COUNT(*) FILTER (k IN (4, 5)) AS unchanged, COUNT(*) FILTER (k > 5) AS refused FROM (SELECT event_id % 11 AS k FROM events)
""")
def attachment_delta_counts(spark, sf_dir):
    ops = ("add", "replace", "replace_unseen", "delete", "unchanged", "repeat", "ambiguous", "refused", "orphan", "unknown", "incomparable")
    return runs.attachment_counts(table(spark, sf_dir, "events").select(F.element_at(F.array(*map(F.lit, ops)), (F.col("event_id") % 11 + 1).cast("int")).alias("op")))


@query("relationship_dataset_ids", "SELECT a.p_partkey AS name, MIN(b.p_partkey) AS origin_id, MIN(c.p_partkey) AS destination_id FROM part a JOIN part b ON a.p_brand = b.p_brand JOIN part c ON a.p_type = c.p_type GROUP BY 1")
def relationship_dataset_ids(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    ids = lambda c: parts.groupBy(F.col(c).alias("dataset")).agg(F.min("p_partkey").alias("dataset_id"))
    return pairing.relationship_ids(parts.select(F.col("p_partkey").alias("name"), F.col("p_brand").alias("origin"), F.col("p_type").alias("destination")), ids("p_brand").unionByName(ids("p_type")))


@query("missing_targets", """
SELECT c_custkey AS dataset, CASE WHEN n IS NULL THEN 'no such dataset' ELSE 'no main branch' END AS reason FROM customer LEFT JOIN (SELECT o_custkey, COUNT(*) AS n, bool_or(o_orderstatus = 'P') AS main FROM orders GROUP BY 1) ON c_custkey = o_custkey WHERE n IS NULL OR NOT main
""")
def missing_targets(spark, sf_dir):
    branches = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("dataset"), F.when(F.col("o_orderstatus") == "P", "main").otherwise("side").alias("branch"))
    return pairing.missing_targets(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("dataset")), branches)


@query("attachment_parents", """
SELECT event_id AS id, CASE WHEN c_custkey IS NOT NULL THEN CASE WHEN c_custkey % 4 = 0 THEN c_custkey + 1000000 ELSE c_custkey END END AS oid FROM (SELECT *, CASE WHEN event_id % 9 <> 0 THEN user_id END AS g FROM events) LEFT JOIN customer ON g = c_custkey AND c_custkey % 5 <> 0
""")
def attachment_parents(spark, sf_dir):
    """Adds find their parent in the window (every fourth customer) or in the table (the others but every fifth)."""
    adds = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.when(F.col("event_id") % 9 != 0, F.col("user_id").cast("long")).alias("parent_global_id"))
    rows = table(spark, sf_dir, "customer").where("c_custkey % 5 <> 0").select(F.col("c_custkey").cast("long").alias("global_id"), F.col("c_custkey").cast("long").alias("oid"))
    window = rows.where("global_id % 4 = 0").withColumn("oid", F.col("oid") + 1000000)
    return pairing.parents_by_global_id(adds, window, rows).select("id", "oid")


@query("blob_features", """
WITH b AS (SELECT event_id AS row, event_type AS "table", user_id AS parent, CASE WHEN event_id % 5 = 0 THEN ' ' ELSE event_type END AS name, event_id % 7 = 0 AS empty FROM events)
SELECT row, CASE WHEN row % 5 = 0 THEN "table" || '-' || row ELSE name END AS name, CASE WHEN led AND c_custkey IS NOT NULL THEN 'f' || c_custkey END AS feature_id, CASE WHEN empty THEN 'empty' WHEN NOT led OR c_custkey IS NULL THEN 'unresolved' ELSE 'kept' END AS state
FROM (SELECT *, "table" <> (SELECT MIN(event_type) FROM events) AS led FROM b) LEFT JOIN customer ON parent = c_custkey AND c_custkey % 3 <> 0
""")
def blob_features(spark, sf_dir):
    """Events are rows of a blob table per type; all types but the first have a media relationship to the customers."""
    events = table(spark, sf_dir, "events")
    key = F.col("event_id")
    blobs = events.select(F.col("event_type").alias("table"), key.alias("row"), F.col("user_id").alias("parent"), F.when(key % 5 == 0, " ").otherwise(F.col("event_type")).alias("name"), F.when(key % 7 != 0, F.lit("x").cast("binary")).alias("data"))
    least = events.agg(F.min("event_type").alias("least"))
    media = events.select(F.col("event_type").alias("destination")).distinct().join(F.broadcast(least), F.col("destination") != F.col("least")).select("destination", F.lit("customers").alias("dataset"))
    features = table(spark, sf_dir, "customer").where("c_custkey % 3 <> 0").select(F.lit("customers").alias("dataset"), F.col("c_custkey").alias("key"), F.concat(F.lit("f"), F.col("c_custkey").cast("string")).alias("feature_id"))
    return pairing.blob_features(blobs, media, features).select("row", "name", "feature_id", "state")


@query("json_scalars", "SELECT event_id AS id, CASE event_id % 4 WHEN 0 THEN CAST(event_id AS VARCHAR) WHEN 1 THEN event_type WHEN 2 THEN 'true' ELSE '[1,2]' END AS text FROM events")
def json_scalars(spark, sf_dir):
    key = F.col("event_id")
    document = F.when(key % 4 == 0, key.cast("string")).when(key % 4 == 1, F.to_json(F.struct(F.col("event_type").alias("v")))).when(key % 4 == 2, "true").otherwise("[1, 2]")
    parsed = F.parse_json(document)
    value = F.when(key % 4 == 1, text.scalar_text(F.try_variant_get(parsed, "$.v", "variant"))).otherwise(text.scalar_text(parsed))
    return table(spark, sf_dir, "events").select(key.alias("id"), value.alias("text"))


@query("payload_texts", "SELECT p_partkey AS id, base64(encode(p_name)) AS as_base64, lower(hex(encode(p_name))) AS as_hex FROM part")
def payload_texts(spark, sf_dir):
    payload = F.col("p_name").cast("binary")
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), sinks.payload_text(payload).alias("as_base64"), sinks.payload_text(payload, as_hex=True).alias("as_hex"))


@query("name_lists", "SELECT p_brand AS layer, string_agg(DISTINCT p_type, ', ' ORDER BY p_type) AS names, COUNT(*) || CASE WHEN COUNT(*) = 1 THEN ' field' ELSE ' fields' END AS detail FROM part GROUP BY 1")
def name_lists(spark, sf_dir):
    parts = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("layer")).agg(F.collect_list("p_type").alias("names"), F.count("*").alias("n"))
    return parts.select("layer", F.array_join(text.sorted_names(F.col("names")), ", ").alias("names"), text.counted(F.col("n"), "field").alias("detail"))


@query("cardinality_words", "SELECT p_partkey AS id, CASE p_size % 4 WHEN 0 THEN 'one to one' WHEN 1 THEN 'one to many' WHEN 2 THEN 'many to many' ELSE p_type END AS word FROM part")
def cardinality_words(spark, sf_dir):
    number = F.col("p_size") % 4
    code = F.when(number == 0, "esriRelCardinalityOneToOne").when(number == 1, "esriRelCardinalityOneToMany").when(number == 2, "esriRelCardinalityManyToMany").otherwise(F.col("p_type"))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), text.cardinality_word(code).alias("word"))


@query("altitudes", "SELECT p_partkey AS id, p_size % 5 IN (1, 2) AS has FROM part")
def altitudes(spark, sf_dir):
    number = F.col("p_size") % 5
    coordinates = F.when(number == 0, "1,2").when(number == 1, " 1,2,3.5 ").when(number == 2, "1, 2 -4").when(number == 3, "1,2,0.0").otherwise("1,2,x")
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), text.has_altitude(coordinates).alias("has"))


@query("attachment_names", """
SELECT event_id AS id, CASE event_id % 4 WHEN 0 THEN event_type WHEN 1 THEN 'g' || event_id WHEN 2 THEN CAST(event_id AS VARCHAR) ELSE 'attachment' END AS name,
  CASE WHEN event_id % 2 = 0 THEN event_type END AS content_type, CAST(user_id AS BIGINT) AS size FROM events
""")
def attachment_names(spark, sf_dir):
    """Names of attachments (F14), and their metadata as JSON without what is null (F15), read out again."""
    key = F.col("event_id")
    name = text.attachment_name(F.when(key % 4 == 0, F.col("event_type")).otherwise(" "), F.when(key % 4 == 1, F.concat(F.lit("g"), key.cast("string"))), F.when(key % 4 == 2, key))
    rows = table(spark, sf_dir, "events").select(key.alias("id"), name.alias("name"), F.when(key % 2 == 0, F.col("event_type")).alias("content_type"), F.col("user_id").alias("size"))
    stated = rows.withColumn("metadata", sinks.attachment_metadata("content_type", "size"))
    return stated.select("id", "name", F.get_json_object("metadata", "$.content_type").alias("content_type"), F.get_json_object("metadata", "$.size").cast("long").alias("size"))


@query("run_counts", """
WITH f AS (SELECT o_orderstatus AS dataset, CASE WHEN o_orderkey % 40 <> 0 THEN o_orderkey // 2 END AS key FROM orders WHERE o_orderkey % 9 <> 0),
k AS (SELECT dataset, key, COUNT(*) AS n FROM f WHERE key IS NOT NULL GROUP BY 1, 2)
SELECT dataset, CAST(SUM(n) AS BIGINT) AS inserted, CAST(SUM(n - 1) AS BIGINT) AS repeated, (SELECT COUNT(*) FROM f WHERE f.dataset = k.dataset AND key IS NULL) AS unkeyed FROM k GROUP BY 1
""")
def run_counts(spark, sf_dir):
    """A full extraction of orders whose keys repeat: later rows of a key are inserts too, rows without a key are counted."""
    key = F.when(F.col("o_orderkey") % 40 != 0, F.floor(F.col("o_orderkey") / 2))
    rows = table(spark, sf_dir, "orders").where("o_orderkey % 9 <> 0").select(F.col("o_orderstatus").alias("dataset"), key.alias("key"), "o_custkey", "o_totalprice", "o_orderkey")
    return runs.extract(rows, ["o_custkey", "o_totalprice", "o_orderkey"], "run").counts.select("dataset", "inserted", "repeated", "unkeyed")


@query("run_increment", """
WITH f AS (SELECT o_orderstatus AS dataset, o_orderkey AS key, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS v FROM orders WHERE o_orderkey % 20 <> 0),
s AS (SELECT o_orderstatus AS dataset, o_orderkey AS key, o_totalprice AS v FROM orders WHERE o_orderkey % 33 <> 0)
SELECT COALESCE(s.dataset, f.dataset) AS dataset, COALESCE(s.key, f.key) AS key, CASE WHEN f.key IS NULL THEN 'insert' WHEN s.key IS NULL THEN 'delete' ELSE 'update' END AS op
FROM s FULL OUTER JOIN f ON s.key = f.key WHERE f.key IS NULL OR s.key IS NULL OR s.v <> f.v
""")
def run_increment(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("dataset"), F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("v"))
    first = orders.where("key % 20 <> 0").withColumn("v", F.when(F.col("key") % 7 == 0, F.col("v") + 1).otherwise(F.col("v")))
    index = runs.extract(first, ["v"], "run 1").index
    return runs.increment(index, orders.where("key % 33 <> 0"), ["v"], "run 2").operations.select("dataset", "key", "op")


#: Three states of a document's text, of 100 to 3,200 letters, and the bytes that an operation may have.
TEXTS = "SELECT source AS dataset, doc_id AS key, {length} AS n FROM documents WHERE {there}"
MOST_BYTES = 2000
LENGTHS = {
    1: ("CAST(100 + n_chars % 50 + CASE WHEN doc_id % 5 = 0 THEN 3000 ELSE 0 END AS INTEGER)", "true"),
    2: ("CAST(100 + n_chars % 50 + doc_id % 2 + CASE WHEN doc_id % 4 = 0 THEN 3000 ELSE 0 END AS INTEGER)", "doc_id % 11 <> 0"),
    3: ("CAST(100 + n_chars % 50 + doc_id % 3 + CASE WHEN doc_id % 7 = 0 THEN 3000 ELSE 0 END AS INTEGER)", "doc_id % 13 <> 0"),
}


def _state(n: int) -> str:
    return TEXTS.format(length=LENGTHS[n][0], there=LENGTHS[n][1])


@query("run_chain", f"""
WITH fit AS (SELECT {MOST_BYTES} - length('{{"op":"insert","dataset":"","feature_id":"","v":""}}') - 36 AS most),
a AS ({_state(1)}), b AS ({_state(2)}), c AS ({_state(3)}), k AS (SELECT source AS dataset, doc_id AS key FROM documents),
one AS (SELECT k.*, CASE WHEN a.n + length(k.dataset) <= most THEN a.n END AS held FROM k JOIN a ON k.key = a.key, fit),
two AS (SELECT one.dataset, one.key, one.held, b.n, b.n + length(one.dataset) <= most AS fits FROM one LEFT JOIN b ON one.key = b.key, fit),
after_two AS (SELECT dataset, key, held AS before, CASE WHEN n IS NULL THEN NULL WHEN fits THEN n ELSE held END AS held, n, fits FROM two),
three AS (SELECT t.dataset, t.key, t.held AS before, c.n, c.n + length(t.dataset) <= most AS fits, t.key % 3 <> 1 AS touched, t.key % 4 = 1 AS gone FROM after_two t LEFT JOIN c ON t.key = c.key, fit)
SELECT 1 AS run, dataset, key, 'insert' AS op FROM one WHERE held IS NOT NULL
UNION ALL SELECT 2, dataset, key, CASE WHEN n IS NULL THEN 'delete' WHEN before IS NULL THEN 'insert' ELSE 'update' END FROM after_two
  WHERE (n IS NULL AND before IS NOT NULL) OR (n IS NOT NULL AND fits AND n IS DISTINCT FROM before)
UNION ALL SELECT 3, dataset, key, CASE WHEN before IS NULL THEN 'insert' ELSE 'update' END FROM three WHERE touched AND n IS NOT NULL AND fits AND n IS DISTINCT FROM before
UNION ALL SELECT 3, dataset, key, 'delete' FROM three WHERE gone AND before IS NOT NULL AND NOT (touched AND n IS NOT NULL)
""")
def run_chain(spark, sf_dir):
    """A full run, an increment on it by comparison, and one on that by a change feed; some rows are too large in some of them."""
    docs = table(spark, sf_dir, "documents")
    docs.createOrReplaceTempView("documents_of_runs")
    states = [spark.sql(_state(n).replace("FROM documents", "FROM documents_of_runs")).select("dataset", "key", F.repeat(F.lit("x"), "n").alias("v")) for n in LENGTHS]
    keys = docs.select(F.col("source").alias("dataset"), F.col("doc_id").alias("key"))
    chain = runs.Chain(spark, own_place(spark, "runs"))
    found = [chain.full(states[0], ["v"], "run 1", MOST_BYTES), chain.next(states[1], ["v"], "run 2", MOST_BYTES)]
    found.append(chain.next(states[2], ["v"], "run 3", MOST_BYTES, keys.where("key % 3 <> 1"), keys.where("key % 4 = 1")))
    every = [e.operations.select(F.lit(n + 1).alias("run"), "dataset", "key", "op") for n, e in enumerate(found)]
    return every[0].unionByName(every[1]).unionByName(every[2])


@query("run_chain_target", f"""
WITH fit AS (SELECT {MOST_BYTES} - length('{{"op":"insert","dataset":"","feature_id":"","v":""}}') - 36 AS most),
a AS ({_state(1)}), b AS ({_state(2)}),
one AS (SELECT a.*, CASE WHEN a.n + length(a.dataset) <= most THEN a.n END AS held FROM a, fit)
SELECT one.dataset, one.key, CAST(CASE WHEN b.n + length(one.dataset) <= most THEN b.n ELSE held END AS INTEGER) AS n FROM one JOIN b ON one.key = b.key, fit WHERE b.n + length(one.dataset) <= most OR held IS NOT NULL
""")
def run_chain_target(spark, sf_dir):
    """What the target holds after two runs, read from its versions before and after its deltas are made one."""
    docs = table(spark, sf_dir, "documents")
    docs.createOrReplaceTempView("documents_of_runs")
    states = [spark.sql(_state(n).replace("FROM documents", "FROM documents_of_runs")).select("dataset", "key", F.repeat(F.lit("x"), "n").alias("v")) for n in (1, 2)]
    chain = runs.Chain(spark, own_place(spark, "runs"))
    chain.full(states[0], ["v"], "run 1", MOST_BYTES)
    chain.next(states[1], ["v"], "run 2", MOST_BYTES)
    chain.compact()
    return chain.target().join(chain.index().select("dataset", "feature_id", "key"), ["dataset", "feature_id"]).select("dataset", "key", F.length("v").alias("n"))


RELATIONS = """
SELECT concat('p', floor(p_partkey / 2)) AS origin, concat('p', p_partkey) AS destination FROM {part} UNION ALL SELECT concat('p', p_partkey - 3), concat('p', p_partkey) FROM {part} WHERE p_partkey % 7 = 0
UNION ALL SELECT concat('s', s_suppkey), concat('s', (s_suppkey + 1) % 5) FROM {supplier} WHERE s_suppkey < 5 UNION ALL SELECT concat('s', s_suppkey - 5), concat('s', s_suppkey) FROM {supplier}
"""


@query("load_levels", """
WITH RECURSIVE e AS (SELECT p_partkey // 2 AS a, p_partkey AS b FROM part WHERE p_partkey > 0 UNION SELECT p_partkey - 3, p_partkey FROM part WHERE p_partkey % 7 = 0 AND p_partkey >= 3),
w AS (SELECT p_partkey AS k, 1 AS level FROM part WHERE p_partkey = 0 UNION SELECT e.b, w.level + 1 FROM w JOIN e ON e.a = w.k), l AS (SELECT k, MAX(level) AS level FROM w GROUP BY 1)
SELECT 'p' || k AS dataset, level, CAST(NULL AS VARCHAR) AS reason FROM l
UNION ALL SELECT 's' || s_suppkey, (SELECT MAX(level) + 1 FROM l), 'in or below a cycle' FROM supplier
""")
def load_levels(spark, sf_dir):
    """Parts that wait for others in long chains, and suppliers in and below a cycle."""
    names = derive(spark, sf_dir, "SELECT concat('p', p_partkey) AS dataset FROM {part} UNION ALL SELECT concat('s', s_suppkey) FROM {supplier}")
    return ordering.load_levels(names, derive(spark, sf_dir, RELATIONS))


@query("bucketed_index_run", """
WITH f AS (SELECT o_orderstatus AS dataset, o_orderkey AS key, CASE WHEN o_orderkey % 9 = 0 THEN o_custkey + 1 ELSE o_custkey END AS v FROM orders WHERE o_orderkey % 15 <> 0), s AS (SELECT o_orderstatus AS dataset, o_orderkey AS key, o_custkey AS v FROM orders WHERE o_orderkey % 22 <> 0)
SELECT COALESCE(s.dataset, f.dataset) AS dataset, COALESCE(s.key, f.key) AS key, CASE WHEN f.key IS NULL THEN 'insert' WHEN s.key IS NULL THEN 'delete' ELSE 'update' END AS op
FROM s FULL OUTER JOIN f ON s.key = f.key WHERE f.key IS NULL OR s.key IS NULL OR s.v <> f.v
""")
def bucketed_index_run(spark, sf_dir):
    """An increment on an index that lies in buckets of its key."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("dataset"), F.col("o_orderkey").alias("key"), F.col("o_custkey").alias("v"))
    first = orders.where("key % 15 <> 0").withColumn("v", F.when(F.col("key") % 9 == 0, F.col("v") + 1).otherwise(F.col("v")))
    path = own_place(spark, "bucketed-index")
    index = logs.write_index(runs.extract(first, ["v"], "run 1").index, f"key_index_{path[-32:]}", path, buckets=8)
    return runs.increment(index, orders.where("key % 22 <> 0"), ["v"], "run 2").operations.select("dataset", "key", "op")


@query("table_catalogue", """
WITH t AS (SELECT 'part' AS layer, 'p_' AS prefix UNION ALL SELECT 'supplier', 's_' UNION ALL SELECT 'nation', 'n_'),
n AS (SELECT 'part' AS layer, COUNT(*) AS n_rows FROM part UNION ALL SELECT 'supplier', COUNT(*) FROM supplier UNION ALL SELECT 'nation', COUNT(*) FROM nation)
SELECT layer, fields, CAST(len(string_split(fields, ', ')) AS BIGINT) AS n_fields, CAST(n_domains AS BIGINT) AS n_domains, n_rows FROM (VALUES
  ('part', 'p_partkey, p_name, p_brand=Brands, p_type=Types, p_size, p_retailprice', 2), ('supplier', (SELECT string_agg(column_name || CASE column_name WHEN 's_nationkey' THEN '=Nations' ELSE '' END, ', ' ORDER BY column_index) FROM duckdb_columns() WHERE table_name = 'supplier'), 1),
  ('nation', (SELECT string_agg(column_name || CASE column_name WHEN 'n_nationkey' THEN '=Nations' ELSE '' END, ', ' ORDER BY column_index) FROM duckdb_columns() WHERE table_name = 'nation'), 1)) AS f(layer, fields, n_domains) JOIN n USING (layer)
""")
def table_catalogue(spark, sf_dir):
    """Driver tables with their fields, the domains that these use, and how many rows there are."""
    tables = {name: table(spark, sf_dir, name) for name in ("part", "supplier", "nation")}
    uses = [("part", "p_brand", "Brands"), ("part", "p_type", "Types"), ("supplier", "s_nationkey", "Nations"), ("nation", "n_nationkey", "Nations"), ("nation", "nowhere", "Lost")]
    found = definitions.table_catalogue(definitions.table_fields(spark, tables), spark.createDataFrame(uses, "layer string, name string, domain string"), definitions.counted_rows(tables))
    names = F.transform("fields", lambda f: F.concat(f["name"], F.coalesce(F.concat(F.lit("="), f["domain"]), F.lit(""))))
    return found.select("layer", F.array_join(names, ", ").alias("fields"), "n_fields", "n_domains", "n_rows")


@query("change_windows", "SELECT CAST(user_id % 3 AS BIGINT) AS layer, CAST(event_id // 3000 AS BIGINT) AS generation, CAST(event_id AS BIGINT) AS id, event_type AS state FROM events WHERE user_id % 3 < 2 AND event_id >= 3000")
def change_windows(spark, sf_dir):
    """Events landed as pages of two layers' windows, and what lies behind a cursor, read through the source with its filters."""
    folder = own_place(spark, "windows")
    events = table(spark, sf_dir, "events").select((F.col("user_id") % 3).alias("layer"), F.floor(F.col("event_id") / 3000).alias("generation"), F.col("event_id").alias("id"), F.col("event_type").alias("state"))
    windows.land(events, folder)
    windows.register(spark)
    read = spark.read.format("change_windows").schema("layer bigint, generation bigint, id bigint, state string").load(folder)
    return read.where("layer in (0, 1) and generation > 0")


@query("observed_tally", """
SELECT COUNT(*) AS read, COUNT(*) FILTER (n <= 4096 AND k IS NOT NULL) AS written, COUNT(*) FILTER (n > 4096 AND k IS NOT NULL) AS oversized, CAST(MAX(CASE WHEN n > 4096 AND k IS NOT NULL THEN n END) AS BIGINT) AS largest, COUNT(*) FILTER (k IS NULL) AS unkeyed
FROM (SELECT strlen(text) AS n, CASE WHEN doc_id % 9 <> 0 THEN doc_id END AS k FROM documents)
""")
def observed_tally(spark, sf_dir):
    """Documents that fit are written; what there was is known from the write itself."""
    rows = table(spark, sf_dir, "documents").select(F.when(F.col("doc_id") % 9 != 0, F.col("doc_id")).alias("key"), "text")
    size = F.octet_length("text")
    seen, numbers = tally.observed(rows, size, 4096, F.col("key"))
    seen.where(size <= 4096).where("key is not null").write.parquet(own_place(spark, "observed"))
    return spark.createDataFrame([tuple(numbers.get[c] for c in ("read", "written", "oversized", "largest", "unkeyed"))], "read bigint, written bigint, oversized bigint, largest bigint, unkeyed bigint")
