"""Queries over landed service documents; their JSON is written from driver tables and read back through the stated schemas."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import table
from ..sources import landed, logs
from .base import query


@query("page_scan", "SELECT o_orderkey AS key, o_custkey % 97 AS layer, o_orderstatus AS status FROM orders")
def page_scan(spark, sf_dir):
    """Orders as landed pages of a range of 10,000 keys in a layer, some hundred rows at most, read back row by row."""
    attributes = F.parse_json(F.to_json(F.struct(F.col("o_orderkey").alias("objectid"), F.col("o_orderstatus").alias("status"))))
    rows = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 97).alias("layer"), F.floor(F.col("o_orderkey") / 10_000).alias("page"), F.struct(attributes.alias("attributes")).alias("row"))
    pages = rows.groupBy("layer", "page").agg(F.to_json(F.struct(F.collect_list("row").alias("features"))).alias("body"))
    read = landed.page_rows(pages)
    return read.select(F.try_variant_get("attributes", "$.objectid", "bigint").alias("key"), "layer", F.try_variant_get("attributes", "$.status", "string").alias("status"))


@query("page_completeness", """
WITH p AS (SELECT o_custkey % 97 AS layer, o_orderkey % 5 AS page, COUNT(*) FILTER (o_custkey % 7 <> 0 OR o_orderkey % 5 = 0) AS n_rows FROM orders GROUP BY 1, 2),
f AS (SELECT *, page < 4 OR layer % 10 = 0 AS exceeded, layer % 13 <> 0 AS can_page FROM p),
r AS (SELECT *, exceeded AND n_rows = 0 AS e, sum(CASE WHEN exceeded AND n_rows = 0 THEN 0 ELSE 1 END) OVER (PARTITION BY layer ORDER BY page) AS run FROM f),
s AS (SELECT *, sum(CAST(e AS INTEGER)) OVER (PARTITION BY layer, run ORDER BY page) AS n_in_run FROM r),
x AS (SELECT layer, COALESCE(MIN(page) FILTER (NOT exceeded), 1000000) AS e, COALESCE(MIN(page) FILTER (n_in_run >= 3), 1000000) AS s, COALESCE(MIN(page) FILTER (exceeded AND NOT can_page), 1000000) AS c FROM s GROUP BY 1)
SELECT layer, reason IS NULL AS complete, reason FROM (SELECT layer, CASE WHEN c < e AND c <= s THEN 'more rows on a layer that cannot page' WHEN s < e THEN 'empty pages that promise more' WHEN e = 1000000 THEN 'the last page promises more' END AS reason FROM x)
""")
def page_completeness(spark, sf_dir):
    pages = table(spark, sf_dir, "orders").groupBy((F.col("o_custkey") % 97).alias("layer"), (F.col("o_orderkey") % 5).alias("page")).agg(F.count_if((F.col("o_custkey") % 7 != 0) | (F.col("o_orderkey") % 5 == 0)).alias("n_rows"))
    return landed.page_completeness(pages.withColumns({"exceeded": (F.col("page") < 4) | (F.col("layer") % 10 == 0), "can_page": F.col("layer") % 13 != 0}))


@query("service_heads", """
SELECT s_suppkey AS service, CASE WHEN s_suppkey % 4 <> 0 THEN s_name END AS description, s_suppkey % 2 = 0 AS versioned, s_suppkey % 3 = 0 AS tracked, CASE WHEN s_suppkey % 5 <> 0 THEN s_suppkey * 10 END AS generation FROM supplier
""")
def service_heads(spark, sf_dir):
    key = F.col("s_suppkey")
    gens = F.when(key % 5 != 0, F.struct(F.array(F.struct(F.lit(0).alias("id"), (key * 10).alias("serverGen"))).alias("layerServerGens")))
    body = F.struct(
        F.when(key % 4 != 0, F.col("s_name")).alias("serviceDescription"), F.when(key % 2 == 0, True).alias("hasVersionedData"), F.when(key % 3 == 0, "Query, ChangeTracking").otherwise("Query,Sync").alias("capabilities"), gens.alias("changeTrackingInfo")
    )
    heads = landed.service_heads(table(spark, sf_dir, "supplier").select(key.alias("service"), F.to_json(body).alias("body")))
    return heads.select("service", "description", "versioned", "tracked", F.element_at("generations", F.lit(0).cast("long")).alias("generation"))


@query("layer_catalogue", """
SELECT p_partkey AS id, CASE WHEN p_partkey % 9 <> 0 THEN p_name END AS name, CASE WHEN p_size % 4 = 0 THEN 'group' WHEN p_size % 4 = 1 THEN 'table' ELSE 'layer' END AS kind,
  CASE WHEN p_partkey % 2 = 0 THEN 4326 ELSE 26919 END AS code, CASE WHEN p_partkey % 5 = 0 THEN 'oid' ELSE p_brand END AS oid_column,
  CASE WHEN p_size % 4 IN (2, 3) THEN 'esriGeometryPoint' WHEN p_size % 4 = 0 THEN 'esriGeometryPoint' END AS geometry_type, CASE WHEN p_partkey % 3 = 0 THEN 2000 ELSE 1000 END AS page_size FROM part
""")
def layer_catalogue(spark, sf_dir):
    key = F.col("p_partkey")
    reference = F.struct(F.struct(F.lit(26919).alias("wkid"), F.when(key % 2 == 0, 4326).alias("latestWkid")).alias("spatialReference"))
    fields = F.array(F.struct(F.lit("note").alias("name"), F.lit("esriFieldTypeString").alias("type")), F.struct(F.col("p_brand").alias("name"), F.lit("esriFieldTypeOID").alias("type")))
    size = F.col("p_size") % 4
    body = F.struct(
        key.alias("id"), F.when(key % 9 != 0, F.col("p_name")).otherwise(" ").alias("name"), F.when(size == 0, "Group Layer").otherwise("Feature Layer").alias("type"), F.when(size == 1, "esriGeometryNull").otherwise("esriGeometryPoint").alias("geometryType"),
        reference.alias("extent"), F.when(key % 5 == 0, "oid").otherwise("").alias("objectIdField"), fields.alias("fields"), F.when(key % 3 == 0, 2000).alias("maxRecordCount"),
    )
    layers = landed.layers(table(spark, sf_dir, "part").select(F.lit("s").alias("service"), F.to_json(body).alias("body")))
    return layers.select("id", "name", "kind", "code", "oid_column", "geometry_type", F.col("page_size").cast("int").alias("page_size"))


@query("change_files", """
SELECT o_custkey % 20 AS layer, o_orderkey AS key, 'touched' AS what FROM orders WHERE o_orderkey % 3 < 2 GROUP BY ALL
UNION ALL SELECT o_custkey % 20, o_orderkey, 'deleted' FROM orders WHERE o_orderkey % 3 = 2 GROUP BY ALL
""")
def change_files(spark, sf_dir):
    """A change file per day of orders: adds and updates (some both), deletes by id, null sections where a day has none."""
    own = F.parse_json(F.to_json(F.struct(F.col("o_orderkey").alias("objectid"))))
    row = lambda k: F.when(F.col("o_orderkey") % 3 == k, F.struct(own.alias("attributes")))
    orders = table(spark, sf_dir, "orders")
    gone = F.when(F.col("o_orderkey") % 3 == 2, F.col("o_orderkey").cast("string"))
    edits = orders.groupBy("o_orderdate", (F.col("o_custkey") % 20).alias("id")).agg(
        F.collect_list(row(0)).alias("adds"), F.collect_list(F.when(F.col("o_orderkey") % 3 < 2, F.struct(own.alias("attributes")))).alias("updates"), F.collect_list(gone).alias("deleteIds")
    )
    empty = lambda c: F.when(F.size(c) > 0, F.col(c)).alias(c)
    files = edits.groupBy("o_orderdate").agg(F.to_json(F.struct(F.collect_list(F.struct("id", F.struct(empty("adds"), empty("updates"), empty("deleteIds")).alias("features"))).alias("edits"))).alias("body"))
    touched, deleted, _, _ = landed.changes(files, "objectid")
    return touched.withColumn("what", F.lit("touched")).unionByName(deleted.withColumn("what", F.lit("deleted")))


@query("attachment_listings", "SELECT user_id AS oid, event_id AS number, event_type AS name, CAST(event_id % 97 AS BIGINT) AS size FROM events")
def attachment_listings(spark, sf_dir):
    info = F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("name"), (F.col("event_id") % 97).alias("size"))
    per_parent = table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_list(info).alias("attachmentInfos"))
    single = per_parent.where("user_id % 2 = 0").select(F.col("user_id").alias("parent"), F.to_json(F.struct("attachmentInfos")).alias("body"))
    group = F.struct(F.col("user_id").alias("parentObjectId"), "attachmentInfos")
    grouped = per_parent.where("user_id % 2 = 1").groupBy(F.floor(F.col("user_id") / 20)).agg(F.to_json(F.struct(F.collect_list(group).alias("attachmentGroups"))).alias("body"))
    listing = landed.attachment_listing(single.unionByName(grouped.select(F.lit(None).cast("long").alias("parent"), "body")))
    return listing.select("oid", "number", "name", "size")


@query("operation_log", """
SELECT o_orderkey AS feature, CASE o_orderkey % 3 WHEN 0 THEN 'insert' WHEN 1 THEN 'update' ELSE 'delete' END AS type, CASE WHEN o_orderkey % 3 < 2 THEN o_orderstatus END AS status FROM orders
""")
def operation_log(spark, sf_dir):
    """Orders as lines of an operation log; deletes carry a state that reading drops, for the tag decides."""
    key = F.col("o_orderkey")
    line = F.struct(F.when(key % 3 == 0, "insert").when(key % 3 == 1, "update").otherwise("delete").alias("type"), F.lit("orders").alias("dataset"), key.cast("string").alias("feature_id"), F.struct(F.col("o_orderstatus").alias("status")).alias("properties"))
    ops = logs.parse_operations(table(spark, sf_dir, "orders").select(F.to_json(line).alias("value")))
    return ops.select(F.col("feature_id").cast("long").alias("feature"), "type", F.try_variant_get("properties", "$.status", "string").alias("status"))


@query("portal_items", "SELECT 'http://s/' || s_suppkey AS url, s_name AS title FROM supplier WHERE s_suppkey % 3 <> 0 AND s_suppkey % 2 = 0")
def portal_items(spark, sf_dir):
    key = F.col("s_suppkey")
    item = F.struct(F.when(key % 3 != 0, F.concat(F.lit("http://s/"), key.cast("string"))).alias("url"), F.col("s_name").alias("title"), F.lit("o").alias("owner"), F.when(key % 2 == 0, "Feature Service").otherwise("Map").alias("type"))
    listings = table(spark, sf_dir, "supplier").groupBy(F.floor(key / 100).alias("page")).agg(F.to_json(F.struct(F.collect_list(item).alias("results"))).alias("body"))
    return landed.portal_items(listings, "Feature Service", "o").select("url", "title")


@query("report_lines", "SELECT p_partkey AS seq, '| ' || replace(p_name, '|', '\\|') || ' | ' || p_brand || ' | ' || p_type || ' | faithful |  |' AS line FROM part")
def report_lines(spark, sf_dir):
    items = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("seq"), F.col("p_name").alias("location"), F.col("p_brand").alias("kind"), F.col("p_type").alias("detail"), F.lit("faithful").alias("outcome"), F.lit("").alias("reason"), F.array().cast("array<string>").alias("losses"))
    return logs.report_lines(items)
