"""Queries over catalogues: fields, layers, domains, relationships, verdicts, logs. Their rows are derived from `part`, `supplier` and others."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import catalog, forest, pairing, rules, tally
from ..session import table
from .base import derive, plain, query

#: One field per part: its layer is the brand, its type and nullability follow from size and key.
FIELDS = """
SELECT p_brand AS layer, p_partkey AS pos, p_name AS name,
  CASE p_size % 10 WHEN 0 THEN 'esriFieldTypeOID' WHEN 1 THEN 'esriFieldTypeInteger' WHEN 2 THEN 'esriFieldTypeDouble' WHEN 3 THEN 'esriFieldTypeString'
    WHEN 4 THEN 'esriFieldTypeDate' WHEN 5 THEN 'esriFieldTypeBlob' WHEN 6 THEN 'esriFieldTypeGeometry' WHEN 7 THEN 'esriFieldTypeGUID' WHEN 8 THEN 'esriFieldTypeOdd' ELSE 'esriFieldTypeXML' END AS type,
  CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN ' ' ELSE p_type END AS alias, p_partkey % 4 <> 0 AS nullable
FROM {part}
"""
TYPES_SQL = "(VALUES " + ", ".join("('{}', '{}', {})".format(t, d, "NULL" if loss is None else f"'{loss}'") for ns, t, d, loss in catalog.TYPE_MAP if ns == "hosted") + ") AS t(type, declared, loss)"


@query("type_map", f"""
SELECT f.layer, f.pos, f.name, f.type, COALESCE(t.declared, 'string') AS declared, CASE WHEN t.type IS NULL THEN 'unknown type ' || f.type ELSE t.loss END AS loss
FROM ({plain(FIELDS)}) f LEFT JOIN {TYPES_SQL} ON f.type = t.type
""")
def type_map(spark, sf_dir):
    return catalog.declared_types(derive(spark, sf_dir, FIELDS), "hosted").select("layer", "pos", "name", "type", "declared", "loss")


@query("schema_projection", f"""
SELECT f.layer, f.pos, f.name, COALESCE(t.declared, 'string') AS declared, NOT nullable AS required, NULLIF(CASE WHEN trim(alias) <> '' THEN alias END, name) AS alias
FROM ({plain(FIELDS)}) f LEFT JOIN {TYPES_SQL} ON f.type = t.type WHERE f.type NOT IN ('esriFieldTypeGeometry', 'esriFieldTypeBlob', 'esriFieldTypeRaster')
""")
def schema_projection(spark, sf_dir):
    return catalog.schema_rows(derive(spark, sf_dir, FIELDS), "hosted")


@query("safe_names", """
WITH n AS (SELECT 'part' AS origin, p_partkey AS id, p_name AS name FROM part UNION ALL SELECT 'pages', page_id, url FROM pages)
SELECT origin, id, COALESCE(NULLIF(regexp_replace(regexp_replace(name, '[^A-Za-z0-9._-]', '_', 'g'), '^\\.+|\\.+$', '', 'g'), ''), 'unnamed') AS safe FROM n
""")
def safe_names(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(F.lit("part").alias("origin"), F.col("p_partkey").alias("id"), text.safe_name(F.col("p_name")).alias("safe"))
    return parts.unionByName(table(spark, sf_dir, "pages").select(F.lit("pages").alias("origin"), F.col("page_id").alias("id"), text.safe_name(F.col("url")).alias("safe")))


@query("epoch_to_rfc3339", """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN (epoch_us(ts) // 1000) % 1000 > 0 THEN '.' || lpad(CAST((epoch_us(ts) // 1000) % 1000 AS VARCHAR), 3, '0') ELSE '' END || 'Z' AS at FROM events
""")
def epoch_to_rfc3339(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", text.rfc3339(F.unix_millis(F.col("ts").cast("timestamp"))).alias("at"))


@query("typed_properties", """
SELECT event_id, CASE WHEN json_type(props, '$.k') IN ('BIGINT', 'UBIGINT') THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
  CASE WHEN json_type(props, '$.k') = 'VARCHAR' THEN json_extract_string(props, '$.k') END AS k_text FROM events
""")
def typed_properties(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    as_number = catalog.typed_properties(events, "props", {"k": "integer"})
    both = catalog.typed_properties(as_number.withColumnRenamed("typed", "typed_number"), "props", {"k": "string"})
    return both.select("event_id", F.get_json_object("typed_number", "$.k").cast("long").alias("k"), F.get_json_object("typed", "$.k").alias("k_text"))


@query("duplicate_name_suffix", """
SELECT p_partkey, CASE WHEN row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) > 1 THEN p_name || ' ' || p_partkey ELSE p_name END AS dataset FROM part
""")
def duplicate_name_suffix(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("name"))
    return catalog.suffix_duplicates(parts, "name", "p_partkey", "p_partkey").select("p_partkey", "dataset")


REFERENCES = """
SELECT s_suppkey AS id, CASE s_suppkey % 5 WHEN 0 THEN 4326 WHEN 1 THEN 26919 WHEN 2 THEN 102100 END AS code, CASE WHEN s_suppkey % 3 = 0 THEN 'LOCAL_CS' WHEN s_suppkey % 3 = 1 THEN ' ' END AS wkt,
  s_suppkey % 7 <> 0 AS has_geometry FROM {supplier}
"""
REFERENCE_SQL = "CASE WHEN code IS NULL AND wkt IS NULL THEN 'none' WHEN code = 4326 THEN 'working' WHEN code > 0 AND code < 33000 THEN 'code' WHEN trim(wkt) <> '' THEN 'wkt' ELSE 'unstatable' END"


@query("reference_plan", f"""
SELECT id, {REFERENCE_SQL} AS reference, CASE WHEN NOT has_geometry THEN 'rows only' WHEN {REFERENCE_SQL} = 'working' THEN 'straight' WHEN {REFERENCE_SQL} IN ('code', 'wkt') THEN 'through' ELSE 'refused' END AS plan
FROM ({plain(REFERENCES)})
""")
def reference_plan(spark, sf_dir):
    rows = derive(spark, sf_dir, REFERENCES)
    return rows.select("id", catalog.reference_class(F.col("code"), F.col("wkt")).alias("reference"), catalog.projection_plan(F.col("code"), F.col("wkt"), F.col("has_geometry")).alias("plan"))


@query("table_roles", """
SELECT p_partkey, CASE WHEN starts_with(upper(n), 'GDB_') THEN 'system' WHEN ends_with(upper(n), '__ATTACH') THEN 'attachments' ELSE 'user' END AS role
FROM (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'GDB_' || p_name WHEN 1 THEN p_name || '__ATTACH' ELSE p_name END AS n FROM part)
""")
def table_roles(spark, sf_dir):
    name = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("GDB_"), "p_name")).when(F.col("p_partkey") % 3 == 1, F.concat("p_name", F.lit("__ATTACH"))).otherwise(F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", catalog.table_role(name).alias("role"))


DOMAIN_FIELDS = "SELECT p_brand AS dataset, p_partkey AS pos, p_name AS name, CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_type END AS domain, CASE WHEN p_size % 2 = 0 THEN 'integer' ELSE 'string' END AS declared FROM {part} WHERE p_size % 7 < 2"
SUBTYPE_FIELDS = "SELECT p_brand AS dataset, p_partkey AS pos, p_name AS name, CASE WHEN p_size % 5 = 0 THEN p_type END AS domain, 'float' AS declared FROM {part}"


@query("domain_usage", f"""
WITH u AS (SELECT domain, 0 AS by_, pos, name FROM ({plain(DOMAIN_FIELDS)}) WHERE domain IS NOT NULL UNION ALL SELECT domain, 1, pos, name FROM ({plain(SUBTYPE_FIELDS)}) WHERE domain IS NOT NULL)
SELECT domain, string_agg(name, ', ' ORDER BY by_, pos, name) AS users, COUNT(*) AS n_users FROM u GROUP BY domain
""")
def domain_usage(spark, sf_dir):
    return catalog.domain_usage(derive(spark, sf_dir, DOMAIN_FIELDS), derive(spark, sf_dir, SUBTYPE_FIELDS))


#: Every third domain name is one that no field uses.
DOMAINS = "SELECT CASE WHEN p_partkey % 3 = 0 THEN concat(p_type, ' unused') ELSE p_type END AS domain FROM {part} UNION ALL SELECT concat(p_name, p_partkey) FROM {part}"
ONE_HOME = "SELECT p_brand AS dataset, p_partkey AS pos, CASE WHEN p_partkey % 2 = 0 THEN p_type ELSE concat(p_name, p_partkey) END AS domain, CASE WHEN p_size % 2 = 0 THEN 'integer' ELSE 'string' END AS declared FROM {part} WHERE p_size % 5 > 0"
BY_SUBTYPE = "SELECT p_brand AS dataset, p_partkey AS pos, CASE WHEN p_size % 3 > 0 THEN concat(p_name, p_partkey) END AS domain, 'float' AS declared FROM {part}"


@query("domain_fanout", f"""
WITH d AS (SELECT DISTINCT domain FROM ({plain(DOMAINS)})), h AS (SELECT domain, COUNT(DISTINCT dataset) AS n FROM ({plain(ONE_HOME)}) WHERE domain IS NOT NULL GROUP BY domain)
SELECT d.domain, COALESCE(n, 0) AS holders, CASE COALESCE(n, 0) WHEN 0 THEN 'nowhere to live' WHEN 1 THEN 'one home' ELSE 'separate copies' END AS state FROM d LEFT JOIN h ON d.domain = h.domain
""")
def domain_fanout(spark, sf_dir):
    return catalog.domain_fanout(derive(spark, sf_dir, DOMAINS), derive(spark, sf_dir, ONE_HOME))


@query("domain_types", f"""
WITH d AS (SELECT DISTINCT domain FROM ({plain(DOMAINS)})), f AS (SELECT domain, min_by(declared, pos) AS t FROM ({plain(ONE_HOME)}) WHERE domain IS NOT NULL GROUP BY 1),
s AS (SELECT domain, min_by(declared, pos) AS t FROM ({plain(BY_SUBTYPE)}) WHERE domain IS NOT NULL GROUP BY 1)
SELECT d.domain, COALESCE(f.t, s.t, 'string') AS declared FROM d LEFT JOIN f ON d.domain = f.domain LEFT JOIN s ON d.domain = s.domain
""")
def domain_types(spark, sf_dir):
    return catalog.domain_types(derive(spark, sf_dir, DOMAINS), derive(spark, sf_dir, ONE_HOME), derive(spark, sf_dir, BY_SUBTYPE))


@query("subtype_assignment", """
SELECT p_brand AS dataset, CAST(p_size AS VARCHAR) AS code, p_name AS field, p_type AS domain, MIN(p_partkey) OVER (PARTITION BY p_brand, p_type) AS domain_id FROM part
""")
def subtype_assignment(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(F.col("p_brand").alias("dataset"), F.col("p_size").cast("string").alias("code"), F.col("p_name").alias("field"), F.col("p_type").alias("domain"), "p_partkey")
    ids = parts.groupBy("dataset", "domain").agg(F.min("p_partkey").alias("domain_id"))
    return pairing.domain_ids(parts.drop("p_partkey"), ids)


@query("group_members", """
SELECT c_nationkey AS group_id, string_agg(c_name, ', ' ORDER BY c_custkey, c_name) AS members, COUNT(*) AS n_members FROM customer GROUP BY 1
""")
def group_members(spark, sf_dir):
    return catalog.group_members(table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("parent"), F.col("c_custkey").alias("pos"), F.col("c_name").alias("name")))


@query("uninterpreted_entries", "SELECT p_type AS kind, p_name || p_brand || p_size AS name FROM part WHERE p_size % 5 <> 0 AND p_name || p_brand || p_size NOT IN (SELECT p_name || p_brand || p_size FROM part WHERE p_partkey % 3 = 0)")
def uninterpreted_entries(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(F.when(F.col("p_size") % 5 == 0, "known").otherwise(F.col("p_type")).alias("kind"), F.concat("p_name", "p_brand", F.col("p_size").cast("string")).alias("name"), "p_partkey")
    return catalog.uninterpreted(parts.drop("p_partkey"), parts.where("p_partkey % 3 = 0"), ["known"])


@query("container_path", """
WITH RECURSIVE t AS (SELECT 'r' || r_regionkey AS id, 1 AS depth, 'Region[' || r_name || ']' AS path, r_regionkey AS k FROM region),
n AS (SELECT 'n' || n_nationkey AS id, 2 AS depth, t.path || '/Nation[' || n_name || ']' AS path, n_nationkey AS k FROM nation JOIN t ON n_regionkey = t.k),
c AS (SELECT 'c' || c_custkey AS id, 3 AS depth, n.path || '/Customer[' || c_name || ']' AS path FROM customer JOIN n ON c_nationkey = n.k),
p AS (SELECT p_partkey AS k, 1 AS depth, 'Part[' || p_name || ']' AS path FROM part WHERE p_partkey % 50 = 0
  UNION ALL SELECT p_partkey, p.depth + 1, p.path || '/Part[' || p_name || ']' FROM part JOIN p ON p_partkey = p.k + 1 WHERE p_partkey % 50 <> 0)
SELECT id, depth, path, CAST(NULL AS VARCHAR) AS reason FROM t UNION ALL SELECT id, depth, path, NULL FROM n UNION ALL SELECT id, depth, path, NULL FROM c
UNION ALL SELECT 'p' || k, depth, path, NULL FROM p
UNION ALL SELECT 'y' || r_regionkey, NULL, NULL, 'in or below a cycle' FROM region UNION ALL SELECT 's' || s_suppkey, NULL, NULL, CASE WHEN s_suppkey % 2 = 0 THEN 'in or below a cycle' ELSE 'below a parent that is not there' END FROM supplier
""")
def container_path(spark, sf_dir):
    nodes = derive(
        spark,
        sf_dir,
        """SELECT concat('r', r_regionkey) AS id, CAST(NULL AS STRING) AS parent, 'Region' AS element, r_name AS name FROM {region}
        UNION ALL SELECT concat('n', n_nationkey), concat('r', n_regionkey), 'Nation', n_name FROM {nation}
        UNION ALL SELECT concat('c', c_custkey), concat('n', c_nationkey), 'Customer', c_name FROM {customer}
        UNION ALL SELECT concat('p', p_partkey), CASE WHEN p_partkey % 50 <> 0 THEN concat('p', p_partkey - 1) END, 'Part', p_name FROM {part}
        UNION ALL SELECT concat('y', r_regionkey), concat('y', (r_regionkey + 1) % 5), 'Region', r_name FROM {region}
        UNION ALL SELECT concat('s', s_suppkey), CASE WHEN s_suppkey % 2 = 0 THEN 'y0' WHEN s_suppkey > 1 THEN concat('s', s_suppkey - 2) ELSE 'nowhere' END, 'Supplier', s_name FROM {supplier}""",
    )
    return forest.container_paths(nodes)


ENDS = """
SELECT p_partkey AS layer_id, p_size AS rel_id, p_name AS name, p_partkey + 1 AS related_id, 'origin' AS role,
  CASE p_partkey % 3 WHEN 0 THEN 'one to one' WHEN 1 THEN 'one to many' ELSE 'many to many' END AS cardinality, 'key' AS key_field, p_size % 2 = 0 AS composite FROM {part}
UNION ALL
SELECT p_partkey + 1, p_size, p_name, p_partkey, 'destination', 'one to many', CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_brand END, false FROM {part} WHERE p_partkey % 5 <> 0
"""
ENDS_SQL = f"""
WITH e AS ({plain(ENDS)}), p AS (
SELECT o.rel_id, o.name, o.layer_id AS origin_id, o.related_id, o.cardinality, o.composite, d.key_field AS destination_key
FROM e o LEFT JOIN e d ON o.related_id = d.layer_id AND o.rel_id = d.rel_id AND d.role = 'destination' WHERE o.role = 'origin')
"""


@query("rel_end_pairing", ENDS_SQL + "SELECT rel_id, name, origin_id, related_id, cardinality, destination_key, composite FROM p")
def rel_end_pairing(spark, sf_dir):
    return pairing.relationship_pairs(derive(spark, sf_dir, ENDS)).select("rel_id", "name", "origin_id", "related_id", "cardinality", "destination_key", "composite")


@query("rel_resolution", ENDS_SQL + """, ds AS (SELECT p_partkey AS layer_id, p_name || p_partkey AS dataset FROM part WHERE p_partkey % 11 <> 0)
SELECT p.rel_id, p.name, a.dataset AS origin, b.dataset AS destination, p.destination_key AS key_field, p.cardinality,
  CASE WHEN a.dataset IS NULL THEN 'origin is not extracted' WHEN b.dataset IS NULL THEN 'destination is not extracted'
       WHEN cardinality NOT IN ('one to one', 'one to many') THEN 'cannot be ' || cardinality WHEN destination_key IS NULL THEN 'no key on the destination' END AS reason
FROM p LEFT JOIN ds a ON p.origin_id = a.layer_id LEFT JOIN ds b ON p.related_id = b.layer_id
""")
def rel_resolution(spark, sf_dir):
    datasets = table(spark, sf_dir, "part").where("p_partkey % 11 <> 0").select(F.col("p_partkey").alias("layer_id"), F.concat("p_name", F.col("p_partkey").cast("string")).alias("dataset"))
    return pairing.resolve_relationships(pairing.relationship_pairs(derive(spark, sf_dir, ENDS)), datasets)


FILE_RELATIONSHIPS = """
SELECT p_name AS name, p_brand AS origin, p_type AS destination, concat('o', p_size) AS origin_key, concat('d', p_partkey) AS destination_key,
  CASE WHEN p_partkey % 2 = 0 THEN 'has' END AS forward_label, 'of' AS backward_label, CASE p_partkey % 3 WHEN 0 THEN 'many to one' WHEN 1 THEN 'one to many' ELSE 'one to one' END AS cardinality FROM {part}
"""


@query("many_to_one_reversal", f"""
WITH r AS ({plain(FILE_RELATIONSHIPS)}) SELECT name, CASE WHEN t THEN destination ELSE origin END AS origin, CASE WHEN t THEN origin ELSE destination END AS destination,
 CASE WHEN t THEN destination_key ELSE origin_key END AS origin_key, CASE WHEN t THEN origin_key ELSE destination_key END AS destination_key,
 CASE WHEN t THEN backward_label ELSE forward_label END AS forward_label, CASE WHEN t THEN forward_label ELSE backward_label END AS backward_label, CASE WHEN t THEN 'one to many' ELSE cardinality END AS cardinality
FROM (SELECT *, cardinality = 'many to one' AS t FROM r)
""")
def many_to_one_reversal(spark, sf_dir):
    return pairing.forward_relationships(derive(spark, sf_dir, FILE_RELATIONSHIPS))


@query("rel_orphans", "SELECT l_orderkey, COUNT(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 9 <> 0) GROUP BY 1")
def rel_orphans(spark, sf_dir):
    _, orphans = pairing.with_parents(table(spark, sf_dir, "lineitem").select("l_orderkey"), table(spark, sf_dir, "orders").where("o_orderkey % 9 <> 0"), "l_orderkey", "o_orderkey")
    return orphans.groupBy("l_orderkey").agg(F.count("*").alias("n"))


@query("orphan_blob_tables", "SELECT p_partkey AS id, p_name || p_brand || '__ATTACH' AS name FROM part WHERE p_partkey % 3 = 1 AND p_name || p_brand NOT IN (SELECT p_name || p_brand FROM part WHERE p_size % 2 = 0)")
def orphan_blob_tables(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    tables = parts.select(F.col("p_partkey").alias("id"), F.concat("p_name", "p_brand", F.lit("__ATTACH")).alias("name")).withColumn("role", F.when(F.col("id") % 3 == 1, catalog.table_role(F.col("name"))))
    media = parts.select(F.concat("p_name", "p_brand", F.lit("__ATTACH")).alias("destination"), (F.col("p_size") % 2 == 0).alias("is_media"))
    return pairing.orphan_blob_tables(tables, media).select("id", "name")


@query("layer_reconciliation", """
WITH n AS (SELECT DISTINCT p_name AS name FROM part), least AS (SELECT MIN(name) AS m FROM n)
SELECT name, CASE WHEN name = m THEN 'renamed ' || m ELSE name END AS exported, CASE WHEN name = m THEN 'renamed' ELSE 'exact' END AS state FROM n, least
""")
def layer_reconciliation(spark, sf_dir):
    names = table(spark, sf_dir, "part").select(F.col("p_name").alias("name")).distinct()
    least = names.agg(F.min("name").alias("m"))
    exported = names.join(F.broadcast(least), names["name"] == least["m"], "left").select(F.when(F.col("m").isNotNull(), F.concat(F.lit("renamed "), "m")).otherwise(F.col("name")).alias("name"))
    return pairing.reconcile_names(names, exported)


@query("dropped_fields", "SELECT p_brand AS dataset, p_name AS field FROM part WHERE (p_brand, p_name) NOT IN (SELECT (p_brand, p_name) FROM part WHERE p_partkey % 10 <> 0)")
def dropped_fields(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(F.col("p_brand").alias("dataset"), F.col("p_name").alias("field"), "p_partkey")
    return pairing.dropped_fields(parts, parts.where("p_partkey % 10 <> 0"))


@query("row_count_audit", "SELECT l_returnflag || l_linestatus AS dataset, COUNT(*) AS source_rows, COUNT(*) FILTER (l_returnflag <> 'R' OR l_partkey % 50 <> 0) AS copy_rows FROM lineitem GROUP BY 1 HAVING source_rows <> copy_rows")
def row_count_audit(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("dataset"), (F.col("l_returnflag") != "R").alias("stays"), "l_partkey")
    count = lambda df: df.groupBy("dataset").agg(F.count("*").alias("n"))
    return pairing.row_count_audit(count(lines), count(lines.where("stays or l_partkey % 50 <> 0")))


def _layers(spark, sf_dir):
    fields = derive(spark, sf_dir, FIELDS)
    own = F.array_sort(F.collect_list(F.struct("pos", "name", "type", F.nullif(F.when(F.trim("alias") != "", F.col("alias")), F.col("name")).alias("alias"))))
    grouped = fields.groupBy("layer").agg(own.alias("fields"), F.count("*").alias("n"))
    return grouped.withColumns({
        "geometry_type": F.when(F.col("n") % 4 != 0, "point"),
        "code": F.when(F.col("n") % 3 == 0, 4326).when(F.col("n") % 3 == 1, 26919),
        "wkt": F.when(F.col("n") % 2 == 0, "LOCAL_CS"),
        "has_attachments": F.col("n") % 5 != 0,
        "can_list_attachments": F.col("n") % 2 == 1,
    })


def _domain_rows(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    rows = parts.groupBy(F.col("p_type").alias("domain")).agg(F.countDistinct("p_brand").alias("n_bindings"), F.count("*").alias("n"))
    return rows.withColumns({"kind_of_domain": F.when(F.col("n") % 7 == 0, "glob").otherwise("coded"), "in_subtypes": F.col("n") % 2 == 0})


def _items(spark, sf_dir):
    layers = rules.judge(_layers(spark, sf_dir), "layer", rules.HOSTED, "layer", "concat(cast(n as string), ' fields')")
    return layers.unionByName(rules.judge(_domain_rows(spark, sf_dir), "domain", rules.HOSTED, "domain", "kind_of_domain"))


ITEMS_SQL = f"""
WITH f AS (SELECT layer, pos, name, type, NULLIF(CASE WHEN trim(alias) <> '' THEN alias END, name) AS alias FROM ({plain(FIELDS)})),
l AS (SELECT layer, COUNT(*) AS n, bool_or(alias IS NOT NULL) AS aliased, string_agg(name, ', ' ORDER BY pos) FILTER (type = 'esriFieldTypeDate') AS dates, bool_or(type = 'esriFieldTypeBlob') AS blobs FROM f GROUP BY layer),
x AS (SELECT *, n % 4 <> 0 AS geo, CASE n % 3 WHEN 0 THEN 4326 WHEN 1 THEN 26919 END AS code, n % 2 = 0 AS wkt FROM l),
layers AS (SELECT layer AS location, 'layer' AS kind, n || ' fields' AS detail, concat_ws('; ',
  CASE WHEN aliased THEN 'aliases are kept but never shown' END, 'dates and times become text: ' || dates, CASE WHEN blobs THEN 'binary values stay behind' END,
  CASE WHEN geo AND code IS NULL AND NOT wkt THEN 'no spatial reference is stated' END, CASE WHEN geo AND code IS NOT NULL AND code <> 4326 THEN 'shapes are transformed from ' || code END,
  CASE WHEN geo AND code IS NULL AND wkt THEN 'shapes are transformed from a custom reference' END, CASE WHEN NOT geo THEN 'rows get an empty geometry' END,
  CASE WHEN n % 5 <> 0 AND n % 2 = 0 THEN 'attachments have to be listed row by row' END) AS losses, NULL AS reason FROM x),
d AS (SELECT p_type AS domain, COUNT(DISTINCT p_brand) AS b, COUNT(*) AS n FROM part GROUP BY 1),
domains AS (SELECT domain AS location, 'domain' AS kind, CASE WHEN n % 7 = 0 THEN 'glob' ELSE 'coded' END AS detail,
  CASE WHEN n % 7 <> 0 AND b > 0 AND n % 2 = 1 THEN 'bound by ' || b || ' fields, and bindings outside subtypes are not kept' ELSE '' END AS losses,
  CASE WHEN n % 7 = 0 THEN 'domains of kind glob have no counterpart' END AS reason FROM d),
items AS (SELECT *, CASE WHEN reason IS NOT NULL THEN 'unsupported' WHEN losses <> '' THEN 'approximated' ELSE 'faithful' END AS outcome FROM (SELECT * FROM layers UNION ALL SELECT * FROM domains))
"""


@query("verdict_items", ITEMS_SQL + "SELECT location, kind, detail, outcome, CASE WHEN reason IS NULL THEN CASE kind WHEN 'layer' THEN 'dataset' ELSE 'domain' END END AS target, losses, reason FROM items")
def verdict_items(spark, sf_dir):
    return _items(spark, sf_dir).withColumn("losses", F.array_join("losses", "; "))


@query("verdict_counts", ITEMS_SQL + """SELECT COUNT(*) FILTER (outcome = 'faithful') AS faithful, COUNT(*) FILTER (outcome = 'approximated') AS approximated,
  COUNT(*) FILTER (outcome = 'unsupported') AS unsupported, COUNT(*) FILTER (outcome = 'not_applicable') AS not_applicable, COUNT(*) AS items FROM items""")
def verdict_counts(spark, sf_dir):
    return tally.outcome_counts(_items(spark, sf_dir))


LOG_SQL = """
WITH i AS (SELECT p_partkey AS seq, p_name AS location, p_brand AS kind, CASE p_partkey % 4 WHEN 0 THEN 'faithful' WHEN 1 THEN 'approximated' WHEN 2 THEN 'unsupported' ELSE 'not_applicable' END AS outcome FROM part),
p AS (SELECT p_partkey AS seq, p_name AS location, p_brand AS kind, p_type AS dataset FROM part WHERE p_partkey % 3 <> 0),
a AS (SELECT *, row_number() OVER (PARTITION BY location, kind ORDER BY seq) AS o FROM i), b AS (SELECT location, kind, dataset, row_number() OVER (PARTITION BY location, kind ORDER BY seq) AS o FROM p),
j AS (SELECT a.*, b.dataset, a.outcome IN ('unsupported', 'not_applicable') AS refused FROM a LEFT JOIN b ON a.location = b.location AND a.kind = b.kind AND a.o = b.o),
log AS (SELECT seq, location, kind, CASE WHEN refused OR dataset IS NULL THEN 'skipped' WHEN outcome = 'approximated' THEN 'carried_with_loss' ELSE 'carried' END AS state,
  CASE WHEN NOT refused THEN dataset END AS dataset, CASE WHEN NOT refused AND dataset IS NOT NULL AND outcome = 'approximated' THEN 'lost ' || seq END AS loss,
  CASE WHEN refused THEN 'no ' || seq WHEN dataset IS NULL THEN 'it was not placed' END AS reason FROM j)
"""


def _log(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("seq"), F.col("p_name").alias("location"), F.col("p_brand").alias("kind"), F.col("p_type").alias("dataset"))
    number, word = F.col("seq") % 4, F.col("seq").cast("string")
    outcome = F.when(number == 0, "faithful").when(number == 1, "approximated").when(number == 2, "unsupported").otherwise("not_applicable")
    items = parts.select("seq", "location", "kind", outcome.alias("outcome"), F.array(F.concat(F.lit("lost "), word)).alias("losses"), F.concat(F.lit("no "), word).alias("reason"))
    return rules.log_items(items, parts.where("seq % 3 <> 0"))


@query("log_from_verdict", LOG_SQL + "SELECT * FROM log")
def log_from_verdict(spark, sf_dir):
    return _log(spark, sf_dir)


@query("log_counts", LOG_SQL + "SELECT COUNT(*) FILTER (state = 'carried') AS carried, COUNT(*) FILTER (state = 'carried_with_loss') AS carried_with_loss, COUNT(*) FILTER (state = 'skipped') AS skipped FROM log")
def log_counts(spark, sf_dir):
    return tally.log_counts(_log(spark, sf_dir))
