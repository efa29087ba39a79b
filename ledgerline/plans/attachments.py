"""Queries over attachments: `events` stand in for listings, edits and loaded copies."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import attachment_feed as feed
from ..operators import pairing
from ..session import table
from ..sources import logs
from .base import derive, plain, query

BASIS = "SELECT event_id AS pos, user_id AS oid, event_type AS name, CASE WHEN event_id % 4 = 0 THEN CAST(CAST(floor(event_id / 8) AS BIGINT) AS STRING) END AS global_id, CAST(event_id % 97 AS BIGINT) AS size, CASE WHEN event_id % 5 = 0 THEN 'image/png' END AS content_type FROM {events} WHERE event_id % 10 < 3"
LISTED = "SELECT event_id AS pos, user_id AS oid, CASE WHEN event_id % 101 = 0 THEN NULL ELSE event_type END AS name, CASE WHEN event_id % 4 = 0 THEN CAST(CAST(floor(event_id / 8) AS BIGINT) AS STRING) END AS global_id, CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(event_id % 97 + CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END AS BIGINT) END AS size, CASE WHEN event_id % 5 = 0 THEN 'image/png' END AS content_type FROM {events} WHERE event_id % 10 BETWEEN 1 AND 5"


def moved_sql(a: str, b: str, at: str, bt: str) -> str:
    """The moved test in SQL: null where nothing can be compared."""
    return f"""CASE WHEN ({a} IS NOT NULL AND {b} IS NOT NULL) OR ({at} IS NOT NULL AND {bt} IS NOT NULL) THEN
      ({a} IS NOT NULL AND {b} IS NOT NULL AND {a} <> {b}) OR ({at} IS NOT NULL AND {bt} IS NOT NULL AND {at} <> {bt}) END"""


@query("attachment_diff", f"""
WITH b AS ({plain(BASIS)}), l AS ({plain(LISTED)}), parents AS (SELECT DISTINCT user_id AS oid FROM events WHERE user_id % 11 <> 0),
kb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY global_id ORDER BY pos DESC) AS n FROM b WHERE global_id IS NOT NULL) WHERE n = 1),
kl AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY global_id ORDER BY pos DESC) AS n FROM l WHERE global_id IS NOT NULL) WHERE n = 1),
paired AS (SELECT kl.oid, kl.name, kl.global_id, {moved_sql('kb.size', 'kl.size', 'kb.content_type', 'kl.content_type')} AS m FROM kb JOIN kl ON kb.global_id = kl.global_id),
rb AS (SELECT * FROM b WHERE global_id IS NULL OR global_id NOT IN (SELECT global_id FROM paired)), rl AS (SELECT * FROM l WHERE global_id IS NULL OR global_id NOT IN (SELECT global_id FROM paired)),
gb AS (SELECT oid, name, COUNT(*) AS n, MIN(size) AS size, MIN(content_type) AS type, MIN(global_id) AS id FROM rb WHERE name IS NOT NULL AND oid IS NOT NULL GROUP BY 1, 2),
gl AS (SELECT oid, name, COUNT(*) AS n, MIN(size) AS size, MIN(content_type) AS type, MIN(global_id) AS id FROM rl WHERE name IS NOT NULL AND oid IS NOT NULL GROUP BY 1, 2),
g AS (SELECT COALESCE(gb.oid, gl.oid) AS oid, COALESCE(gb.name, gl.name) AS name, COALESCE(gl.id, gb.id) AS global_id, gb.n AS bn, gl.n AS ln, {moved_sql('gb.size', 'gl.size', 'gb.type', 'gl.type')} AS m
      FROM gb FULL OUTER JOIN gl ON gb.oid = gl.oid AND gb.name = gl.name)
SELECT oid, name, global_id, CASE WHEN m IS NULL THEN 'incomparable' WHEN m THEN 'replace' ELSE 'unchanged' END AS op FROM paired
UNION ALL
SELECT g.oid, g.name, g.global_id, CASE WHEN bn IS NULL AND p.oid IS NULL THEN 'orphan' WHEN bn IS NULL THEN 'add' WHEN ln IS NULL THEN 'delete' WHEN bn > 1 OR ln > 1 THEN 'ambiguous' WHEN m IS NULL THEN 'incomparable' WHEN m THEN 'replace' ELSE 'unchanged' END
FROM g LEFT JOIN parents p ON g.oid = p.oid
UNION ALL SELECT oid, name, global_id, 'refused' FROM rb WHERE name IS NULL OR oid IS NULL
UNION ALL SELECT oid, name, global_id, 'refused' FROM rl WHERE name IS NULL OR oid IS NULL
""")
def attachment_diff(spark, sf_dir):
    parents = table(spark, sf_dir, "events").where("user_id % 11 <> 0").select(F.col("user_id").alias("oid"))
    return pairing.attachment_diff(derive(spark, sf_dir, BASIS), derive(spark, sf_dir, LISTED), parents)


#: Forty events in a row are a dataset; few parents and names, so that names repeat, and ids of rows with other names.
SAME = "CAST(floor(event_id / 40) AS BIGINT) AS dataset, {order}, {gid} AS global_id, user_id % 3 AS oid, {name} AS name"
SIZED = "CASE WHEN event_id % 9 = 0 THEN NULL ELSE CAST(event_id % 4 AS BIGINT) END AS size, CASE WHEN event_id % 8 = 0 THEN 'image/png' END AS content_type"
FEED_BASIS = f"SELECT {SAME.format(order='event_id AS pos', gid='CASE WHEN event_id % 5 <> 4 THEN CAST(event_id AS STRING) END', name='event_type')}, concat('f', user_id % 3) AS feature_id, {SIZED} FROM {{events}} WHERE event_id % 10 < 5"
ADD_ID = "CASE event_id % 6 WHEN 0 THEN CAST(event_id AS STRING) WHEN 1 THEN CAST(event_id - event_id % 10 + 1 AS STRING) WHEN 2 THEN CAST(event_id - event_id % 40 + 2 AS STRING) WHEN 3 THEN CAST(event_id - 3 AS STRING) END"
ADDS = f"SELECT {SAME.format(order='event_id AS seq', gid=ADD_ID, name='CASE WHEN event_id % 29 <> 0 THEN event_type END')}, CASE WHEN user_id % 11 <> 0 THEN concat('f', user_id % 3) END AS feature_id, {SIZED} FROM {{events}} WHERE event_id % 10 BETWEEN 3 AND 8"
EDIT = "SELECT CAST(floor(event_id / 40) AS BIGINT) AS dataset, event_id AS seq, {gid} AS global_id, {more} FROM {{events}} WHERE event_id % 10 {window}"
UPDATES = EDIT.format(gid="CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN CAST(event_id - event_id % 10 + 1 AS STRING) ELSE CAST(event_id - event_id % 5 AS STRING) END", more=f"event_type AS name, {SIZED}", window="IN (2, 6, 8, 9)")
DELETES = EDIT.format(gid="CASE event_id % 3 WHEN 0 THEN CAST(event_id - event_id % 10 + 1 AS STRING) ELSE CAST(event_id AS STRING) END", more="0 AS nothing", window="IN (0, 3, 6, 9)")
#: The edits in order, one add after the other; each takes from what those before it left.
FEED_SQL = f"""
WITH RECURSIVE b AS (SELECT *, global_id IS NOT NULL AND row_number() OVER (PARTITION BY dataset, global_id ORDER BY pos DESC) = 1 AS of_id FROM ({plain(FEED_BASIS)})),
x AS ({plain(ADDS)}), u AS ({plain(UPDATES)}), d AS ({plain(DELETES)}), a AS (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY seq) AS i FROM x WHERE feature_id IS NOT NULL),
run AS (
  SELECT DISTINCT dataset, CAST(0 AS BIGINT) AS i, CAST([] AS BIGINT[]) AS used, CAST(NULL AS BIGINT) AS pos, CAST(0 AS BIGINT) AS same FROM a
  UNION ALL
  SELECT dataset, i, CASE WHEN COALESCE(by_id, by_name) IS NULL THEN used ELSE list_append(used, COALESCE(by_id, by_name)) END, COALESCE(by_id, by_name), CASE WHEN by_id IS NULL THEN same ELSE 1 END
  FROM (SELECT dataset, i, used, by_id, CASE WHEN same = 1 THEN one END AS by_name, same FROM (
    SELECT r.dataset, a.i, any_value(r.used) AS used, MIN(b.pos) FILTER (b.of_id AND b.global_id = a.global_id) AS by_id,
           COUNT(b.pos) FILTER (b.oid = a.oid AND b.name = a.name) AS same, MIN(b.pos) FILTER (b.oid = a.oid AND b.name = a.name) AS one
    FROM run r JOIN a ON a.dataset = r.dataset AND a.i = r.i + 1 LEFT JOIN b ON b.dataset = r.dataset AND NOT list_contains(r.used, b.pos) GROUP BY r.dataset, a.i))
), j AS (
  SELECT a.*, run.same > 1 AS crowded, b.pos AS held, b.global_id AS held_id, b.oid AS held_oid, b.name AS held_name, b.feature_id AS held_feature, b.size AS held_size, b.content_type AS held_type,
         CASE WHEN (a.size IS NOT NULL AND b.size IS NOT NULL) OR (a.content_type IS NOT NULL AND b.content_type IS NOT NULL) THEN (a.size IS NOT NULL AND a.size IS DISTINCT FROM b.size) OR (a.content_type IS NOT NULL AND a.content_type IS DISTINCT FROM b.content_type) END AS m
  FROM a JOIN run ON run.dataset = a.dataset AND run.i = a.i LEFT JOIN b ON b.dataset = a.dataset AND b.pos = run.pos
), k AS (SELECT *, CASE WHEN crowded THEN 'ambiguous' WHEN held IS NULL THEN 'add' WHEN m IS NULL THEN 'replace_unseen' WHEN m THEN 'replace' ELSE 'repeat' END AS op, COALESCE(name, global_id, 'unnamed') AS said FROM j),
entry AS (
  SELECT dataset, seq, COALESCE(global_id, held_id) AS global_id, CASE WHEN op = 'repeat' THEN COALESCE(oid, held_oid) ELSE oid END AS oid, CASE WHEN held IS NULL THEN said ELSE held_name END AS name,
         CASE WHEN held IS NULL THEN feature_id ELSE held_feature END AS feature_id, CASE WHEN op = 'repeat' THEN held_size ELSE size END AS size, CASE WHEN op = 'repeat' THEN held_type ELSE content_type END AS content_type, held_id
  FROM k WHERE op <> 'ambiguous'
), idx AS (
  SELECT dataset, global_id, oid, name, feature_id, size, content_type FROM b WHERE of_id AND NOT EXISTS (SELECT 1 FROM entry e WHERE e.dataset = b.dataset AND b.global_id IN (e.held_id, e.global_id))
  UNION ALL SELECT dataset, global_id, oid, name, feature_id, size, content_type FROM entry WHERE global_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY dataset, global_id ORDER BY seq DESC) = 1
)"""


@query("attachment_feed", f"""{FEED_SQL}
SELECT dataset, 'adds' AS phase, seq, op, global_id, CASE WHEN held IS NULL THEN feature_id ELSE held_feature END AS feature_id, CASE WHEN held IS NULL THEN said ELSE held_name END AS name, held IS NOT NULL AND said <> held_name AS renamed FROM k
UNION ALL SELECT dataset, 'adds', seq, 'orphan', global_id, NULL, COALESCE(name, global_id, 'unnamed'), false FROM x WHERE feature_id IS NULL
UNION ALL SELECT u.dataset, 'updates', seq, CASE WHEN u.global_id IS NULL THEN 'no_id' WHEN idx.global_id IS NULL THEN 'unknown' ELSE 'replace' END, u.global_id, idx.feature_id, idx.name, COALESCE(u.name <> idx.name, false)
  FROM u LEFT JOIN idx ON idx.dataset = u.dataset AND idx.global_id = u.global_id
UNION ALL SELECT d.dataset, 'deletes', seq, CASE WHEN first THEN 'delete' ELSE 'unknown' END, d.global_id, CASE WHEN first THEN idx.feature_id END, CASE WHEN first THEN idx.name END, false
  FROM (SELECT *, row_number() OVER (PARTITION BY dataset, global_id ORDER BY seq) AS nth FROM d) d LEFT JOIN idx ON idx.dataset = d.dataset AND idx.global_id = d.global_id, LATERAL (SELECT idx.global_id IS NOT NULL AND nth = 1 AS first)
""")
def attachment_feed(spark, sf_dir):
    return feed.attachment_feed(*[derive(spark, sf_dir, sql) for sql in (FEED_BASIS, ADDS, UPDATES, DELETES)]).results


@query("attachment_feed_index", f"""{FEED_SQL}, fresh AS (SELECT dataset, global_id, arg_max(size, seq) FILTER (size IS NOT NULL) AS size, arg_max(content_type, seq) FILTER (content_type IS NOT NULL) AS content_type FROM u GROUP BY 1, 2)
SELECT idx.dataset, idx.global_id, oid, name, feature_id, COALESCE(fresh.size, idx.size) AS size, COALESCE(fresh.content_type, idx.content_type) AS content_type
FROM idx LEFT JOIN fresh ON fresh.dataset = idx.dataset AND fresh.global_id = idx.global_id WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.dataset = idx.dataset AND d.global_id = idx.global_id)
""")
def attachment_feed_index(spark, sf_dir):
    return feed.attachment_feed(*[derive(spark, sf_dir, sql) for sql in (FEED_BASIS, ADDS, UPDATES, DELETES)]).index


LOADED = "SELECT user_id AS feature_id, event_type AS name, CAST(event_id AS STRING) AS payload FROM {events} WHERE event_id % 7 = 0"
OPS = "SELECT CASE event_id % 3 WHEN 0 THEN 'replace' WHEN 1 THEN 'delete' ELSE 'add' END AS op, user_id AS feature_id, event_type AS name, concat('new ', event_id) AS payload FROM {events} WHERE event_id % 50 = 1"


@query("loaded_copy_match", f"""
WITH h AS (SELECT feature_id, name, COUNT(*) AS n FROM ({plain(LOADED)}) GROUP BY 1, 2)
SELECT o.*, CASE WHEN h.n IS NULL THEN 'none' WHEN h.n = 1 THEN 'one' ELSE 'many' END AS copies FROM ({plain(OPS)}) o LEFT JOIN h ON o.feature_id = h.feature_id AND o.name = h.name
""")
def loaded_copy_match(spark, sf_dir):
    return pairing.loaded_copies(derive(spark, sf_dir, OPS), derive(spark, sf_dir, LOADED))


@query("attachment_apply", f"""
WITH l AS ({plain(LOADED)}), o AS ({plain(OPS)}), h AS (SELECT feature_id, name, COUNT(*) AS n FROM l GROUP BY 1, 2), m AS (SELECT o.* FROM o JOIN h ON o.feature_id = h.feature_id AND o.name = h.name AND h.n = 1 WHERE op <> 'add')
SELECT * FROM l WHERE (feature_id, name) NOT IN (SELECT (feature_id, name) FROM m) UNION ALL SELECT feature_id, name, payload FROM m WHERE op = 'replace' UNION ALL SELECT feature_id, name, payload FROM o WHERE op = 'add'
""")
def attachment_apply(spark, sf_dir):
    return pairing.apply_attachments(derive(spark, sf_dir, LOADED), derive(spark, sf_dir, OPS))


ATTACHMENT_INDEX = "SELECT CAST(event_id AS STRING) AS global_id, CAST(user_id AS STRING) AS feature_id, event_type AS name, CAST(event_id % 50 AS BIGINT) AS size, CAST(NULL AS STRING) AS content_type FROM {events} WHERE event_id % 3 = 0"
RESULTS = "SELECT CAST(event_id + 1 AS STRING) AS global_id, CASE WHEN event_id % 4 = 0 THEN CAST(event_id AS STRING) END AS previous_id, CASE WHEN event_id % 5 = 0 THEN 'delete' ELSE 'add' END AS op, CAST(user_id AS STRING) AS feature_id, event_type AS name, CAST(7 AS BIGINT) AS size, 'text/plain' AS content_type FROM {events} WHERE event_id % 6 < 2"


@query("attachment_index_rollforward", f"""
WITH i AS ({plain(ATTACHMENT_INDEX)}), r AS ({plain(RESULTS)}), stale AS (SELECT previous_id AS global_id FROM r WHERE previous_id IS NOT NULL UNION SELECT global_id FROM r)
SELECT * FROM i WHERE global_id NOT IN (SELECT global_id FROM stale) UNION ALL SELECT global_id, feature_id, name, size, content_type FROM r WHERE op <> 'delete'
""")
def attachment_index_rollforward(spark, sf_dir):
    return pairing.roll_attachment_index(derive(spark, sf_dir, ATTACHMENT_INDEX), derive(spark, sf_dir, RESULTS))


@query("blob_paths", """
SELECT event_id, event_type || '/' || (row_number() OVER (PARTITION BY event_type ORDER BY feature_id, name) - 1) || '-' || regexp_replace(name, '[^A-Za-z0-9._-]', '_', 'g') AS file
FROM (SELECT event_id, event_type, CAST(user_id AS VARCHAR) AS feature_id, 'file ' || event_id || '.png' AS name FROM events)
""")
def blob_paths(spark, sf_dir):
    name = F.concat(F.lit("file "), F.col("event_id").cast("string"), F.lit(".png"))
    blobs = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("dataset"), F.col("user_id").cast("string").alias("feature_id"), name.alias("name"))
    return logs.blob_paths(blobs).select("event_id", "file")


@query("missing_originals", "SELECT vec_id, vec_id % 3 <> 0 AND vec_id % 5 = 0 AS missing FROM embeddings")
def missing_originals(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    rows = vectors.select("vec_id", F.when(F.col("vec_id") % 3 != 0, F.col("embedding")).alias("geometry"))
    return pairing.original_geometry(rows, vectors.where("vec_id % 5 <> 0").select("vec_id", F.col("embedding").alias("geometry")), "vec_id").select("vec_id", "missing")
