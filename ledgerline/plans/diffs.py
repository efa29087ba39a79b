"""Queries over snapshots, change feeds, indexes and streams."""

from __future__ import annotations


from pyspark.sql import functions as F

from ..functions.hashing import content_hash, feature_id
from ..operators import batches, diff, tally
from ..session import own_place, stored, table
from ..streaming import classify
from .base import derive, plain, query

STATE = ["o_custkey", "o_orderstatus", "o_totalprice"]

PREVIOUS = """
SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
FROM {orders} WHERE o_orderkey % 20 <> 0
UNION ALL
SELECT o_orderkey + 10000000 AS o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM {orders} WHERE o_orderkey % 50 = 0
"""

DIFF_SQL = f"""
SELECT COALESCE(c.o_orderkey, p.o_orderkey) AS o_orderkey,
  CASE WHEN p.o_orderkey IS NULL THEN 'insert' WHEN c.o_orderkey IS NULL THEN 'delete'
       WHEN c.o_custkey IS DISTINCT FROM p.o_custkey OR c.o_orderstatus IS DISTINCT FROM p.o_orderstatus OR c.o_totalprice IS DISTINCT FROM p.o_totalprice THEN 'update'
       ELSE 'unchanged' END AS op
FROM orders c FULL OUTER JOIN ({plain(PREVIOUS)}) p ON c.o_orderkey = p.o_orderkey
"""


def _order_diff(spark, sf_dir):
    key = [F.col("o_orderkey")]
    return diff.snapshot_diff(derive(spark, sf_dir, PREVIOUS), table(spark, sf_dir, "orders"), ["o_orderkey"], STATE, key, key)


@query("snapshot_diff", DIFF_SQL)
def snapshot_diff(spark, sf_dir):
    return _order_diff(spark, sf_dir).select("o_orderkey", "op")


@query("delta_counts", f"""
SELECT CAST(COUNT(*) FILTER (op = 'insert') AS BIGINT) AS inserted, CAST(COUNT(*) FILTER (op = 'update') AS BIGINT) AS updated,
       CAST(COUNT(*) FILTER (op = 'delete') AS BIGINT) AS deleted, CAST(COUNT(*) FILTER (op = 'unchanged') AS BIGINT) AS unchanged FROM ({DIFF_SQL})
""")
def delta_counts(spark, sf_dir):
    return diff.delta_counts(_order_diff(spark, sf_dir))


@query("delta_apply_roundtrip", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def delta_apply_roundtrip(spark, sf_dir):
    previous, current, key = derive(spark, sf_dir, PREVIOUS), table(spark, sf_dir, "orders"), [F.col("o_orderkey")]
    ops = stored(diff.operations(previous, current, ["o_orderkey"], STATE, key, key), "operations")
    return diff.apply_operations(previous, ops, ["o_orderkey"], STATE)


LINE_STATE = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag"]
PREVIOUS_LINES = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_suppkey % 7 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity, l_extendedprice, l_returnflag
FROM {lineitem} WHERE l_partkey % 20 <> 0
"""


@query("snapshot_diff_dup_keys", f"""
WITH previous AS ({plain(PREVIOUS_LINES)}),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_returnflag DESC) AS nth FROM previous) WHERE nth = 1),
c AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag) AS nth FROM lineitem)
SELECT COALESCE(c.l_orderkey, p.l_orderkey) AS l_orderkey, COALESCE(c.l_linenumber, p.l_linenumber) AS l_linenumber, CAST(COALESCE(c.nth, 1) AS INTEGER) AS ordinal,
  CASE WHEN p.l_orderkey IS NULL THEN 'insert' WHEN c.l_orderkey IS NULL THEN 'delete'
       WHEN (c.l_partkey, c.l_suppkey, c.l_quantity, c.l_extendedprice, c.l_returnflag) IS DISTINCT FROM (p.l_partkey, p.l_suppkey, p.l_quantity, p.l_extendedprice, p.l_returnflag) THEN 'update'
       ELSE 'unchanged' END AS op
FROM c FULL OUTER JOIN p ON c.l_orderkey = p.l_orderkey AND c.l_linenumber = p.l_linenumber AND c.nth = p.nth
""")
def snapshot_diff_dup_keys(spark, sf_dir):
    order = [F.col(c) for c in LINE_STATE]
    found = diff.snapshot_diff(derive(spark, sf_dir, PREVIOUS_LINES), table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], LINE_STATE, order, order)
    return found.select("l_orderkey", "l_linenumber", "ordinal", "op")


TOUCHED = "SELECT o_orderkey FROM {orders} WHERE o_orderkey % 7 = 0 OR o_orderkey % 20 = 0"
DELETED = """
SELECT o_orderkey + 10000000 AS o_orderkey FROM {orders} WHERE o_orderkey % 50 = 0
UNION ALL SELECT o_orderkey + 20000000 AS o_orderkey FROM {orders} WHERE o_orderkey % 100 = 0
UNION ALL SELECT o_orderkey FROM {orders} WHERE o_orderkey % 70 = 0 OR o_orderkey % 33 = 0
"""
FEED_SQL = f"""
WITH p AS ({plain(PREVIOUS)}), t AS ({plain(TOUCHED)}), d AS (SELECT DISTINCT o_orderkey FROM ({plain(DELETED)})),
judged AS (
  SELECT c.o_orderkey, CASE WHEN p.o_orderkey IS NULL THEN 'insert'
    WHEN (c.o_custkey, c.o_orderstatus, c.o_totalprice) IS DISTINCT FROM (p.o_custkey, p.o_orderstatus, p.o_totalprice) THEN 'update' ELSE 'unchanged' END AS op
  FROM orders c JOIN t ON c.o_orderkey = t.o_orderkey LEFT JOIN p ON c.o_orderkey = p.o_orderkey)
SELECT o_orderkey, op FROM judged
UNION ALL
SELECT d.o_orderkey, CASE WHEN p.o_orderkey IS NOT NULL AND j.o_orderkey IS NULL THEN 'delete' ELSE 'unknown' END AS op
FROM d LEFT JOIN p ON d.o_orderkey = p.o_orderkey LEFT JOIN (SELECT o_orderkey FROM judged WHERE op <> 'insert') j ON d.o_orderkey = j.o_orderkey
"""


@query("change_feed_diff", FEED_SQL)
def change_feed_diff(spark, sf_dir):
    return diff.change_feed_diff(derive(spark, sf_dir, PREVIOUS), table(spark, sf_dir, "orders"), derive(spark, sf_dir, TOUCHED), derive(spark, sf_dir, DELETED), "o_orderkey", STATE)


@query("index_rollforward", f"""
WITH i AS (SELECT o_orderkey, md5('id' || o_orderkey) AS feature_id, md5(o_orderkey || '-' || o_orderstatus || '-old') AS hash FROM ({plain(PREVIOUS)})),
ops AS (SELECT d.o_orderkey, d.op, md5('id' || d.o_orderkey) AS feature_id, md5(d.o_orderkey || '-' || o.o_orderstatus || '-new') AS hash
        FROM ({DIFF_SQL}) d LEFT JOIN orders o ON d.o_orderkey = o.o_orderkey WHERE d.op <> 'unchanged')
SELECT COALESCE(i.o_orderkey, ops.o_orderkey) AS o_orderkey, COALESCE(ops.feature_id, i.feature_id) AS feature_id, COALESCE(ops.hash, i.hash) AS hash
FROM i FULL OUTER JOIN ops ON i.o_orderkey = ops.o_orderkey WHERE ops.op IS NULL OR ops.op <> 'delete'
""")
def index_rollforward(spark, sf_dir):
    text = F.col("o_orderkey").cast("string")
    identity = F.md5(F.concat(F.lit("id"), text)).alias("feature_id")
    state = lambda word: F.md5(F.concat_ws("-", text, "o_orderstatus", F.lit(word))).alias("hash")
    index = derive(spark, sf_dir, PREVIOUS).select("o_orderkey", identity, state("old"))
    key = [F.col("o_orderkey")]
    ops = stored(diff.operations(derive(spark, sf_dir, PREVIOUS), table(spark, sf_dir, "orders"), ["o_orderkey"], STATE, key, key), "operations")
    return diff.roll_index(index, ops.select("o_orderkey", "op", identity, state("new")), "o_orderkey")


@query("content_hashes")
def content_hashes(spark, sf_dir):
    """Hash of every order's state: the hash column of an index, equal for equal rows on every run."""
    return table(spark, sf_dir, "orders").select("o_orderkey", content_hash(*STATE).alias("hash"))


@query("feature_ids", """
SELECT o_orderkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-8' || substr(h, 14, 3) || '-a' || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS feature_id
FROM (SELECT o_orderkey, sha256('{"col1":"orders","o_orderkey":' || o_orderkey || '}') AS h FROM orders)
""")
def feature_ids(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", feature_id(F.lit("orders"), "o_orderkey").alias("feature_id"))


@query("content_changes", """
SELECT o_orderkey, CAST(o_orderkey % 3 AS INTEGER) AS edit, o_orderkey % 3 > 0 AS changed FROM orders
""")
def content_changes(spark, sf_dir):
    """A state's hash is that of another state only if nothing differs: a third is equal, a third has another value, a third has value and null swapped."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("a"), F.lit(None).cast("string").alias("b"), (F.col("o_orderkey") % 3).cast("int").alias("edit"))
    before = orders.withColumn("before", content_hash("a", "b"))
    edited = before.withColumns({"a": F.when(F.col("edit") == 1, "x").when(F.col("edit") == 0, F.col("a")), "b": F.when(F.col("edit") == 2, F.col("a"))})
    return edited.withColumn("after", content_hash("a", "b")).select("o_orderkey", "edit", (F.col("before") != F.col("after")).alias("changed"))


LAYERS = """
SELECT s_nationkey AS service, s_suppkey AS pos, s_suppkey % 11 <> 0 AS tracked, CASE WHEN s_suppkey % 13 = 0 THEN NULL ELSE 'oid' END AS oid_column,
  CASE WHEN s_suppkey % 17 = 0 THEN NULL ELSE s_suppkey END AS previous_generation, CASE WHEN s_suppkey % 19 = 0 THEN NULL ELSE s_suppkey + s_suppkey % 5 - 1 END AS generation
FROM {supplier}
"""


@query("feed_path_decision", f"""
WITH j AS (SELECT service, pos, CASE WHEN NOT COALESCE(tracked, false) THEN 'does not track changes' WHEN oid_column IS NULL THEN 'has no object id'
  WHEN previous_generation IS NULL THEN 'was not read before' WHEN generation IS NULL THEN 'states no generation' WHEN generation < previous_generation THEN 'went back in time' END AS reason FROM ({plain(LAYERS)}))
SELECT service, CASE WHEN COUNT(reason) = 0 THEN 'feed' ELSE 'snapshot' END AS path, MIN_BY(reason, pos) FILTER (reason IS NOT NULL) AS reason FROM j GROUP BY service
""")
def feed_path_decision(spark, sf_dir):
    return diff.feed_path(derive(spark, sf_dir, LAYERS))


@query("vanished_datasets", "SELECT DISTINCT o_orderpriority || o_custkey AS dataset FROM orders WHERE o_orderkey % 2 = 0 AND o_orderpriority || o_custkey NOT IN (SELECT o_orderpriority || o_custkey FROM orders WHERE o_orderkey % 2 = 1)")
def vanished_datasets(spark, sf_dir):
    """Every second order is of the last run, the others of this one: datasets that only the last run met."""
    orders = table(spark, sf_dir, "orders").select(F.concat("o_orderpriority", F.col("o_custkey").cast("string")).alias("dataset"), "o_orderkey")
    return diff.vanished(orders.where("o_orderkey % 2 = 0"), orders.where("o_orderkey % 2 = 1"))


@query("basis_guard", "SELECT DISTINCT p_brand AS dataset FROM part WHERE p_brand NOT IN (SELECT p_brand FROM part WHERE p_size % 3 = 0 AND p_partkey % 40 = 1)")
def basis_guard(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(F.col("p_brand").alias("dataset"), "p_partkey", "p_size")
    return diff.missing_indexes(parts, parts.where("p_size % 3 = 0 and p_partkey % 40 = 1"))


@query("migration_reconcile", f"""
WITH p AS ({plain(PREVIOUS)}), full_rows AS (SELECT o_orderstatus AS dataset, COUNT(*) AS n FROM p GROUP BY 1),
ops AS (SELECT COALESCE(c.o_orderstatus, p.o_orderstatus) AS dataset, d.op FROM ({DIFF_SQL}) d LEFT JOIN orders c ON d.o_orderkey = c.o_orderkey LEFT JOIN p ON d.o_orderkey = p.o_orderkey),
moved AS (SELECT dataset, COUNT(*) FILTER (op = 'insert') AS i, COUNT(*) FILTER (op = 'delete') AS d FROM ops GROUP BY 1),
served AS (SELECT o_orderstatus AS dataset, COUNT(*) AS n FROM orders WHERE o_orderstatus <> 'P' OR o_orderkey % 2 = 0 GROUP BY 1)
SELECT dataset, CAST(COALESCE(f.n, 0) + COALESCE(m.i, 0) - COALESCE(m.d, 0) AS BIGINT) AS expected, CAST(COALESCE(s.n, 0) AS BIGINT) AS served,
  CASE WHEN COALESCE(f.n, 0) + COALESCE(m.i, 0) - COALESCE(m.d, 0) = COALESCE(s.n, 0) THEN 'OK' ELSE 'MISMATCH' END AS state
FROM full_rows f FULL OUTER JOIN moved m USING (dataset) FULL OUTER JOIN served s USING (dataset)
""")
def migration_reconcile(spark, sf_dir):
    previous, current = derive(spark, sf_dir, PREVIOUS), table(spark, sf_dir, "orders")
    status = lambda df, name: df.select("o_orderkey", F.col("o_orderstatus").alias(name))
    ops = _order_diff(spark, sf_dir).join(status(current, "now"), "o_orderkey", "left").join(status(previous, "then"), "o_orderkey", "left")
    count = lambda df: df.groupBy(F.col("o_orderstatus").alias("dataset")).agg(F.count("*").alias("n"))
    return diff.reconcile(count(previous), ops.select(F.coalesce("now", "then").alias("dataset"), "op"), count(current.where("o_orderstatus <> 'P' or o_orderkey % 2 = 0")))


@query("row_tally", """
SELECT source AS layer, COUNT(*) AS read, COUNT(*) FILTER (strlen(text) <= 4096 AND k IS NOT NULL) AS written, COUNT(*) FILTER (lang = 'fr') AS shapeless,
  COUNT(*) FILTER (lang <> 'fr' AND n_chars % 13 = 0) AS unwritable, COUNT(*) FILTER (strlen(text) > 4096 AND k IS NOT NULL) AS oversized,
  CAST(MAX(strlen(text)) FILTER (strlen(text) > 4096 AND k IS NOT NULL) AS BIGINT) AS largest, COUNT(*) FILTER (k IS NULL) AS unkeyed
FROM (SELECT *, CASE WHEN doc_id % 29 = 0 THEN NULL ELSE doc_id END AS k FROM documents) GROUP BY source
""")
def row_tally(spark, sf_dir):
    key = F.when(F.col("doc_id") % 29 != 0, F.col("doc_id"))
    return tally.row_tally(table(spark, sf_dir, "documents"), "source", F.octet_length("text"), 4096, key, F.nullif(F.col("lang"), F.lit("fr")), F.col("n_chars") % 13 != 0)


@query("greedy_batches", """
WITH RECURSIVE r AS (SELECT page_id // 1000 AS shard, page_id, CAST(strlen(html) AS BIGINT) AS bytes, row_number() OVER (PARTITION BY page_id // 1000 ORDER BY page_id) AS nth FROM pages),
walk AS (
  SELECT shard, page_id, bytes, nth, CAST(0 AS BIGINT) AS batch, 1 AS n, bytes AS total FROM r WHERE nth = 1
  UNION ALL
  SELECT r.shard, r.page_id, r.bytes, r.nth, CASE WHEN w.n + 1 > 50 OR w.total + r.bytes > 60000 THEN w.batch + 1 ELSE w.batch END,
    CASE WHEN w.n + 1 > 50 OR w.total + r.bytes > 60000 THEN 1 ELSE w.n + 1 END, CASE WHEN w.n + 1 > 50 OR w.total + r.bytes > 60000 THEN r.bytes ELSE w.total + r.bytes END
  FROM walk w JOIN r ON r.shard = w.shard AND r.nth = w.nth + 1)
SELECT shard, page_id, bytes, batch FROM walk
""")
def greedy_batches(spark, sf_dir):
    """Shards are ranges of 1000 ids, so their number grows with the table and their size does not."""
    pages = table(spark, sf_dir, "pages").select(F.floor(F.col("page_id") / 1000).alias("shard"), "page_id", F.octet_length("html").cast("long").alias("bytes"))
    return batches.greedy_batches(pages, "shard", "page_id", "bytes", most_rows=50, most_bytes=60000)


def _states_sql(index: str) -> str:
    """Events as states of (layer, user), after the entries of an index; each in the light of the one before it."""
    return f"""
WITH x AS ({index}), r AS (
  SELECT user_id % 4 AS dataset, user_id AS oid, event_id AS seq, event_type AS hash, event_id % 6 = 0 AS gone, 'n' || event_id AS new_id FROM events
  UNION ALL SELECT dataset, oid, -1, hash, false, feature_id FROM x),
b AS (SELECT *, lag(hash) OVER w AS h, lag(gone) OVER w AS g, lag(seq) OVER w AS s FROM r WINDOW w AS (PARTITION BY oid ORDER BY seq)),
j AS (SELECT *, CASE WHEN gone THEN CASE WHEN s IS NOT NULL AND NOT g THEN 'delete' ELSE 'unknown' END WHEN s IS NULL OR g THEN 'insert' WHEN h = hash THEN 'unchanged' ELSE 'update' END AS op FROM b)
SELECT * FROM (SELECT dataset, oid, seq, op, CASE WHEN op <> 'unknown' THEN last_value(CASE WHEN op = 'insert' THEN new_id END IGNORE NULLS) OVER (PARTITION BY oid ORDER BY seq) END AS feature_id FROM j) WHERE seq >= 0
"""


NO_INDEX = "SELECT 0 AS dataset, 0 AS oid, '' AS hash, '' AS feature_id WHERE false"
USERS_INDEX = "SELECT DISTINCT user_id % 4 AS dataset, user_id AS oid, 'click' AS hash, concat('f', user_id) AS feature_id FROM {events} WHERE user_id % 3 <> 0"


def _states(events):
    return events.select(
        (F.col("user_id") % 4).alias("dataset"), F.col("user_id").alias("oid"), F.col("event_id").alias("seq"), F.col("event_type").alias("hash"), (F.col("event_id") % 6 == 0).alias("gone"), F.concat(F.lit("n"), F.col("event_id").cast("string")).alias("new_id")
    )


@query("batch_classify", _states_sql(NO_INDEX))
def batch_classify(spark, sf_dir):
    return classify.classify_batch(_states(table(spark, sf_dir, "events")))


@query("batch_classify_index", _states_sql(plain(USERS_INDEX)))
def batch_classify_index(spark, sf_dir):
    return classify.classify_batch(_states(table(spark, sf_dir, "events")), derive(spark, sf_dir, USERS_INDEX))


def _event_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/events.parquet")
    reader = spark.readStream.schema(schema)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory():
        return reader.parquet(f"{sf_dir}/events.parquet")
    return reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)  # a stream reads folders


def _streamed(spark, sf_dir, index=None):
    out = own_place(spark, "classified")
    found = classify.classify_stream(_states(_event_stream(spark, sf_dir)), index)
    found.writeStream.format("parquet").outputMode("append").option("checkpointLocation", own_place(spark, "state")).trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.schema(found.schema).parquet(out)


@query("stream_classify", _states_sql(NO_INDEX))
def stream_classify(spark, sf_dir):
    """The same classification by a streaming job that keeps the state of every key; it runs until the table is read."""
    return _streamed(spark, sf_dir)


@query("stream_classify_index", _states_sql(plain(USERS_INDEX)))
def stream_classify_index(spark, sf_dir):
    """A stream that starts from a key index."""
    return _streamed(spark, sf_dir, derive(spark, sf_dir, USERS_INDEX))


@query("stream_deltas", """
WITH l AS (SELECT user_id AS key, arg_max(event_type, event_id) AS hash, MAX(event_id) AS seq FROM events GROUP BY 1)
SELECT CAST(key AS BIGINT) AS key, hash FROM l WHERE seq % 6 <> 0 UNION ALL SELECT CAST(c_custkey AS BIGINT), c_name FROM customer WHERE c_custkey NOT IN (SELECT key FROM l)
""")
def stream_deltas(spark, sf_dir):
    """Events as edits and deletes of the customers' states, written as deltas by a streaming job; the table after them."""
    out = own_place(spark, "deltas")
    op = F.when(F.col("event_id") % 6 == 0, "delete").otherwise("update")
    stream = _event_stream(spark, sf_dir).select(F.col("user_id").cast("long").alias("key"), F.col("event_type").alias("hash"), F.col("event_id").alias("seq"), op.alias("op"))
    classify.write_deltas(stream, out, own_place(spark, "state")).start().awaitTermination()
    base = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("long").alias("key"), F.col("c_name").alias("hash"))
    return classify.after_deltas(base, out, ["key"], ["hash"], ["seq"])
