"""Queries over geometry columns and markup."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import geometry
from ..session import table
from ..sources import markup
from .base import derive, plain, query


def _rings(spark, sf_dir):
    """Every embedding as a ring of 32 vertices."""
    e = F.col("embedding").cast("array<double>")
    ring = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.array(F.get(e, 2 * i), F.get(e, 2 * i + 1)))
    return table(spark, sf_dir, "embeddings").select("vec_id", ring.alias("ring"))


@query("ring_orientation", """
WITH r AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings)
SELECT vec_id, list_sum(list_transform(range(0, 32), lambda i: e[2 * i + 1] * e[2 * ((i + 1) % 32) + 2] - e[2 * ((i + 1) % 32) + 1] * e[2 * i + 2])) <= 0 AS is_outer,
  CAST(CASE WHEN e[1] = e[63] AND e[2] = e[64] THEN 32 ELSE 33 END AS INTEGER) AS n_closed FROM r
""")
def ring_orientation(spark, sf_dir):
    return _rings(spark, sf_dir).select("vec_id", geometry.is_outer(F.col("ring")).alias("is_outer"), F.size(geometry.closed(F.col("ring"))).alias("n_closed"))


#: Axis-aligned squares: every third ring of a feature bounds from outside, the others are small holes.
SQUARES = """
SELECT CAST(floor(p_partkey / 10) AS BIGINT) AS feature, p_partkey % 10 AS pos, p_partkey % 3 = 0 AS outside,
  CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size % 20 AS DOUBLE) ELSE p_size % 40 + 0.46875 + (p_partkey % 10) / 16.0 END AS x, CASE WHEN p_partkey % 3 = 0 THEN 10.0 + p_partkey % 10 ELSE 0.03125 END AS side
FROM {part}
"""


@query("hole_assignment", f"""
WITH r AS ({plain(SQUARES)}), pairs AS (SELECT h.feature, h.pos, MIN(o.pos) AS home FROM r h JOIN r o ON h.feature = o.feature AND o.outside AND o.x < h.x AND h.x < o.x + o.side AND o.x < h.x AND h.x < o.x + o.side WHERE NOT h.outside GROUP BY 1, 2)
SELECT r.feature, r.pos, CASE WHEN r.outside THEN r.pos ELSE COALESCE(p.home, r.pos) END AS polygon FROM r LEFT JOIN pairs p ON r.feature = p.feature AND r.pos = p.pos
""")
def hole_assignment(spark, sf_dir):
    squares = derive(spark, sf_dir, SQUARES)
    x, far = F.col("x").cast("double"), (F.col("x") + F.col("side")).cast("double")
    at = lambda a, b: F.array(a, b)
    clockwise = F.array(at(x, x), at(x, far), at(far, far), at(far, x))
    ring = F.when(F.col("outside"), clockwise).otherwise(F.reverse(clockwise))
    # a hole begins with its corner at (x, x)
    ring = F.when(F.col("outside"), ring).otherwise(F.concat(F.slice(ring, 4, 1), F.slice(ring, 1, 3)))
    return geometry.assign_holes(squares.select("feature", "pos", ring.alias("ring")))


#: A 32-bit number and a double as little-endian hexadecimal digits.
WORD = "printf('%02X%02X0000', {0} & 255, {0} >> 8)"
REAL = "(SELECT h[15:16] || h[13:14] || h[11:12] || h[9:10] || h[7:8] || h[5:6] || h[3:4] || h[1:2] FROM (SELECT hex(CAST(CAST(CAST({0} AS DOUBLE) AS BIT) AS BLOB)) AS h))"
VERTICES_SQL = f"""
WITH o AS (SELECT vec_id, label, generate_subscripts(embedding, 1) AS i, unnest(embedding) AS x FROM embeddings),
h AS (SELECT vec_id, label, i, hex(CAST(CAST(CAST(x AS DOUBLE) AS BIT) AS BLOB)) AS h FROM o),
r AS (SELECT vec_id, label, i, h[15:16] || h[13:14] || h[11:12] || h[9:10] || h[7:8] || h[5:6] || h[3:4] || h[1:2] AS d FROM h),
v AS (SELECT vec_id, label, (i - 1) // 2 AS n, string_agg(d, '' ORDER BY i) AS xy FROM r GROUP BY 1, 2, 3)"""


@query("wkb_encode", f"""{VERTICES_SQL}
SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN '010700000000000000' ELSE '0105000000' || '01000000' || '0102000000' || {WORD.format('COUNT(*)')} || string_agg(xy, '' ORDER BY n) END AS wkb_hex FROM v GROUP BY vec_id
""")
def wkb_encode(spark, sf_dir):
    """Embeddings as polylines of 32 vertices in binary form; rows whose id is divisible by 7 have no shape and get the empty one."""
    rows = _rings(spark, sf_dir).select("vec_id", F.when(F.col("vec_id") % 7 != 0, F.lit("polyline")).alias("kind"), F.array("ring").alias("parts"), F.lit(False).alias("has_z"))
    return geometry.with_binary(rows).select("vec_id", F.hex("wkb").alias("wkb_hex"))


@query("wkb_kinds", f"""{VERTICES_SQL}, more AS (SELECT {REAL.format(1.5)} AS z, {REAL.format(2.5)} AS m),
w AS (SELECT v.*, vec_id % 4 AS kind, xy || CASE label % 3 WHEN 0 THEN '' WHEN 1 THEN z ELSE z || m END AS d FROM v, more),
c AS (SELECT *, CASE label % 3 WHEN 0 THEN 0 WHEN 1 THEN CASE WHEN vec_id % 2 = 0 THEN 1000 ELSE 2000 END ELSE 3000 END AS base FROM w)
SELECT vec_id, CASE kind
  WHEN 0 THEN '01' || {WORD.format('(MIN(base) + 1)')} || MIN(CASE WHEN n = 0 THEN d END)
  WHEN 1 THEN '01' || {WORD.format('(MIN(base) + 4)')} || {WORD.format('COUNT(*)')} || string_agg('01' || {WORD.format('(base + 1)')} || d, '' ORDER BY n)
  WHEN 2 THEN '01' || {WORD.format('(MIN(base) + 5)')} || '02000000' || '01' || {WORD.format('(MIN(base) + 2)')} || {WORD.format('COUNT(*) FILTER (n < 20)')} || string_agg(CASE WHEN n < 20 THEN d END, '' ORDER BY n)
    || '01' || {WORD.format('(MIN(base) + 2)')} || {WORD.format('COUNT(*) FILTER (n >= 20)')} || string_agg(CASE WHEN n >= 20 THEN d END, '' ORDER BY n)
  ELSE '01' || {WORD.format('(MIN(base) + 6)')} || '02000000' || '01' || {WORD.format('(MIN(base) + 3)')} || '02000000' || {WORD.format('COUNT(*) FILTER (n < 20)')} || string_agg(CASE WHEN n < 20 THEN d END, '' ORDER BY n)
    || {WORD.format('COUNT(*) FILTER (n >= 20)')} || string_agg(CASE WHEN n >= 20 THEN d END, '' ORDER BY n) || '01' || {WORD.format('(MIN(base) + 3)')} || '01000000' || {WORD.format('COUNT(*)')} || string_agg(d, '' ORDER BY n) END AS wkb_hex
FROM c GROUP BY vec_id, kind
""")
def wkb_kinds(spark, sf_dir):
    """Points, multipoints, lines of two parts with an empty one between, and polygons of two, with z, m, both or neither."""
    label = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    kind = F.col("vec_id") % 4
    extra = F.when(F.col("label") % 3 == 0, F.array().cast("array<double>")).when(F.col("label") % 3 == 1, F.array(F.lit(1.5))).otherwise(F.array(F.lit(1.5), F.lit(2.5)))
    rows = _rings(spark, sf_dir).join(label, "vec_id").withColumn("ring", F.transform("ring", lambda p: F.concat(p, extra)))
    cut = [F.slice("ring", 1, 20), F.slice("ring", 21, 100)]
    none = F.array().cast("array<array<double>>")
    flat = rows.where(kind < 3).select(
        "vec_id", F.element_at(F.array(F.lit("point"), F.lit("multipoint"), F.lit("polyline")), (kind + 1).cast("int")).alias("kind"), F.when(kind == 2, F.array(cut[0], none, cut[1])).otherwise(F.array("ring")).alias("parts"), (F.col("vec_id") % 2 == 0).alias("has_z")
    )
    deep = rows.where(kind == 3).select("vec_id", F.lit("polygon").alias("kind"), F.array(F.array(*cut), F.array("ring"), F.array(none)).alias("parts"), (F.col("vec_id") % 2 == 0).alias("has_z"))
    return geometry.with_binary(flat).select("vec_id", F.hex("wkb").alias("wkb_hex")).unionByName(geometry.with_binary(deep).select("vec_id", F.hex("wkb").alias("wkb_hex")))


@query("vertex_decode", """
SELECT vec_id, vec_id % 11 = 0 AS unencodable, CAST(CASE WHEN vec_id % 11 <> 0 THEN CASE WHEN vec_id % 2 = 0 THEN 32 ELSE 0 END END AS INTEGER) AS nulled,
  CAST(CASE WHEN vec_id % 11 <> 0 THEN 32 END AS INTEGER) AS vertices FROM embeddings
""")
def vertex_decode(spark, sf_dir):
    """Landed shapes: rings as JSON, every second one of a layer with z that has none, every eleventh with a broken vertex."""
    ring = F.when(F.col("vec_id") % 11 == 0, F.concat("ring", F.array(F.array(F.lit(1.0))))).otherwise(F.col("ring"))
    rows = _rings(spark, sf_dir).select("vec_id", F.to_json(F.struct(F.array(ring).alias("rings"))).alias("shape"), (F.col("vec_id") % 2 == 0).alias("z"), F.lit(False).alias("m"))
    found = geometry.decode_vertices(rows, "shape", "z", "m")
    return found.select("vec_id", "unencodable", F.col("nulled").cast("int").alias("nulled"), F.when(F.col("parts").isNotNull(), F.size(F.flatten("parts"))).alias("vertices"))


@query("element_tally", """
SELECT element, COUNT(*) AS n FROM (SELECT lower(unnest(regexp_extract_all(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '<([A-Za-z][A-Za-z0-9]*)', 1))) AS element FROM pages) GROUP BY 1
""")
def element_tally(spark, sf_dir):
    return markup.start_tags(table(spark, sf_dir, "pages"), "page_id", "html").groupBy("element").agg(F.count("*").alias("n"))


MARKUP = """concat('<kml><Document><name>', p_brand, '</name><Folder>', repeat(concat('<Placemark><Point><coordinates>', p_size, ',1,', p_partkey % 2, '</coordinates></Point></Placemark>'), CAST(p_size % 5 AS INT)),
 CASE WHEN p_partkey % 3 = 0 THEN '<Placemark><TimeStamp><when>2020-01-01</when></TimeStamp><LineString/></Placemark>' ELSE '' END, CASE WHEN p_partkey % 17 = 0 THEN '</Folder>' ELSE '</Folder></Document></kml>' END)"""


@query("markup_shapes", """
SELECT p_partkey AS doc_id, parent, element, n FROM (
  SELECT p_partkey, 'Placemark' AS parent, 'Point' AS element, CAST(p_size % 5 AS BIGINT) AS n FROM part WHERE p_partkey % 17 <> 0 AND p_size % 5 > 0
  UNION ALL SELECT p_partkey, 'Placemark', 'LineString', 1 FROM part WHERE p_partkey % 17 <> 0 AND p_partkey % 3 = 0)
""")
def markup_shapes(spark, sf_dir):
    """A markup document per part; truncated ones are quarantined, not counted."""
    documents = table(spark, sf_dir, "part").select("p_partkey", F.expr(MARKUP).alias("body"))
    return markup.shape_histogram(markup.element_rows(documents, "p_partkey", "body"))


@query("markup_quarantine", "SELECT p_partkey AS doc_id FROM part WHERE p_partkey % 17 = 0")
def markup_quarantine(spark, sf_dir):
    documents = table(spark, sf_dir, "part").select("p_partkey", F.expr(MARKUP).alias("body"))
    return markup.element_rows(documents, "p_partkey", "body").where("problem is not null").select("doc_id")


@query("markup_times", "SELECT p_partkey AS doc_id, CASE WHEN p_partkey % 17 <> 0 AND p_partkey % 3 = 0 THEN 1 ELSE 0 END AS instants, 0 AS spans, p_partkey % 17 <> 0 AND p_partkey % 3 = 0 AS has_partial FROM part")
def markup_times(spark, sf_dir):
    documents = table(spark, sf_dir, "part").select("p_partkey", F.expr(MARKUP).alias("body"))
    return markup.time_tally(markup.element_rows(documents, "p_partkey", "body"))


@query("markup_containers", "SELECT p_partkey AS doc_id, CASE WHEN p_partkey % 17 = 0 THEN 0 ELSE 1 END AS folders, CAST(CASE WHEN p_partkey % 17 <> 0 THEN 2 END AS INTEGER) AS deepest, CASE WHEN p_partkey % 17 = 0 THEN 0 ELSE p_size % 5 + CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END END AS rows FROM part")
def markup_containers(spark, sf_dir):
    documents = table(spark, sf_dir, "part").select("p_partkey", F.expr(MARKUP).alias("body"))
    return markup.container_tally(markup.element_rows(documents, "p_partkey", "body"))
