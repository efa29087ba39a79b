"""Queries over the rule packs: every kind of item is derived from `part`, judged by its rules, and stated again in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rules
from ..session import table
from ..sources import markup, markup_facts
from .base import derive, plain, query

FACTS = """
SELECT p_partkey AS id, CASE p_size % 4 WHEN 0 THEN 'many to many' WHEN 1 THEN 'one to one' WHEN 2 THEN 'many to one' ELSE 'one to many' END AS cardinality,
  CASE WHEN p_partkey % 5 <> 0 THEN p_brand END AS destination, CASE WHEN p_partkey % 7 <> 0 THEN p_type END AS origin, p_partkey % 3 = 0 AS composite,
  CASE WHEN p_size % 3 = 0 THEN 'key' END AS origin_key, CASE WHEN p_size % 5 = 0 THEN 'has' END AS forward_label, CASE WHEN p_size % 6 = 0 THEN 'of' END AS backward_label,
  CASE WHEN p_partkey % 2 = 0 THEN 'c' END AS default_code, CAST(p_size % 3 AS BIGINT) AS n_defaults, CAST(p_size % 2 AS BIGINT) AS keywords, p_partkey % 4 = 0 AS tracked, p_partkey % 6 = 0 AS versioned, CAST(p_size % 9 AS BIGINT) AS n_layers,
  p_partkey % 8 <> 0 AS has_relationship, CASE WHEN p_partkey % 9 = 0 THEN 'glob' ELSE 'range' END AS kind_of_domain, CASE WHEN p_size % 4 = 1 THEN 'text' END AS description, CASE WHEN p_size % 7 = 0 THEN 'copy' END AS split_policy, CAST(NULL AS STRING) AS merge_policy,
  p_partkey % 3 <> 1 AS min_inclusive, CAST(NULL AS BOOLEAN) AS max_inclusive, CAST(CASE WHEN p_size % 8 = 0 THEN 18014398509481984 ELSE p_size END AS BIGINT) AS max_value, CAST(NULL AS BIGINT) AS min_value,
  CASE WHEN p_size % 3 = 1 THEN array(p_type, p_brand, p_type) END AS domain_names, CAST(p_size % 4 AS BIGINT) AS n_large, p_partkey % 5 <> 1 AS described, CAST(p_size % 3 AS BIGINT) AS n_sections, CASE WHEN p_partkey % 4 = 0 THEN p_brand END AS gdb_version,
  p_partkey % 3 <> 2 AS drawn, p_partkey % 5 <> 2 AS timed, CASE WHEN p_size % 2 = 0 THEN array('KEYWORDS', 'TAKEN') END AS other_columns, CASE WHEN p_size % 3 = 0 THEN 'esriFTDimension' END AS feature_type, p_partkey % 6 AS n_members
FROM {part}
"""


def _judged(spark, sf_dir, facts: str, kinds: list[str], pack: list[rules.Rule]):
    rows = derive(spark, sf_dir, facts)
    return rules.judge_all({kind: rows for kind in kinds}, pack, "id", "id").select("location", "kind", "outcome", "target", F.array_join("losses", "; ").alias("losses"), "reason")


def sql_of(facts: str) -> str:
    """The facts without their arrays, which the rules' SQL states from the part."""
    return plain(facts).replace("array(p_type, p_brand, p_type)", "1").replace("array('KEYWORDS', 'TAKEN')", "1")


def _sql(facts: str, kinds: list[tuple[str, str | None, str, str]]) -> str:
    """kind, target, and in SQL: the reason with its outcome ('outcome|reason' or null), and the losses."""
    each = [
        f"SELECT CAST(id AS VARCHAR) AS location, '{kind}' AS kind, {no} AS no, {losses} AS losses, {'NULL' if target is None else repr(target)} AS target FROM f" for kind, target, no, losses in kinds
    ]
    return f"""
    WITH f AS (SELECT f.*, p_size, p_brand, p_type FROM ({sql_of(facts)}) f JOIN part ON p_partkey = id), j AS ({' UNION ALL '.join(each)})
    SELECT location, kind, CASE WHEN no IS NOT NULL THEN split_part(no, '|', 1) WHEN losses <> '' THEN 'approximated' ELSE 'faithful' END AS outcome, CASE WHEN no IS NULL THEN target END AS target,
      CASE WHEN no IS NULL THEN losses ELSE '' END AS losses, NULLIF(split_part(COALESCE(no, ''), '|', 2), '') AS reason FROM j
    """


NONE = "CAST(NULL AS VARCHAR)"
LABELS = "CASE WHEN forward_label IS NOT NULL OR backward_label IS NOT NULL THEN 'labels are not kept' END"
SECTIONS = "concat_ws('; ', 'descriptions are kept as one text', CASE WHEN n_sections > 0 THEN n_sections || ' other sections of the record have no place' END)"
WHOLE = "CASE WHEN composite THEN 'parts do not go with their whole' END"

HOSTED = [
    ("group", None, "'unsupported|groups of layers have no counterpart; their layers are kept'", "''"),
    ("raster", None, "'unsupported|pixels are not rows'", "''"),
    ("annotation", None, NONE, "'placed text is kept as shapes without its drawing'"),
    ("subtype", "subtype", NONE, "concat_ws('; ', CASE WHEN default_code IS NOT NULL THEN 'the default code is not kept' END, CASE WHEN p_size % 3 = 1 THEN 'domains are assigned by name and need the ids of loaded ones: ' || LEAST(p_brand, p_type) || CASE WHEN p_brand = p_type THEN '' ELSE ', ' || GREATEST(p_brand, p_type) END END)"),
    ("relationship", "relationship", "CASE WHEN cardinality = 'many to many' THEN 'unsupported|many to many needs a table between' WHEN destination IS NULL THEN 'unsupported|the other side is not here' END", f"concat_ws('; ', {WHOLE}, CASE WHEN origin_key IS NOT NULL THEN 'the key on the origin side is implied' END, {LABELS})"),
    ("attachments", "attachments", NONE, "concat_ws('; ', CASE WHEN keywords > 0 THEN 'keywords are kept as metadata only' END, CASE WHEN n_large > 0 THEN n_large || ' are larger than a request may be' END)"),
    ("style", "style", "CASE WHEN NOT drawn THEN 'not_applicable|nothing says how it is drawn' END", "'the style is carried as it stands, not drawn'"),
    ("time", "dataset", "CASE WHEN NOT timed THEN 'not_applicable|there are no time settings' ELSE 'unsupported|time settings have no counterpart' END", "''"),
    ("metadata", "metadata", "CASE WHEN NOT described THEN 'not_applicable|nothing is described' END", SECTIONS),
    ("versioning", None, "CASE WHEN NOT versioned THEN 'not_applicable|there are no versions to carry' WHEN gdb_version IS NOT NULL THEN 'unsupported|only version ' || gdb_version || ' is read, not the tree that it is in' ELSE 'unsupported|only the default version is read, not the tree that it is in' END", "''"),
    ("tracking", "source", "CASE WHEN NOT tracked THEN 'not_applicable|changes are not tracked' END", "'the history of edits stays behind'"),
    ("service", "source", "CASE WHEN n_layers = 0 THEN 'not_applicable|nothing to move' END", "CASE WHEN versioned THEN 'only one version is read' ELSE '' END"),
]


@query("hosted_rules", _sql(FACTS, HOSTED))
def hosted_rules(spark, sf_dir):
    return _judged(spark, sf_dir, FACTS, [k for k, *_ in HOSTED], rules.HOSTED)


FILE = [
    ("domain", "domain", "CASE WHEN kind_of_domain = 'glob' THEN 'unsupported|patterns have no counterpart' END", "concat_ws('; ', CASE WHEN description IS NOT NULL THEN 'the description is not kept' END, CASE WHEN split_policy IS NOT NULL THEN 'split and merge policies are not kept' END, CASE WHEN NOT min_inclusive THEN 'open ends become closed ends' END, CASE WHEN max_value > 9007199254740992 THEN 'ends beyond 53 bits are rounded' END)"),
    ("relationship", "relationship", "CASE WHEN cardinality = 'many to many' THEN 'unsupported|many to many needs a table between' WHEN origin IS NULL OR destination IS NULL THEN 'unsupported|one side is not here' END", f"concat_ws('; ', CASE WHEN cardinality = 'many to one' THEN 'sides are turned around' END, {WHOLE}, {LABELS})"),
    ("attachments", "attachments", "CASE WHEN NOT has_relationship THEN 'unsupported|no relationship leads to these attachments' END", "concat_ws('; ', CASE WHEN p_size % 2 = 0 THEN 'columns beside the bytes are kept as metadata only: KEYWORDS, TAKEN' END, CASE WHEN n_large > 0 THEN n_large || ' are larger than a request may be' END)"),
    ("drawn", None, NONE, "CASE WHEN feature_type IS NULL THEN 'drawn text is kept as shapes' ELSE 'drawn measures are kept as shapes' END"),
    ("subtype", "subtype", NONE, "concat_ws('; ', CASE WHEN default_code IS NOT NULL THEN 'the default code is not kept' END, CASE WHEN n_defaults > 0 THEN n_defaults || ' default values are not kept' END)"),
    ("metadata", "metadata", "CASE WHEN NOT described THEN 'not_applicable|nothing is described' END", SECTIONS),
    ("group", None, "CASE WHEN n_members = 0 THEN 'not_applicable|the group is empty' END", "'the group is kept in names only'"),
    ("entry", None, "'unsupported|nothing reads this kind of entry'", "''"),
]


@query("file_rules", _sql(FACTS, FILE))
def file_rules(spark, sf_dir):
    return _judged(spark, sf_dir, FACTS, [k for k, *_ in FILE], rules.FILE)


TABLES = """
SELECT p_brand AS id, CASE WHEN MIN(p_partkey) % 6 = 0 THEN 'system' ELSE 'user' END AS role, CASE WHEN MIN(p_size) % 3 = 0 THEN NULL ELSE 'point' END AS geometry_type,
  CASE WHEN COUNT(*) % 3 = 0 THEN NULL WHEN COUNT(*) % 3 = 1 THEN 4326 ELSE 26919 END AS code, CASE WHEN COUNT(*) % 2 = 0 THEN 'LOCAL_CS' END AS wkt FROM {part} GROUP BY p_brand
"""
TABLE_FIELDS = """
SELECT p_brand AS id, p_name AS name, CASE WHEN p_size % 3 = 0 THEN p_type END AS alias,
  CASE p_size % 9 WHEN 0 THEN 'Date' WHEN 1 THEN 'Binary' WHEN 2 THEN 'StringList' WHEN 3 THEN 'Integer64' ELSE 'String' END AS type FROM {part} WHERE p_partkey % 40 < 3
"""


@query("file_table_rules", f"""
WITH t AS ({plain(TABLES)}), f AS (SELECT id, bool_or(alias IS NOT NULL AND alias <> name) AS a, bool_or(type = 'Date') AS d, bool_or(type = 'Binary') AS b, bool_or(type = 'StringList') AS l FROM ({plain(TABLE_FIELDS)}) GROUP BY id),
j AS (SELECT t.*, CASE WHEN role = 'system' THEN 'not_applicable|a table of the database itself' WHEN geometry_type IS NOT NULL AND code IS NULL AND wkt IS NULL THEN 'unsupported|shapes without a reference cannot be placed' END AS no,
  concat_ws('; ', CASE WHEN a THEN 'aliases are kept but never shown' END, CASE WHEN d THEN 'dates and times become text' END, CASE WHEN b THEN 'binary values stay behind' END, CASE WHEN l THEN 'lists lose the type of their elements' END,
    CASE WHEN geometry_type IS NOT NULL AND code <> 4326 THEN 'shapes are transformed from ' || code END, CASE WHEN geometry_type IS NULL THEN 'rows get an empty geometry' END) AS losses FROM t LEFT JOIN f ON t.id = f.id)
SELECT id AS location, CASE WHEN no IS NOT NULL THEN split_part(no, '|', 1) WHEN losses <> '' THEN 'approximated' ELSE 'faithful' END AS outcome, CASE WHEN no IS NULL THEN losses ELSE '' END AS losses, NULLIF(split_part(COALESCE(no, ''), '|', 2), '') AS reason FROM j
""")
def file_table_rules(spark, sf_dir):
    fields = derive(spark, sf_dir, TABLE_FIELDS).groupBy("id").agg(F.collect_list(F.struct("name", "alias", "type")).alias("fields"))
    items = rules.judge(derive(spark, sf_dir, TABLES).join(fields, "id", "left"), "table", rules.FILE, "id", "role")
    return items.select("location", "outcome", F.array_join("losses", "; ").alias("losses"), "reason")


#: A document per part: by its numbers it has folders, heights, tracks, schemas, styles, times, links, overlays and settings for viewers, or is not there.
BODY = """CASE WHEN p_partkey % 13 <> 5 THEN concat('<kml><Document>',
 CASE WHEN p_partkey % 4 <> 3 THEN concat('<name>part ', p_partkey, '</name>') ELSE '' END, CASE WHEN p_size % 3 = 0 THEN '<description>d</description>' ELSE '' END,
 CASE WHEN p_partkey % 3 = 0 THEN concat('<Schema name="s"><SimpleField type="int" name="n">', CASE WHEN p_partkey % 2 = 0 THEN '<displayName>N</displayName>' ELSE '' END, '</SimpleField><SimpleField type="string" name="t"/></Schema>') ELSE '' END,
 CASE p_size % 3 WHEN 1 THEN '<Style><IconStyle><Icon><href>http://x/i.png</href></Icon><colorMode>random</colorMode></IconStyle><LabelStyle/><BalloonStyle/></Style>'
   WHEN 2 THEN concat('<Style><LineStyle/></Style><StyleMap>', CASE WHEN p_partkey % 2 = 0 THEN '<Pair><key>normal</key></Pair>' ELSE '' END, '<Pair><key>highlight</key></Pair></StyleMap>') ELSE '' END,
 CASE WHEN p_size % 5 = 0 THEN '<Folder><name>f</name><Placemark><Point><extrude>0</extrude></Point></Placemark></Folder>' ELSE '' END,
 repeat('<Placemark><ExtendedData><Data name="a"/></ExtendedData></Placemark>', CAST(p_size % 3 AS INT)),
 CASE WHEN p_partkey % 2 = 0 THEN '<Placemark><Point><altitudeMode>absolute</altitudeMode><extrude>1</extrude></Point></Placemark>' ELSE '' END,
 CASE WHEN p_size % 4 = 0 THEN concat('<Placemark>', CASE WHEN p_size % 8 = 0 THEN '<gx:MultiTrack>' ELSE '' END,
   repeat(concat('<gx:Track><altitudeMode>absolute</altitudeMode><when>2020-01-01', CASE WHEN p_partkey % 2 = 1 THEN 'T00:00:00Z' ELSE '' END, '</when><gx:coord>1 2 ', CASE WHEN p_partkey % 2 = 1 THEN '3' ELSE '0' END, '</gx:coord>',
     CASE p_partkey % 3 WHEN 0 THEN '<gx:angles>1 2 3</gx:angles>' WHEN 1 THEN '<ExtendedData><SchemaData><gx:SimpleArrayData/></SchemaData><Data name="b"/></ExtendedData>' ELSE '' END, '</gx:Track>'), CASE WHEN p_size % 8 = 0 THEN 2 ELSE 1 END),
   CASE WHEN p_size % 8 = 0 THEN '</gx:MultiTrack>' ELSE '' END, '</Placemark>') ELSE '' END,
 CASE p_partkey % 5 WHEN 1 THEN '<TimeStamp><when>1997</when></TimeStamp>' WHEN 2 THEN '<TimeSpan><begin>2020-01-01T00:00:00Z</begin></TimeSpan>' ELSE '' END,
 CASE WHEN p_partkey % 6 = 0 THEN '<NetworkLink><name>n</name><Link><href>http://y</href><refreshMode>onChange</refreshMode></Link></NetworkLink>' ELSE '' END,
 CASE WHEN p_partkey % 5 = 0 THEN concat('<GroundOverlay><color>ff</color><Icon><href>g.png</href></Icon><LatLonBox><rotation>', p_size % 2, '</rotation></LatLonBox>', CASE WHEN p_partkey % 10 = 0 THEN '<gx:LatLonQuad/>' ELSE '' END,
   '<drawOrder>1</drawOrder></GroundOverlay><Region><Lod/></Region><ScreenOverlay/><LookAt/>') ELSE '' END,
 '</Document></kml>') END"""


@query("markup_rules", """
WITH d AS (SELECT p_partkey AS k, p_size AS z, p_size % 4 = 0 AS tracked, p_size % 8 = 0 AS multi FROM part WHERE p_partkey % 13 <> 5), i AS (
SELECT k, 'document' AS kind, CASE WHEN k % 4 <> 3 THEN 'part ' || k ELSE 'a description' END AS detail, CAST(NULL AS VARCHAR) AS reason, 'metadata' AS target, [CASE WHEN z % 3 = 0 THEN 'the description is markup for a popup: its text is kept and not shown' END] AS l FROM d WHERE k % 4 <> 3 OR z % 3 = 0
UNION ALL SELECT p_partkey, 'document', 'there is no document', 'the document cannot be read: there is no document', NULL, [] FROM part WHERE p_partkey % 13 = 5
UNION ALL SELECT k, 'hierarchy', '1 folders, 1 deep', NULL, 'dataset', ['nesting is kept as a path on every row: no group can be switched or moved', 'which folders are open or visible is not kept'] FROM d WHERE z % 5 = 0
UNION ALL SELECT k, 'container', '1 rows of Point', NULL, 'dataset', [] FROM d WHERE z % 5 = 0
UNION ALL SELECT k, 'container', (z % 3 + CASE WHEN k % 2 = 0 THEN 1 ELSE 0 END + CASE WHEN tracked THEN 1 ELSE 0 END) || ' rows' || CASE WHEN k % 2 = 0 THEN ' of Point' ELSE '' END || CASE WHEN multi THEN ', MultiTrack apart' WHEN tracked THEN ', Track apart' ELSE '' END, NULL, 'dataset',
  [CASE WHEN z % 3 > 0 THEN (z % 3) || ' rows have no shape, and an empty shape means a deletion' END, CASE WHEN k % 2 = 0 THEN 'heights are kept, but nothing lifts or drapes shapes by altitudeMode, extrude' END] FROM d WHERE z % 3 > 0 OR k % 2 = 0 OR tracked
UNION ALL SELECT k, 'track', CASE WHEN multi THEN '2 parts, 2 samples' ELSE '1 samples' END, NULL, 'dataset', ['a track has points and a period only: values and style of its row stay on another row', 'speeds and positions are worked out only where the store has functions for moving points',
  CASE WHEN multi THEN 'parts become tracks of their own, and the gaps between them are not stated' END, CASE WHEN k % 2 = 1 THEN 'heights of samples are dropped' END, CASE WHEN k % 3 = 0 THEN 'headings and tilts of samples are dropped' END, CASE WHEN k % 3 = 1 THEN 'values a sample have no column' END,
  CASE WHEN k % 2 = 0 THEN 'dates without a time become moments, and that they were dates is lost' END] FROM d WHERE tracked
UNION ALL SELECT k, 'schema', 's, 2 fields', NULL, NULL, ['declared widths become plain numbers: int', CASE WHEN k % 2 = 0 THEN 'display names are carried and not shown' END] FROM d WHERE k % 3 = 0
UNION ALL SELECT k, 'extended', (z % 3) || ' rows, 1 keys, 0 blocks', NULL, 'schema', [] FROM d WHERE z % 3 > 0
UNION ALL SELECT k, 'style', 'IconStyle, LabelStyle; icon http://x/i.png', NULL, 'style', ['labels are scaled from a size that is not stated', 'the icon lies on another server: http://x/i.png', 'random colours are picked at drawing and cannot be kept'] FROM d WHERE z % 3 = 1
UNION ALL SELECT k, 'chrome', 'BalloonStyle', 'popup templates are content, not symbols', NULL, [] FROM d WHERE z % 3 = 1
UNION ALL SELECT k, 'style', 'LineStyle', NULL, 'style', [] FROM d WHERE z % 3 = 2
UNION ALL SELECT k, 'style_map', CASE WHEN k % 2 = 0 THEN 'normal, highlight' ELSE 'highlight' END, NULL, 'style', ['only the normal state becomes a symbol', CASE WHEN k % 2 = 1 THEN 'no state is the normal one, so there is no symbol to begin with' END] FROM d WHERE z % 3 = 2
UNION ALL SELECT k, 'time', CASE k % 5 WHEN 1 THEN '1 instants, 0 spans' ELSE '0 instants, 1 spans' END, NULL, 'dataset', [CASE WHEN k % 5 = 1 THEN 'a moment becomes a period that is open at its end' END, CASE WHEN k % 5 = 1 THEN 'dates without a time become moments, and that they were dates is lost' END] FROM d WHERE k % 5 IN (1, 2)
UNION ALL SELECT k, 'link', 'n to http://y (refreshMode=onChange)', 'what a link leads to is not read', NULL, [] FROM d WHERE k % 6 = 0
UNION ALL SELECT k, 'overlay', 'unnamed shows g.png, in a box' || CASE WHEN k % 10 = 0 THEN ', in a quadrangle' ELSE '' END, NULL, 'raster', ['the image is not fetched, so what it holds is not known', CASE WHEN k % 10 = 0 THEN 'an image between four corners needs to be warped' END,
  CASE WHEN z % 2 = 1 THEN 'a turned image needs to be sampled again' END, 'tints are settings for drawing', 'the order of drawing is a rule of the viewer'] FROM d WHERE k % 5 = 0
UNION ALL SELECT k, 'screen', '1 on the screen', 'what is fixed to the screen is no part of the map', NULL, [] FROM d WHERE k % 5 = 0
UNION ALL SELECT k, 'region', '1 regions, 1 with levels', NULL, 'style', ['levels of detail go by pixels, scales do not: the limits are to be chosen anew', 'that a region has to be in view cannot be said'] FROM d WHERE k % 5 = 0
UNION ALL SELECT k, 'element', '1 LookAt', 'viewpoints have no place: maps open on their data', NULL, [] FROM d WHERE k % 5 = 0
), j AS (SELECT *, array_to_string(list_filter(l, lambda x: x IS NOT NULL), '; ') AS losses FROM i)
SELECT CAST(k AS VARCHAR) AS location, kind, detail, CASE WHEN reason IS NOT NULL THEN 'unsupported' WHEN losses <> '' THEN 'approximated' ELSE 'faithful' END AS outcome, target, losses, reason FROM j
""")
def markup_rules(spark, sf_dir):
    """From documents to verdicts: elements, the facts of each kind of item, and the rules over them."""
    parts = table(spark, sf_dir, "part").select("p_partkey", F.expr(BODY).alias("body"))
    items = markup_facts.items(markup.element_rows(parts, "p_partkey", "body"))
    return items.select(F.split("location", "#")[0].alias("location"), "kind", "detail", "outcome", "target", F.array_join("losses", "; ").alias("losses"), "reason")


@query("left_behind", """
SELECT p_partkey AS seq, CASE p_size % 5 WHEN 0 THEN 'no dataset uses it' WHEN 1 THEN 'one of its sides stays behind' WHEN 2 THEN 'its rows stay behind' WHEN 3 THEN 'its dataset stays behind' ELSE 'it was not placed' END AS reason FROM part WHERE p_partkey % 3 = 0
""")
def left_behind(spark, sf_dir):
    """Items of several kinds of which a third is placed nowhere: the log gives the reason of their kind."""
    kind = "CASE p_size % 5 WHEN 0 THEN 'domain' WHEN 1 THEN 'relationship' WHEN 2 THEN 'attachments' WHEN 3 THEN 'style' ELSE 'layer' END"
    items = derive(spark, sf_dir, f"SELECT p_partkey AS seq, concat(p_name, p_partkey) AS location, {kind} AS kind, 'faithful' AS outcome, CAST(array() AS ARRAY<STRING>) AS losses, CAST(NULL AS STRING) AS reason FROM {{part}}")
    placed = items.where("seq % 3 <> 0").select("seq", "location", "kind", F.lit("d").alias("dataset"))
    return rules.log_items(items, placed).where("state = 'skipped'").select("seq", "reason")
