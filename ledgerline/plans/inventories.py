"""Queries over markup inventories and archives: a document per part, its elements tallied in every way that the rules ask for."""

from __future__ import annotations

import io
import zipfile

import pyarrow as pa
from pyspark.sql import functions as F

from ..session import table
from ..sources import markup
from .base import query

#: Documents with tracks, extended data, styles, style maps, regions and overlays, by the numbers of a part.
BODY = """concat('<kml><Document>',
 repeat('<Placemark><ExtendedData><Data name="a"/><Data name="b"/></ExtendedData></Placemark>', CAST(p_size % 3 AS INT)),
 CASE WHEN p_partkey % 2 = 0 THEN '<Placemark><ExtendedData><Data name="c"/><SchemaData/></ExtendedData><Point/></Placemark>' ELSE '' END,
 CASE WHEN p_size % 4 = 0 THEN concat('<Placemark><Track>', repeat('<when>2020-01-01</when><coord>1 2 3</coord>', CAST(p_size % 5 AS INT)), '<when>2020-01-01T00:00:00Z</when><Model/><ExtendedData><Data name="t"/><SchemaData/></ExtendedData></Track></Placemark>') ELSE '' END,
 CASE WHEN p_size % 3 = 1 THEN '<Style><LineStyle/><IconStyle/></Style>' WHEN p_size % 3 = 2 THEN '<Style><BalloonStyle/></Style><StyleMap><Pair><key>normal</key></Pair><Pair><key>highlight</key></Pair></StyleMap>' ELSE '' END,
 CASE WHEN p_partkey % 5 = 0 THEN concat('<Region><Lod/></Region><GroundOverlay><LatLonBox><rotation>', p_size % 2, '</rotation></LatLonBox></GroundOverlay>') ELSE '' END,
 '</Document></kml>')"""


def _elements(spark, sf_dir):
    return markup.element_rows(table(spark, sf_dir, "part").select("p_partkey", F.expr(BODY).alias("body")), "p_partkey", "body")


@query("markup_extended_data", """
SELECT p_partkey AS doc_id, p_size % 3 + CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END AS rows, CASE WHEN p_size % 3 > 0 THEN 2 ELSE 0 END + CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END AS keys, CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END AS blocks FROM part
""")
def markup_extended_data(spark, sf_dir):
    return markup.extended_data_tally(_elements(spark, sf_dir))


@query("markup_tracks", """
SELECT p_partkey AS doc_id, CASE WHEN t THEN 1 ELSE 0 END AS tracks, CASE WHEN t THEN p_size % 5 ELSE 0 END AS samples, CASE WHEN t THEN p_size % 5 ELSE 0 END AS partial, CASE WHEN t THEN 1 ELSE 0 END AS models FROM (SELECT *, p_size % 4 = 0 AS t FROM part)
""")
def markup_tracks(spark, sf_dir):
    return markup.track_tally(_elements(spark, sf_dir))


@query("markup_styles", "SELECT p_partkey AS doc_id, CASE p_size % 3 WHEN 1 THEN 'IconStyle, LineStyle' WHEN 2 THEN 'BalloonStyle' ELSE '' END AS parts, CASE WHEN p_size % 3 = 2 THEN 'highlight, normal' ELSE '' END AS states FROM part")
def markup_styles(spark, sf_dir):
    return markup.style_parts(_elements(spark, sf_dir))


@query("markup_overlays", """
SELECT p_partkey AS doc_id, o AS regions, o AS lods, o AS overlays, o * (p_size % 2) AS rotated FROM (SELECT *, CASE WHEN p_partkey % 5 = 0 THEN 1 ELSE 0 END AS o FROM part)
""")
def markup_overlays(spark, sf_dir):
    return markup.overlay_tally(_elements(spark, sf_dir))


@query("markup_unruled", """
SELECT element, CAST(SUM(n) AS BIGINT) AS n FROM (SELECT 'Data' AS element, 2 * (p_size % 3) + CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END + CASE WHEN p_size % 4 = 0 THEN 1 ELSE 0 END AS n FROM part UNION ALL SELECT 'coord', p_size % 5 FROM part WHERE p_size % 4 = 0
  UNION ALL SELECT 'LatLonBox', 1 FROM part WHERE p_partkey % 5 = 0) GROUP BY 1 HAVING SUM(n) > 0
""")
def markup_unruled(spark, sf_dir):
    ruled = "kml Document Placemark ExtendedData SchemaData Point Track when Model Style LineStyle IconStyle BalloonStyle StyleMap Pair key Region Lod GroundOverlay rotation".split()
    return markup.unruled(_elements(spark, sf_dir), ruled)


@query("markup_row_kinds", """
SELECT doc_id, kind, CAST(SUM(n) AS BIGINT) AS n FROM (SELECT p_partkey AS doc_id, 'none' AS kind, p_size % 3 AS n FROM part UNION ALL SELECT p_partkey, 'Point', 1 FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT p_partkey, 'Track', 1 FROM part WHERE p_size % 4 = 0)
WHERE n > 0 GROUP BY 1, 2
""")
def markup_row_kinds(spark, sf_dir):
    return markup.row_kinds(_elements(spark, sf_dir)).select("doc_id", "kind", "n")


def _archives(spark, sf_dir):
    """An archive per part: a document (or two, or none), a folder and images."""

    def build(batches):
        for batch in batches:
            out = []
            for key, size in zip(batch.column("p_partkey").to_pylist(), batch.column("p_size").to_pylist()):
                packed = io.BytesIO()
                with zipfile.ZipFile(packed, "w") as archive:
                    archive.writestr("images/", b"")
                    for i in range(size % 3):
                        archive.writestr(f"images/{i}.png", b"x" * (10 + i))
                    if key % 4 != 0:
                        archive.writestr("a.kml", b"<kml/>")
                    if key % 4 == 2:
                        archive.writestr("DOC.kml", b"<kml></kml>")
                out.append(packed.getvalue() if key % 10 else b"no archive")
            yield pa.RecordBatch.from_arrays([batch.column("p_partkey").cast(pa.string()), pa.array(out, pa.binary())], ["path", "content"])

    return table(spark, sf_dir, "part").select("p_partkey", "p_size").mapInArrow(build, "path string, content binary")


@query("archive_members", """
WITH a AS (SELECT p_partkey AS k, CAST(p_partkey AS VARCHAR) AS archive, p_size FROM part WHERE p_partkey % 10 <> 0)
SELECT archive, 'images/' || i || '.png' AS member, CAST(10 + i AS BIGINT) AS size, false AS chosen FROM a, range(2) AS r(i) WHERE i < p_size % 3
UNION ALL SELECT archive, 'a.kml', 6, k % 4 <> 2 FROM a WHERE k % 4 <> 0 UNION ALL SELECT archive, 'DOC.kml', 11, true FROM a WHERE k % 4 = 2
""")
def archive_members(spark, sf_dir):
    return markup.archive_members(_archives(spark, sf_dir)).where("member is not null").select("archive", "member", "size", "chosen")


@query("archive_problems", "SELECT CAST(p_partkey AS VARCHAR) AS archive FROM part WHERE p_partkey % 10 = 0 OR p_partkey % 4 = 0")
def archive_problems(spark, sf_dir):
    return markup.archive_members(_archives(spark, sf_dir)).where("problem is not null").select("archive")


@query("archive_totals", """
WITH a AS (SELECT p_partkey AS k, p_size % 3 AS images FROM part WHERE p_partkey % 10 <> 0)
SELECT CAST(k AS VARCHAR) AS archive, CAST(images + CASE WHEN k % 4 = 2 THEN 1 ELSE 0 END AS BIGINT) AS others,
  CAST(CASE WHEN images + CASE WHEN k % 4 = 2 THEN 1 ELSE 0 END > 0 THEN CASE images WHEN 0 THEN 0 WHEN 1 THEN 10 ELSE 21 END + CASE WHEN k % 4 = 2 THEN 6 ELSE 0 END END AS BIGINT) AS bytes
FROM a WHERE images > 0 OR k % 4 <> 0
""")
def archive_totals(spark, sf_dir):
    return markup.archive_totals(markup.archive_members(_archives(spark, sf_dir)))
