"""Cases of the operators that the driver tables do not hold."""

from __future__ import annotations

import random
import struct

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerline.functions import text
from ledgerline.operators import batches, catalog, diff, forest, geometry, pairing, rules
from ledgerline.sources import landed, logs, markup


def rows(frame, *columns):
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=str)


def test_before_and_after_states(spark):
    before = spark.createDataFrame([(1, 12.5), (2, 30.0), (3, 40.0)], "oid long, depth double")
    after = spark.createDataFrame([(1, 13.0), (2, 30.0), (4, 55.0), (None, 1.0)], "oid long, depth double")
    found = diff.snapshot_diff(before, after, ["oid"], ["depth"], [F.col("depth")], [F.col("depth")])
    assert rows(found, "oid", "op") == [(1, "update"), (2, "unchanged"), (3, "delete"), (4, "insert"), (None, "unkeyed")]


def test_a_key_is_consumed_once(spark):
    before = spark.createDataFrame([(1, "a", 0), (1, "b", 1)], "oid long, v string, at int")
    after = spark.createDataFrame([(1, "b", 0), (1, "b", 1)], "oid long, v string, at int")
    found = diff.snapshot_diff(before, after, ["oid"], ["v"], [F.col("at")], [F.col("at")])
    assert rows(found, "op", "ordinal") == [("insert", 2), ("unchanged", 1)]


def test_empty_states(spark):
    empty = spark.createDataFrame([], "oid long, v string")
    some = spark.createDataFrame([(1, None)], "oid long, v string")
    order = [F.col("v")]
    assert rows(diff.snapshot_diff(empty, some, ["oid"], ["v"], order, order), "op") == [("insert",)]
    assert rows(diff.snapshot_diff(some, empty, ["oid"], ["v"], order, order), "op") == [("delete",)]
    assert rows(diff.snapshot_diff(some, some, ["oid"], ["v"], order, order), "op") == [("unchanged",)]
    assert rows(diff.delta_counts(diff.snapshot_diff(empty, empty, ["oid"], ["v"], order, order)), "inserted", "deleted") == [(0, 0)]


@pytest.mark.parametrize("seed", range(4))
def test_applying_a_diff_gives_the_current_state(spark, seed):
    rnd = random.Random(seed)
    state = lambda: [(k, rnd.choice([None, "x", "y"]), rnd.randint(0, 2)) for k in rnd.sample(range(40), 25)]
    schema = "k long, a string, b long"
    before, after = spark.createDataFrame(state(), schema), spark.createDataFrame(state(), schema)
    ops = diff.operations(before, after, ["k"], ["a", "b"], [F.col("k")], [F.col("k")])
    assert rows(diff.apply_operations(before, ops, ["k"], ["a", "b"]), "k", "a", "b") == rows(after, "k", "a", "b")


def test_touched_and_deleted_in_one_window(spark):
    before = spark.createDataFrame([(1, "a"), (2, "b"), (5, "e")], "k long, v string")
    now = spark.createDataFrame([(1, "a"), (3, "c"), (5, "changed but not touched")], "k long, v string")
    touched, gone = spark.createDataFrame([(1,), (1,), (3,), (9,)], "k long"), spark.createDataFrame([(1,), (2,), (7,)], "k long")
    found = diff.change_feed_diff(before, now, touched, gone, "k", ["v"])
    assert rows(found, "k", "op") == [(1, "unchanged"), (1, "unknown"), (2, "delete"), (3, "insert"), (7, "unknown")]


def test_oversize_rows_are_split_off(spark):
    ops = spark.createDataFrame([(1, "x" * 10), (2, "x" * 2000)], "k long, v string")
    fit, over = diff.split_oversize(ops, 1000)
    assert rows(fit, "k") == [(1,)] and rows(over, "k") == [(2,)]


def test_attachments_pair_or_are_refused(spark):
    schema = "oid long, name string, global_id string, size long, content_type string"
    arrived = lambda rows: spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], f"pos int, {schema}")
    basis = arrived(
        [(9, "older", "g1", 6, None), (1, "grown", "g1", 5, None), (1, "same", "g2", 7, "t"), (1, "gone", "g3", 7, None), (2, "twice", None, 1, None), (2, "twice", None, 2, None), (3, "blind", None, None, None), (4, "by name", None, 9, None), (4, None, None, 1, None)]
    )
    listed = arrived(
        [(1, "grown", "g1", 6, None), (1, "same", "g2", 7, "t"), (2, "twice", None, 1, None), (3, "blind", None, None, None), (4, "by name", None, 9, None), (5, "new", "g9", 1, None), (99, "lost", None, 1, None)]
    )
    parents = spark.createDataFrame([(1,), (2,), (3,), (4,), (5,)], "oid long")
    found = pairing.attachment_diff(basis, listed, parents)
    assert rows(found, "name", "op") == [
        ("blind", "incomparable"), ("by name", "unchanged"), ("gone", "delete"), ("grown", "replace"), ("lost", "orphan"), ("new", "add"), ("same", "unchanged"), ("twice", "ambiguous"), (None, "refused"),
    ]


def test_ambiguous_copies_change_nothing(spark):
    loaded = spark.createDataFrame([("f", "a", "1"), ("f", "b", "2"), ("f", "b", "3")], "feature_id string, name string, payload string")
    ops = spark.createDataFrame([("replace", "f", "a", "9"), ("delete", "f", "b", None), ("delete", "f", "c", None), ("add", "f", "d", "4")], "op string, feature_id string, name string, payload string")
    assert rows(pairing.apply_attachments(loaded, ops), "name", "payload") == [("a", "9"), ("b", "2"), ("b", "3"), ("d", "4")]


def test_names_are_never_guessed(spark):
    names = lambda *x: spark.createDataFrame([(n,) for n in x], "name string")
    assert rows(pairing.reconcile_names(names("a", "b"), names("a", "B")), "name", "exported", "state") == [("a", "a", "exact"), ("b", "B", "renamed")]
    assert rows(pairing.reconcile_names(names("a", "b"), names("x")), "name", "state") == [("a", "ambiguous"), ("b", "ambiguous")]
    assert rows(pairing.reconcile_names(names("a"), names()), "name", "state") == [("a", "missing")]


def test_unknown_domains_are_an_error(spark):
    fields = spark.createDataFrame([("d", "1", "f", "nowhere")], "dataset string, code string, field string, domain string")
    known = spark.createDataFrame([("d", "x", 1)], "dataset string, domain string, domain_id long")
    with pytest.raises(Exception, match="unknown domain nowhere"):
        pairing.domain_ids(fields, known).collect()


def test_verdicts_follow_their_losses(spark):
    layers = spark.sql("SELECT 'a' AS name, array(named_struct('name', 'f', 'type', 'x', 'alias', 'F')) AS fields, 'point' AS geometry_type, 4326 AS code, CAST(NULL AS STRING) AS wkt, false AS has_attachments, false AS can_list_attachments")
    (row,) = rules.judge(layers, "layer", rules.HOSTED, "name", "name").collect()
    assert row["outcome"] == "approximated" and row["losses"] == ["aliases are kept but never shown"] and row["target"] == "dataset"
    (row,) = rules.judge(layers, "raster", rules.HOSTED, "name", "name").collect()
    assert row["outcome"] == "unsupported" and row["reason"] and row["target"] is None and row["losses"] == []
    for pack in (rules.HOSTED, rules.FILE, rules.MARKUP):
        assert all(rule.effect in (rules.LOSS, rules.UNSUPPORTED, rules.NOT_APPLICABLE) for rule in pack)
    with pytest.raises(ValueError, match="empty"):
        rules.require_items(rules.judge(layers.limit(0), "layer", rules.HOSTED, "name", "name"))


def test_batches_close_before_either_limit(spark):
    frame = spark.createDataFrame([(0, i, s) for i, s in enumerate([4, 4, 4, 20, 1, 1, 1, 1])] + [(1, 0, None)], "shard int, at int, bytes long")
    packed = batches.greedy_batches(frame, "shard", "at", "bytes", most_rows=3, most_bytes=10)
    assert [r["batch"] for r in packed.where("shard = 0").orderBy("at").collect()] == [0, 0, 1, 2, 3, 3, 3, 4]
    assert rows(batches.batch_sizes(packed, "shard", "bytes"), "shard", "batch", "n_rows")[-1] == (1, 0, 1)


@pytest.mark.parametrize("most_rows, most_bytes, piece", [(5, 60, 37), (500, 2000, 100), (1, 10, 64), (40, 10**9, 50)])
def test_pieces_of_a_shard_give_the_fold(spark, most_rows, most_bytes, piece):
    rnd = random.Random(most_rows)
    sizes = [[rnd.choice([0, 1, 3, 10, 25, 70, 3000]) if k else rnd.randint(0, 3) for _ in range(n)] for k, n in enumerate((700, 900, 1, 120))]
    frame = spark.createDataFrame([(k, at, size if size else None) for k, own in enumerate(sizes) for at, size in enumerate(own)], "shard int, at int, bytes long")
    found = batches.greedy_batches(frame, "shard", "at", "bytes", most_rows, most_bytes, piece)
    expected = []
    for k, own in enumerate(sizes):
        batch = n = total = 0
        for at, size in enumerate(own):
            if n and (n + 1 > most_rows or total + size > most_bytes):
                batch, n, total = batch + 1, 0, 0
            n, total = n + 1, total + size
            expected.append((k, at, batch))
    assert rows(found, "shard", "at", "batch") == sorted(expected, key=str)


def test_a_piece_follows_its_batches_by_doubling():
    draw = np.random.default_rng(0)
    ends = np.concatenate([[0], np.cumsum(draw.integers(0, 3000, 300_000))])
    following = batches.next_starts(ends, 500, 1 << 20)
    last, count = batches.runs_from(following, 500)
    for start in (0, 1, 499):
        at, n = start, 0
        while at < len(following):
            was, at, n = at, int(following[at]), n + 1
        assert (last[start], count[start]) == (was, n)


def test_forests_of_any_depth(spark):
    chain = [(f"c{k}", f"c{k - 1}" if k else None, "E", str(k)) for k in range(1000)]
    others = [("x", "y", "E", None), ("y", "x", "E", None), ("z", "x", "E", None), ("own", "own", "E", None), ("l", "nowhere", "E", None), ("m", "l", "E", None), ("alone", None, "E", None)]
    nodes = spark.createDataFrame(chain + others, "id string, parent string, element string, name string")
    found = {r["id"]: (r["depth"], r["path"], r["reason"]) for r in forest.container_paths(nodes).collect()}
    assert len(found) == len(chain) + len(others)
    for k in (0, 1, 2, 511, 512, 999):
        assert found[f"c{k}"] == (k + 1, "/".join(f"E[{i}]" for i in range(k + 1)), None)
    assert {k: v[2] for k, v in found.items() if v[2]} == {"x": forest.CYCLE, "y": forest.CYCLE, "z": forest.CYCLE, "own": forest.CYCLE, "l": forest.LOST, "m": forest.LOST}
    assert found["alone"] == (1, "E[]", None) and forest.container_paths(nodes.limit(0)).count() == 0


def test_members_of_deeply_nested_groups(spark):
    groups = [(f"g{k}", f"g{k - 1}" if k else None, "group", k, f"G{k}") for k in range(100)]
    layers = [("a", "g99", "layer", 2, "A"), ("b", "g40", "layer", 1, "B"), ("free", None, "layer", 3, "F"), ("p", "q", "group", 4, "P"), ("q", "p", "group", 5, "Q"), ("in p", "p", "layer", 6, "I"), ("e", None, "group", 7, "E")]
    found = {r["group_id"]: tuple(r)[1:] for r in forest.member_lists(spark.createDataFrame(groups + layers, "id string, parent string, kind string, pos int, name string")).collect()}
    assert all(found[f"g{k}"] == ("B, A", 2, None) for k in range(41)) and all(found[f"g{k}"] == ("A", 1, None) for k in range(41, 100))
    assert found["p"] == found["q"] == (None, None, forest.CYCLE) and found["e"] == ("", 0, None) and len(found) == 103


def test_text_functions(spark):
    frame = spark.createDataFrame([("..a b/c..", "\\top\\x", 1743630690000, "1,2,3.5", "2020-01-01"), ("...", "alone", 1743630690007, "1,2", "2020-01-01T00:00:00Z")], "n string, p string, ms long, c string, t string")
    found = frame.select(text.safe_name(F.col("n")).alias("n"), text.path_head(F.col("p")).alias("p"), text.rfc3339(F.col("ms")).alias("ms"), text.has_altitude(F.col("c")).alias("c"), text.is_partial_time(F.col("t")).alias("t"))
    assert [tuple(r) for r in found.collect()] == [("a_b_c", "top", "2025-04-02T21:51:30Z", True, True), ("unnamed", None, "2025-04-02T21:51:30.007Z", False, False)]
    xml = spark.createDataFrame([("<?xml version='1.0'?><!-- <x> --><a:Root y='1'/>",), ("no markup",)], "x string")
    assert [r[0] for r in xml.select(text.root_element(F.col("x"))).collect()] == ["Root", None]


def test_values_fit_their_declared_type_or_are_dropped(spark):
    frame = spark.createDataFrame([('{"i": 1.5, "f": 1, "s": 2}',), ('{"i": 7, "f": 1.25, "s": "x"}',), ("not json",), (None,)], "p string")
    found = catalog.typed_properties(frame, "p", {"i": "integer", "f": "float", "s": "string"})
    assert [r["typed"] for r in found.collect()] == ['{"f":1.0}', '{"i":7,"f":1.25,"s":"x"}', "{}", "{}"]


def test_holes_go_to_the_first_outer_ring_and_orphans_adopt(spark):
    square = lambda x, y, s: [[x, y], [x, y + s], [x + s, y + s], [x + s, y]]
    hole = lambda x, y, s: [[x, y], [x + s, y], [x + s, y + s], [x, y + s]]
    rings = [(1, 0, square(0.0, 0.0, 10.0)), (1, 1, hole(1.0, 1.0, 2.0)), (1, 2, hole(20.0, 20.0, 5.0)), (1, 3, hole(21.0, 21.0, 1.0)), (2, 0, hole(0.0, 0.0, 1.0)), (2, 1, hole(0.2, 0.2, 0.1))]
    frame = spark.createDataFrame(rings, "feature long, pos long, ring array<array<double>>")
    assert rows(geometry.assign_holes(frame), "feature", "pos", "polygon") == [(1, 0, 0), (1, 1, 0), (1, 2, 2), (1, 3, 2), (2, 0, 0), (2, 1, 1)]


def plain_binary(kind, parts, has_z):
    """One shape, written part by part."""
    own = lambda vertices: b"".join(struct.pack(f"<{len(v)}d", *v) for v in vertices)
    if kind == "polygon":
        polygons = [[r for r in rings if r] for rings in parts or []]
        polygons = [rings for rings in polygons if rings]
        vertices = [v for rings in polygons for r in rings for v in r]
    else:
        lines = [p for p in parts or [] if p]
        vertices = [v for p in lines for v in p]
    if kind is None or not vertices:
        return geometry.EMPTY
    base = {2: 0, 3: 1000 if has_z else 2000, 4: 3000}[len(vertices[0])]
    if kind == "point":
        return struct.pack("<BI", 1, base + 1) + own(vertices[:1])
    if kind == "multipoint":
        return struct.pack("<BII", 1, base + 4, len(vertices)) + b"".join(struct.pack("<BI", 1, base + 1) + own([v]) for v in vertices)
    if kind == "polyline":
        return struct.pack("<BII", 1, base + 5, len(lines)) + b"".join(struct.pack("<BII", 1, base + 2, len(p)) + own(p) for p in lines)
    return struct.pack("<BII", 1, base + 6, len(polygons)) + b"".join(struct.pack("<BII", 1, base + 3, len(rings)) + b"".join(struct.pack("<I", len(r)) + own(r) for r in rings) for rings in polygons)


@pytest.mark.parametrize("deep", [False, True])
def test_binary_shapes_of_every_kind(spark, deep):
    rnd = random.Random(3 + deep)
    shapes = []
    for i in range(300):
        width = rnd.choice([2, 3, 4])
        line = lambda: [[rnd.uniform(-9, 9) for _ in range(width)] for _ in range(rnd.choice([0, 1, 2, 5]))]  # noqa: E731, B023
        parts = [[line() for _ in range(rnd.randint(0, 3))] if deep else line() for _ in range(rnd.randint(0, 3))]
        kind = rnd.choice(["polygon", None] if deep else ["point", "multipoint", "polyline", None])
        shapes.append((i, kind, rnd.choice([parts, parts, parts, None]), rnd.choice([True, False, None])))
    depth = "array<array<array<array<double>>>>" if deep else "array<array<array<double>>>"
    frame = spark.createDataFrame(shapes, f"id int, kind string, parts {depth}, has_z boolean")
    found = {r["id"]: bytes(r["wkb"]) for r in geometry.with_binary(frame).collect()}
    assert found == {i: plain_binary(kind, parts, bool(z)) for i, kind, parts, z in shapes}
    assert geometry.with_binary(frame.limit(0)).count() == 0
    spark.conf.set("spark.sql.geospatial.enabled", "true")
    some = [(bytearray(v),) for v in found.values() if v != geometry.EMPTY and int.from_bytes(v[1:5], "little") < 7]
    assert all(r["g"] == r["back"] for r in spark.createDataFrame(some, "g binary").selectExpr("g", "st_asbinary(st_geomfromwkb(g)) AS back").collect())


def test_shapes_that_cannot_be_written():
    one = lambda kind, parts: geometry.binary_shapes([kind], pa.array([parts], pa.list_(pa.list_(pa.list_(pa.float64())))), np.array([False]))
    with pytest.raises(ValueError, match="no shape of kind 'circle'"):
        one("circle", [[[1.0, 2.0]]])
    with pytest.raises(ValueError, match="different numbers"):
        one("polyline", [[[1.0, 2.0], [1.0, 2.0, 3.0]]])
    assert one("point", [[[1.0, 2.0]]])[0].as_py().hex() == "0101000000000000000000f03f0000000000000040"


def test_vertices_that_do_not_fit(spark):
    frame = spark.createDataFrame([('{"x": 1, "y": 2}', True), ('{"rings": [[[0, 0], [1]]]}', False), ('{"paths": [[[0, 0], [1, 1]]], "hasZ": true}', False), (None, True)], "g string, z boolean")
    found = geometry.decode_vertices(frame.withColumn("m", F.lit(False)), "g", "z", "m").collect()
    assert [(r["kind"], r["unencodable"], r["nulled"]) for r in found] == [("point", False, 1), ("polygon", True, None), ("polyline", False, 2), (None, False, None)]
    assert found[0]["parts"] == [[[1.0, 2.0, 0.0]]]


def test_markup_is_read_whole_or_quarantined(spark):
    documents = [(1, "<kml><Document><Placemark><gx:Track xmlns:gx='g'><when>2020-01-01</when><gx:coord>1 2 3</gx:coord></gx:Track></Placemark></Document></kml>"), (2, "<kml><Document>"), (3, "<html/>"), (4, None)]
    found = markup.element_rows(spark.createDataFrame(documents, "id long, body string"), "id", "body")
    assert rows(found.where("problem is not null"), "doc_id") == [(2,), (3,), (4,)]
    assert rows(markup.track_tally(found.where("problem is null")), "tracks", "samples", "partial") == [(1, 1, 1)]
    assert rows(found.where("doc_id = 1"), "seq", "depth", "element")[:3] == [(0, 0, "kml"), (1, 1, "Document"), (2, 2, "Placemark")]


def test_archives_name_their_document(spark):
    import io
    import zipfile

    def archive(*names):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for n in names:
                z.writestr(n, "x")
        return bytearray(out.getvalue())

    frame = spark.createDataFrame([("a", archive("first.kml", "DOC.kml", "img/")), ("b", archive("x.png")), ("c", bytearray(b"junk"))], "path string, content binary")
    found = markup.archive_members(frame)
    assert rows(found.where("chosen"), "archive", "member") == [("a", "DOC.kml")]
    assert rows(found.where("problem is not null"), "archive") == [("b",), ("c",)]


def test_logs_are_read_strictly(spark):
    lines = spark.createDataFrame([('{"type": "insert", "feature_id": "1", "native_srid": 5}',), ('{"type": "delete", "feature_id": "2", "native_srid": 5}',)], "value string")
    assert rows(logs.parse_operations(lines), "type", "native_srid") == [("delete", None), ("insert", 5)]
    with pytest.raises(Exception, match="unknown operation"):
        logs.parse_operations(spark.createDataFrame([('{"feature_id": "1"}',)], "value string")).collect()
    adds = logs.parse_attachment_operations(spark.createDataFrame([('{"name": "n"}',)], "value string"))
    assert rows(adds, "op", "name") == [("add", "n")]


def test_indexes_and_cursors(spark, tmp_path):
    (tmp_path / "index.json").write_text('{"oid": "1", "feature_id": "f", "hash": 5}\n\n{"oid": "2", "feature_id": "g", "hash": -6}\n')
    assert rows(logs.read_index(spark, str(tmp_path / "index.json")), "oid", "hash") == [("1", 5), ("2", -6)]
    (tmp_path / "bad.json").write_text("nonsense\n")
    with pytest.raises(Exception, match="not an index entry"):
        logs.read_index(spark, str(tmp_path / "bad.json")).collect()
    assert logs.read_attachment_index(spark, str(tmp_path / "none.json")).count() == 0
    old = spark.createDataFrame([("s", "a", 0, 5), ("s", "b", 1, 6)], logs.CURSOR)
    new = spark.createDataFrame([("s", "a", 0, 9)], logs.CURSOR)
    assert rows(logs.next_cursor(old, new, "feed"), "dataset", "generation") == [("a", 9), ("b", 6)]
    assert logs.next_cursor(old, new, "local").count() == 0


def test_layers_and_pages_with_nulls(spark):
    documents = spark.createDataFrame([("s", '{"id": 1, "name": "", "geometryType": null, "fields": [{"name": "o", "type": "esriFieldTypeOID", "domain": {"type": "range", "name": "d", "range": [1, 2]}}]}'), ("s", "{}")], "service string, body string")
    found = landed.layers(documents)
    assert rows(found, "id", "name", "kind", "oid_column", "page_size") == [(1, None, "table", "o", 1000), (None, None, "table", None, 1000)]
    assert rows(landed.domains(found), "domain", "kind", "min", "max") == [("d", "range", 1.0, 2.0)]
    pages = spark.createDataFrame([(1, 0, '{"features": [{"attributes": {"a": 1}}]}'), (1, 1, "{}"), (1, 2, None)], "layer int, page int, body string")
    assert landed.page_rows(pages).count() == 1
    with pytest.raises(ValueError, match="no layer 7"):
        landed.scoped(found, "http://x/FeatureServer/7")
