"""Geometry columns: vertex arrays, rings, polygons, and their binary form."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: An empty geometry collection, little-endian: what rows without a shape get.
EMPTY = bytes.fromhex("010700000000000000")

#: Codes of the binary form.
POINT, LINE, POLYGON, MULTI_POINT, MULTI_LINE, MULTI_POLYGON = range(1, 7)


def signed_area(ring: Column) -> Column:
    """Twice the area of an array of (x, y, ...) arrays, positive anticlockwise; the ring need not be closed."""
    n = F.size(ring)
    at = lambda i: F.get(ring, i)
    cross = lambda i: F.get(at(i), F.lit(0)) * F.get(at((i + 1) % n), F.lit(1)) - F.get(at((i + 1) % n), F.lit(0)) * F.get(at(i), F.lit(1))
    terms = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), cross)
    return F.when(n > 0, F.aggregate(terms, F.lit(0.0), lambda total, x: total + x)).otherwise(F.lit(0.0))


def is_outer(ring: Column) -> Column:
    """Whether a ring bounds a polygon from outside (G3): clockwise, without area, or empty."""
    return signed_area(ring) <= 0


def closed(ring: Column) -> Column:
    """The ring with its first vertex at the end (G5), if it has more than two and is open."""
    first, last = F.get(ring, F.lit(0)), F.get(ring, F.size(ring) - 1)
    return F.when((F.size(ring) > 2) & (first != last), F.concat(ring, F.slice(ring, 1, 1))).otherwise(ring)


def contains(ring: Column, x: Column, y: Column) -> Column:
    """Whether a point is inside a ring, by the number of edges that a ray to the right crosses."""
    n = F.size(ring)
    px = lambda i: F.get(F.get(ring, i), F.lit(0))
    py = lambda i: F.get(F.get(ring, i), F.lit(1))

    def crossed(i: Column) -> Column:
        j = (i + n - 1) % n
        over = (py(i) > y) != (py(j) > y)
        return F.when(over & (x < (px(j) - px(i)) * (y - py(i)) / F.nullif(py(j) - py(i), F.lit(0.0)) + px(i)), 1).otherwise(0)

    total = F.aggregate(F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), crossed), F.lit(0), lambda a, b: a + b)
    return (n > 2) & (total % 2 == 1)


def assign_holes(rings: DataFrame) -> DataFrame:
    """feature, pos and polygon (pos of its outer ring) of every ring (G4). rings: feature, pos, ring.

    A hole goes to the first outer ring, by position, that contains its first vertex. A hole in none becomes a
    polygon of its own and can take in later holes; features without any outer ring have a polygon per ring. The
    rings of a feature are folded in order inside its row; features are independent.
    """
    own = F.array_sort(F.collect_list(F.struct("pos", "ring", is_outer(F.col("ring")).alias("outer"))))
    features = rings.groupBy("feature").agg(own.alias("rings"))
    features = features.withColumn("outers", F.filter("rings", lambda r: r["outer"])).withColumn("holes", F.filter("rings", lambda r: ~r["outer"]))
    start = F.struct(F.col("outers").alias("outers"), F.array().cast("array<struct<pos:bigint,polygon:bigint>>").alias("done"))

    def place(state: Column, hole: Column) -> Column:
        x, y = F.get(F.get(hole["ring"], F.lit(0)), F.lit(0)), F.get(F.get(hole["ring"], F.lit(0)), F.lit(1))
        home = F.get(F.filter(state["outers"], lambda o: contains(o["ring"], x, y)), F.lit(0))
        polygon = F.coalesce(home["pos"], hole["pos"]).cast("long")
        outers = F.when(home.isNull(), F.concat(state["outers"], F.array(hole))).otherwise(state["outers"])
        return F.struct(outers.alias("outers"), F.concat(state["done"], F.array(F.struct(hole["pos"].cast("long").alias("pos"), polygon.alias("polygon")))).alias("done"))

    folded = F.aggregate("holes", start, place)["done"]
    alone = F.transform("holes", lambda h: F.struct(h["pos"].cast("long").alias("pos"), h["pos"].cast("long").alias("polygon")))
    outers = F.transform("outers", lambda o: F.struct(o["pos"].cast("long").alias("pos"), o["pos"].cast("long").alias("polygon")))
    every = F.concat(outers, F.when(F.size("outers") > 0, folded).otherwise(alone))
    return features.select("feature", F.explode(every).alias("r")).select("feature", "r.pos", "r.polygon")


def decode_vertices(rows: DataFrame, json_col: str, has_z: str, has_m: str) -> DataFrame:
    """rows with kind, parts (arrays of rings of x, y, z, m), unencodable and nulled ordinates.

    json_col holds {x, y} or points, paths or rings, whose own hasZ and hasM win over the columns'. A vertex with
    fewer than two numbers makes the shape unencodable. Declared z or m that are missing count and become 0.
    """
    schema = "struct<x:double,y:double,z:double,m:double,points:array<array<double>>,paths:array<array<array<double>>>,rings:array<array<array<double>>>,hasZ:boolean,hasM:boolean>"
    g = F.from_json(json_col, schema)
    rows = rows.withColumn("_g", g)
    kind = F.when(F.col("_g.rings").isNotNull(), "polygon").when(F.col("_g.paths").isNotNull(), "polyline").when(F.col("_g.points").isNotNull(), "multipoint").when(F.col("_g.x").isNotNull(), "point")
    z, m = F.coalesce("_g.hasZ", has_z, F.lit(False)), F.coalesce("_g.hasM", has_m, F.lit(False))
    single = F.array(F.array(F.array_compact(F.array("_g.x", "_g.y", "_g.z", "_g.m"))))
    parts = F.when(kind == "polygon", F.col("_g.rings")).when(kind == "polyline", F.col("_g.paths")).when(kind == "multipoint", F.array("_g.points")).when(kind == "point", single)
    bad = F.exists("_parts", lambda part: F.exists(part, lambda p: p.isNull() | (F.size(p) < 2) | F.get(p, F.lit(0)).isNull() | F.get(p, F.lit(1)).isNull()))
    rows = rows.withColumns({"kind": kind, "_z": z, "_m": m, "_parts": parts})
    wanted = F.lit(2) + F.col("_z").cast("int") + F.col("_m").cast("int")
    missing = F.aggregate(F.flatten("_parts"), F.lit(0), lambda n, p: n + F.greatest(wanted - F.size(p), F.lit(0)))
    full = F.transform("_parts", lambda part: F.transform(part, lambda p: F.slice(F.concat(F.transform(p, lambda v: F.coalesce(v, F.lit(0.0))), F.array_repeat(F.lit(0.0), 4)), F.lit(1), wanted)))
    rows = rows.withColumn("unencodable", F.coalesce(bad, F.lit(False)))
    return rows.withColumn("nulled", F.when(~F.col("unencodable"), missing)).withColumn("parts", F.when(~F.col("unencodable"), full)).withColumn("has_z", F.col("_z")).withColumn("has_m", F.col("_m")).drop("_g", "_parts", "_z", "_m")


#: Codes of shapes by kind, and of what they hold (0: nothing of its own).
_KINDS = {"point": (POINT, 0), "multipoint": (MULTI_POINT, POINT), "polyline": (MULTI_LINE, LINE), "polygon": (MULTI_POLYGON, POLYGON)}


def _levels(column: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
    """The offsets of each level of nested lists, outermost first, and the numbers that they hold; null lists are empty."""
    offsets = []
    while pa.types.is_list(column.type) or pa.types.is_large_list(column.type):
        sizes = np.asarray(column.value_lengths().fill_null(0)).astype(np.int64)
        offsets.append(np.concatenate([[0], np.cumsum(sizes)]))
        column = column.flatten()
    return offsets, np.asarray(column.fill_null(0.0) if column.null_count else column, np.float64)


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of values over the runs that offsets give."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]


def binary_shapes(kinds: list[str | None], parts: pa.Array, has_z: np.ndarray) -> pa.Array:
    """Shapes of a batch in ISO binary, little-endian: lines and polygons always as multi-shapes, z and m in the type code.

    All headers and all numbers of the batch are laid out at once: the output is a row of segments, each a header and the numbers
    behind it; a mask over its bytes says which belong to headers. parts: arrays of vertices per shape, or of rings per polygon.
    A point is its first vertex; parts and polygons without vertices are left out; a null kind or no vertex gives EMPTY.
    """
    levels, numbers = _levels(parts)
    deep = len(levels) == 4
    unknown = sorted({k for k in kinds if k is not None and (k not in _KINDS or (k == "polygon") != deep)})
    if unknown:
        raise ValueError(f"no shape of kind {unknown[0]!r}")
    shape = np.array([list(_KINDS).index(k) if k is not None else -1 for k in kinds], np.int64)
    groups, runs, vertices = levels[0], levels[-2], np.diff(levels[-1])  # groups of runs of vertices of numbers
    if deep:  # a group of rings for each polygon
        ring_of, polygons = levels[1], groups
        rings = np.diff(runs)
        kept_rings = rings > 0
        row_of_polygon = np.repeat(np.arange(len(kinds)), np.diff(polygons))
        alive = shape[row_of_polygon] >= 0
        n_rings = _sums(kept_rings.astype(np.int64), ring_of) * alive
        kept_polygons = n_rings > 0
        row_of_run = np.repeat(row_of_polygon, np.diff(ring_of))
        keep_run = kept_rings & (shape[row_of_run] >= 0)
    else:
        row_of_run = np.repeat(np.arange(len(kinds)), np.diff(groups))
        keep_run = (np.diff(runs) > 0) & (shape[row_of_run] >= 0)
    sizes = np.diff(runs)
    row_of_vertex = np.repeat(row_of_run, sizes)
    keep = np.repeat(keep_run, sizes)
    is_point = shape == 0
    if is_point.any():  # only the first vertex that is kept
        at = np.flatnonzero(keep & is_point[row_of_vertex])
        first = at[np.unique(row_of_vertex[at], return_index=True)[1]]
        keep = keep & ~is_point[row_of_vertex]
        keep[first] = True
    rows = len(kinds)
    held = np.bincount(row_of_vertex[keep], minlength=rows)
    width = np.zeros(rows, np.int64)
    width[row_of_vertex[keep]] = vertices[keep]
    if (vertices[keep] != width[row_of_vertex[keep]]).any():
        raise ValueError("the vertices of a shape have different numbers of ordinates")
    there = held > 0
    dimension = np.where(width == 4, 3000, np.where(width == 2, 0, np.where(has_z, 1000, 2000)))
    codes = np.array([c for c, _ in _KINDS.values()] + [7])[shape] + np.where(there, dimension, 0)
    codes[~there] = 7
    inner = np.array([c for _, c in _KINDS.values()] + [0])[shape] + dimension
    # segments behind the shape's own header: vertices of multipoints, lines, or polygons and their rings
    line, many = shape == 2, shape == 1
    per_run = np.where(line[row_of_run] & keep_run, 1, 0) if not deep else keep_run.astype(np.int64)
    count = np.bincount(row_of_run, per_run, rows).astype(np.int64) if not deep else np.bincount(row_of_polygon[kept_polygons], minlength=rows)
    count = np.where(many, held, count) * there
    behind = count + (np.bincount(row_of_run[keep_run], minlength=rows) * there if deep else 0)
    start = np.concatenate([[0], np.cumsum(1 + behind)])
    total = int(start[-1])
    head, length, data = np.zeros((total, 9), np.uint8), np.full(total, 9, np.int64), np.zeros(total, np.int64)
    code, number, lead = np.zeros(total, np.uint32), np.zeros(total, np.uint32), np.ones(total, np.uint8)
    own = start[:-1]
    code[own], number[own] = codes, count
    length[own[is_point & there]] = 5
    data[own[is_point & there]] = 8 * width[is_point & there]
    lengths_of_run = np.where(keep_run, sizes, 0)

    def placed(row_of: np.ndarray) -> np.ndarray:
        """Segments of things that follow each other in rows, counted from the row's first one."""
        fresh = np.concatenate([[True], row_of[1:] != row_of[:-1]]) if len(row_of) else np.zeros(0, bool)
        begin = np.maximum.accumulate(np.where(fresh, np.arange(len(row_of)), 0))
        return own[row_of] + 1 + np.arange(len(row_of)) - begin

    if deep:
        # a polygon's header stands before its rings: both in order of their places
        which = np.flatnonzero(keep_run)
        polygon_of_run = np.repeat(np.arange(len(row_of_polygon)), np.diff(ring_of))[which]
        opens = np.concatenate([[True], polygon_of_run[1:] != polygon_of_run[:-1]]) if len(which) else np.zeros(0, bool)
        row = row_of_run[which]
        before = np.cumsum(opens)
        first = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows) + np.bincount(row[opens], minlength=rows))])
        ring_at = own[row] + 1 + np.arange(len(which)) + before - first[row]
        at = ring_at[opens] - 1
        code[at], number[at] = inner[row[opens]], n_rings[polygon_of_run[opens]]
        number[ring_at], length[ring_at], data[ring_at] = sizes[which], 4, 8 * width[row] * sizes[which]
    else:
        which = np.flatnonzero(per_run)
        at = placed(row_of_run[which])
        code[at], number[at], data[at] = inner[row_of_run[which]], lengths_of_run[which], 8 * width[row_of_run[which]] * sizes[which]
        which = np.flatnonzero(keep & many[row_of_vertex])
        at = placed(row_of_vertex[which])
        code[at], length[at], data[at] = inner[row_of_vertex[which]], 5, 8 * width[row_of_vertex[which]]
    head[:, 0] = lead
    head[:, 1:5] = code.astype("<u4").view(np.uint8).reshape(-1, 4)
    head[:, 5:9] = number.astype("<u4").view(np.uint8).reshape(-1, 4)
    place = np.arange(9)[None, :]
    used = np.where((length == 4)[:, None], place >= 5, place < length[:, None])
    mask = np.repeat(np.tile([True, False], total), np.stack([length, data], 1).ravel())
    out = np.empty(len(mask), np.uint8)
    out[mask] = head[used]
    out[~mask] = numbers[np.repeat(keep, vertices)].astype("<f8").view(np.uint8)
    ends = np.concatenate([[0], np.cumsum(length + data)])[start]
    return pa.Array.from_buffers(pa.large_binary(), rows, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(out)]).cast(pa.binary())


def with_binary(rows: DataFrame, kind: str = "kind", parts: str = "parts", has_z: str = "has_z", out: str = "wkb") -> DataFrame:
    """rows with their shapes in binary form (G6, X3), in one pass over Arrow batches; null or empty shapes get EMPTY.

    For polygons parts holds one array of closed rings per polygon (array<array<ring>>), else arrays of vertices.
    """
    schema = rows.select("*", F.lit(None).cast("binary").alias(out)).schema

    def pack(batches):
        for batch in batches:
            if batch.num_rows:
                z = np.asarray(batch.column(has_z).fill_null(False))
                shapes = binary_shapes(batch.column(kind).to_pylist(), batch.column(parts), z)
                yield pa.RecordBatch.from_arrays([*batch.columns, shapes], [*batch.schema.names, out])

    return rows.mapInArrow(pack, schema)
