"""The columnar coder, against one that reads a geometry at a time."""

import json
import random
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tallyhall.functions import geometry as geo
from tallyhall.functions import wkb
from tallyhall.functions.shapes import Shapes

draw = np.random.default_rng(3)


def ring(n):
    angle = np.sort(draw.random(n)) * 2 * np.pi
    xy = np.column_stack([np.cos(angle), np.sin(angle)]) * draw.random() + draw.random(2) * 50
    return np.vstack([xy, xy[:1]])[:: draw.choice([-1, 1])]


def geometry(depth=0, kind=None):
    kind = kind or int(draw.integers(1, 8 if depth < 3 else 7))
    if kind == 1:
        return kind, [draw.random((1, 2))]
    if kind == 2:
        return kind, [draw.random((int(draw.integers(0, 5)), 2))]
    if kind == 3:
        return kind, [ring(int(draw.integers(3, 12))) for _ in range(int(draw.integers(0, 4)))]
    if kind == 7:
        return kind, [geometry(depth + 1) for _ in range(int(draw.integers(0, 4)))]
    return kind, [geometry(9, kind - 3) for _ in range(int(draw.integers(0, 4)))]


def big_endian(geom, dims=2):
    kind, parts = geom
    out = [struct.pack(">BI", 0, kind + 1000 * (dims - 2))]
    pad = lambda xy: np.hstack([xy, np.full((len(xy), dims - 2), 7.0)]).astype(">f8").tobytes()
    if kind == 2:
        out.append(struct.pack(">I", len(parts[0])))
    elif kind != 1:
        out.append(struct.pack(">I", len(parts)))
    for part in parts:
        if kind > 3:
            out.append(big_endian(part, dims))
        else:
            out.append((struct.pack(">I", len(part)) if kind == 3 else b"") + pad(part))
    return b"".join(out)


def test_reads_and_writes_as_one_by_one():
    shapes = [geometry() for _ in range(400)]
    plain = [wkb.write(g) for g in shapes]
    for made in (plain, [big_endian(g, 2 + i % 2) for i, g in enumerate(shapes)]):
        rows = [None if i % 17 == 0 else b for i, b in enumerate(made)]
        got = Shapes.from_wkb(pa.array([b"x", *rows], pa.binary())[1:])
        assert not got.bad.any() and got.null.sum() == 24
        assert got.to_wkb().to_pylist() == [None if i % 17 == 0 else b for i, b in enumerate(plain)]
    with_srid = b"\x01" + struct.pack("<II", 0x20000001, 4326) + struct.pack("<dd", 1, 2)
    assert Shapes.from_wkb(pa.array([with_srid])).to_wkb()[0].as_py() == wkb.write((1, [np.array([[1.0, 2.0]])]))


def test_damaged_rows_cost_themselves_only():
    random_ = random.Random(4)
    good = [wkb.write(geometry()) for _ in range(60)]
    cut = [b[: random_.randrange(len(b))] for b in good]
    odd = [b"", b"\x01", b"\x01\xff\xff\xff\xff", b"\x01" + struct.pack("<II", 3, 1 << 31), bytes(40), b"\x01" + struct.pack("<II", 9, 1)]
    odd += [b"".join([b"\x01" + struct.pack("<II", 7, 1)] * 40)]
    mixed = [x for pair in zip(good, cut) for x in pair] + odd
    got = Shapes.from_wkb(pa.array(mixed, pa.binary()))
    assert got.to_wkb().to_pylist()[: 2 * len(good) : 2] == good
    assert got.bad[len(good) * 2 :].all() and got.bad[1 : 2 * len(good) : 2].all()


def test_orientation_edges_and_checks():
    shapes = [geometry() for _ in range(200)]
    got = Shapes.from_wkb(pa.array([wkb.write(g) for g in shapes])).orient()
    areas = got.signed_areas()
    assert ((areas > 0) != got.hole)[got.in_polygon].all()
    e, row = got.edges()
    turned = Shapes.from_wkb(got.to_wkb())
    assert (turned.edges()[0] == e).all() and (turned.edges()[1] == row).all()
    square = np.array([[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]], float)
    bad = [square[:4], square[:3], np.zeros((5, 2)), np.where(square == 1, np.nan, square), square[[0, 1, 0, 1, 0]]]
    rows = [wkb.write((3, [r])) for r in bad] + [wkb.write((6, [(3, [square]), (3, [square, bad[0]])])), wkb.write((3, [square]))]
    assert Shapes.from_wkb(pa.array(rows)).ill_formed().tolist() == [True] * 6 + [False]


def test_geojson_of_every_kind(spark):
    square, hole = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]], [[1, 1], [1, 2], [2, 2], [2, 1], [1, 1]]
    made = [
        {"type": "Point", "coordinates": [1.5, 2]}, {"type": "LineString", "coordinates": [[0, 0, 9], [1, 1.25, 9]]},
        {"type": "Polygon", "coordinates": [square, hole]}, {"type": "MultiPoint", "coordinates": [[1, 2], [3, 4]]},
        {"type": "MultiLineString", "coordinates": [[[0, 0], [1, 1]], [[2, 2], [3, 3], [4, 4]]]},
        {"type": "MultiPolygon", "coordinates": [[square, hole], [[[9, 9], [10, 9], [10, 10], [9, 9]]]]},
        {"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [1, 2]}, {"type": "Polygon", "coordinates": [square]}]},
        {"type": "MultiPolygon", "coordinates": []}, {"type": "Polygon", "coordinates": [square[::-1]]},
    ]
    rows = [(i, json.dumps(g)) for i, g in enumerate(made)] + [(50, None)]
    df = spark.createDataFrame(rows, "i int, g string").repartition(2)
    got = {r.i: r.w and bytes(r.w) for r in df.select("i", geo.to_wkb(F.col("g"), geojson=True).alias("w")).collect()}
    want = {i: wkb.write(wkb.from_geojson(g)) for i, g in rows if g}
    want[8] = wkb.write(wkb.from_geojson(json.dumps({"type": "Polygon", "coordinates": [square]})))
    assert got == {**want, 50: None}
    bad = ["{", "{}", '{"type":"Polygon"}', '{"type":"Polygon","coordinates":[[1,2]]}', '{"type":"Point","coordinates":[1]}',
           '{"type":"Point","coordinates":["x","y"]}', '{"type":"Curve","coordinates":[1,2]}', '{"type":"LineString","coordinates":[[1,2],null]}',
           '{"type":"Polygon","coordinates":[[[0,0],[1,1],[1,0],[0,1],[0,0]]]}', '{"type":"GeometryCollection"}']
    df = spark.createDataFrame([(b,) for b in bad] + [(rows[2][1],)], "g string")
    loose = df.select(geo.to_wkb(F.col("g"), strict=False, geojson=True).alias("w")).collect()
    assert [r.w is None for r in loose] == [True] * len(bad) + [False]
