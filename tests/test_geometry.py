"""Kernels against hand-computed shapes and the JTS library in Spark's own jars."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhall.functions import geometry as geo
from tallyhall.functions import tiles as tl
from tallyhall.functions import wkb
from tallyhall.operators import spatial
from tallyhall.plans import jobs


def poly(*rings):
    return wkb.write((wkb.POLYGON, [np.array(r, "f8") for r in rings]))


def box(x1, y1, x2, y2):
    return [(x1, y1), (x2, y1), (x2, y2), (x1, y2), (x1, y1)]


def multi(*polygons):
    return wkb.write((wkb.MULTIPOLYGON, [wkb.read(p) for p in polygons]))


ELL = poly([(0, 0), (3, 0), (3, 1), (1, 1), (1, 3), (0, 3), (0, 0)])
HOLED = poly(box(0, 0, 10, 10), box(2, 2, 5, 5))
POINT = wkb.write((wkb.POINT, [np.array([[1.0, 2.0]])]))


def frame(spark, *pairs):
    return spark.createDataFrame(
        [(i, bytearray(a) if a else None, bytearray(b) if b else None) for i, (a, b) in enumerate(pairs)],
        "i int, a binary, b binary",
    )


def apply(spark, pairs, *columns):
    return [tuple(r)[1:] for r in frame(spark, *pairs).select("i", *columns).orderBy("i").collect()]


def test_hand_computed(spark):
    pairs = [
        (ELL, poly(box(0.5, 0.5, 3.5, 3.5))),  # concave: two arms
        (HOLED, poly(box(1, 1, 4, 4))),
        (HOLED, poly(box(3, 3, 4, 4))),  # inside the hole
        (HOLED, poly(box(-5, -5, 50, 50))),
        (poly(box(0, 0, 1, 1)), poly(box(1, 0, 2, 1))),  # shared edge
        (poly(box(0, 0, 1, 1)), poly(box(1, 1, 2, 2))),  # shared corner
        (poly(box(0, 0, 1, 1)), poly(box(1.5, 0, 2, 1))),
        (poly(box(0, 0, 1, 1)[::-1]), poly(box(0, 0, 1, 1))),  # clockwise
        (multi(poly(box(0, 0, 1, 1)), poly(box(5, 5, 7, 7))), poly(box(0.5, 0.5, 6, 6))),
        (None, ELL),
    ]
    a, b = F.col("a"), F.col("b")
    got = apply(spark, pairs, geo.st_intersection_area(a, b, "planar"), geo.st_intersects(a, b))
    want = [2.25, 5, 0, 91, 0, 0, 0, 1, 1.25, None]
    meets = [True, True, False, True, True, True, False, True, True, None]
    assert [g[1] for g in got] == meets
    for (area, _), expected in zip(got, want, strict=True):
        assert area == (None if expected is None else pytest.approx(expected, abs=1e-9))


def test_types_areas_orientation(spark):
    big = wkb.read(ELL)
    big_endian = b"\x00\x00\x00\x00\x03\x00\x00\x00\x01\x00\x00\x00\x07" + big[1][0].astype(">f8").tobytes()
    a = F.col("a")
    got = apply(
        spark, [(ELL, None), (HOLED, None), (POINT, None), (big_endian, None), (None, None)],
        geo.geom_type(a), geo.st_area(a, "planar"), geo.orient(a),
    )
    assert [g[0] for g in got] == [3, 3, 1, 3, None]
    assert [g[1] for g in got] == [5.0, 91.0, 0.0, 5.0, None]
    shell, hole = wkb.read(bytes(got[1][2]))[1]
    assert wkb.signed_area(shell) > 0 > wkb.signed_area(hole)


def test_geography_area(spark):
    square = poly(box(-122, 37, -121.9, 37.1))
    (area,) = apply(spark, [(square, None)], geo.st_area(F.col("a")))[0]
    r = 6371010.0
    want = r * r * math.radians(0.1) * (math.sin(math.radians(37.1)) - math.sin(math.radians(37)))
    assert area == pytest.approx(want, rel=1e-9)


def test_validity(spark):
    bowtie = poly([(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)])
    open_ring = poly([(0, 0), (2, 0), (2, 2), (0, 2)])
    flat = poly([(0, 0), (1, 0), (2, 0), (0, 0)])
    pairs = [(g, None) for g in (ELL, bowtie, open_ring, flat, b"\x01junk", POINT)]
    got = [g[0] is not None for g in apply(spark, pairs, geo.to_wkb(F.col("a"), strict=False))]
    assert got == [True, False, False, False, False, True]
    with pytest.raises(Exception, match="cannot read geometry"):
        apply(spark, [(bowtie, None)], geo.to_wkb(F.col("a")))


def test_validity_against_jts(spark):
    rng = random.Random(9)
    rings = []
    for _ in range(300):
        ring = [(rng.randint(0, 6), rng.randint(0, 6)) for _ in range(rng.randint(3, 6))]
        rings.append(poly([*ring, ring[0]]))
    got = apply(spark, [(r, None) for r in rings], geo.to_wkb(F.col("a"), strict=False))
    reader = spark._jvm.org.locationtech.jts.io.WKBReader()
    valid = [reader.read(bytearray(r)).isValid() for r in rings]
    kept = [g[0] is not None for g in got]
    # Rings that only touch or retrace themselves are let through, never the reverse.
    assert all(k for k, v in zip(kept, valid, strict=True) if v)
    simple = [reader.read(bytearray(r)).getExteriorRing().isSimple() for r in rings]
    assert sum(kept) < len(kept) and sum(simple) > 20


def test_reproject_round_trip(spark):
    there = geo.reproject(F.col("a"), 4326, 3857)
    back = geo.reproject(there, 3857, 4326)
    got = wkb.read(bytes(apply(spark, [(ELL, None)], back)[0][0]))[1][0]
    assert np.allclose(got, wkb.read(ELL)[1][0], atol=1e-9)
    x, y = wkb.read(bytes(apply(spark, [(POINT, None)], there)[0][0]))[1][0][0]
    assert (x, y) == pytest.approx((111319.4908, 222684.2085), abs=1e-3)
    with pytest.raises(ValueError):
        geo.reproject(F.col("a"), 2227, 4326)


def star(rng, holes=False):
    """A random star-shaped, mostly concave ring, optionally with a square hole."""
    cx, cy, n = rng.uniform(-5, 5), rng.uniform(-5, 5), rng.randint(5, 14)
    turns = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
    ring = [(cx + (r := rng.uniform(1.2, 3)) * math.cos(t), cy + r * math.sin(t)) for t in turns]
    ring.append(ring[0])
    gaps = [b - a for a, b in zip(turns, turns[1:], strict=False)]
    gaps.append(2 * math.pi - turns[-1] + turns[0])
    if max(gaps) > 2.5:  # the centre may fall outside
        return star(rng, holes)
    hole = box(cx - 0.2, cy - 0.2, cx + 0.2, cy + 0.2)[::-1]
    return poly(ring, hole) if holes and max(gaps) < 1.5 else poly(ring)


def test_against_jts(spark):
    rng = random.Random(11)
    pairs = [(star(rng, i % 2 == 0), star(rng, i % 3 == 0)) for i in range(120)]
    pairs.append((multi(star(rng)), star(rng)))
    a, b = F.col("a"), F.col("b")
    got = apply(spark, pairs, geo.st_intersection_area(a, b, "planar"), geo.st_intersects(a, b))
    reader = spark._jvm.org.locationtech.jts.io.WKBReader()
    for (x, y), (area, meets) in zip(pairs, got, strict=True):
        left, right = reader.read(bytearray(x)), reader.read(bytearray(y))
        assert meets == left.intersects(right)
        assert area == pytest.approx(left.intersection(right).getArea(), abs=1e-9)


SHAPES = "id int, geometry binary"


def shapes(spark, seed, n, spread):
    """Boxes and stars of very different sizes; every third box is one hot copy."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        size = 10 ** rng.uniform(-2, 1.5)
        x, y = rng.uniform(-spread, spread), rng.uniform(-spread, spread)
        x, y, size = (1.0, 1.0, 0.5) if i % 3 == 0 else (x, y, size)
        shape = star(rng, True) if i % 7 == 1 else poly(box(x, y, x + size, y + size * 0.7))
        rows.append((i, bytearray(shape) if i % 50 else None))
    return rows


@pytest.mark.parametrize("hot", [True, False])
@pytest.mark.parametrize("cut", [4, 256])
def test_join_against_all_pairs(spark, hot, cut, monkeypatch):
    monkeypatch.setattr(geo, "PIECE_EDGES", cut)
    if hot:
        monkeypatch.setattr(spatial, "MIN_HOT", 5)
        monkeypatch.setattr(spatial, "HOT_SHARE", 20)
    left, right = shapes(spark, 1, 150, 20), shapes(spark, 2, 120, 20)
    boxes = [
        (i, j, bytes(g), bytes(h)) for i, g in left for j, h in right if g is not None and h is not None
    ]
    every = spark.createDataFrame(
        [(i, j, bytearray(g), bytearray(h)) for i, j, g, h in boxes], "i int, j int, a binary, b binary"
    )
    area = geo.st_intersection_area(F.col("a"), F.col("b"), "planar")
    want = every.filter(geo.st_intersects(F.col("a"), F.col("b"))).select("i", "j", area.alias("s"))
    want = {(r.i, r.j): r.s for r in want.collect()}
    ldf = spark.createDataFrame(left, SHAPES)
    rdf = spark.createDataFrame(right, SHAPES).withColumnRenamed("id", "rid")
    out = spatial.spatial_join(ldf, rdf, ["id"], ["rid"], kind="left", dedup=False, mode="planar")
    rows = out.collect()
    got = Counter((r.id, r.rid) for r in rows)
    for r in rows:
        assert r.intersection_area == pytest.approx(want.get((r.id, r.rid)), abs=1e-9)
    alone = {i for i, _ in left} - {i for i, _ in want}
    assert got == Counter([*want, *[(i, None) for i in alone]])

    best = spatial.spatial_join(ldf, rdf, ["id"], ["rid"], kind="inner", mode="planar").collect()
    assert sorted(r.id for r in best) == sorted({i for i, _ in want})
    for r in best:
        rival = max(s for (i, _), s in want.items() if i == r.id)
        assert want[r.id, r.rid] == pytest.approx(rival, abs=1e-6)
    left_over = spatial.spatial_anti(ldf, rdf).collect()
    assert {r.id for r in left_over} == alone


def test_many_edges(spark):
    """A comb and a jagged coast, whole or cut, against JTS; long edges do not multiply."""
    rng = random.Random(5)
    coast = [(x / 50, rng.uniform(5, 6)) for x in range(1001)]
    coast = poly([(0, 0), *reversed(coast), (0, 0)][:1] + [(20, 0), *reversed(coast), (0, 0)])
    comb = [(0, 0)]
    for k in range(400):
        comb += [(30, k + 0.2), (30, k + 0.4), (0, k + 0.5)]
    comb = poly([*comb, (-1, 400), (-1, 0), (0, 0)])
    df = spark.createDataFrame([(1, bytearray(coast)), (2, bytearray(comb))], SHAPES)
    sizes = df.select(geo.pieces(F.col("geometry"), "planar").alias("p")).collect()
    assert len(sizes[0].p.edges) > 3
    assert all(sum(map(len, r.p.edges)) <= 5 * 4 * 1300 for r in sizes)
    probes = [(i, rng.uniform(0, 18), rng.uniform(0, 6), rng.uniform(0.1, 9)) for i in range(60)]
    probes = [(i, bytearray(poly(box(x, y, x + w, y + 1)))) for i, x, y, w in probes]
    left = spark.createDataFrame(probes, SHAPES).withColumnRenamed("id", "probe")
    out = spatial.spatial_join(left, df, ["probe"], ["id"], kind="inner", dedup=False, mode="planar")
    reader = spark._jvm.org.locationtech.jts.io.WKBReader()
    shapes = {1: reader.read(bytearray(coast)), 2: reader.read(bytearray(comb))}
    want = {}
    for i, g in probes:
        for k, shape in shapes.items():
            if shape.intersects(reader.read(g)):
                want[i, k] = shape.intersection(reader.read(g)).getArea()
    got = {(r.probe, r.id): r.intersection_area for r in out.collect()}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-8) for k in want)


def test_ties_take_smallest_right(spark):
    ldf = spark.createDataFrame([(1, bytearray(poly(box(0, 0, 2, 2))))], SHAPES)
    halves = [(9, poly(box(0, 0, 1, 2))), (3, poly(box(1, 0, 2, 2))), (1, poly(box(2, 0, 3, 2)))]
    rdf = spark.createDataFrame([(i, bytearray(g)) for i, g in halves], "rid int, geometry binary")
    out = spatial.spatial_join(ldf, rdf, ["id"], ["rid"], mode="planar").collect()
    assert [(r.id, r.rid) for r in out] == [(1, 3)]
    for bad in ({"op": "st_dwithin"}, {"kind": "full"}):
        with pytest.raises(ValueError):
            spatial.spatial_join(ldf, rdf, ["id"], ["rid"], **bad)


def test_empty_sides(spark):
    one = spark.createDataFrame([(1, bytearray(ELL))], SHAPES)
    none = one.limit(0).withColumnRenamed("id", "rid")
    out = spatial.spatial_join(one, none, ["id"], ["rid"], mode="planar").collect()
    assert [(r.id, r.rid) for r in out] == [(1, None)]


def test_tiles(spark):
    df = spark.createDataFrame([(-122.5, 37.5, -122.3, 37.9), (179.9, 10.0, -179.9, 10.1)], "minx double, miny double, maxx double, maxy double")
    got = tl.tiles_for_bounds(df, 9).collect()
    keys = {r.quadkey for r in got if r.minx < 0}
    assert keys == {"023010203", "023010212", "023010221", "023010230"}
    wrapped = [(r.x, r.y) for r in got if r.minx > 0]
    assert {x for x, _ in wrapped} == {0, 511}
    west, south, east, north = spark.range(1).select(*tl.tile_bounds(F.lit(0), F.lit(0), 1)).first()
    assert (west, east, south) == (-180.0, 0.0, pytest.approx(0)) and north == pytest.approx(85.0511287798)


def test_exact_tile_prune(spark):
    """A thin diagonal strip meets far fewer tiles than its bounds."""
    strip = poly([(0, 0), (40, 40), (40.1, 40), (0.1, 0), (0, 0)])
    masks = spark.createDataFrame([(1, bytearray(strip))], SHAPES)
    touching = spatial.tiles_touching(masks, 6, keep=["id"]).count()
    assert 0 < touching < 20


def test_layers_need_known_system(spark):
    df = spark.createDataFrame([(1, bytearray(ELL))], SHAPES)
    loaded, failed = jobs.ingest_layers({"a": (df, 4326), "b": (df, None), "c": (df, 2227)})
    assert set(loaded) == {"a"} and set(failed) == {"b", "c"}
    with pytest.raises(ValueError):
        jobs.load_geo_table(df, "no_database", 4326)
    jobs.load_geo_table(df, "geo.layer_t", 4326)
    jobs.load_geo_table(df, "geo.layer_t", 4326, overwrite=False)
    assert spark.table("geo.layer_t").count() == 2


def two_pass_tiles(masks, zoom):
    """Every tile of the bounds, each held against the whole polygon."""
    shaped = masks.select("id", geo.parts(F.col("geometry"), "planar").alias("_p")).select("id", "_p.*")
    west, south, east, north = bounds = tl.tile_bounds(F.col("x"), F.col("y"), zoom)
    area = geo.edges_overlap(
        geo.box_edges(*bounds), F.col("edges"), F.greatest(west, "minx"), F.least(east, "maxx"),
        F.least((east - west) * (north - south), "area"), "planar",
    )
    return tl.tiles_for_bounds(shaped, zoom).withColumn("_a", area).filter("_a is not null").select("id", "x", "y", "quadkey")


def test_tiles_as_in_two_passes(spark):
    draw = np.random.default_rng(8)

    def star(x, y, r, n):
        angle, size = np.arange(n) * 2 * np.pi / n, r * draw.uniform(0.2, 1, n)
        xy = np.column_stack([x + size * np.cos(angle), y + size * np.sin(angle)])
        return np.vstack([xy, xy[:1]])

    shapes = []
    for _ in range(25):
        x, y, r = draw.uniform(-170, 170), draw.uniform(-75, 75), draw.choice([0.01, 1.0, 9.0])
        hole = np.array([[x - r / 30, y - r / 30], [x + r / 30, y - r / 30], [x, y + r / 30], [x - r / 30, y - r / 30]])
        shapes.append(wkb.write((wkb.POLYGON, [star(x, y, r, int(draw.integers(3, 60))), hole])))
    apart_ = [(wkb.POLYGON, [star(x, 10, 3, 9)]) for x in (20, 40)]
    box = np.array([[-45.0, 0], [0, 0], [0, 45], [-45, 45], [-45, 0]])  # its sides lie on borders of tiles
    ring = np.array([[-60.0, -60], [60, -60], [60, 60], [-60, 60], [-60, -60]])
    shapes += [wkb.write((wkb.MULTIPOLYGON, apart_)), wkb.write((wkb.POLYGON, [box])), wkb.write((wkb.POLYGON, [ring, ring[::-1] / 2]))]
    shapes += [None, POINT, wkb.write((wkb.POLYGON, [np.array([[170.0, 80], [180, 80], [180, 90], [170, 90], [170, 80]])]))]
    masks = spark.createDataFrame(list(enumerate(shapes)), "id int, geometry binary").repartition(3)
    for zoom in (1, 5, 7):
        got = spatial.tiles_touching(masks, zoom, keep=["id"]).collect()
        want = two_pass_tiles(masks, zoom).collect()
        assert len(got) == len(set(got)) and set(map(tuple, got)) == set(map(tuple, want)), zoom
    assert spatial.tiles_touching(masks.limit(0), 5).count() == 0


def test_a_country_at_a_fine_zoom_gives_runs(spark):
    n = 3000
    angle = np.arange(n + 1) * 2 * np.pi / n
    shape = np.column_stack([10 + 8 * np.cos(angle), 50 + 5 * np.sin(angle)])
    shape[-1] = shape[0]
    df = spark.createDataFrame([(wkb.write((wkb.POLYGON, [shape])),)], "geometry binary")
    found = df.select(geo.tile_runs(F.col("geometry"), 12).alias("t")).select("t.runs").first()["runs"]
    tiles = sum(r.x1 - r.x0 + 1 for r in found)
    assert tiles > 20_000 and len(found) < 250


@pytest.mark.parametrize(
    "hot, cut, steps, rows", [(True, 4, 64, 3), (False, 256, 2_000_000, 20_000), (True, 256, 64, 20_000), (False, 4, 2_000_000, 3)]
)
def test_merged_cells_give_the_same_pairs(spark, hot, cut, steps, rows, monkeypatch):
    """Kernels over whole cells against Spark's join of them, in steps of any size."""
    monkeypatch.setattr(geo, "PIECE_EDGES", cut)
    if hot:
        monkeypatch.setattr(spatial, "MIN_HOT", 5)
        monkeypatch.setattr(spatial, "HOT_SHARE", 20)
    ldf = spark.createDataFrame(shapes(spark, 3, 90, 15), SHAPES).withColumn("twice", F.col("id") * 2)
    rdf = spark.createDataFrame(shapes(spark, 4, 80, 15), SHAPES).withColumnRenamed("id", "rid").withColumn("_l_0", F.lit("x"))

    def found(kind):
        out = spatial.spatial_join(ldf, rdf, ["id", "twice"], ["rid", "_l_0"], kind=kind, dedup=False, mode="planar")
        assert out.columns == ["geometry", "id", "twice", "rid", "_l_0", "intersection_area"]
        key = {(r.id, r.rid): r for r in out.collect()}
        return {k: (r.geometry and bytes(r.geometry), r.twice, r._l_0, r.intersection_area) for k, r in key.items()}

    kinds = ("inner", "left") if rows > 3 else ("inner",)
    want = [found(kind) for kind in kinds]
    monkeypatch.setattr(spatial, "MERGE_PIECES", 0)
    monkeypatch.setattr(spatial, "MERGE_ROWS", rows)
    monkeypatch.setattr(spatial, "MERGE_DOUBLES", steps)
    monkeypatch.setattr(geo, "MAX_EDGE_PAIRS", steps)
    for kind, old in zip(kinds, want, strict=True):
        new = found(kind)
        assert new.keys() == old.keys()
        for k in new:
            assert new[k][:3] == old[k][:3] and new[k][3] == pytest.approx(old[k][3], abs=1e-9)


def test_pairs_are_not_shuffled(spark, monkeypatch):
    """Footprints that all overlap: the pairs stay in the tasks that find them."""
    monkeypatch.setattr(spatial, "MERGE_PIECES", 0)
    near = [(i, bytearray(poly(box(i / 1000, 0, 1 + i / 1000, 1)))) for i in range(200)]
    df = spark.createDataFrame(near, SHAPES)
    other = df.withColumnRenamed("id", "other")
    out = spatial.spatial_join(df, other, ["id"], ["other"], kind="inner", dedup=False, mode="planar")
    plan = out._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("MapInArrow")]
    assert "Exchange" not in above and "Join" not in above
    assert out.count() == 200 * 200


def test_upright_edges_are_not_paired(monkeypatch):
    seen = []
    real = geo._edge_pairs
    monkeypatch.setattr(geo, "_edge_pairs", lambda a, b: (seen.append(int((a * b).sum())), real(a, b))[1])
    sides = [0.0, 0, 2, 0, 2, 0, 2, 1, 2, 1, 0, 1, 0, 1, 0, 0]
    edges = geo.pa.array([sides], geo.pa.list_(geo.pa.float64()))
    one = geo.np.ones(1)
    assert geo.overlap_areas(edges, edges, one * 0, one * 2, one * 2, "planar").tolist() == [2.0]
    assert seen == [4, 0]
