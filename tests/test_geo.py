"""Geometry and terrain against brute force in plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from rideloom.functions import geo as gf
from rideloom.operators import geo, terrain

RINGS = "zone int, rings array<array<struct<lon: double, lat: double>>>"
# An L-shape, a triangle and a zone of two parts (one inside the notch of the L).
SHAPES = {
    1: [[(0.0, 0.0), (4.0, 0.0), (4.0, 1.0), (1.0, 1.0), (1.0, 4.0), (0.0, 4.0)]],
    2: [[(5.0, 5.0), (9.0, 5.0), (7.0, 9.0)]],
    3: [[(2.0, 2.0), (3.0, 2.0), (3.0, 3.0), (2.0, 3.0)], [(6.0, 0.5), (8.0, 0.5), (8.0, 2.5), (6.0, 2.5)]],
}


def inside(x, y, ring):
    odd = False
    for (xi, yi), (xj, yj) in zip(ring, ring[-1:] + ring[:-1]):
        if (yi > y) != (yj > y) and x < (xj - xi) * (y - yi) / (yj - yi) + xi:
            odd = not odd
    return odd


@pytest.mark.parametrize("cell", [0.5, 3.0, 0.01])
def test_point_in_zone(spark, cell):
    rng = random.Random(7)
    pts = [(i, rng.uniform(-1, 10), rng.uniform(-1, 10)) for i in range(1500)]
    zones = spark.createDataFrame(list(SHAPES.items()), RINGS)
    got = geo.point_in_zone(spark.createDataFrame(pts, "id int, px double, py double"), zones, cell=cell)
    want = {(i, z) for i, x, y in pts for z, rings in SHAPES.items() if any(inside(x, y, r) for r in rings)}
    assert {(r["id"], r["zone"]) for r in got.collect()} == want


def seg_gap(p, a, b):
    dx, dy = b[0] - a[0], b[1] - a[1]
    length = dx * dx + dy * dy
    k = 0 if length == 0 else max(0, min(1, ((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / length))
    return math.dist(p, (a[0] + k * dx, a[1] + k * dy))


def ring_gap(r, s):
    if inside(*r[0], s) or inside(*s[0], r):
        return 0.0
    def sides(ring):
        return list(zip(ring, ring[1:] + ring[:1]))

    return min(
        [seg_gap(p, *side) for p in r for side in sides(s)] + [seg_gap(p, *side) for p in s for side in sides(r)]
    )


def test_distance_join(spark):
    rng = random.Random(3)
    boxes = {}
    for zone in range(60):
        x, y = rng.uniform(-74.2, -74.0), rng.uniform(40.5, 40.65)
        w, h = rng.uniform(0.001, 0.012), rng.uniform(0.001, 0.012)
        boxes[zone] = [(x, y), (x + w, y), (x + w * 1.3, y + h), (x, y + h * 0.7)]
    zones = spark.createDataFrame([(z, [r]) for z, r in boxes.items()], RINGS)
    metres = {
        r["zone"]: [(p["x"], p["y"]) for p in r["v"]]
        for r in zones.select("zone", F.transform(F.col("rings")[0], lambda p: F.struct(
            gf.utm(p["lon"], p["lat"])[0].alias("x"), gf.utm(p["lon"], p["lat"])[1].alias("y"))).alias("v")).collect()
    }
    want = {}
    for a in boxes:
        for b in boxes:
            if a != b:
                gap = ring_gap(metres[a], metres[b])
                if gap <= 800:
                    want[a, b] = gap
    rows = geo.distance_join(zones, 800.0).collect()
    got = {(r["zone"], r["neighbor"]): r["distance_m"] for r in rows}
    assert len(rows) == len(got) and got.keys() == want.keys()
    # crossing boxes have distance 0 in the join; the brute force above measures their corners
    assert all(abs(got[p] - want[p]) < 1e-3 or got[p] == 0 for p in got)


def test_crossing_polygons_touch(spark):
    bars = {1: [[(-74.10, 40.60), (-74.00, 40.60), (-74.00, 40.61), (-74.10, 40.61)]],
            2: [[(-74.06, 40.55), (-74.05, 40.55), (-74.05, 40.65), (-74.06, 40.65)]]}
    rows = geo.distance_join(spark.createDataFrame(list(bars.items()), RINGS), 10.0).collect()
    assert {(r["zone"], r["neighbor"], r["distance_m"]) for r in rows} == {(1, 2, 0.0), (2, 1, 0.0)}


def test_utm_known_points(spark):
    """On the central meridian the easting is 500 km; a degree east at the equator is 111.3 km away."""
    e, n = gf.utm(F.col("lon"), F.col("lat"))
    rows = spark.createDataFrame([(-75.0, 40.0), (-74.0, 0.0)], "lon double, lat double").select(
        e.alias("e"), n.alias("n")).collect()
    assert abs(rows[0]["e"] - 500000) < 1e-6 and abs(rows[0]["n"] - 4427757.219) < 0.01
    assert abs(rows[1]["e"] - 611280.87) < 1 and abs(rows[1]["n"]) < 1e-6


def test_nearest_zone(spark):
    rng = random.Random(11)
    # most centres in one dense spot, some far away
    centers = [(z, rng.gauss(0, 0.01), rng.gauss(0, 0.01)) for z in range(60)] + [
        (100 + z, rng.uniform(-5, 5), rng.uniform(-5, 5)) for z in range(8)
    ]
    pts = [(i, rng.uniform(-6, 6), rng.uniform(-6, 6)) for i in range(300)] + [
        (1000 + i, rng.gauss(0, 0.02), rng.gauss(0, 0.02)) for i in range(100)
    ]
    more = [(1, pts[1][1], pts[1][2]), (2000, None, 1.0), (2001, 40.0, -90.0), (2001, 40.0, -90.0)]
    got = geo.nearest_zone(
        spark.createDataFrame(pts + more, "id int, px double, py double"),
        spark.createDataFrame(centers + [(999, None, 0.0)], "zone int, cx double, cy double"), "id",
    )
    pts = pts + more[2:3]
    want = {i: min((abs(cx - x) + abs(cy - y), z) for z, cx, cy in centers)[1] for i, x, y in pts}
    rows = got.collect()
    assert len(rows) == len(want) + 3 and {r["id"]: r["zone"] for r in rows} == {**want, 2000: None}
    none = geo.nearest_zone(got.selectExpr("id", "1d px", "1d py"), spark.createDataFrame([], "zone int, cx double, cy double"), "id")
    assert none.filter("zone is null").count() == len(rows)


def test_block_mean_and_snap(spark):
    spec = terrain.GridSpec(lon_min=-74.2, lat_min=40.5, lon_max=-74.1, lat_max=40.6, nx=7, ny=5, z=11)
    def px(lon):
        return (lon + 180) / 360 * 2048 * 256

    def py(lat):
        return (1 - math.asinh(math.tan(math.radians(lat))) / math.pi) / 2 * 2048 * 256

    x0, y0 = int(px(-74.2)) - 3, int(py(40.6)) - 3
    pixels = [(x0 + i, y0 + j, 127 + (i + j) % 2, (i * 37) % 256, (j * 91) % 256) for i in range(155) for j in range(205)]
    got = {
        (r["i"], r["j"]): r["elev"]
        for r in terrain.block_mean_grid(spark.createDataFrame(pixels, "px long, py long, r int, g int, b int"), spec).collect()
    }
    height = {(x, y): r * 256 + g + b / 256 - 32768 for x, y, r, g, b in pixels}
    for i in range(7):
        for j in range(5):
            lon = [-74.2 + 0.1 * k / 7 for k in (i, i + 1)]
            lat = [40.5 + 0.1 * k / 5 for k in (j, j + 1)]
            cell = [height[x, y] for x in range(int(px(lon[0])), int(px(lon[1]))) for y in range(int(py(lat[1])), int(py(lat[0])))]
            assert abs(got[i, j] - max(0.0, sum(cell) / len(cell))) <= 0.0501
    rng = random.Random(2)
    pts = [(i, rng.uniform(-74.25, -74.05), rng.uniform(40.45, 40.65)) for i in range(400)]
    lons = [round((-74.2 + (-74.1 - -74.2) * i / 7 + -74.2 + (-74.1 - -74.2) * (i + 1) / 7) / 2, 4) for i in range(7)]
    snapped = terrain.snap(spark.createDataFrame(pts, "id int, px double, py double"), spec).collect()
    for row in snapped:
        assert row["i"] == min(range(7), key=lambda i: (abs(lons[i] - row["px"]), i))


HOLED = "zone int, rings array<array<struct<lon: double, lat: double>>>, holes array<array<array<struct<lon: double, lat: double>>>>"


def box(x, y, w, h):
    return [(float(a), float(b)) for a, b in ((x, y), (x + w, y), (x + w, y + h), (x, y + h))]


# A frame with two holes, an island of the same zone in one of them, a triangle in the other; zone 3 has null holes.
WITH_HOLES = [
    (1, [box(0, 0, 10, 6), box(2, 2, 1, 1)], [[box(1, 1, 3, 3), [(5.0, 1.0), (9.0, 1.0), (7.0, 5.0)]], []]),
    (2, [[(6.5, 1.5), (7.5, 1.5), (7.0, 3.0)]], []),
    (3, [box(4.2, 1.0, 0.5, 0.5)], None),
    (4, [box(12, 0, 3, 3), box(20, 0, 2, 2)], [[box(13, 1, 1, 1)]]),
]


def in_holed(x, y, rings, holes):
    inner = [h or [] for h in (holes or [])] + [[]] * len(rings)
    return any(inside(x, y, r) and not any(inside(x, y, h) for h in hs) for r, hs in zip(rings, inner))


@pytest.mark.parametrize("cell", [0.7, 6.0])
def test_points_in_holes_are_outside(spark, cell):
    rng = random.Random(9)
    pts = [(i, rng.uniform(-1, 23), rng.uniform(-1, 7)) for i in range(4000)] + [(9000, 1.0, 1.0), (9001, 4.0, 4.0), (9002, 2.0, 2.0)]
    zones = spark.createDataFrame(WITH_HOLES, HOLED)
    got = geo.point_in_zone(spark.createDataFrame(pts, "id int, px double, py double"), zones, cell=cell)
    want = {(i, z) for i, x, y in pts for z, rings, holes in WITH_HOLES if in_holed(x, y, rings, holes)}
    assert {(r["id"], r["zone"]) for r in got.collect()} == want and len(want) > 500


def test_distances_stop_at_the_ring_of_a_hole(spark):
    """The same shapes in hundredths of a degree; a zone in a hole is apart, one in the solid part is not."""
    def small(ring):
        return [(-74.3 + x / 100, 40.5 + y / 100) for x, y in ring]

    rows = [(z, [small(r) for r in rings], None if holes is None else [[small(h) for h in hs] for hs in holes]) for z, rings, holes in WITH_HOLES]
    zones = spark.createDataFrame(rows, HOLED)
    place = F.transform("rings", lambda r: F.transform(r, lambda p: F.struct(*gf.utm(p["lon"], p["lat"]))))
    metres = {r["zone"]: r for r in zones.select("zone", place.alias("r"), F.transform("holes", lambda hs: F.transform(
        hs, lambda h: F.transform(h, lambda p: F.struct(*gf.utm(p["lon"], p["lat"]))))).alias("h")).collect()}

    def want(a, b):
        ra, rb = ([tuple(map(tuple, r)) for r in metres[z]["r"]] for z in (a, b))
        ha, hb = ([[tuple(map(tuple, h)) for h in hs] for hs in metres[z]["h"] or []] for z in (a, b))
        if any(in_holed(*r[0], rb, hb) for r in ra) or any(in_holed(*r[0], ra, ha) for r in rb):
            return 0.0
        sides = lambda r: list(zip(r, r[1:] + r[:1]))
        all_a, all_b = ra + [h for hs in ha for h in hs], rb + [h for hs in hb for h in hs]
        return min([seg_gap(p, *s) for r in all_a for p in r for q in all_b for s in sides(q)]
                   + [seg_gap(p, *s) for r in all_b for p in r for q in all_a for s in sides(q)])

    got = {(r["zone"], r["neighbor"]): r["distance_m"] for r in geo.distance_join(zones, 20_000.0).collect()}
    assert got.keys() == {(a, b) for a in range(1, 5) for b in range(1, 5) if a != b}
    assert all(abs(got[p] - want(*p)) < 1e-3 for p in got)
    assert got[1, 2] > 0 and got[1, 3] == 0
