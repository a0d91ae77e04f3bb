"""Spatial joins and zone geometry.

Zone frames have ``zone`` and ``rings``, the shells of its polygons (lon/lat), and may have ``holes``: for each
shell, in the same order, the list of the rings cut out of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rideloom.functions.geo import in_edges, polygon_edges, polygons_distance, utm
from rideloom.functions.once import computed_once
from rideloom.workspace import cut_lineage


_HOLES = "array<array<array<struct<lon: double, lat: double>>>>"


def _holes(zones: DataFrame) -> Column:
    """The holes of a zone frame, none where it has no such column."""
    return (F.col("holes") if "holes" in zones.columns else F.array()).cast(_HOLES)


def _vertices(zones: DataFrame) -> DataFrame:
    return zones.select("zone", F.explode(F.flatten("rings")).alias("v")).select("zone", "v.lon", "v.lat")


def zone_center(zones: DataFrame) -> DataFrame:
    """Mean of the vertices of the first ring."""
    first = F.element_at("rings", 1)
    total = F.aggregate(
        first,
        F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y")),
        lambda acc, p: F.struct((acc["x"] + p["lon"]).alias("x"), (acc["y"] + p["lat"]).alias("y")),
    )
    return zones.select("zone", total.alias("t"), F.size(first).alias("n")).select(
        "zone", (F.col("t.x") / F.col("n")).alias("cx"), (F.col("t.y") / F.col("n")).alias("cy")
    )


def borough_centroid(centers: DataFrame, zones: DataFrame) -> DataFrame:
    """Mean of the zone centres of each borough."""
    named = centers.join(zones.select(F.col("id").alias("zone"), "borough"), "zone")
    return named.groupBy("borough").agg(F.avg("cx").alias("cx"), F.avg("cy").alias("cy"), F.count("*").alias("zones"))


def bbox(zones: DataFrame) -> DataFrame:
    return _vertices(zones).groupBy("zone").agg(
        F.min("lon").alias("x0"), F.min("lat").alias("y0"), F.max("lon").alias("x1"), F.max("lat").alias("y1")
    )


def _bounds(points: Column, x: str, y: str) -> dict[str, Column]:
    return {
        "x0": F.array_min(F.transform(points, lambda p: p[x])),
        "y0": F.array_min(F.transform(points, lambda p: p[y])),
        "x1": F.array_max(F.transform(points, lambda p: p[x])),
        "y1": F.array_max(F.transform(points, lambda p: p[y])),
    }


def _cell(value: Column, size: float) -> Column:
    return F.floor(value / F.lit(float(size)))


# A box enters at most this many cells along each axis; larger boxes use coarser cells.
_MOST_CELLS = 8


def _level(x0: Column, y0: Column, x1: Column, y1: Column, size: float) -> Column:
    """How often the cell size is to be doubled so that a box stays within ``_MOST_CELLS`` cells each way."""
    extent = F.greatest(x1 - x0, y1 - y0) / F.lit(size * (_MOST_CELLS - 1))
    return F.greatest(F.ceil(F.log2(F.greatest(extent, F.lit(1.0)))), F.lit(0)).cast("int")


def _cover(x0: Column, y0: Column, x1: Column, y1: Column, size: Column) -> Column:
    """Every grid cell a box touches."""
    at = lambda value: F.floor(value / size)
    rows = F.sequence(at(y0), at(y1))
    return F.flatten(
        F.transform(
            F.sequence(at(x0), at(x1)),
            lambda cx: F.transform(rows, lambda cy: F.struct(cx.alias("cx"), cy.alias("cy"))),
        )
    )


def _cell_size(level: Column, size: float) -> Column:
    return F.lit(float(size)) * F.pow(F.lit(2.0), level)


_BOX = ("x0", "y0", "x1", "y1")


def point_in_zone(points: DataFrame, zones: DataFrame, x: str = "px", y: str = "py", cell: float = 0.02) -> DataFrame:
    """Points with the zones that hold them (boundary rule of ray casting); others drop out.

    A point in a hole is outside, one in a polygon that stands in a hole is inside.

    Zones enter the cells that their box touches, large ones on a coarser level of the grid, and points look
    up their cell on the levels in use. Points meet zone ids and boxes first; the rings come by id after
    that. The ray test runs inside the row over the zone's edges.
    """
    shapes = zones.select("zone", "rings", _holes(zones).alias("holes"), *[c.alias(n) for n, c in _bounds(F.flatten("rings"), "lon", "lat").items()])
    boxes = shapes.select("zone", *_BOX, _level(*map(F.col, _BOX), cell).alias("level"))
    cells = boxes.select(
        "zone", *_BOX, "level",
        F.explode(_cover(*map(F.col, _BOX), _cell_size(F.col("level"), cell))).alias("c"),
    ).select("zone", *_BOX, "level", "c.cx", "c.cy")
    levels = boxes.agg(F.array_sort(F.collect_set("level"))).scalar()  # logarithm of the largest box
    px, py = F.col(x), F.col(y)
    size = _cell_size(F.col("level"), cell)
    located = points.withColumn("level", F.explode(levels)).withColumns(
        {"cx": F.floor(px / size), "cy": F.floor(py / size)}).join(cells, ["level", "cx", "cy"])
    inside = px.between(F.col("x0"), F.col("x1")) & py.between(F.col("y0"), F.col("y1"))
    edges = shapes.select("zone", polygon_edges(F.col("rings"), F.col("holes")).alias("edges"))
    return located.filter(inside).select(*points.columns, "zone").join(edges, "zone").filter(
        F.exists("edges", lambda polygon: in_edges(px, py, polygon))).select(*points.columns, "zone")


def distance_join(zones: DataFrame, max_m: float, utm_zone: int = 18, cell_m: float | None = None) -> DataFrame:
    """Pairs of zones at most ``max_m`` metres apart, in both directions.

    The distance is 0 where zones touch or one stands in the solid part of the other; a zone in another's hole
    is as far away as the ring of the hole.

    A zone is entered into the cells of its box, its partner into the cells of its box grown by
    ``max_m``; a pair within reach shares a cell. Of the shared cells only the first one reports the
    pair, so no duplicates need to be removed, and no zone meets a zone outside its neighbourhood. Large
    boxes use coarser cells. Ids and boxes meet first, outlines come by id for the pairs that are left.
    """
    size = float(cell_m or 2.5 * max_m)

    def metres(p: Column) -> Column:
        east, north = utm(p["lon"], p["lat"], utm_zone)
        return F.struct(east.alias("lon"), north.alias("lat"))

    flat = lambda rings: F.transform(rings, lambda ring: F.transform(ring, metres))
    planar = computed_once(
        zones.select("zone", "rings", _holes(zones).alias("holes")),
        {"plane": flat(F.col("rings")), "cut": F.transform("holes", flat)},
    )
    shapes = computed_once(
        planar.select("zone", "plane", "cut"),
        {"edges": polygon_edges(F.col("plane"), F.col("cut")), **_bounds(F.flatten("plane"), "lon", "lat")},
    )

    reach = float(max_m)
    grown = [F.col("x0") - reach, F.col("y0") - reach, F.col("x1") + reach, F.col("y1") + reach]
    boxes = cut_lineage(shapes.select("zone", *_BOX, _level(*grown, size).alias("level")), "boxes")
    top = boxes.agg(F.max("level")).scalar()

    def entered(side: str, by: float) -> DataFrame:
        """Ids and boxes in the cells of their own and of all coarser levels."""
        box = {"x0": F.col("x0") - by, "y0": F.col("y0") - by, "x1": F.col("x1") + by, "y1": F.col("y1") + by}
        placed = boxes.withColumns(box).withColumn("at", F.explode(F.sequence(F.col("level"), top)))
        return placed.select(
            "at", F.explode(_cover(*map(F.col, _BOX), _cell_size(F.col("at"), size))).alias("c"),
            F.struct("zone", "level", *_BOX).alias(side),
        ).select("at", "c.cx", "c.cy", side)

    first = lambda axis: F.floor(F.greatest(f"a.{axis}0", f"b.{axis}0") / _cell_size(F.col("at"), size))
    pairs = entered("a", reach).join(entered("b", 0.0), ["at", "cx", "cy"]).filter(
        (F.col("a.zone") < F.col("b.zone")) & (F.col("at") == F.greatest("a.level", "b.level"))
        & (F.col("a.x0") <= F.col("b.x1")) & (F.col("b.x0") <= F.col("a.x1"))
        & (F.col("a.y0") <= F.col("b.y1")) & (F.col("b.y0") <= F.col("a.y1"))
        & (F.col("cx") == first("x")) & (F.col("cy") == first("y"))
    ).select(F.col("a.zone").alias("za"), F.col("b.zone").alias("zb"))
    edges = cut_lineage(shapes.select("zone", "edges"), "edges")
    of = lambda z, e: edges.select(F.col("zone").alias(z), F.col("edges").alias(e))
    near = computed_once(
        pairs.join(of("za", "ea"), "za").join(of("zb", "eb"), "zb").select("za", "zb", "ea", "eb"),
        {"distance_m": polygons_distance(F.col("ea"), F.col("eb"))},
    ).filter(F.col("distance_m") <= max_m)
    both = F.array(
        F.struct(F.col("za").alias("zone"), F.col("zb").alias("neighbor")),
        F.struct(F.col("zb").alias("zone"), F.col("za").alias("neighbor")),
    )
    return near.select(F.explode(both).alias("p"), "distance_m").select("p.zone", "p.neighbor", "distance_m")


def nearest_zone(points: DataFrame, centers: DataFrame, key: str, x: str = "px", y: str = "py") -> DataFrame:
    """The zone whose centre is nearest in city-block distance, ties to the smaller id.

    One row for each row of ``points``; null where a coordinate is null or there is no centre. Each distinct
    place is searched once: centres are entered into the 3 x 3 cells around them, so a place looks up its
    own cell only and has then seen everything within one cell size. Places not settled go on with cells
    four times as large. A place outside the centres' box is moved to its edge first, which adds the same
    to every distance, so cells never grow beyond half of the box.
    """
    centers = centers.select("zone", "cx", "cy").dropna()
    lo_x, lo_y, hi_x, hi_y, n = centers.agg(F.min("cx"), F.min("cy"), F.max("cx"), F.max("cy"), F.count("*")).first()
    if not n:
        return points.select(key, F.lit(None).cast(centers.schema["zone"].dataType).alias("zone"))
    extent = max(hi_x - lo_x, hi_y - lo_y, 1e-9) * 1.001
    size = extent / max(2, 2 ** int(n**0.5).bit_length())
    clamp = lambda c, lo, hi: F.least(F.greatest(F.col(c), F.lit(lo)), F.lit(hi))
    known = F.col(x).isNotNull() & F.col(y).isNotNull() & ~F.isnan(x) & ~F.isnan(y)
    moved = points.select(
        key, F.when(known, clamp(x, lo_x, hi_x)).alias("x"), F.when(known, clamp(y, lo_y, hi_y)).alias("y"))
    places = cut_lineage(moved.select("x", "y").dropna().distinct(), "places")
    settled: list[DataFrame] = []
    while True:
        last = size * 2 >= extent  # then the 3 x 3 cells around any place hold all centres
        around = F.array(*[F.lit(step) for step in (-1, 0, 1)])
        entered = centers.select(
            "zone", "cx", "cy",
            F.explode(F.flatten(F.transform(around, lambda dx: F.transform(around, lambda dy: F.struct(
                (_cell(F.col("cx") - lo_x, size) + dx).alias("gx"), (_cell(F.col("cy") - lo_y, size) + dy).alias("gy")
            ))))).alias("g"),
        ).select("zone", "cx", "cy", "g.gx", "g.gy")
        located = places.withColumns({"gx": _cell(F.col("x") - lo_x, size), "gy": _cell(F.col("y") - lo_y, size)})
        gap = F.abs(F.col("cx") - F.col("x")) + F.abs(F.col("cy") - F.col("y"))
        found = cut_lineage(
            located.join(entered, ["gx", "gy"], "left").groupBy("x", "y").agg(
                F.min(F.when(F.col("zone").isNotNull(), F.struct(gap.alias("gap"), "zone"))).alias("best")
            ),
            "nearest",
        )
        done = F.lit(True) if last else F.coalesce(F.col("best.gap") <= size, F.lit(False))
        settled.append(found.filter(done).select("x", "y", F.col("best.zone").alias("zone")))
        places = found.filter(~done).select("x", "y")
        if last or places.isEmpty():
            break
        size = min(size * 4, extent / 2)
    answers = settled[0]
    for part in settled[1:]:
        answers = answers.unionByName(part)
    return moved.join(answers, ["x", "y"], "left").select(key, "zone")
