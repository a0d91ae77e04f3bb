"""Elevation grid: pixels to cells, cell lookup, terrain points and tower heights."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rideloom.functions.geo import TILE, decode_elevation, mercator_x, mercator_y
from rideloom.operators.geo import point_in_zone


@dataclass(frozen=True)
class GridSpec:
    """A regular lon/lat grid over a box, fed from Web-Mercator pixels at zoom z."""

    lon_min: float = -74.28
    lat_min: float = 40.47
    lon_max: float = -73.62
    lat_max: float = 40.95
    nx: int = 160
    ny: int = 160
    z: int = 11

    def lon_edge(self, k: Column) -> Column:
        return F.lit(self.lon_min) + F.lit(self.lon_max - self.lon_min) * k / F.lit(float(self.nx))

    def lat_edge(self, k: Column) -> Column:
        return F.lit(self.lat_min) + F.lit(self.lat_max - self.lat_min) * k / F.lit(float(self.ny))

    def lon(self, i: Column) -> Column:
        return F.round((self.lon_edge(i) + self.lon_edge(i + 1)) / 2, 4)

    def lat(self, j: Column) -> Column:
        return F.round((self.lat_edge(j) + self.lat_edge(j + 1)) / 2, 4)


def _clamped(lo: Column, hi: Column, first: Column, size: Column) -> tuple[Column, Column]:
    """Pixel range [left, right) on the canvas, at least one pixel wide."""
    left = F.least(size - 1, F.greatest(F.lit(0), F.floor(lo) - first))
    return left, F.least(size, F.greatest(left + 1, F.floor(hi) - first))


def _axis(spark, spec: GridSpec, axis: str) -> DataFrame:
    """Cell index and each global pixel index it covers; one row per pixel of the canvas edge."""
    def origin(fraction: Column) -> Column:
        return F.floor(fraction)

    cells = spark.range(spec.nx if axis == "x" else spec.ny)
    k = F.col("id").cast("double")
    if axis == "x":
        tile_lo = origin(mercator_x(F.lit(spec.lon_min), spec.z))
        tile_hi = origin(mercator_x(F.lit(spec.lon_max), spec.z))
        lo = mercator_x(spec.lon_edge(k), spec.z) * TILE
        hi = mercator_x(spec.lon_edge(k + 1), spec.z) * TILE
    else:
        tile_lo = origin(mercator_y(F.lit(spec.lat_max), spec.z))
        tile_hi = origin(mercator_y(F.lit(spec.lat_min), spec.z))
        lo = mercator_y(spec.lat_edge(k + 1), spec.z) * TILE
        hi = mercator_y(spec.lat_edge(k), spec.z) * TILE
    first, size = tile_lo * TILE, (tile_hi - tile_lo + 1) * TILE
    left, right = _clamped(lo, hi, first, size)
    index, pixel = ("i", "px") if axis == "x" else ("j", "py")
    return cells.select(
        F.col("id").cast("int").alias(index), F.explode(F.sequence(first + left, first + right - 1)).alias(pixel)
    )


def block_mean_grid(pixels: DataFrame, spec: GridSpec = GridSpec()) -> DataFrame:
    """Mean elevation per cell from pixels (px, py, r, g, b); never below 0, one decimal.

    A cell is a rectangle of pixel columns and rows, so two equi-joins against the canvas edges
    replace a range join; the means combine map-side.
    """
    elevation = decode_elevation(F.col("r"), F.col("g"), F.col("b"))
    spark = pixels.sparkSession
    placed = pixels.select("px", "py", elevation.alias("elev")).join(_axis(spark, spec, "x"), "px").join(
        _axis(spark, spec, "y"), "py"
    )
    means = placed.groupBy("i", "j").agg(F.avg("elev").alias("mean"))
    return means.select(
        "i", "j",
        spec.lon(F.col("i")).alias("lon"),
        spec.lat(F.col("j")).alias("lat"),
        F.bround(F.greatest(F.lit(0.0), F.col("mean")), 1).alias("elev"),
    )


def _nearest_index(value: Column, at, n: int, lo: float, step: float) -> Column:
    """Index of the nearest grid line, ties to the lower index; at most three lines are compared."""
    guess = F.floor((value - F.lit(lo)) / F.lit(step)).cast("int")
    near = F.transform(
        F.array(guess - 1, guess, guess + 1), lambda k: F.greatest(F.lit(0), F.least(F.lit(n - 1), k))
    )
    best = F.array_min(F.transform(near, lambda k: F.struct(F.abs(at(k) - value).alias("gap"), k.alias("k"))))
    return best["k"]


def snap(points: DataFrame, spec: GridSpec, x: str = "px", y: str = "py") -> DataFrame:
    """Add the indices of the nearest grid longitude and latitude."""
    return points.withColumns({
        "i": _nearest_index(F.col(x), spec.lon, spec.nx, spec.lon_min, (spec.lon_max - spec.lon_min) / spec.nx),
        "j": _nearest_index(F.col(y), spec.lat, spec.ny, spec.lat_min, (spec.lat_max - spec.lat_min) / spec.ny),
    })


def nearest_cell(points: DataFrame, cells: DataFrame, spec: GridSpec, x: str = "px", y: str = "py") -> DataFrame:
    """Points with the elevation of their nearest cell (null where the grid has no such cell)."""
    return snap(points, spec, x, y).join(cells.select("i", "j", "elev"), ["i", "j"], "left")


def terrain_points(cells: DataFrame, zones: DataFrame, step: int = 2) -> DataFrame:
    """Every ``step``-th cell that is land (above 1.5 m) or lies in a zone, with drawing height and level.

    Levels: 0 up to 45 m, 1 up to 120 m, 2 above; -1 for water.
    """
    sampled = cells.filter((F.col("i") % step == 0) & (F.col("j") % step == 0))
    land = F.col("elev") > 1.5
    wet = sampled.filter(~land)
    inside = point_in_zone(wet, zones, "lon", "lat").select("i", "j").distinct()
    kept = sampled.filter(land).unionByName(wet.join(inside, ["i", "j"], "left_semi"))
    elev = F.col("elev")
    return kept.select(
        "i", "j",
        F.round("lon", 4).alias("lon"),
        F.round("lat", 4).alias("lat"),
        "elev",
        F.round(F.when(land, F.lit(0.9) + elev * F.lit(0.015)).otherwise(F.lit(0.905)), 3).alias("height"),
        F.when(~land, -1).when(elev <= 45, 0).when(elev <= 120, 1).otherwise(2).alias("level"),
    )


def tower_height(zone_trips: DataFrame, centers: DataFrame, cells: DataFrame, spec: GridSpec) -> DataFrame:
    """Per zone: 0.3 of the ground elevation at its centre plus 55 at the frame's maximum."""
    peak = zone_trips.agg(F.greatest(F.max("trips"), F.lit(1)).alias("peak")).scalar()
    located = nearest_cell(centers, cells, spec, "cx", "cy").join(zone_trips, "zone", "left")
    trips = F.coalesce("trips", F.lit(0))
    height = F.coalesce("elev", F.lit(0.0)) * F.lit(0.3) + trips / peak * F.lit(55.0)
    return located.select(
        "zone", trips.alias("trips"), "elev", (F.floor(height * 10 + F.lit(0.5)) / F.lit(10.0)).alias("height")
    )
