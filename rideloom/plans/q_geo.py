"""Queries: projections, spatial joins, zone geometry, terrain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideloom.functions import geo as geo_functions
from rideloom.operators import geo, terrain
from rideloom.operators.families import additive_sum
from rideloom.plans.catalog import query, r6
from rideloom.plans.sql import with_views
from rideloom.plans.tables import GRID, Tables


@query("mercator", with_views("points", body="""
  SELECT event_id, CAST(floor(x) AS INTEGER) AS tile_x, CAST(floor(y) AS INTEGER) AS tile_y, round(x * 256, 4) AS pixel_x,
    round(y * 256, 4) AS pixel_y, round(px * pi() / 180, 6) AS plane_x, round(-ln(tan(pi() / 4 + py * pi() / 360)), 6) AS plane_y
  FROM (SELECT *, (px + 180) / 360 * 2048 AS x, (1 - asinh(tan(radians(py))) / pi()) / 2 * 2048 AS y FROM points)"""))
def _(t: Tables) -> DataFrame:
    lon, lat = F.col("px"), F.col("py")
    columns = {**geo_functions.mercator(lon, lat, 11), **geo_functions.planar(lon, lat)}
    return t.points.withColumns(columns).select(
        "event_id", "tile_x", "tile_y", r6("pixel_x", 4), r6("pixel_y", 4), r6("plane_x"), r6("plane_y")
    )


@query("decode_elevation", with_views("pixels", body="""
  SELECT px, py, r * CAST(256 AS DOUBLE) + g + b / CAST(256 AS DOUBLE) - 32768 AS elev FROM pixels"""))
def _(t: Tables) -> DataFrame:
    return t.pixels.select("px", "py", geo_functions.decode_elevation(F.col("r"), F.col("g"), F.col("b")).alias("elev"))


@query("block_mean_grid", with_views("elevation", body="SELECT * FROM elevation"))
def _(t: Tables) -> DataFrame:
    return terrain.block_mean_grid(t.pixels, GRID)


@query("point_in_zone", with_views("points", "zones", body="""
  SELECT event_id, id AS zone FROM points JOIN zones
    ON px >= x0 AND px < x0 + 0.12::DOUBLE AND py >= y0 AND py < y0 + 0.08::DOUBLE"""))
def _(t: Tables) -> DataFrame:
    return geo.point_in_zone(t.points, t.zone_geom).select("event_id", "zone")


@query("point_in_zone_ray", with_views("points", "sides", body="""
  SELECT event_id, zone FROM points JOIN sides ON (yi > py) <> (yj > py)
    AND px < (xj - xi) * (py - yi) / (yj - yi) + xi
  GROUP BY 1, 2 HAVING count(*) % 2 = 1"""))
def _(t: Tables) -> DataFrame:
    return geo.point_in_zone(t.points, t.zone_geom, cell=0.05).select("event_id", "zone")


@query("point_in_zone_holes", with_views("points", "zones", body="""
  SELECT event_id, id AS zone FROM points JOIN zones ON
    px >= x0 AND px < x0 + 0.12::DOUBLE AND py >= y0 AND py < y0 + 0.08::DOUBLE AND NOT (
      px >= x0 + 0.03::DOUBLE AND px < x0 + (0.03::DOUBLE + 0.06::DOUBLE) AND
      py >= y0 + 0.02::DOUBLE AND py < y0 + (0.02::DOUBLE + 0.04::DOUBLE))
    OR id % 3 = 0 AND px >= x0 + 0.05::DOUBLE AND px < x0 + (0.05::DOUBLE + 0.02::DOUBLE)
      AND py >= y0 + 0.03::DOUBLE AND py < y0 + (0.03::DOUBLE + 0.02::DOUBLE)"""))
def _(t: Tables) -> DataFrame:
    """Zones with a court: points in it are outside, unless an island of the zone stands there."""
    return geo.point_in_zone(t.points, t.courts).select("event_id", "zone")


@query("distance_join", with_views("parcel_gap", body="""
  SELECT a.zp AS zone, a.zs AS neighbor, round(least(a.gap, b.gap), 3) AS distance_m
  FROM parcel_gap a JOIN parcel_gap b ON a.zp = b.zs AND a.zs = b.zp WHERE least(a.gap, b.gap) <= 800"""))
def _(t: Tables) -> DataFrame:
    return geo.distance_join(t.parcels, 800.0).select("zone", "neighbor", r6("distance_m", 3))


@query("distance_join_holes", with_views("plot_gap", "plots", body="""
  SELECT zone, neighbor, round(min(gap), 3) AS distance_m FROM (
    SELECT a.zp // 2 AS zone, a.zs // 2 AS neighbor, least(a.gap, b.gap) AS gap
    FROM plot_gap a JOIN plot_gap b ON a.zp = b.zs AND a.zs = b.zp WHERE a.zp // 2 <> a.zs // 2
    UNION ALL SELECT unnest([i.ring // 2, o.ring // 2]), unnest([o.ring // 2, i.ring // 2]), CAST(0 AS DOUBLE)
    FROM plots o JOIN plots i ON o.ring // 2 <> i.ring // 2 AND o.ring % 2 = 0 AND i.ring % 2 = 0
      AND i.x0 >= o.x0 AND i.x0 < o.x0 + o.w AND i.y0 >= o.y0 AND i.y0 < o.y0 + o.h
    WHERE NOT EXISTS (SELECT 1 FROM plots h WHERE h.ring = o.ring + 1
      AND i.x0 >= h.x0 AND i.x0 < h.x0 + h.w AND i.y0 >= h.y0 AND i.y0 < h.y0 + h.h))
  WHERE gap <= 800 GROUP BY zone, neighbor"""))
def _(t: Tables) -> DataFrame:
    """Frames around parcels are as far away as the ring of their hole, solid plots hold theirs."""
    return geo.distance_join(t.plots, 800.0).select("zone", "neighbor", r6("distance_m", 3))


@query("nearest_zone", with_views("points", "centers", body="""
  SELECT event_id, CASE WHEN event_id % 50 > 0 THEN zone END AS zone FROM
    (SELECT event_id, arg_min(zone, abs(cx - px) + abs(cy - py)) AS zone FROM points CROSS JOIN centers GROUP BY event_id)
    JOIN (VALUES (0), (1)) v(copy) ON copy = 0 OR event_id % 40 = 0"""))
def _(t: Tables) -> DataFrame:
    """Some points occur twice, some have no latitude."""
    points = t.points.withColumn("py", F.when(F.col("event_id") % 50 > 0, F.col("py")))
    return geo.nearest_zone(
        points.union(points.filter("event_id % 40 = 0")), geo.zone_center(t.zone_geom), "event_id")


@query("nearest_cell", with_views("points", "elevation", body="""
  SELECT event_id, i, j, coalesce(elev, -1) AS elev FROM
    (SELECT event_id, lx.k AS i, ly.k AS j FROM points
      JOIN (SELECT p AS px, arg_min(k, abs(lon - p) + k / CAST(1e12 AS DOUBLE)) AS k FROM (SELECT DISTINCT px AS p FROM points)
        CROSS JOIN (SELECT DISTINCT i AS k, lon FROM cells) GROUP BY p) lx USING (px)
      JOIN (SELECT p AS py, arg_min(k, abs(lat - p) + k / CAST(1e12 AS DOUBLE)) AS k FROM (SELECT DISTINCT py AS p FROM points)
        CROSS JOIN (SELECT DISTINCT j AS k, lat FROM cells) GROUP BY p) ly USING (py)) s
    LEFT JOIN elevation e USING (i, j)"""))
def _(t: Tables) -> DataFrame:
    return terrain.nearest_cell(t.points, t.elevation, GRID).select("event_id", "i", "j", F.coalesce("elev", F.lit(-1.0)).alias("elev"))


@query("zone_center", with_views("centers", body="SELECT zone, round(cx, 6) AS cx, round(cy, 6) AS cy FROM centers"))
def _(t: Tables) -> DataFrame:
    return geo.zone_center(t.zone_geom).select("zone", r6("cx"), r6("cy"))


@query("borough_centroid", with_views("centers", body="""
  SELECT borough, round(avg(cx), 6) AS cx, round(avg(cy), 6) AS cy, CAST(count(*) AS BIGINT) AS zones
  FROM centers JOIN zones ON zone = id GROUP BY borough"""))
def _(t: Tables) -> DataFrame:
    return geo.borough_centroid(geo.zone_center(t.zone_geom), t.zones).select("borough", r6("cx"), r6("cy"), "zones")


@query("bbox", with_views("corners", body="""
  SELECT zone, min(x) AS x0, min(y) AS y0, max(x) AS x1, max(y) AS y1 FROM corners GROUP BY zone"""))
def _(t: Tables) -> DataFrame:
    return geo.bbox(t.zone_geom)


@query("terrain_points", with_views("elevation", "zones", body="""
  SELECT i, j, round(lon, 4) AS lon, round(lat, 4) AS lat, elev,
    round(CASE WHEN elev > 1.5 THEN 0.9::DOUBLE + elev * 0.015::DOUBLE ELSE 0.905::DOUBLE END, 3) AS height,
    CAST(CASE WHEN elev <= 1.5 THEN -1 WHEN elev <= 45 THEN 0 WHEN elev <= 120 THEN 1 ELSE 2 END AS INTEGER) AS level
  FROM elevation WHERE i % 2 = 0 AND j % 2 = 0 AND (elev > 1.5 OR EXISTS (SELECT 1 FROM zones
    WHERE lon >= x0 AND lon < x0 + 0.12::DOUBLE AND lat >= y0 AND lat < y0 + 0.08::DOUBLE))"""))
def _(t: Tables) -> DataFrame:
    return terrain.terrain_points(t.elevation, t.zone_geom)


@query("tower_height", with_views("elevation", "centers", "zh", body="""
  SELECT zone, CAST(trips AS BIGINT) AS trips, coalesce(elev, -1) AS elev,
    floor((coalesce(elev, 0) * 0.3::DOUBLE + trips / max(trips) OVER () * 55) * 10 + 0.5) / 10 AS height
  FROM (SELECT c.zone, coalesce((SELECT sum(trips) FROM zh WHERE zh.zone = c.zone), 0) AS trips,
      (SELECT i FROM (SELECT DISTINCT i, lon FROM cells) ORDER BY abs(lon - cx), i LIMIT 1) AS i,
      (SELECT j FROM (SELECT DISTINCT j, lat FROM cells) ORDER BY abs(lat - cy), j LIMIT 1) AS j FROM centers c)
    LEFT JOIN elevation USING (i, j)"""))
def _(t: Tables) -> DataFrame:
    zone_trips = additive_sum(t.zh, ["zone"]).select("zone", "trips")
    towers = terrain.tower_height(
        zone_trips, geo.zone_center(t.zone_geom), t.elevation, GRID
    )
    return towers.withColumn("elev", F.coalesce("elev", F.lit(-1.0)))
