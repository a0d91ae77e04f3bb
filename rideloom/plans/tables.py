"""Views of the given tables in the shapes the operators expect.

Trip-like data come from events, multi-year origin-destination data from line items, zones from
nations, runs and terrain pixels from orders. Every view is a plain DataFrame over the whole table.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rideloom.functions.measures import half_even
from rideloom.operators.families import day_zone_hour, zone_hour
from rideloom.operators.grid import dense_grid, lag_features, trailing_mean_7
from rideloom.operators.quality import classify_rejects, fixed_point, typed_parse, valid_rows
from rideloom.operators.terrain import GridSpec, block_mean_grid
from rideloom.schema import Rules
from rideloom.streaming.replay import minute_zone_counts
from rideloom.workspace import cut_lineage

MONTH = "2024-01"
RULES = Rules(zone_lo=0, zone_hi=24)
HUBS = ("_1$", "_13$", "_19$")
GRID = GridSpec(nx=32, ny=32, z=11)
# First canvas pixel of GRID at zoom 11: 256 x its first tile.
PIXEL_X0, PIXEL_Y0 = 601 * 256, 768 * 256


def hours_before(ts: Column, hours: int) -> Column:
    return ts - F.make_dt_interval(F.lit(0), F.lit(hours))


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    @cached_property
    def events(self) -> DataFrame:
        return self.read("events")

    # -- trips -------------------------------------------------------------------------------

    @cached_property
    def raw(self) -> DataFrame:
        """Six text fields per event, some of them dirty."""
        return raw_fields(self.events)

    @cached_property
    def classified(self) -> DataFrame:
        return classify_rejects(typed_parse(self.raw), MONTH, RULES)

    @cached_property
    def trips(self) -> DataFrame:
        return fixed_point(valid_rows(self.classified), keep=("event_id", "pickup"))

    @cached_property
    def shipments(self) -> DataFrame:
        """Line items as trips from the supplier's to the customer's nation over several years."""
        orders = self.read("orders").select("o_orderkey", "o_custkey")
        customers = self.read("customer").select("c_custkey", F.col("c_nationkey").alias("dest"))
        suppliers = self.read("supplier").select("s_suppkey", F.col("s_nationkey").alias("zone"))
        items = self.read("lineitem")
        ends = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "dest")
        return (
            items.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
            .join(ends, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                "zone",
                "dest",
                F.to_date("l_shipdate").alias("day"),
                half_even(F.col("l_quantity"), 1000).alias("distance_milli_miles"),
                (F.col("l_linenumber") * 600).cast("long").alias("seconds"),
                half_even(F.col("l_extendedprice"), 100).alias("cents"),
            )
        )

    @cached_property
    def items(self) -> DataFrame:
        """The same line items where neither end is asked for: no join."""
        return self.read("lineitem").select(
            F.to_date("l_shipdate").alias("day"),
            half_even(F.col("l_quantity"), 1000).alias("distance_milli_miles"),
            (F.col("l_linenumber") * 600).cast("long").alias("seconds"),
            half_even(F.col("l_extendedprice"), 100).alias("cents"),
        )

    # Aggregates that a query reads more than once are written once; the base tables are scanned once.

    @cached_property
    def zh(self) -> DataFrame:
        return cut_lineage(zone_hour(self.trips), "zone-hour")

    @cached_property
    def tzh(self) -> DataFrame:
        return cut_lineage(day_zone_hour(self.trips), "day-zone-hour")

    @cached_property
    def slots(self) -> DataFrame:
        return cut_lineage(minute_zone_counts(self.trips), "slots")

    @cached_property
    def od(self) -> DataFrame:
        return cut_lineage(self.shipments.groupBy("zone", "dest").agg(F.count("*").alias("trips")), "od")

    # -- dimensions --------------------------------------------------------------------------

    @cached_property
    def zones(self) -> DataFrame:
        nation, region = self.read("nation"), self.read("region")
        key = F.col("n_nationkey")
        return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            key.alias("id"),
            F.col("n_name").alias("name"),
            F.col("r_name").alias("borough"),
            (F.lit(-74.28) + F.lit(0.13) * (key % 5)).alias("x0"),
            (F.lit(40.47) + F.lit(0.09) * F.floor(key / 5)).alias("y0"),
        )

    @cached_property
    def zone_geom(self) -> DataFrame:
        return boxes(self.zones.withColumnRenamed("id", "zone"), 0.12, 0.08)

    @cached_property
    def parcels(self) -> DataFrame:
        """One small box per supplier on a lattice of 50 by 2,000 places; later suppliers share places."""
        return boxes(self.parcel_corners, 0.006, 0.005)

    @cached_property
    def parcel_corners(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self.read("supplier").select(
            key.alias("zone"),
            (F.lit(-74.28) + F.lit(0.011) * (key % 50) + F.col("s_acctbal") / F.lit(1e7)).alias("x0"),
            (F.lit(40.47) + F.lit(0.009) * (F.floor(key / 50) % 2000)).alias("y0"),
        )

    @cached_property
    def courts(self) -> DataFrame:
        """Zones with a court cut out; in every third court stands an island that belongs to the zone."""
        corner = self.zones.select(F.col("id").alias("zone"), "x0", "y0")
        island = F.when(F.col("zone") % 3 == 0, F.array(box_ring(0.05, 0.03, 0.02, 0.02))).otherwise(F.array())
        return corner.select(
            "zone", F.concat(F.array(box_ring(0.0, 0.0, 0.12, 0.08)), island).alias("rings"),
            F.array(F.array(box_ring(0.03, 0.02, 0.06, 0.04))).alias("holes"))

    @cached_property
    def plots(self) -> DataFrame:
        """Parcels, frames around every fifth of them, and solid plots that hold every fifth one as well."""
        parcel = F.array(box_ring(0.0, 0.0, 0.006, 0.005))
        around = F.array(box_ring(-0.003, -0.0017, 0.012, 0.0084))
        gap = F.array(box_ring(-0.0015, -0.001, 0.009, 0.007))
        placed = self.parcel_corners
        own = placed.select("zone", parcel.alias("rings"), F.array(F.array()).cast(RINGS_IN_RINGS).alias("holes"))
        frames = placed.filter("zone % 5 = 0").select(F.col("zone") + 1_000_000, around, F.array(gap))
        solid = placed.filter("zone % 5 = 2").select(F.col("zone") + 2_000_000, around, F.lit(None).cast(RINGS_IN_RINGS))
        return own.union(frames).union(solid)

    @cached_property
    def points(self) -> DataFrame:
        key = F.col("event_id")
        return self.events.select(
            "event_id",
            (F.lit(-74.28) + F.lit(0.65) * ((key * 7919) % 1000) / F.lit(1000.0)).alias("px"),
            (F.lit(40.47) + F.lit(0.45) * ((key * 104729) % 997) / F.lit(997.0)).alias("py"),
        )

    @cached_property
    def pixels(self) -> DataFrame:
        """Terrain-coloured pixels, one per order, scattered over the canvas of GRID."""
        key = F.col("o_orderkey")
        return self.read("orders").select(
            (F.lit(PIXEL_X0) + (key * 769) % 1024).alias("px"),
            (F.lit(PIXEL_Y0) + (F.floor(key / 1024) * 37 + key * 5) % 1024).alias("py"),
            (F.lit(127) + (key % 3 > 0).cast("int")).alias("r"),
            (key * 37 % 256).cast("int").alias("g"),
            (F.floor("o_totalprice") % 256).cast("int").alias("b"),
        )

    @cached_property
    def elevation(self) -> DataFrame:
        return cut_lineage(block_mean_grid(self.pixels, GRID), "elevation")

    # -- demand grid -------------------------------------------------------------------------

    @cached_property
    def demand(self) -> DataFrame:
        counts = self.events.groupBy(
            (F.col("user_id") % 25).cast("int").alias("zone"),
            F.hour("ts").alias("hour"),
            F.to_date("ts").alias("date"),
        ).agg(F.count("*").alias("trips"))
        return cut_lineage(counts, "demand")

    @cached_property
    def grid(self) -> DataFrame:
        return dense_grid(self.demand)

    @cached_property
    def signal(self) -> DataFrame:
        """The demand grid on top of a daily and weekly pattern that a model can learn."""
        zone, hour, day = F.col("zone"), F.col("hour"), F.col("date")
        pattern = 5 + (hour * 3) % 17 + F.when(F.weekday(day) >= 5, 6).otherwise(0) + zone % 5
        return self.grid.withColumn("trips", (pattern + F.col("trips") * 2).cast("long"))

    @cached_property
    def lagged(self) -> DataFrame:
        return trailing_mean_7(lag_features(self.grid))

    @cached_property
    def weather_h(self) -> DataFrame:
        """Hourly weather made from the number of events in each hour."""
        hourly = self.events.groupBy(F.to_date("ts").alias("date"), F.hour("ts").alias("hour")).agg(
            F.count("*").alias("n")
        )
        dom, hour, n = F.dayofmonth("date"), F.col("hour"), F.col("n")
        temp = ((dom * 7 + hour * 3 + n) % 45 - 10).cast("double")
        wet = F.when((dom * 24 + hour) % 8 == 0, ((dom + hour + n) % 5).cast("double") / F.lit(10.0)).otherwise(0.0)
        weather = hourly.select(
            "date",
            "hour",
            temp.alias("temperature_2m"),
            (temp - 2).alias("apparent_temperature"),
            wet.alias("precipitation"),
            F.when(temp < 0, wet).otherwise(0.0).alias("snowfall"),
            ((n * 5) % 23).cast("double").alias("wind_speed_10m"),
            (30 + (n * 11) % 70).cast("double").alias("relative_humidity_2m"),
            ((n * 17) % 101).cast("double").alias("cloud_cover"),
        )
        return cut_lineage(weather, "weather")

    @cached_property
    def weather_d(self) -> DataFrame:
        return self.weather_h.groupBy("date").agg(
            F.max("temperature_2m").alias("temperature_2m_max"),
            F.min("temperature_2m").alias("temperature_2m_min"),
            F.round(F.sum("precipitation"), 1).alias("precipitation_sum"),
            F.round(F.sum("snowfall"), 1).alias("snowfall_sum"),
            F.max("wind_speed_10m").alias("wind_speed_10m_max"),
            (F.count_if(F.col("cloud_cover") < 50) * 3600).cast("double").alias("sunshine_duration"),
        )

    # -- registry ----------------------------------------------------------------------------

    @cached_property
    def runs(self) -> DataFrame:
        """One run record per order."""
        key, status = F.col("o_orderkey"), F.col("o_orderstatus")
        return self.read("orders").select(
            F.concat(F.lit("run-"), F.lpad(key.cast("string"), 9, "0")).alias("run_id"),
            F.date_format("o_orderdate", "yyyy-MM").alias("month"),
            (1 + F.col("o_custkey") % 4).cast("int").alias("reducers"),
            (key % 2 == 0).alias("combiner"),
            (key % 11 == 0).alias("fail_first"),
            F.when(status == "F", "FAILED").when(status == "P", "RUNNING").otherwise("SUCCEEDED").alias("status"),
            F.concat(
                F.date_format("o_orderdate", "yyyy-MM-dd"),
                F.format_string("T%02d:%02d:00", (key % 24).cast("int"), (key % 60).cast("int")),
            ).alias("started_at"),
            (F.floor("o_totalprice") / F.lit(1000.0)).alias("elapsed_seconds"),
        )

    @cached_property
    def manifests(self) -> DataFrame:
        """One manifest per month with line items."""
        return self.read("lineitem").groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("month")).agg(
            F.count("*").alias("rows"),
            (F.count("*") + F.count_if(F.col("l_quantity") > 45)).alias("source_rows"),
            F.date_format(F.max("l_shipdate"), "yyyy-MM-dd").alias("created_at"),
        )


def raw_fields(events: DataFrame) -> DataFrame:
    key, ts = F.col("event_id"), F.col("ts")
    dropoff = F.timestamp_add("SECOND", half_even(F.col("value") * 30), ts)
    pickup = hours_before(ts, 6).cast("string")
    return events.select(
        "event_id",
        F.when(key % 67 == 0, F.regexp_replace(pickup, ".$", "Z"))
        .when(key % 71 == 0, F.regexp_replace(pickup, ".$", " "))
        .otherwise(pickup)
        .alias("s_pickup"),
        hours_before(dropoff, 6).cast("string").alias("s_dropoff"),
        F.when(key % 53 == 0, "")
        .when(key % 59 == 0, "nan")
        .when(key % 61 == 0, "1.5")
        .otherwise((F.col("user_id") % 27).cast("string"))
        .alias("s_pu"),
        (F.get_json_object("props", "$.k").cast("long") % 26).cast("string").alias("s_do"),
        (F.col("value") / 3).cast("string").alias("s_miles"),
        (F.col("value") * 4).cast("string").alias("s_amount"),
    )


RINGS_IN_RINGS = "array<array<array<struct<lon: double, lat: double>>>>"


def box_ring(x: float, y: float, width: float, height: float) -> Column:
    """The ring of an axis-parallel box placed relative to the corner (x0, y0)."""
    def corner(dx: float, dy: float) -> Column:
        return F.struct((F.col("x0") + F.lit(dx)).alias("lon"), (F.col("y0") + F.lit(dy)).alias("lat"))

    return F.array(corner(x, y), corner(x + width, y), corner(x + width, y + height), corner(x, y + height))


def boxes(df: DataFrame, width: float, height: float) -> DataFrame:
    """zone, rings: one axis-parallel box of the given size per row, from its corner (x0, y0)."""
    return df.select("zone", F.array(box_ring(0.0, 0.0, width, height)).alias("rings"))
