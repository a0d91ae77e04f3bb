"""City and borough summaries over the zone-hour family."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideloom.functions.measures import ratio_or_zero, unit_metrics
from rideloom.operators.dimension import enrich_zone, scope_filter
from rideloom.operators.families import additive_sum
from rideloom.schema import SUM4

EXPORT_COLUMNS = ("id", "name", "borough", "trips", "avg_distance_km", "avg_minutes", "avg_amount")


def summary(zh: DataFrame, zones: DataFrame, hour: int | None = None, borough: str | None = None) -> DataFrame:
    """One row of key figures for the scope; means are weighted by trips, zeros when the scope is empty."""
    scoped = scope_filter(zh, zones, hour, borough)
    totals = scoped.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in SUM4])
    return unit_metrics(totals).select("trips", "distance_km", "avg_distance_km", "avg_minutes", "avg_amount")


def hourly_profile(zh: DataFrame, zones: DataFrame, borough: str | None = None) -> DataFrame:
    """24 hours, empty ones included. The hour filter of a query does not apply here, only its borough."""
    counts = scope_filter(zh, zones, borough=borough).groupBy("hour").agg(F.sum("trips").alias("trips"))
    spine = zh.sparkSession.range(24).select(F.col("id").cast("int").alias("hour"))
    return spine.join(counts, "hour", "left").select("hour", F.coalesce("trips", F.lit(0)).alias("trips"))


def zone_metrics(zh: DataFrame, zones: DataFrame, hour: int | None = None, borough: str | None = None) -> DataFrame:
    """Per zone of the scope: names, sums and means."""
    per_zone = additive_sum(scope_filter(zh, zones, hour, borough), ["zone"])
    return unit_metrics(enrich_zone(per_zone, zones)).withColumnRenamed("zone", "id")


def zone_ranking(
    zh: DataFrame, zones: DataFrame, k: int | None = None, hour: int | None = None, borough: str | None = None
) -> DataFrame:
    """Zones by trips, ties by id; all of them without ``k``."""
    ranked = zone_metrics(zh, zones, hour, borough).orderBy(F.desc("trips"), "id")
    return ranked if k is None else ranked.limit(k)


def top_share(zone_trips: DataFrame) -> DataFrame:
    """The busiest zone and its share of all trips in the frame, in percent."""
    return zone_trips.agg(
        F.max_by("zone", F.struct("trips", -F.col("zone"))).alias("zone"),
        F.max("trips").alias("trips"),
        F.sum("trips").alias("total"),
    ).select("zone", "trips", ratio_or_zero(F.col("trips") * F.lit(100.0), F.col("total")).alias("share_pct"))
