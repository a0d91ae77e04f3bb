"""Top-k per frame or group, and picks from the run registry."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def top_zones_by_hour(zh: DataFrame, k: int = 20) -> DataFrame:
    """The k busiest zones with their real trips in each of the 24 hours."""
    top = zh.groupBy("zone").agg(F.sum("trips").alias("total")).orderBy(F.desc("total"), "zone").limit(k)
    hours = top.withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
    counts = zh.groupBy("zone", "hour").agg(F.sum("trips").alias("trips"))
    return hours.join(counts, ["zone", "hour"], "left").select(
        "zone", "hour", F.coalesce("trips", F.lit(0)).alias("trips")
    )


def top_k_per_frame(minute_counts: DataFrame, k: int = 5) -> DataFrame:
    """The k busiest zones of every slot, ties by zone. Spark drops rows past rank k before the shuffle."""
    order = W.partitionBy("slot").orderBy(F.desc("trips"), "zone")
    ranked = minute_counts.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k)


def argmax_zone(t: DataFrame) -> DataFrame:
    """All rows of the zone with most trips."""
    totals = t.groupBy("zone").agg(F.sum("trips").alias("total"))
    best = totals.agg(F.max_by("zone", F.struct("total", -F.col("zone"))).alias("zone")).scalar()
    return t.filter(F.col("zone") == best)


def _pick_per_month(runs: DataFrame, latest: bool) -> DataFrame:
    """One run per month as an aggregate: no group of runs is ever gathered or sorted."""
    row = F.struct(*runs.columns)
    order = F.struct("started_at", "run_id")
    pick: Column = F.max_by(row, order) if latest else F.min_by(row, order)
    return runs.groupBy("month").agg(pick.alias("run")).select("run.*")


def latest_success_per_month(runs: DataFrame) -> DataFrame:
    return _pick_per_month(runs.filter(F.col("status") == "SUCCEEDED"), latest=True)


def standard_runs(runs: DataFrame) -> DataFrame:
    """Successful runs of the standard configuration: two reducers, combiner on, no injected failure."""
    return runs.filter(
        (F.col("status") == "SUCCEEDED") & (F.col("reducers") == 2) & F.col("combiner") & ~F.col("fail_first")
    )


def earliest_run_per_month(runs: DataFrame) -> DataFrame:
    return _pick_per_month(standard_runs(runs), latest=False)


def latest_matching_run(runs: DataFrame, filters: Mapping[str, object] | None = None) -> DataFrame:
    """Per month the latest standard run that also meets the given column values."""
    matching = standard_runs(runs)
    for name, value in (filters or {}).items():
        matching = matching.filter(F.col(name) == F.lit(value))
    return _pick_per_month(matching, latest=True)


def runs_with_rows(runs: DataFrame, manifests: DataFrame) -> DataFrame:
    """Earliest standard run of every month next to the month's input rows."""
    earliest = earliest_run_per_month(runs).select("month", "elapsed_seconds")
    return earliest.join(manifests.select("month", "rows"), "month")
