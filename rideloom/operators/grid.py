"""Dense demand grid and its features."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rideloom.functions.calendar import weekday

# Variable names of the weather documents.
HOURLY_WEATHER = (
    "temperature_2m",
    "apparent_temperature",
    "precipitation",
    "snowfall",
    "wind_speed_10m",
    "relative_humidity_2m",
    "cloud_cover",
)
DAILY_WEATHER = (
    "temperature_2m_max",
    "temperature_2m_min",
    "precipitation_sum",
    "snowfall_sum",
    "wind_speed_10m_max",
    "sunshine_duration",
)
CALENDAR = ("zone", "hour", "weekday", "month", "is_weekend")
LAGS = ("lag_1", "lag_7", "lag7mean")
FEATURES = (*CALENDAR, *HOURLY_WEATHER, *DAILY_WEATHER, *LAGS)


def dense_grid(
    counts: DataFrame, start: date | None = None, end: date | None = None, zones: DataFrame | None = None
) -> DataFrame:
    """zone x hour x date with 0 where nothing happened.

    Each zone unfolds its own hours and dates, so the grid is produced in parallel and no side is
    joined with every other. ``zones`` (column zone) defaults to the zones that occur, the dates to
    the first and last one that occur.
    """
    present = (counts if zones is None else zones).select("zone").distinct()
    extent = counts.agg(F.struct(F.min("date").alias("first"), F.max("date").alias("last"))).scalar()
    first = F.lit(start) if start else extent["first"]
    last = F.lit(end) if end else extent["last"]
    spine = present.withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23)))).withColumn(
        "date", F.explode(F.sequence(first, last, F.expr("interval 1 day")))
    )
    sums = counts.groupBy("zone", "hour", "date").agg(F.sum("trips").alias("trips"))
    return spine.join(sums, ["zone", "hour", "date"], "left").fillna(0, ["trips"])


def join_hourly_weather(grid: DataFrame, hourly: DataFrame, columns: Sequence[str] = HOURLY_WEATHER) -> DataFrame:
    return grid.join(hourly.select("date", "hour", *columns), ["date", "hour"], "left")


def join_daily_weather(grid: DataFrame, daily: DataFrame, columns: Sequence[str] = DAILY_WEATHER) -> DataFrame:
    return grid.join(daily.select("date", *columns), "date", "left")


def _series():
    return W.partitionBy("zone", "hour").orderBy("date")


def lag_features(grid: DataFrame) -> DataFrame:
    """Demand one and seven days before. Rows are days because the grid is dense."""
    return grid.withColumns({
        "lag_1": F.lag("trips", 1).over(_series()),
        "lag_7": F.lag("trips", 7).over(_series()),
    })


def trailing_mean_7(grid: DataFrame) -> DataFrame:
    """Mean of the seven days before, today excluded; fewer at the start of a series."""
    return grid.withColumn("lag7mean", F.avg("trips").over(_series().rowsBetween(-7, -1)))


def seasonal_naive(grid: DataFrame) -> DataFrame:
    """Prediction = demand one week before."""
    return grid.withColumn("pred", F.lag("trips", 7).over(_series()).cast("double"))


def neighbor_mean(features: DataFrame, edges: DataFrame, value: str = "lag_1") -> DataFrame:
    """Mean of the neighbours' value at the same date and hour; own value without neighbours.

    ``edges`` holds (zone, neighbor) in both directions. A cell is sent to the neighbours of its zone
    and summed there map-side, so a zone with many neighbours is never gathered.
    """
    sent = features.select(F.col("zone").alias("neighbor"), "date", "hour", value).join(
        edges.select("zone", "neighbor"), "neighbor"
    )
    means = sent.groupBy("zone", "date", "hour").agg(F.avg(value).alias("neighbor_lag1_mean"))
    return features.join(means, ["zone", "date", "hour"], "left").withColumn(
        "neighbor_lag1_mean", F.coalesce("neighbor_lag1_mean", F.col(value).cast("double"))
    )


def feature_table(
    grid: DataFrame,
    hourly: DataFrame,
    daily: DataFrame,
    start: date,
    required: Sequence[str] = (*FEATURES, "trips"),
) -> DataFrame:
    """Calendar, weather and lags; rows lacking a required column or before ``start`` are dropped.

    Lags come first: they need the grid as one series per (zone, hour), and the joins keep its rows.
    """
    lagged = trailing_mean_7(lag_features(grid)).filter(F.col("date") >= F.lit(start))
    with_calendar = lagged.withColumns({
        "weekday": weekday(F.col("date")),
        "month": F.month("date"),
        "year": F.year("date"),
        "is_weekend": (weekday(F.col("date")) >= 5).cast("int"),
    })
    joined = join_daily_weather(join_hourly_weather(with_calendar, hourly), daily)
    return joined.dropna(subset=list(required))


def temporal_split(df: DataFrame, train_end: date, valid_end: date) -> DataFrame:
    """Label rows train (up to train_end), valid (up to valid_end) or test."""
    day = F.col("date")
    label = F.when(day <= F.lit(train_end), "train").when(day <= F.lit(valid_end), "valid").otherwise("test")
    return df.withColumn("split", label)
