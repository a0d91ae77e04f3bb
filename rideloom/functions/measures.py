"""Unit arithmetic on columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KM_PER_MILE = 1.609344


def half_even(value: Column, scale: float = 1) -> Column:
    """Integer fixed point, ties to even - the same answer for every partitioning.

    NaN and infinity give null: Spark may evaluate this before the filter that drops such rows.
    """
    return F.rint(value * F.lit(float(scale))).try_cast("long")


def truncated(value: Column, scale: float = 1) -> Column:
    return (value * F.lit(float(scale))).try_cast("long")


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Unrounded seconds between two wall-clock times."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(1e6)


def kilometres(milli_miles: Column) -> Column:
    return milli_miles / F.lit(1000.0) * F.lit(KM_PER_MILE)


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def unit_metrics(df: DataFrame) -> DataFrame:
    """Add distance and per-trip means to a frame holding the four sums; a mean over no trips is 0."""
    trips = F.col("trips")
    km = kilometres(F.col("distance_milli_miles"))
    return df.withColumns({
        "distance_km": km,
        "avg_distance_km": ratio_or_zero(km, trips),
        "avg_minutes": ratio_or_zero(F.col("seconds") / F.lit(60.0), trips),
        "avg_amount": ratio_or_zero(F.col("cents") / F.lit(100.0), trips),
    })


def improvement_pct(model_rmse: Column, base_rmse: Column) -> Column:
    return (F.lit(1.0) - F.try_divide(model_rmse, base_rmse)) * F.lit(100.0)


def clip_error(error_pct: Column, lo: float = -50.0, hi: float = 50.0) -> Column:
    return F.greatest(F.least(error_pct, F.lit(float(hi))), F.lit(float(lo)))
