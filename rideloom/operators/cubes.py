"""Month and year cubes. Inputs are trips or aggregates with day / hour / zone and the four sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rideloom.functions.calendar import weekday
from rideloom.functions.measures import kilometres
from rideloom.operators.families import additive_sum, trip_count
from rideloom.schema import month_arg_guard
from rideloom.workspace import cut_lineage


def month_of(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def month_spine(df_months: DataFrame) -> DataFrame:
    """Every month from the first to the last one in ``df_months.month`` (YYYY-MM)."""
    first = F.to_date(F.concat(F.min("month"), F.lit("-01")))
    last = F.to_date(F.concat(F.max("month"), F.lit("-01")))
    months = F.sequence(first, last, F.expr("interval 1 month"))
    return df_months.agg(F.explode(months).alias("first_day")).select(month_of(F.col("first_day")).alias("month"))


def monthly_sums(trips: DataFrame) -> DataFrame:
    return additive_sum(trips.withColumn("month", month_of(F.col("day"))), ["month"])


def month_stats(sums: DataFrame, rejects: DataFrame, months: DataFrame, runs: DataFrame) -> DataFrame:
    """Per month of the spine: totals and the run they come from, or status MISSING.

    ``sums`` has month and the four sums, ``rejects`` month and rejected, ``runs`` one row per month with
    run_id and elapsed_seconds (null where no run is known).
    """
    joined = months.join(sums, "month", "left").join(
        rejects.groupBy("month").agg(F.sum("rejected").alias("rejected")), "month", "left"
    ).join(runs.select("month", "run_id", "elapsed_seconds"), "month", "left")
    return joined.select(
        "month",
        F.when(F.col("trips").isNull(), "MISSING").otherwise("ok").alias("status"),
        F.coalesce("trips", F.lit(0)).alias("trips"),
        F.coalesce("rejected", F.lit(0)).alias("rejected"),
        F.coalesce(F.rint(kilometres(F.col("distance_milli_miles"))), F.lit(0.0)).cast("long").alias("distance_km"),
        F.coalesce(F.rint(F.col("cents") / F.lit(100.0)), F.lit(0.0)).cast("long").alias("revenue"),
        "run_id",
        "elapsed_seconds",
    )


def month_quality(classified: DataFrame, month: str) -> DataFrame:
    """Rows per reason of the month that was run; the reason of valid rows is ``Valid``.

    Every row belongs to the run's month, also one whose pickup lies outside of it or is unknown.
    """
    return classified.groupBy(
        F.lit(month_arg_guard(month)).alias("month"), F.coalesce("reason", F.lit("Valid")).alias("reason")
    ).agg(F.count("*").alias("rows"))


def month_quality_map(classified: DataFrame, month: str) -> DataFrame:
    """One row: the run's month, valid, rejected and the reason counts as a map (at most seven entries)."""
    counts = month_quality(classified, month)
    valid = F.col("reason") == "Valid"
    entries = F.collect_list(F.when(~valid, F.struct("reason", "rows")))
    return counts.groupBy("month").agg(
        F.sum(F.when(valid, F.col("rows")).otherwise(0)).alias("valid"),
        F.sum(F.when(valid, 0).otherwise(F.col("rows"))).alias("rejected"),
        F.map_from_entries(F.array_sort(entries)).alias("reasons"),
    )


def _hours(df: DataFrame) -> DataFrame:
    return df.withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))


def month_hour_matrix(trips: DataFrame) -> DataFrame:
    """Dense months x 24 in long form."""
    counts = (
        trips.groupBy(month_of(F.col("day")).alias("month"), "hour").agg(trip_count(trips).alias("trips"))
    )
    spine = _hours(counts.select("month").distinct())
    return spine.join(counts, ["month", "hour"], "left").fillna(0, ["trips"])


def month_hour_pivot(trips: DataFrame) -> DataFrame:
    """The same matrix with one column per hour, h0 .. h23."""
    monthly = trips.groupBy(month_of(F.col("day")).alias("month"))
    wide = monthly.pivot("hour", list(range(24))).agg(trip_count(trips)).fillna(0)
    return wide.withColumnsRenamed({str(h): f"h{h}" for h in range(24)})


def weekday_hour_matrix(t: DataFrame) -> DataFrame:
    """Dense 7 x 24, Monday = 0."""
    counts = t.groupBy(weekday(F.col("day")).alias("weekday"), "hour").agg(trip_count(t).alias("trips"))
    spine = _hours(t.sparkSession.range(7).select(F.col("id").cast("int").alias("weekday")))
    return spine.join(counts, ["weekday", "hour"], "left").fillna(0, ["trips"])


def zone_month_matrix(trips: DataFrame) -> DataFrame:
    """Dense zone x month over the months present; every zone gets every month as an array, no pairs joined."""
    counts = trips.groupBy("zone", month_of(F.col("day")).alias("month")).agg(trip_count(trips).alias("trips"))
    counts = cut_lineage(counts, "zone-months")  # read three times below, the trips once
    months = counts.agg(F.array_sort(F.collect_set("month")).alias("months")).scalar()
    spine = counts.select("zone").distinct().withColumn("month", F.explode(months))
    return spine.join(counts, ["zone", "month"], "left").fillna(0, ["trips"])


def zone_year(trips: DataFrame) -> DataFrame:
    return trips.groupBy("zone").agg(trip_count(trips).alias("trips"))


def day_curves(days: DataFrame) -> DataFrame:
    """Per month its days in order, at most 31 points each."""
    return (
        days.groupBy("day").agg(F.sum("trips").alias("trips"))
        .groupBy(month_of(F.col("day")).alias("month"))
        .agg(F.sort_array(F.collect_list(F.struct("day", "trips"))).alias("points"))
    )


def year_kpis(t: DataFrame) -> DataFrame:
    """Totals of the frame; trips per day over the days that occur."""
    per_day = additive_sum(t, ["day"])
    totals = per_day.agg(
        F.sum("trips").alias("trips"),
        F.count("*").alias("days"),
        F.sum("distance_milli_miles").alias("distance_milli_miles"),
        F.sum("cents").alias("cents"),
    )
    return totals.select(
        "trips",
        F.try_divide(F.col("trips"), F.col("days")).alias("trips_per_day"),
        kilometres(F.col("distance_milli_miles")).alias("distance_km"),
        (F.col("cents") / F.lit(100.0)).alias("revenue"),
    )


def monthly_totals_long(t: DataFrame) -> DataFrame:
    """(year, month) totals; distance in miles, revenue in currency units."""
    sums = additive_sum(
        t.withColumns({"year": F.year("day"), "month": F.month("day")}), ["year", "month"]
    )
    return sums.select(
        "year",
        "month",
        "trips",
        (F.col("distance_milli_miles") / F.lit(1000.0)).alias("distance"),
        (F.col("cents") / F.lit(100.0)).alias("revenue"),
    )


def _by_slot_of_year(t: DataFrame, slot: Column, name: str) -> DataFrame:
    """Sum over years and mean per year in which the slot occurs, per (slot, hour)."""
    yearly = t.groupBy(slot.alias(name), "hour", F.year("day").alias("year")).agg(trip_count(t).alias("trips"))
    return yearly.groupBy(name, "hour").agg(
        F.sum("trips").alias("trips"), F.count("*").alias("years")
    ).select(name, "hour", "trips", F.try_divide("trips", "years").alias("avg_trips_per_year"))


def hour_by_calendar_month(t: DataFrame) -> DataFrame:
    return _by_slot_of_year(t, F.month("day"), "month")


def weekday_hour_long(t: DataFrame) -> DataFrame:
    return _by_slot_of_year(t, weekday(F.col("day")), "weekday")


def yearly_totals(t: DataFrame) -> DataFrame:
    return t.groupBy(F.year("day").alias("year")).agg(trip_count(t).alias("trips"))


def year_month_matrix(t: DataFrame) -> DataFrame:
    """Years x 12 with columns m1 .. m12, 0 where a month has no trips."""
    yearly = t.withColumn("m", F.month("day")).groupBy(F.year("day").alias("year"))
    return yearly.pivot("m", list(range(1, 13))).agg(trip_count(t)).fillna(0).withColumnsRenamed({str(m): f"m{m}" for m in range(1, 13)})


def pct_of_base_year(monthly: DataFrame, base_year: int, years: Sequence[int]) -> DataFrame:
    """Months of the given years in percent of the mean month of the base year (twelve months)."""
    base = monthly.filter(F.col("year") == base_year).agg((F.sum("trips") / F.lit(12.0)).alias("base")).scalar()
    return monthly.filter(F.col("year").between(min(years), max(years))).select(
        "year", "month", "trips", F.try_divide(F.col("trips") * F.lit(100.0), base).alias("pct_of_base")
    )


def archive_manifest(t: DataFrame) -> DataFrame:
    """Rows per (year, month) plus the grand total (null, null)."""
    dated = t if "year" in t.columns else t.withColumns({"year": F.year("day"), "month": F.month("day")})
    counts = dated.groupBy("year", "month").agg(F.count("*").alias("rows"))
    return counts.groupingSets([["year", "month"], []], "year", "month").agg(F.sum("rows").alias("rows"))


def months_with_input(months: DataFrame, manifests: DataFrame) -> DataFrame:
    """Rows whose month has a manifest."""
    return months.join(manifests.select("month"), "month", "left_semi")


def missing_months(months: DataFrame, runs: DataFrame) -> DataFrame:
    """Months without any run."""
    return months.join(runs.select("month"), "month", "left_anti")
