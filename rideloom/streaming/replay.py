"""Minute replay over pre-aggregated slots (slot, zone, trips)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rideloom.functions.calendar import MINUTES_PER_DAY, replay_slot

RATE_MINUTES = 60


def minute_zone_counts(events: DataFrame, ts: str = "pickup") -> DataFrame:
    """Trips per minute slot and zone. Pass validated trips, or raw ones to replay everything."""
    return replay_slot(events, ts).groupBy("slot", "zone").agg(F.count("*").alias("trips"))


def minute_totals(minute_counts: DataFrame) -> DataFrame:
    return minute_counts.groupBy("slot").agg(F.sum("trips").alias("trips"))


def peak_minute(minute_counts: DataFrame) -> DataFrame:
    """Largest total of one minute, 0 for an empty index."""
    return minute_totals(minute_counts).agg(F.coalesce(F.max("trips"), F.lit(0)).alias("peak"))


def replay_meta(minute_counts: DataFrame, days: int) -> DataFrame:
    return peak_minute(minute_counts).select(
        F.lit(days * MINUTES_PER_DAY).cast("long").alias("minutes"), F.col("peak").alias("peak_minute_total")
    )


def replay_frame(minute_counts: DataFrame, m: int, span: int, horizon: int) -> DataFrame:
    """Trips per zone in the slots m .. m+span-1, wrapping around at the horizon.

    A wrapped range is a plain predicate on the slot, so the scan can skip files; nothing is joined.
    """
    if not 1 <= span <= RATE_MINUTES:
        raise ValueError("span must be 1..60")
    first = m % horizon
    last = first + span - 1
    slot = F.col("slot")
    inside = slot.between(first, last)
    if last >= horizon:
        inside = slot.between(first, horizon - 1) | slot.between(0, last - horizon)
    return minute_counts.filter(inside).groupBy("zone").agg(F.sum("trips").alias("trips"))


def frame_index(minute_counts: DataFrame, horizon: int) -> DataFrame:
    """For every zone and slot up to the horizon the trips of all slots before it (zone, slot, upto).

    Slots without trips carry the sum on, so the trips of any stretch of slots are the difference of two rows. The
    table has zones * (horizon + 1) rows, whatever the number of trips; slots outside of the horizon are left out.
    """
    counts = minute_counts.filter(F.col("slot").between(0, horizon - 1)).groupBy("zone", "slot").agg(F.sum("trips").alias("trips"))
    slots = counts.select("zone").distinct().withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(horizon))))
    before = W.partitionBy("zone").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
    filled = slots.join(counts, ["zone", "slot"], "left")
    return filled.select("zone", "slot", F.coalesce(F.sum("trips").over(before), F.lit(0)).alias("upto"))


def replay_frames(index: DataFrame, requests: DataFrame, horizon: int, max_span: int = RATE_MINUTES) -> DataFrame:
    """Frames for many requests (``m``, ``span``) at once: m, span, total, and trips of each zone that has some.

    A frame covers the slots m .. m+span-1, wrapping around at the horizon; ``m`` comes back reduced to it. Each
    request looks up two slots of the ``frame_index``, four if it wraps. A frame without trips has one row with
    total 0 and no zone. A span outside of 1 .. ``max_span`` raises an error; a null m or span gives no frame.
    """
    bad = F.raise_error(F.lit(f"span must be 1..{max_span}")).cast("int")
    start = F.pmod(F.col("m"), F.lit(horizon)).cast("int")
    span = F.when(F.col("span").between(1, max_span), F.col("span").cast("int")).otherwise(bad)
    frames = requests.dropna(subset=["m", "span"]).select(start.alias("m"), span.alias("span")).distinct()
    end = F.col("m") + F.col("span")
    look = lambda slot, sign: F.struct(slot.cast("int").alias("slot"), F.lit(sign).alias("sign"))
    direct = F.array(look(end, 1), look(F.col("m"), -1))
    wrapped = F.array(look(F.lit(horizon), 1), look(F.col("m"), -1), look(end - horizon, 1))  # before slot 0 lies nothing
    edges = frames.select("m", "span", F.explode(F.when(end <= horizon, direct).otherwise(wrapped)).alias("e"))
    found = edges.select("m", "span", "e.slot", "e.sign").join(index, "slot").groupBy("m", "span", "zone").agg(
        F.sum(F.col("upto") * F.col("sign")).alias("trips")).filter("trips > 0")
    totals = found.groupBy("m", "span").agg(F.sum("trips").alias("total"), F.collect_list(F.struct("zone", "trips")).alias("zones"))
    return frames.join(totals, ["m", "span"], "left").select(
        "m", "span", F.coalesce("total", F.lit(0)).alias("total"), F.explode_outer("zones").alias("z")).select("m", "span", "total", "z.zone", "z.trips")


def rolling_hour_rate(totals: DataFrame, minutes: int = RATE_MINUTES) -> DataFrame:
    """Trailing total over up to 60 minutes, scaled to one hour by the minutes elapsed since slot 0.

    The window runs per day: the last 59 slots of a day are copied into the next one as its lead-in,
    which keeps the days independent instead of sorting all slots in one task.
    """
    slot = F.col("slot")
    day = F.floor(slot / MINUTES_PER_DAY)
    lead_in = slot % MINUTES_PER_DAY > MINUTES_PER_DAY - minutes
    days = F.when(lead_in, F.array(day, day + 1)).otherwise(F.array(day))
    per_day = totals.withColumn("day", F.explode(days))
    window = W.partitionBy("day").orderBy("slot").rangeBetween(-(minutes - 1), 0)
    summed = per_day.withColumn("window_trips", F.sum("trips").over(window))
    own = summed.filter(F.col("day") == F.floor(slot / MINUTES_PER_DAY))
    seen = F.least(slot + 1, F.lit(minutes))
    return own.select("slot", (F.col("window_trips") * F.lit(float(RATE_MINUTES)) / seen).alias("rate"))
