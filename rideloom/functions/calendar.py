"""Calendar columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MINUTES_PER_DAY = 1440


def weekday(day: Column) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(day)


def calendar_features(df: DataFrame, ts: str) -> DataFrame:
    col = F.col(ts)
    return df.withColumns({
        "hour": F.hour(col),
        "day": F.to_date(col),
        "month": F.month(col),
        "year": F.year(col),
        "weekday": weekday(col),
        "is_weekend": (weekday(col) >= 5).cast("int"),
    })


def replay_slot(df: DataFrame, ts: str) -> DataFrame:
    """Minute of the month, counted from its first midnight."""
    col = F.col(ts)
    slot = (F.dayofmonth(col) - 1) * MINUTES_PER_DAY + F.hour(col) * 60 + F.minute(col)
    return df.withColumn("slot", slot.cast("int"))


def slot_label(slot: Column) -> Column:
    """``dd HH:mm`` of a minute slot."""
    return F.format_string(
        "%02d %02d:%02d",
        (F.floor(slot / MINUTES_PER_DAY) + 1).cast("int"),
        (F.floor(slot % MINUTES_PER_DAY / 60)).cast("int"),
        (slot % 60).cast("int"),
    )
