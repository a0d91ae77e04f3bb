"""Unions, differences and key checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_months(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows (with multiplicity) on one side only, and the side. Empty means an exact match.

    One aggregation over both frames instead of two set differences.
    """
    columns = a.columns
    tagged = a.select(*columns, F.lit(1).alias("weight")).unionByName(b.select(*columns, F.lit(-1).alias("weight")))
    surplus = tagged.groupBy(*columns).agg(F.sum("weight").alias("surplus")).filter(F.col("surplus") != 0)
    return surplus.select(
        *columns,
        F.when(F.col("surplus") > 0, "left").otherwise("right").alias("side"),
        F.abs("surplus").alias("copies"),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` itself, or ValueError naming some keys that occur twice."""
    found = duplicate_keys(df, keys).take(5)
    if found:
        raise ValueError(f"duplicate keys: {[tuple(row[key] for key in keys) for row in found]}")
    return df
