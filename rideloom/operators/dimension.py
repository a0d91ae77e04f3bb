"""Lookups against the zone dimension, and equality of aggregate tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNKNOWN = "Unknown"


def one_per_id(zones: DataFrame) -> DataFrame:
    """Zone attributes, one row per id: a zone with several polygons must not multiply a join."""
    return zones.groupBy("id").agg(F.max(F.struct("name", "borough")).alias("z")).select("id", "z.*")


def enrich_zone(df: DataFrame, zones: DataFrame, on: str = "zone") -> DataFrame:
    """Add name and borough; an unknown id keeps its number as name.

    No broadcast hint: Spark broadcasts the dimension when its measured size allows it, and the left
    side is normally an aggregate already.
    """
    dim = one_per_id(zones).withColumnRenamed("id", on)
    return df.join(dim, on, "left").withColumns({
        "name": F.coalesce("name", F.col(on).cast("string")),
        "borough": F.coalesce("borough", F.lit(UNKNOWN)),
    })


def enrich_od(od: DataFrame, zones: DataFrame, unknown: str = UNKNOWN) -> DataFrame:
    """Add name and borough of both ends."""
    dim = one_per_id(zones)
    out = od
    for key, suffix in (("zone", "o"), ("dest", "d")):
        side = dim.select(
            F.col("id").alias(key), F.col("name").alias(f"name_{suffix}"), F.col("borough").alias(f"borough_{suffix}")
        )
        out = out.join(side, key, "left").withColumns({
            f"name_{suffix}": F.coalesce(f"name_{suffix}", F.col(key).cast("string")),
            f"borough_{suffix}": F.coalesce(f"borough_{suffix}", F.lit(unknown)),
        })
    return out


def scope_filter(df: DataFrame, zones: DataFrame, hour: int | None = None, borough: str | None = None) -> DataFrame:
    """Rows of one borough and/or hour. An unknown borough or hour is an error, not an empty result."""
    if hour is not None and not 0 <= hour <= 23:
        raise ValueError(f"hour must be 0..23, got {hour}")
    out = df
    if borough is not None:
        members = zones.filter(F.col("borough") == borough).select(F.col("id").alias("zone")).distinct()
        if members.isEmpty():
            raise ValueError(f"unknown borough {borough!r}")
        out = out.join(members, "zone", "left_semi")
    return out if hour is None else out.filter(F.col("hour") == hour)


def compare_keyed(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys on which ``b`` does not equal ``a``: missing from b, extra in b, or different values.

    Null key parts match each other. Both sides are aggregates with unique keys.
    """
    values = [name for name in a.columns if name not in keys]

    def packed(df: DataFrame, value: str):
        return df.select(*keys, F.struct(*values).alias(value))

    left, right = packed(a, "a_value").alias("a"), packed(b, "b_value").alias("b")
    same_key = F.lit(True)
    for key in keys:
        same_key = same_key & F.col(f"a.{key}").eqNullSafe(F.col(f"b.{key}"))
    status = (
        F.when(F.col("b_value").isNull(), "missing")
        .when(F.col("a_value").isNull(), "extra")
        .when(~F.col("a_value").eqNullSafe(F.col("b_value")), "different")
    )
    return (
        left.join(right, same_key, "full_outer")
        .select(*[F.coalesce(f"a.{key}", f"b.{key}").alias(key) for key in keys], status.alias("status"))
        .filter(F.col("status").isNotNull())
    )
