"""Additive aggregation along the key families."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rideloom.schema import SUM4

CELL = ("day", "hour", "zone", "dest")
FAMILY_KEYS = {
    "Z": ("zone", "hour"),
    "D": ("day",),
    "O": ("zone", "dest"),
    "T": ("day", "zone", "hour"),
}


def trip_count(df: DataFrame) -> Column:
    """Rows of an aggregate carry their own count; raw trips count as one."""
    return F.sum("trips") if "trips" in df.columns else F.count(F.lit(1))


def _sums(df: DataFrame) -> list[Column]:
    return [trip_count(df).alias("trips"), *[F.sum(name).alias(name) for name in SUM4[1:]]]


def additive_sum(df: DataFrame, keys: list[str] | tuple[str, ...]) -> DataFrame:
    """Sum the four statistics per key. Works on trips and on earlier sums alike, so results merge."""
    return df.groupBy(*keys).agg(*_sums(df))


def base_cuboid(trips: DataFrame) -> DataFrame:
    """The finest cell every family can be summed from. Its size is bounded by the key space."""
    return additive_sum(trips, CELL)


def _kind() -> Column:
    """Family name from the grouping id over (day, hour, zone, dest); a set bit is a rolled-up key."""
    label = None
    for kind, keys in FAMILY_KEYS.items():
        bits = sum(1 << (len(CELL) - 1 - place) for place, key in enumerate(CELL) if key not in keys)
        test = F.grouping_id() == bits
        label = F.when(test, kind) if label is None else label.when(test, kind)
    return label


def key_families(trips: DataFrame) -> DataFrame:
    """All four families from one scan.

    The base cells are aggregated first: rows are parsed once, a hot key collapses map-side, and the
    fourfold expansion of GROUPING SETS runs over cells, not over trips.
    """
    cells = base_cuboid(trips)
    families = cells.groupingSets([list(keys) for keys in FAMILY_KEYS.values()], *CELL)
    return families.agg(_kind().alias("kind"), *_sums(cells)).select(
        "kind", "zone", "hour", "day", "dest", *SUM4
    )


def zone_hour(trips: DataFrame) -> DataFrame:
    return additive_sum(trips, FAMILY_KEYS["Z"])


def day_totals(trips: DataFrame) -> DataFrame:
    return additive_sum(trips, FAMILY_KEYS["D"])


def od_totals(trips: DataFrame) -> DataFrame:
    return additive_sum(trips, FAMILY_KEYS["O"])


def day_zone_hour(trips: DataFrame) -> DataFrame:
    return additive_sum(trips, FAMILY_KEYS["T"])


def family(families: DataFrame, kind: str) -> DataFrame:
    """One family with only its own key columns."""
    return families.filter(F.col("kind") == kind).select(*FAMILY_KEYS[kind], *SUM4)


def classified_cuboid(classified: DataFrame) -> DataFrame:
    """Base cells and reject counts of classified rows in one pass.

    Valid rows keep their cell and measures; rejected rows collapse to one cell per reason.
    """
    from rideloom.functions.measures import elapsed_seconds, half_even

    ok = F.col("reason").isNull()
    return classified.groupBy(
        "reason",
        F.when(ok, F.to_date("pickup")).alias("day"),
        F.when(ok, F.hour("pickup")).alias("hour"),
        F.when(ok, F.col("pu").try_cast("int")).alias("zone"),
        F.when(ok, F.col("do_").try_cast("int")).alias("dest"),
    ).agg(
        F.count(F.lit(1)).alias("trips"),
        F.coalesce(F.sum(F.when(ok, half_even(F.col("miles"), 1000))), F.lit(0)).alias("distance_milli_miles"),
        F.coalesce(
            F.sum(F.when(ok, half_even(elapsed_seconds(F.col("pickup"), F.col("dropoff"))))), F.lit(0)
        ).alias("seconds"),
        F.coalesce(F.sum(F.when(ok, half_even(F.col("amount"), 100))), F.lit(0)).alias("cents"),
    )


def split_cells(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Key families and reject counts (reason, rows) from the cells of :func:`classified_cuboid`."""
    valid = cells.filter(F.col("reason").isNull()).select("day", "hour", "zone", "dest", *SUM4)
    return key_families(valid), cells.filter(F.col("reason").isNotNull()).select("reason", F.col("trips").alias("rows"))
