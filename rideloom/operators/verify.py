"""Checks on published results: conservation, recount, partition invariance."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import lcm

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideloom.operators.families import (
    CELL, FAMILY_KEYS, additive_sum, day_totals, day_zone_hour, key_families, od_totals, zone_hour,
)
from rideloom.operators.sets import symmetric_difference
from rideloom.schema import SUM4
from rideloom.workspace import cut_lineage


def conservation_check(families: DataFrame, rejects: DataFrame, input_rows: int | DataFrame) -> DataFrame:
    """One row: trips per family, rejects, input, and whether all families agree and nothing was lost.

    ``input_rows`` is a number or a one-row frame with that number.
    """
    total = F.lit(input_rows) if isinstance(input_rows, int) else input_rows.scalar()
    rejected = rejects.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("q")).scalar()
    sums = families.agg(*[
        F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("trips"))), F.lit(0)).alias(kind.lower())
        for kind in FAMILY_KEYS
    ])
    z = F.col("z")
    agree = (z == F.col("d")) & (z == F.col("o")) & (z == F.col("t"))
    return sums.withColumns({"q": rejected, "input": total}).withColumn("ok", agree & (z + F.col("q") == F.col("input")))


def require_conservation(check: DataFrame) -> None:
    row = check.first()
    if not row["ok"]:
        raise ValueError(f"conservation check failed: {row.asDict()}")


def independent_recount(trips: DataFrame) -> DataFrame:
    """The key families from four separate aggregations, in the layout of ``key_families``."""
    null = {"zone": "int", "hour": "int", "day": "date", "dest": "int"}

    def tagged(kind: str, df: DataFrame) -> DataFrame:
        return df.select(
            F.lit(kind).alias("kind"),
            *[F.col(c) if c in FAMILY_KEYS[kind] else F.lit(None).cast(t).alias(c) for c, t in null.items()],
            *SUM4,
        )

    parts = [
        tagged("Z", zone_hour(trips)), tagged("D", day_totals(trips)),
        tagged("O", od_totals(trips)), tagged("T", day_zone_hour(trips)),
    ]
    return reduce(DataFrame.unionByName, parts)


def partition_invariance(trips: DataFrame, ks: Sequence[int] = (1, 2, 4, 13)) -> DataFrame:
    """Per k: rows in which the families merged from k parts of the trips differ from the plain result.

    The parts are told by a hash of the row. They are summed apart, in one pass over the trips, and merged;
    nothing is gathered into few tasks.
    """
    plain = cut_lineage(key_families(trips), "plain-families")
    part = F.pmod(F.xxhash64(*CELL, *SUM4[1:]), F.lit(lcm(*ks)))
    parts = cut_lineage(additive_sum(trips.withColumn("part", part), ["part", *CELL]), "parts")
    checks = []
    for k in ks:
        other = key_families(additive_sum(parts.withColumn("part", F.col("part") % k), ["part", *CELL]))
        diff = symmetric_difference(plain, other).agg(F.count("*").alias("diff_rows"))
        checks.append(diff.select(F.lit(k).alias("k"), "diff_rows"))
    return reduce(DataFrame.unionByName, checks)


def reshard_balanced(df: DataFrame, k: int) -> DataFrame:
    """The same rows in k partitions of equal size, whatever the keys."""
    return df.repartition(k)


def partition_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("rows"))
