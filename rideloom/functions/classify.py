"""Classification columns: zone groups by name, intensity levels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Name patterns (tried in this order, on the lower-cased zone name) and group labels.
ZONE_GROUP_RULES = (
    ("airport", "机场"),
    ("upper|yorkville|lenox|carnegie|lincoln", "曼哈顿北部"),
    ("midtown|times sq|garment|hell|theatre", "曼哈顿中城"),
    (
        "soho|west village|east village|greenwich|bowery|little italy|chinatown|financial|lower|"
        "fulton|gramercy|union sq|chelsea|kips|murray|stuyvesant|madison|penn station",
        "曼哈顿其他",
    ),
    ("queens", "皇后区"),
    ("brooklyn", "布鲁克林"),
    ("bronx", "布朗克斯"),
    ("staten", "史坦顿岛"),
    ("newark", "EWR"),
)
ZONE_GROUP_OTHER = "其他"

# Lower limits of intensity levels 1..4 (level 0 lies below the first).
INTENSITY_LIMITS = (0.25, 0.5, 0.75, 0.92)


def zone_group(
    name: Column,
    rules: Sequence[tuple[str, str]] = ZONE_GROUP_RULES,
    other: str = ZONE_GROUP_OTHER,
) -> Column:
    """Label of the first rule whose pattern occurs in the name."""
    lowered = F.lower(name)
    label = F.lit(other)
    for pattern, group in reversed(rules):
        label = F.when(lowered.rlike(pattern), F.lit(group)).otherwise(label)
    return label


def intensity(df: DataFrame, value: str) -> DataFrame:
    """Add log-scaled share of the frame's maximum (at least 1, so no zero division) and its level.

    Twelve digits are kept, so that a share on a limit does not fall below it by the last bit.
    """
    peak = df.agg(F.greatest(F.max(value), F.lit(1)).alias("peak")).scalar()
    scaled = F.round(F.least(F.lit(1.0), F.log1p(F.col(value)) / F.log1p(peak)), 12)
    level = F.lit(0)
    for step, limit in enumerate(INTENSITY_LIMITS, start=1):
        level = F.when(F.col("intensity") >= limit, F.lit(step)).otherwise(level)
    return df.withColumn("intensity", scaled).withColumn("level", level)


def normalise_to_max(df: DataFrame, value: str) -> DataFrame:
    """Add ``ratio``: value over the frame's maximum (at least 1)."""
    peak = df.agg(F.greatest(F.max(value), F.lit(1)).alias("peak")).scalar()
    return df.withColumn("ratio", F.col(value) / peak)
