"""Multi-year archive: tables of drifting schemas in, Parquet by kind / year / month out."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rideloom.schema import SUM4

# Column names used by the published tables over the years.
ALIASES = {
    "tpep_pickup_datetime": "pickup",
    "tpep_dropoff_datetime": "dropoff",
    "lpep_pickup_datetime": "pickup",
    "lpep_dropoff_datetime": "dropoff",
    "PULocationID": "pu",
    "DOLocationID": "do_",
    "trip_distance": "miles",
    "total_amount": "amount",
}
TYPES = {
    "pickup": "timestamp_ntz",
    "dropoff": "timestamp_ntz",
    "pu": "double",
    "do_": "double",
    "miles": "double",
    "amount": "double",
}


def normalize_schema_drift(
    frames: Iterable[DataFrame], aliases: Mapping[str, str] = ALIASES, types: Mapping[str, str] = TYPES
) -> DataFrame:
    """Bring every frame to the same columns and types, skip those lacking one, and union the rest.

    Each file keeps its own reader schema; nothing is merged across files.
    """
    def canonical(df: DataFrame) -> DataFrame | None:
        taken, names = set(df.columns), {}
        for old, new in aliases.items():
            if old in df.columns and new not in taken:
                names[old] = new
                taken.add(new)
        renamed = df.withColumnsRenamed(names)
        if not set(types) <= set(renamed.columns):
            return None
        return renamed.select(*[F.col(name).try_cast(kind).alias(name) for name, kind in types.items()])

    usable = [df for df in map(canonical, frames) if df is not None]
    if not usable:
        raise ValueError("no frame has all required columns")
    return reduce(DataFrame.unionByName, usable)


#: What each kind of archive table shows of a trip, beside its day and measures.
KIND_COLUMNS = {"Z": ("hour", "zone"), "D": (), "O": ("zone", "dest"), "T": ("hour", "zone")}


def write_archive(trips: DataFrame, path: str) -> None:
    """Parquet by year / month, every trip once. ``trips`` has day.

    Rebalancing by folder lets AQE merge small months into one task and split a hot one over many, so
    files come out near the advisory partition size however the rows are spread.
    """
    dated = trips.withColumns({"year": F.year("day"), "month": F.month("day")})
    dated.hint("rebalance", "year", "month").write.mode("overwrite").partitionBy("year", "month").parquet(path)


def read_archive(spark: SparkSession, path: str, kind: str | None = None, years: tuple[int, int] | None = None) -> DataFrame:
    """The years prune folders; a kind is a choice of columns, and only those are read."""
    df = spark.read.parquet(path)
    if years is not None:
        df = df.filter(F.col("year").between(*years))
    if kind is not None:
        df = df.select("year", "month", "day", *KIND_COLUMNS[kind], *SUM4[1:])
    return df
