"""Trip input: columnar tables, text lines, bounded shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rideloom.schema import RAW_FIELDS

# The six trip columns of the published taxi tables.
TRIP_COLUMNS = (
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "PULocationID",
    "DOLocationID",
    "trip_distance",
    "total_amount",
)
ROWS_PER_SHARD = 100_000

_BAD_LINE = "_bad_line"


def read_trips(spark: SparkSession, path: str, columns: Sequence[str] = TRIP_COLUMNS) -> DataFrame:
    """Only the named columns; the scan reads nothing else."""
    return spark.read.parquet(path).select(*columns)


def read_raw(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Headerless lines as six text fields plus ``bad_shape`` for any other field count.

    A blank line is a row without fields, so it has a bad shape too. ``multi_line`` admits quoted line breaks,
    at the price of unsplittable files and of blank lines, which then are no rows.
    """
    schema = ", ".join(f"{name} string" for name in (*RAW_FIELDS, _BAD_LINE))
    if not multi_line:
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD_LINE, "escape": '"'}
        text = spark.read.text(path)
        parsed = text.select(F.from_csv("value", schema, options).alias("r"), F.trim("value").alias("t"))
        blank = ~F.col("t").rlike(r"\S")
        return parsed.select(
            *[F.when(~blank, F.col(f"r.{name}")).alias(name) for name in RAW_FIELDS],
            (blank | F.col(f"r.{_BAD_LINE}").isNotNull()).alias("bad_shape"),
        )
    lines = (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _BAD_LINE)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .csv(path)
    )
    return lines.select(*RAW_FIELDS, F.col(_BAD_LINE).isNotNull().alias("bad_shape"))


def as_lines(trips: DataFrame) -> DataFrame:
    """Typed trip columns as the six text fields of a line."""
    return trips.select(*[F.col(name).cast("string").alias(name) for name in trips.columns])


def write_shards(df: DataFrame, path: str, rows_per_shard: int = ROWS_PER_SHARD) -> None:
    """Headerless CSV files of at most ``rows_per_shard`` rows, written in parallel."""
    if rows_per_shard < 1:
        raise ValueError("rows_per_shard must be positive")
    df.write.option("maxRecordsPerFile", rows_per_shard).option("header", False).option(
        "timestampNTZFormat", "yyyy-MM-dd HH:mm:ss"
    ).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def head_sample(df: DataFrame, order_by: Sequence[str], n: int) -> DataFrame:
    """The first n rows in the given order (a prefix, not a random sample)."""
    if n < 0:
        raise ValueError("n must not be negative")
    return df.orderBy(*order_by).limit(n)
