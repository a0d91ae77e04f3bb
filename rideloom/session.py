"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "rideloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings in ``prepare`` plus skew and partition handling by AQE.

    ``master`` is left to spark-submit when it is not given, and so is the number of shuffle
    partitions: AQE coalesces them to the measured size.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session zone: trip times are naive wall-clock values, durations plain differences."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark
