"""Run records and imported months."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_SCHEMA = (
    "run_id string, month string, reducers int, combiner boolean, fail_first boolean, status string, "
    "started_at string, elapsed_seconds double, job_elapsed_seconds double, job_id string, error string"
)
INTERRUPTED = "Interrupted by restart"


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """One JSON document per run."""
    return spark.read.schema(RUN_SCHEMA).option("multiLine", True).json(path)


def reconcile_interrupted(runs: DataFrame) -> DataFrame:
    """Runs left RUNNING by a dead driver can never finish: mark them failed."""
    orphan = F.col("status") == "RUNNING"
    error = F.when(orphan, INTERRUPTED)
    if "error" in runs.columns:
        error = error.otherwise(F.col("error"))
    return runs.withColumns({"error": error, "status": F.when(orphan, "FAILED").otherwise(F.col("status"))})


def run_registry(runs: DataFrame, limit: int = 30) -> DataFrame:
    """The latest runs, newest first."""
    return reconcile_interrupted(runs).orderBy(F.desc("started_at"), F.desc("run_id")).limit(limit)


def month_catalog(manifests: DataFrame) -> DataFrame:
    """Imported months in order."""
    return manifests.select("month", "rows", "source_rows", "created_at").orderBy("month")
