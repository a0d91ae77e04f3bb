"""Publishing of results: key families by month, the latest pointer, exports."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rideloom.functions.measures import ratio_or_zero
from rideloom.operators.families import classified_cuboid, family, split_cells
from rideloom.operators.flows import top_od
from rideloom.operators.quality import classify_rejects, typed_parse
from rideloom.operators.summary import EXPORT_COLUMNS, hourly_profile, summary, zone_ranking
from rideloom.operators.verify import conservation_check, require_conservation
from rideloom.schema import SUM4, Rules, month_arg_guard
from rideloom.workspace import age_seconds, cut_lineage, exists, list_names, read_text, remove, replace_text


def write_families(families: DataFrame, path: str) -> None:
    """One folder per kind, so the large day-zone-hour family is not read for the others."""
    families.write.mode("overwrite").partitionBy("kind").parquet(path)


_FAMILIES = "zone int, hour int, day date, dest int, " + ", ".join(f"{name} long" for name in SUM4) + ", kind string"
_REJECTS = "reason string, rows long"


def publish_result(families: DataFrame, month: str, root: str, rejects: DataFrame | None = None) -> None:
    """Publish a run of the month: its families and reject counts, both complete or not at all.

    Every run has a folder of its own, so nothing of an earlier run stays, not even a kind or reason that
    has become empty. The pointers, one small file each that is replaced in one step, are written last.
    """
    month_arg_guard(month)
    spark = families.sparkSession
    run = f"runs/{month}/{uuid.uuid4().hex}"
    families.select("kind", "zone", "hour", "day", "dest", *SUM4).write.partitionBy("kind").parquet(f"{root}/{run}/families")
    rejects = spark.createDataFrame([], _REJECTS) if rejects is None else rejects.select("reason", "rows")
    rejects.write.parquet(f"{root}/{run}/rejects")
    replace_text(spark, f"{root}/months/{month}", f"{month} {run}")
    replace_text(spark, f"{root}/latest", f"{month} {run}")


def _published(spark: SparkSession, root: str, month: str | None) -> tuple[str, str]:
    """Month and run folder that the pointer names, by default the one published last."""
    pointer = "latest" if month is None else f"months/{month_arg_guard(month)}"
    found, run = read_text(spark, f"{root}/{pointer}").split()
    return found, f"{root}/{run}"


def read_result(spark: SparkSession, root: str, month: str | None = None) -> DataFrame:
    """Families of a month, by default of the one published last."""
    month, run = _published(spark, root, month)
    return spark.read.schema(_FAMILIES).parquet(f"{run}/families").withColumn("month", F.lit(month))


def read_rejects(spark: SparkSession, root: str, month: str | None = None) -> DataFrame:
    """Reject counts by reason of the same run that :func:`read_result` reads; no row if nothing was rejected."""
    return spark.read.schema(_REJECTS).parquet(f"{_published(spark, root, month)[1]}/rejects")


@contextmanager
def reading(spark: SparkSession, root: str, month: str | None = None) -> Iterator[DataFrame]:
    """Families of a month, by default of the one published last, whose files stay until the block ends.

    A lease, one small file, names the run, so :func:`expire_runs` leaves it even if another one is published meanwhile.
    """
    lease = f"{root}/leases/{uuid.uuid4().hex}"
    try:
        while True:
            found, run = _published(spark, root, month)
            replace_text(spark, lease, run.removeprefix(f"{root}/"))
            if exists(spark, run):  # it may have been removed before the lease was there; then the pointer has moved
                break
        yield spark.read.schema(_FAMILIES).parquet(f"{run}/families").withColumn("month", F.lit(found))
    finally:
        remove(spark, lease)


def expire_runs(spark: SparkSession, root: str, min_age: float = 86_400, lease_age: float = 604_800) -> list[str]:
    """Remove the runs that no pointer and no lease names; returns their folders.

    Runs changed less than ``min_age`` seconds ago stay: they may be about to be published, or be read without a lease.
    Leases older than ``lease_age`` belong to readers that are gone and are removed as well.
    """
    named = {read_text(spark, f"{root}/months/{m}").split()[1] for m in list_names(spark, f"{root}/months")}
    if exists(spark, f"{root}/latest"):
        named.add(read_text(spark, f"{root}/latest").split()[1])
    for name in list_names(spark, f"{root}/leases"):
        lease = f"{root}/leases/{name}"
        if age_seconds(spark, lease) > lease_age:
            remove(spark, lease)
        else:
            named.add(read_text(spark, lease))
    runs = [f"runs/{month}/{run}" for month in list_names(spark, f"{root}/runs") for run in list_names(spark, f"{root}/runs/{month}")]
    gone = [f"{root}/{run}" for run in runs if run not in named and age_seconds(spark, f"{root}/{run}") >= min_age]
    for folder in gone:
        remove(spark, folder)
    return gone


def run_month(raw: DataFrame, month: str, root: str, rules: Rules = Rules()) -> DataFrame:
    """The monthly job: validate, aggregate, check, publish. Returns the conservation row.

    The raw lines are read once, into base cells and reject counts kept in the shared folder; the
    families start from that small table, and the check reads the very rows that are then published.
    """
    month_arg_guard(month)
    cells = cut_lineage(classified_cuboid(classify_rejects(typed_parse(raw), month, rules)), "cells")
    families, rejects = split_cells(cells)
    families = cut_lineage(families, "families")
    check = conservation_check(families, rejects, cells.agg(F.sum("trips").alias("input")))
    require_conservation(check)
    publish_result(families, month, root, rejects)
    return check


def analysis(
    spark: SparkSession,
    root: str,
    zones: DataFrame,
    month: str | None = None,
    hour: int | None = None,
    borough: str | None = None,
) -> dict[str, DataFrame]:
    """The tables behind one view of a published month: summary, zones, hourly, quality; without
    filters also days and top_od. Each reads only the folders of its own family.
    """
    month = month or _published(spark, root, None)[0]
    families, rejects = read_result(spark, root, month), read_rejects(spark, root, month)
    zh = family(families, "Z")
    tables = {
        "summary": summary(zh, zones, hour, borough),
        "zones": zone_ranking(zh, zones, None, hour, borough),
        "hourly": hourly_profile(zh, zones, borough),
        "quality": published_quality(zh, rejects),
    }
    if hour is None and borough is None:
        tables["days"] = family(families, "D").orderBy("day")
        tables["top_od"] = top_od(family(families, "O"), 10)
    return tables


def published_quality(zh: DataFrame, rejects: DataFrame) -> DataFrame:
    """Input, valid and rejected rows and the reasons (at most seven) of a published month; filters do not touch it."""
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct("reason", "rows"))))
    told = rejects.agg(F.struct(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), entries.alias("reasons"))).scalar()
    counts = zh.agg(F.coalesce(F.sum("trips"), F.lit(0)).alias("valid")).withColumn("told", told).select(
        "valid", F.col("told.rows").alias("rejected"), F.col("told.reasons").alias("reasons"))
    total = F.col("valid") + F.col("rejected")
    return counts.select(
        total.alias("input"), "valid", "rejected",
        ratio_or_zero(F.col("valid") * F.lit(100.0), total).alias("valid_pct"), "reasons",
    )


def export_zone_csv(
    zh: DataFrame, zones: DataFrame, path: str, hour: int | None = None, borough: str | None = None
) -> None:
    """The ranked zone table of the current filters as CSV with a header."""
    export_zones(zh, zones, hour, borough).write.mode("overwrite").option("header", True).csv(path)


def export_zones(zh: DataFrame, zones: DataFrame, hour: int | None = None, borough: str | None = None) -> DataFrame:
    return zone_ranking(zh, zones, None, hour, borough).select(*EXPORT_COLUMNS)
