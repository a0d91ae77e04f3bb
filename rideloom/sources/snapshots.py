"""An archive that grows and is mended month by month while others read it.

Data lie under data/year=/month=/run=, one run folder per write and month, and are never changed. The log holds one
small file per version that names, for every month, the run that is valid. A reader takes one version and
reads exactly its folders; a writer adds folders and then the next version, which fails if another writer was
first, and is tried again on top of that one.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rideloom.schema import SUM4
from rideloom.sources.archive import KIND_COLUMNS
from rideloom.workspace import create_text, list_names, read_text, remove

_TRIES = 20
_MONTH = re.compile(r"[0-9]{4}-(0[1-9]|1[0-2])")


class MonthChanged(ValueError):
    """Another writer has replaced a month since the version that a write was based on."""


@dataclass(frozen=True)
class Snapshot:
    """One version: the valid run of each month (``yyyy-MM``) that has rows."""

    version: int
    months: Mapping[str, str]


def versions(spark: SparkSession, root: str) -> list[int]:
    """All versions in the log, oldest first."""
    return sorted(int(name) for name in list_names(spark, f"{root}/log") if name.isdigit())


def snapshot(spark: SparkSession, root: str, version: int | None = None) -> Snapshot:
    """A version, by default the newest; version 0 is the empty archive."""
    if version is None:
        version = max(versions(spark, root), default=0)
    if version == 0:
        return Snapshot(0, {})
    return Snapshot(version, json.loads(read_text(spark, f"{root}/log/{version:020d}")))


def _folder(month: str, run: str) -> str:
    return f"year={int(month[:4])}/month={int(month[5:])}/run={run}"


def _written(spark: SparkSession, root: str, run: str) -> set[str]:
    """Months that a run has written; there are at most as many as the archive has months."""
    out = set()
    for year in list_names(spark, f"{root}/data"):
        for month in list_names(spark, f"{root}/data/{year}"):
            if f"run={run}" in list_names(spark, f"{root}/data/{year}/{month}"):
                out.add(f"{int(year.split('=')[1]):04d}-{int(month.split('=')[1]):02d}")
    return out


def replace_months(trips: DataFrame, root: str, months: Iterable[str] | None = None, based_on: int | None = None) -> Snapshot:
    """Make ``trips`` the content of their months; no other month is touched. Returns the new version.

    ``trips`` has ``day``. ``months`` (``yyyy-MM``) names what is replaced: rows of other months are refused, and
    a named month without rows becomes empty; by default it is the months that ``trips`` holds. With ``based_on``,
    a month that has changed since that version raises ``MonthChanged`` and nothing is published. Rows without a
    day have no month and raise an error.
    """
    spark = trips.sparkSession
    run = uuid.uuid4().hex
    named = None if months is None else set(months)
    if bad := [m for m in named or () if not _MONTH.fullmatch(m)]:
        raise ValueError(f"months must be yyyy-MM, got {bad}")
    month = F.date_format("day", "yyyy-MM")
    ok = month.isNotNull() if named is None else month.isin(*named) & month.isNotNull()
    checked = trips.withColumn("day", F.when(ok, F.col("day")).otherwise(
        F.raise_error(F.concat(F.lit("a row is of no month to replace: "), F.coalesce(month, F.lit("null")))).cast("date")))
    dated = checked.withColumns({"year": F.year("day"), "month": F.month("day"), "run": F.lit(run)})
    dated.hint("rebalance", "year", "month").write.mode("append").partitionBy("year", "month", "run").parquet(f"{root}/data")
    written = _written(spark, root, run)
    touched = written if named is None else named
    start = None if based_on is None else snapshot(spark, root, based_on)
    for _ in range(_TRIES):
        last = snapshot(spark, root)
        if start and any(last.months.get(m) != start.months.get(m) for m in touched):
            raise MonthChanged(f"months changed since version {based_on}: {sorted(touched)}")
        valid = {m: r for m, r in last.months.items() if m not in touched} | dict.fromkeys(written, run)
        if create_text(spark, f"{root}/log/{last.version + 1:020d}", json.dumps(valid, sort_keys=True)):
            return Snapshot(last.version + 1, valid)
    raise RuntimeError(f"other writers were first {_TRIES} times")


def read_months(
    spark: SparkSession, root: str, version: int | None = None, kind: str | None = None, months: tuple[str, str] | None = None
) -> DataFrame:
    """Rows of one version, which later writes do not change, with ``year`` and ``month``.

    ``months`` gives the first and the last one; folders of others are not listed. A kind is a choice of columns.
    The archive must have been written at least once.
    """
    taken = snapshot(spark, root, version)
    first, last = months or ("", "9999-99")
    folders = [f"{root}/data/{_folder(m, r)}" for m, r in sorted(taken.months.items()) if first <= m <= last]
    reader = spark.read.option("basePath", f"{root}/data")
    if folders:
        df = reader.schema(reader.parquet(folders[0]).schema).parquet(*folders)
    else:
        df = spark.createDataFrame([], reader.parquet(f"{root}/data").schema)
    return df.drop("run") if kind is None else df.select("year", "month", "day", *KIND_COLUMNS[kind], *SUM4[1:])


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Forget all versions but the newest ``keep``, and remove the runs that only forgotten ones name.

    Runs that no version has ever named may be writes under way, so they stay. Readers of forgotten versions
    lose their files: ``keep`` has to cover the longest read. Returns the folders removed.
    """
    if keep < 1:
        raise ValueError("at least one version must stay")
    known = versions(spark, root)
    old, new = known[:-keep], known[-keep:]
    gone = {pair for v in old for pair in snapshot(spark, root, v).months.items()}
    gone -= {pair for v in new for pair in snapshot(spark, root, v).months.items()}
    folders = sorted(f"{root}/data/{_folder(m, r)}" for m, r in gone)
    for folder in folders:
        remove(spark, folder)
    for v in old:
        remove(spark, f"{root}/log/{v:020d}")
    return folders
