"""Many files of a few schemas: footers first, then one scan per schema."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rideloom.sources.archive import ALIASES, TYPES, normalize_schema_drift

FOOTERS_PER_TASK = 200


def file_schemas(spark: SparkSession, path: str, aliases: Mapping[str, str] = ALIASES, types: Mapping[str, str] = TYPES) -> DataFrame:
    """``path`` and ``signature`` of every Parquet file under ``path``, from the footers, read in parallel by the tasks.

    The signature lists names and types of the columns that a normalised table may use, in the file's order; files
    that differ in other columns only share one. Stores are opened by pyarrow (local, hdfs, s3, gs, abfs).
    """
    wanted = {*aliases, *types}
    names = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path).select("path", "length")

    def signature(file: str) -> str:
        store, name = fs.FileSystem.from_uri(unquote(file)) if "://" in file else fs.FileSystem.from_uri("file://" + unquote(file.removeprefix("file:")))
        with store.open_input_file(name) as source:
            return ", ".join(f"{f.name} {f.type}" for f in pq.read_schema(source) if f.name in wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            paths = rows.column(0)
            yield pa.RecordBatch.from_arrays([paths, pa.array([signature(p) for p in paths.to_pylist()])], ["path", "signature"])

    tasks = max(1, -(-names.count() // FOOTERS_PER_TASK))
    return names.select("path").repartition(tasks, "path").mapInArrow(run, "path string, signature string")


def read_drifting(spark: SparkSession, path: str, aliases: Mapping[str, str] = ALIASES, types: Mapping[str, str] = TYPES) -> DataFrame:
    """All files under ``path`` as one table of the columns in ``types``; those that lack one are skipped.

    One scan for each distinct signature, whatever the number of files; the driver gets the file names, as it
    does for any scan.
    """
    groups = file_schemas(spark, path, aliases, types).groupBy("signature").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    found = sorted(groups.collect(), key=lambda r: r["paths"][0])
    if not found:
        raise ValueError(f"no Parquet files under {path}")
    return normalize_schema_drift([spark.read.parquet(*r["paths"]) for r in found], aliases, types)
