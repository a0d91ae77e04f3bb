"""Shard manifests: hashes, verification, content-addressed publishing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rideloom.workspace import exists


def shard_manifest(spark: SparkSession, path: str) -> DataFrame:
    """name, rows, bytes and SHA-256 of every shard, from one pass over the files.

    A shard is one row here, which its bounded size (``write_shards``) makes safe.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    text = F.decode("content", "UTF-8")
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.regexp_count(text, F.lit("\n")).cast("long").alias("rows"),
        F.col("length").alias("bytes"),
        F.sha2("content", 256).alias("sha256"),
    )


def manifest_totals(manifest: DataFrame) -> DataFrame:
    return manifest.agg(
        F.count("*").alias("shards"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes")
    )


def manifest_differences(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """Shards whose name and hash are not the same on disk and in the manifest, with the reason."""
    disk = shard_manifest(spark, path).select("name", F.col("sha256").alias("on_disk"))
    known = manifest.select("name", F.col("sha256").alias("expected"))
    status = (
        F.when(F.col("on_disk").isNull(), "missing")
        .when(F.col("expected").isNull(), "unexpected")
        .when(F.col("on_disk") != F.col("expected"), "corrupted")
    )
    return known.join(disk, "name", "full_outer").select("name", status.alias("status")).filter(
        F.col("status").isNotNull()
    )


def verify_manifest(spark: SparkSession, path: str, manifest: DataFrame, rows: int | None = None) -> None:
    """Raise ValueError unless the folder holds exactly the manifest's shards (and ``rows`` rows in all)."""
    bad = manifest_differences(spark, path, manifest).take(5)
    if bad:
        raise ValueError(f"shards differ: {[(row['name'], row['status']) for row in bad]}")
    if rows is not None:
        found = manifest_totals(manifest).first()["rows"]
        if found != rows:
            raise ValueError(f"the dataset holds {found} rows, not {rows}")


def fingerprint(manifest: DataFrame) -> DataFrame:
    """One SHA-256 for a set of shards, whatever their order.

    Hashed in two levels, so no list of all shards is built: 4096 groups by hash prefix, then the
    groups.
    """
    groups = manifest.groupBy(F.substring("sha256", 1, 3).alias("prefix")).agg(
        F.sha2(F.concat_ws("\n", F.sort_array(F.collect_list(F.concat_ws(" ", "name", "sha256")))), 256).alias("digest")
    )
    ordered = F.sort_array(F.collect_list(F.concat_ws(" ", "prefix", "digest")))
    return groups.agg(F.sha2(F.concat_ws("\n", ordered), 256).alias("fingerprint"))


def publish_once(df: DataFrame, manifest: DataFrame, root: str) -> tuple[str, bool]:
    """Write ``df`` under root/<fingerprint of its manifest>; skip if a finished copy is there.

    The committer's _SUCCESS file is the ready mark: a folder without it is written anew.
    Returns the folder and whether it was written now.
    """
    target = f"{root}/{fingerprint(manifest).first()['fingerprint']}"
    if exists(df.sparkSession, f"{target}/_SUCCESS"):
        return target, False
    df.write.mode("overwrite").parquet(target)
    return target, True
