"""Where intermediate tables, stream checkpoints and published results go."""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by the session; where it is unset, a folder in the warehouse, which is shared too."""
    root = spark.conf.get(_SETTING, None)
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
        spark.conf.set(_SETTING, root)
    return root.rstrip("/")


def session_folder(spark: SparkSession) -> str:
    """This application's part of the shared folder; Spark's driver removes it when it ends."""
    path = f"{shared_root(spark)}/rideloom-{spark.sparkContext.applicationId}"
    files, target = _path(spark, path)
    files.deleteOnExit(target)
    return path


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    return f"{session_folder(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder once and continue from the written table."""
    path = fresh_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(*tables: DataFrame) -> None:
    """Remove tables written by ``cut_lineage`` that nothing will read again.

    What is passed may read several of them; files elsewhere stay.
    """
    for df in tables:
        spark = df.sparkSession
        own = session_folder(spark)
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            if own.split(":", 1)[-1].lstrip("/") in folder:
                remove(spark, folder)


def drop_unused_shuffles(spark: SparkSession) -> None:
    """Let Spark find out now, and not at the driver's next full collection, which shuffle files nothing refers to."""
    spark._jvm.System.gc()


def _path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _path(spark, path)
    return files.exists(target)


def is_folder(spark: SparkSession, path: str) -> bool:
    files, target = _path(spark, path)
    return files.exists(target) and files.getFileStatus(target).isDirectory()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of our own; nothing happens if it is not there."""
    files, target = _path(spark, path)
    files.delete(target, True)


def age_seconds(spark: SparkSession, path: str) -> float:
    """Seconds since a file or folder was last changed, by the clock of this machine."""
    files, target = _path(spark, path)
    return time.time() - files.getFileStatus(target).getModificationTime() / 1000


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Put ``text`` into a small file; readers see the old or the new content, never a part."""
    files, target = _path(spark, path)
    fresh = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    out = files.create(fresh)
    out.write(bytearray(text.encode()))
    out.close()
    overwrite = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(files.makeQualified(fresh), files.makeQualified(target), overwrite)


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Put ``text`` into a new small file, complete in one step; False and no change if it is there already."""
    files, target = _path(spark, path)
    fresh = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    out = files.create(fresh)
    out.write(bytearray(text.encode()))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(files.makeQualified(fresh), files.makeQualified(target),
                       spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Py4JJavaError:
        files.delete(fresh, False)
        if files.exists(target):
            return False
        raise
    return True


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if it is not there."""
    files, target = _path(spark, path)
    return [status.getPath().getName() for status in files.listStatus(target)] if files.exists(target) else []


def read_text(spark: SparkSession, path: str) -> str:
    files, target = _path(spark, path)
    stream = files.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
