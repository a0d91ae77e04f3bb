"""Manifests of shard folders: hashes of chunks in a tree, and the request that a dataset answers.

Chunks of a fixed size are read and hashed by the tasks, so no shard is ever one row; a shard's digest is the root of a
tree over its chunks. The manifest is one small document, replaced in one step, beside a table of all chunks.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rideloom.schema import month_arg_guard
from rideloom.workspace import exists, read_text, replace_text

CHUNK_BYTES = 4 << 20
#: Children of a node of the tree.
FAN_OUT = 256
_CHUNKS = "name string, chunk long, bytes long, rows long, sha256 string"
_DOCUMENT = "_manifest.json"


@dataclass(frozen=True)
class Request:
    """What a dataset was asked to hold; ``requested_rows`` 0 means all of the source."""

    month: str
    source: str
    requested_rows: int
    shard_rows: int
    columns: tuple[str, ...]

    def __post_init__(self) -> None:
        month_arg_guard(self.month)
        if self.requested_rows < 0 or self.shard_rows < 1:
            raise ValueError("requested_rows >= 0 and shard_rows >= 1 are needed")


class OtherRequest(ValueError):
    """The folder holds a dataset that answers another request."""


class Corrupted(ValueError):
    """Shards differ from the manifest."""


def chunk_hashes(spark: SparkSession, folder: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``name``, ``chunk``, ``bytes``, ``rows`` (line ends) and ``sha256`` of every piece of every shard; an empty shard has none."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("path", "length")
    last = (F.ceil(F.col("length") / chunk_bytes) - 1).cast("long")  # file scans pass over empty files
    pieces = files.select("path", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("chunk"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, chunk in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                store, name = fs.FileSystem.from_uri(unquote(path) if "://" in path else "file://" + unquote(path.removeprefix("file:")))
                with store.open_input_file(name) as file:
                    file.seek(chunk * chunk_bytes)
                    raw = file.read(chunk_bytes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name.rsplit("/", 1)[1]]), pa.array([chunk]), pa.array([len(raw)]), pa.array([raw.count(b"\n")]),
                     pa.array([hashlib.sha256(raw).hexdigest()])], ["name", "chunk", "bytes", "rows", "sha256"])

    # Chunks of a shard are spread: by place they would all stay with the task that listed it.
    return pieces.repartition("path", "chunk").mapInArrow(run, _CHUNKS)


def shard_digests(chunks: DataFrame) -> DataFrame:
    """One row per shard: ``name``, ``chunks``, ``bytes``, ``rows`` and ``digest``, the root of its tree.

    A node's digest is that of its children's digests, one a line; nodes have ``FAN_OUT`` children, so no row gathers more.
    """
    level = chunks.select("name", F.col("chunk").alias("at"), "sha256", F.lit(1).cast("long").alias("chunks"), "bytes", "rows")
    most = chunks.agg(F.max("chunk")).first()[0] or 0
    while True:
        children = F.transform(F.array_sort(F.collect_list(F.struct("at", "sha256"))), lambda c: c["sha256"])
        level = level.groupBy("name", F.floor(F.col("at") / FAN_OUT).alias("up")).agg(
            F.sha2(F.array_join(children, "\n"), 256).alias("sha256"), *[F.sum(c).alias(c) for c in ("chunks", "bytes", "rows")],
        ).withColumnRenamed("up", "at")
        most //= FAN_OUT
        if not most:
            return level.select("name", "chunks", "bytes", "rows", F.col("sha256").alias("digest"))


def publish_manifest(spark: SparkSession, folder: str, request: Request, source_rows: int, chunk_bytes: int = CHUNK_BYTES) -> dict:
    """Hash the shards of ``folder`` and make the document that describes them its manifest."""
    table = f"_chunks-{uuid.uuid4().hex}"
    chunk_hashes(spark, folder, chunk_bytes).write.parquet(f"{folder}/{table}")
    shards = shard_digests(spark.read.schema(_CHUNKS).parquet(f"{folder}/{table}"))
    totals = shards.agg(F.count("*").alias("shards"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    document = asdict(request) | totals.asDict() | {
        "columns": list(request.columns), "source_rows": source_rows, "chunk_bytes": chunk_bytes, "chunks": table,
        "sampling": "first rows, not random" if request.requested_rows else "all rows"}
    replace_text(spark, f"{folder}/{_DOCUMENT}", json.dumps(document, sort_keys=True))
    return document


def read_manifest(spark: SparkSession, folder: str) -> dict | None:
    return json.loads(read_text(spark, f"{folder}/{_DOCUMENT}")) if exists(spark, f"{folder}/{_DOCUMENT}") else None


def known_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """The chunks as they were when the manifest was published."""
    return spark.read.schema(_CHUNKS).parquet(f"{folder}/{read_manifest(spark, folder)['chunks']}")


def chunk_differences(spark: SparkSession, folder: str, known: DataFrame | None = None) -> DataFrame:
    """Chunks that are not what the manifest (or ``known``) says: ``name``, ``chunk``, ``status``."""
    size = read_manifest(spark, folder)["chunk_bytes"]
    disk = chunk_hashes(spark, folder, size).select("name", "chunk", F.col("sha256").alias("on_disk"))
    expected = (known or known_chunks(spark, folder)).select("name", "chunk", F.col("sha256").alias("expected"))
    status = F.when(F.col("on_disk").isNull(), "missing").when(F.col("expected").isNull(), "unexpected").when(
        F.col("on_disk") != F.col("expected"), "corrupted")
    return expected.join(disk, ["name", "chunk"], "full_outer").select("name", "chunk", status.alias("status")).filter("status is not null")


def open_dataset(
    spark: SparkSession, folder: str, request: Request, make: Callable[[], int], chunk_bytes: int = CHUNK_BYTES
) -> dict:
    """The manifest of a folder that answers ``request``.

    A folder with a manifest is checked: another request raises ``OtherRequest``, shards that differ raise ``Corrupted``
    with the first of the chunks. Otherwise ``make`` writes the shards and returns the number of source rows.
    """
    found = read_manifest(spark, folder)
    if found is None:
        return publish_manifest(spark, folder, request, make(), chunk_bytes)
    asked = asdict(request) | {"columns": list(request.columns)}
    if other := sorted(k for k, v in asked.items() if found[k] != v):
        raise OtherRequest(f"the folder answers another request: {', '.join(f'{k} is {found[k]!r}' for k in other)}")
    bad = chunk_differences(spark, folder).orderBy("name", "chunk").take(5)
    if bad:
        raise Corrupted(f"chunks differ: {[(r['name'], r['chunk'], r['status']) for r in bad]}")
    return found

