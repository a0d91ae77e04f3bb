"""Concatenate and cut: token ids of a table as one long run, cut into sequences of a fixed length."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rideloom.llm.batches import text_chunks, with_columns
from rideloom.llm.tokens import encoder
from rideloom.workspace import cut_lineage

#: Most tasks of a job whose totals may be sent to every executor (16 bytes each).
MAX_PARTS = 4_000_000


def tokenized(docs: DataFrame, tokenizer: str, end_id: int, id_column: str = "doc_id", text_column: str = "text"):
    """Write ``docs`` as token ids and return the written table.

    Columns: ``doc_id``, ``part`` (the task that wrote the row), ``before`` (ids that this task wrote earlier),
    ``n_ids`` and ``ids`` (little-endian unsigned 32-bit, ``end_id`` last). A null or empty text has only
    ``end_id``; a null id stays null; other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, last = encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        part, before = TaskContext.get().partitionId(), 0
        for rows, texts in text_chunks(batches):
            ids = [x + last for x in encode(texts)]
            sizes = np.array([len(x) // 4 for x in ids], np.int64)
            ends = before + np.cumsum(sizes)
            yield with_columns(
                rows, ["doc_id"], part=np.full(len(ids), part, np.int32), before=ends - sizes, n_ids=sizes,
                ids=pa.array(ids, pa.binary()),
            )
            before = int(ends[-1])

    narrow = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return cut_lineage(
        narrow.mapInArrow(run, "doc_id long, part int, before long, n_ids long, ids binary"), "token-ids"
    )


def part_starts(table: DataFrame) -> DataFrame:
    """``part`` and ``first``: ids in all parts before it. One row for each task, so the window stays small."""
    totals = table.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    return starts


def pack(
    docs: DataFrame, tokenizer: str, end_id: int = 1, length: int = 2048, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Boundary records of the sequences: one row for each piece of a document in a sequence.

    First pass: ids of every document and the total of every task. Second pass: prefix sums of the totals
    turn places in a task into places in the whole run, which is cut every ``length`` ids. All sequences
    but the last are full. ``padded_length`` of the last one is ``length``, or its own size where that is a
    power of two.

    Columns: ``doc_id``, ``start``, ``length``, ``ids`` (the piece), ``ids_crc32``, ``doc_tokens``,
    ``sequence_id``, ``offset``, ``padded_length``. Rows keep their own pieces when ids repeat; a null text
    counts as empty; an empty table gives no row.
    """
    table = tokenized(docs, tokenizer, end_id, id_column, text_column)
    starts = cut_lineage(part_starts(table), "part-starts")
    parts, total = starts.join(table.groupBy("part").agg(F.sum("n_ids").alias("n")), "part").agg(
        F.count("*"), F.max(F.col("first") + F.col("n"))).first()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = (total or 0) - (total or 0) % length
        rest = (total or 0) - last
        padded = rest if rest and rest & (rest - 1) == 0 else length
        for rows, found in text_chunks(batches, "ids"):
            out = []
            for doc, place, ids in zip(*(rows.column(i).to_pylist() for i in range(2)), found, strict=True):
                size = len(ids) // 4
                cuts = [0, *range(length - place % length, size, length), size]
                for a, b in zip(cuts, cuts[1:], strict=False):
                    piece = ids[4 * a : 4 * b]
                    at = place + a
                    out.append((doc, a, b - a, piece, zlib.crc32(piece), size, at // length, at % length,
                                padded if at >= last else length))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names
            )

    names = ["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padded_length"]
    kinds = [pa.binary() if n == "ids" else pa.int64() for n in names]
    if parts <= MAX_PARTS:
        starts = F.broadcast(starts)
    placed = table.join(starts, "part").select("doc_id", (F.col("first") + F.col("before")).alias("place"), "ids")
    schema = ", ".join(f"{n} {'binary' if n == 'ids' else 'long'}" for n in names)
    return placed.mapInArrow(run, schema)
