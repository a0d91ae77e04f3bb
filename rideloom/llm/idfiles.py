"""Files of token ids in independent, checksummed blocks, coded by the context-mixing range coder."""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rideloom.llm.batches import text_chunks
from rideloom.llm.coder import decode, encode
from rideloom.llm.packing import MAX_PARTS, part_starts
from rideloom.llm.tokens import encoder

#: Ids of a block, blocks that are coded side by side, and blocks after which a writer begins a new file.
BLOCK_IDS, SIDE_BY_SIDE, FILE_BLOCKS = 4096, 2048, 8192
#: Fixed values of the format. A block: mark, ids, entries, bytes of its payload, CRC-32 of its ids and of its
#: payload; then its entries (document id, or the least long where it is null; ids of the document before this
#: block; ids in it); then the payload.
_HEAD = struct.Struct("<4sIIIII")
_ENTRY = np.dtype([("doc", "<i8"), ("before", "<u8"), ("n", "<u4")])
_MARK = b"TKC1"
_NULL = -(1 << 63)
#: Bytes of text that one task codes; coding takes longer than reading, so this is less than a usual partition.
TASK_BYTES = 16 << 20
#: Bytes of text whose pieces are looked up together.
CHUNK_BYTES = 8 << 20


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


@dataclass
class _Block:
    entries: list[tuple[int, int, int]]
    ids: np.ndarray


def _blocks(docs: Iterator[tuple[int | None, np.ndarray]]) -> Iterator[_Block]:
    """Documents one after the other, cut every ``BLOCK_IDS`` ids."""
    entries, parts, size = [], [], 0
    for doc, ids in docs:
        at = 0
        while at < len(ids):
            n = min(len(ids) - at, BLOCK_IDS - size)
            entries.append((_NULL if doc is None else doc, at, n))
            parts.append(ids[at : at + n])
            at, size = at + n, size + n
            if size == BLOCK_IDS:
                yield _Block(entries, np.concatenate(parts))
                entries, parts, size = [], [], 0
    if size:
        yield _Block(entries, np.concatenate(parts))


def block_bytes(blocks: list[_Block]) -> list[bytes]:
    out = []
    for block, payload in zip(blocks, encode([b.ids for b in blocks]), strict=True):
        crc = zlib.crc32(block.ids.astype("<u4").tobytes())
        head = _HEAD.pack(_MARK, len(block.ids), len(block.entries), len(payload), crc, zlib.crc32(payload))
        out.append(head + np.array(block.entries, _ENTRY).tobytes() + payload)
    return out


def blocks_of(raw: bytes) -> list[_Block]:
    """The blocks in ``raw``, decoded side by side; a wrong checksum raises ``ValueError``."""
    heads, entries, payloads, at = [], [], [], 0
    while at < len(raw):
        head = _HEAD.unpack_from(raw, at)
        if head[0] != _MARK:
            raise ValueError("not a block of token ids")
        at += _HEAD.size
        entries.append(np.frombuffer(raw, _ENTRY, head[2], at))
        at += head[2] * _ENTRY.itemsize
        payloads.append(raw[at : at + head[3]])
        at += head[3]
        if zlib.crc32(payloads[-1]) != head[5]:
            raise ValueError("a block's payload does not match its checksum")
        heads.append(head)
    out = []
    for head, entry, ids in zip(heads, entries, decode(payloads, [h[1] for h in heads]), strict=True):
        if zlib.crc32(ids.astype("<u4").tobytes()) != head[4]:
            raise ValueError("a block's ids do not match their checksum")
        out.append(_Block(entry.tolist(), ids))
    return out


def write(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Write the ids of ``docs`` in ascending order of their id and return the table of files.

    Spark sorts the texts by ranges of ids; each task encodes its range and writes files of its own. The
    table, stored in ``folder``/manifest, names the files of finished tasks only, so those of lost or repeated
    attempts are never read. Columns: ``part`` (range, ascending), ``file``, ``number`` (in the range),
    ``cuts`` (places in the file after every ``SIDE_BY_SIDE`` blocks) and ``n_ids``. A null or empty text has
    only ``end_id``; null ids come first; rows with equal ids stay apart, in any order.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoded, last = encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        store, root = _open(folder)
        store.create_dir(root, recursive=True)
        part, number = TaskContext.get().partitionId(), 0

        def documents():
            for rows, texts in text_chunks(batches, max_bytes=CHUNK_BYTES):
                for doc, x in zip(rows.column(0).to_pylist(), encoded(texts), strict=True):
                    yield doc, np.frombuffer(x + last, "<u4")

        def groups():
            held = []
            for block in _blocks(documents()):
                held.append(block)
                if len(held) == SIDE_BY_SIDE:
                    yield held
                    held = []
            if held:
                yield held

        out, rows = None, []
        for held in groups():
            if out is None:
                name, cuts, n_ids, n_blocks = f"part-{part:07d}-{uuid.uuid4().hex}.tkc", [0], 0, 0
                out = store.open_output_stream(f"{root}/{name}")
            raw = b"".join(block_bytes(held))
            out.write(raw)
            cuts.append(cuts[-1] + len(raw))
            n_ids += sum(len(b.ids) for b in held)
            n_blocks += len(held)
            if n_blocks >= FILE_BLOCKS:
                out.close()
                rows.append((part, number, name, cuts, n_ids))
                out, number = None, number + 1
        if out is not None:
            out.close()
            rows.append((part, number, name, cuts, n_ids))
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.list_(pa.int64()), pa.int64()]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                         names=["part", "number", "file", "cuts", "n_ids"])

    narrow = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    total = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = narrow.repartitionByRange(min(-(-total // TASK_BYTES) or 1, MAX_PARTS), "doc_id").sortWithinPartitions("doc_id")
    schema = "part int, number int, file string, cuts array<long>, n_ids long"
    ranges.mapInArrow(run, schema).write.parquet(f"{folder}/manifest")
    return docs.sparkSession.read.schema(schema).parquet(f"{folder}/manifest")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """What the files of ``folder`` hold: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``,
    ``ids_crc32`` (of its ids as little-endian unsigned 32-bit) and ``ids``.

    One task each decodes the files of one range in their order, a group of blocks at a time; checksums are
    verified. Documents that cross blocks or files are put together again.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        for batch in batches:
            for row in range(batch.num_rows):
                files = sorted(json.loads(batch.column(1)[row].as_py()), key=lambda f: f["number"])
                first = batch.column(2)[row].as_py()
                doc, pieces, out, held = None, [], [], 0
                for raw in _groups(store, root, files):
                    for block in blocks_of(raw):
                        at = 0
                        for entry in block.entries:
                            if entry[1] == 0 and pieces:
                                out.append((doc, first, pieces))
                                first += sum(map(len, pieces))
                                pieces = []
                            doc = entry[0]
                            pieces.append(block.ids[at : at + entry[2]])
                            at += entry[2]
                        held += len(block.ids)
                        if held >= 1 << 20:
                            yield _rows(out)
                            out, held = [], 0
                if pieces:
                    out.append((doc, first, pieces))
                yield _rows(out)

    files = spark.read.schema("part int, number int, file string, cuts array<long>, n_ids long").parquet(
        f"{folder}/manifest")
    starts, n_parts = part_starts(files), files.select("part").distinct().count()
    if n_parts <= MAX_PARTS:
        starts = F.broadcast(starts)
    ranges = files.groupBy("part").agg(F.to_json(F.collect_list(F.struct("number", "file", "cuts"))).alias("files"))
    # A few hundred bytes a row, but many seconds of work: one task each, which a count given here keeps.
    placed = ranges.join(starts, "part").repartitionByRange(max(n_parts, 1), "part")
    return placed.select("part", "files", "first").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


def _groups(store: fs.FileSystem, root: str, files: list[dict]) -> Iterator[bytes]:
    for entry in files:
        with store.open_input_file(f"{root}/{entry['file']}") as file:
            for begin, end in zip(entry["cuts"], entry["cuts"][1:], strict=False):
                file.seek(begin)
                yield file.read(end - begin)


def _rows(found: list[tuple[int, int, list[np.ndarray]]]) -> pa.RecordBatch:
    raw = [np.concatenate(pieces).astype("<u4").tobytes() for _, _, pieces in found]
    return pa.RecordBatch.from_arrays([
        pa.array([None if d == _NULL else d for d, _, _ in found], pa.int64()),
        pa.array([s for _, s, _ in found], pa.int64()), pa.array([len(x) // 4 for x in raw], pa.int64()),
        pa.array([zlib.crc32(x) for x in raw], pa.int64()), pa.array(raw, pa.binary()),
    ], names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"])
