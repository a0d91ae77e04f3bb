"""WARC files as a Python data source: written record by record, read by headers first.

Reading plans one partition for each stretch of a file. Stretches begin at records: the writer notes their
places in the manifest, since a payload may quote anything, other records too. Archives of other writers have no
manifest: single files, or folders of ``.warc`` and ``.warc.gz``, are read file by file, members of gzip one after
another; names of header fields count in any case, values may go on in a further line, and where our field of the full
length is absent ``payload_length`` is ``Content-Length``. A record's block is given as ``payload`` as it stands. Any
other file in such a folder, and a file that is cut off or holds something else, is an error; names that begin with
``_`` or ``.`` are passed over.

Reading passes filters on ``record_type``, ``date``,
``uri`` and ``record_id`` down: a record's header lines are parsed first and its payload is decoded only
if the record passes and the column is asked for (option ``payload``, true unless set to false).
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage,
)

#: Bytes after which a writer begins a new file, and bytes after which it notes a place to begin reading at.
FILE_BYTES, SPLIT_BYTES = 128 << 20, 32 << 20
_BLOCK = 1 << 20
_VERSION = b"WARC/1.1\r\n"
#: Names of the format's header fields, and of the profile of revisits by equal payload.
TYPE, RECORD_ID, URI, DATE = "WARC-Type", "WARC-Record-ID", "WARC-Target-URI", "WARC-Date"
LENGTH, DIGEST, REFERS_TO, PROFILE = "Content-Length", "WARC-Payload-Digest", "WARC-Refers-To", "WARC-Profile"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A field of our own: bytes of the full payload, also where a revisit does not repeat it.
FULL_LENGTH = "X-Payload-Length"
COLUMNS = {  # column -> header field
    "record_type": TYPE, "record_id": RECORD_ID, "uri": URI, "date": DATE, "payload_digest": DIGEST,
    "refers_to": REFERS_TO, "payload_length": FULL_LENGTH,
}
SCHEMA = ("record_type string, record_id string, uri string, date string, payload_digest string, "
          "refers_to string, payload_length long, payload binary")


def digest(payload: bytes) -> str:
    """SHA-1 in upper-case base32, as archives name payloads."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(fields: dict[str, str | None], payload: bytes) -> bytes:
    """One record; line breaks in values become spaces, empty values leave their field out."""
    lines = [f"{k}: {' '.join(v.split())}\r\n" for k, v in fields.items() if v is not None and v.strip()]
    head = "".join([*lines, f"{LENGTH}: {len(payload)}\r\n\r\n"]).encode()
    return b"".join([_VERSION, head, payload, b"\r\n\r\n"])


def parse_head(lines: list[bytes]) -> dict[str, str]:
    """Header fields by name in lower case, without the version line; unknown fields are kept."""
    out, last = {}, None
    for raw in lines:
        line = raw.decode("utf-8", "replace").rstrip("\r\n")
        name, colon, value = line.partition(":")
        if line[:1] in (" ", "\t") and last:
            out[last] = f"{out[last]} {line.strip()}".strip()
        elif colon:
            last = name.strip().lower()
            out[last] = value.strip()
    return out


class _Bytes:
    """Bytes of a file from a place on, read in blocks; what is left out beyond the block at hand is not read."""

    def __init__(self, file, at: int = 0) -> None:
        file.seek(at)
        self.file, self.at, self.block, self.used = file, at, b"", 0

    def fetch(self) -> bytes:
        return self.file.read(_BLOCK)

    def pass_over(self, size: int) -> None:
        self.file.seek(self.file.tell() + size)

    def line(self) -> bytes:
        """The next line with its end; empty at the end of the file."""
        while (end := self.block.find(b"\n", self.used)) < 0:
            more = self.fetch()
            if len(self.block) - self.used > _BLOCK:
                raise ValueError(f"no header line ends within {_BLOCK} bytes of place {self.at}")
            self.block, self.used = self.block[self.used :] + more, 0
            if not more:
                end = len(self.block) - 1
                break
        out = self.block[self.used : end + 1]
        self.used = end + 1
        self.at += len(out)
        return out

    def read(self, size: int) -> bytes:
        out = [self.block[self.used : self.used + size]]
        self.used += len(out[0])
        left = size - len(out[0])
        while left:
            self.block, self.used = self.fetch(), 0
            if not self.block:
                raise ValueError(f"the record's block at {self.at} is cut off")
            out.append(self.block[:left])
            self.used = len(out[-1])
            left -= self.used
        self.at += size
        return b"".join(out)

    def skip(self, size: int) -> None:
        here = min(size, len(self.block) - self.used)
        self.used += here
        if size > here:
            self.block, self.used = b"", 0
            self.pass_over(size - here)
        self.at += size


class _Unpacked(_Bytes):
    """Bytes of the members of a gzip file, one after another; zero bytes behind a member are padding."""

    def __init__(self, file, at: int = 0) -> None:
        super().__init__(file, at)
        self.packed, self.member = b"", None

    def fetch(self) -> bytes:
        while True:
            if self.member is not None and self.member.eof:
                self.packed, self.member = self.member.unused_data, None
            if not self.packed:
                self.packed = self.file.read(_BLOCK)
            if self.member is None:
                self.packed = self.packed.lstrip(b"\0")
                if not self.packed:
                    if self.file.tell() >= self.file.size():
                        return b""
                    continue
                self.member = zlib.decompressobj(31)
            elif not self.packed:
                raise ValueError("a gzip member is cut off")
            out = self.member.decompress(self.packed, _BLOCK)
            self.packed = self.member.unconsumed_tail
            if out:
                return out

    def pass_over(self, size: int) -> None:
        while size:
            more = self.fetch()
            if not more:
                raise ValueError(f"the record's block at {self.at} is cut off")
            self.block, self.used = more, min(size, len(more))
            size -= self.used


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


@dataclass
class _Written(WriterCommitMessage):
    files: list[tuple[str, list[int]]]  # name; places of stretches, the file's size last


@dataclass
class _Stretch(InputPartition):
    path: str
    begin: int
    end: int


class _Writer(DataSourceArrowWriter):
    """Each task writes files of its own; only those named in the manifest of the commit are part of the archive."""

    def __init__(self, path: str, file_bytes: int, split_bytes: int) -> None:
        self.path, self.file_bytes, self.split_bytes = path.rstrip("/"), file_bytes, split_bytes

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, root = _open(self.path)
        store.create_dir(root, recursive=True)
        files, out, name, size, places = [], None, "", 0, []
        for batch in batches:
            columns = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}
            for i in range(batch.num_rows):
                fields = {field: columns[c][i] for c, field in COLUMNS.items()}
                fields[FULL_LENGTH] = str(fields[FULL_LENGTH] or 0)
                if fields[TYPE] == "revisit":
                    fields[PROFILE] = SAME_PAYLOAD
                raw = record(fields, columns["payload"][i] or b"")
                if out is None:
                    name, size, places = f"part-{uuid.uuid4().hex}.warc", 0, [0]
                    out = store.open_output_stream(f"{root}/{name}")
                if size - places[-1] >= self.split_bytes:
                    places.append(size)
                out.write(raw)
                size += len(raw)
                if size >= self.file_bytes:
                    out.close()
                    files.append((name, [*places, size]))
                    out = None
        if out is not None:
            out.close()
            files.append((name, [*places, size]))
        return _Written(files)

    def commit(self, messages) -> None:
        store, root = _open(self.path)
        store.create_dir(root, recursive=True)
        listed = sorted(f for m in messages if m for f in m.files)
        with store.open_output_stream(f"{root}/manifest.json") as out:
            out.write(json.dumps(listed).encode())

    def abort(self, messages) -> None:
        """Files without a manifest are never read."""


class _Reader(DataSourceReader):
    def __init__(self, path: str, payload: bool) -> None:
        self.path, self.payload = path.rstrip("/"), payload
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            if isinstance(f, EqualTo) and len(f.attribute) == 1 and f.attribute[0] in COLUMNS and f.value is not None:
                values = {f.value}
            elif isinstance(f, In) and len(f.attribute) == 1 and f.attribute[0] in COLUMNS:
                values = set(f.value)
            else:
                yield f
                continue
            column = f.attribute[0]
            self.wanted[column] = self.wanted.get(column, values) & values

    def partitions(self):
        store, root = _open(self.path)
        if store.get_file_info(f"{root}/manifest.json").type == fs.FileType.File:
            with store.open_input_stream(f"{root}/manifest.json") as file:
                listed = json.loads(file.read())
        elif store.get_file_info(root).type == fs.FileType.File:
            return [_Stretch(self.path, 0, store.get_file_info(root).size)]
        else:
            found = [f for f in store.get_file_info(fs.FileSelector(root)) if f.base_name[0] not in "_."]
            other = sorted(f.base_name for f in found if not f.base_name.lower().endswith((".warc", ".warc.gz")))
            if other:
                raise ValueError(f"not WARC files: {', '.join(other[:10])}")
            listed = [(f.base_name, [0, f.size]) for f in found]
        return [
            _Stretch(f"{self.path}/{name}", begin, end)
            for name, places in listed for begin, end in zip(places, places[1:], strict=False)
        ] or [_Stretch("", 0, 0)]

    def read(self, partition):
        """The stretch's records, headers first."""
        if not partition.path:
            return
        store, path = _open(partition.path)
        names = list(COLUMNS)
        kinds = [pa.int64() if n == "payload_length" else pa.string() for n in names] + [pa.binary()]
        fields_of = [COLUMNS[n].lower() for n in names]
        packed = path.lower().endswith(".gz")
        rows, held = [], 0
        with store.open_input_file(path) as file:
            stream = _Unpacked(file) if packed else _Bytes(file, partition.begin)
            while True:
                at = stream.at
                line = stream.line()
                if not line or (at >= partition.end and not packed):
                    break
                if not line.strip():
                    continue
                if not line.startswith(b"WARC/"):
                    raise ValueError(f"{partition.path}: no record begins at {at}")
                lines = []
                while (line := stream.line()).strip():
                    lines.append(line)
                fields = parse_head(lines)
                if not line or not fields.get(LENGTH.lower(), "").isdigit():
                    raise ValueError(f"{partition.path}: the record at {at} has no whole header")
                size = int(fields[LENGTH.lower()])
                row = [fields.get(f) for f in fields_of]
                row[-1] = int(row[-1]) if (row[-1] or "").isdigit() else size
                passes = all(row[names.index(c)] in values for c, values in self.wanted.items())
                if not passes or not self.payload:
                    stream.skip(size)
                if passes:
                    rows.append((*row, stream.read(size) if self.payload else None))
                    held += size * self.payload + 200
                    if held >= 4 << 20:
                        yield _batch(rows, names, kinds)
                        rows, held = [], 0
        if rows:
            yield _batch(rows, names, kinds)


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[*names, "payload"])


class WarcSource(DataSource):
    """``spark.read.format("warc").load(folder)`` and ``df.write.format("warc").mode("append").save(folder)``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        options = self.options
        return _Reader(options["path"], options.get("payload", "true").lower() != "false")

    def writer(self, schema, overwrite) -> DataSourceArrowWriter:
        options = self.options
        return _Writer(options["path"], int(options.get("fileBytes", FILE_BYTES)),
                       int(options.get("splitBytes", SPLIT_BYTES)))


def register(spark: SparkSession) -> None:
    """Make the format known to the session and let it take filters."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def page_records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Records for ``pages`` (``page_id``, ``url``, ``html``) with repeated payloads as revisits.

    Of equal payloads of at least ``least_bytes`` bytes the one with the smallest page id is the response.
    A null html is an empty payload. The join by digest moves each payload once, deflated, and Spark splits a
    digest that many pages share. Rows with equal ids and payloads are one response each; a null id never refers.
    """
    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads = [x or b"" for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([zlib.compress(x, 1) for x in payloads], pa.binary()),
                pa.array(map(len, payloads), pa.int64()), pa.array(map(digest, payloads), pa.string()),
            ], names=["page_id", "url", "payload", "payload_length", "payload_digest"])

    narrow = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                          F.col("html").cast("string").cast("binary").alias("html"))
    known = narrow.mapInArrow(
        digests, "page_id long, url string, payload binary, payload_length long, payload_digest string")
    first = known.filter(F.col("payload_length") >= least_bytes).groupBy("payload_digest").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    joined = known.join(first, "payload_digest", "left")
    revisit = F.col("first") < F.col("page_id")
    if least_bytes:
        revisit &= F.col("payload_length") >= least_bytes
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("-")), F.lit(">"))
    is_revisit = F.coalesce(revisit, F.lit(False))

    def inflated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("payload")
            payloads = [None if x is None else zlib.decompress(x) for x in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(payloads, pa.binary()))

    records = joined.select(
        F.when(is_revisit, "revisit").otherwise("response").alias("record_type"), name("page_id").alias("record_id"),
        F.col("url").alias("uri"), F.lit("1970-01-01T00:00:00Z").alias("date"),
        F.concat(F.lit("sha1:"), "payload_digest").alias("payload_digest"),
        F.when(is_revisit, name("first")).alias("refers_to"), "payload_length",
        F.when(~is_revisit, F.col("payload")).alias("payload"))
    return records.mapInArrow(inflated, records.schema)


def write(records: DataFrame, folder: str, **options: int) -> None:
    register(records.sparkSession)
    records.write.format("warc").options(**options).mode("append").save(folder)


def read(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(folder)


def page_view(records: DataFrame) -> DataFrame:
    """What the headers of page records say, with ids as numbers and the bare digest."""
    number = lambda c: F.nullif(F.regexp_extract(c, "page:([0-9-]+)", 1), F.lit("-")).cast("long")
    return records.select(
        number("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"),
        F.substring_index("payload_digest", ":", -1).alias("payload_digest"), "record_type",
        number("refers_to").alias("refers_to"))


def checked(records: DataFrame) -> DataFrame:
    """The records, after comparing every payload that is there with its length and digest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index
            for kind, name, size, payload in zip(*(batch.column(at(c)).to_pylist() for c in (
                    "record_type", "payload_digest", "payload_length", "payload")), strict=True):
                if kind == "response" and (len(payload) != size or f"sha1:{digest(payload)}" != name):
                    raise ValueError(f"payload of {size} bytes does not have the digest {name}")
            yield batch

    return records.mapInArrow(run, records.schema)


def round_trip(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as an archive and return what reading it back gives, one row for each page."""
    write(page_records(pages, least_bytes), folder)
    back = read(pages.sparkSession, folder)
    return page_view(checked(back))
