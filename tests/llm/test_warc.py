import base64
import gzip
import hashlib
import io

import pyarrow as pa
import pytest

from rideloom.llm import warc
from rideloom.llm.queries import op7_warc
from rideloom.workspace import fresh_folder


def by_hand(pages, least=0):
    first = {}
    for page, html in pages:
        raw = (html or "").encode()
        if len(raw) >= least:
            first[raw] = min(first.get(raw, page), page)
    out = []
    for page, html in pages:
        raw = (html or "").encode()
        again = len(raw) >= least and first[raw] < page
        out.append((page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                    "revisit" if again else "response", first[raw] if again else None))
    return sorted(out)


def test_query_on_the_small_table(spark, sf_dir):
    pages = [(r.page_id, r.html) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    df = op7_warc(spark, sf_dir)
    assert df.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, df.collect())) == by_hand(pages)


TRICKY = [(1, "a", None), (2, "b\r\nX: y", ""), (3, None, "x"), (9, "u", "x"), (4, "u", "\r\n\r\nWARC/1.1\r\n\r\n"),
          (5, "u", "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"), (6, "ü", "ü" * 70_000), (7, "u", "x")]


@pytest.fixture(params=[{}, {"splitBytes": 1}, {"splitBytes": 500, "fileBytes": 900}])
def archive(spark, request):
    df = spark.createDataFrame([(*t, 1) for t in TRICKY], "page_id long, url string, html string, payload int")
    folder = fresh_folder(spark, "warc-test")
    warc.write(warc.page_records(df.repartition(2)), folder, **request.param)
    return folder


def test_any_split_gives_every_record_once(spark, archive):
    rows = warc.page_view(warc.checked(warc.read(spark, archive))).collect()
    assert sorted(map(tuple, rows)) == by_hand([(p, h) for p, _, h in TRICKY])
    store, root = warc._open(archive)
    store.delete_file(f"{root}/manifest.json")
    assert warc.read(spark, archive).count() == len(TRICKY)


def test_filters_are_pushed_and_payloads_left_unread(spark, archive):
    df = warc.read(spark, archive).filter("record_type = 'revisit'")
    assert "= revisit" not in df._jdf.queryExecution().executedPlan().toString()
    assert df.count() == 3 and df.filter("uri in ('u', 'z')").count() == 2
    assert {r.payload for r in warc.read(spark, archive, payload=False).collect()} == {None}


def test_least_bytes(spark):
    pages = [(1, "ab"), (2, "ab"), (3, "abcd"), (4, "abcd"), (5, None), (6, "")]
    df = spark.createDataFrame([(p, "u", h) for p, h in pages], "page_id long, url string, html string")
    rows = warc.round_trip(df, fresh_folder(spark, "warc-test"), least_bytes=3).collect()
    assert sorted(map(tuple, rows)) == by_hand(pages, 3)


def test_empty_table_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, None, "a"), (None, "u", "a")],
                               "page_id long, url string, html string")
    rows = warc.round_trip(df, fresh_folder(spark, "warc-test")).collect()
    assert sorted((str(r.page_id), r.record_type) for r in rows) == [
        ("1", "response"), ("1", "response"), ("None", "response")]
    assert warc.round_trip(df.limit(0), fresh_folder(spark, "warc-test")).count() == 0


def test_files_without_a_commit_are_not_read(spark, archive):
    store, root = warc._open(archive)
    with store.open_output_stream(f"{root}/part-lost.warc") as out:
        out.write(warc.record({warc.TYPE: "response"}, b"half"))
    assert warc.read(spark, archive).count() == len(TRICKY)


FOREIGN = [
    b"WARC/1.0\r\nwarc-type: warcinfo\r\nCONTENT-LENGTH: 5\r\n\r\nabcde\r\n\r\n",
    b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: http://a.example/\r\n  long\r\nWarc-Record-Id: <urn:x:1>\r\n"
    b"Content-Length: 41\r\n\r\nHTTP/1.1 200 OK\r\n\r\nWARC/1.1\r\n\r\nbody 12345\r\n\r\n",
    b"WARC/1.1\nWARC-Type: request\nContent-Length: 0\n\n\r\n\r\n",
    b"WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: 3000000\r\n\r\n" + b"z\r\n" * 1_000_000 + b"\r\n\r\n",
]
SAID = [("request", None, 0), ("resource", None, 3_000_000), ("response", "http://a.example/ long", 41), ("warcinfo", None, 5)]


def foreign(spark, files):
    folder = fresh_folder(spark, "warc-test")
    store, root = warc._open(folder)
    store.create_dir(root, recursive=True)
    for name, content in files.items():
        with store.open_output_stream(f"{root}/{name}", compression=None) as out:
            out.write(content)
    return folder


FORMS = {
    "a.warc": b"".join(FOREIGN),
    "b.warc.gz": b"".join(map(gzip.compress, FOREIGN)),
    "c.WARC.GZ": gzip.compress(b"".join(FOREIGN)) + b"\0" * 600,
}


@pytest.mark.parametrize("name", FORMS)
def test_archives_of_other_writers(spark, name):
    folder = foreign(spark, {name: FORMS[name], "_SUCCESS": b"", "empty.warc": b""})
    for place in (folder, f"{folder}/{name}"):
        rows = warc.read(spark, place).collect()
        assert sorted((r.record_type, r.uri, r.payload_length) for r in rows) == SAID
        assert all(len(r.payload) == r.payload_length for r in rows)
        assert warc.read(spark, place).filter("record_type = 'response'").first().payload.endswith(b"body 12345")
        bare = warc.read(spark, place, payload=False).collect()
        assert sorted((r.record_type, r.uri, r.payload_length) for r in bare) == SAID


@pytest.mark.parametrize("name, content", [
    ("a.warc", FORMS["a.warc"][:-10]), ("a.warc", b"hello\r\n"), ("a.warc", b"WARC/1.0\r\nWARC-Type: response\r\n\r\n"),
    ("b.warc.gz", FORMS["b.warc.gz"][:-30]), ("notes.txt", b"x"), ("a.warc", b"WARC/1.0\r\nContent-Length: 5"),
])
def test_what_is_no_archive_is_an_error(spark, name, content):
    with pytest.raises(Exception, match="cut off|no record|no whole header|not WARC files"):
        warc.read(spark, foreign(spark, {name: content})).collect()


@pytest.mark.parametrize("block", [8, 16, 1 << 20])
def test_streams_at_any_block_size(monkeypatch, block):
    monkeypatch.setattr(warc, "_BLOCK", block)
    content = b"ab\n" + b"x" * 40 + b"\nlast"
    for packed in (False, True):
        raw = gzip.compress(content[:20]) + gzip.compress(content[20:]) if packed else content
        file = pa.PythonFile(io.BytesIO(raw), mode="r")
        stream = (warc._Unpacked if packed else warc._Bytes)(file)
        assert stream.line() == b"ab\n"
        stream.skip(30)
        assert stream.read(11) == b"x" * 10 + b"\n" and stream.at == 44
        assert stream.line() == b"last" and stream.line() == b""
