import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rideloom.llm import coder, idfiles
from rideloom.llm.coder import decode, encode
from rideloom.llm.queries import BYTE_BPE, op8_token_files
from rideloom.workspace import fresh_folder


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 65535) | st.integers(0, 3), max_size=60), max_size=6))
def test_blocks_come_back(blocks):
    arrays = [np.array(b, np.int64) for b in blocks]
    back = decode(encode(arrays), [len(a) for a in arrays])
    assert [b.tolist() for b in back] == blocks


def test_long_and_repeating_blocks_come_back_smaller():
    random = np.random.default_rng(3)
    arrays = [np.tile(random.integers(0, 50000, 50), 80), random.zipf(1.3, 4096) % 50000, np.full(4096, 65535)]
    payloads = encode(arrays)
    assert all((a == b).all() for a, b in zip(arrays, decode(payloads, [len(a) for a in arrays]), strict=True))
    assert len(payloads[0]) < 1000 and len(payloads[2]) < 200 and len(payloads[1]) < 2 * 4096
    with pytest.raises(ValueError):
        encode([np.array([70_000])])


def test_an_id_takes_two_steps_of_the_coder_at_most(monkeypatch):
    random = np.random.default_rng(5)
    arrays = [random.zipf(1.2, 300) % 50000 for _ in range(20)]
    for side in (coder._Out, coder._In):
        calls, narrow = [], side.narrow
        monkeypatch.setattr(side, "narrow", lambda *a, calls=calls, narrow=narrow: calls.append(1) or narrow(*a))
        payloads = encode(arrays) if side is coder._Out else payloads
        if side is coder._In:
            assert all((a == b).all() for a, b in zip(arrays, decode(payloads, [300] * 20), strict=True))
        assert 300 < len(calls) <= 600


def test_rare_ids_are_not_dear():
    random = np.random.default_rng(6)
    for payload in encode([random.zipf(1.3, 4096) % 50000 for _ in range(8)]):
        assert len(payload) < 4450


def test_blocks_are_independent_and_large_ones_come_back():
    random = np.random.default_rng(7)
    arrays = [random.integers(0, 9, 900), random.integers(0, 65536, 2000), np.array([65535]), np.arange(17_000)]
    payloads = encode(arrays)
    assert payloads == [encode([a])[0] for a in arrays]
    for a, payload in zip(arrays, payloads, strict=True):
        assert (decode([payload], [len(a)])[0] == a).all()


def by_hand(docs, end):
    library, out, start = Tokenizer.from_file(BYTE_BPE), [], 0
    for doc, text in sorted(docs, key=lambda d: d[0]):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, end]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_on_the_small_table(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    df = op8_token_files(spark, sf_dir)
    assert df.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, df.collect())) == by_hand(docs, 2)


def test_edges_and_documents_over_many_blocks_and_files(spark, monkeypatch):
    docs = [(5, None), (2, ""), (9, "the one " * 4000), (3, "short # text"), (-4, "x y")]
    df = spark.createDataFrame([(*d, 1, b"z") for d in docs], "doc_id long, text string, part int, ids binary")
    folder = fresh_folder(spark, "ids-test")
    idfiles.write(df.repartition(3), folder, BYTE_BPE, 2)
    rows = sorted(idfiles.read(spark, folder).collect())
    assert [tuple(r)[:4] for r in rows] == by_hand(docs, 2)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in rows)
    again = fresh_folder(spark, "ids-test")
    twice = df.filter("doc_id = 3").union(df.filter("doc_id = 3")).union(df.limit(1).selectExpr(
        "cast(null as long)", "'q'", "part", "ids"))
    idfiles.write(twice, again, BYTE_BPE, 2)
    assert sorted((str(r.doc_id), r.start) for r in idfiles.read(spark, again).collect()) == [
        ("3", 2), ("3", 6), ("None", 0)]
    empty = fresh_folder(spark, "ids-test")
    idfiles.write(df.limit(0), empty, BYTE_BPE, 2)
    assert idfiles.read(spark, empty).count() == 0


def test_small_files_and_groups(monkeypatch):
    monkeypatch.setattr(idfiles, "BLOCK_IDS", 10)
    docs = [(1, np.arange(25)), (None, np.arange(3)), (2, np.arange(12))]
    blocks = list(idfiles._blocks(iter(docs)))
    assert [len(b.ids) for b in blocks] == [10, 10, 10, 10]
    back = idfiles.blocks_of(b"".join(idfiles.block_bytes(blocks)))
    assert [b.entries for b in back] == [[tuple(e) for e in b.entries] for b in blocks]


def test_a_changed_byte_is_noticed():
    raw = bytearray(b"".join(idfiles.block_bytes(list(idfiles._blocks(iter([(1, np.arange(500))]))))))
    raw[-5] ^= 1
    with pytest.raises(ValueError):
        idfiles.blocks_of(bytes(raw))


def test_every_range_is_decoded_by_a_task_of_its_own(spark, monkeypatch):
    monkeypatch.setattr(idfiles, "TASK_BYTES", 4000)
    df = spark.range(120).select(F.col("id").alias("doc_id"), F.repeat(F.lit("one two "), 40).alias("text"))
    folder = fresh_folder(spark, "ids-test")
    parts = idfiles.write(df, folder, BYTE_BPE, 2).select("part").distinct().count()
    assert parts == 10
    back = idfiles.read(spark, folder).drop("ids").withColumn("task", F.spark_partition_id())
    rows = back.collect()
    assert len(rows) == 120 and len({r.task for r in rows}) == parts
