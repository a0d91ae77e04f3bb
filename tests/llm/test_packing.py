import tempfile
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rideloom.llm import packing
from rideloom.llm.batches import text_chunks
from rideloom.llm.packing import pack
from rideloom.llm.queries import BYTE_BPE, op3_packing
from rideloom.llm.tokens import Encoder


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE_BPE)


def expected(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("text", [
    "", " ", "\n", "a", " a", "\nab c", "a  b\n\n c   ", "don't I'm <|endoftext|> b", "a\tb  c", "日本 語　x",
    "x 123 4!!\n\n\nq ", "word " * 500, "x" * 3000,
])
def test_pieces_give_the_library_ids(library, text):
    got = np.frombuffer(Encoder(BYTE_BPE)([text, text])[1], "<u4").tolist()
    assert got == expected(library, text)[:-1]


def test_other_tokenizer_files_are_encoded_whole():
    path = public_tokenizers.path("word_bpe_49k.json")
    text = "Some words, and more  words"
    assert np.frombuffer(Encoder(path)([text])[0], "<u4").tolist() == Tokenizer.from_file(path).encode(
        text, add_special_tokens=False).ids


def check(rows, texts, library, length):
    rows = sorted(rows, key=lambda r: (r["sequence_id"], r["offset"]))
    at = 0
    for r in rows:  # gapless: every sequence is filled before the next one begins
        assert (r["sequence_id"], r["offset"]) == (at // length, at % length)
        assert r["length"] > 0 and r["offset"] + r["length"] <= length
        at += r["length"]
    for doc, text in texts:
        ids = expected(library, text)
        mine = sorted((r for r in rows if r["doc_id"] == doc), key=lambda r: r["start"])
        assert sum(r["length"] for r in mine) == len(ids)
        for r in mine:
            raw = np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(raw) and r["doc_tokens"] == len(ids)
    return rows


def test_query_on_the_small_table(spark, sf_dir, library):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    df = op3_packing(spark, sf_dir)
    assert df.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    check(df.collect(), texts, library, 2048)


def test_nulls_empty_texts_long_texts_and_other_columns(spark, library):
    texts = [(1, None), (2, ""), (3, "the one " * 3000), (4, "short")]
    docs = spark.createDataFrame([(*t, 5, "x") for t in texts], "doc_id long, text string, part int, ids string")
    rows = check(pack(docs.repartition(3), BYTE_BPE, length=128).collect(), texts, library, 128)
    total = sum(r["length"] for r in rows)
    assert {r["padded_length"] for r in rows if r["sequence_id"] < total // 128} <= {128}


def test_repeated_rows_keep_their_own_pieces(spark):
    docs = spark.createDataFrame([(7, "abc"), (7, "abc"), (None, "abc")], "doc_id long, text string")
    rows = pack(docs, BYTE_BPE).collect()
    assert [r["doc_id"] for r in rows].count(7) == 2 and len(rows) == 3
    assert len({r["offset"] for r in rows}) == 3


def test_last_sequence_at_a_power_of_two_is_not_padded(spark):
    docs = spark.createDataFrame([(1, ""), (2, ""), (3, ""), (4, "")], "doc_id long, text string")
    assert {r["padded_length"] for r in pack(docs, BYTE_BPE, length=16).collect()} == {4}
    three = docs.filter("doc_id < 4")
    assert {r["padded_length"] for r in pack(three, BYTE_BPE, length=16).collect()} == {16}


def test_empty_table(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string"), BYTE_BPE).count() == 0


def test_pieces_are_cut_a_few_texts_at_a_time(spark, monkeypatch):
    def chunks(batches, column="text", max_bytes=1 << 10):
        for rows, found in text_chunks(batches, column, max_bytes):
            with open(marks, "a") as file:
                file.write(f"{column} {len(found)}\n")
            yield rows, found

    with tempfile.NamedTemporaryFile() as file:
        marks = file.name
        monkeypatch.setattr(packing, "text_chunks", chunks)
        docs = spark.createDataFrame([(i, "some words " * 40) for i in range(60)], "doc_id long, text string").coalesce(1)
        pieces = packing.pack(docs, BYTE_BPE, end_id=1, length=64).collect()
        seen = [line.split() for line in open(marks)]
    assert sum(p.length for p in pieces) == sum({p.doc_id: p.doc_tokens for p in pieces}.values())
    cut = [int(n) for column, n in seen if column == "ids"]
    assert sum(cut) == 60 and max(cut) < 60


def test_pieces_end_at_punctuation_and_at_runs_of_blanks():
    texts = [
        "One two, two. two; (two) two\n\n  two\n two! it's it's, rock'n'roll x'standard a-b_c 3,5 v2.0 e.g.\n",
        "  lead\n", " ", "\n \n", "", "end  ", "na\u00efve, caf\u00e9. \u6f22\u5b57, \u6f22\u5b57\u3002 a\u00a0b \u2014 c\u0301.d",
        "tab\tand, more", "<|endoftext|> two, <|endoftext", "|> two", "\"two,\" two...", "a\n\n\nb", ",", "\x01,a\x1f,",
    ]
    library, ours = Tokenizer.from_file(BYTE_BPE), Encoder(BYTE_BPE)
    for part in (texts, texts[::-1], [t.encode() for t in texts], texts[3:4], texts[:1] * 3):
        got = [np.frombuffer(x, "<u4").tolist() for x in ours(part)]
        assert got == [library.encode(t if isinstance(t, str) else t.decode(), add_special_tokens=False).ids for t in part]
    words = Encoder(BYTE_BPE)
    words(["x one, two. one. two, one; two; one! two!"])
    assert len(words.pieces) == 7  # the head, each word once, the marks


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab Z\n.,'\"st1\t\u00e9\u00a0\u6f22\U0001f600-") | st.characters(codec="utf-8"), max_size=30), max_size=6))
def test_ids_are_those_of_the_library(texts):
    got = [np.frombuffer(x, "<u4").tolist() for x in _KEPT(texts)]
    assert got == [x.ids for x in _LIBRARY.encode_batch(texts, add_special_tokens=False)]


_KEPT, _LIBRARY = Encoder(BYTE_BPE), Tokenizer.from_file(BYTE_BPE)
