import tracemalloc

import pyarrow as pa

from rideloom.llm import batches, tokens
from rideloom.llm.queries import BYTE_BPE


def test_only_the_texts_of_a_chunk_are_held():
    batch = pa.RecordBatch.from_arrays([pa.array(range(4000)), pa.array([f"{i} ".ljust(5000, "x") for i in range(4000)])], ["doc_id", "text"])
    tracemalloc.start()
    n = sum(len(texts) for _, texts in batches.text_chunks(iter([batch]), max_bytes=1 << 20))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 4000 and peak < 6 << 20  # 20 MB of text


def test_chunks_hold_every_row_in_order():
    texts = ["aé", None, "", "x" * 50, "b", "c" * 9, "d"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(texts)], ["doc_id", "text"])
    found = list(batches.text_chunks(iter([batch, batch.slice(3, 2), batch.slice(0, 0)]), max_bytes=10))
    assert [t for rows, part in found for t in part] == [(t or "").encode() for t in texts + texts[3:5]]
    assert [rows.column(0).to_pylist() for rows, _ in found] == [[0, 1, 2], [3], [4, 5], [6], [3], [4]]
    assert all(rows.num_rows == len(part) for rows, part in found)


def test_a_tokenizer_is_dropped_when_another_stage_reads(monkeypatch):
    stage = [7]
    monkeypatch.setattr(batches, "_stage", lambda: stage[0])
    batch = pa.RecordBatch.from_arrays([pa.array(["two words"])], ["text"])
    first = tokens.encoder(BYTE_BPE)
    list(batches.text_chunks(iter([batch])))
    assert tokens.encoder(BYTE_BPE) is first  # the next task of the same stage goes on with it
    stage[0] = 8
    list(batches.text_chunks(iter([batch])))
    assert first not in [x for kept in batches._KEPT.values() for x in kept.values()]
    assert tokens.encoder(BYTE_BPE)(["two words"]) == first(["two words"])
