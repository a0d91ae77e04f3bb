import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from rideloom.llm import quality
from rideloom.llm.queries import BYTE_BPE
from rideloom.workspace import cut_lineage
from tests.llm.test_decontaminate import in_order, normal
from tests.llm.test_minhash import roots, shingles
from tests.llm.test_pii import by_hand as spans_by_hand
from tests.llm.test_quality import by_hand as statistics_by_hand

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage got and gave."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = []
    for name, stage in corpus_pipeline.STAGES:
        after = cut_lineage(stage(spark, docs, FOLDER), name)
        out.append((name, docs, after))
        docs = after
    return {name: (before, after) for name, before, after in out}


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_and_columns(spark, stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == list(stages)
    schema = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    assert all(after.schema == schema for name, (_, after) in stages.items() if name != "packing")


def test_quality(spark, stages):
    before, after = map(texts, stages["quality"])
    failed = {d for d, t in before.items() for n, *_, r in [statistics_by_hand(t)] if n < 50 or 100 * r > 50 * n}
    assert failed and not failed & set(after) and len(after) > 0.5 * len(before)
    rated = quality.rate(stages["quality"][0], spark.read.parquet(f"{FOLDER}/labels.parquet")).filter("kept")
    assert {r.doc_id for r in rated.collect()} == set(after)


def test_near_duplicates(stages):
    before, after = map(texts, stages["near_duplicates"])
    sets = {d: shingles(t, 5) for d, t in before.items()}
    links = [(a, b) for a, b in combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert set(after) == set(roots(links, sets).values()) and len(after) < len(before)


def test_decontamination(spark, stages):
    before, after = map(texts, stages["decontamination"])
    items = [normal(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    copied = {d for d, t in before.items() if any(f" {' '.join(w)} " in f" {' '.join(normal(t))} " for w in items)}
    gone = set(before) - set(after)
    assert copied <= gone
    assert all(any(in_order(w, normal(before[d])) >= 0.6 * len(w) for w in items) for d in gone)


def test_personal_data(stages):
    before, after = map(texts, stages["personal_data"])
    assert set(before) == set(after)
    assert not any(spans_by_hand(t) for t in after.values())
    assert all(before[d] == after[d] for d in before if not spans_by_hand(before[d]))
    assert all(r.n_chars == len(r.text) for r in stages["personal_data"][1].collect() if before[r.doc_id] != r.text)


def test_packing_and_run(spark, stages):
    before, after = texts(stages["packing"][0]), stages["packing"][1].collect()
    library = Tokenizer.from_file(BYTE_BPE)
    total = 0
    for doc, text in before.items():
        ids = [*library.encode(text, add_special_tokens=False).ids, 1]
        pieces = sorted((r for r in after if r.doc_id == doc), key=lambda r: r.start)
        assert b"".join(r.ids for r in pieces) == np.array(ids, "<u4").tobytes()
        assert all(r.ids_crc32 == zlib.crc32(r.ids) for r in pieces)
        total += len(ids)
    sizes = Counter()
    for r in after:
        sizes[r.sequence_id] += r.length
    assert sorted(sizes) == list(range(-(-total // 2048))) and sorted(sizes.values())[1:] == [2048] * (len(sizes) - 1)
    whole = corpus_pipeline.run(spark, FOLDER)
    assert {(r.doc_id, r.start, r.ids_crc32) for r in whole.collect() if r.start == 0 and r.length == r.doc_tokens} <= {
        (r.doc_id, 0, zlib.crc32(np.array([*library.encode(before[r.doc_id], add_special_tokens=False).ids, 1],
                                          "<u4").tobytes())) for r in after}


def test_every_query_is_registered():
    from __spark_entry__ import queries

    names = [n for n in queries() if n.startswith("op") and n[2:3].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in queries()
