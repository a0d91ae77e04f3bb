import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from rideloom.llm import substrings
from rideloom.llm.queries import op2_substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(docs, window):
    words = [WORD.findall(t or "") for _, t in docs]
    count = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc, _), w in zip(docs, words, strict=True):
        gone = {i + k for i in range(len(w) - window + 1) if count[tuple(w[i : i + window])] > 1 for k in range(window)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_against_all_windows(spark, folder):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    df = op2_substrings(spark, folder)
    assert df.columns[:4] == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert sorted(map(tuple, df.collect()), key=str) == by_hand(docs, 35)


@pytest.mark.parametrize("window", [1, 2, 5])
def test_small_alphabets_and_edges(spark, window):
    random = np.random.default_rng(window)
    docs = [(i, " ".join(random.choice(list("abcdefgh"), random.integers(0, 14)))) for i in range(40)]
    docs += [(50, None), (51, ""), (52, " \n"), (1, docs[1][1]), (None, "q r s t u v w"), (53, "q  r\ns t u v w"),
             (54, "x " * 30), (55, "A a \x0b b"), (3, "other text of the id three")]
    df = spark.createDataFrame([(*d, 7) for d in docs], "doc_id long, text string, place int")
    got = substrings.repeated_windows(df.repartition(4), window)
    rows = got.collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows), key=str) == by_hand(docs, window)
    assert all(r.n_removed == sum(x.end - x.begin for x in r.removed) for r in rows)
    assert substrings.repeated_windows(df.limit(0), window).count() == 0


def test_intervals():
    assert substrings.intervals(np.array([9, 0, 1, 30]), 5) == [(0, 6), (9, 14), (30, 35)]
    assert substrings.intervals(np.array([0, 5]), 5) == [(0, 10)]


def test_rolling_hashes_are_equal_for_equal_windows_only():
    words = np.array([3, 1, 4, 1, 5, 9, 3, 1, 4, 1], np.uint64)
    got = substrings.RollingHashes().of(words, 4)
    assert got[0] == got[6] and len(set(got.tolist())) == 6


def test_very_long_texts(spark):
    random = np.random.default_rng(9)
    long = " ".join(f"w{random.integers(0, 50_000)}" for _ in range(150_000))
    docs = [(1, long), (2, "x" * 1_000_000), (3, " ".join(long.split()[-60:]) + " end"), (4, "same " * 50_000)]
    rows = substrings.repeated_windows(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_words, r.n_removed) for r in rows} == {1: (150_000, 60), 2: (1, 0), 3: (61, 60), 4: (50_000, 50_000)}
