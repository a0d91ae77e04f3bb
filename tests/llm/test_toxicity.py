import re
import time
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rideloom.llm import toxicity as tox
from rideloom.llm.queries import op9_toxicity


def by_hand(a, b):
    def profile(word):
        out = defaultdict(float)
        for i, j, k in combinations(range(len(word)), 3):
            if k - i < tox.SPAN:
                out[word[i], word[j], word[k]] += tox.DECAY ** (k - i + 1)
        return out

    p, q = profile(a), profile(b)
    dot = sum(v * q[u] for u, v in p.items() if u in q)
    norm = (sum(v * v for v in p.values()) * sum(v * v for v in q.values())) ** 0.5
    return (dot / norm) ** 2 if norm else 0.0


def test_kernel_against_all_subsequences():
    marks, words = ["idiot", "worthless", "banana"], ["idiot", "idiots", "idxiot", "ban", "wo", "", "anana", "less"]
    got = tox.Kernel(marks).raw(words)
    assert np.allclose(got, [[by_hand(w, m) for m in marks] for w in words])


def test_inserted_and_spaced_letters_stay_near():
    kernel = tox.Kernel(["idiot"])
    for text in ("you id.iot", "you i d i o t there", "i.d.i.o.t!", "qwerzuplkjhgfsa" * 40 + "idiot" + "bnmcvxyqwe" * 40):
        assert len(tox.sentence_values([text], kernel)[0]) > 0, text
    assert len(tox.sentence_values(["a plain text", ""], kernel)[0]) == 0


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    model = tox.fit(docs, labels)
    rows = tox.score(docs.join(labels, "doc_id"), model).join(labels, "doc_id").collect()
    toxic = [r.predicted for r in rows if tox.is_held_out(r.doc_id) and r.toxic == 1]
    clean = [r.predicted for r in rows if tox.is_held_out(r.doc_id) and r.toxic == 0]
    assert np.mean(toxic) >= 0.75 and np.mean(clean) <= 0.03


def test_query_columns(spark):
    rows = op9_toxicity(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 1000 and {0 <= r.score <= 1 for r in rows} == {True}
    assert all(r.held_out == tox.is_held_out(r.doc_id) and r.predicted == (r.score >= 0.3) for r in rows)


def test_only_the_text_is_used(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = tox.Model(["idiot", "scum"], np.eye(2), np.ones(2), -0.5)
    one = {r.doc_id: r.score for r in tox.score(docs, model).collect()}
    other = docs.selectExpr("doc_id", "text", "'x' as lang", "reverse(source) as source", "0 as score")
    assert {r.doc_id: r.score for r in tox.score(other, model).collect()} == one


def test_edges(spark):
    schema = "doc_id long, text string, predicted int"
    docs = spark.createDataFrame([(1, None, 0), (1, "", 0), (2, "idiot", 0), (2, "idiot", 0), (None, "x", 0)], schema)
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 1)], "doc_id long, toxic int")
    model = tox.fit(docs, labels)
    assert model.landmarks == [] and len({r.score for r in tox.score(docs, model).collect()}) == 1
    assert tox.score(docs.limit(0), model).count() == 0
    trained = tox.Model(["idiot"], np.eye(1), np.array([4.0]), -2.0)
    scores = [(r.doc_id, r.predicted) for r in tox.score(docs, trained).collect()]
    assert sorted(scores, key=str) == [(1, 0), (1, 0), (2, 1), (2, 1), (None, 0)]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a.!?\n \t", max_size=30))
def test_sentences_end_as_the_plain_pattern_says(text):
    plain = re.compile(r"[.!?\n]+[\x20\x09-\x0D]+|\n")
    assert tox._END.split(text) == plain.split(text)


@pytest.mark.parametrize("text", ["." * 1_000_000 + "x", "a" * 1_000_000, "語" * 1_000_000, "!\n" * 500_000 + "x"])
def test_very_long_texts_are_split_in_linear_time(text):
    begin = time.perf_counter()
    tox._END.split(text)
    assert time.perf_counter() - begin < 2


def test_sentences_give_the_nearest_words_and_are_not_searched_again_for_spaced_letters(monkeypatch):
    kernel = tox.Kernel(["idiot", "stupid"])
    texts = ["", "You idiot. You st-upid idiots!\nA fine day. " * 20, "An i d i o t. Nice, i.d.i.o.t\nstupid", "all fine"]
    plain = []
    kernel.learn(set().union(*map(tox.words_of, texts)))
    for text in texts:
        found = [[kernel.cache[w] for w in tox.words_of(s) if kernel.cache.get(w) is not None] for s in tox.sentences(text)]
        plain.append([np.max(v, axis=0) for v in found if v])
    searched = []

    class Counted:
        def finditer(self, text, spaced=tox._SPACED):
            searched.append(text)
            return spaced.finditer(text)

    monkeypatch.setattr(tox, "_SPACED", Counted())
    rows = tox.sentence_values(texts, kernel)
    assert [r.tolist() for r in rows] == [[v.tolist() for v in p] for p in plain] and [len(r) for r in rows] == [0, 40, 3, 0]
    assert len(searched) == len(texts) + 3  # only the third text has spaced letters, so only its sentences are searched


def test_long_words_are_compared_together(monkeypatch):
    words = {f"idiot{'xyzw'[i % 4] * 3}stupid{'qvk'[i % 3] * 4}{'z' * (i % 40)}{i}" for i in range(600)} | {"y" * 9000 + "stupid"}
    alone = {}
    for w in words:
        kernel = tox.Kernel(["idiot", "stupid"])
        kernel.learn({w})
        alone[w] = kernel.cache[w]
    calls, real = [], tox.subsequences
    kernel = tox.Kernel(["idiot", "stupid"])
    monkeypatch.setattr(tox, "subsequences", lambda part: calls.append(len(part)) or real(part))
    kernel.learn(words)
    assert len(calls) < 10 < sum(len(w) > tox.STRETCH for w in words)
    assert kernel.near == {w for w, v in alone.items() if v is not None}
    assert all((kernel.cache[w] is None) if v is None else (kernel.cache[w] == v).all() for w, v in alone.items())
