import hashlib
import re
import zlib

import numpy as np
import pytest

from rideloom.llm import runs
from rideloom.llm.queries import op11_runs, with_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def runs_by_hand(w, least=12):
    """All maximal stretches of every period, the smallest period of each kept."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed_by_hand(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def planted(doc_id, text):
    w = WORD.findall(text or "")
    if doc_id is None:
        return w
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    g = h // 10
    if h % 10 == 0 and n > 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    return w


def words_of(text):
    return runs.Sequence([t.encode().split() for t in text])


def listed(texts, least):
    words = words_of(texts)
    out = [[] for _ in texts]
    for s, n, q in runs.find_runs(words, least).tolist():
        i = int(words.document[s])
        out[i].append((s - int(words.begin[i]), n, q))
    return [sorted(x) for x in out]


@pytest.mark.parametrize("seed", range(12))
@pytest.mark.parametrize("least", [1, 2, 5, 12])
def test_runs_against_all_periods(seed, least):
    random = np.random.default_rng(seed)
    letters = list("abcd")[: 1 + seed % 4]
    texts = []
    for _ in range(30):
        piece = list(random.choice(letters, random.integers(1, 30)))
        kind = random.integers(0, 4)
        w = list(random.choice(letters, random.integers(0, 60)))
        if kind:
            w += piece * int(random.integers(2, 6)) + piece[: random.integers(0, len(piece) + 1)]
        if kind == 2:
            w += list(random.choice(letters, random.integers(0, 10))) + piece * 3
        if kind == 3:
            w += [letters[0]] * int(random.integers(1, 50)) + [letters[-1]] + [letters[0]] * int(random.integers(1, 50))
        texts.append(" ".join(w))
    texts += ["", texts[0], texts[0]]
    assert listed(texts, least) == [sorted(runs_by_hand(t.split(), least)) for t in texts]


@pytest.mark.parametrize("text", [
    "ab " * 40 + "ba " * 40,
    ("a " * 30 + "b ") * 6,
    "a b " * 40 + "b a " * 40,
    "a b c a b c d " * 9 + "a b c " * 11,
    " ".join("abaab"[i % 5] for i in range(90)) + " " + " ".join("baaba"[i % 5] for i in range(83)),
])
def test_runs_inside_runs(text):
    assert listed([text], 12) == [sorted(runs_by_hand(text.split(), 12))]


def test_fibonacci_words():
    a, b = ["x"], ["x", "y"]
    while len(b) < 900:
        a, b = b, b + a
    assert listed([" ".join(b)], 12) == [sorted(runs_by_hand(b, 12))]


def test_seeds_stay_in_proportion():
    for text in (b"a " * 200_000, b"a b " * 60_000 + b"b a " * 60_000, b"a " * 100_000 + b"b " + b"a " * 100_000):
        words = runs.Sequence([text.split()])
        assert len(runs.find_runs(words)) >= 1


def by_hand(docs, least=12):
    out = []
    for doc, text in docs:
        w = planted(doc, text)
        found = sorted(runs_by_hand(w, least), key=lambda r: (r[0], r[2]))
        best = min(((-n, s, q) for s, n, q in found), default=None)
        top = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        out.append((doc, len(found), *top, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(collapsed_by_hand(w, found))))
    return sorted(out, key=str)


def test_query_against_all_periods(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    docs = [d for d in docs if len((d[1] or "").split()) < 1500]
    df = op11_runs(spark, sf_dir)
    assert df.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    ids = {d for d, _ in docs}
    assert sorted((tuple(r) for r in df.collect() if r.doc_id in ids), key=str) == by_hand(docs)


def test_edges(spark):
    docs = [(1, None), (2, ""), (None, "k " * 13), (3, " \n\t"), (4, "k " * 13), (4, "k " * 13), (5, "é ü " * 7), (6, "x " * 11),
            (30, " ".join(str(i) for i in range(50))), (None, None)]
    docs += [(i, f"q{i} " + "w v u " * 5) for i in range(50, 120)]
    df = spark.createDataFrame([(*d, "mine", 1) for d in docs], "doc_id long, text string, runs string, n_words int").repartition(3)
    again = with_repeats(df)
    assert sorted(((r.doc_id, r.text.split() if r.text else []) for r in again.collect()), key=str) == sorted(
        ((d, planted(d, t)) for d, t in docs), key=str)
    got = runs.periodic_runs(df, least=12)
    assert got.columns == ["doc_id", "text", "n_words", "runs", "collapsed"]
    want = [(d, len((t or "").split()), (f := sorted(runs_by_hand((t or "").split()), key=lambda r: (r[0], r[2]))),
             collapsed_by_hand((t or "").split(), f)) for d, t in docs]
    assert sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got.collect()), key=str) == sorted(want, key=str)
    assert runs.periodic_runs(df.limit(0)).count() == 0


def test_very_long_text(spark):
    text = " ".join(f"w{i}" for i in range(150_000)) + " p q r" * 100_000
    (row,) = runs.periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [tuple(r) for r in row.runs] == [(150_000, 300_000, 3)] and row.n_words == 450_000
