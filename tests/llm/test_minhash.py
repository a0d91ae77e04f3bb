import re
from itertools import combinations

import numpy as np
import pytest

from rideloom.llm import minhash
from rideloom.llm.batches import WordHashes
from rideloom.llm.components import connected
from rideloom.llm.queries import op1_minhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def roots(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def by_hand(docs, size=2):
    """All pairs, without hashing."""
    sets = {d: shingles(t, size) for d, t in docs}
    links = [(a, b) for a, b in combinations(sets, 2) if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    root = roots(links, sets)
    return {(d, len(sets[d]), root[d], root[d] == d) for d in sets}


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_against_all_pairs(spark, folder):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    df = op1_minhash(spark, folder)
    assert df.columns[:4] == ["doc_id", "n_shingles", "component_id", "kept"]
    assert {tuple(r) for r in df.collect()} == by_hand(docs)


def chain(n):
    """Texts whose neighbours are near and whose ends are not."""
    return [" ".join(f"w{i}" for i in range(k, k + 60)) for k in range(0, 3 * n, 3)]


def test_chains_large_groups_and_edges(spark):
    random = np.random.default_rng(5)
    base = [f"b{i}" for i in range(120)]
    texts = [*chain(12), None, "", " \n", "one", "ONE", "One", "ÄB cd", "äB cd"]
    for _ in range(150):  # copies of one text, each with its own changes: some pairs are near, some are not
        words = list(base)
        for i in random.choice(120, random.integers(0, 9), replace=False):
            words[i] = f"x{random.integers(1e9)}"
        texts.append(" ".join(words))
    docs = [(i * 7 % 1009, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(d, t, 1, "k") for d, t in docs], "doc_id long, text string, key int, a string")
    got = {tuple(r) for r in minhash.near_duplicates(df.repartition(5), size=2).collect()}
    assert got == by_hand(docs)


def test_pivots_leave_nothing_out(spark, monkeypatch):
    monkeypatch.setattr(minhash, "FEW", 0)
    docs = list(enumerate(chain(10)))
    for rounds in (1, 3):
        monkeypatch.setattr(minhash, "PIVOT_ROUNDS", rounds)
        df = spark.createDataFrame(docs, "doc_id long, text string")
        assert {tuple(r) for r in minhash.near_duplicates(df, size=2).collect()} == by_hand(docs)


def test_repeated_rows_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(5, "a b c"), (5, "a b c"), (3, "a b c"), (None, "a b c"), (1, "z")],
                               "doc_id long, text string")
    rows = sorted((tuple(r) for r in minhash.near_duplicates(df, size=2).collect()), key=str)
    assert rows == [(1, 1, 1, True), (3, 2, 3, True), (5, 2, 3, False), (5, 2, 3, False), (None, 2, None, False)]
    assert minhash.near_duplicates(df.limit(0)).count() == 0
    kept = minhash.keep_one(df, size=2)
    assert kept.schema == df.schema and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "None"]


def test_signature_estimates_similarity():
    hashes = WordHashes()
    a = " ".join(f"w{i}" for i in range(400)).encode()
    b = " ".join(f"w{i}" for i in range(60, 460)).encode()
    sets = [minhash.shingle_set(t, 2, hashes) for t in (a, b)]
    one, other = minhash.signatures(sets)
    assert abs((one == other).mean() - len(np.intersect1d(*sets)) / len(np.union1d(*sets))) < 0.15


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 103), (101, 103), (7, 7), (200, 200), (None, 4)]
    got = {r.node: r.component for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 103: 100, 200: 200}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_clouds_of_variants(spark):
    """Texts changed here and there: some near the one they come from, some near each other only, two clouds in one bucket."""
    random = np.random.default_rng(12)
    words = [f"w{i}" for i in range(90)]
    far = [w if i % 9 else f"v{i}" for i, w in enumerate(words)]
    docs = []
    for k in range(120):
        text = list(far if k % 3 == 0 else words)
        for i in random.choice(90, random.integers(0, 9), replace=False):
            text[i] = random.choice(["", "x", f"u{k}-{i}"])
        docs.append((int(1000 + (k * 37) % 120), " ".join(filter(None, text))))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    want = by_hand(docs)
    assert {tuple(r) for r in minhash.near_duplicates(df, size=2).collect()} == want
    assert 3 < sum(r[3] for r in want) < 100


def test_very_long_texts(spark):
    random = np.random.default_rng(12)
    long = [f"w{random.integers(0, 10**9)}" for _ in range(100_000)]
    changed = [w if i % 100 else f"z{i}" for i, w in enumerate(long)]
    docs = [(1, " ".join(long)), (2, " ".join(changed)), (3, "x" * 1_000_000), (4, "same " * 50_000), (5, " ".join(long[:50_000]))]
    rows = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), size=2).collect()
    assert {r.doc_id: r.component_id for r in rows} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5}
    assert {r.doc_id: r.n_shingles for r in rows if r.doc_id in (3, 4)} == {3: 1, 4: 1}
