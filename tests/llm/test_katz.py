import os
import re
import zlib
from collections import Counter, defaultdict
from math import log10

import numpy as np
import pytest

from rideloom.llm import katz
from rideloom.llm.queries import op6_katz

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower) + [None]


class ByHand:
    """The same model with dictionaries, evaluated recursively token by token."""

    def __init__(self, texts):
        self.uni, self.pairs = Counter(), Counter()
        for t in texts:
            words = tokens(t)
            self.uni.update(words)
            self.pairs.update(zip(["<s>", *words], words, strict=False))
        self.n = sum(self.uni.values())
        d = katz.discounts(Counter(self.uni.values()))
        self.p1 = {w: d.get(c, 1.0) * c / self.n for w, c in self.uni.items()}
        known = sum(self.p1.values())
        self.unknown = max(1 - known, 0.5 / max(self.n, 1))
        self.p1 = {w: p * (1 - self.unknown) / known for w, p in self.p1.items()}
        d = katz.discounts(Counter(self.pairs.values()))
        self.kept, self.seen, self.total = defaultdict(dict), defaultdict(float), {}
        for (a, b), c in self.pairs.items():
            if c >= katz.LEAST_PAIR:
                self.kept[a][b] = d.get(c, 1.0) * c
                self.seen[a] += self.p1[b]
        for a, c in {**self.uni, "<s>": len(texts)}.items():
            self.total[a] = max(c, sum(self.kept[a].values()) + 0.5)

    def probability(self, word, context):
        kept = self.kept[context] if context in self.total else {}
        if word in kept:
            return kept[word] / self.total[context]
        uni = self.p1.get(word, self.unknown)
        if context not in self.total:
            return uni
        return (1 - sum(kept.values()) / self.total[context]) / (1 - self.seen[context]) * uni

    def score(self, text):
        words = tokens(text)
        base = sum(log10((self.uni[w] + 0.1) / (self.n + 0.1 * (len(self.uni) + 1))) for w in words)
        model = sum(log10(self.probability(b, a)) for a, b in zip(["<s>", *words], words, strict=False))
        return len(words), sum(self.uni[w] > 0 for w in words), base, model


def compare(rows, docs, model):
    assert len(rows) == len(docs)
    want = {d: model.score(t) for d, t in docs}
    for r in rows:
        n, known, base, score = want[r.doc_id]
        assert (r.n_tokens, r.n_known) == (n, known)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-9)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_against_dictionaries(spark, folder):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    held = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in docs}
    model = ByHand([t for d, t in docs if not held[d]])
    rows = op6_katz(spark, folder).collect()
    assert all(r.held_out == held[r.doc_id] and r.train_tokens == model.n for r in rows)
    compare(rows, docs, model)


def test_every_context_sums_to_one():
    random = np.random.default_rng(2)
    model = ByHand([" ".join(random.choice(list("aabbccddefgh"), 12)) for _ in range(60)])
    for context in [*model.total, "never seen"]:
        total = sum(model.probability(w, context) for w in model.p1) + model.probability("never seen", context)
        assert total == pytest.approx(1)


def test_heads_buckets_and_edges(spark, monkeypatch):
    random = np.random.default_rng(4)
    docs = [(i, " ".join(random.choice(list("aabBccddefgh"), 30))) for i in range(40)] + [(90, None), (91, ""), (92, "Zz")]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, bucket int").repartition(3)
    train = [t for d, t in docs if d < 30]
    for head, tokens_each in ((1 << 16, 50), (8, 7)):
        monkeypatch.setattr(katz, "HEAD", head)
        monkeypatch.setattr(katz, "BUCKET_TOKENS", tokens_each)
        compare(katz.score(df, katz.fit(df.filter("doc_id < 30"))).collect(), docs, ByHand(train))
    model = katz.fit(df.filter("doc_id < 30"))
    assert katz.score(df.limit(0), model).count() == 0
    twice = df.filter("doc_id = 3").union(df.filter("doc_id = 3").selectExpr("cast(null as long)", "text", "bucket"))
    assert len({r.score for r in katz.score(twice.union(twice), model).collect()}) == 1
    nothing = katz.score(df, katz.fit(df.limit(0))).collect()
    assert len(nothing) == len(docs) and all(np.isfinite(r.score) and r.n_known == 0 for r in nothing)


def test_bigrams_seen_once_are_in_the_model(spark, monkeypatch):
    monkeypatch.setattr(katz, "LEAST_PAIR", 1)  # read by ByHand alone: its model has no cut
    random = np.random.default_rng(6)
    docs = [(i, " ".join(random.choice([f"w{j}" for j in range(60)], 40))) for i in range(50)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    train, by_hand = df.filter("doc_id < 40"), ByHand([t for d, t in docs if d < 40])
    model = katz.fit(train)
    assert model.pairs.filter("c = 1").count() == sum(c == 1 for c in by_hand.pairs.values()) > 0
    compare(katz.score(df, model).collect(), docs, by_hand)


def test_very_long_texts(spark):
    random = np.random.default_rng(7)
    docs = [(1, " ".join(f"w{random.integers(0, 9000)}" for _ in range(60_000))), (2, "x" * 1_000_000), (3, "same " * 50_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    model = ByHand([t for _, t in docs])
    for r in katz.score(df, katz.fit(df)).collect():
        n, known, base, score = model.score(docs[r.doc_id - 1][1])
        assert (r.n_tokens, r.n_known) == (n, known) and r.base_score == pytest.approx(base, rel=1e-9)
        # words and pairs are summed apart and cancel where a text repeats itself: the rounding grows with its tokens
        assert r.score == pytest.approx(score, rel=1e-9, abs=1e-10 * n)


def test_pairs_take_few_bytes(spark):
    random = np.random.default_rng(8)
    docs = [(i, " ".join(f"w{j}" for j in random.zipf(1.2, 500) % 100_000)) for i in range(400)]
    model = katz.fit(spark.createDataFrame(docs, "doc_id long, text string"))
    stored = sum(os.path.getsize(f.split(":", 1)[1]) for f in model.pairs.inputFiles())
    n = len(set().union(*(zip(["<s>", *tokens(t)], tokens(t), strict=False) for _, t in docs)))
    assert model.pairs.count() == n and stored < 8 * n  # 13.5 with the key's hash and its weight


def test_every_pair_is_in_the_buckets_of_its_rare_words(monkeypatch):
    monkeypatch.setattr(katz, "BUCKET_TOKENS", 64)
    random, buckets = np.random.default_rng(9), 5
    head = katz.Head(np.arange(10, dtype=np.uint64) + np.uint64(1 << 63), np.arange(100, 0, -10))
    words = np.concatenate([np.arange(10), random.integers(1 << 63, 1 << 64, 20, np.uint64)]).astype(np.uint64)
    first, second, owner = random.choice(words, 3000), random.choice(words, 3000), np.sort(random.integers(0, 40, 3000))
    want = Counter(zip(first.tolist(), second.tolist(), owner.tolist(), strict=True))
    seen, buckets_of = Counter(), defaultdict(set)
    for bucket, blob in katz._by_bucket(first, second, owner.astype(np.uint16), head, buckets):
        own, one, two, times, places = katz._unpacked(blob)
        one, two = (np.repeat(katz._replaced(x, own) if len(own) else x, times.astype(int)).tolist() for x in (one, two))
        found = Counter(zip(one, two, places.tolist(), strict=True))
        for (a, b, _), n in found.items():
            rare = {w % buckets for w in (a, b) if w >= 1 << 16}
            assert bucket in rare or not rare
            buckets_of[a, b].add(bucket)
        seen |= found
        assert all(want[k] == n for k, n in found.items())
    assert seen == want
    assert all(len(found) == max(1, len({w % buckets for w in pair if w >= 1 << 16})) for pair, found in buckets_of.items())
    assert len(set().union(*(buckets_of[0, b] for b in range(10)))) > 2  # a common first word's pairs are spread
