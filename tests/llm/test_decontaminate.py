import numpy as np
import pyarrow as pa

from rideloom.llm import decontaminate as dec
from rideloom.llm.queries import op5_decontamination

STRIP = ".,;:!?\"'()[]{}#*$%&|<>-_"


def normal(text):
    return [w.decode().strip(STRIP) for w in (text or "").encode().lower().split()]


def in_order(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
        row = new
    return row[-1]


def test_common_in_order():
    random = np.random.default_rng(1)
    for _ in range(50):
        a, b = random.integers(0, 6, random.integers(1, 70)), random.integers(0, 6, random.integers(0, 90))
        assert dec.common_in_order(a, b) == in_order(a.tolist(), b.tolist())
    assert dec.contains(np.array([1, 2, 3]), np.array([2, 3])) and not dec.contains(np.array([1]), np.array([1, 2]))


def test_query_finds_every_copied_item_and_little_else(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: " ".join(normal(r.text)) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    items = {r.item_id: normal(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    rows = op5_decontamination(spark, folder).collect()
    found = {(r.doc_id, r.item_id) for r in rows}
    copied = {(d, i) for d, t in docs.items() for i, w in items.items() if f" {' '.join(w)} " in f" {t} "}
    assert copied and copied <= found
    for d, i in found - copied:  # what else is reported really has the item's words in order
        assert in_order(items[i], docs[d].split()) >= dec.LIKELY * len(items[i])
    assert len(found - copied) <= 0.05 * len(copied) + 1


def long_text(seed, n=400):
    random = np.random.default_rng(seed)
    return [f"v{random.integers(0, 3000)}" for _ in range(n)]


def test_paraphrases_edges_and_clashing_columns(spark):
    item = [f"q{i}" for i in range(40)]
    changed = [w if i % 5 else f"z{i}" for i, w in enumerate(item)]  # a fifth of the words replaced, the end kept
    half = item[:16]
    texts = [(1, " ".join(long_text(1) + item + long_text(2))), (2, " ".join(long_text(3) + changed + long_text(4))),
             (3, " ".join(long_text(5) + half + long_text(6))), (4, None), (5, ""), (6, " ".join(long_text(7))),
             (7, " ".join(w.upper() + "," for w in item)), (7, " ".join(item))]
    docs = spark.createDataFrame([(*t, 1) for t in texts], "doc_id long, text string, item_id int")
    benchmark = spark.createDataFrame([(10, " ".join(item)), (11, None), (None, "x"), (12, " ")],
                                      "item_id long, text string")
    rows = dec.leaks(docs, benchmark).collect()
    assert sorted((r.doc_id, r.item_id) for r in rows) == [(1, 10), (2, 10), (7, 10), (7, 10)]
    kept = dec.keep_clean(docs, benchmark)
    assert kept.schema == docs.schema and sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6]
    assert dec.leaks(docs, benchmark.limit(0)).count() == 0 and dec.keep_clean(docs, benchmark.limit(0)).count() == 8
    assert dec.leaks(docs.limit(0), benchmark).count() == 0


def test_singular_values_are_those_of_the_weighted_passages(spark):
    items = [" ".join(f"t{(7 * i + j) % 30}" for j in range(10)) for i in range(6)]
    texts = [" ".join(f"t{random.integers(0, 40)}" for _ in range(150)) for random in map(np.random.default_rng, range(9))]
    known = dec.fit(spark.createDataFrame([(t,) for t in texts], "text string"),
                    spark.createDataFrame(list(enumerate(items)), "item_id long, text string"))
    hashes, rows, halves = dec._Terms(), [], []
    for t in texts + items:
        words = hashes.of(t.encode().split())
        parts = [np.array([(words[a : a + dec.HALF] == w).sum() for w in known.terms]) for a in range(0, len(words), dec.HALF)]
        halves += parts if t in texts else []
        rows += [p + (parts[i + 1] if i + 1 < len(parts) else 0) for i, p in enumerate(parts)]
    counts = (np.array(halves) > 0).sum(0)
    weights = np.log((len(halves) + 1) / (counts + 1)) + 1
    _, values, right = np.linalg.svd(np.array(rows) * weights)
    assert np.allclose(known.singular, values[: len(known.singular)], rtol=1e-3) and len(known.singular) == len(known.terms)
    assert np.allclose(np.abs((known.space / weights[:, None])[:, 0]), np.abs(right[0]), atol=1e-3)


def planted(items, seed):
    """Texts of random words with one copy and one paraphrase (two fifths of the words replaced, end kept) of each item."""
    random = np.random.default_rng(seed)
    for i, item in enumerate(items):
        changed = [f"z{random.integers(0, 9999)}" if j % 5 < 2 and j < len(item) - dec.ANSWER_WORDS else w for j, w in enumerate(item)]
        for k, words in enumerate((item, changed)):
            yield 2 * i + k, " ".join(long_text((seed, i, k), 90) + words + long_text((seed, i, k, 1), 70))


def test_thousands_of_items_are_all_found(spark):
    random = np.random.default_rng(8)
    items = [[f"v{random.integers(0, 3000)}" for _ in range(random.integers(15, 60))] for _ in range(2000)]
    docs = spark.createDataFrame(list(planted(items, 5)), "doc_id long, text string").repartition(4)
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in dec.leaks(docs, benchmark).collect()}
    assert {(2 * i + k, i) for i in range(len(items)) for k in (0, 1)} <= found


def test_long_items(spark):
    items = [long_text(40 + n, n) for n in (161, 300, 2500)]
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    spread = [w for i, w in enumerate(items[1]) for w in ([w, f"z{i}"] if i % 3 == 0 else [w])]  # a third more words
    texts = [" ".join(long_text(3, 77) + w + long_text(4, 50)) for w in (*items, spread)] + [" ".join(long_text(9, 3000))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = dec.leaks(docs, benchmark).collect()
    assert sorted((r.doc_id, r.item_id) for r in rows) == [(0, 0), (1, 1), (2, 2), (3, 1)]
    assert all(r.in_order == 1 and (r.answer or r.doc_id == 3) for r in rows)


def test_blocks_of_items(spark, monkeypatch):
    assert not hasattr(dec, "MOST_ITEMS")  # no number of items is too many
    items = [[f"v{random.integers(0, 3000)}" for _ in range(30)] for random in map(np.random.default_rng, range(50))]
    docs = spark.createDataFrame(list(planted(items, 6)) + [(999, " ".join(long_text(77)))], "doc_id long, text string")
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    whole = sorted((r.doc_id, r.item_id, r.in_order, r.answer) for r in dec.leaks(docs, benchmark).collect())
    monkeypatch.setattr(dec, "BLOCK_ITEMS", 20)
    assert len(dec._item_blocks(benchmark)) == 3
    assert sorted((r.doc_id, r.item_id, r.in_order, r.answer) for r in dec.leaks(docs, benchmark).collect()) == whole
    assert len(whole) >= 100 and [r.doc_id for r in dec.keep_clean(docs, benchmark).collect()] == [999]


def test_sums_in_levels_and_blocks_by_content(spark, monkeypatch):
    random = np.random.default_rng(2)
    start = random.normal(size=(300, 3))
    texts = [" ".join(f"t{random.integers(0, 50)}" for _ in range(90)) for _ in range(40)]
    terms = np.unique(dec._Terms().of(" ".join(texts).encode().split()))
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    once = dec._survey(docs.coalesce(1), terms, start[: len(terms)])
    monkeypatch.setattr(dec, "FAN_IN", 2)
    assert np.allclose(dec._survey(docs.repartition(13), terms, start[: len(terms)]), once, rtol=1e-4)
    monkeypatch.setattr(dec, "BLOCK_ITEMS", 10)
    items = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, text string")
    block = lambda parts: [sorted(r.item_id for r in b.collect()) for b in dec._item_blocks(items.repartition(parts))]
    assert block(1) == block(7) and sorted(sum(block(3), [])) == list(range(40))


def test_a_close_passage_decides_where_the_answer_is_gone(spark):
    items = [[f"q{i}_{j}" for j in range(50)] for i in range(3)]
    changed = [w if j % 10 < 7 else f"z{j}" for j, w in enumerate(items[0])]  # three of ten words replaced, the last ones too
    texts = [long_text(1, 64) + changed + long_text(2, 60), *(long_text(3 + i, 500) for i in range(20))]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    rows = {(r.doc_id, r.item_id): r for r in dec.leaks(docs, benchmark).collect()}
    assert (0, 0) in rows and not rows[0, 0].answer and dec.LIKELY <= rows[0, 0].in_order < dec.SURE
    assert rows[0, 0].cosine >= dec.CLOSE and dec.keep_clean(docs, benchmark).count() == 20
    # without the latent space, no passage is close, and the words in order alone do not make a leak
    known = dec.fit(docs, benchmark)
    known.space[:] = 0
    assert (0, 0) not in {(r.doc_id, r.item_id) for r in dec.leaks(docs, benchmark, known).collect()}


def test_terms_of_a_column_are_those_of_split_texts():
    texts = ["", None, " ", "\x1cb\x0b\x1c c\r\n--  A.B. ", "\u00c9.  x y\x85z", "a", " --", ".la. La,"]
    plain = [dec._Terms().of((t or "").encode().split()).tolist() for t in texts]
    terms = np.unique(dec._Terms().of(b"b a.b x la -- z".split()))
    at, sizes = dec._terms_in(pa.array(texts), terms)
    assert sizes.tolist() == [len(words) for words in plain]
    assert at.tolist() == [terms.tolist().index(w) if w in terms.tolist() else -1 for words in plain for w in words]
