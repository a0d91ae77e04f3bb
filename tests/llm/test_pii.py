import hashlib
import itertools
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rideloom.llm import pii
from rideloom.llm.queries import op4_pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def by_hand(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub(r"[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card":
                double = [int(d) * (2 if i % 2 else 1) for i, d in enumerate(reversed(digits))]
                if not 14 <= len(digits) <= 19 or sum(d // 10 + d % 10 for d in double) % 10:
                    continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="0159.@+-() \naé%", max_size=60))
def test_base_spans(text):
    assert pii.base_spans(text) == by_hand(text)


@pytest.mark.parametrize("text", [
    "a@b.c@d.e", "x.@y.z", "@a.b", "a@b", "1.2.3.4.5.6.7.8", "0001.2.3.255 256.1.1.1", "4111 1111-1111 1111",
    "+1 (017) 555-7713.", "é+49 30 1234567 é", "a@b.c.@d.e", "a@@b.c", "999999999999999999999.1.1.1",
])
def test_base_spans_of_chosen_texts(text):
    assert pii.base_spans(text) == by_hand(text)


def test_query_on_the_small_table(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op4_pii(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = by_hand(docs[r.doc_id])
        text = pii.written(want)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[1] == i for s in want) for i in range(4)]
        assert set(filter(None, text.split(","))) <= set(r.spans.split(","))
        if not re.search("[0-9@]", docs[r.doc_id]):
            assert r.spans == ""


def test_labels_travel_to_the_same_number_in_another_form(spark):
    base = spark.createDataFrame([(i, f"call +1 (2{i:02d}) 555-{i:04d} or card 4111111111111111 now {i * 7919}")
                                  for i in range(60)], "doc_id long, text string")
    field = pii.fit(base)
    text = "card 4111111111111111 then 4111.1111.1111.1111 end 12 and 7919"
    found = pii.added_spans(text, pii.base_spans(text), field)
    assert found == [(text.index("4111."), 2, text.index(" end"))]
    assert pii.added_spans("plain 123 text 45", [], field) == []


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, "x"), (1, "", "x"), (2, "a@b.cd", None), (2, "a@b.cd", None),
                                  (3, "1" * 200_000 + " a@b.cd", "y")], "doc_id long, text string, spans string")
    rows = pii.find(docs).collect()
    assert sorted(len(r.base) for r in rows) == [0, 0, 1, 1, 1]
    assert pii.find(docs.limit(0)).count() == 0
    out = pii.masked(docs)
    assert out.schema == docs.schema
    texts = [r.text for r in out.collect()]
    assert texts.count(None) == 1 and texts.count("[email]") == 2


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab1@ \n\x0b\x1c.é", max_size=40))
def test_nodes_are_words_with_a_digit_or_an_at(text):
    plain = re.compile(r"[^\x20\x09-\x0D]*[0-9@][^\x20\x09-\x0D]*")
    assert [m.span() for m in pii._NODE.finditer(text)] == [m.span() for m in plain.finditer(text)]


@pytest.mark.parametrize("text", ["a" * 1_000_000 + " 1", "語" * 1_000_000 + " 1", "." * 1_000_000 + " @", "1" * 1_000_000])
def test_very_long_words_take_linear_time(text):
    begin = time.perf_counter()
    assert len(list(pii._NODE.finditer(text))) == 1
    pii.base_spans(text)
    assert time.perf_counter() - begin < 3


@pytest.fixture(scope="module")
def field(spark):
    """Learned from texts whose numbers, names and addresses all differ."""
    def card(i):
        body = f"4{i * 7919 % 10**14:014d}"
        return next(body + str(d) for d in range(10) if pii.luhn(body + str(d)))

    texts = [f"order {i * 31} of 20{i % 30:02d}: name{i}@host{i}.org, +1 (2{i:02d}) 555-{i * 97:04d}, 10.{i}.7.{i * 2} and "
             f"card {card(i)}" for i in range(80)]
    texts += [f"shelf {i} row {i * 17} holds {i * 104729 + 10**9} or {i * 15485863 + 10**15} pieces" for i in range(80)]
    return pii.fit(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))


@pytest.mark.parametrize("text, added", [
    ("card 4111 1111 1111 1111 and again 4111.1111.1111.1111", ["card 4111.1111.1111.1111"]),
    ("card 4111 1111 1111 1111 typed as 4111 1111 1111 1112 too", ["card 4111 1111 1111 1112"]),
    ("+1 (212) 555-0100 or 2125550100", ["phone 2125550100"]),
    ("+1 (212) 555-0100 or (212) 555-0100, and 1999.", ["phone (212) 555-0100"]),
    ("bob@x.org, later bob@x", ["email bob@x"]),
    ("bob@x.org, later rob@x and bob@y", []),
    ("at 10.2.33.4 then 10-2-33-4.", ["ip 10-2-33-4"]),
    ("+1 (212) 555-0100 and 9075550199 in 2020", []),
    ("no pattern: 2125550100, 2125550100 and 212555010", []),
    ("4111.1111.1111.1112 and 20200102", []),
])
def test_similar_values_get_the_label_and_others_do_not(field, text, added):
    found = pii.added_spans(text, pii.base_spans(text), field)
    assert [f"{pii.KINDS[k]} {text[a:b]}" for a, k, b in found] == added


def exact(field, nodes):
    """Marginals by summing over all labellings."""
    n, labels = len(nodes.base), len(pii.KINDS) + 1
    unary = field.potentials(nodes).astype(float)
    total = np.zeros((n, labels))
    for y in itertools.product(range(labels), repeat=n):
        energy = sum(unary[i, y[i]] for i in range(n)) + sum(field.chain[y[i], y[j]] for i, j in nodes.chain)
        weight = np.exp(energy + field.skip * sum(y[i] == y[j] for i, j in nodes.skip))
        total[np.arange(n), y] += weight
    return total / total.sum(1, keepdims=True)


@pytest.mark.parametrize("text", [
    "2125550100 a 2125550100", "12 13 14 15", "+1 (212) 555-0100 or 2125550100 and 2125550100 12", "bob@x a bob@x b bob@x",
    "4111 1111 1111 1111 as 4111.1111.1111.1111", "7 bob@x 8 b bob@x 9", "3 12125550100 4 a 2125550100 5",
])
def test_beliefs_against_exact_enumeration(text):
    rng = np.random.default_rng(3)
    labels = len(pii.KINDS) + 1
    field = pii.Field(rng.normal(size=(pii._FEATURES, labels)), rng.normal(size=(labels, labels)), 0.7)
    nodes = pii.graph(text, pii.base_spans(text))
    edges = len(nodes.chain) + len(nodes.skip)
    near = 1e-4 if edges < len(nodes.base) else 0.1  # exact without loops
    assert np.abs(field.posterior(nodes, rounds=60) - exact(field, nodes)).max() < near


def off_by_one(a, b):
    cut = lambda v: {v[:k] + v[k + 1 :] for k in range(len(v))}
    return a in cut(b) or b in cut(a) or bool(len(a) == len(b) and cut(a) & cut(b))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="12", min_size=10, max_size=13), max_size=12, unique=True))
def test_numbers_one_digit_off(numbers):
    """Every similar pair is joined by a path of similar pairs, and no other pair is joined."""
    joined = {tuple(p) for p in pii._one_digit_off(numbers).tolist()}
    root = list(range(len(numbers)))
    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in joined:
        assert off_by_one(numbers[i], numbers[j])
        root[top(i)] = top(j)
    for i, j in itertools.combinations(range(len(numbers)), 2):
        if off_by_one(numbers[i], numbers[j]):
            assert top(i) == top(j)


def test_long_texts_are_marked_whole(field):
    filler = " ".join(str(10**11 + i * i) for i in range(60_000))
    text = f"+1 (212) 555-0100 first, {filler}, then word 2125550100"
    begin = time.perf_counter()
    found = pii.added_spans(text, pii.base_spans(text), field)
    assert (len(text) - 10, 3, len(text)) in found
    assert time.perf_counter() - begin < 60


def test_the_field_learns_from_every_part_of_a_text(spark):
    far = "word " * 30_000 + "call +1 (212) 555-0100 or mail bob@x.org, card 4111 1111 1111 1111"
    docs = spark.createDataFrame([(1, far)], "doc_id long, text string")
    assert pii.fit(docs).skip > 1
    assert pii.fit(docs.limit(0)).skip == 0 and pii.added_spans("a 12", [], pii.fit(docs.limit(0))) == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([
    "a@b.c", "-@-.-", "%@x-.y", "(a@b", "@a", "a@@b.c", "1.2.3.4", "001.2.3.255", "1-2-3-4", "4111 1111 1111 1111", "4111.1111.1111.1111",
    "+1 (212) 555-0100", "2125550100", "+4111111111111111", "\"2125550100\",", "12", "()", "é1", "語@語", "\n", "..1..", "1" * 25,
]), max_size=12), st.sampled_from(["", " ", "  ", "x "]))
def test_any_mixture_of_forms(field, parts, between):
    text = between.join(parts)
    base = pii.base_spans(text)
    added = pii.added_spans(text, base, field)
    spans = sorted((a, b) for a, _, b in added)
    assert all(a < b <= len(text) for a, b in spans) and all(x[1] <= y[0] for x, y in zip(spans, spans[1:], strict=False))
    assert all(b <= c or a >= d for a, b in spans for c, _, d in base)
    nodes, labels, use = pii.lesson(text)
    assert len(nodes.base) == len(labels) == len(use) and not (use & (nodes.base > 0)).any()
    assert (nodes.skip[:, 0] < nodes.skip[:, 1]).all()
