"""Personal data: fixed patterns, and a skip-chain conditional random field that carries their labels further.

The field's nodes are the patterns' spans, which are evidence, other words with a digit or ``@``, and runs of number
words. Its labels are the kinds of the patterns and none. Chain edges join nodes that follow each other closely; skip
edges join the same or similar ones anywhere in the document. Loopy belief propagation makes labels agree along both,
so a card number that the patterns find once is also found where it stands in another form. The field's beliefs
alone decide which spans are added.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b
from heapq import nsmallest

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideloom.llm.batches import text_chunks, with_columns

KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NODE = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+")  # tried at the begin of a word only
_MARKED = re.compile(rb"[0-9@]")
#: Stretches with a span, and as many without, that the field is trained on, their characters, steps, weight of decay.
SAMPLE, SAMPLE_CHARS, STEPS, DECAY = 500, 1000, 600, 0.1
#: Posterior probability from which a node outside the patterns' spans is marked, and rounds of messages.
CERTAIN, ROUNDS = 0.95, 8
_BLOCK = 1 << 16

Span = tuple[int, int, int]  # start, kind, end


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """What the whole pattern finds from left to right, looked for from each ``@`` to the left."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        else:
            done = at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns by start, then kind; a match that fails its test is dropped as a whole."""
    spans = [(a, 0, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            spans.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            spans.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_digits(m[0])) <= 15:
            spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


_FEATURES = 40
_GROUPS = re.compile(r"[0-9]+")
_NUMBER = re.compile(r"[0-9+()./-]+")
_LABEL = re.compile(r"@[A-Za-z0-9-]+")
_LEFT, _RIGHT = "\"'", ".,;:!?\"'"


def _address(word: str) -> str | None:
    """Name, ``@`` and first label of the first address in a word, in linear time."""
    before, at = 0, word.find("@")
    while at >= 0:
        label = _LABEL.match(word, at)
        if at > before and label:
            return word[before : label.end()].lstrip("\"'<([{")
        before = at + 1
        at = word.find("@", before)
    return None


def _is_ip(groups: list[str]) -> bool:
    return len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups)


def _node_features(word: str) -> list[int]:
    """Numbers of the features that hold for a word; only its form counts, never its digits."""
    digits = _digits(word)
    n = len(digits)
    letters = sum(c.isalpha() for c in word)
    address = _address(word)
    out = [0, 1 + min(n, 20)]
    for i, holds in enumerate((
        "@" in word, not letters and _is_ip(_GROUPS.findall(word)), word[0] == "+", "(" in word, "-" in word, letters > 0,
        letters > n, 14 <= n <= 19 and luhn(digits), "." in word, _DOMAIN.search(word) is not None,
        word[0] == "+" and 10 <= n <= 15, n >= 10 and not letters, " " in word, address is not None, "/" in word or ":" in word,
    )):
        if holds:
            out.append(22 + i)
    return out


@dataclass
class Nodes:
    """A text as a graph. ``base`` is the kind + 1 of a pattern's span, 0 for other nodes.

    ``features`` lists the features that hold, node after node, from ``first`` of each node.
    """

    start: np.ndarray
    end: np.ndarray
    base: np.ndarray
    features: np.ndarray
    first: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


class _Likeness:
    """Which nodes of a text are the same or similar.

    Numbers of seven or more digits are similar if they have equal digits, if one ends in the other after at most
    three digits more (a country code), or, from ten to nineteen digits, if they are equal once a digit of one or of each
    is left out (one replaced, missing, added or exchanged with the next). Addresses are similar if name and first
    label are equal, four groups up to 255 if the groups are. Equal ones are chained in order; of similar values one
    node each is joined, so no link grows with the square of a group.
    """

    def __init__(self) -> None:
        self.pairs: list[tuple[int, int]] = []
        self.ends: dict[str, list[int]] = {}  # value -> its first and last node

    def add(self, node: int, word: str) -> None:
        address = _address(word)
        groups = _GROUPS.findall(word)
        if address:
            value = address.lower()
        elif "@" not in word and word[0] != "+" and _is_ip(groups):
            value = "ip " + ".".join(str(int(g)) for g in groups)
        else:
            value = "".join(groups)
            if len(value) < 7 or "@" in word:  # shorter numbers are alike by chance
                return
        known = self.ends.setdefault(value, [node, node])
        if known[1] != node:
            self.pairs.append((known[1], node))
            known[1] = node

    def _join(self, one: str, other: str, apart) -> None:
        for a, b in zip(self.ends[one], self.ends[other], strict=True):
            if apart(a, b):
                self.pairs.append((min(a, b), max(a, b)))
                return

    def links(self, apart) -> np.ndarray:
        """Pairs of nodes, each once; ``apart`` says whether two nodes share no character."""
        numbers = sorted(v[::-1] for v in self.ends if v.isdigit())
        above: list[str] = []
        for value in numbers:
            while above and not value.startswith(above[-1]):
                above.pop()
            if above and len(value) - len(above[-1]) <= 3:
                self._join(value[::-1], above[-1][::-1], apart)
            above.append(value)
        numbers = [v[::-1] for v in numbers if 10 <= len(v) <= 19]
        for i, j in _one_digit_off(numbers):
            self._join(numbers[i], numbers[j], apart)
        return np.unique(np.array(self.pairs, np.int64).reshape(-1, 2), axis=0)


def _one_digit_off(numbers: list[str]) -> np.ndarray:
    """Pairs of places whose numbers are equal once a digit of one or of each is left out, joined in each class."""
    if len(numbers) < 2:
        return np.zeros((0, 2), np.int64)
    value = np.array([int(v) for v in numbers], np.uint64)
    length = np.array([len(v) for v in numbers], np.int64)
    keys, sizes, places = [value], [length], [np.arange(len(numbers))]
    for k in range(int(length.max())):
        has = np.flatnonzero(length > k)
        unit = np.uint64(10**k)
        ten = np.uint64(10)
        keys.append(value[has] // unit // ten * unit + value[has] % unit)
        sizes.append(length[has] - 1)
        places.append(has)
    key, size, place = map(np.concatenate, (keys, sizes, places))
    order = np.lexsort((place, size, key))
    key, size, place = key[order], size[order], place[order]
    same = (key[1:] == key[:-1]) & (size[1:] == size[:-1]) & (place[1:] != place[:-1])
    pairs = np.stack([place[:-1][same], place[1:][same]], axis=1)
    return np.unique(pairs, axis=0)


def graph(text: str, spans: list[Span]) -> Nodes:
    """Nodes are the patterns' spans, the other words with a digit or ``@``, and runs of number words one blank apart.

    Quotes around a word and marks behind it are not part of it. A word that touches a span is no node of its own.
    Chain edges join spans and words at most one character apart; runs lie over their words and have skip edges only.
    """
    start, end, base, features, first = array("q"), array("q"), array("b"), array("b"), array("q")
    chain, run, alike = [], [], _Likeness()
    last, at, covered = -1, 0, 0

    def add(a: int, b: int, label: int) -> int:
        first.append(len(features))
        start.append(a)
        end.append(b)
        base.append(label)
        features.extend(_node_features(text[a:b]))
        alike.add(len(start) - 1, text[a:b])
        return len(start) - 1

    def unit(a: int, b: int, label: int) -> None:
        nonlocal last
        before, last = last, add(a, b, label)
        if before >= 0 and 0 <= a - end[before] <= 1:
            chain.append((before, last))

    def close() -> None:
        if len(run) > 1:
            add(run[0][0], run[-1][1], 0)
        run.clear()

    for m in _NODE.finditer(text):
        while at < len(spans) and spans[at][0] < m.end():
            close()
            a, k, b = spans[at]
            unit(a, b, k + 1)
            covered = max(covered, b)
            at += 1
        if m.start() < covered:
            continue
        word = m[0]
        a = m.start() + len(word) - len(word.lstrip(_LEFT))
        b = m.end() - len(word) + len(word.rstrip(_RIGHT))
        if a >= b:
            continue
        number = _NUMBER.fullmatch(text, a, b) is not None
        if run and (not number or m.start() - run[-1][1] != 1 or text[run[-1][1]] != " "):
            close()
        unit(a, b, 0)
        if number:
            run.append((a, b))
            if b < m.end():
                close()
    close()
    skip = alike.links(lambda i, j: end[i] <= start[j] or end[j] <= start[i])
    whole = lambda x: np.array(x, np.int64)
    return Nodes(whole(start), whole(end), whole(base), np.array(features, np.int8), whole(first),
                 whole(chain).reshape(-1, 2), skip)


@dataclass
class Field:
    """Weights of a node's features, of label pairs along the chain, and of equal labels across a skip."""

    unary: np.ndarray
    chain: np.ndarray
    skip: float

    def potentials(self, nodes: Nodes) -> np.ndarray:
        """Log potentials of the labels of each node; the patterns' labels are evidence."""
        out = np.add.reduceat(self.unary.astype(np.float32)[nodes.features], nodes.first, axis=0)
        fixed = np.flatnonzero(nodes.base)
        out[fixed] = -30.0
        out[fixed, nodes.base[fixed]] = 0.0
        return out

    def posterior(self, nodes: Nodes, rounds: int = ROUNDS) -> np.ndarray:
        """Beliefs after ``rounds`` of damped loopy message passing, edges in blocks so that memory stays small."""
        unary = self.potentials(nodes)
        edges = np.concatenate([nodes.chain, nodes.skip])
        if not len(edges):
            return _softmax(unary)
        n, n_chain = len(edges), len(nodes.chain)
        source, target = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
        along = self.chain.astype(np.float32)
        same = np.eye(len(KINDS) + 1, dtype=np.float32) * np.float32(self.skip)
        parts = [(0, n_chain, along), (n_chain, n, same), (n, n + n_chain, along.T), (n + n_chain, 2 * n, same)]
        message = np.zeros((2 * n, len(KINDS) + 1), np.float32)
        belief = unary
        for _ in range(rounds):
            sent = np.empty_like(message)
            for begin, stop, potential in parts:
                for a in range(begin, stop, _BLOCK):
                    b = min(a + _BLOCK, stop)
                    back = np.arange(a, b)
                    back = np.where(back < n, back + n, back - n)
                    into = (belief[source[a:b]] - message[back])[:, :, None] + potential
                    top = into.max(1)
                    new = top + np.log(np.exp(into - top[:, None, :]).sum(1))
                    sent[a:b] = 0.5 * message[a:b] + 0.5 * (new - new.max(1, keepdims=True))
            message = sent
            belief = unary.copy()
            np.add.at(belief, target, message)
        return _softmax(belief)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _other_forms(kind: int, word: str) -> list[str]:
    """A span written so that no pattern of its kind finds it; a card also with its last digit mistyped."""
    digits = _digits(word)
    if kind == 0:
        return [_address(word)]
    if kind == 1:
        return [word.replace(".", "-")]
    if kind == 2:
        return [".".join(digits[i : i + 4] for i in range(0, len(digits), 4)), digits[:-1] + str((int(digits[-1]) + 1) % 10)]
    return [digits[-10:], f"({digits[-10:-7]}) {digits[-7:-4]}-{digits[-4:]}"]


def _decoy(kind: int, word: str) -> str:
    """A value that belongs to nobody: digits, groups and names are turned around."""
    if kind == 0:
        name, _, rest = _address(word).partition("@")
        return f"{name[::-1]}0@{rest[::-1]}"
    return ".".join(reversed(word.split("."))) if kind == 1 else _digits(word)[::-1]


def lesson(text: str) -> tuple[Nodes, np.ndarray, np.ndarray]:
    """A training text with each span in other forms behind it, and decoys in those forms.

    Returns the graph, the labels, and which nodes are learned from: none of the patterns' spans (they are evidence), none
    of the text's own nodes that are similar to one (nobody knows their label), and no mere part of a form.
    """
    parts, made, size = [text], [], len(text)
    for a, k, b in base_spans(text):
        own, other = _other_forms(k, text[a:b]), _other_forms(k, _decoy(k, text[a:b]))
        for label, form in [(k + 1, form) for form in own] + [(0, form) for form in other]:
            if label or k != 2 or not luhn(_digits(form)):
                parts.append(f" and {form}")
                made.append((size + 5, size + 5 + len(form), label))
                size += 5 + len(form)
    text = "".join(parts)
    nodes = graph(text, base_spans(text))
    labels = nodes.base.copy()
    near = np.zeros(len(labels), bool)
    for one, other in (nodes.skip.T, nodes.skip.T[::-1]):
        near[one[nodes.base[other] > 0]] = True
    for a, b, label in made:
        inside = (nodes.start >= a) & (nodes.start < b)
        whole = inside & (nodes.start == a) & (nodes.end == b)
        labels[whole & (nodes.base == 0)] = label
        near = (near | inside) & ~whole
    return nodes, labels, (nodes.base == 0) & ~near


def train(texts: list[str], steps: int = STEPS) -> Field:
    """Pseudo-likelihood: each label given the node's features and its neighbours' labels, by gradient steps (Adam).

    All weights, that of a skip too, are learned. Without a span in ``texts`` the field marks nothing.
    """
    n_labels = len(KINDS) + 1
    field = Field(np.zeros((_FEATURES, n_labels)), np.zeros((n_labels, n_labels)), 0.0)
    field.unary[0, 0] = 4.0
    lessons = [x for x in map(lesson, texts) if len(x[1])]
    if not lessons:
        return field
    offsets = np.cumsum([0, *(len(y) for _, y, _ in lessons)])
    x = np.zeros((offsets[-1], _FEATURES), np.float32)
    for (nodes, _, _), o in zip(lessons, offsets, strict=False):
        x[o + np.repeat(np.arange(len(nodes.base)), np.diff([*nodes.first, len(nodes.features)])), nodes.features] = 1
    y, use = (np.concatenate([part[i] for part in lessons]) for i in (1, 2))
    chain, skip = (np.concatenate([getattr(nodes, name) + o for (nodes, _, _), o in zip(lessons, offsets, strict=False)])
                   for name in ("chain", "skip"))
    hot = np.eye(n_labels, dtype=np.float32)[y]
    agreeing, before, after = np.zeros_like(hot), np.zeros_like(hot), np.zeros_like(hot)
    np.add.at(agreeing, skip[:, 0], hot[skip[:, 1]])
    np.add.at(agreeing, skip[:, 1], hot[skip[:, 0]])
    before[chain[:, 1]], after[chain[:, 0]] = hot[chain[:, 0]], hot[chain[:, 1]]
    x, hot, agreeing, before, after = (part[use] for part in (x, hot, agreeing, before, after))
    if not len(x):
        return field
    weights = [field.unary, field.chain, np.array(field.skip)]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    for step in range(1, steps + 1):
        unary, along, equal = weights
        gap = hot - _softmax(x @ unary + before @ along + after @ along.T + equal * agreeing)
        slopes = (x.T @ gap, before.T @ gap + gap.T @ after, np.array((gap * agreeing).sum()))
        for i, (w, g) in enumerate(zip(weights, slopes, strict=True)):
            g = g - DECAY * w
            m, v = moments[i] = (0.9 * moments[i][0] + 0.1 * g, 0.99 * moments[i][1] + 0.01 * g * g)
            weights[i] = w + 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Field(weights[0], weights[1], float(weights[2]))


def added_spans(text: str, base: list[Span], field: Field, certain: float = CERTAIN) -> list[Span]:
    """Nodes outside the patterns' spans that the field is certain of; a run goes before the words under it."""
    nodes = graph(text, base)
    if not len(nodes.base):
        return []
    p = field.posterior(nodes)
    kind = p.argmax(1)
    new = np.flatnonzero((nodes.base == 0) & (kind > 0) & (p.max(1) >= certain))
    out: list[Span] = []
    for i in sorted(new.tolist(), key=lambda i: (nodes.start[i], -nodes.end[i])):
        if not out or nodes.start[i] >= out[-1][2]:
            out.append((int(nodes.start[i]), int(kind[i]) - 1, int(nodes.end[i])))
    return out


def fit(docs: DataFrame, sample: int = SAMPLE, text_column: str = "text") -> Field:
    """Train on at most ``sample`` stretches with a pattern's span and as many without one.

    Every stretch of ``SAMPLE_CHARS`` characters of every text that holds a digit or ``@`` may be chosen; those with
    the smallest hash are. Only training is bounded so, never marking.
    """
    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, str]]:
        for _, texts in text_chunks(batches):
            for raw in texts:
                if not _MARKED.search(raw):
                    continue
                text = raw.decode()
                for a in range(0, len(text), SAMPLE_CHARS):
                    part = text[a : a + SAMPLE_CHARS]
                    if _NODE.search(part):
                        yield blake2b(part.encode(), digest_size=8).digest(), part

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[bool, dict] = {False: {}, True: {}}
        for name, part in stretches(batches):
            found = bool(base_spans(part))
            waiting[found][name] = part
            if len(waiting[found]) >= 2 * sample:
                waiting[found] = dict(nsmallest(sample, waiting[found].items()))
        rows = [(name, found, part) for found, parts in waiting.items() for name, part in nsmallest(sample, parts.items())]
        yield pa.RecordBatch.from_arrays([
            pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.bool_()),
            pa.array([r[2] for r in rows], pa.string())], ["name", "found", "text"])

    marked = docs.select(F.col(text_column).alias("text")).mapInArrow(run, "name binary, found boolean, text string")
    of = lambda found: marked.filter(F.col("found") == found).orderBy("name").limit(sample)
    return train([r.text for r in of(True).union(of(False)).select("text").collect()])


def find(docs: DataFrame, field: Field | None = None, text_column: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``spans``: lists of (start, kind, end), code points, kind as in ``KINDS``.

    A null text counts as empty and has no spans. All other columns stay; columns named like the new ones
    are replaced. Repeated rows get the same spans each.
    """
    field = field or fit(docs, text_column=text_column)
    kept = [c for c in docs.columns if c not in ("base", "spans")]
    kind = "array<struct<start: long, kind: int, end: long>>"
    arrow = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
    as_rows = lambda found: pa.array(
        [[{"start": a, "kind": k, "end": b} for a, k, b in x] for x in found], arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_chunks(batches, text_column):
            base, spans = [], []
            for raw in texts:
                text = raw.decode() if _MARKED.search(raw) else ""
                base.append(base_spans(text))
                spans.append(sorted(base[-1] + added_spans(text, base[-1], field)))
            yield with_columns(rows, kept, base=as_rows(base), spans=as_rows(spans))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema)
    return docs.select(*kept).mapInArrow(run, f"{fields}, base {kind}, spans {kind}")


def masked(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets, ``n_chars`` counted anew if present."""
    field = field or fit(docs)
    has_size = "n_chars" in docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_chunks(batches):
            if not any(map(_MARKED.search, texts)):
                yield rows
                continue
            new, sizes = [], []
            olds = rows.column(rows.schema.get_field_index("text"))
            old_sizes = rows.column(rows.schema.get_field_index("n_chars")).to_pylist() if has_size else texts
            for raw, null, size in zip(texts, olds.is_null().to_pylist(), old_sizes, strict=True):
                text = raw.decode()
                spans = base_spans(text) if _MARKED.search(raw) else []
                spans = sorted(spans + added_spans(text, spans, field)) if _MARKED.search(raw) else []
                parts, at = [], 0
                for a, k, b in spans:
                    if a >= at:
                        parts += [text[at:a], f"[{KINDS[k]}]"]
                    at = max(at, b)  # a span inside another one goes with it
                out = "".join([*parts, text[at:]])
                new.append(None if null else out)
                sizes.append(len(out) if spans else size)
            columns = {"text": pa.array(new, olds.type)} | ({"n_chars": pa.array(sizes, pa.int64())} if has_size else {})
            yield pa.RecordBatch.from_arrays(
                [columns.get(n, rows.column(i)) for i, n in enumerate(rows.schema.names)], rows.schema.names)

    return docs.mapInArrow(run, docs.schema)


def counted(found: DataFrame) -> DataFrame:
    """Counts of base spans by kind, the digest of their list, and all spans as text."""
    names = F.array(*map(F.lit, KINDS))
    text_of = lambda column: F.array_join(F.transform(
        column, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(text_of("base"), 256).alias("base_sha256"), text_of("spans").alias("spans"))
