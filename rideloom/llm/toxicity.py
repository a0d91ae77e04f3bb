"""Toxicity: a support vector machine on a gap-weighted subsequence kernel with Nyström landmarks.

The kernel compares two words by all their three-letter subsequences that lie within ``SPAN`` letters; one
that covers s letters weighs DECAY ** s on each side. An insult with inserted characters still shares most
of its subsequences with the plain one, and inflected forms share those of their stem. Values are squared,
which is a kernel too and sets chance likeness further apart from real one. A sentence is
compared with a landmark by its nearest word, a document is as toxic as its most toxic sentence.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideloom.llm.batches import text_chunks, with_columns
from rideloom.workspace import cut_lineage

DECAY, SPAN = 0.7, 6
#: Labelled rows of each class that training reads, landmarks, and the least documents that show a landmark.
SAMPLE_ROWS, LANDMARKS, LEAST_DOCS = 6000, 160, 3
#: Least log-likelihood ratio of a landmark, and rounds of choosing each document's sentence.
LEAST_GAIN, CHOICES = 10.0, 3
#: Normalised kernel value under which a word counts as unlike every landmark.
FLOOR = 0.1
#: Longer words are compared by overlapping stretches of this many letters.
STRETCH = 16
_SPACED = re.compile(r"(?<![^\x20\x09-\x0D])(?:[^\W\d_][\x20.*_-]){2,}[^\W\d_](?![^\W_])")
_END = re.compile(r"(?<![.!?])[.!?\n]+[\x20\x09-\x0D]+|\n")
_MAX_CACHED = 400_000
_GAPS = np.array([(0, i, j) for i, j in combinations(range(1, SPAN), 2)], np.int64)
_WEIGHTS = DECAY ** (_GAPS[:, 2] + 1)


#: Letters as numbers under 64; the few that share one do not matter to a similarity. 0: no letter or digit.
_LETTER = np.array([1 + c * 31 % 8191 % 63 if chr(c).isalnum() else 0 for c in range(1 << 16)], np.int64)


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word number, subsequence and its weight, for every subsequence within the span."""
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(owner))
    flat = np.concatenate([_LETTER[points % (1 << 16)], np.zeros(SPAN, np.int64)])
    out_owner, out_key, out_weight = [], [], []
    for (_, i, j), weight in zip(_GAPS.tolist(), _WEIGHTS.tolist(), strict=True):
        at = np.flatnonzero(left > j)
        a, b, c = flat[at], flat[at + i], flat[at + j]
        letters = (a > 0) & (b > 0) & (c > 0)
        out_owner.append(owner[at[letters]])
        out_key.append((a << 12 | b << 6 | c)[letters])
        out_weight.append(np.full(len(out_key[-1]), weight))
    return np.concatenate(out_owner), np.concatenate(out_key), np.concatenate(out_weight)


def _profile(owner: np.ndarray, key: np.ndarray, weight: np.ndarray, n: int):
    """Distinct subsequences of each word with their summed weight, and each word's length in that space."""
    joint, kind = np.unique(owner << 18 | key, return_inverse=True)
    total = np.bincount(kind, weight, len(joint))
    owner, key = joint >> 18, joint & (1 << 18) - 1
    return owner, key, total, np.sqrt(np.bincount(owner, total**2, n))


@dataclass
class Kernel:
    """Kernel values of words against the landmarks, computed once for each word a process meets."""

    landmarks: list[str]
    cache: dict = field(default_factory=dict)
    near: set = field(default_factory=set)

    def __post_init__(self) -> None:
        owner, key, weight, norm = _profile(*subsequences(self.landmarks), len(self.landmarks))
        order = np.argsort(key, kind="stable")  # postings: the landmarks of each subsequence
        self.mark, self.weight = owner[order], (weight / norm[owner])[order]
        keys, self.first, self.size = np.unique(key[order], return_index=True, return_counts=True)
        self.row_of = np.full(1 << 18, -1, np.int64)
        self.row_of[keys] = np.arange(len(keys))
        self.most = np.zeros(1 << 18)
        self.most[keys] = np.maximum.reduceat(self.weight, self.first) if len(keys) else 0.0

    def raw(self, words: list[str]) -> np.ndarray:
        """A row of normalised kernel values for each word."""
        out = np.zeros((len(words), len(self.landmarks)))
        near, values = self.likely(words)
        out[near] = values
        return out

    def likely(self, words: list[str], floor: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """The words that may have a value of ``floor`` or more, by number, and a row of normalised kernel values for each."""
        n, m = len(words), len(self.landmarks)
        if not n or not m:
            return np.zeros(0, np.int64), np.zeros((0, m))
        owner, key, weight = subsequences(words)
        bound = np.bincount(owner, weight * self.most[key], n)
        shortest = np.sqrt(np.bincount(owner, weight**2, n))  # a word's length is at least this
        near = (bound > 0) & (bound >= floor**0.5 * shortest)
        place = np.cumsum(near) - 1
        count = int(near.sum())
        mine = np.flatnonzero(near[owner])
        owner, key, weight = place[owner[mine]], key[mine], weight[mine]
        *_, norm = _profile(owner, key, weight, count)
        row = self.row_of[key]
        hit = np.flatnonzero(row >= 0)
        owner, row, weight = owner[hit], row[hit], weight[hit]
        size = self.size[row]
        ends = np.cumsum(size)
        at = np.repeat(self.first[row] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)
        cell = np.repeat(owner * m, size) + self.mark[at]
        dot = np.bincount(cell, np.repeat(weight, size) * self.weight[at], count * m).reshape(count, m)
        return np.flatnonzero(near), (dot / norm[:, None]) ** 2

    def learn(self, words: set[str]) -> None:
        """Compute what is not known yet of ``words``, in blocks."""
        if len(self.cache) > _MAX_CACHED:
            self.cache.clear()
            self.near.clear()
        new = list(words.difference(self.cache))
        self.cache.update(dict.fromkeys(new))
        short = [w for w in new if len(w) <= STRETCH]
        for start in range(0, len(short), 5000):
            block = short[start : start + 5000]
            likely, values = self.likely(block, FLOOR)
            for i in np.flatnonzero(values.max(1, initial=0) >= FLOOR).tolist():
                self._keep(block[likely[i]], values[i].copy())
        long = [w for w in new if len(w) > STRETCH]
        for start in range(0, len(long), 2000):
            best: dict[str, np.ndarray] = {}
            stretches = ((w, part) for w in long[start : start + 2000] for part in _stretches(w))
            while some := list(islice(stretches, 5000)):
                likely, values = self.likely([part for _, part in some], FLOOR)
                for i, v in zip(likely.tolist(), values, strict=True):
                    best[some[i][0]] = np.maximum(best.get(some[i][0], 0.0), v)
            for word, v in best.items():
                if v.max() >= FLOOR:
                    self._keep(word, v)

    def _keep(self, word: str, values: np.ndarray) -> None:
        self.cache[word] = values
        self.near.add(word)


def _stretches(word: str) -> Iterator[str]:
    step = STRETCH // 2
    for a in range(0, len(word), step * 1000):
        part = word[a : a + step * 1001]
        for i in range(0, len(part), step):
            yield part[i : i + STRETCH]


def spaced_words(text: str) -> list[str]:
    """Runs of single letters as one lower-case word each."""
    return [re.sub(r"[^\w]", "", m[0]).lower() for m in _SPACED.finditer(text)]


def words_of(text: str) -> list[str]:
    """Lower-case words, and runs of single letters as one word each."""
    return text.lower().split() + spaced_words(text)


def sentences(text: str) -> list[str]:
    return [s for s in _END.split(text) if s and not s.isspace()]


def sentence_values(texts: list[str], kernel: Kernel) -> list[np.ndarray]:
    """For each text a row of kernel values for each sentence with a word like a landmark; maybe none."""
    spaced = [spaced_words(t) for t in texts]
    words = [set(t.lower().split()).union(s) for t, s in zip(texts, spaced, strict=True)]
    kernel.learn(set().union(*words))
    near, none = kernel.near, np.zeros((0, len(kernel.landmarks)))
    out = []
    for text, mine, runs in zip(texts, words, spaced, strict=True):
        found, begins = [], []
        # no run of single letters crosses the end of a sentence, so a text without one has none in its sentences
        each = () if near.isdisjoint(mine) else map(words_of, sentences(text)) if runs else map(str.split, sentences(text.lower()))
        for here in each:
            if like := near.intersection(here):
                begins.append(len(found))
                found += [kernel.cache[w] for w in like]
        out.append(np.maximum.reduceat(np.array(found), begins) if found else none)
    return out


@dataclass
class Model:
    """Landmarks, their Nyström map, the separating plane and the logistic scale of its margins."""

    landmarks: list[str]
    project: np.ndarray
    plane: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def margins(self, values: np.ndarray) -> np.ndarray:
        return values @ self.project @ self.plane + self.bias

    def score(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -40, 40)))


def _svm(x: np.ndarray, y: np.ndarray, steps: int = 60, cost: float = 10.0) -> tuple[np.ndarray, float]:
    """Squared-hinge linear machine by Newton steps; classes weigh alike."""
    z = np.column_stack([x, np.ones(len(x))])
    sign = np.where(y > 0, 1.0, -1.0)
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y <= 0).sum(), 1)) * cost * len(y) ** 0.5
    w = np.zeros(z.shape[1])
    ridge = np.eye(z.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(steps):
        slack = 1 - sign * (z @ w)
        on = slack > 0
        g = ridge @ w - z[on].T @ (share[on] * sign[on] * slack[on])
        h = ridge + (z[on] * share[on, None]).T @ z[on]
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def _platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through the training margins, with smoothed targets."""
    up, down = (y > 0).sum(), (y <= 0).sum()
    t = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    z = np.column_stack([margin, np.ones(len(margin))])
    w = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        h = (z * (p * (1 - p))[:, None]).T @ z + 1e-6 * np.eye(2)
        w -= np.clip(np.linalg.solve(h, z.T @ (p - t)), -2, 2)
    return float(max(w[0], 1e-3)), float(w[1])


def training_rows(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Texts and labels of at most ``sample_rows`` documents of each class whose id is not held out.

    The ids with the smallest hash are taken, so the joined list of ids has a fixed bound and is sent to
    every executor. Null labels and ids are left out; of repeated labels the largest counts.
    """
    ids = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    ids = ids.dropna().filter(F.col("toxic").isin(0, 1) & ~held_out()).groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"))
    order = (F.xxhash64("doc_id"), "doc_id")
    chosen = ids.filter("toxic = 1").orderBy(*order).limit(sample_rows).union(
        ids.filter("toxic = 0").orderBy(*order).limit(sample_rows))
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").dropna()
    return read.join(F.broadcast(chosen), "doc_id").select("text", "toxic")


def landmarks(rows: DataFrame, most: int = LANDMARKS, least_docs: int = LEAST_DOCS) -> list[str]:
    """The words that tell toxic documents best from the others, by the log-likelihood ratio of document counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_chunks(batches):
            toxic = part.column(part.schema.get_field_index("toxic")).to_pylist()
            counts: dict[str, list[int]] = {}
            for text, label in zip(texts, toxic, strict=True):
                for w in set(words_of(text.decode())):
                    w = w.strip(".,;:!?\"'()[]#*$%&|<>")
                    if 3 <= len(w) <= STRETCH:
                        counts.setdefault(w, [0, 0])[label] += 1
            yield pa.RecordBatch.from_arrays([
                pa.array(counts.keys(), pa.string()), pa.array([c[1] for c in counts.values()], pa.int64()),
                pa.array([c[0] for c in counts.values()], pa.int64())], names=["word", "toxic", "clean"])

    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n_toxic, n_clean = float(sizes.get(1, 0)), float(sizes.get(0, 0))
    if not n_toxic or not n_clean:
        return []
    t, c = F.col("toxic"), F.col("clean")
    share = (t + c) / F.lit(n_toxic + n_clean)
    gain = t * F.log(t / (share * n_toxic)) + F.when(c > 0, c * F.log(c / (share * n_clean))).otherwise(0.0)
    counted = rows.mapInArrow(run, "word string, toxic long, clean long").groupBy("word").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    told = counted.filter((t >= least_docs) & (t / n_toxic > 2 * c / n_clean) & (gain >= LEAST_GAIN)).orderBy(gain.desc(), "word").limit(most)
    return [r["word"] for r in told.select("word").collect()]


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Train on a bounded sample of the labelled rows.

    A sentence takes its document's label, and a document brings one sentence: first the one most like the
    landmarks, then, in further rounds, the one with the largest margin so far. Clean documents keep those
    of earlier rounds too, so that a text does not look toxic only because it is long. Without both labels
    every document gets the same low score.
    """
    rows = cut_lineage(training_rows(docs, labels, sample_rows), "toxicity-sample")
    marks = landmarks(rows)
    if not marks:
        return Model([], np.zeros((0, 0)), np.zeros(0), -1.0)
    size, axes = np.linalg.eigh(Kernel(marks).raw(marks))
    keep = size > 1e-3 * size.max()
    model = Model(marks, axes[:, keep] / np.sqrt(size[keep]), np.zeros(0), 0.0)
    values, y = _chosen(rows, model)
    for _ in range(CHOICES - 1):
        model.plane, model.bias = _svm(values @ model.project, y)
        more, labels_of = _chosen(rows, model)
        clean = y == 0
        values, y = np.concatenate([values[clean], more]), np.concatenate([y[clean], labels_of])
    model.plane, model.bias = _svm(values @ model.project, y)
    last, labels_of = _chosen(rows, model)
    model.slope, model.shift = _platt(model.margins(last), labels_of)
    return model


def _chosen(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """One sentence of each document in the sample and the documents' labels; one short row for each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel = Kernel(model.landmarks)
        none = np.zeros((1, len(model.landmarks)))
        for part, texts in text_chunks(batches):
            best = []
            for found in sentence_values([t.decode() for t in texts], kernel):
                found = np.concatenate([found, none])
                rank = model.margins(found) if len(model.plane) else found.sum(1)
                best.append(found[rank.argmax()].astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [part.column(part.schema.get_field_index("toxic")).cast(pa.int32()), pa.array(best, pa.binary())],
                names=["toxic", "sentence"])

    found = rows.mapInArrow(run, "toxic int, sentence binary").collect()
    values = np.array([np.frombuffer(r["sentence"], "<f4") for r in found], float)
    return values, np.array([r["toxic"] for r in found])


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """``doc_id``, ``score`` from 0 to 1 and ``predicted`` (1 from ``threshold`` on) of every whole text.

    Only the text is used. A null or empty text scores like one without any word near a landmark. Rows
    with equal ids are scored one by one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel = Kernel(model.landmarks)
        none = model.margins(np.zeros((1, len(model.landmarks))))[0] if model.landmarks else model.bias
        for rows, texts in text_chunks(batches):
            margins = np.full(len(texts), none)
            found = sentence_values([t.decode() for t in texts], kernel) if model.landmarks else []
            for i, values in enumerate(found):
                if len(values):
                    margins[i] = max(none, model.margins(values).max())
            scores = model.score(margins)
            yield with_columns(rows, ["doc_id"], score=scores, predicted=pa.array(
                (scores >= threshold).astype(np.int32)))

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return narrow.mapInArrow(run, "doc_id long, score double, predicted int")


def held_out(doc_id: str = "doc_id", parts: int = 4, part: int = 2):
    """Whether a row is kept from training: CRC-32 of the id in digits."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(parts)) == part


def is_held_out(doc_id: int, parts: int = 4, part: int = 2) -> bool:
    return zlib.crc32(str(doc_id).encode()) % parts == part
