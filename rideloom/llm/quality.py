"""Quality rules: statistics of a text, fixed rules on them, and an isolation forest for what the rules miss."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideloom.llm.batches import WordHashes, grams, text_chunks, with_columns
from rideloom.workspace import cut_lineage

_BLANK = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DIGITS = b"0123456789"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_lines", "n_upper", "n_digits", "n_marks")
#: Labelled rows whose statistics the trees are grown from, and the size of the forest.
SAMPLE_ROWS, TREES, TREE_ROWS = 4096, 128, 256
#: Largest share of labelled good rows that the calibrated threshold may reject.
MOST_GOOD_REJECTED = 0.003
_BINS = 2000


def statistics(text: bytes, hashes: WordHashes) -> tuple[int, ...]:
    """The counts named by ``BASE`` and ``MORE`` for one text."""
    words = text.split()
    n = len(words)
    if not n:
        return (0,) * (len(BASE) + len(MORE))
    seen_lines, lines, repeated = set(), 0, 0
    for line in text.split(b"\n"):
        if line and not line.isspace():
            lines += 1
            seen_lines.add(line)
    if n >= 3:
        windows = grams(hashes.of(words), 3)
        _, kind, count = np.unique(windows, return_inverse=True, return_counts=True)
        again = count[kind] > 1
        if again.any():
            covered = np.zeros(n, bool)
            for i in range(3):
                covered[i : n - 2 + i] |= again
            repeated = int(covered.sum())
    letters = text.translate(None, _BLANK)
    size = len(letters)
    return (
        n, len(letters.decode()), size - len(letters.translate(None, _SYMBOLS)), lines - len(seen_lines), repeated,
        lines, size - len(letters.translate(None, _UPPER)), size - len(letters.translate(None, _DIGITS)),
        size - len(letters.translate(None, b"!?;:=_/\\")),
    )


def ratios(counts: np.ndarray) -> np.ndarray:
    """What the trees split on: shares that do not depend on a text's length. ``counts``: a row for each text."""
    n, chars, symbols, dup, repeat, lines, upper, digits, marks = np.maximum(counts, 0).T.astype(float)
    words, letters, rows = np.maximum(n, 1), np.maximum(chars, 1), np.maximum(lines, 1)
    return np.column_stack([
        symbols / words, dup / rows, repeat / words, chars / words, upper / letters, digits / letters, marks / words,
    ])


def base_failed(counts: np.ndarray, least_words: int = 50, most_repeated: int = 50) -> np.ndarray:
    n, repeat = counts[:, 0], counts[:, 4]
    return (n < least_words) | (100 * repeat > most_repeated * n)


@dataclass(frozen=True)
class Forest:
    """Isolation trees as arrays: ``feature`` (-1 in a leaf), ``cut``, ``left`` and ``right`` child, ``depth``."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    depth: np.ndarray
    roots: np.ndarray
    rows: int
    threshold: float = np.inf

    def score(self, values: np.ndarray) -> np.ndarray:
        """2 ** (-mean path length / expected length): near 1 for rows that few splits set apart."""
        total = np.zeros(len(values))
        every = np.arange(len(values))
        for root in self.roots:
            at = np.full(len(values), root)
            while True:
                inner = self.feature[at] >= 0
                if not inner.any():
                    break
                f = np.maximum(self.feature[at], 0)
                below = values[every, f] < self.cut[at]
                at = np.where(inner, np.where(below, self.left[at], self.right[at]), at)
            total += self.depth[at]
        return 2.0 ** (-total / max(len(self.roots), 1) / max(_average_path(self.rows), 1e-9))


def _average_path(n: int) -> float:
    """Mean length of an unsuccessful search in a binary tree over n rows."""
    return 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else float(n == 2)


def feature_weights(values: np.ndarray, good: np.ndarray) -> np.ndarray:
    """How well each statistic alone ranks the labelled rows: (2 AUC - 1) ** 8, and a little for every one."""
    out = np.full(values.shape[1], 0.002)
    if good.any() and not good.all():
        for i, column in enumerate(values.T):
            _, kind, count = np.unique(column, return_inverse=True, return_counts=True)
            rank = (np.cumsum(count) - (count - 1) / 2)[kind]  # ties share their mean rank
            n = good.sum()
            auc = (rank[good].sum() - n * (n + 1) / 2) / (n * (len(good) - n))
            out[i] += (2 * auc - 1) ** 8
    return out / out.sum()


def grow(
    values: np.ndarray, weights: np.ndarray | None = None, trees: int = TREES, tree_rows: int = TREE_ROWS,
    seed: int = 7,
) -> Forest:
    """A forest over the sample ``values``; a tree takes ``tree_rows`` of them and splits at random.

    ``weights`` are the chances of the statistics to be split on, equal ones if None.
    """
    weights = np.ones(values.shape[1]) if weights is None else weights
    random = np.random.default_rng(seed)
    size = min(tree_rows, len(values))
    deepest = int(np.ceil(np.log2(max(size, 2))))
    nodes: list[list] = []
    roots = []

    def add(rows: np.ndarray, depth: int) -> int:
        me = len(nodes)
        nodes.append([-1, 0.0, -1, -1, depth + _average_path(len(rows))])
        low, high = (rows.min(0), rows.max(0)) if len(rows) else (np.zeros(0), np.zeros(0))
        open_features = np.flatnonzero(high > low)
        if depth < deepest and len(rows) > 1 and len(open_features):
            p = weights[open_features]
            f = random.choice(open_features, p=p / p.sum())
            cut = random.uniform(low[f], high[f])
            below = rows[:, f] < cut
            nodes[me][:4] = [f, cut, add(rows[below], depth + 1), add(rows[~below], depth + 1)]
        return me

    for _ in range(trees if size else 0):
        roots.append(add(values[random.choice(len(values), size, replace=False)], 0))
    columns = list(zip(*nodes, strict=True)) if nodes else [()] * 5
    kinds = (np.int64, float, np.int64, np.int64, float)
    return Forest(*(np.array(c, k) for c, k in zip(columns, kinds, strict=True)), np.array(roots, np.int64), size)


def with_statistics(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and the counts of every whole text; a null text counts as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for rows, texts in text_chunks(batches):
            counts = np.array([statistics(t, hashes) for t in texts], np.int64)
            yield with_columns(rows, ["doc_id"], **dict(zip(BASE + MORE, counts.T, strict=True)))

    narrow = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return narrow.mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in BASE + MORE))


def _counts_of(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([batch.column(batch.schema.get_field_index(c)).to_numpy() for c in BASE + MORE])


def judged(counts: DataFrame, forest: Forest) -> DataFrame:
    """The counts with ``base_failed``, ``anomaly`` (the forest's score) and ``kept``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _counts_of(batch)
            failed, score = base_failed(values), forest.score(ratios(values))
            yield with_columns(
                batch, batch.schema.names, base_failed=failed, anomaly=score,
                kept=~failed & (score <= forest.threshold),
            )

    fields = ", ".join(f"{name} {kind}" for name, kind in counts.dtypes)
    return counts.mapInArrow(run, f"{fields}, base_failed boolean, anomaly double, kept boolean")


def fit(counts: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> Forest:
    """Grow the forest on at most ``sample_rows`` labelled rows and set its threshold from all of them.

    The rows of the sample are those with the smallest hash of their id. All labelled rows that pass the
    fixed rules are then scored and counted by score and label; the threshold is the score that parts the
    two labels best while no more than ``MOST_GOOD_REJECTED`` of the good rows lie above it. Without labels
    of both kinds nothing is rejected beyond the fixed rules. Null labels and ids are left out; of repeated
    labels the largest counts.
    """
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    marks = marks.dropna().groupBy("doc_id").agg(F.max("quality").alias("quality"))
    known = cut_lineage(counts.join(marks, "doc_id"), "labelled-statistics")
    sample = known.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(sample_rows)
    columns = [*BASE, *MORE, "quality"]
    rows = np.array([tuple(r) for r in sample.select(*columns).collect()], np.int64).reshape(-1, len(columns))
    rows = rows[~base_failed(rows)]
    values = ratios(rows[:, :-1])
    forest = grow(values, feature_weights(values, rows[:, -1] == 1), seed=seed)
    scored = judged(known, forest).filter("not base_failed")
    table = scored.groupBy(F.floor(F.col("anomaly") * _BINS).cast("int").alias("bin")).agg(
        F.sum((F.col("quality") == 1).cast("long")).alias("good"),
        F.sum((F.col("quality") == 0).cast("long")).alias("bad"))
    good, bad = np.zeros(_BINS + 1), np.zeros(_BINS + 1)
    for r in table.collect():  # a row for each of the bins at most
        good[r["bin"]], bad[r["bin"]] = r["good"], r["bad"]
    if not good.sum() or not bad.sum():
        return forest
    good_above, bad_above = (np.cumsum(x[::-1])[::-1] / x.sum() for x in (good, bad))
    gain = np.where(good_above <= MOST_GOOD_REJECTED, bad_above - good_above, -1)
    best = int(np.argmax(gain))
    return Forest(**{**forest.__dict__, "threshold": best / _BINS}) if gain[best] > 0 else forest


def rate(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics and verdict of every document; other columns of ``docs`` are not read.

    Empty and null texts have no words and fail the fixed rules. Repeated ids are rated row by row.
    """
    counts = cut_lineage(with_statistics(docs), "statistics")
    return judged(counts, fit(counts, labels))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that :func:`rate` keeps. Texts are judged where they are read."""
    forest = fit(cut_lineage(with_statistics(docs), "statistics"), labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for rows, texts in text_chunks(batches):
            values = np.array([statistics(t, hashes) for t in texts], np.int64)
            kept = ~base_failed(values)
            kept[kept] = forest.score(ratios(values[kept])) <= forest.threshold
            yield rows.filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)
