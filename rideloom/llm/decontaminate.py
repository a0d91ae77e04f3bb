"""Benchmark decontamination: search for passages like a benchmark item, exact checks, latent semantic cosines.

Stretches of text that hold enough of an item's rarest words, counted through an inverted index so that none is
missed, are compared with the item word by word, by the longest common subsequence. Passages are windows of words as
TF-IDF vectors over the benchmark's terms; a randomised SVD of all of them, the items among them, gives a latent space
that is searched for passages close to an item. Where most but not nearly all of an item's words are there in order, it
has leaked if its end, its answer, is there too, or if a passage is close to it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideloom.llm.batches import WordHashes, text_chunks, with_columns
from rideloom.workspace import cut_lineage

#: Words of half a passage, dimensions of the latent space and how many more its sketch has, items that are searched
#: for at once.
HALF, RANK, MORE_COLUMNS, BLOCK_ITEMS = 32, 128, 16, 8192
#: Terms in a larger share of passages are left out of the latent space, unless their item would keep fewer terms than this.
MOST_SHARE, LEAST_TERMS = 0.05, 8
#: Shares of an item's words in order that are a leak alone and with the answer or a close passage, cells held at once.
SURE, LIKELY, MOST_CELLS = 0.8, 0.6, 1 << 22
#: Least cosine of a close passage in the latent space.
CLOSE = 0.75
#: Half passages whose terms are counted in one dense matrix.
DENSE_HALVES = 64
ANSWER_WORDS = 4
#: Matrices of tasks that one task adds up, and rounds of it; what is left after them is added on the driver.
FAN_IN, LEVELS = 100, 3
_SUMS = "block long, part long, sums binary"
_PUNCTUATION = b".,;:!?\"'()[]{}#*$%&|<>-_"


class _Terms:
    """Words in lower case without punctuation around them."""

    def of(self, words: list[bytes]) -> np.ndarray:
        out = np.empty(len(words), object)
        out[:] = [w.lower().strip(_PUNCTUATION) for w in words]
        return out


def common_in_order(item: np.ndarray, words: np.ndarray) -> int:
    """Length of the longest common subsequence, by bits of one integer for each word of ``words``."""
    places: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        places[w] = places.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    for w in words.tolist():
        match = row & places.get(w, 0)
        if match:
            row = (row + match | row - match) & full
    return len(item) - row.bit_count()


def contains(words: np.ndarray, run: np.ndarray) -> bool:
    if not len(run) or len(words) < len(run):
        return False
    windows = np.lib.stride_tricks.sliding_window_view(words, len(run))
    return bool((windows == run).all(1).any())


@dataclass
class Benchmark:
    """Items as places among the terms, and the latent space: ``terms`` in order, a row of ``space`` (weight x right singular
    vectors) for each and whether its weight is not zero, item vectors of length one, singular values of the weighted passages. The index: ``postings``
    from ``first`` of a term are the items with it among their rarest words, once for each place; of these words
    ``least`` must be in a stretch of ``halves`` half passages.
    """

    ids: list[int]
    items: list[np.ndarray]
    terms: np.ndarray
    space: np.ndarray
    weighed: np.ndarray
    vectors: np.ndarray
    singular: np.ndarray
    first: np.ndarray
    postings: np.ndarray
    least: np.ndarray
    halves: np.ndarray


def _terms_in(texts: pa.Array, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every word's place among ``terms``, -1 for others, one text after the other, and words of each text.

    Words are those that ``_Terms`` takes from split texts; a null text has none.
    """
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words, ends = split.flatten(), split.offsets.to_numpy()
    real = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0  # spaces at a text's begin or end leave empty ones
    if not real.all():
        words, ends = words.filter(pa.array(real)), np.append(0, np.cumsum(real))[ends]
    plain = pc.ascii_trim(pc.ascii_lower(words), characters=_PUNCTUATION.decode()).cast(pa.binary())
    at = pc.index_in(plain, value_set=pa.array(terms, pa.binary()))
    return pc.fill_null(at, -1).to_numpy(), np.diff(ends)


def _halves(words: np.ndarray, sizes: np.ndarray):
    """Known ones of ``words`` (places among the terms, ``sizes`` per document), their half passage, halves per document."""
    halves = -(-sizes // HALF)
    first = np.cumsum(halves) - halves
    known = np.flatnonzero(words >= 0)
    owner = np.repeat(np.arange(len(sizes)), sizes)[known]
    return words[known], first[owner] + (known - (np.cumsum(sizes) - sizes)[owner]) // HALF, halves, first


def _followed(halves: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The half passages that another one of the same text follows."""
    followed = np.ones(int(halves.sum()), bool)
    followed[(first + halves - 1)[halves > 0]] = False
    return np.flatnonzero(followed)


def _sum_rows(found: DataFrame, columns: int) -> np.ndarray:
    """Sum of the matrices of all tasks, sent as blocks of rows and added up by block, ``FAN_IN`` at a time."""
    def add(table: pa.Table) -> pa.Table:
        total = reduce(np.add, (np.frombuffer(x, float) for x in table["sums"].to_pylist()))
        return table.slice(0, 1).select(["block", "part"]).append_column("sums", pa.array([total.tobytes()], pa.binary()))

    for _ in range(LEVELS):
        found = found.withColumn("part", F.floor(F.col("part") / FAN_IN)).groupBy("block", "part").applyInArrow(add, _SUMS)
    parts: dict[int, np.ndarray] = {}
    for r in found.toLocalIterator():
        sums = np.frombuffer(r["sums"], float)
        parts[r["block"]] = parts[r["block"]] + sums if r["block"] in parts else sums
    return np.concatenate([parts[i] for i in sorted(parts)]).reshape(-1, columns) if parts else np.zeros((0, columns))


def _blocks(matrix: np.ndarray, part: int, rows: int = 256) -> pa.RecordBatch:
    starts = range(0, len(matrix), rows)
    return pa.RecordBatch.from_arrays([
        pa.array([s // rows for s in starts], pa.int64()), pa.array([part] * len(starts), pa.int64()),
        pa.array([matrix[s : s + rows].tobytes() for s in starts], pa.binary())], names=["block", "part", "sums"])


class _Counts:
    """How often each term (of ``terms``) is in each of ``count`` half passages, for sums over its rows and columns.

    Dense matrices of ``DENSE_HALVES`` rows, with columns for the terms that are there.
    """

    def __init__(self, at: np.ndarray, half: np.ndarray, count: int, terms: int) -> None:
        self.count, self.blocks = count, []
        column = np.zeros(terms, np.int64)
        starts = np.arange(0, count, DENSE_HALVES)
        edges = np.append(np.searchsorted(half, starts), len(half))
        for a, begin, end in zip(starts.tolist(), edges, edges[1:], strict=False):
            mine = at[begin:end]
            kinds = np.flatnonzero(np.bincount(mine, minlength=terms))
            column[kinds] = np.arange(len(kinds))
            shape = (min(DENSE_HALVES, count - a), len(kinds))
            dense = np.bincount((half[begin:end] - a) * len(kinds) + column[mine], minlength=shape[0] * shape[1])
            self.blocks.append((slice(a, a + shape[0]), kinds, dense.reshape(shape).astype(np.uint8)))  # HALF at most

    def halves_with(self, total: np.ndarray) -> None:
        """Add to each term's place in ``total`` the number of half passages that hold it."""
        for _, kinds, dense in self.blocks:
            total[kinds] += np.count_nonzero(dense, axis=0)

    def rows(self, matrix: np.ndarray) -> np.ndarray:
        """For each half passage the sum of its terms' rows of ``matrix``."""
        out = np.zeros((self.count, matrix.shape[1]), np.float32)
        for here, kinds, dense in self.blocks:
            out[here] = dense.astype(np.float32) @ matrix[kinds]
        return out

    def add_columns(self, rows: np.ndarray, total: np.ndarray) -> None:
        """Add to each term's row of ``total`` the ``rows`` of the half passages with it."""
        for here, kinds, dense in self.blocks:
            total[kinds] += dense.astype(np.float32).T @ rows[here]


def _add_products(words: np.ndarray, sizes: np.ndarray, start: np.ndarray, total: np.ndarray) -> None:
    """Add to ``total`` in how many half passages each term is (column 0, their number in the last row), and
    (passages transposed) x passages x ``start``. A passage is a half with the next one of its text.
    """
    at, half, halves, first = _halves(words, sizes)
    total[-1, 0] += halves.sum()
    if not len(at):
        return
    counts = _Counts(at, half, int(halves.sum()), len(start))
    counts.halves_with(total[:-1, 0])
    seen, ahead = counts.rows(start), _followed(halves, first)
    passages = seen.copy()
    passages[ahead] += seen[ahead + 1]
    back = passages.copy()
    back[ahead + 1] += passages[ahead]
    counts.add_columns(back, total[:-1, 1:])


def _survey(texts: DataFrame, terms: np.ndarray, start: np.ndarray) -> np.ndarray:
    """One pass over all texts: what ``_add_products`` sums up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(terms) + 1, start.shape[1] + 1))
        narrow = start.astype(np.float32)
        for rows, _ in text_chunks(batches):
            _add_products(*_terms_in(rows.column("text"), terms), narrow, total)
        yield _blocks(total, TaskContext.get().partitionId())

    found = _sum_rows(texts.mapInArrow(run, _SUMS), start.shape[1] + 1)
    return found if len(found) else np.zeros((len(terms) + 1, start.shape[1] + 1))


def _index(places: list[np.ndarray], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``first``, ``postings``, ``least`` and ``halves`` of items given as places of their words among the terms.

    Wherever one and a half times an item's length begins in a text, some stretch holds it whole.
    """
    sizes = np.array([len(at) for at in places])
    needed = np.maximum(np.ceil(LIKELY * sizes - 1e-9).astype(np.int64), 1)
    least = np.maximum(needed // 3, 1)
    kept = [at[np.argsort(counts[at], kind="stable")[: len(at) - drop]]  # all but the commonest words
            for at, drop in zip(places, needed - least, strict=True)]
    at, item = np.concatenate(kept), np.repeat(np.arange(len(kept)), [len(k) for k in kept])
    first = np.append(0, np.cumsum(np.bincount(at, minlength=len(counts))))
    return first, item[np.argsort(at, kind="stable")], least, np.maximum(4, np.ceil(1.5 * sizes / HALF).astype(np.int64) + 1)


def _item_blocks(benchmark: DataFrame) -> list[DataFrame]:
    """The items in blocks of about ``BLOCK_ITEMS``, dealt out by their id and text, however they are partitioned."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").dropna()
    parts = -(-items.count() // BLOCK_ITEMS)
    if parts <= 1:
        return [items]
    items = cut_lineage(items.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))), "items")
    return [items.filter(F.col("part") == i).drop("part") for i in range(parts)]


def fit(texts: DataFrame, benchmark: DataFrame, rank: int = RANK, seed: int = 3) -> Benchmark:
    """The latent space of all passages of ``texts`` (column ``text``) and ``benchmark`` (``item_id``, ``text``).

    The benchmark, one block of items, is sent everywhere; items without a word and null ids are left out. The randomised SVD takes
    two passes over all texts: one counts the terms and sketches the range of the weighted passages from random
    columns, the other multiplies them with that range, which gives singular values and vectors.
    """
    rows = benchmark.select(F.col("item_id").cast("long"), "text").dropna().collect()
    named = [(i, _Terms().of(t.encode().split())) for i, t in sorted(rows)]
    named = [(i, words) for i, words in named if len(words)]
    ids, items = [i for i, _ in named], [w for _, w in named]
    terms = np.unique(np.concatenate(items)) if items else np.zeros(0, object)
    terms = terms[np.argsort(WordHashes().of(terms.tolist()))]  # random columns depend on a term's hash, not on its letters
    if not len(terms):
        return Benchmark([], [], terms, np.zeros((0, 0)), np.zeros(0, bool), np.zeros((0, 0)), *[np.zeros(0)] * 5)
    number = {w: i for i, w in enumerate(terms)}
    places = [np.array([number[w] for w in words]) for words in items]
    texts = texts.select("text")

    def products(start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts in the texts, and the product with all passages, the items' among them; of terms with a weight only."""
        used = np.flatnonzero(start.any(1))
        own = np.zeros((len(terms) + 1, start.shape[1] + 1))
        _add_products(np.concatenate(places), np.array([len(at) for at in places]), start.astype(np.float32), own)
        own[:, 0] = 0
        own[np.append(used, -1)] += _survey(texts, terms[used], start[used])
        return own[:, 0], own[:-1, 1:]

    random = np.random.default_rng(seed)
    prior = np.zeros(len(terms))
    for at in places:
        prior[np.unique(at)] += 1
    prior = np.log((len(items) + 1) / (prior + 1)) + 1
    counts, sketch = products(prior[:, None] * random.normal(size=(len(terms), min(rank + MORE_COLUMNS, len(terms)))))
    counts, passages = counts[:-1], counts[-1]
    rare = counts <= MOST_SHARE * max(passages, 1)
    for at in places:
        if rare[np.unique(at)].sum() < LEAST_TERMS:
            rare[at] = True
    # weights only scale the columns of the passages, so they enter the sketch after the pass that counts
    weights = np.where(rare, np.log((passages + 1) / (counts + 1)) + 1, 0.0)[:, None]
    base, _ = np.linalg.qr(weights * sketch)
    image = weights * products(weights * base)[1]
    values, turn = np.linalg.eigh((base.T @ image + image.T @ base) / 2)
    good = values > 1e-6 * max(values[-1], 1e-12)
    right, singular, _ = np.linalg.svd(image @ (turn[:, good] / np.sqrt(values[good])), full_matrices=False)
    right, singular = right[:, :rank], singular[:rank]
    space = (weights * right).astype(np.float32)
    vectors = np.array([space[at].sum(0) for at in places])
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    return Benchmark(ids, places, terms, space, weights[:, 0] > 0, vectors, singular, *_index(places, counts))


def _candidates(
    at: np.ndarray, half: np.ndarray, halves: np.ndarray, first: np.ndarray, known: Benchmark
) -> Iterator[tuple[int, int, bool]]:
    """First half passages of stretches, the items with enough of their rarest words in them, and whether the search of
    the latent space, every passage against every item, has a passage of the stretch close to the item.

    A leaked item has ``LIKELY`` of its words in the stretch, so of any subset of them all but what may be missing;
    no pair that the exact check would report is left out. Stretches may run into the next text here.
    """
    terms, items, count = len(known.terms), len(known.items), int(halves.sum())
    weighed = known.weighed[at]
    passages, ahead = _Counts(at[weighed], half[weighed], count, terms).rows(known.space), _followed(halves, first)
    passages[ahead] += passages[ahead + 1]
    passages /= np.maximum(np.linalg.norm(passages, axis=1, keepdims=True), 1e-12)
    vectors = known.vectors.T.astype(np.float32)
    pairs = np.unique((half * terms + at)[known.first[at + 1] > known.first[at]])
    half, at = pairs // terms, pairs % terms
    sizes = known.first[at + 1] - known.first[at]
    widest = int(known.halves.max())
    rows = max(256, MOST_CELLS // items)
    for a in range(0, count, rows):
        b, end = min(a + rows, count), min(a + rows + widest - 1, count)
        mine = slice(*np.searchsorted(half, [a, end]))
        size = sizes[mine]
        ends = np.cumsum(size)
        here = np.repeat(known.first[at[mine]] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)
        cells = np.repeat(half[mine] - a, size) * items + known.postings[here]
        until = np.zeros((end - a + 1, items), np.int32)
        np.cumsum(np.bincount(cells, minlength=(end - a) * items).reshape(-1, items), axis=0, out=until[1:])
        near = passages[a:end] @ vectors >= CLOSE
        for width in np.unique(known.halves):
            mine = np.flatnonzero(known.halves == width)
            part = until if len(mine) == items else until[:, mine]
            enough = part[np.minimum(np.arange(b - a) + width, end - a)] - part[: b - a] >= known.least[mine]
            row, column = np.nonzero(enough)
            item, close = mine[column], np.zeros(len(row), bool)
            for i in range(width - 1):  # a passage is two halves
                close |= near[np.minimum(row + i, end - a - 1), item]
            yield from zip((row + a).tolist(), item.tolist(), close.tolist(), strict=True)


def _cosine(words: np.ndarray, item: int, known: Benchmark) -> float:
    """The largest cosine of the item and a passage of ``words`` in the latent space."""
    at, half, halves, _ = _halves(words, np.array([len(words)]))
    seen = _Counts(at, half, int(halves[0]), len(known.terms)).rows(known.space)
    passages = seen.copy()
    passages[:-1] += seen[1:]
    return float((passages @ known.vectors[item] / np.maximum(np.linalg.norm(passages, axis=1), 1e-12)).max())


def _leaks(texts: pa.Array, known: Benchmark) -> list[tuple[int, int, float, float, bool]]:
    """Text number, item, cosine, share in order, answer found; the best stretch of each leaked item."""
    every, sizes = _terms_in(texts, known.terms)
    at, half, halves, first = _halves(every, sizes)
    if not len(at):
        return []
    owner, ends = np.repeat(np.arange(len(sizes)), halves), np.cumsum(sizes)
    plain = [item.tolist() for item in known.items]
    best: dict[tuple[int, int], tuple[float, float, bool]] = {}
    stretch, there = slice(0), set()
    for p, item, close in _candidates(at, half, halves, first, known):
        i = int(owner[p])
        place = int(ends[i] - sizes[i]) + (p - int(first[i])) * HALF
        here, wanted = slice(place, min(place + int(known.halves[item]) * HALF, int(ends[i]))), known.items[item]
        if here != stretch:
            stretch, words = here, every[here]
            there = set(words.tolist())
        if sum(map(there.__contains__, plain[item])) < LIKELY * len(wanted):
            continue  # fewer words in common, in whatever order
        share = common_in_order(wanted, words) / len(wanted)
        if share < LIKELY:
            continue
        answer = contains(words, wanted[-ANSWER_WORDS:])
        if share >= SURE or answer or close:
            found = (share, _cosine(words, item, known), answer)
            best[i, item] = max(found, best.get((i, item), found))
    return [(i, known.ids[item], cosine, share, answer) for (i, item), (share, cosine, answer) in sorted(best.items())]


def _shared(docs: DataFrame, benchmark: DataFrame, known: Benchmark | None = None) -> Iterator[Broadcast]:
    """Each block of items with its latent space, sent everywhere; the driver holds one at a time."""
    context = docs.sparkSession.sparkContext
    if known:
        yield context.broadcast(known)
        return
    for block in _item_blocks(benchmark):
        yield context.broadcast(fit(docs, block))


def leaks(docs: DataFrame, benchmark: DataFrame, known: Benchmark | None = None) -> DataFrame:
    """Leaked items: a row for each document and benchmark item that it contains, copied or paraphrased.

    Columns: ``doc_id``, ``item_id``, ``cosine``, ``in_order`` (share of the item's words found in order),
    ``answer`` (its last words are there). Every stretch of every whole text is compared with all items. Null
    and empty texts and an empty benchmark give no row; repeated rows give theirs each.
    """
    def search(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows, _ in text_chunks(batches):
                found = _leaks(rows.column("text"), shared.value)
                columns = list(zip(*found, strict=True)) if found else [[]] * 5
                yield with_columns(
                    rows.take(pa.array(columns[0], pa.int64())), ["doc_id"], item_id=pa.array(columns[1], pa.int64()),
                    cosine=pa.array(columns[2], pa.float64()), in_order=pa.array(columns[3], pa.float64()),
                    answer=pa.array(columns[4], pa.bool_()))

        return narrow.mapInArrow(run, "doc_id long, item_id long, cosine double, in_order double, answer boolean")

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return reduce(DataFrame.union, map(search, _shared(docs, benchmark, known)))


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, without a leaked item."""
    def without(docs: DataFrame, shared: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows, _ in text_chunks(batches):
                kept = np.ones(rows.num_rows, bool)
                kept[[i for i, *_ in _leaks(rows.column("text"), shared.value)]] = False
                yield rows.filter(pa.array(kept))

        return docs.mapInArrow(run, docs.schema)

    return reduce(without, _shared(docs, benchmark), docs)
