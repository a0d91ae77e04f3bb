"""Katz back-off bigram scores: Good-Turing discounts, exactly normalised back-off weights, tables for lookup.

Counts and the model are Spark tables. The ``HEAD`` commonest words have numbers, which every executor knows with
their values; every other word is its hash. A pair of two head words lies in a bucket by its words, any other
pair in the bucket of each of its rare words, so a bucket holds all that its own rare words occur with. Between text
and tables only packed pairs move: a task sends, for every bucket, the pairs of its texts once each and the places
where they occur, and gets back sums for its documents. Pairs that make up a ``HEAD``-th of the corpus or more
number at most ``HEAD``; they are sent to every executor too and never shuffled, and the pairs of a common first
word are spread over buckets, so none gets hot.
"""

from __future__ import annotations

import gc
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rideloom.llm.batches import WordHashes, give_back, mixed, signed, text_chunks
from rideloom.workspace import cut_lineage, forget

#: Words with a number (one number is the start's), at most 65,536; also the bound on pairs that every executor knows.
HEAD = 1 << 16
#: Counts that Good-Turing discounts, least count of a bigram (all are stored), tokens for each bucket of a shuffle.
DISCOUNTED, LEAST_PAIR, BUCKET_TOKENS = 7, 1, 4_000_000
# The highest bit is set in every word's hash, so that no hash is a head word's number.
_END, _START = 1 << 63 | 1, 1 << 63 | 2  # no word's hash but by a chance of one in 2 ** 62
_FLUSH, _MOST_DOCS = 2_000_000, 60_000
_NUMBERS = 1 << 16  # references below are numbers of head words, others places in a list of rare words
_CODEC = pa.Codec("zstd")
_SIZES = struct.Struct("<QQQQ")


class _Codes(WordHashes):
    """The number of a head word, the hash of any other."""

    def __init__(self, head: np.ndarray) -> None:
        super().__init__()
        self.numbers = {int(h): i for i, h in enumerate(head.tolist())}

    def __missing__(self, word: bytes) -> int:
        value = super().__missing__(word) | 1 << 63
        value = self[word] = self.numbers.get(value, value)
        return value

    def sequence(self, text: bytes) -> np.ndarray:
        """Codes of a text's lower-case words between the marks of its start and end."""
        words = text.lower().split()
        out = np.empty(len(words) + 2, np.uint64)
        out[0], out[-1] = (self.numbers.get(mark, mark) for mark in (_START, _END))
        out[1:-1] = self.of(words)
        return out


def _own(refs: np.ndarray, words: np.ndarray, bucket: int, buckets: int) -> np.ndarray:
    """Whether a bucket answers for a word: for rare words of its own and for every head word."""
    return _replaced(refs, words % np.uint64(buckets) == bucket, True)


@dataclass
class Head:
    """Hashes of the head words, commonest first and the start's mark last, and their counts."""

    keys: np.ndarray
    c: np.ndarray

    def bucket(self, first: np.ndarray, second: np.ndarray, buckets: int) -> np.ndarray:
        """The bucket of pairs of two head words: as many for a first word as its count asks for."""
        spread = (1 + self.c * 16 // BUCKET_TOKENS).astype(np.uint64)[first.astype(np.int64)]
        return (mixed(first) % np.uint64(buckets) + mixed(second) % spread) % np.uint64(buckets)




def _planes(values: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, which compress better."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def _packed(words: np.ndarray, first: np.ndarray, second: np.ndarray, c: np.ndarray, places: np.ndarray) -> bytes:
    """Pairs by reference: numbers of head words, or 65,536 and the place in ``words``; ``c`` and ``places`` with them."""
    raw = b"".join([words.tobytes(), *map(_planes, (
        first.astype("<u4"), second.astype("<u4"), c.astype("<u8"), places.astype("<u2")))])
    return _SIZES.pack(len(words), len(first), len(places), len(raw)) + _CODEC.compress(raw, asbytes=True)


def _unpacked(blob: bytes):
    n_words, n, n_places, size = _SIZES.unpack_from(blob)
    raw = np.frombuffer(_CODEC.decompress(memoryview(blob)[_SIZES.size :], size, asbytes=True), np.uint8)
    out, at = [raw[: 8 * n_words].view("<u8")], 8 * n_words
    for k, kind in ((n, "<u4"), (n, "<u4"), (n, "<u8"), (n_places, "<u2")):
        width = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(raw[at : at + k * width].reshape(width, k).T).view(kind).reshape(k))
        at += k * width
    return out


def _replaced(refs: np.ndarray, values: np.ndarray, head: bool | None = None) -> np.ndarray:
    """``values`` of the words in a list of rare words; head words keep their number, or all get the value ``head``."""
    out = refs.astype(values.dtype) if head is None else np.full(len(refs), head, values.dtype)
    rare = np.flatnonzero(refs >= _NUMBERS)
    out[rare] = values[refs[rare] - _NUMBERS]
    return out


def _refs_of(codes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """References to sorted ``words``, which hold all rare codes."""
    out = codes.copy()
    rare = np.flatnonzero(codes >= _NUMBERS)
    out[rare] = np.searchsorted(words, codes[rare]).astype(np.uint64) + np.uint64(_NUMBERS)
    return out


def _gathered(batches: Iterator[pa.RecordBatch], codes: _Codes):
    """Groups of texts of about ``_FLUSH`` tokens: their ids (null without a column of them), the numbers of their
    tokens, and of all tokens the code, the code before it and the text's place in the group."""
    ids, sequences, size = [], [], 0

    def group():
        sizes = np.array([len(s) - 1 for s in sequences])
        one, two = (np.concatenate([s[a:b] for s in sequences]) for a, b in ((0, -1), (1, None)))
        sequences.clear()
        return ids, sizes, one, two, np.repeat(np.arange(len(sizes), dtype=np.uint16), sizes)

    for rows, texts in text_chunks(batches):
        for id_, text in zip(rows.column(0).to_pylist() if rows.num_columns > 1 else texts, texts, strict=True):
            ids.append(id_ if rows.num_columns > 1 else None)
            sequences.append(codes.sequence(text))
            size += len(sequences[-1])
            if size > _FLUSH or len(ids) == _MOST_DOCS:
                yield group()
                ids, size = [], 0
                give_back()
    if ids:
        yield group()


def _by_bucket(first: np.ndarray, second: np.ndarray, owner: np.ndarray | None, head: Head, buckets: int):
    """Distinct pairs of codes for each of their buckets, packed with how often they occur and, with ``owner``, where."""
    words = np.unique(np.concatenate([x[x >= _NUMBERS] for x in (first, second)]))
    keys = _refs_of(first, words) << np.uint64(32) | _refs_of(second, words)
    if owner is None:
        keys, times = np.unique(keys, return_counts=True)
        begins = None
    else:
        order = np.argsort(keys, kind="stable")
        keys, owner = keys[order], owner[order]
        begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        times = np.diff(np.append(begins, len(keys)))
        keys = keys[begins]
    one, two = (keys >> np.uint64(32)).astype(np.uint32), keys.astype(np.uint32)
    rare_one, rare_two = one >= _NUMBERS, two >= _NUMBERS
    home = np.zeros(len(keys), np.uint32)
    both = np.flatnonzero(~rare_one & ~rare_two)
    home[both] = head.bucket(one[both].astype(np.uint64), two[both].astype(np.uint64), buckets)
    of_words = (words % np.uint64(buckets)).astype(np.uint32)
    home[rare_one] = of_words[one[rare_one] - _NUMBERS]
    second_home = np.flatnonzero(rare_two)
    other = of_words[two[second_home] - _NUMBERS]
    home[second_home[~rare_one[second_home]]] = other[~rare_one[second_home]]
    twice = rare_one[second_home] & (home[second_home] != other)
    row = np.concatenate([np.arange(len(keys)), second_home[twice]])
    bucket = np.concatenate([home, other[twice]])
    order = np.lexsort((row, bucket))
    row, bucket = row[order], bucket[order]
    edges = np.flatnonzero(np.diff(bucket.astype(np.int64), prepend=-1, append=-1))
    for a, b in zip(edges, edges[1:], strict=False):
        mine = row[a:b]
        x, y, size = one[mine], two[mine], times[mine]
        held = np.unique(np.concatenate([x[x >= _NUMBERS], y[y >= _NUMBERS]]))
        x, y = (np.where(z < _NUMBERS, z, np.searchsorted(held, z) + _NUMBERS) for z in (x, y))
        places = np.zeros(0, np.uint16)
        if owner is not None:
            ends = np.cumsum(size)
            places = owner[np.repeat(begins[mine] - ends + size, size) + np.arange(ends[-1])]
        yield int(bucket[a]), _packed(words[held - _NUMBERS], x, y, size, places)


def word_counts(texts: DataFrame) -> DataFrame:
    """``w`` and its count ``c``; every text has one end token."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, words, _ in _gathered(batches, _Codes(np.zeros(0, np.uint64))):
            found, total = np.unique(words, return_counts=True)
            for start in range(0, len(found), 100_000):
                yield pa.RecordBatch.from_arrays(
                    [signed(found[start : start + 100_000]), pa.array(total[start : start + 100_000])], ["w", "c"])

    return texts.select("text").mapInArrow(run, "w long, c long").groupBy("w").agg(F.sum("c").alias("c"))


def pair_counts(texts: DataFrame, head: Head, buckets: int) -> DataFrame:
    """A row for each ``bucket``: its pairs with their counts, ``packed``, and ``tally``, how many pairs of its
    own second words have the count 1, 2, ..."""
    shared = texts.sparkSession.sparkContext.broadcast(head)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, first, second, _ in _gathered(batches, _Codes(shared.value.keys)):
            rows = list(_by_bucket(first, second, None, shared.value, buckets))
            for start in range(0, len(rows), 64):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(
                    zip(*rows[start : start + 64], strict=True), (pa.int64(), pa.binary()), strict=True)], ["bucket", "packed"])

    def count(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        parts = [_unpacked(blob) for blob in table["packed"].to_pylist()]
        words = np.unique(np.concatenate([p[0] for p in parts]))
        keys = []
        for own, one, two, _, _ in parts:
            refs = np.searchsorted(words, own).astype(np.uint64) + np.uint64(_NUMBERS)
            keys.append(_replaced(one, refs) << np.uint64(32) | _replaced(two, refs))
        keys, kind = np.unique(np.concatenate(keys), return_inverse=True)
        c = np.bincount(kind, np.concatenate([p[3] for p in parts]), len(keys)).astype(np.int64)
        one, two = keys >> np.uint64(32), keys & np.uint64(0xFFFFFFFF)
        low = c[_own(two, words, bucket, buckets) & (c <= DISCOUNTED + 1)]
        return pa.table({
            "bucket": pa.array([bucket], pa.int64()),
            "packed": pa.array([_packed(words, one, two, c, np.zeros(0, np.int64))], pa.binary()),
            "tally": pa.array([np.bincount(low, minlength=DISCOUNTED + 2)[1:].tolist()], pa.list_(pa.int64()))})

    packed = texts.select("text").mapInArrow(pack, "bucket long, packed binary")
    return packed.groupBy("bucket").applyInArrow(count, "bucket long, packed binary, tally array<long>")


def discounts(tally: dict[int, int], most: int = DISCOUNTED) -> dict[int, float]:
    """Katz' factors for counts 1 to ``most`` from the numbers of types seen 1, 2, ... times.

    Where those numbers give no factor between 0 and 1 (small corpora), half a count is taken off.
    """
    n = lambda r: float(tally.get(r, 0))
    cut = (most + 1) * n(most + 1) / n(1) if n(1) else 1.0
    out = {}
    for r in range(1, most + 1):
        d = ((r + 1) * n(r + 1) / (r * n(r)) - cut) / (1 - cut) if n(r) and cut < 1 else 0.0
        out[r] = d if 0 < d < 1 else 1 - 0.5 / r
    return out


def _discounted(c: np.ndarray, factors: dict[int, float]) -> np.ndarray:
    by_count = np.array([1.0, *(factors[r] for r in sorted(factors)), 1.0])
    return c * by_count[np.minimum(c, len(by_count) - 1).astype(np.int64)]


@dataclass
class Model:
    """``words``: key, c, log_total and log_alpha as contexts; ``parts``: the packed pairs of each bucket; ``head``
    and its values ``log_total``, ``log_alpha``, the start's last. Discounts of words' and pairs' counts; ``scale``
    makes a word's discounted count its probability."""

    words: DataFrame
    parts: DataFrame
    head: Head
    log_total: np.ndarray
    log_alpha: np.ndarray
    word_discounts: dict[int, float]
    pair_discounts: dict[int, float]
    scale: float
    tokens: int
    types: int
    log_unknown: float
    buckets: int

    @property
    def pairs(self) -> DataFrame:
        """``w1``, ``w2`` and the count ``c`` of every pair."""
        keys, buckets = self.head.keys, self.buckets

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for bucket, (words, one, two, c, _) in _buckets(batches):
                mine = _own(two, words, bucket, buckets)
                names = np.concatenate([keys, np.zeros(_NUMBERS - len(keys), np.uint64), words])
                yield pa.RecordBatch.from_arrays(
                    [signed(names[one[mine]]), signed(names[two[mine]]), pa.array(c[mine].astype(np.int64))], ["w1", "w2", "c"])

        return self.parts.mapInArrow(run, "w1 long, w2 long, c long")


def _buckets(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("packed"), strict=True):
            yield bucket, _unpacked(blob.as_py())


def _free(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished steps."""
    gc.collect()
    spark._jvm.System.gc()


def _level(c: str):
    return F.floor(F.log2(c) * 16)


def fit(texts: DataFrame) -> Model:
    """Count and normalise. ``texts`` has a column ``text``; null counts as empty. Logarithms have base 10.

    Unigrams are discounted too; what they leave, half a token at least, is the probability of all unknown
    words together. A
    context's back-off weight is (1 - its stored pairs' discounted share) / (1 - those words' unigram share),
    so every context sums to one over the known words, the end and the unknown. Where a context's counts
    leave nothing over, half a count is added to its total.
    """
    spark = texts.sparkSession
    counted = cut_lineage(word_counts(texts), "word-counts")
    tokens, types = counted.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    tally = {r["c"]: r["n"] for r in counted.filter(F.col("c") <= DISCOUNTED + 1).groupBy("c").agg(
        F.count("*").alias("n")).collect()}
    word_discounts = discounts(tally)
    low = np.array([[r, tally.get(r, 0)] for r in range(1, DISCOUNTED + 1)])
    known = (tokens - float(low.prod(1).sum()) + float(_discounted(low[:, 0], word_discounts) @ low[:, 1])) / max(tokens, 1)
    unknown = max(1.0 - known, 0.5 / max(tokens, 1))
    scale = (1.0 - unknown) / (known or 1.0) / max(tokens, 1)

    level, held = 1 << 16, 0  # the least level of counts whose words all have a number
    for r in sorted(counted.groupBy(_level("c").alias("l")).agg(F.count("*").alias("n")).collect(), reverse=True):
        held += r["n"]
        if held >= HEAD:
            break
        level = r["l"]
    ends = counted.filter(F.col("w") == F.lit(_END - (1 << 64)))
    top = counted.filter(_level("c") >= level).toArrow()
    keys, c = top["w"].to_numpy().view(np.uint64), top["c"].to_numpy()
    order = np.lexsort((keys, -c))
    texts_seen = (ends.select("c").first() or [0])[0]
    head = Head(np.append(keys[order], np.uint64(_START)), np.append(c[order], texts_seen))

    buckets = max(16, tokens // BUCKET_TOKENS)
    parts = cut_lineage(pair_counts(texts, head, buckets), "katz-pairs")
    _free(spark)
    tally = parts.agg(*[F.sum(F.get("tally", F.lit(r))) for r in range(DISCOUNTED + 1)]).first()
    pair_discounts = discounts({r + 1: n or 0 for r, n in enumerate(tally)})
    shared = spark.sparkContext.broadcast(head)

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = shared.value
        numbers = np.concatenate([head.keys, np.zeros(_NUMBERS - len(head.keys), np.uint64)])
        counts = np.concatenate([head.c, np.zeros(_NUMBERS - len(head.c), np.int64)])
        for bucket, (words, one, two, c, _) in _buckets(batches):
            here_1, here_2 = (_own(x, words, bucket, buckets) for x in (one, two))
            of_word = np.bincount(two[here_2], c[here_2], _NUMBERS + len(words))
            of_word[:_NUMBERS] = counts
            uni = _discounted(of_word, word_discounts) * scale
            firsts, place = np.unique(one, return_inverse=True)
            kept = np.bincount(place, np.where(here_1, _discounted(c, pair_discounts), 0.0), len(firsts))
            seen = np.bincount(place, np.where(here_2, uni[two], 0.0), len(firsts))
            names = np.concatenate([numbers, words])[firsts]
            for start in range(0, len(firsts), 100_000):
                mine = slice(start, start + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [signed(names[mine]), pa.array(kept[mine]), pa.array(seen[mine])], ["w", "kept", "seen"])

    none = F.lit(0.0)
    summed = parts.select("bucket", "packed").mapInArrow(contexts, "w long, kept double, seen double").select(
        "w", F.lit(0).cast("long").alias("c"), "kept", "seen")
    summed = summed.union(counted.select("w", "c", none, none)).union(
        ends.select(F.lit(_START - (1 << 64)), "c", none, none))
    summed = summed.groupBy("w").agg(F.sum("c").alias("c"), F.sum("kept").alias("kept"), F.sum("seen").alias("seen"))
    total = F.greatest(F.col("c").cast("double"), F.col("kept") + 0.5)
    stored = cut_lineage(summed.select(
        F.col("w").alias("key"), "c", F.log10(total).alias("log_total"),
        F.log10((1 - F.col("kept") / total) / F.greatest(1 - F.col("seen"), F.lit(unknown / 2))).alias("log_alpha"),
    ), "katz-words")
    top = stored.filter((_level("c") >= level) | (F.col("key") == F.lit(_START - (1 << 64)))).toArrow()
    names = top["key"].to_numpy().view(np.uint64)
    order = np.argsort(names)
    at, here = _found(names[order], head.keys)
    log_total, log_alpha = (
        np.where(here, top[x].to_numpy()[order][at] if len(order) else 0.0, 0.0) for x in ("log_total", "log_alpha"))
    forget(counted)
    _free(spark)
    return Model(
        stored.filter(F.col("key") != F.lit(_START - (1 << 64))), parts.select("bucket", "packed"), head, log_total, log_alpha,
        word_discounts, pair_discounts, scale, tokens, types, float(np.log10(unknown)), buckets)


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``wanted`` in sorted ``keys``, and which are there."""
    at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
    return at, keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)


def _head_pairs(model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of head words that are a ``HEAD``-th of all tokens or more, in order, and their counts."""
    least = -(-model.tokens // HEAD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (_, one, two, c, _) in _buckets(batches):
            mine = (one < _NUMBERS) & (two < _NUMBERS) & (c >= least)
            yield pa.RecordBatch.from_arrays(
                [pa.array(one[mine].astype(np.int64) << 16 | two[mine]), pa.array(c[mine].astype(np.int64))], ["key", "c"])

    rows = model.parts.mapInArrow(run, "key long, c long").toArrow()
    keys, c = rows["key"].to_numpy(), rows["c"].to_numpy()
    order = np.argsort(keys)
    return keys[order].astype(np.uint64), c[order]


def score(docs: DataFrame, model: Model, pseudo: float = 0.1) -> DataFrame:
    """Scores of every whole text by the model and by add-``pseudo`` unigrams.

    ``docs`` has ``doc_id`` and ``text`` (null: empty). Columns: ``doc_id``, ``n_tokens`` (words and the end),
    ``n_known``, ``base_score`` (log10), ``score`` (log10 of the text under back-off). Rows with equal or null ids
    are scored one by one.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.head, model.log_total, model.log_alpha, *_head_pairs(model)))
    total = model.tokens + pseudo * (model.types + 1)
    buckets, log_unknown, scale = model.buckets, model.log_unknown, model.scale
    word_discounts, pair_discounts = model.word_discounts, model.pair_discounts

    def log_kept(c: np.ndarray) -> np.ndarray:
        return np.log10(_discounted(c, pair_discounts))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, log_total, _, pairs, pair_c = shared.value
        base, kept = np.log10((head.c + pseudo) / total), log_kept(pair_c)
        number = TaskContext.get().partitionId() << 32
        for ids, sizes, one, two, owner in _gathered(batches, _Codes(head.keys)):
            number += 1
            near = np.flatnonzero((one < _NUMBERS) & (two < _NUMBERS))
            at, here = _found(pairs, one[near] << np.uint64(16) | two[near])
            near, at = near[here], at[here]
            x, y, place = one[near].astype(np.int64), two[near].astype(np.int64), owner[near]
            sums = np.column_stack([np.bincount(place, v, len(sizes)) for v in (
                base[y], np.ones(len(y)), kept[at] - log_total[x])])
            asked = np.ones(len(one), bool)
            asked[near] = False
            one, two, owner = one[asked], two[asked], owner[asked]
            out = [(bucket, number, 0, blob, b"") for bucket, blob in _by_bucket(one, two, owner, head, buckets)]
            filled = np.array([i if i is not None else 0 for i in ids], np.int64)
            own = b"".join([filled.tobytes(), np.array([i is None for i in ids], np.uint8).tobytes(),
                            sizes.astype(np.int64).tobytes()])
            out.append((number % buckets, number, 1, own, sums.tobytes()))
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
            for start in range(0, len(out), 64):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out[start : start + 64], strict=True), kinds, strict=True)],
                    ["bucket", "chunk", "kind", "packed", "sums"])

    def answer(asked: pa.Table, model_part: pa.Table) -> pa.Table:
        head, log_total, log_alpha, _, _ = shared.value
        bucket = asked["bucket"][0].as_py() if asked.num_rows else 0
        blobs = [b for b in model_part["packed"].to_pylist() if b is not None]
        words, one, two, c, _ = _unpacked(blobs[0]) if blobs else _unpacked(_packed(*[np.zeros(0, np.uint64)] * 5))
        keys, kept = one.astype(np.uint64) << np.uint64(32) | two, log_kept(c)
        of_word = np.bincount(two, c, _NUMBERS + len(words) + 1)  # right for all words of this bucket
        of_word[: len(head.c)] = head.c
        unknown = len(of_word) - 1
        uni = _discounted(of_word, word_discounts) * scale
        log_uni = np.where(uni > 0, np.log10(np.where(uni > 0, uni, 1.0)), log_unknown)
        base = np.log10((of_word + pseudo) / total)
        totals, alphas = (np.zeros(len(of_word)) for _ in range(2))
        totals[: len(head.c)], alphas[: len(head.c)] = log_total, log_alpha
        rows = model_part["packed"].is_null().to_numpy()
        at, here = _found(words, model_part["key"].to_numpy()[rows].view(np.uint64))
        for values, column in ((totals, "log_total"), (alphas, "log_alpha")):
            values[at[here] + _NUMBERS] = model_part[column].to_numpy()[rows][here]
        out = []
        for chunk, kind, packed, sums in zip(*(asked[x].to_pylist() for x in ("chunk", "kind", "packed", "sums")), strict=True):
            if kind == 1:  # a chunk's own row only travels along
                out.append((chunk, kind, packed, sums))
                continue
            asked_words, one, two, times, places = _unpacked(packed)
            at, here = _found(words, asked_words)
            here_1, here_2 = (_own(x, asked_words, bucket, buckets) for x in (one, two))
            refs = np.where(here, at + _NUMBERS, unknown).astype(np.uint64)
            one, two = _replaced(one, refs), _replaced(two, refs)
            at, stored = _found(keys, one << np.uint64(32) | two)
            first = np.where(stored, -totals[one], alphas[one])
            first[stored] += kept[at[stored]]
            each = (np.where(here_2, base[two], 0.0), here_2 & (of_word[two] > 0),
                    np.where(here_1, first, 0.0) + np.where(here_2 & ~stored, log_uni[two], 0.0))
            places, times = places.astype(np.int64), times.astype(np.int64)
            docs_of = np.flatnonzero(np.bincount(places))
            sums = np.column_stack([np.bincount(places, np.repeat(e, times))[docs_of] for e in each])
            out.append((chunk, kind, docs_of.astype("<u2").tobytes(), sums.tobytes()))
        columns = zip(*out, strict=True) if out else [[]] * 4
        return pa.table([pa.array(c, t) for c, t in zip(columns, (
            pa.int64(), pa.int32(), pa.binary(), pa.binary()), strict=True)], ["chunk", "kind", "docs", "sums"])

    def gather(table: pa.Table) -> pa.Table:
        rows = list(zip(*(table[c].to_pylist() for c in ("kind", "docs", "sums")), strict=True))
        own, sums = next((d, np.frombuffer(s, float).reshape(-1, 3).copy()) for k, d, s in rows if k == 1)
        n = len(sums)
        for k, docs_of, part in rows:
            if k == 0:
                sums[np.frombuffer(docs_of, "<u2")] += np.frombuffer(part, float).reshape(-1, 3)
        ids = pa.array(np.frombuffer(own, np.int64, n), mask=np.frombuffer(own, np.uint8, n, 8 * n).astype(bool))
        return pa.table({
            "doc_id": ids, "n_tokens": pa.array(np.frombuffer(own, np.int64, n, 9 * n)),
            "n_known": pa.array(np.rint(sums[:, 1]).astype(np.int64)), "base_score": pa.array(sums[:, 0]),
            "score": pa.array(sums[:, 2])})

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    asked = narrow.mapInArrow(ask, "bucket long, chunk long, kind int, packed binary, sums binary")
    bucket = lambda c: F.pmod(F.pmod(F.col(c), F.lit(buckets)) + F.when(
        F.col(c) < 0, F.lit((1 << 64) % buckets)).otherwise(0), F.lit(buckets)).alias("bucket")
    nothing = F.lit(0.0)
    rare = model.words.select(bucket("key"), "key", "log_total", "log_alpha", F.lit(None).cast("binary").alias("packed"))
    table = rare.union(model.parts.select("bucket", F.lit(0).cast("long"), nothing, nothing, "packed"))
    answers = asked.groupBy("bucket").cogroup(table.groupBy("bucket")).applyInArrow(
        answer, "chunk long, kind int, docs binary, sums binary")
    return answers.groupBy("chunk").applyInArrow(
        gather, "doc_id long, n_tokens long, n_known long, base_score double, score double")
