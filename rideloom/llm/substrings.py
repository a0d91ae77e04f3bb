"""Substring dedup: windows of words that occur twice anywhere are removed wherever they occur.

Every window has a Rabin-Karp hash. A repeated window repeats everything inside it, so the window's smallest
short hash (its anchor) repeats too; windows whose anchor occurs once are known to be unique without being
shuffled. All other windows are counted in Spark by their full hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideloom.llm.batches import WordHashes, mixed, signed, text_chunks, with_columns
from rideloom.workspace import cut_lineage

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2 ** 64
_INVERSE = pow(_BASE, -1, 1 << 64)
NAME = ("name_a", "name_b")  # 128-bit name of a text


class RollingHashes:
    """Rabin-Karp hashes modulo 2 ** 64 of all windows of a length, by prefix sums."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, words: np.ndarray, length: int) -> np.ndarray:
        n = len(words)
        if len(self.up) <= n:
            size = 2 * n
            self.up, self.down = (
                np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, b, np.uint64))]) for b in (_BASE, _INVERSE))
        if n < length:
            return np.zeros(0, np.uint64)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * self.down[:n])])
        return mixed((sums[length:] - sums[:-length]) * self.up[length - 1 : n])


def anchor_places(words: np.ndarray, window: int, rolling: RollingHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all anchors of a text, and for each window the place of its smallest one (the first of equals)."""
    short = max(window // 3, 1)
    hashes = rolling.of(words, short)
    spread = window - short + 1
    if len(words) < window:
        return hashes, np.zeros(0, np.int64)
    least = np.lib.stride_tricks.sliding_window_view(hashes, spread).argmin(1)
    return hashes, least + np.arange(len(least))


def _named(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("name_a"),
        F.xxhash64(F.lit(1), text).alias("name_b"))


def _anchors(texts: DataFrame, window: int) -> DataFrame:
    """The anchors of every text: name, place and hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, rolling = WordHashes(), RollingHashes()
        for rows, found in text_chunks(batches):
            places, anchors, owner = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], []
            for i, text in enumerate(found):
                all_anchors, least = anchor_places(hashes.of(text.split()), window, rolling)
                at = np.unique(least)
                places.append(at)
                anchors.append(all_anchors[at])
                owner.append(np.full(len(at), i))
            named = rows.select(list(NAME)).take(pa.array(np.concatenate(owner)))
            yield with_columns(named, list(NAME), place=np.concatenate(places).astype(np.int32),
                               anchor=signed(np.concatenate(anchors)))

    return texts.mapInArrow(run, "name_a long, name_b long, place int, anchor long")


def _windows(texts: DataFrame, window: int) -> DataFrame:
    """Hash and start of every window of ``texts`` whose anchor is at one of ``places``; ``copies`` comes along."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, rolling = WordHashes(), RollingHashes()
        for rows, found in text_chunks(batches):
            known = rows.column(rows.schema.get_field_index("places")).to_pylist()
            starts, values, owner = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], []
            for i, (text, places) in enumerate(zip(found, known, strict=True)):
                words = hashes.of(text.split())
                _, least = anchor_places(words, window, rolling)
                marked = np.zeros(len(words) + 1, bool)
                marked[places] = True
                at = np.flatnonzero(marked[least])
                starts.append(at)
                values.append(rolling.of(words, window)[at])
                owner.append(np.full(len(at), i))
            named = rows.select([*NAME, "copies"]).take(pa.array(np.concatenate(owner)))
            yield with_columns(named, [*NAME, "copies"], start=np.concatenate(starts).astype(np.int32),
                               window=signed(np.concatenate(values)))

    return texts.mapInArrow(run, "name_a long, name_b long, copies long, start int, window long")


def intervals(starts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal runs of words that windows at ``starts`` cover (begin, end)."""
    if not len(starts):
        return []
    starts = np.sort(starts)
    new = np.flatnonzero(np.diff(starts) > window)
    begins = starts[np.concatenate([[0], new + 1])]
    ends = starts[np.concatenate([new, [len(starts) - 1]])] + window
    return list(zip(begins.tolist(), ends.tolist(), strict=True))


def _cleaned(texts: DataFrame, window: int) -> DataFrame:
    """Words, removed intervals and kept text of every text, given ``copies`` and the ``starts`` of its repeats."""
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, found in text_chunks(batches):
            at = rows.schema.get_field_index
            sizes, removed, kept = [], [], []
            for text, copies, starts in zip(found, rows.column(at("copies")).to_pylist(),
                                            rows.column(at("starts")).to_pylist(), strict=True):
                words = text.split()
                if copies > 1 and len(words) >= window:
                    gone = [(0, len(words))]
                else:
                    gone = intervals(np.array(starts or [], np.int64), window)
                sizes.append(len(words))
                removed.append([{"begin": a, "end": b} for a, b in gone])
                for a, b in reversed(gone):
                    del words[a:b]
                kept.append(hashlib.sha256(b" ".join(words)).hexdigest())
            yield with_columns(rows, list(NAME), n_words=pa.array(sizes, pa.int64()),
                               removed=pa.array(removed, kind), kept_sha256=pa.array(kept, pa.string()))

    return texts.mapInArrow(run, "name_a long, name_b long, n_words long, "
                                 "removed array<struct<begin: long, end: long>>, kept_sha256 string")


def repeated_windows(docs: DataFrame, window: int = 35) -> DataFrame:
    """For every row its words, the maximal intervals of repeated windows, and a digest of what is kept.

    Columns: ``doc_id``, ``n_words``, ``removed`` (begin and end in words), ``n_removed``, ``kept_sha256`` (kept
    words joined by one space). Windows are judged on the input. Texts that occur in several rows are worked
    on once; their windows repeat by that alone. Null and empty texts have no words. Repeated and null ids
    get a row for each of their rows. Windows are compared by 64-bit hashes, texts by 128-bit ones.
    """
    named = _named(docs)
    names = list(NAME)
    anchors = _anchors(named, window)
    shared = anchors.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    shared = cut_lineage(shared, "shared-anchors")
    places = cut_lineage(
        anchors.join(shared, "anchor", "left_semi").groupBy(*names).agg(F.collect_set("place").alias("places")),
        "anchor-places")
    texts = named.groupBy(*names).agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    windows = cut_lineage(_windows(texts.join(places, names), window), "windows")
    twice = windows.groupBy("window").agg(F.sum("copies").alias("n")).filter("n > 1").select("window")
    single = windows.filter("copies = 1")  # a text with copies goes as a whole
    starts = single.join(twice, "window", "left_semi").groupBy(*names).agg(F.collect_list("start").alias("starts"))
    cleaned = cut_lineage(_cleaned(texts.join(starts, names, "left"), window), "cleaned")
    size = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["begin"])
    return named.drop("text").join(cleaned, names).select(
        "doc_id", "n_words", "removed", size.alias("n_removed"), "kept_sha256")
