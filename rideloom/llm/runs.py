"""Periodic runs of words inside a document: seeds on diagonals, extended to maximal runs.

A run of smallest period q and length n has n - q places at which a word equals the one q words on. With
n >= max(least, 2 q) these are max(least - q, q) consecutive places at least, so a run of a class of lags must
repeat some k-gram at exactly its lag: k = ceil(least / 2) for lags up to k, then k = low for the lags from low
below 2 low. Pairs of occurrences of a k-gram whose lag lies in its class are the seeds. Occurrences that overlap
by half or more form progressions inside one shorter run; they are paired as progressions, one seed for each lag,
which keeps the number of seeds in proportion to the text where plain pairs would grow with its square.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rideloom.llm.batches import mixed, text_chunks, with_columns
from rideloom.llm.substrings import RollingHashes

_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
RUNS_DDL = "array<struct<start: long, length: long, period: long>>"


class _Numbers(dict):
    """A number for each distinct word, in order of first sight."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


class Sequence:
    """The words of several documents as numbers, one after the other, each document closed by a number of its own."""

    def __init__(self, documents: list[list[bytes]]) -> None:
        numbers = _Numbers()
        sizes = np.array([len(d) + 1 for d in documents], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(sizes)])
        self.ids = np.empty(int(self.begin[-1]), np.int64)
        for d, at in zip(documents, self.begin, strict=False):
            self.ids[at : at + len(d)] = np.fromiter(map(numbers.__getitem__, d), np.int64, len(d))
        closing = self.begin[1:] - 1
        self.ids[closing] = len(numbers) + np.arange(len(documents))
        self.document = np.repeat(np.arange(len(documents)), sizes)
        self._rolling = RollingHashes()
        self._words = mixed(self.ids.astype(np.uint64) + np.uint64(1))
        self._rolling.of(self._words, 1)  # powers for every length
        self._sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self._words * self._rolling.down[: len(self.ids)])])

    def __len__(self) -> int:
        return len(self.ids)

    def hashes(self, at: np.ndarray, size: int | np.ndarray) -> np.ndarray:
        """Rabin-Karp hash of the ``size`` words from each place."""
        return mixed((self._sums[at + size] - self._sums[at]) * self._rolling.up[at + size])

    def grams(self, at: np.ndarray, size: int) -> np.ndarray:
        """Like ``hashes``, different for each document."""
        return mixed(self.hashes(at, size) + mixed(self.document[at].astype(np.uint64)))

    def equal_after(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from ``a`` equal those from ``b``, by doubling steps; a < b."""
        found = np.zeros(len(a), np.int64)
        for step in _steps(len(self)):
            fits = np.flatnonzero(b + found + step <= len(self))
            x, y = (a + found)[fits], (b + found)[fits]
            found[fits[self.hashes(x, step) == self.hashes(y, step)]] += step
        return found

    def equal_before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before ``a`` equal those before ``b``; a < b."""
        found = np.zeros(len(a), np.int64)
        for step in _steps(len(self)):
            fits = np.flatnonzero(a - found - step >= 0)
            x, y = (a - found - step)[fits], (b - found - step)[fits]
            found[fits[self.hashes(x, step) == self.hashes(y, step)]] += step
        return found


def _steps(size: int) -> list[int]:
    return [1 << j for j in range(max(size, 1).bit_length() - 1, -1, -1)]


def classes(longest: int, least: int) -> Iterator[tuple[int, int, int]]:
    """(k, smallest lag, largest lag) of each class of lags for documents of at most ``longest`` words."""
    k = max(-(-least // 2), 1)
    low, high = 1, k
    while 2 * low <= longest:
        yield k, low, high
        low = high + 1
        k = low
        high = 2 * low - 1


def _seeds(at: np.ndarray, group: np.ndarray, k: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and lags at which equal k-grams (``at``, sorted inside each ``group``) may start a run of the class."""
    near = (np.diff(at) <= k // 2) & (group[1:] == group[:-1])
    first = np.flatnonzero(np.concatenate([[True], ~near]))
    last = np.concatenate([first[1:], [len(at)]]) - 1
    many = last > first
    gap = np.where(many, at[np.minimum(first + 1, len(at) - 1)] - at[first], 0)
    own = many & (gap >= low) & (gap <= high)  # only the first class has lags that short
    places, lags = [at[first[own]]], [gap[own]]
    live = np.arange(len(first))
    step = 1
    while len(live):
        live = live[live + step < len(first)]
        other = live + step
        shortest = at[first[other]] - at[last[live]]
        ok = (group[first[live]] == group[first[other]]) & (shortest <= high)
        live, other, shortest = live[ok], other[ok], shortest[ok]
        longest = at[last[other]] - at[first[live]]
        d = np.maximum(gap[live], gap[other])
        d[d == 0] = 1  # two single occurrences: one lag
        shortest = shortest + np.maximum(-(-(low - shortest) // d), 0) * d
        count = np.maximum((np.minimum(longest, high) - shortest) // d + 1, 0)
        owner = np.repeat(np.arange(len(live)), count)
        lag = shortest[owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)) * d[owner]
        places.append(np.maximum(at[first[live]][owner], at[first[other]][owner] - lag))
        lags.append(lag)
        step += 1
    return np.concatenate(places), np.concatenate(lags)


def _extended(words: Sequence, place: np.ndarray, lag: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, length and lag of the maximal stretch around each seed.

    The furthest place that each lag has covered so far is kept; seeds before it are not extended again. Each round
    extends twice as many seeds of a lag as the one before.
    """
    order = np.lexsort((place, lag))
    place, lag = place[order], lag[order]
    new = np.ones(len(place), bool)
    new[1:] = (np.diff(place) != 1) | (np.diff(lag) != 0)  # the seed one word before covers this one
    place, lag = place[new], lag[new]
    out = [np.zeros((3, 0), np.int64)]
    width = 1
    while len(place):
        begins = np.flatnonzero(np.concatenate([[True], np.diff(lag) != 0]))
        which = np.repeat(np.arange(len(begins)), np.diff(np.concatenate([begins, [len(lag)]])))
        turn = np.arange(len(lag)) - begins[which] < width
        a, q = place[turn], lag[turn]
        after = words.equal_after(a, a + q)
        before = words.equal_before(a, a + q)
        out.append(np.stack([a - before, before + after + q, q]))
        covered = np.zeros(len(begins), np.int64)
        np.maximum.at(covered, which[turn], a + after)
        rest = ~turn & (place >= covered[which])
        place, lag = place[rest], lag[rest]
        width *= 2
    return tuple(np.concatenate(out, axis=1))


def find_runs(words: Sequence, least: int = 12) -> np.ndarray:
    """All runs (rows of start, length, period), sorted by start and period; starts count from the first document."""
    at = np.arange(len(words))
    found = [np.zeros((3, 0), np.int64)]
    for k, low, high in classes(int(np.diff(words.begin).max(initial=0)), least):
        at = at[at + k <= len(words)]
        hashes = words.grams(at, k)
        order = np.argsort(hashes, kind="stable")
        sorted_hashes = hashes[order]
        same = sorted_hashes[1:] == sorted_hashes[:-1]
        twice = np.zeros(len(at), bool)
        twice[1:] |= same
        twice[:-1] |= same
        if not twice.any():
            break  # a longer gram that repeats would repeat its beginning
        group = np.cumsum(np.concatenate([[True], ~same]))[twice]
        chosen = at[order[twice]]
        begin, length, lag = _extended(words, *_seeds(chosen, group, k, low, high))
        ok = length >= np.maximum(least, 2 * lag)
        found.append(np.stack([begin[ok], length[ok], lag[ok]]))
        at = np.sort(chosen)
    begin, length, lag = np.concatenate(found, axis=1)
    order = np.lexsort((lag, length, begin))
    runs = np.stack([begin, length, lag], axis=1)[order]
    first = np.ones(len(runs), bool)
    first[1:] = (np.diff(runs[:, :2], axis=0) != 0).any(axis=1)  # multiples of a period cover the same words
    runs = runs[first]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _dropped(size: int, runs: np.ndarray) -> np.ndarray:
    """Marks the words of runs after their first period."""
    edge = np.zeros(size + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge)[:-1] > 0


def periodic_runs(docs: DataFrame, least: int = 12, text_column: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` and ``collapsed``.

    ``runs`` lists (start, length, period) in words, by start, then period: stretches of consecutive words with
    smallest period q and a length of at least ``least`` and of 2 q that no neighbouring word extends. ``collapsed``
    holds the words outside of runs and the first period of each, joined by one space. A null text counts as
    empty: no runs, empty ``collapsed``. Every row, repeated ones too, is judged by itself; other columns stay,
    those named like the new ones are replaced. Texts of any length are worked on whole, by one task each, with
    memory in proportion to the text. Words are compared exactly when grouped and by 64-bit hashes when stretched.
    """
    new = ("n_words", "runs", "collapsed")
    kept = [c for c in docs.columns if c not in new]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_chunks(batches, text_column):
            split = [t.split() for t in texts]
            words = Sequence(split)
            runs = find_runs(words, least)
            gone = _dropped(len(words), runs)
            owner = words.document[runs[:, 0]] if len(runs) else runs[:, 0]
            bounds = np.searchsorted(owner, np.arange(len(split) + 1))
            listed, collapsed = [], []
            for i, w in enumerate(split):
                mine = runs[bounds[i] : bounds[i + 1]]
                at = int(words.begin[i])
                listed.append([{"start": s - at, "length": n, "period": q} for s, n, q in mine.tolist()])
                if len(mine):
                    w = [x for x, off in zip(w, gone[at : at + len(w)].tolist(), strict=True) if not off]
                collapsed.append(b" ".join(w))
            yield with_columns(rows, kept, n_words=pa.array(map(len, split), pa.int64()),
                               runs=pa.array(listed, _RUNS), collapsed=pa.array(collapsed, pa.binary()).view(pa.string()))

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*kept).schema)
    return docs.select(*kept).mapInArrow(run, f"{fields}n_words long, runs {RUNS_DDL}, collapsed string")
