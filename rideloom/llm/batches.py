"""Arrow batches as documents and word hashes, shared by the operators of this package."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext

_MAX_CACHED = 400_000
#: What a Python worker keeps from task to task, by stage and name.
_KEPT: dict[int, dict] = {}
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc; other libraries give memory back by themselves


def _stage() -> int:
    context = TaskContext.get()
    return context.stageId() if context else -1


def kept_for_stage(name: str, make: Callable[[], object]):
    """What ``make`` returned first; kept in this process until a task of another stage reads texts."""
    kept = _KEPT.setdefault(_stage(), {})
    if name not in kept:
        kept[name] = make()
    return kept[name]


def give_back() -> None:
    """Return freed memory: a worker lives on, and its next stages would hold it beside what they need."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def text_chunks(
    batches: Iterator[pa.RecordBatch], column: str = "text", max_bytes: int = 4 << 20
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with at most ``max_bytes`` of text (or one document), and their texts in UTF-8.

    A null text counts as empty.
    """
    for stage in _KEPT.keys() - {_stage()}:
        del _KEPT[stage]
    for batch in batches:
        texts = pc.fill_null(batch.column(batch.schema.get_field_index(column)).cast(pa.binary()), b"")
        sizes = pc.binary_length(texts).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > max_bytes:
                yield batch.slice(start, i - start), texts.slice(start, i - start).to_pylist()
                start, held = i, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start), texts.slice(start).to_pylist()
        give_back()


class WordHashes(dict):
    """64-bit hash of each word; keeps the words seen last, up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MAX_CACHED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words; of the whole sequence where it is shorter, none where it is empty."""
    size = min(size, len(hashes))
    if not size:
        return hashes
    out = np.full(len(hashes) - size + 1, size, np.uint64)
    for i in range(size):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(hashes) - size + 1 + i])
    return out


def signed(values: np.ndarray) -> pa.Array:
    """Unsigned 64-bit values as Spark's long, bit by bit."""
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def with_columns(batch: pa.RecordBatch, keep: list[str], **columns) -> pa.RecordBatch:
    """``keep`` of the batch and new columns, in this order."""
    arrays = [batch.column(batch.schema.get_field_index(c)) for c in keep]
    return pa.RecordBatch.from_arrays(
        arrays + [v if isinstance(v, pa.Array) else pa.array(v) for v in columns.values()], names=[*keep, *columns]
    )
