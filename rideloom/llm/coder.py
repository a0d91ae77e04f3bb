"""Context-mixing range coder for token ids, many independent blocks side by side.

Each block has a model of its own. For the next id the order-2 and the order-1 context propose the id that
followed them last, each with a confidence; order 0 is the distribution of the ids that neither proposed. The
mixture gives its weights to the two proposals and to order 0 by how often each of them was right in the same
state of confidence, and a range coder codes the id under the mixture. Contexts, proposals and weights start
empty and adapt; order 0 is written in front of the block, as gaps and counts of its ids. The arithmetic runs
over all blocks at once, one id of each per step, on ranks (places among the block's ids), which is what makes
it fast enough in numpy.

A payload: its head, the unary parts and the other bits of gaps and counts, the words of the ids that order 0
codes, the words of the choices between the three predictions.
"""

from __future__ import annotations

import struct

import numpy as np

#: Fixed values of the format: hash bits of order 2, bits of a weight, and the speed at which weights adapt.
BITS_2, _BITS, _RATE = 13, 15, 5
#: Distinct ids, bytes of unary parts, words of the ids under order 0, least bits of a gap.
_HEAD = struct.Struct("<IIIB")
_LOW32, _LEAST = (1 << 32) - 1, 1 << 32
#: Two weights share a value: the end of order 2's share below, the end of order 1's share above.
_PULL = np.array([1020 | 1022 << 16, 2 | 1022 << 16, 2 | 4 << 16], np.int32)
_KEEP = 0x07FF07FF


def _first_weights() -> np.ndarray:
    """Shares in each state: confidence of order 2 (0 to 3), that of order 1, and whether they propose the same."""
    out = []
    for two in (0.01, 0.25, 0.5, 0.75):
        for one in (0.01, 0.1, 0.25, 0.5):
            for same in (False, True):
                share = max(two, one) if same else two
                end = share + (0.01 if same else one * (1 - two) / 2)
                out.append(int(share * 32768) | int(end * 32768) << 16)
    return np.array(out, np.int32)


def _unit(span: np.ndarray, total: np.ndarray) -> np.ndarray:
    """``span // total``: under 2^49 a rounded quotient never reaches the next whole number."""
    return (span / total).astype(np.int64)


class _Out:
    """Range coder with 48-bit state that moves 16 bits at a time; carries stay in the words until the end."""

    def __init__(self, lanes: int, words: int) -> None:
        self.low = np.zeros(lanes, np.int64)
        self.range = np.full(lanes, 1 << 48, np.int64)
        self.words = np.zeros((words, lanes), np.uint32)
        self.at = np.zeros(lanes, np.int64)

    def narrow(self, n: int, begin: np.ndarray, span: np.ndarray) -> None:
        """The first ``n`` lanes go on with ``span`` of their range, from ``begin`` on."""
        low = self.low[:n]
        low += begin
        self.range[:n] = span

    def move(self, n: int) -> None:
        """Write the settled words of the first ``n`` lanes."""
        due = np.flatnonzero(self.range[:n] < _LEAST)
        while len(due):
            low, at, wide = self.low[due], self.at[due], self.range[due] << 16
            self.words[at, due] = low >> 32
            self.low[due], self.range[due], self.at[due] = (low & _LOW32) << 16, wide, at + 1
            due = due[wide < _LEAST]

    def flushed(self) -> list[bytes]:
        self.move(len(self.at))
        self.words[self.at, np.arange(len(self.at))] = self.low + _LOW32 >> 32
        self.at += 1
        words = self.words[: int(self.at.max(initial=0))]
        carry = np.zeros(len(self.at), np.uint32)
        for row in words[::-1]:
            row += carry
            carry = row >> 16
        flat = np.ascontiguousarray(words.astype("<u2").T)
        return [w[:n].tobytes() for w, n in zip(flat, self.at.tolist(), strict=True)]


class _In:
    """The other side of ``_Out``; behind the end of a payload come zeros."""

    def __init__(self, payloads: list[bytes]) -> None:
        most = max(map(len, payloads), default=0) // 2 + 4
        words = np.zeros((len(payloads), most), "<u2")
        for row, p in zip(words, payloads, strict=True):
            row[: len(p) // 2] = np.frombuffer(p, "<u2")
        self.words = words.ravel().astype(np.int64)
        self.at = np.arange(len(payloads)) * most
        self.range = np.full(len(payloads), 1 << 48, np.int64)
        self.code = np.zeros(len(payloads), np.int64)
        for _ in range(3):
            self.code = self.code << 16 | self.words[self.at]
            self.at += 1

    def narrow(self, n: int, begin: np.ndarray, span: np.ndarray) -> None:
        code = self.code[:n]
        code -= begin
        self.range[:n] = span

    def move(self, n: int) -> None:
        due = np.flatnonzero(self.range[:n] < _LEAST)
        while len(due):
            at, wide = self.at[due], self.range[due] << 16
            self.code[due] = self.code[due] << 16 | self.words.take(at, mode="clip")
            self.range[due], self.at[due] = wide, at + 1
            due = due[wide < _LEAST]


def _alive(sizes: np.ndarray) -> list[int]:
    """For each step the number of lanes that have it; lanes lie by falling size."""
    return np.searchsorted(-sizes, -np.arange(int(sizes.max(initial=0))), "left").tolist()


def _follow(sizes: np.ndarray, distinct: int, coder, ranks: np.ndarray, literals=None) -> np.ndarray | None:
    """Code the rows of ``ranks`` (one for each step) by the mixture and return where order 0 was needed.

    With ``literals`` (the ranks that order 0 gave, and where each lane's begin) it fills ``ranks`` instead.
    """
    lanes = len(sizes)
    # An entry is a rank with its confidence (0 to 3) below it; no id has the last rank of a kind.
    kind = np.uint16 if distinct < 1 << 14 else np.uint32
    first_1 = lanes << BITS_2
    table = np.full(first_1 + lanes * (distinct + 1), np.iinfo(kind).max & ~3, kind)
    weights = np.tile(_first_weights(), lanes)
    # Both contexts of each lane; before the first id both hold the number behind the last rank.
    base_2, base_1 = np.arange(lanes) << BITS_2, first_1 + np.arange(lanes) * (distinct + 1)
    at = np.stack([base_2, base_1 + distinct])
    state_0, before = np.arange(lanes) << 5, np.zeros(lanes, np.int64)
    decode = literals is not None
    if decode:
        given, begin = literals
        begin = begin.copy()
    else:
        missed = np.zeros(ranks.shape, bool)
    n = -1
    for step, alive in enumerate(_alive(sizes)):
        if alive != n:
            n = alive
            at, before, base_2, base_1, state_0 = at[:, :n].copy(), before[:n], base_2[:n], base_1[:n], state_0[:n]
            places = at.reshape(-1)
            if decode:
                begin = begin[:n]
        entry = table.take(places).reshape(2, n)
        proposed, sure = entry >> 2, entry & 3
        by_2, by_1 = proposed
        state = state_0 + ((sure[0] << 3) + (sure[1] << 1) + (by_2 == by_1))
        weight = weights.take(state)
        whole = coder.range[:n]
        unit = whole >> _BITS
        end_2, end_1 = (weight & 0xFFFF) * unit, (weight >> 16) * unit
        if decode:
            code = coder.code[:n]
            not_2, neither = code >= end_2, code >= end_1
            value = np.where(neither, given.take(begin), np.where(not_2, by_1, by_2))
            begin += neither
            ranks[step, :n] = value
        else:
            value = ranks[step, :n]
            not_2 = by_2 != value
            neither = not_2 & (by_1 != value)
            missed[step, :n] = neither
        low = np.where(neither, end_1, end_2 * not_2)
        high = np.where(neither, whole, np.where(not_2, end_1, end_2))
        high -= low
        coder.narrow(n, low, high)
        if step & 1:  # a weight is 32 at least, so 32 bits last for two choices
            coder.move(n)
        way = not_2.view(np.int8) + neither.view(np.int8)
        weights[state] = weight - (weight >> _RATE & _KEEP) + _PULL.take(way)
        # The entry afterwards: surer, less sure, or replaced.
        worse = np.where(sure > 1, entry - 1, value << 2 | 1)
        table[places] = np.where(proposed == value, entry + (sure < 3), worse).reshape(-1)
        wide = value.astype(np.int64)
        np.add(wide * 0x9E3779B1 + before >> 16 & (1 << BITS_2) - 1, base_2, out=at[0])
        np.add(wide, base_1, out=at[1])
        before = wide * 0x85EBCA77
    return None if decode else missed


def _bits(values: np.ndarray, widths: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Values of so many bits at these places of ``size`` bits, the lowest first."""
    out = np.zeros(size, bool)
    some = np.flatnonzero(widths)
    widths, values, starts = widths[some], values[some], starts[some]
    for j in range(int(widths.max(initial=0))):
        if j:
            some = widths > j
            widths, values, starts = widths[some], values[some], starts[some]
        out[starts + j] = values >> j & 1
    return out


def _unbits(bits: np.ndarray, widths: np.ndarray, starts: np.ndarray) -> np.ndarray:
    out = np.zeros(len(widths), np.int64)
    some = np.flatnonzero(widths)
    widths, starts = widths[some], starts[some]
    for j in range(int(widths.max(initial=0))):
        if j:
            more = widths > j
            some, widths, starts = some[more], widths[more], starts[more]
        out[some] |= bits[starts + j].astype(np.int64) << j
    return out


def _whole_bytes(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of each lane's bits, and the bit at which each lane begins."""
    size = sizes + 7 >> 3
    return size, np.cumsum(size * 8) - size * 8


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... for each of the sizes."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _tables(ids: np.ndarray, counts: np.ndarray, distinct: np.ndarray):
    """Order 0 of each lane in bytes (unary parts, other bits) and the least bits of its gaps.

    ``ids`` (ascending in a lane) and ``counts`` (1 at least) of all lanes, ``distinct`` of each of them.
    A number v has the bits of v + 2^k behind its highest one, which is named in unary.
    """
    begins = np.cumsum(distinct) - distinct
    gaps = np.diff(ids, prepend=-1) - 1
    gaps[begins] = ids[begins]
    mean = np.add.reduceat(gaps, begins) // distinct
    least = np.maximum(np.frexp(mean.astype(float))[1] - 1, 0)
    lane = np.repeat(np.arange(len(distinct)), distinct)
    k = np.stack([least[lane], np.zeros(len(lane), np.int64)], 1).ravel()
    v = np.stack([gaps, counts - 1], 1).ravel() + (1 << k)
    width = np.frexp(v.astype(float))[1] - 1
    unary = width - k + 1
    first = begins * 2
    out = []
    for widths, values in ((unary, None), (width, v)):
        sizes, starts = _whole_bytes(np.add.reduceat(widths, first))
        ends = np.cumsum(widths)
        ends += np.repeat(starts - (ends[first] - widths[first]), distinct * 2)
        if values is None:
            bits = np.zeros(int(sizes.sum()) * 8, bool)
            bits[ends - 1] = True
        else:
            bits = _bits(values & (1 << widths) - 1, widths, ends - widths, int(sizes.sum()) * 8)
        raw = np.packbits(bits).tobytes()
        cuts = [0, *np.cumsum(sizes).tolist()]
        out.append([raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)])
    return out[0], out[1], least


def _untables(payloads: list[bytes], distinct: np.ndarray, unary_bytes: np.ndarray, least: np.ndarray):
    """Ids and counts as ``_tables`` got them, and the place in each payload behind them."""
    unary = [p[_HEAD.size : _HEAD.size + n] for p, n in zip(payloads, unary_bytes.tolist(), strict=True)]
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(b"".join(unary), np.uint8)))
    first = (np.cumsum(distinct) - distinct) * 2
    starts = np.cumsum(unary_bytes * 8) - unary_bytes * 8
    unary = np.diff(ones, prepend=-1)
    unary[first] = ones[first] - starts + 1
    lane = np.repeat(np.arange(len(distinct)), distinct)
    k = np.stack([least[lane], np.zeros(len(lane), np.int64)], 1).ravel()
    width = unary - 1 + k
    sizes, starts = _whole_bytes(np.add.reduceat(width, first))
    begin = _HEAD.size + unary_bytes
    bits = np.unpackbits(np.frombuffer(b"".join(
        p[a : a + n] for p, a, n in zip(payloads, begin.tolist(), sizes.tolist(), strict=True)), np.uint8))
    ends = np.cumsum(width)
    ends += np.repeat(starts - (ends[first] - width[first]), distinct * 2)
    v = (1 << width) + _unbits(bits, width, ends - width) - (1 << k)
    ids = np.cumsum(v[::2] + 1)
    ids -= np.repeat(ids[first >> 1] - v[first], distinct)
    return ids, v[1::2] + 1, begin + sizes


def _words(sizes: np.ndarray, most_bits: int) -> int:
    return int(sizes.max(initial=0)) * most_bits // 16 + 8


def _shares(counts: np.ndarray, begins: np.ndarray, distinct: np.ndarray) -> np.ndarray:
    """Of each id under order 0: how many of its lane come before it, above how often it comes."""
    under = np.cumsum(counts) - counts
    under -= np.repeat(under[begins], distinct)
    return under << 32 | counts


def _ranked(ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct ids of each lane, lane by lane, their numbers, and the ranks of ``ids`` (a row for each step)."""
    lanes, steps = ids.shape
    shift = steps.bit_length()
    kind = np.int32 if 17 + shift < 32 and steps * lanes < 1 << 31 else np.int64
    keys = ids.astype(kind) << shift
    keys |= np.arange(steps, dtype=kind)
    short = np.flatnonzero(sizes < steps)
    for lane in short.tolist():  # what lies behind a lane's end sorts behind its ids
        keys[lane, sizes[lane] :] |= 1 << 16 + shift
    keys.sort(axis=1)
    place = keys & (1 << shift) - 1
    keys >>= shift
    new = np.ones((lanes, steps), bool)
    np.not_equal(keys[:, 1:], keys[:, :-1], out=new[:, 1:])
    rank = new.cumsum(1, dtype=np.int32)
    rank -= 1
    new[short] &= keys[short] < 1 << 16
    distinct = new.sum(1)
    names = keys[new].astype(np.int64)
    place *= lanes
    place += np.arange(lanes, dtype=kind)[:, None]
    ranks = np.zeros((steps, lanes), np.uint16 if distinct.max() < 1 << 14 else np.uint32)
    ranks.reshape(-1)[place.reshape(-1)] = rank.reshape(-1)
    return names, distinct, ranks


def _encode(ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """``ids`` has a row for each lane, lanes by falling size, none empty."""
    lanes, steps = ids.shape
    names, distinct, ranks = _ranked(ids, sizes)
    ways = _Out(lanes, _words(sizes, 12))
    missed = np.ascontiguousarray(_follow(sizes, int(distinct.max()), ways, ranks).T)
    begins = np.cumsum(distinct) - distinct
    n_given = missed.sum(1)
    # The ranks under order 0, lane by lane; every id comes there first.
    given = np.ascontiguousarray(ranks.T)[missed] + np.repeat(begins, n_given)
    del ranks, missed
    counts = np.bincount(given, minlength=len(names))
    shares = _shares(counts, begins, distinct)
    order = np.argsort(-n_given, kind="stable")
    n_sorted, starts = n_given[order], (np.cumsum(n_given) - n_given)[order]
    literals = _Out(lanes, _words(sizes, steps.bit_length() + 1))
    for step, n in enumerate(_alive(n_sorted)):
        which = given.take(starts[:n] + step)
        unit = _unit(literals.range[:n], n_sorted[:n])
        share = shares.take(which)
        literals.narrow(n, (share >> 32) * unit, (share & _LOW32) * unit)
        literals.move(n)
    unary, other, least = _tables(names, counts, distinct)
    words = [b""] * lanes
    for i, payload in zip(order.tolist(), literals.flushed(), strict=True):
        words[i] = payload
    return [
        _HEAD.pack(d, len(u), len(w) // 2, k) + u + o + w + way
        for d, u, o, w, k, way in zip(distinct.tolist(), unary, other, words, least.tolist(), ways.flushed(), strict=True)
    ]


def _decode(payloads: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """Ids of the payloads, a row for each; lanes by falling size, none empty."""
    lanes, steps = len(sizes), int(sizes.max())
    heads = np.array([_HEAD.unpack_from(p) for p in payloads], np.int64)
    distinct = heads[:, 0]
    names, counts, behind = _untables(payloads, distinct, heads[:, 1], heads[:, 3])
    begins = np.cumsum(distinct) - distinct
    n_given = np.add.reduceat(counts, begins)
    order = np.argsort(-n_given, kind="stable")
    n_sorted, starts = n_given[order], (np.cumsum(n_given) - n_given)[order]
    last = n_sorted - 1
    ends = (behind + heads[:, 2] * 2).tolist()
    behind = behind.tolist()
    coder = _In([payloads[i][behind[i] : ends[i]] for i in order.tolist()])
    shares = _shares(counts, begins, distinct)
    # Each unit of a lane's range under order 0 belongs to one of its ids.
    owners = np.repeat(np.arange(len(names), dtype=np.int32), counts)
    given = np.zeros(int(n_given.sum()) + 1, np.int32)
    for step, n in enumerate(_alive(n_sorted)):
        unit = _unit(coder.range[:n], n_sorted[:n])
        place = np.minimum(_unit(coder.code[:n], unit), last[:n])
        place += starts[:n]
        which = owners.take(place)
        given[starts[:n] + step] = which
        share = shares.take(which)
        coder.narrow(n, (share >> 32) * unit, (share & _LOW32) * unit)
        coder.move(n)
    given[:-1] -= np.repeat(begins, n_given).astype(np.int32)
    given = given.astype(np.uint16 if distinct.max() < 1 << 14 else np.uint32)
    ranks = np.zeros((steps, lanes), given.dtype)
    ways = _In([p[e:] for p, e in zip(payloads, ends, strict=True)])
    _follow(sizes, int(distinct.max()), ways, ranks, (given, np.cumsum(n_given) - n_given))
    places = ranks.T.astype(np.int64)
    places += begins[:, None]
    return names.astype("<u4").take(places, mode="clip")


def encode(blocks: list[np.ndarray]) -> list[bytes]:
    """Payloads of ``blocks``, arrays of ids under 65,536."""
    sizes = np.array([len(b) for b in blocks], np.int64)
    order = [i for i in np.argsort(-sizes, kind="stable").tolist() if sizes[i]]
    out = [b""] * len(blocks)
    if order:
        ids = np.zeros((len(order), int(sizes.max())), np.int32)
        for row, i in zip(ids, order, strict=True):
            if blocks[i].max() >= 1 << 16 or blocks[i].min() < 0:
                raise ValueError("ids must be under 65536")
            row[: sizes[i]] = blocks[i]
        for i, payload in zip(order, _encode(ids, sizes[order]), strict=True):
            out[i] = payload
    return out


def decode(payloads: list[bytes], sizes: list[int]) -> list[np.ndarray]:
    size = np.array(sizes, np.int64)
    order = [i for i in np.argsort(-size, kind="stable").tolist() if size[i]]
    out = [np.zeros(0, "<u4")] * len(payloads)
    if order:
        ids = _decode([payloads[i] for i in order], size[order])
        for row, i in zip(ids, order, strict=True):
            out[i] = row[: size[i]].copy()
    return out
