"""Token ids by a published tokenizer file, one distinct piece of text at a time."""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from rideloom.llm.batches import kept_for_stage

#: Blanks that other rules than the two split on below can see; texts with them are encoded whole.
_ODD_BLANK = re.compile(r"[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028\u2029\u202f\u205f\u3000\ufeff]")
#: Pieces and bytes of them that are kept.
_MAX_CACHED, _MAX_BYTES = 1_200_000, 64 << 20
_LETTER, _MARK, _BLANK, _ODD = 1, 2, 4, 8


def _kinds() -> np.ndarray:
    """Kind of each byte: letters and punctuation of ASCII, blanks, and those with which an odd blank may begin."""
    out = np.zeros(256, np.uint8)
    out[[c for c in range(33, 127) if not chr(c).isalnum()]] = _MARK
    out[[c for c in range(128) if chr(c).isalpha()]] = _LETTER
    out[[*b"\t\r\x0b\x0c\x1c\x1d\x1e\x1f\xc2\xe1\xe2\xe3\xef"]] = _ODD
    out[[*b" \n"]] = _BLANK
    return out


_KIND = _kinds()


def _binary(offsets: np.ndarray, data) -> pa.Array:
    """The parts of ``data`` between the offsets."""
    wide = int(offsets[-1]) >> 31 > 0
    ends = pa.py_buffer(np.ascontiguousarray(offsets, np.int64 if wide else np.int32))
    return pa.Array.from_buffers(pa.large_binary() if wide else pa.binary(), len(offsets) - 1, [None, ends, pa.py_buffer(data)])


def _parts(pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the pieces, one after the other, and the offsets of them."""
    sizes = pc.binary_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    data = b"".join(pieces.to_pylist()) if pieces.offset else pieces.buffers()[2]
    return np.frombuffer(data or b"", np.uint8)[: ends[-1]], ends


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes.

    A byte-level BPE file with its usual split pattern never merges across the start of a run of blanks, nor
    from a letter to a punctuation mark behind it. Such a text's ids are therefore the ids of its pieces, and
    every distinct piece is encoded once. Any other file, and texts with unusual blanks or special tokens, go
    through the library whole.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        split = parts.get("pre_tokenizer") or {}
        self.by_piece = (
            parts.get("normalizer") is None
            and split.get("type") == "ByteLevel"
            and not split.get("add_prefix_space", True)
            and split.get("use_regex", True)
            and not any(t.get("lstrip") or t.get("rstrip") or t.get("normalized") for t in parts["added_tokens"])
            and not any(set(t["content"]) & set(" \n") for t in parts["added_tokens"])
        )
        #: The same model for blanks and ASCII letters alone, whose split and names of bytes are known.
        self.of_words = Tokenizer(self.library.model)
        self.of_words.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        self.special = [t["content"].encode() for t in parts["added_tokens"]]
        self._clear()
        names = self.library.get_vocab()
        self.token_bytes = np.zeros(max(names.values()) + 1, np.int64)
        for name, i in names.items():  # a byte-level token has one character for each of its bytes
            self.token_bytes[i] = len(name)

    def _clear(self) -> None:
        self.pieces = pa.array([], pa.binary())
        self.ids = np.zeros(0, "<u4")
        self.ends = np.zeros(0, np.int64)

    def _encode(self, texts: list[str], library=None) -> list[np.ndarray]:
        found = (library or self.library).encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4") for x in found]

    def _learn(self, new: pa.Array) -> np.ndarray:
        """Keep the ids of new pieces and return their places among those kept.

        Pieces that begin with a blank are encoded as one text, which splits there.
        """
        data, ends = _parts(new)
        begins, kinds = ends[:-1], _KIND[data]
        other = np.add.reduceat((kinds != _LETTER).astype(np.int64), begins)
        blank = (kinds[begins] == _BLANK) & (kinds[ends[1:] - 1] != _BLANK)
        words = (other == 1) & (data[begins] == 32) & blank
        ids, sizes = [], np.zeros(len(new), np.int64)
        order = [np.flatnonzero(words), np.flatnonzero(blank & ~words), np.flatnonzero(~blank)]
        for some, one_by_one in zip(order, (False, False, True), strict=True):
            for start in range(0, len(some), 20_000):
                part = some[start : start + 20_000]
                taken = new.take(pa.array(part))
                if one_by_one:
                    found = self._encode([x.decode() for x in taken.to_pylist()])
                    ids += found
                    sizes[part] = [len(x) for x in found]
                    continue
                raw, cuts = _parts(taken)
                text = raw.tobytes().decode()
                if some is order[0]:
                    (found,) = self._encode([text.replace(" ", " \u0120")], self.of_words)
                else:
                    (found,) = self._encode([text])
                ids.append(found)
                stops = np.searchsorted(np.cumsum(self.token_bytes[found]), cuts[1:]) + 1
                sizes[part] = np.diff(stops, prepend=0)
        # The pieces are kept in the order in which they were encoded.
        order = np.concatenate(order)
        places = np.empty(len(new), np.int64)
        places[order] = np.arange(len(self.pieces), len(self.pieces) + len(new))
        self.pieces = pa.concat_arrays([self.pieces, new.take(pa.array(order))])
        stops = np.cumsum(sizes[order]) + len(self.ids)
        self.ids = np.concatenate([self.ids, *ids])
        self.ends = np.concatenate([self.ends, stops])
        return places

    def _numbers(self, distinct: pa.Array) -> np.ndarray:
        """Places of pieces among those kept, new ones included."""
        if len(self.pieces) > _MAX_CACHED or self.pieces.nbytes > _MAX_BYTES:
            self._clear()
        known = pc.index_in(distinct, value_set=self.pieces)
        new = np.flatnonzero(pc.is_null(known).to_numpy(zero_copy_only=False))
        places = pc.fill_null(known, -1).to_numpy().astype(np.int64)
        if len(new):
            places[new] = self._learn(distinct.take(pa.array(new)))
        return places

    def _whole(self, texts: list[bytes], kinds: np.ndarray, begins: np.ndarray) -> list[int]:
        """Texts that the library has to encode whole."""
        if not self.by_piece:
            return list(range(len(texts)))
        odd = np.unique(np.searchsorted(begins, np.flatnonzero(kinds == _ODD), "right") - 1)
        out = {i for i in odd.tolist() if _ODD_BLANK.search(texts[i].decode())}
        return sorted(out.union(i for i, t in enumerate(texts) if any(s in t for s in self.special)))

    def __call__(self, texts: list[str | bytes]) -> list[bytes]:
        texts = [t.encode() if isinstance(t, str) else t for t in texts]
        data = b"".join(texts)
        if not data:
            return [b""] * len(texts)
        kinds = _KIND[np.frombuffer(data, np.uint8)]
        sizes = np.array([len(t) for t in texts], np.int64)
        text_begins = np.cumsum(sizes) - sizes
        whole = self._whole(texts, kinds, text_begins)
        if len(whole) == len(texts):
            return [x.tobytes() for x in self._encode([t.decode() for t in texts])]
        start = np.zeros(len(data), bool)
        start[1:] = (kinds[1:] == _BLANK) & (kinds[:-1] != _BLANK) | (kinds[1:] == _MARK) & (kinds[:-1] == _LETTER)
        start[text_begins[sizes > 0]] = True
        skipped = np.zeros(len(texts), bool)
        for i in whole:  # not taken apart: they would be learned for nothing
            skipped[i] = True
            start[text_begins[i] + 1 : text_begins[i] + sizes[i]] = False
        begins = np.flatnonzero(start)
        del kinds, start
        pieces = _binary(np.append(begins, len(data)), data)
        # Where each text's pieces begin among them.
        firsts = np.searchsorted(begins, text_begins)
        counts = np.searchsorted(begins, text_begins + sizes) - firsts
        if whole:
            taken = np.ones(len(pieces), bool)
            taken[firsts[skipped & (sizes > 0)]] = False
            pieces = pieces.filter(pa.array(taken))
            counts[skipped] = 0
            firsts = np.cumsum(counts) - counts
        found = pieces.dictionary_encode()
        numbers = self._numbers(found.dictionary)
        at = found.indices.to_numpy()
        ends = self.ends[numbers]
        first = np.concatenate([[0], self.ends])[numbers]
        size = (ends - first)[at]
        stops = np.concatenate([[0], np.cumsum(size)])
        kind = np.int32 if max(stops[-1], len(self.ids)) < 1 << 31 else np.int64
        spread = np.repeat((first[at] - stops[:-1]).astype(kind), size)
        spread += np.arange(len(spread), dtype=kind)
        ids = self.ids[spread].tobytes()
        cuts = (stops[firsts] * 4).tolist()
        until = (stops[firsts + counts] * 4).tolist()
        out = [ids[a:b] for a, b in zip(cuts, until, strict=True)]
        for i, x in zip(whole, self._encode([texts[i].decode() for i in whole]), strict=True):
            out[i] = x.tobytes()
        return out


def encoder(path: str) -> Encoder:
    """The encoder for ``path`` of this process and stage."""
    return kept_for_stage(path, lambda: Encoder(path))
