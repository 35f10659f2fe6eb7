"""Byte-pair encoding of a batch of texts at once: every different word of the batch is merged once.

The texts of a batch are cut into words by the classes of their bytes, and Arrow finds the different ones. These lie
in a matrix of one width; in each round every word merges its pair of lowest rank, the leftmost of equal ones, and so
becomes one token shorter, as wide as the words that join it there. The ids are those of ``bpe.Codec``, which
encodes words of more than ``WIDEST`` bytes and texts with special tokens.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex

from reviewlens.llm.bpe import WHITE, Codec, codec, normal

#: Bytes of text that are cut into words at once, unless a single text has more, and the longest word of a matrix.
BYTES = 2 << 20
WIDEST = 64
_WHITE, _LETTER, _NUMBER, _OTHER = range(4)
#: What the vocabulary's pattern takes as one word after an apostrophe.
_SHORT, _LONG = b"stmd", (b"re", b"ve", b"ll")
_white = re.compile(f"[{WHITE}]").search
_EMPTY = np.uint64(2**64 - 1)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of each code point."""
    found = np.full(0x110000, _OTHER, np.uint8)
    points = [*range(0xD800), *range(0xE000, 0x110000)]
    every = "".join(map(chr, points))
    at = np.array(points)
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_WHITE, f"[{WHITE}]+")):
        for match in regex.finditer(pattern, every):
            found[at[match.start() : match.end()]] = kind
    return found


def _byte_classes(text: str, data: np.ndarray) -> np.ndarray:
    """The class of each byte of a text, which is that of its character."""
    if text.isascii():
        return classes()[:128][data]
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    return np.repeat(classes()[points], 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF).astype(np.int64))


def cut(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The text's bytes without white space, the offsets of its words in them, and each word's first byte in the text."""
    data = np.frombuffer(text.encode(), np.uint8)
    kind = _byte_classes(text, data)
    begins = np.empty(len(data), bool)
    begins[:1] = True
    np.not_equal(kind[1:], kind[:-1], out=begins[1:])
    begins |= (kind == _NUMBER) & ((data & 0xC0) != 0x80)
    quotes = np.flatnonzero((data == ord("'")) & begins)
    if len(quotes):
        _cut_at_apostrophes(data, begins, quotes)
    solid = kind != _WHITE
    begins &= solid
    places, solid_data = np.flatnonzero(begins), data[solid]
    return solid_data, np.append(np.cumsum(solid)[places] - 1, len(solid_data)), places


def _cut_at_apostrophes(data: np.ndarray, begins: np.ndarray, quotes: np.ndarray) -> None:
    """``'s`` and the like are words of their own where a word begins with the apostrophe."""
    padded = np.concatenate((data, np.zeros(3, np.uint8)))
    one, two = padded[quotes + 1], padded[quotes + 2]
    size = np.where(np.isin(one, list(_SHORT)), 2, 0)
    for a, b in _LONG:
        size[(one == a) & (two == b)] = 3
    quotes, size = quotes[size > 0], size[size > 0]
    begins[quotes + 1] = False
    ends = quotes + size
    begins[ends[ends < len(data)]] = True


class Merger:
    """Encodes many words at once by the merges of a codec."""

    def __init__(self, own: Codec):
        self.codec = own
        self.none = len(own.ranked)
        self.whole = np.array([own.merged[pair] for pair in own.ranked] + [0], np.int64)
        self.first = np.array(own.atoms, np.int64)
        keys = np.array([left << 32 | right for left, right in own.ranked], np.uint64)
        self.bits = np.uint64(64 - max(4, (4 * len(keys)).bit_length()))
        self.mask = (1 << (64 - int(self.bits))) - 1
        self.keys = np.full(self.mask + 1, _EMPTY, np.uint64)
        self.ranks = np.full(self.mask + 1, self.none, np.int32)
        left, probe = np.arange(len(keys)), 0
        while len(left):
            slot = self._slot(keys[left], probe)
            _, one = np.unique(slot, return_index=True)
            one = one[self.keys[slot[one]] == _EMPTY]
            self.keys[slot[one]], self.ranks[slot[one]] = keys[left[one]], left[one]
            left, probe = np.delete(left, one), probe + 1

    def _slot(self, keys: np.ndarray, probe: int) -> np.ndarray:
        return (((keys * _SPREAD) >> self.bits).astype(np.int64) + probe) & self.mask

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank at which each pair is merged, or ``none``."""
        key = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        slot = self._slot(key, 0)
        held = self.keys[slot]
        found, other, probe = self.ranks[slot], held != key, 1
        found[other] = self.none
        wrong = np.flatnonzero(other & (held != _EMPTY))
        while len(wrong):
            slot = self._slot(key[wrong], probe)
            held = self.keys[slot]
            hit = held == key[wrong]
            found[wrong[hit]] = self.ranks[slot[hit]]
            wrong, probe = wrong[~hit & (held != _EMPTY)], probe + 1
        return found

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words one behind the other, and the offsets of each word's ids."""
        size = np.diff(offsets)
        atoms = data.astype(np.int64)
        atoms[offsets[1:] - 1] += 256
        symbols = self.first[atoms]
        order = np.argsort(size, kind="stable")
        count = np.zeros(len(size), np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        for w in order[np.searchsorted(size[order], WIDEST, "right") :].tolist():
            word = data[offsets[w] : offsets[w + 1]].tobytes().decode()
            ids = np.frombuffer(self.codec.encode_word(word), "<u4").astype(np.int64)
            count[w] = len(ids)
            done.append((np.array([w]), ids[None, :]))
        edges = np.searchsorted(size[order], np.arange(WIDEST + 2))
        words, ids, ranks = np.empty(0, np.int64), np.empty((0, WIDEST), np.int64), np.empty((0, WIDEST - 1), np.int32)
        for width in range(WIDEST, 0, -1):
            fresh = order[edges[width] : edges[width + 1]]
            if len(fresh):
                new = symbols[offsets[fresh][:, None] + np.arange(width)]
                words, ids = np.concatenate((words, fresh)), np.concatenate((ids, new))
                ranks = np.concatenate((ranks, self.rank(new[:, :-1].ravel(), new[:, 1:].ravel()).reshape(len(new), width - 1)))
            if width > 1 and len(words):
                at = ranks.argmin(axis=1)
                best = ranks[np.arange(len(at)), at]
                ended = best == self.none
                done.append((words[ended], ids[ended]))
                count[words[ended]] = width
                go = ~ended
                words, ids, ranks = words[go], ids[go], ranks[go]
                ids, ranks = self._merge(ids, ranks, at[go], best[go])
            elif width > 1:
                ids, ranks = ids[:, :-1], ranks[:, :-1]
        done.append((words, ids))
        count[words] = 1
        ends = np.concatenate(([0], np.cumsum(count)))
        flat = np.empty(ends[-1], "<u4")
        for words, ids in done:
            flat[ends[words][:, None] + np.arange(ids.shape[1])] = ids
        return flat, ends

    def _merge(self, ids: np.ndarray, ranks: np.ndarray, at: np.ndarray, best: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row's pair at ``at`` becomes one token; the ranks beside it are looked up anew."""
        n, width = ids.shape
        row = np.arange(n)
        ids[row, at] = self.whole[best]
        keep = np.ones((n, width), bool)
        keep[row, at + 1] = False
        ids = ids[keep].reshape(n, width - 1)
        keep = np.ones((n, width - 1), bool)
        keep[row, at] = False
        ranks = ranks[keep].reshape(n, width - 2)
        before, after = np.flatnonzero(at > 0), np.flatnonzero(at < width - 2)
        rows, left = np.concatenate((before, after)), np.concatenate((at[before] - 1, at[after]))
        ranks[rows, left] = self.rank(ids[rows, left], ids[rows, left + 1])
        return ids, ranks


@lru_cache(maxsize=2)
def merger(path: str) -> Merger:
    """One merger per worker process and file."""
    return Merger(codec(path))


def _segments(text: str) -> Iterator[str]:
    """The text in parts of about ``BYTES`` characters that end at white space."""
    at = 0
    while len(text) - at > BYTES and (end := _white(text, at + BYTES)):
        yield text[at : end.start()]
        at = end.start()
    yield text[at:] if at else text


def encode_texts(path: str, texts: Iterable[str | None]) -> Iterator[bytes]:
    """Little-endian unsigned 32-bit ids of each text, in order; a null text has none."""
    own, held, size = merger(path), [], 0
    for text in texts:
        if text and "<|" in text:
            yield from _encode(own, held)
            yield b"".join(own.codec.encode_parts(text))
            held, size = [], 0
            continue
        plain = normal(text or "")
        if size + len(plain) > BYTES:
            yield from _encode(own, held)
            held, size = [], 0
        if len(plain) > BYTES:
            yield b"".join(ids for part in _segments(plain) for ids in _encode(own, [part]))
        else:
            held.append(plain)
            size += len(plain)
    yield from _encode(own, held)


def _encode(own: Merger, texts: list[str]) -> Iterator[bytes]:
    """The ids of normalized texts without special tokens."""
    data, offsets, places = cut("\n".join(texts))
    if not len(places):
        yield from [b""] * len(texts)
        return
    words = pa.Array.from_buffers(pa.large_binary(), len(places), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    found = words.dictionary_encode()
    _, starts, letters = found.dictionary.buffers()
    starts = np.frombuffer(starts, np.int64, len(found.dictionary) + 1)
    ids, ends = own.encode(np.frombuffer(letters, np.uint8, starts[-1]), starts)
    tokens = pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(4 * ends), pa.py_buffer(ids)])
    _, edges, every = tokens.take(found.indices).buffers()
    edges = np.frombuffer(edges, np.int64, len(places) + 1)
    sizes = [(len(x) if x.isascii() else len(x.encode())) + 1 for x in texts]
    cuts, held = edges[np.searchsorted(places, np.cumsum([0, *sizes]))].tolist(), memoryview(every)
    for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
        yield bytes(held[begin:end])
