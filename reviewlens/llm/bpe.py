"""Byte-pair encoding by backtracking over Aho-Corasick matches, and decoding from an offset table.

A word is read once by an Aho-Corasick automaton of the vocabulary, which gives the longest token at each
position. The encoder takes these greedily; a token may follow another only if the two are compatible, that
is, if merging their joined text in rank order gives back exactly the two. Where no token fits, it takes a
shorter one, or steps back. Compatibility is decided from the merge table alone and remembered per pair,
so the merges are exact and a word costs time in proportion to its length.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from functools import lru_cache
from struct import pack

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import map_batches

#: Entries of each of two generations that a worker process remembers: bounds its memory, not the work.
REMEMBERED = 250_000
LONGEST_KEY = 256
END = "</w>"
#: What the vocabulary's own pattern takes as white space, as a word, and as special text.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECE = rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{WHITE}\p{{L}}\p{{N}}]+"

_pieces = regex.compile(PIECE).findall
_white = re.compile(rf"[{WHITE}]+")
_not_white_to_onig = re.compile(r"[\x1c-\x1f]").search


class Remembered(dict):
    """A dict that fills itself by ``make``. When it is full it becomes the old one, from which what is used is taken over."""

    def __init__(self, make):
        super().__init__()
        self.make = make
        self.old: dict = {}

    def __missing__(self, key):
        value = self.old.pop(key, None)
        if value is None:
            value = self.make(key)
            if len(key) > LONGEST_KEY:
                return value
        if len(self) >= REMEMBERED:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    letters, spare = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in letters:
            letters[b] = chr(spare)
            spare += 1
    return [letters[b] for b in range(256)]


def normal(text: str) -> str:
    """NFC, then lower case letter by letter (no special final sigma)."""
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def chunks(text: str) -> list[str]:
    """The stretches of a text between white space."""
    return [c for c in _white.split(text) if c] if _not_white_to_onig(text) else text.split()


class Codec:
    """Encoder and decoder of one vocabulary with word ends, built from its JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        byte_of = {letter: b for b, letter in enumerate(byte_letters())}

        def atoms(token: str) -> str:
            """One character per byte; the last byte of a word is 256 higher."""
            if token.endswith(END) and len(token) > len(END):
                body = [byte_of[c] for c in token[: -len(END)]]
                return "".join(map(chr, body[:-1])) + chr(256 + body[-1])
            return "".join(chr(byte_of[c]) for c in token)

        size = max(*vocab.values(), *self.special.values()) + 1
        self.length = [0] * size
        self.shorter = [-1] * size
        self.rank = [-1] * size
        self.parts: list[tuple[int, int]] = [(-1, -1)] * size
        self.merged: dict[tuple[int, int], int] = {}
        #: The pairs in the order in which they are merged.
        self.ranked: list[tuple[int, int]] = [(vocab[left], vocab[right]) for left, right in merges]
        self.automaton = ahocorasick.Automaton()
        spelled = {atoms(token): i for token, i in vocab.items()}
        #: The token of each byte, and of each byte at the end of a word.
        self.atoms = [spelled[chr(b)] for b in range(512)]
        for text, i in spelled.items():
            self.length[i] = len(text)
            self.automaton.add_word(text, i)
            self.shorter[i] = next((spelled[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in spelled), -1)
        self.automaton.make_automaton()
        for rank, (left, right) in enumerate(merges):
            whole = vocab[left + right]
            self.rank[whole], self.parts[whole] = rank, (vocab[left], vocab[right])
            self.merged[vocab[left], vocab[right]] = whole
        self.known: dict[int, bool] = {}
        self.encoded = Remembered(self._encode_chunk)
        self.decoded = Remembered(self._decode_ids)

        names = [b""] * size
        for token, i in [*vocab.items(), *self.special.items()]:
            names[i] = token.encode()
        self.blob = b"".join(names)
        self.offset = [0, *np.cumsum([len(n) for n in names]).tolist()]

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging in rank order leaves ``left`` and ``right`` as two tokens; remembered per pair.

        Undoes the later of the two merges again and again. While two inner tokens stood side by side, a
        merge of them would have come first if its rank is lower than that of the merge just undone; at
        equal rank the one further left comes first.
        """
        key = left << 20 | right
        rank, parts, merged = self.rank, self.parts, self.merged
        before, found = len(self.merged) + 1, True
        while True:
            joined = merged.get((left, right))
            if joined is not None and rank[joined] < before:
                found = False
                break
            if rank[left] < 0 and rank[right] < 0:
                break
            if rank[left] > rank[right]:
                before, left = rank[left], parts[left][1]
            else:
                before, right = rank[right] + 1, parts[right][0]
        if len(self.known) >= 2 * REMEMBERED:
            self.known.clear()
        self.known[key] = found
        return found

    def encode_word(self, word: str) -> bytes:
        raw = word if word.isascii() else word.encode("utf-8").decode("latin-1")
        text = raw[:-1] + chr(256 + ord(raw[-1]))
        n, length, shorter, known = len(text), self.length, self.shorter, self.known
        longest = [-1] * n
        for end, token in self.automaton.iter(text):  # ends ascend, so the last match of a start is its longest
            longest[end + 1 - length[token]] = token
        open_at = bytearray(b"\1") * (n + 1)
        found: list[int] = []
        at, last, token = 0, -1, longest[0]
        while True:
            pair = last << 20
            while token >= 0:
                end = at + length[token]
                if open_at[end]:
                    if last < 0:
                        break
                    fits = known.get(pair | token)
                    if fits or (fits is None and self.compatible(last, token)):
                        break
                token = shorter[token]
            if token >= 0:
                found.append(token)
                if end == n:
                    return pack(f"<{len(found)}I", *found)
                at, last, token = end, token, longest[end]
            else:
                open_at[at] = 0
                token = found.pop()
                at -= length[token]
                token = shorter[token]
                last = found[-1] if found else -1

    def _encode_chunk(self, chunk: str) -> bytes:
        if chunk.isalpha():
            return self.encode_word(chunk)
        pieces = (chunk[:-1], chunk[-1]) if chunk[-1] in ".,;:" and chunk[:-1].isalpha() else _pieces(chunk)
        encoded = self.encoded
        return b"".join([encoded[p] for p in pieces]) if len(pieces) > 1 else self.encode_word(chunk)

    def _decode_ids(self, ids: bytes) -> bytes:
        blob, offset = self.blob, self.offset
        return b" ".join([blob[offset[i] : offset[i + 1]] for i in np.frombuffer(ids, "<u4").tolist()])

    def encode_parts(self, text: str | None) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each stretch between white space or special tokens."""
        encoded = self.encoded
        if not text:
            return []
        if "<|" not in text:
            return list(map(encoded.__getitem__, chunks(normal(text))))
        found: list[bytes] = []
        for part in self._special.split(text):
            if part in self.special:
                found.append(np.array([self.special[part]], "<u4").tobytes())
            else:
                found += map(encoded.__getitem__, chunks(normal(part)))
        return found

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(b"".join(self.encode_parts(text)), "<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        return self._decode_ids(np.array(ids, "<u4").tobytes()).decode("utf-8")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per worker process and file."""
    return Codec(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids array<int>, decoded string) of each whole text. Null texts count as empty: no ids, empty text."""

    def run(batch: pa.RecordBatch) -> dict:
        own = codec(path)
        parts = [own.encode_parts(text) for text in batch.column(1).to_pylist()]
        return {
            "doc_id": batch.column(0),
            "ids": pa.array([np.frombuffer(b"".join(p), "<i4") for p in parts], pa.list_(pa.int32())),
            "decoded": pa.array([b" ".join([own.decoded[x] for x in p]).decode("utf-8") for p in parts], pa.string()),
        }

    return map_batches(_input(docs), run, "doc_id long, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): ``encode`` with its two wide columns digested in the task.

    A null or empty text has no tokens; repeated rows are encoded one by one, a null doc_id stays null, other
    columns are not read, and an empty table gives no rows.
    """

    def run(batch: pa.RecordBatch) -> dict:
        own, n, ids, texts = codec(path), [], [], []
        for text in batch.column(1).to_pylist():
            parts = own.encode_parts(text)
            joined = b"".join(parts)
            n.append(len(joined) // 4)
            ids.append(hashlib.sha256(joined).hexdigest())
            texts.append(hashlib.sha256(b" ".join(map(own.decoded.__getitem__, parts))).hexdigest())
        return {"doc_id": batch.column(0), "n_tokens": pa.array(n, pa.int64()), "ids_sha256": ids, "decoded_sha256": texts}

    columns = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_batches(_input(docs), run, columns)


def _input(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
