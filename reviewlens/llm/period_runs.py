"""Runs of periodically repeated words by internal pattern matching.

A run is a stretch of consecutive words with smallest period q, of at least ``LEAST_WORDS`` words and
``LEAST_EXPONENT`` periods, that no neighbouring word extends. Texts of a batch become one sequence of word
numbers with a separator of its own after each text. Prefix doubling sorts its suffixes; after the step of
length L each dyadic block (L words from a multiple of L) knows its interval of the suffix array. A run with
period q in [L/2, L) has at least 4q words, so it holds a whole block of length L that recurs q words before or
after itself, inside the run and not nearer. The block therefore asks the neighbouring windows for its nearest
occurrences: range successor and predecessor of its own position in its interval, by a wavelet matrix over the suffix
array. Occurrences so near form an arithmetic progression, whose difference is the candidate period; the stretch
is then extended word by word and kept if it is long enough.

Nothing is shuffled; a batch holds about ``BATCH_WORDS`` words, or one text if that is longer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import portions

LEAST_WORDS = 6
LEAST_EXPONENT = 4
#: Words of short texts that are sorted together.
BATCH_WORDS = 1 << 18

Rewrite = Callable[[int | None, list[bytes]], list[bytes]]


class WaveletMatrix:
    """Order statistics of any range of a sequence of numbers below ``1 << bits``, for arrays of queries."""

    def __init__(self, values: np.ndarray, bits: int):
        self.levels = []
        for bit in range(bits - 1, -1, -1):
            ones = (values >> bit & 1).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            words = np.zeros(len(values) // 64 + 1, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            before = np.zeros(len(words), np.int64)
            np.cumsum(np.bitwise_count(words[:-1]), out=before[1:])
            zeros = len(values) - int(np.count_nonzero(ones))
            self.levels.append((1 << bit, words, before, zeros))
            values = np.concatenate((values[~ones], values[ones]))

    @staticmethod
    def _ones(words: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[at >> 6] + np.bitwise_count(words[at >> 6] & low)

    def smaller(self, left: np.ndarray, right: np.ndarray, than: np.ndarray) -> np.ndarray:
        """How many values of [left, right) are smaller than ``than``."""
        count = np.zeros(len(left), np.int64)
        for bit, words, before, zeros in self.levels:
            l1, r1 = self._ones(words, before, left), self._ones(words, before, right)
            one = (than & bit) != 0
            count += np.where(one, (right - r1) - (left - l1), 0)
            left, right = np.where(one, zeros + l1, left - l1), np.where(one, zeros + r1, right - r1)
        return count

    def ranked(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The value of [left, right) that has ``rank`` smaller ones in it."""
        value = np.zeros(len(left), np.int64)
        for bit, words, before, zeros in self.levels:
            l1, r1 = self._ones(words, before, left), self._ones(words, before, right)
            none = (right - r1) - (left - l1)
            one = rank >= none
            value += np.where(one, bit, 0)
            rank = np.where(one, rank - none, rank)
            left, right = np.where(one, zeros + l1, left - l1), np.where(one, zeros + r1, right - r1)
        return value


def _refine(rank: np.ndarray, live: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """One doubling step: ``live`` positions share their first ``length`` words with others, ``rank`` is the
    start of their interval. Ranks are refined in place; what is still shared is given back with interval sizes."""
    after = live + length
    second = np.where(after < len(rank), rank[np.minimum(after, len(rank) - 1)], -1)
    key = rank[live] * (len(rank) + 1) + second + 1
    order = np.argsort(key, kind="stable")
    live, key = live[order], key[order]
    first = rank[live]
    new = np.ones(len(live), bool)
    new[1:] = key[1:] != key[:-1]
    bucket = np.ones(len(live), bool)
    bucket[1:] = first[1:] != first[:-1]
    index = np.arange(len(live))
    group = np.flatnonzero(new)
    size = np.diff(np.append(group, len(live)))
    start = np.repeat(group, size)
    rank[live] = first + start - np.maximum.accumulate(np.where(bucket, index, 0))
    size = np.repeat(size, size)
    shared = size > 1
    return live[shared], size[shared]


def _candidates(ids: np.ndarray, longest: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(block length, block, period) where a block recurs one period before or after itself; ``ids`` are numbered densely."""
    n = len(ids)
    count = np.bincount(ids)
    rank = (np.cumsum(count) - count)[ids]
    live = np.flatnonzero(count[ids] > 1)
    blocks, kept, length = [], [], 1
    while len(live) and 2 * length <= longest // 2:
        live, size = _refine(rank, live, length)
        length *= 2
        asking = live % length == 0
        if length == 2:  # the period is 1, so the two words of the block are equal
            equal = ids[live[asking]] == ids[live[asking] + 1]
            starts, sizes = live[asking][equal], size[asking][equal]
            kept.append(live[np.isin(rank[live], rank[starts])] if len(starts) else live[:0])
        else:
            starts, sizes = live[asking], size[asking]
            if length == 4:
                kept.append(live)
        if len(starts):
            blocks.append((length, starts, rank[starts].copy(), sizes))
    if not blocks:
        return []
    kept = np.unique(np.concatenate(kept))
    suffixes = kept[np.argsort(rank[kept], kind="stable")]
    ranks = rank[suffixes]
    matrix = WaveletMatrix(suffixes.astype(np.int64), max(n.bit_length(), 1))
    found = []
    for length, starts, low, size in blocks:
        left = np.searchsorted(ranks, low)
        right = left + size
        own = matrix.smaller(left, right, starts)
        for some, rank_of in ((own + 1 < size, own + 1), (own > 0, own - 1)):
            near = matrix.ranked(left[some], right[some], rank_of[some])
            period = np.abs(near - starts[some])
            fits = (period < length) & (2 * period >= length)
            found.append((length, starts[some][fits], period[fits]))
    return found


def _ahead(ids: np.ndarray, at: int, period: int) -> int:
    """The first position from ``at`` whose word differs from the one a period later."""
    step, last = 64, len(ids) - period
    while at < last:
        end = min(at + step, last)
        differs = ids[at:end] != ids[at + period : end + period]
        if differs.any():
            return at + int(differs.argmax())
        at, step = end, min(2 * step, 1 << 16)
    return last


def _behind(ids: np.ndarray, at: int, period: int) -> int:
    """The first position of the stretch around ``at`` in which words equal the ones a period later."""
    step = 64
    while at > 0:
        begin = max(at - step, 0)
        differs = ids[begin:at] != ids[begin + period : at + period]
        if differs.any():
            return at - int(differs[::-1].argmax())
        at, step = begin, min(2 * step, 1 << 16)
    return 0


def sequence_runs(ids: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence of dense numbers, by start, then period.

    Texts in it end in a number that occurs nowhere else; no run spans one. ``longest`` is the longest text.
    """
    found = []
    for length, starts, periods in _candidates(ids, longest):
        if not len(starts):
            continue
        order = np.lexsort((starts, periods))
        starts, periods = starts[order], periods[order]
        edges = np.flatnonzero(np.diff(periods)) + 1
        for begin, end in zip([0, *edges.tolist()], [*edges.tolist(), len(periods)], strict=True):
            period, at = int(periods[begin]), begin
            while at < end:
                block = int(starts[at])
                # The block is longer than the period, so its first word recurs a period later in either case.
                first, stop = _behind(ids, block, period), _ahead(ids, block, period) + period
                if stop - first >= max(LEAST_WORDS, LEAST_EXPONENT * period):
                    found.append((first, stop - first, period))
                # Blocks that lie in the stretch would find it again.
                at = max(at + 1, begin + int(np.searchsorted(starts[begin:end], stop - length, "right")))
    return sorted(set(found), key=lambda run: (run[0], run[2]))


def text_runs(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each list of words, with starts counted from the text's first word."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    longest = int(sizes.max(initial=0))
    if longest < LEAST_WORDS:
        return [[] for _ in texts]
    flat = np.empty(int(sizes.sum()), object)
    flat[:] = [word for words in texts for word in words]
    words, known = pd.factorize(flat)
    ends = np.cumsum(sizes)
    # A separator after every text: numbers behind those of the words, each used once.
    ids = np.insert(words.astype(np.int64), ends, len(known) + np.arange(len(texts)))
    begins = ends - sizes + np.arange(len(texts))
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, length, period in sequence_runs(ids, longest):
        text = int(np.searchsorted(begins, start, "right")) - 1
        found[text].append((start - int(begins[text]), length, period))
    return found


def kept_words(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not found:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


RUNS = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"
_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def period_runs(docs: DataFrame, rewrite: Rewrite | None = None) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row, in its whole text.

    ``runs`` are ordered by start, then period; ``collapsed`` has the words that no run holds after its first
    period, joined by one space. ``rewrite`` may change the words of a document (doc_id, words) before.
    A null or blank text has no words, no runs and an empty ``collapsed``; repeated rows are treated one by one, a
    null doc_id stays null, other columns are not read, and an empty table gives no rows.
    """

    def solve(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        found = text_runs(texts)
        runs = [[{"start": s, "length": n, "period": q} for s, n, q in one] for one in found]
        collapsed = [b" ".join(kept_words(words, one)) for words, one in zip(texts, found, strict=True)]
        columns = [
            pa.array(ids, pa.int64()),
            pa.array([len(words) for words in texts], pa.int64()),
            pa.array(runs, _RUN),
            pa.array(collapsed, pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[list[bytes]] = []
        total = 0
        for batch in portions(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = (text.as_py() or b"").split()
                if rewrite is not None:
                    words = rewrite(doc_id, words)
                ids.append(doc_id)
                texts.append(words)
                total += len(words)
                if total >= BATCH_WORDS:
                    yield solve(ids, texts)
                    ids, texts, total = [], [], 0
        if ids:
            yield solve(ids, texts)

    columns = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary"))
    found = columns.mapInArrow(run, RUNS)
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def digests(found: DataFrame) -> DataFrame:
    """(doc_id, n_runs, the run of greatest length/period or nulls, digests of all runs and of the collapsed text)."""
    wide = "decimal(19,0)"
    # Runs come by start, then period, so only a greater exponent takes the place of an earlier run.
    best = F.aggregate(
        "runs",
        F.lit(None).cast("struct<start:long,length:long,period:long>"),
        lambda held, run: F.when(
            held.isNull()
            | (run["length"].cast(wide) * held["period"].cast(wide) > held["length"].cast(wide) * run["period"].cast(wide)),
            run,
        ).otherwise(held),
    )
    lines = F.transform("runs", lambda run: F.concat(run["start"], F.lit(","), run["length"], F.lit(","), run["period"], F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )
