"""Packing of token sequences into windows by minimum bin slack.

Only the histogram of remaining lengths (at most one count per length up to the window) reaches the driver.
There each window is filled by a subset-sum dynamic program whose reachable sums are the bits of one integer:
it picks the multiset of lengths closest to the capacity, and the counts are found by going back through the
stages. A multiset is used as often as the counts allow, so the number of programs follows the number of
lengths, not of documents. What no multiset fills is filled by cutting a remaining piece; the last tokens are
cut into powers of two, which need no padding.

The plan is a list of runs of equal pieces. Pieces find their place by their rank among those of their length:
a rank within the task that made them plus the counts of the tasks before it.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.llm.bpe_batch import encode_texts
from reviewlens.llm.common import portions, stored

WINDOW = 4096
END_OF_TEXT = 2


@dataclass
class Span:
    """``count`` pieces of full length ``whole``, from rank ``rank`` on: their tokens from ``start`` on, ``length`` of them."""

    whole: int
    rank: int
    count: int
    start: int
    length: int


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """How often to take each length so that the sum is as close to ``capacity`` as it can be.

    Lengths are tried from the longest on, and the program ends as soon as the capacity is met, so among
    equal sums the one with longer pieces wins. A length counts up to ``counts`` times, in binary portions.
    """
    mask, reachable = (1 << (capacity + 1)) - 1, 1
    stages: list[tuple[int, int, int]] = []
    for length in sorted(counts, reverse=True):
        left = min(counts[length], capacity // length)
        portion = 1
        while left > 0:
            take = min(portion, left)
            stages.append((length, take, reachable))
            reachable |= (reachable << (length * take)) & mask
            left -= take
            portion *= 2
        if reachable >> capacity & 1:
            break
    at = reachable.bit_length() - 1
    chosen: dict[int, int] = {}
    for length, take, before in reversed(stages):
        if not before >> at & 1:
            chosen[length] = chosen.get(length, 0) + take
            at -= length * take
    return chosen


class Pool:
    """What is still to be packed: spans by the length of their pieces."""

    def __init__(self, counts: dict[int, int]):
        self.spans: dict[int, list[Span]] = defaultdict(list)
        self.counts = {n: c for n, c in counts.items() if c > 0}
        for n, c in self.counts.items():
            self.spans[n].append(Span(n, 0, c, 0, n))

    def take(self, length: int, count: int) -> Iterator[Span]:
        self.counts[length] -= count
        if not self.counts[length]:
            del self.counts[length]
        held = self.spans[length]
        while count:
            last = held[-1]
            n = min(count, last.count)
            yield Span(last.whole, last.rank + last.count - n, n, last.start, last.length)
            last.count -= n
            count -= n
            if not last.count:
                held.pop()

    def give(self, span: Span) -> None:
        self.spans[span.length].append(span)
        self.counts[span.length] = self.counts.get(span.length, 0) + span.count


def plan(counts: dict[int, int], window: int = WINDOW) -> list[tuple[int, ...]]:
    """Runs (whole, rank, count, start, length, sequence, per, at, offset) that place every token once.

    The ``j``-th piece of a run is the ``at + j``-th of its kind: it lies in sequence ``sequence + (at + j) // per``,
    at ``offset + ((at + j) % per) * length``.
    """
    pool, runs, sequence = Pool(counts), [], 0

    def place(length: int, per: int, repeats: int, offset: int) -> None:
        at = 0
        for s in pool.take(length, per * repeats):
            runs.append((s.whole, s.rank, s.count, s.start, s.length, sequence, per, at, offset))
            at += s.count

    def cut(target: int, repeats: int, offset: int, longer: int) -> None:
        """``target`` tokens of a piece of length ``longer`` for each of ``repeats`` windows; the rest goes back."""
        at = 0
        for s in list(pool.take(longer, repeats)):
            runs.append((s.whole, s.rank, s.count, s.start, target, sequence, 1, at, offset))
            at += s.count
            pool.give(Span(s.whole, s.rank, s.count, s.start + target, s.length - target))

    while pool.counts:
        total = sum(n * c for n, c in pool.counts.items())
        capacity = window if total >= window else 1 << (total.bit_length() - 1)
        first = max((n for n in pool.counts if n <= capacity), default=0)
        chosen = {first: 1} if first else {}
        if first < capacity:
            left = dict(pool.counts)
            if first:
                left[first] -= 1
            for n, c in fullest({n: c for n, c in left.items() if c and n <= capacity - first}, capacity - first).items():
                chosen[n] = chosen.get(n, 0) + c
        slack = capacity - sum(n * c for n, c in chosen.items())
        if capacity < window:
            repeats, longer = 1, 0
        else:
            repeats = min(pool.counts[n] // c for n, c in chosen.items())
            longer = 0
        if slack:
            fits = [n for n, c in pool.counts.items() if n > slack and c > chosen.get(n, 0)]
            # The length that allows most windows at once is cut: a rare one would end the run after its few pieces.
            allowed = {n: pool.counts[n] // (chosen.get(n, 0) + 1) for n in fits}
            longer = max(fits, key=lambda n: (min(allowed[n], repeats), -n))
            repeats = min(repeats, allowed[longer])
        offset = 0
        for n in sorted(chosen, reverse=True):
            place(n, chosen[n], repeats, offset)
            offset += n * chosen[n]
        if slack:
            cut(slack, repeats, offset, longer)
        sequence += repeats
    return runs


class Places:
    """Looks up where the pieces of a length and rank go, for whole batches."""

    def __init__(self, runs: list[tuple[int, ...]]):
        by_whole: dict[int, list[tuple[int, ...]]] = defaultdict(list)
        for r in runs:
            by_whole[r[0]].append(r)
        lows, firsts, rows = [], [0], []
        for whole in sorted(by_whole):
            own = sorted(by_whole[whole], key=lambda r: (r[1], r[3]))
            edges = sorted({r[1] for r in own} | {r[1] + r[2] for r in own})
            here: list[tuple[int, ...]] = []
            queue = iter(own)
            following = next(queue, None)
            for low in edges[:-1]:
                here = [r for r in here if r[1] + r[2] > low]
                while following is not None and following[1] <= low:
                    here.append(following)
                    following = next(queue, None)
                lows.append((whole << 48) + low)
                rows += [(low - r[1] + r[7], r[3], r[4], r[5], r[6], r[8]) for r in here]
                firsts.append(len(rows))
        self.lows = np.array(lows, np.int64)
        self.firsts = np.array(firsts, np.int64)
        self.rows = np.array(rows, np.int64).reshape(-1, 6)

    def find(self, whole: np.ndarray, rank: np.ndarray) -> dict[str, np.ndarray]:
        """For each part of each piece: its piece, start, length, sequence and offset."""
        key = (whole.astype(np.int64) << 48) + rank
        interval = np.searchsorted(self.lows, key, "right") - 1
        n = self.firsts[interval + 1] - self.firsts[interval]
        piece = np.repeat(np.arange(len(key)), n)
        row = np.arange(len(piece)) - np.repeat(np.cumsum(n) - n, n) + self.firsts[interval][piece]
        base, start, length, sequence, per, offset = self.rows[row].T
        at = base + (key - self.lows[interval])[piece]
        return {
            "piece": piece,
            "start": start,
            "length": length,
            "sequence_id": sequence + at // per,
            "offset": offset + at % per * length,
        }


def tokenized(docs: DataFrame, path: str, window: int = WINDOW, end: int = END_OF_TEXT) -> DataFrame:
    """Pieces of at most ``window`` tokens: (doc_id, start, length, doc_tokens, ids binary, part, ordinal).

    ``part`` is the task and ``ordinal`` the rank among its pieces of that length.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), defaultdict(int)
        tail = np.array([end], "<u4").tobytes()
        for batch in portions(batches):
            doc, start, length, total, ids, ordinal = [], [], [], [], [], []
            for doc_id, own in zip(batch.column(0).to_pylist(), encode_texts(path, batch.column(1).to_pylist()), strict=True):
                every = own + tail
                tokens = len(every) // 4
                for s in range(0, tokens, window):
                    n = min(window, tokens - s)
                    doc.append(doc_id)
                    start.append(s)
                    length.append(n)
                    total.append(tokens)
                    ids.append(every[4 * s : 4 * (s + n)])
                    ordinal.append(seen[n])
                    seen[n] += 1
            longs = [pa.array(x, pa.int64()) for x in (doc, start, length, total)]
            yield pa.RecordBatch.from_arrays(
                [*longs, pa.array(ids, pa.binary()), pa.array([part] * len(doc), pa.int32()), pa.array(ordinal, pa.int64())],
                names=["doc_id", "start", "length", "doc_tokens", "ids", "part", "ordinal"],
            )

    columns = "doc_id long, start long, length long, doc_tokens long, ids binary, part int, ordinal long"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, columns)


def pack(docs: DataFrame, path: str, window: int = WINDOW, end: int = END_OF_TEXT) -> DataFrame:
    """(doc_id, start, length, doc_tokens, ids, sequence_id, offset): each token of each row in exactly one piece.

    ``ids`` are little-endian unsigned 32-bit ids. Null and empty texts are the one token ``end``. Rows that
    repeat a doc_id, or have none, are documents of their own. Sequences are gapless; each is ``window``
    tokens long but for the last few, whose lengths are powers of two. Other columns are not read. An empty
    table gives no rows. ``window`` must be a power of two below 2**15.
    """
    pieces = stored(tokenized(docs, path, window, end), "pieces")
    counts = stored(
        pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "piece-counts"
    )  # at most one row per task and length
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= window rows
    places = docs.sparkSession.sparkContext.broadcast(Places(plan(histogram, window)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(
        counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip")), "piece-offsets"
    )
    spot = "array<struct<start:long,length:long,sequence_id:long,offset:long>>"

    @F.arrow_udf(spot)
    def spots(whole: pa.Array, rank: pa.Array) -> pa.Array:
        found = places.value.find(whole.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False))
        names = ["start", "length", "sequence_id", "offset"]
        ends = np.concatenate(([0], np.cumsum(np.bincount(found["piece"], minlength=len(whole)))))
        parts = pa.StructArray.from_arrays([pa.array(found[n], pa.int64()) for n in names], names=names)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), parts)

    # Only lengths and ranks cross to Python; the ids stay where they are.
    placed = pieces.join(offsets, ["length", "part"], "left").select(
        "doc_id", "start", "doc_tokens", "ids", F.explode(spots("length", F.col("skip") + F.col("ordinal"))).alias("spot")
    )
    return placed.select(
        "doc_id",
        (F.col("start") + F.col("spot.start")).alias("start"),
        "spot.length",
        "doc_tokens",
        F.substring("ids", (4 * F.col("spot.start") + 1).cast("int"), (4 * F.col("spot.length")).cast("int")).alias("ids"),
        "spot.sequence_id",
        "spot.offset",
    )


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids binary): the packed sequences themselves, each bounded by the window."""
    held = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.aggregate(held, F.lit(b""), lambda whole, piece: F.concat(whole, piece["ids"])).alias("ids")
    )


def digests(packed: DataFrame) -> DataFrame:
    """``packed`` with a CRC-32 in place of the ids."""
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def crc32(ids: list[int]) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())
