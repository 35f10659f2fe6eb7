"""Scoring of texts by a probabilistic suffix tree that is learned from the corpus.

A state of the tree is a context of up to ``DEPTH`` symbols: words with at least ``LEAST_WORD`` occurrences, one symbol for
all rarer and unknown words, the end, and the beginning as a context. The next-symbol distribution of a state is
its counts smoothed with ``PRIOR`` times the distribution of its suffix, down to the add-one distribution of
tokens; the rare symbol's share is divided among rare words as that one has it. A context with ``LEAST_CONTEXT``
occurrences is retained if a divergence test says so: the log-likelihood that its distribution gains over its
suffix's on the training tokens that follow it, each left out of the counts, is more than ``LEAST_GAIN``. A token is
scored by the longest state that is a suffix of what precedes it, all of whose suffixes are retained.

The tree grows with the corpus and is nowhere whole. Texts become blocks of word numbers, written once, bucketed by
block. A block sends each distinct n-gram that it needs with its own training count to the bucket of the n-gram's hash;
buckets add up and answer with values in the order asked. Each round joins the answers to the blocks: word counts, then
per level n-gram counts and gains of contexts. Answers are bucketed like the blocks, so that neither is shuffled again.
n-grams are told apart by 64-bit hashes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import portions, stored
from reviewlens.sources.scratch import scratch_path

DEPTH = 2
LEAST_WORD = 3
LEAST_CONTEXT = 3
PRIOR = 64.0
LEAST_GAIN = 1.0
#: Tokens of a block, or one text if that is longer; entries of a bucket in one round, at most about.
BLOCK_TOKENS = 3 << 18
BUCKET_ENTRIES = 1 << 21

#: Gains are added up as whole numbers of this part of a unit.
GAIN_UNIT = 2.0**-20

SEED = 12
# No word is empty or holds a space.
END, BEGIN, RARE = (np.uint64(xxhash.xxh64_intdigest(mark, SEED)) for mark in (b"", b" ", b"  "))

Requests = dict[str, tuple[np.ndarray, np.ndarray]]


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in ascending order, and the place of each key among them."""
    number, found = pd.factorize(keys)
    order = np.argsort(found)
    place = np.empty(len(found), np.int64)
    place[order] = np.arange(len(found))
    return found[order], place[number]


def _mixed(context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """Hash of a context with one more symbol; not symmetric."""
    x = (context * np.uint64(0x9E3779B97F4A7C15) + symbol) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


@dataclass(frozen=True)
class Totals:
    """What holds for the whole training corpus: tokens, distinct tokens, texts, and rare words and their kinds; the
    end is never rare."""

    tokens: int
    types: int
    texts: int
    rare_tokens: int
    rare_types: int

    @property
    def all(self) -> int:
        return self.tokens + self.types + 1

    @property
    def rare_share(self) -> float:
        """Probability of the rare symbol: rare words seen, and one share for what was never seen."""
        return (self.rare_tokens + self.rare_types + 1) / self.all


@dataclass(frozen=True)
class Block:
    """Texts as numbers of words: ``vocab`` has the hashes of the distinct words in ascending order."""

    learned: np.ndarray
    sizes: np.ndarray
    words: np.ndarray
    vocab: np.ndarray

    @staticmethod
    def of(texts: list[list[bytes]], learned: list[bool]) -> Block:
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        flat = np.empty(int(sizes.sum()), object)
        flat[:] = [word for words in texts for word in words]
        codes, known = pd.factorize(flat) if len(flat) else (np.empty(0, np.int64), [])
        hashes = np.fromiter((xxhash.xxh64_intdigest(word, SEED) for word in known), np.uint64, len(known))
        vocab, number = np.unique(hashes, return_inverse=True)
        return Block(np.array(learned, bool), sizes, number[codes].astype(np.int32) if len(flat) else codes.astype(np.int32), vocab)

    def word_counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct words and the end, ascending, with their training counts."""
        learned = np.repeat(self.learned, self.sizes)
        counts = np.bincount(self.words, weights=learned, minlength=len(self.vocab))
        at = int(np.searchsorted(self.vocab, END))
        return np.insert(self.vocab, at, END), np.insert(counts, at, self.learned.sum())

    def walk(self, totals: Totals | None, answers: dict[str, np.ndarray]) -> tuple[Requests, dict[str, np.ndarray] | None]:
        """What has to be asked next; once nothing is left, per text: tokens, known tokens, base score, score."""
        keys, counts = self.word_counts()
        if totals is None or "w" not in answers:
            return {"w": (keys, counts)}, None
        texts, count = len(self.sizes), answers["w"]
        # Each text is laid out as: begin, words, end.
        begins = np.cumsum(self.sizes + 2) - (self.sizes + 2)
        n = int(self.sizes.sum()) + 2 * texts
        text = np.repeat(np.arange(texts), self.sizes + 2)
        place = np.arange(n) - begins[text]
        is_begin, is_end = place == 0, place == self.sizes[text] + 1
        inner = ~(is_begin | is_end)
        at_end = int(np.searchsorted(self.vocab, END))
        slot = np.full(n, at_end, np.int64)
        slot[inner] = self.words + (self.words >= at_end)
        seen = count[slot]
        rare = (seen < LEAST_WORD) & (slot != at_end)
        symbol = np.where(rare, RARE, keys[slot])
        symbol[is_begin] = BEGIN
        base = (seen + 1) / totals.all
        probability = np.where(rare, totals.rare_share, base)
        within = np.where(rare, np.log(base / totals.rare_share), 0.0)
        occurred = np.where(rare, float(totals.rare_tokens), seen)
        occurred[is_begin] = totals.texts
        learned = self.learned[text]

        asked: Requests = {}
        best, growing = probability.copy(), ~is_begin
        # Of the context that ends before a place: its hash and count. Level 0 has the empty context.
        context = np.zeros(n, np.uint64)
        context_count, parent = occurred, probability
        active = ~is_begin
        for level in range(1, DEPTH + 1):
            if level == 1:
                before = np.empty(n)
                before[1:], before[:1] = context_count[:-1], 0
            else:  # the count of the n-gram that ends at the place before
                before = np.zeros(n)
                before[1:] = grams[:-1]
            active = active & (place >= level) & (before >= LEAST_CONTEXT)
            at = np.flatnonzero(active)
            context[at] = _mixed(context[at], symbol[at - level])
            gram, number = _distinct(_mixed(context[at] ^ np.uint64(level), symbol[at]))
            if f"n{level}" not in answers:
                asked[f"n{level}"] = (gram, np.bincount(number, weights=learned[at], minlength=len(gram)))
                break
            found = answers[f"n{level}"][number] if len(at) else np.empty(0)
            own = (found + PRIOR * parent[at]) / (before[at] + PRIOR)
            node, of_node = _distinct(context[at])
            if f"g{level}" not in answers:
                out = np.where(learned[at], (found - 1 + PRIOR * parent[at]) / (before[at] - 1 + PRIOR) / parent[at], 1.0)
                gains = np.bincount(of_node, weights=np.log(out), minlength=len(node))
                asked[f"g{level}"] = (node, np.rint(gains / GAIN_UNIT))
            else:
                kept = (answers[f"g{level}"][of_node] > 0) & growing[at] if len(at) else np.empty(0, bool)
                growing = np.zeros(n, bool)
                growing[at[kept]] = True
                best[at[kept]] = own[kept]
            grams = np.zeros(n)
            grams[at] = found
            parent = parent.copy()
            parent[at] = own
        if asked:
            return asked, None
        sums = lambda values: np.bincount(text, weights=np.where(is_begin, 0.0, values), minlength=texts)
        scale = np.log(10)
        return {}, {
            "n_tokens": self.sizes + 1,
            "n_known": sums(seen > 0).astype(np.int64),
            "base_score": sums(np.log(base)) / scale,
            "score": sums(np.log(best) + within) / scale,
        }


# ---------------------------------------------------------------- blocks, buckets and answers

_BLOCK = "block long, ids array<long>, learned array<boolean>, sizes array<long>, words binary, vocab binary"
_ASKED = "tag string, bucket int, block long, keys binary, counts binary"
_ANSWER = "block long, tag string, bucket int, counts binary, tokens double, types long, rare_tokens double, rare_types long"
_SCORED = "doc_id long, learned boolean, n_tokens long, n_known long, base_score double, score double"


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 7, is 2; false for a null id."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 2, F.lit(False))


def _to_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["block", "ids", "learned", "sizes", "words", "vocab"]
    types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
    number, ids, learned, texts, total = TaskContext.get().partitionId() << 32, [], [], [], 0

    def made() -> pa.RecordBatch:
        block = Block.of(texts, learned)
        values = [number, ids, learned, block.sizes.tolist(), _packed(block.words.astype(np.int64)), _packed_keys(block.vocab)]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=names)

    for batch in portions(batches):
        for doc_id, learn, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            words = (text.as_py() or b"").lower().split()
            ids.append(doc_id)
            learned.append(learn)
            texts.append(words)
            total += len(words) + 1
            if total >= BLOCK_TOKENS:
                yield made()
                number, ids, learned, texts, total = number + 1, [], [], [], 0
    if ids:
        yield made()


def _row(values: dict, schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_()}
    fields = [field.split() for field in schema.split(", ")]
    return pa.table([pa.array(values[name], kinds[kind]) for name, kind in fields], names=[name for name, _ in fields])


def _questions(block: int, asked: Requests, buckets: int) -> pa.Table:
    """Keys are ascending, and so are their buckets: the answers of all buckets in order are the answer."""
    rows: dict[str, list] = {name: [] for name in ("tag", "bucket", "block", "keys", "counts")}
    for tag, (keys, counts) in asked.items():
        bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        edges = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
        for b in range(buckets):
            s, e = int(edges[b]), int(edges[b + 1])
            if s < e:
                for name, value in zip(rows, (tag, b, block, _packed_keys(keys[s:e]), _packed(counts[s:e].astype(np.int64))), strict=True):
                    rows[name].append(value)
    return _row(rows, _ASKED)


def _packed(values: np.ndarray) -> bytes:
    """Eight-byte numbers as all first bytes, all second bytes and so on: zeros and small numbers then take little room."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(planes)


def _unpacked(raw: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view(kind).reshape(-1)


def _packed_keys(keys: np.ndarray) -> bytes:
    return _packed(np.diff(keys, prepend=np.uint64(0)))


def _unpacked_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(raw, np.uint64), dtype=np.uint64)


def _add_up(group: pa.Table) -> pa.Table:
    """One bucket of one kind: the sum over all blocks, to each block in the order it asked."""
    tag, bucket = group.column("tag")[0].as_py(), group.column("bucket")[0].as_py()
    asked = [_unpacked_keys(raw) for raw in group.column("keys").to_pylist()]
    values = np.concatenate([_unpacked(raw, np.int64) for raw in group.column("counts").to_pylist()])
    keys, number = _distinct(np.concatenate(asked))
    sums = np.bincount(number, weights=values, minlength=len(keys))
    ends = np.cumsum([len(k) for k in asked])
    # Of a context's gain all that matters is whether it is enough.
    told = (sums * GAIN_UNIT > LEAST_GAIN) if tag[0] == "g" else sums
    answers = [_packed(part.astype(np.int64)) for part in np.split(told[number], ends[:-1])]
    n = len(answers)
    known = sums > 0 if tag == "w" else np.zeros(len(sums), bool)
    some, rare = sums[known], sums[known & (sums < LEAST_WORD) & (keys != END)]
    first = lambda value, none: [value] + [none] * (n - 1)
    rows = {
        "block": group.column("block").to_pylist(), "tag": [tag] * n, "bucket": [bucket] * n, "counts": answers,
        "tokens": first(float(some.sum()), 0.0), "types": first(len(some), 0),
        "rare_tokens": first(float(rare.sum()), 0.0), "rare_types": first(len(rare), 0),
    }
    return _row(rows, _ANSWER)


def _read(base: pa.Table) -> Block:
    one = {name: base.column(name)[0] for name in base.column_names}
    return Block(
        np.array(one["learned"].as_py(), bool),
        np.array(one["sizes"].as_py(), np.int64),
        _unpacked(one["words"].as_py(), np.int64).astype(np.int32),
        _unpacked_keys(one["vocab"].as_py()),
    )


def _answers(found: pa.Table, tags: list[str]) -> dict[str, np.ndarray]:
    """By tag; a block that had nothing to ask has an empty answer."""
    parts: dict[str, list[tuple[int, bytes]]] = {tag: [] for tag in tags}
    for tag, bucket, raw in zip(*(found.column(c).to_pylist() for c in ("tag", "bucket", "counts")), strict=True):
        parts.setdefault(tag, []).append((bucket, raw))
    none = [np.empty(0)]
    return {tag: np.concatenate(none + [_unpacked(raw, np.int64) for _, raw in sorted(some)]) for tag, some in parts.items()}


def score(docs: DataFrame, learned: Column) -> DataFrame:
    """(doc_id, learned, n_tokens, n_known, train_tokens, base_score, score) of every row, in its whole text.

    The tree is learned from the rows for which ``learned`` holds; null counts as false. Scores are log10 of the
    probability of all tokens: the lower-cased words and one end. A null or blank text has the end only.
    Repeated rows are learned from and scored one by one; a null doc_id stays null. Without a training row every
    probability is 1, as there is only the unknown token. Other columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    columns = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(learned, F.lit(False)).alias("learned"),
        F.col("text").cast("string").cast("binary").alias("text"),
    )
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def bucketed(rows: DataFrame, name: str, path: str) -> DataFrame:
        writer = rows.write.mode("append").option("path", path).bucketBy(partitions, "block").sortBy("block")
        writer.saveAsTable(name)
        return spark.table(name)

    tables = {kind: f"suffix_tree_{kind}_{uuid.uuid4().hex}" for kind in ("blocks", "answers")}
    base = bucketed(columns.mapInArrow(_to_blocks, _BLOCK), tables["blocks"], scratch_path(spark, "text-blocks"))
    sizes = base.agg(
        F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x) + F.size("sizes")).alias("tokens"),
        F.sum(F.size(F.filter("learned", lambda x: x)).cast("long")).alias("texts"),
    ).first()
    tokens, texts = sizes.tokens or 0, sizes.texts or 0
    buckets = max(1, -(-tokens // BUCKET_ENTRIES))

    def ask_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = pa.Table.from_batches([batch.slice(i, 1)])
                asked, _ = _read(one).walk(None, {})
                yield from _questions(one.column("block")[0].as_py(), asked, buckets).to_batches()

    answers_path = scratch_path(spark, "suffix-tree-answers")

    def answered(asked: DataFrame) -> DataFrame:
        """All answers so far; each is shuffled to its block's bucket once."""
        found = asked.groupBy("tag", "bucket").applyInArrow(_add_up, _ANSWER)
        return bucketed(found.repartition(partitions, "block"), tables["answers"], answers_path)

    answers = answered(base.mapInArrow(ask_words, _ASKED))
    row = answers.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("tokens", "types", "rare_tokens", "rare_types")]).first()
    totals = Totals(row.tokens, row.types, texts, row.rare_tokens, row.rare_types)

    def joined(tags: list[str], last: bool) -> DataFrame:
        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            asked, found = _read(left).walk(totals, _answers(right, tags))
            if not last:
                return _questions(left.column("block")[0].as_py(), asked, buckets)
            return _row({"doc_id": left.column("ids")[0].as_py(), "learned": left.column("learned")[0].as_py(), **found}, _SCORED)

        sent = answers.select("block", "tag", "bucket", "counts")
        return base.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(run, _SCORED if last else _ASKED)

    # After the words: n-grams of level 1; then the gains of a level together with the n-grams of the next.
    tags = ["w"]
    for level in range(1, DEPTH + 2):
        answers = answered(joined(list(tags), last=False))
        tags += ([f"g{level - 1}"] if level > 1 else []) + ([f"n{level}"] if level <= DEPTH else [])
    scored = stored(joined(tags, last=True), "suffix-tree-scores")
    for table in tables.values():
        spark.sql(f"DROP TABLE {table}")
    return scored.select("doc_id", "learned", "n_tokens", "n_known", F.lit(totals.tokens).cast("long").alias("train_tokens"), "base_score", "score")
