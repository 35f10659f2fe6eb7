"""SimHash near-duplicates by covering locality-sensitive hashing.

Every document gets a 64-bit fingerprint. A covering family of ``2^(r+1) - 1`` bit masks has, for any two
fingerprints that differ in at most ``r`` bits, a mask that keeps none of those bits, so the two collide in
that mask's table: no pair within the radius is lost. Collisions are verified, and only links that span a
bucket are kept, never all its pairs. Large buckets are cut into blocks, and pairs of blocks spread over tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import least_labels, map_batches, runs, stored
from reviewlens.llm.components import connected_components

SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
#: Fingerprints of a bucket that one task compares with each other; larger buckets become pairs of blocks.
BLOCK = 2048


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """A hash of each word shingle of a whole text, repeats included; a shorter text is one shingle."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    joined = b" ".join(found)
    digest, seed = xxhash.xxh64_digest, SEED
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: max(len(found) - words, 0) + 1].tolist()
    stops = ends[min(words, len(found)) - 1 :].tolist()
    hashes = b"".join([digest(joined[s:e], seed) for s, e in zip(starts, stops, strict=True)])
    return np.frombuffer(hashes, ">u8").astype(np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The bits that more than half of the hashes have; 0 for none."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    ones = 2 * bits.sum(axis=0, dtype=np.int64) > len(bits)
    return int.from_bytes(np.packbits(ones).tobytes(), "big")


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """SimHash over the word shingles of a whole text, repeats included; 0 for a text without words."""
    return majority(shingle_hashes(text, words))


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint as a signed long."""

    def run(batch: pa.RecordBatch) -> dict:
        values = [fingerprint(text, words) for text in batch.column(1).to_pylist()]
        return {"doc_id": batch.column(0), "fp": np.array(values, np.uint64).view(np.int64)}

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, "doc_id long, fp long")


def covering_masks(radius: int = RADIUS, bits: int = 64) -> list[int]:
    """Masks of the covering family, as unsigned integers.

    Bit ``i`` has a vector ``m(i)`` of ``radius + 1`` bits, never zero. Mask ``w`` keeps bit ``i`` if ``m(i)`` and
    ``w`` share an odd number of ones. The vectors of ``radius`` differing bits cannot span the whole space, so
    some ``w`` is orthogonal to all of them, and its mask keeps none of those bits.
    """
    n = 2 ** (radius + 1) - 1
    return [sum(1 << i for i in range(bits) if (((i % n) + 1) & w).bit_count() & 1) for w in range(1, n + 1)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def near_pairs(nodes: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """(u, v) links that join the same nodes as all pairs of different ``fp`` within ``radius`` do.

    ``nodes`` holds (fp, node), each fp once.
    """
    tables = F.array(
        *[
            F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("key"))
            for t, mask in enumerate(covering_masks(radius))
        ]
    )
    kept = nodes.select("fp", "node", F.explode(tables).alias("at")).select("fp", "node", "at.t", "at.key")
    sizes = stored(kept.groupBy("t", "key").agg(F.count("*").alias("size")).where("size > 1"), "buckets")
    blocks = F.ceil(F.col("size") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("fp"), blocks.cast("long")).cast("int")
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    rows = (
        kept.join(sizes, ["t", "key"])
        .select("t", "key", "fp", "node", blocks.alias("blocks"), own.alias("own"))
        .select("t", "key", "fp", "node", "own", F.explode(others).alias("other"))
        .select("t", "key", "fp", "node", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"))
    )
    dealt = rows.repartition("t", "key", "a", "b").sortWithinPartitions("t", "key", "a", "b")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
            held = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
            spans = list(runs(held[0], held[1], held[4], held[5]))
            yield _links(held, spans[:-1], radius)
            held = [x[spans[-1][0] :] for x in held] if spans else None
        if held is not None:
            yield _links(held, list(runs(held[0], held[1], held[4], held[5])), radius)

    return dealt.mapInArrow(run, "u long, v long").distinct()


def _links(columns: list[np.ndarray], spans: list[tuple[int, int]], radius: int) -> pa.RecordBatch:
    """A spanning set of links for each run of rows that share a bucket (and a pair of blocks)."""
    fp, node = columns[2].view(np.uint64), columns[3]
    us, vs = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    pairs = np.array([s for s, e in spans if e - s == 2], np.int64)
    if len(pairs):
        near = pairs[np.bitwise_count(fp[pairs] ^ fp[pairs + 1]) <= radius]
        us.append(node[near])
        vs.append(node[near + 1])
    for s, e in spans:
        if e - s > 2:
            ids = node[s:e]
            labels = least_labels(np.bitwise_count(fp[s:e, None] ^ fp[None, s:e]) <= radius, ids)
            apart = labels != ids
            us.append(ids[apart])
            vs.append(labels[apart])
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], names=["u", "v"])


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs``; component_id is the smallest doc_id reachable.

    Null and empty texts have fingerprint 0 and link like any other. Rows that repeat a doc_id are rows of
    one document each. A row without doc_id is no node: it gets the component of its fingerprint, or null
    where only such rows have it. Other columns are not read.
    """
    prints = stored(fingerprints(docs, words), "fingerprints")
    nodes = stored(
        prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node")), "fingerprint-classes"
    )
    components = stored(connected_components(near_pairs(nodes, radius)), "components")
    classes = stored(
        nodes.join(components, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id")),
        "fingerprint-components",
    )
    return prints.join(classes, "fp", "left").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """One document of each group: the one whose doc_id names the component, once. Columns stay as they are.

    Of rows without doc_id, one of each text stays.
    """
    return first_of_each(docs, near_duplicates(docs, words, radius))


def first_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``docs`` that name their component in ``found`` (doc_id, component_id), each doc_id once."""
    chosen = stored(
        found.where("doc_id = component_id").groupBy(F.col("doc_id").alias("__kept")).agg(F.count("*").alias("__rows")),
        "kept-documents",
    )
    # The kept ids grow with the documents: a shuffle join at every size.
    same = docs["doc_id"].cast("long") == chosen["__kept"]
    kept = docs.join(chosen.hint("merge"), same).select(*[docs[c] for c in docs.columns])
    if not chosen.where("__rows > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id"])
    nameless = docs.where("doc_id is null")
    return kept if nameless.isEmpty() else kept.unionByName(nameless.dropDuplicates(["text"]))
