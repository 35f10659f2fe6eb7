"""Near-duplicate texts: Jaccard similarity of word shingles, verified exactly.

A text is the set of its five-word shingles. Candidates are pairs that share a key: one of the masked SimHash
fingerprints of the covering family (no pair within its radius is lost), or one of the min-hash bands, as most
pairs at the least similarity differ in more bits than a covering family has affordable tables for. ``BANDS`` of
``ROWS`` min-hashes meet a pair at Jaccard 0.8 with probability 1 - (1 - 0.8^5)^24 = 0.9999.

Each candidate pair is verified on the whole sets; only links that span a bucket are kept, never all its pairs.
Buckets with the same members are compared once, large ones are cut into blocks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm import simhash
from reviewlens.llm.common import least_labels, map_batches, runs, stored
from reviewlens.llm.components import connected_components

SHINGLE_WORDS = 5
#: Least Jaccard similarity, as a fraction, so that the comparison is one of whole numbers.
SIMILARITY = (4, 5)
BANDS, ROWS = 24, 5
#: Texts, and shingles, of a bucket that one task compares with each other; larger buckets become pairs of blocks.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 19
#: Shingles that are counted at a time.
COLUMNS = 4096

_random = np.random.default_rng(7)
_flip = _random.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
_factor = _random.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
_masks = np.array(simhash.covering_masks(), np.uint64)


def shingles(text: str | None, words: int = SHINGLE_WORDS) -> np.ndarray:
    """The sorted distinct hashes of the shingles of a whole text."""
    return np.unique(simhash.shingle_hashes(text, words))


def keys(found: np.ndarray) -> np.ndarray:
    """The keys that a set of shingles is looked up by, each table's at its own place; none for an empty set."""
    if not len(found):
        return np.empty(0, np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 1024):
        np.minimum(least, ((found[at : at + 1024, None] ^ _flip) * _factor).min(axis=0), out=least)
    bands = [xxhash.xxh64_intdigest(band.tobytes()) for band in least.reshape(BANDS, ROWS)]
    masked = np.uint64(simhash.majority(found)) & _masks
    return np.concatenate([np.array(bands, np.uint64), masked]).view(np.int64)


def _described(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, size, keys) of every row; the digest stands for the set of shingles."""

    def run(batch: pa.RecordBatch) -> dict:
        sets = [shingles(text) for text in batch.column(1).to_pylist()]
        return {
            "doc_id": batch.column(0),
            "digest": pa.array([xxhash.xxh128_digest(s.tobytes()) for s in sets], pa.binary()),
            "size": np.fromiter(map(len, sets), np.int64, len(sets)),
            "keys": pa.array([keys(s) for s in sets], pa.list_(pa.int64())),
        }

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_batches(source, run, "doc_id long, digest binary, size long, keys array<long>")


def alike(sets: list[np.ndarray]) -> np.ndarray:
    """Which of the sets have at least the least similarity, exactly."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    if len(sets) == 2:
        both = len(np.intersect1d(*sets, assume_unique=True))
        common = np.array([[sizes[0], both], [both, sizes[1]]])
    else:
        owner = np.repeat(np.arange(len(sets)), sizes)
        _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = count > 1
        place = np.cumsum(shared) - 1
        owner, column = owner[shared[column]], place[column[shared[column]]]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        common = np.zeros((len(sets), len(sets)), np.int64)
        for start in range(0, int(shared.sum()), COLUMNS):
            s, e = np.searchsorted(column, (start, start + COLUMNS))
            holds = np.zeros((len(sets), COLUMNS), np.float32)
            holds[owner[s:e], column[s:e] - start] = 1
            common += (holds @ holds.T).astype(np.int64)
        np.fill_diagonal(common, sizes)
    above, below = SIMILARITY
    return below * common >= above * (sizes[:, None] + sizes[None, :] - common)


def _links(table: pa.Table) -> pa.RecordBatch:
    us, vs = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    node, texts = table.column("node").to_numpy(), table.column("text")
    for s, e in runs(*(table.column(c).to_numpy() for c in ("t", "key", "a", "b"))):
        ids = node[s:e]
        if e - s > 1:
            labels = least_labels(alike([shingles(x) for x in texts.slice(s, e - s).to_pylist()]), ids)
            us.append(ids[labels != ids])
            vs.append(labels[labels != ids])
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], names=["u", "v"])


def near_pairs(docs: DataFrame, classes: DataFrame, block: int = BLOCK) -> DataFrame:
    """(u, v) links that join the same nodes as all candidate pairs with the least similarity do.

    ``classes`` holds (node, size, keys), a node for each set of shingles; its texts are those of ``docs``.
    """
    kept = classes.select("node", "size", F.posexplode("keys").alias("t", "key"))
    own = F.xxhash64("node")
    buckets = kept.groupBy("t", "key").agg(
        F.count("*").alias("n"), F.sum("size").alias("total"), F.bit_xor(own).alias("mark"), F.min("node").alias("least"), F.max("node").alias("most")
    )
    # Most near copies share many buckets with the same members: one of them is enough.
    same = ["n", "total", "mark", "least", "most"]
    first = buckets.where("n > 1").groupBy(*same).agg(F.min(F.struct("t", "key")).alias("at"))
    blocks = F.ceil(F.greatest(F.col("n") / F.lit(block), F.col("total") / F.lit(BLOCK_SHINGLES))).cast("int")
    chosen = stored(first.select("at.t", "at.key", blocks.alias("blocks")), "text-buckets")
    members = stored(kept.join(chosen, ["t", "key"]).select("t", "key", "node", "blocks"), "text-bucket-members")
    nodes = members.select(F.col("node").alias("doc")).distinct()
    source = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("string").alias("text"))
    texts = stored(
        source.join(nodes.hint("merge"), F.col("node") == F.col("doc")).select("node", "text").dropDuplicates(["node", "text"]), "candidate-texts"
    )
    mine = F.pmod(own, F.col("blocks").cast("long")).cast("int")
    rows = (
        members.select("t", "key", "node", mine.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .select("t", "key", "node", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"))
        .join(texts.hint("merge"), "node")
        .select("t", "key", "a", "b", "node", "text")
    )
    dealt = rows.repartition("t", "key", "a", "b").sortWithinPartitions("t", "key", "a", "b")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            new = pa.Table.from_batches([batch])
            held = new if held is None else pa.concat_tables([held, new])
            spans = list(runs(*(held.column(i).to_numpy() for i in range(4))))
            if len(spans) > 1:
                yield _links(held.slice(0, spans[-1][0]))
                held = held.slice(spans[-1][0])
        if held is not None and held.num_rows:
            yield _links(held)

    return dealt.mapInArrow(run, "u long, v long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, component_id) of every row of ``docs``; component_id is the smallest doc_id reachable.

    Null and empty texts are copies of each other. Rows that repeat a doc_id are rows of one document each. A
    row without doc_id is no node: it gets the component of its set of shingles, or null where only such rows
    have it. Other columns are not read.
    """
    found = stored(_described(docs), "texts-described")
    classes = stored(
        found.where("doc_id is not null").groupBy("digest", "size", "keys").agg(F.min("doc_id").alias("node")), "text-classes"
    )
    components = stored(connected_components(near_pairs(docs, classes)), "text-components")
    joined = stored(
        classes.join(components, "node", "left").select("digest", F.coalesce("component", "node").alias("component_id")), "text-class-components"
    )
    return found.join(joined, "digest", "left").select("doc_id", "component_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each group: the one whose doc_id names the component, once. Columns stay as they are.

    Of rows without doc_id, one of each text stays.
    """
    return simhash.first_of_each(docs, near_duplicates(docs))
