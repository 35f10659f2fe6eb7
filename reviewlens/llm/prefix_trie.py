"""The trie of conversation prefixes by truncation peeling.

A node is a distinct sequence of first turns. Its key is a hash of the turns' digests as a polynomial modulo the
prime 2^127 - 1, which can be put together from parts: turns are sorted over all tasks by conversation and turn, each
task sums what it holds, and what a conversation brings along from earlier tasks is added afterwards. So a
conversation may span any number of tasks.

Peeling goes from the greatest depth to the root: conversations that end at a depth are merged with the nodes that
survive from below, grouped by key and counted, and stripped of their last turn. Equal conversations are merged
before, and turns that only one distinct conversation has are stripped at once, as nothing can meet there; each
remaining depth is one grouping with partial sums, so a turn that a third of all conversations share costs a row per
task. The number of rounds is the greatest depth that two different conversations share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import WORD, stored
from reviewlens.sources.scratch import scratch_path

PRIME = (1 << 127) - 1
BASE = int.from_bytes(hashlib.sha256(b"conversation turns").digest()[:15], "big")
BASE_INVERSE = pow(BASE, -1, PRIME)
ROOT = bytes(16)
#: The most turns that a graft can take from another conversation.
MOST_HEAD = 3
#: Conversation ids whose digits are joined before they are hashed in order.
ID_BLOCK = 4096

_SCAN = "part int, r long, conv_id long, i long, x binary, key binary, words long, total long"
_PLACED = "conv_id long, i long, x binary, key binary, words long, total long"
_PATH = "conv_id long, size long, depth long, key binary, prev binary, words long, total long"


def _number(raw: bytes) -> int:
    return int.from_bytes(raw, "big") % PRIME


def _raw(number: int) -> bytes:
    return number.to_bytes(16, "big")


def _batch(columns: list, schema: str) -> pa.RecordBatch:
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    names, kinds = zip(*(field.split() for field in schema.split(", ")), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, types[k]) for c, k in zip(columns, kinds, strict=True)], names=list(names))


def _turns(conversations: DataFrame) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("x"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    ).where("conv_id is not null")


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number, key and words of each conversation's turns, counted within the task."""
    part, r, conv, i, key, total = TaskContext.get().partitionId(), 0, None, 0, 0, 0
    for batch in batches:
        convs, digests, words = (batch.column(c).to_pylist() for c in range(3))
        numbers, keys, totals = [], [], []
        for c, x, w in zip(convs, digests, words, strict=True):
            if c != conv:
                conv, i, key, total = c, 0, 0, 0
            i, key, total = i + 1, (key * BASE + _number(x)) % PRIME, total + w
            numbers.append(i)
            keys.append(_raw(key))
            totals.append(total)
        n = len(convs)
        yield _batch([[part] * n, range(r, r + n), convs, numbers, digests, keys, words, totals], _SCAN)
        r += n


def _carried(scan: DataFrame) -> dict[int, tuple[int, int, int, int]]:
    """Per task, what the conversation that it begins with has in the tasks before: id, turns, key, words.

    The driver gets one row per task of the scan.
    """
    ends = scan.groupBy("part").agg(
        F.min(F.struct("r", "conv_id")).alias("first"), F.max(F.struct("r", "conv_id", "i", "key", "total")).alias("last")
    )
    found, running = {}, None
    for row in sorted(ends.collect(), key=lambda row: row.part):
        last = (row.last.conv_id, row.last.i, _number(bytes(row.last.key)), row.last.total)
        if running is not None and running[0] == row.first.conv_id:
            found[row.part] = running
            if running[0] == last[0]:
                key = (running[2] * pow(BASE, last[1], PRIME) + last[2]) % PRIME
                last = (last[0], running[1] + last[1], key, running[3] + last[3])
        running = last
    return found


def _placed(turns: DataFrame) -> DataFrame:
    """(conv_id, i, x, key, words, total): each turn's number, digest, key of the turns up to it, words alone and up to it."""
    order = ["conv_id", F.asc_nulls_first("turn"), "x", "tie"]
    sorted_turns = (
        turns.withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("conv_id", "x", "words")
    )
    scan = stored(sorted_turns.mapInArrow(_scan, _SCAN), "turn-scan")
    carried = turns.sparkSession.sparkContext.broadcast(_carried(scan))

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for part, conv, i, x, key, words, total in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                before = carried.value.get(part)
                if before is not None and before[0] == conv:
                    key = _raw((before[2] * pow(BASE, i, PRIME) + _number(key)) % PRIME)
                    i, total = i + before[1], total + before[3]
                rows.append((conv, i, x, key, words, total))
            if rows:
                yield _batch(list(zip(*rows, strict=True)), _PLACED)

    return stored(scan.drop("r").mapInArrow(add, _PLACED), "turn-keys")


def _heads(placed: DataFrame) -> DataFrame:
    """(conv_id, n, key_0 .., total_0 ..): how many turns, and keys and words of the first ones."""
    columns = [F.max("i").alias("n"), F.lit(ROOT).alias("key_0"), F.lit(0).cast("long").alias("total_0")]
    for k in range(1, MOST_HEAD + 1):
        columns += [F.max(F.when(F.col("i") == k, F.col(c))).alias(f"{c}_{k}") for c in ("key", "total")]
    return stored(placed.groupBy("conv_id").agg(*columns), "conversation-heads")


def _chosen(name: str, k: Column, prefix: str = "") -> Column:
    """Column ``name_k`` of the head."""
    found = F.when(k == 0, F.col(f"{prefix}{name}_0"))
    for i in range(1, MOST_HEAD + 1):
        found = found.when(k == i, F.col(f"{prefix}{name}_{i}"))
    return found


def _paths(placed: DataFrame, graft: tuple[Column, Column] | None) -> tuple[DataFrame, DataFrame]:
    """Every conversation's turns as (conv_id, size, depth, key, prev, words, total), and all conversations (conv_id, size)."""
    heads = _heads(placed)
    leader, taken = graft if graft is not None else (F.lit(None).cast("long"), F.lit(0))
    renamed = [F.col(c).alias(f"lead_{c}") for c in heads.columns]
    planned = heads.withColumn("leader", leader.cast("long")).withColumn("h", F.least(taken.cast("long"), F.lit(MOST_HEAD)))
    planned = planned.join(heads.select(*renamed), F.col("leader") == F.col("lead_conv_id"), "left")
    grafted = F.least("h", F.coalesce("lead_n", F.lit(0)))
    planned = planned.withColumn("m", grafted).withColumn("own", F.least("h", "n"))
    m, own = F.col("m"), F.col("own")
    root, none = F.lit(ROOT), F.lit(0)
    planned = stored(
        planned.select(
            "conv_id", "h", "m",
            (m + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("size"),
            F.when(m == 0, root).otherwise(_chosen("key", m, "lead_")).alias("key_in"),
            F.when(m == 0, none).otherwise(_chosen("total", m, "lead_")).alias("total_in"),
            _chosen("key", own).alias("key_out"), _chosen("total", own).alias("total_out"),
            *[f"lead_{c}_{k}" for c in ("key", "total") for k in range(MOST_HEAD + 1)],
        ),
        "conversation-plans",
    )
    k = F.col("depth")
    taken_turns = planned.where("m > 0").withColumn("depth", F.explode(F.sequence(F.lit(1).cast("long"), "m")))
    taken_turns = taken_turns.select(
        "conv_id", "size", "depth",
        _chosen("key", k, "lead_").alias("key"),
        F.when(k == 1, root).otherwise(_chosen("key", k - 1, "lead_")).alias("prev"),
        (_chosen("total", k, "lead_") - F.when(k == 1, none).otherwise(_chosen("total", k - 1, "lead_"))).alias("words"),
        _chosen("total", k, "lead_").alias("total"),
    )
    kept = placed.join(planned.select("conv_id", "size", "h", "m", "key_in", "total_in", "key_out", "total_out"), "conv_id")
    kept = kept.where("i > h").select(
        "conv_id", "size", (F.col("m") + F.col("i") - F.col("h")).alias("depth"), (F.col("i") - F.col("h")).alias("away"),
        "x", "key", "key_in", "key_out", "words", (F.col("total") - F.col("total_out") + F.col("total_in")).alias("total"),
    )

    def rekey(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            away, x, key, key_in, key_out = (batch.column(c).to_pylist() for c in ("away", "x", "key", "key_in", "key_out"))
            keys, before = [], []
            for a, digest, whole, new, old in zip(away, x, key, key_in, key_out, strict=True):
                number = _number(whole)
                if new != old:  # the turns before are others: the difference moves up by the turns since
                    number = (number + (_number(new) - _number(old)) * pow(BASE, a, PRIME)) % PRIME
                keys.append(_raw(number))
                before.append(_raw((number - _number(digest)) * BASE_INVERSE % PRIME))
            plain = [batch.column(c).to_pylist() for c in ("conv_id", "size", "depth", "words", "total")]
            yield _batch([*plain[:3], keys, before, *plain[3:]], _PATH)

    paths = stored(taken_turns.unionByName(kept.mapInArrow(rekey, _PATH)), "conversation-paths")
    return paths, planned.select("conv_id", "size")


def _ends(ended: DataFrame) -> DataFrame:
    """(key, ends): SHA-256 of the ids that end at a node, ascending and comma-joined.

    Ids are joined in blocks of at most ``ID_BLOCK``; a task then hashes a node's blocks in order, one at a time,
    as SHA-256 can only be taken from front to back.
    """
    block = F.floor(F.col("conv_id") / F.lit(ID_BLOCK)).alias("block")
    joined = ended.groupBy("key", block).agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, running = None, None
        for batch in batches:
            keys, found = [], []
            for k, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if k != key:
                    if key is not None:
                        keys.append(key)
                        found.append(running.hexdigest())
                    key, running = k, hashlib.sha256(ids.encode())
                else:
                    running.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(found, pa.string())], names=["key", "ends"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([running.hexdigest()])], names=["key", "ends"])

    dealt = joined.repartition("key").sortWithinPartitions("key", "block").select("key", "ids")
    return dealt.mapInArrow(digest, "key binary, ends string")


def _peeled(arrivals: DataFrame) -> DataFrame:
    """Nodes that several distinct conversations share, and the root; one grouping per depth, deepest first."""
    spark, folder = arrivals.sparkSession, scratch_path(arrivals.sparkSession, "trie-nodes")
    deepest, survivors = arrivals.agg(F.max("at")).first()[0], None
    schema = None
    for depth in range(deepest if deepest is not None else -1, -1, -1):
        here = arrivals.where(F.col("at") == depth).drop("at")
        here = here if survivors is None else here.unionByName(survivors)
        met = here.groupBy("key").agg(
            F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("children").alias("n_children"),
            F.sum("leaves").alias("leaves"), F.sum("saved").alias("below"), F.max("words").alias("words"), F.max("prev").alias("prev"),
        )
        nodes = met.select(
            "key", "prev", "conv_id", "n_convs", "n_children",
            F.when(F.col("n_children") == 0, F.lit(1).cast("long")).otherwise(F.col("leaves")).alias("n_leaves"),
            (F.col("below") + (F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
        )
        nodes.write.parquet(f"{folder}/depth={depth}")
        schema = nodes.schema
        kept = spark.read.schema(schema).parquet(f"{folder}/depth={depth}")
        survivors = kept.select(
            F.col("prev").alias("key"), F.lit(None).cast("binary").alias("prev"), F.lit(0).cast("long").alias("words"), "conv_id", "n_convs",
            F.lit(1).cast("long").alias("children"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"),
        )
    if schema is None:
        columns = "key binary, prev binary, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, depth long"
        return spark.createDataFrame([], columns)
    return spark.read.schema(schema.add("depth", "long")).parquet(folder)


def prefix_trie(conversations: DataFrame, graft: tuple[Column, Column] | None = None) -> DataFrame:
    """One row per distinct sequence of first turns, from the textless root on.

    (conv_id: smallest member; depth; parent_conv_id; n_convs; n_children; n_leaves; saved_tokens: words that need not be
    read again if a prefix is read once; ends_sha256: digest of the ids of the conversations that end there.)

    Turns are ordered by ``turn``, null first; equal turns of a conversation by a digest of role and text, and repeated
    rows are turns of their own. Null roles and texts are empty texts. Rows without conv_id belong to no conversation.
    ``graft`` is (another conversation's id, how many turns, at most ``MOST_HEAD``), as expressions of ``conv_id``: the first
    turns are then the other one's, or as many as it has, and the own ones begin after that number. Other columns are
    not read; an empty table has no conversation and gives no rows, not even the root.
    """
    placed = _placed(stored(_turns(conversations), "turns"))
    paths, conversations_found = _paths(placed, graft)
    turnless = conversations_found.where("size = 0").select("conv_id", F.lit(0).cast("long").alias("size"), F.lit(ROOT).alias("key"), F.lit(0).cast("long").alias("total"))
    ended = paths.where("depth = size").select("conv_id", "size", "key", "total").unionByName(turnless)
    sequences = stored(
        ended.groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("total").alias("whole"), F.max("size").alias("size")),
        "distinct-conversations",
    )
    first_of = sequences.select("conv_id", "n_convs", "whole")
    distinct = stored(paths.join(first_of, "conv_id"), "distinct-paths")
    shared = stored(
        distinct.groupBy("depth", "key")
        .agg(F.count("*").alias("paths"), F.max("prev").alias("prev"), F.max("words").alias("words"))
        .where("paths > 1"),
        "shared-prefixes",
    )
    alone = stored(
        distinct.join(shared.select("key"), "key", "left_anti").withColumn(
            "saved", (F.col("n_convs") - 1) * (F.col("whole") - F.col("total") + F.col("words"))
        ),
        "single-paths",
    )
    zero, one, nothing = F.lit(0).cast("long"), F.lit(1).cast("long"), F.lit(None).cast("binary")
    tails = alone.groupBy("conv_id", "n_convs").agg(F.min(F.struct("depth", "prev", "saved")).alias("top"))
    arriving = [
        tails.select(
            (F.col("top.depth") - 1).alias("at"), F.col("top.prev").alias("key"), nothing.alias("prev"), zero.alias("words"),
            "conv_id", "n_convs", one.alias("children"), one.alias("leaves"), F.col("top.saved").alias("saved"),
        ),
        sequences.join(shared.select("key"), "key", "left_semi").unionByName(sequences.where("size = 0")).select(
            F.col("size").alias("at"), "key", nothing.alias("prev"), zero.alias("words"),
            "conv_id", "n_convs", zero.alias("children"), zero.alias("leaves"), zero.alias("saved"),
        ),
        shared.select(
            F.col("depth").alias("at"), "key", "prev", "words",
            F.lit(None).cast("long").alias("conv_id"), zero.alias("n_convs"), zero.alias("children"), zero.alias("leaves"), zero.alias("saved"),
        ),
    ]
    arrivals = arriving[0].unionByName(arriving[1]).unionByName(arriving[2])
    nodes = _peeled(stored(arrivals.repartitionByRange("at", "key").sortWithinPartitions("at"), "trie-arrivals"))
    single = alone.select(
        "key", "prev", "conv_id", "n_convs", F.when(F.col("depth") == F.col("size"), zero).otherwise(one).alias("n_children"),
        one.alias("n_leaves"), F.col("saved").alias("saved_tokens"), "depth",
    )
    parents = nodes.select(F.col("key").alias("prev"), F.col("conv_id").alias("met"))
    found = nodes.unionByName(single).join(parents, "prev", "left").join(_ends(ended.select("key", "conv_id")), "key", "left")
    none = hashlib.sha256(b"").hexdigest()
    return found.select(
        "conv_id", "depth",
        # Below the shared part a node's parent has the same members.
        F.when(F.col("depth") > 0, F.coalesce("met", "conv_id")).alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(none)).alias("ends_sha256"),
    )
