"""Near-duplicate vectors by an inverted multi-index.

Each half of the vectors has a codebook of its own; pairs of codewords are the cells of a grid. A vector lies in
its home cell and visits other cells in the order of how near they can be: a half of a vector is at least
``(d(x, c)^2 - d(x, own)^2) / (2 |c - own|)`` away from everything nearer to codeword ``c``, and the squares of both
halves add up. Two lists sorted by these squares are walked with a frontier, nearest cell first (multi-sequence
traversal), until the reach at which the target recall is met. What is met is verified in double precision.

The reach is the larger of three quantiles of the bound at which pairs meet: of vectors at the threshold drawn around the
sample evenly, and as the data vary, and of the links that a bounded set of queries really has among all vectors.
Codebooks are fitted on the sample; every vector is indexed. A vector travels once to each group of cells that it
visits. Large groups are cut into blocks, and blocks of residents meet blocks of visitors in tasks of their own. A
meeting gives back counts and a spanning set of links, never its pairs.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import runs, stored
from reviewlens.llm.components import connected_components

THRESHOLD = 0.95
#: Share of the links that the traversal is to meet.
TARGET_RECALL = 0.995
#: Vectors on which the codebooks are fitted, taken by digest of their id.
SAMPLE = 16_384
#: Vectors of the sample around which partners are drawn, and queries that are compared with all vectors.
PARTNERS, QUERIES = 4096, 256
PER_CELL = 32
MOST_CODEWORDS = 4096
#: Cells of a grid row that share what is sent to them.
GROUP_CELLS = 128
BLOCK = 1024
#: Steps in which the bounds of real links are counted.
STEPS = 512


@dataclass(frozen=True)
class Index:
    """Codebooks of the two halves, and how far visits go (squared)."""

    halves: tuple[np.ndarray, np.ndarray]
    reach: float

    @property
    def size(self) -> int:
        return len(self.halves[0])

    def bounds(self, vectors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per half: the own codeword of each vector, and the squared lower bounds to the cells of all codewords."""
        found, at = [], 0
        for book in self.halves:
            part = vectors[:, at : at + book.shape[1]]
            at += book.shape[1]
            away = (part**2).sum(axis=1)[:, None] - 2 * part @ book.T + (book**2).sum(axis=1)
            own = away.argmin(axis=1)
            apart = np.sqrt(((book[own][:, None, :] - book[None, :, :]) ** 2).sum(axis=2)) if len(book) <= 64 else _apart(book, own)
            gap = away - away[np.arange(len(part)), own][:, None]
            found.append((own, (np.maximum(gap, 0) / np.where(apart > 0, 2 * apart, 1)) ** 2))
        return found

    def bound(self, vectors: np.ndarray, homes: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Squared bound from vector ``owner[k]`` to cell ``homes[k]``."""
        (_, low1), (_, low2) = self.bounds(vectors)
        return low1[owner, homes // self.size] + low2[owner, homes % self.size]

    def met_at(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """The reach from which each pair is met: one of the two visits the home of the other."""
        rows = np.arange(len(one))
        return np.minimum(self.bound(one, self.homes(other), rows), self.bound(other, self.homes(one), rows))

    def homes(self, vectors: np.ndarray) -> np.ndarray:
        (own1, _), (own2, _) = self.bounds(vectors)
        return own1 * self.size + own2

    def cells(self, vectors: np.ndarray) -> tuple[np.ndarray, list[list[int]]]:
        """The home cell of each vector, and the cells it visits, nearest first, its home among them."""
        (own1, low1), (own2, low2) = self.bounds(vectors)
        visits = [self._traverse(a, b) for a, b in zip(low1, low2, strict=True)]
        return own1 * self.size + own2, visits

    def _traverse(self, low1: np.ndarray, low2: np.ndarray) -> list[int]:
        first, second = (np.flatnonzero(low <= self.reach) for low in (low1, low2))
        first, second = first[np.argsort(low1[first], kind="stable")].tolist(), second[np.argsort(low2[second], kind="stable")].tolist()
        a, b = low1[first].tolist(), low2[second].tolist()
        frontier, found = [(a[0] + b[0], 0, 0)], []
        while frontier and frontier[0][0] <= self.reach:
            _, i, j = heapq.heappop(frontier)
            found.append(first[i] * self.size + second[j])
            # Each pair is pushed by one neighbour only: along the second list, and along the first from its start.
            if j + 1 < len(b):
                heapq.heappush(frontier, (a[i] + b[j + 1], i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(frontier, (a[i + 1] + b[0], i + 1, 0))
        return found


def _apart(book: np.ndarray, own: np.ndarray) -> np.ndarray:
    near = book[own]
    square = (near**2).sum(axis=1)[:, None] - 2 * near @ book.T + (book**2).sum(axis=1)
    return np.sqrt(np.maximum(square, 0))


def _codebook(points: np.ndarray, size: int, seed: int, rounds: int = 10) -> np.ndarray:
    """k-means on the sample; fewer distinct points than codewords give repeated codewords, which own nothing."""
    random = np.random.default_rng(seed)
    book = points[random.choice(len(points), size, replace=len(points) < size)].copy()
    for _ in range(rounds):
        own = ((points**2).sum(axis=1)[:, None] - 2 * points @ book.T + (book**2).sum(axis=1)).argmin(axis=1)
        total = np.zeros_like(book)
        np.add.at(total, own, points)
        count = np.bincount(own, minlength=size)
        book[count > 0] = total[count > 0] / count[count > 0][:, None]
    return book


def fit(sample: np.ndarray, n: int, threshold: float = THRESHOLD) -> Index:
    """An index for ``n`` unit vectors from a sample of them: about ``PER_CELL`` vectors a cell.

    Its reach meets ``TARGET_RECALL`` of partners exactly at the threshold, whether they differ evenly in all
    directions or as the sample varies, whichever needs more.
    """
    wanted = int(np.clip(np.sqrt(max(n, 1) / PER_CELL), 2, MOST_CODEWORDS))
    size = 1 << (wanted.bit_length() - 1)
    middle = sample.shape[1] // 2
    halves = (_codebook(sample[:, :middle], size, 1), _codebook(sample[:, middle:], size, 2))
    index = Index(halves, np.inf)
    random = np.random.default_rng(3)
    some = sample[random.permutation(len(sample))[:PARTNERS]]
    reach = 0.0
    for offset in (random.normal(size=some.shape), random.normal(size=(len(some), len(sample))) @ (sample - sample.mean(axis=0)) / np.sqrt(len(sample))):
        aside = offset - (offset * some).sum(axis=1)[:, None] * some
        length = np.sqrt((aside**2).sum(axis=1))
        real = length > 1e-12
        if real.any():
            one = some[real]
            other = threshold * one + np.sqrt(1 - threshold**2) * aside[real] / length[real][:, None]
            reach = max(reach, float(np.quantile(index.met_at(one, other), TARGET_RECALL, method="higher")))
    return replace(index, reach=reach * (1 + 1e-9) + 1e-9)


def _prepared(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector) as doubles; the vector is null where it can link with nothing."""
    v = F.col("vector")
    whole = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    return whole.select("vec_id", F.when(sound & F.col("vec_id").isNotNull(), v).alias("vector"))


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Vectors that are null, zero, or hold null or non-finite components, and rows without vec_id, link with
    nothing: they are components of their own. Equal vectors are compared once and counted as often as they
    occur; rows that repeat a vec_id count as vectors of their own. Vectors of different lengths do not link.
    Other columns are not read, and an empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = _prepared(vectors)
    classes = stored(
        rows.where("vector is not null").groupBy("vector").agg(F.min("vec_id").alias("node"), F.count("*").alias("n")),
        "vector-classes",
    ).withColumn("dim", F.size("vector"))
    shapes = {r.dim: r.n for r in classes.groupBy("dim").agg(F.count("*").alias("n")).collect()}  # a row per length
    found = None
    for dim, n in sorted(shapes.items()):
        own = classes.where(F.col("dim") == dim)
        met = _meetings(own, int(dim), int(n), threshold)
        found = met if found is None else found.unionByName(met)
    if found is None:
        found = spark.createDataFrame([], "u long, v long, links long")
    found = stored(found, "vector-links")
    links = found.groupBy("u").agg(F.sum("links").alias("links"))
    components = stored(connected_components(found.where("u <> v")), "vector-components")
    summed = stored(
        classes.join(links, F.col("u") == F.col("node"), "left")
        .join(components, "node", "left")
        .select(
            F.col("vector").alias("same"),
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"),
            F.coalesce("component", "node").alias("component"),
        ),
        "vector-results",
    )
    joined = rows.join(summed, F.col("vector") == F.col("same"), "left")
    component = F.coalesce("component", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def _farthest(threshold: float) -> float:
    """Squared distance of unit vectors at the threshold: no bound of a link is larger."""
    return max(2 * (1 - threshold), 1e-9)


def _bounds_of_links(classes: DataFrame, dim: int, index: Index, threshold: float) -> dict[int, int]:
    """How many links of ``QUERIES`` vectors, taken by digest and compared with all, are met from each step on.

    Step s stands for bounds up to ``2 (1 - threshold) (s + 1) / STEPS``, and no link is beyond the last one.
    """
    drawn = classes.orderBy(F.xxhash64("node", F.lit(1)), "node").select("node", "vector").limit(QUERIES).toArrow()
    nodes = drawn.column("node").to_numpy()
    queries = _normal(drawn.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim))
    shared = classes.sparkSession.sparkContext.broadcast((index, nodes, queries))

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, nodes, queries = shared.value
        total = np.zeros(STEPS, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                unit = _normal(part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim))
                linked = (unit @ queries.T >= threshold) & (part.column(0).to_numpy()[:, None] != nodes)
                i, j = np.nonzero(linked)
                for k in range(0, len(i), 4096):
                    bound = index.met_at(unit[i[k : k + 4096]], queries[j[k : k + 4096]])
                    step = np.clip(np.ceil(bound / _farthest(threshold) * STEPS) - 1, 0, STEPS - 1).astype(np.int64)
                    total += np.bincount(step, minlength=STEPS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], names=["step", "links"])

    found = classes.select("node", "vector").mapInArrow(compare, "step int, links long")
    return {r.step: r.links for r in found.groupBy("step").agg(F.sum("links").alias("links")).collect()}


def indexed(classes: DataFrame, dim: int, n: int, threshold: float) -> tuple[Index, float | None]:
    """The index of (node, vector) rows of one length, and the recall measured on real links, null if the queries have none."""
    drawn = classes.orderBy(F.xxhash64("node"), "node").select("vector").limit(SAMPLE).toArrow().column(0).combine_chunks()
    index = fit(_normal(drawn.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)), n, threshold)
    links = _bounds_of_links(classes, dim, index, threshold)
    total, met, recall = sum(links.values()), 0, None
    for step in sorted(links):
        edge = _farthest(threshold) * (step + 1) / STEPS
        if edge > index.reach and met >= TARGET_RECALL * total:
            break
        index = replace(index, reach=max(index.reach, edge))
        met += links[step]
        recall = met / total
    return index, recall


def _meetings(classes: DataFrame, dim: int, n: int, threshold: float) -> DataFrame:
    """(u, v, links): for nodes with links, how many a meeting found and the least node it reaches there."""
    spark = classes.sparkSession
    index = spark.sparkContext.broadcast(indexed(classes, dim, n, threshold)[0])

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = index.value.size
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                flat = part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                home, visits = index.value.cells(_normal(flat))
                small = flat.astype(np.float32)
                # Numbers that came as floats travel as floats.
                packed = small if (small == flat).all() else flat
                groups = []
                for cells in visits:
                    own: dict[int, list[int]] = {}
                    for cell in cells:
                        own.setdefault(_group(cell, size), []).append(cell)
                    groups.append([{"g": g, "cells": c} for g, c in own.items()])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array([v.tobytes() for v in packed], pa.binary()),
                        pa.array(home, pa.int32()),
                        pa.array([_group(int(h), size) for h in home], pa.int32()),
                        pa.array(groups, pa.list_(pa.struct([("g", pa.int32()), ("cells", pa.list_(pa.int32()))]))),
                    ],
                    names=["node", "n", "vec", "home", "at", "visits"],
                )

    schema = "node long, n long, vec binary, home int, at int, visits array<struct<g:int,cells:array<int>>>"
    placed = stored(classes.select("node", "n", "vector").mapInArrow(place, schema), "vector-cells")
    residents = placed.groupBy(F.col("at").alias("g")).agg(F.count("*").alias("residents"))
    visitors = placed.select(F.explode("visits.g").alias("g")).groupBy("g").agg(F.count("*").alias("visitors"))
    blocks = stored(
        residents.join(visitors, "g").select(
            "g",
            F.ceil(F.col("residents") / F.lit(BLOCK)).cast("int").alias("rs"),
            F.ceil(F.col("visitors") / F.lit(4 * BLOCK)).cast("int").alias("vs"),
        ),
        "cell-blocks",
    )
    one = lambda n: F.pmod(F.xxhash64("node"), F.col(n).cast("long")).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    held = ["node", "n", "vec", "home"]
    staying = placed.select(*held, F.col("at").alias("g")).join(blocks, "g").select(
        "g", one("rs").alias("r"), all_of("vs").alias("v"), F.lit(None).cast("array<int>").alias("cells"), *held
    )
    coming = (
        placed.select(*held, F.inline("visits"))
        .join(blocks, "g")
        .select("g", all_of("rs").alias("r"), one("vs").alias("v"), "cells", *held)
    )
    dealt = staying.unionByName(coming).repartition("g", "r", "v").sortWithinPartitions("g", "r", "v")

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        key = None
        for batch in batches:
            keys = [batch.column(i).to_numpy() for i in range(3)]
            for s, e in runs(*keys):
                now = tuple(int(k[s]) for k in keys)
                if held and now != key:
                    yield _verified(pa.concat_tables(held), dim, index.value, threshold)
                    held = []
                key = now
                held.append(pa.Table.from_batches([batch.slice(s, e - s)]))
        if held:
            yield _verified(pa.concat_tables(held), dim, index.value, threshold)

    return dealt.mapInArrow(meet, "u long, v long, links long")


def _group(cell: int, size: int) -> int:
    """Cells of a row of the grid, ``GROUP_CELLS`` at a time."""
    row, column = divmod(cell, size)
    return row * -(-size // GROUP_CELLS) + column // GROUP_CELLS


def _normal(raw: np.ndarray) -> np.ndarray:
    raw = raw / np.abs(raw).max(axis=1, initial=0)[:, None]
    return raw / np.sqrt((raw**2).sum(axis=1))[:, None]


def _verified(table: pa.Table, dim: int, index: Index, threshold: float) -> pa.RecordBatch:
    """One meeting of residents and visitors of a group of cells."""
    table = table.combine_chunks()
    cells = table.column("cells").combine_chunks()
    visiting = ~cells.is_null().to_numpy(zero_copy_only=False)
    node, n, home = (table.column(c).to_numpy() for c in ("node", "n", "home"))
    none = pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 3, names=["u", "v", "links"])
    if visiting.all() or not visiting.any():
        return none
    wide = 4 * dim
    raw = table.column("vec").to_pylist()
    vectors = np.stack([np.frombuffer(v, np.float32 if len(v) == wide else np.float64).astype(np.float64) for v in raw])
    unit = _normal(vectors)
    residents = np.flatnonzero(~visiting)
    residents = residents[np.argsort(home[residents], kind="stable")]
    at = home[residents]
    sizes = np.where(visiting, np.diff(cells.offsets.to_numpy()), 0)
    owner = np.repeat(np.arange(len(node)), sizes)
    visited = cells.flatten().to_numpy()
    order = np.argsort(visited, kind="stable")
    owner, visited = owner[order], visited[order]
    pairs = []
    for s, e in runs(visited):
        left, right = np.searchsorted(at, visited[s], "left"), np.searchsorted(at, visited[s], "right")
        if left < right:
            v, r = owner[s:e], residents[left:right]
            for some in range(0, len(v), 4 * BLOCK):
                here = v[some : some + 4 * BLOCK]
                i, j = np.nonzero((unit[here] @ unit[r].T >= threshold) & (node[here][:, None] != node[r]))
                pairs.append(np.stack([here[i], r[j]]))
    v, r = np.concatenate(pairs, axis=1) if pairs else np.empty((2, 0), np.int64)
    if not len(v):
        return none
    # A pair is met twice if the resident visits the visitor's home too; else this meeting counts it for both.
    known, of = np.unique(r, return_inverse=True)
    alone = np.empty(len(r), bool)
    for some in range(0, len(known), 1024):
        within = (of >= some) & (of < some + 1024)
        alone[within] = index.bound(unit[known[some : some + 1024]], home[v[within]], of[within] - some) > index.reach
    links = np.bincount(v, weights=n[r], minlength=len(node)) + np.bincount(r[alone], weights=n[v[alone]], minlength=len(node))
    label = node.copy()
    while True:
        least = label.copy()
        np.minimum.at(least, v, label[r])
        np.minimum.at(least, r, least[v])
        if (least == label).all():
            break
        label = least
    some = np.unique(np.concatenate([v, r]))
    columns = (node[some], label[some], links[some].astype(np.int64))
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["u", "v", "links"])
