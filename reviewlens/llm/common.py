"""Helpers that the operators share: Arrow maps, tables that cut lineage, runs of a sorted batch."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlens.sources.scratch import scratch_path

#: Rows that a Python function is given at a time, so that what it makes of them stays small.
ROWS = 1024
#: White space as the contracts of word counts have it; ``bytes.split()`` splits at exactly these.
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again.

    Later jobs read the files, so a lost executor costs no recomputation, and the planner knows the
    size before it chooses between a broadcast and a shuffle.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def portions(batches: Iterable[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], dict], schema: T.StructType | str) -> DataFrame:
    """``function`` gives the columns of the result for each Arrow batch; there is no shuffle."""
    target = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = target.fieldNames()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            columns = function(batch)
            yield pa.RecordBatch.from_arrays(
                [x if isinstance(x, pa.Array) else pa.array(x) for x in (columns[n] for n in names)], names=names
            )

    return df.mapInArrow(run, target)


def keep_rows(df: DataFrame, text: str, keep: Callable[[list], np.ndarray]) -> DataFrame:
    """The rows whose text ``keep`` accepts, with all their columns."""
    position = df.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            yield batch.filter(pa.array(keep(batch.column(position).to_pylist()), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def runs(*keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """(start, end) of each run of equal keys."""
    n = len(keys[0])
    if not n:
        return
    change = np.zeros(n - 1, bool)
    for key in keys:
        change |= key[1:] != key[:-1]
    edges = np.concatenate(([0], np.flatnonzero(change) + 1, [n]))
    yield from zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(raw, upper, upper.lower())


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def least_labels(linked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest id that each row of a symmetric link matrix reaches within it."""
    labels = ids.copy()
    largest = np.iinfo(ids.dtype).max
    while True:
        found = np.minimum(labels, np.where(linked, labels[None, :], largest).min(axis=1, initial=largest))
        if (found == labels).all():
            return labels
        labels = found
