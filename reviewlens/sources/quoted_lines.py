"""Records of large CSV files whose quoted values hold line breaks, read by many tasks.

A line break ends a record if the quotes before it in the file are even in number; doubled quotes keep that so. The
lines of each byte range are read as text. A first scan counts quotes per range; from the running parity of a
file's ranges every range knows whether it begins within a value, and cuts its lines into records on its own. What lies
before its first record end, and behind its last, are parts of records that span ranges: these are put together
by a second reading, at most two parts a range.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

RANGE = ("file", "begin")
_WHOLE = "file string, first boolean, value string"
_PART = "file string, begin long, kind int, first boolean, value string"


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    paths = [path] if isinstance(path, str) else path
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("begin"), "value"
    )


def ranges_within_quotes(lines: DataFrame) -> set[tuple[str, int]]:
    """The ranges that begin within a quoted value. The driver gets a row for each range, as it does to plan the scan."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    odd = lines.groupBy(*RANGE).agg((F.sum(quotes) % 2).alias("odd")).collect()
    inside, file, found = False, None, set()
    for row in sorted(odd, key=lambda r: (r.file, r.begin)):
        inside = inside if row.file == file else False
        file = row.file
        if inside:
            found.add((row.file, row.begin))
        inside ^= bool(row.odd)
    return found


def _cut(lines: list[str], inside: bool) -> tuple[list[str], list[str]]:
    """What ends within ``lines``, and the lines behind the last end."""
    quotes = np.fromiter((line.count('"') for line in lines), np.int64, len(lines))
    records, at = [], 0
    for end in np.flatnonzero((np.cumsum(quotes) + inside) % 2 == 0).tolist():
        records.append(lines[at] if end == at else "\n".join(lines[at : end + 1]))
        at = end + 1
    return records, lines[at:]


@dataclass
class _Range:
    """What is known while the lines of a range go by."""

    file: str
    begin: int
    inside: bool
    first: bool
    #: Still in the record that an earlier range began.
    before: bool
    open_lines: list[str] = field(default_factory=list)

    def take(self, lines: list[str]) -> tuple[list[tuple], list[tuple]]:
        """Whole records as (file, first, value), parts as (file, begin, kind, first, value); kind 0 goes on, 1 begins."""
        records, rest = _cut(lines, self.inside)
        parts = []
        if not records:
            self.open_lines += rest
        else:
            if self.inside:
                records[0] = "\n".join([*self.open_lines, records[0]])
            if self.before:
                parts.append((self.file, self.begin, 0, False, records.pop(0)))
                self.before = False
            self.open_lines = rest
        self.inside = bool(self.open_lines)
        whole = [(self.file, self.first and i == 0, text) for i, text in enumerate(records)]
        self.first &= not whole
        return whole, parts

    def end(self) -> list[tuple]:
        return [(self.file, self.begin, int(not self.before), self.first, "\n".join(self.open_lines))] if self.open_lines else []


def _read(batches: Iterable[pa.RecordBatch], within: set[tuple[str, int]]) -> Iterator[tuple[list[tuple], list[tuple]]]:
    now: _Range | None = None
    for (file, begin), lines in _one_by_one(batches):
        if now is None or (now.file, now.begin) != (file, begin):
            if now is not None:
                yield [], now.end()
            inside = (file, begin) in within
            now = _Range(file, begin, inside, begin == 0, inside)
        yield now.take(lines)
    if now is not None:
        yield [], now.end()


def record_texts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, first, value): the text of every record, line breaks within it; ``first`` marks the first one of a file.

    Quotes may stand only around values, and doubled within them, as ``sinks.export`` writes them. A record
    whose quote is never closed ends with its file.
    """
    lines = _lines(spark, path)
    within = spark.sparkContext.broadcast(ranges_within_quotes(lines))

    def records(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found, _ in _read(batches, within.value):
            if found:
                yield _rows(found, _WHOLE)

    def cut_records(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, found in _read(batches, within.value):
            if found:
                yield _rows(found, _PART)

    # A part of kind 1 begins a record; the parts of kind 0 up to the next one go on with it.
    parts = lines.mapInArrow(cut_records, _PART)
    order = Window.partitionBy("file").orderBy("begin", "kind")
    numbered = parts.withColumn("record", F.sum("kind").over(order))
    joined = numbered.groupBy("file", "record").agg(
        F.max("first").alias("first"), F.sort_array(F.collect_list(F.struct("begin", "kind", "value"))).alias("parts")
    )
    spanning = joined.select("file", "first", F.array_join("parts.value", "\n").alias("value"))
    return lines.mapInArrow(records, _WHOLE).unionByName(spanning)


def _one_by_one(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], list[str]]]:
    """The lines of each batch, split where a new range begins."""
    for batch in batches:
        files, begins = batch.column(0).to_pylist(), batch.column(1).to_numpy()
        texts = batch.column(2).to_pylist()
        change = np.flatnonzero(np.array([a != b for a, b in zip(files[1:], files, strict=False)], bool) | (np.diff(begins) != 0)) + 1
        edges = [0, *change.tolist(), len(texts)]
        for s, e in zip(edges[:-1], edges[1:], strict=True):
            if s < e:
                yield (files[s], int(begins[s])), texts[s:e]


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    types = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    names, kinds = zip(*(column.split() for column in schema.split(", ")), strict=True)
    columns = zip(zip(*rows, strict=True), kinds, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(values, types[kind]) for values, kind in columns], names=list(names))
