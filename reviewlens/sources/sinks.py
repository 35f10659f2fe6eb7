"""Sinks for cleaned tables, name lists and results."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewlens.functions.predicates import column
from reviewlens.operators.catalog import distinct_names
from reviewlens.operators.columns import require_columns, require_limit
from reviewlens.schema import REVIEW, ReviewColumns

COMPRESSION = "snappy"
YEAR_COLUMN = "review_year"
#: Of a clustered file: one Parquet row group, and what one task of a layout gets.
FILE_BYTES = 128 << 20


def write_parquet(
    df: DataFrame,
    path: str,
    files: int | None = None,
    max_rows_per_file: int | None = None,
    partition_by: Iterable[str] = (),
    mode: str = "overwrite",
) -> None:
    """Snappy Parquet. By default every task writes its own file and nothing is moved.

    ``files=1`` makes the single file that small tables are handed over in. The rows are then
    repartitioned, not coalesced, so that the work before the write keeps its parallelism.
    """
    rows = df if files is None else df.repartition(require_limit(files))
    writer = rows.write.mode(mode).option("compression", COMPRESSION)
    if max_rows_per_file is not None:
        writer = writer.option("maxRecordsPerFile", require_limit(max_rows_per_file))
    writer.partitionBy(*partition_by).parquet(path)


def cluster_reviews(df: DataFrame, files: int | None = None, cols: ReviewColumns = REVIEW) -> DataFrame:
    """Reviews laid out by product, then clock, so that report filters skip row groups.

    Ranges are cut on product, clock and a digest of the author: one product, or one product and
    clock, that holds a third of the table is spread over many files. A task gets the rows of one file whole: choose
    ``files`` by ``files_for``; left out, ``spark.sql.shuffle.partitions`` decides.
    """
    require_columns(df, [cols.product, cols.created, cols.author])
    keys = [column(cols.product), column(cols.created), F.xxhash64(column(cols.author))]
    ranged = df.repartitionByRange(*keys) if files is None else df.repartitionByRange(require_limit(files), *keys)
    return ranged.sortWithinPartitions(column(cols.product), column(cols.created))


def files_for(spark: SparkSession, path: str, file_bytes: int = FILE_BYTES) -> int:
    """How many files of about ``file_bytes`` hold what is stored at ``path``."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    stored = folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    return max(1, -(-stored // file_bytes))


def with_review_year(df: DataFrame, created: str = REVIEW.created, name: str = YEAR_COLUMN) -> DataFrame:
    """Adds the year of a clock as a partition column. Bind it as ``created_year`` for day filters on that clock."""
    require_columns(df, [created])
    return df.withColumn(name, F.year(column(created)))


def write_names(df: DataFrame, name: str, path: str, single_file: bool = False, mode: str = "overwrite") -> None:
    """Sorted distinct non-empty values of a column, one per line in UTF-8 text files, in the order of their names.

    The values are made distinct and sorted by the cluster. ``single_file`` sorts and writes them in one
    task: for lists that are known to be short.
    """
    names = distinct_names(df, name)
    (names.coalesce(1) if single_file else names).write.mode(mode).text(path)


def export(
    df: DataFrame, path: str, file_format: str = "parquet", null_value: str = "", mode: str = "overwrite"
) -> None:
    """Any result as ``parquet`` or ``csv`` with a header and doubled quotes.

    In CSV an empty text is written as ``""`` and null as ``null_value``. Spark's CSV reader takes a
    value equal to its null marker for null, so a marker other than ``''`` keeps the two apart.
    """
    if file_format == "parquet":
        write_parquet(df, path, mode=mode)
    elif file_format == "csv":
        df.write.mode(mode).options(header=True, **_csv_options(null_value)).csv(path)
    else:
        raise ValueError(f"parquet or csv, not {file_format!r}")


def _csv_options(null_value: str) -> dict[str, str]:
    return {
        "quote": '"',
        "escape": '"',
        "nullValue": null_value,
        "emptyValue": '""',
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    }


def export_one_csv(df: DataFrame, path: str, null_value: str = "") -> None:
    """One CSV file ``path`` as :func:`export` writes it, by as many tasks as ``df`` has partitions.

    A first pass counts the bytes of each partition, a second one writes each at its place in the file; only counts reach
    the driver. ``path`` must lie in a folder that the driver and all executors have mounted. ``df`` is computed twice
    and has to give the same partitions, as the scan of a table does; the job fails if a partition's length differs.
    """
    spark = df.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if target.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme() != "file":
        raise ValueError(f"one file can be written by many tasks in a mounted folder only, not at {path}")
    local, options = target.toUri().getPath(), _csv_options(null_value)
    names = F.struct(*[F.lit(name).alias(f"_{i}") for i, name in enumerate(df.columns)])
    header = spark.range(1).select(F.to_csv(names, options)).first()[0].encode() + b"\n"
    lines = df.select(F.concat(F.to_csv(F.struct(*[column(c) for c in df.columns]), options), F.lit("\n")).alias("line"))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield _length(sum(len(_bytes(batch)) for batch in batches))

    sizes = dict(lines.mapInArrow(count, "part int, bytes long").collect())
    begins, end = {}, len(header)
    for part in sorted(sizes):
        begins[part] = end
        end += sizes[part]
    os.makedirs(os.path.dirname(local), exist_ok=True)
    with open(local, "wb") as file:
        file.write(header)
        file.truncate(end)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        with open(local, "r+b") as file:
            file.seek(begins.get(part, end))
            for batch in batches:
                found = _bytes(batch)
                at += len(found)
                if at > sizes.get(part, 0):
                    break
                file.write(found)
        if at != sizes.get(part, 0):
            raise ValueError(f"partition {part} had {sizes.get(part, 0)} bytes at first, then {at}")
        yield _length(at)

    written = sum(row.bytes for row in lines.mapInArrow(write, "part int, bytes long").collect())
    if written != end - len(header):
        raise ValueError(f"{written} bytes were written behind the header, not {end - len(header)}")


def _bytes(batch: pa.RecordBatch) -> memoryview:
    """The texts of a batch one behind the other, as Arrow holds them."""
    texts = batch.column(0).cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    edges = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return memoryview(data or b"")[edges[0] : edges[-1]]


def _length(n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {"part": pa.array([TaskContext.get().partitionId()], pa.int32()), "bytes": pa.array([n], pa.int64())}
    )
