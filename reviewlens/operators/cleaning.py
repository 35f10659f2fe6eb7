"""Raw, text-typed reviews to typed, complete reviews, with audits of what was lost."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from reviewlens.functions.casts import convert
from reviewlens.functions.predicates import column, is_complete, is_missing, is_present
from reviewlens.operators.columns import drop_columns, require_columns
from reviewlens.schema import CLEAN_CASTS, UNUSED_COLUMNS, CastSpec


def convert_types(df: DataFrame, casts: CastSpec = CLEAN_CASTS, allow_fractional: bool = True) -> DataFrame:
    """Apply a cast spec in one projection. Malformed and overflowing values become null."""
    targets = casts.target_types()
    require_columns(df, targets)
    return df.select(
        *[
            convert(f, targets[f.name], allow_fractional).alias(f.name) if f.name in targets else column(f.name)
            for f in df.schema.fields
        ]
    )


def null_audit(df: DataFrame, empty_as_missing: bool = True) -> DataFrame:
    """One row with the number of missing values of every column; one scan, no shuffle of rows."""
    return df.agg(*[F.count_if(is_missing(f, empty_as_missing)).alias(f.name) for f in df.schema.fields])


def null_audit_rows(df: DataFrame, empty_as_missing: bool = True) -> DataFrame:
    """The same audit as (column_name, missing_rows)."""
    return null_audit(df, empty_as_missing).unpivot([], [column(c) for c in df.columns], "column_name", "missing_rows")


def _fields(df: DataFrame, names: Iterable[str] | None):
    if names is None:
        return df.schema.fields
    names = list(names)
    require_columns(df, names)
    return [df.schema[name] for name in names]


def drop_incomplete(df: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """Rows in which every column (or every one of ``names``) is present."""
    return df.where(is_complete(_fields(df, names)))


def drop_missing(df: DataFrame, name: str) -> DataFrame:
    """Rows in which one column is present; unchanged when the table has no such column."""
    return df.where(is_present(df.schema[name])) if name in df.columns else df


def drop_report(df: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """rows_before, rows_after and rows_dropped of :func:`drop_incomplete`, counted in one scan."""
    complete = is_complete(_fields(df, names))
    counts = df.agg(F.count(F.lit(1)).alias("rows_before"), F.count_if(complete).alias("rows_after"))
    return counts.withColumn("rows_dropped", F.col("rows_before") - F.col("rows_after"))


def clean_reviews(
    raw: DataFrame,
    casts: CastSpec = CLEAN_CASTS,
    unused: Iterable[str] = UNUSED_COLUMNS,
    allow_fractional: bool = True,
) -> DataFrame:
    """Drop unused columns, convert types, keep complete rows: one scan, no shuffle."""
    return drop_incomplete(convert_types(drop_columns(raw, unused), casts, allow_fractional))
