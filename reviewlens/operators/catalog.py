"""Catalogs of distinct names."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reviewlens.functions.predicates import column
from reviewlens.operators.columns import require_columns, resolve_column
from reviewlens.schema import LANGUAGE_NAME_CANDIDATES, PRODUCT_NAME_CANDIDATES


def distinct_names(df: DataFrame, name: str) -> DataFrame:
    """Distinct non-empty values of a column as text, ascending by code point; never on the driver."""
    require_columns(df, [name])
    text = column(name).cast("string")
    return df.select(text.alias(name)).where(column(name) != "").distinct().orderBy(column(name))


def product_names(df: DataFrame) -> DataFrame:
    """Sorted product names from whichever product column the table has."""
    return distinct_names(df, resolve_column(df, PRODUCT_NAME_CANDIDATES))


def language_codes(df: DataFrame) -> DataFrame | None:
    """Sorted language codes, or None when the table has no language column."""
    name = resolve_column(df, LANGUAGE_NAME_CANDIDATES, required=False)
    return None if name is None else distinct_names(df, name)


def distinct_counts(df: DataFrame, *names: str, approximate: bool = False) -> DataFrame:
    """One row with the number of distinct non-null values of each column.

    Exact counts shuffle the distinct values; approximate ones only a sketch per task.
    """
    require_columns(df, names)
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[count(column(c)).alias(c) for c in names])
