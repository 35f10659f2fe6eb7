"""Row filters shared by leaderboards and reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from reviewlens.functions.predicates import as_date, column, on_days
from reviewlens.operators.columns import require_columns
from reviewlens.schema import REVIEW, ReviewColumns

def between_days(
    df: DataFrame, start=None, end=None, created: str = REVIEW.created, created_year: str | None = None
) -> DataFrame:
    """Reviews of ``start`` to ``end``, both days included; a bound left out is open.

    The test is a plain range on the clock, which Parquet row groups and pages are pruned by.
    ``created_year`` names a partition column with the year of this same clock: whole directories are
    then pruned too. Their range is a day wider on both sides because the year may have been taken in
    another session zone.
    """
    if start is None and end is None:
        return df
    require_columns(df, [created])
    result = df.where(on_days(column(created), start, end))
    if created_year is not None:
        require_columns(df, [created_year])
        if start is not None:
            result = result.where(column(created_year) >= (as_date(start) - dt.timedelta(days=1)).year)
        if end is not None:
            result = result.where(column(created_year) <= (as_date(end) + dt.timedelta(days=1)).year)
    return result


def of_product(df: DataFrame, product: str, start=None, end=None, cols: ReviewColumns = REVIEW) -> DataFrame:
    """Reviews of exactly this product (case-sensitive, untrimmed) in a day range."""
    require_columns(df, [cols.product])
    chosen = df.where(column(cols.product) == F.lit(product))
    return between_days(chosen, start, end, cols.created, cols.created_year)
