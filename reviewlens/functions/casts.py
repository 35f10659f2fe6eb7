"""Tolerant casts: text that does not convert becomes null instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Seconds of 0001-01-01 and 9999-12-31T23:59:59, the range a timestamp can be shown in (fixed values).
MIN_UNIX_SECONDS = -62135596800
MAX_UNIX_SECONDS = 253402300799


def to_whole_number(c: Column, dtype: T.DataType, allow_fractional: bool = True) -> Column:
    """Whole number or null. ``'12.0'`` is truncated to 12, or malformed if ``allow_fractional`` is false."""
    whole = c.try_cast(dtype)
    # Nearly all numbers are plain ones; the exact and dear way over decimals is for what is left.
    return F.coalesce(whole, c.try_cast("decimal(38,18)").try_cast(dtype)) if allow_fractional else whole


def unix_to_timestamp(seconds: Column) -> Column:
    """Instant for unix seconds; independent of the session zone, null when malformed or out of range."""
    whole = seconds.try_cast("bigint")
    return F.when(whole.between(MIN_UNIX_SECONDS, MAX_UNIX_SECONDS), F.timestamp_seconds(whole))


def convert(field: T.StructField, target: T.DataType, allow_fractional: bool = True) -> Column:
    """Expression turning one column into ``target``; a column that has the type already is left alone."""
    c = F.col(f"`{field.name}`")
    if field.dataType == target or (
        isinstance(target, T.TimestampType) and isinstance(field.dataType, T.TimestampNTZType)
    ):
        return c
    if isinstance(target, T.TimestampType):
        return unix_to_timestamp(c)
    if isinstance(target, T.IntegralType):
        return to_whole_number(c, target, allow_fractional)
    return c.try_cast(target)
