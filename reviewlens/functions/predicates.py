"""Row predicates chosen by column type, built once in Python from the schema."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, functions as F, types as T

# Patterns of the conversion checks (fixed values). \A and \z anchor the whole value,
# also when it ends in a line break.
BOOLEAN_PATTERN = r"\A(0|1|true|false|t|f|yes|no|y|n)\z"
INTEGER_PATTERN = r"\A-?\d+\z"
FLOAT_PATTERN = r"\A-?\d+(\.\d*)?\z"
WHITE_SPACE = " \t\n\x0b\f\r"
SPECIAL_CHARACTER_PATTERN = r"[^a-zA-Z0-9\s\.-]"


def column(name: str) -> Column:
    """Column by its exact name, dots included."""
    return F.col(f"`{name}`")


def is_missing(field: T.StructField, empty_as_missing: bool = True) -> Column:
    """Null; for float and double also NaN; for strings also ``''``. Blanks count as present."""
    c = column(field.name)
    if isinstance(field.dataType, T.FractionalType) and not isinstance(field.dataType, T.DecimalType):
        return c.isNull() | F.isnan(c)
    if isinstance(field.dataType, T.StringType) and empty_as_missing:
        return c.isNull() | (c == "")
    return c.isNull()


def is_present(field: T.StructField) -> Column:
    """Opposite of :func:`is_missing`, in a form whose null and ``''`` tests reach the Parquet scan."""
    c = column(field.name)
    if isinstance(field.dataType, T.FractionalType) and not isinstance(field.dataType, T.DecimalType):
        return c.isNotNull() & ~F.isnan(c)
    if isinstance(field.dataType, T.StringType):
        return c.isNotNull() & (c != "")
    return c.isNotNull()


def is_complete(fields: Iterable[T.StructField]) -> Column:
    """True when every column is present; true for an empty list."""
    return reduce(lambda left, right: left & right, map(is_present, fields), F.lit(True))


def is_null_or_zero(field: T.StructField) -> Column:
    """Null, or the type's empty value: 0 or NaN, false, ``''`` or spaces only. Clocks: null only."""
    c = column(field.name)
    if isinstance(field.dataType, T.NumericType):
        return is_missing(field) | (c == 0)
    if isinstance(field.dataType, T.BooleanType):
        return c.isNull() | ~c
    if isinstance(field.dataType, T.StringType):
        return c.isNull() | (F.trim(c) == "")
    return c.isNull()


def is_blank(text: Column) -> Column:
    """Null, empty or white space only."""
    return text.isNull() | (F.btrim(text, F.lit(WHITE_SPACE)) == "")


def is_padded(text: Column) -> Column:
    """Not null, with spaces at either end."""
    return text.isNotNull() & (text != F.trim(text))


def has_special_characters(text: Column) -> Column:
    return text.isNotNull() & text.rlike(SPECIAL_CHARACTER_PATTERN)


def breaks_pattern(text: Column, pattern: str) -> Column:
    """Not null and not of the form ``pattern``."""
    return text.isNotNull() & ~text.rlike(pattern)


def as_date(value: dt.date | dt.datetime | str) -> dt.date:
    """The calendar day of a bound; the time of day is dropped."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, str):
        return dt.date.fromisoformat(value[:10])
    return value


def on_days(created: Column, start=None, end=None) -> Column:
    """``start <= day <= end`` as a half-open range on the clock itself, so that it reaches the scan.

    Either bound may be left out; null clocks match no bound.
    """
    test = F.lit(True)
    if start is not None:
        test = test & (created >= F.lit(as_date(start)))
    if end is not None:
        test = test & (created < F.lit(as_date(end) + dt.timedelta(days=1)))
    return test
