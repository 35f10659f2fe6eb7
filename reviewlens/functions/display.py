"""Display forms of review values."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from reviewlens.schema import ALL_LANGUAGES, ALL_LANGUAGES_NAME, LANGUAGE_NAMES

# Display conventions (fixed values).
ELLIPSIS = "..."
TEXT_LENGTH = 300
ID_LENGTH = 8
DATE_FORMAT = "yyyy-MM-dd"
FREE_LABEL = "Free"
PURCHASED_LABEL = "Purchased"
DEFAULT_RANGE_DAYS = 365 * 5


def shorten(text: Column, length: int = TEXT_LENGTH) -> Column:
    """First ``length`` characters and an ellipsis; text that fits, ``''`` and null stay as they are."""
    return F.when(F.length(text) > length, F.concat(F.left(text, F.lit(length)), F.lit(ELLIPSIS))).otherwise(text)


def abbreviate_id(identifier: Column, length: int = ID_LENGTH) -> Column:
    """Leading characters of an id, always with an ellipsis."""
    return F.concat(F.left(identifier.cast("string"), F.lit(length)), F.lit(ELLIPSIS))


def hours(minutes: Column) -> Column:
    """Minutes as hours with one decimal; null counts as 0."""
    return F.round(F.coalesce(minutes.cast("double"), F.lit(0.0)) / F.lit(60.0), 1)


def day(created: Column) -> Column:
    return F.to_date(created)


def day_text(created: Column) -> Column:
    """``YYYY-MM-DD``; null stays null."""
    return F.date_format(created, DATE_FORMAT)


def acquisition(free: Column) -> Column:
    """Free when the flag is true, otherwise Purchased; an unknown flag counts as Purchased."""
    return F.when(free, F.lit(FREE_LABEL)).otherwise(F.lit(PURCHASED_LABEL))


def _lookup(entries: dict[str, str], key: Column) -> Column:
    literals = [F.lit(part) for entry in entries.items() for part in entry]
    return F.try_element_at(F.create_map(*literals), key)


def language_name(code: Column) -> Column:
    """Display name of a language code; unknown codes name themselves. A literal map, so no join."""
    return F.coalesce(_lookup({ALL_LANGUAGES: ALL_LANGUAGES_NAME, **LANGUAGE_NAMES}, code), code)


def language_code(name: Column) -> Column:
    """Code of a display name; anything else means all languages."""
    inverse = {display: code for code, display in LANGUAGE_NAMES.items()}
    return F.coalesce(_lookup(inverse, name), F.lit(ALL_LANGUAGES))


def default_date_range(as_of: dt.date, days: int = DEFAULT_RANGE_DAYS) -> tuple[dt.date, dt.date]:
    """The day range a report covers when none is asked for, ending ``as_of``."""
    return as_of - dt.timedelta(days=days), as_of
