"""Column checks and projections."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame

from reviewlens.schema import UNUSED_COLUMNS


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` itself, or a ValueError naming every missing column."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns {missing}; the table has {df.columns}")
    return df


def resolve_column(df: DataFrame, candidates: Sequence[str], required: bool = True) -> str | None:
    """First candidate the table has. None when there is none and it is not required."""
    found = next((name for name in candidates if name in df.columns), None)
    if found is None and required:
        raise ValueError(f"none of {list(candidates)} found; the table has {df.columns}")
    return found


def drop_columns(df: DataFrame, names: Iterable[str] = UNUSED_COLUMNS) -> DataFrame:
    """Without ``names``; names the table does not have are ignored."""
    return df.drop(*names)


def require_limit(k: int) -> int:
    """A usable row limit, or a ValueError."""
    if isinstance(k, bool) or not isinstance(k, int) or k <= 0:
        raise ValueError(f"a positive whole number is needed, not {k!r}")
    return k
