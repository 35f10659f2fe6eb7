"""The profile of text columns as a whole: counts, frequent values, samples and bad values."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from reviewlens.operators import profiling as P


@dataclass(frozen=True)
class ProfileReport:
    counts: DataFrame
    frequent_values: DataFrame
    sample_values: DataFrame
    nonconvertible_values: DataFrame
    cached: tuple[DataFrame, ...] = ()

    def unpersist(self) -> None:
        for frame in self.cached:
            frame.unpersist()

    def __enter__(self) -> ProfileReport:
        return self

    def __exit__(self, *_) -> None:
        self.unpersist()


def profile_report(
    df: DataFrame,
    columns: Iterable[str],
    patterns: Mapping[str, str] = P.TARGET_PATTERNS,
    frequent: int = 20,
    sample: int = 20,
    bad: int = 10,
    persist: bool = True,
    listed: Iterable[str] | None = None,
) -> ProfileReport:
    """Profile ``columns``: counts from one scan, lists of values from one more.

    The counts shuffle digests only. The lists are made from the counted values of the ``listed`` columns (all
    of them by default), which are what is cached, one row per distinct value: leave free text out of
    ``listed``, as it has about as many values as rows.
    """
    columns = list(columns)
    listed = columns if listed is None else list(listed)
    values = P.value_counts(df, listed)
    if persist:
        values = values.persist(StorageLevel.MEMORY_AND_DISK)
    by_count = [F.desc("row_count"), F.asc_nulls_last("value")]
    by_value = [F.asc_nulls_last("value")]
    return ProfileReport(
        counts=P.profile_columns(df, columns, patterns),
        frequent_values=P.first_per_column(values, by_count, frequent),
        sample_values=P.first_per_column(values.select("column_name", "value"), by_value, sample),
        nonconvertible_values=P.nonconvertible_in_values(values, listed, bad, patterns),
        cached=(values,) if persist else (),
    )
