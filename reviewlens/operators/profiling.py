"""Profiles of text columns before they are converted."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from reviewlens.functions.predicates import (
    BOOLEAN_PATTERN,
    FLOAT_PATTERN,
    INTEGER_PATTERN,
    breaks_pattern,
    column,
    has_special_characters,
    is_blank,
    is_null_or_zero,
    is_padded,
)
from reviewlens.operators.columns import require_columns, require_limit

# Which columns are meant to become which type (fixed values).
TARGET_PATTERNS: Mapping[str, str] = {
    "voted_up": BOOLEAN_PATTERN,
    "steam_purchase": BOOLEAN_PATTERN,
    "received_for_free": BOOLEAN_PATTERN,
    "written_during_early_access": BOOLEAN_PATTERN,
    "votes_up": INTEGER_PATTERN,
    "votes_funny": INTEGER_PATTERN,
    "comment_count": INTEGER_PATTERN,
    "weighted_vote_score": FLOAT_PATTERN,
}

# Sketches of 4,096 counters: a standard error of 1.6 %.
SKETCH_LG_K = 12
# How many parts of a column are ranked on their own before the column is.
RANKED_PARTS = 64
# Characters of a free text that take part in its ranking before its text is fetched.
RANKED_CHARACTERS = 64
ROW_COUNTS = ("blank_rows", "nonconvertible_rows", "padded_rows", "special_character_rows")


def _row_checks(text: Column) -> dict[str, Column]:
    return {
        "blank_rows": is_blank(text),
        "padded_rows": is_padded(text),
        "special_character_rows": has_special_characters(text),
    }


def _as_text(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    columns = list(columns)
    return require_columns(df, columns).select(*[column(c).cast("string").alias(c) for c in columns])


def value_counts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """(column_name, value, row_count) over several columns in one scan; counted before the shuffle."""
    columns = list(columns)
    values = _as_text(df, columns).unpivot([], [column(c) for c in columns], "column_name", "value")
    return values.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("row_count"))


def profile_columns(
    df: DataFrame,
    columns: Iterable[str],
    patterns: Mapping[str, str] = TARGET_PATTERNS,
    sketch: Iterable[str] = (),
) -> DataFrame:
    """One row of counts per column: distinct, blank, non-convertible, padded, special characters.

    ``nonconvertible_rows`` is null for a column without a pattern. One scan checks every row as a flat aggregate of one
    row a task; one more makes the digests of the other columns' values distinct, and what is shuffled is 16 bytes a
    distinct value, however long the texts are. For columns in ``sketch`` the number of distinct values is approximate
    and comes from the first scan. An empty table gives a row of zeros per column.
    """
    columns, sketch = list(columns), set(sketch)
    text = _as_text(df, columns)
    numbers = {name: f"c{i}" for i, name in enumerate(columns)}
    flat = []
    for name, number in numbers.items():
        checks = _row_checks(column(name))
        if name in patterns:
            checks["nonconvertible_rows"] = breaks_pattern(column(name), patterns[name])
        flat += [F.count_if(check).alias(f"{number}_{kind}") for kind, check in checks.items()]
        if name in sketch:
            flat.append(F.approx_count_distinct(column(name)).alias(f"{number}_distinct"))
    none, zero = F.lit(None).cast("bigint"), F.lit(0).cast("bigint")
    counts = [
        F.struct(
            F.lit(name).alias("column_name"),
            (column(f"{number}_distinct") if name in sketch else zero).alias("distinct_values"),
            *[
                (column(f"{number}_{kind}") if kind != "nonconvertible_rows" or name in patterns else none).alias(kind)
                for kind in ROW_COUNTS
            ],
        )
        for name, number in numbers.items()
    ]
    checked = text.agg(*flat).select(F.inline(F.array(*counts)))
    exact = [name for name in columns if name not in sketch]
    if exact:
        digests = F.array(*[F.struct(F.lit(name).alias("column_name"), F.unhex(F.md5(column(name))).alias("digest")) for name in exact])
        values = text.select(F.inline(digests)).where(F.col("digest").isNotNull()).distinct()
        distinct = values.groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct_values"))
        checked = checked.unionByName(distinct, allowMissingColumns=True)
    return checked.groupBy("column_name").agg(F.sum("distinct_values").alias("distinct_values"), *[F.sum(c).alias(c) for c in ROW_COUNTS])


def distinct_sketches(df: DataFrame, columns: Iterable[str], by: Iterable[str] = (), lg_k: int = SKETCH_LG_K) -> DataFrame:
    """(``by``..., column_name, known_rows, sketch): a mergeable sketch of each column's distinct values, per group.

    Store them by day or file: a profile of a table that has grown then reads the new part only and merges its
    sketches with the old ones. One row per group and task is shuffled, of about 2^``lg_k`` bytes a column at most,
    so a group with a third of the table costs no more than others. Null is no value.
    """
    columns, by = list(columns), list(by)
    text = require_columns(df, [*columns, *by])
    parts = []
    for i, name in enumerate(columns):
        value = column(name).cast("string")
        parts += [F.count(value).alias(f"n{i}"), F.hll_sketch_agg(value, lg_k).alias(f"s{i}")]
    keys = [column(c) for c in by]
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("column_name"), F.col(f"n{i}").alias("known_rows"), F.col(f"s{i}").alias("sketch"))
            for i, name in enumerate(columns)
        ]
    )
    return text.groupBy(*keys).agg(*parts).select(*keys, F.inline(rows))


def merge_sketches(sketches: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """Sketches of the same form for coarser groups, or one per column: as if made from all the rows at once."""
    keys = [*map(column, by), F.col("column_name")]
    return sketches.groupBy(*keys).agg(F.sum("known_rows").alias("known_rows"), F.hll_union_agg("sketch").alias("sketch"))


def distinct_from_sketches(sketches: DataFrame) -> DataFrame:
    """(column_name, known_rows, distinct_values) of the whole table; the standard error is about 1 / 2^(lg_k / 2)."""
    merged = merge_sketches(sketches)
    return merged.select("column_name", "known_rows", F.hll_sketch_estimate("sketch").alias("distinct_values"))


def _nonconvertible(columns: Iterable[str], patterns: Mapping[str, str]) -> Column:
    # For (column_name, value) rows; null for a column without a pattern.
    names_of: dict[str, list[str]] = {}
    for name in columns:
        if name in patterns:
            names_of.setdefault(patterns[name], []).append(name)
    test = F.lit(None).cast("boolean")
    for pattern, names in names_of.items():
        test = F.when(F.col("column_name").isin(names), breaks_pattern(F.col("value"), pattern)).otherwise(test)
    return test


def value_frequency(df: DataFrame, name: str, n: int = 20, free_text: bool = False) -> DataFrame:
    """The ``n`` most frequent values; ties by value, null last.

    ``free_text`` is for columns with about as many values as rows: no text is shuffled. Digests are counted with
    the first ``RANKED_CHARACTERS`` of their text, and only the texts of those that are not behind the n-th by
    count and these characters are fetched, by a second scan.
    """
    require_columns(df, [name])
    require_limit(n)
    if free_text:
        return _frequent_texts(df, name, n)
    counted = df.groupBy(column(name).alias("value")).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.orderBy(F.desc("row_count"), F.asc_nulls_last("value")).limit(n)


def _frequent_texts(df: DataFrame, name: str, n: int) -> DataFrame:
    text = column(name).cast("string")
    digest = F.unhex(F.md5(text))
    start = F.substring(text, 1, RANKED_CHARACTERS)
    counted = df.select(digest.alias("digest"), start.alias("start")).groupBy("digest").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("start").alias("start")
    )
    # Sorts like the ranking, as far as the first characters go.
    placed = counted.select("digest", "row_count", F.struct(-F.col("row_count"), F.col("start").isNull(), "start").alias("place"))
    last = placed.select("place").orderBy("place").limit(n).agg(F.max("place")).scalar()
    ahead = placed.where(F.col("place") <= last)
    chosen = ahead.agg(
        F.map_from_entries(F.collect_list(F.when(F.col("digest").isNotNull(), F.struct(F.hex("digest"), "row_count")))).alias("of"),
        F.max(F.when(F.col("digest").isNull(), F.col("row_count"))).alias("nulls"),
    )
    counts, nulls = chosen.select("of").scalar(), chosen.select("nulls").scalar()
    key = F.hex(digest)
    found = df.select(text.alias("value"), F.when(text.isNull(), nulls).otherwise(F.element_at(counts, key)).alias("row_count"))
    rows = found.where(F.col("row_count").isNotNull())
    # What is left are the rows of the few texts that can be in the result, one per text and task when shuffled.
    values = rows.groupBy("value").agg(F.max("row_count").alias("row_count"))
    return values.orderBy(F.desc("row_count"), F.asc_nulls_last("value")).limit(n)


def distinct_sample(df: DataFrame, name: str, n: int = 20) -> DataFrame:
    """The first ``n`` distinct values in ascending order, null last."""
    values = require_columns(df, [name]).select(column(name).alias("value")).distinct()
    return values.orderBy(F.asc_nulls_last("value")).limit(require_limit(n))


def nonconvertible_values(
    df: DataFrame, columns: Iterable[str], n: int = 10, patterns: Mapping[str, str] = TARGET_PATTERNS
) -> DataFrame:
    """Up to ``n`` distinct values per column that break the column's pattern, in ascending order.

    Good values are dropped in the scan, bad ones are made distinct before the shuffle and cut to
    ``n`` per column on both sides of the ranking shuffle: no column is sorted whole in one task.
    """
    columns = [c for c in columns if c in patterns]
    text = _as_text(df, columns)
    bad = text.select(*[F.when(breaks_pattern(column(c), patterns[c]), column(c)).alias(c) for c in columns])
    values = bad.unpivot([], [column(c) for c in columns], "column_name", "value")
    values = values.where(F.col("value").isNotNull()).distinct()
    return first_per_column(values, [F.asc("value")], n).select("column_name", "value")


def nonconvertible_in_values(
    values: DataFrame, columns: Iterable[str], n: int = 10, patterns: Mapping[str, str] = TARGET_PATTERNS
) -> DataFrame:
    """:func:`nonconvertible_values` from the :func:`value_counts` of the columns."""
    bad = values.where(_nonconvertible(columns, patterns)).select("column_name", "value")
    return first_per_column(bad, [F.asc("value")], n).select("column_name", "value")


def first_per_column(values: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of every column with their ``position``.

    The values of a column are ranked in parts, and the first ``n`` of each part once more: no task
    sorts a whole column, whatever ``n``.
    """
    part = F.pmod(F.xxhash64("value"), F.lit(RANKED_PARTS))
    within = Window.partitionBy("column_name", part).orderBy(*order)
    first = values.withColumn("position", F.row_number().over(within)).where(F.col("position") <= require_limit(n))
    position = F.row_number().over(Window.partitionBy("column_name").orderBy(*order))
    return first.withColumn("position", position).where(F.col("position") <= n)


def null_or_zero_rows(df: DataFrame, name: str) -> DataFrame:
    """Rows in which a column is null or holds its type's empty value."""
    require_columns(df, [name])
    return df.where(is_null_or_zero(df.schema[name]))


def null_or_zero_counts(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """(column_name, row_count) of :func:`null_or_zero_rows` for many columns in one scan."""
    names = list(columns) if columns is not None else df.columns
    require_columns(df, names)
    counts = df.agg(*[F.count_if(is_null_or_zero(df.schema[c])).alias(c) for c in names])
    return counts.unpivot([], [column(c) for c in names], "column_name", "row_count")


def random_rows(df: DataFrame, n: int = 10, seed: int | None = None, key: Iterable[str] = ()) -> DataFrame:
    """``n`` rows in random order, without a full sort.

    With ``key`` columns the order is that of a digest of seed and key: the same rows on every run,
    however the table is partitioned. Without, it is ``rand(seed)``.
    """
    key = list(key)
    if not key:
        return df.orderBy(F.rand(seed) if seed is not None else F.rand()).limit(require_limit(n))
    require_columns(df, key)
    parts = [F.coalesce(column(c).cast("string"), F.lit("")) for c in key]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed or 0)), *parts))
    return df.orderBy(digest, *[column(c) for c in key]).limit(require_limit(n))
