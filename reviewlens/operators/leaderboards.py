"""Top products and authors.

Every ranking ends in the key, so ties have one answer. Counts are combined before the shuffle, which
carries one row per key and map task however hot a key is, and top-k keeps k rows per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from reviewlens.functions.predicates import column
from reviewlens.operators.columns import require_columns, require_limit
from reviewlens.operators.filters import between_days
from reviewlens.schema import REVIEW, ReviewColumns


def product_totals(df: DataFrame, start=None, end=None, cols: ReviewColumns = REVIEW) -> DataFrame:
    """(game, count): reviews per product; a null product is a group of its own."""
    require_columns(df, [cols.product])
    rows = between_days(df, start, end, cols.created, cols.created_year)
    return rows.groupBy(column(cols.product).alias("game")).agg(F.count(F.lit(1)).alias("count"))


def author_totals(df: DataFrame, start=None, end=None, cols: ReviewColumns = REVIEW) -> DataFrame:
    """(author_id, total_upvotes, review_count): unknown votes add nothing, their reviews count."""
    require_columns(df, [cols.author, cols.upvotes])
    rows = between_days(df, start, end, cols.created, cols.created_year)
    return rows.groupBy(column(cols.author).alias("author_id")).agg(
        F.sum(column(cols.upvotes)).alias("total_upvotes"),
        F.count(F.lit(1)).alias("review_count"),
    )


def product_order() -> list[Column]:
    return [F.desc("count"), F.asc_nulls_last("game")]


def author_count_order() -> list[Column]:
    return [F.desc("review_count"), F.asc_nulls_last("author_id")]


def author_upvote_order() -> list[Column]:
    return [F.desc_nulls_last("total_upvotes"), F.asc_nulls_last("author_id")]


def top_products(df: DataFrame, k: int = 10, start=None, end=None, cols: ReviewColumns = REVIEW) -> DataFrame:
    """The ``k`` products with most reviews: (game, count)."""
    return product_totals(df, start, end, cols).orderBy(*product_order()).limit(require_limit(k))


def top_authors_by_count(df: DataFrame, k: int = 10, start=None, end=None, cols: ReviewColumns = REVIEW) -> DataFrame:
    """The ``k`` authors with most reviews: (author_id, review_count)."""
    require_columns(df, [cols.author])
    rows = between_days(df, start, end, cols.created, cols.created_year)
    totals = rows.groupBy(column(cols.author).alias("author_id")).agg(F.count(F.lit(1)).alias("review_count"))
    return totals.orderBy(*author_count_order()).limit(require_limit(k))


def top_authors_by_upvotes(df: DataFrame, k: int = 10, start=None, end=None, cols: ReviewColumns = REVIEW) -> DataFrame:
    """The ``k`` authors with most upvotes: (author_id, total_upvotes, review_count)."""
    return author_totals(df, start, end, cols).orderBy(*author_upvote_order()).limit(require_limit(k))


def top_products_summary(top: DataFrame) -> DataFrame:
    """First product, its count and the truncated mean count of a :func:`top_products` result."""
    # A null name sorts last in the ranking, and so it does here.
    first = F.struct(-F.col("count"), F.col("game").isNull(), F.col("game"))
    return top.agg(
        F.min_by("game", first).alias("most_reviewed_game"),
        F.max("count").alias("most_reviews"),
        F.floor(F.avg("count")).alias("average_reviews"),
    )


def with_position(top: DataFrame, order: list[Column]) -> DataFrame:
    """Number the rows of a top-k result from 1. Only for results already cut to k rows."""
    return top.withColumn("position", F.row_number().over(Window.orderBy(*order)))
