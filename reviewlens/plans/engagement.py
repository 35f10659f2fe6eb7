"""The engagement report: three leaderboards over one day range."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from reviewlens.operators import leaderboards as L
from reviewlens.operators.columns import require_columns, require_limit
from reviewlens.schema import REVIEW, ReviewColumns


@dataclass(frozen=True)
class EngagementReport:
    top_games: DataFrame
    top_authors_by_count: DataFrame
    top_authors_by_upvotes: DataFrame
    summary: DataFrame
    cached: tuple[DataFrame, ...] = ()

    def unpersist(self) -> None:
        for frame in self.cached:
            frame.unpersist()

    def __enter__(self) -> EngagementReport:
        return self

    def __exit__(self, *_) -> None:
        self.unpersist()


def _check(df: DataFrame, cols: ReviewColumns) -> None:
    require_columns(df, [cols.product, cols.author, cols.upvotes, cols.created])


def engagement_report(
    df: DataFrame,
    games_k: int = 10,
    authors_k: int = 10,
    start=None,
    end=None,
    persist: bool = True,
    cols: ReviewColumns = REVIEW,
) -> EngagementReport:
    """Top products, top authors by reviews and by upvotes, and the summary of the top products.

    The table is read twice in all, each time narrow: product and clock, then author, votes and clock.
    What several sections share is cached after aggregation, one row per product or author, never the
    reviews. Leave the ``with`` block, or call ``unpersist``, when done.
    """
    _check(df, cols)
    authors = L.author_totals(df, start, end, cols)
    top_games = L.top_products(df, games_k, start, end, cols)
    cached: tuple[DataFrame, ...] = ()
    if persist:
        cached = (authors.persist(StorageLevel.MEMORY_AND_DISK), top_games.persist(StorageLevel.MEMORY_AND_DISK))
    by_count = authors.orderBy(*L.author_count_order()).limit(require_limit(authors_k))
    by_upvotes = authors.orderBy(*L.author_upvote_order()).limit(require_limit(authors_k))
    return EngagementReport(
        top_games,
        by_count.select("author_id", "review_count"),
        by_upvotes,
        L.top_products_summary(top_games),
        cached,
    )


def engagement_rows(
    df: DataFrame, games_k: int = 10, authors_k: int = 10, start=None, end=None, cols: ReviewColumns = REVIEW
) -> DataFrame:
    """The three leaderboards as one long table: (metric, position, key, measure, value).

    Both author boards keep the same aggregate, so Spark reuses its shuffle and reads the authors once.
    """
    _check(df, cols)
    games = L.product_totals(df, start, end, cols)
    authors = L.author_totals(df, start, end, cols)
    author_measures = ("review_count", "total_upvotes")
    boards = (
        ("top_games", games, "game", L.product_order(), games_k, ("count",)),
        ("top_authors_by_count", authors, "author_id", L.author_count_order(), authors_k, author_measures),
        ("top_authors_by_upvotes", authors, "author_id", L.author_upvote_order(), authors_k, author_measures),
    )
    parts = []
    for metric, totals, key, order, k, measures in boards:
        top = L.with_position(totals.orderBy(*order).limit(require_limit(k)), order)
        board = top.select(
            F.lit(metric).alias("metric"), "position", F.col(key).cast("string").alias("key"), *measures
        )
        parts.append(board.unpivot(["metric", "position", "key"], list(measures), "measure", "value"))
    return reduce(DataFrame.unionAll, parts)
