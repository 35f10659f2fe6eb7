"""The per-product report: totals, daily series, splits, top reviews and sentiment."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from reviewlens.functions.display import shorten
from reviewlens.functions.predicates import column
from reviewlens.operators import reports as R
from reviewlens.operators import sentiment as T
from reviewlens.operators.columns import require_columns, require_limit
from reviewlens.operators.filters import of_product
from reviewlens.schema import REVIEW, ReviewColumns

SCORES = ("sentiment", "confidence")


@dataclass(frozen=True)
class ProductReport:
    """Sections of a report, each a lazy frame; all are empty for an unknown product or an empty range
    (``overall`` then is its one neutral row). ``scored`` has the text as it is displayed."""

    summary: DataFrame
    languages: DataFrame
    daily: DataFrame
    acquisition: DataFrame
    top_upvoted: DataFrame
    top_funny: DataFrame
    top_commented: DataFrame
    scored: DataFrame
    overall: DataFrame
    positive: DataFrame
    negative: DataFrame
    histogram: DataFrame
    cached: tuple[DataFrame, ...] = ()

    def unpersist(self) -> None:
        for frame in self.cached:
            frame.unpersist()

    def __enter__(self) -> ProductReport:
        return self

    def __exit__(self, *_) -> None:
        self.unpersist()


def sentiment_sample(
    df: DataFrame, max_reviews: int | None = None, prefilter: bool = True, cols: ReviewColumns = REVIEW
) -> DataFrame:
    """All reviews, or the ``max_reviews`` most upvoted ones, spread over the session's tasks again."""
    if max_reviews is None:
        return df
    chosen = R.top_rows(df, R.upvote_ranking(require_limit(max_reviews), cols), prefilter, cols)
    return chosen.repartition(df.sparkSession.sparkContext.defaultParallelism)


def scored_list(rows: DataFrame, cols: ReviewColumns = REVIEW) -> DataFrame:
    """Display columns of scored reviews with their funny votes, sentiment and confidence."""
    return R.review_list(rows, cols.upvotes, (cols.funny_votes, *SCORES), cols=cols)


def _shown_columns(df: DataFrame, cols: ReviewColumns, more: tuple[str, ...] = ()) -> DataFrame:
    # What lists and sentiment need: caching freezes columns, so the rest has to go before it.
    names = [
        *cols.key, cols.author, cols.text, cols.upvotes, cols.funny_votes, cols.comments, cols.created,
        cols.playtime, cols.language, *more,
    ]
    require_columns(df, names)
    return df.select(*[column(name) for name in dict.fromkeys(names)])


def scored_for_display(
    df: DataFrame,
    scorer: T.Scorer | None = None,
    stored: bool = False,
    max_reviews: int | None = None,
    cols: ReviewColumns = REVIEW,
) -> DataFrame:
    """Reviews with their scores, whole texts scored, then cut to what is displayed: small enough to keep."""
    if stored and scorer is not None:
        raise ValueError("a table with stored scores takes no scorer")
    sample = sentiment_sample(_shown_columns(df, cols, SCORES if stored else ()), max_reviews, cols=cols)
    scored = sample if stored else T.score_reviews(sample, scorer, cols).drop("raw_scores")
    return scored.withColumn(cols.text, shorten(column(cols.text)))


def product_report(
    df: DataFrame,
    product: str,
    start=None,
    end=None,
    scorer: T.Scorer | None = None,
    max_reviews: int | None = None,
    top: int = R.TOP_REVIEWS,
    persist: bool = True,
    stored: bool = False,
    cols: ReviewColumns = REVIEW,
) -> ProductReport:
    """Everything about one product in a day range.

    The reviews are read narrow for a cube of counts, from which all totals add up, and once for the places of
    the last rows of all lists; with text for the few reviews that enter a list; and once more to be scored.
    What the sections share is cached: the cube, the rows of the lists, each review's scores with its text as
    displayed, and their sums per bucket, so that a model sees each review once whatever the number of sections.

    Every review is scored unless ``max_reviews`` asks for the most upvoted ones only. ``stored`` takes
    the columns ``sentiment`` and ``confidence`` of the table instead; a scorer is then refused.
    """
    reviews = of_product(df, product, start, end, cols)
    shown = _shown_columns(reviews, cols)
    keep = (lambda frame: frame.persist(StorageLevel.MEMORY_AND_DISK)) if persist else (lambda frame: frame)

    upvoted, funny, commented = (
        R.upvote_ranking(top, cols),
        R.funny_ranking(top, cols),
        R.comment_ranking(top, cols),
    )
    scored = keep(scored_for_display(reviews, scorer, stored, max_reviews, cols))
    cube = keep(R.report_cube(reviews, cols))
    parts = keep(T.sentiment_parts(scored))
    rankings = [upvoted, funny, commented]
    leaders = keep(R.ranking_leaders(reviews, rankings, cols)) if persist else None
    candidates = keep(R.ranking_candidates(shown, rankings, cols, leaders))

    return ProductReport(
        summary=R.summary_from_cube(cube),
        languages=R.available_languages(cube),
        daily=R.daily_counts_from_cube(cube),
        acquisition=R.acquisition_split_from_cube(cube),
        top_upvoted=R.top_reviews(candidates, upvoted, False, cols),
        top_funny=R.top_reviews(candidates, funny, False, cols),
        top_commented=R.top_reviews(candidates, commented, False, cols),
        scored=scored,
        overall=T.overall_from_parts(parts),
        positive=scored_list(T.extreme_reviews(scored, True, cols=cols), cols),
        negative=scored_list(T.extreme_reviews(scored, False, cols=cols), cols),
        histogram=T.histogram_from_parts(parts),
        cached=(cube, candidates, scored, parts, leaders) if persist else (),
    )
