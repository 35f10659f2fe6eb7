"""Parts of a per-product report. Input is the product's reviews, as cut by ``filters.of_product``."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from reviewlens.functions.display import acquisition, day, day_text, hours, shorten
from reviewlens.functions.predicates import column
from reviewlens.operators.columns import require_columns, require_limit
from reviewlens.schema import ALL_LANGUAGES, REVIEW, ReviewColumns

TOP_REVIEWS = 100


# ---------------------------------------------------------------- totals


def report_cube(df: DataFrame, cols: ReviewColumns = REVIEW) -> DataFrame:
    """Counts by product, day, language and acquisition, from which every total of a report adds up.

    One narrow scan without the review text. The shuffle carries at most one row per group and map
    task, also for a product that owns a third of the table.
    """
    require_columns(df, [cols.product, cols.created, cols.language, cols.free, cols.playtime, cols.early_access])
    return df.groupBy(
        column(cols.product).alias("game"),
        day(column(cols.created)).alias("review_date"),
        column(cols.language).alias("language"),
        acquisition(column(cols.free)).alias("category"),
    ).agg(
        F.count(F.lit(1)).alias("reviews"),
        F.sum(column(cols.playtime)).alias("playtime_sum"),
        F.count(column(cols.playtime)).alias("playtime_reviews"),
        F.count_if(column(cols.early_access)).alias("early_access_reviews"),
    )


def _summary(grouped, reviews: Column, playtime: Column, early: Column) -> DataFrame:
    totals = grouped.agg(
        reviews.alias("total_reviews"),
        F.coalesce(F.round(playtime, 2), F.lit(0.0)).alias("avg_playtime"),
        early.alias("early_access_count"),
    )
    return totals.select(
        "*",
        hours(F.col("avg_playtime")).alias("avg_playtime_hours"),
        # One division only: a share that is exactly half way then rounds up as it should.
        F.round(F.col("early_access_count") * 100 / F.col("total_reviews"), 1).alias("early_access_percent"),
    )


def summary(df: DataFrame, cols: ReviewColumns = REVIEW) -> DataFrame:
    """One row per product: reviews, mean playtime in minutes and hours, early-access count and share.

    No row when there are no reviews. A playtime known for no review counts as 0.
    """
    require_columns(df, [cols.product, cols.playtime, cols.early_access])
    return _summary(
        df.groupBy(column(cols.product).alias("game")),
        F.count(F.lit(1)),
        F.avg(column(cols.playtime)),
        F.count_if(column(cols.early_access)),
    )


def summary_from_cube(cube: DataFrame) -> DataFrame:
    """:func:`summary` added up from a :func:`report_cube`."""
    return _summary(
        cube.groupBy("game"),
        F.sum("reviews"),
        F.try_divide(F.sum("playtime_sum"), F.sum("playtime_reviews")),
        F.sum("early_access_reviews"),
    )


def _daily(grouped, reviews: Column, newest_first: bool) -> DataFrame:
    counted = grouped.agg(reviews.alias("count"))
    order = F.desc("review_date") if newest_first else F.asc("review_date")
    return counted.orderBy(order).select(day_text(F.col("review_date")).alias("date"), "count")


def daily_counts(df: DataFrame, newest_first: bool = False, cols: ReviewColumns = REVIEW) -> DataFrame:
    """(date, count) for the days that have reviews; reviews without a clock count under a null date."""
    require_columns(df, [cols.created])
    return _daily(df.groupBy(day(column(cols.created)).alias("review_date")), F.count(F.lit(1)), newest_first)


def daily_counts_from_cube(cube: DataFrame, newest_first: bool = False) -> DataFrame:
    return _daily(cube.groupBy("review_date"), F.sum("reviews"), newest_first)


def acquisition_split(df: DataFrame, cols: ReviewColumns = REVIEW) -> DataFrame:
    """(category, count) for Free and Purchased, one row each at most."""
    require_columns(df, [cols.free])
    grouped = df.groupBy(acquisition(column(cols.free)).alias("category"))
    return grouped.agg(F.count(F.lit(1)).alias("count")).orderBy("category")


def acquisition_split_from_cube(cube: DataFrame) -> DataFrame:
    return cube.groupBy("category").agg(F.sum("reviews").alias("count")).orderBy("category")


def available_languages(df: DataFrame, language: str = REVIEW.language) -> DataFrame:
    """Distinct language codes in order, null included and last. Also takes a cube."""
    require_columns(df, [language])
    return df.select(column(language).alias("language")).distinct().orderBy(F.asc_nulls_last("language"))


# ---------------------------------------------------------------- top reviews


@dataclass(frozen=True)
class Ranking:
    """A row-level top-k: by one measure, descending, nulls last, ties by the key, then by all that is shown."""

    measure: str
    k: int = TOP_REVIEWS

    def place(self, df: DataFrame, cols: ReviewColumns) -> Column:
        """Measure and key as one struct that sorts like the ranking, in ascending order."""
        measure = column(self.measure)
        whole = isinstance(df.schema[self.measure].dataType, T.IntegralType)
        parts = [measure.isNull(), F.bitwise_not(measure) if whole else -measure]
        for name in cols.key:
            parts += [column(name).isNull(), column(name)]
        return F.struct(*[part.alias(f"p{i}") for i, part in enumerate(parts)])

    def order(self, df: DataFrame, cols: ReviewColumns) -> list[Column]:
        # Rows that agree in measure and key are told apart by a digest of what a list shows of them.
        shown = [c for c in _shown(cols) if c in df.columns and c not in cols.key and c != self.measure]
        digest = [F.xxhash64(*[column(c) for c in shown])] if shown else []
        keys = [F.asc_nulls_last(column(c)) for c in cols.key]
        return [F.desc_nulls_last(column(self.measure)), *keys, *digest]


def _shown(cols: ReviewColumns) -> list[str]:
    return [
        cols.author, cols.text, cols.upvotes, cols.funny_votes, cols.comments, cols.created, cols.playtime, cols.language,
    ]


def upvote_ranking(k: int = TOP_REVIEWS, cols: ReviewColumns = REVIEW) -> Ranking:
    return Ranking(cols.upvotes, k)


def funny_ranking(k: int = TOP_REVIEWS, cols: ReviewColumns = REVIEW) -> Ranking:
    return Ranking(cols.funny_votes, k)


def comment_ranking(k: int = TOP_REVIEWS, cols: ReviewColumns = REVIEW) -> Ranking:
    return Ranking(cols.comments, k)


# Which ranking a row of ``ranking_leaders`` is first in.
RANKING_NUMBER = "ranking_number"


def ranking_leaders(df: DataFrame, rankings: list[Ranking], cols: ReviewColumns = REVIEW) -> DataFrame:
    """The first rows of every ranking within each task, measures and keys only: one narrow scan for all rankings.

    A task holds the first ``k`` rows so far per ranking, whatever it reads. Kept (cached or written), the rows
    give :func:`ranking_candidates` the places of the last rows without further scans.
    """
    names = list(dict.fromkeys([*[r.measure for r in rankings], *cols.key]))
    require_columns(df, names)
    rows = df.select(*[column(c) for c in names])
    orders = [([(r.measure, "descending"), *[(k, "ascending") for k in cols.key]], require_limit(r.k)) for r in rankings]

    def first_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table | None] = [None] * len(orders)
        for batch in batches:
            new = pa.Table.from_batches([batch])
            for i, (order, k) in enumerate(orders):
                both = new if held[i] is None else pa.concat_tables([held[i], new])
                held[i] = both.take(pc.sort_indices(both, sort_keys=order, null_placement="at_end")[:k])
        for i, table in enumerate(held):
            if table is not None:
                yield from table.add_column(0, RANKING_NUMBER, pa.array([i] * len(table), pa.int32())).to_batches()

    schema = T.StructType([T.StructField(RANKING_NUMBER, T.IntegerType()), *rows.schema.fields])
    return rows.mapInArrow(first_rows, schema)


def _may_rank(df: DataFrame, ranking: Ranking, cols: ReviewColumns, rows: DataFrame | None = None) -> Column:
    # The place of the k-th row comes from a scan of measure and key. Rows behind it are out, also where
    # the measure is flat or unknown. The test of the measure alone says less, but reaches the Parquet scan.
    measure = column(ranking.measure)
    source = df if rows is None else rows
    places = source.select(ranking.place(source, cols).alias("place"), measure.alias("m"))
    last = places.orderBy("place").limit(require_limit(ranking.k)).agg(
        F.max("place").alias("place"), F.min("m").alias("m")
    )
    ahead = ranking.place(df, cols) <= last.select("place").scalar()
    return ((measure >= last.select("m").scalar()) | measure.isNull()) & ahead


def ranking_candidates(
    df: DataFrame, rankings: list[Ranking], cols: ReviewColumns = REVIEW, leaders: DataFrame | None = None
) -> DataFrame:
    """The rows of all ``rankings`` and what ties with their last rows in measure and key: all that has to be read.

    The limits are scalar subqueries, known before the wide scan starts, so Parquet skips row groups
    and pages that hold no candidate. They are taken from the kept ``leaders`` of the same rankings, or else
    from a narrow scan for each.
    """
    require_columns(df, [*cols.key, *[r.measure for r in rankings]])
    own = [None if leaders is None else leaders.where(column(RANKING_NUMBER) == i) for i in range(len(rankings))]
    tests = [_may_rank(df, r, cols, rows) for r, rows in zip(rankings, own, strict=True)]
    return df.where(reduce(lambda left, right: left | right, tests))


def top_rows(df: DataFrame, ranking: Ranking, prefilter: bool = True, cols: ReviewColumns = REVIEW) -> DataFrame:
    """The rows of a ranking, all columns, without a full sort.

    ``prefilter`` finds the k-th measure first; it pays where rows carry text and costs a narrow
    scan. The result is the same.
    """
    require_columns(df, [ranking.measure, *cols.key])
    rows = ranking_candidates(df, [ranking], cols) if prefilter else df
    return rows.orderBy(*ranking.order(rows, cols)).limit(require_limit(ranking.k))


def review_list(
    rows: DataFrame, measure: str, extra: Iterable[str] = (), full_text: bool = False, cols: ReviewColumns = REVIEW
) -> DataFrame:
    """Display columns of reviews: key and author, text cut for display, measure, date, hours, language."""
    extra = list(extra)
    require_columns(
        rows, [cols.author, cols.text, measure, cols.created, cols.playtime, cols.language, *cols.key, *extra]
    )
    text = column(cols.text)
    ids = [c for c in cols.key if c not in (cols.author, cols.created)]
    return rows.select(
        *[column(c) for c in ids],
        column(cols.author).alias("author_id"),
        (text if full_text else shorten(text)).alias("review_text"),
        column(measure),
        day_text(column(cols.created)).alias("date"),
        hours(column(cols.playtime)).alias("playtime_hrs"),
        column(cols.language).alias("language"),
        *[column(c) for c in extra],
    )


def top_reviews(df: DataFrame, ranking: Ranking, prefilter: bool = True, cols: ReviewColumns = REVIEW) -> DataFrame:
    """The display list of a ranking, in order."""
    return review_list(top_rows(df, ranking, prefilter, cols), ranking.measure, cols=cols)


def of_language(df: DataFrame, language: str | None, cols: ReviewColumns = REVIEW) -> DataFrame:
    """Reviews in one language; all of them for ``all`` or no language. The test reaches the scan."""
    require_columns(df, [cols.language])
    return df if not language or language == ALL_LANGUAGES else df.where(column(cols.language) == F.lit(language))


def in_language(
    df: DataFrame, ranking: Ranking, language: str | None, limit: int = 10, cols: ReviewColumns = REVIEW
) -> DataFrame:
    """The first ``limit`` reviews of ``df`` in one language; the whole ranking for ``all`` or no language.

    The language is chosen before the ranking, so a language has its list however rare it is.
    """
    chosen = of_language(df, language, cols)
    return top_rows(chosen, ranking if chosen is df else Ranking(ranking.measure, require_limit(limit)), cols=cols)


def language_match_count(df: DataFrame, language: str | None, cols: ReviewColumns = REVIEW) -> DataFrame:
    """How many of the reviews are in one language, as ``matches``."""
    return of_language(df, language, cols).agg(F.count(F.lit(1)).alias("matches"))
