"""Registered queries over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewlens import oracle as O
from reviewlens.fixtures import DOC_REVIEWS, dirty_reviews, doc_reviews, raw_reviews, sales_reviews, table
from reviewlens.functions import display as D
from reviewlens.functions import sentiment as S
from reviewlens.operators import catalog, cleaning, leaderboards, profiling, reports
from reviewlens.operators import sentiment as T
from reviewlens.operators.columns import drop_columns, require_columns
from reviewlens.operators.filters import between_days, of_product
from reviewlens.plans.cleaning import clean_to_parquet
from reviewlens.plans.engagement import engagement_report, engagement_rows
from reviewlens.plans.product_report import product_report, scored_list
from reviewlens.plans.profile import profile_report
from reviewlens.schema import EXPLORE_CASTS, RAW_SCHEMA, ReviewColumns
from reviewlens.sources.readers import has_rows, read_parquet, read_raw_csv
from reviewlens.sources.scratch import scratch_path
from reviewlens.sources.sinks import YEAR_COLUMN, export, export_one_csv, write_names, write_parquet

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries; the SQL in ``oracle`` uses the same values.
GAME = "click"
SALES_GAME = "42"
SALES_DAYS = (dt.date(1996, 1, 1), dt.date(1998, 12, 31))
DOC_DAYS = (dt.date(2024, 1, 2), dt.date(2024, 1, 3))
LANGUAGE = "de"
SEED = 7
NULL_MARK = "\\N"

QUERIES: dict[str, Query] = {}


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def _typed(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.convert_types(drop_columns(raw_reviews(spark, sf)))


def _game(spark: SparkSession, sf: str, days=(None, None)) -> DataFrame:
    return of_product(doc_reviews(spark, sf), GAME, *days, cols=DOC_REVIEWS)


def _scorer() -> T.Scorer:
    return T.fragment_scorer("en", "on")


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return T.score_reviews(_game(spark, sf), _scorer(), DOC_REVIEWS)


def _score_columns(scored: DataFrame) -> DataFrame:
    return scored.select(
        "review_id",
        F.round("sentiment", 9).alias("sentiment"),
        F.round("confidence", 9).alias("confidence"),
        F.round("raw_scores.negative", 9).alias("negative"),
        F.round("raw_scores.positive", 9).alias("positive"),
    )


# ---------------------------------------------------------------- leaderboards


@register
def top_games(spark, sf):
    return leaderboards.top_products(sales_reviews(spark, sf))


@register
def top_games_dated(spark, sf):
    return leaderboards.top_products(sales_reviews(spark, sf), 20, *SALES_DAYS)


@register
def top_games_since(spark, sf):
    return leaderboards.top_products(sales_reviews(spark, sf), 20, start=SALES_DAYS[0])


@register
def top_games_summary(spark, sf):
    return leaderboards.top_products_summary(leaderboards.top_products(sales_reviews(spark, sf)))


@register
def game_review_counts(spark, sf):
    return leaderboards.product_totals(sales_reviews(spark, sf))


@register
def author_vote_totals(spark, sf):
    return leaderboards.author_totals(sales_reviews(spark, sf))


@register
def top_authors_by_count(spark, sf):
    return leaderboards.top_authors_by_count(sales_reviews(spark, sf), 10, *SALES_DAYS)


@register
def top_authors_by_upvotes(spark, sf):
    return leaderboards.top_authors_by_upvotes(sales_reviews(spark, sf), 10, *SALES_DAYS)


@register
def engagement_all(spark, sf):
    return engagement_rows(sales_reviews(spark, sf), 10, 10, *SALES_DAYS)


@register
def engagement_cached(spark, sf):
    """The boards of a report whose aggregates are cached while it is open, and let go of after it."""
    sales = sales_reviews(spark, sf)
    path = scratch_path(spark, "boards")
    with engagement_report(sales, 10, 10, *SALES_DAYS) as report:
        kept = all(frame.is_cached for frame in report.cached)
        boards = [
            report.top_games.select(F.lit("games").alias("board"), F.col("game").alias("name"), F.col("count").alias("value")),
            report.top_authors_by_count.select(F.lit("reviews"), "author_id", "review_count"),
            report.top_authors_by_upvotes.select(F.lit("upvotes"), "author_id", "total_upvotes"),
        ]
        write_parquet(reduce(DataFrame.unionAll, boards), path)
    released = not any(frame.is_cached for frame in report.cached)
    return read_parquet(spark, path).withColumns({"kept": F.lit(kept), "released": F.lit(released)})


@register
def refused_limits(spark, sf):
    """A board of k rows for usable limits; other limits are refused before anything runs."""
    sales = sales_reviews(spark, sf)
    boards = []
    for k in (3, 50, 0, -1, True, 2.0, "5", None):
        try:
            rows = leaderboards.top_products(sales, k).agg(F.count(F.lit(1)).alias("listed_games"))
        except ValueError:
            rows = sales.limit(1).select(F.lit(None).cast("bigint").alias("listed_games"))
        boards.append(rows.select(F.lit(repr(k)).alias("k"), "listed_games"))
    return reduce(DataFrame.unionAll, boards)


@register
def default_range_totals(spark, sf):
    """The range of a report that names no days, counted back from the newest review."""
    sales = sales_reviews(spark, sf)
    newest = sales.agg(F.max("timestamp_created").cast("date").alias("day")).first().day
    return reports.summary(between_days(sales, *D.default_date_range(newest))).select("game", "total_reviews")


# ---------------------------------------------------------------- cleaning


@register
def drop_columns_schema(spark, sf):
    return drop_columns(raw_reviews(spark, sf))


@register
def clean_cast(spark, sf):
    return _typed(spark, sf)


@register
def explore_cast(spark, sf):
    return cleaning.convert_types(raw_reviews(spark, sf), EXPLORE_CASTS)


@register
def null_audit(spark, sf):
    return cleaning.null_audit(_typed(spark, sf))


@register
def null_audit_raw(spark, sf):
    return cleaning.null_audit_rows(raw_reviews(spark, sf))


@register
def null_audit_nulls_only(spark, sf):
    typed = cleaning.convert_types(raw_reviews(spark, sf), EXPLORE_CASTS)
    return cleaning.null_audit_rows(typed, empty_as_missing=False)


@register
def drop_incomplete(spark, sf):
    return cleaning.drop_incomplete(_typed(spark, sf))


@register
def clean_fractional(spark, sf):
    """Whole numbers written with a fraction keep their rows."""
    raw = raw_reviews(spark, sf)
    return cleaning.clean_reviews(raw.withColumn("votes_up", F.concat("votes_up", F.lit(".0"))))


@register
def lost_in_cast(spark, sf):
    """Per column, the values that were there before the cast and are missing after it."""
    path = scratch_path(spark, "clean")
    report = clean_to_parquet(raw_reviews(spark, sf), path)
    return spark.createDataFrame(sorted(report.lost_in_cast.items()), "column_name string, lost_values bigint")


@register
def drop_report(spark, sf):
    return cleaning.drop_report(_typed(spark, sf))


@register
def drop_one_column(spark, sf):
    return cleaning.drop_missing(raw_reviews(spark, sf), "review")


# ---------------------------------------------------------------- profiling


@register
def null_or_zero_numeric(spark, sf):
    return profiling.null_or_zero_rows(_typed(spark, sf), "votes_funny")


@register
def null_or_zero_string(spark, sf):
    return profiling.null_or_zero_rows(_typed(spark, sf), "review")


@register
def null_or_zero_boolean(spark, sf):
    return profiling.null_or_zero_rows(_typed(spark, sf), "received_for_free")


@register
def null_or_zero_counts(spark, sf):
    return profiling.null_or_zero_counts(_typed(spark, sf))


@register
def null_or_zero_sample(spark, sf):
    typed = cleaning.convert_types(raw_reviews(spark, sf), EXPLORE_CASTS)
    rows = profiling.null_or_zero_rows(typed, "votes_funny")
    return profiling.random_rows(rows, 10, SEED, ["recommendationid"]).select("recommendationid", "votes_funny")


@register
def null_or_zero_random_sample(spark, sf):
    return profiling.random_rows(profiling.null_or_zero_rows(_typed(spark, sf), "votes_funny"), 10, SEED)


@register
def null_or_zero_random_check(spark, sf):
    """What holds for any random sample: its size, and that all its rows are of the kind asked for."""
    typed = cleaning.convert_types(raw_reviews(spark, sf), EXPLORE_CASTS)
    sample = profiling.random_rows(profiling.null_or_zero_rows(typed, "votes_funny"), 10, SEED)
    return sample.agg(
        F.count(F.lit(1)).alias("sampled_rows"),
        F.count_distinct("recommendationid").alias("different_rows"),
        F.count_if(F.col("votes_funny").isNull() | (F.col("votes_funny") == 0)).alias("rows_of_the_kind"),
    )


@register
def column_profile_dirty(spark, sf):
    """Padded text, malformed floats and long language codes, which the plain raw view lacks."""
    dirty = dirty_reviews(spark, sf)
    return profiling.profile_columns(dirty, ["game", "language", "weighted_vote_score"])


@register
def column_profile(spark, sf):
    raw = raw_reviews(spark, sf)
    return profiling.profile_columns(raw, raw.columns)


@register
def column_profile_sketch(spark, sf):
    """Free text by sketch, the rest exact; the sketched distinct count itself is not comparable."""
    raw = raw_reviews(spark, sf)
    profile = profiling.profile_columns(raw, raw.columns, sketch=["review"])
    exact = F.when(F.col("column_name") != "review", F.col("distinct_values"))
    return profile.withColumn("distinct_values", exact)


@register
def column_profile_report(spark, sf):
    """Every section of the profile bundle as rows (section, column_name, value, amount)."""
    raw = raw_reviews(spark, sf)
    report = profile_report(raw, raw.columns, persist=False)

    def rows(section: str, frame: DataFrame, value, amount) -> DataFrame:
        return frame.select(
            F.lit(section).alias("section"), "column_name", value.alias("value"), amount.cast("bigint").alias("amount")
        )

    none = F.lit(None).cast("string")
    parts = [
        rows("distinct", report.counts, none, F.col("distinct_values")),
        rows("blank", report.counts, none, F.col("blank_rows")),
        rows("frequent", report.frequent_values, F.col("value"), F.col("row_count")),
        rows("sample", report.sample_values, F.col("value"), F.col("position")),
        rows("nonconvertible", report.nonconvertible_values, F.col("value"), F.lit(None)),
    ]
    return reduce(DataFrame.unionAll, parts)


@register
def value_frequency(spark, sf):
    return profiling.value_frequency(raw_reviews(spark, sf), "votes_up")


@register
def value_frequency_review(spark, sf):
    """Free text: only the texts of the winners are fetched."""
    return profiling.value_frequency(raw_reviews(spark, sf), "review", free_text=True)


@register
def value_frequency_language(spark, sf):
    return profiling.value_frequency(raw_reviews(spark, sf), "language")


@register
def nonconvertible_values(spark, sf):
    raw = raw_reviews(spark, sf)
    return profiling.nonconvertible_values(raw, raw.columns)


@register
def distinct_sample(spark, sf):
    return profiling.distinct_sample(raw_reviews(spark, sf), "game")


SKETCHED = ("recommendationid", "game", "language", "review", "votes_up")


@register
def distinct_sketch_merge(spark, sf):
    """Sketches stored per game and per author are near the exact counts once merged, however the table was cut."""
    raw = raw_reviews(spark, sf)
    found = []
    for by in ("game", "author_steamid"):
        path = scratch_path(spark, "sketches")
        write_parquet(profiling.distinct_sketches(raw, SKETCHED, [by]), path)
        found.append(profiling.distinct_from_sketches(read_parquet(spark, path)))
    exact = raw.agg(*[F.count_distinct(c).alias(c) for c in SKETCHED]).unpivot([], list(SKETCHED), "column_name", "exact")
    one, other = (f.withColumnsRenamed({"distinct_values": f"d{i}", "known_rows": f"n{i}"}) for i, f in enumerate(found))
    near = lambda c: F.abs(F.col(c) - F.col("exact")) <= F.col("exact") * 0.05 + 1
    return exact.join(one, "column_name").join(other, "column_name").select(
        "column_name",
        F.col("exact").alias("distinct_values"),
        F.col("n0").alias("known_rows"),
        (F.col("n0") == F.col("n1")).alias("same_rows"),
        (near("d0") & near("d1")).alias("near_exact"),
    )


# ---------------------------------------------------------------- catalog


@register
def distinct_games(spark, sf):
    return catalog.product_names(raw_reviews(spark, sf))


@register
def distinct_languages(spark, sf):
    return catalog.language_codes(raw_reviews(spark, sf))


@register
def catalog_counts(spark, sf):
    return catalog.distinct_counts(raw_reviews(spark, sf), "game", "language")


# ---------------------------------------------------------------- product report


@register
def game_summary(spark, sf):
    return reports.summary(_game(spark, sf), DOC_REVIEWS)


@register
def game_summary_dated(spark, sf):
    return reports.summary(_game(spark, sf, DOC_DAYS), DOC_REVIEWS)


@register
def game_summary_sales(spark, sf):
    return reports.summary(of_product(sales_reviews(spark, sf), SALES_GAME, *SALES_DAYS))


@register
def game_summary_all(spark, sf):
    return reports.summary(sales_reviews(spark, sf))


@register
def report_cube(spark, sf):
    cube = reports.report_cube(between_days(sales_reviews(spark, sf), *SALES_DAYS))
    return cube.withColumn("review_date", D.day_text(F.col("review_date")))


@register
def daily_counts(spark, sf):
    return reports.daily_counts(_game(spark, sf), cols=DOC_REVIEWS)


@register
def daily_counts_desc(spark, sf):
    return reports.daily_counts(_game(spark, sf, DOC_DAYS), newest_first=True, cols=DOC_REVIEWS)


@register
def daily_counts_sales(spark, sf):
    return reports.daily_counts(sales_reviews(spark, sf))


@register
def acquisition_split(spark, sf):
    return reports.acquisition_split(_game(spark, sf), DOC_REVIEWS)


@register
def available_languages(spark, sf):
    return reports.available_languages(_game(spark, sf))


@register
def language_display(spark, sf):
    languages = reports.available_languages(raw_reviews(spark, sf))
    name = D.language_name(F.col("language"))
    return languages.select("language", name.alias("display_name"), D.language_code(name).alias("filter_code"))


@register
def language_display_names(spark, sf):
    """Every code of the language dimension by its display name, and back."""
    languages = reports.available_languages(dirty_reviews(spark, sf))
    name = D.language_name(F.col("language"))
    return languages.select("language", name.alias("display_name"), D.language_code(name).alias("filter_code"))


@register
def top_upvoted(spark, sf):
    return reports.top_reviews(_game(spark, sf), reports.upvote_ranking(), cols=DOC_REVIEWS)


@register
def top_funny(spark, sf):
    return reports.top_reviews(_game(spark, sf), reports.funny_ranking(), cols=DOC_REVIEWS)


@register
def top_commented(spark, sf):
    rows = reports.top_reviews(_game(spark, sf, DOC_DAYS), reports.comment_ranking(), cols=DOC_REVIEWS)
    return rows.withColumn("author_short", D.abbreviate_id(F.col("author_id")))


@register
def top_upvoted_by_language(spark, sf):
    ranking = reports.upvote_ranking()
    rows = reports.in_language(_game(spark, sf), ranking, LANGUAGE, cols=DOC_REVIEWS)
    return reports.review_list(rows, ranking.measure, cols=DOC_REVIEWS)


@register
def language_match_count(spark, sf):
    return reports.language_match_count(_game(spark, sf), LANGUAGE, DOC_REVIEWS)


@register
def top_upvoted_without_id(spark, sf):
    """The cleaned layout has no row id: author and clock, then a digest of the row, break ties."""
    rows = of_product(doc_reviews(spark, sf).drop("review_id"), GAME)
    listed = reports.top_reviews(rows, reports.upvote_ranking(20))
    return listed.groupBy("votes_up").agg(F.count(F.lit(1)).alias("listed_reviews"))


@register
def game_report(spark, sf):
    """Every section of the bundle as rows (section, item, amount), to compare it as a whole."""
    path = scratch_path(spark, "report")

    def rows(section: str, frame: DataFrame, item, amount) -> DataFrame:
        return frame.select(
            F.lit(section).alias("section"),
            F.col(item).cast("string").alias("item"),
            F.round(F.col(amount).cast("double"), 6).alias("amount"),
        )

    with product_report(doc_reviews(spark, sf), GAME, *DOC_DAYS, scorer=_scorer(), cols=DOC_REVIEWS) as r:
        parts = [
            rows("total_reviews", r.summary, "game", "total_reviews"),
            rows("avg_playtime", r.summary, "game", "avg_playtime"),
            rows("early_access", r.summary, "game", "early_access_percent"),
            rows("daily", r.daily, "date", "count"),
            rows("acquisition", r.acquisition, "category", "count"),
            rows("top_upvoted", r.top_upvoted, "review_id", "votes_up"),
            rows("top_funny", r.top_funny, "review_id", "votes_funny"),
            rows("top_commented", r.top_commented, "review_id", "comment_count"),
            rows("overall", r.overall, "sentiment_label", "sentiment_score"),
            rows("positive", r.positive, "review_id", "sentiment"),
            rows("negative", r.negative, "review_id", "sentiment"),
            rows("histogram", r.histogram, "bucket", "review_count"),
        ]
        reduce(DataFrame.unionAll, parts).write.parquet(path)
    return spark.read.parquet(path)


# ---------------------------------------------------------------- sentiment


@register
def sentiment_scores(spark, sf):
    return _score_columns(_scored(spark, sf))


@register
def sentiment_scores_all(spark, sf):
    return _score_columns(T.score_reviews(doc_reviews(spark, sf), _scorer(), DOC_REVIEWS))


@register
def sentiment_overall(spark, sf):
    overall = T.overall_sentiment(_scored(spark, sf))
    return overall.withColumn("sentiment_score", F.round("sentiment_score", 9))


@register
def sentiment_label(spark, sf):
    scored = T.score_reviews(doc_reviews(spark, sf), _scorer(), DOC_REVIEWS)
    labelled = scored.groupBy(S.label(F.col("sentiment")).alias("sentiment_label"))
    return labelled.agg(F.count(F.lit(1)).alias("review_count"))


@register
def sentiment_positive(spark, sf):
    return _extremes(scored_list(T.extreme_reviews(_scored(spark, sf), True, cols=DOC_REVIEWS), DOC_REVIEWS))


@register
def sentiment_negative(spark, sf):
    return _extremes(scored_list(T.extreme_reviews(_scored(spark, sf), False, cols=DOC_REVIEWS), DOC_REVIEWS))


def _extremes(listed: DataFrame) -> DataFrame:
    return listed.withColumns({c: F.round(c, 9) for c in ("sentiment", "confidence")})


@register
def sentiment_histogram(spark, sf):
    return T.sentiment_histogram(_scored(spark, sf))


@register
def sentiment_lexicon(spark, sf):
    scorer = T.lexicon_scorer(["le", "de", "the", "und"], ["que", "la", "of", "der"])
    return _score_columns(T.score_reviews(doc_reviews(spark, sf), scorer, DOC_REVIEWS))


@register
def sentiment_plugin(spark, sf):
    """The fragment scorer as a model: its logits are the logs of the two counts."""

    def load():
        import numpy as np

        def logits(texts):
            lowered = [text.lower() for text in texts]
            return np.log([(text.count("on") + 1.0, text.count("en") + 1.0) for text in lowered])

        return logits

    scored = T.score_reviews(doc_reviews(spark, sf), T.classifier_scorer(load), DOC_REVIEWS)
    return _score_columns(scored)


@register
def sentiment_ml(spark, sf):
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF, RegexTokenizer

    labelled = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select(
        "text", F.col("quality").cast("double").alias("label")
    )
    pipeline = Pipeline(
        stages=[
            RegexTokenizer(inputCol="text", outputCol="words", pattern=r"[^\p{L}]+"),
            HashingTF(inputCol="words", outputCol="features", numFeatures=4096),
            LogisticRegression(maxIter=10, regParam=0.01),
        ]
    )
    path = scratch_path(spark, "model")
    pipeline.fit(labelled).save(path)
    scorer = T.ml_scorer(PipelineModel.load(path))
    return _score_columns(T.score_reviews(doc_reviews(spark, sf), scorer, DOC_REVIEWS))


@register
def sentiment_ml_check(spark, sf):
    """What holds for any trained model: all reviews scored, by probabilities."""
    scores = sentiment_ml(spark, sf)
    return scores.agg(
        F.count(F.lit(1)).alias("reviews"),
        F.count_distinct("review_id").alias("different_reviews"),
        F.count_if(F.abs(F.col("negative") + F.col("positive") - 1) < 1e-6).alias("sum_to_one"),
        F.count_if(F.col("negative").between(0, 1) & F.col("positive").between(0, 1)).alias("probabilities"),
    )


# ---------------------------------------------------------------- sources and sinks


@register
def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv")
    export(raw_reviews(spark, sf), path, "csv", null_value=NULL_MARK)
    return read_raw_csv(spark, path, RAW_SCHEMA, null_value=NULL_MARK)


@register
def csv_clean(spark, sf):
    """The documented path of raw data: CSV export, read as text, cleaned."""
    path = scratch_path(spark, "csv")
    export(raw_reviews(spark, sf), path, "csv")
    return cleaning.clean_reviews(read_raw_csv(spark, path))


@register
def csv_shuffled_columns(spark, sf):
    """Columns are found by name: a file with its columns the other way round reads the same."""
    path = scratch_path(spark, "csv")
    raw = raw_reviews(spark, sf)
    export(raw.select(*reversed(raw.columns)), path, "csv", null_value=NULL_MARK)
    return read_raw_csv(spark, path, RAW_SCHEMA, null_value=NULL_MARK)


@register
def required_columns(spark, sf):
    """Which lists of columns the raw table has; the others are refused with the names that are missing."""
    raw, found = raw_reviews(spark, sf), []
    for names in (("game", "review"), ("game", "no_such"), ("nothing", "no_such"), ()):
        try:
            missing = "" if require_columns(raw, names) is raw else None
        except ValueError as error:
            missing = str(error).split("[")[1].split("]")[0].replace("'", "")
        found.append((",".join(names), missing))
    lists = raw.select(F.explode(F.array(*[F.struct(F.lit(a).alias("names"), F.lit(b).alias("missing")) for a, b in found])).alias("x"))
    return lists.groupBy("x.names", "x.missing").agg(F.count(F.lit(1)).alias("raw_rows"))


@register
def tables_with_rows(spark, sf):
    """The empty check, on whole tables and on a product that has no review."""
    frames = {
        "raw": raw_reviews(spark, sf),
        "doc": doc_reviews(spark, sf),
        "sales": sales_reviews(spark, sf),
        "unknown": of_product(doc_reviews(spark, sf), "no such game"),
    }
    return spark.createDataFrame([(name, has_rows(df)) for name, df in frames.items()], "name string, has_rows boolean")


@register
def csv_one_file(spark, sf):
    """One file whose texts hold line breaks and doubled quotes, written at offsets and read in byte ranges by many tasks."""
    path = scratch_path(spark, "csv")
    texts = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.concat(F.lit('"'), F.translate("text", "\r", " "), F.lit('"\n"')).alias("quoted"),
        "text",
    )
    export_one_csv(texts, path, null_value=NULL_MARK)
    read = read_raw_csv(spark, path, "doc_id string, quoted string, text string", null_value=NULL_MARK, split_quoted=True)
    return read.select("doc_id", F.md5("quoted").alias("quoted_md5"), F.md5("text").alias("text_md5"))


@register
def csv_bad_rows(spark, sf):
    """Rows with too many values are set apart, the others read as they are."""
    path = scratch_path(spark, "csv")
    # Unquoted separators in a value make a row too wide; every file has the header.
    extra = F.when(F.col("event_id") % 50 == 0, F.lit(",extra")).otherwise(F.lit(""))
    events = table(spark, sf, "events").select("event_id", F.concat("event_type", extra).alias("event_type"))
    events.write.option("header", True).option("quote", "").csv(path)
    read = read_raw_csv(spark, path, "event_id string, event_type string", corrupt="bad")
    return read.agg(
        F.count_if(F.col("bad").isNull()).alias("good_rows"),
        F.count_if(F.col("bad").isNotNull()).alias("bad_rows"),
        F.count_distinct(F.when(F.col("bad").isNull(), F.col("event_id"))).alias("good_events"),
    )


@register
def parquet_by_year(spark, sf):
    """A table partitioned by the year of one clock, filtered on the other clock: the year plays no part."""
    path = scratch_path(spark, "by-year")
    clean_to_parquet(raw_reviews(spark, sf), path, by_year="timestamp_created")
    cleaned = read_parquet(spark, path).drop(YEAR_COLUMN)
    return between_days(cleaned, *DOC_DAYS, created="timestamp_updated")


@register
def parquet_by_year_pruned(spark, sf):
    path = scratch_path(spark, "by-year")
    clean_to_parquet(raw_reviews(spark, sf), path, by_year="timestamp_created")
    cols = ReviewColumns(created_year=YEAR_COLUMN)
    return leaderboards.product_totals(read_parquet(spark, path), *DOC_DAYS, cols=cols)


@register
def parquet_roundtrip(spark, sf):
    path = scratch_path(spark, "clean")
    clean_to_parquet(raw_reviews(spark, sf), path)
    return read_parquet(spark, path)


@register
def parquet_clustered(spark, sf):
    path = scratch_path(spark, "clustered")
    clean_to_parquet(raw_reviews(spark, sf), path, clustered=True)
    return read_parquet(spark, path)


@register
def names_text_file(spark, sf):
    path = scratch_path(spark, "names")
    write_names(raw_reviews(spark, sf), "game", path)
    return spark.read.text(path).withColumnRenamed("value", "name")


ORACLE_SQL: dict[str, str] = {name: sql for name, sql in O.sql().items() if name in QUERIES}
