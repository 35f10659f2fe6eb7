"""Sentiment of review text as a distributed job with a pluggable scorer.

A scorer is a function (df, text column, output column) -> df that adds the output column as
``struct<negative: double, positive: double>``, the probabilities of the two classes; both are null
for a null text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from reviewlens.functions import sentiment as S
from reviewlens.functions.predicates import column
from reviewlens.operators.columns import require_columns, require_limit
from reviewlens.operators.reports import top_rows, upvote_ranking
from reviewlens.schema import REVIEW, ReviewColumns

Scorer = Callable[[DataFrame, str, str], DataFrame]

SCORES_TYPE = "struct<negative:double,positive:double>"
EXTREME_REVIEWS = 10
BATCH_SIZE = 32

# A small English opinion lexicon: the default scorer's parameters, to be replaced for other languages.
POSITIVE_WORDS = (
    "amazing", "awesome", "beautiful", "best", "brilliant", "enjoy", "enjoyable", "enjoyed", "excellent",
    "fantastic", "fun", "good", "great", "incredible", "like", "love", "loved", "masterpiece", "nice",
    "perfect", "recommend", "recommended", "solid", "superb", "wonderful", "worth",
)
NEGATIVE_WORDS = (
    "annoying", "awful", "bad", "boring", "broken", "buggy", "crash", "crashes", "disappointed",
    "disappointing", "dull", "frustrating", "garbage", "hate", "horrible", "laggy", "mess", "poor",
    "refund", "terrible", "trash", "ugly", "unplayable", "useless", "waste", "worst",
)


# ---------------------------------------------------------------- scorers


def word_count(text: Column, words: Iterable[str]) -> Column:
    """Occurrences of any of ``words`` as whole words (letters and digits); ``text`` is lower case already."""
    tokens = F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    return F.size(F.filter(tokens, lambda token: token.isin(sorted(set(words)))))


def fragment_count(text: Column, fragment: str) -> Column:
    """Occurrences of one fragment anywhere, left to right without overlap: what is missing without it."""
    if not fragment:
        raise ValueError("an empty fragment is everywhere")
    without = F.octet_length(F.replace(text, F.lit(fragment), F.lit("")))
    return ((F.octet_length(text) - without) / F.lit(len(fragment.encode()))).cast("int")


def evaluated_once(value: Column) -> Column:
    """``value`` behind a barrier for the optimizer: what reads the result reads a finished value.

    Without it a scorer made of plain expressions is copied into every filter, sort key and projection above
    it, and filters on its result move below joins. No task has a negative number, but the optimizer has to take
    the number for one that differs wherever it is asked for.
    """
    return F.when(F.spark_partition_id() >= 0, value)


def smoothed_scores(positive: Column, negative: Column) -> Column:
    """Class probabilities from two counts: p(positive) = (positive + 1) / (positive + negative + 2)."""
    p = ((positive + F.lit(1.0)) / (positive + negative + F.lit(2.0))).cast("double")
    return F.struct((F.lit(1.0) - p).alias("negative"), p.alias("positive"))


def _from_counts(df: DataFrame, output: str, positive: Column, negative: Column) -> DataFrame:
    # The scores use each count several times, so the counts are what is evaluated once.
    counts = F.struct(positive.alias("positive"), negative.alias("negative"))
    counted = df.withColumn(output, evaluated_once(counts))
    return counted.withColumn(output, smoothed_scores(column(output)["positive"], column(output)["negative"]))


def lexicon_scorer(
    positive: Iterable[str] = POSITIVE_WORDS, negative: Iterable[str] = NEGATIVE_WORDS
) -> Scorer:
    """Counts whole words of two lists over the whole text, inside Catalyst."""
    positive, negative = tuple(positive), tuple(negative)

    def score(df: DataFrame, text: str, output: str) -> DataFrame:
        lowered = F.lower(column(text))
        return _from_counts(df, output, word_count(lowered, positive), word_count(lowered, negative))

    return score


def fragment_scorer(positive: str, negative: str) -> Scorer:
    """Counts two fragments over the whole text, inside Catalyst."""

    def score(df: DataFrame, text: str, output: str) -> DataFrame:
        lowered = F.lower(column(text))
        return _from_counts(df, output, fragment_count(lowered, positive), fragment_count(lowered, negative))

    return score


# Models that a worker process keeps: as many as the scorers that one job may well use side by side.
KEPT_MODELS = 4
_models: dict[str, Callable] = {}


def loaded(name: str, load: Callable[[], Callable]) -> Callable:
    """The model of a scorer, loaded once per worker process; beyond ``KEPT_MODELS`` the one longest unused goes."""
    model = _models.pop(name) if name in _models else load()
    _models[name] = model
    while len(_models) > KEPT_MODELS:
        del _models[next(iter(_models))]
    return model


def classifier_scorer(
    load: Callable[[], Callable[[list[str]], np.ndarray]],
    batch_size: int = BATCH_SIZE,
    partitions: int | None = None,
) -> Scorer:
    """Runs a two-class text model on the executors.

    ``load`` runs once per worker process and returns a function from texts to logits of shape (texts, 2),
    negative first, that are turned into probabilities by softmax; tokenising is the model's part.
    Only the text crosses to Python. Batches hold up to ``batch_size`` texts. ``partitions`` spreads a small
    input, such as a top-k sample that sits in one task, over that many tasks.
    """
    require_limit(batch_size)
    name = uuid.uuid4().hex

    def probabilities(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = loaded(name, load)
        for texts in batches:
            scores = np.full((len(texts), 2), np.nan)
            known = np.flatnonzero(texts.notna().to_numpy())
            for at in range(0, len(known), batch_size):
                rows = known[at : at + batch_size]
                logits = np.asarray(model(texts.iloc[rows].tolist()), dtype="float64")
                weights = np.exp(logits - logits.max(axis=1, keepdims=True))
                scores[rows] = weights / weights.sum(axis=1, keepdims=True)
            yield pd.DataFrame({"negative": scores[:, 0], "positive": scores[:, 1]})

    # Nondeterministic for the optimizer: filters above must not run the model a second time.
    run = F.pandas_udf(probabilities, SCORES_TYPE).asNondeterministic()

    def score(df: DataFrame, text: str, output: str) -> DataFrame:
        rows = df if partitions is None else df.repartition(require_limit(partitions))
        return rows.withColumn(output, run(column(text)))

    return score


def ml_scorer(model, input_column: str = "text", probability: str = "probability") -> Scorer:
    """Applies a fitted two-class Spark ML pipeline that reads ``input_column`` and writes ``probability``.

    Load the pipeline from storage: right after fitting, a model may still hold its session through
    its training summary, which Spark cannot send to tasks once the session has observed a write.
    """
    from pyspark.ml.functions import vector_to_array

    def score(df: DataFrame, text: str, output: str) -> DataFrame:
        # The review travels as one struct, so that no column of it clashes with the pipeline's.
        inputs = df.select(
            F.struct(*[column(c) for c in df.columns]).alias("scored_review"),
            F.coalesce(column(text), F.lit("")).alias(input_column),
        )
        known = F.col("scored_review")[text].isNotNull()
        p = F.when(known, vector_to_array(column(probability)))
        scores = F.struct(p[0].alias("negative"), p[1].alias("positive"))
        return model.transform(inputs).select("scored_review.*", scores.alias(output))

    return score


# ---------------------------------------------------------------- scored reviews


def score_reviews(df: DataFrame, scorer: Scorer | None = None, cols: ReviewColumns = REVIEW) -> DataFrame:
    """``df`` with ``sentiment``, ``confidence`` and ``raw_scores``. Narrow: no shuffle, no join.

    Each review is scored once, whatever reads the scores. Filter reviews before they are scored: a filter above
    the scores stays above them.
    """
    require_columns(df, [cols.text])
    scored = (scorer or lexicon_scorer())(df, cols.text, "raw_scores")
    scores = F.col("raw_scores")
    return scored.withColumns({"sentiment": S.sentiment_score(scores), "confidence": S.confidence(scores)})


def overall_sentiment(scored: DataFrame) -> DataFrame:
    """One row: confidence-weighted mean, its label, and the number of scored reviews."""
    totals = scored.agg(
        S.weighted_mean(F.col("sentiment"), F.col("confidence")).alias("sentiment_score"),
        F.count("sentiment").alias("analyzed_count"),
    )
    return totals.withColumn("sentiment_label", S.label(S.clamp(F.col("sentiment_score"))))


def extreme_reviews(
    scored: DataFrame,
    positive: bool = True,
    count: int = EXTREME_REVIEWS,
    prefilter: bool = False,
    cols: ReviewColumns = REVIEW,
) -> DataFrame:
    """The most upvoted positive (or negative) reviews; the limits themselves belong to both sides.

    ``prefilter`` as in ``reports.top_rows``: for stored scores, since it would run a model twice.
    """
    require_columns(scored, ["sentiment", cols.upvotes, *cols.key])
    test = S.is_positive if positive else S.is_negative
    ranking = upvote_ranking(require_limit(count), cols)
    return top_rows(scored.where(test(F.col("sentiment"))), ranking, prefilter, cols)


def sentiment_histogram(scored: DataFrame, bins: int = S.HISTOGRAM_BINS) -> DataFrame:
    """(bucket, bucket_start, review_count) over [-1, 1]; empty buckets have no row."""
    return histogram_from_parts(sentiment_parts(scored, bins), bins)


def sentiment_parts(scored: DataFrame, bins: int = S.HISTOGRAM_BINS) -> DataFrame:
    """Sums per bucket, from which the histogram and the overall score add up: one scan for both."""
    value, weight = F.col("sentiment"), F.col("confidence")
    bucket = S.bucket(value, require_limit(bins)).alias("bucket")
    return scored.where(value.isNotNull()).groupBy(bucket).agg(
        F.count(F.lit(1)).alias("review_count"),
        F.sum(value * weight).alias("weighted"),
        F.sum(weight).alias("weight"),
    )


def histogram_from_parts(parts: DataFrame, bins: int = S.HISTOGRAM_BINS) -> DataFrame:
    start = F.round(F.col("bucket") * F.lit(2.0 / bins) - F.lit(1.0), 9)
    return parts.orderBy("bucket").select("bucket", start.alias("bucket_start"), "review_count")


def overall_from_parts(parts: DataFrame) -> DataFrame:
    """:func:`overall_sentiment` added up from :func:`sentiment_parts`."""
    totals = parts.agg(
        F.coalesce(F.try_divide(F.sum("weighted"), F.sum("weight")), F.lit(0.0)).alias("sentiment_score"),
        F.coalesce(F.sum("review_count"), F.lit(0)).cast("bigint").alias("analyzed_count"),
    )
    return totals.withColumn("sentiment_label", S.label(S.clamp(F.col("sentiment_score"))))
