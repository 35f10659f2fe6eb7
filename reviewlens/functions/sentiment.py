"""Sentiment arithmetic on class probabilities, and the labels and buckets made from it."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Class limits, labels and histogram shape (fixed values). Each limit belongs to the upper class.
LABELS = ((0.6, "Very Positive"), (0.2, "Positive"), (-0.2, "Mixed"), (-0.6, "Negative"))
LOWEST_LABEL = "Very Negative"
POLARITY_LIMIT = 0.2
HISTOGRAM_BINS = 20


def sentiment_score(scores: Column) -> Column:
    """p(positive) - p(negative), in [-1, 1]."""
    return scores["positive"] - scores["negative"]


def confidence(scores: Column) -> Column:
    """Probability of the likelier class."""
    return F.greatest(scores["negative"], scores["positive"])


def clamp(score: Column) -> Column:
    return F.greatest(F.least(score, F.lit(1.0)), F.lit(-1.0))


def label(score: Column) -> Column:
    """Five-class label; null for a null score."""
    result = F.when(score.isNull(), F.lit(None).cast("string"))
    for limit, name in LABELS:
        result = result.when(score >= limit, F.lit(name))
    return result.otherwise(F.lit(LOWEST_LABEL))


def is_positive(score: Column) -> Column:
    return score >= POLARITY_LIMIT


def is_negative(score: Column) -> Column:
    return score <= -POLARITY_LIMIT


def bucket(score: Column, bins: int = HISTOGRAM_BINS) -> Column:
    """Number of the equal-width bin over [-1, 1], 0 to ``bins - 1``; 1.0 falls into the last bin.

    The position is rounded to 9 decimals first: -0.8 + 1 is a hair below 0.2 in binary.
    """
    position = F.round((clamp(score) + F.lit(1.0)) * F.lit(bins / 2.0), 9)
    return F.least(F.floor(position), F.lit(bins - 1).cast("bigint")).cast("int")


def weighted_mean(value: Column, weight: Column) -> Column:
    """sum(value * weight) / sum(weight); 0.0 for no rows or no weight."""
    return F.coalesce(F.try_divide(F.sum(value * weight), F.sum(weight)), F.lit(0.0))
