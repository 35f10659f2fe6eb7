import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from reviewlens.fixtures import DOC_REVIEWS, doc_reviews
from reviewlens.functions import sentiment as S
from reviewlens.operators import sentiment as T
from reviewlens.schema import ReviewColumns

COLS = ReviewColumns(key=("review_id",))


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "review_id bigint, review string")


def values(spark, expression, *scores):
    df = spark.createDataFrame([(s,) for s in scores], "s double")
    return [row[0] for row in df.select(expression(F.col("s"))).collect()]


def scored(spark, rows):
    return spark.createDataFrame(rows, "review_id bigint, votes_up int, sentiment double, confidence double")


def test_labels_at_the_limits(spark):
    got = values(spark, S.label, 1.0, 0.6, 0.59, 0.2, 0.19, -0.2, -0.21, -0.6, -0.61, -1.0, None)
    assert got == [
        "Very Positive", "Very Positive", "Positive", "Positive", "Mixed", "Mixed", "Negative", "Negative",
        "Very Negative", "Very Negative", None,
    ]


def test_clamp_and_buckets(spark):
    assert values(spark, S.clamp, -3.0, -1.0, 0.3, 2.0) == [-1.0, -1.0, 0.3, 1.0]
    assert values(spark, S.bucket, -1.0, -0.9, -0.8, -0.3, 0.0, 0.7, 0.99, 1.0) == [0, 1, 2, 7, 10, 17, 19, 19]
    assert values(spark, lambda s: S.bucket(s, 4), -1.0, -0.5, 0.0, 0.5, 1.0) == [0, 1, 2, 3, 3]


def test_overall_is_weighted_by_confidence(spark):
    overall = T.overall_sentiment(scored(spark, [(1, 1, 1.0, 0.9), (2, 1, -1.0, 0.6), (3, 1, None, None)]))
    row = overall.first()
    assert abs(row.sentiment_score - 0.2) < 1e-12 and row.analyzed_count == 2
    assert T.overall_sentiment(scored(spark, [])).first() == (0.0, 0, "Mixed")
    assert T.overall_sentiment(scored(spark, [(1, 1, 0.5, 0.0)])).first().sentiment_score == 0.0


def test_extremes_include_their_limits(spark):
    rows = scored(
        spark,
        [(1, 1, 0.2, 1.0), (2, 9, 0.19, 1.0), (3, 5, 0.9, 1.0), (4, 7, -0.2, 1.0), (5, 7, -0.9, 1.0), (6, None, 1.0, 1.0)],
    )
    assert [r.review_id for r in T.extreme_reviews(rows, True, cols=COLS).collect()] == [3, 1, 6]
    assert [r.review_id for r in T.extreme_reviews(rows, False, cols=COLS).collect()] == [4, 5]
    assert [r.review_id for r in T.extreme_reviews(rows, False, 1, prefilter=True, cols=COLS).collect()] == [4]


def test_lexicon_counts_whole_words(spark):
    df = texts(
        spark, "Good, GOOD good!", "goods are bad-ish", "awful... refund", "", None, "no opinion", "good good bad"
    )
    rows = {r.review_id: r for r in T.score_reviews(df, cols=COLS).collect()}
    assert rows[0].raw_scores.positive == 0.8 and abs(rows[0].sentiment - 0.6) < 1e-12
    assert rows[1].raw_scores.positive == pytest.approx(1 / 3)
    assert rows[2].raw_scores.positive == 0.25
    assert rows[3].sentiment == rows[5].sentiment == 0.0 and rows[3].confidence == 0.5
    assert rows[4].sentiment is None and rows[4].confidence is None and rows[4].raw_scores == (None, None)
    assert rows[6].raw_scores.positive == pytest.approx(3 / 5)


def test_whole_text_is_scored(spark):
    df = texts(spark, "x " * 50_000 + "good")
    assert T.score_reviews(df, cols=COLS).first().raw_scores.positive == pytest.approx(2 / 3)


def test_score_columns(spark):
    columns = dict(T.score_reviews(texts(spark, "good"), cols=COLS).dtypes)
    assert columns["raw_scores"] == "struct<negative:double,positive:double>"
    assert columns["sentiment"] == columns["confidence"] == "double"


@pytest.mark.parametrize("partitions", [None, 5])
def test_classifier_softmax_batches_and_nulls(spark, partitions):
    def load():
        def model(batch):
            assert 0 < len(batch) <= 3
            return np.array([[0.0, float(len(text))] for text in batch])

        return model

    scorer = T.classifier_scorer(load, batch_size=3, partitions=partitions)
    df = texts(spark, *["a" * (i % 4) for i in range(20)], None)
    rows = T.score_reviews(df, scorer, COLS).collect()
    assert len(rows) == 21
    for row in rows:
        if row.review is None:
            assert row.raw_scores == (None, None) and row.sentiment is None
        else:
            positive = 1 / (1 + np.exp(-len(row.review)))
            assert row.raw_scores.positive == pytest.approx(positive)
            assert row.sentiment == pytest.approx(2 * positive - 1)
            assert row.confidence == pytest.approx(max(positive, 1 - positive))


def test_classifier_loads_once_per_process(spark):
    loads = spark.sparkContext.accumulator(0)

    def load():
        loads.add(1)

        def model(batch):
            return np.zeros((len(batch), 2))

        return model

    df = texts(spark, *["text"] * 100).repartition(12)
    result = T.score_reviews(df, T.classifier_scorer(load), COLS)
    assert T.overall_sentiment(result.where("sentiment >= -0.5 and confidence > 0.4")).first().analyzed_count == 100
    assert 1 <= loads.value <= 4  # twelve tasks in at most four processes


def test_pipeline_scorer_keeps_the_columns_it_gets(spark, tmp_path):
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF, Tokenizer

    train = spark.createDataFrame([("good fun", 1.0), ("bad bad", 0.0)] * 5, "text string, label double")
    stages = [
        Tokenizer(inputCol="text", outputCol="words"),
        HashingTF(inputCol="words", outputCol="features", numFeatures=64),
        LogisticRegression(maxIter=5),
    ]
    Pipeline(stages=stages).fit(train).save(str(tmp_path / "model"))
    model = PipelineModel.load(str(tmp_path / "model"))
    rows = [("good", 1, "w"), ("bad", 2, None), (None, 3, "w")]
    df = spark.createDataFrame(rows, "text string, label int, words string")
    scored = T.score_reviews(df, T.ml_scorer(model), ReviewColumns(text="text"))
    assert scored.columns == [*df.columns, "raw_scores", "sentiment", "confidence"]
    good, bad, unknown = scored.orderBy("label").collect()
    assert good.sentiment > 0.5 > -0.5 > bad.sentiment
    assert (unknown.text, unknown.sentiment, unknown.raw_scores) == (None, None, (None, None))


def test_failing_model_fails_the_job(spark):
    def load():
        def model(batch):
            raise RuntimeError("model is broken")

        return model

    with pytest.raises(Exception, match="model is broken"):
        T.score_reviews(texts(spark, "a"), T.classifier_scorer(load), COLS).collect()


def test_histogram_sums_to_scored_reviews(spark):
    rows = T.score_reviews(doc_reviews(spark, SMALL), T.fragment_scorer("en", "on"), DOC_REVIEWS)
    histogram = T.sentiment_histogram(rows).collect()
    assert sum(r.review_count for r in histogram) == rows.count()
    assert all(r.bucket_start == pytest.approx(r.bucket / 10 - 1) for r in histogram)
    assert T.sentiment_histogram(rows.limit(0)).collect() == []
    low, high = rows.agg(F.min("sentiment"), F.max("sentiment")).first()
    assert low <= T.overall_sentiment(rows).first().sentiment_score <= high
