"""Empty, hot and streaming input."""

import threading

from pyspark.sql import functions as F

from conftest import SMALL
from reviewlens.fixtures import raw_reviews
from reviewlens.operators import cleaning, leaderboards, profiling, reports
from reviewlens.operators import sentiment as T
from reviewlens.plans.cleaning import clean_to_parquet
from reviewlens.schema import RAW_SCHEMA, ReviewColumns
from reviewlens.sources.sinks import write_parquet


def test_cleaning_nothing_ends(spark, tmp_path):
    raw = raw_reviews(spark, SMALL)
    empty = [raw.limit(0), raw.where(F.lit(False)), spark.createDataFrame([], RAW_SCHEMA)]
    reports_found = []

    def run():
        for i, df in enumerate(empty):
            reports_found.append(clean_to_parquet(df, str(tmp_path / f"empty{i}")))

    job = threading.Thread(target=run, daemon=True)
    job.start()
    job.join(120)
    assert [(r.rows_before, r.rows_after, r.rows_dropped) for r in reports_found] == [(0, 0, 0)] * 3
    assert all(set(r.missing_before.values()) == {0} for r in reports_found)


def hot(spark, rows=60_000):
    """A third of the rows belong to one product, one author, one value and one day."""
    one = F.col("id") % 3 == 0
    return spark.range(0, rows, 1, 6).select(
        F.col("id").alias("review_id"),
        F.when(one, F.lit("hot")).otherwise(F.concat(F.lit("g"), F.col("id") % 1000)).alias("game"),
        F.when(one, F.lit("u")).otherwise(F.concat(F.lit("u"), F.col("id") % 1700)).alias("author_steamid"),
        F.when(one, F.lit(0)).otherwise(F.col("id") % 50).cast("int").alias("votes_up"),
        F.timestamp_seconds(F.when(one, F.lit(0)).otherwise(F.col("id") * 60)).alias("timestamp_created"),
        F.lit("english").alias("language"),
        F.lit(60).alias("author_playtime_at_review"),
        F.lit(None).cast("boolean").alias("received_for_free"),
        one.alias("written_during_early_access"),
        F.when(one, F.lit("good")).otherwise(F.lit("bad")).alias("review"),
    )


def test_hot_keys_are_counted_in_full(spark):
    df = hot(spark)
    assert leaderboards.top_products(df, 1).collect() == [("hot", 20_000)]
    assert leaderboards.top_authors_by_count(df, 1).collect() == [("u", 20_000)]
    assert reports.summary_from_cube(reports.report_cube(df.where("game = 'hot'"))).collect() == [
        ("hot", 20_000, 60.0, 20_000, 1.0, 100.0)
    ]
    assert profiling.value_frequency(df, "review").collect() == [("bad", 40_000), ("good", 20_000)]
    histogram = T.sentiment_histogram(T.score_reviews(df)).collect()
    assert [(r.bucket, r.review_count) for r in histogram] == [(6, 40_000), (13, 20_000)]


def test_a_ranking_of_ties_is_decided_by_the_key(spark):
    # All votes of the hot product are equal: every row ties with the last place of the list.
    cols = ReviewColumns(key=("review_id",))
    top = reports.top_rows(hot(spark).where("game = 'hot'"), reports.upvote_ranking(5, cols), cols=cols)
    assert [row.review_id for row in top.collect()] == [0, 3, 6, 9, 12]


def test_row_operators_take_streams(spark, tmp_path):
    path = str(tmp_path / "raw")
    write_parquet(raw_reviews(spark, SMALL), path)
    batch = T.score_reviews(cleaning.clean_reviews(spark.read.parquet(path)))
    stream = T.score_reviews(cleaning.clean_reviews(spark.readStream.schema(RAW_SCHEMA).parquet(path)))
    query = stream.writeStream.format("memory").queryName("scored").trigger(availableNow=True).start()
    try:
        assert query.awaitTermination(120)
        streamed = spark.table("scored")
        assert streamed.schema == stream.schema
        assert streamed.exceptAll(batch.select(streamed.columns)).isEmpty() and streamed.count() == batch.count() == 84
    finally:
        query.stop()
