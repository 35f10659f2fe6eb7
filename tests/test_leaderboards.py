import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from conftest import SMALL
from reviewlens.fixtures import sales_reviews
from reviewlens.functions.display import default_date_range
from reviewlens.operators import leaderboards
from reviewlens.operators.filters import between_days
from reviewlens.plans.engagement import engagement_report, engagement_rows
from reviewlens.schema import ReviewColumns
from reviewlens.sources.sinks import with_review_year, write_parquet

SCHEMA = "game string, author_steamid string, votes_up int, timestamp_created timestamp"


def reviews(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def at(day, hour=0, minute=0, second=0):
    return dt.datetime(2024, 1, day, hour, minute, second)


def sample(spark):
    return reviews(
        spark,
        [
            ("b", "u1", 5, at(1)),
            ("b", "u2", None, at(2, 23, 59, 59)),
            ("a", "u1", 1, at(2)),
            ("a", "u3", 6, at(3)),
            (None, "u3", None, at(3)),
            ("c", None, 2, None),
        ],
    )


def test_ties_and_null_keys(spark):
    assert leaderboards.top_products(sample(spark)).collect() == [("a", 2), ("b", 2), ("c", 1), (None, 1)]
    assert leaderboards.top_authors_by_count(sample(spark)).collect() == [
        ("u1", 2), ("u3", 2), ("u2", 1), (None, 1),
    ]


def test_unknown_votes_add_nothing(spark):
    assert leaderboards.top_authors_by_upvotes(sample(spark)).collect() == [
        ("u1", 6, 2), ("u3", 6, 2), (None, 2, 1), ("u2", None, 1),
    ]


@pytest.mark.parametrize(
    "start, end, rows",
    [
        (None, None, 6),
        (dt.date(2024, 1, 2), dt.date(2024, 1, 2), 2),
        (dt.datetime(2024, 1, 2, 18), dt.datetime(2024, 1, 2, 1), 2),
        ("2024-01-02", None, 4),
        (None, "2024-01-02", 3),
        ("2024-01-03", "2024-01-01", 0),
    ],
)
def test_day_ranges_are_inclusive(spark, start, end, rows):
    for zone_type in ("timestamp", "timestamp_ntz"):
        df = sample(spark).selectExpr("*", f"cast(timestamp_created as {zone_type}) as clock")
        assert between_days(df, start, end, "clock").count() == rows
    days = sample(spark).selectExpr("cast(timestamp_created as date) as day")
    assert between_days(days, start, end, "day").count() == rows


def test_day_range_follows_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    df = sample(spark).cache()
    df.count()
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        days = df.selectExpr("to_date(timestamp_created) as day").where("day = date'2024-01-01'").count()
        assert between_days(df, "2024-01-01", "2024-01-01").count() == days == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
        df.unpersist()


def test_default_range():
    # 1825 days, not five calendar years: two leap days lie in between.
    assert default_date_range(dt.date(2024, 12, 31)) == (dt.date(2020, 1, 2), dt.date(2024, 12, 31))


def test_years_are_pruned_and_results_stay(spark, tmp_path):
    df = sales_reviews(spark, SMALL)
    path = str(tmp_path / "by_year")
    write_parquet(with_review_year(df), path, partition_by=["review_year"])
    stored = spark.read.parquet(path)
    days = (dt.date(1997, 1, 1), dt.date(1997, 12, 31))
    pruned = leaderboards.top_products(stored, 50, *days, cols=ReviewColumns(created_year="review_year"))
    assert pruned.collect() == leaderboards.top_products(df, 50, *days).collect()
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "review_year" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert leaderboards.top_products(stored, 50, *days).collect() == pruned.collect()


def test_a_year_column_counts_only_where_it_is_bound(spark):
    df = spark.createDataFrame([("g", dt.datetime(2023, 5, 1), 2019)], "game string, timestamp_created timestamp, review_year int")
    assert leaderboards.top_products(df, 1, "2023-01-01", "2023-12-31").count() == 1
    cols = ReviewColumns(created_year="review_year")
    assert leaderboards.top_products(df, 1, "2023-01-01", "2023-12-31", cols).count() == 0


def test_summary(spark):
    top = leaderboards.top_products(sample(spark), 3)
    assert leaderboards.top_products_summary(top).first() == ("a", 2, 1)
    assert leaderboards.top_products_summary(top.limit(0)).first() == (None, None, None)


@pytest.mark.parametrize("k", [0, -1, 2.5, True, "10"])
def test_limits_are_checked(spark, k):
    with pytest.raises(ValueError):
        leaderboards.top_products(sample(spark), k)


def test_missing_columns(spark):
    with pytest.raises(ValueError, match="author_steamid"):
        leaderboards.top_authors_by_count(sample(spark).drop("author_steamid"))
    with pytest.raises(ValueError, match="votes_up"):
        engagement_report(sample(spark).drop("votes_up"))
    with pytest.raises(ValueError, match="timestamp_created"):
        leaderboards.top_products(sample(spark).drop("timestamp_created"), start="2024-01-01")
    assert leaderboards.top_products(sample(spark).select("game")).count() == 4


def test_other_column_names(spark):
    cols = ReviewColumns(product="title", author="user", upvotes="likes", created="posted")
    df = sample(spark).toDF("title", "user", "likes", "posted")
    assert leaderboards.top_products(df, cols=cols).collect() == leaderboards.top_products(sample(spark)).collect()


@pytest.mark.parametrize("persist", [True, False])
def test_report_equals_its_parts(spark, persist):
    df = sales_reviews(spark, SMALL)
    days = ("1996-01-01", "1998-12-31")
    with engagement_report(df, 7, 5, *days, persist=persist) as report:
        assert report.top_games.collect() == leaderboards.top_products(df, 7, *days).collect()
        assert report.top_authors_by_count.collect() == leaderboards.top_authors_by_count(df, 5, *days).collect()
        assert report.top_authors_by_upvotes.collect() == leaderboards.top_authors_by_upvotes(df, 5, *days).collect()
        summary = leaderboards.top_products_summary(leaderboards.top_products(df, 7, *days))
        assert report.summary.collect() == summary.collect()
        assert len(report.cached) == (2 if persist else 0)
        assert all(frame.is_cached for frame in report.cached)
    assert not any(frame.is_cached for frame in report.cached)


def test_rows_form_equals_report(spark):
    df = sales_reviews(spark, SMALL)
    value = {(r.metric, r.position, r.measure): (r.key, r.value) for r in engagement_rows(df, 7, 5).collect()}
    assert len(value) == 7 + 5 * 2 + 5 * 2
    for position, (game, count) in enumerate(leaderboards.top_products(df, 7).collect(), 1):
        assert value["top_games", position, "count"] == (game, count)
    for position, (author, reviews_of) in enumerate(leaderboards.top_authors_by_count(df, 5).collect(), 1):
        assert value["top_authors_by_count", position, "review_count"] == (author, reviews_of)
    for position, (author, votes, reviews_of) in enumerate(leaderboards.top_authors_by_upvotes(df, 5).collect(), 1):
        assert value["top_authors_by_upvotes", position, "total_upvotes"] == (author, votes)
        assert value["top_authors_by_upvotes", position, "review_count"] == (author, reviews_of)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abcde"), st.sampled_from("xyz"), st.integers(0, 3)), max_size=25))
def test_top_k_is_a_prefix_of_top_k_plus_one(spark, rows):
    df = reviews(spark, [(g, a, v, at(1)) for g, a, v in rows])
    for board in (leaderboards.top_products, leaderboards.top_authors_by_count, leaderboards.top_authors_by_upvotes):
        longer = board(df, 4).collect()
        assert board(df, 3).collect() == longer[:3]
    counts = {g: sum(1 for r in rows if r[0] == g) for g, _, _ in rows}
    expected = sorted(counts.items(), key=lambda item: (-item[1], item[0]))[:4]
    assert [tuple(r) for r in leaderboards.top_products(df, 4).collect()] == expected
