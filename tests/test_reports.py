import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import SMALL
from reviewlens.fixtures import DOC_REVIEWS, doc_reviews
from reviewlens.functions import display
from reviewlens.operators import reports
from reviewlens.operators import sentiment as T
from reviewlens.operators.filters import of_product
from reviewlens.plans.product_report import product_report
from reviewlens.schema import ALL_LANGUAGES, LANGUAGE_NAMES, REVIEW, ReviewColumns

SCHEMA = (
    "review_id bigint, game string, author_steamid string, review string, language string, "
    "timestamp_created timestamp, votes_up int, votes_funny int, comment_count int, "
    "author_playtime_at_review int, received_for_free boolean, written_during_early_access boolean"
)
COLS = ReviewColumns(key=("review_id",))


def at(day):
    return dt.datetime(2024, 1, day, 12)


def sample(spark):
    return spark.createDataFrame(
        [
            (1, "g", "author-0001", "good", "english", at(1), 5, 0, 1, 60, True, True),
            (2, "g", "a2", "x" * 300, "german", at(1), 5, 2, 1, None, None, None),
            (3, "g", "a3", "y" * 301, None, at(3), None, 2, 1, 0, False, False),
            (4, "g", "a4", None, "german", None, 7, None, 1, 27, False, True),
            (5, "G", "a5", "other game", "german", at(1), 99, 99, 99, 3, False, True),
            (6, " g", "a6", "untrimmed", "german", at(1), 99, 99, 99, 3, False, True),
        ],
        SCHEMA,
    )


def test_product_match_is_exact(spark):
    assert of_product(sample(spark), "g").count() == 4
    assert of_product(sample(spark), "g", "2024-01-01", "2024-01-02").count() == 2


def test_display_forms(spark):
    df = spark.createDataFrame(
        [("x" * 299, 0), ("x" * 300, 3), ("x" * 301, 9), ("", 27), (None, None), ("é" * 400, 60)], "t string, m int"
    )
    rows = df.select(
        F.length(display.shorten(F.col("t"))).alias("n"), display.hours(F.col("m")).alias("h")
    ).collect()
    assert [row.n for row in rows] == [299, 300, 303, 0, None, 303]
    assert [row.h for row in rows] == [0.0, 0.1, 0.2, 0.5, 0.0, 1.0]
    ids = spark.createDataFrame([("76561198000000000",), ("abc",), (None,)], "i string")
    assert [r[0] for r in ids.select(display.abbreviate_id(F.col("i"))).collect()] == ["76561198...", "abc...", None]


def test_language_names(spark):
    assert len(LANGUAGE_NAMES) == len(set(LANGUAGE_NAMES.values())) == 29 and ALL_LANGUAGES not in LANGUAGE_NAMES
    df = spark.createDataFrame([("koreana",), ("all",), ("xx",), (None,)], "c string")
    name = display.language_name(F.col("c"))
    rows = df.select(name.alias("name"), display.language_code(name).alias("code")).collect()
    assert rows == [("Korean", "koreana"), ("All Languages", "all"), ("xx", "all"), (None, "all")]


def test_summary(spark):
    rows = reports.summary(of_product(sample(spark), "g")).collect()
    assert rows == [("g", 4, 29.0, 2, 0.5, 50.0)]
    unknown = sample(spark).withColumn("author_playtime_at_review", F.lit(None).cast("int"))
    assert reports.summary(of_product(unknown, "g")).first().avg_playtime == 0.0
    assert reports.summary(of_product(sample(spark), "nope")).collect() == []


def test_daily_counts(spark):
    game = of_product(sample(spark), "g")
    assert reports.daily_counts(game).collect() == [(None, 1), ("2024-01-01", 2), ("2024-01-03", 1)]
    assert reports.daily_counts(game, newest_first=True).collect() == [("2024-01-03", 1), ("2024-01-01", 2), (None, 1)]


def test_unknown_acquisition_is_one_purchased_row(spark):
    assert reports.acquisition_split(of_product(sample(spark), "g")).collect() == [("Free", 1), ("Purchased", 3)]


def test_languages(spark):
    game = of_product(sample(spark), "g")
    assert [row.language for row in reports.available_languages(game).collect()] == ["english", "german", None]


def test_cube_adds_up_to_the_sections(spark):
    for game in (of_product(sample(spark), "g"), sample(spark), of_product(sample(spark), "nope")):
        cube = reports.report_cube(game)
        assert sorted(reports.summary_from_cube(cube).collect()) == sorted(reports.summary(game).collect())
        assert reports.daily_counts_from_cube(cube).collect() == reports.daily_counts(game).collect()
        assert reports.acquisition_split_from_cube(cube).collect() == reports.acquisition_split(game).collect()
        assert reports.available_languages(cube).collect() == reports.available_languages(game).collect()


@pytest.mark.parametrize("prefilter", [True, False])
def test_rankings_put_nulls_last_and_break_ties(spark, prefilter):
    game = of_product(sample(spark), "g")

    def ids(ranking):
        return [row.review_id for row in reports.top_rows(game, ranking, prefilter, COLS).collect()]

    assert ids(reports.upvote_ranking(cols=COLS)) == [4, 1, 2, 3]
    assert ids(reports.upvote_ranking(3, COLS)) == [4, 1, 2]
    assert ids(reports.upvote_ranking(2, COLS)) == [4, 1]
    assert ids(reports.funny_ranking(cols=COLS)) == [2, 3, 1, 4]
    assert ids(reports.comment_ranking(2, COLS)) == [1, 2]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(0, 4)), max_size=30), st.integers(1, 8))
def test_prefilter_never_changes_a_ranking(spark, votes, k):
    df = spark.createDataFrame(list(enumerate(votes)), "review_id bigint, votes_up int").repartition(3)
    ranking = reports.Ranking("votes_up", k)
    with_filter = reports.top_rows(df, ranking, True, COLS).collect()
    assert with_filter == reports.top_rows(df, ranking, False, COLS).collect()
    expected = sorted(enumerate(votes), key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))[:k]
    assert [tuple(row) for row in with_filter] == expected


def test_review_list(spark):
    game = of_product(sample(spark), "g")
    first = reports.top_reviews(game, reports.upvote_ranking(cols=COLS), cols=COLS).collect()
    assert first[0].asDict() == {
        "review_id": 4, "author_id": "a4", "review_text": None, "votes_up": 7, "date": None,
        "playtime_hrs": 0.5, "language": "german",
    }
    assert first[3].review_text == "y" * 300 + "..." and first[2].review_text == "x" * 300
    full = reports.review_list(game, "votes_up", full_text=True, cols=COLS)
    assert full.agg(F.max(F.length("review_text"))).first()[0] == 301
    default = reports.top_reviews(game, reports.upvote_ranking()).columns
    assert default == ["author_id", "review_text", "votes_up", "date", "playtime_hrs", "language"]


def test_language_filter(spark):
    ranking = reports.upvote_ranking(cols=COLS)
    game = of_product(sample(spark), "g")
    german = reports.in_language(game, ranking, "german", cols=COLS)
    assert [row.review_id for row in german.collect()] == [4, 2]
    assert [row.review_id for row in reports.in_language(game, ranking, "german", 1, COLS).collect()] == [4]
    for everything in ("all", "", None):
        assert reports.in_language(game, ranking, everything, cols=COLS).count() == game.count()
    assert reports.language_match_count(game, "german").first() == (2,)
    assert reports.language_match_count(game, "thai").first() == (0,)


def test_a_rare_language_has_its_list(spark):
    rows = [(i, "english" if i < 200 else "thai", 1000 - i) for i in range(203)]
    df = spark.createDataFrame(rows, "review_id bigint, language string, votes_up int")
    thai = reports.in_language(df, reports.upvote_ranking(), "thai", cols=COLS)
    assert [row.review_id for row in thai.collect()] == [200, 201, 202]


@pytest.mark.parametrize("measure", ["0", "cast(null as int)", "if(id % 2 = 0, null, 0)"])
def test_candidates_are_few_however_flat_the_measure(spark, measure):
    df = spark.range(1000).selectExpr("id as review_id", f"{measure} as votes_up")
    assert reports.ranking_candidates(df, [reports.upvote_ranking(7)], COLS).count() == 7


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(*[st.one_of(st.none(), st.integers(0, 4))] * 3), min_size=0, max_size=30), st.integers(1, 6))
def test_leaders_give_the_same_candidates(spark, votes, k):
    """One scan that keeps the first rows per task finds the places that a scan per ranking finds."""
    rows = [(i, *v) for i, v in enumerate(votes)]
    df = spark.createDataFrame(rows, "review_id long, votes_up int, votes_funny int, comment_count int").repartition(3)
    rankings = [r(k, COLS) for r in (reports.upvote_ranking, reports.funny_ranking, reports.comment_ranking)]
    leaders = reports.ranking_leaders(df, rankings, COLS)
    found = reports.ranking_candidates(df, rankings, COLS, leaders)
    assert sorted(r.review_id for r in found.collect()) == sorted(r.review_id for r in reports.ranking_candidates(df, rankings, COLS).collect())
    assert leaders.count() <= 3 * 3 * k


def test_equal_rows_have_one_order(spark):
    rows = [("a", None, f"text{i}", 1) for i in range(8)]
    df = spark.createDataFrame(rows, "author_steamid string, timestamp_created timestamp, review string, votes_up int")
    listed = [
        [r.review for r in reports.top_rows(df.repartition(n), reports.upvote_ranking(3)).collect()] for n in (1, 3, 7)
    ]
    assert listed[0] == listed[1] == listed[2]


def sections(report):
    names = (
        "summary languages daily acquisition top_upvoted top_funny top_commented overall positive negative histogram"
    ).split()
    return {name: getattr(report, name).collect() for name in names}


@pytest.mark.parametrize("persist", [True, False])
@pytest.mark.parametrize("max_reviews", [1000, 5, None])
def test_report_equals_its_parts(spark, persist, max_reviews):
    df = doc_reviews(spark, SMALL)
    days = ("2024-01-02", "2024-01-04")
    scorer = T.fragment_scorer("en", "on")
    game = of_product(df, "click", *days)
    with product_report(
        df, "click", *days, scorer=scorer, max_reviews=max_reviews, top=4, persist=persist, cols=DOC_REVIEWS
    ) as report:
        got = sections(report)
    upvotes = reports.upvote_ranking(4, DOC_REVIEWS)
    sample_rows = game if max_reviews is None else reports.top_rows(
        game, reports.upvote_ranking(max_reviews, DOC_REVIEWS), cols=DOC_REVIEWS
    )
    scored = T.score_reviews(sample_rows, scorer, DOC_REVIEWS)
    assert got["summary"] == reports.summary(game).collect()
    assert got["languages"] == reports.available_languages(game).collect()
    assert got["daily"] == reports.daily_counts(game).collect()
    assert got["acquisition"] == reports.acquisition_split(game).collect()
    assert got["top_upvoted"] == reports.top_reviews(game, upvotes, cols=DOC_REVIEWS).collect()
    assert got["top_funny"] == reports.top_reviews(game, reports.funny_ranking(4), cols=DOC_REVIEWS).collect()
    assert got["top_commented"] == reports.top_reviews(game, reports.comment_ranking(4), cols=DOC_REVIEWS).collect()
    assert got["histogram"] == T.sentiment_histogram(scored).collect()
    assert got["overall"][0].analyzed_count == scored.count() == min(max_reviews or 10**9, game.count())
    assert abs(got["overall"][0].sentiment_score - T.overall_sentiment(scored).first().sentiment_score) < 1e-12
    assert [r.review_id for r in got["positive"]] == [
        r.review_id for r in T.extreme_reviews(scored, True, cols=DOC_REVIEWS).collect()
    ]
    # totals agree with each other
    total = got["summary"][0].total_reviews
    assert total == sum(r["count"] for r in got["daily"]) == sum(r["count"] for r in got["acquisition"])
    assert sum(r.review_count for r in got["histogram"]) == got["overall"][0].analyzed_count


@pytest.mark.parametrize("game, days", [("nope", (None, None)), ("click", ("2030-01-01", "2030-02-01"))])
def test_report_on_nothing_is_empty(spark, game, days):
    with product_report(doc_reviews(spark, SMALL), game, *days, cols=DOC_REVIEWS) as report:
        got = sections(report)
    assert got.pop("overall") == [(0.0, 0, "Mixed")]
    assert all(rows == [] for rows in got.values())


@pytest.mark.parametrize("max_reviews", [1000, None])
def test_report_uses_scores_the_table_has(spark, max_reviews):
    df = doc_reviews(spark, SMALL)
    scorer = T.fragment_scorer("en", "on")
    options = {"max_reviews": max_reviews, "persist": False, "cols": DOC_REVIEWS}
    fresh = product_report(df, "click", scorer=scorer, **options)
    scored = T.score_reviews(df, scorer, DOC_REVIEWS)
    assert sections(fresh) == sections(product_report(scored, "click", stored=True, **options))
    with pytest.raises(ValueError, match="stored"):
        product_report(scored, "click", scorer=scorer, stored=True, **options)
    other = T.fragment_scorer("on", "en")
    again = product_report(scored, "click", scorer=other, **options)
    assert sections(again) == sections(product_report(df, "click", scorer=other, **options))


def test_report_scores_every_review(spark):
    with product_report(doc_reviews(spark, SMALL), "click", cols=DOC_REVIEWS) as report:
        assert report.overall.first().analyzed_count == report.summary.first().total_reviews
        assert report.positive.columns == report.negative.columns and "votes_funny" in report.positive.columns


def test_default_key_is_author_and_clock():
    assert REVIEW.key == (REVIEW.author, REVIEW.created)
