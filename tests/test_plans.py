"""The physical plans that the results alone do not show."""

import re

import pytest

from conftest import SMALL
from reviewlens.fixtures import doc_reviews, raw_reviews, sales_reviews
from reviewlens.operators import cleaning, leaderboards, profiling, reports
from reviewlens.operators import sentiment as T
from reviewlens.operators.columns import drop_columns
from reviewlens.operators.filters import of_product
from reviewlens.plans.engagement import engagement_rows
from reviewlens.plans.product_report import product_report
from reviewlens.plans.profile import profile_report
from reviewlens.queries import QUERIES
from reviewlens.schema import ReviewColumns
from reviewlens.sources.sinks import write_parquet

COLS = ReviewColumns(key=("review_id",))


def plan(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[-1]


def scans(text):
    return re.findall(r"ReadSchema: struct<([^>]*)>", text)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The views as tables, as on a cluster: plans then start at a Parquet scan."""
    root = tmp_path_factory.mktemp("tables")
    result = {}
    for name, view in (("raw", raw_reviews), ("doc", doc_reviews), ("sales", sales_reviews)):
        write_parquet(view(spark, SMALL), str(root / name))
        result[name] = spark.read.parquet(str(root / name))
    return result


def test_leaderboard_reads_two_columns_and_never_sorts(stored):
    text = plan(leaderboards.top_products(stored["sales"], 10, "1996-01-01", "1998-12-31"))
    assert scans(text) == ["game:string,timestamp_created:timestamp_ntz"]
    assert "GreaterThanOrEqual(timestamp_created,1996-01-01T00:00)" in text
    assert "LessThan(timestamp_created,1999-01-01T00:00)" in text
    assert "TakeOrderedAndProject" in text and "Sort [" not in text
    assert "partial_count" in text and text.count("Exchange") == 1


def test_engagement_reads_authors_once(stored):
    text = plan(engagement_rows(stored["sales"], 10, 10))
    assert text.count("TakeOrderedAndProject") == 3
    engaged = engagement_rows(stored["sales"], 10, 10)
    engaged.collect()
    final = engaged._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in final.split("== Initial Plan ==")[0]


def test_cleaning_is_one_stage(stored):
    text = plan(cleaning.clean_reviews(stored["raw"]))
    assert "Exchange" not in text and len(scans(text)) == 1
    dropped = ("recommendationid", "appid", "voted_up", "hidden_in_steam_china")
    assert not any(f"{name}:" in scans(text)[0] for name in dropped)
    assert "IsNotNull(game)" in text and "Not(EqualTo(game,))" in text


def test_audits_read_the_table_once(stored):
    typed = cleaning.convert_types(drop_columns(stored["raw"]))
    for df in (cleaning.null_audit_rows(typed), cleaning.drop_report(typed), profiling.null_or_zero_counts(typed)):
        assert len(scans(plan(df))) == 1
    # A flat aggregate, one row a task, and the digests of the values.
    for sketch in ((), ("review",)):
        profile = plan(profiling.profile_columns(stored["raw"], stored["raw"].columns, sketch=sketch))
        assert len(scans(profile)) == 2 and "partial_count" in profile
        moved = [line for line in profile.splitlines() if "Exchange hashpartitioning" in line]
        assert moved and all(re.search(r"\(column_name#\d+(, digest#\d+)?, \d+\)", line) for line in moved)
        assert profile.count("Generate inline") == 2 and "explode" not in profile


def test_frequent_texts_are_fetched_after_the_ranking(stored):
    frame = profiling.value_frequency(stored["raw"], "review", free_text=True)
    optimized = frame._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in optimized
    counted = [line for line in plan(frame).splitlines() if "Exchange hashpartitioning" in line]
    assert any("digest" in line for line in counted) and not any("review" in line for line in counted)


def test_bad_values_are_cut_before_the_ranking_shuffle(stored):
    report = profile_report(stored["raw"], ["votes_up", "voted_up", "game"], persist=False)
    for df in (
        profiling.nonconvertible_values(stored["raw"], ["votes_up", "voted_up"]),
        report.frequent_values,
        report.sample_values,
        report.nonconvertible_values,
    ):
        text = plan(df)
        assert len(scans(text)) == 1 and text.count("Window [") >= 2


def test_totals_do_not_read_text(stored):
    game = of_product(stored["doc"], "click", "2024-01-02", "2024-01-03")
    text = plan(reports.report_cube(game))
    assert "review:string" not in scans(text)[0] and "EqualTo(game,click)" in text
    assert text.count("Exchange") == 1


def test_top_reviews_find_the_limit_without_text(stored):
    game = of_product(stored["doc"], "click")
    text = plan(reports.top_reviews(game, reports.upvote_ranking(), cols=COLS))
    narrow = [columns for columns in scans(text) if "review:" not in columns]
    assert narrow and set(narrow) == {"review_id:bigint,game:string,votes_up:int"}
    assert "Exchange hashpartitioning" not in text and "Sort [" not in text
    wide = [line for line in text.splitlines() if "FileScan" in line and "review:string" in line]
    assert wide and all("Or(GreaterThanOrEqual(votes_up" in line and "EqualTo(game,click)" in line for line in wide)


def test_report_caches_shown_columns_only(stored):
    wide = stored["doc"].selectExpr("*", "game as unused_one", "review as unused_two")
    report = product_report(wide, "click", persist=True, cols=COLS)
    try:
        assert not any("unused" in name for frame in report.cached for name in frame.columns)
        assert not any("unused" in columns for frame in report.cached for columns in scans(plan(frame)))
        cube, candidates, scored, _, leaders = report.cached
        assert scans(plan(leaders)) == ["review_id:bigint,game:string,votes_up:int,votes_funny:int,comment_count:int"]
        # One wide scan; the places of the last rows come from the leaders that are kept.
        own = [line for line in plan(candidates).splitlines() if "FileScan" in line and "review:string" in line]
        assert len(set(own)) == 1
        assert "review" not in cube.columns and "review" in candidates.columns and "sentiment" in scored.columns
    finally:
        report.unpersist()


def test_a_report_runs_its_model_once(stored):
    report = product_report(stored["doc"], "click", scorer=T.classifier_scorer(lambda: None), cols=COLS)
    try:
        for section in (report.overall, report.positive, report.negative, report.histogram):
            assert plan(section).count("ArrowEvalPython") == 1 and "InMemoryTableScan" in plan(section)
    finally:
        report.unpersist()


def test_native_scoring_stays_in_the_jvm(stored):
    text = plan(T.score_reviews(stored["doc"], T.fragment_scorer("en", "on"), COLS))
    assert "Python" not in text and "Exchange" not in text


def test_a_catalyst_scorer_is_evaluated_once(stored):
    """What reads the scores reads finished ones, and no test of them moves below."""
    scored = T.score_reviews(of_product(stored["doc"], "click"), T.fragment_scorer("en", "on"), COLS)
    for df in (T.extreme_reviews(scored, True, cols=COLS), T.sentiment_histogram(scored), T.overall_sentiment(scored)):
        text = plan(df)
        assert text.count("replace(") == 2 and len(scans(text)) == 1
        assert "EqualTo(game,click)" in text
    report = product_report(stored["doc"], "click", scorer=T.fragment_scorer("en", "on"), cols=COLS)
    try:
        for section in (report.overall, report.histogram, report.positive, report.negative):
            assert plan(section).count("replace(") == 0 or "InMemoryTableScan" in plan(section)
    finally:
        report.unpersist()


def test_plugin_scoring_ships_only_the_text_once(stored):
    scored = T.score_reviews(stored["doc"], T.classifier_scorer(lambda: None), COLS)
    text = plan(T.extreme_reviews(scored, True, cols=COLS))
    assert len(re.findall(r"ArrowEvalPython \[probabilities\(review#\d+\)", text)) == 1
    assert "Exchange" not in text


def test_no_query_has_a_cross_join(spark):
    for name, query in QUERIES.items():
        if name != "sentiment_ml":
            text = plan(query(spark, SMALL))
            assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
    spark.catalog.clearCache()
