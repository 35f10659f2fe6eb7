import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from conftest import SMALL
from reviewlens.fixtures import raw_reviews
from reviewlens.functions.casts import unix_to_timestamp
from reviewlens.operators import cleaning
from reviewlens.operators.columns import drop_columns, require_columns, resolve_column
from reviewlens.plans.cleaning import check_cleaned, clean_to_parquet
from reviewlens.schema import CLEAN_CASTS, CLEAN_SCHEMA, EXPLORE_CASTS, RAW_SCHEMA, CastSpec, cleaned_schema


def texts(spark, *values, name="v"):
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField(name, T.StringType())]))


def converted(spark, spec, *values, **options):
    return [row.v for row in cleaning.convert_types(texts(spark, *values), spec, **options).collect()]


def test_integers(spark):
    values = ["7", " 7 ", "-3", "1.0", "abc", "3000000000", "", None]
    assert converted(spark, CastSpec(integers=("v",)), *values) == [7, 7, -3, 1, None, None, None, None]


def test_fractions_are_cut_unless_refused(spark):
    values = ["1.0", "2.9", "2.9999999", "-2.9", "7", "3000000000", "x"]
    spec = CastSpec(integers=("v",))
    assert converted(spark, spec, *values) == [1, 2, 2, -2, 7, None, None]
    assert converted(spark, spec, *values, allow_fractional=False) == [None, None, None, None, 7, None, None]


def test_cleaning_job_counts_what_casts_lose(spark, tmp_path):
    raw = raw_reviews(spark, SMALL).withColumn("votes_up", F.concat("votes_up", F.lit(".0")))
    report = clean_to_parquet(raw, str(tmp_path / "a"))
    assert report.rows_after == 84 and report.lost_in_cast["votes_up"] == 0
    assert report.lost_in_cast["author_playtime_at_review"] == 11
    assert set(report.missing_after.values()) == {0}
    strict = clean_to_parquet(raw, str(tmp_path / "b"), allow_fractional=False)
    assert strict.rows_after == 0 and strict.lost_in_cast["votes_up"] == 1000


def test_audit_after_cleaning_sees_what_the_row_test_lets_through(spark, tmp_path):
    raw = raw_reviews(spark, SMALL)
    report = clean_to_parquet(raw, str(tmp_path / "a"), required=["game", "votes_up"])
    kept = spark.read.parquet(str(tmp_path / "a"))
    counts = cleaning.null_audit(kept).first().asDict()
    assert report.missing_after == counts and report.rows_after == kept.count()
    assert counts["game"] == counts["votes_up"] == 0 and counts["review"] > 0 and counts["received_for_free"] > 0
    with pytest.raises(ValueError):
        clean_to_parquet(raw, str(tmp_path / "b"), required=["nothing"])


def test_longs_and_floats(spark):
    assert converted(spark, CastSpec(longs=("v",)), "3000000000", "x") == [3000000000, None]
    got = converted(spark, CastSpec(floats=("v",)), "0.5", "1.", "x", "nan")
    assert got[:3] == [0.5, 1.0, None] and got[3] != got[3]


def test_booleans(spark):
    values = ["1", "0", "true", "TRUE", "f", "no", "2", "", None]
    expected = [True, False, True, True, False, False, None, None, None]
    assert converted(spark, CastSpec(booleans=("v",)), *values) == expected


def test_unix_seconds_are_instants(spark):
    # Around the end of daylight saving in New York, where local text names two instants.
    zone = spark.conf.get("spark.sql.session.timeZone")
    seconds = ["1699162200", "1699165800", "1699169400", "abc", "99999999999999999", None]
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = texts(spark, *seconds).select(F.unix_seconds(unix_to_timestamp(F.col("v"))).alias("s"))
        assert [row.s for row in df.collect()] == [1699162200, 1699165800, 1699169400, None, None, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_converting_twice_changes_nothing(spark):
    once = cleaning.convert_types(drop_columns(raw_reviews(spark, SMALL)))
    twice = cleaning.convert_types(once)
    assert twice.schema == once.schema
    assert twice.exceptAll(once).isEmpty()


def test_schemas(spark):
    typed = cleaning.convert_types(drop_columns(raw_reviews(spark, SMALL)))
    assert [(f.name, f.dataType) for f in typed.schema] == [(f.name, f.dataType) for f in CLEAN_SCHEMA]
    assert len(RAW_SCHEMA) == 24 and len(CLEAN_SCHEMA) == 18
    explored = cleaning.convert_types(raw_reviews(spark, SMALL), EXPLORE_CASTS)
    assert {f.name: f.dataType for f in explored.schema} == {
        f.name: f.dataType for f in cleaned_schema(casts=EXPLORE_CASTS, unused=())
    }
    assert explored.schema["author_last_played"].dataType == T.LongType()


def test_missing_cast_column_is_an_error(spark):
    with pytest.raises(ValueError, match="votes_up"):
        cleaning.convert_types(texts(spark, "1", name="game"))


MIXED = "i int, b bigint, d double, f float, s string, x boolean, t timestamp, day date"


def mixed(spark):
    now, today = dt.datetime(2024, 1, 1), dt.date(2024, 1, 1)
    nan = float("nan")
    return spark.createDataFrame(
        [
            (1, 1, 1.0, 1.0, "a", True, now, today),
            (0, 0, 0.0, 0.0, "  ", False, now, today),
            (1, 1, nan, 1.0, "a", True, now, today),
            (1, 1, 1.0, nan, "a", True, now, today),
            (1, 1, 1.0, 1.0, "", True, now, today),
            (None, None, None, None, None, None, None, None),
        ],
        MIXED,
    )


def test_null_audit_by_type(spark):
    audit = cleaning.null_audit(mixed(spark)).first().asDict()
    assert audit == {"i": 1, "b": 1, "d": 2, "f": 2, "s": 2, "x": 1, "t": 1, "day": 1}
    plain = {r.column_name: r.missing_rows for r in cleaning.null_audit_rows(mixed(spark), False).collect()}
    assert plain == {"i": 1, "b": 1, "d": 2, "f": 2, "s": 1, "x": 1, "t": 1, "day": 1}


def test_incomplete_rows(spark):
    kept = cleaning.drop_incomplete(mixed(spark))
    assert [row.s for row in kept.collect()] == ["a", "  "]
    assert cleaning.drop_report(mixed(spark)).first() == (6, 2, 4)
    assert set(cleaning.null_audit(kept).first()) == {0}
    assert cleaning.drop_incomplete(kept).count() == kept.count()
    assert cleaning.drop_incomplete(mixed(spark), ["i", "d"]).count() == 4


def test_one_column(spark):
    assert cleaning.drop_missing(mixed(spark), "s").count() == 4
    assert cleaning.drop_missing(mixed(spark), "d").count() == 4
    assert cleaning.drop_missing(mixed(spark), "day").count() == 5
    assert cleaning.drop_missing(mixed(spark), "nope").count() == 6


def test_empty_input(spark):
    empty = mixed(spark).limit(0)
    assert set(cleaning.null_audit(empty).first()) == {0}
    assert cleaning.drop_report(empty).first() == (0, 0, 0)


def test_column_helpers(spark):
    df = spark.createDataFrame([(1, 2, 3)], "title int, name int, review_language int")
    assert resolve_column(df, ("app_name", "title", "name")) == "title"
    assert resolve_column(df, ("language",), required=False) is None
    with pytest.raises(ValueError, match="app_name"):
        resolve_column(df, ("app_name",))
    with pytest.raises(ValueError, match="game"):
        require_columns(df, ["title", "game"])
    assert drop_columns(df, ["name", "nope"]).columns == ["title", "review_language"]


@pytest.mark.parametrize("options", [{}, {"files": 1}, {"clustered": True}, {"clustered": True, "files": 3}, {"by_year": "timestamp_created"}])
def test_cleaning_job(spark, tmp_path, options):
    raw = raw_reviews(spark, SMALL)
    path = str(tmp_path / "clean")
    report = clean_to_parquet(raw, path, **options)
    written = spark.read.parquet(path)
    if "by_year" in options:
        assert {r.review_year for r in written.select("review_year").distinct().collect()} == {2024}
        written = written.drop("review_year")
    expected = cleaning.clean_reviews(raw)
    assert (report.rows_before, report.rows_after, report.rows_dropped) == (1000, 84, 916)
    assert report.missing_before == cleaning.null_audit(cleaning.convert_types(drop_columns(raw))).first().asDict()
    assert written.schema == expected.schema
    assert written.exceptAll(expected).isEmpty() and expected.exceptAll(written).isEmpty()
    audit, counts = check_cleaned(spark, path)
    assert set(audit.first()) == {0}
    assert counts.first() == (84, 84, 0)
    if options.get("files") == 1:
        assert len(list((tmp_path / "clean").glob("*.parquet"))) == 1


def test_clean_casts_cover_the_documented_columns():
    assert len(CLEAN_CASTS.target_types()) == 14
    assert len(EXPLORE_CASTS.target_types()) == 15
