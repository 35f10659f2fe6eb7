import datetime as dt

import pytest

from pyspark.sql import functions as F

from reviewlens.operators import catalog, profiling
from reviewlens.plans.profile import profile_report
from reviewlens.sources.sinks import write_names


def profile_of(df, columns, **options):
    return {row.column_name: row.asDict() for row in profiling.profile_columns(df, columns, **options).collect()}


def dirty(spark):
    return spark.createDataFrame(
        [
            ("1", "5", "0.52", "plain"),
            ("true", "-5", "1.", " padded"),
            ("TRUE", "5\n", "x", "tail "),
            ("2", "5.0", "-3", "café!"),
            (None, None, None, None),
            ("", "", "", ""),
            (" ", "\t", " \n ", "   "),
            ("1", "5", "0.52", "plain"),
        ],
        "voted_up string, votes_up string, weighted_vote_score string, game string",
    )


COLUMNS = ["voted_up", "votes_up", "weighted_vote_score", "game"]


@pytest.mark.parametrize("sketch", [[], ["game"], ["game", "votes_up"], COLUMNS])
def test_profile(spark, sketch):
    found = profile_of(dirty(spark), COLUMNS, sketch=sketch)
    assert sorted(found) == sorted(COLUMNS)
    assert [found[c]["blank_rows"] for c in found] == [3, 3, 3, 3]
    assert found["voted_up"]["nonconvertible_rows"] == 4  # TRUE, 2, '', blank
    assert found["votes_up"]["nonconvertible_rows"] == 4  # line break, 5.0, '', tab
    assert found["weighted_vote_score"]["nonconvertible_rows"] == 3  # x, '', blank
    assert found["game"]["nonconvertible_rows"] is None
    assert found["game"]["padded_rows"] == 3
    assert found["votes_up"]["padded_rows"] == 0  # only spaces count as padding
    assert found["game"]["special_character_rows"] == 1
    assert found["game"]["distinct_values"] == 6


@pytest.mark.parametrize("persist", [True, False])
def test_report_equals_its_parts(spark, persist):
    df = dirty(spark)
    with profile_report(df, COLUMNS, frequent=3, sample=4, bad=2, persist=persist) as report:
        counts = {row.column_name: row.asDict() for row in report.counts.collect()}
        assert counts == profile_of(df, COLUMNS)
        for name in COLUMNS:
            frequent = report.frequent_values.where(F.col("column_name") == name).orderBy("position")
            expected = profiling.value_frequency(df, name, 3)
            assert frequent.select("value", "row_count").collect() == expected.collect()
            sampled = report.sample_values.where(F.col("column_name") == name).orderBy("position")
            assert sampled.select("value").collect() == profiling.distinct_sample(df, name, 4).collect()
        bad = sorted(report.nonconvertible_values.collect())
        assert bad == sorted(profiling.nonconvertible_values(df, COLUMNS, 2).collect())
        assert {row.column_name for row in bad} == {"voted_up", "votes_up", "weighted_vote_score"}
    assert not any(frame.is_cached for frame in report.cached)


def test_profile_of_typed_columns(spark):
    df = spark.createDataFrame(
        [(1, True, dt.datetime(2024, 1, 1)), (None, None, None)], "votes_up int, voted_up boolean, t timestamp"
    )
    found = profile_of(df, ["votes_up", "voted_up", "t"])
    assert all(row["blank_rows"] == 1 and row["distinct_values"] == 1 for row in found.values())
    assert found["votes_up"]["nonconvertible_rows"] == found["voted_up"]["nonconvertible_rows"] == 0


def test_value_frequency_breaks_ties_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "v string")
    assert profiling.value_frequency(df, "v").collect() == [("c", 2), ("a", 1), ("b", 1), (None, 1)]
    assert profiling.value_frequency(df, "v", 1).collect() == [("c", 2)]


def test_distinct_sample(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), (None,)], "v string")
    assert [row.value for row in profiling.distinct_sample(df, "v", 3).collect()] == ["a", "b", None]


def test_nonconvertible_values_are_cut_per_column(spark):
    df = spark.createDataFrame([(f"x{i % 30:02d}", "7") for i in range(300)], "votes_up string, votes_funny string")
    rows = profiling.nonconvertible_values(df, df.columns).collect()
    assert sorted(row.value for row in rows) == [f"x{i:02d}" for i in range(10)]
    assert {row.column_name for row in rows} == {"votes_up"}
    assert profiling.nonconvertible_values(df, df.columns, 2000).count() == 30


def test_profile_of_an_empty_table_has_a_row_per_column(spark):
    empty = spark.createDataFrame([], "votes_up string, game string")
    for sketch in ((), ("game",)):
        rows = sorted(profiling.profile_columns(empty, empty.columns, sketch=sketch).collect())
        assert [tuple(r) for r in rows] == [("game", 0, 0, None, 0, 0), ("votes_up", 0, 0, 0, 0, 0)]


def test_null_or_zero_by_type(spark):
    df = spark.createDataFrame(
        [
            (0, 0.0, False, "  ", dt.datetime(2024, 1, 1), dt.date(2024, 1, 1)),
            (1, float("nan"), True, "", dt.datetime(2024, 1, 1), dt.date(2024, 1, 1)),
            (2, 1.5, True, "\t", None, None),
            (None, None, None, None, None, None),
        ],
        "i int, d double, x boolean, s string, t timestamp, day date",
    ).selectExpr("*", "cast(i as decimal(5,2)) as dec", "array(i) as other")
    expected = {"i": 2, "d": 3, "x": 2, "s": 3, "t": 2, "day": 2, "dec": 2, "other": 0}
    assert {c: profiling.null_or_zero_rows(df, c).count() for c in expected} == expected
    counted = {row.column_name: row.row_count for row in profiling.null_or_zero_counts(df).collect()}
    assert counted == expected
    with pytest.raises(ValueError):
        profiling.null_or_zero_rows(df, "nope")


def test_keyed_sample_does_not_depend_on_partitioning(spark):
    df = spark.range(1000)
    one = [row.id for row in profiling.random_rows(df.repartition(1), 10, 3, ["id"]).collect()]
    many = [row.id for row in profiling.random_rows(df.repartition(7), 10, 3, ["id"]).collect()]
    other = [row.id for row in profiling.random_rows(df, 10, 4, ["id"]).collect()]
    assert one == many and one != other and len(set(one)) == 10
    assert profiling.random_rows(df, 10).count() == 10


def test_catalog(spark, tmp_path):
    df = spark.createDataFrame(
        [("b", None), ("a", ""), ("Z", None), ("a", ""), (None, None), ("", None), ("é", None)],
        "name string, user_language string",
    )
    assert [row.name for row in catalog.product_names(df).collect()] == ["Z", "a", "b", "é"]
    assert catalog.language_codes(df).collect() == []
    assert catalog.language_codes(df.drop("user_language")) is None
    with pytest.raises(ValueError):
        catalog.product_names(df.drop("name"))
    assert catalog.distinct_counts(df, "name").first() == (5,)
    assert catalog.distinct_counts(df, "name", "user_language", approximate=True).first() == (5, 1)

    path = tmp_path / "names"
    write_names(df, "name", str(path), single_file=True)
    (part,) = path.glob("part-*")
    assert part.read_text(encoding="utf-8") == "Z\na\nb\né\n"
    write_names(df, "name", str(tmp_path / "parts"))
    parts = sorted((tmp_path / "parts").glob("part-*"))
    assert "".join(p.read_text(encoding="utf-8") for p in parts) == "Z\na\nb\né\n"
