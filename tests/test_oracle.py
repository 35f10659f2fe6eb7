"""Every registered query against DuckDB on the smallest test tables."""

import pytest

from compare import duck_table, spark_table
from conftest import SMALL
from reviewlens.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    assert spark_table(QUERIES[name](spark, SMALL)) == duck_table(duck, ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_without_sql_runs(spark, name):
    df = QUERIES[name](spark, SMALL)
    assert df.columns and df.count() > 0


def test_random_sample_comes_from_the_filtered_rows(spark):
    rows = QUERIES["null_or_zero_random_sample"](spark, SMALL).collect()
    assert len(rows) == 10
    assert all(row.votes_funny in (None, 0) for row in rows)


def test_ml_scores_are_probabilities_of_every_review(spark):
    rows = QUERIES["sentiment_ml"](spark, SMALL).collect()
    assert len({row.review_id for row in rows}) == len(rows) == 200
    assert all(abs(row.negative + row.positive - 1) < 1e-8 for row in rows)
    assert all(row.confidence >= 0.5 and -1 <= row.sentiment <= 1 for row in rows)
