"""Review tables derived from the driver's test tables (see FIXTURES.md), for queries, tests and bench."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reviewlens.schema import LANGUAGE_NAMES, ReviewColumns

# ``doc_reviews`` has a row id that breaks ties.
DOC_REVIEWS = ReviewColumns(key=("review_id",))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(c: Column) -> Column:
    return c.cast("string")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """24 text columns with malformed, empty and missing values."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("label_id"), "quality", "toxic")
    rows = (
        table(spark, sf_dir, "events")
        .join(documents, F.col("event_id") == F.col("doc_id"), "left")
        .join(labels, F.col("event_id") == F.col("label_id"), "left")
    )
    event, user, seconds = F.col("event_id"), F.col("user_id"), F.unix_timestamp("ts")
    columns = {
        "recommendationid": _text(event),
        "appid": _text(event % 100),
        "game": F.concat(F.col("event_type"), F.lit("-"), _text(event % 20)),
        "author_steamid": _text(user),
        "author_num_games_owned": _text(user % 40),
        "author_num_reviews": _text(user % 9),
        "author_playtime_forever": _text(F.floor(F.col("value") * 20)),
        "author_playtime_last_two_weeks": F.lit("0"),
        "author_playtime_at_review": F.when(event % 97 == 0, F.lit("abc")).otherwise(
            _text(F.floor(F.col("value") * 10))
        ),
        "author_last_played": _text(seconds + 60),
        "language": F.col("lang"),
        "review": F.when(event % 53 == 0, F.lit("")).otherwise(F.col("text")),
        "timestamp_created": _text(seconds),
        "timestamp_updated": _text(seconds + event % 86400),
        "voted_up": _text(F.col("quality")),
        "votes_up": _text(_k()),
        "votes_funny": _text(_k() % 13),
        "weighted_vote_score": _text(F.col("value")),
        "comment_count": _text(event % 11),
        "steam_purchase": F.when(event % 3 == 0, F.lit("0")).otherwise(F.lit("1")),
        "received_for_free": _text(F.col("toxic")),
        "written_during_early_access": F.when(event % 89 == 0, F.lit("2")).otherwise(_text(1 - F.col("quality"))),
        "hidden_in_steam_china": F.lit("0"),
        "steam_china_location": F.lit(None).cast("string"),
    }
    return rows.select(*[c.alias(name) for name, c in columns.items()])


def dirty_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_reviews`` with padded names, malformed floats and the codes of the language dimension."""
    event = F.col("recommendationid").cast("bigint")
    codes = F.array(*[F.lit(code) for code in sorted(LANGUAGE_NAMES)])
    return raw_reviews(spark, sf_dir).withColumns(
        {
            "game": F.when(event % 7 == 0, F.concat(F.lit(" "), F.col("game"))).otherwise(F.col("game")),
            "weighted_vote_score": F.when(event % 31 == 0, F.lit("0.5.1")).otherwise(F.col("weighted_vote_score")),
            "language": F.element_at(codes, (event % len(LANGUAGE_NAMES) + 1).cast("int")),
        }
    )


def doc_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed reviews with real text and a row id."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("label_id"), "quality", "toxic")
    rows = (
        table(spark, sf_dir, "events")
        .join(documents, F.col("event_id") == F.col("doc_id"))
        .join(labels, F.col("event_id") == F.col("label_id"), "left")
    )
    return rows.select(
        F.col("event_id").alias("review_id"),
        F.col("event_type").alias("game"),
        _text(F.col("user_id")).alias("author_steamid"),
        F.col("text").alias("review"),
        F.col("lang").alias("language"),
        F.col("ts").alias("timestamp_created"),
        _k().alias("votes_up"),
        (_k() % 13).alias("votes_funny"),
        (F.col("event_id") % 11).cast("int").alias("comment_count"),
        F.floor(F.col("value") * 10).cast("int").alias("author_playtime_at_review"),
        (F.col("toxic") == 1).alias("received_for_free"),
        (F.col("quality") == 0).alias("written_during_early_access"),
    )


def sales_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed reviews without text, the largest view; it has no row id, so group results only."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    rows = table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select(
        _text(F.col("l_partkey")).alias("game"),
        _text(F.col("o_custkey")).alias("author_steamid"),
        F.col("l_shipdate").alias("timestamp_created"),
        F.col("l_quantity").cast("int").alias("votes_up"),
        F.col("l_linenumber").alias("comment_count"),
        F.floor(F.col("l_extendedprice") / 100).cast("int").alias("author_playtime_at_review"),
        (F.col("l_returnflag") == "R").alias("received_for_free"),
        (F.col("l_linestatus") == "F").alias("written_during_early_access"),
        F.col("l_returnflag").alias("language"),
    )
