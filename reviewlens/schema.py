"""Review schemas, cast specs, column bindings and the language dimension."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Column names, target types, language codes and display names.
# They define the data this library reads and must stay exactly as they are.
# --------------------------------------------------------------------------

RAW_COLUMNS = (
    "recommendationid",
    "appid",
    "game",
    "author_steamid",
    "author_num_games_owned",
    "author_num_reviews",
    "author_playtime_forever",
    "author_playtime_last_two_weeks",
    "author_playtime_at_review",
    "author_last_played",
    "language",
    "review",
    "timestamp_created",
    "timestamp_updated",
    "voted_up",
    "votes_up",
    "votes_funny",
    "weighted_vote_score",
    "comment_count",
    "steam_purchase",
    "received_for_free",
    "written_during_early_access",
    "hidden_in_steam_china",
    "steam_china_location",
)

UNUSED_COLUMNS = (
    "author_playtime_last_two_weeks",
    "recommendationid",
    "appid",
    "voted_up",
    "hidden_in_steam_china",
    "steam_china_location",
)

PRODUCT_NAME_CANDIDATES = ("app_name", "game_name", "title", "name", "game")
LANGUAGE_NAME_CANDIDATES = ("language", "review_language", "user_language")

ALL_LANGUAGES = "all"
ALL_LANGUAGES_NAME = "All Languages"

LANGUAGE_NAMES = {
    "brazilian": "Brazilian Portuguese",
    "bulgarian": "Bulgarian",
    "czech": "Czech",
    "danish": "Danish",
    "dutch": "Dutch",
    "english": "English",
    "finnish": "Finnish",
    "french": "French",
    "german": "German",
    "greek": "Greek",
    "hungarian": "Hungarian",
    "indonesian": "Indonesian",
    "italian": "Italian",
    "japanese": "Japanese",
    "koreana": "Korean",
    "latam": "Latin American Spanish",
    "norwegian": "Norwegian",
    "polish": "Polish",
    "portuguese": "Portuguese",
    "romanian": "Romanian",
    "russian": "Russian",
    "schinese": "Simplified Chinese",
    "spanish": "Spanish",
    "swedish": "Swedish",
    "tchinese": "Traditional Chinese",
    "thai": "Thai",
    "turkish": "Turkish",
    "ukrainian": "Ukrainian",
    "vietnamese": "Vietnamese",
}


@dataclass(frozen=True)
class CastSpec:
    """Which text columns become which type; columns not listed stay as they are."""

    integers: tuple[str, ...] = ()
    longs: tuple[str, ...] = ()
    floats: tuple[str, ...] = ()
    booleans: tuple[str, ...] = ()
    unix_seconds: tuple[str, ...] = ()

    def target_types(self) -> dict[str, T.DataType]:
        typed = (
            (self.integers, T.IntegerType()),
            (self.longs, T.LongType()),
            (self.floats, T.FloatType()),
            (self.booleans, T.BooleanType()),
            (self.unix_seconds, T.TimestampType()),
        )
        return {name: dtype for names, dtype in typed for name in names}


# Types of the cleaned table (fixed values).
CLEAN_CASTS = CastSpec(
    integers=(
        "author_num_games_owned",
        "author_num_reviews",
        "author_playtime_forever",
        "author_playtime_at_review",
        "votes_up",
        "votes_funny",
        "comment_count",
    ),
    floats=("weighted_vote_score",),
    booleans=("steam_purchase", "received_for_free", "written_during_early_access"),
    unix_seconds=("author_last_played", "timestamp_created", "timestamp_updated"),
)

# Wider variant for exploring the raw table: nothing is dropped, clocks stay numeric or text (fixed values).
EXPLORE_CASTS = CastSpec(
    integers=("appid", "author_playtime_last_two_weeks", *CLEAN_CASTS.integers),
    longs=("author_last_played",),
    floats=CLEAN_CASTS.floats,
    booleans=("voted_up", *CLEAN_CASTS.booleans),
)

RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])


def cleaned_schema(
    raw: T.StructType = RAW_SCHEMA,
    casts: CastSpec = CLEAN_CASTS,
    unused: tuple[str, ...] = UNUSED_COLUMNS,
) -> T.StructType:
    """Schema of the cleaned table that belongs to a raw schema and a cast spec."""
    types = casts.target_types()
    return T.StructType(
        [T.StructField(f.name, types.get(f.name, f.dataType)) for f in raw.fields if f.name not in unused]
    )


CLEAN_SCHEMA = cleaned_schema()


@dataclass(frozen=True)
class ReviewColumns:
    """Binds the roles an operator needs to column names of the table at hand.

    ``key`` breaks ties in row-level rankings. The cleaned table has no row id, so the
    default is the author and the clock; bind an id column where there is one. ``created_year`` names a
    partition column with the year of ``created``, for day filters to prune directories by.
    """

    product: str = "game"
    author: str = "author_steamid"
    text: str = "review"
    language: str = "language"
    created: str = "timestamp_created"
    upvotes: str = "votes_up"
    funny_votes: str = "votes_funny"
    comments: str = "comment_count"
    playtime: str = "author_playtime_at_review"
    free: str = "received_for_free"
    early_access: str = "written_during_early_access"
    created_year: str | None = None
    key: tuple[str, ...] = ("author_steamid", "timestamp_created")


REVIEW = ReviewColumns()
