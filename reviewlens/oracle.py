"""Independent SQL (DuckDB) for the registered queries."""

from __future__ import annotations

from reviewlens.functions.display import DEFAULT_RANGE_DAYS
from reviewlens.schema import CLEAN_CASTS, EXPLORE_CASTS, LANGUAGE_NAMES, RAW_COLUMNS, UNUSED_COLUMNS

RAW = """raw_reviews AS (
  SELECT
    CAST(e.event_id AS VARCHAR) AS recommendationid,
    CAST(e.event_id % 100 AS VARCHAR) AS appid,
    concat(e.event_type, '-', CAST(e.event_id % 20 AS VARCHAR)) AS game,
    CAST(e.user_id AS VARCHAR) AS author_steamid,
    CAST(e.user_id % 40 AS VARCHAR) AS author_num_games_owned,
    CAST(e.user_id % 9 AS VARCHAR) AS author_num_reviews,
    CAST(CAST(floor(e.value * 20) AS BIGINT) AS VARCHAR) AS author_playtime_forever,
    '0' AS author_playtime_last_two_weeks,
    CASE WHEN e.event_id % 97 = 0 THEN 'abc'
         ELSE CAST(CAST(floor(e.value * 10) AS BIGINT) AS VARCHAR) END AS author_playtime_at_review,
    CAST(CAST(floor(epoch(e.ts)) AS BIGINT) + 60 AS VARCHAR) AS author_last_played,
    d.lang AS language,
    CASE WHEN e.event_id % 53 = 0 THEN '' ELSE d.text END AS review,
    CAST(CAST(floor(epoch(e.ts)) AS BIGINT) AS VARCHAR) AS timestamp_created,
    CAST(CAST(floor(epoch(e.ts)) AS BIGINT) + e.event_id % 86400 AS VARCHAR) AS timestamp_updated,
    CAST(l.quality AS VARCHAR) AS voted_up,
    CAST(CAST(json_extract_string(e.props, '$.k') AS INT) AS VARCHAR) AS votes_up,
    CAST(CAST(json_extract_string(e.props, '$.k') AS INT) % 13 AS VARCHAR) AS votes_funny,
    CAST(e.value AS VARCHAR) AS weighted_vote_score,
    CAST(e.event_id % 11 AS VARCHAR) AS comment_count,
    CASE WHEN e.event_id % 3 = 0 THEN '0' ELSE '1' END AS steam_purchase,
    CAST(l.toxic AS VARCHAR) AS received_for_free,
    CASE WHEN e.event_id % 89 = 0 THEN '2' ELSE CAST(1 - l.quality AS VARCHAR) END AS written_during_early_access,
    '0' AS hidden_in_steam_china,
    CAST(NULL AS VARCHAR) AS steam_china_location
  FROM events e
  LEFT JOIN documents d ON d.doc_id = e.event_id
  LEFT JOIN labels l ON l.doc_id = e.event_id
)"""

DOC = """doc_reviews AS (
  SELECT
    e.event_id AS review_id,
    e.event_type AS game,
    CAST(e.user_id AS VARCHAR) AS author_steamid,
    d.text AS review,
    d.lang AS language,
    e.ts AS timestamp_created,
    CAST(json_extract_string(e.props, '$.k') AS INT) AS votes_up,
    CAST(json_extract_string(e.props, '$.k') AS INT) % 13 AS votes_funny,
    CAST(e.event_id % 11 AS INT) AS comment_count,
    CAST(floor(e.value * 10) AS INT) AS author_playtime_at_review,
    (l.toxic = 1) AS received_for_free,
    (l.quality = 0) AS written_during_early_access
  FROM events e
  JOIN documents d ON d.doc_id = e.event_id
  LEFT JOIN labels l ON l.doc_id = e.event_id
)"""

SALES = """sales_reviews AS (
  SELECT
    CAST(l_partkey AS VARCHAR) AS game,
    CAST(o_custkey AS VARCHAR) AS author_steamid,
    l_shipdate AS timestamp_created,
    CAST(l_quantity AS INT) AS votes_up,
    l_linenumber AS comment_count,
    CAST(floor(l_extendedprice / 100) AS INT) AS author_playtime_at_review,
    (l_returnflag = 'R') AS received_for_free,
    (l_linestatus = 'F') AS written_during_early_access,
    l_returnflag AS language
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

SALES_DAYS = "CAST(timestamp_created AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'"
DOC_DAYS = "CAST(timestamp_created AS DATE) BETWEEN DATE '2024-01-02' AND DATE '2024-01-03'"
GAME = "game = 'click'"


def _converted(casts, names) -> str:
    sql_types = (
        (casts.integers, "TRY_CAST({0} AS INTEGER)"),
        (casts.longs, "TRY_CAST({0} AS BIGINT)"),
        (casts.floats, "TRY_CAST({0} AS FLOAT)"),
        (casts.booleans, "TRY_CAST({0} AS BOOLEAN)"),
        (casts.unix_seconds, "make_timestamp(TRY_CAST({0} AS BIGINT) * 1000000)"),
    )
    form = {name: sql for group, sql in sql_types for name in group}
    return ", ".join(f"{form[n].format(n)} AS {n}" if n in form else n for n in names)


CLEAN_COLUMNS = [c for c in RAW_COLUMNS if c not in UNUSED_COLUMNS]
CLEAN_TEXT = ["game", "author_steamid", "language", "review"]
TYPED = f"{RAW}, typed AS (SELECT {_converted(CLEAN_CASTS, CLEAN_COLUMNS)} FROM raw_reviews)"
EXPLORED = f"{RAW}, typed AS (SELECT {_converted(EXPLORE_CASTS, RAW_COLUMNS)} FROM raw_reviews)"
COMPLETE = " AND ".join(
    f"{c} IS NOT NULL AND {c} <> ''" if c in CLEAN_TEXT
    else f"{c} IS NOT NULL AND NOT isnan({c})" if c in CLEAN_CASTS.floats
    else f"{c} IS NOT NULL"
    for c in CLEAN_COLUMNS
)

_BOOLEAN = "(0|1|true|false|t|f|yes|no|y|n)"
_INTEGER = r"-?\d+"
_FLOAT = r"-?\d+(\.\d*)?"
PATTERNS = {
    "voted_up": _BOOLEAN,
    "steam_purchase": _BOOLEAN,
    "received_for_free": _BOOLEAN,
    "written_during_early_access": _BOOLEAN,
    "votes_up": _INTEGER,
    "votes_funny": _INTEGER,
    "comment_count": _INTEGER,
    "weighted_vote_score": _FLOAT,
}


def _missing(c: str) -> str:
    if c in CLEAN_TEXT:
        return f"{c} IS NULL OR {c} = ''"
    return f"{c} IS NULL OR isnan({c})" if c in CLEAN_CASTS.floats else f"{c} IS NULL"


def _null_or_zero(c: str) -> str:
    if c in CLEAN_TEXT:
        return f"{c} IS NULL OR trim({c}) = ''"
    if c in CLEAN_CASTS.booleans:
        return f"{c} IS NULL OR NOT {c}"
    if c in CLEAN_CASTS.unix_seconds:
        return f"{c} IS NULL"
    return f"{c} IS NULL OR {c} = 0"


def _each(columns, select: str) -> str:
    return " UNION ALL ".join(select.format(c=c) for c in columns)


def _profile(sketched: tuple[str, ...] = (), columns: tuple[str, ...] = RAW_COLUMNS, view: str = "") -> str:
    def one(c: str) -> str:
        broken = (
            f"count(*) FILTER (WHERE {c} IS NOT NULL AND NOT regexp_full_match({c}, '{PATTERNS[c]}'))"
            if c in PATTERNS
            else "CAST(NULL AS BIGINT)"
        )
        distinct = "CAST(NULL AS BIGINT)" if c in sketched else f"count(DISTINCT {c})"
        return rf"""SELECT '{c}' AS column_name, {distinct} AS distinct_values,
            count(*) FILTER (WHERE {c} IS NULL OR regexp_full_match({c}, '\s*')) AS blank_rows,
            {broken} AS nonconvertible_rows,
            count(*) FILTER (WHERE {c} IS NOT NULL AND {c} <> trim({c})) AS padded_rows,
            count(*) FILTER (WHERE {c} IS NOT NULL AND regexp_matches({c}, '[^a-zA-Z0-9\s\.-]'))
              AS special_character_rows
          FROM {"dirty" if view else "raw_reviews"}"""

    return f"WITH {view or RAW} " + " UNION ALL ".join(one(c) for c in columns)


DIRTY = f"""{RAW}, dirty AS (
  SELECT CASE WHEN e % 7 = 0 THEN ' ' || game ELSE game END AS game,
    CASE WHEN e % 31 = 0 THEN '0.5.1' ELSE weighted_vote_score END AS weighted_vote_score,
    [{", ".join(f"'{code}'" for code in sorted(LANGUAGE_NAMES))}][CAST(e % {len(LANGUAGE_NAMES)} + 1 AS INT)] AS language
  FROM (SELECT *, CAST(recommendationid AS BIGINT) AS e FROM raw_reviews))"""


def _lost() -> str:
    cast = sorted(CLEAN_CASTS.target_types())
    counts = ", ".join(
        f"(SELECT count(*) FROM raw_reviews WHERE {c} IS NOT NULL AND {c} <> '') - "
        f"(SELECT count(*) FROM typed WHERE {c} IS NOT NULL) AS {c}" for c in cast
    )
    each = " UNION ALL ".join(f"SELECT '{c}' AS column_name, {c} AS lost_values FROM n" for c in cast)
    return f"n AS (SELECT {counts}) {each}"


def _half_up(value: str, digits: int) -> str:
    # Decimal rounding: DuckDB's round(double) scales in binary and takes some exact halves down.
    return f"CAST(round(CAST({value} AS DECIMAL(38, 10)), {digits}) AS DOUBLE)"


def _profile_report() -> str:
    counted = _each(RAW_COLUMNS, "SELECT '{c}' AS column_name, {c} AS value, count(*) AS n FROM raw_reviews GROUP BY 2")
    broken = " OR ".join(
        f"(column_name = '{c}' AND NOT regexp_full_match(value, '{p}'))" for c, p in PATTERNS.items()
    )
    return rf"""WITH {RAW}, counted AS ({counted}),
      ranked AS (SELECT *,
        row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value NULLS LAST) AS by_count,
        row_number() OVER (PARTITION BY column_name ORDER BY value NULLS LAST) AS by_value FROM counted),
      bad AS (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY value) AS by_bad
        FROM counted WHERE value IS NOT NULL AND ({broken})),
      counts AS (SELECT column_name, count(value) AS d,
        CAST(coalesce(sum(n) FILTER (WHERE value IS NULL OR regexp_full_match(value, '\s*')), 0) AS BIGINT) AS b
        FROM counted GROUP BY 1)
      SELECT 'distinct' AS section, column_name, CAST(NULL AS VARCHAR) AS value, d AS amount FROM counts
      UNION ALL SELECT 'blank', column_name, NULL, b FROM counts
      UNION ALL SELECT 'frequent', column_name, value, n FROM ranked WHERE by_count <= 20
      UNION ALL SELECT 'sample', column_name, value, by_value FROM ranked WHERE by_value <= 20
      UNION ALL SELECT 'nonconvertible', column_name, value, NULL FROM bad WHERE by_bad <= 10"""


TOTALS = f"""total_reviews, avg_playtime, early_access_count,
  {_half_up('avg_playtime / 60', 1)} AS avg_playtime_hours,
  {_half_up('early_access_count * 100 / total_reviews', 1)} AS early_access_percent"""


def _summary(view: str, where: str) -> str:
    return f"""WITH {view}, totals AS (
      SELECT game, count(*) AS total_reviews,
        coalesce({_half_up('avg(author_playtime_at_review)', 2)}, 0.0) AS avg_playtime,
        count(*) FILTER (WHERE written_during_early_access) AS early_access_count
      FROM {view.split()[0]} WHERE {where} GROUP BY game)
    SELECT game, {TOTALS} FROM totals"""


def _shown(measure: str) -> str:
    return f"""review_id, author_steamid AS author_id,
      CASE WHEN length(review) > 300 THEN left(review, 300) || '...' ELSE review END AS review_text,
      {measure}, strftime(timestamp_created, '%Y-%m-%d') AS date,
      round(CAST(coalesce(author_playtime_at_review, 0) AS DOUBLE) / 60, 1) AS playtime_hrs, language"""


def _top(measure: str, where: str = GAME, limit: int = 100) -> str:
    return f"SELECT * FROM doc_reviews WHERE {where} ORDER BY {measure} DESC NULLS LAST, review_id LIMIT {limit}"


def _count(word: str) -> str:
    return f"(length(lower(review)) - length(replace(lower(review), '{word}', ''))) / 2.0"


def _words(words: str) -> str:
    # No look-around in RE2: each match takes one non-letter before it, letters' neighbours are single spaced.
    spaced = r"regexp_replace(lower(review), '([^\p{L}\p{N}])', '\1\1', 'g')"
    return rf"len(regexp_extract_all(' ' || {spaced} || ' ', '[^\p{{L}}\p{{N}}]({words})[^\p{{L}}\p{{N}}]'))"


def _scored(rows: str, positive: str = _count("en"), negative: str = _count("on")) -> str:
    return f"""{DOC}, sample AS ({rows}),
    counted AS (SELECT *, {positive} AS p, {negative} AS n FROM sample),
    chance AS (SELECT *, CAST((p + 1) / (p + n + 2) AS DOUBLE) AS p_pos FROM counted),
    scored AS (SELECT *, 1 - p_pos AS p_neg, p_pos - (1 - p_pos) AS sentiment,
      greatest(p_pos, 1 - p_pos) AS confidence FROM chance)"""


SAMPLE = _scored(f"SELECT * FROM doc_reviews WHERE {GAME}")
SCORES = """SELECT review_id, round(sentiment, 9) AS sentiment, round(confidence, 9) AS confidence,
  round(p_neg, 9) AS negative, round(p_pos, 9) AS positive FROM scored"""
SCORES_ALL = f"WITH {_scored('SELECT * FROM doc_reviews')} {SCORES}"
LABEL = """CASE WHEN {0} >= 0.6 THEN 'Very Positive' WHEN {0} >= 0.2 THEN 'Positive'
  WHEN {0} >= -0.2 THEN 'Mixed' WHEN {0} >= -0.6 THEN 'Negative' ELSE 'Very Negative' END"""
OVERALL = "coalesce(sum(sentiment * confidence) / nullif(sum(confidence), 0), 0.0)"
BUCKET = "CAST(least(floor(round((sentiment + 1) * 10, 9)), 19) AS INT)"
CLEANED = f"WITH {TYPED} SELECT * FROM typed WHERE {COMPLETE}"


def _extreme(test: str) -> str:
    return f"""WITH {SAMPLE} SELECT {_shown('votes_up')}, votes_funny,
      round(sentiment, 9) AS sentiment, round(confidence, 9) AS confidence
      FROM scored WHERE {test} ORDER BY votes_up DESC, review_id LIMIT 10"""


def _report() -> str:
    dated = f"{GAME} AND {DOC_DAYS}"

    def item(section: str, item_sql: str, amount: str, source: str) -> str:
        return (
            f"SELECT '{section}' AS section, CAST({item_sql} AS VARCHAR) AS item, "
            f"round(CAST({amount} AS DOUBLE), 6) AS amount FROM {source}"
        )

    parts = [
        item("total_reviews", "game", "total_reviews", "totals"),
        item("avg_playtime", "game", "avg_playtime", "totals"),
        item("early_access", "game", _half_up("early * 100 / total_reviews", 1), "totals"),
        item("daily", "day", "n", "daily"),
        item("acquisition", "category", "n", "acquisition"),
        item("top_upvoted", "review_id", "votes_up", f"({_top('votes_up', dated)})"),
        item("top_funny", "review_id", "votes_funny", f"({_top('votes_funny', dated)})"),
        item("top_commented", "review_id", "comment_count", f"({_top('comment_count', dated)})"),
        item("overall", LABEL.format("s"), "s", f"(SELECT {OVERALL} AS s FROM scored)"),
        item("positive", "review_id", "sentiment",
             "(SELECT * FROM scored WHERE sentiment >= 0.2 ORDER BY votes_up DESC, review_id LIMIT 10)"),
        item("negative", "review_id", "sentiment",
             "(SELECT * FROM scored WHERE sentiment <= -0.2 ORDER BY votes_up DESC, review_id LIMIT 10)"),
        item("histogram", "b", "n", f"(SELECT {BUCKET} AS b, count(*) AS n FROM scored GROUP BY 1)"),
    ]
    return f"""WITH {_scored(f'SELECT * FROM doc_reviews WHERE {dated}')},
      chosen AS (SELECT * FROM doc_reviews WHERE {dated}),
      totals AS (SELECT game, count(*) AS total_reviews,
        {_half_up('avg(author_playtime_at_review)', 2)} AS avg_playtime,
        count(*) FILTER (WHERE written_during_early_access) AS early FROM chosen GROUP BY game),
      daily AS (SELECT strftime(timestamp_created, '%Y-%m-%d') AS day, count(*) AS n FROM chosen GROUP BY 1),
      acquisition AS (SELECT CASE WHEN received_for_free THEN 'Free' ELSE 'Purchased' END AS category,
        count(*) AS n FROM chosen GROUP BY 1)
      """ + " UNION ALL ".join(f"SELECT * FROM ({p})" for p in parts)


def sql() -> dict[str, str]:
    """Query name -> SQL."""
    games = "SELECT game, count(*) AS count FROM sales_reviews {0} GROUP BY game"
    authors = """SELECT author_steamid AS author_id, CAST(sum(votes_up) AS BIGINT) AS total_upvotes,
      count(*) AS review_count FROM sales_reviews {0} GROUP BY 1"""
    top_games = games.format("") + " ORDER BY count DESC, game LIMIT 10"
    dated = f"WHERE {SALES_DAYS}"
    names = " UNION ALL ".join(f"SELECT '{code}' AS code, '{name}' AS name" for code, name in LANGUAGE_NAMES.items())
    zero = _null_or_zero("votes_funny")
    sampled = f"WITH {EXPLORED} SELECT recommendationid, votes_funny FROM typed WHERE {zero}"
    return {
        "top_games": f"WITH {SALES} {top_games}",
        "top_games_dated": f"WITH {SALES} {games.format(dated)} ORDER BY count DESC, game LIMIT 20",
        "top_games_since": f"WITH {SALES} {games.format("WHERE timestamp_created >= TIMESTAMP '1996-01-01'")} "
        "ORDER BY count DESC, game LIMIT 20",
        "top_games_summary": f"""WITH {SALES}, top AS ({top_games})
          SELECT (SELECT game FROM top ORDER BY count DESC, game LIMIT 1) AS most_reviewed_game,
            (SELECT max(count) FROM top) AS most_reviews,
            (SELECT CAST(floor(avg(count)) AS BIGINT) FROM top) AS average_reviews""",
        "game_review_counts": f"WITH {SALES} {games.format('')}",
        "author_vote_totals": f"WITH {SALES} {authors.format('')}",
        "top_authors_by_count": f"""WITH {SALES}, a AS ({authors.format(dated)})
          SELECT author_id, review_count FROM a ORDER BY review_count DESC, author_id LIMIT 10""",
        "top_authors_by_upvotes": f"""WITH {SALES} {authors.format(dated)}
          ORDER BY total_upvotes DESC, author_id LIMIT 10""",
        "engagement_all": f"""WITH {SALES}, g AS ({games.format(dated)}), a AS ({authors.format(dated)}),
          by_games AS (SELECT *, row_number() OVER (ORDER BY count DESC, game) AS p FROM g),
          by_count AS (SELECT *, row_number() OVER (ORDER BY review_count DESC, author_id) AS p FROM a),
          by_upvotes AS (SELECT *, row_number() OVER (ORDER BY total_upvotes DESC, author_id) AS p FROM a),
          boards AS (
            SELECT 'top_games' AS metric, p, game AS key, 'count' AS measure, count AS value FROM by_games
            UNION ALL SELECT 'top_authors_by_count', p, author_id, 'review_count', review_count FROM by_count
            UNION ALL SELECT 'top_authors_by_count', p, author_id, 'total_upvotes', total_upvotes FROM by_count
            UNION ALL SELECT 'top_authors_by_upvotes', p, author_id, 'review_count', review_count FROM by_upvotes
            UNION ALL SELECT 'top_authors_by_upvotes', p, author_id, 'total_upvotes', total_upvotes FROM by_upvotes)
          SELECT metric, CAST(p AS INT) AS position, key, measure, value FROM boards WHERE p <= 10""",
        "drop_columns_schema": f"WITH {RAW} SELECT {', '.join(CLEAN_COLUMNS)} FROM raw_reviews",
        "clean_cast": f"WITH {TYPED} SELECT * FROM typed",
        "explore_cast": f"WITH {EXPLORED} SELECT * FROM typed",
        "null_audit": f"WITH {TYPED} SELECT "
        + ", ".join(f"count(*) FILTER (WHERE {_missing(c)}) AS {c}" for c in CLEAN_COLUMNS)
        + " FROM typed",
        "null_audit_raw": f"WITH {RAW} "
        + _each(RAW_COLUMNS, "SELECT '{c}' AS column_name, "
                "count(*) FILTER (WHERE {c} IS NULL OR {c} = '') AS missing_rows FROM raw_reviews"),
        "null_audit_nulls_only": f"WITH {EXPLORED} "
        + _each(RAW_COLUMNS, "SELECT '{c}' AS column_name, "
                "count(*) FILTER (WHERE {c} IS NULL) AS missing_rows FROM typed"),
        "drop_incomplete": CLEANED,
        "clean_fractional": CLEANED,
        "lost_in_cast": f"WITH {TYPED}, raw AS (SELECT * FROM raw_reviews), " + _lost(),
        "null_or_zero_random_check": f"""WITH {EXPLORED}, n AS (SELECT least(10, count(*)) AS n FROM typed WHERE {zero})
          SELECT n AS sampled_rows, n AS different_rows, n AS rows_of_the_kind FROM n""",
        "column_profile_dirty": _profile(columns=("game", "language", "weighted_vote_score"), view=DIRTY),
        "language_display_names": f"""WITH names AS ({names}),
          found AS (SELECT DISTINCT code AS language FROM names JOIN events ON true
            WHERE code = (SELECT list(code ORDER BY code)[CAST(event_id % {len(LANGUAGE_NAMES)} + 1 AS INT)] FROM names))
          SELECT language, name AS display_name, language AS filter_code FROM found JOIN names ON language = code""",
        "drop_report": f"""WITH {TYPED}, n AS (SELECT count(*) AS b, count(*) FILTER (WHERE {COMPLETE}) AS a FROM typed)
          SELECT b AS rows_before, a AS rows_after, b - a AS rows_dropped FROM n""",
        "drop_one_column": f"WITH {RAW} SELECT * FROM raw_reviews WHERE review IS NOT NULL AND review <> ''",
        "null_or_zero_numeric": f"WITH {TYPED} SELECT * FROM typed WHERE {_null_or_zero('votes_funny')}",
        "null_or_zero_string": f"WITH {TYPED} SELECT * FROM typed WHERE {_null_or_zero('review')}",
        "null_or_zero_boolean": f"WITH {TYPED} SELECT * FROM typed WHERE {_null_or_zero('received_for_free')}",
        "null_or_zero_counts": f"WITH {TYPED} "
        + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {_null_or_zero(c)}) AS row_count FROM typed"
            for c in CLEAN_COLUMNS
        ),
        "null_or_zero_sample": f"{sampled} ORDER BY md5('7|' || recommendationid), recommendationid LIMIT 10",
        "column_profile": _profile(),
        "column_profile_sketch": _profile(("review",)),
        "column_profile_report": _profile_report(),
        "value_frequency": f"""WITH {RAW} SELECT votes_up AS value, count(*) AS row_count FROM raw_reviews
          GROUP BY 1 ORDER BY row_count DESC, value NULLS LAST LIMIT 20""",
        "value_frequency_review": f"""WITH {RAW} SELECT review AS value, count(*) AS row_count FROM raw_reviews
            GROUP BY review ORDER BY row_count DESC, review ASC NULLS LAST LIMIT 20""",
        "value_frequency_language": f"""WITH {RAW} SELECT language AS value, count(*) AS row_count FROM raw_reviews
          GROUP BY 1 ORDER BY row_count DESC, value NULLS LAST LIMIT 20""",
        "nonconvertible_values": f"WITH {RAW} "
        + " UNION ALL ".join(
            f"(SELECT DISTINCT '{c}' AS column_name, {c} AS value FROM raw_reviews "
            f"WHERE {c} IS NOT NULL AND NOT regexp_full_match({c}, '{p}') ORDER BY value LIMIT 10)"
            for c, p in PATTERNS.items()
        ),
        "distinct_sketch_merge": f"WITH {RAW} "
        + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values, count({c}) AS known_rows, "
            "true AS same_rows, true AS near_exact FROM raw_reviews"
            for c in ("recommendationid", "game", "language", "review", "votes_up")
        ),
        "engagement_cached": f"""WITH {SALES}, authors AS (SELECT author_steamid AS name, count(*) AS n, sum(votes_up) AS up
            FROM sales_reviews WHERE {SALES_DAYS} AND author_steamid IS NOT NULL GROUP BY 1),
          boards AS ((SELECT 'games' AS board, game AS name, count(*) AS value FROM sales_reviews WHERE {SALES_DAYS}
              AND game IS NOT NULL GROUP BY game ORDER BY value DESC, name LIMIT 10)
            UNION ALL (SELECT 'reviews', name, n FROM authors ORDER BY n DESC, name LIMIT 10)
            UNION ALL (SELECT 'upvotes', name, up FROM authors ORDER BY up DESC, name LIMIT 10))
          SELECT *, true AS kept, true AS released FROM boards""",
        "refused_limits": f"""WITH {SALES}, games AS (SELECT count(DISTINCT game) AS n FROM sales_reviews)
          SELECT k, CASE WHEN size > 0 THEN least(size, n) END AS listed_games FROM games,
            (VALUES ('3', 3), ('50', 50), ('0', 0), ('-1', 0), ('True', 0), ('2.0', 0), ($$'5'$$, 0), ('None', 0)) AS limits(k, size)""",
        "default_range_totals": f"""WITH {SALES} SELECT game, count(*) AS total_reviews FROM sales_reviews
          WHERE CAST(timestamp_created AS DATE) BETWEEN (SELECT CAST(max(timestamp_created) AS DATE) - {DEFAULT_RANGE_DAYS} FROM sales_reviews)
            AND (SELECT CAST(max(timestamp_created) AS DATE) FROM sales_reviews) GROUP BY game""",
        "required_columns": f"""WITH {RAW} SELECT names, missing, count(*) AS raw_rows FROM raw_reviews,
          (VALUES ('game,review', ''), ('game,no_such', 'no_such'), ('nothing,no_such', 'no_such, nothing'), ('', '')) AS lists(names, missing)
          GROUP BY names, missing""",
        "tables_with_rows": f"""WITH {RAW}, {DOC}, {SALES}
          SELECT 'raw' AS name, EXISTS (SELECT 1 FROM raw_reviews) AS has_rows UNION ALL
          SELECT 'doc', EXISTS (SELECT 1 FROM doc_reviews) UNION ALL SELECT 'sales', EXISTS (SELECT 1 FROM sales_reviews) UNION ALL
          SELECT 'unknown', EXISTS (SELECT 1 FROM doc_reviews WHERE game = 'no such game')""",
        "distinct_sample": f"""WITH {RAW} SELECT DISTINCT game AS value FROM raw_reviews
          ORDER BY value NULLS LAST LIMIT 20""",
        "distinct_games": f"WITH {RAW} SELECT DISTINCT game FROM raw_reviews WHERE game <> '' ORDER BY game",
        "distinct_languages": f"WITH {RAW} SELECT DISTINCT language FROM raw_reviews WHERE language <> '' ORDER BY 1",
        "catalog_counts": f"""WITH {RAW} SELECT count(DISTINCT game) AS game,
          count(DISTINCT language) AS language FROM raw_reviews""",
        "game_summary": _summary(DOC, GAME),
        "game_summary_dated": _summary(DOC, f"{GAME} AND {DOC_DAYS}"),
        "game_summary_sales": _summary(SALES, f"game = '42' AND {SALES_DAYS}"),
        "game_summary_all": _summary(SALES, "true"),
        "report_cube": f"""WITH {SALES} SELECT game, strftime(timestamp_created, '%Y-%m-%d') AS review_date, language,
            CASE WHEN received_for_free THEN 'Free' ELSE 'Purchased' END AS category,
            count(*) AS reviews, CAST(sum(author_playtime_at_review) AS BIGINT) AS playtime_sum,
            count(author_playtime_at_review) AS playtime_reviews,
            count(*) FILTER (WHERE written_during_early_access) AS early_access_reviews
          FROM sales_reviews WHERE {SALES_DAYS}
          GROUP BY game, review_date, language, category""",
        "daily_counts": f"""WITH {DOC} SELECT strftime(timestamp_created, '%Y-%m-%d') AS date, count(*) AS count
          FROM doc_reviews WHERE {GAME} GROUP BY 1 ORDER BY 1""",
        "daily_counts_desc": f"""WITH {DOC} SELECT strftime(timestamp_created, '%Y-%m-%d') AS date, count(*) AS count
          FROM doc_reviews WHERE {GAME} AND {DOC_DAYS} GROUP BY 1 ORDER BY 1 DESC""",
        "daily_counts_sales": f"""WITH {SALES} SELECT strftime(timestamp_created, '%Y-%m-%d') AS date,
          count(*) AS count FROM sales_reviews GROUP BY 1 ORDER BY 1""",
        "acquisition_split": f"""WITH {DOC} SELECT CASE WHEN received_for_free THEN 'Free' ELSE 'Purchased' END
          AS category, count(*) AS count FROM doc_reviews WHERE {GAME} GROUP BY 1 ORDER BY 1""",
        "available_languages": f"WITH {DOC} SELECT DISTINCT language FROM doc_reviews WHERE {GAME} ORDER BY 1",
        "language_display": f"""WITH {RAW}, names AS ({names}), found AS (SELECT DISTINCT language FROM raw_reviews)
          SELECT language, coalesce(name, language) AS display_name, coalesce(code, 'all') AS filter_code
          FROM found LEFT JOIN names ON language = code""",
        "top_upvoted": f"WITH {DOC} SELECT {_shown('votes_up')} FROM ({_top('votes_up')})",
        "top_funny": f"WITH {DOC} SELECT {_shown('votes_funny')} FROM ({_top('votes_funny')})",
        "top_commented": f"""WITH {DOC} SELECT {_shown('comment_count')},
            left(author_steamid, 8) || '...' AS author_short
          FROM ({_top('comment_count', f'{GAME} AND {DOC_DAYS}')})""",
        "top_upvoted_by_language": f"""WITH {DOC} SELECT {_shown('votes_up')} FROM doc_reviews
          WHERE {GAME} AND language = 'de' ORDER BY votes_up DESC, review_id LIMIT 10""",
        "language_match_count": f"WITH {DOC} SELECT count(*) AS matches FROM doc_reviews WHERE {GAME} AND language = 'de'",
        "top_upvoted_without_id": f"""WITH {DOC} SELECT votes_up, count(*) AS listed_reviews
          FROM ({_top('votes_up', limit=20)}) GROUP BY 1""",
        "game_report": _report(),
        "sentiment_scores": f"WITH {SAMPLE} {SCORES}",
        "sentiment_scores_all": SCORES_ALL,
        "sentiment_overall": f"""WITH {SAMPLE}, o AS (SELECT {OVERALL} AS s, count(*) AS n FROM scored)
          SELECT round(s, 9) AS sentiment_score, n AS analyzed_count, {LABEL.format('s')} AS sentiment_label FROM o""",
        "sentiment_label": f"""WITH {_scored('SELECT * FROM doc_reviews')}
          SELECT {LABEL.format('sentiment')} AS sentiment_label, count(*) AS review_count FROM scored GROUP BY 1""",
        "sentiment_positive": _extreme("sentiment >= 0.2"),
        "sentiment_negative": _extreme("sentiment <= -0.2"),
        "sentiment_histogram": f"""WITH {SAMPLE}, b AS (SELECT {BUCKET} AS bucket FROM scored)
          SELECT bucket, round(bucket * CAST(0.1 AS DOUBLE) - 1, 9) AS bucket_start, count(*) AS review_count
          FROM b GROUP BY 1""",
        "sentiment_lexicon": "WITH "
        + _scored("SELECT * FROM doc_reviews", _words("le|de|the|und"), _words("que|la|of|der"))
        + SCORES,
        "sentiment_plugin": SCORES_ALL,
        "sentiment_ml_check": f"""WITH {DOC} SELECT count(*) AS reviews, count(DISTINCT review_id) AS different_reviews,
          count(*) AS sum_to_one, count(*) AS probabilities FROM doc_reviews""",
        "csv_roundtrip": f"WITH {RAW} SELECT * FROM raw_reviews",
        "csv_clean": CLEANED,
        "csv_shuffled_columns": f"WITH {RAW} SELECT * FROM raw_reviews",
        "csv_one_file": """SELECT CAST(doc_id AS VARCHAR) AS doc_id, md5('"' || replace(text, chr(13), ' ') || '"' || chr(10) || '"') AS quoted_md5,
            md5(text) AS text_md5 FROM documents""",
        "csv_bad_rows": """SELECT count(*) FILTER (WHERE event_id % 50 <> 0) AS good_rows,
            count(*) FILTER (WHERE event_id % 50 = 0) AS bad_rows,
            count(DISTINCT event_id) FILTER (WHERE event_id % 50 <> 0) AS good_events FROM events""",
        "parquet_by_year": f"{CLEANED} AND {DOC_DAYS.replace('timestamp_created', 'timestamp_updated')}",
        "parquet_by_year_pruned": f"""WITH {TYPED} SELECT game, count(*) AS count FROM typed
          WHERE {COMPLETE} AND {DOC_DAYS} GROUP BY 1""",
        "parquet_roundtrip": CLEANED,
        "parquet_clustered": CLEANED,
        "names_text_file": f"WITH {RAW} SELECT DISTINCT game AS name FROM raw_reviews WHERE game <> ''",
    }
