"""The same results in SQL, written from the rules and not from the Spark plans."""

from __future__ import annotations

from verification.queries import mart_view

AS_OF = "TIMESTAMP '2001-06-01 00:00:00'"
INGESTED = "TIMESTAMP '2024-06-01 00:00:00'"

# --- tables as common table expressions; each may use those before it ----------

CTES = {
    "movies_raw": """
        SELECT CAST(p_partkey AS INTEGER) AS movie_id,
               CASE WHEN p_partkey % 41 = 0 THEN NULL
                    WHEN p_partkey % 37 = 0 THEN p_name
                    WHEN p_partkey % 43 = 0 THEN p_name || ' (1700)'
                    ELSE p_name || ' (' || CAST(1950 + p_size AS VARCHAR) || ')' END AS title,
               CASE WHEN p_partkey % 29 = 0 THEN NULL
                    WHEN p_partkey % 31 = 0 THEN '(no genres listed)'
                    ELSE p_type || '| ' || split_part(p_name, ' ', 2) || '|' || p_type END AS genres
        FROM part""",
    "movies_cleaned": f"""
        SELECT movie_id, trim(regexp_extract(title, '^(.*)\\s\\(\\d{{4}}\\)$', 1)) AS title,
               TRY_CAST(regexp_extract(title, '\\((\\d{{4}})\\)', 1) AS INTEGER) AS release_year,
               coalesce(genres, 'unknown') AS genres_raw,
               {INGESTED} AS ingestion_timestamp, 'postgres' AS source
        FROM movies_raw
        WHERE trim(regexp_extract(title, '^(.*)\\s\\(\\d{{4}}\\)$', 1)) <> ''
          AND TRY_CAST(regexp_extract(title, '\\((\\d{{4}})\\)', 1) AS INTEGER) BETWEEN 1888 AND 2028""",
    "movie_genres": """
        SELECT DISTINCT movie_id, genre
        FROM (SELECT movie_id, lower(trim(unnest(string_split(genres_raw, '|')))) AS genre FROM movies_cleaned)
        WHERE genre <> '' AND genre <> '(no genres listed)'""",
    "ratings_cleaned": f"""
        SELECT user_id, movie_id, rating, event_timestamp, ingestion_timestamp,
               'kafka' AS source_system, 'csv-ratings_for_additional_users' AS source_topic
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id, movie_id, event_timestamp
                        ORDER BY ingestion_timestamp DESC, rating DESC NULLS LAST) AS n
              FROM (SELECT CAST(o_custkey AS INTEGER) AS user_id, CAST(l_partkey AS INTEGER) AS movie_id,
                           CASE WHEN l_quantity / 10 >= 0.5 AND l_quantity / 10 <= 5.0
                                THEN l_quantity / 10 END AS rating,
                           CAST(l_shipdate AS TIMESTAMP) AS event_timestamp,
                           {INGESTED} + to_seconds(l_linenumber) AS ingestion_timestamp
                    FROM lineitem JOIN orders ON l_orderkey = o_orderkey))
        WHERE n = 1""",
    "rating_features": f"""
        SELECT user_id, movie_id, rating,
               CASE WHEN rating <= 2.5 THEN 'low' WHEN rating <= 3.5 THEN 'medium' ELSE 'high' END
                   AS rating_category,
               rating >= 4 AS is_positive,
               CASE WHEN rating BETWEEN 0.5 AND 1.5 THEN 'very_low' WHEN rating BETWEEN 1.5 AND 2.5 THEN 'low'
                    WHEN rating BETWEEN 2.5 AND 3.5 THEN 'mid' WHEN rating BETWEEN 3.5 AND 4.5 THEN 'high'
                    WHEN rating BETWEEN 4.5 AND 5.0 THEN 'top' END AS rating_bucket,
               event_timestamp, CAST(event_timestamp AS DATE) AS event_date,
               CAST(date_diff('day', CAST(event_timestamp AS DATE), CAST({AS_OF} AS DATE)) AS INTEGER)
                   AS recency_days
        FROM ratings_cleaned""",
    "belief_cleaned": f"""
        SELECT user_id, movie_id, is_seen, watch_date, user_rating, predicted_rating, user_certainty,
               system_rating, event_timestamp, movie_idx, source_type, ingestion_timestamp,
               'postgres' AS source_system
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id, movie_id, event_timestamp
                        ORDER BY ingestion_timestamp DESC, is_seen DESC NULLS LAST, watch_date DESC NULLS LAST,
                                 user_rating DESC NULLS LAST, predicted_rating DESC NULLS LAST,
                                 user_certainty DESC NULLS LAST, system_rating DESC NULLS LAST,
                                 movie_idx DESC NULLS LAST, source_type DESC NULLS LAST) AS n
              FROM (SELECT CAST(o_custkey AS INTEGER) AS user_id, CAST(l_partkey AS INTEGER) AS movie_id,
                           CASE WHEN l_linenumber % 3 <> 0 THEN CAST(l_linenumber % 3 - 1 AS INTEGER) END AS is_seen,
                           CASE WHEN l_linenumber % 3 = 2 THEN CAST(l_shipdate AS DATE) END AS watch_date,
                           CASE WHEN l_linenumber % 3 = 2 THEN l_quantity / 10 END AS user_rating,
                           CASE WHEN l_linenumber % 3 <> 2 THEN l_quantity / 10 END AS predicted_rating,
                           CASE WHEN l_linenumber % 5 <> 0 THEN CAST(l_linenumber % 5 + 1 AS DOUBLE) END
                               AS user_certainty,
                           l_discount * 50 AS system_rating,
                           CAST(l_shipdate AS TIMESTAMP) AS event_timestamp,
                           CAST(l_suppkey AS INTEGER) AS movie_idx,
                           CAST(l_linenumber % 5 + 1 AS INTEGER) AS source_type,
                           {INGESTED} + to_seconds(l_linenumber) AS ingestion_timestamp
                    FROM lineitem JOIN orders ON l_orderkey = o_orderkey))
        WHERE n = 1""",
    "belief_features": """
        SELECT user_id, movie_id, is_seen, is_seen = 1 AS has_watched, user_rating, system_rating,
               round(user_rating - system_rating, 4) AS rating_diff, user_certainty,
               user_certainty >= 4 AS is_high_confidence, event_timestamp,
               CAST(event_timestamp AS DATE) AS event_date
        FROM belief_cleaned""",
    "elicitation_cleaned": f"""
        SELECT movie_id, month_idx, source_type, event_timestamp, {INGESTED} AS ingestion_timestamp,
               'postgres' AS source_system
        FROM (SELECT *, row_number() OVER (PARTITION BY movie_id, event_timestamp
                        ORDER BY month_idx DESC NULLS LAST, source_type DESC NULLS LAST) AS n
              FROM (SELECT CAST(o_custkey AS INTEGER) AS movie_id,
                           CASE WHEN o_orderkey % 12 >= 1 THEN CAST(o_orderkey % 12 - 1 AS INTEGER) END AS month_idx,
                           CASE WHEN o_orderkey % 7 BETWEEN 1 AND 5 THEN CAST(o_orderkey % 7 AS INTEGER) END
                               AS source_type,
                           CAST(o_orderdate AS TIMESTAMP) AS event_timestamp
                    FROM orders))
        WHERE n = 1""",
    "elicitation_features": f"""
        SELECT movie_id, month_idx, source_type,
               CASE source_type WHEN 1 THEN 'popular' WHEN 2 THEN 'well_rated' WHEN 3 THEN 'recent_popular'
                                WHEN 4 THEN 'trending' WHEN 5 THEN 'serendipity' END AS source_category,
               CASE WHEN month_idx IS NULL THEN 'unknown' WHEN month_idx <= 2 THEN 'early_stage'
                    WHEN month_idx <= 6 THEN 'mid_stage' ELSE 'late_stage' END AS month_group,
               event_timestamp, CAST(event_timestamp AS DATE) AS event_date,
               event_timestamp >= {AS_OF} - INTERVAL 365 DAY AS is_recent
        FROM elicitation_cleaned""",
    "recommendation_history_cleaned": f"""
        SELECT user_id, movie_id, predicted_rating, event_timestamp, {INGESTED} AS ingestion_timestamp,
               'kafka' AS source_system, 'csv-user_recommendation_history' AS source_topic
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id, movie_id, event_timestamp
                        ORDER BY predicted_rating DESC NULLS LAST) AS n
              FROM (SELECT CAST(user_id AS INTEGER) AS user_id,
                           CAST(json_extract_string(props, '$.k') AS INTEGER) AS movie_id,
                           CASE WHEN value / 50 >= 0 AND value / 50 <= 5 THEN value / 50 END AS predicted_rating,
                           date_trunc('second', CAST(ts AS TIMESTAMP)) AS event_timestamp
                    FROM events))
        WHERE n = 1""",
    "recommendation_features": """
        SELECT user_id, movie_id, predicted_rating,
               CASE WHEN predicted_rating <= 2.5 THEN 'low' WHEN predicted_rating <= 3.5 THEN 'medium'
                    ELSE 'high' END AS predicted_rating_category,
               predicted_rating >= 4 AS is_high_score,
               CASE WHEN predicted_rating BETWEEN 0.0 AND 1.5 THEN 'very_low'
                    WHEN predicted_rating BETWEEN 1.5 AND 2.5 THEN 'low'
                    WHEN predicted_rating BETWEEN 2.5 AND 3.5 THEN 'mid'
                    WHEN predicted_rating BETWEEN 3.5 AND 4.5 THEN 'high'
                    WHEN predicted_rating BETWEEN 4.5 AND 5.0 THEN 'top' END AS predicted_rating_bucket,
               event_timestamp, CAST(event_timestamp AS DATE) AS event_date
        FROM recommendation_history_cleaned""",
    "stg_movies": """
        SELECT movie_id, title, release_year, genres_raw, ingestion_timestamp FROM movies_cleaned
        WHERE movie_id IS NOT NULL AND title IS NOT NULL""",
    "stg_movie_genres": """
        SELECT movie_id, genre FROM movie_genres
        WHERE movie_id IS NOT NULL AND genre IS NOT NULL AND genre <> '(no genres listed)'""",
    "stg_ratings": """
        SELECT user_id, movie_id, rating, event_timestamp, CAST(event_timestamp AS DATE) AS event_date,
               ingestion_timestamp, source_system, source_topic
        FROM ratings_cleaned WHERE user_id IS NOT NULL AND movie_id IS NOT NULL AND rating IS NOT NULL""",
    "stg_belief": "SELECT * FROM belief_cleaned WHERE user_id IS NOT NULL AND movie_id IS NOT NULL",
    "stg_belief_features": "SELECT * FROM belief_features WHERE user_id IS NOT NULL AND movie_id IS NOT NULL",
    "stg_movie_elicitation": "SELECT * FROM elicitation_cleaned WHERE movie_id IS NOT NULL",
    "stg_elicitation_features": "SELECT * FROM elicitation_features WHERE movie_id IS NOT NULL",
    "stg_recommendation_history": """
        SELECT * FROM recommendation_history_cleaned WHERE user_id IS NOT NULL AND movie_id IS NOT NULL""",
    "stg_recommendation_features": """
        SELECT * FROM recommendation_features WHERE user_id IS NOT NULL AND movie_id IS NOT NULL""",
    "int_movie_metrics": """
        SELECT a.movie_id, m.title, m.release_year, a.total_ratings, a.avg_rating
        FROM (SELECT movie_id, count(*) AS total_ratings, avg(CAST(rating AS DECIMAL(6, 2))) AS avg_rating
              FROM stg_ratings GROUP BY movie_id) a
        LEFT JOIN stg_movies m ON a.movie_id = m.movie_id
        WHERE total_ratings >= 30""",
    "int_genre_metrics": """
        SELECT genre, count(*) AS total_ratings, avg(CAST(rating AS DECIMAL(6, 2))) AS avg_rating
        FROM stg_ratings r JOIN stg_movie_genres g ON r.movie_id = g.movie_id GROUP BY genre""",
    "int_user_metrics": """
        SELECT user_id, count(*) AS total_ratings, avg(CAST(rating AS DECIMAL(6, 2))) AS avg_rating,
               avg(CASE WHEN rating >= 4 THEN 1 ELSE 0 END) AS pct_positive, max(event_timestamp) AS last_activity
        FROM stg_ratings GROUP BY user_id""",
    "int_user_genre_metrics": """
        SELECT user_id, genre, count(*) AS total_ratings, avg(CAST(rating AS DECIMAL(6, 2))) AS avg_rating
        FROM stg_ratings r JOIN stg_movie_genres g ON r.movie_id = g.movie_id GROUP BY user_id, genre""",
    "gold_ratings_over_time": """
        SELECT CAST(event_timestamp AS DATE) AS event_date, count(*) AS total_ratings, avg(CAST(rating AS DECIMAL(6, 2))) AS avg_rating,
               avg(CASE WHEN rating >= 4 THEN 1 ELSE 0 END) AS pct_positive
        FROM stg_ratings GROUP BY 1""",
    "gold_top_movies": """
        SELECT * FROM int_movie_metrics
        ORDER BY avg_rating DESC, total_ratings DESC, movie_id LIMIT 10""",
    "gold_worst_movies": """
        SELECT * FROM int_movie_metrics
        ORDER BY avg_rating ASC, total_ratings DESC, movie_id LIMIT 10""",
    "gold_most_rated_movies": "SELECT * FROM int_movie_metrics ORDER BY total_ratings DESC, movie_id LIMIT 10",
    "gold_least_rated_movies": "SELECT * FROM int_movie_metrics ORDER BY total_ratings ASC, movie_id LIMIT 10",
    "gold_genre_popularity": """
        SELECT genre, count(*) AS total_ratings, avg(CAST(rating AS DECIMAL(6, 2))) AS avg_ratings
        FROM stg_ratings r JOIN stg_movie_genres g ON r.movie_id = g.movie_id GROUP BY genre""",
    "gold_genre_popularity_vs_quality": """
        SELECT genre, total_ratings AS popularity, avg_rating AS quality FROM int_genre_metrics""",
    "gold_movie_popularity_vs_quality": """
        SELECT movie_id, title, release_year, total_ratings AS popularity, avg_rating AS quality
        FROM int_movie_metrics""",
    "gold_user_activity": "SELECT * FROM int_user_metrics",
    "gold_user_genre_preference": """
        SELECT user_id, genre, total_ratings, avg_rating,
               row_number() OVER (PARTITION BY user_id
                   ORDER BY avg_rating DESC, total_ratings DESC, genre) AS rank_genre
        FROM int_user_genre_metrics""",
    "gold_rating_distribution": "SELECT rating, count(*) AS total_ratings FROM stg_ratings GROUP BY rating",
    "gold_rating_seasonality": """
        SELECT CAST(month(event_timestamp) AS INTEGER) AS month,
               CAST(isodow(event_timestamp) AS INTEGER) AS day_of_week,
               count(*) AS total_ratings, avg(CAST(rating AS DECIMAL(6, 2))) AS avg_rating
        FROM stg_ratings GROUP BY 1, 2""",
    "gold_underrated_movies": """
        SELECT movie_id, title, avg_rating, total_ratings FROM int_movie_metrics
        WHERE avg_rating >= 2 AND total_ratings < 40""",
}

COLUMNS = {
    "int_movie_metrics": ["movie_id", "title", "release_year", "total_ratings", "~avg_rating"],
    "int_genre_metrics": ["genre", "total_ratings", "~avg_rating"],
    "int_user_metrics": ["user_id", "total_ratings", "~avg_rating", "~pct_positive", "last_activity"],
    "int_user_genre_metrics": ["user_id", "genre", "total_ratings", "~avg_rating"],
    "gold_ratings_over_time": ["event_date", "total_ratings", "~avg_rating", "~pct_positive"],
    "gold_genre_popularity": ["genre", "total_ratings", "~avg_ratings"],
    "gold_genre_popularity_vs_quality": ["genre", "popularity", "~quality"],
    "gold_movie_popularity_vs_quality": ["movie_id", "title", "release_year", "popularity", "~quality"],
    "gold_user_genre_preference": ["user_id", "genre", "total_ratings", "~avg_rating", "rank_genre"],
    "gold_rating_seasonality": ["month", "day_of_week", "total_ratings", "~avg_rating"],
    "gold_underrated_movies": ["movie_id", "title", "~avg_rating", "total_ratings"],
}
for _name in ("top", "worst", "most_rated", "least_rated"):
    COLUMNS[f"gold_{_name}_movies"] = COLUMNS["int_movie_metrics"]
COLUMNS["gold_user_activity"] = COLUMNS["int_user_metrics"]


def _with(final: str, replace: tuple[tuple[str, str], ...] = ()) -> str:
    body = ",\n".join(f"{name} AS ({sql})" for name, sql in CTES.items())
    for old, new in replace:
        body = body.replace(old, new)
    return f"WITH {body}\n{final}"


def _model(name: str) -> str:
    """Rows of a model, columns marked ``~`` rounded to six places."""
    columns = COLUMNS.get(name)
    if columns is None:
        return _with(f"SELECT * FROM {name}")
    shown = [f"round({c[1:]}, 6) AS {c[1:]}" if c[0] == "~" else c for c in columns]
    return _with(f"SELECT {', '.join(shown)} FROM {name}")


BY_SUPPLIER = (("CAST(l_partkey AS INTEGER) AS movie_id", "CAST(l_suppkey AS INTEGER) AS movie_id"),
               ("total_ratings >= 30", "total_ratings >= 50"))


def _supplier(name: str) -> str:
    return _with(
        "SELECT movie_id, title, release_year, total_ratings, round(avg_rating, 6) AS avg_rating "
        f"FROM {name}",
        BY_SUPPLIER,
    )


def _check(table: str, column: str, kind: str, source: str | None = None) -> str:
    source = source or table
    if kind == "not_null":
        count = f"SELECT count(*) FROM {source} WHERE {column} IS NULL"
    else:
        count = (
            f"SELECT count(*) FROM (SELECT {column} FROM {source} WHERE {column} IS NOT NULL "
            f"GROUP BY {column} HAVING count(*) > 1)"
        )
    return (
        f"SELECT '{table}' AS \"table\", '{kind}' AS \"check\", '{column}' AS \"column\", "
        f"({count}) AS failing_rows"
    )


def _profile_row(statistic: str, fn: str) -> str:
    values = ", ".join(f"round(CAST({fn}({c}) AS DOUBLE), 4) AS {c}" for c in ("user_id", "movie_id", "rating"))
    return f"SELECT '{statistic}' AS summary, {values} FROM ratings_cleaned"


DECLARED_CHECKS = [
    ("movies_cleaned", "movie_id", "not_null"),
    ("movies_cleaned", "title", "not_null"),
    ("movies_cleaned", "release_year", "not_null"),
    ("movies_cleaned", "movie_id", "unique"),
    ("movie_genres", "movie_id", "not_null"),
    ("movie_genres", "genre", "not_null"),
    ("ratings_cleaned", "user_id", "not_null"),
    ("ratings_cleaned", "movie_id", "not_null"),
]
RAW_CHECKS = [("movies", c, "not_null", "movies_raw") for c in ("movie_id", "title", "genres")]
UNIQUE_CHECKS = [
    ("lineitem", "l_orderkey", "unique"),
    ("orders", "o_orderkey", "unique"),
    ("customer", "c_custkey", "unique"),
    ("events", "user_id", "unique"),
]

BUCKET = """CASE WHEN s BETWEEN 0.5 AND 1.5 THEN 'very_low' WHEN s BETWEEN 1.5 AND 2.5 THEN 'low'
    WHEN s BETWEEN 2.5 AND 3.5 THEN 'mid' WHEN s BETWEEN 3.5 AND 4.5 THEN 'high'
    WHEN s BETWEEN 4.5 AND 5.0 THEN 'top' END"""

ORDERS_WITH_CODES = """(SELECT o_orderkey % 7 AS code,
    CASE WHEN o_orderkey % 12 >= 1 THEN o_orderkey % 12 - 1 END AS month_idx FROM orders)"""

EVENT_TEXT = """CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
    CAST(CAST(value AS DECIMAL(12, 2)) AS VARCHAR) AS value, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts"""

ORACLE: dict[str, str] = {
    "recommendation_cleaned": _model("recommendation_history_cleaned"),
    "supplier_metrics": _supplier("int_movie_metrics"),
    "supplier_top": _supplier("gold_top_movies"),
    "dedup_latest": """
        SELECT * EXCLUDE (n) FROM (
            SELECT * REPLACE (CAST(l_shipdate AS TIMESTAMP) AS l_shipdate),
                   row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                       ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                                l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
                                l_linestatus DESC) AS n
            FROM lineitem)
        WHERE n = 1""",
    "bucketize": f"""
        SELECT bucket, category, count(*) AS n, min(s) AS low, max(s) AS high
        FROM (SELECT s, {BUCKET} AS bucket,
                     CASE WHEN s < 0.5 OR s > 4.0 THEN 'high' WHEN s <= 2.5 THEN 'low' WHEN s <= 3.5 THEN 'medium'
                          ELSE 'high' END AS category
              FROM (SELECT l_quantity / 10 AS s FROM lineitem))
        GROUP BY bucket, category""",
    "clamp_domain": """
        SELECT o_orderkey,
               CASE WHEN o_totalprice BETWEEN 50000 AND 250000 THEN o_totalprice END AS price_in_range,
               CASE WHEN o_orderkey % 12 >= 1 THEN CAST(o_orderkey % 12 - 1 AS INTEGER) END AS month_idx,
               CASE WHEN o_orderkey % 7 IN (1, 2, 3, 4, 5) THEN CAST(o_orderkey % 7 AS INTEGER) END AS source_type
        FROM orders""",
    "sentinel_nulls": """
        SELECT is_seen, is_seen = 1 AS has_watched, count(*) AS n
        FROM (SELECT CASE WHEN l_linenumber % 3 <> 0 THEN CAST(l_linenumber % 3 - 1 AS INTEGER) END AS is_seen
              FROM lineitem)
        GROUP BY is_seen""",
    "parsed_times": """
        SELECT event_id,
               CASE WHEN event_type IN ('purchase', 'signup') THEN CAST(ts AS DATE) END AS day,
               date_trunc('second', CAST(ts AS TIMESTAMP)) AS at,
               CAST(NULL AS TIMESTAMP) AS none_of_these
        FROM events""",
    "explode_delimited": """
        SELECT DISTINCT p_brand, token
        FROM (SELECT p_brand, lower(trim(unnest(string_split(p_name, ' ')))) AS token FROM part)
        WHERE token NOT IN ('', 'bolt')""",
    "code_label_map": f"""
        SELECT CASE code WHEN 1 THEN 'popular' WHEN 2 THEN 'well_rated' WHEN 3 THEN 'recent_popular'
                         WHEN 4 THEN 'trending' WHEN 5 THEN 'serendipity' END AS source_category,
               CASE WHEN month_idx IS NULL THEN 'unknown' WHEN month_idx <= 2 THEN 'early_stage'
                    WHEN month_idx <= 6 THEN 'mid_stage' ELSE 'late_stage' END AS month_group,
               count(*) AS n
        FROM {ORDERS_WITH_CODES} GROUP BY 1, 2""",
    "flags_and_differences": """
        SELECT s >= 4 AS is_positive, round(s - shown, 4) AS rating_diff, count(*) AS n
        FROM (SELECT CASE WHEN l_quantity / 10 BETWEEN 0.5 AND 4.5 THEN l_quantity / 10 END AS s,
                     l_discount * 50 AS shown FROM lineitem)
        GROUP BY 1, 2""",
    "recency": f"""
        SELECT CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST({AS_OF} AS DATE)) AS INTEGER) AS recency_days,
               CAST(o_orderdate AS TIMESTAMP) >= {AS_OF} - INTERVAL 365 DAY AS is_recent,
               CAST(isodow(o_orderdate) AS INTEGER) AS day_of_week, count(*) AS n
        FROM orders GROUP BY 1, 2, 3""",
    "quality_not_null": _with(" UNION ALL ".join(_check(*c) for c in DECLARED_CHECKS + RAW_CHECKS)),
    "quality_unique": " UNION ALL ".join(_check(*c) for c in UNIQUE_CHECKS),
    "table_profile": _with(
        " UNION ALL ".join(
            _profile_row(statistic, fn)
            for statistic, fn in [
                ("count", "count"),
                ("mean", "avg"),
                ("stddev", "stddev_samp"),
                ("min", "min"),
                ("max", "max"),
            ]
        )
    ),
    "incremental_read": """
        SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus IN ('O', 'P')""",
    "insert_only_merge": """
        SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS o_orderdate, o_orderstatus,
               CASE WHEN o_orderstatus = 'O' THEN o_totalprice ELSE 0.0 END AS o_totalprice
        FROM orders""",
    "incremental_ratings": _model("ratings_cleaned"),
    "incremental_belief_features": _model("belief_features"),
    "bronze_load": "SELECT *, 'postgres' AS _source FROM supplier",
    "gold_build": _with(
        "SELECT p.movie_id, title, release_year, total_ratings AS popularity, round(avg_rating, 6) AS quality, "
        "(SELECT genres_raw FROM movies_cleaned c WHERE c.movie_id = p.movie_id) AS genres_raw "
        "FROM int_movie_metrics p"
    ),
    "csv_load": "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders",
    "csv_tail": "SELECT 'first' AS pass, o_orderkey, o_custkey, o_orderpriority FROM orders",
    "canonical_schemas": """
        WITH headers AS (
            SELECT 'in/' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') || '.csv' AS file_path,
                   o_orderstatus AS proposed, replace(o_orderpriority, '-', ',') AS columns FROM orders),
        firsts AS (SELECT columns, arg_min(proposed, file_path) AS proposed, min(file_path) AS first
                   FROM headers GROUP BY columns),
        named AS (SELECT columns, proposed,
                         row_number() OVER (PARTITION BY proposed ORDER BY first) - 1 AS n FROM firsts)
        SELECT file_path, named.proposed || CASE WHEN n > 0 THEN '_' || CAST(n AS VARCHAR) ELSE '' END AS schema_name,
               headers.columns AS columns
        FROM headers JOIN named ON headers.columns = named.columns""",
    "parse_topic_json": f"SELECT 'csv-' || event_type AS topic, {EVENT_TEXT} FROM events",
    "stream_to_bronze": f"""
        SELECT {EVENT_TEXT}, 'kafka' AS _source, 'csv-' || event_type AS _topic
        FROM events WHERE event_type <> 'error'""",
    "stream_to_silver": _with(
        "SELECT user_id, movie_id, predicted_rating, event_timestamp, source_system, source_topic "
        "FROM recommendation_history_cleaned"
    ),
    "csv_to_bronze": """
        SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderpriority,
               'kafka' AS _source, 'csv-orders' AS _topic
        FROM orders""",
    "stream_quarantine": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, 'no schema registered for error' AS error
        FROM events WHERE event_type = 'error'""",
    "stream_new_checkpoint": "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus FROM orders",
    "stream_catalog": "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus FROM orders",
    "catalog_uncommitted": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 3 <> 1",
    "canonical_schemas_known": """
        SELECT 'in/' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') || '.csv' AS file_path,
               replace(o_orderpriority, '-', ',') AS columns
        FROM orders""",
    "features_backfill": _model("rating_features"),
    "catalog_run": _model("ratings_cleaned").replace("SELECT * FROM ratings_cleaned", "SELECT *, 1 AS checkpoint FROM ratings_cleaned"),
}
ORACLE.update({name: _model(name) for name in CTES if name not in ("movies_raw", "recommendation_history_cleaned")})
MARTS = sorted(name for name in CTES if name.startswith("gold_"))
ORACLE["gold_build_all"] = _with(" UNION ALL ".join(f"SELECT {', '.join(mart_view(m))} FROM {m}" for m in MARTS))
ORACLE["gold_incremental"] = ORACLE["gold_build_all"]
ORACLE["change_feed"] = """
    WITH old AS (
        SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 10 = 1 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
        FROM orders WHERE o_orderkey % 10 <> 0)
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, 'insert' AS change_type, 1 AS commit_version FROM orders WHERE o_orderkey % 10 = 0
    UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, 'update_postimage', 1 FROM orders WHERE o_orderkey % 10 = 1
    UNION ALL SELECT *, 'update_preimage', 1 FROM old WHERE o_orderkey % 10 = 1
    UNION ALL SELECT *, 'delete', 1 FROM old WHERE o_orderkey % 10 IN (2, 3)"""
ORACLE["change_feed_run"] = _model("elicitation_features")
ORACLE["csv_tail_to_bronze"] = ORACLE["csv_to_bronze"]
ORACLE["csv_rejects"] = """
    SELECT CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 THEN 'reject' ELSE 'row' END AS kind,
           CASE WHEN o_orderkey % 7 = 0 THEN concat_ws(',', o_orderkey, o_custkey)
                WHEN o_orderkey % 11 = 0 THEN concat_ws(',', o_orderkey, o_custkey, o_orderpriority, 'more')
                WHEN o_orderkey % 13 = 0 THEN concat_ws(',', 'none', o_custkey, o_orderpriority)
                ELSE concat_ws(',', o_orderkey, o_custkey, o_orderpriority) END AS line
    FROM orders"""
ORACLE["json_rejects"] = """
    SELECT CASE WHEN event_type = 'error' THEN 'no schema registered for error'
                WHEN event_id % 7 = 0 OR (event_id % 11 <> 0 AND event_id % 13 = 0) THEN 'not a JSON object'
                WHEN event_id % 11 = 0 THEN 'no value'
                WHEN event_id % 17 = 0 THEN 'no field of ' || event_type ELSE 'row' END AS outcome,
           count(*) AS n,
           CAST(sum(CASE WHEN event_id % 7 = 0 OR event_id % 11 <> 0 THEN event_id END) AS BIGINT) AS ids
    FROM events GROUP BY 1"""
ORACLE["quarantine_replay"] = f"SELECT {EVENT_TEXT}, 'kafka' AS _source, 'csv-' || event_type AS _topic FROM events"
ORACLE["quality_observed"] = _with(
    " UNION ALL ".join(
        [_check(*c) for c in DECLARED_CHECKS if c[2] == "not_null"]
        + [f"SELECT '{t}', 'rows', '*', count(*) FROM {t}" for t in ("movies_cleaned", "movie_genres", "ratings_cleaned")]
    )
)
ORACLE["profile_merged"] = ORACLE["table_profile"]
ORACLE["ingest_one_table"] = "SELECT *, 'postgres' AS _source FROM customer"
ORACLE["registry_lookups"] = f"SELECT schema_name, columns, count(*) AS files FROM ({ORACLE['canonical_schemas']}) GROUP BY schema_name, columns"
ORACLE["registry_per_batch"] = """
    SELECT CAST(event_id AS VARCHAR) AS event_id,
           CASE WHEN event_type = 'error' OR (event_id % 2 = 0 AND event_type <> 'click') THEN 'quarantine' ELSE event_type END AS place
    FROM events"""
ORACLE["inferred_schemas"] = """
    SELECT event_type AS schema_name, c AS column, 'STRING' AS type, count(*) AS messages, count(*) AS replayed
    FROM events, (SELECT unnest(['event_id', 'user_id', 'value', 'ts']) AS c)
    WHERE event_type NOT IN ('click', 'view') GROUP BY event_type, c"""
ORACLE["customer_underrated"] = _with(
    "SELECT movie_id, title, round(avg_rating, 6) AS avg_rating, total_ratings FROM gold_underrated_movies",
    (
        ("CAST(l_partkey AS INTEGER) AS movie_id", "CAST(o_custkey AS INTEGER) AS movie_id"),
        ("total_ratings >= 30", "total_ratings >= 50"),
        ("total_ratings < 40", "total_ratings < 100"),
    ),
)
