"""Ratings from the stream: text rows typed, clamped and deduplicated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions import (
    at_least,
    bucketize,
    clamp_between,
    days_since,
    parse_event_time,
    parse_int,
)
from strataflow.operators import dedup_latest, rename_map, require_keys
from strataflow.plans.silver.labels import BUCKETS, rating_category

# Fixed values of the data contract.
RATING_RANGE = (0.5, 5.0)
POSITIVE_AT = 4.0

KEYS = ["user_id", "movie_id", "event_timestamp"]
CLEANED_SCHEMA = (
    "user_id int, movie_id int, rating double, event_timestamp timestamp, "
    "ingestion_timestamp timestamp, source_system string, source_topic string, "
    "processed_timestamp timestamp"
)
FEATURES_SCHEMA = (
    "user_id int, movie_id int, rating double, rating_category string, is_positive boolean, "
    "rating_bucket string, event_timestamp timestamp, event_date date, recency_days int"
)


def clean(df: DataFrame, processed_at: Column | None = None, event_time: str = "text") -> DataFrame:
    """Rows with a key; a rating that is unreadable or out of range is NULL and stays.

    ``event_time`` chooses how the time is written: see ``parse_event_time``.
    """
    names = {
        "userId": "user_id",
        "movieId": "movie_id",
        "tstamp": "event_timestamp",
        "_ingestion_timestamp": "ingestion_timestamp",
        "_source": "source_system",
        "_topic": "source_topic",
    }
    typed = rename_map(df, names).select(
        parse_int("user_id").alias("user_id"),
        parse_int("movie_id").alias("movie_id"),
        clamp_between(F.col("rating").try_cast("double"), *RATING_RANGE).alias("rating"),
        parse_event_time("event_timestamp", event_time).alias("event_timestamp"),
        "ingestion_timestamp",
        "source_system",
        "source_topic",
    )
    return dedup_latest(require_keys(typed, KEYS), KEYS, "ingestion_timestamp").withColumn(
        "processed_timestamp", F.current_timestamp() if processed_at is None else processed_at
    )


def features(cleaned: DataFrame, as_of: Column | None = None) -> DataFrame:
    return cleaned.select(
        "user_id",
        "movie_id",
        "rating",
        rating_category("rating").alias("rating_category"),
        at_least("rating", POSITIVE_AT).alias("is_positive"),
        bucketize("rating", RATING_RANGE[0], BUCKETS).alias("rating_bucket"),
        "event_timestamp",
        F.to_date("event_timestamp").alias("event_date"),
        days_since("event_timestamp", as_of).alias("recency_days"),
    )
