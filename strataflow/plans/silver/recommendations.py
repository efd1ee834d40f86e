"""Recommendation history from the stream: predicted ratings shown to users."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions import at_least, bucketize, clamp_between, parse_event_time, parse_int
from strataflow.operators import dedup_latest, rename_map, require_keys
from strataflow.plans.silver.labels import BUCKETS, rating_category

# Fixed values of the data contract.
PREDICTED_RANGE = (0.0, 5.0)
HIGH_SCORE_AT = 4.0

KEYS = ["user_id", "movie_id", "event_timestamp"]
CLEANED_SCHEMA = (
    "user_id int, movie_id int, predicted_rating double, event_timestamp timestamp, "
    "ingestion_timestamp timestamp, source_system string, source_topic string, "
    "processed_timestamp timestamp"
)
FEATURES_SCHEMA = (
    "user_id int, movie_id int, predicted_rating double, predicted_rating_category string, "
    "is_high_score boolean, predicted_rating_bucket string, event_timestamp timestamp, event_date date"
)


def clean(df: DataFrame, processed_at: Column | None = None, event_time: str = "epoch") -> DataFrame:
    """Rows with a key; a predicted rating that is unreadable or out of range is NULL and stays."""
    names = {
        "userId": "user_id",
        "movieId": "movie_id",
        "predictedRating": "predicted_rating",
        "tstamp": "event_timestamp",
        "_ingestion_timestamp": "ingestion_timestamp",
        "_source": "source_system",
        "_topic": "source_topic",
    }
    typed = rename_map(df, names).select(
        parse_int("user_id").alias("user_id"),
        parse_int("movie_id").alias("movie_id"),
        clamp_between(F.col("predicted_rating").try_cast("double"), *PREDICTED_RANGE).alias(
            "predicted_rating"
        ),
        parse_event_time("event_timestamp", event_time).alias("event_timestamp"),
        "ingestion_timestamp",
        "source_system",
        "source_topic",
    )
    return dedup_latest(require_keys(typed, KEYS), KEYS, "ingestion_timestamp").withColumn(
        "processed_timestamp", F.current_timestamp() if processed_at is None else processed_at
    )


def features(cleaned: DataFrame) -> DataFrame:
    return cleaned.select(
        "user_id",
        "movie_id",
        "predicted_rating",
        rating_category("predicted_rating").alias("predicted_rating_category"),
        at_least("predicted_rating", HIGH_SCORE_AT).alias("is_high_score"),
        bucketize("predicted_rating", PREDICTED_RANGE[0], BUCKETS).alias("predicted_rating_bucket"),
        "event_timestamp",
        F.to_date("event_timestamp").alias("event_date"),
    )
