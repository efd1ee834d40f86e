"""Belief data: what users said, expected and were shown about a movie."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions import at_least, difference, null_sentinel, parse_date
from strataflow.operators import cast_columns, dedup_latest, rename_map, require_keys

# Fixed values of the data contract.
UNANSWERED = -1
HIGH_CONFIDENCE_AT = 4.0

KEYS = ["user_id", "movie_id", "event_timestamp"]
CLEANED_SCHEMA = (
    "user_id int, movie_id int, is_seen int, watch_date date, user_rating double, "
    "predicted_rating double, user_certainty double, system_rating double, "
    "event_timestamp timestamp, movie_idx int, source_type int, ingestion_timestamp timestamp, "
    "source_system string, processed_timestamp timestamp"
)
FEATURES_SCHEMA = (
    "user_id int, movie_id int, is_seen int, has_watched boolean, user_rating double, "
    "system_rating double, rating_diff double, user_certainty double, is_high_confidence boolean, "
    "event_timestamp timestamp, event_date date"
)


def clean(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Rows with a user and a movie; unanswered values and blank dates are NULL."""
    names = {
        "user_elicit_rating": "user_rating",
        "user_predict_rating": "predicted_rating",
        "system_predict_rating": "system_rating",
        "tstamp": "event_timestamp",
        "source": "source_type",
        "_ingestion_timestamp": "ingestion_timestamp",
        "_source": "source_system",
    }
    answered = {
        c: null_sentinel(c, UNANSWERED)
        for c in ("is_seen", "user_rating", "predicted_rating", "user_certainty")
    }
    typed = cast_columns(
        require_keys(rename_map(df, names), ["user_id", "movie_id"]).withColumns(
            {**answered, "watch_date": parse_date("watch_date")}
        ),
        {
            "user_id": "int",
            "movie_id": "int",
            "is_seen": "int",
            "watch_date": "date",
            "user_rating": "double",
            "predicted_rating": "double",
            "user_certainty": "double",
            "system_rating": "double",
            "event_timestamp": "timestamp",
            "movie_idx": "int",
            "source_type": "int",
            "ingestion_timestamp": "timestamp",
            "source_system": "string",
        },
    )
    return dedup_latest(typed, KEYS, "ingestion_timestamp").withColumn(
        "processed_timestamp", F.current_timestamp() if processed_at is None else processed_at
    )


def features(cleaned: DataFrame) -> DataFrame:
    return cleaned.select(
        "user_id",
        "movie_id",
        "is_seen",
        (F.col("is_seen") == 1).alias("has_watched"),
        "user_rating",
        "system_rating",
        difference("user_rating", "system_rating").alias("rating_diff"),
        "user_certainty",
        at_least("user_certainty", HIGH_CONFIDENCE_AT).alias("is_high_confidence"),
        "event_timestamp",
        F.to_date("event_timestamp").alias("event_date"),
    )
