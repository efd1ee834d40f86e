"""Elicitation sets: which movies were put before users, when and why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions import clamp_between, clamp_in, label_map, within_days
from strataflow.operators import cast_columns, dedup_latest, rename_map, require_keys
from strataflow.plans.silver.labels import month_group

# Fixed values of the data contract.
SOURCE_LABELS = {
    1: "popular",
    2: "well_rated",
    3: "recent_popular",
    4: "trending",
    5: "serendipity",
}
RECENT_DAYS = 365

KEYS = ["movie_id", "event_timestamp"]
CLEANED_SCHEMA = (
    "movie_id int, month_idx int, source_type int, event_timestamp timestamp, "
    "ingestion_timestamp timestamp, source_system string, processed_timestamp timestamp"
)
FEATURES_SCHEMA = (
    "movie_id int, month_idx int, source_type int, source_category string, month_group string, "
    "event_timestamp timestamp, event_date date, is_recent boolean"
)


def clean(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Rows with movie and time; an unknown source or a negative month is NULL and stays."""
    names = {
        "tstamp": "event_timestamp",
        "source": "source_type",
        "_ingestion_timestamp": "ingestion_timestamp",
        "_source": "source_system",
    }
    typed = cast_columns(
        require_keys(rename_map(df, names), KEYS).withColumns(
            {
                "source_type": clamp_in("source_type", list(SOURCE_LABELS)),
                "month_idx": clamp_between("month_idx", lo=0),
            }
        ),
        {
            "movie_id": "int",
            "month_idx": "int",
            "source_type": "int",
            "event_timestamp": "timestamp",
            "ingestion_timestamp": "timestamp",
            "source_system": "string",
        },
    )
    return dedup_latest(typed, KEYS, "ingestion_timestamp").withColumn(
        "processed_timestamp", F.current_timestamp() if processed_at is None else processed_at
    )


def features(cleaned: DataFrame, as_of: Column | None = None) -> DataFrame:
    return cleaned.select(
        "movie_id",
        "month_idx",
        "source_type",
        label_map("source_type", SOURCE_LABELS).alias("source_category"),
        month_group("month_idx").alias("month_group"),
        "event_timestamp",
        F.to_date("event_timestamp").alias("event_date"),
        within_days("event_timestamp", RECENT_DAYS, as_of).alias("is_recent"),
    )
