"""Movies: title and year apart, one row per movie; genres as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.operators import dedup_latest, explode_delimited, rename_map

# Fixed values of the data contract.
TITLE_BEFORE_YEAR = r"^(.*)\s\(\d{4}\)$"
FIRST_YEAR = r"\((\d{4})\)"
YEARS = (1888, 2028)
GENRE_SEPARATOR = r"\|"
NO_GENRES = "(no genres listed)"
UNKNOWN_GENRES = "unknown"

CLEANED_SCHEMA = (
    "movie_id int, title string, release_year int, genres_raw string, "
    "ingestion_timestamp timestamp, source string, processed_timestamp timestamp"
)
FEATURES_SCHEMA = "movie_id int, genre string"


def clean(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Movies with a usable title and year; the rest are dropped."""
    names = {"genres": "genres_raw", "_ingestion_timestamp": "ingestion_timestamp", "_source": "source"}
    parsed = (
        rename_map(df, names)
        .select(
            F.col("movie_id").try_cast("int").alias("movie_id"),
            F.trim(F.regexp_extract("title", TITLE_BEFORE_YEAR, 1)).alias("title"),
            F.regexp_extract("title", FIRST_YEAR, 1).try_cast("int").alias("release_year"),
            F.coalesce("genres_raw", F.lit(UNKNOWN_GENRES)).alias("genres_raw"),
            "ingestion_timestamp",
            "source",
        )
        .where((F.col("title") != "") & F.col("release_year").between(*YEARS))
    )
    return dedup_latest(parsed, ["movie_id"], "ingestion_timestamp").withColumn(
        "processed_timestamp", F.current_timestamp() if processed_at is None else processed_at
    )


def features(cleaned: DataFrame) -> DataFrame:
    """One row per movie and genre. Cleaned movies are unique, so no shuffle is needed."""
    return explode_delimited(
        cleaned, "genres_raw", GENRE_SEPARATOR, "genre", ["movie_id"], drop=[NO_GENRES], keep_is_unique=True
    )
