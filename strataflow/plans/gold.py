"""Gold: staging, intermediate and mart models over the silver tables.

A model is a function of ``ref``, which gives any model or silver table by name,
and of the thresholds. Models over the same grain share a rollup, so the ratings
are read once per grain and never shuffled row by row:

* ``rollup_movies``      rating totals per movie
* ``rollup_days``        rating totals per day and rating value
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.functions import iso_day_of_week
from strataflow.operators import merge_totals, rank_within, rating_totals, require_keys, top_k
from strataflow.operators.metrics import POSITIVE_AT, average_of_merged, average_of_totals, ordering
from strataflow.plans.silver.movies import NO_GENRES

Ref = Callable[[str], DataFrame]


@dataclass(frozen=True)
class Thresholds:
    """Numbers the models depend on; the defaults are the published ones."""

    min_ratings: int = 50
    underrated_below: int = 100
    underrated_avg: float = 2.0
    top: int = 10


@dataclass(frozen=True)
class Model:
    name: str
    layer: str
    stored: bool
    build: Callable[[Ref, Thresholds], DataFrame]
    order: tuple[tuple[str, str], ...] = ()

    @property
    def tags(self) -> tuple[str, ...]:
        return {
            "staging": ("staging",),
            "rollup": (),
            "intermediate": ("marts", "intermediate"),
            "gold": ("marts", "gold"),
        }[self.layer]


MODELS: dict[str, Model] = {}


def _model(layer: str, stored: bool = False, order: tuple[tuple[str, str], ...] = ()):
    def add(build):
        MODELS[build.__name__] = Model(build.__name__, layer, stored, build, order)
        return build

    return add


# --- staging: contract columns of rows with their identifiers --------------


@_model("staging")
def stg_movies(ref: Ref, t: Thresholds) -> DataFrame:
    return require_keys(ref("movies_cleaned"), ["movie_id", "title"]).select(
        "movie_id", "title", "release_year", "genres_raw", "ingestion_timestamp", "processed_timestamp"
    )


@_model("staging")
def stg_movie_genres(ref: Ref, t: Thresholds) -> DataFrame:
    genres = require_keys(ref("movie_genres"), ["movie_id", "genre"])
    return genres.where(F.col("genre") != NO_GENRES).select("movie_id", "genre")


@_model("staging")
def stg_ratings(ref: Ref, t: Thresholds) -> DataFrame:
    return require_keys(ref("ratings_cleaned"), ["user_id", "movie_id", "rating"]).select(
        "user_id",
        "movie_id",
        "rating",
        "event_timestamp",
        F.to_date("event_timestamp").alias("event_date"),
        "ingestion_timestamp",
        "processed_timestamp",
        "source_system",
        "source_topic",
    )


@_model("staging")
def stg_belief(ref: Ref, t: Thresholds) -> DataFrame:
    return require_keys(ref("belief_cleaned"), ["user_id", "movie_id"]).select(
        "user_id",
        "movie_id",
        "is_seen",
        "watch_date",
        "user_rating",
        "predicted_rating",
        "user_certainty",
        "system_rating",
        "event_timestamp",
        "movie_idx",
        "source_type",
        "ingestion_timestamp",
        "source_system",
        "processed_timestamp",
    )


@_model("staging")
def stg_belief_features(ref: Ref, t: Thresholds) -> DataFrame:
    return require_keys(ref("belief_features"), ["user_id", "movie_id"]).select(
        "user_id",
        "movie_id",
        "is_seen",
        "has_watched",
        "user_rating",
        "system_rating",
        "rating_diff",
        "user_certainty",
        "is_high_confidence",
        "event_timestamp",
        "event_date",
    )


@_model("staging")
def stg_movie_elicitation(ref: Ref, t: Thresholds) -> DataFrame:
    return require_keys(ref("elicitation_cleaned"), ["movie_id"]).select(
        "movie_id",
        "month_idx",
        "source_type",
        "event_timestamp",
        "ingestion_timestamp",
        "source_system",
        "processed_timestamp",
    )


@_model("staging")
def stg_elicitation_features(ref: Ref, t: Thresholds) -> DataFrame:
    return require_keys(ref("elicitation_features"), ["movie_id"]).select(
        "movie_id",
        "month_idx",
        "source_type",
        "source_category",
        "month_group",
        "event_timestamp",
        "is_recent",
        "event_date",
    )


@_model("staging")
def stg_recommendation_history(ref: Ref, t: Thresholds) -> DataFrame:
    return require_keys(ref("recommendation_history_cleaned"), ["user_id", "movie_id"]).select(
        "user_id",
        "movie_id",
        "predicted_rating",
        "event_timestamp",
        "ingestion_timestamp",
        "source_system",
        "source_topic",
        "processed_timestamp",
    )


@_model("staging")
def stg_recommendation_features(ref: Ref, t: Thresholds) -> DataFrame:
    return require_keys(ref("recommendation_features"), ["user_id", "movie_id"]).select(
        "user_id",
        "movie_id",
        "predicted_rating",
        "predicted_rating_category",
        "is_high_score",
        "predicted_rating_bucket",
        "event_timestamp",
        "event_date",
    )


# --- rollups: one pass over the ratings each --------------------------------


@_model("rollup")
def rollup_movies(ref: Ref, t: Thresholds) -> DataFrame:
    return rating_totals(ref("stg_ratings"), ["movie_id"])


@_model("rollup")
def rollup_days(ref: Ref, t: Thresholds) -> DataFrame:
    return rating_totals(ref("stg_ratings"), ["event_date", "rating"])


@_model("rollup")
def rollup_users(ref: Ref, t: Thresholds) -> DataFrame:
    return rating_totals(ref("stg_ratings"), ["user_id"], positive_at=POSITIVE_AT, last_activity="event_timestamp")


@_model("rollup")
def rollup_user_genres(ref: Ref, t: Thresholds) -> DataFrame:
    """Totals of a user per genre.

    The one join at rating grain. Genres are broadcast when their size allows it;
    otherwise adaptive execution splits the partition of a hot movie, which an
    inner sort-merge join right below a shuffle permits.
    """
    ratings = ref("stg_ratings").select("user_id", "movie_id", "rating")
    return rating_totals(ratings.join(ref("stg_movie_genres"), "movie_id"), ["user_id", "genre"])


# --- intermediate -----------------------------------------------------------


@_model("intermediate")
def int_movie_metrics(ref: Ref, t: Thresholds) -> DataFrame:
    """Movies with enough ratings; one that is not in the catalog has no title."""
    rated = (
        ref("rollup_movies")
        .where(F.col("total_ratings") >= t.min_ratings)
        .select("movie_id", "total_ratings", average_of_totals().alias("avg_rating"))
    )
    catalog = ref("stg_movies").select("movie_id", "title", "release_year")
    return rated.join(catalog, "movie_id", "left").select(
        "movie_id", "title", "release_year", "total_ratings", "avg_rating"
    )


@_model("intermediate")
def int_genre_metrics(ref: Ref, t: Thresholds) -> DataFrame:
    """Joins one row per movie, not per rating: a hot movie weighs no more than any other."""
    by_genre = ref("rollup_movies").join(ref("stg_movie_genres"), "movie_id")
    return merge_totals(by_genre, ["genre"])


@_model("intermediate")
def int_user_metrics(ref: Ref, t: Thresholds) -> DataFrame:
    return ref("rollup_users").select(
        "user_id",
        "total_ratings",
        average_of_totals().alias("avg_rating"),
        (F.col("positives") / F.col("total_ratings")).alias("pct_positive"),
        "last_activity",
    )


@_model("intermediate")
def int_user_genre_metrics(ref: Ref, t: Thresholds) -> DataFrame:
    """Ratings of a user per genre."""
    return ref("rollup_user_genres").select("user_id", "genre", "total_ratings", average_of_totals().alias("avg_rating"))


# --- marts -------------------------------------------------------------------


@_model("gold", stored=True)
def gold_ratings_over_time(ref: Ref, t: Thresholds) -> DataFrame:
    positive = F.when(F.col("rating") >= POSITIVE_AT, F.col("total_ratings")).otherwise(0)
    total = F.sum("total_ratings")
    return (
        ref("rollup_days")
        .groupBy("event_date")
        .agg(
            total.alias("total_ratings"),
            average_of_merged().alias("avg_rating"),
            (F.sum(positive) / total).alias("pct_positive"),
        )
    )


@_model("gold", stored=True)
def gold_top_movies(ref: Ref, t: Thresholds) -> DataFrame:
    order = [("avg_rating", "desc"), ("total_ratings", "desc")]
    return top_k(ref("int_movie_metrics"), order, t.top, tie="movie_id")


@_model("gold", stored=True)
def gold_worst_movies(ref: Ref, t: Thresholds) -> DataFrame:
    order = [("avg_rating", "asc"), ("total_ratings", "desc")]
    return top_k(ref("int_movie_metrics"), order, t.top, tie="movie_id")


@_model("gold", stored=True)
def gold_most_rated_movies(ref: Ref, t: Thresholds) -> DataFrame:
    return top_k(ref("int_movie_metrics"), [("total_ratings", "desc")], t.top, tie="movie_id")


@_model("gold", stored=True)
def gold_least_rated_movies(ref: Ref, t: Thresholds) -> DataFrame:
    return top_k(ref("int_movie_metrics"), [("total_ratings", "asc")], t.top, tie="movie_id")


@_model("gold", stored=True, order=(("avg_ratings", "desc"), ("total_ratings", "desc"), ("genre", "asc")))
def gold_genre_popularity(ref: Ref, t: Thresholds) -> DataFrame:
    return ref("int_genre_metrics").withColumnRenamed("avg_rating", "avg_ratings")


@_model("gold", stored=True, order=(("popularity", "desc"), ("genre", "asc")))
def gold_genre_popularity_vs_quality(ref: Ref, t: Thresholds) -> DataFrame:
    return ref("int_genre_metrics").select(
        "genre", F.col("total_ratings").alias("popularity"), F.col("avg_rating").alias("quality")
    )


@_model("gold", stored=True)
def gold_movie_popularity_vs_quality(ref: Ref, t: Thresholds) -> DataFrame:
    return ref("int_movie_metrics").select(
        "movie_id",
        "title",
        "release_year",
        F.col("total_ratings").alias("popularity"),
        F.col("avg_rating").alias("quality"),
    )


@_model("gold", stored=True, order=(("total_ratings", "desc"), ("user_id", "asc")))
def gold_user_activity(ref: Ref, t: Thresholds) -> DataFrame:
    return ref("int_user_metrics")


@_model("gold", stored=True)
def gold_user_genre_preference(ref: Ref, t: Thresholds) -> DataFrame:
    """Genres of each user, best liked first; a user has no more rows than there are genres."""
    ranked = rank_within(
        ref("int_user_genre_metrics"),
        ["user_id"],
        [("avg_rating", "desc"), ("total_ratings", "desc")],
        tie="genre",
        out="rank_genre",
    )
    return ranked.select("user_id", "genre", "total_ratings", "avg_rating", "rank_genre")


@_model("gold", stored=True, order=(("rating", "asc"),))
def gold_rating_distribution(ref: Ref, t: Thresholds) -> DataFrame:
    return ref("rollup_days").groupBy("rating").agg(F.sum("total_ratings").alias("total_ratings"))


@_model("gold", stored=True, order=(("month", "asc"), ("day_of_week", "asc")))
def gold_rating_seasonality(ref: Ref, t: Thresholds) -> DataFrame:
    return merge_totals(
        ref("rollup_days"),
        [F.month("event_date").alias("month"), iso_day_of_week("event_date").alias("day_of_week")],
    )


@_model("gold", stored=True, order=(("avg_rating", "desc"), ("total_ratings", "asc"), ("movie_id", "asc")))
def gold_underrated_movies(ref: Ref, t: Thresholds) -> DataFrame:
    liked = F.col("avg_rating") >= t.underrated_avg
    rarely_rated = F.col("total_ratings") < t.underrated_below
    return (
        ref("int_movie_metrics")
        .where(liked & rarely_rated)
        .select("movie_id", "title", "avg_rating", "total_ratings")
    )


def in_order(name: str, df: DataFrame) -> DataFrame:
    """The reading order of a mart; a stored table has none."""
    order = MODELS[name].order
    return df.orderBy(*ordering(order)) if order else df
