"""The five silver entities: where they live, what identifies a row, how they are built."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame

from strataflow.plans.silver import belief, elicitation, movies, ratings, recommendations

STREAM_AUDIT = "_ingestion_timestamp timestamp, _source string, _topic string"


@dataclass(frozen=True)
class Entity:
    """One bronze table and the two silver tables made of it.

    ``snapshot`` says what the current content of the bronze table is (see
    ``read_since``); ``bronze_schema`` is given where rows are text and versions
    many. ``bound`` are key columns by which a merge narrows its target. Features
    get ``as_of`` only when ``uses_clock``.
    """

    name: str
    bronze: str
    snapshot: str
    table_cleaned: str
    table_features: str
    clean: Callable[..., DataFrame]
    features: Callable[..., DataFrame]
    cleaned_schema: str
    features_schema: str
    merge_keys_cleaned: tuple[str, ...]
    merge_keys_features: tuple[str, ...]
    bound: tuple[str, ...] = ()
    bronze_schema: str | None = None
    uses_clock: bool = False
    run_cleaned: bool = True
    run_features: bool = True
    clean_options: dict[str, str] = field(default_factory=dict)

    def bronze_path(self, base: str) -> str:
        return f"{base}/bronze/{self.bronze}"

    def cleaned_path(self, base: str) -> str:
        return f"{base}/silver/cleaned/{self.table_cleaned}"

    def features_path(self, base: str) -> str:
        return f"{base}/silver/features/{self.table_features}"

    @property
    def order_cleaned(self) -> tuple[str, ...]:
        """Time first, then the rest of the key, which splits a day that holds most rows."""
        return (*self.bound, *(c for c in self.merge_keys_cleaned if c not in self.bound)) if self.bound else ()

    @property
    def order_features(self) -> tuple[str, ...]:
        return (*self.bound, *(c for c in self.merge_keys_features if c not in self.bound)) if self.bound else ()

    def build_cleaned(self, df: DataFrame) -> DataFrame:
        return self.clean(df, **self.clean_options)

    def build_features(self, cleaned: DataFrame, as_of: Column | None = None) -> DataFrame:
        return self.features(cleaned, as_of) if self.uses_clock else self.features(cleaned)


MOVIES = Entity(
    name="movies",
    bronze="batch/movies",
    snapshot="latest",
    table_cleaned="movies_cleaned",
    table_features="movie_genres",
    clean=movies.clean,
    features=movies.features,
    cleaned_schema=movies.CLEANED_SCHEMA,
    features_schema=movies.FEATURES_SCHEMA,
    merge_keys_cleaned=("movie_id",),
    merge_keys_features=("movie_id", "genre"),
)

RATINGS = Entity(
    name="ratings",
    bronze="streaming/ratings_for_additional_users",
    bronze_schema=f"userId string, movieId string, rating string, tstamp string, {STREAM_AUDIT}",
    snapshot="all",
    table_cleaned="ratings_cleaned",
    table_features="rating_features",
    clean=ratings.clean,
    features=ratings.features,
    cleaned_schema=ratings.CLEANED_SCHEMA,
    features_schema=ratings.FEATURES_SCHEMA,
    merge_keys_cleaned=tuple(ratings.KEYS),
    merge_keys_features=tuple(ratings.KEYS),
    bound=("event_timestamp",),
    uses_clock=True,
    run_features=False,
)

BELIEF = Entity(
    name="belief",
    bronze="batch/belief_data",
    snapshot="latest",
    table_cleaned="belief_cleaned",
    table_features="belief_features",
    clean=belief.clean,
    features=belief.features,
    cleaned_schema=belief.CLEANED_SCHEMA,
    features_schema=belief.FEATURES_SCHEMA,
    merge_keys_cleaned=tuple(belief.KEYS),
    merge_keys_features=tuple(belief.KEYS),
    bound=("event_timestamp",),
)

ELICITATION = Entity(
    name="elicitation",
    bronze="batch/movie_elicitation_set",
    snapshot="latest",
    table_cleaned="elicitation_cleaned",
    table_features="elicitation_features",
    clean=elicitation.clean,
    features=elicitation.features,
    cleaned_schema=elicitation.CLEANED_SCHEMA,
    features_schema=elicitation.FEATURES_SCHEMA,
    merge_keys_cleaned=tuple(elicitation.KEYS),
    merge_keys_features=tuple(elicitation.KEYS),
    bound=("event_timestamp",),
    uses_clock=True,
)

RECOMMENDATIONS = Entity(
    name="recommendation_history",
    bronze="streaming/user_recommendation_history",
    bronze_schema=f"userId string, tstamp string, movieId string, predictedRating string, {STREAM_AUDIT}",
    snapshot="all",
    table_cleaned="recommendation_history_cleaned",
    table_features="recommendation_features",
    clean=recommendations.clean,
    features=recommendations.features,
    cleaned_schema=recommendations.CLEANED_SCHEMA,
    features_schema=recommendations.FEATURES_SCHEMA,
    merge_keys_cleaned=tuple(recommendations.KEYS),
    merge_keys_features=tuple(recommendations.KEYS),
    bound=("event_timestamp",),
)

ENTITIES = {e.name: e for e in (MOVIES, RATINGS, BELIEF, ELICITATION, RECOMMENDATIONS)}
