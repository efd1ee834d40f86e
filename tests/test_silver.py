from __future__ import annotations

from pyspark.sql import functions as F

from strataflow.plans.entities import ENTITIES
from strataflow.plans.silver import belief, elicitation, movies, ratings, recommendations
from tests.conftest import rows


def T(text):
    return F.lit(text).cast("timestamp")


def raw_movies(spark, data):
    df = spark.createDataFrame(data, "movie_id int, title string, genres string")
    return df.withColumns({"_ingestion_timestamp": T("2024-01-01"), "_source": F.lit("postgres")})


def test_titles_and_years(spark):
    titles = [
        "Toy Story (1995)", "Foo (1990) (1995)", "NoYear", "Bar (1995) ", "Baz (2001) extended", " (1999)", None,
        "Old (1887)", "First (1888)", "Last (2028)", "Next (2029)",
    ]
    cleaned = movies.clean(raw_movies(spark, [(i, t, "A") for i, t in enumerate(titles)]))
    assert rows(cleaned.select("title", "release_year")) == [
        ("First", 1888), ("Foo (1990)", 1990), ("Last", 2028), ("Toy Story", 1995),
    ]
    assert cleaned.columns[-1] == "processed_timestamp"


def test_genres(spark):
    data = [(1, "A (2000)", None), (2, "B (2000)", "Action|Sci-Fi| |(no genres listed)|action"), (3, "C (2000)", "")]
    genres = movies.features(movies.clean(raw_movies(spark, data)))
    assert rows(genres) == [(1, "unknown"), (2, "action"), (2, "sci-fi")]


def stream_rows(spark, data, cols):
    df = spark.createDataFrame(data, f"{cols}, at string")
    return df.withColumns(
        {"_ingestion_timestamp": F.col("at").cast("timestamp"), "_source": F.lit("kafka"), "_topic": F.lit("csv-x")}
    ).drop("at")


def test_ratings(spark):
    at = "2024-01-01 10:00:00"
    data = [
        ("1", "10", "4.5", at, "2024-02-01"),
        ("1", "10", "3.0", at, "2024-02-02"),  # later ingestion wins
        ("2", "10", "NA", at, "2024-02-01"),
        ("3", "10", "-1", at, "2024-02-01"),
        ("4", "10", "0.4", at, "2024-02-01"),
        ("5", "10", "5.5", at, "2024-02-01"),
        ("6.0", "10", "0.5", at, "2024-02-01"),
        ("7", "10", "4.0", "1700000000", "2024-02-01"),  # not a timestamp text: dropped
        ("x", "10", "4.0", at, "2024-02-01"),
        ("8", None, "4.0", at, "2024-02-01"),
    ]
    raw = stream_rows(spark, data, "userId string, movieId string, rating string, tstamp string")
    cleaned = ratings.clean(raw)
    assert rows(cleaned.select("user_id", "rating")) == [(1, 3.0), (2, None), (3, None), (4, None), (5, None), (6, 0.5)]
    assert ratings.clean(raw, event_time="either").count() == 7
    features = ratings.features(cleaned, T("2024-01-11 09:00:00"))
    assert rows(features.select("user_id", "rating_category", "is_positive", "rating_bucket", "recency_days"))[:2] == [
        (1, "medium", False, "mid", 10), (2, "high", None, None, 10),
    ]


def test_recommendations(spark):
    data = [
        ("1", "1700000000", "10", "0.0", "2024-02-01"),
        ("2", "1700000000.5", "10", "5.01", "2024-02-01"),
        ("3", "2024-01-01", "10", "4.0", "2024-02-01"),  # not epoch seconds: dropped
    ]
    raw = stream_rows(spark, data, "userId string, tstamp string, movieId string, predictedRating string")
    features = recommendations.features(recommendations.clean(raw))
    assert rows(features.select("user_id", "predicted_rating_category", "is_high_score", "predicted_rating_bucket")) == [
        (1, "low", False, "very_low"), (2, "high", None, None),
    ]


def test_belief(spark):
    cols = (
        "user_id int, movie_id int, is_seen smallint, watch_date string, user_elicit_rating double, "
        "user_predict_rating double, user_certainty double, tstamp string, movie_idx int, source int, "
        "system_predict_rating double"
    )
    at = "2024-01-01 10:00:00"
    data = [
        (1, 1, 1, "2024-01-02", 4.0, -1.0, 4.0, at, 7, 2, 3.33333),
        (1, 2, -1, "", -1.0, 3.0, -1.0, at, 7, 2, -1.0),  # the system's -1 is a value
        (1, 3, 0, "x", 2.0, -1.0, 3.0, None, 7, 2, None),  # no time: kept
        (None, 3, 0, "x", 2.0, -1.0, 3.0, at, 7, 2, None),
    ]
    raw = spark.createDataFrame(data, cols).withColumns(
        {"tstamp": F.col("tstamp").cast("timestamp"), "_ingestion_timestamp": T("2024-01-01"), "_source": F.lit("p")}
    )
    cleaned = belief.clean(raw)
    shown = cleaned.select("movie_id", "is_seen", F.col("watch_date").cast("string"), "user_rating", "predicted_rating",
                           "user_certainty", "system_rating", "source_type")
    assert rows(shown) == [
        (1, 1, "2024-01-02", 4.0, None, 4.0, 3.33333, 2),
        (2, None, None, None, 3.0, None, -1.0, 2),
        (3, 0, None, 2.0, None, 3.0, None, 2),
    ]
    features = belief.features(cleaned).select("movie_id", "has_watched", "rating_diff", "is_high_confidence")
    assert rows(features) == [(1, True, 0.6667, True), (2, None, None, None), (3, False, None, False)]


def test_elicitation(spark):
    at = "2024-01-01 10:00:00"
    data = [(1, -1, 0, at), (2, 0, 1, at), (3, None, 5, at), (4, 3, 6, at), (5, 7, 3, "2020-01-01"), (6, 1, 1, None)]
    raw = spark.createDataFrame(data, "movie_id int, month_idx int, source int, tstamp string").withColumns(
        {"tstamp": F.col("tstamp").cast("timestamp"), "_ingestion_timestamp": T("2024-01-01"), "_source": F.lit("p")}
    )
    features = elicitation.features(elicitation.clean(raw), T("2024-06-01"))
    assert rows(features.select("movie_id", "month_idx", "source_category", "month_group", "is_recent")) == [
        (1, None, None, "unknown", True),
        (2, 0, "popular", "early_stage", True),
        (3, None, "serendipity", "unknown", True),
        (4, 3, None, "mid_stage", True),
        (5, 7, "recent_popular", "late_stage", False),
    ]


def test_schemas_are_the_contract(spark):
    from pyspark.sql.types import StructType

    from strataflow.sources import shapes

    for entity in ENTITIES.values():
        raw = shapes.SILVER_INPUTS[entity.name](spark, "/root/testdata/sf0.001")
        cleaned = entity.build_cleaned(raw)
        for df, ddl in ((cleaned, entity.cleaned_schema), (entity.build_features(cleaned), entity.features_schema)):
            assert df.dtypes == [(f.name, f.dataType.simpleString()) for f in StructType.fromDDL(ddl)]
