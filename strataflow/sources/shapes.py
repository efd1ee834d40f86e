"""The given tables in the shapes of the bronze inputs.

Every function maps whole tables, row by row: values are derived, no rows are
left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.operators import stamp_audit
from strataflow.sources.messages import to_messages

INGESTED_AT = "2024-06-01 00:00:00"


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ingested(offset: Column | None = None) -> Column:
    start = F.lit(INGESTED_AT).cast("timestamp")
    if offset is None:
        return start
    return F.timestamp_seconds(F.unix_timestamp(start) + offset)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = given(spark, sf_dir, "lineitem")
    orders = given(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, name = F.col("p_partkey"), F.col("p_name")
    dated = F.concat(name, F.lit(" ("), (F.lit(1950) + F.col("p_size")).cast("string"), F.lit(")"))
    title = (
        F.when(key % 41 == 0, F.lit(None).cast("string"))
        .when(key % 37 == 0, name)
        .when(key % 43 == 0, F.concat(name, F.lit(" (1700)")))
        .otherwise(dated)
    )
    listed = F.concat("p_type", F.lit("| "), F.split_part(name, F.lit(" "), F.lit(2)), F.lit("|"), "p_type")
    genres = (
        F.when(key % 29 == 0, F.lit(None).cast("string"))
        .when(key % 31 == 0, F.lit("(no genres listed)"))
        .otherwise(listed)
    )
    rows = given(spark, sf_dir, "part").select(
        key.cast("int").alias("movie_id"), title.alias("title"), genres.alias("genres")
    )
    return stamp_audit(rows, "postgres", ingested_at=_ingested())


def rating_rows(spark: SparkSession, sf_dir: str, movie: str = "l_partkey") -> DataFrame:
    """Text columns, as they arrive from the stream, and the ingestion order."""
    return _lines(spark, sf_dir).select(
        F.col("o_custkey").cast("string").alias("userId"),
        F.col(movie).cast("string").alias("movieId"),
        (F.col("l_quantity") / 10).cast("string").alias("rating"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("tstamp"),
        F.col("l_linenumber").alias("_seq"),
    )


def ratings(spark: SparkSession, sf_dir: str, movie: str = "l_partkey") -> DataFrame:
    topic = F.lit("csv-ratings_for_additional_users")
    rows = rating_rows(spark, sf_dir, movie)
    return stamp_audit(rows, "kafka", topic, _ingested(F.col("_seq"))).drop("_seq")


def belief(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = F.col("l_linenumber") % 3 - 1
    score, line = F.col("l_quantity") / 10, F.col("l_linenumber")
    rows = _lines(spark, sf_dir).select(
        F.col("o_custkey").cast("int").alias("user_id"),
        F.col("l_partkey").cast("int").alias("movie_id"),
        seen.cast("smallint").alias("is_seen"),
        F.when(seen == 1, F.date_format("l_shipdate", "yyyy-MM-dd")).otherwise("").alias("watch_date"),
        F.when(seen == 1, score).otherwise(-1.0).alias("user_elicit_rating"),
        F.when(seen == 1, -1.0).otherwise(score).alias("user_predict_rating"),
        F.when(line % 5 == 0, -1.0).otherwise((line % 5 + 1).cast("double")).alias("user_certainty"),
        F.col("l_shipdate").cast("timestamp").alias("tstamp"),
        F.col("l_suppkey").cast("int").alias("movie_idx"),
        (line % 5 + 1).cast("int").alias("source"),
        (F.col("l_discount") * 50).alias("system_predict_rating"),
        line.alias("_seq"),
    )
    return stamp_audit(rows, "postgres", ingested_at=_ingested(F.col("_seq"))).drop("_seq")


def elicitation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = given(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("int").alias("movie_id"),
        (F.col("o_orderkey") % 12 - 1).cast("int").alias("month_idx"),
        (F.col("o_orderkey") % 7).cast("int").alias("source"),
        F.col("o_orderdate").cast("timestamp").alias("tstamp"),
    )
    return stamp_audit(rows, "postgres", ingested_at=_ingested())


def recommendation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("userId"),
        F.unix_timestamp(F.col("ts").cast("timestamp")).cast("string").alias("tstamp"),
        F.get_json_object("props", "$.k").alias("movieId"),
        (F.col("value") / 50).cast("string").alias("predictedRating"),
    )


def recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = F.lit("csv-user_recommendation_history")
    return stamp_audit(recommendation_rows(spark, sf_dir), "kafka", topic, _ingested())


EVENT_COLUMNS = ["event_id", "user_id", "value", "ts"]
# One kind of event has no registered schema.
EVENT_SCHEMAS = {kind: EVENT_COLUMNS for kind in ("click", "purchase", "signup", "view")}


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = given(spark, sf_dir, "events").select(
        "event_type",
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("value").cast("decimal(12,2)").cast("string").alias("value"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"),
    )
    return to_messages(rows, F.col("event_type"), EVENT_COLUMNS)


def order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file header per order: the status proposes the name, the priority gives the columns."""
    return given(spark, sf_dir, "orders").select(
        F.concat(F.lit("in/"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0"), F.lit(".csv")).alias(
            "file_path"
        ),
        F.col("o_orderstatus").alias("schema_name"),
        F.split("o_orderpriority", "-").alias("columns"),
    )


SILVER_INPUTS = {
    "movies": movies,
    "ratings": ratings,
    "belief": belief,
    "elicitation": elicitation,
    "recommendation_history": recommendations,
}
