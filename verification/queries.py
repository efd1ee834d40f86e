"""Every query takes ``(spark, sf_dir)`` and runs over whole tables of that folder.

Averages are rounded to six places here, because the two engines add doubles in
different orders; the library does not round. Times of processing are left out,
and clocks are fixed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.functions import (
    at_least,
    bucketize,
    clamp_between,
    clamp_in,
    days_since,
    difference,
    iso_day_of_week,
    label_map,
    null_sentinel,
    parse_date,
    parse_epoch,
    within_days,
)
from strataflow.operators import dedup_latest, explode_delimited, quality_report, table_profile
from strataflow.operators.profiles import EXACT, PARTS_SCHEMA, merge_profiles, profile_of, profile_parts
from strataflow.plans import checks
from strataflow.plans.build import build, read_mart, resolver
from strataflow.plans.entities import BELIEF, ELICITATION, ENTITIES, MOVIES, RATINGS, RECOMMENDATIONS
from strataflow.plans.gold import MODELS, Thresholds, in_order
from strataflow.plans.incremental import read_cleaned, read_features, run_incremental
from strataflow.plans.silver.elicitation import SOURCE_LABELS
from strataflow.plans.silver.labels import BUCKETS, month_group, rating_category
from strataflow.plans.silver.ratings import RATING_RANGE
from strataflow.session import apply_defaults
from strataflow.sources import shapes
from strataflow.sources.bronze import ingest_csv, ingest_table, load_to_bronze, rejects_path
from strataflow.sources.catalog import ensure_database, get_checkpoint, register_table
from strataflow.sources.changes import changes_since
from strataflow.sources.csv_files import HEADERS_SCHEMA, csv_stream, csv_tail, load_csv
from strataflow.sources.csv_tail import csv_tail_stream
from strataflow.sources.files import arrow_path, drop_path, glob_paths, make_folder, new_scratch
from strataflow.sources.messages import file_messages, inferred_columns, parse_messages, proposed_headers, tail_messages, to_messages
from strataflow.sources.registry import canonical_schemas, list_file_mappings, list_schemas, load_schemas
from strataflow.sources.shapes import given
from strataflow.sources.versions import insert_only_merge, read_since, version_path, write_version
from strataflow.streaming import route_messages, start_bronze_stream
from strataflow.streaming.ingest import quarantine_path, replay_quarantine, stream_path, unregistered, version_for

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2001-06-01 00:00:00"
# Few parts of the given data reach the published thresholds; suppliers do.
PART_THRESHOLDS = Thresholds(min_ratings=30, underrated_below=40)
ROUNDED = ("avg_rating", "avg_ratings", "pct_positive", "quality")
QUERIES: dict[str, Query] = {}


def query(key: str) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_defaults(spark)
            return fn(spark, sf_dir)

        QUERIES[key] = run
        return fn

    return add


def _as_of():
    return F.lit(AS_OF).cast("timestamp")


def comparable(df: DataFrame) -> DataFrame:
    df = df.drop("processed_timestamp")
    return df.withColumns({c: F.round(c, 6) for c in ROUNDED if c in df.columns})


# --- models ------------------------------------------------------------------


def model_ref(
    spark: SparkSession, sf_dir: str, thresholds: Thresholds = PART_THRESHOLDS, movie: str = "l_partkey"
):
    """``ref`` over the given tables, nothing stored in between."""

    def raw(entity):
        if entity is RATINGS:
            return shapes.ratings(spark, sf_dir, movie)
        return shapes.SILVER_INPUTS[entity.name](spark, sf_dir)

    tables = {}
    for entity in ENTITIES.values():
        tables[entity.table_cleaned] = lambda e=entity: e.build_cleaned(raw(e))
        tables[entity.table_features] = lambda e=entity: e.build_features(e.build_cleaned(raw(e)), _as_of())
    return resolver(tables, thresholds)


def _model_query(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_defaults(spark)
        df = model_ref(spark, sf_dir)(name)
        return comparable(in_order(name, df) if name in MODELS else df)

    return run


SILVER_QUERIES = {
    "movies_cleaned": "movies_cleaned",
    "movie_genres": "movie_genres",
    "ratings_cleaned": "ratings_cleaned",
    "rating_features": "rating_features",
    "belief_cleaned": "belief_cleaned",
    "belief_features": "belief_features",
    "elicitation_cleaned": "elicitation_cleaned",
    "elicitation_features": "elicitation_features",
    "recommendation_cleaned": "recommendation_history_cleaned",
    "recommendation_features": "recommendation_features",
}
QUERIES.update({key: _model_query(name) for key, name in SILVER_QUERIES.items()})
QUERIES.update({name: _model_query(name) for name, m in MODELS.items() if m.layer != "rollup"})


@query("supplier_metrics")
def supplier_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movie metrics with the published thresholds, at a grain that reaches them."""
    return comparable(model_ref(spark, sf_dir, Thresholds(), "l_suppkey")("int_movie_metrics"))


@query("supplier_top")
def supplier_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(model_ref(spark, sf_dir, Thresholds(), "l_suppkey")("gold_top_movies"))


@query("customer_underrated")
def customer_underrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published thresholds of underrated movies at the grain of customers, who have 50 to 99 ratings."""
    return comparable(model_ref(spark, sf_dir, Thresholds(), "o_custkey")("gold_underrated_movies"))


# --- single operators ----------------------------------------------------------


@query("dedup_latest")
def dedup_stress(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = given(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp"))
    return dedup_latest(lines, ["l_orderkey", "l_linenumber"], "l_shipdate")


@query("bucketize")
def bucketized(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = F.col("l_quantity") / 10
    bucket = bucketize(score, RATING_RANGE[0], BUCKETS)
    return (
        given(spark, sf_dir, "lineitem")
        .groupBy(bucket.alias("bucket"), rating_category(clamp_between(score, 0.5, 4.0)).alias("category"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(score).alias("low"), F.max(score).alias("high"))
    )


@query("clamp_domain")
def clamped_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = given(spark, sf_dir, "orders")
    return orders.select(
        "o_orderkey",
        clamp_between("o_totalprice", 50000.0, 250000.0).alias("price_in_range"),
        clamp_between((F.col("o_orderkey") % 12 - 1).cast("int"), lo=0).alias("month_idx"),
        clamp_in((F.col("o_orderkey") % 7).cast("int"), list(SOURCE_LABELS)).alias("source_type"),
    )


@query("sentinel_nulls")
def sentinel_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = (F.col("l_linenumber") % 3 - 1).cast("int")
    return (
        given(spark, sf_dir, "lineitem")
        .groupBy(null_sentinel(flag).alias("is_seen"), (null_sentinel(flag) == 1).alias("has_watched"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query("parsed_times")
def parsed_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank and unreadable dates, and epoch seconds as text."""
    ts = F.col("ts").cast("timestamp")
    text = (
        F.when(F.col("event_type") == "error", "")
        .when(F.col("event_type") == "view", "  ")
        .when(F.col("event_type") == "click", "not a date")
        .otherwise(F.date_format(ts, "yyyy-MM-dd"))
    )
    seconds = F.unix_timestamp(ts).cast("string")
    return given(spark, sf_dir, "events").select(
        "event_id",
        parse_date(text).alias("day"),
        parse_epoch(seconds).alias("at"),
        parse_epoch(text).alias("none_of_these"),
    )


@query("explode_delimited")
def exploded_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = given(spark, sf_dir, "part")
    return explode_delimited(parts, "p_name", " ", "token", ["p_brand"], drop=["bolt"])


@query("code_label_map")
def labelled_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = (F.col("o_orderkey") % 7).cast("int")
    month = clamp_between((F.col("o_orderkey") % 12 - 1).cast("int"), lo=0)
    return (
        given(spark, sf_dir, "orders")
        .groupBy(label_map(code, SOURCE_LABELS).alias("source_category"), month_group(month).alias("month_group"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query("flags_and_differences")
def flags_and_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = clamp_between(F.col("l_quantity") / 10, 0.5, 4.5)
    shown = F.col("l_discount") * 50
    return (
        given(spark, sf_dir, "lineitem")
        .groupBy(at_least(score, 4).alias("is_positive"), difference(score, shown).alias("rating_diff"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query("recency")
def recency(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("timestamp")
    return (
        given(spark, sf_dir, "orders")
        .groupBy(
            days_since(day, _as_of()).alias("recency_days"),
            within_days(day, 365, _as_of()).alias("is_recent"),
            iso_day_of_week(day).alias("day_of_week"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query("quality_not_null")
def quality_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = quality_report(shapes.movies(spark, sf_dir), not_null=["movie_id", "title", "genres"])
    declared = checks.silver_checks(model_ref(spark, sf_dir))
    return declared.unionAll(raw.select(F.lit("movies").alias("table"), "*"))


@query("quality_unique")
def quality_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [("lineitem", "l_orderkey"), ("orders", "o_orderkey"), ("customer", "c_custkey"), ("events", "user_id")]
    reports = [
        quality_report(given(spark, sf_dir, t), unique=[c]).select(F.lit(t).alias("table"), "*")
        for t, c in parts
    ]
    return reduce(DataFrame.unionAll, reports)


@query("table_profile")
def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["user_id", "movie_id", "rating"]
    described = table_profile(model_ref(spark, sf_dir)("ratings_cleaned"), cols)
    return described.select("summary", *[F.round(F.col(c).cast("double"), 4).alias(c) for c in cols])


# --- storage, merges and runs --------------------------------------------------


@query("incremental_read")
def incremental_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three versions by order status; what came after the first."""
    path = new_scratch(spark, "incremental-read")
    orders = given(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    for version, status in enumerate(("F", "O", "P")):
        write_version(orders.where(F.col("o_orderstatus") == status), path, version)
    return read_since(spark, path, 0)


@query("insert_only_merge")
def merged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of open status first, then all of them with another price: known ones stay as they are."""
    path = new_scratch(spark, "merge")
    orders = given(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice")
    keys = ["o_orderkey", "o_orderdate"]
    insert_only_merge(orders.where(F.col("o_orderstatus") == "O"), path, keys, 0)
    insert_only_merge(
        orders.withColumn("o_totalprice", F.lit(0.0)), path, keys, 1, bound=["o_orderdate"]
    )
    return read_since(spark, path).withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))


def _loaded_twice(spark: SparkSession, sf_dir: str, entity, label: str) -> str:
    """Bronze in two versions, the early rows and then all of them; a run after each and one more.

    The second version has other ratings for the early rows, which must not get through.
    """
    base = new_scratch(spark, label)
    raw = shapes.SILVER_INPUTS[entity.name](spark, sf_dir)
    early = F.col("tstamp") < "1998-01-01"
    write_version(raw.where(early), entity.bronze_path(base), 0)
    run_incremental(spark, entity, base, _as_of(), database=None)
    if entity is RATINGS:
        raw = raw.withColumn("rating", F.when(early, F.lit("0.5")).otherwise(F.col("rating")))
    write_version(raw, entity.bronze_path(base), 1)
    run_incremental(spark, entity, base, _as_of(), database=None)
    run_incremental(spark, entity, base, _as_of(), database=None)
    return base


@query("incremental_ratings")
def incremental_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _loaded_twice(spark, sf_dir, RATINGS, "run-ratings")
    return comparable(read_cleaned(spark, RATINGS, base))


@query("incremental_belief_features")
def incremental_belief_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _loaded_twice(spark, sf_dir, BELIEF, "run-belief")
    return comparable(read_features(spark, BELIEF, base))


@query("bronze_load")
def bronze_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load replaces the one before, columns and all."""
    base = new_scratch(spark, "bronze")
    supplier = given(spark, sf_dir, "supplier")
    load_to_bronze(spark, supplier.select("s_suppkey", "s_name"), "supplier", base)
    path = load_to_bronze(spark, supplier, "supplier", base)
    return read_since(spark, path, snapshot="latest").drop("_ingestion_timestamp")


@query("gold_build")
def gold_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored way: silver tables, then one mart from them, read back with silver titles."""
    base = new_scratch(spark, "gold-build")
    for entity in (MOVIES, RATINGS):
        write_version(shapes.SILVER_INPUTS[entity.name](spark, sf_dir), entity.bronze_path(base), 0)
        run_incremental(spark, entity, base, database=None)
    build(spark, base, "gold_movie_popularity_vs_quality", PART_THRESHOLDS, database=None)
    mart = read_mart(spark, base, "gold_movie_popularity_vs_quality")
    silver = read_cleaned(spark, MOVIES, base).select("movie_id", "genres_raw")
    return comparable(mart.join(silver, "movie_id", "left"))


# --- files and messages ----------------------------------------------------------


def _orders_as_csv(spark: SparkSession, sf_dir: str) -> str:
    path = new_scratch(spark, "csv")
    given(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority").write.csv(path, header=True)
    return path


@query("csv_load")
def csv_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _orders_as_csv(spark, sf_dir)
    return load_csv(spark, path, "o_orderkey bigint, o_custkey bigint, o_orderpriority string")


@query("csv_tail")
def csv_tail_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows on the first pass, none past the offsets it leaves on the second."""
    files = glob_paths(spark, f"{_orders_as_csv(spark, sf_dir)}/*.csv")
    columns = ["o_orderkey", "o_custkey", "o_orderpriority"]
    first, offsets = csv_tail(spark, files, columns)
    again, _ = csv_tail(spark, files, columns, offsets)
    both = first.select(F.lit("first").alias("pass"), *columns).unionAll(
        again.select(F.lit("again").alias("pass"), *columns)
    )
    return both.select("pass", F.col("o_orderkey").cast("bigint"), F.col("o_custkey").cast("bigint"), "o_orderpriority")


@query("canonical_schemas")
def canonical_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = canonical_schemas(shapes.order_headers(spark, sf_dir))
    return registry.select("file_path", "schema_name", F.array_join("columns", ",").alias("columns"))


@query("parse_topic_json")
def parsed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = load_schemas(shapes.EVENT_SCHEMAS)["click"]
    return parse_messages(shapes.event_messages(spark, sf_dir), schema)


def _streamed(spark: SparkSession, sf_dir: str, label: str) -> str:
    """All events as messages through the checkpointed stream."""
    base = new_scratch(spark, label)
    shapes.event_messages(spark, sf_dir).write.json(f"{base}/in")
    start_bronze_stream(
        file_messages(spark, f"{base}/in", files_per_batch=4),
        lambda: load_schemas(shapes.EVENT_SCHEMAS),
        base,
        f"{base}/checkpoint",
        available_now=True,
    ).awaitTermination()
    return base


@query("stream_to_bronze")
def stream_to_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _streamed(spark, sf_dir, "stream")
    tables = [read_since(spark, stream_path(base, name)) for name in sorted(shapes.EVENT_SCHEMAS)]
    return reduce(DataFrame.unionAll, tables).drop("_ingestion_timestamp")


@query("stream_quarantine")
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _streamed(spark, sf_dir, "stream-quarantine")
    rejected = read_since(spark, quarantine_path(base))
    return rejected.select(F.get_json_object("data", "$.event_id").alias("event_id"), "error")


@query("stream_to_silver")
def stream_to_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole way of a streamed table: messages, bronze by the stream, silver by a run."""
    base = new_scratch(spark, "stream-silver")
    name = "user_recommendation_history"
    sent = to_messages(shapes.recommendation_rows(spark, sf_dir), F.lit(name))
    sent.write.json(f"{base}/in")
    start_bronze_stream(
        file_messages(spark, f"{base}/in"),
        lambda: load_schemas({name: ["userId", "tstamp", "movieId", "predictedRating"]}),
        f"{base}/bronze",
        f"{base}/checkpoint",
        available_now=True,
    ).awaitTermination()
    run_incremental(spark, RECOMMENDATIONS, base, database=None)
    return comparable(read_cleaned(spark, RECOMMENDATIONS, base)).drop("ingestion_timestamp")


@query("csv_to_bronze")
def csv_to_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New CSV files as a stream of messages into the bronze table of their schema."""
    base = new_scratch(spark, "csv-bronze")
    columns = ["o_orderkey", "o_custkey", "o_orderpriority"]
    orders = given(spark, sf_dir, "orders").select(*columns)
    orders.write.csv(f"{base}/in", header=True)
    start_bronze_stream(
        to_messages(csv_stream(spark, f"{base}/in", columns), F.lit("orders")),
        lambda: load_schemas({"schemas": {"orders": columns}}),
        base,
        f"{base}/checkpoint",
        available_now=True,
    ).awaitTermination()
    return read_since(spark, stream_path(base, "orders")).drop("_ingestion_timestamp")


@query("stream_new_checkpoint")
def stream_new_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two halves of the events through two queries with checkpoints of their own: all rows are there."""
    base, name = new_scratch(spark, "stream-again"), "orders"
    columns = ["o_orderkey", "o_orderstatus"]
    orders = given(spark, sf_dir, "orders").select(*columns)
    for n in range(2):
        half = orders.where(F.col("o_orderkey") % 2 == n)
        to_messages(half, F.lit(name)).write.json(f"{base}/in{n}")
        start_bronze_stream(
            file_messages(spark, f"{base}/in{n}"),
            lambda: load_schemas({name: columns}),
            base,
            f"{base}/checkpoint{n}",
            available_now=True,
        ).awaitTermination()
    return read_since(spark, stream_path(base, name)).select(*columns)


def _own_database(spark: SparkSession, label: str) -> tuple[str, str]:
    path = new_scratch(spark, label)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    ensure_database(spark, name, f"{path}/database")
    return path, name


@query("stream_catalog")
def stream_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches, the second of which the catalog never heard of; the table shows all of them after the third."""
    path, database = _own_database(spark, "stream-catalog")
    columns = ["o_orderkey", "o_orderstatus"]
    messages = to_messages(given(spark, sf_dir, "orders").select(*columns), F.lit("orders"))
    key = F.get_json_object("value", "$.o_orderkey").cast("bigint")
    for n in range(3):
        shown = database if n != 1 else None
        route_messages(messages.where(key % 3 == n), n, load_schemas({"orders": columns}), path, database=shown)
    return spark.table(f"{database}.orders").select(*columns)


@query("catalog_uncommitted")
def catalog_uncommitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three versions, the second without its marker: the table shows the first and the third."""
    path, database = _own_database(spark, "uncommitted")
    orders = given(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    for n in range(3):
        write_version(orders.where(F.col("o_orderkey") % 3 == n), f"{path}/orders", n)
    drop_path(spark, f"{version_path(f'{path}/orders', 1)}/_SUCCESS")
    register_table(spark, f"{database}.orders", f"{path}/orders", orders.schema)
    return spark.table(f"{database}.orders").select("o_orderkey", "o_totalprice")


@query("canonical_schemas_known")
def canonical_schemas_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the files are known; the other half comes, then one of them again with ``force_refresh``: all entries stay."""
    headers = shapes.order_headers(spark, sf_dir)
    late = F.crc32(F.col("file_path").cast("binary")) % 2 == 0
    known = canonical_schemas(headers.where(~late))
    both = canonical_schemas(headers.where(late), known)
    again = canonical_schemas(headers.where(late), both, force_refresh=True)
    return again.select("file_path", F.array_join("columns", ",").alias("columns"))


@query("features_backfill")
def features_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of ratings without features, then with: the features of all of them."""
    base = _loaded_twice(spark, sf_dir, RATINGS, "run-backfill")
    switched = replace(RATINGS, run_features=True)
    run_incremental(spark, switched, base, _as_of(), database=None)
    return comparable(read_features(spark, switched, base))


@query("catalog_run")
def catalog_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs with a database; the table is read through the catalog, with the checkpoint on it."""
    path, database = _own_database(spark, "catalog-run")
    raw = shapes.SILVER_INPUTS["ratings"](spark, sf_dir)
    for n in range(2):
        write_version(raw.where(F.col("userId").cast("bigint") % 2 == n), RATINGS.bronze_path(path), n)
        run_incremental(spark, RATINGS, path, _as_of(), database=database)
    table = f"{database}.{RATINGS.table_cleaned}"
    shown = spark.table(table).drop("_version")
    return comparable(shown).withColumn("checkpoint", F.lit(get_checkpoint(spark, table)))


# What a mart holds, in columns that all marts share: a name, a count, an average and one more number.
MART_VIEWS = {
    "gold_genre_popularity": ("genre", "total_ratings", "avg_ratings", "NULL"),
    "gold_genre_popularity_vs_quality": ("genre", "popularity", "quality", "NULL"),
    "gold_least_rated_movies": ("CAST(movie_id AS STRING)", "total_ratings", "avg_rating", "release_year"),
    "gold_most_rated_movies": ("CAST(movie_id AS STRING)", "total_ratings", "avg_rating", "release_year"),
    "gold_movie_popularity_vs_quality": ("CAST(movie_id AS STRING) || coalesce(title, '')", "popularity", "quality", "release_year"),
    "gold_rating_distribution": ("'rating'", "total_ratings", "rating", "NULL"),
    "gold_rating_seasonality": ("CAST(month AS STRING) || '/' || CAST(day_of_week AS STRING)", "total_ratings", "avg_rating", "NULL"),
    "gold_ratings_over_time": ("CAST(event_date AS STRING)", "total_ratings", "avg_rating", "pct_positive"),
    "gold_top_movies": ("CAST(movie_id AS STRING)", "total_ratings", "avg_rating", "release_year"),
    "gold_underrated_movies": ("CAST(movie_id AS STRING) || title", "total_ratings", "avg_rating", "NULL"),
    "gold_user_activity": ("CAST(user_id AS STRING) || ' ' || CAST(CAST(last_activity AS DATE) AS STRING)", "total_ratings", "avg_rating", "pct_positive"),
    "gold_user_genre_preference": ("CAST(user_id AS STRING) || genre", "total_ratings", "avg_rating", "rank_genre"),
    "gold_worst_movies": ("CAST(movie_id AS STRING)", "total_ratings", "avg_rating", "release_year"),
}


def mart_view(mart: str) -> list[str]:
    name, total, average, extra = MART_VIEWS[mart]
    return [
        f"'{mart}' AS mart",
        f"{name} AS name",
        f"CAST({total} AS BIGINT) AS total",
        f"round(CAST({average} AS DOUBLE), 6) AS average",
        f"round(CAST({extra} AS DOUBLE), 6) AS extra",
    ]


def all_marts(read: Callable[[str], DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, [read(m).selectExpr(*mart_view(m)) for m in sorted(MART_VIEWS)])


@query("gold_build_all")
def gold_build_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stored marts built by tag with a database of their own; what the catalog shows of each."""
    path, database = _own_database(spark, "gold-all")
    for entity in (MOVIES, RATINGS):
        write_version(shapes.SILVER_INPUTS[entity.name](spark, sf_dir), entity.bronze_path(path), 0)
        run_incremental(spark, entity, path, database=database)
    build(spark, path, "tag:gold", PART_THRESHOLDS, database=database)
    return all_marts(lambda m: spark.table(f"{database}.{m}"))


@query("gold_incremental")
def gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three silver versions of ratings and two of movies, so that genres come after ratings of their movies; marts from kept rollups after each."""
    base = new_scratch(spark, "gold-incremental")
    ratings, movies = (shapes.SILVER_INPUTS[e.name](spark, sf_dir) for e in (RATINGS, MOVIES))
    third = F.pmod(F.xxhash64("userId", "movieId", "tstamp"), F.lit(3))
    for n in range(3):
        write_version(ratings.where(third == n), RATINGS.bronze_path(base), n)
        run_incremental(spark, RATINGS, base, database=None)
        if n < 2:
            write_version(movies.where(F.col("movie_id") % 2 <= n), MOVIES.bronze_path(base), n)
            run_incremental(spark, MOVIES, base, database=None)
        build(spark, base, "tag:gold", PART_THRESHOLDS, database=None, incremental=True)
    return all_marts(lambda m: read_mart(spark, base, m))


# --- what changed, what does not fit, what comes back -------------------------------


@query("change_feed")
def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of orders: a tenth is new, another has new prices, one is there twice before, one is gone after."""
    path = new_scratch(spark, "change-feed")
    orders = given(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    kind = F.col("o_orderkey") % 10
    price = F.when(kind == 1, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    before = orders.where(kind != 0).withColumn("o_totalprice", price)
    write_version(before.unionAll(before.where(kind == 2)), path, 0)
    write_version(orders.where(kind != 3), path, 1)
    feed = changes_since(spark, path, 0, ["o_orderkey"])
    return feed.withColumnsRenamed({"_change_type": "change_type", "_commit_version": "commit_version"})


@query("change_feed_run")
def change_feed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over a reload: the feed since the first load is what is cleaned, and the table is that of everything."""
    base = new_scratch(spark, "change-run")
    raw = shapes.SILVER_INPUTS["elicitation"](spark, sf_dir)
    write_version(raw.where(F.col("movie_id") % 100 != 0), ELICITATION.bronze_path(base), 0)
    run_incremental(spark, ELICITATION, base, _as_of(), database=None)
    write_version(raw, ELICITATION.bronze_path(base), 1)
    run_incremental(spark, ELICITATION, base, _as_of(), database=None)
    return comparable(read_features(spark, ELICITATION, base))


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderpriority"]


def _grow(spark: SparkSession, parts: DataFrame, folder: str) -> None:
    """Add the CSV lines of ``parts`` (bucket, orders) to a file per bucket, as another program would that appends to its files."""
    written = new_scratch(spark, "csv-parts")
    parts.repartition("bucket").write.partitionBy("bucket").csv(written)
    make_folder(spark, folder)
    store, source = arrow_path(written)
    _, target = arrow_path(folder)
    for bucket in sorted(b.rsplit("=", 1)[1] for b in glob_paths(spark, f"{written}/bucket=*")):
        name = f"{target}/orders_{bucket}.csv"
        before = store.open_input_file(name).readall() if store.get_file_info(name).is_file else (",".join(ORDER_COLUMNS) + "\n").encode()
        with store.open_output_stream(name) as out:
            out.write(before)
            for part in glob_paths(spark, f"{written}/bucket={bucket}/*.csv"):
                with store.open_input_stream(arrow_path(part)[1]) as f:
                    while block := f.read(1 << 20):
                        out.write(block)


@query("csv_tail_to_bronze")
def csv_tail_to_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that grow between three starts of the tail; every row is in bronze once."""
    base = new_scratch(spark, "csv-tail")
    orders = given(spark, sf_dir, "orders").select(*ORDER_COLUMNS, (F.col("o_orderkey") % 4).alias("bucket"))
    registry = spark.createDataFrame([(f"orders_{n}.csv", "orders", ORDER_COLUMNS) for n in range(4)], HEADERS_SCHEMA)
    third = F.pmod(F.xxhash64("o_orderkey"), F.lit(3))
    for n in range(3):
        # Bucket 3 appears with the second start.
        share = (third == n) & ((F.col("bucket") != 3) | (n > 0))
        late = (third == 0) & (F.col("bucket") == 3) & (n == 1)
        _grow(spark, orders.where(share | late), f"{base}/in")
        start_bronze_stream(
            tail_messages(csv_tail_stream(spark, f"{base}/in", split_bytes=1 << 16), registry),
            lambda: load_schemas({"orders": ORDER_COLUMNS}),
            base,
            f"{base}/checkpoint",
            available_now=True,
        ).awaitTermination()
    return read_since(spark, stream_path(base, "orders")).drop("_ingestion_timestamp")


@query("csv_rejects")
def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as CSV lines, some cut short, some too long, some with text in place of a number: rows and rejects of a checked load."""
    base = new_scratch(spark, "csv-rejects")
    key = F.col("o_orderkey")
    line = (
        F.when(key % 7 == 0, F.concat_ws(",", "o_orderkey", "o_custkey"))
        .when(key % 11 == 0, F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderpriority", F.lit("more")))
        .when(key % 13 == 0, F.concat_ws(",", F.lit("none"), "o_custkey", "o_orderpriority"))
        .otherwise(F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderpriority"))
    )
    # One column whose name is the header line; its separator is in no line, so nothing is quoted.
    lines = given(spark, sf_dir, "orders").select(line.alias(",".join(ORDER_COLUMNS)))
    lines.write.csv(f"{base}/in", header=True, sep="\x01")
    ingest_csv(spark, f"{base}/in", "o_orderkey bigint, o_custkey bigint, o_orderpriority string", "orders", base, database=_own_database(spark, "csv-rejects")[1])
    good = read_since(spark, f"{base}/batch/orders").select(F.lit("row").alias("kind"), F.concat_ws(",", *ORDER_COLUMNS).alias("line"))
    return good.unionAll(read_since(spark, rejects_path(base, "orders")).select(F.lit("reject").alias("kind"), F.col("data").alias("line")))


def _mixed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages, some of them cut off, without a value, not objects, or without a known field."""
    key = F.get_json_object("value", "$.event_id").cast("bigint")
    spoilt = (
        F.when(key % 7 == 0, F.expr("substr(value, 1, length(value) - 5)"))
        .when(key % 11 == 0, F.lit(None).cast("string"))
        .when(key % 13 == 0, F.concat(F.lit("["), "value", F.lit("]")))
        .when(key % 17 == 0, F.concat(F.lit('{"id": '), key.cast("string"), F.lit("}")))
        .otherwise(F.col("value"))
    )
    return shapes.event_messages(spark, sf_dir).select("topic", spoilt.alias("value"))


@query("json_rejects")
def json_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message is a row or a dead letter with its reason; none is lost and none becomes a row of NULLs."""
    base = new_scratch(spark, "json-rejects")
    route_messages(_mixed_events(spark, sf_dir), 0, load_schemas(shapes.EVENT_SCHEMAS), base)
    good = [read_since(spark, stream_path(base, n)).select("event_id", F.lit("row").alias("outcome")) for n in sorted(shapes.EVENT_SCHEMAS)]
    rejected = read_since(spark, quarantine_path(base)).select(F.col("data").alias("event_id"), F.col("error").alias("outcome"))
    rows = reduce(DataFrame.unionAll, [*good, rejected.withColumn("event_id", F.regexp_extract("event_id", r"(?:event_id|id)\W*(\d+)", 1))])
    return rows.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"), F.sum(F.expr("try_cast(event_id AS bigint)")).alias("ids"))


@query("quarantine_replay")
def quarantine_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches with half of the schemas, then the others are registered and the quarantine is replayed twice: every event is in bronze once."""
    base = new_scratch(spark, "replay")
    messages = shapes.event_messages(spark, sf_dir)
    key = F.get_json_object("value", "$.event_id").cast("bigint")
    few = {n: c for n, c in shapes.EVENT_SCHEMAS.items() if n in ("click", "view")}
    for n in range(2):
        route_messages(messages.where(key % 2 == n), version_for(spark, base, "events", n), load_schemas(few), base)
    schemas = load_schemas({**shapes.EVENT_SCHEMAS, "error": shapes.EVENT_COLUMNS})
    for _ in range(2):
        replay_quarantine(spark, base, schemas)
    tables = [read_since(spark, stream_path(base, name)) for name in sorted(schemas)]
    return reduce(DataFrame.unionAll, tables).drop("_ingestion_timestamp")


@query("quality_observed")
def quality_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and declared not-null checks of silver tables, seen by the jobs that store them."""
    base, ref = new_scratch(spark, "observed"), model_ref(spark, sf_dir)
    reports = [checks.store_checked(ref(t), t, f"{base}/{t}", 0) for t in sorted(checks.DECLARED)]
    return reduce(DataFrame.unionAll, reports)


@query("profile_merged")
def profile_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of three versions, stored with them and merged: the profile of everything."""
    base, cols = new_scratch(spark, "profiles"), ["user_id", "movie_id", "rating"]
    ratings = model_ref(spark, sf_dir)("ratings_cleaned")
    for n in range(3):
        write_version(profile_parts(ratings.where(F.pmod(F.xxhash64("user_id", "movie_id"), F.lit(3)) == n), cols), base, n)
    merged = profile_of(merge_profiles(read_since(spark, base, schema=PARTS_SCHEMA)), cols).where(F.col("summary").isin(*EXACT))
    return merged.select("summary", *[F.round(F.col(c).cast("double"), 4).alias(c) for c in cols])


@query("ingest_one_table")
def ingest_one_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A named table, taken by an extract function, as bronze."""
    base, database = _own_database(spark, "ingest")
    path = ingest_table(spark, "public.customer", base, extract=lambda s, table: given(s, sf_dir, table.rsplit(".", 1)[-1]))
    return read_since(spark, path, snapshot="latest").drop("_ingestion_timestamp")


@query("registry_lookups")
def registry_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which schemas there are, and how many files use each."""
    registry = canonical_schemas(shapes.order_headers(spark, sf_dir))
    used = list_file_mappings(registry).groupBy("schema_name").agg(F.count(F.lit(1)).alias("files"))
    return list_schemas(registry).join(used, "schema_name").select("schema_name", F.array_join("columns", ",").alias("columns"), "files")


@query("registry_per_batch")
def registry_per_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even events under few schemas, then odd ones under all: each batch uses the registry of its time."""
    base = new_scratch(spark, "registry-batch")
    messages = shapes.event_messages(spark, sf_dir)
    key = F.get_json_object("value", "$.event_id").cast("bigint")
    known = {"click": shapes.EVENT_COLUMNS}
    for n in range(2):
        messages.where(key % 2 == n).write.json(f"{base}/in/{n}")
        start_bronze_stream(
            file_messages(spark, f"{base}/in/*", files_per_batch=1000), lambda: load_schemas(known), base, f"{base}/checkpoint", available_now=True
        ).awaitTermination()
        known = shapes.EVENT_SCHEMAS
    found = [read_since(spark, stream_path(base, name)).select("event_id", F.lit(name).alias("place")) for name in sorted(known)]
    rejected = read_since(spark, quarantine_path(base)).select(F.get_json_object("data", "$.event_id").alias("event_id"), F.lit("quarantine").alias("place"))
    return reduce(DataFrame.unionAll, [*found, rejected])


@query("inferred_schemas")
def inferred_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the quarantined events hold, proposed as schemas; then they are registered under that and replayed."""
    base = new_scratch(spark, "inferred")
    few = {n: c for n, c in shapes.EVENT_SCHEMAS.items() if n in ("click", "view")}
    route_messages(shapes.event_messages(spark, sf_dir), 0, load_schemas(few), base)
    found = inferred_columns(unregistered(spark, base))
    proposed = canonical_schemas(proposed_headers(found))
    replay_quarantine(spark, base, load_schemas({r.file_path.split("/", 1)[1]: r.columns for r in proposed.collect()}))
    names = ("error", "purchase", "signup")
    rows = [read_since(spark, stream_path(base, n)).agg(F.count("event_id").alias("replayed")).withColumn("schema_name", F.lit(n)) for n in names]
    return found.join(reduce(DataFrame.unionAll, [r.select("schema_name", "replayed") for r in rows]), "schema_name")
