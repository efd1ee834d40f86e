from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strataflow.plans import build as gold
from strataflow.plans import incremental
from strataflow.plans.entities import BELIEF, ENTITIES, MOVIES, RATINGS
from strataflow.plans.gold import MODELS, Thresholds
from strataflow.plans.incremental import last_processed, read_cleaned, read_features, run_incremental
from strataflow.session import scan_bytes, shuffle_width
from strataflow.sources import shapes, versions
from strataflow.sources.catalog import get_checkpoint
from tests.conftest import plan_of, rows

SF = "/root/testdata/sf0.001"


def test_width_follows_the_input():
    tb = 1024**4
    assert shuffle_width(0, 8) == 8
    assert shuffle_width(1024**3, 8) == 24
    assert shuffle_width(100 * tb, 8000) == 50_000
    assert scan_bytes(1024**3) == 128 * 1024**2
    assert 500 * 1024**2 < scan_bytes(100 * tb) < 600 * 1024**2


def movie_batch(spark, *movies):
    df = spark.createDataFrame(list(movies), "movie_id int, title string, genres string")
    return df.withColumns({"_ingestion_timestamp": F.current_timestamp(), "_source": F.lit("postgres")})


def titles(spark, base):
    return rows(read_cleaned(spark, MOVIES, base).select("movie_id", "title"))


def test_runs_take_up_what_is_new(spark, base):
    bronze = MOVIES.bronze_path(base)
    with pytest.raises(ValueError, match="nothing loaded"):
        run_incremental(spark, MOVIES, base)
    versions.write_version(movie_batch(spark, (1, "A (2000)", "x")), bronze, 0)
    assert run_incremental(spark, MOVIES, base)["status"] == "OK"
    assert last_processed(spark, MOVIES, base) == 0
    assert get_checkpoint(spark, "silver.movies_cleaned") == 0
    assert run_incremental(spark, MOVIES, base)["status"] == "UP_TO_DATE"
    # The next load has a changed movie and a new one: the known row stays, its new genre is added.
    versions.write_version(movie_batch(spark, (1, "A changed (2000)", "x|y"), (2, "B (2001)", "z")), bronze, 1)
    assert run_incremental(spark, MOVIES, base)["status"] == "OK"
    assert titles(spark, base) == [(1, "A"), (2, "B")]
    assert rows(read_features(spark, MOVIES, base)) == [(1, "x"), (1, "y"), (2, "z")]
    assert spark.table("silver.movies_cleaned").count() == 2
    assert spark.table("silver.movie_genres").count() == 3
    assert get_checkpoint(spark, "silver.movies_cleaned") == 1


def test_a_registration_that_failed_is_made_up_for(spark, base, monkeypatch):
    def fail(*args, **kwargs):
        raise OSError("catalog away")

    for n in range(2):
        versions.write_version(movie_batch(spark, (n, "A (2000)", "x")), MOVIES.bronze_path(base), n)
        with monkeypatch.context() as m:
            m.setattr(incremental, "register_table", fail)
            with pytest.raises(OSError):
                run_incremental(spark, MOVIES, base, database="silver_late")
    assert run_incremental(spark, MOVIES, base, database="silver_late")["status"] == "UP_TO_DATE"
    assert spark.table("silver_late.movies_cleaned").count() == 2
    assert spark.table("silver_late.movie_genres").count() == 2
    assert get_checkpoint(spark, "silver_late.movies_cleaned") == 1


def test_an_empty_batch_changes_nothing(spark, base):
    versions.write_version(movie_batch(spark, (1, "A (2000)", "x")).limit(0), MOVIES.bronze_path(base), 0)
    assert run_incremental(spark, MOVIES, base, database=None)["status"] == "EMPTY"
    assert last_processed(spark, MOVIES, base) is None


def test_a_run_that_failed_between_its_tables_can_be_repeated(spark, base, monkeypatch):
    bronze = BELIEF.bronze_path(base)
    raw = shapes.belief(spark, SF)
    # Rows without a time have a NULL in their key and would be inserted again by a plain merge.
    raw = raw.withColumn("tstamp", F.when(F.col("movie_idx") != 3, F.col("tstamp")))
    versions.write_version(raw, bronze, 0)
    run_incremental(spark, BELIEF, base, database=None)
    versions.write_version(raw.withColumn("user_id", F.col("user_id") + 100_000), bronze, 1)

    write = incremental.insert_only_merge

    def fail_on_features(df, path, *args, **kwargs):
        if "features" in path:
            raise OSError("executor lost")
        return write(df, path, *args, **kwargs)

    monkeypatch.setattr(incremental, "insert_only_merge", fail_on_features)
    with pytest.raises(OSError):
        run_incremental(spark, BELIEF, base, database=None)
    monkeypatch.undo()
    assert versions.latest_version(spark, BELIEF.cleaned_path(base)) == 1
    assert last_processed(spark, BELIEF, base) == 0
    # More arrives before the repeat.
    versions.write_version(raw.withColumn("user_id", F.col("user_id") + 200_000), bronze, 2)
    run_incremental(spark, BELIEF, base, database=None)
    once = BELIEF.build_cleaned(raw).count()
    assert read_cleaned(spark, BELIEF, base).count() == 3 * once
    assert read_features(spark, BELIEF, base).count() == 3 * once


def test_complete_versions_are_never_taken_back(spark, base):
    for n in (0, 1):
        versions.write_version(movie_batch(spark, (n, "A (2000)", "x")), base, n)
    with pytest.raises(RuntimeError, match="complete versions"):
        versions.drop_leftover(spark, base, None)


def test_two_batches_give_what_one_gives(spark, base):
    raw = shapes.ratings(spark, SF)
    even = F.col("userId").cast("int") % 2 == 0
    versions.write_version(raw.where(even), RATINGS.bronze_path(base), 0)
    run_incremental(spark, RATINGS, base, database=None)
    versions.write_version(raw.where(~even), RATINGS.bronze_path(base), 1)
    run_incremental(spark, RATINGS, base, database=None)
    assert not versions.committed_versions(spark, RATINGS.features_path(base))
    one = RATINGS.build_cleaned(raw).drop("processed_timestamp")
    assert rows(read_cleaned(spark, RATINGS, base).drop("processed_timestamp")) == rows(one)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("lake"))
    for entity in ENTITIES.values():
        versions.write_version(shapes.SILVER_INPUTS[entity.name](spark, SF), entity.bronze_path(base), 0)
        run_incremental(spark, entity, base)
    return base


def test_build_stores_marts_and_views(spark, lake):
    results = gold.build(spark, lake, thresholds=Thresholds(min_ratings=20))
    assert sorted(results) == sorted(m.name for m in MODELS.values() if m.layer != "rollup")
    assert spark.table("gold.gold_top_movies").columns == ["movie_id", "title", "release_year", "total_ratings", "avg_rating"]
    assert spark.table("gold.gold_top_movies").count() == 10
    assert spark.table("stg_ratings").count() > 0
    # Silver and gold in one query.
    joined = spark.table("gold.gold_most_rated_movies").join(spark.table("silver.ratings_cleaned"), "movie_id")
    assert joined.count() > 0
    activity = [r["total_ratings"] for r in gold.read_mart(spark, lake, "gold_user_activity").collect()]
    assert activity == sorted(activity, reverse=True)
    # Again: same marts, no more than the version before is kept.
    for _ in range(2):
        gold.build(spark, lake, "gold_rating_distribution", database=None)
    assert len(versions.committed_versions(spark, f"{lake}/gold/gold_rating_distribution")) == 2


def test_build_selects_by_name_and_tag(spark, lake):
    assert list(gold.build(spark, lake, "gold_top_movies", database=None)) == ["gold_top_movies"]
    assert len(gold.build(spark, lake, "tag:staging")) == 9
    assert len(gold.selected("tag:intermediate")) == 4
    assert len(gold.selected("tag:gold")) == 13
    with pytest.raises(ValueError, match="no model"):
        gold.build(spark, lake, "dim_nothing")
    with pytest.raises(KeyError):
        gold.resolver({})("dim_nothing")


def test_no_model_leaves_the_engine_or_multiplies_rows(spark, lake):
    ref = gold.resolver(gold.silver_tables(spark, lake))
    for name in MODELS:
        plan = plan_of(ref(name))
        for bad in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEval"):
            assert bad not in plan, (name, bad)


def test_scans_read_only_what_is_needed(spark, lake):
    ref = gold.resolver(gold.silver_tables(spark, lake))
    plan = plan_of(ref("gold_rating_distribution"))
    assert "ReadSchema: struct<user_id:int,movie_id:int,rating:double,event_timestamp:timestamp>" in plan
    assert "IsNotNull(rating)" in plan
    assert plan.count("FileScan") == 1


def test_hot_movie_is_split_in_the_join_at_rating_grain(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10k",
        spark__sql__shuffle__partitions="16",
    )
    # A third of all ratings are of one movie.
    ratings = spark.range(0, 60_000, numPartitions=8).select(
        (F.col("id") % 997).cast("int").alias("user_id"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 500).cast("int").alias("movie_id"),
        (F.col("id") % 10 / 2 + 0.5).alias("rating"),
        F.lit("2024-01-01").cast("timestamp").alias("event_timestamp"),
        F.lit(None).cast("timestamp").alias("ingestion_timestamp"),
        F.lit(None).cast("timestamp").alias("processed_timestamp"),
        F.lit("x").alias("source_system"),
        F.lit("x").alias("source_topic"),
    )
    genres = spark.range(0, 500).select(
        F.col("id").cast("int").alias("movie_id"), F.explode(F.array(F.lit("a"), F.lit("b"))).alias("genre")
    )
    df = gold.resolver({"ratings_cleaned": lambda: ratings, "movie_genres": lambda: genres})("int_user_genre_metrics")
    result = df.collect()
    assert sum(r["total_ratings"] for r in result) == 120_000
    assert "skew=true" in plan_of(df)


def test_features_can_be_switched_on_later(spark, base):
    from dataclasses import replace

    raw, on = shapes.ratings(spark, SF), replace(RATINGS, run_features=True)
    even = F.col("userId").cast("int") % 2 == 0
    for n, part in enumerate((raw.where(even), raw.where(~even))):
        versions.write_version(part, RATINGS.bronze_path(base), n)
        run_incremental(spark, RATINGS, base, database=None)
    cleaned = rows(read_cleaned(spark, RATINGS, base))
    assert run_incremental(spark, on, base, database=None)["status"] == "UP_TO_DATE"
    assert rows(read_cleaned(spark, RATINGS, base)) == cleaned
    assert read_features(spark, on, base).count() == len(cleaned)
    versions.write_version(raw.withColumn("userId", F.lit("7000001")), RATINGS.bronze_path(base), 2)
    run_incremental(spark, on, base, database=None)
    assert read_features(spark, on, base).count() == read_cleaned(spark, on, base).count() > len(cleaned)


def test_run_leaves_the_callers_settings(spark, base):
    versions.write_version(movie_batch(spark, (1, "A (2000)", "x")), MOVIES.bronze_path(base), 0)
    keys = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")
    before = [spark.conf.get(k) for k in keys]
    run_incremental(spark, MOVIES, base, database=None)
    assert [spark.conf.get(k) for k in keys] == before
