from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strataflow import operators as O
from tests.conftest import plan_of, rows


def test_rename_map_refuses_missing_columns(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert O.rename_map(df, {"a": "b"}).columns == ["b"]
    with pytest.raises(ValueError, match="missing"):
        O.rename_map(df, {"x": "y"})


def test_cast_columns_gives_order_and_null_for_misfits(spark):
    df = spark.createDataFrame([("1", "x"), ("NA", "y")], "n string, s string")
    out = O.cast_columns(df, {"s": "string", "n": "int"})
    assert out.columns == ["s", "n"]
    assert rows(out) == [("x", 1), ("y", None)]


def test_require_keys_keeps_nan(spark):
    df = spark.createDataFrame([(1, 1.0), (None, 1.0), (2, None), (3, float("nan"))], "k int, v double")
    assert O.require_keys(df, ["k", "v"]).count() == 2


def test_frame_level_domains(spark):
    df = spark.createDataFrame([(-1, 0.4, 9), (1, 0.5, 5)], "a int, b double, c int")
    out = O.clamp_set(O.clamp_range(O.sentinel_to_null(df, ["a"]), "b", 0.5, 5.0), "c", [5])
    assert rows(out) == [(1, 0.5, 5), (None, None, None)]


def test_audit_columns(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert O.stamp_audit(df, "postgres").columns == ["a", "_ingestion_timestamp", "_source"]
    stamped = O.stamp_audit(df, "kafka", F.lit("csv-a"), F.lit("2024-01-01").cast("timestamp"))
    assert [str(v) for v in stamped.select("_source", "_topic", F.col("_ingestion_timestamp").cast("string")).first()] == [
        "kafka", "csv-a", "2024-01-01 00:00:00",
    ]


def test_dedup_takes_the_latest_then_the_greatest(spark):
    data = [
        (1, "old", 1), (1, "new", 2),  # the later one
        (2, "a", 1), (2, "b", 1),  # same time: the greater value
        (None, "x", 1), (None, "y", None),  # NULL keys are one key, NULL time is earliest
        (3, None, 1), (3, "z", 1),  # NULL is smallest
    ]
    df = spark.createDataFrame(data, "k int, v string, t int")
    for parts in (1, 4):
        out = O.dedup_latest(df.repartition(parts), ["k"], "t")
        assert out.columns == df.columns
        assert rows(out) == [(1, "new", 2), (2, "b", 1), (3, "z", 1), (None, "x", 1)]


def test_dedup_folds_a_hot_key_before_the_shuffle(spark):
    hot = spark.range(0, 90_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("t")
    )
    out = O.dedup_latest(hot, ["k"], "t")
    assert plan_of(out).count("partial_max") == 1
    assert out.count() == 60_001
    assert out.where("k = -1").first()["t"] == 89_997


def test_explode_delimited(spark):
    df = spark.createDataFrame(
        [(1, "Action|Sci-Fi| |(no genres listed)"), (1, "ACTION | Drama"), (2, ""), (3, None)], "id int, g string"
    )
    out = O.explode_delimited(df, "g", r"\|", "genre", ["id"], drop=["(no genres listed)"])
    assert rows(out) == [(1, "action"), (1, "drama"), (1, "sci-fi")]


def test_averages_do_not_depend_on_the_order_of_addition(spark):
    df = spark.range(0, 20_000).select(
        (F.col("id") % 7).alias("k"), (F.col("id") % 46 / 10 + 0.5).alias("rating"), F.lit(1).alias("one")
    )
    a = rows(O.rating_metrics(df.repartition(1), ["k"]))
    b = rows(O.rating_metrics(df.repartition(13, F.rand(3)), ["k"]))
    c = rows(O.merge_totals(O.rating_totals(df.repartition(5, F.rand(4)), ["k", "rating"]), ["k"]))
    assert a == b == c


def test_averages_of_ratings_with_many_decimals(spark):
    values = [1 / 3, 2 / 7, 4.9999999, 0.5]
    df = spark.createDataFrame([(v,) for v in values], "rating double")
    average = O.rating_metrics(df, []).first()["avg_rating"]
    assert average == pytest.approx(sum(values) / 4, abs=1e-14)


def test_metrics_per_key(spark):
    df = spark.createDataFrame(
        [(1, 4.0, "2024-01-01"), (1, 3.0, "2024-01-03"), (2, 5.0, "2024-01-02")], "u int, rating double, t string"
    )
    out = O.rating_metrics(df.withColumn("t", F.col("t").cast("timestamp")), ["u"], 4, "t")
    assert rows(out.withColumn("last_activity", F.col("last_activity").cast("string"))) == [
        (1, 2, 3.5, 0.5, "2024-01-03 00:00:00"), (2, 1, 5.0, 1.0, "2024-01-02 00:00:00"),
    ]


def test_top_k_and_rank_break_ties_and_put_nulls_last(spark):
    df = spark.createDataFrame([(3, 1.0), (1, 2.0), (2, 2.0), (4, None)], "id int, v double")
    desc = O.top_k(df, [("v", "desc")], 2, "id")
    assert [r[0] for r in desc.collect()] == [1, 2]
    assert "TakeOrderedAndProject" in plan_of(desc)
    assert [r[0] for r in O.top_k(df, [("v", "asc")], 4, "id").collect()] == [3, 1, 2, 4]
    ranked = O.rank_within(df.withColumn("p", F.lit(1)), ["p"], [("v", "desc")], "id", "n")
    assert dict(ranked.dtypes)["n"] == "bigint"
    assert [r["id"] for r in ranked.orderBy("n").collect()] == [1, 2, 3, 4]


def test_quality_report(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, None), (None, "b"), (None, "b")], "id int, v string")
    report = O.quality_report(df, not_null=["id", "v"], unique=["id", "v"])
    assert rows(report) == [("not_null", "id", 2), ("not_null", "v", 2), ("unique", "id", 1), ("unique", "v", 1)]
    with pytest.raises(ValueError):
        O.quality_report(df)


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (3, "b")], "n int, s string")
    profile = {r["summary"]: (r["n"], r["s"]) for r in O.table_profile(df).collect()}
    assert profile["count"] == ("2", "2") and profile["mean"][0] == "2.0" and profile["max"] == ("3", "b")


def test_preview(spark):
    schema, few = O.preview(spark.range(0, 100), 3)
    assert "id: long" in schema and few.count() == 3


def test_average_of_values_beyond_the_exact_range(spark):
    df = spark.createDataFrame([(1, 1e15), (1, 3e15), (2, 3.5)], "k int, rating double")
    assert rows(O.rating_metrics(df, ["k"]).select("k", "avg_rating")) == [(1, 2e15), (2, 3.5)]
