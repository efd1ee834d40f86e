"""Large merges drop what can't match before it is shuffled; files skip row groups without a key."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataflow.session import key_filters
from strataflow.sources.versions import insert_only_merge, new_rows, read_since, read_versions, write_observed
from tests.conftest import rows


def nodes(plan):
    """All nodes of an executed plan, through the wrappers of adaptive execution."""
    name = plan.getClass().getSimpleName()
    yield name, plan
    children = plan.children()
    inner = [plan.executedPlan()] if name == "AdaptiveSparkPlanExec" else [plan.plan()] if name.endswith("QueryStageExec") else []
    for child in [*inner, *(children.apply(i) for i in range(children.size()))]:
        yield from nodes(child)


def rows_out(plan):
    return plan.metrics().apply("numOutputRows").value()


def test_target_rows_are_dropped_before_the_exchange(spark, base, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    target = spark.range(200_000).select((F.col("id") % 1000).cast("int").alias("u"), F.col("id").alias("m"), F.lit("x").alias("v"))
    write_observed(target, f"{base}/target", 0)
    batch = spark.range(199_000, 203_000).select((F.col("id") % 1000).cast("int").alias("u"), F.col("id").alias("m"), F.lit("new").alias("v"))
    batch.write.parquet(f"{base}/batch")
    stored = spark.read.parquet(f"{base}/batch")
    with key_filters(spark):
        fresh = new_rows(stored, read_versions(spark, f"{base}/target", [0]), ["u", "m"])
        assert sorted(r["m"] for r in fresh.collect()) == list(range(200_000, 203_000))
    plan = fresh._jdf.queryExecution().executedPlan()
    filters = [p for name, p in nodes(plan) if name == "FilterExec" and "might_contain" in p.condition().toString()]
    assert filters
    # Of 200,000 rows those of 1,000 known keys get through, and few that only look like one.
    assert min(rows_out(p) for p in filters) < 3000


def test_one_filter_goes_through_the_driver(spark, base, conf):
    """One of the whole key; further ones of its columns are as large and drop no more."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    keys = ["u", "m", "t"]
    made = lambda a, b: spark.range(a, b).select((F.col("id") % 100).alias("u"), (F.col("id") % 101).alias("m"), F.col("id").alias("t"))
    write_observed(made(0, 50_000), f"{base}/target", 0)
    made(49_000, 52_000).write.parquet(f"{base}/batch")
    with key_filters(spark):
        fresh = new_rows(spark.read.parquet(f"{base}/batch"), read_versions(spark, f"{base}/target", [0]), keys)
        assert sorted(r["t"] for r in fresh.collect()) == list(range(50_000, 52_000))
    filters = [p for name, p in nodes(fresh._jdf.queryExecution().executedPlan()) if name == "FilterExec" and "might_contain" in p.condition().toString()]
    assert sum(p.condition().toString().count("might_contain") for p in filters) == 1
    # Each user and movie of the target is also in the batch: only the whole key tells these rows apart.
    assert rows_out(filters[0]) < 3000


def test_merge_with_filters_keeps_null_keys_and_known_rows(spark, base, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    first = spark.createDataFrame([(1, "a", 1), (None, "a", 2), (2, "b", 3)], "k int, s string, v int")
    second = spark.createDataFrame([(1, "a", 9), (None, "a", 9), (3, "c", 9)], "k int, s string, v int")
    assert insert_only_merge(first, base, ["k", "s"], 0) == 3
    assert insert_only_merge(second, base, ["k", "s"], 1) == 2
    assert rows(read_since(spark, base)) == [(1, "a", 1), (2, "b", 3), (3, "c", 9), (None, "a", 2), (None, "a", 9)]


def test_files_skip_row_groups_without_a_key(spark, base):
    df = spark.range(0, 100_000, 2).select(F.col("id").alias("k"), F.lit("x").alias("v")).repartition(1)
    read = {}
    for name, lookup in (("plain", []), ("filtered", ["k"])):
        write_observed(df, f"{base}/{name}", 0, lookup=lookup)
        one = spark.read.parquet(f"{base}/{name}").where("k = 50001")
        assert one.count() == 0
        one.collect()
        read[name] = sum(rows_out(p) for n, p in nodes(one._jdf.queryExecution().executedPlan()) if n == "FileSourceScanExec")
    assert read["plain"] > 0 and read["filtered"] == 0
