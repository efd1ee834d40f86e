"""What a join may send through the driver goes by rows in memory, not by stored bytes."""

from pyspark.sql import functions as F

from strataflow.sources import shapes
from tests.conftest import plan_of

LIMIT = 16 << 20


def broadcast_bytes(df) -> list[int]:
    """Size of each broadcast of a frame that has run."""
    found, left = [], [df._jdf.queryExecution().executedPlan()]
    while left:
        p = left.pop()
        name = p.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            left.append(p.executedPlan())
        elif "QueryStage" in name:
            left.append(p.plan())
        if name.startswith("BroadcastExchange"):
            found.append(p.metrics().apply("dataSize").value())
        children = p.children()
        left += [children.apply(i) for i in range(children.size())]
    return found


def orders_of(spark, base, n):
    """Orders as wide as the given ones, so that two columns are a small part of the stored bytes."""
    spark.range(0, n, 1, 4).select(
        F.col("id").alias("o_orderkey"),
        (F.col("id") % 1500).alias("o_custkey"),
        F.when(F.col("id") % 2 == 0, "F").otherwise("O").alias("o_orderstatus"),
        (F.col("id") % 997).cast("double").alias("o_totalprice"),
        F.timestamp_seconds(F.lit(800_000_000) + F.col("id") % 2000 * 86400).alias("o_orderdate"),
        F.concat((F.col("id") % 5 + 1).cast("string"), F.lit("-HIGH")).alias("o_orderpriority"),
    ).write.parquet(f"{base}/orders.parquet")


def test_orders_are_not_broadcast_to_their_lines(spark, base):
    n = 750_000
    orders_of(spark, base, n)
    spark.range(0, 2 * n, 1, 4).select(
        (F.col("id") % n).alias("l_orderkey"),
        (F.col("id") % 2000).alias("l_partkey"),
        (F.col("id") % 100).alias("l_suppkey"),
        (F.col("id") % 7).cast("int").alias("l_linenumber"),
        (F.col("id") % 50).cast("double").alias("l_quantity"),
        F.timestamp_seconds(F.lit(800_000_000) + F.col("id") % 2000 * 86400).alias("l_shipdate"),
    ).write.parquet(f"{base}/lineitem.parquet")
    lines = shapes.rating_rows(spark, base).agg(F.count("userId").alias("n"), F.sum(F.col("userId").cast("long")).alias("users"))
    found = lines.collect()[0]
    assert (found.n, found.users) == (2 * n, 2 * sum(i % 1500 for i in range(n)))
    assert all(size <= LIMIT for size in broadcast_bytes(lines))


def test_known_files_are_not_broadcast(spark, base):
    """The join by which a registry leaves out what it knows."""
    orders_of(spark, base, 1_000_000)
    headers = shapes.order_headers(spark, base)
    known = headers.where("file_path < 'in/000000700000.csv'")
    fresh = headers.join(known.select("file_path"), "file_path", "left_anti")
    counted = fresh.groupBy("schema_name").count()
    assert sorted(counted.collect()) == [("F", 150_000), ("O", 150_000)]
    assert all(size <= LIMIT for size in broadcast_bytes(counted))


def test_a_small_side_is_still_broadcast(spark, base):
    spark.range(0, 100_000).withColumn("k", F.col("id") % 50).write.parquet(f"{base}/facts")
    spark.range(0, 50).withColumnRenamed("id", "k").write.parquet(f"{base}/few")
    joined = spark.read.parquet(f"{base}/facts").join(spark.read.parquet(f"{base}/few"), "k")
    assert "BroadcastHashJoin" in plan_of(joined) and joined.count() == 100_000
