"""Connected components of an edge list, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import stored

#: Of more edges than this no side of a round's joins is broadcast, whatever Spark makes of their stored bytes.
BROADCAST_EDGES = 100_000


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges`` has long columns ``a`` and ``b``; returns ``node`` and ``root``, its component's smallest node.

    Every step folds the neighbours of a node to their minimum before the shuffle,
    so a hub costs no more than its rows. Each round is written to the shared folder.
    Nodes without an edge to another one are left out; null ends are dropped.
    """
    current = stored(edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b").distinct(), "edges")
    before = _state(current)
    for _ in range(max_rounds):
        held = (lambda df: df.hint("merge")) if before[0] > BROADCAST_EDGES else lambda df: df
        both = current.select("a", "b").union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(held(low), "a").where("b > a AND b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(held(least), "a").select("b", "m", "a")
        stars = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(small.select("a", F.col("m").alias("b")))
        current = stored(stars.where("a <> b").distinct(), "edges")
        now = _state(current)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    pairs = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return pairs.union(pairs.select(F.col("root").alias("node"), "root").distinct())
