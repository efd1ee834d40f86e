"""Rating aggregates, top-k and ranking.

A sum of doubles depends on the order in which tasks add, so equal averages
would come out a little apart and rank at random. Ratings are therefore summed as
whole ten-thousandths, which is exact in any order, plus what a rating has beyond
those (zero for any rating with up to four decimals). Both sums can be merged
from a finer grain into a coarser one without going back to the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

POSITIVE_AT = 4
POINTS = 10_000
# Sums of so many points stay within 64 bits up to 9e10 rows.
EXACT_BELOW = 10_000


def _points(rating: str) -> Column:
    """Whole ten-thousandths; none of a value beyond ``EXACT_BELOW``, which counts as remainder, in the order of addition."""
    return F.when(F.abs(F.col(rating)) < EXACT_BELOW, F.rint(F.col(rating) * POINTS)).otherwise(0.0)


def _beyond(rating: str) -> Column:
    return F.col(rating) - _points(rating) / POINTS


def _average(points: Column, beyond: Column, total: Column) -> Column:
    return (points + beyond * POINTS) / (total * F.lit(float(POINTS)))


def rating_metrics(
    df: DataFrame,
    keys: Sequence[str],
    positive_at: float | None = None,
    last_activity: str | None = None,
    rating: str = "rating",
) -> DataFrame:
    """``total_ratings``, ``avg_rating`` and on request ``pct_positive`` and ``last_activity`` per key.

    Rows must have a rating, as staging guarantees.
    """
    total = F.count(F.lit(1))
    average = _average(F.sum(_points(rating).cast("bigint")), F.sum(_beyond(rating)), total)
    aggs = [total.alias("total_ratings"), average.alias("avg_rating")]
    if positive_at is not None:
        aggs.append(F.avg(F.when(F.col(rating) >= positive_at, 1).otherwise(0)).alias("pct_positive"))
    if last_activity is not None:
        aggs.append(F.max(last_activity).cast("timestamp").alias("last_activity"))
    return df.groupBy(*keys).agg(*aggs)


def rating_totals(
    df: DataFrame,
    keys: Sequence[str],
    rating: str = "rating",
    positive_at: float | None = None,
    last_activity: str | None = None,
) -> DataFrame:
    """Mergeable form of :func:`rating_metrics`: ``total_ratings``, ``points`` and ``beyond`` per key, on request ``positives`` and ``last_activity``."""
    aggs = [
        F.count(F.lit(1)).alias("total_ratings"),
        F.sum(_points(rating).cast("bigint")).alias("points"),
        F.sum(_beyond(rating)).alias("beyond"),
    ]
    if positive_at is not None:
        aggs.append(F.count_if(F.col(rating) >= positive_at).alias("positives"))
    if last_activity is not None:
        aggs.append(F.max(last_activity).cast("timestamp").alias("last_activity"))
    return df.groupBy(*keys).agg(*aggs)


def merged_totals(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Several rows of :func:`rating_totals` per key as one: counts and sums add up, the last activity is the latest."""
    merge = {"last_activity": F.max}
    return df.groupBy(*keys).agg(*[merge.get(c, F.sum)(c).alias(c) for c in df.columns if c not in keys])


def average_of_totals() -> Column:
    """Average rating of one row of :func:`rating_totals`."""
    return _average(F.col("points"), F.col("beyond"), F.col("total_ratings"))


def average_of_merged() -> Column:
    """Average rating over merged rows of :func:`rating_totals`; an aggregate expression."""
    return _average(F.sum("points"), F.sum("beyond"), F.sum("total_ratings"))


def merge_totals(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Roll rows of :func:`rating_totals` up to ``keys``."""
    return df.groupBy(*keys).agg(
        F.sum("total_ratings").alias("total_ratings"), average_of_merged().alias("avg_rating")
    )


def _direction(col: str, how: str) -> Column:
    return F.col(col).asc_nulls_last() if how == "asc" else F.col(col).desc_nulls_last()


def ordering(order: Sequence[tuple[str, str]]) -> list[Column]:
    """``[(column, 'asc' | 'desc'), …]`` as sort columns with NULLs last."""
    return [_direction(c, how) for c, how in order]


def top_k(df: DataFrame, order: Sequence[tuple[str, str]], k: int, tie: str) -> DataFrame:
    """First ``k`` rows; ``tie`` must be unique so that the cut is well defined.

    Each task keeps its own best ``k`` before the merge.
    """
    return df.orderBy(*ordering([*order, (tie, "asc")])).limit(k)


def rank_within(
    df: DataFrame, part: Sequence[str], order: Sequence[tuple[str, str]], tie: str, out: str
) -> DataFrame:
    """Row number (bigint) inside each partition; ``tie`` makes it repeatable."""
    window = Window.partitionBy(*part).orderBy(*ordering([*order, (tie, "asc")]))
    return df.withColumn(out, F.row_number().over(window).cast(T.LongType()))
