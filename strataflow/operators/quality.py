"""Column checks and table profiles."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """All columns in one pass over the table."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counts.unpivot([], list(cols), "column", "failing_rows").select(
        F.lit("not_null").alias("check"), "column", "failing_rows"
    )


def _unique(df: DataFrame, col: str) -> DataFrame:
    """Number of values that occur more than once; NULLs are left to ``not_null``."""
    repeated = (
        df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    )
    return repeated.agg(F.count(F.lit(1)).alias("failing_rows")).select(
        F.lit("unique").alias("check"), F.lit(col).alias("column"), "failing_rows"
    )


def quality_report(df: DataFrame, not_null: Sequence[str] = (), unique: Sequence[str] = ()) -> DataFrame:
    """One row per check: ``check, column, failing_rows``; 0 means the check holds."""
    parts = [_not_null(df, not_null)] if not_null else []
    parts += [_unique(df, c) for c in unique]
    if not parts:
        raise ValueError("name at least one column to check")
    return reduce(DataFrame.unionAll, parts)


def table_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum as text, one row per statistic."""
    return df.describe(*(cols or df.columns))


def preview(df: DataFrame, n: int = 20) -> tuple[str, DataFrame]:
    """The schema as text and any ``n`` rows."""
    return df.schema.treeString(), df.limit(n)
