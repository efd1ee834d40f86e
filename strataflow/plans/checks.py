"""The column checks declared for the silver tables, as one report."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.operators import quality_report
from strataflow.sources.versions import write_observed

# Fixed values of the data contract: table -> (not null, unique).
DECLARED = {
    "movies_cleaned": (["movie_id", "title", "release_year"], ["movie_id"]),
    "movie_genres": (["movie_id", "genre"], []),
    "ratings_cleaned": (["user_id", "movie_id"], []),
}


def silver_checks(ref: Callable[[str], DataFrame]) -> DataFrame:
    """``table, check, column, failing_rows`` of every declared check."""
    reports = [
        quality_report(ref(table), not_null, unique).select(
            F.lit(table).alias("table"), "check", "column", "failing_rows"
        )
        for table, (not_null, unique) in DECLARED.items()
    ]
    return reduce(DataFrame.unionAll, reports)


def store_checked(df: DataFrame, table: str, path: str, version: int, order_by: Sequence[str] = ()) -> DataFrame:
    """Store a silver table's version and report its number of rows and declared not-null checks from the same job.

    Returns ``table, check, column, failing_rows``; the row of check ``rows`` has the number of rows stored.
    """
    not_null, _ = DECLARED.get(table, ([], []))
    missing = {f"null {c}": F.count_if(F.col(c).isNull()) for c in not_null}
    found = write_observed(df, path, version, order_by, metrics=missing, keep_empty=True)
    report = [(table, "rows", "*", found["rows"]), *((table, "not_null", c, found[f"null {c}"]) for c in not_null)]
    return df.sparkSession.createDataFrame(report, "table string, check string, column string, failing_rows bigint")
