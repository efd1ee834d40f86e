"""Batch loads into bronze."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strataflow.operators import stamp_audit
from strataflow.sources.catalog import register_snapshot
from strataflow.sources.csv_files import load_csv_checked
from strataflow.sources.jdbc import JdbcSource, extract_table
from strataflow.sources.versions import next_version, write_observed


def load_to_bronze(
    spark: SparkSession,
    df: DataFrame,
    table_name: str,
    base: str,
    source: str = "postgres",
    database: str = "bronze",
) -> str | None:
    """Store ``df`` as the new content of a bronze table, columns and all.

    Its source is read once: the write itself tells whether there were rows, and an empty ``df`` leaves the
    table as it was. Returns the path, or None.
    """
    path = f"{base}/batch/{table_name}"
    version = next_version(spark, path)
    if not write_observed(stamp_audit(df, source), path, version)["rows"]:
        return None
    register_snapshot(spark, f"{database}.{table_name}", path, version)
    return path


def rejects_path(base: str, table_name: str) -> str:
    return f"{base}/batch_rejects/{table_name}"


def ingest_csv(
    spark: SparkSession,
    path: str,
    schema: str,
    table_name: str,
    base: str,
    multiline: bool = False,
    database: str = "bronze",
) -> str | None:
    """Load CSV files into a bronze table; lines that do not fit become a version beside it, of the same number."""
    rows, rejects = load_csv_checked(spark, path, schema, multiline)
    number = next_version(spark, f"{base}/batch/{table_name}")
    write_observed(rejects, rejects_path(base, table_name), number)
    return load_to_bronze(spark, rows, table_name, base, "csv", database)


def ingest_table(
    spark: SparkSession,
    table: str | None,
    base: str,
    source: JdbcSource | None = None,
    extract: Callable[[SparkSession, str], DataFrame] | None = None,
    **extract_options,
) -> str | None:
    """Copy one source table, ``schema.name`` or ``name``, to the bronze table ``name``."""
    if not table:
        raise ValueError("name the table to ingest")
    if extract is None:
        if source is None:
            raise ValueError("give a JDBC source or an extract function")
        df = extract_table(spark, source, table, **extract_options)
    else:
        df = extract(spark, table)
    return load_to_bronze(spark, df, table.rsplit(".", 1)[-1], base)
