"""Databases, external tables over versioned folders, and checkpoints in table properties."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from strataflow.sources.versions import VERSION_COL, committed_versions, version_path

PARTITIONS_PER_STATEMENT = 500
CHECKPOINT_PROPERTY = "silver.last_bronze_version"


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def register_snapshot(spark: SparkSession, table: str, path: str, version: int) -> None:
    """Point a table at one version. With the same columns the table only moves, so readers always find it."""
    ensure_database(spark, table.rsplit(".", 1)[0])
    location = version_path(path, version)
    if table_exists(spark, table):
        if spark.table(table).schema == spark.read.parquet(location).schema:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
            spark.catalog.refreshTable(table)
            return
        spark.sql(f"DROP TABLE {table}")
    spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{location}'")


def register_table(
    spark: SparkSession, table: str, path: str, schema: StructType, versions: Sequence[int] | None = None
) -> None:
    """Make versions of an appended folder, by default all committed, readable as an external table.

    The version follows the other columns. The table is declared anew, with all versions, when the columns
    differ; files are never touched. Versions that are not committed are never added.
    """
    ensure_database(spark, table.rsplit(".", 1)[0])
    types = {f.name: f.dataType.simpleString() for f in schema if f.name != VERSION_COL} | {VERSION_COL: "int"}
    if table_exists(spark, table) and spark.table(table).columns != list(types):
        spark.sql(f"DROP TABLE {table}")
    fresh = not table_exists(spark, table)
    if fresh:
        declared = ", ".join(f"`{c}` {t}" for c, t in types.items())
        spark.sql(f"CREATE TABLE {table} ({declared}) USING parquet PARTITIONED BY ({VERSION_COL}) LOCATION '{path}'")
    committed = committed_versions(spark, path)
    added = committed if fresh or versions is None else [v for v in versions if v in set(committed)]
    specs = [f"PARTITION ({VERSION_COL} = {v})" for v in added]
    for i in range(0, len(specs), PARTITIONS_PER_STATEMENT):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(specs[i : i + PARTITIONS_PER_STATEMENT])}")
    spark.catalog.refreshTable(table)


def get_checkpoint(spark: SparkSession, table: str) -> int | None:
    """Last bronze version recorded on the table; None without table or record."""
    if not table_exists(spark, table):
        return None
    # A property that is not set comes back as a row with a message, not as no row.
    row = spark.sql(f"SHOW TBLPROPERTIES {table} ('{CHECKPOINT_PROPERTY}')").first()
    value = row["value"] if row else ""
    return int(value) if value.isdigit() else None


def set_checkpoint(spark: SparkSession, table: str, version: int) -> None:
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{CHECKPOINT_PROPERTY}' = '{version}')")
