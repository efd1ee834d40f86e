"""Relational sources over JDBC."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

FETCH_SIZE = 1000


@dataclass(frozen=True)
class JdbcSource:
    """Address of a database; ``properties`` go to the reader as they are."""

    url: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str = "org.postgresql.Driver"
    properties: dict[str, str] = field(default_factory=dict)

    @classmethod
    def postgres(cls, host: str, database: str, port: int = 5432, **kwargs) -> JdbcSource:
        return cls(url=f"jdbc:postgresql://{host}:{port}/{database}", **kwargs)

    def options(self) -> dict[str, str]:
        options = {"url": self.url, "driver": self.driver, "fetchsize": str(FETCH_SIZE)}
        if self.user is not None:
            options["user"] = self.user
        if self.password is not None:
            options["password"] = self.password
        return {**options, **self.properties}


def range_options(column: str, low, high, partitions: int) -> dict[str, str]:
    """Reader options that split a table scan into ranges of ``column``."""
    return {
        "partitionColumn": column,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(partitions),
    }


def bounds_query(table: str, column: str) -> str:
    return f"SELECT MIN({column}) AS low, MAX({column}) AS high FROM {table}"


def extract_table(
    spark: SparkSession,
    source: JdbcSource,
    table: str,
    partition_column: str | None = None,
    partitions: int = 64,
) -> DataFrame:
    """A whole table.

    With ``partition_column`` (numeric, date or timestamp) the scan runs as that
    many range queries; without it one task reads everything.
    """
    reader = spark.read.format("jdbc").options(**source.options())
    if partition_column is not None:
        # One row, computed by the database; it takes a scan there and none here.
        low, high = reader.option("query", bounds_query(table, partition_column)).load().first()
        reader = spark.read.format("jdbc").options(**source.options())
        if low is not None:
            reader = reader.options(**range_options(partition_column, low, high, partitions))
    return reader.option("dbtable", table).load()


def discovery_query(schema: str = "raw") -> str:
    return (
        "SELECT table_schema || '.' || table_name AS full_name FROM information_schema.tables "
        f"WHERE table_schema = '{schema}' AND table_type = 'BASE TABLE'"
    )


def discover_tables(spark: SparkSession, source: JdbcSource, schema: str = "raw") -> list[str]:
    """``schema.table`` of every base table, in name order."""
    reader = spark.read.format("jdbc").options(**source.options()).option("query", discovery_query(schema))
    tables = [r[0] for r in reader.load().orderBy("full_name").collect()]
    if not tables:
        raise ValueError(f"no tables in schema {schema!r}")
    return tables
