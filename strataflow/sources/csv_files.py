"""CSV files: whole loads, discovery, and the rows a growing file has gained."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.window import Window

from strataflow.sources.files import first_line, glob_paths

HEADERS_SCHEMA = "file_path string, schema_name string, columns array<string>"


# Quotes inside a quoted value are doubled; a backslash is a character like any other.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"'}


_MISFIT = "_misfit"


def load_csv(spark: SparkSession, path: str, schema: str | StructType, multiline: bool = False) -> DataFrame:
    """CSV with the given columns, by position; the header line is skipped.

    ``multiline`` allows line breaks inside quoted values, at the price of one task
    per file.
    """
    return spark.read.schema(schema).options(**CSV_OPTIONS, multiLine=multiline).csv(path)


def load_csv_checked(
    spark: SparkSession, path: str, schema: str | StructType, multiline: bool = False
) -> tuple[DataFrame, DataFrame]:
    """``load_csv`` with the lines that do not fit apart: ``(rows, rejects)``.

    A line with more or fewer values than there are columns, or with a value that is not of its column's type, is a reject, as
    ``data, error, timestamp, topic`` (the file); it does not become a row of NULLs.
    """
    columns = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    wider = StructType([*columns, StructField(_MISFIT, StringType())])
    reader = spark.read.schema(wider).options(**CSV_OPTIONS, multiLine=multiline, columnNameOfCorruptRecord=_MISFIT)
    read = reader.csv(path).select("*", F.col("_metadata.file_path").alias("_file"))
    rows = read.where(F.col(_MISFIT).isNull()).select(*columns.names)
    # Spark tells misfits only where it reads all columns, so all of them take part in a comparison that always holds.
    values = F.concat_ws("\0", *[F.col(f"`{c}`").cast("string") for c in columns.names])
    never = values.eqNullSafe(F.concat(F.col(_MISFIT), F.lit("\0\0")))
    rejects = read.where(F.col(_MISFIT).isNotNull() & ~never).select(
        F.col(_MISFIT).alias("data"),
        F.lit(f"does not fit {columns.simpleString()}").alias("error"),
        F.current_timestamp().alias("timestamp"),
        F.col("_file").alias("topic"),
    )
    return rows, rejects


def discover_csv_files(spark: SparkSession, base: str) -> list[str]:
    return glob_paths(spark, f"{base}/*.csv")


def read_headers(spark: SparkSession, files: list[str], threads: int = 32) -> DataFrame:
    """``(file_path, schema_name, columns)``: the stripped header names of each file.

    Opens each file for its first line only, ``threads`` at a time; a Spark job would have to read
    each file's first block. The name proposed for the schema is that of the file.
    """

    def header(path: str) -> tuple[str, str, list[str]]:
        names = next(csv.reader([first_line(spark, path) or ""]), [])
        return path, path.rsplit("/", 1)[-1].removesuffix(".csv"), [n.strip() for n in names]

    with ThreadPoolExecutor(threads) as pool:
        rows = list(pool.map(header, files))
    return spark.createDataFrame(rows, HEADERS_SCHEMA)


def all_string(columns: list[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def _empty_text(df: DataFrame) -> DataFrame:
    """An empty field of a text row is empty text; Spark reads it as NULL."""
    return df.fillna("")


def csv_stream(
    spark: SparkSession, base: str, columns: list[str], files_per_batch: int = 1000, multiline: bool = False
) -> DataFrame:
    """New ``*.csv`` files under ``base`` as a stream of text columns."""
    reader = spark.readStream.schema(all_string(columns)).options(**CSV_OPTIONS, multiLine=multiline)
    reader = reader.option("pathGlobFilter", "*.csv").option("maxFilesPerTrigger", str(files_per_batch))
    return _empty_text(reader.csv(base))


OFFSETS_SCHEMA = "file_path string, row_offset bigint, file_size bigint"


def _grown(spark: SparkSession, files: list[str], offsets: DataFrame) -> list[str]:
    """Files whose size is not the one last seen; looks at the listing only."""
    listing = spark.read.format("binaryFile").load(files).select(F.col("path").alias("file_path"), "length")
    changed = listing.join(offsets, "file_path", "left").where(~F.col("length").eqNullSafe(F.col("file_size")))
    return [r[0] for r in changed.select("file_path").collect()]


def _numbered(spark: SparkSession, files: list[str], columns: list[str], multiline: bool) -> DataFrame:
    """Rows with the file block they were read from and an id that rises within it."""
    rows = spark.read.schema(all_string(columns)).options(**CSV_OPTIONS, multiLine=multiline).csv(files)
    return _empty_text(rows.select(*columns, "_metadata.*")).select(
        *columns,
        F.col("file_path").alias("_file"),
        F.col("file_size").alias("_size"),
        F.col("file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
    )


def _block_starts(rows: DataFrame) -> DataFrame:
    """Per block: its first id, its rows, and the rows of the file before it.

    One row per block of the input, not per row of it; the running count orders
    the blocks of one file only.
    """
    blocks = rows.groupBy("_file", "_size", "_block").agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))


def csv_tail(
    spark: SparkSession,
    files: list[str],
    columns: list[str],
    offsets: DataFrame | None = None,
    multiline: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Rows past the saved offset of each file, and the offsets to save next.

    Returns ``(rows, offsets)``: ``rows`` has the columns, ``file_path`` and
    ``row_number`` (from 1, the header not counted); ``offsets`` has ``file_path``,
    ``row_offset``, the absolute number of rows seen, and ``file_size``. A file
    without a saved offset is read from its start, one that has not grown not at
    all. Rows are numbered inside the blocks Spark splits a file into, so a file of
    any size is read by many tasks.
    """
    if offsets is None:
        offsets = spark.createDataFrame([], OFFSETS_SCHEMA)
    grown = _grown(spark, files, offsets) if files else []
    if not grown:
        nothing = spark.createDataFrame([], all_string([*columns, "file_path"]))
        return nothing.withColumn("row_number", F.lit(0).cast("bigint")), offsets
    rows = _numbered(spark, grown, columns, multiline)
    starts = _block_starts(rows)
    seen = starts.groupBy(F.col("_file").alias("file_path")).agg(
        F.sum("_rows").alias("row_offset"), F.max("_size").alias("file_size")
    )
    unread = offsets.join(seen, "file_path", "left_anti").select("file_path", "row_offset", "file_size")
    saved = offsets.select(F.col("file_path").alias("_file"), F.col("row_offset").alias("_offset"))
    # Blocks that end before the offset need no row of theirs looked at.
    starts = (
        starts.drop("_size")
        .join(saved, "_file", "left")
        .fillna({"_offset": 0})
        .where(F.col("_before") + F.col("_rows") > F.col("_offset"))
    )
    tail = (
        rows.join(starts, ["_file", "_block"])
        .withColumn("row_number", F.col("_before") + F.col("_at") - F.col("_first") + 1)
        .where(F.col("row_number") > F.col("_offset"))
        .select(*columns, F.col("_file").alias("file_path"), "row_number")
    )
    return tail, seen.unionByName(unread)
