"""The message contract ``(topic, value)``: topic names, JSON values, rejected rows."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TOPIC_PREFIX = "csv"
MESSAGE_SCHEMA = "topic string, value string"
NO_SCHEMA = "no schema registered for "


def topic_for(schema_name: Column | str, prefix: str = TOPIC_PREFIX) -> Column:
    return F.concat(F.lit(f"{prefix}-"), F.col(schema_name) if isinstance(schema_name, str) else schema_name)


def schema_name_of(topic: Column | str, prefix: str = TOPIC_PREFIX) -> Column:
    """The topic without its prefix; a topic that has none passes as it is."""
    return F.regexp_replace(topic, f"^{re.escape(prefix)}-", "")


def to_messages(df: DataFrame, schema_name: Column, columns: list[str] | None = None) -> DataFrame:
    """Each row as a JSON object of its columns, addressed to the topic of its schema."""
    return df.select(
        topic_for(schema_name).alias("topic"), F.to_json(F.struct(*(columns or df.columns))).alias("value")
    )


def parse_messages(messages: DataFrame, schema: StructType) -> DataFrame:
    """Topic and the fields of the value; text that is not JSON gives NULL fields."""
    return messages.select(
        "topic", F.from_json(F.col("value").cast("string"), schema).alias("data")
    ).select("topic", "data.*")


def unknown_schema(name: Column) -> Column:
    """The error of a message that no schema is registered for."""
    return F.concat(F.lit(NO_SCHEMA), F.coalesce(name, F.lit("no topic")))


def misfit(schemas: Mapping[str, Sequence[str]], name: str = "_schema", value: str = "value") -> Column:
    """Why a message can't become a row of its schema; NULL if it can.

    ``schemas`` has the columns of each known schema. A message that would be a row of NULLs is a misfit: without a value, not a JSON
    object, or with none of its schema's columns in it.
    """
    fields = F.from_json(F.col(value).cast("string"), "map<string, string>")
    if not schemas:
        return unknown_schema(F.col(name))
    known = F.create_map(*[x for n, columns in schemas.items() for x in (F.lit(n), F.array(*map(F.lit, columns)))])
    columns = F.try_element_at(known, F.col(name))
    return (
        F.when(columns.isNull(), unknown_schema(F.col(name)))
        .when(F.col(value).isNull(), "no value")
        .when(fields.isNull() | ~F.col(value).cast("string").rlike(r"^\s*\{"), "not a JSON object")
        .when(~F.exists(columns, lambda c: F.try_element_at(fields, c).isNotNull()), F.concat(F.lit("no field of "), F.col(name)))
    )


def inferred_columns(messages: DataFrame, prefix: str = TOPIC_PREFIX) -> DataFrame:
    """``schema_name, column, type, messages``: what the JSON objects of each topic hold; the type is the narrowest that takes all values of a column.

    Values that are not JSON objects have no part in it. Works on any messages; of the quarantine's it tells what schemas to register.
    """
    value = F.try_parse_json(F.col("value").cast("string"))
    objects = messages.where("topic IS NOT NULL").select(schema_name_of("topic", prefix).alias("schema_name"), value.alias("v"))
    # Text is taken for an object by its first character, as casting any other value to a map fails.
    fields = objects.where(F.schema_of_variant("v").startswith("OBJECT")).select("schema_name", F.explode(F.expr("CAST(v AS MAP<STRING, VARIANT>)")).alias("column", "v"))
    return fields.groupBy("schema_name", "column").agg(F.schema_of_variant_agg("v").alias("type"), F.count(F.lit(1)).alias("messages"))


def proposed_headers(columns: DataFrame) -> DataFrame:
    """``inferred_columns`` as headers for ``canonical_schemas``: a file per schema, its columns in order of their names."""
    listed = columns.groupBy("schema_name").agg(F.array_sort(F.collect_set("column")).alias("columns"))
    return listed.select(F.concat(F.lit("inferred/"), "schema_name").alias("file_path"), "schema_name", "columns")


def dead_letters(messages: DataFrame, error: Column) -> DataFrame:
    """Rejected messages as ``data, error, timestamp, topic``."""
    return messages.select(
        F.col("value").cast("string").alias("data"),
        error.alias("error"),
        F.current_timestamp().alias("timestamp"),
        "topic",
    )


def tail_messages(rows: DataFrame, registry: DataFrame, prefix: str = TOPIC_PREFIX) -> DataFrame:
    """Rows of ``csv_tail_stream`` as messages of the schema that ``registry`` has for their file, by its name.

    A row with more or fewer values than its schema has columns becomes a JSON array, which no schema takes, and one of a file that is not in the registry has
    no topic; so both reach the quarantine and neither is lost.
    """
    name = F.element_at(F.split("file_path", "/"), -1)
    known = registry.select(F.element_at(F.split("file_path", "/"), -1).alias("_name"), "schema_name", "columns")
    met = rows.withColumn("_name", name).join(known, "_name", "left")
    fits = F.size("columns") == F.size("values")
    value = F.when(fits, F.to_json(F.map_from_arrays("columns", "values"))).otherwise(F.to_json("values"))
    return met.select(topic_for("schema_name", prefix).alias("topic"), value.alias("value"))


def kafka_messages(spark: SparkSession, servers: str, prefix: str = TOPIC_PREFIX, **options) -> DataFrame:
    """All topics of the prefix from their beginning; needs the Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribePattern", f"{prefix}-.*")
        .option("startingOffsets", "earliest")
        .options(**options)
        .load()
        .select("topic", "value")
    )


def file_messages(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """The same contract from a folder that receives JSON-lines files."""
    return (
        spark.readStream.schema(MESSAGE_SCHEMA)
        .option("maxFilesPerTrigger", str(files_per_batch))
        .json(path)
    )
