"""Which column lists are known, under which name, and which file uses which.

The registry is itself a small table, ``(file_path, schema_name, columns)``. Names are given by a plan; only
those that a stream asks for, one per topic, ever reach the driver.
"""

from __future__ import annotations

import itertools
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strataflow.sources.csv_files import all_string
from strataflow.sources.files import new_scratch


def _name(wanted: Column, suffix: Column) -> Column:
    return F.when(suffix == 0, wanted).otherwise(F.concat_ws("_", wanted, suffix.cast("string")))


def _blocked(known: DataFrame) -> DataFrame:
    """``wanted, blocked``: of each name, the suffixes that known names leave no room for; 0 stands for the name as it is."""
    name = F.col("schema_name")
    parts = F.regexp_extract(name, "^(.*)_([1-9][0-9]{0,17})$", 1), F.regexp_extract(name, "^(.*)_([1-9][0-9]{0,17})$", 2)
    numbered = F.when(parts[1] != "", F.struct(parts[0].alias("wanted"), parts[1].cast("long").alias("suffix")))
    plain = F.struct(name.alias("wanted"), F.lit(0).cast("long").alias("suffix"))
    pairs = known.select("schema_name").distinct().select(F.explode(F.array_compact(F.array(plain, numbered))).alias("p"))
    return pairs.groupBy("p.wanted").agg(F.array_sort(F.collect_set("p.suffix")).alias("blocked"))


def name_schemas(lists: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``schema_name, columns`` for column lists ``(first, wanted, columns)`` in the order of ``first``, which is theirs alone.

    Each list gets the name it wants, or the first free of ``_1``, ``_2``, … that no known list and none before it has. Lists that want one name are ranked, and skip what
    known names block; so they clash only with lists that want another name (``a_1`` itself against the second ``a``). Those clashes are settled in rounds: a name
    stays with the first that claims it, and of the others' names the loser and all after it move up by one. That ends in the names
    that handing them out one by one would give, and no list ever moves back.
    """
    rank = F.row_number().over(Window.partitionBy("wanted").orderBy("first")) - 1
    state = lists.select("first", "wanted", "columns", rank.cast("long").alias("rank"))
    if known is not None:
        state = state.join(_blocked(known), "wanted", "left")
    else:
        state = state.withColumn("blocked", F.lit(None).cast("array<bigint>"))
    state = state.withColumn("slot", F.col("rank"))
    free = F.aggregate(F.coalesce("blocked", F.array().cast("array<bigint>")), F.col("slot"), lambda at, b: F.when(b <= at, at + 1).otherwise(at))
    spark = lists.sparkSession
    path = new_scratch(spark, "schema-names")
    for turn in itertools.count():
        # Each round starts from stored rows, whatever the number of rounds.
        state.withColumn("schema_name", _name(F.col("wanted"), free)).write.parquet(f"{path}/{turn}")
        claims = spark.read.parquet(f"{path}/{turn}")
        held = claims.groupBy("schema_name").agg(F.min("first").alias("holder"), F.count(F.lit(1)).alias("n")).where("n > 1")
        lost = claims.join(held, "schema_name").where("first <> holder").groupBy("wanted").agg(F.min("rank").alias("lost_from"))
        if lost.isEmpty():
            return claims.select("schema_name", "columns")
        moved = F.coalesce((F.col("rank") >= F.col("lost_from")).cast("long"), F.lit(0).cast("long"))
        state = claims.drop("schema_name").join(lost, "wanted", "left").withColumn("slot", F.col("slot") + moved).drop("lost_from")


def canonical_schemas(
    headers: DataFrame, known: DataFrame | None = None, force_refresh: bool = False
) -> DataFrame:
    """Registry over ``headers`` ``(file_path, schema_name, columns)``.

    Files with the same ordered columns share the name proposed by the first of
    them; a name already used for other columns gets ``_1``, ``_2``, …. A file in
    ``known`` keeps its entry unless ``force_refresh`` and ``headers`` has it anew; entries of files that are not in
    ``headers`` always stay, so the result can be saved in the place of ``known``. Files are reduced to their
    distinct column lists before anything leaves the executors.
    """
    mapped, kept = headers, None
    if known is not None:
        if force_refresh:
            kept = known.join(headers.select("file_path"), "file_path", "left_anti")
        else:
            kept = known
            mapped = headers.join(known.select("file_path"), "file_path", "left_anti")
    lists = mapped.groupBy("columns").agg(F.min(F.struct("file_path", "schema_name")).alias("first"))
    lists = lists.select(F.col("first.file_path").alias("first"), F.col("first.schema_name").alias("wanted"), "columns")
    if known is None:
        names = name_schemas(lists)
    else:
        # Of several names that are registered for one list the least is used.
        registered = known.groupBy("columns").agg(F.min("schema_name").alias("schema_name"))
        fresh = name_schemas(lists.join(registered, "columns", "left_anti"), known)
        names = fresh.unionByName(registered)
    out = mapped.join(names.withColumnRenamed("schema_name", "canonical"), "columns")
    out = out.select("file_path", F.col("canonical").alias("schema_name"), "columns")
    return out if kept is None else kept.select("file_path", "schema_name", "columns").unionAll(out)


def registered_schemas(registry: DataFrame) -> dict[str, list[str]]:
    """``{schema name: columns}`` of a registry table."""
    rows = registry.select("schema_name", "columns").distinct().orderBy("schema_name").collect()
    return {r[0]: list(r[1]) for r in rows}


def load_schemas(registry: DataFrame | Mapping) -> dict[str, StructType]:
    """All-text struct per schema name.

    Takes a registry table, or a mapping ``{"schemas": {name: columns}, …}`` or in
    the older form ``{name: columns}``.
    """
    if isinstance(registry, DataFrame):
        schemas = registered_schemas(registry)
    else:
        schemas = registry.get("schemas", registry)
    return {name: all_string(list(cols)) for name, cols in schemas.items()}


def get_schema(registry: DataFrame, schema_name: str) -> list[str] | None:
    row = registry.where(F.col("schema_name") == schema_name).select("columns").first()
    return list(row[0]) if row else None


def list_schemas(registry: DataFrame) -> DataFrame:
    return registry.select("schema_name", "columns").distinct()


def list_file_mappings(registry: DataFrame) -> DataFrame:
    return registry.select("file_path", "schema_name")
