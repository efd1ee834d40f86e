"""Bronze to silver, one run per entity: whatever bronze versions are new."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from strataflow.plans.entities import Entity
from strataflow.session import apply_defaults, released_shuffles, shuffle_width, sized_shuffle
from strataflow.sources.catalog import get_checkpoint, register_table, set_checkpoint
from strataflow.sources.changes import CHANGE_TYPE, COMMIT_VERSION, NEW_CONTENT, changes_since
from strataflow.sources.files import drop_path, new_scratch, path_exists, size_of
from strataflow.sources.versions import (
    committed_versions,
    drop_leftover,
    insert_only_merge,
    latest_version,
    read_since,
    read_versions,
    version_path,
)


def last_processed(spark: SparkSession, entity: Entity, base: str) -> int | None:
    """Bronze version the silver tables are complete up to.

    Silver versions carry the number of the bronze version they were made from and
    the features are written last, so the newest one there is the checkpoint.
    """
    path = entity.features_path(base) if entity.run_features else entity.cleaned_path(base)
    return latest_version(spark, path)


def _store_cleaned(spark: SparkSession, entity: Entity, base: str, cleaned: DataFrame, version: int, changes: str):
    """Write the cleaned rows; return them re-readable, the scratch folder used, if any, and how many were added.

    The batch is needed again for the merge and for the features, so it is stored
    once rather than computed each time: the first load in the table itself, later
    ones in scratch. ``changes``, which ``cleaned`` may read, goes once the batch is there.
    """
    path = entity.cleaned_path(base)
    if not committed_versions(spark, path):
        rows = insert_only_merge(cleaned, path, entity.merge_keys_cleaned, version, order_by=entity.order_cleaned)
        return read_versions(spark, path, [version], entity.cleaned_schema), None, rows
    scratch = new_scratch(spark, f"{entity.name}-batch")
    with released_shuffles(spark):
        cleaned.write.parquet(scratch)
    drop_path(spark, changes)
    batch = spark.read.schema(entity.cleaned_schema).parquet(scratch)
    rows = insert_only_merge(
        batch,
        path,
        entity.merge_keys_cleaned,
        version,
        order_by=entity.order_cleaned,
        bound=entity.bound,
        schema=entity.cleaned_schema,
    )
    return batch, scratch, rows


def _bytes_of_run(spark: SparkSession, entity: Entity, base: str, last: int | None) -> tuple[int, int]:
    """Bytes of the new rows, and of those and the tables they are merged into."""
    bronze = entity.bronze_path(base)
    new = [v for v in committed_versions(spark, bronze) if last is None or v > last]
    added = size_of(spark, [version_path(bronze, v) for v in new])
    targets = [p for p in (entity.cleaned_path(base), entity.features_path(base)) if path_exists(spark, p)]
    return added, added + size_of(spark, targets)


def _backfill_features(spark: SparkSession, entity: Entity, base: str, as_of: Column | None) -> int | None:
    """Features of everything cleaned, where none were built yet: they were switched on later, or the first run broke off.

    Returns the bronze version the silver tables are then complete up to.
    """
    if not (entity.run_cleaned and entity.run_features) or committed_versions(spark, entity.features_path(base)):
        return last_processed(spark, entity, base)
    version = latest_version(spark, entity.cleaned_path(base))
    if version is not None:
        cleaned = read_cleaned(spark, entity, base)
        insert_only_merge(
            entity.build_features(cleaned, as_of),
            entity.features_path(base),
            entity.merge_keys_features,
            version,
            order_by=entity.order_features,
            schema=entity.features_schema,
        )
    return version


def _new_rows(spark: SparkSession, entity: Entity, base: str, last: int | None, scratch: str) -> DataFrame:
    """What bronze has beyond version ``last``.

    Of a table that every load replaces these are the rows that a load did not find in the one before: merges only insert, so what
    was cleaned once has nothing to add. Where the loads to compare with are gone, whole loads are read.
    """
    bronze = entity.bronze_path(base)
    if entity.snapshot != "latest" or last is None or last not in committed_versions(spark, bronze):
        return read_since(spark, bronze, last, entity.snapshot, entity.bronze_schema)
    feed = changes_since(spark, bronze, last, types=NEW_CONTENT, scratch=scratch, schema=entity.bronze_schema, store=True)
    return feed.drop(CHANGE_TYPE, COMMIT_VERSION)


def _process(
    spark: SparkSession, entity: Entity, base: str, last: int | None, current: int, as_of: Column | None
) -> bool:
    added, _ = _bytes_of_run(spark, entity, base, last)
    tasks = shuffle_width(added, spark.sparkContext.defaultParallelism)
    changes = new_scratch(spark, f"{entity.name}-changes")
    raw = _new_rows(spark, entity, base, last, changes)
    # What a failed run left behind must not count as existing rows.
    drop_leftover(spark, entity.cleaned_path(base), last)
    scratch = None
    try:
        batch = raw
        if entity.run_cleaned:
            batch, scratch, stored = _store_cleaned(spark, entity, base, entity.build_cleaned(raw), current, changes)
            # The job that stored the rows counted them; only where there are none it matters whether there was input.
            if not stored and last is None and raw.isEmpty():
                drop_path(spark, version_path(entity.cleaned_path(base), current))
                return False
        if entity.run_features:
            insert_only_merge(
                entity.build_features(batch, as_of),
                entity.features_path(base),
                entity.merge_keys_features,
                current,
                order_by=entity.order_features,
                bound=entity.bound,
                schema=entity.features_schema,
                tasks=tasks,
            )
    finally:
        for path in (scratch, changes):
            if path:
                drop_path(spark, path)
    return True


def _register(spark: SparkSession, entity: Entity, base: str, database: str, version: int) -> None:
    """Bring the catalog up to ``version``: whatever it does not show yet, as a registration may have failed."""
    tables = []
    if entity.run_features:
        tables.append((entity.table_features, entity.features_path(base), entity.features_schema))
    if entity.run_cleaned:
        tables.append((entity.table_cleaned, entity.cleaned_path(base), entity.cleaned_schema))
    # The checkpoint is on the table registered last, so that it stands for both.
    marked = f"{database}.{tables[-1][0]}"
    shown = get_checkpoint(spark, marked)
    if shown == version:
        return
    for name, path, schema in tables:
        new = [v for v in committed_versions(spark, path) if shown is None or v > shown]
        register_table(spark, f"{database}.{name}", path, StructType.fromDDL(schema), new)
    set_checkpoint(spark, marked, version)


def run_incremental(
    spark: SparkSession,
    entity: Entity,
    base: str,
    as_of: Column | None = None,
    database: str | None = "silver",
) -> dict[str, object]:
    """Bring an entity's silver tables up to its bronze table.

    Returns ``{"status", "elapsed"}`` with status ``OK``, or ``UP_TO_DATE`` /
    ``EMPTY`` when there was nothing to do. Errors are raised; a run repeated after
    one starts from the last complete version and gives the same tables.
    """
    started = time.monotonic()
    apply_defaults(spark)
    bronze = entity.bronze_path(base)
    current = latest_version(spark, bronze)
    if current is None:
        raise ValueError(f"nothing loaded under {bronze}")
    with sized_shuffle(spark, _bytes_of_run(spark, entity, base, last_processed(spark, entity, base))[1]):
        last = _backfill_features(spark, entity, base, as_of)
        if last is not None and last >= current:
            status = "UP_TO_DATE"
        else:
            status = "OK" if _process(spark, entity, base, last, current, as_of) else "EMPTY"
    if database and status != "EMPTY":
        _register(spark, entity, base, database, current)
    return {"status": status, "elapsed": time.monotonic() - started}


def read_cleaned(spark: SparkSession, entity: Entity, base: str) -> DataFrame:
    return read_since(spark, entity.cleaned_path(base), schema=entity.cleaned_schema)


def read_features(spark: SparkSession, entity: Entity, base: str) -> DataFrame:
    return read_since(spark, entity.features_path(base), schema=entity.features_schema)
