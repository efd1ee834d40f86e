"""Parquet tables kept as numbered versions.

A table is a folder of ``_version=N`` folders, each written by one job. A
version exists once that job has left its success marker, so readers never see
half of one, and a retry of the same number replaces what the failed attempt
left. That gives incremental reads (partition pruning on the number) and
repeatable loads without a transactional table format. A table has one writer at a
time: two that pick the same number would replace each other's rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType, TimestampNTZType, TimestampType

from strataflow.session import key_filters, released_shuffles
from strataflow.sources.files import create_empty, drop_path, glob_paths, new_scratch

VERSION_COL = "_version"
#: Stretches of days a merge looks for in its target; between them nothing is read.
MAX_STRETCHES = 8


def version_path(path: str, version: int) -> str:
    return f"{path}/{VERSION_COL}={version}"


def committed_versions(spark: SparkSession, path: str) -> list[int]:
    markers = glob_paths(spark, f"{path}/{VERSION_COL}=*/_SUCCESS")
    return sorted(int(m.rsplit("/", 2)[1].split("=")[1]) for m in markers)


def latest_version(spark: SparkSession, path: str) -> int | None:
    versions = committed_versions(spark, path)
    return versions[-1] if versions else None


def next_version(spark: SparkSession, path: str) -> int:
    latest = latest_version(spark, path)
    return 0 if latest is None else latest + 1


def _dealt(df: DataFrame, order_by: Sequence[str], tasks: int | None) -> DataFrame:
    if not order_by:
        return df
    tasks = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(tasks, *order_by).sortWithinPartitions(*order_by)


def write_version(
    df: DataFrame, path: str, version: int, order_by: Sequence[str] = (), tasks: int | None = None
) -> None:
    """Write one version, replacing an earlier attempt at it.

    With ``order_by`` the rows are dealt to ``tasks`` tasks (by default as many as a shuffle has
    partitions) by ranges of these columns and sorted, so that files and row groups
    hold tight ranges and a reader skips what it does not ask for. A value that holds most rows is
    split where the further columns differ.
    """
    with released_shuffles(df.sparkSession):
        _dealt(df, order_by, tasks).write.mode("overwrite").parquet(version_path(path, version))


def write_observed(
    df: DataFrame,
    path: str,
    version: int,
    order_by: Sequence[str] = (),
    tasks: int | None = None,
    metrics: Mapping[str, Column] | None = None,
    keep_empty: bool = False,
    lookup: Sequence[str] = (),
) -> dict[str, int]:
    """``write_version`` that also returns the number of ``rows`` and further ``metrics`` (aggregates) of what it wrote, from the job that wrote it.

    They are observed above the sort: below it, the job that samples the ranges would count as well. The version is committed
    after its rows are known, and a version without any is taken back unless ``keep_empty``, so readers never see an empty one.
    Files hold Bloom filters of the ``lookup`` columns, by which a reader that asks for single values skips row groups that ranges don't exclude.
    """
    seen = Observation()
    asked = {"rows": F.count(F.lit(1)), **(metrics or {})}
    observed = _dealt(df, order_by, tasks).observe(seen, *[c.alias(name) for name, c in asked.items()])
    target = version_path(path, version)
    options = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false", "parquet.bloom.filter.adaptive.enabled": "true"}
    options |= {f"parquet.bloom.filter.enabled#{c}": "true" for c in lookup}
    with released_shuffles(df.sparkSession):
        observed.write.mode("overwrite").options(**options).parquet(target)
    found = seen.get
    if found["rows"] or keep_empty:
        create_empty(df.sparkSession, f"{target}/_SUCCESS")
    else:
        drop_path(df.sparkSession, target)
    return found


def read_versions(
    spark: SparkSession, path: str, versions: Sequence[int], schema: str | None = None, keep_version: bool = False
) -> DataFrame:
    """Rows of the given versions, with ``keep_version`` also their number.

    With ``schema`` columns come in its order and no footer is opened to plan the
    read. Without it the schema is that of a file of the one version, or, of several
    versions, the merged one, for which all their footers are read.
    """
    if not versions:
        raise ValueError(f"no committed version to read under {path}")
    reader = spark.read.option("basePath", path)
    if schema is None:
        reader = reader.option("mergeSchema", len(versions) > 1)
    else:
        reader = reader.schema(f"{schema}, {VERSION_COL} int")
    df = reader.parquet(*[version_path(path, v) for v in versions])
    if schema is not None:
        df = df.select(*StructType.fromDDL(schema).names, VERSION_COL)
    return df if keep_version else df.drop(VERSION_COL)


def read_since(
    spark: SparkSession,
    path: str,
    version: int | None = None,
    snapshot: str = "all",
    schema: str | None = None,
) -> DataFrame:
    """Rows added after ``version``; without one, the current snapshot.

    ``snapshot`` tells what the current content of the table is: ``all`` versions
    of an appended table, or only the ``latest`` of one that every load replaces.
    """
    versions = committed_versions(spark, path)
    if version is not None:
        versions = [v for v in versions if v > version]
    elif snapshot == "latest":
        versions = versions[-1:]
    return read_versions(spark, path, versions, schema)


def drop_leftover(spark: SparkSession, path: str, version: int | None) -> None:
    """Take back the version beyond ``version`` that an unfinished run wrote.

    Such a run leaves one at most; more were written on purpose and are not touched.
    """
    beyond = [v for v in committed_versions(spark, path) if version is None or v > version]
    if len(beyond) > 1:
        raise RuntimeError(f"{path} has complete versions {beyond} beyond checkpoint {version}")
    for v in beyond:
        drop_path(spark, version_path(path, v))


def drop_older(spark: SparkSession, path: str, keep: int) -> None:
    """Keep the newest ``keep`` versions of a table that every load replaces."""
    for v in committed_versions(spark, path)[:-keep]:
        drop_path(spark, version_path(path, v))


_KEY_HASH = "_key_hash"
#: Every hash is at least this.
_LEAST_HASH = -(1 << 63)


def known_keys(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of ``batch`` that are in ``target``; a NULL in a key never matches.

    The target's keys are first cut down to those the batch asks for. A batch
    below the broadcast limit then passes over a target of any size without
    shuffling it, and what is left to compare is no larger than the batch. Of a larger batch a Bloom filter of its keys does so (see ``key_filters``):
    keys are joined by a hash of all their columns first, so that the one filter speaks for the whole key.
    """
    hashed = F.xxhash64(*keys).alias(_KEY_HASH)
    # Spark makes a filter of a side that a comparison seems to narrow; this one always holds.
    asked = batch.select(*keys, hashed).where(F.col(_KEY_HASH) >= F.lit(_LEAST_HASH))
    return target.select(*keys, hashed).join(asked, [_KEY_HASH, *keys], "left_semi").select(*keys)


def new_rows(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``target``; a NULL in a key never matches."""
    return batch.join(known_keys(batch, target, keys), list(keys), "left_anti")


def day_stretches(batch: DataFrame, column: str, most: int = MAX_STRETCHES) -> list[tuple[date, date]]:
    """First and last day of the ``most`` stretches that cover a time column with the widest gaps between them.

    One row per day of the batch is ordered; ``most`` rows at most reach the driver.
    """
    days = batch.select(F.to_date(column).alias("day")).where("day IS NOT NULL").distinct()
    ends = days.agg(F.min("day"), F.max("day")).first()
    if ends[0] is None:
        return []
    gaps = days.withColumn("before", F.lag("day").over(Window.orderBy("day"))).where("datediff(day, before) > 1")
    widest = gaps.orderBy(F.datediff("day", "before").desc(), "day").limit(most - 1).collect()
    starts = sorted([ends[0], *(r["day"] for r in widest)])
    stops = sorted([ends[1], *(r["before"] for r in widest)])
    return list(zip(starts, stops))


def _within_batch_range(batch: DataFrame, target: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Target rows inside the batch's stretches of ``cols``, columns that follow from the key.

    Exact, as equal keys share these values. Times are narrowed to stretches of days, so one late row opens
    its own day and not the whole time up to it; other columns to their range.
    """
    for c in cols:
        if isinstance(target.schema[c].dataType, (TimestampType, TimestampNTZType, DateType)):
            kind = target.schema[c].dataType.simpleString()
            day = lambda d: F.lit(d).cast(kind)  # noqa: E731, B023
            inside = [(F.col(c) >= day(a)) & (F.col(c) < day(b + timedelta(days=1))) for a, b in day_stretches(batch, c)]
            target = target.where(reduce(Column.__or__, inside, F.lit(False)))
        else:
            low = batch.agg(F.min(c)).scalar()
            high = batch.agg(F.max(c)).scalar()
            target = target.where((F.col(c) >= low) & (F.col(c) <= high))
    return target


def insert_only_merge(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    version: int,
    order_by: Sequence[str] = (),
    bound: Sequence[str] = (),
    schema: str | None = None,
    tasks: int | None = None,
) -> int:
    """Add the rows of ``batch`` whose key the table does not hold yet, as ``version``.

    Creates the table when there is none and appends everything when ``keys`` is
    empty. Existing rows are never changed. ``bound`` names columns, fixed by the
    key, by which the target is narrowed to the batch's range; it makes the merge
    read ``batch`` more than once, so pass a stored one. ``order_by`` and ``tasks``
    are those of ``write_version``. Returns how many rows were added.
    """
    spark = batch.sparkSession
    others = [v for v in committed_versions(spark, path) if v != version]
    lookup = [k for k in keys if k not in bound]
    if not (keys and others):
        return write_observed(batch, path, version, order_by, tasks, keep_empty=True, lookup=lookup)["rows"]
    target = _within_batch_range(batch, read_versions(spark, path, others, schema), bound)
    # Stored, so that the shuffles that find the known keys are gone when those of the new rows are made, and a few are broadcast.
    scratch = new_scratch(spark, "known")
    try:
        known = known_keys(batch, target, keys)
        with key_filters(spark), released_shuffles(spark):
            known.write.parquet(scratch)
        rows = batch.join(spark.read.schema(known.schema).parquet(scratch), list(keys), "left_anti")
        return write_observed(rows, path, version, order_by, tasks, keep_empty=True, lookup=lookup)["rows"]
    finally:
        drop_path(spark, scratch)
