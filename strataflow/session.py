"""Session settings the jobs rely on, and sizing of the shuffle width."""

from __future__ import annotations

import logging
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime SQL settings; all can be changed on a live session, so the jobs can
# also be used in a session somebody else built.
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Splits a hot key's partition of a sort-merge join at run time.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # A side that is broadcast passes through the driver. Before a query runs Catalyst knows the stored bytes of the columns read, of
    # which rows in memory take many times as much, so that limit is low. Adaptive execution measures shuffled rows and
    # goes by their bytes: a side below the second limit is broadcast all the same.
    "spark.sql.autoBroadcastJoinThreshold": "1m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "16m",
    # INT96, the default, carries no statistics, so merges could not skip row groups.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}

MB = 1024 * 1024
TARGET_PARTITION_BYTES = 128 * MB
# What the driver can keep track of: beyond these partitions and tasks grow (and spill) instead. Both
# are arguments of the functions below, and a warning says when one binds.
MAX_SHUFFLE_PARTITIONS = 50_000
MAX_SCAN_TASKS = 200_000

log = logging.getLogger(__name__)


def apply_defaults(spark: SparkSession) -> SparkSession:
    for key, value in SQL_DEFAULTS.items():
        spark.conf.set(key, value)
    # Folders are listed by a job with, by default, a task for each of them.
    listers = 4 * spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(listers))
    return spark


def build_session(
    app_name: str = "strataflow", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_width(input_bytes: int, cores: int, most: int = MAX_SHUFFLE_PARTITIONS) -> int:
    """Partitions to start a shuffle with: about 128 MB each, at least one per core, ``most`` at most.

    Adaptive execution merges partitions that turn out small but cannot widen a
    shuffle, so the estimate leans high: it takes compressed input at 3x.
    """
    wanted = -(-3 * input_bytes // TARGET_PARTITION_BYTES)
    if wanted > most:
        log.warning("a shuffle of %d partitions is held to %d; load in several bronze versions instead", wanted, most)
    return max(cores, min(wanted, most))


def scan_bytes(input_bytes: int, most_tasks: int = MAX_SCAN_TASKS) -> int:
    """Bytes a scan task reads: 128 MB, more once that would give more than ``most_tasks`` tasks."""
    return max(TARGET_PARTITION_BYTES, -(-input_bytes // most_tasks))


@contextmanager
def sized_shuffle(spark: SparkSession, input_bytes: int) -> Iterator[int]:
    """Within the block the session's shuffles and scans suit the input; after it they are as before."""
    width = shuffle_width(input_bytes, spark.sparkContext.defaultParallelism)
    wanted = {"spark.sql.shuffle.partitions": str(width), "spark.sql.files.maxPartitionBytes": str(scan_bytes(input_bytes))}
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield width
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


#: One filter of 8 MB at most, good for some four million keys, is all that is broadcast. The driver holds it many times over: as a result, in
#: the plan, and in the tasks of each stage that asks it. One for each key column took all of a heap of 750 MB.
KEY_FILTER_BITS, KEY_FILTER_KEYS, KEY_FILTERS = 64 * MB, 4_000_000, 1
_RUNTIME_FILTER = "spark.sql.optimizer.runtime.bloomFilter"
_RUNTIME_FILTERS = "spark.sql.optimizer.runtimeFilter.number.threshold"


@contextmanager
def key_filters(spark: SparkSession, batch_bytes: int = 64 * 1024 * MB) -> Iterator[None]:
    """Within the block a query's lowest join may aggregate a Bloom filter from a side of up to ``batch_bytes`` and drop what can't match from the other before it is shuffled.

    The filter is of the join's first key. Spark's own limits suit a filter from a small dimension. A batch with more keys than the filter is made for drops fewer rows; results are the same.
    """
    wanted = {
        "enabled": "true",
        "creationSideThreshold": str(batch_bytes),
        "applicationSideScanSizeThreshold": "0",
        "expectedNumItems": str(KEY_FILTER_KEYS),
        "numBits": str(KEY_FILTER_BITS),
        "maxNumBits": str(KEY_FILTER_BITS),
    }
    wanted = {f"{_RUNTIME_FILTER}.{key}": value for key, value in wanted.items()} | {_RUNTIME_FILTERS: str(KEY_FILTERS)}
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within the block the shuffle files of a query go when it ends, not only once the driver happens to collect garbage.

    For writes: whoever runs a frame again that was run within it may have to make its shuffles anew.
    """
    before = spark.conf.get(_RELEASE, None)
    spark.conf.set(_RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.unset(_RELEASE) if before is None else spark.conf.set(_RELEASE, before)
