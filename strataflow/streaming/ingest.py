"""Messages of many topics into one bronze table per schema."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType
from pyspark.storagelevel import StorageLevel
from pyspark.util import inheritable_thread_target

from strataflow.operators import stamp_audit
from strataflow.session import apply_defaults
from strataflow.sources.catalog import get_checkpoint, register_table, set_checkpoint
from strataflow.sources.files import drop_path, first_line, glob_paths, make_folder
from strataflow.sources.messages import NO_SCHEMA, TOPIC_PREFIX, dead_letters, misfit, parse_messages, schema_name_of
from strataflow.sources.versions import (
    VERSION_COL,
    committed_versions,
    latest_version,
    read_versions,
    write_observed,
    write_version,
)

log = logging.getLogger(__name__)

QUARANTINE = "quarantine"
DEAD_LETTERS = "data string, error string, timestamp timestamp, topic string"


def stream_path(base: str, schema_name: str) -> str:
    return f"{base}/streaming/{schema_name}"


def quarantine_path(base: str) -> str:
    """Apart from the topics, so that rejected messages are never read back as input."""
    return f"{base}/{QUARANTINE}"


def _try_register(table: str, path: str, rows: DataFrame, version: int) -> None:
    """Show this batch and those whose registration failed before.

    The rows are stored by now; a catalog that is away must not stop the stream.
    """
    spark = rows.sparkSession
    try:
        shown = get_checkpoint(spark, table)
        new = [v for v in committed_versions(spark, path) if shown is None or v > shown]
        register_table(spark, table, path, rows.schema, new)
        set_checkpoint(spark, table, max([version, *new]))
    except Exception:
        log.warning("could not register %s", table, exc_info=True)


def query_id(spark: SparkSession, checkpoint: str) -> str:
    return json.loads(first_line(spark, f"{checkpoint}/metadata"))["id"]


def _number(path: str) -> int:
    return int(path.rsplit("=", 1)[1])


def version_for(spark: SparkSession, base: str, query: str, batch_id: int) -> int:
    """The number under ``base`` of a query's batch: beyond all that were given out, and the same again when the batch is replayed.

    It is fixed in a folder's name before the batch first writes, so queries that take turns, and replays of the quarantine between
    them, add to the same tables. A query only ever repeats its last batch, so numbers of those before are forgotten, and the listing is
    one or two names per query. The tables themselves are listed for a query's first batch only.
    """
    own = f"{base}/streaming_queries/{query}"
    found = glob_paths(spark, f"{own}/batch={batch_id}/version=*")
    if found:
        return _number(found[0])
    given = glob_paths(spark, f"{base}/streaming_queries/*/batch=*/version=*")
    before = [p for p in given if f"/streaming_queries/{query}/" in p]
    numbers = [_number(p) for p in given]
    if not before:
        folders = {m.rsplit("/", 2)[0] for m in glob_paths(spark, f"{base}/streaming/*/{VERSION_COL}=*/_SUCCESS")}
        latest = [latest_version(spark, f) for f in [*sorted(folders), quarantine_path(base)]]
        numbers += [v for v in latest if v is not None]
    version = 1 + max(numbers, default=-1)
    make_folder(spark, f"{own}/batch={batch_id}/version={version}")
    for p in before:
        folder = p.rsplit("/", 1)[0]
        if _number(folder) < batch_id - 1:
            drop_path(spark, folder)
    return version


def _write_rows(
    fitting: DataFrame, name: str, schema: StructType, version: int, base: str, source: str, database: str | None
) -> None:
    """Messages that fit their schema, as a version of its table."""
    parsed = parse_messages(fitting, schema)
    rows = stamp_audit(parsed.withColumnRenamed("topic", "_in"), source, topic=F.col("_in")).drop("_in")
    write_version(rows, stream_path(base, name), version)
    if database:
        _try_register(f"{database}.{name}", stream_path(base, name), rows, version)


def _columns(schemas: Mapping[str, StructType], names: Iterable[str]) -> dict[str, list[str]]:
    return {n: schemas[n].names for n in names}


def route_messages(
    batch: DataFrame,
    batch_id: int,
    schemas: Mapping[str, StructType],
    base: str,
    source: str = "kafka",
    prefix: str = TOPIC_PREFIX,
    database: str | None = None,
    threads: int = 8,
) -> list[str]:
    """Write one micro-batch: a version per schema present, and one of rejected messages.

    The version is ``batch_id``, so a batch that is replayed after a failure
    replaces its first attempt. Messages that no schema is registered for or that do not fit theirs go to the quarantine with the reason.
    Only the names of the schemas present come to the driver. Schemas are written ``threads`` at a time. Returns the schemas written.
    """
    named = batch.select("topic", "value", schema_name_of("topic", prefix).alias("_schema"))
    # Read by one write per schema; the source is asked only once.
    named.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        present = {r[0] for r in named.select("_schema").distinct().collect()}
        # Only schemas that are there become part of the expression.
        judged = named.withColumn("_why", misfit(_columns(schemas, sorted(n for n in present if n in schemas))))
        fits = F.col("_why").isNull()
        found = {(r[0], r[1]) for r in judged.select("_schema", fits.alias("fits")).distinct().collect()}
        known = sorted(n for n, ok in found if ok)

        def write(name: str) -> None:
            fitting = judged.where(fits & (F.col("_schema") == name))
            _write_rows(fitting, name, schemas[name], batch_id, base, source, database)

        with ThreadPoolExecutor(threads) as pool:
            list(pool.map(inheritable_thread_target(write), known))
        if any(not ok for _, ok in found):
            write_version(dead_letters(judged.where(~fits), F.col("_why")), quarantine_path(base), batch_id)
        return known
    finally:
        named.unpersist()


def _taken(spark: SparkSession, base: str, name: str) -> dict[int, list[int]]:
    """Which quarantine versions each replay of a schema takes, by the version it writes."""
    taken: dict[int, list[int]] = {}
    for path in glob_paths(spark, f"{base}/quarantine_taken/{name}/by=*/from=*"):
        folder, _, origin = path.rpartition("/from=")
        taken.setdefault(_number(folder), []).append(int(origin))
    return taken


def replay_quarantine(
    spark: SparkSession,
    base: str,
    schemas: Mapping[str, StructType],
    source: str = "kafka",
    prefix: str = TOPIC_PREFIX,
    database: str | None = None,
) -> dict[str, list[int]]:
    """Move messages that were rejected for want of a schema to bronze, now that it is registered.

    Each schema gets a version of its own, beyond all others, so incremental readers find it. What a version takes is fixed, in folders' names, before it is written: a replay
    that broke off is finished under the same number, and one that is repeated finds nothing. Messages that do not fit the schema are
    quarantined anew with that reason. No stream may write under ``base`` meanwhile, except the one that calls this. Returns ``{schema: quarantine versions moved}``.
    """
    rejected = committed_versions(spark, quarantine_path(base))
    if not rejected:
        return {}
    error = {n: f"{NO_SCHEMA}{n}" for n in schemas}
    waiting = (
        read_versions(spark, quarantine_path(base), rejected, DEAD_LETTERS, keep_version=True)
        .where(F.col("error").isin(*error.values()) & F.col("topic").isNotNull())
        .groupBy(schema_name_of("topic", prefix).alias("name"))
        .agg(F.collect_set(VERSION_COL).alias("versions"))
    )
    moved: dict[str, list[int]] = {}
    for name, versions in sorted((r[0], set(r[1])) for r in waiting.collect()):
        taken = _taken(spark, base, name)
        done = set(committed_versions(spark, stream_path(base, name)))
        jobs = {by: origins for by, origins in taken.items() if by not in done}
        fresh = versions.difference(*taken.values())
        if fresh:
            by = version_for(spark, base, f"replay-{name}", len(taken))
            for origin in sorted(fresh):
                make_folder(spark, f"{base}/quarantine_taken/{name}/by={by}/from={origin}")
            jobs[by] = sorted(fresh)
        for by, origins in sorted(jobs.items()):
            letters = read_versions(spark, quarantine_path(base), origins, DEAD_LETTERS).where(F.col("error") == error[name])
            messages = letters.select("topic", F.col("data").alias("value"), schema_name_of("topic", prefix).alias("_schema")).where(F.col("_schema") == name)
            judged = messages.withColumn("_why", misfit(_columns(schemas, [name])))
            write_observed(dead_letters(judged.where("_why IS NOT NULL"), F.col("_why")), quarantine_path(base), by)
            # The rows come last: their version says that the replay is done.
            _write_rows(judged.where("_why IS NULL"), name, schemas[name], by, base, source, database)
            moved.setdefault(name, []).extend(origins)
    return moved


def unregistered(spark: SparkSession, base: str) -> DataFrame:
    """The quarantined messages that no schema was registered for, as ``topic, value``."""
    letters = read_versions(spark, quarantine_path(base), committed_versions(spark, quarantine_path(base)), DEAD_LETTERS)
    return letters.where(F.col("error").startswith(NO_SCHEMA)).select("topic", F.col("data").alias("value"))


def start_bronze_stream(
    messages: DataFrame,
    load_registry: Callable[[], Mapping[str, StructType]],
    base: str,
    checkpoint: str,
    source: str = "kafka",
    available_now: bool = False,
    database: str | None = None,
    replay: bool = False,
) -> StreamingQuery:
    """Run the routing as a checkpointed query.

    ``load_registry`` is called for every batch, so a schema registered while the
    query runs is used from the next batch on; with ``replay`` its quarantined messages are moved to bronze before that batch.
    Several queries add to the same tables; they must not run at the same time.
    """
    spark: SparkSession = apply_defaults(messages.sparkSession)
    query: list[str] = []
    replayed: set[str] = set()

    def write(batch: DataFrame, batch_id: int) -> None:
        if not query:
            query.append(query_id(spark, checkpoint))
        schemas = load_registry()
        if replay and not replayed.issuperset(schemas):
            replay_quarantine(spark, base, schemas, source, database=database)
            replayed.update(schemas)
        route_messages(batch, version_for(spark, base, query[0], batch_id), schemas, base, source, database=database)

    writer = messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
