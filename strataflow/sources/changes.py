"""Row-level changes between two contents of a table.

A batch load replaces its table, so most of a new version is what the one before held. A difference by key and digest
finds what is not: each version is projected to its key and a digest of the row, one aggregation counts every (key, digest) on both sides, and only
rows whose counts differ are looked up again. Repeated rows are counted, not collapsed. Per changed row:

* ``insert``: the key lost no row; ``delete``: the key gained none;
* ``update_preimage`` and ``update_postimage``: rows lost and gained by a key that has both.

A key with a NULL part equals no other, so its rows are inserted and deleted. Columns that only the later version has count as NULL in the earlier
one; columns that only the earlier version has are not compared. A digest is the SHA-256 of the row as JSON.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.session import released_shuffles
from strataflow.sources.files import drop_path, new_scratch, size_of
from strataflow.sources.versions import committed_versions, read_versions, version_path

CHANGE_TYPE, COMMIT_VERSION = "_change_type", "_commit_version"
INSERT, DELETE, PREIMAGE, POSTIMAGE = "insert", "delete", "update_preimage", "update_postimage"
#: The types whose rows are content of the later version.
NEW_CONTENT = (INSERT, POSTIMAGE)
#: Stamps of a load, which every row of it has anew.
AUDIT = ("_ingestion_timestamp", "_source", "_topic")

_JSON = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
#: Copies of one row made by one step, so that no array grows with their number.
_COPIES = 1 << 16


#: Slices ``changes_since`` looks for changes in, where it stores them: one for so many stored bytes of the two loads. Each slice reads both anew.
SLICE_BYTES, MAX_SLICES = 32 << 20, 3


def _row_json(columns: Sequence[str]) -> Column:
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), _JSON)


def row_digest(columns: Sequence[str]) -> Column:
    """32 bytes; as hex digits they would be 64 in every shuffle, which compression doesn't make up for."""
    return F.unhex(F.sha2(_row_json(columns), 256))


def _short(digest: Column) -> Column:
    """8 bytes of a digest for rows to travel with; what meets by them is compared by whole digests."""
    return F.xxhash64(digest)


def _with_columns_of(df: DataFrame, model: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in model.schema])


def changed_digests(before: DataFrame, after: DataFrame, keys: Sequence[str] = (), ignore: Sequence[str] = AUDIT) -> DataFrame:
    """``_digest``, ``_copies`` gained (or, below 0, lost) and the change type of every row whose number changed.

    The counts are folded in each task before the shuffle, so a row with a third of all copies, and a key of no digest of its own,
    weigh as much as any other; what is compared per key are changed rows only.
    """
    compared = [c for c in after.columns if c not in ignore]

    def side(df: DataFrame, weight: int) -> DataFrame:
        return df.select(*[F.col(f"`{k}`").alias(f"_key_{i}") for i, k in enumerate(keys)], row_digest(compared).alias("_digest"), F.lit(weight).cast("long").alias("_n"))

    names = [f"_key_{i}" for i in range(len(keys))]
    both = side(_with_columns_of(before, after), -1).unionAll(side(after, 1))
    net = both.groupBy(*names, "_digest").agg(F.sum("_n").alias("_copies")).where("_copies <> 0")
    gained = F.col("_copies") > 0
    if not keys:
        return net.select("_digest", "_copies", F.when(gained, INSERT).otherwise(DELETE).alias(CHANGE_TYPE))
    keyed = net.groupBy(*names).agg(F.bool_or(gained).alias("_gained"), F.bool_or(~gained).alias("_lost"))
    # An inner-type condition on NULL holds for no row, so keys with a NULL part find nothing here.
    met = net.join(keyed.where("_gained AND _lost"), names, "left")
    updated = F.col("_gained").isNotNull()
    kind = F.when(gained, F.when(updated, POSTIMAGE).otherwise(INSERT)).otherwise(F.when(updated, PREIMAGE).otherwise(DELETE))
    return met.select("_digest", "_copies", kind.alias(CHANGE_TYPE))


def rows_of(changed: DataFrame, df: DataFrame, columns: Sequence[str], copies: Column) -> DataFrame:
    """The rows of ``df`` that ``changed`` names, ``copies`` of each. Pass a stored ``changed``: Spark then knows its size and broadcasts it
    if it is small, so ``df`` is not shuffled. If it is large, shuffled rows carry 8 bytes for their digest, which is made again, and compared,
    where these meet those of a changed one."""
    names = list(df.columns)
    wanted = changed.select("_digest", copies.alias("_copies"), CHANGE_TYPE)
    found = df.withColumn("_digest_hash", _short(row_digest(columns))).join(wanted, F.col("_digest_hash") == _short(F.col("_digest")))
    row = F.when(row_digest(columns) == F.col("_digest"), F.struct(*[F.col(f"`{c}`") for c in names]))
    one = found.groupBy("_digest_hash", "_digest", "_copies", CHANGE_TYPE).agg(F.first(row, ignorenulls=True).alias("_row"))
    last = F.col("_copies") - 1
    steps = one.withColumn("_step", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / _COPIES))))
    rows = steps.withColumn("_nth", F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.lit(_COPIES - 1), last - F.col("_step") * _COPIES))))
    return rows.select(*[F.col("_row").getField(c).alias(c) for c in names], CHANGE_TYPE)


def change_feed(
    before: DataFrame, after: DataFrame, keys: Sequence[str] = (), ignore: Sequence[str] = AUDIT, types: Sequence[str] | None = None, scratch: str | None = None
) -> DataFrame:
    """The changed rows, with ``after``'s columns and ``_change_type``; ``types`` narrows them, and spares the look-up in a version that has none of them.

    The changed digests are stored under ``scratch``, by default in a new scratch folder.
    """
    spark = after.sparkSession
    scratch = scratch or new_scratch(spark, "changes")
    before = _with_columns_of(before, after)
    compared = [c for c in after.columns if c not in ignore]
    found = changed_digests(before, after, keys, ignore)
    if types is not None:
        found = found.where(F.col(CHANGE_TYPE).isin(*types))
    with released_shuffles(spark):
        found.write.mode("overwrite").parquet(scratch)
    changed = spark.read.schema(found.schema).parquet(scratch)
    parts = []
    if types is None or set(types) & set(NEW_CONTENT):
        parts.append(rows_of(changed.where("_copies > 0"), after, compared, F.col("_copies")))
    if types is None or set(types) - set(NEW_CONTENT):
        parts.append(rows_of(changed.where("_copies < 0"), before, compared, -F.col("_copies")))
    return reduce(DataFrame.unionAll, parts)


def _stored_slices(before: DataFrame, after: DataFrame, ignore: Sequence[str], types: Sequence[str] | None, scratch: str, slices: int) -> DataFrame:
    """``change_feed`` without keys, stored under ``scratch``: equal rows of both loads are in one slice, so each is compared by itself
    and its shuffles and digests go before the next one starts."""
    spark = after.sparkSession
    before = _with_columns_of(before, after)
    own = F.pmod(F.xxhash64(_row_json([c for c in after.columns if c not in ignore])), F.lit(slices))
    for i in range(slices):
        part = lambda df: df if slices == 1 else df.where(own == i)  # noqa: E731, B023
        feed = change_feed(part(before), part(after), (), ignore, types, f"{scratch}/digests")
        with released_shuffles(spark):
            feed.write.mode("append").parquet(f"{scratch}/rows")
        drop_path(spark, f"{scratch}/digests")
    return spark.read.schema(feed.schema).parquet(f"{scratch}/rows")


def changes_since(
    spark: SparkSession,
    path: str,
    version: int,
    keys: Sequence[str] = (),
    ignore: Sequence[str] = AUDIT,
    types: Sequence[str] | None = None,
    scratch: str | None = None,
    schema: str | None = None,
    store: bool = False,
) -> DataFrame:
    """The changes of every load after ``version`` of a table that each load replaces, with ``_change_type`` and ``_commit_version``.

    Each load is compared with the one before it, so rows that came and went again are there. ``version`` itself must still be stored.
    With ``store``, for feeds without ``keys``, the changes are written to ``scratch`` and read from there, so that no more than a slice's shuffles are on disk at a time.
    """
    if store and (keys or not scratch):
        raise ValueError("a feed that is stored has no keys, and a folder")
    versions = committed_versions(spark, path)
    if version not in versions:
        raise ValueError(f"version {version} of {path} is no longer stored")
    later = [v for v in versions if v > version]
    if not later:
        raise ValueError(f"{path} has no version after {version}")
    feeds = []
    for old, new in zip([version, *later], later):
        contents = [read_versions(spark, path, [v], schema) for v in (old, new)]
        if store:
            loaded = size_of(spark, [version_path(path, v) for v in (old, new)])
            feed = _stored_slices(*contents, ignore, types, f"{scratch}/{new}", min(MAX_SLICES, loaded // SLICE_BYTES + 1))
        else:
            feed = change_feed(*contents, keys, ignore, types, f"{scratch}/{new}" if scratch else None)
        feeds.append(feed.withColumn(COMMIT_VERSION, F.lit(new)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)
