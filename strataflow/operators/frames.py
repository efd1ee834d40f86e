"""Row- and key-level cleaning operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions import clamp_between, clamp_in, null_sentinel


def rename_map(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"cannot rename missing columns {missing}; have {df.columns}")
    return df.withColumnsRenamed(dict(names))


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Project to the given columns, in the given order, NULL where a value does not fit."""
    return df.select(*[F.col(c).try_cast(t).alias(c) for c, t in types.items()])


def require_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with a value in each of ``cols``, written so that it reaches the Parquet scan."""
    for c in cols:
        df = df.where(F.col(c).isNotNull())
    return df


def sentinel_to_null(df: DataFrame, cols: Sequence[str], sentinel: float = -1) -> DataFrame:
    return df.withColumns({c: null_sentinel(c, sentinel) for c in cols})


def clamp_range(df: DataFrame, col: str, lo: float | None = None, hi: float | None = None) -> DataFrame:
    return df.withColumn(col, clamp_between(col, lo, hi))


def clamp_set(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return df.withColumn(col, clamp_in(col, values))


def stamp_audit(
    df: DataFrame, source: str, topic: Column | None = None, ingested_at: Column | None = None
) -> DataFrame:
    stamps = {
        "_ingestion_timestamp": F.current_timestamp() if ingested_at is None else ingested_at,
        "_source": F.lit(source),
    }
    if topic is not None:
        stamps["_topic"] = topic
    return df.withColumns(stamps)


def dedup_latest(df: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """One row per key: the latest by ``order_col``, ties to the greatest remaining columns.

    ``max`` over a struct rather than a ranked window: each task first folds its
    own rows of a key into one, so a key with a third of all rows sends one row
    per task through the shuffle. NULL sorts lowest; NULL keys group together.
    """
    rest = [c for c in df.columns if c not in keys and c != order_col]
    winner = df.groupBy(*keys).agg(F.max(F.struct(order_col, *rest)).alias("_winner"))
    return winner.select(*[c if c in keys else F.col(f"_winner.{c}").alias(c) for c in df.columns])


def explode_delimited(
    df: DataFrame,
    col: str,
    pattern: str,
    out: str,
    keep: Sequence[str],
    drop: Sequence[str] = (),
    keep_is_unique: bool = False,
) -> DataFrame:
    """Distinct ``(keep…, out)`` pairs of lower-cased, trimmed, non-blank tokens.

    Tokens are made distinct inside each row before they are exploded. When
    ``keep`` identifies a row that already makes the pairs distinct, without a
    shuffle; otherwise a ``distinct`` follows.
    """
    tokens = F.transform(F.split(col, pattern), lambda t: F.lower(F.trim(t)))
    wanted = F.filter(tokens, lambda t: ~t.isin("", *drop))
    exploded = df.select(*keep, F.explode(F.array_distinct(wanted)).alias(out))
    return exploded if keep_is_unique else exploded.distinct()
