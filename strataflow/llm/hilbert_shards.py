"""Shards along a Hilbert curve through document metadata: runs of equal length, each compact in every dimension.

Only DataFrame functions. Each dimension is quantised to ``2**BITS`` levels that keep its order: a number by quantiles, text by the rank of its value
among the distinct ones. The levels make a cell; a table of all cells (``2**(BITS * dimensions)`` rows, whatever the input) has each one's index on the
curve. Rows are dealt by ranges of (index, doc_id, place in the scan) and sorted, so that a hot cell or id is split. A row's position is its place in its
partition plus the rows of the partitions before; no task sees more than its own range, or a row per partition. Shard ``s`` of ``n`` starts at position
``ceil(s * rows / n)``: the law is ``rows``, counts differ by one at most. A shard holds narrow ranges of every dimension, so a reader
needs few of them (``extents``, ``shards_meeting``).

Null text has no bytes and the crc32 of empty text; null lang and source come before all others. Repeated rows and rows without doc_id are each
placed. An empty table gives no rows. ``grown_shard`` is null: under the law ``rows`` another shard moves most rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataflow.llm.common import stored, width_for

SHARDS, BITS, HEADER = 24, 5, 8
TEXT_DIMENSIONS, NUMBER_DIMENSIONS = ("lang", "source"), ("size",)
_PLACE_BITS = 33  # monotonically_increasing_id keeps the place in the partition in its low 33 bits, a fixed value


def _bit(x: Column, q: Column) -> Column:
    return x.bitwiseAND(q) != 0


def curve(spark: SparkSession, dimensions: int, bits: int = BITS) -> DataFrame:
    """(cell, index) of every cell; a cell is its levels one after the other, ``bits`` bits each, the first dimension highest.

    The index comes from its transposed form: from the highest bit on, an axis with the bit set inverts the first axis below that bit, any other
    swaps those bits with it; then the axes are Gray coded and their bits interleaved.
    """
    cells = spark.range(1 << (bits * dimensions)).select(F.col("id").alias("cell"))
    levels = [F.shiftright("cell", bits * (dimensions - 1 - i)).bitwiseAND(F.lit((1 << bits) - 1)).cast("int") for i in range(dimensions)]
    pairs = lambda lowest: [F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i")) for b in range(bits - 1, lowest - 1, -1) for i in range(dimensions)]

    def turn(x: Column, step: Column) -> Column:
        below, i = step["q"] - 1, step["i"]
        swap = x[0].bitwiseXOR(x[i]).bitwiseAND(below)
        inverted = F.transform(x, lambda v, j: F.when(j == 0, v.bitwiseXOR(below)).otherwise(v))
        swapped = F.transform(x, lambda v, j: F.when((j == 0) | (j == i), v.bitwiseXOR(swap)).otherwise(v))
        return F.when(_bit(x[i], step["q"]), inverted).otherwise(swapped)

    df = cells.withColumn("x", F.array(*levels))
    if bits > 1:
        df = df.withColumn("x", F.aggregate(F.array(*pairs(1)), F.col("x"), turn))
    df = df.withColumn("x", F.transform("x", lambda v, j: F.aggregate(F.slice("x", 1, j + 1), F.lit(0), lambda a, b: a.bitwiseXOR(b))))
    masks = F.array(*[F.lit(1 << b) for b in range(bits - 1, 0, -1)], F.lit(1))
    flip = F.aggregate(masks, F.lit(0), lambda a, q: F.when(_bit(F.element_at("x", -1), q), a.bitwiseXOR(q - 1)).otherwise(a))
    df = df.withColumn("flip", flip).withColumn("x", F.transform("x", lambda v: v.bitwiseXOR(F.col("flip"))))
    index = F.aggregate(F.array(*pairs(0)), F.lit(0).cast("long"), lambda a, p: a * 2 + F.when(_bit(F.col("x")[p["i"]], p["q"]), 1).otherwise(0))
    return df.select("cell", index.alias("index"))


def positions(df: DataFrame, order: Sequence[str], label: str, tasks: int) -> DataFrame:
    """``df``, stored, with each row's gapless ``position`` in the given order and the number of all ``rows``. Rows equal in ``order`` stand in any order."""
    ordered = df.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    placed = stored(ordered.withColumn("_part", F.shiftright(place, _PLACE_BITS)).withColumn("_at", place.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))), label)
    parts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    before = parts.select(
        "_part", (F.sum("n").over(Window.orderBy("_part")) - F.col("n")).alias("_before"), F.sum("n").over(Window.partitionBy()).alias("rows")
    )
    joined = placed.join(before, "_part")
    return joined.withColumn("position", F.col("_before") + F.col("_at")).drop("_part", "_at", "_before")


def _text_levels(df: DataFrame, column: str, bits: int) -> DataFrame:
    """The level of each distinct value of a text column, by its rank."""
    ranked = positions(df.select(column).distinct(), [column], f"{column}-ranks", width_for(df))
    return ranked.select(F.col(column).alias("_value"), F.expr(f"position * {1 << bits} div rows").alias("_level"))


def _level(x: Column, edges: Sequence[float]) -> Column:
    """How many edges are below; none for null."""
    return F.size(F.filter(F.array(*map(F.lit, edges)).cast("array<double>"), lambda e: e < x))


def with_index(df: DataFrame, texts: Sequence[str], numbers: Sequence[str], bits: int = BITS) -> DataFrame:
    """``df`` with ``curve_index``, from the levels of its columns; null is a value of its own, before all others."""
    base, levels = df, []
    for k, column in enumerate(texts):
        known = _text_levels(base, column, bits).withColumnRenamed("_level", f"_level_{k}")
        df = df.join(known, df[column].eqNullSafe(known["_value"]), "left").drop("_value")
        levels.append(F.col(f"_level_{k}"))
    if numbers:
        shares = F.array(*[F.lit(k / (1 << bits)) for k in range(1, 1 << bits)])
        edges = df.agg(*[F.percentile_approx(c, shares, 10_000).alias(c) for c in numbers]).first()
        for c in numbers:
            levels.append(_level(F.col(c), edges[c] or []))
    cell = F.lit(0).cast("long")
    for level in levels:
        cell = cell * (1 << bits) + level
    cells = curve(df.sparkSession, len(levels), bits).withColumnRenamed("index", "curve_index")
    out = df.withColumn("cell", cell).join(F.broadcast(cells), "cell")
    return out.drop("cell", *[f"_level_{k}" for k in range(len(texts))])


def placed(df: DataFrame, shards: int = SHARDS, texts: Sequence[str] = TEXT_DIMENSIONS, numbers: Sequence[str] = NUMBER_DIMENSIONS, key: str = "doc_id") -> DataFrame:
    """All columns of a stored frame with ``curve_index``, ``shard`` and ``slot``, the place in the shard. ``row`` is kept for ties, by place in the scan."""
    indexed = with_index(df.withColumn("_row", F.monotonically_increasing_id()), texts, numbers)
    every = positions(indexed, ["curve_index", key, "_row"], "shards", width_for(df)).drop("_row")
    shard = F.expr(f"CAST(position * {shards} div rows AS int)")
    first = F.expr(f"(shard * rows + {shards - 1}) div {shards}")
    return every.withColumn("shard", shard).withColumn("slot", F.col("position") - first).drop("position", "rows")


def slim(docs: DataFrame) -> DataFrame:
    """What decides a document's place, without its text; stored, so that texts are read once."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), "lang", "source", (F.length(text) + HEADER).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
        ),
        "slim",
    )


def shards_of(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document."""
    return placed(slim(docs), shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def write(docs: DataFrame, path: str, shards: int = SHARDS) -> DataFrame:
    """Write whole documents, a folder per shard, rows in order of the curve; returns the shards' extents. A column ``size`` is added if there is none.
    ``docs`` must be stored, as it is read more than once."""
    if "size" not in docs.columns:
        docs = docs.withColumn("size", F.length(F.coalesce(F.col("text"), F.lit("")).cast("binary")).cast("long") + HEADER)
    every = placed(docs, shards).drop("curve_index", "slot")
    every.write.partitionBy("shard").parquet(path)
    return extents(docs.sparkSession.read.parquet(path))


def extents(written: DataFrame, columns: Sequence[str] = (*TEXT_DIMENSIONS, *NUMBER_DIMENSIONS)) -> DataFrame:
    """A row per shard: least and greatest value of each column, and whether it holds null."""
    found = [(F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"), F.max(F.col(c).isNull()).alias(f"null_{c}")) for c in columns]
    return written.groupBy("shard").agg(*[x for three in found for x in three])


def shards_meeting(known: DataFrame, **ranges: tuple) -> DataFrame:
    """The shards that can hold rows with each column within its (low, high), ends included."""
    for column, (low, high) in ranges.items():
        known = known.where((F.col(f"max_{column}") >= low) & (F.col(f"min_{column}") <= high))
    return known.select("shard")
