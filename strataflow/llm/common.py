"""What the operators share: reading, shared scratch tables, Arrow batches, packed columns."""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.sources.files import new_scratch

#: Rows of a batch made here, so that none grows with its partition.
BATCH_ROWS = 2_000
#: Stored bytes of input that one task of a shuffle takes.
TASK_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str, release: bool = False) -> DataFrame:
    """Write to the shared scratch folder and read again: cuts the lineage, survives lost executors.

    ``release``: the write's shuffle files go when it ends, not only once the driver happens to collect garbage.
    """
    spark, path = df.sparkSession, new_scratch(df.sparkSession, label)
    before = spark.conf.get(_RELEASE, None)
    if release:
        spark.conf.set(_RELEASE, "true")
    try:
        df.write.parquet(path)
    finally:
        if release:
            spark.conf.unset(_RELEASE) if before is None else spark.conf.set(_RELEASE, before)
    return spark.read.schema(df.schema).parquet(path)


def texts_of(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, with null texts as empty ones; any other column stays behind."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def crc_fold(column: Column, folds: int = 5) -> Column:
    """crc32 of the value's decimal text, modulo ``folds``; null for null."""
    return F.crc32(column.cast("string").cast("binary")) % folds


def rows_to_batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Tuples in the order of the schema, as batches of at most ``BATCH_ROWS`` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= BATCH_ROWS:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def map_texts(docs: DataFrame, row: Callable[[str], tuple], schema: str, arrow: pa.Schema, prepare=None) -> DataFrame:
    """One result row for each document: its id, then what ``row`` makes of its text.

    ``prepare``, if given, is called once in each task and returns ``row``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = prepare() if prepare else row
        yield from rows_to_batches(
            ((d, *work(t)) for b in batches for d, t in zip(b.column(0).to_pylist(), _texts(b.column(1)), strict=True)), arrow
        )

    return texts_of(docs).mapInArrow(run, schema)


def _texts(column: pa.Array) -> Iterator[str]:
    """One text at a time, so that a batch is not held twice."""
    for value in column:
        yield value.as_py()


def pack(*arrays: np.ndarray | bytes, level: int = 1) -> bytes:
    """Arrays or byte strings as one compressed value."""
    raw = [a if isinstance(a, bytes) else np.ascontiguousarray(a).tobytes() for a in arrays]
    head = struct.pack(f"<{len(raw) + 1}q", len(raw), *map(len, raw))
    return zstandard.ZstdCompressor(level=level).compress(head + b"".join(raw))


def unpack(blob: bytes, *dtypes) -> list:
    """What ``pack`` was given; ``bytes`` stays bytes, any other type is an array's."""
    data = zstandard.ZstdDecompressor().decompress(blob)
    (count,) = struct.unpack_from("<q", data)
    sizes = struct.unpack_from(f"<{count}q", data, 8)
    at, out = 8 * (count + 1), []
    for size, dtype in zip(sizes, dtypes, strict=True):
        piece = data[at : at + size]
        out.append(piece if dtype is bytes else np.frombuffer(piece, dtype))
        at += size
    return out


def planes(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of unsigned words, each byte's plane by itself, which compresses better."""
    words = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)
    return np.ascontiguousarray(words[:, :width].T).tobytes()


def from_planes(data: bytes, width: int) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(width, -1)
    words = np.zeros((raw.shape[1], 8), np.uint8)
    words[:, :width] = raw.T
    return words.reshape(-1).view("<u8")


def bit_planes(values: np.ndarray, bits: int) -> bytes:
    """The low ``bits`` bits of unsigned words: planes of whole bytes, then planes of single bits."""
    whole = bits // 8
    rest = [np.packbits(((values >> np.uint64(k)) & np.uint64(1)).astype(np.uint8)).tobytes() for k in range(8 * whole, bits)]
    return b"".join([planes(values, whole), *rest])


def from_bit_planes(data: bytes, bits: int, count: int) -> np.ndarray:
    whole = bits // 8
    words = from_planes(data[: whole * count], whole).copy() if whole else np.zeros(count, np.uint64)
    at, size = whole * count, -(-count // 8)
    for k in range(8 * whole, bits):
        words |= np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=count).astype(np.uint64) << np.uint64(k)
        at += size
    return words


def input_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of the frame's size, which for a plain scan is the size of its files.

    Where Catalyst knows nothing it says so by a number beyond any table; the session's shuffle width stands in then.
    """
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size if size < 1 << 60 else TASK_BYTES * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def width_for(df: DataFrame, per_task: int = TASK_BYTES) -> int:
    """Partitions for a shuffle that carries about as much as ``df``: ``per_task`` bytes in each, and one per core at least."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(cores, -(-input_bytes(df) // per_task))
