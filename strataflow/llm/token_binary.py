"""Token ids in binary files, document boundaries as Elias-Fano sequences.

A file holds whole documents: a header, the boundaries, the doc_ids, and all ids one after the other in 2 or 4 bytes. A boundary costs
2 + log2(ids / documents) bits. Files are written to the shared folder by the tasks; those that a committed
task reported count, whatever attempts that were lost left behind.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.bpe_text import Encoder
from strataflow.llm.common import rows_to_batches, stored, texts_of, width_for
from strataflow.sources.files import new_scratch

MAGIC = b"SFTOKEN1"
#: A file is closed once it has this many ids; a longer document has one of its own.
FILE_IDS = 4 << 20
_TEXTS = 256


class EliasFano:
    """A sequence that never falls: low bits packed, high bits in unary, every 64th one's place as a 32-bit step for select."""

    STEP = 64

    def __init__(self, count: int, low_bits: int, low: np.ndarray, high: np.ndarray, marks: np.ndarray):
        self.count, self.low_bits, self.low, self.high, self.marks = count, low_bits, low, high, marks

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n, top = len(values), int(values[-1]) if len(values) else 0
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        words = values.astype(np.uint64)
        low = ((words[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        ones = (words >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        high[ones] = 1
        return cls(n, bits, np.packbits(low.reshape(-1)), np.packbits(high), ones[:: cls.STEP].astype(np.uint32))

    def all(self) -> np.ndarray:
        ones = np.nonzero(np.unpackbits(self.high))[0][: self.count]
        low = np.unpackbits(self.low, count=self.count * self.low_bits).reshape(self.count, self.low_bits)
        return ((ones - np.arange(self.count)) << self.low_bits) + (low.astype(np.int64) << np.arange(self.low_bits)).sum(1)

    def select(self, i: int) -> int:
        """Value ``i`` alone: from the mark before it, over the high bits up to its one."""
        if not 0 <= i < self.count:
            raise IndexError(i)
        at, left = int(self.marks[i // self.STEP]), i % self.STEP
        while True:
            first = at // 8
            bits = np.unpackbits(self.high[first : first + 64])
            bits[: at - 8 * first] = 0
            ones = np.nonzero(bits)[0]
            if left < len(ones):
                one = 8 * first + int(ones[left])
                break
            left -= len(ones)
            at = 8 * (first + 64)
        a = i * self.low_bits
        low = np.unpackbits(self.low[a // 8 : (a + self.low_bits + 7) // 8])[a % 8 : a % 8 + self.low_bits]
        return ((one - i) << self.low_bits) + sum(int(b) << k for k, b in enumerate(low))

    def dump(self) -> bytes:
        head = struct.pack("<qiqqq", self.count, self.low_bits, self.low.nbytes, self.high.nbytes, self.marks.nbytes)
        return head + self.low.tobytes() + self.high.tobytes() + self.marks.tobytes()

    @classmethod
    def load(cls, data: memoryview, at: int) -> tuple[EliasFano, int]:
        count, bits, low, high, marks = struct.unpack_from("<qiqqq", data, at)
        at += struct.calcsize("<qiqqq")
        a, b, c = (np.frombuffer(data[x : x + n], t) for x, n, t in ((at, low, np.uint8), (at + low, high, np.uint8), (at + low + high, marks, np.uint32)))
        return cls(count, bits, a, b, c), at + low + high + marks


def dump_file(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """``doc_ids`` ascend, nulls first."""
    nulls = sum(d is None for d in doc_ids)
    known = np.array(doc_ids[nulls:], np.int64)
    base = int(known[0]) if len(known) else 0
    width = 2 if not len(ids) or ids.max() < 1 << 16 else 4
    head = MAGIC + struct.pack("<qqqq", width, nulls, base, len(ids))
    starts = EliasFano.of(np.concatenate([[0], np.cumsum(lengths)]))
    return head + starts.dump() + EliasFano.of(known - base).dump() + ids.astype(f"<u{width}").tobytes()


def load_file(data: bytes) -> tuple[list[int | None], EliasFano, np.ndarray]:
    if data[:8] != MAGIC:
        raise ValueError("not a token file")
    width, nulls, base, count = struct.unpack_from("<qqqq", data, 8)
    view = memoryview(data)
    starts, at = EliasFano.load(view, 40)
    known, at = EliasFano.load(view, at)
    return [None] * nulls + (known.all() + base).tolist(), starts, np.frombuffer(view[at:], f"<u{width}", count)


_MANIFEST = pa.schema([("part", pa.int64()), ("nth", pa.int64()), ("name", pa.string()), ("n_ids", pa.int64())])


def _write(folder: str, tokenizer: str, end_id: int):
    from pyarrow import fs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        encode, part = Encoder(tokenizer), TaskContext.get().partitionId()

        def close(nth: int, docs: list, lengths: list, pieces: list) -> tuple:
            ids, name = np.concatenate(pieces), f"{part:06d}-{nth:06d}-{uuid.uuid4().hex}.tok"
            with store.open_output_stream(f"{root}/{name}") as f:
                f.write(dump_file(docs, np.concatenate(lengths), ids))
            return part, nth, name, len(ids)

        def written() -> Iterator[tuple]:
            docs, lengths, pieces, held, nth = [], [], [], 0, 0
            for b in batches:
                for at in range(0, b.num_rows, _TEXTS):
                    texts = b.column(1).slice(at, _TEXTS).to_pylist()
                    ids, counts = encode(texts)
                    ends = np.cumsum(counts)
                    docs += b.column(0).slice(at, _TEXTS).to_pylist()
                    pieces.append(np.insert(ids, ends, end_id).astype(np.uint32))
                    lengths.append(counts + 1)
                    held += len(pieces[-1])
                    if held >= FILE_IDS:
                        yield close(nth, docs, lengths, pieces)
                        docs, lengths, pieces, held, nth = [], [], [], 0, nth + 1
            if docs:
                yield close(nth, docs, lengths, pieces)

        yield from rows_to_batches(written(), _MANIFEST)

    return run


def write(docs: DataFrame, tokenizer: str, end_id: int = 0) -> tuple[str, DataFrame]:
    """Encode all documents in ascending doc_id order (nulls first, rows with one id in any order), append
    ``end_id`` to each, write the files; returns their folder and the list of files with the ids before each."""
    spark = docs.sparkSession
    folder = new_scratch(spark, "tokens")
    uri = folder if "://" in folder else "file://" + folder.removeprefix("file:")
    jvm = spark._jvm.org.apache.hadoop.fs.Path(folder)
    jvm.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(jvm)
    n = width_for(docs)
    ordered = texts_of(docs).repartitionByRange(n, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first())
    files = stored(ordered.mapInArrow(_write(uri, tokenizer, end_id), "part long, nth long, name string, n_ids long"), "manifest")
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("ahead"))
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("nth")) - F.col("n_ids")
    return folder, files.join(before, "part").withColumn("first", F.col("ahead") + inside).select("name", "first", "n_ids")


_RESULT = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for b in batches:
            for first, content in zip(b.column(0), b.column(1), strict=True):
                docs, starts, ids = load_file(content.as_py())
                edges, first = starts.all().tolist(), first.as_py()
                for d, a, e in zip(docs, edges, edges[1:], strict=False):
                    yield d, first + a, e - a, zlib.crc32(ids[a:e].astype("<u4").tobytes())

    yield from rows_to_batches(rows(), _RESULT)


def read(folder: str, files: DataFrame) -> DataFrame:
    """One row per document from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    content = files.sparkSession.read.format("binaryFile").load(folder).select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    return content.join(files, "name").select("first", "content").mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def write_and_read(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """An empty table gives no files and no rows; an empty or null text is a document of its end id alone."""
    folder, files = write(docs, tokenizer, end_id)
    return read(folder, files)
