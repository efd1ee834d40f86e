"""The tail of growing CSV files as a streaming source.

``csv_tail_stream`` reads a folder of ``*.csv`` files that other programs append to. The offset of a batch is how many bytes of
each file are taken, always up to the end of a line, so it is stored with the batch in the query's checkpoint: rows and offsets
can't come apart, and a batch that is run again reads the same bytes. A batch reads only what was added, in splits of
``splitBytes``; the driver looks at the listing and at the last block of files that grew.

Rows come as ``file_path``, ``row_start`` (the byte at which the row begins, which names it within its file) and ``values``, whatever columns a file has.
With ``multiLine`` quoted values may hold line breaks; what was added to a file is then one split, and the driver reads it once to find the last whole row.
A file that became shorter than what is taken of it is not read until it is longer again.
"""

from __future__ import annotations

import csv
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "file_path string, row_start bigint, `values` array<string>"
BLOCK = 1 << 20
_BATCH_ROWS = 10_000
_ARROW = pa.schema([("file_path", pa.string()), ("row_start", pa.int64()), ("values", pa.list_(pa.string()))])


def _open(path: str):
    """The file system of a path or URI, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


@dataclass
class Split(InputPartition):
    """Rows that begin in [start, stop); ``exact`` if one begins at ``start``. ``end`` is where the batch ends."""

    path: str
    start: int
    stop: int
    end: int
    exact: bool
    header: bool
    multiline: bool


def _blocks_back(f, size: int) -> Iterator[tuple[int, bytes]]:
    while size > 0:
        start = max(0, size - BLOCK)
        f.seek(start)
        yield start, f.read(size - start)
        size = start


def last_line_end(f, size: int) -> int:
    """The byte after the last line break before ``size``, 0 if there is none."""
    for start, block in _blocks_back(f, size):
        at = block.rfind(b"\n")
        if at >= 0:
            return start + at + 1
    return 0


def last_row_end(f, start: int, size: int) -> int:
    """The byte after the last line break outside quotes; a row begins at ``start``."""
    end, quotes = start, 0
    f.seek(start)
    while start < size:
        block = f.read(min(BLOCK, size - start))
        at = 0
        while (found := block.find(b"\n", at)) >= 0:
            quotes += block.count(b'"', at, found)
            if quotes % 2 == 0:
                end = start + found + 1
            at = found + 1
        quotes += block.count(b'"', at)
        start += len(block)
    return end


def _lines(f, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """The lines of [start, end) with where they begin, line breaks kept."""
    f.seek(start)
    rest, at, read = b"", start, start
    while read < end:
        block = f.read(min(BLOCK, end - read))
        if not block:
            break
        read += len(block)
        *whole, rest = (rest + block).split(b"\n")
        for line in whole:
            yield at, line + b"\n"
            at += len(line) + 1
    if rest:
        yield at, rest


def _rows(split: Split, f) -> Iterator[tuple[int, list[str]]]:
    start = split.start
    if not split.exact:
        # The line that holds the byte before the split belongs to the split before.
        for at, line in _lines(f, start - 1, split.end):
            start = at + len(line)
            break
    if split.multiline:
        begun: list[int] = []

        def texts() -> Iterator[str]:
            for at, line in _lines(f, start, split.end):
                begun.append(at)
                yield line.decode(errors="replace")

        reader = csv.reader(texts())
        while True:
            begun.clear()
            row = next(reader, None)
            if row is None:
                return
            if row:
                yield begun[0], row
    for at, line in _lines(f, start, split.end):
        if at >= split.stop:
            return
        text = line.decode(errors="replace").rstrip("\r\n")
        if text:
            yield at, next(csv.reader([text]))


class CsvTailReader(DataSourceStreamReader):
    def __init__(self, options):
        self.base = options["path"].rstrip("/")
        self.multiline = str(options.get("multiLine", "false")).lower() == "true"
        self.split_bytes = int(options.get("splitBytes", 64 << 20))
        self.taken: dict[str, int] = {}

    def initialOffset(self) -> dict:
        return {}

    def _files(self) -> Iterator[tuple[str, int]]:
        from pyarrow import fs

        store, root = _open(self.base)
        for info in store.get_file_info(fs.FileSelector(root, allow_not_found=True)):
            if info.is_file and info.base_name.endswith(".csv") and not info.base_name.startswith(("_", ".")):
                yield info.base_name, info.size

    def latestOffset(self) -> dict:
        store, root = _open(self.base)
        for name, size in self._files():
            known = self.taken.get(name, 0)
            if size > known:
                with store.open_input_file(f"{root}/{name}") as f:
                    end = last_row_end(f, known, size) if self.multiline else last_line_end(f, size)
                self.taken[name] = max(known, end)
        return dict(self.taken)

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        splits = []
        for name, stop in sorted(end.items()):
            first = start.get(name, 0)
            step = max(stop - first, 1) if self.multiline else self.split_bytes
            for at in range(first, stop, step):
                splits.append(Split(f"{self.base}/{name}", at, min(at + step, stop), stop, at == first, at == 0, self.multiline))
        return splits

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        store, path = _open(partition.path)
        with store.open_input_file(path) as f:
            starts, values = [], []
            rows = _rows(partition, f)
            if partition.header:
                next(rows, None)
            for at, row in rows:
                starts.append(at)
                values.append(row)
                if len(starts) == _BATCH_ROWS:
                    yield self._batch(partition.path, starts, values)
                    starts, values = [], []
            if starts:
                yield self._batch(partition.path, starts, values)

    @staticmethod
    def _batch(path: str, starts: list[int], values: list[list[str]]) -> pa.RecordBatch:
        columns = [[path] * len(starts), starts, values]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)


class CsvTail(DataSource):
    @classmethod
    def name(cls) -> str:
        return "csv_tail"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> CsvTailReader:
        return CsvTailReader(self.options)


# Tasks get this module with the reader, so it need not be installed where they run.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def csv_tail_stream(spark: SparkSession, base: str, multiline: bool = False, split_bytes: int = 64 << 20) -> DataFrame:
    """``file_path, row_start, values`` of every whole row of the ``*.csv`` files under ``base``, headers left out, as the files grow."""
    spark.dataSource.register(CsvTail)
    reader = spark.readStream.format("csv_tail").option("multiLine", str(multiline)).option("splitBytes", str(split_bytes))
    return reader.load(base)
