"""Paths through the cluster's own file system client, and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_scratch: dict[str, str] = {}


def _fs(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def drop_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def create_empty(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.create(p, True).close()


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Matching paths, fully qualified, in name order."""
    fs, p = _fs(spark, pattern)
    found = fs.globStatus(p)
    return sorted(path.toString() for path in spark._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(found) or [])


def size_of(spark: SparkSession, paths: list[str]) -> int:
    """Stored bytes under the paths."""
    total = 0
    for path in paths:
        fs, p = _fs(spark, path)
        total += fs.getContentSummary(p).getLength()
    return total


def arrow_path(path: str):
    """The Arrow file system of a path or URI, and the path in it, for work outside the JVM."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


def first_line(spark: SparkSession, path: str) -> str | None:
    """First line of a file; reads no further than its first buffer."""
    fs, p = _fs(spark, path)
    jvm = spark._jvm
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        return reader.readLine()
    finally:
        stream.close()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own: on a
    cluster a machine-local folder would be lost with its executor.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="strataflow-")
    return _local_scratch[app]


def new_scratch(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"
