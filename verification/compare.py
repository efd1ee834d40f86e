"""Run queries and their SQL side by side: ``python -m verification.compare <sf_dir> [name…]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from strataflow.session import build_session
from verification.oracle import ORACLE
from verification.queries import QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, Decimal):
        return repr(float(value))
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, list):
        return tuple(_plain(v) for v in value)
    return repr(value)


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(spark: SparkSession, con, name: str, sf_dir: str) -> str | None:
    """None when both give the same columns and the same rows, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    result = con.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    ours, theirs = _rows(df.columns, df.collect()), _rows(columns, result.fetchall())
    if ours == theirs:
        return None
    only_ours, only_theirs = ours - theirs, theirs - ours
    return (
        f"{sum(ours.values())} rows against {sum(theirs.values())}; only Spark: "
        f"{list(only_ours)[:2]}; only SQL: {list(only_theirs)[:2]}"
    )


def main(sf_dir: str, names: list[str]) -> int:
    spark = build_session("verification", "local[8]", {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    for name in names or QUERIES:
        started = time.monotonic()
        if name not in ORACLE:
            print(f"rows only {name}: {QUERIES[name](spark, sf_dir).count()}", flush=True)
            continue
        problem = differences(spark, con, name, sf_dir)
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.monotonic() - started:.1f}s {problem or ''}", flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
