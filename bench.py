"""Times the five bronze-to-silver jobs and the gold marts; prints one JSON line.

``BENCH_SF_DIR`` names the folder of given tables, ``BENCH_CPUS`` the cores. The
bronze tables are written before the clock starts. A silver job is a whole run:
read what is new, clean, deduplicate, write, register. A mart is timed alone, from
the stored silver tables to its last row; ``gold_build`` is all of them stored.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import SparkSession

from strataflow.plans.build import build, resolver, silver_tables
from strataflow.plans.entities import ENTITIES
from strataflow.plans.gold import MODELS, in_order
from strataflow.plans.incremental import run_incremental
from strataflow.session import apply_defaults, build_session
from strataflow.sources import shapes
from strataflow.sources.versions import write_version


def timed(action: Callable[[], object]) -> float:
    started = time.monotonic()
    action()
    return round(time.monotonic() - started, 3)


def session(cpus: str, work: str) -> SparkSession:
    conf = {
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": cpus,
        "spark.sql.warehouse.dir": f"{work}/warehouse",
    }
    spark = build_session("strataflow-bench", f"local[{cpus}]", conf)
    spark.sparkContext.setLogLevel("ERROR")
    return apply_defaults(spark)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = session(cpus, base)
    rows, seconds = {}, {}
    for entity in ENTITIES.values():
        raw = shapes.SILVER_INPUTS[entity.name](spark, sf_dir)
        write_version(raw.repartition(int(cpus)), entity.bronze_path(base), 0)
        rows[entity.name] = spark.read.parquet(entity.bronze_path(base)).count()
    for entity in ENTITIES.values():
        seconds[f"silver_{entity.name}"] = timed(lambda e=entity: run_incremental(spark, e, base))
    for name, model in MODELS.items():
        if model.stored:
            df = in_order(name, resolver(silver_tables(spark, base))(name))
            seconds[name] = timed(lambda d=df: d.write.format("noop").mode("overwrite").save())
    seconds["gold_build"] = timed(lambda: build(spark, base, "tag:gold"))
    spark.stop()
    line = {
        "metric": "bronze_to_silver_to_gold_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "rows": rows,
        "rows_per_sec": {n: round(r / seconds[f"silver_{n}"]) for n, r in rows.items()},
        "cpus": int(cpus),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent))
    main()
