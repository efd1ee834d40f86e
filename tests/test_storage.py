from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strataflow.sources import bronze, catalog, files, jdbc, versions
from tests.conftest import plan_of, rows


def numbers(spark, *ids, v="a"):
    return spark.createDataFrame([(i, v) for i in ids], "k int, v string")


def test_versions_and_incremental_reads(spark, base):
    assert versions.latest_version(spark, base) is None
    versions.write_version(numbers(spark, 1), base, 0)
    versions.write_version(numbers(spark, 2), base, 3)
    assert versions.committed_versions(spark, base) == [0, 3]
    assert versions.next_version(spark, base) == 4
    assert rows(versions.read_since(spark, base)) == [(1, "a"), (2, "a")]
    assert rows(versions.read_since(spark, base, snapshot="latest")) == [(2, "a")]
    assert rows(versions.read_since(spark, base, 0)) == [(2, "a")]
    with pytest.raises(ValueError, match="no committed version"):
        versions.read_since(spark, base, 3)


def test_a_version_without_marker_does_not_exist(spark, base):
    versions.write_version(numbers(spark, 1), base, 0)
    versions.write_version(numbers(spark, 2), base, 1)
    os.remove(f"{base}/_version=1/_SUCCESS")
    assert versions.latest_version(spark, base) == 0
    assert rows(versions.read_since(spark, base)) == [(1, "a")]


def test_a_repeated_write_replaces_the_version(spark, base):
    versions.write_version(numbers(spark, 1, 2), base, 0)
    versions.write_version(numbers(spark, 3), base, 0)
    assert rows(versions.read_since(spark, base)) == [(3, "a")]


def test_columns_added_later(spark, base):
    versions.write_version(numbers(spark, 1), base, 0)
    versions.write_version(numbers(spark, 2).withColumn("w", F.lit("new")), base, 1)
    assert rows(versions.read_since(spark, base)) == [(1, "a", None), (2, "a", "new")]
    assert rows(versions.read_since(spark, base, schema="w string, k int")) == [("new", 2), (None, 1)]


def test_merge_inserts_only(spark, base):
    keys = ["k"]
    versions.insert_only_merge(numbers(spark, 1, 2), base, keys, 0)
    versions.insert_only_merge(numbers(spark, 2, 3, v="changed"), base, keys, 1)
    expected = [(1, "a"), (2, "a"), (3, "changed")]
    assert rows(versions.read_since(spark, base)) == expected
    # The same version again, as after a failure: nothing doubles, nothing is lost.
    versions.insert_only_merge(numbers(spark, 2, 3, v="changed"), base, keys, 1)
    assert rows(versions.read_since(spark, base)) == expected


def test_merge_always_inserts_null_keys_and_appends_without_keys(spark, base):
    versions.insert_only_merge(numbers(spark, None), base, ["k"], 0)
    versions.insert_only_merge(numbers(spark, None), base, ["k"], 1)
    assert versions.read_since(spark, base).count() == 2
    versions.insert_only_merge(numbers(spark, 1), f"{base}/append", [], 0)
    versions.insert_only_merge(numbers(spark, 1), f"{base}/append", [], 1)
    assert versions.read_since(spark, f"{base}/append").count() == 2


def test_merge_bound_narrows_the_target_without_changing_the_result(spark, base):
    def batch(low, high):
        df = spark.range(low, high).select(F.col("id").cast("int").alias("k"), F.date_add(F.lit("2024-01-01"), F.col("id").cast("int")).alias("d"))
        return df.withColumn("at", F.col("d").cast("timestamp"))

    schema = "k int, d date, at timestamp"
    for path, bound in ((f"{base}/bound", ("at", "d")), (f"{base}/free", ())):
        versions.insert_only_merge(batch(0, 40), path, ["k", "at"], 0, ["d"], bound, schema)
        versions.insert_only_merge(batch(30, 60), path, ["k", "at"], 1, ["d"], bound, schema)
        versions.insert_only_merge(batch(0, 0), path, ["k", "at"], 2, ["d"], bound, schema)
    result = versions.read_since(spark, f"{base}/bound", schema=schema)
    assert rows(result) == rows(versions.read_since(spark, f"{base}/free", schema=schema))
    assert result.count() == 60
    target = versions.read_versions(spark, f"{base}/bound", [0], schema)
    narrowed = versions._within_batch_range(batch(30, 60), target, ("at", "d"))
    plan = plan_of(narrowed)
    assert "GreaterThanOrEqual(at" in plan and "dynamicpruning" not in plan
    assert narrowed.count() == 10


def test_small_batch_leaves_a_large_target_unshuffled(spark, base):
    versions.write_version(numbers(spark, 1, 2), f"{base}/batch", 0)
    spark.range(0, 200_000).select(F.col("id").cast("int").alias("k"), F.lit("a").alias("v")).write.parquet(f"{base}/target")
    batch = versions.read_since(spark, f"{base}/batch", schema="k int, v string")
    target = spark.read.parquet(f"{base}/target")
    plan = plan_of(versions.new_rows(batch, target, ["k"]))
    assert plan.count("BroadcastHashJoin") == 2 and "Exchange hashpartitioning" not in plan


def test_hot_day_is_written_by_several_tasks_in_tight_ranges(spark, base):
    hot = spark.range(0, 9_000).select(
        "id", F.when(F.col("id") % 3 == 0, F.date_add(F.lit("2024-01-01"), (F.col("id") % 30).cast("int"))).alias("d")
    )
    versions.write_version(hot, base, 0, ["d", "id"], tasks=6)
    read = versions.read_since(spark, base, schema="id bigint, d date")
    assert rows(read) == rows(hot)
    by_file = spark.read.parquet(base).groupBy(F.input_file_name().alias("f")).agg(
        F.countDistinct("d").alias("days"), F.max(F.col("d").isNull()).alias("hot"), F.count("*").alias("n")
    ).collect()
    assert sum(r.hot for r in by_file) > 1 and max(r.n for r in by_file) < 3_000


def test_one_late_row_does_not_open_the_time_between(spark, base):
    days = spark.range(0, 4_000).select(F.col("id").alias("k"), F.date_add(F.lit("2010-01-01"), F.col("id").cast("int")).alias("d"))
    versions.insert_only_merge(days, base, ["k", "d"], 0, order_by=["d", "k"], tasks=8)
    late = "k >= 3990 or k = 5"
    batch = days.where(late).unionAll(days.where("k = 3999").selectExpr("k + 1", "date_add(d, 1)"))
    batch.write.parquet(f"{base}-batch")
    batch = spark.read.parquet(f"{base}-batch")
    stretches = versions.day_stretches(batch, "d")
    assert [str(a) for a, _ in stretches] == ["2010-01-06", "2020-12-04"]
    target = versions._within_batch_range(batch, versions.read_since(spark, base, schema="k bigint, d date"), ["d"])
    assert target.count() == 11 and "Or(And(GreaterThanOrEqual(d" in plan_of(target).replace(" ", "")
    versions.insert_only_merge(batch, base, ["k", "d"], 1, bound=["d"], schema="k bigint, d date")
    assert versions.read_since(spark, base, schema="k bigint, d date").count() == 4_001


def test_registered_table_follows_versions_and_columns(spark, base):
    schema = StructType.fromDDL("k int, v string")
    for n in range(2):
        versions.write_version(numbers(spark, n), base, n)
        catalog.register_table(spark, "reg.plain", base, schema)
    assert rows(spark.table("reg.plain")) == [(0, "a", 0), (1, "a", 1)]
    versions.write_version(numbers(spark, 2).withColumn("w", F.lit("x")), base, 2)
    catalog.register_table(spark, "reg.plain", base, StructType.fromDDL("k int, v string, w string"))
    assert spark.table("reg.plain").columns == ["k", "v", "w", "_version"]
    assert spark.table("reg.plain").count() == 3


def test_catalog_leaves_out_uncommitted_versions(spark, base):
    schema = StructType.fromDDL("k int, v string")
    for n in range(3):
        versions.write_version(numbers(spark, n), base, n)
    os.remove(f"{base}/_version=1/_SUCCESS")
    catalog.register_table(spark, "reg.whole", base, schema)
    catalog.register_table(spark, "reg.named", base, schema)
    catalog.register_table(spark, "reg.named", base, schema, [1, 2])
    for table in ("reg.whole", "reg.named"):
        assert rows(spark.table(table).select("k")) == [(0,), (2,)]


def test_snapshot_moves_without_a_gap(spark, base, monkeypatch):
    for n in range(2):
        versions.write_version(numbers(spark, n), base, n)
        catalog.register_snapshot(spark, "reg.moved", base, n)
        assert rows(spark.table("reg.moved")) == [(n, "a")]
    versions.write_version(numbers(spark, 5).withColumn("w", F.lit(1)), base, 2)
    catalog.register_snapshot(spark, "reg.moved", base, 2)
    assert spark.table("reg.moved").columns == ["k", "v", "w"]


def test_checkpoint_property(spark, base):
    assert catalog.get_checkpoint(spark, "reg.none") is None
    versions.write_version(numbers(spark, 1), base, 0)
    catalog.register_table(spark, "reg.checked", base, StructType.fromDDL("k int, v string"))
    assert catalog.get_checkpoint(spark, "reg.checked") is None
    catalog.set_checkpoint(spark, "reg.checked", 7)
    assert catalog.get_checkpoint(spark, "reg.checked") == 7


def test_bronze_load_replaces_content_and_schema(spark, base):
    assert bronze.load_to_bronze(spark, numbers(spark), "t", base) is None
    path = bronze.load_to_bronze(spark, numbers(spark, 1), "t", base)
    wider = numbers(spark, 2).withColumn("w", F.lit(1))
    assert bronze.ingest_table(spark, "raw.t", base, extract=lambda s, table: wider) == path
    table = spark.table("bronze.t")
    assert table.columns == ["k", "v", "w", "_ingestion_timestamp", "_source"]
    assert [r["k"] for r in table.collect()] == [2]
    assert versions.committed_versions(spark, path) == [0, 1]


def test_ingest_needs_a_table_and_a_source(spark, base):
    for table in (None, ""):
        with pytest.raises(ValueError):
            bronze.ingest_table(spark, table, base)
    with pytest.raises(ValueError, match="source"):
        bronze.ingest_table(spark, "raw.t", base)


def test_jdbc_options():
    source = jdbc.JdbcSource.postgres("db", "movies", user="u", password="secret", properties={"ssl": "true"})
    assert source.options() == {
        "url": "jdbc:postgresql://db:5432/movies",
        "driver": "org.postgresql.Driver",
        "fetchsize": "1000",
        "user": "u",
        "password": "secret",
        "ssl": "true",
    }
    assert "secret" not in repr(source)
    assert jdbc.range_options("id", 1, 9, 4) == {
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "9", "numPartitions": "4",
    }
    assert "table_schema = 'raw'" in jdbc.discovery_query()
    assert jdbc.bounds_query("raw.t", "id") == "SELECT MIN(id) AS low, MAX(id) AS high FROM raw.t"


class Reader:
    """Records how a JDBC read is put together; there is no database to ask."""

    def __init__(self, log, answers):
        self.log, self.answers, self.set = log, answers, {}

    def format(self, name):
        return self

    def options(self, **options):
        self.set.update(options)
        return self

    def option(self, name, value):
        return self.options(**{name: value})

    def load(self):
        self.log.append(self.set)
        return self.answers[len(self.log) - 1]


class ReaderSession:
    def __init__(self, *answers):
        self.log, self.answers = [], answers

    @property
    def read(self):
        return Reader(self.log, self.answers)


def test_jdbc_reads(spark):
    source = jdbc.JdbcSource("jdbc:x")
    plain = ReaderSession("rows")
    assert jdbc.extract_table(plain, source, "raw.t") == "rows"
    assert plain.log[0]["dbtable"] == "raw.t" and "partitionColumn" not in plain.log[0]

    bounds = spark.createDataFrame([(1, 9)], "low int, high int")
    ranged = ReaderSession(bounds, "rows")
    assert jdbc.extract_table(ranged, source, "raw.t", "id", 4) == "rows"
    assert "dbtable" not in ranged.log[0] and "query" not in ranged.log[1]
    assert ranged.log[1]["lowerBound"] == "1" and ranged.log[1]["numPartitions"] == "4"

    empty = ReaderSession(spark.createDataFrame([(None, None)], "low int, high int"), "rows")
    jdbc.extract_table(empty, source, "raw.t", "id", 4)
    assert "partitionColumn" not in empty.log[1]

    found = spark.createDataFrame([("raw.b",), ("raw.a",)], "full_name string")
    assert jdbc.discover_tables(ReaderSession(found), source) == ["raw.a", "raw.b"]
    with pytest.raises(ValueError, match="no tables"):
        jdbc.discover_tables(ReaderSession(found.limit(0)), source)


class Session:
    """Just the settings ``scratch_root`` looks at."""

    def __init__(self, master, checkpoint_dir=None):
        self.conf = {"spark.checkpoint.dir": checkpoint_dir} if checkpoint_dir else {}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": f"app-{master}"})


def test_scratch_is_the_named_folder_and_local_only_without_one(spark):
    assert files.scratch_root(Session("yarn", "s3a://shared/cp/")) == "s3a://shared/cp"
    with pytest.raises(RuntimeError, match="checkpoint"):
        files.scratch_root(Session("yarn"))
    local = files.scratch_root(Session("local[2]"))
    assert os.path.isdir(local) and files.scratch_root(Session("local[2]")) == local
    first = files.new_scratch(spark, "x")
    assert os.path.dirname(first) == files.scratch_root(spark) and first != files.new_scratch(spark, "x")


def test_globs(spark, tmp_path):
    for name in ("b, c", "a", "x=1, y=2"):
        (tmp_path / name).mkdir()
    assert [p.rsplit("/", 1)[1] for p in files.glob_paths(spark, f"{tmp_path}/*")] == ["a", "b, c", "x=1, y=2"]
    assert files.glob_paths(spark, f"{tmp_path}/none*") == [] == files.glob_paths(spark, f"{tmp_path}/none/x")
