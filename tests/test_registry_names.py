from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from strataflow.sources import registry
from tests.conftest import rows

SCHEMA = "first string, wanted string, columns array<string>"


def one_by_one(lists, known):
    """Names handed out in order, each list taking the first that is free."""
    taken, out = set(known), []
    for _, wanted, columns in sorted(lists):
        name, n = wanted, 0
        while name in taken:
            n += 1
            name = f"{wanted}_{n}"
        taken.add(name)
        out.append((name, columns))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_names_are_those_handed_out_one_by_one(spark, seed):
    rng = random.Random(seed)
    wanted = ["a", "a_1", "a_1_1", "a_2", "a_01", "b", "_1", "", "a_1_2"][: rng.choice([3, 6, 9])]
    lists = [(f"{i:04d}", rng.choice(wanted), [f"c{i}"]) for i in rng.sample(range(1000), 60)]
    known = rng.sample(["a", "a_1", "a_3", "b_2", "a_1_1", "a_2_1", "zz", "_1_1"], rng.choice([0, 3, 6]))
    registered = spark.createDataFrame([("f", n, ["k", n]) for n in known], "file_path string, schema_name string, columns array<string>")
    named = registry.name_schemas(spark.createDataFrame(lists, SCHEMA), registered if known else None)
    assert rows(named.select("schema_name", "columns")) == one_by_one(lists, known)


def test_many_lists_are_named_by_a_plan(spark):
    n = 20_000
    wanted = F.when(F.col("id") % 4 == 0, F.concat(F.lit("s_"), (F.col("id") % 300).cast("string"))).otherwise("s")
    lists = spark.range(n).select(F.lpad(F.col("id").cast("string"), 9, "0").alias("first"), wanted.alias("wanted"), F.array(F.col("id").cast("string")).alias("columns"))
    known = spark.createDataFrame([("f", "s", ["x"]), ("g", "s_5", ["y"])], "file_path string, schema_name string, columns array<string>")
    named = registry.name_schemas(lists, known)
    assert named.count() == n and named.select("schema_name").distinct().count() == n
    assert named.where("schema_name IN ('s', 's_5')").count() == 0


def test_a_registered_list_keeps_its_name(spark):
    schema = "file_path string, schema_name string, columns array<string>"
    known = spark.createDataFrame([("a", "x", ["1"]), ("b", "x_1", ["2"])], schema)
    again = registry.canonical_schemas(spark.createDataFrame([("c", "y", ["2"]), ("d", "x", ["3"])], schema), known)
    assert rows(again.select("file_path", "schema_name")) == [("a", "x"), ("b", "x_1"), ("c", "x_1"), ("d", "x_2")]


def test_naming_by_distinct_columns_is_naming_file_by_file(spark):
    rng = random.Random(9)
    files = [(f"{i:03d}", rng.choice(["a", "b", "a_1"]), rng.choices("xyz", k=rng.choice([1, 2]))) for i in range(80)]
    by_file, names = {}, {}
    for path, wanted, columns in files:
        if tuple(columns) not in names:
            name, n = wanted, 0
            while name in names.values():
                n += 1
                name = f"{wanted}_{n}"
            names[tuple(columns)] = name
        by_file[path] = names[tuple(columns)]
    headers = spark.createDataFrame(files, "file_path string, schema_name string, columns array<string>")
    assert dict(rows(registry.canonical_schemas(headers).select("file_path", "schema_name"))) == by_file
