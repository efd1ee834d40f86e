from __future__ import annotations

import random
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.operators import table_profile
from strataflow.operators.profiles import EXACT, PARTS_SCHEMA, merge_profiles, profile_of, profile_parts
from strataflow.sources.versions import read_since, write_version

COLS = ["k", "v", "t", "none"]


def made(spark, n, seed):
    rng = random.Random(seed)
    rows = [(rng.randint(-50, 10**rng.randint(1, 6)), rng.choice([None, rng.gauss(1e6, 3)]), rng.choice(["a", "Z", "10", "9", None]), None) for _ in range(n)]
    return spark.createDataFrame(rows, "k bigint, v double, t string, none int")


def test_merged_over_versions_is_the_profile_of_everything(spark, base):
    parts = [made(spark, n, n) for n in (400, 1, 0, 250)]
    for n, df in enumerate(parts):
        write_version(profile_parts(df, COLS), base, n)
    merged = profile_of(merge_profiles(read_since(spark, base, schema=PARTS_SCHEMA)), COLS)
    got = {r["summary"]: r for r in merged.collect()}
    everything = reduce(DataFrame.unionAll, parts)
    want = {r["summary"]: r for r in table_profile(everything, COLS).collect()}
    for statistic in EXACT:
        for c in COLS:
            a, b = got[statistic][c], want[statistic][c]
            if c == "t" and statistic in ("mean", "stddev"):
                assert a is None  # text has no moments here
            elif statistic in ("mean", "stddev") and b is not None:
                assert float(a) == pytest.approx(float(b), rel=1e-9)
            else:
                assert a == b, (statistic, c)
    distinct = everything.select("k").distinct().count()
    assert abs(float(got["distinct"]["k"]) - distinct) <= 0.05 * distinct
    below = everything.where(F.col("k") <= float(got["median"]["k"])).count() / everything.count()
    assert abs(below - 0.5) < 0.04
    assert got["median"]["t"] is None and got["median"]["none"] is None


def test_large_values_with_small_spread_keep_their_deviation(spark):
    parts = [spark.range(100).select((F.col("id") % 3 + 1e12 + s).alias("v")) for s in (0, 1)]
    merged = merge_profiles(profile_parts(parts[0], ["v"]).unionAll(profile_parts(parts[1], ["v"]))).first()
    exact = parts[0].unionAll(parts[1]).agg(F.var_pop("v")).first()[0]
    assert merged.m2 / merged.n == pytest.approx(exact, rel=1e-3)
