from __future__ import annotations

import random
import time
from collections import Counter
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from strataflow.plans.entities import BELIEF, MOVIES
from strataflow.plans.incremental import read_cleaned, read_features, run_incremental
from strataflow.sources import changes, shapes, versions
from tests.conftest import plan_of, rows

SF = "/root/testdata/sf0.001"
SCHEMA = "k1 int, k2 string, v double, at timestamp, more array<string>, _ingestion_timestamp timestamp"


def made(rng, n):
    values = [(rng.choice([1, 2, 3, None]), rng.choice(["a", None]), rng.choice([0.5, None]), rng.choice(["x", None])) for _ in range(n)]
    return [(a, b, v, None, [m, None] if m else None, None) for a, b, v, m in values]


def plain_feed(before, after, keyed):
    lost, gained = Counter(map(repr, before)), Counter(map(repr, after))
    lost, gained = lost - gained, gained - lost
    key = lambda text: text.split(", ")[:2]
    whole = lambda text: "None" not in key(text)[0] and key(text)[1] != "None"
    out = Counter()
    for side, other, alone, met in ((lost, gained, "delete", "update_preimage"), (gained, lost, "insert", "update_postimage")):
        others = {tuple(key(t)) for t in other}
        for text, n in side.items():
            out[text, met if keyed and whole(text) and tuple(key(text)) in others else alone] += n
    return out


@pytest.mark.parametrize("keyed", [False, True])
def test_feed_against_counting(spark, keyed):
    rng = random.Random(1)
    for n in (0, 3, 40):
        before, after = made(rng, n), made(rng, 40 - n)
        frames = [spark.createDataFrame(x, SCHEMA) for x in (before, after)]
        feed = changes.change_feed(*frames, ["k1", "k2"] if keyed else ())
        got = Counter((repr(tuple(r)[:-1]), r[changes.CHANGE_TYPE]) for r in feed.collect())
        assert got == plain_feed(before, after, keyed)


def test_copies_beyond_one_step(spark, monkeypatch):
    monkeypatch.setattr(changes, "_COPIES", 4)
    one = spark.range(1).select(F.lit("x").alias("v"))
    for n in (1, 4, 5, 8, 11):
        feed = changes.change_feed(one, spark.range(n + 1).select(F.lit("x").alias("v")))
        assert Counter(r[changes.CHANGE_TYPE] for r in feed.collect()) == {"insert": n}


def test_columns_that_came_and_went(spark):
    before = spark.createDataFrame([(1, "a", 9), (2, "b", 9)], "k int, v string, gone int")
    after = spark.createDataFrame([(1, "a", None), (2, "b", "new")], "k int, v string, came string")
    feed = changes.change_feed(before, after, ["k"])
    assert rows(feed) == [(2, "b", "new", "update_postimage"), (2, "b", None, "update_preimage")]


def test_times_differ_by_microseconds(spark):
    at = lambda text: spark.createDataFrame([(1,)], "k int").withColumn("at", F.lit(text).cast("timestamp"))
    assert changes.change_feed(at("2024-01-01 00:00:00.000001"), at("2024-01-01 00:00:00.000002"), ["k"]).count() == 2
    assert changes.change_feed(at("2024-01-01 00:00:00.000001"), at("2024-01-01 00:00:00.000001"), ["k"]).count() == 0


def test_changes_over_several_loads(spark, base):
    for n, values in enumerate([[1, 2], [2, 3], [3, 4, 4]]):
        versions.write_version(spark.createDataFrame([(v,) for v in values], "v int"), base, n)
    feed = changes.changes_since(spark, base, 0)
    assert rows(feed) == [(1, "delete", 1), (2, "delete", 2), (3, "insert", 1), (4, "insert", 2), (4, "insert", 2)]
    assert rows(changes.changes_since(spark, base, 1, types=changes.NEW_CONTENT).select("v")) == [(4,), (4,)]
    for bad in (7, 2):
        with pytest.raises(ValueError, match="version"):
            changes.changes_since(spark, base, bad)


def test_changed_rows_are_looked_up_without_shuffling_the_table(spark, base):
    orders = shapes.given(spark, SF, "orders")
    versions.write_version(orders.where("o_orderkey % 100 <> 0"), base, 0)
    versions.write_version(orders, base, 1)
    feed = changes.changes_since(spark, base, 0, types=changes.NEW_CONTENT)
    assert feed.count() == orders.where("o_orderkey % 100 = 0").count()
    assert "BroadcastHashJoin" in plan_of(feed) or "BroadcastExchange" in plan_of(feed)


def counting(entity):
    """The entity, and how many rows its cleaning was given."""
    seen = entity_rows = []

    def clean(df, **options):
        seen.append(df.sparkSession.sparkContext.accumulator(0))
        total = seen[-1]
        counted = df.rdd.map(lambda r: (total.add(1), r)[1])
        return entity.clean(df.sparkSession.createDataFrame(counted, df.schema), **options)

    return replace(entity, clean=clean), entity_rows


def test_a_reload_cleans_its_changes_only(spark, base):
    raw = shapes.belief(spark, SF)
    versions.write_version(raw.where("user_id % 100 <> 0"), BELIEF.bronze_path(base), 0)
    run_incremental(spark, BELIEF, base, database=None)
    new = raw.where("user_id % 100 = 0")
    later = raw.withColumn("_ingestion_timestamp", F.col("_ingestion_timestamp") + F.expr("INTERVAL 1 DAY"))
    versions.write_version(later, BELIEF.bronze_path(base), 1)
    entity, seen = counting(BELIEF)
    assert run_incremental(spark, entity, base, database=None)["status"] == "OK"
    # The plan that stores the rows passes over them more than once where it sorts ranges by a sample.
    assert 0 < seen[-1].value <= 2 * new.count() < raw.count() // 10
    columns = ["user_id", "movie_id", "event_timestamp", "user_rating", "predicted_rating"]
    whole = BELIEF.build_cleaned(raw).select(*columns)
    assert rows(read_cleaned(spark, BELIEF, base).select(*columns)) == rows(whole)
    assert read_features(spark, BELIEF, base).count() == whole.count()


def test_a_reload_without_changes_and_one_whose_base_is_gone(spark, base):
    def load(n, *movies):
        df = spark.createDataFrame(list(movies), "movie_id int, title string, genres string")
        stamped = df.withColumns({"_ingestion_timestamp": F.current_timestamp(), "_source": F.lit("postgres")})
        versions.write_version(stamped, MOVIES.bronze_path(base), n)

    def titles():
        return rows(read_cleaned(spark, MOVIES, base).select("movie_id", "title"))

    load(0, (1, "A (2000)", "x"))
    run_incremental(spark, MOVIES, base, database=None)
    load(1, (1, "A (2000)", "x"))
    assert run_incremental(spark, MOVIES, base, database=None)["status"] == "OK"
    assert run_incremental(spark, MOVIES, base, database=None)["status"] == "UP_TO_DATE"
    # Changed rows of a key that is known add nothing, also over several loads at once.
    load(2, (1, "B (2000)", "x"), (2, "C (2001)", "y"))
    load(3, (3, "D (2001)", "y"))
    run_incremental(spark, MOVIES, base, database=None)
    assert titles() == [(1, "A"), (2, "C"), (3, "D")]
    versions.drop_older(spark, MOVIES.bronze_path(base), keep=0)
    load(4, (4, "E (2001)", "y"))
    run_incremental(spark, MOVIES, base, database=None)
    assert titles() == [(1, "A"), (2, "C"), (3, "D"), (4, "E")]


@pytest.mark.parametrize("slices", [1, 3])
def test_a_stored_feed_is_the_same(spark, base, conf, monkeypatch, slices):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    monkeypatch.setattr(changes, "SLICE_BYTES", 1 if slices > 1 else 1 << 30)
    rng = random.Random(2)
    for n in range(3):
        versions.write_version(spark.createDataFrame(made(rng, 60), SCHEMA), f"{base}/t", n)
    for types in (None, changes.NEW_CONTENT):
        scratch = f"{base}/scratch-{types}"
        stored = changes.changes_since(spark, f"{base}/t", 0, types=types, scratch=scratch, store=True)
        assert rows(stored) == rows(changes.changes_since(spark, f"{base}/t", 0, types=types)) != []
        # Digests went with their slice.
        assert sorted(p.name for n in (1, 2) for p in Path(f"{scratch}/{n}").iterdir()) == ["rows", "rows"]
    with pytest.raises(ValueError, match="keys"):
        changes.changes_since(spark, f"{base}/t", 0, ["k1"], scratch=f"{base}/s", store=True)


def test_rows_that_share_a_short_digest_are_told_apart(spark, conf, monkeypatch):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    monkeypatch.setattr(changes, "_short", lambda digest: F.xxhash64(digest) % 3)
    rng = random.Random(5)
    before, after = made(rng, 30), made(rng, 50)
    feed = changes.change_feed(*[spark.createDataFrame(x, SCHEMA) for x in (before, after)])
    assert Counter((repr(tuple(r)[:-1]), r[changes.CHANGE_TYPE]) for r in feed.collect()) == plain_feed(before, after, False)


def test_digests_are_bytes(spark):
    kind = spark.range(1).select(changes.row_digest(["id"]).alias("d"))
    assert kind.dtypes == [("d", "binary")] and len(kind.first().d) == 32


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    files = [found.apply(k) for k in range(found.size())]
    return {f.getName(): f.length() for f in files if f.getName().startswith("shuffle_")}


def test_a_run_releases_its_shuffles(spark, base):
    """Else they stay until the driver happens to collect its garbage, beside those of the next step."""
    raw = shapes.belief(spark, SF)
    before = shuffle_files(spark)
    for n, part in enumerate([raw.where("user_id % 2 = 0"), raw]):
        versions.write_version(part, BELIEF.bronze_path(base), n)
        run_incremental(spark, BELIEF, base, database=None)
    # What is left is of the looks at the batch's days; the rows of a single shuffle take more.
    until = time.time() + 20
    while (left := sum(n for f, n in shuffle_files(spark).items() if f not in before)) >= 150_000 and time.time() < until:
        time.sleep(0.1)
    assert left < 150_000
    assert read_features(spark, BELIEF, base).count() == raw.count()
