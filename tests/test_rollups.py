from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from strataflow.plans import rollups
from strataflow.plans.build import build, read_mart
from strataflow.plans.entities import MOVIES, RATINGS
from strataflow.plans.gold import MODELS, Thresholds
from strataflow.sources.files import drop_path
from strataflow.sources.versions import version_path, write_version
from tests.conftest import rows

T = Thresholds(min_ratings=2, underrated_below=6)
MARTS = sorted(m.name for m in MODELS.values() if m.stored)


def load_ratings(spark, base, version, n, seed):
    rng = random.Random(seed)
    data = [(rng.randint(1, 9), rng.randint(1, 12), rng.choice([0.5, 3.0, 4.0, 4.5, None, 3.123456]), version * 1000 + i) for i in range(n)]
    df = spark.createDataFrame(data, "user_id int, movie_id int, rating double, s int").select(
        "user_id", "movie_id", "rating", F.timestamp_seconds(F.col("s") * 40_000).alias("event_timestamp"),
        *[F.lit(None).cast(t).alias(c) for c, t in (("ingestion_timestamp", "timestamp"), ("source_system", "string"), ("source_topic", "string"), ("processed_timestamp", "timestamp"))],
    )
    write_version(df, RATINGS.cleaned_path(base), version)


def load_movies(spark, base, version, ids):
    write_version(
        spark.createDataFrame([(i, f"M{i}", 1990 + i, "x", None, None, None) for i in ids], MOVIES.cleaned_schema), MOVIES.cleaned_path(base), version
    )
    write_version(spark.createDataFrame([(i, g) for i in ids for g in ("drama", f"g{i % 3}")], MOVIES.features_schema), MOVIES.features_path(base), version)


def marts(spark, base, incremental):
    build(spark, base, "tag:gold", T, database=None, incremental=incremental)
    rounded = {}
    for name in MARTS:
        df = read_mart(spark, base, name)
        doubles = [c for c, t in df.dtypes if t == "double"]
        rounded[name] = rows(df.withColumns({c: F.round(c, 9) for c in doubles}))
    return rounded


def same_as_whole(spark, base):
    """Every kept rollup is its model over all silver versions; remainders are compared to nine places."""
    silver = {t: spark.read.parquet(p(base)) for t, p in ((RATINGS.table_cleaned, RATINGS.cleaned_path), (MOVIES.table_features, MOVIES.features_path))}
    for name, rollup in rollups.ROLLUPS.items():
        whole = rollups._totals(rollup, silver[RATINGS.table_cleaned], silver[MOVIES.table_features])
        kept = rollups.read_rollup(spark, base, name).select(whole.columns)
        assert rows(kept.withColumn("beyond", F.round("beyond", 9))) == rows(whole.withColumn("beyond", F.round("beyond", 9)))


def versions_read(df):
    return {int(f.split("_version=")[1].split("/")[0]) for f in df.inputFiles() if "ratings_cleaned" in f}


def test_marts_from_kept_rollups_are_those_of_a_full_build(spark, base):
    load_movies(spark, base, 0, range(1, 5))
    steps = [
        lambda: load_ratings(spark, base, 0, 60, 1),
        lambda: load_ratings(spark, base, 3, 40, 2),
        lambda: load_movies(spark, base, 1, range(5, 9)),  # genres for movies that were rated before
        lambda: (load_ratings(spark, base, 4, 30, 3), load_movies(spark, base, 2, [9, 10])),
        lambda: None,
    ]
    for step in steps:
        step()
        rollups.update(spark, base)
        same_as_whole(spark, base)
    assert marts(spark, base, True) == marts(spark, base, False)


def test_an_update_reads_new_versions_only(spark, base):
    load_movies(spark, base, 0, range(1, 5))
    for n in range(2):
        load_ratings(spark, base, n, 30, n)
    assert rollups.update(spark, base)["rollup_user_genres"] == (0, 1)
    load_ratings(spark, base, 2, 30, 5)
    for name in rollups.ROLLUPS:
        assert versions_read(rollups.pending(spark, base, name, (0, 2))) == {2}
    rollups.update(spark, base)
    assert all(rollups.pending(spark, base, name, (0, 2)) is None for name in rollups.ROLLUPS)
    # New genres make the old ratings count again, for totals by genre alone.
    load_movies(spark, base, 1, [7])
    assert versions_read(rollups.pending(spark, base, "rollup_user_genres", (1, 2))) == {0, 1, 2}
    assert rollups.pending(spark, base, "rollup_users", (0, 2)) is None


def test_an_update_that_broke_off_is_made_again(spark, base, monkeypatch):
    load_movies(spark, base, 0, range(1, 5))
    load_ratings(spark, base, 0, 30, 1)
    write = rollups.write_version

    def fail(df, path, version):
        write(df, path, version)
        if "rollup_users" in path:
            drop_path(spark, f"{version_path(path, version)}/_SUCCESS")
            raise OSError("driver lost")

    monkeypatch.setattr(rollups, "write_version", fail)
    with pytest.raises(OSError):
        rollups.update(spark, base)
    monkeypatch.undo()
    rollups.update(spark, base)
    same_as_whole(spark, base)


def test_deltas_are_folded_and_old_ones_go(spark, base):
    load_movies(spark, base, 0, range(1, 5))
    for n in range(7):
        load_ratings(spark, base, n, 12, n)
        rollups.update(spark, base, max_deltas=2)
        found = rollups.entries(spark, base, "rollup_days")
        assert len(found["base"]) <= 2 and len(found["delta"]) <= 4
        live = rollups._live(found)
        assert sum(kind == "delta" for kind, _ in live) < 2
        whole = rollups._totals(rollups.ROLLUPS["rollup_days"], spark.read.parquet(RATINGS.cleaned_path(base)), None)
        columns = ["event_date", "rating", "total_ratings", "points"]
        assert rows(rollups.read_rollup(spark, base, "rollup_days").select(columns)) == rows(whole.select(columns))


def test_without_ratings_or_genres(spark, base):
    with pytest.raises(ValueError, match="no entries"):
        rollups.read_rollup(spark, base, "rollup_users")
    load_ratings(spark, base, 0, 20, 1)
    assert rollups.update(spark, base)["rollup_user_genres"] == rollups.NOTHING
    assert set(rollups.stored_rollups(spark, base)) == {"rollup_movies", "rollup_days", "rollup_users"}
    load_movies(spark, base, 0, [1, 2])
    assert rollups.update(spark, base)["rollup_user_genres"] == (0, 0)
