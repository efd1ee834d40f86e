"""Sides of joins that grow with the documents are not broadcast, however small Spark takes them to be."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from strataflow.llm import components as components_module
from strataflow.llm import packing_gga, simhash_anchor
from strataflow.llm.components import components
from strataflow.llm.queries import ready
from tests.conftest import plan_of


@pytest.fixture
def plans(monkeypatch):
    """Initial plans of what a module stores."""

    def held(module):
        found, store = [], module.stored
        monkeypatch.setattr(module, "stored", lambda df, *a, **k: (found.append(plan_of(df)), store(df, *a, **k))[1])
        return found

    return held


def docs_of(spark, base, n=200):
    ready(spark)
    rng = random.Random(3)
    rows = [(i, " ".join(f"w{rng.randrange(5000)}" for _ in range(30))) for i in range(n)]
    spark.createDataFrame([*rows, (n, rows[0][1])], "doc_id long, text string").write.parquet(base)
    return spark.read.parquet(base)


def test_replicas_of_fingerprints_are_not_broadcast(spark, base, conf):
    """Spark takes the 34 rows of a fingerprint for one: 10 MB by its estimate took all of a driver's heap."""
    conf(spark__sql__autoBroadcastJoinThreshold="10m")
    ready(spark)
    spark.range(2000).select(F.xxhash64("id").alias("fp")).union(spark.range(1).select((F.xxhash64("id").bitwiseXOR(F.lit(5))).alias("fp"))).write.parquet(base)
    links = simhash_anchor.link_fingerprints(spark.read.parquet(base))
    assert "SortMergeJoin" in plan_of(links) and "Broadcast" not in plan_of(links)
    assert links.distinct().count() == 1


def test_names_of_components_are_not_broadcast(spark, base, conf, plans):
    conf(spark__sql__autoBroadcastJoinThreshold="10m")
    stored = plans(simhash_anchor)
    found = simhash_anchor.near_duplicates(docs_of(spark, base))
    assert stored and not [p for p in [*stored, plan_of(found)] if "Broadcast" in p]
    assert {(r.doc_id, r.component_id) for r in found.collect() if r.doc_id in (0, 200)} == {(0, 0), (200, 0)}


@pytest.mark.parametrize("limit, sent", [(0, False), (100_000, True)])
def test_rounds_over_many_edges_broadcast_nothing(spark, base, conf, plans, monkeypatch, limit, sent):
    conf(spark__sql__autoBroadcastJoinThreshold="10m")
    monkeypatch.setattr(components_module, "BROADCAST_EDGES", limit, raising=False)
    rounds = plans(components_module)
    spark.createDataFrame([(1, 2), (2, 3), (3, 4), (9, 8)], "a long, b long").write.parquet(base)
    found = {r.node: r.root for r in components(spark.read.parquet(base)).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 1, 8: 8, 9: 8}
    assert any("Broadcast" in p for p in rounds) == sent


def test_places_of_pieces_are_not_broadcast(spark, base, conf, plans):
    conf(spark__sql__autoBroadcastJoinThreshold="10m")
    stored = plans(packing_gga)
    packed = packing_gga.pack_documents(docs_of(spark, base, 50), "byte_bpe_50k.json", size=64)
    assert "SortMergeJoin" in plan_of(packed) and "Broadcast" not in plan_of(packed)
    assert stored and not [p for p in stored if "Broadcast" in p]
    assert len({r.doc_id for r in packed.collect()}) == 51
