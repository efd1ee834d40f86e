"""Operators against plain Python on generated inputs."""

from __future__ import annotations

from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strataflow import operators as O
from strataflow.functions import bucketize
from strataflow.plans.silver.labels import BUCKETS, rating_category
from strataflow.sources.versions import new_rows
from tests.conftest import rows

few = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
maybe = lambda s: st.one_of(st.none(), s)


@given(st.lists(st.tuples(maybe(st.integers(0, 3)), maybe(st.integers(0, 3)), maybe(st.text("ab", max_size=2))), max_size=30))
@few
def test_dedup_keeps_the_greatest_of_each_key(spark, data):
    lowest = lambda v: (v is not None, v)
    groups = defaultdict(list)
    for row in data:
        groups[row[0]].append(row)
    expected = [max(g, key=lambda r: (lowest(r[1]), lowest(r[2]))) for g in groups.values()]
    df = spark.createDataFrame(data, "k int, t int, v string").repartition(3)
    assert rows(O.dedup_latest(df, ["k"], "t")) == sorted(expected, key=repr)


@given(
    st.sets(st.tuples(maybe(st.integers(0, 5)), st.integers(0, 2))),
    st.sets(st.tuples(maybe(st.integers(0, 5)), st.integers(0, 2))),
)
@few
def test_new_rows_are_those_whose_whole_key_is_unknown(spark, batch, target):
    schema = "a int, b int"
    out = new_rows(spark.createDataFrame(list(batch), schema), spark.createDataFrame(list(target), schema), ["a", "b"])
    expected = [r for r in batch if r[0] is None or r not in target]
    assert rows(out) == sorted(expected, key=repr)


@given(st.lists(maybe(st.floats(-1, 6, width=32)), min_size=1, max_size=40))
@few
def test_labels_follow_the_written_ranges(spark, values):
    def bucket(v):
        low = 0.5
        for high, label in BUCKETS:
            if v is not None and low <= v <= high:
                return label
            low = high
        return None

    def category(v):
        return "high" if v is None or v > 3.5 else "low" if v <= 2.5 else "medium"

    df = spark.createDataFrame([(v,) for v in values], "v double").coalesce(1)
    got = df.select(bucketize("v", 0.5, BUCKETS), rating_category("v")).collect()
    assert [tuple(r) for r in got] == [(bucket(v), category(v)) for v in values]


@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 3), st.floats(0.5, 5)), min_size=1, max_size=40))
@few
def test_merged_totals_are_the_totals(spark, data):
    df = spark.createDataFrame(data, "k int, fine int, rating double")
    direct = rows(O.rating_metrics(df, ["k"]))
    merged = rows(O.merge_totals(O.rating_totals(df, ["k", "fine"]), ["k"]))
    assert [r[:2] for r in direct] == [r[:2] for r in merged]
    for (k, n, average), (_, _, other) in zip(direct, merged):
        exact = sum(r[2] for r in data if r[0] == k) / n
        assert abs(average - exact) < 1e-12 and abs(other - exact) < 1e-12


@given(st.lists(st.text("aA |b", max_size=8), max_size=20))
@few
def test_exploded_tokens(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    out = O.explode_delimited(df, "t", r"\|", "token", ["id"], drop=["b"])
    expected = {(i, p.strip(" ").lower()) for i, t in enumerate(texts) for p in t.split("|")}
    assert rows(out) == sorted(((i, p) for i, p in expected if p not in ("", "b")), key=repr)
    assert rows(out) == rows(O.explode_delimited(df, "t", r"\|", "token", ["id"], ["b"], keep_is_unique=True))
