from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from strataflow import functions as C
from strataflow.plans.silver import elicitation, labels, ratings, recommendations


def apply(spark, values, type_, fn):
    df = spark.createDataFrame([(v,) for v in values], f"v {type_}").coalesce(1)
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


@pytest.mark.parametrize(
    ("type_", "fn", "cases"),
    [
        (
            "double",
            lambda c: C.bucketize(c, ratings.RATING_RANGE[0], ratings.BUCKETS),
            {
                0.5: "very_low", 1.5: "very_low", 1.50001: "low", 2.5: "low", 3.5: "mid", 4.5: "high",
                5.0: "top", None: None, 0.4: None, 5.1: None, float("nan"): None,
            },
        ),
        (
            "double",
            lambda c: C.bucketize(c, recommendations.PREDICTED_RANGE[0], recommendations.BUCKETS),
            {0.0: "very_low", -0.1: None, 0.4: "very_low", 4.51: "top"},
        ),
        (
            "double",
            labels.rating_category,
            {2.5: "low", 2.51: "medium", 3.5: "medium", 3.51: "high", None: "high"},
        ),
        ("double", lambda c: C.at_least(c, 4), {4.0: True, 3.99: False, None: None}),
        (
            "int",
            lambda c: C.label_map(c, elicitation.SOURCE_LABELS),
            {
                1: "popular", 2: "well_rated", 3: "recent_popular", 4: "trending", 5: "serendipity",
                0: None, 6: None, None: None,
            },
        ),
        (
            "int",
            labels.month_group,
            {
                None: "unknown", 0: "early_stage", 2: "early_stage", 3: "mid_stage", 6: "mid_stage",
                7: "late_stage",
            },
        ),
        ("double", C.null_sentinel, {-1.0: None, 0.0: 0.0, 1.0: 1.0, None: None}),
        ("double", lambda c: C.clamp_between(c, 0.5, 5.0), {0.5: 0.5, 5.0: 5.0, 0.49: None, 5.01: None, None: None}),
        ("int", lambda c: C.clamp_between(c, lo=0), {-1: None, 0: 0, 9: 9, None: None}),
        ("int", lambda c: C.clamp_in(c, [1, 2, 3, 4, 5]), {0: None, 1: 1, 5: 5, 6: None, None: None}),
        (
            "string",
            C.parse_int,
            {"7": 7, " 7 ": 7, "7.0": 7, "7.9": 7, "-3": -3, "x": None, "": None, None: None, "99999999999": None},
        ),
        (
            "string",
            C.parse_date,
            {"": None, "  ": None, "x": None, "2024-01-02": date(2024, 1, 2), " 2024-01-02 ": date(2024, 1, 2), None: None},
        ),
        (
            "string",
            lambda c: C.parse_event_time(c).cast("string"),
            {"2024-01-01 10:00:00": "2024-01-01 10:00:00", "1700000000": None, "x": None, "": None, None: None},
        ),
        (
            "string",
            lambda c: C.parse_event_time(c, "epoch").cast("string"),
            {"1700000000": "2023-11-14 22:13:20", "2024-01-01 10:00:00": None, "NaN": None, None: None},
        ),
        (
            "string",
            lambda c: C.parse_event_time(c, "either").cast("string"),
            {"1700000000": "2023-11-14 22:13:20", "2024-01-01 10:00:00": "2024-01-01 10:00:00"},
        ),
        (
            "date",
            C.iso_day_of_week,
            {date(2024, 1, 7): 7, date(2024, 1, 8): 1, None: None},
        ),
    ],
)
def test_values(spark, type_, fn, cases):
    assert apply(spark, list(cases), type_, fn) == list(cases.values())


def test_event_time_form_must_be_known():
    with pytest.raises(ValueError, match="accept"):
        C.parse_event_time("c", "guess")


def test_difference_is_rounded_and_null_safe(spark):
    df = spark.createDataFrame([(4.12345, 1.0), (None, 1.0), (1.0, None)], "a double, b double").coalesce(1)
    assert [r[0] for r in df.select(C.difference("a", "b")).collect()] == [3.1235, None, None]


def test_clock_can_be_fixed(spark):
    as_of = F.lit("2024-12-31 12:00:00").cast("timestamp")
    times = [datetime(2024, 1, 1, 12), datetime(2024, 1, 1, 11, 59), None]
    text = [t and t.isoformat(sep=" ") for t in times]
    ts = lambda c: c.cast("timestamp")
    assert apply(spark, text, "string", lambda c: C.within_days(ts(c), 365, as_of)) == [True, False, None]
    assert apply(spark, text, "string", lambda c: C.days_since(ts(c), as_of)) == [365, 365, None]
    # Without one it is now.
    assert apply(spark, ["1999-01-01"], "string", lambda c: C.within_days(ts(c), 365)) == [False]
