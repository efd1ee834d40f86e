"""Column expressions; every one is built from native Spark functions."""

from strataflow.functions.columns import (
    at_least,
    blank_to_null,
    bucketize,
    by_bounds,
    clamp_between,
    clamp_in,
    days_since,
    difference,
    iso_day_of_week,
    label_map,
    null_sentinel,
    parse_date,
    parse_epoch,
    parse_event_time,
    parse_int,
    within_days,
)

__all__ = [
    "at_least",
    "blank_to_null",
    "bucketize",
    "by_bounds",
    "clamp_between",
    "clamp_in",
    "days_since",
    "difference",
    "iso_day_of_week",
    "label_map",
    "null_sentinel",
    "parse_date",
    "parse_epoch",
    "parse_event_time",
    "parse_int",
    "within_days",
]
