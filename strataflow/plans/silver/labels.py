"""Labels that several silver tables share."""

from __future__ import annotations

from pyspark.sql import Column

from strataflow.functions import by_bounds

# Fixed values of the data contract.
BUCKETS = [(1.5, "very_low"), (2.5, "low"), (3.5, "mid"), (4.5, "high"), (5.0, "top")]
CATEGORIES = [(2.5, "low"), (3.5, "medium")]
ABOVE_CATEGORIES = "high"
MONTH_GROUPS = [(2, "early_stage"), (6, "mid_stage")]
ABOVE_MONTH_GROUPS = "late_stage"
NO_MONTH = "unknown"


def rating_category(c: Column | str) -> Column:
    """The published rules put a missing rating with the high ones."""
    return by_bounds(c, CATEGORIES, ABOVE_CATEGORIES, ABOVE_CATEGORIES)


def month_group(c: Column | str) -> Column:
    return by_bounds(c, MONTH_GROUPS, ABOVE_MONTH_GROUPS, NO_MONTH, lower=0)
