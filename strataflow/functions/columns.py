"""Column expressions used by the layers.

Sessions stay in ANSI mode, where a plain cast of bad text fails the job, so
everything that parses text goes through the ``try_`` forms and yields NULL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- parsing ---------------------------------------------------------------


def parse_int(c: Column | str) -> Column:
    """Text to int; ``'12.0'`` counts as 12, anything unreadable as NULL."""
    c = _col(c).cast("string")
    whole = F.regexp_extract(c, r"^\s*([+-]?\d+)\.\d*\s*$", 1)
    return F.coalesce(c.try_cast("int"), whole.try_cast("int"))


def blank_to_null(c: Column | str) -> Column:
    trimmed = F.trim(_col(c))
    return F.nullif(trimmed, F.lit(""))


def parse_date(c: Column | str) -> Column:
    """Text to date; blank or unreadable text is NULL."""
    return blank_to_null(c).try_cast("date")


def parse_epoch(c: Column | str) -> Column:
    """Unix seconds, as text or number, to timestamp."""
    return _col(c).try_cast("double").try_cast("timestamp")


def parse_event_time(c: Column | str, accept: str = "text") -> Column:
    """``accept`` is ``text`` (timestamp literal), ``epoch`` (seconds) or ``either``."""
    readers = {
        "text": lambda x: x.try_cast("timestamp"),
        "epoch": parse_epoch,
        "either": lambda x: F.coalesce(x.try_cast("timestamp"), parse_epoch(x)),
    }
    if accept not in readers:
        raise ValueError(f"accept must be one of {sorted(readers)}, got {accept!r}")
    return readers[accept](_col(c))


# --- domains ---------------------------------------------------------------


def null_sentinel(c: Column | str, sentinel: float = -1) -> Column:
    return F.nullif(_col(c), F.lit(sentinel))


def clamp_between(c: Column | str, lo: float | None = None, hi: float | None = None) -> Column:
    """The value inside ``[lo, hi]``, else NULL; a bound left out is open."""
    c = _col(c)
    inside = F.lit(True)
    if lo is not None:
        inside = inside & (c >= lo)
    if hi is not None:
        inside = inside & (c <= hi)
    return F.when(inside, c)


def clamp_in(c: Column | str, values: Sequence) -> Column:
    c = _col(c)
    return F.when(c.isin(*values), c)


# --- labels and flags ------------------------------------------------------


def bucketize(c: Column | str, lower: float, bounds: Sequence[tuple[float, str]]) -> Column:
    """Label of the first ascending upper bound at or above the value.

    Both ends are inclusive, so a value on a bound takes the lower bucket. NULL
    and values outside ``[lower, last bound]`` have no label.
    """
    c = _col(c)
    labelled = F.when(c < lower, F.lit(None).cast("string"))
    for upper, label in bounds:
        labelled = labelled.when(c <= upper, F.lit(label))
    return labelled


def by_bounds(
    c: Column | str, bounds: Sequence[tuple[float, str]], beyond: str, missing: str, lower: float | None = None
) -> Column:
    """Label of the first ascending upper bound at or above the value; ``beyond`` for any other value, ``missing`` for NULL."""
    c = _col(c)
    labelled = F.when(c.isNull(), missing)
    if lower is not None:
        labelled = labelled.when(c < lower, beyond)
    for upper, label in bounds:
        labelled = labelled.when(c <= upper, label)
    return labelled.otherwise(beyond)


def at_least(c: Column | str, threshold: float) -> Column:
    return _col(c) >= threshold


def label_map(c: Column | str, labels: Mapping[int, str]) -> Column:
    """Code to label; an unknown code is NULL."""
    (first, label), *rest = labels.items()
    c = _col(c)
    mapped = F.when(c == first, F.lit(label))
    for code, label in rest:
        mapped = mapped.when(c == code, F.lit(label))
    return mapped


def difference(a: Column | str, b: Column | str, places: int = 4) -> Column:
    """``a - b`` rounded; NULL when either side is."""
    return F.round(_col(a) - _col(b), places)


# --- time ------------------------------------------------------------------


def within_days(c: Column | str, days: int, as_of: Column | None = None) -> Column:
    """True for timestamps not older than ``days`` before ``as_of`` (default: now)."""
    now = F.current_timestamp() if as_of is None else as_of
    return _col(c) >= now - F.expr(f"INTERVAL '{int(days)}' DAY")


def days_since(c: Column | str, as_of: Column | None = None) -> Column:
    today = F.current_date() if as_of is None else F.to_date(as_of)
    return F.datediff(today, _col(c))


def iso_day_of_week(c: Column | str) -> Column:
    """Monday 1 to Sunday 7."""
    return (F.weekday(_col(c)) + 1).cast("int")
