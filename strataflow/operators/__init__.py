"""DataFrame to DataFrame operators."""

from strataflow.operators.frames import (
    cast_columns,
    clamp_range,
    clamp_set,
    dedup_latest,
    explode_delimited,
    rename_map,
    require_keys,
    sentinel_to_null,
    stamp_audit,
)
from strataflow.operators.metrics import merge_totals, rank_within, rating_metrics, rating_totals, top_k
from strataflow.operators.quality import preview, quality_report, table_profile

__all__ = [
    "cast_columns",
    "clamp_range",
    "clamp_set",
    "dedup_latest",
    "explode_delimited",
    "merge_totals",
    "preview",
    "quality_report",
    "rank_within",
    "rating_metrics",
    "rating_totals",
    "rename_map",
    "require_keys",
    "sentinel_to_null",
    "stamp_audit",
    "table_profile",
    "top_k",
]
