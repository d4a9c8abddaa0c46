"""Column-level building blocks (all built-in Spark expressions)."""

from skyfold.functions.keys import surrogate_key
from skyfold.functions.exprs import (
    bucketize,
    conditional_count,
    safe_pct,
    three_valued_flag,
    status_in,
    json_field,
    json_object_or_null,
    sentinel_to_null,
)
from skyfold.functions.dates import date_attributes

__all__ = [
    "surrogate_key",
    "bucketize",
    "conditional_count",
    "safe_pct",
    "three_valued_flag",
    "status_in",
    "json_field",
    "json_object_or_null",
    "sentinel_to_null",
    "date_attributes",
]
