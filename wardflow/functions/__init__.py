"""Column functions: each takes and returns Columns, so plans stay in codegen."""

from wardflow.functions.conditions import band, classify_severity, iff, lookup, score
from wardflow.functions.dates import (
    boundary_diff,
    clock_time,
    completed_years,
    day_of_week,
    fiscal_quarter,
    fiscal_year,
    floor_day,
    floor_hour,
    floor_month,
    floor_week,
    plus,
    since,
)
from wardflow.functions.keys import hash_bucket, mask_pii, md5_key, surrogate_key, text_of
from wardflow.functions.numbers import div0null, iqr_fences, safe_divide, safe_variant_cast, share, whole, zero_if_null
from wardflow.functions.text import find_group, find_text, squash

__all__ = [
    "band", "boundary_diff", "classify_severity", "clock_time", "completed_years", "day_of_week",
    "div0null", "find_group", "find_text", "fiscal_quarter", "fiscal_year", "floor_day",
    "floor_hour", "floor_month", "floor_week", "hash_bucket", "iff", "iqr_fences", "lookup",
    "mask_pii", "md5_key", "plus", "safe_divide", "safe_variant_cast", "score", "share", "since", "squash",
    "surrogate_key", "text_of", "whole", "zero_if_null",
]
