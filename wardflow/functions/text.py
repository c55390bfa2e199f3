"""Regular-expression helpers with NULL for "not found"."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def find_text(text: Column, pattern: str) -> Column:
    return F.regexp_substr(text, F.lit(pattern))


def find_group(text: Column, pattern: str, group: int = 1) -> Column:
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def squash(text: Column, keep: str) -> Column:
    """Drop every character outside the class `keep`, e.g. `0-9`."""
    return F.regexp_replace(text, f"[^{keep}]", "")
