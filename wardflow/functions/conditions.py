"""Conditional columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def iff(condition: Column, yes, no) -> Column:
    """A NULL condition counts as no."""
    return F.when(condition, yes).otherwise(no)


def band(rules: Iterable[tuple[Column, object]], default=None) -> Column:
    """First rule that holds wins."""
    rules = list(rules)
    chain = F.when(*rules[0])
    for condition, label in rules[1:]:
        chain = chain.when(condition, label)
    return chain.otherwise(default)


def lookup(column: Column, mapping: Mapping, default=None) -> Column:
    """Decode a column by a small fixed mapping."""
    return band([(column == key, value) for key, value in mapping.items()], default)


def score(parts: Iterable[Column]) -> Column:
    """Sum of point columns."""
    return reduce(lambda a, b: a + b, parts)


def classify_severity(value: Column, low, high, critical_low, critical_high) -> Column:
    return band(
        [
            ((value <= critical_low) | (value >= critical_high), "Critical"),
            ((value < low) | (value > high), "Abnormal"),
        ],
        "Normal",
    )
