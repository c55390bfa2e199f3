"""Divisions with the three null rules the models need, and number parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def div0null(numerator: Column, denominator: Column) -> Column:
    """0 when the divisor is 0 or NULL."""
    bottom = denominator.cast("double")
    return F.when(bottom.isNull() | (bottom == 0), F.lit(0.0)).otherwise(
        F.try_divide(numerator.cast("double"), bottom)
    )


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """NULL when the divisor is 0 or NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def share(part: Column, whole_: Column) -> Column:
    """Part of a total; NULL for a zero total."""
    return F.try_divide(part.cast("double"), whole_.cast("double"))


def zero_if_null(column: Column) -> Column:
    return F.coalesce(column, F.lit(0))


def whole(text: Column, safe: bool = False) -> Column:
    """Whole number from text, rounding a fraction ("98.6" gives 99)."""
    number = text.try_cast("decimal(38,0)") if safe else text.cast("decimal(38,0)")
    return number.cast("bigint")


def safe_variant_cast(text: Column, kind: str, default) -> Column:
    """The text as `kind`, or the default where it is NULL or cannot be read so."""
    return F.coalesce(text.try_cast(kind), F.lit(default).cast(kind))


def iqr_fences(p25: Column, p75: Column, k: float = 1.5) -> tuple[Column, Column, Column]:
    """Interquartile range and the fences k ranges outside it."""
    spread = p75 - p25
    return spread, p25 - spread * k, p75 + spread * k
