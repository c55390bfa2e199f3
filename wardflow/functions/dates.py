"""Calendar arithmetic on DATE and TIMESTAMP_NTZ columns, free of time zones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def boundary_diff(unit: str, start: Column, end: Column) -> Column:
    """Number of unit boundaries crossed between two moments.

    31 Dec to 1 Jan is one year, 00:59 to 01:01 is one hour. Spark's own
    `datediff(unit, ...)` counts whole units, which gives 0 for both.
    """
    if unit == "year":
        return F.year(end) - F.year(start)
    if unit == "month":
        return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
    days = F.date_diff(F.to_date(end), F.to_date(start))
    if unit == "day":
        return days
    hours = days.cast("bigint") * 24 + F.hour(end) - F.hour(start)
    if unit == "hour":
        return hours
    if unit == "minute":
        return hours * 60 + F.minute(end) - F.minute(start)
    raise ValueError(f"unsupported unit {unit!r}")


def plus(unit: str, count, moment: Column) -> Column:
    """Shift a timestamp by days or hours."""
    count = count if isinstance(count, Column) else F.lit(count)
    zero = F.lit(0)
    parts = {"day": (count, zero), "hour": (zero, count)}[unit]
    return moment + F.make_dt_interval(parts[0].cast("int"), parts[1].cast("int"))


def floor_day(moment: Column) -> Column:
    return F.to_date(moment).cast("timestamp_ntz")


def floor_hour(moment: Column) -> Column:
    return plus("hour", F.hour(moment), floor_day(moment))


def floor_week(moment: Column) -> Column:
    """Monday of the week, as a timestamp."""
    return F.trunc(F.to_date(moment), "week").cast("timestamp_ntz")


def floor_month(day: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(F.to_date(day), "month")


def day_of_week(day: Column) -> Column:
    """0 is Sunday, 6 is Saturday."""
    return F.dayofweek(day) - 1


def completed_years(birth: Column, as_of: Column) -> Column:
    """Full years of life."""
    return F.floor(F.months_between(F.to_date(as_of), F.to_date(birth), False) / 12).cast("int")


def fiscal_quarter(day: Column, start_month: int = 7) -> Column:
    into_year = F.pmod(F.month(day) - start_month, F.lit(12))
    return F.concat(F.lit("Q"), (F.floor(into_year / 3) + 1).cast("string"))


def fiscal_year(day: Column, start_month: int = 7) -> Column:
    """Named after the calendar year in which the fiscal year ends."""
    ends_in = F.year(day) + F.when(F.month(day) >= start_month, 1).otherwise(0)
    return F.concat(F.lit("FY"), ends_in.cast("string"))


def clock_time(text: Column) -> Column:
    """`HH:mm` or `HH:mm:ss` as a moment on one fixed day; NULL when it is neither."""
    padded = F.when(F.length(text) == 5, F.concat(text, F.lit(":00"))).otherwise(text)
    return F.concat(F.lit("1970-01-01 "), padded).try_cast("timestamp_ntz")


def since(column: Column, as_of: Column, count: int, unit: str) -> Column:
    """Predicate: not older than `count` days or months before `as_of`."""
    today = F.to_date(as_of)
    start = {"day": F.date_sub(today, count), "month": F.add_months(today, -count)}[unit]
    return column >= start
