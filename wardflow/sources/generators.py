"""Generated rows: counters, time spines and the calendar dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.functions import day_of_week, fiscal_quarter, fiscal_year, floor_month


def row_generator(spark: SparkSession, n: int) -> DataFrame:
    """Rows 0 .. n-1 in column `seq`."""
    return spark.range(n).select(F.col("id").alias("seq"))


def time_points(start: Column, count: int, unit: str) -> Column:
    """Array of `count` days (of a date) or hours (of a timestamp), for `explode`."""
    if unit == "day":
        return F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: F.date_add(start, i))
    return F.transform(
        F.sequence(F.lit(0), F.lit(count - 1)), lambda i: start + F.make_dt_interval(hours=i)
    )


def time_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Every day from start to end, both included, in column `date_day`."""
    days = (date.fromisoformat(end) - date.fromisoformat(start)).days + 1
    origin = F.lit(start).cast("date")
    return row_generator(spark, days).select(F.date_add(origin, F.col("seq").cast("int")).alias("date_day"))


def recursive_series(spark: SparkSession, anchor: Column, step_days: int, n: int) -> DataFrame:
    """anchor, anchor + step, ... n rows with their number; the closed form of the recursion."""
    number = F.col("seq").cast("int")
    return row_generator(spark, n).select(
        F.date_add(anchor, number * step_days).alias("day_date"), (number + 1).alias("day_num")
    )


def calendar(spark: SparkSession, start: str = "2024-01-01", days: int = 730, fiscal_start: int = 7) -> DataFrame:
    """One row per day with calendar and fiscal attributes."""
    d = F.col("date_day")
    base = row_generator(spark, days).select(
        F.date_add(F.lit(start).cast("date"), F.col("seq").cast("int")).alias("date_day")
    )
    return base.select(
        d,
        F.year(d).alias("year_num"),
        F.quarter(d).alias("quarter_num"),
        F.month(d).alias("month_num"),
        F.monthname(d).alias("month_name"),
        F.weekofyear(d).alias("week_num"),
        day_of_week(d).alias("day_of_week"),
        F.dayname(d).alias("day_name"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        day_of_week(d).isin(0, 6).alias("is_weekend"),
        (d == F.last_day(d)).alias("is_month_end"),
        floor_month(d).alias("first_of_month"),
        F.last_day(d).alias("last_of_month"),
        (F.date_diff(d, floor_month(d)) + 1).alias("day_of_month_seq"),
        fiscal_quarter(d, fiscal_start).alias("fiscal_quarter"),
        fiscal_year(d, fiscal_start).alias("fiscal_year"),
    )
