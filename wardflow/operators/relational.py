"""Joins, deduplication, shares and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.functions import share
from wardflow.operators.ordered import By, join_facts, null_safe


def top_k_per_group(df: DataFrame, keys: list[str], order: list[By], k: int) -> DataFrame:
    """The first k rows of each group.

    Spark limits each map task to k rows per group before the shuffle, so a large group is cheap.
    """
    w = Window.partitionBy(*keys).orderBy(*[by.column for by in order])
    return df.withColumn("__rank", F.row_number().over(w)).filter(F.col("__rank") <= k).drop("__rank")


def latest_by(df: DataFrame, keys: list[str], order: list[By]) -> DataFrame:
    """The first row of each group."""
    return top_k_per_group(df, keys, order, 1)


def fan_in(base: DataFrame, sides: list[DataFrame], key: str) -> DataFrame:
    """Left joins of sides that have one row per key; the sides are put together first."""
    known = [side.filter(F.col(key).isNotNull()) for side in sides]
    facts = reduce(lambda left, right: left.join(right, key, "full_outer"), known)
    columns = [c for c in facts.columns if c != key]
    return join_facts(base, facts, [key]).select(*base.columns, *columns)


def left_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join in which NULL keys match each other; for two results of the same grain."""
    renamed = right.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    joined = left.join(renamed, null_safe(left, renamed, [(k, f"__k_{k}") for k in keys]), "left")
    return joined.drop(*[f"__k_{k}" for k in keys])


def share_of_total(df: DataFrame, **shares: str) -> DataFrame:
    """New column -> share of that column in its grand total; the one-row total is broadcast."""
    total = df.agg(*[F.sum(c).alias(f"__total_{n}") for n, c in shares.items()])
    joined = df.crossJoin(F.broadcast(total))
    out = {n: share(F.col(c), F.col(f"__total_{n}")) for n, c in shares.items()}
    return joined.withColumns(out).drop(*[f"__total_{n}" for n in shares])


def union_all(*feeds: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, feeds)


def densify(entities: DataFrame, points: Column, point: str) -> DataFrame:
    """Every entity with every point of a bounded spine."""
    return entities.select("*", F.explode(points).alias(point))


def newer_than(df: DataFrame, column: str, watermark) -> DataFrame:
    """Rows past the high-water mark; all rows when there is none yet."""
    if watermark is None:
        return df
    mark = F.lit(str(watermark)).cast(df.schema[column].dataType)
    return df.filter(F.col(column) > mark)


def arrived_since(df: DataFrame, column: str, watermark, late: int = 0) -> DataFrame:
    """Rows at or past the high-water mark less `late` (days of a date or time, else plain units).

    Rows at the mark may have come after it was taken; what may come later still is for `late` to say.
    """
    return df if watermark is None else df.filter(since(df, column, watermark, late))


def since(df: DataFrame, column: str, watermark, late: int = 0) -> Column:
    """The condition of `arrived_since`; without a mark it holds for every row."""
    if watermark is None:
        return F.lit(True)
    kind = df.schema[column].dataType
    mark = F.lit(str(watermark)).cast(kind)
    if kind.typeName() in ("date", "timestamp", "timestamp_ntz"):
        start = mark - F.make_dt_interval(F.lit(late))
    else:
        start = mark - F.lit(late) if late else mark
    return F.col(column) >= start
