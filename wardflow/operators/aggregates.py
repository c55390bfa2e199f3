"""Grouped results beyond a plain groupBy."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.operators.ordered import Sizes, asc, group_sizes, ordered_window, row_number, running, total
from wardflow.operators.relational import left_null_safe
from wardflow.session import max_group_rows, settle


def grouped(
    df: DataFrame,
    keys: list[str],
    aggs: dict[str, Column],
    percentiles: dict[str, tuple[str, float]] | None = None,
) -> DataFrame:
    """groupBy with exact interpolated percentiles: `percentiles` maps a name to (column, fraction).

    Percentiles are read from counted values, at every size, all columns and fractions in one go: no
    task holds the distinct values of a group.
    """
    percentiles = percentiles or {}
    plain = [c.alias(n) for n, c in aggs.items()]
    if not percentiles:
        return df.groupBy(*keys).agg(*plain)
    out = df.groupBy(*keys).agg(*plain) if plain else df.select(*keys).distinct()
    counts = settle(_value_counts(df, keys, percentiles))
    out = left_null_safe(out, percentiles_from_counts(counts, keys, percentiles), keys)
    return out.select(*keys, *aggs, *percentiles)


def _value_counts(df: DataFrame, keys: list[str], percentiles: dict[str, tuple[str, float]]) -> DataFrame:
    """(keys, __c, __v, __n): how often each value stands in each column that percentiles are asked of."""
    names = list(dict.fromkeys(c for c, _ in percentiles.values()))
    # All values in one column, so that the input is read once more and not once per column.
    pairs = F.array(*[F.struct(F.lit(c).alias("__c"), F.col(c).cast("double").alias("__v")) for c in names])
    values = df.select(*keys, F.explode(pairs).alias("__p")).select(*keys, "__p.*").filter(F.col("__v").isNotNull())
    return values.groupBy(*keys, "__c", "__v").agg(F.count(F.lit(1)).alias("__n"))


def percentiles_from_counts(counts: DataFrame, keys: list[str], percentiles: dict[str, tuple[str, float]]) -> DataFrame:
    """Interpolated percentiles from (keys, __c, __v, __n) rows: the two values around each position."""
    placed = ordered_window(
        counts, [*keys, "__c"], [asc("__v")],
        __upto=running("sum", F.col("__n")),
        __all=total("sum", F.col("__n")),
    )
    picks, finals = [], []
    for name, (column, p) in percentiles.items():
        mine = F.col("__c") == column
        position = F.lit(float(p)) * (F.col("__all") - 1)
        holds = lambda at: mine & (F.col("__upto") > at) & (F.col("__upto") - F.col("__n") <= at)  # noqa: B023, E731
        picks += [
            F.max(F.when(holds(F.floor(position)), F.col("__v"))).alias(f"__lo_{name}"),
            F.max(F.when(holds(F.ceil(position)), F.col("__v"))).alias(f"__hi_{name}"),
            F.max(F.when(mine, position - F.floor(position))).alias(f"__w_{name}"),
        ]
        low, high, weight = F.col(f"__lo_{name}"), F.col(f"__hi_{name}"), F.col(f"__w_{name}")
        finals.append((low + (high - low) * weight).alias(name))
    return placed.groupBy(*keys).agg(*picks).select(*keys, *finals)


Measure = tuple[str, Column | None]


def grouping_sets(
    df: DataFrame,
    columns: list[str],
    sets: Sequence[Sequence[str]],
    measures: dict[str, Measure],
    percentiles: dict[str, tuple[str, float]] | None = None,
) -> DataFrame:
    """Several levels of totals in one result, with `is_total_<column>` flags and `level` (grouping id).

    Measures are ("count", None), ("sum", c), ("avg", c) or ("count_if", predicate). Rows are first
    aggregated once to the finest level; only that small result is multiplied by the sets. So are
    the value counts that percentiles are read from.
    """
    percentiles = percentiles or {}
    flags = [F.grouping(c).cast("int").alias(f"is_total_{c}") for c in columns]
    level = F.grouping_id(*columns).alias("level")
    levels = [list(s) for s in sets]
    partial, final = [], []
    for name, (kind, column) in measures.items():
        if kind == "count":
            partial.append(F.count(F.lit(1)).alias(f"__c_{name}"))
            final.append(F.sum(f"__c_{name}").alias(name))
        elif kind == "count_if":
            partial.append(F.count_if(column).alias(f"__c_{name}"))
            final.append(F.sum(f"__c_{name}").alias(name))
        else:
            partial.append(F.sum(column).alias(f"__s_{name}"))
            if kind == "avg":
                partial.append(F.count(column).alias(f"__c_{name}"))
                final.append(F.try_divide(F.sum(f"__s_{name}"), F.sum(f"__c_{name}").cast("double")).alias(name))
            else:
                final.append(F.sum(f"__s_{name}").alias(name))
    finest = df.groupBy(*columns).agg(*partial)
    out = finest.groupingSets(levels, *columns).agg(*final, *flags, level)
    if not percentiles:
        return out
    counts = _value_counts(df, columns, percentiles).groupingSets([[*s, "__c", "__v"] for s in levels], *columns, "__c", "__v").agg(
        F.sum("__n").alias("__n"), F.grouping_id(*columns, "__c", "__v").alias("__id")
    )
    counts = settle(counts.withColumn("level", F.shiftright("__id", 2)).drop("__id"))
    return left_null_safe(out, percentiles_from_counts(counts, [*columns, "level"], percentiles), [*columns, "level"])


def pivot_sum(df: DataFrame, keys: list[str], column: str, names: dict[str, str], value: Column) -> DataFrame:
    """Literal values of `column` become output columns; NULL where a group has no such row.

    Conditional sums need one shuffle on the keys, with partial sums before it.
    """
    return df.groupBy(*keys).agg(*[F.sum(F.when(F.col(column) == v, value)).alias(n) for v, n in names.items()])


def unpivot(df: DataFrame, ids: list[str], columns: list[str], name: str, value: str) -> DataFrame:
    """Columns to rows; NULL values give no row."""
    return df.unpivot(ids, columns, name, value).filter(F.col(value).isNotNull())


def histogram(
    df: DataFrame, keys: list[str], column: str, low: float, high: float, bars: int, bucket: str, **aggs: Column
) -> DataFrame:
    """Equal-width buckets 1..bars; 0 below the range, bars+1 from its end on."""
    number = F.width_bucket(F.col(column).cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(bars))
    return df.withColumn(bucket, number.cast("int")).groupBy(*keys, bucket).agg(*[c.alias(a) for a, c in aggs.items()])


def sorted_set(column: Column | str) -> Column:
    """Distinct values in order; for columns with a bounded vocabulary."""
    return F.array_sort(F.collect_set(column))


def joined_set(column: Column | str, separator: str) -> Column:
    return F.array_join(sorted_set(column), separator)


#: Members that one task sorts as objects; a longer list is put together from sorted pieces of so many members.
LIST_ROWS = 200_000
PIECE_ROWS = 10_000
#: Members that one task gathers into whole lists: few enough to be sorted and joined further on without spilling.
DEALT_ROWS = 250_000


def _dealt(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """Shuffled by key, to more tasks the more rows there are.

    The adaptive plan goes by compressed bytes, and a session's number of partitions is fixed: either lets the
    rows of one task outgrow its memory.
    """
    by, parts = [F.col(k) for k in keys], math.ceil(rows / DEALT_ROWS)
    return df.repartition(parts, *by) if parts > df.sparkSession.sparkContext.defaultParallelism else df.repartition(*by)


def ordered_list(
    df: DataFrame, keys: list[str], order: list[str], item: Column | None, name: str, sizes: Sizes | None = None
) -> DataFrame:
    """One row per group with all its items, ordered, as `name`; NULLs in the order come last, ties go by item.

    Without `item`, the items are structs of the columns in `order`, which then travel once. A group always
    has one row, so totals joined to it are never repeated. The list is one cell, whole, whatever its length.
    Members of long lists are numbered by sharded windows and gathered in pieces; one task then holds the
    pieces of one list, packed, and nothing else of it. Keep the member relation itself where even that is
    too much.
    """
    sizes = sizes or group_sizes(df, keys)
    limit = min(LIST_ROWS, max_group_rows(df.sparkSession))
    if sizes.largest <= limit:
        carried = [F.col(o).alias(f"o{i}") for i, o in enumerate(order)]
        packed = df.select(*keys, F.struct(*carried, *([] if item is None else [item.alias("item")])).alias("__e"))
        # Lists are no smaller than their members: gathered before the shuffle, each map task would sort its
        # whole input by key. Dealt out by key first, a task sorts one partition. NULL marks are added there.
        dealt = _dealt(packed, keys, sizes.rows) if keys else packed
        lists = dealt.groupBy(*keys).agg(F.collect_list("__e").alias("__l"))

        def sortable(e: Column) -> Column:
            values = [c for i in range(len(order)) for c in (e[f"o{i}"].isNull().alias(f"n{i}"), e[f"o{i}"].alias(f"o{i}"))]
            return F.struct(*values, *([] if item is None else [e["item"].alias("item")]))

        def shown(e: Column) -> Column:
            return F.struct(*[e[f"o{i}"].alias(o) for i, o in enumerate(order)]) if item is None else e["item"]

        ordered = F.array_sort(F.transform("__l", sortable))
        return lists.select(*keys, F.transform(ordered, shown).alias(name))
    item = F.struct(*order) if item is None else item
    members = df.select(*keys, *[F.col(o).alias(f"__o{i}") for i, o in enumerate(order)], item.alias("__item"))
    by = [*[asc(f"__o{i}") for i in range(len(order))], asc("__item", "first")]
    numbered = ordered_window(members, keys, by, Sizes(sizes.rows, sizes.groups, sizes.largest), __at=row_number())
    pieces = numbered.groupBy(*keys, F.floor((F.col("__at") - 1) / min(PIECE_ROWS, limit)).alias("__piece")).agg(
        F.array_sort(F.collect_list(F.struct("__at", "__item")))["__item"].alias("__items")
    )
    whole = F.flatten(F.array_sort(F.collect_list(F.struct("__piece", "__items")))["__items"])
    return settle(pieces).groupBy(*keys).agg(whole.alias(name))
