"""Ordered window functions that stay distributed when one group holds much of the data.

A plain window puts each group into one task. `ordered_window` looks at the largest group first.
Up to `wardflow.maxGroupRows` rows (with few groups: FEW_GROUPS_ROWS) the plain window is planned. Beyond it the rows are range
partitioned by (partition, order) into shards of equal size, written to the shared folder, and
each function is computed per shard and completed with what the earlier (or later) shards of the
same group hand over. Fewer than two hand-over rows per shard exist for groups that span shards,
so that table is broadcast whatever the data size. Both ways give the same rows.

The order has to be total (end in a unique key) for the row-order functions to be repeatable.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import ceil
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.session import max_broadcast_rows, max_group_rows, settle


# Keeps the number of shuffle blocks and of hand-over rows bounded however large the input is.
MAX_SHARDS = 20_000
# Fewer groups than tasks leave tasks idle, without keys all but one; so many rows one task sorts in about a second.
FEW_GROUPS_ROWS = 200_000


@dataclass(frozen=True)
class By:
    """One sort column: ascending puts NULLs last, descending puts them first."""

    name: str
    descending: bool = False
    nulls: str | None = None

    @property
    def column(self) -> Column:
        nulls = self.nulls or ("first" if self.descending else "last")
        direction = "desc" if self.descending else "asc"
        return getattr(F.col(self.name), f"{direction}_nulls_{nulls}")()


def asc(name: str, nulls: str | None = None) -> By:
    return By(name, False, nulls)


def desc(name: str, nulls: str | None = None) -> By:
    return By(name, True, nulls)


@dataclass(frozen=True)
class Calc:
    """One window function; build it with the functions below."""

    kind: str
    value: Column | None = None
    n: int = 0
    agg: str = ""


def row_number() -> Calc:
    return Calc("row_number")


def ntile(n: int) -> Calc:
    return Calc("ntile", n=n)


def lag(value: Column, n: int = 1) -> Calc:
    return Calc("lag", value, n)


def lead(value: Column, n: int = 1) -> Calc:
    return Calc("lead", value, n)


def running(agg: str, value: Column) -> Calc:
    """sum, count, avg, min or max from the first row of the group to this one."""
    return Calc("running", value, agg=agg)


def moving(agg: str, value: Column, preceding: int) -> Calc:
    """sum, count or avg over the `preceding` rows before and this one."""
    return Calc("moving", value, preceding, agg)


def first_of(value: Column) -> Calc:
    """Value of the first row of the group, NULL included."""
    return Calc("first", value)


def last_before(value: Column) -> Calc:
    """Last non-NULL value strictly before this row."""
    return Calc("last_before", value)


def total(agg: str, value: Column) -> Calc:
    """sum, count, avg, min or max over the whole group."""
    return Calc("total", value, agg=agg)


class Sizes(NamedTuple):
    """How a relation falls into groups."""

    rows: int
    groups: int
    largest: int


def group_sizes(df: DataFrame, keys: list[str]) -> Sizes:
    """Counts only, pre-aggregated before the shuffle. Operators with the same keys can share the result."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    row = counts.agg(F.sum("n"), F.count(F.lit(1)), F.max("n")).first()
    return Sizes(int(row[0] or 0), int(row[1] or 0), int(row[2] or 0))


def sizes_within(df: DataFrame, keys: list[str]) -> Sizes | None:
    """Sizes to share with operators whose keys contain `keys`, or None when a group is too large.

    Finer groups are no larger than coarse ones, so one count can settle all of them.
    """
    sizes = group_sizes(df, keys)
    return sizes if sizes.largest <= max_group_rows(df.sparkSession) else None


def ordered_window(
    df: DataFrame, partition: list[str], order: list[By], sizes: Sizes | None = None, **calcs: Calc
) -> DataFrame:
    """`df` with one column per entry of `calcs`."""
    sizes = sizes or group_sizes(df, partition)
    limit = _task_rows(df.sparkSession, sizes)
    if sizes.largest <= limit:
        return _plain(df, partition, order, calcs)
    return _sharded(df, partition, order, calcs, min(ceil(2 * sizes.rows / limit), MAX_SHARDS))


def _task_rows(spark: SparkSession, sizes: Sizes) -> int:
    """Rows of the largest group up to which its task takes no longer than the others."""
    limit = max_group_rows(spark)
    few = sizes.groups < int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(limit, FEW_GROUPS_ROWS) if few else limit


_AGGREGATES = {"sum": F.sum, "count": F.count, "avg": F.avg, "min": F.min, "max": F.max}


def _plain(df: DataFrame, partition: list[str], order: list[By], calcs: dict[str, Calc]) -> DataFrame:
    whole = Window.partitionBy(*partition)
    ordered = whole.orderBy(*[by.column for by in order])
    out = {}
    for name, calc in calcs.items():
        if calc.kind == "row_number":
            out[name] = F.row_number().over(ordered).cast("bigint")
        elif calc.kind == "ntile":
            out[name] = F.ntile(calc.n).over(ordered)
        elif calc.kind in ("lag", "lead"):
            out[name] = getattr(F, calc.kind)(calc.value, calc.n).over(ordered)
        elif calc.kind == "running":
            frame = ordered.rowsBetween(Window.unboundedPreceding, 0)
            out[name] = _AGGREGATES[calc.agg](calc.value).over(frame)
        elif calc.kind == "moving":
            out[name] = _AGGREGATES[calc.agg](calc.value).over(ordered.rowsBetween(-calc.n, 0))
        elif calc.kind == "first":
            out[name] = F.first(calc.value).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
        elif calc.kind == "last_before":
            frame = ordered.rowsBetween(Window.unboundedPreceding, -1)
            out[name] = F.last(calc.value, ignorenulls=True).over(frame)
        else:
            out[name] = _AGGREGATES[calc.agg](calc.value).over(whole)
    return df.withColumns(out)


def null_safe(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    """Equality on every pair of columns, NULL matching NULL."""
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs], F.lit(True))


def same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Equality on columns of the same names, NULL matching NULL."""
    return null_safe(left, right, [(k, k) for k in keys])


def _sharded(
    df: DataFrame, partition: list[str], order: list[By], calcs: dict[str, Calc], shards: int
) -> DataFrame:
    values = {f"__v_{name}": c.value for name, c in calcs.items() if c.value is not None}
    # Written out, because partition numbers must not change between the two uses below.
    placed = settle(
        df.withColumns(values)
        .repartitionByRange(shards, *[F.col(p) for p in partition], *[by.column for by in order])
        .withColumn("__shard", F.spark_partition_id())
    )
    here = Window.partitionBy(*partition, "__shard")
    local = here.orderBy(*[by.column for by in order])
    rows = placed.withColumns(
        {"__rn": F.row_number().over(local).cast("bigint"), "__cnt": F.count(F.lit(1)).over(here)}
    )

    carry = _carry(rows, partition, calcs)
    renamed = carry.select(
        *[F.col(p).alias(f"__k_{p}") for p in partition],
        F.col("__shard").alias("__k_shard"),
        *[c for c in carry.columns if c not in {*partition, "__shard"}],
    )
    pairs = [(p, f"__k_{p}") for p in partition] + [("__shard", "__k_shard")]
    joined = rows.join(F.broadcast(renamed), null_safe(rows, renamed, pairs), "left")
    done = {name: _complete(name, calc, placed, here, local) for name, calc in calcs.items()}
    return joined.withColumns(done).select(*[c for c in df.columns if c not in done], *done)


def _carry(rows: DataFrame, partition: list[str], calcs: dict[str, Calc]) -> DataFrame:
    """Per shard of a group that spans shards: what its neighbours hand over."""
    rn, cnt = F.col("__rn"), F.col("__cnt")
    edge = {"__n": F.count(F.lit(1))}
    for name, calc in calcs.items():
        v = F.col(f"__v_{name}") if calc.value is not None else None
        if calc.kind in ("running", "total"):
            edge |= {f"__s_{name}": F.sum(v)} if calc.agg in ("sum", "avg") else {}
            edge |= {f"__c_{name}": F.count(v)} if calc.agg in ("count", "avg") else {}
            edge |= {f"__m_{name}": _AGGREGATES[calc.agg](v)} if calc.agg in ("min", "max") else {}
        elif calc.kind in ("lag", "moving"):
            edge[f"__t_{name}"] = F.array_sort(
                F.collect_list(F.when(rn > cnt - calc.n, F.struct(rn.alias("r"), v.alias("v"))))
            )["v"]
        elif calc.kind == "lead":
            edge[f"__h_{name}"] = F.array_sort(
                F.collect_list(F.when(rn <= calc.n, F.struct(rn.alias("r"), v.alias("v"))))
            )["v"]
        elif calc.kind == "first":
            edge[f"__f_{name}"] = F.max(F.when(rn == 1, F.struct(v.alias("v"))))
        elif calc.kind == "last_before":
            edge[f"__l_{name}"] = F.max_by(v, F.when(v.isNotNull(), rn))
    edges = rows.groupBy(*partition, "__shard").agg(*[c.alias(n) for n, c in edge.items()])

    # One row per shard and group: at most `shards` rows in any of these windows.
    whole = Window.partitionBy(*partition)
    by_shard = whole.orderBy("__shard")
    earlier = by_shard.rowsBetween(Window.unboundedPreceding, -1)
    out = {
        "__spread": F.count(F.lit(1)).over(whole),
        "__off": F.coalesce(F.sum("__n").over(earlier), F.lit(0)),
        "__all": F.sum("__n").over(whole),
    }
    for name, calc in calcs.items():
        frame = earlier if calc.kind == "running" else whole
        if calc.kind in ("running", "total"):
            if calc.agg in ("sum", "avg"):
                out[f"__s_{name}"] = F.sum(f"__s_{name}").over(frame)
            if calc.agg in ("count", "avg"):
                out[f"__c_{name}"] = F.coalesce(F.sum(f"__c_{name}").over(frame), F.lit(0))
            if calc.agg in ("min", "max"):
                out[f"__m_{name}"] = _AGGREGATES[calc.agg](f"__m_{name}").over(frame)
        elif calc.kind in ("lag", "moving"):
            near = by_shard.rowsBetween(-calc.n, -1)
            out[f"__t_{name}"] = F.flatten(F.collect_list(f"__t_{name}").over(near))
        elif calc.kind == "lead":
            near = by_shard.rowsBetween(1, calc.n)
            out[f"__h_{name}"] = F.flatten(F.collect_list(f"__h_{name}").over(near))
        elif calc.kind == "first":
            full = by_shard.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            out[f"__f_{name}"] = F.first(f"__f_{name}").over(full)
        elif calc.kind == "last_before":
            out[f"__l_{name}"] = F.last(f"__l_{name}", ignorenulls=True).over(earlier)
    return edges.select(*partition, "__shard", *[c.alias(n) for n, c in out.items()]).filter("__spread > 1")


def _complete(name: str, calc: Calc, placed: DataFrame, here, local) -> Column:
    """The local result of a shard put together with what was handed over."""
    rn, cnt, spread = F.col("__rn"), F.col("__cnt"), F.col("__spread")
    position = rn + F.coalesce(F.col("__off"), F.lit(0))
    size = F.coalesce(F.col("__all"), cnt)
    v = F.col(f"__v_{name}")
    if calc.kind == "row_number":
        return position
    if calc.kind == "ntile":
        return tile(position, size, calc.n)
    if calc.kind == "lag":
        back = F.try_element_at(F.col(f"__t_{name}"), (rn - 1 - calc.n).cast("int"))
        return F.when(rn > calc.n, F.lag(v, calc.n).over(local)).otherwise(back)
    if calc.kind == "lead":
        ahead = F.try_element_at(F.col(f"__h_{name}"), (F.lit(calc.n) - (cnt - rn)).cast("int"))
        return F.when(cnt - rn >= calc.n, F.lead(v, calc.n).over(local)).otherwise(ahead)
    if calc.kind == "first":
        mine = F.first(v).over(local.rowsBetween(Window.unboundedPreceding, 0))
        return F.when(spread.isNull(), mine).otherwise(F.col(f"__f_{name}")["v"])
    if calc.kind == "last_before":
        mine = F.last(v, ignorenulls=True).over(local.rowsBetween(Window.unboundedPreceding, -1))
        return F.coalesce(mine, F.col(f"__l_{name}"))
    if calc.kind == "running":
        frame = local.rowsBetween(Window.unboundedPreceding, 0)
        if calc.agg in ("min", "max"):
            pick = F.least if calc.agg == "min" else F.greatest
            return pick(_AGGREGATES[calc.agg](v).over(frame), F.col(f"__m_{name}"))
        sums = _plus(F.sum(v).over(frame), F.col(f"__s_{name}")) if calc.agg != "count" else None
        counts = (
            F.count(v).over(frame) + F.coalesce(F.col(f"__c_{name}"), F.lit(0)) if calc.agg != "sum" else None
        )
        return _result(calc.agg, sums, counts, placed.schema[f"__v_{name}"].dataType)
    if calc.kind == "moving":
        frame = local.rowsBetween(-calc.n, 0)
        missing = (F.lit(calc.n + 1) - rn).cast("int")
        tail = F.col(f"__t_{name}")
        start = F.greatest(F.size(tail) - missing, F.lit(0)) + 1
        extra = F.when((rn <= calc.n) & tail.isNotNull(), F.slice(tail, start, missing))
        value_type = placed.schema[f"__v_{name}"].dataType
        kind = _sum_type(value_type)
        known = F.filter(extra, lambda x: x.isNotNull())
        extra_sum = F.when(
            F.size(known) > 0,
            F.aggregate(known, F.lit(0).cast(kind), lambda acc, x: (acc + x).cast(kind)),
        )
        sums = _plus(F.sum(v).over(frame), extra_sum)
        counts = F.count(v).over(frame) + F.coalesce(F.size(known), F.lit(0))
        return _result(calc.agg, sums, counts, value_type)
    # total
    if calc.agg == "avg":
        sums = F.coalesce(F.col(f"__s_{name}"), F.sum(v).over(here))
        counts = F.coalesce(F.col(f"__c_{name}"), F.count(v).over(here))
        return _result("avg", sums, counts, placed.schema[f"__v_{name}"].dataType)
    if calc.agg == "sum":
        sums = F.when(spread.isNull(), F.sum(v).over(here)).otherwise(F.col(f"__s_{name}"))
        return _result("sum", sums, None, placed.schema[f"__v_{name}"].dataType)
    handed = F.col(f"__c_{name}" if calc.agg == "count" else f"__m_{name}")
    return F.when(spread.isNull(), _AGGREGATES[calc.agg](v).over(here)).otherwise(handed)


def _plus(a: Column, b: Column) -> Column:
    return F.coalesce(a + b, a, b)


def _sum_type(kind: T.DataType) -> T.DataType:
    """The type of a sum of values of a type, as Spark has it."""
    if isinstance(kind, T.DecimalType):
        return T.DecimalType(min(kind.precision + 10, 38), kind.scale)
    return T.LongType() if isinstance(kind, T.IntegralType) else T.DoubleType()


def _result(agg: str, sums: Column | None, counts: Column | None, kind: T.DataType) -> Column:
    """Sum, count or average of values of type `kind`, in the type that the plain window gives."""
    if agg == "count":
        return counts
    sums = sums.cast(_sum_type(kind))
    if agg == "sum":
        return sums
    if isinstance(kind, T.DecimalType):
        mean = T.DecimalType(min(kind.precision + 4, 38), min(kind.scale + 4, 38))
        # A quotient of 38 digits would lose places; a sum that fits into 34 keeps four more than it has.
        short = sums.try_cast(T.DecimalType(min(kind.precision + 10, 34), kind.scale))
        count = counts.cast("decimal(20,0)")
        return F.coalesce(F.try_divide(short, count).cast(mean), F.try_divide(sums, count).cast(mean))
    return F.try_divide(sums.cast("double"), counts.cast("double"))


def tile(position: Column, size: Column, n: int) -> Column:
    """Tile of a row from its 1-based position: the first `size % n` tiles are one row longer."""
    small = F.floor(size / n)
    longer = size % n
    border = longer * (small + 1)
    # `greatest` only guards the branch that is not taken when there are fewer rows than tiles.
    return (
        F.when(position <= border, F.floor((position - 1) / (small + 1)) + 1)
        .otherwise(longer + F.floor((position - 1 - border) / F.greatest(small, F.lit(1))) + 1)
        .cast("int")
    )


def peer_ranks(
    df: DataFrame, partition: list[str], order: list[By], sizes: Sizes | None = None, **kinds: str
) -> DataFrame:
    """rank, dense_rank, percent_rank or cume_dist: rows with equal sort columns share the value.

    `kinds` maps output column to function name. Large groups are first counted down to one row
    per distinct sort value, those few rows are ranked, and the ranks are joined back.
    """
    sizes = sizes or group_sizes(df, partition)
    if sizes.largest <= _task_rows(df.sparkSession, sizes):
        w = Window.partitionBy(*partition).orderBy(*[by.column for by in order])
        return df.withColumns({name: getattr(F, kind)().over(w) for name, kind in kinds.items()})
    keys = [*partition, *[by.name for by in order]]
    peers = settle(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__peers")))
    ranked = ordered_window(
        peers, partition, order,
        __seq=row_number(),
        __upto=running("sum", F.col("__peers")),
        __size=total("sum", F.col("__peers")),
    )
    position = F.col("__upto") - F.col("__peers") + 1
    formulas = {
        "rank": position.cast("int"),
        "dense_rank": F.col("__seq").cast("int"),
        "percent_rank": F.when(F.col("__size") > 1, (position - 1) / (F.col("__size") - 1)).otherwise(F.lit(0.0)),
        "cume_dist": F.col("__upto") / F.col("__size"),
    }
    ranks = ranked.select(*keys, *[formulas[kind].alias(name) for name, kind in kinds.items()])
    return join_facts(df, ranks, keys, own_keys=True).select(*df.columns, *kinds)


def group_totals(df: DataFrame, keys: list[str], sizes: Sizes | None = None, **aggs: Column) -> DataFrame:
    """Every row with aggregates over its whole group.

    Few groups: aggregated and broadcast back, the rows are not shuffled. Many small groups: one
    window. Large groups: aggregated and joined back with their rows spread over tasks.
    """
    sizes = sizes or group_sizes(df, keys)
    spark = df.sparkSession
    if sizes.groups > max_broadcast_rows(spark) and sizes.largest <= max_group_rows(spark):
        w = Window.partitionBy(*keys)
        return df.withColumns({name: agg.over(w) for name, agg in aggs.items()})
    facts = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])
    return join_facts(df, facts, keys, sizes, own_keys=True).select(*df.columns, *aggs)


def join_facts(
    df: DataFrame, facts: DataFrame, keys: list[str], sizes: Sizes | None = None, own_keys: bool = False, how: str = "left"
) -> DataFrame:
    """Left (or inner) join of `facts`, one or a few rows per key, to all rows of that key, NULL keys included.

    `own_keys` says that `facts` holds no other keys than `df`; it is then broadcast while the
    counted keys stay under `wardflow.maxBroadcastRows`. Otherwise the join is left to the planner,
    and keys with more rows in `df` than one task should hold are spread by a salt. Fewer than
    `wardflow.maxBroadcastRows` such keys exist, because each holds more than that part of all rows.
    """
    spark = df.sparkSession
    sizes = sizes or group_sizes(df, keys)
    renamed = facts.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *[c for c in facts.columns if c not in keys])
    pairs = [(k, f"__k_{k}") for k in keys]
    if own_keys and sizes.groups <= max_broadcast_rows(spark):
        return df.join(F.broadcast(renamed), null_safe(df, renamed, pairs), how)
    limit = max(max_group_rows(spark), sizes.rows // max(max_broadcast_rows(spark), 1))
    if sizes.largest <= limit:
        return df.join(renamed, null_safe(df, renamed, pairs), how)
    salts = ceil(sizes.largest / limit) * 4
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > limit)
    hot = counts.select(*[F.col(k).alias(f"__h_{k}") for k in keys], F.lit(salts).alias("__salts"))

    def marked(side: DataFrame, columns: list[str]) -> DataFrame:
        same = null_safe(side, hot, [(c, f"__h_{k}") for c, k in zip(columns, keys, strict=True)])
        return side.join(F.broadcast(hot), same, "left").drop(*[f"__h_{k}" for k in keys])

    # By place, not by value: equal rows of a hot key must part too. Written out first, so that a task
    # that is run again deals its rows to the same salts.
    left = marked(settle(df), keys)
    spread = F.pmod(F.monotonically_increasing_id(), F.col("__salts")).cast("int")
    left = left.withColumn("__salt", F.coalesce(spread, F.lit(0))).drop("__salts")
    copies = F.sequence(F.lit(0), F.coalesce(F.col("__salts"), F.lit(1)) - 1)
    right = marked(renamed, [f"__k_{k}" for k in keys]).withColumn("__k_salt", F.explode(copies)).drop("__salts")
    return left.join(right, null_safe(left, right, [*pairs, ("__salt", "__k_salt")]), how)
