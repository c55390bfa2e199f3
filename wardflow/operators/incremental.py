"""Incremental upserts and history tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions import surrogate_key, text_of
from wardflow.operators.ordered import By, asc, lead, ordered_window, same_keys
from wardflow.operators.relational import arrived_since, latest_by, since
from wardflow.session import settle
from wardflow.sources.tables import KeyedTable


def high_mark(df: DataFrame, column: str):
    """Highest value of a column as text that casts back to it."""
    return df.agg(F.max(column).cast("string")).first()[0]


def merge_upsert(
    table: KeyedTable,
    source: DataFrame,
    watermark: str,
    order: list[By],
    build: Callable[[DataFrame], DataFrame],
    late: int = 0,
) -> DataFrame:
    """Take the source rows past the table's mark, build target rows, keep one per key, upsert.

    The mark is the highest *source* value consumed. Comparing source times with the load time of
    the target would lose every row that arrives late. Rows at the mark, and up to `late` behind it, are
    looked at again: those that differ from what the table holds take its place, equal ones cost no write.
    Of the rows looked at, the first in `order` stands for its key.
    """
    seen = arrived_since(source, watermark, table.watermark(), late)
    table.merge(latest_by(build(seen), table.keys, order), high_mark(seen, watermark))
    return table.read()


def merge_aggregate(
    table: KeyedTable,
    source: DataFrame,
    watermark: str,
    groups: list[str],
    build: Callable[[DataFrame], DataFrame],
    late: int = 0,
) -> DataFrame:
    """Replace what is computed from whole groups: groups touched by new rows are built again from all their rows.

    Building from the new rows alone would overwrite a group's total, or its ranks, with those of a part of
    it. Groups with rows at the mark, or up to `late` behind it, count as touched. If the table is keyed by
    the groups, a group may have many rows; it is replaced as a whole, and rows that vanished go.
    """
    old = table.watermark()
    fresh = arrived_since(source, watermark, old, late)
    looked_at = since(source, watermark, old, late)
    mark, every = source.agg(
        F.max(F.when(looked_at, F.col(watermark))).cast("string"),
        F.coalesce(F.min(F.coalesce(looked_at, F.lit(False))), F.lit(False)),
    ).first()
    if mark is None and table.exists():
        return table.read()
    if old is None:
        table.merge(build(source), mark)
        return table.read()
    keyed = set(groups) == set(table.keys)
    # Where no row lies before what is looked at, all rows are those of touched groups.
    touched = settle(fresh.select(*groups).distinct()) if keyed or not every else None
    affected = source if every else source.join(touched, same_keys(source, touched, groups), "left_semi")
    table.merge(build(affected), mark, touched if keyed else None)
    return table.read()


def scd2_snapshot(history: DataFrame | None, current: DataFrame, key: str, check: list[str], as_of: Column) -> DataFrame:
    """History of a changing relation: a change in a checked column closes the open row and opens one.

    `current` holds one row per key. Columns added: valid_from, valid_to (NULL while open), row_id.
    Keys that vanish from `current` keep their open row.
    """
    names = current.columns
    opened = [F.col(c) for c in names] + [
        as_of.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        surrogate_key(F.col(key), text_of(as_of)).alias("row_id"),
    ]
    if history is None:
        return current.select(*opened)
    columns = [*names, "valid_from", "valid_to", "row_id"]
    closed = history.filter(F.col("valid_to").isNotNull()).select(*columns)
    live = history.filter(F.col("valid_to").isNull())
    old = live.select(F.col(key).alias("__old_key"), F.struct(*columns).alias("__old"))
    new = current.select(F.col(key).alias("__new_key"), F.struct(*opened).alias("__new"))
    both = old.join(new, F.col("__old_key") == F.col("__new_key"), "full_outer")
    changed = F.lit(False)
    for column in check:
        changed = changed | ~F.col(f"__old.{column}").eqNullSafe(F.col(f"__new.{column}"))
    ended = F.col("__old").withField("valid_to", as_of)
    rows = (
        F.when(F.col("__new").isNull(), F.array("__old"))
        .when(F.col("__old").isNull(), F.array("__new"))
        .when(changed, F.array(ended, F.col("__new")))
        .otherwise(F.array("__old"))
    )
    return both.select(F.explode(rows).alias("r")).select("r.*").unionByName(closed)


def scd2_from_log(df: DataFrame, key: str, ts: str, tie_break: list[str]) -> DataFrame:
    """Validity from an append-only log: a version ends where the next one of its key begins."""
    order = [asc(ts), *[asc(t) for t in tie_break]]
    with_end = ordered_window(df, [key], order, valid_to=lead(F.col(ts)), __next=lead(F.lit(1)))
    return with_end.select(
        *df.columns, F.col(ts).alias("valid_from"), "valid_to", F.col("__next").isNull().alias("is_current")
    )


def current_dimension(df: DataFrame, key: str, hash_columns: list[str], valid_from: str, valid_to: str) -> DataFrame:
    """Dimension in which every row is current, with a surrogate key and a hash of tracked columns."""
    return df.select(
        surrogate_key(F.col(key)).alias(f"{key.removesuffix('_id')}_key"),
        *[c for c in df.columns if c != valid_from],
        F.col(valid_from).alias("valid_from"),
        F.lit(valid_to).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
        surrogate_key(*[F.col(c) for c in hash_columns]).alias("row_hash"),
    )
