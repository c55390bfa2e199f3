"""Row features: flags, hashes, watch lists, note parsing, rate cards and alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions import find_group, find_text, hash_bucket, lookup
from wardflow.operators.aggregates import sorted_set
from wardflow.operators.ordered import By, asc, desc, first_of, group_sizes, ordered_window, peer_ranks, total
from wardflow.operators.relational import latest_by, share_of_total


def encode_flags(conditions: list[Column]) -> Column:
    """Condition i sets bit i."""
    flags = F.lit(0)
    for bit, condition in enumerate(conditions):
        flags = flags.bitwiseOR(F.when(condition, F.shiftleft(F.lit(1), bit)).otherwise(F.lit(0)))
    return flags


def has_flag(flags: Column, bit: int) -> Column:
    return flags.bitwiseAND(F.lit(1 << bit)) > 0


def count_flags(flags: Column) -> Column:
    return F.bit_count(flags)


def hash_dedup(df: DataFrame, key: Column, order: list[By]) -> DataFrame:
    """One row per key hash, the first in order."""
    return latest_by(df.withColumn("__hash", key), ["__hash"], order).drop("__hash")


def buckets(df: DataFrame, columns: dict[str, tuple[str, int]]) -> DataFrame:
    """New name -> (column, number of buckets)."""
    return df.withColumns({name: hash_bucket(F.col(c), n) for name, (c, n) in columns.items()})


def watchlist_overlap(df: DataFrame, entity: str, items: dict[str, str], lists: dict[str, tuple[str, list[str]]]) -> DataFrame:
    """Distinct items per entity and their overlap with fixed lists.

    `items` maps a new array name to its column; `lists` maps a new name to (array, watched values).
    """
    # Overlaps come from the rows, so they hold no more than the watched values however many items there are.
    overlaps = [
        sorted_set(F.when(F.col(items[source]).isin(values), F.col(items[source]))).alias(name)
        for name, (source, values) in lists.items()
    ]
    return df.groupBy(entity).agg(*[sorted_set(column).alias(name) for name, column in items.items()], *overlaps)


def note_features(text: Column, terms: str, values: dict[str, str], classes: list[tuple[str, str]], short: str) -> dict:
    """Columns found in a free-text note: terms, captured values, class, abbreviations, sizes.

    Patterns are searched anywhere in the note. `values` maps names to patterns with one group;
    `classes` lists (pattern, label), the first hit wins.
    """
    label = F.lit("General")
    for pattern, name in reversed(classes):
        label = F.when(text.rlike(f"(?i){pattern}"), name).otherwise(label)
    return {
        "first_med_mention": find_text(text, f"(?i){terms}"),
        "med_mention_count": F.regexp_count(text, F.lit(f"(?i){terms}")),
        **{name: find_group(text, pattern) for name, pattern in values.items()},
        "note_classification": label,
        "first_abbreviation": find_text(text, short),
        "abbreviation_count": F.regexp_count(text, F.lit(r"\b[A-Z]{2,5}\b")),
        "word_count": F.array_size(F.split(text, " ")),
        "char_count": F.length(text),
    }


def rate_card(df: DataFrame, cards: dict[str, tuple[str, dict[str, str], str]], days: int) -> DataFrame:
    """Daily rates by tier, their sum, a projection over `days`, a JSON detail and the share of all.

    `cards` maps a component to (tier column, {tier: rate}, default rate); rates are decimal text.
    """
    def money(value: str) -> Column:
        return F.lit(value).cast("decimal(10,2)")

    rated = df.withColumns(
        {
            f"{name}_rate": lookup(F.col(tier), {k: money(v) for k, v in card.items()}, money(default))
            for name, (tier, card, default) in cards.items()
        }
    )
    per_day = sum((F.col(f"{name}_rate") for name in cards), F.lit(0).cast("decimal(10,2)"))
    detail = [
        F.struct(F.col(tier).alias("tier"), F.col(f"{name}_rate").alias("rate")).alias(name)
        for name, (tier, _, _) in cards.items()
    ]
    priced = rated.withColumn("total_per_diem", per_day.cast("decimal(12,2)"))
    priced = priced.withColumns(
        {
            "projected_monthly_revenue": (F.col("total_per_diem") * days).cast("decimal(16,2)"),
            "pdpm_detail_json": F.to_json(F.struct(*detail, F.col("total_per_diem").alias("total"))),
        }
    )
    return share_of_total(priced, revenue_share="total_per_diem")


def unify_alerts(alerts: DataFrame, entity: str, priority: str, ts: str, message: str, tie_break: list[str]) -> DataFrame:
    """Alerts of one entity ranked by priority and recency, with their number and the worst one."""
    order = [asc(priority), desc(ts)]
    sizes = group_sizes(alerts, [entity])
    whole = ordered_window(
        alerts, [entity], [*order, *[asc(t) for t in tie_break]], sizes,
        total_patient_alerts=total("count", F.lit(1)),
        most_critical_alert=first_of(F.col(message)),
    )
    return peer_ranks(whole, [entity], order, sizes, alert_rank="dense_rank")


def rule_points(value: Column, steps: list[tuple[int, int]], default: int) -> Column:
    """Points of the first (threshold, points) step that the value exceeds."""
    points = F.lit(default)
    for threshold, worth in reversed(steps):
        points = F.when(value > threshold, worth).otherwise(points)
    return points
