"""Time-series composites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions import boundary_diff, div0null, floor_day, floor_hour, iff, zero_if_null
from wardflow.operators.ordered import (
    By,
    Sizes,
    asc,
    desc,
    group_sizes,
    join_facts,
    lag,
    last_before,
    lead,
    moving,
    ordered_window,
    peer_ranks,
    row_number,
    running,
    total,
)
from wardflow.operators.relational import densify
from wardflow.session import max_group_rows, settle
from wardflow.sources.generators import time_points


def densify_forecast(
    counts: DataFrame, entity: str, day: str, count: str, today: Column, back: int = 90, forward: int = 30
) -> DataFrame:
    """Daily counts per entity on a gapless spine, with 7- and 30-day means as forecast."""
    counts = settle(counts)
    entities = counts.select(entity).distinct().filter(F.col(entity).isNotNull())
    spine = densify(entities, time_points(F.date_sub(today, back), back + forward, "day"), "forecast_date")
    facts = counts.select(entity, F.col(day).alias("forecast_date"), F.col(count).alias("__n"))
    filled = spine.join(facts, [entity, "forecast_date"], "left").withColumn("actual_count", zero_if_null(F.col("__n")))
    means = ordered_window(
        filled.drop("__n"), [entity], [asc("forecast_date")],
        m7=moving("avg", F.col("actual_count"), 6),
        m30=moving("avg", F.col("actual_count"), 29),
    )
    return means.select(
        entity,
        "forecast_date",
        "actual_count",
        F.round("m7", 1).alias("forecast_7d"),
        F.round("m30", 1).alias("forecast_30d"),
        (F.col("forecast_date") > today).alias("is_forecast"),
        (F.col("actual_count") - F.round("m7", 0)).alias("variance_from_forecast"),
    )


def detect_gaps(
    readings: DataFrame, entity: str, ts: str, value: str, now: Column, days: int = 7, warn: int = 2, critical: int = 4,
    ignore_nulls: bool = False,
) -> DataFrame:
    """Hourly slots of the last days per entity, with missing ones flagged.

    The spine starts on a full hour, so that slots can equal truncated reading times. "Previous
    reading" is the slot just before; with `ignore_nulls` it is the last slot that has a reading.
    """
    recent = readings.filter(F.col(ts) >= F.date_sub(F.to_date(now), days))
    hourly = recent.groupBy(entity, floor_hour(F.col(ts)).alias("expected_time")).agg(
        F.count(F.lit(1)).alias("reading_count"), F.avg(value).alias("avg_hr")
    )
    hourly = settle(hourly)
    start = floor_hour(now) - F.make_dt_interval(F.lit(days))
    spine = densify(hourly.select(entity).distinct(), time_points(start, days * 24, "hour"), "expected_time")
    slots = spine.join(hourly, [entity, "expected_time"], "left").withColumn(
        "is_gap", F.col("reading_count").isNull()
    )
    seen = F.when(~F.col("is_gap"), F.col("expected_time"))
    placed = ordered_window(
        slots, [entity], [asc("expected_time")],
        __prev=last_before(seen) if ignore_nulls else lag(seen),
        consecutive_gaps=moving("sum", F.col("is_gap").cast("int"), 3),
    )
    since_last = boundary_diff("hour", F.col("__prev"), F.col("expected_time"))
    return placed.withColumn("hours_since_last", since_last).select(
        entity,
        "expected_time",
        "is_gap",
        "hours_since_last",
        zero_if_null(F.col("reading_count")).alias("readings_in_window"),
        "avg_hr",
        iff(
            F.col("hours_since_last") > critical, "CRITICAL_GAP",
            iff(F.col("hours_since_last") > warn, "WARNING_GAP", "OK"),
        ).alias("gap_severity"),
        "consecutive_gaps",
    )


def rolling_daily(events: DataFrame, entity: str, ts: str, critical: Column, value: str) -> DataFrame:
    """Daily counts per entity with rolling, cumulative and week-over-week figures (over days with rows)."""
    daily = events.groupBy(entity, floor_day(F.col(ts)).alias("event_date")).agg(
        F.count(F.lit(1)).alias("daily_event_count"),
        F.count_if(critical).alias("daily_critical"),
        F.avg(value).alias("avg_resolution"),
    )
    daily = settle(daily)
    n = F.col("daily_event_count")
    sizes = group_sizes(daily, [entity])
    rolled = ordered_window(
        daily, [entity], [asc("event_date")], sizes,
        rolling_7d_avg_events=moving("avg", n, 6),
        rolling_30d_critical_sum=moving("sum", F.col("daily_critical"), 29),
        __week_ago=lag(n, 7),
        cumulative_events=running("sum", n),
    )
    ranked = peer_ranks(rolled, [entity], [desc("daily_event_count")], sizes, busiest_day_rank="rank")
    return ranked.withColumn("week_over_week_change", n - F.col("__week_ago")).drop("__week_ago")


def count_within(
    df: DataFrame, keys: list[str], ts: str, seconds: int, condition: Column, name: str, sizes: Sizes | None = None
) -> DataFrame:
    """Rows of the group that meet `condition` within `seconds` up to each row's time, ties included.

    The count at a moment minus the count just before the start of its range: both only grow, so a row is
    looked at twice however many rows lie within a range. Large groups use running counts over distinct times.
    """
    sizes = sizes or group_sizes(df, keys)
    if sizes.largest <= max_group_rows(df.sparkSession):
        by = ", ".join(f"`{k}`" for k in keys)
        marked = df.withColumn("__hit", F.coalesce(condition, F.lit(False)))
        upto = f"count_if(__hit) OVER (PARTITION BY {by} ORDER BY `{ts}` ASC NULLS LAST RANGE BETWEEN UNBOUNDED PRECEDING AND "
        # Times are in microseconds: the next one before the range.
        counted = f"{upto} CURRENT ROW) - {upto} INTERVAL '{seconds}.000001' SECOND PRECEDING)"
        # Rows without a time form a range of their own.
        timeless = f"count_if(__hit AND `{ts}` IS NULL) OVER (PARTITION BY {by})"
        return marked.withColumn(name, F.expr(f"if(`{ts}` IS NULL, {timeless}, {counted})")).drop("__hit")
    times = df.groupBy(*keys, ts).agg(F.count_if(condition).alias("__n"))
    width = F.make_dt_interval(secs=F.lit(seconds))
    ends = times.select(*keys, ts, F.col(ts).alias("__at"), F.lit(1).alias("__end"), "__n")
    starts = times.select(
        *keys, ts, (F.col(ts) - width).alias("__at"), F.lit(0).alias("__end"),
        F.lit(0).cast("bigint").alias("__n"),
    )
    order = [asc("__at"), asc("__end"), asc(ts)]
    marks = settle(ends.unionByName(starts))
    summed = ordered_window(marks, keys, order, __run=running("sum", F.col("__n")))
    per_time = summed.groupBy(*keys, ts).agg(
        # Rows without a time form a range of their own.
        F.when(F.col(ts).isNull(), F.sum("__n"))
        .otherwise(
            F.max(F.when(F.col("__end") == 1, F.col("__run"))) - F.max(F.when(F.col("__end") == 0, F.col("__run")))
        )
        .alias(name),
    )
    return join_facts(df, per_time, [*keys, ts], own_keys=True).select(*df.columns, name)


def return_intervals(df: DataFrame, entity: str, start: str, end: str, tie_break: str, carried: dict[str, str]) -> DataFrame:
    """Visits in order with what came before and after; `carried` maps new names to lagged columns."""
    visits = ordered_window(
        df, [entity], [asc(start), asc(tie_break)],
        encounter_seq=row_number(),
        prev_discharge=lag(F.col(end)),
        **{name: lag(F.col(column)) for name, column in carried.items()},
        next_admit=lead(F.col(start)),
        total_encounters=total("count", F.lit(1)),
    )
    gap = boundary_diff("day", F.col("prev_discharge"), F.col(start))
    ahead = boundary_diff("day", F.col(end), F.col("next_admit"))
    days = F.col("days_since_last_discharge")
    return visits.withColumn("days_since_last_discharge", gap).withColumns(
        {
            "is_30_day_readmission": iff(days <= 30, True, False),
            "is_7_day_readmission": iff(days <= 7, True, False),
            "will_readmit_30d": iff(F.col("next_admit").isNotNull() & (ahead <= 30), True, False),
            "readmission_risk_level": F.when(days <= 7, "Very High Risk")
            .when(days <= 14, "High Risk")
            .when(days <= 30, "Moderate Risk")
            .otherwise("Low Risk"),
        }
    )


def adherence(df: DataFrame, entity: str, item: str, day: str, tie_break: str) -> DataFrame:
    """Gaps between successive fills of an item."""
    fills = ordered_window(
        df, [entity, item], [asc(day), asc(tie_break)],
        fill_number=row_number(),
        prev_fill_date=lag(F.col(day)),
        total_fills=total("count", F.lit(1)),
    )
    gap = F.col("days_between_fills")
    return fills.withColumn(
        "days_between_fills", boundary_diff("day", F.col("prev_fill_date"), F.col(day))
    ).withColumns(
        {
            "is_gap": iff(gap > 30, True, False),
            "is_lapse": iff(gap > 90, True, False),
            "adherence_status": F.when(gap.isNull(), "FIRST_FILL")
            .when(gap <= 35, "ADHERENT")
            .when(gap <= 90, "PARTIAL")
            .otherwise("NON_ADHERENT"),
        }
    )


def trend_states(df: DataFrame, keys: list[str], ts: str, tie_break: str, value: str, low: str, high: str) -> DataFrame:
    """Each series' last reading of the day with its trend; neighbours are taken over all readings."""
    order: list[By] = [asc(ts), asc(tie_break)]
    v, lo, hi = F.col(value), F.col(low), F.col(high)
    day = F.to_date(F.col(ts))
    seen = ordered_window(
        df, keys, order,
        result_seq=row_number(),
        prev_value=lag(v),
        next_value=lead(v),
        moving_avg_3=moving("avg", v, 2),
        min_value=total("min", v),
        max_value=total("max", v),
        total_readings=total("count", F.lit(1)),
        __next_day=lead(F.struct(day.alias("d"))),
    )
    # The last row of a day is the one whose successor lies on another day.
    last = F.col("__next_day").isNull() | ~F.col("__next_day.d").eqNullSafe(day)
    prev = F.coalesce(F.col("prev_value"), v)
    came_back = (F.coalesce(F.col("prev_value"), F.lit(0)) < lo) | (F.coalesce(F.col("prev_value"), F.lit(999)) > hi)
    return (
        seen.filter(last)
        .drop("__next_day")
        .withColumns(
            {
                "change_from_prev": v - prev,
                "pct_change": iff(
                    F.col("prev_value").isNotNull(),
                    div0null(v - F.col("prev_value"), F.abs("prev_value")) * 100,
                    F.lit(0.0),
                ),
                "is_abnormal": iff((v < lo) | (v > hi), True, False),
                "trend_status": F.when((v < lo) & (prev >= lo), "NEW_LOW")
                .when((v > hi) & (prev <= hi), "NEW_HIGH")
                .when(v.between(lo, hi) & came_back, "NORMALIZED")
                .otherwise("STABLE"),
            }
        )
    )


def sla(df: DataFrame, keys: list[str], ts: str, tie_break: str, minutes: str, target: Column) -> DataFrame:
    """Target per row, whether it was met, and the mean over the last ten rows of the group."""
    timed = df.withColumn("sla_target_minutes", target)
    timed = timed.withColumn("sla_met", iff(F.col(minutes) <= F.col("sla_target_minutes"), True, False))
    return ordered_window(
        timed, keys, [asc(ts), asc(tie_break)], rolling_10_avg_resolution=moving("avg", F.col(minutes), 9)
    )
