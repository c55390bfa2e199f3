from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wardflow.operators.incremental import merge_aggregate, merge_upsert, scd2_from_log, scd2_snapshot
from wardflow.operators.ordered import asc, desc
from wardflow.session import fresh_path, settle
from wardflow.sources.tables import KeyedTable


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, v int, at timestamp_ntz")


def day(n):
    return datetime(2024, 1, n)


@pytest.fixture
def table(spark):
    return KeyedTable(spark, fresh_path(spark, "t"), "k")


def content(table):
    return sorted(tuple(r)[:2] for r in table.read().collect())


def test_upsert_inserts_replaces_and_is_idempotent(spark, table):
    order = [desc("at")]
    first = frame(spark, [("a", 1, day(1)), ("b", 2, day(1)), ("a", 0, day(1).replace(hour=0))])
    merge_upsert(table, first.filter("v > 0"), "at", order, lambda r: r)
    second = first.filter("v > 0").unionByName(frame(spark, [("b", 3, day(2)), ("c", 4, day(2)), ("c", 5, day(3))]))
    merge_upsert(table, second, "at", order, lambda r: r)
    assert content(table) == [("a", 1), ("b", 3), ("c", 5)]
    merge_upsert(table, second, "at", order, lambda r: r)
    assert content(table) == [("a", 1), ("b", 3), ("c", 5)]
    table.compact()
    assert content(table) == [("a", 1), ("b", 3), ("c", 5)]
    assert str(table.watermark()) == "2024-01-03 00:00:00"


def test_mark_is_the_source_value_so_late_loads_lose_nothing(spark, table):
    # The load happens "now", years after the rows' own times; a later row still counts as new.
    merge_upsert(table, frame(spark, [("a", 1, day(1))]), "at", [desc("at")], lambda r: r)
    merge_upsert(table, frame(spark, [("a", 1, day(1)), ("b", 2, day(2))]), "at", [desc("at")], lambda r: r)
    assert content(table) == [("a", 1), ("b", 2)]


def test_an_uncommitted_version_is_ignored_and_overwritten(spark, table):
    table.merge(frame(spark, [("a", 1, day(1))]), "1")
    frame(spark, [("a", 9, day(9))]).write.parquet(table._rows(2))
    assert content(table) == [("a", 1)]
    table.merge(frame(spark, [("b", 2, day(2))]), "2")
    assert content(table) == [("a", 1), ("b", 2)]


def test_first_load_of_nothing_takes_everything_later(spark, table):
    merge_upsert(table, frame(spark, []), "at", [desc("at")], lambda r: r)
    merge_upsert(table, frame(spark, [("a", 1, day(1))]), "at", [desc("at")], lambda r: r)
    assert content(table) == [("a", 1)]


def test_touched_groups_are_totalled_from_all_rows(spark, table):
    def totals(rows):
        return rows.groupBy("k").agg(F.sum("v").alias("v"), F.max("at").alias("at"))

    first = frame(spark, [("a", 1, day(1)), ("b", 10, day(1))])
    merge_aggregate(table, first, "at", ["k"], totals)
    merge_aggregate(table, first.unionByName(frame(spark, [("a", 5, day(2))])), "at", ["k"], totals)
    assert content(table) == [("a", 6), ("b", 10)]


def test_snapshot_history_never_overlaps(spark):
    history = None
    states = [
        [("a", "x"), ("b", "x")], [("a", "y"), ("b", "x"), ("c", None)], [("a", "y"), ("c", "z")], [("a", "x"), ("b", "w"), ("c", "z")],
    ]
    for n, state in enumerate(states, 1):
        current = spark.createDataFrame(state, "k string, plan string")
        history = scd2_snapshot(history, current, "k", ["plan"], F.lit(str(day(n))).cast("timestamp_ntz"))
    rows = sorted((r.k, r.valid_from, r.valid_to, r.plan) for r in history.collect())
    assert [(k, p) for k, _, _, p in rows] == [("a", "x"), ("a", "y"), ("a", "x"), ("b", "x"), ("b", "w"), ("c", None), ("c", "z")]
    for key in "abc":
        mine = [r for r in rows if r[0] == key]
        assert sum(r[2] is None for r in mine) == 1
        assert all(a[2] == b[1] for a, b in zip(mine, mine[1:], strict=False))
    assert history.select("row_id").distinct().count() == len(rows)


def test_log_versions_chain(spark):
    log = frame(spark, [("a", 1, day(1)), ("a", 2, day(3)), ("b", 1, day(2)), ("a", 3, day(3))])
    rows = sorted((r.k, r.v, r.valid_from, r.valid_to, r.is_current) for r in scd2_from_log(log, "k", "at", ["v"]).collect())
    assert rows == [
        ("a", 1, day(1), day(3), False), ("a", 2, day(3), day(3), False), ("a", 3, day(3), None, True), ("b", 1, day(2), None, True),
    ]


def test_upsert_order_is_respected(spark, table):
    batch = frame(spark, [("a", 1, day(1)), ("a", 2, day(1))])
    merge_upsert(table, batch, "at", [asc("v")], lambda r: r)
    assert content(table) == [("a", 1)]


def test_a_merge_lists_no_keys_and_joins_no_source_where_all_rows_are_new_or_looked_at_again(spark, monkeypatch):
    """The relations written are the updates and the keys that changed; rows without a time stay as they were."""
    from wardflow.operators import incremental
    from wardflow.sources import tables

    written = []

    def noted(df):
        written.append(df.columns)
        return settle(df)

    monkeypatch.setattr(incremental, "settle", noted)
    monkeypatch.setattr(tables, "settle", noted)
    table = KeyedTable(spark, fresh_path(spark, "t"), "k")
    rows = frame(spark, [(f"k{i}", i % 5, day(1 + i % 20)) for i in range(60)] + [(None, 7, day(3))])

    def build(source):
        return source.groupBy("k").agg(F.sum("v").alias("v"), F.max("at").alias("at"))

    def load(source):
        # Keyed by other columns than the groups, so that vanished rows stay.
        merge_aggregate(table, source, "at", ["k", "v"], build, 36_500)
        return sorted(map(tuple, table.read().collect()), key=repr)

    want = lambda source: sorted(map(tuple, build(source).collect()), key=repr)
    assert load(rows.filter("k is null or v < 3")) == want(rows.filter("k is null or v < 3"))
    written.clear()
    assert load(rows) == want(rows)
    assert [c for c in written if "at" not in c] == [["k"]]
    written.clear()
    # A row without a time is not looked at by itself: the groups of the others are told apart again.
    timeless = rows.unionByName(frame(spark, [("k1", 100, None), ("z", 1, None)]))
    assert load(timeless) == want(rows)
    assert ["k", "v"] in written
