"""Published, keyed and history tables: what a merge reads and writes, dead runs, vanished keys."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wardflow.operators.incremental import merge_aggregate, merge_upsert
from wardflow.operators.ordered import desc
from wardflow.session import fresh_path
from wardflow.sources.tables import DIGEST, HistoryTable, KeyedTable, PublishedTable, publish_table


def day(n):
    return datetime(2024, 1, n)


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, v int, at timestamp_ntz")


def content(table):
    return sorted(tuple(r)[:2] for r in table.read().collect())


def files(table):
    return {f for f in table.read().inputFiles()}


def test_changed_equal_time_and_late_rows_arrive(spark):
    table = KeyedTable(spark, fresh_path(spark, "t"), "k")
    merge_upsert(table, frame(spark, [("a", 1, day(10)), ("b", 1, day(5))]), "at", [desc("at")], lambda r: r)
    second = frame(spark, [("a", 2, day(10)), ("b", 9, day(6)), ("c", 3, day(10)), ("d", 4, day(1))])
    merge_upsert(table, second, "at", [desc("at")], lambda r: r, late=100)
    assert content(table) == [("a", 2), ("b", 9), ("c", 3), ("d", 4)]
    before = files(table)
    merge_upsert(table, second, "at", [desc("at")], lambda r: r, late=100)
    assert files(table) == before


def test_only_changed_buckets_are_read_and_written(spark):
    table = KeyedTable(spark, fresh_path(spark, "t"), "k", buckets=16)
    rows = frame(spark, [(f"k{i}", i, day(1)) for i in range(400)])
    table.merge(rows)
    before = files(table)
    # All rows come again, one of them changed.
    assert table.merge(rows.withColumn("v", F.when(F.col("k") == "k7", -7).otherwise(F.col("v")))) == 1
    after = files(table)
    buckets = {f.split("__bucket=")[1].split("/")[0] for f in after - before}
    assert len(buckets) == 1 and len(before & after) >= 15
    assert dict(content(table))["k7"] == -7 and table.read().count() == 400
    scan = table.read_keys(spark.createDataFrame([("k7",)], "k string"))
    assert {f.split("__bucket=")[1].split("/")[0] for f in scan.inputFiles() if "__bucket=" in f} == buckets
    assert [tuple(r)[:2] for r in scan.collect()] == [("k7", -7)]
    table.compact()
    assert files(table) == after and len(table.versions()) == 1 and table.read().count() == 400


def test_columns_that_do_not_count(spark):
    table = KeyedTable(spark, fresh_path(spark, "t"), "k")
    rows = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    table.merge(rows.withColumn("_last_updated", F.lit(1)))
    assert table.merge(rows.withColumn("_last_updated", F.lit(2))) == 0
    assert {r["_last_updated"] for r in table.read().collect()} == {1}
    assert DIGEST not in table.read().columns


def test_a_null_key_and_a_new_column(spark):
    table = KeyedTable(spark, fresh_path(spark, "t"), "k")
    table.merge(spark.createDataFrame([(None, 1), ("a", 1)], "k string, v int"))
    assert table.merge(spark.createDataFrame([(None, 2, "n")], "k string, v int, w string")) == 1
    assert sorted(map(tuple, table.read().collect()), key=str) == [("a", 1, None), (None, 2, "n")]


def test_groups_are_replaced_as_a_whole(spark):
    """Rows of a touched group that vanished go, ranks of those that stay move; other groups stay as they are."""

    def ranked(rows):
        return rows.join(rows.groupBy("k").agg(F.sum("v").alias("total")), "k")

    table = KeyedTable(spark, fresh_path(spark, "t"), "k")
    first = frame(spark, [("a", 1, day(1)), ("a", 1, day(1)), ("a", 2, day(1)), ("b", 5, day(1)), ("c", 6, day(1))])
    merge_aggregate(table, first, "at", ["k"], ranked)
    second = frame(spark, [("a", 1, day(1)), ("a", 4, day(2)), ("b", 5, day(1))])
    merge_aggregate(table, second, "at", ["k"], ranked)
    assert sorted((r.k, r.v, r.total) for r in table.read().collect()) == [("a", 1, 5), ("a", 4, 5), ("b", 5, 5), ("c", 6, 6)]
    # A touched group that is built to nothing goes.
    merge_aggregate(table, second, "at", ["k"], lambda rows: ranked(rows).filter("k <> 'a'"))
    assert sorted(r.k for r in table.read().collect()) == ["b", "c"]


def failing(spark, columns):
    return spark.range(4).select(*[F.when(F.col("id") < 9, F.raise_error(F.lit("lost"))).cast(t).alias(c) for c, t in columns])


def test_a_merge_that_dies_leaves_the_rows(spark):
    table = KeyedTable(spark, fresh_path(spark, "t"), "k")
    table.merge(frame(spark, [("a", 1, day(1))]))
    with pytest.raises(Exception, match="lost"):
        table.merge(failing(spark, [("k", "string"), ("v", "int"), ("at", "timestamp_ntz")]))
    assert content(table) == [("a", 1)]
    # As if the run had died between the rows and the manifest.
    frame(spark, [("a", 9, day(9))]).write.parquet(table._rows(2))
    assert content(table) == [("a", 1)]
    table.merge(frame(spark, [("b", 2, day(2))]))
    assert content(table) == [("a", 1), ("b", 2)]


def test_publishing_again_keeps_the_old_rows_until_the_end(spark):
    root = fresh_path(spark, "lake")
    publish_table(spark.range(3), root, "gold", "t")
    table = PublishedTable(spark, f"{root}/gold/t")
    reader = table.read()
    with pytest.raises(Exception, match="lost"):
        table.publish(failing(spark, [("id", "bigint")]))
    assert table.read().count() == 3 and len(table.loads()) == 1
    # The new rows may be computed from the old ones.
    table.publish(table.read().filter("id > 0"))
    assert table.read().count() == 2 and reader.count() == 3
    table.publish(spark.range(9).withColumn("p", F.col("id") % 2), partition_by=["p"])
    assert table.read().filter("p = 1").count() == 4 and len(table.loads()) == 2
    assert sorted(os.listdir(f"{root.removeprefix('file:')}/gold/t/rows")) == ["000002", "000003"]
    with pytest.raises(ValueError, match="nothing is published"):
        PublishedTable(spark, f"{root}/gold/u").read()


def test_history(spark):
    table = HistoryTable(spark, fresh_path(spark, "h"), "k", ["plan"])
    states = [
        [("a", "x", 1), ("b", "x", 1)], [("a", "y", 2), ("b", "x", 2), ("c", None, 2)], [("a", "y", 3), ("c", "z", 3)],
        [("a", "x", 4), ("b", "w", 4), ("c", "z", 4)],
    ]
    did = []
    for n, state in enumerate(states, 1):
        current = spark.createDataFrame(state, "k string, plan string, n int")
        did.append(table.snapshot(current, F.lit(str(day(n))).cast("timestamp_ntz")))
        # The same state at a later time changes nothing.
        assert table.snapshot(current, F.lit(str(day(n).replace(hour=5))).cast("timestamp_ntz")) == (0, 0)
    assert did == [(0, 2), (1, 2), (1, 1), (2, 2)]
    rows = sorted((r.k, r.valid_from, r.valid_to, r.plan, r.n) for r in table.read().collect())
    assert [(k, p, n) for k, _, _, p, n in rows] == [
        ("a", "x", 1), ("a", "y", 2), ("a", "x", 4), ("b", "x", 1), ("b", "w", 4), ("c", None, 2), ("c", "z", 3),
    ]
    for key in "abc":
        mine = [r for r in rows if r[0] == key]
        assert sum(r[2] is None for r in mine) == 1
        assert all(a[2] == b[1] for a, b in zip(mine, mine[1:], strict=False))
    ledger = [(r.as_of, r.closed, r.opened) for r in table.runs().orderBy("run").collect() if r.closed or r.opened]
    assert ledger == [(day(n), *d) for n, d in enumerate(did, 1)]


def test_a_snapshot_that_dies_closes_nothing(spark):
    table = HistoryTable(spark, fresh_path(spark, "h"), "k", ["plan"])
    table.snapshot(spark.createDataFrame([("a", "x")], "k string, plan string"), F.lit(str(day(1))).cast("timestamp_ntz"))
    # Closed rows were written, the merge was not.
    table.read().write.parquet(f"{table.path}/closed/000002")
    assert table.read().count() == 1
    table.snapshot(spark.createDataFrame([("a", "y")], "k string, plan string"), F.lit(str(day(2))).cast("timestamp_ntz"))
    assert sorted((r.plan, r.valid_to) for r in table.read().collect()) == [("x", day(2)), ("y", None)]
