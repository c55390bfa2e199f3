import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardflow.operators import aggregates as A


@pytest.mark.parametrize("limited", [False, True])
def test_exact_percentiles(spark, readings, limited, request):
    if limited:
        request.getfixturevalue("tight")
    got = A.grouped(readings, ["key"], {"n": F.count(F.lit(1))}, {"p10": ("v", 0.1), "p50": ("v", 0.5), "s90": ("score", 0.9)})
    data = readings.select("key", "v", "score").toPandas()
    for row in got.collect():
        group = data[data.key == row.key] if row.key is not None else data[data.key.isna()]
        assert row.n == len(group)
        v = group.v.dropna()
        if len(v) == 0:
            assert row.p10 is None and row.p50 is None
        else:
            assert row.p10 == pytest.approx(np.percentile(v, 10))
            assert row.p50 == pytest.approx(statistics.median(v))
        assert row.s90 == pytest.approx(np.percentile(group.score, 90))


def test_percentiles_have_the_same_bits_at_every_size(spark, readings):
    """Same schema and same doubles below and above the limits, of whole numbers, decimals and doubles."""
    df = readings.withColumns({"d": F.col("v") / 7, "m": (F.col("v") / 7).cast("decimal(12,3)")})
    asked = {f"{c}{int(p * 100)}": (c, p) for c in ("v", "d", "m") for p in (0.1, 0.25, 0.5, 0.95)}
    sets = [["key", "score"], ["key"], []]

    def build():
        plain = A.grouped(df, ["key"], {"n": F.count(F.lit(1))}, asked)
        levels = A.grouping_sets(df, ["key", "score"], sets, {"n": ("count", None)}, asked)
        return [(x.schema, sorted(map(repr, x.collect()))) for x in (plain, levels)]

    below = build()
    spark.conf.set("wardflow.maxGroupRows", "25")
    spark.conf.set("wardflow.maxBroadcastRows", "40")
    try:
        assert build() == below
    finally:
        spark.conf.unset("wardflow.maxGroupRows")
        spark.conf.unset("wardflow.maxBroadcastRows")


def test_percentile_of_an_all_null_group_is_null(tight):
    df = tight.range(60).select((F.col("id") % 2).alias("g"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("v"))
    got = {r.g: r.p for r in A.grouped(df, ["g"], {}, {"p": ("v", 0.5)}).collect()}
    assert got == {0: 29.0, 1: None}


def test_grouping_sets_flags_and_levels(spark, readings):
    rows = A.grouping_sets(
        readings, ["key", "score"], [["key", "score"], ["key"], []],
        {"n": ("count", None), "s": ("sum", F.col("v")), "a": ("avg", F.col("v")), "c": ("count_if", F.col("v") > 50)}, {"m": ("v", 0.5)},
    )
    top = rows.filter("level = 3").first()
    assert (top.n, top.is_total_key, top.is_total_score) == (3000, 1, 1)
    data = readings.toPandas()
    assert top.s == data.v.sum() and top.a == pytest.approx(data.v.mean()) and top.m == data.v.median()
    hot = rows.filter("level = 1 and key = 'hot'").first()
    assert hot.n == 1000
    assert rows.filter("level = 0").agg(F.sum("n")).first()[0] == 3000


def test_lists_are_whole_and_one_row_per_group(spark, readings):
    rows = A.ordered_list(readings, ["key"], ["id"], F.col("id"), "ids").collect()
    assert len({r.key for r in rows}) == len(rows)
    assert next(r.ids for r in rows if r.key == "hot") == list(range(0, 3000, 3))
    assert sum(len(r.ids) for r in rows) == 3000


def test_unpivot_drops_nulls_and_pivot_keeps_missing_as_null(spark):
    df = spark.createDataFrame([(1, 5, None), (2, None, 7)], "id int, a int, b int")
    long = A.unpivot(df, ["id"], ["a", "b"], "m", "v")
    assert sorted(map(tuple, long.collect())) == [(1, "a", 5), (2, "b", 7)]
    wide = A.pivot_sum(long, ["id"], "m", {"a": "a", "b": "b"}, F.col("v"))
    assert sorted(map(tuple, wide.collect())) == [(1, 5, None), (2, None, 7)]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (9.9,), (10.0,), (100.0,), (None,)], "v double")
    got = {r.b: r.n for r in A.histogram(df, [], "v", 0, 100, 10, "b", n=F.count(F.lit(1))).collect()}
    assert got == {0: 1, 1: 2, 2: 1, 11: 1, None: 1}


def test_long_lists_are_put_together_from_pieces(spark, readings):
    """The list of a group past the limit has the same items in the same order, NULLs and ties included."""
    items = F.struct("ts", "v")

    def build(order):
        return sorted((str(r.key), repr(r.l)) for r in A.ordered_list(readings, ["key"], order, items, "l").collect())

    below = build(["v", "id"]), build(["score"])
    spark.conf.set("wardflow.maxGroupRows", "25")
    try:
        above = build(["v", "id"]), build(["score"])
    finally:
        spark.conf.unset("wardflow.maxGroupRows")
    assert above == below


def test_members_of_lists_are_dealt_out_before_they_are_gathered(spark, readings):
    """No map task sorts its whole input by key, and the columns of the order travel once."""
    lists = A.ordered_list(readings, ["key"], ["v", "id"], None, "l")
    plan = lists._jdf.queryExecution().executedPlan().toString()
    # The plan is printed from the result down to the scan.
    assert plan.rindex("partial_collect_list") < plan.index("hashpartitioning(key")
    assert plan.count("Exchange") == 1
    assert [f.name for f in lists.schema["l"].dataType.elementType] == ["v", "id"]
    wide = A.ordered_list(readings, ["key"], ["v", "id"], F.struct("v", "id"), "l")
    assert sorted(map(str, lists.collect())) == sorted(map(str, wide.collect()))
    data = readings.toPandas()
    hot = next(r.l for r in lists.collect() if r.key == "hot")
    want = data[data.key == "hot"].sort_values(["v", "id"], na_position="last")
    assert [r.id for r in hot] == list(want.id)
    whole = A.ordered_list(readings.limit(9), [], ["id"], F.col("id"), "l").first().l
    assert whole == sorted(whole) and len(whole) == 9


def test_members_of_lists_are_dealt_out_to_more_tasks_the_more_there_are(spark, readings, monkeypatch):
    """Neither the session's number of partitions nor compressed bytes set how many members a task gathers."""
    below = A.ordered_list(readings, ["key"], ["v", "id"], None, "l").collect()
    monkeypatch.setattr(A, "DEALT_ROWS", 100)
    lists = A.ordered_list(readings, ["key"], ["v", "id"], None, "l")
    assert lists.rdd.getNumPartitions() == 30
    assert sorted(map(str, lists.collect())) == sorted(map(str, below))
    # What is joined to the lists by their key comes to them: they are not shuffled again.
    joined = readings.withColumnRenamed("key", "k").hint("merge").join(lists, F.col("k") == F.col("key"), "left")
    assert joined._jdf.queryExecution().executedPlan().toString().count("Exchange") == 2
