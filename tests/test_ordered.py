"""The plain and the distributed way of every ordered operator give the same rows."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from wardflow.operators import ordered as O
from wardflow.operators.timeseries import count_within

ORDERS = {"ts": [O.asc("ts"), O.asc("id")], "nulls_first": [O.desc("v"), O.asc("id")], "nulls_last": [O.desc("v", "last"), O.desc("id")]}


def rows(df):
    return sorted(map(str, df.collect()))


def both(spark, build):
    plain = rows(build())
    spark.conf.set("wardflow.maxGroupRows", "25")
    spark.conf.set("wardflow.maxBroadcastRows", "40")
    try:
        spread = rows(build())
    finally:
        spark.conf.unset("wardflow.maxGroupRows")
        spark.conf.unset("wardflow.maxBroadcastRows")
    return plain, spread


@pytest.mark.parametrize("partition", [[], ["key"], ["key", "score"]])
@pytest.mark.parametrize("order", list(ORDERS))
def test_row_order_functions(spark, readings, partition, order):
    v = F.col("v")
    calcs = {
        "rn": O.row_number(), "t": O.ntile(7), "p": O.lag(v), "p9": O.lag(v, 9), "n": O.lead(v), "n4": O.lead(F.col("id"), 4),
        "s": O.running("sum", v), "a": O.running("avg", v), "c": O.running("count", v), "lo": O.running("min", v),
        "hi": O.running("max", v), "m": O.moving("avg", v, 29), "ms": O.moving("sum", v, 3), "mc": O.moving("count", v, 5),
        "f": O.first_of(v), "l": O.last_before(v), "ts_": O.total("sum", v), "ta": O.total("avg", v), "tc": O.total("count", v),
        "tlo": O.total("min", v), "thi": O.total("max", v),
    }
    plain, spread = both(spark, lambda: O.ordered_window(readings, partition, ORDERS[order], **calcs))
    assert len(plain) == 3000
    assert plain == spread


@pytest.mark.parametrize("kind", ["int", "decimal(9,2)", "decimal(38,4)", "double"])
def test_types_and_values_at_every_size(spark, readings, kind):
    """Sums and averages keep Spark's type, and decimals their digits, across shards."""
    v = (F.col("v") / 7).cast(kind) if kind != "int" else F.col("v").cast("int")
    df = readings.withColumn("x", v)
    calcs = {
        f"{way}_{agg}": make(agg)
        for agg in ("sum", "avg", "count")
        for way, make in {
            "r": lambda a: O.running(a, F.col("x")), "m": lambda a: O.moving(a, F.col("x"), 40), "t": lambda a: O.total(a, F.col("x"))
        }.items()
    }
    order = [O.asc("ts"), O.asc("id")]
    plain = O.ordered_window(df, ["key"], order, **calcs)
    spark.conf.set("wardflow.maxGroupRows", "25")
    try:
        spread = O.ordered_window(df, ["key"], order, **calcs)
        assert [(f.name, f.dataType) for f in spread.schema] == [(f.name, f.dataType) for f in plain.schema]
        got = {r["id"]: r for r in spread.collect()}
    finally:
        spark.conf.unset("wardflow.maxGroupRows")
    for row in plain.collect():
        for name in calcs:
            a, b = row[name], got[row["id"]][name]
            assert a == b if kind != "double" or a is None else b == pytest.approx(a, rel=1e-12), (name, a, b)


@pytest.mark.parametrize("partition", [[], ["key"]])
@pytest.mark.parametrize("order", [[O.asc("score")], [O.desc("v")], [O.asc("v"), O.desc("score")]])
def test_peer_ranks(spark, readings, partition, order):
    kinds = {"r": "rank", "d": "dense_rank", "p": "percent_rank", "c": "cume_dist"}
    plain, spread = both(spark, lambda: O.peer_ranks(readings, partition, order, **kinds))
    assert plain == spread


def test_group_totals_with_a_hot_key(spark, readings):
    def build():
        return O.group_totals(readings, ["key"], s=F.sum("v"), n=F.count(F.lit(1)), m=F.min("id"))

    plain, spread = both(spark, build)
    assert plain == spread


def test_join_facts_keeps_all_rows_and_matches_null_keys(tight, readings):
    facts = readings.select("key").distinct().withColumn("found", F.lit(1))
    facts = facts.unionByName(tight.createDataFrame([("stranger", 1)], facts.schema))
    joined = O.join_facts(readings, facts, ["key"])
    assert joined.count() == 3000
    assert joined.filter("found is null").count() == 0


def test_count_within_an_hour(spark, readings):
    plain, spread = both(spark, lambda: count_within(readings, ["key"], "ts", 3600, F.col("score") > 5, "n"))
    assert plain == spread


def test_tiles_differ_by_at_most_one(tight):
    for n in (3, 24, 26, 1000, 1003):
        counts = O.ordered_window(tight.range(n), [], [O.asc("id")], t=O.ntile(5)).groupBy("t").count().collect()
        sizes = [r["count"] for r in sorted(counts, key=lambda r: r.t)]
        assert sizes == sorted(sizes, reverse=True) and max(sizes) - min(sizes) <= 1 and sum(sizes) == n


def test_large_groups_are_windowed_by_shard(tight, readings):
    for partition in ([], ["key"]):
        df = O.ordered_window(readings, partition, [O.asc("id")], rn=O.row_number())
        plan = df._jdf.queryExecution().executedPlan().toString()
        keys = [*partition, "__shard"]
        assert f"hashpartitioning({keys[0]}#" in plan and "__shard#" in plan
        # Only the hand-over rows, one per shard and group, are gathered by group.
        assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan


def test_checkpoint_folder_comes_from_the_session(spark, readings):
    from wardflow.session import fresh_path, shared_dir

    assert shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert fresh_path(spark, "x").startswith(shared_dir(spark))


def test_count_within_looks_at_each_row_twice_at_most(spark):
    """Frames only grow; a sliding one costs rows times rows within a range where many lie close together."""
    rows = spark.range(4000).selectExpr(
        "id % 3 AS k", "id",
        # Ties, times apart by a microsecond around the width, and rows without a time.
        "if(id % 53 = 0, null, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * 7919 % 400 * 60 + id % 5 / 1000000BD)) AS ts",
        "if(id % 11 = 0, null, id % 4 > 0) AS hit",
    )
    counted = count_within(rows, ["k"], "ts", 3600, F.col("hit"), "n")
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("specifiedwindowframe(") == plan.count("Frame, unboundedpreceding$()") > 0
    data = [r.asDict() for r in rows.collect()]
    width = timedelta(hours=1)

    def near(a, b):
        return a is None if b is None else a is not None and timedelta() <= b - a <= width

    want = {
        r["id"]: sum(bool(o["hit"]) and near(o["ts"], r["ts"]) for o in data if o["k"] == r["k"]) for r in data if r["id"] % 10 < 4
    }
    assert {r.id: r.n for r in counted.collect() if r.id in want} == want
