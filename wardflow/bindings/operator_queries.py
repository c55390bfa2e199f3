"""Operators on the given tables, each with the SQL that checks it.

Money is counted in whole cents, so that sums do not depend on the order of addition.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.bindings.landing import table
from wardflow.bindings.portable import portable
from wardflow.functions import (
    band,
    boundary_diff,
    classify_severity,
    completed_years,
    day_of_week,
    div0null,
    find_group,
    find_text,
    fiscal_quarter,
    fiscal_year,
    floor_day,
    floor_hour,
    floor_month,
    floor_week,
    hash_bucket,
    iff,
    iqr_fences,
    lookup,
    mask_pii,
    md5_key,
    plus,
    safe_divide,
    safe_variant_cast,
    score,
    share,
    since,
    squash,
    surrogate_key,
    text_of,
    whole,
    zero_if_null,
)
from wardflow.operators.aggregates import (
    grouped,
    grouping_sets,
    histogram,
    joined_set,
    ordered_list,
    pivot_sum,
    sorted_set,
    unpivot,
)
from wardflow.operators.features import (
    buckets,
    count_flags,
    encode_flags,
    has_flag,
    hash_dedup,
    note_features,
    rate_card,
    rule_points,
    unify_alerts,
    watchlist_overlap,
)
from wardflow.operators.incremental import (
    current_dimension,
    merge_aggregate,
    merge_upsert,
    scd2_from_log,
    scd2_snapshot,
)
from wardflow.operators.ordered import (
    asc,
    desc,
    first_of,
    group_totals,
    join_facts,
    lag,
    last_before,
    lead,
    moving,
    ntile,
    ordered_window,
    peer_ranks,
    row_number,
    running,
    total,
)
from wardflow.operators.pairs import cooccurrence_pairs, pair_rule_counts
from wardflow.operators.relational import (
    densify,
    fan_in,
    latest_by,
    newer_than,
    share_of_total,
    top_k_per_group,
    union_all,
)
from wardflow.operators.semi import build_document, completeness, flatten, flatten_product, is_array, object_keys
from wardflow.operators.timeseries import (
    adherence,
    count_within,
    densify_forecast,
    detect_gaps,
    return_intervals,
    rolling_daily,
    sla,
    trend_states,
)
from wardflow.plans.advanced import metric_profile
from wardflow.session import fresh_path
from wardflow.sources.generators import calendar, recursive_series, row_generator, time_points, time_spine
from wardflow.sources.landing import parse, read_landing, read_seed
from wardflow.sources.tables import KeyedTable, publish_table, publish_view
from wardflow.streaming.feed import upsert_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

CENTS = "CAST(round({} * 100) AS BIGINT)"
EVENT_NOW = datetime(2024, 1, 29, 12, 30)


def query(sql: str | None = None, digits: dict[str, int] | None = None):
    """Register a query under its function's name, with its check SQL."""

    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[function.__name__] = lambda spark, sf_dir: portable(function(spark, sf_dir), digits)
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def cents(column: str):
    return F.round(F.col(column) * 100).cast("bigint")


def _orders(spark, sf):
    """Orders as visits: an end 0 to 89 days later, none while the status is O."""
    end = F.when(F.col("o_orderstatus") != "O", plus("day", F.pmod("o_orderkey", F.lit(90)), F.col("o_orderdate")))
    return table(spark, sf, "orders").withColumns({"cents": cents("o_totalprice"), "o_end": end})


ORD = f"(SELECT *, {CENTS.format('o_totalprice')} AS cents, CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + to_days(CAST(o_orderkey % 90 AS INTEGER)) END AS o_end FROM orders)"


def _events(spark, sf):
    return table(spark, sf, "events").withColumns({"cents": cents("value"), "facility": F.col("user_id") % 6})


EVE = f"(SELECT *, {CENTS.format('value')} AS cents, user_id % 6 AS facility FROM events)"

LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def _lines(spark, sf):
    return table(spark, sf, "lineitem").withColumn("cents", cents("l_extendedprice"))


LIN = f"(SELECT *, {CENTS.format('l_extendedprice')} AS cents FROM lineitem)"


# ---- semi-structured ------------------------------------------------------------------------------


def _event_docs(spark, sf):
    """Event documents in which some fields are missing or malformed."""
    e = F.expr
    doc = F.to_json(
        F.struct(
            e("event_id").alias("id"),
            e("if(event_id % 3 = 0, null, event_type)").alias("kind"),
            e("if(event_id % 5 = 0, 'n/a', cast(ts as string))").alias("at"),
            e("if(event_id % 7 = 0, '12.6', cast(user_id as string))").alias("who"),
            e("if(event_id % 4 = 0, null, filter(array('a', 'b', 'c'), (x, i) -> i < event_id % 4))").alias("tags"),
            e("from_json(props, 'k bigint')").alias("props"),
        )
    )
    return table(spark, sf, "events").select(
        doc.alias("raw_data"), F.col("ts").cast("timestamp_ntz").alias("_ingested_at"),
        F.lit("f").alias("_source_file"), F.lit("b").alias("_batch_id"),
    )


@query(
    """SELECT event_id AS id, CASE WHEN event_id % 3 <> 0 THEN event_type END AS kind, CASE WHEN event_id % 5 <> 0 THEN CAST(ts AS VARCHAR) END AS at,
       CASE WHEN event_id % 7 = 0 THEN 13 ELSE user_id END AS who, CAST(props ->> 'k' AS BIGINT) AS k, coalesce(CASE WHEN event_id % 3 <> 0 THEN event_type END, 'unknown') AS kind_or_default,
       CAST(NULL AS BIGINT) AS missing FROM events"""
)
def json_path_extract(spark, sf):
    doc = parse(_event_docs(spark, sf), "id string, kind string, at string, who string, props struct<k:string,z:string>")
    return doc.select(
        F.col("id").cast("bigint").alias("id"), "kind", F.col("at").try_cast("timestamp_ntz").alias("at"),
        whole(F.col("who")).alias("who"), F.col("props.k").cast("bigint").alias("k"),
        F.coalesce("kind", F.lit("unknown")).alias("kind_or_default"), whole(F.col("props.z"), safe=True).alias("missing"),
    )


@query(
    """SELECT event_id AS id, coalesce(TRY_CAST(props ->> 'k' AS BIGINT), -1) AS k, 0.5::DOUBLE AS kind_number, coalesce(TRY_CAST(CASE WHEN event_id % 4 = 0 THEN 'x' ELSE CAST(user_id AS VARCHAR) END AS INTEGER), 0) AS who FROM events"""
)
def safe_cast_default(spark, sf):
    events = table(spark, sf, "events")
    who = F.when(F.col("event_id") % 4 == 0, F.lit("x")).otherwise(F.col("user_id").cast("string"))
    return events.select(
        F.col("event_id").alias("id"), safe_variant_cast(F.get_json_object("props", "$.k"), "bigint", -1).alias("k"),
        safe_variant_cast(F.col("event_type"), "double", 0.5).alias("kind_number"), safe_variant_cast(who, "int", 0).alias("who"),
    )


@query("SELECT event_id AS id, [ 'a', 'b', 'c'][i + 1] AS tag, i + 1 AS tag_number FROM events, unnest(range(event_id % 4)) t(i)")
def flatten_array(spark, sf):
    doc = parse(_event_docs(spark, sf), "id bigint, tags array<string>")
    return flatten(doc, "tags").select("id", F.col("item").alias("tag"), (F.col("pos") + 1).alias("tag_number"))


def _customer_docs(spark, sf):
    """Per customer and day an array of orders, each with an array of line items."""
    line = ["l_linenumber", "l_partkey", "l_suppkey", "cents"]
    lines = ordered_list(_lines(spark, sf), ["l_orderkey"], line, F.struct(*line), "lines")
    orders = _orders(spark, sf).join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    order = F.struct("o_orderkey", "o_orderstatus", "lines")
    days = ordered_list(orders, ["o_custkey", "o_orderdate"], ["o_orderkey"], order, "orders")
    return days.select(F.to_json(F.struct("o_custkey", "orders")).alias("raw_data"))


@query(
    f"""SELECT o_custkey, o_orderkey, o_orderstatus, l_linenumber, l_partkey, l.cents,
        row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l.cents) AS line_seq FROM orders JOIN {LIN} l ON l_orderkey = o_orderkey"""
)
def flatten_nested(spark, sf):
    schema = (
        "o_custkey bigint, orders array<struct<o_orderkey:bigint,o_orderstatus:string,"
        "lines:array<struct<l_linenumber:int,l_partkey:bigint,cents:bigint>>>>"
    )
    orders = flatten(parse(_customer_docs(spark, sf), schema), "orders").select("o_custkey", "item.*")
    return flatten(orders, "lines").select(
        "o_custkey", "o_orderkey", "o_orderstatus", "item.*",
        (F.col("pos") + 1).alias("line_seq"),
    )


@query(
    """SELECT c_custkey, a, b, c FROM customer, unnest(range(c_custkey % 4)) t(a), unnest(range(c_custkey % 5)) u(b), unnest(range(c_custkey % 3 + 1)) v(c) WHERE a % 2 = 0"""
)
def flatten_product_all(spark, sf):
    arrays = table(spark, sf, "customer").selectExpr(
        "c_custkey",
        *[
            f"transform(filter(sequence(0, 9), x -> x < {n}), x -> named_struct('v', x)) AS {name}"
            for name, n in {"a": "c_custkey % 4", "b": "c_custkey % 5", "c": "c_custkey % 3 + 1"}.items()
        ],
    )
    rows = flatten_product(arrays, "a", ["b", "c"], F.col("a.v") % 2 == 0)
    return rows.select("c_custkey", *[F.col(f"{n}.v").alias(n) for n in "abc"])


@query(
    f"""SELECT o_orderkey, o_orderstatus AS status, o_orderpriority AS priority, string_agg(l_partkey, ',' ORDER BY l_linenumber, l_partkey, l_suppkey, l.cents) AS parts, count(l_partkey) AS n_lines,
        sum(l.cents) AS total FROM orders LEFT JOIN {LIN} l ON l_orderkey = o_orderkey GROUP BY ALL"""
)
def build_document_orders(spark, sf):
    item = F.struct(F.col("l_partkey").alias("part"), F.col("cents").alias("charge"))
    order = ["l_linenumber", "l_partkey", "l_suppkey", "cents"]
    lists = ordered_list(_lines(spark, sf), ["l_orderkey"], order, item, "lines")
    docs = _orders(spark, sf).join(lists, F.col("l_orderkey") == F.col("o_orderkey"), "left").select(
        "o_orderkey",
        build_document(
            key=F.col("o_orderkey"),
            header=F.struct(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")),
            lines=F.coalesce("lines", F.array()),
        ).alias("raw_data"),
    )
    schema = "header struct<status:string,priority:string>, lines array<struct<part:bigint,charge:bigint>>"
    d = docs.select("o_orderkey", F.from_json("raw_data", schema).alias("d"))
    parts = F.array_join(F.col("d.lines.part").cast("array<string>"), ",")
    return d.select(
        "o_orderkey", "d.header.*", F.when(parts != "", parts).alias("parts"), F.array_size("d.lines").alias("n_lines"),
        F.when(F.array_size("d.lines") > 0, F.aggregate("d.lines.charge", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("total"),
    )


@query(
    """SELECT event_id AS id, 4 + (event_id % 3 <> 0)::INT + (event_id % 4 <> 0)::INT AS fields_present, round((4 + (event_id % 3 <> 0)::INT + (event_id % 4 <> 0)::INT) * 100 / 6, 1) AS completeness_pct,
       event_id % 4 <> 0 AS tags_is_array, CASE WHEN event_id % 4 <> 0 THEN event_id % 4 END AS n_tags, 1 AS n_prop_keys FROM events"""
)
def completeness_profile(spark, sf):
    fields = ["id", "kind", "at", "who", "tags", "props"]
    doc = parse(_event_docs(spark, sf), ", ".join(f"{f} string" for f in fields))
    present, pct = completeness(fields)
    return doc.select(
        F.col("id").cast("bigint").alias("id"), present.alias("fields_present"), pct.alias("completeness_pct"),
        is_array(F.col("tags")).alias("tags_is_array"), F.json_array_length("tags").alias("n_tags"),
        F.array_size(object_keys(F.col("props"))).alias("n_prop_keys"),
    )


@query("SELECT event_id AS id, user_id AS who, event_type AS kind, CAST(props ->> 'k' AS BIGINT) AS k, true AS has_source FROM events")
def landing_text(spark, sf):
    """JSON lines written to and read back from text files, with the file as lineage."""
    path = fresh_path(spark, "lines")
    docs = table(spark, sf, "events").select(
        F.to_json(F.struct("event_id", "user_id", "event_type", F.from_json("props", "k bigint").alias("props"))).alias("value")
    )
    docs.write.text(path)
    landed = read_landing(spark, path, "text")
    return parse(landed, "event_id bigint, user_id bigint, event_type string, props struct<k:bigint>").select(
        F.col("event_id").alias("id"), F.col("user_id").alias("who"), F.col("event_type").alias("kind"), "props.k",
        F.col("_source_file").contains("lines-").alias("has_source"),
    )


@query("SELECT event_id AS id, CAST(props ->> 'k' AS BIGINT) AS k, event_type AS kind FROM events")
def landing_variant(spark, sf):
    """The document column as VARIANT."""
    docs = _event_docs(spark, sf).withColumn("raw_data", F.parse_json("raw_data"))
    full = parse(docs, "id bigint, props struct<k:bigint>").select("id", "props.k")
    kinds = table(spark, sf, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("kind"))
    return full.join(kinds, "id")


# ---- projections and predicates -------------------------------------------------------------------


@query(
    f"""SELECT o_orderkey, datediff('day', o_orderdate, o_end) AS days, datediff('month', o_orderdate, o_end) AS months, datediff('year', o_orderdate, o_end) AS years,
        CASE WHEN o_orderkey % 10 = 0 THEN 0.0 ELSE cents / (o_orderkey % 10) END AS div0, cents / nullif(o_orderkey % 10, 0) AS safe, o_end IS NULL AS is_open,
        cents - coalesce(nullif(o_orderkey % 4, 0), 0) AS outstanding FROM {ORD}"""
)
def claims_enrich(spark, sf):
    start, end, n = F.col("o_orderdate"), F.col("o_end"), F.col("o_orderkey") % 10
    part = F.nullif(F.col("o_orderkey") % 4, F.lit(0))
    return _orders(spark, sf).select(
        "o_orderkey", *[boundary_diff(u, start, end).alias(f"{u}s") for u in ("day", "month", "year")],
        div0null(F.col("cents"), n).alias("div0"), safe_divide(F.col("cents"), n).alias("safe"),
        end.isNull().alias("is_open"), (F.col("cents") - zero_if_null(part)).alias("outstanding"),
    )


@query(
    f"""SELECT l_orderkey, l_linenumber, l_partkey, cents, sum(cents) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice ROWS UNBOUNDED PRECEDING) AS running,
        cents / sum(cents) OVER (PARTITION BY l_orderkey) AS pct_of_order FROM {LIN}"""
)
def claim_lines_running(spark, sf):
    order = [asc(c) for c in LINE_KEYS[1:]]
    rows = ordered_window(
        _lines(spark, sf), ["l_orderkey"], order, running=running("sum", F.col("cents")), __all=total("sum", F.col("cents"))
    )
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "cents", "running", share(F.col("cents"), F.col("__all")).alias("pct_of_order")
    )


@query(
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'DEBT' WHEN c_acctbal < 2500 THEN 'LOW' WHEN c_acctbal < 7500 THEN 'MID' ELSE 'HIGH' END AS band,
       CASE WHEN c_acctbal <= -500 OR c_acctbal >= 9000 THEN 'Critical' WHEN c_acctbal < 0 OR c_acctbal > 8000 THEN 'Abnormal' ELSE 'Normal' END AS severity FROM customer"""
)
def case_banding(spark, sf):
    b = F.col("c_acctbal")
    return table(spark, sf, "customer").select(
        "c_custkey", band([(b < 0, "DEBT"), (b < 2500, "LOW"), (b < 7500, "MID")], "HIGH").alias("band"),
        classify_severity(b, 0, 8000, -500, 9000).alias("severity"),
    )


@query(
    """SELECT p_partkey, CASE WHEN p_size > 40 THEN 4 WHEN p_size > 25 THEN 3 WHEN p_size > 10 THEN 2 ELSE 1 END + CASE WHEN p_retailprice > 1000 THEN 3 WHEN p_retailprice > 950 THEN 2 ELSE 0 END
       + (p_type = 'PROMO')::INT AS points FROM part"""
)
def scorecard(spark, sf):
    points = [
        rule_points(F.col("p_size"), [(40, 4), (25, 3), (10, 2)], 1),
        rule_points(F.col("p_retailprice"), [(1000, 3), (950, 2)], 0),
        iff(F.col("p_type") == "PROMO", 1, 0),
    ]
    return table(spark, sf, "part").select("p_partkey", score(points).alias("points"))


@query(
    """SELECT o_orderkey, coalesce(map(['F', 'O'], ['Finished', 'Open'])[o_orderstatus], 'Other') AS status, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 END AS rank FROM orders"""
)
def decode_lookup(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", lookup(F.col("o_orderstatus"), {"F": "Finished", "O": "Open"}, "Other").alias("status"),
        lookup(F.col("o_orderpriority"), {"1-URGENT": 1, "2-HIGH": 2}).alias("rank"),
    )


@query(
    """SELECT event_id, CASE WHEN value > 150 THEN 'CRITICAL' WHEN value > 120 THEN 'HIGH' WHEN value > 100 THEN 'MODERATE' WHEN value < 50 THEN 'LOW' ELSE 'NORMAL' END AS level,
       CASE WHEN event_id % 6 = 0 THEN 'NOT_MEASURED' WHEN value < 90 THEN 'BELOW' ELSE 'FINE' END AS status FROM events"""
)
def nested_if(spark, sf):
    v = F.col("value")
    known = F.when(F.col("event_id") % 6 != 0, v)
    level = iff(v > 150, "CRITICAL", iff(v > 120, "HIGH", iff(v > 100, "MODERATE", iff(v < 50, "LOW", "NORMAL"))))
    return table(spark, sf, "events").select(
        "event_id", level.alias("level"),
        F.nvl2(known, iff(known < 90, "BELOW", "FINE"), F.lit("NOT_MEASURED")).alias("status"),
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, CAST(l_shipdate AS VARCHAR) AS l_shipdate FROM lineitem WHERE l_returnflag IN ('A', 'R') AND NOT l_linestatus = 'F' AND l_quantity BETWEEN 5 AND 20
       AND l_shipdate >= DATE '2001-02-01' AND CAST(l_partkey AS VARCHAR) LIKE '1%'"""
)
def predicates(spark, sf):
    now = F.lit("2001-08-01 12:30:00").cast("timestamp_ntz")
    return (
        table(spark, sf, "lineitem")
        .filter(F.col("l_returnflag").isin("A", "R") & ~(F.col("l_linestatus") == "F"))
        .filter(F.col("l_quantity").between(5, 20) & F.col("l_partkey").cast("string").like("1%"))
        .filter(since(F.col("l_shipdate"), now, 6, "month"))
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate")
    )


@query(
    """SELECT c_custkey, c_name, c_custkey || ' ' || c_mktsegment AS tag, sha256(c_name) AS masked, md5(coalesce(c_name, '_null_') || '|' || coalesce(CASE WHEN c_nationkey > 12 THEN c_nationkey END::VARCHAR, '_null_')) AS key,
       c_mktsegment <> 'HOUSEHOLD' AS keep FROM customer"""
)
def projection_passthrough(spark, sf):
    some = F.when(F.col("c_nationkey") > 12, F.col("c_nationkey"))
    return table(spark, sf, "customer").select("*").select(
        "c_custkey", "c_name", F.concat(F.col("c_custkey").cast("string"), F.lit(" "), F.col("c_mktsegment")).alias("tag"),
        mask_pii(F.col("c_name")).alias("masked"), surrogate_key(F.col("c_name"), some).alias("key"),
        (F.col("c_mktsegment") != "HOUSEHOLD").alias("keep"),
    )


# ---- joins ----------------------------------------------------------------------------------------


@query(
    f"""SELECT c_custkey, c_name, n_name, coalesce(n, 0) AS n_orders, coalesce(s, 0) AS spent FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
        LEFT JOIN (SELECT o_custkey, count(*) AS n, sum(cents) AS s FROM {ORD} WHERE o_orderstatus = 'F' GROUP BY 1) ON o_custkey = c_custkey"""
)
def join_left(spark, sf):
    spent = _orders(spark, sf).filter("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("cents").alias("s")
    )
    named = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    # nation is far below the planner's broadcast threshold, so no hint is needed.
    people = table(spark, sf, "customer").join(named, "c_nationkey", "left")
    return fan_in(people, [spent], "c_custkey").select(
        "c_custkey", "c_name", "n_name", zero_if_null(F.col("n")).alias("n_orders"), zero_if_null(F.col("s")).alias("spent")
    )


@query(
    f"""SELECT o_orderkey, o_orderpriority, n AS priority_orders, s AS priority_total, cents / s AS pct_of_priority FROM {ORD}
        JOIN (SELECT o_orderpriority, count(*) AS n, sum(cents) AS s FROM {ORD} GROUP BY 1) USING (o_orderpriority)"""
)
def join_inner_back(spark, sf):
    rows = group_totals(
        _orders(spark, sf), ["o_orderpriority"], priority_orders=F.count(F.lit(1)), priority_total=F.sum("cents")
    )
    return rows.select(
        "o_orderkey", "o_orderpriority", "priority_orders", "priority_total",
        share(F.col("cents"), F.col("priority_total")).alias("pct_of_priority"),
    )


@query(
    """SELECT CAST(hi - CAST(i AS INTEGER) AS VARCHAR) AS day_date, i + 1 AS day_num, count(event_id) AS n FROM (SELECT max(CAST(ts AS DATE)) AS hi, unnest(range(datediff('day', min(ts), max(ts)) + 1)) AS i FROM events)
       LEFT JOIN events ON CAST(ts AS DATE) = hi - CAST(i AS INTEGER) GROUP BY hi, i"""
)
def join_expr_day(spark, sf):
    events = table(spark, sf, "events").select("event_id", F.to_date("ts").alias("day_date"))
    first, last = events.agg(F.min("day_date"), F.max("day_date")).first()
    days = recursive_series(spark, F.lit(last), -1, (last - first).days + 1)
    counts = events.groupBy("day_date").agg(F.count("event_id").alias("n"))
    return days.join(counts, "day_date", "left").select("day_date", "day_num", zero_if_null(F.col("n")).alias("n"))


@query(
    """SELECT u AS user_id, CAST(d AS VARCHAR) AS day, (SELECT count(*) FROM events e WHERE e.user_id = u AND CAST(ts AS DATE) = d) AS n
       FROM (SELECT DISTINCT user_id AS u FROM events), (SELECT DATE '2024-01-01' + CAST(i AS INTEGER) AS d FROM range(30) t(i))"""
)
def join_cross_spine(spark, sf):
    events = table(spark, sf, "events")
    spine = densify(events.select("user_id").distinct(), time_points(F.lit("2024-01-01").cast("date"), 30, "day"), "day")
    counts = events.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return spine.join(counts, ["user_id", "day"], "left").select("user_id", "day", zero_if_null(F.col("n")).alias("n"))


@query(
    f"""SELECT o_orderkey, coalesce(n, 0) AS n_lines, coalesce(s, 0) AS line_total, coalesce(r, 0) AS n_returned FROM orders
        LEFT JOIN (SELECT l_orderkey, count(*) AS n, sum(cents) AS s FROM {LIN} GROUP BY 1) a ON a.l_orderkey = o_orderkey
        LEFT JOIN (SELECT l_orderkey, count(*) AS r FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) b ON b.l_orderkey = o_orderkey"""
)
def join_fan_in(spark, sf):
    lines = _lines(spark, sf).withColumnRenamed("l_orderkey", "o_orderkey")
    sums = lines.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("s"))
    back = lines.filter("l_returnflag = 'R'").groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("r"))
    joined = fan_in(table(spark, sf, "orders").select("o_orderkey"), [sums, back], "o_orderkey")
    return joined.select(
        "o_orderkey", *[zero_if_null(F.col(c)).alias(n) for c, n in {"n": "n_lines", "s": "line_total", "r": "n_returned"}.items()]
    )


# ---- pairs ----------------------------------------------------------------------------------------

BASKET = "(SELECT DISTINCT l_orderkey, p_brand, p_brand[1:5] AS lab FROM lineitem JOIN part ON p_partkey = l_partkey)"


def _basket(spark, sf):
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_partkey").join(parts, "l_partkey")


@query(
    f"""SELECT a.p_brand AS item_1, b.p_brand AS item_2, count(*) AS support, count(*) / sum(count(*)) OVER () AS prevalence, count(*) AS n_entities, min(a.l_orderkey) AS first_entity
        FROM {BASKET} a JOIN {BASKET} b ON a.l_orderkey = b.l_orderkey AND a.p_brand < b.p_brand GROUP BY 1, 2 HAVING count(*) >= 2"""
)
def self_join_pairs(spark, sf):
    basket = _basket(spark, sf).withColumn("lab", F.substring("p_brand", 1, 5))
    pairs = cooccurrence_pairs(basket, "l_orderkey", "p_brand", "lab")
    return pairs.select(
        "item_1", "item_2", "support", "prevalence", F.array_size("entities").alias("n_entities"),
        F.col("entities")[0].alias("first_entity"),
    )


@query(
    """SELECT a.l_orderkey, count(*) AS pair_count, count_if(a.p_type = 'ECONOMY' AND b.p_type = 'PROMO') AS high,
       count_if(NOT (a.p_type = 'ECONOMY' AND b.p_type = 'PROMO') AND a.p_brand LIKE '%1' AND b.p_brand LIKE '%1') AS moderate
       FROM (SELECT l_orderkey, p_type, p_brand FROM lineitem JOIN part ON p_partkey = l_partkey) a JOIN (SELECT l_orderkey, p_type, p_brand FROM lineitem JOIN part ON p_partkey = l_partkey) b
       ON a.l_orderkey = b.l_orderkey AND a.p_type < b.p_type GROUP BY 1"""
)
def pair_rules(spark, sf):
    kind, brand = F.col("p_type"), F.col("p_brand")
    rules = [(kind == "ECONOMY", kind == "PROMO", "high"), (brand.like("%1"), brand.like("%1"), "moderate")]
    counts = pair_rule_counts(_basket(spark, sf), "l_orderkey", "p_type", rules, ["high", "moderate"])
    return counts.filter("pair_count > 0")


# ---- aggregation ----------------------------------------------------------------------------------


@query(
    f"""SELECT o_orderpriority, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS n_f, count(*) FILTER (o_totalprice > 100000) AS n_big, sum(cents) AS total, min(cents) AS lo, max(cents) AS hi,
        sum(cents) / count(*) AS mean, max((o_orderstatus = 'P')::INT) AS has_p, 0 AS stub FROM {ORD} GROUP BY 1 HAVING count(*) > 1"""
)
def cond_agg(spark, sf):
    rows = _orders(spark, sf).groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("n_f"),
        F.count_if(F.col("o_totalprice") > 100000).alias("n_big"), F.sum("cents").alias("total"), F.min("cents").alias("lo"),
        F.max("cents").alias("hi"), F.avg("cents").alias("mean"), F.max(iff(F.col("o_orderstatus") == "P", 1, 0)).alias("has_p"),
        F.lit(0).alias("stub"),
    )
    return rows.filter("n > 1")


@query("SELECT o_orderstatus, count(DISTINCT o_custkey) AS customers, count(DISTINCT CAST(o_orderdate AS DATE)) AS days FROM orders GROUP BY 1")
def distinct_counts(spark, sf):
    return table(spark, sf, "orders").groupBy("o_orderstatus").agg(
        F.count_distinct("o_custkey").alias("customers"), F.count_distinct(F.to_date("o_orderdate")).alias("days")
    )


@query("SELECT DISTINCT l_returnflag, l_linestatus, l_suppkey FROM lineitem")
def select_distinct(spark, sf):
    return table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_suppkey").distinct()


@query(
    f"""SELECT o_orderpriority, o_orderstatus, median(cents) AS med, round(quantile_cont(cents, 0.25), 4) AS p25, round(quantile_cont(cents, 0.95), 4) AS p95, round(stddev_samp(cents), 2) AS sd, count(*) AS n FROM {ORD} GROUP BY 1, 2""",
    {"p25": 4, "p95": 4, "sd": 2},
)
def stats_percentiles(spark, sf):
    return grouped(
        _orders(spark, sf), ["o_orderpriority", "o_orderstatus"],
        {"sd": F.stddev_samp("cents"), "n": F.count(F.lit(1))},
        {"med": ("cents", 0.5), "p25": ("cents", 0.25), "p95": ("cents", 0.95)},
    )


@query(
    """SELECT event_type, round(q3 - q1, 4) AS iqr, round(q1 - 1.5 * (q3 - q1), 4) AS low, round(q3 + 1.5 * (q3 - q1), 4) AS high, (SELECT count(*) FROM events x WHERE x.event_type = q.event_type AND x.value > q3 + 1.5 * (q3 - q1)) AS outliers
       FROM (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1) q""",
    {"iqr": 4, "low": 4, "high": 4},
)
def iqr_outliers(spark, sf):
    events = table(spark, sf, "events").select("event_type", "value")
    quart = grouped(events, ["event_type"], {"n": F.count(F.lit(1))}, {"q1": ("value", 0.25), "q3": ("value", 0.75)})
    spread, low, high = iqr_fences(F.col("q1"), F.col("q3"))
    fences = quart.select("event_type", spread.alias("iqr"), low.alias("low"), high.alias("high"))
    return join_facts(events, fences, ["event_type"], own_keys=True).filter("event_type IS NOT NULL").groupBy("event_type", "iqr", "low", "high").agg(
        F.count_if(F.col("value") > F.col("high")).alias("outliers")
    )


@query("SELECT event_type, count(DISTINCT user_id) AS exact_users, true AS approx_ok, true AS p50_ok FROM events GROUP BY 1")
def approx_functions(spark, sf):
    """Approximations are checked by their error: distinct count within 10 %, median within 2 % of ranks."""
    rows = table(spark, sf, "events").groupBy("event_type").agg(
        F.count_distinct("user_id").alias("exact_users"), F.approx_count_distinct("user_id").alias("a"),
        F.approx_percentile("value", [0.48, 0.5, 0.52]).alias("q"),
    )
    near = F.abs(F.col("a") - F.col("exact_users")) <= F.col("exact_users") * 0.1 + 1
    exact = grouped(table(spark, sf, "events"), ["event_type"], {}, {"lo": ("value", 0.48), "hi": ("value", 0.52)})
    return rows.join(exact, "event_type").select(
        "event_type", "exact_users", near.alias("approx_ok"), F.col("q")[1].between(F.col("lo"), F.col("hi")).alias("p50_ok")
    )


@query(
    """SELECT l_orderkey, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS flags, string_agg(DISTINCT l_suppkey, ',' ORDER BY l_suppkey) AS suppliers, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1"""
)
def array_agg_sorted(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_suppkey")
    flags = lines.groupBy("l_orderkey").agg(
        sorted_set("l_returnflag").alias("flags"), F.count_distinct("l_suppkey").alias("n")
    )
    pairs = lines.select("l_orderkey", "l_suppkey").distinct()
    lists = ordered_list(pairs, ["l_orderkey"], ["l_suppkey"], F.col("l_suppkey"), "suppliers")
    return flags.join(lists, "l_orderkey").select("l_orderkey", "flags", "suppliers", "n")


@query("SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ' | ' ORDER BY o_orderpriority) AS priorities, count(*) AS n FROM orders GROUP BY 1")
def listagg_distinct(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(
        joined_set("o_orderpriority", " | ").alias("priorities"), F.count(F.lit(1)).alias("n")
    )


@query("SELECT o_custkey, string_agg(o_orderkey, ',' ORDER BY o_orderdate, o_orderkey) AS keys FROM orders GROUP BY 1")
def listagg_ordered(spark, sf):
    return ordered_list(
        table(spark, sf, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], F.col("o_orderkey"), "keys"
    )


@query(
    f"""SELECT coalesce(o_orderpriority, 'ALL') AS priority, coalesce(o_orderstatus, 'ALL') AS status, count(*) AS n, sum(cents) AS total, sum(cents) / count(*) AS mean, median(cents) AS med,
        grouping(o_orderpriority) AS is_total_o_orderpriority, grouping(o_orderstatus) AS is_total_o_orderstatus, grouping_id(o_orderpriority, o_orderstatus) AS level
        FROM {ORD} GROUP BY GROUPING SETS ((o_orderpriority, o_orderstatus), (o_orderpriority), ())"""
)
def grouping_sets_3(spark, sf):
    a, b = columns = ["o_orderpriority", "o_orderstatus"]
    rows = grouping_sets(
        _orders(spark, sf), columns, [columns, [a], []],
        {"n": ("count", None), "total": ("sum", F.col("cents")), "mean": ("avg", F.col("cents"))}, {"med": ("cents", 0.5)},
    )
    return rows.withColumns({"priority": F.coalesce(a, F.lit("ALL")), "status": F.coalesce(b, F.lit("ALL"))}).drop(a, b)


@query(
    """SELECT coalesce(l_returnflag, 'ALL') AS flag, coalesce(l_linestatus, 'ALL') AS status, coalesce(CAST(l_linenumber AS VARCHAR), 'ALL') AS line, count(*) AS n, count(*) FILTER (l_quantity > 25) AS n_large,
       grouping_id(l_returnflag, l_linestatus, l_linenumber) AS level FROM lineitem
       GROUP BY GROUPING SETS ((l_returnflag, l_linestatus, l_linenumber), (l_returnflag, l_linestatus), (l_returnflag), (l_linestatus), ())"""
)
def grouping_sets_5(spark, sf):
    a, b, c = columns = ["l_returnflag", "l_linestatus", "l_linenumber"]
    rows = grouping_sets(
        table(spark, sf, "lineitem"), columns, [columns, [a, b], [a], [b], []],
        {"n": ("count", None), "n_large": ("count_if", F.col("l_quantity") > 25)},
    )
    return rows.select(
        F.coalesce(a, F.lit("ALL")).alias("flag"), F.coalesce(b, F.lit("ALL")).alias("status"),
        F.coalesce(F.col(c).cast("string"), F.lit("ALL")).alias("line"), "n", "n_large", "level",
    )


@query(
    f"""SELECT *, total / sum(total) OVER () AS share_all FROM (SELECT coalesce(o_orderstatus, 'ALL') AS status, coalesce(o_orderpriority, 'ALL') AS priority, count(*) AS n, sum(cents) AS total
        FROM {ORD} GROUP BY GROUPING SETS ((o_orderstatus, o_orderpriority), (o_orderstatus), (o_orderpriority), ()))"""
)
def cost_allocation(spark, sf):
    a, b = columns = ["o_orderstatus", "o_orderpriority"]
    rows = grouping_sets(
        _orders(spark, sf), columns, [columns, [a], [b], []], {"n": ("count", None), "total": ("sum", F.col("cents"))}
    )
    return share_of_total(rows, share_all="total").select(
        F.coalesce(a, F.lit("ALL")).alias("status"), F.coalesce(b, F.lit("ALL")).alias("priority"), "n", "total", "share_all"
    )


@query(
    f"""SELECT facility, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, {', '.join(f"nullif(count(*) FILTER (event_type = '{t}'), 0) AS {t}s" for t in ('click', 'error', 'purchase', 'signup', 'view'))} FROM {EVE} GROUP BY 1, 2"""
)
def pivot_counts(spark, sf):
    names = {t: f"{t}s" for t in ("click", "error", "purchase", "signup", "view")}
    days = _events(spark, sf).withColumn("day", F.to_date("ts"))
    return pivot_sum(days, ["facility", "day"], "event_type", names, F.lit(1))


@query(
    """SELECT event_type, max(n) FILTER (r = 1) AS first_n, max(n) FILTER (r = 2) AS second_n, max(n) FILTER (r = 3) AS third_n FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY n DESC, user_id) AS r
       FROM (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY 1, 2)) GROUP BY 1"""
)
def pivot_rank(spark, sf):
    counts = table(spark, sf, "events").groupBy("event_type", "user_id").agg(F.count(F.lit(1)).alias("n"))
    ranked = ordered_window(counts, ["event_type"], [desc("n"), asc("user_id")], r=row_number())
    return pivot_sum(ranked, ["event_type"], "r", {1: "first_n", 2: "second_n", 3: "third_n"}, F.col("n"))


@query(
    """SELECT c_custkey, metric_name, metric_value, percent_rank() OVER (PARTITION BY metric_name ORDER BY metric_value) AS percentile_rank, ntile(10) OVER (PARTITION BY metric_name ORDER BY metric_value, c_custkey) AS decile,
       avg(metric_value) OVER (PARTITION BY metric_name) AS population_avg, metric_value - population_avg AS deviation_from_avg
       FROM (SELECT c_custkey, unnest(['cents', 'nation', 'some']) AS metric_name, unnest([CAST(round(c_acctbal * 100) AS BIGINT), c_nationkey, CASE WHEN c_custkey % 3 = 0 THEN c_custkey % 50 END]) AS metric_value FROM customer)
       WHERE metric_value IS NOT NULL"""
)
def unpivot_metrics(spark, sf):
    metrics = table(spark, sf, "customer").select(
        "c_custkey", cents("c_acctbal").alias("cents"), F.col("c_nationkey").cast("bigint").alias("nation"),
        F.when(F.col("c_custkey") % 3 == 0, F.col("c_custkey") % 50).alias("some"),
    )
    return metric_profile(metrics, "c_custkey", ["cents", "nation", "some"], [])


@query(
    """SELECT l_suppkey, metric, v FROM (SELECT l_suppkey, unnest(['n', 'qty']) AS metric, unnest([count(*), CAST(sum(l_quantity) AS BIGINT)]) AS v FROM lineitem GROUP BY 1)"""
)
def unpivot_plain(spark, sf):
    sums = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("bigint").alias("qty")
    )
    return unpivot(sums, ["l_suppkey"], ["n", "qty"], "metric", "v")


@query(
    """SELECT o_orderstatus, CASE WHEN o_totalprice < 50000 THEN 0 WHEN o_totalprice >= 450000 THEN 9 ELSE CAST(floor((o_totalprice - 50000) / 50000) AS BIGINT) + 1 END AS bucket, count(*) AS n,
       min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders GROUP BY 1, 2"""
)
def histogram_price(spark, sf):
    return histogram(
        table(spark, sf, "orders"), ["o_orderstatus"], "o_totalprice", 50000, 450000, 8, "bucket",
        n=F.count(F.lit(1)), lo=F.min("o_totalprice"), hi=F.max("o_totalprice"),
    )


# ---- windows --------------------------------------------------------------------------------------


@query(
    f"""SELECT event_id, rank() OVER w AS r, dense_rank() OVER w AS d, percent_rank() OVER w AS p, cume_dist() OVER w AS c, row_number() OVER (PARTITION BY event_type ORDER BY user_id DESC, event_id) AS n,
        ntile(7) OVER (PARTITION BY event_type ORDER BY user_id DESC, event_id) AS t FROM {EVE} WINDOW w AS (PARTITION BY event_type ORDER BY user_id DESC)"""
)
def rank_family(spark, sf):
    ranked = peer_ranks(
        _events(spark, sf), ["event_type"], [desc("user_id")], r="rank", d="dense_rank", p="percent_rank", c="cume_dist"
    )
    rows = ordered_window(ranked, ["event_type"], [desc("user_id"), asc("event_id")], n=row_number(), t=ntile(7))
    return rows.select("event_id", "r", "d", "p", "c", "n", "t")


@query(
    """SELECT event_id, lag(value) OVER w AS prev, lead(value) OVER w AS next, lag(value, 7) OVER w AS week_ago, value - lag(value) OVER w AS change FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"""
)
def lag_lead(spark, sf):
    v = F.col("value")
    rows = ordered_window(
        table(spark, sf, "events"), ["user_id"], [asc("ts"), asc("event_id")], prev=lag(v), next=lead(v), week_ago=lag(v, 7)
    )
    return rows.select("event_id", "prev", "next", "week_ago", (v - F.col("prev")).alias("change"))


@query(
    """SELECT event_id, first_value(event_type) OVER w AS first_type, last_value(CASE WHEN event_type = 'error' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_error
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"""
)
def first_last_ignore_nulls(spark, sf):
    rows = ordered_window(
        table(spark, sf, "events"), ["user_id"], [asc("ts"), asc("event_id")], first_type=first_of(F.col("event_type")),
        last_error=last_before(F.when(F.col("event_type") == "error", F.col("event_id"))),
    )
    return rows.select("event_id", "first_type", "last_error")


@query(
    f"""SELECT event_id, {', '.join(f'sum(cents) OVER (w ROWS {n} PRECEDING) AS s{n}, avg(cents) OVER (w ROWS {n} PRECEDING) AS a{n}' for n in (2, 3, 5, 6, 9, 29))}, sum(cents) OVER (w ROWS UNBOUNDED PRECEDING) AS run
        FROM {EVE} WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)"""
)
def moving_frames(spark, sf):
    c = F.col("cents")
    frames = {f"s{n}": moving("sum", c, n) for n in (2, 3, 5, 6, 9, 29)} | {f"a{n}": moving("avg", c, n) for n in (2, 3, 5, 6, 9, 29)}
    rows = ordered_window(_events(spark, sf), ["event_type"], [asc("ts"), asc("event_id")], run=running("sum", c), **frames)
    return rows.select("event_id", "run", *frames)


@query(
    f"""SELECT event_id, count(*) FILTER (event_type = 'error') OVER (PARTITION BY facility ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS errors_last_hour FROM {EVE}"""
)
def range_1h(spark, sf):
    rows = count_within(
        _events(spark, sf), ["facility"], "ts", 3600, F.col("event_type") == "error", "errors_last_hour"
    )
    return rows.select("event_id", "errors_last_hour")


@query("SELECT user_id, event_type, event_id, CAST(ts AS VARCHAR) AS ts FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) = 1")
def latest_by_key(spark, sf):
    rows = latest_by(table(spark, sf, "events"), ["user_id", "event_type"], [desc("ts"), asc("event_id")])
    return rows.select("user_id", "event_type", "event_id", "ts")


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 3")
def top_k_orders(spark, sf):
    rows = top_k_per_group(table(spark, sf, "orders"), ["o_custkey"], [desc("o_totalprice"), asc("o_orderkey")], 3)
    return rows.select("o_custkey", "o_orderkey", "o_totalprice")


@query("SELECT event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_id FROM events QUALIFY row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts DESC, event_id) = 1")
def latest_per_day(spark, sf):
    days = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    return latest_by(days, ["event_type", "day"], [desc("ts"), asc("event_id")]).select("event_type", "day", "event_id")


@query(f"SELECT o_orderkey, cents / sum(cents) OVER (PARTITION BY o_custkey) AS share_customer, cents / sum(cents) OVER () AS share_all FROM {ORD}")
def ratio_to_report(spark, sf):
    sums = group_totals(_orders(spark, sf), ["o_custkey"], s=F.sum("cents"))
    return share_of_total(sums, share_all="cents").select(
        "o_orderkey", share(F.col("cents"), F.col("s")).alias("share_customer"), "share_all"
    )


@query(
    f"""SELECT o_orderkey, m AS mean, cents - m AS deviation, cents > m + 2 * s AS is_outlier, CASE WHEN cents > m * 1.5 THEN 'OVER' ELSE 'WITHIN' END AS status
        FROM (SELECT *, avg(cents) OVER p AS m, stddev_samp(cents) OVER p AS s FROM {ORD} WINDOW p AS (PARTITION BY o_orderpriority))"""
)
def deviation(spark, sf):
    rows = group_totals(_orders(spark, sf), ["o_orderpriority"], m=F.avg("cents"), s=F.stddev_samp("cents"))
    c, m = F.col("cents"), F.col("m")
    return rows.select(
        "o_orderkey", m.alias("mean"), (c - m).alias("deviation"), iff(c > m + F.col("s") * 2, True, False).alias("is_outlier"),
        iff(c > m * 1.5, "OVER", "WITHIN").alias("status"),
    )


@query(
    """SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS position, ntile(4) OVER (ORDER BY c_acctbal DESC, c_custkey) AS quartile, rank() OVER (ORDER BY c_nationkey) AS nation_rank,
       percent_rank() OVER (ORDER BY c_nationkey) AS nation_pct, cume_dist() OVER (ORDER BY c_nationkey) AS nation_dist FROM customer"""
)
def global_rank(spark, sf):
    rows = ordered_window(
        table(spark, sf, "customer"), [], [desc("c_acctbal"), asc("c_custkey")], position=row_number(), quartile=ntile(4)
    )
    ranked = peer_ranks(
        rows, [], [asc("c_nationkey")], nation_rank="rank", nation_pct="percent_rank", nation_dist="cume_dist"
    )
    return ranked.select("c_custkey", "position", "quartile", "nation_rank", "nation_pct", "nation_dist")


@query(
    """SELECT o_orderkey, row_number() OVER (ORDER BY CASE WHEN o_orderstatus <> 'O' THEN o_totalprice END DESC NULLS LAST, o_orderkey) AS last_pos, row_number() OVER (ORDER BY CASE WHEN o_orderstatus <> 'O' THEN o_totalprice END DESC NULLS FIRST, o_orderkey) AS first_pos,
       row_number() OVER (ORDER BY o_orderpriority ASC NULLS LAST, o_totalprice DESC NULLS FIRST, o_orderkey) AS mixed FROM orders"""
)
def sorted_nulls(spark, sf):
    """Final sorts with each NULL placement, as positions."""
    rows = table(spark, sf, "orders").withColumn("known", F.expr("if(o_orderstatus <> 'O', o_totalprice, null)"))
    key = asc("o_orderkey")
    rows = ordered_window(rows, [], [desc("known", nulls="last"), key], last_pos=row_number())
    rows = ordered_window(rows, [], [desc("known"), key], first_pos=row_number())
    rows = ordered_window(rows, [], [asc("o_orderpriority"), desc("o_totalprice"), key], mixed=row_number())
    return rows.select("o_orderkey", "last_pos", "first_pos", "mixed")


# ---- sets and arrays ------------------------------------------------------------------------------

ALERTS = f"""(SELECT user_id AS who, 'EVENT' AS feed, 'event ' || event_type AS message, CASE WHEN event_type = 'error' THEN 1 ELSE 3 END AS priority, ts AS seen, event_id AS id FROM events WHERE event_type IN ('error', 'signup')
    UNION ALL SELECT o_custkey, 'ORDER', 'order ' || o_orderpriority, 2, o_orderdate, o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT'
    UNION ALL SELECT l_suppkey, 'LINE', 'line ' || l_linenumber, 3, l_shipdate, l_orderkey FROM lineitem WHERE l_quantity > 48 AND l_returnflag = 'R')"""


@query(
    f"""SELECT who, feed, message, priority, CAST(seen AS VARCHAR) AS seen, id, dense_rank() OVER (PARTITION BY who ORDER BY priority, seen DESC) AS alert_rank, count(*) OVER (PARTITION BY who) AS total_patient_alerts,
        first_value(message) OVER (PARTITION BY who ORDER BY priority, seen DESC, feed, message) AS most_critical_alert FROM {ALERTS}"""
)
def union_alerts(spark, sf):
    event = table(spark, sf, "events").filter(F.col("event_type").isin("error", "signup")).select(
        F.col("user_id").alias("who"), F.lit("EVENT").alias("feed"), F.concat(F.lit("event "), "event_type").alias("message"),
        iff(F.col("event_type") == "error", 1, 3).alias("priority"), F.col("ts").alias("seen"), F.col("event_id").alias("id"),
    )
    order = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").select(
        F.col("o_custkey").alias("who"), F.lit("ORDER").alias("feed"), F.concat(F.lit("order "), "o_orderpriority").alias("message"),
        F.lit(2).alias("priority"), F.col("o_orderdate").alias("seen"), F.col("o_orderkey").alias("id"),
    )
    line = table(spark, sf, "lineitem").filter("l_quantity > 48 AND l_returnflag = 'R'").select(
        F.col("l_suppkey").alias("who"), F.lit("LINE").alias("feed"),
        F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("message"), F.lit(3).alias("priority"),
        F.col("l_shipdate").alias("seen"), F.col("l_orderkey").alias("id"),
    )
    return unify_alerts(union_all(event, order, line), "who", "priority", "seen", "message", ["feed", "message"])


@query(
    """SELECT l_orderkey, len(f) AS n_flags, list_contains(f, 'R') AS has_r, len(list_intersect(f, ['A', 'N', 'X'])) AS common, array_to_string(f, ' | ') AS joined FROM (SELECT l_orderkey, list_sort(list(DISTINCT l_returnflag)) AS f FROM lineitem GROUP BY 1)"""
)
def array_ops(spark, sf):
    sets = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(sorted_set("l_returnflag").alias("f"))
    watched = F.array(F.lit("A"), F.lit("N"), F.lit("X"))
    return sets.select(
        "l_orderkey", F.array_size("f").alias("n_flags"), F.array_contains("f", "R").alias("has_r"),
        F.array_size(F.array_intersect("f", watched)).alias("common"), F.array_join("f", " | ").alias("joined"),
    )


@query(
    f"""SELECT l_orderkey, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS types, coalesce(string_agg(DISTINCT p_type, ',' ORDER BY p_type) FILTER (p_type IN ('PROMO', 'LARGE')), '') AS watched,
        count(DISTINCT p_type) FILTER (p_type IN ('PROMO', 'LARGE')) = 2 AS both FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1"""
)
def watchlist(spark, sf):
    found = watchlist_overlap(_basket(spark, sf), "l_orderkey", {"types": "p_type"}, {"watched": ("types", ["PROMO", "LARGE"])})
    return found.withColumn("both", F.array_size("watched") == 2)


# ---- time -----------------------------------------------------------------------------------------


@query(
    """SELECT o_orderkey, CAST(d AS VARCHAR) AS date_day, year(d) AS year_num, quarter(d) AS quarter_num, month(d) AS month_num, left(monthname(d), 3) AS month_name, weekofyear(d) AS week_num, dayofweek(d) AS day_of_week,
       left(dayname(d), 3) AS day_name, day(d) AS day_of_month, dayofyear(d) AS day_of_year, dayofweek(d) IN (0, 6) AS is_weekend, d = last_day(d) AS is_month_end, CAST(CAST(date_trunc('month', d) AS DATE) AS VARCHAR) AS first_of_month,
       CAST(last_day(d) AS VARCHAR) AS last_of_month, day(d) AS day_of_month_seq, 'Q' || ((month(d) + 5) % 12 // 3 + 1) AS fiscal_quarter, 'FY' || (year(d) + (month(d) > 6)::INT) AS fiscal_year
       FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)"""
)
def calendar_orders(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("date_day"))
    first, last = orders.agg(F.min("date_day"), F.max("date_day")).first()
    return orders.join(calendar(spark, first.isoformat(), (last - first).days + 1), "date_day")


@query(
    """SELECT CAST(d AS VARCHAR) AS date_day, (SELECT count(*) FROM orders WHERE CAST(o_orderdate AS DATE) = d) AS n FROM (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS d FROM orders)"""
)
def spine_orders(spark, sf):
    orders = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date_day"))
    first, last = orders.agg(F.min("date_day"), F.max("date_day")).first()
    days = time_spine(spark, first.isoformat(), last.isoformat())
    counts = orders.groupBy("date_day").agg(F.count(F.lit(1)).alias("n"))
    return days.join(counts, "date_day", "left").select("date_day", zero_if_null(F.col("n")).alias("n"))


@query(
    """SELECT i AS seq, i * 7 AS low, i * 7 + 7 AS high, count(event_id) AS n FROM (SELECT unnest(range(CAST(floor(max(value) / 7) AS BIGINT) + 1)) AS i FROM events)
       LEFT JOIN events ON greatest(value, 0) >= i * 7 AND greatest(value, 0) < i * 7 + 7 GROUP BY i"""
)
def generated_buckets(spark, sf):
    """As many buckets as the largest value needs; what is below zero counts in the first."""
    events = table(spark, sf, "events").select(F.floor(F.greatest("value", F.lit(0)) / 7).alias("seq"))
    counts = events.groupBy("seq").agg(F.count(F.lit(1)).alias("n"))
    last = events.agg(F.max("seq")).first()[0] or 0
    rows = row_generator(spark, int(last) + 1).select("seq", (F.col("seq") * 7).alias("low"), (F.col("seq") * 7 + 7).alias("high"))
    return rows.join(counts, "seq", "left").withColumn("n", zero_if_null(F.col("n")))


@query(
    """SELECT event_id, year(ts) AS y, CAST(date_trunc('hour', ts) AS VARCHAR) AS h, CAST(CAST(date_trunc('day', ts) AS TIMESTAMP) AS VARCHAR) AS d, CAST(CAST(date_trunc('week', ts) AS TIMESTAMP) AS VARCHAR) AS w,
       CAST(CAST(date_trunc('month', ts) AS DATE) AS VARCHAR) AS m, hour(ts) AS hr, dayofweek(ts) AS dow, datediff('hour', ts, TIMESTAMP '2024-02-01 00:30:00') AS hours_left, datediff('minute', ts, TIMESTAMP '2024-02-01 00:30:00') AS minutes_left,
       CAST(ts + INTERVAL 12 HOUR AS VARCHAR) AS later, datesub('year', DATE '1950-01-20', CAST(ts AS DATE)) AS age, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS txt,
       'Q' || ((month(ts) + 5) % 12 // 3 + 1) AS fq, 'FY' || (year(ts) + (month(ts) > 6)::INT) AS fy FROM events"""
)
def date_parts(spark, sf):
    ts, end = F.col("ts"), F.lit("2024-02-01 00:30:00").cast("timestamp_ntz")
    return table(spark, sf, "events").select(
        "event_id", F.year(ts).alias("y"), floor_hour(ts).alias("h"), floor_day(ts).alias("d"), floor_week(ts).alias("w"),
        floor_month(ts).alias("m"), F.hour(ts).alias("hr"), day_of_week(ts).alias("dow"),
        boundary_diff("hour", ts, end).alias("hours_left"), boundary_diff("minute", ts, end).alias("minutes_left"),
        plus("hour", 12, ts).alias("later"), completed_years(F.lit("1950-01-20").cast("date"), ts).alias("age"),
        text_of(ts).alias("txt"), fiscal_quarter(ts).alias("fq"), fiscal_year(ts).alias("fy"),
    )


@query(
    """SELECT facility, CAST(d AS VARCHAR) AS forecast_date, n AS actual_count, round(avg(n) OVER (w ROWS 6 PRECEDING), 1) AS forecast_7d, round(avg(n) OVER (w ROWS 29 PRECEDING), 1) AS forecast_30d, d > DATE '2024-01-29' AS is_forecast,
       n - round(avg(n) OVER (w ROWS 6 PRECEDING), 0) AS variance_from_forecast
       FROM (SELECT f AS facility, d, (SELECT count(*) FROM events e WHERE e.user_id % 6 = f AND CAST(ts AS DATE) = d) AS n FROM (SELECT DISTINCT user_id % 6 AS f FROM events), (SELECT DATE '2023-10-31' + CAST(i AS INTEGER) AS d FROM range(120) t(i)))
       WINDOW w AS (PARTITION BY facility ORDER BY d)"""
)
def densify_forecast_events(spark, sf):
    daily = _events(spark, sf).groupBy("facility", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return densify_forecast(daily, "facility", "day", "n", F.lit("2024-01-29").cast("date"))


@query(
    """SELECT user_id, CAST(h AS VARCHAR) AS expected_time, n IS NULL AS is_gap, datediff('hour', lag(CASE WHEN n IS NOT NULL THEN h END) OVER w, h) AS hours_since_last, coalesce(n, 0) AS readings_in_window, avg_hr,
       CASE WHEN datediff('hour', lag(CASE WHEN n IS NOT NULL THEN h END) OVER w, h) > 2 THEN 'UNREACHED' ELSE 'OK' END AS gap_severity, sum((n IS NULL)::INT) OVER (w ROWS 3 PRECEDING) AS consecutive_gaps
       FROM (SELECT u.user_id, h, n, avg_hr FROM (SELECT DISTINCT user_id FROM events WHERE ts >= DATE '2024-01-22') u, (SELECT TIMESTAMP '2024-01-22 12:00:00' + to_hours(i) AS h FROM range(168) t(i))
         LEFT JOIN (SELECT user_id, date_trunc('hour', ts) AS hh, count(*) AS n, avg(CAST(round(value * 100) AS BIGINT)) AS avg_hr FROM events WHERE ts >= DATE '2024-01-22' GROUP BY 1, 2) r ON r.user_id = u.user_id AND hh = h)
       WINDOW w AS (PARTITION BY user_id ORDER BY h)"""
)
def detect_gaps_events(spark, sf):
    return detect_gaps(_events(spark, sf), "user_id", "ts", "cents", F.lit(EVENT_NOW.isoformat(sep=" ")).cast("timestamp_ntz"))


@query(
    """SELECT user_id, CAST(h AS VARCHAR) AS expected_time, g AS hours_since_last, CASE WHEN g > 4 THEN 'CRITICAL_GAP' WHEN g > 2 THEN 'WARNING_GAP' ELSE 'OK' END AS gap_severity FROM (
       SELECT u.user_id, h, datediff('hour', last_value(hh IGNORE NULLS) OVER (PARTITION BY u.user_id ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), h) AS g
       FROM (SELECT DISTINCT user_id FROM events WHERE ts >= DATE '2024-01-22') u, (SELECT TIMESTAMP '2024-01-22 12:00:00' + to_hours(i) AS h FROM range(168) t(i))
       LEFT JOIN (SELECT DISTINCT user_id, date_trunc('hour', ts) AS hh FROM events WHERE ts >= DATE '2024-01-22') r ON r.user_id = u.user_id AND hh = h)"""
)
def detect_gaps_filled(spark, sf):
    """Gaps counted from the last slot that has a reading."""
    now = F.lit(EVENT_NOW.isoformat(sep=" ")).cast("timestamp_ntz")
    gaps = detect_gaps(_events(spark, sf), "user_id", "ts", "cents", now, ignore_nulls=True)
    return gaps.select("user_id", "expected_time", "hours_since_last", "gap_severity")


@query(
    """SELECT user_id, CAST(CAST(d AS TIMESTAMP) AS VARCHAR) AS event_date, n AS daily_event_count, c AS daily_critical, a AS avg_resolution, avg(n) OVER (w ROWS 6 PRECEDING) AS rolling_7d_avg_events, sum(c) OVER (w ROWS 29 PRECEDING) AS rolling_30d_critical_sum,
       sum(n) OVER (w ROWS UNBOUNDED PRECEDING) AS cumulative_events, rank() OVER (PARTITION BY user_id ORDER BY n DESC) AS busiest_day_rank, n - lag(n, 7) OVER w AS week_over_week_change
       FROM (SELECT user_id, CAST(ts AS DATE) AS d, count(*) AS n, count_if(event_type = 'error') AS c, avg(CAST(round(value * 100) AS BIGINT)) AS a FROM events GROUP BY 1, 2) WINDOW w AS (PARTITION BY user_id ORDER BY d)"""
)
def rolling_daily_events(spark, sf):
    return rolling_daily(_events(spark, sf), "user_id", "ts", F.col("event_type") == "error", "cents")


@query(
    f"""SELECT event_id, t AS sla_target_minutes, value <= t AS sla_met, avg(cents) OVER (PARTITION BY facility, event_type ORDER BY ts, event_id ROWS 9 PRECEDING) AS mean_10
        FROM (SELECT *, CASE event_type WHEN 'error' THEN 30 WHEN 'purchase' THEN 120 ELSE 480 END AS t FROM {EVE})"""
)
def sla_events(spark, sf):
    target = lookup(F.col("event_type"), {"error": 30, "purchase": 120}, 480)
    rated = sla(_events(spark, sf), ["facility", "event_type"], "ts", "event_id", "value", target)
    mean = ordered_window(
        rated, ["facility", "event_type"], [asc("ts"), asc("event_id")], mean_10=moving("avg", F.col("cents"), 9)
    )
    return mean.select("event_id", "sla_target_minutes", "sla_met", "mean_10")


@query(
    f"""SELECT o_orderkey, encounter_seq, CAST(prev_discharge AS VARCHAR) AS prev_discharge, prev_key, CAST(next_admit AS VARCHAR) AS next_admit, total_encounters, g AS days_since_last_discharge, coalesce(g <= 30, false) AS is_30_day_readmission,
        coalesce(g <= 7, false) AS is_7_day_readmission, coalesce(datediff('day', o_end, next_admit) <= 30, false) AS will_readmit_30d,
        CASE WHEN g <= 7 THEN 'Very High Risk' WHEN g <= 14 THEN 'High Risk' WHEN g <= 30 THEN 'Moderate Risk' ELSE 'Low Risk' END AS readmission_risk_level
        FROM (SELECT *, row_number() OVER w AS encounter_seq, lag(o_end) OVER w AS prev_discharge, lag(o_orderkey) OVER w AS prev_key, lead(o_orderdate) OVER w AS next_admit, count(*) OVER (PARTITION BY o_custkey) AS total_encounters,
          datediff('day', prev_discharge, o_orderdate) AS g FROM {ORD} WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))"""
)
def return_intervals_orders(spark, sf):
    orders = _orders(spark, sf).select("o_orderkey", "o_custkey", "o_orderdate", "o_end")
    rows = return_intervals(orders, "o_custkey", "o_orderdate", "o_end", "o_orderkey", {"prev_key": "o_orderkey"})
    return rows.drop("o_custkey", "o_orderdate", "o_end")


@query(
    """SELECT o_custkey, o_orderpriority, o_orderkey, n AS fill_number, CAST(p AS VARCHAR) AS prev_fill_date, t AS total_fills, g AS days_between_fills, coalesce(g > 30, false) AS is_gap, coalesce(g > 90, false) AS is_lapse,
       CASE WHEN g IS NULL THEN 'FIRST_FILL' WHEN g <= 35 THEN 'ADHERENT' WHEN g <= 90 THEN 'PARTIAL' ELSE 'NON_ADHERENT' END AS adherence_status
       FROM (SELECT *, row_number() OVER w AS n, lag(o_orderdate) OVER w AS p, count(*) OVER (PARTITION BY o_custkey, o_orderpriority) AS t, datediff('day', p, o_orderdate) AS g FROM orders
         WINDOW w AS (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate, o_orderkey))"""
)
def adherence_orders(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderpriority", "o_orderkey", "o_orderdate")
    return adherence(orders, "o_custkey", "o_orderpriority", "o_orderdate", "o_orderkey").drop("o_orderdate")


@query(
    f"""SELECT * EXCLUDE (d, p, user_id, ts) FROM (SELECT *, cents - p AS change_from_prev, CASE WHEN prev_value IS NULL OR prev_value = 0 THEN 0.0 ELSE (cents - prev_value) / abs(prev_value) * 100 END AS pct_change, cents < 500 OR cents > 6000 AS is_abnormal,
          CASE WHEN cents < 500 AND p >= 500 THEN 'NEW_LOW' WHEN cents > 6000 AND p <= 6000 THEN 'NEW_HIGH' WHEN cents BETWEEN 500 AND 6000 AND (coalesce(prev_value, 0) < 500 OR coalesce(prev_value, 999) > 6000) THEN 'NORMALIZED' ELSE 'STABLE' END AS trend_status
        FROM (SELECT event_id, user_id, ts, cents, CAST(ts AS DATE) AS d, row_number() OVER w AS result_seq, lag(cents) OVER w AS prev_value, lead(cents) OVER w AS next_value, coalesce(prev_value, cents) AS p, avg(cents) OVER (w ROWS 2 PRECEDING) AS moving_avg_3,
            min(cents) OVER a AS min_value, max(cents) OVER a AS max_value, count(*) OVER a AS total_readings FROM {EVE} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id), a AS (PARTITION BY user_id)))
        QUALIFY row_number() OVER (PARTITION BY user_id, d ORDER BY ts DESC, event_id DESC) = 1"""
)
def trend_states_events(spark, sf):
    rows = _events(spark, sf).select("event_id", "user_id", "ts", "cents").withColumns({"lo": F.lit(500), "hi": F.lit(6000)})
    return trend_states(rows, ["user_id"], "ts", "event_id", "cents", "lo", "hi").drop("lo", "hi", "user_id", "ts")


# ---- features -------------------------------------------------------------------------------------


@query(
    """SELECT p_partkey, f AS flags, f % 2 = 1 AS large, f // 2 % 2 = 1 AS promo, f // 4 = 1 AS dear, bit_count(f) AS n FROM (SELECT p_partkey, (p_size > 25)::INT + 2 * (p_type = 'PROMO')::INT + 4 * (p_retailprice > 950)::INT AS f FROM part)"""
)
def bit_flags(spark, sf):
    rules = [F.col("p_size") > 25, F.col("p_type") == "PROMO", F.col("p_retailprice") > 950]
    coded = table(spark, sf, "part").select("p_partkey", encode_flags(rules).alias("flags"))
    f = F.col("flags")
    return coded.select(
        "p_partkey", "flags", *[has_flag(f, i).alias(n) for i, n in enumerate(("large", "promo", "dear"))], count_flags(f).alias("n")
    )


@query(
    """SELECT md5(p_name || '|' || p_brand) AS h, sha256(p_name) AS s, p_partkey, true AS bucket_ok, true AS same_bucket FROM part QUALIFY row_number() OVER (PARTITION BY p_name, p_brand ORDER BY p_retailprice DESC, p_partkey) = 1"""
)
def hash_dedup_parts(spark, sf):
    key = md5_key(F.col("p_name"), F.col("p_brand"))
    kept = hash_dedup(table(spark, sf, "part"), key, [desc("p_retailprice"), asc("p_partkey")])
    cut = buckets(kept, {"b": ("p_brand", 10)})
    return cut.select(
        key.alias("h"), mask_pii(F.col("p_name")).alias("s"), "p_partkey", F.col("b").between(0, 9).alias("bucket_ok"),
        (hash_bucket(F.col("p_brand"), 10) == F.col("b")).alias("same_bucket"),
    )


@query(
    r"""SELECT doc_id, nullif(regexp_extract(text, '(?i)(the|und|que|les)'), '') AS first_med_mention, len(regexp_extract_all(text, '(?i)(the|und|que|les)')) AS med_mention_count, nullif(regexp_extract(text, '([0-9]{3})-[0-9]', 1), '') AS code,
       CASE WHEN regexp_matches(text, '(?i)(license|copyright)') THEN 'Legal' WHEN regexp_matches(text, '(?i)(secret|password|key)') THEN 'Secret' ELSE 'General' END AS note_classification,
       nullif(regexp_extract(text, '(ND|TH|PT)'), '') AS first_abbreviation, len(string_split(text, ' ')) AS word_count, length(text) AS char_count FROM documents"""
)
def note_features_documents(spark, sf):
    classes = [("(license|copyright)", "Legal"), ("(secret|password|key)", "Secret")]
    found = note_features(F.col("text"), "(the|und|que|les)", {"code": "([0-9]{3})-[0-9]"}, classes, "(ND|TH|PT)")
    del found["abbreviation_count"]
    return table(spark, sf, "documents").select("doc_id", *[c.alias(n) for n, c in found.items()])


@query(
    r"""SELECT doc_id, left(text, 50) AS preview, length(text) AS n, contains(text, 'STAT') AS urgent, upper(trim(lang)) AS lang, regexp_replace(source, '[^0-9]', '', 'g') AS digits, nullif(regexp_extract(source, '[0-9]$'), '') AS last_digit,
       nullif(regexp_extract(url, '^(https?)://', 1), '') AS scheme, len(regexp_extract_all(text, '[A-Z]')) AS capitals FROM documents LEFT JOIN pages ON page_id = doc_id"""
)
def string_ops(spark, sf):
    text = F.col("text")
    docs = table(spark, sf, "documents").join(table(spark, sf, "pages"), F.col("doc_id") == F.col("page_id"), "left")
    return docs.select(
        "doc_id", F.left(text, F.lit(50)).alias("preview"), F.length(text).alias("n"), F.contains(text, F.lit("STAT")).alias("urgent"),
        F.upper(F.trim("lang")).alias("lang"), squash(F.col("source"), "0-9").alias("digits"), find_text(F.col("source"), "[0-9]$").alias("last_digit"),
        find_group(F.col("url"), "^(https?)://").alias("scheme"), F.regexp_count(text, F.lit("[A-Z]")).alias("capitals"),
    )


@query(
    """SELECT *, (a + b) / 100.0::DOUBLE AS total_per_diem, (a + b) * 30 / 100.0::DOUBLE AS projected_monthly_revenue, (a + b) / 100.0::DOUBLE / (sum(a + b) OVER () / 100.0::DOUBLE) AS revenue_share FROM (
       SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 22550 WHEN 'O' THEN 19830 ELSE 13500 END AS a, CASE o_orderpriority WHEN '1-URGENT' THEN 5525 ELSE 3500 END AS b FROM orders)"""
)
def rate_card_orders(spark, sf):
    cards = {
        "a": ("o_orderstatus", {"F": "225.50", "O": "198.30"}, "135.00"),
        "b": ("o_orderpriority", {"1-URGENT": "55.25"}, "35.00"),
    }
    rows = rate_card(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"), cards, 30)
    return rows.select(
        "o_orderkey", *[(F.col(f"{n}_rate") * 100).cast("bigint").alias(n) for n in "ab"], "total_per_diem",
        "projected_monthly_revenue", "revenue_share",
    )


@query(
    f"""SELECT c_custkey, n_name, coalesce(n, 0) AS n_orders, last_status, coalesce(e, 0) AS n_events, coalesce(n >= 10 AND e > 50, false) AS is_active FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
        LEFT JOIN (SELECT o_custkey, count(*) AS n, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS last_status FROM orders GROUP BY 1) ON o_custkey = c_custkey
        LEFT JOIN (SELECT user_id, count(*) AS e FROM events GROUP BY 1) ON user_id = c_custkey"""
)
def entity_360(spark, sf):
    orders = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n"), F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("last_status")
    )
    events = table(spark, sf, "events").groupBy(F.col("user_id").alias("c_custkey")).agg(F.count(F.lit(1)).alias("e"))
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    people = table(spark, sf, "customer").join(nation, "c_nationkey", "left")
    return fan_in(people, [orders, events], "c_custkey").select(
        "c_custkey", "n_name", zero_if_null(F.col("n")).alias("n_orders"), "last_status",
        zero_if_null(F.col("e")).alias("n_events"), iff((F.col("n") >= 10) & (F.col("e") > 50), True, False).alias("is_active"),
    )


# ---- sources, sinks and history -------------------------------------------------------------------


@query("SELECT n_nationkey, n_name, count(c_custkey) AS n FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL")
def seed_join(spark, sf):
    """A CSV reference table, read with its declared schema and joined."""
    path = fresh_path(spark, "seed")
    table(spark, sf, "nation").write.option("header", True).csv(path)
    seed = read_seed(spark, path, "n_nationkey int, n_name string, n_regionkey int")
    counts = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("n"))
    return seed.join(counts, "n_nationkey", "left").select("n_nationkey", "n_name", zero_if_null(F.col("n")).alias("n"))


@query(f"SELECT o_orderpriority, count(*) AS n, sum(cents) AS total, 'gold' AS layer FROM {ORD} GROUP BY 1")
def publish_layers(spark, sf):
    """A staging view, and a table built from it and read back."""
    view = publish_view(_orders(spark, sf), "orders_clean", "bronze")
    sums = spark.table(view).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("total"))
    path = publish_table(sums, fresh_path(spark, "published"), "gold", "priority_totals")
    return spark.read.parquet(path).withColumn("layer", F.lit("gold"))


@query("SELECT count(*) AS n, min(o_orderkey) AS lo FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < DATE '2000-01-01')")
def newer_than_mark(spark, sf):
    orders = table(spark, sf, "orders")
    mark = orders.filter("o_orderdate < date'2000-01-01'").agg(F.max("o_orderdate").cast("string")).first()[0]
    return newer_than(orders, "o_orderdate", mark).agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("lo"))


@query(
    f"""SELECT o_custkey, o_orderkey, o_orderstatus, cents, CAST(o_orderdate AS VARCHAR) AS o_orderdate FROM {ORD}
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1"""
)
def merge_upsert_orders(spark, sf):
    """Four incremental runs that keep each customer's newest order, the last of them with all orders, then a compaction."""
    orders = _orders(spark, sf).select("o_custkey", "o_orderkey", "o_orderstatus", "cents", "o_orderdate")
    target = KeyedTable(spark, fresh_path(spark, "upsert"), "o_custkey")
    order = [desc("o_orderdate"), asc("o_orderkey")]
    for end in ("1997-01-01", "1999-06-15", "2001-01-01", "9999-01-01"):
        arrived = orders.filter(F.col("o_orderdate") < F.lit(end).cast("date"))
        merge_upsert(target, arrived, "o_orderdate", order, lambda rows: rows)
    target.compact()
    return target.read()


@query(
    f"""SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE)::VARCHAR AS month, count(*) AS n, sum(cents) AS total FROM {ORD} GROUP BY 1, 2"""
)
def merge_aggregate_orders(spark, sf):
    """Monthly totals over arrival in two halves: months touched by both are totalled from all rows."""
    orders = _orders(spark, sf).withColumns(
        {"month": floor_month(F.col("o_orderdate")), "arrived": F.pmod("o_orderkey", F.lit(2))}
    )
    target = KeyedTable(spark, fresh_path(spark, "aggregate"), "key")

    def totals(rows: DataFrame) -> DataFrame:
        sums = rows.groupBy("o_orderpriority", "month").agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("total"))
        return sums.withColumn("key", surrogate_key(F.col("o_orderpriority"), F.col("month")))

    for last in (0, 1):
        merge_aggregate(target, orders.filter(F.col("arrived") <= last), "arrived", ["o_orderpriority", "month"], totals)
    return target.read().drop("key")


def _plan(year: str):
    return f"(SELECT o_custkey AS id, o_orderpriority AS plan, o_orderkey AS ref FROM orders WHERE o_orderdate < DATE '{year}-01-01' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1)"


@query(
    f"""WITH a AS {_plan('1998')}, b AS {_plan('9999')}
        SELECT id, plan, ref, '1998-01-01 00:00:00' AS valid_from, CASE WHEN b.plan <> a.plan THEN '9999-01-01 00:00:00' END AS valid_to FROM a JOIN (SELECT id, plan FROM b) b USING (id)
        UNION ALL SELECT id, b.plan, b.ref, '9999-01-01 00:00:00', NULL FROM b LEFT JOIN (SELECT id, plan AS p FROM a) a USING (id) WHERE p IS NULL OR p <> b.plan""".replace(
        "SELECT id, plan, ref, '1998", "SELECT id, a.plan, ref, '1998"
    )
)
def scd2_snapshot_plans(spark, sf):
    """Two snapshots of each customer's current priority, the second after all orders."""
    orders = table(spark, sf, "orders")
    history = None
    for year in ("1998", "9999"):
        before = orders.filter(F.col("o_orderdate") < F.lit(f"{year}-01-01").cast("date"))
        now = latest_by(before, ["o_custkey"], [desc("o_orderdate"), asc("o_orderkey")]).select(
            F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("plan"), F.col("o_orderkey").alias("ref")
        )
        as_of = F.lit(f"{year}-01-01 00:00:00").cast("timestamp_ntz")
        history = scd2_snapshot(history, now, "id", ["plan"], as_of)
    return history.drop("row_id")


@query(
    """SELECT o_orderkey, o_custkey, CAST(o_orderdate AS VARCHAR) AS valid_from, CAST(lead(o_orderdate) OVER w AS VARCHAR) AS valid_to, lead(o_orderdate) OVER w IS NULL AS is_current FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)"""
)
def scd2_from_log_orders(spark, sf):
    log = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return scd2_from_log(log, "o_custkey", "o_orderdate", ["o_orderkey"]).drop("o_orderdate")


@query(
    """SELECT md5(CAST(c_custkey AS VARCHAR)) AS cust_key, c_custkey AS cust_id, c_name, c_nationkey, '2001-01-01 00:00:00' AS valid_from, '9999-12-31' AS valid_to, true AS is_current, md5(c_custkey || '|' || c_name || '|' || c_nationkey) AS row_hash FROM customer"""
)
def current_dimension_customers(spark, sf):
    rows = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("cust_id"), "c_name", "c_nationkey", F.lit("2001-01-01 00:00:00").cast("timestamp_ntz").alias("seen")
    )
    return current_dimension(rows, "cust_id", ["cust_id", "c_name", "c_nationkey"], "seen", "9999-12-31")


@query(
    """SELECT user_id, event_id, event_type, CAST(ts AS VARCHAR) AS ts FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) = 1"""
)
def stream_upsert_events(spark, sf):
    """The keyed upsert fed by a stream that stops when all files are read."""
    events = table(spark, sf, "events")
    stream = spark.readStream.schema(events.schema).parquet(f"{sf}/events.parque[t]")
    target = KeyedTable(spark, fresh_path(spark, "streamed"), "user_id")
    upsert_stream(stream, target, [desc("ts"), asc("event_id")], fresh_path(spark, "progress"))
    return target.read().select("user_id", "event_id", "event_type", "ts")
