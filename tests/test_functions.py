"""One test per semantic hazard: dates, NULL rules, division, regular expressions, keys."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from wardflow import functions as W


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first().asDict()


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.mark.parametrize(
    ("unit", "start", "end", "expected"),
    [
        ("year", "2000-12-31 00:00:00", "2001-01-01 00:00:00", 1),
        ("month", "2001-01-31 00:00:00", "2001-02-01 00:00:00", 1),
        ("day", "2001-01-01 23:00:00", "2001-01-02 01:00:00", 1),
        ("hour", "2001-01-01 00:59:00", "2001-01-01 01:01:00", 1),
        ("minute", "2001-01-01 00:00:59", "2001-01-01 00:01:00", 1),
        ("hour", "2001-01-02 01:00:00", "2001-01-01 23:30:00", -2),
    ],
)
def test_boundaries_are_counted(spark, unit, start, end, expected):
    assert one(spark, d=W.boundary_diff(unit, ts(start), ts(end)))["d"] == expected


def test_boundary_diff_of_null_and_bad_unit(spark):
    assert one(spark, d=W.boundary_diff("day", ts(None), ts("2001-01-01 00:00:00")))["d"] is None
    with pytest.raises(ValueError):
        W.boundary_diff("century", F.lit(1), F.lit(2))


def test_weekdays_start_on_sunday(spark):
    row = one(spark, sat=W.day_of_week(F.lit("2024-01-06").cast("date")), sun=W.day_of_week(F.lit("2024-01-07").cast("date")))
    assert row == {"sat": 6, "sun": 0}


def test_division_rules(spark):
    zero, none, two = F.lit(0), F.lit(None).cast("int"), F.lit(2)
    row = one(
        spark, a=W.div0null(two, zero), b=W.div0null(two, none), c=W.div0null(none, two), d=W.safe_divide(two, zero),
        e=W.safe_divide(two, none), f=W.share(F.lit(0), zero), g=W.div0null(F.lit(5), two),
    )
    assert row == {"a": 0.0, "b": 0.0, "c": None, "d": None, "e": None, "f": None, "g": 2.5}


def test_whole_numbers_round_and_fail_loudly(spark):
    assert one(spark, n=W.whole(F.lit("98.6")))["n"] == 99
    assert one(spark, n=W.whole(F.lit("n/a"), safe=True))["n"] is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, n=W.whole(F.lit("n/a")))


def test_dates_stay_dates_and_floors(spark):
    moment = ts("2024-02-14 13:45:10")
    row = one(
        spark, m=W.floor_month(moment), d=W.floor_day(moment), h=W.floor_hour(moment), w=W.floor_week(moment),
        p=W.plus("hour", 12, moment), fq=W.fiscal_quarter(moment), fy=W.fiscal_year(moment),
    )
    assert row["m"] == date(2024, 2, 1)
    assert row["d"] == datetime(2024, 2, 14)
    assert row["h"] == datetime(2024, 2, 14, 13)
    assert row["w"] == datetime(2024, 2, 12)
    assert row["p"] == datetime(2024, 2, 15, 1, 45, 10)
    assert (row["fq"], row["fy"]) == ("Q3", "FY2024")


def test_floor_hour_does_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # This wall-clock hour does not exist in New York.
        assert one(spark, h=W.floor_hour(ts("2024-03-10 02:30:00")))["h"] == datetime(2024, 3, 10, 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_ages(spark):
    born, today = F.lit("1950-08-02").cast("date"), F.lit("2001-08-01").cast("date")
    assert one(spark, a=W.completed_years(born, today), b=W.boundary_diff("year", born, today)) == {"a": 50, "b": 51}


def test_clock_times(spark):
    row = one(spark, a=W.clock_time(F.lit("08:50")), b=W.clock_time(F.lit("08:50:30")), c=W.clock_time(F.lit("late")))
    assert row == {"a": datetime(1970, 1, 1, 8, 50), "b": datetime(1970, 1, 1, 8, 50, 30), "c": None}


def test_text_helpers_give_null_on_a_miss(spark):
    note = F.lit("BP 120/80, call (555) 1-2")
    row = one(
        spark, bp=W.find_group(note, r"BP\s*([0-9]+/[0-9]+)"), none=W.find_group(note, r"GFR ([0-9]+)"),
        miss=W.find_text(note, "O[0-9]{4}"), digits=W.squash(F.lit("(555) 1-2"), "0-9"),
    )
    assert row == {"bp": "120/80", "none": None, "miss": None, "digits": "55512"}


def test_keys(spark):
    import hashlib

    row = one(
        spark, s=W.surrogate_key(F.lit("a"), F.lit(None).cast("string")), m=W.md5_key(F.lit("a"), F.lit("b")),
        n=W.md5_key(F.lit("a"), F.lit(None).cast("string")), p=W.mask_pii(F.lit("x")), t=W.text_of(ts("2024-01-01 00:00:00.5")),
    )
    assert row["s"] == hashlib.md5(b"a|_null_").hexdigest()
    assert row["m"] == hashlib.md5(b"a|b").hexdigest()
    assert row["n"] is None
    assert row["p"] == hashlib.sha256(b"x").hexdigest()
    assert row["t"] == "2024-01-01 00:00:00.500000"


def test_hash_buckets_are_stable_and_in_range(spark):
    rows = spark.range(1000).select(W.hash_bucket(F.col("id"), 10).alias("a"), W.hash_bucket(F.col("id"), 10).alias("b")).collect()
    assert all(r.a == r.b and 0 <= r.a < 10 for r in rows)
    assert len({r.a for r in rows}) == 10


def test_conditions(spark):
    v = F.lit(5)
    row = one(
        spark, a=W.iff(F.lit(None).cast("boolean"), 1, 2), b=W.band([(v > 9, "x"), (v > 4, "y")], "z"),
        c=W.lookup(F.lit("q"), {"p": 1}, 0), d=W.classify_severity(v, 1, 4, 0, 9), e=W.classify_severity(v, 1, 8, 5, 9),
    )
    assert row == {"a": 2, "b": "y", "c": 0, "d": "Abnormal", "e": "Critical"}
