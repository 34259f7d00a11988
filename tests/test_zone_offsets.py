"""Offsets joined from a table against conversion row by row and by the standard library."""

import datetime
from zoneinfo import ZoneInfo

import pytest

from delaylens.functions import timeutil, zoneoffsets
from delaylens.plans import flights as flow
from pyspark.sql import functions as F

ZONES = [
    "America/New_York", "Europe/London", "Asia/Kathmandu", "Australia/Lord_Howe", "Africa/Casablanca", "Pacific/Apia",
    "America/Caracas", "America/St_Johns", "Asia/Pyongyang", "Antarctica/Troll", "Asia/Tokyo", "America/Phoenix",
]


def named(spark):
    return spark.createDataFrame([(z,) for z in [*ZONES, None, ZONES[0]]], "tz string")


def grid(spark, start, end, step):
    times = F.expr(f"sequence(timestamp_ntz'{start}', timestamp_ntz'{end}', interval {step})")
    return named(spark).distinct().withColumn("ts", F.explode(times))


@pytest.mark.parametrize("ambiguous", ["later", "earlier"])
def test_equals_conversion_by_row(spark, any_zone, ambiguous):
    known = zoneoffsets.zone_table(named(spark), 2007, 2019, ambiguous)
    df = known.attach(grid(spark, "2006-12-25 00:03:00", "2020-01-10 00:00:00", "47 minutes"), "tz", "ts")
    found = df.select(known.to_utc("ts", "tz").alias("a"), timeutil.local_to_utc("ts", "tz", ambiguous).alias("b"))
    assert found.filter(~F.col("a").eqNullSafe(F.col("b"))).count() == 0


def test_equals_the_standard_library(spark):
    known = zoneoffsets.zone_table(named(spark), 2014, 2015)
    df = known.attach(grid(spark, "2014-01-01 00:00:30", "2015-12-31 23:59:00", "191 minutes"), "tz", "ts")
    rows = df.filter("tz IS NOT NULL").select("tz", "ts", known.to_utc("ts", "tz").alias("utc")).collect()
    for tz, ts, utc in rows:
        # of two instants the later one, and behind a gap the old offset
        local = ts.replace(tzinfo=ZoneInfo(tz))
        later = max(local.replace(fold=f).utcoffset() for f in (0, 1)) if _skipped(local) else local.replace(fold=1).utcoffset()
        expected = ts - (local.replace(fold=0).utcoffset() if _skipped(local) else later)
        assert utc == expected, (tz, ts)


def _skipped(local):
    back = local.astimezone(datetime.UTC).astimezone(local.tzinfo)
    return back.replace(tzinfo=None) != local.replace(tzinfo=None, fold=0) and back.replace(tzinfo=None) != local.replace(tzinfo=None)


def test_changes_are_found_to_the_second(spark):
    zones = spark.createDataFrame([("America/New_York",), ("Africa/Monrovia",)], "tz string")
    found = zoneoffsets.changes(zones, 1971, 1973).filter("tz = 'Africa/Monrovia'").collect()
    assert [str(r["at"]) for r in found] == ["1972-01-07 00:44:30"]


def test_years_and_missing_parts(spark):
    dates = spark.createDataFrame([("2015-03-01",), ("x",), (None,), ("9999-01-01",), ("2017-01-01T05:00:00",)], "d string")
    assert zoneoffsets.years_of(dates, "d") == (2015, 2017)
    assert zoneoffsets.years_of(dates.limit(0), "d") == (1970, 1970)
    known = zoneoffsets.zone_table(named(spark), 2015, 2017)
    rows = [("2015-01-01", 5, "Asia/Tokyo"), ("2031-01-01", 5, "Asia/Tokyo"), ("x", 5, "Asia/Tokyo"), ("2015-01-01", 5, None), ("2015-01-01", None, "Asia/Tokyo"), ("2015-01-01", 5, "America/Denver")]
    df = known.attach(spark.createDataFrame(rows, "d string, t int, tz string"), "tz", "d")
    found = [str(r[0]) for r in df.select(known.hhmm_to_utc("d", "t", "tz")).collect()]
    assert found == ["2014-12-31 15:05:00", "2030-12-31 15:05:00", "None", "None", "None", "2015-01-01 07:05:00"]


def test_one_join_a_zone_and_no_conversion_of_known_years(spark):
    known = zoneoffsets.zone_table(named(spark), 2015, 2015)
    names = [t for t, _, _ in flow.FLIGHT_TIMES]
    schema = "fl_date string, " + ", ".join(f"{c} int" for c in names) + ", dep_delay double, tz string, dest_tz string"
    df = spark.createDataFrame([("2015-12-31", 2350, 2355, 5, 100, 130, 140, 5.0, "America/New_York", "Europe/London")], schema)
    joined = flow.flight_times(df, offsets=known)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 2
    assert joined.collect() == flow.flight_times(df).select(joined.columns).collect()
