import datetime as dt

import pytest
from pyspark.sql import functions as F

from delaylens import features, schemas, timeutil


def rows(df):
    return [tuple(r) for r in df.collect()]


def ntz(text):
    return F.lit(text).cast("timestamp_ntz")


def test_clamp_and_hour(spark):
    df = spark.createDataFrame([(0,), (1,), (559,), (1200,), (2359,), (2400,), (None,)], "t int")
    got = rows(df.select(timeutil.clamp_hhmm("t"), timeutil.hhmm_hour(timeutil.clamp_hhmm("t"))))
    assert got == [(0, 0), (1, 0), (559, 5), (1200, 12), (2359, 23), (2359, 23), (None, None)]


@pytest.mark.parametrize(
    "local, zone, utc",
    [
        ("2021-07-01 12:00:00", "America/New_York", "2021-07-01 16:00:00"),
        ("2021-01-01 12:00:00", "America/New_York", "2021-01-01 17:00:00"),
        ("2021-03-14 02:30:00", "America/New_York", "2021-03-14 07:30:00"),
        ("2021-11-07 01:30:00", "America/New_York", "2021-11-07 06:30:00"),
        ("2021-11-07 00:59:00", "America/New_York", "2021-11-07 04:59:00"),
        ("2021-11-07 02:00:00", "America/New_York", "2021-11-07 07:00:00"),
        ("2021-12-31 23:45:00", "Asia/Kolkata", "2021-12-31 18:15:00"),
    ],
)
def test_local_to_utc(spark, any_zone, local, zone, utc):
    df = spark.range(1).select(timeutil.local_to_utc(ntz(local), F.lit(zone)).cast("string"))
    assert rows(df) == [(utc,)]


def test_ambiguous_earlier_and_missing_zone(spark):
    ts = ntz("2021-11-07 01:30:00")
    df = spark.range(1).select(
        timeutil.local_to_utc(ts, F.lit("America/New_York"), "earlier").cast("string"),
        timeutil.local_to_utc(ts, F.lit(None).cast("string")),
    )
    assert rows(df) == [("2021-11-07 05:30:00", None)]


def test_hhmm_to_utc(spark, any_zone):
    df = spark.createDataFrame(
        [("2021-12-31", 2400), ("2021-12-31 00:00:00", 0), ("2021-06-01", 1275), (None, 10), ("2021-06-01", None)],
        "d string, t int",
    )
    zone = F.lit("America/Chicago")
    got = rows(
        df.select(
            timeutil.hhmm_to_utc("d", "t", zone).cast("string"),
            timeutil.hhmm_to_utc("d", "t", zone, zero_is_null=True).cast("string"),
        )
    )
    assert got == [
        ("2022-01-01 05:59:00", "2022-01-01 05:59:00"),
        ("2021-12-31 06:00:00", None),
        (None, None),
        (None, None),
        (None, None),
    ]


def test_hour_keys(spark, any_zone):
    df = spark.createDataFrame(
        [("2021-12-31 23:29:59",), ("2021-12-31 23:30:00",), ("2021-03-14 02:30:00",), ("2021-01-01 01:15:00",)],
        "s string",
    )
    df = df.select(timeutil.parse_local("s").alias("ts"))
    got = rows(df.select(timeutil.hour_key_round("ts"), timeutil.hour_key_floor("ts")))
    assert got == [
        ("2021123123", "2021123121"),
        ("2022010100", "2021123121"),
        ("2021031403", "2021031400"),
        ("2021010101", "2020123123"),
    ]


def test_parse_local_is_lenient(spark):
    df = spark.createDataFrame([("2020-01-01T03:00:00",), ("noon",), (None,)], "s string")
    assert rows(df.select(timeutil.parse_local("s"))) == [(dt.datetime(2020, 1, 1, 3),), (None,), (None,)]


def test_attach_tz(spark):
    sites = spark.createDataFrame([("A",), ("X",)], "iata string")
    zones = spark.createDataFrame([("A", "UTC")], "iata string, tz string")
    assert rows(timeutil.attach_tz(sites, "iata", zones)) == [("A", "UTC")]
    assert sorted(rows(timeutil.attach_tz(sites, "iata", zones, "left"))) == [("A", "UTC"), ("X", None)]


def test_delay_label(spark):
    df = spark.createDataFrame(
        [(1, 14.0), (1, 15.0), (1, 16.0), (None, None), (None, 3.0), (1, None)], "actual int, delay double"
    )
    assert [r[-1] for r in rows(features.delay_label(df, "actual", "delay"))] == [0, 0, 1, 1, 1, 0]
    inclusive = features.delay_label(df, "actual", "delay", inclusive=True, cancelled_is_delay=False)
    assert [r[-1] for r in rows(inclusive)] == [0, 1, 1, 0, 0, 0]


def test_seasons_and_day_parts(spark):
    months = features.seasons(spark.range(1, 13).toDF("m"), "m")
    assert [[c for c in schemas.SEASONS if r[c]] for r in months.collect()] == (
        [["winter"]] * 2 + [["spring"]] * 3 + [["summer"]] * 3 + [["fall"]] * 3 + [["winter"]]
    )
    hours = spark.range(24).toDF("h")
    for r in features.day_parts(hours, "h").collect():
        assert sum(r[p] for p in schemas.DAY_PARTS) == 1
    compat = {r["h"]: r["night"] for r in features.day_parts(hours, "h", compat_night=True).collect()}
    assert [h for h, on in compat.items() if on] == [1, 2, 3, 4, 12, 22, 23]


def test_holidays(spark):
    days = spark.createDataFrame(
        [("2021-12-23",), ("2021-12-24",), ("2021-12-26",), ("2021-12-27",), ("2021-07-04",), (None,)], "d string"
    )
    holidays = spark.createDataFrame([("2021-12-24",), ("2021-12-25",), ("not a date",)], "date string")
    got = dict(rows(features.holiday_flag(days, "d", holidays)))
    assert got == {
        "2021-12-23": 1, "2021-12-24": 1, "2021-12-26": 1, "2021-12-27": 0, "2021-07-04": 0, None: 0,
    }
    assert features.holiday_flag(days, "d", holidays).count() == 6
    fixed = dict(rows(features.fixed_holiday(days, "d", schemas.FIXED_HOLIDAYS)))
    assert fixed["2021-07-04"] == 1 and fixed["2021-12-23"] == 0 and fixed[None] == 0


def test_keys_and_flags(spark):
    df = spark.createDataFrame([("2021-07-04", "N1", "ATL", 3), ("2021-01-31", None, None, 1)], "d string, t string, a string, q int")
    got = rows(features.tail_key(features.member_flag(df, "a", ["ATL"]), "d", "t").select("busy_airport", "tail_key"))
    assert got == [(1, "2021-07-04 N1"), (0, "2021-01-31")]
    assert rows(df.select(features.month_day("d"))) == [("7-4",), ("1-31",)]
    periods = features.period_keys(df, "d", "q").select("year", "year_order", "year_quarter")
    assert rows(periods) == [(2021, 6, 20213), (2021, 6, 20211)]


def test_zscore(spark):
    train = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, b double")
    test = spark.createDataFrame([(4.0, 7.0), (None, 1.0)], "a double, b double")
    a, b = features.zscore(train, [train, test], ["a", "b"])
    assert rows(a) == [(-1.0, 0.0), (0.0, 0.0), (1.0, 0.0)]
    assert rows(b) == [(2.0, 0.0), (None, 0.0)]


@pytest.mark.parametrize("name", [*schemas.KNOWN_ONLY_AFTERWARDS, "wheels_on_utc_timestamp", "dep_delay_scaled"])
def test_guard_names_each_leak(name):
    with pytest.raises(ValueError):
        features.guard(["month", name], schemas.KNOWN_ONLY_AFTERWARDS)


def test_guard_and_drop_correlated(spark):
    assert features.guard(["month"], ["weather_delay"]) == ["month"]
    with pytest.raises(ValueError, match="weather_delay"):
        features.guard(["month", "weather_delay_scaled"], ["weather_delay"])
    df = spark.createDataFrame([(float(i), 2.0 * i + 1, float(i * i % 7), 1.0) for i in range(20)], "a double, b double, c double, k double")
    assert features.drop_correlated(df, ["a", "b", "c", "k"], 0.95) == ["a", "c", "k"]


def test_pca_keeps_variance(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, float(i % 3)) for i in range(30)], "a double, b double, c double")
    scores, model = features.pca(df, ["a", "b", "c"], k=2)
    assert scores.count() == 30
    assert model.explainedVariance[0] > 0.95
