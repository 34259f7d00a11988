import pytest
from pyspark.sql import functions as F

from delaylens import bridge, clean, joins, lagjoin, rollup


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_cast_readings(spark):
    df = spark.createDataFrame([("7",), ("T",), ("0.05s",), ("",), (None,)], "r string")
    got = [r[0] for r in clean.cast_readings(df, {"r": "int"}).collect()]
    assert got == [7, None, None, None, None]


def test_fill_require_dedup(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 3.0), (2, float("nan"))], "a int, b double")
    assert rows(clean.fill(df, 0)) == [(1, 0.0), (1, 0.0), (2, 0.0), (2, 3.0)]
    assert clean.require(df, ["b"]).count() == 1
    assert clean.dedup(df).count() == 3
    with pytest.raises(ValueError):
        clean.dedup(df, ["a"])
    kept = clean.dedup(df.na.fill(9.0), ["a"], order_by=["b"])
    assert rows(kept) == [(1, 9.0), (2, 3.0)]


def test_rollup_functions_and_boundary(spark):
    df = spark.createDataFrame(
        [
            ("2021-12-31 23:29:00", "A", 10, 1.0, "x"),
            ("2021-12-31 23:30:00", "A", 20, 2.0, "z"),
            ("2021-12-31 23:45:00", "A", 21, None, "y"),
            ("2021-12-31 23:45:00", "B", None, 4.0, None),
        ],
        "s string, site string, t int, p double, sky string",
    ).withColumn("ts", F.col("s").cast("timestamp_ntz"))
    got = rollup.hourly_rollup(df, "ts", ["site"], {"t": "mean", "p": "max", "sky": "first"})
    assert got.columns == ["weather_ymdh", "site", "t", "p", "sky"]
    assert rows(got) == [
        ("2021123123", "A", 10.0, 1.0, "x"),
        ("2022010100", "A", 20.5, 2.0, "z"),
        ("2022010100", "B", None, 4.0, None),
    ]


def test_first_breaks_ties_by_value(spark):
    df = spark.createDataFrame([("2021-01-01", "b"), ("2021-01-01", "a")], "s string, v string")
    df = df.withColumn("ts", F.col("s").cast("timestamp_ntz")).withColumn("site", F.lit(1))
    got = rollup.hourly_rollup(df, "ts", ["site"], {"v": "first"}).first()
    assert got["v"] == "a"


def test_bridge(spark):
    stations = spark.createDataFrame(
        [("s1", "n1", "CA", "KAAA", 1.0, 2.0)] * 2 + [("s2", "n2", "CA", "KAAA", 1.0, 2.0), ("s3", "n3", "CA", "KZZZ", 1.0, 2.0)],
        "neighbor_id string, neighbor_name string, neighbor_state string, neighbor_call string, neighbor_lat double, neighbor_lon double",
    )
    airports = spark.createDataFrame([("KAAA", "AAA"), ("KBBB", "BBB")], "call string, iata string")
    sites = bridge.station_airport(stations, airports)
    assert sites.columns == [
        "station_id", "station_name", "station_state", "station_call", "station_lat", "station_lon", "airport_iata",
    ]
    assert [(r[0], r[-1]) for r in rows(sites)] == [("s1", "AAA"), ("s2", "AAA")]
    weather = spark.createDataFrame([("s1", 1), ("s3", 2), ("s2", 3)], "STATION string, v int")
    got = bridge.attach_airport(weather, sites.select("station_id", "airport_iata"))
    assert rows(got.select("station_id", "v", "airport_iata")) == [("s1", 1, "AAA"), ("s2", 3, "AAA")]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_join_equals_plain_join(spark, how):
    facts = spark.range(6000).select(
        "id",
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, None).otherwise(F.col("id") % 50).alias("k"),
    )
    dim = spark.range(40).select(F.col("id").cast("int").alias("k"), (F.col("id") * 10).alias("v"))
    hot = joins.hot_keys(facts, ["k"])
    assert len(hot) == 2 and all(0.3 < share < 0.4 for share in hot.values())
    salted = joins.skew_join(facts, dim, ["k"], how)
    assert rows(salted.na.fill(-1)) == rows(facts.join(dim, "k", how).na.fill(-1))
    assert salted.columns == facts.join(dim, "k", how).columns
    assert "_salt" in salted._jdf.queryExecution().optimizedPlan().toString()


def test_skew_join_spreads_the_hot_key(spark):
    facts = spark.range(8000).select("id", F.when(F.col("id") < 4000, 7).otherwise(F.col("id")).alias("k"))
    dim = spark.range(9000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    joined = joins.skew_join(facts, dim.hint("merge"), ["k"], partitions=16)
    assert joined.count() == 8000
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = joined.filter("k = 7").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) > 1


def test_lookup_without_broadcast(spark):
    facts = spark.range(100).select("id", (F.col("id") % 5).alias("k"))
    dim = spark.range(5).select(F.col("id").alias("k"), (F.col("id") + 1).alias("v"))
    assert not joins.fits(dim, 4) and joins.fits(dim, 5)
    assert rows(joins.lookup(facts, dim, ["k"], max_rows=4)) == rows(joins.lookup(facts, dim, ["k"]))


def test_lag_join(spark):
    flights = spark.createDataFrame(
        [(1, "A", "2021-01-01 01:15:00"), (2, "A", "2021-01-01 05:00:00"), (3, "B", None)], "id int, site string, s string"
    ).select("id", "site", F.col("s").cast("timestamp_ntz").alias("ts"))
    hourly = spark.createDataFrame([("2020123123", "A", 5.0), ("2021010103", "B", 6.0)], "weather_ymdh string, site string, t double")
    got = lagjoin.lag_hour_join(flights, hourly, "ts", ["site"])
    assert [(r["id"], r["target_dep_ymdh_n2"], r["t"]) for r in got.collect()] == [(1, "2020123123", 5.0)]
    assert lagjoin.lag_hour_join(flights, hourly, "ts", ["site"], how="left").count() == 3


def test_plans_stay_native(spark):
    hourly = rollup.hourly_rollup(
        spark.createDataFrame([("2021-01-01 00:00:00", 1, 2.0)], "s string, site int, v double").withColumn(
            "ts", F.col("s").cast("timestamp_ntz")
        ),
        "ts", ["site"], {"v": "mean"},
    )
    plan = hourly._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan
    assert "partial_avg" in plan


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("left, right", [("int", "int"), ("int", "bigint"), ("bigint", "double"), ("int", "double"), ("string", "string"), ("decimal(5,1)", "decimal(5,1)")])
def test_lookup_rows_do_not_depend_on_size(spark, left, right, how):
    facts = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (None,)], "k double").select(F.col("k").cast(left))
    dim = spark.createDataFrame([(1.5, "x"), (2.0, "y"), (None, "z")], "k double, v string")
    dim = dim.filter("k <> 1.5 or k is null" if right in ("int", "bigint") else "true").select(F.col("k").cast(right), "v")
    small = joins.lookup(facts, dim, ["k"], how)
    large = joins.lookup(facts, dim, ["k"], how, max_rows=0)
    assert small.dtypes == large.dtypes and dict(small.dtypes)["k"] == left
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))
    assert [r["v"] for r in small.filter("v is not null").collect()] == ["y", "y"]


def test_lookup_refuses_unlike_keys(spark):
    facts = spark.createDataFrame([("1",)], "k string")
    with pytest.raises(TypeError):
        joins.lookup(facts, spark.createDataFrame([(1,)], "k int"), ["k"])
