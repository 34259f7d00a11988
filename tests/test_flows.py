"""The jobs end to end on literal tables, and the sources they use."""

import json
import datetime
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from delaylens import clean, io, schemas
from delaylens.plans import flights as flow
from jobs import curate, join, learn, profile

SITES = {"AAA": "America/New_York", "BBB": "America/Chicago", "CCC": "America/Los_Angeles", "DDD": "Asia/Kolkata"}

FLIGHT = {c: None for c in schemas.FLIGHT_NAMES}


def flight(**values):
    return {**FLIGHT, "CANCELLED": 0, "DIVERTED": 0, **values}


FLIGHT_TYPES = {
    **{c: "string" for c in schemas.FLIGHT_NAMES},
    **{c: "int" for c in ("QUARTER", "MONTH", "DAY_OF_WEEK", "CANCELLED", "DIVERTED", "CRS_DEP_TIME", "DEP_TIME",
                          "WHEELS_OFF", "WHEELS_ON", "CRS_ARR_TIME", "ARR_TIME")},
    **{c: "double" for c in schemas.FLIGHT_NAMES if c.endswith("_DELAY")},
}


def flights_frame(spark, rows):
    ddl = ", ".join(f"{c} {t}" for c, t in FLIGHT_TYPES.items())
    return spark.createDataFrame([tuple(r[c] for c in FLIGHT_TYPES) for r in rows], ddl)


def weather_frame(spark, rows):
    cols = ["STATION", *schemas.WEATHER_NAMES]
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], ", ".join(f"{c} string" for c in cols))


@pytest.fixture(scope="module")
def dims(spark):
    stations = spark.createDataFrame(
        [(f"s{k}", f"n{k}", "ST", f"K{k}", 1.0, 2.0) for k in [*SITES, "AAA", "ZZZ"]],
        ", ".join(f"{c} {'double' if c.endswith(('lat', 'lon')) else 'string'}" for c in schemas.STATION_NAMES),
    )
    airports = spark.createDataFrame([(f"K{k}", k) for k in [*SITES, "QQQ"]], "call string, iata string")
    zones = spark.createDataFrame(list(SITES.items()), "iata string, tz string")
    return stations, airports, zones


def test_curate_weather(spark, dims, any_zone):
    reading = {
        "STATION": "sAAA", "DATE": "2021-07-01T08:10:00", "HourlyDryBulbTemperature": "70", "HourlyPrecipitation": "T",
        "HourlyVisibility": "9.5", "HourlyWindSpeed": "8", "DailySnowfall": "1.5", "HourlySkyConditions": "CLR",
    }
    weather = weather_frame(
        spark,
        [
            reading,
            reading,
            {**reading, "DATE": "2021-07-01T07:31:00", "HourlyDryBulbTemperature": "60", "HourlySkyConditions": "OVC"},
            {**reading, "DATE": "2021-07-01T08:31:00", "HourlyDryBulbTemperature": "80"},
            {**reading, "STATION": "sZZZ"},
            {**reading, "DATE": "soon"},
        ],
    )
    got = flow.curate_weather(weather, *dims).orderBy("weather_ymdh").collect()
    assert [(r["weather_ymdh"], r["airport_iata"]) for r in got] == [("2021070112", "AAA"), ("2021070113", "AAA")]
    lean = flow.curate_weather(weather, *dims, carry=[])
    assert lean.columns == ["weather_ymdh", "airport_iata", *schemas.WEATHER_AGGREGATES]
    assert "SortAggregate" not in lean._jdf.queryExecution().executedPlan().toString()
    first = got[0]
    assert first["hourly_dry_bulb_temperature"] == 65.0
    assert first["hourly_sky_conditions"] == "OVC" and first["station_id"] == "sAAA"
    assert first["hourly_precipitation"] is None and first["hourly_wind_gust_speed"] == 0
    assert first["daily_snow_fall"] == 1.5 and first["daily_snow_depth"] == 0


def test_curate_flights(spark, dims, any_zone):
    base = flight(QUARTER=3, MONTH=7, DAY_OF_WEEK=4, FL_DATE="2021-07-01", OP_CARRIER="XX", TAIL_NUM="N1",
                  OP_CARRIER_FL_NUM="1", ORIGIN="AAA", DEST="DDD", CRS_DEP_TIME=2330, DEP_TIME=2400, DEP_DELAY=30.0,
                  WHEELS_OFF=10, WHEELS_ON=900, CRS_ARR_TIME=800, ARR_TIME=930)
    df = flights_frame(
        spark,
        [base, base, {**base, "OP_CARRIER_FL_NUM": "2", "ORIGIN": "???", "DEP_TIME": None, "DEP_DELAY": None},
         {**base, "CRS_DEP_TIME": None}],
    )
    zones = dims[2]
    got = {r["flight_num"]: r for r in flow.curate_flights(df, zones).withColumns(
        {c: F.col(c).cast("string") for _, c, _ in flow.FLIGHT_TIMES}).collect()}
    assert set(got) == {"1", "2"}
    one, two = got["1"], got["2"]
    assert one["target_dep_utc_timestamp"] == "2021-07-02 03:30:00"
    assert one["actual_dep_utc_timestamp"] == "2021-07-02 03:59:00"
    assert one["wheels_off_utc_timestamp"] == "2021-07-02 04:10:00"
    assert one["target_arr_utc_timestamp"] == "2021-07-03 02:30:00"
    assert one["wheels_on_utc_timestamp"] == "2021-07-03 03:30:00"
    assert one["actual_arr_utc_timestamp"] == "2021-07-03 04:00:00"
    assert one["delay_label"] == 1 and one["night"] == 1 and one["summer"] == 1 and one["year"] == 2021
    assert two["target_dep_utc_timestamp"] is None and two["delay_label"] == 1
    compat = {r["flight_num"]: r for r in flow.curate_flights(df, zones, compat=True).collect()}
    assert str(compat["1"]["wheels_on_utc_timestamp"]) == "2021-07-01 13:00:00"


@pytest.mark.parametrize(
    "target, actual, delay, day",
    [(5, 2358, -7.0, "2021-06-30"), (2358, 5, 7.0, "2021-07-02"), (5, 2358, None, "2021-06-30"),
     (1000, 1000, 1440.0, "2021-07-02"), (1000, 1130, 1530.0, "2021-07-02"), (1000, 955, -5.0, "2021-07-01")],
)
def test_departure_day_and_order(spark, target, actual, delay, day):
    off = (actual + 10) % 2400 if actual % 100 < 45 else actual % 2400 // 100 * 100
    row = [("2021-07-01", target, actual, off, off, target, actual, delay, "UTC", "UTC")]
    names = ["target_dep_time", "actual_dep_time", "wheels_off", "wheels_on", "target_arr_time", "actual_arr_time"]
    schema = "fl_date string, " + ", ".join(f"{c} int" for c in names) + ", dep_delay double, tz string, dest_tz string"
    got = flow.flight_times(spark.createDataFrame(row, schema).withColumn("fl_date", F.to_date("fl_date"))).first()
    times = [got[f"{c}_utc_timestamp"] for c in ("actual_dep", "wheels_off", "wheels_on", "actual_arr")]
    assert str(times[0])[:10] == day and times == sorted(times)
    assert all(b - a < datetime.timedelta(days=1) for a, b in zip(times, times[1:]))


def build_inputs(spark, base, dims):
    stations, airports, zones = dims
    rng = random.Random(4)
    rows, weather = [], []
    for year in range(2015, 2022):
        for i in range(120):
            month, day, hour = rng.randint(1, 12), rng.randint(1, 28), rng.randint(4, 22)
            origin, dest = rng.sample([s for s in SITES if s != "DDD"], 2)
            wind = rng.randint(0, 30)
            late = wind + rng.randint(-12, 12) > 17
            date = f"{year}-{month:02d}-{day:02d}"
            rows.append(flight(
                QUARTER=(month + 2) // 3, MONTH=month, DAY_OF_WEEK=1 + i % 7, FL_DATE=date, OP_CARRIER="XX",
                TAIL_NUM=f"N{i % 9}", OP_CARRIER_FL_NUM=str(i), ORIGIN=origin, DEST=dest, CRS_DEP_TIME=hour * 100 + 20,
                DEP_TIME=hour * 100 + 20, DEP_DELAY=40.0 if late else 2.0, CRS_ARR_TIME=2300, ARR_TIME=2310))
            weather.append({
                "STATION": f"s{origin}", "DATE": f"{date}T{hour - 2:02d}:05:00", "HourlyDryBulbTemperature": str(40 + i % 50),
                "HourlyPrecipitation": "0.1", "HourlyRelativeHumidity": "50", "HourlyVisibility": "10",
                "HourlyWindSpeed": str(wind)})
    flights_frame(spark, rows).write.parquet(f"{base}/flights")
    weather_frame(spark, weather).write.parquet(f"{base}/weather/part")
    stations.write.parquet(f"{base}/stations/part")
    blank = {f.name: F.lit(None).cast(f.dataType) for f in schemas.AIRPORTS.fields}
    full = airports.select(*[F.col(n) if n in ("call", "iata") else c.alias(n) for n, c in blank.items()])
    full.write.option("sep", ":").csv(f"{base}/airports.txt")
    zones.write.option("header", True).csv(f"{base}/zones.csv")
    days = [(f"{y}-{m}-{d}", "h", str(y)) for y in range(2014, 2022) for m, d in (("12", "24"), ("12", "25"), ("07", "04"))]
    spark.createDataFrame(days, "Date string, Holiday string, Year string").write.option("header", True).csv(f"{base}/holidays.csv")
    return len(rows)


def test_jobs_end_to_end(spark, dims, tmp_path, capsys, monkeypatch):
    base, out, models = (str(tmp_path / x) for x in ("raw", "staged", "models"))
    n = build_inputs(spark, base, dims)
    curate.main(["--base", base, "--out", out, "--airports", f"{base}/airports.txt", "--zones", f"{base}/zones.csv"])
    join.main(["--base", out, "--holidays", f"{base}/holidays.csv"])
    table = io.read_table(spark, out, "features")
    assert n - 5 <= table.count() <= n
    assert table.agg(F.sum("dep_rank")).first()[0] > 0
    assert {r[0] for r in table.select("is_holiday").distinct().collect()} == {0, 1}

    profile.main(["--base", base, "--out", f"{out}/raw"])
    assert io.read_table(spark, out, "raw/shape_flights").first()["rows"] == n
    assert io.read_table(spark, out, "raw/delay_by_weekday").count() == 7
    profile.main(["--base", out, "--out", f"{out}/eda", "--of", "features"])
    assert io.read_table(spark, out, "eda/correlation").count() == 18 * 18
    assert io.read_table(spark, out, "eda/most_delayed_airports").count() == 3

    full_plan = learn.plan
    monkeypatch.setattr(learn, "plan", lambda name: (lambda s, e, g, v: (s, e, g[:1] if name == "BoostedTrees" else g[:2], v))(*full_plan(name)))
    learn.main(["--base", out, "--out", models, "--model", "LogisticRegression", "--sample", "1.0"])
    got = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert got["model"] == "LogisticRegression" and 0.5 < got["auc"] <= 1.0 and got["recall"] == got["accuracy"]
    predictions = io.read_table(spark, models, "predictions_LogisticRegression")
    assert predictions.count() == table.filter("year = 2021").count()
    roc = io.read_table(spark, models, "roc_LogisticRegression")
    assert roc.agg(F.max("area")).first()[0] == pytest.approx(got["auc"])
    learn.main(["--base", out, "--out", models, "--model", "BoostedTrees", "--dataset", "scaled", "--sample", "0.8"])
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["rmse"] < 1
    assert len(full_plan("RandomForest")[2]) == 16 and len(full_plan("LogisticRegression")[2]) == 48


def test_readings_meet_stations_before_any_shuffle(spark, dims):
    weather = weather_frame(spark, [{"STATION": "sAAA", "DATE": "2021-07-01T08:10:00"}])
    plan = flow.curate_weather(weather, *dims, carry=[])._jdf.queryExecution().executedPlan().toString()
    # the tree is printed from the result down: duplicates and roll-up combine above the join with the sites
    trunk = plan[: plan.index("BroadcastHashJoin")]
    assert trunk.count("Exchange hashpartitioning") == 2 and "SortMergeJoin" not in plan


def test_ranks_ignore_the_held_out_year(spark):
    def scores(later):
        rows = [("AAA", "BBB", "2019-03-01", 2019), ("BBB", "CCC", "2020-03-01", 2020), ("CCC", "AAA", "2020-04-01", 2020),
                *[(a, b, "2021-03-01", 2021) for a, b in later]]
        df = spark.createDataFrame(rows, "airport_iata string, dest_iata string, fl_date string, year int")
        holidays = spark.createDataFrame([("2021-07-04",)], "Date string")
        found = flow.add_context(df.withColumn("holiday", F.lit(0)), holidays, last_year=2021)
        return {(r["airport_iata"], r["fl_date"]): r["dep_rank"] for r in found.collect() if r["year"] < 2021}

    assert scores([("AAA", "CCC")] * 9) == scores([("CCC", "BBB"), ("DDD", "AAA")])


def test_split_modes(spark):
    rows = [(f"{2015 + i % 7}-03-01", "XX", str(i), "N", "AAA", "BBB", 900, 1, int(i % 4 == 0)) for i in range(700)]
    df = spark.createDataFrame(
        rows, "fl_date string, airline string, flight_num string, tail_num string, airport_iata string, dest_iata string, "
        "target_dep_time int, quarter int, delay_label int")
    df = df.withColumns({c: F.col("flight_num").cast("double") for c in schemas.NUMERIC_FEATURES})
    train, test = flow.train_and_test(df, 2021)
    assert test.count() == 100
    mean, sd = train.agg(F.avg("dep_rank_scaled"), F.stddev_samp("dep_rank_scaled")).first()
    assert abs(mean) < 0.01 and abs(sd - 1) < 0.01
    _, balanced = flow.train_and_test(df, 2021, fit_on="all")
    assert balanced.count() < 80


def test_sources(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 2015), (2, "b", 2016)], "i int, s string, year int")
    path = str(tmp_path / "t")
    again = io.stage(df, path, ["year"])
    assert again.schema == df.select("i", "s", "year").schema
    plan = again.filter("year = 2016")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    io.stage(df.limit(1), path)
    assert io.read_table(spark, str(tmp_path), "t").count() == 1
    with pytest.raises(AnalysisException):
        io.save_split(df, path)
    io.stage(df, str(tmp_path / "many" / "x"))
    assert io.read_table(spark, str(tmp_path), "many/*").count() == 2
    assert io.read_table(spark, str(tmp_path), "t", "").columns == ["i", "s", "year"]
    (tmp_path / "a.txt").write_text("KAAA:AAA:Name:City:Land:1:2:3:N:4:5:6:W:7:1.5:-2.5\n")
    airport = io.read_delimited(spark, str(tmp_path / "a.txt"), schemas.AIRPORTS, sep=":").first()
    assert (airport["call"], airport["lat_dir"], airport["lon"]) == ("KAAA", "N", -2.5)
    (tmp_path / "h.csv").write_text("Date,Holiday,Year\n2021-12-25,Christmas,2021\n2014-12-25,Christmas,2014\n")
    days = io.read_delimited(spark, str(tmp_path / "h.csv"), header=True).filter("Year >= 2015")
    assert days.dtypes[2] == ("Year", "string") and days.count() == 1
    assert clean.project(clean.rename(days, {"Date": "date"}), ["date"]).columns == ["date"]
