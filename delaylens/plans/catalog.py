"""Every operator as a query over the supplied tables, with its SQL counterpart.

Each entry runs over whole tables. ``sql`` is plain SQL for an independent
engine; entries without it have no exact SQL form.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce
from operator import add, and_

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylens.functions import timeutil, zoneoffsets
from delaylens.operators import (
    bridge,
    certify,
    clean,
    evaluate,
    features,
    graph,
    lagjoin,
    models,
    oversample,
    profile,
    rollup,
    sampling,
    scaling,
    split,
    tuning,
)
from delaylens.plans import flights as flow
from delaylens.plans import standin
from delaylens.plans.standin import FIRST_YEAR, LAST_YEAR, ROW_KEYS, flights, readings, table
from delaylens.session import scratch_path
from delaylens.sources import io, schemas

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql.strip()
        return f

    return add


# ---------------------------------------------------------------- SQL fragments

_ZONES = "zones(site, tz) AS (VALUES " + ", ".join(f"({i}, '{z}')" for i, z in enumerate(standin.ZONES)) + ")"

_HOLIDAYS = (
    "holidays(date) AS (SELECT make_date(y, m, d) FROM range(1995, 2002) t(y), (VALUES "
    + ", ".join(f"({m}, {d})" for m, d in standin.HOLIDAYS)
    + ") h(m, d))"
)

_READINGS = """readings AS (
  SELECT event_id, ts, CAST(user_id % 25 AS INTEGER) AS station, event_type, value,
         json_extract_string(props, '$.k') AS k
  FROM events)"""

_FLIGHTS = """flights AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
         CAST(quarter(o_orderdate) AS INTEGER) AS quarter, CAST(month(o_orderdate) AS INTEGER) AS month,
         CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS day_of_week, strftime(o_orderdate, '%Y-%m-%d') AS fl_date,
         CAST(year(o_orderdate) AS INTEGER) AS year, l_suppkey AS airline, l_partkey AS tail_num,
         c_nationkey AS airport_iata, s_nationkey AS dest_iata,
         CASE WHEN l_partkey % 25 = 24 THEN 2400
              ELSE CAST(l_partkey % 25 AS INTEGER) * 100 + l_linenumber END AS target_dep_time,
         CASE WHEN o_orderstatus <> 'P' THEN CASE WHEN l_partkey % 25 = 24 THEN 2400
              ELSE CAST(l_partkey % 25 AS INTEGER) * 100 + l_linenumber END END AS actual_dep_time,
         CAST(date_diff('day', o_orderdate, l_shipdate) AS DOUBLE) AS dep_delay,
         CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS cancelled,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS diverted,
         l_quantity, l_extendedprice, l_discount, l_tax, o_totalprice,
         CASE WHEN o_orderstatus = 'P' OR date_diff('day', o_orderdate, l_shipdate) > 15
              THEN 1 ELSE 0 END AS delay_label
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey)"""

_ROLLUP = f"""{_READINGS}, hourly AS (
  SELECT strftime(ts + INTERVAL 30 MINUTE, '%Y%m%d%H') AS weather_ymdh, station,
         round(avg(value), 8) AS value, max(TRY_CAST(k AS INTEGER)) AS k,
         first(event_type ORDER BY ts, event_id) AS event_type
  FROM readings GROUP BY ALL)"""


def _hash_sql(keys: list[str], seed: int) -> str:
    text = f"concat_ws('|', '{seed}', {', '.join(keys)})"
    return f"(('0x' || substr(md5({text}), 1, 8))::BIGINT / 4294967296.0)"


def labelled(spark: SparkSession, base: str) -> DataFrame:
    return features.delay_label(flights(spark, base), "actual_dep_time", "dep_delay")


def dated(spark: SparkSession, base: str) -> DataFrame:
    return labelled(spark, base).withColumn("year", features.year_of("fl_date"))


# ---------------------------------------------------------------- roll-up and joins


def hourly(spark: SparkSession, base: str) -> DataFrame:
    typed = clean.cast_readings(readings(spark, base), {"k": "int"})
    rolled = rollup.hourly_rollup(
        typed, "ts", ["station"], {"value": "mean", "k": "max", "event_type": "first"}, order_by=["ts", "event_id"]
    )
    return rolled.withColumn("value", F.round("value", 8))


@query(f"WITH {_ROLLUP} SELECT * FROM hourly")
def station_hour_rollup(spark, base):
    return hourly(spark, base)


@query(f"""WITH {_ROLLUP}
SELECT r.event_id, r.station, strftime(r.ts - INTERVAL 2 HOUR, '%Y%m%d%H') AS target_dep_ymdh_n2,
       h.value AS site_value, h.k AS site_k, h.event_type AS site_event
FROM readings r JOIN hourly h
  ON h.station = r.station AND h.weather_ymdh = strftime(r.ts - INTERVAL 2 HOUR, '%Y%m%d%H')""")
def lag_hour_join(spark, base):
    facts = readings(spark, base).select("event_id", "ts", "station")
    site = hourly(spark, base).withColumnsRenamed({"value": "site_value", "k": "site_k", "event_type": "site_event"})
    return lagjoin.lag_hour_join(facts, site, "ts", ["station"]).drop("ts")


LAG_BUCKETS = 8


@query(ORACLES["lag_hour_join"])
def lag_hour_join_bucketed(spark, base):
    """The lag join of tables staged in buckets by station and hour: nothing moves in the join itself."""
    facts = lagjoin.lag_keyed(readings(spark, base).select("event_id", "ts", "station"), "ts").drop("ts")
    site = hourly(spark, base).withColumnsRenamed({"value": "site_value", "k": "site_k", "event_type": "site_event"})
    run = uuid.uuid4().hex

    def staged(df, name, hour):
        path = scratch_path(spark, name)
        return io.stage_bucketed(df, path, f"{name}_{run}", ["station", hour], LAG_BUCKETS)

    held = staged(facts, "bucketed_facts", "target_dep_ymdh_n2"), staged(site, "bucketed_hours", "weather_ymdh")
    return lagjoin.bucketed_lag_join(*held, ["station"])


def stations(spark: SparkSession, base: str) -> DataFrame:
    """One row per event, so that every station is listed many times."""
    user = F.col("user_id")
    return table(spark, base, "events").select(
        user.alias("neighbor_id"),
        F.concat(F.lit("STATION_"), user).alias("neighbor_name"),
        F.concat(F.lit("STATE_"), user % 5).alias("neighbor_state"),
        (user % 30).cast("string").alias("neighbor_call"),
        (user / 4.0).alias("neighbor_lat"),
        (user / 8.0 - 100).alias("neighbor_lon"),
    )


def airports(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "nation").select(
        F.col("n_nationkey").cast("string").alias("call"), F.col("n_name").alias("iata")
    )


_SITES = """sites AS (
  SELECT DISTINCT user_id AS station_id, 'STATION_' || user_id AS station_name,
         'STATE_' || (user_id % 5) AS station_state, CAST(user_id % 30 AS VARCHAR) AS station_call,
         CAST(user_id AS DOUBLE) / 4 AS station_lat, CAST(user_id AS DOUBLE) / 8 - 100 AS station_lon,
         n_name AS airport_iata
  FROM events JOIN nation ON n_nationkey = user_id % 30)"""


@query(f"WITH {_SITES} SELECT * FROM sites")
def bridge_station_airport(spark, base):
    return bridge.station_airport(stations(spark, base), airports(spark, base))


@query(f"""WITH {_SITES}
SELECT event_id, station_id, station_call, airport_iata FROM events JOIN sites ON user_id = station_id""")
def attach_airport(spark, base):
    sites = bridge.station_airport(stations(spark, base), airports(spark, base))
    weather = table(spark, base, "events").select("event_id", F.col("user_id").alias("STATION"))
    joined = bridge.attach_airport(weather, sites.select("station_id", "station_call", "airport_iata"))
    return joined.select("event_id", "station_id", "station_call", "airport_iata")


@query(f"""WITH {_ZONES}, {_SITES}, r AS (
  SELECT DISTINCT user_id, ts, event_type, value, json_extract_string(props, '$.k') AS k FROM events),
u AS (
  SELECT airport_iata, user_id, event_type, value, TRY_CAST(k AS INTEGER) AS k, (ts AT TIME ZONE tz) AT TIME ZONE 'UTC' AS utc
  FROM r JOIN sites ON user_id = station_id JOIN nation ON n_name = airport_iata JOIN zones ON site = n_nationkey)
SELECT strftime(utc + INTERVAL 30 MINUTE, '%Y%m%d%H') AS weather_ymdh, airport_iata,
       first(event_type ORDER BY utc, user_id, event_type) AS hourly_sky_conditions,
       round(avg(k), 8) AS hourly_dry_bulb_temperature, max(value) AS hourly_precipitation,
       round(avg(CASE WHEN event_type = 'view' THEN k END), 8) AS hourly_relative_humidity,
       max(value) AS hourly_visibility,
       max(CASE WHEN event_type = 'error' THEN 0 ELSE coalesce(k, 0) END) AS hourly_wind_gust_speed,
       max(k) AS hourly_wind_speed, 0.0::DOUBLE AS daily_precipitation, 0 AS daily_snow_depth,
       0.0::DOUBLE AS daily_snow_fall
FROM u WHERE utc IS NOT NULL GROUP BY 1, 2""")
def curate_weather(spark, base):
    """The whole weather flow over all events as raw readings."""
    k, kind = F.col("k"), F.col("event_type")
    given = {
        "STATION": F.col("user_id"),
        "DATE": F.col("ts").cast("string"),
        "HourlyDryBulbTemperature": k,
        "HourlyPrecipitation": F.col("value").cast("string"),
        "HourlyRelativeHumidity": F.when(kind == "view", k),
        "HourlySkyConditions": kind,
        "HourlyVisibility": F.col("value").cast("string"),
        "HourlyWindGustSpeed": F.when(kind != "error", k),
        "HourlyWindSpeed": k,
    }
    events = table(spark, base, "events").withColumn("k", F.get_json_object("props", "$.k"))
    none = F.lit(None).cast("string")
    weather = events.select(*[given.get(c, none).alias(c) for c in ("STATION", *schemas.WEATHER_NAMES)])
    names = table(spark, base, "nation").select(F.col("n_nationkey").alias("site"), F.col("n_name").alias("iata"))
    zones = standin.zones(spark, base).join(names, "site").select("iata", "tz")
    rolled = flow.curate_weather(
        weather, stations(spark, base), airports(spark, base), zones, carry=["hourly_sky_conditions"]
    )
    means = [c for c, f in schemas.WEATHER_AGGREGATES.items() if f == "mean"]
    return rolled.withColumns({c: F.round(c, 8) for c in means})


# ---------------------------------------------------------------- time


@query(f"""WITH {_ZONES}, {_READINGS}
SELECT event_id, tz, CAST((ts AT TIME ZONE tz) AT TIME ZONE 'UTC' AS VARCHAR) AS utc,
       strftime(((ts AT TIME ZONE tz) AT TIME ZONE 'UTC') + INTERVAL 30 MINUTE, '%Y%m%d%H') AS weather_ymdh
FROM readings JOIN zones ON station = site""")
def local_to_utc(spark, base):
    text = readings(spark, base).withColumn("ts", F.col("ts").cast("string"))
    sited = timeutil.attach_tz(text, "station", standin.zones(spark, base), "inner", zone_key="site")
    offsets = zoneoffsets.zone_table(standin.zones(spark, base), *zoneoffsets.years_of(text, "ts"))
    utc = offsets.to_utc(timeutil.parse_local("ts"), "tz")
    return offsets.attach(sited, "tz", "ts").select("event_id", "tz", utc.alias("utc")).select(
        "event_id", "tz", F.col("utc").cast("string").alias("utc"), timeutil.hour_key_round("utc").alias("weather_ymdh")
    )


def _utc_sql(hhmm: str, tz: str) -> str:
    t = f"CASE WHEN {hhmm} = 2400 THEN 2359 ELSE {hhmm} END"
    local = f"(CAST(fl_date AS TIMESTAMP) + to_hours(CAST(({t}) // 100 AS INTEGER)) + to_minutes(CAST(({t}) % 100 AS INTEGER)))"
    return f"CAST(({local} AT TIME ZONE {tz}) AT TIME ZONE 'UTC' AS VARCHAR)"


@query(f"""WITH {_ZONES}, {_FLIGHTS}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o.tz AS tz,
       {_utc_sql('target_dep_time', 'o.tz')} AS target_dep_utc, {_utc_sql('actual_dep_time', 'o.tz')} AS actual_dep_utc,
       {_utc_sql('target_dep_time', 'd.tz')} AS target_arr_utc
FROM flights LEFT JOIN zones o ON airport_iata = o.site LEFT JOIN zones d ON dest_iata = d.site""")
def hhmm_to_utc(spark, base):
    zones = standin.zones(spark, base)
    df = flights(spark, base)
    df = timeutil.attach_tz(df, "airport_iata", zones, "left", zone_key="site")
    df = timeutil.attach_tz(df, "dest_iata", zones, "left", zone_key="site", out="dest_tz")

    offsets = zoneoffsets.zone_table(zones, FIRST_YEAR, LAST_YEAR)
    df = offsets.attach(offsets.attach(df, "tz", "fl_date", "_origin"), "dest_tz", "fl_date", "_dest")

    def utc(hhmm, tz, name):
        side = "_origin" if tz == "tz" else "_dest"
        return offsets.hhmm_to_utc("fl_date", hhmm, tz, side).cast("string").alias(name)

    return df.select(
        *ROW_KEYS[:4],
        "tz",
        utc("target_dep_time", "tz", "target_dep_utc"),
        utc("actual_dep_time", "tz", "actual_dep_utc"),
        utc("target_dep_time", "dest_tz", "target_arr_utc"),
    )


# The other times of a stand-in flight, spread over the day so that many roll over.
_TIMES = {
    "actual_dep_time": "CASE WHEN actual_dep_time IS NOT NULL THEN (l_partkey + 5 * l_linenumber) % 24 * 100 + l_linenumber END",
    "wheels_off": "CASE WHEN l_linenumber <> 3 THEN (l_partkey + 5 * l_linenumber + 1) % 24 * 100 + 10 END",
    "wheels_on": "CASE WHEN l_linenumber <> 4 THEN (l_partkey + l_suppkey) % 24 * 100 + 15 END",
    "target_arr_time": "(l_partkey + l_suppkey + 1) % 24 * 100 + 30",
    "actual_arr_time": "CASE WHEN diverted = 0 THEN (l_partkey + l_suppkey + 2) % 25 * 100 END",
    "dep_delay": "CASE WHEN l_linenumber <> 5 THEN (dep_delay - 30) * 30 END",
}


def _after_sql(c: str, before: str) -> str:
    """``c`` on the first day on which it is not before ``before``."""
    return f"CASE WHEN {c} < {before} THEN {c} + to_days(CAST(ceil((epoch({before}) - epoch({c})) / 86400) AS INTEGER)) ELSE {c} END AS {c}"


@query(f"""WITH {_ZONES}, {_FLIGHTS}, given AS (
  SELECT flights.* EXCLUDE (actual_dep_time, dep_delay), {', '.join(f'{x} AS {c}' for c, x in _TIMES.items())},
         o.tz AS tz, d.tz AS dest_tz
  FROM flights LEFT JOIN zones o ON airport_iata = o.site LEFT JOIN zones d ON dest_iata = d.site),
utc AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, dep_delay,
         {', '.join(f"CAST({_utc_sql(t, 'dest_tz' if dest else 'tz')} AS TIMESTAMP) AS {u}" for t, u, dest in flow.FLIGHT_TIMES)}
  FROM given),
expected AS (
  SELECT *, target_dep_utc_timestamp + to_minutes(CAST(coalesce(dep_delay, 0) AS INTEGER)) + INTERVAL 12 HOUR AS latest FROM utc),
dep AS (
  SELECT * REPLACE (CASE WHEN latest IS NULL THEN actual_dep_utc_timestamp
                         ELSE actual_dep_utc_timestamp
                              + to_days(CAST(floor((epoch(latest) - epoch(actual_dep_utc_timestamp)) / 86400) AS INTEGER))
                    END AS actual_dep_utc_timestamp) FROM expected),
off AS (SELECT * REPLACE ({_after_sql('wheels_off_utc_timestamp', 'actual_dep_utc_timestamp')}) FROM dep),
landed AS (
  SELECT * REPLACE ({_after_sql('wheels_on_utc_timestamp', 'coalesce(wheels_off_utc_timestamp, actual_dep_utc_timestamp)')}) FROM off),
arrived AS (
  SELECT * REPLACE (
    {_after_sql('target_arr_utc_timestamp', 'target_dep_utc_timestamp')},
    {_after_sql('actual_arr_utc_timestamp', 'coalesce(wheels_on_utc_timestamp, wheels_off_utc_timestamp, actual_dep_utc_timestamp)')})
  FROM landed)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {', '.join(f'CAST({u} AS VARCHAR) AS {u}' for _, u, _ in flow.FLIGHT_TIMES)}
FROM arrived""")
def flight_times(spark, base):
    zones = standin.zones(spark, base)
    given = flights(spark, base)
    given = given.withColumns({c: F.expr(x) for c, x in _TIMES.items()})
    df = timeutil.attach_tz(given, "airport_iata", zones, "left", zone_key="site")
    df = timeutil.attach_tz(df, "dest_iata", zones, "left", zone_key="site", out="dest_tz")
    df = flow.flight_times(df, offsets=zoneoffsets.zone_table(zones, FIRST_YEAR, LAST_YEAR))
    return df.select(*ROW_KEYS[:4], *[F.col(u).cast("string").alias(u) for _, u, _ in flow.FLIGHT_TIMES])


@query(f"""WITH {_FLIGHTS}, c AS (
  SELECT CASE WHEN target_dep_time = 2400 THEN 2359 ELSE target_dep_time END AS hhmm FROM flights)
SELECT hhmm, CAST(hhmm // 100 AS INTEGER) AS hour, count(*) AS n FROM c GROUP BY ALL""")
def clamp_hhmm(spark, base):
    df = flights(spark, base).select(timeutil.clamp_hhmm("target_dep_time").alias("hhmm"))
    return df.groupBy("hhmm", timeutil.hhmm_hour("hhmm").alias("hour")).agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- labels and calendar


@query(f"""WITH {_FLIGHTS}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, delay_label,
       CASE WHEN dep_delay > 15 THEN 1 ELSE 0 END AS late, CASE WHEN dep_delay >= 15 THEN 1 ELSE 0 END AS late_inclusive
FROM flights""")
def delay_label(spark, base):
    df = labelled(spark, base)
    df = features.delay_label(df, "actual_dep_time", "dep_delay", cancelled_is_delay=False, out="late")
    df = features.delay_label(
        df, "actual_dep_time", "dep_delay", inclusive=True, cancelled_is_delay=False, out="late_inclusive"
    )
    return df.select(*ROW_KEYS[:4], "delay_label", "late", "late_inclusive")


def _in_sql(c: str, values: list[int], name: str) -> str:
    return f"CASE WHEN {c} IN ({', '.join(map(str, values))}) THEN 1 ELSE 0 END AS {name}"


@query(f"""WITH {_FLIGHTS}
SELECT month, {', '.join(_in_sql('month', m, s) for s, m in features.SEASON_MONTHS.items())}, count(*) AS n
FROM flights GROUP BY ALL""")
def seasons(spark, base):
    df = features.seasons(flights(spark, base), "month")
    return df.groupBy("month", *schemas.SEASONS).agg(F.count("*").alias("n"))


_HOUR = "CAST((CASE WHEN target_dep_time = 2400 THEN 2359 ELSE target_dep_time END) // 100 AS INTEGER)"


@query(f"""WITH {_FLIGHTS}, h AS (SELECT {_HOUR} AS hour FROM flights)
SELECT hour, {', '.join(_in_sql('hour', v, p) for p, v in features.DAY_PART_HOURS.items())},
       {_in_sql('hour', features.COMPAT_NIGHT_HOURS, 'compat_night')}, count(*) AS n
FROM h GROUP BY ALL""")
def day_parts(spark, base):
    hour = timeutil.hhmm_hour(timeutil.clamp_hhmm("target_dep_time")).alias("hour")
    df = flights(spark, base).select(hour)
    compat = features.day_parts(df, "hour", compat_night=True).select("hour", F.col("night").alias("compat_night"))
    both = features.day_parts(compat, "hour")
    return both.groupBy("hour", *schemas.DAY_PARTS, "compat_night").agg(F.count("*").alias("n"))


@query(f"""WITH {_FLIGHTS}
SELECT airport_iata, CASE WHEN airport_iata IN (3, 7) THEN 1 ELSE 0 END AS busy_airport, count(*) AS n
FROM flights GROUP BY ALL""")
def member_flag(spark, base):
    df = features.member_flag(flights(spark, base), "airport_iata", [3, 7])
    return df.groupBy("airport_iata", "busy_airport").agg(F.count("*").alias("n"))


@query(f"""WITH {_FLIGHTS}
SELECT fl_date, month(CAST(fl_date AS DATE)) || '-' || day(CAST(fl_date AS DATE)) AS month_day, count(*) AS n
FROM flights GROUP BY ALL""")
def month_day(spark, base):
    df = flights(spark, base).select("fl_date", features.month_day("fl_date").alias("month_day"))
    return df.groupBy("fl_date", "month_day").agg(F.count("*").alias("n"))


@query(f"""WITH {_FLIGHTS}
SELECT concat_ws(' ', fl_date, CASE WHEN cancelled = 0 THEN tail_num END) AS tail_key, count(*) AS n
FROM flights GROUP BY ALL""")
def tail_key(spark, base):
    df = flights(spark, base).withColumn("tail", F.when(F.col("cancelled") == 0, F.col("tail_num")))
    return features.tail_key(df, "fl_date", "tail").groupBy("tail_key").agg(F.count("*").alias("n"))


@query(f"""WITH {_FLIGHTS}
SELECT fl_date, year, year - 1995 AS year_order, year * 10 + quarter AS year_quarter, count(*) AS n
FROM flights GROUP BY ALL""")
def period_keys(spark, base):
    df = features.period_keys(flights(spark, base), "fl_date", "quarter", base_year=FIRST_YEAR)
    return df.groupBy("fl_date", "year", "year_order", "year_quarter").agg(F.count("*").alias("n"))


@query(f"""WITH {_FLIGHTS}
SELECT fl_date, CASE WHEN month(CAST(fl_date AS DATE)) || '-' || day(CAST(fl_date AS DATE))
       IN ({', '.join(repr(d) for d in schemas.FIXED_HOLIDAYS)}) THEN 1 ELSE 0 END AS holiday, count(*) AS n
FROM flights GROUP BY ALL""")
def fixed_holiday(spark, base):
    df = features.fixed_holiday(flights(spark, base), "fl_date", schemas.FIXED_HOLIDAYS)
    return df.groupBy("fl_date", "holiday").agg(F.count("*").alias("n"))


@query(f"""WITH {_HOLIDAYS}, {_FLIGHTS}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, fl_date,
       CASE WHEN EXISTS (SELECT 1 FROM holidays WHERE abs(date_diff('day', date, CAST(fl_date AS DATE))) <= 1)
            THEN 1 ELSE 0 END AS is_holiday
FROM flights""")
def holiday_flag(spark, base):
    df = features.holiday_flag(flights(spark, base), "fl_date", standin.holidays(spark))
    return df.select(*ROW_KEYS[:4], "fl_date", "is_holiday")


@query(f"""WITH {_HOLIDAYS}
SELECT DISTINCT CAST(date + CAST(p AS INTEGER) AS VARCHAR) AS date, count(o_orderkey) AS orders
FROM holidays CROSS JOIN range(-1, 2) t(p) LEFT JOIN orders ON CAST(o_orderdate AS DATE) = date + CAST(p AS INTEGER)
GROUP BY date, p""")
def holiday_orders(spark, base):
    days = features.pad_holidays(standin.holidays(spark))
    orders = table(spark, base, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("date"))
    counted = orders.groupBy("date").agg(F.count("o_orderkey").alias("orders"))
    joined = days.join(counted, "date", "left")
    return joined.select(F.col("date").cast("string").alias("date"), F.coalesce("orders", F.lit(0)).alias("orders"))


# ---------------------------------------------------------------- cleaning


@query(f"WITH {_READINGS} SELECT DISTINCT station, event_type, k FROM readings")
def clean_dedup(spark, base):
    return clean.dedup(clean.project(readings(spark, base), ["station", "event_type", "k"]))


@query(f"""WITH {_READINGS}
SELECT station, first(event_id ORDER BY value DESC, event_id) AS event_id, max(value) AS value
FROM readings GROUP BY station""")
def clean_dedup_keys(spark, base):
    df = readings(spark, base).select("station", "event_id", "value", (-F.col("value")).alias("down"))
    return clean.dedup(df, ["station"], order_by=["down", "event_id"]).drop("down")


@query(f"""WITH {_FLIGHTS}
SELECT cancelled, count(*) AS n, CAST(sum(coalesce(actual_dep_time, 0)) AS BIGINT) AS total
FROM flights GROUP BY cancelled""")
def clean_fill(spark, base):
    df = clean.fill(flights(spark, base), 0, ["actual_dep_time"])
    return df.groupBy("cancelled").agg(F.count("*").alias("n"), F.sum("actual_dep_time").alias("total"))


@query(f"WITH {_FLIGHTS} SELECT cancelled, count(*) AS n FROM flights WHERE actual_dep_time IS NOT NULL GROUP BY cancelled")
def clean_require(spark, base):
    df = clean.require(flights(spark, base), ["actual_dep_time", "fl_date"])
    return df.groupBy("cancelled").agg(F.count("*").alias("n"))


@query("""SELECT event_id, coalesce(TRY_CAST(CASE WHEN event_type = 'error' THEN 'T' WHEN event_type = 'view' THEN ''
       ELSE json_extract_string(props, '$.k') END AS INTEGER), -1) AS reading FROM events""")
def cast_readings(spark, base):
    text = F.when(F.col("event_type") == "error", "T").when(F.col("event_type") == "view", "").otherwise(F.col("k"))
    df = readings(spark, base).select("event_id", text.alias("reading"))
    return clean.fill(clean.cast_readings(df, {"reading": "int"}), -1)


@query("SELECT c_custkey AS site_id, c_name AS site_name, c_nationkey AS airport FROM customer")
def project_rename(spark, base):
    df = clean.project(table(spark, base, "customer"), ["c_custkey", "c_name", "c_nationkey"])
    return clean.rename(df, {"c_custkey": "site_id", "c_name": "site_name", "c_nationkey": "airport"})


# ---------------------------------------------------------------- sources and sinks


@query("SELECT CAST(c_custkey AS VARCHAR) AS call, c_name AS iata, c_nationkey AS alt, c_acctbal AS lat FROM customer")
def delimited_schema(spark, base):
    path = scratch_path(spark, "customer-text")
    table(spark, base, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal").write.option("sep", ":").csv(path)
    return io.read_delimited(spark, path, "call string, iata string, alt int, lat double", sep=":")


@query("SELECT strftime(o_orderdate, '%Y-%m-%d') AS Date, CAST(count(*) AS VARCHAR) AS Year FROM orders GROUP BY 1")
def delimited_header(spark, base):
    path = scratch_path(spark, "orders-per-day")
    day = F.substring(F.col("o_orderdate").cast("string"), 1, 10).alias("Date")
    counts = table(spark, base, "orders").groupBy(day).agg(F.count("*").alias("Year"))
    counts.write.option("header", True).csv(path)
    return io.read_delimited(spark, path, header=True)


@query(f"""WITH {_FLIGHTS} SELECT year, delay_label, count(*) AS n FROM flights GROUP BY ALL""")
def stage_by_year(spark, base):
    staged = io.stage(
        dated(spark, base).select("year", "delay_label", *ROW_KEYS[:4]), scratch_path(spark, "flights"), ["year"]
    )
    return staged.groupBy("year", "delay_label").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def save_split(spark, base):
    df = table(spark, base, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return io.save_split(df, scratch_path(spark, "orders"))


# ---------------------------------------------------------------- profiles


@query(f"WITH {_FLIGHTS} SELECT count(*) AS rows, CAST(23 AS BIGINT) AS columns FROM flights")
def profile_shape(spark, base):
    return profile.shape(flights(spark, base))


_MEASURES = ["dep_delay", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "o_totalprice"]


def _describe_sql(cols: list[str]) -> str:
    return f"WITH {_FLIGHTS} " + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 8) AS mean,
       round(stddev_samp({c}), 8) AS stddev, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM flights"""
        for c in cols
    )


@query(_describe_sql([*_MEASURES, "actual_dep_time"]))
def profile_describe(spark, base):
    df = profile.describe(flights(spark, base), [*_MEASURES, "actual_dep_time"])
    return df.withColumns({"mean": F.round("mean", 8), "stddev": F.round("stddev", 8)})


_CHECKED = ["fl_date", "target_dep_time", "actual_dep_time", "dep_delay", "tail_num"]


@query(f"WITH {_FLIGHTS} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) - count({c}) AS missing FROM flights""" for c in _CHECKED))
def profile_missing(spark, base):
    return profile.missing(flights(spark, base).select(*_CHECKED, "l_tax"), exclude=("l_tax",))


@query(f"WITH {_FLIGHTS} SELECT count(*) - count(actual_dep_time) AS nulls FROM flights")
def profile_null_count(spark, base):
    return profile.null_count(flights(spark, base), "actual_dep_time")


@query(f"WITH {_FLIGHTS} " + " UNION ALL ".join(
    f"SELECT '{c}' AS flag, round(avg({c}) * 100, 8) AS percent FROM flights" for c in ("cancelled", "diverted")))
def profile_flag_rate(spark, base):
    return profile.flag_rate(flights(spark, base), ["cancelled", "diverted"]).withColumn("percent", F.round("percent", 8))


@query("SELECT count(DISTINCT user_id) AS ndv FROM events")
def profile_ndv(spark, base):
    return profile.ndv(table(spark, base, "events"), "user_id")


@query(f"""WITH {_FLIGHTS} SELECT airport_iata, count(DISTINCT tail_num) AS tails, true AS near FROM flights GROUP BY ALL""")
def ndv_sketches(spark, base):
    """Exact counts, and whether the merged sketches of all years come within 5 % of them."""
    yearly = profile.distinct_sketches(dated(spark, base), ["year", "airport_iata"], "tail_num")
    sketches = io.stage(yearly, scratch_path(spark, "sketches"), ["year"])
    estimates = profile.merged_ndv(sketches, ["airport_iata"])
    exact = flights(spark, base).groupBy("airport_iata").agg(F.count_distinct("tail_num").alias("tails"))
    near = F.abs(F.col("ndv") - F.col("tails")) <= 0.05 * F.col("tails")
    return exact.join(estimates, "airport_iata").select("airport_iata", "tails", near.alias("near"))


@query(f"""WITH {_FLIGHTS}, b AS (SELECT {', '.join(f'min({c}) AS lo_{c}, max({c}) AS hi_{c}' for c in ("l_quantity", "l_tax"))} FROM flights),
s AS ({' UNION ALL '.join(f"SELECT '{c}' AS name, least(floor(({c} - lo_{c}) / ((hi_{c} - lo_{c}) / 7)), 6)::BIGINT AS bin FROM flights, b" for c in ("l_quantity", "l_tax"))})
SELECT name, bin, count(*) AS n FROM s GROUP BY ALL""")
def histograms_one_scan(spark, base):
    """Several histograms of flights from one scan, their ranges from another."""
    cols = ["l_quantity", "l_tax"]
    rows = flights(spark, base).select(*cols)
    summary = profile.Summary(rows, cols)
    found = profile.histograms(rows, {c: (c, 7, *summary.range(c)) for c in cols})
    named = [t.select(F.lit(c).alias("name"), "bin", "n") for c, t in found.items()]
    return named[0].unionByName(named[1]).filter("n > 0")


@query(f"WITH {_FLIGHTS} SELECT delay_label, count(*) AS n FROM flights GROUP BY ALL")
def profile_value_counts(spark, base):
    return profile.value_counts(labelled(spark, base), "delay_label")


@query(f"WITH {_FLIGHTS} SELECT year, month, round(avg(dep_delay), 8) AS mean FROM flights GROUP BY ALL")
def profile_mean_by_month(spark, base):
    return profile.mean_by(dated(spark, base), ["year", "month"], "dep_delay").withColumn("mean", F.round("mean", 8))


@query(f"WITH {_FLIGHTS} SELECT fl_date, round(avg(dep_delay), 8) AS mean FROM flights GROUP BY ALL")
def profile_mean_by_date(spark, base):
    return profile.mean_by(flights(spark, base), ["fl_date"], "dep_delay").withColumn("mean", F.round("mean", 8))


@query(f"WITH {_FLIGHTS} SELECT day_of_week, round(avg(delay_label), 8) AS mean FROM flights GROUP BY ALL")
def profile_mean_by_weekday(spark, base):
    return profile.mean_by(labelled(spark, base), ["day_of_week"], "delay_label").withColumn("mean", F.round("mean", 8))


def _histogram_sql(c: str, bins: int, lo: str, hi: str) -> str:
    return f"""WITH {_FLIGHTS}, r AS (SELECT CAST({lo} AS DOUBLE) AS lo, CAST({hi} AS DOUBLE) AS hi FROM flights),
w AS (SELECT lo, hi, (hi - lo) / {bins} AS width FROM r),
c AS (SELECT least(CAST(floor(({c} - lo) / width) AS BIGINT), {bins - 1}) AS bin, count(*) AS n
      FROM flights, w WHERE {c} BETWEEN lo AND hi GROUP BY ALL)
SELECT b AS bin, round(b * width + lo, 6) AS left_edge, round((b + 1) * width + lo, 6) AS right_edge,
       coalesce(n, 0) AS n
FROM range({bins}) t(b) CROSS JOIN w LEFT JOIN c ON c.bin = b"""


def _edges_rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({"left_edge": F.round("left_edge", 6), "right_edge": F.round("right_edge", 6)})


@query(_histogram_sql("dep_delay", 50, "min(dep_delay)", "max(dep_delay)"))
def histogram(spark, base):
    return _edges_rounded(profile.histogram(flights(spark, base), "dep_delay", 50))


@query(_histogram_sql("dep_delay", 10, "any_value(0)", "any_value(400)"))
def histogram_clipped(spark, base):
    return _edges_rounded(profile.histogram(flights(spark, base), "dep_delay", 10, 0, 400))


@query(_histogram_sql("delay_label", 2, "min(delay_label)", "max(delay_label)"))
def label_histogram(spark, base):
    return _edges_rounded(profile.histogram(labelled(spark, base), "delay_label", 2))


def _box_sql(c: str, by: str | None) -> str:
    key = f"{by}, " if by else ""
    join = f"f.{by} = q.{by}" if by else "true"
    return f"""WITH {_FLIGHTS}, q AS (
  SELECT {key}count({c}) AS n, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median,
         quantile_cont({c}, 0.75) AS q3 FROM flights {f'GROUP BY {by}' if by else ''})
SELECT {f'f.{by}, ' if by else ''}any_value(n) AS n, any_value(round(q1, 6)) AS q1, any_value(round(median, 6)) AS median,
       any_value(round(q3, 6)) AS q3, min({c}) AS min, max({c}) AS max,
       min(CASE WHEN {c} >= q1 - 1.5 * (q3 - q1) THEN {c} END) AS whisker_low,
       max(CASE WHEN {c} <= q3 + 1.5 * (q3 - q1) THEN {c} END) AS whisker_high,
       count(CASE WHEN {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1) THEN 1 END) AS outliers
FROM flights f JOIN q ON {join} {f'GROUP BY f.{by}' if by else ''}"""


def _quartiles_rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3")})


@query(_box_sql("dep_delay", None))
def box_stats(spark, base):
    return _quartiles_rounded(profile.box_stats(flights(spark, base), "dep_delay"))


@query(_box_sql("l_extendedprice", "delay_label"))
def box_stats_by_label(spark, base):
    return _quartiles_rounded(profile.box_stats(labelled(spark, base), "l_extendedprice", "delay_label"))


@query(f"""WITH {_FLIGHTS}, h AS (SELECT delay_label, {_HOUR} AS hour FROM flights)
""" + " UNION ALL ".join(
    f"SELECT delay_label, '{p}' AS flag, count(*) AS n FROM h WHERE hour IN ({', '.join(map(str, v))}) GROUP BY delay_label"
    for p, v in features.DAY_PART_HOURS.items()))
def label_by_flag(spark, base):
    hour = timeutil.hhmm_hour(timeutil.clamp_hhmm("target_dep_time"))
    df = features.day_parts(labelled(spark, base).withColumn("hour", hour), "hour")
    return profile.label_by_flag(df, schemas.DAY_PARTS, "delay_label")


@query(f"WITH {_FLIGHTS} " + " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM flights"
    for a in [*_MEASURES, "delay_label"] for b in [*_MEASURES, "delay_label"]))
def correlation_long(spark, base):
    return profile.correlation(labelled(spark, base), [*_MEASURES, "delay_label"]).withColumn("corr", F.round("corr", 6))


@query(_describe_sql(_MEASURES))
def drop_correlated(spark, base):
    df = flights(spark, base).withColumn("price_again", F.col("l_extendedprice") * 2 + 1)
    # read twice, so the joins run once
    df = io.stage(df.select(*_MEASURES, "price_again"), scratch_path(spark, "measures"))
    kept = features.drop_correlated(df, [*_MEASURES, "price_again"])
    return profile.describe(df, kept).withColumns({"mean": F.round("mean", 8), "stddev": F.round("stddev", 8)})


# ---------------------------------------------------------------- graph

_ROUTES = "SELECT airport_iata AS src, dest_iata AS dst, count(*) AS w FROM flights GROUP BY ALL"

_SALES = """SELECT 'C' || o_custkey AS src, 'S' || l_suppkey AS dst, count(*) AS w
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL"""


def _page_rank_ctes(edges: str, alpha: float = 0.15, spread: bool = True, rounds: int = 15) -> str:
    """The rounds written out as common table expressions ``s0 .. s15``."""
    start = (
        "SELECT node, 1.0::DOUBLE / (SELECT count(*) FROM nodes) AS score FROM nodes"
        if spread
        else """SELECT node, CASE WHEN node IN (SELECT src FROM edges)
                THEN 1.0::DOUBLE / (SELECT count(DISTINCT src) FROM edges) ELSE 0.0::DOUBLE END AS score FROM nodes"""
    )
    ctes = [
        f"edges AS MATERIALIZED ({edges})",
        "links AS MATERIALIZED (SELECT src, dst, w::DOUBLE / sum(w) OVER (PARTITION BY src) AS share FROM edges)",
        "nodes AS MATERIALIZED (SELECT src AS node FROM edges UNION SELECT dst FROM edges)",
        f"s0 AS MATERIALIZED ({start})",
    ]
    for i in range(1, rounds + 1):
        lost = (
            f"(SELECT coalesce(sum(score), 0) FROM s{i - 1} WHERE node NOT IN (SELECT src FROM edges))" if spread else "0"
        )
        ctes.append(f"""s{i} AS MATERIALIZED (
  SELECT node, {alpha}::DOUBLE / (SELECT count(*) FROM nodes)
         + {1 - alpha}::DOUBLE * (coalesce(inflow, 0) + {lost} / (SELECT count(*) FROM nodes)) AS score
  FROM nodes LEFT JOIN (SELECT dst, sum(share * score) AS inflow FROM links JOIN s{i - 1} ON src = node GROUP BY dst)
       ON dst = node)""")
    return ", ".join(ctes)


_RANKED = f"{_FLIGHTS}, {_page_rank_ctes(_ROUTES)}"


def routes(spark: SparkSession, base: str) -> DataFrame:
    return graph.edge_weights(flights(spark, base), "airport_iata", "dest_iata")


def sales(spark: SparkSession, base: str) -> DataFrame:
    """Customers to suppliers: no supplier sends anything on."""
    orders = table(spark, base, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    lines = table(spark, base, "lineitem").select("l_orderkey", "l_suppkey").join(orders, "l_orderkey")
    counted = graph.edge_weights(lines, "o_custkey", "l_suppkey")
    return counted.select(
        F.concat(F.lit("C"), "src").alias("src"), F.concat(F.lit("S"), "dst").alias("dst"), "w"
    )


@query(f"WITH {_FLIGHTS} {_ROUTES}")
def edge_weights(spark, base):
    return routes(spark, base)


@query(f"WITH {_RANKED} SELECT node AS dep_iata, round(score, 8) AS dep_rank FROM s15")
def page_rank(spark, base):
    return graph.page_rank(routes(spark, base)).withColumn("dep_rank", F.round("dep_rank", 8))


@query(f"WITH {_page_rank_ctes(_SALES)} SELECT node AS dep_iata, round(score, 8) AS dep_rank FROM s15")
def page_rank_dangling(spark, base):
    return graph.page_rank(sales(spark, base)).withColumn("dep_rank", F.round("dep_rank", 8))


@query(f"WITH {_FLIGHTS}, {_page_rank_ctes(_ROUTES, 0.0, False)} SELECT node AS dep_iata, round(score, 8) AS dep_rank FROM s15")
def page_rank_compat(spark, base):
    ranks = graph.page_rank(routes(spark, base), alpha=0.0, dangling="drop")
    return ranks.withColumn("dep_rank", F.round("dep_rank", 8))


def ranks(spark: SparkSession, base: str) -> DataFrame:
    return graph.page_rank(routes(spark, base)).withColumn("dep_rank", F.round("dep_rank", 8))


_KNOWN_ROUTES = f"SELECT airport_iata AS src, dest_iata AS dst, count(dest_iata) AS w FROM flights WHERE year < {LAST_YEAR} GROUP BY ALL"


@query(f"""WITH {_HOLIDAYS}, {_FLIGHTS}, {_page_rank_ctes(_KNOWN_ROUTES)}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, airport_iata, round(score, 8) AS dep_rank,
       CASE WHEN EXISTS (SELECT 1 FROM holidays WHERE abs(date_diff('day', date, CAST(fl_date AS DATE))) <= 1)
            THEN 1 ELSE 0 END AS is_holiday
FROM flights LEFT JOIN s15 ON node = airport_iata""")
def add_context(spark, base):
    """The whole context flow: scores from the routes of the training years, and the padded holidays."""
    days = standin.holidays(spark).withColumnRenamed("date", "Date")
    df = flow.add_context(dated(spark, base).withColumn("holiday", F.lit(0)), days, last_year=LAST_YEAR)
    return df.select(*ROW_KEYS[:4], "airport_iata", F.round("dep_rank", 8).alias("dep_rank"), "is_holiday")


@query(f"""WITH {_RANKED}
SELECT node AS dep_iata, round(score, 8) AS dep_rank FROM s15 ORDER BY dep_rank DESC, dep_iata LIMIT 10""")
def top_airports(spark, base):
    return profile.top_k(ranks(spark, base), [F.col("dep_rank").desc(), F.col("dep_iata")], 10)


@query(f"""WITH {_RANKED}, d AS (
  SELECT airport_iata, round(score, 8) AS dep_rank, CAST(sum(delay_label) AS BIGINT) AS delays
  FROM flights LEFT JOIN s15 ON node = airport_iata GROUP BY ALL)
SELECT airport_iata, dep_rank, delays, row_number() OVER (ORDER BY dep_rank DESC, airport_iata) AS rank FROM d""")
def delays_by_airport(spark, base):
    ranked = features.add_rank(labelled(spark, base), ranks(spark, base))
    return profile.delays_by_airport(ranked)


@query(f"""WITH {_RANKED}, d AS (
  SELECT airport_iata, round(score, 8) AS dep_rank, CAST(sum(delay_label) AS BIGINT) AS delays
  FROM flights LEFT JOIN s15 ON node = airport_iata GROUP BY ALL),
r AS (SELECT airport_iata, dep_rank, delays, row_number() OVER (ORDER BY dep_rank DESC, airport_iata) AS rank FROM d)
SELECT * FROM r ORDER BY delays DESC, airport_iata LIMIT 10""")
def most_delayed_airports(spark, base):
    return profile.top_k(delays_by_airport(spark, base), [F.col("delays").desc(), F.col("airport_iata")], 10)


@query("""SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders""")
def rank_orders(spark, base):
    df = table(spark, base, "orders").select("o_orderkey", "o_totalprice")
    return profile.rank_by(df, [F.col("o_totalprice").desc(), "o_orderkey"], "place").drop("o_totalprice")


# ---------------------------------------------------------------- sampling and splitting


@query(f"WITH {_FLIGHTS} SELECT year, delay_label, count(*) AS n FROM flights GROUP BY ALL")
def class_counts(spark, base):
    df = dated(spark, base)
    return sampling.class_counts(df, "year", "delay_label")


@query(f"""WITH {_FLIGHTS}, f AS (
  SELECT least(1.0, count(CASE WHEN delay_label = 0 THEN 1 END)::DOUBLE / count(CASE WHEN delay_label = 1 THEN 1 END)) AS f FROM flights)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, delay_label FROM flights, f
WHERE delay_label = 0 OR {_hash_sql(ROW_KEYS, 0)} < f""")
def undersample(spark, base):
    df = sampling.undersample(labelled(spark, base), "delay_label", 0, 1.0, ROW_KEYS)
    return df.select(*ROW_KEYS[:4], "delay_label")


@query(f"""WITH {_FLIGHTS}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM flights WHERE {_hash_sql(ROW_KEYS, 81)} < 0.1""")
def fraction_sample(spark, base):
    return sampling.fraction(flights(spark, base), 0.1, ROW_KEYS).select(*ROW_KEYS[:4])


@query(f"""WITH {_FLIGHTS}
SELECT CASE WHEN year = 2001 THEN 'test' ELSE 'train' END AS part, delay_label, count(*) AS n
FROM flights WHERE year <= 2001 GROUP BY ALL""")
def holdout_counts(spark, base):
    train, test = split.holdout(dated(spark, base), "year", LAST_YEAR)
    parts = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return parts.groupBy("part", "delay_label").agg(F.count("*").alias("n"))


@query(f"""WITH {_FLIGHTS}
SELECT CAST(k AS INTEGER) AS fold, CASE WHEN year = 1995 + k THEN 'test' ELSE 'train' END AS cv, year, delay_label, count(*) AS n
FROM flights, range(1, 6) t(k) WHERE year <= 1995 + k GROUP BY ALL""")
def rolling_folds(spark, base):
    df = split.rolling_folds(dated(spark, base).select("year", "delay_label"), "year", FIRST_YEAR, LAST_YEAR - 1)
    return df.groupBy("fold", "cv", "year", "delay_label").agg(F.count("*").alias("n"))


@query(f"""WITH {_FLIGHTS}
SELECT CAST(k AS INTEGER) AS fold, CASE WHEN year = 1995 + k THEN 'test' ELSE 'train' END AS cv, year, delay_label, count(*) AS n
FROM flights, range(1, 6) t(k) WHERE year IN (1994 + k, 1995 + k) GROUP BY ALL""")
def yearly_folds(spark, base):
    df = split.yearly_folds(dated(spark, base).select("year", "delay_label"), "year", FIRST_YEAR, LAST_YEAR - 1)
    return df.groupBy("fold", "cv", "year", "delay_label").agg(F.count("*").alias("n"))


@query(f"""WITH {_FLIGHTS}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(floor({_hash_sql(ROW_KEYS, 0)} * 3) AS INTEGER) AS fold FROM flights""")
def hash_folds(spark, base):
    return split.random_folds(flights(spark, base), 3, ROW_KEYS).select(*ROW_KEYS[:4], "fold")


# ---------------------------------------------------------------- feature stages


@query(f"""WITH {_FLIGHTS}, t AS (
  SELECT avg(l_quantity) AS mq, stddev_samp(l_quantity) AS sq, avg(o_totalprice) AS mp, stddev_samp(o_totalprice) AS sp
  FROM flights WHERE year < 2001)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, year, round((l_quantity - mq) / sq, 2) + 0.0 AS l_quantity_scaled,
       round((o_totalprice - mp) / sp, 2) + 0.0 AS o_totalprice_scaled
FROM flights, t""")
def zscore(spark, base):
    df = dated(spark, base).select(*ROW_KEYS[:4], "year", "l_quantity", "o_totalprice")
    train, test = split.holdout(df, "year", LAST_YEAR)
    train, test = features.zscore(train, [train, test], ["l_quantity", "o_totalprice"])
    return train.unionByName(test)


@query(f"""WITH {_FLIGHTS}, m AS (SELECT avg(actual_dep_time) AS mean FROM flights)
SELECT cancelled, round(avg(coalesce(actual_dep_time, mean)), 8) AS filled, count(*) AS n FROM flights, m GROUP BY ALL""")
def impute_mean(spark, base):
    df = flights(spark, base).select("cancelled", F.col("actual_dep_time").cast("double").alias("x"))
    filled = Pipeline(stages=models.matrix_stages([], ["x"])).fit(df).transform(df)
    return filled.groupBy("cancelled").agg(F.round(F.avg("x_imputed"), 8).alias("filled"), F.count("*").alias("n"))


_INDEXED = """SELECT event_type, row_number() OVER (ORDER BY n DESC, event_type) - 1 AS place, n
FROM (SELECT event_type, count(*) AS n FROM events GROUP BY event_type)"""


@query(f"SELECT event_type, CAST(place AS DOUBLE) AS event_index, n FROM ({_INDEXED})")
def string_index(spark, base):
    df = table(spark, base, "events").select("event_type")
    indexed = Pipeline(stages=models.matrix_stages(["event_type"], [])).fit(df).transform(df)
    return indexed.groupBy("event_type", F.col("event_type_idx").alias("event_index")).agg(F.count("*").alias("n"))


@query(f"""SELECT event_type, CAST(place AS INTEGER) AS slot, CAST((SELECT count(DISTINCT event_type) FROM events) AS INTEGER) AS width, n
FROM ({_INDEXED})""")
def one_hot(spark, base):
    df = table(spark, base, "events").select("event_type")
    stages = models.matrix_stages(["event_type"], [])
    encoded = Pipeline(stages=stages).fit(df).transform(df)
    cells = encoded.select("event_type", vector_to_array("event_type_class").alias("cells"))
    slot = (F.array_position("cells", 1.0) - 1).cast("int").alias("slot")
    return cells.groupBy("event_type", slot, F.size("cells").alias("width")).agg(F.count("*").alias("n"))


@query(f"""WITH {_FLIGHTS}
SELECT quarter, CAST(quarter - 1 AS DOUBLE) AS quarter_index, CAST(sum(l_quantity) AS DOUBLE) AS quantity
FROM flights GROUP BY quarter""")
def vector_index(spark, base):
    df = flights(spark, base).select("quarter", "l_quantity")
    indexed = Pipeline(stages=models.boosted_stages(["quarter", "l_quantity"])).fit(df).transform(df)
    cells = indexed.select("quarter", vector_to_array("features").alias("cells"))
    return cells.groupBy("quarter", F.get("cells", F.lit(0)).alias("quarter_index")).agg(
        F.sum(F.get("cells", F.lit(1))).alias("quantity")
    )


@query(f"""WITH {_FLIGHTS}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 3 AS width,
       actual_dep_time + l_quantity + round(l_tax * 100) AS total
FROM flights WHERE actual_dep_time IS NOT NULL""")
def assemble_vector(spark, base):
    df = flights(spark, base).withColumn("tax", F.round(F.col("l_tax") * 100))
    inputs = ["actual_dep_time", "l_quantity", "tax"]
    vectors = VectorAssembler(inputCols=inputs, outputCol="v", handleInvalid="skip").transform(df)
    cells = vectors.select(*ROW_KEYS[:4], vector_to_array("v").alias("cells"))
    total = F.aggregate("cells", F.lit(0.0), lambda a, b: a + b).alias("total")
    return cells.select(*ROW_KEYS[:4], F.size("cells").alias("width"), total)


# ---------------------------------------------------------------- evaluation

_SCORED = f"""{_FLIGHTS}, scored AS (
  SELECT delay_label, ((l_partkey * 7 + l_suppkey * 13 + l_linenumber * 31) % 1000)::DOUBLE / 1000 AS score,
         CASE WHEN (l_partkey * 7 + l_suppkey * 13 + l_linenumber * 31) % 1000 >= 500 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
  FROM flights)"""

_CLASSES = f"""{_SCORED}, classes AS (
  SELECT c AS class, count(CASE WHEN delay_label = c THEN 1 END) AS support,
         coalesce(count(CASE WHEN delay_label = c AND prediction = c THEN 1 END)::DOUBLE / nullif(count(CASE WHEN prediction = c THEN 1 END), 0), 0) AS precision,
         coalesce(count(CASE WHEN delay_label = c AND prediction = c THEN 1 END)::DOUBLE / nullif(count(CASE WHEN delay_label = c THEN 1 END), 0), 0) AS recall,
         count(CASE WHEN delay_label = c AND prediction = c THEN 1 END) AS hits
  FROM scored, (VALUES (0.0::DOUBLE), (1.0::DOUBLE)) v(c) GROUP BY c),
rates AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM classes),
metrics AS (
  SELECT sum(support * recall) / sum(support) AS recall, sum(support * precision) / sum(support) AS precision,
         sum(support * f1) / sum(support) AS f1, sum(hits)::DOUBLE / sum(support) AS accuracy, sum(support)::BIGINT AS n
  FROM rates)"""


def scored(spark: SparkSession, base: str) -> DataFrame:
    """A fixed score, so that metrics can be checked apart from any model."""
    mixed = (F.col("l_partkey") * 7 + F.col("l_suppkey") * 13 + F.col("l_linenumber") * 31) % 1000
    return labelled(spark, base).select(
        "delay_label",
        (mixed / 1000).alias("score"),
        F.when(mixed >= 500, 1.0).otherwise(0.0).alias("prediction"),
    )


@query(f"""WITH {_CLASSES}
SELECT round(recall, 8) AS recall, round(precision, 8) AS precision, round(f1, 8) AS f1, round(accuracy, 8) AS accuracy, n FROM metrics""")
def metrics_weighted(spark, base):
    df = evaluate.weighted(scored(spark, base), "delay_label", "prediction")
    return df.withColumns({c: F.round(c, 8) for c in ("recall", "precision", "f1", "accuracy")})


@query(f"""WITH {_CLASSES}
SELECT class, support, round(precision, 8) AS precision, round(recall, 8) AS recall, hits, round(f1, 8) AS f1 FROM rates""")
def metrics_per_class(spark, base):
    df = evaluate.per_class(scored(spark, base), "delay_label", "prediction")
    return df.withColumns({c: F.round(c, 8) for c in ("precision", "recall", "f1")})


@query(f"""WITH {_SCORED}
SELECT CAST(delay_label AS DOUBLE) AS label, prediction, count(*) AS n FROM scored GROUP BY ALL""")
def confusion(spark, base):
    return evaluate.confusion(scored(spark, base), "delay_label", "prediction")


@query(f"""WITH {_SCORED}, r AS (
  SELECT delay_label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS place FROM scored)
SELECT round((sum(CASE WHEN delay_label = 1 THEN place END) - sum(delay_label) * (sum(delay_label) + 1) / 2.0)
       / (sum(delay_label)::DOUBLE * sum(1 - delay_label)), 8) AS auc FROM r""")
def auc(spark, base):
    return evaluate.auc(scored(spark, base), "delay_label", "score").withColumn("auc", F.round("auc", 8))


@query(f"WITH {_SCORED} SELECT round(sqrt(avg(pow(delay_label - score, 2))), 8) AS rmse FROM scored")
def rmse(spark, base):
    return evaluate.rmse(scored(spark, base), "delay_label", "score").withColumn("rmse", F.round("rmse", 8))


@query(f"""WITH {_SCORED}, b AS (
  SELECT score, sum(delay_label) AS pos, sum(1 - delay_label) AS neg FROM scored GROUP BY 1),
p AS (SELECT score, sum(pos) OVER (ORDER BY score DESC)::DOUBLE / sum(pos) OVER () AS tpr,
             sum(neg) OVER (ORDER BY score DESC)::DOUBLE / sum(neg) OVER () AS fpr FROM b),
s AS (SELECT *, (fpr - lag(fpr, 1, 0) OVER (ORDER BY score DESC)) * (tpr + lag(tpr, 1, 0) OVER (ORDER BY score DESC)) / 2 AS slab FROM p)
SELECT round(score, 6) AS threshold, round(fpr, 8) AS fpr, round(tpr, 8) AS tpr,
       round(sum(slab) OVER (ORDER BY score DESC), 8) AS area FROM s""")
def roc_points(spark, base):
    df = evaluate.roc(scored(spark, base), "delay_label", "score")
    return df.withColumns({"threshold": F.round("threshold", 6), **{c: F.round(c, 8) for c in ("fpr", "tpr", "area")}})


@query(f"""WITH {_CLASSES}
SELECT round(recall * 976000, 4) AS detected, round(recall * precision * 976000, 4) AS confirmed,
       round(recall * precision * 8.4e9, 2) AS savings, round(8.4e9 / 976000, 6) AS savings_per_delay FROM metrics""")
def impact(spark, base):
    metrics = evaluate.weighted(scored(spark, base), "delay_label", "prediction")
    places = {"detected": 4, "confirmed": 4, "savings": 2, "savings_per_delay": 6}
    return evaluate.impact(metrics, 976_000.0, 8.4e9).withColumns({c: F.round(c, d) for c, d in places.items()})


@query(f"""WITH {_SCORED} SELECT least(greatest(round(score * 3 - 1), 0.0), 1.0)::DOUBLE AS pred_adjust, count(*) AS n FROM scored GROUP BY ALL""")
def round_prediction(spark, base):
    df = scored(spark, base).select((F.col("score") * 3 - 1).alias("prediction"))
    return evaluate.round_prediction(df).groupBy("pred_adjust").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- models

_CATEGORICAL = ["quarter", "month", "day_of_week", "airport_iata", "dest_iata", "is_holiday", *schemas.SEASONS]
_NUMERIC = ["l_quantity", "l_discount", "l_tax", "o_totalprice"]
_PLAIN = ["is_holiday", *schemas.SEASONS, *schemas.DAY_PARTS, *[c + "_scaled" for c in _NUMERIC]]


def model_rows(spark: SparkSession, base: str) -> DataFrame:
    """Rows of all years with the model columns, materialised once."""
    df = features.holiday_flag(dated(spark, base), "fl_date", standin.holidays(spark))
    df = features.seasons(df, "month")
    df = features.day_parts(df.withColumn("hour", timeutil.hhmm_hour(timeutil.clamp_hhmm("target_dep_time"))), "hour")
    wanted = [*_CATEGORICAL, *schemas.DAY_PARTS, *_NUMERIC]
    return io.stage(df.select(*ROW_KEYS, "year", *wanted, "delay_label"), scratch_path(spark, "model-table"))


def model_tables(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    """Scaled training years and the held-out year; the balanced rows are materialised once, as fits read them often."""
    train, test = split.holdout(model_rows(spark, base), "year", LAST_YEAR)
    train = io.stage(balanced(train), scratch_path(spark, "model-train"))
    return tuple(features.zscore(train, [train, test], _NUMERIC))


def fold_tables(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    """Training years and the held-out year as they are, for stages that scale and balance inside each fold."""
    return split.holdout(model_rows(spark, base), "year", LAST_YEAR)


def balanced(df: DataFrame) -> DataFrame:
    return sampling.undersample(df, "delay_label", 0, 1.0, ROW_KEYS)


def _scaled(cols: list[str]) -> list[str]:
    return [c + "_scaled" for c in cols]


_SHOWN = [*ROW_KEYS[:4], "delay_label", "prediction"]


@query()
def pca_scores(spark, base):
    df = model_rows(spark, base)
    (df,) = features.zscore(df, [df], _NUMERIC)
    scores, _ = features.pca(df, _PLAIN, k=5)
    return scores.select(*ROW_KEYS[:4], vector_to_array("pca_features").alias("pca_features"))


@query()
def pca_embeddings(spark, base):
    df = table(spark, base, "embeddings")
    least, width = df.filter(F.col("embedding").isNotNull()).agg(F.min(F.size("embedding")), F.max(F.size("embedding"))).first()
    if least != width:
        raise ValueError(f"embeddings are {least} to {width} wide")
    cols = [f"e{i}" for i in range(width or 0)]
    wide = df.select("vec_id", *[F.get("embedding", F.lit(i)).cast("double").alias(c) for i, c in enumerate(cols)])
    scores, _ = features.pca(wide, cols, k=5)
    return scores.select("vec_id", vector_to_array("pca_features").alias("pca_features"))


@query()
def lr_predictions(spark, base):
    train, test = model_tables(spark, base)
    return models.logistic(_PLAIN).fit(train).transform(test).select(*_SHOWN)


@query(f"""SELECT term, true AS optimal FROM (VALUES ('(intercept)'), {', '.join(f"('{c}')" for c in _PLAIN)}) t(term)""")
def lr_optimality(spark, base):
    """Whether the penalised log loss has no slope at the fitted coefficients, term by term, over all training rows."""
    train, _ = model_tables(spark, base)
    model = models.logistic(_PLAIN).fit(train)
    found = certify.logistic_gradient(model.transform(train), model.stages[-1], _PLAIN)
    return found.select("term", (F.abs("gradient") < 1e-4).alias("optimal"))


@query("SELECT component, true AS matches, true AS uncorrelated, true AS in_order FROM range(1, 6) t(component)")
def pca_optimality(spark, base):
    """Whether each component's scores have the variance the model states, in order and uncorrelated."""
    df = model_rows(spark, base)
    (df,) = features.zscore(df, [df], _NUMERIC)
    scores, model = features.pca(df, _PLAIN, k=5)
    total = df.agg(reduce(add, [F.var_samp(c) for c in _PLAIN])).first()[0]
    found = certify.component_checks(scores, model, total)
    return found.select(F.col("component").cast("long").alias("component"), "matches", "uncorrelated", "in_order")


@query(f"""WITH {_FLIGHTS} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, delay_label, true AS same, true AS rounded
FROM flights WHERE year = {LAST_YEAR}""")
def saved_model_agrees(spark, base):
    """Every held-out row once: the saved and loaded model scores it as the fitted one does, and predicts the likelier class."""
    train, test = model_tables(spark, base)
    fitted, path = models.logistic(_PLAIN).fit(train), scratch_path(spark, "model")
    io.save_model(fitted, path)
    names = ["p", "prediction"]
    rows = fitted.transform(test).select("*", vector_to_array("probability")[1].alias("p"))
    rows = rows.select(*test.columns, *[F.col(c).alias(f"was_{c}") for c in names])
    again = io.load_model(path).transform(rows).withColumn("p", vector_to_array("probability")[1])
    same = (F.col("p") == F.col("was_p")) & (F.col("prediction") == F.col("was_prediction"))
    rounded = F.col("prediction") == F.when(F.col("p") > 0.5, 1.0).otherwise(0.0)
    return again.select(*ROW_KEYS[:4], "delay_label", same.alias("same"), rounded.alias("rounded"))


@query()
def pca_lr_predictions(spark, base):
    train, test = model_tables(spark, base)
    *stages, lr = models.pca_logistic(_PLAIN).getStages()
    return models.fit_cached(stages, lr, train).transform(test).select(*_SHOWN)


@query()
def rf_predictions(spark, base):
    train, test = model_tables(spark, base)
    stages = models.with_pca(models.matrix_stages(_CATEGORICAL, _scaled(_NUMERIC)))
    fitted = models.fit_cached(stages, models.random_forest(), train)
    return fitted.transform(test).select(*_SHOWN)


@query()
def gbt_predictions(spark, base):
    train, test = model_tables(spark, base)
    fitted = models.fit_cached(models.boosted_stages(_PLAIN), models.boosted_trees(maxDepth=6, maxIter=50), train)
    return evaluate.round_prediction(fitted.transform(test)).select(*_SHOWN, "pred_adjust")


@query()
def boosted_missing_predictions(spark, base):
    train, test = model_tables(spark, base)
    fitted = models.fit_cached([VectorAssembler(inputCols=_PLAIN, outputCol="raw_features")], models.boosted_missing(), train)
    return evaluate.round_prediction(fitted.transform(test)).select(*_SHOWN, "pred_adjust")


_SMOTE_KEYS = ROW_KEYS[:4]
_SMOTE_RATIO = 0.75
_SMOTE_COPIES = f"floor(n * {_SMOTE_RATIO}) + CASE WHEN {_hash_sql(_SMOTE_KEYS, 81)} < n * {_SMOTE_RATIO} - floor(n * {_SMOTE_RATIO}) THEN 1 ELSE 0 END"


@query(f"""WITH {_FLIGHTS}, points AS (
  SELECT {', '.join(_NUMERIC)}, min({{{', '.join(f"'{c}': {c}" for c in _SMOTE_KEYS)}}}) AS id, count(*) AS n
  FROM flights WHERE cancelled = 1 GROUP BY {', '.join(_NUMERIC)}),
counted AS (SELECT {', '.join(f"id.{c} AS {c}" for c in _SMOTE_KEYS)}, n FROM points),
copies AS (SELECT {', '.join(_SMOTE_KEYS)}, unnest(range(1, CAST({_SMOTE_COPIES} AS BIGINT) + 1)) AS copy FROM counted)
SELECT {', '.join(_SMOTE_KEYS)}, copy, true AS other_is_another, true AS on_line FROM copies""")
def smote_rows(spark, base):
    """New rows for the cancelled flights; each is checked to lie between its two points."""
    rows = labelled(spark, base).select(*_SMOTE_KEYS, *_NUMERIC, "cancelled")
    rows = io.stage(rows.filter("cancelled = 1"), scratch_path(spark, "minority"))
    new = oversample.smote(rows, "cancelled", 1, _NUMERIC, _SMOTE_KEYS, _SMOTE_RATIO)
    at_base, at_other = F.col("base")["at"], F.col("other")["at"]

    def along(end):
        """Of the way from the base to ``end``, the part that goes towards the other point."""
        return reduce(add, [(end[c] - at_base[c]) * (at_other[c] - at_base[c]) for c in _NUMERIC])

    new = new.withColumn("share", along(F.struct(*_NUMERIC)) / along(at_other))
    gaps = [
        F.abs(F.col(c) - at_base[c] - F.col("share") * (at_other[c] - at_base[c]))
        <= 1e-9 * (F.abs(at_base[c]) + F.abs(at_other[c]) + 1)
        for c in _NUMERIC
    ]
    on_line = reduce(and_, gaps, F.col("share").between(-1e-9, 1 + 1e-9))
    apart = (F.col("base") != F.col("other")).alias("other_is_another")
    return new.select("base.key.*", "copy", apart, on_line.alias("on_line"))


def _tuned_logistic():
    """Estimator, its full grid and its feature stages, as in ``jobs/learn.py``."""
    lr = models.LogisticRegression(featuresCol="pca_features", labelCol="delay_label")
    stages = models.with_pca(models.matrix_stages(_CATEGORICAL, _scaled(_NUMERIC)))
    return lr, tuning.logistic_grid(lr), Pipeline(stages=[scaling.ZScore(inputCols=_NUMERIC), *stages])


@query()
def fold_cv_scores(spark, base):
    train, _ = fold_tables(spark, base)
    lr, maps, stages = _tuned_logistic()
    found = tuning.fold_cv(
        lr,
        maps,
        BinaryClassificationEvaluator(labelCol="delay_label"),
        train,
        split.rolling_splits("year", FIRST_YEAR, LAST_YEAR - 1),
        features=stages,
        balance=balanced,
    )
    return found.scores


@query()
def fold_cv_average(spark, base):
    train, _ = fold_tables(spark, base)
    gbt = models.boosted_trees()
    found = tuning.fold_cv(
        gbt,
        tuning.boosted_grid(gbt),
        RegressionEvaluator(labelCol="delay_label", metricName="rmse"),
        split.random_folds(train, 3, ROW_KEYS),
        split.random_splits("fold", 3),
        features=Pipeline(stages=[scaling.ZScore(inputCols=_NUMERIC), *models.boosted_stages(_PLAIN)]),
        balance=balanced,
    )
    return found.average()


@query()
def tuned_predictions(spark, base):
    train, test = fold_tables(spark, base)
    lr, maps, stages = _tuned_logistic()
    model, _ = tuning.tune_then_refit(
        lr,
        maps,
        BinaryClassificationEvaluator(labelCol="delay_label"),
        train,
        split.yearly_splits("year", FIRST_YEAR, LAST_YEAR - 1),
        ROW_KEYS,
        sample=0.5,
        features=stages,
        balance=balanced,
    )
    return model.transform(test).select(*_SHOWN)


@query()
def saved_model_predictions(spark, base):
    train, test = model_tables(spark, base)
    path = scratch_path(spark, "model")
    io.save_model(models.logistic(_PLAIN).fit(train), path)
    return io.load_model(path).transform(test).select(*_SHOWN)
