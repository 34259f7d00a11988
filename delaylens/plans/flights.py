"""The three flows over real flight, weather, station and airport tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaylens.functions import timeutil
from delaylens.functions.zoneoffsets import ZoneTable, years_of, zone_table
from delaylens.operators import bridge, clean, features, graph, lagjoin, rollup, sampling, split
from delaylens.sources import schemas

# Time columns of a flight: (HHMM column, UTC column, whether it is at the destination).
FLIGHT_TIMES = [
    ("target_dep_time", "target_dep_utc_timestamp", False),
    ("actual_dep_time", "actual_dep_utc_timestamp", False),
    ("wheels_off", "wheels_off_utc_timestamp", False),
    ("wheels_on", "wheels_on_utc_timestamp", True),
    ("target_arr_time", "target_arr_utc_timestamp", True),
    ("actual_arr_time", "actual_arr_utc_timestamp", True),
]


def curate_weather(
    weather: DataFrame, stations: DataFrame, airports: DataFrame, zones: DataFrame, carry: list[str] | None = None
) -> DataFrame:
    """Raw readings to one row per airport and UTC hour.

    Stations get their airport and zone first, so that readings of places that
    are not known are dropped by one small join before anything is shuffled.
    Duplicates, compared as they were read, and the roll-up both combine on the
    map side, so copies of one reading do not meet in one task. ``carry`` names the
    other columns to keep from the earliest reading, by default all. Without any,
    Spark can aggregate by hash instead of sorting.
    """
    sites = clean.dedup(bridge.station_airport(stations, airports))
    sites = timeutil.attach_tz(sites, "airport_iata", zones, "inner")
    readings = clean.project(weather, ["STATION", *schemas.WEATHER_NAMES])
    offsets = zone_table(zones, *years_of(weather, "DATE"))
    readings = offsets.attach(bridge.attach_airport(readings, sites), "tz", "DATE")
    utc = offsets.to_utc(timeutil.parse_local("DATE"), "tz")
    readings = clean.dedup(readings.withColumn("weather_utc_timestamp", utc).drop("tz", "_zone"))
    readings = clean.rename(readings, schemas.WEATHER_NAMES)
    readings = clean.cast_readings(readings, schemas.WEATHER_TYPES)
    readings = clean.fill(readings, 0, schemas.WEATHER_ZERO_WHEN_MISSING)
    readings = clean.require(readings, ["weather_utc_timestamp"])
    carried = [c for c in readings.columns if c not in schemas.WEATHER_AGGREGATES and c != "airport_iata"]
    if carry is not None:
        carried = [c for c in carried if c in carry]
    return rollup.hourly_rollup(
        readings,
        "weather_utc_timestamp",
        ["airport_iata"],
        {**{c: "first" for c in carried}, **schemas.WEATHER_AGGREGATES},
        order_by=["weather_utc_timestamp", "station_id"],
    )


def flight_times(flights: DataFrame, compat_utc: bool = False, offsets: ZoneTable | None = None) -> DataFrame:
    """Add the six UTC times from local ``HHMM`` and the zones ``tz`` and ``dest_tz``.

    Departures fall on the day nearest to the target and ``dep_delay``; arrivals use the destination's
    zone, and each later event the first day on which it does not precede the one before. ``compat_utc`` uses the origin's zone and date
    throughout and takes 0 for missing. With ``offsets`` two small joins bring the offsets of both zones;
    without, every time is converted by itself.
    """
    sides = {False: ("tz", "_origin"), True: ("dest_tz", "_dest")}
    df = flights
    for tz, side in [sides[dest] for dest in (False, True) if offsets and not (dest and compat_utc)]:
        df = offsets.attach(df, tz, "fl_date", side)

    def utc(hhmm: str, dest: bool) -> Column:
        tz, side = sides[dest and not compat_utc]
        if offsets is None:
            return timeutil.hhmm_to_utc("fl_date", hhmm, tz, zero_is_null=compat_utc)
        return offsets.hhmm_to_utc("fl_date", hhmm, tz, side, zero_is_null=compat_utc)

    df = df.withColumns({name: utc(t, dest) for t, name, dest in FLIGHT_TIMES}).drop("_origin", "_dest")
    if compat_utc:
        return df

    day, half_day = F.expr("INTERVAL 1 DAY"), F.expr("INTERVAL 12 HOURS")

    def moved(time: Column, upto: Column) -> Column:
        """``time`` moved by whole days to the last one not after ``upto``."""
        near = time + F.make_dt_interval(F.extract(F.lit("DAY"), upto - time))
        return F.when(near > upto, near - day).otherwise(near)

    def after(c: str, *earlier: str) -> Column:
        """Add whole days until ``c`` is no longer before the first known of ``earlier``."""
        before = F.coalesce(*earlier)
        last = moved(F.col(c), before)
        first = F.when(last < before, last + day).otherwise(last)
        return F.when(F.col(c) < before, first).otherwise(F.col(c))

    # of all days the one on which the departure lies nearest to its target and delay
    late = F.make_dt_interval(mins=F.coalesce(F.col("dep_delay"), F.lit(0.0)).cast("int"))
    actual, expected = F.col("actual_dep_utc_timestamp"), F.col("target_dep_utc_timestamp") + late
    dep, off, on = (f"{c}_utc_timestamp" for c in ("actual_dep", "wheels_off", "wheels_on"))
    df = df.withColumn(dep, F.when(expected.isNotNull(), moved(actual, expected + half_day)).otherwise(actual))
    df = df.withColumn(off, after(off, dep)).withColumn(on, after(on, off, dep))
    return df.withColumns(
        {
            "target_arr_utc_timestamp": after("target_arr_utc_timestamp", "target_dep_utc_timestamp"),
            "actual_arr_utc_timestamp": after("actual_arr_utc_timestamp", on, off, dep),
        }
    )


def curate_flights(flights: DataFrame, zones: DataFrame, compat: bool = False) -> DataFrame:
    """Raw flights to distinct rows with UTC times, label and calendar features."""
    df = clean.rename(clean.project(flights, list(schemas.FLIGHT_NAMES)), schemas.FLIGHT_NAMES)
    df = clean.dedup(clean.require(df, ["fl_date", "target_dep_time"]))
    df = df.withColumns({t: timeutil.clamp_hhmm(t) for t, _, _ in FLIGHT_TIMES})
    df = timeutil.attach_tz(df, "airport_iata", zones, "left")
    df = timeutil.attach_tz(df, "dest_iata", zones, "left", out="dest_tz")
    offsets = zone_table(zones, *years_of(flights, "FL_DATE"))
    df = flight_times(df, compat, offsets).drop("tz", "dest_tz")
    df = features.delay_label(df, "actual_dep_time", "dep_delay")
    df = features.fixed_holiday(df, "fl_date", schemas.FIXED_HOLIDAYS)
    df = features.seasons(df, "month")
    df = df.withColumn("_hour", timeutil.hhmm_hour("target_dep_time"))
    df = features.day_parts(df, "_hour", compat_night=compat).drop("_hour")
    df = features.member_flag(df, "airport_iata", schemas.BUSY_AIRPORTS)
    df = features.tail_key(df, "fl_date", "tail_num")
    return df.withColumn("year", features.year_of("fl_date"))


def join_weather(flights: DataFrame, hourly: DataFrame) -> DataFrame:
    """Flights with the weather at their origin two hours before departure."""
    return lagjoin.lag_hour_join(flights, hourly, "target_dep_utc_timestamp", ["airport_iata"])


def add_context(
    joined: DataFrame, holidays: DataFrame, compat_rank: bool = False, last_year: int | None = None
) -> DataFrame:
    """Add airport scores of the joined routes and the padded holiday flag.

    ``last_year`` is the held-out year: only routes of the years before it count. Without it
    routes of all years do.
    """
    known = joined if last_year is None else joined.filter(F.col("year") < last_year)
    edges = graph.edge_weights(known, "airport_iata", "dest_iata")
    ranks = graph.page_rank(edges, **({"alpha": 0.0, "dangling": "drop"} if compat_rank else {}))
    return features.holiday_flag(
        features.add_rank(joined, ranks).drop("holiday"), "fl_date", holidays, date="Date"
    )


def select_features(df: DataFrame) -> DataFrame:
    """Model columns only, with missing numbers as 0."""
    wanted = features.guard(
        [*schemas.CATEGORICAL_FEATURES, *schemas.NUMERIC_FEATURES], schemas.KNOWN_ONLY_AFTERWARDS
    )
    keys = ["fl_date", "airline", "flight_num", "tail_num", "target_dep_time", "year"]
    return clean.fill(df.select(*keys, "target_dep_utc_timestamp", *wanted, "delay_label"), 0, schemas.NUMERIC_FEATURES)


SAMPLE_KEYS = ["fl_date", "airline", "flight_num", "tail_num", "airport_iata", "dest_iata", "target_dep_time"]


def balanced(df: DataFrame, ratio: float = 1.0, seed: int = 81) -> DataFrame:
    """All delayed flights and about ``ratio`` times as many others."""
    return sampling.undersample(df, "delay_label", 1, ratio, SAMPLE_KEYS, seed)


def train_and_test(
    df: DataFrame, last_year: int, ratio: float = 1.0, seed: int = 81, fit_on: str = "train"
) -> tuple[DataFrame, DataFrame]:
    """Hold out ``last_year``, undersample and standardise.

    By default both are done on the training years alone; ``fit_on='all'`` undersamples
    and scales before the split. ``fit_on='fold'`` does neither: the rows stay as they are
    for a pipeline that scales and balances inside each fold.
    """
    df = features.period_keys(df, "fl_date", "quarter")
    if fit_on == "all":
        rows = balanced(df, ratio, seed)
        (scaled,) = features.zscore(rows, [rows], schemas.NUMERIC_FEATURES)
        return split.holdout(scaled, "year", last_year)
    train, test = split.holdout(df, "year", last_year)
    if fit_on == "fold":
        return train, test
    train = balanced(train, ratio, seed)
    train, test = features.zscore(train, [train, test], schemas.NUMERIC_FEATURES)
    return train, test
