"""Column lists, names and types of the input tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The columns and names of the input tables.

AIRPORTS = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("call", "iata", "name", "city", "country")]
    + [T.StructField(c, T.IntegerType()) for c in ("lat_deg", "lat_min", "lat_sec")]
    + [T.StructField("lat_dir", T.StringType())]
    + [T.StructField(c, T.IntegerType()) for c in ("lon_deg", "lon_min", "lon_sec")]
    + [T.StructField("lon_dir", T.StringType())]
    + [T.StructField("alt", T.IntegerType())]
    + [T.StructField(c, T.DoubleType()) for c in ("lat", "lon")]
)

STATION_NAMES = {
    "neighbor_id": "station_id",
    "neighbor_name": "station_name",
    "neighbor_state": "station_state",
    "neighbor_call": "station_call",
    "neighbor_lat": "station_lat",
    "neighbor_lon": "station_lon",
}

WEATHER_NAMES = {
    "DATE": "local_datetime",
    "HourlyDryBulbTemperature": "hourly_dry_bulb_temperature",
    "HourlyPrecipitation": "hourly_precipitation",
    "HourlyPresentWeatherType": "hourly_present_weather_type",
    "HourlyRelativeHumidity": "hourly_relative_humidity",
    "HourlySkyConditions": "hourly_sky_conditions",
    "HourlyVisibility": "hourly_visibility",
    "HourlyWindGustSpeed": "hourly_wind_gust_speed",
    "HourlyWindSpeed": "hourly_wind_speed",
    "DailyPrecipitation": "daily_precipitation",
    "DailySnowDepth": "daily_snow_depth",
    "DailySnowfall": "daily_snow_fall",
}

WEATHER_TYPES = {
    "hourly_dry_bulb_temperature": "int",
    "hourly_precipitation": "double",
    "hourly_relative_humidity": "int",
    "hourly_visibility": "double",
    "hourly_wind_gust_speed": "int",
    "hourly_wind_speed": "int",
    "daily_precipitation": "double",
    "daily_snow_depth": "int",
    "daily_snow_fall": "double",
}

WEATHER_ZERO_WHEN_MISSING = [
    "hourly_wind_gust_speed",
    "daily_precipitation",
    "daily_snow_depth",
    "daily_snow_fall",
]

WEATHER_AGGREGATES = {
    "hourly_dry_bulb_temperature": "mean",
    "hourly_precipitation": "max",
    "hourly_relative_humidity": "mean",
    "hourly_visibility": "max",
    "hourly_wind_gust_speed": "max",
    "hourly_wind_speed": "max",
    "daily_precipitation": "max",
    "daily_snow_depth": "max",
    "daily_snow_fall": "max",
}

FLIGHT_NAMES = {
    "QUARTER": "quarter",
    "MONTH": "month",
    "DAY_OF_WEEK": "day_of_week",
    "FL_DATE": "fl_date",
    "OP_CARRIER": "airline",
    "TAIL_NUM": "tail_num",
    "OP_CARRIER_FL_NUM": "flight_num",
    "ORIGIN": "airport_iata",
    "DEST": "dest_iata",
    "CRS_DEP_TIME": "target_dep_time",
    "DEP_TIME": "actual_dep_time",
    "DEP_DELAY": "dep_delay",
    "WHEELS_OFF": "wheels_off",
    "WHEELS_ON": "wheels_on",
    "CRS_ARR_TIME": "target_arr_time",
    "ARR_TIME": "actual_arr_time",
    "ARR_DELAY": "arr_delay",
    "CANCELLED": "cancelled",
    "DIVERTED": "diverted",
    "CANCELLATION_CODE": "cancellation_code",
    "CARRIER_DELAY": "carrier_delay",
    "WEATHER_DELAY": "weather_delay",
    "NAS_DELAY": "nas_delay",
    "SECURITY_DELAY": "security_delay",
    "LATE_AIRCRAFT_DELAY": "late_aircraft_delay",
}

KNOWN_ONLY_AFTERWARDS = [
    "carrier_delay",
    "weather_delay",
    "nas_delay",
    "security_delay",
    "late_aircraft_delay",
    "dep_delay",
    "arr_delay",
    "actual_dep_time",
    "actual_arr_time",
    "actual_dep_utc_timestamp",
    "actual_arr_utc_timestamp",
    "wheels_off",
    "wheels_on",
    "cancelled",
    "cancellation_code",
    "diverted",
    "delay_label",
    "late",
]

BUSY_AIRPORTS = ["ORD", "ATL"]

# Month and day of the holidays and the days around them.
FIXED_HOLIDAYS = [
    "1-1", "1-2", "7-3", "7-4", "7-5", "11-27", "11-28", "11-29", "12-24", "12-25", "12-26", "12-31",
]

SEASONS = ["spring", "summer", "fall", "winter"]

DAY_PARTS = ["early_morning", "morning", "afternoon", "evening", "night"]

NUMERIC_FEATURES = [
    "hourly_dry_bulb_temperature",
    "hourly_precipitation",
    "hourly_relative_humidity",
    "hourly_visibility",
    "hourly_wind_speed",
    "daily_precipitation",
    "dep_rank",
]

CATEGORICAL_FEATURES = (
    ["quarter", "month", "day_of_week", "airport_iata", "dest_iata", "is_holiday"] + SEASONS + DAY_PARTS
)
