"""Departures, readings, sites and calendars drawn from the supplied tables.

No flight data is supplied, so the order and event tables play its part: an
order line is a flight from the customer's nation to the supplier's, an event
is a sensor reading at station ``user_id % 25``, and nation ``n`` is both
station ``n`` and airport ``n``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylens.operators import features
from delaylens.sources.io import read_table

FIRST_YEAR, LAST_YEAR = 1995, 2001
ROW_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]

# A zone per site; site 24 has none on purpose.
ZONES = [
    "America/New_York", "America/Chicago", "America/Denver", "America/Los_Angeles", "America/Phoenix",
    "America/Anchorage", "Pacific/Honolulu", "America/Sao_Paulo", "Europe/London", "Europe/Paris",
    "Europe/Berlin", "Europe/Helsinki", "Africa/Cairo", "Africa/Johannesburg", "Asia/Dubai",
    "Asia/Kolkata", "Asia/Kathmandu", "Asia/Tokyo", "Asia/Shanghai", "Asia/Singapore",
    "Australia/Sydney", "Australia/Adelaide", "Pacific/Auckland", "America/St_Johns",
]

# Fixed values: (month, day) of the holidays; the December ones overlap once padded.
HOLIDAYS = [(1, 1), (7, 4), (11, 27), (12, 24), (12, 25), (12, 31)]


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return read_table(spark, base, name, ".parquet")


def zones(spark: SparkSession, base: str) -> DataFrame:
    """``site, tz`` for the nations that have a zone."""
    named = F.get(F.array(*[F.lit(z) for z in ZONES]), F.col("n_nationkey"))
    sites = table(spark, base, "nation").select(F.col("n_nationkey").alias("site"), named.alias("tz"))
    return sites.filter(F.col("tz").isNotNull())


def holidays(spark: SparkSession) -> DataFrame:
    return features.holidays_between(spark, FIRST_YEAR, LAST_YEAR, HOLIDAYS)


def readings(spark: SparkSession, base: str) -> DataFrame:
    """Sensor readings: a numeric one and a second one as text."""
    return table(spark, base, "events").select(
        "event_id",
        "ts",
        (F.col("user_id") % 25).cast("int").alias("station"),
        "event_type",
        "value",
        F.get_json_object("props", "$.k").alias("k"),
    )


def flights(spark: SparkSession, base: str) -> DataFrame:
    """One row per order line, with the columns of a flight record."""
    lines = table(spark, base, "lineitem")
    orders = table(spark, base, "orders")
    origin = table(spark, base, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("airport_iata")
    )
    dest = table(spark, base, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("dest_iata")
    )
    # customers meet the orders first, so that the lines, the largest table, move once for both
    orders = orders.withColumnRenamed("o_orderkey", "l_orderkey").join(origin, "o_custkey")
    joined = lines.join(orders, "l_orderkey").join(dest, "l_suppkey")
    slot = (F.col("l_partkey") % 25).cast("int")
    hhmm = F.when(slot == 24, 2400).otherwise(slot * 100 + F.col("l_linenumber"))
    day = F.col("o_orderdate")
    return joined.select(
        *ROW_KEYS,
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.dayofweek(day).alias("day_of_week"),
        F.substring(day.cast("string"), 1, 10).alias("fl_date"),
        F.col("l_suppkey").alias("airline"),
        F.col("l_partkey").alias("tail_num"),
        "airport_iata",
        "dest_iata",
        hhmm.alias("target_dep_time"),
        F.when(F.col("o_orderstatus") != "P", hhmm).alias("actual_dep_time"),
        F.datediff("l_shipdate", day).cast("double").alias("dep_delay"),
        F.when(F.col("o_orderstatus") == "P", 1).otherwise(0).alias("cancelled"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("diverted"),
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "o_totalprice",
    )
