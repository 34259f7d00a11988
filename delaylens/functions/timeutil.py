"""Local time, UTC and hour keys.

Everything stays in ``timestamp_ntz`` so that results do not depend on the
session time zone, and every function is a native column expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaylens.operators.joins import lookup

TWO_HOURS = "2 hours"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _interval(text: str) -> Column:
    return F.expr(f"INTERVAL {text}")


def clamp_hhmm(c: Column | str) -> Column:
    """``HHMM`` with midnight written 2400 becomes 2359; null stays null."""
    c = _col(c)
    return F.when(c == 2400, F.lit(2359)).otherwise(c).cast("int")


def hhmm_hour(c: Column | str) -> Column:
    """Hour of an integer ``HHMM``."""
    return F.floor(_col(c) / 100).cast("int")


def parse_local(c: Column | str) -> Column:
    """ISO text to ``timestamp_ntz``; unparsable text becomes null."""
    return _col(c).try_cast("timestamp_ntz")


def local_to_utc(ts: Column | str, tz: Column | str, ambiguous: str = "later") -> Column:
    """Wall-clock time in zone ``tz`` to UTC.

    Times skipped by a clock change move forward by the gap. Times that occur
    twice take the later instant (standard time), or the earlier on request.
    """
    ts, tz = _col(ts), _col(tz)
    utc = F.convert_timezone(tz, F.lit("UTC"), ts)
    if ambiguous == "earlier":
        return utc
    later = F.when(F.lit(False), _interval("0 hour"))
    # clocks go back by an hour, by half of one or by two
    for back in map(_interval, ("1 hour", "30 minutes", "2 hours")):
        later = later.when(F.convert_timezone(F.lit("UTC"), tz, utc + back) == ts, back)
    return utc + later.otherwise(_interval("0 hour"))


def date_of(c: Column | str) -> Column:
    """Day of an ISO text, a date or a timestamp; null if it is none."""
    return F.substring(_col(c).cast("string"), 1, 10).try_cast("date")


def hhmm_to_local(date: Column | str, hhmm: Column | str) -> Column:
    """Date (ISO text, date or timestamp) and ``HHMM`` to local time; 2400 is 2359.

    An impossible time such as 1275 gives null.
    """
    day = F.substring(_col(date).cast("string"), 1, 10).try_cast("timestamp_ntz")
    t = clamp_hhmm(hhmm)
    clock = F.make_dt_interval(F.lit(0), hhmm_hour(t), F.pmod(t, F.lit(100)))
    return F.when(t.between(0, 2359) & (F.pmod(t, F.lit(100)) < 60), day + clock)


def hhmm_to_utc(
    date: Column | str, hhmm: Column | str, tz: Column | str, zero_is_null: bool = False
) -> Column:
    """Date and local ``HHMM`` in zone ``tz`` to UTC; any missing part gives null."""
    hhmm = _col(hhmm)
    if zero_is_null:
        hhmm = F.when(hhmm != 0, hhmm)
    return local_to_utc(hhmm_to_local(date, hhmm), tz)


def _hour_key(ts: Column) -> Column:
    number = F.year(ts) * 1000000 + F.month(ts) * 10000 + F.dayofmonth(ts) * 100 + F.hour(ts)
    return number.cast("string")


def hour_key_round(ts: Column | str) -> Column:
    """``YYYYMMDDHH`` of the nearest hour; half past goes up."""
    return _hour_key(_col(ts) + _interval("30 minutes"))


def hour_key_floor(ts: Column | str, lag: str = TWO_HOURS) -> Column:
    """``YYYYMMDDHH`` of the hour that contains ``ts - lag``."""
    return _hour_key(_col(ts) - _interval(lag))


def attach_tz(
    df: DataFrame, key: str, zones: DataFrame, how: str = "inner", zone_key: str = "iata", out: str = "tz"
) -> DataFrame:
    """Add each row's time zone: ``inner`` drops unknown sites, ``left`` gives null."""
    dim = zones.select(F.col(zone_key).alias(key), F.col("tz").alias(out))
    return lookup(df, dim, [key], how)
