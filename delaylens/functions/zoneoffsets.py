"""Offsets of time zones as a small table, joined by zone and year instead of converting every row.

The clock changes of each zone are searched once: its offset is probed every six hours, and
where two probes differ the instant of the change is found by the minute and then by the
second. A row of the table holds a zone's offsets over one year and some days around it, so
one broadcast join serves all times of a record, and the rest is comparisons.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaylens.functions.timeutil import _col, _interval, date_of, hhmm_to_local, local_to_utc

PAD_DAYS = 3
PROBE = "6 HOURS"
#: Years that a table may cover; other times are converted one by one.
YEARS = (1970, 2037)


def years_of(df: DataFrame, date: str) -> tuple[int, int]:
    """First and last year, within ``YEARS``, of an ISO text, date or timestamp: one pass over one column."""
    year = F.substring(F.col(date).cast("string"), 1, 4).try_cast("int")
    inside = df.select(year.alias("year")).filter(F.col("year").between(*YEARS))
    first, last = inside.agg(F.min("year"), F.max("year")).first()
    return (YEARS[0], YEARS[0]) if first is None else (first, last)


def _offset(utc: Column) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.col("tz"), utc) - utc


def _first_change(windows: DataFrame, step: str) -> DataFrame:
    """Shorten each (tz, since, upto, before) to the step in which the offset first differs from ``before``."""
    probes = F.sequence(F.col("since") + _interval(step), F.col("upto"), _interval(step))
    probed = windows.withColumn("at", F.explode(probes)).filter(_offset(F.col("at")) != F.col("before"))
    found = probed.groupBy("tz", "since", "before").agg(F.min("at").alias("upto"))
    return found.select("tz", (F.col("upto") - _interval(step)).alias("since"), "upto", "before")


def changes(zones: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Clock changes of the zones in ``tz``: at (UTC), and the offsets before and after it.

    Two changes within six hours that cancel out are not seen; no zone has had such.
    """
    start, end = (F.lit(f"{y}-01-01").cast("timestamp_ntz") for y in (first_year - 1, last_year + 2))
    probed = (
        zones.select("tz").distinct()
        .withColumn("since", F.explode(F.sequence(start, end, _interval(PROBE))))
        .withColumn("before", _offset(F.col("since")))
    )
    along = Window.partitionBy("tz").orderBy("since")
    # a zone has four probes a day, however many rows use it
    windows = probed.withColumns({"upto": F.lead("since").over(along), "after": F.lead("before").over(along)})
    windows = windows.filter(F.col("before") != F.col("after")).select("tz", "since", "upto", "before")
    exact = _first_change(_first_change(windows, "1 MINUTE"), "1 SECOND")
    return exact.select("tz", F.col("upto").alias("at"), "before", _offset(F.col("upto")).alias("after"))


@dataclass
class ZoneTable:
    """One row per zone and year: bounds of its local times, and offsets with the local times they start at.

    At most the number of zones times that of years, so it is always broadcast.
    """

    rows: DataFrame
    width: int
    ambiguous: str

    def attach(self, df: DataFrame, tz: str, date: Column | str, prefix: str = "_zone") -> DataFrame:
        """Left join the offsets of zone ``tz`` in the year of ``date`` as columns under ``prefix``."""
        dim = self.rows.select(
            F.col("tz").alias(f"{prefix}_tz"), F.col("year").alias(f"{prefix}_year"), F.col("known").alias(prefix)
        )
        on = (F.col(tz) == F.col(f"{prefix}_tz")) & (F.year(date_of(date)) == F.col(f"{prefix}_year"))
        return df.join(F.broadcast(dim), on, "left").drop(f"{prefix}_tz", f"{prefix}_year")

    def to_utc(self, ts: Column | str, tz: str, prefix: str = "_zone") -> Column:
        """Local times of attached rows in UTC; times outside the row's bounds are converted one by one."""
        ts, known = _col(ts), F.col(prefix)
        offset = reduce(
            lambda held, i: F.when(ts >= known[f"start{i}"], known[f"offset{i}"]).otherwise(held),
            range(1, self.width + 1),
            known["offset0"],
        )
        inside = (ts >= known["low"]) & (ts < known["high"])
        return F.when(inside, ts - offset).otherwise(local_to_utc(ts, tz, self.ambiguous))

    def hhmm_to_utc(self, date: str, hhmm: Column | str, tz: str, prefix: str = "_zone", zero_is_null: bool = False) -> Column:
        """Date and local ``HHMM`` of attached rows in UTC; any missing part gives null."""
        hhmm = _col(hhmm)
        if zero_is_null:
            hhmm = F.when(hhmm != 0, hhmm)
        return self.to_utc(hhmm_to_local(date, hhmm), tz, prefix)


def zone_table(
    zones: DataFrame, first_year: int, last_year: int, ambiguous: str = "later", pad_days: int = PAD_DAYS
) -> ZoneTable:
    """Offsets of the zones in column ``tz`` for local times of the given years, ``pad_days`` on either side.

    A local time belongs to the offset after a change from the moment the new clock shows
    it: times that occur twice are the later instant, and times that are skipped still
    have the old offset, which moves them forward. With ``ambiguous="earlier"`` repeated
    times keep the old offset.
    """
    named = zones.select("tz").filter(F.col("tz").isNotNull()).distinct()
    after = F.col("after") if ambiguous == "later" else F.greatest("before", "after")
    found = changes(named, first_year, last_year).select("tz", (F.col("at") + after).alias("start"), F.col("after").alias("offset"))
    origin = F.lit(f"{first_year - 1}-01-01").cast("timestamp_ntz")
    first = named.select("tz", (origin - _interval("2 DAYS")).alias("start"), _offset(origin).alias("offset"))
    held = first.unionByName(found).groupBy("tz").agg(F.array_sort(F.collect_list(F.struct("start", "offset"))).alias("all"))
    held = held.withColumn("year", F.explode(F.sequence(F.lit(first_year), F.lit(last_year))))
    pad = _interval(f"{pad_days} DAYS")
    low = F.make_date("year", F.lit(1), F.lit(1)).cast("timestamp_ntz") - pad
    high = F.make_date(F.col("year") + 1, F.lit(1), F.lit(1)).cast("timestamp_ntz") + pad
    held = held.withColumns({"low": low, "high": high}).withColumns(
        {
            "offset0": F.element_at(F.filter("all", lambda s: s["start"] <= F.col("low")), -1)["offset"],
            "inside": F.filter("all", lambda s: (s["start"] > F.col("low")) & (s["start"] < F.col("high"))),
        }
    )
    # zones times years: small, whatever the facts are
    rows = held.select("tz", "year", "low", "high", "offset0", "inside").collect()
    width = max((len(r["inside"]) for r in rows), default=0)
    parts = [F.col("low"), F.col("high"), F.col("offset0")]
    for i in range(1, width + 1):
        change = F.get("inside", F.lit(i - 1))
        parts += [change["start"].alias(f"start{i}"), change["offset"].alias(f"offset{i}")]
    kind = held.select("tz", "year", "low", "high", "offset0", "inside").schema
    table = zones.sparkSession.createDataFrame(rows, kind)
    return ZoneTable(table.select("tz", "year", F.struct(*parts).alias("known")), width, ambiguous)
