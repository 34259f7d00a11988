"""Roll readings up to one row per site and hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaylens.functions.timeutil import hour_key_round

AGGREGATES = {"mean": F.avg, "max": F.max, "min": F.min, "sum": F.sum}


def hourly_rollup(
    df: DataFrame,
    ts: str,
    keys: list[str],
    aggs: dict[str, str],
    order_by: list[str] | None = None,
    hour: str = "weather_ymdh",
) -> DataFrame:
    """One row per ``keys`` and nearest hour; ``aggs`` maps a column to its function.

    ``first`` means the earliest row along ``order_by`` (default ``ts``), ties
    going to the smallest values. All ``first`` columns share one buffer, and
    every function combines on the map side.
    """
    firsts = [c for c, f in aggs.items() if f == "first"]
    outputs: list[Column] = [AGGREGATES[f](c).alias(c) for c, f in aggs.items() if f != "first"]
    if firsts:
        order = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order_by or [ts])]
        outputs.append(F.min(F.struct(*order, *firsts)).alias("_first"))
    rolled = df.withColumn(hour, hour_key_round(ts)).groupBy(hour, *keys).agg(*outputs)
    return rolled.select(hour, *keys, *[F.col(f"_first.{c}") if c in firsts else F.col(c) for c in aggs])
