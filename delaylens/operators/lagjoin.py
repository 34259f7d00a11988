"""Join each fact to the conditions of a fixed time before it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.functions.timeutil import TWO_HOURS, hour_key_floor
from delaylens.operators.joins import skew_join


def lag_hour_join(
    facts: DataFrame,
    rollup: DataFrame,
    ts: str,
    keys: list[str],
    lag: str = TWO_HOURS,
    how: str = "inner",
    hour: str = "weather_ymdh",
    out: str | None = "target_dep_ymdh_n2",
    hot: dict[int, float] | None = None,
) -> DataFrame:
    """Facts with the roll-up row of the same site and the hour of ``ts - lag``.

    An equality on a derived hour key, so Spark can shuffle both sides by
    (site, hour); hours with a large share of the facts are salted. They are
    found in a pass over the key columns, which ``hot={}`` leaves out.
    """
    keyed = facts.withColumn(hour, hour_key_floor(ts, lag))
    joined = skew_join(keyed, rollup, [*keys, hour], how, hot=hot)
    return joined.withColumnRenamed(hour, out) if out else joined.drop(hour)


def lag_keyed(facts: DataFrame, ts: str, lag: str = TWO_HOURS, out: str = "target_dep_ymdh_n2") -> DataFrame:
    """Facts with the hour of ``ts - lag`` as a column, to be staged in buckets by site and hour."""
    return facts.withColumn(out, hour_key_floor(ts, lag))


def bucketed_lag_join(
    facts: DataFrame, rollup: DataFrame, keys: list[str], hour: str = "weather_ymdh", on: str = "target_dep_ymdh_n2",
    how: str = "inner",
) -> DataFrame:
    """The lag join of facts and a roll-up that were both staged in buckets by (``keys``, hour).

    The hour of the facts is a stored column, so the buckets meet as they lie: nothing is
    shuffled, however often different facts or roll-ups are joined. Same rows as
    :func:`lag_hour_join`; hot hours are not split, for those use that one.
    """
    site = rollup.select(*[F.col(c).alias(f"_site_{c}") for c in [*keys, hour]], *[c for c in rollup.columns if c not in [*keys, hour]])
    same = [F.col(c) == F.col(f"_site_{c}") for c in keys] + [F.col(on) == F.col(f"_site_{hour}")]
    return facts.join(site, same, how).drop(*[f"_site_{c}" for c in [*keys, hour]])
