"""Running totals and exact quantiles over a total order, without one big task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaylens.operators.joins import lookup
from delaylens.session import checkpointed


def place(df: DataFrame, order: list[Column | str], by: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Range-sort the rows by ``by`` and ``order`` and checkpoint them, or their columns ``keep``, with their place.

    ``order`` should be unique, so that a hot value can be split over partitions.
    """
    group = [F.col(by).asc_nulls_first()] if by else []
    located = df.orderBy(*group, *order).select(*(keep or df.columns)).withColumn("_pos", F.monotonically_increasing_id())
    return checkpointed(located.withColumn("_part", F.shiftright("_pos", 33)))


def running_totals(placed: DataFrame, totals: dict[str, Column], by: str | None = None) -> DataFrame:
    """Inclusive running sums of ``totals`` over :func:`place`-d rows, restarting for each ``by``.

    ``<name>_total`` holds the sum over the whole group. Sums run inside each
    range partition; only one row per partition and group takes part in the
    sums across partitions.
    """
    columns = [c for c in placed.columns if c not in ("_pos", "_part")]
    group = [by] if by else []
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("_part", *group).agg(*[F.sum(c).alias(f"_p_{n}") for n, c in totals.items()])
    offsets = parts.select(
        "_part",
        *group,
        *[F.coalesce(F.sum(f"_p_{n}").over(earlier), F.lit(0)).alias(f"_o_{n}") for n in totals],
        *[F.sum(f"_p_{n}").over(whole).alias(f"{n}_total") for n in totals],
    )
    inside = (
        Window.partitionBy("_part", *group)
        .orderBy("_pos")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    sums = placed.select(*columns, "_part", *[F.sum(c).over(inside).alias(f"_s_{n}") for n, c in totals.items()])
    if by:
        key = F.xxhash64("_part", by)
        offsets = offsets.withColumn("_key", key).drop("_part", by)
        joined = lookup(sums.withColumn("_key", key), offsets, ["_key"])
    else:
        joined = sums.join(F.broadcast(offsets), "_part")
    return joined.select(
        *columns,
        *[(F.col(f"_o_{n}") + F.col(f"_s_{n}")).alias(n) for n in totals],
        *[f"{n}_total" for n in totals],
    )


def rank_by(df: DataFrame, order: list[Column | str], out: str = "rank") -> DataFrame:
    """Number the rows 1, 2, 3, ... along ``order``."""
    return running_totals(place(df, order), {out: F.lit(1).cast("long")}).drop(f"{out}_total")


def counted_values(df: DataFrame, value: str, by: str) -> DataFrame:
    """Distinct valid values ``x`` per group with their count ``n``, in order of place."""
    counted = (
        df.select(by, F.col(value).cast("double").alias("x"))
        .filter(F.col("x").isNotNull() & ~F.isnan("x"))
        .groupBy(by, "x")
        .agg(F.count("*").alias("n"))
    )
    return place(counted, ["x"], by)


def quantiles(counted: DataFrame, probs: list[float], by: str) -> DataFrame:
    """Exact, linearly interpolated quantiles ``q0, q1, ...`` of :func:`counted_values`."""
    counted = running_totals(counted, {"upto": F.col("n")}, by)
    first, last = F.col("upto") - F.col("n"), F.col("upto") - 1
    picks = []
    for i, p in enumerate(probs):
        at = F.lit(p) * (F.col("upto_total") - 1)
        for side, k in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            picks.append(F.max(F.when((first <= k) & (k <= last), F.col("x"))).alias(f"_{side}{i}"))
        picks.append(F.max(at - F.floor(at)).alias(f"_w{i}"))
    found = counted.groupBy(by).agg(F.max("upto_total").alias("n"), *picks)
    values = [
        (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_w{i}")).alias(f"q{i}")
        for i in range(len(probs))
    ]
    return found.select(by, "n", *values)
