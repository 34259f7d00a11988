"""Mix sources to target weights by entropy balancing.

Each document has ``most`` copy slots that are taken with probability 1 / most before
any balancing, so its base rate is 1. Among all rates that meet the token target of each
source, the one with the largest entropy relative to that base tilts exponentially with the document's
tokens: ``rate = most * e^h / (most - 1 + e^h)`` with ``h = lambda * tokens / mean``. The
convex dual has one multiplier per source. Newton steps find all of them at once; each
step is one distributed aggregation over (source, tokens, documents) counts.

Rates become copies by carrying the rounding error from document to document in
descending order of tokens, so that what remains is at most a short document for each bucket.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaylens.llm.common import WORD, staged

STEPS = 60
TOLERANCE = 1e-7
BUCKET_ROWS = 2048


def capped_targets(sizes: list[int], weights: list[float], total: float, most: float) -> list[float]:
    """Share ``total`` by weight; none above ``most`` times its size, the excess goes to the others."""
    targets = [0.0] * len(sizes)
    free = [i for i in range(len(sizes)) if weights[i] > 0]
    left = float(total)
    while free:
        share = left / sum(weights[i] for i in free)
        full = [i for i in free if weights[i] * share > most * sizes[i]]
        if not full:
            for i in free:
                targets[i] = weights[i] * share
            return targets
        for i in full:
            targets[i] = float(most * sizes[i])
            left -= targets[i]
        free = [i for i in free if i not in full]
    return targets


def _rate(h: Column, most: float) -> Column:
    """most * e^h / (most - 1 + e^h), written so that it cannot overflow."""
    return F.lit(float(most)) / (1 + (most - 1) * F.exp(-F.least(F.greatest(h, F.lit(-500.0)), F.lit(500.0))))


def balance(counts: DataFrame, sources: dict[int, tuple[float, float]], most: float) -> dict[int, float]:
    """Multiplier of each source; ``counts`` has k, size, n, ``sources`` k -> (target, scale).

    Newton steps, kept inside a bracket that each step narrows. A target at the
    source's cap or at nothing needs an infinite multiplier and is left to the caller.
    """
    spark = counts.sparkSession
    at = {k: 0.0 for k in sources}
    low, high = {k: -math.inf for k in sources}, {k: math.inf for k in sources}
    todo = set(sources)
    for _ in range(STEPS):
        if not todo:
            break
        now = spark.createDataFrame(
            [(k, at[k], sources[k][1]) for k in sorted(todo)], "k int, at double, scale double"
        )
        x = F.col("size") / F.col("scale")
        rate = _rate(F.col("at") * x, most)
        sums = (
            counts.join(F.broadcast(now), "k")
            .groupBy("k")
            .agg(
                F.sum(F.col("n") * F.col("size") * rate).alias("tokens"),
                F.sum(F.col("n") * F.col("size") * x * rate * (1 - rate / most)).alias("slope"),
            )
            .collect()
        )
        for r in sums:
            k, gap = r["k"], r["tokens"] - sources[r["k"]][0]
            if abs(gap) <= TOLERANCE * max(sources[k][0], 1.0):
                todo.discard(k)
                continue
            if gap > 0:
                high[k] = at[k]
            else:
                low[k] = at[k]
            step = at[k] - gap / r["slope"] if r["slope"] > 0 else math.nan
            if not low[k] < step < high[k]:
                if math.isinf(low[k]) or math.isinf(high[k]):
                    step = at[k] + (-1 if gap > 0 else 1) * max(1.0, abs(at[k]))
                else:
                    step = (low[k] + high[k]) / 2
            at[k] = step
    return at


def whole_copies(rate: float, size: int, debt: float, most: int) -> tuple[int, float]:
    """Copies next to ``rate`` that bring the running token total nearest to that of the rates."""
    debt += rate * size
    copies = math.floor(debt / size + 0.5) if size else round(rate)
    copies = min(max(copies, math.floor(rate)), math.ceil(rate), most)
    return copies, debt - copies * size


def _round_buckets(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, debt = None, 0.0
        for batch in batches:
            copies = []
            columns = (batch.column(c).to_pylist() for c in ("k", "bucket", "rate", "size"))
            for k, b, rate, size in zip(*columns):
                if (k, b) != bucket:
                    bucket, debt = (k, b), 0.0
                n, debt = whole_copies(rate, size, debt, most)
                copies.append(n)
            kept = [batch.column(c) for c in ("row", "k", "size")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(copies, pa.int64())], names=["row", "k", "size", "copies"]
            )

    return run


def mix(
    docs: DataFrame,
    columns: list[str],
    size: Column,
    source: str = "source",
    weights: tuple[float, ...] = (1, 2, 3),
    most: int = 3,
) -> DataFrame:
    """Copies of each row so that every source's tokens meet its share.

    Returns ``row`` (a struct of ``columns``), k (place of the source by code point,
    null last), source_size, target, size, copies. Weights repeat over the sources in that order. Rows without
    tokens keep one copy and take nothing; repeated rows are rounded one by one; a
    source without any tokens has target 0; an empty table gives no rows. The sources are
    listed on the driver: one total for each, never rows.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.struct(*columns).alias("row"),
        F.col(source).cast("string").alias("source"),
        F.coalesce(size, F.lit(0)).cast("long").alias("size"),
    )
    thin = staged(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "sizes")
    totals = thin.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("tokens"), F.sum("n").alias("docs")
    )
    listed = sorted(totals.collect(), key=lambda r: (r["source"] is None, r["source"] or ""))
    given = [float(weights[i % len(weights)]) for i in range(len(listed))]
    sizes = [r["tokens"] for r in listed]
    targets = capped_targets(sizes, given, sum(sizes), most)
    names = [
        (i, r["source"], int(r["tokens"]), targets[i], max(r["tokens"] / r["docs"], 1.0), -(-r["docs"] // BUCKET_ROWS))
        for i, r in enumerate(listed)
    ]
    schema = "k int, source string, source_size long, target double, scale double, buckets long"
    known = spark.createDataFrame(names, schema)
    counts = staged(
        thin.join(F.broadcast(known), thin["source"].eqNullSafe(known["source"])).select("k", "size", "n"), "counts"
    )
    open_ = {i: (targets[i], n[4]) for i, n in enumerate(names) if 0 < targets[i] < most * sizes[i] * (1 - 1e-9)}
    at = balance(counts, open_, most)
    tilts = [
        (*n, at.get(i, 0.0), None if i in open_ else (float(most) if targets[i] > 0 else 1.0))
        for i, n in enumerate(names)
    ]
    tilts = spark.createDataFrame(tilts, schema + ", at double, fixed double")
    rated = rows.join(F.broadcast(tilts), rows["source"].eqNullSafe(tilts["source"])).select(
        "row",
        "k",
        "size",
        F.when(F.col("size") == 0, F.lit(1.0))
        .otherwise(F.coalesce("fixed", _rate(F.col("at") * F.col("size") / F.col("scale"), most)))
        .alias("rate"),
        F.pmod(F.xxhash64("row"), F.col("buckets")).alias("bucket"),
    )
    ordered = rated.repartition("k", "bucket").sortWithinPartitions(
        "k", "bucket", F.desc("size"), F.xxhash64("row")
    )
    kind = rows.schema["row"].dataType.simpleString()
    done = ordered.mapInArrow(_round_buckets(most), f"row {kind}, k int, size long, copies long")
    return done.join(F.broadcast(known.select("k", "source_size", "target")), "k")


def words(text: Column) -> Column:
    """Number of words of a text; none for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0))
