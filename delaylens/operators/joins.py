"""Joins of a large table with a table that holds few rows per key."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
SKETCHES = 64
SKETCH_ITEMS = 1024


def fits(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows: a distributed count, no rows move."""
    return df.count() <= max_rows


INTEGRAL = ["tinyint", "smallint", "int", "bigint"]
FLOATING = ["float", "double"]


def common_type(a: str, b: str) -> str:
    """The type two key types are compared in; fails where neither widens to the other."""
    if a == b:
        return a
    if a in INTEGRAL and b in INTEGRAL:
        return "bigint"
    if a in INTEGRAL + FLOATING and b in INTEGRAL + FLOATING:
        return "double"
    raise TypeError(f"keys of types {a} and {b} do not compare; cast one of them")


def same_keys(facts: DataFrame, dim: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame, list[str]]:
    """Give keys of different types a common one, in columns of their own; ``facts`` keeps its keys."""
    left, right, keys = dict(facts.dtypes), dict(dim.dtypes), []
    for c in on:
        kind = common_type(left[c], right[c])
        if left[c] != right[c]:
            facts = facts.withColumn(f"_key_{c}", F.col(c).cast(kind))
            dim = dim.withColumn(f"_key_{c}", F.col(c).cast(kind)).drop(c)
            keys.append(f"_key_{c}")
        else:
            keys.append(c)
    return facts, dim, keys


def _plain(joined: DataFrame, on: list[str], keys: list[str]) -> DataFrame:
    """Leave the keys of :func:`same_keys` out; the given ones come first, as in any join."""
    return joined.select(*on, *[c for c in joined.columns if c not in on and c not in keys])


def lookup(
    facts: DataFrame, dim: DataFrame, on: list[str], how: str = "inner", max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Join ``dim`` to ``facts`` on equally named columns.

    The dimension is broadcast once its row count has been checked; beyond the
    bound the rows are shuffled, with hot keys salted. Both ways compare keys in
    their common type, so the rows do not depend on the size of ``dim``.
    """
    if fits(dim, max_rows):
        facts, dim, keys = same_keys(facts, dim, on)
        return _plain(facts.join(F.broadcast(dim), keys, how), on, keys)
    return skew_join(facts, dim, on, how)


def hot_keys(df: DataFrame, on: list[str], partitions: int | None = None) -> dict[int, float]:
    """Hash and share of each key that would overfill one of ``partitions``.

    One pass with sketches of fixed size, merged in ``SKETCHES`` parallel groups;
    at most about ``1 / share`` numbers reach the driver. A sketch may overcount,
    which only salts more.
    """
    share = 1 / (partitions or cluster_width(df))
    most = int(1 / share) + 1
    sketch = F.expr(f"approx_top_k(key, {most}, {max(SKETCH_ITEMS, 4 * most)})").alias("top")
    keys = df.select(F.xxhash64(*on).alias("key"))
    found = keys.groupBy(F.pmod("key", F.lit(SKETCHES))).agg(F.count("*").alias("n"), sketch).collect()
    n = sum(g["n"] for g in found)
    return {i["item"]: i["count"] / n for g in found for i in g["top"] if i["count"] >= share * n}


def cluster_width(df: DataFrame) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2)


def skew_join(
    facts: DataFrame,
    dim: DataFrame,
    on: list[str],
    how: str = "inner",
    partitions: int | None = None,
    hot: dict[int, float] | None = None,
) -> DataFrame:
    """Shuffle join that spreads each hot key over several reducers.

    ``hot`` is the result of :func:`hot_keys`, found here when not given. A hot
    key is cut in proportion to its share of ``partitions`` (default: the
    session's shuffle partitions). Only ``dim`` rows under hot keys are
    repeated, about ``2 * partitions`` copies in all. The salt hashes whole
    rows, so a task that runs again salts alike; identical rows stay together,
    so remove duplicates first.
    """
    facts, dim, keys = same_keys(facts, dim, on)
    given, on = on, keys
    partitions = partitions or cluster_width(facts)
    if hot is None:
        hot = hot_keys(facts, on, partitions)
    if not hot:
        return _plain(facts.join(dim, on, how), given, on)
    pieces = pieces_of(on, hot, partitions)
    joined = salted(facts, pieces).join(copied(dim, pieces), [*on, "_salt"], how).drop("_salt")
    return _plain(joined, given, on)


def pieces_of(on: list[str], hot: dict[int, float], partitions: int) -> Column:
    """Into how many pieces a row's key is cut: a power of two, 1 unless it is hot."""
    by_pieces: dict[int, list[int]] = {}
    for key, share in hot.items():
        by_pieces.setdefault(2 ** math.ceil(math.log2(max(share * partitions, 2))), []).append(key)
    pieces = F.lit(1)
    for n, keys in by_pieces.items():
        pieces = F.when(F.xxhash64(*on).isin(keys), F.lit(n)).otherwise(pieces)
    return pieces


def salted(facts: DataFrame, pieces: Column) -> DataFrame:
    """Assign each row to one of its key's pieces by a hash of the whole row."""
    return facts.withColumn("_salt", F.pmod(F.xxhash64(*facts.columns), pieces).cast("int"))


def copied(dim: DataFrame, pieces: Column) -> DataFrame:
    """Repeat each row once for every piece of its key."""
    return dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), pieces - 1)))
