"""Class balance and reproducible sampling.

A row is kept or dropped by a hash of its key columns, so the outcome does not
depend on partitioning, retries or row order. Rows that agree on the keys share
one outcome: sample after duplicates are removed, on columns that tell rows apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_unit(keys: list[str], seed: int = 0) -> Column:
    """Uniform number in [0, 1) from the md5 of the seed and the key columns."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def class_counts(df: DataFrame, *labels: str) -> DataFrame:
    return df.groupBy(*labels).agg(F.count("*").alias("n"))


def undersample(
    df: DataFrame, label: str, base: int, ratio: float, keys: list[str], seed: int = 0
) -> DataFrame:
    """All rows of class ``base`` and about ``ratio`` times as many others.

    Rows without a label are left out. If there are too few others, all stay.
    """
    is_base = F.col(label) == base
    n = df.agg(F.count_if(is_base).alias("base"), F.count_if(~is_base).alias("rest")).first()
    fraction = min(1.0, n["base"] * ratio / n["rest"]) if n["rest"] else 1.0
    return df.filter(is_base | (~is_base & (hash_unit(keys, seed) < fraction)))


def fraction(df: DataFrame, f: float, keys: list[str], seed: int = 81) -> DataFrame:
    """About the fraction ``f`` of the rows."""
    return df.filter(hash_unit(keys, seed) < f)
