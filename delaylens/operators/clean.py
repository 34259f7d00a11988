"""Projection, renaming, casting, filling and duplicate removal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def project(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def cast_readings(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast text readings; what does not parse becomes null, also under ANSI."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def fill(df: DataFrame, value: float | str, subset: list[str] | None = None) -> DataFrame:
    """Replace nulls (and NaN) by a constant in columns of the constant's type."""
    return df.na.fill(value, subset=subset)


def require(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop rows that lack any of the required values."""
    return df.na.drop(subset=cols)


def dedup(df: DataFrame, keys: list[str] | None = None, order_by: list[str] | None = None) -> DataFrame:
    """Remove whole-row duplicates, or keep the first row per key along ``order_by``.

    Both forms combine on the map side, so a hot group of copies shrinks to one
    row per task before the shuffle.
    """
    if keys is None:
        return df.dropDuplicates()
    if not order_by:
        raise ValueError("order_by decides which row of a key is kept")
    kept = F.min_by(F.struct(*df.columns), F.struct(*order_by))
    return df.groupBy(*keys).agg(kept.alias("_row")).select("_row.*")
