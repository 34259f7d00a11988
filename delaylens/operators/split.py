"""Temporal hold-out and cross-validation folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaylens.operators.sampling import hash_unit

Split = tuple[Column, Column]


def holdout(df: DataFrame, year: str, last: int) -> tuple[DataFrame, DataFrame]:
    """Train on the years before ``last``, test on ``last``."""
    return df.filter(F.col(year) < last), df.filter(F.col(year) == last)


def rolling_folds(df: DataFrame, year: str, first: int, last: int) -> DataFrame:
    """Fold ``k`` trains on ``first .. first+k-1`` and tests on ``first+k``.

    One row per fold a row belongs to, with ``fold`` and ``cv`` in {train, test}.
    """
    y, k = F.col(year), F.col("fold")
    inside = df.filter(y.between(first, last))
    folds = F.sequence(F.greatest(F.lit(1), y - first), F.lit(last - first))
    tagged = inside.withColumn("fold", F.explode(folds))
    return tagged.withColumn("cv", F.when(y == first + k, "test").otherwise("train"))


def yearly_folds(df: DataFrame, year: str, first: int, last: int) -> DataFrame:
    """Fold ``k`` trains on year ``first+k-1`` alone and tests on ``first+k``."""
    y, k = F.col(year), F.col("fold")
    folds = F.filter(F.array(y - first, y - first + 1), lambda f: f.between(1, last - first))
    tagged = df.filter(y.between(first, last)).withColumn("fold", F.explode(folds))
    return tagged.withColumn("cv", F.when(y == first + k, "test").otherwise("train"))


def random_folds(df: DataFrame, k: int, keys: list[str], seed: int = 0) -> DataFrame:
    """Add a random ``fold`` in ``0 .. k-1``, the same on every run."""
    return df.withColumn("fold", F.floor(hash_unit(keys, seed) * k).cast("int"))


def rolling_splits(year: str, first: int, last: int) -> list[Split]:
    """(train, test) filters of the rolling folds, for use on one cached table."""
    y = F.col(year)
    return [(y.between(first, t - 1), y == t) for t in range(first + 1, last + 1)]


def yearly_splits(year: str, first: int, last: int) -> list[Split]:
    y = F.col(year)
    return [(y == t - 1, y == t) for t in range(first + 1, last + 1)]


def random_splits(fold: str, k: int) -> list[Split]:
    return [(F.col(fold) != i, F.col(fold) == i) for i in range(k)]


def tagged_splits(fold: str, cv: str, folds: list[int], names: tuple[str, str] = ("train", "test")) -> list[Split]:
    """(train, test) filters of a table tagged with fold and role columns."""
    return [tuple((F.col(fold) == k) & (F.col(cv) == name) for name in names) for k in folds]
