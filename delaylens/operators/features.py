"""Labels, calendar and site features, scaling and feature selection."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.feature import PCA, PCAModel, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylens.operators.joins import lookup
from delaylens.operators.scaling import ZScore

# Months of the seasons and hours of the parts of the day.
SEASON_MONTHS = {"spring": [3, 4, 5], "summer": [6, 7, 8], "fall": [9, 10, 11], "winter": [12, 1, 2]}
DAY_PART_HOURS = {
    "early_morning": [5, 6, 7],
    "morning": [8, 9, 10, 11],
    "afternoon": [12, 13, 14, 15, 16],
    "evening": [17, 18, 19, 20],
    "night": [21, 22, 23, 0, 1, 2, 3, 4],
}
COMPAT_NIGHT_HOURS = [12, 22, 23, 24, 1, 2, 3, 4]


def _flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it is false or null."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def _date(c: str) -> Column:
    return F.substring(F.col(c).cast("string"), 1, 10).try_cast("date")


def delay_label(
    df: DataFrame,
    actual: str,
    delay: str,
    minutes: float = 15,
    inclusive: bool = False,
    cancelled_is_delay: bool = True,
    out: str = "delay_label",
) -> DataFrame:
    """1 when the delay exceeds ``minutes`` or, by default, there was no departure."""
    late = F.col(delay) >= minutes if inclusive else F.col(delay) > minutes
    return df.withColumn(out, _flag(F.col(actual).isNull() | late if cancelled_is_delay else late))


def month_day(date: str) -> Column:
    """Month and day without padding, such as ``7-4``."""
    day = _date(date)
    return F.concat_ws("-", F.month(day).cast("string"), F.dayofmonth(day).cast("string"))


def fixed_holiday(df: DataFrame, date: str, days: list[str], out: str = "holiday") -> DataFrame:
    """Flag dates whose month and day are in a fixed list."""
    return df.withColumn(out, _flag(month_day(date).isin(days)))


def pad_holidays(holidays: DataFrame, pad: int = 1, date: str = "date") -> DataFrame:
    """Distinct holiday dates together with the ``pad`` days before and after."""
    day = _date(date)
    around = F.sequence(F.date_sub(day, pad), F.date_add(day, pad))
    return holidays.filter(day.isNotNull()).select(F.explode(around).alias("date")).distinct()


def holiday_flag(
    df: DataFrame, date_col: str, holidays: DataFrame, pad: int = 1, date: str = "date", out: str = "is_holiday"
) -> DataFrame:
    """1 within ``pad`` days of a holiday, else 0; the row count never changes."""
    days = pad_holidays(holidays, pad, date).select(F.col("date").alias("_day"), F.lit(1).alias(out))
    joined = lookup(df.withColumn("_day", _date(date_col)), days, ["_day"], "left")
    return joined.withColumn(out, F.coalesce(out, F.lit(0))).drop("_day").select(*df.columns, out)


def seasons(df: DataFrame, month: str) -> DataFrame:
    return df.withColumns({s: _flag(F.col(month).isin(m)) for s, m in SEASON_MONTHS.items()})


def day_parts(df: DataFrame, hour: str, compat_night: bool = False) -> DataFrame:
    """Part-of-day dummies. ``compat_night`` counts noon, not 21 or 0, as night."""
    hours = {**DAY_PART_HOURS, "night": COMPAT_NIGHT_HOURS} if compat_night else DAY_PART_HOURS
    return df.withColumns({part: _flag(F.col(hour).isin(h)) for part, h in hours.items()})


def member_flag(df: DataFrame, c: str, values: list, out: str = "busy_airport") -> DataFrame:
    return df.withColumn(out, _flag(F.col(c).isin(values)))


def tail_key(df: DataFrame, date: str, tail: str, out: str = "tail_key") -> DataFrame:
    """Date and tail number; a missing part is left out."""
    return df.withColumn(out, F.concat_ws(" ", F.col(date).cast("string"), F.col(tail).cast("string")))


def year_of(c: str) -> Column:
    """Year of an ISO date text, a date or a timestamp."""
    return F.year(_date(c))


def period_keys(df: DataFrame, ts: str, quarter: str, base_year: int = 2015) -> DataFrame:
    """``year``, years since ``base_year`` and year followed by quarter."""
    year = year_of(ts)
    return df.withColumns(
        {"year": year, "year_order": year - base_year, "year_quarter": year * 10 + F.col(quarter)}
    )


def add_rank(df: DataFrame, ranks: DataFrame, key: str = "airport_iata", node: str = "dep_iata") -> DataFrame:
    """Left join of site scores (``node``, ``dep_rank``)."""
    return lookup(df, ranks.withColumnRenamed(node, key), [key], "left")


def zscore(
    train: DataFrame, dfs: list[DataFrame], cols: list[str], ndigits: int | None = 2, suffix: str = "_scaled"
) -> list[DataFrame]:
    """Standardise with the mean and sample deviation of ``train``.

    One aggregation fits all columns. Each ``c`` is replaced by ``c_scaled``;
    a constant column becomes 0.
    """
    model = ZScore(inputCols=cols, digits=-1 if ndigits is None else ndigits, suffix=suffix).fit(train)
    return [model.transform(df) for df in dfs]


def fit_pca(estimator: PCA, df: DataFrame) -> PCAModel:
    """Fit on the persisted vectors: the fit reads them several times, in part with few tasks."""
    vectors = df.select(estimator.getInputCol()).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return estimator.fit(vectors)
    finally:
        vectors.unpersist()


def pca(df: DataFrame, cols: list[str], k: int = 5, out: str = "pca_features") -> tuple[DataFrame, PCAModel]:
    """First ``k`` principal components; rows with missing values are skipped."""
    vectors = VectorAssembler(inputCols=cols, outputCol="_raw", handleInvalid="skip").transform(df)
    model = fit_pca(PCA(k=k, inputCol="_raw", outputCol=out), vectors)
    return model.transform(vectors).drop("_raw"), model


def guard(cols: list[str], banned: list[str]) -> list[str]:
    """Return ``cols``, or fail if one of them is not known at prediction time."""
    leaks = [c for c in cols for b in banned if c == b or c.startswith(b + "_")]
    if leaks:
        raise ValueError(f"not known at prediction time: {sorted(set(leaks))}")
    return cols


def drop_correlated(df: DataFrame, cols: list[str], threshold: float = 0.95) -> list[str]:
    """Keep columns in order, leaving out those that repeat one already kept."""
    from delaylens.operators.profile import correlation

    strength = {(r["col_a"], r["col_b"]): r["corr"] for r in correlation(df, cols).collect()}
    kept: list[str] = []
    for c in cols:
        if all(abs(strength[(k, c)] or 0.0) < threshold for k in kept):
            kept.append(c)
    return kept


def holidays_between(spark: SparkSession, first_year: int, last_year: int, days: list[tuple[int, int]]) -> DataFrame:
    """Holiday table with the given (month, day) pairs in every year."""
    years = spark.range(first_year, last_year + 1).withColumn("year", F.col("id").cast("int"))
    dates = F.array(*[F.make_date("year", F.lit(m), F.lit(d)) for m, d in days])
    return years.select(F.explode(dates).alias("date"))
