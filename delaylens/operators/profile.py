"""Profiles: each is one aggregation, plus scalar or tiny follow-ups."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaylens.operators import ordered
from delaylens.operators.joins import lookup
from delaylens.session import checkpointed


def _invalid(df: DataFrame, c: str) -> Column:
    """Null, or NaN where the type has it."""
    null = F.col(c).isNull()
    if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        return null | F.isnan(c)
    return null


def _unpivot(one_row: DataFrame, names: list[str], fields: list[str], key: str) -> DataFrame:
    """Columns ``<field>__<i>`` of a single row to one row per name."""
    parts = ", ".join(
        "'" + n.replace("'", "''") + "', " + ", ".join(f"`{f}__{i}`" for f in fields) for i, n in enumerate(names)
    )
    return one_row.selectExpr(f"stack({len(names)}, {parts}) as (`{key}`, {', '.join(f'`{f}`' for f in fields)})")


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows")).withColumn("columns", F.lit(len(df.columns)).cast("long"))


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, mean, stddev, min and max per numeric column."""
    fields = {"count": F.count, "mean": F.avg, "stddev": F.stddev_samp, "min": F.min, "max": F.max}
    aggs = [
        (f(c) if name == "count" else f(F.col(c).cast("double"))).alias(f"{name}__{i}")
        for i, c in enumerate(cols)
        for name, f in fields.items()
    ]
    return _unpivot(df.agg(*aggs), cols, list(fields), "column")


def missing(df: DataFrame, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Number of null or NaN values per column."""
    cols = [c for c in df.columns if c not in exclude]
    counts = df.agg(*[F.count_if(_invalid(df, c)).alias(f"missing__{i}") for i, c in enumerate(cols)])
    return _unpivot(counts, cols, ["missing"], "column")


def null_count(df: DataFrame, c: str) -> DataFrame:
    return df.agg(F.count_if(F.col(c).isNull()).alias("nulls"))


def flag_rate(df: DataFrame, cols: list[str]) -> DataFrame:
    """Percentage of all rows in which each flag is 1."""
    rates = [
        (F.avg(F.when(F.col(c) == 1, 1.0).otherwise(0.0)) * 100).alias(f"percent__{i}") for i, c in enumerate(cols)
    ]
    return _unpivot(df.agg(*rates), cols, ["percent"], "flag")


def ndv(df: DataFrame, c: str, approximate: bool = False) -> DataFrame:
    return df.agg((F.approx_count_distinct(c) if approximate else F.count_distinct(c)).alias("ndv"))


def distinct_sketches(df: DataFrame, keys: list[str], c: str, lg: int = 12) -> DataFrame:
    """A sketch of the distinct values of ``c`` per ``keys``, of at most about ``2 ** lg`` bytes each.

    Sketches are staged once and merged over any of their keys later, without the rows.
    Estimates are off by about ``1.04 / sqrt(2 ** lg)``, 1.6 % by default; nulls do not count.
    """
    return df.groupBy(*keys).agg(F.hll_sketch_agg(c, lg).alias("sketch"))


def merged_ndv(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Estimated number of distinct values per ``keys`` over all ``sketches``."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("ndv"))


def value_counts(df: DataFrame, c: str) -> DataFrame:
    return df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("n"))


def mean_by(df: DataFrame, keys: list[str], v: str, out: str = "mean") -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(v).alias(out))


def top_k(df: DataFrame, by: list[Column], k: int = 10) -> DataFrame:
    """First ``k`` rows along ``by``; each task keeps only its own ``k``."""
    return df.orderBy(*by).limit(k)


def rank_by(df: DataFrame, order: list[Column | str], out: str = "rank") -> DataFrame:
    return ordered.rank_by(df, order, out)


def delays_by_airport(
    df: DataFrame, airport: str = "airport_iata", rank: str = "dep_rank", label: str = "delay_label"
) -> DataFrame:
    """Delayed departures per airport, with the airport's place by score."""
    totals = df.groupBy(airport, rank).agg(F.sum(label).alias("delays"))
    return rank_by(totals, [F.col(rank).desc(), airport])


def histogram(df: DataFrame, c: str, bins: int, lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Counts in ``bins`` equal intervals; the last includes its upper end.

    Without a range, the minimum and maximum are used. Values outside are left out.
    """
    value = F.col(c).cast("double")
    valid = df.select(value.alias("x")).filter(F.col("x").isNotNull() & ~F.isnan("x"))
    if lo is None or hi is None:
        seen = valid.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).first()
        lo = seen["lo"] if lo is None else lo
        hi = seen["hi"] if hi is None else hi
    if lo is None or hi is None:
        lo, hi = 0.0, 1.0
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    lo, hi = float(lo), float(hi)
    width = (hi - lo) / bins
    slot = F.least(F.floor((F.col("x") - lo) / width), F.lit(bins - 1)).cast("long")
    counts = valid.filter(F.col("x").between(lo, hi)).groupBy(slot.alias("bin")).agg(F.count("*").alias("n"))
    every = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return every.join(counts, "bin", "left").select(
        "bin",
        (F.col("bin") * width + lo).alias("left_edge"),
        ((F.col("bin") + 1) * width + lo).alias("right_edge"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def histograms(df: DataFrame, wanted: dict[str, tuple[str, int, float | None, float | None]]) -> dict[str, DataFrame]:
    """Several histograms (column, bins, lowest, highest) as tables like :func:`histogram`, from one scan.

    Every row gives one (histogram, bin) for each histogram it falls into; they are counted
    on the map side. Without a lowest and highest value the column's own are needed, such
    as from :func:`summary`; where these are null the range is 0 to 1.
    """
    edges = {}
    for name, (_, bins, lo, hi) in wanted.items():
        lo, hi = (0.0, 1.0) if lo is None or hi is None else (float(lo), float(hi))
        lo, hi = (lo - 0.5, hi + 0.5) if lo == hi else (lo, hi)
        edges[name] = (lo, hi, (hi - lo) / bins)

    def slot(name: str) -> Column:
        c, bins = wanted[name][:2]
        lo, hi, width = edges[name]
        x = F.col(c).try_cast("double")
        inside = x.between(lo, hi) & ~F.isnan(x)
        return F.when(inside, F.least(F.floor((x - lo) / width), F.lit(bins - 1)).cast("long"))

    slots = F.array(*[F.struct(F.lit(name).alias("name"), slot(name).alias("bin")) for name in wanted])
    counts = df.select(F.inline(slots)).filter(F.col("bin").isNotNull()).groupBy("name", "bin").agg(F.count("*").alias("n"))
    counts = checkpointed(counts)
    tables = {}
    for name, (_, bins, _, _) in wanted.items():
        lo, _, width = edges[name]
        every = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
        tables[name] = every.join(counts.filter(F.col("name") == name).drop("name"), "bin", "left").select(
            "bin",
            (F.col("bin") * width + lo).alias("left_edge"),
            ((F.col("bin") + 1) * width + lo).alias("right_edge"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
    return tables


class Summary:
    """Size, missing values, moments, ranges and flag rates of a table, from one scan for all of them.

    The scan runs when the first of the tables below is asked for. Every measure is a sum on
    the map side, so one row per task is all that moves.
    """

    def __init__(self, df: DataFrame, numbers: list[str] | None = None, flags: list[str] | None = None) -> None:
        self.columns, self.numbers, self.flags = df.columns, numbers or [], flags or []
        self.df = df
        aggs = [F.count("*").alias("rows")]
        aggs += [F.count_if(_invalid(df, c)).alias(f"missing_{c}") for c in df.columns]
        aggs += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in self.numbers]
        for c in self.numbers:
            x = F.col(c).try_cast("double")
            known = F.when(~F.isnan(x), x)
            aggs += [f(x).alias(f"{n}_{c}") for n, f in (("mean", F.avg), ("stddev", F.stddev_samp), ("min", F.min), ("max", F.max))]
            aggs += [F.count(c).alias(f"count_{c}"), F.min(known).alias(f"lo_{c}"), F.max(known).alias(f"hi_{c}")]
        aggs += [F.sum(F.when(F.col(c) == 1, 1).otherwise(0)).alias(f"flag_{c}") for c in self.flags]
        self.aggs = aggs

    @cached_property
    def found(self) -> dict[str, object]:
        return self.df.agg(*self.aggs).first().asDict()

    def _table(self, rows: list[tuple], schema: str) -> DataFrame:
        return self.df.sparkSession.createDataFrame(rows, schema)

    def shape(self) -> DataFrame:
        return self._table([(self.found["rows"], len(self.columns))], "rows long, columns long")

    def missing(self) -> DataFrame:
        return self._table([(c, self.found[f"missing_{c}"]) for c in self.columns], "column string, missing long")

    def null_count(self, c: str) -> DataFrame:
        return self._table([(self.found[f"null_{c}"],)], "nulls long")

    def describe(self, cols: list[str]) -> DataFrame:
        fields = ("count", "mean", "stddev", "min", "max")
        rows = [(c, *[self.found[f"{f}_{c}"] for f in fields]) for c in cols]
        return self._table(rows, "column string, count long, mean double, stddev double, min double, max double")

    def flag_rate(self, cols: list[str]) -> DataFrame:
        n = self.found["rows"]
        return self._table([(c, 100.0 * self.found[f"flag_{c}"] / n if n else None) for c in cols], "flag string, percent double")

    def range(self, c: str) -> tuple[float | None, float | None]:
        """Lowest and highest valid value, for :func:`histograms`."""
        return self.found[f"lo_{c}"], self.found[f"hi_{c}"]


def box_stats(df: DataFrame, c: str, by: str | None = None) -> DataFrame:
    """Exact quartiles, whisker ends within 1.5 IQR and the number of outliers.

    Everything follows from the counted distinct values, so ``df`` is read once.
    """
    key = by or "_all"
    counted = ordered.counted_values(df if by else df.withColumn(key, F.lit(0)), c, key)
    quarts = ordered.quantiles(counted, [0.25, 0.5, 0.75], key).toDF(key, "total", "q1", "median", "q3")
    iqr = F.col("q3") - F.col("q1")
    quarts = checkpointed(quarts.withColumns({"_low": F.col("q1") - 1.5 * iqr, "_high": F.col("q3") + 1.5 * iqr}))
    inside = F.col("x").between(F.col("_low"), F.col("_high"))
    stats = lookup(counted.select(key, "x", "n"), quarts, [key]).groupBy(key).agg(
        F.max("total").alias("n"),
        *[F.max(k).alias(k) for k in ("q1", "median", "q3")],
        F.min("x").alias("min"),
        F.max("x").alias("max"),
        F.min(F.when(inside, F.col("x"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("x"))).alias("whisker_high"),
        F.sum(F.when(~inside, F.col("n")).otherwise(0)).alias("outliers"),
    )
    return stats if by else stats.drop(key)


def label_by_flag(df: DataFrame, flags: list[str], label: str) -> DataFrame:
    """Rows per label among those where each flag is 1."""
    counts = df.groupBy(label).agg(*[F.count_if(F.col(f) == 1).alias(f) for f in flags])
    return counts.unpivot([label], flags, "flag", "n").filter(F.col("n") > 0)


def correlation(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlations in long form; rows with an invalid value are skipped.

    One aggregation: Spark merges means and co-moments, which stay accurate without a pass
    for the means before, so ``df`` is read once.
    """
    names = [f"v{i}" for i in range(len(cols))]
    valid = df.select(*[F.col(c).cast("double").alias(v) for c, v in zip(cols, names)]).na.drop()
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    spreads = valid.agg(*[F.covar_pop(names[i], names[j]).alias(f"c{i}_{j}") for i, j in pairs])
    corr = [
        F.when((F.col(f"c{i}_{i}") > 0) & (F.col(f"c{j}_{j}") > 0),
               F.col(f"c{i}_{j}") / F.sqrt(F.col(f"c{i}_{i}")) / F.sqrt(F.col(f"c{j}_{j}"))).alias(f"r{i}_{j}")
        for i, j in pairs
    ]
    parts = ", ".join(
        f"'{cols[i]}', '{cols[j]}', r{min(i, j)}_{max(i, j)}" for i in range(len(cols)) for j in range(len(cols))
    )
    return spreads.select(*corr).selectExpr(f"stack({len(cols) ** 2}, {parts}) as (col_a, col_b, corr)")
