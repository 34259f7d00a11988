"""Plain measures from one scan, several histograms a scan, mergeable distinct counts."""

import pytest

from delaylens.operators import profile
from delaylens.plans import profiles
from pyspark.sql import functions as F


def table(spark, rows=400):
    return spark.range(rows).select(
        "id", (F.col("id") % 7).cast("double").alias("x"),
        F.when(F.col("id") % 5 > 0, F.when(F.col("id") % 11 == 0, F.lit(float("nan"))).otherwise(F.col("id") / 3)).alias("y"),
        F.when(F.col("id") % 4 > 0, (F.col("id") % 3 == 1).cast("int")).alias("flag"),
    )


def rows(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


@pytest.mark.parametrize("n", [0, 1, 400])
def test_summary_equals_the_single_profiles(spark, n):
    df = table(spark, n).withColumn("y", F.when(~F.isnan("y"), F.col("y")))
    summary = profile.Summary(df, ["x", "y"], ["flag"])
    assert rows(summary.shape()) == rows(profile.shape(df))
    assert rows(summary.missing()) == rows(profile.missing(df))
    assert summary.describe(["x", "y"]).collect() == profile.describe(df, ["x", "y"]).collect()
    assert rows(summary.null_count("y")) == rows(profile.null_count(df, "y"))
    assert rows(summary.flag_rate(["flag"])) == rows(profile.flag_rate(df, ["flag"]))


def test_histograms_equal_single_ones(spark):
    df = table(spark)
    summary = profile.Summary(df, ["x", "y"])
    found = profile.histograms(df, {"a": ("x", 7, *summary.range("x")), "b": ("y", 5, *summary.range("y")), "c": ("y", 3, 10, 50), "d": ("y", 2, None, None)})
    for name, args in {"a": ("x", 7), "b": ("y", 5), "c": ("y", 3, 10, 50), "d": ("y", 2, 0.0, 1.0)}.items():
        assert rows(found[name]) == rows(profile.histogram(df, *args))


def test_raw_profiles_read_flights_three_times(spark, tmp_path):
    flights = spark.range(300).select(
        F.lit("2015-01-02").alias("FL_DATE"), (F.col("id") % 12 + 1).cast("int").alias("MONTH"), (F.col("id") % 7 + 1).cast("int").alias("DAY_OF_WEEK"),
        F.when(F.col("id") % 9 > 0, F.col("id") % 40 - 5.0).alias("DEP_DELAY"), (F.col("id") % 30 + 0.0).alias("ARR_DELAY"),
        F.lit(0).alias("CANCELLED"), F.lit(1).alias("DIVERTED"),
    )
    weather = spark.range(90).select((F.col("id") % 8).cast("string").alias("STATION"), F.lit("0.5").alias("HourlyPrecipitation"), F.col("id").cast("string").alias("HourlyWindSpeed"))
    flights.write.parquet(f"{tmp_path}/flights")
    reads = spark.sparkContext.accumulator(0)

    def noted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    source = spark.read.parquet(f"{tmp_path}/flights")
    tables = profiles.raw_profiles(source.mapInArrow(noted, source.schema), weather, weather)
    got = {name: rows(t) for name, t in tables.items()}
    assert reads.value == 3 * 300
    assert got["arrival_delay_by_month"] == rows(profile.mean_by(flights, ["MONTH"], "ARR_DELAY"))
    assert got["delay_by_weekday"] == rows(profile.mean_by(flights, ["DAY_OF_WEEK"], "DEP_DELAY"))
    assert got["delay_histogram"] == rows(profile.histogram(flights, "DEP_DELAY", 50))
    assert got["late_flights"] == rows(profile.value_counts(flights.select((F.col("DEP_DELAY") > 15).alias("late")), "late"))
    assert got["rates"] == [("CANCELLED", 0.0), ("DIVERTED", 100.0)] and got["station_count"] == [(8,)]
    assert got["shape_flights"] == [(300, 7)] and sum(r[3] for r in got["histogram_HourlyWindSpeed"]) == 90


def test_sketches_merge_to_the_whole(spark):
    df = spark.range(60_000).select((F.col("id") % 3).alias("g"), (F.col("id") % 4).alias("year"), F.when(F.col("id") % 50 > 0, F.col("id") % 20_000).alias("v"))
    sketches = profile.distinct_sketches(df, ["g", "year"], "v")
    exact = {r["g"]: r["n"] for r in df.groupBy("g").agg(F.count_distinct("v").alias("n")).collect()}
    found = {r["g"]: r["ndv"] for r in profile.merged_ndv(sketches, ["g"]).collect()}
    assert found.keys() == exact.keys() and all(abs(found[g] / exact[g] - 1) < 0.05 for g in exact)
    wide = profile.merged_ndv(profile.distinct_sketches(df, ["year"], "v", lg=16), []).first()["ndv"]
    assert abs(wide / df.agg(F.count_distinct("v")).first()[0] - 1) < 0.015
    assert profile.merged_ndv(profile.distinct_sketches(df.limit(0), ["g"], "v"), ["g"]).count() == 0
