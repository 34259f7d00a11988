"""Boosted trees on merged rows are those of MLlib on all rows."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor

from delaylens.operators import binning, models
from pyspark.sql import functions as F

COLUMNS = ["a", "b", "c"]


def rows(spark, n=12_000):
    """Few values of each feature, so that MLlib too finds all of them in its sample, and 20 rows of each kind."""
    kind = F.col("id") % (n // 20)
    draw = [F.pmod(F.xxhash64(kind, F.lit(c)), F.lit(v)).cast("double") / 4 for c, v in zip(COLUMNS, (30, 25, 2))]
    late = F.col("a") + 3 * F.col("c") + F.pmod(F.xxhash64("id"), F.lit(40)) / 8 > 7
    return spark.range(n).select("id", *[d.alias(c) for d, c in zip(draw, COLUMNS)]).withColumn("y", late.cast("int"))


def prepared(df):
    stages = models.fit_stages([*models.boosted_stages(COLUMNS)], df)
    return stages, stages.transform(df)


def test_merged_rows_give_the_trees_of_all_rows(spark, monkeypatch, tmp_path):
    stages, df = prepared(rows(spark).cache())
    seen, fit = [], GBTRegressor._fit

    def watched(self, df):
        seen.append(df.count())
        return fit(self, df)

    expected = GBTRegressor(labelCol="y", seed=7, maxDepth=3, maxIter=8).fit(df).transform(df)
    monkeypatch.setattr(GBTRegressor, "_fit", watched)
    model = models.boosted_trees("y", maxDepth=3, maxIter=8).fit(df)
    assert len(seen) == 1 and seen[0] <= 1200
    both = model.transform(df).select("id", F.col("prediction").alias("p")).join(expected.select("id", "prediction"), "id")
    assert both.agg(F.count("*"), F.max(F.abs(F.col("p") - F.col("prediction")))).first() == pytest.approx((12_000, 0), abs=1e-9)
    whole = PipelineModel(stages=[*stages.stages, model])
    whole.write().save(f"{tmp_path}/m")
    again = PipelineModel.load(f"{tmp_path}/m").transform(rows(spark)).agg(F.sum("prediction")).first()[0]
    assert again == pytest.approx(expected.agg(F.sum("prediction")).first()[0])


def test_small_tables_and_distinct_rows_are_left_to_mllib(spark):
    _, small = prepared(rows(spark, 2000))
    assert not isinstance(models.boosted_trees("y", maxIter=1).fit(small), PipelineModel)
    wide = spark.range(12_000).select(*[F.rand(j).alias(c) for j, c in enumerate(COLUMNS)], (F.col("id") % 2).alias("y"))
    _, distinct = prepared(wide)
    assert not isinstance(models.boosted_trees("y", maxDepth=2, maxIter=1).fit(distinct), PipelineModel)


def test_cut_places_are_halfway_and_even():
    values, counts = np.arange(6.0), np.array([1, 1, 1, 1, 1, 5])
    assert binning.cut_places(values, counts, 5) == [0.5, 1.5, 2.5, 3.5, 4.5]
    assert binning.cut_places(values, counts, 1) == [4.5]
    assert binning.cut_places(np.array([2.0]), np.array([9]), 3) == []


def test_bins_count_the_edges_below(spark):
    df = VectorAssembler(inputCols=["v", "w"], outputCol="x").transform(spark.createDataFrame([(float(v), 3.0) for v in range(5)], "v double, w double"))
    bins = binning.Bins()
    bins._set(inputCol="x", outputCol="b", edges=[[1.0, 2.5, 3.0], None])
    assert [list(r["b"]) for r in bins.transform(df).orderBy("v").collect()] == [[0.0, 3.0], [0.0, 3.0], [1.0, 3.0], [2.0, 3.0], [3.0, 3.0]]
