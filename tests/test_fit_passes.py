"""Model fits read what they repeat from persisted or staged rows."""

import numpy as np
import pytest

from delaylens.operators import features, models
from delaylens.plans import catalog
from pyspark.ml import Pipeline
from pyspark.ml.feature import PCA


def rows(spark, n=200):
    draw = np.random.default_rng(3).normal(size=(n, 3))
    made = [(i, *map(float, x), int(x[0] + x[1] > 0), i % 2, f"note {i}") for i, x in enumerate(draw)]
    return spark.createDataFrame(made, "k long, a double, b double, c double, y int, fold int, note string")


@pytest.fixture
def pca_inputs(monkeypatch):
    """Storage level and columns of what PCA is fitted on."""
    seen, fit = [], PCA.fit

    def watched(self, df, params=None):
        seen.append((df.storageLevel.useMemory, df.columns))
        return fit(self, df, params)

    monkeypatch.setattr(PCA, "fit", watched)
    return seen


def test_pca_is_fitted_on_persisted_vectors(spark, pca_inputs):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    features.pca(rows(spark), ["a", "b", "c"], k=2)
    assert pca_inputs == [(True, ["_raw"])]
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_stages_are_fitted_as_a_pipeline_fits_them(spark, pca_inputs):
    df, stages = rows(spark), models.with_pca(models.matrix_stages(["fold"], ["a", "b", "c"]), k=2)
    plain = Pipeline(stages=stages).fit(df).transform(df).select("k", "pca_features").orderBy("k").collect()
    assert models.fit_stages(stages, df).transform(df).select("k", "pca_features").orderBy("k").collect() == plain
    assert [held for held, _ in pca_inputs] == [False, True]


def test_balanced_rows_are_staged(spark):
    train, test = catalog.model_tables(spark, "/root/testdata/sf0.001")
    assert all("model-train" in f for f in train.inputFiles()) and train.inputFiles()
    assert all("model-table" in f for f in test.inputFiles())
