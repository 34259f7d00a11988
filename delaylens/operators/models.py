"""Feature stages and estimators, as MLlib pipelines."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import PCA, Imputer, OneHotEncoder, StringIndexer, VectorAssembler, VectorIndexer
from pyspark.sql import DataFrame

from delaylens.operators.binning import MergedGBTRegressor
from delaylens.operators.boosting import HistogramBoosting
from delaylens.operators.features import fit_pca

PipelineStage = Estimator | Transformer


def fit_cached(stages: list[PipelineStage], estimator: Estimator, train: DataFrame) -> PipelineModel:
    """Fit the feature stages, then the estimator on their persisted output.

    Tree and iterative estimators read their input many times; this way the
    feature stages run once.
    """
    columns, label = [estimator.getFeaturesCol(), estimator.getLabelCol()], estimator.getLabelCol()
    # a PCA at the end reads its input several times too: what comes before it also runs once
    last = stages[-1:] if stages and isinstance(stages[-1], PCA) else []
    prepared = fit_stages(stages[: len(stages) - len(last)], train)
    inputs = [last[0].getInputCol(), label] if last else columns
    held = [prepared.transform(train).select(*inputs).persist(StorageLevel.MEMORY_AND_DISK)]
    try:
        reduced = Pipeline(stages=last).fit(held[0])
        if last:
            held.append(reduced.transform(held[0]).select(*columns).persist(StorageLevel.MEMORY_AND_DISK))
        return PipelineModel(stages=[*prepared.stages, *reduced.stages, estimator.fit(held[-1])])
    finally:
        for d in held:
            d.unpersist()


def fit_stages(stages: list[PipelineStage], train: DataFrame) -> PipelineModel:
    """What ``Pipeline.fit`` gives; the vectors of a PCA are persisted while it is fitted."""
    fitted: list[Transformer] = []
    for stage in stages:
        if isinstance(stage, PCA):
            stage = fit_pca(stage, train)
        elif isinstance(stage, Estimator):
            stage = stage.fit(train)
        train = stage.transform(train)
        fitted.append(stage)
    return PipelineModel(stages=fitted)


def matrix_stages(categoricals: list[str], numerics: list[str], out: str = "features") -> list[PipelineStage]:
    """Index, one-hot encode, impute and assemble.

    All categorical columns share one indexer and one encoder, so fitting reads
    the data once for them. The 0/1 label is used as it is, never indexed.
    """
    stages: list[PipelineStage] = []
    if categoricals:
        indexed = [c + "_idx" for c in categoricals]
        stages.append(StringIndexer(inputCols=categoricals, outputCols=indexed, handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=[c + "_class" for c in categoricals]))
    imputed = [c + "_imputed" for c in numerics]
    if numerics:
        stages.append(Imputer(inputCols=numerics, outputCols=imputed))
    inputs = [c + "_class" for c in categoricals] + imputed
    return [*stages, VectorAssembler(inputCols=inputs, outputCol=out)]


def with_pca(stages: list[PipelineStage], k: int = 5) -> list[PipelineStage]:
    return [*stages, PCA(k=k, inputCol="features", outputCol="pca_features")]


def logistic(features: list[str], label: str = "delay_label", **params) -> Pipeline:
    """Ridge logistic regression on assembled numeric columns."""
    lr = LogisticRegression(featuresCol="features", labelCol=label, **{"regParam": 1.0, **params})
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features"), lr])


def pca_logistic(features: list[str], label: str = "delay_label", k: int = 5, **params) -> Pipeline:
    """Logistic regression that really reads the principal components."""
    assembler = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="skip")
    lr = LogisticRegression(
        featuresCol="pca_features", labelCol=label, **{"maxIter": 10, "regParam": 0.3, **params}
    )
    return Pipeline(stages=[*with_pca([assembler], k), lr])


def random_forest(label: str = "delay_label", features: str = "pca_features", **params) -> RandomForestClassifier:
    settings = {"numTrees": 40, "maxDepth": 5, "featureSubsetStrategy": "sqrt", "bootstrap": True, "seed": 7}
    return RandomForestClassifier(labelCol=label, featuresCol=features, **{**settings, **params})


def boosted_stages(features: list[str]) -> list[PipelineStage]:
    """Assemble, with low-cardinality slots as categories."""
    assembler = VectorAssembler(inputCols=features, outputCol="raw_features")
    return [assembler, VectorIndexer(inputCol="raw_features", outputCol="features", handleInvalid="keep")]


def boosted_trees(label: str = "delay_label", features: str = "features", **params) -> MergedGBTRegressor:
    settings = {"maxDepth": 5, "maxIter": 10, "seed": 7}
    return MergedGBTRegressor(labelCol=label, featuresCol=features, **{**settings, **params})


def boosted_missing(label: str = "delay_label", features: str = "raw_features", **params) -> HistogramBoosting:
    """Boosted trees that take 0.0 for missing and learn where it goes; depth 6, 50 trees and their penalties."""
    return HistogramBoosting(labelCol=label, featuresCol=features, **params)


def boosted(features: list[str], label: str = "delay_label", **params) -> Pipeline:
    """Boosted trees regressing the 0/1 label, low-cardinality slots as categories."""
    return Pipeline(stages=[*boosted_stages(features), boosted_trees(label, **params)])
