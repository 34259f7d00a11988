import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from delaylens import evaluate, io, models, sampling, split, tuning


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.range(4000).select(
        "id",
        (F.col("id") % 5 == 0).cast("int").alias("y"),
        (2015 + F.col("id") % 7).cast("int").alias("year"),
        ((F.col("id") * 37) % 101 / 10.0 + F.when(F.col("id") % 5 == 0, 4.0).otherwise(0.0)).alias("a"),
        F.concat(F.lit("c"), F.col("id") % 3).alias("c"),
    )


def test_undersample(labelled):
    kept = sampling.undersample(labelled, "y", 1, 1.0, ["id"])
    counts = dict(rows(sampling.class_counts(kept, "y")))
    assert counts[1] == 800 and 700 < counts[0] < 900
    again = sampling.undersample(labelled.repartition(7), "y", 1, 1.0, ["id"])
    assert rows(again.select("id")) == rows(kept.select("id"))
    other = sampling.undersample(labelled, "y", 1, 1.0, ["id"], seed=5)
    assert rows(other.select("id")) != rows(kept.select("id"))


def test_undersample_edges(spark):
    df = spark.createDataFrame([(i, 1) for i in range(9)] + [(9, 0), (10, None)], "id int, y int")
    assert sampling.undersample(df, "y", 1, 1.0, ["id"]).count() == 10
    only = df.filter("y = 1")
    assert sampling.undersample(only, "y", 1, 1.0, ["id"]).count() == 9


def test_fraction(labelled):
    kept = sampling.fraction(labelled, 0.1, ["id"])
    assert 320 < kept.count() < 480
    assert sampling.fraction(labelled, 1.0, ["id"]).count() == 4000


def test_holdout_and_folds(labelled):
    train, test = split.holdout(labelled, "year", 2021)
    assert train.agg(F.max("year")).first()[0] == 2020
    assert [r[0] for r in test.select("year").distinct().collect()] == [2021]
    for make, splits in (
        (split.rolling_folds, split.rolling_splits("year", 2015, 2020)),
        (split.yearly_folds, split.yearly_splits("year", 2015, 2020)),
    ):
        tagged = make(labelled, "year", 2015, 2020)
        spans = {
            (r["fold"], r["cv"]): (r["lo"], r["hi"])
            for r in tagged.groupBy("fold", "cv").agg(F.min("year").alias("lo"), F.max("year").alias("hi")).collect()
        }
        assert len(spans) == 10
        for k in range(1, 6):
            assert spans[(k, "test")] == (2015 + k, 2015 + k)
            first = 2015 if make is split.rolling_folds else 2014 + k
            assert spans[(k, "train")] == (first, 2014 + k)
            for (train_rows, test_rows), name in ((splits[k - 1], k),):
                assert rows(labelled.filter(train_rows).select("id")) == rows(
                    tagged.filter(f"fold = {k} and cv = 'train'").select("id")
                )
        by_tag = split.tagged_splits("fold", "cv", [1])[0]
        assert tagged.filter(by_tag[1]).count() == tagged.filter("fold = 1 and cv = 'test'").count()


def test_random_folds(labelled):
    folds = split.random_folds(labelled, 3, ["id"])
    sizes = [r["count"] for r in folds.groupBy("fold").count().collect()]
    assert len(sizes) == 3 and min(sizes) > 1200
    train, test = split.random_splits("fold", 3)[0]
    assert folds.filter(train).count() + folds.filter(test).count() == 4000


@pytest.fixture(scope="module")
def scores(spark):
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 500)
    s = np.round(np.clip(0.3 * y + rng.random(500) * 0.7, 0, 1), 2)
    return spark.createDataFrame([(int(a), float(b), float(b >= 0.5)) for a, b in zip(y, s)], "y int, s double, p double")


def test_metrics_match_mllib(scores):
    got = evaluate.weighted(scores, "y", "p").first()
    for name, metric in (("recall", "weightedRecall"), ("precision", "weightedPrecision"), ("f1", "f1"), ("accuracy", "accuracy")):
        want = MulticlassClassificationEvaluator(metricName=metric, labelCol="y", predictionCol="p").evaluate(
            scores.withColumn("y", F.col("y").cast("double"))
        )
        assert got[name] == pytest.approx(want)
    assert got["recall"] == pytest.approx(got["accuracy"]) and got["n"] == 500
    area = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="s", numBins=0).evaluate(scores)
    assert evaluate.auc(scores, "y", "s").first()[0] == pytest.approx(area)
    points = evaluate.roc(scores, "y", "s").orderBy("threshold").collect()
    assert points[0]["area"] == pytest.approx(area)
    wide = evaluate.roc(scores.withColumn("s", F.col("s") * 9 - 4), "y", "s").orderBy("threshold").collect()
    assert [(r["fpr"], r["tpr"]) for r in wide] == [(r["fpr"], r["tpr"]) for r in points]
    one = evaluate.roc(scores.filter("y = 1"), "y", "s").collect()
    assert all(r["fpr"] is None and r["area"] is None for r in one)
    assert (points[0]["fpr"], points[0]["tpr"]) == (1.0, 1.0)
    want = RegressionEvaluator(labelCol="y", predictionCol="s", metricName="rmse").evaluate(scores)
    assert evaluate.rmse(scores, "y", "s").first()[0] == pytest.approx(want)


@pytest.mark.parametrize(
    "data, area",
    [
        ([(0, 0.1), (1, 0.9)], 1.0),
        ([(1, 0.1), (0, 0.9)], 0.0),
        ([(1, 0.5), (0, 0.5)], 0.5),
        ([(1, 0.5), (1, 0.7)], None),
    ],
)
def test_auc_edges(spark, data, area):
    assert evaluate.auc(spark.createDataFrame(data, "y int, s double"), "y", "s").first()[0] == area


def test_never_predicted_class(spark):
    df = spark.createDataFrame([(0, 0.0), (1, 0.0)], "y int, p double")
    got = {r["class"]: tuple(r)[1:] for r in evaluate.per_class(df, "y", "p").collect()}
    assert got == {0.0: (1, 0.5, 1.0, 1, pytest.approx(2 / 3)), 1.0: (1, 0.0, 0.0, 0, 0.0)}


def test_round_prediction_and_impact(spark):
    df = spark.createDataFrame([(-0.7,), (0.5,), (0.49,), (1.9,)], "prediction double")
    assert [r[1] for r in evaluate.round_prediction(df).collect()] == [0.0, 1.0, 0.0, 1.0]
    assert [r[1] for r in evaluate.round_prediction(df, clip=False).collect()] == [-1.0, 1.0, 0.0, 2.0]
    metrics = spark.createDataFrame([(0.5, 0.4)], "recall double, precision double")
    assert tuple(evaluate.impact(metrics, 1000.0, 5000.0).first()) == (500.0, 200.0, 1000.0, 5.0)


def test_matrix_stages_keep_unseen_and_impute(spark):
    train = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("a", None)], "c string, x double")
    test = spark.createDataFrame([("zz", None)], "c string, x double")
    fitted = Pipeline(stages=models.matrix_stages(["c"], ["x"])).fit(train)
    assert fitted.transform(test).first()["features"].toArray().tolist() == [0.0, 0.0, 2.0]
    assert fitted.transform(train).first()["features"].toArray().tolist() == [1.0, 0.0, 1.0]


def test_pca_logistic_reads_components(labelled):
    model = models.pca_logistic(["a", "year"], "y", k=2).fit(labelled)
    assert model.stages[-1].getFeaturesCol() == "pca_features"
    assert model.stages[-1].numFeatures == 2


def test_label_is_not_flipped(labelled):
    common = labelled.withColumn("y", 1 - F.col("y"))
    model = models.logistic(["a"], "y", regParam=0.0).fit(common)
    got = evaluate.weighted(model.transform(common), "y", "prediction").first()
    assert got["accuracy"] > 0.75


def test_boosted_and_fit_cached(labelled):
    scored = models.boosted(["a"], "y", maxDepth=2, maxIter=3).fit(labelled).transform(labelled)
    base = labelled.agg(F.stddev_pop("y")).first()[0]
    assert evaluate.rmse(scored, "y", "prediction").first()[0] < base
    stages = models.with_pca(models.matrix_stages(["c"], ["a"]), k=2)
    forest = models.fit_cached(stages, models.random_forest("y", numTrees=3, maxDepth=3), labelled)
    assert forest.transform(labelled).count() == 4000


def test_fold_cv_and_refit(labelled, tmp_path):
    lr = models.LogisticRegression(featuresCol="features", labelCol="y", maxIter=5)
    grid = tuning.grid({lr.regParam: [0.01, 100.0], lr.elasticNetParam: [0.0, 1.0]})
    assert len(grid) == 4
    features = Pipeline(stages=[VectorAssembler(inputCols=["a"], outputCol="features")])
    splits = split.rolling_splits("year", 2015, 2020)
    evaluator = BinaryClassificationEvaluator(labelCol="y")
    model, found = tuning.tune_then_refit(
        lr, grid, evaluator, labelled, splits, ["id"], sample=0.5, features=features
    )
    assert found.scores.count() == 20
    averages = {r["params"]: r["score"] for r in found.average().collect()}
    assert max(averages.values()) == pytest.approx(found.best_score)
    assert found.best[lr.regParam] == 0.01
    assert not labelled.is_cached
    path = str(tmp_path / "model")
    io.save_model(model, path)
    loaded = io.load_model(path)
    first = rows(model.transform(labelled).select("id", "prediction"))
    assert rows(loaded.transform(labelled).select("id", "prediction")) == first
    plain = Pipeline(stages=[*features.getStages(), lr])
    io.save_model(plain, str(tmp_path / "plain"))
    assert len(io.load_model(str(tmp_path / "plain"), fitted=False).getStages()) == 2
