"""Distributed boosting against a trainer written as plain loops."""

import math

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors

from delaylens.operators import boosting, tuning
from delaylens.operators.boosting import HistogramBoosting

PARAMS = {"maxIter": 4, "maxDepth": 3, "stepSize": 0.3, "alpha": 0.2, "lam": 0.5, "gamma": 0.4, "bins": 12}


def numbers(n=400, seed=3):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, 4))
    x[draw.random((n, 4)) < 0.15] = 0.0
    x[::17, 1] = np.nan
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] == 0) | (draw.random(n) < 0.1)).astype(float)
    return x, y


def table(spark, x, y):
    rows = [(i, Vectors.dense(v), float(t)) for i, (v, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, ["i", "features", "label"]).repartition(3)


def plain_tree(x, g, h, edges, p, depth):
    """A tree as nested tuples: a number, or (feature, cut, missing left, left, right, gain)."""

    def score(rows):
        total = sum(g[i] for i in rows)
        return max(abs(total) - p["alpha"], 0) ** 2 / (sum(h[i] for i in rows) + p["lam"])

    def leaf(rows):
        total = sum(g[i] for i in rows)
        return -p["stepSize"] * math.copysign(max(abs(total) - p["alpha"], 0), total) / (sum(h[i] for i in rows) + p["lam"])

    def grow(rows, depth):
        best = (1e-6, None)
        for f in range(x.shape[1]) if depth else []:
            for goes_left in (False, True):
                for cut in edges[f]:
                    gone = {i for i in rows if math.isnan(x[i, f]) or x[i, f] == 0}
                    left = [i for i in rows if (goes_left if i in gone else x[i, f] <= cut)]
                    right = [i for i in rows if i not in set(left)]
                    if sum(h[i] for i in left) < 1 or sum(h[i] for i in right) < 1:
                        continue
                    gain = score(left) + score(right) - score(rows)
                    if gain > best[0] + 1e-9:
                        best = (gain, (f, cut, goes_left, left, right))
        if best[1] is None:
            return leaf(rows)
        f, cut, goes_left, left, right = best[1]
        a, b = grow(left, depth - 1), grow(right, depth - 1)
        if not isinstance(a, tuple) and not isinstance(b, tuple) and best[0] < p["gamma"]:
            return leaf(rows)
        return f, cut, goes_left, a, b

    return grow(list(range(len(x))), depth)


def plain_value(tree, v):
    while isinstance(tree, tuple):
        f, cut, goes_left, a, b = tree
        gone = math.isnan(v[f]) or v[f] == 0
        tree = a if (goes_left if gone else v[f] <= cut) else b
    return tree


def plain_margins(x, y, edges, p, logistic):
    margin = np.full(len(x), 0.5)
    for _ in range(p["maxIter"]):
        prob = 1 / (1 + np.exp(-margin))
        g, h = (prob - y, prob * (1 - prob)) if logistic else (margin - y, np.ones(len(x)))
        tree = plain_tree(x, g, h, edges, p, p["maxDepth"])
        margin = margin + [plain_value(tree, v) for v in x]
    return 1 / (1 + np.exp(-margin)) if logistic else margin


@pytest.mark.parametrize("objective", ["squared", "logistic"])
def test_equals_plain_loops(spark, objective):
    x, y = numbers(160)
    df = table(spark, x, y)
    estimator = HistogramBoosting(objective=objective, **PARAMS)
    rows = df.select(boosting.vector_to_array("features").alias("x"))
    expected = plain_margins(x, y, estimator.edges(rows, 4), PARAMS, objective == "logistic")
    found = {r["i"]: r["prediction"] for r in estimator.fit(df).transform(df).collect()}
    assert np.allclose([found[i] for i in range(len(x))], expected, atol=1e-9)


def test_partitions_do_not_matter(spark):
    x, y = numbers()
    df = table(spark, x, y)
    one, two = (HistogramBoosting(**PARAMS).fit(d).transform(df).orderBy("i").collect() for d in (df, df.repartition(7)))
    assert np.allclose([r["prediction"] for r in one], [r["prediction"] for r in two])


def test_missing_direction_is_learned(spark):
    # only the missing values are positive: one cut parts them from all others
    x = np.array([[0.0], [1.0], [2.0], [-1.0]] * 30)
    df = table(spark, x, x[:, 0] == 0)
    found = HistogramBoosting(maxIter=1, maxDepth=1, stepSize=1.0, alpha=0.0, lam=0.0, gamma=0.0).fit(df).transform(df)
    assert {(r["features"][0], round(r["prediction"], 6)) for r in found.collect()} == {(0, 1), (1, 0), (2, 0), (-1, 0)}


def test_gamma_prunes_and_penalties_shrink(spark):
    x, y = numbers()
    df = table(spark, x, y)

    def spread(**params):
        found = HistogramBoosting(**{**PARAMS, **params}).fit(df).transform(df).toPandas()["prediction"]
        return found.nunique(), found.std()

    assert spread(gamma=1e9)[0] == 1
    assert spread(alpha=5.0)[1] < spread(alpha=0.0)[1]
    assert spread(lam=500.0)[1] < spread(lam=0.0)[1]


def test_learns_and_serves_in_pipelines_grids_and_files(spark, tmp_path):
    x, y = numbers()
    df = spark.createDataFrame([(*map(float, v), float(t), i % 2) for i, (v, t) in enumerate(zip(x, y))], ["a", "b", "c", "d", "label", "fold"])
    stages = [VectorAssembler(inputCols=list("abcd"), outputCol="features", handleInvalid="keep")]
    estimator = HistogramBoosting(**PARAMS)
    model = Pipeline(stages=[*stages, estimator]).fit(df)
    scored = model.transform(df)
    rmse = RegressionEvaluator(labelCol="label", metricName="rmse").evaluate(scored)
    assert rmse < 0.95 * RegressionEvaluator(labelCol="label", predictionCol="half").setMetricName("rmse").evaluate(scored.selectExpr("label", "0.5D AS half"))
    model.write().save(f"{tmp_path}/model")
    again = PipelineModel.load(f"{tmp_path}/model").transform(df)
    assert again.select("prediction").collect() == scored.select("prediction").collect()
    found = tuning.fold_cv(
        estimator, tuning.grid({estimator.maxDepth: [1, 2], estimator.maxIter: [2]}), RegressionEvaluator(labelCol="label"),
        df, [(df["fold"] == 0, df["fold"] == 1)], features=Pipeline(stages=stages),
    )
    assert found.scores.count() == 2


def test_odd_tables(spark):
    x, y = numbers(30)
    df = table(spark, x, y)
    unlabelled = df.withColumn("label", boosting.F.when(boosting.F.col("i") > 0, boosting.F.col("label")))
    assert HistogramBoosting(maxIter=1).fit(unlabelled).transform(df).count() == 30
    empty = HistogramBoosting(maxIter=2).fit(df.limit(0)).transform(df)
    assert {r["prediction"] for r in empty.collect()} == {0.5}
    constant = table(spark, np.ones((20, 2)), np.ones(20))
    found = HistogramBoosting(maxIter=1, stepSize=1.0, alpha=0.0, lam=0.0).fit(constant).transform(constant)
    assert {r["prediction"] for r in found.collect()} == {1.0}
    mixed = spark.createDataFrame([(Vectors.dense([1.0]), 1.0), (Vectors.dense([1.0, 2.0]), 0.0)], ["features", "label"])
    with pytest.raises(ValueError, match="1 to 2 long"):
        HistogramBoosting().fit(mixed)


def test_rows_are_kept_in_blocks_and_walk_like_single_ones():
    draw = np.random.default_rng(5)
    x = draw.integers(0, 4, (50, 2)).astype(float)
    edges = [[1.0, 2.0, math.inf], [2.0, math.inf]]
    gone = boosting.gone_bin(edges)
    batch = boosting.pa.record_batch({"x": boosting.pa.array(x.tolist()), "label": boosting.pa.array(x[:, 0])})
    held = list(boosting._bin_rows(edges, 0.0, 0.5, gone)([batch]))
    assert [b.num_rows for b in held] == [1]
    bins, label, margin = next(boosting.blocks_of(held, 2))
    assert bins.shape == (2, 50) and label.tolist() == x[:, 0].tolist() and set(margin) == {0.5}
    tree = boosting.Tree([0, -1, 1, -1, -1], [1, 0, 0, 0, 0], [2.0, 0, 2.0, 0, 0], [False, False, True, False, False],
                         [1, 1, 3, 3, 4], [2, 1, 4, 3, 4], [1.0] * 5, [0.0] * 5)
    assert boosting.BinWalk(tree, gone).leaves(bins).tolist() == tree.walk(x, x == 0, "cut").tolist()
