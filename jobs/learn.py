"""spark-submit job: features to tuned models, predictions and metrics."""

from __future__ import annotations

import argparse
import json

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from delaylens import evaluate, io, models, schemas, split, tuning
from delaylens.operators.scaling import ZScore
from delaylens.plans import flights as flow
from delaylens.session import get_session

MODELS = ["LogisticRegression", "RandomForest", "BoostedTrees"]
CATEGORICAL = [*schemas.CATEGORICAL_FEATURES, "year", "year_order", "year_quarter"]
NUMERIC = [c + "_scaled" for c in schemas.NUMERIC_FEATURES]
FLAGS = ["quarter", "month", "day_of_week", "is_holiday", *schemas.SEASONS, *schemas.DAY_PARTS]


def plan(name: str):
    """Feature stages, estimator, parameter grid, evaluator and score column of a model."""
    if name == "BoostedTrees":
        stages = models.boosted_stages(FLAGS + NUMERIC)
        gbt = models.boosted_trees()
        return stages, gbt, tuning.boosted_grid(gbt), RegressionEvaluator(labelCol="delay_label", metricName="rmse")
    if name == "PenalisedTrees":
        assembler = VectorAssembler(inputCols=FLAGS + NUMERIC, outputCol="raw_features")
        trees = models.boosted_missing()
        return [assembler], trees, tuning.boosted_grid(trees), RegressionEvaluator(labelCol="delay_label", metricName="rmse")
    stages = models.with_pca(models.matrix_stages(CATEGORICAL, NUMERIC))
    if name == "RandomForest":
        rf = models.random_forest()
        return stages, rf, tuning.forest_grid(rf), BinaryClassificationEvaluator(labelCol="delay_label")
    lr = models.LogisticRegression(featuresCol="pca_features", labelCol="delay_label")
    return stages, lr, tuning.logistic_grid(lr), BinaryClassificationEvaluator(labelCol="delay_label")


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--base", required=True, help="folder with the staged tables")
    p.add_argument("--out", required=True, help="folder for splits, models and predictions")
    p.add_argument("--suffix", default="")
    p.add_argument("--dataset", choices=["prescaled", "scaled"], default="prescaled")
    p.add_argument("--model", choices=[*MODELS, "PenalisedTrees", "All"], default="All")
    p.add_argument("--first-year", type=int, default=2015)
    p.add_argument("--last-year", type=int, default=2021)
    p.add_argument("--sample", type=float, default=0.1, help="fraction of the training rows used for tuning")
    p.add_argument("--fit-on", choices=["fold", "train", "all"], default="fold")
    a = p.parse_args(argv)

    spark = get_session("delaylens-learn")
    if a.dataset == "prescaled":
        table = io.read_table(spark, a.base, "features", a.suffix)
        train, test = flow.train_and_test(table, a.last_year, fit_on=a.fit_on)
        train = io.save_split(train, f"{a.out}/train{a.suffix}")
        test = io.save_split(test, f"{a.out}/test{a.suffix}")
    else:
        train = io.read_table(spark, a.out, "train", a.suffix)
        test = io.read_table(spark, a.out, "test", a.suffix)
    splits = split.rolling_splits("year", a.first_year, a.last_year - 1)
    # rows that are not scaled yet are scaled and balanced by what each fold trains on
    inside = NUMERIC[0] not in train.columns
    first = [ZScore(inputCols=schemas.NUMERIC_FEATURES)] if inside else []

    for name in MODELS if a.model == "All" else [a.model]:
        stages, estimator, grid, evaluator = plan(name)
        model, tuned = tuning.tune_then_refit(
            estimator, grid, evaluator, train, splits, flow.SAMPLE_KEYS, a.sample,
            features=Pipeline(stages=[*first, *stages]), balance=flow.balanced if inside else None,
        )
        io.save_model(model, f"{a.out}/model_{name}{a.suffix}")
        scored = evaluate.round_prediction(model.transform(test))
        score = F.col("prediction") if name.endswith("Trees") else vector_to_array("probability")[1]
        kept = scored.select(*flow.SAMPLE_KEYS, "delay_label", score.alias("score"), "prediction", "pred_adjust")
        kept = io.save_split(kept, f"{a.out}/predictions_{name}{a.suffix}")
        roc = evaluate.roc(kept, "delay_label", "score")
        io.save_split(roc, f"{a.out}/roc_{name}{a.suffix}")
        metrics = {
            **evaluate.weighted(kept, "delay_label", "pred_adjust").first().asDict(),
            **evaluate.auc(kept, "delay_label", "score").first().asDict(),
            **evaluate.rmse(kept, "delay_label", "prediction").first().asDict(),
        }
        print(json.dumps({"model": name, "params": tuning.describe_params(tuned.best), **metrics}))


if __name__ == "__main__":
    main()
