"""Checks of fitted models against their own definition, each one aggregation over the rows."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import PCAModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.operators.profile import correlation


def logistic_gradient(
    scored: DataFrame, model: LogisticRegressionModel, names: list[str], label: str = "delay_label"
) -> DataFrame:
    """Gradient of the penalised log loss at the fitted coefficients: (term, gradient), each per deviation of its feature.

    ``scored`` holds the training rows with ``features`` and ``probability``. The penalty is
    the ridge one on standardised coefficients, so at the optimum every gradient is 0, the
    intercept's too. Features without spread have no gradient. An empty table gives nulls.
    """
    x, p = vector_to_array("features"), vector_to_array("probability")[1]
    rows = scored.select(x.alias("x"), (p - F.col(label)).alias("e"))
    sums = rows.agg(
        F.avg("e").alias("intercept"),
        *[F.avg(F.col("e") * F.get("x", F.lit(j))).alias(f"g{j}") for j in range(len(names))],
        *[F.stddev_samp(F.get("x", F.lit(j))).alias(f"s{j}") for j in range(len(names))],
    )
    ridge = model.getRegParam() * (1 - model.getElasticNetParam())
    terms = [F.struct(F.lit("(intercept)").alias("term"), F.col("intercept").alias("gradient"))]
    for j, (name, beta) in enumerate(zip(names, model.coefficients.toArray().tolist())):
        spread = F.col(f"s{j}")
        gradient = F.when(spread > 0, F.col(f"g{j}") / spread + ridge * spread * beta).otherwise(F.lit(0.0))
        terms.append(F.struct(F.lit(name).alias("term"), gradient.alias("gradient")))
    return sums.select(F.inline(F.array(*terms)))


def component_checks(scores: DataFrame, model: PCAModel, total_variance: float, column: str = "pca_features") -> DataFrame:
    """(component, variance, explained, uncorrelated, in_order) of principal component scores.

    ``explained`` is the model's share of ``total_variance``, the sum of the variances of all
    inputs. The scores of components without variance count as uncorrelated.
    """
    k = model.getK()
    names = [f"c{i}" for i in range(k)]
    flat = scores.select(*[vector_to_array(column)[i].alias(n) for i, n in enumerate(names)])
    pairs = correlation(flat, names).filter("col_a <> col_b")
    worst = pairs.groupBy(F.col("col_a").alias("name")).agg(F.coalesce(F.max(F.abs("corr")), F.lit(0.0)).alias("worst"))
    spread = flat.agg(*[F.var_samp(n).alias(n) for n in names])
    shares = model.explainedVariance.toArray().tolist()
    each = F.array(*[
        F.struct(F.lit(i + 1).alias("component"), F.lit(n).alias("name"), F.col(n).alias("variance"),
                 F.lit(shares[i]).alias("explained"), (F.col(n) <= (F.col(names[i - 1]) if i else F.col(n)) * (1 + 1e-9)).alias("in_order"))
        for i, n in enumerate(names)
    ])
    found = spread.select(F.inline(each)).join(F.broadcast(worst), "name")
    matches = F.abs(F.col("variance") / F.lit(total_variance) - F.col("explained")) <= 1e-6
    return found.select("component", "variance", "explained", matches.alias("matches"), (F.col("worst") < 1e-6).alias("uncorrelated"), "in_order")
