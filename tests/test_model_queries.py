"""The model queries do the work that jobs/learn.py does."""

import pytest

from delaylens import models, tuning
from delaylens.plans import catalog


class Asked(Exception):
    pass


@pytest.fixture
def asked(spark, monkeypatch):
    """What a query asks to be fitted: the estimator, and its grid if it is tuned."""

    def stop(*args, **kwargs):
        raise Asked(*args)

    monkeypatch.setattr(catalog, "model_tables", lambda spark, base: (spark.range(1), spark.range(1)))
    monkeypatch.setattr(catalog, "fold_tables", catalog.model_tables)
    monkeypatch.setattr(catalog, "ROW_KEYS", ["id"])
    for module, name in ((models, "fit_cached"), (tuning, "fold_cv"), (tuning, "tune_then_refit")):
        monkeypatch.setattr(module, name, stop)

    def run(query):
        with pytest.raises(Asked) as e:
            catalog.QUERIES[query](spark, "")
        return e.value.args

    return run


def test_tree_queries_fit_all_trees(asked):
    forest, boosted = asked("rf_predictions")[1], asked("gbt_predictions")[1]
    assert (forest.getNumTrees(), forest.getMaxDepth()) == (40, 5)
    assert (boosted.getMaxIter(), boosted.getMaxDepth()) == (50, 6)


@pytest.mark.parametrize(
    "query, axes",
    [
        ("fold_cv_scores", {"regParam": 4, "maxIter": 3, "elasticNetParam": 4}),
        ("tuned_predictions", {"regParam": 4, "maxIter": 3, "elasticNetParam": 4}),
        ("fold_cv_average", {"maxDepth": 2, "maxIter": 2}),
    ],
)
def test_tuned_queries_try_the_whole_grid(asked, query, axes):
    _, maps, *_ = asked(query)
    values = {name: len({m[p] for m in maps for p in m if p.name == name}) for name in axes}
    every = {tuning.describe_params(m) for m in maps}
    size = 1
    for n in axes.values():
        size *= n
    assert values == axes and len(every) == len(maps) == size
