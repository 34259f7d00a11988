"""Queries that once left out rows, components or times."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from delaylens.plans import catalog
from delaylens.plans import flights as flow

BASE = os.environ.get("CATALOG_SF_DIR", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not os.path.isdir(BASE), reason="no test data")


@needs_data
def test_pca_scores_every_row(spark):
    assert catalog.pca_scores(spark, BASE).count() == catalog.dated(spark, BASE).count()


def embeddings(spark, folder, vectors):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{folder}/embeddings.parquet")
    return str(folder)


@pytest.mark.parametrize("width", [20, 70])
def test_pca_embeddings_reads_every_position(spark, tmp_path, width):
    rng = np.random.default_rng(3)
    x = (rng.normal(size=(80, width)) * np.linspace(0.1, 4.0, width)).astype(np.float32)
    got = catalog.pca_embeddings(spark, embeddings(spark, tmp_path, x)).orderBy("vec_id").collect()
    _, _, axes = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)
    assert len(got) == 80
    np.testing.assert_allclose(np.abs([r["pca_features"] for r in got]), np.abs(x @ axes[:5].T), atol=1e-3)


def test_pca_embeddings_refuses_two_widths(spark, tmp_path):
    with pytest.raises(ValueError, match="3 to 4 wide"):
        catalog.pca_embeddings(spark, embeddings(spark, tmp_path, [[1, 2, 3], [1, 2, 3, 4]]))


@needs_data
def test_flight_times_are_in_order(spark):
    dep, off, on, arrived = ("actual_dep", "wheels_off", "wheels_on", "actual_arr")
    df = catalog.QUERIES["flight_times"](spark, BASE)
    assert {u for _, u, _ in flow.FLIGHT_TIMES} <= set(df.columns)
    wrong = F.lit(False)
    for a, b in ((dep, off), (off, on), (on, arrived), ("target_dep", "target_arr")):
        wrong |= F.coalesce(F.col(f"{a}_utc_timestamp") > F.col(f"{b}_utc_timestamp"), F.lit(False))
    found = df.agg(F.count("*").alias("n"), F.count(F.when(wrong, 1)).alias("wrong")).first()
    assert found["n"] > 0 and found["wrong"] == 0
