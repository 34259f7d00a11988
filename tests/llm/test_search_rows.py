"""Rows that the vector search once lost."""

import pytest

from delaylens.llm import hashing
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<double>"


def searched(spark, rows, query, k=10):
    got = hashing.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id").isin(query), k)
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got.collect())


@pytest.mark.parametrize("first", [2**53, 2**62, -(2**63)])
def test_large_ids_with_equal_vectors_all_stay(spark, first):
    rows = [(first + i, [1.0, 2.0]) for i in range(4)] + [(first + 3, [1.0, 2.0]), (5, [2.0, 0.0])]
    got = searched(spark, rows, [5])
    assert got == [(5, i + 1, first + i, 2.0) for i in range(4)]


def test_every_width_is_searched(spark):
    rows = [(i, [1.0, float(i)]) for i in range(6)] + [(10 + i, [1.0, 0.0, float(i)]) for i in range(3)] + [(20, [1.0])]
    got = searched(spark, rows, [1, 11, 20], k=2)
    assert got == [(1, 1, 5, 6.0), (1, 2, 4, 5.0), (11, 1, 12, 3.0), (11, 2, 10, 1.0)]
