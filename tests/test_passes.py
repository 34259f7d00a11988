"""How often the large tables are read and moved."""

import numpy as np
import pytest

from delaylens.operators import graph, profile
from delaylens.plans import catalog, standin

MEASURES = 7


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def jobs(spark):
    """The ids of the jobs that have run in the test."""
    spark.sparkContext.setJobGroup("passes", "passes")
    before = set(spark.sparkContext.statusTracker().getJobIdsForGroup("passes"))
    yield lambda: set(spark.sparkContext.statusTracker().getJobIdsForGroup("passes")) - before
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_correlation_reads_its_rows_once(spark, jobs):
    df = spark.createDataFrame([(float(i), float(i * i)) for i in range(9)], "a double, b double")
    found = profile.correlation(df, ["a", "b"])
    assert not jobs()
    want = np.corrcoef(range(9), [i * i for i in range(9)])[0, 1]
    assert {(r.col_a, r.col_b): r.corr for r in found.collect()}["a", "b"] == pytest.approx(want)


def test_dropping_correlated_columns_runs_the_joins_once(spark, monkeypatch):
    rows = [(float(i), float(i % 3), float(i % 5), float(i * 2), float(i % 7), float(i % 2), float(i % 4)) for i in range(40)]
    measures = spark.createDataFrame(rows, ", ".join(f"m{i} double" for i in range(MEASURES)))
    names = dict(zip(measures.columns, [*catalog._MEASURES, "spare"]))
    joined = measures.withColumnsRenamed(names).crossJoin(spark.createDataFrame([(1,)], "one int"))
    monkeypatch.setattr(catalog, "flights", lambda spark, base: joined)
    assert "Join" not in plan(catalog.drop_correlated(spark, ""))


def test_customers_meet_the_orders_before_the_lines(spark, tmp_path):
    tables = {
        "lineitem": ([(1, 1, 5, 7, 1.0)], "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double"),
        "orders": ([(1, 3, "P")], "o_orderkey long, o_custkey long, o_orderstatus string"),
        "customer": ([(3, 4), (3, 6)], "c_custkey long, c_nationkey int"),
        "supplier": ([(7, 2)], "s_suppkey long, s_nationkey int"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    dates = {"orders": ["o_orderdate"], "lineitem": ["l_shipdate"]}
    for name, cols in dates.items():
        df = spark.read.parquet(f"{tmp_path}/{name}.parquet")
        df = df.selectExpr("*", *[f"timestamp_ntz'1995-01-0{i + 1}' AS {c}" for i, c in enumerate(cols)])
        for c in {"orders": ["o_totalprice"], "lineitem": ["l_extendedprice", "l_discount", "l_tax", "l_returnflag"]}[name]:
            df = df.selectExpr("*", f"{repr('R') if c == 'l_returnflag' else '2.0D'} AS {c}")
        df.write.parquet(f"{tmp_path}/full/{name}.parquet")
    for name in ("customer", "supplier"):
        spark.read.parquet(f"{tmp_path}/{name}.parquet").write.parquet(f"{tmp_path}/full/{name}.parquet")
    found = standin.flights(spark, f"{tmp_path}/full")
    assert sorted((r.airport_iata, r.dest_iata) for r in found.collect()) == [(4, 2), (6, 2)]
    joins = [line for line in plan(found).splitlines() if "Join Inner" in line]
    assert ["l_suppkey" in joins[0], "l_orderkey" in joins[1], "o_custkey" in joins[2]] == [True] * 3


def test_links_of_unreached_sites_are_followed_once(spark, monkeypatch):
    """Nobody sells to the customers: their links are summed before the rounds, which see one link a supplier."""
    monkeypatch.setattr(graph, "BROADCAST_ROWS", 0)
    followed = []
    monkeypatch.setattr(graph, "hot_keys", lambda df, *_: followed.append(df.count()) or {})
    edges = [(f"C{i}", f"S{j}", 1 + (i + j) % 3) for i in range(30) for j in range(4)]
    found = graph.page_rank(spark.createDataFrame(edges, "src string, dst string, w long"), tol=0.0)
    scores = {r.dep_iata: r.dep_rank for r in found.collect()}
    assert followed[-1] == 4
    assert len(scores) == 34 and sum(scores.values()) == pytest.approx(1.0)
    assert len({round(scores[f"C{i}"], 15) for i in range(30)}) == 1
