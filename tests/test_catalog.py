"""Every registered query with SQL is compared with an independent engine."""

import math
import os

import pytest

import __spark_entry__ as entry_points

duckdb = pytest.importorskip("duckdb")
BASE = os.environ.get("CATALOG_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(BASE), reason="no test data")

QUERIES = entry_points.queries()
ORACLES = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in os.listdir(BASE):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{BASE}/{name}'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    return repr(float(value)) if isinstance(value, (int, float)) else str(value)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, tables, name):
    df = QUERIES[name](spark, BASE)
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    found = tables.execute(ORACLES[name])
    want = normal([d[0] for d in found.description], found.fetchall())
    assert got[1], "no rows"
    assert got == want


@pytest.mark.parametrize("name", ["pca_scores", "gbt_predictions", "saved_model_predictions"])
def test_rows_only(spark, name):
    assert QUERIES[name](spark, BASE).count() > 0


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.count() > 0 and "target_dep_ymdh_n2" in df.columns


def test_no_python_in_plans(spark):
    for name in ("lag_hour_join", "hhmm_to_utc", "holiday_flag", "undersample", "metrics_weighted"):
        plan = QUERIES[name](spark, BASE)._jdf.queryExecution().executedPlan().toString()
        assert "EvalPython" not in plan, name
