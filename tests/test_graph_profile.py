import numpy as np
import pytest
from pyspark.sql import functions as F

from delaylens import graph, ordered, profile


def brute_page_rank(edges, alpha, rounds, spread):
    nodes = sorted({e[0] for e in edges} | {e[1] for e in edges})
    out = {n: sum(w for s, _, w in edges if s == n) for n in nodes}
    n = len(nodes)
    senders = [x for x in nodes if out[x]]
    score = {x: 1 / n if spread else (1 / len(senders) if out[x] else 0.0) for x in nodes}
    for _ in range(rounds):
        inflow = {x: sum(score[s] * w / out[s] for s, d, w in edges if d == x) for x in nodes}
        lost = sum(score[x] for x in nodes if not out[x]) if spread else 0.0
        score = {x: alpha / n + (1 - alpha) * (inflow[x] + lost / n) for x in nodes}
    return score


EDGES = [("a", "b", 3), ("b", "a", 1), ("b", "c", 2), ("a", "c", 1), ("d", "a", 5), ("c", "e", 2), ("a", "a", 1)]
CLOSED = [("a", "b", 3), ("b", "a", 1), ("b", "c", 2), ("c", "a", 4)]


@pytest.mark.parametrize("edges", [EDGES, CLOSED])
@pytest.mark.parametrize("alpha, dangling", [(0.15, "spread"), (0.0, "drop"), (0.15, "drop")])
def test_page_rank(spark, edges, alpha, dangling):
    df = spark.createDataFrame(edges, "src string, dst string, w long")
    got = {r["dep_iata"]: r["dep_rank"] for r in graph.page_rank(df, alpha=alpha, dangling=dangling).collect()}
    want = brute_page_rank(edges, alpha, 15, dangling == "spread")
    assert got == pytest.approx(want, abs=1e-12)
    if dangling == "spread":
        assert sum(got.values()) == pytest.approx(1.0)


@pytest.mark.parametrize("dangling", ["spread", "drop"])
def test_page_rank_without_broadcast(spark, monkeypatch, dangling):
    monkeypatch.setattr(graph, "BROADCAST_ROWS", 0)
    hub = [("hub", f"n{i}", 1 + i % 3) for i in range(40)] + [(f"n{i}", "hub", 1) for i in range(0, 40, 2)]
    edges = EDGES + hub + [("a", "hub", 1)]
    df = spark.createDataFrame(edges, "src string, dst string, w long")
    got = {r["dep_iata"]: r["dep_rank"] for r in graph.page_rank(df, max_iter=6, dangling=dangling).collect()}
    assert got == pytest.approx(brute_page_rank(edges, 0.15, 6, dangling == "spread"), abs=1e-12)


def test_edge_weights(spark):
    df = spark.createDataFrame([("a", "b"), ("a", "b"), ("b", "a")], "o string, d string")
    assert sorted(map(tuple, graph.edge_weights(df, "o", "d").collect())) == [("a", "b", 2), ("b", "a", 1)]


def test_rank_and_top(spark):
    df = spark.createDataFrame([(i, i % 7) for i in range(1000)], "id int, v int").repartition(6)
    ranked = profile.rank_by(df, [F.col("v").desc(), "id"])
    want = sorted(((-(i % 7), i) for i in range(1000)))
    assert [r["id"] for r in ranked.orderBy("rank").collect()] == [i for _, i in want]
    assert sorted(r["rank"] for r in ranked.collect()) == list(range(1, 1001))
    assert [r["id"] for r in profile.top_k(df, [F.col("v").desc(), F.col("id")], 3).collect()] == [6, 13, 20]


@pytest.mark.parametrize("hot", [False, True])
def test_box_stats_against_numpy(spark, hot):
    rng = np.random.default_rng(3)
    values = {g: np.round(rng.normal(0, 10, 700 + 13 * g), 1) for g in (0, 1)}
    if hot:
        values[1] = np.concatenate([values[1], np.full(900, 2.5), [900.0, -400.0]])
    data = [(g, float(v)) for g, vs in values.items() for v in vs] + [(0, None), (1, float("nan"))]
    df = spark.createDataFrame(data, "g int, v double").repartition(8)
    got = {r["g"]: r for r in profile.box_stats(df, "v", "g").collect()}
    for g, vs in values.items():
        q1, q2, q3 = np.quantile(vs, [0.25, 0.5, 0.75])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = vs[(vs >= low) & (vs <= high)]
        r = got[g]
        assert (r["n"], r["outliers"]) == (len(vs), len(vs) - len(inside))
        assert [r[c] for c in ("q1", "median", "q3")] == pytest.approx([q1, q2, q3])
        assert [r[c] for c in ("min", "max", "whisker_low", "whisker_high")] == pytest.approx(
            [vs.min(), vs.max(), inside.min(), inside.max()]
        )
    whole = profile.box_stats(df, "v").first()
    everything = np.concatenate(list(values.values()))
    assert whole["median"] == pytest.approx(np.quantile(everything, 0.5))


def test_quantiles_of_tiny_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("b", 2.0)], "g string, v double")
    counted = ordered.counted_values(df, "v", "g")
    got = {r["g"]: (r["q0"], r["q1"]) for r in ordered.quantiles(counted, [0.5, 0.25], "g").collect()}
    assert got == {"a": (1.0, 1.0), "b": (1.5, 1.25)}


@pytest.mark.parametrize("bins, lo, hi", [(10, None, None), (7, -5.0, 5.0), (2, None, None)])
def test_histogram_against_numpy(spark, bins, lo, hi):
    values = [float(v) for v in np.random.default_rng(5).normal(0, 6, 500)] + [-5.0, 5.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double")
    span = None if lo is None else (lo, hi)
    counts, edges = np.histogram(values, bins=bins, range=span)
    got = profile.histogram(df, "v", bins, lo, hi).orderBy("bin").collect()
    assert [r["n"] for r in got] == list(counts)
    assert [r["left_edge"] for r in got] == pytest.approx(list(edges[:-1]))


def test_histogram_of_constant_and_empty(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "v double")
    assert sum(r["n"] for r in profile.histogram(df, "v", 4).collect()) == 2
    assert sum(r["n"] for r in profile.histogram(df.limit(0), "v", 4).collect()) == 0


def test_summaries(spark):
    df = spark.createDataFrame([(1, 2.0, "a"), (0, float("nan"), None), (None, 4.0, "a")], "f int, v double, s string")
    assert {r["column"]: r["missing"] for r in profile.missing(df).collect()} == {"f": 1, "v": 1, "s": 1}
    assert [r["column"] for r in profile.missing(df, exclude=("v",)).collect()] == ["f", "s"]
    assert profile.shape(df).first() == (3, 3)
    assert profile.flag_rate(df, ["f"]).first()["percent"] == pytest.approx(100 / 3)
    assert profile.null_count(df, "s").first()[0] == 1
    assert profile.ndv(df, "s").first()[0] == profile.ndv(df, "s", approximate=True).first()[0] == 1
    assert [tuple(r) for r in profile.value_counts(df, "s").collect()] == [("a", 2)]
    got = profile.describe(df, ["f"]).first()
    assert (got["count"], got["mean"], got["min"], got["max"]) == (2, 0.5, 0.0, 1.0)
    flags = profile.label_by_flag(spark.createDataFrame([(1, 1, 0), (0, 1, 1)], "y int, p int, q int"), ["p", "q"], "y")
    assert sorted(map(tuple, flags.collect())) == [(0, "p", 1), (0, "q", 1), (1, "p", 1)]


def test_correlation_against_numpy(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(1e6, 1.0, 400)
    data = np.column_stack([x, x * 2 + rng.normal(0, 1, 400), rng.normal(0, 1, 400), np.full(400, 3.0)])
    rows = [tuple(map(float, r)) for r in data] + [(float("nan"), 1.0, 1.0, 3.0), (None, 1.0, 1.0, 3.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, k double")
    got = {(r[0], r[1]): r[2] for r in profile.correlation(df, ["a", "b", "c", "k"]).collect()}
    want = np.corrcoef(data[:, :3].T)
    for i, p in enumerate("abc"):
        for j, q in enumerate("abc"):
            assert got[(p, q)] == pytest.approx(want[i, j], abs=1e-9)
    assert got[("a", "k")] is None and got[("k", "k")] is None
