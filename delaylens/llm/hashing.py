"""Largest inner products through multi-index hashing.

Binary codes come from rotations that are learned on a bounded sample: principal directions, turned so that
signs lose little. A code is split into substrings of eight bits. For every substring an
index holds, for each of its 256 values, the rows whose substring lies within the probing radius of it. By the
pigeonhole principle every code within Hamming radius r agrees with the query up to r / substrings
bits in some substring, so the union of the probed lists holds the whole ball; codes are checked
against r, and the floats of those inside rank the result. A query that finds too few widens its radius.

Rows and queries are dealt into blocks; a task indexes one block of rows and answers one block
of queries, and the best of all blocks are merged.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from delaylens.llm.common import staged

BITS = 128
TURNS = 15
SAMPLE = 8192
PROBES = 512
KEPT = 0.985
ROWS_BLOCK, QUERY_BLOCK = 8192, 4096


@dataclass
class Codes:
    """Codes of vectors of one width; ``radius`` is the usual Hamming radius of a neighbour."""

    center: np.ndarray
    directions: np.ndarray  # (width + 1) x BITS
    longest: float
    radius: int

    def of(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Packed codes. One more coordinate gives all rows the same length, so that a large inner
        product is a small angle; queries are brought to that length without it."""
        norms = np.linalg.norm(x, axis=1)
        if query:
            turned = np.hstack([x * (self.longest / norms)[:, None], np.zeros((len(x), 1))])
        else:
            turned = np.hstack([x, np.sqrt(np.maximum(self.longest**2 - norms**2, 0))[:, None]])
        return np.packbits((turned - self.center) @ self.directions > 0, axis=1)


def rotations(z: np.ndarray, bits: int, seed: int = 8) -> np.ndarray:
    """Directions whose signs keep centred rows ``z`` apart: principal ones, turned to fit their signs."""
    rng = np.random.default_rng(seed)
    axes = np.linalg.svd(z, full_matrices=False)[2]
    kept = axes[: min(bits, len(axes), z.shape[1])].T
    found = []
    while sum(d.shape[1] for d in found) < bits:
        flat = z @ kept
        turn = np.linalg.qr(rng.normal(size=(kept.shape[1],) * 2))[0]
        for _ in range(TURNS):
            u, _, v = np.linalg.svd(np.sign(flat @ turn).T @ flat)
            turn = (u @ v).T
        found.append(kept @ turn)
    return np.hstack(found)[:, :bits]


def fit(sample: np.ndarray, longest: float, rows: int, k: int) -> Codes:
    """Codes from a sample of ``rows`` vectors, with the radius that holds ``KEPT`` of its neighbours."""
    codes = Codes(np.zeros(sample.shape[1] + 1), np.zeros((sample.shape[1] + 1, BITS)), longest, BITS)
    lifted = np.hstack([sample, np.sqrt(np.maximum(longest**2 - (sample**2).sum(1), 0))[:, None]])
    codes.center = lifted.mean(axis=0)
    codes.directions = rotations(lifted - codes.center, BITS)
    # the k nearest of all rows are about this many of the sample
    near = max(1, round(k * len(sample) / max(rows, 1)))
    asked = sample[: min(PROBES, len(sample))]
    if len(sample) > near:
        scores = asked @ sample.T
        scores[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
        best = np.argpartition(-scores, near - 1, axis=1)[:, :near]
        own, theirs = codes.of(asked, True), codes.of(sample, False)
        far = np.bitwise_count(own[:, None, :] ^ theirs[best]).sum(axis=2)
        codes.radius = int(np.quantile(far, KEPT, method="higher"))
    return codes


class MultiIndex:
    """Rows of one block by the balls around each value of each substring of their codes."""

    def __init__(self, codes: np.ndarray, radius: int) -> None:
        self.codes, self.radius = codes, radius
        self.rows, self.parts = codes.shape
        self.words = codes.view(np.uint64)
        values = np.arange(256, dtype=np.uint8)
        self.flips = np.bitwise_count(values[:, None] ^ values[None, :])
        self.buckets = [
            np.packbits(codes[None, :, p] == values[:, None], axis=1) for p in range(self.parts)
        ]
        self.balls: dict[int, list[np.ndarray]] = {}

    def _balls(self, reach: int) -> list[np.ndarray]:
        """Bitmaps of the rows within ``reach`` flips of each value, one array for each substring."""
        if reach not in self.balls:
            near = self.flips <= reach
            self.balls[reach] = [
                np.stack([np.bitwise_or.reduce(b[near[v]], axis=0) for v in range(256)]) for b in self.buckets
            ]
        return self.balls[reach]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose code lies within ``radius`` of ``code``."""
        if radius >= 8 * self.parts:
            return np.arange(self.rows)
        balls = self._balls(radius // self.parts)
        probed = np.bitwise_or.reduce([balls[p][code[p]] for p in range(self.parts)], axis=0)
        at = np.flatnonzero(np.unpackbits(probed, count=self.rows))
        return at[np.bitwise_count(self.words[at] ^ code.view(np.uint64)).sum(axis=1) <= radius]


def _best(index: MultiIndex, x: np.ndarray, ids: np.ndarray, code: np.ndarray, query: np.ndarray, own: int, k: int):
    """The k best of a block, nearest first; fewer only if the block has fewer."""
    others = len(ids) - np.count_nonzero(ids == own)
    radius = index.radius
    while True:
        at = index.within(code, radius)
        at = at[ids[at] != own]
        if len(at) >= min(k, others):
            break
        radius += index.parts
    scores = x[at] @ query
    if len(at) > k:
        least = -np.partition(-scores, k - 1)[k - 1]
        inside = scores >= least
        at, scores = at[inside], scores[inside]
    order = np.lexsort((ids[at], -scores))[:k]
    return ids[at][order], scores[order]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=np.float64)


def _search(codes: Codes, k: int):
    schema = pa.schema([("query_id", pa.int64()), ("query", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        ids, x = left.column("vec_id").to_numpy(), _matrix(left.column("v"))
        # rows that repeat id and vector count once
        whole = np.ascontiguousarray(np.column_stack([ids, x.view(np.int64)]))
        first = np.sort(np.unique(whole.view(f"V{whole.shape[1] * 8}").ravel(), return_index=True)[1])
        ids, x = ids[first], x[first]
        index = MultiIndex(codes.of(x, False), codes.radius)
        asked = _matrix(right.column("v"))
        owns, rows = right.column("vec_id").to_numpy(), right.column("row").to_numpy()
        parts = []
        for i, code in enumerate(codes.of(asked, True)):
            found, scores = _best(index, x, ids, code, asked[i], owns[i], k)
            parts.append((np.full(len(found), owns[i]), np.full(len(found), rows[i]), found, scores))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*parts)], schema=schema)

    return run


def valid(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """vec_id and v (doubles) of the vectors that take part: all components finite, not all zero."""
    v = F.col(vector).cast("array<double>")
    good = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    some = F.exists(v, lambda c: c != 0)
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"))
    return rows.filter(F.col("vec_id").isNotNull() & F.coalesce(F.when(F.col("v").isNotNull(), good & some), F.lit(False)))


def search(vectors: DataFrame, is_query: Column, k: int, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ``k`` largest inner products of each query row (``is_query`` over ``vec_id``) with all other rows.

    Returns query_id, rank, vec_id, score; ties go to the smaller vec_id. A row never finds rows of its own
    id. Null, zero or non-finite vectors and vectors without an id take no part; vectors of each width are
    searched among their own; rows that repeat id and vector count once; two vectors under one query id are
    asked one by one; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    out = "query_id long, rank int, vec_id long, score double"
    rows = staged(valid(vectors, vec_id, vector), "vectors")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c))
    widths = rows.groupBy(F.size("v").alias("width")).agg(F.count("*").alias("n"), F.max(norm).alias("longest"))
    found = [_among(rows.filter(F.size("v") == w["width"]), w, is_query, k) for w in widths.filter("n > 1").orderBy("width").collect()]
    if not found:
        return spark.createDataFrame([], out)
    return reduce(DataFrame.unionAll, found)


def _among(rows: DataFrame, size: Row, is_query: Column, k: int) -> DataFrame:
    """``search`` among ``rows`` of one width; ``size`` has their number and the longest norm."""
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").collect()
    codes = fit(np.array([r["v"] for r in sample]), size["longest"], size["n"], k)
    queries = rows.filter(is_query).dropDuplicates(["vec_id", "v"])
    row_blocks = -(-size["n"] // ROWS_BLOCK)
    query_blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    base = rows.select(
        "vec_id",
        "v",
        F.pmod(F.xxhash64("vec_id"), F.lit(row_blocks)).alias("rb"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(query_blocks - 1).cast("long"))).alias("qb"),
    )
    asked = queries.select(
        "vec_id",
        "v",
        F.xxhash64("v").alias("row"),
        F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(query_blocks)).alias("qb"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(row_blocks - 1).cast("long"))).alias("rb"),
    )
    found = base.groupBy("rb", "qb").cogroup(asked.groupBy("rb", "qb")).applyInArrow(
        _search(codes, k), "query_id long, query long, vec_id long, score double"
    )
    nearest = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
