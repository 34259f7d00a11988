"""Gradient boosted trees on second-order histograms, as an MLlib estimator.

Features are cut into at most 255 bins at their quantiles, and rows are kept in blocks, a few
arrays each, so that no row is handled on its own. For every level of a tree each
task adds up the gradients of its rows by (node, feature, bin); Spark sums the tasks' parts
and finds each feature's best cut, and only one candidate per node and feature reaches the
driver. Every cut learns where missing values go. Trees grow to their depth and are then
pruned from the leaves; leaves are shrunk by L1 and L2 penalties.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, TaskContext, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol, HasStepSize
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.session import checkpointed

MISSING_BIN = 255
SLOTS = 256
LEAST_GAIN = 1e-6
CHECKPOINT_TREES = 10
#: A block of rows: bins by feature, labels and margins, each as the bytes of an array.
ROWS = "bins binary, label binary, margin binary"


@dataclass
class Tree:
    """Nodes as arrays; ``feature`` is -1 at a leaf. A row goes left if its value is at most ``cut``."""

    feature: list[int]
    bin: list[int]
    cut: list[float]
    default_left: list[bool]
    left: list[int]
    right: list[int]
    gain: list[float]
    value: list[float]

    @classmethod
    def leaf(cls) -> Tree:
        return cls([-1], [0], [0.0], [False], [0], [0], [0.0], [0.0])

    def add(self) -> int:
        for name, blank in (("feature", -1), ("bin", 0), ("cut", 0.0), ("default_left", False), ("left", 0), ("right", 0), ("gain", 0.0), ("value", 0.0)):
            getattr(self, name).append(blank)
        return len(self.feature) - 1

    def walk(self, values: np.ndarray, missing: np.ndarray, cuts: str) -> np.ndarray:
        """The leaf of each row of ``values``; ``cuts`` says whether these are bins or raw values."""
        feature, cut = np.array(self.feature), np.array(getattr(self, cuts))
        left, right, default = np.array(self.left), np.array(self.right), np.array(self.default_left)
        node, row = np.zeros(len(values), np.int64), np.arange(len(values))
        while len(row):
            at = node[row]
            inner = feature[at] >= 0
            row, at = row[inner], at[inner]
            f = feature[at]
            goes = np.where(missing[row, f], default[at], values[row, f] <= cut[at])
            node[row] = np.where(goes, left[at], right[at])
        return node

    def prune(self, gamma: float) -> None:
        """From the leaves up, undo cuts that gain less than ``gamma``."""
        for i in range(len(self.feature) - 1, -1, -1):
            ends = [self.feature[c] < 0 for c in (self.left[i], self.right[i])]
            if self.feature[i] >= 0 and all(ends) and self.gain[i] < gamma:
                self.feature[i] = -1


def shrunk(g: np.ndarray, alpha: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0)


def leaf_score(g: np.ndarray, h: np.ndarray, alpha: float, lam: float) -> np.ndarray:
    total = h + lam
    return np.divide(shrunk(g, alpha) ** 2, total, out=np.zeros_like(total), where=total > 0)


def leaf_value(g: float, h: float, alpha: float, lam: float) -> float:
    return float(-shrunk(np.float64(g), alpha) / (h + lam)) if h + lam > 0 else 0.0


def best_cut(g: np.ndarray, h: np.ndarray, alpha: float, lam: float, least_weight: float) -> tuple:
    """(gain, bin, missing go left, g left, h left, g, h) of a feature's histogram; the first of equal gains."""
    total_g, total_h = g.sum(), h.sum()
    left_g, left_h = np.cumsum(g[:MISSING_BIN]), np.cumsum(h[:MISSING_BIN])
    best = (-np.inf, 0, False, 0.0, 0.0)
    for goes_left in (False, True):
        part_g = left_g + (g[MISSING_BIN] if goes_left else 0.0)
        part_h = left_h + (h[MISSING_BIN] if goes_left else 0.0)
        gain = leaf_score(part_g, part_h, alpha, lam) + leaf_score(total_g - part_g, total_h - part_h, alpha, lam)
        allowed = (part_h >= least_weight) & (total_h - part_h >= least_weight)
        gain = np.where(allowed, gain - leaf_score(np.array([total_g]), np.array([total_h]), alpha, lam), -np.inf)
        at = int(np.argmax(gain))
        if gain[at] > best[0]:
            best = (float(gain[at]), at, goes_left, float(part_g[at]), float(part_h[at]))
    return (*best, float(total_g), float(total_h))


def blocks_of(batches: Iterator[pa.RecordBatch], features: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bins, label, margin) of each block of rows; ``bins`` holds a row for each feature."""
    for batch in batches:
        columns = [batch.column(c) for c in ("bins", "label", "margin")]
        for cells in zip(*columns):
            bins, label, margin = (np.frombuffer(c.as_buffer(), kind) for c, kind in zip(cells, ("u1", "f8", "f8")))
            yield bins.reshape(features, len(label)), label, margin


def block(bins: np.ndarray, label: np.ndarray, margin: np.ndarray) -> pa.RecordBatch:
    data = [pa.array([part.tobytes()], pa.binary()) for part in (bins, label, margin)]
    return pa.RecordBatch.from_arrays(data, ["bins", "label", "margin"])


class BinWalk:
    """A tree's steps on bins as a table by node and bin; a leaf leads to itself. Bin ``gone`` is missing."""

    def __init__(self, tree: Tree, gone: int) -> None:
        self.width, nodes = gone + 1, len(tree.feature)
        self.feature = np.maximum(tree.feature, 0)
        self.steps = np.repeat(np.arange(nodes), self.width).reshape(nodes, self.width)
        deep = [0] * nodes
        for i in range(nodes):
            if tree.feature[i] >= 0:
                left, right = tree.left[i], tree.right[i]
                self.steps[i] = np.where(np.arange(self.width) <= tree.bin[i], left, right)
                self.steps[i, gone] = left if tree.default_left[i] else right
                deep[left] = deep[right] = deep[i] + 1
        self.depth, self.steps = max(deep), self.steps.ravel()

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        rows = bins.shape[1]
        node, row, flat, starts = np.zeros(rows, np.int64), np.arange(rows), bins.ravel(), self.feature * rows
        for _ in range(self.depth):
            node = self.steps.take(node * self.width + flat.take(starts.take(node) + row))
        return node


def gradients(objective: str, label: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """First and second derivatives; None stands for second ones that are all 1."""
    if objective == "logistic":
        p = 1 / (1 + np.exp(-margin))
        return p - label, p * (1 - p)
    return margin - label, None


def _bin_rows(edges: list[list[float]], missing: float, base: float, gone: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            x = batch.column("x").flatten().to_numpy().reshape(rows, len(edges))
            bins = np.empty((len(edges), rows), np.uint8)
            for f, cuts in enumerate(edges):
                bins[f] = np.minimum(np.searchsorted(cuts, x[:, f]), gone)
            bins[is_missing(x, missing).T] = gone
            yield block(bins, batch.column("label").to_numpy(), np.full(rows, base))

    return run


def gone_bin(edges: list[list[float]]) -> int:
    """The bin of missing values: the one behind the last of any feature."""
    return max(map(len, edges), default=0)


def is_missing(x: np.ndarray, missing: float) -> np.ndarray:
    return np.isnan(x) | (x == missing)


def _histograms(tree: Tree, level: list[int], features: int, objective: str, gone: int):
    """A task's sums of gradients by (node, feature), for the nodes of ``level``."""
    place = np.full(len(tree.feature), -1)
    place[level] = np.arange(len(level))
    walk, width = BinWalk(tree, gone), gone + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((2, features, len(level) * width))
        for bins, label, margin in blocks_of(batches, features):
            node = place.take(walk.leaves(bins))
            g, h = gradients(objective, label, margin)
            inside = np.flatnonzero(node >= 0)
            if len(inside) < len(node):
                node, bins, g = node.take(inside), bins.take(inside, axis=1), g.take(inside)
                h = h if h is None else h.take(inside)
            start = node * width
            for f in range(features):
                slot = start + bins[f]
                found[0, f] += np.bincount(slot, g, len(level) * width)
                found[1, f] += np.bincount(slot, h, len(level) * width)
        # missing values are in the last place of a node, and in their own among the slots
        found, sums = found.reshape(2, features, len(level), width), np.zeros((2, features, len(level), SLOTS))
        sums[..., :gone], sums[..., MISSING_BIN] = found[..., :gone], found[..., gone]
        part, cells = TaskContext.get().partitionId(), sums.reshape(2, features, len(level), SLOTS)
        for f in range(features):
            columns = {
                "node": pa.array(level, pa.int32()),
                "feature": pa.array([f] * len(level), pa.int32()),
                "part": pa.array([part] * len(level), pa.int32()),
                "g": pa.array([c.tobytes() for c in cells[0, f]], pa.binary()),
                "h": pa.array([c.tobytes() for c in cells[1, f]], pa.binary()),
            }
            yield pa.record_batch(columns)

    return run


CUT = "node int, feature int, gain double, bin int, default_left boolean, left_g double, left_h double, g double, h double"


def _best(alpha: float, lam: float, least_weight: float):
    def run(table: pa.Table) -> pa.Table:
        # tasks are added in their order, so that a rerun gives the same sums
        table = table.sort_by("part")
        g, h = (sum(np.frombuffer(b, "f8") for b in table.column(c).to_pylist()) for c in ("g", "h"))
        gain, cut, goes_left, left_g, left_h, total_g, total_h = best_cut(g, h, alpha, lam, least_weight)
        row = {
            "node": table.column("node")[0].as_py(), "feature": table.column("feature")[0].as_py(), "gain": gain, "bin": cut,
            "default_left": goes_left, "left_g": left_g, "left_h": left_h, "g": total_g, "h": total_h,
        }
        kinds = [pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.bool_(), *[pa.float64()] * 4]
        return pa.Table.from_pylist([row], pa.schema(list(zip(row, kinds))))

    return run


def _moved(tree: Tree, features: int, gone: int):
    walk = BinWalk(tree, gone)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = np.array(tree.value)
        for bins, label, margin in blocks_of(batches, features):
            yield block(bins, label, margin + value.take(walk.leaves(bins)))

    return run


class _BoostingParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasMaxIter, HasStepSize):
    maxDepth = Param(Params._dummy(), "maxDepth", "levels of cuts in a tree", TypeConverters.toInt)
    alpha = Param(Params._dummy(), "alpha", "L1 penalty of leaves", TypeConverters.toFloat)
    lam = Param(Params._dummy(), "lam", "L2 penalty of leaves", TypeConverters.toFloat)
    gamma = Param(Params._dummy(), "gamma", "least gain of a cut that stays", TypeConverters.toFloat)
    leastWeight = Param(Params._dummy(), "leastWeight", "least sum of second derivatives in a child", TypeConverters.toFloat)
    missing = Param(Params._dummy(), "missing", "the value that stands for missing, besides NaN", TypeConverters.toFloat)
    base = Param(Params._dummy(), "base", "margin before the first tree", TypeConverters.toFloat)
    objective = Param(Params._dummy(), "objective", "squared or logistic", TypeConverters.toString)
    bins = Param(Params._dummy(), "bins", "most bins of a feature, up to 255", TypeConverters.toInt)

    def _defaults(self) -> None:
        self._setDefault(
            maxIter=50, stepSize=0.1, maxDepth=6, alpha=0.1, lam=1e-5, gamma=7.0, leastWeight=1.0, missing=0.0, base=0.5,
            objective="squared", bins=64,
        )


class HistogramBoosting(Estimator, _BoostingParams, DefaultParamsReadable, DefaultParamsWritable):
    """Boosted trees with a learned direction for missing values, on a vector column.

    Rows without a label are left out; vectors of several lengths are an error. The
    defaults are depth 6, 50 trees, rate 0.1, L1 0.1, L2 1e-5, least gain 7, and 0.0 missing.
    """

    @keyword_only
    def __init__(self, **kwargs) -> None:
        super().__init__()
        self._defaults()
        self._set(**kwargs)

    def edges(self, rows: DataFrame, width: int) -> list[list[float]]:
        """Upper edges of each feature's bins: its quantiles without missing values, in one aggregation."""
        if not width:
            return []
        n = min(self.getOrDefault(self.bins), MISSING_BIN)
        probs = [(i + 1) / n for i in range(n - 1)]
        cuts = []
        for f in range(width):
            x = F.get("x", F.lit(f))
            known = F.when(~F.isnan(x) & (x != self.getOrDefault(self.missing)), x)
            cuts.append(F.percentile_approx(known, probs, 100 * n).alias(f"f{f}"))
        # the last bin has no end, so that a cut behind it parts the missing values from all others
        return [[*sorted(set(found or [])), float("inf")] for found in rows.agg(*cuts).first()]

    def _fit(self, df: DataFrame) -> HistogramBoostingModel:
        label = F.col(self.getLabelCol()).cast("double")
        rows = df.select(vector_to_array(self.getFeaturesCol()).alias("x"), label.alias("label")).dropna(subset=["label"])
        least, width = rows.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
        if least != width:
            raise ValueError(f"feature vectors are {least} to {width} long")
        edges = self.edges(rows, width or 0)
        missing, base = self.getOrDefault(self.missing), self.getOrDefault(self.base)
        trees: list[Tree] = []
        persisted: list[DataFrame] = []

        def kept(held: DataFrame) -> DataFrame:
            """Persist new margins. They are computed, from those before them, as the next tree grows."""
            persisted.append(held.persist(StorageLevel.MEMORY_AND_DISK))
            for old in persisted[:-2]:
                old.unpersist()
            del persisted[:-2]
            return held

        try:
            held = kept(rows.mapInArrow(_bin_rows(edges, missing, base, gone_bin(edges)), ROWS))
            for n in range(self.getMaxIter()):
                trees.append(self._grow(held, edges))
                if n + 1 < self.getMaxIter():
                    moved = held.mapInArrow(_moved(trees[-1], len(edges), gone_bin(edges)), ROWS)
                    held = kept(checkpointed(moved) if (n + 1) % CHECKPOINT_TREES == 0 else moved)
        finally:
            for old in persisted:
                old.unpersist()
        model = HistogramBoostingModel(trees=json.dumps([vars(t) for t in trees]))
        return self._copyValues(model)

    def _grow(self, held: DataFrame, edges: list[list[float]]) -> Tree:
        rate, alpha, lam = self.getStepSize(), self.getOrDefault(self.alpha), self.getOrDefault(self.lam)
        search = _best(alpha, lam, self.getOrDefault(self.leastWeight))
        tree, level = Tree.leaf(), [0]
        for _ in range(self.getOrDefault(self.maxDepth)):
            if not level or not edges:
                break
            sums = held.mapInArrow(
                _histograms(tree, level, len(edges), self.getOrDefault(self.objective), gone_bin(edges)),
                "node int, feature int, part int, g binary, h binary",
            )
            found = sums.groupBy("node", "feature").applyInArrow(search, CUT).collect()
            following = []
            for node in level:
                own = sorted((r for r in found if r["node"] == node), key=lambda r: (-r["gain"], r["feature"]))
                if not own:
                    continue
                best = own[0]
                if node == 0:
                    tree.value[0] = rate * leaf_value(best["g"], best["h"], alpha, lam)
                if best["gain"] > LEAST_GAIN:
                    following += self._cut(tree, node, best, edges, rate, alpha, lam)
            level = following
        tree.prune(self.getOrDefault(self.gamma))
        return tree

    def _cut(self, tree: Tree, node: int, best, edges, rate: float, alpha: float, lam: float) -> list[int]:
        left, right = tree.add(), tree.add()
        tree.feature[node], tree.bin[node], tree.gain[node] = best["feature"], best["bin"], best["gain"]
        tree.cut[node] = edges[best["feature"]][best["bin"]]
        tree.default_left[node], tree.left[node], tree.right[node] = best["default_left"], left, right
        rest = best["g"] - best["left_g"], best["h"] - best["left_h"]
        tree.value[left] = rate * leaf_value(best["left_g"], best["left_h"], alpha, lam)
        tree.value[right] = rate * leaf_value(*rest, alpha, lam)
        return [left, right]


class HistogramBoostingModel(Model, _BoostingParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted trees; ``transform`` adds their sum, as a probability under the logistic objective."""

    trees = Param(Params._dummy(), "trees", "the fitted trees as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, **kwargs) -> None:
        super().__init__()
        self._defaults()
        self._set(**kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        trees = [Tree(**t) for t in json.loads(self.getOrDefault(self.trees))]
        missing, base = self.getOrDefault(self.missing), self.getOrDefault(self.base)
        logistic = self.getOrDefault(self.objective) == "logistic"

        @F.pandas_udf("double")
        def score(column: pd.Series) -> pd.Series:
            x = np.stack(column.to_numpy()) if len(column) else np.zeros((0, 1))
            gone, margin = is_missing(x, missing), np.full(len(x), base)
            for tree in trees:
                margin += np.array(tree.value)[tree.walk(x, gone, "cut")]
            return pd.Series(1 / (1 + np.exp(-margin)) if logistic else margin)

        return df.withColumn(self.getPredictionCol(), score(vector_to_array(self.getFeaturesCol())))
