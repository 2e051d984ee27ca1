"""Regularised second-order boosting of regression trees from histograms.

Inputs are cut into quantile bins once and rows are kept as blocks of bin numbers. For each level of a tree, one distributed
aggregation sums gradients and hessians per (node, input, bin); the driver sees only these sums, whose size depends on the tree's width,
and picks the splits. Leaf weights and gains carry an L2 penalty. Rows are drawn per round by a hash of the row, so a
task that is run again draws the same rows.
"""

from __future__ import annotations

import json
import sys
import types
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocktide.config import BoostSpec
from stocktide.storage import discard, read_file, staged, write_file

#: Rows of one block.
BLOCK_ROWS = 1 << 16
#: Rank error of the quantiles that bound the bins, as a share of a bin.
QUANTILE_ACCURACY = 20


def bin_edges(train: DataFrame, inputs: list[str], bins: int) -> list[np.ndarray]:
    """Per input the different values among its quantiles; a row's bin is the number of edges below its value."""
    shares = ", ".join(f"{i / bins}D" for i in range(1, bins))
    quantiles = [f"percentile_approx(cast(`{c}` AS double), array({shares}), {bins * QUANTILE_ACCURACY}) AS `{c}`" for c in inputs]
    found = train.agg(*map(F.expr, quantiles)).first()
    return [np.unique(np.array(found[c] or [], float)) for c in inputs]


def binned(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bins of a rows x inputs matrix; NULL and NaN go with the smallest values."""
    out = np.empty(values.shape, np.uint8)
    for j, e in enumerate(edges):
        out[:, j] = np.searchsorted(e, np.nan_to_num(values[:, j], nan=-np.inf, posinf=np.inf, neginf=-np.inf), "left")
    return out


def drawn(ids: np.ndarray, tree: int, seed: int, share: float) -> np.ndarray:
    """Which rows a round uses, by a hash of row and round."""
    with np.errstate(over="ignore"):
        x = ids.astype(np.uint64) + np.uint64(seed * 1_000_003 + tree + 1) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) < np.uint64(int(share * (2**64 - 1)))


def columns_of(tree: int, n: int, spec: BoostSpec) -> np.ndarray:
    """The inputs that a round may split on."""
    take = max(1, int(spec.colsample * n))
    return np.sort(np.random.default_rng([spec.seed, tree]).choice(n, take, replace=False))


def place(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    """The node of every row after some levels; node i has the children 2i + 1 (bin at or below its cut) and 2i + 2."""
    node = np.zeros(len(bins), np.int64)
    line = np.arange(len(bins))
    for _ in range(levels):
        f = feature[node]
        right = bins[line, np.maximum(f, 0)] > cut[node]
        node = np.where(f < 0, node, 2 * node + 1 + right)
    return node


def level_sums(node: np.ndarray, bins: np.ndarray, gradient: np.ndarray, level: int, columns: np.ndarray, n_bins: int) -> np.ndarray:
    """Gradient and hessian per node of a level, input and bin, as one array (2, nodes, inputs, bins)."""
    width = 1 << level
    here = np.flatnonzero((node >= width - 1) & (node < 2 * width - 1))
    cell = ((node[here] - (width - 1))[:, None] * len(columns) + np.arange(len(columns))) * n_bins + bins[here][:, columns]
    size = width * len(columns) * n_bins
    g = np.bincount(cell.ravel(), np.repeat(gradient[here], len(columns)), size)
    h = np.bincount(cell.ravel(), minlength=size)  # the hessian of the squared error is one a row
    return np.stack([g, h]).reshape(2, width, len(columns), n_bins)


def best_splits(sums: np.ndarray, l2: float, least_weight: float):
    """Per node: gain, place among the inputs, and bin of the best split (no gain: none); and its sums (gradient, hessian)."""
    left = sums.cumsum(axis=3)
    total = left[:, :, :1, -1:]
    right = total - left
    score = lambda s: s[0] ** 2 / (s[1] + l2)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = score(left) + score(right) - score(total)
    gain[(left[1] < least_weight) | (right[1] < least_weight) | ~np.isfinite(gain)] = -np.inf
    flat = gain.reshape(len(gain), -1)
    # the first of equal gains, whatever the order of the additions did to their last digits
    top = flat.max(axis=1, keepdims=True)
    at = (flat >= top - 1e-9 * np.abs(np.where(np.isfinite(top), top, 0))).argmax(axis=1)
    return flat[np.arange(len(flat)), at], at // sums.shape[3], at % sums.shape[3], total[:, :, 0, 0]


@dataclass
class Boosted:
    """Trees as arrays (tree, node), node 0 the root; a leaf has feature -1 and a weight."""

    inputs: list[str]
    base: float
    edges: list[np.ndarray]
    feature: np.ndarray
    cut: np.ndarray
    weight: np.ndarray
    gain: np.ndarray
    depth: int

    def scores(self, bins: np.ndarray, first: int = 0) -> np.ndarray:
        """Sum of the trees from ``first`` on, without the base."""
        found = np.zeros(len(bins))
        for t in range(first, len(self.feature)):
            found += self.weight[t][place(bins, self.feature[t], self.cut[t], self.depth)]
        return found

    def predict(self, df: DataFrame, out: str = "predicted") -> DataFrame:
        """Add the prediction in one pass over Arrow batches; the trees, bounded by rounds and depth, travel with the tasks."""
        shared = df.sparkSession.sparkContext.broadcast(self)
        inputs = self.inputs

        @F.pandas_udf(T.DoubleType())
        def score(*columns):
            import pandas as pd

            model = shared.value
            return pd.Series(model.base + model.scores(binned(np.column_stack([c.to_numpy(float) for c in columns]), model.edges)))

        return df.withColumn(out, score(*[F.col(c).cast("double") for c in inputs]))

    def importances(self) -> dict[str, float]:
        """Share of the whole gain per input."""
        split = self.feature >= 0
        found = np.bincount(self.feature[split], self.gain[split], len(self.inputs))
        return dict(zip(self.inputs, (found / found.sum() if found.sum() else found).tolist()))

    def save(self, spark: SparkSession, path: str) -> None:
        plain = {
            "inputs": self.inputs, "base": self.base, "edges": [e.tolist() for e in self.edges], "depth": self.depth,
            **{k: getattr(self, k).tolist() for k in ("feature", "cut", "weight", "gain")},
        }
        write_file(spark, path, json.dumps(plain))

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Boosted":
        found = json.loads(read_file(spark, path))
        found |= {"edges": [np.array(e) for e in found["edges"]]}
        found |= {k: np.array(found[k], int if k in ("feature", "cut") else float) for k in ("feature", "cut", "weight", "gain")}
        return Boosted(**found)


def _blocks(train: DataFrame, inputs: list[str], target: str, edges: list[np.ndarray], block_rows: int) -> DataFrame:
    """Training rows as blocks: bin numbers, targets and row hashes."""
    rows = train.select(
        F.xxhash64(*[F.col(f"`{c}`") for c in train.columns]).alias("id"), F.col(target).cast("double").alias("y"),
        *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(inputs)],
    ).filter("y IS NOT NULL")
    n = len(inputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, block_rows):
                part = batch.slice(at, block_rows)
                values = np.column_stack([part.column(f"x{i}").to_numpy(zero_copy_only=False) for i in range(n)])
                arrays = (binned(values, edges), part.column("y").to_numpy(zero_copy_only=False), part.column("id").to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.num_rows]), *(pa.array([np.ascontiguousarray(a).tobytes()], pa.binary()) for a in arrays)], names=["n", "bins", "y", "ids"]
                )

    return rows.mapInArrow(run, "n long, bins binary, y binary, ids binary")


class _Rows:
    """Blocks of one task with their margins under the trees so far; a lost task makes them again from the trees."""

    def __init__(self, blocks: Iterator[tuple], n_inputs: int, base: float):
        self.blocks = []
        for size, bins, y, ids in blocks:
            arrays = np.frombuffer(bins, np.uint8).reshape(size, n_inputs), np.frombuffer(y), np.frombuffer(ids, np.int64)
            self.blocks.append([*arrays, np.full(size, base)])
        self.trees = 0

    def sums(self, model: "Boosted", tree: int, level: int, spec: BoostSpec) -> np.ndarray | None:
        """Sums of a level of a tree under the trees before it and its splits so far; nothing without rows."""
        columns, total = columns_of(tree, len(model.inputs), spec), None
        for block in self.blocks:
            bins, y, ids, margin = block
            for t in range(self.trees, tree):
                margin = margin + model.weight[t][place(bins, model.feature[t], model.cut[t], model.depth)]
            block[3] = margin
            use = drawn(ids, tree, spec.seed, spec.subsample) if spec.subsample < 1 else slice(None)
            node = place(bins[use], model.feature[tree], model.cut[tree], level)
            found = level_sums(node, bins[use], (margin - y)[use], level, columns, spec.bins)
            total = found if total is None else total + found
        self.trees = tree
        return total


def _kept(fit_id: str, part: int, make) -> _Rows:
    """What a Python worker keeps between the levels of one fit."""
    kept = sys.modules.setdefault("_stocktide_boosting", types.ModuleType("_stocktide_boosting")).__dict__
    if kept.get("fit") != fit_id:
        kept.clear()
        kept["fit"] = fit_id
    if part not in kept:
        kept[part] = make()
    return kept[part]


def grow(model: Boosted, tree: int, spec: BoostSpec, sums_of) -> None:
    """Add a tree, level by level; ``sums_of(tree, level)`` gives a level's sums over all rows."""
    columns = columns_of(tree, len(model.inputs), spec)
    for level in range(spec.depth):
        sums = sums_of(tree, level)
        gain, column, cut, total = best_splits(sums, spec.l2, spec.least_weight)
        first = (1 << level) - 1
        for i in range(1 << level):
            node = first + i
            if level and model.feature[tree, (node - 1) // 2] < 0:
                continue
            if gain[i] > 0:
                model.feature[tree, node], model.cut[tree, node], model.gain[tree, node] = columns[column[i]], cut[i], gain[i]
                left = sums[:, i, column[i], :cut[i] + 1].sum(axis=1)
                for child, s in ((2 * node + 1, left), (2 * node + 2, total[:, i] - left)):
                    model.weight[tree, child] = -spec.learning_rate * s[0] / (s[1] + spec.l2)
            elif not level:
                model.weight[tree, node] = -spec.learning_rate * total[0, i] / (total[1, i] + spec.l2)
        if not (model.feature[tree, first:2 * first + 1] >= 0).any():
            break


def fit(
    train: DataFrame, inputs: list[str], target: str, spec: BoostSpec = BoostSpec(), edges: list[np.ndarray] | None = None,
    block_rows: int = BLOCK_ROWS,
) -> Boosted:
    """Boost ``spec.rounds`` trees of ``spec.depth`` levels on the squared error of ``target``.

    Rows without a target take no part. Gain and leaf weights use ``spec.l2``; a split leaves at least ``spec.least_weight`` of hessian on each side.
    An empty table gives a model that predicts 0. A table of at most ``block_rows`` rows is a single block, and the task that holds
    it needs no sums of others, so it grows all trees; beyond that every level is an aggregation over all tasks. Both
    give the same trees for the same ``edges`` of the bins, which are quantiles where left out.
    """
    spark = train.sparkSession
    n_inputs, n_nodes = len(inputs), 2 ** (spec.depth + 1) - 1
    n, mean = train.agg(F.count(target), F.avg(F.col(target).cast("double"))).first()
    edges = bin_edges(train, inputs, spec.bins) if edges is None else edges
    shape = (spec.rounds if n else 0, n_nodes)
    model = Boosted(inputs, mean or 0.0, edges, np.full(shape, -1), np.zeros(shape, int), np.zeros(shape), np.zeros(shape), spec.depth)
    if not n:
        return model
    one = n <= block_rows
    stored = staged(_blocks(train.coalesce(1) if one else train, inputs, target, edges, block_rows))
    base, empty = model.base, model
    if one:
        def whole(blocks: Iterator[tuple]) -> Iterator[tuple]:
            rows, grown = _Rows(blocks, n_inputs, base), empty
            if rows.blocks:
                for tree in range(spec.rounds):
                    grow(grown, tree, spec, lambda t, level: rows.sums(grown, t, level, spec))
                yield grown.feature, grown.cut, grown.weight, grown.gain

        model.feature, model.cut, model.weight, model.gain = stored.rdd.map(tuple).coalesce(1).mapPartitions(whole).first()
        discard(stored)
        return model
    blocks, fit_id = stored.rdd.map(tuple).persist(), uuid.uuid4().hex

    def sums_of(tree: int, level: int) -> np.ndarray:
        shared = spark.sparkContext.broadcast(model)

        def task(part: int, found: Iterator[tuple]) -> Iterator[np.ndarray]:
            sums = _kept(fit_id, part, lambda: _Rows(found, n_inputs, base)).sums(shared.value, tree, level, spec)
            return iter([] if sums is None else [sums])

        total = blocks.mapPartitionsWithIndex(task).treeReduce(np.add)
        shared.unpersist()
        return total

    for tree in range(spec.rounds):
        grow(model, tree, spec, sums_of)
    blocks.unpersist()
    discard(stored)
    return model
