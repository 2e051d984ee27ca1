"""Isolation forest fitted and applied as Spark jobs.

Each tree sees a few hundred rows. Every tree draws them from all rows by hash inside the scan, so only a few times
``max_samples`` rows per tree are shuffled, and grows in a group of its own. The model is a table of nodes (at most
trees × (2 · max_samples − 1) rows, whatever the data size), which is what gets broadcast for scoring.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocktide.config import ForestSpec
from stocktide.operators.features import online_anomaly_features
from stocktide.operators.selection import kth_smallest
from stocktide.schemas import ANOMALY_COLUMNS, FEATURE_KEY
from stocktide.storage import discard, staged

NODES = "tree INT, node INT, feature INT, split DOUBLE, left INT, right INT, size INT, depth INT"
_EULER_GAMMA = 0.5772156649015329
# Rows expected below a tree's limit, per sampled row: too few for a sample only with a chance of nothing.
DRAWS_PER_SAMPLE = 4


def average_path(n: np.ndarray | int) -> np.ndarray:
    """Mean depth of an unsuccessful search among ``n`` rows of a binary tree."""
    n = np.asarray(n, dtype=float)
    m = np.maximum(n - 1, 1)
    return np.where(n > 2, 2 * (np.log(m) + _EULER_GAMMA) - 2 * m / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def grow_tree(values: np.ndarray, seed: int) -> list[tuple]:
    """Random splits until rows are alone, equal, or at the depth limit; nodes as (id, feature, split, left, right, size, depth)."""
    rng = np.random.default_rng(seed)
    limit = max(1, math.ceil(math.log2(max(len(values), 2))))
    nodes: list[tuple] = []
    pending = [(0, values, 0)]
    next_id = 1
    while pending:
        node, rows, depth = pending.pop()
        lo, hi = rows.min(axis=0), rows.max(axis=0)
        usable = np.flatnonzero(hi > lo)
        if depth >= limit or len(rows) <= 1 or not len(usable):
            nodes.append((node, -1, 0.0, -1, -1, len(rows), depth))
            continue
        feature = int(rng.choice(usable))
        # Below the maximum, so that both sides keep rows even when the values are one rounding step apart.
        split = min(float(rng.uniform(lo[feature], hi[feature])), float(np.nextafter(hi[feature], lo[feature])))
        goes_left = rows[:, feature] <= split
        left, right = next_id, next_id + 1
        next_id += 2
        nodes.append((node, feature, split, left, right, len(rows), depth))
        pending += [(left, rows[goes_left], depth + 1), (right, rows[~goes_left], depth + 1)]
    return nodes


class NodeArrays:
    """All trees as flat arrays. A leaf leads to itself, so every walk can take the same number of steps."""

    def __init__(self, nodes: pd.DataFrame):
        nodes = nodes.sort_values(["tree", "node"])
        per_tree = nodes.groupby("tree").size().to_numpy()
        self.roots = np.concatenate([[0], np.cumsum(per_tree)[:-1]])
        base = np.repeat(self.roots, per_tree)
        here = np.arange(len(nodes))
        leaf = nodes["feature"].to_numpy() < 0
        self.feature = np.where(leaf, 0, nodes["feature"].to_numpy())
        self.split = nodes["split"].to_numpy(dtype=float)
        self.left = np.where(leaf, here, base + nodes["left"].to_numpy())
        self.right = np.where(leaf, here, base + nodes["right"].to_numpy())
        self.reached = nodes["depth"].to_numpy() + average_path(nodes["size"].to_numpy())
        self.steps = int(nodes["depth"].max())
        self.sample_size = int(nodes.loc[nodes["node"] == 0, "size"].max())

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Score in (0, 1] per row; close to 1 means isolated after few splits."""
        at = np.tile(self.roots, (len(x), 1))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.steps):
            at = np.where(x[rows, self.feature[at]] <= self.split[at], self.left[at], self.right[at])
        depth = self.reached[at].mean(axis=1)
        return np.power(2.0, -depth / max(float(average_path(self.sample_size)), 1e-9))


def _unit_hash(seed: Column | int, columns: list[str]) -> Column:
    """Repeatable number in [0, 1) per row and seed."""
    seed = F.lit(seed) if isinstance(seed, int) else seed
    return F.pmod(F.xxhash64(seed, *columns), F.lit(2**53)) / F.lit(float(2**53))


def tree_draws(rows: DataFrame, spec: ForestSpec, key: list[str], limit: float) -> DataFrame:
    """Each row once per tree in which its draw is below ``limit``, with ``tree`` and ``_draw``.

    A row has one hash u in [0, 1); its draw in tree t is the fractional part of u + t / trees. That is uniform for
    every tree, and the few trees below the limit follow from u, without a hash per tree.
    """
    at = _unit_hash(spec.seed, key) * spec.trees
    inside = at - F.floor(at)
    count = F.least(F.ceil(F.lit(min(limit, 1.0) * spec.trees) - inside), F.lit(spec.trees)).cast("int")
    steps = F.when(count > 0, F.sequence(F.lit(0), count - 1))  # NULL, and so no row, where no tree draws it
    return rows.withColumn("_step", F.explode(steps)).withColumns({
        "tree": F.pmod(F.col("_step") - F.floor(at).cast("int"), F.lit(spec.trees)).cast("int"),
        "_draw": (inside + F.col("_step")) / spec.trees,
    }).drop("_step")


def fit_forest(
    features: DataFrame,
    spec: ForestSpec = ForestSpec(),
    columns: list[str] | None = None,
    key: list[str] | None = None,
) -> DataFrame:
    """Node table of a forest over ``columns``. Rows flagged ``is_injected_anomaly`` are not trained on.

    ``key`` identifies a row; sampling hashes it, so the same table gives the same forest. A tree takes the
    ``max_samples`` rows with the smallest draws (``tree_draws``) of the whole table.
    """
    columns, key = columns or ANOMALY_COLUMNS, key or FEATURE_KEY
    rows = features
    if "is_injected_anomaly" in features.columns:
        rows = rows.filter(~F.coalesce(F.col("is_injected_anomaly"), F.lit(False)))
    rows = rows.select(*key, *[F.col(c).cast("double").alias(c) for c in columns])
    n = max(1, rows.count())
    draw = Window.partitionBy("tree").orderBy("_draw", *key)
    drawn = (
        tree_draws(rows, spec, key, DRAWS_PER_SAMPLE * spec.max_samples / n)
        .withColumn("_rank", F.row_number().over(draw))
        .filter(F.col("_rank") <= spec.max_samples)
        .select("tree", "_rank", *columns)
    )
    seed = spec.seed

    def grow(sample: pd.DataFrame) -> pd.DataFrame:
        tree = int(sample["tree"].iloc[0])
        values = sample.sort_values("_rank")[columns].to_numpy(dtype=float)
        grown = grow_tree(values, seed * 100_003 + tree)
        out = pd.DataFrame(grown, columns=["node", "feature", "split", "left", "right", "size", "depth"])
        out.insert(0, "tree", tree)
        return out

    return drawn.groupBy("tree").applyInPandas(grow, NODES)


class Forest:
    """Nodes on the driver (bounded by the forest settings) with the score cut for anomalies."""

    def __init__(self, nodes: pd.DataFrame, cut: float, columns: list[str]):
        self.nodes, self.cut, self.columns = nodes, cut, columns

    @classmethod
    def fit(cls, features: DataFrame, spec: ForestSpec = ForestSpec(), columns: list[str] | None = None) -> Forest:
        """Fit, then cut at the ``contamination`` share of the training rows' scores: exactly the score of that rank."""
        columns = columns or ANOMALY_COLUMNS
        forest = cls(fit_forest(features, spec, columns).toPandas(), 1.0, columns)
        train = features
        if "is_injected_anomaly" in features.columns:
            train = features.filter(~F.coalesce(F.col("is_injected_anomaly"), F.lit(False)))
        scored = staged(forest.score(train.select(*columns)).select("anomaly_score"))
        n = scored.count()
        cut = kth_smallest(scored, "anomaly_score", max(1, math.ceil(round((1 - spec.contamination) * n, 6))))
        forest.cut = 1.0 if cut is None else cut
        discard(scored)
        return forest

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``anomaly_score``."""
        shared = df.sparkSession.sparkContext.broadcast(NodeArrays(self.nodes))

        @F.pandas_udf("double")
        def score_batch(features: pd.DataFrame) -> pd.Series:
            return pd.Series(shared.value.scores(features.to_numpy(dtype=float)))

        inputs = F.struct(*[F.col(c).cast("double").alias(c) for c in self.columns])
        return df.withColumn("anomaly_score", score_batch(inputs))

    def predict(self, df: DataFrame) -> DataFrame:
        """Add ``anomaly_score`` and ``prediction``: −1 for anomalies, 1 for normal rows."""
        return self.score(df).withColumn(
            "prediction", F.when(F.col("anomaly_score") > self.cut, -1).otherwise(1)
        )

    def predict_online(self, rows: DataFrame) -> DataFrame:
        """Predict rows that have no history: missing inputs take defaults, z-scores are 0."""
        scored = self.predict(online_anomaly_features(rows))
        return scored.select(*rows.columns, "anomaly_score", "prediction")

    def save(self, spark, path: str) -> None:
        """Write the node table with the cut; a forest is a few ten thousand rows at most."""
        spark.createDataFrame(self.nodes, NODES).withColumn("cut", F.lit(float(self.cut))).withColumn(
            "columns", F.lit(",".join(self.columns))
        ).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark, path: str) -> Forest:
        table = spark.read.schema(NODES + ", cut DOUBLE, columns STRING").parquet(path).toPandas()
        return cls(table.drop(columns=["cut", "columns"]), float(table["cut"].iloc[0]), table["columns"].iloc[0].split(","))
