"""Isolation forest: small trees over row samples, grown and applied in Spark tasks."""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from jobtide.operators.features import EMERGENCE_FEATURES
from jobtide.operators.quantiles import quantiles_disc
from jobtide.plans.store import stored

_NODES = "tree int, node int, feature int, threshold double, path_length double"
_HASH_RANGE = 2**31


@dataclass(frozen=True)
class ForestParams:
    """The published forest settings."""

    trees: int = 100
    sample: int = 256
    contamination: float = 0.1
    seed: int = 42
    features: tuple[str, ...] = EMERGENCE_FEATURES


def average_path(n: float) -> float:
    """Mean path length of an unsuccessful search in a binary tree of *n* points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def draw_samples(df: DataFrame, params: ForestParams) -> DataFrame:
    """(tree, order, point): up to ``sample`` rows for each tree, without repeats within a tree.

    A row joins a tree when the hash of row and tree falls below a limit that lets about one and a half samples
    through; the lowest hashes of those are kept. The draw is one pass, depends on the rows alone, and shuffles
    only the drawn rows.
    """
    rows = df.agg(F.count(F.lit(1))).scalar()
    limit = F.least(F.lit(1.0), F.try_divide(F.lit(1.5 * params.sample), rows.cast("double"))) * F.lit(float(_HASH_RANGE))
    hashed = df.select(
        F.array(*[F.col(c).cast("double") for c in params.features]).alias("point"),
        F.xxhash64(F.lit(params.seed), *[F.col(c) for c in df.columns]).alias("row"), limit.alias("limit"),
    )

    def draw(tree: Column) -> Column:
        return F.pmod(F.xxhash64("row", tree), F.lit(_HASH_RANGE))

    chosen = F.filter(F.sequence(F.lit(0), F.lit(params.trees - 1)), lambda tree: draw(tree) < F.col("limit"))
    drawn = hashed.select("point", "row", F.explode(chosen).alias("tree")).withColumn("order", draw(F.col("tree")))
    rank = F.row_number().over(Window.partitionBy("tree").orderBy("order", "row"))
    return drawn.withColumn("_rank", rank).filter(F.col("_rank") <= params.sample).select("tree", "order", "point")


def _grow(points: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple[int, int, float, float]]:
    """Nodes in heap order: (node, feature or -1, threshold, path length at a leaf)."""
    nodes, open_nodes = [], [(0, points)]
    while open_nodes:
        node, part = open_nodes.pop()
        depth = int(math.log2(node + 1))
        low, high = part.min(axis=0), part.max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= max_depth or len(part) <= 1 or len(usable) == 0:
            nodes.append((node, -1, 0.0, depth + average_path(len(part))))
            continue
        feature = int(rng.choice(usable))
        # Below the largest value, which a draw between close values may round to, so that both sides have rows.
        threshold = float(min(rng.uniform(low[feature], high[feature]), np.nextafter(high[feature], low[feature])))
        right = part[:, feature] > threshold
        nodes.append((node, feature, threshold, 0.0))
        open_nodes += [(2 * node + 1, part[~right]), (2 * node + 2, part[right])]
    return nodes


def grow_trees(samples: DataFrame, params: ForestParams) -> DataFrame:
    """One tree per group; a group holds at most ``sample`` rows."""
    depth = math.ceil(math.log2(max(params.sample, 2)))

    def grow(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        tree = int(key[0])
        points = np.stack(group.sort_values("order")["point"].to_numpy())
        rows = _grow(points, np.random.default_rng([params.seed, tree]), depth)
        return pd.DataFrame(
            [(tree, *row) for row in rows], columns=["tree", "node", "feature", "threshold", "path_length"]
        )

    return samples.groupBy("tree").applyInPandas(grow, _NODES)


class IsolationForestModel:
    """Trees as a node table, plus the score above which a row is an outlier."""

    def __init__(self, nodes: DataFrame, params: ForestParams, threshold: float = 0.0) -> None:
        self.nodes, self.params, self.threshold = nodes, params, threshold

    def _arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Node table as arrays; at most trees * (2 * sample) rows reach the driver."""
        table = self.nodes.toPandas()
        width = 2 ** (math.ceil(math.log2(max(self.params.sample, 2))) + 1) - 1
        shape = (self.params.trees, width)
        feature, threshold, path = np.full(shape, -1, dtype=np.int32), np.zeros(shape), np.zeros(shape)
        at = (table["tree"].to_numpy(), table["node"].to_numpy())
        feature[at], threshold[at], path[at] = table["feature"], table["threshold"], table["path_length"]
        return feature, threshold, path

    def isolation(self, df: DataFrame) -> DataFrame:
        """Add ``isolation``: 2^(-mean path / expected path), near 1 for rows that are easy to isolate."""
        arrays = df.sparkSession.sparkContext.broadcast(self._arrays())
        depth = math.ceil(math.log2(max(self.params.sample, 2)))
        expected = average_path(self.params.sample) or 1.0  # a single row is as deep as expected

        @F.pandas_udf(T.DoubleType())
        def score(points: pd.Series) -> pd.Series:
            feature, threshold, path = arrays.value
            matrix = np.stack(points.to_numpy()) if len(points) else np.zeros((0, 1))
            rows = np.arange(len(matrix))
            total = np.zeros(len(matrix))
            for tree in range(feature.shape[0]):
                node = np.zeros(len(matrix), dtype=np.int64)
                for _ in range(depth):
                    split = feature[tree, node]
                    inner = split >= 0
                    right = matrix[rows, np.maximum(split, 0)] > threshold[tree, node]
                    node = np.where(inner, 2 * node + 1 + right, node)
                total += path[tree, node]
            return pd.Series(np.power(2.0, -(total / feature.shape[0]) / expected))

        point = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in self.params.features])
        return df.withColumn("isolation", score(point))

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``anomaly_score`` (positive for outliers) and ``is_outlier``."""
        scored = self.isolation(df).withColumn("anomaly_score", F.col("isolation") - F.lit(self.threshold))
        return scored.withColumn("is_outlier", F.col("anomaly_score") > 0).drop("isolation")


def train_emergence(matrix: DataFrame, params: ForestParams = ForestParams()) -> IsolationForestModel:
    """Fit the forest; the outlier threshold leaves the contamination share of the rows above it.

    A table of fewer rows than a sample is the sample of every tree, and path lengths are compared with those of its size.
    """
    params = replace(params, sample=max(1, min(params.sample, matrix.count())))
    nodes = stored(grow_trees(draw_samples(matrix, params), params), "forest")
    model = IsolationForestModel(nodes, params)
    scores = stored(model.isolation(matrix).select(F.lit(1).alias("_all"), "isolation"), "isolation")
    quantile = quantiles_disc(scores, ["_all"], "isolation", {"limit": str(1 - params.contamination)})
    model.threshold = float(quantile.first()["limit"])
    return model


def emerging_rows(model: IsolationForestModel, matrix: DataFrame, min_growth: float = 0.1) -> DataFrame:
    """Outlying rows with monthly growth."""
    return model.score(matrix).filter(F.col("is_outlier") & (F.col("mom_growth") > min_growth))


def emergence_metrics(model: IsolationForestModel, matrix: DataFrame) -> DataFrame:
    """(metric, value): skills found, the isolation limit, and the limit of the anomaly score (0 by construction)."""
    found = emerging_rows(model, matrix).agg(F.countDistinct("skill").cast("double").alias("n_emerging_detected"))
    row = found.withColumns({"isolation_limit": F.lit(model.threshold), "anomaly_threshold": F.lit(0.0)})
    return row.unpivot([], list(row.columns), "metric", "value")


def emerging_sample(model: IsolationForestModel, matrix: DataFrame, n: int = 10) -> DataFrame:
    return emerging_rows(model, matrix).select("skill").distinct().orderBy("skill").limit(n)
