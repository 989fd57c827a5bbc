"""Second-order gradient boosting on histograms: one distributed aggregation per level of a tree, for several fits at once."""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.session import scratch_path

#: Values of the binned table per task: at most, and (while there are idle cores) at least; and the trees after which the
#: lineage of the rows' state is cut.
VALUES_PER_TASK, LEAST_VALUES, CUT_EVERY = 16_000_000, 4_000_000, 25


@dataclass(frozen=True)
class DemandParams:
    """The published training parameters. ``max_bins`` bounds the histograms."""

    max_iter: int = 200
    max_depth: int = 6
    step_size: float = 0.05
    subsample: float = 0.8
    features_per_tree: float = 0.8
    min_child_weight: float = 3.0
    alpha: float = 0.1
    reg_lambda: float = 1.0
    max_bins: int = 64
    seed: int = 42


@dataclass(frozen=True)
class BoostedTrees:
    """Trees in heap order: ``feature`` is -1 at a leaf; values up to ``threshold`` go left; ``gain`` is that of the split."""

    columns: tuple[str, ...]
    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        depth = int(math.log2(self.feature.shape[1] + 1)) - 1
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                split = feature[node]
                right = x[rows, np.maximum(split, 0)] > threshold[node]
                node = np.where(split >= 0, 2 * node + 1 + right, node)
            total += value[node]
        return total

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``predicted``; NULL inputs count as 0."""
        model = df.sparkSession.sparkContext.broadcast(self)

        @F.pandas_udf("double")
        def predicted(points: pd.Series) -> pd.Series:
            x = np.stack(points.to_numpy()) if len(points) else np.zeros((0, len(model.value.columns)))
            return pd.Series(model.value.predict(x))

        point = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in self.columns])
        return df.withColumn("predicted", predicted(point))

    def importance(self) -> dict[str, float]:
        """Mean gain of the splits on each column, as shares."""
        split = self.feature >= 0
        gain = np.bincount(self.feature[split], self.gain[split], len(self.columns))
        mean = gain / np.maximum(np.bincount(self.feature[split], minlength=len(self.columns)), 1)
        return dict(zip(self.columns, (mean / (mean.sum() or 1.0)).tolist()))

    def save(self, spark: SparkSession, path: str) -> None:
        """A row per node of each tree, and the base and the columns with each."""
        trees, nodes = self.feature.shape
        frame = pd.DataFrame({
            "tree": np.repeat(np.arange(trees), nodes), "node": np.tile(np.arange(nodes), trees), "feature": self.feature.ravel(),
            "threshold": self.threshold.ravel(), "value": self.value.ravel(), "gain": self.gain.ravel(), "base": self.base,
        })
        schema = "tree int, node int, feature int, threshold double, value double, gain double, base double"
        table = spark.createDataFrame(frame.astype({"tree": "int32", "node": "int32", "feature": "int32"}), schema)
        table.withColumn("columns", F.array(*[F.lit(c) for c in self.columns])).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostedTrees:
        table = spark.read.parquet(path).orderBy("tree", "node")
        frame = table.drop("columns").toPandas()  # trees times nodes, as they were saved
        shape = (int(frame["tree"].max()) + 1, int(frame["node"].max()) + 1)
        part = {name: frame[name].to_numpy().reshape(shape) for name in ("feature", "threshold", "value", "gain")}
        return BoostedTrees(tuple(table.select("columns").first()[0]), float(frame["base"].iloc[0]), **part)


def _mixed(rows: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """A uniform number in [0, 1) per row and tree from the row's hash, so that a draw depends on nothing else."""
    with np.errstate(over="ignore"):
        z = rows + np.uint64(0x9E3779B97F4A7C15) * np.uint64(tree + 1) + np.uint64(seed)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / 2.0**53


def soft(gradient: np.ndarray, alpha: float) -> np.ndarray:
    return np.sign(gradient) * np.maximum(np.abs(gradient) - alpha, 0.0)


def leaf_value(gradient: np.ndarray, hessian: np.ndarray, p: DemandParams) -> np.ndarray:
    return -p.step_size * soft(gradient, p.alpha) / (hessian + p.reg_lambda)


def best_splits(sums: np.ndarray, p: DemandParams) -> tuple[np.ndarray, ...]:
    """(gain, feature, bin, left gradient, left hessian) per node from its (2, features, bins) of gradients and hessians.

    Equal gains go to the first feature, then to the lowest bin. A gain of 0 means that no split is allowed.
    """
    left = sums.cumsum(3)[..., :-1]
    total = sums.sum(3)[:, :, :1, None]
    right = total - left

    def score(part: np.ndarray) -> np.ndarray:
        return soft(part[:, 0], p.alpha) ** 2 / (part[:, 1] + p.reg_lambda)

    with np.errstate(divide="ignore", invalid="ignore"):  # empty sides, which are not allowed below
        gain = score(left) + score(right) - score(total)
    allowed = (left[:, 1] >= p.min_child_weight) & (right[:, 1] >= p.min_child_weight)
    gain = np.where(allowed & (gain > 1e-6), gain, 0.0).reshape(len(sums), -1)
    best = gain.argmax(1)
    feature, cut = np.divmod(best, left.shape[3])
    at = np.arange(len(sums))
    return gain[at, best], feature, cut, left[at, 0, feature, cut], left[at, 1, feature, cut]


def decided(sums: np.ndarray, p: DemandParams) -> np.ndarray:
    """One row per node: what :func:`best_splits` finds, then the node's gradient and hessian."""
    return np.stack([*best_splits(sums, p), *sums[:, :, 0].sum(2).T], 1)


def _walk(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, depth: int) -> np.ndarray:
    """Node of each row after *depth* steps down a tree whose splits are on bins."""
    node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
    for _ in range(depth):
        split = feature[node]
        right = bins[rows, np.maximum(split, 0)] > cut[node]
        node = np.where(split >= 0, 2 * node + 1 + right, node)
    return node


def fit_boosted(
    df: DataFrame, columns: Sequence[str], label: str, params: DemandParams = DemandParams(), fits: Sequence[Column] | None = None
) -> list[BoostedTrees]:
    """Squared-error boosting; one model for each condition in *fits* (default: one over all rows).

    All fits share every pass: a pass reads the binned rows once and sums gradients and hessians by (fit, node, feature,
    bin) into arrays of bounded size. These are added up, and the splits chosen, in tasks by (fit, node); the driver sees
    seven numbers per node and sends back the splits. A model is the same as if it were fitted alone: cuts are the quantiles of its own rows, a row
    is drawn for a tree by a hash of the row and the tree, and columns are drawn per tree by the seed.

    This is one of the few loops that DataFrames do not fit: rows keep a running prediction per fit, a tree needs
    *max_depth* passes over it, and each pass is one short job over cached numpy blocks. The state is cut from its lineage
    by a reliable checkpoint every few trees; a lost executor costs the passes since then.
    """
    spark, p, columns = df.sparkSession, params, tuple(columns)
    conditions = [F.coalesce(c, F.lit(False)) for c in (fits if fits is not None else [F.lit(True)])]
    values = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns]
    prepared = df.where(F.col(label).isNotNull()).select(
        F.array(*values).alias("x"), F.col(label).cast("double").alias("y"), F.xxhash64(*columns, label).alias("row"),
        F.array(*conditions).alias("fits"),
    )
    # Quantiles as cuts: exact up to the stated accuracy of rows, one pass for all fits and columns.
    shares = F.array(*[F.lit(i / p.max_bins) for i in range(1, p.max_bins)])
    aggregates = []
    for k in range(len(conditions)):
        member = F.col("fits")[k]
        aggregates += [F.avg(F.when(member, F.col("y"))).alias(f"base{k}")]
        aggregates += [F.percentile_approx(F.when(member, F.col("x")[i]), shares, 10_000).alias(f"c{k}_{i}") for i in range(len(columns))]
    summary = prepared.agg(F.count(F.lit(1)).alias("n"), *aggregates).first()
    base = [summary[f"base{k}"] for k in range(len(conditions))]
    if any(b is None for b in base):
        raise ValueError("a fit without rows")
    cuts = [[np.unique(summary[f"c{k}_{i}"]) for i in range(len(columns))] for k in range(len(conditions))]

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
            y = batch.column("y").to_numpy()
            member = batch.column("fits").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).T
            bins = np.stack([
                np.stack([np.searchsorted(edge, x[:, i], "left") for i, edge in enumerate(of)], 1).astype(np.uint8) for of in cuts
            ])
            margin = np.repeat(np.array(base)[:, None], len(y), 1)
            block = (bins, y, batch.column("row").to_numpy().view(np.uint64), member, margin)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(block)], pa.binary())], ["block"])

    context, size = spark.sparkContext, summary["n"] * len(columns) * len(conditions)
    tasks = max(math.ceil(size / VALUES_PER_TASK), min(context.defaultParallelism, math.ceil(size / LEAST_VALUES)), 1)
    packed = prepared.repartition(tasks).mapInArrow(blocks, "block binary")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_path(spark, "boosting"))
    state = packed.rdd.map(lambda row: pickle.loads(row["block"])).persist(StorageLevel.MEMORY_AND_DISK)

    nodes, inner = 2 ** (p.max_depth + 1) - 1, 2**p.max_depth - 1
    shape = (len(conditions), p.max_iter, nodes)
    feature, bin_cut = np.full(shape, -1, np.int32), np.zeros(shape, np.int32)
    value, gain = np.zeros(shape), np.zeros(shape)
    drawn = max(1, int(p.features_per_tree * len(columns)))
    bins_at_most = max(len(edge) for of in cuts for edge in of) + 1
    rng = np.random.default_rng(p.seed)
    old = []
    for tree in range(p.max_iter):
        chosen = np.sort(rng.permutation(len(columns))[:drawn])
        open_nodes = [np.array([0]) for _ in conditions]
        for level in range(p.max_depth):
            slots = [np.full(nodes, -1) for _ in conditions]
            for k, some in enumerate(open_nodes):
                slots[k][some] = np.arange(len(some))
            if not any(len(some) for some in open_nodes):
                break
            step = (tree, level, chosen, slots, feature[:, tree, :inner].copy(), bin_cut[:, tree, :inner].copy(), [len(some) for some in open_nodes])

            def histogram(parts: Iterable, step: tuple = step) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
                tree, level, chosen, slots, split, cut, sizes = step
                out = [np.zeros((size, 2, len(chosen), bins_at_most)) for size in sizes]
                for bins, y, row, member, margin in parts:
                    sampled = _mixed(row, tree, p.seed) < p.subsample
                    for k, sums in enumerate(out):
                        of = np.flatnonzero(member[k] & sampled)
                        slot = slots[k][_walk(bins[k][of], split[k], cut[k], level)] if level else np.zeros(len(of), np.int64)
                        of, slot = of[slot >= 0], slot[slot >= 0]
                        place = (slot[:, None] * len(chosen) + np.arange(len(chosen))) * bins_at_most + bins[k][np.ix_(of, chosen)]
                        gradient = np.repeat(margin[k][of] - y[of], len(chosen))
                        length = sums.shape[0] * len(chosen) * bins_at_most
                        sums[:, 0] += np.bincount(place.ravel(), gradient, length).reshape(-1, len(chosen), bins_at_most)
                        sums[:, 1] += np.bincount(place.ravel(), minlength=length).reshape(-1, len(chosen), bins_at_most)
                yield from (((k, slot), node) for k, sums in enumerate(out) for slot, node in enumerate(sums))

            summed = state.mapPartitions(histogram)
            if state.getNumPartitions() > 1:  # one task has the whole sums already
                summed = summed.reduceByKey(np.add, min(state.getNumPartitions(), sum(step[-1])))
            answers = dict(summed.mapValues(lambda node: decided(node[None], p)[0]).collect())  # seven numbers per fit and node
            for k, some in enumerate(open_nodes):
                if not len(some):
                    continue
                won, which, cut, g_left, h_left, g, h = np.stack([answers[k, slot] for slot in range(len(some))], 1)
                which, cut = which.astype(np.int64), cut.astype(np.int64)
                if level == 0:  # a tree of one leaf, unless it is split
                    value[k, tree, 0] = leaf_value(g[0], h[0], p)
                split = some[won > 0]
                at = np.flatnonzero(won > 0)
                feature[k, tree, split], bin_cut[k, tree, split], gain[k, tree, split] = chosen[which[at]], cut[at], won[at]
                value[k, tree, 2 * split + 1] = leaf_value(g_left[at], h_left[at], p)
                value[k, tree, 2 * split + 2] = leaf_value(g[at] - g_left[at], h[at] - h_left[at], p)
                open_nodes[k] = np.sort(np.concatenate([2 * split + 1, 2 * split + 2]))
        grown = (feature[:, tree].copy(), bin_cut[:, tree].copy(), value[:, tree].copy())

        def updated(block: tuple, grown: tuple = grown) -> tuple:
            bins, y, row, member, margin = block
            split, cut, worth = grown
            leaf = [worth[k][_walk(bins[k], split[k], cut[k], p.max_depth)] for k in range(len(bins))]
            return bins, y, row, member, margin + np.stack(leaf)

        if tree + 1 < p.max_iter:
            old.append(state)
            state = state.map(updated).persist(StorageLevel.MEMORY_AND_DISK)
            if (tree + 1) % CUT_EVERY == 0:
                state.checkpoint()
            while len(old) > 2:  # the state before the last is read no more
                old.pop(0).unpersist()
    for rdd in [*old, state]:
        rdd.unpersist()

    threshold = np.zeros(shape)
    for k in range(len(conditions)):
        padded = np.zeros((len(columns), bins_at_most))
        for i, edge in enumerate(cuts[k]):
            padded[i, : len(edge)] = edge
        threshold[k] = np.where(feature[k] >= 0, padded[np.maximum(feature[k], 0), bin_cut[k]], 0.0)
    for k in range(len(conditions)):  # only leaves carry a value
        value[k][feature[k] >= 0] = 0.0
    return [BoostedTrees(columns, float(base[k]), feature[k], threshold[k], value[k], gain[k]) for k in range(len(conditions))]
