"""Skill clusters from mean feature vectors: k-means with all starts in one pass per step."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobtide.ml.demand import scale_features
from jobtide.operators.features import FEATURES
from jobtide.plans.store import stored


def skill_profiles(matrix: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Mean of every feature per skill."""
    return matrix.groupBy("skill").agg(*[F.avg(c).alias(c) for c in columns])


@dataclass(frozen=True)
class KMeansFit:
    """Centres (starts x k x features) after the last step, squared distances summed per start, and the best start."""

    centres: np.ndarray
    costs: np.ndarray
    steps: int

    @property
    def best(self) -> int:
        return int(self.costs.argmin())


def _nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the nearest centre; ties to the lower index."""
    found = ((points[:, None, :] - centres[None]) ** 2).sum(2)
    best = found.argmin(1)
    return best, found[np.arange(len(points)), best]


def fit_kmeans(points: DataFrame, key: str, vector: str, k: int, starts: int, seed: int, max_iter: int) -> KMeansFit:
    """Lloyd steps for all starts at once: one scan, and one row per (start, centre) at the driver, for each step.

    A start begins with the *k* rows of the least md5 of key, start and seed, so it depends on nothing else. An empty cluster
    keeps its centre. Steps end when no centre moves, or after *max_iter*. With fewer than *k* rows there are as many centres
    as rows.
    """
    word = F.md5(F.concat_ws(":", F.col(key), F.col("start").cast("string"), F.lit(str(seed))).cast("binary"))
    order = Window.partitionBy("start").orderBy(word, key)
    chosen = points.select(key, vector, F.explode(F.sequence(F.lit(0), F.lit(starts - 1))).alias("start"))
    chosen = chosen.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    first = sorted(((r["start"], r["place"], r[vector]) for r in chosen.collect()), key=lambda r: r[:2])  # starts times k rows
    if not first:
        return KMeansFit(np.zeros((starts, 0, 0)), np.zeros(starts), 0)
    centres = np.array([v for _, _, v in first], np.float64).reshape(starts, -1, len(first[0][2]))
    schema = "start int, centre int, n long, cost double, total array<double>"

    def summed(now: np.ndarray) -> list:
        def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, cost, total = np.zeros(now.shape[:2], np.int64), np.zeros(now.shape[:2]), np.zeros(now.shape)
            for batch in batches:
                x = batch.column(vector).flatten().to_numpy().reshape(batch.num_rows, -1)
                for start in range(len(now) if batch.num_rows else 0):
                    best, distance = _nearest(x, now[start])
                    n[start] += np.bincount(best, minlength=now.shape[1])
                    cost[start] += np.bincount(best, distance, now.shape[1])
                    np.add.at(total[start], best, x)
            at = np.argwhere(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at[:, 0].astype(np.int32)), pa.array(at[:, 1].astype(np.int32)), pa.array(n[n > 0]), pa.array(cost[n > 0]),
                 pa.array(list(total[n > 0]), pa.list_(pa.float64()))],
                ["start", "centre", "n", "cost", "total"],
            )

        sums = [F.sum(F.get("total", F.lit(i))).alias(f"t{i}") for i in range(now.shape[2])]
        parts = points.select(vector).mapInArrow(partial, schema).groupBy("start", "centre")
        return parts.agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"), *sums).collect()

    steps, rows = 0, summed(centres)
    while steps < max_iter:
        moved = centres.copy()
        for row in rows:
            moved[row["start"], row["centre"]] = np.array(row[4:]) / row["n"]
        steps += 1
        if (moved == centres).all():
            break
        centres, rows = moved, summed(moved)
    costs = np.zeros(starts)
    for row in rows:
        costs[row["start"]] += row["cost"]
    return KMeansFit(centres, costs, steps)


def train_clusters(
    matrix: DataFrame, k: int = 8, starts: int = 10, seed: int = 42, columns: Sequence[str] = FEATURES, max_iter: int = 20
) -> DataFrame:
    """(skill, cluster): the best of *starts* k-means runs over the profiles, which take their steps together.

    The profiles have their own scaler, so the one of the demand model stays as it was fitted.
    """
    profiles = stored(skill_profiles(matrix, columns), "profiles")
    scaled = scale_features(profiles, columns).transform(profiles)
    scaled = stored(scaled.select("skill", vector_to_array("features").alias("point")), "scaled")
    fit = fit_kmeans(scaled, "skill", "point", k, starts, seed, max_iter)
    centres = fit.centres[fit.best]

    def assigned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("point").flatten().to_numpy().reshape(batch.num_rows, centres.shape[1])
            found = _nearest(x, centres)[0] if len(x) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("skill"), pa.array(found.astype(np.int32))], ["skill", "cluster"])

    return scaled.mapInArrow(assigned, "skill string, cluster int")


def cluster_profiles(clusters: DataFrame) -> DataFrame:
    """(cluster, count, skills); skills are the distinct vocabulary, so the lists are bounded by it."""
    return clusters.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("count"), F.array_sort(F.collect_list("skill")).alias("skills")
    )
