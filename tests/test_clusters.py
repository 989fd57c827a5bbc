"""k-means of several starts at once against one after the other in numpy."""

import hashlib

import numpy as np
import pytest

from jobtide.ml import clusters


def alone(names, x, k, start, seed, max_iter):
    word = lambda name: (hashlib.md5(f"{name}:{start}:{seed}".encode()).hexdigest(), name)
    centres = x[[names.index(n) for n in sorted(names, key=word)[:k]]].copy()
    for _ in range(max_iter):
        nearest = ((x[:, None] - centres) ** 2).sum(2).argmin(1)
        moved = np.array([x[nearest == c].mean(0) if (nearest == c).any() else centres[c] for c in range(len(centres))])
        if np.allclose(moved, centres, atol=0):
            break
        centres = moved
    return centres, ((x[:, None] - centres) ** 2).sum(2).min(1).sum()


@pytest.mark.parametrize("rows, k", [(200, 6), (30, 8), (5, 8)])
def test_starts_equal_separate_runs(spark, rows, k):
    rng = np.random.default_rng(rows)
    x = np.round(rng.normal(size=(rows, 3)) + 4 * rng.integers(0, 3, (rows, 1)), 2)
    names = [f"s{i}" for i in range(rows)]
    df = spark.createDataFrame(list(zip(names, x.tolist())), "skill string, point array<double>").repartition(5)
    fit = clusters.fit_kmeans(df, "skill", "point", k, 4, 7, 15)
    for start in range(4):
        centres, cost = alone(names, x, k, start, 7, 15)
        assert fit.centres[start] == pytest.approx(centres) and fit.costs[start] == pytest.approx(cost, abs=1e-9)
    assert fit.costs[fit.best] == fit.costs.min()


def test_no_rows(spark):
    df = spark.createDataFrame([], "skill string, point array<double>")
    assert clusters.fit_kmeans(df, "skill", "point", 3, 2, 1, 5).steps == 0
