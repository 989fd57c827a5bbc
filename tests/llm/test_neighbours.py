"""Neighbours by inner product against all pairs."""

import numpy as np
import pytest

from jobtide.llm import neighbours
from jobtide.llm.neighbours import Best, Index, nearest_neighbours

SCHEMA = "vec_id long, embedding array<double>, rank string, score string, rid string"


def exact(rows, n=20, modulus=20):
    """(query row, [(score, vec_id, row)]) over (vec_id, vector) rows."""
    kept = [(at, i, np.array(v)) for at, (i, v) in enumerate(rows)]
    out = {}
    for at, i, v in kept:
        if i is not None and i % modulus == 0:
            found = sorted((-(v * w).sum(), j is None, j, b) for b, j, w in kept if b != at)
            out.setdefault(i, []).append([(j, -minus) for minus, _, j, _ in found[:n]])
    return out


def answers(spark, rows, **options):
    got = {}
    for r in nearest_neighbours(spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA), **options).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return {key: [(v, s) for _, v, s in sorted(found, key=lambda f: f[0])] for key, found in got.items()}


def test_few_rows_are_all_returned(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=5).tolist()) for i in range(15)]
    assert answers(spark, rows, query_modulus=5) == {key: found[0] for key, found in exact(rows, modulus=5).items()}
    assert answers(spark, rows[:1]) == {} and answers(spark, []) == {}


def test_odd_rows_ties_and_copies(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 7 - 3), float(i % 3), -0.0]) for i in range(1, 200)] + [(20, [1.0, 1.0, 0.0]), (20, [1.0, 1.0, 0.0]), (None, [2.0, 2.0, 0.0])]
    rows = [r for r in rows if any(r[1])]
    odd = [(40, None), (60, []), (80, [nan, 1.0, 1.0]), (80, [inf, 1.0, 1.0]), (80, [None, 1.0, 1.0]), (80, [0.0, 0.0, 0.0]), (100, [1.0, 2.0])]
    want = exact(rows)
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows + odd], SCHEMA)
    got = {}
    for r in nearest_neighbours(df).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == set(want)
    for key, lists in want.items():
        flat = sorted((at + 1, v, s) for found in lists for at, (v, s) in enumerate(found) if v is not None)
        assert sorted(g for g in got[key] if g[1] is not None) == flat


@pytest.mark.parametrize("kind", ["spread", "clusters", "norms", "copies"])
def test_recall(spark, kind):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(3_000, 24))
    if kind == "clusters":
        x = x[rng.integers(0, 60, 3_000)] + rng.normal(size=x.shape) / 5
    if kind == "norms":
        x *= np.exp(rng.normal(size=(3_000, 1)) * 3)
    if kind == "copies":
        x[rng.permutation(3_000)[:1_000]] = x[0]
        x[rng.permutation(3_000)[:500]] = x[0] + rng.normal(size=(500, 24)) / 1e4
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got, want = answers(spark, rows), exact(rows)
    assert set(got) == set(want) and all(len(found) == 20 for found in got.values())
    hits = sum(len({v for v, _ in got[i]} & {v for v, _ in want[i][0]}) for i in want)
    assert hits >= 0.9 * 20 * len(want)
    for i, found in got.items():
        assert found == sorted(found, key=lambda f: (-f[1], f[0]))
        assert all(s == pytest.approx((x[i] * x[v]).sum(), abs=1e-12 * np.abs(x).max() ** 2) and v != i for v, s in found)


def test_probes_come_in_the_order_of_their_estimate():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(5, 6))
    norms = np.linalg.norm(x, axis=1)
    short, whole = (Index({0: 1.0}, 1, 3, probes, 0.4, 9).sequence(0, x, norms) for probes in (20, 16**3))
    assert (short == whole[:, :20]).all()
    assert all(len(set(row[row >= 0])) == (row >= 0).sum() for row in whole)
    # The bucket that holds most of many neighbours of the expected cosine is visited first.
    index, q = Index({0: 1.0}, 1, 3, 1, 0.4, 9), x[:1] / norms[0]
    noise = rng.normal(size=(200_000, 6))
    noise -= (noise @ q.T) * q
    near = 0.4 * q + np.sqrt(1 - 0.4**2) * noise / np.linalg.norm(noise, axis=1)[:, None]
    codes, counts = np.unique(index.codes(0, near, np.ones(len(near)), np.zeros(len(near), int)), return_counts=True)
    first = dict(zip(codes, counts)).get(index.sequence(0, q, np.ones(1))[0, 0], 0)
    assert first >= 0.7 * counts.max()


def test_best_of_the_visited_buckets_only():
    rng = np.random.default_rng(5)
    q, r = rng.integers(-2, 3, (40, 4)).astype(float), rng.integers(-2, 3, (3_000, 4)).astype(float)
    code, ids = rng.integers(0, 30, 3_000), rng.permutation(3_000)
    probes = [None if at % 10 == 0 else rng.permutation(30)[:8].tolist() for at in range(40)]
    best = Best(np.arange(40) + 100, q, probes, 7)
    for c in rng.permutation(30):
        of = np.flatnonzero(code == c)
        for part in np.array_split(of, 3):
            best.meet(c, r[part], part, ids[part])
    best.settle()
    a, v, score, least = best.found
    for k in range(40):
        visited = [j for j in range(3_000) if probes[k] is None or code[j] in probes[k]]
        want = sorted((-(q[k] * r[j]).sum(), ids[j], j) for j in visited)[:7]
        assert [(-s, i, j) for s, i, j in zip(score[a == k], least[a == k], v[a == k])] == want


def test_whoever_finds_too_few_is_compared_with_all(spark, monkeypatch):
    """One probe of one table with many hash functions finds few rows; still every query gets its number, exactly."""
    calls, scored = [], neighbours._scored
    monkeypatch.setattr(neighbours, "_scored", lambda *given: calls.append(1) or scored(*given))
    monkeypatch.setattr(neighbours, "_fitted", lambda *given: Index({0: 1.0}, 1, 8, 1, 0.9, 3))
    rng = np.random.default_rng(11)
    x = rng.normal(size=(2_000, 12))
    x /= np.linalg.norm(x, axis=1)[:, None] * 1.001
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got, want = answers(spark, rows, tables=1), exact(rows)
    assert set(got) == set(want) and all(len(found) == 20 for found in got.values())
    assert len(calls) == 2
    assert all([v for v, _ in got[i]] == [v for v, _ in want[i][0]] for i in want)
