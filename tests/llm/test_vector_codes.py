"""Vector codes against whole integers of Python, and the pieces against plain definitions."""

from hashlib import sha256
from math import floor, isfinite

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobtide.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<double>, label int, code string, Part string, v string"


def expected(rows, entries=256, rounds=4):
    """(vec_id, code, error, label_error, codebooks_sha256) of rows of (vec_id, vector, label)."""
    kept = [
        (i, [min(max(floor(1024 * x), -vc.LARGEST), vc.LARGEST) for x in v], label) for i, v, label in rows
        if v and all(x is not None and isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    dim = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == dim]
    cuts = [dim * k // 4 for k in range(5)]
    split = [[r[1][a:b] for a, b in zip(cuts, cuts[1:])] for r in kept]
    books = [[p[k] for p in split[:entries]] for k in range(4)]

    def nearest(point, book):
        found = [(sum((x - y) ** 2 for x, y in zip(point, entry)), at) for at, entry in enumerate(book)]
        return min(found)

    for _ in range(rounds):
        for k in range(4):
            members = {}
            for p in split:
                members.setdefault(nearest(p[k], books[k])[1], []).append(p[k])
            for at, points in members.items():
                books[k][at] = [sum(c) // len(points) for c in zip(*points)]
    codes = [[nearest(p[k], books[k]) for k in range(4)] for p in split]
    errors = [sum(d for d, _ in c) for c in codes]
    labels = {}
    for r, e in zip(kept, errors):
        labels[r[2]] = labels.get(r[2], 0) + e
    digest = sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    out = [
        (r[0], "".join(f"{at:02x}" for _, at in c), e, labels[r[2]] if labels[r[2]] < 1 << 63 else None, digest)
        for r, c, e in zip(kept, codes, errors)
    ]
    return sorted(out, key=str)


def check(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    out = vc.vector_codes(df, **options)
    assert out.columns == ["vec_id", "embedding", "label", "Part", "v", "code", "error", "label_error", "codebooks_sha256"]
    got = sorted((tuple(r) for r in out.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=str)
    assert got == expected(rows, **options)


def test_random_and_clustered_vectors(spark):
    rng = np.random.default_rng(3)
    spread = rng.normal(size=(500, 16)) / 4
    spread[250:] = spread[rng.integers(0, 30, 250)] + rng.normal(size=(250, 16)) / 500
    check(spark, [(i * 7 % 500, v.tolist(), i % 3 or None) for i, v in enumerate(spread)], entries=40)


def test_ties_copies_and_a_hot_vector(spark):
    rng = np.random.default_rng(4)
    rows = [(i // 2, (rng.integers(-2, 3, 8) / 1024).tolist(), 1) for i in range(700)]
    rows += [(1_000 + i, [0.001] * 8, 2) for i in range(1_500)]
    check(spark, rows, entries=20)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (5, [1.0] * 6, 1), (5, [0.5] * 6, 1), (1, [-1e-9, 0.0, -0.0, 1e-9, 2.0, -2.0], None), (2, None, 1), (3, [], 1), (4, [nan] * 6, 1),
        (6, [inf] * 6, 1), (7, [None] * 6, 1), (8, [1.0, 2.0], 1), (None, [3.0] * 6, None), (9, [1e300, -1e300, 1e5, -1e5, 6e4, 0.1], 7),
        (10, [-1e300] * 6, 7), (0, None, None), (11, [0.25] * 6, 7), (11, [0.25] * 6, 7),
    ]
    check(spark, rows)
    check(spark, rows, entries=2)
    check(spark, [], entries=2)
    check(spark, rows[3:7])


def test_the_curve_visits_neighbours_one_after_the_other():
    for bits, axes in ((1, 3), (3, 2), (2, 3), (2, 4)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), -1).reshape(-1, axes)
        key = vc.hilbert_keys(grid, bits)
        assert sorted(key) == list(range(len(grid)))
        assert (np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(1) == 1).all()


@pytest.mark.parametrize("size", [3, 1_000, 1 << 24, 1 << 26])
def test_kernels_are_exact_and_shortlists_complete(size):
    rng = np.random.default_rng(size)
    points, entries = rng.integers(-size, size + 1, (60, 5)), rng.integers(-size, size + 1, (30, 5))
    entries[7] = entries[3]
    found = vc.distances(points, entries)
    assert found.tolist() == [[sum((int(x) - int(y)) ** 2 for x, y in zip(p, c)) for c in entries] for p in points]
    boxes = points.reshape(-1, 6, 5)
    listed = vc.shortlists(boxes.min(1), boxes.max(1), entries)
    for at, box in enumerate(boxes):
        near = vc.distances(box, entries)
        assert listed[at][(near == near.min(1)[:, None]).any(0)].all()
    assert vc.shortlists(entries[:1], entries[:1], entries)[0].sum() == 1 + (entries[1:] == entries[0]).all(1).sum()


def test_blocks_of_one_entry_use_their_sums(spark):
    """Far tight clusters: no block needs its points in a round."""
    df = spark.createDataFrame([(i, [1000.0 * (i % 4)] * 4, 1) for i in range(400)], "vec_id long, embedding array<double>, label int")
    out = vc.vector_codes(df, entries=4)
    assert {(r.vec_id % 4, r.code, r.error) for r in out.collect()} == {(k, f"{k:02x}" * 4, 0) for k in range(4)}
    assert out.select(F.countDistinct("codebooks_sha256")).first()[0] == 1
