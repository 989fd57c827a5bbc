"""Bag-of-words embeddings: gradients against differences, windows against loops, planted groups."""

import numpy as np
import pyarrow as pa
import pytest

from jobtide.ml import embeddings as em


def test_step_follows_the_gradient():
    rng = np.random.default_rng(1)
    inner, outer = rng.normal(size=(6, 4)), rng.normal(size=(6, 4))
    context, known = np.array([[1, 2, 2]]), np.array([[True, True, False]])
    centre, drawn = np.array([0]), np.array([[3, 4, 0]])  # the last draw is the centre itself and does not count

    def loss(a, b):
        mean = (a[1] + a[2]) / 2
        log = lambda z: np.log(1 / (1 + np.exp(-z)))
        return -(log(b[0] @ mean) + log(-b[3] @ mean) + log(-b[4] @ mean))

    moved = inner.copy(), outer.copy()
    em.cbow_step(*moved, context, known, centre, drawn, 1e-3)
    for which, (old, new) in enumerate(zip((inner, outer), moved)):
        for at in np.ndindex(old.shape):
            shifted = [inner.copy(), outer.copy()]
            shifted[which][at] += 1e-6
            slope = (loss(*shifted) - loss(inner, outer)) / 1e-6
            # Each word of the context takes the whole step of the mean, as is usual for this method.
            factor = 2 if which == 0 else 1
            assert new[at] - old[at] == pytest.approx(-1e-3 * slope * factor, abs=1e-8)


def test_steps_at_once_equal_steps_one_by_one(monkeypatch):
    """Products over all words, sums of sorted rows and additions one after the other come to the same."""
    rng = np.random.default_rng(2)
    sentence = np.repeat(np.arange(150), rng.integers(1, 9, 150))
    words = rng.integers(0, 9, len(sentence))
    counts = np.bincount(words, minlength=9)
    start = rng.normal(size=(9, 4)), rng.normal(size=(9, 4))
    found = []
    for dense in (em.DENSE_WORDS, 0):
        monkeypatch.setattr(em, "DENSE_WORDS", dense)
        for thin in (0.0, 0.01):
            a, b = start[0].copy(), start[1].copy()
            em.train_block(words, sentence, a, b, counts, 3, thin, (0.05, 0.01), np.random.default_rng(7))
            found.append((a, b))
    assert np.allclose(found[0], found[2], rtol=0, atol=1e-12) and np.allclose(found[1], found[3], rtol=0, atol=1e-12)
    assert not np.allclose(found[0], found[1]) and not np.allclose(found[0], start)

    # The same draws, position after position, with plain additions.
    a, b, rng = start[0].copy(), start[1].copy(), np.random.default_rng(7)
    rng.random(len(words))
    context, known = em.windows(words, sentence, rng.integers(1, 4, len(words)))
    some = np.flatnonzero(known.any(1))
    some = some[rng.permutation(len(some))]
    for at in range(0, len(some), em.BATCH):
        of, olda, oldb = some[at : at + em.BATCH], a.copy(), b.copy()
        drawn = np.searchsorted(em.noise_table(counts), rng.random((len(of), em.NEGATIVE)), "right")
        step = 0.05 - 0.04 * at / len(some)
        for k, others in zip(of, drawn):
            around = context[k][known[k]]
            mean, back = olda[around].mean(0), 0
            for word, label in [(words[k], 1.0)] + [(w, 0.0) for w in others if w != words[k]]:
                error = step * (label - 1 / (1 + np.exp(-oldb[word] @ mean)))
                back = back + error * oldb[word]
                b[word] += error * mean
            for word in around:
                a[word] += back
    assert np.allclose(found[0], (a, b), rtol=0, atol=1e-12)


def test_blocks_hold_the_shares_of_their_sequences():
    """Every copy of a sequence is in one block, of the blocks from its first on; unknown skills are left out."""
    skills = [["b", "a"], ["a", "x"], ["x"], ["c"], ["a", "b", "c"]]
    copies, first, blocks = np.array([7, 1, 9, 2, 23]), np.array([3, 0, 1, 4, 2]), 5
    rows = [row for of in (range(0, 2), range(2, 4), range(4, 5)) for row in em._block_rows(skills, copies, first, pa.array(["a", "b", "c"]), blocks, of)]
    assert [block for block, _, _ in rows] == [0, 1, 2, 3, 4]
    for block, words, lengths in rows:
        want = []
        for of, n, start in sorted(zip(skills, copies.tolist(), first.tolist())):
            held = sum((start + at) % blocks == block for at in range(n)) if n < blocks else n // blocks + ((block - start) % blocks < n % blocks)
            want += [["abc".index(s) for s in of if s != "x"]] * (held if of != ["x"] else 0)
        assert [w.tolist() for w in np.split(words, np.cumsum(lengths)[:-1])] == want


def test_windows_and_noise():
    words, sentence, width = np.array([5, 6, 7, 8, 9]), np.array([0, 0, 0, 1, 1]), np.array([1, 2, 1, 2, 1])
    context, known = em.windows(words, sentence, width)
    got = [sorted(context[i][known[i]].tolist()) for i in range(5)]
    assert got == [[6], [5, 7], [6], [9], [8]]
    table = em.noise_table(np.array([1, 16, 81]))
    assert table == pytest.approx([1 / 36, 9 / 36, 1.0])


def test_planted_groups_are_neighbours(spark):
    rng = np.random.default_rng(3)
    groups = [[f"{g}{i}" for i in range(20)] for g in "abcd"]
    rows = [(rng.choice(groups[rng.integers(4)], 4, replace=False).tolist(),) for _ in range(3_000)]
    df = spark.createDataFrame(rows + [(["once"],), ([],), (None,), (["a0", None],)], "skills array<string>")
    vectors = em.skill2vec(df, vector_size=8, epochs=10, thin=0.0, block_positions=3_000)
    found = {r.skill: np.array(r.vector) for r in vectors.collect()}
    assert set(found) == {s for g in groups for s in g} and all(len(v) == 8 for v in found.values())
    for skill, v in found.items():
        near = sorted((-(v @ w) / np.linalg.norm(v) / np.linalg.norm(w), s) for s, w in found.items() if s != skill)
        assert {s[0] for _, s in near[:5]} == {skill[0]}


def test_repeatable_whatever_the_partitions(spark):
    rows = [([f"s{(i * k) % 7}" for k in (1, 2, 3)],) for i in range(300)] + [(["hot", "s1"],)] * 600
    df = spark.createDataFrame(rows, "skills array<string>")
    first, again = (
        {r.skill: r.vector for r in em.skill2vec(d, vector_size=4, epochs=2, block_positions=200).collect()} for d in (df, df.repartition(13))
    )
    assert first.keys() == again.keys() and all(first[s] == pytest.approx(again[s], abs=1e-12) for s in first)
    assert em.skill2vec(df.limit(0)).collect() == []


def test_without_arrow(spark):
    """A session without Arrow takes no numpy numbers."""
    df = spark.createDataFrame([(["a", "b", "c"],)] * 20, "skills array<string>")
    key = "spark.sql.execution.arrow.pyspark.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        found = {r.skill: r.vector for r in em.skill2vec(df, vector_size=4, epochs=1, thin=0.0, block_positions=10).collect()}
    finally:
        spark.conf.set(key, before)
    assert set(found) == set("abc") and all(len(v) == 4 and any(v) for v in found.values())


def test_block_without_kept_words():
    """A small block may lose all its positions to thinning."""
    empty = np.zeros(0, np.int64)
    context, known = em.windows(empty, empty, empty)
    assert context.shape == known.shape == (0, 0)
