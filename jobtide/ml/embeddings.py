"""Skill embeddings and similarity search."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.plans.store import stored

#: The usual settings of the method (words drawn against each, power of the frequency for the draw, share
#: above which words are thinned out, step sizes of the first and the last position).
NEGATIVE, NOISE_POWER, THIN_ABOVE, FIRST_STEP, LAST_STEP = 5, 0.75, 1e-3, 0.025, 1e-4
#: Positions whose gradients are taken at the same vectors.
BATCH = 64
#: Words up to which a step is made of matrix products over all of them; blocks that are packed together.
DENSE_WORDS, CHUNK = 128, 16
_BLOCK = pa.schema([("block", pa.int64()), ("words", pa.binary()), ("lengths", pa.binary())])


def noise_table(counts: np.ndarray) -> np.ndarray:
    """Cumulated shares of the words by which others are drawn: frequency to the power of 3/4."""
    weight = counts.astype(np.float64) ** NOISE_POWER
    return np.cumsum(weight / weight.sum())


def windows(words: np.ndarray, sentence: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(context, known): per position the words up to *width* places away in its sentence, and which of the places hold one."""
    reach = int(width.max(initial=0))
    shifts = np.array([d for d in range(-reach, reach + 1) if d], np.int64)  # none, if all of a block is thinned out
    at = np.arange(len(words))[:, None] + shifts
    inside = np.clip(at, 0, len(words) - 1)
    known = (at == inside) & (sentence[inside] == sentence[:, None]) & (np.abs(shifts) <= width[:, None])
    return words[inside], known


def _added(to: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """Add *rows* to the rows of *to* at the given places, which may repeat."""
    order = np.argsort(at, kind="stable")
    places, starts = np.unique(at[order], return_index=True)
    if len(places):
        to[places] += np.add.reduceat(rows[order], starts)


def cbow_step(
    inner: np.ndarray, outer: np.ndarray, context: np.ndarray, known: np.ndarray, centre: np.ndarray, drawn: np.ndarray, step: float
) -> None:
    """One step for a batch of positions: the mean of the context tells the centre from the words drawn."""
    size = known.sum(1)
    mean = np.einsum("ncd,nc->nd", inner[context], known.astype(np.float64)) / size[:, None]
    words = np.concatenate([centre[:, None], drawn], 1)
    label = np.zeros(words.shape)
    label[:, 0] = 1.0
    real = np.ones(words.shape, bool)
    real[:, 1:] = drawn != centre[:, None]
    vectors = outer[words]
    score = 1.0 / (1.0 + np.exp(-np.clip(np.einsum("nwd,nd->nw", vectors, mean), -30, 30)))
    error = (label - score) * real * step
    back = np.einsum("nw,nwd->nd", error, vectors)
    row, place = np.nonzero(real)
    _added(outer, words[row, place], error[row, place][:, None] * mean[row])
    row, place = np.nonzero(known)
    _added(inner, context[row, place], back[row])


def _counted(row: np.ndarray, word: np.ndarray, rows: int, words: int) -> np.ndarray:
    """How often each row has each word, as numbers of *rows* by *words*."""
    return np.bincount(row * words + word, minlength=rows * words).reshape(rows, words).astype(np.float64)


def cbow_steps(
    inner: np.ndarray, outer: np.ndarray, context: np.ndarray, known: np.ndarray, centre: np.ndarray, drawn: np.ndarray, step: np.ndarray
) -> None:
    """What :func:`cbow_step` does batch after batch, by products of matrices over all words; *step* has a number per position."""
    n, words = len(centre), len(inner)
    row, place = np.nonzero(known)
    around = _counted(row, context[row, place], n, words)
    mean_of = around / known.sum(1)[:, None]
    own = np.zeros((n, words))
    own[np.arange(n), centre] = step
    row, place = np.nonzero(drawn != centre[:, None])
    others = _counted(row, drawn[row, place], n, words) * step[:, None] + own
    for at in range(0, n, BATCH):
        of = slice(at, at + BATCH)
        mean = mean_of[of] @ inner
        error = mean @ outer.T
        np.clip(error, -30, 30, out=error)
        np.exp(np.negative(error, out=error), out=error)
        error += 1.0
        np.divide(others[of], error, out=error)
        np.subtract(own[of], error, out=error)
        back = error @ outer
        outer += error.T @ mean
        inner += around[of].T @ back


def train_block(
    words: np.ndarray, sentence: np.ndarray, inner: np.ndarray, outer: np.ndarray, counts: np.ndarray, window: int, thin: float,
    steps: tuple[float, float], rng: np.random.Generator,
) -> None:
    """One pass over the positions of a block, in place."""
    share = counts / counts.sum()
    keep = np.minimum(1.0, np.sqrt(thin / share) + thin / share) if thin else np.ones(len(counts))
    kept = rng.random(len(words)) < keep[words]
    words, sentence = words[kept], sentence[kept]
    context, known = windows(words, sentence, rng.integers(1, window + 1, len(words)))
    noise = noise_table(counts)
    some = np.flatnonzero(known.any(1))
    some = some[rng.permutation(len(some))]
    dense = len(counts) <= DENSE_WORDS
    size = BATCH * (64 if dense else 1)
    for at in range(0, len(some), size):
        of = some[at : at + size]
        drawn = np.minimum(np.searchsorted(noise, rng.random((len(of), NEGATIVE)), "right"), len(counts) - 1)
        step = steps[0] + (steps[1] - steps[0]) * (np.arange(at, at + len(of)) // BATCH * BATCH) / len(some)
        if dense:
            cbow_steps(inner, outer, context[of], known[of], words[of], drawn, step)
        else:
            cbow_step(inner, outer, context[of], known[of], words[of], drawn, step[0])


def _block_rows(
    skills: list[list[str]], copies: np.ndarray, first: np.ndarray, names: pa.Array, blocks: int, of: range
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(block, words, lengths) of the blocks *of*: the numbers of the words of its sequences in their order, and how many each has."""
    order = sorted(range(len(skills)), key=skills.__getitem__)
    copies, first, size = copies[order], first[order], np.array([len(skills[at]) for at in order], np.int64)
    number = pc.fill_null(pc.index_in(pa.array([s for at in order for s in skills[at]], pa.string()), value_set=names), -1)
    number = number.to_numpy(zero_copy_only=False)
    size = np.bincount(np.repeat(np.arange(len(size)), size)[number >= 0], minlength=len(size))
    number = number[number >= 0].astype(np.min_scalar_type(len(names)))
    start, shares = np.cumsum(size) - size, np.minimum(copies, blocks)
    for block in of:
        share = (block - first) % blocks
        own = np.flatnonzero((share < shares) & (size > 0))
        if len(own):
            sequence = np.repeat(own, copies[own] // shares[own] + (share[own] < copies[own] % shares[own]))
            lengths = size[sequence]
            skip = start[sequence] - (np.cumsum(lengths) - lengths)
            yield block, number[np.arange(lengths.sum()) + np.repeat(skip, lengths)], lengths


def skill2vec(
    sequences: DataFrame, column: str = "skills", vector_size: int = 64, window: int = 5, min_count: int = 2,
    epochs: int = 30, thin: float = THIN_ABOVE, block_positions: int = 50_000, seed: int = 42,
) -> DataFrame:
    """(skill, vector) learnt from the skills that stand together in postings: continuous bag of words with negative sampling.

    Equal sequences are counted and dealt, in shares, to blocks of about *block_positions* positions, by their hash. In each
    epoch every block takes its steps from the same vectors, and the blocks' changes are averaged by their positions; tasks
    add up what their blocks changed. So the vectors depend on the data and the parameters, not on the machine. The
    vectors (a row of 2 * *vector_size* numbers per skill) are with the driver and every task. Skills that stand in fewer
    than *min_count* sequences are left out, also of the windows; without any the result is empty.
    """
    spark = sequences.sparkSession
    known = sequences.select(F.filter(F.col(column), lambda s: s.isNotNull()).alias("skills")).where(F.size("skills") > 0)
    counted = stored(known.groupBy("skills").agg(F.count(F.lit(1)).alias("copies")), "sequences")
    each = counted.select("copies", F.explode("skills").alias("skill"))
    frequent = each.groupBy("skill").agg(F.sum("copies").alias("n")).where(F.col("n") >= min_count)
    vocabulary = [(r["skill"], r["n"]) for r in frequent.orderBy("skill").collect()]  # the model's rows
    if not vocabulary:
        return spark.createDataFrame([], "skill string, vector array<double>")
    names, counts = [name for name, _ in vocabulary], np.array([n for _, n in vocabulary], np.int64)
    blocks = max(1, ceil(int(counts.sum()) / block_positions))

    # A sequence goes to as many blocks as it has copies, at most to all, one after the other; each gets its share of them. A row
    # per chunk of blocks brings it there.
    first = F.pmod(F.xxhash64("skills"), F.lit(blocks)).cast("long")
    end = F.col("first") + F.least(F.col("copies"), F.lit(blocks)) - 1

    def chunks(low, high):
        return F.sequence(F.floor(low / CHUNK), F.floor(high / CHUNK))

    reached = F.when(end < blocks, chunks(F.col("first"), end)).otherwise(
        F.array_union(chunks(F.col("first"), F.lit(blocks - 1)), chunks(F.lit(0), end - blocks))
    )
    dealt = counted.withColumn("first", first).select("skills", "copies", "first", F.explode(reached).alias("chunk"))
    known_names = spark.sparkContext.broadcast(names)
    code = np.min_scalar_type(len(names))

    def packed(table: pa.Table) -> pa.Table:
        chunk, skills = table.column("chunk")[0].as_py(), table.column("skills").to_pylist()
        copies, first = (table.column(name).to_numpy() for name in ("copies", "first"))
        of = range(chunk * CHUNK, min((chunk + 1) * CHUNK, blocks))
        found = _block_rows(skills, copies, first, pa.array(known_names.value, pa.string()), blocks, of)
        rows = [{"block": block, "words": words.tobytes(), "lengths": lengths.astype(np.int32).tobytes()} for block, words, lengths in found]
        return pa.Table.from_pylist(rows, _BLOCK)

    # By number, as a few bytes of a chunk become many positions, which Spark does not see when it puts partitions together.
    cores = spark.sparkContext.defaultParallelism
    dealt = dealt.repartition(min(ceil(blocks / CHUNK), 4 * cores), "chunk")
    dealt = dealt.groupBy("chunk").applyInArrow(packed, "block long, words binary, lengths binary")
    corpus = stored(dealt.repartition(min(blocks, 2 * cores)), "corpus")
    positions = int(counts.sum())
    rng = np.random.default_rng(seed)
    inner = (rng.random((len(names), vector_size)) - 0.5) / vector_size
    outer = np.zeros((len(names), vector_size))
    parts = corpus.rdd
    depth = max(1, ceil(log(max(parts.getNumPartitions(), 2), 16)))
    for epoch in range(epochs):
        steps = tuple(FIRST_STEP + (LAST_STEP - FIRST_STEP) * (epoch + e) / epochs for e in (0, 1))
        model = spark.sparkContext.broadcast((inner, outer))

        def trained(rows: Iterable, model=model, steps=steps, epoch=epoch) -> Iterator[np.ndarray]:
            before, change = model.value, np.zeros((2, len(names), vector_size))
            for row in rows:
                a, b = before[0].copy(), before[1].copy()
                words, lengths = np.frombuffer(row["words"], code).astype(np.int64), np.frombuffer(row["lengths"], np.int32)
                sentence = np.repeat(np.arange(len(lengths)), lengths)
                train_block(words, sentence, a, b, counts, window, thin, steps, np.random.default_rng([seed, epoch, row["block"]]))
                change += np.stack([a - before[0], b - before[1]]) * (len(words) / positions)
            yield change

        change = parts.mapPartitions(trained).treeReduce(np.add, depth)
        inner, outer = inner + change[0], outer + change[1]
        model.destroy()
    # Plain numbers, which a session takes with and without Arrow.
    return spark.createDataFrame(list(zip(names, inner.tolist())), "skill string, vector array<double>")


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)


def most_similar(vectors: DataFrame, skill: str, n: int = 10) -> DataFrame:
    """The *n* nearest skills by cosine; empty for an unknown skill.

    The wanted vector enters as a scalar subquery, so the search is one scan with a top-k at its end.
    """
    target = vectors.filter(F.col("skill") == skill).agg(F.any_value("vector")).scalar()
    paired = vectors.filter(F.col("skill") != skill).withColumn("_target", target)
    own, other = F.col("vector"), F.col("_target")
    cosine = _dot(own, other) / (F.sqrt(_dot(own, own)) * F.sqrt(_dot(other, other)) + F.lit(1e-9))
    return (
        paired.filter(F.col("_target").isNotNull())
        .select("skill", cosine.alias("similarity")).orderBy(F.desc("similarity"), "skill").limit(n)
    )
