"""Quality classifier: supervised subword embeddings."""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.llm.frames import packed, slices, with_columns
from jobtide.llm.subwords import mean_rows, mixed, ngrams, words_of

SIZES = (1, 2, 3, 4)
#: Words whose scores a worker remembers before it starts afresh.
CACHED_WORDS = 500_000


def bag(texts: pa.Array, buckets: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text its hashed features and weights, which add up to one: half from words, half from neighbouring words.

    A word stands for the mean of itself and its n-grams. A pair of neighbours has a bucket; pairs of one repeated word
    share bucket 0.
    """
    words, index, counts = words_of(texts)
    features, sizes = ngrams(words, SIZES, buckets)
    starts = np.cumsum(sizes) - sizes
    out, begin = [], 0
    for count in counts:
        own, times = np.unique(index[begin : begin + count], return_counts=True)
        lengths = sizes[own]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[own] - (ends - lengths), lengths)
        ids = [features[at]]
        weights = [np.repeat(times / lengths, lengths) * (0.5 / max(count, 1))]
        if count > 1:
            pairs = pair_buckets(features[starts + sizes - 1][index[begin : begin + count]], index[begin : begin + count], buckets)
            ids.append(pairs)
            weights.append(np.full(count - 1, 0.5 / (count - 1)))
        distinct, inverse = np.unique(np.concatenate(ids), return_inverse=True)
        out.append((distinct, np.bincount(inverse, np.concatenate(weights), len(distinct))))
        begin += count
    return out


def pair_buckets(whole: np.ndarray, index: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of neighbouring words from the buckets of the words."""
    with np.errstate(over="ignore"):
        hashed = mixed(whole[:-1].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + whole[1:].astype(np.uint64) + np.uint64(1))
    return np.where(index[:-1] == index[1:], 0, 1 + (hashed % np.uint64(buckets - 1)).astype(np.int64))


def train(bags: Sequence[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, buckets: int, dim: int, updates: int, seed: int) -> dict:
    """Feature vectors, output weights and bias by stochastic gradient descent on the softmax loss, a text at a time.

    Steps are scaled per feature by the gradients so far, since features differ widely in frequency.
    """
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1.0 / dim, 1.0 / dim, (buckets, dim))
    output, bias = rng.normal(0, 0.5, (2, dim)), np.log(np.maximum(np.bincount(labels, minlength=2), 1) / max(len(labels), 1))
    seen, seen_out, seen_bias = np.full(buckets, 1e-8), 1e-8, 1e-8
    epochs = int(np.clip(-(-updates // max(len(bags), 1)), 3, 30)) if bags else 0
    for epoch in range(epochs):
        rate = 0.2 * (1 - epoch / epochs) + 0.01
        for at in rng.permutation(len(bags)):
            ids, weights = bags[at]
            hidden = weights @ vectors[ids]
            logits = output @ hidden + bias
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[labels[at]] -= 1
            back = error @ output
            seen[ids] += weights**2 * (back @ back)
            vectors[ids] -= (rate * weights / np.sqrt(seen[ids]))[:, None] * back
            step = np.outer(error, hidden)
            seen_out += (step**2).sum()
            seen_bias += (error**2).sum()
            output -= rate * step / np.sqrt(seen_out)
            bias = bias - rate * error / np.sqrt(seen_bias)
    return {"vectors": vectors.astype(np.float32), "output": output, "bias": bias}


def fit_quality(
    docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    max_docs: int = 2000, max_chars: int = 20_000, buckets: int = 1 << 17, dim: int = 8, updates: int = 20_000, seed: int = 1,
) -> bytes:
    """Learn from a bounded sample of labelled rows: *max_docs* by hash of the id, none longer than *max_chars*.

    Rows with a label other than 0 and 1, without an id, or without a text are not used. Without any usable row the
    model gives 0.5 to every text. The features are made on all executors, the fit runs in one task on the sample.
    """
    ident, label = F.col(f"`{id_col}`"), F.col(f"`{label_col}`")
    chosen = labelled.where(label.isin(0, 1) & ident.isNotNull()).select(ident.alias("id"), label.cast("int").alias("label"))
    chosen = chosen.orderBy(F.xxhash64("id"), "id", "label").limit(max_docs)
    texts = docs.select(ident.alias("id"), F.col(f"`{text_col}`").alias("text")).where(F.length("text") <= max_chars)
    sample = texts.join(F.broadcast(chosen), "id").select("id", "text", "label")

    def features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            made = bag(part.column("text"), buckets)
            yield pa.RecordBatch.from_arrays(
                [part.column("id").cast(pa.string()), part.column("label"), pa.array([i.astype(np.int32) for i, _ in made], pa.list_(pa.int32())),
                 pa.array([w.astype(np.float32) for _, w in made], pa.list_(pa.float32()))], ["id", "label", "features", "weights"],
            )

    def fit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            f, w = batch.column("features"), batch.column("weights")
            for at, (key, label) in enumerate(zip(batch.column("id").to_pylist(), batch.column("label").to_pylist(), strict=True)):
                rows.append((key, label, f[at].values.to_numpy().astype(np.int64), w[at].values.to_numpy().astype(np.float64)))
        rows.sort(key=lambda row: (row[0], row[1], len(row[2])))
        model = train([row[2:] for row in rows], np.array([row[1] for row in rows], np.int64), buckets, dim, updates, seed)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    made = sample.mapInArrow(features, "id string, label int, features array<int>, weights array<float>")
    return bytes(made.repartition(1).mapInArrow(fit, "model binary").first()["model"])


class _Scorer:
    """Scores of texts from a model: as the output is linear in the features, a number per feature is enough."""

    def __init__(self, model: dict) -> None:
        self.buckets = len(model["vectors"])
        self.values = model["vectors"].astype(np.float64) @ (model["output"][1] - model["output"][0])
        self.bias = float(model["bias"][1] - model["bias"][0])
        self.known: dict[str, int] = {}
        self.score, self.whole = np.zeros(0), np.zeros(0, np.int64)

    def __call__(self, texts: pa.Array) -> np.ndarray:
        words, index, counts = words_of(texts)
        if len(self.known) > CACHED_WORDS:
            self.known, self.score, self.whole = {}, np.zeros(0), np.zeros(0, np.int64)
        fresh = [word for word in words if word not in self.known]
        if fresh:
            features, sizes = ngrams(fresh, SIZES, self.buckets)
            self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh)), strict=True))
            self.score = np.concatenate([self.score, mean_rows(self.values[features], sizes)])
            self.whole = np.concatenate([self.whole, features[np.cumsum(sizes) - 1]])
        at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        by_word = mean_rows(self.score[at][index], counts)
        by_pair = np.zeros(len(counts))
        if len(index) > 1:
            pairs = np.append(self.values[pair_buckets(self.whole[at][index], index, self.buckets)], 0.0)
            ends = np.cumsum(counts)
            pairs[ends[counts > 0] - 1] = 0.0
            by_pair = mean_rows(pairs, counts) * counts / np.maximum(counts - 1, 1)
        return 1.0 / (1.0 + np.exp(-np.clip(self.bias + 0.5 * (by_word + by_pair), -700, 700)))


_SCORERS: dict[bytes, _Scorer] = {}


def score_quality(
    docs: DataFrame, model: bytes, text_col: str = "text", carry: Sequence[str] | None = None
) -> DataFrame:
    """Score every whole text with a fitted model.

    Returns the columns *carry* (default: all) and ``score``, the probability of label 1; an input column of that name is
    replaced. NULL, empty and blank texts have no features and get the model's bias. Repeated rows get equal scores; an
    empty table gives an empty result.
    """
    columns = list(docs.columns if carry is None else carry)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    # A carried text goes through the workers once, not beside the row.
    others = [name for name in columns if name != text_col]
    rows = docs.select(packed(docs, others).alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))
    passed = ["row"] + ["text"] * (len(others) < len(columns))
    schema = T.StructType([rows.schema[name] for name in passed] + [T.StructField("score", T.DoubleType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if shared.value not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[shared.value] = _Scorer(pickle.loads(shared.value))
        scorer = _SCORERS[shared.value]
        for part in slices(batches, "text"):
            values = [part.column(name) for name in passed]
            yield pa.RecordBatch.from_arrays([*values, pa.array(scorer(part.column("text")))], [*passed, "score"])

    whole = [F.col("text" if name == text_col else f"row.`{name}`").alias(name) for name in columns]
    scored = rows.mapInArrow(run, schema).select(F.struct(*whole).alias("row"), "score")
    return with_columns(scored, columns, {"score": F.col("score")})
