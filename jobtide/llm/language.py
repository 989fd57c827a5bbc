"""Language identification with a linear-chain conditional random field over words."""

from __future__ import annotations

import pickle
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.llm.frames import packed, slices, with_columns
from jobtide.llm.subwords import mean_rows, ngrams, words_of

SIZES = (1, 2, 3, 4, 5)
#: Words whose emissions a worker remembers before it starts afresh.
CACHED_WORDS = 500_000
#: Words per link of the chain that are run one after the other; links run side by side.
LINK = 64
#: Steps between scalings of the messages. Scores differ by far less than 80 within a word, so nothing underflows.
EVERY = 4


def letters(word: str) -> str:
    """A word in lower case without what surrounds its letters; empty if it has none."""
    begin, end = 0, len(word)
    while begin < end and not word[begin].isalpha():
        begin += 1
    while end > begin and not word[end - 1].isalpha():
        end -= 1
    return word[begin:end].lower()


def _normal(values: np.ndarray) -> np.ndarray:
    """Rows that sum to one; a product with ones sums short rows faster than a reduction."""
    return values / np.maximum(values @ np.ones((values.shape[-1], 1)), 1e-300)


def marginals(emission: np.ndarray, lengths: np.ndarray, start: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Label probabilities of every word of every chain by forward-backward.

    *emission*: scores (words, labels), chain after chain; *lengths*: words per chain; *start* and *move*: scores of the
    first label and of transitions. Chains are cut into links of LINK words. The transfer matrices of all links are
    multiplied up side by side, then the messages pass from link to link, then through all links side by side: the
    exact forward-backward values, whatever a chain's length.
    """
    words, labels = emission.shape
    if not words:
        return np.zeros((0, labels))
    top = emission[:, 0]
    for label in range(1, labels):
        top = np.maximum(top, emission[:, label])
    weight = np.exp(emission - top[:, None])
    first, step = np.exp(start - start.max()), np.exp(move - move.max())
    lengths = lengths[lengths > 0]
    links = -(-lengths // LINK)
    chain_begin = np.cumsum(links) - links
    begin = np.concatenate([np.arange(0, n, LINK) for n in lengths]) + np.repeat(np.cumsum(lengths) - lengths, links)
    size = np.minimum(LINK, np.repeat(np.cumsum(lengths), links) - begin)
    # Links by falling size, so that those still running at a step are the first ones.
    order = np.argsort(-size, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    begin, size = begin[order], size[order]
    running = [int(n) for n in np.searchsorted(-size, -np.arange(int(size[0])), "left")]

    transfer = np.broadcast_to(np.eye(labels), (len(begin), labels, labels)).copy()
    if links.max() > 1:
        for t, n in enumerate(running):
            product = (transfer[:n].reshape(-1, labels) @ step).reshape(n, labels, labels)
            product *= weight[begin[:n] + t][:, None, :]
            transfer[:n] = _normal(product.reshape(n, -1)).reshape(product.shape) if t % EVERY == 0 else product

    # What enters each link from the left (before its first transition) and from the right (after its last word).
    entering, leaving = np.ones((len(begin), labels)), np.ones((len(begin), labels))
    # A start vector s with s @ step = first, so that a chain's first word is treated like any other.
    entering[place[chain_begin]] = np.linalg.lstsq(step.T, first, rcond=None)[0]
    for t in range(1, int(links.max())):
        at = chain_begin[links > t] + t
        passed = np.einsum("ni,nij->nj", entering[place[at - 1]], transfer[place[at - 1]])
        entering[place[at]] = passed / np.abs(passed).max(1, keepdims=True)
    for t in range(int(links.max()) - 2, -1, -1):
        at = chain_begin[links > t + 1] + t
        leaving[place[at]] = _normal(np.einsum("nij,nj->ni", transfer[place[at + 1]], leaving[place[at + 1]]))

    forward, out = np.empty((words, labels)), np.empty((words, labels))
    message = entering
    for t, n in enumerate(running):
        passed = np.maximum(message[:n] @ step, 0) * weight[begin[:n] + t]
        message[:n] = _normal(passed) if t % EVERY == 0 else passed
        forward[begin[:n] + t] = message[:n]
    message, back = leaving, step.T.copy()
    for t in range(len(running) - 1, -1, -1):
        at = begin[: running[t]] + t
        out[at] = forward[at] * message[: running[t]]
        passed = (message[: running[t]] * weight[at]) @ back
        message[: running[t]] = _normal(passed) if t % EVERY == 0 else passed
    return _normal(out)


def splice(segments: Sequence[tuple[int, list[str]]], seed: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Chains of three segments each, of whatever languages chance brings together: words, labels, words per chain."""
    order = np.random.default_rng(seed).permutation(len(segments))
    words, labels, lengths = [], [], []
    for begin in range(0, len(order), 3):
        before = len(words)
        for at in order[begin : begin + 3]:
            words.extend(segments[at][1])
            labels.extend([segments[at][0]] * len(segments[at][1]))
        lengths.append(len(words) - before)
    return words, np.array(labels, np.int64), np.array(lengths, np.int64)


def train(segments: Sequence[tuple[str, list[str]]], buckets: int, epochs: int, seed: int) -> dict:
    """Weights of features and transitions by gradient steps on the chains' log likelihood.

    Features of a word: buckets of its affixes, n-grams and whole, averaged; and, if a lexicon of the training words
    knows it, its shares by language. Steps are scaled by the gradients so far.
    """
    names = sorted({name for name, _ in segments})
    code = {name: at for at, name in enumerate(names)}
    kinds = len(names)
    words, labels, lengths = splice([(code[name], words) for name, words in segments], seed)
    distinct, index = np.unique(np.array(words, object), return_inverse=True)
    tallies = np.zeros((len(distinct), kinds))
    np.add.at(tallies, (index, labels), 1)
    known = tallies.sum(1) >= 3
    lexicon = {word: tuple(row) for word, row in zip(distinct[known], _normal(tallies[known] + 0.1), strict=True)}

    features, sizes = ngrams(list(distinct), SIZES, buckets)
    owner = np.repeat(np.arange(len(distinct)), sizes)
    shares = np.array([lexicon.get(word, (0.0,) * kinds) for word in distinct]).reshape(len(distinct), kinds)
    weights, lookup, start, move = np.zeros((buckets, kinds)), np.zeros((kinds, kinds)), np.zeros(kinds), np.zeros((kinds, kinds))
    totals = [np.full(x.shape, 1e-6) for x in (weights, lookup, start, move)]
    ends = np.cumsum(lengths)
    batches = np.array_split(np.arange(len(lengths)), max(1, len(lengths) // 250)) if len(lengths) else []
    gold = np.eye(kinds)[labels] if kinds else np.zeros((0, 0))
    for _ in range(epochs):
        for batch in batches:
            begin, end = ends[batch[0]] - lengths[batch[0]], ends[batch[-1]]
            word, size = index[begin:end], lengths[batch]
            used = np.unique(word)
            emission = np.zeros((len(distinct), kinds))
            emission[used] = mean_rows(weights[features[np.isin(owner, used)]], sizes[used]) * 10 + shares[used] @ lookup
            belief = marginals(emission[word], size, start, move)
            error = gold[begin:end] - belief
            by_word = np.zeros((len(distinct), kinds))
            np.add.at(by_word, word, error)
            picked = np.isin(owner, used)
            slope = np.zeros_like(weights)
            np.add.at(slope, features[picked], (by_word * 10 / np.maximum(sizes, 1)[:, None])[owner[picked]])
            heads = np.cumsum(size) - size
            inner = np.ones(len(word), bool)
            inner[heads] = False
            at = np.flatnonzero(inner)
            # Expected transitions, from pairs of beliefs joined by the transition scores.
            pair = belief[at - 1][:, :, None] * np.exp(move)[None] * belief[at][:, None, :]
            pair /= pair.sum((1, 2), keepdims=True)
            seen = gold[begin:end][at - 1].T @ gold[begin:end][at]
            for values, gradient, total in zip(
                (weights, lookup, start, move),
                (slope, shares[word].T @ error, error[heads].sum(0), seen - pair.sum(0)), totals, strict=True,
            ):
                gradient = gradient / len(size) - 1e-4 * values
                total += gradient**2
                values += 0.3 * gradient / np.sqrt(total)
    return {"names": names, "weights": weights.astype(np.float32), "lookup": lookup, "start": start, "move": move, "lexicon": lexicon}


def fit_language(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", max_docs: int = 3000,
    max_chars: int = 20_000, segment_words: int = 15, segments_per_doc: int = 3, buckets: int = 1 << 16, epochs: int = 4,
    seed: int = 1,
) -> bytes:
    """Learn from a bounded sample of rows with a language: *max_docs* by hash of the id, none longer than *max_chars*.

    Of each, *segments_per_doc* runs of *segment_words* words at places given by the id are labelled with the row's
    language; chains that switch between languages are spliced from them. Rows without id, text or language are not
    used. Without any usable row the model knows no language.
    """
    ident, text, label = (F.col(f"`{name}`") for name in (id_col, text_col, label_col))
    usable = docs.select(ident.alias("id"), text.alias("text"), label.cast("string").alias("label")).where(
        "id IS NOT NULL AND label IS NOT NULL"
    ).where(F.length("text").between(1, max_chars))
    chosen = usable.select("id", F.xxhash64("id").alias("hash")).distinct().orderBy("hash", "id").limit(max_docs)
    sample = usable.join(F.broadcast(chosen), "id").select(F.col("id").cast("string").alias("id"), "text", "label")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            out = []
            for key, text, label in zip(*(part.column(name).to_pylist() for name in ("id", "text", "label")), strict=True):
                words = [word for word in map(letters, text.split()) if word]
                places = np.random.default_rng(zlib.crc32(key.encode())).integers(0, max(1, len(words) - segment_words + 1), segments_per_doc)
                out += [(key, label, words[place : place + segment_words]) for place in sorted(set(places.tolist())) if words]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row[at] for row in out], kind) for at, kind in enumerate((pa.string(), pa.string(), pa.list_(pa.string())))],
                ["id", "label", "words"],
            )

    def fit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((row["id"], row["label"], row["words"]) for batch in batches for row in batch.to_pylist())
        model = train([row[1:] for row in rows], buckets, epochs, seed)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    made = sample.mapInArrow(cut, "id string, label string, words array<string>")
    return bytes(made.repartition(1).mapInArrow(fit, "model binary").first()["model"])


class Tagger:
    """Emissions of words met so far, and the chain's weights."""

    def __init__(self, model: dict) -> None:
        self.model, self.kinds = model, len(model["names"])
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.emission, self.has_letters = np.zeros((0, self.kinds)), np.zeros(0, bool)

    def _learn(self, fresh: list[str]) -> None:
        stems = [letters(word) for word in fresh]
        features, sizes = ngrams(stems, SIZES, len(self.model["weights"]))
        shares = np.array([self.model["lexicon"].get(stem, (0.0,) * self.kinds) for stem in stems]).reshape(len(stems), self.kinds)
        scores = mean_rows(self.model["weights"][features].astype(np.float64), sizes) * 10 + shares @ self.model["lookup"]
        some = np.array([bool(stem) for stem in stems])
        scores[~some] = 0.0
        self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh)), strict=True))
        self.emission = np.concatenate([self.emission, scores])
        self.has_letters = np.concatenate([self.has_letters, some])

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Label probabilities per word, whether it has letters, words per text, and the mean over words with letters."""
        words, index, counts = words_of(texts)
        if len(self.known) > CACHED_WORDS:
            self.forget()
        if fresh := [word for word in words if word not in self.known]:
            self._learn(fresh)
        at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))[index]
        belief = marginals(self.emission[at], counts, self.model["start"], self.model["move"])
        some = self.has_letters[at]
        owner = np.repeat(np.arange(len(counts)), counts)
        means = mean_rows(belief[some], np.bincount(owner[some], minlength=len(counts)))
        return belief, some, counts, means


_TAGGERS: dict[bytes, Tagger] = {}


def _tagger(model: bytes) -> Tagger:
    if model not in _TAGGERS:
        _TAGGERS.clear()
        _TAGGERS[model] = Tagger(pickle.loads(model))
    return _TAGGERS[model]


def predict_language(
    docs: DataFrame, model: bytes, text_col: str = "text", carry: Sequence[str] | None = None, words: bool = False
) -> DataFrame:
    """Label the words of every whole text, and the text by the mean over its words.

    Returns the columns *carry* (default: all), ``lang_pred`` and ``score`` (mean probability of that language); with
    *words*, also ``word_langs``, the likeliest label of each word between ASCII white space (NULL for words without
    letters). Input columns of these names are replaced. NULL text and text without a letter, and every text if the
    model knows no language, are ``und`` with score 0. Repeated rows get equal results; an empty table gives an empty
    result.
    """
    columns = list(docs.columns if carry is None else carry)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(packed(docs, columns).alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))
    fields = [rows.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    if words:
        fields.append(T.StructField("word_langs", T.ArrayType(T.StringType())))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = _tagger(shared.value)
        names = np.array([*tagger.model["names"], "und"], object)
        for part in slices(batches, "text", 2 << 20):
            belief, some, counts, means = tagger(part.column("text"))
            best, score = np.full(len(counts), len(names) - 1), np.zeros(len(counts))
            if tagger.kinds:
                labelled = means.sum(1) > 0
                best[labelled] = means[labelled].argmax(1)
                score[labelled] = np.minimum(means[labelled].max(1), 1.0)
            out = [part.column("row"), pa.array(names[best], pa.string()), pa.array(score)]
            if words:
                tags = np.where(some, names[belief.argmax(1)] if tagger.kinds else "und", None)
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                out.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(tags.tolist(), pa.string())))
            yield pa.RecordBatch.from_arrays(out, [field.name for field in fields])

    return with_columns(rows.mapInArrow(run, T.StructType(fields)), columns, {f.name: F.col(f.name) for f in fields[1:]})
