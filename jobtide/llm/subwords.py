"""Words of Arrow batches and hashed byte n-grams of words, without a loop over words."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def mixed(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (one round of multiply and shift each way)."""
    values = values.astype(np.uint64)
    values = (values ^ (values >> np.uint64(30))) * _MIX
    return values ^ (values >> np.uint64(31))


def words_of(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct words between `[\\x20\\x09-\\x0D]`, the index of each word of all texts in turn, and words per text."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = pc.list_flatten(lists)
    owner = pc.list_parent_indices(lists)
    filled = pc.not_equal(flat, "")
    flat, owner = flat.filter(filled), owner.filter(filled)
    coded = flat.dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    counts = np.bincount(owner.to_numpy(zero_copy_only=False), minlength=len(texts)).astype(np.int64)
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), counts


def ngrams(words: Sequence[str], sizes: Sequence[int], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte n-grams of `<word>` for each size and of the whole word, word after word, and how many each has.

    N-grams that hold the edge marks are the word's affixes.
    """
    raw = [b"<" + word.encode() + b">" for word in words]
    lengths = np.fromiter(map(len, raw), np.int64, len(raw))
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(raw)), lengths)
    data = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64) + np.uint64(1)
    left = np.repeat(ends, lengths) - np.arange(len(data))
    with np.errstate(over="ignore"):
        rolled, found, whose = np.zeros(len(data), np.uint64), [], []
        for size in range(1, max(sizes, default=0) + 1):
            # The hash of the n-gram that starts at each byte, from that of one byte less.
            shifted = np.zeros(len(data), np.uint64)
            shifted[: len(data) - size + 1] = data[size - 1 :]
            rolled = rolled * _BASE + shifted
            if size in sizes:
                fits = left >= size
                found.append(mixed(rolled[fits] + np.uint64(size)) % np.uint64(buckets))
                whose.append(owner[fits])
        # The whole word: a sum over its bytes and places, mixed.
        place = np.arange(len(data)) - np.repeat(ends - lengths, lengths)
        terms = mixed(data * _BASE + place.astype(np.uint64) * _MIX)
        sums = np.add.reduceat(terms, ends - lengths) if len(raw) else np.zeros(0, np.uint64)
        found.append(mixed(sums) % np.uint64(buckets))
        whose.append(np.arange(len(raw)))
    whose_all = np.concatenate(whose)
    order = np.argsort(whose_all, kind="stable")
    return np.concatenate(found)[order].astype(np.int64), np.bincount(whose_all, minlength=len(raw))


def mean_rows(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Means of consecutive runs of rows; an empty run gives zero."""
    sums = np.zeros((len(counts), *values.shape[1:]))
    some = counts > 0
    if some.any():
        starts = (np.cumsum(counts) - counts)[some]
        sums[some] = np.add.reduceat(values, starts, axis=0)
    return sums / np.maximum(counts, 1).reshape(-1, *[1] * (values.ndim - 1))
