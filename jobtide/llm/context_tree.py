"""Language-model scoring by context-tree weighting over bytes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Log of gamma, tabled up to here and by Stirling's series beyond.
_TABLED = 4096


def _tables() -> tuple[np.ndarray, np.ndarray]:
    whole = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, _TABLED, dtype=np.float64)))])
    half = np.concatenate([[0.0], np.cumsum(np.log(np.arange(0, _TABLED - 1) + 0.5))])
    return whole, half


_WHOLE, _HALF = _tables()


def _stirling(x: np.ndarray) -> np.ndarray:
    return (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3)


def _rising_half(n: np.ndarray) -> np.ndarray:
    """Log of gamma(n + 1/2) / gamma(1/2)."""
    return np.where(n < _TABLED, _HALF[np.minimum(n, _TABLED - 1)], _stirling(np.maximum(n, 2) + 0.5) - 0.5 * np.log(np.pi))


def krichevsky_trofimov(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log probability of so many zeros and ones in any one order, by the KT estimate."""
    total = zeros + ones
    factorial = np.where(total < _TABLED, _WHOLE[np.minimum(total, _TABLED - 1)], _stirling(np.maximum(total, 2) + 1.0))
    return _rising_half(zeros) + _rising_half(ones) - factorial


@dataclass
class Level:
    """The nodes of one depth and one bit: a context with the bits of the next byte so far, and its counts."""

    of: np.ndarray  # the node of each gram
    zeros: np.ndarray
    ones: np.ndarray


def levels(keys: np.ndarray, counts: np.ndarray, depth: int, above: int) -> list[list[Level]]:
    """Nodes of all grams for each depth from *above* to *depth* and each of eight bits.

    A key holds, from its top byte on, the last context byte, the one before it and so on, and at last the next byte. Keys
    are sorted. Counts are training counts and may be zero: such a gram is looked up but teaches nothing.
    """
    out = []
    byte = keys & np.uint64(255)
    for at in range(above, depth + 1):
        context = keys >> np.uint64(8 * (depth - at) + 8)
        # Grams by context of this depth and next byte: at full depth they are in order already.
        order = np.arange(len(keys)) if at == depth else np.lexsort((byte, context))
        context, sorted_byte, sorted_counts = context[order], byte[order], counts[order]
        bits = []
        for bit in range(8):
            prefix = sorted_byte >> np.uint64(8 - bit)
            new = np.ones(len(keys), bool)
            new[1:] = (context[1:] != context[:-1]) | (prefix[1:] != prefix[:-1])
            starts = np.flatnonzero(new)
            one = (sorted_byte >> np.uint64(7 - bit)) & np.uint64(1) == 1
            total = np.add.reduceat(sorted_counts, starts) if len(starts) else np.zeros(0, np.int64)
            ones = np.add.reduceat(np.where(one, sorted_counts, 0), starts) if len(starts) else np.zeros(0, np.int64)
            of = np.empty(len(keys), np.int64)
            of[order] = np.cumsum(new) - 1
            bits.append(Level(of, total - ones, ones))
        out.append(bits)
    return out


def weighted(tree: list[list[Level]], bottom: bool = True, below: list[np.ndarray] | None = None) -> list[list[np.ndarray]]:
    """Log weighted probability of each node: half its own KT estimate, half the product over its longer contexts.

    Nodes of the last depth have their KT estimate only, or, if *below* gives sums over longer contexts, both.
    """
    out: list[list[np.ndarray]] = [[] for _ in tree]
    for bit in range(8):
        deeper = None
        for at in range(len(tree) - 1, -1, -1):
            level = tree[at][bit]
            own = krichevsky_trofimov(level.zeros, level.ones)
            if deeper is not None:
                child = tree[at + 1][bit]
                parent_of_child = np.empty(len(child.zeros), np.int64)
                parent_of_child[child.of] = level.of
                product = np.bincount(parent_of_child, deeper, len(level.zeros))
                own = np.logaddexp(own, product) - np.log(2)
            deeper = own
            out[at].append(own)
    return out


def mixed_bits(tree: list[list[Level]], logs: list[list[np.ndarray]], grams: np.ndarray, byte: np.ndarray) -> np.ndarray:
    """For each gram and bit: the estimate of the top depth of *tree*, mixed with those of all longer contexts.

    A node that trained nothing has no say: its parent's own estimate stands for it.
    """
    out = np.empty((8, len(grams)))
    for bit in range(8):
        one = (byte >> np.uint64(7 - bit)) & np.uint64(1) == 1
        estimate = None
        for at in range(len(tree) - 1, -1, -1):
            level, node = tree[at][bit], tree[at][bit].of[grams]
            zeros, ones = level.zeros[node], level.ones[node]
            total = zeros + ones
            own = (np.where(one, ones, zeros) + 0.5) / (total + 1.0)
            if estimate is None:
                estimate = np.where(total > 0, own, np.nan)
            else:
                stay = np.exp(krichevsky_trofimov(level.zeros, level.ones) - np.log(2) - logs[at][bit])[node]
                both = np.where(np.isnan(estimate), own, stay * own + (1 - stay) * estimate)
                estimate = np.where(total > 0, both, np.nan)
        out[bit] = estimate
    return out
