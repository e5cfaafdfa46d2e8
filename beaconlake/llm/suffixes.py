"""Suffix arrays by the difference cover modulo three, on numpy arrays."""

from __future__ import annotations

import numpy as np


def _order(first: np.ndarray, second: np.ndarray, third: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of triples, and for each place in that order whether it differs from the place before."""
    if symbols < 1 << 21:
        packed = (first * symbols + second) * symbols + third
        order = np.argsort(packed, kind="stable")
        packed = packed[order]
        return order, np.concatenate([[True], packed[1:] != packed[:-1]])
    pair = first * symbols + second
    order = np.lexsort((third, pair))
    pair, third = pair[order], third[order]
    return order, np.concatenate([[True], (pair[1:] != pair[:-1]) | (third[1:] != third[:-1])])


def suffix_array(text: np.ndarray, symbols: int) -> np.ndarray:
    """Start of every suffix in ascending order; symbols are 1 to ``symbols - 1``, as 0 ends the text.

    The suffixes that start at places 1 and 2 modulo 3 are sorted by their triples; where triples tie, the names of the
    triples form a text of two thirds of the length whose suffix array settles the order. The others are sorted by their
    first symbol and the rank of what follows, and merged: how many sampled suffixes of either kind come before one is a
    search among keys that are already sorted.
    """
    n = len(text)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: text[i:].tolist()), np.int64)
    t = np.concatenate([text.astype(np.int64), np.zeros(3, np.int64)])
    # one more place 1 modulo 3 at the end keeps the two kinds apart in the text of names
    ones = np.arange(1, n + (n % 3 == 1), 3)
    twos = np.arange(2, n, 3)
    sample = np.concatenate([ones, twos])
    order, fresh = _order(t[sample], t[sample + 1], t[sample + 2], symbols)
    names = np.empty(len(sample), np.int64)
    names[order] = np.cumsum(fresh)
    if fresh.all():
        sampled = sample[order]
    else:
        sampled = sample[suffix_array(names, int(names.max()) + 1)]
    rank = np.zeros(n + 4, np.int64)
    rank[sampled] = np.arange(1, len(sampled) + 1)
    sampled = sampled[sampled < n]

    rest = np.arange(0, n, 3)
    wide = len(sample) + 2
    key = t[rest] * wide + rank[rest + 1]
    rest = rest[np.argsort(key, kind="stable")]
    ones, twos = sampled[sampled % 3 == 1], sampled[sampled % 3 == 2]
    before = np.searchsorted(t[ones] * wide + rank[ones + 1], t[rest] * wide + rank[rest + 1])
    before += _earlier(t[twos], t[twos + 1], rank[twos + 2], t[rest], t[rest + 1], rank[rest + 2], symbols, wide)
    out = np.empty(n, np.int64)
    places = before + np.arange(len(rest))
    taken = np.zeros(n, bool)
    taken[places] = True
    out[places] = rest
    out[~taken] = sampled
    return out


def _earlier(a1, a2, a3, b1, b2, b3, symbols: int, wide: int) -> np.ndarray:
    """For each triple of ``b``, how many of the sorted triples of ``a`` come before it."""
    if symbols * symbols * wide < 1 << 62:
        return np.searchsorted((a1 * symbols + a2) * wide + a3, (b1 * symbols + b2) * wide + b3)
    # too wide for one number: name the pairs first
    pairs, named = np.unique(np.concatenate([a1 * symbols + a2, b1 * symbols + b2]), return_inverse=True)
    return np.searchsorted(named[: len(a1)] * wide + a3, named[len(a1) :] * wide + b3)
