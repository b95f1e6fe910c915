"""Rolling hashes of k-grams and their minima over sliding windows, for whole arrays at once."""

from __future__ import annotations

import numpy as np

#: An odd base has an inverse modulo 2**64, so prefix sums give every k-gram's polynomial hash.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2 ... modulo 2**64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = max(1 << 12, 1 << (n - 1).bit_length())
        known = np.full(size, base, dtype=np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        _powers[base] = known
    return known[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit over the whole word."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums from which the polynomial hash of any run of ``values`` follows."""
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers(INVERSE, len(values)), out=sums[1:])
    return sums


def kgrams_of(sums: np.ndarray, k: int) -> np.ndarray:
    if len(sums) <= k:
        return np.zeros(0, dtype=np.uint64)
    return mixed((sums[k:] - sums[:-k]) * powers(BASE, len(sums) - k))


def kgram_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """The hash of each run of ``k`` values; equal runs have equal hashes, wherever they stand."""
    return kgrams_of(prefix_sums(values), k)


def sliding_min(keys: np.ndarray, window: int) -> np.ndarray:
    """The least key of each run of ``window`` keys, in about log2(window) passes."""
    low, width = keys, 1
    while 2 * width <= window:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < window:
        low = np.minimum(low[: len(keys) - window + 1], low[window - width :])
    return low
