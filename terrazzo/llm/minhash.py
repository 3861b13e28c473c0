"""One-permutation MinHash with optimal densification, in numpy.

The hashes of a set are cut into `BINS` bins by their high bits; a bin keeps its least hash. An empty bin borrows from the first filled bin in its
own random order of all bins, so that borrowed bins of two sets agree as often as the sets are similar.
"""

from __future__ import annotations

import numpy as np

from terrazzo.llm.wordhash import mixed

BANDS, ROWS = 26, 5
BINS = BANDS * ROWS

_rng = np.random.default_rng(7919)
_ORDER = np.argsort(_rng.random((BINS, BINS)), axis=1)
_WEIGHTS = _rng.integers(1, 1 << 63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """The `BINS` values of a set given as its sorted, distinct hashes; the set is not empty."""
    bins = ((hashes >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
    first = np.flatnonzero(np.diff(bins, prepend=np.uint64(BINS)))
    values = np.zeros(BINS, np.uint64)
    filled = np.zeros(BINS, bool)
    at = bins[first].astype(np.int64)
    values[at], filled[at] = hashes[first], True
    empty = np.flatnonzero(~filled)
    if len(empty):
        order = _ORDER[empty]
        values[empty] = values[order[np.arange(len(empty)), filled[order].argmax(axis=1)]]
    return values


def bands(values: np.ndarray) -> np.ndarray:
    """One hash for each band of a sketch; the same values in two bands give two hashes."""
    return mixed((values.reshape(BANDS, ROWS) * _WEIGHTS).sum(axis=1, dtype=np.uint64))
