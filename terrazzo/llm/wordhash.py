"""Hashes of words and of word shingles, in numpy, for a batch of texts at a time.

A word is a run of bytes other than space and \\x09-\\x0D in the UTF-8 text; A-Z count as a-z. Word hashes are polynomials over
random 64-bit byte values, shingle hashes mix those of the words; both take 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

#: bytes hashed at once; a longer word is hashed whole all the same
STEP = 1 << 20
#: bytes of text gathered into one batch; a longer text is a batch of its own
BATCH = 4 << 20

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_COEFFICIENTS = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    if name not in _powers or len(_powers[name]) < n:
        steps = np.full(max(n, STEP + 4096), base, np.uint64)
        steps[0] = 1
        _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers[name][:n]


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word of a text, or of texts with a space between them."""
    hashes, firsts, at = [], [], 0
    while at < len(data):
        end = min(len(data), at + STEP)
        while end < len(data) and not _SPACE[data[end]]:
            # a word is not cut; look for its end a little at a time
            ahead = np.flatnonzero(_SPACE[data[end : end + 4096]])
            end = end + int(ahead[0]) if len(ahead) else min(len(data), end + 4096)
        part = data[at:end]
        inside = np.zeros(len(part) + 2, bool)
        inside[1:-1] = ~_SPACE[part]
        start = np.flatnonzero(inside[1:-1] & ~inside[:-2])
        stop = np.flatnonzero(inside[1:-1] & ~inside[2:])
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_BYTE[part] * _power("up", _BASE, len(part)), dtype=np.uint64, out=sums[1:])
        hashes.append(mixed((sums[stop + 1] - sums[start]) * _power("down", _INVERSE, len(part))[start]))
        firsts.append(start + at)
        at = end
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(firsts)


def shingles_of(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of `size` words; the whole sequence as one where it is shorter; none without words."""
    n = min(size, len(words))
    if not n:
        return np.empty(0, np.uint64)
    count = len(words) - n + 1
    total = np.full(count, (n * int(_BASE)) & ((1 << 64) - 1), np.uint64)
    for i in range(n):
        total += words[i : i + count] * _COEFFICIENTS[i]
    return mixed(total)


def batches(texts: Iterable[bytes | None]) -> Iterator[tuple[int, list[bytes]]]:
    """(number of the first text, texts): runs of about `BATCH` bytes."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        held.append(text or b"")
        size += len(held[-1])
        if size >= BATCH:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


def word_lists(texts: Iterable[bytes | None]) -> Iterator[np.ndarray]:
    """The word hashes of every text, in order; null is empty."""
    for _, held in batches(texts):
        data = np.frombuffer(b" ".join(held) + b" ", np.uint8)
        hashes, firsts = words_of(data)
        ends = np.cumsum([len(t) + 1 for t in held])
        at = 0
        for upto in np.searchsorted(firsts, ends):
            yield hashes[at:upto]
            at = int(upto)


def utf8(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.large_binary()).to_pylist()
