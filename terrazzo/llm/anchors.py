"""Places in a text that its repeats must share, in numpy.

Of all `GRAM`-byte strings inside a `length`-byte string the one with the least hash (the leftmost of equals) is its anchor. Equal strings have equal
anchors at equal places, so what repeats anywhere can be found among strings of one anchor. Successive strings mostly share
their anchor: a text has about two anchors in `length` bytes.
"""  # noqa: E501

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

from terrazzo.llm.wordhash import _power, mixed

GRAM = 32
#: starts of strings that are looked at together; a longer text is cut into such segments
SEGMENT = 1 << 19

_rng = np.random.default_rng(65537)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0xD1342543DE82EF95)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the `GRAM` bytes from each place on."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power("gram up", _BASE, len(data)), dtype=np.uint64, out=sums[1:])
    return mixed((sums[GRAM:] - sums[:-GRAM]) * _power("gram down", _INVERSE, len(data))[: len(data) - GRAM + 1])


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each `width` successive values."""
    count = len(values) - width + 1
    whole = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    whole[: len(values)] = values
    rows = whole.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


def anchored(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(text, first start, last start, anchor hash): runs of starts of `length`-byte strings that share an anchor."""
    held, size = [], 0
    for i, text in enumerate(texts):
        for at in range(0, len(text) - length + 1, SEGMENT):
            piece = text[at : at + SEGMENT + length - 1]
            held.append((i, at, piece))
            size += len(piece)
            if size >= SEGMENT:
                yield _anchored(held, length)
                held, size = [], 0
    if held:
        yield _anchored(held, length)


def _anchored(pieces: list[tuple[int, int, bytes]], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(p[2] for p in pieces), np.uint8)
    hashes = gram_hashes(data)
    # the place breaks ties and tells where the least is
    ordered = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    least = window_minima(ordered, length - GRAM + 1)
    sizes = np.array([len(p[2]) for p in pieces])
    begins = np.cumsum(sizes) - sizes
    valid = np.zeros(len(least) + 1, bool)
    for begin, size in zip(begins.tolist(), sizes.tolist(), strict=True):
        valid[begin : begin + size - length + 1] = True
    valid = valid[:-1]
    place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    change = np.ones(len(least), bool)
    change[1:] = (place[1:] != place[:-1]) | ~valid[:-1]
    first = np.flatnonzero(change & valid)
    ends = np.ones(len(least), bool)
    ends[:-1] = change[1:] | ~valid[1:]
    last = np.flatnonzero(ends & valid)
    owner = np.searchsorted(begins, first, "right") - 1
    shift = np.array([p[1] for p in pieces])[owner] - begins[owner]
    return np.array([p[0] for p in pieces])[owner], first + shift, last + shift, hashes[place[first]].view(np.int64)


def digest(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)
