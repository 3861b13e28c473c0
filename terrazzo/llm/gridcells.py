"""Nearest entries of a small codebook through memoised grid cells, in numpy.

Points fall into the cells of a grid of `width` whole numbers a component. For a cell's box every entry has a least and a greatest distance; an entry whose
least distance is above the smallest greatest distance is dominated, it is the nearest of no point in the box. What is not dominated is remembered by
cell, and a point is compared exactly with only those entries.
"""  # noqa: E501

from __future__ import annotations

import math

import numpy as np

#: cells that are remembered, and point-entry pairs that are evaluated at once
REMEMBERED, PAIRS = 1 << 16, 1 << 16

_rng = np.random.default_rng(6007)


def whole(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * value) of finite doubles, exactly: 64-bit whole numbers, or Python's where these do not fit."""
    with np.errstate(over="ignore"):
        floors = np.floor(values * float(scale))
    if not values.size or np.abs(floors).max() < 2.0**62:
        return floors.astype(np.int64)
    # beyond 2^53 a double is a whole number
    flat = [int(x) * scale if abs(x) >= 2.0**53 else math.floor(x * scale) for x in values.ravel().tolist()]
    out = np.empty(len(flat), object)
    out[:] = flat
    return out.reshape(values.shape)


def _rows_of(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the first rows of each distinct cell, and the cell of every row among those."""
    if cells.dtype != object and cells.shape[1]:
        # hashed; rows of one hash are compared with the first of them
        weights = _rng.integers(1, 1 << 62, cells.shape[1]) | 1
        with np.errstate(over="ignore"):
            hashes = (cells * weights).sum(axis=1)
        _, first, of = np.unique(hashes, return_index=True, return_inverse=True)
        if (cells[first[of]] == cells).all():
            return first, of
    seen: dict[tuple, int] = {}
    of = np.array([seen.setdefault(tuple(row), len(seen)) for row in cells.tolist()], np.int64)
    first = np.unique(of, return_index=True)[1] if len(of) else np.empty(0, np.int64)
    return first, of


class Cells:
    """The nearest entry of points of one part. `book`: entries by components, whole numbers."""

    def __init__(self, book: np.ndarray, width: int):
        self.book, self.width = book, width
        self.known: dict[bytes | tuple, np.ndarray] = {}
        self.evaluated = self.bounded = 0
        self.largest = int(np.abs(book).max()) if book.size else 0

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest entry and squared distance of every point; ties go to the lower number."""
        reach = (int(np.abs(points).max()) if points.size else 0) + self.largest + self.width
        book = self.book
        if reach * reach * max(1, points.shape[1]) * len(book) >= 1 << 62:
            points, book = points.astype(object), book.astype(object)
        else:
            points, book = points.astype(np.int64), book.astype(np.int64)
        cells = points // self.width
        first, of = _rows_of(cells)
        candidates = self._candidates(cells[first], book)
        sizes = np.array([len(c) for c in candidates], np.int64)
        order = np.argsort(of, kind="stable")
        best = np.empty(len(points), object if points.dtype == object else np.int64)
        counts = sizes[of[order]]
        cuts = np.flatnonzero(np.diff((np.cumsum(counts) - 1) // PAIRS)) + 1
        for rows in np.split(order, cuts):
            if not len(rows):
                continue
            entries = np.concatenate([candidates[c] for c in of[rows].tolist()])
            each = sizes[of[rows]]
            gap = points[np.repeat(rows, each)] - book[entries]
            # the entry's number in the lowest digits settles ties
            keyed = (gap * gap).sum(axis=1) * len(book) + entries
            best[rows] = np.minimum.reduceat(keyed, np.cumsum(each) - each)
            self.evaluated += len(entries)
        return (best % len(book)).astype(np.int64), best // len(book)

    def _candidates(self, cells: np.ndarray, book: np.ndarray) -> list[np.ndarray]:
        """The entries of each cell that are not dominated, from memory where it holds them."""
        names = [tuple(c) for c in cells.tolist()] if cells.dtype == object else [c.tobytes() for c in cells]
        found = [self.known.get(n) for n in names]
        new = [i for i, f in enumerate(found) if f is None]
        for part in np.array_split(np.array(new, np.int64), max(1, len(new) * len(book) // (1 << 20))):
            if not len(part):
                continue
            shape = len(part), len(book)
            low, high = np.zeros(shape, book.dtype), np.zeros(shape, book.dtype)
            for at in range(cells.shape[1]):
                # few distinct cells along one component: their distances are looked up
                along, which = np.unique(cells[part, at], return_inverse=True)
                under = along[:, None] * self.width - book[None, :, at]
                over = -under - (self.width - 1)
                least = np.maximum(np.maximum(under, over), 0)
                most = np.maximum(abs(under), abs(over))
                low += (least * least)[which]
                high += (most * most)[which]
            free = low <= high.min(axis=1)[:, None]
            self.bounded += len(part)
            for i, row in zip(part.tolist(), free, strict=True):
                found[i] = np.flatnonzero(row)
                if len(self.known) < REMEMBERED:
                    self.known[names[i]] = found[i]
        return found
