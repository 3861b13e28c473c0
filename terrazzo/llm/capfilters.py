"""Spherical-cap filters from structured random product codes, in numpy.

A vector is rotated at random and cut into two halves; each half has `B` random directions. Every pair of directions, one of each half, is one
filter, so 2 B directions make B * B filters. A vector passes the filters whose inner product with it exceeds a height; they are found by list decoding: only
directions of the first half that can reach the height with the best of the second half are looked at, and the second half is read in falling order.
"""  # noqa: E501

from __future__ import annotations

import functools
import math
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np

#: nodes of a bucket that a plan aims at, and pairs of random vectors that settle how many filters a vector must pass
AIM, PAIRS = 512, 2000
#: lists of this many rows and directions are searched at once
SEARCHED = 1 << 21


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1; powers of two scale them first, so that squares neither overflow nor vanish."""
    scaled = vectors * np.exp2(-np.frexp(np.abs(vectors).max(axis=1, initial=0))[1].astype(np.float64))[:, None]
    return scaled / np.linalg.norm(scaled, axis=1)[:, None]


@functools.lru_cache(maxsize=16)
def _directions(dims: int, count: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A rotation and the directions of both halves. One component has a second one, 0, beside it."""
    rng = np.random.default_rng((dims, seed))
    wide = max(dims, 2)
    rotation = np.linalg.qr(rng.normal(size=(wide, wide)))[0][:dims]
    first, second = (rng.normal(size=(count, n)) for n in (wide // 2, wide - wide // 2))
    return rotation, first / np.linalg.norm(first, axis=1)[:, None], second / np.linalg.norm(second, axis=1)[:, None]


def halves(units: np.ndarray, count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Inner products of both halves of every vector with their directions."""
    rotation, first, second = _directions(units.shape[1], count, seed)
    turned = units @ rotation
    return turned[:, : first.shape[1]] @ first.T, turned[:, first.shape[1] :] @ second.T


def cells(units: np.ndarray, count: int, seed: int) -> np.ndarray:
    """The one filter whose inner product with a vector is largest."""
    first, second = halves(units, count, seed)
    return first.argmax(axis=1) * count + second.argmax(axis=1)


def decoded(units: np.ndarray, count: int, height: float, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Row and filter of every vector and every filter it passes."""
    first, second = halves(units, count, seed)
    order = np.argsort(-second, axis=1, kind="stable")
    falling = np.take_along_axis(second, order, axis=1)
    row, one = np.nonzero(first + falling[:, :1] >= height)
    missing = height - first[row, one]
    rows, filters = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for part in np.array_split(np.arange(len(row)), max(1, len(row) * count // SEARCHED)):
        passed = (falling[row[part]] >= missing[part, None]).sum(axis=1)
        again = np.repeat(part, passed)
        place = np.arange(len(again)) - np.repeat(np.cumsum(passed) - passed, passed)
        rows.append(row[again])
        filters.append(one[again] * count + order[row[again], place])
    return np.concatenate(rows), np.concatenate(filters)


@dataclass(frozen=True)
class Plan:
    """Directions of a half, the height of a cap (as the sum of both halves' products), independent codes, and the recall of one on random pairs."""

    dims: int
    count: int
    height: float
    codes: int
    recall: float

    def filters(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and filter of every vector and every filter of any code that it passes."""
        found = [decoded(units, self.count, self.height, seed) for seed in range(self.codes)]
        return np.concatenate([r for r, _ in found]), np.concatenate([f + seed * self.count**2 for seed, (_, f) in enumerate(found)])


def _height(dims: int, count: int, passed: float) -> float:
    """The height that random vectors exceed with `passed` of count * count filters on average."""
    if count * count <= 1 << 14:
        sample = unit(np.random.default_rng((dims, 1)).normal(size=(256, dims)))
        first, second = halves(sample, count, 0)
        return float(np.quantile((first[:, :, None] + second[:, None, :]).ravel(), max(0.0, 1 - passed / count**2)))
    # a product with a random direction of many components is nearly normal
    return NormalDist().inv_cdf(1 - passed / count**2) * math.sqrt(2 / max(dims, 2))


@functools.lru_cache(maxsize=64)
def plan(dims: int, rows: int, cosine: float, recall: float) -> Plan:
    """Filters for `rows` vectors: the fewest, on average, with which random pairs of the least cosine share one with probability `recall`.

    A vector passes more or fewer filters of one code than others do; several codes, independent of each other, level that.
    """
    rng = np.random.default_rng((dims, 2))
    one = unit(rng.normal(size=(PAIRS, dims)))
    noise = rng.normal(size=(PAIRS, dims))
    noise -= (noise * one).sum(axis=1)[:, None] * one
    length = np.linalg.norm(noise, axis=1)[:, None]
    # in one dimension nothing is at right angles
    two = cosine * one + math.sqrt(max(0.0, 1 - cosine**2)) * np.divide(noise, length, out=np.zeros_like(noise), where=length > 1e-9)
    two = unit(two)
    plans = {}
    for passed in (4, 6, 8, 12, 16, 24, 32):
        count = max(8, math.ceil(math.sqrt(rows * passed / AIM)))
        height = _height(dims, count, passed)
        shared = [set(zip(*(x.tolist() for x in decoded(v, count, height)), strict=True)) for v in (one, two)]
        met = len({row for row, _ in shared[0] & shared[1]}) / PAIRS
        # one pair that does not meet is assumed
        codes = max(1, math.ceil(math.log(1 - recall) / math.log(max(1 - met, 1 / PAIRS))))
        plans[passed * codes] = Plan(dims, count, height, codes, met)
    return plans[min(plans)]
