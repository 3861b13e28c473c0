"""Near-duplicate vectors and vector codes against brute force: nulls, odd lengths, huge and tiny values, ties, copies, clashing names."""

from __future__ import annotations

import hashlib
import math
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrazzo.llm import capfilters, gridcells, vecdup, vectorcodes

CLASHING = ["id", "x", "row", "node", "weight", "least", "reach", "small", "cell", "cells", "code", "error", "a", "b", "links", "fine", "_n", "_label", "part"]
ODD = [(None, 0), ([], 1), ([0.0] * 12, 2), ([float("nan")] + [1.0] * 11, 0), ([None] * 12, None), ([float("inf")] + [0.0] * 11, 1), ([1.0, 2.0], 1), ([2.0, 4.0], 1), ([3.0], 2), ([-3.0], 2)]


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    loose = rng.normal(0, 0.2, (120, 12))
    base = rng.normal(0, 1, 12)
    near = base + rng.normal(0, 0.12, (150, 12))  # about the least cosine: sure, unsure and unlinked pairs
    chain = np.cumsum(rng.normal(0, 0.15, (30, 12)), axis=0) + rng.normal(0, 1, 12)
    copies = np.repeat(rng.normal(0, 1, (2, 12)), [90, 3], axis=0) * rng.choice([1.0, 2.0, 1e-200, 1e200], (93, 1))
    rows = [r.tolist() for r in np.concatenate([loose, near, chain, copies])]
    out = [(1000 - i if i % 2 else i, v, i % 4 if i % 5 else None) for i, v in enumerate(rows)]
    out += [(2000 + i, v, label) for i, (v, label) in enumerate(ODD)]
    return out + [(7, rows[7], 3), (7, rows[200], 3), (None, rows[130], None)]


@pytest.fixture(scope="module")
def table(spark, vectors):
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label int").repartition(6)
    return df.withColumns({c: F.lit(c) for c in CLASHING})


def usable(v) -> bool:
    return v is not None and len(v) > 0 and all(c is not None and math.isfinite(c) for c in v) and any(v)


def brute_links(rows: list[tuple], least: float) -> Counter:
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    counts = [0] * len(rows)
    for a, (i, v, _) in enumerate(rows):
        for b, (j, w, _) in enumerate(rows[:a]):
            if i is None or j is None or not usable(v) or not usable(w) or len(v) != len(w):
                continue
            p, q = (np.array(y) / np.abs(y).max() for y in (v, w))
            if p @ q / math.sqrt(p @ p) / math.sqrt(q @ q) >= least:
                counts[a] += 1
                counts[b] += 1
                parent[root(a)] = root(b)
    smallest = {}
    for a, (i, _, _) in enumerate(rows):
        if i is not None:
            smallest[root(a)] = min(smallest.get(root(a), i), i)
    return Counter((i, counts[a], None if i is None else smallest[root(a)], i is None or i == smallest[root(a)]) for a, (i, _, _) in enumerate(rows))


@pytest.mark.parametrize("block", [vecdup.BLOCK, 16])
def test_near_vectors(table, vectors, monkeypatch, block):
    monkeypatch.setattr(vecdup, "BLOCK", block)
    assert Counter(tuple(r) for r in vecdup.near_vectors(table).collect()) == brute_links(vectors, 0.95)


def test_near_vectors_without_rows_or_links(table):
    assert vecdup.near_vectors(table.limit(0)).collect() == []
    alone = vecdup.near_vectors(table.where("vec_id IN (2000, 2002, 2008)")).collect()
    assert {tuple(r) for r in alone} == {(i, 0, i, True) for i in (2000, 2002, 2008)}


def test_filters_find_what_a_search_of_all_finds():
    rng = np.random.default_rng(5)
    for dims in (1, 2, 5, 16):
        units = capfilters.unit(rng.normal(size=(40, dims)))
        for height in (0.1, 0.7, 1.2):
            first, second = capfilters.halves(units, 9, 0)
            want = {(r, i * 9 + j) for r in range(40) for i in range(9) for j in range(9) if first[r, i] + second[r, j] >= height}
            assert set(zip(*(x.tolist() for x in capfilters.decoded(units, 9, height)), strict=True)) == want


def test_recall_at_the_least_cosine(spark):
    """Of pairs of just over the least cosine, among many other vectors, practically all are found."""
    rng = np.random.default_rng(9)
    one = capfilters.unit(rng.normal(size=(1500, 64)))
    noise = rng.normal(size=one.shape)
    noise = capfilters.unit(noise - (noise * one).sum(axis=1)[:, None] * one)
    two = 0.9505 * one + math.sqrt(1 - 0.9505**2) * noise
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([one, two]))]
    got = vecdup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)).collect()
    assert sum(r["n_links"] == 1 and r["component_id"] == r["vec_id"] % 1500 for r in got) >= 0.998 * len(rows)


def test_rounded_directions_stay_in_reach():
    units = capfilters.unit(np.random.default_rng(1).normal(size=(500, 64)))
    small, off = vecdup.quantised(units)
    assert small.dtype == np.int8 and (np.arccos((capfilters.unit(small.astype(float)) * units).sum(axis=1)) <= off).all() and off.max() < 0.02


def brute_codes(rows, parts=4, entries=256, rounds=4, scale=1024):
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return Counter()
    dims = len(kept[0][1])
    whole = {k: [math.floor(Fraction(c) * scale) for c in v] for k, (_, v, _) in enumerate(kept) if len(v) == dims}
    cuts = [len(c) for c in np.array_split(np.arange(dims), parts)]
    starts = [sum(cuts[:p]) for p in range(parts)]
    pieces = {k: [w[s : s + n] for s, n in zip(starts, cuts, strict=True)] for k, w in whole.items()}
    books = [[pieces[k][p] for k in list(whole)[:entries]] for p in range(parts)]

    def nearest(p, piece):
        return min((sum((a - b) ** 2 for a, b in zip(piece, e, strict=True)), n) for n, e in enumerate(books[p]))

    for _ in range(rounds):
        groups = defaultdict(list)
        for ps in pieces.values():
            for p in range(parts):
                groups[p, nearest(p, ps[p])[1]].append(ps[p])
        for (p, n), members in groups.items():
            books[p][n] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    text = ",".join(str(c) for book in books for e in book for c in e)
    sha = hashlib.sha256(text.encode()).hexdigest()
    found, errors = {}, Counter()
    for k, ps in pieces.items():
        best = [nearest(p, ps[p]) for p in range(parts)]
        error = sum(d for d, _ in best)
        found[k] = "".join(f"{n:02x}" for _, n in best), error if error < 1 << 63 else None
        errors[kept[k][2]] += found[k][1] or 0
    held = {kept[k][2] for k in found if found[k][1] is not None}
    return Counter((i, *found.get(k, (None, None)), errors[label] if label in held else None, sha) for k, (i, _, label) in enumerate(kept))


def test_vector_codes(table, vectors):
    small = [r for r in vectors if r[1] is None or not any(c is not None and abs(c) > 1e100 for c in r[1]) or not usable(r[1])]
    got = vectorcodes.compressed(table.where("embedding IS NULL OR NOT exists(embedding, c -> abs(c) > 1e100 AND abs(c) < double('inf'))"), entries=16)
    assert Counter(tuple(r) for r in got.collect()) == brute_codes(small, entries=16)
    assert vectorcodes.compressed(table.limit(0)).collect() == []


def test_vector_codes_of_any_size(spark):
    """Components beyond 64 bits are coded exactly; errors beyond 64 bits are null."""
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 6) * 10.0 ** rng.choice([-3, 0, 8, 30, 300])], i % 3) for i in range(40)]
    rows += [(50 + i, [-0.0005, 5e-324, -5e-324, 1e8, -1e8, 1.0], None) for i in range(3)]
    got = vectorcodes.compressed(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3), entries=5)
    assert Counter(tuple(r) for r in got.collect()) == brute_codes(rows, entries=5)


def test_fewer_vectors_than_entries_and_empty_vectors(spark):
    schema = "vec_id long, embedding array<double>, label int"
    rows = [(i, [i / 8, 1.0, -i / 4, 0.0, 2.0], 1) for i in range(5)]
    assert Counter(tuple(r) for r in vectorcodes.compressed(spark.createDataFrame(rows, schema)).collect()) == brute_codes(rows)
    bare = [(1, [], 1), (2, [], None), (3, [1.0], None)]
    assert Counter(tuple(r) for r in vectorcodes.compressed(spark.createDataFrame(bare, schema)).collect()) == brute_codes(bare)


def test_cells_hold_the_nearest_entry():
    rng = np.random.default_rng(4)
    for width in (1, 7, 64, 100_000):
        book, points = rng.integers(-300, 300, (40, 5)), rng.integers(-400, 400, (500, 5))
        book[7] = book[3]  # a tie
        cells = gridcells.Cells(book, width)
        distances = ((points[:, None] - book) ** 2).sum(axis=2)
        for _ in range(2):  # the second time from memory
            codes, errors = cells.nearest(points)
            assert codes.tolist() == distances.argmin(axis=1).tolist() and errors.tolist() == distances.min(axis=1).tolist()
        assert cells.bounded == len(cells.known) == len({tuple(p) for p in (points // width).tolist()})
    assert gridcells.Cells(book, 7).nearest(points[:0])[0].tolist() == []
