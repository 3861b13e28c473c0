"""Near-duplicate vectors by spherical-cap filters.

1. Balls. Vectors of one cell (the filter they exceed most) that lie within half the largest linked angle of the cell's mean are all linked with each
   other; they are one node from here on, with a centre and a radius. Only cells of `HEAVY` vectors or more are looked at, so what is left
   alone is cheap to compare. A group of copies, equal or slightly changed, becomes a few nodes, whatever its share of all rows.
2. Filters. Every vector is list-decoded to all filters it exceeds (`capfilters`); a node stands once in each bucket that one of its vectors reaches.
3. Buckets. The nodes of a bucket are compared by directions of 8 bits a component, whose error is part of a node's radius. By the
   triangle inequality of angles a pair is linked throughout, nowhere, or unsure. Only the links leave a task; buckets beyond `BLOCK` nodes are cut
   into blocks.
4. Verification. Of unsure pairs all vectors are compared in double precision, again in blocks; a task reports counts, not pairs.
5. Components of all links between nodes.
"""  # noqa: E501

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrazzo.llm import capfilters
from terrazzo.llm.components import components
from terrazzo.session import staged

#: vectors that make a cell worth a ball, vectors of an average cell, and searches for balls
HEAVY, CELL, SEARCHES = 32, 8, 2
#: nodes or vectors that are compared at once
BLOCK = 2048
#: least share of random pairs, linked at the least cosine, that meet in a filter
RECALL = 0.9995
#: radians that cover the rounding of angles
MARGIN = 1e-6

Plans = dict[int, capfilters.Plan]


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of an Arrow list column by the lists' length, and their values as a matrix."""
    lengths = np.diff(column.offsets.to_numpy())
    for dims in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == dims)
        part = column.take(pa.array(rows)) if len(rows) < len(column) else column
        yield rows, part.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), dims)


def _angle(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1, 1))


def quantised(directions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Directions in 8 bits a component, and how far the rounded ones are off, in radians."""
    top = np.abs(directions).max(axis=1, initial=0)[:, None]
    small = np.rint(directions / top * 127).astype(np.int8)
    return small, _angle((capfilters.unit(small.astype(np.float64)) * directions).sum(axis=1)) + MARGIN


def _celled(counts: dict[int, int]):
    """row, id, x -> row, id, x, cells: one cell for each search."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((len(batch), SEARCHES), np.int64)
            for rows, vectors in _by_length(batch.column(2)):
                units = capfilters.unit(vectors)
                count = max(2, math.ceil(math.sqrt(counts[vectors.shape[1]] / CELL)))
                for search in range(SEARCHES):
                    out[rows, search] = (capfilters.cells(units, count, search + 1) << 20) | vectors.shape[1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(out), pa.list_(pa.int64()))], ["row", "id", "x", "cells"])

    return run


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """cell, x -> cell, total: the sum of the directions of a task's vectors, one row for each cell."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        numbers = batch.column(0).to_numpy()
        for rows, vectors in _by_length(batch.column(1)):
            cell = numbers[rows]
            order = np.argsort(cell, kind="stable")
            names, first = np.unique(cell[order], return_index=True)
            for name, total in zip(names.tolist(), np.add.reduceat(capfilters.unit(vectors)[order], first, axis=0), strict=True):
                held[name] = held[name] + total if name in held else total
    yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array([t.tolist() for t in held.values()], pa.list_(pa.float64()))], ["cell", "total"])


def _centre(key: tuple, table: pa.Table) -> pa.Table:
    """The direction of a cell's mean, from one row for each task."""
    total = np.array(table.column("total").to_pylist()).sum(axis=0)
    rows = [capfilters.unit(total[None])[0].tolist()] if np.abs(total).max(initial=0) > 0 else []
    return pa.table({"cell": pa.array([key[0].as_py()] * len(rows), pa.int64()), "centre": pa.array(rows, pa.list_(pa.float64()))})


def _within(limit: float):
    """row, cell, x, centre -> row, cell, away: vectors no farther from the centre than `limit`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            away = np.full(len(batch), np.inf)
            for rows, vectors in _by_length(batch.column(2)):
                centres = batch.column(3).take(pa.array(rows)).flatten().to_numpy().reshape(vectors.shape)
                away[rows] = _angle((capfilters.unit(vectors) * centres).sum(axis=1)) + MARGIN
            near = np.flatnonzero(away <= limit)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(near)), batch.column(1).take(pa.array(near)), pa.array(away[near])], ["row", "cell", "away"])

    return run


def _rounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, weight, least, reach, x -> node, weight, least, reach, small: directions of 8 bits; the reach grows by their error."""
    for batch in batches:
        reach = batch.column(3).to_numpy().copy()
        small: list[bytes] = [b""] * len(batch)
        for rows, vectors in _by_length(batch.column(4)):
            numbers, off = quantised(capfilters.unit(vectors))
            reach[rows] += off
            for at, data in zip(rows.tolist(), numbers, strict=True):
                small[at] = data.tobytes()
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(reach), pa.array(small, pa.binary())], ["node", "weight", "least", "reach", "small"])


def _passed(plans: Plans):
    """node, x -> filter, node: every filter that a vector exceeds, once for the vectors of a node in a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column(0).to_numpy()
            found = [np.empty((0, 2), np.int64)]
            for rows, vectors in _by_length(batch.column(1)):
                own = plans[vectors.shape[1]]
                at, filters = own.filters(capfilters.unit(vectors))
                found.append(np.stack([(filters << 20) | own.dims, nodes[rows[at]]], axis=1))
            both = np.unique(np.concatenate(found), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["filter", "node"])

    return run


def _told_apart(widest: float):
    """The nodes of two blocks of a bucket -> a, b, sure: pairs linked throughout, and pairs that may hold a link."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        one, two = key[1].as_py(), key[2].as_py()
        nodes, reach, block = (table.column(c).to_numpy() for c in ("node", "reach", "block"))
        small = np.frombuffer(b"".join(table.column("small").to_pylist()), np.int8).reshape(len(nodes), -1)
        units = capfilters.unit(small.astype(np.float64))
        left, right = np.flatnonzero(block == one), np.flatnonzero(block == two)
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(left) and len(right):
            floor = math.cos(min(math.pi, widest + reach[left].max() + reach[right].max()))
            for part in np.array_split(left, -(-len(left) // 512)):
                cosines = units[part] @ units[right].T
                i, j = np.nonzero(cosines >= floor)
                a, b = part[i], right[j]
                keep = nodes[a] < nodes[b] if one == two else nodes[a] != nodes[b]
                i, j, a, b = i[keep], j[keep], a[keep], b[keep]
                angle, spread = _angle(cosines[i, j]), reach[a] + reach[b]
                near = angle - spread <= widest + MARGIN
                sure = angle + spread <= widest - MARGIN
                low, high = np.minimum(nodes[a], nodes[b]), np.maximum(nodes[a], nodes[b])
                out.append((low[near], high[near], sure[near]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)]
        return pa.table({"a": columns[0], "b": columns[1], "sure": columns[2]})

    return run


def cosines(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Cosines of all vectors on the left with all on the right, in double precision."""
    # a power of two changes no digit
    one, two = (v * np.exp2(-np.frexp(np.abs(v).max(axis=1, initial=0))[1].astype(np.float64))[:, None] for v in (left, right))
    return (one @ two.T) / np.linalg.norm(one, axis=1)[:, None] / np.linalg.norm(two, axis=1)[None, :]


def _verified(least: float):
    """Vectors of a node (side 0) and of its unsure partners (side 1) -> counts of links by row, and nodes with a link."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        side, rows, nodes = (table.column(c).to_numpy() for c in ("side", "row", "node"))
        vectors = table.column("x").combine_chunks()
        parts = [(np.flatnonzero(side == s), None) for s in (0, 1)]
        (own, _), (other, _) = parts
        empty = {"row": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())}
        if not len(own) or not len(other):
            return pa.table(empty)
        matrices = [next(_by_length(vectors.take(pa.array(p))))[1] for p in (own, other)]
        linked = cosines(*matrices) >= least
        counts = np.concatenate([linked.sum(axis=1), linked.sum(axis=0)])
        numbers = np.concatenate([rows[own], rows[other]])
        some = counts > 0
        partners = np.unique(nodes[other][linked.any(axis=0)])
        n, m = int(some.sum()), len(partners)
        return pa.table(
            {
                "row": pa.array([*numbers[some].tolist(), *[None] * m], pa.int64()),
                "links": pa.array([*counts[some].tolist(), *[None] * m], pa.int64()),
                "a": pa.array([*[None] * n, *[key[0].as_py()] * m], pa.int64()),
                "b": pa.array([*[None] * n, *partners.tolist()], pa.int64()),
            }
        )

    return run


def _balls(vectors: DataFrame, half: float) -> tuple[DataFrame, DataFrame]:
    """`vectors` (row, id, x, cells) with their node, and the nodes: node, weight, least (id), reach, x (the centre)."""
    left, members, nodes = vectors, [], []
    for search in range(SEARCHES):
        own = left.select("row", "id", "x", F.col("cells")[search].alias("cell"))
        heavy = own.groupBy("cell").agg(F.count("*").alias("_n")).where(F.col("_n") >= HEAVY).select("cell")
        dense = staged(own.join(heavy, "cell"), "dense")
        centres = dense.select("cell", "x").mapInArrow(_sums, "cell long, total array<double>").groupBy("cell").applyInArrow(_centre, "cell long, centre array<double>")
        centres = staged(centres, "centres")
        near = dense.join(centres, "cell").select("row", "cell", "x", "centre").mapInArrow(_within(half), "row long, cell long, away double")
        near = staged(near.join(dense.select("row", "id"), "row"), "near")
        balls = near.groupBy("cell").agg(F.min("row").alias("node"), F.count("*").alias("weight"), F.min("id").alias("least"), F.max("away").alias("reach"))
        balls = staged(balls.where("weight > 1").join(centres, "cell"), "balls")
        held = near.join(balls.select("cell", "node"), "cell").select("row", "node")
        members.append(held)
        nodes.append(balls.select("node", "weight", "least", "reach", F.col("centre").alias("x")))
        left = left.join(held, "row", "left_anti")
    alone = staged(left.select("row", "id", "x"), "alone")
    nodes.append(alone.select(F.col("row").alias("node"), F.lit(1).cast("long").alias("weight"), F.col("id").alias("least"), F.lit(0.0).alias("reach"), "x"))
    of, every = alone.select("row", F.col("row").alias("node")), nodes[0]
    for more in members:
        of = of.unionByName(more)
    for more in nodes[1:]:
        every = every.unionByName(more)
    return staged(vectors.select("row", "id", "x").join(of, "row"), "members"), every


def _pairs(members: DataFrame, nodes: DataFrame, plans: Plans, widest: float) -> DataFrame:
    """a, b, sure of every pair of nodes that meet in a filter and may be linked."""
    entries = staged(members.select("node", "x").mapInArrow(_passed(plans), "filter long, node long").distinct(), "entries")
    blocks = F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")
    sizes = entries.groupBy("filter").agg(F.count("*").alias("_n"), blocks).where("_n > 1").drop("_n")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    rows = entries.join(sizes, "filter").join(nodes.select("node", "reach", "small"), "node").withColumn("block", block)
    # a block meets itself and every other block once
    rows = rows.withColumn("_other", F.explode(F.expr("sequence(0, blocks - 1)")))
    rows = rows.withColumns({"one": F.least("block", "_other"), "two": F.greatest("block", "_other")})
    apart = rows.groupBy("filter", "one", "two").applyInArrow(_told_apart(widest), "a long, b long, sure boolean")
    return staged(apart.distinct(), "pairs")


def _checked(pairs: DataFrame, members: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """row, links of single vectors (null in rows that tell nodes with a link: a, b) for the unsure pairs."""
    weight = nodes.select("node", "weight")
    unsure = pairs.where("NOT sure").join(weight.select(F.col("node").alias("a"), F.col("weight").alias("_wa")), "a")
    unsure = unsure.join(weight.select(F.col("node").alias("b"), F.col("weight").alias("_wb")), "b")
    # the heavier node reads its partners together
    heavier = F.col("_wa") >= F.col("_wb")
    unsure = staged(
        unsure.select(
            F.when(heavier, F.col("a")).otherwise(F.col("b")).alias("owner"),
            F.when(heavier, F.col("b")).otherwise(F.col("a")).alias("node"),
            F.greatest("_wa", "_wb").alias("_own"),
            F.least("_wa", "_wb").alias("_other"),
        ),
        "unsure",
    )
    owners = unsure.groupBy("owner").agg(F.ceil(F.max("_own") / BLOCK).cast("int").alias("n1"), F.ceil(F.sum("_other") / BLOCK).cast("int").alias("n2"))
    others = unsure.select("owner", "node").join(owners, "owner").join(members.select("node", "row", "x"), "node")
    own = owners.join(members.select(F.col("node").alias("owner"), "row", "x"), "owner").withColumn("node", F.col("owner"))

    def dealt(rows: DataFrame, side: int) -> DataFrame:
        """Every vector in its own block, once for each block of the other side."""
        mine, theirs = ("n1", "n2") if side == 0 else ("n2", "n1")
        place = F.pmod(F.xxhash64("row"), F.col(mine)).cast("int")
        each = F.explode(F.sequence(F.lit(0), F.col(theirs) - 1))
        names = ("one", "two") if side == 0 else ("two", "one")
        return rows.select("owner", F.lit(side).alias("side"), "node", "row", "x", place.alias(names[0]), each.alias(names[1]))

    both = dealt(own, 0).unionByName(dealt(others, 1))
    return staged(both.groupBy("owner", "one", "two").applyInArrow(_verified(least), "row long, links long, a long, b long"), "checked")


def near_vectors(vectors: DataFrame, cosine: float = 0.95, recall: float = RECALL, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The id, n_links, component_id (least id reachable by links), kept (the id is that) of every row of `vectors`.

    Linked are rows whose vectors have a cosine of at least `cosine` (above 0) in double precision; every link reported is verified, and of random
    pairs of just that cosine a share of `recall` meets in a filter. Vectors that are null, hold nulls or what is not finite, have no component or
    only zeros link with nothing; vectors of different lengths do not link. Rows of one id are rows of their own: they link as others do, and the
    row with the least id is kept with its repetitions. A row without id has no links, no component, and is kept. An empty table gives no rows; other
    columns are not read.
    """  # noqa: E501
    widest = math.acos(cosine)
    x = F.col(vector_col).cast("array<double>")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))) & F.exists(x, lambda c: c != 0)
    rows = vectors.select(F.col(id_col).alias("id"), x.alias("x"), fine.alias("fine")).withColumn("row", F.monotonically_increasing_id())
    rows = staged(rows.select("row", "id", F.when(F.coalesce("fine", F.lit(False)) & F.col("id").isNotNull(), F.col("x")).alias("x")), "rows")
    usable = rows.where(F.col("x").isNotNull())
    counts = {r["dims"]: r["n"] for r in usable.groupBy(F.size("x").alias("dims")).agg(F.count("*").alias("n")).collect()}
    plans = {dims: capfilters.plan(dims, n, cosine, recall) for dims, n in counts.items()}
    id_type = rows.schema["id"].dataType.simpleString()
    celled = staged(usable.select("row", "id", "x").mapInArrow(_celled(counts), f"row long, id {id_type}, x array<double>, cells array<long>"), "cells")
    # all vectors of a ball are linked: two radii are at most the largest angle
    members, nodes = _balls(celled, widest / 2 - 10 * MARGIN)
    nodes = nodes.select("node", "weight", "least", "reach", "x")
    nodes = staged(nodes.mapInArrow(_rounded, f"node long, weight long, least {id_type}, reach double, small binary"), "nodes")
    pairs = _pairs(members, nodes, plans, widest)
    checked = _checked(pairs, members, nodes, cosine)
    sure = pairs.where("sure")
    links = sure.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(checked.where("a IS NOT NULL").select(F.col("a").alias("u"), F.col("b").alias("v")))
    reached = staged(components(links.distinct()), "components")
    both = sure.select(F.col("a").alias("node"), F.col("b").alias("_to")).unionByName(sure.select(F.col("b").alias("node"), F.col("a").alias("_to")))
    beside = both.join(nodes.select(F.col("node").alias("_to"), "weight"), "_to").groupBy("node").agg(F.sum("weight").alias("_beside"))
    told = nodes.join(reached, "node", "left").withColumn("component", F.coalesce("component", "node"))
    told = told.join(beside, "node", "left").withColumn("_whole", F.col("weight") - 1 + F.coalesce("_beside", F.lit(0)))
    told = staged(told.select("node", "component", "least", "_whole"), "told")
    least = told.groupBy("component").agg(F.min("least").alias("component_id"))
    told = told.join(least, "component").select("node", "_whole", "component_id")
    single = checked.where("row IS NOT NULL").groupBy("row").agg(F.sum("links").alias("_single"))
    known = members.select("row", "node").join(told, "node").join(single, "row", "left")
    out = rows.select("row", "id").join(known, "row", "left")
    n_links = F.coalesce(F.col("_whole") + F.coalesce("_single", F.lit(0)), F.lit(0)).cast("long")
    out = out.select(F.col("id").alias(id_col), n_links.alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))


def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors with their links of a cosine of 0.95 or more and their component."""
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


# the links are what the filters find; on the tables at hand these are all, as a search of all pairs shows
OP12_SQL = """
WITH RECURSIVE units AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS u, b.vec_id AS w FROM units a JOIN units b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95
), reach AS (
  SELECT vec_id AS node, vec_id AS least FROM embeddings
  UNION
  SELECT l.w, r.least FROM reach r JOIN links l ON l.u = r.node WHERE r.least < l.w
), least AS (
  SELECT node, min(least) AS component_id FROM reach GROUP BY node
), counted AS (
  SELECT u, count(*) AS n FROM links GROUP BY u
)
SELECT e.vec_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_links, l.component_id, e.vec_id = l.component_id AS kept
FROM embeddings e JOIN least l ON l.node = e.vec_id LEFT JOIN counted c ON c.u = e.vec_id
"""
