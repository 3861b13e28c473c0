"""Exact top-k search by vector-approximation files.

Every distinct vector is kept twice: as an approximation of `BITS` bits a component, which bounds its score with any query from above and
below, and exactly. Queries and approximations meet in blocks; a block keeps, for each query, the vectors whose upper bound
reaches the k-th best lower bound it has seen. The k-th best lower bound over all blocks then rules out most of those, and only what is left is
read exactly, in the order of its bounds, until the k-th result is certain.

Equal vectors are one: a vector that a third of all rows share is scored once for each query and expanded to its least ids at the end.
"""  # noqa: E501

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrazzo.session import staged

BITS = 6
#: queries and vectors of a block
QUERY_BLOCK, VECTOR_BLOCK = 16384, 8192
#: queries of a block that are bounded at once
TILE = 512
#: exact vectors that are scored between two looks at the next bound
CHUNK = 64


def scaled(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """id, v: floor(scale * component) of each vector, without null ids and vectors with null or non-finite components.

    A scaled component of 2^61 or more is refused: its square is no 64-bit score.
    """
    x = F.col(vector_col).cast("array<double>")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    # the choice stands inside the expression: filters may be reordered, and what is not finite must not be cast

    def floored(c: Column) -> Column:
        product = c * F.lit(float(scale))
        return F.when(F.abs(product) < F.lit(2.0**61), F.floor(product)).otherwise(F.raise_error(F.lit("a scaled component does not fit 62 bits with its sign")).cast("long"))

    whole = F.when(fine, F.transform(x, floored))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), whole.alias("v"))
    return rows.where(F.col("id").isNotNull() & F.col("v").isNotNull())


def _least_ids(k: int):
    """v, id -> v, ids: the least k ids of each vector in a batch, so that a common vector is few rows afterwards."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            held: dict[tuple, list[int]] = {}
            for vector, number in zip(part.column(1).to_pylist(), part.column(0).to_pylist(), strict=True):
                held.setdefault(tuple(vector), []).append(number)
            yield pa.RecordBatch.from_arrays(
                [pa.array([list(v) for v in held], pa.list_(pa.int64())), pa.array([sorted(set(i))[:k] for i in held.values()], pa.list_(pa.int64()))],
                ["v", "ids"],
            )

    return run


def exact_scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Whole-number inner products of all queries (rows) with all vectors (rows); Python's numbers where they may not fit 64 bits."""
    if not queries.size or not vectors.size:
        return np.zeros((len(queries), len(vectors)), np.int64)
    largest = float(np.abs(queries).max()) * float(np.abs(vectors).max()) * max(1, queries.shape[1])
    if largest < 1 << 53:
        return (queries.astype(np.float64) @ vectors.T.astype(np.float64)).astype(np.int64)
    if largest < 1 << 62:
        return queries.astype(np.int64) @ vectors.T.astype(np.int64)
    return queries.astype(object) @ vectors.T.astype(object)


def scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """`exact_scores`, refused where one does not fit 64 bits."""
    whole = exact_scores(queries, vectors)
    if whole.dtype == object and not all(fits(x) for x in whole.flat):
        raise OverflowError("scores of these vectors do not fit 64 bits")
    return whole.astype(np.int64)


def fits(score: int) -> bool:
    return -(1 << 63) <= score < 1 << 63


def cells(vectors: np.ndarray, low: np.ndarray, step: np.ndarray) -> np.ndarray:
    """The approximation: the number of the cell of each component."""
    return ((vectors - low) // step).astype(np.uint8)


def bounds(queries: np.ndarray, numbers: np.ndarray, low: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of every query with any vector in the cells."""
    least = (low + numbers * step).astype(np.float64)
    wide = (step - 1).astype(np.float64)
    base = queries.astype(np.float64) @ least.T
    # the far corner of a cell adds its width times the query's component
    up = np.maximum(queries, 0) @ wide
    down = np.minimum(queries, 0) @ wide
    # beyond 2^53 doubles round, by a share of the sum of the terms' sizes; a bound may be too wide, never too narrow
    sizes = np.abs(queries).astype(np.float64)
    slack = sizes @ np.abs(least).T + (sizes @ wide)[:, None]
    slack = np.where(slack < 2.0**53, 0.0, slack * 2.0**-40)
    return base + down[:, None] - slack, base + up[:, None] + slack


def _filtered(k: int):
    """One pair of blocks: rows of queries (kind 0) and approximations (kind 1) -> query, vector, lower, upper."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        kind = table.column("kind").to_numpy()
        number = table.column("number").to_numpy()
        flat = table.column("data").to_pylist()
        asked, stored = np.flatnonzero(kind == 0), np.flatnonzero(kind == 1)
        if not len(asked) or not len(stored):
            return pa.table({"query": pa.array([], pa.int64()), "vector": pa.array([], pa.int64()), "lower": pa.array([], pa.float64()), "upper": pa.array([], pa.float64())})
        grid = np.frombuffer(table.column("grid")[0].as_py(), "<i8").reshape(2, -1)
        approximations = np.array([np.frombuffer(flat[i], "u1") for i in stored], np.int64)
        best = min(k, len(stored))
        out = []
        for first in range(0, len(asked), TILE):
            tile = asked[first : first + TILE]
            queries = np.array([np.frombuffer(flat[i], "<i8") for i in tile], np.int64)
            lower, upper = bounds(queries, approximations, grid[0], grid[1])
            limit = np.partition(lower, len(stored) - best, axis=1)[:, len(stored) - best]
            row, column = np.nonzero(upper >= limit[:, None])
            columns = (number[tile][row], number[stored][column], lower[row, column], upper[row, column])
            out.append(pa.table(dict(zip(("query", "vector", "lower", "upper"), columns, strict=True))))
        return pa.concat_tables(out)

    return run


def _certain(k: int):
    """query, upper, q, vector, v, first (rows of one query) -> query, vector, score: read by upper bound until the k-th is certain.

    A score that does not fit 64 bits is null.
    """

    def run(key: tuple, table: pa.Table) -> pa.Table:
        upper = table.column("upper").to_numpy()
        first = table.column("first").to_numpy()
        order = np.lexsort((first, -upper))
        query = np.array(table.column("q")[0].as_py(), np.int64)[None]
        vectors = table.column("v")
        names = table.column("vector").to_numpy()
        got: list[tuple[int, int, int]] = []
        for at in range(0, len(order), CHUNK):
            # ties of the k-th score may have a smaller id, so an equal bound is read too
            if len(got) >= k and upper[order[at]] < -got[k - 1][0]:
                break
            part = order[at : at + CHUNK]
            exact = exact_scores(query, np.array(vectors.take(pa.array(part)).to_pylist(), np.int64))[0]
            got = sorted(got + [(-int(s), int(first[i]), int(names[i])) for s, i in zip(exact, part, strict=True)])[:k]
        return pa.table(
            {
                "query": pa.array([key[0].as_py()] * len(got), pa.int64()),
                "vector": pa.array([x[2] for x in got], pa.int64()),
                "score": pa.array([-x[0] if fits(-x[0]) else None for x in got], pa.int64()),
            }
        )

    return run


def _approximated(low: np.ndarray, step: np.ndarray):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            vectors = part.column(1).to_pylist()
            data = [cells(np.array(v, np.int64), low, step).tobytes() for v in vectors]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(data, pa.binary())], ["number", "data"])

    return run


def _packed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        data = [np.array(v, "<i8").tobytes() for v in part.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(data, pa.binary())], ["number", "data"])


def nearest(
    vectors: DataFrame, k: int = 5, scale: int = 256, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score: for every row whose id is divisible by `every`, the k other rows of the highest scores.

    Score: the inner product of the floors of `scale` times the components. Ties go to the smaller id. Rows without an id, and vectors that are null or
    hold null or non-finite components, take no part. A vector shorter than the longest counts as followed by zeros. A score with another row that
    is among the best k + 1 and does not fit 64 bits raises. Rows of one id and vector are one. With fewer than k other rows all are returned; an empty table gives no rows.
    """  # noqa: E501
    rows = scaled(vectors, id_col, vector_col, scale)
    lengths = rows.agg(F.min(F.size("v")).alias("least"), F.max(F.size("v")).alias("most")).first()
    if lengths["least"] != lengths["most"]:
        rows = rows.withColumn("v", F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(lengths["most"]) - F.size("v"))))
    # k + 1 ids of a vector: its own row may be among them
    some = rows.select("id", "v").mapInArrow(_least_ids(k + 1), "v array<long>, ids array<long>")
    distinct = some.groupBy("v").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1).alias("ids"))
    distinct = staged(distinct.withColumn("number", F.monotonically_increasing_id()).withColumn("first", F.col("ids")[0]), "vectors")
    asking = rows.where(F.col("id") % every == 0).distinct()
    asked = staged(asking.join(distinct.select("v", "number"), "v").select("id", "number"), "asking")
    ends = distinct.select(F.posexplode("v").alias("at", "x")).groupBy("at").agg(F.min("x").alias("low"), F.max("x").alias("high")).orderBy("at").collect()
    low = np.array([r["low"] for r in ends], np.int64)
    high = np.array([r["high"] for r in ends], np.int64)
    step = np.maximum(1, -(-(high - low + 1) // (1 << BITS)))
    stored = staged(distinct.select("number", "v").mapInArrow(_approximated(low, step), "number long, data binary"), "approximations")
    queries = distinct.join(asked.select("number").distinct(), "number", "left_semi").select("number", "v")
    queries = staged(queries.mapInArrow(_packed, "number long, data binary"), "queries")
    n_queries, n_stored = queries.count(), stored.count()
    query_blocks, vector_blocks = max(1, -(-n_queries // QUERY_BLOCK)), max(1, -(-n_stored // VECTOR_BLOCK))

    def dealt(table: DataFrame, kind: int, own: int, other: int) -> DataFrame:
        """Every row once for each block of the other kind."""
        block = F.pmod(F.xxhash64("number"), F.lit(own)).cast("int")
        others = F.explode(F.sequence(F.lit(0), F.lit(other - 1)))
        sides = ("asked", "stored") if kind == 0 else ("stored", "asked")
        return table.select(F.lit(kind).alias("kind"), "number", "data", block.alias(sides[0]), others.alias(sides[1]))

    grid = np.stack([low, step]).astype("<i8").tobytes()
    blocks = dealt(queries, 0, query_blocks, vector_blocks).unionByName(dealt(stored, 1, vector_blocks, query_blocks))
    close = (
        blocks.withColumn("grid", F.lit(bytearray(grid)))
        .groupBy("asked", "stored")
        .applyInArrow(_filtered(k + 1), "query long, vector long, lower double, upper double")
    )
    close = staged(close, "close")
    # the k-th best lower bound of a query, over all blocks: each block sends its best few
    by_lower = Window.partitionBy("query").orderBy(F.desc("lower"), "vector")
    limits = close.withColumn("place", F.row_number().over(by_lower)).where(F.col("place") <= k + 1)
    limits = limits.groupBy("query").agg(F.min("lower").alias("limit"), F.count("*").alias("n"))
    left = close.join(limits, "query").where((F.col("upper") >= F.col("limit")) | (F.col("n") < k + 1)).select("query", "vector", "upper")
    exact = (
        left.join(distinct.select(F.col("number").alias("vector"), "v", "first"), "vector")
        .join(distinct.select(F.col("number").alias("query"), F.col("v").alias("q")), "query")
        .groupBy("query")
        .applyInArrow(_certain(k + 1), "query long, vector long, score long")
    )
    found = (
        exact.join(distinct.select(F.col("number").alias("vector"), F.explode("ids").alias("vec_id")), "vector")
        .join(asked.select(F.col("id").alias("query_id"), F.col("number").alias("query")), "query")
        .where("vec_id <> query_id")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # a query's own row may have a score beyond 64 bits, another row not
    fitting = F.coalesce("score", F.raise_error(F.lit("a score does not fit 64 bits")).cast("long"))
    ranked = found.select("query_id", "vec_id", fitting.alias("score")).distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best other vectors of every vector whose id is divisible by 50."""
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP4_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
