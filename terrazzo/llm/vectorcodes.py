"""Vector code compression: a vector becomes one codebook number for each of its parts.

Codebooks start as the parts of the vectors of the smallest ids and are refined in rounds: every part goes to its nearest entry, then entries move to the
floors of their parts' means. The nearest entry comes from memoised grid cells (`gridcells`). A round is one pass over the vectors: tasks
send one partial sum for each entry, and only the entries, a bounded number, come to the driver and go out with the next pass.

All arithmetic is on whole numbers, so neither the order of rows nor their partitions change a result.
"""  # noqa: E501

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrazzo.llm import gridcells
from terrazzo.session import staged

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: width of a grid cell, in whole numbers
CELL = 32
LARGEST = (1 << 63) - 1

Books = list[np.ndarray]


def finite_vectors(vectors: DataFrame, id_col: str, label_col: str | None, vector_col: str) -> DataFrame:
    """id, label, x (array of doubles) of the vectors that are not null and hold neither nulls nor what is not finite."""
    x = F.col(vector_col).cast("array<double>")
    fine = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    label = F.col(label_col) if label_col else F.lit(None)
    return vectors.where(fine).select(F.col(id_col).alias("id"), label.alias("label"), x.alias("x"))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of doubles of an Arrow list column whose lists all have `dims` values."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dims)


def parts_of(points: np.ndarray, parts: int) -> list[np.ndarray]:
    """Consecutive parts of all points: equal, or the first ones longer by one where the length cannot be divided."""
    return np.array_split(points, parts, axis=1)


def _partial_sums(books: Books, dims: int, scale: int, cell: int):
    """x -> part, entry, n, sums (decimal texts): one row for each entry that a task has used."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [gridcells.Cells(b, cell) for b in books]
        sums = [np.zeros(b.shape, object) for b in books]
        counts = [np.zeros(len(b), np.int64) for b in books]
        for batch in batches:
            for k, points in enumerate(parts_of(gridcells.whole(matrix(batch.column(0), dims), scale), len(books))):
                if not len(points):
                    continue
                codes, _ = cells[k].nearest(points)
                order = np.argsort(codes, kind="stable")
                used, first = np.unique(codes[order], return_index=True)
                # a batch has far fewer rows than 2^20
                wide = points.astype(object) if points.dtype == object or (points.size and np.abs(points).max() >= 1 << 42) else points
                sums[k][used] += np.add.reduceat(wide[order], first, axis=0).astype(object)
                counts[k] += np.bincount(codes, minlength=len(books[k]))
        rows = [(k, e, int(n), [str(s) for s in sums[k][e]]) for k in range(len(books)) for e, n in enumerate(counts[k]) if n]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.string())))],
            ["part", "entry", "n", "sums"],
        )

    return run


def _means(key: tuple, table: pa.Table) -> pa.Table:
    """The floors of the means of one entry; its partial sums are as many as tasks."""
    n = sum(table.column("n").to_pylist())
    sums = [sum(map(int, column)) for column in zip(*table.column("sums").to_pylist(), strict=True)]
    return pa.table({"part": [key[0].as_py()], "entry": [key[1].as_py()], "means": pa.array([[str(s // n) for s in sums]], pa.list_(pa.string()))},
                    schema=pa.schema({"part": pa.int32(), "entry": pa.int32(), "means": pa.list_(pa.string())}))


def _coded(books: Books, dims: int, scale: int, cell: int):
    """id, label, x -> id, label, code, error; vectors of another length have neither code nor error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [gridcells.Cells(b, cell) for b in books]
        for batch in batches:
            vectors = batch.column(2)
            fits = np.flatnonzero(np.diff(vectors.offsets.to_numpy()) == dims)
            codes: list[str | None] = [None] * len(batch)
            errors: list[int | None] = [None] * len(batch)
            if len(fits):
                points = gridcells.whole(matrix(vectors.take(pa.array(fits)), dims), scale)
                found = [cells[k].nearest(p) for k, p in enumerate(parts_of(points, len(books)))]
                for row, at in enumerate(fits.tolist()):
                    codes[at] = "".join(f"{entries[row]:02x}" for entries, _ in found)
                    error = sum(int(distances[row]) for _, distances in found)
                    errors[at] = error if error <= LARGEST else None
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(codes, pa.string()), pa.array(errors, pa.int64())], ["id", "label", "code", "error"]
            )

    return run


def refined(rows: DataFrame, books: Books, dims: int, scale: int = SCALE, cell: int = CELL) -> Books:
    """One round: the codebooks after every part of `rows` (x) has gone to its nearest entry; unused entries stay."""
    partial = rows.select("x").mapInArrow(_partial_sums(books, dims, scale, cell), "part int, entry int, n long, sums array<string>")
    means = partial.groupBy("part", "entry").applyInArrow(_means, "part int, entry int, means array<string>")
    out = [b.copy() for b in books]
    # as many rows as entries
    for r in means.collect():
        new = [int(m) for m in r["means"]]
        if any(abs(m) > LARGEST >> 1 for m in new):
            out[r["part"]] = out[r["part"]].astype(object)
        out[r["part"]][r["entry"]] = new
    return out


def compressed(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    cell: int = CELL,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
) -> DataFrame:
    """The id, code, error, label_error, codebooks_sha256 of every vector that is not null and holds neither nulls nor what is not finite.

    Components are the floors of `scale` times their values, however large. Codebooks start with the `entries` smallest ids (rows of one id in the
    order of their vectors, rows without id last), fewer if there are fewer, and are refined `rounds` times. The vector of the smallest id sets the
    length: one of another length keeps its row and has neither code nor error, nor a share in a codebook. Lengths that
    `parts` does not divide give the first parts one component more. An error, or the sum of a label's errors, beyond 64 bits is null. Rows of one id are
    vectors of their own. An empty table gives no rows. At most 256 entries, so that a code has two digits a part.
    """  # noqa: E501
    if not 0 < entries <= 256:
        raise ValueError("a code of two hex digits tells 256 entries at most")
    rows = staged(finite_vectors(vectors, id_col, label_col, vector_col), "finite")
    by_id = [F.col("id").asc_nulls_last(), "x"]
    leader = rows.orderBy(*by_id).limit(1).collect()
    dims = len(leader[0]["x"]) if leader else 0
    fitting = rows.where(F.size("x") == dims)
    smallest = [r["x"] for r in fitting.select("id", "x").orderBy(*by_id).limit(entries).collect()]
    first = np.array(smallest, np.float64).reshape(len(smallest), dims)
    books = [np.ascontiguousarray(b) for b in parts_of(gridcells.whole(first, scale), parts)]
    for _ in range(rounds if len(first) else 0):
        books = refined(fitting, books, dims, scale, cell)
    label_type = rows.schema["label"].dataType.simpleString()
    id_type = rows.schema["id"].dataType.simpleString()
    coded = staged(rows.mapInArrow(_coded(books, dims, scale, cell), f"id {id_type}, label {label_type}, code string, error long"), "codes")
    by_label = coded.groupBy(F.col("label").alias("_label")).agg(F.try_sum("error").alias("label_error"))
    text = ",".join(str(c) for book in books for entry in book.tolist() for c in entry)
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("_label"))).select(
        F.col("id").alias(id_col), "code", "error", "label_error", F.lit(hashlib.sha256(text.encode()).hexdigest()).alias("codebooks_sha256")
    )


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The code of every vector, its error, its label's error and the digest of all codebooks."""
    return compressed(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _assigned_sql(number: int) -> str:
    """Each part with its nearest entry: the number in the lowest digits of the least distance settles ties."""
    distance = "list_inner_product(p.p, p.p) - 2 * list_inner_product(p.p, b.e) + list_inner_product(b.e, b.e)"
    return f"""near{number} AS MATERIALIZED (
  SELECT p.row, p.part, any_value(p.p) AS p, min(CAST({distance} AS BIGINT) * 256 + b.entry) AS best
  FROM pieces p JOIN book{number} b ON b.part = p.part GROUP BY p.row, p.part
)"""


def _refined_sql(number: int) -> str:
    return f"""{_assigned_sql(number)}, mean{number} AS (
  SELECT part, entry, list(m ORDER BY pos) AS e FROM (
    SELECT part, entry, pos, floor(sum(x) / count(*)) AS m
    FROM (SELECT part, best % 256 AS entry, unnest(range(1, len(p) + 1)) AS pos, unnest(p) AS x FROM near{number}) GROUP BY part, entry, pos
  ) GROUP BY part, entry
), book{number + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.e, b.e) AS e FROM book{number} b LEFT JOIN mean{number} m ON m.part = b.part AND m.entry = b.entry
)"""


OP13_SQL = f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v, row_number() OVER (ORDER BY vec_id, embedding) - 1 AS row
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pieces AS MATERIALIZED (
  SELECT row, vec_id, label, part, v[CAST(part * len(v) / {PARTS} AS BIGINT) + 1:CAST((part + 1) * len(v) / {PARTS} AS BIGINT)] AS p
  FROM kept, range({PARTS}) r(part)
), book0 AS MATERIALIZED (
  SELECT part, row AS entry, p AS e FROM pieces WHERE row < {ENTRIES}
), {", ".join(_refined_sql(n) for n in range(ROUNDS))}, {_assigned_sql(ROUNDS)}, told AS (
  SELECT row, string_agg(printf('%02x', CAST(best % 256 AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(best // 256) AS BIGINT) AS error
  FROM near{ROUNDS} GROUP BY row
), books AS (
  SELECT sha256(string_agg(array_to_string(list_transform(e, lambda x: CAST(x AS BIGINT)), ','), ',' ORDER BY part, entry)) AS codebooks_sha256
  FROM book{ROUNDS}
)
SELECT k.vec_id, t.code, t.error, CAST(sum(t.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, b.codebooks_sha256
FROM kept k JOIN told t ON t.row = k.row CROSS JOIN books b
"""
