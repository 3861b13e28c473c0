"""Updates of keyed tables, written as joins: no row passes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def one_per_key(rows: DataFrame, key: str, order: list[str] | None) -> DataFrame:
    """One row for each key that is not null: the last by `order`, or without an order the only one, more raising when read."""
    rows = rows.filter(F.col(key).isNotNull())
    if order:
        return latest_per_key(rows, key, order)
    others = [c for c in rows.columns if c != key]
    says = F.concat(F.lit(f"several rows for {key} "), F.col(key).cast("string"))
    only = F.when(F.col("_n") == 1, F.col("_row")).otherwise(F.raise_error(says).cast(T.StructType([rows.schema[c] for c in others])))
    return (
        rows.groupBy(key)
        .agg(F.any_value(F.struct(*others)).alias("_row"), F.count("*").alias("_n"))
        .withColumn("_row", only)
        .select(*[F.col(key) if c == key else F.col(f"_row.{c}").alias(c) for c in rows.columns])
    )


def update_matched(
    table: DataFrame, updates: DataFrame, key: str, columns: dict[str, str], order: list[str] | None = None
) -> DataFrame:
    """UPDATE by key without inserting; `columns` maps a table column to its column in `updates`.

    Rows without a match, and matches whose new value is null, keep the old value. Of several updates of a key the last by
    `order` counts; without an order they raise.
    """
    wanted = list(dict.fromkeys([key, *columns.values(), *(order or [])]))
    new = one_per_key(updates.select(*wanted), key, order).select(key, *[F.col(src).alias(f"_new_{dst}") for dst, src in columns.items()])
    joined = table.join(new, key, "left")
    return joined.select(
        *[
            F.coalesce(F.col(f"_new_{c}").cast(table.schema[c].dataType), F.col(c)).alias(c) if c in columns else F.col(c)
            for c in table.columns
        ]
    )


def upsert(table: DataFrame, rows: DataFrame, key: str, overwrite: list[str], order: list[str] | None = None) -> DataFrame:
    """INSERT, or where the key exists replace the `overwrite` columns and keep the others.

    Of several incoming rows of a key the last by `order` counts; without an order they raise.
    """
    wanted = list(dict.fromkeys([*table.columns, *(order or [])]))
    old, new = table.alias("o"), one_per_key(rows.select(*wanted), key, order).alias("n")
    known, incoming = F.col(f"o.{key}").isNotNull(), F.col(f"n.{key}").isNotNull()

    def merged(c: str):
        if c in overwrite:
            return F.when(incoming, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))
        return F.when(known, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}"))

    return old.join(new, F.col(f"o.{key}") == F.col(f"n.{key}"), "full").select(
        *[merged(c).cast(table.schema[c].dataType).alias(c) for c in table.columns]
    )


def latest_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of each key. `order` must break ties, for a deterministic result.

    One aggregation with map-side combining: a key with many rows sends one row per task.
    """
    others = [c for c in df.columns if c != key]
    return (
        df.groupBy(key)
        .agg(F.max_by(F.struct(*others), F.struct(*order)).alias("_last"))
        .select(key, *[F.col(f"_last.{c}").alias(c) for c in others])
        .select(*df.columns)
    )
