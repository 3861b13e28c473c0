"""Checks of declared table rules, each returning the offending rows or counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrazzo.errors import ContractError


def duplicate_keys(df: DataFrame, *key: str) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def orphans(df: DataFrame, parent: DataFrame, column: str, parent_key: str) -> DataFrame:
    """Rows whose foreign key has no parent. A null key is not an orphan."""
    keys = parent.select(F.col(parent_key).alias("_parent"))
    return df.filter(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("_parent"), "left_anti")


def fits(column: Column, dtype: T.DataType, length: int | None = None) -> Column:
    """The value can be stored in the type: digits of a decimal, length of a text."""
    if length is not None:
        return column.isNull() | (F.length(column) <= length)
    return column.isNull() | column.try_cast(dtype).isNotNull()


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row per rule with the number of rows that break it, in one pass.

    A rule is a condition that must hold; null does not break it.
    """
    counts = df.agg(*[F.count_if(~rule).alias(name) for name, rule in rules.items()])
    return counts.unpivot([], list(rules), "rule", "n_broken")


def not_null(*columns: str) -> dict[str, Column]:
    return {f"{c} is null": F.col(c).isNotNull() for c in columns}


def one_of(column: str, values: list) -> dict[str, Column]:
    return {f"{column} unknown": F.col(column).isin(*values)}


def fits_schema(schema: T.StructType, lengths: dict[str, int] = {}) -> dict[str, Column]:
    """Rules that every column fits its declared type or length."""
    rules = {f"{f.name} too wide": fits(F.col(f.name), f.dataType) for f in schema if f.name not in lengths}
    return rules | {f"{c} too long": fits(F.col(c), T.StringType(), n) for c, n in lengths.items()}


def require(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Return the table if no rule is broken, else raise. Runs one job over the table."""
    broken = violations(df, rules).filter("n_broken > 0").collect()
    if broken:
        raise ContractError("; ".join(f"{r.rule}: {r.n_broken} rows" for r in broken))
    return df


def enforced(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """The table, raising in the pass that reads it where a rule is broken; null breaks none. `require` says how many rows do."""
    for name, rule in rules.items():
        holds = F.when(F.coalesce(rule, F.lit(True)), F.lit(True)).otherwise(F.raise_error(F.lit(name)).cast("boolean"))
        df = df.filter(holds)
    return df


def evolved(df: DataFrame, schema: T.StructType, defaults: dict[str, object] = {}, strict: bool = True) -> DataFrame:
    """Cast to the schema in its column order, adding missing columns with their default or null.

    A value that does not fit raises in the pass that reads it, naming its column. With `strict=False` it becomes
    null; count such values with `misfits` first.
    """
    have = set(df.columns)

    def cast(f: T.StructField) -> Column:
        if f.name not in have:
            return F.lit(defaults.get(f.name)).cast(f.dataType)
        value = F.col(f.name)
        if not strict:
            return value.try_cast(f.dataType)
        says = F.concat(F.lit(f"{f.name} does not fit {f.dataType.simpleString()}: "), value.cast("string"))
        return F.when(fits(value, f.dataType), value.try_cast(f.dataType)).otherwise(F.raise_error(says).cast(f.dataType))

    return df.select(*[cast(f).alias(f.name) for f in schema])


def misfits(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Number of values of each column that do not fit its declared type."""
    have = set(df.columns)
    return violations(df, fits_schema(T.StructType([f for f in schema if f.name in have])))


def unique(df: DataFrame, *key: str) -> DataFrame:
    """The table, raising in the pass that reads it where a key stands more than once.

    For tables of one row per key, such as gold: their rows are counted in a window over the key.
    """
    times = F.count("*").over(Window.partitionBy(*key))
    says = F.concat(F.lit(f"more than one row for {', '.join(key)}: "), F.to_json(F.struct(*key)))
    checked = F.when(F.col("_times") == 1, F.lit(True)).otherwise(F.raise_error(says).cast("boolean"))
    return df.withColumn("_times", times).filter(checked).drop("_times")
