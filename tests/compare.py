"""Strict comparison of a Spark result with its DuckDB twin."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value, digits: int):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return float(f"{value:.{digits}g}") + 0.0
    return value


def _rows(rows, names: list[str], digits: int) -> Counter:
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(_plain(row[i], digits) for i in order) for row in rows)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str, digits: int = 17) -> list[str]:
    """What differs in columns, types or rows; empty if nothing does."""
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    types = {c[0]: str(c[1]) for c in result.description}
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    for name, dtype in df.dtypes:
        if TYPES.get(dtype, dtype) != types[name]:
            problems.append(f"type of {name}: {dtype} against {types[name]}")
    ours, theirs = _rows(df.collect(), df.columns, digits), _rows(result.fetchall(), names, digits)
    if ours != theirs:
        extra, missing = ours - theirs, theirs - ours
        problems.append(
            f"rows {sum(ours.values())} against {sum(theirs.values())}; only ours {sum(extra.values())}: "
            f"{list(extra)[:3]}; only theirs {list(missing)[:3]}"
        )
    return problems
