"""Names for columns that stand beside a caller's own."""

from __future__ import annotations

from pyspark.sql import DataFrame


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """`wanted`, each with as many underscores more as it takes to be no column of `df`, whatever the letters' case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
