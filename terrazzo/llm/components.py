"""Connected components of a table of links by alternating large and small stars.

Each round lets every node pass its least neighbour on; the links end as one star for each component, round its least node. Rounds grow with the
logarithm of the number of nodes, and each is written to the shared folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrazzo.session import staged


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("_m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("_m").alias("v")).where("u <> v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("_m"))
    joined = down.join(least, "u")
    passed = joined.select(F.col("v").alias("u"), F.col("_m").alias("v"))
    return passed.unionByName(least.select("u", F.col("_m").alias("v"))).where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component (its least node) of every node that has a link. `links`: u, v, both whole numbers, no nulls."""
    now = staged(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "links")
    seen = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if state == seen:
            break
        seen = state
        now = staged(_small_star(_large_star(now)), "links")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
