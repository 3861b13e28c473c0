"""Sharding by a consistent-hash ring with virtual nodes and bounded loads, DataFrame operations only.

Every row has a place on a ring of 2^64 points: the hash of its text, so that copies stand side by side. Virtual
nodes cut the ring into arcs; a row belongs to the shard of the next node clockwise. A shard takes no more rows than its
capacity: what overflows goes on clockwise to the next shard with room.

Rows are sorted round the ring once (a range shuffle of narrow rows: a heavy text is split over partitions by doc_id) and
numbered. All that the driver sees are the row counts of `CELLS` ring cells; from those it works out which
stretches of the numbering go to which shard, at most a few times as many as there are virtual nodes.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrazzo.session import staged

CELL_BITS = 16
CELLS = 1 << CELL_BITS
#: stretches are looked up by blocks of the numbering, so many at most
LOOKUP_BLOCKS = 4096


def ring(shards: int, virtual_nodes: int) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node round the ring. A node's cell depends on its shard and its own number only.

    Two nodes on one cell: the smaller shard number comes first.
    """
    nodes = []
    for shard in range(shards):
        for node in range(virtual_nodes):
            digest = hashlib.blake2b(f"{shard}/{node}".encode(), digest_size=8).digest()
            nodes.append((int.from_bytes(digest, "big") >> (64 - CELL_BITS), shard))
    return sorted(nodes)


def stretches(counts: dict[int, int], shards: int, virtual_nodes: int, slack: float) -> list[tuple[int, int, int, int]]:
    """(first row, rows, shard, first slot): which rows, numbered round the ring, go to which shard.

    With a slack of 0 the capacities add up to the number of rows and differ by one at most.
    """
    total = sum(counts.values())
    if slack > 0:
        room = [-int(-(1 + slack) * total // shards)] * shards
    else:
        room = [total // shards + (shard < total % shards) for shard in range(shards)]
    nodes = ring(shards, virtual_nodes)
    # rows of an arc: those of the cells after the last node up to this one; the arc after the last node wraps round
    arcs, number, at = [], 0, 0
    cells = sorted(counts.items())
    for i, (cell, shard) in enumerate(nodes):
        first = number
        while at < len(cells) and cells[at][0] <= cell:
            number += cells[at][1]
            at += 1
        if number > first:
            arcs.append((i, first, number - first))
    if total > number:
        arcs.append((0, number, total - number))
    taken: list[tuple[int, int, int]] = []
    over: list[tuple[int, int, int]] = []
    for i, first, rows in arcs:
        shard = nodes[i][1]
        own = min(rows, room[shard])
        room[shard] -= own
        if own:
            taken.append((first, own, shard))
        if rows > own:
            over.append((i, first + own, rows - own))
    for i, first, rows in over:
        step = i
        while rows:
            step = (step + 1) % len(nodes)
            shard = nodes[step][1]
            more = min(rows, room[shard])
            if more:
                room[shard] -= more
                taken.append((first, more, shard))
                first, rows = first + more, rows - more
    slots = [0] * shards
    out = []
    for first, rows, shard in sorted(taken):
        out.append((first, rows, shard, slots[shard]))
        slots[shard] += rows
    return out


def ring_order(rows: DataFrame, key: str, order: str) -> DataFrame:
    """`rows` with `ring_cell` and `ring_number`: 0, 1, ... round the ring, written to the shared folder.

    Ties of `key` stand in the order of `order`'s hash, then `order`; equal rows in any order. A null key is a key.
    """
    place = F.xxhash64(F.col(key))
    tie = F.xxhash64(F.col(order))
    sorted_rows = (
        rows.withColumns({"_place": place, "_tie": tie})
        .repartitionByRange("_place", "_tie", order)
        .sortWithinPartitions("_place", "_tie", order)
        .drop(key)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    kept = staged(sorted_rows.drop("_tie"), "ring")
    part, at = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    # one row for each partition of the range shuffle: as few as the session has shuffle partitions
    parts = kept.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = F.expr("coalesce(sum(_rows) OVER (ORDER BY _part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)")
    starts = parts.select("_part", before.alias("_before"))
    # signed hashes: the sign bit is flipped so that cells rise in the order of sorting
    cell = (F.shiftright("_place", 64 - CELL_BITS) + F.lit(CELLS // 2)).cast("int")
    return (
        kept.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn("ring_cell", cell)
        .withColumn("ring_number", F.col("_before") + at)
        .drop("_part", "_before", "_at", "_place")
    )


def _lookup(spark: SparkSession, plan: list[tuple[int, int, int, int]], total: int, names: tuple[str, str]) -> tuple[DataFrame, int]:
    """The stretches as a table, one row for each block of the numbering that a stretch touches."""
    width = max(1, -(-total // LOOKUP_BLOCKS))
    rows = [
        (block, first, first + n, shard, slot)
        for first, n, shard, slot in plan
        for block in range(first // width, (first + n - 1) // width + 1)
    ]
    schema = f"_block long, _first long, _end long, {names[0]} int, {names[1]} long"
    return spark.createDataFrame(rows, schema), width


def ring_sharded(
    rows: DataFrame,
    key: str = "text",
    order: str = "doc_id",
    shards: int = 8,
    virtual_nodes: int = 128,
    slack: float = 0.0,
    grown: bool = False,
) -> DataFrame:
    """`rows` without `key`, with `shard` (0 to shards - 1) and `slot` (0, 1, ... in the shard).

    slack: how much a shard may hold above the mean, as a share of it. 0: counts are at most one apart; the larger it is, the fewer
    rows move when a shard is added. grown: adds `grown_shard`, the shard on a ring with one shard more.
    Null keys are one group of copies, as are empty texts; equal rows each get a slot of their own; an empty table gives no rows.
    """
    spark = rows.sparkSession
    numbered = ring_order(rows, key, order)
    counts = {r["ring_cell"]: r["n"] for r in numbered.groupBy("ring_cell").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    wanted = [(shards, ("shard", "_slot"))] + ([(shards + 1, ("grown_shard", "_grown_slot"))] if grown else [])
    out = numbered
    for count, names in wanted:
        table, width = _lookup(spark, stretches(counts, count, virtual_nodes, slack), total, names)
        number = F.col("ring_number")
        # at most LOOKUP_BLOCKS rows more than there are stretches, whatever the input
        out = (
            out.withColumn("_block", F.floor(number / width) if width == 1 else F.expr(f"ring_number div {width}"))
            .join(F.broadcast(table), "_block")
            .where((number >= F.col("_first")) & (number < F.col("_end")))
            .withColumn(names[1], F.col(names[1]) + number - F.col("_first"))
            .drop("_block", "_first", "_end")
        )
    out = out.withColumnRenamed("_slot", "slot")
    return out.drop("ring_cell", "ring_number", "_grown_slot")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 8 shards whose row counts are at most one apart."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        "text",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    out = ring_sharded(rows, shards=8)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
