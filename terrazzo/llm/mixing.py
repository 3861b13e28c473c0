"""Mixing sources to target weights by a low-discrepancy schedule, DataFrame operations only.

The documents of a source, shuffled by a hash, form a stream of words that is cut into blocks of equal length. The
mix is a row of slots; slot i belongs to the source into whose interval of cumulative weights the i-th point of the golden-ratio sequence
falls, and the r-th slot of a source takes the source's r-th block, going round again when it has no more.

Nothing of a source is in one task: positions come from sums over `BUCKETS` hash buckets of a source and a window within each, ranks
from counts over chunks of slots and a window within each. One row per source is ordered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrazzo.llm.names import fresh
from terrazzo.session import staged

WORD = r"[^\x20\x09-\x0D]+"
BUCKETS = 1024
CHUNK = 1 << 16
CELL_BITS = 12
POINT_BITS = 31
#: 2^31 over the golden ratio, to the nearest (odd) number: multiples of it mod 2^31 are the golden-ratio points, and each of the
#: 2^31 points is met once in every 2^31 slots
GOLDEN = 1_327_217_885


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """row (its own number), id, source, size of every document, written to the shared folder: the texts are read once."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col)).alias("size"),
    )
    return staged(rows, "sizes")


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, limit: float) -> DataFrame:
    """One row for each source: src (0, 1, ... by code point, null last), source, source_size, target.

    Targets share `share` times all sizes in proportion to the weights (repeated in the order of sources), but none is above `limit`
    times its source's size; what is above is shared by the others again. With the sources in the order of
    limit over weight those above are the first ones, so one running sum settles it.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    src = F.row_number().over(by_name) - 1
    weight = F.get(F.array(*(F.lit(float(w)) for w in weights)), (F.col("src") % len(weights)).cast("int"))
    rows = sources.withColumn("src", src).withColumn("_weight", weight).withColumn("_cap", F.col("source_size") * float(limit))
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_level = Window.orderBy(F.col("_cap") / F.col("_weight"), "src")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_level.rowsBetween(0, Window.unboundedFollowing)
    wanted = F.sum("source_size").over(everything) * float(share)
    level = (wanted - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_weight").over(onward)
    rows = rows.withColumns({"_wanted": wanted, "_level": level})
    rows = rows.withColumn("_full", F.col("_cap") / F.col("_weight") <= F.col("_level"))
    left = F.col("_wanted") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("_cap"))).over(everything), F.lit(0.0))
    open_weight = F.sum(F.when(~F.col("_full"), F.col("_weight"))).over(everything)
    target = F.when(F.col("_full"), F.col("_cap")).otherwise(left * F.col("_weight") / open_weight)
    return rows.select("src", "source", "source_size", target.alias("target"))


def with_needs(sources: DataFrame, block: int) -> DataFrame:
    """`sources` with the blocks of each and the slots it needs: whole rounds through its blocks, then `rest` words."""
    words = F.floor("target")
    rows = sources.withColumns(
        {
            "blocks": F.ceil(F.col("source_size") / block),
            "rounds": F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(F.lit(0)).cast("long"),
        }
    )
    rows = rows.withColumn("rest", words - F.col("rounds") * F.col("source_size"))
    return rows.withColumn("need", F.col("rounds") * F.col("blocks") + F.ceil(F.col("rest") / block))


def schedule(sources: DataFrame) -> DataFrame:
    """slot, src, rank: which source each slot belongs to, and the how-manieth of its source it is.

    `sources`: src and need, small and written. A source has exactly `need` slots: surplus points of the sequence
    are left empty, and the few slots by which the sequence falls short follow at the end (slot null).
    """
    spark = sources.sparkSession
    total = sources.agg(F.sum("need")).first()[0] or 0
    rising = Window.orderBy("src")
    scale = float(1 << POINT_BITS) / max(total, 1)
    edge = F.sum("need").over(rising)
    bounds = sources.select(
        "src", "need", F.floor((edge - F.col("need")) * scale).alias("lo"), F.floor(edge * scale).alias("hi")
    ).where("hi > lo")
    shift = POINT_BITS - CELL_BITS
    # at most one row for each source and each of the 2^CELL_BITS cells of the unit interval in which it begins or lies
    cells = bounds.withColumn("cell", F.explode(F.expr(f"sequence(shiftright(lo, {shift}), shiftright(hi - 1, {shift}))")))
    mask = (1 << POINT_BITS) - 1
    slots = spark.range(total).select(
        F.col("id").alias("slot"),
        (F.col("id").bitwiseAND(F.lit(mask)) * F.lit(GOLDEN)).bitwiseAND(F.lit(mask)).alias("point"),
    )
    dealt = (
        slots.withColumn("cell", F.shiftright("point", shift))
        .join(cells, "cell")
        .where("point >= lo AND point < hi")
        .select("slot", "src", "need", F.expr(f"slot div {CHUNK}").alias("chunk"))
    )
    counts = dealt.groupBy("src", "chunk").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("src").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("src", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    inside = Window.partitionBy("src", "chunk").orderBy("slot")
    ranked = (
        dealt.withColumn("_in", F.row_number().over(inside) - 1)
        .join(starts, ["src", "chunk"])
        .withColumn("rank", F.col("start") + F.col("_in"))
        .where("rank < need")
        .select("slot", "src", "rank")
    )
    got = counts.groupBy("src").agg(F.sum("n").alias("got"))
    short = (
        sources.join(got, "src", "left")
        .withColumn("got", F.coalesce("got", F.lit(0)))
        .where("got < need")
        .select(F.lit(None).cast("long").alias("slot"), "src", F.explode(F.expr("sequence(got, need - 1)")).alias("rank"))
    )
    return ranked.unionByName(short)


def positions(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """`sizes` with src and `start`, the place of the document's first word in its source's shuffled stream."""
    bucket = F.pmod(F.col("_hash"), F.lit(BUCKETS))
    rows = (
        sizes.join(sources.select("src", F.col("source").alias("_source")), F.col("source").eqNullSafe(F.col("_source")))
        .drop("_source")
        .withColumn("_hash", F.xxhash64("id", "size"))
        .withColumn("_bucket", bucket)
    )
    totals = rows.groupBy("src", "_bucket").agg(F.sum("size").alias("_words"))
    earlier = Window.partitionBy("src").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("src", "_bucket", F.coalesce(F.sum("_words").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("src", "_bucket").orderBy("_hash", "row").rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.withColumn("_inside", F.sum("size").over(inside) - F.col("size"))
        .join(starts, ["src", "_bucket"])
        .withColumn("start", F.col("_before") + F.col("_inside"))
        .drop("_before", "_inside", "_hash", "_bucket")
    )


def mixed_pieces(sizes: DataFrame, sources: DataFrame, block: int) -> DataFrame:
    """The mix: slot, src, rank, row, id, first, words. A slot holds words first .. first + words - 1 of each document of its block."""
    placed = positions(sizes, sources).where("size > 0")
    pieces = placed.withColumn("block", F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")))
    begin = F.greatest(F.col("start"), F.col("block") * block)
    end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block)
    pieces = pieces.select(
        "src", "block", "row", "id", (begin - F.col("start")).alias("first"),
        (begin - F.col("block") * block).alias("_at"), (end - begin).alias("_words"),
    )
    slots = (
        schedule(sources)
        .join(sources.select("src", "blocks", "rounds", "rest"), "src")
        .withColumns({"block": F.expr("rank % blocks"), "_round": F.expr("rank div blocks")})
        # the last slot of a source takes what is left of its target
        .withColumn("_take", F.when(F.col("_round") == F.col("rounds"), F.col("rest") - F.col("block") * block).otherwise(F.lit(block)))
        .select("slot", "src", "rank", "block", "_take")
    )
    words = F.least(F.col("_words"), F.col("_take") - F.col("_at"))
    return slots.join(pieces, ["src", "block"]).withColumn("words", words).where("words > 0").select(
        "slot", "src", "rank", "row", "id", "first", "words"
    )


def mixture(
    docs: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    limit: float = 2.0,
    block: int = 512,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sizes, sources, pieces) of a mix of `docs`, see `sized`, `targets` and `mixed_pieces`.

    Each source's pieces hold its target, rounded down to whole words. A document without words or text has no pieces; null is a
    source like any other; a document of a repeated id is a document of its own; without documents, or words, the mix is empty.
    Runs on the same files agree.
    """
    sizes = sized(docs, id_col, text_col, source_col)
    sources = staged(with_needs(targets(sizes, weights, share, limit), block), "sources")
    return sizes, sources, mixed_pieces(sizes, sources, block)


def taken(sizes: DataFrame, sources: DataFrame, pieces: DataFrame) -> DataFrame:
    """row, id, source, size, source_size, target and `taken`: the words the mix takes from each document, repeats counted."""
    words = pieces.groupBy("row").agg(F.sum("words").alias("taken"))
    named = sources.select(F.col("source").alias("_source"), "source_size", "target")
    return (
        sizes.join(words, "row", "left")
        .join(named, F.col("source").eqNullSafe(F.col("_source")))
        .select("row", "id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))
    )


def mixed(docs: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """`docs` as the mix holds them: each document as often as the mix takes its words, to the nearest whole number.

    Rows of one id stand equally often. A document without words, which no slot holds, stands once.
    """
    own, times, again = fresh(docs, "_id", "_times", "_again")
    words = taken(*mixture(docs, id_col=id_col, **how)).groupBy("id").agg(F.sum("taken").alias("taken"), F.sum("size").alias("size"))
    rounded = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(F.lit(1)).cast("int")
    counted = words.select(F.col("id").alias(own), rounded.alias(times)).where(F.col(times) > 0)
    found = docs.join(counted, docs[id_col].eqNullSafe(counted[own]))
    return found.withColumn(again, F.explode(F.sequence(F.lit(1), times))).select(*docs.columns)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the words that the mix takes from each."""
    parts = mixture(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return taken(*parts).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "source")
