"""Benchmark decontamination: which documents hold at least a share of an item's word shingles.

Items are short and documents long, so similarity says nothing and containment is searched instead. Items are partitioned by size; in a partition every
item has a MinHash sketch, its shingles of the least hashes, as many as a document that holds the wanted share may miss in an item of the partition's
greatest size, and `SPARE` more. Documents stream past a bit filter of all item shingles, which leaves a few hashes of each. A document whose hashes hold too
few of a sketch for the wanted share cannot hold the item: this bound is exact, so no item is missed by chance. The others are
candidates, and a candidate is confirmed by counting the item's whole shingle set in the document's.

No text is shuffled. The filter has a fixed greatest size (`FILTER_BITS`): a larger benchmark makes it denser, which costs rows and loses nothing.
"""  # noqa: E501

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrazzo.llm.wordhash import shingles_of, utf8, word_lists
from terrazzo.session import staged

#: 32 MB at most
FILTER_BITS = 28
#: shingles of a sketch that a document must hold (all that its item can spare, if these are fewer)
SPARE = 4


def _item_shingles(shingle: int):
    """id, text -> id, width (words in a shingle), shingles (array)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            widths, found = [], []
            for words in word_lists(utf8(part.column(1))):
                widths.append(min(shingle, len(words)))
                found.append(np.unique(shingles_of(words, shingle)).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(widths, pa.int32()), pa.array(found, pa.list_(pa.int64()))], ["item", "width", "shingles"]
            )

    return run


def _hits(widths: list[int], bits: Broadcast, shift: int):
    """id, text -> id, hits: the distinct shingles of the wanted widths that pass the filter; texts without any are left out."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bits.value
        for part in parts:
            rows, hits = [], []
            for i, words in enumerate(word_lists(utf8(part.column(1)))):
                passed = []
                for width in widths:
                    if len(words) >= width:
                        hashes = shingles_of(words, width)
                        place = hashes >> np.uint64(shift)
                        word = table[(place >> np.uint64(6)).astype(np.int64)]
                        passed.append(hashes[(word >> (place & np.uint64(63))) & np.uint64(1) == 1])
                if passed and sum(map(len, passed)):
                    rows.append(i)
                    hits.append(np.unique(np.concatenate(passed)).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(rows, pa.int64())), pa.array(hits, pa.list_(pa.int64()))], ["id", "hits"]
            )

    return run


def _filter(shingles: DataFrame) -> tuple[np.ndarray, int]:
    """Bits of the filter of the column `h`, and by how much a hash is shifted to give its bit."""
    count = shingles.count()
    bits = min(FILTER_BITS, max(12, int(np.ceil(np.log2(64 * max(count, 1))))))
    place = F.shiftrightunsigned("h", 64 - bits)
    # one row for each 64 bits at most, whatever the number of items
    words = shingles.groupBy(F.shiftright(place, 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(shiftrightunsigned(h, %d) & 63 as int))" % (64 - bits))).alias("bits")
    )
    got = words.toArrow()
    table = np.zeros(1 << (bits - 6), np.uint64)
    table[got.column("word").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return table, 64 - bits


def sketches(shingles: DataFrame, percent: int) -> DataFrame:
    """number, h, needed: the sketch of each item, and how many of its hashes a document with the share holds at least.

    `shingles` has number, h and n (shingles of the item). Sizes up to a power of two are one partition, whose sketches have one size.
    """

    def missing(n: Column) -> Column:
        return n - F.ceil(n * percent / 100)

    size = missing(F.pow(F.lit(2.0), F.ceil(F.log2("n")))) + SPARE
    order = Window.partitionBy("number").orderBy(F.xxhash64("h"), "h")
    ranked = shingles.withColumn("place", F.row_number().over(order)).where(F.col("place") <= size)
    needed = F.greatest(F.lit(1), F.least(size, F.col("n")) - missing(F.col("n")))
    return ranked.select("number", "h", needed.cast("int").alias("needed"))


def candidates(hits: DataFrame, sketched: DataFrame) -> DataFrame:
    """row, number of documents that hold enough of an item's sketch."""
    met = hits.select("row", F.explode("hits").alias("h")).join(sketched, "h")
    return met.groupBy("row", "number").agg(F.count("*").alias("met"), F.max("needed").alias("needed")).where("met >= needed").select("row", "number")


def contained_items(
    docs: DataFrame, items: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """id, item, n_item, n_shared of every document and item of which the document holds at least `percent` hundredths of the shingles.

    Shingles are runs of `shingle` words, A-Z as a-z; an item with fewer words has its whole sequence as its one shingle, one
    without words is in no document. Repeated rows of an id give one row with the most shingles shared; a null id is an id. Null texts hold nothing.
    """  # noqa: E501
    spark = docs.sparkSession
    sets = items.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text")).mapInArrow(
        _item_shingles(shingle), f"item {dict(items.dtypes)[item_col]}, width int, shingles array<long>"
    )
    sets = staged(sets.where("width > 0").withColumn("number", F.monotonically_increasing_id()), "items")
    single = staged(sets.select("number", F.explode("shingles").alias("h"), F.size("shingles").alias("n")), "shingles")
    widths = sorted(r["width"] for r in sets.select("width").distinct().collect())
    table, shift = _filter(single.select("h").distinct())
    bits = spark.sparkContext.broadcast(table)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    hits = rows.mapInArrow(_hits(widths, bits, shift), f"id {dict(docs.dtypes)[id_col]}, hits array<long>")
    hits = staged(hits.withColumn("row", F.monotonically_increasing_id()), "hits")
    shared = F.size(F.array_intersect("hits", "shingles"))
    confirmed = (
        candidates(hits, sketches(single, percent))
        .join(hits, "row")
        .join(sets, "number")
        .select("id", "item", F.size("shingles").alias("n_item"), shared.alias("n_shared"))
        .where(F.col("n_shared") * 100 >= F.col("n_item") * percent)
    )
    return confirmed.groupBy(F.col("id").alias(id_col), F.col("item").alias(item_col)).agg(
        F.max("n_item").cast("long").alias("n_item"), F.max("n_shared").cast("long").alias("n_shared")
    )


def decontaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **how: int) -> DataFrame:
    """`docs` without the documents that hold an item. A document without id is kept unless a document without id holds one."""
    held = contained_items(docs, items, id_col=id_col, **how).select(F.col(id_col).alias("_held")).distinct()
    return docs.join(held, docs[id_col].eqNullSafe(held["_held"]), "left_anti")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item of whose 5-word shingles the document holds at least 0.8."""
    return contained_items(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP7_SQL = r"""
WITH words_of AS (
  SELECT 'd' AS kind, doc_id AS id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
  UNION ALL
  SELECT 'b', item_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') FROM benchmark
), items AS (
  SELECT DISTINCT id AS item_id, least(5, len(words)) AS width, unnest(list_transform(range(1, greatest(len(words) - 3, 2)), lambda i: array_to_string(words[i:i + 4], ' '))) AS shingle
  FROM words_of WHERE kind = 'b' AND len(words) > 0
), widths AS (
  SELECT DISTINCT width FROM items
), held AS (
  SELECT DISTINCT id AS doc_id, shingle FROM (
    SELECT id, unnest(list_transform(range(1, len(words) - width + 2), lambda i: array_to_string(words[i:i + width - 1], ' '))) AS shingle
    FROM words_of, widths WHERE kind = 'd' AND len(words) >= width
  ) WHERE shingle IN (SELECT shingle FROM items)
), sizes AS (
  SELECT item_id, count(*) AS n_item FROM items GROUP BY item_id
)
SELECT doc_id, item_id, n_item, count(*) AS n_shared
FROM held JOIN items USING (shingle) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id, n_item HAVING count(*) * 100 >= n_item * 80
"""  # noqa: E501
