"""Near-duplicate documents: MinHash bands find candidates, whole shingle sets confirm them.

1. One pass over the texts gives every document a digest of its shingle set and the band hashes of a densified one-permutation MinHash sketch.
2. Documents of one set are one node from here on, so thousands of exact copies cost no more than one.
3. Nodes that share a band hash share a bucket. A bucket is not expanded into pairs: its least node is the centre of a star, and
   the similarity of each member with the centre is computed from the whole sets. Links make components.
4. Two members of a star may be linked though neither is linked with the centre. Stars whose members are still in several
   components are compared in blocks of bounded size, one task for two blocks: only members of different components, and only if their distances to the
   centre differ by no more than a link allows (the Jaccard distance is a metric). A task reports a spanning forest of the links it
   finds, never pairs.
5. Components of all links.

Bands of 5 values, 26 of them: two sets with a similarity of 0.85 share no bucket in 3 of 10 million cases, at 0.8 in 3 of 100,000.
"""  # noqa: E501

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrazzo.llm import minhash
from terrazzo.llm.components import components
from terrazzo.llm.names import fresh
from terrazzo.llm.wordhash import mixed, shingles_of, utf8, word_lists
from terrazzo.session import staged

#: members and shingles of a block, about
BLOCK = 256
BLOCK_SHINGLES = 1 << 18
#: columns of the incidence matrix that are multiplied at once
COLUMNS = 4096


def _sketches(shingle: int):
    """id, text -> id, n, two digests of the shingle set, band hashes (null without words)."""
    weights = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            sizes, digests, bands = [], [], []
            for words in word_lists(utf8(part.column(1))):
                found = np.unique(shingles_of(words, shingle))
                sizes.append(len(found))
                # order does not matter in a sum; two sums of independently mixed hashes tell sets apart
                digests.append([int(mixed(found * w).sum(dtype=np.uint64).view(np.int64)) for w in weights])
                bands.append(minhash.bands(minhash.sketch(found)).view(np.int64) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array([d[0] for d in digests], pa.int64()),
                    pa.array([d[1] for d in digests], pa.int64()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                ["id", "n", "d1", "d2", "bands"],
            )

    return run


def _overlaps(shingle: int):
    """a, b, text_a, text_b -> a, b, shared, united: sizes of the intersection and the union of their shingle sets."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, left = None, None  # rows come sorted by a
        for part in parts:
            ids = part.column(0).to_pylist()
            shared, united = [], []
            rights = word_lists(utf8(part.column(3)))
            lefts = utf8(part.column(2))
            for i, words in enumerate(rights):
                if ids[i] != held:
                    left = np.unique(shingles_of(next(word_lists([lefts[i]])), shingle))
                    held = ids[i]
                right = np.unique(shingles_of(words, shingle))
                # both sorted and distinct: a value stands twice in the merged row if it is in both
                both = np.sort(np.concatenate([left, right]))
                common = int((both[1:] == both[:-1]).sum())
                shared.append(common)
                united.append(len(left) + len(right) - common)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(shared, pa.int64()), pa.array(united, pa.int64())],
                ["a", "b", "shared", "united"],
            )

    return run


def forest(left: np.ndarray, right: np.ndarray, n: int) -> list[int]:
    """Numbers of the pairs of a spanning forest of the graph on 0 .. n - 1 with pairs (left, right)."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for k, (i, j) in enumerate(zip(left.tolist(), right.tolist(), strict=True)):
        a, b = root(i), root(j)
        if a != b:
            parent[a] = b
            kept.append(k)
    return kept


def block_links(sets: list[np.ndarray], labels: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between sets of different labels: their numbers."""
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.empty(len(values), bool)
    new[:1] = True
    new[1:] = values[1:] != values[:-1]
    column = np.cumsum(new) - 1
    # a shingle of one member only is in no intersection
    common = np.bincount(column) > 1
    column = (np.cumsum(common) - 1)[column][keep] if (keep := common[column]).any() else np.empty(0, np.int64)
    owner = owner[keep]
    shared = np.zeros((len(sets), len(sets)), np.float32)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        low, high = np.searchsorted(column, [first, first + COLUMNS])
        matrix = np.zeros((len(sets), COLUMNS), np.float32)
        matrix[owner[low:high], column[low:high] - first] = 1
        shared += matrix @ matrix.T  # whole numbers far below 2^24
    shared = shared.astype(np.int64)
    united = sizes[:, None] + sizes[None, :] - shared
    linked = (100 * shared >= percent * united) & (labels[:, None] != labels[None, :])
    left, right = np.nonzero(np.triu(linked, 1))
    kept = forest(left, right, len(sets))
    return left[kept], right[kept]


def _compared(shingle: int, percent: int):
    def run(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        labels = table.column("label").to_numpy()
        sets = [np.unique(shingles_of(w, shingle)) for w in word_lists(utf8(table.column("text").combine_chunks()))]
        left, right = block_links(sets, labels, percent)
        return pa.table({"u": pa.array(ids[left], pa.int64()), "v": pa.array(ids[right], pa.int64())})

    return run


def _blocks(members: DataFrame, window: float) -> DataFrame:
    """id, label, pair: the members of the stars that hold several components, once for each pair of blocks they are compared in.

    `members`: star, id, label, distance (to the centre, the member `star`), n.
    """
    counts = members.groupBy("star", "label").agg(F.count("*").alias("_n"))
    main = counts.groupBy("star").agg(F.max_by("label", F.struct("_n", "label")).alias("_main"), F.count("*").alias("_labels"), F.sum("_n").alias("_all"))
    # with two members the pair has been compared already
    main = main.where("_labels > 1 AND _all > 2")
    ring = F.floor(F.col("distance") / window).cast("int")
    rows = members.join(main, "star").withColumns({"ring": ring, "main": F.col("label") == F.col("_main")})
    sizes = rows.groupBy("star", "ring", "main").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_SHINGLES)).alias("chunks")
    )
    rows = rows.join(sizes, ["star", "ring", "main"]).withColumn("chunk", F.pmod(F.xxhash64("id"), "chunks"))
    blocks = sizes.withColumn("chunk", F.explode(F.expr("sequence(0L, chunks - 1)"))).drop("chunks")
    one, two = blocks.alias("one"), blocks.alias("two")
    order = F.struct(*(F.col(f"one.{c}") for c in ("ring", "main", "chunk"))) <= F.struct(*(F.col(f"two.{c}") for c in ("ring", "main", "chunk")))
    near = F.abs(F.col("one.ring") - F.col("two.ring")) <= 1
    pairs = one.join(two, (F.col("one.star") == F.col("two.star")) & near & order & ~(F.col("one.main") & F.col("two.main")))
    keys = ("star", "ring", "main", "chunk")
    pairs = pairs.select(
        F.col("one.star").alias("star"),
        F.array_distinct(F.array(*(F.struct(*(F.col(f"{side}.{c}").alias(c) for c in keys[1:])) for side in ("one", "two")))).alias("sides"),
        F.struct("one.star", *(F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in ("one", "two") for c in keys[1:])).alias("pair"),
    )
    pairs = pairs.withColumn("_side", F.explode("sides")).select("star", "_side.*", "pair")
    return rows.join(pairs, list(keys)).select("id", "label", "pair")


def linked(nodes: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """node, component of every node with a link. `nodes`: id, n, bands; `texts`: id, text, one row for each node and maybe others."""
    rows = nodes.select("id", "n", F.explode("bands").alias("bucket"))
    centres = rows.groupBy("bucket").agg(F.min("id").alias("a"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    stars = staged(rows.join(centres, "bucket").where("id <> a").select("a", F.col("id").alias("b"), "n").distinct(), "stars")
    involved = stars.select(F.col("a").alias("id")).unionByName(stars.select(F.col("b").alias("id"))).distinct()
    texts = staged(texts.join(involved, "id", "left_semi"), "texts")
    measured = staged(
        stars.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
        .join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
        .select("a", "b", "text_a", "text_b")
        .mapInArrow(_overlaps(shingle), "a long, b long, shared long, united long")
        .join(stars, ["a", "b"]),
        "measured",
    )
    found = measured.where(F.col("shared") * 100 >= F.col("united") * percent).select(F.col("a").alias("u"), F.col("b").alias("v"))
    first = staged(components(found), "components")
    members = measured.select(F.col("a").alias("star"), F.col("b").alias("id"), (1 - F.col("shared") / F.col("united")).alias("distance"), "n")
    members = members.unionByName(
        measured.groupBy(F.col("a").alias("star")).agg(F.max("united").alias("n")).select("star", F.col("star").alias("id"), F.lit(0.0).alias("distance"), "n")
    )
    members = members.join(first.withColumnRenamed("node", "id"), "id", "left").withColumn("label", F.coalesce("component", "id")).drop("component")
    more = (
        # a hair more than a link's largest distance, for the rounding of the quotient
        _blocks(staged(members, "members"), (100 - percent) / 100 + 1e-9)
        .join(texts, "id")
        .groupBy("pair")
        .applyInArrow(_without_key(_compared(shingle, percent)), "u long, v long")
    )
    more = staged(more, "more")
    again = found.unionByName(more)
    return components(again)


def _without_key(run):
    def grouped(key: tuple, table: pa.Table) -> pa.Table:
        return run(table)

    return grouped


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles, component_id (least id reachable by links), kept (the id is that) of every row of `docs`.

    Linked are documents whose sets of `shingle`-word runs have an intersection of at least `percent` hundredths of their union. A text
    with fewer words has its whole sequence as its one shingle; one without words, or null, has none and is linked with nothing.
    Rows of one id are one document, whose text is the least of them, a null text being the least. A row without id stays alone: its component is null and
    it is kept. Ids are whole numbers. An empty table gives no rows; other columns are not read.
    """  # noqa: E501
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = _of_one_text(rows, repeated_ids(rows, "id"))
    sketched = staged(rows.mapInArrow(_sketches(shingle), "id long, n long, d1 long, d2 long, bands array<long>"), "sketches")
    usable = sketched.where("n > 0 AND id IS NOT NULL")
    classes = staged(usable.groupBy("d1", "d2").agg(F.min("id").alias("node")), "classes")
    nodes = (
        usable.join(classes.withColumnRenamed("node", "id"), ["id", "d1", "d2"], "left_semi").groupBy("id").agg(
            F.max("n").alias("n"), F.flatten(F.collect_set("bands")).alias("bands")
        )
    )
    texts = rows.join(classes.select(F.col("node").alias("id")).distinct(), "id", "left_semi").dropDuplicates(["id"])
    found = staged(linked(nodes, texts, shingle, percent), "found")
    return _told(sketched, classes, found, id_col)


def repeated_ids(docs: DataFrame, id_col: str) -> DataFrame:
    """The ids, as the one column `again`, that stand more than once."""
    ids = docs.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("again"))
    return staged(ids.agg(F.count("*").alias("n")).where("n > 1").select("again"), "repeated-ids")


def _of_one_text(rows: DataFrame, again: DataFrame) -> DataFrame:
    """Rows of id and text, each with the least text of its id."""
    if again.isEmpty():
        return rows
    repeated = rows.join(again, F.col("id") == F.col("again"), "left_semi")
    least = repeated.groupBy(F.col("id").alias("same")).agg(F.min(F.struct("text"))["text"].alias("text"))
    least = repeated.select("id").join(least, F.col("id") == F.col("same")).select("id", "text")
    return rows.join(again, F.col("id") == F.col("again"), "left_anti").unionByName(staged(least, "repeated-texts"))


def _told(sketched: DataFrame, classes: DataFrame, found: DataFrame, id_col: str) -> DataFrame:
    component: Column = F.coalesce("component", "node", "id")
    return (
        sketched.drop("bands")
        .join(classes, ["d1", "d2"], "left")
        .join(found.select("node", "component"), "node", "left")
        .select(
            F.col("id").alias(id_col),
            F.col("n").alias("n_shingles"),
            F.when(F.col("id").isNotNull(), F.when(F.col("n") > 0, component).otherwise(F.col("id"))).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))
    )


def deduplicated(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with one document of each group of near copies, see `near_duplicates`; of those without id all.

    Of rows of one id the one with the least text stays, a null text being the least, and of equal texts any one of those whose other columns, written as
    JSON, come first.
    """  # noqa: E501
    (own,) = fresh(docs, "_kept")
    told = near_duplicates(docs, shingle, percent, id_col, text_col)
    kept = told.where(F.col("kept") & F.col(id_col).isNotNull()).select(F.col(id_col).alias(own)).distinct()
    named = docs.join(kept, docs[id_col] == kept[own], "left_semi")
    # ids alone are counted; texts move only where an id stands twice
    twice = repeated_ids(docs, id_col).withColumnRenamed("again", own)
    once = named.join(twice, named[id_col] == twice[own], "left_anti")
    repeated = named.join(twice, named[id_col] == twice[own], "left_semi")
    order = F.struct(F.col(text_col), F.to_json(F.struct(*[F.col(c) for c in docs.columns if c != text_col])))
    chosen = repeated.groupBy(F.col(id_col).alias(own)).agg(F.min_by(F.struct(*docs.columns), order).alias("row")).select("row.*")
    return once.unionByName(chosen).unionByName(docs.where(F.col(id_col).isNull()))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their component of near copies: 3-word shingles, a similarity of 0.85 or more."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), shingle=3, percent=85)
