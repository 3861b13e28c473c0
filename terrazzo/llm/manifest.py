"""Merkle manifest of a dataset: a content-addressed store of digest and children, and proofs by descent from its root.

1. Every row is a leaf, the digest of its fields. Leaves of one language stand in the order of their ids; runs of `FAN` consecutive nodes become one
   node until one is left, the subroot. Subroots, ordered by language, become the root in the same way.
2. The store holds one record for each distinct inner node: its digest and its children.
3. Requests for leaves descend from the root, level by level. The digits of a leaf's rank in base `FAN` say which child to take; the children
   that are not taken are one segment of its path. Requests that agree in their first digits are one row of the frontier until they part, so the
   top of the tree is no hot key, and a level of the frontier has no more rows than the tree.
4. Reversed, the segments are the proof: the digest folded with them from the leaf up must be the root.

Ranks come from a sort by ranges, whatever the share of one language; no group is held by one task.
"""  # noqa: E501

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrazzo.session import staged

#: children of a node; the digits of a rank are those of its octal form
FAN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: where monotonically_increasing_id() keeps the number of the partition
PART_BITS = 33


def digest(*texts: Column) -> Column:
    """Lowercase hex sha256 of the UTF-8 bytes of `texts`, one after another."""
    return F.sha2(F.concat(*texts).cast("binary"), 256)


def told(value: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, `:` and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def placed(rows: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """`rows` with `place`: the position, from 0, among the rows of one group in the given order, nulls first; any order among equal rows.

    Ranges of all groups' rows are sorted each by itself; only one row for each group and range is counted together.
    """
    keys = [*group, *order, "_tie"]
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    dealt = staged(dealt.drop("_tie").withColumn("_at", F.monotonically_increasing_id()), name)
    dealt = dealt.withColumn("_part", F.shiftright("_at", PART_BITS))
    runs = dealt.groupBy(*group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy(*[F.col(g) for g in group] or [F.lit(0)]).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_start", F.col("_first") - F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    left, right = dealt.alias("l"), runs.alias("r")
    same = F.col("l._part") == F.col("r._part")
    for g in group:
        same = same & F.col(f"l.{g}").eqNullSafe(F.col(f"r.{g}"))
    return left.join(right, same).select(*(f"l.{c}" for c in rows.columns), (F.col("l._at") - F.col("r._start")).alias("place"))


def height(count: Column) -> Column:
    """Levels above `count` nodes: the octal digits of the last rank, none for a lone node."""
    return F.when(count > 1, F.length(F.conv((count - 1).cast("string"), 10, FAN))).otherwise(0)


@dataclass
class Tier:
    """The trees of one tier: subroots (tree, digest) and, for each level from 1, a table of tree, place, digest, children."""

    subroots: DataFrame
    levels: list[DataFrame]

    def records(self, level: int) -> DataFrame:
        """digest, children of the distinct nodes of a level: that part of the store."""
        return self.levels[level - 1].select("digest", "children").dropDuplicates(["digest"])


def grown(nodes: DataFrame, top: int, name: str) -> Tier:
    """The trees above `nodes` (tree, height, place, digest; places 0, 1, ... of each tree); `top` is their greatest height."""
    now, levels = nodes, []
    subroots = nodes.where("height = 0").select("tree", "digest")
    for level in range(1, top + 1):
        runs = now.where(F.col("height") >= level).groupBy("tree", "height", F.expr(f"place div {FAN}").alias("place"))
        # a run has FAN rows at most
        run = F.array_sort(F.collect_list(F.struct(F.col("place").alias("at"), "digest")))
        built = runs.agg(F.transform(run, lambda c: c["digest"]).alias("children"))
        now = staged(built.withColumn("digest", digest(F.array_join("children", ""))), f"{name}-{level}")
        levels.append(now)
        subroots = subroots.unionByName(now.where(F.col("height") == level).select("tree", "digest"))
    return Tier(subroots, levels)


@dataclass
class Manifest:
    """A dataset's leaves (id, tree, place, leaf, tampered), languages (lang, tree, height), two tiers of trees and their root."""

    leaves: DataFrame
    languages: DataFrame
    lower: Tier
    upper: Tier
    root: str | None

    def store(self) -> DataFrame:
        """tier, level, digest, children: every distinct inner node once."""
        parts = [
            tier.records(level).select(F.lit(name).alias("tier"), F.lit(level).alias("level"), "digest", "children")
            for name, tier in (("languages", self.upper), ("leaves", self.lower))
            for level in range(1, len(tier.levels) + 1)
        ]
        spark = self.leaves.sparkSession
        out = spark.createDataFrame([], "tier string, level int, digest string, children array<string>")
        for part in parts:
            out = out.unionByName(part)
        return out


def manifest(docs: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text") -> Manifest:
    """The manifest of all rows of `docs`. Leaves of one language ascend by id, nulls first; rows of one id by their digest."""
    before = F.concat(*(told(F.col(c)) for c in (id_col, "source", lang_col, "n_chars")))
    lowered = F.translate(F.col(text_col), string.ascii_uppercase, string.ascii_lowercase)
    hit = F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 0
    leaves = docs.select(
        F.col(id_col).alias("id"),
        F.col(lang_col).alias("lang"),
        digest(before, told(F.col(text_col))).alias("leaf"),
        F.when(hit, digest(before, told(lowered))).alias("tampered"),
    )
    leaves = placed(staged(leaves, "leaves"), ["lang"], ["id", "leaf"], "ordered")
    languages = placed(leaves.groupBy("lang").agg(F.count("*").alias("n")), [], ["lang"], "languages")
    languages = staged(languages.withColumnRenamed("place", "tree").withColumn("height", height(F.col("n"))), "trees")
    size = languages.agg(F.count("*").alias("n"), F.coalesce(F.max("height"), F.lit(0)).alias("top")).withColumn("over", height(F.col("n"))).first()
    own = languages.withColumnRenamed("lang", "_lang")
    leaves = leaves.join(own, F.col("lang").eqNullSafe(F.col("_lang"))).select("id", "tree", "height", "place", "leaf", "tampered")
    leaves = staged(leaves, "placed")
    lower = grown(leaves.select("tree", "height", "place", F.col("leaf").alias("digest")), size["top"], "runs")
    tops = lower.subroots.select(F.lit(0).alias("tree"), F.lit(size["over"]).alias("height"), F.col("tree").alias("place"), "digest")
    upper = grown(tops, size["over"], "languages")
    top = upper.subroots.first()
    return Manifest(leaves, languages, lower, upper, top["digest"] if top else None)


def segment(children: Column, digit: Column) -> Column:
    """The children that are not taken, left and right of the one that is."""
    left = F.array_join(F.slice(children, 1, digit), "")
    right = F.array_join(F.slice(children, digit + 2, F.lit(FAN)), "")
    return F.struct(left.alias("left"), right.alias("right"))


def _descended(frontier: DataFrame, records: DataFrame, asked: DataFrame) -> DataFrame:
    """One level down: tree, place, digest, path of those children of the frontier that lead to a request (`asked`: tree, place)."""
    opened = frontier.join(records, "digest").select("tree", "place", "path", "children", F.posexplode("children").alias("digit", "digest"))
    down = opened.select(
        "tree",
        (F.col("place") * FAN + F.col("digit")).alias("place"),
        "digest",
        F.concat("path", F.array(segment(F.col("children"), F.col("digit")))).alias("path"),
    )
    # a level is written before the next one is opened: it is small beside the leaves, and plans stay short
    return staged(down.join(asked, ["tree", "place"], "left_semi"), "frontier")


def _asked(requests: DataFrame, levels: int) -> list[DataFrame]:
    """tree, place of the nodes above `requests` (tree, height, place), from level 1 upwards; each level comes from the one below it."""
    out, now = [], requests.select("tree", "height", "place")
    for level in range(1, levels + 1):
        up = now.where(F.col("height") >= level).select("tree", "height", F.expr(f"place div {FAN}").alias("place")).distinct()
        now = staged(up, "asked")
        out.append(now)
    return out


def proven(of: Manifest, requests: DataFrame) -> DataFrame:
    """The rows of `requests` (some of the manifest's leaves) with subroot and path, the segments from the root down to the leaf."""
    spark = requests.sparkSession
    levels = len(of.lower.levels)
    trees = requests.select(F.lit(0).alias("tree"), F.lit(len(of.upper.levels)).alias("height"), F.col("tree").alias("place")).distinct()
    top = [trees, *_asked(trees, len(of.upper.levels))]
    path = "array<struct<left:string,right:string>>"
    frontier = spark.createDataFrame([(0, 0, of.root, [])] if of.root else [], f"tree long, place long, digest string, path {path}")
    for level in range(len(of.upper.levels), 0, -1):
        frontier = _descended(frontier, of.upper.records(level), top[level - 1])
    # every tree asked for, at its subroot
    own = of.languages.select("tree", "height")
    entering = frontier.select(F.col("place").alias("tree"), F.lit(0).cast("long").alias("place"), "digest", "path")
    entering = staged(entering.join(own, "tree").withColumn("subroot", F.col("digest")), "entering")
    below = entering.where(F.col("height") >= levels) if levels else entering.limit(0)
    asked = _asked(requests, levels)
    for level in range(levels, 1, -1):
        down = _descended(below.select("tree", "place", "digest", "path"), of.lower.records(level), asked[level - 2])
        below = down.unionByName(entering.where(F.col("height") == level - 1).select("tree", "place", "digest", "path"))
    last = [entering.where("height = 0").select("tree", "place", "path", F.lit(None).cast("array<string>").alias("children"))]
    if levels:
        last.append(below.join(of.lower.records(1), "digest").select("tree", "place", "path", "children"))
    runs = last[0]
    for more in last[1:]:
        runs = runs.unionByName(more)
    # the last digit is taken beside the request, so that a long path is carried once for each run
    runs = runs.select("tree", F.col("place").alias("run"), "path", "children")
    found = requests.withColumn("run", F.expr(f"place div {FAN}")).join(runs, ["tree", "run"])
    digit = F.expr(f"cast(place % {FAN} as int)")
    full = F.when(F.col("children").isNull(), F.col("path")).otherwise(F.concat("path", F.array(segment(F.col("children"), digit))))
    found = found.withColumn("path", full).drop("run", "children")
    return found.join(entering.select("tree", "subroot"), "tree")


def verified(docs: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """The id, leaf, subroot, root, proof_sha256, folded_root, verified of every row of `docs`.

    Every row is a request; rows whose id has a crc32 that 3 divides are folded with the leaf of their lower-cased text.
    A row without id is a leaf like others, the first of its language, and never tampered with; null fields have a form of their own. Equal rows
    are leaves of their own. An empty table gives no rows. Other columns than id, source, language, n_chars and text are not read.
    """  # noqa: E501
    of = manifest(docs, id_col, lang_col, text_col)
    up = F.reverse("path")
    proof = F.array_join(F.transform(up, lambda s: F.concat(s["left"], s["right"])), "")
    folded = F.aggregate(up, F.coalesce("tampered", "leaf"), lambda now, s: digest(s["left"], now, s["right"]))
    out = proven(of, of.leaves).select(
        F.col("id").alias(id_col),
        "leaf",
        "subroot",
        F.lit(of.root).alias("root"),
        F.sha2(proof.cast("binary"), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, proof and the root folded from it, a third of them tampered with."""
    return verified(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _told_sql(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR) END"


# crc32 is written out: each byte is one element, eight shifts follow it
OP11_SQL = f"""
WITH RECURSIVE rows AS (
  SELECT doc_id, lang, {" || ".join(_told_sql(c) for c in FIELDS[:-1])} AS before, {_told_sql("text")} AS body,
    {_told_sql(f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')")} AS low,
    list_concat([4294967295], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
      lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))) AS bits
  FROM documents
), hashed AS (
  SELECT doc_id, lang, sha256(before || body) AS leaf, sha256(before || low) AS tampered,
    xor(list_reduce(bits, lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295) % 3 = 0 AS hit
  FROM rows
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank, count(*) OVER (PARTITION BY lang) AS n FROM hashed
), lower AS (
  SELECT lang, 0 AS level, rank AS place, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT lang, level + 1, place // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY place)) FROM lower WHERE n > 1
  GROUP BY lang, level, place // 8, n
), subroots AS (
  SELECT lang, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS rank, count(*) OVER () AS n FROM lower WHERE n = 1
), upper AS (
  SELECT 0 AS level, rank AS place, n, digest FROM subroots
  UNION ALL
  SELECT level + 1, place // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY place)) FROM upper WHERE n > 1 GROUP BY level, place // 8, n
), runs AS (
  SELECT 0 AS tier, lang, level, place // 8 AS run, list(digest ORDER BY place) AS members FROM lower WHERE n > 1 GROUP BY lang, level, place // 8
  UNION ALL
  SELECT 1, NULL, level, place // 8, list(digest ORDER BY place) FROM upper WHERE n > 1 GROUP BY level, place // 8
), steps AS (
  SELECT l.lang, l.rank, r.tier, r.level, r.members, (l.rank >> (3 * r.level)) % 8 + 1 AS pick
  FROM leaves l JOIN runs r ON r.tier = 0 AND r.lang IS NOT DISTINCT FROM l.lang AND r.run = l.rank >> (3 * (r.level + 1))
  UNION ALL
  SELECT l.lang, l.rank, r.tier, r.level, r.members, (s.rank >> (3 * r.level)) % 8 + 1
  FROM leaves l JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang JOIN runs r ON r.tier = 1 AND r.run = s.rank >> (3 * (r.level + 1))
), paths AS (
  SELECT lang, rank, members, pick, row_number() OVER (PARTITION BY lang, rank ORDER BY tier, level) AS step FROM steps
), proofs AS (
  SELECT lang, rank, sha256(string_agg(array_to_string(list_concat(members[:pick - 1], members[pick + 1:]), ''), '' ORDER BY step)) AS proof_sha256
  FROM paths GROUP BY lang, rank
), folded AS (
  SELECT lang, rank, 0 AS step, CASE WHEN hit THEN tampered ELSE leaf END AS digest FROM leaves
  UNION ALL
  SELECT f.lang, f.rank, p.step, sha256(array_to_string(p.members[:p.pick - 1], '') || f.digest || array_to_string(p.members[p.pick + 1:], ''))
  FROM folded f JOIN paths p ON p.lang IS NOT DISTINCT FROM f.lang AND p.rank = f.rank AND p.step = f.step + 1
), ends AS (
  SELECT lang, rank, arg_max(digest, step) AS folded_root FROM folded GROUP BY lang, rank
), top AS (
  SELECT digest AS root FROM upper WHERE n = 1
)
SELECT l.doc_id, l.leaf, s.digest AS subroot, t.root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256, e.folded_root, e.folded_root = t.root AS verified
FROM leaves l
JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang
JOIN ends e ON e.lang IS NOT DISTINCT FROM l.lang AND e.rank = l.rank
LEFT JOIN proofs p ON p.lang IS NOT DISTINCT FROM l.lang AND p.rank = l.rank
CROSS JOIN top t
"""
