"""URL filter by a path-template tree, DataFrame operations only.

The paths of a host form a tree of segments. Variable segments become wildcards, branches whose labels do not differ
statistically become one, and a template is rejected when the smoothed share of blocked pages among its labelled ones is high.

Digits are generalised row by row before anything is shuffled, so that the tree is built from counted shapes and a host with a third of all
pages arrives as a few pre-aggregated rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrazzo.session import staged

#: The rules of the query: (verdict, host, path).
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

#: The tree of the query: down to the last segment, the significance test alone merges branches, and none without labels with labelled ones.
WHOLE = {"depth": None, "min_share": 0, "min_rows": 0, "apart": True}
#: levels of the tree in one plan
LEVELS = 4

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What follows the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://` or url."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; empty without `://` or url."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_columns(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits (host and path written together) and its verdict; null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == rule_host) | F.endswith(host, F.lit(f".{rule_host}"))) & F.startswith(path, F.lit(rule_path))
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def shape_of(path: Column) -> Column:
    """The path with every run of digits as `#`."""
    return F.regexp_replace(path, "[0-9]+", "#")


def template_tree(
    shapes: DataFrame, depth: int | None = 4, min_share: float = 0.02, min_rows: int = 20, z: float = 1.96, apart: bool = False
) -> DataFrame:
    """host, shape and `template` of each row of `shapes` (host, shape, pages, labelled, blocked; one row for each host and shape).

    Level by level, a segment below the same template so far stays a branch of its own only if it is a lasting part of the
    tree (at least `min_share` of the parent's pages and `min_rows` of them) and its blocked share
    differs from that of its siblings together by more than `z` standard errors. All others become `*`. With `apart` a branch
    without labels beside labelled ones stays as well, and below a parent without any label one that a labelled host has as a branch of its own: both are
    judged by the same template of other hosts.
    Segments below `depth` become one `**`; without a depth the tree goes on to the end of the longest path.
    """
    rows = shapes.withColumns({"_segments": F.split("shape", "/"), "template": F.lit("")})
    ended = []
    # one number
    levels = depth if depth is not None else rows.agg(F.max(F.size("_segments"))).first()[0] or 0
    for level in range(1, levels + 1):
        if level > 1 and level % LEVELS == 1:
            # only paths that go on are carried further
            rows = staged(rows.drop("_segment"), "levels")
            ended.append(rows.where(F.size("_segments") < level))
            rows = rows.where(F.size("_segments") >= level)
        # the first element of the split is what stands before the first slash
        rows = rows.withColumn("_segment", F.get("_segments", F.lit(level - 1)))
        branches = (
            rows.where(F.col("_segment").isNotNull())
            .groupBy("host", "template", "_segment")
            .agg(*(F.sum(c).alias(c) for c in ("pages", "labelled", "blocked")))
        )
        parent = Window.partitionBy("host", "template")
        branches = branches.withColumns({f"_all_{c}": F.sum(c).over(parent) for c in ("pages", "labelled", "blocked")})
        rest = F.col("_all_labelled") - F.col("labelled")
        pooled = (F.col("_all_blocked") + 1) / (F.col("_all_labelled") + 2)
        gap = F.abs(
            (F.col("blocked") + 1) / (F.col("labelled") + 2) - (F.col("_all_blocked") - F.col("blocked") + 1) / (rest + 2)
        )
        error = F.sqrt(pooled * (1 - pooled) * (1 / (F.col("labelled") + 2) + 1 / (rest + 2)))
        lasting = (F.col("pages") >= min_rows) & (F.col("pages") >= min_share * F.col("_all_pages"))
        alone = F.col("pages") == F.col("_all_pages")
        stays = alone | (lasting & (gap > z * error))
        if apart:
            stays = stays | ((F.col("labelled") == 0) & (F.col("_all_labelled") > 0))
        branches = branches.withColumn("_stays", stays)
        if apart:
            # a parent without any label keeps the branches that a labelled host has as its own
            seen = branches.where("_stays AND labelled > 0").select(F.col("template").alias("_t"), F.col("_segment").alias("_s")).distinct()
            same = (F.col("_all_labelled") == 0) & (F.col("template") == F.col("_t")) & (F.col("_segment") == F.col("_s"))
            branches = branches.join(seen, same, "left").withColumn("_stays", F.col("_stays") | F.col("_t").isNotNull())
        branches = branches.select(
            F.col("host").alias("_host"), F.col("template").alias("_template"), F.col("_segment").alias("_branch"), "_stays"
        )
        # one row for each branch; written, so that a level's plan does not hold those of the levels before it twice
        branches = staged(branches, "branches")
        rows = (
            rows.join(
                branches,
                (F.col("host") == F.col("_host")) & (F.col("template") == F.col("_template")) & (F.col("_segment") == F.col("_branch")),
                "left",
            )
            .withColumn(
                "template",
                F.when(F.col("_segment").isNull(), F.col("template")).otherwise(
                    F.concat("template", F.lit("/" if level > 1 else ""), F.when(F.col("_stays"), F.col("_segment")).otherwise("*"))
                ),
            )
            .drop("_host", "_template", "_branch", "_stays")
        )
    rows = rows.drop("_segment")
    for part in ended:
        rows = rows.unionByName(part)
    deeper = F.when(F.size("_segments") > levels, F.concat("template", F.lit("/**"))).otherwise(F.col("template"))
    return rows.withColumn("template", deeper).drop("_segments")


def template_verdicts(tree: DataFrame, weight: float = 4.0, threshold: float = 0.5) -> DataFrame:
    """host, shape, template and `blocked_share` and `verdict` of each row of the tree.

    The blocked share of a host's template is smoothed with `weight` pages of the share of the same template over all
    hosts, and that with `weight` pages of the share of everything, so a host without labels is judged by others' templates.
    """

    def share(blocked: Column, labelled: Column, prior: Column) -> Column:
        return (blocked + weight * prior) / (labelled + weight)

    labelled = tree.groupBy("host", "template").agg(F.sum("labelled").alias("_n"), F.sum("blocked").alias("_b"))
    across = labelled.groupBy("template").agg(F.sum("_n").alias("_tn"), F.sum("_b").alias("_tb"))
    # two numbers
    total = tree.agg(F.sum("labelled").alias("n"), F.sum("blocked").alias("b")).first()
    prior = F.lit(((total["b"] or 0) + 1) / ((total["n"] or 0) + 2))
    across = across.select("template", share(F.col("_tb"), F.col("_tn"), prior).alias("_prior"))
    judged = labelled.join(across, "template").select(
        "host", "template", share(F.col("_b"), F.col("_n"), F.col("_prior")).alias("blocked_share")
    )
    verdict = F.when(F.col("blocked_share") >= threshold, "block").otherwise("allow")
    return tree.select("host", "shape", "template").join(judged, ["host", "template"]).withColumn("verdict", verdict)


def filtered_urls(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url", **tree: float | None) -> DataFrame:
    """id, host, path, rule, verdict, template, blocked_share of every page.

    The verdict is that of the longest rule that fits; the pages a rule judges are the labelled ones from which templates
    are judged, and those decide where no rule fits. A null or malformed url has an empty host and path and is
    judged like any other; repeated rows are judged alike and count as often as they stand there. A section that no labelled host has, on a host without
    labels, has no evidence of its own: its verdict is that of all labelled pages together.
    """
    read = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    name, ruled = rule_columns(F.col("host"), F.col("path"), rules)
    read = read.withColumns({"rule": name, "_ruled": ruled, "shape": shape_of(F.col("path"))})
    shapes = read.groupBy("host", "shape").agg(
        F.count("*").alias("pages"),
        F.count("_ruled").alias("labelled"),
        F.count(F.when(F.col("_ruled") == "block", 1)).alias("blocked"),
    )
    verdicts = staged(template_verdicts(staged(template_tree(staged(shapes, "shapes"), **tree), "templates")), "verdicts")
    return read.join(verdicts, ["host", "shape"], "left").select(
        F.col("page_id").alias(id_col),
        "host",
        "path",
        "rule",
        F.coalesce("_ruled", "verdict").alias("verdict"),
        "template",
        "blocked_share",
    )


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's host, path, rule and verdict."""
    return filtered_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), RULES, **WHOLE)
