"""The manifest against a plain build: proofs, tampering, lone leaves, nulls, repeated rows, clashing names."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from terrazzo.llm import manifest

CLASHING = ["id", "tree", "place", "leaf", "tampered", "path", "children", "digest", "height", "root", "_tie", "_at", "_n", "_part", "run"]


def sha(*texts: str) -> str:
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def field(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def folded_up(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The last node, and for each node what stands left and right of it and of those above it."""
    paths = [[] for _ in nodes]
    over = list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 8] for i in range(0, len(nodes), 8)]
        for i, at in enumerate(over):
            run = runs[at // 8]
            paths[i].append(("".join(run[: at % 8]), "".join(run[at % 8 + 1 :])))
            over[i] = at // 8
        nodes = [sha(*run) for run in runs]
    return nodes[0], paths


def expected(rows: list[tuple]) -> Counter:
    by_lang = defaultdict(list)
    for doc, source, lang, n, text in rows:
        before = "".join(map(field, (doc, source, lang, n)))
        lowered = None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        hit = doc is not None and zlib.crc32(str(doc).encode()) % 3 == 0
        leaf = sha(before, field(text))
        by_lang[lang].append((doc is not None, doc or 0, leaf, sha(before, field(lowered)) if hit else leaf))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: (sorted(by_lang[x]), *folded_up([r[2] for r in sorted(by_lang[x])])) for x in langs}
    root, tops = folded_up([trees[x][1] for x in langs])
    out = Counter()
    for x, top in zip(langs, tops, strict=True):
        leaves, subroot, paths = trees[x]
        for (named, doc, leaf, now), path in zip(leaves, paths, strict=True):
            for left, right in path + top:
                now = sha(left, now, right)
            proof = sha(*(left + right for left, right in path + top))
            out[(doc if named else None, leaf, subroot, root, proof, now, now == root)] += 1
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    out = [(i, rng.choice([None, "a", "bé"]), "en", rng.choice([None, 3]), rng.choice([None, "", "Words Of %d" % i, "Ärger É"])) for i in range(700)]
    out += [(1000 + i, "s", lang, 1, "Text") for i, lang in enumerate(["x", None, "", "é", "Z"] + ["l%d" % k for k in range(60)])]  # lone leaves
    out += [(2000 + i, "s", "eight", 1, "T" * i) for i in range(8)] + [(3000 + i, "s", "nine", 1, "T" * i) for i in range(9)]
    out += [(None, None, None, None, None), (None, "s", "en", 2, "No id"), (5, "s", "en", 2, "Other Text"), (4000, "s", "en", 2, "Long " * 100_000)]
    return out + [(6000, "s", "fr", 1, "Same")] * 100


@pytest.fixture(scope="module")
def docs(spark, rows):
    table = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    return table.withColumns({c: F.lit(c) for c in CLASHING})


def test_proofs(docs, rows):
    got = Counter(tuple(r) for r in manifest.verified(docs).collect())
    assert got == expected(rows)
    assert {r[6] for r in got} == {True, False}


@pytest.mark.parametrize("n", [0, 1, 2, 8, 9, 64, 65])
def test_small_tables(spark, docs, rows, n):
    one = [r for r in rows if r[2] == "en"][:n]
    table = spark.createDataFrame(one, docs.select("doc_id", "source", "lang", "n_chars", "text").schema)
    assert Counter(tuple(r) for r in manifest.verified(table).collect()) == (expected(one) if one else Counter())


def test_some_requests(docs, rows):
    """A few leaves are proven from the store alone."""
    of = manifest.manifest(docs)
    some = of.leaves.where("id IN (17, 1003, 2005, 3008, 6000)")
    got = manifest.proven(of, some).collect()
    assert len(got) == 4 + 100
    for r in got:
        now = r["leaf"]
        for left, right in reversed(r["path"]):
            now = sha(left, now, right)
        assert now == of.root


def test_store_is_addressed_by_content(docs):
    of = manifest.manifest(docs)
    records = of.store().collect()
    assert len({r["digest"] for r in records}) == len(records)
    assert all(r["digest"] == sha(*r["children"]) and 1 <= len(r["children"]) <= 8 for r in records)
    known = {r["digest"] for r in records}
    leaves = {r["leaf"] for r in of.leaves.select("leaf").collect()}
    assert of.root in known and all(c in known or c in leaves for r in records for c in r["children"])


def test_places_of_a_hot_group(spark):
    table = spark.range(5000).select((F.col("id") % 7 == 0).cast("int").alias("g"), F.lit(1).alias("x"), (F.col("id") % 10).alias("o"))
    got = manifest.placed(table, ["g"], ["o"], "hot").collect()
    for g in (0, 1):
        mine = sorted((r["place"], r["o"]) for r in got if r["g"] == g)
        assert [p for p, _ in mine] == list(range(len(mine))) and [o for _, o in mine] == sorted(o for _, o in mine)
