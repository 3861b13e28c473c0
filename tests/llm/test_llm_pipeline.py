"""The pipeline's stages against plain versions of their decisions."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from terrazzo.llm import langid
from terrazzo.session import staged
from tests.llm import brute


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    outs = []
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, sf_dir), "stage")
        outs.append([r.asDict() for r in docs.collect()])
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    languages, near, clean, mixed, tokens = outs
    assert {r["doc_id"] for r in languages} == {i for i, t in kept.items() if any(c.isalpha() for c in t)}
    told = brute.near_duplicates([(r["doc_id"], r["text"]) for r in languages], 5, 80)
    assert {r["doc_id"] for r in near} == {i for i, (_, c) in told.items() if i == c}
    held = {d for d, *_ in brute.contained([(r["doc_id"], r["text"]) for r in near], items)}
    assert {r["doc_id"] for r in clean} == {r["doc_id"] for r in near} - held and held
    sizes, words = Counter(), Counter()
    for r in clean:
        sizes[r["source"]] += len(brute.words(r["text"]))
    for r in mixed:
        words[r["source"]] += len(brute.words(r["text"]))
    for source, target in brute.targets(sizes).items():
        largest = max(len(brute.words(r["text"])) for r in clean if r["source"] == source)
        assert abs(words[source] - target) <= largest + 1
    assert max(Counter(r["doc_id"] for r in mixed).values()) <= 2
    assert sorted(r["doc_id"] for r in tokens) == sorted(r["doc_id"] for r in mixed)
    assert sum(r["n_tokens"] for r in tokens) == max(r["start"] + r["n_tokens"] for r in tokens)


def test_empty(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.collect() == []
    assert langid.accepted(spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)).collect() == []


@pytest.mark.parametrize("label", ["en", None])
def test_languages_without_a_choice(spark, sf_dir, label):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("lang", F.lit(label).cast("string"))
    text = F.when(F.col("doc_id") % 10 == 0, "12 34 ...").when(F.col("doc_id") % 10 != 1, F.col("text"))
    docs = docs.withColumn("text", text)
    kept = corpus_pipeline.language(spark, docs, sf_dir)
    assert kept.columns == docs.columns
    want = {r["doc_id"] for r in docs.collect() if r["text"] is not None and any(c.isalpha() for c in r["text"])}
    assert len(want) > 100 and {r["doc_id"] for r in kept.collect()} == want


def test_network_rejects(spark, sf_dir):
    """Unlearned languages and letter junk go and clean texts stay, with four learned languages as with two."""
    strange = [
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem.",
        "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler.",
        "Все люди рождаются свободными и равными в своем достоинстве и правах.",
        "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα.",
        "人人生而自由,在尊严和权利上一律平等。他们赋有理性和良心。",
    ]
    rng = random.Random(8)
    for letters in ("abcdefghijklmnopqrstuvwxyz", "bcdfghjklmnpqrstvwxz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "xqzjk"):
        strange += [" ".join("".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(60)) for _ in range(5)]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {x: [r["text"] for r in docs.where((F.col("lang") == x) & (F.length("text") > 200)).limit(8).collect()] for x in ("en", "fr")}
    both = [f"{a[:200]} {b[:200]}" for a, b in zip(texts["en"], texts["fr"], strict=True)]
    planted = [(10**9 + i, t) for i, t in enumerate(strange)] + [(2 * 10**9 + i, t) for i, t in enumerate(both)]
    planted = spark.createDataFrame(planted, "doc_id long, text string")
    for names in (["en", "fr", "de", "es"], ["en", "fr"]):
        clean = docs.where(F.col("lang").isin(names))
        kept = corpus_pipeline.language(spark, clean.unionByName(planted, allowMissingColumns=True), sf_dir)
        kept = {r["doc_id"] for r in kept.select("doc_id").collect()}
        assert not kept & {10**9 + i for i in range(len(strange))}
        assert kept >= {2 * 10**9 + i for i in range(len(both))}
        assert kept >= {r["doc_id"] for r in clean.select("doc_id").collect()}


def test_bars():
    net, texts = langid.Network(["a", "b"], *[None] * 5), [b"x"] * 600
    best = np.repeat([0, 1], 300)
    shares = np.concatenate([np.linspace(0.2, 1, 300), np.full(300, 0.9)])
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(langid, "placed", lambda *_: (best, shares))
        least = langid.bars(net, texts, 0.01)
        assert (shares[:300] < least[0]).sum() == 2 and least[1] == 0.5
        best, shares = best[:3], np.array([0.3, 0.9, 0.8])
        assert langid.bars(net, texts[:3], 0.01).tolist() == [0.3, 0.3]
        best, shares = best[:0], shares[:0]
        assert langid.bars(net, [], 0.01).tolist() == [0.5, 0.5]


def test_bars_of_all_held_out_documents(spark, sf_dir):
    """Every held-out labelled document counts for the bars, not a sample of them: as the plain rule says of all texts, in any number of partitions."""
    docs = spark.read.parquet(sf_dir.replace("sf0.001", "sf0.01") + "/documents.parquet").where(langid.judged(F.col("text")).isNotNull())
    learn, held = docs.where(~langid.held_out(F.col("doc_id"))), docs.where(langid.held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    # the sample leaves most of them out
    texts, labels = langid.training_rows(learn, "doc_id", "text", "lang", 20, 256)
    net = langid.train(texts, labels, epochs=2, none=langid.disguised(texts))
    every = [r["text"].encode() for r in held.select("text").collect()]
    for lost in (0.01, 0.2, 1e-6):
        want = langid.bars(net, every, lost)
        for parts in (1, 5):
            assert np.allclose(langid.all_bars(net, held.repartition(parts), "text", lost), want, rtol=0, atol=1e-6)
    assert langid.all_bars(net, held.limit(0), "text", 0.01).tolist() == [0.5] * len(net.names)


def test_a_rare_low_share_counts_for_the_bar(spark):
    """Of one language's 4,000 held-out documents 2 % read badly; the bar lies below them, wherever a sample of 400 would have put it."""
    net = langid.Network(["a", "b"], *[None] * 5)
    shares = np.concatenate([np.linspace(0.1, 0.3, 80), np.full(3920, 0.9)])
    table = spark.createDataFrame([(f"{i}",) for i in range(4000)], "text string").repartition(7)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(langid, "_placed", lambda _: lambda parts: (_row_shares(part, shares) for part in parts))
        least = langid.all_bars(net, table, "text", 0.01)
    assert (shares < least[0]).sum() == 39 and least[1] == least[0]


def _row_shares(part, shares):
    import pyarrow as pa

    at = [int(x) for x in part.column(0).to_pylist()]
    return pa.RecordBatch.from_arrays([pa.array([0] * len(at), pa.int32()), pa.array(shares[at])], ["best", "share"])
