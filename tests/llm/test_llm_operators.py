"""The operators against brute force: nulls, empty and long texts, ties, repeated rows, empty tables, clashing column names."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from terrazzo.llm import chat, decontam, grammar, langid, mixing, neardup, sharding, substrings, suffixes, topk, urls
from tests.llm import brute

CLASHING = ["id", "k", "h", "n", "row", "rows", "size", "node", "component", "anchor", "digest", "item", "hits", "shard", "slot", "words", "label"]
CLASHING += [f"_{c}" for c in ("id", "times", "again", "taken", "size", "judged", "kept", "source", "row", "n", "node")]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 6))) for _ in range(400)]

    def text(n):
        return " ".join(rng.choices(vocabulary, k=n))

    out = [(None, "no id at all"), (1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "one two"), (7, "...!")]
    base = text(150)
    out += [(20 + i, base) for i in range(30)]  # copies
    for i in range(40):  # near copies
        w = base.split()
        for _ in range(rng.randint(1, 12)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        out.append((100 + i, " ".join(w)))
    passage = text(90)
    out += [(200 + i, f"{text(rng.randint(1, 60))} {passage}\n{text(rng.randint(1, 60))}") for i in range(15)]
    out += [(300 + i, text(rng.randint(1, 300))) for i in range(60)]
    out += [(400, text(30_000)), (401, "x" * 5000), (402, "Ärger über Öl " * 60), (300, out[-60][1])]  # the last is a repeated row
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    df = df.withColumns({"lang": F.lit("en"), "source": F.when(F.col("doc_id") % 7 != 0, F.concat(F.lit("s"), F.col("doc_id") % 7))})
    return df.withColumns({c: F.lit(c) for c in CLASHING})


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def test_mixing_meets_targets(docs, empty, rows):
    parts = mixing.mixture(docs, block=16)
    got = mixing.taken(*parts).collect()
    assert len(got) == len(rows)
    sizes, want = Counter(), {}
    for r in got:
        sizes[r["source"]] += r["size"]
    want = brute.targets(sizes)
    for source, target in want.items():
        mine = [r for r in got if r["source"] == source]
        assert all(r["source_size"] == sizes[source] and abs(r["target"] - target) < 1e-6 * max(1, target) for r in mine)
        assert abs(sum(r["taken"] for r in mine) - target) < 1
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    assert {(r["id"], r["size"]) for r in got} == {(i, len(brute.words(t))) for i, t in rows}
    again = mixing.taken(*mixing.mixture(docs, block=16)).collect()
    assert Counter((r["id"], r["taken"]) for r in got) == Counter((r["id"], r["taken"]) for r in again)
    assert mixing.taken(*mixing.mixture(empty)).collect() == []


def test_mixing_schedule(spark, docs):
    sizes, sources, pieces = mixing.mixture(docs, block=16)
    need = {r["src"]: r["need"] for r in sources.collect()}
    slots = mixing.schedule(sources.select("src", "need")).collect()
    ranks = {s: sorted(r["rank"] for r in slots if r["src"] == s) for s in need}
    assert ranks == {s: list(range(n)) for s, n in need.items()}
    placed = sorted((r["slot"], r["src"]) for r in slots if r["slot"] is not None)
    # low discrepancy: after any number of slots each source has about its share
    total, seen = sum(need.values()), Counter()
    for slot, src in placed:
        seen[src] += 1
        assert abs(seen[src] - (slot + 1) * need[src] / total) < 4
    assert all(r["words"] > 0 for r in pieces.collect())


def test_mixed_documents(docs, empty):
    out = mixing.mixed(docs.where("doc_id IS NOT NULL"))
    assert out.columns == docs.columns
    times = Counter(r["doc_id"] for r in out.collect())
    assert max(v for k, v in times.items() if k != 300) <= 2 and times[2] == 1
    assert mixing.mixed(empty).count() == 0


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates(docs, rows, size, percent):
    want = brute.near_duplicates(rows, size, percent)
    got = neardup.near_duplicates(docs, size, percent).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
            assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_blocks_find_links_that_stars_miss():
    # 1 and 2 are linked, but neither is linked with the centre 0
    base = np.arange(100, dtype=np.uint64)
    sets = [base, np.append(base[:88], np.arange(200, 212, dtype=np.uint64)), np.append(base[:88], np.arange(200, 213, dtype=np.uint64))]
    left, right = neardup.block_links(sets, np.array([0, 1, 2]), 85)
    assert list(zip(left, right, strict=True)) == [(1, 2)]
    # members of one component are not compared
    assert len(neardup.block_links(sets, np.array([0, 1, 1]), 85)[0]) == 0


def test_deduplicated(docs, empty, rows):
    out = neardup.deduplicated(docs)
    assert out.columns == docs.columns
    want = {i for i, (_, c) in brute.near_duplicates(rows, 5, 80).items() if i == c}
    got = [r["doc_id"] for r in out.select("doc_id").collect()]
    assert Counter(got) == Counter(want | {None})
    assert neardup.near_duplicates(empty).collect() == []


def test_contained_items(spark, docs, empty, rows):
    long = next(t for i, t in rows if i == 400).split()
    items = [(1, " ".join(long[1000:1040])), (2, " ".join(long[50:60] + ["changed"] + long[61:100])), (3, "ONE"), (4, None), (5, ""), (6, "not to be found here at all"),
             (None, " ".join(long[7:20])), (8, " ".join(long[1000:1040]))]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit(1) for c in ("id", "h", "n")})
    got = decontam.contained_items(docs, bench).collect()
    assert {tuple(r) for r in got} == brute.contained(rows, items) and len(got) == len({tuple(r) for r in got})
    assert decontam.contained_items(empty, bench).collect() == []
    assert decontam.contained_items(docs, bench.limit(0)).collect() == []
    left = decontam.decontaminated(docs, bench)
    held = {d for d, *_ in brute.contained(rows, items)}
    assert Counter(r["doc_id"] for r in left.collect()) == Counter(i for i, _ in rows if i not in held)


def test_language(spark, sf_dir, docs, empty):
    table = spark.read.parquet(sf_dir.replace("sf0.001", "sf0.01") + "/documents.parquet")
    told = langid.identified(table).join(table.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in told if r["held_out"]]
    assert len(held) > 100 and np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.96
    assert all(0 <= r["score"] <= 1 for r in told)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in told)
    mixed = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "a").when(F.col("doc_id") % 3 == 0, "b"))
    got = {r["doc_id"]: r for r in langid.identified(mixed).collect()}
    assert {i for i, r in got.items() if r["lang_pred"] == "und"} == {1, 2, 3, 7}
    assert {r["lang_pred"] for r in got.values()} <= {"a", "b", "und"}
    kept = langid.accepted(mixed)
    assert kept.columns == mixed.columns and {1, 2, 3, 7}.isdisjoint(r["doc_id"] for r in kept.collect())
    assert langid.identified(empty).collect() == []
    none = langid.identified(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in none} == {"und"}


def test_tokens(spark, docs, empty, rows, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    odd = ["J\u030c <|ENDOFTEXT|> <|endoftext|>x \u0130I\u0307", "it's IT'S don't.. a.,b... É.É,  x\x1cy\x85z 1234.5", "naïve!!! a|b x<|endoftext|>. y'> é."]
    more = docs.unionByName(spark.createDataFrame([(500 + i, t) for i, t in enumerate(odd)], "doc_id long, text string"), allowMissingColumns=True)
    all_rows = rows + [(500 + i, t) for i, t in enumerate(odd)]
    want = {i: [*plain.encode(t or "", add_special_tokens=False).ids, 1] for i, t in all_rows}
    got = grammar.tokens_of(more).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == sorted((i for i, _ in all_rows), key=lambda i: (i is not None, i))
    at = 0
    for r in got:
        ids = want[r["doc_id"]]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    to = str(tmp_path / "tokens")
    grammar.write_tokens(more, to, path)
    shard = spark.read.parquet(to).orderBy("part", "shard").first().asDict()
    whole = [x for r in got for x in want[r["doc_id"]]]
    for a, b in ((0, 3), (100, 900), (0, sum(shard["counts"]))):
        assert grammar.slice_of(shard, a, b).tolist() == whole[a:b]
    assert grammar.tokens_of(empty).collect() == []


def test_grammar_rules():
    rng = np.random.default_rng(0)
    for ids in (np.zeros(1001, np.uint32), rng.integers(0, 3, 5000).astype(np.uint32), np.tile(np.arange(7, dtype=np.uint32), 500), np.zeros(1, np.uint32)):
        for base in (10, (1 << 16) - 1, 70_000):
            rules, symbols = grammar.repaired(ids, base)
            assert grammar.expanded(symbols, rules, base).tolist() == ids.tolist()
            assert all(a < base + i and b < base + i for i, (a, b) in enumerate(rules.tolist()))


def test_repeated_substrings(docs, empty, rows, monkeypatch):
    want = {i: r for (i, _), r in zip(rows, brute.without_repeats([t for _, t in rows], 60), strict=True)}
    for large in (substrings.LARGE, 300):  # the second spreads anchors over shards and merges them
        monkeypatch.setattr(substrings, "LARGE", large)
        got = substrings.without_repeats(docs, 60).collect()
        assert len(got) == len(rows)
        assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} == want
    assert substrings.without_repeats(empty).collect() == []


def test_suffix_arrays():
    rng = random.Random(3)
    for length in (9, 20):
        for _ in range(40):
            letters = rng.choice([b"ab", b"abcdef", bytes([0, 1, 255])])
            base = bytes(rng.choices(letters, k=200))
            texts = [base[(a := rng.randint(0, 150)) : a + rng.randint(0, 90)] for _ in range(rng.randint(1, 6))]
            if not any(texts):
                continue
            data = np.frombuffer(b"".join(texts), np.uint8)
            sizes = np.array([len(t) for t in texts])
            room = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(data))
            order = suffixes.suffix_array(suffixes.packed(data), room)
            tails = [bytes(data[i : i + room[i]]) for i in order]
            assert tails == sorted(tails) and sorted(order.tolist()) == list(range(len(data)))
            seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
            want = [len(t) - i >= length and seen[t[i : i + length]] > 1 for t in texts for i in range(len(t))]
            assert suffixes.repeated_starts(texts, length).tolist() == want
    keys, runs = np.array([5, 5, 7, 9, 9, 3, 7]), np.array([0, 0, 0, 1, 1, 1, 2])
    assert suffixes.in_other_runs(keys, runs).tolist() == [False, False, True, False, False, False, True]


def test_top_k(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(0, 0.2, (180, 12)))]
    vectors += [(1000 + i, vectors[10][1]) for i in range(25)]  # one common vector, ties
    odd = [(None, vectors[0][1]), (2000, None), (2050, [float("nan")] * 12), (2100, [None] * 12), (2150, [float("inf")] + [0.0] * 11), (0, vectors[0][1])]
    table = spark.createDataFrame(vectors + odd, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("id", "v", "number", "query")})
    whole = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in vectors]
    got = topk.nearest(table, every=10).collect()
    assert {tuple(r) for r in got} == brute.top(whole, 5, 10) and len(got) == len({tuple(r) for r in got})
    few = topk.nearest(table.where("vec_id < 4"), every=2)
    assert {tuple(r) for r in few.collect()} == brute.top(whole[:4], 5, 2)
    assert topk.nearest(table.limit(0)).collect() == []


def test_exact_scores():
    big = np.array([[1 << 30, 3]], np.int64)
    assert topk.scores(big, big).tolist() == [[(1 << 60) + 9]]
    with pytest.raises(OverflowError):
        topk.scores(np.array([[1 << 31] * 4]), np.array([[1 << 31] * 4]))


def test_topk_large_components_and_lengths(spark):
    rng = random.Random(11)
    vectors = [[rng.choice([-1, 1]) * rng.choice([0.25, 3.5, 1e4, 4e5]) for _ in range(n)] for n in (4, 4, 4, 6, 2, 4, 0, 4, 6, 3)]
    rows = list(enumerate(vectors)) + [(50, [1e8, -1e8, 0.5, 1.0]), (100, vectors[3]), (51, None), (52, [float("inf")] * 4)]
    whole = {i: [math.floor(256 * x) for x in v] for i, v in rows if i < 51 or i == 100}
    want = []
    for q in (0, 50, 100):
        found = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)[:5]
        want += [(q, rank, i, -score) for rank, (score, i) in enumerate(found, 1)]
    got = topk.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert sorted(map(tuple, got.collect())) == want
    empties = spark.createDataFrame([(0, []), (1, [])], "vec_id long, embedding array<float>")
    assert list(map(tuple, topk.nearest(empties).collect())) == [(0, 1, 1, 0)]



def test_ring(docs, empty, rows):
    got = sharding.ring_sharded(docs.select("doc_id", "text"), grown=True).collect()
    counts = Counter(r["shard"] for r in got)
    assert len(got) == len(rows) and max(counts.values()) - min(counts.values()) <= 1 and len(counts) == 8
    for s, n in counts.items():
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(n))
    # copies stand side by side on the ring: they leave a shard only where it is full
    roomy = sharding.ring_sharded(docs.select("doc_id", "text"), slack=3.0).collect()
    assert len({r["shard"] for r in roomy if r["doc_id"] in range(20, 50)}) == 1
    loose = sharding.ring_sharded(docs.select("doc_id", "text"), slack=0.5, grown=True).collect()
    assert max(Counter(r["shard"] for r in loose).values()) <= -(-1.5 * len(rows) // 8)
    moved = [r for r in loose if r["shard"] != r["grown_shard"]]
    assert len(moved) < len(rows) / 2
    assert sharding.ring_sharded(empty.select("doc_id", "text")).collect() == []


def test_stretches_hold_every_row():
    rng = random.Random(2)
    for _ in range(50):
        counts = {rng.randrange(sharding.CELLS): rng.randint(1, 1000) for _ in range(rng.randint(1, 50))}
        plan = sharding.stretches(counts, 8, 16, rng.choice([0.0, 0.25]))
        assert [p[0] for p in plan] == [sum(p[1] for p in plan[:i]) for i in range(len(plan))]
        assert sum(p[1] for p in plan) == sum(counts.values())


def test_urls(spark, sf_dir):
    rng = random.Random(4)
    hosts = ["a.example.com", "WWW.example.com", "b.net", "www.x.org", "net", "notnet", "example.com:80", "y.org"]
    urls_ = [None, "", "no scheme", "http://", "http://h", "https://b.net/es/1?x#y", "ftp://b.net?/es/", "a://b://c/d", "http://net/fr/2#z", "http://É.net/es/1\n2"]
    urls_ += [f"http://{rng.choice(hosts)}/{rng.choice(['en', 'es', 'fr', 'de'])}/{rng.choice(['', 'x/'])}{rng.randrange(900)}{rng.choice(['', '?q', '/a/b/c'])}" for _ in range(900)]
    table = spark.createDataFrame(list(enumerate(urls_)) + [(5, urls_[5]), (None, urls_[7])], "page_id long, url string")
    table = table.withColumns({c: F.lit(c) for c in ("host", "path", "rule", "template", "shape")})
    got = urls.filtered_urls(table, urls.RULES).collect()
    assert len(got) == len(urls_) + 2
    shapes, expect = Counter(), {}
    everything = list(enumerate(urls_)) + [(5, urls_[5]), (None, urls_[7])]
    import re

    for _, u in everything:
        host, path = brute.url_parts(u)
        name, verdict = brute.rule_for(host, path, urls.RULES)
        expect[u] = (host, path, name, verdict)
        key = host, re.sub("[0-9]+", "#", path)
        old = shapes.get(key, (0, 0, 0))
        shapes[key] = (old[0] + 1, old[1] + (name is not None), old[2] + (verdict == "block"))
    tree = brute.templates(shapes)
    sums = Counter(), Counter(), Counter(), Counter()
    for (host, shape), (_, labelled, blocked) in shapes.items():
        t = tree[host, shape]
        sums[0][host, t] += labelled
        sums[1][host, t] += blocked
        sums[2][t] += labelled
        sums[3][t] += blocked
    prior = (sum(sums[3].values()) + 1) / (sum(sums[2].values()) + 2)
    by_id = {i: u for i, u in everything}
    for r in got:
        host, path, name, verdict = expect[by_id[r["page_id"]]]
        t = tree[host, re.sub("[0-9]+", "#", path)]
        across = (sums[3][t] + 4 * prior) / (sums[2][t] + 4)
        share = (sums[1][host, t] + 4 * across) / (sums[0][host, t] + 4)
        assert (r["host"], r["path"], r["rule"], r["template"]) == (host, path, name, t)
        assert abs(r["blocked_share"] - share) < 1e-9
        assert r["verdict"] == (verdict or ("block" if share >= 0.5 else "allow"))
    assert urls.filtered_urls(table.limit(0), urls.RULES).collect() == []


@pytest.mark.parametrize("times", [1, 10])
def test_urls_small_branches(spark, tmp_path, times):
    """Small branches without labels do not take the verdict of labelled ones, whatever the size of the table."""
    paths = [("big.net", "es", 30), ("tiny.net", "es", 3), ("tiny.net", "de", 2), ("x.com", "de", 5)]
    paths += [(host, f"sec{c}", n) for c in "abcdefghijklmnopqrstuvwxyz" for host, n in (("big.net", 70), ("x.com", 3))]
    rows = [f"http://{host}/{name}/{i}" for host, name, n in paths for i in range(n * times)]
    spark.createDataFrame(list(enumerate(rows)), "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    got = urls.op10_url_filters(spark, str(tmp_path)).select("host", "path", "verdict").collect()
    assert len(got) == len(rows)
    assert all(r["verdict"] == ("block" if r["path"].startswith("/es/") else "allow") for r in got)


def test_urls_hosts_without_labels(spark):
    """A host without labels is judged section by section as the labelled hosts' sections are; what none of them has, by all labelled pages."""
    rules = [("block", "a.net", "/es/"), ("allow", "a.net", "/de/"), ("block", "c.net", "/es/"), ("allow", "c.net", "/de/"), ("allow", "c.net", "/it/")]
    sections = [("a.net", "es", 60), ("a.net", "de", 40), ("c.net", "es", 50), ("c.net", "de", 30), ("c.net", "it", 10)]
    sections += [("b.org", name, n) for name, n in (("es", 9), ("de", 9), ("it", 3), ("zz", 5))] + [("only.org", "de", 4), ("new.org", "zz", 4)]
    rows = [f"http://{host}/{name}/{i}" for host, name, n in sections for i in range(n)]
    table = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    got = urls.filtered_urls(table, rules, **urls.WHOLE).collect()
    verdicts = {(r["host"], r["path"].split("/")[1]): r["verdict"] for r in got}
    assert len(got) == len(rows) and len(verdicts) == len(sections)
    assert {v for (h, s), v in verdicts.items() if s == "es"} == {"block"}
    assert {v for (h, s), v in verdicts.items() if s in ("de", "it")} == {"allow"}
    # more labelled pages are blocked than allowed
    assert verdicts["b.org", "zz"] == verdicts["new.org", "zz"] == "block"


def test_shared_ids(spark):
    rows = [(1, "b c d e f g", "x"), (1, "a b c d e f", "y"), (1, "a b c d e f", "x"), (2, None, "x"), (2, "z z", "x"), (3, "q", None), (None, "q", "x"), (None, "q", "x")]
    table = spark.createDataFrame(rows, "doc_id long, text string, _kept string").repartition(3)
    for _ in range(2):
        got = sorted(map(tuple, neardup.deduplicated(table).collect()), key=repr)
        assert [r for r in got if r[0] in (1, 2)] == [(1, "a b c d e f", "x"), (2, None, "x")] and len(got) == 5


def test_shared_ids_are_compared_by_their_least_text(spark):
    low, high = "a b c d e f g", "p q r s t u v"
    rows = [(5, high), (5, low), (5, low), (6, high), (7, low), (8, None), (8, low), (None, low)]
    for order in (rows, rows[::-1]):
        told = neardup.near_duplicates(spark.createDataFrame(order, "doc_id long, text string").repartition(3))
        got = Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in told.collect())
        assert got == Counter([(5, 3, 5, True)] * 3 + [(6, 3, 6, True), (7, 3, 5, False), (8, 0, 8, True), (8, 0, 8, True), (None, 3, None, True)])


def test_urls_deep_paths(spark):
    """Paths that differ only from a deep segment on have templates and verdicts of their own."""
    top = "/" + "/".join("abcdefghijk")
    rules = [("block", "h.org", f"{top}/bad/"), ("allow", "h.org", f"{top}/good/")]
    hosts = [("h.org", "bad", 40), ("h.org", "good", 40), ("k.org", "bad", 2), ("l.org", "good", 2)]
    rows = [f"http://{host}{top}/{name}/{i}" for host, name, n in hosts for i in range(n)] + ["http://s.org/short/1", None]
    table = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    got = urls.filtered_urls(table, rules, **urls.WHOLE).collect()
    assert sorted(r["page_id"] for r in got) == list(range(len(rows)))
    deep = [r for r in got if r["path"].startswith(top)]
    assert len(deep) == 84 and all(r["verdict"] == ("block" if "/bad/" in r["path"] else "allow") for r in deep)
    assert {r["template"] for r in deep if r["host"] in ("k.org", "l.org")} == {f"{top}/bad/#", f"{top}/good/#"}
    assert urls.filtered_urls(table.limit(0), rules, **urls.WHOLE).collect() == []


def test_chat(spark):
    rng = random.Random(6)
    bits = ["<|im_end|>\n", "<|im_sep|>", "<|", "\\", "<\\|", "\n", "x", "é𝄞", "<", "|", "", "<\\~"]
    rows = [(rng.choice([1, 2, 3, None]), rng.choice([None, *range(700)]), rng.choice(["user", "assistant", "system", None, "a\nb<\\~\\"]),
             rng.choice([None, "".join(rng.choices(bits, k=5))])) for _ in range(400)]
    rows += [(9, 0, "user", "only"), (9, 0, "user", "only"), (10, 1, "assistant", "long " * 50_000)]
    # without numbers, all of one number, and equal rows
    rows += [(11, rng.choice([None, 5]), rng.choice(["user", "assistant"]), f"{rng.random()}") for _ in range(1500)] + [(11, 5, "user", "same")] * 700
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    table = table.withColumns({c: F.lit(1) for c in ("conv", "part", "piece", "tie", "turns", "loss", "formatted")})
    parts = chat.formatted_chat(table)
    held = [r["formatted"].count(chat.START) + r["formatted"].count(chat.SEP) for r in parts.collect()]
    assert max(held) <= chat.PART and len(held) > 9 + 2200 // chat.PART
    got = {r["conv_id"]: r for r in chat.chat_digest(parts).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv, r in got.items():
        turns = sorted(((t is not None, t or 0, ro or "", tx or "") for c, t, ro, tx in rows if c == conv))
        whole = "".join(f"{ro}\n{tx}\n" for _, _, ro, tx in turns)
        loss = "".join(tx for _, _, ro, tx in turns if ro == "assistant")
        assert r["n_turns"] == len(turns) and r["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.chat_digest(chat.formatted_chat(table.limit(0))).collect() == []
    merged = chat.formatted_chat(spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")], table.select("conv_id", "turn", "role", "text").schema))
    assert merged.first()["formatted"] == "<|im_start|>user\na<|im_sep|>b<|im_end|>\n<|im_start|>assistant\nc<|im_end|>\n"
