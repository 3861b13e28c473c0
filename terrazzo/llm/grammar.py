"""Token ids in grammar-compressed files.

Documents are sorted by id, encoded, and packed into shards of about `SHARD` ids. In a shard, frequent pairs of neighbouring ids
are replaced by new symbols (Re-Pair) round after round: a round counts all pairs, takes the commonest ones that cannot overlap each other, and
replaces every occurrence. A file row is one shard:

    part, shard       place in the order of the file
    ids, counts       the documents and how many ids each has
    base              the least symbol that is a rule
    width             bytes of a symbol in `rules` and `symbols` (2 or 4, little-endian)
    rules             rule i is symbol base + i: its left and right symbol, both less than it
    lengths           how many ids each rule expands to (4 bytes each)
    symbols           the shard's sequence

The expansion lengths tell where in the sequence an id stands without expanding what is before it.
"""  # noqa: E501

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrazzo.llm.wordhash import batches, utf8
from terrazzo.session import staging_path

SHARD = 1 << 20
#: a pair is frequent if it makes up one in so many ids, and stands there so often at least
SHARE, LEAST = 4096, 16
#: the rounds end when one shortens the sequence by less than this share
GAIN = 0.02
END = 1
CACHE = 1_000_000

SHARDS = "part long, shard long, ids array<long>, counts array<long>, base int, width int, rules binary, lengths binary, symbols binary"


class Words(dict):
    """Ids (little-endian, 4 bytes each) of every run of bytes without white space, as the tokenizer gives them.

    The tokenizer drops white space and never joins what it parts, so a text's ids are those of its runs one after
    another, and most runs come again and again. At most `CACHE` runs are held, and those of the texts at hand.
    """

    def __init__(self, path: str):
        super().__init__()
        # tasks run side by side already
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True

    def __missing__(self, run: bytes) -> bytes:
        stem = _stem(run)
        if stem != run:
            # put together for each batch of texts: words with marks would fill the memory
            return self[stem] + self[run[len(stem) :]]
        ids = np.array(self.tokenizer.encode(run.decode(), add_special_tokens=False).ids, "<u4").tobytes()
        if len(run) <= 64:
            self[run] = ids
        return ids

    def learn(self, runs: set[bytes]) -> None:
        """Encodes the runs of letters that are new, many at a time: each ends with the one token that ends a word."""
        if len(self) > CACHE:
            self.clear()
        # a difference with the keys of a dict subclass would walk over all that are held
        stems = {_stem(run) for run in runs if run not in self}
        new = [run for run in stems if run not in self and len(run) <= 64 and run.decode().isalpha()]
        for at in range(0, len(new), 4096):
            part = new[at : at + 4096]
            lines = [b" ".join(part[i : i + 512]).decode() for i in range(0, len(part), 512)]
            got = self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)
            ids = np.array([i for line in got for i in line.ids], "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(part):
                data, stops = ids.tobytes(), (stops * 4).tolist()
                self.update(zip(part, map(data.__getitem__, map(slice, [0, *stops[:-1]], stops)), strict=True))

    def texts(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text."""
        # lower case is the tokenizer's own; where marks compose with letters, or special tokens may stand, it is left to do it
        lowered = [t if b"\xcc" in t or b"\xcd" in t or b"<|" in t else t.lower() for t in texts]
        parted = pc.ascii_split_whitespace(pa.array(lowered, pa.large_binary()).cast(pa.large_string()))
        runs = parted.flatten().dictionary_encode()
        # only the distinct runs of these texts are looked up; white space at an end leaves an empty one
        distinct = runs.dictionary.cast(pa.large_binary()).to_pylist()
        self.learn(set(distinct) - {b""})
        found = [self[run] if run else b"" for run in distinct]
        ids = np.frombuffer(b"".join(found), "<u4")
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        which = runs.indices.to_numpy()
        count = sizes[which]
        ends = np.cumsum(count)
        # an id's place among the distinct runs' ids: where its run begins there, and how far in it stands
        place = np.repeat((np.cumsum(sizes) - sizes)[which] - (ends - count), count) + np.arange(count.sum())
        out = ids[place]
        cuts = np.concatenate(([0], ends))[parted.offsets.to_numpy() - parted.offsets[0].as_py()].tolist()
        return [out[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:], strict=True)]


MARKS = b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~"


def _stem(run: bytes) -> bytes:
    """What is before the marks a run ends with, if that ends with a letter: the tokenizer parts letters from marks."""
    if run[-1] not in MARKS:
        return run
    stem = run.rstrip(MARKS)
    if not stem:
        return run
    last = stem[-1]
    if 97 <= last <= 122 or 65 <= last <= 90 or (last >= 128 and stem[-4:].decode(errors="ignore")[-1:].isalpha()):
        return stem
    return run


_words: dict[str, Words] = {}


def words(path: str) -> Words:
    if path not in _words:
        _words[path] = Words(path)
    return _words[path]


def repaired(ids: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """(rules, symbols): the grammar of a sequence; rule i is symbol base + i."""
    seq = ids.astype(np.uint32)
    rules: list[tuple[int, int]] = []
    while len(seq) > 1:
        # pairs of small symbols fit one word of 32 bits, which is sorted in half the time
        bits = 16 if base + len(rules) <= 1 << 16 else 32
        kind = np.uint32 if bits == 16 else np.uint64
        shift, low = kind(bits), kind((1 << bits) - 1)
        wide = seq.astype(kind, copy=False)
        pairs = (wide[:-1] << shift) | wide[1:]
        ordered = np.sort(pairs)
        edges = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        times = np.diff(np.append(edges, len(ordered)))
        frequent = np.flatnonzero(times >= max(LEAST, len(seq) // SHARE))
        lefts, rights, chosen = set(), set(), []
        for k in frequent[np.argsort(-times[frequent], kind="stable")]:
            pair = int(ordered[edges[k]])
            a, b = pair >> bits, pair & ((1 << bits) - 1)
            # no chosen pair ends with what another begins with, so their occurrences are apart
            if a != b and a not in rights and b not in lefts:
                lefts.add(a)
                rights.add(b)
                chosen.append(pair)
            elif a == b and a not in rights and a not in lefts:
                lefts.add(a)
                rights.add(a)
                chosen.append(pair)
        if not chosen:
            break
        wanted = np.sort(np.array(chosen, kind))
        begins, finishes = np.zeros(base + len(rules), bool), np.zeros(base + len(rules), bool)
        begins[list(lefts)], finishes[list(rights)] = True, True
        found = np.flatnonzero(begins[seq[:-1]] & finishes[seq[1:]])
        at = np.minimum(np.searchsorted(wanted, pairs[found]), len(wanted) - 1)
        hit = wanted[at] == pairs[found]
        found, at = found[hit], at[hit]
        twins = (pairs[found] >> shift) == (pairs[found] & low)
        if twins.any():
            # in a run of one symbol every other occurrence is replaced
            place = np.arange(len(found))
            follows = np.zeros(len(found), bool)
            follows[1:] = twins[1:] & twins[:-1] & (found[1:] == found[:-1] + 1) & (pairs[found[1:]] == pairs[found[:-1]])
            begin = np.maximum.accumulate(np.where(follows, 0, place))
            every = ~twins | ((place - begin) % 2 == 0)
            found, at = found[every], at[every]
        before = len(seq)
        first = base + len(rules)
        rules.extend((int(p) >> bits, int(p) & ((1 << bits) - 1)) for p in wanted)
        seq[found] = at.astype(np.uint32) + np.uint32(first)
        keep = np.ones(len(seq), bool)
        keep[found + 1] = False
        seq = seq[keep]
        if before - len(seq) < GAIN * before:
            break
    return np.array(rules, np.uint32).reshape(-1, 2), seq


def expansions(rules: np.ndarray, base: int) -> list[np.ndarray]:
    """What each rule stands for."""
    out: list[np.ndarray] = []
    for a, b in rules.tolist():
        left = out[a - base] if a >= base else np.array([a], np.uint32)
        right = out[b - base] if b >= base else np.array([b], np.uint32)
        out.append(np.concatenate([left, right]))
    return out


def expanded(symbols: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """The ids that a run of symbols stands for."""
    texts = expansions(rules, base)
    flat = np.concatenate([np.empty(0, np.uint32), *texts])
    begins = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    rule = symbols >= base
    which = np.where(rule, symbols, base).astype(np.int64) - base
    lengths = np.where(rule, np.diff(begins, append=begins[-1])[which], 1)
    ends = np.cumsum(lengths)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint32)
    out[(ends - lengths)[~rule]] = symbols[~rule]
    held = lengths[rule]
    inside = np.arange(held.sum()) - np.repeat(np.cumsum(held) - held, held)
    out[np.repeat((ends - lengths)[rule], held) + inside] = flat[np.repeat(begins[which[rule]], held) + inside]
    return out


def symbols_of(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, rules, expansion lengths) of a file row."""
    kind = np.dtype(f"<u{row['width']}")
    return (
        np.frombuffer(row["symbols"], kind).astype(np.uint32),
        np.frombuffer(row["rules"], kind).astype(np.uint32).reshape(-1, 2),
        np.frombuffer(row["lengths"], "<u4"),
    )


def slice_of(row: dict, start: int, stop: int) -> np.ndarray:
    """Ids start .. stop - 1 of a shard: only the symbols that reach into them are expanded."""
    symbols, rules, lengths = symbols_of(row)
    base = row["base"]
    rule = symbols >= base
    each = np.ones(len(symbols), np.int64)
    each[rule] = lengths[symbols[rule].astype(np.int64) - base]
    ends = np.cumsum(each)
    low, high = int(np.searchsorted(ends, start, "right")), int(np.searchsorted(ends, stop, "left")) + 1
    ids = expanded(symbols[low:high], rules, base)
    skip = start - (int(ends[low - 1]) if low else 0)
    return ids[skip : skip + stop - start]


def _packed(path: str):
    """part, id, text (sorted) -> shards."""

    def row(part: int, number: int, ids: list, counts: list[int], data: list[bytes], base: int) -> dict:
        rules, symbols = repaired(np.frombuffer(b"".join(data), "<u4"), base)
        lengths = np.array([len(t) for t in expansions(rules, base)], "<u4")
        width = 2 if base + len(rules) <= 1 << 16 else 4
        kind = np.dtype(f"<u{width}")
        return {
            "part": part, "shard": number, "ids": ids, "counts": counts, "base": base, "width": width,
            "rules": rules.astype(kind).tobytes(), "lengths": lengths.tobytes(), "symbols": symbols.astype(kind).tobytes(),
        }

    schema = pa.schema(
        [("part", pa.int64()), ("shard", pa.int64()), ("ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("base", pa.int32()),
         ("width", pa.int32()), ("rules", pa.binary()), ("lengths", pa.binary()), ("symbols", pa.binary())]
    )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = words(path)
        base = known.tokenizer.get_vocab_size()
        end = np.array([END], "<u4").tobytes()
        number, held, ids, counts, data, where = 0, 0, [], [], [], 0
        for part in parts:
            places, keys = part.column(0).to_pylist(), part.column(1).to_pylist()
            for first, texts in batches(utf8(part.column(2))):
                for i, encoded in enumerate(known.texts(texts), first):
                    where = places[i]
                    ids.append(keys[i])
                    data.append(encoded + end)
                    counts.append(len(data[-1]) // 4)
                    held += counts[-1]
                    if held >= SHARD:
                        yield pa.RecordBatch.from_pylist([row(where, number, ids, counts, data, base)], schema)
                        number, held, ids, counts, data = number + 1, 0, [], [], []
        if ids:
            yield pa.RecordBatch.from_pylist([row(where, number, ids, counts, data, base)], schema)

    return run


def write_tokens(docs: DataFrame, to: str, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the shards of `docs` to the folder `to`, ids ascending (null first, ties by a hash of the text).

    path: the tokenizer's file. A document is the ids of its whole text (null: none) and the end id `END`. Ids are whole numbers;
    repeated rows are documents of their own; an empty table makes a file without rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange("id", tie).sortWithinPartitions("id", tie)
    shards = ordered.select(F.spark_partition_id().cast("long").alias("part"), "id", "text").mapInArrow(_packed(path), SHARDS)
    shards.write.option("compression", "zstd").parquet(to)


def _read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        for row in part.to_pylist():
            symbols, rules, _ = symbols_of(row)
            data = expanded(symbols, rules, row["base"]).astype("<u4")
            ends = np.cumsum(row["counts"])
            starts = ends - np.array(row["counts"])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["ids"], pa.int64()),
                    pa.array(starts + row["before"], pa.int64()),
                    pa.array(row["counts"], pa.int64()),
                    pa.array([zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)], pa.int64()),
                ],
                ["id", "start", "n_tokens", "ids_crc32"],
            )


def token_digest(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """id, start, n_tokens, ids_crc32 of every document, decoded from the files of `write_tokens`."""
    shards = spark.read.schema(SHARDS).parquet(path)
    sizes = shards.select("part", "shard", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    # one row for each partition that wrote
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_part"))
    before = sizes.select("part", "shard", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("_shard")).join(starts, "part")
    placed = shards.join(before.select("part", "shard", (F.col("_part") + F.col("_shard")).alias("before")), ["part", "shard"])
    columns = ["ids", "counts", "base", "width", "rules", "lengths", "symbols", "before"]
    told = placed.select(*columns).mapInArrow(_read, "id long, start long, n_tokens long, ids_crc32 long")
    return told.withColumnRenamed("id", id_col)


def tokens_of(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Writes the token files of `docs` to the shared folder and tells what is in them."""
    import public_tokenizers

    to = staging_path(docs.sparkSession, "tokens")
    write_tokens(docs, to, path or public_tokenizers.path("word_bpe_49k.json"))
    return token_digest(docs.sparkSession, to)


def op6_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place, length and checksum in the grammar-compressed token files."""
    return tokens_of(spark.read.parquet(f"{sf_dir}/documents.parquet"))
