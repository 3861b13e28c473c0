"""Removal of long strings that stand more than once in all texts, by suffix arrays.

1. Anchors (`anchors.py`) cut every text into windows: runs of starts of `length`-byte strings that share an anchor, with the bytes they
   reach. Equal strings lie in windows of one anchor, so anchors that stand once need no further look.
2. Windows equal as a whole repeat in all their strings, whether there are two or a billion of them; one of each stays for the rest.
3. What is left goes to shards by anchor. A shard of bounded size gets a suffix array (Larsson-Sadakane) and the common prefixes of its neighbours (Kasai):
   a string repeats where one of at least `length` bytes meets it.
4. An anchor with more windows than a shard holds is spread over several. Their strings are merged across shards: digests, dealt by
   their high bits, are looked up in the other shards' sorted runs by binary search.
5. Every text drops the bytes that its repeated strings cover.
"""  # noqa: E501

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrazzo.llm import anchors
from terrazzo.llm.suffixes import in_other_runs, repeated_starts
from terrazzo.llm.wordhash import _power, utf8
from terrazzo.session import staged

#: bytes of windows in a shard, and of an anchor's windows from which it has shards of its own
SHARD, LARGE = 1 << 20, 1 << 19
#: digests of a merge task
MERGE = 1 << 20
#: tasks that the rows of one key are spread over in a join
SALTS = 32

WINDOWS = "k long, h long, lo int, hi int, anchor long, digest long"


def _windows(length: int):
    """k, h, text -> the windows of every text."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = [t or b"" for t in utf8(part.column(2))]
            k, h = part.column(0).to_numpy(), part.column(1).to_numpy()
            for which, first, last, anchor in anchors.anchored(texts, length):
                digests = [
                    anchors.digest(texts[i][a : b + length]) for i, a, b in zip(which.tolist(), first.tolist(), last.tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k[which]), pa.array(h[which]), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)),
                     pa.array(anchor), pa.array(digests, pa.int64())],
                    ["k", "h", "lo", "hi", "anchor", "digest"],
                )

    return run


def _compressed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts in the last column, compressed for the shuffle."""
    pack = zstandard.ZstdCompressor(level=1)
    for part in parts:
        data = [pack.compress(t or b"") for t in utf8(part.column(part.num_columns - 1))]
        yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(data, pa.binary())], part.schema.names)


def _cut(length: int):
    """k, h, cuts (array of lo, hi, anchor, digest, n, pieces, slices), text -> one row for each window with its bytes."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for part in parts:
            for k, h, cuts, packed in zip(*(part.column(i).to_pylist() for i in range(4)), strict=True):
                text = unpack.decompress(packed) if cuts else b""
                names = ("lo", "hi", "anchor", "digest", "n", "pieces", "slices")
                columns = {c: [cut[c] for cut in cuts] for c in names}
                yield pa.RecordBatch.from_pydict(
                    {"k": [k] * len(cuts), "h": [h] * len(cuts), **columns, "data": [text[c["lo"] : c["hi"] + length] for c in cuts]},
                    schema=_CUT,
                )

    return run


_CUT = pa.schema(
    [("k", pa.int64()), ("h", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("anchor", pa.int64()), ("digest", pa.int64()),
     ("n", pa.int64()), ("pieces", pa.int64()), ("slices", pa.int64()), ("data", pa.binary())]
)
CUT = "k long, h long, lo int, hi int, anchor long, digest long, n long, pieces long, slices long, data binary"


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of every run of true values."""
    padded = np.concatenate([[False], flags, [False]])
    return np.flatnonzero(~padded[:-1] & padded[1:]), np.flatnonzero(padded[:-1] & ~padded[1:]) - 1


def _shard(length: int):
    """The windows of one shard -> one row for each window and slice of digests.

    `runs`: pairs of first and last repeated start, in the row of the first slice. `starts` and `digests`, of a divided anchor only:
    the window's strings whose digests fall into the slice.
    """  # noqa: E501

    def run(table: pa.Table) -> pa.Table:
        texts = table.column("data").to_pylist()
        hit = repeated_starts(texts, length)
        ends = np.cumsum([len(t) for t in texts])
        divided = table.column("pieces")[0].as_py() > 1
        slices = table.column("slices")[0].as_py()
        alone = table.column("n").to_pylist()
        rows, runs, part, starts, digests = [], [], [], [], []
        for i, text in enumerate(texts):
            count = len(text) - length + 1
            flags = hit[ends[i] - len(text) : ends[i] - len(text) + count]
            # a window that stands more than once repeats as a whole anyhow
            own = np.stack(_runs(flags), axis=1).reshape(-1).tolist() if alone[i] == 1 else []
            if not divided:
                if own:
                    rows.append(i)
                    runs.append(own)
                    part.append(0)
                    starts.append(b"")
                    digests.append(b"")
                continue
            # strings repeated here may repeat elsewhere too, and others must see them
            pairs = np.stack(string_digests(text, length), axis=1)
            where = pairs[:, 0].view(np.uint64) % np.uint64(slices)
            for number in np.unique(where).tolist():
                chosen = np.flatnonzero(where == number)
                rows.append(i)
                runs.append(own)
                own = []
                part.append(number)
                starts.append(chosen.astype("<i4").tobytes())
                digests.append(pairs[chosen].astype("<i8").tobytes())
        out = table.select(["k", "h", "lo", "anchor", "n", "piece"]).take(pa.array(rows, pa.int64()))
        for name, values, kind in (
            ("runs", runs, pa.list_(pa.int32())), ("slice", part, pa.int64()), ("starts", starts, pa.binary()), ("digests", digests, pa.binary()),
        ):
            out = out.append_column(name, pa.array(values, kind))
        return out

    return lambda key, table: run(table)


SHARDED = "k long, h long, lo int, anchor long, n long, piece long, runs array<int>, slice long, starts binary, digests binary"

_rng = np.random.default_rng(31337)
_TABLES = _rng.integers(1, 1 << 63, (2, 256), dtype=np.uint64) | np.uint64(1)


def string_digests(text: bytes, length: int) -> list[np.ndarray]:
    """Two hashes of the `length` bytes from each start on."""
    data = np.frombuffer(text, np.uint8)
    out = []
    for table in _TABLES:
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(table[data] * _power("gram up", anchors._BASE, len(data)), dtype=np.uint64, out=sums[1:])
        whole = (sums[length:] - sums[:-length]) * _power("gram down", anchors._INVERSE, len(data))[: len(data) - length + 1]
        out.append(anchors.mixed(whole).view(np.int64))
    return out


def _merged(key: tuple, table: pa.Table) -> pa.Table:
    """One slice of the digests of a divided anchor -> the windows' starts that another piece has too."""
    starts = [np.frombuffer(x, "<i4") for x in table.column("starts").to_pylist()]
    sizes = np.array([len(x) for x in starts])
    whole = np.frombuffer(b"".join(table.column("digests").to_pylist()), np.uint8).reshape(-1, 16).copy()
    # one bit that is always set: numpy's strings drop zeros at the end
    whole[:, 15] |= 1
    found = in_other_runs(whole.reshape(-1).view("S16"), np.repeat(table.column("piece").to_numpy(), sizes))
    found &= np.repeat(table.column("n").to_numpy() == 1, sizes)
    rows, runs = [], []
    for i, (flags, own) in enumerate(zip(np.split(found, np.cumsum(sizes)[:-1]), starts, strict=True)):
        if flags.any():
            rows.append(i)
            hit = own[flags]
            cut = np.flatnonzero(np.diff(hit) > 1)
            runs.append(np.stack([np.append(hit[:1], hit[cut + 1]), np.append(hit[cut], hit[-1:])], axis=1).reshape(-1).tolist())
    return table.select(["k", "h", "lo"]).take(pa.array(rows, pa.int64())).append_column("runs", pa.array(runs, pa.list_(pa.int32())))


def _kept(length: int):
    """id, ranges (array of first, last repeated start), text -> what is left of each text."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for part in parts:
            rows = []
            for ranges, packed in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                text = unpack.decompress(packed)
                rows.append((len(text), *removed(text, [(r["first"], r["last"] + length) for r in ranges or []])))
            columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())],
                ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return run


def removed(text: bytes, spans: list[tuple[int, int]]) -> tuple[int, int, str]:
    """Bytes covered by the spans, maximal runs of them, sha256 of the others."""
    gone, count, at, rest = 0, 0, 0, hashlib.sha256()
    end = None
    for begin, stop in sorted(spans):
        if end is None or begin > end:
            rest.update(text[at:begin])
            count += 1
            gone += stop - begin
            at = end = stop
        elif stop > end:
            gone += stop - end
            at = end = stop
    rest.update(text[at:])
    return gone, count, rest.hexdigest()


def _salt(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(SALTS)).cast("int")


def _salts(*columns: str) -> Column:
    """The salts that rows of a group have, as the bits of a number: an aggregate, combined before the shuffle."""
    return F.bit_or(F.call_function("shiftleft", F.lit(1), _salt(*columns)))


def _spread(groups: DataFrame) -> DataFrame:
    """Each group once for each of its salts (`salts` becomes `salt`): never more rows than the other side of the join has."""
    own = F.filter(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda i: F.expr("salts").bitwiseAND(F.call_function("shiftleft", F.lit(1), i)) != 0)
    return groups.withColumn("salt", F.explode(own)).drop("salts")


def repeated_ranges(rows: DataFrame, length: int) -> DataFrame:
    """k, h, ranges (array of first, last): the repeated starts of each text, in any number of rows. `rows`: k, h (together the key of a text), text."""
    windows = staged(rows.mapInArrow(_windows(length), WINDOWS), "windows")
    # one anchor, or one window, may hold most rows: joins on it go by a salt too
    repeated = windows.groupBy("anchor").agg(F.count("*").alias("c"), _salts("digest", "k").alias("salts")).where("c > 1").select("anchor", "salts")
    shared = staged(windows.withColumn("salt", _salt("digest", "k")).join(_spread(repeated), ["anchor", "salt"]).drop("salt"), "shared")
    one = F.min(F.struct("k", "h", "lo", "hi")).alias("one")
    distinct = staged(shared.groupBy("anchor", "digest").agg(F.count("*").alias("n"), one, _salts("k").alias("salts")), "distinct")
    several_times = _spread(distinct.where("n > 1").select("anchor", "digest", "salts"))
    whole = shared.withColumn("salt", _salt("k")).join(several_times, ["anchor", "digest", "salt"]).select(
        "k", "h", F.array(F.struct(F.col("lo").alias("first"), F.col("hi").alias("last"))).alias("ranges")
    )
    size = F.col("one.hi") - F.col("one.lo") + length
    several = distinct.groupBy("anchor").agg(
        F.count("*").alias("d"), F.sum(size).alias("bytes"), F.ceil(F.sum(size - length + 1) / MERGE).alias("slices"),
        _salts("digest").alias("salts"),
    ).where("d > 1")
    pieces = F.when(F.col("bytes") > LARGE, F.ceil(F.col("bytes") / LARGE)).otherwise(F.lit(0))
    several = staged(several.select("anchor", "bytes", "slices", "salts", pieces.alias("pieces")), "several")
    total = several.where("pieces = 0").agg(F.sum("bytes")).first()[0] or 0
    shards = max(1, -(-total // SHARD))
    spread = _spread(several.select("anchor", "slices", "pieces", "salts"))
    cuts = distinct.drop("salts").withColumn("salt", _salt("digest")).join(spread, ["anchor", "salt"]).select("anchor", "digest", "n", "pieces", "slices", "one.*")
    cuts = cuts.groupBy("k", "h").agg(F.collect_list(F.struct("lo", "hi", "anchor", "digest", "n", "pieces", "slices")).alias("cuts"))
    packed = rows.select("k", "h", "text").mapInArrow(_compressed, "k long, h long, packed binary")
    # texts of one key are equal: any of them will do, and a window cut twice is put right below
    cut = cuts.join(packed, ["k", "h"]).select("k", "h", "cuts", "packed").mapInArrow(_cut(length), CUT)
    cut = cut.dropDuplicates(["k", "h", "lo", "hi"])
    divided = F.col("pieces") > 1
    piece = F.when(divided, F.pmod("digest", "pieces")).otherwise(F.lit(0))
    # an anchor of its own shard or shards; others together, by a hash
    own = F.when(F.col("pieces") > 0, F.col("anchor")).otherwise(F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    sharded = staged(
        cut.withColumns({"piece": piece, "own": own, "large": F.col("pieces") > 0})
        .groupBy("large", "own", "piece")
        .applyInArrow(_shard(length), SHARDED),
        "shards",
    )
    merged = sharded.where("length(digests) > 0").groupBy("anchor", "slice").applyInArrow(_merged, "k long, h long, lo int, runs array<int>")
    paired = "transform(sequence(0, size(runs) div 2 - 1), i -> struct(lo + runs[2 * i] as first, lo + runs[2 * i + 1] as last))"
    found = sharded.select("k", "h", "lo", "runs").unionByName(merged).where("size(runs) > 0").select("k", "h", F.expr(paired).alias("ranges"))
    return whole.unionByName(found)


def without_repeats(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256 of every row of `docs`.

    Removed is each byte of the UTF-8 text that is covered by a `length`-byte string that also starts anywhere else, in the same text or
    another, judged on the input as it is. Null is an empty text; a text shorter than `length` keeps everything; rows that are
    equal repeat each other, whatever their ids, null among them. An empty table gives no rows.
    """  # noqa: E501
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("k"),
        F.xxhash64(F.coalesce(text_col, F.lit("")), F.col(id_col).isNull()).alias("h"),
        F.coalesce(text_col, F.lit("")).alias("text"),
    )
    ranges = staged(repeated_ranges(rows.select("k", "h", "text"), length), "ranges")
    ranges = ranges.groupBy("k", "h").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))
    packed = rows.select("id", "k", "h", "text").mapInArrow(_compressed, "id long, k long, h long, packed binary")
    kept = packed.join(ranges, ["k", "h"], "left").select("id", "ranges", "packed")
    told = kept.mapInArrow(_kept(length), "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return told.withColumnRenamed("id", id_col)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 400-byte strings that stand more than once."""
    return without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
