"""Language identification by a byte convolutional network.

A text is cut into windows of `WINDOW` bytes, the whole text, the last one padded. Bytes have an embedding; filters of several
widths slide over a window, each keeps its maximum, and a softmax over those tells the language. The network is trained in numpy on the driver on a
bounded sample (`per_language` documents of each of at most `languages` languages, a piece of `PIECE` characters of each), and
applied to Arrow batches. A text's probabilities are the mean over its windows, weighted by their bytes.

Where texts are to be rejected the network learns one class more, from texts in no language that are made of the sample
(`disguised`), and what it leaves to the languages is held against the same of all held-out labelled documents (`all_bars`).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrazzo.llm.names import fresh
from terrazzo.llm.wordhash import batches, utf8
from terrazzo.operators.quantiles import exact_quantiles
from terrazzo.session import staged

WINDOW = 256
DIM = 8
WIDTHS = (2, 3, 4)
FILTERS = 16
PIECE = 2048
UNKNOWN = "und"
#: windows that go through the network at once: their activations stay in the cache
AT_ONCE = 32


@dataclass
class Network:
    """Names of the languages and the weights. Filters of all widths are as wide as the widest, with zeros behind.
    An output behind those of the languages stands for texts in none of them."""

    names: list[str]
    embedding: np.ndarray  # 256 x DIM; byte 0 pads and stays zero
    filters: np.ndarray  # max(WIDTHS) * DIM x filters
    filter_bias: np.ndarray
    out: np.ndarray  # filters x languages, and one for none of them where it is learned
    out_bias: np.ndarray

    def patches(self, windows: np.ndarray) -> np.ndarray:
        """windows x places x (widest filter * DIM); a window is followed by padding, so every byte starts a patch."""
        wide = max(WIDTHS)
        padded = np.zeros((len(windows), WINDOW + wide - 1, DIM), np.float32)
        padded[:, :WINDOW] = self.embedding[windows]
        view = np.lib.stride_tricks.as_strided(
            padded, (len(windows), WINDOW, wide * DIM), (padded.strides[0], padded.strides[1], padded.strides[2])
        )
        return np.ascontiguousarray(view)

    def pooled(self, patches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The maximum of each filter over a window, and where it is."""
        active = (patches.reshape(-1, patches.shape[2]) @ self.filters).reshape(len(patches), WINDOW, -1)
        where = active.argmax(axis=1)
        top = np.take_along_axis(active, where[:, None, :], axis=1)[:, 0]
        return np.maximum(top + self.filter_bias, 0), where

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        out = np.empty((len(windows), len(self.out_bias)), np.float32)
        for at in range(0, len(windows), AT_ONCE):
            patches = self.patches(windows[at : at + AT_ONCE])
            active = (patches.reshape(-1, patches.shape[2]) @ self.filters).reshape(len(patches), WINDOW, -1)
            top = np.maximum(active.max(axis=1) + self.filter_bias, 0)
            out[at : at + AT_ONCE] = softmax(top @ self.out + self.out_bias)
        return out


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The windows of all texts, and the number of the text of each."""
    counts = [-(-len(t) // WINDOW) for t in texts]
    data = b"".join(t.ljust(n * WINDOW, b"\0") for t, n in zip(texts, counts, strict=True))
    return np.frombuffer(data, np.uint8).reshape(-1, WINDOW), np.repeat(np.arange(len(texts)), counts)


def train(
    texts: list[bytes], labels: list[str], epochs: int = 12, batch: int = 64, rate: float = 0.01, seed: int = 0, none: Sequence[bytes] = ()
) -> Network:
    """A network trained by Adam on all windows of the texts, and of `none` as texts in no language. Without labelled texts it knows no language."""
    names = sorted(set(labels))
    classes = max(len(names) + bool(none), 1)
    rng = np.random.default_rng(seed)
    wide, total = max(WIDTHS), FILTERS * len(WIDTHS)
    mask = np.zeros((wide * DIM, total), np.float32)
    for i, width in enumerate(WIDTHS):
        mask[: width * DIM, i * FILTERS : (i + 1) * FILTERS] = 1
    scale = np.sqrt(2 / mask.sum(axis=0))
    net = Network(
        names,
        rng.normal(0, 1, (256, DIM)).astype(np.float32),
        (rng.normal(0, 1, mask.shape) * mask * scale).astype(np.float32),
        np.zeros(total, np.float32),
        rng.normal(0, 0.1, (total, classes)).astype(np.float32),
        np.zeros(classes, np.float32),
    )
    net.embedding[0] = 0
    if len(names) < 2:
        return net
    windows, owner = windows_of([*texts, *none])
    wanted = np.array([names.index(x) for x in labels] + [len(names)] * len(none))[owner]
    params = [net.embedding, net.filters, net.filter_bias, net.out, net.out_bias]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for epoch in range(epochs):
        for at in np.array_split(rng.permutation(len(windows)), max(1, len(windows) // batch)):
            part = windows[at]
            patches = net.patches(part)
            top, where = net.pooled(patches)
            error = softmax(top @ net.out + net.out_bias)
            error[np.arange(len(at)), wanted[at]] -= 1
            error /= len(at)
            back = (error @ net.out.T) * (top > 0)
            chosen = patches[np.arange(len(at))[:, None], where]  # windows x filters x patch
            grad_filters = np.einsum("nf,nfp->pf", back, chosen) * mask
            # the bytes below each chosen patch
            spread = (back[:, :, None] * net.filters.T[None]).reshape(len(at), total, wide, DIM)
            padded = np.zeros((len(at), WINDOW + wide - 1), np.int64)
            padded[:, :WINDOW] = part
            below = padded[np.arange(len(at))[:, None, None], where[:, :, None] + np.arange(wide)]
            grad_embedding = np.zeros_like(net.embedding)
            np.add.at(grad_embedding, below.reshape(-1), spread.reshape(-1, DIM))
            grad_embedding[0] = 0
            grads = [grad_embedding, grad_filters, back.sum(axis=0), top.T @ error, error.sum(axis=0)]
            step += 1
            pace = rate * (1 - epoch / epochs)
            for p, g, m, v in zip(params, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def training_rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int, languages: int) -> tuple[list[bytes], list[str]]:
    """The bounded sample: for each of the commonest languages about `per_language` documents, chosen by a hash of the id."""
    named = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = named.groupBy(lang_col).count().orderBy(F.desc("count"), lang_col).limit(languages).collect()
    if not counts:
        return [], []
    parts = 1 << 30
    share = F.create_map(*(x for r in counts for x in (F.lit(r[0]), F.lit(min(parts, parts * per_language // r[1])))))
    chosen = F.pmod(F.xxhash64(id_col, F.lit("train")), F.lit(parts)) < F.element_at(share, F.col(lang_col))
    # somewhere in the text
    at = F.pmod(F.xxhash64(id_col, F.lit("at")), F.greatest(F.char_length(text_col) - PIECE, F.lit(0)) + 1) + 1
    rows = (
        named.where(chosen)
        .select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.substring(F.col(text_col), at.cast("int"), F.lit(PIECE)).alias("text"))
        .limit(2 * per_language * len(counts))
        .collect()
    )
    rows.sort(key=lambda r: (r["id"], r["text"]))
    return [r["text"].encode() for r in rows], [r["lang"] for r in rows]


def disguised(texts: list[bytes], seed: int = 0) -> list[bytes]:
    """For every text one in no language, of the same length in characters and with the same signs between its letters.

    By turns its letters are exchanged for each other by a random table, for those of another script, each by itself for any of a few
    or many letters, or shuffled over the text.
    """
    rng = np.random.default_rng(seed)
    held = [t.decode() for t in texts]
    letters = sorted({c for t in held for c in t.lower() if c.isalpha()})
    out = []
    for i, text in enumerate(held):
        at = np.array([c.isalpha() for c in text], bool)
        if i % 4 == 0:
            table = dict(zip(letters, rng.permutation(letters).tolist(), strict=True))
            new = [table.get(c.lower(), c) for c in text]
        elif i % 4 == 1:
            first = rng.integers(0x370, 0xD000)
            table = dict(zip(letters, (chr(first + x) for x in rng.permutation(len(letters)) % 64), strict=True))
            new = [table.get(c.lower(), c) for c in text]
        elif i % 4 == 2:
            some = rng.permutation(letters)[: int(np.exp(rng.uniform(0, np.log(len(letters) + 1))))]
            new = np.where(at, rng.choice(some, len(text)), list(text)).tolist()
        else:
            moved = np.array(list(text.lower()))
            moved[at] = rng.permutation(moved[at])
            new = moved.tolist()
        out.append("".join(n.upper() if c.isupper() else n for n, c in zip(new, text, strict=True)).encode())
    return out


def summed(net: Network, held: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The probabilities of every text summed over its windows, weighted by their bytes, and the sum of the weights."""
    windows, owner = windows_of(held)
    likely = net.probabilities(windows)
    # 0 is padding; a text may hold it too, and its bytes then weigh nothing
    weight = np.count_nonzero(windows, axis=1).astype(np.float64) + 1e-9
    sums = np.zeros((len(held), likely.shape[1]))
    np.add.at(sums, owner, likely * weight[:, None])
    return sums, np.bincount(owner, weights=weight, minlength=len(held))


def placed(net: Network, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """The likeliest language of every text by number, and the share of the text that is in any language; -1 and 0 for a null or empty one."""
    best, share = [], []
    for _, held in batches(texts):
        sums, totals = summed(net, held)
        there = np.array([bool(t) for t in held], bool)
        best.append(np.where(there, sums[:, : len(net.names)].argmax(axis=1), -1))
        share.append(np.where(there, 1 - sums[:, -1] / np.maximum(totals, 1e-9), 0))
    return np.concatenate([*best, np.zeros(0, np.int64)]), np.concatenate([*share, np.zeros(0)])


def bars(net: Network, texts: list[bytes], lost: float) -> np.ndarray:
    """For each language the share in any language that a text told as that language has to have: one half, or less where more than
    the part `lost` of the held-out documents told so are below it. Where they are too few to say so the bar is that of all
    languages, and where all are too few the least share among them. For texts at hand; `all_bars` tells the same of a table.
    """
    best, share = placed(net, texts)

    def rank(scores: np.ndarray) -> int:
        # the next text would be below the score of this rank with a probability of `lost` at most
        return int(lost * (len(scores) + 1))

    def bar(scores: np.ndarray) -> float:
        return min([0.5, *np.sort(scores)[max(rank(scores), 1) - 1 :][:1]])

    groups = [share[best == i] for i in range(len(net.names))]
    return np.array([bar(g if rank(g) else share) for g in groups])


#: all languages together, beside the numbers of the languages
_EVERY = -1


def all_bars(net: Network, held: DataFrame, text_col: str, lost: float) -> np.ndarray:
    """`bars` of every text of `held`, whole. Executors place the texts and count their shares; the driver sees one row for each language."""
    shares = staged(held.select(text_col).mapInArrow(_placed(net), "best int, share double"), "shares")
    every = shares.select(F.explode(F.array(F.col("best"), F.lit(_EVERY))).alias("best"), "share")

    def rank(n: Column) -> Column:
        # as in `bars`
        return F.floor(F.lit(lost) * (n + 1))

    enough = every.groupBy("best").agg((rank(F.count("share")) >= 1).alias("enough"))
    lowest = {r["best"]: r["bar"] for r in exact_quantiles(every, ("best",), {"bar": ("share", rank)}).collect()}
    usable = {r["best"] for r in enough.collect() if r["enough"]}
    return np.array([min(0.5, lowest.get(i if i in usable else _EVERY, 0.5)) for i in range(len(net.names))])


def told(net: Network, texts: list[bytes | None]) -> tuple[list[str], list[float]]:
    """Language and score of every text; `und` and 0 for a null or empty one."""
    names, scores = [], []
    for _, held in batches(texts):
        sums, totals = summed(net, held)
        for i, text in enumerate(held):
            if not text or not net.names:
                names.append(UNKNOWN)
                scores.append(0.0)
            else:
                best = int(sums[i].argmax())
                names.append(net.names[best])
                scores.append(float(min(1.0, sums[i][best] / totals[i])))
    return names, scores


def _predicted(net: Network):
    """id, held_out, text (null where it has no letter) -> id, held_out, lang_pred, score."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            names, scores = told(net, utf8(part.column(2)))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["id", "held_out", "lang_pred", "score"],
            )

    return run


def _placed(net: Network):
    """Texts -> best, share."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            best, share = placed(net, utf8(part.column(0)))
            yield pa.RecordBatch.from_arrays([pa.array(best, pa.int32()), pa.array(share, pa.float64())], ["best", "share"])

    return run


def _accepted(net: Network, least: np.ndarray):
    """Rows, their judged text last -> the rows that are accepted."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            last = part.num_columns - 1
            best, share = placed(net, utf8(part.column(last)))
            good = (best >= 0) & (share >= least[best])
            yield pa.RecordBatch.from_arrays(part.columns[:last], part.schema.names[:last]).filter(pa.array(good, pa.bool_()))

    return run


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identified(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 400, languages: int = 256
) -> DataFrame:
    """id, held_out, lang_pred, score of every row of `docs`.

    Learns from rows with a language and an id whose crc32 modulo 4 is not 2; predicts from the text alone. A null text, an
    empty one or one without a letter is `und` with a score of 0, as is everything where nothing could be learned. Repeated
    rows are told alike.
    """
    net = learned(docs, id_col, text_col, lang_col, per_language, languages)
    rows = docs.select(F.col(id_col).alias("id"), held_out(F.col(id_col)).alias("held_out"), judged(F.col(text_col)).alias("text"))
    found = rows.mapInArrow(_predicted(net), f"id {dict(docs.dtypes)[id_col]}, held_out boolean, lang_pred string, score double")
    return found.withColumnRenamed("id", id_col)


def learned(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int, languages: int) -> Network:
    learn = docs.where(F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    return train(*training_rows(learn, id_col, text_col, lang_col, per_language, languages))


def judged(text: Column) -> Column:
    """The text if it has a letter."""
    return F.when(text.rlike(r"\p{L}"), text)


def accepted(
    docs: DataFrame, lost: float = 0.01, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 400,
    languages: int = 256,
) -> DataFrame:
    """The rows of `docs` that are not rejected: those without a letter are, and those that the network takes for none of its
    languages, by a bar for each language that at most the part `lost` of all its held-out labelled documents misses. Where fewer than two
    languages are learned (one label only, or none at all) there is nothing to tell apart, and every text with a letter stays."""
    clean = docs.where(judged(F.col(text_col)).isNotNull() & F.col(id_col).isNotNull())
    held = held_out(F.col(id_col))
    texts, labels = training_rows(clean.where(~held), id_col, text_col, lang_col, per_language, languages)
    if len(set(labels)) < 2:
        return docs.where(judged(F.col(text_col)).isNotNull())
    net = train(texts, labels, none=disguised(texts))
    least = all_bars(net, clean.where(held & F.col(lang_col).isNotNull()), text_col, lost)
    # the last column, by place
    rows = docs.withColumn(*fresh(docs, "_judged"), judged(F.col(text_col)))
    return rows.mapInArrow(_accepted(net, least), docs.schema)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    return identified(spark.read.parquet(f"{sf_dir}/documents.parquet"))
