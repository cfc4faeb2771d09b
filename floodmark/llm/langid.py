"""Language ID by a byte convolutional network.

A text's bytes are cut into windows of ``WINDOW`` bytes that overlap by the widest filter. Each
byte has a small vector; filters of several widths slide over a window, each keeps its largest
response (max pooling), and a softmax over the pooled responses names the language. The
network is trained in numpy on the driver, on windows of a bounded sample of labelled texts:
``FIT_ROWS`` distinct texts in all, the same number for each language, picked by a hash of the
text. A text's logits are the mean over all its windows, weighted by their bytes. Tasks apply
the network to batches of windows, so a text of any length takes bounded memory.

Defined results: null texts and texts without a letter are ``und`` with score 0, as is every text
where there is nothing to learn from; with one language all others score 1 for it; equal texts
get equal results up to rounding; ties go to the language that sorts first; rows with null ids
are not held out and not learned from; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floodmark.llm.base import query, table
from floodmark.llm.words import encoded

#: Texts that the network is trained on, at most, in all languages together; windows of each.
FIT_ROWS, FIT_WINDOWS = 8000, 2
#: Bytes of a window, numbers for a byte, widths of filters, filters of each width.
WINDOW, BYTE_SIZE, WIDTHS, FILTERS = 256, 8, (2, 3, 4, 5), 16
WIDEST = max(WIDTHS)
STEP = WINDOW - WIDEST + 1
EPOCHS, BATCH, RATE = 4, 64, 0.004
#: Windows that are worked on at a time.
SLAB = 128
UNKNOWN = "und"


def windows(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """All windows of a text, padded with blanks at its end, and the bytes of each."""
    data = np.frombuffer(encoded(text), np.uint8)
    n = max(1, -(-(len(data) - WIDEST + 1) // STEP))
    padded = np.full((n - 1) * STEP + WINDOW, 0x20, np.uint8)
    padded[: len(data)] = data
    at = np.arange(n) * STEP
    return padded[at[:, None] + np.arange(WINDOW)], np.minimum(len(data) - at, WINDOW)


@dataclass
class Network:
    """Byte vectors, filters (all as wide as the widest, zero beyond their own width) and the softmax layer."""

    languages: list[str]
    bytes: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    weights: np.ndarray
    offset: np.ndarray

    @classmethod
    def fresh(cls, languages: list[str], seed: int = 12) -> Network:
        rng = np.random.default_rng(seed)
        n = FILTERS * len(WIDTHS)
        draw = lambda *shape, scale: rng.normal(scale=scale, size=shape).astype(np.float32)
        out = cls(languages, draw(256, BYTE_SIZE, scale=0.5), draw(WIDEST * BYTE_SIZE, n, scale=0.3), np.zeros(n, np.float32), draw(n, len(languages), scale=0.1), np.zeros(len(languages), np.float32))
        out.filters *= out.shape
        return out

    @property
    def shape(self) -> np.ndarray:
        """1 where a filter may have weight."""
        width = np.repeat(WIDTHS, FILTERS)
        return (np.arange(WIDEST * BYTE_SIZE)[:, None] < width * BYTE_SIZE).astype(np.float32)

    def columns(self, rows: np.ndarray) -> np.ndarray:
        """What the filters see at each place of each window."""
        vectors = self.bytes[rows]
        n, step = WINDOW - WIDEST + 1, vectors.strides[1]
        view = np.lib.stride_tricks.as_strided(vectors, (len(rows), n, WIDEST * BYTE_SIZE), (vectors.strides[0], step, vectors.strides[2]))
        return np.ascontiguousarray(view).reshape(len(rows) * n, -1)

    def responses(self, columns: np.ndarray, n: int) -> np.ndarray:
        return (columns @ self.filters).reshape(n, -1, self.filters.shape[1])

    def logits(self, rows: np.ndarray) -> np.ndarray:
        """Window by window; the bias is the same at each place, so it follows the maximum."""
        out = np.empty((len(rows), len(self.languages)))
        for k in range(0, len(rows), SLAB):
            part = rows[k : k + SLAB]
            pooled = np.maximum(self.responses(self.columns(part), len(part)).max(axis=1) + self.bias, 0)
            out[k : k + SLAB] = pooled @ self.weights + self.offset
        return out

    def slopes(self, rows: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean cross entropy. Only the largest response of a filter has one."""
        n, columns = len(rows), self.columns(rows)
        every = self.responses(columns, n)
        place = every.argmax(axis=1)
        top = np.take_along_axis(every, place[:, None, :], axis=1)[:, 0] + self.bias
        pooled = np.maximum(top, 0)
        error = softmax(pooled @ self.weights + self.offset)
        error[np.arange(n), labels] -= 1
        error = (error / n).astype(np.float32)
        back = (error @ self.weights.T) * (top > 0)
        seen = columns[(np.arange(n)[:, None] * (WINDOW - WIDEST + 1) + place).ravel()].reshape(n, len(self.bias), -1)
        filters = np.einsum("nf,nfc->cf", back, seen) * self.shape
        spread = (back[:, :, None] * self.filters.T[None]).reshape(n, len(self.bias), WIDEST, BYTE_SIZE)
        met = rows[np.arange(n)[:, None, None], place[:, :, None] + np.arange(WIDEST)]
        vectors = np.stack([np.bincount(met.ravel(), weights=spread[..., k].ravel(), minlength=256) for k in range(BYTE_SIZE)], axis=1)
        return [vectors.astype(np.float32), filters, back.sum(axis=0), pooled.T @ error, error.sum(axis=0)]


def softmax(logits: np.ndarray) -> np.ndarray:
    out = np.exp(logits - logits.max(axis=1, keepdims=True))
    return out / out.sum(axis=1, keepdims=True)


def train(rows: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = EPOCHS, seed: int = 12) -> Network:
    """A network for windows with the number of their language, by Adam over small batches."""
    net, rng = Network.fresh(languages, seed), np.random.default_rng(seed)
    weights = [net.bytes, net.filters, net.bias, net.weights, net.offset]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    turn = 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for k in range(0, len(order), BATCH):
            at = order[k : k + BATCH]
            turn += 1
            for w, slope, m, v in zip(weights, net.slopes(rows[at], labels[at]), first, second, strict=True):
                m += 0.1 * (slope - m)
                v += 0.01 * (slope * slope - v)
                w -= RATE * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-7)
    return net


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike("\\p{L}"), F.lit(False))


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", fit_rows: int = FIT_ROWS) -> Network | None:
    """A network for the languages of labelled texts; None where no labelled text has a letter."""
    text = F.col(f"`{text_col}`")
    told = docs.where(has_letter(text) & F.col(f"`{lang_col}`").isNotNull())
    told = told.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), text.alias("text"), F.xxhash64(text).alias("mark"))
    # Texts count once however many copies they have; only their marks are shuffled.
    counts = told.select("lang", "mark").distinct().groupBy("lang").count()
    # One row for each language, and of more than ``fit_rows`` languages those with most texts.
    counts = counts.orderBy(F.desc("count"), "lang").limit(fit_rows).collect()
    each = max(1, fit_rows // max(1, len(counts)))
    # Marks are spread evenly, so a bound on them gives a few more than wanted; the rest is cut below.
    wanted = each + 8 * math.sqrt(each)
    last = [(r.lang, int(min(1.0, wanted / r["count"]) * (1 << 64)) - (1 << 63) - 1) for r in counts]
    last = docs.sparkSession.createDataFrame(last, "lang string, last long")
    chosen = told.join(F.broadcast(last), "lang").where("mark <= last").groupBy("lang", "mark").agg(F.first("text").alias("text"))

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, marks, cut = [], [], []
            for lang, mark, value in zip(*(batch.column(c).to_pylist() for c in ("lang", "mark", "text")), strict=True):
                rows, _ = windows(value)
                rng = np.random.default_rng(crc32(encoded(value)))
                for k in rng.permutation(len(rows))[:FIT_WINDOWS]:
                    langs.append(lang), marks.append(mark), cut.append(rows[k].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(marks, pa.int64()), pa.array(cut, pa.binary())], ["lang", "mark", "window"])

    # Some FIT_ROWS * FIT_WINDOWS windows of 256 bytes.
    found = sorted(chosen.mapInArrow(some, "lang string, mark long, window binary").collect())
    if not found:
        return None
    languages = sorted({r.lang for r in found})
    smallest = {lang: set(sorted({r.mark for r in found if r.lang == lang})[:each]) for lang in languages}
    found = [r for r in found if r.mark in smallest[r.lang]]
    rows = np.frombuffer(b"".join(bytes(r.window) for r in found), np.uint8).reshape(-1, WINDOW)
    return train(rows, np.array([languages.index(r.lang) for r in found]), languages)


def predict(docs: DataFrame, network: Network | None, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """id, the columns of ``carry``, lang_pred and score of each whole text."""
    fields = [docs.schema[c] for c in (id_col, *carry)]
    schema = T.StructType([*(T.StructField(f"c{i}", f.dataType) for i, f in enumerate(fields)), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    known = [F.col(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(fields)]
    inner = docs.select(*known, F.when(has_letter(F.col(f"`{text_col}`")), F.col(f"`{text_col}`")).alias("text"))

    def named(texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Windows of many texts are worked on together, a bounded number at a time."""
        total = np.zeros((len(texts), len(network.languages)))
        held, owner, size = [], [], 0

        def flush() -> None:
            rows, own = np.concatenate([r for r, _ in held]), np.concatenate(owner)
            weight = np.concatenate([n for _, n in held])
            np.add.at(total, own, network.logits(rows) * weight[:, None])

        share = np.ones(len(texts))
        for i, text in enumerate(texts):
            if text is None:
                continue
            rows, n = windows(text)
            held.append((rows, n)), owner.append(np.full(len(rows), i))
            share[i] = n.sum()
            size += len(rows)
            if size >= 8 * SLAB:
                flush()
                held, owner, size = [], [], 0
        if held:
            flush()
        chance = softmax(total / share[:, None])
        best = chance.argmax(axis=1)
        none = [t is None for t in texts]
        return [UNKNOWN if x else network.languages[b] for x, b in zip(none, best, strict=True)], [0.0 if x else float(c) for x, c in zip(none, chance.max(axis=1), strict=True)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            langs, scores = named(texts) if network and texts else ([UNKNOWN] * len(texts), [0.0] * len(texts))
            own = [batch.column(f"c{i}") for i in range(len(fields))]
            yield pa.RecordBatch.from_arrays([*own, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], schema.names)

    return inner.mapInArrow(work, schema).select(*[F.col(f"c{i}").alias(f.name) for i, f in enumerate(fields)], "lang_pred", "score")


@query()
def op12_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    network = learn(docs.where(remainder != 1))
    held = F.coalesce(remainder == 1, F.lit(False))
    return predict(docs.select("doc_id", "text", held.alias("held_out")), network, carry=("held_out",))
