"""Language-model scores by Katz backoff.

Counts of n-grams of all orders are taken over the whole training part of the corpus. Small
counts are discounted after Good and Turing; what that frees is given to words not seen in a
context, in proportion to the next shorter context, with a backoff weight that makes each
context's chances sum to one exactly. Unknown words are one class, which gets what the
unigrams free. Where a context has nothing to free, its seen words leave 1 / (2 * (n + 1)).

Counts and context sums are tables in the shared folder, partitioned by chunk and bucket (see
exchange.py): a chunk of documents sends its distinct n-grams and gets their corpus counts,
then sends what its contexts' first-seen n-grams add up to and gets the contexts' sums. The
first chunk of a bucket that sent an n-gram counts it for its context, so each is counted
once. A token's chance is evaluated from the longest context down.

Names travel with all their 64 bits (see exchange.close): an n-gram of a corpus with N distinct
ones shares its count with another by a chance of N / 2**64, which is 1e-9 at N = 2e10.

Defined results: null text is empty and has the end token alone; rows of a null id are training rows;
rows of equal id are rows; without training rows all chances are those of the unknown class.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floodmark.llm import exchange as X
from floodmark.llm.base import keep, query, table
from floodmark.llm.words import U64, encoded, mix, named

#: Counts up to this one are discounted.
DISCOUNTED = 5
#: Characters of a chunk: a larger one sends fewer n-grams twice.
CHUNK_CHARS = 16 << 20
_START, _END = U64(0x243F6A8885A308D3), U64(0x13198A2E03707344)

ANSWERS = "chunk int, bucket int, answer binary, stats array<long>"


def discounts(seen: np.ndarray) -> np.ndarray:
    """Factors of the counts 1 to DISCOUNTED; ``seen[r]`` n-grams occur r times."""
    k, out = DISCOUNTED, np.ones(DISCOUNTED + 1)
    common = (k + 1) * seen[k + 1] / seen[1] if seen[1] else 1.0
    for r in range(1, k + 1):
        turing = (r + 1) * seen[r + 1] / seen[r] / r if seen[r] else 1.0
        factor = (turing - common) / (1 - common) if common != 1 else 0.0
        # Where the counts of counts give no factor between 0 and 1: half an occurrence less.
        out[r] = factor if 0 < factor < 1 else 1 - 0.5 / r
    return out


def shares(total: np.ndarray, few: np.ndarray, factors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What a discounted occurrence counts, and what is left for unseen words, per context.

    ``few[:, r - 1]`` of the context's n-grams occur r times, ``total`` are all occurrences.
    """
    size = np.maximum(total, 1)
    r = np.arange(1, DISCOUNTED + 1)
    mass = (total - few @ ((1 - factors[1:]) * r)) / size
    least = 1 / (2 * (size + 1))
    scale = np.where(1 - mass < least, (1 - least) / np.maximum(mass, 1e-300), 1.0)
    return np.where(total > 0, scale / size, 0.0), np.where(total > 0, 1 - mass * scale, 1.0)


class Chunk:
    """A chunk's tokens and its distinct n-grams by order."""

    def __init__(self, rows: pa.Table, order: int):
        texts = [encoded(t).lower() for t in rows["text"].to_pylist()]
        parts, since, size = [], 0, 0
        for i, t in enumerate(texts):
            size += len(t)
            if size >= 2 << 20 or i + 1 == len(texts):
                parts.append(named(texts[since : i + 1]))
                since, size = i + 1, 0
        words = np.concatenate([n for n, _ in parts])
        self.n = np.concatenate([np.diff(b) for _, b in parts]) + 1
        del texts, parts
        ends = np.cumsum(self.n) - 1
        tokens = np.empty(len(words) + len(self.n), U64)
        is_end = np.zeros(len(tokens), bool)
        is_end[ends] = True
        tokens[is_end], tokens[~is_end] = _END, words
        self.doc = np.repeat(np.arange(len(self.n)), self.n)
        self.train = ~np.repeat(rows["held"].to_numpy(zero_copy_only=False).astype(bool), self.n)
        place = np.arange(len(tokens)) - np.repeat(ends + 1 - self.n, self.n)
        self.names, self.inverse, self.counts = [], [], []
        context = np.full(len(tokens), _START)
        self.contexts = []
        for k in range(order):
            if k:  # the word k places back, or the start, goes in front of the context
                back = np.where(place >= k, np.roll(tokens, k), _START)
                context = back if k == 1 else mix(context * U64(0x9E3779B97F4A7C15) + back)
                self.contexts.append(mix(context))
            gram = mix(tokens) if not k else mix(mix(context) * U64(0xD1B54A32D192ED03) + tokens)
            names, inverse, counts = grouped(gram, self.train)
            self.names.append(names), self.inverse.append(inverse), self.counts.append(counts)


def grouped(values: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values, the place of each value among them, and sums of weights."""
    order = np.argsort(values)
    ordered = values[order]
    new = np.ones(len(values), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    group = np.cumsum(new) - 1
    inverse = np.empty(len(values), np.int32)
    inverse[order] = group
    return ordered[new], inverse, np.bincount(group, weights=weights[order], minlength=int(new.sum()))


def add_up(rows: pd.DataFrame) -> pd.DataFrame:
    """Corpus counts of a bucket's n-grams for each block, who counts them, and counts of counts."""
    rows = rows.sort_values("chunk", ignore_index=True)
    parts = [X.open_up(x) for x in rows["names"]]
    sizes = [len(p) for p in parts]
    counts = np.concatenate([X.widen(x) for x in rows["extra"]])
    order = np.argsort(np.concatenate(parts), kind="stable")  # earlier chunks first
    name = np.concatenate(parts)[order]
    new = np.ones(len(name), bool)
    new[1:] = name[1:] != name[:-1]
    group = np.cumsum(new) - 1
    total = np.bincount(group, weights=counts[order]).astype(np.int64)
    back, first = np.empty(len(name), np.int64), np.zeros(len(name), bool)
    back[order], first[order] = total[group], new
    first &= back > 0
    answers = [X.narrow(t) + np.packbits(f).tobytes() for t, f in zip(X.cut_up(back, sizes), X.cut_up(first, sizes), strict=True)]
    out = pd.DataFrame({"chunk": rows["chunk"], "bucket": rows["bucket"], "answer": answers, "stats": None})
    few = np.bincount(total[total <= DISCOUNTED + 1], minlength=DISCOUNTED + 2)
    stats = [int(total.sum()), int((total > 0).sum()), *few[1:].tolist()]
    return pd.concat([out, pd.DataFrame({"chunk": [-1], "bucket": [rows["bucket"].iloc[0]], "answer": [None], "stats": [stats]})], ignore_index=True)


def counted(answers: list[bytes], sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(corpus count, counted here) of a chunk's n-grams."""
    totals, firsts = [], []
    for data, n in zip(answers, sizes, strict=True):
        width = data[0]
        totals.append(np.frombuffer(data, f"<u{width}", offset=1, count=n).astype(np.int64))
        firsts.append(np.unpackbits(np.frombuffer(data, np.uint8, offset=1 + n * width), count=n).astype(bool))
    return np.concatenate(totals), np.concatenate(firsts)


def written(total: np.ndarray, few: np.ndarray, lower: np.ndarray) -> bytes:
    """Context sums: occurrences, n-grams by small counts, chances in the shorter context."""
    return b"".join([X.narrow(total), *(X.narrow(few[:, r]) for r in range(DISCOUNTED)), lower.astype("<f8").tobytes()])


def read(data: bytes, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at, columns = 0, []
    for _ in range(DISCOUNTED + 1):
        width = data[at]
        columns.append(np.frombuffer(data, f"<u{width}", offset=at + 1, count=n).astype(np.int64))
        at += 1 + n * width
    return columns[0], np.stack(columns[1:], axis=1), np.frombuffer(data, "<f8", offset=at, count=n)


def add_up_contexts(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("chunk", ignore_index=True)
    parts = [X.open_up(x) for x in rows["names"]]
    sizes = [len(p) for p in parts]
    sums = [read(x, n) for x, n in zip(rows["extra"], sizes, strict=True)]
    _, group = np.unique(np.concatenate(parts), return_inverse=True)
    add = lambda values: np.bincount(group, weights=values)[group]
    total = add(np.concatenate([s[0] for s in sums])).astype(np.int64)
    few_in = np.concatenate([s[1] for s in sums])
    few = np.stack([add(few_in[:, r]) for r in range(DISCOUNTED)], axis=1).astype(np.int64)
    lower = add(np.concatenate([s[2] for s in sums]))
    edge = np.cumsum([0, *sizes])
    answers = [written(total[a:b], few[a:b], lower[a:b]) for a, b in zip(edge[:-1], edge[1:], strict=True)]
    return pd.DataFrame({"chunk": rows["chunk"], "bucket": rows["bucket"], "answer": answers, "stats": None})


class Model:
    """Chances of a chunk's tokens by what the corpus has answered so far."""

    def __init__(self, chunk: Chunk, right: pd.DataFrame, stats: np.ndarray, chunks: int):
        self.chunk, self.stats = chunk, stats
        by_kind = {k: part.sort_values("bucket") for k, part in right.groupby(right["bucket"] // chunks)}
        self.grams = []
        for k, names in enumerate(chunk.names):
            self.grams.append(counted(list(by_kind[k]["answer"]), [b - a for _, a, b in X.slices(names, chunks)]))
        self.sums = []
        for k in range(len(chunk.contexts)):
            if len(chunk.names) + k not in by_kind:
                break
            names, inverse, _ = grouped(chunk.contexts[k], chunk.train)
            got = [read(x, b - a) for x, (_, a, b) in zip(by_kind[len(chunk.names) + k]["answer"], X.slices(names, chunks), strict=True)]
            self.sums.append((inverse, *(np.concatenate([g[i] for g in got]) for i in range(3))))

    def log_chances(self, order: int) -> np.ndarray:
        """log10 P of each token given up to ``order`` - 1 tokens before it."""
        factors = discounts(self.stats[order - 1, 1:])
        count = self.grams[order - 1][0][self.chunk.inverse[order - 1]]
        factor = factors[np.minimum(count, DISCOUNTED + 1) % (DISCOUNTED + 1)]
        if order == 1:
            total, few = self.stats[0, :1], self.stats[0, None, 2 : 2 + DISCOUNTED]
            each, left = shares(total, few, factors)
            return np.log10(np.where(count > 0, each[0] * factor * count, left[0]))
        inverse, total, few, lower = self.sums[order - 2]
        each, left = shares(total, few, factors)
        weight = left / np.where(total > 0, np.maximum(1 - lower, 1e-300), 1.0)
        with np.errstate(divide="ignore"):
            seen, backoff = np.log10(each[inverse] * factor * count), np.log10(weight)[inverse]
        return np.where(count > 0, seen, backoff + self.log_chances(order - 1))


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = 2) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 of the text's chance)."""
    chunks = X.chunk_count(docs, text_col, CHUNK_CHARS)
    key = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")
    held = F.col(f"`{id_col}`").isNotNull() & (F.crc32(key) % 7 == 2)
    columns = ["id", "held", "text"]
    packed = X.pack(docs.select(F.col(f"`{id_col}`").alias("id"), held.alias("held"), F.col(f"`{text_col}`").alias("text")), columns, chunks, spread=False)

    def kind_blocks(chunk: int, kind: int, names: np.ndarray, extra) -> pd.DataFrame:
        out = X.blocks(chunk, chunks, names, extra, width=None)
        return out.assign(bucket=out["bucket"] + kind * chunks)

    def send_grams(chunk: int, blobs) -> pd.DataFrame:
        own = Chunk(X.unpacked(blobs, columns), order)
        sent = [kind_blocks(chunk, k, n, lambda a, b, c=c: X.narrow(c[a:b].astype(np.int64))) for k, (n, c) in enumerate(zip(own.names, own.counts, strict=True))]
        return pd.concat(sent, ignore_index=True)

    sent = X.over_chunks(packed, send_grams, X.BLOCKS)
    known = keep(sent.groupBy("bucket").applyInPandas(add_up, ANSWERS), "ngrams")
    kind = F.floor(F.col("bucket") / chunks).cast("int").alias("kind")
    sums = known.where("chunk = -1").select(kind, F.posexplode("stats")).groupBy("kind", "pos").agg(F.sum("col").alias("n")).collect()
    stats = np.zeros((order, DISCOUNTED + 3), np.int64)  # occurrences, distinct, seen once, twice, ...
    for r in sums:
        stats[r.kind, r.pos] = r.n
    known = known.where("chunk >= 0").select("chunk", "bucket", "answer")

    for level in range(2, order + 1):

        def send_contexts(chunk: int, blobs, right: pd.DataFrame, level=level) -> pd.DataFrame:
            own = Chunk(X.unpacked(blobs, columns), order)
            model = Model(own, right, stats, chunks)
            names, context, _ = grouped(own.contexts[level - 2], own.train)
            total, first = model.grams[level - 1]
            # One token of each n-gram stands for it.
            token = np.empty(len(own.names[level - 1]), np.int64)
            token[own.inverse[level - 1]] = np.arange(len(own.doc))
            mine = np.flatnonzero(first)
            at, count = context[token[mine]], total[mine]
            chance = 10 ** model.log_chances(level - 1)[token[mine]]
            few = np.stack([np.bincount(at[count == r], minlength=len(names)) for r in range(1, DISCOUNTED + 1)], axis=1)
            all_ = np.bincount(at, weights=count, minlength=len(names)).astype(np.int64)
            lower = np.bincount(at, weights=chance, minlength=len(names))
            return kind_blocks(chunk, order + level - 2, names, lambda a, b: written(all_[a:b], few[a:b], lower[a:b]))

        sent = X.over_chunks(packed, send_contexts, X.BLOCKS, known)
        contexts = keep(sent.groupBy("bucket").applyInPandas(add_up_contexts, ANSWERS), "contexts")
        known = known.unionByName(contexts.select("chunk", "bucket", "answer"))

    fields = [("held_out", T.BooleanType()), ("n_tokens", T.LongType()), ("n_known", T.LongType()), ("train_tokens", T.LongType()), ("base_score", T.DoubleType()), ("score", T.DoubleType())]
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *(T.StructField(n, t) for n, t in fields)])
    occurrences, distinct = int(stats[0, 0]), int(stats[0, 1])

    def finish(chunk: int, blobs, right: pd.DataFrame) -> pd.DataFrame:
        rows = X.unpacked(blobs, columns)
        own = Chunk(rows, order)
        model = Model(own, right, stats, chunks)
        count = model.grams[0][0][own.inverse[0]]
        base = np.log10((count + 1) / (occurrences + distinct + 1))
        per_doc = lambda values: np.bincount(own.doc, weights=values, minlength=len(own.n))
        return pd.DataFrame(
            {
                "id": X.to_pandas(rows.select(["id"]))["id"],
                "held_out": rows["held"].to_pandas().astype(bool),
                "n_tokens": own.n,
                "n_known": per_doc(count > 0).astype(np.int64),
                "train_tokens": occurrences,
                "base_score": per_doc(base),
                "score": per_doc(model.log_chances(order)),
            }
        )

    return X.over_chunks(packed, finish, schema, known).withColumnRenamed("id", id_col)


@query()
def op6_katz_scores(spark: SparkSession, sf: str) -> DataFrame:
    return score(table(spark, sf, "documents"), order=2)
