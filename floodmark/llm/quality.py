"""Quality classifier: a weak-label model over heuristics, and a hashed linear scorer.

Labellers vote on every document or hold back: against it for its share of signs, of capitals,
of repeated words or lines, or for words that labelled toxic documents have and others have
not; for it where nothing is odd; and as the given labels of a sample say. All documents are counted by their votes (a bounded number
of patterns); expectation-maximisation over these counts estimates what each labeller's votes
say about good and bad documents. The posteriors of a bounded sample of ``FIT_ROWS`` documents
(labelled ones where there are labels) train a logistic scorer over hashed words, word heads
and binned shares. It scores every document whole; those it takes for bad are rejected.

Labels are read by id: a document with any label of quality 0 or toxic 1 counts as bad.
Defined results: text without words (null, empty, signs only) scores 1 and is rejected; rows of equal
id and text score alike; labels without documents or with null ids are ignored; without
labels of documents at hand the sample are documents by a hash of their id; texts of any length
are scored whole, some at a time; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floodmark.llm.base import keep, query, table
from floodmark.llm.words import U64, mix, named

#: Rows that the word list and the scorer are fitted on, at most.
FIT_ROWS = 12_000
#: Words of the list, at most, and documents that must have a word.
LIST_WORDS, LIST_SEEN = 4000, 5
HASH_BITS = 18
HEAD_BYTES = 6
ROUNDS_EM, EPOCHS = 40, 6
#: P(bad) from which a document is rejected.
REJECT = 0.6
#: Chance that a given label is right.
TRUST = 0.98
SLAB = 1 << 20

# Bytes of words: digits, letters and everything beyond ASCII.
_GAPS = np.ones(256, bool)
_GAPS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_LINES = np.zeros(256, bool)
_LINES[0x0A] = True
_UPPER = np.zeros(256, np.int64)
_UPPER[0x41:0x5B] = 1
_LETTER = np.zeros(256, np.int64)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
_SIGN = np.zeros(256, np.int64)
_SIGN[[b for b in range(0x21, 0x7F) if _GAPS[b]]] = 1

SHARES = ("signs", "capitals", "same_again", "repeated_words", "repeated_lines", "word_length")
#: A share from the second bound on speaks against a document; one that is up to the first
#: bound everywhere, with no listed word, is plain and speaks for it.
BOUNDS = {
    "signs": (0.06, 0.095),
    "capitals": (0.06, 0.4),
    "same_again": (0.03, 0.1),
    "repeated_words": (0.5, 0.65),
    "repeated_lines": (0.2, 0.4),
}
#: Characters below which shares of signs and capitals say nothing.
LEAST_CHARS = 40
LABELLERS = (*BOUNDS, "listed", "plain", "given")
GOOD, BAD, NONE = 0, 1, 2
#: What a vote counts in the number of a pattern.
PLACES = 3 ** np.arange(len(LABELLERS))
#: Documents of the sample that must have a hashed feature.
LEAST_SEEN = 5
BINS = 8
SIZE = (1 << HASH_BITS) + len(SHARES) * BINS + len(LABELLERS)


def _per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]


class Slab:
    """Features of some whole texts."""

    def __init__(self, texts: list[str | None]):
        plain = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
        lower = [b"" if t is None else t.lower().encode("utf-8", "surrogatepass") for t in texts]
        self.names, first = named(lower, _GAPS)
        heads, _ = named(lower, _GAPS, head=HEAD_BYTES)
        self.n_words = np.diff(first)
        self.first = first
        self.text = np.repeat(np.arange(len(texts)), self.n_words)
        data = np.frombuffer(b"".join(plain), np.uint8)
        edge = np.cumsum([0, *(len(t) for t in plain)])
        letters, signs = _per_text(_LETTER[data], edge), _per_text(_SIGN[data], edge)
        self.chars = letters + signs
        same = np.zeros(len(self.names), np.int64)
        same[1:] = (self.names[1:] == self.names[:-1]) & (self.text[1:] == self.text[:-1])
        lines, at = named(plain, _LINES, joiner=b"\n")
        line_text = np.repeat(np.arange(len(texts)), np.diff(at))
        words = np.maximum(self.n_words, 1)
        self.shares = {
            "signs": signs / np.maximum(signs + letters, 1),
            "capitals": _per_text(_UPPER[data], edge) / np.maximum(letters, 1),
            "same_again": _per_text(same, first) / words,
            "repeated_words": np.where(self.n_words >= 20, 1 - self._distinct(self.names, self.text, len(texts)) / words, 0.3),
            "repeated_lines": 1 - self._distinct(lines, line_text, len(texts)) / np.maximum(np.diff(at), 1),
            "word_length": np.minimum(letters / words / 16, 1),
        }
        self.heads = heads

    @staticmethod
    def _distinct(names: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
        order = np.lexsort((names, text))
        a, b = names[order], text[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        return np.bincount(b[new], minlength=n)

    def votes(self, listed: np.ndarray, given: np.ndarray) -> np.ndarray:
        """One column for each labeller."""
        n = len(self.n_words)
        out = np.full((n, len(LABELLERS)), NONE)
        plain = self.n_words > 0
        for k, (share, (low, high)) in enumerate(BOUNDS.items()):
            told = self.chars >= LEAST_CHARS if share in ("signs", "capitals") else np.ones(n, bool)
            out[told & (self.shares[share] >= high), k] = BAD
            plain &= ~told | (self.shares[share] <= low)
        if len(listed):
            at = np.minimum(np.searchsorted(listed, self.names), len(listed) - 1)
            hits = np.bincount(self.text[listed[at] == self.names], minlength=n)
            out[hits > 0, -3] = BAD
            plain &= hits == 0
        out[plain, -2] = GOOD
        out[:, -1] = given
        return out

    def features(self, votes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, index): distinct hashed words and heads, the bins of the shares, heuristic votes."""
        bits = U64(64 - HASH_BITS)
        index = np.concatenate([self.names >> bits, (self.heads * U64(0x9E3779B97F4A7C15)) >> bits]).astype(np.int64)
        pair = np.unique(np.concatenate([self.text, self.text]) * (1 << HASH_BITS) + index)
        text, index = [pair >> HASH_BITS], [pair & ((1 << HASH_BITS) - 1)]
        for k, share in enumerate(SHARES):
            text.append(np.arange(len(self.n_words)))
            index.append((1 << HASH_BITS) + k * BINS + np.minimum(self.shares[share] * BINS, BINS - 1).astype(np.int64))
        for k in range(len(LABELLERS) - 1):
            text.append(np.flatnonzero(votes[:, k] != NONE))
            index.append(np.full(len(text[-1]), SIZE - len(LABELLERS) + k))
        text.append(np.arange(len(self.n_words)))
        index.append(np.full(len(self.n_words), SIZE - 1))  # the constant
        return np.concatenate(text), np.concatenate(index)


def slabs(batch: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, Slab]]:
    since, size = 0, 0
    texts = batch["text"].tolist()
    for i, text in enumerate(texts):
        size += 0 if text is None else len(text)
        if size >= SLAB or i + 1 == len(texts):
            yield batch.iloc[since : i + 1], Slab(texts[since : i + 1])
            since, size = i + 1, 0


def estimate(patterns: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """P(bad) of each vote pattern: expectation-maximisation over the patterns' counts.

    A labeller that votes is right with its accuracy, whatever the others say; no vote says
    nothing. Its accuracy is how often it agrees with what the others' votes let expect,
    where others vote too (its own vote would only confirm itself); one pseudo-vote right and
    one wrong, and it beats chance. Given labels are right with the chance ``TRUST``: that ties classes to meaning.
    """
    sign = np.where(patterns == BAD, 1.0, np.where(patterns == GOOD, -1.0, 0.0))
    accuracy = np.full(patterns.shape[1], 0.8)
    accuracy[-1] = TRUST
    bad = np.full(len(patterns), 0.5)
    # The classes' shares follow from given labels, where there are any: a sample by hash.
    known = patterns[:, -1] != NONE
    known = known if known.any() else np.ones(len(patterns), bool)
    for _ in range(ROUNDS_EM):
        weight = sign * np.log(accuracy / (1 - accuracy))
        share = np.clip((bad[known] @ counts[known] + 1) / (counts[known].sum() + 2), 0.1, 0.9)
        log = np.log(share / (1 - share)) + weight.sum(axis=1)
        for k in range(patterns.shape[1] - 1):
            both = (sign[:, k] != 0) & ((sign != 0).sum(axis=1) > 1)
            others = 1 / (1 + np.exp(-np.clip(log[both] - weight[both, k], -50, 50)))
            right = np.where(sign[both, k] > 0, others, 1 - others) @ counts[both]
            accuracy[k] = np.clip((right + 1) / (counts[both].sum() + 2), 0.55, 0.99)
        bad = 1 / (1 + np.exp(-np.clip(log, -50, 50)))
    return bad


def scores(text: np.ndarray, index: np.ndarray, weights: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of weights per text, and what each feature counts: words share a text's length out."""
    hashed = index < 1 << HASH_BITS
    many = np.bincount(text[hashed], minlength=n)
    value = np.where(hashed, 1 / np.sqrt(np.maximum(many, 1))[text], 1.0)
    return np.bincount(text, weights=weights[index] * value, minlength=n), value


def train(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Weights of a logistic scorer; ``rows`` are feature indices. Adagrad over small batches.

    Features that few rows have say nothing about other documents and keep a weight of 0.
    """
    weights, squares = np.zeros(SIZE), np.full(SIZE, 1e-2)
    seen = np.bincount(np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64), minlength=SIZE) >= min(LEAST_SEEN, len(rows))
    weightless = ~seen
    rng = np.random.default_rng(11)
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for k in range(0, len(order), 64):
            part = [rows[i] for i in order[k : k + 64]]
            index, text = np.concatenate(part), np.repeat(np.arange(len(part)), [len(p) for p in part])
            score, value = scores(text, index, weights, len(part))
            error = 1 / (1 + np.exp(-np.clip(score, -30, 30))) - labels[order[k : k + 64]]
            touched, where = np.unique(index, return_inverse=True)
            slope = np.bincount(where, weights=error[text] * value) + 1e-4 * weights[touched]
            squares[touched] += slope**2
            weights[touched] -= 0.2 * slope / np.sqrt(squares[touched])
            weights[weightless] = 0
    return weights


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_rows: int = FIT_ROWS) -> DataFrame:
    """All columns of ``docs`` as ``row``, with n_words, weak (posterior), score (P(bad)) and rejected."""
    ids = F.col(f"`{id_col}`").cast("long")
    bad = F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), F.lit(BAD)).otherwise(F.lit(GOOD))).alias("given")
    told = labels.where("doc_id is not null and (quality is not null or toxic is not null)")
    told = told.groupBy(F.col("doc_id").cast("long").alias("told_id")).agg(bad, F.max("toxic").alias("toxic"))
    # Only labels of documents that are there fill the sample: they may be a small part of the labelled ones.
    here = docs.select(ids.alias("told_id")).distinct()
    told = told.join(here, "told_id", "left_semi").orderBy(F.xxhash64("told_id"), "told_id").limit(fit_rows)
    sample = [(r.told_id, r.given, r.toxic or 0) for r in told.collect()]
    if not sample:
        some = docs.where(ids.isNotNull()).select(ids.alias("told_id")).distinct().orderBy(F.xxhash64("told_id"), "told_id").limit(fit_rows)
        sample = [(r.told_id, NONE, 0) for r in some.collect()]
    # At most ``fit_rows`` rows of three numbers.
    given = docs.sparkSession.createDataFrame(sample, "told_id long, given int, toxic int").coalesce(1)
    flat = docs.select(F.struct("*").alias("row"), ids.alias("told_id"), F.col(f"`{text_col}`").alias("text"))
    flat = flat.join(F.broadcast(given), "told_id", "left").fillna({"given": NONE})

    def sampled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for rows, slab in slabs(batch):
                names = np.split(slab.names, slab.first[1:-1])
                yield pd.DataFrame({"toxic": rows["toxic"].to_numpy(), "names": [np.unique(n).astype("<u8").tobytes() for n in names]})

    def fitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for rows, slab in slabs(batch):
                votes = slab.votes(listed, rows["given"].to_numpy())
                text, index = slab.features(votes)
                order = np.argsort(text, kind="stable")
                cut = np.cumsum(np.bincount(text, minlength=len(rows)))[:-1]
                features = [p.astype("<i4").tobytes() for p in np.split(index[order], cut)]
                yield pd.DataFrame({"features": features, "pattern": votes @ PLACES})

    # One row for each id of the sample: repeated rows of an id add nothing to a fit.
    one = keep(flat.where("toxic is not null").select("told_id", "text", "given", "toxic").dropDuplicates(["told_id"]), "sample")
    rows = one.mapInPandas(sampled, "toxic int, names binary").collect()
    listed = word_list([np.frombuffer(r.names, "<u8") for r in rows], np.array([r.toxic for r in rows], bool))
    rows = one.mapInPandas(fitted, "features binary, pattern long").collect()

    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, slab in slabs(batch):
                votes = slab.votes(listed, part["given"].to_numpy())
                kinds, n = np.unique(votes @ PLACES, return_counts=True)
                yield pd.DataFrame({"pattern": kinds, "n": n})

    counted = flat.select("text", "given").mapInPandas(vote, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n")).collect()
    keys = np.array([r.pattern for r in counted], np.int64)
    patterns = keys[:, None] // PLACES % 3
    posterior = dict(zip(keys.tolist(), estimate(patterns, np.array([r.n for r in counted], float)).tolist(), strict=True)) if counted else {}

    weights = train([np.frombuffer(r.features, "<i4") for r in rows], np.array([posterior[r.pattern] for r in rows])).astype(np.float32)

    @F.pandas_udf("n_words long, weak double, score double, rejected boolean")
    def scored(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, told in batches:
            done = [pd.DataFrame({"n_words": [], "weak": [], "score": [], "rejected": []}).astype({"n_words": "int64", "rejected": "bool"})]
            for part, slab in slabs(pd.DataFrame({"text": texts, "given": told})):
                votes = slab.votes(listed, part["given"].to_numpy())
                text, index = slab.features(votes)
                value, _ = scores(text, index, weights, len(part))
                value = np.where(slab.n_words > 0, 1 / (1 + np.exp(-np.clip(value, -30, 30))), 1.0)
                weak = [posterior[v] for v in (votes @ PLACES).tolist()]
                done.append(pd.DataFrame({"n_words": slab.n_words, "weak": weak, "score": value, "rejected": value >= REJECT}))
            yield pd.concat(done, ignore_index=True) if len(done) > 1 else done[0]

    # Only the text passes through Python; the other columns stay where they are.
    return flat.select("row", scored("text", "given").alias("found")).select("row", "found.*")


def word_list(names: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Words that many toxic documents of the sample have and hardly any other."""
    if not len(names) or not toxic.any() or toxic.all():
        return np.empty(0, U64)

    def count(which: bool) -> tuple[np.ndarray, np.ndarray]:
        mine = [n for n, t in zip(names, toxic, strict=True) if t == which]
        # Near copies mostly have the same smallest names: their words count once.
        keys = [hash(tuple(np.sort(mix(n))[:4].tolist())) & 0x7FFFFFFF for n in mine]
        word = np.concatenate(mine)
        key = np.repeat(np.array(keys, np.int64), [len(n) for n in mine])
        order = np.lexsort((key, word))
        word, key = word[order], key[order]
        new = np.ones(len(word), bool)
        new[1:] = (word[1:] != word[:-1]) | (key[1:] != key[:-1])
        return np.unique(word[new], return_counts=True)

    (word, n), (other, m) = count(True), count(False)
    at = np.minimum(np.searchsorted(other, word), max(len(other) - 1, 0))
    clean = np.where(other[at] == word, m[at], 0) if len(other) else np.zeros(len(word))
    ratio = (n / toxic.sum()) / ((clean + 0.2) / (~toxic).sum())
    good = (n >= LIST_SEEN) & (ratio >= 20)
    return np.sort(word[good][np.argsort(-n[good], kind="stable")[:LIST_WORDS]])


@query()
def op2_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    out = classify(docs, table(spark, sf, "labels"))
    return out.select("row.doc_id", "n_words", "weak", "score", (~F.col("rejected")).alias("kept"))
