"""Runs of words: stretches that repeat with a period, by a suffix automaton with link-cut access.

The words of a text enter a suffix automaton one by one. Its suffix links form a tree whose
path from a prefix's state up to the root are the suffixes of that prefix; a link-cut tree
keeps this tree as paths of one colour each, a path's colour being the word at which its
suffixes ended last. Appending word r walks up from the new state: every path segment it meets
names a previous end l and the longest suffix (``length``) that ended there. If the distance
r - l is at most that length, the last 2 * (r - l) words are a square, and the words that fit
it form a stretch of length + r - l words with the smallest period r - l, which nothing
extends to the left. Where the next word does not go on with the period, the stretch is a run.
Then the whole path takes the colour r. Segments change colour O(log n) times a word, amortised.

Only stretches that can hold a run enter an automaton: inside a run of length L and period q the
word groups of L - q >= ceil(least / 2) words stand q words earlier as well, so a run lies
around consecutive word groups that have occurred before, no further away than that stretch is
long. Hashes of the groups pick these zones; runs themselves are found on the words.

Defined results: null text has no words and no runs; a text is judged alone, so repeated rows
and ids give a row each, with equal results; a text of any length is one automaton, of some
60 bytes for each word of a zone. An empty table gives no rows.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floodmark.llm.base import query, table
from floodmark.llm.words import U64, mix, split

#: Words of a run, at least, and periods that it must hold.
LEAST, PERIODS = 12, 2
#: Characters of results that are handed over at a time, about.
SLAB = 2 << 20

RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")]), False)


class Automaton:
    """Suffix automaton whose link tree is a link-cut tree; node 0 is none, node 1 the root.

    Most states have one transition, kept in two arrays; further ones are in ``more``.
    """

    def __init__(self, n: int):
        def numbers() -> array:
            return array("i", bytes(4 * (2 * n + 3)))

        self.link, self.length, self.word, self.to = numbers(), numbers(), numbers(), numbers()
        self.left, self.right, self.up, self.colour = numbers(), numbers(), numbers(), numbers()
        self.more: dict[int, dict[int, int]] = {}
        self.size, self.last = 2, 1

    def step(self, state: int, word: int) -> int:
        if self.word[state] == word and self.to[state]:
            return self.to[state]
        further = self.more.get(state)
        return further.get(word, 0) if further else 0

    def lead(self, state: int, word: int, to: int) -> None:
        if not self.to[state] or self.word[state] == word:
            self.word[state], self.to[state] = word, to
        else:
            self.more.setdefault(state, {})[word] = to

    def append(self, word: int) -> int:
        """The state of the longest prefix with ``word`` added; the link tree follows."""
        link, length, first, to, more = self.link, self.length, self.word, self.to, self.more
        new, p = self.size, self.last
        self.size += 1
        length[new] = length[p] + 1
        q = 0
        while p:
            if not to[p]:
                first[p], to[p] = word, new
            elif first[p] == word:
                q = to[p]
                break
            else:
                further = more.get(p)
                if further is None:
                    more[p] = {word: new}
                elif word in further:
                    q = further[word]
                    break
                else:
                    further[word] = new
            p = link[p]
        if not q:
            above = 1
        elif length[q] == length[p] + 1:
            above = q
        else:
            above = self.size
            self.size += 1
            length[above] = length[p] + 1
            first[above], to[above] = first[q], to[q]
            if q in more:
                more[above] = dict(more[q])
            while p and self.step(p, word) == q:
                self.lead(p, word, above)
                p = link[p]
            self.insert_above(q, above)
            link[above] = link[q]
            link[q] = above
        link[new] = above
        self.up[new] = above
        self.last = new
        return new

    def insert_above(self, node: int, new: int) -> None:
        """Put a state between a state and its parent, in the path and the colour of the state."""
        self.splay(node)
        shallower = self.left[node]
        self.left[new] = shallower
        if shallower:
            self.up[shallower] = new
        self.left[node], self.up[new] = new, node

    def splay(self, x: int) -> None:
        """Make a node the root of its path's splay tree, which holds the path's colour."""
        left, right, up = self.left, self.right, self.up
        top = 0
        while True:
            y = up[x]
            if left[y] != x and right[y] != x:
                break
            z = up[y]
            inside = left[z] == y or right[z] == y
            if inside:
                top, turns = z, (y, x) if (left[z] == y) == (left[y] == x) else (x, x)
            else:
                top, turns = y, (x,)
            for a in turns:
                b = up[a]
                c = up[b]
                if left[b] == a:
                    d = right[a]
                    left[b], right[a] = d, b
                else:
                    d = left[a]
                    right[b], left[a] = d, b
                if d:
                    up[d] = b
                up[b], up[a] = a, c
                if left[c] == b:
                    left[c] = a
                elif right[c] == b:
                    right[c] = a
        if top:
            self.colour[x] = self.colour[top]

    def access(self, node: int, end: int) -> list[tuple[int, int]]:
        """(previous end, longest suffix) of the path's segments; all of them get the colour ``end``."""
        right, up, colour, length = self.right, self.up, self.colour, self.length
        out, below, x = [], 0, node
        while x:
            self.splay(x)
            before = colour[x]
            deeper = right[x]
            if deeper:
                colour[deeper] = before
            right[x] = below
            if before:
                out.append((before, length[x]))
            below, x = x, up[x]
        colour[below] = end
        return out


def runs_in(words: list[int], least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence, by start, then period."""
    automaton, n, out = Automaton(len(words)), len(words), []
    for at, word in enumerate(words):
        end = at + 1  # colours count from 1
        for before, length in automaton.access(automaton.append(word), end):
            period = end - before
            if period <= length and length + period >= least and (end == n or words[end] != words[end - period]):
                out.append((end - length - period, length + period, period))
    out.sort(key=lambda r: (r[0], r[2]))
    return out


def zones(words: np.ndarray, least: int = LEAST) -> list[tuple[int, int]]:
    """(start, end) of stretches outside of which no run has a word; no run reaches over two of them."""
    group = -(-least // 2)
    m = len(words) - group + 1
    if m < 2:
        return []
    with np.errstate(over="ignore"):
        x = mix(words.astype(U64) + U64(1))
        name = np.zeros(m, U64)
        for k in range(group):
            name = name * U64(0x9E3779B97F4A7C15) + x[k : k + m]
    order = np.argsort(name, kind="stable")
    again = name[order[1:]] == name[order[:-1]]
    if not again.any():
        return []
    back = np.zeros(m, np.int64)  # distance to the last equal group before; 0: none
    back[order[1:][again]] = (order[1:] - order[:-1])[again]
    while True:
        met = np.flatnonzero(np.diff(back > 0, prepend=False, append=False))
        starts, ends = met[::2], met[1::2]
        far = np.repeat(ends - starts + group - 1, ends - starts)
        inside = np.flatnonzero(back > 0)
        drop = inside[back[inside] > far]
        if not len(drop):
            break
        back[drop] = 0
    out: list[tuple[int, int]] = []
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        a, b = max(0, a - (b - a + group - 1)), b + group - 1
        if out and a <= out[-1][1]:
            a, b = min(a, out[-1][0]), max(b, out.pop()[1])
            while out and a <= out[-1][1]:
                a = min(a, out.pop()[0])
        out.append((a, b))
    return out


def runs_of(words: list[bytes], least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a text's words."""
    if len(words) < least:
        return []
    known: dict[bytes, int] = {}
    numbers = [known.setdefault(w, len(known)) for w in words]
    out = []
    for a, b in zones(np.array(numbers, np.int64), least):
        out += [(a + start, length, period) for start, length, period in runs_in(numbers[a:b], least)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    step = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        step[start + period] += 1
        step[start + length] -= 1
    gone = np.cumsum(step[:-1]) > 0
    return [w for w, drop in zip(words, gone.tolist(), strict=True) if not drop]


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """id, n_words, runs (start, length, period; by start, then period), collapsed_text of each whole text."""

    def some(ids: list, found: list[tuple]) -> pa.RecordBatch:
        lists = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs] for _, runs, _ in found]
        kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
        columns = [pa.concat_arrays(ids), pa.array([n for n, _, _ in found], pa.int64()), pa.array(lists, kind), pa.array([t for _, _, t in found], pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["id", "n_words", "runs", "collapsed_text"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, since, size = [], 0, 0
            for i, value in enumerate(batch.column("text")):
                words = split(value.as_py())
                runs = runs_of(words, least)
                text = b" ".join(collapsed(words, runs))
                held.append((len(words), runs, text))
                size += len(text)
                if size >= SLAB or i + 1 == batch.num_rows:
                    yield some([batch.column("id").slice(since, i + 1 - since)], held)
                    held, since, size = [], i + 1, 0

    inner = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS), T.StructField("collapsed_text", T.StringType())])
    return inner.mapInArrow(work, schema).withColumnRenamed("id", id_col)


def periodic(text: str, number: Column) -> Column:
    """The text whose words from a on repeat with a period, for every tenth number (words joined by a space)."""
    g = F.floor(number / 10)

    def bound(value: Column, use) -> Column:
        """use(value), with the value worked out once."""
        return F.get(F.transform(F.array(value), use), F.lit(0))

    def repeated(words: Column) -> Column:
        n = F.size(words)

        def joined(shape: Column) -> Column:
            a, p = shape["a"], shape["p"]
            return F.array_join(F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, a + (i - a) % p))), " ")

        start = (g % n).cast("int")
        shape = F.struct(start.alias("a"), (1 + F.floor((n - start) / (3 + g % 8))).cast("int").alias("p"))
        return F.when(n > 0, bound(shape, joined)).otherwise(F.lit(""))

    words = F.filter(F.split(F.col(text), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    return F.when(number % 10 == 0, bound(words, repeated)).otherwise(F.col(text))


@query()
def op11_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    found = find_runs(docs.select("doc_id", periodic("text", number).alias("text")), least=LEAST)
    longest = F.array_sort(F.col("runs"), lambda a, b: F.when(a["length"] != b["length"], F.signum(b["length"] - a["length"])).when(a["start"] != b["start"], F.signum(a["start"] - b["start"])).otherwise(F.signum(a["period"] - b["period"])).cast("int"))
    best = F.get(longest, F.lit(0))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit(""))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed_text", 256).alias("collapsed_sha256"),
    )
