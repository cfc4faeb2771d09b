"""Chat formatting: root-to-leaf paths of reply trees as conversations with a loss mask.

Messages form trees by their parents. Self-joins double the distance that a message can jump
up: after round k every message knows its ancestor 2**k steps up and the score in between.
Branches (leaves) are ranked by their path's mean score; the best of each tree are expanded
with the same tables, from the longest jump down, so exactly the rows of chosen paths arise
and a chain of any length takes a logarithm of rounds. A formatted conversation is one row,
as is its path when it is put together; all steps before work on single messages.

The template writes a turn as ``<s>[INST]role[/INST]text</s>``. A marker inside a role or a text
gets a backslash behind its first character, and one that has some gets one more; reading
takes one away. The mask are the code point ranges of the assistants' texts.

Defined results: null texts and roles are empty; a null conversation id is one conversation; rows of
equal turn are ordered by role and text, repeated rows stay; a message whose parent does not
exist starts a tree; messages on a cycle, or only reachable from one, are in no path.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from floodmark.llm.base import keep, query, table

# The template's markers (fixed values).
START, ROLE, TEXT, END = "<s>", "[INST]", "[/INST]", "</s>"
_MARKER = re.compile(r"([<\[])(\\*)(s>|/s>|INST\]|/INST\])")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(s>|/s>|INST\]|/INST\])")
_TURN = re.compile(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>", re.DOTALL)


def escape(text: str) -> str:
    return _MARKER.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def formatted(turns: list[tuple[str, str]], masked: str = "assistant") -> tuple[str, list[list[int]]]:
    """A conversation's text and the code point ranges under its loss mask."""
    out, mask, at = [], [], 0
    for role, text in turns:
        head, body = START + ROLE + escape(role) + TEXT, escape(text)
        if role == masked:
            mask.append([at + len(head), at + len(head) + len(body)])
        out += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(out), mask


def read_back(text: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    return [(unescape(role), unescape(body)) for role, body in _TURN.findall(text)]


def chained(messages: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(tree, node, parent, score, role, text): each row answers the row before it.

    Rows are sorted by ranges and numbered, so a conversation of any length is spread over
    tasks; only the first row of a range looks up where the range before ends.
    """
    rows = messages.select(
        F.col(f"`{conv}`").cast("long").alias("tree"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    rows = rows.orderBy("tree", "turn", "role", "text").withColumn("node", F.monotonically_increasing_id())
    rows = keep(rows, "turns")
    # The numbers' upper bits are the range: one row for each range goes through this window.
    ranges = rows.groupBy(F.shiftright("node", 33).alias("range")).agg(F.min("node").alias("node"), F.max("node").alias("last"))
    before = ranges.select("node", F.lag("last").over(Window.orderBy("node")).alias("before"))
    linked = rows.join(before, "node", "left").withColumn("before", F.coalesce("before", F.col("node") - 1))
    previous = rows.select(F.col("node").alias("before"), F.col("tree").alias("before_tree"), F.lit(True).alias("exists"))
    linked = linked.join(previous, "before", "left")
    # The very first row has none before it; its null must not pass for a null conversation.
    same = F.col("exists") & F.col("tree").eqNullSafe(F.col("before_tree"))
    return linked.select("tree", "node", F.when(same, F.col("before")).alias("parent"), F.lit(0.0).alias("score"), "role", "text")


def best_paths(messages: DataFrame, best: int = 1) -> DataFrame:
    """(tree, leaf, rank, node, above) of the ``best`` branches of each tree by mean score.

    ``messages`` has tree, node (unique), parent and score; ``above`` counts the steps up from the leaf.
    """
    nodes = messages.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    known = nodes.select(F.col("node").alias("parent"), F.lit(True).alias("known"))
    nodes = nodes.join(known, "parent", "left").select("tree", "node", F.when(F.col("known"), F.col("parent")).alias("parent"), "score")
    nodes = keep(nodes, "messages")
    n = nodes.count()
    # state: what lies between a message and the root as far as the jumps have come
    state = nodes.select("node", F.col("parent").alias("up"), F.col("score").alias("total"), F.lit(1).cast("long").alias("length"))
    state = keep(state, "jumps")
    jumps, done, going = [], state.where("up is null"), state.where("up is not null")
    # Only messages that have not reached their root are joined again.
    while (1 << len(jumps)) <= max(n, 1) and going.take(1):
        jumps.append(going.select("node", "up"))
        above = going.unionByName(done).select(
            F.col("node").alias("up"), F.col("up").alias("next"), F.col("total").alias("more"), F.col("length").alias("steps")
        )
        further = going.join(above, "up").select(
            "node", F.col("next").alias("up"), (F.col("total") + F.col("more")).alias("total"), (F.col("length") + F.col("steps")).alias("length")
        )
        further = keep(further, "jumps")
        done, going = done.unionByName(further.where("up is null")), further.where("up is not null")
    parents = nodes.where("parent is not null").select(F.col("parent").alias("node")).distinct()
    leaves = nodes.join(parents, "node", "left_anti").select("tree", F.col("node").alias("leaf"))
    rooted = done.select(F.col("node").alias("leaf"), (F.col("total") / F.col("length")).alias("mean"))
    # The limit on the rank also holds before the shuffle: a tree sends a few leaves per task.
    order = Window.partitionBy("tree").orderBy(F.desc("mean"), "leaf")
    path = leaves.join(rooted, "leaf").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    path = keep(path.select("tree", "leaf", "rank", F.col("leaf").alias("node"), F.lit(0).cast("long").alias("above")), "branches")
    for k in reversed(range(len(jumps))):
        step = F.array(F.struct("node", "above"), F.struct(F.col("up").alias("node"), (F.col("above") + (1 << k)).alias("above")))
        path = path.join(jumps[k], "node", "left").withColumn("to", F.explode(step)).where("to.node is not null")
        path = path.select("tree", "leaf", "rank", "to.*")
    return path


def format_paths(messages: DataFrame, best: int = 1) -> DataFrame:
    """(tree, leaf, rank, n_turns, text, mask): one row for each chosen path."""
    path = best_paths(messages, best).join(messages.select("node", "role", "text"), "node")
    turns = path.groupBy("tree", "leaf", "rank").agg(F.sort_array(F.collect_list(F.struct(-F.col("above"), "role", "text"))).alias("turns"))
    turns = turns.select("tree", "leaf", "rank", F.transform("turns", lambda t: F.struct(F.coalesce(t["role"], F.lit("")).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text"))).alias("turns"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Ids stay Arrow values: pandas would round large ones beside a null.
        for batch in batches:
            given = batch.column("turns").to_pylist()
            done = [formatted([(t["role"], t["text"]) for t in turns]) for turns in given]
            more = [pa.array([len(t) for t in given], pa.int64()), pa.array([x for x, _ in done], pa.string()), pa.array([m for _, m in done], pa.list_(pa.list_(pa.int64())))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *more], [*names, "n_turns", "text", "mask"])

    names = ["tree", "leaf", "rank"]
    kind = messages.schema["tree"].dataType.simpleString()
    return turns.mapInArrow(rows, f"tree {kind}, leaf long, rank int, n_turns long, text string, mask array<array<long>>")


@query()
def op1_chat_formatting(spark: SparkSession, sf: str) -> DataFrame:
    hard = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    out = format_paths(chained(rows, "conv_id", "turn", "role", "text"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, mask in zip(batch.column("text").to_pylist(), batch.column("mask").to_pylist(), strict=True):
                turns = read_back(text)
                told = sha256("".join(f"{role}\n{body}\n" for role, body in turns).encode("utf-8", "surrogatepass")).hexdigest()
                loss = "".join(unescape(text[a:b]) for a, b in mask)
                rows.append((len(turns), told, len(loss), sha256(loss.encode("utf-8", "surrogatepass")).hexdigest(), len(text)))
            cells = [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], t) for t in kinds]
            yield pa.RecordBatch.from_arrays([batch.column("tree"), *cells], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return out.mapInArrow(digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
