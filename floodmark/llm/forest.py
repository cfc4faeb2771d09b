"""Embedding near-dedup by a forest of random projection trees with spill overlap.

Only vectors of one label (and one dimension) are compared. A label that fits one leaf is
compared whole; a larger one is the root of ``TREES`` trees. Rounds split all nodes that are
too large at once: a bounded sample of a node's vectors gives thresholds for some levels of
random directions, then every vector of the node is routed, to both sides where it lies within
``SPILL`` of a threshold. A root's vectors are routed through all its trees in one pass, and what
comes out are numbers of leaves only; vectors meet them again when leaves are compared. A node
that splitting hardly shrinks (vectors closer than the overlap) is left as it is, whatever
the others do, and is compared in blocks, so a node of any size is work of bounded tasks.
Vectors that share a leaf are compared in double precision.

A linked pair is counted in the smallest leaf that both share, so counts need no list of
pairs: a task gives the number of links of each vector and a forest of its links. Equal
vectors of a label are one class with their number.

Defined results: rows with null labels or ids, and vectors that are null, empty, zero or hold null or
non-finite components link with nothing (a null id has a null component and is kept); rows
with equal ids are one node of the graph, but each is a vector of its own in the counts; an
empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floodmark.llm.base import keep, query, table
from floodmark.llm.components import components
from floodmark.llm.topk import valid

TREES = 8
#: Overlap to both sides of a threshold, on unit vectors.
SPILL = 0.02
#: Vectors of a leaf or block, sampled vectors that fit a node, levels of a round, most rounds.
LEAF, SAMPLE, LEVELS, ROUNDS = 2048, 4000, 4, 12
#: Vectors that are routed at a time, and the share of its parent above which a node counts as stuck.
ROUTED, STUCK = 20_000, 0.8
#: Random directions of which a split takes the best.
TRIED = 4


def units(vectors: pa.ChunkedArray) -> np.ndarray:
    """Unit vectors of lists of one length."""
    lists = vectors.combine_chunks()
    v = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)
    return v / np.sqrt((v * v).sum(axis=1))[:, None]


def fit(vectors: np.ndarray, seed: int, levels: int, n: int, spill: float, leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions and thresholds of a subtree in heap order, from a sample of a node's n vectors.

    Of some random directions that is taken, with its threshold, whose two sides have the fewest
    pairs together: a threshold in a tight group would send the group to both sides. A part
    that fits a leaf or hardly shrinks has an infinite threshold, so all of it stays on one side.
    """
    rng = np.random.default_rng(seed)
    size = (1 << levels) - 1
    directions, thresholds = np.zeros((size, vectors.shape[1])), np.full(size, np.inf)
    members = [np.arange(len(vectors))] + [np.empty(0, np.int64)] * (2 * size)
    for k in range(size):
        tried = rng.normal(size=(TRIED, vectors.shape[1]))
        tried /= np.sqrt((tried**2).sum(axis=1))[:, None]
        at = members[2 * k + 1] = members[k]
        if len(at) * n <= leaf * len(vectors):
            continue
        heights, best = vectors[at] @ tried.T, (np.inf,)
        for way in range(TRIED):
            height = np.sort(heights[:, way])
            cuts = np.linspace(*np.quantile(height, [0.05, 0.95]), 65)
            low, high = np.searchsorted(height, cuts + spill, "right"), len(at) - np.searchsorted(height, cuts - spill, "right")
            pairs = low.astype(np.float64) ** 2 + high.astype(np.float64) ** 2
            c = int(pairs.argmin())
            best = min(best, (pairs[c], way, cuts[c], max(low[c], high[c])))
        if best[3] > STUCK * len(at):
            continue
        directions[k], thresholds[k] = tried[best[1]], best[2]
        height = heights[:, best[1]] - best[2]
        members[2 * k + 1], members[2 * k + 2] = at[height <= spill], at[height > -spill]
    return directions, thresholds


def route(vectors: np.ndarray, directions: np.ndarray, thresholds: np.ndarray, spill: float) -> list[tuple[int, np.ndarray]]:
    """(leaf, rows): rows near a threshold go to both sides."""
    at = [(0, np.arange(len(vectors)))]
    out = []
    while at:
        k, rows = at.pop()
        if k >= len(thresholds):
            out.append((k, rows))
            continue
        height = vectors[rows] @ directions[k] - thresholds[k]
        at += [(2 * k + 1, rows[height <= spill]), (2 * k + 2, rows[height > -spill])]
    return [(k, rows) for k, rows in out if len(rows)]


def leaves(classes: DataFrame, trees: int, spill: float, leaf: int) -> DataFrame:
    """(cid, leaf long): the leaves that rounds of splits put each class in."""
    vectors = classes.select("cid", "embedding")
    rows = classes.select("cid", F.xxhash64("label", "dim").alias("leaf"), F.lit(None).cast("long").alias("above"))
    done = []
    for turn in range(ROUNDS):
        rows = keep(rows, "nodes")
        sizes = rows.groupBy("leaf").agg(F.count("*").alias("n"), F.max("above").alias("above"))
        stuck = F.coalesce(F.col("n") > STUCK * F.col("above"), F.lit(False))
        sizes = keep(sizes.where((F.col("n") > leaf) & ~stuck).drop("above"), "large-nodes")
        done.append(rows.join(sizes, "leaf", "left_anti").select("cid", "leaf"))
        if not sizes.take(1):
            break
        many = trees if turn == 0 else 1
        large = rows.select("cid", "leaf").join(sizes, "leaf").join(vectors, "cid")
        share = F.pmod(F.xxhash64("cid", F.lit(turn)), F.lit(1 << 20)) < F.lit(SAMPLE) / F.col("n") * (1 << 20)
        wanted = F.least(F.lit(LEVELS), F.ceil(F.log2(F.col("n") / leaf))).cast("int")

        def plan(sample: pa.Table) -> pa.Table:
            node, levels, n = (sample[c][0].as_py() for c in ("leaf", "levels", "n"))
            unit = units(sample.sort_by("cid")["embedding"])
            found = [fit(unit, (node ^ (tree * 0x9E3779B97F4A7C15)) & 0xFFFFFFFF, levels, n, spill, leaf) for tree in range(many)]
            directions, thresholds = (np.stack([f[k] for f in found]).astype("<f8").tobytes() for k in (0, 1))
            return pa.table({"leaf": [node], "directions": pa.array([directions], pa.binary()), "thresholds": pa.array([thresholds], pa.binary()), "trees": pa.array([many], pa.int32())})

        fitted = large.where(share).select("leaf", "cid", "embedding", "n", wanted.alias("levels"))
        fitted = keep(fitted.groupBy("leaf").applyInArrow(plan, "leaf long, directions binary, thresholds binary, trees int"), "splits")

        def split(part: pa.Table, splits: pa.Table) -> pa.Table:
            empty = pa.table({"cid": pa.array([], pa.int64()), "node": pa.array([], pa.int64()), "child": pa.array([], pa.int32()), "above": pa.array([], pa.int64())})
            if not part.num_rows or not splits.num_rows:
                return empty
            thresholds = np.frombuffer(splits["thresholds"][0].as_py()).reshape(splits["trees"][0].as_py(), -1)
            directions = np.frombuffer(splits["directions"][0].as_py()).reshape(*thresholds.shape, -1)
            unit, cid, out = units(part["embedding"]), part["cid"].to_numpy(), []
            for tree in range(len(thresholds)):
                for k, at in route(unit, directions[tree], thresholds[tree], spill):
                    out.append((cid[at], np.full(len(at), tree * (1 << LEVELS + 1) + k, np.int32)))
            ids, child = (np.concatenate([o[k] for o in out]) for k in (0, 1))
            fixed = {c: pa.array(np.full(len(ids), part[c][0].as_py())) for c in ("leaf", "n")}
            return pa.table({"cid": ids, "node": fixed["leaf"], "child": child, "above": fixed["n"]})

        # Each block of a node's vectors gets the node's splits once.
        blocks = F.ceil(F.col("n") / ROUTED).cast("int")
        dealt = large.select("leaf", "cid", "n", "embedding", F.pmod(F.xxhash64("cid"), blocks).cast("int").alias("block"))
        splits = fitted.join(sizes, "leaf").withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).drop("n")
        routed = dealt.groupBy("leaf", "block").cogroup(splits.groupBy("leaf", "block")).applyInArrow(split, "cid long, node long, child int, above long")
        rows = routed.select("cid", F.xxhash64("node", "child").alias("leaf"), "above")
    else:
        done.append(rows.select("cid", "leaf"))
    out = done[0]
    for part in done[1:]:
        out = out.unionAll(part)
    return out


def first_met(codes: pa.ListArray, here: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Places of the pairs (i, j) of rows that share no leaf below ``here``.

    Each row's lower leaves are bits, those of most rows first: nearly all pairs of a tight
    group that meet elsewhere are settled by the first word.
    """
    codes = codes.take(pa.array(np.arange(len(codes)))) if codes.offset else codes
    row, code = np.repeat(np.arange(len(codes)), np.diff(codes.offsets.to_numpy())), codes.flatten().to_numpy()
    linked = np.zeros(len(codes), bool)
    linked[i] = linked[j] = True
    lower = linked[row] & (code < here)
    row, (names, bit, many) = row[lower], np.unique(code[lower], return_inverse=True, return_counts=True)
    rank = np.empty(len(names), np.int64)
    rank[np.argsort(-many, kind="stable")] = np.arange(len(names))
    bit, own = rank[bit.ravel()], np.arange(len(i))
    for word in range(-(-int((many > 1).sum()) // 64)):  # a leaf of one row is shared by no pair
        mine = bit // 64 == word
        bits = np.zeros(len(codes), np.uint64)
        np.bitwise_or.at(bits, row[mine], np.uint64(1) << (bit[mine] % 64).astype(np.uint64))
        own = own[(bits[i[own]] & bits[j[own]]) == 0]
    return own


def least_reached(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest row that each of n rows reaches over the pairs (i, j)."""
    label = np.arange(n)
    while len(i):
        new = label.copy()
        np.minimum.at(new, np.maximum(label[i], label[j]), np.minimum(label[i], label[j]))
        while (new[new] != new).any():
            new = new[new]
        label = new
        apart = label[i] != label[j]
        i, j = i[apart], j[apart]
    return label


def compare(rows: pa.Table, cosine: float) -> pa.Table:
    """(cid, n, to): links of one block pair that this leaf counts, and a forest of all its links."""
    rows = rows.sort_by([("block", "ascending"), ("cid", "ascending")])
    here, one, other = (rows[c][0].as_py() for c in ("leaf", "block_a", "block_b"))
    u, block, cid = units(rows["embedding"]), rows["block"].to_numpy(), rows["cid"].to_numpy()
    if one == other:
        linked = np.triu((u @ u.T) >= cosine, 1)
        i, j = np.nonzero(linked)
    else:  # pairs inside a block have a task of their own
        edge = int(np.searchsorted(block, other)) if one < other else 0
        i, j = np.nonzero((u[:edge] @ u[edge:].T) >= cosine)
        j = j + edge
    if not len(i):
        return pa.table({"cid": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "to": pa.array([], pa.int64())})
    own = first_met(rows["codes"].combine_chunks(), here, i, j)
    number, i_, j_ = rows["number"].to_numpy(), i[own], j[own]
    n = np.bincount(i_, weights=number[j_], minlength=len(rows)) + np.bincount(j_, weights=number[i_], minlength=len(rows))
    label = least_reached(len(rows), i, j)
    at, joined = np.flatnonzero(n), np.flatnonzero(label != np.arange(len(rows)))
    none = lambda k: pa.nulls(k, pa.int64())
    return pa.table(
        {
            "cid": np.concatenate([cid[at], cid[joined]]),
            "n": pa.concat_arrays([pa.array(n[at].astype(np.int64)), none(len(joined))]),
            "to": pa.concat_arrays([none(len(at)), pa.array(cid[label[joined]])]),
        }
    )


def near_vectors(
    vectors: DataFrame,
    cosine: float = 0.93,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    trees: int = TREES,
    spill: float = SPILL,
    leaf: int = LEAF,
) -> DataFrame:
    """(id, n_links, component_id, kept) for each row."""
    flat = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").alias("embedding"), F.col(f"`{label_col}`").alias("label")
    )
    some = F.exists("embedding", lambda x: x.cast("double") != 0)
    flat = keep(flat.withColumn("good", valid("embedding") & F.coalesce(some, F.lit(False)) & F.col("label").isNotNull() & F.col("id").isNotNull()), "rows")
    good = flat.where("good")
    classes = good.groupBy("label", "embedding").agg(F.min("id").alias("rep"), F.count("*").alias("number"))
    classes = keep(classes.withColumns({"dim": F.size("embedding"), "cid": F.monotonically_increasing_id()}), "classes")

    placed = keep(leaves(classes, trees, spill, leaf), "placed")
    codes = placed.groupBy("cid").agg(F.sort_array(F.collect_set("leaf")).alias("codes"))
    sizes = placed.groupBy("leaf").agg(F.ceil(F.count("*") / F.lit(leaf)).cast("int").alias("n_blocks"), F.count("*").alias("n")).where("n > 1")
    carried = classes.select("cid", "number", "embedding").join(codes, "cid")
    rows = placed.join(sizes.drop("n"), "leaf").join(carried, "cid")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("cid"), F.col("n_blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))
    rows = rows.withColumn("other", other).withColumns({"block_a": F.least("block", "other"), "block_b": F.greatest("block", "other")})
    keys = ["leaf", "block_a", "block_b"]
    dealt = rows.select(*keys, "block", "cid", "number", "codes", "embedding")
    found = dealt.groupBy(*keys).applyInArrow(lambda part: compare(part, cosine), "cid long, n long, to long")
    found = keep(found, "vector-links")

    counts = found.where("n is not null").groupBy("cid").agg(F.sum("n").alias("n"))
    per_class = classes.join(counts, "cid", "left").select("label", "embedding", "rep", (F.coalesce("n", F.lit(0)) + F.col("number") - 1).alias("n_links"))
    members = good.join(per_class, ["label", "embedding"]).select("id", "rep", "n_links")
    members = keep(members, "members")
    reps = classes.select("cid", "rep")
    forest = found.where("to is not null").join(reps, "cid").select("to", F.col("rep").alias("a")).join(reps.withColumnRenamed("cid", "to"), "to")
    links = forest.select("a", F.col("rep").alias("b")).unionAll(members.where("id != rep").select(F.col("id").alias("a"), F.col("rep").alias("b")))
    out = members.select("id", "n_links").unionAll(flat.where("not good").select("id", F.lit(0).cast("long")))
    reached = components(links).withColumnRenamed("node", "id")
    component = F.coalesce("component", "id")
    return out.join(reached, "id", "left").select(
        F.col("id").alias(id_col), "n_links", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept")
    )


@query()
def op8_embedding_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_vectors(table(spark, sf, "embeddings"), cosine=0.93)
