"""Exact top-k inner product search by norm buckets.

Vectors become integers, floor(scale * x), and are grouped by length: the lengths of a bucket
lie within a factor of ``RATIO``; large buckets are dealt into blocks. Each query starts with the
k-th best product among the longest vectors as its bound; divided by the lengths of query and
bucket this is the cosine that a vector of the bucket must have at least. A bucket that would
need a cosine above 1 is left out for the query. Inside a bucket a high cosine threshold picks
pruning by coordinates (each large coordinate of the query confines that of its matches to
an interval), a low one pruning by length (vectors too short for the bound are skipped). What
is left is verified by its product. A query's bound stays as it is: buckets are searched by
tasks of their own, at the same time.

Defined results: vectors that are null, empty or hold null or non-finite components take no
part, nor rows without an id; vectors of another dimension than the query's are no candidates;
rows with the query's id are its own and no candidates; repeated rows count as rows.
Components beyond 2**20 are compared by 64-bit integer products (sums beyond 2**63 overflow).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from floodmark.llm.base import keep, query, table

RATIO = 1.05
#: Vectors of a block, queries of a block, and longest vectors that give the first bounds.
BLOCK, QUERIES_AT_ONCE, SEEDS = 4096, 1024, 1024
#: Cosine threshold from which coordinates prune better than lengths.
COORDINATES_FROM = 0.5
#: Largest coordinates of a query that are looked at.
FOCUS = 3


def valid(vector: str) -> Column:
    """Not null, not empty, all components finite."""
    v = F.col(f"`{vector}`").cast("array<double>")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf)))
    return F.coalesce((F.size(v) > 0) & ~odd, F.lit(False))


def integers(rows: pd.Series) -> np.ndarray:
    return np.array(rows.tolist(), np.int64).reshape(len(rows), -1)


def products(vectors: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles where every sum fits their 53 bits."""
    if len(vectors) and float(np.abs(vectors).max()) * float(np.abs(one).max()) * len(one) < 2**53:
        return (vectors.astype(np.float64) @ one.astype(np.float64)).astype(np.int64)
    return vectors @ one


def bound(scores: np.ndarray, k: int) -> float:
    return float(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else -math.inf


class Block:
    """Vectors of one bucket by falling length."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
        order = np.argsort(-self.norms, kind="stable")
        self.norms, self.ids, self.vectors = self.norms[order], ids[order], vectors[order]
        self.unit = self.vectors / np.maximum(self.norms, 1e-300)[:, None]

    def candidates(self, one: np.ndarray, least: float) -> np.ndarray:
        """Rows whose product with ``one`` can reach ``least``."""
        norm = float(np.sqrt((one.astype(np.float64) ** 2).sum()))
        if least <= 0 or norm == 0:
            return np.arange(len(self.ids)) if least <= 0 else np.empty(0, np.int64)
        need = least / (norm * max(float(self.norms[0]), 1e-300)) * (1 - 1e-9)
        if need > 1:
            return np.empty(0, np.int64)
        # Any vector shorter than least / norm fails, whatever its direction.
        upto = int(np.searchsorted(-self.norms, -least / norm * (1 - 1e-9), side="right"))
        if need < COORDINATES_FROM:
            return np.arange(upto)
        unit, fits = one / norm, np.ones(upto, bool)
        for f in np.argsort(-np.abs(unit))[:FOCUS]:
            wide = math.sqrt(max(0.0, 1 - need * need) * max(0.0, 1 - unit[f] * unit[f])) + 1e-9
            # Within a cosine of ``need``, or closer: the interval around need * q and up to q.
            low, high = need * unit[f] - wide, need * unit[f] + wide
            if unit[f] >= need:
                high = 1.0
            if unit[f] <= -need:
                low = -1.0
            fits &= (self.unit[:upto, f] >= low) & (self.unit[:upto, f] <= high)
        return np.flatnonzero(fits)

    def best(self, own: int, one: np.ndarray, k: int, least: float) -> tuple[np.ndarray, np.ndarray]:
        at = self.candidates(one, least)
        at = at[self.ids[at] != own]
        scores = products(self.vectors[at], one)
        good = scores >= least
        at, scores = at[good], scores[good]
        order = np.lexsort((self.ids[at], -scores))[:k]
        return self.ids[at[order]], scores[order]


def top_k(
    vectors: DataFrame, queries: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of all rows for the rows where ``queries`` holds."""
    spark = vectors.sparkSession
    whole = F.transform(F.col(f"`{vector_col}`").cast("array<double>"), lambda x: F.floor(x * scale))
    rows = vectors.where(valid(vector_col) & F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").cast("long").alias("id"), whole.alias("v"), F.coalesce(queries, F.lit(False)).alias("asks")
    )
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    rows = rows.withColumn("norm", F.sqrt(square)).withColumn("dim", F.size("v"))
    rows = rows.withColumn("bucket", F.floor(F.log(F.greatest("norm", F.lit(1.0))) / math.log(RATIO)).cast("int"))
    rows = keep(rows, "integers")

    # A few numbers for each dimension and bucket of lengths; blocks are numbered through.
    stats = rows.groupBy("dim", "bucket").agg(F.count("*").alias("n"), F.max("norm").alias("most")).orderBy("dim", "bucket").collect()
    blocks, at = [], 0
    for s in stats:
        n = -(-s.n // BLOCK)
        blocks.append((s.dim, s.bucket, at, n, s.most))
        at += n
    # The blocks' numbers start at 0 for each bucket row; the table is as long as ``stats``.
    numbers = spark.createDataFrame(blocks, "dim int, bucket int, first int, n_blocks int, most double")
    probes = rows.join(numbers, ["dim", "bucket"]).withColumn("block", F.col("first") + F.pmod(F.xxhash64("id"), F.col("n_blocks")).cast("int"))

    asked = rows.where("asks")
    n_asked = asked.count()
    query_blocks = max(1, -(-n_asked // QUERIES_AT_ONCE))
    seeds = rows.orderBy(F.desc("norm"), "id").limit(SEEDS).select("id", "v").collect()
    by_dim: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for dim in {len(s.v) for s in seeds}:
        mine = [s for s in seeds if len(s.v) == dim]
        by_dim[dim] = np.array([s.id for s in mine], np.int64), np.array([s.v for s in mine], np.int64)

    def bounds(batches):
        for batch in batches:
            least = []
            for own, v in zip(batch["id"], batch["v"], strict=True):
                ids, some = by_dim.get(len(v), (np.empty(0, np.int64), np.empty((0, len(v)), np.int64)))
                least.append(bound(products(some[ids != own], np.asarray(v, np.int64)), k))
            yield batch.assign(least=least)

    asked = asked.select("dim", "id", "v", "norm", F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int").alias("ask"))
    asked = keep(asked.mapInPandas(bounds, "dim int, id long, v array<long>, norm double, ask int, least double"), "asked")
    # A query goes to the buckets whose longest vector can reach its bound.
    reach = asked.join(numbers, "dim").where(F.col("least") <= F.col("norm") * F.col("most") * (1 + 1e-9))
    left = reach.withColumn("block", F.explode(F.sequence("first", F.col("first") + F.col("n_blocks") - 1)))
    # A block of vectors goes to those blocks of queries that have a query which can reach it.
    met = reach.select("ask", "first", "n_blocks").distinct()
    met = met.withColumn("block", F.explode(F.sequence("first", F.col("first") + F.col("n_blocks") - 1))).select("block", F.col("ask").alias("met_ask"))
    right = probes.join(met, "block")

    def search(asks: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if not len(asks) or not len(found):
            return pd.DataFrame(columns=["query_id", "vec_id", "score"])
        block = Block(found["id"].to_numpy(np.int64), integers(found["v"]))
        out = []
        for own, v, least in zip(asks["id"], integers(asks["v"]), asks["least"], strict=True):
            ids, scores = block.best(own, v, k, least)
            out.append(pd.DataFrame({"query_id": own, "vec_id": ids, "score": scores}))
        return pd.concat(out, ignore_index=True)

    grouped = left.select("block", "ask", "id", "v", "least").groupBy("block", "ask")
    pairs = grouped.cogroup(right.select(F.col("block").alias("met_block"), "met_ask", "id", "v").groupBy("met_block", "met_ask")).applyInPandas(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


ORACLE = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v, len(embedding) as dim
  from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), p as (
  select q.vec_id as query_id, c.vec_id,
         list_sum(list_transform(range(1, q.dim + 1), lambda i: q.v[i] * c.v[i]))::bigint as score
  from v q join v c on q.dim = c.dim and q.vec_id <> c.vec_id where q.vec_id % 100 = 0
)
select query_id, rank::integer as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from p)
where rank <= 10
"""


@query(ORACLE)
def op3_exact_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0, k=10, scale=1024)
