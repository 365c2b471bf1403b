"""Nearest neighbours by vantage-point trees, one per shard.

Vectors are dealt to shards of about SHARD_ROWS rows, and each shard's tree is built
in one task and written. A block of queries walks a tree together: at a node their
distances to the vantage point are one product, each goes to its near side first, and
to the far side only if the triangle inequality leaves room there: if the distance to the
sphere is at most ``factor`` times the distance of its k-th neighbour so far. Factor 1
restores exact search; less prunes more and may miss neighbours.

Nearness is the cosine; the tree uses the chord between unit vectors, a metric that
orders alike. Final scores are computed anew from the original vectors in double
precision, for all candidates within rounding of the k-th, so ties are exact.

Scale: each block of queries meets each shard once, which is what a search of all
queries in all rows takes; a task holds one shard and one block. Blocks go to the trees in rounds, one
row of at most some BLOCK_VALUES numbers each, so a tree stays where it lies. Equal vectors are
spread over the shards, and each shard returns k rows a query.

Defined cases: vectors that are NULL, empty, zero or hold NULL or non-finite
components take no part; vectors are compared with those of the same length only;
of rows that repeat a query's id the one with the smallest vector asks, and none of
them is its own candidate; ties go to the smaller id.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import stored

SHARD_ROWS, LEAF = 8192, 64
BLOCK_VALUES = 1 << 20  # numbers in a block of queries: 8 MB
SLACK = 1e-9  # of rounding, between a product of matrices and a sum in order


@dataclass
class Tree:
    ids: np.ndarray  # in the order of the leaves
    vectors: np.ndarray  # original components, as doubles
    unit: np.ndarray
    lo: list[int]
    hi: list[int]
    vantage: list[int]  # place of the vantage point; -1 in a leaf
    radius: list[float]
    inner: list[int]
    outer: list[int]


def build(ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF, seed: int = 0) -> Tree:
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order].astype(np.float64)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    draw = np.random.default_rng(seed)
    perm = np.arange(len(ids))
    tree = Tree(ids, vectors, unit, [], [], [], [], [], [])

    def node(lo: int, hi: int) -> int:
        me = len(tree.lo)
        for part, value in ((tree.lo, lo), (tree.hi, hi), (tree.vantage, -1), (tree.radius, 0.0), (tree.inner, -1), (tree.outer, -1)):
            part.append(value)
        if hi - lo <= leaf:
            return me
        own = perm[lo:hi]
        point = int(own[draw.integers(len(own))])
        d = chord(unit[own] @ unit[point])
        radius = float(np.median(d))
        inside = d <= radius
        if inside.all():  # more than half as far as the farthest, for example equal vectors
            return me
        perm[lo:hi] = np.concatenate([own[inside], own[~inside]])
        tree.vantage[me], tree.radius[me] = point, radius
        middle = lo + int(inside.sum())
        tree.inner[me] = node(lo, middle)
        tree.outer[me] = node(middle, hi)
        return me

    if len(ids):
        node(0, len(ids))
    place = np.empty(len(perm), dtype=np.int64)
    place[perm] = np.arange(len(perm))
    tree.ids, tree.vectors, tree.unit = ids[perm], vectors[perm], unit[perm]
    tree.vantage = [int(place[v]) if v >= 0 else -1 for v in tree.vantage]
    return tree


def chord(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * cosine, 0.0))


def search(tree: Tree, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float = 1.0) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the ids and scores of its k nearest in the tree, nearest first."""
    queries = queries.astype(np.float64)
    unit = queries / np.linalg.norm(queries, axis=1, keepdims=True)
    best = np.full((len(queries), k), -np.inf)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def reach(q: np.ndarray) -> np.ndarray:
        """Distance of the k-th neighbour so far."""
        kth = best[q, k - 1]
        return np.where(np.isfinite(kth), chord(np.where(np.isfinite(kth), kth, 0.0)) + SLACK**0.5, np.inf)

    def walk(node: int, q: np.ndarray) -> None:
        if not len(q):
            return
        if tree.vantage[node] < 0:
            lo, hi = tree.lo[node], tree.hi[node]
            s = unit[q] @ tree.unit[lo:hi].T
            s[query_ids[q][:, None] == tree.ids[None, lo:hi]] = -np.inf
            merged = np.concatenate([best[q], s], axis=1)
            best[q] = -np.sort(np.partition(-merged, k - 1, axis=1)[:, :k], axis=1)
            a, b = np.nonzero((s >= best[q, k - 1][:, None] - SLACK) & np.isfinite(s))
            found.append((q[a], b + lo, s[a, b]))
            return
        d = chord(unit[q] @ tree.unit[tree.vantage[node]])
        gap = d - tree.radius[node]
        near = gap <= 0
        for group, first, second in ((near, tree.inner[node], tree.outer[node]), (~near, tree.outer[node], tree.inner[node])):
            own, far = q[group], np.abs(gap[group])
            walk(first, own)
            walk(second, own[far <= factor * reach(own)])

    if tree.lo:
        walk(0, np.arange(len(queries)))
    if not found:
        return [(np.zeros(0, np.int64), np.zeros(0))] * len(queries)
    q, place, s = (np.concatenate(x) for x in zip(*found))
    keep = s >= best[q, k - 1] - SLACK
    q, place = q[keep], place[keep]
    exact = cosine(queries[q], tree.vectors[place])
    order = np.lexsort((tree.ids[place], -exact, q))
    q, place, exact = q[order], place[order], exact[order]
    first = np.searchsorted(q, np.arange(len(queries) + 1))
    return [(tree.ids[place[a:b][:k]], exact[a:b][:k]) for a, b in zip(first[:-1], first[1:])]


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of paired rows: sums in the order of the components."""
    dot, aa, bb = (np.zeros(len(a)) for _ in range(3))
    for i in range(a.shape[1]):
        dot += a[:, i] * b[:, i]
        aa += a[:, i] * a[:, i]
        bb += b[:, i] * b[:, i]
    return dot / (np.sqrt(aa) * np.sqrt(bb))


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _stack(vectors) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in vectors])


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    tree = build(pdf["vec_id"].to_numpy(), _stack(pdf["embedding"]))
    return pd.DataFrame({"dim": [pdf["dim"].iloc[0]], "shard": [pdf["shard"].iloc[0]], "tree": [pickle.dumps(tree)]})


def index(spark: SparkSession, vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(dim, shard, tree) over every usable vector."""
    rows = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    shards = max(1, -(-rows.count() // shard_rows))
    # Rows are dealt by their place in the input, so no id and no vector has a shard to itself.
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))
    dealt = stored(spark, dealt.withColumn("dim", F.size("embedding")), "vectors")
    return stored(spark, dealt.groupBy("dim", "shard").applyInPandas(_build, "dim int, shard long, tree binary"), "trees")


def _matrix(rows: pa.ListScalar) -> np.ndarray:
    return rows.values.flatten().to_numpy(zero_copy_only=False).reshape(len(rows.values), -1)


def _search(k: int, factor: float):
    def run(batches):
        last, tree = None, None
        for batch in batches:
            out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
            for dim, shard, packed, ids, vectors in zip(*(batch.column(c) for c in ("dim", "shard", "tree", "ids", "vectors"))):
                if last != (dim.as_py(), shard.as_py()):
                    last, tree = (dim.as_py(), shard.as_py()), pickle.loads(packed.as_py())
                asked = np.asarray(ids.as_py(), dtype=np.int64)
                for query, (near, score) in zip(asked.tolist(), search(tree, asked, _matrix(vectors), k, factor)):
                    out["query_id"] += [query] * len(near)
                    out["vec_id"] += near.tolist()
                    out["score"] += score.tolist()
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]))

    return run


def nearest(spark: SparkSession, trees: DataFrame, queries: DataFrame, k: int, factor: float = 1.0) -> DataFrame:
    """query_id, rank, vec_id, score for the queries (query_id, embedding)."""
    asked = queries.where(F.col("query_id").isNotNull() & usable(F.col("embedding"))).select(
        F.col("query_id").cast("long").alias("query_id"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    asked = stored(spark, asked.groupBy("query_id").agg(F.min("embedding").alias("embedding")), "queries")
    met = [searched(spark, trees, block, k, factor) for block in query_blocks(asked)]
    if not met:
        return asked.select("query_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    found = reduce(DataFrame.union, met)
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query_blocks(asked: DataFrame) -> Iterator[DataFrame]:
    """The queries in blocks of at most some BLOCK_VALUES numbers, each one row (dim, ids, vectors)."""
    counts = asked.groupBy(F.size("embedding").alias("dim")).agg(F.count("*").alias("n")).orderBy("dim").collect()  # one row per length
    for r in counts:
        blocks = max(1, -(-r.n * r.dim // BLOCK_VALUES))
        dealt = asked.where(F.size("embedding") == r.dim).withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
        for k in range(blocks):
            rows = dealt.where(F.col("block") == k).agg(
                F.max(F.size("embedding")).alias("dim"), F.collect_list(F.struct("query_id", "embedding")).alias("rows")
            )
            yield rows.select("dim", F.col("rows.query_id").alias("ids"), F.col("rows.embedding").alias("vectors"))


def searched(spark: SparkSession, trees: DataFrame, block: DataFrame, k: int, factor: float) -> DataFrame:
    """(query_id, vec_id, score) of one block of queries in every tree.

    The block is one row of bounded size, so it goes to the trees: a tree is read where it lies,
    once a block, and is neither shuffled nor copied. The result is written, so one block at a time is held.
    """
    pairs = trees.join(F.broadcast(block), "dim").select("dim", "shard", "tree", "ids", "vectors")
    return stored(spark, pairs.mapInArrow(_search(k, factor), "query_id long, vec_id long, score double"), "found")


def op4(spark: SparkSession, embeddings: DataFrame) -> DataFrame:
    trees = index(spark, embeddings)
    queries = embeddings.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return nearest(spark, trees, queries, k=5)


SQL = """
WITH u AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
v AS (SELECT vec_id, e, sqrt(list_reduce(list_transform(e, lambda x: x * x), lambda a, b: a + b)) AS n FROM u),
q AS (SELECT vec_id, min(e) AS e, arg_min(n, e) AS n FROM v WHERE vec_id % 50 = 0 GROUP BY vec_id),
s AS (SELECT q.vec_id AS query_id, v.vec_id, list_reduce(list_transform(list_zip(q.e, v.e), lambda p: p[1] * p[2]), lambda a, b: a + b) / (q.n * v.n) AS score
  FROM q JOIN v ON q.vec_id <> v.vec_id AND len(q.e) = len(v.e)),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
