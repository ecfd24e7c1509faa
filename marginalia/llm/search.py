"""Exact top-k search by inner product with KD-trees.

Vectors are dealt to shards by a hash of their id; each shard becomes a KD-tree (median splits on
the widest side, tight bounding boxes, smallest id below each node). A query walks a tree best
first by the largest inner product that a box allows and stops at its kth score. A query first
searches the shard that it lies in; the kth score found there goes with it to all other shards,
which therefore skip most of what cannot enter the result. Queries stream through a shard's task,
so only one shard is in memory; only up to k rows of a query leave each shard.

Defined cases: vectors that are null or hold null or non-finite components take no part, nor do
null ids; of rows that share an id the smallest vector counts; vectors meet only vectors of their
own length; equal scores go to the smaller id; a table without queries or candidates gives no rows;
further columns are ignored. Scores beyond a long are cut to its range and then tie. Every query goes
to every shard: only the kth score that travels with it saves work there.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, in_arrow, table

K = 20
QUERY_STEP = 20
SHARD_ROWS = 16_384
LEAF = 128
SCALE = 64
FOUND = "query_id long, dim int, vec_id long, score long"
LONG = np.iinfo(np.int64)


class Tree:
    """A KD-tree over integer vectors (as doubles, exact up to 2**53)."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray) -> None:
        self.order = np.arange(len(ids))
        self.lo, self.hi, self.least, self.span, self.kids = [], [], [], [], []
        todo, self.ids, self.rows = [(0, len(ids), -1)], ids, rows
        while todo:
            a, b, parent = todo.pop()
            me = len(self.span)
            if parent >= 0:
                self.kids[parent].append(me)
            own = rows[self.order[a:b]]
            lo, hi = own.min(axis=0), own.max(axis=0)
            self.lo.append(lo)
            self.hi.append(hi)
            self.least.append(int(ids[self.order[a:b]].min()))
            self.span.append((a, b))
            self.kids.append([])
            if b - a > LEAF and len(lo) and (hi > lo).any():
                side, mid = int(np.argmax(hi - lo)), (b - a) // 2
                self.order[a:b] = self.order[a:b][np.argpartition(own[:, side], mid)]
                todo += [(a, a + mid, me), (a + mid, b, me)]
        self.ids, self.rows = ids[self.order], rows[self.order]
        self.lo, self.hi = np.array(self.lo), np.array(self.hi)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Largest inner product of each query with any point of each box."""
        return np.maximum(queries, 0) @ self.hi.T + np.minimum(queries, 0) @ self.lo.T

    def search(self, query_id: int, query: np.ndarray, bound: np.ndarray, k: int, floor: float) -> list[tuple[float, int]]:
        """Up to k (score, vec_id), best first; ``floor`` is a kth score known from elsewhere:
        scores under it are of no use."""
        best: list[tuple[float, int]] = []  # a heap of (score, -vec_id): the worst is on top
        queue = [(-bound[0], 0)]
        while queue:
            top, node = heapq.heappop(queue)
            if -top < floor or len(best) == k and (-top, -self.least[node]) <= best[0]:
                if -top < floor or -top < best[0][0]:
                    break
                continue
            if self.kids[node]:
                for kid in self.kids[node]:
                    if bound[kid] >= floor:
                        heapq.heappush(queue, (-bound[kid], kid))
                continue
            a, b = self.span[node]
            scores, ids = self.rows[a:b] @ query, self.ids[a:b]
            keep = scores >= (max(floor, best[0][0]) if len(best) == k else floor)
            for score, vec_id in zip(scores[keep].tolist(), ids[keep].tolist()):
                if vec_id == query_id:
                    continue
                if len(best) < k:
                    heapq.heappush(best, (score, -vec_id))
                elif (score, -vec_id) > best[0]:
                    heapq.heapreplace(best, (score, -vec_id))
        return [(s, -i) for s, i in sorted(best, reverse=True)]


def _numbers(lists: pa.Array, dim: int) -> np.ndarray:
    """Rows of integers; doubles where their products are exact, Python integers elsewhere."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    most = np.abs(flat).max(initial=0.0)
    rows = flat if dim * most * most < 2.0**52 else np.array([int(x) for x in flat], object)
    return rows.reshape(len(lists), dim)


def _scan(batches: Iterator[pa.RecordBatch], k: int, home: bool) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by dim and shard, a shard's vectors (kind 0) before its queries (kind 1)."""
    now, tree, ids, rows = None, None, [], []
    for batch in batches:
        for (dim, shard), part in _runs(batch, ("dim", "shard")):
            if (dim, shard) != now:
                if home and ids:
                    yield from _home(_tree(ids, rows), k, now[0])
                now, tree, ids, rows = (dim, shard), None, [], []
            for (kind,), piece in _runs(part, ("kind",)):
                numbers = _numbers(piece.column("v"), dim)
                if kind == 0:
                    ids.append(piece.column("vec_id").to_numpy())
                    rows.append(numbers)
                elif ids:
                    tree = tree or _tree(ids, rows)
                    yield _answers(tree, piece.column("vec_id").to_numpy(), numbers, piece.column("floor").to_pylist(), k, dim)
    if home and ids:
        yield from _home(_tree(ids, rows), k, now[0])


def _runs(batch: pa.RecordBatch, names: tuple[str, ...]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in names], axis=1)
    edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield tuple(int(x) for x in keys[a]), batch.slice(a, b - a)


def _tree(ids: list[np.ndarray], rows: list[np.ndarray]) -> Tree:
    return Tree(np.concatenate(ids), np.concatenate(rows))


def _answers(tree: Tree, query_ids: np.ndarray, queries: np.ndarray, floors: list, k: int, dim: int) -> pa.RecordBatch:
    out: list[tuple] = []
    if object in (tree.rows.dtype, queries.dtype):
        whole = lambda x: np.array([int(y) for y in x.ravel()], object).reshape(x.shape)
        tree, queries = Tree(tree.ids, whole(tree.rows)), whole(queries)
    for a in range(0, len(query_ids), 512):
        bounds = tree.bounds(queries[a : a + 512])
        for i, bound in enumerate(bounds, a):
            floor = -float("inf") if floors[i] is None else floors[i]
            out += [(int(query_ids[i]), dim, v, min(max(int(s), LONG.min), LONG.max)) for s, v in tree.search(int(query_ids[i]), queries[i], bound, k, floor)]
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
    columns = list(zip(*out)) or [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["query_id", "dim", "vec_id", "score"])


def _home(tree: Tree, k: int, dim: int) -> Iterator[pa.RecordBatch]:
    """The queries among a shard's own vectors."""
    own = np.flatnonzero(tree.ids % QUERY_STEP == 0)
    for a in range(0, len(own), 2048):
        some = own[a : a + 2048]
        yield _answers(tree, tree.ids[some], tree.rows[some], [None] * len(some), k, dim)


def scaled(embedding: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component as whole doubles, null where the vector takes no part."""
    fine = F.forall(embedding, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))), F.lit(False)))
    whole = lambda y: F.when(F.abs(y) < 2.0**53, F.floor(y).cast("double")).otherwise(y)  # noqa: E731  larger doubles are whole
    return F.when(fine, F.transform(embedding, lambda x: whole(x.cast("double") * scale)))


def top_k(vectors: DataFrame, k: int = K, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score for each row of (vec_id, v: whole doubles) whose id is
    divisible by 20, against all rows."""
    spark = vectors.sparkSession
    unique = vectors.where(F.col("v").isNotNull() & F.col("vec_id").isNotNull()).groupBy("vec_id").agg(F.min("v").alias("v"))
    unique = cut(unique.withColumn("dim", F.size("v")), "vectors")
    shards = max(1, -(-unique.count() // shard_rows))
    candidates = unique.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    deal = lambda df: df.repartitionById(shards, F.col("shard")).sortWithinPartitions("dim", "shard", "kind")  # noqa: E731  a task for each shard
    typed = lambda df: df.select("dim", "shard", F.col("kind").cast("int"), "vec_id", "v", F.col("floor").cast("long"))
    rows = typed(candidates.withColumns({"kind": F.lit(0), "floor": F.lit(None)}))
    home = cut(deal(rows).transform(in_arrow, lambda it: _scan(it, k, True), FOUND), "home")
    floors = home.groupBy("query_id").agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("n")).select("query_id", F.when(F.col("n") >= k, F.col("floor")).alias("floor"))
    asked = candidates.where(F.col("vec_id") % QUERY_STEP == 0).join(floors, F.col("vec_id") == F.col("query_id"), "left")
    everywhere = F.explode(F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != F.col("home")))
    travelling = asked.withColumnRenamed("shard", "home").withColumn("shard", everywhere).withColumn("kind", F.lit(1))
    away = deal(rows.unionByName(typed(travelling))).transform(in_arrow, lambda it: _scan(it, k, False), FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return home.unionByName(away).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best vectors for every twentieth one."""
    rows = table(spark, sf_dir, "embeddings")
    return top_k(rows.select("vec_id", scaled(F.col("embedding")).alias("v")))


OP2_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 20
"""
