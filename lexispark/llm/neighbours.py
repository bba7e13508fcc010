"""Approximate nearest neighbours by largest inner product: a forest of
random-projection trees, searched through one priority queue for all trees,
then an exact rerank of the leaf candidates in double precision.

Fit: hyperplanes come from a bounded sample (about ``sample`` vectors, by a
hash of their ids; equal ones count once), each the widest of three differences of two
sampled points, cut at the sample's median. Vectors get one more component,
sqrt(M^2 - |x|^2) with M the largest norm (queries: 0), so that the largest
inner product is the nearest point.

Index: every vector goes to one leaf of each tree. Equal vectors are one
entry with their k + 1 smallest ids: no other copy can enter a list of k
whose ties go to the smaller id, so nothing is lost.

Search: a query's queue holds nodes of all trees by the squared margins
passed on the wrong side; the ``visits`` nearest leaves are read. A leaf
with many entries or many queries is dealt out in blocks of ``block`` rows a
side (the counts of each leaf, at most trees * 2 ** depth, decide), so no
task gets an unbounded group. Each block emits a query's k best.

Vectors that are null, zero, or hold null or non-finite components take no
part, nor rows without id, nor vectors of another length than the most
frequent one of the table (ties: the longer), as queries either. Of several
query rows with one id the smallest vector is asked. Copies and ties go to the smaller id; a
query never meets its own id. Fewer candidates than k: all of them found.
Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: A tree is split no further than to this many sampled points a leaf.
LEAF = 128
SCHEMA = "query_id long, vec_id long, score double"


class Forest:
    """Per tree: unit normals and offsets of its nodes in heap order."""

    def __init__(self, sample: np.ndarray, trees: int, depth: int, seed: int):
        self.trees, self.depth = trees, depth
        rng = np.random.default_rng(seed)
        self.first = (1 << depth) - 1
        self.normal = np.zeros((trees, self.first, sample.shape[1]))
        self.offset = np.zeros((trees, self.first))
        for t in range(trees):
            rows = {0: np.arange(len(sample))}
            for node in range(self.first):
                own = rows.pop(node)
                w, at = self._cut(sample[own], rng)
                self.normal[t, node], self.offset[t, node] = w, at
                right = sample[own] @ w >= at
                rows[2 * node + 1], rows[2 * node + 2] = own[~right], own[right]

    @staticmethod
    def _cut(points: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, float]:
        best = None
        for _ in range(3):
            w = points[rng.integers(len(points))] - points[rng.integers(len(points))] if len(points) > 1 else np.zeros(points.shape[1])
            if (norm := np.linalg.norm(w)) < 1e-9:
                w = rng.normal(size=points.shape[1])
                norm = np.linalg.norm(w)
            along = points @ (w / norm)
            spread = along.std() if len(along) else 0.0
            if best is None or spread > best[0]:
                best = (spread, w / norm, float(np.median(along)) if len(along) else 0.0)
        return best[1], best[2]

    def margins(self, points: np.ndarray) -> np.ndarray:
        """(points, trees, nodes): signed distances to the hyperplanes."""
        return np.einsum("pd,tnd->ptn", points, self.normal, optimize=True) - self.offset

    def leaves(self, points: np.ndarray) -> np.ndarray:
        """(points, trees): the leaf of each point."""
        m = self.margins(points)
        node = np.zeros(m.shape[:2], dtype=np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (np.take_along_axis(m, node[..., None], 2)[..., 0] >= 0)
        return node - self.first

    def search(self, margins: np.ndarray, visits: int) -> list[tuple[int, int]]:
        """The (tree, leaf) pairs nearest to one query, from one queue."""
        queue = [(0.0, t, 0) for t in range(self.trees)]
        found: list[tuple[int, int]] = []
        while queue and len(found) < visits:
            cost, t, node = heapq.heappop(queue)
            while node < self.first:
                m = margins[t, node]
                near, far = (2 * node + 2, 2 * node + 1) if m >= 0 else (2 * node + 1, 2 * node + 2)
                heapq.heappush(queue, (cost + m * m, t, far))
                node = near
            found.append((t, node - self.first))
        return found


def valid_vectors(embeddings: DataFrame, size: int | None = None) -> tuple[DataFrame, int]:
    """(vec_id, v) of the vectors that take part, and their length:
    ``size``, or else the most frequent."""
    v = F.transform(F.col("embedding"), lambda x: x.cast("double"))
    whole = F.forall(F.col("v"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    given = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    given = given.where(whole & F.exists(F.col("v"), lambda x: x != 0))
    if size is None:
        sizes = given.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
        size = sizes[0].d if sizes else 0
    return given.where(F.size("v") == size), size


def _matrix(column: pa.Array | pa.ChunkedArray, rows: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1) if rows else np.zeros((0, 0))


def _lift(points: np.ndarray, most: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(most - np.einsum("ij,ij->i", points, points), 0))
    return np.concatenate([points, rest[:, None]], axis=1)


def rerank(k: int, queries: np.ndarray, q: np.ndarray, ids: list[list[int]], x: np.ndarray) -> tuple[list[int], list[int], list[float]]:
    """Each query's k best among the entries (their ids, their vectors) by
    exact inner product, ties to the smaller id."""
    out: tuple[list[int], list[int], list[float]] = ([], [], [])
    rough = q @ x.T
    for row, query in enumerate(queries.tolist()):
        need = min(len(ids), k + 1)
        floor = np.partition(rough[row], len(ids) - need)[len(ids) - need]
        near = np.flatnonzero(rough[row] >= floor - 1e-9 * max(1.0, abs(floor)))
        exact = (x[near] * q[row]).sum(axis=1)
        pairs = sorted((-score, vec) for at, score in zip(near, exact.tolist(), strict=True) for vec in ids[at] if vec != query)
        for score, vec in pairs[:k]:
            out[0].append(query)
            out[1].append(vec)
            out[2].append(-score)
    return out


def nearest(embeddings: DataFrame, queries: DataFrame, k: int = 20, trees: int = 6, depth: int = 6, visits: int = 72, sample: int = 8192, block: int = 4096, seed: int = 7) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of ``embeddings``
    found for each of ``queries`` (both vec_id, embedding)."""
    points, size = valid_vectors(embeddings)
    asked = valid_vectors(queries, size)[0]
    spark = points.sparkSession
    n = points.count()
    part = F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(1_000_000)) < max(1, min(1_000_000, 1_000_000 * sample // max(n, 1)))
    some = points.where(part | F.lit(n <= sample)).select("v").collect()  # about ``sample`` rows
    if not some:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    some = np.unique(np.array([r.v for r in some], dtype=np.float64), axis=0)
    depth = min(depth, max(0, (len(some) // LEAF).bit_length() - 1))
    most = points.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).first()[0]
    forest = Forest(_lift(some, most), trees, depth, seed)
    send = spark.sparkContext.broadcast(forest)

    copies = Window.partitionBy("v").orderBy("vec_id")
    few = points.withColumn("_n", F.row_number().over(copies)).where(F.col("_n") <= k + 1)
    entries = few.groupBy("v").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"))

    def to_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = send.value.leaves(_lift(_matrix(b.column(0), b.num_rows), most))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at.tolist(), pa.list_(pa.int32()))], names=["v", "ids", "leaves"])

    def to_visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            q = _matrix(b.column(1), b.num_rows)
            for lo in range(0, b.num_rows, 256):
                m = send.value.margins(np.concatenate([q[lo : lo + 256], np.zeros((len(q[lo : lo + 256]), 1))], axis=1))
                seen = [[t << depth | leaf for t, leaf in send.value.search(one, visits)] for one in m]
                yield pa.RecordBatch.from_arrays([*b.slice(lo, 256).columns, pa.array(seen, pa.list_(pa.int32()))], names=["query_id", "q", "leaves"])

    placed = stored(entries.mapInArrow(to_leaves, "v array<double>, ids array<long>, leaves array<int>"), "leaves")
    placed = placed.select("v", "ids", F.posexplode("leaves").alias("_t", "_l")).select("v", "ids", (F.shiftleft("_t", depth) + F.col("_l")).alias("leaf"))
    visited = asked.select(F.col("vec_id").alias("query_id"), "v").groupBy("query_id").agg(F.min("v").alias("q"))
    visited = stored(visited.mapInArrow(to_visits, "query_id long, q array<double>, leaves array<int>"), "visits").select("query_id", "q", F.explode("leaves").alias("leaf"))

    def blocks(df: DataFrame) -> list[int]:
        n = dict(df.groupBy("leaf").count().collect())  # at most trees * 2 ** depth rows
        return [max(1, -(-n.get(i, 0) // block)) for i in range(trees << depth)]

    by_row, by_query = blocks(placed.select("leaf")), blocks(visited.select("leaf"))
    n_row, n_query = (F.element_at(F.lit(x), F.col("leaf") + 1) for x in (by_row, by_query))
    left = placed.select("*", F.pmod(F.xxhash64(F.element_at("ids", 1)), n_row).cast("int").alias("part"), F.explode(F.sequence(F.lit(0), n_query - 1)).alias("qpart"))
    right = visited.select("*", F.pmod(F.xxhash64("query_id"), n_query).cast("int").alias("qpart"), F.explode(F.sequence(F.lit(0), n_row - 1)).alias("part"))
    empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})

    def meet(rows: pa.Table, asks: pa.Table) -> pa.Table:
        if not rows.num_rows or not asks.num_rows:
            return empty
        got = rerank(k, asks["query_id"].to_numpy(), _matrix(asks["q"], asks.num_rows), rows["ids"].to_pylist(), _matrix(rows["v"], rows.num_rows))
        return pa.table({"query_id": pa.array(got[0], pa.int64()), "vec_id": pa.array(got[1], pa.int64()), "score": pa.array(got[2], pa.float64())})

    key = ["leaf", "part", "qpart"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(meet, SCHEMA)
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = once.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
