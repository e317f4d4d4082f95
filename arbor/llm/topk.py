"""Exact top-k inner-product search with two cover trees (operator 8).

Vectors become integers, ``floor(1024 * x)`` by component; a score is an integer
inner product. Queries are taken in blocks of bounded size; a block is broadcast
with a cover tree over it. Each task builds a cover tree over each batch of data
vectors it reads and walks the two trees together. A pair of nodes (centres c, c',
covering radii r, r') has no score above ``c.c' + |c| r' + |c'| r + r r'``; it is
pruned where that is below the worst k-th score of the node's queries. Leaves
that are left are scored in order of their bounds, which raises the k-th scores
as they go. A task sends each query its own best k; Spark ranks them by query.

Every query starts from the k-th best score over a sample of ``SAMPLE`` rows
(taken by hash), a lower bound that any exact answer reaches, so all tasks prune
from the start. The sample affects speed only: every row is indexed and the
answer is exact, ties included.

Cover trees here have bounded fan-out: a node's children are picked farthest
first, so they are at least as far from each other as the radius that covers
the node from them; the first child is the node's own centre.

Defined cases: vectors that are null or hold null or non-finite components, and
rows without an id, take no part; vectors are compared with those of their own
length; a query's own id is no candidate for it; repeated rows are candidates
each; repeated query rows are answered once; fewer candidates than k give all;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, gathered, ship

#: Queries in a broadcast block (expected), rows of the sample, children of a node, vectors in a leaf, rows scored at once.
QUERY_BLOCK, SAMPLE, FAN_OUT, LEAF, AT_ONCE = 2048, 2048, 16, 32, 1024
SCALE = 1024.0


class CoverTree:
    """Nodes of a cover tree over the rows of ``points``; a node's points are ``order[start:stop]``."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points = points
        self.order = np.arange(len(points))
        self.center: list[int] = []
        self.radius: list[float] = []
        self.start: list[int] = []
        self.stop: list[int] = []
        self.children: list[list[int]] = []
        root = self._node(0, 0, len(points), np.sqrt(((points - points[0]) ** 2).sum(axis=1)))
        todo = [(root, np.sqrt(((points - points[0]) ** 2).sum(axis=1)))]
        while todo:
            node, near = todo.pop()
            a, b = self.start[node], self.stop[node]
            if b - a <= leaf or self.radius[node] == 0.0:
                continue
            own = self.order[a:b]
            x = points[own]
            owner = np.zeros(b - a, np.int64)
            centers = [self.center[node]]
            for k in range(1, FAN_OUT):
                far = int(near.argmax())
                if near[far] == 0.0:
                    break
                centers.append(int(own[far]))
                d = np.sqrt(((x - points[own[far]]) ** 2).sum(axis=1))
                closer = d < near
                owner[closer], near = k, np.where(closer, d, near)
            by = np.argsort(owner, kind="stable")
            self.order[a:b], near, owner = own[by], near[by], owner[by]
            cuts = np.searchsorted(owner, np.arange(len(centers) + 1))
            for k, c in enumerate(centers):
                lo, hi = int(cuts[k]), int(cuts[k + 1])
                if lo < hi:
                    child = self._node(c, a + lo, a + hi, near[lo:hi])
                    self.children[node].append(child)
                    todo.append((child, near[lo:hi]))
        self.center_points = points[self.center]
        self.norm = np.sqrt((self.center_points**2).sum(axis=1))
        self.reach = np.array(self.radius)
        self.is_leaf = np.array([not c for c in self.children])

    def _node(self, center: int, start: int, stop: int, near: np.ndarray) -> int:
        self.center.append(center)
        self.radius.append(float(near.max()) if len(near) else 0.0)
        self.start.append(start)
        self.stop.append(stop)
        self.children.append([])
        return len(self.center) - 1


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of rows; by float products where they are exact."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if most < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


class Best:
    """The best k of each query so far: highest score first, ties to the smaller id."""

    def __init__(self, floor: np.ndarray, k: int):
        self.k, self.floor = k, floor.copy()  # the score that a candidate must reach
        self.score = [np.zeros(0, np.int64)] * len(floor)
        self.id = [np.zeros(0, np.int64)] * len(floor)

    def add(self, q: int, score: np.ndarray, ids: np.ndarray) -> None:
        own = score >= self.floor[q]
        if not own.any():
            return
        s, i = np.concatenate([self.score[q], score[own]]), np.concatenate([self.id[q], ids[own]])
        by = np.lexsort((i, -s))[:self.k]
        self.score[q], self.id[q] = s[by], i[by]
        if len(by) == self.k:
            self.floor[q] = max(self.floor[q], int(s[by[-1]]))


def dual_search(queries: CoverTree, q_int: np.ndarray, q_id: np.ndarray, data: CoverTree, d_int: np.ndarray, d_id: np.ndarray,
                best: Best) -> None:
    """Fill ``best`` from one data tree."""
    def floors(nodes: np.ndarray) -> np.ndarray:
        return np.array([best.floor[queries.order[queries.start[n]:queries.stop[n]]].min() for n in nodes], np.float64)

    slack = 1e-9
    qs, ds = np.zeros(1, np.int64), np.zeros(1, np.int64)
    leaves: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(qs):
        dot = np.einsum("ij,ij->i", queries.center_points[qs], data.center_points[ds])
        rq, rd = queries.reach[qs], data.reach[ds]
        bound = dot + queries.norm[qs] * rd + data.norm[ds] * rq + rq * rd
        bound += np.abs(bound) * slack + 1e-3
        nodes, at = np.unique(qs, return_inverse=True)
        own = bound >= floors(nodes)[at]
        qs, ds, bound = qs[own], ds[own], bound[own]
        end = queries.is_leaf[qs] & data.is_leaf[ds]
        if end.any():
            leaves.append((qs[end], ds[end], bound[end]))
        qs, ds = qs[~end], ds[~end]
        # the node with the larger radius opens, if it is no leaf
        by_data = ~data.is_leaf[ds] & (queries.is_leaf[qs] | (data.reach[ds] >= queries.reach[qs]))
        new_q, new_d = [], []
        for q, d, opens in zip(qs.tolist(), ds.tolist(), by_data.tolist()):
            kids = data.children[d] if opens else queries.children[q]
            new_q += [q] * len(kids) if opens else kids
            new_d += kids if opens else [d] * len(kids)
        qs, ds = np.array(new_q, np.int64), np.array(new_d, np.int64)
    if not leaves:
        return
    qs, ds, bound = map(np.concatenate, zip(*leaves))
    for leaf in np.unique(qs).tolist():
        own = np.flatnonzero(qs == leaf)
        own = own[np.argsort(-bound[own], kind="stable")]
        members = queries.order[queries.start[leaf]:queries.stop[leaf]]
        at = 0
        while at < len(own):
            if bound[own[at]] < best.floor[members].min():
                break  # bounds only fall from here
            rows, size = [], 0
            while at < len(own) and size < AT_ONCE:
                d = int(ds[own[at]])
                rows.append(data.order[data.start[d]:data.stop[d]])
                size += len(rows[-1])
                at += 1
            row = np.concatenate(rows)
            found = scores(q_int[members], d_int[row])
            for q, s in zip(members.tolist(), found):
                other = d_id[row] != q_id[q]
                best.add(q, s[other], d_id[row][other])


def _vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, v, dims``: usable vectors as integers."""
    x = F.col(vector_col).cast("array<double>")
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x")).where(
        "vec_id IS NOT NULL AND x IS NOT NULL AND forall(x, e -> e IS NOT NULL AND NOT isnan(e) AND abs(e) < double('infinity'))")
    return rows.select("vec_id", F.expr(f"transform(x, e -> CAST(floor({SCALE}D * e) AS bigint))").alias("v"), F.size("x").alias("dims"))


def _arrays(batch: pa.RecordBatch | pa.Table, dims: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.asarray(batch.column("vec_id").to_numpy(), np.int64)
    col = batch.column("v")
    flat = col.combine_chunks().flatten() if isinstance(col, pa.ChunkedArray) else col.flatten()
    return ids, np.asarray(flat.to_numpy(zero_copy_only=False), np.int64).reshape(len(ids), dims)


def top_k(table: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` of the queries (ids divisible by ``every``) against every other row."""
    spark = table.sparkSession
    ship(spark)
    scratch = Scratch(spark, "topk")
    vectors = _vectors(table, id_col, vector_col)
    queries = scratch.write(vectors.where(f"vec_id % {every} = 0").distinct(), "queries")
    found = None
    sizes = queries.groupBy("dims").count().collect()  # lengths of vectors: one as a rule
    for dims, n in sorted((r["dims"], r["count"]) for r in sizes):
        own = vectors.where(F.col("dims") == dims)
        sample = own.orderBy(F.xxhash64("vec_id", F.lit("sample")), "vec_id").limit(SAMPLE).select("vec_id", "v").toArrow()
        s_id, s_int = _arrays(sample, dims)
        blocks = -(-n // QUERY_BLOCK)
        for block in range(blocks):
            part = queries.where((F.col("dims") == dims) & (F.expr(f"pmod(xxhash64(vec_id), {blocks})") == block))
            q_id, q_int = _arrays(part.select("vec_id", "v").toArrow(), dims)
            if len(q_id):
                out = _block(own, q_id, q_int, s_id, s_int, dims, k)
                found = out if found is None else found.unionByName(out)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # a task's best k of each query: Spark drops what is past rank k before the shuffle, too
    ranked = Window.partitionBy("query_id", "block_row").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def _block(data: DataFrame, q_id: np.ndarray, q_int: np.ndarray, s_id: np.ndarray, s_int: np.ndarray, dims: int, k: int) -> DataFrame:
    floor = np.full(len(q_id), np.iinfo(np.int64).min)
    for a in range(0, len(q_id), 256):
        for i, s in enumerate(scores(q_int[a:a + 256], s_int), a):
            s = np.sort(s[s_id != q_id[i]])
            if len(s) >= k:
                floor[i] = s[-k]
    tree = CoverTree(q_int.astype(np.float64), leaf=8)
    shared = data.sparkSession.sparkContext.broadcast((tree, q_id, q_int, floor))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, q_id, q_int, floor = shared.value
        best = Best(floor, k)
        for batch in gathered(batches):
            ids, v = _arrays(batch, dims)
            dual_search(tree, q_int, q_id, CoverTree(v.astype(np.float64)), v, ids, best)
        n = [len(i) for i in best.id]
        if sum(n):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(q_id, n)), pa.array(np.repeat(np.arange(len(n)), n)), pa.array(np.concatenate(best.id)),
                 pa.array(np.concatenate(best.score))], names=["query_id", "block_row", "vec_id", "score"])

    return data.select("vec_id", "v").mapInArrow(run, "query_id long, block_row long, vec_id long, score long")
