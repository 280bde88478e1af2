"""Approximate nearest neighbours by learned partitions.

On a bounded sample: a k-nearest-neighbour graph, cut into PARTS balanced parts
(random-direction halvings, then moves of nodes to the part of most of their
neighbours while sizes stay balanced), and a small neural classifier that learns a
vector's part.  The number of parts a query visits is the smallest with which held-out
sample queries find TARGET of their true neighbours.

All vectors are then assigned to their most probable part, all queries go to their
most probable parts, and candidates are reranked by exact distance in double precision.
A query visits further parts, in the order of their probability, until those visited hold k
candidates besides its own rows.  Parts of more than CHUNK vectors are cut into chunks and
their queries into blocks of about BLOCK, each pair a task of its own, and each passes on its
ten nearest per query only.  The number of parts grows with the root of the table.

Vectors that are null, zero, or hold null or non-finite components, or whose length is
not the most frequent one, take no part.  Rows with a query's id are its own and no
candidates; a repeated query id asks with the smallest of its vectors; rows without an id take
no part; repeated rows of a candidate are separate candidates.  Fewer candidates than k give all of them; extra columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketrec.llm.common import materialise, smallest_draws
from basketrec.llm.vectors import matrix, valid

K = 10
#: Bound of the sample, and the settings of graph, classifier and search.
MAX_SAMPLE = 6000
PARTS, MAX_PARTS, NEIGHBOURS, BALANCE = 32, 256, 10, 1.1
HIDDEN, EPOCHS, BATCH, RATE = 128, 12, 128, 0.003
TARGET = 0.96
CHUNK, BLOCK = 4096, 2048


def knn(x: np.ndarray, queries: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k nearest other rows of x for rows ``queries``, by blocks."""
    norm, out = (x ** 2).sum(axis=1), []
    for at in range(0, len(queries), 512):
        q = queries[at:at + 512]
        d = norm[None, :] - 2 * x[q] @ x.T
        d[np.arange(len(q)), q] = np.inf
        out.append(np.argpartition(d, min(k, len(x) - 1) - 1, axis=1)[:, :k])
    return np.concatenate(out)


def partition_graph(x: np.ndarray, graph: np.ndarray, parts: int, rng) -> np.ndarray:
    """A balanced part for each node with few cut edges."""
    part = np.zeros(len(x), np.int64)
    groups = [np.arange(len(x))]
    while len(groups) < parts:
        big = groups.pop(int(np.argmax([len(g) for g in groups])))
        a, b = x[rng.choice(big, 2)]
        order = big[np.argsort(x[big] @ (a - b), kind="stable")]
        groups += [order[:len(order) // 2], order[len(order) // 2:]]
    for p, g in enumerate(groups):
        part[g] = p
    size, most = np.bincount(part, minlength=parts), int(np.ceil(BALANCE * len(x) / parts))
    near = [[] for _ in range(len(x))]
    for i, row in enumerate(graph.tolist()):
        for j in row:
            near[i].append(j)
            near[j].append(i)
    for _ in range(6):
        moved = 0
        for i in rng.permutation(len(x)):
            votes = np.bincount(part[near[i]], minlength=parts)
            own, best = part[i], int(np.argmax(np.where(size < most, votes, -1)))
            if votes[best] > votes[own] and size[own] > 1:
                part[i], moved = best, moved + 1
                size[own] -= 1
                size[best] += 1
        if not moved:
            break
    return part


@dataclass
class Router:
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    scale: float
    visits: int

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x * self.scale @ self.w1 + self.b1, 0) @ self.w2 + self.b2


def train_router(x: np.ndarray, graph: np.ndarray, part: np.ndarray, parts: int, rng) -> Router:
    """Two-layer classifier by Adam; the target of a vector is the mix of its neighbours' parts and its own."""
    target = np.zeros((len(x), parts))
    for col in graph.T:
        np.add.at(target, (np.arange(len(x)), part[col]), 0.5 / graph.shape[1])
    target[np.arange(len(x)), part] += 0.5
    scale = float(np.sqrt(x.shape[1] / max((x ** 2).sum(axis=1).mean(), 1e-300)))
    z = x * scale
    p = [rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, parts)), np.zeros(parts)]
    m, v, step = [0 * a for a in p], [0 * a for a in p], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for at in range(0, len(order), BATCH):
            rows = order[at:at + BATCH]
            h = np.maximum(z[rows] @ p[0] + p[1], 0)
            o = h @ p[2] + p[3]
            e = np.exp(o - o.max(axis=1, keepdims=True))
            g = (e / e.sum(axis=1, keepdims=True) - target[rows]) / len(rows)
            back = (g @ p[2].T) * (h > 0)
            step += 1
            for i, d in enumerate((z[rows].T @ back, back.sum(axis=0), h.T @ g, g.sum(axis=0))):
                m[i], v[i] = 0.9 * m[i] + 0.1 * d, 0.999 * v[i] + 0.001 * d * d
                p[i] = p[i] - RATE * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
    return Router(*p, scale, parts)


def fit(x: np.ndarray, seed: int = 9, parts: int = PARTS) -> Router:
    """Router of a sample; a tenth of it only measures the visits needed."""
    rng = np.random.default_rng(seed)
    parts = max(1, min(parts, len(x) // 8))
    held = np.zeros(len(x), bool)
    held[rng.permutation(len(x))[:len(x) // 10]] = True
    own = x[~held] if held.any() else x
    graph = knn(own, np.arange(len(own)), min(NEIGHBOURS, max(1, len(own) - 1)))
    router = train_router(own, graph, partition_graph(own, graph, parts, rng), parts, rng)
    if held.any():
        q = np.flatnonzero(held)
        true = knn(x, q, min(K, len(x) - 1))
        logits = router.logits(x)
        home = logits.argmax(axis=1)
        rank = np.argsort(np.argsort(-logits[q], axis=1), axis=1)
        need = np.take_along_axis(rank, home[true], 1).ravel()
        router.visits = min(parts, int(np.quantile(need, TARGET, method="higher")) + 1)
    return router


def _home(router):
    """Rows with their most probable part."""
    def run(batches):
        for rb in batches:
            if rb.num_rows:
                part = router.logits(matrix(rb.column(1))).argmax(axis=1)
                yield pa.RecordBatch.from_arrays([rb.column(0), rb.column(1), pa.array(part, pa.int32())], names=["vec_id", "v", "part"])

    return run


def _route(router, sizes: np.ndarray, k: int):
    """Queries with the parts they visit: the first ones, and more until they hold ``k`` rows
    besides those of the query's own id (``own``)."""
    def run(batches):
        for rb in batches:
            if rb.num_rows:
                order = np.argsort(-router.logits(matrix(rb.column(1))), axis=1, kind="stable")
                short = np.cumsum(sizes[order], axis=1) < (k + rb.column(2).to_numpy())[:, None]
                count = np.minimum(np.maximum(short.sum(axis=1) + 1, router.visits), order.shape[1])
                parts = [row[:n] for row, n in zip(order.tolist(), count.tolist())]
                yield pa.RecordBatch.from_arrays([rb.column(0), rb.column(1), pa.array(parts, pa.list_(pa.int32()))], names=["vec_id", "v", "parts"])

    return run


def _nearest(k):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out = []
        if len(rows) and len(queries):
            ids, x = rows["vec_id"].to_numpy(), matrix(rows["v"])
            norm = (x ** 2).sum(axis=1)
            for q, y in zip(queries["vec_id"].to_pylist(), matrix(queries["v"])):
                rough = norm - 2 * (x @ y) + y @ y
                rough[ids == q] = np.inf
                keep = np.flatnonzero(np.isfinite(rough))
                if len(keep) > k:  # all that could be among the k nearest in exact arithmetic
                    edge = np.partition(rough, k - 1)[k - 1]
                    keep = np.flatnonzero(rough <= edge + 1e-9 * (norm.max() + y @ y))
                exact = np.sqrt(((x[keep] - y) ** 2).sum(axis=1))
                best = np.lexsort((ids[keep], exact))[:k]
                out += [(q, int(ids[keep[b]]), float(exact[b])) for b in best]
        cols = list(zip(*out)) or [(), (), ()]
        return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64()))], names=["query_id", "vec_id", "score"])

    return run


def search(vectors: DataFrame, is_query, k: int = K, seed: int = 9) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest found of each row where ``is_query``."""
    rows = valid(vectors).filter("vec_id is not null")
    dims = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    empty = "query_id long, rank int, vec_id long, score double"
    if dims is None:
        return vectors.sparkSession.createDataFrame([], empty)
    rows = rows.filter(F.size("v") == dims["d"])
    sample = smallest_draws(rows.withColumn("draw", F.xxhash64(F.lit(seed), "vec_id")), "draw", MAX_SAMPLE, "vec_id")
    x = matrix(sample["v"])
    if len(x) < 2:
        return vectors.sparkSession.createDataFrame([], empty)
    router = fit(x, seed, min(MAX_PARTS, max(PARTS, math.isqrt(rows.count()) // 4)))
    index = materialise(rows.mapInArrow(_home(router), "vec_id long, v array<double>, part int"), "ann-index")
    # one row per part, and there are at most MAX_PARTS
    held = {r["part"]: r["count"] for r in index.groupBy("part").count().collect()}
    sizes = np.array([held.get(p, 0) for p in range(len(router.b2))])
    asked = rows.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v"), F.count("*").alias("own"))
    asked = materialise(asked.mapInArrow(_route(router, sizes, k), "vec_id long, v array<double>, parts array<int>"), "ann-queries")
    asked = asked.select("vec_id", "v", F.explode("parts").alias("part"))
    met = {r["part"]: r["count"] for r in asked.groupBy("part").count().collect()}
    cuts = [(p, -(-held[p] // CHUNK), -(-met.get(p, 1) // BLOCK)) for p in held]
    cuts = F.broadcast(vectors.sparkSession.createDataFrame(cuts, "part int, chunks int, blocks int"))
    place = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = index.join(cuts, "part").withColumn("chunk", place("chunks")).withColumn("block", each("blocks"))
    right = asked.join(cuts, "part").withColumn("block", place("blocks")).withColumn("chunk", each("chunks"))
    keys = ["part", "chunk", "block"]
    near = (left.select(*keys, "vec_id", "v").groupBy(*keys)
            .cogroup(right.select(*keys, "vec_id", "v").groupBy(*keys)).applyInArrow(_nearest(k), "query_id long, vec_id long, score double"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_query(vectors: DataFrame) -> DataFrame:
    return search(vectors, F.col("vec_id") % 100 == 0)
