"""Clustering around centroids, with the nearest centroid found by the threshold algorithm.

Every component has a list of the centroids sorted by their value there.  From a vector's own
value each list is walked outward, nearer side first, all lists one centroid a step.  A centroid
met for the first time gets its exact squared distance.  A centroid that no list has reached
differs in every component by at least that list's frontier, so its squared distance is at
least the sum of the squared frontier distances: the walk ends when that sum strictly exceeds the
best exact distance, which leaves ties seen, or when every centroid was met.  All arithmetic is
in integers and exact.

Rounds replace every non-empty centroid by the floor of its vectors' mean: tasks send partial
sums of the centroids only.

Vectors of another length, null ones and those with a null or non-finite component, or with an
integer of ``vectors.INTEGER_LIMIT`` or more, take no part.  Repeated rows and ids each count
and give a row; first centroids are rows in the order of their hash (null id last), then of their
components.  With fewer vectors than centroids there are as many centroids as vectors; an empty
table gives no row.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketrec.llm import vectors
from basketrec.llm.common import materialise

SCALE, DIM, CENTROIDS, ROUNDS, SEED = 64, 64, 16, 3, 1
#: Vectors walked at once.
BATCH = 4096
FAR = np.int64(1) << 30


class SortedLists:
    """Centroids (centroid, component), sorted in every component."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.k, self.d = centroids.shape
        self.order = np.argsort(centroids, axis=0, kind="stable").T
        self.values = np.take_along_axis(centroids, self.order.T, 0).T

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and squared distance of the nearest centroid of each row, ties to the smaller
        number; and how many exact distances that took."""
        found = [self._nearest(x[i:i + BATCH]) for i in range(0, len(x), BATCH)]
        best = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.int64)
        return best % self.k, best // self.k, sum(f[1] for f in found)

    def _nearest(self, x: np.ndarray) -> tuple[np.ndarray, int]:
        n, component = len(x), np.arange(self.d)
        right = np.stack([np.searchsorted(self.values[j], x[:, j]) for j in component], 1)
        left = right - 1
        met = np.zeros((n, self.k), bool)
        best = np.full(n, np.iinfo(np.int64).max)
        live, exact = np.arange(n), 0
        while len(live):
            gap_l = np.where(left >= 0, x - self.values[component, np.maximum(left, 0)], FAR)
            gap_r = np.where(right < self.k, self.values[component, np.minimum(right, self.k - 1)] - x, FAR)
            go_left = gap_l <= gap_r
            centroid = self.order[component, np.where(go_left, left, right)]
            now = np.zeros_like(met)
            now[np.arange(len(live))[:, None], centroid] = True
            row, c = np.nonzero(now & ~met)
            exact += len(row)
            dist = ((x[row] - self.centroids[c]) ** 2).sum(1) * self.k + c
            if len(row):
                first = np.flatnonzero(np.diff(row, prepend=-1))
                at = live[row[first]]
                best[at] = np.minimum(best[at], np.minimum.reduceat(dist, first))
            met |= now
            frontier = (np.minimum(gap_l, gap_r) ** 2).sum(1)
            on = (frontier <= best[live] // self.k) & ~met.all(1)
            left, right = left - go_left, right + ~go_left
            live, x, left, right, met = (a[on] for a in (live, x, left, right, met))
        return best, exact


def _move(centroids: np.ndarray):
    def run(batches):
        lists = SortedLists(centroids)
        sums, counts = np.zeros((1, *centroids.shape), np.int64), np.zeros((1, len(centroids)), np.int64)
        for rb in batches:
            if rb.num_rows:
                q = vectors.matrix(rb.column(0)).astype(np.int64)
                c, _, _ = lists.nearest(q)
                counts[0] += np.bincount(c, minlength=lists.k)
                np.add.at(sums[0], c, q)
        if counts.any():
            yield vectors.partial_sums(sums, counts)

    return run


def _assign(centroids: np.ndarray):
    def run(batches):
        lists = SortedLists(centroids)
        for rb in batches:
            if rb.num_rows:
                c, dist, _ = lists.nearest(vectors.matrix(rb.column(1)).astype(np.int64))
                yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(c, pa.int32()), pa.array(dist)], names=["vec_id", "cluster", "distance"])

    return run


def train(rows: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED) -> np.ndarray:
    """Centroids of ``rows`` (vec_id, q of one length)."""
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = rows.orderBy(draw.asc_nulls_last(), "q").select("q").limit(k).collect()
    centroids = np.array([r.q for r in first], np.int64)
    for _ in range(rounds if first else 0):
        moved = vectors.floor_means(rows.select("q").mapInArrow(_move(centroids), vectors.PARTIAL_SCHEMA), centroids.size)
        for (_, c), mean in moved.items():
            centroids[c] = mean
    return centroids


def assign(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of ``rows`` (vec_id, q)."""
    schema = "vec_id long, cluster int, distance long"
    if not len(centroids):
        return rows.sparkSession.createDataFrame([], schema)
    return rows.mapInArrow(_assign(centroids), schema)


def op12_query(embeddings: DataFrame) -> DataFrame:
    rows = materialise(vectors.quantised(embeddings, SCALE).filter(F.size("q") == DIM), "quantised")
    centroids = train(rows)
    found = materialise(assign(rows, centroids), "assigned")
    # at most one row a centroid
    of_cluster = {r.cluster: r.inertia for r in found.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    total = sum(of_cluster.values())
    table = [(c, of_cluster[c], total, hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c in sorted(of_cluster)]
    facts = found.sparkSession.createDataFrame(table, "__cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), F.col("cluster") == F.col("__cluster")).drop("__cluster")


def _round_sql(n: int) -> str:
    return f"""
d{n} AS (SELECT q.vec_id, c.cluster, sum((q.v - c.c) * (q.v - c.c)) AS dist FROM q JOIN c{n} c ON q.j = c.j GROUP BY q.vec_id, c.cluster),
a{n} AS (SELECT vec_id, cluster, dist FROM d{n} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY dist, cluster) = 1)"""


def _move_sql(n: int) -> str:
    return f"""
m{n} AS (SELECT a.cluster, q.j, CAST(floor(sum(q.v) / count(*)) AS BIGINT) AS c FROM q JOIN a{n} a ON q.vec_id = a.vec_id GROUP BY a.cluster, q.j),
c{n + 1} AS (SELECT c.cluster, c.j, coalesce(m.c, c.c) AS c FROM c{n} c LEFT JOIN m{n} m ON c.cluster = m.cluster AND c.j = m.j)"""


OP12_SQL = f"""
WITH kept AS (SELECT vec_id, embedding FROM embeddings
              WHERE embedding IS NOT NULL AND len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT vec_id, j, CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) AS v
      FROM (SELECT vec_id, generate_subscripts(embedding, 1) AS j, unnest(embedding) AS x FROM kept)),
first AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS cluster FROM kept QUALIFY cluster < {CENTROIDS}),
c0 AS (SELECT f.cluster, q.j, q.v AS c FROM q JOIN first f ON q.vec_id = f.vec_id),
{",".join(_round_sql(n) + "," + _move_sql(n) for n in range(ROUNDS))},{_round_sql(ROUNDS)},
h AS (SELECT cluster, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY j)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY cluster)
SELECT a.vec_id, CAST(a.cluster AS INTEGER) AS cluster, CAST(a.dist AS BIGINT) AS distance,
       CAST(sum(a.dist) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(a.dist) OVER () AS BIGINT) AS inertia, h.centroid_sha256
FROM a{ROUNDS} a JOIN h ON a.cluster = h.cluster"""
