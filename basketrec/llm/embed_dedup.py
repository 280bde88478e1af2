"""Embedding near-duplicates by cross-polytope hashing with multiprobe buckets.

Each of TABLES hash tables turns a vector by two pseudo-random rotations (three
rounds of random signs and a fast Hadamard transform each); the nearest signed axes
of both make its bucket.  A vector is stored in its bucket and visits the next
PROBES - 1 likely ones.  Within a bucket the stored vectors are compared with each
other and with the visitors by cosine in double precision.

Links are not written out as pairs.  A pair that meets in several buckets counts in
the first of them only (the codes of both vectors tell), so numbers of links add up
exactly, and each tile of comparisons passes on its vectors' link counts and a
spanning forest of its links.  Equal vectors are one class with a multiplicity.
Buckets of more than TILE vectors are cut into a grid of tiles, every pair of blocks
in a tile of its own, so no bucket is a single task and none is capped.

Vectors that are null, zero, or hold null or non-finite components link with nothing
(0 links, a component of their own, kept); so do vectors of different lengths.
Repeated rows count as other vectors of the same id; rows without an id take part,
with a null component unless linked to one with an id.  Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketrec.llm.common import materialise
from basketrec.llm.components import connected_components
from basketrec.llm.vectors import valid

THRESHOLD = 0.95
TABLES, PROBES, SEED = 8, 4, 1
TILE = 1024
AXES = 5  # axes of each rotation that are tried for probes


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, scaled to keep lengths."""
    m, h = x.shape[1], 1
    while h < m:
        x = x.reshape(-1, m // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(-1, m)
        h *= 2
    return x / np.sqrt(m)


def codes(unit: np.ndarray, table: int, probes: int) -> np.ndarray:
    """Buckets of unit vectors in a table, own bucket first, then by likelihood."""
    m = 1 << max(1, int(np.ceil(np.log2(unit.shape[1]))))
    x = np.zeros((len(unit), m))
    x[:, :unit.shape[1]] = unit
    axes, loss = [], []
    for k in range(2):
        signs = np.random.default_rng([SEED, table, k, m]).choice([-1.0, 1.0], (3, m))
        z = x
        for s in signs:
            z = hadamard(z * s)
        both = np.concatenate([z, -z], axis=1)
        top = np.argsort(-both, axis=1, kind="stable")[:, :AXES]
        v = np.take_along_axis(both, top, 1)
        axes.append(top)
        loss.append((v[:, :1] - v) ** 2)
    cost = (loss[0][:, :, None] + loss[1][:, None, :]).reshape(len(x), -1)
    code = (axes[0][:, :, None] * (2 * m) + axes[1][:, None, :]).reshape(len(x), -1)
    return np.take_along_axis(code, np.argsort(cost, axis=1, kind="stable")[:, :probes], 1)


def _hash(tables, probes):
    def run(batches):
        for rb in batches:
            vecs = [np.asarray(v, float) for v in rb.column(1).to_pylist()]
            out = [None] * len(vecs)
            dims = np.array([len(v) for v in vecs])
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                x = np.array([vecs[i] for i in at])
                x /= np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                c = np.concatenate([codes(x, t, probes) for t in range(tables)], axis=1).astype("<i8")
                for i, row in zip(at, c):
                    out[i] = row
            yield pa.RecordBatch.from_arrays(
                [rb.column(0), pa.array(dims, pa.int32()), pa.array([v.astype("<f8").tobytes() for v in vecs], pa.binary()), rb.column(2),
                 pa.array([c.tolist() for c in out], pa.list_(pa.int64()))], names=["id", "dim", "vec", "copies", "codes"])

    return run


def _union(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest member of each of n nodes' component under links (i, j)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _compare(threshold, tables, probes):
    """Sorted rows of tiles -> (id, links) with other null and (id, other) forest edges."""
    def tile(ids, copies, vecs, codes_, stored, block, t, code, x, y):
        v = np.frombuffer(b"".join(vecs), "<f8").reshape(len(ids), -1)
        v = v / np.abs(v).max(axis=1, keepdims=True)
        v = v / np.linalg.norm(v, axis=1, keepdims=True)
        one = np.flatnonzero(stored & (block == x))
        two = np.flatnonzero(block == y) if x != y else np.arange(len(ids))
        rest = np.flatnonzero(stored & (block == y)) if x != y else one[:0]
        back = np.flatnonzero(~stored & (block == x)) if x != y else one[:0]
        found = []
        for left, right in ((one, two), (rest, back)):
            for at in range(0, len(left), 256):
                part = left[at:at + 256]
                i, j = np.nonzero(v[part] @ v[right].T >= threshold)
                found.append((part[i], right[j]))
        i, j = (np.concatenate(f) for f in zip(*found))
        # within a block two stored vectors meet in both orders, across blocks in one
        ok = ~(stored[i] & stored[j] & (ids[i] >= ids[j])) if x == y else ids[i] != ids[j]
        i, j = i[ok], j[ok]
        if not len(i):
            return
        # the first table, and there the first of at most two buckets, in which the pair meets
        small, large = np.where(ids[i] < ids[j], i, j), np.where(ids[i] < ids[j], j, i)
        keep = np.ones(len(i), bool)
        for u in range(t + 1):
            mine = codes_[:, u * probes:(u + 1) * probes]
            meets = (mine[small, :1] == mine[large]).any(axis=1)
            other = (mine[large, :1] == mine[small]).any(axis=1)
            if u < t:
                keep &= ~(meets | other)
            else:
                keep &= np.where(meets, mine[small, 0], mine[large, 0]) == code
        i, j = i[keep], j[keep]
        links = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        root = order[_union(len(ids), place[i], place[j])][place]
        for k in np.flatnonzero(links):
            yield int(ids[k]), int(links[k]), int(ids[root[k]]) if root[k] != k else None

    def run(batches):
        held = None
        for rb in batches:
            now = pa.Table.from_batches([rb])
            held = now if held is None else pa.concat_tables([held, now])
            key = [held[c].to_numpy() for c in ("t", "code", "dim", "x", "y")]
            cut = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1
            if len(cut):
                yield from emit(held.slice(0, cut[-1]))
                held = held.slice(cut[-1])
        if held is not None and len(held):
            yield from emit(held)

    def emit(rows):
        rows = rows.combine_chunks()
        key = [rows[c].to_numpy() for c in ("t", "code", "dim", "x", "y")]
        cut = [0, *(np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1).tolist(), len(rows)]
        ids, copies, block = (rows[c].to_numpy() for c in ("id", "copies", "block"))
        stored, vecs = rows["stored"].to_numpy(zero_copy_only=False), rows["vec"].to_pylist()
        table = rows["codes"].combine_chunks().flatten().to_numpy().reshape(len(rows), -1)
        out = []
        for lo, hi in zip(cut[:-1], cut[1:]):
            if hi - lo > 1 and stored[lo:hi].any():
                t, code, _, x, y = (int(k[lo]) for k in key)
                out += tile(ids[lo:hi], copies[lo:hi], vecs[lo:hi], table[lo:hi], stored[lo:hi], block[lo:hi], t, code, x, y)
        cols = list(zip(*out)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["id", "links", "other"])

    return run


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors`` (vec_id, embedding)."""
    rows = valid(vectors)
    same = rows.groupBy("v").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    # the class of equal vectors goes by a hash of its components, so ids may be null or repeat
    same = materialise(same.select(F.xxhash64("v").alias("id"), "v", "copies", "least"), "near-classes")
    hashed = materialise(same.select("id", "v", "copies").mapInArrow(_hash(tables, probes), "id long, dim int, vec binary, copies long, codes array<long>"), "near-hashed")
    own = hashed.select("id", "dim", F.posexplode("codes").alias("p", "code")).select(
        "id", "dim", "code", F.expr(f"p div {probes}").cast("int").alias("t"), (F.col("p") % probes == 0).alias("stored"))
    crowd = own.groupBy("t", "code", "dim").agg(F.count("*").alias("n"), F.max("stored").alias("any")).filter(f"any and n > {TILE}")
    crowd = materialise(crowd.select("t", "code", "dim", F.ceil(F.col("n") / TILE).cast("int").alias("blocks")), "near-crowds")
    member = own.join(crowd, ["t", "code", "dim"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    member = member.withColumn("block", F.pmod(F.xxhash64("id", "t"), F.col("blocks")).cast("int"))
    member = member.withColumn("s", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    member = member.select("id", "t", "code", "dim", "stored", "block", F.least("block", "s").alias("x"), F.greatest("block", "s").alias("y"))
    tiles = member.join(hashed.select("id", "vec", "copies", "codes"), "id")
    n = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tiles = tiles.select("t", "code", "dim", "x", "y", "block", "stored", "id", "vec", "copies", "codes").repartition(n, "t", "code", "dim", "x", "y")
    tiles = tiles.sortWithinPartitions("t", "code", "dim", "x", "y")
    found = materialise(tiles.mapInArrow(_compare(threshold, tables, probes), "id long, links long, other long"), "near-links")

    comp = connected_components(found.filter("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b")))
    count = found.groupBy("id").agg(F.sum("links").alias("links"))
    groups = same.select("id", "copies", "least").join(count, "id", "left").join(comp, F.col("id") == F.col("node"), "left")
    groups = materialise(groups.select("id", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "id").alias("group")), "near-groups")
    low = groups.groupBy("group").agg(F.min("least").alias("component"))
    groups = groups.join(low, "group").select(F.col("id").alias("class"), "n_links", "component")
    every = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.expr("cast(embedding as array<double>)").alias("v"))
             .withColumn("class", F.xxhash64("v")))
    out = every.select("vec_id", "class").join(groups, "class", "left")
    linked = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), linked.alias("component_id"),
                      F.coalesce(F.col("vec_id") == linked, F.lit(True)).alias("kept"))
