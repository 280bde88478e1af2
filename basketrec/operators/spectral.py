"""Latent semantic factors of the co-occurrence matrix, by randomised subspace iteration.

The matrix stays the long table of its pairs.  A block of ``rank + oversample`` directions is one
short array per product.  Each step multiplies it by the matrix (a join of the pairs with the
arrays on the right product, and as many sums per left product, combined before the shuffle),
where large blocks meet pairs that were dealt by the right product once, not in each step,
and makes the result orthonormal through its small Gram matrix.  Only such small matrices reach
the driver, and no products-by-products object exists.  Steps end when the leading Ritz values
settle.

The co-occurrence matrix is symmetric, so its singular values are the absolute Ritz values and its
singular vectors the Ritz vectors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketrec.functions.dense import inner_products, multiplied
from basketrec.operators.similarity import L, R
from basketrec.plans.broadcast import UNKNOWN, estimated_bytes
from basketrec.plans.staging import Staging
from basketrec.session import shuffles_freed
from basketrec.sources.bucketed import BucketedTable

#: Directions are broadcast to the pairs up to this many bytes, else joined by a shuffle of pairs into
#: parts of ``PART_BYTES``, no fewer than cores.  Few parts: each gives one partial sum a product.
BROADCAST_BYTES, PART_BYTES = 16 << 20, 256 << 20
#: Directions of a part that are looked up in memory; more are merged in their order.
LOOKED_UP_BYTES = 64 << 20


@dataclass
class LatentFactors:
    """``factors``: (product_id, vector), singular vectors scaled by the root of their value;
    ``values``: singular values, largest first; ``steps``: multiplications by the matrix."""

    factors: DataFrame
    values: list[float]
    steps: int


def _few(rows: int, width: int) -> bool:
    return rows * (8 * width + 32) <= BROADCAST_BYTES


def with_product(thin: DataFrame, product: DataFrame, rows: int, width: int) -> DataFrame:
    """``thin`` with the ``product`` of a matrix and it.  The hint keeps Spark from a broadcast by the size of
    the written table, which is many times smaller than the block where its numbers repeat."""
    return (thin if _few(rows, width) else thin.hint("merge")).join(product, "id")


def _parts(pairs: DataFrame) -> int:
    size, cores = estimated_bytes(pairs), pairs.sparkSession.sparkContext.defaultParallelism
    return max(cores, size // PART_BYTES) if size < UNKNOWN else cores


def times(pairs: DataFrame, thin: DataFrame, width: int, row: str, col: str, value: str, rows: int, buckets: int | None = None) -> DataFrame:
    """(id, y): the matrix of ``pairs`` times the block ``thin`` (id, v) of ``rows`` rows; ``buckets``: those of
    ``pairs`` by ``col``, if it is so dealt."""
    side = thin.select(F.col("id").alias(col), "v")
    cells = pairs.select(row, col, F.col(value).cast("double").alias(value))
    if _few(rows, width):
        side = F.broadcast(side)
    else:
        parts = buckets or _parts(pairs)
        how = "shuffle_hash" if rows * (16 * width + 128) <= parts * LOOKED_UP_BYTES else "merge"
        cells, side = cells if buckets else cells.repartition(parts, col), side.repartition(parts, col).hint(how)
    sums = [F.sum(F.col(value) * F.col("v")[j]).alias(f"y{j}") for j in range(width)]
    summed = cells.join(side, col).groupBy(row).agg(*sums)
    return summed.select(F.col(row).alias("id"), F.array(*[f"y{j}" for j in range(width)]).alias("y"))


def _orthonormal(gram: np.ndarray) -> np.ndarray:
    """W with W' gram W = 1, over the directions that are not numerically zero."""
    size, w = np.linalg.eigh((gram + gram.T) / 2)
    keep = size > size[-1] * 1e-13
    return w[:, keep] / np.sqrt(size[keep])


def latent_factors(pairs: DataFrame, rank: int = 16, row: str = L, col: str = R, value: str = "cooccurances",
                   oversample: int = 8, max_steps: int = 30, tolerance: float = 1e-5, seed: int = 1, written: bool = False) -> LatentFactors:
    """Leading factors of the symmetric matrix ``pairs`` (both orders of every pair, one row a cell).

    Starting directions are signs drawn by a hash of seed, product and column, so a repeated
    task draws the same.  A matrix of lower rank gives fewer values; an empty one gives none.  ``written``:
    ``pairs`` is a written table."""
    spark, stage = pairs.sparkSession, Staging(pairs.sparkSession, "latent")
    steps = Staging(spark, "latent")
    pairs = pairs.select(row, col, value) if written else stage.write(pairs.select(row, col, value), "pairs")
    sign = lambda j: F.when(F.xxhash64(F.lit(seed), F.lit(j), "id") < 0, -1.0).otherwise(1.0)
    width = rank + oversample
    ids = pairs.select(F.col(row).alias("id")).distinct()
    thin = stage.write(ids.select("id", F.array(*map(sign, range(width))).alias("v")), "start")
    n = thin.count()
    if not n:
        return LatentFactors(spark.createDataFrame([], f"product_id {pairs.schema[row].dataType.simpleString()}, vector array<double>"), [], 0)
    w = _orthonormal(inner_products(thin, [("v", "v")], width)[0])
    dealt = None if _few(n, width) else BucketedTable(pairs, [col], _parts(pairs))
    buckets = dealt and dealt.buckets
    if dealt:
        pairs = dealt.read()
        stage.paths.append(dealt.path)
        stage.drop_older(2)  # "start" and the dealt pairs
    before, ritz = None, None
    for step in range(1, max_steps + 1):
        thin = multiplied(thin, "v", w, "v")
        width = w.shape[1]
        state = steps.write(with_product(thin, times(pairs, thin, width, row, col, value, n, buckets), n, width), f"step{step}")
        steps.drop_older(1)
        unit, mixed, gram = inner_products(state, [("v", "v"), ("v", "y"), ("y", "y")], width)
        own = _orthonormal(unit)
        ritz, turn = np.linalg.eigh(own.T @ (mixed + mixed.T) @ own / 2)
        order = np.argsort(-np.abs(ritz), kind="stable")[:rank]
        ritz, turn = ritz[order], own @ turn[:, order]
        if before is not None and len(before) == len(ritz) and (np.abs(ritz - before) <= tolerance * np.abs(ritz)).all():
            break
        before, w = ritz, _orthonormal(gram)
        thin = state.select("id", F.col("y").alias("v"))
    keep = np.abs(ritz) > np.abs(ritz).max() * 1e-12
    values = np.abs(ritz[keep])
    made = steps.write(multiplied(state.select("id", "v"), "v", turn[:, keep] * np.sqrt(values), "vector"), "factors")
    steps.drop_older(1)
    if dealt:
        dealt.drop()
    stage.drop_older(0)
    return LatentFactors(made.select(F.col("id").alias("product_id"), "vector"), values.tolist(), step)


def eigen_residuals(pairs: DataFrame, found: LatentFactors, row: str = L, col: str = R, value: str = "cooccurances", written: bool = False) -> DataFrame:
    """(component, value, norm, residual) of each factor: its singular value, the length of its
    singular vector, and the length of matrix times vector minus value times vector, over value."""
    width = len(found.values)
    if not width:
        return pairs.sparkSession.createDataFrame([], "component int, value double, norm double, residual double")
    unit = F.transform("vector", lambda x, i: x / F.sqrt(F.array(*map(F.lit, found.values))[i]))
    thin = found.factors.select(F.col("product_id").alias("id"), unit.alias("v"))
    n, stage = thin.count(), Staging(pairs.sparkSession, "residuals")
    pairs = pairs if written else stage.write(pairs.select(row, col, value), "pairs")  # of known size
    state = with_product(thin, times(pairs, thin, width, row, col, value, n), n, width)
    with shuffles_freed(pairs.sparkSession):
        vv, vy, yy = inner_products(state, [("v", "v"), ("v", "y"), ("y", "y")], width)
    stage.drop_older(0)
    rows = []
    for j, s in enumerate(found.values):
        sign = 1.0 if vy[j, j] >= 0 else -1.0
        gap = yy[j, j] - 2 * sign * s * vy[j, j] + s * s * vv[j, j]
        rows.append((j + 1, s, float(np.sqrt(vv[j, j])), float(np.sqrt(max(gap, 0.0)) / s)))
    return pairs.sparkSession.createDataFrame(rows, "component int, value double, norm double, residual double")
