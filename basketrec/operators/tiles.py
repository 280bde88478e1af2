"""A sparse matrix as a table of tiles.

Rows and columns are dealt to blocks by a hash of their ids; a tile holds the cells of one block
of rows and one of columns as three arrays, sorted by row and column.  A row with very many cells,
such as a huge basket, or a column, such as a product in every basket, spreads over all
tiles of its block, and none holds more than the cells of its ids.

``gram`` multiplies the matrix by its own transpose from the left: every two column blocks meet
within each block of rows, a task a pair of tiles, and the partial products are summed by
cell.  ``l1_rows`` divides by the row sums, which are sums over tiles first.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketrec.functions.dense import importable

#: Cells that a tile holds on average, cells of a row in one block of columns, and products of cells formed
#: at once within a task.
CELLS, ROW_CELLS, PAIRS = 200_000, 1_000, 2_000_000


def _block(column, blocks: int):
    return F.pmod(F.xxhash64(column), F.lit(blocks)).cast("int")


def tiled(long: DataFrame, row: str, col: str, value: str, row_blocks: int | None = None, col_blocks: int | None = None) -> DataFrame:
    """(row_block, col_block, rows, cols, values) of the cells (row, col, value); ids are longs, cells with a
    null id are left out, values of repeated cells are summed.  By default tiles hold
    ``CELLS`` cells.  Every block of columns meets every other in ``gram``, so there are as many only as the
    longest row needs for ``ROW_CELLS`` cells in each, and no more than blocks of rows."""
    cells = long.where(F.col(row).isNotNull() & F.col(col).isNotNull())
    cells = cells.groupBy(F.col(row).cast("long").alias("r"), F.col(col).cast("long").alias("c")).agg(F.sum(F.col(value).cast("double")).alias("v"))
    if row_blocks is None or col_blocks is None:
        size = cells.groupBy("r").agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n").alias("all"), F.max("n").alias("most")).first()
        n = -(-(size["all"] or 0) // CELLS)
        col_blocks = col_blocks or max(1, min(math.isqrt(n), -(-(size["most"] or 0) // ROW_CELLS)))
        row_blocks = row_blocks or max(1, -(-n // col_blocks))
    placed = cells.select(_block("r", row_blocks).alias("row_block"), _block("c", col_blocks).alias("col_block"), F.struct("r", "c", "v").alias("cell"))
    tiles = placed.groupBy("row_block", "col_block").agg(F.array_sort(F.collect_list("cell")).alias("cells"))
    return tiles.select("row_block", "col_block", F.col("cells.r").alias("rows"), F.col("cells.c").alias("cols"), F.col("cells.v").alias("values"))


def cells_of(tiles: DataFrame, row: str, col: str, value: str) -> DataFrame:
    """The cells of a tiled matrix in long form."""
    return tiles.select(F.inline(F.arrays_zip("rows", "cols", "values"))).toDF(row, col, value)


def _summed(left: np.ndarray, right: np.ndarray, value: np.ndarray):
    order = np.lexsort((right, left))
    left, right, value = left[order], right[order], value[order]
    first = np.flatnonzero(np.r_[True, (left[1:] != left[:-1]) | (right[1:] != right[:-1])]) if len(left) else np.zeros(0, np.int64)
    return left[first], right[first], np.add.reduceat(value, first) if len(first) else value


def tile_product(r1: np.ndarray, c1: np.ndarray, v1: np.ndarray, r2: np.ndarray, c2: np.ndarray, v2: np.ndarray):
    """Cells (column of the first, column of the second, sum over rows) of two tiles of the same rows,
    both sorted by row; about ``PAIRS`` products are formed at once."""
    lo, hi = np.searchsorted(r2, r1, "left"), np.searchsorted(r2, r1, "right")
    size = hi - lo
    cuts = np.searchsorted(np.cumsum(size), np.arange(PAIRS, int(size.sum()) + PAIRS, PAIRS))
    held: list[tuple] = []
    for part in np.split(np.arange(len(r1)), np.unique(cuts[cuts < len(r1)]) + 1):
        n = size[part]
        if n.sum():
            a = np.repeat(part, n)
            b = np.repeat(lo[part] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            held = [_summed(*(np.concatenate(x) for x in zip(*held, (c1[a], c2[b], v1[a] * v2[b]))))]
    return held[0] if held else (c1[:0], c1[:0], v1[:0])


def _products(batches):
    for rb in batches:
        for x, y, a, b in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist(), rb.column(2), rb.column(3)):
            left, right, value = tile_product(*(t[k].values.to_numpy() for t in (a, b) for k in ("rows", "cols", "values")))
            if x < y:  # tiles of different columns: the other order of every pair, too
                left, right, value = np.r_[left, right], np.r_[right, left], np.r_[value, value]
            yield pa.RecordBatch.from_arrays([pa.array(left), pa.array(right), pa.array(value)], names=["l", "r", "v"])


def gram(tiles: DataFrame, left: str, right: str, value: str) -> DataFrame:
    """(left, right, value): the transpose of the matrix times the matrix, all cells that are not empty."""
    importable(tiles.sparkSession)
    one = tiles.select("row_block", F.col("col_block").alias("x"), F.struct("rows", "cols", "values").alias("a"))
    two = tiles.select("row_block", F.col("col_block").alias("y"), F.struct("rows", "cols", "values").alias("b"))
    pairs = one.join(two, "row_block").where("x <= y").repartition("row_block", "x", "y").select("x", "y", "a", "b")
    made = pairs.mapInArrow(_products, "l long, r long, v double")
    return made.groupBy(F.col("l").alias(left), F.col("r").alias(right)).agg(F.sum("v").alias(value))


def _divided(batches):
    for rb in batches:
        out = []
        for rows, values, ids, sums in zip(*(rb.column(i) for i in range(3, 7))):
            at = np.searchsorted(ids.values.to_numpy(), rows.values.to_numpy())
            total = sums.values.to_numpy()[at]
            out.append(pa.array(values.values.to_numpy() / np.where(total > 0, total, 1), mask=total <= 0))
        yield pa.RecordBatch.from_arrays([*rb.columns[:4], pa.array(out, pa.list_(pa.float64()))], names=["row_block", "col_block", "cols", "rows", "values"])


def l1_rows(tiles: DataFrame) -> DataFrame:
    """The tiled matrix with every row divided by the sum of its absolute values; rows of zeros become nulls."""
    importable(tiles.sparkSession)
    sums = tiles.select("row_block", F.inline(F.arrays_zip("rows", "values"))).groupBy("row_block", "rows").agg(F.sum(F.abs("values")).alias("l1"))
    by_block = sums.groupBy("row_block").agg(F.array_sort(F.collect_list(F.struct("rows", "l1"))).alias("s"))
    met = tiles.join(by_block.select("row_block", F.col("s.rows").alias("ids"), F.col("s.l1").alias("sums")), "row_block")
    met = met.select("row_block", "col_block", "cols", "rows", "values", "ids", "sums")
    out = met.mapInArrow(_divided, "row_block int, col_block int, cols array<bigint>, rows array<bigint>, values array<double>")
    return out.select("row_block", "col_block", "rows", "cols", "values")
