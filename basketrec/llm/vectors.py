"""Helpers for tables of vectors (vec_id, embedding)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def valid(df: DataFrame) -> DataFrame:
    """Rows whose vector is not null, has no null or non-finite component and is not zero."""
    v = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.expr("cast(embedding as array<double>)").alias("v"))
    fine = F.expr("v is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) and exists(v, x -> x <> 0)")
    return v.filter(fine)


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


#: Integers of ``quantised`` stay below this, so that squared distances, with an index in the
#: same number, fit 64 bits up to 1,024 components.
INTEGER_LIMIT = 1 << 20


def quantised(df: DataFrame, scale: int, *others: str) -> DataFrame:
    """(vec_id, others, q): floor(scale * x) of every component x as a double.  Rows whose vector is null,
    has no component, or holds a null, a non-finite component or one whose integer reaches
    ``INTEGER_LIMIT`` in size are left out."""
    v = df.select(F.col("vec_id").cast("long").alias("vec_id"), *others, F.expr("cast(embedding as array<double>)").alias("v"))
    fine = F.expr(f"v is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < {INTEGER_LIMIT // scale}D)")
    return v.filter(fine).select("vec_id", *others, F.expr(f"transform(v, x -> cast(floor({scale} * x) as int))").alias("q"))


def floor_means(rows: DataFrame, entries: int) -> dict[tuple, list[int]]:
    """(part, entry) -> floor(total / n) by position, from partial sums (part, entry, pos, n, total) of the
    tasks.  What comes to the driver is one row a component of the ``entries`` entries."""
    summed = rows.groupBy("part", "entry", "pos").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    out: dict[tuple, list[int]] = {}
    for r in sorted(summed.limit(entries).collect()):
        out.setdefault((r.part, r.entry), []).append(int(r.total) // r.n)
    return out


PARTIAL_SCHEMA = "part int, entry int, pos int, n long, total long"


def partial_sums(sums: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """Rows of ``PARTIAL_SCHEMA`` from sums (part, entry, pos) and counts (part, entry) of a task."""
    part, entry, pos = (x.ravel() for x in np.indices(sums.shape))
    n = np.repeat(counts.ravel(), sums.shape[2])
    used = n > 0
    return pa.RecordBatch.from_arrays(
        [pa.array(x[used], t) for x, t in zip((part, entry, pos, n, sums.ravel()), (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()))],
        names=["part", "entry", "pos", "n", "total"])
