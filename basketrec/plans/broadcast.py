"""Broadcast only behind a size bound.

The bound is in bytes: of the optimiser's estimate of a frame, or of a known number of rows times the
width of a row.  The estimate of a written table is the size of its files, which may hold its rows in a
small part of what they take in the driver's memory; so the rows of files that could be too many are
counted, by their footers.  Nothing else is run.  Beyond the bound the frame is returned without a
broadcast hint, and Spark plans a shuffle join, which adaptive execution may still turn into a broadcast by the
size that it measures, but for files whose size alone would have Spark broadcast them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BYTES = 32 << 20
#: Bytes of memory that a byte of a file stands for at most where the rows are not counted.
PACKED = 32


def estimated_bytes(df: DataFrame, rows: int | None = None) -> int:
    if rows is not None:
        return rows * (16 + df._jdf.schema().defaultSize())
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_MAX_BYTES, rows: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_bytes``; ``rows``: its number of rows, if known."""
    size = estimated_bytes(df, rows)
    if size > max_bytes:
        return df
    if rows is None and size * PACKED > max_bytes and df.inputFiles() and estimated_bytes(df, df.count()) > max_bytes:
        return df.hint("merge")  # the size of the files alone would be under Spark's own bound
    return F.broadcast(df)


#: Bytes of written tables that one task of a join takes; estimates from ``UNKNOWN`` on are no estimates.
TASK_BYTES, UNKNOWN = 4 << 20, 1 << 50


def spread_by_size(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` to a task for every ``TASK_BYTES`` of its estimate, so that a task's share does
    not grow with the table; adaptive execution would merge shuffled partitions to about one a core.
    Tables that make no more tasks than cores, and those of unknown size, stay as they are."""
    size = estimated_bytes(df)
    n = -(-size // TASK_BYTES)
    return df.repartition(n, *keys) if size < UNKNOWN and n > df.sparkSession.sparkContext.defaultParallelism else df
