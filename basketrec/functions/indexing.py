"""Row numbering computed in parallel, without one window partition per group.

``global_index`` numbers all rows 0..n-1 in sort order: the frame is
range-partitioned and sorted on the sort columns (the range bounds are
sampled, so a group holding a third of all rows is spread over many
partitions), every row gets its position inside its partition, and a table
of per-partition row counts — one row per partition, bounded by the
partition count, not the data — gives each partition's offset.  The
numbered frame is checkpointed to the shared checkpoint folder first, so
every later use sees the same numbering even if tasks are re-executed on
other executors.

``group_row_number`` turns that into ``row_number() OVER (PARTITION BY g
ORDER BY o)``: the global index minus the group's first index, the first
index coming from a map-side-combined ``min`` per group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketrec.plans.broadcast import broadcast_if_small

_LOW_BITS = (1 << 33) - 1


def global_index(df: DataFrame, order_cols: list[str], index_col: str = "idx",
                 num_partitions: int | None = None) -> DataFrame:
    """``df`` plus ``index_col``: 0-based position of the row in the order of
    ``order_cols`` (ties: the order must be total for a deterministic
    result)."""
    ranged = (df.repartitionByRange(num_partitions, *order_cols) if num_partitions
              else df.repartitionByRange(*order_cols))
    numbered = ranged.sortWithinPartitions(*order_cols).withColumn("_mid", F.monotonically_increasing_id())
    numbered = numbered.withColumn("_part", F.shiftright(F.col("_mid"), 33)) \
        .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit(_LOW_BITS))).drop("_mid") \
        .checkpoint(eager=True)
    sizes = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(
        "_part",
        F.coalesce(
            F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0)).alias("_off"),
    )  # one row per partition
    return numbered.join(F.broadcast(offsets), "_part").withColumn(
        index_col, F.col("_off") + F.col("_pos")).drop("_part", "_pos", "_off")


def dense_index(df: DataFrame, key: str, index_col: str = "idx",
                num_partitions: int | None = None) -> DataFrame:
    """``(key, index_col)`` with index_col = rank of key among the distinct
    keys, from 0."""
    keys = df.select(key).where(F.col(key).isNotNull()).distinct()
    return global_index(keys, [key], index_col, num_partitions).select(key, index_col)


def group_row_number(df: DataFrame, group_cols: list[str], order_cols: list[str],
                     out: str = "row_number", group_size: str | None = None) -> DataFrame:
    """``df`` plus ``out`` = row_number() over (partition by group_cols order
    by order_cols), from 1; with ``group_size`` also the group's row count.

    The per-group table (first index, size) is broadcast within the size
    bound; beyond it, it is a shuffle join, which AQE's skew handling
    splits for a hot group."""
    indexed = global_index(df, list(group_cols) + list(order_cols), "_gidx")
    firsts = indexed.groupBy(*group_cols).agg(F.min("_gidx").alias("_first"),
                                              F.count(F.lit(1)).alias("_gsize"))
    firsts = broadcast_if_small(firsts)
    res = indexed.join(firsts, list(group_cols)).withColumn(
        out, (F.col("_gidx") - F.col("_first") + 1).cast("int"))
    if group_size:
        res = res.withColumn(group_size, F.col("_gsize"))
    return res.drop("_gidx", "_first", "_gsize")
