"""Item-item and user-item matrices.

The long (row, column, value) form is canonical: it is sparse, partitions by any
key and never moves through the driver.  The wide form has one row per id with
sorted arrays of column ids and values, so its schema is the same for any catalogue.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketrec.operators import similarity as sim


def user_item_matrix(facts: DataFrame) -> DataFrame:
    """(user_id, product_id, purchases): lines per user and product."""
    return facts.groupBy("user_id", "product_id").agg(F.count(F.lit(1)).alias("purchases"))


def l1_normalize(long: DataFrame, row: str, value: str, out: str = "l1_value") -> DataFrame:
    """Divide every value by the sum of |values| of its row.  Row sums are an
    aggregation (map-side combined), joined back on the row key; a row with
    a huge number of entries is split by AQE's skew-join handling rather
    than sorted into one window partition."""
    sums = long.groupBy(row).agg(F.sum(F.abs(F.col(value))).alias("_l1"))
    return long.join(sums, row).select(
        *long.columns, F.try_divide(F.col(value).cast("double"), F.col("_l1").cast("double")).alias(out))


def matrix_rows(long: DataFrame, row: str, col: str, value: str) -> DataFrame:
    """One row per id: its column ids in order and their values; absent cells are 0.
    The schema does not depend on the data, so any number of columns fits, and
    a row is as long as its id has distinct partners."""
    cells = long.groupBy(row).agg(F.array_sort(F.collect_list(F.struct(F.col(col).alias("c"), F.col(value).alias("v")))).alias("_cells"))
    return cells.select(row, F.col("_cells.c").alias("columns"), F.col("_cells.v").alias("row_values"))


def item_matrix_wide(facts: DataFrame) -> DataFrame:
    """Item-item co-occurrence counts, one row per left product."""
    return matrix_rows(sim.cooccurrence(facts), sim.L, sim.R, "cooccurances")


def user_matrix_wide(facts: DataFrame) -> DataFrame:
    """Purchases per product, one row per user."""
    return matrix_rows(user_item_matrix(facts), "user_id", "product_id", "purchases")


def l1_normalize_rows(rows: DataFrame) -> DataFrame:
    """Adds ``norm_values``: the row's values over the sum of their absolute values."""
    total = F.expr("aggregate(row_values, 0D, (a, x) -> a + abs(cast(x as double)))")
    return rows.withColumn("_l1", total).withColumn(
        "norm_values", F.expr("transform(row_values, x -> try_divide(cast(x as double), _l1))")).drop("_l1")


def dimensions(long: DataFrame, row: str = sim.L, col: str = sim.R) -> DataFrame:
    """(num_rows, num_cols, entries) of a long-form matrix with 0-based
    integer indices, as a CoordinateMatrix would report them."""
    return long.agg((F.max(row) + 1).alias("num_rows"), (F.max(col) + 1).alias("num_cols"),
                    F.count(F.lit(1)).alias("entries"))


def to_coordinate_matrix(long: DataFrame, row: str = sim.L, col: str = sim.R, value: str = "cooccurances"):
    """Bridge to ``pyspark.mllib`` distributed linear algebra."""
    from pyspark.mllib.common import callMLlibFunc
    from pyspark.mllib.linalg.distributed import CoordinateMatrix

    entries = long.select(F.col(row).cast("long").alias("i"), F.col(col).cast("long").alias("j"), F.col(value).cast("double").alias("value"))
    return CoordinateMatrix(callMLlibFunc("createCoordinateMatrix", entries, 0, 0))


def coordinate_entries(cm) -> DataFrame:
    """(i, j, value) of a CoordinateMatrix, without rows passing through Python."""
    from pyspark.mllib.common import callMLlibFunc

    return callMLlibFunc("getMatrixEntries", cm._java_matrix_wrapper._java_model).select("i", "j", "value")
