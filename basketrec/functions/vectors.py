"""Cosine of two equal-length numeric arrays as column expressions.

``zip_with`` silently pads the shorter array with nulls, so unequal lengths
raise an error instead; a zero vector gives NULL (the division has no value)
rather than an ANSI divide-by-zero failure.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def array_dot(x, y) -> Column:
    x, y = _c(x), _c(y)
    prods = F.zip_with(x, y, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(prods, F.lit(0.0).cast("double"), lambda acc, v: acc + v)


def array_magnitude(x) -> Column:
    x = _c(x)
    sq = F.transform(x, lambda a: a.cast("double") * a.cast("double"))
    return F.sqrt(F.aggregate(sq, F.lit(0.0).cast("double"), lambda acc, v: acc + v))


def array_cosine(x, y) -> Column:
    x, y = _c(x), _c(y)
    checked = F.when(
        F.size(x) != F.size(y),
        F.raise_error(F.lit("array_cosine: arrays differ in length")),
    )
    cos = F.try_divide(array_dot(x, y), array_magnitude(x) * array_magnitude(y))
    return F.coalesce(checked.cast("double"), cos)


def centroid_cosine(df, key: str, vec: str, id_col: str):
    """Cosine of every array to the element-wise mean of its group's arrays.

    Centroids are aggregated per (group, position) — map-side partial sums,
    so a group holding a third of the rows is still summed in parallel —
    and rebuilt as one array per group (bounded by the dimension).  The
    centroid table (groups × dimension) is broadcast within the size
    bound.  O(rows); no pair of rows is ever formed."""
    from pyspark.sql import functions as F

    from basketrec.plans.broadcast import broadcast_if_small

    exploded = df.select(key, F.posexplode(vec).alias("_pos", "_v"))
    means = exploded.groupBy(key, "_pos").agg(F.avg(F.col("_v").cast("double")).alias("_m"))
    cents = means.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("_pos", "_m"))).alias("_s")
    ).select(key, F.transform("_s", lambda s: s["_m"]).alias("_centroid"))
    cents = broadcast_if_small(cents)
    return df.join(cents, key).select(id_col, key, array_cosine(vec, "_centroid").alias("cosine_to_centroid"))
