"""Seeded, engine-independent pseudo-random numbers.

A draw is the first 8 hex digits of ``md5(seed|v1|v2|...)`` read as an
unsigned 32-bit number.  md5, decimal rendering of integers and '|' joining
are identical in Spark and in SQL engines, so sampled rows can be checked
against an oracle, and a re-run (or a re-executed task after executor loss)
draws the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def hash_order_key(seed: int, *cols) -> Column:
    """md5 hex string of ``seed|c1|c2|...`` (sortable, deterministic)."""
    parts = [F.lit(str(seed))] + [_as_col(c).cast("string") for c in cols]
    return F.md5(F.concat_ws("|", *parts))


def hash_u32(seed: int, *cols) -> Column:
    """Unsigned 32-bit draw in [0, 2**32) from ``seed|c1|c2|...``."""
    return F.conv(F.substring(hash_order_key(seed, *cols), 1, 8), 16, 10).cast("long")
