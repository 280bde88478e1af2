"""Connected components by alternating star contractions.

Each round points every neighbour of a node at the smallest node of its
neighbourhood: first the larger neighbours (large star), then the smaller ones
(small star).  The edge list never grows beyond its input size plus one edge
per node, and the rounds are logarithmic in the longest path.  Every round is a
grouped minimum and an equi-join, so a node with very many edges is only a
skewed join side, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketrec.llm.common import discard, materialise


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a")).toDF("a", "b")
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.filter("b > a").join(low, "a").filter("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges come as (larger, smaller)."""
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(low.select("a", F.col("m").alias("b"))).distinct()


def _fingerprint(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"),
                  F.sum(F.xxhash64("b", "a") % 1000003).alias("s")).first()
    return r["n"], r["x"], r["s"]


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b, both long): root is
    the smallest node reachable.  Self-edges and null ends are ignored, order and
    repetition of edges do not matter, no edges give no rows."""
    cur = materialise(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "cc-edges")
    seen = _fingerprint(cur)
    while seen[0]:
        last, cur = cur, materialise(_small_star(_large_star(cur)), "cc-round")
        discard(last)
        now = _fingerprint(cur)
        if now == seen:
            break
        seen = now
    roots = cur.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return cur.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
