"""Nearest products by shared orders, through MinHash signatures.

A product is the set of its orders.  Products of one and the same set form a class, told by the
set's size and two independent 64-bit sums of order hashes, and are searched as one.  A class has
``hashes`` minima of seeded order hashes, one aggregation over the lines; ``bands`` of
consecutive minima make keys, and classes that share a key are candidates.  Every candidate pair
is verified: its shared orders are counted, and only pairs at or above the threshold stay.

Two sets of Jaccard similarity s share a band of r minima with probability s ** r, so of such pairs
1 - (1 - s ** r) ** bands are found.  ``bands_for`` gives the bands for a wanted recall.

A pair of similarity s has sizes within a factor of s, so a band key is joined within size
steps: a class meets those of its own step and of the next.  A key's commonest size step can
still be shared by many classes; its members are salted over several tasks before the join.

Bands of one row need no row a band: their key is the order that has the least hash of a class, so
two classes share a band if they share an order that is least in the same band.  A class then has
one row an order, with a list of its bands, however many bands there are.

Shared orders are counted by a join of the lines with themselves on the order.  Orders of more than
``CROWD`` classes would make too many pairs: their bands stay keys, and candidates look them up.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketrec.operators.similarity import L, R
from basketrec.plans.skew import heavy_keys, salted
from basketrec.plans.staging import Staging

#: Members of one band key and size step that one task pairs.
MEMBERS_PER_TASK = 4096
#: Classes of an order whose pairs are formed at once.
CROWD = 64


def bands_for(threshold: float, band_rows: int, recall: float) -> int:
    """Fewest bands that find a pair at the threshold with probability ``recall``."""
    if threshold >= 1:  # equal sets share every band
        return 1
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold ** band_rows)))


def order_sets(facts: DataFrame) -> DataFrame:
    """(product_id, order_id), each pair once."""
    return facts.select("product_id", "order_id").where("product_id is not null and order_id is not null").distinct()


def classes(sets: DataFrame) -> DataFrame:
    """(product_id, class, size): products with equal order sets share a class, named by their
    smallest id."""
    h = lambda seed: F.sum(F.xxhash64(F.lit(seed), "order_id").cast("decimal(20,0)"))
    prints = sets.groupBy("product_id").agg(F.count(F.lit(1)).alias("size"), h(1).alias("h1"), h(2).alias("h2"))
    names = prints.groupBy("size", "h1", "h2").agg(F.min("product_id").alias("class"))
    return prints.join(names, ["size", "h1", "h2"]).select("product_id", "class", "size")


def _hash(seed: int, i: int):
    return F.xxhash64(F.lit(seed * 1_000_003 + i), "order_id")


def signatures(sets: DataFrame, hashes: int, seed: int) -> DataFrame:
    """(product_id, size, mins): ``hashes`` minima of seeded order hashes."""
    mins = [F.min(_hash(seed, i)).alias(f"h{i}") for i in range(hashes)]
    made = sets.groupBy("product_id").agg(F.count(F.lit(1)).alias("size"), *mins)
    return made.select("product_id", "size", F.array(*[f"h{i}" for i in range(hashes)]).alias("mins"))


def candidates(signed: DataFrame, band_rows: int, bands: int, threshold: float, members_per_task: int = MEMBERS_PER_TASK) -> DataFrame:
    """(product_id_left, product_id_right, sizes), left < right, of products that share a band and whose sizes
    allow the threshold."""
    keys = [F.xxhash64(F.lit(b), *[F.col("mins")[b * band_rows + i] for i in range(band_rows)]) for b in range(bands)]
    return _sharing(signed.select("product_id", "size", F.explode(F.array(*keys)).alias("key")), threshold, members_per_task)


def _sharing(keyed: DataFrame, threshold: float, members_per_task: int) -> DataFrame:
    """Candidates among the rows (product_id, size, key) with one key."""
    step = F.floor(F.log(F.col("size").cast("double")) / F.lit(-math.log(threshold) if threshold < 1 else 1.0)).cast("int")
    rows = keyed.withColumn("step", step)
    # a class is on the left in its own step and on the right also one step below
    sides = rows.withColumn("at", F.explode(F.array("step", F.col("step") - 1)))
    n = F.col("_n").cast("double")
    sides = salted(sides, heavy_keys(sides, "key", "at", least=members_per_task), F.ceil(n / F.lit(float(members_per_task))), ["key", "at"])
    sides = sides.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).repartition("key", "at", "salt")
    a = sides.where("step = at").where(F.col("salt") == F.pmod(F.xxhash64("product_id"), F.col("_salts"))).select("key", "at", "salt", F.col("product_id").alias("a"), F.col("size").alias("na"))
    b = sides.select("key", "at", "salt", F.col("product_id").alias("b"), F.col("size").alias("nb"), F.col("step").alias("sb"))
    pairs = a.join(b, ["key", "at", "salt"]).where("(sb > at or a < b) and a <> b")
    pairs = pairs.where(F.least("na", "nb") >= F.lit(threshold) * F.greatest("na", "nb"))
    ordered = pairs.select(F.least("a", "b").alias(L), F.greatest("a", "b").alias(R))
    return ordered.distinct()


def least_orders(sets: DataFrame, signed: DataFrame, bands: int, seed: int) -> DataFrame:
    """(product_id, order_id, size, bands): the orders that have the least hash of their product in some band
    of one row, with those bands.  ``signed`` has the products' signatures, one hash a band."""
    base = F.lit(seed * 1_000_003)
    least = F.filter(F.sequence(base, base + F.lit(bands - 1)), lambda s: F.xxhash64(s, "order_id") == F.get("mins", (s - base).cast("int")))
    made = sets.select("product_id", "order_id").join(signed, "product_id").select("product_id", "order_id", "size", least.alias("bands"))
    return made.where(F.size("bands") > 0)


def candidates_by_order(least: DataFrame, crowded: DataFrame, threshold: float, members_per_task: int = MEMBERS_PER_TASK) -> DataFrame:
    """The candidates of bands of one row, from ``least_orders``; ``crowded`` (_hot): hashes of orders whose
    bands are keys, so that an order in many sets is joined band by band."""
    hot, key = F.broadcast(crowded), F.xxhash64("order_id") == F.col("_hot")
    few = least.join(hot, key, "left_anti")
    a = few.select("order_id", F.col("product_id").alias(L), F.col("size").alias("na"), F.col("bands").alias("bands_left"))
    b = few.select("order_id", F.col("product_id").alias(R), F.col("size").alias("nb"), F.col("bands").alias("bands_right"))
    pairs = a.join(b, "order_id").where((F.col(L) < F.col(R)) & (F.least("na", "nb") >= F.lit(threshold) * F.greatest("na", "nb")))
    pairs = pairs.where(F.arrays_overlap("bands_left", "bands_right"))
    many = least.join(hot, key, "left_semi").withColumn("band", F.explode("bands"))
    keyed = many.select("product_id", "size", F.xxhash64("band", "order_id").alias("key"))
    return pairs.select(L, R).unionByName(_sharing(keyed, threshold, members_per_task)).distinct()


def _together(sets: DataFrame) -> DataFrame:
    """(left, right, sizes, shared) of the products that share an order of ``sets`` (product_id, order_id, size)."""
    side = lambda p, n: sets.select("order_id", F.col("product_id").alias(p), F.col("size").alias(n))
    pairs = side(L, "size_left").join(side(R, "size_right"), "order_id").where(F.col(L) < F.col(R))
    return pairs.groupBy(L, R, "size_left", "size_right").agg(F.count(F.lit(1)).alias("shared"))


def _looked_up(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The same of ``pairs``, through the orders of each left product."""
    left = sets.select(F.col("product_id").alias(L), "order_id", F.col("size").alias("size_left"))
    right = sets.select(F.col("product_id").alias(R), "order_id", F.col("size").alias("size_right"))
    met = pairs.join(left, L).join(right, [R, "order_id"])
    return met.groupBy(L, R, "size_left", "size_right").agg(F.count(F.lit(1)).alias("shared"))


def verified(pairs: DataFrame, sets: DataFrame, crowded: DataFrame, threshold: float) -> DataFrame:
    """``pairs`` with their number of shared orders and Jaccard similarity, at or above the threshold.  ``sets``:
    (product_id, order_id, size); ``crowded`` (_hot): hashes of orders to look up by pair."""
    jaccard = F.col("shared") / (F.col("size_left") + F.col("size_right") - F.col("shared"))
    hot, key = F.broadcast(crowded), F.xxhash64("order_id") == F.col("_hot")
    shared = _together(sets.join(hot, key, "left_anti"))
    if not crowded.isEmpty():
        both = shared.unionByName(_looked_up(pairs, sets.join(hot, key, "left_semi")))
        shared = both.groupBy(L, R, "size_left", "size_right").agg(F.sum("shared").alias("shared"))
    found = shared.select(L, R, "shared", jaccard.alias("jaccard")).where(F.col("jaccard") >= F.lit(threshold))
    return found.join(pairs, [L, R], "left_semi")


def _sharing_a_band(links: DataFrame, own: DataFrame, bands: int, seed: int) -> DataFrame:
    """Those of ``links`` whose products share a band of one row; only products with a link are signed."""
    linked = links.select(F.col(L).alias("product_id")).union(links.select(R)).distinct()
    signed = signatures(own.join(linked, "product_id", "left_semi"), bands, seed)
    left, right = signed.select(F.col("product_id").alias(L), F.col("mins").alias("a")), signed.select(F.col("product_id").alias(R), F.col("mins").alias("b"))
    same = F.exists(F.zip_with("a", "b", lambda x, y: x == y), lambda x: x)
    return links.join(left, L).join(right, R).where(same).select(*links.columns)


def shared_order_links(facts: DataFrame, threshold: float = 0.5, recall: float = 0.999, band_rows: int = 1, seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """(links, classes): pairs of class names (product_id_left < product_id_right, shared, jaccard) at or above
    ``threshold``, and (product_id, class, size) of every product.  Links between members of one class
    have similarity 1 and are not listed."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    stage = Staging(facts.sparkSession, "minhash")
    sets = stage.write(order_sets(facts), "sets")
    of_class = stage.write(classes(sets), "classes")
    own = sets.join(of_class.where("product_id = class").select("product_id", "size"), "product_id")
    # a product's lines together, so that its signature leaves one task, not each of those that read some of them
    own = stage.write(own.hint("rebalance", "product_id"), "class-sets")
    crowded = stage.write(heavy_keys(own, "order_id", least=CROWD).select("_hot"), "crowded-orders")
    bands = bands_for(threshold, band_rows, recall)
    if band_rows == 1 and crowded.isEmpty():
        # all shared orders are counted by order, whatever the candidates: the few links are signed, not every line
        jaccard = F.col("shared") / (F.col("size_left") + F.col("size_right") - F.col("shared"))
        links = _together(own).select(L, R, "shared", jaccard.alias("jaccard")).where(F.col("jaccard") >= F.lit(threshold))
        return _sharing_a_band(stage.write(links, "links"), own, bands, seed), of_class
    signed = signatures(own, bands * band_rows, seed)
    if band_rows == 1:
        pairs = candidates_by_order(least_orders(own, signed, bands, seed), crowded, threshold)
    else:
        pairs = candidates(signed, band_rows, bands, threshold)
    return verified(stage.write(pairs, "candidates"), own, crowded, threshold), of_class


def nearest_by_shared_orders(facts: DataFrame, k: int = 10, **options) -> DataFrame:
    """(product_id_left, product_id_right, jaccard, rank): up to ``k`` linked products of every product, likeliest
    first, ties by id.  Of every class only its k + 1 smallest ids can be among them."""
    links, of_class = shared_order_links(facts, **options)
    small = Window.partitionBy("class").orderBy("product_id")
    members = of_class.select("class", "product_id").withColumn("_r", F.row_number().over(small)).where(F.col("_r") <= k + 1).drop("_r")
    both = links.select(F.col(L).alias("a"), F.col(R).alias("b"), "jaccard").unionByName(links.select(F.col(R).alias("a"), F.col(L).alias("b"), "jaccard"))
    itself = of_class.select(F.col("class").alias("a"), F.col("class").alias("b")).distinct().withColumn("jaccard", F.lit(1.0))
    near = both.unionByName(itself).join(members.select(F.col("class").alias("b"), F.col("product_id").alias(R)), "b")
    best = Window.partitionBy("a").orderBy(F.desc("jaccard"), R)
    near = near.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= k + 1).drop("_r", "b")
    out = of_class.select(F.col("product_id").alias(L), F.col("class").alias("a")).join(near, "a").where(F.col(L) != F.col(R))
    own = Window.partitionBy(L).orderBy(F.desc("jaccard"), R)
    return out.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k).select(L, R, "jaccard", "rank")
