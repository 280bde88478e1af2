"""Item-item co-occurrence and cosine similarity over baskets.

Plan (one shuffle of pair-sized data, two of pre-aggregated lines):

1. order lines are collapsed once to (order, product, m) — m is the
   multiplicity of the product in the basket (``basket='multiset'``, the
   reference's counting) or 1 (``'set'``) — with a map-side partial
   aggregation; all that follows reads this one exchange;
2. per product n = Σ m (line count; the squared norm) and Σ m², the diagonal;
   this product table is broadcast to the lines within the size bound, by its
   counted rows, else joined by a shuffle;
3. a count over the collapsed lines finds baskets of more than
   ``pairs_per_task`` pairs (``plans.skew``); each is dealt to as many salts as
   its pairs need, every other basket to one.  A line goes to every salt of
   its basket, and to one of them as the left side of its pairs, so lines are
   partitioned by (order, salt) once, and the basket self-join runs inside
   those partitions with no new shuffle, emitting only
   product_id_left < product_id_right;
4. Σ m_l·m_r per pair is aggregated map-side first, then shuffled once;
   n_l and n_r ride along as group keys, so no join on the pair table is
   needed for the norms;
5. the upper triangle is mirrored with one ``explode``; the diagonal comes
   from the product table.

While the plan is built, the products are counted; baskets are not looked at.

Cosine is ``dot / (sqrt(n_l) * sqrt(n_r))`` — the Ochiai coefficient on 0/1
baskets; in multiset mode a repeated product makes the self pair exceed 1,
as in the reference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketrec.plans.broadcast import broadcast_if_small
from basketrec.plans.skew import heavy_keys, salted
from basketrec.session import shuffles_freed

L, R = "product_id_left", "product_id_right"


def _keyed(facts: DataFrame, basket_key: str | tuple[str, ...]) -> DataFrame:
    """(order_id, product_id) of the lines with both; several key columns make one struct."""
    cols = (basket_key,) if isinstance(basket_key, str) else tuple(basket_key)
    whole = F.col("product_id").isNotNull()
    for c in cols:
        whole = whole & F.col(c).isNotNull()
    key = F.col(cols[0]) if len(cols) == 1 else F.struct(*cols)
    return facts.where(whole).select(key.alias("order_id"), "product_id")


def basket_lines(facts: DataFrame, basket: str = "multiset",
                 basket_key: str | tuple[str, ...] = "order_id") -> DataFrame:
    """(order_id, product_id, m): one row per basket and product.  The basket
    key is one column, or several where order ids are unique per user only.

    Lines are aggregated map-side first, and by order and product, so an order
    holding a huge share of all lines is spread over all tasks."""
    if basket not in ("multiset", "set"):
        raise ValueError(f"basket must be 'multiset' or 'set', not {basket!r}")
    lines = _keyed(facts, basket_key)
    if basket == "multiset":
        return lines.groupBy("order_id", "product_id").agg(F.count(F.lit(1)).alias("m"))
    return lines.distinct().withColumn("m", F.lit(1).cast("long"))


def product_counts(lines: DataFrame) -> DataFrame:
    """Per product of ``basket_lines``: n = squared norm, its line count (multiset) or the
    number of baskets holding it (set), and dot = Σ m², its product with itself."""
    return lines.groupBy("product_id").agg(F.sum("m").alias("n"), F.sum(F.col("m") * F.col("m")).alias("dot"))


#: Lines of the baskets that one task joins with themselves.
LINES_PER_TASK = 200_000


def _dealt(lines: DataFrame, pairs_per_task: int, rows: int) -> DataFrame:
    """``lines`` once per salt of their basket, partitioned by (order_id, _salt); ``_own`` marks the
    salt in which a line is the left side.  A basket of b products has b(b-1)/2 pairs and
    ceil(pairs / pairs_per_task) salts.  ``rows`` lines, if many, make a task for every ``LINES_PER_TASK``: adaptive
    execution would merge them to about one a core, whose pairs, held to be added up, grow with the table."""
    n = F.col("_n").cast("double")
    salts = F.ceil(n * (n - 1) / 2 / F.lit(float(max(pairs_per_task, 1))))
    least = (2.0 * max(pairs_per_task, 1)) ** 0.5  # fewer products cannot make more pairs
    out = salted(lines, heavy_keys(lines, "order_id", least=least), salts, ["order_id"])
    out = out.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)))
    out = out.withColumn("_own", F.col("_salt") == F.pmod(F.xxhash64("product_id"), F.col("_salts")))
    n = -(-rows // LINES_PER_TASK)
    many = [n] if n > lines.sparkSession.sparkContext.defaultParallelism else []
    return out.drop("_salts").repartition(*many, "order_id", "_salt")


def _upper_pairs(lines: DataFrame, counts: DataFrame, pairs_per_task: int, norms: bool = True) -> DataFrame:
    """(l, r, n_l, n_r, dot) for l < r; without ``norms`` (l, r, dot)."""
    with shuffles_freed(lines.sparkSession):
        found = counts.agg(F.count(F.lit(1)).alias("products"), F.coalesce(F.sum("n"), F.lit(0)).alias("lines")).first()
    if norms:
        few = broadcast_if_small(counts.select("product_id", "n"), rows=found["products"])
        lines = lines.join(few, "product_id")
    dealt = _dealt(lines, pairs_per_task, found["lines"])

    def side(df, p, m, n):
        return df.select("order_id", "_salt", F.col("product_id").alias(p), F.col("m").alias(m), *([F.col("n").alias(n)] if norms else []))

    pairs = side(dealt.where("_own"), L, "m_l", "n_l").join(side(dealt, R, "m_r", "n_r"), ["order_id", "_salt"]).where(F.col(L) < F.col(R))
    return pairs.groupBy(L, R, *(["n_l", "n_r"] if norms else [])).agg(F.sum(F.col("m_l") * F.col("m_r")).alias("dot"))


def pair_dots(facts: DataFrame, basket: str = "multiset", pairs_per_task: int = 50_000_000,
              basket_key: str | tuple[str, ...] = "order_id") -> DataFrame:
    """All ordered pairs (self pairs included) of products bought in the
    same basket: (product_id_left, product_id_right, dot, n_l, n_r).
    ``basket_key=("user_id", "order_id")`` where users share order ids."""
    lines = basket_lines(facts, basket, basket_key)
    counts = product_counts(lines)
    diag = counts.select(F.col("product_id").alias(L), F.col("product_id").alias(R), "dot", F.col("n").alias("n_l"), F.col("n").alias("n_r"))
    return _mirrored(_upper_pairs(lines, counts, pairs_per_task), ["n"]).unionByName(diag)


def _mirrored(up: DataFrame, sided: list[str]) -> DataFrame:
    """Both orders of every pair; ``sided``: stems of columns that belong to a side (``n``: n_l and n_r)."""
    own, other = [L, R, *[f"{c}_{x}" for c in sided for x in "lr"]], [R, L, *[f"{c}_{x}" for c in sided for x in "rl"]]
    order = lambda cols: F.struct(*[F.col(c).alias(f"_{name}") for c, name in zip(cols, own)])
    both = up.select(F.explode(F.array(order(own), order(other))).alias("p"), "dot")
    return both.select(F.col(f"p._{L}").alias(L), F.col(f"p._{R}").alias(R), "dot", *[F.col(f"p._{c}").alias(c) for c in own[2:]])


def _cosine(dot, n_l, n_r):
    return dot / (F.sqrt(n_l) * F.sqrt(n_r))


def cosine_similarity(facts: DataFrame, basket: str = "multiset", **kw) -> DataFrame:
    """(product_id_left, product_id_right, cosine_similarity) for every
    co-occurring ordered pair, self pairs included."""
    d = pair_dots(facts, basket, **kw)
    return d.select(L, R, _cosine(F.col("dot"), F.col("n_l"), F.col("n_r")).alias("cosine_similarity"))


def item_norms(facts: DataFrame, basket: str = "multiset") -> DataFrame:
    """(product_id, norm) with norm = sqrt(line count)."""
    return product_counts(basket_lines(facts, basket)).select("product_id", F.sqrt("n").alias("norm"))


def attach_names(pairs: DataFrame, catalog: DataFrame) -> DataFrame:
    """Left-join product names for both ids (names are looked up after the
    aggregation, so they never widen the shuffle)."""
    names = broadcast_if_small(catalog.select("product_id", "product_name"))
    nl = names.select(F.col("product_id").alias(L), F.col("product_name").alias("product_name_left"))
    nr = names.select(F.col("product_id").alias(R), F.col("product_name").alias("product_name_right"))
    return pairs.join(nl, L, "left").join(nr, R, "left")


def cooccurrence(facts: DataFrame, catalog: DataFrame | None = None, basket: str = "multiset",
                 pairs_per_task: int = 50_000_000, basket_key: str | tuple[str, ...] = "order_id") -> DataFrame:
    """Item-item co-occurrence counts (long sparse form), names attached when
    a catalogue is given.  The pairs of ``pair_dots`` without the products' counts, which
    no count of pairs needs: they would widen the shuffle by half."""
    lines = basket_lines(facts, basket, basket_key)
    counts = product_counts(lines)
    up = _upper_pairs(lines, counts, pairs_per_task, norms=False)
    diag = counts.select(F.col("product_id").alias(L), F.col("product_id").alias(R), "dot")
    d = _mirrored(up, []).unionByName(diag).select(L, R, F.col("dot").alias("cooccurances"))
    if catalog is None:
        return d
    return attach_names(d, catalog).select(L, R, "product_name_left", "product_name_right", "cooccurances")


def top_pairs(cooc: DataFrame, n: int = 10) -> DataFrame:
    """The n most frequent non-self pairs (ties by ids)."""
    return (cooc.where(F.col(L) != F.col(R))
            .orderBy(F.desc("cooccurances"), F.asc(L), F.asc(R)).limit(n))


def topk_neighbours(sim: DataFrame, k: int = 10, ceiling: float | None = 0.999,
                    score: str = "cosine_similarity") -> DataFrame:
    """Per left product the k right products with the highest score below the
    ceiling (ties by right id); ``rank`` from 1.  Spark plans a
    WindowGroupLimit, so each map task keeps only k rows per product before
    the shuffle."""
    s = sim if ceiling is None else sim.where(F.col(score) < F.lit(ceiling))
    w = Window.partitionBy(L).orderBy(F.desc(score), F.asc(R))
    return s.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def similar_items(scores: DataFrame, catalog: DataFrame, product_ids: DataFrame,
                  method: str = "cosine", n: int = 30, include_self: bool = True) -> DataFrame:
    """Products most similar to each probe product (matched on the right id),
    top ``n`` per probe by cosine or co-occurrence, ties by left id.  Products
    without a catalogue row take no place.

    ``product_ids`` is a one-column frame of probe ids (``product_id``)."""
    if method == "cosine":
        score = "cosine_similarity"
    elif method == "cooccurrence":
        score = "cooccurances"
    else:
        raise ValueError(f"method must be 'cosine' or 'cooccurrence', not {method!r}")
    s = scores.select(L, R, score)
    probes = product_ids.select(F.col("product_id").alias(R)).distinct()
    known = catalog.select("product_id").distinct()
    s = s.join(probes, R, "left_semi").join(known.withColumnRenamed("product_id", R), R, "left_semi")
    s = s.join(known.withColumnRenamed("product_id", L), L, "left_semi")
    if not include_self:
        s = s.where(F.col(L) != F.col(R))
    w = Window.partitionBy(R).orderBy(F.desc(score), F.asc(L))
    top = s.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
    return attach_names(top, catalog).select(
        L, R, "product_name_left", "product_name_right", score, "rank")
