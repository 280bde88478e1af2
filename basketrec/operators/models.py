"""Recommendation models over held-out last orders.

* ``last_prior_order``   each user's last prior order that has lines
* ``input_baskets``      last-prior-order lines of users who have train lines,
                         optionally a seeded sample of them
* ``actual_baskets``     train lines of those users (the truth to score)
* ``top_products``       popularity over every user's last prior order
* ``predict_cosine``     each basket line -> its top-k cosine neighbours
* ``predict_random``     each basket line -> k distinct random catalogue items
* ``predict_baseline``   each basket line -> k items drawn from the top products

Every prediction table has user_id, purchased_product, predicted_product, a
score column, the two product names, ``line`` (the add_to_cart_order of the
basket line) and ``pos`` (position of the prediction in the user's list,
from 1).  With ``rank_mode='line'`` the list is basket-line order, then the
per-line rank — the reference's order, in which the first line's k items
fill a top-k list; ``rank_mode='score'`` ranks a user's distinct predicted
products by their best score instead.

Random draws are md5 hashes of (seed, user, product, line), so results are
reproducible, task retries redraw the same items and an SQL engine can
check them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketrec.functions.hashing import hash_order_key, hash_u32
from basketrec.functions.indexing import dense_index, group_row_number
from basketrec.operators import similarity as sim
from basketrec.plans.broadcast import broadcast_if_small

PRED_COLS = ["user_id", "purchased_product", "predicted_product"]


def last_prior_order(prior_facts: DataFrame) -> DataFrame:
    """(user_id, order_id, product_id, order_number, add_to_cart_order) of
    each user's highest-numbered prior order among those with lines.  The
    join key is (user, order_number), so a user with a huge history is not
    one join partition."""
    lines = prior_facts.select("user_id", "order_id", "product_id", "order_number", "add_to_cart_order")
    last = lines.groupBy("user_id").agg(F.max("order_number").alias("order_number"))
    return lines.join(last, ["user_id", "order_number"]).select(
        "user_id", "order_id", "product_id", "order_number", "add_to_cart_order")


def train_users(last_facts: DataFrame) -> DataFrame:
    return last_facts.select("user_id").distinct()


def input_baskets(last_prior: DataFrame, last_facts: DataFrame, n_users: int | None = None,
                  seed: int = 1, by: str = "row") -> DataFrame:
    """Basket lines to predict from.

    Lines of each user's last prior order, for users who have train lines.
    ``n_users=None`` keeps every such user.  Otherwise ``by='row'`` draws
    ``n_users`` lines by seeded hash order and keeps all lines of the users
    drawn (users with larger baskets are likelier, a user drawn twice counts
    once — the reference's sampling); ``by='user'`` draws users directly."""
    eligible = last_prior.join(train_users(last_facts), "user_id", "left_semi")
    if n_users is None:
        return eligible
    if by == "row":
        key = hash_order_key(seed, "user_id", "product_id", "add_to_cart_order")
        chosen = eligible.select("user_id", key.alias("_h")).orderBy("_h", "user_id").limit(n_users)
        chosen = chosen.select("user_id").distinct()
    elif by == "user":
        users = eligible.select("user_id").distinct()
        chosen = users.select("user_id", hash_order_key(seed, "user_id").alias("_h")) \
            .orderBy("_h", "user_id").limit(n_users).select("user_id")
    else:
        raise ValueError("by must be 'row' or 'user'")
    return eligible.join(chosen, "user_id", "left_semi")


def actual_baskets(last_facts: DataFrame, baskets: DataFrame) -> DataFrame:
    """Train-order lines (user_id, product_id) of the users in ``baskets``."""
    users = baskets.select("user_id").distinct()
    return last_facts.select("user_id", "product_id").join(users, "user_id", "left_semi")


def top_products(last_prior: DataFrame, n: int = 100) -> DataFrame:
    """The n products bought most often in users' last prior orders
    (purchasecount), ties by product id."""
    counts = last_prior.groupBy("product_id").agg(F.count(F.lit(1)).alias("purchasecount"))
    return counts.orderBy(F.desc("purchasecount"), F.asc("product_id")).limit(n)


def _purchased_names(rows: DataFrame, products: DataFrame) -> DataFrame:
    names = broadcast_if_small(products.select(F.col("product_id").alias("purchased_product"),
                                               F.col("product_name").alias("prior_product_name")))
    return rows.join(names, "purchased_product", "left")


def _predicted_names(rows: DataFrame, products: DataFrame) -> DataFrame:
    names = broadcast_if_small(products.select(F.col("product_id").alias("predicted_product"),
                                               F.col("product_name").alias("predicted_product_name")))
    return rows.join(names, "predicted_product", "left")


#: Basket lines that are numbered together.
LINES_PER_BLOCK = 64


def _numbered_lines(lines: DataFrame, size: Column) -> DataFrame:
    """``lines`` (user_id, line, ..) with ``_before``, the predictions of the user's earlier lines, and
    ``_twins``, the user's lines of the same place (all in one ``_block``); ``size``: predictions of a line.

    Lines are numbered, not their predictions, which are many times as many: a window holds
    ``LINES_PER_BLOCK`` lines, and what is gathered by user is one number a block."""
    block = F.coalesce(F.floor(F.col("line") / LINES_PER_BLOCK).cast("long"), F.lit(-(1 << 62)))
    sized = lines.withColumn("_block", block).withColumn("_size", size.cast("long"))
    upto = Window.partitionBy("user_id", "_block").orderBy("line")  # lines of the same place included
    same = Window.partitionBy("user_id", "_block", "line")
    numbered = (sized.withColumn("_within", F.sum("_size").over(upto) - F.sum("_size").over(same))
                .withColumn("_twins", F.count(F.lit(1)).over(same)))
    sizes = sized.groupBy("user_id", "_block").agg(F.sum("_size").alias("n"))
    blocks = sizes.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("_block", "n"))).alias("_b"))
    before = F.expr("transform(_b, (x, i) -> struct(x._block as _block, aggregate(slice(_b, 1, i), 0L, (a, y) -> a + y.n) as _before))")
    placed = numbered.join(blocks.select("user_id", F.inline(before)), ["user_id", "_block"])
    return placed.withColumn("_before", F.col("_before") + F.col("_within")).drop("_size", "_within")


def _in_line_order(numbered: DataFrame, products: DataFrame) -> DataFrame:
    """The predictions of numbered lines with the purchased product's name and ``pos``, the place in the user's
    list: by line, rank and product.  ``picks``: an array of (rank, predicted_product, ..) in this order.
    Names meet lines, not predictions; only predictions of lines of the same place are sorted together."""
    def each(rows):
        kept = [c for c in rows.columns if c != "picks"]
        return rows.select(*kept, F.posexplode("picks").alias("_place", "_pick")).select(*kept, "_place", "_pick.*")

    w = Window.partitionBy("user_id", "_block", "line").orderBy("rank", "predicted_product")
    lone = each(_purchased_names(numbered.where("_twins = 1"), products))
    lone = lone.withColumn("pos", (F.col("_before") + F.col("_place") + 1).cast("int"))
    twins = each(numbered.where("_twins > 1")).withColumn("pos", (F.col("_before") + F.row_number().over(w)).cast("int"))
    return lone.unionByName(_purchased_names(twins, products)).drop("_before", "_twins", "_place", "_block")


def _by_score(pred: DataFrame, score: str) -> DataFrame:
    """Each user's distinct predicted products, at their best score and its first line, with ``pos``, the place
    by score.  Rows are numbered in range partitions (``group_row_number``)."""
    first = Window.partitionBy("user_id", "predicted_product").orderBy(F.desc(score), "line")
    one = pred.where("user_id is not null and predicted_product is not null")
    one = one.withColumn("_r", F.row_number().over(first)).where(F.col("_r") == 1).drop("_r")
    return group_row_number(one.withColumn("_worse", -F.col(score)), ["user_id"], ["_worse", "predicted_product"], "pos").drop("_worse")


def _known_mode(rank_mode: str) -> None:
    if rank_mode not in ("line", "score"):
        raise ValueError("rank_mode must be 'line' or 'score'")


def predict_cosine(baskets: DataFrame, neighbours: DataFrame, products: DataFrame,
                   rank_mode: str = "line") -> DataFrame:
    """Every basket line joined to its product's top-k neighbours (one
    equi-join on product id; ``neighbours`` from ``similarity.topk_neighbours``),
    which are one row a product, so that lines stay one row each until they are numbered.

    The join is left to adaptive execution: both inputs are shuffle stages,
    so AQE broadcasts the neighbour table (products × k) when its
    measured size is under the broadcast threshold, without computing the
    neighbours twice for an up-front size check."""
    _known_mode(rank_mode)
    one = F.struct("rank", F.col(sim.R).alias("predicted_product"), F.col("cosine_similarity").alias("cosine_sims"))
    nb = neighbours.groupBy(F.col(sim.L).alias("purchased_product")).agg(F.array_sort(F.collect_list(one)).alias("picks"))
    b = baskets.select("user_id", F.col("product_id").alias("purchased_product"),
                       F.col("add_to_cart_order").alias("line"))
    lines = b.join(nb, "purchased_product")
    if rank_mode == "line":
        pred = _in_line_order(_numbered_lines(lines, F.size("picks")), products)
    else:
        pred = _purchased_names(_by_score(lines.select("user_id", "purchased_product", "line", F.inline("picks")), "cosine_sims"), products)
    return _predicted_names(pred, products).select(
        *PRED_COLS, "cosine_sims", "prior_product_name", "predicted_product_name", "line", "rank", "pos")


def next_prime(n: int) -> int:
    c = max(2, n)
    while True:
        if c < 4 or all(c % d for d in range(2, int(c ** 0.5) + 1)):
            return c
        c += 1


def affine_draws(seed: int, line_cols: list, k: int, n: int):
    """Array column of min(k, n) distinct indices in [0, n) for each row.

    a ∈ [1, P−1] and b ∈ [0, P−1] come from the row's hash (P = smallest
    prime ≥ n); positions j = 0, 1, ... map to (a·j + b) mod P — a
    permutation of 0..P−1 — and values ≥ n are skipped.  The first
    min(k + P − n, P) positions hold at least min(k, n) valid values."""
    p = next_prime(n)
    draws = min(k + (p - n), p)  # positions past P would repeat values: the permutation has period P
    a = F.lit(1) + F.pmod(hash_u32(seed, *line_cols, F.lit("a")), F.lit(max(p - 1, 1)))
    b = F.pmod(hash_u32(seed, *line_cols, F.lit("b")), F.lit(p))
    seq = F.transform(F.sequence(F.lit(0).cast("long"), F.lit(draws - 1).cast("long")),
                      lambda j: F.pmod(a * j + b, F.lit(p)))
    return F.slice(F.filter(seq, lambda v: v < F.lit(n)), 1, k)


def predict_random(baskets: DataFrame, products: DataFrame, k: int = 10, seed: int = 1) -> DataFrame:
    """k distinct catalogue products per basket line, without replacement.

    Products get a dense index 0..N-1 (by id).  Each line draws a step a and
    an offset b from its hash; positions j = 0, 1, ... map to (a·j + b) mod P
    with P the smallest prime ≥ N — a permutation of 0..P-1 — and values ≥ N
    are skipped.  The first k + (P − N) positions therefore always hold k
    distinct products (or all N when N < k): exact, O(lines·k), no
    per-line scan of the catalogue and no cross join."""
    idx = dense_index(products, "product_id", "idx")
    n = idx.count()
    picked = affine_draws(seed, ["user_id", "product_id", "add_to_cart_order"], k, n)
    lines = baskets.select("user_id", F.col("product_id").alias("purchased_product"), F.col("add_to_cart_order").alias("line"))
    # Random draws carry no score: a user's list is always line order, then draw order; the index follows the ids.
    numbered = _numbered_lines(lines, F.lit(min(k, n)))
    picked = affine_draws(seed, ["user_id", "purchased_product", "line"], k, n)
    pred = _in_line_order(numbered.withColumn("picks", F.transform(
        picked, lambda v, i: F.struct((i + 1).alias("rank"), v.alias("predicted_product")))), products)
    ix = broadcast_if_small(idx.withColumnRenamed("idx", "_idx"), rows=n)
    pred = pred.withColumnRenamed("predicted_product", "_idx").join(ix, "_idx").withColumnRenamed("product_id", "predicted_product")
    return _predicted_names(pred, products).select(
        *PRED_COLS, "prior_product_name", "predicted_product_name", "line", "rank", "pos")


def predict_baseline(baskets: DataFrame, last_prior: DataFrame, products: DataFrame, k: int = 10,
                     seed: int = 1, pool: int = 100, rank_mode: str = "line",
                     per_line_seed: bool = False) -> DataFrame:
    """k products drawn (seeded) from the ``pool`` most popular ones.

    Default: one draw for all — with a fixed seed every basket line gets the
    same k items, as in the reference.  ``per_line_seed=True``: every line draws
    its own k of the pool with the same exact permutation draw as
    ``predict_random`` (O(k) per line).

    The items with their names are a scalar subquery, a bounded array (k, or ``pool``) of
    structs, so each line is expanded by ``posexplode`` — no join, no cross
    product, and no shuffle of predictions by one of few products."""
    _known_mode(rank_mode)
    top = top_products(last_prior, pool)
    lines = baskets.select("user_id", F.col("product_id").alias("purchased_product"), F.col("add_to_cart_order").alias("line"))
    if per_line_seed:
        items = top.withColumn("_h", F.row_number().over(
            Window.orderBy(F.desc("purchasecount"), F.asc("product_id"))))  # ≤ pool rows
        n = items.count()
        size = F.lit(min(k, n))
    else:
        items = top.select("product_id", "purchasecount", hash_order_key(seed, "product_id").alias("_h")) \
            .orderBy("_h", "product_id").limit(k)
    named = (items.join(products.select("product_id", "product_name"), "product_id", "left")
             .groupBy("_h", "product_id", "purchasecount").agg(F.collect_list(F.struct("product_name")).alias("names")))
    arr = named.agg(F.array_sort(F.collect_list(F.struct("_h", "product_id", "purchasecount", "names")))).scalar()

    def pick(rank, item):
        return F.struct(rank.alias("rank"), item["product_id"].alias("predicted_product"),
                        item["purchasecount"].alias("purchasecount"), item["names"].alias("names"))

    def picks(rows):
        rows = rows.withColumn("_items", arr)
        if per_line_seed:
            picked = affine_draws(seed, ["user_id", "purchased_product", "line"], k, n)
            found = F.transform(picked, lambda v, i: pick(i + 1, F.element_at("_items", (v + 1).cast("int"))))
        else:
            found = F.transform("_items", lambda x, i: pick(i + 1, x))
        return rows.withColumn("picks", found).drop("_items")

    if rank_mode == "line":
        numbered = _numbered_lines(lines, size if per_line_seed else F.size(arr))
        pred = _in_line_order(picks(numbered), products)
    else:
        pred = _by_score(picks(lines).select("user_id", "purchased_product", "line", F.inline("picks")), "purchasecount")
        pred = _purchased_names(pred, products)
    return pred.withColumn("_name", F.explode("names")).withColumn("predicted_product_name", F.col("_name.product_name")).select(
        *PRED_COLS, "purchasecount", "prior_product_name", "predicted_product_name", "line", "rank", "pos")
