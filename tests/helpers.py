"""Hand-made basket fixtures (FIXTURES.md §4) and plain-Python references."""

from pyspark.sql import types as T

LINES = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("order_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("add_to_cart_order", T.IntegerType()),
])


def lines_df(spark, rows):
    """rows: (user, order, product[, cart position])"""
    full = []
    pos = {}
    for r in rows:
        if len(r) == 4:
            full.append(tuple(r))
        else:
            u, o, p = r
            pos[o] = pos.get(o, 0) + 1
            full.append((u, o, p, pos[o]))
    return spark.createDataFrame(full, LINES)


# baskets_small: 2 users, 4 orders, 5 products
BASKETS_SMALL = [
    (1, 10, 1), (1, 10, 2), (1, 10, 3),
    (1, 11, 1), (1, 11, 2),
    (2, 20, 2), (2, 20, 4),
    (2, 21, 1), (2, 21, 5),
]


def brute_cosine(rows, basket="multiset"):
    """Per ordered pair: Σ over orders m_l*m_r / (sqrt(n_l) sqrt(n_r))."""
    import math
    from collections import Counter, defaultdict

    mult = defaultdict(Counter)
    for u, o, p, *_ in rows:
        mult[(u, o)][p] += 1
    if basket == "set":
        for k in mult:
            for p in mult[k]:
                mult[k][p] = 1
    n = Counter()
    dot = Counter()
    for basket_items in mult.values():
        for p, m in basket_items.items():
            n[p] += m
        for a, ma in basket_items.items():
            for b, mb in basket_items.items():
                dot[(a, b)] += ma * mb
    return {k: v / (math.sqrt(n[k[0]]) * math.sqrt(n[k[1]])) for k, v in dot.items()}, dict(dot)


def ap_at_k(actual, predicted, k):
    """Mean of the precision at the ranks of the hits, over the hits that were possible.
    A rank is a hit if its product is bought and has no earlier rank."""
    rank = {p: r for r, p in reversed(list(enumerate(predicted[:k], start=1)))}
    ranks = {rank[p] for p in rank.keys() & set(actual)}
    precisions = [len([r for r in ranks if r <= at]) / at for at in ranks]
    return sum(precisions) / min(len(actual), k)
