from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from basketrec.operators import models, similarity as sim
from helpers import lines_df


def facts(spark):
    # user 1: orders 1, 2 (prior), 3 without lines; user 2: one prior order; user 3 no train lines
    prior = spark.createDataFrame(
        [(1, 1, 10, 1, 1), (1, 1, 11, 1, 2), (1, 2, 12, 2, 1), (1, 2, 10, 2, 2),
         (2, 4, 11, 1, 1), (2, 4, 13, 1, 2), (3, 6, 10, 1, 1)],
        "user_id long, order_id long, product_id long, order_number int, add_to_cart_order int")
    train = spark.createDataFrame([(1, 3, 10), (1, 3, 14), (2, 5, 11)], "user_id long, order_id long, product_id long")
    return prior, train


def test_last_prior_order_and_baskets(spark):
    prior, train = facts(spark)
    last = models.last_prior_order(prior)
    assert sorted((r.user_id, r.order_id, r.product_id) for r in last.collect()) == \
        [(1, 2, 10), (1, 2, 12), (2, 4, 11), (2, 4, 13), (3, 6, 10)]
    b = models.input_baskets(last, train)
    assert sorted({r.user_id for r in b.collect()}) == [1, 2]
    act = models.actual_baskets(train, b)
    assert act.count() == 3
    one = models.input_baskets(last, train, n_users=1, seed=3, by="user")
    assert len({r.user_id for r in one.collect()}) == 1
    by_row = models.input_baskets(last, train, n_users=1, seed=3, by="row").collect()
    assert len({r.user_id for r in by_row}) == 1 and len(by_row) == 2  # all lines of the drawn user
    assert models.input_baskets(last, train, n_users=1, seed=3).collect() == by_row


def test_top_products_ties(spark):
    last = spark.createDataFrame([(1, 5), (1, 3), (2, 3), (2, 9), (3, 5), (3, 1)], "user_id long, product_id long")
    top = models.top_products(last, 2).collect()
    assert [(r.product_id, r.purchasecount) for r in top] == [(3, 2), (5, 2)]


def products(spark, n):
    return spark.createDataFrame([(p * 7, f"p{p}") for p in range(n)], "product_id long, product_name string")


def baskets(spark):
    return spark.createDataFrame([(1, 10, 1), (1, 11, 2), (2, 10, 1)], "user_id long, product_id long, add_to_cart_order int")


@pytest.mark.parametrize("n,k", [(50, 10), (7, 10), (10, 10), (1, 3)])
def test_random_model_k_distinct_catalogue_items(spark, n, k):
    pred = models.predict_random(baskets(spark), products(spark, n), k=k, seed=5).collect()
    per_line = defaultdict(list)
    for r in pred:
        per_line[(r.user_id, r.line)].append(r.predicted_product)
    catalogue = {p * 7 for p in range(n)}
    assert len(per_line) == 3
    for items in per_line.values():
        assert len(items) == min(k, n) and len(set(items)) == len(items) and set(items) <= catalogue
    again = models.predict_random(baskets(spark), products(spark, n), k=k, seed=5).collect()
    assert sorted(again) == sorted(pred)
    user1 = sorted((r.pos, r.line, r.rank) for r in pred if r.user_id == 1)
    assert [p for p, _, _ in user1] == list(range(1, len(user1) + 1))
    assert [(l, r) for _, l, r in user1] == sorted((l, r) for _, l, r in user1)


def test_random_model_seeds_differ(spark):
    a = models.predict_random(baskets(spark), products(spark, 500), k=5, seed=1).collect()
    b = models.predict_random(baskets(spark), products(spark, 500), k=5, seed=2).collect()
    assert sorted(r.predicted_product for r in a) != sorted(r.predicted_product for r in b)


def test_baseline_same_items_every_line(spark):
    last = spark.createDataFrame([(u, p) for u in range(5) for p in range(u, 30)], "user_id long, product_id long")
    pred = models.predict_baseline(baskets(spark), last, products(spark, 5), k=4, seed=1, pool=10).collect()
    per_line = defaultdict(list)
    for r in pred:
        per_line[(r.user_id, r.line)].append((r.rank, r.predicted_product))
    lists = [sorted(v) for v in per_line.values()]
    assert len(lists) == 3 and all(x == lists[0] for x in lists) and len(lists[0]) == 4
    top10 = {r.product_id for r in models.top_products(last, 10).collect()}
    assert {p for _, p in lists[0]} <= top10


def test_predict_cosine_line_and_score_modes(spark):
    hist = lines_df(spark, [(9, 1, 10), (9, 1, 11), (9, 2, 10), (9, 2, 12), (9, 3, 11), (9, 3, 12), (9, 3, 13)])
    nb = sim.topk_neighbours(sim.cosine_similarity(hist), k=2)
    cat = spark.createDataFrame([(p, f"p{p}") for p in (10, 11, 12, 13)], "product_id long, product_name string")
    b = spark.createDataFrame([(1, 11, 1), (1, 10, 2)], "user_id long, product_id long, add_to_cart_order int")
    line = models.predict_cosine(b, nb, cat, rank_mode="line").orderBy("pos").collect()
    assert [r.pos for r in line] == [1, 2, 3, 4]
    assert [r.purchased_product for r in line] == [11, 11, 10, 10]
    assert line[0].cosine_sims >= line[1].cosine_sims and line[0].prior_product_name == "p11"
    score = models.predict_cosine(b, nb, cat, rank_mode="score").orderBy("pos").collect()
    prods = [r.predicted_product for r in score]
    assert len(prods) == len(set(prods))
    assert [r.cosine_sims for r in score] == sorted((r.cosine_sims for r in score), reverse=True)


def test_baseline_per_line_seed(spark):
    last = spark.createDataFrame([(u, p) for u in range(5) for p in range(u, 30)], "user_id long, product_id long")
    pred = models.predict_baseline(baskets(spark), last, products(spark, 5), k=4, seed=1, pool=10,
                                   per_line_seed=True).collect()
    per_line = defaultdict(list)
    for r in pred:
        per_line[(r.user_id, r.line)].append(r.predicted_product)
    top10 = {r.product_id for r in models.top_products(last, 10).collect()}
    assert len(per_line) == 3
    for items in per_line.values():
        assert len(items) == 4 and len(set(items)) == 4 and set(items) <= top10
    assert len({tuple(sorted(v)) for v in per_line.values()}) > 1  # lines draw independently


def _marks(spark, rows):
    return spark.createDataFrame(rows, "user_id long, order_id long, product_id long, order_number int, add_to_cart_order int")


def test_predictions_are_numbered_by_line_with_equal_places_and_repeated_names(spark):
    """Positions equal a plain sort, also for lines of one place and products of two names; names and
    positions are found on the lines, so nothing joins above the expansion of a line."""
    rows = [(1, 10, p, 1, line) for p, line in ((5, 1), (6, 2), (7, 2), (8, None), (9, None), (5, 70), (6, 200))] + [(2, 20, 6, 1, 3)]
    baskets = _marks(spark, rows)
    products = spark.createDataFrame([(p, f"p{p}") for p in range(1, 10)] + [(6, "again"), (2, "two")], "product_id long, product_name string")
    near = [(5, 1, 0.5, 1), (5, 2, 0.4, 2), (6, 2, 0.9, 1), (7, 1, 0.3, 1), (7, 3, 0.2, 2), (8, 4, 0.1, 1), (9, 2, 0.6, 1)]
    nb = spark.createDataFrame(near, "product_id_left long, product_id_right long, cosine_similarity double, rank int")
    got = models.predict_cosine(baskets, nb, products).select("user_id", "purchased_product", "predicted_product", "line", "rank", "pos")
    want = set()
    for user in (1, 2):
        one = sorted(((line is not None, line or 0), rank, r, p, line) for u, _, p, _, line in rows if u == user for left, r, _, rank in near if left == p)
        want |= {(user, p, r, line, rank, i + 1) for i, (_, rank, r, p, line) in enumerate(one)}
    assert {tuple(r) for r in got.collect()} == want
    names = {p: sum(x == p for x in [*range(1, 10), 6, 2]) for p in range(1, 10)}
    assert got.count() == sum(names[w[1]] * names[w[2]] for w in want)
    base = models.predict_baseline(baskets, baskets, products, k=3, seed=1)
    assert {r["pos"] for r in base.where("user_id = 1").collect()} == set(range(1, 22))
    plan = base._jdf.queryExecution().optimizedPlan().toString().split("Union")[-1].splitlines()
    assert next(i for i, x in enumerate(plan) if "posexplode" in x) < next(i for i, x in enumerate(plan) if "Join" in x)
