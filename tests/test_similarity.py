import math

import pytest
from pyspark.sql import functions as F

from basketrec.operators import similarity as sim
from helpers import BASKETS_SMALL, brute_cosine, lines_df


def as_dict(df, col):
    return {(r[sim.L], r[sim.R]): r[col] for r in df.collect()}


def test_cooccurrence_and_cosine_small(spark):
    facts = lines_df(spark, BASKETS_SMALL)
    exp_cos, exp_dot = brute_cosine(BASKETS_SMALL)
    cooc = as_dict(sim.cooccurrence(facts), "cooccurances")
    assert cooc == exp_dot
    # worked by hand: product 1 is in orders 10, 11, 21 (n=3), product 2 in 10, 11, 20 (n=3)
    assert cooc[(1, 2)] == 2 and cooc[(1, 1)] == 3 and (4, 5) not in cooc
    cos = as_dict(sim.cosine_similarity(facts), "cosine_similarity")
    assert set(cos) == set(exp_cos)
    for k, v in exp_cos.items():
        assert cos[k] == pytest.approx(v, abs=1e-15)
    assert cos[(1, 2)] == pytest.approx(2 / 3)
    assert cos[(2, 4)] == pytest.approx(1 / math.sqrt(3))


def test_multiset_vs_set(spark):
    rows = [(1, 1, 7), (1, 1, 7), (1, 1, 8), (1, 2, 7)]
    facts = lines_df(spark, rows)
    multi = as_dict(sim.cosine_similarity(facts, basket="multiset"), "cosine_similarity")
    sett = as_dict(sim.cosine_similarity(facts, basket="set"), "cosine_similarity")
    # multiset: product 7 has n=3 lines, self dot = 2² + 1² = 5 -> 5/3 > 1
    assert multi[(7, 7)] == pytest.approx(5 / 3)
    assert sett[(7, 7)] == pytest.approx(1.0)
    assert sett[(7, 8)] == pytest.approx(1 / math.sqrt(2))
    assert multi[(7, 8)] == pytest.approx(2 / math.sqrt(3))


def test_symmetry_and_self_pairs_set_mode(spark):
    rows = [(u, o, p) for u, o, p in BASKETS_SMALL] + [(3, 30, 2), (3, 30, 3), (3, 30, 5)]
    cos = as_dict(sim.cosine_similarity(lines_df(spark, rows), basket="set"), "cosine_similarity")
    for (a, b), v in cos.items():
        assert cos[(b, a)] == v
        if a == b:
            assert v == pytest.approx(1.0)


def test_hot_basket_salting_equals_plain_path(spark):
    rows = [(1, 1, p) for p in range(1, 40)] + [(2, 2, p) for p in (1, 2, 3)] + [(1, 3, 5), (1, 3, 5), (1, 3, 6)]
    facts = lines_df(spark, rows)
    plain = as_dict(sim.pair_dots(facts), "dot")
    salted = as_dict(sim.pair_dots(facts, pairs_per_task=5), "dot")       # 39-product order: 148 salts
    all_hot = as_dict(sim.pair_dots(facts, pairs_per_task=0), "dot")        # every basket salted
    _, exp = brute_cosine(rows)
    assert plain == exp and salted == exp and all_hot == exp


def test_top_pairs_excludes_self_and_breaks_ties(spark):
    facts = lines_df(spark, BASKETS_SMALL)
    top = sim.top_pairs(sim.cooccurrence(facts), 3).collect()
    assert all(r[sim.L] != r[sim.R] for r in top)
    assert [(r[sim.L], r[sim.R], r["cooccurances"]) for r in top] == [(1, 2, 2), (2, 1, 2), (1, 3, 1)]


def test_topk_neighbours_ceiling_and_ties(spark):
    sims = spark.createDataFrame(
        [(1, 1, 1.0), (1, 2, 0.9995), (1, 3, 0.5), (1, 4, 0.5), (1, 5, 0.7), (2, 1, 0.2)],
        "product_id_left long, product_id_right long, cosine_similarity double")
    top = sim.topk_neighbours(sims, k=2).orderBy(sim.L, "rank").collect()
    assert [(r[sim.L], r[sim.R], r["rank"]) for r in top] == [(1, 5, 1), (1, 3, 2), (2, 1, 1)]
    top_all = sim.topk_neighbours(sims, k=10, ceiling=None).where(F.col(sim.L) == 1).orderBy("rank").collect()
    assert [r[sim.R] for r in top_all] == [1, 2, 5, 3, 4]


def test_similar_items_methods(spark):
    facts = lines_df(spark, BASKETS_SMALL)
    catalog = spark.createDataFrame([(p, f"p{p}") for p in range(1, 6)], "product_id long, product_name string")
    probes = spark.createDataFrame([(2,)], "product_id long")
    out = sim.similar_items(sim.cosine_similarity(facts), catalog, probes, "cosine", n=2).orderBy("rank").collect()
    assert [r[sim.L] for r in out] == [2, 1]  # self pair first (cosine 1), then product 1
    assert out[0]["product_name_right"] == "p2"
    out2 = sim.similar_items(sim.cooccurrence(facts), catalog, probes, "cooccurrence", n=5,
                             include_self=False).collect()
    assert all(r[sim.L] != 2 for r in out2)
    with pytest.raises(ValueError):
        sim.similar_items(sim.cooccurrence(facts), catalog, probes, "jaccard")


def test_item_norms(spark):
    norms = {r["product_id"]: r["norm"] for r in sim.item_norms(lines_df(spark, BASKETS_SMALL)).collect()}
    assert norms[1] == pytest.approx(math.sqrt(3)) and norms[4] == pytest.approx(1.0)


def test_cosine_matches_mllib_column_similarities_set_mode(spark):
    """columnSimilarities of the 0/1 order x product matrix = set-mode cosine (l < r)."""
    from pyspark.mllib.linalg.distributed import CoordinateMatrix, MatrixEntry

    rows = [(u, o, p) for u, o, p in BASKETS_SMALL]
    facts = lines_df(spark, rows)
    entries = spark.sparkContext.parallelize(sorted({(o, p) for _, o, p in rows})).map(
        lambda t: MatrixEntry(t[0], t[1], 1.0))
    cs = CoordinateMatrix(entries).toRowMatrix().columnSimilarities().entries.collect()
    got = {(int(e.i), int(e.j)): e.value for e in cs}
    cos = as_dict(sim.cosine_similarity(facts, basket="set"), "cosine_similarity")
    upper = {k: v for k, v in cos.items() if k[0] < k[1]}
    assert set(got) == set(upper)
    for k, v in upper.items():
        assert got[k] == pytest.approx(v, rel=1e-9)


def test_order_ids_shared_by_two_users(spark):
    rows = [(1, 10, 7), (1, 10, 8), (2, 10, 8), (2, 10, 9), (None, 10, 7)]
    facts = lines_df(spark, rows)
    key = ("user_id", "order_id")
    plain = as_dict(sim.pair_dots(facts, basket_key=key), "dot")
    assert plain == {(7, 7): 1, (7, 8): 1, (8, 7): 1, (8, 8): 2, (8, 9): 1, (9, 8): 1, (9, 9): 1}
    assert as_dict(sim.pair_dots(facts, basket="set", basket_key=key, pairs_per_task=0), "dot") == plain
    assert as_dict(sim.pair_dots(facts), "dot")[(7, 9)] == 2  # one basket, by order id alone


def test_many_lines_make_many_tasks(spark, monkeypatch):
    """The baskets are dealt to tasks by the number of lines, with the same cosines."""
    facts = lines_df(spark, BASKETS_SMALL)
    monkeypatch.setattr(sim, "LINES_PER_TASK", 1)
    dealt = sim._dealt(sim.basket_lines(facts), 50_000_000, len(BASKETS_SMALL))
    assert dealt.rdd.getNumPartitions() == len(BASKETS_SMALL)
    want, _ = brute_cosine(BASKETS_SMALL)
    got = {(r[0], r[1]): r[2] for r in sim.cosine_similarity(facts).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
