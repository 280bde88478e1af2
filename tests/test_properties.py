"""Randomised properties against plain-Python brute force (hypothesis)."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from basketrec.operators import evaluate, similarity as sim
from helpers import ap_at_k, brute_cosine, lines_df

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])

baskets = st.lists(
    st.tuples(st.integers(1, 4), st.integers(1, 8), st.integers(1, 9)),  # user, order, product
    min_size=1, max_size=40,
).map(lambda rows: [(o % 4 + 1, o, p) for _, o, p in rows])  # an order belongs to one user


@SETTINGS
@given(rows=baskets, mode=st.sampled_from(["multiset", "set"]), budget=st.sampled_from([50_000_000, 2, 0]))
def test_pair_dots_and_cosine_match_brute_force(spark, rows, mode, budget):
    facts = lines_df(spark, rows)
    exp_cos, exp_dot = brute_cosine(rows, mode)
    got = {(r[sim.L], r[sim.R]): r for r in sim.pair_dots(facts, mode, pairs_per_task=budget).collect()}
    assert {k: v["dot"] for k, v in got.items()} == exp_dot
    cos = {(r[sim.L], r[sim.R]): r.cosine_similarity for r in
           sim.cosine_similarity(facts, mode, pairs_per_task=budget).collect()}
    assert cos.keys() == exp_cos.keys()
    for k, v in exp_cos.items():
        assert cos[k] == pytest.approx(v, rel=1e-12)
        assert cos[(k[1], k[0])] == cos[k]
    if mode == "set":
        for (a, b), v in got.items():
            if a == b:  # dot(l, l) = number of baskets holding l
                assert v["dot"] == v["n_l"]


users_preds = st.dictionaries(
    st.integers(1, 6),
    st.tuples(st.lists(st.integers(1, 12), min_size=1, max_size=8),      # actual rows (repeats allowed)
              st.lists(st.integers(1, 12), min_size=0, max_size=14)),    # prediction list
    min_size=1, max_size=6)


@SETTINGS
@given(cases=users_preds, k=st.integers(1, 12))
def test_average_precision_matches_definition(spark, cases, k):
    pred = [(u, p, i + 1) for u, (_, ps) in cases.items() for i, p in enumerate(ps)]
    actual = [(u, a) for u, (acts, _) in cases.items() for a in acts]
    pdf = spark.createDataFrame(pred, "user_id long, predicted_product long, pos int")
    adf = spark.createDataFrame(actual, "user_id long, product_id long")
    udf = spark.createDataFrame([(u,) for u in cases], "user_id long")
    got = {r.userid: r.MAP for r in evaluate.average_precision(pdf, adf, udf, k=k).collect()}
    for u, (acts, ps) in cases.items():
        assert got[u] == pytest.approx(ap_at_k(acts, ps, k), abs=1e-12)


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 20), st.integers(0, 1000)),
                     min_size=1, max_size=60, unique_by=lambda r: (r[0], r[1], r[2])),
       parts=st.integers(1, 7))
def test_group_row_number_equals_window(spark, rows, parts):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from basketrec.functions.indexing import global_index, group_row_number

    df = spark.createDataFrame(rows, "g long, t long, i long").repartition(parts)
    got = sorted((r.g, r.t, r.i, r.rn, r.n) for r in group_row_number(df, ["g"], ["t", "i"], "rn", "n").collect())
    w = Window.partitionBy("g").orderBy("t", "i")
    exp = sorted((r.g, r.t, r.i, r.rn, r.n) for r in df.select(
        "*", F.row_number().over(w).alias("rn"), F.count(F.lit(1)).over(Window.partitionBy("g")).alias("n")).collect())
    assert got == exp
    idx = [r.idx for r in global_index(df, ["g", "t", "i"], num_partitions=parts).collect()]
    assert sorted(idx) == list(range(len(rows)))
