import pytest
from pyspark.sql import functions as F

from basketrec.operators import factor, matrix, similarity as sim
from helpers import BASKETS_SMALL, lines_df


def test_user_item_and_l1(spark):
    f = lines_df(spark, BASKETS_SMALL)
    ui = matrix.user_item_matrix(f)
    got = {(r.user_id, r.product_id): r.purchases for r in ui.collect()}
    assert got[(1, 1)] == 2 and got[(2, 4)] == 1
    l1 = matrix.l1_normalize(ui, "user_id", "purchases")
    sums = {r.user_id: r.s for r in l1.groupBy("user_id").agg(F.sum("l1_value").alias("s")).collect()}
    assert all(v == pytest.approx(1.0) for v in sums.values())


def test_long_and_wide_agree(spark):
    f = lines_df(spark, BASKETS_SMALL)
    cooc = {(r[sim.L], r[sim.R]): r.cooccurances for r in sim.cooccurrence(f).collect()}
    rows = matrix.item_matrix_wide(f).collect()
    assert {(r[sim.L], c): v for r in rows for c, v in zip(r["columns"], r.row_values)} == cooc
    assert all(r["columns"] == sorted(r["columns"]) for r in rows)
    assert matrix.user_matrix_wide(f).count() == 2


def test_l1_vector_form(spark):
    f = lines_df(spark, BASKETS_SMALL)
    for r in matrix.l1_normalize_rows(matrix.user_matrix_wide(f)).collect():
        assert sum(r.norm_values) == pytest.approx(1.0) and len(r.norm_values) == len(r["columns"])


def test_many_columns_need_no_bound(spark):
    f = lines_df(spark, [(1, 1, p) for p in range(6000)])
    assert len(matrix.user_matrix_wide(f).first().row_values) == 6000


def test_dimensions_and_coordinate_bridge(spark):
    f = lines_df(spark, BASKETS_SMALL)
    cooc = sim.cooccurrence(f)
    d = matrix.dimensions(cooc).first()
    cm = matrix.to_coordinate_matrix(cooc)
    assert (d.num_rows, d.num_cols, d.entries) == (cm.numRows(), cm.numCols(), cm.entries.count())


def test_ratings_basket_weight_equals_self_join(spark):
    f = lines_df(spark, BASKETS_SMALL + [(1, 10, 1)])
    r = factor.ratings(f)
    a, b = f.alias("a"), f.alias("b")
    ref = (a.join(b, (F.col("a.user_id") == F.col("b.user_id")) & (F.col("a.order_id") == F.col("b.order_id")))
           .groupBy(F.col("a.user_id").alias("user_id"), F.col("a.product_id").alias("product_id"))
           .agg(F.count(F.lit(1)).alias("purchases")))
    assert r.exceptAll(ref).count() == 0 and ref.exceptAll(r).count() == 0
    cnt = {(x.user_id, x.product_id): x.purchases for x in factor.ratings(f, weight="count").collect()}
    assert cnt[(1, 1)] == 3


def test_save_sim_matrix_from_coordinate_matrix(spark, scratch):
    from basketrec.sources import files

    f = lines_df(spark, BASKETS_SMALL)
    cooc = sim.cooccurrence(f)
    path = scratch("mat")
    files.save_sim_matrix(matrix.to_coordinate_matrix(cooc), path)
    got = sorted(r.value for r in spark.read.text(path).collect())
    exp = sorted(f"{r[sim.L]}|{r[sim.R]}|{float(r.cooccurances)}" for r in cooc.collect())
    assert got == exp
