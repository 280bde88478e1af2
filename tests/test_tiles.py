"""Tiled matrices against the long forms."""

import random

import numpy as np
import pytest

from basketrec.operators import matrix, similarity, tiles
from helpers import BASKETS_SMALL, lines_df


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def skewed(seed=2):
    rng = random.Random(seed)
    rows = [(u, 100 * u + o, rng.randrange(60)) for u in range(12) for o in range(8) for _ in range(rng.randrange(1, 9))]
    rows += [(50, 9999, p) for p in range(60)] + [(50, 9999, 3)] * 4         # a huge basket, with repeats
    return rows + [(60 + i, 7000 + i, 5) for i in range(300)]                 # one product in most baskets


@pytest.mark.parametrize("rows", [BASKETS_SMALL, skewed()])
@pytest.mark.parametrize("blocks, pairs", [(None, 2_000_000), (3, 2_000_000), (4, 50)])
def test_gram_equals_cooccurrence(spark, monkeypatch, rows, blocks, pairs):
    monkeypatch.setattr(tiles, "PAIRS", pairs)
    facts = lines_df(spark, rows)
    lines = similarity.basket_lines(facts)
    made = tiles.gram(tiles.tiled(lines, "order_id", "product_id", "m", blocks, blocks), similarity.L, similarity.R, "cooccurances")
    got = rows_of(made.selectExpr("product_id_left", "product_id_right", "cast(cooccurances as long)"))
    assert got and got == rows_of(similarity.cooccurrence(facts).select(similarity.L, similarity.R, "cooccurances"))


@pytest.mark.parametrize("blocks", [None, 5])
def test_l1_equals_long_form(spark, blocks):
    long = matrix.user_item_matrix(lines_df(spark, skewed()))
    made = tiles.cells_of(tiles.l1_rows(tiles.tiled(long, "user_id", "product_id", "purchases", blocks, blocks)), "user_id", "product_id", "l1_value")
    assert rows_of(made) == rows_of(matrix.l1_normalize(long, "user_id", "purchases").select("user_id", "product_id", "l1_value"))


def test_zero_rows_nulls_and_empty(spark):
    long = spark.createDataFrame([(1, 2, 0.0), (1, 3, 0.0), (2, 2, -3.0), (2, 3, 1.0), (None, 1, 1.0), (1, None, 1.0), (2, 3, 0.0)], "r long, c long, v double")
    t = tiles.tiled(long, "r", "c", "v", 2, 2)
    assert rows_of(tiles.cells_of(t, "r", "c", "v")) == [(1, 2, 0.0), (1, 3, 0.0), (2, 2, -3.0), (2, 3, 1.0)]
    assert sorted(map(str, rows_of(tiles.cells_of(tiles.l1_rows(t), "r", "c", "v")))) == ["(1, 2, None)", "(1, 3, None)", "(2, 2, -0.75)", "(2, 3, 0.25)"]
    assert tiles.gram(tiles.tiled(long.limit(0), "r", "c", "v"), "a", "b", "v").count() == 0


def test_a_huge_basket_spreads(spark):
    t = tiles.tiled(lines_df(spark, skewed()).selectExpr("order_id", "product_id", "1 as m"), "order_id", "product_id", "m", 2, 6)
    assert t.where("array_contains(rows, 9999L)").count() == 6
    assert np.max([len(r.rows) for r in t.collect()]) < 300


def test_short_rows_need_one_block_of_columns(spark, monkeypatch):
    """More orders of the same length make more blocks of rows, not of columns, so that no tile is copied;
    a huge basket still spreads."""
    monkeypatch.setattr(tiles, "CELLS", 40)
    monkeypatch.setattr(tiles, "ROW_CELLS", 10)
    short = spark.createDataFrame([(o, (o * 7 + j) % 50, 1) for o in range(200) for j in range(5)], "r long, c long, v int")
    made = tiles.tiled(short, "r", "c", "v")
    assert {r.col_block for r in made.collect()} == {0} and made.count() >= 20
    long = short.union(spark.createDataFrame([(999, j, 1) for j in range(50)], "r long, c long, v int"))
    made = tiles.tiled(long, "r", "c", "v")
    assert made.where("array_contains(rows, 999L)").count() == 5
    assert sorted(map(tuple, tiles.cells_of(made, "r", "c", "v").collect())) == sorted(map(tuple, long.selectExpr("r", "c", "double(v)").collect()))
