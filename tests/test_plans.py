"""Plan shape: the properties the operators are designed for at scale."""

import re

import pytest

from basketrec.operators import similarity as sim
from basketrec.plans import registry as R

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark):
    return R.load_basket_tables(spark, SF)


def test_topk_is_a_group_limit(spark, tables):
    p = plan(sim.topk_neighbours(sim.cosine_similarity(R.prior_lines(tables)), k=10))
    # a partial limit before the shuffle by product and a final one after it
    assert "WindowGroupLimit [product_id_left" in p and ", Partial" in p and ", Final" in p


def test_self_join_reuses_order_partitioning(spark, tables):
    p = plan(sim.cosine_similarity(R.prior_lines(tables)))
    order_exchanges = re.findall(r"Exchange hashpartitioning\(order_id#\d+L?, _salt#\d+, \d+\), (\w+)", p)
    assert order_exchanges and set(order_exchanges) == {"REPARTITION_BY_COL"}
    # the pair aggregation is combined map-side before its single shuffle
    assert "partial_sum((m_l" in p


def test_positions_have_no_window_by_user_alone(spark, tables):
    for key in ("predict_cosine", "predict_random", "predict_baseline", "predict_baseline_per_line", "predict_cosine_by_score"):
        assert not re.search(r"windowspecdefinition\(user_id#\d+L?, (?!_block|predicted_product#\d+L?, \w)", plan(R.queries()[key](spark, SF))), key


def test_scans_are_pruned_and_filtered(spark, tables):
    p = plan(sim.cosine_similarity(R.prior_lines(tables)))
    assert "ReadSchema: struct<order_id:bigint,product_id:bigint>" in p
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(eval_set,prior\)", p)


@pytest.mark.parametrize("key", sorted(R.queries()))
def test_no_cross_join_or_python_udf(spark, key):
    p = plan(R.queries()[key](spark, SF))
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in p, f"{key}: {bad}"


def test_broadcast_only_under_bound(spark):
    from basketrec.plans.broadcast import broadcast_if_small

    small = broadcast_if_small(spark.range(10), max_bytes=80)
    big = broadcast_if_small(spark.range(11), max_bytes=80)
    known = broadcast_if_small(spark.range(11), max_bytes=80, rows=3)
    assert "broadcast" in spark.range(9).join(known, "id")._jdf.queryExecution().analyzed().toString().lower()
    j_small = spark.range(100).join(small, "id")
    j_big = spark.range(100).join(big, "id")
    assert "broadcast" in j_small._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in j_big._jdf.queryExecution().analyzed().toString().lower()
    assert not big.is_cached


def test_baskets_are_written_once(spark):
    """All steps of a query that read the baskets read one written table."""
    from basketrec.plans import registry
    from basketrec.sources.testdata import load_basket_tables

    t = load_basket_tables(spark, "/root/testdata/sf0.001")
    assert all("-baskets-" in f for f in registry.baskets(t).inputFiles())
    assert registry.baskets(t).inputFiles() == registry.baskets(t).inputFiles()


def test_cooccurrence_shuffles_no_counts(spark, tables):
    """Counts of products do not widen the pairs where only the pairs are counted."""
    p = plan(sim.cooccurrence(R.prior_lines(tables)))
    assert not re.search(r"\bn_[lr]#", p) and "partial_sum((m_l" in p


def test_broadcast_by_rows_of_packed_files(spark, scratch):
    """Files that hold many rows in few bytes are no small table."""
    from basketrec.plans.broadcast import broadcast_if_small, estimated_bytes

    path = scratch("packed")
    spark.range(50000).selectExpr("id % 2 as id", "'a long name of a product' as name").coalesce(1).write.parquet(path)
    packed = spark.read.parquet(path)
    most = 4 * estimated_bytes(packed)
    assert most < 50000 * 24
    p = plan(spark.range(10).join(broadcast_if_small(packed, max_bytes=most), "id"))
    assert "SortMergeJoin" in p and "Broadcast" not in p
    assert "BroadcastHashJoin" in plan(spark.range(10).join(broadcast_if_small(packed), "id"))
