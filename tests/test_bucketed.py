"""Joins and aggregations of bucketed tables have no exchange."""

import pytest

from basketrec.operators import factor, models, similarity
from basketrec.sources.bucketed import BucketedTable
from helpers import lines_df
from test_tiles import skewed


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_basket_lines_to_neighbours(spark, no_broadcast):
    facts = lines_df(spark, skewed())
    near = similarity.topk_neighbours(similarity.cosine_similarity(facts), 5)
    lines = facts.withColumnRenamed("product_id", "purchased_product")
    wanted = lines.join(near.withColumnRenamed(similarity.L, "purchased_product"), "purchased_product")
    with BucketedTable(lines, ["purchased_product"], 4) as a, BucketedTable(near.withColumnRenamed(similarity.L, "purchased_product"), ["purchased_product"], 4) as b:
        joined = a.join(b, "purchased_product")
        assert exchanges(joined) == 0 and exchanges(wanted) > 0
        assert joined.count() == wanted.count() > 0 and joined.exceptAll(wanted.select(*joined.columns)).count() == 0


def test_ratings_and_last_orders(spark, no_broadcast):
    facts = lines_df(spark, skewed()).selectExpr("*", "cast(order_id % 100 as int) as order_number")
    table = BucketedTable(facts, ["user_id", "order_id"], 4)
    sizes = table.read().groupBy("user_id", "order_id").count()
    joined = table.read().join(sizes, ["user_id", "order_id"])
    assert exchanges(joined) == 0
    assert sorted(factor.ratings(table.read()).collect()) == sorted(factor.ratings(facts).collect())
    assert sorted(models.last_prior_order(table.read()).collect()) == sorted(models.last_prior_order(facts).collect())
    table.drop()
    assert not spark.catalog.tableExists(table.name)
    assert spark.read.parquet(table.path).count() == facts.count()
