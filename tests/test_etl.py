from pyspark.sql import functions as F

from basketrec import schemas
from basketrec.operators import etl


def orders(spark):
    rows = [
        (1, 1, "prior", 1, 2, 8, None), (2, 1, "prior", 2, 3, 7, 15.0), (3, 1, "train", 3, 1, 9, 7.0),
        (4, 2, "prior", 1, 0, 10, None), (5, 2, "test", 2, 4, 11, 30.0),
        (6, 3, "prior", 1, 5, 12, None),
    ]
    return spark.createDataFrame(rows, schemas.ORDERS)


def catalogue(spark):
    products = spark.createDataFrame(
        [(1, "Nuts, mixed", 1, 1), (2, "Milk", 2, 1), (3, "Orphan aisle", 99, 1)], schemas.PRODUCTS)
    aisles = spark.createDataFrame([(1, "snacks"), (2, "dairy")], schemas.AISLES)
    departments = spark.createDataFrame([(1, "food")], schemas.DEPARTMENTS)
    return etl.product_catalog(products, aisles, departments)


def test_eval_split_and_profile(spark):
    o = orders(spark)
    assert {r.order_id for r in etl.eval_split(o, "train").collect()} == {3}
    prof = {r.eval_set: r.users for r in etl.split_profile(o).collect()}
    assert prof == {"all": 3, "prior": 3, "train": 1, "test": 1}


def test_catalog_inner_join_drops_unknown_aisle(spark):
    cat = catalogue(spark)
    assert sorted(r.product_id for r in cat.collect()) == [1, 2]
    assert cat.columns == ["product_id", "product_name", "aisle_id", "department_id", "aisle", "department"]


def test_order_facts_left_join_keeps_unknown_products(spark):
    op = spark.createDataFrame([(1, 1, 1, 0), (1, 3, 2, 0), (2, 42, 1, 0), (3, 2, 1, 1), (77, 1, 1, 0)],
                               schemas.ORDER_PRODUCTS)
    facts = etl.order_facts(op, orders(spark), catalogue(spark), "prior")
    rows = {(r.order_id, r.product_id): r for r in facts.collect()}
    assert set(rows) == {(1, 1), (1, 3), (2, 42)}  # order 3 is train, order 77 unknown
    assert rows[(1, 1)].product_name == "Nuts, mixed" and rows[(1, 1)].user_id == 1
    assert rows[(1, 3)].product_name is None and rows[(2, 42)].aisle is None
    assert facts.columns == etl.FACT_COLUMNS
    lines = etl.order_lines(op, orders(spark), "prior")
    assert lines.count() == facts.count()
    prof = {r.stage: r.rows for r in etl.merge_profile(op, orders(spark), catalogue(spark), "prior").collect()}
    assert prof == {"prior_lines": 5, "prior_with_orders": 3, "prior_with_products": 3}


def test_write_eval_split_prunes_partitions(spark, scratch):
    path = scratch("split")
    etl.write_eval_split(orders(spark), path)
    df = spark.read.parquet(path).where(F.col("eval_set") == "test")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(eval_set" in plan
    assert [r.order_id for r in df.collect()] == [5]


def test_samples(spark):
    df = spark.range(10000)
    a = etl.row_sample(df, 0.1, seed=7).collect()
    b = etl.row_sample(df, 0.1, seed=7).collect()
    assert a == b and 700 < len(a) < 1300
    facts = spark.createDataFrame([(1, 5), (2, 4), (3, 5)], "product_id long, department_id long")
    assert [r.product_id for r in etl.dept_sample(facts).orderBy("product_id").collect()] == [1, 3]


def test_order_lines_are_dealt_by_size(spark, scratch, monkeypatch):
    """Twice the lines make twice the tasks, each with as many lines; small and unwritten tables are left as they are."""
    from basketrec.plans import broadcast

    monkeypatch.setattr(broadcast, "TASK_BYTES", 2000)

    def tasks(n):
        path = scratch("lines")
        rows = spark.range(n).selectExpr("id % 997 as order_id", "xxhash64(id) as product_id")
        rows.coalesce(1).write.parquet(path)
        dealt = broadcast.spread_by_size(spark.read.parquet(path), "order_id")
        assert dealt.count() == n
        return dealt.rdd.getNumPartitions()

    assert tasks(100) == 1
    few, many = tasks(4000), tasks(16000)
    assert few > 8 and 3 * few <= many <= 5 * few
    assert broadcast.spread_by_size(spark.createDataFrame([(1,)], "order_id long"), "order_id").rdd.getNumPartitions() <= 4
