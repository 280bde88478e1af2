"""A skewed fixture end to end: one user with most orders, one basket with
a third of all lines, one product in almost every basket.  The salted run
(hot baskets split over many tasks) must equal the plain run table by table."""

from basketrec import schemas
from basketrec.operators import etl, similarity
from basketrec.plans import skew
from basketrec.plans.job import BasketJob, JobConfig
from basketrec.sources.testdata import BasketTables


def skewed_tables(spark):
    orders, lines = [], []
    oid = 0
    for user, n_orders in [(1, 30)] + [(u, 2 + u % 3) for u in range(2, 12)]:
        for k in range(1, n_orders + 1):
            oid += 1
            eval_set = "train" if k == n_orders else "prior"
            orders.append((oid, user, eval_set, k, k % 7, 9, None if k == 1 else 7.0))
            if oid == 1:
                products = list(range(1, 61)) + [1, 1]          # the hot basket, with repeats
            else:
                products = [1] + [(oid * 7 + j * 3) % 40 + 2 for j in range(oid % 4 + 1)]
            for pos, p in enumerate(products, 1):
                lines.append((oid, p, pos, 0, eval_set))
    o = spark.createDataFrame(orders, schemas.ORDERS)
    op = [r[:4] for r in lines if r[4] == "prior"]
    ot = [r[:4] for r in lines if r[4] == "train"]
    products = spark.createDataFrame([(p, f"p{p}", p % 3 + 1, 1) for p in range(1, 70)], schemas.PRODUCTS)
    aisles = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], schemas.AISLES)
    depts = spark.createDataFrame([(1, "d")], schemas.DEPARTMENTS)
    return BasketTables(o, spark.createDataFrame(op, schemas.ORDER_PRODUCTS),
                        spark.createDataFrame(ot, schemas.ORDER_PRODUCTS), products, aisles, depts)


def test_salted_job_equals_plain_job(spark, scratch):
    t = skewed_tables(spark)
    plain = BasketJob(spark, t, JobConfig(), scratch("plain"))
    salted = BasketJob(spark, t, JobConfig(pairs_per_task=40, lines_per_task=10), scratch("salted"))
    assert plain.run().collect() and sorted(plain.run().collect()) == sorted(salted.run().collect())
    for name in ("similarities", "neighbours", "predictions/cosine", "scores"):
        a = plain.spark.read.parquet(f"{plain.out}/{plain.fingerprint}/{name}")
        b = salted.spark.read.parquet(f"{salted.out}/{salted.fingerprint}/{name}")
        assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
    # the hot basket holds 60 distinct products: 1770 pairs -> 45 salts at 40 pairs per task
    sims = plain.spark.read.parquet(f"{plain.out}/{plain.fingerprint}/similarities")
    assert sims.where("product_id_left = 1 AND product_id_right = 1").first().cosine_similarity > 1  # repeats


def test_hot_keys_are_split_before_the_shuffle(spark):
    """A key with most rows is dealt to several salts; results and columns are those of a plain join."""
    lines = spark.createDataFrame([(1 if i % 4 else i, i, i % 9) for i in range(4000)] + [(None, 1, 1)], "order_id long, product_id long, cart int")
    orders = spark.createDataFrame([(i, i % 5) for i in range(3000)] + [(None, 7)], "order_id long, user_id long")
    hot = {r["_hot"]: r["_n"] for r in skew.heavy_keys(lines, "order_id").orderBy("_n", ascending=False).limit(1).collect()}
    assert list(hot.values()) == [3000]
    for how in ("inner", "left"):
        a, b = lines.join(orders, "order_id", how), skew.join_split(lines, orders, "order_id", 100, how)
        assert sorted(a.columns) == sorted(b.columns)
        b = b.select(*a.columns)
        assert a.count() == b.count() > 3000 and a.exceptAll(b).count() == 0
    t = skewed_tables(spark)
    plain = etl.order_lines(t.order_products_prior, t.orders, "prior")
    split = etl.order_lines(t.order_products_prior, t.orders, "prior", lines_per_task=10)
    assert plain.columns == split.columns and plain.count() == split.count() and plain.exceptAll(split).count() == 0


def test_plans_without_broadcast_threshold(spark):
    """Without size-based broadcasts the hot baskets still are salted before the pair join."""
    t = skewed_tables(spark)
    facts = etl.order_lines(t.order_products_prior, t.orders, "prior")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = similarity.cosine_similarity(facts, pairs_per_task=40)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrderedAndProject(limit=100000" in plan and "hashpartitioning(order_id" in plan
        split = {tuple(r) for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert split == {tuple(r) for r in similarity.cosine_similarity(facts).collect()}
