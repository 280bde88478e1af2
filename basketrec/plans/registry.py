"""Registered queries: key -> (Spark builder, DuckDB oracle SQL or None).

Every builder reads the test tables under ``sf_dir`` whole (through the
basket adapter) and returns a lazy DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketrec import schemas
from basketrec.functions.vectors import centroid_cosine
from basketrec.operators import etl, evaluate, factor, knn, matrix, minhash, models, similarity as sim, spectral, tiles
from basketrec.plans.oracle import md5_key, named, similar_sql, with_ctes
from basketrec.plans.staging import Staging
from basketrec.session import scratch_path, shuffles_freed
from basketrec.sources import files
from basketrec.sources.testdata import BasketTables, load_basket_tables

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: Callable[[BasketTables, SparkSession, str], DataFrame]):
        def builder(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(load_basket_tables(spark, sf_dir), spark, sf_dir)
        builder.__name__ = name
        builder.__doc__ = fn.__doc__
        REGISTRY[name] = (builder, sql)
        return fn
    return deco


_CATALOGS: dict[tuple, str] = {}


def catalog(t: BasketTables) -> DataFrame:
    """The catalogue, written once per input like the other tables, so that its size is known."""
    spark, key = t.products.sparkSession, (*t.products.inputFiles(), t.products.sparkSession.sparkContext.applicationId)
    if key not in _CATALOGS:
        path = scratch_path(spark, "catalog")
        etl.product_catalog(t.products, t.aisles, t.departments).write.parquet(path)
        _CATALOGS[key] = path
    return spark.read.schema(schemas.CATALOG).parquet(_CATALOGS[key])


def prior_facts(t: BasketTables) -> DataFrame:
    return etl.order_facts(t.order_products_prior, t.orders, catalog(t), "prior")


def prior_lines(t: BasketTables) -> DataFrame:
    """Prior fact rows without catalogue columns (same rows as prior_facts)."""
    return etl.order_lines(t.order_products_prior, t.orders, "prior")


def last_lines(t: BasketTables) -> DataFrame:
    """Train fact rows without catalogue columns (same rows as last_facts)."""
    return etl.order_lines(t.order_products_train, t.orders, "train")


def last_facts(t: BasketTables) -> DataFrame:
    return etl.order_facts(t.order_products_train, t.orders, catalog(t), "train")


#: Digits of scores: engines add up floating-point numbers in different orders.
AP_DIGITS = 12
FACT_COLS = ", ".join(etl.FACT_COLUMNS)

# --- ETL ----------------------------------------------------------------------------------


@register("eval_split", with_ctes(["b_orders"], "SELECT * FROM b_orders WHERE eval_set IN ('prior', 'train', 'test')"))
def q_eval_split(t, spark, sf_dir):
    """Orders of the three splits."""
    parts = [etl.eval_split(t.orders, s) for s in ("prior", "train", "test")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("split_profile", with_ctes(["b_orders"], """
SELECT 'all' AS eval_set, count(DISTINCT user_id) AS users FROM b_orders
UNION ALL
SELECT eval_set, count(DISTINCT user_id) AS users FROM b_orders GROUP BY eval_set"""))
def q_split_profile(t, spark, sf_dir):
    return etl.split_profile(t.orders)


@register("product_catalog", with_ctes(["b_catalog"], "SELECT * FROM b_catalog"))
def q_product_catalog(t, spark, sf_dir):
    return etl.product_catalog(t.products, t.aisles, t.departments)


@register("prior_order_products", with_ctes(["b_prior_facts"], "SELECT * FROM b_prior_facts"))
def q_prior_order_products(t, spark, sf_dir):
    return prior_facts(t)


@register("last_order_products", with_ctes(["b_last_facts"], "SELECT * FROM b_last_facts"))
def q_last_order_products(t, spark, sf_dir):
    return last_facts(t)


@register("merge_profile", with_ctes(["b_op_prior", "b_orders", "b_catalog"], """
SELECT 'prior_lines' AS stage, count(*) AS rows FROM b_op_prior
UNION ALL
SELECT 'prior_with_orders' AS stage, count(*) AS rows
FROM b_op_prior op JOIN b_orders o ON op.order_id = o.order_id AND o.eval_set = 'prior'
UNION ALL
SELECT 'prior_with_products' AS stage, count(*) AS rows
FROM b_op_prior op JOIN b_orders o ON op.order_id = o.order_id AND o.eval_set = 'prior'
LEFT JOIN b_catalog c ON op.product_id = c.product_id"""))
def q_merge_profile(t, spark, sf_dir):
    return etl.merge_profile(t.order_products_prior, t.orders, catalog(t), "prior")


@register("dept_sample", with_ctes(["b_prior_facts"], "SELECT * FROM b_prior_facts WHERE department_id = 5"))
def q_dept_sample(t, spark, sf_dir):
    return etl.dept_sample(prior_facts(t), "department_id", 5)


# --- similarity ---------------------------------------------------------------------------

@register("cooccurrence", with_ctes(["b_cooc", "b_catalog"], """
SELECT c.product_id_left, c.product_id_right, l.product_name AS product_name_left,
       r.product_name AS product_name_right, c.cooccurances
FROM b_cooc c
LEFT JOIN b_catalog l ON l.product_id = c.product_id_left
LEFT JOIN b_catalog r ON r.product_id = c.product_id_right"""))
def q_cooccurrence(t, spark, sf_dir):
    return sim.cooccurrence(prior_lines(t), catalog(t))


@register("cooccurrence_by_user_order", with_ctes(["b_cooc"], "SELECT * FROM b_cooc"))
def q_cooccurrence_by_user_order(t, spark, sf_dir):
    """Co-occurrence of baskets told apart by (user, order)."""
    return sim.cooccurrence(prior_lines(t), basket_key=("user_id", "order_id"))


@register("item_norms", with_ctes(["b_norms"], "SELECT * FROM b_norms"))
def q_item_norms(t, spark, sf_dir):
    return sim.item_norms(prior_lines(t))


@register("cosine_similarity", with_ctes(["b_cosine"], "SELECT * FROM b_cosine"))
def q_cosine_similarity(t, spark, sf_dir):
    return sim.cosine_similarity(prior_lines(t))


@register("topk_neighbours", with_ctes(["b_topk10"], "SELECT * FROM b_topk10"))
def q_topk_neighbours(t, spark, sf_dir):
    return sim.topk_neighbours(sim.cosine_similarity(prior_lines(t)), k=10)


@register("top_pairs", with_ctes(["b_cooc"], """
SELECT product_id_left, product_id_right, cooccurances FROM b_cooc
WHERE product_id_left <> product_id_right
ORDER BY cooccurances DESC, product_id_left, product_id_right LIMIT 10"""))
def q_top_pairs(t, spark, sf_dir):
    return sim.top_pairs(sim.cooccurrence(prior_lines(t)), 10)



# --- models and evaluation ------------------------------------------------------------

_STAGED: dict[tuple, DataFrame] = {}


def staged(t: BasketTables, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A table that several steps of a query read, written once per input."""
    spark = t.orders.sparkSession
    key = (name, *t.orders.inputFiles(), *t.order_products_prior.inputFiles(), spark.sparkContext.applicationId)
    if key not in _STAGED:
        df, path = build(), scratch_path(spark, name)
        with shuffles_freed(spark):
            df.write.parquet(path)
        _STAGED[key] = spark.read.schema(df.schema).parquet(path)
    return _STAGED[key]


def last_prior(t):
    return staged(t, "last-prior", lambda: models.last_prior_order(prior_lines(t)))


def baskets(t):
    return staged(t, "baskets", lambda: models.input_baskets(last_prior(t), last_lines(t)))


def neighbours(t, k=10):
    return sim.topk_neighbours(sim.cosine_similarity(prior_lines(t)), k=k)


def pred_cosine(t):
    return models.predict_cosine(baskets(t), neighbours(t), t.products)


def pred_random(t):
    return models.predict_random(baskets(t), t.products, k=10, seed=1)


def pred_baseline(t):
    return models.predict_baseline(baskets(t), last_prior(t), t.products, k=10, seed=1)


def ap(t, pred):
    b = baskets(t)
    return evaluate.average_precision(pred, models.actual_baskets(last_lines(t), b), b, k=10, digits=AP_DIGITS)


@register("last_prior_order", with_ctes(["b_last_prior"], "SELECT * FROM b_last_prior"))
def q_last_prior_order(t, spark, sf_dir):
    return models.last_prior_order(prior_lines(t))


@register("input_baskets", with_ctes(["b_last_prior", "b_last_facts"], f"""
SELECT * FROM b_last_prior WHERE user_id IN (
  SELECT DISTINCT user_id FROM (
    SELECT user_id FROM b_last_prior WHERE user_id IN (SELECT user_id FROM b_last_facts)
    ORDER BY {md5_key(1, 'user_id', 'product_id', 'add_to_cart_order')}, user_id LIMIT 100) s)"""))
def q_input_baskets(t, spark, sf_dir):
    """Seeded sample: the users of 100 hash-drawn eligible lines (a sampling operator)."""
    return models.input_baskets(last_prior(t), last_lines(t), n_users=100, seed=1, by="row")


@register("input_baskets_by_user", with_ctes(["b_input"], f"""
SELECT * FROM b_input WHERE user_id IN (
  SELECT user_id FROM (SELECT DISTINCT user_id FROM b_input) u ORDER BY {md5_key(1, 'user_id')}, user_id LIMIT 100)"""))
def q_input_baskets_by_user(t, spark, sf_dir):
    """Seeded sample: 100 hash-drawn users (a sampling operator)."""
    return models.input_baskets(last_prior(t), last_lines(t), n_users=100, seed=1, by="user")


@register("actual_baskets", with_ctes(["b_actual"], "SELECT * FROM b_actual"))
def q_actual_baskets(t, spark, sf_dir):
    return models.actual_baskets(last_lines(t), baskets(t))


@register("top_products", with_ctes(["b_top100"], "SELECT * FROM b_top100"))
def q_top_products(t, spark, sf_dir):
    return models.top_products(last_prior(t), 100)


@register("predict_cosine", with_ctes(["b_pred_cos", "b_products"],
                                      named("b_pred_cos", "p.cosine_sims,")))
def q_predict_cosine(t, spark, sf_dir):
    return pred_cosine(t)


@register("predict_random", with_ctes(["b_pred_rand", "b_products"], named("b_pred_rand", "")))
def q_predict_random(t, spark, sf_dir):
    return pred_random(t)


@register("predict_baseline", with_ctes(["b_pred_base", "b_products"],
                                        named("b_pred_base", "p.purchasecount,")))
def q_predict_baseline(t, spark, sf_dir):
    return pred_baseline(t)


@register("average_precision", with_ctes(["b_ap_cos"], "SELECT * FROM b_ap_cos"))
def q_average_precision(t, spark, sf_dir):
    """Per-user AP@10 of the cosine model over every scored user."""
    return ap(t, pred_cosine(t))


@register("map_score", with_ctes(["b_ap_cos", "b_ap_rand", "b_ap_base"], """
SELECT 'cosine' AS modelname, count(*) AS users, round(avg(MAP), 12) AS meanMAP FROM b_ap_cos
UNION ALL
SELECT 'random' AS modelname, count(*) AS users, round(avg(MAP), 12) AS meanMAP FROM b_ap_rand
UNION ALL
SELECT 'baseline' AS modelname, count(*) AS users, round(avg(MAP), 12) AS meanMAP FROM b_ap_base"""))
def q_map_score(t, spark, sf_dir):
    """MAP@10 of the three models side by side."""
    b = baskets(t)
    return evaluate.score_models(
        {"cosine": pred_cosine(t), "random": pred_random(t), "baseline": pred_baseline(t)},
        models.actual_baskets(last_lines(t), b), b, k=10, digits=AP_DIGITS)


@register("global_map", with_ctes(["b_ap_cos", "b_ap_rand", "b_ap_base"], """
SELECT 'map-cosine' AS modelname, round(avg(MAP), 12) AS meanMAP FROM b_ap_cos
UNION ALL
SELECT 'map-random' AS modelname, round(avg(MAP), 12) AS meanMAP FROM b_ap_rand
UNION ALL
SELECT 'map-baseline' AS modelname, round(avg(MAP), 12) AS meanMAP FROM b_ap_base"""))
def q_global_map(t, spark, sf_dir):
    """Per-user scores written as map-<model>.csv, read back by file glob,
    averaged per model."""
    folder = scratch_path(spark, "map")
    for name, pred in (("cosine", pred_cosine(t)), ("random", pred_random(t)),
                       ("baseline", pred_baseline(t))):
        files.write_csv(ap(t, pred), f"{folder}/map-{name}.csv")
    return evaluate.global_map(files.read_score_files(spark, folder), AP_DIGITS)




@register("predict_cosine_by_score", with_ctes(["b_pred_cos_score", "b_products"],
                                               named("b_pred_cos_score", "p.cosine_sims,")))
def q_predict_cosine_by_score(t, spark, sf_dir):
    """Cosine model, each user's distinct predicted products ranked by their
    best similarity over the basket lines (rank_mode='score')."""
    return models.predict_cosine(baskets(t), neighbours(t), t.products, rank_mode="score")


@register("predict_baseline_per_line", with_ctes(["b_pred_base_line", "b_products"],
                                                 named("b_pred_base_line", "p.purchasecount,")))
def q_predict_baseline_per_line(t, spark, sf_dir):
    """Baseline model with an independent draw of 10 of the top-100 per line."""
    return models.predict_baseline(baskets(t), last_prior(t), t.products, k=10, seed=1,
                                   per_line_seed=True)


# --- matrices, ratings, ALS -----------------------------------------------------------------

@register("user_item_matrix", with_ctes(["b_user_item"], "SELECT * FROM b_user_item"))
def q_user_item_matrix(t, spark, sf_dir):
    return matrix.user_item_matrix(prior_lines(t))


@register("matrix_l1", with_ctes(["b_user_item"], """
SELECT u.user_id, u.product_id, u.purchases,
       CAST(u.purchases AS DOUBLE) / CAST(s.l1 AS DOUBLE) AS l1_value
FROM b_user_item u JOIN (SELECT user_id, sum(abs(purchases)) AS l1 FROM b_user_item GROUP BY user_id) s
  ON u.user_id = s.user_id"""))
def q_matrix_l1(t, spark, sf_dir):
    """Rows of the user-item matrix scaled to unit L1 norm."""
    return matrix.l1_normalize(matrix.user_item_matrix(prior_lines(t)), "user_id", "purchases")


@register("item_matrix_wide", with_ctes(["b_cooc"], """
SELECT product_id_left, list(product_id_right ORDER BY product_id_right) AS columns,
       list(CAST(cooccurances AS BIGINT) ORDER BY product_id_right) AS row_values
FROM b_cooc GROUP BY product_id_left"""))
def q_item_matrix_wide(t, spark, sf_dir):
    return matrix.item_matrix_wide(prior_lines(t))


@register("user_matrix_wide", with_ctes(["b_user_item"], """
SELECT user_id, list(product_id ORDER BY product_id) AS columns, list(purchases ORDER BY product_id) AS row_values
FROM b_user_item GROUP BY user_id"""))
def q_user_matrix_wide(t, spark, sf_dir):
    return matrix.user_matrix_wide(prior_lines(t))


@register("matrix_l1_vectors", with_ctes(["b_user_item"], """
SELECT u.user_id, list(u.product_id ORDER BY u.product_id) AS columns, list(u.purchases ORDER BY u.product_id) AS row_values,
       list(CAST(u.purchases AS DOUBLE) / CAST(s.l1 AS DOUBLE) ORDER BY u.product_id) AS norm_values
FROM b_user_item u JOIN (SELECT user_id, sum(abs(purchases)) AS l1 FROM b_user_item GROUP BY user_id) s
  ON u.user_id = s.user_id GROUP BY u.user_id"""))
def q_matrix_l1_vectors(t, spark, sf_dir):
    """Rows of the user-item matrix as arrays, scaled to unit L1 norm."""
    return matrix.l1_normalize_rows(matrix.user_matrix_wide(prior_lines(t)))


@register("matrix_text_roundtrip", with_ctes(["b_user_item"], """
SELECT user_id, product_id, CAST(purchases AS DOUBLE) AS purchases FROM b_user_item"""))
def q_matrix_text_roundtrip(t, spark, sf_dir):
    """The user-item matrix as CoordinateMatrix, written as 'i|j|value' text and parsed back."""
    path = scratch_path(spark, "matrix")
    cm = matrix.to_coordinate_matrix(matrix.user_item_matrix(prior_lines(t)), "user_id", "product_id", "purchases")
    files.save_sim_matrix(cm, path)
    return files.read_pipe_text(spark, path, "user_id long, product_id long, purchases double")


@register("cooc_dimensions", with_ctes(["b_cooc"], """
SELECT max(product_id_left) + 1 AS num_rows, max(product_id_right) + 1 AS num_cols, count(*) AS entries
FROM b_cooc"""))
def q_cooc_dimensions(t, spark, sf_dir):
    return matrix.dimensions(sim.cooccurrence(prior_lines(t)))


@register("ratings", with_ctes(["b_ratings"], "SELECT * FROM b_ratings"))
def q_ratings(t, spark, sf_dir):
    return factor.ratings(prior_lines(t))


def als_recs(t):
    return factor.als_recommendations(factor.ratings(prior_lines(t)), baskets(t), k=10)


@register("als_recommendations", None)
def q_als_recommendations(t, spark, sf_dir):
    """Implicit ALS (rank 50) top-10 unbought products for every scored user."""
    return als_recs(t)


@register("als_map_score", None)
def q_als_map_score(t, spark, sf_dir):
    """MAP@10 of the ALS model on the same held-out baskets."""
    recs = als_recs(t).select(F.col("userid").alias("user_id"),
                              F.col("productid").alias("predicted_product"), "pos")
    return evaluate.compare_models({"als": ap(t, recs)}, AP_DIGITS)


@register("als_user_invariants", with_ctes(["b_input", "b_ratings"], """
SELECT u.user_id AS userid, least(10, i.n - coalesce(b.n, 0)) AS recommended, CAST(0 AS BIGINT) AS bought, CAST(0 AS BIGINT) AS out_of_order
FROM (SELECT DISTINCT user_id FROM b_input) u
LEFT JOIN (SELECT user_id, count(*) AS n FROM b_ratings GROUP BY user_id) b ON u.user_id = b.user_id
CROSS JOIN (SELECT count(DISTINCT product_id) AS n FROM b_ratings) i
WHERE i.n > coalesce(b.n, 0)"""))
def q_als_user_invariants(t, spark, sf_dir):
    """For every scored user the number of its ALS recommendations, how many of them it had
    bought, and how many score above the one before or leave a gap in the positions."""
    rating = factor.ratings(prior_lines(t))
    return factor.recommendation_invariants(factor.als_recommendations(rating, baskets(t), k=10), rating)


# --- latent factors, nearest rows -----------------------------------------------------------

LSA_RANK = 8


@register("lsa_invariants", f"""
SELECT CAST(i AS INTEGER) AS component, true AS unit_length, true AS singular FROM range(1, {LSA_RANK + 1}) r(i)""")
def q_lsa_invariants(t, spark, sf_dir):
    """Of the leading factors of the co-occurrence matrix: whether each has length 1 and is a singular
    vector of its value (matrix times vector within 5 % of value times vector)."""
    stage = Staging(spark, "cooccurrence")
    cooc = stage.write(sim.cooccurrence(prior_lines(t)), "pairs")
    found = spectral.latent_factors(cooc, rank=LSA_RANK, written=True)
    checked = spectral.eigen_residuals(cooc, found, written=True)
    stage.drop_older(0)  # the residuals are numbers
    return checked.select("component", (F.abs(F.col("norm") - 1) < 1e-6).alias("unit_length"), (F.col("residual") < 0.05).alias("singular"))


@register("lsa_neighbours", None)
def q_lsa_neighbours(t, spark, sf_dir):
    """The 10 products nearest to every product by the cosine of their latent factors."""
    found = spectral.latent_factors(sim.cooccurrence(prior_lines(t)), rank=LSA_RANK)
    near = knn.nearest_vectors(found.factors, "product_id", "vector", 10).rows
    return near.select(F.col("id").alias(sim.L), F.col("neighbour").alias(sim.R), F.col("score").alias("cosine"), "rank")


@register("item_als_neighbours", None)
def q_item_als_neighbours(t, spark, sf_dir):
    """The 10 products nearest to every product by the cosine of factors of item-item ALS."""
    near = knn.nearest_vectors(factor.item_factors(sim.cooccurrence(prior_lines(t))), "product_id", "vector", 10).rows
    return near.select(F.col("id").alias(sim.L), F.col("neighbour").alias(sim.R), F.col("score").alias("cosine"), "rank")


@register("tiled_cooccurrence", with_ctes(["b_cooc"], "SELECT * FROM b_cooc"))
def q_tiled_cooccurrence(t, spark, sf_dir):
    """Co-occurrence as the product of the tiled order-product matrix with its transpose."""
    tiled = tiles.tiled(sim.basket_lines(prior_lines(t)), "order_id", "product_id", "m")
    return tiles.gram(tiled, sim.L, sim.R, "cooccurances").withColumn("cooccurances", F.col("cooccurances").cast("long"))


@register("tiled_l1", with_ctes(["b_user_item"], """
SELECT u.user_id, u.product_id, CAST(u.purchases AS DOUBLE) / CAST(s.l1 AS DOUBLE) AS l1_value
FROM b_user_item u JOIN (SELECT user_id, sum(abs(purchases)) AS l1 FROM b_user_item GROUP BY user_id) s ON u.user_id = s.user_id"""))
def q_tiled_l1(t, spark, sf_dir):
    """Rows of the tiled user-item matrix scaled to unit L1 norm."""
    tiled = tiles.tiled(matrix.user_item_matrix(prior_lines(t)), "user_id", "product_id", "purchases")
    return tiles.cells_of(tiles.l1_rows(tiled), "user_id", "product_id", "l1_value")


@register("embedding_topk", f"""
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT a.vec_id, b.vec_id AS neighbour, round(list_cosine_similarity(a.v, b.v), {knn.DIGITS}) AS cosine FROM e a JOIN e b ON a.vec_id <> b.vec_id)
SELECT vec_id, neighbour, cosine, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY cosine DESC, neighbour) AS INTEGER) AS rank
FROM p QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY cosine DESC, neighbour) <= 10""")
def q_embedding_topk(t, spark, sf_dir):
    """The 10 nearest embeddings of every embedding by cosine, exactly."""
    emb = spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet")
    return knn.nearest_vectors(emb, "vec_id", "embedding", 10).rows.select(F.col("id").alias("vec_id"), "neighbour", F.col("score").alias("cosine"), "rank")


SHARED_ORDERS = 0.04


@register("shared_order_links", with_ctes(["b_op_prior"], f"""
, s AS (SELECT DISTINCT product_id, order_id FROM b_op_prior),
z AS (SELECT product_id, count(*) AS n, list(order_id ORDER BY order_id) AS orders FROM s GROUP BY product_id),
c AS (SELECT min(product_id) AS product_id, any_value(n) AS n FROM z GROUP BY orders),
k AS (SELECT s.* FROM s JOIN c ON s.product_id = c.product_id),
p AS (SELECT a.product_id AS l, b.product_id AS r, count(*) AS shared FROM k a JOIN k b ON a.order_id = b.order_id AND a.product_id < b.product_id GROUP BY 1, 2)
SELECT l AS product_id_left, r AS product_id_right, shared, shared / (x.n + y.n - shared) AS jaccard
FROM p JOIN c x ON x.product_id = l JOIN c y ON y.product_id = r WHERE shared / (x.n + y.n - shared) >= {SHARED_ORDERS}"""))
def q_shared_order_links(t, spark, sf_dir):
    """Pairs of product classes whose order sets have a Jaccard similarity of 0.04 or more, found by MinHash."""
    return minhash.shared_order_links(prior_lines(t), SHARED_ORDERS, recall=0.999999)[0]


# --- similar items ------------------------------------------------------------------------

@register("similar_items_cosine", with_ctes(["b_cosine", "b_catalog"], similar_sql("cosine_similarity", "b_cosine")))
def q_similar_items_cosine(t, spark, sf_dir):
    """Top-30 products by cosine for every catalogue product as probe."""
    c = catalog(t)
    return sim.similar_items(sim.cosine_similarity(prior_lines(t)), c, c.select("product_id"),
                             method="cosine", n=30)


@register("similar_items_cooccurrence", with_ctes(["b_cooc", "b_catalog"], similar_sql("cooccurances", "b_cooc")))
def q_similar_items_cooccurrence(t, spark, sf_dir):
    c = catalog(t)
    return sim.similar_items(sim.cooccurrence(prior_lines(t)), c, c.select("product_id"),
                             method="cooccurrence", n=30)


# --- sources and sinks ----------------------------------------------------------------------

@register("csv_roundtrip", with_ctes(["b_catalog"], "SELECT * FROM b_catalog"))
def q_csv_roundtrip(t, spark, sf_dir):
    """Catalogue written as CSV with header and read back with its schema."""
    path = scratch_path(spark, "csv")
    c = catalog(t)
    files.write_csv(c, path)
    return files.read_csv(spark, path, c.schema)


@register("parquet_roundtrip", with_ctes(["b_orders"], "SELECT * FROM b_orders"))
def q_parquet_roundtrip(t, spark, sf_dir):
    """Orders written once, partitioned by eval_set; all splits are read back."""
    path = scratch_path(spark, "orders")
    etl.write_eval_split(t.orders, path)
    return files.read_parquet(spark, path)


@register("sim_text_roundtrip", with_ctes(["b_cosine"], """
SELECT product_id_left, product_id_right, cosine_similarity FROM b_cosine"""))
def q_sim_text_roundtrip(t, spark, sf_dir):
    """All similarities as 'left|right|value' text, parsed back."""
    path = scratch_path(spark, "sims")
    with shuffles_freed(spark):
        files.write_pipe_text(sim.cosine_similarity(prior_lines(t)), path, compression="gzip")
    return files.read_pipe_text(spark, path)


@register("header_cleanup", with_ctes(["b_last_prior"], "SELECT user_id, product_id FROM b_last_prior"))
def q_header_cleanup(t, spark, sf_dir):
    """Last prior orders written as several CSV part files, each with its
    header, read as one concatenated text table; header rows dropped."""
    path = scratch_path(spark, "concat")
    files.write_csv(last_prior(t).select("user_id", "order_id", "product_id", "order_number"), path)
    return files.read_concat_csv(spark, path)


@register("map_text_parse", with_ctes(["b_ap_cos"], "SELECT * FROM b_ap_cos"))
def q_map_text_parse(t, spark, sf_dir):
    """Per-user scores as "{'user': score, ...}" text, parsed back."""
    path = scratch_path(spark, "maptext")
    scores = ap(t, pred_cosine(t))
    text = scores.select(F.concat(F.lit("'"), F.col("userid").cast("string"), F.lit("': "),
                                  F.col("MAP").cast("string")).alias("value"))
    text.write.option("lineSep", ",").text(path)
    parsed = files.parse_dict_text(spark, path, trim=True)
    return parsed.select(F.col("userid").cast("long").alias("userid"), F.col("MAP").cast("double").alias("MAP"))


@register("row_sample", with_ctes(["b_prior_facts"], etl.row_sample_sql("b_prior_facts", 0.10, 42)))
def q_row_sample(t, spark, sf_dir):
    """10 % sample with replacement of the prior facts, seeded."""
    return etl.row_sample(prior_facts(t), 0.10, seed=42, key=etl.SAMPLE_KEY)



# --- array cosine -----------------------------------------------------------------------------

@register("embedding_centroid_cosine", """
WITH e AS (SELECT vec_id, label, embedding FROM embeddings),
p AS (SELECT label, pos, avg(CAST(v AS DOUBLE)) AS m
      FROM (SELECT label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS pos FROM e) t
      GROUP BY label, pos),
c AS (SELECT label, list(m ORDER BY pos) AS centroid FROM p GROUP BY label),
d AS (SELECT e.vec_id, e.label,
             list_sum(list_transform(list_zip(e.embedding, c.centroid), lambda z: CAST(z[1] AS DOUBLE) * z[2])) AS dot,
             sqrt(list_sum(list_transform(e.embedding, lambda a: CAST(a AS DOUBLE) * CAST(a AS DOUBLE)))) AS nx,
             sqrt(list_sum(list_transform(c.centroid, lambda a: a * a))) AS ny
      FROM e JOIN c ON e.label = c.label)
SELECT vec_id, label, round(CASE WHEN nx * ny = 0 THEN NULL ELSE dot / (nx * ny) END, 9) AS cosine_to_centroid FROM d""")
def q_embedding_centroid_cosine(t, spark, sf_dir):
    """Array cosine (equal-length arrays) of every embedding to its label's
    mean vector, rounded to 9 digits (float sums differ in order)."""
    emb = spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet")
    out = centroid_cosine(emb, "label", "embedding", "vec_id")
    return out.select("vec_id", "label", F.round("cosine_to_centroid", 9).alias("cosine_to_centroid"))



# --- end-to-end -----------------------------------------------------------------------------

@register("end_to_end_global_map", with_ctes(["b_ap_cos", "b_ap_rand", "b_ap_base"], """
SELECT 'map-cosine' AS modelname, round(avg(MAP), 12) AS meanMAP FROM b_ap_cos
UNION ALL
SELECT 'map-random' AS modelname, round(avg(MAP), 12) AS meanMAP FROM b_ap_rand
UNION ALL
SELECT 'map-baseline' AS modelname, round(avg(MAP), 12) AS meanMAP FROM b_ap_base"""))
def q_end_to_end_global_map(t, spark, sf_dir):
    """The whole job — facts, similarities, neighbours, baskets, three
    models, per-user scores, score files — with every reused table written
    once to the shared folder; returns the global MAP per model."""
    from basketrec.plans.job import BasketJob, JobConfig

    return BasketJob(spark, t, JobConfig(digits=AP_DIGITS)).run()


def queries() -> dict[str, Builder]:
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-10 neighbours per product by cosine, with both product names."""
    t = load_basket_tables(spark, sf_dir)
    top = sim.topk_neighbours(sim.cosine_similarity(prior_lines(t)), k=10)
    return sim.attach_names(top, catalog(t)).select(
        sim.L, sim.R, "product_name_left", "product_name_right", "cosine_similarity", "rank")
