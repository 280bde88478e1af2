"""DuckDB SQL for the correctness gate.

Each query is the plain SQL statement of the same semantics, written
independently of the Spark plan (e.g. co-occurrence is the full line
self-join the definition states, not the pre-aggregated triangle).  The
basket model is derived from the TPC-H-style views with the mapping of
``basketrec.sources.testdata``; CTEs are declared once here and each query
names the ones it needs.
"""

from __future__ import annotations

# name -> (dependencies, body)
CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, deps: tuple[str, ...], body: str) -> None:
    CTES[name] = (deps, body)


def with_ctes(needed: list[str], select: str) -> str:
    """``WITH`` clause holding ``needed`` and their dependencies in order, then ``select``, which may
    start with a comma and further ones of its own."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in needed:
        visit(n)
    if not order:
        return select
    parts = ",\n".join(f"{n} AS (\n{CTES[n][1]}\n)" for n in order)
    return f"WITH {parts}{'' if select.lstrip().startswith(',') else chr(10)}{select}"


# --- basket model from the test tables ------------------------------------------------

cte("b_o_num", (), """
SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderdate AS ts,
       row_number() OVER w AS rn, lag(o_orderdate) OVER w AS prev_ts,
       (lead(1) OVER w) IS NULL AS is_last
FROM orders
WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")

cte("b_orders", ("b_o_num",), """
SELECT order_id, user_id,
       CASE WHEN is_last AND rn >= 2
            THEN CASE WHEN user_id % 3 = 0 THEN 'test' ELSE 'train' END
            ELSE 'prior' END AS eval_set,
       CAST(rn AS INTEGER) AS order_number,
       CAST(dayofweek(ts) AS INTEGER) AS order_dow,
       CAST(hour(ts) AS INTEGER) AS order_hour_of_day,
       CASE WHEN prev_ts IS NULL THEN NULL
            ELSE CAST(least(30, date_diff('day', CAST(prev_ts AS DATE), CAST(ts AS DATE))) AS DOUBLE)
       END AS days_since_prior_order
FROM b_o_num""")

cte("b_lines", ("b_orders",), """
SELECT order_id, product_id, add_to_cart_order,
       CAST(order_number > min(order_number) OVER (PARTITION BY user_id, product_id) AS INTEGER) AS reordered,
       eval_set
FROM (
  SELECT l.l_orderkey AS order_id, l.l_partkey AS product_id,
         CAST(row_number() OVER (PARTITION BY l.l_orderkey
              ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice) AS INTEGER)
           AS add_to_cart_order,
         o.user_id, o.order_number, o.eval_set
  FROM lineitem l JOIN b_orders o ON l.l_orderkey = o.order_id
) t""")

cte("b_op_prior", ("b_lines",), """
SELECT order_id, product_id, add_to_cart_order, reordered FROM b_lines WHERE eval_set = 'prior'""")

cte("b_op_train", ("b_lines",), """
SELECT order_id, product_id, add_to_cart_order, reordered FROM b_lines WHERE eval_set = 'train'""")

cte("b_aisles", (), """
SELECT CAST(dense_rank() OVER (ORDER BY aisle) AS BIGINT) AS aisle_id, aisle
FROM (SELECT DISTINCT p_type AS aisle FROM part WHERE p_type IS NOT NULL) t""")

cte("b_departments", (), """
SELECT CAST(dense_rank() OVER (ORDER BY department) AS BIGINT) AS department_id, department
FROM (SELECT DISTINCT p_brand AS department FROM part WHERE p_brand IS NOT NULL) t""")

cte("b_products", ("b_aisles", "b_departments"), """
SELECT p.p_partkey AS product_id, p.p_name AS product_name, a.aisle_id, d.department_id
FROM part p
LEFT JOIN b_aisles a ON p.p_type = a.aisle
LEFT JOIN b_departments d ON p.p_brand = d.department""")

cte("b_catalog", ("b_products", "b_aisles", "b_departments"), """
SELECT p.product_id, p.product_name, p.aisle_id, p.department_id, a.aisle, d.department
FROM b_products p
JOIN b_aisles a ON p.aisle_id = a.aisle_id
JOIN b_departments d ON p.department_id = d.department_id""")


def _facts(op: str, split: str) -> str:
    return f"""
SELECT op.product_id, op.order_id, op.add_to_cart_order, op.reordered, o.user_id, o.eval_set,
       o.order_number, o.order_dow, o.order_hour_of_day, o.days_since_prior_order,
       c.department_id, c.aisle_id, c.product_name, c.aisle, c.department
FROM {op} op
JOIN (SELECT * FROM b_orders WHERE eval_set = '{split}') o ON op.order_id = o.order_id
LEFT JOIN b_catalog c ON op.product_id = c.product_id"""


cte("b_prior_facts", ("b_op_prior", "b_orders", "b_catalog"), _facts("b_op_prior", "prior"))
cte("b_last_facts", ("b_op_train", "b_orders", "b_catalog"), _facts("b_op_train", "train"))

# --- similarity -------------------------------------------------------------------------

cte("b_cooc", ("b_prior_facts",), """
SELECT a.product_id AS product_id_left, b.product_id AS product_id_right, count(*) AS cooccurances
FROM b_prior_facts a JOIN b_prior_facts b ON a.user_id = b.user_id AND a.order_id = b.order_id
GROUP BY a.product_id, b.product_id""")

cte("b_norms", ("b_prior_facts",), """
SELECT product_id, sqrt(count(*)) AS norm FROM b_prior_facts GROUP BY product_id""")

cte("b_cosine", ("b_cooc", "b_norms"), """
SELECT c.product_id_left, c.product_id_right,
       c.cooccurances / (x.norm * y.norm) AS cosine_similarity
FROM b_cooc c
JOIN b_norms x ON x.product_id = c.product_id_left
JOIN b_norms y ON y.product_id = c.product_id_right""")


def topk_cte(name: str, k: int, ceiling: float = 0.999) -> None:
    cte(name, ("b_cosine",), f"""
SELECT * FROM (
  SELECT product_id_left, product_id_right, cosine_similarity,
         row_number() OVER (PARTITION BY product_id_left
                            ORDER BY cosine_similarity DESC, product_id_right) AS rank
  FROM b_cosine WHERE cosine_similarity < {ceiling}
) t WHERE rank <= {k}""")


topk_cte("b_topk10", 10)

# --- models -------------------------------------------------------------------------------

cte("b_last_prior", ("b_prior_facts",), """
SELECT f.user_id, f.order_id, f.product_id, f.order_number, f.add_to_cart_order
FROM b_prior_facts f
JOIN (SELECT user_id, max(order_number) AS mx FROM b_prior_facts GROUP BY user_id) m
  ON f.user_id = m.user_id AND f.order_number = m.mx""")

cte("b_input", ("b_last_prior", "b_last_facts"), """
SELECT * FROM b_last_prior WHERE user_id IN (SELECT user_id FROM b_last_facts)""")

cte("b_actual", ("b_last_facts", "b_input"), """
SELECT user_id, product_id FROM b_last_facts WHERE user_id IN (SELECT user_id FROM b_input)""")

cte("b_top100", ("b_last_prior",), """
SELECT product_id, count(*) AS purchasecount FROM b_last_prior
GROUP BY product_id ORDER BY purchasecount DESC, product_id LIMIT 100""")


def md5_key(seed: int, *cols: str) -> str:
    parts = ", ".join([f"'{seed}'"] + [f"CAST({c} AS VARCHAR)" for c in cols])
    return f"md5(concat_ws('|', {parts}))"


def u32(seed: int, *cols: str) -> str:
    return f"CAST(('0x' || substr({md5_key(seed, *cols)}, 1, 8)) AS BIGINT)"


cte("b_pred_cos", ("b_input", "b_topk10"), """
SELECT i.user_id, i.product_id AS purchased_product, t.product_id_right AS predicted_product,
       t.cosine_similarity AS cosine_sims, i.add_to_cart_order AS line, t.rank,
       row_number() OVER (PARTITION BY i.user_id ORDER BY i.add_to_cart_order, t.rank, t.product_id_right) AS pos
FROM b_input i JOIN b_topk10 t ON t.product_id_left = i.product_id""")

cte("b_pidx", ("b_products",), """
SELECT product_id, row_number() OVER (ORDER BY product_id) - 1 AS idx
FROM (SELECT DISTINCT product_id FROM b_products WHERE product_id IS NOT NULL) t""")

cte("b_np", ("b_pidx",), """
SELECT n, list_filter(range(n, n + 5000),
         lambda c: c >= 2 AND len(list_filter(range(2, CAST(floor(sqrt(c)) AS BIGINT) + 1), lambda d: c % d = 0)) = 0)[1] AS p
FROM (SELECT count(*) AS n FROM b_pidx) t""")

cte("b_pred_rand", ("b_input", "b_np", "b_pidx"), f"""
SELECT d.user_id, d.purchased_product, d.line, d.rank, x.product_id AS predicted_product,
       row_number() OVER (PARTITION BY d.user_id ORDER BY d.line, d.rank) AS pos
FROM (
  SELECT user_id, purchased_product, line, unnest(arr) AS idx, generate_subscripts(arr, 1) AS rank
  FROM (
    SELECT i.user_id, i.product_id AS purchased_product, i.add_to_cart_order AS line,
           list_slice(list_filter(
             list_transform(range(0, least(10 + np.p - np.n, np.p)),
               lambda j: ((1 + {u32(1, 'i.user_id', 'i.product_id', 'i.add_to_cart_order', "'a'")} % greatest(np.p - 1, 1)) * j
                     + {u32(1, 'i.user_id', 'i.product_id', 'i.add_to_cart_order', "'b'")} % np.p) % np.p),
             lambda v: v < np.n), 1, 10) AS arr
    FROM b_input i, b_np np
  ) s
) d JOIN b_pidx x ON x.idx = d.idx""")

cte("b_picks", ("b_top100",), f"""
SELECT product_id, purchasecount,
       row_number() OVER (ORDER BY {md5_key(1, 'product_id')}, product_id) AS rank
FROM (SELECT * FROM b_top100 ORDER BY {md5_key(1, 'product_id')}, product_id LIMIT 10) t""")

cte("b_pred_base", ("b_input", "b_picks"), """
SELECT i.user_id, i.product_id AS purchased_product, i.add_to_cart_order AS line, p.rank,
       p.product_id AS predicted_product, p.purchasecount,
       row_number() OVER (PARTITION BY i.user_id ORDER BY i.add_to_cart_order, p.rank) AS pos
FROM b_input i CROSS JOIN b_picks p""")


def named(pred: str, extra: str) -> str:
    return f"""
SELECT p.user_id, p.purchased_product, p.predicted_product, {extra}
       a.product_name AS prior_product_name, b.product_name AS predicted_product_name,
       p.line, p.rank, p.pos
FROM {pred} p
LEFT JOIN b_products a ON a.product_id = p.purchased_product
LEFT JOIN b_products b ON b.product_id = p.predicted_product"""


def ap_cte(name: str, pred: str, k: int = 10) -> None:
    cte(name, (pred, "b_actual", "b_input"), f"""
SELECT u.user_id AS userid, round(coalesce(s.s, 0.0) / least(na.na, {k}), 12) AS MAP
FROM (SELECT DISTINCT user_id FROM b_input) u
LEFT JOIN (
  SELECT user_id, sum(hit * nh / pos) AS s FROM (
    SELECT user_id, pos, hit,
           sum(hit) OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS nh
    FROM (
      SELECT p.user_id, p.pos,
             CASE WHEN p.is_first AND a.user_id IS NOT NULL THEN 1 ELSE 0 END AS hit
      FROM (SELECT user_id, predicted_product, pos,
                   row_number() OVER (PARTITION BY user_id, predicted_product ORDER BY pos) = 1 AS is_first
            FROM {pred} WHERE pos <= {k}) p
      LEFT JOIN (SELECT DISTINCT user_id, product_id FROM b_actual) a
        ON a.user_id = p.user_id AND a.product_id = p.predicted_product
    ) x
  ) y GROUP BY user_id
) s ON s.user_id = u.user_id
LEFT JOIN (SELECT user_id, count(*) AS na FROM b_actual GROUP BY user_id) na ON na.user_id = u.user_id""")


ap_cte("b_ap_cos", "b_pred_cos")
ap_cte("b_ap_rand", "b_pred_rand")
ap_cte("b_ap_base", "b_pred_base")

# --- matrices and ratings -------------------------------------------------------------------

cte("b_user_item", ("b_prior_facts",), """
SELECT user_id, product_id, count(*) AS purchases FROM b_prior_facts GROUP BY user_id, product_id""")

cte("b_ratings", ("b_prior_facts",), """
SELECT a.user_id, a.product_id, count(*) AS purchases
FROM b_prior_facts a JOIN b_prior_facts b ON a.user_id = b.user_id AND a.order_id = b.order_id
GROUP BY a.user_id, a.product_id""")


def similar_sql(score: str, source: str, n: int = 30) -> str:
    return f"""
SELECT s.product_id_left, s.product_id_right, l.product_name AS product_name_left,
       r.product_name AS product_name_right, s.{score}, s.rank
FROM (
  SELECT product_id_left, product_id_right, {score},
         row_number() OVER (PARTITION BY product_id_right ORDER BY {score} DESC, product_id_left) AS rank
  FROM {source}
  WHERE product_id_right IN (SELECT product_id FROM b_catalog)
    AND product_id_left IN (SELECT product_id FROM b_catalog)
) s
LEFT JOIN b_catalog l ON l.product_id = s.product_id_left
LEFT JOIN b_catalog r ON r.product_id = s.product_id_right
WHERE s.rank <= {n}"""


# --- model variants -------------------------------------------------------------------------

cte("b_pred_cos_score", ("b_pred_cos",), """
SELECT user_id, purchased_product, predicted_product, cosine_sims, line, rank,
       row_number() OVER (PARTITION BY user_id ORDER BY best DESC, predicted_product) AS pos
FROM (
  SELECT user_id, purchased_product, predicted_product, cosine_sims, line, rank,
         max(cosine_sims) OVER (PARTITION BY user_id, predicted_product) AS best,
         row_number() OVER (PARTITION BY user_id, predicted_product ORDER BY cosine_sims DESC, line) AS r1
  FROM b_pred_cos
) t WHERE r1 = 1""")

cte("b_pool", ("b_top100",), """
SELECT product_id, purchasecount,
       row_number() OVER (ORDER BY purchasecount DESC, product_id) - 1 AS idx
FROM b_top100""")

cte("b_pool_np", ("b_pool",), """
SELECT n, list_filter(range(n, n + 5000),
         lambda c: c >= 2 AND len(list_filter(range(2, CAST(floor(sqrt(c)) AS BIGINT) + 1), lambda d: c % d = 0)) = 0)[1] AS p
FROM (SELECT count(*) AS n FROM b_pool) t""")

cte("b_pred_base_line", ("b_input", "b_pool_np", "b_pool"), f"""
SELECT d.user_id, d.purchased_product, d.line, d.rank, x.product_id AS predicted_product, x.purchasecount,
       row_number() OVER (PARTITION BY d.user_id ORDER BY d.line, d.rank) AS pos
FROM (
  SELECT user_id, purchased_product, line, unnest(arr) AS idx, generate_subscripts(arr, 1) AS rank
  FROM (
    SELECT i.user_id, i.product_id AS purchased_product, i.add_to_cart_order AS line,
           list_slice(list_filter(
             list_transform(range(0, least(10 + np.p - np.n, np.p)),
               lambda j: ((1 + {u32(1, 'i.user_id', 'i.product_id', 'i.add_to_cart_order', "'a'")} % greatest(np.p - 1, 1)) * j
                     + {u32(1, 'i.user_id', 'i.product_id', 'i.add_to_cart_order', "'b'")} % np.p) % np.p),
             lambda v: v < np.n), 1, 10) AS arr
    FROM b_input i, b_pool_np np
  ) s
) d JOIN b_pool x ON x.idx = d.idx""")
