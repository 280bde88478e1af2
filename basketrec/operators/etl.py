"""ETL: evaluation split, profiles, catalogue and order-fact joins, samples."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketrec.plans.broadcast import broadcast_if_small, spread_by_size
from basketrec.plans.skew import join_split

FACT_COLUMNS = [
    "product_id", "order_id", "add_to_cart_order", "reordered", "user_id", "eval_set",
    "order_number", "order_dow", "order_hour_of_day", "days_since_prior_order",
    "department_id", "aisle_id", "product_name", "aisle", "department",
]


def eval_split(orders: DataFrame, eval_set: str) -> DataFrame:
    """Orders of one evaluation set (prior / train / test)."""
    return orders.where(F.col("eval_set") == F.lit(eval_set))


def write_eval_split(orders: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """All three splits in one write, one directory per eval_set, so readers
    of a single split prune the other directories."""
    orders.write.mode(mode).partitionBy("eval_set").parquet(path)


def split_profile(orders: DataFrame) -> DataFrame:
    """Distinct users overall (eval_set = 'all') and per evaluation set, in a
    single pass (rollup)."""
    return (
        orders.rollup("eval_set")
        .agg(F.count_distinct("user_id").alias("users"), F.grouping_id().alias("_g"))
        .select(F.when(F.col("_g") == 1, F.lit("all")).otherwise(F.col("eval_set")).alias("eval_set"),
                "users")
    )


def merge(df1: DataFrame, df2: DataFrame, key: str | list[str], how: str = "inner") -> DataFrame:
    """USING join: the key column appears once."""
    return df1.join(df2, key if isinstance(key, list) else [key], how)


def product_catalog(products: DataFrame, aisles: DataFrame, departments: DataFrame) -> DataFrame:
    """products ⋈ aisles ⋈ departments (inner: products without a known
    aisle or department drop out).  The two dimension tables are broadcast
    within the size bound."""
    a = broadcast_if_small(aisles)
    d = broadcast_if_small(departments)
    return (products.join(a, "aisle_id").join(d, "department_id")
            .select("product_id", "product_name", "aisle_id", "department_id", "aisle", "department"))


def order_lines(order_products: DataFrame, orders: DataFrame, eval_set: str | None = None,
                lines_per_task: int | None = None) -> DataFrame:
    """order lines ⋈ orders (inner): the fact table without catalogue
    attributes.  The catalogue is keyed by product_id, so its left join never
    adds or drops a line; operators that need no names start here.

    With ``lines_per_task``, orders of more lines are found by a count and dealt to
    several tasks before the shuffle; without, that is left to adaptive execution, and tables of many
    bytes are dealt to tasks of bounded size."""
    if eval_set is not None:
        orders = eval_split(orders, eval_set)
    if lines_per_task is not None:
        joined = join_split(order_products, orders, "order_id", lines_per_task)
        return joined.select(*order_products.columns, *[c for c in orders.columns if c != "order_id"])
    return spread_by_size(order_products, "order_id").join(orders, "order_id")


def order_facts(order_products: DataFrame, orders: DataFrame, catalog: DataFrame,
                eval_set: str | None = None,
                lines_per_task: int | None = None) -> DataFrame:
    """order lines ⋈ orders (inner) ⟕ catalogue.  Lines of unknown products
    keep NULL names.  The catalogue is broadcast within the size bound (so
    the lines are not shuffled for it), else joined by a shuffle."""
    cat = broadcast_if_small(catalog)
    facts = order_lines(order_products, orders, eval_set, lines_per_task).join(cat, "product_id", "left")
    return facts.select(*FACT_COLUMNS)


def merge_profile(order_products: DataFrame, orders: DataFrame, catalog: DataFrame,
                  eval_set: str) -> DataFrame:
    """Row counts before and after each merge of ``order_facts`` as a table
    (stage, rows), in one pass over the lines: a line counts as often as its
    keys occur on the other sides."""
    o = eval_split(orders, eval_set).groupBy("order_id").agg(F.count(F.lit(1)).alias("_o"))
    c = catalog.groupBy("product_id").agg(F.count(F.lit(1)).alias("_c"))
    lines = merge(merge(order_products.select("order_id", "product_id"), o, "order_id", "left"), c, "product_id", "left")
    in_orders = F.coalesce("_o", F.lit(0).cast("long"))
    none = F.lit(0).cast("long")
    counts = lines.agg(
        F.count(F.lit(1)).alias("lines"),
        F.coalesce(F.sum(in_orders), none).alias("with_orders"),
        F.coalesce(F.sum(in_orders * F.coalesce("_c", F.lit(1).cast("long"))), none).alias("with_products"))
    stages = [F.struct(F.lit(f"{eval_set}_{s}").alias("stage"), F.col(s).alias("rows")) for s in counts.columns]
    return counts.select(F.inline(F.array(*stages)))


def dept_sample(df: DataFrame, column: str = "department_id", value: int = 5) -> DataFrame:
    """Rows of one department (or any column == value)."""
    return df.where(F.col(column) == F.lit(value))


SAMPLE_KEY = ("order_id", "product_id", "add_to_cart_order")


def _poisson_steps(rate: float) -> list[float]:
    """Distribution function of a Poisson variable, up to where a 40-bit draw ends."""
    steps, term, total, k = [], math.exp(-rate), 0.0, 0
    while total < 1 - 2 ** -40 and k < 200:
        total += term
        k += 1
        term *= rate / k
        steps.append(total)
    return steps


def row_sample(df: DataFrame, fraction: float = 0.10, seed: int = 42, with_replacement: bool = True,
               key: tuple[str, ...] | None = None) -> DataFrame:
    """Row sample by a hash of the seed and the ``key`` columns (all columns by default):
    the same rows for any partitioning.  With replacement a row comes a Poisson
    number of times."""
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), *(key or df.columns)).cast("binary"))
    draw = F.conv(F.substring(key, 1, 10), 16, 10).cast("double") / float(1 << 40)
    if not with_replacement:
        return df.where(draw < F.lit(fraction))
    times = sum((F.when(draw >= F.lit(s), 1).otherwise(0) for s in _poisson_steps(fraction)), F.lit(0))
    return df.withColumn("_n", times).where("_n > 0").withColumn("_i", F.explode(F.sequence(F.lit(1), "_n"))).drop("_n", "_i")


def row_sample_sql(source: str, fraction: float, seed: int) -> str:
    """The same sample in DuckDB SQL."""
    draw = f"CAST('0x' || substr(md5(concat_ws('|', '{seed}', {', '.join(SAMPLE_KEY)})), 1, 10) AS BIGINT)::DOUBLE / {float(1 << 40)!r}::DOUBLE"
    times = " + ".join(f"(u >= {s!r}::DOUBLE)::INTEGER" for s in _poisson_steps(fraction))
    return f"SELECT * EXCLUDE (u, i) FROM (SELECT *, unnest(range(1, 1 + {times})) AS i FROM (SELECT *, {draw} AS u FROM {source}))"
