"""Derive the basket model (orders, order lines, catalogue) from the
TPC-H-style tables under ``/root/testdata/sf*``.

Mapping (deterministic, mirrored by the DuckDB oracle SQL):

* orders: order_id = o_orderkey, user_id = o_custkey; order_number is the
  position of the order in the customer's history by (o_orderdate,
  o_orderkey); a customer's last order is ``test`` when o_custkey % 3 = 0,
  else ``train``, provided the customer has two orders or more; every other
  order is ``prior``.  order_dow counts from Sunday = 0, the hour comes from
  o_orderdate and days_since_prior_order is capped at 30, NULL on the first.
* order lines: lineitem (l_orderkey, l_partkey); add_to_cart_order is the
  position by (l_linenumber, l_partkey, l_suppkey, l_quantity,
  l_extendedprice); reordered = 1 when the same user bought the product in
  an earlier order.
* products: part (p_partkey, p_name); aisles are the distinct p_type values,
  departments the distinct p_brand values, each numbered by name from 1.

Real basket data carries order_number, eval_set and add_to_cart_order as
columns; here they are derived with ``group_row_number`` (a distributed row
number, no window partition per customer or per order) and composite-key
joins, so a customer or an order holding a third of all rows does not end
up in one task.

``load_basket_tables`` derives the six basket-model tables once per input
(keyed by the paths, sizes and modification times of the source files and by
this module's code) and
writes them as Parquet below the shared checkpoint folder — the processed
input files of the reference's ETL.  Queries read those tables, so their
plans start at a scan, and the derivation is not re-run in every branch of
every plan.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, fields

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketrec.functions.indexing import dense_index, group_row_number
from basketrec.session import checkpoint_dir

SOURCE_TABLES = ("orders", "lineitem", "part")
_LOADED: dict[tuple[str, str], "BasketTables"] = {}


@dataclass(frozen=True)
class BasketTables:
    orders: DataFrame
    order_products_prior: DataFrame
    order_products_train: DataFrame
    products: DataFrame
    aisles: DataFrame
    departments: DataFrame


def _raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def adapt_orders(orders_raw: DataFrame) -> DataFrame:
    o = orders_raw.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("ts"),
    )
    # Position in the customer's history without a window per customer: a
    # customer with a third of all orders is still numbered in parallel.
    o = group_row_number(o, ["user_id"], ["ts", "order_id"], "order_number", group_size="n_orders")
    prev = o.select("user_id", (F.col("order_number") + 1).alias("order_number"), F.col("ts").alias("prev_ts"))
    o = o.join(prev, ["user_id", "order_number"], "left")
    is_last = F.col("order_number") == F.col("n_orders")
    eval_set = (
        F.when(is_last & (F.col("order_number") >= 2),
               F.when(F.pmod(F.col("user_id"), F.lit(3)) == 0, F.lit("test"))
               .otherwise(F.lit("train")))
        .otherwise(F.lit("prior"))
    )
    days = F.when(F.col("prev_ts").isNull(), F.lit(None).cast("double")).otherwise(
        F.least(F.lit(30), F.datediff(F.to_date("ts"), F.to_date("prev_ts"))).cast("double"))
    return o.select(
        "order_id", "user_id",
        eval_set.alias("eval_set"),
        "order_number",
        (F.dayofweek("ts") - 1).cast("int").alias("order_dow"),
        F.hour("ts").cast("int").alias("order_hour_of_day"),
        days.alias("days_since_prior_order"),
    )


def adapt_lines(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """All order lines with add_to_cart_order and reordered (all eval sets)."""
    lines = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                            "l_extendedprice")
    lines = group_row_number(
        lines, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"],
        "add_to_cart_order",
    ).select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
             "add_to_cart_order")
    lo = lines.join(orders.select("order_id", "user_id", "order_number", "eval_set"), "order_id")
    first = lo.groupBy("user_id", "product_id").agg(
        F.min("order_number").alias("first_number"))
    return (
        lo.join(first, ["user_id", "product_id"])
        .select(
            "order_id", "product_id", "add_to_cart_order",
            (F.col("order_number") > F.col("first_number")).cast("int").alias("reordered"),
            "eval_set",
        )
    )


def adapt_dimension(part: DataFrame, src: str, id_col: str, name_col: str) -> DataFrame:
    """Distinct attribute values numbered by name from 1 (distributed dense
    index, no single-partition window)."""
    vals = part.select(F.col(src).alias(name_col)).where(F.col(name_col).isNotNull())
    return dense_index(vals, name_col, "_i").select(
        (F.col("_i") + 1).cast("long").alias(id_col), name_col)


def derive_basket_tables(spark: SparkSession, sf_dir: str) -> BasketTables:
    """The basket model as lazy plans over the source tables."""
    orders = adapt_orders(_raw(spark, sf_dir, "orders"))
    lines = adapt_lines(_raw(spark, sf_dir, "lineitem"), orders)
    part = _raw(spark, sf_dir, "part")
    aisles = adapt_dimension(part, "p_type", "aisle_id", "aisle")
    departments = adapt_dimension(part, "p_brand", "department_id", "department")
    products = (
        part.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
                    F.col("p_type").alias("aisle"), F.col("p_brand").alias("department"))
        .join(aisles, "aisle", "left")
        .join(departments, "department", "left")
        .select("product_id", "product_name", "aisle_id", "department_id")
    )
    cols = ["order_id", "product_id", "add_to_cart_order", "reordered"]
    return BasketTables(
        orders=orders,
        order_products_prior=lines.where(F.col("eval_set") == "prior").select(*cols),
        order_products_train=lines.where(F.col("eval_set") == "train").select(*cols),
        products=products,
        aisles=aisles,
        departments=departments,
    )


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def source_fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Hash of this module's code and of path, length and modification time
    of every source file: new data or a changed derivation gets new tables."""
    h = hashlib.sha1()
    with open(__file__, "rb") as fh:
        h.update(fh.read())
    for name in SOURCE_TABLES:
        path = f"{sf_dir.rstrip('/')}/{name}.parquet"
        fs, p = _hadoop_fs(spark, path)
        for st in sorted(fs.listStatus(p), key=lambda x: x.getPath().toString()):
            h.update(f"{st.getPath().toString()}|{st.getLen()}|{st.getModificationTime()};".encode())
    return h.hexdigest()[:16]


def _complete(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop_fs(spark, f"{path}/_SUCCESS")
    return bool(fs.exists(p))


def load_basket_tables(spark: SparkSession, sf_dir: str, materialize: bool = True) -> BasketTables:
    """The basket model for ``sf_dir``; with ``materialize`` (default) read
    from Parquet written once below the shared checkpoint folder.  If that
    folder cannot be written, the lazy derivation is returned instead."""
    if not materialize:
        return derive_basket_tables(spark, sf_dir)
    fingerprint = source_fingerprint(spark, sf_dir)
    key = (id(spark), spark.sparkContext.applicationId, checkpoint_dir(spark), sf_dir, fingerprint)
    if key in _LOADED:
        return _LOADED[key]
    try:
        base = f"{checkpoint_dir(spark).rstrip('/')}/basketrec-basket-model/{fingerprint}"
        derived = None
        out = {}
        for f in fields(BasketTables):
            path = f"{base}/{f.name}"
            if not _complete(spark, path):
                derived = derived or derive_basket_tables(spark, sf_dir)
                df = getattr(derived, f.name)
                # files sized by the data, not by the cores, and no key in one file
                df.hint("rebalance").write.mode("overwrite").parquet(path)
            out[f.name] = spark.read.parquet(path)
        tables = BasketTables(**out)
    except Py4JJavaError as exc:  # only a folder that cannot be written: stay correct, just slower
        if not re.search("AccessControlException|Permission denied|Read-only file system|Mkdirs failed", str(exc.java_exception)):
            raise
        import warnings

        warnings.warn(f"basket model not materialised ({type(exc).__name__}: {exc}); deriving lazily")
        return derive_basket_tables(spark, sf_dir)
    _LOADED[key] = tables
    return tables
