"""The e-commerce data model expressed over the star-schema test tables.

Each raw table of the layered flow is a projection (or a small lookup) of
the parquet tables, so the silver and gold plans run unchanged on them:

* orders: ``o_orderkey`` / ``o_custkey`` / ``o_orderdate``; delivered at the
  latest ship date of the order's finished (``l_linestatus = 'F'``) lines;
* order items: lineitem, price = ``l_extendedprice``, freight =
  ``round(price * l_tax, 2)`` (computed on decimals, exact);
* payments: one per line, installments = ``l_linenumber``;
* reviews: one per order, score = the ``o_orderpriority`` digit, and a
  second one for urgent, partly filled orders (so the review lookup fans a
  few orders out, as in the original data);
* customers / sellers: customer / supplier with the nation name as state;
* products: every part; category = ``p_type`` where ``p_size <= 25``, else NULL
  (like uncategorised products);
* category dictionary: distinct ``p_type`` with a lower-case "English" name.

All of these are lazy projections; Catalyst prunes the unused columns and
the scans read only what the final query needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.enrich import lookup

TPCH_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one test table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def freight(price: str = "l_extendedprice", tax: str = "l_tax"):
    return F.round(F.col(price).cast("decimal(18,2)") * F.col(tax).cast("decimal(18,2)"), 2).cast("double")


def delivery_dates(lineitem: DataFrame) -> DataFrame:
    """Latest ship date of finished lines per order (partial aggregate per task)."""
    return (
        lineitem.filter(F.col("l_linestatus") == "F")
        .groupBy("l_orderkey")
        .agg(F.max("l_shipdate").alias("order_delivered_customer_date"))
    )


def bronze_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The eight raw tables of the layered flow, mapped onto the test tables."""
    t = {name: load(spark, sf_dir, name) for name in TPCH_TABLES}
    li = t["lineitem"]
    orders = lookup(
        t["orders"], delivery_dates(li), {"o_orderkey": "l_orderkey"}
    ).select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        F.col("order_delivered_customer_date"),
    )
    order_items = li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        freight().alias("freight_value"),
    )
    payments = li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        F.col("l_linenumber").alias("payment_installments"),
        F.col("l_extendedprice").alias("payment_value"),
    )
    # one review per order, scored 1-5 by the priority digit; urgent, partly
    # filled orders get a second (score 1), so the review lookup fans a few
    # orders out as in the original data
    first = t["orders"].select(
        F.concat(F.lit("r"), F.col("o_orderkey").cast("string")).alias("review_id"),
        F.col("o_orderkey").alias("order_id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("review_score"),
    )
    second = t["orders"].filter(
        (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P")
    ).select(
        F.concat(F.lit("r"), F.col("o_orderkey").cast("string"), F.lit("b")).alias("review_id"),
        F.col("o_orderkey").alias("order_id"),
        F.lit(1).alias("review_score"),
    )
    reviews = first.unionByName(second)
    nation = t["nation"].select("n_nationkey", "n_name")
    customers = lookup(t["customer"], nation, {"c_nationkey": "n_nationkey"}, broadcast=True).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        F.col("c_nationkey").alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        F.col("n_name").alias("customer_state"),
    )
    products = t["part"].select(
        F.col("p_partkey").alias("product_id"),
        F.when(F.col("p_size") <= 25, F.col("p_type")).alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        F.col("p_size").alias("product_weight_g"),
    )
    sellers = lookup(t["supplier"], nation, {"s_nationkey": "n_nationkey"}, broadcast=True).select(
        F.col("s_suppkey").alias("seller_id"),
        F.col("s_nationkey").alias("seller_zip_code_prefix"),
        F.col("s_name").alias("seller_city"),
        F.col("n_name").alias("seller_state"),
    )
    translations = t["part"].select(
        F.col("p_type").alias("product_category_name"),
        F.lower("p_type").alias("product_category_name_english"),
    )
    return {
        "orders": orders,
        "order_items": order_items,
        "payments": payments,
        "customers": customers,
        "products": products,
        "sellers": sellers,
        "reviews": reviews,
        "translations": translations,
    }
