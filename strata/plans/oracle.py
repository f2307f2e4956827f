"""Independent SQL statements of the registered queries (DuckDB dialect).

They restate the mapping and the layered flow in plain SQL over the same
parquet tables, so the check does not share code with the Spark side.
Spark-specific details restated here: ``datediff`` counts calendar days
(cast to DATE first), sums of integers are BIGINT, money sums run on
DECIMAL(18,2), Spark's ``round`` is HALF_UP on the decimal value of the
double, and ascending order puts NULLs first.
"""

from __future__ import annotations

_PRELUDE = """
WITH
delivered AS (
  SELECT l_orderkey, max(l_shipdate) AS order_delivered_customer_date
  FROM lineitem WHERE l_linestatus = 'F' GROUP BY l_orderkey),
b_orders AS (
  SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id, o.o_orderstatus AS order_status,
         o.o_orderdate AS order_purchase_timestamp, d.order_delivered_customer_date
  FROM orders o LEFT JOIN delivered d ON o.o_orderkey = d.l_orderkey),
b_items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
         l_suppkey AS seller_id, l_shipdate AS shipping_limit_date, l_extendedprice AS price,
         CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2)), 2) AS DOUBLE)
           AS freight_value
  FROM lineitem),
b_payments AS (
  SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential,
         l_linenumber AS payment_installments, l_extendedprice AS payment_value
  FROM lineitem),
b_reviews AS (
  SELECT 'r' || CAST(o_orderkey AS VARCHAR) AS review_id, o_orderkey AS order_id,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS review_score
  FROM orders
  UNION ALL
  SELECT 'r' || CAST(o_orderkey AS VARCHAR) || 'b', o_orderkey, 1
  FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'),
b_customers AS (
  SELECT c_custkey AS customer_id, c_name AS customer_unique_id, c_nationkey AS customer_zip_code_prefix,
         c_mktsegment AS customer_city, n_name AS customer_state
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
b_products AS (
  SELECT p_partkey AS product_id, CASE WHEN p_size <= 25 THEN p_type END AS product_category_name,
         CAST(length(p_name) AS INTEGER) AS product_name_lenght, p_size AS product_weight_g
  FROM part),
b_sellers AS (
  SELECT s_suppkey AS seller_id, s_nationkey AS seller_zip_code_prefix, s_name AS seller_city,
         n_name AS seller_state
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey),
b_translations AS (
  SELECT p_type AS product_category_name, lower(p_type) AS product_category_name_english FROM part),
c_orders AS (SELECT DISTINCT * FROM b_orders WHERE order_id IS NOT NULL),
c_items AS (SELECT DISTINCT * FROM b_items WHERE order_id IS NOT NULL AND price IS NOT NULL),
c_payments AS (SELECT DISTINCT * FROM b_payments WHERE order_id IS NOT NULL),
c_customers AS (SELECT DISTINCT * FROM b_customers WHERE customer_id IS NOT NULL),
c_reviews AS (SELECT DISTINCT * FROM b_reviews WHERE order_id IS NOT NULL),
c_products AS (SELECT DISTINCT * FROM b_products WHERE product_id IS NOT NULL),
c_sellers AS (SELECT DISTINCT * FROM b_sellers WHERE seller_id IS NOT NULL),
c_translations AS (SELECT DISTINCT * FROM b_translations WHERE product_category_name IS NOT NULL),
items AS (
  SELECT *, price + freight_value AS total_price, price - freight_value AS profit_margin FROM c_items),
with_days AS (
  SELECT *, CAST(date_diff('day', CAST(order_purchase_timestamp AS DATE),
                           CAST(order_delivered_customer_date AS DATE)) AS INTEGER) AS delivery_time_days
  FROM c_orders),
d_orders AS (
  SELECT * FROM with_days WHERE order_delivered_customer_date IS NOT NULL AND delivery_time_days > 0),
payments_agg AS (
  SELECT order_id, CAST(sum(payment_installments) AS BIGINT) AS payment_count
  FROM c_payments GROUP BY order_id),
orders_enriched AS (
  SELECT o.*, c.customer_unique_id, c.customer_zip_code_prefix, c.customer_city, c.customer_state,
         p.payment_count, r.review_score
  FROM d_orders o
  LEFT JOIN c_customers c ON o.customer_id = c.customer_id
  LEFT JOIN payments_agg p ON o.order_id = p.order_id
  LEFT JOIN (SELECT order_id, review_score FROM c_reviews) r ON o.order_id = r.order_id),
items_enriched AS (
  SELECT i.*, p.product_category_name, p.product_name_lenght, p.product_weight_g,
         s.seller_zip_code_prefix, s.seller_city, s.seller_state, t.product_category_name_english
  FROM items i
  LEFT JOIN c_products p ON i.product_id = p.product_id
  LEFT JOIN c_sellers s ON i.seller_id = s.seller_id
  LEFT JOIN c_translations t ON p.product_category_name = t.product_category_name),
seller_days AS (
  SELECT p.seller_id, o.delivery_time_days
  FROM (SELECT DISTINCT order_id, seller_id FROM items_enriched) p
  JOIN (SELECT order_id, delivery_time_days FROM orders_enriched
        WHERE delivery_time_days BETWEEN 1 AND 60) o ON p.order_id = o.order_id),
kpi_sales_per_category AS (
  SELECT product_category_name, CAST(sum(CAST(total_price AS DECIMAL(18,2))) AS DOUBLE) AS total_sales
  FROM items_enriched GROUP BY product_category_name),
kpi_avg_delivery_per_seller AS (
  SELECT seller_id,
         CAST(round(CAST(avg(delivery_time_days) AS DECIMAL(38,10)), 2) AS DOUBLE) AS avg_delivery_time
  FROM seller_days GROUP BY seller_id),
kpi_orders_per_state AS (
  SELECT customer_state, count(DISTINCT order_id) AS order_count FROM orders_enriched GROUP BY customer_state),
c_lines AS (SELECT DISTINCT * FROM lineitem WHERE l_orderkey IS NOT NULL),
gold_join AS (
  SELECT i.*, o.customer_id, o.order_purchase_timestamp, o.delivery_time_days
  FROM items_enriched i
  JOIN (SELECT order_id, customer_id, order_purchase_timestamp, delivery_time_days FROM orders_enriched) o
    ON i.order_id = o.order_id)
"""

_CSV_TABLES = """
        SELECT 'orders' AS table_name, count(*) AS row_count, round(sum(o_totalprice), 1) AS checksum FROM orders
        UNION ALL SELECT 'lineitem', count(*), round(sum(l_extendedprice), 1) FROM lineitem
        UNION ALL SELECT 'part', count(*), CAST(sum(p_size) AS DOUBLE) FROM part"""

_REPORTS = """
        SELECT 'kpi_sales_per_category' AS report, product_category_name AS key, total_sales AS value,
               row_number() OVER (ORDER BY total_sales DESC, product_category_name NULLS FIRST) AS position,
               10 AS most FROM kpi_sales_per_category
        UNION ALL
        SELECT 'kpi_avg_delivery_per_seller', CAST(seller_id AS VARCHAR), avg_delivery_time,
               row_number() OVER (ORDER BY avg_delivery_time DESC, {seller}), 10 FROM kpi_avg_delivery_per_seller
        UNION ALL
        SELECT 'kpi_orders_per_state', customer_state, CAST(order_count AS DOUBLE),
               row_number() OVER (ORDER BY order_count DESC, customer_state NULLS FIRST), NULL FROM kpi_orders_per_state"""


def _reports(columns: str, seller: str = "seller_id") -> str:
    """Rows of the three fixed reports; raw files hold ids as text, which orders ties otherwise."""
    return f"SELECT {columns} FROM ({_REPORTS.format(seller=seller)}) WHERE most IS NULL OR position <= most"


_ORDER_LINES = """
        SELECT *, o_orderkey % 7 AS kind, CAST(o_orderkey AS VARCHAR) || ',' || CAST(o_custkey AS VARCHAR) || ',' || o_orderstatus AS head,
               CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price_text FROM orders"""

_HOT_PAYMENTS = """
        SELECT DISTINCT CASE WHEN order_id % 3 = 0 THEN 0 ELSE order_id END AS order_id,
               payment_sequential, payment_installments, payment_value FROM b_payments WHERE order_id IS NOT NULL"""

_FINAL = {
    "category_sales": "SELECT * FROM kpi_sales_per_category",
    "gold_build": "SELECT * FROM kpi_sales_per_category",
    "category_sales_top10": """
        SELECT product_category_name, total_sales FROM kpi_sales_per_category
        ORDER BY total_sales DESC, product_category_name NULLS FIRST LIMIT 10""",
    "part_name_sales_top10": """
        SELECT product_name, total_sales FROM (
          SELECT p.p_name AS product_name,
                 CAST(sum(CAST(i.total_price AS DECIMAL(18,2))) AS DOUBLE) AS total_sales
          FROM items i LEFT JOIN part p ON i.product_id = p.p_partkey
          GROUP BY p.p_name)
        ORDER BY total_sales DESC, product_name NULLS FIRST LIMIT 10""",
    "order_installments": "SELECT * FROM payments_agg",
    "delivered_orders": "SELECT * FROM d_orders",
    "orders_per_state": "SELECT * FROM kpi_orders_per_state",
    "orders_by_state_ranked": """
        SELECT customer_state, order_count FROM kpi_orders_per_state
        ORDER BY order_count DESC, customer_state NULLS FIRST""",
    "seller_mean_delivery": "SELECT * FROM kpi_avg_delivery_per_seller",
    "slowest_sellers_top10": """
        SELECT seller_id, avg_delivery_time FROM kpi_avg_delivery_per_seller
        ORDER BY avg_delivery_time DESC, seller_id NULLS FIRST LIMIT 10""",
    "overall_mean_delivery": "SELECT avg(delivery_time_days) AS mean_delivery_time FROM seller_days",
    "customer_running_sales": """
        SELECT customer_id, order_id, order_purchase_timestamp, total_price,
               CAST(sum(CAST(total_price AS DECIMAL(18,2))) OVER (
                 PARTITION BY customer_id ORDER BY order_purchase_timestamp, order_id, total_price
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS cumulative_sales
        FROM gold_join""",
    "category_rolling_delivery": """
        SELECT product_category_name, order_id, delivery_time_days,
               avg(delivery_time_days) OVER (
                 PARTITION BY product_category_name ORDER BY order_purchase_timestamp, order_id
                 ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rolling_avg_delivery
        FROM gold_join""",
    "customer_running_sales_staged": """
        SELECT customer_id, order_id, order_purchase_timestamp, total_price,
               CAST(sum(CAST(total_price AS DECIMAL(18,2))) OVER (
                 PARTITION BY customer_id ORDER BY order_purchase_timestamp, order_id, total_price
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS cumulative_sales
        FROM gold_join""",
    "category_rolling_delivery_by_key": """
        SELECT product_category_name, order_id, delivery_time_days,
               avg(delivery_time_days) OVER (
                 PARTITION BY product_category_name ORDER BY order_purchase_timestamp, order_id
                 ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rolling_avg_delivery
        FROM gold_join""",
    "orders_enriched": "SELECT * FROM orders_enriched",
    "orders_enriched_one_review": """
        SELECT o.*, c.customer_unique_id, c.customer_zip_code_prefix, c.customer_city, c.customer_state,
               p.payment_count, r.review_score
        FROM d_orders o
        LEFT JOIN c_customers c ON o.customer_id = c.customer_id
        LEFT JOIN payments_agg p ON o.order_id = p.order_id
        LEFT JOIN (SELECT order_id, max(review_score) AS review_score FROM c_reviews GROUP BY order_id) r
          ON o.order_id = r.order_id""",
    "items_enriched": "SELECT * FROM items_enriched",
    "item_amounts": "SELECT * FROM items",
    "dedupe_copies": "SELECT DISTINCT * FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem)",
    "clean_items": """
        SELECT DISTINCT order_id, seller_id, product_category_name FROM items_enriched
        WHERE product_category_name IS NOT NULL""",
    "seller_order_pairs": "SELECT DISTINCT order_id, seller_id FROM items_enriched",
    "csv_roundtrip": "SELECT * FROM lineitem",
    "layer_roundtrip": "SELECT * FROM orders",
    "append_mode": "SELECT * FROM orders UNION ALL SELECT * FROM orders",
    "self_overwrite": "SELECT * FROM customer WHERE c_acctbal >= 0",
    "named_steps": """
        SELECT *, CAST(date_diff('day', CAST(order_purchase_timestamp AS DATE),
                                 CAST(order_delivered_customer_date AS DATE)) AS INTEGER) AS delivery_time_days
        FROM b_orders""",
    "table_counts": """
        SELECT 'cumulative_sales_per_customer' AS table_name, count(*) AS row_count FROM gold_join
        UNION ALL SELECT 'rolling_avg_delivery_per_category', count(*) FROM gold_join
        UNION ALL SELECT 'kpi_sales_per_category', count(*) FROM kpi_sales_per_category
        UNION ALL SELECT 'kpi_avg_delivery_per_seller', count(*) FROM kpi_avg_delivery_per_seller
        UNION ALL SELECT 'kpi_orders_per_state', count(*) FROM kpi_orders_per_state""",
    "bronze_incremental": "SELECT * FROM lineitem",
    "gold_stage": """
        SELECT 'cumulative_sales_per_customer' AS table_name, count(*) AS row_count, round(sum(w), 1) AS checksum FROM (
          SELECT CAST(sum(CAST(total_price AS DECIMAL(18,2))) OVER (
                   PARTITION BY customer_id ORDER BY order_purchase_timestamp, order_id, total_price
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS w FROM gold_join)
        UNION ALL SELECT 'rolling_avg_delivery_per_category', count(*), round(sum(w), 1) FROM (
          SELECT avg(delivery_time_days) OVER (
                   PARTITION BY product_category_name ORDER BY order_purchase_timestamp, order_id
                   ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS w FROM gold_join)
        UNION ALL SELECT 'kpi_sales_per_category', count(*), round(sum(total_sales), 1) FROM kpi_sales_per_category
        UNION ALL SELECT 'kpi_avg_delivery_per_seller', count(*), round(sum(avg_delivery_time), 1) FROM kpi_avg_delivery_per_seller
        UNION ALL SELECT 'kpi_orders_per_state', count(*), CAST(sum(order_count) AS DOUBLE) FROM kpi_orders_per_state""",
    "hot_key_running_quantity": """
        SELECT l_linestatus, l_orderkey, l_linenumber,
               CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) OVER (
                 PARTITION BY l_linestatus ORDER BY l_shipdate, l_orderkey, l_linenumber, l_quantity
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_quantity
        FROM lineitem""",
    "flag_tax_share_exact": """
        SELECT l_returnflag, CAST(sum(CAST(l_extendedprice * l_discount * l_tax AS DECIMAL(18,6))) AS DOUBLE) AS total
        FROM lineitem GROUP BY l_returnflag""",
    "flag_tax_share": """
        SELECT l_returnflag, round(sum(l_extendedprice * l_discount * l_tax), 3) AS total
        FROM lineitem GROUP BY l_returnflag""",
    "csv_ingest_declared": _CSV_TABLES,
    "csv_ingest_inferred": _CSV_TABLES,
    "csv_flow_saved": "SELECT * FROM (SELECT DISTINCT * FROM lineitem) WHERE l_linestatus = 'F' AND l_quantity > 10",
    "csv_flow_counts": """
        SELECT 0 AS step, 'input' AS name, count(*) AS rows FROM lineitem
        UNION ALL SELECT 1, 'drop missing keys', count(*) FROM c_lines
        UNION ALL SELECT 2, 'keep finished', count(*) FROM c_lines WHERE l_linestatus = 'F'
        UNION ALL SELECT 3, 'keep finished', count(*) FROM c_lines WHERE l_linestatus = 'F' AND l_quantity > 10""",
}

_MODES = (
    ("overwrite", "n", "n", False, "m", "m", False),
    ("append", "n", "n", False, "m", "n + m", False),
    ("ignore", "n", "n", False, "0", "n", False),
    ("error", "n", "n", False, "0", "n", True),
)

_FINAL |= {
    "interrupted_overwrite": """
        SELECT 'committed' AS new_version, c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal >= 0
        UNION ALL SELECT 'lost', c_custkey, c_name, c_acctbal FROM customer""",
    "write_modes": " UNION ALL ".join(
        f"""
        SELECT '{mode}' AS mode, {step} AS step, CAST({written} AS BIGINT) AS written, CAST({total} AS BIGINT) AS table_rows, {refused} AS refused
        FROM (SELECT count(*) AS n, count(*) FILTER (WHERE c_acctbal >= 0) AS m FROM customer)"""
        for mode, w1, t1, r1, w2, t2, r2 in _MODES
        for step, written, total, refused in ((1, w1, t1, r1), (2, w2, t2, r2))
    ),
    "csv_rejects": f"""
        SELECT CASE WHEN kind IN (1, 3, 5) THEN 'rejected' ELSE 'bronze' END AS layer, o_orderkey, o_custkey,
               CASE WHEN kind NOT IN (1, 5) THEN o_totalprice END AS o_totalprice,
               CASE WHEN kind <> 5 THEN o_orderpriority END AS o_orderpriority,
               CASE kind WHEN 1 THEN head || ',n/a,' || o_orderpriority
                         WHEN 3 THEN head || ',' || price_text || ',' || o_orderpriority || ',extra'
                         WHEN 5 THEN head END AS raw_row
        FROM ({_ORDER_LINES})""",
    "csv_reject_counts": """
        SELECT 'orders' AS table_name, count(*) AS row_count FROM orders WHERE o_orderkey % 7 NOT IN (1, 3, 5)
        UNION ALL SELECT 'rejected/orders', count(*) FROM orders WHERE o_orderkey % 7 IN (1, 3, 5)""",
    "csv_inferred_late": """
        SELECT column_name, type, row_count FROM (SELECT count(*) AS row_count FROM orders),
             (VALUES ('o_orderkey', 'int'), ('code', 'string'), ('o_totalprice', 'double')) v(column_name, type)""",
    "csv_missing_input": """
        SELECT 'orders' AS file, true AS found, count(*) AS row_count FROM orders
        UNION ALL SELECT 'lineitem', true, count(*) FROM lineitem
        UNION ALL SELECT 'part', true, count(*) FROM part
        UNION ALL SELECT 'refunds', false, NULL""",
    "flow_limited_counts": """
        SELECT 0 AS step, 'input' AS name, count(*) AS rows FROM lineitem
        UNION ALL SELECT 1, 'keep finished', count(*) FROM lineitem WHERE l_linestatus = 'F'
        UNION ALL SELECT 2, 'first hundred', least(100, count(*)) FROM lineitem WHERE l_linestatus = 'F'
        UNION ALL SELECT 3, 'add price', least(100, count(*)) FROM lineitem WHERE l_linestatus = 'F'
        UNION ALL SELECT 4, 'nothing', 0""",
    "clean_hot_payments": f"""
        SELECT order_id, count(*) AS payments, CAST(sum(payment_installments) AS BIGINT) AS payment_count
        FROM ({_HOT_PAYMENTS}) GROUP BY order_id""",
    "report_positions": _reports("report, position, key, value"),
    "orders_by_price_positions": """
        SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS position FROM orders""",
    "reports_from_views": _reports("report, key, value"),
    "bronze_from_raw": """
        SELECT 'olist_orders_dataset' AS table_name, count(*) AS row_count, CAST(sum(length(order_status)) AS DOUBLE) AS checksum FROM b_orders
        UNION ALL SELECT 'olist_customers_dataset', count(*), CAST(sum(customer_zip_code_prefix) AS DOUBLE) FROM b_customers
        UNION ALL SELECT 'olist_geolocation_dataset', count(*), CAST(sum(customer_id % 90) AS DOUBLE) FROM b_customers
        UNION ALL SELECT 'olist_order_reviews_dataset', count(*), CAST(sum(review_score) AS DOUBLE) FROM b_reviews
        UNION ALL SELECT 'olist_order_payments_dataset', count(*), round(sum(payment_value), 1) FROM b_payments
        UNION ALL SELECT 'olist_order_items_dataset', count(*), round(sum(price + freight_value), 1) FROM b_items
        UNION ALL SELECT 'olist_sellers_dataset', count(*), CAST(sum(seller_zip_code_prefix) AS DOUBLE) FROM b_sellers
        UNION ALL SELECT 'product_category_name_translation', count(*), CAST(sum(length(product_category_name_english)) AS DOUBLE) FROM b_translations
        UNION ALL SELECT 'olist_products_dataset', count(*), CAST(sum(product_weight_g) AS DOUBLE) FROM b_products""",
    "reviews_from_raw": """
        SELECT review_id, CAST(order_id AS VARCHAR) AS order_id, review_score,
               CASE WHEN review_score <> 3 THEN 'Order "' || CAST(order_id AS VARCHAR) || '", score ' || CAST(review_score AS VARCHAR)
                 || chr(10) || 'line two' || chr(10) || chr(10) || CAST(review_score AS VARCHAR) END AS review_comment_message
        FROM b_reviews""",
    "reports_from_raw": _reports("report, key, value", "CAST(seller_id AS VARCHAR)"),
}


def oracle_sql() -> dict[str, str]:
    return {name: _PRELUDE + final for name, final in _FINAL.items()}
