"""Declared schemas of the nine raw e-commerce tables.

Declaring them removes the inference pass over every file and keeps a
malformed row from changing column types.  Column names are fixed values of
the raw files, misspellings included.
"""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _D, _TS = T.StringType(), T.IntegerType(), T.DoubleType(), T.TimestampType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Raw file names and their column names/types.
ORDERS = _schema(
    ("order_id", _S),
    ("customer_id", _S),
    ("order_status", _S),
    ("order_purchase_timestamp", _TS),
    ("order_approved_at", _TS),
    ("order_delivered_carrier_date", _TS),
    ("order_delivered_customer_date", _TS),
    ("order_estimated_delivery_date", _TS),
)
ORDER_ITEMS = _schema(
    ("order_id", _S),
    ("order_item_id", _I),
    ("product_id", _S),
    ("seller_id", _S),
    ("shipping_limit_date", _TS),
    ("price", _D),
    ("freight_value", _D),
)
PAYMENTS = _schema(
    ("order_id", _S),
    ("payment_sequential", _I),
    ("payment_type", _S),
    ("payment_installments", _I),
    ("payment_value", _D),
)
REVIEWS = _schema(
    ("review_id", _S),
    ("order_id", _S),
    ("review_score", _I),
    ("review_comment_title", _S),
    ("review_comment_message", _S),
    ("review_creation_date", _TS),
    ("review_answer_timestamp", _TS),
)
CUSTOMERS = _schema(
    ("customer_id", _S),
    ("customer_unique_id", _S),
    ("customer_zip_code_prefix", _I),
    ("customer_city", _S),
    ("customer_state", _S),
)
PRODUCTS = _schema(
    ("product_id", _S),
    ("product_category_name", _S),
    ("product_name_lenght", _I),
    ("product_description_lenght", _I),
    ("product_photos_qty", _I),
    ("product_weight_g", _I),
    ("product_length_cm", _I),
    ("product_height_cm", _I),
    ("product_width_cm", _I),
)
SELLERS = _schema(
    ("seller_id", _S),
    ("seller_zip_code_prefix", _I),
    ("seller_city", _S),
    ("seller_state", _S),
)
TRANSLATIONS = _schema(
    ("product_category_name", _S),
    ("product_category_name_english", _S),
)
GEOLOCATION = _schema(
    ("geolocation_zip_code_prefix", _I),
    ("geolocation_lat", _D),
    ("geolocation_lng", _D),
    ("geolocation_city", _S),
    ("geolocation_state", _S),
)

# The file names of the public e-commerce dataset that the
# bronze ingest reads (without ".csv"); bronze tables are named after them.
RAW_FILES = {
    "olist_orders_dataset": ORDERS,
    "olist_customers_dataset": CUSTOMERS,
    "olist_geolocation_dataset": GEOLOCATION,
    "olist_order_reviews_dataset": REVIEWS,
    "olist_order_payments_dataset": PAYMENTS,
    "olist_order_items_dataset": ORDER_ITEMS,
    "olist_sellers_dataset": SELLERS,
    "product_category_name_translation": TRANSLATIONS,
    "olist_products_dataset": PRODUCTS,
}

# Review text holds quoted newlines and doubled quotes.
CSV_OPTIONS = {"olist_order_reviews_dataset": {"multi_line": True, "escape": '"'}}

# Fixed values (they must equal the original pipeline's): logical table -> raw
# table, and the null-key subset cleaned per table.
BRONZE_TABLES = {
    "orders": "olist_orders_dataset",
    "order_items": "olist_order_items_dataset",
    "payments": "olist_order_payments_dataset",
    "customers": "olist_customers_dataset",
    "products": "olist_products_dataset",
    "sellers": "olist_sellers_dataset",
    "reviews": "olist_order_reviews_dataset",
    "translations": "product_category_name_translation",
}
CLEAN_KEYS = {
    "orders": ["order_id"],
    "order_items": ["order_id", "price"],
    "payments": ["order_id"],
    "customers": ["customer_id"],
    "reviews": ["order_id"],
    "products": ["product_id"],
    "sellers": ["seller_id"],
    "translations": ["product_category_name"],
}
