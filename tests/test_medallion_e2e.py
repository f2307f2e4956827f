"""Raw CSV -> bronze -> silver -> gold -> reports through the stage drivers.

Hand-made raw files carry the cases the test tables lack: whole-row copies,
NULL keys, an undelivered and a same-day order, several reviews per order,
a multi-line review, an untranslated and a NULL category, and a delivery
beyond the 60-day range.  The checks are the pipeline's invariants (row
counts kept by unique lookups, fan-out only growing, equal window inputs,
day and mean ranges, the NULL group, result types) plus exact values.
"""

import os

import pytest
from conftest import rows

from strata.plans import medallion
from strata.sources.store import LayerStore

RAW = {
    "olist_orders_dataset": [
        "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
        "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date",
        "o1,c1,delivered,2018-01-01 10:00:00,,,2018-01-05 09:00:00,",
        "o1,c1,delivered,2018-01-01 10:00:00,,,2018-01-05 09:00:00,",  # whole-row copy
        "o2,c2,delivered,2018-01-02 08:00:00,,,2018-01-02 20:00:00,",  # same day: 0 days
        "o3,c1,shipped,2018-01-03 08:00:00,,,,",  # not delivered
        "o4,c3,delivered,2018-01-04 12:00:00,,,2018-03-20 12:00:00,",  # 75 days
        ",c9,delivered,2018-01-04 12:00:00,,,2018-01-09 12:00:00,",  # NULL key
    ],
    "olist_customers_dataset": [
        "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state",
        "c1,u1,1000,sao paulo,SP",
        "c1,u1,1000,sao paulo,SP",
        "c2,u2,2000,rio,RJ",
        "c3,u3,3000,campinas,SP",
    ],
    "olist_geolocation_dataset": [
        "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state",
        "1000,-23.5,-46.6,sao paulo,SP",
    ],
    "olist_order_reviews_dataset": [
        "review_id,order_id,review_score,review_comment_title,review_comment_message,"
        "review_creation_date,review_answer_timestamp",
        "r1,o1,5,,ok,2018-01-06 00:00:00,2018-01-06 10:00:00",
        'r2,o1,4,,"two\nlines",2018-01-07 00:00:00,2018-01-07 10:00:00',
        "r3,o4,3,,,2018-03-21 00:00:00,2018-03-21 10:00:00",
    ],
    "olist_order_payments_dataset": [
        "order_id,payment_sequential,payment_type,payment_installments,payment_value",
        "o1,1,credit_card,2,20.0",
        "o1,2,voucher,3,17.0",
        "o4,1,boleto,1,8.75",
    ],
    "olist_order_items_dataset": [
        "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value",
        "o1,1,p1,s1,2018-01-02 00:00:00,10.0,2.0",
        "o1,2,p2,s2,2018-01-02 00:00:00,20.0,5.0",
        "o4,1,p3,s1,2018-01-05 00:00:00,7.5,1.25",
        "o2,1,p1,s1,2018-01-03 00:00:00,10.0,2.0",
        "o3,1,p1,s1,2018-01-03 00:00:00,,2.0",  # NULL price
    ],
    "olist_sellers_dataset": [
        "seller_id,seller_zip_code_prefix,seller_city,seller_state",
        "s1,1000,sao paulo,SP",
        "s2,4000,belo horizonte,MG",
    ],
    "product_category_name_translation": [
        "product_category_name,product_category_name_english",
        "cat_a,a_en",
    ],
    "olist_products_dataset": [
        "product_id,product_category_name,product_name_lenght,product_description_lenght,product_photos_qty,"
        "product_weight_g,product_length_cm,product_height_cm,product_width_cm",
        "p1,cat_a,10,100,1,500,10,10,10",
        "p2,cat_b,12,120,2,600,20,20,20",  # not in the dictionary
        "p3,,14,140,3,700,30,30,30",  # NULL category
    ],
}


@pytest.fixture
def built(spark, tmp_root):
    raw = os.path.join(tmp_root, "raw")
    os.makedirs(raw)
    for name, lines in RAW.items():
        with open(os.path.join(raw, f"{name}.csv"), "w", newline="") as f:
            f.write("\r\n".join(lines) + "\r\n")
    store = LayerStore(spark, os.path.join(tmp_root, "lake"))
    bronze = medallion.build_bronze(spark, raw, store)
    silver = medallion.build_silver(store)
    gold = medallion.build_gold(store)
    reports = medallion.build_reports(spark, store)
    return store, bronze, silver, gold, reports


def test_stage_counts_and_invariants(built):
    store, bronze, silver, gold, _ = built
    assert bronze["olist_orders_dataset"] == 6 and bronze["olist_order_reviews_dataset"] == 3  # multi-line kept whole
    assert bronze["olist_geolocation_dataset"] == 1
    # Unique lookups keep the cleaned item count (the NULL-price item is cleaned away)
    assert silver["order_items_enriched"] == 4
    # Review fan-out only grows the delivered orders (o1 twice, o4 once)
    assert silver["orders_enriched"] == 3
    # Both windows read the same inner join
    assert gold["cumulative_sales_per_customer"] == gold["rolling_avg_delivery_per_category"] == 5
    orders = store.read("silver", "orders_enriched")
    assert rows(orders, "order_id", "delivery_time_days", "payment_count", "review_score") == [
        ("o1", 4, 5, 4),
        ("o1", 4, 5, 5),
        ("o4", 75, 1, 3),
    ]
    # I4: seller means lie in [1, 60]; o4 (75 days) is outside the range
    sellers = store.read("gold", "kpi_avg_delivery_per_seller")
    assert rows(sellers) == [("s1", 4.0), ("s2", 4.0)]


def test_gold_values_and_types(built):
    store = built[0]
    sales = store.read("gold", "kpi_sales_per_category")
    # Exactly one NULL category group; category sales use every item
    assert rows(sales) == [("cat_a", 24.0), ("cat_b", 25.0), (None, 8.75)]
    assert rows(store.read("gold", "kpi_orders_per_state")) == [("SP", 2)]
    running = store.read("gold", "cumulative_sales_per_customer")
    assert rows(running, "customer_id", "total_price", "cumulative_sales") == [
        ("c1", 12.0, 12.0),
        ("c1", 12.0, 24.0),
        ("c1", 25.0, 49.0),
        ("c1", 25.0, 74.0),
        ("c3", 8.75, 8.75),
    ]
    rolling = store.read("gold", "rolling_avg_delivery_per_category")
    assert rows(rolling, "product_category_name", "rolling_avg_delivery") == [
        ("cat_a", 4.0),
        ("cat_a", 4.0),
        ("cat_b", 4.0),
        ("cat_b", 4.0),
        (None, 75.0),
    ]
    # I8: int days, long counts, double sums and means
    types = {
        **dict(store.read("silver", "orders_enriched").dtypes),
        **dict(sales.dtypes),
        **dict(store.read("gold", "kpi_orders_per_state").dtypes),
        **dict(rolling.dtypes),
    }
    assert types["delivery_time_days"] == "int"
    assert types["payment_count"] == "bigint" and types["order_count"] == "bigint"
    assert types["total_sales"] == "double" and types["rolling_avg_delivery"] == "double"


def test_reports(built):
    reports = built[4]
    assert [tuple(r) for r in reports["top_categories"].collect()] == [
        ("cat_b", 25.0),
        ("cat_a", 24.0),
        (None, 8.75),
    ]
    assert [tuple(r) for r in reports["slowest_sellers"].collect()] == [("s1", 4.0), ("s2", 4.0)]
    assert [tuple(r) for r in reports["orders_by_state"].collect()] == [("SP", 2)]



def test_gold_build_removes_staged_window_input(built, spark):
    import glob

    from strata.session import ensure_checkpoint_dir

    root = ensure_checkpoint_dir(spark).replace("file:", "")
    before = set(glob.glob(f"{root}/scratch/gold-window-input-*"))
    store = built[0]
    medallion.build_gold(store)
    assert set(glob.glob(f"{root}/scratch/gold-window-input-*")) <= before
