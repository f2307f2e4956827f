import math

import pytest

from conftest import rows

from strata.operators.metrics import (
    distinct_count_by,
    kpi_tables,
    mean_by,
    mean_delivery_by_seller,
    overall_mean,
    seller_deliveries,
    total_by,
)
from strata.operators.reports import (
    ORDERS_BY_STATE_SQL,
    SLOWEST_SELLERS_SQL,
    TOP_CATEGORIES_SQL,
    ranked,
    run_report,
    top_n,
)


def test_total_by_keeps_null_group_and_is_exact(spark):
    df = spark.createDataFrame(
        [("a", 0.1)] * 10 + [(None, 1.5), (None, 2.25), ("b", None)], "cat string, total_price double"
    )
    out = dict(rows(total_by(df, "cat", "total_price", exact_scale=2)))
    assert out == {"a": 1.0, None: 3.75, "b": None}


def test_mean_by_half_up(spark):
    # 1.005 -> 1.01 and 2.345 -> 2.35 (HALF_UP on the decimal value), 0.125 -> 0.13
    data = [("x", v) for v in [1] * 199 + [2]] + [("y", v) for v in [2] * 131 + [3] * 69] + [("z", 0), ("z", 0), ("z", 0), ("z", 0), ("z", 0), ("z", 0), ("z", 0), ("z", 1)]
    df = spark.createDataFrame(data, "s string, d int")
    got = dict(rows(mean_by(df, "s", "d", "m", 2)))
    assert got == {"x": 1.01, "y": 2.35, "z": 0.13}


def test_distinct_count_and_overall_mean(spark):
    df = spark.createDataFrame([("SP", 1), ("SP", 1), ("SP", 2), ("RJ", 3), (None, 4)], "st string, o int")
    out = distinct_count_by(df, "st", "o", "order_count")
    assert dict(out.dtypes)["order_count"] == "bigint"
    assert dict(rows(out)) == {"SP": 2, "RJ": 1, None: 1}
    assert overall_mean(df, "o", "m").first()["m"] == 11 / 5


def _silver(spark):
    orders = spark.createDataFrame(
        [("o1", 5, "SP"), ("o1", 5, "SP"), ("o2", 61, "RJ"), ("o3", 0, "SP"), ("o4", 10, None)],
        "order_id string, delivery_time_days int, customer_state string",
    )  # o1 twice: review fan-out
    items = spark.createDataFrame(
        [("o1", "s1", "cama", 10.0), ("o1", "s1", "cama", 5.0), ("o2", "s1", None, 1.0), ("o4", "s2", "mesa", 2.0),
         ("o9", "s3", "cama", 4.0)],
        "order_id string, seller_id string, product_category_name string, total_price double",
    )
    return orders, items


def test_seller_means_use_distinct_pairs_and_range(spark):
    orders, items = _silver(spark)
    pairs = seller_deliveries(items, orders)
    # (o1, s1) once per order row: the fan-out weighs o1 twice; o2 (61) and o3 (0) drop out
    assert sorted(r["delivery_time_days"] for r in pairs.collect()) == [5, 5, 10]
    assert dict(rows(mean_delivery_by_seller(items, orders))) == {"s1": 5.0, "s2": 10.0}


def test_kpi_tables(spark):
    orders, items = _silver(spark)
    k = kpi_tables(orders, items)
    assert dict(rows(k["kpi_sales_per_category"])) == {"cama": 19.0, "mesa": 2.0, None: 1.0}
    assert dict(rows(k["kpi_orders_per_state"])) == {"SP": 2, "RJ": 1, None: 1}


def test_top_n_ties_and_nulls(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", 5.0), ("c", 5.0), ("d", None), ("e", 1.0)], "k string, v double")
    assert [r["k"] for r in top_n(df, "v", 2, tie_break=["k"]).collect()] == ["b", "c"]
    assert [r["k"] for r in ranked(df, "v").collect()][-1] == "d"  # DESC puts NULLs last
    assert [r["k"] for r in ranked(df, "v", descending=False, tie_break=["k"]).collect()][0] == "d"


def test_sql_and_dataframe_reports_agree(spark):
    orders, items = _silver(spark)
    k = kpi_tables(orders, items)
    sql_top = [tuple(r) for r in run_report(spark, TOP_CATEGORIES_SQL, k).collect()]
    df_top = [tuple(r) for r in top_n(k["kpi_sales_per_category"], "total_sales", 10,
                                      tie_break=["product_category_name"]).collect()]
    assert sql_top == df_top
    assert [tuple(r) for r in run_report(spark, SLOWEST_SELLERS_SQL, k).collect()] == [("s2", 10.0), ("s1", 5.0)]
    by_state = [tuple(r) for r in run_report(spark, ORDERS_BY_STATE_SQL, k).collect()]
    assert by_state == [("SP", 2), (None, 1), ("RJ", 1)]
    plan = run_report(spark, TOP_CATEGORIES_SQL, k)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_total_by_is_a_plain_sum_by_default(spark):
    rows = [("a", 0.004)] * 1000 + [("n", float("nan")), ("n", float("nan")), ("big", 3e17), ("big", 3e17)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: r["total_sales"] for r in total_by(df, "k", "v").collect()}
    assert got["a"] == pytest.approx(4.0) and math.isnan(got["n"]) and got["big"] == 6e17


def test_exact_scale_holds_noise_and_refuses_the_rest(spark):
    def total(values):
        return total_by(spark.createDataFrame([("a", v) for v in values], "k string, v double"), "k", "v", exact_scale=2).first()["total_sales"]

    assert total([10.1 + 0.2, 0.1 + 0.2 - 0.3, None]) == 10.3
    assert math.isnan(total([1.0, float("nan")])) and total([1.0, float("inf")]) == float("inf")
    assert total([None]) is None
    for bad in (0.004, 3e17):
        with pytest.raises(Exception, match="cannot be held"):
            total([1.0, bad])


def test_reports_of_two_sets_do_not_meet(spark):
    from strata.operators.reports import run_report

    a = spark.createDataFrame([("x", 1.0)], "product_category_name string, total_sales double")
    b = spark.createDataFrame([("y", 2.0)], "product_category_name string, total_sales double")
    text = "SELECT product_category_name FROM {kpi}"
    first, second = run_report(spark, text, {"kpi": a}), run_report(spark, text, {"kpi": b})
    assert first.first()[0] == "x" and second.first()[0] == "y"
