"""Key-performance tables.

All are hash aggregates with a map-side partial step, so a hot group is
pre-aggregated in every map task before the shuffle.  The exact distinct
count is planned by Spark as two aggregations, first on (key, value) and
then on key, so no task ever holds a group's distinct set.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import exact_sum
from strata.operators.derive import within
from strata.operators.quality import distinct_pairs


def _keys(by: str | Sequence[str]) -> list[str]:
    return [by] if isinstance(by, str) else list(by)


def total_by(
    df: DataFrame, by: str | Sequence[str], value: str, out: str = "total_sales", exact_scale: int | None = None
) -> DataFrame:
    """Per-group sum; NULL keys form their own group.

    A plain sum by default.  With ``exact_scale`` amounts on a decimal grid
    are summed as decimals (see :func:`strata.functions.exact_sum`).
    """
    agg = exact_sum(value, exact_scale) if exact_scale is not None else F.sum(value)
    return df.groupBy(*_keys(by)).agg(agg.alias(out))


def mean_by(df: DataFrame, by: str | Sequence[str], value: str, out: str, round_to: int | None = 2) -> DataFrame:
    """Per-group mean, rounded HALF_UP to ``round_to`` places when given."""
    m = F.avg(value)
    if round_to is not None:
        m = F.round(m, round_to)
    return df.groupBy(*_keys(by)).agg(m.alias(out))


def distinct_count_by(df: DataFrame, by: str | Sequence[str], value: str, out: str = "order_count") -> DataFrame:
    """Exact number of distinct ``value`` per group (``bigint``)."""
    return df.groupBy(*_keys(by)).agg(F.countDistinct(value).alias(out))


def overall_mean(df: DataFrame, value: str, out: str = "mean_delivery_time") -> DataFrame:
    """One-row global mean."""
    return df.select(F.mean(value).alias(out))


def seller_deliveries(
    items: DataFrame,
    orders: DataFrame,
    order_key: str = "order_id",
    seller_key: str = "seller_id",
    days: str = "delivery_time_days",
    lo: int = 1,
    hi: int = 60,
) -> DataFrame:
    """Distinct (order, seller) pairs joined to order durations within [lo, hi].

    The range filter is placed on the order side before the join; Catalyst
    would push it there anyway, and the NULL check it implies reaches the
    scan.  Orders repeated in ``orders`` (review fan-out) weigh more, as in
    the reference.
    """
    pairs = distinct_pairs(items, [order_key, seller_key])
    durations = within(orders.select(order_key, days), days, lo, hi)
    return pairs.join(durations, order_key, "inner")


def mean_delivery_by_seller(
    items: DataFrame,
    orders: DataFrame,
    seller_key: str = "seller_id",
    days: str = "delivery_time_days",
    out: str = "avg_delivery_time",
    lo: int = 1,
    hi: int = 60,
    round_to: int = 2,
    order_key: str = "order_id",
) -> DataFrame:
    """Mean delivery days per seller over distinct (order, seller) pairs (A3)."""
    joined = seller_deliveries(items, orders, order_key, seller_key, days, lo, hi)
    return mean_by(joined, seller_key, days, out, round_to)


def kpi_tables(
    orders: DataFrame,
    items: DataFrame,
    category: str = "product_category_name",
    total: str = "total_price",
    seller_key: str = "seller_id",
    state: str = "customer_state",
    order_key: str = "order_id",
    days: str = "delivery_time_days",
    exact_scale: int | None = None,
) -> dict[str, DataFrame]:
    """The three KPI tables (A7): category sales, seller mean delivery, state order counts.

    Category sales use every item, delivered or not, as in the reference.
    """
    return {
        "kpi_sales_per_category": total_by(items, category, total, "total_sales", exact_scale),
        "kpi_avg_delivery_per_seller": mean_delivery_by_seller(
            items, orders, seller_key, days, "avg_delivery_time", order_key=order_key
        ),
        "kpi_orders_per_state": distinct_count_by(orders, state, order_key, "order_count"),
    }
