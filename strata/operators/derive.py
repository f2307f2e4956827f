"""Derived amounts, calendar-day durations and range filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import elapsed_days


def add_amounts(
    df: DataFrame,
    price: str = "price",
    freight: str = "freight_value",
    total: str = "total_price",
    margin: str = "profit_margin",
) -> DataFrame:
    """``total = price + freight`` and ``margin = price - freight`` (NULL if either is NULL)."""
    return df.withColumns(
        {total: F.col(price) + F.col(freight), margin: F.col(price) - F.col(freight)}
    )


def add_elapsed_days(
    df: DataFrame,
    end: str,
    start: str,
    out: str = "delivery_time_days",
    guarded: bool = True,
) -> DataFrame:
    """Whole calendar days ``end - start`` as ``int``.

    ``guarded`` writes the NULL case explicitly (``when`` without
    ``otherwise``); both forms give the same values because ``datediff`` is
    NULL-safe.  With zoned timestamps the day boundary is the session zone's.
    """
    expr = elapsed_days(end, start) if guarded else F.datediff(F.col(end), F.col(start))
    return df.withColumn(out, expr)


def keep_delivered(df: DataFrame, days: str = "delivery_time_days", end: str | None = None) -> DataFrame:
    """Keep rows with a known, strictly positive duration.

    When the end column is given the NULL check is made on it, a base column
    the scan or an outer join below can use; the duration check follows.
    """
    cond = F.col(days) > 0
    if end is not None:
        cond = F.col(end).isNotNull() & cond
    else:
        cond = F.col(days).isNotNull() & cond
    return df.filter(cond)


def within(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Closed range ``lo <= col <= hi``; NULL is dropped."""
    return df.filter(F.col(col).between(lo, hi))


def add_delivery_days(
    orders: DataFrame,
    delivered: str = "order_delivered_customer_date",
    purchased: str = "order_purchase_timestamp",
    out: str = "delivery_time_days",
) -> DataFrame:
    """Orders with a positive delivery duration (the composite of P4, F1, F2)."""
    return keep_delivered(add_elapsed_days(orders, delivered, purchased, out), out, end=delivered)
