"""Bronze -> silver -> gold -> report, as functions of DataFrames.

Each ``*_tables`` function is lazy and returns named DataFrames; the
``build_*`` functions add I/O through a :class:`LayerStore`.  Stages hand
over through storage, which also cuts lineage: a lost executor only costs
the stage it was running.
"""

from __future__ import annotations

import copy
from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from strata.operators.derive import add_amounts, add_delivery_days
from strata.operators.enrich import (
    DEFAULT_MAX_BROADCAST_BYTES,
    ESTIMATED_MAX_BROADCAST_BYTES,
    can_broadcast,
    enrich_items,
    enrich_orders,
    estimated_size_bytes,
    loaded_bytes,
    total_installments,
)
from strata.operators.metrics import kpi_tables, seller_deliveries, overall_mean
from strata.operators.quality import clean, even_keys
from strata.operators.reports import (
    ORDERS_BY_STATE_SQL,
    SLOWEST_SELLERS_SQL,
    TOP_CATEGORIES_SQL,
    run_report,
)
from strata.operators.windows import DEFAULT_PIECE_ROWS, PIECE, hottest_key, rolling_mean, running_total, stage_pieces
from strata.session import scratch_path, sized_session
from strata.schemas import BRONZE_TABLES, CLEAN_KEYS, CSV_OPTIONS, RAW_FILES
from strata.sources.csv import ingest_all
from strata.sources.store import delete_path

SILVER_TABLES = ("orders_enriched", "order_items_enriched")
GOLD_TABLES = (
    "cumulative_sales_per_customer",
    "rolling_avg_delivery_per_category",
    "kpi_sales_per_category",
    "kpi_avg_delivery_per_seller",
    "kpi_orders_per_state",
)

# Ordering of the two windows: purchase time, then keys that make ties
# deterministic (rows still tied are equal in every output column).
RUNNING_ORDER = ("order_purchase_timestamp", "order_id", "total_price")
ROLLING_ORDER = ("order_purchase_timestamp", "order_id")


# Tables whose cleaning key is also the key of their next join or aggregate.
DIMENSION_KEYS = {"customers": ["customer_id"], "products": ["product_id"], "sellers": ["seller_id"]}
JOIN_KEYS = {**DIMENSION_KEYS, "payments": ["order_id"], "reviews": ["order_id"]}
# Items are hashed on the key of their first lookup, if that one is joined by shuffle.
ITEM_KEYS = {"order_items": ["product_id"]}
# What the items look up.
LOOKUPS = ("products", "sellers", "translations")
# Rows of one key that may meet in a task while copies are dropped.
EVEN_KEY_ROWS = 100_000


def clean_all(
    bronze: Mapping[str, DataFrame],
    keys: Mapping[str, Sequence[str]] = CLEAN_KEYS,
    join_keys: Mapping[str, Sequence[str]] = DIMENSION_KEYS,
    small: Collection[str] | None = None,
) -> dict[str, DataFrame]:
    """D3 on every table with its key subset.

    Tables in ``join_keys`` are hashed once for cleaning and join, unless they
    are small enough to be broadcast: those in ``small``, or by their
    estimates.  By default these are the dimensions, whose key is their
    identity; :func:`build_silver` counts and decides.
    """
    if small is None:
        small = [name for name, df in bronze.items() if can_broadcast(df, ESTIMATED_MAX_BROADCAST_BYTES)]
    return {name: clean(df, keys.get(name, []), () if name in small else join_keys.get(name, ())) for name, df in bronze.items()}


def small_lookups(bronze: Mapping[str, DataFrame]) -> list[str]:
    """The tables the items look up that are small enough to be broadcast, by the counted rows that cleaning leaves."""
    stored = {name: bronze[name] for name in LOOKUPS if can_broadcast(bronze[name])}
    return [name for name, df in clean_all(stored, join_keys={}).items() if loaded_bytes(df) <= DEFAULT_MAX_BROADCAST_BYTES]


def silver_tables(
    bronze: Mapping[str, DataFrame],
    reviews_one_per_key: Mapping[str, str] | None = None,
    join_keys: Mapping[str, Sequence[str]] = DIMENSION_KEYS,
    small: Collection[str] | None = None,
) -> dict[str, DataFrame]:
    """Clean, derive and enrich: ``orders_enriched`` and ``order_items_enriched``.

    ``small`` names the tables that the items' lookups broadcast, where that is
    known (see :func:`small_lookups`).
    """
    t = clean_all(bronze, join_keys=join_keys, small=small)
    items = add_amounts(t["order_items"])
    orders = add_delivery_days(t["orders"])
    payments_agg = total_installments(t["payments"])
    orders_enriched = enrich_orders(
        orders, t["customers"], payments_agg, t["reviews"], reviews_one_per_key=reviews_one_per_key
    )
    items_enriched = enrich_items(items, t["products"], t["sellers"], t["translations"], small=small)
    return {"orders_enriched": orders_enriched, "order_items_enriched": items_enriched}


def window_input(
    orders: DataFrame,
    items: DataFrame,
    customer_key: str = "customer_id",
    category: str = "product_category_name",
) -> DataFrame:
    """J7 and J8 as one inner join: the columns both gold windows read."""
    return items.select("order_id", "total_price", category).join(
        orders.select("order_id", customer_key, "order_purchase_timestamp", "delivery_time_days"), "order_id", "inner"
    )


def stage_window_input(orders: DataFrame, items: DataFrame, **keys) -> tuple[DataFrame, str]:
    """Write :func:`window_input` once below the shared checkpoint folder; the stored frame and its path.

    Both gold windows read this join, and a chunked window reads its input
    twice.  Stored, the join runs once, the hottest key can be counted
    exactly, and a lost executor re-runs at most the window stages.
    """
    joined = window_input(orders, items, **keys)
    path = scratch_path(joined.sparkSession, "gold-window-input")
    joined.write.parquet(path)
    return joined.sparkSession.read.parquet(path), path


def stage_for_window(
    stored: DataFrame, keys: Sequence[str], order: Sequence[str], piece_rows: int = DEFAULT_PIECE_ROWS
) -> tuple[DataFrame, str | None, str | None]:
    """``(frame, chunk column, path)`` for a window over a stored frame.

    Counts the rows of every key.  If one exceeds ``piece_rows`` the frame is
    stored again in pieces, to be passed on with ``chunk``; else it is
    returned as it is, with no chunk and no path.
    """
    if hottest_key(stored, keys) <= piece_rows:
        return stored, None, None
    path = scratch_path(stored.sparkSession, "gold-window-pieces")
    return stage_pieces(stored, keys, order, path, piece_rows), PIECE, path


def running_sales(
    joined: DataFrame, customer_key: str = "customer_id", chunk=None, exact_scale: int | None = None
) -> DataFrame:
    """W1 over the joined window input."""
    out = running_total(
        joined, [customer_key], RUNNING_ORDER, "total_price", "cumulative_sales", exact_scale, chunk=chunk
    )
    return out.select(customer_key, "order_id", "order_purchase_timestamp", "total_price", "cumulative_sales")


def rolling_delivery(
    joined: DataFrame, category: str = "product_category_name", rows: int = 3, chunk=None
) -> DataFrame:
    """W2 over the joined window input."""
    out = rolling_mean(joined, [category], ROLLING_ORDER, "delivery_time_days", "rolling_avg_delivery", rows, chunk=chunk)
    return out.select(category, "order_id", "delivery_time_days", "rolling_avg_delivery")


def cumulative_sales_per_customer(
    orders: DataFrame, items: DataFrame, customer_key: str = "customer_id", exact_scale: int | None = None
) -> DataFrame:
    """W1 over items joined to their (delivered) orders (J7), as one lazy plan."""
    joined = items.join(orders.select("order_id", customer_key, "order_purchase_timestamp"), "order_id", "inner")
    return running_sales(joined, customer_key, exact_scale=exact_scale)


def rolling_avg_delivery_per_category(
    orders: DataFrame,
    items: DataFrame,
    category: str = "product_category_name",
    rows: int = 3,
    piece_rows: int | None = None,
    spark: SparkSession | None = None,
) -> DataFrame:
    """W2 over items joined to their (delivered) orders (J8), as one lazy plan.

    With ``piece_rows`` the joined rows are stored and a category with more
    rows is cut (see :func:`stage_for_window`); NULL, the items without a
    category, is such a one.  The stored rows are then read in ``spark``, by
    default the session of ``orders``.
    """
    if piece_rows is not None:
        stored, path = stage_window_input(orders, items, category=category)
        stored = stored if spark is None else spark.read.parquet(path)
        narrow = stored.select(category, *ROLLING_ORDER, "delivery_time_days")
        frame, chunk, _ = stage_for_window(narrow, [category], ROLLING_ORDER, piece_rows)
        return rolling_delivery(frame, category, rows, chunk=chunk)
    joined = items.join(
        orders.select("order_id", "delivery_time_days", "order_purchase_timestamp"), "order_id", "inner"
    )
    return rolling_delivery(joined, category, rows)


def gold_tables(
    orders: DataFrame, items: DataFrame, names: Sequence[str] = GOLD_TABLES, exact_scale: int | None = None
) -> dict[str, DataFrame]:
    """The gold tables asked for, as lazy plans over the two silver tables."""
    build = {
        "cumulative_sales_per_customer": lambda: cumulative_sales_per_customer(orders, items, exact_scale=exact_scale),
        "rolling_avg_delivery_per_category": lambda: rolling_avg_delivery_per_category(orders, items),
    }
    kpis = kpi_tables(orders, items, exact_scale=exact_scale) if set(names) - set(build) else {}
    return {name: build[name]() if name in build else kpis[name] for name in names}


def mean_delivery_time(orders: DataFrame, items: DataFrame) -> DataFrame:
    """A5: one-row mean over the seller-delivery input (shared with A3)."""
    return overall_mean(seller_deliveries(items, orders), "delivery_time_days", "mean_delivery_time")


def report_tables(spark: SparkSession, gold: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The three SQL reports over gold KPI views."""
    def report(sql: str, table: str) -> DataFrame:
        return run_report(spark, sql, {table: gold[table]})

    return {
        "top_categories": report(TOP_CATEGORIES_SQL, "kpi_sales_per_category"),
        "slowest_sellers": report(SLOWEST_SELLERS_SQL, "kpi_avg_delivery_per_seller"),
        "orders_by_state": report(ORDERS_BY_STATE_SQL, "kpi_orders_per_state"),
    }


# ----------------------------------------------------------------- with I/O
def sized_for(spark: SparkSession, tables: Mapping[str, DataFrame]) -> SparkSession:
    """A session whose tasks stay small over these stored tables (see :func:`sized_session`)."""
    return sized_session(spark, sum(estimated_size_bytes(df) or 0 for df in tables.values()))


def _sized(store, layer: str, names: Sequence[str]):
    """The store in a session sized for these tables of it."""
    out = copy.copy(store)
    out.spark = sized_for(store.spark, store.read_all(layer, names))
    return out


def build_bronze(
    spark: SparkSession, raw_root: str, store, files: Sequence[str] | None = None, rejects: str | None = None
) -> dict[str, int]:
    """Load the raw files; with ``rejects``, rows that do not fit their schema go to that layer."""
    names = list(files) if files is not None else [f"{n}.csv" for n in RAW_FILES]
    return ingest_all(
        spark, raw_root, names, store, "bronze", schemas=RAW_FILES, csv_options=CSV_OPTIONS, rejects=rejects
    )


def build_silver(store, even_key_rows: int = EVEN_KEY_ROWS) -> dict[str, int]:
    """Write the silver tables.

    The rows of the lookup tables are counted first: only small ones are
    broadcast, which the estimates of compressed files do not tell.  Then the
    keys of the stored bronze tables: a table with a hot key is de-duplicated
    by whole rows, the others by the key they join on.
    """
    store = _sized(store, "bronze", list(BRONZE_TABLES.values()))
    bronze = {logical: store.read("bronze", raw) for logical, raw in BRONZE_TABLES.items()}
    small = small_lookups(bronze)
    large = {name: df for name, df in bronze.items() if name not in small and (name in LOOKUPS or not can_broadcast(df, ESTIMATED_MAX_BROADCAST_BYTES))}
    keys = even_keys(large, JOIN_KEYS | (ITEM_KEYS if "products" in large else {}), even_key_rows)
    return store.write_all(silver_tables(bronze, join_keys=keys, small=small), "silver")


def build_gold(store, piece_rows: int = DEFAULT_PIECE_ROWS, exact_scale: int | None = None) -> dict[str, int]:
    """Write the five gold tables; what is stored for the windows is removed in any case."""
    store = _sized(store, "silver", SILVER_TABLES)
    orders = store.read("silver", "orders_enriched")
    items = store.read("silver", "order_items_enriched")
    paths: list[str | None] = []
    try:
        joined, path = stage_window_input(orders, items)
        paths.append(path)
        narrow = joined.select("customer_id", *RUNNING_ORDER)
        sales, sales_chunk, path = stage_for_window(narrow, ["customer_id"], RUNNING_ORDER, piece_rows)
        paths.append(path)
        narrow = joined.select("product_category_name", *ROLLING_ORDER, "delivery_time_days")
        days, days_chunk, path = stage_for_window(narrow, ["product_category_name"], ROLLING_ORDER, piece_rows)
        paths.append(path)
        tables = {
            "cumulative_sales_per_customer": running_sales(sales, chunk=sales_chunk, exact_scale=exact_scale),
            "rolling_avg_delivery_per_category": rolling_delivery(days, chunk=days_chunk),
            **kpi_tables(orders, items, exact_scale=exact_scale),
        }
        return store.write_all(tables, "gold")
    finally:
        for path in paths:
            if path is not None:
                delete_path(orders.sparkSession, path.rsplit("/", 1)[0])  # with its scratch folder


def build_reports(spark: SparkSession, store) -> dict[str, DataFrame]:
    return report_tables(spark, store.read_all("gold", GOLD_TABLES))
