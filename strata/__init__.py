"""strata: layered (bronze / silver / gold) batch analytics on Spark.

Every operator is a plain ``DataFrame -> DataFrame`` function; sessions,
I/O and composites live at the edges (``session``, ``sources``, ``plans``).
"""

from strata.operators.derive import add_amounts, add_delivery_days, add_elapsed_days, keep_delivered, within
from strata.operators.enrich import enrich_items, enrich_orders, lookup, total_installments
from strata.operators.metrics import (
    distinct_count_by,
    kpi_tables,
    mean_by,
    mean_delivery_by_seller,
    overall_mean,
    seller_deliveries,
    total_by,
)
from strata.operators.quality import clean, dedupe, distinct_pairs, drop_null_keys
from strata.operators.reports import ranked, register_views, run_report, top_n
from strata.operators.windows import rolling_mean, running_total
from strata.plans.flow import Flow
from strata.session import build_session, ensure_checkpoint_dir, sizing_conf
from strata.sources.csv import ingest_all, read_csv
from strata.sources.store import LayerStore, row_counts

__all__ = [
    "sizing_conf",
    "Flow",
    "LayerStore",
    "add_amounts",
    "add_delivery_days",
    "add_elapsed_days",
    "build_session",
    "clean",
    "dedupe",
    "distinct_count_by",
    "distinct_pairs",
    "drop_null_keys",
    "enrich_items",
    "enrich_orders",
    "ensure_checkpoint_dir",
    "ingest_all",
    "keep_delivered",
    "kpi_tables",
    "lookup",
    "mean_by",
    "mean_delivery_by_seller",
    "overall_mean",
    "ranked",
    "read_csv",
    "register_views",
    "rolling_mean",
    "row_counts",
    "run_report",
    "running_total",
    "seller_deliveries",
    "top_n",
    "total_by",
    "total_installments",
    "within",
]
