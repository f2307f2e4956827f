"""Registered queries over the test tables, one per inventory operator.

Every query reads the given parquet tables (through the mapping in
``strata.plans.mapped``) and runs over them whole.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.derive import add_amounts, add_delivery_days, add_elapsed_days
from strata.operators.enrich import lookup, total_installments
from strata.operators.metrics import distinct_count_by, kpi_tables, mean_delivery_by_seller, total_by
from strata.operators.quality import clean, dedupe, distinct_pairs, even_keys
from strata.operators.reports import REPORTS, numbered, report_sql, run_report, top_n
from strata.operators.windows import DEFAULT_PIECE_ROWS, running_total
from strata.plans import medallion
from strata.plans.flow import Flow
from strata.plans.mapped import TPCH_TABLES, bronze_tables, load
from strata.session import scratch_path
from strata.schemas import BRONZE_TABLES, RAW_FILES
from strata.sources.csv import ingest_all, read_csv
from strata.sources.store import LayerStore, row_counts

Query = Callable[[SparkSession, str], DataFrame]


# Amounts of the mapped tables are whole cents.
CENTS = 2


def _sized_for_tables(spark: SparkSession, sf: str) -> SparkSession:
    return medallion.sized_for(spark, {name: load(spark, sf, name) for name in TPCH_TABLES})


def _silver(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return medallion.silver_tables(bronze_tables(spark, sf))


def _cleaned(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return medallion.clean_all(bronze_tables(spark, sf))


# ------------------------------------------------------------ silver stage
def item_amounts(spark, sf):
    return add_amounts(_cleaned(spark, sf)["order_items"])


def delivered_orders(spark, sf):
    return add_delivery_days(_cleaned(spark, sf)["orders"])


def order_installments(spark, sf):
    return total_installments(_cleaned(spark, sf)["payments"])


def orders_enriched(spark, sf):
    return _silver(spark, sf)["orders_enriched"]


def orders_enriched_one_review(spark, sf):
    bronze = bronze_tables(spark, sf)
    return medallion.silver_tables(bronze, reviews_one_per_key={"review_score": "max"})["orders_enriched"]


def items_enriched(spark, sf):
    return _silver(spark, sf)["order_items_enriched"]


def dedupe_copies(spark, sf):
    li = load(spark, sf, "lineitem")
    return dedupe(li.unionByName(li))


def clean_items(spark, sf):
    items = _silver(spark, sf)["order_items_enriched"]
    return clean(items.select("order_id", "seller_id", "product_category_name"), ["product_category_name"])


def seller_order_pairs(spark, sf):
    return distinct_pairs(_silver(spark, sf)["order_items_enriched"], ["order_id", "seller_id"])


# -------------------------------------------------------------- gold stage
def customer_running_sales(spark, sf):
    s = _silver(spark, sf)
    return medallion.cumulative_sales_per_customer(s["orders_enriched"], s["order_items_enriched"], exact_scale=CENTS)


def category_rolling_delivery(spark, sf):
    """W2; half of the items have no category, so the joined rows are stored and that key is cut when it is hot."""
    s = _silver(_sized_for_tables(spark, sf), sf)
    return medallion.rolling_avg_delivery_per_category(
        s["orders_enriched"], s["order_items_enriched"], piece_rows=DEFAULT_PIECE_ROWS, spark=spark
    )


def customer_running_sales_staged(spark, sf):
    """W1 as the gold stage runs it: the shared window input is stored once,
    its hottest key counted, and the window reads that table."""
    s = _silver(spark, sf)
    stored, _ = medallion.stage_window_input(s["orders_enriched"], s["order_items_enriched"])
    frame, chunk, _ = medallion.stage_for_window(stored, ["customer_id"], medallion.RUNNING_ORDER)
    return medallion.running_sales(frame, chunk=chunk, exact_scale=CENTS)


def category_rolling_delivery_by_key(spark, sf):
    """W2 in pieces of about 1,000 rows along (category, ordering): a task size
    small enough that every category is cut on the test tables."""
    s = _silver(spark, sf)
    stored, _ = medallion.stage_window_input(s["orders_enriched"], s["order_items_enriched"])
    frame, chunk, _ = medallion.stage_for_window(stored, ["product_category_name"], medallion.ROLLING_ORDER, 1000)
    return medallion.rolling_delivery(frame, chunk=chunk)


def hot_key_running_quantity(spark, sf):
    """W1 over two keys that hold all lines, cut into pieces of about 2,000 rows."""
    lines = load(spark, sf, "lineitem").select("l_linestatus", "l_shipdate", "l_orderkey", "l_linenumber", "l_quantity")
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_quantity"]
    frame, chunk, _ = medallion.stage_for_window(lines, ["l_linestatus"], order, 2000)
    out = running_total(frame, ["l_linestatus"], order, "l_quantity", "running_quantity", CENTS, chunk=chunk)
    return out.select("l_linestatus", "l_orderkey", "l_linenumber", "running_quantity")


def category_sales(spark, sf):
    items = _silver(spark, sf)["order_items_enriched"]
    return total_by(items, "product_category_name", "total_price", "total_sales", exact_scale=CENTS)


def flag_tax_share_exact(spark, sf):
    """A2 on a six-place grid: price * discount * tax per return flag."""
    li = load(spark, sf, "lineitem")
    product = li.withColumn("amount", F.col("l_extendedprice") * F.col("l_discount") * F.col("l_tax"))
    return total_by(product, "l_returnflag", "amount", "total", exact_scale=6)


def flag_tax_share(spark, sf):
    """A2 as a plain sum of doubles, rounded only after the sum."""
    li = load(spark, sf, "lineitem")
    product = li.withColumn("amount", F.col("l_extendedprice") * F.col("l_discount") * F.col("l_tax"))
    return total_by(product, "l_returnflag", "amount", "total").withColumn("total", F.round("total", 3))


def seller_mean_delivery(spark, sf):
    s = _silver(spark, sf)
    return mean_delivery_by_seller(s["order_items_enriched"], s["orders_enriched"])


def orders_per_state(spark, sf):
    return distinct_count_by(_silver(spark, sf)["orders_enriched"], "customer_state", "order_id", "order_count")


def overall_mean_delivery(spark, sf):
    s = _silver(spark, sf)
    return medallion.mean_delivery_time(s["orders_enriched"], s["order_items_enriched"])


# ----------------------------------------------------------------- reports
def _report(spark, sf, name):
    s = _silver(spark, sf)
    return medallion.report_tables(spark, kpi_tables(s["orders_enriched"], s["order_items_enriched"], exact_scale=CENTS))[name]


def category_sales_top10(spark, sf):
    return _report(spark, sf, "top_categories")


def slowest_sellers_top10(spark, sf):
    return _report(spark, sf, "slowest_sellers")


def orders_by_state_ranked(spark, sf):
    return _report(spark, sf, "orders_by_state")


def part_name_sales_top10(spark, sf):
    """DataFrame form of a top-10 report over 64 product names."""
    items = add_amounts(_cleaned(spark, sf)["order_items"])
    part = load(spark, sf, "part").select(F.col("p_partkey"), F.col("p_name").alias("product_name"))
    named = lookup(items, part, {"product_id": "p_partkey"})
    sales = total_by(named, "product_name", "total_price", "total_sales", exact_scale=CENTS)
    return top_n(sales, "total_sales", 10, tie_break=["product_name"])


# ------------------------------------------------------ sources and sinks
def csv_roundtrip(spark, sf):
    li = load(spark, sf, "lineitem")
    path = scratch_path(spark, "csv-lineitem")
    li.write.option("header", True).csv(path)
    return read_csv(spark, path, schema=li.schema)


def layer_roundtrip(spark, sf):
    store = LayerStore(spark, scratch_path(spark, "layers"))
    store.write(load(spark, sf, "orders"), "bronze", "orders")
    return store.read("bronze", "orders")


def append_mode(spark, sf):
    store = LayerStore(spark, scratch_path(spark, "layers"))
    orders = load(spark, sf, "orders")
    store.write(orders, "bronze", "orders", mode="overwrite")
    store.write(orders, "bronze", "orders", mode="append")
    return store.read("bronze", "orders")


def self_overwrite(spark, sf):
    """Overwrite a table from a plan that reads it (staged through the checkpoint folder)."""
    store = LayerStore(spark, scratch_path(spark, "layers"))
    store.write(load(spark, sf, "customer"), "bronze", "customer")
    current = store.read("bronze", "customer")
    store.write(current.filter(F.col("c_acctbal") >= 0), "bronze", "customer")
    return store.read("bronze", "customer")


def _layers(spark, sf, piece_rows: int = DEFAULT_PIECE_ROWS) -> LayerStore:
    """Bronze written from the mapped tables under the raw names, then silver and gold by the stage drivers."""
    store = LayerStore(spark, scratch_path(spark, "medallion"))
    sized = _sized_for_tables(spark, sf)
    bronze = bronze_tables(sized, sf)
    LayerStore(sized, store.root).write_all({BRONZE_TABLES[name]: df for name, df in bronze.items()}, "bronze")
    medallion.build_silver(store)
    medallion.build_gold(store, piece_rows=piece_rows, exact_scale=CENTS)
    return store


def gold_build(spark, sf):
    """Bronze -> silver -> gold through a layer store, then a gold table read back."""
    return _layers(spark, sf).read("gold", "kpi_sales_per_category")


#: A column of each gold table whose sum, to two places, stands for its contents.
GOLD_CHECKS = {
    "cumulative_sales_per_customer": "cumulative_sales",
    "rolling_avg_delivery_per_category": "rolling_avg_delivery",
    "kpi_sales_per_category": "total_sales",
    "kpi_avg_delivery_per_seller": "avg_delivery_time",
    "kpi_orders_per_state": "order_count",
}


def gold_stage(spark, sf):
    """The whole gold stage, hot categories cut: (table, rows, checksum) of the five written tables."""
    tables = _layers(spark, sf, piece_rows=5000).read_all("gold", medallion.GOLD_TABLES)
    return _summary({name: (df, GOLD_CHECKS[name]) for name, df in tables.items()})


def _summary(tables):
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count"), F.round(F.sum(F.col(c).cast("double")), 1).alias("checksum")).select(
            F.lit(name).alias("table_name"), "row_count", "checksum"
        )
        for name, (df, c) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def table_counts(spark, sf):
    """Row counts of the gold tables as written."""
    return row_counts(_layers(spark, sf).read_all("gold", medallion.GOLD_TABLES))


def _raw_csvs(spark, sf) -> str:
    root = scratch_path(spark, "raw-csv")
    for name in CSV_CHECKS:
        load(spark, sf, name).write.option("header", True).csv(f"{root}/{name}.csv")
    return root


#: A numeric column of each table that the CSV queries load.
CSV_CHECKS = {"orders": "o_totalprice", "lineitem": "l_extendedprice", "part": "p_size"}


def csv_ingest_declared(spark, sf):
    """Several raw files into bronze with declared schemas; rows and checksum of each table."""
    root, store = _raw_csvs(spark, sf), LayerStore(spark, scratch_path(spark, "layers"))
    ingest_all(spark, root, [f"{n}.csv" for n in CSV_CHECKS], store, schemas={n: load(spark, sf, n).schema for n in CSV_CHECKS})
    return _summary({n: (store.read("bronze", n), c) for n, c in CSV_CHECKS.items()})


def csv_ingest_inferred(spark, sf):
    """The same with inferred types."""
    root, store = _raw_csvs(spark, sf), LayerStore(spark, scratch_path(spark, "layers"))
    ingest_all(spark, root, [f"{n}.csv" for n in CSV_CHECKS], store)
    return _summary({n: (store.read("bronze", n), c) for n, c in CSV_CHECKS.items()})


def _csv_flow(spark, sf):
    flow = Flow(spark, _raw_csvs(spark, sf), LayerStore(spark, scratch_path(spark, "flow")))
    lines = flow.read_csv("lineitem.csv", schema=load(spark, sf, "lineitem").schema)
    steps = [
        ("drop missing keys", lambda df: clean(df, ["l_orderkey"])),
        ("keep finished", lambda df: df.filter(F.col("l_linestatus") == "F")),
        ("keep finished", lambda df: df.filter(F.col("l_quantity") > 10)),
    ]
    return flow, flow.apply(lines, steps)


def csv_flow_saved(spark, sf):
    """CSV -> named steps -> save, read back."""
    flow, out = _csv_flow(spark, sf)
    flow.save(out, "silver", "finished_lines")
    return flow.store.read("silver", "finished_lines")


def csv_flow_counts(spark, sf):
    """Rows before and after each step of that flow."""
    return _csv_flow(spark, sf)[0].step_counts()


def named_steps(spark, sf):
    """Step runner on the orders table: add durations without filtering (P5)."""
    flow = Flow(spark, sf, LayerStore(spark, scratch_path(spark, "flow")))
    orders = bronze_tables(spark, sf)["orders"]
    steps = [
        (
            "add delivery time",
            lambda df: add_elapsed_days(df, "order_delivered_customer_date", "order_purchase_timestamp", guarded=False),
        )
    ]
    out = flow.apply(orders, steps)
    flow.save(out, "silver", "orders_with_days")
    return flow.store.read("silver", "orders_with_days")


def bronze_incremental(spark, sf):
    from strata.streaming.ingest import ingest_incremental

    li = load(spark, sf, "lineitem")
    target = scratch_path(spark, "stream-lineitem")
    ingest_incremental(
        spark, sf, li.schema, target, source_format="parquet", options={"pathGlobFilter": "lineitem.parquet"}
    )
    return spark.read.parquet(target)


# --------------------------------------- storage, raw files and order, in depth
def interrupted_overwrite(spark, sf):
    """K4: overwrites that stop between their two renames, read by another store.

    One had its new version committed and is completed; of the other one the
    new version is gone, so the old one comes back.
    """
    customers, found = load(spark, sf, "customer"), []
    for case, committed in (("committed", True), ("lost", False)):
        store = LayerStore(spark, scratch_path(spark, "layers"))
        store.write(customers, "bronze", "customer")
        staged, _ = store.stage(customers.filter(F.col("c_acctbal") >= 0), "bronze", "customer")
        store.set_aside(staged, store.path("bronze", "customer"))
        if not committed:
            store.discard(staged)
        table = LayerStore(spark, store.root).read("bronze", "customer")
        found.append(table.select(F.lit(case).alias("new_version"), "c_custkey", "c_name", "c_acctbal"))
    return reduce(DataFrame.unionByName, found)


def write_modes(spark, sf):
    """K4: every mode on no table and then on a table: rows reported, rows in the table, refused or not."""
    first = load(spark, sf, "customer")
    second = first.filter(F.col("c_acctbal") >= 0)
    seen = []
    for mode in ("overwrite", "append", "ignore", "error"):
        store = LayerStore(spark, scratch_path(spark, "layers"))
        for step, df in enumerate((first, second), 1):
            try:
                written, refused = store.write(df, "bronze", "customer", mode=mode), False
            except FileExistsError:
                written, refused = 0, True
            seen.append((mode, step, written, store.read("bronze", "customer").count(), refused))
    return spark.createDataFrame(seen, "mode string, step int, written long, table_rows long, refused boolean")


#: Columns of the raw order lines that the malformed-row queries write and read.
ORDER_LINE = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string"


def _broken_orders(spark, sf) -> str:
    """Order lines as raw text; of seven kinds of keys three get a broken line: a bad price, a field too many, fields missing."""
    o = load(spark, sf, "orders")
    kind = F.col("o_orderkey") % 7
    price = F.when(kind == 1, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
    fields = ["o_orderkey", "o_custkey", "o_orderstatus", price, "o_orderpriority"]
    line = F.when(kind == 3, F.concat_ws(",", *fields, F.lit("extra"))).when(kind == 5, F.concat_ws(",", *fields[:3]))
    root = scratch_path(spark, "raw-csv")
    o.select(line.otherwise(F.concat_ws(",", *fields)).alias("value")).write.text(f"{root}/orders.csv")
    return root


def _ingest_broken(spark, sf):
    store = LayerStore(spark, scratch_path(spark, "layers"))
    root = _broken_orders(spark, sf)
    counts = ingest_all(
        spark, root, ["orders.csv"], store, schemas={"orders": ORDER_LINE}, csv_options={"orders": {"header": False}}, rejects="rejected"
    )
    return store, counts


def csv_rejects(spark, sf):
    """A raw file with broken rows: the good rows, and the rows set aside with their text."""
    store, _ = _ingest_broken(spark, sf)
    cols = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"]
    good = store.read("bronze", "orders").select(F.lit("bronze").alias("layer"), *cols, F.lit(None).cast("string").alias("raw_row"))
    return good.unionByName(store.read("rejected", "orders").select(F.lit("rejected").alias("layer"), *cols, "raw_row"))


def csv_reject_counts(spark, sf):
    """Rows written and rows set aside, as the ingest reports them."""
    _, counts = _ingest_broken(spark, sf)
    return spark.createDataFrame(list(counts.items()), "table_name string, row_count long")


def csv_inferred_late(spark, sf):
    """Types that a sample cannot show: one order's status code is text, all others are numbers.

    Columns with their types, and the rows of the table.
    """
    o = load(spark, sf, "orders")
    last = o.agg(F.max("o_orderkey").alias("last"))
    code = F.when(F.col("o_orderkey") == F.col("last"), F.lit("none")).otherwise((F.col("o_orderkey") % 5).cast("string"))
    root = scratch_path(spark, "raw-csv")
    rows = o.crossJoin(F.broadcast(last)).select("o_orderkey", code.alias("code"), "o_totalprice")  # one row on the right
    rows.write.option("header", True).csv(f"{root}/codes.csv")
    store = LayerStore(spark, scratch_path(spark, "layers"))
    n = ingest_all(spark, root, ["codes.csv"], store)["codes"]
    types = store.read("bronze", "codes").dtypes
    return spark.createDataFrame([(name, kind, n) for name, kind in types], "column_name string, type string, row_count long")


def csv_missing_input(spark, sf):
    """S3: of several raw files one does not exist: which could be read, and their rows."""
    flow = Flow(spark, _raw_csvs(spark, sf), LayerStore(spark, scratch_path(spark, "flow")))
    seen = []
    for name in [*CSV_CHECKS, "refunds"]:
        try:
            seen.append((name, True, flow.read_csv(f"{name}.csv", infer_schema=False).count()))
        except FileNotFoundError:
            seen.append((name, False, None))
    return spark.createDataFrame(seen, "file string, found boolean, row_count long")


def flow_limited_counts(spark, sf):
    """Steps of which one stops reading early; the counts of the others stay complete."""
    flow = Flow(spark, sf, LayerStore(spark, scratch_path(spark, "flow")))
    steps = [
        ("keep finished", lambda df: df.filter(F.col("l_linestatus") == "F")),
        ("first hundred", lambda df: df.limit(100)),
        ("add price", lambda df: df.withColumn("unit_price", F.col("l_extendedprice") / F.col("l_quantity"))),
        ("nothing", lambda df: df.filter(F.lit(False))),
    ]
    flow.apply(load(spark, sf, "lineitem"), steps)
    return flow.step_counts()


def _hot_payments(spark, sf) -> DataFrame:
    """Payments of which a third belong to one order, every row twice."""
    p = bronze_tables(spark, sf)["payments"]
    p = p.withColumn("order_id", F.when(F.col("order_id") % 3 == 0, F.lit(0).cast("long")).otherwise(F.col("order_id")))
    return p.unionByName(p)


#: Rows of one key that the hot-key query lets meet in a task: few enough that the test tables have a hot key.
HOT_QUERY_ROWS = 1000


def cleaned_hot_payments(spark, sf) -> DataFrame:
    """The cleaned payments, dealt out as the counted keys allow (see ``even_keys``)."""
    store = LayerStore(spark, scratch_path(spark, "layers"))
    store.write(_hot_payments(spark, sf), "bronze", "payments")
    stored = {"payments": store.read("bronze", "payments")}
    keys = even_keys(stored, medallion.JOIN_KEYS, HOT_QUERY_ROWS)
    return clean(stored["payments"], ["order_id"], keys.get("payments", ()))


def clean_hot_payments(spark, sf):
    """D3 and A1 with a third of the payments on one order: rows left and installments of every order."""
    paid = cleaned_hot_payments(spark, sf)
    return paid.groupBy("order_id").agg(F.count(F.lit(1)).alias("payments"), F.sum("payment_installments").alias("payment_count"))


def _position_reports(tables) -> DataFrame:
    """The three fixed reports with the rows' places in their order."""
    parts = []
    for table, key, measure, limit in REPORTS:
        rows = numbered(tables[table], measure, tie_break=[key], cols=[key, measure])
        if limit is not None:
            rows = rows.filter(F.col("position") <= limit)
        parts.append(
            rows.select(F.lit(table).alias("report"), "position", F.col(key).cast("string").alias("key"), F.col(measure).cast("double").alias("value"))
        )
    return reduce(DataFrame.unionByName, parts)


def report_positions(spark, sf):
    """The reports of gold KPIs with each row's place as a column."""
    s = _silver(spark, sf)
    return _position_reports(kpi_tables(s["orders_enriched"], s["order_items_enriched"], exact_scale=CENTS))


def orders_by_price_positions(spark, sf):
    """All orders by descending price with their places: a row number over a whole table, in ranges."""
    orders = load(spark, sf, "orders")
    return numbered(orders, "o_totalprice", tie_break=["o_orderkey"], cols=["o_orderkey", "o_totalprice"])


def reports_from_views(spark, sf):
    """SQL text over registered views of the stored gold tables."""
    store = _layers(spark, sf)
    store.register_views("gold", [table for table, *_ in REPORTS])
    parts = []
    for table, key, measure, limit in REPORTS:
        text = report_sql(table, key, measure, limit).replace("{", "").replace("}", "")
        rows = run_report(spark, text)
        parts.append(rows.select(F.lit(table).alias("report"), F.col(key).cast("string").alias("key"), F.col(measure).cast("double").alias("value")))
    return reduce(DataFrame.unionByName, parts)


#: Rows of a raw file of the shop at most.
RAW_FILE_ROWS = 500_000


def _raw_shop(spark, sf) -> str:
    """The nine raw files with all their columns, written as CSV from the mapped tables.

    Review texts hold line breaks, doubled quotes and commas, as the real ones do.
    """
    t = bronze_tables(spark, sf)
    score = F.col("review_score").cast("string")
    message = F.concat(F.lit('Order "'), F.col("order_id").cast("string"), F.lit('", score '), score, F.lit("\nline two\n\n"), score)
    place = t["customers"].select(
        F.col("customer_zip_code_prefix").alias("geolocation_zip_code_prefix"),
        F.col("customer_city").alias("geolocation_city"),
        F.col("customer_state").alias("geolocation_state"),
        (F.col("customer_id") % 90).cast("double").alias("geolocation_lat"),
    )
    frames = {BRONZE_TABLES[name]: df for name, df in t.items()} | {"olist_geolocation_dataset": place}
    reviews = BRONZE_TABLES["reviews"]
    frames[reviews] = t["reviews"].withColumn("review_comment_message", F.when(F.col("review_score") != 3, message))
    root = scratch_path(spark, "raw-shop")
    for name, schema in RAW_FILES.items():
        df = frames[name]
        cols = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
        raw = df.select(*cols).write.option("header", True).option("escape", '"')
        # a compressed file is read by one task, so files stay small
        raw.option("compression", "gzip").option("maxRecordsPerFile", RAW_FILE_ROWS).csv(f"{root}/{name}.csv")
    return root


#: A numeric expression over each raw table whose sum stands for its contents.
RAW_CHECKS = {
    "olist_orders_dataset": "length(order_status)",
    "olist_customers_dataset": "customer_zip_code_prefix",
    "olist_geolocation_dataset": "geolocation_lat",
    "olist_order_reviews_dataset": "review_score",
    "olist_order_payments_dataset": "payment_value",
    "olist_order_items_dataset": "price + freight_value",
    "olist_sellers_dataset": "seller_zip_code_prefix",
    "product_category_name_translation": "length(product_category_name_english)",
    "olist_products_dataset": "product_weight_g",
}


def _from_raw(spark, sf) -> LayerStore:
    store = LayerStore(spark, scratch_path(spark, "shop"))
    medallion.build_bronze(spark, _raw_shop(spark, sf), store, rejects="rejected")
    return store


def bronze_from_raw(spark, sf):
    """U4: the bronze stage over nine raw CSV files: rows and checksum of each table, and of what was set aside (nothing)."""
    store = _from_raw(spark, sf)
    tables = {name: store.read("bronze", name).withColumn("check", F.expr(c)) for name, c in RAW_CHECKS.items()}
    return _summary({name: (df, "check") for name, df in tables.items()})


def reviews_from_raw(spark, sf):
    """Every review as it comes out of a CSV file with line breaks and doubled quotes in its fields."""
    reviews = _from_raw(spark, sf).read("bronze", BRONZE_TABLES["reviews"])
    return reviews.select("review_id", "order_id", "review_score", "review_comment_message")


def reports_from_raw(spark, sf):
    """U4: raw CSV files -> bronze -> silver -> gold on disk -> the reports."""
    store = _from_raw(spark, sf)
    medallion.build_silver(store)
    medallion.build_gold(store, exact_scale=CENTS)
    measures = {"top_categories": REPORTS[0], "slowest_sellers": REPORTS[1], "orders_by_state": REPORTS[2]}
    parts = [
        df.select(F.lit(table).alias("report"), F.col(key).alias("key"), F.col(measure).cast("double").alias("value"))
        for name, df in medallion.build_reports(spark, store).items()
        for table, key, measure, _ in [measures[name]]
    ]
    return reduce(DataFrame.unionByName, parts)


QUERIES: dict[str, Query] = {
    "category_sales": category_sales,
    "category_sales_top10": category_sales_top10,
    "part_name_sales_top10": part_name_sales_top10,
    "order_installments": order_installments,
    "delivered_orders": delivered_orders,
    "orders_per_state": orders_per_state,
    "orders_by_state_ranked": orders_by_state_ranked,
    "seller_mean_delivery": seller_mean_delivery,
    "slowest_sellers_top10": slowest_sellers_top10,
    "overall_mean_delivery": overall_mean_delivery,
    "customer_running_sales": customer_running_sales,
    "category_rolling_delivery": category_rolling_delivery,
    "category_rolling_delivery_by_key": category_rolling_delivery_by_key,
    "customer_running_sales_staged": customer_running_sales_staged,
    "orders_enriched": orders_enriched,
    "orders_enriched_one_review": orders_enriched_one_review,
    "items_enriched": items_enriched,
    "item_amounts": item_amounts,
    "dedupe_copies": dedupe_copies,
    "clean_items": clean_items,
    "seller_order_pairs": seller_order_pairs,
    "csv_roundtrip": csv_roundtrip,
    "layer_roundtrip": layer_roundtrip,
    "append_mode": append_mode,
    "self_overwrite": self_overwrite,
    "gold_build": gold_build,
    "gold_stage": gold_stage,
    "hot_key_running_quantity": hot_key_running_quantity,
    "flag_tax_share": flag_tax_share,
    "flag_tax_share_exact": flag_tax_share_exact,
    "csv_ingest_declared": csv_ingest_declared,
    "csv_ingest_inferred": csv_ingest_inferred,
    "csv_flow_saved": csv_flow_saved,
    "csv_flow_counts": csv_flow_counts,
    "named_steps": named_steps,
    "table_counts": table_counts,
    "bronze_incremental": bronze_incremental,
    "interrupted_overwrite": interrupted_overwrite,
    "write_modes": write_modes,
    "csv_rejects": csv_rejects,
    "csv_reject_counts": csv_reject_counts,
    "csv_inferred_late": csv_inferred_late,
    "csv_missing_input": csv_missing_input,
    "flow_limited_counts": flow_limited_counts,
    "clean_hot_payments": clean_hot_payments,
    "report_positions": report_positions,
    "orders_by_price_positions": orders_by_price_positions,
    "reports_from_views": reports_from_views,
    "bronze_from_raw": bronze_from_raw,
    "reviews_from_raw": reviews_from_raw,
    "reports_from_raw": reports_from_raw,
}
