import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from strata.plans.flow import Flow
from strata.schemas import REVIEWS, TRANSLATIONS
from strata.sources.csv import ingest_all, read_csv, table_name_for
from strata.sources.store import LayerStore, row_counts

REVIEW_CSV = (
    "﻿review_id,order_id,review_score,review_comment_title,review_comment_message,"
    "review_creation_date,review_answer_timestamp\r\n"
    'r1,o1,5,,"great\r\n\r\nreally ""great""",2018-01-18 00:00:00,2018-01-18 21:46:59\r\n'
    "r2,o2,4,title,,2018-03-10 00:00:00,2018-03-11 03:05:13\r\n"
    'r3,o3,1,,"line one\nline two",2018-02-17 00:00:00,2018-02-18 14:36:24'
)


@pytest.fixture
def raw_dir(tmp_root):
    d = os.path.join(tmp_root, "raw")
    os.makedirs(d)
    with open(os.path.join(d, "olist_order_reviews_dataset.csv"), "w", newline="") as f:
        f.write(REVIEW_CSV)
    with open(os.path.join(d, "product_category_name_translation.csv"), "w", newline="") as f:
        f.write("﻿product_category_name,product_category_name_english\r\nbeleza_saude,health_beauty\r\n"
                "cama_mesa,bed_table")
    return d


def test_multiline_csv_needs_options(spark, raw_dir):
    path = os.path.join(raw_dir, "olist_order_reviews_dataset.csv")
    naive = read_csv(spark, path, infer=True)
    assert naive.count() > 3 and dict(naive.dtypes)["review_score"] == "string"
    good = read_csv(spark, path, schema=REVIEWS, multi_line=True, escape='"')
    assert good.count() == 3
    got = {r["review_id"]: r for r in good.collect()}
    assert got["r1"]["review_comment_message"].replace("\r", "") == 'great\n\nreally "great"'
    assert got["r2"]["review_comment_message"] is None
    assert got["r3"]["review_score"] == 1
    inferred = read_csv(spark, path, infer=True, multi_line=True, escape='"')
    assert dict(inferred.dtypes)["review_score"] == "int"
    assert inferred.columns[0] == "review_id"  # byte-order mark stripped


def test_missing_csv_raises_file_not_found(spark, tmp_root):
    with pytest.raises(FileNotFoundError):
        read_csv(spark, os.path.join(tmp_root, "nope.csv"))


def test_table_name_for():
    assert table_name_for("/data/raw/olist_orders_dataset.csv") == "olist_orders_dataset"
    assert table_name_for("olist_orders_dataset.csv", prefix="olist_") == "orders_dataset"


def test_ingest_all_counts_and_reads_back(spark, raw_dir, tmp_root):
    store = LayerStore(spark, os.path.join(tmp_root, "lake"))
    counts = ingest_all(
        spark, raw_dir, ["product_category_name_translation.csv", "olist_order_reviews_dataset.csv"], store,
        schemas={"product_category_name_translation": TRANSLATIONS, "olist_order_reviews_dataset": REVIEWS},
        csv_options={"olist_order_reviews_dataset": {"multi_line": True, "escape": '"'}},
    )
    assert counts == {"product_category_name_translation": 2, "olist_order_reviews_dataset": 3}
    back = store.read("bronze", "product_category_name_translation")
    assert rows(back) == [("beleza_saude", "health_beauty"), ("cama_mesa", "bed_table")]


def test_store_modes_and_schema_guard(spark, tmp_root):
    store = LayerStore(spark, os.path.join(tmp_root, "lake"))
    df = spark.range(5).withColumn("x", F.col("id") * 2)
    assert store.write(df, "silver", "t") == 5
    assert store.write(df, "silver", "t", mode="append") == 5
    assert store.read("silver", "t").count() == 10
    assert store.write(df, "silver", "t", mode="ignore") == 0
    with pytest.raises(FileExistsError):
        store.write(df, "silver", "t", mode="error")
    with pytest.raises(ValueError):
        store.write(df.select("id"), "silver", "t")  # narrower schema refused
    assert store.write(df.select("id"), "silver", "t", overwrite_schema=True) == 5
    assert store.read("silver", "t").columns == ["id"]
    assert store.exists("silver", "t") and not store.exists("silver", "nope")


def test_overwrite_from_own_input_is_safe(spark, tmp_root):
    store = LayerStore(spark, os.path.join(tmp_root, "lake"))
    store.write(spark.range(100), "gold", "t")
    current = store.read("gold", "t")
    assert store.write(current.filter("id % 2 = 0"), "gold", "t") == 50
    assert store.read("gold", "t").count() == 50


def test_failed_overwrite_keeps_old_table(spark, tmp_root):
    store = LayerStore(spark, os.path.join(tmp_root, "lake"))
    store.write(spark.range(100), "gold", "t")
    # the job itself fails half way (rows 50.. raise), after the old table exists
    check = F.coalesce(F.assert_true(F.col("id") < 50).cast("long"), F.lit(0))
    failing = spark.range(100).select((F.col("id") + check).alias("id"))
    with pytest.raises(Exception):
        store.write(failing, "gold", "t")
    assert store.read("gold", "t").count() == 100
    assert not [d for d in os.listdir(os.path.join(tmp_root, "lake", "gold")) if d.startswith("_staging")]


def test_row_counts_and_views(spark, tmp_root):
    store = LayerStore(spark, os.path.join(tmp_root, "lake"))
    store.write_all({"a": spark.range(3), "b": spark.range(7)}, "gold")
    views = store.register_views("gold", ["a", "b"])
    assert spark.sql("SELECT count(*) FROM b").first()[0] == 7
    assert dict(rows(row_counts(views))) == {"a": 3, "b": 7}


def test_flow_counts_every_step(spark, raw_dir, tmp_root):
    flow = Flow(spark, raw_dir, LayerStore(spark, os.path.join(tmp_root, "lake")))
    df = flow.read_csv("product_category_name_translation.csv", infer_schema=False)
    out = flow.apply(df, [
        ("upper", lambda d: d.withColumn("up", F.upper("product_category_name"))),
        ("only cama", lambda d: d.filter(F.col("up").startswith("CAMA"))),
    ])
    assert flow.save(out, "silver", "tr") == 1
    assert flow.counts() == [("input", 2), ("upper", 2), ("only cama", 1)]
    with pytest.raises(FileNotFoundError):
        flow.read_csv("missing.csv")


def test_shuffle_sizing():
    from strata.session import shuffle_partitions_for, sizing_conf

    assert shuffle_partitions_for(1) == 1
    assert shuffle_partitions_for(100 * 10**12) == -(-100 * 10**12 // (256 * 1024 * 1024))
    conf = sizing_conf(10 * 1024**3, target_bytes=128 * 1024**2)
    assert conf["spark.sql.shuffle.partitions"] == "80"
    assert conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "80"


def test_build_session_applies_defaults_and_sizing(spark):
    from strata.session import CHECKPOINT_CONF, build_session

    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
            "spark.sql.adaptive.enabled")
    saved = {k: spark.conf.get(k, None) for k in keys}
    try:
        s = build_session("strata-test", shuffle_bytes=3 * 256 * 1024 * 1024)
        assert s is spark  # an existing session is reused, not replaced
        assert s.conf.get("spark.sql.shuffle.partitions") == "3"
        assert s.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum") == "3"
        assert s.conf.get("spark.sql.adaptive.enabled") == "true"
        assert s.conf.get(CHECKPOINT_CONF)
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_reordered_header_raises_instead_of_swapping(spark, tmp_root):
    with open(f"{tmp_root}/r.csv", "w") as f:
        f.write("b,a\nB1,A1\n")
    df = read_csv(spark, f"{tmp_root}/r.csv", schema="a string, b string")
    with pytest.raises(Exception, match="(?i)header"):
        df.collect()
    with open(f"{tmp_root}/ok.csv", "w") as f:
        f.write("a,b\nA1,B1\n")
    assert read_csv(spark, f"{tmp_root}/ok.csv", schema="a string, b string").first()["a"] == "A1"


def test_step_counts_are_complete_and_keep_equal_names(spark, tmp_root):
    from strata.plans.flow import Flow

    flow = Flow(spark, tmp_root, LayerStore(spark, f"{tmp_root}/l"))
    out = flow.apply(spark.range(1_000_000).toDF("id"), [("f", lambda d: d.limit(5)), ("f", lambda d: d.filter("id >= 0"))])
    flow.save(out, "silver", "t")
    assert flow.counts() == [("input", 1_000_000), ("f", 5), ("f", 5)]


def test_damaged_table_can_be_replaced(spark, tmp_root):
    import os

    store = LayerStore(spark, f"{tmp_root}/d")
    os.makedirs(f"{tmp_root}/d/bronze/t")
    with open(f"{tmp_root}/d/bronze/t/part-0.parquet", "w") as f:
        f.write("not parquet")
    df = spark.range(3).toDF("id")
    with pytest.raises(OSError, match="overwrite_schema"):
        store.write(df, "bronze", "t")
    assert store.write(df, "bronze", "t", overwrite_schema=True) == 3
    assert store.read("bronze", "t").count() == 3


def test_failed_swap_keeps_the_old_table(spark, tmp_root):
    store = LayerStore(spark, f"{tmp_root}/s")
    store.write(spark.range(2).toDF("id"), "bronze", "t")
    with pytest.raises(Exception):
        store._swap_in(f"{tmp_root}/s/bronze/missing", store.path("bronze", "t"))
    assert store.read("bronze", "t").count() == 2


def test_sized_session_makes_more_tasks_of_a_larger_input(spark):
    """Shuffles of a sized session are wide and not merged into large tasks; the caller's settings stay."""
    from strata.session import own_session, sized_session

    advisory, width = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions"
    before = [spark.conf.get(k) for k in (advisory, width)]
    sized = sized_session(spark, 64 << 20, shuffle_bytes=1 << 20)
    assert [sized.conf.get(k) for k in (advisory, width)] == [str(1 << 20), "64"]
    plain, small = (s.range(2_000_000).groupBy(F.xxhash64("id").alias("k")).count().rdd.getNumPartitions() for s in (spark, sized))
    assert plain <= 8 and small >= 16
    fine = own_session(spark)
    fine.conf.set(advisory, "4k")
    fine.conf.set(width, "99")
    kept = sized_session(fine, 64 << 20, shuffle_bytes=1 << 20)
    assert [kept.conf.get(k) for k in (advisory, width)] == ["4096", "99"]
    assert [spark.conf.get(k) for k in (advisory, width)] == before


def test_stage_drivers_run_in_a_sized_session(spark, tmp_root, monkeypatch):
    from strata.plans import mapped, medallion

    store, seen = LayerStore(spark, tmp_root), []
    monkeypatch.setattr(LayerStore, "write_all", lambda self, tables, layer, f=LayerStore.write_all: seen.append((layer, self.spark is spark)) or f(self, tables, layer))
    bronze = mapped.bronze_tables(spark, "/root/testdata/sf0.001")
    store.write_all({medallion.BRONZE_TABLES[name]: df for name, df in bronze.items()}, "bronze")
    medallion.build_silver(store)
    medallion.build_gold(store, exact_scale=2)
    assert seen == [("bronze", True), ("silver", False), ("gold", False)]


def test_lookups_are_broadcast_by_their_rows_not_by_their_files(spark, tmp_root, monkeypatch):
    """A million products are a file of few MB and a hash table of 80 MB: items and products meet by shuffle."""
    from strata.plans import mapped, medallion

    store, plans = LayerStore(spark, tmp_root), {}
    bronze = mapped.bronze_tables(spark, "/root/testdata/sf0.001")
    columns = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in bronze["products"].schema} | {"product_id": F.col("id").alias("product_id")}
    bronze["products"] = spark.range(1_000_000).select(*columns.values())
    store.write_all({medallion.BRONZE_TABLES[name]: df for name, df in bronze.items()}, "bronze")

    def write_all(self, tables, layer):
        plans.update({name: df._jdf.queryExecution().executedPlan().toString() for name, df in tables.items()})

    monkeypatch.setattr(LayerStore, "write_all", write_all)
    medallion.build_silver(store)
    joins = [line for line in plans["order_items_enriched"].split("\n") if "Join" in line]
    assert [("SortMergeJoin" in x, "BroadcastHashJoin" in x) for x in joins if "product_id" in x] == [(True, False)]
    assert [("SortMergeJoin" in x, "BroadcastHashJoin" in x) for x in joins if "seller_id" in x] == [(False, True)]
    # hashed on the product to be cleaned, the items are not hashed on it again
    assert plans["order_items_enriched"].count("hashpartitioning(product_id") == 2


def test_sized_session_broadcasts_less_by_estimate_than_by_measure(spark):
    from strata.session import own_session, sized_session

    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    sized = sized_session(spark, 1 << 20)
    assert [int(sized.conf.get(k)) for k in keys] == [1 << 19, 4 << 20]
    for value, kept in (("-1", ["-1", "-1"]), ("256k", [str(256 << 10)] * 2)):
        asked = own_session(spark)
        asked.conf.set(keys[0], value)
        assert [sized_session(asked, 1 << 20).conf.get(k) for k in keys] == kept


def test_raw_shop_files_are_compressed_and_small(spark, monkeypatch):
    from strata.plans import queries

    monkeypatch.setattr(queries, "RAW_FILE_ROWS", 1000)
    root = queries._raw_shop(spark, "/root/testdata/sf0.001")
    items = spark.read.option("header", True).csv(f"{root}/olist_order_items_dataset.csv")
    n = queries.load(spark, "/root/testdata/sf0.001", "lineitem").count()
    assert items.count() == n and len(items.inputFiles()) >= n // 1000
    assert all(f.endswith(".csv.gz") for f in items.inputFiles())
