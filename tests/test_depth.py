"""Interrupted overwrites, one-pass step counts, malformed and inferred CSV, hot cleaning keys, global order."""

import os
import random
import statistics
from concurrent.futures import ThreadPoolExecutor

import pytest
from conftest import rows
from pyspark.sql import functions as F

from strata.functions import exact_sum
from strata.operators.quality import clean, even_keys
from strata.operators.reports import numbered
from strata.operators.windows import _SAMPLE_CONF, PIECE, running_total, stage_pieces
from strata.plans import flow as flow_module
from strata.plans.flow import Flow
from strata.session import DEFAULT_CONF, session_conf, table_format_conf
from strata.sources.csv import RAW_ROW, ingest_all, ingest_inferred, read_csv, split_rows
from strata.sources.store import LayerStore

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------ interrupted overwrite
def interrupted(spark, root, lost=False, table="t"):
    """A store whose overwrite of 2 rows by 5 stopped after the first rename."""
    store = LayerStore(spark, f"{root}/lake")
    store.write(spark.range(2), "gold", table)
    staged, n = store.stage(spark.range(5), "gold", table)
    assert n == 5 and store.set_aside(staged, store.path("gold", table)) == f"{staged}_old"
    if lost:
        store.discard(staged)
    assert not os.path.exists(store.path("gold", table))
    return LayerStore(spark, f"{root}/lake"), staged


@pytest.mark.parametrize("lost, found", [(False, 5), (True, 2)])
@pytest.mark.parametrize("way", ["read", "exists", "schema", "settle"])
def test_next_access_settles(spark, tmp_root, lost, found, way):
    store, _ = interrupted(spark, tmp_root, lost)
    assert getattr(store, way)("gold", "t")
    assert store.read("gold", "t").count() == found
    assert os.listdir(f"{tmp_root}/lake/gold") == ["t"]


@pytest.mark.parametrize("mode, lost, found", [("append", False, 6), ("append", True, 3), ("overwrite", False, 1), ("ignore", True, 2)])
def test_next_write_settles_first(spark, tmp_root, mode, lost, found):
    store, _ = interrupted(spark, tmp_root, lost)
    store.write(spark.range(1), "gold", "t", mode=mode)
    assert store.read("gold", "t").count() == found


def test_an_old_version_beside_its_table_is_deleted(spark, tmp_root):
    store, staged = interrupted(spark, tmp_root)
    os.rename(staged, store.path("gold", "t"))  # the process died before it deleted the old version
    assert store.settle("gold", "t") == "cleaned"
    assert os.listdir(f"{tmp_root}/lake/gold") == ["t"] and store.read("gold", "t").count() == 5


def test_settling_keeps_to_its_own_table(spark, tmp_root):
    store, _ = interrupted(spark, tmp_root, table="t_b")
    assert not store.exists("gold", "t") and store.settle("gold", "t") is None
    assert store.read("gold", "t_b").count() == 5


def test_a_reader_may_complete_the_swap_of_a_running_writer(spark, tmp_root, monkeypatch):
    store = LayerStore(spark, f"{tmp_root}/lake")
    store.write(spark.range(2), "gold", "t")
    set_aside = LayerStore.set_aside

    def and_a_reader_comes(self, staged, target):
        out = set_aside(self, staged, target)
        assert LayerStore(spark, self.root).read("gold", "t").count() == 5
        return out

    monkeypatch.setattr(LayerStore, "set_aside", and_a_reader_comes)
    assert store.write(spark.range(5), "gold", "t") == 5
    assert store.read("gold", "t").count() == 5 and os.listdir(f"{tmp_root}/lake/gold") == ["t"]


def test_clean_staging_takes_old_folders_only(spark, tmp_root):
    store = LayerStore(spark, f"{tmp_root}/lake")
    store.write(spark.range(2), "gold", "t")
    staged, _ = store.stage(spark.range(3), "gold", "t")  # its writer never came back
    assert store.clean_staging("gold", "t") == 0 and os.path.exists(staged)
    assert store.clean_staging("gold", "t", older_than_hours=0) == 1 and not os.path.exists(staged)
    assert store.read("gold", "t").count() == 2


# ------------------------------------------------------------------ step counts
STEPS = [
    ("even", lambda d: d.filter("id % 2 = 0")),
    ("keys", lambda d: d.withColumn("k", F.col("id") % 10)),
    ("one a key", lambda d: d.dropDuplicates(["k"])),
    ("dealt", lambda d: d.repartition(3)),
]


def test_steps_that_read_all_take_one_pass(spark, tmp_root):
    spark.range(1000).write.csv(f"{tmp_root}/ids.csv")
    flow = Flow(spark, tmp_root, LayerStore(spark, f"{tmp_root}/l"))
    flow.apply(flow.read_csv("ids.csv", header=False, schema="id long"), STEPS)
    ((names, frame),) = flow.passes()
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert len(names) == 5 and plan.count("Relation [id") == 1 and plan.count("CollectMetrics") == 5
    assert flow.counts() == [("input", 1000), ("even", 500), ("keys", 500), ("one a key", 5), ("dealt", 5)]
    assert rows(flow.step_counts(), "step", "rows") == [(0, 1000), (1, 500), (2, 500), (3, 5), (4, 5)]


def test_a_step_that_stops_early_starts_another_pass(spark, tmp_root):
    flow = Flow(spark, tmp_root, LayerStore(spark, f"{tmp_root}/l"))
    other = spark.range(3)
    flow.apply(
        spark.range(100_000),
        [("even", lambda d: d.filter("id % 2 = 0")), ("few", lambda d: d.limit(7)), ("same", lambda d: d), ("met", lambda d: d.join(other, "id"))],
    )
    assert [len(names) for names, _ in flow.passes()] == [2, 2, 1]
    assert [n for _, n in flow.counts()][:4] == [100_000, 50_000, 7, 7]


def test_a_sort_samples_its_input_and_starts_another_pass(spark, tmp_root):
    flow = Flow(spark, tmp_root, LayerStore(spark, f"{tmp_root}/l"))
    flow.apply(spark.range(1000), [*STEPS, ("sorted", lambda d: d.orderBy("id")), ("ranges", lambda d: d.repartitionByRange(3, "id"))])
    assert [len(names) for names, _ in flow.passes()] == [5, 1, 1]
    assert flow.counts() == [("input", 1000), ("even", 500), ("keys", 500), ("one a key", 5), ("dealt", 5), ("sorted", 5), ("ranges", 5)]


def test_a_step_that_leaves_nothing_counts_zero(spark, tmp_root):
    flow = Flow(spark, tmp_root, LayerStore(spark, f"{tmp_root}/l"))
    flow.apply(spark.read.parquet(f"{SF}/orders.parquet"), [("none", lambda d: d.filter(F.lit(False))), ("still none", lambda d: d.dropDuplicates())])
    n = spark.read.parquet(f"{SF}/orders.parquet").count()
    assert flow.counts() == [("input", n), ("none", 0), ("still none", 0)]


def test_uncertain_observations_are_counted_again(spark, tmp_root, monkeypatch):
    flow = Flow(spark, tmp_root, LayerStore(spark, f"{tmp_root}/l"))
    flow.apply(spark.range(1000), STEPS)
    monkeypatch.setattr(flow_module, "_observed", lambda spark, names, frame: [None] * len(names))
    assert flow.counts() == [("input", 1000), ("even", 500), ("keys", 500), ("one a key", 5), ("dealt", 5)]


def test_counting_leaves_the_job_group_alone(spark, tmp_root):
    flow = Flow(spark, tmp_root, LayerStore(spark, f"{tmp_root}/l"))
    flow.apply(spark.range(10), STEPS[:1])
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", "mine")
    try:
        assert flow.counts() == [("input", 10), ("even", 5)]
        assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") == "mine"
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


# ------------------------------------------------------------ malformed rows
def raw_file(root, name, text):
    with open(f"{root}/{name}", "w", newline="") as f:
        f.write(text)


def test_broken_rows_go_to_a_side_table(spark, tmp_root):
    raw_file(tmp_root, "a.csv", 'id,price,note\n1,1.5,x\n2,abc,y\n3,2.5\n4,3.5,z,more\n5,,"two\nlines"\n')
    raw_file(tmp_root, "b.csv", "id\n1\n2\n")
    store = LayerStore(spark, f"{tmp_root}/lake")
    schemas = {"a": "id int, price double, note string", "b": "id int"}
    options = {"a": {"multi_line": True}}
    counts = ingest_all(spark, tmp_root, ["a.csv", "b.csv"], store, schemas=schemas, csv_options=options, rejects="rejected")
    assert counts == {"a": 2, "b": 2, "rejected/a": 3, "rejected/b": 0}
    assert rows(store.read("bronze", "a")) == [(1, 1.5, "x"), (5, None, "two\nlines")]
    bad = store.read("rejected", "a")
    assert [(r.id, r.raw_row.strip()) for r in bad.orderBy("id").collect()] == [(2, "2,abc,y"), (3, "3,2.5"), (4, "4,3.5,z,more")]
    assert all(r.source_file.endswith("a.csv") for r in bad.collect()) and not store.exists("rejected", "b")
    # the file is mended: the side table of the next run is empty
    raw_file(tmp_root, "a.csv", "id,price,note\n1,1.5,x\n")
    assert ingest_all(spark, tmp_root, ["a.csv"], store, schemas=schemas, rejects="rejected") == {"a": 1, "rejected/a": 0}
    assert store.read("rejected", "a").count() == 0


def test_verdict_does_not_depend_on_the_columns_read(spark, tmp_root):
    raw_file(tmp_root, "a.csv", "id,price\n1,1.5\n2,abc\n")
    good, bad = split_rows(read_csv(spark, f"{tmp_root}/a.csv", schema="id int, price double", raw_row=RAW_ROW))
    assert [r.id for r in good.select("id").collect()] == [1] and [r.id for r in bad.select("id").collect()] == [2]
    with pytest.raises(ValueError):
        read_csv(spark, f"{tmp_root}/a.csv", infer=True, raw_row=RAW_ROW)


# ------------------------------------------------------------ inferred types
LATE = {  # column values in which the last row alone decides the type
    "number or text": ["7"] * 5000 + ["seven"],
    "whole or not": ["7"] * 5000 + ["7.5"],
    "int or long": ["7"] * 5000 + ["7000000000"],
    "date or time": ["2024-01-02"] * 5000 + ["2024-01-02 03:04:05"],
    "nothing or number": [""] * 5000 + ["7"],
    "always text": ["no number"] * 5001,
    "always number": ["7"] * 5001,
    "always date": ["2024-01-02"] * 5001,
    "always empty": [""] * 5001,
}


@pytest.mark.parametrize("case", LATE)
def test_inference_from_a_share_equals_inference_from_all(spark, tmp_root, case):
    raw_file(tmp_root, "a.csv", "id,v\n" + "".join(f"{k},{v}\n" for k, v in enumerate(LATE[case])))
    store = LayerStore(spark, f"{tmp_root}/lake")
    assert ingest_inferred(spark, f"{tmp_root}/a.csv", store, "bronze", "a") == 5001
    every = read_csv(spark, f"{tmp_root}/a.csv", infer=True)
    got = store.read("bronze", "a")
    assert got.dtypes == every.dtypes and got.exceptAll(every).isEmpty() and every.exceptAll(got).isEmpty()
    assert os.listdir(f"{tmp_root}/lake/bronze") == ["a"]


def test_inferred_modes_and_schema_guard(spark, tmp_root):
    raw_file(tmp_root, "a.csv", "id\n1\n2\n")
    store = LayerStore(spark, f"{tmp_root}/lake")
    assert ingest_inferred(spark, f"{tmp_root}/a.csv", store, "bronze", "a") == 2
    assert ingest_inferred(spark, f"{tmp_root}/a.csv", store, "bronze", "a", mode="append") == 2
    assert store.read("bronze", "a").count() == 4
    raw_file(tmp_root, "a.csv", "id,more\n1,x\n")
    with pytest.raises(ValueError):
        ingest_inferred(spark, f"{tmp_root}/a.csv", store, "bronze", "a")
    with pytest.raises(FileNotFoundError):
        ingest_all(spark, tmp_root, ["a.csv", "missing.csv"], store)


# --------------------------------------------------------------- hot keys
def test_a_hot_key_is_cleaned_in_even_tasks(spark):
    from strata.plans.queries import _hot_payments, cleaned_hot_payments

    assert _hot_payments(spark, SF).groupBy().agg(F.avg((F.col("order_id") == 0).cast("int"))).first()[0] > 0.3
    sizes = [r["count"] for r in cleaned_hot_payments(spark, SF).groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) <= 2 * statistics.median(sizes)


def test_keys_are_chosen_by_their_counts(spark):
    even, hot = spark.range(1000).withColumnRenamed("id", "k"), spark.range(1000).select((F.col("id") % 3).alias("k"))
    keys = even_keys({"even": even, "hot": hot}, {"even": ["k"], "hot": ["k"], "absent": ["k"]}, 100)
    assert keys == {"even": ["k"]}
    assert clean(hot, ["k"], keys.get("hot", ())).count() == 3


# ------------------------------------------------------------------ order
@pytest.mark.parametrize("partitions", [1, 7])
def test_numbered_is_the_row_number_of_the_whole_order(spark, partitions):
    rnd = random.Random(4)
    data = [(k, rnd.choice([None, *range(20)])) for k in range(500)]
    df = spark.createDataFrame(data, "k int, v int")
    for descending in (True, False):
        got = {r.k: r.position for r in numbered(df, "v", descending, ["k"], partitions=partitions).collect()}
        key = (lambda r: (r[1] is None, -(r[1] or 0), r[0])) if descending else (lambda r: (r[1] is not None, r[1] or 0, r[0]))
        assert got == {r[0]: i + 1 for i, r in enumerate(sorted(data, key=key))}
    assert numbered(df.limit(0), "v").collect() == []


def test_numbered_plans_no_window_over_rows(spark):
    out = numbered(spark.range(1000).withColumn("v", F.col("id") % 10), "v", tie_break=["id"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    (window,) = [line for line in plan.split("\n") if " Window [" in line]
    assert "__range" in window and "id" not in window.split("windowspecdefinition")[0].replace("__id", "")


# ----------------------------------------------------- exact sums and pieces
def test_amounts_off_the_grid_raise(spark):
    off = spark.createDataFrame([(1e10 + 0.004,)] * 3, "v double")
    with pytest.raises(Exception, match="decimal places"):
        off.agg(exact_sum("v", 2)).collect()
    noisy = spark.createDataFrame([(10.1 + 0.2,), (0.1 + 0.2,), (1e10 + 0.01,), (1000.1 - 1000,)], "v double")
    assert noisy.agg(exact_sum("v", 2)).first()[0] == 10000000010.71


def test_two_windows_are_staged_at_once(spark, tmp_root):
    df = spark.range(20_000).select((F.col("id") % 2).alias("k"), F.col("id").alias("t"), F.lit(1.0).alias("v"))
    df.write.parquet(f"{tmp_root}/rows")
    stored, before = spark.read.parquet(f"{tmp_root}/rows"), spark.conf.get(_SAMPLE_CONF)
    seen = []

    def stage(n):
        out = stage_pieces(stored, ["k"], ["t"], f"{tmp_root}/pieces{n}", 500 + 500 * n)
        seen.append(spark.conf.get(_SAMPLE_CONF))
        return out

    with ThreadPoolExecutor(4) as pool:
        staged = list(pool.map(stage, range(4)))
    assert set(seen) == {before} and spark.conf.get(_SAMPLE_CONF) == before
    for out in staged:
        assert out.select(PIECE).distinct().count() > 5
        totals = running_total(out, ["k"], ["t"], "v", "s", chunk=PIECE)
        assert totals.filter(F.col("s") != F.floor(F.col("t") / 2) + 1).isEmpty() and totals.count() == 20_000
    assert not [t for t in spark.catalog.listTables("global_temp") if t.name.startswith("strata_")]


# ---------------------------------------------------------------- session
def test_table_format_settings():
    conf = session_conf(table_format="delta", extra_conf={"spark.sql.extensions": "my.Extension", "a": "b"}, shuffle_partitions=7)
    assert conf["spark.sql.extensions"] == "io.delta.sql.DeltaSparkSessionExtension,my.Extension"
    assert conf["spark.sql.catalog.spark_catalog"] == "org.apache.spark.sql.delta.catalog.DeltaCatalog"
    assert conf["a"] == "b" and conf["spark.sql.shuffle.partitions"] == "7"
    assert "spark.jars.packages" not in conf
    assert table_format_conf("delta", packages="g:a:1")["spark.jars.packages"] == "g:a:1"
    assert session_conf() == DEFAULT_CONF
    with pytest.raises(ValueError):
        table_format_conf("unknown")


# -------------------------------------------------------------- streaming
def test_batches_are_counted_beyond_the_kept_progress(spark, tmp_root):
    from strata.streaming.ingest import ingest_incremental

    os.makedirs(f"{tmp_root}/in")
    for k in range(9):
        raw_file(f"{tmp_root}/in", f"{k}.csv", f"{k}\n")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "4")
    try:
        n = ingest_incremental(spark, f"{tmp_root}/in", spark.range(0).schema, f"{tmp_root}/out", max_files_per_trigger=1)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert n == 9 and spark.read.parquet(f"{tmp_root}/out").count() == 9
