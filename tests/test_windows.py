"""Chunked windows against the single-window form and a Python brute force."""

import datetime as dt
import uuid
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators.windows import PIECE, hottest_key, rolling_mean, running_total, stage_pieces

BASE = dt.datetime(2021, 3, 1)
SCHEMA = "id int, k string, ts timestamp, v int"


def _frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def _brute(data, rows_back=None):
    """Expected running sum (rows_back None) or trailing mean per id."""
    groups = defaultdict(list)
    for r in data:
        groups[r[1]].append(r)
    out = {}
    for g in groups.values():
        g.sort(key=lambda r: ((r[2] is not None), r[2] or BASE, r[0]))  # NULL ts first, then id
        for i, r in enumerate(g):
            lo = 0 if rows_back is None else max(0, i - rows_back)
            vals = [x[3] for x in g[lo:i + 1] if x[3] is not None]
            if rows_back is None:
                out[r[0]] = sum(vals) if vals else None
            else:
                out[r[0]] = sum(vals) / len(vals) if vals else None
    return out


def _collect(df, col):
    return {r["id"]: r[col] for r in df.select("id", col).collect()}


rows_st = st.lists(
    st.tuples(
        st.sampled_from(["hot", "hot", "hot", "b", "c", None]),
        st.one_of(st.none(), st.integers(0, 20)),  # day offset (NULL ts allowed)
        st.integers(0, 23),
        st.one_of(st.none(), st.integers(-5, 50)),
    ),
    min_size=1,
    max_size=60,
)


def _data(raw):
    return [
        (i, k, None if d is None else BASE + dt.timedelta(days=d, hours=h), v)
        for i, (k, d, h, v) in enumerate(raw)
    ]


def _day(name="ts"):
    return F.unix_date(F.col(name).cast("date"))


def _pieces(df, order, root, piece_rows):
    return stage_pieces(df, ["k"], order, f"{root}/{uuid.uuid4().hex}", piece_rows)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(raw=rows_st)
def test_running_total_matches_brute_force(spark, tmp_root, raw):
    data = _data(raw)
    df = _frame(spark, data)
    expect = _brute(data)
    staged = _pieces(df, ["ts", "id"], tmp_root, 4)
    for name, frame, chunk in (("single", df, None), ("day", df, _day()), ("pieces", staged, PIECE)):
        got = _collect(running_total(frame, ["k"], ["ts", "id"], "v", "run", chunk=chunk), "run")
        assert got == expect, name


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(raw=rows_st, back=st.integers(0, 4))
def test_rolling_mean_matches_brute_force(spark, tmp_root, raw, back):
    data = _data(raw)
    df = _frame(spark, data)
    expect = _brute(data, rows_back=back)
    staged = _pieces(df, ["ts", "id"], tmp_root, 3)
    for name, frame, chunk in (("single", df, None), ("day", df, _day()), ("pieces", staged, PIECE)):
        got = _collect(rolling_mean(frame, ["k"], ["ts", "id"], "v", "avg3", rows=back + 1, chunk=chunk), "avg3")
        assert got.keys() == expect.keys()
        for i in expect:
            assert (got[i] is None and expect[i] is None) or got[i] == pytest.approx(expect[i]), (name, i)


def test_exact_running_money_sum(spark):
    data = [(i, "c", BASE + dt.timedelta(days=i % 3), 0.1) for i in range(30)]
    df = spark.createDataFrame(data, "id int, k string, ts timestamp, v double")
    for chunk in (None, _day()):
        out = running_total(df, ["k"], ["ts", "id"], "v", "run", exact_scale=2, chunk=chunk)
        assert dict(out.dtypes)["run"] == "double"
        assert max(r["run"] for r in out.collect()) == 3.0  # 30 x 0.1 without binary noise


def test_custom_chunk_column(spark):
    data = _data([("hot", d % 7, 0, d) for d in range(40)])
    df = _frame(spark, data)
    got = _collect(running_total(df, ["k"], ["ts", "id"], "v", "run", chunk=F.dayofmonth("ts")), "run")
    assert got == _brute(data)


def test_single_window_exchange_for_big_side(spark, tmp_root):
    """The large input is shuffled once: the exchange under the local window is reused."""
    path = f"{tmp_root}/w"
    _frame(spark, _data([("hot", d % 9, d % 24, d) for d in range(200)])).write.parquet(path)
    out = running_total(spark.read.parquet(path), ["k"], ["ts", "id"], "v", "run", chunk=_day())
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = plan.splitlines()
    join = next(i for i, line in enumerate(lines) if "Join" in line)
    window = next(i for i, line in enumerate(lines) if "Window" in line and i > join)
    # the windowed rows go straight into the carry join: no second exchange of the big side
    assert not any("Exchange" in line for line in lines[join + 1 : window])


def _jobs(spark):
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(None) or [])


def test_planning_starts_no_job(spark):
    """Building window, KPI and gold plans over lazy frames runs nothing."""
    from strata.plans import mapped, medallion

    bronze = mapped.bronze_tables(spark, "/root/testdata/sf0.001")
    before = _jobs(spark)
    silver = medallion.silver_tables(bronze)
    tables = medallion.gold_tables(silver["orders_enriched"], silver["order_items_enriched"])
    assert list(tables) == list(medallion.GOLD_TABLES)
    assert list(medallion.gold_tables(silver["orders_enriched"], silver["order_items_enriched"], ["kpi_orders_per_state"])) == ["kpi_orders_per_state"]
    assert _jobs(spark) == before


def test_hot_key_with_few_distinct_tuples(spark, tmp_root):
    """300,000 rows of one key with 12 distinct (day, value) tuples: found hot, cut as far as the ordering allows."""
    df = spark.range(300_000).select(F.lit("hot").alias("k"), (F.col("id") % 12).alias("day"), F.lit(1).alias("v"))
    assert hottest_key(df, ["k"]) == 300_000
    staged = stage_pieces(df, ["k"], ["day"], f"{tmp_root}/few", 20_000)
    sizes = {r[PIECE]: r["n"] for r in staged.groupBy(PIECE).agg(F.count("*").alias("n")).collect()}
    assert len(sizes) >= 10 and max(sizes.values()) <= 50_000
    assert staged.groupBy("day").agg(F.countDistinct(PIECE).alias("n")).agg(F.max("n")).first()[0] == 1
    out = running_total(staged, ["k"], ["day"], "v", "run", chunk=PIECE)
    assert out.agg(F.max("run")).first()[0] == 300_000 and out.select("run").distinct().count() == 300_000


def test_pieces_are_even_along_the_ordering(spark, tmp_root):
    df = spark.range(300_000).select(F.lit("hot").alias("k"), (F.col("id") % 50).alias("stamp"), "id")
    staged = stage_pieces(df, ["k"], ["stamp", "id"], f"{tmp_root}/even", 18_750)
    parts = staged.groupBy(PIECE).agg(F.count("*").alias("n"), F.min("stamp").alias("lo"), F.max("stamp").alias("hi")).orderBy(PIECE).collect()
    assert len(parts) == 16 and max(p["n"] for p in parts) < 2 * 18_750
    assert all(a["hi"] <= b["lo"] for a, b in zip(parts, parts[1:], strict=False))


def test_many_small_pieces_need_few_ranges(spark, tmp_root):
    """3,000 pieces are cut within 512 ranges: few files and tasks, pieces still small, in order and never through ties."""
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 != 0, "hot").alias("k"), (F.col("id") % 20_011).cast("double").alias("stamp"), F.lit(1).alias("v")
    )
    staged = stage_pieces(df, ["k"], ["stamp"], f"{tmp_root}/small", 20)
    assert len(staged.inputFiles()) <= 512
    parts = staged.groupBy(PIECE).agg(F.count("*").alias("n"), F.min(F.struct("k", "stamp")).alias("lo"), F.max(F.struct("k", "stamp")).alias("hi"))
    parts = parts.orderBy(PIECE).collect()
    assert len(parts) >= 2_000 and max(p["n"] for p in parts) <= 40
    bounds = [((k is not None, k or "", s)) for p in parts for k, s in (p["lo"], p["hi"])]
    assert bounds == sorted(bounds)
    assert staged.groupBy("k", "stamp").agg(F.countDistinct(PIECE).alias("n")).agg(F.max("n")).first()[0] == 1
    cols = ["k", "stamp", "w"]
    for fn in (running_total, rolling_mean):
        cut, single = (fn(f, ["k"], ["stamp"], "v", "w", chunk=c).select(*cols) for f, c in ((staged, PIECE), (df, None)))
        assert cut.exceptAll(single).count() == 0 == single.exceptAll(cut).count()


def test_pieces_on_test_tables_match_single_window(spark, tmp_root):
    """Gold windows over the mapped sf0.001 tables, every key cut."""
    from strata.plans import mapped, medallion

    silver = medallion.silver_tables(mapped.bronze_tables(spark, "/root/testdata/sf0.001"))
    stored, _ = medallion.stage_window_input(silver["orders_enriched"], silver["order_items_enriched"])
    for keys, order, fn, kw in (
        (["customer_id"], medallion.RUNNING_ORDER, running_total, {"value": "total_price", "out": "w", "exact_scale": 2}),
        (["product_category_name"], medallion.ROLLING_ORDER, rolling_mean, {"value": "delivery_time_days", "out": "w", "rows": 3}),
    ):
        frame, chunk, path = medallion.stage_for_window(stored, keys, order, 20)
        assert chunk == PIECE and path
        cols = [*keys, *order, "w"]
        cut, single = fn(frame, keys, order, chunk=chunk, **kw), fn(stored, keys, order, **kw)
        assert sorted(map(tuple, cut.select(*cols).collect()), key=str) == sorted(map(tuple, single.select(*cols).collect()), key=str)


def test_hot_category_of_the_rolling_mean_is_cut(spark):
    """NULL, the items without a category, holds half of the rows: with piece_rows no task gets it whole."""
    from strata.plans import mapped, medallion

    s = medallion.silver_tables(mapped.bronze_tables(spark, "/root/testdata/sf0.001"))
    plain = medallion.rolling_avg_delivery_per_category(s["orders_enriched"], s["order_items_enriched"])
    cut = medallion.rolling_avg_delivery_per_category(s["orders_enriched"], s["order_items_enriched"], piece_rows=100, spark=spark)
    assert PIECE in cut._jdf.queryExecution().analyzed().toString()
    assert cut.sparkSession is spark and cut.schema == plain.schema
    assert cut.exceptAll(plain).count() == 0 == plain.exceptAll(cut).count()


@pytest.mark.parametrize("op", ["running", "rolling"])
def test_default_window_is_one_exchange(spark, tmp_root, op):
    """One hash exchange on the key, then the window."""
    path = f"{tmp_root}/even"
    _frame(spark, _data([(k, d % 9, d % 24, d) for d in range(100) for k in "abcdefgh"])).write.parquet(path)
    df = spark.read.parquet(path)
    if op == "running":
        out = running_total(df, ["k"], ["ts", "id"], "v", "run")
    else:
        out = rolling_mean(df, ["k"], ["ts", "id"], "v", "avg", rows=3)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(exchanges) == 1 and "hashpartitioning(k#" in exchanges[0]
    assert "ReadSchema: struct<id:int,k:string,ts:timestamp,v:int>" in plan
