from conftest import rows

from strata.operators.enrich import can_broadcast, enrich_items, enrich_orders, loaded_bytes, lookup, total_installments


def facts(spark):
    return spark.createDataFrame(
        [(1, "a"), (2, "b"), (3, None), (4, "zz")], "fact_id int, k string"
    )


def dim(spark):
    # "b" repeats: the lookup fans out; "zz" is absent.
    return spark.createDataFrame([("a", 10), ("b", 20), ("b", 21), (None, 99)], "k string, v int")


def test_left_lookup_keeps_misses_and_fans_out(spark):
    out = lookup(facts(spark), dim(spark), "k")
    assert out.columns[0] == "k"  # USING form puts the key first
    assert rows(out, "fact_id", "v") == [(1, 10), (2, 20), (2, 21), (3, None), (4, None)]


def test_one_per_key_removes_fan_out(spark):
    out = lookup(facts(spark), dim(spark), "k", one_per_key={"v": "max"})
    assert rows(out, "fact_id", "v") == [(1, 10), (2, 21), (3, None), (4, None)]


def test_mapping_form_and_inner(spark):
    d = dim(spark).withColumnRenamed("k", "dim_k")
    out = lookup(facts(spark), d, {"k": "dim_k"}, how="inner")
    assert "dim_k" not in out.columns
    assert rows(out, "fact_id", "v") == [(1, 10), (2, 20), (2, 21)]


def test_cols_narrow_the_dimension(spark):
    d = dim(spark)
    d = d.withColumn("extra", d.v * 2)
    out = lookup(facts(spark), d, "k", cols=["v"])
    assert out.columns == ["k", "fact_id", "v"]


def test_broadcast_only_behind_size_check(spark):
    # a relation with statistics (range); Python-local rows have no size estimate
    small = spark.range(4).selectExpr("cast(id as string) as k", "cast(id as int) as v")
    assert not can_broadcast(dim(spark), 1 << 40)
    assert can_broadcast(small, 1 << 20)
    assert not can_broadcast(small, 1)
    plan = lookup(facts(spark), small, "k", broadcast=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "BROADCAST" in plan.upper()
    plan2 = lookup(facts(spark), small, "k", broadcast=True, max_broadcast_bytes=1)
    assert "broadcast" not in plan2._jdf.queryExecution().optimizedPlan().toString().lower()


def test_installments_sum_is_bigint(spark):
    p = spark.createDataFrame([("o1", 2), ("o1", 3), ("o2", 0)], "order_id string, payment_installments int")
    out = total_installments(p)
    assert dict(out.dtypes)["payment_count"] == "bigint"
    assert rows(out) == [("o1", 5), ("o2", 0)]


def test_enrich_orders_and_items(spark):
    orders = spark.createDataFrame([("o1", "c1"), ("o2", "c9")], "order_id string, customer_id string")
    customers = spark.createDataFrame([("c1", "SP")], "customer_id string, customer_state string")
    pay = spark.createDataFrame([("o1", 3)], "order_id string, payment_count bigint")
    reviews = spark.createDataFrame(
        [("r1", "o1", 5), ("r2", "o1", 4)], "review_id string, order_id string, review_score int"
    )
    out = enrich_orders(orders, customers, pay, reviews)
    assert rows(out, "order_id", "customer_state", "payment_count", "review_score") == [
        ("o1", "SP", 3, 4), ("o1", "SP", 3, 5), ("o2", None, None, None)]
    one = enrich_orders(orders, customers, pay, reviews, reviews_one_per_key={"review_score": "max"})
    assert one.count() == 2

    items = spark.createDataFrame([("o1", "p1", "s1"), ("o1", "p2", "s2"), ("o2", "p3", "s1")],
                                  "order_id string, product_id string, seller_id string")
    products = spark.createDataFrame([("p1", "cama"), ("p2", None)], "product_id string, product_category_name string")
    sellers = spark.createDataFrame([("s1", "RJ")], "seller_id string, seller_state string")
    tr = spark.createDataFrame([("cama", "bed")], "product_category_name string, product_category_name_english string")
    got = rows(enrich_items(items, products, sellers, tr), "product_id", "product_category_name_english", "seller_state")
    assert got == [("p1", "bed", "RJ"), ("p2", None, None), ("p3", None, "RJ")]


def test_known_small_lookups_alone_are_broadcast(spark):
    items = spark.range(9).selectExpr("id as product_id", "id as seller_id")
    products = spark.range(9).selectExpr("id as product_id", "cast(id as string) as product_category_name")
    sellers = spark.range(9).selectExpr("id as seller_id", "1 as seller_state")
    tr = spark.range(9).selectExpr("cast(id as string) as product_category_name", "id as n")
    got = enrich_items(items, products, sellers, tr, small=["sellers"])
    joins = [line for line in got._jdf.queryExecution().executedPlan().toString().split("\n") if "Join" in line]
    assert sorted(("Broadcast" in x, "seller_id" in x) for x in joins) == [(False, False), (False, False), (True, True)]
    assert rows(got) == rows(enrich_items(items, products, sellers, tr))
    assert loaded_bytes(tr) == 9 * (48 + 16 + 1) and loaded_bytes(tr.limit(0)) == 0
    assert loaded_bytes(tr.selectExpr("if(n < 3, null, 'éé') as s")) == 9 * 56 + 6 * 4
