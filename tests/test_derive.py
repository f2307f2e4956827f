import datetime as dt

from conftest import rows

from strata.operators.derive import add_amounts, add_delivery_days, add_elapsed_days, keep_delivered, within


def durations(spark):
    base = dt.datetime(2020, 1, 10, 12, 0, 0)
    data = [
        ("undelivered", base, None),
        ("same_day", base, base + dt.timedelta(hours=3)),
        ("negative", base, base - dt.timedelta(days=2)),
        ("one", base, base + dt.timedelta(days=1)),
        ("sixty", base, base + dt.timedelta(days=60)),
        ("sixty_one", base, base + dt.timedelta(days=61)),
        ("midnight", dt.datetime(2020, 1, 10, 23, 59), dt.datetime(2020, 1, 11, 0, 1)),
    ]
    return spark.createDataFrame(data, "id string, bought timestamp, delivered timestamp")


def test_elapsed_days_calendar_days(spark):
    df = add_elapsed_days(durations(spark), "delivered", "bought", "days")
    got = dict(rows(df, "id", "days"))
    assert got == {
        "undelivered": None, "same_day": 0, "negative": -2, "one": 1,
        "sixty": 60, "sixty_one": 61, "midnight": 1,
    }
    assert dict(df.dtypes)["days"] == "int"


def test_guarded_and_plain_agree(spark):
    a = add_elapsed_days(durations(spark), "delivered", "bought", "d", guarded=True)
    b = add_elapsed_days(durations(spark), "delivered", "bought", "d", guarded=False)
    assert rows(a) == rows(b)


def test_day_boundary_follows_session_zone(spark):
    df = durations(spark).filter("id = 'midnight'")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        # the same two instants fall on one local day in New York
        assert add_elapsed_days(df, "delivered", "bought", "d").first()["d"] == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_keep_delivered_and_composite(spark):
    df = add_elapsed_days(durations(spark), "delivered", "bought", "delivery_time_days")
    kept = [r[0] for r in rows(keep_delivered(df), "id")]
    assert kept == ["midnight", "one", "sixty", "sixty_one"]
    comp = add_delivery_days(durations(spark), "delivered", "bought")
    assert rows(comp, "id") == rows(keep_delivered(df), "id")


def test_within_closed_range_drops_null(spark):
    df = add_elapsed_days(durations(spark), "delivered", "bought", "d")
    assert sorted(r[0] for r in rows(within(df, "d", 1, 60), "d")) == [1, 1, 60]


def test_amounts_null_propagation(spark):
    df = spark.createDataFrame([(10.0, 2.5), (None, 1.0), (3.0, None)], "price double, freight_value double")
    got = rows(add_amounts(df), "price", "total_price", "profit_margin")
    assert got == [(10.0, 12.5, 7.5), (3.0, None, None), (None, None, None)]
