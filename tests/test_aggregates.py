from storelens.functions.text import keyword_tokens
from storelens.operators import aggregates as agg


def test_unpivot_positive(spark):
    df = spark.createDataFrame([("a", 0, 0, 0), ("b", 3, 0, 2)], "k string, click_ct long, cart_ct long, order_ct long")
    out = agg.unpivot_positive(df, {"click_ct": "CLICK", "cart_ct": "CART", "order_ct": "ORDER"})
    assert sorted(tuple(r) for r in out.collect()) == [("b", 2, "ORDER"), ("b", 3, "CLICK")]


def test_order_count_is_distinct_and_windows_half_open(spark):
    orders = spark.createDataFrame([(7, 10_000, 100, 1, 5), (7, 19_999, 100, 1, 5), (7, 20_000, 100, 1, 5)],
                                   "sku_id long, ts long, order_id long, n long, amt long")
    ev = agg.product_events(order_wide=orders.selectExpr(
        "sku_id", "order_id", "n as sku_num", "cast(amt as decimal(18,2)) as split_total_amount",
        "date_format(timestamp_millis(ts), 'yyyy-MM-dd HH:mm:ss') as create_time"))
    rows = sorted((r["stt"], r["order_ct"], r["order_sku_num"]) for r in
                  agg.product_stats(ev, "10 seconds", "2025-01-01 00:00:00").collect())
    assert rows == [("1970-01-01 00:00:10", 1, 2), ("1970-01-01 00:00:20", 1, 1)]


def test_keyword_tokens_whole_text(spark):
    long_text = "Red Ball, " * 5000 + "gizmo42"
    got = spark.createDataFrame([(long_text,)], "t string").select(keyword_tokens("t").alias("k")).first()["k"]
    assert len(got) == 10001 and got[:2] == ["red", "ball"] and got[-1] == "gizmo42"


def test_token_counts(spark):
    lines = spark.createDataFrame([("a,b,,a",), ("b",)], "value string")
    assert sorted(tuple(r) for r in agg.token_counts(lines).collect()) == [("a", 2), ("b", 2)]


def test_zone_formats_window_bounds(spark):
    s = spark.createDataFrame([("k w", 0)], "fullword string, ts long")
    row = agg.keyword_stats(s, "10 seconds", zone="+08:00", as_of="2025-01-01 00:00:00").first()
    assert (row["stt"], row["edt"]) == ("1970-01-01 08:00:00", "1970-01-01 08:00:10")


def test_times_do_not_depend_on_session_zone(spark):
    from pyspark.sql import functions as F

    from storelens.functions.time import day_of, epoch_ms, format_ts
    df = spark.createDataFrame([("2024-07-01 12:34:56.789",)], "t string") \
        .select(F.to_timestamp_ntz("t").alias("ntz"))
    exprs = [epoch_ms("ntz").alias("ms"), format_ts("ntz").alias("txt"), day_of(F.lit(1719837296789)).alias("day")]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        results = []
        for zone in ("UTC", "America/New_York", "Asia/Shanghai"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            results.append(tuple(df.select(*exprs).first()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert results == [(1719837296789, "2024-07-01 12:34:56", "20240701")] * 3
