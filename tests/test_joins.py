from storelens.operators import joins


def test_interval_join_bounds_inclusive(spark):
    orders = spark.createDataFrame([(1, 1000)], "id long, ts long")
    lines = spark.createDataFrame([(1, 1000 + o, o) for o in (-6, -5, 0, 5, 6)], "order_id long, lts long, off long")
    j = joins.interval_join(orders, lines, {"id": "order_id"}, "ts", "lts", -5, 5)
    assert sorted(r["off"] for r in j.collect()) == [-5, 0, 5]
    # mutation check: a wrong bound must change the result
    j4 = joins.interval_join(orders, lines, {"id": "order_id"}, "ts", "lts", -4, 4)
    assert sorted(r["off"] for r in j4.collect()) == [0]


def test_payment_interval(spark):
    pay = spark.createDataFrame([(1, 2_000_000)], "order_id long, pts long")
    wide = spark.createDataFrame([(1, 2_000_000 + s * 1000, s) for s in (-1801, -1800, 0, 1)],
                                 "oid long, ots long, s long")
    j = joins.interval_join(pay, wide, {"order_id": "oid"}, "pts", "ots", -1_800_000, 0)
    assert sorted(r["s"] for r in j.collect()) == [-1800, 0]


def test_lookup_keeps_facts(spark):
    facts = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "id long, sku_id long")
    sku = spark.createDataFrame([(10, "ten", 5)], "id long, sku_name string, spu_id long")
    spu = spark.createDataFrame([(5, "five")], "id long, spu_name string")
    w = joins.lookup(facts, sku, {"sku_id": "id"}, ["sku_name", "spu_id"])
    w = joins.lookup(w, spu, {"spu_id": "id"}, ["spu_name"], broadcast=True)
    got = sorted(tuple(r) for r in w.select("id", "sku_name", "spu_name").collect())
    assert got == [(1, "ten", "five"), (2, None, None), (3, None, None)]


def test_composite_lookup(spark):
    facts = spark.createDataFrame([(1, 7, 1), (2, 7, 2)], "id long, uid long, nat long")
    dim = spark.createDataFrame([(7, 1, "M")], "id long, nation long, gender string")
    w = joins.lookup(facts, dim, {"uid": "id", "nat": "nation"}, {"gender": "g"})
    assert sorted(tuple(r) for r in w.select("id", "g").collect()) == [(1, "M"), (2, None)]


def test_bounded_broadcast_checks_rows(spark):
    small = spark.range(5)
    big = spark.range(50)
    assert "ResolvedHint" in small.hint("broadcast")._jdf.queryExecution().analyzed().toString()
    b1 = joins.bounded_broadcast(small, 10)
    b2 = joins.bounded_broadcast(big, 10)
    assert "broadcast" in b1._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in b2._jdf.queryExecution().analyzed().toString().lower()


def test_coalesce_merge(spark):
    a = spark.createDataFrame([(1, "x", None), (2, None, None)], "id long, u string, p string")
    b = spark.createDataFrame([(1, None, "px"), (3, "y", "pz")], "id long, u string, p string")
    got = sorted(tuple(r) for r in joins.coalesce_merge(a, b, ["id"]).collect())
    assert got == [(1, "x", "px"), (2, None, None), (3, "y", "pz")]
