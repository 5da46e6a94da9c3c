"""The change chain: routed facts read back by table, lookups on the store as of the micro-batch, a crash between two sinks."""

import json
import tempfile

import pytest

from pyspark.sql import functions as F

from storelens import schemas
from storelens.operators import upsert
from storelens.sources import adapters as ad
from storelens.streaming import jobs as sj
from storelens.streaming import topics

T0 = "2024-01-01 00:00:0"


def _layout():
    return sj.Layout(tempfile.mkdtemp(prefix="chain-", dir="/tmp"))


def _run(q):
    q.awaitTermination()
    assert q.exception() is None


def _changes(spark, lay, rows):
    """One more file of change records: (table, data)."""
    first = len(spark.read.schema(schemas.RAW).json(lay.topic("changes")).collect()) if rows and getattr(lay, "_has", False) else 0
    lay._has = True
    recs = [(first + i, json.dumps({"table": t, "type": "insert", "data": d, "ts": 1})) for i, (t, d) in enumerate(rows)]
    spark.createDataFrame(recs, "offset long, value string").coalesce(1).write.mode("append").json(lay.topic("changes"))


def _rules(spark, lay):
    ad.shop_rules(spark).write.mode("overwrite").parquet(lay.rules)


def _order(i, second, user="7"):
    return ("order_info", {"id": str(i), "user_id": user, "province_id": "1", "order_status": "F", "total_amount": "9.50",
                           "create_time": f"{T0}{second}", "unknown": "x"})


def _line(i, at):
    return ("order_detail", {"detail_id": str(i * 10), "order_id": str(i), "sku_id": "3", "sku_num": "2", "order_price": "4.75",
                             "split_total_amount": "9.50", "create_time": at})


WIDE = "detail_id long, order_id long, user_id long, user_age int, user_gender string, province_name string, sku_name string, tm_name string"


def _wide(spark, lay):
    rows = sj.read_records(spark, sj.batches_of(lay, "order_wide"), WIDE, stream=False).drop("offset").collect()
    return {r["order_id"]: r.asDict() for r in rows}


def test_facts_by_table_with_types(spark):
    lay = _layout()
    _rules(spark, lay)
    _changes(spark, lay, [_order(1, 1), _line(1, f"{T0}1.004"), ("order_info", {"id": "bad", "total_amount": "?"}), ("order_info", {})])
    _run(sj.change_routing_job(spark, lay))
    rows = topics.read_facts(spark, lay.topic("facts"), sj.FACT_ORDER, sj.FACT_COLUMNS[sj.FACT_ORDER], stream=False)
    assert dict(rows.dtypes)["total_amount"] == "decimal(18,2)"
    got = {r["offset"]: r for r in rows.collect()}
    assert set(got) == {0, 2} and got[0]["id"] == 1 and str(got[0]["total_amount"]) == "9.50" and got[0]["create_time"] == f"{T0}1"
    assert got[2]["id"] is None and got[2]["total_amount"] is None


def test_dimension_change_shows_in_the_next_batch_only(spark):
    lay = _layout()
    _rules(spark, lay)
    user = lambda gender: ("user_info", {"id": "7", "birthday": "2000-01-01", "gender": gender})
    sku = lambda tm: ("sku_info", {"id": "3", "sku_name": "s", "price": "1", "spu_id": "1", "tm_id": tm, "category3_id": "1"})
    _changes(spark, lay, [user("M"), ("base_province", {"id": "1", "name": "P"}), sku("1"), ("base_trademark", {"id": "1", "tm_name": "one"}),
                          _order(1, 1), _line(1, f"{T0}1.005"), _line(1, f"{T0}1.006")])
    _run(sj.change_routing_job(spark, lay))
    _run(sj.fact_order_wide_job(spark, lay, "2025-01-01 00:00:00"))
    assert _wide(spark, lay) == {1: {"detail_id": 10, "order_id": 1, "user_id": 7, "user_age": 25, "user_gender": "M", "province_name": "P",
                                     "sku_name": "s", "tm_name": "one"}}
    _changes(spark, lay, [user("F"), ("sku_info", {"id": "3", "tm_id": "2"}), ("base_trademark", {"id": "2", "tm_name": "two"}),
                          _order(2, 2), _line(2, f"{T0}2"), _order(3, 3, "8"), _line(3, f"{T0}2.996")])
    _run(sj.change_routing_job(spark, lay))
    _run(sj.fact_order_wide_job(spark, lay, "2025-01-01 00:00:00"))
    got = _wide(spark, lay)
    assert {k: (v["user_gender"], v["tm_name"], v["sku_name"]) for k, v in got.items()} == {
        1: ("M", "one", "s"), 2: ("F", "two", "s"), 3: (None, "two", "s")}   # an unknown user keeps the row


def test_product_statistics_on_the_store(spark):
    """J5 after the aggregate, on the store as of the micro-batch."""
    lay = _layout()
    dims = lambda name, offset: spark.createDataFrame(
        [("dim_sku_info", "id", {"id": "3", "sku_name": name, "price": "1.50", "tm_id": "1"}, offset)],
        "sink_table string, sink_pk string, data map<string,string>, offset long")
    store = upsert.DimensionStore(spark, lay.dims)
    store.merge(dims("old", 0), 0)

    def put(*seconds):
        for topic in ("favor", "cart", "refund", "comment", "order_wide", "payment_wide", "dwd"):
            rows = [{"sku_id": 3, "create_time": s} for s in seconds]
            page = {"common": {"mid": "1"}, "page": {"page_id": "good_detail", "item": "3"}, "ts": 1}
            recs = [(0, json.dumps({**r, "payment_create_time": r["create_time"]}) if topic != "dwd" else json.dumps({**page, "ts": int(
                __import__("calendar").timegm(__import__("time").strptime(r["create_time"], "%Y-%m-%d %H:%M:%S")) * 1000)})) for r in rows]
            df = spark.createDataFrame(recs, "offset long, value string").coalesce(1)
            if topic == "dwd":
                df.withColumn("kind", F.lit("page")).write.mode("append").partitionBy("kind").json(lay.topic(topic))
            else:
                df.write.mode("append").json(lay.topic(topic))

    wide = "sku_id long, order_id long, sku_num long, split_total_amount decimal(18,2), create_time string"
    paid = "sku_id long, order_id long, split_total_amount decimal(18,2), payment_create_time string"
    put(f"{T0}1")
    put("2024-01-02 00:00:00")
    _run(sj.product_stats_job(spark, lay, wide, paid, as_of="2025-01-01 00:00:00"))
    store.merge(dims("new", 1), 1)
    put("2024-01-03 00:00:00")
    _run(sj.product_stats_job(spark, lay, wide, paid, as_of="2025-01-01 00:00:00"))
    got = [(r["stt"], r["sku_name"], str(r["sku_price"]), r["favor_ct"], r["click_ct"]) for r in spark.read.parquet(
        lay.stats("product_stats")).orderBy("stt").collect()]
    assert got == [("2024-01-01 00:00:00", "old", "1.50", 1, 1), ("2024-01-02 00:00:00", "new", "1.50", 1, 1)]


def test_crash_between_two_sinks(spark, monkeypatch):
    """A failure after the store write and before the facts write, then a restart: every record once in both sinks."""
    lay = _layout()
    _rules(spark, lay)
    _changes(spark, lay, [("user_info", {"id": "7", "gender": "M"}), _order(1, 1), _line(1, f"{T0}1")])
    real, seen = sj.write_batch, []

    def failing(df, path, batch_id, *a, **kw):
        if path == lay.topic("facts") and not seen:
            seen.append(batch_id)
            raise OSError("lost before the facts write")
        return real(df, path, batch_id, *a, **kw)
    monkeypatch.setattr(sj, "write_batch", failing)
    with pytest.raises(Exception, match="lost before the facts write"):
        sj.change_routing_job(spark, lay).awaitTermination()
    store = upsert.DimensionStore(spark, lay.dims)
    assert store.batches() == [0] and topics.batch_ids(spark, lay.topic("facts")) == []
    _changes(spark, lay, [_order(2, 2)])
    _run(sj.change_routing_job(spark, lay))
    assert {(r["pk"], r["column"]): r["value"] for r in store.current().collect()} == {("7", "ID"): "7", ("7", "GENDER"): "M"}
    ids = lambda table: sorted(r["id"] for r in topics.read_facts(spark, lay.topic("facts"), table, "id long", stream=False).collect())
    assert ids(sj.FACT_ORDER) == [1, 2]
    assert topics.read_facts(spark, lay.topic("facts"), sj.FACT_DETAIL, "order_id long", stream=False).count() == 1


def test_a_batch_is_written_once(spark):
    path = tempfile.mkdtemp(prefix="batch-", dir="/tmp") + "/t"
    rows = spark.createDataFrame([(1, "a")], "offset long, value string")
    assert topics.write_batch(rows, path, 3) and not topics.write_batch(rows.union(rows), path, 3)
    assert topics.batch_ids(spark, path) == [3] and spark.read.json(f"{path}/batch-*").count() == 1
    assert topics.batch_ids(spark, path + "-none") == []


def test_chains_hold_little_on_disk(spark, monkeypatch):
    """Topics are compressed, go when they are read, and are read a slice (a file per core) at a time, the sentinel alone."""
    import os

    from storelens.sources.tables import Tables
    from storelens.streaming import run
    from storelens.streaming.publish import publish
    sf = "/root/testdata/sf0.001"
    seen = {}
    monkeypatch.setattr(run, "_drop", lambda spark, lay, *kept: seen.update(lay=lay))
    run.payment_wide_stream(spark, sf).count()
    lay = seen["lay"]
    files = [os.path.join(d, f) for d, _, fs in os.walk(lay.root.removeprefix("file:")) for f in fs]
    assert not [f for f in files if "/topics/changes/" in f or "/topics/facts/" in f and ".json" in f or "_checkpoints/change_routing" in f]
    topics = [f for f in files if "/topics/" in f and f.endswith((".json", ".json.gz"))]
    assert topics and all(f.endswith(".gz") for f in topics)
    lay = run.new_layout(spark, "slices", 3, 4)
    publish(Tables(spark, sf), lay, topics=("order_info",), files=2, parts=3)
    info = lay.topic("order_info").removeprefix("file:")
    names = sorted((f for f in os.listdir(info) if f.startswith("part-")), key=lambda f: os.stat(f"{info}/{f}").st_mtime)
    assert len(names) == 7 and spark.read.json(f"{lay.topic('order_info')}/{names[-1]}").count() == 1
    assert spark.read.json(lay.topic("order_info")).count() == Tables(spark, sf).orders.count() + 1


def _files(spark, path):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return sorted(((s.getModificationTime(), s.getPath().toString()) for s in p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)
                   if s.getPath().getName().startswith("part-")))


def test_published_span_by_span_in_time_order(spark):
    """Frames staged one after another give every record once, in slices of time of ``parts`` files, and leave nothing staged."""
    import os
    from storelens.streaming import publish
    lay, parts = _layout(), 2
    frame = lambda lo, hi: spark.range(lo, hi).select(
        F.col("id").cast("string").alias("k"), F.col("id").alias("_offset"), F.when(F.col("id") % 50 != 0, (F.col("id") * 37 % 1000)).alias("_at"))
    path = lay.topic("t")
    publish._write([frame(0, 300), frame(300, 1000)], frame(0, 1000).select("_at"), ["k"], path, 6, parts, None)
    files = _files(spark, path)
    assert not os.path.exists(f"{path}-staged") and len(files) % parts == 0
    seen, before = [], -1
    for i in range(0, len(files), parts):
        ids = [r["offset"] for _, f in files[i:i + parts] for r in spark.read.schema(schemas.RAW).json(f).collect()]
        at = [i * 37 % 1000 for i in ids if i % 50]
        if at:
            assert min(at) > before
            before = max(at)
        seen += ids
    assert sorted(seen) == list(range(1000))


def test_topics_read_once_are_deleted_as_they_are_read(spark):
    lay = _layout()
    lay.once, lay.max_files = True, 1
    _rules(spark, lay)
    for k in range(4):
        _changes(spark, lay, [_order(k + 1, 1), _line(k + 1, f"{T0}1.004")])
    assert len(_files(spark, lay.topic("changes"))) == 4
    _run(sj.change_routing_job(spark, lay))
    assert len(_files(spark, lay.topic("changes"))) < 4
    assert topics.read_facts(spark, lay.topic("facts"), sj.FACT_ORDER, sj.FACT_COLUMNS[sj.FACT_ORDER], stream=False).count() == 4


def test_registered_chains_keep_state_on_disk_whatever_the_session_says(spark):
    from storelens.streaming import run
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        with run._state_partitions(spark):
            assert "RocksDB" in spark.conf.get(key) and spark.conf.get("spark.sql.streaming.stateStore.rocksdb.compression") == "zstd"
        assert "HDFSBacked" in spark.conf.get(key)
    finally:
        spark.conf.set(key, old)
