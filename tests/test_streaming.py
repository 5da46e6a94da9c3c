
import json
import tempfile


from pyspark.sql import functions as F

from helpers import log_rows
from storelens import schemas
from storelens.operators import stateful
from storelens.streaming import jobs as sj
from storelens.streaming.topics import as_records

END = 4_102_444_800_000   # sentinel far in the future: moves the watermark past every real window


def _layout(max_files=None):
    return sj.Layout(tempfile.mkdtemp(prefix="stream-", dir="/tmp"), max_files, max_files)


def _publish(df, path, kind=None):
    """Append log records to a topic folder (one file per call); ``kind`` for the base-log topic."""
    rec = as_records(df, "offset", ["common", "start", "page", "displays", "ts"]).select("offset", "value").coalesce(1)
    if kind:
        rec.withColumn("kind", F.lit(kind)).write.mode("append").partitionBy("kind").json(path)
    else:
        rec.write.mode("append").json(path)


def _read(spark, lay, topic, kind=None):
    return sj.read_records(spark, lay.topic(topic), schemas.LOG, stream=False, kind=kind)


def _run(q):
    q.awaitTermination()
    assert q.exception() is None


def _mid_ts(df):
    return sorted((r["mid"], r["ts"]) for r in df.select(F.col("common.mid").alias("mid"), "ts").collect()
                  if r["mid"] != "__end__")


FIXTURE = [
    {"mid": 101, "ts": 10000, "page_id": "home", "last_page_id": None},
    {"mid": 102, "ts": 12000, "page_id": "home", "last_page_id": None},
    {"mid": 102, "ts": 150000, "page_id": "good_list", "last_page_id": "home"},
    {"mid": 102, "ts": 300000, "page_id": "good_list", "last_page_id": "detail"},
    {"mid": 103, "ts": 400000, "page_id": "home", "last_page_id": None},
    {"mid": 103, "ts": 405000, "page_id": "good_list", "last_page_id": "home"},
    {"mid": "__end__", "ts": END, "page_id": "good_list", "last_page_id": "home", "item": "end"},
]


def test_jump_stream_matches_batch_across_micro_batches(spark):
    lay = _layout(max_files=1)
    rows = log_rows(spark, FIXTURE)
    # one file per record: each micro-batch sees one record, so pending entries cross batches
    for r in rows.collect():
        _publish(spark.createDataFrame([r], rows.schema), lay.topic("dwd"), "page")
    _run(sj.user_jump_job(spark, lay, 10_000))
    got = _mid_ts(_read(spark, lay, "user_jump"))
    assert got == [("101", 10000), ("102", 12000)]
    assert got == _mid_ts(stateful.bounces(rows, 10_000))


def test_base_log_and_unique_visit_stream(spark):
    lay = _layout()
    day = 86_400_000
    rows = log_rows(spark, [
        {"mid": 1, "ts": 1, "is_new": "1", "last_page_id": None},   # epoch 0 itself counts as late
        {"mid": 1, "ts": 10, "is_new": "1", "start": True},
        {"mid": 1, "ts": day + 5, "is_new": "1", "last_page_id": None},
        {"mid": 1, "ts": day + 9, "is_new": "1", "last_page_id": None},
        {"mid": 2, "ts": 3, "is_new": "0", "last_page_id": "home", "displays": [("sku_id", "4")]},
        {"mid": "__end__", "ts": END, "page_id": "good_list", "last_page_id": "home", "item": "end"},
    ])
    _publish(rows, lay.topic("log"))
    _run(sj.base_log_job(spark, lay))
    pages = _read(spark, lay, "dwd", "page")
    flags = sorted((r["ts"], r["is_new"]) for r in pages.select("ts", F.col("common.is_new").alias("is_new")).collect())
    assert flags[:4] == [(1, "1"), (3, "0"), (day + 5, "0"), (day + 9, "0")]
    assert _read(spark, lay, "dwd", "start").count() == 1
    shown = spark.read.schema("offset long, value string, kind string").json(lay.topic("dwd")).where("kind = 'display'")
    assert [json.loads(r["value"]) for r in shown.collect()] == [{"item_type": "sku_id", "item": "4", "page_id": "home"}]
    _run(sj.unique_visit_job(spark, lay))
    assert _mid_ts(_read(spark, lay, "unique_visit")) == [("1", 1), ("1", day + 5)]


def test_late_rows_drop_and_restart_has_no_duplicates(spark):
    lay = _layout()
    rows = lambda recs: log_rows(spark, recs)
    _publish(rows([{"mid": 1, "ts": 1_000, "last_page_id": "home"},
                   {"mid": 1, "ts": 100_000, "last_page_id": "home"}]), lay.topic("dwd"), "page")
    for topic in ("unique_visit", "user_jump"):   # each input has its own watermark: all must move on
        _publish(rows([{"mid": 1, "ts": 100_000, "last_page_id": None}]), lay.topic(topic))
    _run(sj.visitor_stats_job(spark, lay, "10 seconds", delay="0 seconds"))
    # second run on the same checkpoint: a late row (window long closed) and the sentinel
    _publish(rows([{"mid": 1, "ts": 2_000, "last_page_id": "home"},
                   {"mid": "__end__", "ts": END, "last_page_id": "home"}]), lay.topic("dwd"), "page")
    for topic in ("unique_visit", "user_jump"):
        _publish(rows([{"mid": "__end__", "ts": END, "last_page_id": None}]), lay.topic(topic))
    _run(sj.visitor_stats_job(spark, lay, "10 seconds", delay="0 seconds"))
    stats = spark.read.parquet(lay.stats("visitor_stats"))
    got = sorted((r["stt"], r["pv_ct"]) for r in stats.collect())
    assert got == [("1970-01-01 00:00:00", 1), ("1970-01-01 00:01:40", 1)]   # late row at 2 s dropped, no repeats


def test_token_count_stream_updates(spark):
    import os
    d = tempfile.mkdtemp(prefix="lines-", dir="/tmp")
    os.makedirs(f"{d}/in")
    with open(f"{d}/in/a.txt", "w") as fh:
        fh.write("a,b\nb,,c\n")
    lines = spark.readStream.text(f"{d}/in")
    _run(sj.token_count_job(spark, lines, f"{d}/out", f"{d}/ckpt", trigger={"availableNow": True}))
    with open(f"{d}/in/b.txt", "w") as fh:
        fh.write("c,a\n")
    _run(sj.token_count_job(spark, spark.readStream.text(f"{d}/in"), f"{d}/out", f"{d}/ckpt"))
    got = {r["token"]: r["ct"] for r in sj.latest_counts(spark, f"{d}/out").collect()}
    assert got == {"a": 2, "b": 2, "c": 2}


def test_order_wide_stream_interval_join(spark):
    """J1 stream-stream: lines within +-5 ms of their order join; state evicted by watermark + bounds."""
    lay = _layout()
    o = spark.createDataFrame([(1, 10_000), (2, 50_000), (-1, END)], "id long, create_ts long") \
        .selectExpr("id", "cast(id % 5 as bigint) as province_id", "id * 10 as user_id", "'F' as order_status",
                    "cast(1.5 as decimal(18,2)) as total_amount", "'x' as create_time", "create_ts")
    d = spark.createDataFrame([(10, 1, 10_000 + off) for off in (-6, -5, 0, 5, 6)] + [(20, 2, 50_000), (99, -1, END)],
                              "detail_id long, order_id long, create_ts long") \
        .selectExpr("detail_id", "order_id", "detail_id as sku_id", "1L as sku_num", "cast(2 as decimal(18,2)) as order_price",
                    "cast(2 as decimal(18,2)) as split_total_amount", "'x' as create_time", "create_ts + 0 as create_ts")
    as_records(o, "id").coalesce(1).write.json(lay.topic("order_info"))
    as_records(d.withColumn("offset", F.col("detail_id")), "offset",
               [c for c in d.columns]).coalesce(1).write.json(lay.topic("order_detail"))
    empty = spark.createDataFrame([], "id long, birthday string, gender string, nation_id long, name string, "
                                      "area_code string, iso_code string, iso_3166_2 string, sku_name string, "
                                      "spu_id long, tm_id long, category3_id long, spu_name string, tm_name string, "
                                      "category3_name string")
    _run(sj.order_wide_job(spark, lay, empty, empty, empty, "2025-01-01 00:00:00"))
    wide = spark.read.schema(schemas.RAW).json(lay.topic("order_wide")) \
        .select(F.get_json_object("value", "$.order_id").cast("long").alias("o"),
                F.get_json_object("value", "$.user_age").alias("age"))
    assert sorted(r["o"] for r in wide.collect() if r["o"] != -1) == [1, 1, 1, 2]


def test_topic_chain_restart_has_no_duplicates(spark):
    """A job restarted on its checkpoint with new input appends only the new records to its topic,
    and its file sink's log keeps downstream readers to committed files."""
    lay = _layout()
    day = 86_400_000
    _publish(log_rows(spark, [{"mid": 1, "ts": 1_000, "offset": 1, "last_page_id": None}]), lay.topic("dwd"), "page")
    _run(sj.unique_visit_job(spark, lay))
    _publish(log_rows(spark, [{"mid": 1, "ts": day + 1, "offset": 2, "last_page_id": None},
                              {"mid": 1, "ts": day + 2, "offset": 3, "last_page_id": None}]), lay.topic("dwd"), "page")
    _run(sj.unique_visit_job(spark, lay))
    out = spark.read.schema(schemas.RAW).json(lay.topic("unique_visit"))
    assert sorted(r["offset"] for r in out.collect()) == [1, 2]


def test_no_rows_lost_over_many_micro_batches(spark):
    """One file per micro-batch in every job: the unique visits and jumps are the batch jobs' ones."""
    from storelens.plans import jobs as batch
    from storelens.sources.tables import Tables
    from storelens.streaming import run
    from storelens.streaming.publish import publish
    from storelens.streaming.topics import late_rows
    t = Tables(spark, "/root/testdata/sf0.001")
    lay = run.new_layout(spark, "many", max_files=1, derived_files=5)
    publish(t, lay, topics=("log",), files=4)
    _run(sj.base_log_job(spark, lay))
    run.measure(spark, lay, "dwd")
    whole = t.events.agg((F.max("ts").cast("timestamp").cast("long") - F.min("ts").cast("timestamp").cast("long"))).first()[0] * 1000
    assert 0 < lay.late("dwd") < whole / 2   # a slice or so, not the whole log
    pages = batch.log_pages(t)
    for job, topic, want in ((sj.unique_visit_job, "unique_visit", stateful.daily_unique(pages)),
                             (sj.user_jump_job, "user_jump", stateful.bounces(pages, batch.JUMP_WITHIN))):
        q = job(spark, lay)
        _run(q)
        assert late_rows(q) == 0 and len([p for p in q.recentProgress if p.numInputRows]) > 4
        got = _mid_ts(_read(spark, lay, topic))
        assert got == _mid_ts(want) and len(got) > 150


REAL_END = 2_000_000_000_000   # after every real event time, before the sentinels


def _closed_before_last(q):
    """Windows that the state let go of in micro-batches whose watermark real rows had set, with more real rows to come."""
    import datetime as dt

    def watermark(p):
        w = p.eventTime.get("watermark")
        return dt.datetime.fromisoformat(w.replace("Z", "+00:00")).timestamp() * 1000 if w else 0
    progress = list(q.recentProgress)
    last = max(i for i, p in enumerate(progress) if p.numInputRows and watermark(p) < REAL_END)
    return sum(op.numRowsRemoved for p in progress[:last] if 0 < watermark(p) < REAL_END for op in p.stateOperators)


def test_windows_close_on_real_rows(spark):
    """T4, T5: with each topic's own measured bound, windows close while real slices are still to come, and the rows are
    the batch job's."""
    from storelens.plans import jobs as batch
    from storelens.sources import adapters as ad
    from storelens.sources.tables import Tables
    from storelens.streaming import run
    from storelens.streaming.publish import publish, publish_last
    sf = "/root/testdata/sf0.001"
    t = Tables(spark, sf)
    lay = run.new_layout(spark, "close", run.MAX_FILES, 4)
    publish(t, lay, topics=("log", *run.ORDER_TOPICS), files=run.SOURCE_FILES)
    for last in (False, True):
        if last:
            publish_last(t, lay)
        for job in (sj.base_log_job, sj.unique_visit_job, sj.user_jump_job):
            q = job(spark, lay)
            _run(q)
            if not last and job is not sj.base_log_job:
                assert _closed_before_last(q) > 0 or job is sj.unique_visit_job   # its flags live a day more
            run.measure(spark, lay, "dwd")
    run.measure(spark, lay, "unique_visit", "user_jump")
    _run(sj.order_wide_job(spark, lay, ad.dim_user(t), ad.dim_province(t), batch.products(t), batch.AS_OF))
    run.measure(spark, lay, "order_wide")
    wide = run._ddl(batch.order_wide_enriched(t))
    for q, name, want in (
            (sj.visitor_stats_job(spark, lay, batch.WINDOW), "visitor_stats", batch.q_visitor_stats(spark, sf)),
            (sj.keyword_stats_job(spark, lay, batch.WINDOW, as_of=batch.AS_OF), "keyword_stats", batch.q_keyword_stats(spark, sf)),
            (sj.province_stats_job(spark, lay, wide, batch.WINDOW, as_of=batch.AS_OF), "province_stats", batch.q_province_stats(spark, sf))):
        _run(q)
        assert _closed_before_last(q) > 0, name
        mine = spark.read.parquet(lay.stats(name))
        assert mine.select("batch_id").distinct().count() > 2
        mine = mine.select(*want.columns)
        assert mine.exceptAll(want).count() == 0 and want.exceptAll(mine).count() == 0


def test_continuous_deployment_equals_batch(spark):
    """All jobs running at once on processing-time triggers, chained through their topics: each input has its own
    watermark and the slowest decides, so jobs that union several topics reach the batch results too."""
    import time

    from storelens.plans import jobs as batch
    from storelens.sources import adapters as ad
    from storelens.sources.tables import Tables
    from storelens.streaming import run
    from storelens.streaming.publish import publish, publish_last
    sf = "/root/testdata/sf0.001"
    t = Tables(spark, sf)
    lay = run.new_layout(spark, "deploy", max_files=1)
    publish(t, lay, files=4)
    publish_last(t, lay)
    span = {name: sj.measured_lateness(spark, lay.topic(name), F.get_json_object("value", f"$.{ts}").cast("long"), before=END)
            for name, ts in (("order_info", "create_ts"), ("order_detail", "create_ts"), ("payment_info", "callback_ts"))}
    lay.lateness["order_wide"] = span["order_info"] + span["order_detail"]
    lay.lateness["payment_wide"] = lay.lateness["order_wide"] + span["payment_info"] + 1_800_000
    wide = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in batch.order_wide_enriched(t).schema.fields)
    pay = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in batch.payment_wide_of(t).schema.fields)
    qs = run.start_all(spark, lay, ad.dim_user(t), ad.dim_province(t), batch.products(t), wide, pay,
                       as_of=batch.AS_OF, trigger={"processingTime": "1 second"})
    exact = {"keyword_stats": 376, "province_stats": 1395, "visitor_stats": 801, "product_stats": 7719}

    def counts():
        out = {}
        for name in exact:
            try:
                out[name] = spark.read.parquet(lay.stats(name)).count()
            except Exception:
                out[name] = 0
        return out

    try:
        deadline = time.time() + 300
        got = counts()
        while time.time() < deadline and got != exact:
            assert all(q.exception() is None for q in qs)
            time.sleep(5)
            got = counts()
    finally:
        for q in qs:
            q.stop()
    assert got == exact
    for name, want in (("visitor_stats", batch.q_visitor_stats(spark, sf)), ("product_stats", batch.q_product_stats(spark, sf))):
        mine = spark.read.parquet(lay.stats(name)).select(*want.columns)
        assert mine.exceptAll(want).count() == 0 and want.exceptAll(mine).count() == 0


def test_hot_device_jumps_spread_over_buckets_without_python(spark):
    """A device with a third of all rows; parity over several micro-batches, and a plan without Python."""
    import random
    rng = random.Random(7)
    recs, ts = [], 100_000
    for i in range(900):
        ts += rng.choice([0, 0, 1, 2_000, 9_999, 10_000, 10_001, 25_000])
        mid = 1 if i % 3 == 0 else rng.randrange(2, 40)
        recs.append({"mid": mid, "ts": ts, "offset": i, "last_page_id": rng.choice([None, "", "home"])})
    rows = log_rows(spark, recs)
    lay = _layout(max_files=1)
    for k in range(6):
        _publish(rows.where((F.col("offset") >= 150 * k) & (F.col("offset") < 150 * (k + 1))), lay.topic("dwd"), "page")
    _publish(log_rows(spark, [{"mid": "__end__", "ts": END, "last_page_id": "home"}]), lay.topic("dwd"), "page")
    q = sj.user_jump_job(spark, lay, 10_000)
    _run(q)
    got, want = _mid_ts(_read(spark, lay, "user_jump")), _mid_ts(stateful.bounces(rows, 10_000))
    assert got == want and len([m for m, _ in got if m == "1"]) > 20
    plan = q._jsq.explainInternal(False)
    assert "Python" not in plan and "Pandas" not in plan and "partial_max_by" in plan


def test_whole_records_through_the_log_chain(spark):
    """keys that no schema names stay in ``common``, ``page`` and ``displays``, also in a record whose is_new changes."""
    import os
    day = 86_400_000
    logs = [
        {"common": {"mid": "1", "is_new": "1", "os": {"v": [1, None, "x"]}}, "page": {"page_id": "p", "source": 7}, "ts": 1_000, "err": "e"},
        {"common": {"mid": "1", "is_new": "1", "os": "b"}, "page": {"page_id": "q", "deep": {"a": True}}, "ts": day + 1_000, "extra": [1, 2],
         "displays": [{"item": "4", "pos": 3}, {"item_type": "sku_id", "more": {"z": None}}, "odd"]},
        {"common": {"mid": "2", "is_new": "0"}, "start": {"unknown": 1}, "ts": day + 2_000},
        {"common": {"mid": "2", "is_new": "0"}, "start": {}, "page": {"page_id": "r"}, "ts": day + 3_000, "n": 12345678901234},
    ]
    lay = _layout()
    os.makedirs(lay.topic("log"))
    with open(f"{lay.topic('log')}/a.json", "w") as fh:
        fh.writelines(json.dumps({"offset": i, "value": json.dumps(x)}) + "\n" for i, x in enumerate(logs))
        fh.write(json.dumps({"offset": -1, "value": json.dumps({"common": {"mid": "e", "is_new": "0"}, "page": {"page_id": "p", "last_page_id": "x"}, "ts": END})}) + "\n")
    _run(sj.base_log_job(spark, lay))
    dwd = spark.read.schema("offset long, value string, kind string").json(lay.topic("dwd")).where("offset >= 0").collect()
    by = lambda kind: [json.loads(r["value"]) for r in sorted(dwd, key=lambda r: r["offset"]) if r["kind"] == kind]
    second = json.loads(json.dumps(logs[1]))
    second["common"]["is_new"] = "0"   # the only key that changes
    assert by("page") == [logs[0], second, logs[3]] and by("start") == [logs[2]]
    assert sorted(map(json.dumps, by("display"))) == sorted(map(json.dumps, (
        {"item": "4", "page_id": "q", "pos": 3}, {"item_type": "sku_id", "more": {"z": None}, "page_id": "q"})))
    _run(sj.unique_visit_job(spark, lay))
    _run(sj.user_jump_job(spark, lay))
    for topic in ("unique_visit", "user_jump"):
        got = spark.read.schema(schemas.RAW).json(lay.topic(topic)).where("offset >= 0").orderBy("offset").collect()
        assert [json.loads(r["value"]) for r in got] == [logs[0], second, logs[3]], topic


def test_late_rows_are_counted(spark):
    """K late rows, of k windows or groups, read as k dropped rows."""
    from storelens.streaming.topics import late_rows
    lay = _layout()
    page = lambda ts, item: {"mid": 1, "ts": ts, "page_id": "good_list", "last_page_id": "home", "item": item}
    _publish(log_rows(spark, [page(1_000, "a"), page(500_000, "b")]), lay.topic("dwd"), "page")
    q = sj.keyword_stats_job(spark, lay)
    _run(q)
    assert late_rows(q) == 0
    _publish(log_rows(spark, [page(2_000, "c"), page(3_000, "d"), page(30_000, "e"), page(600_000, "f")]), lay.topic("dwd"), "page")
    q = sj.keyword_stats_job(spark, lay)
    _run(q)
    assert late_rows(q) == 3


def test_first_day_state_expires(spark):
    """T1 with a time to live: the state shrinks once a device has been silent, and it then starts anew."""
    day = 86_400_000
    lay = _layout(max_files=1)
    for recs in ([{"mid": m, "ts": 1_000 + m, "is_new": "1", "last_page_id": None} for m in range(20)],
                 [{"mid": 99, "ts": 10 * day, "is_new": "1", "last_page_id": None}],
                 [{"mid": 99, "ts": 10 * day + 5, "is_new": "0", "last_page_id": None}],
                 [{"mid": 0, "ts": 11 * day, "is_new": "1", "last_page_id": None}]):
        _publish(log_rows(spark, recs), lay.topic("log"))
    q = sj.base_log_job(spark, lay, ttl_ms=3 * day)
    _run(q)
    sizes = [p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.stateOperators]
    assert max(sizes) >= 20 and sizes[-1] <= 2
    flags = {(r["mid"], r["ts"]): r["is_new"] for r in _read(spark, lay, "dwd", "page").select("common.mid", "ts", "common.is_new").collect()}
    assert flags["0", 11 * day] == "1"   # forgotten; kept for good it would be 0


def test_devices_share_state_rows(spark):
    """Devices are gathered in buckets, so a micro-batch makes no call and no state row per device; a null id is one too."""
    day = 86_400_000
    mids = [None, *range(3_000)]
    recs = [{"mid": m, "ts": 1_000 + i, "offset": i, "is_new": "1", "last_page_id": None} for i, m in enumerate(mids)]
    recs += [{**r, "ts": r["ts"] + d, "offset": r["offset"] + 10_000 * k} for k, d in ((1, 5), (2, day)) for r in recs]
    lay = _layout(max_files=1)
    rows = log_rows(spark, recs)
    rows = rows.withColumn("common", F.col("common").withField("mid", F.when(F.col("common.mid") != "None", F.col("common.mid"))))
    for part in ("offset < 5000", "offset >= 5000"):
        _publish(rows.where(part), lay.topic("log"))
    for job in (sj.base_log_job, sj.unique_visit_job):
        q = job(spark, lay)
        _run(q)
        assert 0 < max(op.numRowsTotal for p in q.recentProgress for op in p.stateOperators) <= 1_000
    flags = _read(spark, lay, "dwd", "page").groupBy(F.col("ts") >= day, "common.is_new").count().collect()
    assert sorted(tuple(r) for r in flags) == [(False, "1", 6_002), (True, "0", 3_001)]
    visits = _read(spark, lay, "unique_visit").select("common.mid", "ts").collect()
    assert sorted(r["ts"] for r in visits) == sorted([1_000 + i for i in range(3_001)] + [1_000 + i + day for i in range(3_001)])
