"""Sinks and sources: routed topics (S8), statistics writer replay (S10), rule table (S5), console."""

import json
import tempfile

from pyspark.sql import functions as F

from storelens import schemas
from storelens.streaming import topics


def _tmp(prefix):
    return tempfile.mkdtemp(prefix=prefix, dir="/tmp")


def test_routed_topics_payload_is_data_only(spark):
    d = _tmp("routed-")
    df = spark.createDataFrame([("dwd_a", 1, {"id": "1", "x": "y"}), ("dwd_b", 2, {"id": "2"})],
                               "sink_table string, offset long, data map<string,string>")
    topics.write_routed(df, d)
    back = spark.read.schema("offset long, value string").json(f"{d}/sink_table=dwd_a")
    row = back.select("offset", F.from_json("value", "map<string,string>").alias("m")).first()
    assert row["offset"] == 1 and row["m"] == {"id": "1", "x": "y"}
    assert spark.read.json(d).select("sink_table").distinct().count() == 2


def test_stats_writer_replay_replaces_batch(spark):
    d = _tmp("stats-")
    write = topics.stats_writer(d, ["k", "ct"])
    write(spark.createDataFrame([("a", 1), ("b", 2)], "k string, ct long"), 0)
    write(spark.createDataFrame([("a", 5)], "k string, ct long"), 1)
    write(spark.createDataFrame([("a", 5)], "k string, ct long"), 1)      # replayed batch 1
    got = sorted(tuple(r) for r in spark.read.parquet(d).select("batch_id", "k", "ct").collect())
    assert got == [(0, "a", 1), (0, "b", 2), (1, "a", 5)]


def test_rule_table_reader(spark):
    d = _tmp("rules-")
    spark.createDataFrame([("t", "insert", "hbase", "dim_t", "id", "id", None, 0)], schemas.RULE).write.mode("overwrite").parquet(d)
    rules = topics.read_rules(spark, d)
    assert rules.columns == list(schemas.RULE.fieldNames()) and rules.count() == 1


def test_topic_roundtrip_and_console(spark):
    d = _tmp("topic-")
    recs = topics.as_records(spark.createDataFrame([(7, "a")], "offset long, x string"))
    topics.write_topic(recs, d)
    back = topics.read_topic(spark, d, stream=False)
    assert [(r["offset"], r["value"]) for r in back.collect()] == [(7, '{"x":"a"}')]
    q = topics.write_console(spark.readStream.schema(schemas.RAW).json(d).select("offset"))
    q.processAllAvailable()
    q.stop()


def test_topic_declared_as_sql_table(spark):
    from storelens.plans.sql import create_topic_table
    d = _tmp("ddl-")
    topics.write_topic(topics.as_records(spark.createDataFrame([(1, "good_list", "red ball"), (2, "home", None)],
                                                               "offset long, page_id string, item string")), d)
    create_topic_table(spark, "page_view_ddl", d, "offset BIGINT, value STRING")
    got = spark.sql("""SELECT get_json_object(value, '$.item') AS fullword FROM page_view_ddl
                       WHERE get_json_object(value, '$.page_id') = 'good_list'""").collect()
    assert [r["fullword"] for r in got] == ["red ball"]


def test_materialize_and_clear(spark):
    from storelens.session import clear_materialized, materialize
    df = materialize(spark.range(10).withColumnRenamed("id", "x"), "t")
    assert df.count() == 10
    clear_materialized(spark)
    assert materialize(spark.range(3), "t").count() == 3


def test_stored_rules_last_one_counts(spark):
    """Two stored rules for one table and type: the later by ``rule_order`` routes, whatever its values and file order."""
    from storelens.operators import route
    d = _tmp("rules-")
    rows = [("t", "insert", "hbase", "dim_z", "", "id", None, 1), ("t", "insert", "kafka", "dwd_a", "", "id", None, 2)]
    for r in reversed(rows):
        spark.createDataFrame([r], schemas.RULE).write.mode("append").parquet(d)
    changes = spark.createDataFrame([("t", "insert", {"id": "1"}, 0)], "table string, type string, data map<string,string>, ts long")
    got = route.route(changes, topics.read_rules(spark, d)).collect()
    assert [(r["sink_type"], r["sink_table"]) for r in got] == [("kafka", "dwd_a")]


def test_log_archive_replaces_days_and_reads_one(spark):
    d = _tmp("archive-")
    line = lambda day, x: (json.dumps({"ts": day * 86_400_000 + 5, "x": x}),)
    put = lambda rows: topics.write_log_archive(spark.createDataFrame(rows, "value string"), d)
    put([line(0, "a"), line(1, "b"), line(1, "c"), ("no json",)])
    put([line(1, "B")])   # day 1 again; day 0 stays
    day = topics.read_log_archive(spark, d, "1970-01-02", "1970-01-02")
    assert [json.loads(r["value"])["x"] for r in day.collect()] == ["B"]
    assert sorted(str(r["dt"]) for r in topics.read_log_archive(spark, d).collect()) == ["1970-01-01", "1970-01-02", "None"]
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "1970-01-02" in plan


def test_stream_table_by_ddl_from_the_latest_position(spark):
    """A declared table as a stream source; "latest" skips what the topic holds at the first start, and a restart skips
    nothing more."""
    import time

    from storelens.streaming import jobs as sj
    lay = sj.Layout(_tmp("latest-"))

    def put(word, ts):
        time.sleep(1.1)
        page = {"page": {"page_id": "good_list", "item": word}, "ts": ts}
        spark.createDataFrame([(0, json.dumps(page), "page")], "offset long, value string, kind string").coalesce(1) \
            .write.mode("append").partitionBy("kind").json(lay.topic("dwd"))

    def run():
        q = sj.keyword_stats_sql_job(spark, lay, "page_log_latest", "10 seconds", "2025-01-01 00:00:00", start="latest")
        q.awaitTermination()
        assert q.exception() is None

    put("old", 1_000)
    sj.page_table(spark, lay, "page_log_latest")
    run()
    put("new words", 20_000)
    run()
    put("more", 40_000)
    put("end", 900_000)
    run()
    spark.sql("DROP TABLE page_log_latest")
    got = sorted((r["keyword"], r["ct"]) for r in spark.read.parquet(lay.stats("keyword_stats_sql")).collect())
    assert got == [("more", 1), ("new", 1), ("words", 1)]


def test_lateral_functions_stay_generates(spark):
    from storelens.plans import sql
    sql.create_table_functions(spark)
    df = spark.sql("""SELECT k.word, a.ct, a.source FROM VALUES ('Red ball', 2L, 0L, 1L), ('', 1L, 1L, 1L), (NULL, 1L, 1L, 1L)
                      AS t(name, c, b, o), LATERAL ik_analyze(name) AS k, LATERAL keywordProductC2R(c, b, o) AS a""")
    assert sorted(map(tuple, df.collect())) == [("ball", 1, "ORDER"), ("ball", 2, "CLICK"), ("red", 1, "ORDER"), ("red", 2, "CLICK")]
    big = spark.sql("SELECT k.word FROM range(10) AS r, LATERAL ik_analyze(CAST(r.id AS STRING)) AS k")
    plan = big._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan and "Join" not in plan and "Python" not in plan


def test_lateness_of_wall_clocks_is_that_of_their_ms(spark, tmp_path):
    """Time texts are compared as wall clocks and only a file's ends become ms: the same bound, sentinels and bad texts left out."""
    import os

    from storelens.functions.time import epoch_ms
    from storelens.streaming.jobs import measured_lateness
    from storelens.streaming.publish import SENTINEL_MS, SENTINEL_TEXT
    files = (["2024-01-01 00:00:10", "2024-01-01 00:00:20.0075"], ["2024-01-01 00:00:05.0025", "no time", SENTINEL_TEXT],
             ["2024-01-01 00:00:30"], [SENTINEL_TEXT, None])
    path = f"{tmp_path}/t"
    os.makedirs(path)
    for i, times in enumerate(files):
        with open(f"{path}/{i}.json", "w") as f:
            f.writelines(json.dumps({"offset": i, "value": json.dumps({"at": t})}) + "\n" for t in times)
        os.utime(f"{path}/{i}.json", (1000 + i, 1000 + i))
    text = F.get_json_object("value", "$.at").try_cast("timestamp_ntz")
    as_ms = measured_lateness(spark, path, epoch_ms(text), before=SENTINEL_MS)
    assert as_ms == 15_005 and measured_lateness(spark, path, text, before=SENTINEL_MS, to_ms=epoch_ms) == as_ms


def test_chains_write_state_without_reading_it(spark):
    """The registered chains do not look every state row up before it is written, and put the session's settings back."""
    from storelens.streaming import run
    key = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
    before = spark.conf.get(key, None)
    with run._state_partitions(spark):
        assert spark.conf.get(key) == "false"
    assert spark.conf.get(key, None) == before
