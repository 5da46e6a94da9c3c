from pyspark.sql import functions as F

from helpers import log_rows, rows_of
from storelens.operators import clean
from storelens.sources import adapters as ad
from storelens.sources.tables import Tables


def test_split_start_page_and_displays(spark):
    log = log_rows(spark, [
        {"mid": 1, "ts": 1, "start": True},                                   # start record
        {"mid": 1, "ts": 2, "page_id": "home", "displays": None},             # page, null displays
        {"mid": 1, "ts": 3, "page_id": "good_list", "displays": []},          # page, empty displays
        {"mid": 1, "ts": 4, "page_id": "good_list", "displays": [("sku_id", "7"), ("activity_id", "8")]},
    ])
    start, page, display = clean.split_log(log)
    assert rows_of(start, "ts") == [(1,)]
    assert rows_of(page, "ts") == [(2,), (3,), (4,)]
    assert rows_of(display, "item_type", "item", "page_id") == [("activity_id", "8", "good_list"),
                                                                ("sku_id", "7", "good_list")]


def test_empty_start_object_is_a_page(spark):
    log = log_rows(spark, [{"mid": 1, "ts": 1, "page_id": "home"}])
    log = log.withColumn("start", F.struct(F.lit(None).cast("string").alias("entry"),
                                           F.lit(None).cast("long").alias("loading_time")))
    start, page, _ = clean.split_log(log)
    assert start.count() == 0 and page.count() == 1


def test_parse_roundtrip_and_bad_json(spark):
    raw = spark.createDataFrame([('{"common":{"mid":"9","is_new":"1"},"page":{"page_id":"home"},"ts":5}', 0),
                                 ("not json", 1)], "value string, offset long")
    flat = clean.flatten_log(clean.parse_log(raw))
    got = {r["offset"]: (r["mid"], r["page_id"], r["ts"]) for r in flat.collect()}
    assert got[0] == ("9", "home", 5)
    assert got[1] == (None, None, None)


def test_keyword_pages_filter(spark):
    log = log_rows(spark, [{"mid": 1, "ts": 1, "page_id": "good_list", "item": "red ball"},
                           {"mid": 1, "ts": 2, "page_id": "good_list", "item": None},
                           {"mid": 1, "ts": 3, "page_id": "home", "item": "x"}])
    assert rows_of(clean.keyword_pages(log), "fullword", "ts") == [("red ball", 1)]


def test_stand_in_log_facts(spark):
    t = Tables(spark, "/root/testdata/sf0.01")
    start, page, display = clean.split_log(ad.behaviour_log(t))
    assert display.count() == 1913
    assert start.count() + page.count() == 10000


def test_start_key_however_spelled(spark):
    texts = {'{"start":{"entry":"icon"}}': True, '{"\\u0073tart":{"entry":"icon"}}': True, '{"start":{}}': False, '{"page":{"item":"start"}}': False,
             '{"page":{}}': False, 'no json': False, None: False}
    rows = spark.createDataFrame([(t,) for t in texts], "value string")
    got = {r["value"]: r["s"] for r in rows.select("value", clean.is_start(rows).alias("s")).collect()}
    assert got == texts


def test_a_text_is_parsed_once_to_set_a_key(spark):
    from storelens.functions.json_text import set_key
    rows = spark.createDataFrame([('{"common":{"is_new":"1","x":2},"y":[1]}',), ("[1]",)], "value string")
    out = rows.select(set_key("value", ("common", "is_new"), F.lit("0")).alias("v"))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("parseJson(value") <= 1
    assert [r["v"] for r in out.collect()] == ['{"common":{"is_new":"0","x":2},"y":[1]}', "[1]"]
