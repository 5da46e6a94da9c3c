"""Plan properties that matter at scale, read from the executed (adaptive) plans at sf0.001."""

import pytest

from storelens.plans.jobs import QUERIES

SF = "/root/testdata/sf0.001"
BATCH = ["province_stats", "order_wide", "payment_wide", "product_stats", "visitor_stats", "keyword_stats",
         "new_visitor_repair", "unique_visit", "user_jump", "route_changes", "dim_upsert", "document_keywords",
         "token_counts", "log_parse"]


def _plan(spark, name):
    df = QUERIES[name](spark, SF)
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_python_on_batch_plans(spark, name):
    p = _plan(spark, name)
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "FlatMapGroupsInPandas" not in p


def test_filters_reach_the_scan(spark):
    assert "EqualTo(o_orderstatus,F)" in _plan(spark, "payment_wide")
    assert "ReadSchema: struct<text:string>" in _plan(spark, "document_keywords")


def test_no_table_is_read_in_part(spark):
    """No range, remainder or language filter keeps rows of a table out of a query."""
    for name in ("keyword_stats", "product_stats", "document_keywords"):
        p = _plan(spark, name)
        assert "LessThan(p_partkey" not in p and "p_partkey % 10" not in p and "EqualTo(lang" not in p


def test_product_distinct_counts_without_expand(spark):
    assert "Expand" not in _plan(spark, "product_stats")


def test_first_day_is_a_hash_aggregate(spark):
    p = _plan(spark, "new_visitor_repair")
    assert "HashAggregate" in p and "SortAggregate" not in p and "Window" not in p


def test_routing_scans_changes_once(spark):
    p = _plan(spark, "route_changes")
    assert p.count("FileScan parquet") == 2   # customer once, part once


def test_unique_visits_combine_before_their_exchange(spark):
    """A partial min per (device, day) below the exchange, straight over the log's rows, so a hot (device, day) sends one
    record a task; the repair joins the few visits afterwards."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = QUERIES["unique_visit"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = p.splitlines()
    final = next(i for i, x in enumerate(lines) if "Aggregate(key=[_k" in x and "_day" in x and "functions=[min(" in x)
    below = lines[final + 1:]
    exchange = next(i for i, x in enumerate(below) if "Exchange hashpartitioning(_k" in x and "_day" in x)
    partial = next(i for i, x in enumerate(below) if "partial_min(" in x and "_day" in x)
    assert exchange < partial and "SortMergeJoin" in "".join(lines[:final])


def test_bounces_read_the_log_once(spark):
    p = _plan(spark, "user_jump")
    first = QUERIES["new_visitor_repair"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    scans = lambda x: x.count("FileScan parquet")
    assert scans(QUERIES["user_jump"](spark, SF)._jdf.queryExecution().executedPlan().toString()) == scans(first) and "Union" not in p
