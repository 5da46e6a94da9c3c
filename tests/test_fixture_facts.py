"""Counts FIXTURES.md states for the stand-ins at sf0.01 (counted there with DuckDB)."""

from pyspark.sql import functions as F

from storelens.operators import clean, joins, stateful
from storelens.plans import jobs
from storelens.sources import adapters as ad
from storelens.sources.tables import Tables

SF = "/root/testdata/sf0.01"


def test_new_visitor_repair_changes(spark):
    log = ad.behaviour_log(Tables(spark, SF))
    fixed = stateful.repair_is_new(log).select("offset", F.col("common.is_new").alias("after"))
    both = log.select("offset", F.col("common.is_new").alias("before")).join(fixed, "offset")
    assert both.where("before = '1'").count() == 4939
    assert both.where("before = '1' AND after = '0'").count() == 4681


def test_unique_visit_and_jump_counts(spark):
    pages = jobs.log_pages(Tables(spark, SF))
    entries = pages.where(clean.is_entry("page.last_page_id", empty_is_entry=True))
    assert entries.count() == 1986
    assert stateful.daily_unique(pages).count() == 1598
    assert stateful.bounces(pages, 3_600_000).count() == 1845


def test_interval_join_counts(spark):
    t = Tables(spark, SF)
    assert jobs.order_wide_core(t).count() == 42812
    assert jobs.order_wide_core(t, "ship").count() == 725
    pay, orders = ad.payment_info(t), ad.order_info(t)
    assert pay.count() == 4933
    at_order_level = joins.interval_join(pay.select("order_id", "callback_ts"), orders.select("id", "create_ts"),
                                         {"order_id": "id"}, "callback_ts", "create_ts", -1_800_000, 0)
    assert at_order_level.count() == 2554
    # through the order lines (lines 2-6 of an order survive J1): 2,395 payments (DuckDB gives the same)
    pw = jobs.payment_wide_of(t, jobs.order_wide_core(t))
    assert pw.select("payment_id").distinct().count() == 2395


def test_display_rows(spark):
    _, _, display = clean.split_log(ad.behaviour_log(Tables(spark, SF)))
    assert display.count() == 1913


def test_swapped_dimension_key_changes_result(spark):
    """Mutation check: the brand looked up by the category id (the shop's Q4 slip) must differ."""
    t = Tables(spark, SF)
    sku, tm = ad.dim_sku(t), ad.dim_trademark(t)
    right = joins.lookup(sku, tm, {"tm_id": "id"}, {"tm_name": "tm_name"})
    wrong = joins.lookup(sku, tm, {"category3_id": "id"}, {"tm_name": "tm_name"})
    assert right.where(F.col("tm_name").isNull()).count() == 0
    assert wrong.where(F.col("tm_name").isNotNull()).count() == 0
