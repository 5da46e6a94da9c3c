"""Record schemas of the shop (see FIXTURES.md part 1) as StructType constants."""

from __future__ import annotations

from pyspark.sql import types as T

S, L = T.StringType(), T.LongType()
MONEY = T.DecimalType(18, 2)
MONEY_SUM = T.DecimalType(28, 2)

COMMON = T.StructType([T.StructField(n, S) for n in ("mid", "vc", "ch", "ar", "is_new")])
START = T.StructType([T.StructField("entry", S), T.StructField("loading_time", L)])
PAGE = T.StructType([T.StructField("page_id", S), T.StructField("last_page_id", S),
                     T.StructField("item", S), T.StructField("during_time", L)])
DISPLAY = T.StructType([T.StructField("item_type", S), T.StructField("item", S)])

# Behaviour log line (one JSON object per line / topic record).
LOG = T.StructType([
    T.StructField("common", COMMON),
    T.StructField("start", START),
    T.StructField("page", PAGE),
    T.StructField("displays", T.ArrayType(DISPLAY)),
    T.StructField("ts", L),
])

# Database change record: the changed row's columns differ per table, so ``data`` is a text map.
CHANGE = T.StructType([
    T.StructField("table", S),
    T.StructField("type", S),
    T.StructField("data", T.MapType(S, S)),
    T.StructField("ts", L),
])

# Routing rule table, snake_case as stored.
RULE = T.StructType([T.StructField(n, S) for n in (
    "source_table", "operate_type", "sink_type", "sink_table", "sink_columns", "sink_pk", "sink_extend")]
    + [T.StructField("rule_order", L)])  # the order in which the rules were stored: of several for a table and type the last counts

# Raw topic record: payload text plus its position in the topic (arrival order).
RAW = T.StructType([T.StructField("value", S), T.StructField("offset", L)])

VISITOR_STATS_COLUMNS = ("stt", "edt", "vc", "ch", "ar", "is_new",
                         "uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum", "ts")
PRODUCT_MEASURES = ("display_ct", "click_ct", "favor_ct", "cart_ct", "order_sku_num", "order_amount",
                    "order_ct", "payment_amount", "paid_order_ct", "refund_order_ct", "refund_amount",
                    "comment_ct", "good_comment_ct")
PRODUCT_STATS_COLUMNS = ("stt", "edt", "sku_id", "sku_name", "sku_price", "spu_id", "spu_name", "tm_id",
                         "tm_name", "category3_id", "category3_name") + PRODUCT_MEASURES + ("ts",)
PROVINCE_STATS_COLUMNS = ("stt", "edt", "province_id", "province_name", "area_code", "iso_code",
                          "iso_3166_2", "order_amount", "order_count", "ts")
KEYWORD_STATS_COLUMNS = ("keyword", "ct", "source", "stt", "edt", "ts")
