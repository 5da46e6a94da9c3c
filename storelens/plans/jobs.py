"""End-to-end jobs over the driver's tables: the shop's three entries (behaviour log -> visitor
statistics; change log -> order/payment wide -> product statistics; SQL keyword and province
statistics) as batch DataFrame plans. Each ``q_*`` takes (spark, sf_dir) and returns a DataFrame.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.operators import aggregates as agg
from storelens.operators import clean, joins, route, stateful, upsert
from storelens.sources import adapters as ad
from storelens.session import checkpoint_root, materialize
from storelens.sources.tables import Tables
from storelens.streaming.topics import read_log_archive, write_log_archive

# Fixed parameters of the registered jobs (the shop's values unless said otherwise).
AS_OF = "2025-01-01 00:00:00"        # replaces the wall clock in stamps and ages (Q17)
WINDOW = "10 seconds"                # statistics window
ORDER_LINE_BOUNDS = (-5, 5)          # J1, ms
SHIP_BOUNDS = (0, 30 * 86_400_000)   # J1 on ship dates: 0..30 days
PAYMENT_BOUNDS = (-1_800_000, 0)     # J2, ms
JUMP_WITHIN = 10_000                 # T3, ms
JUMP_WITHIN_LONG = 3_600_000         # T3 with 1 h (the data's events are hours apart)


# ------------------------------------------------------------------------------------ building blocks

def log_pages(t: Tables) -> DataFrame:
    """Behaviour log -> new-visitor repair -> page records (the page topic)."""
    log = stateful.repair_is_new(ad.behaviour_log(t))
    _, pages, _ = clean.split_log(log)
    return pages


def page_records(t: Tables) -> DataFrame:
    """Page records without the new-visitor repair, for jobs that never look at ``is_new``: no join by device."""
    log = ad.behaviour_log(t)
    return log.where(~clean.is_start(log))


def products(t: Tables) -> DataFrame:
    return joins.product_dimension(ad.dim_sku(t), ad.dim_spu(t), ad.dim_trademark(t), ad.dim_category3(t))


def order_wide_core(t: Tables, timing: str = "offset") -> DataFrame:
    lo, hi = ORDER_LINE_BOUNDS if timing == "offset" else SHIP_BOUNDS
    return joins.order_wide(ad.order_info(t), ad.order_detail(t, timing), lo, hi)


def order_wide_enriched(t: Tables) -> DataFrame:
    return joins.enrich_order_wide(order_wide_core(t), ad.dim_user(t), ad.dim_province(t), products(t), AS_OF)


def payment_wide_of(t: Tables, wide: DataFrame | None = None) -> DataFrame:
    lo, hi = PAYMENT_BOUNDS
    return joins.payment_wide(ad.payment_info(t), wide if wide is not None else order_wide_enriched(t), lo, hi)


# ------------------------------------------------------------------------------------------ queries

def q_province_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: orders x lines (J1) -> province statistics (A3) by province id -> province lookup (J3) of the result."""
    t = Tables(spark, sf_dir)
    return agg.province_stats(order_wide_core(t), WINDOW, AS_OF, province=ad.dim_province(t))


def q_order_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 + J4 + P16: order lines with order, user, province and product attributes."""
    return order_wide_enriched(Tables(spark, sf_dir))


def q_order_ship_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 with line time = ship date and bounds 0..30 days."""
    return order_wide_core(Tables(spark, sf_dir), "ship")


def q_payment_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 + P16: payments x enriched order lines, order time within 30 minutes before payment.

    The lookups are left joins on unique keys, so they commute with J2: the selective payment join
    runs first and only paid lines are enriched."""
    t = Tables(spark, sf_dir)
    pw = payment_wide_of(t, order_wide_core(t))
    return joins.enrich_order_wide(pw, ad.dim_user(t), ad.dim_province(t), products(t), AS_OF)


def q_product_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P13 + W3 + A1 + J5 over the seven product inputs."""
    t = Tables(spark, sf_dir)
    # Lookups are left joins on unique keys: they never drop or repeat a line, so the statistics need
    # only the un-enriched order lines; attributes are looked up once, after the aggregate (J5). The order lines
    # feed two branches; the planner reuses their exchanges.
    wide = order_wide_core(t)
    ev = agg.product_events(pages=page_records(t), order_wide=wide, payment_wide=payment_wide_of(t, wide),
                            favor=ad.favor_info(t), cart=ad.cart_info(t), refund=ad.refund_info(t),
                            comment=ad.comment_info(t))
    return agg.product_stats(ev, WINDOW, AS_OF, products(t))


def q_visitor_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 -> P9 -> (T2, T3) -> P14 + W3 -> A2."""
    t = Tables(spark, sf_dir)
    pages = materialize(log_pages(t), "page_log")
    ev = agg.visitor_events(pages, stateful.daily_unique(pages), stateful.bounces(pages, JUMP_WITHIN))
    return agg.visitor_stats(ev, WINDOW)


def q_keyword_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P11 -> U1 (lateral explode) -> A4 with source SEARCH."""
    t = Tables(spark, sf_dir)
    return agg.keyword_stats(clean.keyword_pages(page_records(t)), WINDOW, agg.KEYWORD_SEARCH, AS_OF)


def q_keyword_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keywords of SPU names x positive click/cart/order counts of the product statistics.

    Only clicks, carts and orders can make those three counts positive; a (window, SKU) group fed
    by the other inputs alone has all three at zero and yields no row. So the statistics are built
    from those three inputs only: the same rows, without the payment join and four other scans."""
    t = Tables(spark, sf_dir)
    ev = agg.product_events(pages=page_records(t), order_wide=order_wide_core(t), cart=ad.cart_info(t))
    return agg.keyword_actions(agg.product_stats(ev, WINDOW, AS_OF, products(t)), AS_OF)


def _log_rows(df: DataFrame) -> DataFrame:
    return df.select("offset", F.col("common.mid").alias("mid"), "ts", F.col("common.is_new").alias("is_new"))


def q_new_visitor_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 over the whole log: every record with its repaired is_new."""
    return _log_rows(stateful.repair_is_new(ad.behaviour_log(Tables(spark, sf_dir))))


def q_unique_visit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First entry page per device and day, taken from the raw log; T1 then repairs those records only."""
    t = Tables(spark, sf_dir)
    visits = stateful.daily_unique(page_records(t))
    return _log_rows(stateful.repair_is_new(visits, history=ad.behaviour_log(t)))


def q_user_jump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3 with the shop's 10 s."""
    return _log_rows(stateful.bounces(log_pages(Tables(spark, sf_dir)), JUMP_WITHIN))


def q_user_jump_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3 with 1 h, where the data's gaps make successors common."""
    return _log_rows(stateful.bounces(log_pages(Tables(spark, sf_dir)), JUMP_WITHIN_LONG))


def q_log_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON log lines parsed with the log schema and flattened."""
    raw = ad.behaviour_log_json(Tables(spark, sf_dir))
    return clean.flatten_log(clean.parse_log(raw))


def q_log_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole log archived as JSON lines by day, and its last day read back from the archive (that day's folder only)."""
    t = Tables(spark, sf_dir)
    path = f"{checkpoint_root(spark).rstrip('/')}/storelens-archive/{uuid.uuid4().hex}"
    write_log_archive(ad.behaviour_log_json(t).select("value"), path)
    last = t.events.agg(F.max("ts").cast("date").cast("string")).first()[0]
    return clean.flatten_log(clean.parse_log(read_log_archive(spark, path, last, last))).drop("offset")


def q_log_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start and page records, labelled by stream in one pass."""
    log = ad.behaviour_log(Tables(spark, sf_dir))
    stream = F.when(clean.is_start(log), F.lit("start")).otherwise(F.lit("page"))
    return log.select(stream.alias("stream"), "offset", F.col("common.mid").alias("mid"),
                      F.col("page.page_id").alias("page_id"), "ts")


def q_display_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: display records with the parent page id."""
    _, _, display = clean.split_log(ad.behaviour_log(Tables(spark, sf_dir)))
    return display


def q_route_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records routed to the dimension and fact branches, columns pruned by rule.
    One pass: the branch is a label on the routed records (other sink types dropped)."""
    t = Tables(spark, sf_dir)
    routed = route.route(ad.change_log(t), ad.rules(spark))
    branch = F.when(F.col("sink_type") == route.SINK_DIMENSION, F.lit("dim")) \
        .when(F.col("sink_type") == route.SINK_FACT, F.lit("fact"))
    return routed.select(branch.alias("branch"), "sink_table", "table", "type", upsert.key_of(routed).alias("id"),
                         F.array_join(F.array_sort(F.map_keys("data")), ",").alias("columns"), "offset") \
        .where(F.col("branch").isNotNull())


def q_dim_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension branch merged into an empty store, as cells."""
    t = Tables(spark, sf_dir)
    dims, _ = route.route_changes(ad.change_log(t), ad.rules(spark))
    return upsert.upsert(None, dims).select("sink_table", "pk", "column", "value")


def q_composite_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders looked up in the user dimension by two columns (user id and nation)."""
    t = Tables(spark, sf_dir)
    o = ad.order_info(t).select("id", "user_id", "province_id")
    return joins.lookup(o, ad.dim_user(t), {"user_id": "id", "province_id": "nation_id"},
                        {"birthday": "birthday", "gender": "gender"})


def q_coalesce_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two partial records of an order, its payment and the order itself, merged by order id. Orders without a
    payment are on one side only, and the two create times differ: the payment's comes first."""
    t = Tables(spark, sf_dir)
    paid = ad.payment_info(t).select(F.col("order_id").alias("id"), "user_id", "create_time", "payment_type")
    placed = ad.order_info(t).select("id", "user_id", "create_time", "province_id", "order_status")
    return joins.coalesce_merge(paid, placed, ["id"])


def q_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: comma tokens of every document text, counted."""
    return agg.token_counts(Tables(spark, sf_dir).documents, "text")


def q_document_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1 over all documents: keyword counts of the whole texts."""
    return agg.corpus_keywords(ad.documents(Tables(spark, sf_dir)))


QUERIES = {
    "province_stats": q_province_stats,
    "order_wide": q_order_wide,
    "order_ship_join": q_order_ship_join,
    "payment_wide": q_payment_wide,
    "product_stats": q_product_stats,
    "visitor_stats": q_visitor_stats,
    "keyword_stats": q_keyword_stats,
    "keyword_actions": q_keyword_actions,
    "new_visitor_repair": q_new_visitor_repair,
    "unique_visit": q_unique_visit,
    "user_jump": q_user_jump,
    "user_jump_1h": q_user_jump_1h,
    "log_parse": q_log_parse,
    "log_archive": q_log_archive,
    "log_split": q_log_split,
    "display_explode": q_display_explode,
    "route_changes": q_route_changes,
    "dim_upsert": q_dim_upsert,
    "composite_lookup": q_composite_lookup,
    "coalesce_merge": q_coalesce_merge,
    "token_counts": q_token_counts,
    "document_keywords": q_document_keywords,
}
