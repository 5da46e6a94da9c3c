"""Windowed statistics (A1-A6) with their input normalisation (P13, P14), union (W3), stamping
and the two table functions (U1 keyword tokens, U2 columns-to-rows).

Every aggregate is a plain ``groupBy(window, keys)``: Catalyst plans a partial aggregate before the
shuffle and a final one after, which is the incremental reduce of the stream jobs. Windows are
tumbling, epoch-aligned ``[start, end)`` over the event-time instant; ``stt``/``edt`` are printed on the
wall clock of ``zone``. The same functions run on streams: pass the watermarked ``time_col``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens import schemas
from storelens.functions.text import comma_tokens, keyword_tokens
from storelens.functions.time import epoch_ms, event_time, format_ts, local_time, parse_ms, window_bounds
from storelens.operators.clean import is_entry
from storelens.operators.joins import lookup

# Keyword sources and the good-comment appraisal code.
KEYWORD_SEARCH, KEYWORD_CLICK, KEYWORD_CART, KEYWORD_ORDER = "SEARCH", "CLICK", "CART", "ORDER"
APPRAISE_GOOD = "1201"
GOOD_DETAIL, SKU_ITEM = "good_detail", "sku_id"


def stamp_ms(as_of: str | None) -> Column:
    """P18 ``ts``: the wall clock of the run, or the fixed ``as_of`` (UTC ``yyyy-MM-dd HH:mm:ss``)."""
    if as_of is None:
        return F.unix_millis(F.current_timestamp())
    return epoch_ms(F.lit(as_of).cast("timestamp_ntz"))


def tumble(ts_ms: str | Column, size: str, time_col: str | None = None) -> Column:
    """Epoch-aligned tumbling window of an epoch-ms column. On a stream pass ``time_col``, the
    watermarked event-time column (see ``storelens.streaming.jobs.watermarked``)."""
    if time_col:
        return F.window(F.col(time_col), size)
    c = F.col(ts_ms) if isinstance(ts_ms, str) else ts_ms
    return F.window(event_time(c), size)


_UNIT_MS = {"millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000,
            "week": 604_800_000}


def size_ms(size: str) -> int | None:
    """``'10 seconds'`` / ``'1 day 2 hours'`` -> milliseconds; None if not a fixed-length interval."""
    parts = re.findall(r"(\d+)\s*([a-z]+?)s?\b", size.strip().lower())
    if not parts or re.sub(r"(\d+)\s*[a-z]+", "", size.strip().lower()).strip():
        return None
    total = 0
    for n, unit in parts:
        if unit not in _UNIT_MS:
            return None
        total += int(n) * _UNIT_MS[unit]
    return total


def _tumbling(size: str, zone: str, time_col: str | None, ts_ms: str = "ts") -> tuple[Column, Column, Column]:
    """(grouping key ``_w``, ``stt``, ``edt``) of an epoch-aligned tumbling window.

    Batch: the key is the window start in epoch ms, ``ts - pmod(ts, size)`` (a long groups about 2.5x
    faster than the ``window`` struct). Streams: ``F.window`` over the watermarked ``time_col``, which
    is what lets Spark close windows and drop their state."""
    width = size_ms(size)
    if time_col or width is None:
        key = (F.window(F.col(time_col), size) if time_col else tumble(ts_ms, size)).alias("_w")
        stt, edt = window_bounds("_w", zone)
        return key, stt, edt
    key = (F.col(ts_ms) - F.pmod(F.col(ts_ms), F.lit(width))).alias("_w")
    return (key, format_ts(local_time(F.col("_w"), zone)).alias("stt"),
            format_ts(local_time(F.col("_w") + F.lit(width), zone)).alias("edt"))


def _cents(c: str | Column) -> Column:
    """Money (decimal, 2 places) as whole cents: sums run on fixed-width longs, exactly."""
    return (F.col(c) if isinstance(c, str) else c) * 100


def _from_cents(c: str | Column) -> Column:
    return ((F.col(c) if isinstance(c, str) else c).cast("decimal(28,0)") / 100).cast(schemas.MONEY_SUM)


def _union(parts: Mapping[str, DataFrame], watermark: Callable[[DataFrame, str], DataFrame] | None) -> DataFrame:
    """W3; ``watermark`` gets each input with its name."""
    out = None
    for name, p in parts.items():
        p = watermark(p, name) if watermark else p
        out = p if out is None else out.unionByName(p)
    return out


def _zero(name: str, dtype=None) -> Column:
    return F.lit(0).cast(dtype or "long").alias(name)


# ------------------------------------------------------------------------------ product statistics

_LONG_MEASURES = ("display_ct", "click_ct", "favor_ct", "cart_ct", "order_sku_num", "comment_ct", "good_comment_ct")
_MONEY_MEASURES = ("order_amount", "payment_amount", "refund_amount")
_ID_KINDS = {"order_ct": "order", "paid_order_ct": "paid", "refund_order_ct": "refund"}


def _product_row(sku: Column, ts: Column, kind: str | None = None, oid: Column | None = None,
                 **measures: Column) -> list[Column]:
    out = [sku.cast("long").alias("sku_id"), ts.cast("long").alias("ts")]
    for m in _LONG_MEASURES:
        out.append(measures[m].cast("long").alias(m) if m in measures else _zero(m))
    for m in _MONEY_MEASURES:
        out.append(measures[m].cast(schemas.MONEY).alias(m) if m in measures else _zero(m, schemas.MONEY))
    out.append((F.lit(kind) if kind else F.lit(None).cast("string")).alias("id_kind"))
    out.append((oid.cast("long") if oid is not None else F.lit(None).cast("long")).alias("id_value"))
    return out


def product_events(pages: DataFrame | None = None, order_wide: DataFrame | None = None,
                   payment_wide: DataFrame | None = None, favor: DataFrame | None = None,
                   cart: DataFrame | None = None, refund: DataFrame | None = None,
                   comment: DataFrame | None = None, zone: str = "UTC",
                   watermark: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """P13 + W3: the seven inputs as one measure schema (zeros elsewhere), unioned by name. On streams
    ``watermark`` is set on each input before the union, so the slowest input closes the windows."""
    one = F.lit(1)
    parts: dict[str, DataFrame] = {}
    if pages is not None:
        # One pass over the page log: the click of a detail page and its product displays.
        hit = F.struct(F.col("page.item").alias("sku"), F.lit(1).alias("click"), F.lit(0).alias("shown"))
        shown = F.transform(F.filter(F.coalesce(F.col("displays"), F.array()), lambda d: d["item_type"] == SKU_ITEM),
                            lambda d: F.struct(d["item"].alias("sku"), F.lit(0).alias("click"), F.lit(1).alias("shown")))
        hits = F.concat(F.when(F.col("page.page_id") == GOOD_DETAIL, F.array(hit)).otherwise(F.array()), shown)
        ex = pages.select(F.explode(hits).alias("_h"), "ts")
        parts["pages"] = ex.select(*_product_row(F.col("_h.sku"), F.col("ts"), click_ct=F.col("_h.click"),
                                                 display_ct=F.col("_h.shown")))
    if order_wide is not None:
        parts["order_wide"] = order_wide.select(*_product_row(
            F.col("sku_id"), parse_ms(F.col("create_time"), zone), "order", F.col("order_id"),
            order_sku_num=F.col("sku_num"), order_amount=F.col("split_total_amount")))
    if payment_wide is not None:
        parts["payment_wide"] = payment_wide.select(*_product_row(
            F.col("sku_id"), parse_ms(F.col("payment_create_time"), zone), "paid", F.col("order_id"),
            payment_amount=F.col("split_total_amount")))
    if favor is not None:
        parts["favor"] = favor.select(*_product_row(F.col("sku_id"), parse_ms(F.col("create_time"), zone), favor_ct=one))
    if cart is not None:
        parts["cart"] = cart.select(*_product_row(F.col("sku_id"), parse_ms(F.col("create_time"), zone), cart_ct=one))
    if refund is not None:
        parts["refund"] = refund.select(*_product_row(
            F.col("sku_id"), parse_ms(F.col("create_time"), zone), "refund", F.col("order_id"),
            refund_amount=F.col("refund_amount")))
    if comment is not None:
        good = F.when(F.col("appraise") == APPRAISE_GOOD, 1).otherwise(0)
        parts["comment"] = comment.select(*_product_row(F.col("sku_id"), parse_ms(F.col("create_time"), zone),
                                                  comment_ct=one, good_comment_ct=good))
    if not parts:
        raise ValueError("no input")
    return _union(parts, watermark)


def product_stats(events: DataFrame, window: str = "10 seconds", as_of: str | None = None,
                  products: DataFrame | None = None, zone: str = "UTC", time_col: str | None = None) -> DataFrame:
    """A1 (+ J5): per SKU and window, 10 sums and 3 distinct order counts, then product attributes.

    First per (window, sku, kind, order id) - which also pre-sums
    every measure - then per (window, sku), where counting a kind's order ids is the distinct count.
    That avoids the row expansion Spark plans for several distinct aggregates, and both levels
    combine map-side. Streams (``time_col``) run the same two levels as two stateful aggregates in append mode:
    the state holds one fixed-width row per (window, sku, kind, order id), never a set of ids.
    Attributes are looked up after the aggregate (fewer rows to join).
    """
    w, stt, edt = _tumbling(window, zone, time_col)
    sums = [F.sum(m).alias(m) for m in _LONG_MEASURES] + \
           [F.sum(_cents(m).cast("long")).alias(m) for m in _MONEY_MEASURES]
    level1 = events.groupBy(w, "sku_id", "id_kind", "id_value").agg(*sums)
    counts = [F.count(F.when(F.col("id_kind") == k, F.col("id_value"))).alias(n) for n, k in _ID_KINDS.items()]
    grouped = level1.groupBy("_w", "sku_id")
    agg = grouped.agg(*[F.sum(m).cast("long").alias(m) for m in _LONG_MEASURES],
                      *[_from_cents(F.sum(m)).alias(m) for m in _MONEY_MEASURES], *counts)
    out = agg.select(stt, edt, "sku_id", *schemas.PRODUCT_MEASURES, stamp_ms(as_of).alias("ts"))
    return out if products is None else with_product(out, products)


def with_product(stats: DataFrame, products: DataFrame) -> DataFrame:
    """The product attributes of each SKU's statistics; a miss keeps the row."""
    out = lookup(stats, products, {"sku_id": "id"},
                 {"sku_name": "sku_name", "price": "sku_price", "spu_id": "spu_id", "spu_name": "spu_name",
                  "tm_id": "tm_id", "tm_name": "tm_name", "category3_id": "category3_id",
                  "category3_name": "category3_name"})
    return out.select(*schemas.PRODUCT_STATS_COLUMNS)


# ------------------------------------------------------------------------------ visitor statistics

def visitor_events(pages: DataFrame, unique_visits: DataFrame | None = None, jumps: DataFrame | None = None,
                   watermark: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """P14 + W3: page views (pv, duration), unique visits (uv), session entries (sv), jumps (uj). On streams
    ``watermark`` is set on each input before the union, so the slowest input closes the windows.

    Session entries are pages without a previous page, null or empty (the intent; Q1)."""
    def row(df: DataFrame, uv=0, pv=0, sv=0, uj=0, dur: Column | None = None) -> DataFrame:
        return df.select(
            F.col("common.vc").alias("vc"), F.col("common.ch").alias("ch"), F.col("common.ar").alias("ar"),
            F.col("common.is_new").alias("is_new"),
            *[(v if isinstance(v, Column) else F.lit(v)).cast("long").alias(n)
              for n, v in (("uv_ct", uv), ("pv_ct", pv), ("sv_ct", sv), ("uj_ct", uj))],
            (F.coalesce(dur, F.lit(0)) if dur is not None else F.lit(0)).cast("long").alias("dur_sum"),
            F.col("ts"))
    # A page view and its session entry are summed into the same groups, so one row carries both.
    sv = F.when(is_entry("page.last_page_id", empty_is_entry=True), 1).otherwise(0)
    parts = {"pages": row(pages, pv=1, sv=sv, dur=F.col("page.during_time"))}
    if unique_visits is not None:
        parts["unique_visits"] = row(unique_visits, uv=1)
    if jumps is not None:
        parts["jumps"] = row(jumps, uj=1)
    return _union(parts, watermark)


def visitor_stats(events: DataFrame, window: str = "10 seconds", zone: str = "UTC",
                  time_col: str | None = None) -> DataFrame:
    """A2: per (ar, ch, vc, is_new) and window: uv, pv, sv, uj and duration sums.

    The shop's record keeps the ``ts`` of the first record reduced into the window; with arrival in
    time order that is the window's earliest ``ts``, so ``ts`` = min(ts) (deterministic)."""
    w, stt, edt = _tumbling(window, zone, time_col)
    agg = events.groupBy(w, "vc", "ch", "ar", "is_new").agg(
        *[F.sum(c).cast("long").alias(c) for c in ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")],
        F.min("ts").alias("ts"))
    return agg.select(stt, edt, "vc", "ch", "ar", "is_new", "uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum", "ts")


# ----------------------------------------------------------------------------- province statistics

PROVINCE_ATTRIBUTES = {"name": "province_name", "area_code": "province_area_code", "iso_code": "province_iso_code",
                       "iso_3166_2": "province_3166_2_code"}


def province_stats(order_wide: DataFrame, window: str = "10 seconds", as_of: str | None = None,
                   zone: str = "UTC", ts_col: str = "create_ts", time_col: str | None = None,
                   province: DataFrame | None = None) -> DataFrame:
    """A3: per province and window, distinct orders and the sum of line amounts.

    In two levels, (window, province, order) then (window, province): both combine map-side, and on streams
    (``time_col``) the state holds a fixed-width row per order, never a set of ids. With ``province``, the dimension, the
    lines need only carry ``province_id``: the aggregates run on that one key and their few rows are looked up."""
    w, stt, edt = _tumbling(window, zone, time_col, ts_col)
    keys = ["province_id"] if province is not None else ["province_id", *PROVINCE_ATTRIBUTES.values()]
    orders = order_wide.groupBy(w, *keys, "order_id").agg(F.sum(_cents("split_total_amount").cast("long")).alias("_c"))
    agg = orders.groupBy("_w", *keys).agg(F.count("order_id").alias("order_count"), _from_cents(F.sum("_c")).alias("order_amount"))
    if province is not None:
        agg = lookup(agg, province, {"province_id": "id"}, PROVINCE_ATTRIBUTES)
    return agg.select(stt, edt, "province_id", "province_name", F.col("province_area_code").alias("area_code"),
                      F.col("province_iso_code").alias("iso_code"), F.col("province_3166_2_code").alias("iso_3166_2"),
                      "order_amount", "order_count", stamp_ms(as_of).alias("ts"))


# ------------------------------------------------------------------------------ keyword statistics

def explode_keywords(df: DataFrame, text: str, out: str = "keyword") -> DataFrame:
    """U1 + J7: one row per keyword token of ``text``; a text without tokens gives no row."""
    return df.select("*", F.explode(keyword_tokens(text)).alias(out))


def keyword_stats(search: DataFrame, window: str = "10 seconds", source: str = KEYWORD_SEARCH,
                  as_of: str | None = None, zone: str = "UTC", time_col: str | None = None) -> DataFrame:
    """A4 (+ P12): keyword counts per window from ``fullword, ts`` rows (see ``keyword_pages``)."""
    kw = explode_keywords(search, "fullword")
    w, stt, edt = _tumbling(window, zone, time_col)
    agg = kw.groupBy(w, "keyword").agg(F.count(F.lit(1)).alias("ct"))
    return agg.select("keyword", "ct", F.lit(source).alias("source"), stt, edt, stamp_ms(as_of).alias("ts"))


def unpivot_positive(df: DataFrame, columns: Mapping[str, str], value: str = "ct", label: str = "source") -> DataFrame:
    """One row (value, label) per listed column whose value is > 0; none when all are 0."""
    pairs = F.array(*[F.struct(F.col(c).cast("long").alias(value), F.lit(lab).alias(label)) for c, lab in columns.items()])
    keep = [c for c in df.columns if c not in columns]
    return df.select(*keep, F.explode(F.filter(pairs, lambda x: x[value] > 0)).alias("_u")) \
        .select(*keep, F.col(f"_u.{value}").alias(value), F.col(f"_u.{label}").alias(label))


def keyword_actions(product_stats_df: DataFrame, as_of: str | None = None) -> DataFrame:
    """Product name keywords x (clicks, carts, orders) > 0, no aggregate."""
    base = product_stats_df.select("spu_name", "click_ct", "cart_ct", "order_ct", "stt", "edt")
    kw = explode_keywords(base, "spu_name")
    un = unpivot_positive(kw, {"click_ct": KEYWORD_CLICK, "cart_ct": KEYWORD_CART, "order_ct": KEYWORD_ORDER})
    return un.select("keyword", "ct", "source", "stt", "edt", stamp_ms(as_of).alias("ts"))


def token_counts(lines: DataFrame, text: str = "value") -> DataFrame:
    """A5: comma-separated tokens and their counts (batch result of the running per-token sum)."""
    return lines.select(F.explode(comma_tokens(text)).alias("token")) \
        .groupBy("token").agg(F.count(F.lit(1)).alias("ct"))


def corpus_keywords(docs: DataFrame, text: str = "text") -> DataFrame:
    """U1 over whole documents: keyword counts of a corpus (a word count, combined map-side)."""
    return docs.select(F.explode(keyword_tokens(text)).alias("keyword")) \
        .groupBy("keyword").agg(F.count(F.lit(1)).alias("ct"))
