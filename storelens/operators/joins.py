"""Joins: interval joins (J1, J2), dimension lookups (J3-J6), wide-record constructors.

Broadcast policy. A side is broadcast by hint only when its size is bounded: either by a key domain
the caller states, or by a row count taken at run time (``bounded_broadcast``). Dimensions that grow
with the data get no hint; AQE then measures the materialised shuffle and turns the join into a
broadcast only if the measured side is small, and splits hot keys of a sort-merge join otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.functions.time import age_years
from storelens.schemas import MONEY, S


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` only if it has at most ``max_rows`` rows (checked with a bounded ``limit``)."""
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def _pairs(on) -> list[tuple[str, str]]:
    if isinstance(on, str):
        return [(on, on)]
    if isinstance(on, Mapping):
        return list(on.items())
    return [(p, p) if isinstance(p, str) else tuple(p) for p in on]


def interval_join(left: DataFrame, right: DataFrame, on, left_ts: str, right_ts: str,
                  lower: int, upper: int, how: str = "inner",
                  time_cols: tuple[str, str] | None = None) -> DataFrame:
    """Equality on ``on`` and ``right_ts`` in [left_ts + lower, left_ts + upper], inclusive.

    Times and bounds are epoch milliseconds. The equality keys make it a hash-partitioned join; the
    range is a residual filter. On streams pass ``time_cols``, the watermarked event-time columns of
    the two sides: the same range is then stated on them, which is what lets Spark evict join state.
    Column names of the two sides must not collide except in the keys.
    """
    cond: list[Column] = [left[a] == right[b] for a, b in _pairs(on)]
    if time_cols:
        lt, rt = left[time_cols[0]], right[time_cols[1]]
        lo = F.expr(f"INTERVAL '{abs(lower)}' MILLISECOND")
        hi = F.expr(f"INTERVAL '{abs(upper)}' MILLISECOND")
        cond.append(rt >= (lt - lo if lower < 0 else lt + lo))
        cond.append(rt <= (lt - hi if upper < 0 else lt + hi))
    else:
        cond.append(right[right_ts].between(left[left_ts] + F.lit(lower), left[left_ts] + F.lit(upper)))
    return left.join(right, cond, how)


def lookup(facts: DataFrame, dim: DataFrame, on, attributes: Mapping[str, str] | Sequence[str],
           broadcast: bool | int | None = None) -> DataFrame:
    """Left lookup by one or several key columns; a missing key keeps the fact with nulls.

    ``on`` maps fact columns to dimension columns; ``attributes`` maps dimension columns to output
    names. ``broadcast``: True = the caller states a bound; an int = broadcast if at most that many
    rows (checked); None = no hint, AQE decides from the measured size. The dimension must have one
    row per key (its primary key), so a fact row never multiplies.
    """
    pairs = _pairs(on)
    attrs = dict(attributes) if isinstance(attributes, Mapping) else {a: a for a in attributes}
    keys = [F.col(d).alias(f"_lk{i}") for i, (_, d) in enumerate(pairs)]
    d = dim.select(*keys, *[F.col(a).alias(o) for a, o in attrs.items()])
    if broadcast is True:
        d = F.broadcast(d)
    elif isinstance(broadcast, int) and not isinstance(broadcast, bool):
        d = bounded_broadcast(d, broadcast)
    cond = [facts[f] == d[f"_lk{i}"] for i, (f, _) in enumerate(pairs)]
    return facts.join(d, cond, "left").drop(*[f"_lk{i}" for i in range(len(pairs))])


def coalesce_merge(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """Full outer merge of two partial records of the same key; per column the first non-null."""
    on = list(on)
    cols = [c for c in a.columns if c not in on] + [c for c in b.columns if c not in on and c not in a.columns]
    A, B = a.alias("_ma"), b.alias("_mb")
    ca = lambda c: F.col(f"_ma.`{c}`")
    cb = lambda c: F.col(f"_mb.`{c}`")
    out = [F.coalesce(ca(k), cb(k)).alias(k) for k in on]
    for c in cols:
        if c in a.columns and c in b.columns:
            out.append(F.coalesce(ca(c), cb(c)).alias(c))
        else:
            out.append((ca(c) if c in a.columns else cb(c)).alias(c))
    cond = [ca(k) == cb(k) for k in on]
    return A.join(B, cond, "full").select(*out)


# ----------------------------------------------------------------------------------- order wide

ORDER_COLUMNS = ("id", "province_id", "user_id", "order_status", "total_amount", "create_time", "create_ts")
DETAIL_COLUMNS = ("detail_id", "order_id", "sku_id", "sku_num", "order_price", "split_total_amount", "create_ts")
# Further fields of the records; null where a source does not carry them.
ORDER_FIELDS = {"activity_reduce_amount": MONEY, "coupon_reduce_amount": MONEY, "original_total_amount": MONEY,
                "feight_fee": MONEY, "expire_time": S, "operate_time": S}
DETAIL_FIELDS = {"split_feight_fee": MONEY, "split_activity_amount": MONEY, "split_coupon_amount": MONEY}


def _or_null(df: DataFrame, fields: Mapping[str, T.DataType]) -> list:
    return [(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in fields.items()]


def order_wide(orders: DataFrame, details: DataFrame, lower: int = -5, upper: int = 5,
               time_cols: tuple[str, str] | None = None) -> DataFrame:
    """J1 + P16: order x line, line time within [order + lower, order + upper] ms; one row per line.

    Order fields (status, amounts, create time) come from the order, line fields from the line.
    ``time_cols``: the two sides' watermarked event-time columns on streams.
    """
    keep = (time_cols[0],) if time_cols else ()
    o = orders.select(*ORDER_COLUMNS, *_or_null(orders, ORDER_FIELDS), *keep)
    d = details.select(*[F.col(c).alias(f"d_{c}") if c in ("create_ts",) else F.col(c) for c in DETAIL_COLUMNS],
                       *_or_null(details, DETAIL_FIELDS), *([F.col(time_cols[1]).alias("d_event_time")] if time_cols else []))
    tc = (time_cols[0], "d_event_time") if time_cols else None
    j = interval_join(o, d, {"id": "order_id"}, "create_ts", "d_create_ts", lower, upper, time_cols=tc)
    return j.select("detail_id", "order_id", "user_id", "sku_id", "sku_num", "order_price", "split_total_amount",
                    "province_id", "order_status", "total_amount", "create_time", "create_ts", *ORDER_FIELDS, *DETAIL_FIELDS,
                    F.substring("create_time", 1, 10).alias("create_date"), F.substring("create_time", 12, 2).alias("create_hour"))


def product_dimension(sku: DataFrame, spu: DataFrame, trademark: DataFrame, category3: DataFrame) -> DataFrame:
    """SKU rows with SPU, brand and category names: the snowflake folded on the dimension side, so the
    facts are looked up once instead of four times. Joined by the ids the SKU supplies (brand by
    ``tm_id``, see Q4)."""
    p = lookup(sku, spu, {"spu_id": "id"}, {"spu_name": "spu_name"})
    p = lookup(p, trademark, {"tm_id": "id"}, {"tm_name": "tm_name"})
    p = lookup(p, category3, {"category3_id": "id"}, {"name": "category3_name"})
    return p


def enrich_order_wide(wide: DataFrame, user: DataFrame, province: DataFrame, products: DataFrame,
                      as_of: str | None = None) -> DataFrame:
    """User (age, gender), province (name, codes), then product attributes. Misses keep the row."""
    w = lookup(wide, user.select("id", age_years("birthday", as_of).alias("user_age"), "gender"),
               {"user_id": "id"}, {"user_age": "user_age", "gender": "user_gender"})
    w = lookup(w, province, {"province_id": "id"},
               {"name": "province_name", "area_code": "province_area_code",
                "iso_code": "province_iso_code", "iso_3166_2": "province_3166_2_code"})
    w = lookup(w, products, {"sku_id": "id"},
               {"sku_name": "sku_name", "spu_id": "spu_id", "tm_id": "tm_id", "category3_id": "category3_id",
                "spu_name": "spu_name", "tm_name": "tm_name", "category3_name": "category3_name"})
    return w


PAYMENT_COLUMNS = ("id", "order_id", "user_id", "total_amount", "payment_type", "create_time", "callback_time",
                   "callback_ts")


def payment_wide(payments: DataFrame, wide: DataFrame, lower: int = -1_800_000, upper: int = 0,
                 time_cols: tuple[str, str] | None = None) -> DataFrame:
    """J2 + P16: payment x order-wide by order id, order time within [pay + lower, pay + upper] ms.

    Payment wins on shared names (order_id, user_id, total_amount); the two create times are renamed.
    """
    p = payments.select(
        F.col("id").alias("payment_id"), "order_id", "user_id", "total_amount", "payment_type",
        F.col("create_time").alias("payment_create_time"), "callback_time", "callback_ts", *_or_null(payments, {"subject": S}),
        *([F.col(time_cols[0]).alias("p_event_time")] if time_cols else []))
    shared = {"order_id", "user_id", "total_amount"}
    w = wide.select(*[F.col(c).alias(f"w_{c}") if c in shared else F.col(c) for c in wide.columns
                      if not (time_cols and c == time_cols[1])],
                    *([F.col(time_cols[1]).alias("w_event_time")] if time_cols else [])) \
        .withColumnRenamed("create_time", "order_create_time").withColumnRenamed("create_ts", "order_create_ts")
    tc = ("p_event_time", "w_event_time") if time_cols else None
    j = interval_join(p, w, {"order_id": "w_order_id"}, "callback_ts", "order_create_ts", lower, upper, time_cols=tc)
    return j.drop(*[f"w_{c}" for c in shared], *(["p_event_time", "w_event_time"] if time_cols else []))
