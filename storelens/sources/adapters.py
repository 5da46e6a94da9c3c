"""Stand-ins: the shop's records built from the driver's tables (FIXTURES.md part 3).

Adapters only reshape; no operator logic lives here. Every rule is a plain column expression, so the
DuckDB check SQL in ``storelens.plans.oracle`` repeats it exactly. All of them are narrow
transformations except where a record needs columns of two tables (order -> customer nation, order
line -> order date), which are key joins left to the planner and AQE.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens import schemas
from storelens.functions.time import epoch_ms, format_ts, local_time
from storelens.sources.tables import Tables

# Fixed values of the stand-in rules.
BIRTHDAY_BASE = "1950-01-01"        # user birthday = base + c_custkey % 18000 days
BIRTHDAY_SPAN = 18000
DETAIL_STEP_US = 2500               # order line time = order time + (l_linenumber - 4) * 2500 us
DETAIL_CENTER_LINE = 4
PAYMENT_DELAY_MOD = 60              # payment callback = order time + (o_orderkey % 60) minutes
APPRAISE_GOOD, APPRAISE_BAD = "1201", "1203"
PAYMENT_TYPES = ("1101", "1102", "1103")
PAGE_OF_EVENT = (("click", "good_detail"), ("view", "good_list"), ("purchase", "trade"), ("error", "error"))


def k_of(props: str = "props") -> Column:
    return F.get_json_object(F.col(props), "$.k").cast("int")


def stable_id(text: Column) -> Column:
    """Distributed, order-free surrogate key of a name: the first 60 bits of its MD5."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _money(c: Column) -> Column:
    return c.cast(schemas.MONEY)


def split_amount(price: str = "l_extendedprice", discount: str = "l_discount") -> Column:
    """price * (1 - discount) in exact decimals, rounded half-up to cents."""
    return F.round(_money(F.col(price)) * (F.lit(1) - _money(F.col(discount))), 2).cast(schemas.MONEY)


# --------------------------------------------------------------------------------------------- logs

def behaviour_log(t: Tables) -> DataFrame:
    """One behaviour-log record per event: ``common, start, page, displays, ts`` plus ``offset``.

    ``offset`` is the record's position in the topic (event_id): the arrival order.
    """
    ev = t.events
    k = F.col("k")
    # The whole of part: AQE measures it and broadcasts it only while it is small. Only views carry the
    # key, so the other events never meet in one hot null key (they get a spread key that matches nothing).
    names = t.part.select(F.col("p_partkey").cast("long").alias("p_partkey"), "p_name")
    ev = ev.select("event_id", "ts", "user_id", "event_type", "value", k_of().alias("k"))
    viewed = F.when(F.col("event_type") == "view", k.cast("long")).otherwise(-1 - F.col("event_id"))
    ev = ev.withColumn("_viewed", viewed).join(names, F.col("_viewed") == F.col("p_partkey"), "left")

    page_id = F.lit(None).cast("string")
    for et, pid in reversed(PAGE_OF_EVENT):
        page_id = F.when(F.col("event_type") == et, F.lit(pid)).otherwise(page_id)
    millis = F.floor(F.col("value") * 1000).cast("long")
    item = (F.when(F.col("event_type") == "click", k.cast("string"))
            .when(F.col("event_type") == "view", F.col("p_name")))
    common = F.struct(
        F.col("user_id").cast("string").alias("mid"),
        F.concat(F.lit("v"), (k % 3).cast("string")).alias("vc"),
        F.concat(F.lit("c"), (k % 4).cast("string")).alias("ch"),
        F.concat(F.lit("a"), (F.col("user_id") % 5).cast("string")).alias("ar"),
        F.when(k < 50, F.lit("1")).otherwise(F.lit("0")).alias("is_new"),
    )
    is_signup = F.col("event_type") == "signup"
    start = F.when(is_signup, F.struct(F.lit("icon").alias("entry"), millis.alias("loading_time")))
    page = F.when(~is_signup, F.struct(
        page_id.alias("page_id"),
        F.when(k % 4 == 0, F.lit(None).cast("string")).otherwise(F.lit("home")).alias("last_page_id"),
        item.alias("item"),
        millis.alias("during_time"),
    ))
    shown = F.array(
        F.struct(F.lit("sku_id").alias("item_type"), k.cast("string").alias("item")),
        F.struct(F.lit("activity_id").alias("item_type"), (k + 1).cast("string").alias("item")),
    )
    displays = F.when(F.col("event_type") == "view", F.slice(shown, 1, k % 3))
    return ev.select(common.alias("common"), start.alias("start"), page.alias("page"),
                     displays.alias("displays"), epoch_ms("ts").alias("ts"), F.col("event_id").alias("offset"))


def behaviour_log_json(t: Tables) -> DataFrame:
    """The log as the topic carries it: ``value`` JSON text and ``offset``."""
    log = behaviour_log(t)
    return log.select(F.to_json(F.struct("common", "start", "page", "displays", "ts")).alias("value"), "offset")


# ------------------------------------------------------------------------------------------- orders

def order_info(t: Tables) -> DataFrame:
    o, c = t.orders, t.customer.select("c_custkey", "c_nationkey")
    o = o.join(c, o.o_custkey == c.c_custkey, "left")
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.col("c_nationkey").cast("long").alias("province_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("order_status"),
        _money(F.col("o_totalprice")).alias("total_amount"),
        format_ts("o_orderdate").alias("create_time"),
        epoch_ms("o_orderdate").alias("create_ts"),
    )


def order_detail(t: Tables, timing: str = "offset") -> DataFrame:
    """Order lines. ``timing='ship'``: line time = l_shipdate; ``'offset'``: order time + (line-4)*2.5 ms.

    ``detail_id`` is a label only: (order, line number) is not unique in the data.
    """
    li = t.lineitem
    if timing == "ship":
        when = F.col("l_shipdate")
    elif timing == "offset":
        li = li.join(t.orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
        when = F.timestamp_add("MICROSECOND", (F.col("l_linenumber") - DETAIL_CENTER_LINE) * DETAIL_STEP_US,
                               F.col("o_orderdate"))
    else:
        raise ValueError(f"timing must be 'ship' or 'offset', not {timing!r}")
    return li.select(
        (F.col("l_orderkey") * 16 + F.col("l_linenumber")).alias("detail_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        F.col("l_quantity").cast("long").alias("sku_num"),
        _money(F.col("l_extendedprice")).alias("order_price"),
        split_amount().alias("split_total_amount"),
        format_ts(when).alias("create_time"),
        epoch_ms(when).alias("create_ts"),
    )


def payment_info(t: Tables) -> DataFrame:
    o = t.orders.where(F.col("o_orderstatus") == "F")
    paid = F.timestamp_add("MINUTE", F.col("o_orderkey") % PAYMENT_DELAY_MOD, F.col("o_orderdate"))
    ptype = F.element_at(F.array(*[F.lit(p) for p in PAYMENT_TYPES]), (F.col("o_orderkey") % 3 + 1).cast("int"))
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        _money(F.col("o_totalprice")).alias("total_amount"),
        ptype.alias("payment_type"),
        format_ts(paid).alias("create_time"),
        format_ts(paid).alias("callback_time"),
        epoch_ms(paid).alias("callback_ts"),
    )


# -------------------------------------------------------------------------------------- dimensions

def dim_user(t: Tables) -> DataFrame:
    c = t.customer
    return c.select(
        F.col("c_custkey").alias("id"),
        F.date_add(F.lit(BIRTHDAY_BASE).cast("date"), (F.col("c_custkey") % BIRTHDAY_SPAN).cast("int"))
        .cast("string").alias("birthday"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("M")).otherwise(F.lit("F")).alias("gender"),
        F.col("c_nationkey").cast("long").alias("nation_id"),
    )


def dim_province(t: Tables) -> DataFrame:
    n, r = t.nation, t.region
    n = n.join(r, n.n_regionkey == r.r_regionkey, "left")
    return n.select(
        F.col("n_nationkey").cast("long").alias("id"),
        F.col("n_name").alias("name"),
        F.col("r_name").alias("area_code"),
        F.upper(F.substring("n_name", 1, 3)).alias("iso_code"),
        F.concat(F.upper(F.substring("n_name", 1, 2)), F.lit("-"), F.col("n_nationkey").cast("string")).alias("iso_3166_2"),
    )


def dim_sku(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("sku_name"),
        _money(F.col("p_retailprice")).alias("price"),
        stable_id(F.col("p_type")).alias("spu_id"),
        stable_id(F.col("p_brand")).alias("tm_id"),
        F.col("p_size").cast("long").alias("category3_id"),
    )


def dim_spu(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_type").alias("spu_name")).distinct() \
        .select(stable_id(F.col("spu_name")).alias("id"), "spu_name")


def dim_trademark(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_brand").alias("tm_name")).distinct() \
        .select(stable_id(F.col("tm_name")).alias("id"), "tm_name")


def dim_category3(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_size").cast("long").alias("id")).distinct() \
        .select("id", F.concat(F.lit("category "), F.col("id").cast("string")).alias("name"))


# ------------------------------------------------------------------------- product side records

def _event_sku(t: Tables) -> Column:
    """sku_id = event_id % count(part), the count as a scalar subquery (one number, no cross join)."""
    return F.col("event_id") % t.part.select(F.count(F.lit(1))).scalar()


def favor_info(t: Tables) -> DataFrame:
    ev = t.events.where(F.col("event_type") == "signup")
    return ev.select(_event_sku(t).alias("sku_id"), format_ts("ts").alias("create_time"))


def cart_info(t: Tables) -> DataFrame:
    ev = t.events.where(F.col("event_type") == "purchase")
    return ev.select(_event_sku(t).alias("sku_id"), format_ts("ts").alias("create_time"))


def comment_info(t: Tables) -> DataFrame:
    ev = t.events.where(F.col("event_type") == "view")
    appraise = F.when(k_of() < 50, F.lit(APPRAISE_GOOD)).otherwise(F.lit(APPRAISE_BAD))
    return ev.select(_event_sku(t).alias("sku_id"), appraise.alias("appraise"), format_ts("ts").alias("create_time"))


def refund_info(t: Tables) -> DataFrame:
    li = t.lineitem.where(F.col("l_returnflag") == "R")
    return li.select(F.col("l_partkey").alias("sku_id"), F.col("l_orderkey").alias("order_id"),
                     split_amount().alias("refund_amount"), format_ts("l_shipdate").alias("create_time"))


# ---------------------------------------------------------------------------- change records, rules

# The stand-in routing rules (source_table, operate_type, sink_type, sink_table,
# sink_columns, sink_pk, sink_extend). They cover both sinks, a sink type in upper case, an unknown
# sink type, a key column other than id and a rule whose type never reaches the lookup.
RULES = (
    ("customer", "insert", "hbase", "dim_user_info", "id,name,nation_id,segment", "id", None),
    ("customer", "update", "HBASE", "dim_user_info", "", "id", None),
    ("customer", "delete", "kafka", "dwd_user_delete", "id", "id", None),
    ("customer", "bootstrap-insert", "kafka", "dwd_user_boot", "", "id", None),
    ("part", "insert", "hbase", "dim_sku_info", "sku_name,brand", "sku_id", None),
    ("nation", "insert", "clickhouse", "nation_stats", "", "id", None),
)

CHANGE_TYPES = ("insert", "update", "bootstrap-insert", "delete")


def rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(*r, i) for i, r in enumerate(RULES)], schemas.RULE)


def change_log(t: Tables) -> DataFrame:
    """Change records of ``customer``: insert (all), update (every 7th: id and segment), bootstrap-insert
    (every 11th, name upper-cased), delete (every 13th: id only) and, every 17th, an empty and invalid record;
    and of ``part``: insert (all), keyed by ``sku_id``. One scan and one ``explode`` per table.

    Columns: ``table, type, data, ts, offset``; ``offset`` = key * 4 + position of the type.
    """
    c = t.customer
    key = F.col("c_custkey")
    sid = key.cast("string")

    def full(name: Column) -> Column:
        return F.create_map(F.lit("id"), sid, F.lit("name"), name,
                            F.lit("nation_id"), F.col("c_nationkey").cast("string"),
                            F.lit("acctbal"), _money(F.col("c_acctbal")).cast("string"),
                            F.lit("segment"), F.col("c_mktsegment"))

    def rec(typ: str, pos: int, data: Column) -> Column:
        return F.struct(F.lit(typ).alias("type"), data.alias("data"), (key * 4 + pos).alias("offset"))

    candidates = F.array(
        rec("insert", 0, full(F.col("c_name"))),
        F.when(key % 7 == 0, rec("update", 1, F.create_map(F.lit("id"), sid, F.lit("segment"),
                                                           F.lower(F.col("c_mktsegment"))))),
        F.when(key % 11 == 0, rec("bootstrap-insert", 2, full(F.upper(F.col("c_name"))))),
        F.when(key % 13 == 0, rec("delete", 3, F.create_map(F.lit("id"), sid))),
        F.when(key % 17 == 0, rec("insert", 3, F.create_map().cast("map<string,string>"))),
    )
    part = t.part.select(
        F.lit("part").alias("table"), F.lit("insert").alias("type"),
        F.create_map(F.lit("sku_id"), F.col("p_partkey").cast("string"), F.lit("sku_name"), F.col("p_name"),
                     F.lit("brand"), F.col("p_brand"), F.lit("type"), F.col("p_type")).alias("data"),
        (F.col("p_partkey").cast("long") * 4000).alias("ts"), (F.col("p_partkey").cast("long") * 4).alias("offset"))
    return c.select(F.explode(F.filter(candidates, lambda x: x.isNotNull())).alias("r")).select(
        F.lit("customer").alias("table"), F.col("r.type").alias("type"), F.col("r.data").alias("data"),
        (F.col("r.offset") * 1000).cast("long").alias("ts"), F.col("r.offset").cast("long").alias("offset")).unionByName(part)


def change_log_json(t: Tables) -> DataFrame:
    ch = change_log(t)
    return ch.select(F.to_json(F.struct("table", "type", "data", "ts")).alias("value"), "offset")


# The stand-in rules of the order chain. Dimensions go to the store, orders, lines and payments to a topic per table.
SHOP_RULES = (
    ("user_info", "insert", "hbase", "dim_user_info", "id,birthday,gender", "id", None),
    ("base_province", "insert", "hbase", "dim_base_province", "id,name,area_code,iso_code,iso_3166_2", "id", None),
    ("sku_info", "insert", "hbase", "dim_sku_info", "id,sku_name,price,spu_id,tm_id,category3_id", "id", None),
    ("spu_info", "insert", "hbase", "dim_spu_info", "id,spu_name", "id", None),
    ("base_trademark", "insert", "hbase", "dim_base_trademark", "id,tm_name", "id", None),
    ("base_category3", "insert", "hbase", "dim_base_category3", "id,name", "id", None),
    ("order_info", "insert", "kafka", "dwd_order_info", "id,province_id,user_id,order_status,total_amount,create_time", "id", None),
    ("order_detail", "insert", "kafka", "dwd_order_detail",
     "detail_id,order_id,sku_id,sku_num,order_price,split_total_amount,create_time", "detail_id", None),
    ("payment_info", "insert", "kafka", "dwd_payment_info",
     "id,order_id,user_id,total_amount,payment_type,create_time,callback_time", "id", None),
)


def shop_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(*r, i) for i, r in enumerate(SHOP_RULES)], schemas.RULE)


def as_changes(df: DataFrame, table: str, offset: Column, ts: Column) -> DataFrame:
    """Inserts of a table: every column as text, nulls kept as nulls."""
    data = F.map_from_arrays(F.array(*[F.lit(c) for c in df.columns]), F.array(*[F.col(c).cast("string") for c in df.columns]))
    return df.select(F.lit(table).alias("table"), F.lit("insert").alias("type"), data.alias("data"),
                     ts.cast("long").alias("ts"), offset.cast("long").alias("offset"))


def shop_change_frames(t: Tables) -> list[DataFrame]:
    """Change records of every table of the order chain: the dimensions (at time 0), then orders, lines and payments at their
    own times. A line's ``create_time`` keeps its milliseconds; no epoch ms travels."""
    start = F.lit(0)
    parts = [as_changes(df, name, F.col("id"), start) for name, df in (
        ("user_info", dim_user(t)), ("base_province", dim_province(t)), ("sku_info", dim_sku(t)), ("spu_info", dim_spu(t)),
        ("base_trademark", dim_trademark(t)), ("base_category3", dim_category3(t)))]
    line = order_detail(t)
    at = local_time("create_ts").cast("string")
    parts += [as_changes(df.withColumn("create_time", at) if name == "order_detail" else df, name, F.col(key), F.col(ts)) for name, df, key, ts in (
        ("order_info", order_info(t), "id", "create_ts"), ("order_detail", line, "detail_id", "create_ts"),
        ("payment_info", payment_info(t), "id", "callback_ts"))]
    return parts


def shop_changes(t: Tables) -> DataFrame:
    """All of ``shop_change_frames``."""
    return functools.reduce(DataFrame.unionByName, shop_change_frames(t))


# ------------------------------------------------------------------------------------ keyword text

def documents(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", "text")
