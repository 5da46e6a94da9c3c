"""The shop's jobs as Structured Streaming queries chained through topic directories.

    log --(T1, P9, P10)--> dwd (kind = start | page | display)
    page --(T2, T7)--> unique_visit          page --(T3)--> user_jump
    page + unique_visit + user_jump --(P14, W3, A2)--> visitor_stats
    page --(P11, U1, A4)--> keyword_stats
    order_info + order_detail --(J1, J4)--> order_wide --(A3)--> province_stats
    payment_info + order_wide --(J2)--> payment_wide
    page + order_wide + payment_wide + favor + cart + refund + comment --(P13, W3, A1, J5)--> product_stats
    changes --(P4-P8, rules re-read per batch)--> dimension store (S9) + routed facts (S8)
    facts of orders and lines --(J1; J3, J4 on the store)--> order_wide; facts of payments --(J2)--> payment_wide

Every query has its own checkpoint under ``<root>/_checkpoints``. Topics between jobs are written by
Spark's file sink, whose ``_spark_metadata`` log commits each micro-batch's files together with the
query's offsets; a downstream file source reads only committed files, so the chain is exactly-once
across restarts. Statistics go through ``foreachBatch`` writers that overwrite their batch's own
folder (nothing streams from them). ``trigger`` defaults to ``availableNow``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens import schemas
from storelens.functions.json_text import array_of, with_key
from storelens.functions.time import epoch_ms, event_time, local_time
from storelens.operators import aggregates as agg
from storelens.operators import clean, joins, route, upsert
from storelens.streaming import state
from storelens.streaming.topics import CODEC, as_records, latest_position, read_facts, read_rules, stats_writer, write_batch

# The shop's watermark delays (T4, T5).
DELAY_ORDER = "3 seconds"
DELAY_VISITOR = "3 seconds"        # the shop's; too short when jump records feed the same window (Q12)
DELAY_VISITOR_CHAINED = "20 seconds"  # default here: above the 10 s bounce horizon
DELAY_PRODUCT = "5 seconds"
DELAY_KEYWORD = "2 seconds"
DELAY_MONOTONIC = "0 seconds"

ORDER_INFO_SCHEMA = "id long, province_id long, user_id long, order_status string, total_amount decimal(18,2), " \
                    "create_time string, create_ts long"
ORDER_DETAIL_SCHEMA = "detail_id long, order_id long, sku_id long, sku_num long, order_price decimal(18,2), " \
                      "split_total_amount decimal(18,2), create_time string, create_ts long"
PAYMENT_SCHEMA = "id long, order_id long, user_id long, total_amount decimal(18,2), payment_type string, " \
                 "create_time string, callback_time string, callback_ts long"
FAVOR_SCHEMA = "sku_id long, create_time string"
COMMENT_SCHEMA = "sku_id long, appraise string, create_time string"
REFUND_SCHEMA = "sku_id long, order_id long, refund_amount decimal(18,2), create_time string"

# The sink tables of the change chain and the columns read from them. Changed rows carry texts only; event
# times come from their time texts.
FACT_ORDER, FACT_DETAIL, FACT_PAYMENT = "dwd_order_info", "dwd_order_detail", "dwd_payment_info"
FACT_COLUMNS = {
    FACT_ORDER: "id long, province_id long, user_id long, order_status string, total_amount decimal(18,2), create_time string",
    FACT_DETAIL: "detail_id long, order_id long, sku_id long, sku_num long, order_price decimal(18,2), "
                 "split_total_amount decimal(18,2), create_time string",
    FACT_PAYMENT: "id long, order_id long, user_id long, total_amount decimal(18,2), payment_type string, create_time string, "
                  "callback_time string",
}
DIM_COLUMNS = {
    "dim_user_info": "id long, birthday string, gender string",
    "dim_base_province": "id long, name string, area_code string, iso_code string, iso_3166_2 string",
    "dim_sku_info": "id long, sku_name string, price decimal(18,2), spu_id long, tm_id long, category3_id long",
    "dim_spu_info": "id long, spu_name string",
    "dim_base_trademark": "id long, tm_name string",
    "dim_base_category3": "id long, name string",
}


@dataclass
class Layout:
    """Folder layout of one deployment: topics, statistics, dimension store and checkpoints.

    ``max_files`` caps the files per micro-batch of source topics, ``derived_files`` those (of one kind of record) of topics that
    another job writes (None = all available, which is whole micro-batches of the writer). ``lateness`` holds for each topic how far, in ms of
    event time, a record may come behind a record of an earlier file (``measured_lateness``): its readers add that to their
    watermark delay. Source topics whose files follow event time need none. ``once``: source topics and topics of batch folders have
    one reader each, which deletes their files after it has committed them (``cleanSource``)."""
    root: str
    max_files: int | None = None
    derived_files: int | None = None
    once: bool = False
    lateness: dict[str, int] = field(default_factory=dict)

    def late(self, topic: str) -> int:
        return self.lateness.get(topic, 0)

    def topic(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/topics/{name}"

    def stats(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/stats/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/_checkpoints/{name}"

    @property
    def dims(self) -> str:
        return f"{self.root.rstrip('/')}/dims"

    def folded(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/folded/{name}"

    @property
    def rules(self) -> str:
        return f"{self.root.rstrip('/')}/rules"


# ---------------------------------------------------------------------------------------- helpers

def watermarked(df: DataFrame, delay: str, ts: str = "ts", extra_ms: int = 0) -> DataFrame:
    """T4/T5: event time from epoch ms and a bounded-out-of-order watermark (late rows drop: T8). With several
    inputs each has its own; Spark's policy ``min`` lets the slowest decide."""
    ms = agg.size_ms(delay) + extra_ms
    return df.withColumn("event_time", event_time(ts)).withWatermark("event_time", f"{ms} milliseconds")


def measured_lateness(spark: SparkSession, path: str, ts, kind: str | None = None, before: int | None = None, to_ms=None) -> int:
    """How far a record of a topic may come behind a record of a file no younger than its own, in ms of event time: the bound
    its readers need, however they cut its files into micro-batches. ``ts``: the epoch ms as an expression over ``value``;
    ``before`` leaves out records from that time on (sentinels). A ``ts`` that is a wall clock comes with ``to_ms``, which turns the
    ends of a file, not each record's time, into epoch ms. One row per file goes through a running maximum."""
    raw = T.StructType([*schemas.RAW.fields, *([T.StructField("kind", T.StringType())] if kind else [])])
    src = spark.read.schema(raw).json(path)
    if kind:
        src = src.where(F.col("kind") == kind)
    rows = src.select(F.unix_millis("_metadata.file_modification_time").alias("m"), F.col("_metadata.file_path").alias("f"), ts.alias("ts"))
    # the limit stands in the aggregates: in a filter Spark would take the time out of each record's text twice
    limit = F.lit(before) if to_ms is None or before is None else local_time(F.lit(before))
    known = F.col("ts") if before is None else F.when(F.col("ts") < limit, F.col("ts"))
    ms = to_ms or (lambda c: c)
    files = rows.groupBy("m", "f").agg(F.min(known).alias("low"), F.max(known).alias("high")).where(F.col("low").isNotNull()).select(
        "m", "f", ms(F.col("low")).alias("low"), ms(F.col("high")).alias("high"))
    seen = F.max("high").over(Window.orderBy("m").rangeBetween(Window.unboundedPreceding, 0))
    return files.select((seen - F.col("low")).alias("d")).agg(F.max("d")).first()[0] or 0


def read_records(spark: SparkSession, path: str, schema, stream: bool = True, max_files: int | None = None,
                 kind: str | None = None, whole: bool = False, once: bool = False) -> DataFrame:
    """A topic's records parsed with ``schema`` (P1), keeping ``offset``; ``kind`` picks one record
    kind of a topic partitioned by kind (the base-log topic); ``whole`` keeps the record's text as ``value``; ``once`` deletes
    files that a stream has read."""
    raw = schemas.RAW if kind is None else T.StructType(list(schemas.RAW.fields) + [T.StructField("kind", T.StringType())])
    if stream:
        r = spark.readStream.schema(raw)
        if max_files:
            r = r.option("maxFilesPerTrigger", max_files)
        if once:
            r = r.option("cleanSource", "delete")
        src = r.json(path)
    else:
        src = spark.read.schema(raw).json(path)
    if kind is not None:
        src = src.where(F.col("kind") == kind)
    return clean.parse_records(src, schema if not isinstance(schema, str) else T.StructType.fromDDL(schema),
                               keep=("offset", "value") if whole else ("offset",))


def topic_sink(records: DataFrame, lay: Layout, topic: str, name: str, trigger: dict | None,
               partition_by: str | None = None):
    """S7 between jobs: the file sink (exactly-once with the query's checkpoint)."""
    w = records.writeStream.queryName(name).format("json").option("path", lay.topic(topic)).option("compression", CODEC) \
        .option("checkpointLocation", lay.checkpoint(name)).outputMode("append")
    if partition_by:
        w = w.partitionBy(partition_by)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def _start(df: DataFrame, name: str, lay: Layout, fn, trigger: dict | None, mode: str = "append"):
    return (df.writeStream.queryName(name).foreachBatch(fn).option("checkpointLocation", lay.checkpoint(name))
            .outputMode(mode).trigger(**(trigger or {"availableNow": True})).start())


def _log_records(df: DataFrame) -> DataFrame:
    """The records' own texts, so that keys no schema names go on through the chain (F2)."""
    return df.select(F.col("offset").cast("long").alias("offset"), "value")


# ------------------------------------------------------------------------------------------- jobs

def base_log_job(spark: SparkSession, lay: Layout, zone: str = "UTC", trigger: dict | None = None, ttl_ms: int | None = None):
    """T1 + P9 + P10 in one query: each repaired record becomes its start or page record plus one
    display record per display, all in the ``dwd`` topic partitioned by ``kind``. Records keep their text but for ``is_new``
    and a display's added ``page_id``. ``ttl_ms`` bounds the state (see ``repair_is_new_stream``)."""
    log = read_records(spark, lay.topic("log"), schemas.LOG, max_files=lay.max_files, whole=True, once=lay.once)
    if ttl_ms is not None:
        log = watermarked(log, DELAY_MONOTONIC, extra_ms=lay.late("log"))
    fixed = state.repair_is_new_stream(log, zone, ttl_ms)

    def rec(kind: str, value):
        return F.struct(F.lit(kind).alias("kind"), F.col("offset").alias("offset"), value.alias("value"))
    elements = F.when(F.contains("value", F.lit('"displays"')), array_of("value", "displays"))
    shown = F.filter(F.transform(elements, lambda d: rec("display", with_key(d, "page_id", F.col("page.page_id")))),
                     lambda r: r["value"].isNotNull())
    records = F.when(clean.is_start(fixed), F.array(rec("start", F.col("value")))) \
        .otherwise(F.concat(F.array(rec("page", F.col("value"))), F.coalesce(shown, F.array())))
    out = fixed.select(F.explode(records).alias("r")).select("r.kind", "r.offset", "r.value")
    return topic_sink(out, lay, "dwd", "base_log", trigger, partition_by="kind")


KINDS = 3  # start, page and display records


def _pages(spark: SparkSession, lay: Layout) -> DataFrame:
    files = lay.derived_files and KINDS * lay.derived_files  # a micro-batch leaves files of each kind
    return read_records(spark, lay.topic("dwd"), schemas.LOG, max_files=files, kind="page", whole=True)


def _source(spark: SparkSession, lay: Layout, topic: str, schema=schemas.LOG) -> DataFrame:
    return read_records(spark, lay.topic(topic), schema, max_files=lay.max_files, once=lay.once)


def _derived(spark: SparkSession, lay: Layout, topic: str, schema=schemas.LOG) -> DataFrame:
    return read_records(spark, lay.topic(topic), schema, max_files=lay.derived_files)


def unique_visit_job(spark: SparkSession, lay: Layout, zone: str = "UTC", trigger: dict | None = None):
    """T2 + T7 on the page topic."""
    pages = watermarked(_pages(spark, lay), DELAY_MONOTONIC, extra_ms=lay.late("dwd"))
    out = state.daily_unique_stream(pages, zone)
    return topic_sink(_log_records(out), lay, "unique_visit", "unique_visit", trigger)


def user_jump_job(spark: SparkSession, lay: Layout, within: int = 10_000, trigger: dict | None = None):
    """T3 on the page topic, monotonic watermark (T5) but for the topic's lateness."""
    out = state.bounces_stream(_pages(spark, lay), within, delay_ms=agg.size_ms(DELAY_MONOTONIC) + lay.late("dwd"))
    return topic_sink(_log_records(out), lay, "user_jump", "user_jump", trigger)


def visitor_stats_job(spark: SparkSession, lay: Layout, window: str = "10 seconds", zone: str = "UTC",
                      delay: str = DELAY_VISITOR_CHAINED, trigger: dict | None = None):
    """P14 + W3 + A2. Each input has its own watermark with its topic's lateness and the slowest decides, so jumps, which
    leave their job later than the pages they come from, hold the windows open until they are read."""
    topics = {"pages": "dwd", "unique_visits": "unique_visit", "jumps": "user_jump"}
    ev = agg.visitor_events(_pages(spark, lay), _derived(spark, lay, "unique_visit"), _derived(spark, lay, "user_jump"),
                            watermark=lambda d, name: watermarked(d, delay, extra_ms=lay.late(topics[name])))
    stats = agg.visitor_stats(ev, window, zone, time_col="event_time")
    return _start(stats, "visitor_stats", lay, stats_writer(lay.stats("visitor_stats"), schemas.VISITOR_STATS_COLUMNS), trigger)


def keyword_stats_job(spark: SparkSession, lay: Layout, window: str = "10 seconds", zone: str = "UTC",
                      as_of: str | None = None, trigger: dict | None = None):
    """P11 + U1 + A4 (+ P12, T9 append: each window once)."""
    pages = watermarked(_pages(spark, lay), DELAY_KEYWORD, extra_ms=lay.late("dwd"))
    kw = agg.keyword_stats(clean.keyword_pages(pages, keep=("event_time",)), window, agg.KEYWORD_SEARCH, as_of,
                           zone, time_col="event_time")
    return _start(kw, "keyword_stats", lay, stats_writer(lay.stats("keyword_stats"), schemas.KEYWORD_STATS_COLUMNS), trigger)


def page_table(spark: SparkSession, lay: Layout, table: str) -> None:
    """The base-log topic declared as the catalogue table ``table``, as the shop's DDL does; its records' ``kind`` is a column."""
    from storelens.plans.sql import create_topic_table
    create_topic_table(spark, table, lay.topic("dwd"), "offset BIGINT, value STRING")


def keyword_stats_sql_job(spark: SparkSession, lay: Layout, table: str, window: str, as_of: str, start: str = "earliest",
                          trigger: dict | None = None):
    """A4 as SQL text over a streaming catalogue table (S2): the declared table is read with ``readStream.table``; its row time
    and watermark are set in SQL's place (Spark's DDL has no watermark clause), the statement is the batch one.

    ``start="latest"`` takes only files that are newer than all that the topic held when the query first started."""
    from storelens.plans.sql import create_table_functions, keyword_stats_text
    create_table_functions(spark)
    r = spark.readStream
    if lay.derived_files:
        r = r.option("maxFilesPerTrigger", KINDS * lay.derived_files)
    rows = r.table(table)
    if start == "latest":
        since = latest_position(spark, lay.topic("dwd"), f"{lay.root.rstrip('/')}/_positions/{table}")
        rows = rows.where(F.unix_millis("_metadata.file_modification_time") > since)
    elif start != "earliest":
        raise ValueError(start)
    pages = rows.where("kind = 'page'").selectExpr("from_json(value, 'page MAP<STRING,STRING>, ts BIGINT') AS r").selectExpr("r.page", "r.ts")
    timed = watermarked(pages, DELAY_KEYWORD, extra_ms=lay.late("dwd")).withColumnRenamed("event_time", "rowtime")
    view = f"{table}_stream"
    timed.createOrReplaceTempView(view)
    stats = spark.sql(keyword_stats_text(view, window, as_of))
    return _start(stats, "keyword_stats_sql", lay, stats_writer(lay.stats("keyword_stats_sql"), schemas.KEYWORD_STATS_COLUMNS), trigger)


def order_wide_job(spark: SparkSession, lay: Layout, user: DataFrame, province: DataFrame, products: DataFrame,
                   as_of: str | None = None, bounds: tuple[int, int] = (-5, 5), trigger: dict | None = None):
    """J1 (stream-stream interval join, state evicted by watermark + bounds) + J4 (stream-static)."""
    o = watermarked(_source(spark, lay, "order_info", ORDER_INFO_SCHEMA), DELAY_ORDER, "create_ts")
    d = watermarked(_source(spark, lay, "order_detail", ORDER_DETAIL_SCHEMA), DELAY_ORDER, "create_ts")
    wide = joins.order_wide(o, d, *bounds, time_cols=("event_time", "event_time"))
    wide = joins.enrich_order_wide(wide, user, province, products, as_of)
    return topic_sink(as_records(wide, "detail_id"), lay, "order_wide", "order_wide", trigger)


def _fact_stream(spark: SparkSession, lay: Layout, table: str, time: str, ts: str) -> DataFrame:
    """A routed table as a stream: its columns, the epoch ms ``ts`` of its time text (P3) and a watermark."""
    rows = read_facts(spark, lay.topic("facts"), table, FACT_COLUMNS[table], max_files=lay.derived_files, once=lay.once)
    return watermarked(rows.withColumn(ts, epoch_ms(F.col(time).try_cast("timestamp_ntz"))), DELAY_ORDER, ts, lay.late(table))


def folded(df: DataFrame, lay: Layout, name: str) -> DataFrame:
    """A dimension written once in the form that micro-batches look it up in, so that none of them folds it anew."""
    df.write.mode("overwrite").parquet(lay.folded(name))
    return df.sparkSession.read.schema(df.schema).parquet(lay.folded(name))


def store_products(store: upsert.DimensionStore, until: int | None = None) -> DataFrame:
    """The product snowflake from the store's tables, folded on the dimension side."""
    return joins.product_dimension(*[store.table(n, DIM_COLUMNS[n], until) for n in (
        "dim_sku_info", "dim_spu_info", "dim_base_trademark", "dim_base_category3")])


def fact_order_wide_job(spark: SparkSession, lay: Layout, as_of: str | None = None, bounds: tuple[int, int] = (-5, 5),
                        trigger: dict | None = None):
    """J1 on the routed orders and lines, J3/J4 against the dimension store that the change stream writes.

    Point in time: a micro-batch looks its rows up in the store as it stands when the batch runs (the store's committed
    batches are listed once for it), so a dimension change is seen by the next micro-batch and never by an earlier one. The
    store's cells are folded into tables once per state of the store, not once per micro-batch.
    A batch that runs again before its folder of the ``order_wide`` topic was in place looks up anew; nobody has read its first try."""
    o = _fact_stream(spark, lay, FACT_ORDER, "create_time", "create_ts")
    d = _fact_stream(spark, lay, FACT_DETAIL, "create_time", "create_ts")
    wide = joins.order_wide(o, d, *bounds, time_cols=("event_time", "event_time"))
    store = upsert.DimensionStore(spark, lay.dims)
    kept: dict = {}

    def dimensions() -> list[DataFrame]:
        until = max(store.batches(), default=None)
        if kept.get("until", -1) != until:
            kept["tables"] = [folded(store.table(n, DIM_COLUMNS[n], until), lay, n) for n in ("dim_user_info", "dim_base_province")]
            kept["tables"].append(folded(store_products(store, until), lay, "dim_product"))
            kept["until"] = until
        return kept["tables"]

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = joins.enrich_order_wide(batch, *dimensions(), as_of)
        write_batch(as_records(rows, "detail_id"), lay.topic("order_wide"), batch_id)
    return _start(wide, "order_wide", lay, handle, trigger)


def batches_of(lay: Layout, topic: str) -> str:
    """The path of a topic that a job writes folder by folder, one per micro-batch."""
    return f"{lay.topic(topic)}/batch-*"


def fact_payment_wide_job(spark: SparkSession, lay: Layout, wide_schema, bounds: tuple[int, int] = (-1_800_000, 0),
                          trigger: dict | None = None):
    """Routed payments x the order-wide records of ``fact_order_wide_job``."""
    p = _fact_stream(spark, lay, FACT_PAYMENT, "callback_time", "callback_ts")
    w = read_records(spark, batches_of(lay, "order_wide"), wide_schema, max_files=lay.derived_files, once=lay.once)
    pw = joins.payment_wide(p, watermarked(w, DELAY_ORDER, "create_ts", lay.late("order_wide")), *bounds, time_cols=("event_time", "event_time"))
    return topic_sink(as_records(pw, "detail_id"), lay, "payment_wide", "payment_wide", trigger)


def payment_wide_job(spark: SparkSession, lay: Layout, wide_schema, bounds: tuple[int, int] = (-1_800_000, 0),
                     trigger: dict | None = None):
    """Payments x order-wide records, both watermarked."""
    p = watermarked(_source(spark, lay, "payment_info", PAYMENT_SCHEMA), DELAY_ORDER, "callback_ts")
    w = watermarked(_derived(spark, lay, "order_wide", wide_schema), DELAY_ORDER, "create_ts", lay.late("order_wide"))
    pw = joins.payment_wide(p, w, *bounds, time_cols=("event_time", "event_time"))
    return topic_sink(as_records(pw, "detail_id"), lay, "payment_wide", "payment_wide", trigger)


def province_stats_job(spark: SparkSession, lay: Layout, wide_schema, window: str = "10 seconds",
                       zone: str = "UTC", as_of: str | None = None, trigger: dict | None = None):
    """A3 on the order-wide topic; distinct orders in two levels."""
    w = watermarked(_derived(spark, lay, "order_wide", wide_schema), DELAY_MONOTONIC, "create_ts", lay.late("order_wide"))
    stats = agg.province_stats(w, window, as_of, zone, time_col="event_time")
    return _start(stats, "province_stats", lay,
                  stats_writer(lay.stats("province_stats"), schemas.PROVINCE_STATS_COLUMNS), trigger)


def province_stats_sql_job(spark: SparkSession, lay: Layout, wide_schema, window: str = "10 seconds",
                           as_of_ms: int | None = None, trigger: dict | None = None):
    """A3 as SQL text over a streaming view (the shop's SQL entry on a dynamic table): the watermarked
    order-wide stream is a temp view and the statement groups by ``window(event_time, ...)``. Distinct
    orders are counted in two nested ``GROUP BY``: streams refuse ``COUNT(DISTINCT)``."""
    w = watermarked(_derived(spark, lay, "order_wide", wide_schema), DELAY_MONOTONIC, "create_ts", lay.late("order_wide"))
    view = f"order_wide_stream_{abs(hash(lay.root)) % 10**8}"
    w.createOrReplaceTempView(view)
    fmt = ("substring(CAST(timestampadd(MILLISECOND, unix_millis(w.{}), TIMESTAMP_NTZ '1970-01-01 00:00:00') "
           "AS STRING), 1, 19)")
    stamp = f"CAST({as_of_ms} AS BIGINT)" if as_of_ms is not None else "unix_millis(current_timestamp())"
    place = "province_id, province_name, province_area_code, province_iso_code, province_3166_2_code"
    stats = spark.sql(f"""
        SELECT {fmt.format('start')} AS stt, {fmt.format('end')} AS edt, province_id, province_name,
               province_area_code AS area_code, province_iso_code AS iso_code, province_3166_2_code AS iso_3166_2,
               CAST(sum(amount) AS DECIMAL(28,2)) AS order_amount, count(order_id) AS order_count, {stamp} AS ts
        FROM (SELECT window(event_time, '{window}') AS w, {place}, order_id, sum(split_total_amount) AS amount
              FROM {view} GROUP BY window(event_time, '{window}'), {place}, order_id)
        GROUP BY w, {place}""")
    return _start(stats, "province_stats_sql", lay,
                  stats_writer(lay.stats("province_stats_sql"), schemas.PROVINCE_STATS_COLUMNS), trigger)


def product_stats_job(spark: SparkSession, lay: Layout, wide_schema, payment_schema, products: DataFrame | None = None,
                      window: str = "10 seconds", zone: str = "UTC", as_of: str | None = None,
                      trigger: dict | None = None):
    """P13 + W3 (seven topics) + A1 in two levels + J5 after the aggregate: against the static ``products``, or, where none is
    given, against the dimension store as it stands when the micro-batch runs."""
    topics = {"pages": "dwd"}
    ev = agg.product_events(
        pages=_pages(spark, lay),
        order_wide=_derived(spark, lay, "order_wide", wide_schema),
        payment_wide=_derived(spark, lay, "payment_wide", payment_schema),
        favor=_source(spark, lay, "favor", FAVOR_SCHEMA),
        cart=_source(spark, lay, "cart", FAVOR_SCHEMA),
        refund=_source(spark, lay, "refund", REFUND_SCHEMA),
        comment=_source(spark, lay, "comment", COMMENT_SCHEMA), zone=zone,
        watermark=lambda d, name: watermarked(d, DELAY_PRODUCT, extra_ms=lay.late(topics.get(name, name))))
    stats = agg.product_stats(ev, window, as_of, products, zone, time_col="event_time")
    write = stats_writer(lay.stats("product_stats"), schemas.PRODUCT_STATS_COLUMNS)
    if products is not None:
        return _start(stats, "product_stats", lay, write, trigger)
    store = upsert.DimensionStore(spark, lay.dims)

    def handle(batch: DataFrame, batch_id: int) -> None:
        write(agg.with_product(batch, store_products(store, max(store.batches(), default=None))), batch_id)
    return _start(stats, "product_stats", lay, handle, trigger)


def change_routing_job(spark: SparkSession, lay: Layout, trigger: dict | None = None):
    """P4-P8 + S8 + S9: change records routed per micro-batch with the rules re-read each time (a
    rule change applies from the next batch; no rules at all is an error); the dimension branch goes to the
    dimension store, the fact branch to a folder per sink table (``read_facts``). Each sink writes a batch once, so a failure
    between the two leaves nothing out and nothing twice."""
    changes = _source(spark, lay, "changes", schemas.CHANGE)
    store = upsert.DimensionStore(spark, lay.dims)

    def handle(batch: DataFrame, batch_id: int) -> None:
        rules = read_rules(spark, lay.rules)
        route.require_rules(rules)
        routed = route.route(batch, rules).persist()   # feeds two sinks: route once per micro-batch
        try:
            store.merge(routed.where(F.col("sink_type") == route.SINK_DIMENSION), batch_id)
            facts = routed.where(F.col("sink_type") == route.SINK_FACT).select(
                "sink_table", F.col("offset").cast("long").alias("offset"), F.to_json("data").alias("value"))
            write_batch(facts, lay.topic("facts"), batch_id, partition_by="sink_table")
        finally:
            routed.unpersist()
    return _start(changes, "change_routing", lay, handle, trigger)


def token_count_job(spark: SparkSession, lines: DataFrame, out_path: str, checkpoint: str,
                    text: str = "value", trigger: dict | None = None):
    """A5 (+ S3): comma tokens of a text stream, running count per token, emitted on each update
    (update mode) into batch-keyed folders; ``latest_counts`` reads the current count per token."""
    counts = agg.token_counts(lines, text)
    return (counts.writeStream.queryName("token_counts").foreachBatch(stats_writer(out_path, ["token", "ct"]))
            .option("checkpointLocation", checkpoint).outputMode("update")
            .trigger(**(trigger or {"availableNow": True})).start())


def latest_counts(spark: SparkSession, out_path: str) -> DataFrame:
    """The newest emitted count of every token (updates carry running totals)."""
    return spark.read.parquet(out_path).groupBy("token").agg(F.max_by("ct", "batch_id").alias("ct"))
