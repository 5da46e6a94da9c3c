"""Run the streaming chain to completion (``availableNow``) over the driver's tables and read the
statistics back: the streaming counterparts of the batch jobs, checked against the same SQL."""

from __future__ import annotations

import contextlib
import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens import schemas
from storelens.functions.time import epoch_ms
from storelens.operators.upsert import DimensionStore
from storelens.plans import jobs as batch
from storelens.session import CORE_CONF, checkpoint_root
from storelens.sources import adapters as ad
from storelens.sources.tables import Tables
from storelens.streaming import jobs as sj
from storelens.streaming.publish import SENTINEL_MS, publish, publish_last
from storelens.streaming.topics import late_rows, read_json_lines


def _await(q) -> None:
    """Wait for the end of a query. The bounds of a registered chain are measured on its own topics, so a late row there is
    an error, not a loss (T8)."""
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover - surfaced to the caller
        raise RuntimeError(str(q.exception()))
    if late_rows(q):
        raise RuntimeError(f"{q.name}: {late_rows(q)} rows behind the watermark")


# Settings of the registered chains. A chain is run once and to its end, so the state's files need only last for a
# restart of the latest micro-batch, and shuffle files only for the query that wrote them. Every state partition leaves a file a
# micro-batch (uncoalesced), so that the topics of one job are read in step. State lies in RocksDB whatever the session's store
# is, in blocks of zstd that are large enough for a row's repeats to show. Rows are
# written and removed without first reading whether they are there, which only serves a count of the state's rows.
CHAIN_CONF = {
    "spark.sql.streaming.stateStore.providerClass": CORE_CONF["spark.sql.streaming.stateStore.providerClass"],
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.blockSizeKB": "64",
    "spark.sql.streaming.minBatchesToRetain": "2",
    "spark.sql.streaming.stateStore.minDeltasForSnapshot": "1",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.maintenanceInterval": "5s",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.streaming.numRecentProgressUpdates": "100000",  # late rows are looked for in every micro-batch
}


@contextlib.contextmanager
def _state_partitions(spark: SparkSession):
    """A fresh checkpoint fixes a query's number of state partitions from ``spark.sql.shuffle.partitions``.
    For these runs use one per core of the cluster (``defaultParallelism``) and ``CHAIN_CONF``, then restore the settings."""
    key = "spark.sql.shuffle.partitions"
    try:
        cores = spark.sparkContext.defaultParallelism
    except Exception:  # Spark Connect
        cores = int(spark.conf.get(key))
    mine = {key: str(max(1, cores)), **CHAIN_CONF}
    old = {k: spark.conf.get(k, None) for k in mine}
    for k, v in mine.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _sized(fn):
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str, *a, **kw):
        with _state_partitions(spark):
            return fn(spark, sf_dir, *a, **kw)
    return run


# The registered chains read their sources in several micro-batches: slices of event time, SOURCE_FILES or more, so that none
# holds more than some SLICE_BYTES of the tables, MAX_FILES at a time, and a sentinel file. A slice is a file per core; topics
# between jobs are read a file per state partition at a time, what one micro-batch of the writer leaves.
SOURCE_FILES, MAX_FILES, SLICE_BYTES = 4, 1, 64 << 20
LOG_TOPICS = ("log",)
ORDER_TOPICS = ("order_info", "order_detail")
PRODUCT_TOPICS = (*LOG_TOPICS, *ORDER_TOPICS, "payment_info", "favor", "cart", "refund", "comment")


def new_layout(spark: SparkSession, name: str, max_files: int | None = None, derived_files: int | None = None) -> sj.Layout:
    return sj.Layout(f"{checkpoint_root(spark).rstrip('/')}/storelens-stream/{name}-{uuid.uuid4().hex}", max_files, derived_files)


def _table_bytes(spark: SparkSession, t: Tables, names: tuple[str, ...]) -> int:
    paths = [spark._jvm.org.apache.hadoop.fs.Path(f"{t.sf_dir.rstrip('/')}/{n}.parquet") for n in names]
    return sum(p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength() for p in paths)


def _chain(spark: SparkSession, t: Tables, name: str, topics: tuple[str, ...], sentinel: bool = True) -> sj.Layout:
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tables = ("events",) if topics == LOG_TOPICS else ("customer", "part") if topics == ("changes",) else ("orders", "lineitem")
    slices = max(SOURCE_FILES, -(-_table_bytes(spark, t, tables) // SLICE_BYTES))
    lay = new_layout(spark, name, MAX_FILES * parts, parts)
    lay.once = True
    publish(t, lay, sentinel, topics=topics, files=slices, parts=parts)
    return lay


# The field that holds a topic's event time, and whether it is epoch ms (else a time text).
EVENT_TIMES = {"dwd": ("ts", True), "unique_visit": ("ts", True), "user_jump": ("ts", True), "order_wide": ("create_ts", True),
               "payment_wide": ("payment_create_time", False), sj.FACT_ORDER: ("create_time", False),
               sj.FACT_DETAIL: ("create_time", False), sj.FACT_PAYMENT: ("callback_time", False)}


def measure(spark: SparkSession, lay: sj.Layout, *topics: str, path: str | None = None) -> None:
    """Set the lateness bounds of topics that a finished job has written, from their files (sentinels left out)."""
    for topic in topics:
        name, ms = EVENT_TIMES[topic]
        text = F.get_json_object("value", f"$.{name}")
        at = text.cast("long") if ms else text.try_cast("timestamp_ntz")
        lay.lateness[topic] = sj.measured_lateness(spark, path or lay.topic(topic), at, "page" if topic == "dwd" else None, SENTINEL_MS,
                                                   to_ms=None if ms else epoch_ms)


def _drop(spark: SparkSession, lay: sj.Layout, *kept: str) -> None:
    """Delete a finished chain's folders but for the ``kept`` ones, which its result is read from."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(lay.root)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for st in fs.listStatus(root):
        if st.getPath().getName() not in kept:
            fs.delete(st.getPath(), True)


def _read_up(spark: SparkSession, lay: sj.Layout, jobs: tuple[str, ...], *paths: str) -> None:
    """Delete what nobody reads any more: topics (paths, with patterns) that all of their readers have read to the end, and the
    checkpoints of the finished ``jobs``. A chain so holds the topics of a step or two, not of all its steps."""
    for path in (*paths, *(lay.checkpoint(j) for j in jobs)):
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        for st in fs.globStatus(p) or ():
            fs.delete(st.getPath(), True)


def _read_stats(spark: SparkSession, path: str, columns) -> DataFrame:
    return spark.read.parquet(path).select(*columns)


@_sized
def visitor_stats_stream(spark: SparkSession, sf_dir: str, within: int = batch.JUMP_WITHIN) -> DataFrame:
    """log -> base log (T1) -> unique visit (T2), jump (T3) -> visitor statistics (A2), all streaming."""
    t = Tables(spark, sf_dir)
    lay = _chain(spark, t, "visitor", LOG_TOPICS)
    for last in (False, True):  # the jobs go on from their checkpoints with the last file
        if last:
            publish_last(t, lay)
        _await(sj.base_log_job(spark, lay))
        measure(spark, lay, "dwd")
        _await(sj.unique_visit_job(spark, lay))
        _await(sj.user_jump_job(spark, lay, within))
    _read_up(spark, lay, ("base_log", "unique_visit", "user_jump"), lay.topic("log"))
    measure(spark, lay, "unique_visit", "user_jump")
    _await(sj.visitor_stats_job(spark, lay, batch.WINDOW))
    _drop(spark, lay, "stats")
    return _read_stats(spark, lay.stats("visitor_stats"), schemas.VISITOR_STATS_COLUMNS)


def _base_log_chain(spark: SparkSession, lay: sj.Layout) -> None:
    _await(sj.base_log_job(spark, lay))
    _read_up(spark, lay, ("base_log",), lay.topic("log"))
    measure(spark, lay, "dwd")


@_sized
def keyword_stats_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    lay = _chain(spark, Tables(spark, sf_dir), "keyword", LOG_TOPICS)
    _base_log_chain(spark, lay)
    _await(sj.keyword_stats_job(spark, lay, batch.WINDOW, as_of=batch.AS_OF))
    _drop(spark, lay, "stats")
    return _read_stats(spark, lay.stats("keyword_stats"), schemas.KEYWORD_STATS_COLUMNS)


@_sized
def keyword_stats_sql_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyword statistics as SQL text over the page topic, declared by DDL as a table and read as a stream."""
    lay = _chain(spark, Tables(spark, sf_dir), "keyword-sql", LOG_TOPICS)
    _base_log_chain(spark, lay)
    table = f"page_log_{uuid.uuid4().hex[:12]}"
    sj.page_table(spark, lay, table)
    _await(sj.keyword_stats_sql_job(spark, lay, table, batch.WINDOW, batch.AS_OF))
    spark.sql(f"DROP TABLE {table}")
    _drop(spark, lay, "stats")
    return _read_stats(spark, lay.stats("keyword_stats_sql"), schemas.KEYWORD_STATS_COLUMNS)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)


def _products(t: Tables, lay: sj.Layout) -> DataFrame:
    """The product snowflake, folded once for all micro-batches of the chain."""
    return sj.folded(batch.products(t), lay, "products")


def _order_wide_chain(spark: SparkSession, t: Tables, lay: sj.Layout, products: DataFrame | None = None) -> str:
    products = _products(t, lay) if products is None else products
    _await(sj.order_wide_job(spark, lay, ad.dim_user(t), ad.dim_province(t), products, batch.AS_OF))
    _read_up(spark, lay, ("order_wide",), *map(lay.topic, ORDER_TOPICS))
    measure(spark, lay, "order_wide")
    return _ddl(batch.order_wide_enriched(t))


@_sized
def province_stats_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order info + lines -> order wide (J1, J4) -> province statistics (A3), all streaming."""
    t = Tables(spark, sf_dir)
    lay = _chain(spark, t, "province", ORDER_TOPICS)
    wide_schema = _order_wide_chain(spark, t, lay)
    _await(sj.province_stats_job(spark, lay, wide_schema, batch.WINDOW, as_of=batch.AS_OF))
    _drop(spark, lay, "stats")
    return _read_stats(spark, lay.stats("province_stats"), schemas.PROVINCE_STATS_COLUMNS)


@_sized
def province_stats_sql_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same chain with the province statistics written as SQL text over a streaming view."""
    import datetime as dt
    t = Tables(spark, sf_dir)
    lay = _chain(spark, t, "province-sql", ORDER_TOPICS)
    wide_schema = _order_wide_chain(spark, t, lay)
    as_of = dt.datetime.strptime(batch.AS_OF, "%Y-%m-%d %H:%M:%S").replace(tzinfo=dt.timezone.utc)
    _await(sj.province_stats_sql_job(spark, lay, wide_schema, batch.WINDOW, int(as_of.timestamp() * 1000)))
    _drop(spark, lay, "stats")
    return _read_stats(spark, lay.stats("province_stats_sql"), schemas.PROVINCE_STATS_COLUMNS)


@_sized
def product_stats_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seven product topics (order wide and payment wide produced by streaming joins) -> A1 + J5."""
    t = Tables(spark, sf_dir)
    lay = _chain(spark, t, "product", PRODUCT_TOPICS)
    _base_log_chain(spark, lay)
    products = _products(t, lay)
    wide_schema = _order_wide_chain(spark, t, lay, products)
    _await(sj.payment_wide_job(spark, lay, wide_schema))
    _read_up(spark, lay, ("payment_wide",), lay.topic("payment_info"))
    measure(spark, lay, "payment_wide")
    _await(sj.product_stats_job(spark, lay, wide_schema, _ddl(batch.payment_wide_of(t)), products, batch.WINDOW,
                                as_of=batch.AS_OF))
    _drop(spark, lay, "stats")
    return _read_stats(spark, lay.stats("product_stats"), schemas.PRODUCT_STATS_COLUMNS)


@_sized
def dim_upsert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """changes -> routing with rules re-read per batch -> dimension store."""
    lay = _chain(spark, Tables(spark, sf_dir), "dims", ("changes",), sentinel=False)
    _await(sj.change_routing_job(spark, lay))
    _drop(spark, lay, "dims")
    return DimensionStore(spark, lay.dims).current().select("sink_table", "pk", "column", "value")


def _change_chain(spark: SparkSession, t: Tables, name: str) -> tuple[sj.Layout, str]:
    """changes -> routing (S8, S9) -> order wide from the routed orders and lines, enriched from the store."""
    lay = _chain(spark, t, name, ("shop_changes",), sentinel=False)
    _await(sj.change_routing_job(spark, lay))
    _read_up(spark, lay, ("change_routing",), lay.topic("changes"))
    for table in (sj.FACT_ORDER, sj.FACT_DETAIL, sj.FACT_PAYMENT):
        measure(spark, lay, table, path=f"{sj.batches_of(lay, 'facts')}/sink_table={table}")
    _await(sj.fact_order_wide_job(spark, lay, batch.AS_OF))
    _read_up(spark, lay, ("order_wide",), *(f"{sj.batches_of(lay, 'facts')}/sink_table={table}" for table in (sj.FACT_ORDER, sj.FACT_DETAIL)))
    return lay, _ddl(batch.order_wide_enriched(t))


@_sized
def order_wide_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change chain: database changes -> routing -> J1 on the routed facts, J4 on the dimension store."""
    lay, schema = _change_chain(spark, Tables(spark, sf_dir), "order-wide")
    _read_up(spark, lay, (), lay.topic("facts"))
    _drop(spark, lay, "topics")
    return sj.read_records(spark, sj.batches_of(lay, "order_wide"), schema, stream=False).drop("offset")


@_sized
def payment_wide_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change chain one step on: J2 of the routed payments with the streamed order-wide records."""
    t = Tables(spark, sf_dir)
    lay, schema = _change_chain(spark, t, "payment-wide")
    measure(spark, lay, "order_wide", path=sj.batches_of(lay, "order_wide"))
    _await(sj.fact_payment_wide_job(spark, lay, schema))
    _read_up(spark, lay, (), lay.topic("facts"), lay.topic("order_wide"))
    _drop(spark, lay, "topics")
    return sj.read_records(spark, lay.topic("payment_wide"), _ddl(batch.payment_wide_of(t)), stream=False).drop("offset")


@_sized
def token_counts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 + A5 on a stream: a text-line source, every line the JSON text of one document, and running comma-token counts
    (update mode)."""
    lay = new_layout(spark, "tokens")
    Tables(spark, sf_dir).documents.select(F.col("text").alias("value")).write.mode("overwrite").json(lay.topic("lines"))
    lines = read_json_lines(spark, lay.topic("lines"), "value string")
    _await(sj.token_count_job(spark, lines, lay.stats("token_counts"), lay.checkpoint("token_counts")))
    _drop(spark, lay, "stats")
    return sj.latest_counts(spark, lay.stats("token_counts"))


STREAM_QUERIES = {
    "visitor_stats_stream": visitor_stats_stream,
    "keyword_stats_stream": keyword_stats_stream,
    "keyword_stats_sql_stream": keyword_stats_sql_stream,
    "province_stats_stream": province_stats_stream,
    "province_stats_sql_stream": province_stats_sql_stream,
    "product_stats_stream": product_stats_stream,
    "dim_upsert_stream": dim_upsert_stream,
    "order_wide_stream": order_wide_stream,
    "payment_wide_stream": payment_wide_stream,
    "token_counts_stream": token_counts_stream,
}


def start_all(spark: SparkSession, lay: sj.Layout, user: DataFrame, province: DataFrame, products: DataFrame,
              wide_schema: str, payment_schema: str, as_of: str | None = None,
              trigger: dict | None = None, window: str = "10 seconds", within: int = 10_000) -> list:
    """Deployment form: every job of the chain running continuously. The shop checkpointed every 5 s;
    here each query triggers every 5 s and commits its offsets and state to its checkpoint. Returns
    the running queries (stop them with ``q.stop()``). ``as_of=None`` stamps statistics with the
    wall clock as the shop did."""
    trig = trigger or {"processingTime": "5 seconds"}
    return [
        sj.base_log_job(spark, lay, trigger=trig),
        sj.unique_visit_job(spark, lay, trigger=trig),
        sj.user_jump_job(spark, lay, within, trigger=trig),
        sj.visitor_stats_job(spark, lay, window, trigger=trig),
        sj.keyword_stats_job(spark, lay, window, as_of=as_of, trigger=trig),
        sj.order_wide_job(spark, lay, user, province, products, as_of, trigger=trig),
        sj.payment_wide_job(spark, lay, wide_schema, trigger=trig),
        sj.province_stats_job(spark, lay, wide_schema, window, as_of=as_of, trigger=trig),
        sj.product_stats_job(spark, lay, wide_schema, payment_schema, products, window, as_of=as_of, trigger=trig),
        sj.change_routing_job(spark, lay, trigger=trig),
    ]
