"""Publish the stand-in records of the driver's tables to topic directories (batch S7), so the
streaming jobs run over the whole tables. A topic's files are slices of event time, and their modification times follow
their order, which is the order a file stream reads them in. Far-future sentinel records, files of their
own, move every input's watermark past the last real window; their own windows stay open and are never emitted."""

from __future__ import annotations

import functools
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.functions.time import epoch_ms, parse_ms
from storelens.sources import adapters as ad
from storelens.sources.tables import Tables
from storelens.streaming.jobs import Layout
from storelens.streaming.topics import CODEC

# Fixed values of the sentinel: 2100-01-01 00:00:00 UTC in ms, and its keys.
SENTINEL_MS = 4102444800000
SENTINEL_TEXT = "2100-01-01 00:00:00"
TEN_YEARS_MS = 315_360_000_000
SENTINEL_ID = -1


ALL_TOPICS = ("log", "order_info", "order_detail", "payment_info", "favor", "cart", "refund", "comment", "changes")


# Fixed value: a topic of more slices is written in so many spans of time, one after another, so that only a span's rows are
# dealt out at once.
SPANS = 4


def _cuts(times: DataFrame, files: int) -> list[int]:
    """The times (ms) between the spans; fewer where many records share a time."""
    n = min(SPANS, files)
    cuts = times.agg(F.approx_percentile("_at", [i / n for i in range(1, n)], 1000)).first()[0] if n > 1 else None
    return sorted(set(cuts or ()))


def _write(frames: list[DataFrame], times: DataFrame | None, payload: list[str], path: str, files: int, parts: int, end: DataFrame | None) -> None:
    """Write rows of ``payload``, ``_offset`` and their time ``_at`` as records: ``files`` slices of time, in order, each in ``parts``
    files, and ``end`` as a file after them. Rows travel as columns and become text where they are written. Files that no row
    fell into are made up for by empty ones, so that a reader of ``parts`` files at a time meets ``end`` alone.

    With ``times`` (``_at`` of about the same spread, only to cut spans by) the frames are first staged one after another, by
    span of time, so that the files of one frame's joins are gone before the next one's come; then span by span is dealt out."""
    spark, jvm = frames[0].sparkSession, frames[0].sparkSession._jvm
    fs_path, staged = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}-staged")
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(fs_path, True)
    if times is None:
        spans = [functools.reduce(DataFrame.unionByName, frames)]
    else:
        cuts, span = _cuts(times, files), F.lit(0)
        for c in cuts:  # as in a sort, rows without a time come first
            span = span + F.coalesce((F.col("_at") > c).cast("int"), F.lit(0))
        for i, rows in enumerate(frames):
            rows.withColumn("_span", span).write.mode("append" if i else "overwrite").partitionBy("_span").parquet(staged.toString(), compression="zstd")
        folders = [f"{staged.toString()}/_span={i}" for i in range(len(cuts) + 1)]
        spans = [spark.read.schema(frames[0].schema).parquet(f) for f in folders if fs.exists(jvm.org.apache.hadoop.fs.Path(f))]
    written, slices = [], -(-files // max(1, len(spans)))
    for i, rows in enumerate(spans):
        rows.repartitionByRange(slices * parts, "_at").sortWithinPartitions("_at") \
            .select(F.col("_offset").alias("offset"), F.to_json(F.struct(*payload)).alias("value")) \
            .write.mode("append").json(path, compression=CODEC)
        old = {p.getName() for p in written}
        written += sorted((s.getPath() for s in fs.listStatus(fs_path)
                           if s.getPath().getName().startswith("part-") and s.getPath().getName() not in old), key=lambda p: p.getName())
        for j in range(-len(written) % parts):
            written.append(jvm.org.apache.hadoop.fs.Path(fs_path, f"part-none-{i:05d}-{j:05d}.json"))
            fs.create(written[-1]).close()
        if times is not None:
            for f in rows.inputFiles():
                fs.delete(jvm.org.apache.hadoop.fs.Path(f), False)
    fs.delete(staged, True)
    fs.mkdirs(fs_path)
    now = int(time.time() * 1000)
    for i, part in enumerate(written):
        fs.setTimes(part, now - (len(written) - i + 1) * 2000, -1)
    if end is not None:
        end.select("offset", "value").coalesce(1).write.mode("append").json(path, compression=CODEC)


def _log_row(spark, log: DataFrame, mid: str, page_id: str, last: str | None, item: str | None, ts: int) -> DataFrame:
    return spark.range(1).select(
        F.struct(F.lit(mid).alias("mid"), F.lit("v0").alias("vc"), F.lit("c0").alias("ch"),
                 F.lit("a0").alias("ar"), F.lit("0").alias("is_new")).alias("common"),
        F.lit(None).cast(log.schema["start"].dataType).alias("start"),
        F.struct(F.lit(page_id).alias("page_id"), F.lit(last).cast("string").alias("last_page_id"),
                 F.lit(item).cast("string").alias("item"), F.lit(0).cast("long").alias("during_time")).alias("page"),
        F.lit(None).cast(log.schema["displays"].dataType).alias("displays"),
        F.lit(ts).alias("ts"), F.lit(SENTINEL_ID).cast("long").alias("offset"))


def _log_end(spark, log: DataFrame) -> DataFrame:
    """The sentinel of the log: a detail page (a click) and a search page, both with a previous page. They close every real
    window and bucket; no unique visit and no jump comes of them."""
    return _log_row(spark, log, "__end__", "good_detail", "home", str(SENTINEL_ID), SENTINEL_MS).unionByName(
        _log_row(spark, log, "__end__", "good_list", "home", "end", SENTINEL_MS))


def publish_last(t: Tables, lay: Layout) -> None:
    """A further file of the log: an entry page of another device, which becomes the sentinel of the unique visits and, once
    a page ten years on has settled its bucket, of the jumps. It goes out after the jobs have written their last real
    records, or, with all jobs running, last: its visit and jump are in later files than any real one."""
    spark, log = t.spark, ad.behaviour_log(t)
    rows = _log_row(spark, log, "__last__", "good_detail", None, str(SENTINEL_ID), SENTINEL_MS).unionByName(
        _log_row(spark, log, "__last__", "home", "home", None, SENTINEL_MS + TEN_YEARS_MS))
    rows.select(F.to_json(F.struct("common", "start", "page", "displays", "ts")).alias("value"), "offset").coalesce(1) \
        .write.mode("append").json(lay.topic("log"), compression=CODEC)


def _end_row(df: DataFrame, keys: tuple[str, ...], times: tuple[str, ...], texts: tuple[str, ...]) -> DataFrame:
    """A sentinel row of ``df``'s columns from literals: keys -1, times and texts far in the future, money 0."""
    cols = []
    for f in df.schema.fields:
        v = F.lit(SENTINEL_ID) if f.name in keys else F.lit(SENTINEL_MS) if f.name in times else \
            F.lit(SENTINEL_TEXT) if f.name in texts else F.lit("F") if f.name == "order_status" else \
            F.lit(0) if f.dataType.simpleString().startswith(("bigint", "decimal", "int")) else F.lit(None)
        cols.append(v.cast(f.dataType).alias(f.name))
    return df.sparkSession.range(1).select(*cols)


def publish(t: Tables, lay: Layout, sentinel: bool = True, timing: str = "offset", topics: tuple[str, ...] = ALL_TOPICS,
            files: int = 1, parts: int = 1) -> None:
    """Write the named source topics (what a chain reads, and no others) in ``files`` slices of ``parts`` files each, plus the routing rules table
    where changes go out (``changes``: customers and parts; ``shop_changes``: every table of the order chain, to the same topic)."""
    spark = t.spark

    def put(name: str, df: DataFrame | list[DataFrame], offset, end: DataFrame | None, ts, payload: list[str] | None = None,
            times: DataFrame | None = None) -> None:
        frames = df if isinstance(df, list) else [df]
        cols = payload or frames[0].columns
        keep = [d.select(*cols, offset.cast("long").alias("_offset"), ts.cast("long").alias("_at")) for d in frames]
        last = end.select(F.to_json(F.struct(*cols)).alias("value"), F.lit(SENTINEL_ID).cast("long").alias("offset")) \
            if end is not None and sentinel else None
        _write(keep, times, cols, lay.topic(name), files, parts, last)

    ordered = t.orders.select(epoch_ms("o_orderdate").cast("long").alias("_at"))  # lines and payments follow their orders

    if "log" in topics:
        log = ad.behaviour_log(t)
        put("log", log, F.col("offset"), _log_end(spark, log), F.col("ts"), ["common", "start", "page", "displays", "ts"])
    if "order_info" in topics:
        df = ad.order_info(t)
        put("order_info", df, F.col("id"), _end_row(df, ("id",), ("create_ts",), ("create_time",)), F.col("create_ts"))
    if "order_detail" in topics:
        df = ad.order_detail(t, timing)
        put("order_detail", df, F.col("detail_id"), _end_row(df, ("detail_id", "order_id"), ("create_ts",), ("create_time",)), F.col("create_ts"),
            times=ordered if timing == "offset" else None)
    if "payment_info" in topics:
        df = ad.payment_info(t)
        put("payment_info", df, F.col("id"), _end_row(df, ("id", "order_id"), ("callback_ts",), ("create_time", "callback_time")),
            F.col("callback_ts"))
    for name, make in (("favor", ad.favor_info), ("cart", ad.cart_info), ("refund", ad.refund_info), ("comment", ad.comment_info)):
        if name in topics:
            df = make(t)
            put(name, df, F.lit(0), _end_row(df, ("sku_id", "order_id"), (), ("create_time",)), parse_ms(F.col("create_time")))
    if "changes" in topics:
        df = ad.change_log(t)
        put("changes", df, F.col("offset"), None, F.col("offset"), ["table", "type", "data", "ts"])
        ad.rules(spark).write.mode("overwrite").parquet(lay.rules)
    if "shop_changes" in topics:
        put("changes", ad.shop_change_frames(t), F.col("offset"), None, F.col("ts"), ["table", "type", "data", "ts"], times=ordered)
        ad.shop_rules(spark).write.mode("overwrite").parquet(lay.rules)
