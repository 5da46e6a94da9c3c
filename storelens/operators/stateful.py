"""Keyed-state operators in batch form: new-visitor repair (T1), daily unique visit (T2), bounce.

The shop keeps per-device state and visits records in arrival order. In batch, each rule is rewritten
into aggregates and bounded windows so that no device's whole history has to sit in one task:

* T1 - the first flagged day per device is a ``min`` (combined map-side), joined back by device.
* T2 - with arrival ordered by time, "day differs from the last emitted day" is "first record of its
  (device, day)": a ``min`` per (device, day), combined map-side.
* T3 - a record's successor within ``within`` ms lies in its own time bucket or the next one, so the
  window is partitioned by (device, bucket) with the next bucket's records replicated in as probes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storelens.functions.time import day_of
from storelens.operators.clean import is_entry

ORDER = ("ts", "offset")


def _mid(key: str) -> Column:
    return F.col(key)


def first_days(log: DataFrame, key: str = "common.mid", order_by: Sequence[str] = ORDER, zone: str = "UTC") -> DataFrame:
    """T1's state: per device (``_k``) the day of its first record (in ``order_by``) with is_new='1' (``_first_day``)."""
    day = day_of(F.col("ts"), zone)
    flagged = log.where(F.col("common.is_new") == "1")
    if order_by[0] == "ts":
        # Days never go back along time: the first record's day is the day of the smallest ts
        # (a fixed-width min, so a hash aggregate).
        return flagged.groupBy(_mid(key).alias("_k")).agg(F.min("ts").alias("_t")) \
            .select("_k", day_of(F.col("_t"), zone).alias("_first_day"))
    return flagged.select(_mid(key).alias("_k"), F.struct(*[F.col(c) for c in order_by], day.alias("day")).alias("_o")) \
        .groupBy("_k").agg(F.min("_o").alias("_o")).select("_k", F.col("_o.day").alias("_first_day"))


def repair_is_new(log: DataFrame, key: str = "common.mid", order_by: Sequence[str] = ORDER,
                  zone: str = "UTC", history: DataFrame | None = None) -> DataFrame:
    """The first record (in ``order_by``) with is_new='1' fixes the device's day; a later is_new='1'
    on another day becomes '0'. Records with '0' neither read nor set the state.

    ``history``: the log that the first days are taken from, where ``log`` holds some of its records only. T2 and T3 never
    look at is_new, so a job may pick its records first and repair those few."""
    day = day_of(F.col("ts"), zone)
    first = first_days(log if history is None else history, key, order_by, zone)
    j = log.join(first, _mid(key) == first["_k"], "left")
    fixed = F.when((F.col("common.is_new") == "1") & (day != F.col("_first_day")), F.lit("0")) \
        .otherwise(F.col("common.is_new"))
    return j.withColumn("common", F.col("common").withField("is_new", fixed)).drop("_k", "_first_day")


def daily_unique(pages: DataFrame, key: str = "common.mid", order_by: Sequence[str] = ORDER,
                 zone: str = "UTC", method: str = "first_per_day") -> DataFrame:
    """Among entry pages (``last_page_id`` null; '' is not an entry here, Q8), emit a record when its
    day differs from the device's last emitted day.

    ``first_per_day`` is exact when ``order_by`` starts with the time the day is taken from (then days
    never go back); ``lag`` is exact for any order (Q9: d1, d2, d1 emits three times) but keeps each
    device in one window partition.
    """
    day = day_of(F.col("ts"), zone)
    entry = pages.where(is_entry("page.last_page_id", empty_is_entry=False)).withColumn("_day", day)
    if method == "lag":
        w = Window.partitionBy(_mid(key)).orderBy(*[F.col(c) for c in order_by])
        prev = entry.withColumn("_prev", F.lag("_day").over(w))
        return prev.where(F.col("_prev").isNull() | (F.col("_prev") != F.col("_day"))).drop("_day", "_prev")
    if method != "first_per_day":
        raise ValueError(method)
    payload = [c for c in pages.columns if c not in order_by]
    # Combined where the rows are read: a task sends one record per (device, day). On the output of a join by device the
    # aggregate would reuse that partitioning instead, so take the visits before such a join (see ``repair_is_new``).
    entry = entry.withColumn("_k", _mid(key))
    firsts = entry.groupBy("_k", "_day").agg(
        F.min(F.struct(*[F.col(c) for c in order_by], *[F.col(c) for c in payload])).alias("_r"))
    return firsts.select(*[F.col(f"_r.{c}").alias(c) for c in pages.columns])


def bounces(pages: DataFrame, within: int = 10_000, key: str = "common.mid", order_by: Sequence[str] = ORDER,
            empty_is_entry: bool = True, bucket_ms: int | None = None) -> DataFrame:
    """Entry pages whose next record (in ``order_by``) of the same device is absent or comes
    ``within`` ms or later. Equal times count as a successor (Q11). ``within`` in ms.

    Bucket b = floor(ts / bucket_ms) with ``bucket_ms`` = ``within`` by default. A successor closer
    than ``within`` lies at most k = ceil(within / bucket_ms) buckets later, so every record also
    enters the k buckets before its own as a probe, and ``lead`` over (device, bucket) finds it.
    Narrower buckets spread a device that is dense in time over more window partitions, at the cost
    of k probe copies per record.
    """
    if order_by[0] != "ts":
        raise ValueError("bounces orders by event time first")
    width = bucket_ms or within
    k = -(-within // width)
    bucket = F.floor(F.col("ts") / F.lit(width)).cast("long")
    entry = is_entry("page.last_page_id", empty_is_entry)
    order = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order_by)]
    # One pass: each record once in its own bucket and once as a probe in each of the k buckets before; only an entry
    # page in its own bucket carries its columns along.
    copies = F.transform(F.sequence(F.lit(0), F.lit(k)), lambda d: F.struct((bucket - d).alias("b"), (d > 0).alias("probe")))
    both = pages.select(_mid(key).alias("_k"), *order, entry.alias("_entry"), F.struct(*pages.columns).alias("_r"),
                        F.explode(copies).alias("_c"))
    both = both.select("_k", *[f"_o{i}" for i in range(len(order_by))], F.col("_c.b").alias("_b"), F.col("_c.probe").alias("_probe"),
                       (F.col("_entry") & ~F.col("_c.probe")).alias("_entry"),
                       F.when(F.col("_entry") & ~F.col("_c.probe"), F.col("_r")).alias("_r"))
    w = Window.partitionBy("_k", "_b").orderBy(*[F.col(f"_o{i}") for i in range(len(order_by))], F.col("_probe"))
    out = both.withColumn("_next", F.lead("_o0").over(w)).where(
        F.col("_entry") & (F.col("_next").isNull() | (F.col("_next") - F.col("_o0") >= within)))
    return out.select(*[F.col(f"_r.{c}").alias(c) for c in pages.columns])
