"""Operator 5: shards by a consistent-hash ring with virtual nodes and bounded loads.

The ring is cut into a fixed number of cells. A text's 64-bit hash gives its cell, so equal texts start at
the same place; a cell's home is the first virtual node at or after it, clockwise. Keys are placed in ring
order: a key whose shard is full continues clockwise to the next virtual node whose shard has room. With
``slack=0`` the capacities are the exact shares (row counts at most one apart); with a larger slack a shard
takes up to ``ceil((1 + slack) * rows / shards)`` rows and fewer keys leave their home.

Plan: one pass reads the texts and writes narrow rows (id, size, checksum, hash). Row counts per cell are
summed map-side; cells with many rows (a third of all rows may be copies of one text) are cut by a hash of
the id into blocks, so that no window holds more than about ``1 / BLOCKS`` of the rows. The block counts (at most
``CELLS + BLOCKS`` small rows, whatever the input) are walked clockwise once on the driver; this gives each block's
segments (first rows to this shard, next rows to that one). Rows get their rank in their block and look
their segment up in that bounded table. No step is Python on the executors.
"""

from __future__ import annotations

import bisect
import hashlib
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.llm.common import write_once

CELL_BITS = 14
CELLS = 1 << CELL_BITS
BLOCKS = 4096
VNODES = 64


def ring(shards: int, vnodes: int = VNODES) -> tuple[list[int], list[int]]:
    """Positions (cells, ascending) of the virtual nodes and their shards. A shard's nodes do not depend
    on how many shards there are, so one more shard only adds its own nodes."""
    nodes = sorted((int.from_bytes(hashlib.md5(f"{s}:{v}".encode()).digest()[:8], "big") % CELLS, s)
                   for s in range(shards) for v in range(vnodes))
    return [p for p, _ in nodes], [s for _, s in nodes]


def place(blocks: list[tuple[int, int, int]], shards: int, slack: float = 0.0,
          vnodes: int = VNODES) -> list[tuple[int, int, list[tuple[int, int, int]]]]:
    """``blocks``: (cell, salt, rows) in any order. Gives (cell, salt, segments); a segment is (upto, shard,
    shift): the rows ranked below ``upto`` and above the last segment go to ``shard`` at slot rank + shift."""
    total = sum(n for _, _, n in blocks)
    if slack > 0:
        room = [math.ceil((1 + slack) * total / shards)] * shards
    else:
        room = [total // shards + (s < total % shards) for s in range(shards)]
    at, owner = ring(shards, vnodes)
    used = [0] * shards
    out = []
    for cell, salt, n in sorted(blocks):
        i = bisect.bisect_left(at, cell)
        done, segments = 0, []
        while done < n:
            s = owner[i % len(owner)]
            take = min(n - done, room[s] - used[s])
            if take > 0:
                segments.append((done + take, s, used[s] - done))
                used[s] += take
                done += take
            i += 1
        out.append((cell, salt, segments))
    return out


def assign_shards(docs: DataFrame, shards: int = 40, slack: float = 0.0, id_col: str = "doc_id",
                  text_col: str = "text", vnodes: int = VNODES) -> DataFrame:
    """One row per input row: ``doc_id, size, text_crc32, law, shard, slot, grown_shard, home_shard``.

    ``size``: UTF-8 bytes of the text plus 16 (null text: 16, checksum 0; an empty text likewise); ``slot`` is
    gapless from 0 in each shard; ``home_shard`` is the ring's shard before overflow; ``law`` is ``rows`` for
    slack 0, else ``bounded``; ``grown_shard`` is null, as no key-only law holds. Null ids are placed like any
    other; repeated rows are separate rows. Copies of one text stay together until their shard is full. An
    empty table gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + F.lit(16)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("h"))
    rows = rows.withColumn("cell", F.shiftrightunsigned("h", 64 - CELL_BITS).cast("int"))
    rows = write_once(rows, "shard-keys")

    counts = {r["cell"]: r["n"] for r in rows.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    most = max(1, math.ceil(sum(counts.values()) / BLOCKS))
    cut = [(c, -(-n // most)) for c, n in counts.items() if n > most]
    salts = spark.createDataFrame(cut, "cell int, salts int")
    salted = (rows.join(F.broadcast(salts), "cell", "left")
              .withColumn("salt", F.when(F.col("salts").isNull(), F.lit(0)).otherwise(
                  F.pmod(F.xxhash64("doc_id", F.lit(5)), F.col("salts"))).cast("int")))
    blocks = salted.groupBy("cell", "salt").agg(F.count("*").alias("n")).collect()
    at, owner = ring(shards, vnodes)
    plan = [(c, s, owner[bisect.bisect_left(at, c) % len(owner)], segments)
            for c, s, segments in place([(r["cell"], r["salt"], r["n"]) for r in blocks], shards, slack, vnodes)]
    segment = T.StructType([T.StructField(n, T.LongType()) for n in ("upto", "shard", "shift")])
    table = spark.createDataFrame(plan, T.StructType([
        T.StructField("cell", T.IntegerType()), T.StructField("salt", T.IntegerType()),
        T.StructField("home_shard", T.IntegerType()), T.StructField("segments", T.ArrayType(segment))]))

    w = Window.partitionBy("cell", "salt").orderBy("h", "doc_id", "size")
    ranked = salted.withColumn("rank", F.row_number().over(w).cast("long") - 1).join(
        F.broadcast(table), ["cell", "salt"])
    ranked = ranked.withColumn("seg", F.filter("segments", lambda s: F.col("rank") < s["upto"])[0])
    return ranked.select(
        "doc_id", "size", "text_crc32", F.lit("rows" if slack <= 0 else "bounded").alias("law"),
        F.col("seg.shard").cast("int").alias("shard"), (F.col("rank") + F.col("seg.shift")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "home_shard")
