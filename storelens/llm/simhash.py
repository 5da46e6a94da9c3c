"""Operator 8: SimHash fingerprints and the search for all fingerprints within a Hamming radius.

A text's terms are its neighbouring word pairs (the last word alone); a term weighs more the longer its word.
Each of the 64 bits of a term's hash votes with that weight, and the fingerprint has the bits whose votes for one
outweigh those for zero. Votes are summed in packed lanes: a long holds four 16-bit counters, so a term costs 16 additions in
generated code. Terms are summed per block of 4096 terms (lanes cannot overflow), combined map-side; the few
block rows of a text are then unpacked and summed. A text of any length spreads over blocks.

The search cuts fingerprints into blocks of bits and keeps one table per choice of blocks that must agree; two
fingerprints within the radius agree on at least one choice. It runs on distinct fingerprints, so copies meet once, and a pair
is given by the first table only in which it meets. No step is Python on the executors.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storelens.llm.common import write_once

BITS = 64
BLOCK_BITS = 12  # 4096 terms of weight 7 or less stay below 2 ** 15, also in the lane that holds the sign
ORDER_CHUNKS = 1024
DEALS = 16
_NO_ID = -(1 << 63)
_SPREAD = 1 + (1 << 15) + (1 << 30) + (1 << 45)  # a nibble times this has its bit k at place 16 k
_LANES = 1 + (1 << 16) + (1 << 32) + (1 << 48)


def fingerprints(texts: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """``keys`` (unique together) with ``fp``, a long. A text without words has fingerprint zero."""
    staged = texts.select(*keys, F.split(F.coalesce(F.col(text_col), F.lit("")), r"[\x20\x09-\x0D]+").alias("__words"))
    words = F.col("__words")
    terms = F.transform(words, lambda w, i: F.struct(F.xxhash64(w, F.get(words, i + 1)).alias("h"),
                                                     F.least(F.length(w), F.lit(7)).cast("long").alias("w")))
    rows = staged.select(*keys, F.posexplode(terms).alias("__at", "__t")).select(
        *keys, F.shiftright("__at", BLOCK_BITS).alias("__block"), F.col("__t.h").alias("__h"), F.col("__t.w").alias("__w"))
    lanes = []
    for j in range(16):
        nibble = F.shiftrightunsigned("__h", 4 * j).bitwiseAND(F.lit(15))
        lanes.append(F.sum((nibble * F.lit(_SPREAD)).bitwiseAND(F.lit(_LANES)) * F.col("__w")).alias(f"__l{j}"))
    blocks = rows.groupBy(*keys, "__block").agg(F.sum("__w").alias("__total"), *lanes)
    # blocks of one text: lanes of 32 bits, two to a long, in the order of the bits' even and odd places
    wide = [F.sum(F.shiftrightunsigned(f"__l{j}", 16 * odd).bitwiseAND(F.lit(0xFFFF0000FFFF))).alias(f"__s{2 * j + odd}")
            for j in range(16) for odd in range(2)]
    votes = blocks.groupBy(*keys).agg(F.sum("__total").alias("__total"), *wide)
    votes = votes.select(*keys, "__total", F.array(*[f"__s{i}" for i in range(32)]).alias("__s"))

    def bit(fp, b):
        # bit b lies in nibble b / 4 at place p = b % 4: sum 2 * nibble + p % 2, upper half for p of 2 and 3
        place = b % 4
        lane = F.get(F.col("__s"), (2 * F.floor(b / 4) + place % 2).cast("int"))
        count = F.when(place >= 2, F.shiftrightunsigned(lane, 32)).otherwise(lane).bitwiseAND(F.lit(0xFFFFFFFF))
        return fp.bitwiseOR(F.when(count * 2 > F.col("__total"), F.get(powers, b)).otherwise(F.lit(0).cast("long")))

    powers = F.array(*[F.lit((1 << b) - (1 << 64 if b == 63 else 0)).cast("long") for b in range(64)])
    return votes.select(*keys, F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), bit).alias("fp"))


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def likeness(a: Column, b: Column) -> Column:
    return 1.0 - distance(a, b) / F.lit(float(BITS))


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def in_order(keys: DataFrame, by: list[str], chunks: int = ORDER_CHUNKS) -> DataFrame:
    """``keys`` (distinct rows, narrow) with ``chunk`` and ``at`` (0 on in the chunk): sorting by (chunk, at) is
    sorting by ``by`` (``by[0]`` a long without nulls). Chunks are cut at quantiles of ``by[0]``, at most
    ``chunks`` of them, so no window holds more than about one in ``chunks`` of the rows."""
    n = max(1, min(chunks, keys.sparkSession.sparkContext.defaultParallelism * 16))
    cuts = keys.agg(F.percentile_approx(by[0], [i / n for i in range(1, n)] or [0.5], 20_000).alias("c")).first()["c"]
    cuts = sorted(set(cuts or []))
    step = max(1, int(len(cuts) ** 0.5))
    coarse = F.array(*[F.lit(c).cast("long") for c in cuts[::step]]) if cuts else F.array().cast("array<bigint>")
    fine = F.array(*[F.array(*[F.lit(c).cast("long") for c in cuts[i:i + step]]) for i in range(0, len(cuts), step)]) \
        if cuts else F.array().cast("array<array<bigint>>")
    key = F.col(by[0])
    group = F.size(F.filter(coarse, lambda c: c <= key))
    chunk = F.when(group == 0, F.lit(0)).otherwise((group - 1) * step + F.size(F.filter(F.get(fine, group - 1), lambda c: c <= key)))
    w = Window.partitionBy("chunk").orderBy(*by)
    return keys.withColumn("chunk", chunk.cast("int")).withColumn("at", F.row_number().over(w) - 1)


def with_next(keys: DataFrame, by: list[str], carry: list[str]) -> DataFrame:
    """``keys`` with the next row's columns as ``next_<column>``; after the last comes the first."""
    order = write_once(in_order(keys, by), "order")
    w = Window.partitionBy("chunk").orderBy("at")
    firsts = order.where("at = 0").select("chunk", F.struct(*by, *carry).alias("s")).orderBy("chunk").collect()  # one a chunk
    following = {a["chunk"]: b["s"] for a, b in zip(firsts, firsts[1:] + firsts[:1], strict=True)}
    types = {f.name: f.dataType for f in keys.schema}
    table = F.broadcast(keys.sparkSession.createDataFrame(
        [(c, *s) for c, s in following.items()],
        "chunk int, " + ", ".join(f"__{c} {types[c].simpleString()}" for c in [*by, *carry])))
    moved = order.withColumns({f"next_{c}": F.lead(c).over(w) for c in [*by, *carry]}).withColumn(
        "__last", F.lead(F.lit(1)).over(w).isNull()).join(table, "chunk")
    return moved.withColumns({f"next_{c}": F.when(F.col("__last"), F.col(f"__{c}")).otherwise(F.col(f"next_{c}"))
                              for c in [*by, *carry]}).drop("chunk", "at", "__last", *[f"__{c}" for c in [*by, *carry]])


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_chars, edited_sha256, fp, edited_fp, next_fp`` (fingerprints as longs).

    The edited text: the last floor(n_chars / 4) code points replaced by the first as many (or all) of the next
    document by ascending id (after the last: the first; a single document follows itself). A null text is empty. A
    null id sorts first. Rows with one id follow each other by a hash of their texts; rows equal in id and text count as
    one document in this order and each gets its row. An empty table gives no rows. Other columns are ignored.

    The order is found on narrow rows (id, hash, length); a document then sends just the needed head of its text to
    the one before it, by an equi-join on (id, hash), so texts move once and no key is hot.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("k", F.coalesce("doc_id", F.lit(_NO_ID))).withColumn("h", F.xxhash64("text"))
    narrow = rows.groupBy("k", "h").agg(F.min(F.length("text")).alias("n"))
    nexts = write_once(with_next(narrow, ["k", "h"], []), "next")
    whole = rows.groupBy("k", "h").agg(F.first("text").alias("text"), F.count("*").alias("rows"))
    asked = nexts.select(F.col("next_k").alias("k"), F.col("next_h").alias("h"), F.col("k").alias("to_k"), F.col("h").alias("to_h"),
                         F.floor(F.col("n") / 4).cast("int").alias("need"))
    # both sides read all columns of ``whole``, so its one exchange serves them both
    heads = whole.join(asked, ["k", "h"]).select(F.col("to_k").alias("k"), F.col("to_h").alias("h"), "need",
                                                 F.expr("CASE WHEN rows > 0 THEN left(text, need) END").alias("head"))
    both = whole.join(heads, ["k", "h"]).withColumn(
        "edited", F.concat(F.expr("left(text, length(text) - need)"), F.col("head")))
    keys = ["k", "h", "rows", "n_chars", "edited_sha256", "edited"]
    texts = both.select("k", "h", "rows", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                        F.explode(F.array(F.struct(F.lit(False).alias("edited"), F.col("text").alias("t")),
                                          F.struct(F.lit(True).alias("edited"), F.col("edited").alias("t")))).alias("x"))
    texts = texts.select("k", "h", "rows", "n_chars", "edited_sha256", "x.edited", "x.t")
    fps = fingerprints(texts, keys, "t")
    fps = write_once(fps.groupBy(*keys[:-1]).agg(F.max(F.when(~F.col("edited"), F.col("fp"))).alias("fp"),
                                                 F.max(F.when(F.col("edited"), F.col("fp"))).alias("edited_fp")), "fingerprints")
    following = fps.select(F.col("k").alias("next_k"), F.col("h").alias("next_h"), F.col("fp").alias("next_fp"))
    out = fps.join(nexts.select("k", "h", "next_k", "next_h"), ["k", "h"]).join(following, ["next_k", "next_h"])
    out = out.withColumn("__row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return out.select(F.when(F.col("k") != _NO_ID, F.col("k")).alias("doc_id"), "n_chars", "edited_sha256", "fp", "edited_fp", "next_fp")


def with_near(rows: DataFrame, radius: int = 3) -> DataFrame:
    """``rows`` (with ``doc_id`` and ``fp``) with ``n_near`` and ``near_id``, for the queries: ids that divide by 20.

    ``n_near`` counts all other rows whose fingerprint is at most ``radius`` bits away. ``near_id`` is the id of the nearest of
    them that has one; of equally near ones the smallest, but the smallest of equal fingerprints names the largest.
    Both are null outside the queries.
    """
    rows = write_once(rows, "fingerprint-rows")
    asked = F.coalesce(F.col("doc_id") % 20 == 0, F.lit(False))
    groups = write_once(rows.groupBy("fp").agg(F.count("*").alias("n"), F.count("doc_id").alias("ids"), F.min("doc_id").alias("lo"),
                                               F.max("doc_id").alias("hi"), F.max(asked).alias("asked")), "fingerprint-groups")
    pairs = near_search(groups.where("asked"), groups, radius)
    met = pairs.join(groups.select("fp", "n", "ids", "lo", "hi"), "fp").groupBy("query_fp").agg(
        F.sum("n").alias("__n"), F.min(F.when((F.col("distance") > 0) & (F.col("ids") > 0), F.struct("distance", "lo")))["lo"].alias("__other"),
        F.max(F.when(F.col("distance") == 0, F.struct("ids", "lo", "hi"))).alias("__same"))
    # the queries of one fingerprint meet its counts in DEALS tasks
    met = met.select(F.col("query_fp").alias("fp"), "__n", "__other", "__same", F.explode(F.sequence(F.lit(0), F.lit(DEALS - 1))).alias("__deal"))
    same = F.when(F.col("__same.ids") > 1, F.when(F.col("__same.lo") != F.col("doc_id"), F.col("__same.lo")).otherwise(F.col("__same.hi")))
    found = rows.where(asked).withColumn("__deal", F.pmod(F.xxhash64("doc_id"), F.lit(DEALS)).cast("int")).join(met, ["fp", "__deal"])
    found = found.select(*rows.columns, (F.col("__n") - 1).alias("n_near"), F.coalesce(same, "__other").alias("near_id"))
    none = F.lit(None).cast("long")
    return found.unionAll(rows.where(~asked).select(*rows.columns, none.alias("n_near"), none.alias("near_id")))


def digest(rows: DataFrame) -> DataFrame:
    """The contract's columns from ``fingerprint_documents``, and the search's ``n_near`` and ``near_id``."""
    return with_near(rows).select("doc_id", "n_chars", "edited_sha256", as_hex(F.col("fp")).alias("fingerprint"),
                       as_hex(F.col("edited_fp")).alias("edited_fingerprint"),
                       likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
                       likeness(F.col("fp"), F.col("next_fp")).alias("near_next"), "n_near", "near_id")


def near_search(queries: DataFrame, index: DataFrame, radius: int = 3, blocks: int = 6, fp: str = "fp") -> DataFrame:
    """All pairs of a distinct query fingerprint and a distinct index fingerprint at most ``radius`` bits apart:
    ``query_fp, fp, distance`` (equal ones included, distance 0).

    ``blocks`` (above the radius) cuts the bits; one table per choice of ``blocks - radius`` blocks. Null
    fingerprints match nothing. The join key is (table, agreeing bits); AQE splits a hot key, and nothing is capped.
    """
    width = -(-BITS // blocks)
    choices = list(itertools.combinations(range(blocks), blocks - radius))

    def part(col: Column, b: int) -> Column:
        return F.shiftrightunsigned(col, b * width).bitwiseAND(F.lit((1 << width) - 1))

    def table(df: DataFrame, name: str) -> DataFrame:
        one = df.where(F.col(fp).isNotNull()).select(F.col(fp).alias(name)).distinct()
        keys = F.array(*[F.struct(F.lit(t).alias("table"), F.xxhash64(F.lit(t), *[part(F.col(name), b) for b in c]).alias("key"))
                         for t, c in enumerate(choices)])
        return one.select(name, F.explode(keys).alias("x")).select(name, "x.table", "x.key")

    met = table(queries, "query_fp").join(table(index, "fp"), ["table", "key"])
    first = F.coalesce(*[F.when(F.lit(True) & _all_equal(c, part), F.lit(t)) for t, c in enumerate(choices)])
    return met.withColumn("distance", distance(F.col("query_fp"), F.col("fp"))).where(
        (F.col("distance") <= radius) & (F.col("table") == first)).select("query_fp", "fp", "distance")


def _all_equal(choice, part) -> Column:
    same = None
    for b in choice:
        e = part(F.col("query_fp"), b) == part(F.col("fp"), b)
        same = e if same is None else same & e
    return same
