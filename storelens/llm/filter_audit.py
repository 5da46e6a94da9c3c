"""Operator 11: how text filters interact, over every order in which they could run.

A document's failures of the five filters are a mask of five bits. Filters A to D are expressions on the text; E (the
same text under a smaller id) is settled from 32-byte digests, never from shuffled texts. Documents of one part and mask
behave alike in every order, so they are counted into at most 32 cells a part. Each cell then folds across the constant
array of the 120 orders (``aggregate`` along an order inside a ``transform`` over the orders), which gives 600 structs
weighted by the cell's counts; a part's cells are merged by elementwise sums. All of it is SQL higher-order functions.

Copies: counts are combined per (text, part, mask, labels) before they meet, so a text with a third of all rows
reaches the step that finds its smallest id as a few rows.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storelens.llm.common import write_once

FILTERS = "ABCDE"
ORDERS = tuple("".join(p) for p in permutations(FILTERS))
BLANKS = r"[\x20\x09-\x0D]+"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def _bit(letter: str) -> int:
    return 1 << FILTERS.index(letter)


def text_mask(text: Column) -> Column:
    """Bits of filters A (under 100 words), B (under 80 % distinct words), C (over 10 % capitals) and D (a symbol) that a text
    fails; words are runs without blanks, case-sensitive."""
    words = F.filter(F.split(text, BLANKS), lambda w: w != "")

    def bits(ws: Column) -> Column:
        capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
        return (F.when(F.size(ws) < 100, _bit("A")).otherwise(0)
                + F.when(F.lit(100) * F.size(F.array_distinct(ws)) < F.lit(80) * F.size(ws), _bit("B")).otherwise(0)
                + F.when(F.lit(100).cast("long") * capitals > F.lit(10).cast("long") * F.length(text), _bit("C")).otherwise(0)
                + F.when(text.rlike("[#$%&*|]"), _bit("D")).otherwise(0)).cast("int")

    return F.transform(F.array(words), bits)[0]  # the words are split once


def mask_cells(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               part_col: str = "lang") -> DataFrame:
    """Counts of documents by part and failure mask: ``part, mask, n, good, toxic``."""
    # the digests and masks of all rows are written once (some 50 bytes a row): texts are read a single time
    narrow = write_once(docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text_col), F.lit("")).alias("body"))
        .select("id", "part", text_mask(F.col("body")).alias("mask"), F.unhex(F.sha2("body", 256)).alias("digest")), "filter-masks")
    rows = narrow.groupBy("id", "part", "mask", "digest").agg(F.count("*").alias("n"))  # repeated rows become one
    marks = (labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("id"))
             .agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
                  F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")))
    marked = rows.join(marks, "id", "left").fillna(0, ["good", "toxic"])
    # per text and kind of row: how many, and how many under the smallest id (rows without id are never later copies)
    kinds = marked.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("id").isNotNull(), F.col("n")).otherwise(0)).alias("with_id"),
        F.min("id").alias("low"), F.min_by("n", "id").alias("at_low"))
    first = F.min("low").over(Window.partitionBy("digest"))
    later = F.coalesce(F.col("with_id") - F.when(F.col("low") == F.col("first"), F.col("at_low")).otherwise(0), F.lit(0))
    split = kinds.withColumn("first", first).select(
        "part", "good", "toxic", F.explode(F.array(
            F.struct((F.col("mask") + _bit("E")).alias("mask"), later.alias("n")),
            F.struct(F.col("mask"), (F.col("n") - later).alias("n")))).alias("c"))
    return split.groupBy("part", F.col("c.mask").alias("mask")).agg(
        F.sum("c.n").alias("n"), F.sum(F.col("c.n") * F.col("good")).alias("good"),
        F.sum(F.col("c.n") * F.col("toxic")).alias("toxic"))


_ROW = "struct<" + ",".join(f"{c}:long" for c in COUNTS) + ">"
_ROWS = f"array<{_ROW}>"


def _orders() -> Column:
    """The constant array of all orders, each the places of its filters in ``FILTERS``."""
    return F.from_json(F.lit(str([[FILTERS.index(f) for f in o] for o in ORDERS])), "array<array<int>>")


def _fold(cell: Column) -> Column:
    """One cell's 600 weighted structs: for each order, a fold along its steps."""
    mask = cell["mask"]

    def count(condition: Column, weight: str) -> Column:
        return F.when(condition, cell[weight]).otherwise(F.lit(0).cast("long"))

    def step(state: Column, place: Column) -> Column:
        fails, alive = F.getbit(mask, place) == 1, state["alive"]
        row = F.struct(
            count(alive & ~fails, "n").alias("kept"), count(alive & fails, "n").alias("removed"),
            count(~alive & fails, "n").alias("redundant"), count(mask == F.call_function("shiftleft", F.lit(1), place), "n").alias("unique_fails"),
            count(alive & fails, "good").alias("good_lost"), count(alive & fails, "toxic").alias("toxic_lost"))
        return F.struct((alive & ~fails).alias("alive"), F.concat(state["rows"], F.array(row)).alias("rows"))

    start = F.struct(F.lit(True).alias("alive"), F.array().cast(_ROWS).alias("rows"))
    return F.flatten(F.transform(_orders(), lambda order: F.aggregate(order, start, step, lambda s: s["rows"])))


def _add(a: Column, b: Column) -> Column:
    """Elementwise sums of two arrays of counts."""
    return F.zip_with(a, b, lambda x, y: F.struct(*[(x[c] + y[c]).alias(c) for c in COUNTS]))


def fold_orders(cells: DataFrame) -> DataFrame:
    """``mask_cells``' rows to ``part, filter_order, step`` and the counts: 600 rows a part, zeros included."""
    n = len(ORDERS) * len(FILTERS)
    zeros = F.array_repeat(F.struct(*[F.lit(0).cast("long").alias(c) for c in COUNTS]), n)
    # a part has at most 32 cells
    merged = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells")).select(
        "part", F.aggregate("cells", zeros, lambda acc, cell: _add(acc, _fold(cell))).alias("sums"))
    places = F.flatten(_orders())
    shapley = F.transform(F.sequence(F.lit(0), F.lit(len(FILTERS) - 1)), lambda f: F.aggregate(
        F.zip_with("sums", places, lambda s, p: F.when(p == f, s["removed"]).otherwise(F.lit(0).cast("long"))),
        F.lit(0).cast("long"), lambda a, x: a + x))
    orders = F.split(F.lit(",".join(ORDERS)), ",")
    step = F.transform("sums", lambda s, i: F.struct(
        F.get(orders, (i / len(FILTERS)).cast("int")).alias("filter_order"), (i % len(FILTERS) + 1).cast("int").alias("step"),
        *[s[c].alias(c) for c in COUNTS], F.get("shapley", F.get(places, i)).alias("shapley")))
    return merged.withColumn("shapley", shapley).select("part", F.inline(step))


def audit_filters(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  part_col: str = "lang") -> DataFrame:
    """One row per part, order and step: ``part, filter_order, step`` (1 to 5) and, for the step's filter, ``kept, removed,
    redundant, unique_fails, good_lost, toxic_lost, shapley``.

    A null text is empty, a null part is the empty string. E holds for a row whose text stands under a smaller id anywhere
    in the table; rows that repeat an id are not copies of each other, and a row without id is no copy and makes none. A
    document is good or toxic if any label row of its id says so; other columns, of either table, are ignored. Texts of
    any length are taken whole; an empty table gives no rows.
    """
    return fold_orders(mask_cells(docs, labels, id_col, text_col, part_col))
