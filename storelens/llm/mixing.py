"""Operator 4: mixing sources to target weights.

Temperature mixing: a source's weight is its token share to the power ``alpha``, normalised. ``alpha`` is bisected in
0..1: the smallest that keeps every source within ``max_repetition`` epochs, or the largest whose weights reach
``target_entropy`` (nats). The token budget is given, or by default the smallest that shows every source at least
once, so that no document is dropped. A source's quota is its weight of the budget: whole epochs of all its rows, and for
the rest of the quota a prefix of a permutation of its blocks.

Plan: token counts are summed per source (map-side); the weights are computed on the driver from one row per source.
Rows fall into blocks by a hash of their id; block sums (at most ``BLOCKS`` plus one per source) are ranked by a hash of
block and seed and cut at the quota. Only the block in which the quota ends is ordered row by row, so a hot source
is never gathered in one task. The small plan is broadcast (its size follows from ``BLOCKS`` and the number of
sources); texts are not shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCKS = 16_384
MAX_REPETITION = 2.0
OWN = ("mix_tokens", "mix_epoch", "mix_block", "mix_weight", "mix_order")


def weights(tokens: dict[str, int], alpha: float) -> dict[str, float]:
    """Normalised shares to the power alpha; sources without tokens weigh nothing."""
    total = sum(tokens.values())
    raw = {s: (n / total) ** alpha if n else 0.0 for s, n in tokens.items()}
    z = sum(raw.values()) or 1.0
    return {s: v / z for s, v in raw.items()}


def cover_budget(tokens: dict[str, int], w: dict[str, float]) -> float:
    """The smallest budget in which every source's quota is at least its size."""
    return max((n / w[s] for s, n in tokens.items() if n), default=0.0)


def entropy(w: dict[str, float]) -> float:
    return -sum(v * math.log(v) for v in w.values() if v > 0)


def bisect_alpha(tokens: dict[str, int], max_repetition: float | None = MAX_REPETITION,
                 target_entropy: float | None = None, budget: float | None = None, steps: int = 60) -> float:
    """The exponent by bisection. With both limits given the repetition limit wins. If even alpha 1 breaks the
    limit (a budget above ``max_repetition`` times the corpus, or an entropy out of reach), the nearer end is taken."""
    def good(alpha: float) -> bool:
        w = weights(tokens, alpha)
        if max_repetition is not None:
            b = cover_budget(tokens, w) if budget is None else budget
            return all(b * w[s] <= max_repetition * n * (1 + 1e-12) for s, n in tokens.items() if n)
        return entropy(w) <= target_entropy

    if max_repetition is None and target_entropy is None:
        return 1.0
    low, high = 0.0, 1.0
    if good(low):
        return low
    for _ in range(steps):
        mid = (low + high) / 2
        low, high = (low, mid) if good(mid) else (mid, high)
    return high


def mix(docs: DataFrame, max_repetition: float | None = MAX_REPETITION, target_entropy: float | None = None,
        budget: float | None = None, seed: int = 0, id_col: str = "doc_id", source_col: str = "source",
        text_col: str = "text") -> DataFrame:
    """The mixed rows: all columns of ``docs`` plus ``mix_tokens`` (blank-separated words), ``mix_epoch`` (0 on),
    ``mix_block``, ``mix_weight`` (of the source) and ``mix_order`` (0..1: sorting by it interleaves the sources by weight, in
    permuted blocks). Columns of ``docs`` with these names are replaced.

    A null source counts as the source ""; a null or empty text has no tokens and rides along with every whole epoch
    of its source; sources without any token appear once; null ids and repeated rows are rows like any other; an empty
    table gives no rows. A source's tokens exceed its quota by less than one row.
    """
    spark = docs.sparkSession
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}  # no column of docs can meet a helper's name
    id_col, source_col, text_col = names[id_col], names[source_col], names[text_col]
    rows = docs.toDF(*names.values()).withColumns({
        "__source": F.coalesce(F.col(source_col), F.lit("")),
        "mix_tokens": F.size(F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"),
                                                  F.lit(0))).cast("long"),
        "__hash": F.xxhash64(F.col(id_col), F.lit(seed))})
    tokens = {r["s"]: r["n"] for r in rows.groupBy(F.col("__source").alias("s")).agg(F.sum("mix_tokens").alias("n")).collect()}
    total = max(1, sum(tokens.values()))
    w = weights(tokens, bisect_alpha(tokens, max_repetition, target_entropy, budget))
    size = cover_budget(tokens, w) if budget is None else float(budget)
    plan = []
    for s, n in sorted(tokens.items()):
        # cover_budget makes one quota equal to its source's size; rounding must not make it an epoch short
        quota = round(size * w[s])
        epochs, rest = divmod(quota, n) if n else (1, 0)
        plan.append((s, w[s], epochs, rest, max(1, round(BLOCKS * n / total))))
    plan = F.broadcast(spark.createDataFrame(
        plan, "__source string, mix_weight double, __epochs long, __rest long, __blocks long"))
    rows = rows.join(plan, "__source").withColumn("mix_block", F.pmod("__hash", "__blocks"))

    order = F.xxhash64("mix_block", "__epochs", F.lit(seed + 1))
    by = Window.partitionBy("__source").orderBy("__turn", "mix_block").rowsBetween(Window.unboundedPreceding, -1)
    cut = (rows.where("__rest > 0").groupBy("__source", "mix_block", "__epochs", "__rest").agg(F.sum("mix_tokens").alias("__n"))
           .withColumn("__turn", order).withColumn("__before", F.coalesce(F.sum("__n").over(by), F.lit(0)))
           .where("__before < __rest")
           .select("__source", "mix_block", (F.col("__rest") - F.col("__before")).alias("__left"),
                   (F.col("__before") + F.col("__n") > F.col("__rest")).alias("__ends")))
    rows = rows.join(F.broadcast(cut), ["__source", "mix_block"], "left")
    split = F.coalesce(F.col("__ends"), F.lit(False))
    inside = Window.partitionBy("__source", "mix_block").orderBy(F.xxhash64("__hash", F.lit(seed + 2)), id_col, "mix_tokens") \
        .rowsBetween(Window.unboundedPreceding, -1)
    whole = rows.where(~split).withColumn("__extra", F.col("__left").isNotNull())
    ends = rows.where(split).withColumn("__extra", F.coalesce(F.sum("mix_tokens").over(inside), F.lit(0)) < F.col("__left"))
    out = whole.unionByName(ends).withColumn("__copies", F.col("__epochs") + F.col("__extra").cast("long")).where("__copies > 0")
    out = out.withColumn("mix_epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__copies") - 1)))
    place = F.pmod(F.xxhash64("mix_block", "mix_epoch", F.lit(seed + 1)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    out = out.withColumn("mix_order", (F.col("mix_epoch") + place) / (F.col("__epochs") + F.when(
        F.col("__rest") > 0, F.lit(1)).otherwise(F.lit(0))))
    return out.select(*[F.col(n).alias(c) for c, n in names.items() if c not in OWN], *OWN)
