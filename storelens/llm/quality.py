"""Operator 2: quality classifier, ordinal cumulative-link regression on graded ratings.

Grades come from the ratings: 0 toxic, 1 poorly written, 2 good. One weight vector over hashed text features is
shared by all grades; ordered thresholds cut its score: P(grade >= k) = sigmoid(score - cut_k). The model gives the
expected grade and the tail probability P(grade >= 2) by which documents are selected.

Features of a whole text: each distinct word's hashed core and hashed heads of 4 and 5 letters (insults share their
stem), and for the text as a whole the shares of word shapes (capitals, trailing symbols, table bars) and of
repeated neighbours, in bands. Features seen in fewer than ``MIN_DOCS`` sample documents, or whose
grades are as usual (screening, see ``Z``), have no weight.

The fit uses at most ``SAMPLE`` rated documents, the first by a hash of their id (a documented, fixed bound): their ids
are broadcast to one scan, and their hashed features go to the driver. Scoring is one pass over all documents, batch by
batch, without a shuffle.
"""

from __future__ import annotations

import zlib
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.common import returned_memory, text_batches
from storelens.session import ship_package

SAMPLE = 6000
MIN_DOCS = 12
Z = 0.7  # times the logarithm of the sample's size: how far off, in deviations, a feature's grades must be
L2 = 1e-5
WEIGHTING = 0.25
BITS = 20
WHOLE = 4096  # numbers kept for features of the text as a whole, so that no word shares them
SIZE = (1 << BITS) + WHOLE
GRADES = 3
STEPS = 300
_KNOWN = 100_000  # words remembered per Python worker


class Model(NamedTuple):
    weights: object  # numpy float32, SIZE
    cuts: tuple[float, ...]  # ascending, one below each grade from 1


def _crc(kind: str, s: str) -> int:
    return zlib.crc32(f"{kind}{s}".encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1)


def _whole(s: str) -> int:
    return (1 << BITS) + zlib.crc32(s.encode()) % WHOLE


def _shape(word: str) -> str:
    if not any(c.isalnum() for c in word):
        return "bar" if "|" in word else "symbols"
    tail = "marks" if word[-1] in "*#$%&@~^=+<>" else "bang" if word[-1] in "!?" and len(word) > 1 and word[-2] in "!?" else ""
    if len(word) > 2 and word.isupper() and word[:2].isalpha():
        return "capitals" + tail
    return tail or "plain"


def word_features(word: str) -> tuple[tuple[int, ...], str]:
    core = "".join(c for c in word.lower() if c.isalnum())
    ids = (_crc("w", core), _crc("4", core[:4]), _crc("5", core[:5])) if core else ()
    return ids, _shape(word)


def _band(share: float) -> int:
    return 0 if share == 0 else 1 if share < 0.02 else 2 if share < 0.1 else 3 if share < 0.3 else 4 if share < 0.7 else 5


class Features:
    """Distinct feature numbers of a text; words are remembered, up to a bound."""

    def __init__(self):
        self.known: dict[str, tuple[tuple[int, ...], str]] = {}

    def words(self, text: str) -> dict[str, int]:
        counts: dict[str, int] = {}
        for w in text.split():
            counts[w] = counts.get(w, 0) + 1
        if len(self.known) > _KNOWN:
            self.known.clear()
        for w in counts:
            if w not in self.known:
                self.known[w] = word_features(w)
        return counts

    def whole(self, text: str, counts: dict[str, int]) -> list[int]:
        """Features of the text as a whole: shape shares, repetition, in bands."""
        shapes: dict[str, int] = {}
        total = 0
        for w, n in counts.items():
            s = self.known[w][1]
            shapes[s] = shapes.get(s, 0) + n
            total += n
        if not total:
            return [_whole("none")]
        out = [_whole(f"{s}:{_band(n / total)}") for s, n in shapes.items()]
        out.append(_whole(f"distinct{int(10 * len(counts) / total)}{total > 200}"))
        out.append(_whole(f"most{_band(max(counts.values()) / total)}{total > 40}"))
        return out

    def __call__(self, text: str | None) -> list[int]:
        text = text or ""
        counts = self.words(text)
        ids = set(self.whole(text, counts))
        for w in counts:
            ids.update(self.known[w][0])
        return sorted(ids)


def without_copies(rows: list[tuple[int, list[int]]]) -> list[tuple[int, list[int]]]:
    """One row of each group of near copies in the sample (equal grade and equal minima of four hashes of the
    features), so that a text copied a hundred times does not make its own words telling."""
    import numpy as np

    factors, seen, out = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], "u8"), set(), []
    for grade, f in rows:
        x = np.asarray(f, "u8")[:, None] * factors
        key = (grade, tuple(((x ^ (x >> np.uint64(15))) * np.uint64(0x2545F491) % np.uint64(1 << 32)).min(0).tolist())) if len(f) else (grade,)
        if key not in seen:
            seen.add(key)
            out.append((grade, f))
    return out


def fit_rows(rows: list[tuple[int, list[int]]], steps: int = STEPS, min_docs: int = MIN_DOCS) -> Model:
    """``rows``: (grade, feature numbers). Penalised likelihood by full-batch Adam; the cuts stay ordered as the
    first plus positive steps. No rows: a model that gives every document the top grade."""
    import numpy as np

    size = SIZE
    if not rows:
        return Model(np.zeros(size, "f4"), (-20.0,) * (GRADES - 1))
    y = np.array([g for g, _ in rows])
    flat = np.concatenate([np.asarray(f, "i4") for _, f in rows])
    of = np.repeat(np.arange(len(rows), dtype="i4"), [len(f) for _, f in rows])
    n, classes = len(rows), np.eye(GRADES)[y]
    seen = np.bincount(flat, minlength=size)
    share = classes.mean(0)
    # screening: a feature stays if some grade is far from its usual share among the documents that have it
    z = np.zeros(size)
    for k in range(GRADES):
        got = np.bincount(flat, weights=classes[of, k], minlength=size)
        z = np.maximum(z, np.abs(got - seen * share[k]) / np.sqrt(seen * share[k] * (1 - share[k]) + 0.5))
    keep = (z[flat] >= Z * np.log(n)) & (seen[flat] >= min(min_docs, max(2, n // 200)))
    names, cols = np.unique(flat[keep], return_inverse=True)
    of = of[keep]
    w, cut, step = np.zeros(len(names)), -1.0, np.zeros(GRADES - 2)
    params = np.concatenate([w, [cut], step])
    m = v = np.zeros_like(params)
    prior = np.bincount(y, minlength=GRADES) / n
    each = 1 / np.maximum(prior, 1e-3)
    each = (each / each[y].mean())[y] ** WEIGHTING
    for t in range(1, steps + 1):
        x = np.bincount(of, weights=params[cols], minlength=n)
        gaps = np.exp(params[len(names) + 1:])
        cuts = params[len(names)] + np.concatenate([[0.0], np.cumsum(gaps)])
        above = np.column_stack([np.ones(n), *(1 / (1 + np.exp(-np.clip(x - c, -30, 30))) for c in cuts), np.zeros(n)])
        p = np.maximum(above[np.arange(n), y] - above[np.arange(n), y + 1], 1e-9)
        slope = above * (1 - above)
        up, down = slope[np.arange(n), y] / p, slope[np.arange(n), y + 1] / p
        gx = each * (down - up)  # d(-log p) / d score
        g_cut = np.empty(GRADES - 1)
        for k in range(GRADES - 1):
            g_cut[k] = (each * (np.where(y == k + 1, up, 0.0) - np.where(y == k, down, 0.0))).sum()
        grad = np.empty_like(params)
        grad[:len(names)] = np.bincount(cols, weights=gx[of], minlength=len(names)) / n + L2 * params[:len(names)]
        grad[len(names)] = g_cut.sum() / n
        for j in range(GRADES - 2):
            grad[len(names) + 1 + j] = g_cut[j + 1:].sum() * gaps[j] / n
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        params = params - 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
        # features only speak against a text: a short text that holds few of them is not worse for it
        np.minimum(params[:len(names)], 0.0, out=params[:len(names)])
    weights = np.zeros(size, "f4")
    weights[names] = params[:len(names)]
    cuts = params[len(names)] + np.concatenate([[0.0], np.cumsum(np.exp(params[len(names) + 1:]))])
    return Model(weights, tuple(float(c) for c in cuts))


def graded(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``doc_id, grade`` from ratings (quality 0/1, toxic 0/1); a document rated twice has its lowest grade; null
    ids and rows without a quality are not rated; a null toxic counts as 0."""
    toxic = F.coalesce(F.col("toxic"), F.lit(0)) > 0
    grade = F.when(toxic, 0).when(F.col("quality") <= 0, 1).otherwise(2)
    return (labels.where(F.col(id_col).isNotNull() & F.col("quality").isNotNull())
            .groupBy(F.col(id_col).alias("doc_id")).agg(F.min(grade).alias("grade")))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """The model from at most ``sample`` rated documents, the first by a hash of the id."""
    import numpy as np

    ship_package(docs.sparkSession)
    text_batches(docs.sparkSession)
    some = F.broadcast(graded(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rated = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(some, "doc_id").select("grade", "text")

    def features(batches):
        import pyarrow as pa

        make = Features()
        with returned_memory():
            for part in _slices(batches):
                packed = [np.array(make(t), "<i4").tobytes() for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(packed, pa.binary())], names=["grade", "features"])
            make.known.clear()

    # numbers travel as bytes: the driver never holds them as Python objects
    rows = sorted((r["grade"], bytes(r["features"])) for r in rated.mapInArrow(features, "grade int, features binary").collect())
    return fit_rows(without_copies([(g, np.frombuffer(f, "<i4")) for g, f in rows]))


def _slices(batches, rows: int = 512):
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


class Scorer:
    """Scores of whole texts; a word's share of the score is looked up once per distinct word."""

    def __init__(self, model: Model):
        import numpy as np

        self.np, self.model, self.make = np, model, Features()
        self.w = model.weights

    def __call__(self, texts: list[str | None]):
        np = self.np
        out = np.empty(len(texts))
        for i, t in enumerate(texts):
            out[i] = float(self.w[np.asarray(self.make(t), "i8")].sum())
        return out

    def tails(self, texts):
        """P(grade >= k) for k from 1, one column each."""
        x = self(texts)
        return self.np.column_stack([1 / (1 + self.np.exp(-self.np.clip(x - c, -30, 30))) for c in self.model.cuts])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, expected_grade`` (0 to 2), ``p_good`` (P(grade >= 2)), ``p_fair`` (P(grade >= 1)).

    Null and empty texts are scored as texts without words; null ids and repeated rows are kept; an empty table gives
    no rows. Other columns are ignored.
    """
    ship_package(docs.sparkSession)
    text_batches(docs.sparkSession)

    def run(batches):
        import pyarrow as pa

        scorer = Scorer(model)
        with returned_memory():
            for b in _slices(batches):
                tails = scorer.tails(b.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(tails.sum(1)), pa.array(tails[:, -1]), pa.array(tails[:, 0])],
                                                 names=["doc_id", "expected_grade", "p_good", "p_fair"])
            scorer.make.known.clear()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col)).mapInArrow(
        run, "doc_id long, expected_grade double, p_good double, p_fair double")


def select_good(docs: DataFrame, model: Model, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose P(grade >= 2) is at least ``threshold``."""
    ship_package(docs.sparkSession)
    text_batches(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches):
        import pyarrow as pa

        scorer = Scorer(model)
        with returned_memory():
            for b in _slices(batches):
                yield b.filter(pa.array(scorer.tails(b.column(at).to_pylist())[:, -1] >= threshold))
            scorer.make.known.clear()

    return docs.mapInArrow(run, docs.schema)
