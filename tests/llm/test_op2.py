"""Operator 2: held-out accuracy on the given ratings, the fit against known weights, and edge rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from storelens.llm import quality, queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_held_out(spark, tables):
    docs, labels = tables
    first, last = labels.where(F.col("doc_id") % 2 == 0), labels.where(F.col("doc_id") % 2 == 1)
    model = quality.fit(docs, first)
    got = quality.score(docs, model).join(quality.graded(last), "doc_id").collect()
    good = [r for r in got if r.grade == 2]
    poor = [r for r in got if r.grade < 2]
    assert np.mean([r.p_good >= 0.5 for r in good]) > 0.96 and np.mean([r.p_good < 0.5 for r in poor]) > 0.65
    assert np.mean([r.expected_grade for r in good]) > np.mean([r.expected_grade for r in poor]) + 0.8


def test_query_and_selection_agree(spark, tables):
    docs, labels = tables
    got = queries.op2_ordinal_quality(spark, SF).collect()
    assert len(got) == docs.count()
    for r in got:
        assert 0 <= r.p_good <= r.p_fair <= 1 and abs(r.expected_grade - r.p_good - r.p_fair) < 1e-9
    kept = quality.select_good(docs, quality.fit(docs, labels))
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if r.p_good >= 0.5}


def test_fit_orders_grades():
    rng = random.Random(1)
    rows = []
    for i in range(600):
        grade = i % 3
        rows.append((grade, sorted({*([7] if grade == 0 else [11] if grade == 1 else []), *(rng.randrange(100, 400) for _ in range(20))})))
    m = quality.fit_rows(rows)
    assert m.cuts[0] < m.cuts[1] and m.weights[7] < m.weights[11] < 0
    score = [sum(float(m.weights[i]) for i in f) for _, f in rows]
    pred = [sum(s > c for c in m.cuts) for s in score]
    assert np.mean([p == g for p, (g, _) in zip(pred, rows, strict=True)]) > 0.95
    assert len(quality.without_copies(rows + rows)) == len(quality.without_copies(rows)) == 600


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "word " * 300_000), (None, "no id"), (5, "same same"), (5, "same same"), (6, "퟿ \U0001F600 | !! ***")]
    docs = spark.createDataFrame([(*r, 0, 0.5) for r in rows], "doc_id long, text string, grade int, p_good double")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (3, None, 1), (None, 1, 1), (5, 1, None), (5, 0, 0)], "doc_id long, quality int, toxic int")
    assert {(r.doc_id, r.grade) for r in quality.graded(labels).collect()} == {(1, 2), (2, 0), (5, 1)}
    assert quality.score(docs, quality.fit(docs, labels)).count() == len(rows)
    blank = quality.fit(docs, labels.limit(0))
    assert quality.select_good(docs, blank).count() == len(rows)  # without ratings nothing is rejected
    assert quality.score(docs.limit(0), blank).count() == 0
