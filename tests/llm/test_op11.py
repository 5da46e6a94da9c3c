"""Operator 11 against a plain Python walk through every order, and on edge rows."""

import re
from collections import Counter
from itertools import permutations

import pytest

from storelens.llm import filter_audit, queries

SF = "/root/testdata/sf0.001"
COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
WORDS = " ".join(f"w{i}" for i in range(100))
EDGE = [
    (1, None, "en"), (2, "", None), (3, WORDS, "en"), (4, WORDS, "de"), (4, WORDS, "de"), (4, WORDS, "en"), (None, WORDS, "en"),
    (5, "a " * 100, "en"), (6, "A" * 11 + "b" * 89, ""), (7, "A" * 10 + "b" * 90, None), (8, WORDS + " #", "en"), (9, WORDS + "\u2003x", "en"),
    (10, "é\x0bé\x1cé " * 60, "fr"), (11, "y" * 300_000, "fr"), (12, "z " * 150_000, "fr"), (2, "", None), (13, WORDS.upper(), "en"),
]
LABELS = [(1, 1, 0), (4, 0, 1), (4, 1, None), (None, 1, 1), (5, None, 1), (99, 1, 1), (11, 1, 1)]


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    low = {}
    for i, t, _ in rows:
        if i is not None:
            low[t or ""] = min(i, low.get(t or "", i))
    docs = []
    for i, t, lang in rows:
        t = t or ""
        ws = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(ws) < 100, "B": 100 * len(set(ws)) < 80 * len(ws), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and low[t] < i}
        docs.append((lang or "", {k for k, v in fails.items() if v}, i in good, i in toxic))
    out, shapley = {}, Counter()
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        for order in permutations("ABCDE"):
            alive = mine
            for s, f in enumerate(order):
                gone = [d for d in alive if f in d[1]]
                alive = [d for d in alive if f not in d[1]]
                shapley[part, f] += len(gone)
                out[part, "".join(order), s + 1] = [
                    len(alive), len(gone), sum(f in d[1] for d in mine) - len(gone), sum(d[1] == {f} for d in mine),
                    sum(d[2] for d in gone), sum(d[3] for d in gone)]
    return sorted((*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items())


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, "x", 7) for i, t, lang in rows],
                                 "doc_id long, text string, lang string, digest string, mask int")


def _labels(spark, rows):
    return spark.createDataFrame([(*r, "en") for r in rows], "doc_id long, quality int, toxic int, lang string")


def _rows(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


def test_edge_rows(spark):
    got = filter_audit.audit_filters(_docs(spark, EDGE), _labels(spark, LABELS))
    assert _rows(got) == brute(EDGE, LABELS)


def test_query_equals_brute_force(spark):
    read = lambda t, *c: [tuple(r) for r in spark.read.parquet(f"{SF}/{t}.parquet").select(*c).collect()]
    assert _rows(queries.op11_filter_audit(spark, SF)) == brute(read("documents", "doc_id", "text", "lang"),
                                                               read("labels", "doc_id", "quality", "toxic"))


def test_empty_tables(spark):
    assert _rows(filter_audit.audit_filters(_docs(spark, []), _labels(spark, LABELS))) == []
    assert _rows(filter_audit.audit_filters(_docs(spark, EDGE), _labels(spark, []))) == brute(EDGE, [])


@pytest.mark.parametrize("n", [1, 2, 3])
def test_many_copies(spark, n):
    rows = [(i * 7 % 31, WORDS, "en" if i % n else "de") for i in range(60)]
    assert _rows(filter_audit.audit_filters(_docs(spark, rows), _labels(spark, [(i, i % 2, int(i % 3 == 0)) for i in range(31)]))) == brute(
        rows, [(i, i % 2, int(i % 3 == 0)) for i in range(31)])
