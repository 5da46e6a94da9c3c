"""Operator 13: the pointer sort against Python's sort, the query against plain integer arithmetic, edge rows."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from storelens.llm import divergence, queries

SF = "/root/testdata/sf0.001"
EDGE = [
    ("the the cat", "en", "a"), ("The CAT sat", "en", "b"), ("the cat SAT", "en", "b"), ("", "en", "c"), (None, None, None), ("cat cat", None, "a"),
    ("été été ÉTÉ 日本x9日本", "fr", "a"), ("été\x00日本 a1b", "fr", "a"), ("été 日本", "fr", "d"), ("solo", "xx", "s"), ("abcdefgh abcdefghi abcdefgh", "en", "a"),
    ("abcdefgh abcdefghi", "en", "b"), ("abcdefgh-abcdefghi", "en", "c"), ("w" * 200_000 + " the", "en", "a"), ("the " * 50_000, "en", "c"),
    ("the cat", "en", ""), ("the cat", "en", ""),
]


def brute(rows):
    groups, total, df, count = defaultdict(set), Counter(), Counter(), Counter()
    for t, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        for w, n in Counter(words).items():
            total[lang, w] += n
            df[lang, w] += 1
            count[lang, source, w] += n
    out = set()
    ranked = lambda found: [(v, i, r + 1) for r, (v, i) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode())))]
    for lang, sources in groups.items():
        kept = [w for (la, w), n in df.items() if la == lang and n >= 3]
        v, n_lang = len(kept), sum(total[lang, w] for w in kept)
        p = {}
        for s in sources:
            n = sum(count[lang, s, w] for w in kept)
            p[s] = {w: 1 + 10**9 * (count[lang, s, w] + 1) // (n + v) for w in kept}
        q = {w: 1 + 10**9 * (total[lang, w] + 1) // (n_lang + v) for w in kept}
        f = lambda a, b: (a - b) * (a - b) // b
        for s in sources:
            pairs = ranked([(sum(f(p[s][w], p[o][w]) for w in kept), o) for o in sources if o != s])
            terms = ranked([(f(p[s][w], q[w]), w) for w in kept if count[lang, s, w] and p[s][w] > q[w]])[:200]
            out |= {(lang, s, part, i, x, r) for part, rows_ in (("pair", pairs), ("term", terms)) for x, i, r in rows_}
    return out


def _rows(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def _docs(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], "text string, lang string, source string, term string, n int, value int, p long")


def test_edge_rows(spark):
    assert _rows(divergence.audit_sources(_docs(spark, EDGE))) == brute(EDGE)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("text", "lang", "source").collect()]
    assert _rows(queries.op13_source_divergence(spark, SF)) == brute(rows)


def test_many_sources_slices_and_shares(spark, monkeypatch):
    rows = [(" ".join(f"t{chr(97 + (i * k) % 17)}{chr(97 + k % 7)}" for k in range(1 + i % 30)), "en", f"s{i % 37}") for i in range(300)]
    monkeypatch.setattr(divergence, "SOURCES", 5)
    monkeypatch.setattr(divergence, "TERMS", 20)
    monkeypatch.setattr(divergence, "CELLS", 64)
    assert _rows(divergence.audit_sources(_docs(spark, rows), top=200)) == brute(rows)


def test_empty_table(spark):
    assert _rows(divergence.audit_sources(_docs(spark, []))) == set()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abÀ日 -", max_size=40), max_size=12), st.sampled_from([2, 8, 1 << 16]))
def test_pointer_sort(texts, direct):
    old, divergence.DIRECT = divergence.DIRECT, direct
    try:
        data = ("\x00" + "\x00".join(texts)).encode() + b"\x00" * 16
        flat = divergence._lower()[np.frombuffer(data, "u1")]
        letters = flat != 0
        pointers = np.flatnonzero(letters[1:] & ~letters[:-1]) + 1
        order, begins = divergence.sort_pointers(flat, pointers)
    finally:
        divergence.DIRECT = old
    word = lambda at: bytes(flat[at:]).split(b"\x00")[0]
    want = sorted(pointers.tolist(), key=lambda at: (word(at), at))
    assert order.tolist() == want
    assert begins.tolist() == [i == 0 or word(want[i]) != word(want[i - 1]) for i in range(len(want))]


@pytest.mark.parametrize("limit", [1, 500, 1 << 30])
def test_slices_add_up(spark, limit):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole = {tuple(r) for r in divergence.term_counts(docs).collect()}
    assert {tuple(r) for r in divergence.term_counts(docs, slice_bytes=limit).collect()} == whole
