"""Operator 8 against plain Python for the edited texts, laws of the fingerprint, and brute force for the search."""

import hashlib

import pytest
from pyspark.sql import functions as F

from storelens.llm import queries, simhash

SF = "/root/testdata/sf0.001"
ROWS = [(5, None), (9, ""), (2, "one two three four five six seven eight"), (7, "\U0001F600é" * 9 + " end"), (7, "other text of the id seven"),
        (3, "copy copy"), (3, "copy copy"), (None, "no id at all here"), (11, "w " * 50_000), (12, "a"), (13, "abcd")]


def check(rows, got):
    order = sorted({(-(1 << 63) if i is None else i, t or "") for i, t in rows})
    ties = {k for k, _ in order if sum(a == k for a, _ in order) > 1}
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    for j, (k, t) in enumerate(order):
        follow = order[(j + 1) % len(order)]
        if k in ties or follow[0] in ties:
            continue
        n = len(t) // 4
        want = hashlib.sha256((t[:len(t) - n] + follow[1][:n]).encode()).hexdigest()
        for r in by[None if k == -(1 << 63) else k]:
            assert (r.n_chars, r.edited_sha256) == (len(t), want)
            assert len(r.fingerprint) == 16 and 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    same = {}
    texts = {(i, len(t or "")): t or "" for i, t in rows}
    for r in got:
        if (r.doc_id, r.n_chars) in texts:
            assert same.setdefault(texts[(r.doc_id, r.n_chars)], r.fingerprint) == r.fingerprint


def test_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op8_simhash(spark, SF).collect()
    check(rows, got)
    long = [r for r in got if r.n_chars > 400]
    edited, other = sorted(r.near_edited for r in long), sorted(r.near_next for r in long)
    assert edited[len(edited) // 20] > other[len(other) * 19 // 20] - 0.1 and edited[len(edited) // 2] > 0.68
    assert other[len(other) // 2] < 0.62


def test_edges(spark):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in ROWS], "doc_id long, text string, k int, h string")
    check(ROWS, simhash.digest(simhash.fingerprint_documents(docs)).collect())
    assert simhash.fingerprint_documents(docs.limit(0)).count() == 0
    one = simhash.digest(simhash.fingerprint_documents(docs.where("doc_id = 2"))).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_votes_match_plain_python(spark):
    text = "the quick brown fox jumps over the lazy dog and the quick cat"
    words = text.split()
    pairs = [(w, words[i + 1] if i + 1 < len(words) else None) for i, w in enumerate(words)] * 1500  # many blocks
    rows = spark.createDataFrame(pairs[:len(words)], "a string, b string").select("a", F.xxhash64("a", "b").alias("h")).collect()
    total, value = sum(min(len(r.a), 7) for r in rows), 0
    for b in range(64):
        value |= (2 * sum(min(len(r.a), 7) for r in rows if (r.h >> b) & 1) > total) << b
    signed = value - (1 << 64) if value >> 63 else value
    assert simhash.fingerprints(spark.createDataFrame([(1, text)], "k int, t string"), ["k"], "t").first().fp == signed


def test_long_texts_use_many_blocks(spark):
    """The same terms, repeated far beyond a block, vote the same way."""
    text = "extraordinary circumstances deserve remarkably different explanations everywhere "
    docs = spark.createDataFrame([(1, text * 3), (2, text * 9000)], "k int, t string")
    a, b = (r.fp for r in simhash.fingerprints(docs, ["k"], "t").orderBy("k").collect())
    assert (a ^ b).bit_count() <= 8


@pytest.mark.parametrize("radius,blocks", [(3, 4), (3, 6), (5, 8)])
def test_near_search_equals_brute_force(spark, radius, blocks):
    import random

    rng = random.Random(4)
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = base + [b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(9))) for b in base for _ in range(5)] + base[:5]
    fps = [f & ((1 << 64) - 1) for f in fps]
    df = spark.createDataFrame([(signed(f),) for f in fps] + [(None,)], "fp long")
    got = [(r.query_fp, r.fp) for r in simhash.near_search(df, df, radius, blocks).collect()]
    assert set(got) == {(signed(a), signed(b)) for a in set(fps) for b in set(fps) if (a ^ b).bit_count() <= radius}
    assert len(set(got)) == len(got)


def near(rows):
    """(n_near, ids that may be named) for each (id, fingerprint) whose id divides by 20."""
    for at, (i, fp) in enumerate(rows):
        if i is not None and i % 20 == 0:
            others = [((fp ^ g).bit_count(), j) for k, (j, g) in enumerate(rows) if k != at and (fp ^ g).bit_count() <= 3]
            first = min((d for d, j in others if j is not None), default=None)
            yield i, len(others), {j for d, j in others if d == first and j is not None}


def test_query_gives_near_documents(spark):
    got = queries.op8_simhash(spark, SF).collect()
    want = {i: (n, ids) for i, n, ids in near([(r.doc_id, int(r.fingerprint, 16)) for r in got])}
    assert any(n for n, _ in want.values())
    for r in got:
        n, ids = want.get(r.doc_id, (None, set()))
        assert r.n_near == n and (r.near_id in ids if ids else r.near_id is None)


def test_near_counts_copies_and_null_ids(spark):
    rows = [(20, 0), (21, 0), (None, 1), (40, 3), (40, 3), (60, 0xFF00), (80, 1 << 40), (3, (1 << 40) + 1), (2, (1 << 40) + 6), (100, 7 << 50)]
    got = simhash.with_near(spark.createDataFrame(rows, "doc_id long, fp long")).collect()
    want = {i: (n, ids) for i, n, ids in near(rows)}
    assert len(got) == len(rows)
    for r in got:
        n, ids = want.get(r.doc_id, (None, set()))
        assert r.n_near == n and (r.near_id in ids if ids else r.near_id is None), r
