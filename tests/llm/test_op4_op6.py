"""Operators 4 and 6 against plain Python versions and their own laws."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from storelens.llm import mixing, packing, queries

SF = "/root/testdata/sf0.001"
ROWS = [(1, None, "a"), (2, "", "a"), (3, "word " * 9000, "b"), (4, "same text", None), (4, "same text", None), (None, "no id", "c"),
        (6, "é" * 5000 + "́ é   tab\tx <|endoftext|> don't 12ab", "c"), (7, "  two  spaces\n\nand lines ", "a")]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame([(*r, 5, 6) for r in ROWS], "doc_id long, text string, source string, length long, left int")


def check_pack(rows, got, length):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.default_tokenizer())
    want = Counter()
    for i, t in rows:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        for s in range(0, len(ids), length):
            p = ids[s:s + length]
            want[(i, s, len(p), zlib.crc32(p.tobytes()), len(ids))] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    seqs = defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length))
    for pieces in seqs.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= length
    return len(seqs), sum(n for p in seqs.values() for _, n in p)


def test_pack_equals_tokenizer(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    n, total = check_pack(rows, queries.op6_window_packing(spark, SF).collect(), 4096)
    assert total / (n * 4096) > 0.97


def test_smallest_id_and_clashing_names(spark):
    low = -(1 << 63)
    rows = [(low, "a b c", "s"), (None, "a b c", "s"), (0, "a b c", "t"), (1, None, "t")]
    docs = spark.createDataFrame([(*r, 1, 2, "h", None) for r in rows],
                                 "doc_id long, text string, source string, no_id int, part int, __hash string, __source string")
    check_pack([r[:2] for r in rows], packing.pack(docs, length=64).collect(), 64)
    mixed = mixing.mix(docs)
    assert mixed.columns == [*docs.columns, *mixing.OWN]
    assert {tuple(r)[:7] for r in mixed.collect()} == {tuple(r) for r in docs.collect()}


def test_pack_edges_parts_and_sequences(spark, edge, monkeypatch):
    n, total = check_pack([r[:2] for r in ROWS], packing.pack(edge, length=64).collect(), 64)
    monkeypatch.setattr(packing, "PART", 10)  # many parts, so leftovers are merged across parts
    docs = spark.createDataFrame([(i, "word " * (i % 37), "s") for i in range(400)], "doc_id long, text string, source string")
    pieces = packing.pack(docs, length=64, open_windows=4)
    n, total = check_pack([(i, "word " * (i % 37)) for i in range(400)], pieces.collect(), 64)
    assert total / (n * 64) > 0.9
    padded = packing.sequences(docs, pieces, length=64).collect()
    assert len(padded) == n and all(len(r.ids) == 64 for r in padded) and sum(r.n_tokens for r in padded) == total
    assert packing.pack(edge.limit(0)).count() == 0


def test_encoder_on_odd_texts():
    """The word-by-word ids are the whole text's ids."""
    e = packing.Encoder(packing.default_tokenizer())
    pool = ["a", "B", "Z", "é", "É", "e\u0301", "A\u030a", "ß", "Σ", "İ", "1", "²", "'", "'s", "'S", "don't", "I'LL", " ", "  ", "\n", "\t",
            "\u00a0", "\u2003", ",", ".", "%%%", "!!", "_", "-", "…", "\u0301", "日本", "한", "ﬁ", "\U0001F600", "THE", "<", "<|endoftext|>", "\x1c",
            "\x00", "\ufeff", "\u200d", "क\u093c", "\u0958"]
    rng = random.Random(3)
    for _ in range(1500):
        x = "".join(rng.choice(pool) for _ in range(rng.randrange(14)))
        assert e([x])[0].tolist() == [*e.tokenizer.encode(x, add_special_tokens=False).ids, 2], repr(x)


def test_pack_online_is_bounded():
    lengths = [((i * 7919) % 4096) + 1 for i in range(3000)]
    emitted, left = packing.pack_online(lengths, 4096, 16)
    assert len(left) <= 16 and sorted(i for w in emitted + left for i in w) == list(range(3000))
    assert all(sum(lengths[i] for i in w) <= 4096 for w in emitted + left)


def test_alpha_bisection():
    tokens = {"big": 9000, "mid": 900, "small": 100, "none": 0}
    a = mixing.bisect_alpha(tokens, max_repetition=3.0)
    w = mixing.weights(tokens, a)
    b = mixing.cover_budget(tokens, w)
    assert math.isclose(max(b * w[s] / n for s, n in tokens.items() if n), 3.0, rel_tol=1e-6) and 0 < a < 1
    a = mixing.bisect_alpha(tokens, None, target_entropy=0.8)
    assert math.isclose(mixing.entropy(mixing.weights(tokens, a)), 0.8, rel_tol=1e-6)
    assert mixing.bisect_alpha({}, 2.0) == 0.0 and mixing.bisect_alpha({"a": 5}, 2.0) == 0.0


def brute_quota(rows, **kw):
    tokens = Counter()
    for _, t, s in rows:
        tokens[s or ""] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    w = mixing.weights(tokens, mixing.bisect_alpha(tokens, **{k: v for k, v in kw.items()}))
    return tokens, w


def check_mix(rows, got, budget=None, max_repetition=mixing.MAX_REPETITION):
    tokens, w = brute_quota(rows, max_repetition=max_repetition, budget=budget)
    size = mixing.cover_budget(tokens, w) if budget is None else budget
    longest, taken, copies = Counter(), Counter(), defaultdict(Counter)
    for i, t, s in rows:
        longest[s or ""] = max(longest[s or ""], len(re.findall(r"[^\x20\x09-\x0D]+", t or "")))
    for r in got:
        taken[r.source or ""] += r.mix_tokens
        copies[r.source or ""][r.doc_id] += 1
        assert math.isclose(r.mix_weight, w[r.source or ""]) and 0 <= r.mix_order <= 1
    per_row = Counter((i, s or "") for i, _, s in rows)
    for s, n in tokens.items():
        if n:
            assert -1 <= taken[s] - size * w[s] <= longest[s] + 1
        epochs = int(round(size * w[s]) // n) if n else 1
        for i in {i for i, _, x in rows if (x or "") == s}:
            k = per_row[(i, s)]
            assert epochs * k <= copies[s][i] <= (epochs + 1) * k


def test_mix_keeps_all_and_meets_quotas(spark, edge):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op4_temperature_mix(spark, SF).collect()
    check_mix(rows, got)
    assert {r.doc_id for r in got} == {i for i, *_ in rows}
    mixed = mixing.mix(edge)
    assert mixed.columns[:5] == edge.columns
    check_mix(ROWS, mixed.collect())
    assert mixing.mix(edge.limit(0)).count() == 0
    clash = mixing.mix(edge.withColumnRenamed("left", "mix_tokens"))
    assert sorted(clash.columns) == sorted([*edge.columns[:4], *mixing.OWN]) and clash.count() == mixed.count()


def test_mix_hot_source_and_budget(spark):
    rows = [(i, "w " * (1 + i % 5), "hot" if i % 3 else f"s{i % 7}") for i in range(5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    check_mix(rows, mixing.mix(docs, budget=9000.0, max_repetition=4.0).collect(), 9000.0, 4.0)
    a, b = (sorted((r.doc_id, r.mix_epoch) for r in mixing.mix(docs, seed=s).collect()) for s in (1, 1))
    assert a == b
