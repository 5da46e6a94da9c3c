"""Operator 12: rules against plain Python, the model's scores against a plain sum over n-grams, held-out addresses."""

import math
import random
import re

import numpy as np

from storelens.llm import queries, url_filter

SF = "/root/testdata/sf0.001"
EDGE = [
    (1, None), (2, ""), (3, "no address"), (4, "http://example.com"), (5, "http://EXAMPLE.com/en/1"), (6, "https://WWW.example.com/en/"),
    (7, "http://a.www.example.com/en/x?y#z"), (8, "ftp://net/es/"), (9, "http://x.net/es"), (10, "http://xnet/es/1"), (11, "http://b.net/fr/?q"),
    (12, "http://example.com#/en/"), (13, "http://com/"), (14, "://com/"), (15, "a://b://c.com/d"), (16, "http://casino.org/\nen/é"),
    (17, "http://example.com:80/en/"), (18, "http://" + "k" * 100_000 + ".org/" + "p" * 200_000), (4, "http://example.com"), (None, "http://poker.org/"),
    (19, "http:///en/"), (20, "http://example.com?x=/en/"), (21, "http://ÀB.NET/es/"), (22, "http://x.Com/EN/"),
]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url).groups()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def ruled(host, path):
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, None)


def plain_probability(model, host, path):
    z = model.intercept
    for salt, text in ((1, host), (2, path)):
        data = b"\x01" + text.encode() + b"\x02"
        total, n = 0.0, 0
        for size in url_filter.GRAMS:
            for at in range(len(data) - size + 1):
                h = salt * 31 + size
                for byte in data[at:at + size]:
                    h = (h ^ byte) * 0x100000001B3 % 2**64
                    h ^= h >> 29
                total += float(np.float32(model.weights[(h * 0x9E3779B97F4A7C15 % 2**64 >> 48) % url_filter.BUCKETS]))
                n += 1
        z += total / math.sqrt(max(n, 1))
    return 1 / (1 + math.exp(-max(-40, min(40, z))))


def check(rows, got, model):
    assert len(rows) == len(got)
    want = []
    for i, url in rows:
        host, path = split(url)
        rule, verdict = ruled(host, path)
        want.append((i or -1, host, path, rule or "", verdict or "", url))
    have = sorted((r["page_id"] or -1, r["host"], r["path"], r["rule"] or "", r["verdict"], r["p_block"]) for r in got)
    for w, h in zip(sorted(want, key=lambda w: w[:4]), have, strict=True):
        assert w[:4] == h[:4]
        if len(w[1]) < 1000:
            assert abs(plain_probability(model, w[1], w[2]) - h[5]) < 1e-5
        assert h[4] == (w[4] or ("block" if h[5] >= 0.5 else "allow"))


def test_edge_rows(spark):
    model = url_filter.fit_urls(url_filter.seed_urls())
    df = spark.createDataFrame([(i, u, "h", "r", 0.5) for i, u in EDGE], "page_id long, url string, host string, rule string, p_block double")
    check(EDGE, url_filter.judge_urls(df, model).collect(), model)
    assert url_filter.judge_urls(df.limit(0)).count() == 0


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()]
    check(rows, queries.op12_url_filter(spark, SF).collect(), url_filter.fit_urls(url_filter.seed_urls()))


def test_held_out_addresses():
    rows = url_filter.seed_urls()
    random.Random(5).shuffle(rows)
    right = total = 0
    for k in range(5):
        model = url_filter.fit_urls([r for i, r in enumerate(rows) if i % 5 != k])
        held = [r for i, r in enumerate(rows) if i % 5 == k]
        p = model.probability(*map(list, zip(*(split(u) for u, _ in held), strict=True)))
        right += sum((x >= 0.5) == bool(y) for x, (_, y) in zip(p, held, strict=True))
        total += len(held)
    assert right / total >= 0.9


def test_labelled_table_is_a_parameter(spark):
    rows = [(f"http://good{i}.org/a", 0) for i in range(30)] + [(f"http://evil{i}.org/a", 1) for i in range(30)] + [(None, 1), ("http://x.org", None)]
    model = url_filter.fit_urls(url_filter.labelled_urls(spark.createDataFrame(rows, "url string, label int")))
    good, evil = model.probability(["good99.org", "evil99.org"], ["/a", "/a"])
    assert good < 0.3 and evil > 0.7
    assert url_filter.fit_urls(url_filter.labelled_urls(spark.createDataFrame([], "url string, label int"))).probability(["a"], [""])[0] == 0.5
