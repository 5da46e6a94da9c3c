"""Operator 9 against brute force: exact verification, recall, components, and edge vectors."""

import numpy as np
import pytest

from storelens.llm import queries, vector_dedup

SF = "/root/testdata/sf0.01"


def brute(rows, t=0.9):
    ok = [(i, np.array(v, float)) for i, v in rows
          if i is not None and v is not None and len(v) and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)]
    links = [set() for _ in ok]
    for a in range(len(ok)):
        for b in range(a):
            x, y = ok[a][1], ok[b][1]
            if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= t:
                links[a].add(b)
                links[b].add(a)
    comp = {}
    for s in sorted(range(len(ok)), key=lambda k: ok[k][0]):
        todo = [s]
        while todo:
            k = todo.pop()
            if k not in comp:
                comp[k] = ok[s][0]
                todo += links[k]
    return [(ok[k][0], len(links[k]), comp[k]) for k in range(len(ok))]


def test_small_table_is_exact(spark):
    t = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = queries.op9_vector_graph(spark, SF).collect()
    want = brute([(r.vec_id, r.embedding) for r in t.collect()])
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == sorted(want)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_many_shards_recall(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 16))
    rows = [(int(i), (base[i % 60] + rng.normal(size=16) * (0.12 if i % 2 else 0.4)).tolist()) for i in range(2400)]
    rows += [(2400 + i, rows[7][1]) for i in range(900)]  # a hot vector
    t = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = vector_dedup.near_vectors(t, shard=120)
    got.cache()
    found, there = vector_dedup.audit(t, got)
    want = {i: (n, c) for i, n, c in brute(rows)}
    assert there == sum(n for i, (n, _) in want.items() if i % 20 == 0)
    assert there * 0.95 <= found <= there
    assert all(r.n_links <= want[r.vec_id][0] for r in got.collect())
    assert np.mean([r.component_id == want[r.vec_id][1] for r in got.collect()]) > 0.98


def test_cloud_over_many_shards(spark):
    """A third of the rows are distinct vectors near one point, several times a shard: every link between them counts."""
    rng = np.random.default_rng(5)
    point, base = rng.normal(size=24), rng.normal(size=(40, 24))
    rows = [(i, (point + rng.normal(size=24) * 0.25).tolist()) for i in range(700)]
    rows += [(700 + i, (base[i % 40] + rng.normal(size=24) * 0.2).tolist()) for i in range(1400)]
    t = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = vector_dedup.near_vectors(t, shard=70).collect()
    want = {i: (n, c) for i, n, c in brute(rows)}
    assert sum(n for i, (n, _) in want.items() if i < 700) > 100 * 700
    assert all(r.n_links <= want[r.vec_id][0] for r in got)
    assert sum(r.n_links for r in got) >= 0.995 * sum(n for n, _ in want.values())
    assert np.mean([r.component_id == want[r.vec_id][1] for r in got]) > 0.99


def test_shards_are_bounded(spark):
    """A sample too small to shape the clusters, and many vectors of one direction: no shard is above the bound, links are kept."""
    rng = np.random.default_rng(6)
    base = rng.normal(size=(50, 12))
    rows = [(i, (base[i % 50] + rng.normal(size=12) * 0.15).tolist()) for i in range(1500)]
    rows += [(1500 + i, (base[7] * (1 + i / 1000)).tolist()) for i in range(500)]
    t = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    classes = t.selectExpr("vec_id AS rep", "1L AS members", "embedding AS v")
    placed = vector_dedup._shards(classes, 25, 16).collect()
    sizes = {}
    for r in placed:
        sizes[r.shard] = sizes.get(r.shard, 0) + 1
        assert r.shard in r.shards and list(r.shards) == sorted(set(r.shards))
    assert max(sizes.values()) <= 2 * vector_dedup.OVERLAP * 25, sorted(sizes.values())[-5:]
    assert {r.rep for r in placed} == set(range(2000)) and len(placed) <= 3 * 2000
    got = vector_dedup.near_vectors(t, shard=25, sample=16).collect()
    want = {i: (n, c) for i, n, c in brute(rows)}
    assert all(r.n_links <= want[r.vec_id][0] for r in got)
    assert sum(r.n_links for r in got) >= 0.99 * sum(n for n, _ in want.values())


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]),
            (9, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (10, [1e300, 1e299]), (11, [0.0, -1.0]), (1, [1.0, 0.0]), (12, [1e-300, 0.0])]
    t = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, n_links int, v int")
    got = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in vector_dedup.near_vectors(t).collect())
    alone = [(0, 0, None, True)] + [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 11)]
    want = alone + [(1, 4, 1, True)] * 2 + [(i, 4, 1, False) for i in (2, 10, 12)]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert vector_dedup.near_vectors(t.limit(0)).count() == 0


@pytest.mark.parametrize("m", [1, 2, 50])
def test_prune_and_search(m):
    x = np.random.default_rng(m).normal(size=(m, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    lists = vector_dedup.robust_prune(x)
    assert len(lists) == m and all(len(set(k)) == len(k) <= vector_dedup.DEGREE and i not in k for i, k in enumerate(lists))
    for q in range(m):
        found = vector_dedup.range_search(x, [list(k) for k in lists], q, 0, 0.3)
        assert q in found and all(x[j] @ x[q] >= 0.3 for j in found)
