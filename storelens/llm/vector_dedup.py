"""Operator 9: near-duplicate vectors by a robust-pruned flat graph.

Vectors that are equal component by component form one class first (a third of all rows may be one vector); the graph holds
one node per class. Cluster centres come from a bounded sample (``SAMPLE`` classes, by a hash), split again and again until
a cluster should hold about ``SHARD`` nodes. Every node joins its ``OVERLAP`` nearest clusters. Spark counts the nodes of each
cluster; one above 2 x ``OVERLAP`` x ``SHARD`` is split again, with centres fitted on a bounded sample of its own, until none is left (one that
no centres can split, such as vectors of one direction, is dealt by a hash, two places a node). Each shard links its nodes to their
nearest ones there and prunes robustly (a neighbour is dropped when a kept one is clearly nearer to it). A node's
lists from all its shards are united. Then every node is a query in each of its shards: greedy search from the shard's medoid and
range expansion over all nodes within the threshold, the query's own node included. Then the expansion crosses shards: a query goes on
to the other shards of the nodes it has reached, is compared there with every node, and so on in rounds until no node within the threshold
lies in a shard it has not seen. A group of near vectors cut over any number of shards is so met as a whole; the visits
grow with the shards that hold links of a query, not with all shards.

A pair that shares a shard is counted in the first one only; any other where its query first meets the node. So counts add up
without listing pairs; a shard emits the links of a spanning forest only, and connected components join the shards. Every link is a cosine in double precision.
``audit`` measures the recall of the counts against brute force for all ids divisible by 20.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.common import components, write_once
from storelens.session import ship_package

THRESHOLD = 0.9
SAMPLE = 16_384
SHARD = 1500
OVERLAP = 2
SPLIT_SAMPLE = 4096
SPLITS = 8  # rounds; what is still too large then is dealt by a hash
NEAREST = 40
DEGREE = 20
ALPHA = 1.2
BEAM = 12
FOUND = "a long, b long, n long, next array<long>"


def valid(v) -> F.Column:
    """Not null, not empty, all components present and finite, not all zero."""
    return F.coalesce((F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
                      & F.exists(v, lambda x: x != 0), F.lit(False))


def centres(sample, population: int, shard: int = SHARD, seed: int = 7):
    """Leaf centres of a repeated split of the (normalised) sample: each leaf stands for about ``shard`` nodes or fewer."""
    import numpy as np

    rng = np.random.default_rng(seed)
    per = population / max(1, len(sample))
    todo, leaves = [sample], []
    while todo:
        x = todo.pop()
        k = min(16, math.ceil(len(x) * per / shard))
        if k < 2 or len(x) < 4 * k:
            leaves.append(x.mean(0))
            continue
        c = x[rng.choice(len(x), k, replace=False)]
        for _ in range(8):
            near = (x @ c.T).argmax(1)
            c = np.stack([x[near == j].mean(0) if (near == j).any() else x[rng.integers(len(x))] for j in range(k)])
            c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        near = (x @ c.T).argmax(1)
        parts = [x[near == j] for j in range(k) if (near == j).any()]
        if max(len(p) for p in parts) > 0.95 * len(x):  # all alike: cut evenly
            parts = np.array_split(x, k)
        todo += parts
    c = np.stack(leaves)
    return c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)


def robust_prune(x, nearest: int = NEAREST, degree: int = DEGREE, alpha: float = ALPHA):
    """Neighbour lists (arrays of positions) of the rows of ``x`` (normalised)."""
    import numpy as np

    m = len(x)
    if m < 2:
        return [np.empty(0, int) for _ in range(m)]
    out = []
    take = min(nearest, m - 1)
    for at in range(0, m, 512):
        rows = np.arange(at, min(at + 512, m))
        s = x[rows] @ x.T
        s[np.arange(len(rows)), rows] = -2
        cand = np.argpartition(-s, take - 1, axis=1)[:, :take]
        sims = np.take_along_axis(s, cand, 1)
        order = np.argsort(-sims, axis=1, kind="stable")
        cand, sims = np.take_along_axis(cand, order, 1), np.take_along_axis(sims, order, 1)
        alive = np.ones_like(cand, bool)
        kept: list[list[int]] = [[] for _ in rows]
        vectors = x[cand]
        for _ in range(degree):
            live = alive.any(1)
            if not live.any():
                break
            pick = alive.argmax(1)
            chosen = cand[np.arange(len(rows)), pick]
            for i in np.flatnonzero(live):
                kept[i].append(int(chosen[i]))
            between = np.einsum("ijd,id->ij", vectors, x[chosen])
            alive &= alpha * np.sqrt(np.maximum(2 - 2 * between, 0)) > np.sqrt(np.maximum(2 - 2 * sims, 0))
            alive[np.arange(len(rows)), pick] = False
        out += [np.array(k, int) for k in kept]
    return out


def range_search(x, lists, q: int, start: int, threshold: float, beam: int = BEAM) -> list[int]:
    """Positions within ``threshold`` of row q reachable in the graph: greedy from ``start``, then expansion."""
    import heapq

    import numpy as np

    v, seen = x[q], {start, q}
    first = float(x[start] @ v)
    frontier, best, inside = [(-first, start)], [first], [q]
    if first >= threshold and start != q:
        inside.append(start)
    while frontier:
        s, node = heapq.heappop(frontier)
        if len(best) >= beam and -s < best[0]:
            break
        new = [j for j in lists[node] if j not in seen]
        if not new:
            continue
        seen.update(new)
        for j, sim in zip(new, (x[new] @ v).tolist(), strict=True):
            if sim >= threshold:
                inside.append(j)
            if len(best) < beam:
                heapq.heappush(best, sim)
            elif sim > best[0]:
                heapq.heapreplace(best, sim)
            else:
                continue
            heapq.heappush(frontier, (-sim, j))
    wave = inside
    while wave:
        near = {j for i in wave for j in lists[i]}
        new = np.fromiter((j for j in near if j not in seen), int)
        seen.update(new.tolist())
        wave = new[x[new] @ v >= threshold].tolist() if len(new) else []
        inside = inside + wave
    return inside


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding",
                 shard: int = SHARD, sample: int = SAMPLE) -> DataFrame:
    """One row per input row: ``vec_id, n_links, component_id, kept``.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do vectors of
    different length; a null id links with nothing (component null, kept). A repeated row is one more vector. An empty table gives
    no rows. Other columns are ignored.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.withColumn("ok", valid(v) & F.col("vec_id").isNotNull())
    rows = rows.withColumns({"h": F.xxhash64("v"), "g": F.xxhash64("v", F.lit(1))})
    classes = write_once(rows.where("ok").groupBy("h", "g").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("members"), F.first("v").alias("v")), "vector-classes")
    shards = _shards(classes, shard, sample)
    found = write_once(_links(shards, threshold), "vector-links")
    found = _across(shards, found, threshold, shard)
    linked = components(found.where("b IS NOT NULL").select("a", "b"), "vectors")
    counts = found.where("b IS NULL").groupBy("a").agg(F.sum("n").alias("n"))
    of = (classes.select("h", "g", "rep", "members").join(counts.withColumnRenamed("a", "rep"), "rep", "left")
          .join(linked.withColumnRenamed("node", "rep"), "rep", "left")
          .select("h", "g", (F.col("members") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
                  F.coalesce("component", "rep").alias("component")))
    good = rows.where("ok").select("vec_id", "h", "g").join(of, ["h", "g"]).select(
        "vec_id", "n_links", F.col("component").alias("component_id"))
    bad = rows.where("NOT ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.unionAll(bad).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _shards(classes: DataFrame, shard: int, sample: int) -> DataFrame:
    """Rows (shard, rep, members, v normalised, shards): every class once for each of its nearest clusters."""
    import numpy as np

    chosen = classes.orderBy(F.xxhash64("rep"), "rep").limit(sample).select("v").collect()
    sizes = {r["d"]: r["n"] for r in classes.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).collect()}
    by_size = {}
    for r in chosen:
        by_size.setdefault(len(r["v"]), []).append(r["v"])
    tables = {}
    for d, n in sorted(sizes.items()):
        x = _unit(np.array(by_size.get(d, []) or [[1.0] * d]))
        c = centres(x, n, shard)
        tables[d] = (c, np.ones(len(c), np.int64))
    tables = _bounded(classes, tables, 2 * OVERLAP * shard, shard)
    starts = _starts(tables)

    def assign(frames):
        import pandas as pd

        for f in frames:
            out = []
            for d, part in f.groupby(f["v"].map(len)):
                x = _unit(np.stack(part["v"].to_numpy()))
                near = _homes(x, part["rep"].to_numpy(), *tables[d], starts[d])
                at = np.repeat(np.arange(len(near)), [len(h) for h in near])
                out.append(pd.DataFrame({"shard": np.concatenate(near), "rep": part["rep"].to_numpy()[at],
                                         "members": part["members"].to_numpy()[at], "v": [x[i] for i in at],
                                         "shards": [near[i] for i in at]}))
            if out:
                yield pd.concat(out)

    return write_once(classes.select("rep", "members", "v").mapInPandas(
        assign, "shard long, rep long, members long, v array<double>, shards array<long>"), "vector-shards")


def _unit(x):
    import numpy as np

    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _mix(rep, salt):
    """Even 64-bit hashes of ids and salts."""
    import numpy as np

    h = rep.astype(np.int64).view(np.uint64) + (np.asarray(salt).astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(by)
    return h ^ (h >> np.uint64(31))


def _starts(tables: dict) -> dict:
    """First shard of each cluster, by vector length: a cluster has as many shards as ``pieces``."""
    import numpy as np

    out, first = {}, 0
    for d, (_, pieces) in sorted(tables.items()):
        out[d] = first + np.cumsum(pieces) - pieces
        first += int(pieces.sum())
    return out


def _homes(x, rep, c, pieces, starts) -> list:
    """The shards of each row of ``x``, ascending: one of each of its nearest clusters, and a second one of the nearest if that is dealt."""
    import numpy as np

    out = []
    step = max(1, 4_000_000 // len(c))
    for at in range(0, len(x), step):
        near = np.argsort(-(x[at:at + step] @ c.T), axis=1, kind="stable")[:, :OVERLAP]
        near = np.concatenate([near, near[:, :1]], axis=1)
        ids = rep[at:at + step, None]
        part = (_mix(ids, near * 2 + (np.arange(near.shape[1]) == near.shape[1] - 1)) % pieces[near].astype(np.uint64)).astype(np.int64)
        out += [np.unique(h) for h in starts[near] + part]
    return out


def _bounded(classes: DataFrame, tables: dict, bound: int, shard: int) -> dict:
    """``tables`` (by vector length: centres, shards per cluster) with every cluster above ``bound`` nodes split or dealt."""
    import numpy as np

    rows = classes.select("rep", "v")
    for round_ in range(SPLITS + 1):
        starts = _starts(tables)

        def count(frames, tables=tables, starts=starts):
            import pandas as pd

            for f in frames:
                for d, part in f.groupby(f["v"].map(len)):
                    homes = _homes(_unit(np.stack(part["v"].to_numpy())), part["rep"].to_numpy(), *tables[d], starts[d])
                    ids, n = np.unique(np.concatenate(homes), return_counts=True)
                    yield pd.DataFrame({"shard": ids, "n": n})

        large = {r["shard"]: r["n"] for r in rows.mapInPandas(count, "shard long, n long").groupBy("shard").agg(
            F.sum("n").alias("n")).where(F.col("n") > bound).collect()}
        if not large:
            return tables

        def chosen(frames, tables=tables, starts=starts, large=large):
            import pandas as pd

            for f in frames:
                out = []
                for d, part in f.groupby(f["v"].map(len)):
                    x, rep = _unit(np.stack(part["v"].to_numpy())), part["rep"].to_numpy()
                    share = _mix(rep, 1 << 40) / 2.0 ** 64
                    for i, homes in enumerate(_homes(x, rep, *tables[d], starts[d])):
                        out += [(h, large[h], x[i]) for h in homes.tolist() if h in large and share[i] * large[h] < SPLIT_SAMPLE]
                yield pd.DataFrame(out, columns=["shard", "n", "v"]).astype({"shard": "int64", "n": "int64"})

        def fit(f):
            import pandas as pd

            x = np.stack(f["v"].to_numpy())
            c = centres(x, int(f["n"].iloc[0]), shard)
            if np.bincount((x @ c.T).argmax(1)).max() > 0.9 * len(x):  # no centres split it
                c = c[:0]
            return pd.DataFrame({"shard": f["shard"].iloc[:1], "c": [list(c)]})

        new = {}
        if round_ < SPLITS:
            new = {r["shard"]: np.array(r["c"]) for r in rows.mapInPandas(chosen, "shard long, n long, v array<double>").groupBy(
                "shard").applyInPandas(fit, "shard long, c array<array<double>>").collect()}
        after = {}
        for d, (c, pieces) in tables.items():
            rows_c, rows_p = [], []
            for i in range(len(c)):
                n = max((large.get(int(starts[d][i]) + k, 0) for k in range(pieces[i])), default=0)
                if n and pieces[i] == 1 and len(new.get(int(starts[d][i]), ())):
                    rows_c += list(new[int(starts[d][i])])
                    rows_p += [1] * (len(rows_c) - len(rows_p))
                else:
                    rows_c.append(c[i])
                    rows_p.append(int(pieces[i]) * (math.ceil(4 * n / bound) if n else 1))
            after[d] = (np.stack(rows_c), np.array(rows_p, np.int64))
        tables = after
    return tables


def _links(shards: DataFrame, threshold: float) -> DataFrame:
    """(a, b, n, next): a link of the spanning forest (n null), or with b null the number of vectors linked with a and
    the shards, other than its own, of the nodes a has reached."""

    def build(f):
        import numpy as np
        import pandas as pd

        f = f.sort_values("rep", ignore_index=True)
        ids = f["rep"].to_numpy()
        lists = robust_prune(np.stack(f["v"].to_numpy()))
        return pd.DataFrame({"rep": ids, "near": [ids[x] for x in lists]})

    # lists of all shards united, with the reverse links
    one_way = shards.groupBy("shard").applyInPandas(build, "rep long, near array<long>").select("rep", F.explode("near").alias("to"))
    both = one_way.unionAll(one_way.select(F.col("to").alias("rep"), F.col("rep").alias("to")))
    graph = both.groupBy("rep").agg(F.collect_set("to").alias("near"))

    def search(f):
        import numpy as np

        f = f.sort_values("rep", ignore_index=True)
        ids, here = f["rep"].to_numpy(), int(f["shard"].iloc[0])
        x, members, homes = np.stack(f["v"].to_numpy()), f["members"].to_numpy(), [set(s) for s in f["shards"]]
        place = {int(i): j for j, i in enumerate(ids)}
        lists = [[place[k] for k in near if k in place] if near is not None else [] for near in f["near"]]
        start = int((x @ x.mean(0)).argmax())
        parent = list(range(len(ids)))

        def root(i):
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        a, b, n, beyonds = [], [], [], []
        for q in range(len(ids)):
            total, beyond = 0, set()
            for j in range_search(x, lists, q, start, threshold):
                if j == q:
                    continue
                beyond |= homes[j]
                if min(homes[q] & homes[j]) == here:
                    total += int(members[j])
                i, k = root(q), root(j)
                if i != k:
                    parent[max(i, k)] = min(i, k)
                    a.append(ids[q])
                    b.append(ids[j])
                    n.append(None)
                    beyonds.append(None)
            beyond -= homes[q]
            if total or beyond:
                a.append(ids[q])
                b.append(None)
                n.append(total)
                beyonds.append(sorted(beyond))
        return _found(a, b, n, beyonds)

    return shards.join(graph, "rep", "left").groupBy("shard").applyInPandas(search, FOUND)


def _found(a, b, n, beyond):
    import pandas as pd

    return pd.DataFrame({"a": pd.array(a, "Int64"), "b": pd.array(b, "Int64"), "n": pd.array(n, "Int64"),
                         "next": pd.Series(beyond, dtype=object)})


def _across(shards: DataFrame, found: DataFrame, threshold: float, shard: int) -> DataFrame:
    """``found`` and the links of every query with the nodes of the shards it goes on to, round by round.

    ``done`` holds the shards a query has seen, ``now`` those of this round. The visitors of a shard are dealt to as many
    tasks as keep each to about ``shard`` of them.
    """
    nodes = shards.select("shard", "rep", "members", "v", "shards")
    vectors = shards.where(F.col("shard") == F.get("shards", F.lit(0))).select("rep", "v", F.col("shards").alias("done"))
    every, round_, last = found, 0, found

    def go_on(last):
        return last.where("size(next) > 0").select(F.col("a").alias("rep"), F.explode("next").alias("s")).groupBy("rep").agg(
            F.collect_set("s").alias("s"))

    state = vectors.join(go_on(last), "rep").select("rep", "v", "done", F.array_sort(F.array_except("s", "done")).alias("now"))
    while True:
        state = write_once(state.where("size(now) > 0"), f"vector-visits-{round_}")
        if state.isEmpty():
            return every
        visits = state.withColumn("shard", F.explode("now"))
        tasks = visits.groupBy("shard").agg(F.ceil(F.count("*") / F.lit(shard)).cast("long").alias("tasks"))
        left = visits.join(tasks, "shard").select(
            "shard", F.pmod(F.xxhash64("rep", "shard"), F.col("tasks")).alias("task"), "rep", "v", "done", "now",
            F.lit(None).cast("long").alias("members"), F.lit(None).cast("array<long>").alias("shards"))
        right = nodes.join(tasks, "shard").select(
            "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tasks") - 1)).alias("task"), "rep", "v",
            F.lit(None).cast("array<long>").alias("done"), F.lit(None).cast("array<long>").alias("now"), "members", "shards")

        def visit(f):
            import numpy as np

            asked, there = f[f["shards"].isna()], f[f["shards"].notna()]
            if asked.empty:
                return _found([], [], [], [])
            asked, there = (t.sort_values("rep", ignore_index=True) for t in (asked, there))
            x, y, here = np.stack(asked["v"].to_numpy()), np.stack(there["v"].to_numpy()), int(f["shard"].iloc[0])
            q, ids, members = asked["rep"].to_numpy(), there["rep"].to_numpy(), there["members"].to_numpy().astype(np.int64)
            homes = list(there["shards"])
            a, b, n, beyond = [], [], [], []
            label, roots = np.arange(len(y)), []
            for i in range(len(x)):
                near = np.flatnonzero(y @ x[i] >= threshold)
                done, now = set(asked["done"][i]), set(asked["now"][i])
                total, more = 0, set()
                for j in near.tolist():
                    if done.isdisjoint(homes[j]):
                        more.update(homes[j])
                        if min(now.intersection(homes[j])) == here:
                            total += int(members[j])
                if len(near):
                    a.append(q[i])
                    b.append(None)
                    n.append(total)
                    beyond.append(sorted(more - now))
                    old = np.unique(label[near])
                    roots.append(old[0])
                    if len(old) > 1:
                        label[np.isin(label, old)] = old[0]
            roots_of = iter(roots)
            for i in list(a):
                a.append(i)
                b.append(ids[next(roots_of)])
            for j in np.flatnonzero(label != np.arange(len(y))):
                a.append(ids[j])
                b.append(ids[label[j]])
            n += [None] * (len(a) - len(n))
            beyond += [None] * (len(a) - len(beyond))
            return _found(a, b, n, beyond)

        last = write_once(left.unionAll(right).groupBy("shard", "task").applyInPandas(visit, FOUND), f"vector-links-{round_}")
        every = every.unionAll(last)
        seen = state.select("rep", "v", F.array_union("done", "now").alias("done"))
        state = seen.join(go_on(last), "rep").select("rep", "v", "done", F.array_sort(F.array_except("s", "done")).alias("now"))
        round_ += 1


def audit(vectors: DataFrame, result: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id",
          vector_col: str = "embedding", block: int = 2048) -> tuple[int, int]:
    """(links found, links there) over all vectors whose id divides by 20, against all rows by brute force.

    The queries go in blocks of ``block``; each block is one pass over the rows, which returns a count per query.
    """
    import numpy as np

    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).where(
        valid(F.col("v")) & F.col("vec_id").isNotNull())
    asked = rows.where("vec_id % 20 = 0")
    n = asked.count()
    blocks = max(1, -(-n // block))
    there = 0
    for i in range(blocks):
        part = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == i).collect()
        by_size = {}
        for r in part:
            by_size.setdefault(len(r["v"]), []).append(r["v"])
        sides = {d: np.array(v) / np.linalg.norm(np.array(v), axis=1, keepdims=True) for d, v in by_size.items()}

        def count(frames, sides=sides):
            import pandas as pd

            for f in frames:
                total = 0
                for v in f["v"]:
                    q = sides.get(len(v))
                    if q is not None:
                        total += int((q @ (v / np.linalg.norm(v)) >= threshold).sum())
                yield pd.DataFrame({"n": [total]})

        there += (rows.select("v").mapInPandas(count, "n long").agg(F.sum("n")).first()[0] or 0) - len(part)
    found = result.where("vec_id % 20 = 0").agg(F.sum("n_links")).first()[0] or 0
    return found, there
