"""Operator 10: personal data by weak supervision.

Candidate spans come from four fixed patterns (the base spans: always kept when they pass their checks) and
from wider patterns (obfuscated e-mail, national telephone numbers, long ip form). Six labelers vote on every
candidate: the strict pattern, the wide pattern, a gazetteer (known domains endings, dialling codes, card
issuers, address ranges), words in the context before it, words that speak against it, and the checksum. The votes of all
documents are counted by (kind, vote pattern): at most 4 * 3^6 rows, combined map-side. Expectation
maximisation on these counts estimates each labeler's reliability per kind; its posteriors train a logistic
span classifier on the votes. A wide span is added when the classifier gives it ``threshold`` or more and it
does not overlap a base span.

All work on the executors is SQL expressions in one projection per document (regular expressions, higher-order
functions), so it neither shuffles texts nor runs Python. Positions come from splitting at the pattern and
adding lengths, in code points.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.llm.common import write_once

KINDS = ("email", "ip", "card", "phone")

# The base patterns. Written so that the engine needs no backtracking over long runs: a match
# may only start where its first run starts (or where the last match ended), and closing repeats are possessive.
EMAIL = (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++")
IP = r"(?:(?<![0-9])|\G)[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}

WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?(?:\[at\]|\(at\))\x20?[A-Za-z0-9-]{1,63}"
             r"(?:\x20?(?:\.|\[dot\]|\(dot\))\x20?[A-Za-z0-9-]{1,63}){1,6}",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "phone": r"(?<![0-9+().-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])",
}
GAZETTEER = {
    "email": r"(?i)(?:\.|dot[\])]\x20?)(?:com|org|net|edu|gov|io|info|biz|de|fr|es|uk|eu|us|ch|at|it|nl)$",
    "ip": r"^(?:10|127|172|192|[1-9][0-9]?|1[0-9][0-9]|2[01][0-9]|22[0-3])[.]|^(?:2[0-9A-Fa-f]{3}|f[cde][0-9A-Fa-f]{2}):",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)",
    "phone": r"^(?:\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])|\(?[2-9][0-9]{2})",
}
CONTEXT = {
    "email": r"(?i)(?:e-?mail|contact|write|reach|address|kontakt|correo|courriel)",
    "ip": r"(?i)(?:\bip\b|host|server|address|login|client|peer|network)",
    "card": r"(?i)(?:card|visa|master|amex|credit|payment|karte|carte|tarjeta)",
    "phone": r"(?i)(?:tel|phone|call|fax|mobile|cell|dial|anruf|appel|llam)",
}
AGAINST = {
    "email": r"(?i)(?:git|ssh|package|npm)\S*\s*$",
    "ip": r"(?i)(?:version|release|section|chapter|\bv|§)\.?\s*$",
    "card": r"(?i)(?:isbn|order|serial|sku|part|no\.|id)\W*$",
    "phone": r"(?i)(?:isbn|order|serial|sku|part|version)\W*$",
}
VOTES = ("strict", "wide", "gazetteer", "context", "against", "checksum")
THRESHOLD = 0.5
BLOCK = 64  # matches scanned together
REACH = 40  # code points of context before a span that the context labelers see


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Checksum of a digit string: from the right, every second digit doubled (9 taken off above 9)."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda x, i: F.when(
        i % 2 == 1, F.element_at(F.array(*[F.lit(v) for v in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]),
                                 F.coalesce(x.cast("int"), F.lit(0)) + 1)).otherwise(F.coalesce(x.cast("int"), F.lit(0))))
    return F.aggregate(values, F.lit(0), lambda a, v: a + v) % 10 == 0


def _passes(kind: str, m: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: F.length(F.ltrim(p, F.lit("0"))) <= 3) & F.forall(
            F.split(m, r"\."), lambda p: F.coalesce(F.substring(F.ltrim(p, F.lit("0")), 1, 4).try_cast("int"),
                                                    F.lit(0)) <= 255)
    if kind == "card":
        d = _digits(m)
        return F.when(F.length(d).between(12, 19), _luhn(d)).otherwise(F.lit(False))
    return F.length(_digits(m)).between(9, 15)


def _found(text: Column, pattern: str, gate: Column) -> Column:
    """array<struct<start, m, before>>: leftmost non-overlapping matches, start in code points, and up to ``REACH`` code points
    before each. Positions are running sums over the pieces between matches, in blocks of ``BLOCK``, so the time grows with
    the matches and the text, not with their product."""
    empty = F.array().cast("array<struct<start:int,m:string,before:string>>")
    pieces = F.arrays_zip(F.split(text, pattern, -1).alias("p"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))

    def in_blocks(pairs: Column) -> Column:
        last = F.floor((F.size(pairs) - 1) / BLOCK).cast("int")
        block = lambda j: F.slice(pairs, j * BLOCK + 1, F.lit(BLOCK))
        whole = lambda x: F.concat(x["p"], F.coalesce(x["m"], F.lit("")))
        ends = F.transform(F.sequence(F.lit(0), last), lambda j: F.struct(
            F.aggregate(block(j), F.lit(0), lambda n, x: n + F.length(x["p"]) + F.coalesce(F.length(x["m"]), F.lit(0))).alias("size"),
            F.aggregate(block(j), F.lit(""), lambda a, x: F.right(F.concat(a, whole(x)), F.lit(REACH))).alias("tail")))
        begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("tail"), F.array().cast("array<struct<at:int,tail:string>>").alias("all"))
        begins = F.aggregate(ends, begin, lambda a, e: F.struct(
            (a["at"] + e["size"]).alias("at"), e["tail"].alias("tail"),
            F.concat(a["all"], F.array(F.struct(a["at"].alias("at"), a["tail"].alias("tail")))).alias("all")), lambda a: a["all"])

        def scan(b: Column, j: Column) -> Column:
            zero = F.struct(b["at"].alias("at"), b["tail"].alias("tail"), empty.alias("out"))
            return F.aggregate(block(j), zero, lambda a, x: F.struct(
                (a["at"] + F.length(x["p"]) + F.coalesce(F.length(x["m"]), F.lit(0))).alias("at"),
                F.right(F.concat(a["tail"], whole(x)), F.lit(REACH)).alias("tail"),
                F.when(x["m"].isNull(), a["out"]).otherwise(F.concat(a["out"], F.array(F.struct(
                    (a["at"] + F.length(x["p"])).alias("start"), x["m"].alias("m"),
                    F.right(F.concat(a["tail"], x["p"]), F.lit(REACH)).alias("before"))))).alias("out")), lambda a: a["out"])
        return F.flatten(F.transform(begins, scan))

    # the pieces are bound to a name: they are made once
    return F.when(gate & text.rlike(pattern), F.transform(F.array(pieces), in_blocks)[0]).otherwise(empty)


def _vote(yes: Column, no: Column | None = None) -> Column:
    return F.when(yes, F.lit(1)).when(no if no is not None else F.lit(False), F.lit(-1)).otherwise(F.lit(0))


def _voter(kind: str, rank: int, strict: bool):
    """The votes of all labelers on one found match."""
    def vote(x):
        m, start, before = x["m"], x["start"], x["before"]
        passed = _passes(kind, m) if strict or kind == "phone" else F.lit(True)
        return F.struct(
            start.alias("start"), (start + F.length(m)).alias("end"), F.lit(rank).alias("rank"),
            F.lit(kind).alias("kind"), (passed if strict else F.lit(False)).alias("base"),
            F.lit(not strict).alias("eligible"),
            F.array(_vote(passed if strict else F.lit(False), ~passed if strict else None),
                    _vote(F.lit(not strict)),
                    _vote(m.rlike(GAZETTEER[kind]), ~m.rlike(GAZETTEER[kind])),
                    _vote(before.rlike(CONTEXT[kind])),
                    _vote(F.lit(False), before.rlike(AGAINST[kind])),
                    _vote(passed, ~passed)).alias("votes"))

    return vote


def candidates(text: Column) -> Column:
    """array<struct<start, end, rank, kind, base, eligible, votes array<int>>>, unsorted."""
    text = F.coalesce(text, F.lit(""))
    digit = text.rlike("[0-9]")
    gates = {"email": F.contains(text, F.lit("@")), "ip": digit, "card": digit, "phone": F.contains(text, F.lit("+"))}
    wide_gates = {"email": F.lower(text).rlike(r"[\[(]at[\])]"), "ip": F.contains(text, F.lit(":")) & digit, "phone": digit}
    parts = []
    for rank, kind in enumerate(KINDS):
        for form in ("strict", "wide"):
            pattern = (BASE if form == "strict" else WIDE).get(kind)
            if not pattern:
                continue
            strict = form == "strict"
            found = _found(text, pattern, (gates if strict else wide_gates)[kind])

            parts.append(F.transform(found, _voter(kind, rank, strict)))
    return F.concat(*parts)


def fit(votes: DataFrame, rounds: int = 50) -> dict[str, list[float]]:
    """``votes``: rows (kind, votes). Gives per kind the classifier's bias and one weight per labeler.

    The counts per vote pattern are bounded (at most 4 * 3^6 rows); EM and the logistic fit on the driver
    see only those.
    """
    counts: dict[str, list[tuple[tuple[int, ...], int]]] = {k: [] for k in KINDS}
    for r in votes.groupBy("kind", "votes").agg(F.count("*").alias("n")).collect():
        counts[r["kind"]].append((tuple(r["votes"]), r["n"]))
    return {k: _train(_em(sorted(counts[k]), rounds)) for k in KINDS}


def _em(patterns: list[tuple[tuple[int, ...], int]], rounds: int) -> list[tuple[tuple[int, ...], float, float]]:
    """(votes, count, posterior): two hidden classes, independent labelers, add-one smoothing; starts from the
    majority of the votes so that the first class is the personal one."""
    post = {v: 1 / (1 + math.exp(-sum(v))) for v, _ in patterns}
    for _ in range(rounds):
        mass = [1.0, 1.0]
        like = [[{-1: 1.0, 0: 1.0, 1: 1.0} for _ in VOTES] for _ in range(2)]
        for v, n in patterns:
            for c, p in enumerate((1 - post[v], post[v])):
                mass[c] += n * p
                for j, x in enumerate(v):
                    like[c][j][x] += n * p
        for v, _ in patterns:
            score = [math.log(mass[c]) + sum(math.log(like[c][j][x] / sum(like[c][j].values()))
                                             for j, x in enumerate(v)) for c in range(2)]
            post[v] = 1 / (1 + math.exp(max(-50.0, min(50.0, score[0] - score[1]))))
    return [(v, n, post[v]) for v, n in patterns]


def _train(soft: list[tuple[tuple[int, ...], float, float]], steps: int = 300) -> list[float]:
    """Logistic weights [bias, one per labeler] on the soft labels. A prior of one row per labeler's own vote
    keeps unseen labelers at their plain meaning."""
    k = len(VOTES)
    rows = [((1.0, *map(float, v)), math.log1p(n), p) for v, n, p in soft]
    rows += [((1.0, *(float(s * (i == j)) for i in range(k))), 1.0, 0.5 + 0.4 * s) for j in range(k) for s in (-1, 1)]
    w = [0.0] * (k + 1)
    total = sum(n for _, n, _ in rows)
    for _ in range(steps):
        g = [0.02 * x for x in w]
        for x, n, p in rows:
            q = 1 / (1 + math.exp(-max(-50.0, min(50.0, sum(a * b for a, b in zip(w, x, strict=True))))))
            for i, b in enumerate(x):
                g[i] += n / total * (q - p) * b
        w = [a - 2.0 * b for a, b in zip(w, g, strict=True)]
    return w


def classify(found: Column, model: dict[str, list[float]], threshold: float = THRESHOLD) -> Column:
    """Kept spans of one document, array<struct<start, rank, end, kind, base, p>> by start, then kind."""
    def scored(x):
        z = None
        for k in KINDS:
            w = model[k]
            s = F.lit(w[0])
            for j, b in enumerate(w[1:]):
                s = s + F.lit(b) * x["votes"][j]
            z = F.when(x["kind"] == k, s) if z is None else z.when(x["kind"] == k, s)
        return F.struct(x["start"].alias("start"), x["rank"].alias("rank"), x["end"].alias("end"),
                        x["kind"].alias("kind"), x["base"].alias("base"), (1 / (1 + F.exp(-z))).alias("p"))

    base = F.transform(F.filter(found, lambda x: x["base"]), scored)
    more = F.filter(F.transform(F.filter(found, lambda x: x["eligible"]), scored), lambda x: x["p"] >= threshold)
    more = F.when(F.size(more) == 0, more).otherwise(F.filter(more, lambda x: ~F.exists(
        base, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))))
    return F.sort_array(F.concat(base, more))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: ``doc_id, found`` with the kept spans (start, rank, end, kind, base, p).

    Null and empty texts have no spans; an empty table gives no rows (the classifier then keeps its prior);
    null ids are kept. Repeated rows are found each, and their votes count each. Spans that begin together go by kind as listed,
    then by end. Texts of any length are taken whole, in time that grows with text and matches (only added spans are held
    against the base ones pair by pair). Other columns are ignored.
    """
    found = write_once(docs.select(F.col(id_col).alias("doc_id"), candidates(F.col(text_col)).alias("found")), "pii")
    model = fit(found.select(F.explode("found").alias("c")).select("c.kind", "c.votes"))
    return found.select("doc_id", classify(F.col("found"), model, threshold).alias("found"))


def _is(kind: str):
    return lambda s: F.when(s["kind"] == kind, F.lit(1))


def digest(spans: DataFrame) -> DataFrame:
    """The contract's columns from ``find_pii``'s spans."""
    base = F.filter("found", lambda s: s["base"])
    return spans.select(
        "doc_id", *[F.size(F.array_compact(F.transform(base, _is(k)))).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"),
        F.coalesce(F.array_max(F.transform("found", lambda s: s["p"])), F.lit(0.0)).alias("max_probability"))


def _fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _rewritten(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by its kind, in blocks of ``BLOCK`` spans: each block cuts its own stretch first."""
    merged = F.aggregate(spans, F.lit(-1), lambda a, s: F.greatest(a, s["end"]))  # where the last one ends

    def piece(part: Column, begin: Column, end: Column) -> Column:
        stretch = F.transform(F.array(F.substring(text, begin + 1, end - begin)), lambda x: F.aggregate(
            part, F.struct(begin.alias("at"), F.lit("").alias("out")), lambda a, s: F.when(s["start"] < a["at"], F.struct(
                F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out"))).otherwise(F.struct(
                    s["end"].alias("at"), F.concat(a["out"], F.substring(x, a["at"] - begin + 1, s["start"] - a["at"]), F.lit("<"),
                                                   s["kind"], F.lit(">")).alias("out"))), lambda a: a["out"]))
        return stretch[0]

    def blocks(all_: Column) -> Column:
        last = F.floor((F.size(all_) - 1) / BLOCK).cast("int")
        part = lambda j: F.slice(all_, j * BLOCK + 1, F.lit(BLOCK))
        reach = F.transform(F.sequence(F.lit(0), last), lambda j: F.aggregate(part(j), F.lit(0), lambda a, s: F.greatest(a, s["end"])))

        def joined(ends: Column) -> Column:
            begin = lambda j: F.when(j == 0, F.lit(0)).otherwise(F.array_max(F.slice(ends, 1, j)))
            return F.array_join(F.transform(ends, lambda end, j: piece(part(j), begin(j), F.greatest(begin(j), end))), "")
        return F.transform(F.array(reach), joined)[0]

    return F.concat(F.transform(F.array(spans), blocks)[0], F.substring(text, merged + 1, F.length(text)))


def redact(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The same rows and columns with every kept span replaced by its kind in angle brackets.

    Overlapping spans are replaced as one, under the first one's kind. Null and empty texts stay, repeated rows are rewritten
    each, an empty table gives no rows, columns of any name pass through. Spans are found once: the rows are written with their
    candidates, whose votes are counted over all rows, and rewritten from there, without a shuffle.
    """
    name = _fresh(docs, "pii_candidates")
    staged = write_once(docs.withColumn(name, candidates(F.col(text_col))), "pii-rows")
    model = fit(staged.select(F.explode(name).alias("c")).select("c.kind", "c.votes"))
    spans = F.transform(F.array(classify(F.col(name), model, threshold)), lambda s: F.when(F.size(s) > 0, _rewritten(F.col(text_col), s)))[0]
    return staged.withColumn(text_col, F.coalesce(spans, F.col(text_col))).select(*[F.col(f"`{c}`") for c in docs.columns])
