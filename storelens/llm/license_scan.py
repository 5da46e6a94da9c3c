"""Operator 1: licence scan by ordered signature rules.

A rule is a phrase expression over words, keywords of which a text must hold one for the rule to be tried, a label
and a priority. Rules come from families (written by hand below) times phrase forms, from "or later" and exception
clauses, and from sentences of licence texts. The keywords of a rule are derived from all texts that its expression
stands for (``gate``), so the prefilter can never hide a match. Detections that lie inside another one of the same or a higher priority are
suppressed, so "under the MIT License" inside "released under the MIT License" counts once.

One projection per document, SQL expressions only: runs of separators become blanks once; only texts that hold some
keyword (one alternation) number their words ("17:mit 18:license"), so a match brings its word position with
it; a rule's expression runs only where its keyword stands. No shuffle, no Python on the executors.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.llm.common import lower_ascii

# The base phrases.
# Fixed value: what stands between words. Words are [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z, so
# before it the capitals belong to words too.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BASE_PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

_LIC = "(?:license|licence)"
_V = "VER "  # before a number: "version 2", "v 2", "v2" or "2"

#: (label, keyword, the name in words). Alternatives in brackets; every run of letters or digits is a whole word.
FAMILIES = (
    ("mit", "mit", f"(?:mit|mit x11|expat) {_LIC}"),
    ("mit-0", "mit", f"(?:mit no attribution|mit 0)(?: {_LIC})?"),
    ("x11", "x11", f"x11 {_LIC}"),
    ("apache-1.1", "apache", f"apache (?:software )?{_LIC} {_V}1 1"),
    ("apache-2", "apache", f"apache (?:software )?(?:{_LIC} )?{_V}2(?: 0)?"),
    ("bsd-2", "bsd", f"(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)(?: {_LIC})?"),
    ("bsd-3", "bsd", f"(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)(?: {_LIC})?"),
    ("bsd-4", "bsd", f"(?:bsd 4 clause|4 clause bsd|original bsd)(?: {_LIC})?"),
    ("0bsd", "bsd", f"(?:zero clause bsd|bsd zero clause|0 clause bsd)(?: {_LIC})?"),
    ("bsd", "bsd", f"(?:bsd|bsd style) {_LIC}"),
    ("gpl-1", "general public", f"(?:gnu )?general public {_LIC} {_V}1(?: 0)?"),
    ("gpl-2", "general public", f"(?:gnu )?general public {_LIC} {_V}2(?: 0)?"),
    ("gpl-3", "general public", f"(?:gnu )?general public {_LIC} {_V}3(?: 0)?"),
    ("gpl-2", "gpl", f"(?:gnu )?(?:gpl(?: {_LIC})? {_V}2|gplv2)(?: 0)?"),
    ("gpl-3", "gpl", f"(?:gnu )?(?:gpl(?: {_LIC})? {_V}3|gplv3)(?: 0)?"),
    ("lgpl-2", "lesser", f"(?:gnu )?(?:lesser|library) general public {_LIC} {_V}2(?: 0)?"),
    ("lgpl-2.1", "lesser", f"(?:gnu )?lesser general public {_LIC} {_V}2 1"),
    ("lgpl-3", "lesser", f"(?:gnu )?lesser general public {_LIC} {_V}3(?: 0)?"),
    ("lgpl-2.1", "lgpl", f"(?:gnu )?lgpl {_V}2 1"),
    ("lgpl-3", "lgpl", f"(?:gnu )?lgpl {_V}3(?: 0)?"),
    ("agpl-3", "affero", f"(?:gnu )?affero general public {_LIC}(?: {_V}3(?: 0)?)?"),
    ("agpl-3", "agpl", f"(?:gnu )?agpl {_V}3(?: 0)?"),
    ("gfdl", "free documentation", f"(?:gnu )?free documentation {_LIC}"),
    ("mpl-1.1", "mozilla", f"mozilla public {_LIC} {_V}1 1"),
    ("mpl-2", "mozilla", f"mozilla public {_LIC} {_V}2(?: 0)?"),
    ("epl-1", "eclipse", f"eclipse public {_LIC} {_V}1(?: 0)?"),
    ("epl-2", "eclipse", f"eclipse public {_LIC} {_V}2(?: 0)?"),
    ("edl-1", "eclipse", f"eclipse distribution {_LIC}"),
    ("cddl-1", "common development", f"common development and distribution {_LIC}"),
    ("cpl-1", "common public", f"common public {_LIC}(?: {_V}1(?: 0)?)?"),
    ("eupl-1.2", "european union", f"european union public {_LIC}(?: {_V}1 (?:1|2))?"),
    ("artistic-1", "artistic", f"artistic {_LIC} {_V}1(?: 0)?"),
    ("artistic-2", "artistic", f"artistic {_LIC} {_V}2(?: 0)?"),
    ("perl", "perl", "same terms as perl(?: itself)?"),
    ("boost", "boost", f"boost software {_LIC}"),
    ("zlib", "zlib", f"zlib(?: libpng)? {_LIC}"),
    ("isc", "isc", f"isc {_LIC}"),
    ("wtfpl", "wtfpl", "wtfpl"),
    ("unlicense", "unlicense", "(?:the )?unlicense"),
    ("openssl", "openssl", f"openssl {_LIC}"),
    ("postgresql", "postgresql", f"postgresql {_LIC}"),
    ("python", "python", f"python software foundation {_LIC}"),
    ("php", "php", f"php {_LIC}(?: {_V}3(?: 0|(?: 01))?)?"),
    ("ruby", "ruby", f"ruby {_LIC}"),
    ("ms-pl", "microsoft", f"microsoft public {_LIC}"),
    ("ms-rl", "microsoft", f"microsoft reciprocal {_LIC}"),
    ("ofl", "open font", f"(?:sil )?open font {_LIC}"),
    ("odbl", "open database", f"open database {_LIC}"),
    ("ncsa", "ncsa", f"(?:university of illinois )?ncsa(?: open source)? {_LIC}"),
    ("beerware", "beerware", f"beerware {_LIC}"),
    ("elastic", "elastic", f"elastic {_LIC}"),
    ("sspl", "server side", f"server side public {_LIC}"),
    ("bsl", "business source", f"business source {_LIC}"),
    ("cc0", "cc0", "cc0(?: 1 0)?(?: universal)?"),
    ("cc-by-nc-nd", "cc by", "cc by nc nd"),
    ("cc-by-nc-sa", "cc by", "cc by nc sa"),
    ("cc-by-nc", "cc by", "cc by nc"),
    ("cc-by-nd", "cc by", "cc by nd"),
    ("cc-by-sa", "cc by", "cc by sa"),
    ("cc-by", "cc by", "cc by"),
    ("cc-by-nc-nd", "creative commons", "creative commons attribution (?:noncommercial|non commercial) (?:noderivatives|no derivatives|noderivs)"),
    ("cc-by-nc-sa", "creative commons", "creative commons attribution (?:noncommercial|non commercial) (?:sharealike|share alike)"),
    ("cc-by-nc", "creative commons", "creative commons attribution (?:noncommercial|non commercial)"),
    ("cc-by-sa", "creative commons", "creative commons attribution (?:sharealike|share alike)"),
    ("cc-by", "creative commons", "creative commons attribution"),
    ("cecill-2", "cecill", f"cecill(?: free software)?(?: {_LIC})?(?: {_V}2(?: 1| 0)?)?"),
    ("vim", "vim", f"vim {_LIC}"),
    ("w3c", "w3c", f"w3c(?: software)?(?: notice and)? {_LIC}"),
    ("unicode", "unicode", f"unicode {_LIC}(?: agreement)?"),
    ("ipl-1", "ibm public", f"ibm public {_LIC}"),
    ("nasa-1.3", "nasa", "nasa open source agreement"),
    ("qpl-1", "q public", f"q public {_LIC}"),
    ("sleepycat", "sleepycat", f"sleepycat {_LIC}"),
    ("tcl", "tcl", f"tcl(?: tk)? {_LIC}"),
    ("apsl-2", "apple public", f"apple public source {_LIC}(?: {_V}2(?: 0)?)?"),
    ("osl-3", "open software", f"open software {_LIC}(?: {_V}3(?: 0)?)?"),
    ("afl-3", "academic free", f"academic free {_LIC}(?: {_V}3(?: 0)?)?"),
    ("ecl-2", "educational community", f"educational community {_LIC}"),
    ("upl-1", "universal permissive", f"universal permissive {_LIC}"),
    ("mulan-2", "mulan", f"mulan(?: psl| permissive software {_LIC})(?: {_V}2)?"),
    ("blue-oak-1", "blue oak", f"blue oak model {_LIC}"),
    ("polyform-nc", "polyform", f"polyform noncommercial {_LIC}"),
    ("cdla-permissive", "community data", f"community data {_LIC} agreement permissive"),
    ("odc-by", "open data commons", f"open data commons attribution {_LIC}"),
    ("pddl", "public domain dedication", f"public domain dedication and {_LIC}"),
    ("lppl-1.3", "latex project", f"latex project public {_LIC}"),
    ("zpl-2", "zope public", f"zope public {_LIC}"),
    ("rpl-1.5", "reciprocal public", f"reciprocal public {_LIC}"),
    ("aladdin", "aladdin", f"aladdin free public {_LIC}"),
    ("jsond", "json", f"json {_LIC}"),
    ("mpl-1.0", "mozilla", f"mozilla public {_LIC} {_V}1 0"),
    ("osdn", "public domain mark", "public domain mark(?: 1 0)?"),
)

_LATER = "or (?:at your option )?(?:any )?later(?: version)?"
#: Clauses that widen or narrow a licence: (label, keyword, priority, confidence, words). They are longer than the names in
#: them, so they suppress those.
CLAUSES = tuple(
    (f"{label}-or-later", key, 3, 0.95, f"{name} {_LATER}") for label, key, name in (
        ("gpl-2", "general public", f"(?:gnu )?general public {_LIC} {_V}2(?: 0)?"),
        ("gpl-3", "general public", f"(?:gnu )?general public {_LIC} {_V}3(?: 0)?"),
        ("gpl-2", "gpl", f"gpl {_V}2(?: 0)?"),
        ("gpl-3", "gpl", f"gpl {_V}3(?: 0)?"),
        ("lgpl-2.1", "lesser", f"(?:gnu )?lesser general public {_LIC} {_V}2 1"),
        ("lgpl-3", "lesser", f"(?:gnu )?lesser general public {_LIC} {_V}3(?: 0)?"),
        ("agpl-3", "affero", f"(?:gnu )?affero general public {_LIC} {_V}3(?: 0)?"),
        ("gfdl-1.3", "free documentation", f"(?:gnu )?free documentation {_LIC} {_V}1 3"))) + (
    ("gpl-2-only", "general public", 3, 0.90, f"(?:gnu )?general public {_LIC} {_V}2(?: 0)? only"),
    ("gpl-3-only", "general public", 3, 0.90, f"(?:gnu )?general public {_LIC} {_V}3(?: 0)? only"),
    ("classpath-exception", "classpath", 3, 0.90, "(?:gnu )?classpath exception(?: 2 0)?"),
    ("gcc-exception", "gcc runtime", 3, 0.90, "gcc runtime library exception(?: 3 1)?"),
    ("llvm-exception", "llvm", 3, 0.90, "(?:with )?llvm exceptions?"),
    ("font-exception", "font exception", 2, 0.80, "(?:gpl )?font exception(?: 2 0)?"),
    ("openssl-exception", "openssl", 2, 0.80, "openssl (?:linking )?exception"),
    ("bison-exception", "bison", 2, 0.80, "bison exception(?: 2 2)?"),
    ("linking-exception", "special exception", 2, 0.75, "as a special exception the copyright holders? (?:of this library )?give you permission to link"),
)

#: Phrase forms: (priority, confidence, words around the name N).
FORMS = (
    (3, 0.97, "(?:licensed|released|distributed|available|provided|published) under (?:the )?(?:terms of )?(?:the )?N"),
    (3, 0.95, "subject to (?:the )?(?:terms of )?(?:the )?N"),
    (3, 0.95, "spdx (?:license|licence) identifier N"),
    (2, 0.90, "under (?:the )?(?:terms of )?(?:the )?N"),
    (2, 0.85, "(?:license|licence) (?:is )?(?:the )?N"),
    (1, 0.60, "N"),
)

#: Sentences of licence texts: (label, keyword, priority, confidence, words).
SENTENCES = (
    ("mit", "permission is hereby", 3, 0.95, "permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "permission to use", 3, 0.90, "permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", "redistribution and use", 3, 0.90, "redistribution and use in source and binary forms"),
    ("bsd-3", "endorse or promote", 3, 0.85, "may be used to endorse or promote products derived from"),
    ("gpl", "free software", 3, 0.90, "this program is free software you can redistribute it and or modify it"),
    ("gpl", "general public", 1, 0.55, f"(?:gnu )?general public {_LIC}"),
    ("lgpl", "lesser", 1, 0.55, f"(?:gnu )?lesser general public {_LIC}"),
    ("mpl", "mozilla", 1, 0.55, f"mozilla public {_LIC}"),
    ("epl", "eclipse", 1, 0.55, f"eclipse public {_LIC}"),
    ("apache", "apache", 1, 0.60, f"apache (?:software )?{_LIC}"),
    ("cc", "creative commons", 1, 0.50, "creative commons"),
    ("unlicense", "unencumbered", 3, 0.95, "this is free and unencumbered software released into the public domain"),
    ("public-domain", "public domain", 2, 0.80, "(?:released|dedicated|placed|is) (?:in|into|to) the public domain"),
    ("wtfpl", "do what the", 3, 0.90, "do what the fuck you want to"),
    ("zlib", "provided as is", 2, 0.60, "this software is provided as is without any express or implied warranty in no event"),
    ("proprietary", "all rights reserved", 2, 0.80, "all rights reserved"),
    ("proprietary", "confidential and proprietary", 3, 0.90, "confidential and proprietary"),
    ("proprietary", "unauthorized copying", 3, 0.85, "unauthorized copying of this (?:file|work|document)"),
    ("proprietary", "no part of", 3, 0.80, "no part of this (?:publication|book|work|document) may be reproduced"),
    ("cc0", "waived all copyright", 3, 0.90, "has waived all copyright and related or neighboring rights"),
    ("gpl", "useful but", 2, 0.70, "distributed in the hope that it will be useful but without any warranty"),
    ("gpl", "copy of the gnu", 2, 0.75, f"you should have received a copy of the gnu general public {_LIC}"),
    ("lgpl", "copy of the gnu", 2, 0.75, f"you should have received a copy of the gnu lesser general public {_LIC}"),
    ("agpl", "copy of the gnu", 2, 0.75, f"you should have received a copy of the gnu affero general public {_LIC}"),
    ("apache-2", "except in compliance", 3, 0.85, f"you may not use this file except in compliance with the {_LIC}"),
    ("apache-2", "as is basis", 2, 0.70, "on an as is basis without warranties or conditions of any kind"),
    ("mpl-2", "source code form", 3, 0.90, f"this source code form is subject to the terms of the mozilla public {_LIC}"),
    ("boost", "software and accompanying", 3, 0.85, "obtaining a copy of the software and accompanying documentation covered by this"),
    ("zlib", "altered source", 3, 0.90, "altered source versions must be plainly marked as such"),
    ("ms-pl", "patent contributor", 2, 0.60, "each contributor grants you a non exclusive worldwide royalty free"),
    ("ofl", "reserved font", 3, 0.85, "reserved font names?"),
    ("artistic", "standard version", 2, 0.60, "you may distribute verbatim copies of the source form of the standard version"),
    ("bsd-4", "all advertising", 3, 0.90, "all advertising materials mentioning features or use of this software"),
    ("bsd", "neither the name", 3, 0.85, "neither the name of the copyright holder nor the names of its contributors"),
    ("0bsd", "with or without", 2, 0.80, "modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("beerware", "buy me a beer", 3, 0.90, "you can buy me a beer in return"),
    ("fair-source", "fair source", 2, 0.80, f"fair source {_LIC}"),
    ("proprietary", "trade secret", 2, 0.70, "(?:contains|is) (?:the )?(?:confidential|proprietary) (?:and )?trade secrets?"),
    ("proprietary", "evaluation purposes", 2, 0.70, "for (?:internal )?evaluation purposes only"),
    ("non-commercial", "non commercial", 1, 0.60, "(?:for )?non commercial use only"),
)


def _numbered(words: str) -> str:
    """A phrase over words as an expression over numbered words."""
    words = re.sub(r"VER ([0-9]+)", r"(?:version \1|v \1|v\1|\1)", words)
    return r"(?<![^ ])" + re.sub(r"[a-z0-9]+", lambda m: "[0-9]+:" + m[0], words) + r"(?![^ ])"


def texts_of(words: str) -> list[str]:
    """All phrases that a phrase expression stands for."""
    out, at = [""], 0
    while at < len(words):
        if words.startswith("(?:", at):
            depth, end, bars = 1, at + 3, []
            while depth:
                depth += {"(": 1, ")": -1}.get(words[end], 0)
                if depth == 1 and words[end] == "|":
                    bars.append(end)
                end += 1
            cuts = [at + 2, *bars, end - 1]
            options = [t for a, b in zip(cuts[:-1], cuts[1:], strict=True) for t in texts_of(words[a + 1:b])]
        elif m := re.match(r"VER ([0-9]+)", words[at:]):
            end, options = at + m.end(), [f"version {m[1]}", f"v {m[1]}", f"v{m[1]}", m[1]]
        else:
            end, options = at + 1, [words[at]]
        if words[end:end + 1] == "?":
            end, options = end + 1, [*options, ""]
        out, at = [o + t for o in out for t in options], end
    return out


#: Words too common to gate a rule by.
COMMON = frozenset("license licence licenses public general software version free open source the and of this use with you it".split())


def gate(key: str, words: str) -> tuple[str, ...]:
    """Keywords of which every text of the expression holds one at the start of a word: ``key``, and for each text without it
    its longest word that is not common."""
    keys = [key]
    for text in texts_of(words):
        if not any(f" {k}" in f" {text}" for k in keys):
            keys.append(max((w for w in text.split() if w not in COMMON), key=lambda w: (len(w), w), default=text))
    return tuple(f" {k}" for k in keys)


def prefix_tree(keys) -> str:
    """An expression that matches where any of the keywords begins, as a tree of letters: at a place it tries the letters that
    keywords share, not every keyword. A keyword that begins with another one is left out."""
    keys = sorted(set(keys))
    keys = [k for k in keys if not any(k != o and k.startswith(o) for o in keys)]
    if len(keys) == 1:
        return keys[0]
    heads = {k[0]: [o[1:] for o in keys if o[0] == k[0]] for k in keys}
    return "(?:" + "|".join(head + prefix_tree(rest) for head, rest in heads.items()) + ")"


def build_rules() -> list[tuple[str, tuple[str, ...], int, float, str]]:
    """(label, keywords, priority, confidence, expression over numbered words), in rule order."""
    rules = [(label, gate(key, words), p, c, _numbered(words)) for label, key, p, c, words in (*SENTENCES, *CLAUSES)]
    for label, key, name in FAMILIES:
        keys = gate(key, name)  # the name stands in every form
        rules += [(label, keys, p, c, _numbered(form.replace("N", name))) for p, c, form in FORMS]
    return rules


RULES = build_rules()
_SPAN = "array<struct<start:int,end:int,priority:int,rule:int,label:string,confidence:double>>"


def detections(norm: Column, numbered: Column, rules=None) -> Column:
    """Kept detections of one text: array<struct<start, end, priority, rule, label, confidence>> in order of
    start, longer first. ``norm``: its words with a space before each; ``numbered``: the numbered words."""
    rules = RULES if rules is None else rules
    by_key: dict[tuple, list] = {}
    for i, (label, key, p, c, pattern) in enumerate(rules):
        by_key.setdefault(key, []).append((i, label, p, c, pattern))
    table = F.array(*[F.struct(F.array(*map(F.lit, k)).alias("keys"), F.array(*[F.struct(
        F.lit(i).alias("rule"), F.lit(label).alias("label"), F.lit(p).alias("priority"), F.lit(float(c)).alias("confidence"),
        F.lit(pattern).alias("pattern")) for i, label, p, c, pattern in rows]).alias("rules"))
        for k, rows in by_key.items()])
    live = F.flatten(F.transform(F.filter(table, lambda t: F.exists(t["keys"], lambda k: F.contains(norm, k))), lambda t: t["rules"]))
    hits = F.flatten(F.transform(live, lambda r: F.transform(
        F.regexp_extract_all(numbered, r["pattern"], F.lit(0)), lambda m: F.struct(
            F.substring_index(m, ":", 1).cast("int").alias("start"),
            (-(F.substring_index(m, ":", 1).cast("int") + F.size(F.split(m, " ")))).alias("minus_end"),
            (-r["priority"]).alias("minus_priority"), r["rule"].alias("rule"), r["label"].alias("label"),
            r["confidence"].alias("confidence")))))
    zero = F.struct(*[F.lit(-1).alias(f"e{p}") for p in (1, 2, 3)], F.array().cast(_SPAN).alias("kept"))

    def step(a, x):
        end, p = -x["minus_end"], -x["minus_priority"]
        reach = F.when(p == 1, a["e1"]).when(p == 2, a["e2"]).otherwise(a["e3"])
        return F.when(reach >= end, a).otherwise(F.struct(
            *[F.when(p >= q, F.greatest(a[f"e{q}"], end)).otherwise(a[f"e{q}"]).alias(f"e{q}") for q in (1, 2, 3)],
            F.concat(a["kept"], F.array(F.struct(
                x["start"].alias("start"), end.alias("end"), p.alias("priority"), x["rule"].alias("rule"),
                x["label"].alias("label"), x["confidence"].alias("confidence")))).alias("kept")))

    return F.aggregate(F.sort_array(hits), zero, step, lambda a: a["kept"])


def _labelled(label: str):
    return lambda m: F.struct(F.substring_index(m, ":", 1).cast("int").alias("start"), F.lit(label).alias("label"))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=None) -> DataFrame:
    """One row per input row: ``doc_id, n_words, base_hits (array<struct<start, label>>), spans`` (kept
    detections, positions in words, end exclusive).

    Null and empty texts have no words and no detections; repeated rows are separate rows; null ids are
    kept; an empty table gives no rows. Other columns are ignored. Texts are taken whole.
    """
    rules = RULES if rules is None else rules
    keys = sorted({k for r in rules for k in r[1]})
    starts = prefix_tree(k.strip() for k in keys)  # tried behind blanks only
    gate = f" (?=[{''.join(sorted({k.strip()[0] for k in keys}))}]){starts}"
    # runs of separators become one blank; letters keep their case until a keyword is seen
    step = docs.select(F.col(id_col).alias("doc_id"), F.trim(F.regexp_replace(
        F.coalesce(F.col(text_col), F.lit("")), SEPARATORS, " ")).alias("spaced"))
    step = step.select("doc_id", "spaced", F.when(F.col("spaced") == "", F.lit(0)).otherwise(
        F.length("spaced") - F.length(F.replace("spaced", F.lit(" "), F.lit(""))) + 1).cast("long").alias("n_words"))
    step = step.select("doc_id", "n_words", F.when(F.concat(F.lit(" "), "spaced").rlike("(?i)" + gate), F.concat(
        F.lit(" "), lower_ascii(F.col("spaced")), F.lit(" "))).otherwise(F.lit("")).alias("norm"))
    step = step.withColumn("numbered", F.when(F.col("norm") != "", F.array_join(F.transform(
        F.split(F.trim("norm"), " "), lambda w, i: F.concat(i.cast("string"), F.lit(":"), w)), " ")).otherwise(F.lit("")))
    base = F.concat(*[F.transform(
        F.regexp_extract_all("numbered", F.lit(_numbered(phrase)), F.lit(0)), _labelled(label))
        for phrase, label in BASE_PHRASES.items()])
    none = F.array().cast("array<struct<start:int,label:string>>")
    some = F.col("numbered") != ""
    return step.select(
        "doc_id", "n_words", F.when(some, base).otherwise(none).alias("base_hits"),
        F.when(some, detections(F.col("norm"), F.col("numbered"), rules)).otherwise(F.array().cast(_SPAN)).alias("spans"))


def digest(scan: DataFrame) -> DataFrame:
    """The contract's columns from ``scan_licenses``. ``score``: 1 minus the product of (1 - confidence) over
    the kept detections, at least 0.99 with a base phrase."""
    starts = F.transform("base_hits", lambda h: h["start"])
    base = F.array_sort(F.array_distinct(F.transform("base_hits", lambda h: h["label"])))
    both = F.array_sort(F.array_distinct(F.concat(base, F.transform("spans", lambda s: s["label"]))))
    miss = F.aggregate("spans", F.lit(1.0), lambda a, s: a * (1.0 - s["confidence"]))
    return scan.select(
        "doc_id", "n_words", F.size("base_hits").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"), F.array_join(both, ",").alias("labels"),
        F.greatest(1.0 - miss, F.when(F.size("base_hits") > 0, F.lit(0.99)).otherwise(F.lit(0.0))).alias("score"),
        F.size("spans").cast("long").alias("n_spans"))
