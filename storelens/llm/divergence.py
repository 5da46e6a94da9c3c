"""Operator 13: how far the sources of a language differ in their words.

Counting. A task joins the text buffers of its Arrow batches into slices of some megabytes, lower-cases bytes through a
table and takes a pointer to every word start. The pointers are sorted by the words they point at with a multikey
quicksort whose characters are eight bytes long: ternary splits at a sampled pivot, small slices sorted directly, equal
runs going on to the next eight bytes. A slice's documents stand in order of their group and the sort is stable, so inside
a run of equal words the pointers lie by group and document, and the run's breaks give counts and document frequencies
per (lang, source) at once. Only those sums leave the task; they are combined by word in ordinary aggregates.

Comparing. ``p = 1 + floor(1e9 * (count + 1) / (N + V))`` is exact decimal arithmetic in SQL. The pair sums go over all
kept words of a language, those a source lacks included: words are dealt by hash into slices of about ``TERMS`` and the
sources into blocks of about ``SOURCES``, a task sums the pairs of one block over one slice in 64-bit integers, and the
sums of the slices are added up. The sums fit as long as a language keeps fewer than 2^31 words.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storelens.llm.common import returned_memory, text_batches, write_once
from storelens.session import ship_package

SLICE = 24 << 20  # bytes of text sorted at once
DIRECT = 1 << 16  # pointers sorted without further splits
SCALE = 1_000_000_000
MIN_DOCS = 3
TOP = 200
TERMS, SOURCES, SALTS = 16_384, 64, 32
CELLS = 1 << 18  # cells of a block of words by sources compared at once


def _lower():
    """Byte to byte: A-Z lowered, other bytes of words (a-z and all above 0x7F) as they are, the rest 0."""
    import numpy as np

    table = np.arange(256, dtype="u1")
    table[65:91] += 32
    table[:65] = 0
    table[91:97] = 0
    table[123:128] = 0
    return table


def symbols(flat, at):
    """The eight bytes from each place as one number, the first byte highest, zero from the end of the word on."""
    import numpy as np

    out, inside = np.zeros(len(at), "u8"), np.ones(len(at), bool)
    for k in range(8):
        byte = flat[at + k]
        inside &= byte != 0
        out <<= np.uint64(8)
        out |= np.where(inside, byte, 0).astype("u8")
    return out


def sort_pointers(flat, pointers):
    """``pointers`` in the order of the words they point at, equal words in their given order; and for each whether it begins
    a run of equal words. ``flat`` ends with eight zeros at least; a word ends at its first zero.

    Multikey quicksort: a slice is split by its symbol (eight bytes at its depth) into lower, equal and higher; lower and
    higher keep the symbol, equal goes on behind it, or is a finished run if the word ended within it.
    """
    import numpy as np

    order, begins = np.empty_like(pointers), np.zeros(len(pointers), bool)
    work = [(0, pointers, 0, None)]  # first place, pointers, depth in bytes, their symbols if known
    while work:
        first, at, depth, keys = work.pop()
        n = len(at)
        if n == 0:
            continue
        if keys is None:
            keys = symbols(flat, at + depth)
        if n > DIRECT:
            pivot = np.sort(keys[:: max(1, n // 101)])[51 * len(keys[:: max(1, n // 101)]) // 101]
            low, same = keys < pivot, keys == pivot
            high = ~(low | same)
            a, b = int(low.sum()), int(same.sum())
            work.append((first, at[low], depth, keys[low]))
            work.append((first + a + b, at[high], depth, keys[high]))
            if int(pivot) & 0xFF:
                work.append((first + a, at[same], depth + 8, None))
            else:
                order[first + a:first + a + b] = at[same]
                begins[first + a] = True
            continue
        # a small slice at once: by symbol, then again within equal runs that go on, until every run has ended
        place, run = np.arange(n), np.zeros(n, "i8")
        done_at, done_new = at.copy(), np.zeros(n, bool)
        while len(place):
            by = np.lexsort((keys, run))
            at_now, keys, run = done_at[place][by], keys[by], run[by]
            new = np.empty(len(by), bool)
            new[0] = True
            new[1:] = (run[1:] != run[:-1]) | (keys[1:] != keys[:-1])
            done_at[place] = at_now
            done_new[place] |= new
            run = np.cumsum(new)
            goes_on = (keys & np.uint64(0xFF)) != 0
            goes_on &= np.bincount(run)[run] > 1
            place, run, depth = place[goes_on], run[goes_on], depth + 8
            keys = symbols(flat, done_at[place] + depth) if len(place) else keys[:0]
        order[first:first + n], begins[first:first + n] = done_at, done_new
    return order, begins


def count_slice(texts: list, groups, n_groups: int):
    """Words of one slice: ``(group, word bytes, words' ends in them, occurrences, documents)``.

    ``texts``: each document's UTF-8 bytes, in order of ``groups`` (their group numbers, ascending).
    """
    import numpy as np

    sizes = np.array([len(t) + 1 for t in texts], "i8")
    flat = _lower()[np.frombuffer(b"".join(b"\x00" + bytes(t) for t in texts) + b"\x00" * 16, "u1")]
    letters = flat != 0
    pointers = np.flatnonzero(letters[1:] & ~letters[:-1]) + 1
    order, begins = sort_pointers(flat, pointers)
    if not len(order):
        return np.empty(0, "i8"), b"", np.zeros(1, "i8"), np.empty(0, "i8"), np.empty(0, "i8")
    doc = np.searchsorted(np.cumsum(sizes), order, side="right")
    group = np.asarray(groups, "i8")[doc]
    new_group = begins.copy()
    new_group[1:] |= group[1:] != group[:-1]
    new_doc = new_group.copy()
    new_doc[1:] |= doc[1:] != doc[:-1]
    at = np.flatnonzero(new_group)
    occurrences = np.diff(at, append=len(order))
    documents = np.add.reduceat(new_doc.astype("i8"), at)
    ends = np.flatnonzero(~letters)
    start = order[at]
    length = ends[np.searchsorted(ends, start)] - start
    stop = np.cumsum(length)
    where = np.repeat(start - (stop - length), length) + np.arange(int(stop[-1]))
    return group[at], flat[where].tobytes(), np.concatenate([[0], stop]), occurrences, documents


_COUNTS = "lang string, source string, term string, n long, docs long"


def _count_batches(batches: Iterator, limit: int) -> Iterator:
    """Arrow batches (lang, source, text) to batches of sums, a slice of about ``limit`` bytes at a time."""
    import numpy as np
    import pyarrow as pa

    def flush(held: list):
        held.sort(key=lambda x: x[0])
        names = sorted({k for k, _ in held})
        number = {k: i for i, k in enumerate(names)}
        group, words, ends, n, docs = count_slice([t for _, t in held], [number[k] for k, _ in held], len(names))
        for i in range(0, len(group), 100_000):  # parts, so that a batch's text stays within 32-bit offsets
            part, at = group[i:i + 100_000], ends[i:i + 100_001]
            terms = pa.StringArray.from_buffers(
                len(part), pa.py_buffer((at - at[0]).astype("i4").tobytes()), pa.py_buffer(words[at[0]:at[-1]]))
            langs, sources = (pa.array([k[j] for k in names], pa.string()) for j in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [langs.take(pa.array(part)), sources.take(pa.array(part)), terms, pa.array(n[i:i + 100_000]),
                 pa.array(docs[i:i + 100_000])], names=["lang", "source", "term", "n", "docs"])

    held, size = [], 0
    with returned_memory():
        for batch in batches:
            lang, source = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            texts = batch.column(2)
            offsets = np.frombuffer(texts.buffers()[1], "i4", len(texts) + 1, texts.offset * 4)
            data = memoryview(texts.buffers()[2] or b"")
            for i in range(len(texts)):
                held.append(((lang[i], source[i]), bytes(data[offsets[i]:offsets[i + 1]])))
            size += int(offsets[-1] - offsets[0])
            if size >= limit:
                yield from flush(held)
                held, size = [], 0
        if held:
            yield from flush(held)


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                slice_bytes: int = SLICE) -> DataFrame:
    """Occurrences and documents of every word by group: ``lang, source, term, n, docs``."""
    ship_package(docs.sparkSession)
    text_batches(docs.sparkSession)
    read = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in (
        (lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    found = read.mapInArrow(lambda batches: _count_batches(batches, slice_bytes), _COUNTS)
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _p(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + terms)), exact."""
    above = (count.cast("decimal(19,0)") + 1) * F.lit(SCALE).cast("decimal(10,0)")
    return F.lit(1).cast("long") + F.call_function("div", above, total.cast("decimal(19,0)") + terms.cast("decimal(19,0)"))


def kept_terms(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang, source, term, n, total``: the words that stand in ``min_docs`` documents of their language, with its total."""
    word = Window.partitionBy("lang", "term")  # at most one row a source
    return (counts.withColumn("total", F.sum("n").over(word)).withColumn("df", F.sum("docs").over(word))
            .where(F.col("df") >= min_docs).select("lang", "source", "term", "n", "total"))


def group_totals(docs: DataFrame, kept: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per occurring group: ``lang, source, n_group, n_lang, v`` (occurrences of kept words; kept words of the
    language) and ``p_zero``, the group's p of a word that it lacks."""
    groups = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in (
        (lang_col, "lang"), (source_col, "source"))]).distinct()
    by_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    by_lang = (kept.groupBy("lang", "term").agg(F.max("total").alias("total"))
               .groupBy("lang").agg(F.sum("total").alias("n_lang"), F.count("*").alias("v")))
    out = groups.join(by_group, ["lang", "source"], "left").join(by_lang, "lang", "left").fillna(0, ["n_group", "n_lang", "v"])
    return out.withColumn("p_zero", F.when(F.col("v") > 0, _p(F.lit(0), F.col("n_group"), F.col("v"))).otherwise(0))


def top_terms(kept: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """Part ``term``: each group's words with p above its language's, by f, to rank ``top``."""
    p = _p(F.col("n"), F.col("n_group"), F.col("v"))
    q = _p(F.col("total"), F.col("n_lang"), F.col("v"))
    scored = (kept.join(groups, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q"))
              .where("p > q").select("lang", "source", "item", F.expr("((p - q) * (p - q)) div q").alias("value")))
    best = [F.desc("value"), F.asc("item")]
    # a group may hold most of the words: the first ranks of each of its shares, then of those
    share = Window.partitionBy("lang", "source", "share").orderBy(*best)
    some = (scored.withColumn("share", F.pmod(F.xxhash64("item"), F.lit(SALTS))).withColumn("rank", F.row_number().over(share))
            .where(F.col("rank") <= top).drop("rank", "share"))
    return (some.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*best)))
            .where(F.col("rank") <= top).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))


def _pair_sums(frame_words, frame_groups):
    """The sums of one slice and block: for each source of the block and each other source of the language, f over the
    slice's words. Both tables hold one language."""
    import numpy as np
    import pyarrow as pa

    sources = frame_groups.column("source").to_pylist()
    place = {s: i for i, s in enumerate(sources)}
    zero = np.array(frame_groups.column("p_zero"), "i8")
    mine = np.flatnonzero(np.array(frame_groups.column("own"), bool))
    sums = np.zeros((len(mine), len(sources)), "i8")
    if frame_words.num_rows:
        terms = frame_words.column("term").combine_chunks().dictionary_encode()
        words = np.array(terms.indices, "i8")
        named = frame_words.column("source").combine_chunks().dictionary_encode()
        cols = np.array([place[s] for s in named.dictionary.to_pylist()], "i8")[np.array(named.indices)]
        p = np.array(frame_words.column("p"), "i8")
        by = np.argsort(words, kind="stable")
        words, cols, p = words[by], cols[by], p[by]
        step = max(1, CELLS // len(sources))
        for low in range(0, len(terms.dictionary), step):
            a, b = np.searchsorted(words, (low, low + step))
            block = np.repeat(zero[None, :], min(step, len(terms.dictionary) - low), 0)
            block[words[a:b] - low, cols[a:b]] = p[a:b]
            block = block.astype("u8")
            for i, g in enumerate(mine):
                one = block[:, g:g + 1]
                apart = np.where(one > block, one - block, block - one)
                sums[i] += (apart * apart // block).sum(0).astype("i8")
    i, j = np.nonzero(mine[:, None] != np.arange(len(sources))[None, :])
    lang = frame_groups.column("lang")[0]
    names = pa.array(sources, pa.string())
    return pa.table({"lang": pa.array([lang.as_py()] * len(i), pa.string()), "source": names.take(pa.array(mine[i])),
                     "item": names.take(pa.array(j)), "value": pa.array(sums[i, j], pa.int64())})


def source_pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """Part ``pair``: each group against each other source of its language, f summed over all kept words."""
    ship_package(kept.sparkSession)
    blocks = F.greatest(F.lit(1), F.ceil(F.count("*").over(Window.partitionBy("lang")) / SOURCES)).cast("int")
    slices = F.greatest(F.lit(1), F.ceil(F.col("v") / TERMS)).cast("int")
    sized = groups.withColumn("blocks", blocks).withColumn("slices", slices).withColumn(
        "home", F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int"))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    words = (kept.join(sized, ["lang", "source"])
             .select("lang", "source", "term", _p(F.col("n"), F.col("n_group"), F.col("v")).alias("p"),
                     F.pmod(F.xxhash64("term"), F.col("slices")).cast("int").alias("slice"), F.explode(every).alias("block")))
    sides = (sized.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
             .select("lang", "source", "p_zero", "slice", F.explode(every).alias("block"), "home")
             .withColumn("own", F.col("home") == F.col("block")).drop("home"))
    key = ["lang", "slice", "block"]
    part = words.groupBy(*key).cogroup(sides.groupBy(*key)).applyInArrow(_pair_sums, "lang string, source string, item string, value long")
    total = part.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item")))
    return total.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))


def audit_sources(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                  min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank``: every pair of sources of a language (part ``pair``), and for each source the
    words it holds more of than its language does (part ``term``, ranks to ``top``).

    Null texts, languages and sources are empty strings; each row is a document, repeated rows are each one; a group without
    words has count 0 of every kept word; a language without kept words gives pairs of value 0; ties go by the item's UTF-8
    bytes; texts of any length are taken whole; other columns are ignored; an empty table gives no rows.
    """
    kept = write_once(kept_terms(term_counts(docs, text_col, lang_col, source_col), min_docs), "kept-terms")
    groups = write_once(group_totals(docs, kept, lang_col, source_col), "source-groups")
    return source_pairs(kept, groups).unionByName(top_terms(kept, groups, top))
