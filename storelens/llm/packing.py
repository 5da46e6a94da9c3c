"""Operator 6: bounded-space online packing of token sequences.

Texts are tokenised where they are read (no shuffle of texts) and cut into pieces of at most ``length`` ids;
only narrow piece rows (id, start, length, checksum) go on. The pieces are dealt by hash into parts of about
``PART`` rows. Each part is packed online: ``open_windows`` windows are open, a piece goes to the window it fits
best, a full window is emitted, and when none fits the fullest is emitted and a new one opened. The windows still
open at the end are few per part; leftovers of neighbouring parts are merged by best fit, largest first.

Pieces and packed rows are each written once, so a lost executor cannot re-pack a part differently. A part
and a merge group hold a fixed number of narrow rows, whatever the input.
"""

from __future__ import annotations

import math
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.common import returned_memory, text_batches, write_once
from storelens.session import ship_package

LENGTH = 4096
OPEN_WINDOWS = 64
PART = 16_384
MERGE = 32  # parts whose leftovers are merged together
END_ID = 2
_WORDS = 600_000  # words remembered per task
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
_PACKED = _PIECES + ", no_id boolean, sequence_id long, offset long"


#: After a (Latin) letter, symbols up to a blank: the vocabulary's splitter cuts there too, so a blank changes no id.
_TAIL = (r"([A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{12f}\x{131}-\x{24f}])"
         r"([!-&(-/:-@\[-`{-~]+)([ \n]|\z)")


def _words(texts):
    """The words of each text (an Arrow array of texts), whose ids in a row are the text's, as a list array; null texts are empty.
    A text that might hold a special token's text keeps its capitals and symbols as they stand."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if texts.offset:  # a slice is copied: ``ascii_lower`` reads past a slice's start
        texts = texts.take(pa.array(range(len(texts)), pa.int64()))
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    spaced = pc.replace_substring_regex(pc.ascii_lower(texts), _TAIL, r"\1 \2\3")
    special = pc.match_substring(texts, "<|")
    if pc.any(special).as_py():
        spaced = pc.if_else(special, texts, spaced)
    return pc.split_pattern(pc.replace_substring(spaced, "\n", " "), " ")


class Encoder:
    """Ids of whole texts. The vocabulary drops white space and never joins across it, so a text's ids are its
    blank-separated words' ids in a row; it lower-cases, so A-Z may be lowered first. A batch's texts are split and their distinct
    words found by Arrow's kernels; words are remembered (up to a bound) as slices of one flat array, which ids are gathered from."""

    def __init__(self, path: str):
        import numpy as np
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(False)
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a run of letters or symbols
        self.closes[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        import numpy as np

        self.known = {"": 0}
        self.start, self.size, self.flat = np.zeros(1, "i8"), np.zeros(1, "i8"), np.empty(0, "<u4")

    def learn(self, words: list[str]) -> None:
        """New words. Words of plain letters are one run each, so many go in one call and closing ids part them; the
        others go one by one."""
        import numpy as np

        plain = [w for w in words if w.isalpha() and max(w) < "\u0250" and "\u0130" not in w]
        odd = list(set(words).difference(plain))
        parts = [plain[i:i + 1000] for i in range(0, len(plain), 1000)]
        sizes, ids = [], []
        for part, e in zip(parts, self.tokenizer.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False), strict=True):
            ids.append(np.array(e.ids, "<u4"))
            sizes.append(np.diff(np.flatnonzero(self.closes[ids[-1]]), prepend=-1))
            if len(sizes[-1]) != len(part):
                raise ValueError("the vocabulary does not close every run of letters")
        for e in self.tokenizer.encode_batch_fast(odd, add_special_tokens=False):
            ids.append(np.array(e.ids, "<u4"))
            sizes.append(np.array([len(ids[-1])], "i8"))
        size = np.concatenate(sizes)
        self.known.update(zip([*plain, *odd], range(len(self.known), len(self.known) + len(size)), strict=True))
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.flat = np.concatenate([self.flat, *ids])

    def __call__(self, texts) -> list:
        """The ids of each text (a list or an Arrow array) with the end id, as arrays of little-endian 32-bit numbers."""
        import numpy as np
        import pyarrow as pa

        words = _words(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        bounds = np.asarray(words.offsets)
        coded = words.values.dictionary_encode()
        distinct, codes = coded.dictionary.to_pylist(), np.asarray(coded.indices)
        if len(self.known) > _WORDS:
            self.forget()
        new = [w for w in distinct if w not in self.known]
        if new:
            self.learn(sorted(new))
        place = np.fromiter(map(self.known.__getitem__, distinct), "i8", len(distinct))
        starts, sizes, out = self.start[place], self.size[place], []
        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            at = codes[low:high]
            size = sizes[at]
            total = int(size.sum())
            ids = np.empty(total + 1, "<u4")
            if total:
                ids[:-1] = self.flat[np.repeat(starts[at] - (np.cumsum(size) - size), size) + np.arange(total)]
            ids[-1] = END_ID
            out.append(ids)
        return out


def default_tokenizer() -> str:
    """The public vocabulary file; installed with its package on every machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def tokenised(docs: DataFrame, length: int = LENGTH, tokenizer: str | None = None, id_col: str = "doc_id",
              text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``length`` ids: ``doc_id, start, length, ids_crc32, doc_tokens`` and, on request, ``ids``."""
    path = tokenizer or default_tokenizer()
    ship_package(docs.sparkSession)
    text_batches(docs.sparkSession)

    def cut(batches):
        import os

        import pyarrow as pa

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode = Encoder(path)  # the task's own: a worker that other stages use again should not keep the words
        with returned_memory():
            for batch in batches:
                ids, texts = batch.column(0).to_pylist(), batch.column(1)
                for at in range(0, len(ids), 1000):
                    rows = []
                    for doc, seq in zip(ids[at:at + 1000], encode(texts[at:at + 1000]), strict=True):
                        for s in range(0, len(seq), length):
                            piece = seq[s:s + length]
                            rows.append((doc, s, len(piece), zlib.crc32(piece.tobytes()), len(seq), piece))
                    cols = list(zip(*rows, strict=True))
                    arrays = [pa.array(c, pa.int64()) for c in cols[:5]]
                    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                    if with_ids:
                        arrays.append(pa.array([c.astype("i4") for c in cols[5]], pa.list_(pa.int32())))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(arrays, names=names)
            encode.forget()

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(
        cut, _PIECES + (", ids array<int>" if with_ids else ""))


def pack_online(lengths: list[int], capacity: int, open_windows: int) -> tuple[list[list[int]], list[list[int]]]:
    """Positions of the pieces in emitted windows, and in the windows still open at the end."""
    emitted: list[list[int]] = []
    windows: list[list[int]] = []
    room: list[int] = []
    for i, n in enumerate(lengths):
        best = min((r, j) for j, r in enumerate(room) if r >= n) if any(r >= n for r in room) else None
        if best is None:
            if len(windows) >= open_windows:
                fullest = min(range(len(room)), key=lambda j: (room[j], j))
                emitted.append(windows.pop(fullest))
                room.pop(fullest)
            windows.append([i])
            room.append(capacity - n)
            j = len(windows) - 1
        else:
            j = best[1]
            windows[j].append(i)
            room[j] -= n
        if room[j] == 0:
            emitted.append(windows.pop(j))
            room.pop(j)
    return emitted, windows


def pack_best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Best fit, largest first, over all pieces of a merge group."""
    import bisect

    windows: list[list[int]] = []
    rooms: list[tuple[int, int]] = []  # (room, window), ascending
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        k = bisect.bisect_left(rooms, (lengths[i], -1))
        if k == len(rooms):
            windows.append([i])
            bisect.insort(rooms, (capacity - lengths[i], len(windows) - 1))
        else:
            r, j = rooms.pop(k)
            windows[j].append(i)
            bisect.insort(rooms, (r - lengths[i], j))
    return windows


def _rows(frame, windows: list[list[int]], first: int):
    """The frame's rows in window order with sequence ids from ``first`` and offsets."""
    order = [i for w in windows for i in w]
    out = frame.iloc[order].copy()
    out["sequence_id"] = [first + k for k, w in enumerate(windows) for _ in w]
    out["sequence_id"] = out["sequence_id"].astype("int64")
    out["offset"] = (out.groupby("sequence_id", sort=False)["length"].cumsum() - out["length"]).astype("int64")
    return out


def pack(docs: DataFrame, length: int = LENGTH, open_windows: int = OPEN_WINDOWS, tokenizer: str | None = None,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A null or empty text is its end id alone; null ids are kept; repeated rows are packed each; a text of any
    length is cut every ``length`` ids; an empty table gives no rows. Other columns are ignored. Which ids lie in
    which sequence depends on the rows alone, not on tasks. ``sequences`` gives the padded ids.
    """
    # pandas has no null integers: a null id travels as a zero and a mark
    pieces = write_once(tokenised(docs, length, tokenizer, id_col, text_col).withColumns(
        {"no_id": F.col("doc_id").isNull(), "doc_id": F.coalesce("doc_id", F.lit(0))}), "pieces")
    parts = max(1, math.ceil(pieces.count() / PART))
    names = [f.split()[0] for f in _PACKED.split(", ")]

    def online(key, frame):
        frame = frame.sort_values(["no_id", "doc_id", "start", "ids_crc32"], kind="stable", ignore_index=True)
        emitted, left = pack_online(frame["length"].tolist(), length, open_windows)
        first = key[0] << 24
        a, b = _rows(frame, emitted, first), _rows(frame, left, first + len(emitted))
        a["left"], b["left"] = False, True
        import pandas as pd

        return pd.concat([a, b])[["part", *names, "left"]]

    def merge(key, frame):
        frame = frame.sort_values(["part", "sequence_id", "offset"], ignore_index=True)
        return _rows(frame, pack_best_fit(frame["length"].tolist(), length), (1 << 60) + (key[0] << 24))[names]

    dealt = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(parts)))
    packed = write_once(dealt.groupBy("part").applyInPandas(online, f"part long, {_PACKED}, left boolean"), "packed")
    merged = packed.where("left").withColumn("grp", F.floor(F.col("part") / MERGE)).groupBy("grp").applyInPandas(
        merge, _PACKED)
    return packed.where("not left").select(*names).unionAll(merged).withColumn(
        "doc_id", F.when(~F.col("no_id"), F.col("doc_id"))).drop("no_id")


def sequences(docs: DataFrame, pieces: DataFrame, length: int = LENGTH, pad_id: int = 0, tokenizer: str | None = None,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The training sequences of ``pack``'s rows: ``sequence_id, ids`` (padded to ``length``), ``n_tokens``."""
    key = ["doc_id", "start", "ids_crc32"]
    ids = tokenised(docs, length, tokenizer, id_col, text_col, with_ids=True).select(*key, "ids").dropDuplicates(key)
    i, p = ids.alias("i"), pieces.alias("p")
    same = F.col("p.doc_id").eqNullSafe(F.col("i.doc_id")) & (F.col("p.start") == F.col("i.start")) & (
        F.col("p.ids_crc32") == F.col("i.ids_crc32"))
    joined = p.join(i, same).select("p.sequence_id", "p.offset", "i.ids")
    flat = joined.groupBy("sequence_id").agg(F.flatten(F.transform(
        F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))
    return flat.select("sequence_id", F.concat("ids", F.array_repeat(F.lit(pad_id), F.lit(length) - F.size("ids"))).alias("ids"),
                       F.size("ids").alias("n_tokens"))
