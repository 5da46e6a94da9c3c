"""Operator 3: main text of web pages, by structure and by nearest-URL page differencing.

A page is cut into blocks (one text line each) and every block gets a role: ``main`` inside article or main
elements, ``frame`` inside menus, headers, footers, sidebars, notices, adverts, forms and reader comments (by
element, role or class words), else ``open``. Pages of a host are
ordered by URL path, each is paired with the neighbour whose path shares the longer head, and all lines of the two pages
outside main are aligned by longest common subsequence: shared lines are the host's template and are deleted. Structure
guards both ways: frames that a pair does not share go as well, and main lines are not taken out by a pair. A pair that agrees
almost everywhere may be copies, whose shared lines say nothing about a template, or pages with little text of their own. There, and for
lines inside main elements, the whole host decides: a line goes if at least half of the host's different pages, and three or more, have it
(pages with the same longest line are copies and count once), unless hardly any text of the page would be left. So copies keep
their whole article, and a repeated notice inside an article goes.

Plan: the first pass reads the pages and writes only URLs, 64-bit hashes and lengths of lines. Pages per host and line are counted on
them by Spark aggregates; a host's common lines are few (on average at most twice those of a page) and join its pages.
The rows with lines outside main are sorted by (host, path, id) over the cluster, numbered, and compared in chunks of ``CHUNK`` neighbours with one row
of overlap at either end, so a host with a third of all pages is spread like any other. The result, the positions of deleted lines, joins
the pages, whose second pass gives the text.
"""

from __future__ import annotations

import html as html_lib
import itertools
import re
from urllib.parse import urlsplit

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.common import text_batches, write_once
from storelens.session import ship_package

CHUNK = 512
COPY_SHARE = 0.8  # of the longer page's lines: from here on a pair may be copies, and the host decides
DEALS = 64
HOST_PAGES = 3  # different pages a host must have to decide
HOST_SHARE = 0.5  # of the host's different pages: from here on a line is common to the host
OWN_SHARE = 0.05  # of a page's characters: with less left, the host's common lines stay

# Element names by their part in a page.
_SKIP = {"script", "style", "noscript", "template", "head", "title", "svg", "math", "iframe", "object", "canvas", "select",
         "textarea", "button", "audio", "video", "datalist"}
_RAW = {"script", "style", "textarea", "title", "iframe", "noscript"}
_FRAME = {"nav", "header", "footer", "aside", "form", "menu", "dialog"}
_MAIN = {"article", "main"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr", "param"}
_BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
          "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html",
          "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead",
          "tr", "ul"}
_FRAME_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "menubar", "dialog", "alert", "alertdialog"}
_FRAME_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments",
                "consent", "cookie", "cookies", "copyright", "disqus", "footer", "gdpr", "header", "masthead", "menu", "modal", "nav",
                "navbar", "navigation", "newsletter", "notice", "pagination", "popup", "promo", "promoted", "promotion", "related", "replies",
                "share", "sharing", "sidebar", "skip", "social", "sponsor", "sponsored", "subscribe", "subscription", "toolbar", "topbar",
                "widget", "widgets"}
_NAME = re.compile(r"[a-zA-Z]")
_NAME_END = re.compile(r"[\s/>]")
_HALT = re.compile(r"[=>]")
_VALUE = re.compile(r"\s*+(?:\"[^\"]*+\"|'[^']*+')")
_ATTR = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?|\"[^\"]*\"|'[^']*'")
# Frame words that also name the wrapper of a whole page: an article below may be the page's own.
_WRAPPERS = {"banner", "header", "masthead", "menu", "nav", "navbar", "navigation", "notice", "promo", "share", "sharing", "sidebar", "social",
             "toolbar", "topbar", "widget", "widgets"}
_STATES = {"has", "have", "with", "without", "no", "not", "is", "show", "hide", "after", "before", "below"}
_HOLDERS = {"layout", "wrapper", "wrap", "page", "container", "content", "body", "main", "open", "closed", "enabled", "visible"}
_READ = {"main", "open", "maybe", "form", "frame", "soft"}
_SPACE = re.compile(r"\s+")


def _attributes(attrs: str | None) -> dict[str, str]:
    """Attribute names and values in lower case, the first of a name."""
    out: dict[str, str] = {}
    for key, a, b, c in _ATTR.findall(attrs or ""):
        if key:
            out.setdefault(key.lower(), (a or b or c).lower())
    return out


def _words(value: str) -> set[str]:
    """Frame words of a class or id: a token itself, or a part of it unless it tells a state (has-sidebar) or a holder (header-wrapper)."""
    found = set()
    for token in value.split():
        parts = [x for x in re.split(r"[^a-z0-9]+", token) if x]
        if len(parts) == 1 or (parts and parts[0] not in _STATES and parts[-1] not in _HOLDERS):
            found.update(_FRAME_WORDS.intersection(parts))
    return found


def _frame_kind(name: str, attrs: dict[str, str]) -> str:
    """``frame``, ``soft`` (by wrapper words only), ``form``, or nothing."""
    if name == "form":
        return "form"
    if name in _FRAME:
        return "frame"
    if name in _MAIN or name in ("body", "html") or not attrs:
        return ""
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or re.search(
            r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", "")) or attrs.get("role") in _FRAME_ROLES:
        return "frame"
    words = _words(attrs.get("class", "")) | _words(attrs.get("id", ""))
    return "" if not words else "soft" if words <= _WRAPPERS else "frame"


class Tags:
    """The tags of a page in order, each character looked at a bounded number of times whatever the markup: the next place of a
    kind is remembered, and so is every ``=`` from which no tag end can be reached."""

    def __init__(self, page: str):
        self.page, self.last = page, page.rfind(">")
        self.stops = {_HALT: (0, -1), _NAME_END: (0, -1)}
        self.doomed: set[int] = set()

    def _stop(self, pattern, at: int) -> int:
        low, stop = self.stops[pattern]  # the first stop from any place between the two on
        if not low <= at <= stop:
            m = pattern.search(self.page, at)
            stop = m.start() if m else len(self.page)
            self.stops[pattern] = at, stop
        return stop

    def _end(self, at: int) -> int:
        """The place of the ``>`` that ends the tag whose attributes begin at ``at``; quoted values may hold ``>``. -1 if none."""
        seen, n = [], len(self.page)
        while (at := self._stop(_HALT, at)) < n and self.page[at] == "=" and at not in self.doomed:
            seen.append(at)
            value = _VALUE.match(self.page, at + 1)
            at = value.end() if value else at + 1
        if at < n and self.page[at] == ">":
            return at
        self.doomed.update(seen)
        return -1

    def next(self, at: int) -> tuple[int, int, str, str]:
        """(start, end, lower-case name, attributes) of the first tag, comment or declaration from ``at`` on (the latter two
        without name); (length, length, "", "") if there is none."""
        page, n = self.page, len(self.page)
        while (at := page.find("<", at)) >= 0:
            for head, foot in (("<!--", "-->"), ("<![CDATA[", "]]>"), ("<!", ">"), ("<?", ">")):
                if page.startswith(head, at):
                    close = page.find(foot, at + len(head))
                    return at, n if close < 0 else close + len(foot), "", ""
            first = at + 2 if page.startswith("</", at) else at + 1
            if at < self.last and _NAME.match(page, first):
                tail = self._stop(_NAME_END, first)
                close = self._end(tail) if tail < n else -1
                if close >= 0:
                    return at, close + 1, page[first:tail].lower(), page[tail:close]
            at += 1
        return n, n, "", ""


def blocks(page: str | None) -> list[tuple[str, str]]:
    """(role, text line) of a page's blocks in page order; role ``main`` or ``open``, frames left out."""
    return [(r, t) for r, t in all_blocks(page) if r != "frame"]


def all_blocks(page: str | None) -> list[tuple[str, str]]:
    """(role, text line) of all of a page's blocks in page order: ``main``, ``open`` or ``frame``.

    A main element below a form or a wrapper word is main. An article below a wrapper word is main if the page has no other main line;
    the text of a form is open if the page has no line besides it. Time and memory grow with the page's length.
    """
    out: list[tuple[str, str]] = []
    stack: list[tuple[str, str]] = []  # open elements and the role inside: main, open, frame, soft, form, maybe or skip
    opened: dict[str, int] = {}  # how many of the open elements have a name
    line: list[str] = []
    role = "open"
    page = page or ""

    def leave() -> str:
        name = stack.pop()[0]
        opened[name] -= 1
        return name

    def flush() -> None:
        if line:
            text = _SPACE.sub(" ", html_lib.unescape("".join(line))).strip()
            line.clear()
            if text:
                out.append((role, text))

    at, end, tags = 0, len(page), Tags(page)
    while at < end:
        start, after, name, tail = tags.next(at)
        if start > at and role in _READ:
            line.append(page[at:start])
        if start == end:
            break
        at = after
        if not name:
            continue
        if page[start + 1] == "/":
            if name in _BLOCK or name in _SKIP:
                flush()
            if opened.get(name):
                while leave() != name:
                    pass
                role = stack[-1][1] if stack else "open"
            continue
        if name in _BLOCK:
            flush()
        if name in _VOID:
            if name == "br" and role in _READ:
                line.append(" ")
            continue
        if name in _BLOCK and stack and stack[-1][0] == "p":
            leave()
            role = stack[-1][1] if stack else "open"
        if name in _SKIP:
            inside = "skip"
        elif role in ("skip", "frame"):
            inside = role
        else:
            attrs = _attributes(tail)
            kind, main = _frame_kind(name, attrs), name == "main" or attrs.get("role") == "main"
            if kind:
                inside = "frame" if role == "maybe" else "soft" if role == "soft" and kind == "form" else kind
            elif main and role != "maybe":
                inside = "main"
            elif name in _MAIN and role != "maybe":
                inside = "maybe" if role == "soft" else "main"
            else:
                inside = role
        if inside != role:
            flush()
        if tail.endswith("/") and name not in _BLOCK:
            continue
        stack.append((name, inside))
        opened[name] = opened.get(name, 0) + 1
        role = inside
        if name in _RAW:  # raw text: only its own end tag ends it
            close = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = close.start() if close else end
    flush()
    told = {r for r, _ in out} - {"frame", "soft"}
    as_main, as_open = {"main"} if "main" in told else {"maybe"}, {"open"} if told - {"form"} else {"form"}
    return [("main" if r in as_main else "open" if r in as_open else "frame", t) for r, t in out]


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Positions in ``a`` of a longest common subsequence with ``b``. Bit-parallel rows over ``b``; beyond a fixed
    amount of row memory ``a`` is halved at the best cut of ``b`` (same result length, linear memory)."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    known = set(b[head:len(b) - tail])
    keep = [i for i in range(head, len(a) - tail) if a[i] in known]
    known = {a[i] for i in keep}
    mid = _lcs([a[i] for i in keep], [x for x in b[head:len(b) - tail] if x in known])
    return [*range(head), *(keep[i] for i in mid), *range(len(a) - tail, len(a))]


def _rows(a: list[int], b: list[int], keep: bool) -> list[int]:
    """Bit vectors after each element of ``a``: a zero at place j means that b[j] lengthens the subsequence."""
    places: dict[int, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | (1 << j)
    full = (1 << len(b)) - 1
    v, out = full, []
    for x in a:
        u = v & places.get(x, 0)
        v = ((v + u) | (v - u)) & full
        if keep:
            out.append(v)
    return out if keep else [v]


def _lcs(a: list[int], b: list[int], limit: int = 1 << 28) -> list[int]:
    if not a or not b:
        return []
    if len(a) * len(b) <= limit or len(a) == 1:
        rows, out, j = _rows(a, b, True), [], len(b) - 1
        for i in range(len(a) - 1, -1, -1):
            before = rows[i - 1] if i else (1 << len(b)) - 1
            # the subsequence over b[..j] has as many elements as zeros at places 0..j
            mask = (1 << (j + 1)) - 1
            if (rows[i] & mask).bit_count() < (before & mask).bit_count():
                while j >= 0 and b[j] != a[i]:
                    j -= 1
                # the last place at which row i gains over the row before
                out.append(i)
                j -= 1
            if j < 0:
                break
        return out[::-1]
    half = len(a) // 2
    up = _rows(a[:half], b, False)[0]
    down = _rows(a[:half - 1:-1], b[::-1], False)[0]
    best, cut, left, right = -1, 0, 0, len(b) - down.bit_count()
    for j in range(len(b) + 1):
        if left + right > best:
            best, cut = left + right, j
        if j < len(b):
            left += not (up >> j) & 1
            right -= not (down >> (len(b) - 1 - j)) & 1
    return _lcs(a[:half], b[:cut], limit) + [half + i for i in _lcs(a[half:], b[cut:], limit)]


def _hash(lines: list[str]) -> list[int]:
    import xxhash

    return [xxhash.xxh64_intdigest(x) - (1 << 63) for x in lines]


def split_url(url: str | None) -> tuple[str, str]:
    """Host (lower case, without www. and port) and path with query; fragments do not count."""
    try:
        u = urlsplit((url or "").strip())
        host = (u.hostname or "").removeprefix("www.")
    except ValueError:
        return "", url or ""
    return host, u.path.rstrip("/") + (f"?{u.query}" if u.query else "")


def shared_lines(paths: list[tuple[str, str]], lines: list[list[int]], places: list[list[int]], i: int,
                 common: list[int]) -> tuple[list[int], int]:
    """Places of page i's open lines that its nearest neighbour in URL order shares, and how many lines outside main it shares
    at all. ``lines``: every page's lines outside main, all of which are aligned; ``places``: where an open one stands among the
    page's kept lines, -1 for a frame's (those go anyway). For pairs whose open lines agree almost everywhere, ``common``: the
    places of lines common to the host."""
    best = None
    for j in (i - 1, i + 1):
        if 0 <= j < len(paths) and paths[j][0] == paths[i][0] and paths[i][0]:
            n = 0
            for x, y in zip(paths[i][1], paths[j][1], strict=False):
                if x != y:
                    break
                n += 1
            if best is None or n > best[0]:
                best = (n, j)
    if best is None:
        return [], 0
    a, b = lines[i], lines[best[1]]
    aligned = common_lines(a, b)
    found = [places[i][x] for x in aligned if places[i][x] >= 0]
    opens = max(sum(x >= 0 for x in places[i]), sum(x >= 0 for x in places[best[1]]))
    return list(common) if found and len(found) >= COPY_SHARE * opens else found, len(aligned)


def _host_lines(pages: DataFrame) -> DataFrame:
    """(host, common): hashes of the lines that at least ``HOST_SHARE`` of the host's different pages have."""
    longest = F.aggregate(F.arrays_zip("sizes", "lines"), F.struct(F.lit(0).alias("sizes"), F.lit(0).cast("long").alias("lines")),
                          lambda a, b: F.greatest(a, b))["lines"]
    told = pages.select("host", "lines", longest.alias("longest"))
    hosts = told.select("host", "longest").distinct().groupBy("host").agg(F.count("*").alias("pages")).where(F.col("pages") >= HOST_PAGES)
    counts = told.select("host", "longest", F.explode("lines").alias("line")).distinct().groupBy("host", "line").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= HOST_PAGES).join(hosts, "host").where(F.col("n") >= F.col("pages") * HOST_SHARE).groupBy("host").agg(
        F.collect_list("line").alias("common"))


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars, n_open, n_deleted, n_shared`` (open lines, lines deleted from main and
    open ones, and lines outside main that the nearest page shares, frames included).

    Character references are decoded, white space inside a block is one space, blocks are joined by one newline in page
    order. Null or empty html gives an empty text; a null or broken url has no host, so nothing of its page is deleted by
    differencing; broken or unclosed markup is read as far as it goes; null ids and repeated rows are rows like
    any other (rows that repeat id, url and html are settled alike); an empty table gives no rows. Other columns are ignored.
    """
    spark = pages.sparkSession
    ship_package(spark)
    text_batches(spark)
    keyed = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    keyed = keyed.withColumn("k", F.xxhash64("page_id", "url", "html"))

    def outline(frames):
        import pandas as pd

        for f in frames:
            out = []
            for k, url, page in zip(f["k"], f["url"], f["html"], strict=True):
                host, path = split_url(url) if isinstance(url, str) else ("", "")
                found = all_blocks(page if isinstance(page, str) else None) if host else []
                kept = [(r, t) for r, t in found if r != "frame"]
                if found:
                    place = itertools.count()  # of the kept lines; -1 for a frame's
                    told = [(-1 if r == "frame" else next(place), r, t) for r, t in found]
                    out.append((k, host, path, _hash([t for _, t in kept]), [len(t) for _, t in kept],
                                [i for i, (r, _) in enumerate(kept) if r == "open"],
                                _hash([t for _, r, t in told if r != "main"]), [i for i, r, _ in told if r != "main"]))
            yield pd.DataFrame(out, columns=["k", "host", "path", "lines", "sizes", "open", "outer", "places"]).astype({"k": "int64"})

    narrow = write_once(keyed.select("k", "url", "html").mapInPandas(
        outline, "k long, host string, path string, lines array<long>, sizes array<int>, open array<int>, outer array<long>, "
                 "places array<int>").dropDuplicates(["k"]), "page-lines")
    at = F.when(F.size("lines") > 0, F.sequence(F.lit(0), F.size("lines") - 1)).otherwise(F.array().cast("array<int>"))
    everywhere = F.coalesce(F.filter(at, lambda i: F.array_contains("common", F.get("lines", i))), F.array().cast("array<int>"))
    size = lambda places: F.aggregate(places, F.lit(0).cast("long"), lambda n, i: n + F.get("sizes", i))
    # a host's pages meet its lines in DEALS tasks
    common = _host_lines(narrow).withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(DEALS - 1))))
    narrow = narrow.withColumn("deal", F.pmod("k", F.lit(DEALS)).cast("int")).join(common, ["host", "deal"], "left").withColumn(
        "everywhere", everywhere)
    narrow = narrow.withColumn("everywhere", F.when(
        size(F.array_except(at, "everywhere")) >= size(at) * OWN_SHARE, F.col("everywhere")).otherwise(F.array().cast("array<int>")))
    narrow = write_once(narrow.select("k", "host", "path", "outer", "places",
                                      F.array_intersect("open", "everywhere").alias("common"),
                                      F.array_except("everywhere", "open").alias("inside")), "host-lines")
    inside = narrow.where("size(inside) > 0").select("k", F.col("inside").alias("gone"), F.lit(0).alias("shared"))
    narrow = narrow.where("size(outer) > 0").drop("inside")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = write_once(
        narrow.repartitionByRange(parts, "host", "path", "k").sortWithinPartitions("host", "path", "k")
        .withColumn("part", F.spark_partition_id())
        .withColumn("at", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)), "url-order")
    offset, starts = 0, []
    for r in sorted_.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect():
        starts.append((r["part"], offset))
        offset += r["n"]
    numbered = sorted_.join(F.broadcast(spark.createDataFrame(starts, "part int, start long")), "part").withColumn(
        "place", F.col("start") + F.col("at")).drop("part", "at", "start")
    chunk = F.floor(F.col("place") / CHUNK)
    dealt = numbered.withColumn("chunk", F.explode(F.array_distinct(F.array(
        chunk, F.floor((F.col("place") - 1) / CHUNK), F.floor((F.col("place") + 1) / CHUNK))))).where("chunk >= 0")

    def compare(key, f):
        import pandas as pd

        f = f.sort_values("place", ignore_index=True)
        paths = list(zip(f["host"], f["path"], strict=True))
        lines, places = [list(x) for x in f["outer"]], [list(x) for x in f["places"]]
        out = []
        for i, (k, place, common) in enumerate(zip(f["k"], f["place"], f["common"], strict=True)):
            if place // CHUNK == key[0]:
                found, shared = shared_lines(paths, lines, places, i, list(common))
                if shared:
                    out.append((k, found, shared))
        return pd.DataFrame(out, columns=["k", "gone", "shared"]).astype({"k": "int64", "shared": "int32"})

    gone = dealt.groupBy("chunk").applyInPandas(compare, "k long, gone array<int>, shared int").unionAll(inside)
    gone = gone.groupBy("k").agg(F.array_distinct(F.flatten(F.collect_set("gone"))).alias("gone"), F.max("shared").alias("shared"))
    gone = write_once(gone, "shared-lines")

    def texts(frames):
        import pandas as pd

        for f in frames:
            text, opens, deleted = [], [], []
            for page, drop in zip(f["html"], f["gone"], strict=True):
                drop = set() if drop is None else set(drop)
                lines, n = [], 0
                for i, (r, t) in enumerate(blocks(page if isinstance(page, str) else None)):
                    n += r == "open"
                    if i not in drop:
                        lines.append(t)
                text.append("\n".join(lines))
                opens.append(n)
                deleted.append(len(drop))
            yield pd.DataFrame({"page_id": f["page_id"], "url": f["url"], "text": text, "n_open": opens, "n_deleted": deleted,
                                "n_shared": f["shared"].fillna(0).astype("int64")})

    pages_ = keyed.withColumn("page_id", F.col("page_id").cast("string"))  # pandas has no null integers
    out = pages_.join(gone, "k", "left").select("page_id", "url", "html", "gone", "shared").mapInPandas(
        texts, "page_id string, url string, text string, n_open long, n_deleted long, n_shared long")
    return out.select(F.col("page_id").cast("long").alias("page_id"), "url", "text",
                      F.length("text").cast("long").alias("n_chars"), "n_open", "n_deleted", "n_shared")
