"""Operator 3: the generated pages against a parser of its own, hand-written pages, and the alignment by brute force."""

import random
from html.parser import HTMLParser

import pytest

from storelens.llm import html_text, queries

SF = "/root/testdata/sf0.001"


class Plain(HTMLParser):
    """Text of the article's blocks, for the generated pages (no nesting tricks there)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.lines = False, [""]

    def handle_starttag(self, tag, attrs):
        self.inside = self.inside or tag == "article"
        self.lines.append("") if tag in ("h1", "p", "article") else self.handle_data(" ") if tag == "br" else None

    def handle_endtag(self, tag):
        self.inside = self.inside and tag != "article"
        self.lines.append("") if tag in ("h1", "p", "article") else None

    def handle_data(self, data):
        if self.inside:
            self.lines[-1] += data


def test_generated_pages(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = {r.page_id: r for r in queries.op3_page_text(spark, SF).collect()}
    assert len(got) == len(rows)
    for r in rows:
        p = Plain()
        p.feed(r.html)
        p.close()
        want = "\n".join(x for x in (" ".join(t.split()) for t in p.lines) if x)
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want) > 0


def test_blocks_by_hand():
    page = """<html><head><title>t</title><script>if (a<b) "</p>"</script></head><body><div class="site-header">menu</div>
      <main><h1>A &amp; B</h1><p>one<br>two &lt;3 <b>bold</b>text<aside>side</aside>more<p title='a > b'>x < y &nbsp; z<!-- <p>no</p> -->
      <ul><li>i<li>j</ul><form>f</form><div role="navigation">n</div><div style="display: none">h</div></main>
      <div id="comments"><p>c</p></div><footer>f</footer>tail"""
    assert [t for _, t in html_text.blocks(page)] == ["A & B", "one two <3 boldtext", "more", "x < y z", "i", "j", "tail"]
    assert html_text.blocks(None) == [] and html_text.blocks("") == [] and html_text.blocks("plain") == [("open", "plain")]
    assert html_text.blocks("<p>cut <b") == [("open", "cut <b")]
    assert html_text.blocks("<div " + "a='" * 20_000) and html_text.blocks("<p>" * 50_000 + "x") == [("open", "x")]


@pytest.mark.parametrize("page,want", [
    ('<div class="layout has-sidebar"><article><p>a</p></article><div class="sidebar">s</div></div>', ["a"]),
    ('<div class="layout has-sidebar"><p>a</p></div>', ["a"]),
    ('<div class="sidebar"><article>a</article></div><footer>f</footer>', ["a"]),
    ('<div class="header"><main>a</main></div>', ["a"]),
    ('<article>a</article><div class="sidebar"><article>teaser</article></div>', ["a"]),
    ('<div class="comments"><article>c</article></div><p>a</p>', ["a"]),
    ('<form id="aspnetForm" method=post><div class="menu">m</div><main>a</main></form>', ["a"]),
    ('<form id="aspnetForm"><nav>m</nav><p>a</p><p>b</p></form>', ["a", "b"]),
    ('<p>a</p><form><p>your name</p></form>', ["a"]),
    ('<p title="the hidden city">a</p><div data-hidden="false">b</div><p data-class="menu">c</p>', ["a", "b", "c"]),
    ('<p hidden>a</p><div class=menu>b</div><div id="site-header">c</div><p data-x="role=main" class="x">d</p>', ["d"]),
])
def test_frames_by_whole_attributes(page, want):
    assert [t for _, t in html_text.blocks(page)] == want


@pytest.mark.parametrize("piece", ["<a ", "<a ='", "<a ='>'", "<b>x</i>", "<a<", "<!-", "<p a=\"", "</", "<a b=c ", "&lt", "<div><p>", "< a=>"])
def test_hostile_markup_takes_linear_time(piece):
    import time
    page = piece * (1_000_000 // len(piece))
    for tail in ("", ">", "'>", "</article>"):
        began = time.process_time()
        html_text.blocks(page + tail)
        assert time.process_time() - began < 12, (piece, tail)


TAG = __import__("re").compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|</?([a-zA-Z][^\s/>]*)"
                               r"((?:[^>=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=)*+)>", __import__("re").S)


def test_tags_against_one_expression():
    rng = random.Random(11)
    for _ in range(4000):
        page = "".join(rng.choices(["<", ">", "a", "/", "=", "'", '"', " ", "!", "--", "<p", "</p>", "<a b='", "\n", "<!--", "-->", "<![CDATA[", "]]>", "?"], k=rng.randrange(25)))
        tags, at, got = html_text.Tags(page), 0, []
        while (t := tags.next(at))[0] < len(page):
            got.append(t)
            at = t[1]
        want = [(m.start(), m.end(), (m[1] or "").lower(), m[2] or "") for m in TAG.finditer(page)]
        assert got == want, page


def test_without_article_marks_the_article_stays(spark):
    """The given pages without article elements, classes, ids and roles. Their menus and notices are made of words drawn page by
    page, so few lines repeat on the nearest page; what differencing takes there must not be the article's."""
    import re
    from collections import Counter
    rows = [(r.page_id, r.url, re.sub(r"</?(?:article|main|nav|header|footer|aside|section)\b", lambda m: ("</div" if "/" in m[0] else "<div"),
             re.sub(r"\s(?:class|id|role)=(?:\"[^\"]*\"|'[^']*'|[^\s>]+)", "", r.html))) for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    truth = {r.page_id: Counter(r.text.split("\n")) for r in queries.op3_page_text(spark, "/root/testdata/sf0.01").collect()}
    got = html_text.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    kept = sum((Counter(r.text.split("\n")) & truth[r.page_id]).total() for r in got)
    assert kept >= 0.99 * sum(c.total() for c in truth.values()) and sum(r.n_deleted for r in got) > 0


def test_repeated_url_with_other_html(spark):
    rows = [(1, "http://h.example.com/a", "<p>one</p><p>two</p><p>three</p><p>four</p>"), (1, "http://h.example.com/a", "<p>one</p><p>two</p><p>five</p><p>six</p>")]
    got = sorted(r.text for r in html_text.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect())
    assert got == ["five\nsix", "three\nfour"]


def brute_lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


@pytest.mark.parametrize("limit", [1 << 28, 8])
def test_alignment(limit, monkeypatch):
    rng = random.Random(3)
    plain = html_text._lcs
    monkeypatch.setattr(html_text, "_lcs", lambda a, b, n=limit: plain(a, b, limit))
    for _ in range(400):
        a, b = ([rng.randrange(rng.choice((2, 6))) for _ in range(rng.randrange(14))] for _ in range(2))
        found = html_text.common_lines(a, b)
        rest = iter(b)
        assert found == sorted(set(found)) and len(found) == brute_lcs(a, b) and all(a[i] in rest for i in found)


def template(i, host="news.example.com", path=None):
    body = f"<p>Story {i} line one.</p><p>Story {i} line two.</p><div>Shared sentence {i % 2 + 5}.</div><p>Story {i} end.</p>"
    return (i, f"https://{host}{path or f'/a/{i:03d}'}", f"<body><div>Top of site</div><p>Today's links</p>{body}<div>All about us</div></body>")


def test_differencing(spark, monkeypatch):
    monkeypatch.setattr(html_text, "CHUNK", 4)
    rows = [template(i) for i in range(23)]
    rows += [(100, "http://one.example.com/x", "<p>alone</p>"), (101, None, "<p>no url</p>"), (102, "http://[bad", "<p>bad url</p>"),
             (103, "http://e.example.com/", None), (104, "http://e.example.com/a", ""), (None, "http://e.example.com/b", "<p>null id</p>")]
    copies = [(i, f"http://copy.example.org/p?ref={i}", "<p>same one</p><p>same two</p><p>same three</p>") for i in range(110, 113)]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows + copies + copies[:1]], "page_id long, url string, html string, text string, k int")
    got = html_text.extract_text(pages).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == len(rows) + 4
    for i in range(23):
        want = ["Story %d line one." % i, "Story %d line two." % i, f"Shared sentence {i % 2 + 5}.", "Story %d end." % i]
        assert by[i].text.split("\n") == want and by[i].n_deleted == 3, by[i]
    assert by[100].text == "alone" and by[101].text == "no url" and by[102].text == "bad url" and by[103].text == by[104].text == ""
    assert by[None].text == "null id" and by[111].text == "same one\nsame two\nsame three"
    assert html_text.extract_text(pages.limit(0)).count() == 0


def test_host_decides_where_pairs_agree(spark):
    """Much template and little text, copies beside other pages, a notice inside articles; near copies alone keep their text."""
    menu = "".join(f"<div>Menu entry {j}</div>" for j in range(20))
    own = [[f"Story {i} tells its own tale number {j}, and it does so at some length." for j in range(4)] for i in range(9)]
    rows = [(i, f"http://a.example.com/s/{i}", menu + "".join(f"<p>{t}</p>" for t in own[i])) for i in range(9)]
    rows += [(20 + i, f"http://a.example.com/s/4?ref={i}", rows[4][2]) for i in range(6)]
    rows += [(40 + i, f"http://b.example.com/{i}", f"<article><p>{own[i][0]}</p><p>Sign up today</p><p>{own[i][1]}</p></article>") for i in range(5)]
    story = "".join(f"<p>The one story of this host, told in its line {j} at some length.</p>" for j in range(30))
    rows += [(60 + i, f"http://c.example.com/{i}", f"{story}<p>No. {i}</p>") for i in range(5)]
    by = {r.page_id: r.text.split("\n") for r in html_text.extract_text(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(by[i] == own[i] for i in range(9)) and all(by[20 + i] == own[4] for i in range(6))
    assert all(by[40 + i] == own[i][:2] for i in range(5))
    assert all(len(by[60 + i]) == 31 for i in range(5))
