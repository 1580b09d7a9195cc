import re
import time
from html.parser import HTMLParser

import numpy as np
import pytest

from lexiflow.llm import html_extract as H
from lexiflow.llm.html_extract import main_text, report

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>x";</script></head>
<body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href=x>Home</a></li></ul></nav>
<div id="cookie-notice">We use cookies, really. Accept them.</div><div class="ad">Buy this, now. It is good.</div>
<div class="wrap"><div class="c1"><h2>Big &amp; news</h2><p>It was a <b>dark</b> night,
  and the rain&nbsp;fell. Nobody came, not even the cat.</p><p>No.</p><!-- <p>hidden, text.</p> -->
<ul><li>First, one.<li>Two</ul><p>A paragraph with a <a href=q>link</a>, and more text. It goes on, for a while.
</div><div class="side"><ul><li><a href=1>One</a></li><li><a href=2>Two</a></li></ul></div></div>
<section class="comments"><p>Great article, thanks. I liked it, a lot.</p></section><aside>See also, this. And that.
</aside><form><p>Name, please. <input name=x></p></form><footer>(c) me, you, all. Rights, reserved.</footer></body>"""


def test_article_only():
    assert main_text(PAGE) == "\n\n".join([
        "Big & news", "It was a dark night, and the rain fell. Nobody came, not even the cat.", "No.", "First, one.",
        "Two", "A paragraph with a link, and more text. It goes on, for a while."])


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("   ", ""), ("plain < text & more", "plain < text & more"), ("<!-- open", ""),
    ("<script>alert(1)", ""), ("<p>a<b>c</p><p>d", "ac\n\nd"), ("<p>x<br>y</p>", "x y"), ("<footer>only</footer>", ""),
    ("<p title='a>b'>q</p>", "q"), ("<p class=\"x>never closed</p>", "never closed"), ("</div></p>t", "t"),
    ("<p>&lt;b&gt; &#233;&eacute;</p>", "<b> éé")])
def test_broken_and_small_pages(html, text):
    assert main_text(html) == text


def test_marked_article_is_kept_whole():
    page = ("<main><article><h1>T</h1><p>A long text, with marks. And more of it, too.</p><p><a href=x>Only a link</a></p>"
            "<div class='related'>Other, things.</div><p>x</p></article></main><div><p>Beside, of it. Again, so.</p></div>")
    assert main_text(page) == "T\n\nA long text, with marks. And more of it, too.\n\nOnly a link\n\nx"


def test_deep_and_long_pages():
    assert main_text("<div>" * 3000 + "<p>Deep, text.</p>") == "Deep, text."
    long = " ".join(f"word{i}," for i in range(60000))
    assert main_text(f"<nav>menu</nav><article><p>{long}</p></article>") == long


def test_report(spark):
    rows = [(1, "u", PAGE, 0), (1, "u", PAGE, 0), (2, None, None, 1), (None, "v", "", 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = report(pages).collect()
    assert len(got) == 4 and {r.n_chars for r in got} == {len(main_text(PAGE)), 0}
    assert report(pages.limit(0)).collect() == []


def test_articles_of_the_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in report(pages).join(pages.select("page_id", "html"), "page_id").collect():
        inside = r.html.split("<article>")[1].split("</article>")[0]
        assert r.n_chars == len(r.text) and "\n\n".join(r.text.split("\n\n")) == r.text
        assert len(r.text) <= len(inside) and r.text.split("\n\n")[0].split(" ")[0] in inside


class Plain(HTMLParser):
    """(path of tag names, text, announced as something else) of each visible text of a well-formed page."""

    def __init__(self):
        super().__init__()
        self.open, self.found = [], []

    def handle_starttag(self, tag, attrs):
        if tag in H.BLOCK and "p" in [t for t, _ in self.open]:  # the tables' pages leave <p> open
            self.handle_endtag("p")
        if tag not in H.VOID:
            self.open.append((tag, tag in H.OUTSIDE or any(k == "class" and v == "ad" for k, v in attrs)))

    def handle_endtag(self, tag):
        if tag in [t for t, _ in self.open]:  # and <b>
            while self.open.pop()[0] != tag:
                pass

    def handle_data(self, data):
        if not any(t in H.HIDDEN for t, _ in self.open) and data.strip():
            self.found.append((tuple(t for t, _ in self.open), data, any(o for _, o in self.open)))


def scored(html):
    """Each visible text with its score and the threshold, by loops over paths."""
    p = Plain()
    p.feed(html)
    fused = {}
    for count in (lambda t: len(t.strip()), lambda t: len(re.findall(r"[.,;:!?。、，；：！？…]", t))):
        mean = {path: np.mean([count(t) for q, t, _ in p.found if q == path]) for path, _, _ in p.found}
        row = [mean[path] for path, _, _ in p.found]
        smooth = [0.25 * row[max(i - 1, 0)] + 0.5 * row[i] + 0.25 * row[min(i + 1, len(row) - 1)] for i in range(len(row))]
        for path in mean:
            fused.setdefault(path, []).append(np.mean([s for s, (q, _, _) in zip(smooth, p.found) if q == path]))
    score = [fused[q][0] * (1 + fused[q][1]) * (H.BELIEF if o else 1) for q, _, o in p.found]
    plain = [(s, len(t)) for s, (_, t, o) in zip(score, p.found) if not o]
    least = H.LEAST_RATIO * np.average([s for s, _ in plain], weights=[n for _, n in plain])
    return [(t, o, s, least) for (_, t, o), s in zip(p.found, score)]


def test_ratios_of_table_pages_equal_loops(spark):
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").limit(60).collect()]
    for html in pages:
        expect = scored(html)
        page = H.read_page(html)
        at = np.array(page.element)
        shown = [i for i, t in enumerate(page.text) if t.strip() and not (at[i] >= 0 and page.hidden[at[i]])]
        texts = [page.text[i] for i in shown]
        assert texts == [t for t, _, _, _ in expect]
        ratio = H.path_ratios(np.array(page.path)[shown], np.array([len(t.strip()) for t in texts], float),
                              np.array([len(H.MARKS.findall(t)) for t in texts], float))
        outside = np.array(page.outside())[at[shown]]
        assert outside.tolist() == [o for _, o, _, _ in expect]
        assert np.allclose(np.where(outside, H.BELIEF, 1) * ratio, [s for _, _, s, _ in expect])
        # every node over the threshold is in the result, none of those announced as something else is
        got = main_text(html)
        for text, o, s, least in expect:
            line = " ".join(text.split())
            assert (line in got) if s >= least else (not o or line not in got.split("\n\n"))


def test_the_threshold_decides(spark, monkeypatch):
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").limit(80).collect()]
    before = [main_text(p) for p in pages]
    monkeypatch.setattr(H, "LEAST_RATIO", 0.0)
    assert sum(main_text(p) != b for p, b in zip(pages, before)) > 70
    monkeypatch.setattr(H, "LEAST_RATIO", 1e9)
    assert all(main_text(p) == "" for p in pages)
    monkeypatch.setattr(H, "LEAST_RATIO", 0.3)
    monkeypatch.setattr(H, "OUTSIDE_WORDS", frozenset())
    assert all(set(b.split("\n\n")) <= set(main_text(p).split("\n\n")) for p, b in zip(pages, before))


LONG = "It was a long day, and nobody came. The rain fell, as it does, on all of them. " * 8


@pytest.mark.parametrize("page, text", [
    ("<nav><a>Home</a></nav><footer>only</footer>", ""),
    ("<div class='cookie-notice'>We use cookies, really.</div><form>Name, please.</form>", ""),
    (f"<div class='main-with-sidebar'><article><p>{LONG}</p></article></div><nav>Home</nav>", LONG.strip()),
    (f"<article><p>{LONG}</p><p class='notice-board-story'>{LONG}</p><p class='ad'>Buy, now. Do it.</p></article>",
     LONG.strip() + "\n\n" + LONG.strip()),
    (f"<div class='sidebar'><article><p>{LONG}</p></article></div><p>Home</p>", LONG.strip()),
    (f"<main><p>{LONG}</p></main><div><p>{LONG}</p></div>", LONG.strip() + "\n\n" + LONG.strip()),
    (f"<article><p>Short, it is.</p></article><section class='comments'><p>{LONG}</p></section>", "Short, it is.")])
def test_what_is_and_is_not_the_article(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("piece", ["<div>word", "<b>word", "<p><b>", "<li><b>x", "<div></div><b>", "</div>", "<ul><li>x", "<td>x",
                                   "<option>x", "<main><p>x, y.", "<b></i>", "<dl><dt>x<dd>"])
def test_time_is_linear_in_hostile_pages(piece):
    start = time.perf_counter()
    main_text(piece * 100_000 + "<p>end, of it.")
    assert time.perf_counter() - start < 15
