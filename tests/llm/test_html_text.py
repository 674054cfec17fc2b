"""Main text of pages."""

import html
import re
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tallyhall.llm import html_text

LONG = "This paragraph is long enough to look like the text of an article, and it goes on for a while."


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""),
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>one<p>two &eacute;&#33;", "one two é!"),
        ("<nav>menu</nav>", ""),
        (f"<nav><a>a</a></nav><article><h1>T</h1><p><b>bold</b>xy<p>{LONG}</p></article><footer>f</footer>", f"T boldxy {LONG}"),
        (f"<div id=cookieNotice>{LONG}</div><div class=content><p>{LONG}</p><p>Short.</p></div><div class='user-comments'><p>{LONG}</p></div>", f"{LONG} Short."),
        (f"<body>{LONG}<script>var a='</p>'+1;</script><style>p{{}}</style><form><p>{LONG}</p></form></body>", LONG),
        (f"<article class='no-sidebar'><p>{LONG}</p></article><aside><article>{LONG} Related.</article></aside>", LONG),
        (f"<aside><p>never closed<article><p>{LONG}</p></article>", LONG),
        (f"<main>\n <p>{LONG}</p>\n<ul><li>one<li>two</ul><div class='ad'>buy</div></main>", f"{LONG} one two"),
    ],
)
def test_pages(page, want):
    assert html_text.main_text(page) == want


def test_chunks_do_not_matter(monkeypatch):
    page = f"<article><p>{LONG} &amp; caf&eacute; &#x1F642;</p><p>{LONG}</p></article><div class=comments>{LONG}</div>"
    whole = html_text.main_text(page)
    assert "& café 🙂" in whole and whole.count(LONG) == 2
    for size in (1, 3, 7):
        monkeypatch.setattr(html_text, "CHUNK", size)
        assert html_text.main_text(page) == whole


def test_very_long_and_broken_pages():
    page = "<article>" + f"<p>{LONG}</p>" * 3000 + "</article>" + "<div>" * 2000 + "<footer>x"
    assert html_text.main_text(page) == " ".join([LONG] * 3000)
    assert html_text.main_text("<" * 50 + "p>x") is not None


def test_rows(spark):
    rows = [(1, "u", f"<p>{LONG}</p>"), (1, "u", f"<p>{LONG}</p>"), (None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = html_text.extract(pages).collect()
    assert [(r.page_id, r.text, r.n_chars) for r in got] == [(1, LONG, len(LONG))] * 2 + [(None, "", 0)]
    assert html_text.extract(pages.limit(0)).count() == 0


def test_sections_without_article():
    """Nothing inside the smallest container around the clustered text is dropped but boilerplate."""
    long, short = " ".join([LONG] * 20), " ".join([LONG] * 3)
    page = f"<div class=content><section><p>{long}</p></section><section><p>{short}</p></section></div>"
    assert html_text.main_text(page) == f"{long} {short}"
    blocks = f"<div><h2>Title</h2></div><div>{long}</div><div>Short one.</div><div>{short}</div>"
    page = f"<body><nav>menu</nav><div>{blocks}<div class=comments>{LONG}</div></div><footer>f</footer></body>"
    assert html_text.main_text(page) == f"Title {long} Short one. {short}"
    deep = f"<div><section><div>{long}</div></section><div><div>{short}</div><section>x</section></div></div>"
    assert html_text.main_text(deep) == f"{long} {short} x"
    assert html_text.main_text(f"{long}<div>{short}</div>") == f"{long} {short}"


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (f"<nav>menu</nav><article class='social-policy'><h1>T</h1><p>{LONG}</p></article><p>stray</p>", f"T {LONG}"),
        (f"<article class='comment-free'><p>{LONG}</p></article>", LONG),
        (f"<header>h</header><main id='widget-review'><p>{LONG}</p></main>", LONG),
        (f"<div class='sidebar-less'><p>{LONG}</p></div><footer>f</footer>", LONG),
        (f"<article><p>{LONG} {LONG}</p></article><div>x</div><article><p>Short one.</p></article>", f"{LONG} {LONG} Short one."),
        (f"<article><p>{LONG}</p></article><article><a href=x>teaser of links</a></article>", LONG),
        (f"<article><p>{LONG}</p></article><div id=comments><article class=comment><p>{LONG} {LONG}</p></article></div>", LONG),
        ("<p>one<br>two<hr>three<wbr>four</p>", "one two threefour"),
        ("<div class=menu><a href=x>only links here</a></div>", ""),
    ],
)
def test_marks_yield_to_text(page, want):
    assert html_text.main_text(page) == want


@pytest.mark.parametrize("part", ["<div>x", "<p><b>x", "<div></i>x", "<li>x", "<article>x", "<div class=ad>x", "<option>x<div>"])
def test_a_megabyte_of_unclosed_tags(part):
    start = time.process_time()
    html_text.main_text(part * (1_000_000 // len(part)))
    assert time.process_time() - start < 30


def test_every_page_gives_its_article():
    """The driver's pages hold one article each: its text without markup, found by patterns."""
    blocks = "article|h[1-6]|p|div|ul|ol|li|table|tr|td|th|section|blockquote|pre|br|figure|figcaption"
    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet").column("html").to_pylist()
    held = [h for h in pages if h and h.count("<article") == 1]
    assert len(held) > 0.9 * len(pages)
    for h in held:
        body = re.search(r"<article[^>]*>(.*?)(</article>|$)", h, re.S)[1]
        body = re.sub(r"<!--.*?-->|<(script|style|aside|form|nav)\b.*?</\1>", " ", body, flags=re.S)
        body = re.sub(rf"</?({blocks})\b[^>]*>", " ", body)
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", "", body)).split())
        assert html_text.main_text(h) == want
