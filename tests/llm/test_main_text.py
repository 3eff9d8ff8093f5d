import re
from html import unescape

import duckdb
import pytest

from tideload.llm.main_text import extract_text, main_lines

LONG = "A paragraph of the article that goes on for a while, with commas, and with more than one clause in it."
MORE = "Another one follows, of about the same length, so that the window sums stay well above the surge height."
PAGES = "page_id long, url string, html string"


def marked(article: str, around: str = "") -> str:
    return (
        f"<!doctype html><html><head><title>T</title><style>p{{}}</style></head><body>{around}<nav><ul><li><a href='/'>Home</a></li></ul></nav>"
        f"<article>{article}</article><footer>&copy; 2024 All rights</footer></body></html>"
    )


CASES = {
    "null": (None, []),
    "empty": ("", []),
    "plain text": ("just  a\nline", ["just a line"]),
    "short article": (marked("<h1>Title</h1><p>One.</p><p>Two.</p>"), ["Title", "One.", "Two."]),
    "short last line": (marked(f"<h1>Title</h1><p>{LONG}</p><p>{MORE}</p><p>End.</p>"), ["Title", LONG, MORE, "End."]),
    "unclosed tags": (marked(f"<p><b>{LONG}<br><p>{MORE}"), [LONG, MORE]),
    "advert inside": (
        marked(f"<p>{LONG}</p><div class='ad-slot'><p>{MORE}</p></div><aside>{MORE}</aside><p>End.</p>"), [LONG, "End."]),
    "references": (marked("<p>a &amp; b &lt;p&gt; &eacute;&#233;&#xe9; &amp;amp; &amp x&nbsp;y</p>"), ["a & b <p> ééé &amp; & x y"]),
    "broken reference": (marked("<p>cut &am</p>"), ["cut &am"]),
    "white space": (marked("<p> a\t b\r\n\fc <i> d</i>e</p>"), ["a b c de"]),
    "line break": (marked("<p>a<br>b</p><p>c<br><br>d</p>"), ["a b", "c", "d"]),
    "scripts": (marked("<p>a</p><script>if (1 < 2) document.write('<p>x</p>')</script><style>p{}</style><!-- <p>no</p> --><p>b</p>"), ["a", "b"]),
    "unclosed comment": ("<article><p>a</p><!-- <p>b</p></article>", ["a"]),
    "unclosed script": ("<article><p>a</p><script>var t = '<p>b</p>'", ["a"]),
    "quoted >": (marked("<p title='a > b'>x</p><a href=\"?a>b\">y</a>"), ["x", "y"]),
    "stray signs": (marked("<p>1 < 2 and 3 > 2</p>"), ["1 < 2 and 3 > 2"]),
    "list": (marked(f"<p>{LONG}</p><ul><li>one</li><li>two<li>three</ul><p>End.</p>"), [LONG, "one", "two", "three", "End."]),
    "links": (marked(f"<p>{LONG}</p><p><a href='x'>source</a></p>"), [LONG, "source"]),
    "form": (marked(f"<p>{LONG}</p><form><p>{MORE}</p><label>Mail</label><input><button>Send</button></form><p>End.</p>"), [LONG, "End."]),
    "page in a form": (f"<form id='f'>{marked(f'<p>{LONG}</p>')}</form>", [LONG]),
    "header of the article": (marked(f"<header><h1>Title</h1><span>By A</span></header><p>{LONG}</p><footer>tags</footer>"), ["Title", LONG]),
    "cookie notice": (marked(f"<p>{LONG}</p>", f"<div id='cookie-notice' class='x'>{MORE} {MORE}</div>"), [LONG]),
    "comments": (
        marked(f"<p>{LONG}</p><section class='comments'><article class='comment'><p>{MORE}</p></article></section>"), [LONG]),
    "comments below a heading": (f"<body><div><h1>Title</h1><p>{LONG}</p><h2>Comments (2)</h2><p>{MORE}</p></div></body>", ["Title", LONG]),
    "comment articles": (f"<main><article><p>{LONG}</p></article><div id='comments'><article>{MORE}</article></div></main>", [LONG]),
    "main part": (f"<div>{MORE}</div><main><h1>Title</h1><section><p>{LONG}</p></section><section><p>s</p></section></main>", ["Title", LONG, "s"]),
    "headline before": (f"<main><h1>Title</h1><article><p>{LONG}</p></article></main>", ["Title", LONG]),
    "no marks": (
        "<body><div><a href='1'>Home</a> <a href='2'>News</a></div><div><div><h1>Title</h1></div>"
        f"<p>{LONG}</p><p>{MORE}</p><p>End.</p></div><div><div><div><a href='x'>imprint</a></div></div></div></body>", ["Title", LONG, MORE, "End."]),
    "names": (
        f"<body class='has-sidebar'><div class='page with-comments'><div class='top-menu'>{MORE}</div><div class='content'><p>{LONG}</p></div>"
        f"<div id='leftSidebar'><p>{MORE}</p></div></div><div class='post-comments'>{MORE}</div></body>", [LONG]),
    "hidden": (marked(f"<p>{LONG}</p><p hidden>no</p><div style='display: none'>no</div><p class='overflow'>yes</p>"), [LONG, "yes"]),
    "teasers": (f"<article><p>{LONG} {MORE}</p><p>{LONG}</p><p>{MORE}</p></article><article><p>Short.</p></article>", [f"{LONG} {MORE}", LONG, MORE]),
    "only links": ("<ul><li><a href='1'>one</a></li><li><a href='2'>two</a></li></ul>", []),
}


@pytest.mark.parametrize("name", CASES)
def test_lines(name):
    html, want = CASES[name]
    assert main_lines(html or "") == want


def test_every_way_of_cutting_a_page_ends():
    page = marked(f"<p title=\"q'>{LONG}</p><!-- x --><script>1</script><p>&amp;</p>")
    for end in range(len(page)):
        main_lines(page[:end])


def test_very_long_page_and_odd_signs():
    page = marked("".join(f"<p>{LONG} {i}</p>" for i in range(20_000)))
    assert len(main_lines(page)) == 20_000
    assert main_lines("<article><p>" + "<" * 50_000 + "</p></article>")
    assert main_lines("<article><p>x</p>" + "<!-- " * 50_000) == ["x"]
    assert main_lines("<div>" * 20_000 + LONG) == [LONG]


def test_columns_nulls_and_repeated_rows(spark):
    rows = [(1, "u", marked("<p>x</p>"), "old", 1.5), (1, "u", marked("<p>x</p>"), "old", 1.5), (None, None, None, None, None)]
    out = extract_text(spark.createDataFrame(rows, PAGES + ", text string, `a.b` double"))
    assert out.columns == ["page_id", "url", "html", "a.b", "text", "n_chars"]
    assert sorted(((r.page_id, r.text, r.n_chars) for r in out.collect()), key=str) == [(1, "x", 1), (1, "x", 1), (None, "", 0)]
    assert extract_text(spark.createDataFrame([], PAGES)).collect() == []


def test_given_pages():
    """The blocks of the one article that the given pages have, cut out plainly."""
    for html, in duckdb.sql("SELECT html FROM '/root/testdata/sf0.001/pages.parquet'").fetchall():
        article = re.search("<article>(.*)</article>", html, re.DOTALL)[1]
        blocks = [re.sub("</?b>", "", b).replace("<br>", " ") for b in re.split("</?(?:p|h1)>", article)]
        assert main_lines(html) == [text for b in blocks if (text := " ".join(unescape(b).split()))]
