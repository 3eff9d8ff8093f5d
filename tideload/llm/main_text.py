"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one for each block of text, with blank lines where containers begin
or end. Lengths are summed over sliding windows of ``WINDOW`` lines: a run of lines begins at the
surge where the sums leave zero and ends at the dive where they fall back to it. Runs whose sums
reach the surge height, and that hold a fair share of the longest run's text, are kept whole, so
that short lines between their ends stay.

What a line weighs: the code points of its text outside links. Elements that are no part of an
article by their kind, role or class (menus, headers, footers, sidebars, notices, adverts, forms,
reader comments) are taken out before the lines are counted, as are scripts and styles. Where a
page marks its article, lines outside weigh nothing, and lines and containers inside always count.

Defined cases: a null or empty page, and one without such lines, has an empty text. Pages are
worked on whole, one at a time, whatever their length; a tag or comment that never closes ends with the page.
Repeated pages and ids are rows like any other; an empty table stays empty. Columns of the caller
named like the results are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tideload.llm.common import filled, quoted

WINDOW = 3
SURGE_CHARS = 86
RUN_SHARE = 0.25

# Elements whose content is no text of the page.
_RAW = "script style noscript template iframe svg object textarea select title canvas audio video button"
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CONTAINERS = frozenset(
    "html body main article section div nav header footer aside form fieldset table ul ol dl menu dialog details blockquote".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_BLOCKS = _CONTAINERS | _HEADINGS | frozenset(
    "p li dt dd tr td th caption thead tbody tfoot pre address figure figcaption summary center hr legend option optgroup".split()
)
# Containers that leave a blank line where they begin and end.
_BLANKS = _CONTAINERS - {"ul", "ol", "dl", "blockquote", "fieldset", "html"}
_NEVER_OUT = frozenset("html body main article".split())
_OUT_ELEMENTS = frozenset("nav footer aside menu dialog label legend".split())
_OUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
# First or last part of a class or id that tells what an element is.
_OUT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense sponsor sponsored promo promotion banner "
    "nav navbar navigation menu breadcrumb breadcrumbs masthead topbar footer sidebar aside widget widgets "
    "cookie cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription "
    "signup signin login register share sharing social related recommended recommendations comment comments commentlist "
    "reply replies respond disqus discussion feedback pagination pager toolbar copyright disclaimer search form skip "
    "werbung anzeige kommentare publicite commentaires publicidad comentarios".split()
)
_NEGATIONS = frozenset("no not has with without".split())
_COMMENTS_HEADING = re.compile(
    r"(?:\d+ |reader |user |leser)?(?:comments?|kommentare?|commentaires?|comentarios?)(?: ?\(?\d+\)?)?:?$", re.IGNORECASE
)

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?--!?>|.*)"
    rf"|<(?P<raw>{_RAW.replace(' ', '|')})(?=[\s/>])[^>]*+(?:>(?:.*?</(?P=raw)(?=[\s/>])[^>]*+(?:>|\Z)|.*)|\Z)"
    r"""|<(?P<end>/?)(?P<name>[a-z][^\s/>]*+)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*+|[^>]*+)(?:>|\Z)"""
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"']+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_NOT_SHOWN = re.compile(r"display\s*:\s*none", re.IGNORECASE)
_QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
_ROLE_MAIN = re.compile(r"\brole\s*=\s*[\"']?main\b", re.IGNORECASE)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Why an element is out: the first kind comes back where an article begins in it.
_IN, _SOFT, _OUT = 0, 1, 2


def _named_out(name: str) -> int:
    parts = [p.lower() for p in _PARTS.findall(name)]
    if not parts or not _NEGATIONS.isdisjoint(parts):
        return _IN
    if parts[0] in _OUT_NAMES or parts[-1] in _OUT_NAMES:
        return _OUT
    return _SOFT if parts[-1] == "header" else _IN


def _state(name: str, attrs: str) -> int:
    """Whether an element is no part of an article by itself."""
    if name in _NEVER_OUT:
        return _IN
    if name in _OUT_ELEMENTS:
        return _SOFT if name == "nav" else _OUT
    state = _SOFT if name in ("form", "header") else _IN
    if attrs:
        if "hidden" in attrs and "hidden" in re.split(r"[\s=/]+", _QUOTED.sub("", attrs).lower()):
            return _OUT
        for key, *values in _ATTRIBUTE.findall(attrs):
            value = values[0] or values[1] or values[2]
            if key.lower() in ("class", "id"):
                state = max(state, *[_named_out(v) for v in value.split()], _IN)
            elif key.lower() == "role" and value.lower() in _OUT_ROLES or key.lower() == "style" and _NOT_SHOWN.search(value):
                return _OUT
    return state


class Line(NamedTuple):
    """A line: code points outside links, blank lines before it, number of the article and whether in the main part it is in."""

    text: str
    weight: int
    blanks: int
    article: int
    main: bool
    heading: bool


class _Lines:
    """The lines of a page as they are found."""

    def __init__(self) -> None:
        self.found: list[Line] = []
        # Open elements that matter: name, state, number of the outermost article or 0, in the main part, in its header.
        self.open: list[tuple[str, int, int, bool, bool]] = [("", _IN, 0, False, False)]
        self.parts: list[str] = []
        self.in_link = self.link_chars = self.blanks = self.articles = self.breaks = 0
        self.heading = False

    def text(self, raw: str) -> None:
        state, header = self.open[-1][1], self.open[-1][4]
        if state == _IN and not (header and not self.heading):
            text = unescape(raw)
            self.parts.append(text)
            if text.strip():
                self.breaks = 0
                if self.in_link:
                    self.link_chars += len(" ".join(text.split()))

    def flush(self) -> None:
        if not self.parts:
            return
        text = " ".join("".join(self.parts).split())
        links, self.link_chars = self.link_chars, 0
        self.parts = []
        if not text:
            return
        name, _, article, main, _ = self.open[-1]
        if self.heading and _COMMENTS_HEADING.match(text):
            # What follows in this container are the readers' comments.
            self.open[-1] = (name, _OUT, *self.open[-1][2:])
            return
        self.found.append(Line(text, max(0, len(text) - links), self.blanks, article, main, self.heading))
        self.blanks = 0

    def begin(self, name: str, attrs: str) -> None:
        if name == "br":
            self.breaks += 1
            self.parts.append(" ")
            if self.breaks > 1:
                self.flush()
            return
        if name == "a":
            self.in_link = 1
        block = name in _BLOCKS
        if block:
            self.flush()
            self.heading = name in _HEADINGS
            while self.open[-1][0] not in _CONTAINERS and self.open[-1][0] not in ("", "li", "td", "tr"):
                self.open.pop()
            if name in ("li", "td", "tr") and self.open[-1][0] == name:
                self.open.pop()
        if name in _VOID:
            return
        _, held, article, main, header = self.open[-1]
        state = _state(name, attrs)
        if name == "main" or _ROLE_MAIN.search(attrs):
            main, state, held = True, _IN, _IN
        if name == "article":
            held = _IN if held == _SOFT else held
            if not article and held == _IN:
                self.articles += 1
                article = self.articles
        if state == _SOFT and (article or main) and name not in ("nav", "form"):
            # The header of the article itself: its headings belong to the text.
            header, state = True, _IN
        if name in _BLANKS and not article:
            self.blanks += 1
        if name in _CONTAINERS or state != _IN or header != self.open[-1][4]:
            self.open.append((name, max(state, held), article, main, header))

    def end(self, name: str) -> None:
        if name == "a":
            self.in_link = 0
        if name in _BLOCKS:
            self.flush()
            self.heading = False
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at][0] == name:
                was_in = self.open[at][2]
                del self.open[at:]
                if name in _BLANKS and not (was_in and self.open[-1][2]):
                    self.blanks += 1
                return
            if name not in _CONTAINERS and self.open[at][0] in _CONTAINERS:
                return


def lines_of(html: str) -> list[Line]:
    """The lines of a page that may belong to its article, with what they weigh."""
    lines, at = _Lines(), 0
    for token in _TOKEN.finditer(html):
        if token.start() > at:
            lines.text(html[at : token.start()])
        at = token.end()
        if name := token["name"]:
            if token["end"]:
                lines.end(name.lower())
            else:
                lines.begin(name.lower(), token["attrs"])
    if at < len(html):
        lines.text(html[at:])
    lines.flush()
    return lines.found


def _weighed(lines: list[Line]) -> list[tuple[int, int]]:
    """Weight of each line and blank lines before it, by the articles or main part the page marks."""
    in_articles = sum(len(line.text) for line in lines if line.article)
    in_main = sum(len(line.text) for line in lines if line.main)
    if not in_articles and not in_main:
        return [(line.weight, line.blanks) for line in lines]
    by_article = in_articles and 2 * sum(len(line.text) for line in lines if line.article and line.main) >= in_main
    out, before, part = [], 0, 0
    for line, after in zip(lines, [*lines[1:], None], strict=True):
        part = line.article if by_article else int(line.main)
        if not part and by_article and line.main and line.heading and after:
            part = after.article  # the headline that stands before its article
        blanks = line.blanks if part == before else max(line.blanks, WINDOW)
        out.append((len(line.text), 0 if part == before else blanks) if part else (0, blanks))
        before = part
    return out


def main_lines(html: str, window: int = WINDOW, surge_chars: int = SURGE_CHARS, run_share: float = RUN_SHARE) -> list[str]:
    """The lines between the surge and dive points of a page."""
    lines = lines_of(html)
    # Weights with the blank lines between them; the place of each line.
    weights: list[int] = []
    places: list[int] = []
    for weight, blanks in _weighed(lines):
        weights += [0] * min(blanks, window)
        places.append(len(weights))
        weights.append(weight)
    sums = [sum(weights[i : i + window]) for i in range(len(weights))]
    if not any(sums):
        return []
    height = min(surge_chars, max(sums) / 2)
    runs, surge, heavy = [], None, 0
    for i, weight in enumerate([*weights, *[0] * window]):
        if weight and surge is None:
            surge = i
        if weight:
            heavy = i
        if surge is not None and i - heavy >= window:
            runs.append((surge, heavy))
            surge = None
    sizes = [sum(weights[a : b + 1]) for a, b in runs]
    kept = [
        (a, b) for (a, b), size in zip(runs, sizes, strict=True) if max(sums[a : b + 1]) >= height and size >= run_share * max(sizes)
    ]
    return [line.text for line, at in zip(lines, places, strict=True) if any(a <= at <= b for a, b in kept)]


def extract_text(
    pages: DataFrame,
    html_col: str = "html",
    window: int = WINDOW,
    surge_chars: int = SURGE_CHARS,
    run_share: float = RUN_SHARE,
) -> DataFrame:
    """The rows of ``pages`` with ``text``, the main text of each, and its code points ``n_chars``."""
    kept = [c for c in pages.columns if c not in ("text", "n_chars")]
    # Plain names on the way: a dot in a name would not pass the Arrow step.
    rows = pages.select(*[quoted(c).alias(f"c{i}") for i, c in enumerate(kept)], filled(quoted(html_col)).alias("html"))
    added = [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    schema = T.StructType([*rows.schema.fields[:-1], *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ["\n\n".join(main_lines(p.as_py(), window, surge_chars, run_share)) for p in batch.columns[-1]]
            found = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *found], names=schema.names)

    return rows.mapInArrow(run, schema).toDF(*kept, "text", "n_chars")
