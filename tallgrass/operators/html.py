"""Text and tables out of HTML, by Arrow-batched parsing with the standard library only."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame

_SILENT = {"script", "style", "nav", "header", "footer", "aside", "noscript", "form"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "keygen", "link", "menuitem", "meta", "param", "source", "track", "wbr"}
_BLOCKS = {"p", "div", "br", "li", "h1", "h2", "h3", "h4", "tr", "article", "section", "main"}
#: A main part has at least so many characters; without one, paragraphs of at least the second number make the text.
LEAST_MAIN, LEAST_PARAGRAPH = 100, 30

# Where pages keep their main text, best first, what is cut out of them, and where they keep title and time.
MAIN = (
    "[itemprop=articleBody]", "#dic_area", "#articleBody", "#article_body", "#news_body", "#articeBody", ".article_body", ".article-body", ".articleBody",
    ".news_body", ".news-body", ".newsct_article", ".view_text", ".view-content", ".article-view", ".article_cont", ".article-content", "article", ".content",
)
ANCHOR_MAIN = ("#dic_area", "#articeBody", "#articleBodyContents", "article")
CUT = frozenset({"script", "style", "nav", "footer", "aside", "iframe", "form", "button"})
ANCHOR_CUT = frozenset({"script", "style", "nav", "footer", "aside", "iframe"})
TITLES = (("h2#title_area", None), ("h2.media_end_head_headline", None), ("meta[property=og:title]", "content"), ("meta[name=twitter:title]", "content"))
TIMES = (
    ("meta[property=article:published_time]", "content"), ("meta[name=article:published_time]", "content"),
    ("span._ARTICLE_DATE_TIME", "data-date-time"), ("span.media_end_head_info_datestamp_time", "data-date-time"),
)


class _Reader(HTMLParser):
    """Tables as rows of (text, rowspan, colspan)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.text: list[str] = []
        self.silent = 0
        self.tables: list[list[list[tuple[str, int, int]]]] = []
        self.cell: tuple[int, int, int] | None = None

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag in _SILENT:
            self.silent += 1
        if tag in _BLOCKS:
            self.text.append("\n")
        if tag == "table":
            self.tables.append([])
        if tag == "tr" and self.tables:
            self.tables[-1].append([])
        if tag in ("td", "th") and self.tables and self.tables[-1]:
            span = lambda k, most: max(1, min(int(a[k]), most)) if (a.get(k) or "").isdigit() else 1
            self._end_cell()
            self.cell = (len(self.text), span("rowspan", 65_534), span("colspan", 1000))  # the limits that HTML sets

    def handle_endtag(self, tag):
        if tag in _SILENT and self.silent:
            self.silent -= 1
        if tag in ("td", "th", "tr", "table"):
            self._end_cell()
        if tag in _BLOCKS:
            self.text.append("\n")

    def handle_data(self, data):
        if not self.silent:
            self.text.append(data)

    def _end_cell(self):
        if self.cell is not None and self.tables and self.tables[-1]:
            at, rows, columns = self.cell
            self.tables[-1][-1].append((" ".join("".join(self.text[at:]).split()), rows, columns))
        self.cell = None


def _selector(pattern: str):
    """A test of (tag, attributes) for a pattern: a tag, then #id, .class or [attribute=value], each of which may lack."""
    tag, kind, rest = re.fullmatch(r"([a-z0-9]*)([#.\[]?)(.*)", pattern).groups()
    name, _, value = rest.rstrip("]").partition("=") if kind == "[" else ("id" if kind == "#" else "class", "", rest)
    one = (lambda have: value in (have or "").split()) if kind == "." else (lambda have: have == value)
    return lambda t, a: (not tag or t == tag) and (not kind or one(a.get(name)))


class _Page(HTMLParser):
    """A page's main text, title and time by ordered selectors; an element ends with its own end tag, that of one around it, or the page."""

    def __init__(self, main, cut, marks) -> None:
        super().__init__(convert_charrefs=True)
        self.main, self.cut, self.marks = main, cut, marks
        self.stack: list[tuple] = []  # (tag, where its text begins, where all text begins, best selector, marks that it is the first of)
        self.opened: Counter = Counter()
        self.text: list[str] = []  # outside what is cut
        self.all: list[str] = []
        self.silent = 0
        self.parts: list[tuple[int, int, str]] = []  # (selector, where it begins, text)
        self.paragraphs: list[tuple[int, int, str]] = []
        self.found: dict[int, str] = {}

    def handle_starttag(self, tag, attrs):
        a = dict(reversed(attrs))
        first = []
        for i, (test, attribute) in enumerate(self.marks):
            if i not in self.found and test(tag, a):
                self.found[i] = (a.get(attribute) or "") if attribute else ""
                first += [] if attribute else [i]
        if tag in _VOID:
            return
        self.silent += tag in self.cut
        rank = next((i for i, test in enumerate(self.main) if test(tag, a)), None) if not self.silent else None
        self.stack.append((tag, len(self.text), len(self.all), rank, first))
        self.opened[tag] += 1

    def handle_endtag(self, tag):
        if self.opened[tag]:
            while self._pop() != tag:
                pass

    def handle_data(self, data):
        data = data.strip()
        if data:
            self.all.append(data)
            if not self.silent:
                self.text.append(data)

    def finish(self):
        self.close()
        while self.stack:
            self._pop()

    def _pop(self):
        tag, at, at_all, rank, first = self.stack.pop()
        self.opened[tag] -= 1
        for i in first:
            self.found[i] = " ".join(self.all[at_all:])
        if not self.silent and (tag == "p" or rank is not None):
            text = "\n".join(self.text[at:])
            if tag == "p" and len(text) >= LEAST_PARAGRAPH:
                self.paragraphs.append((at, -len(self.stack), text))
            if rank is not None and len(text) >= LEAST_MAIN:
                self.parts.append((rank, at, text))
        self.silent -= tag in self.cut
        return tag


def _compiled(main, cut, marks):
    return [_selector(x) for x in main], cut, [(_selector(x), a) for x, a in marks]


_ANY, _ANCHOR = _compiled(MAIN, CUT, TITLES), _compiled(ANCHOR_MAIN, ANCHOR_CUT, TITLES + TIMES)


def page_of(html: str | None, anchor: bool = False) -> tuple[str | None, str | None, str | None]:
    """(text, title, published) of a page, each NULL where it lacks; the anchor's own pages have other selectors, and they alone a time.

    The text is the longest one of the best selector that has one of LEAST_MAIN characters, else the longer paragraphs together.
    """
    r = _Page(*(_ANCHOR if anchor else _ANY))
    r.feed(html or "")
    r.finish()
    text = min(r.parts, key=lambda p: (p[0], -len(p[2]), p[1]), default=(0, 0, None))[2]
    if text is None:
        joined = "\n".join(p[2] for p in sorted(r.paragraphs, key=lambda p: (p[0], -p[1])))
        text = joined if len(joined) >= LEAST_MAIN else None
    printed = (re.sub("<.*?>", "", unescape(r.found.get(i, ""))).strip() for i in range(len(TITLES)))
    times = (r.found.get(i, "").strip() for i in range(len(TITLES), len(TITLES) + len(TIMES)))
    return text, next((t for t in printed if t), None), next((t for t in times if t), None)


def main_text(html: str | None) -> str | None:
    return page_of(html)[0]


def grid(rows: list[list[tuple[str, int, int]]]) -> list[list[str]]:
    """A table's cells with row and column spans filled in."""
    out: list[list[str]] = []
    hanging: dict[int, tuple[int, str]] = {}
    for row in rows:
        line: list[str] = []
        cells, at = iter(row), 0
        cell = next(cells, None)
        while cell is not None or at in hanging:
            if at in hanging:
                left, text = hanging.pop(at)
                line.append(text)
                if left > 1:
                    hanging[at] = (left - 1, text)
                at += 1
                continue
            text, down, across = cell
            for _ in range(across):
                if at in hanging:
                    break
                line.append(text)
                if down > 1:
                    hanging[at] = (down - 1, text)
                at += 1
            cell = next(cells, None)
        out.append(line)
    return out


_PLAIN = re.compile(r'<(/?)(table|tr|td|th)((?: (?:row|col)span=(?:"[0-9]{1,9}"|[0-9]{1,9}))*)>|([^<&\x00]+)')
_SPAN = re.compile(r'(row|col)span="?([0-9]+)')


def _plain_tables(html: str) -> list | None:
    """The tables of _Reader for markup of nothing but tables, spans and text, which is read by one pattern; None for any other."""
    tables: list = []
    cell, text, end = None, [], 0
    for m in _PLAIN.finditer(html):
        if m.start() != end:
            return None
        end = m.end()
        close, tag, spans, data = m.groups()
        if data is not None:
            text.append(data)
            continue
        if close or tag in ("td", "th") and tables and tables[-1]:
            if cell is not None and tables and tables[-1]:
                tables[-1][-1].append((" ".join("".join(text).split()), *cell))
            cell = None
        if close:
            continue
        if tag == "table":
            tables.append([])
        elif tag == "tr":
            text.append(" ")
            if tables:
                tables[-1].append([])
        elif tables and tables[-1]:
            have = {k: int(v) for k, v in _SPAN.findall(spans)} if spans else {}
            cell, text = (max(1, min(have.get("row", 1), 65_534)), max(1, min(have.get("col", 1), 1000))), []
    return tables if end == len(html) else None


def tables_of(html: str | None) -> list[list[list[str]]]:
    plain = _plain_tables(html or "")
    if plain is not None:
        return [g for g in (grid(t) for t in plain) if g]
    r = _Reader()
    r.feed(html or "")
    r.close()
    return [g for g in (grid(t) for t in r.tables) if g]


def page_texts(pages: DataFrame, key: str, html: str, url: str | None = None, anchor: str | None = None) -> DataFrame:
    """(key, text, title, published) of each page; pages whose url is on the anchor's host, or one below it, are read as the anchor's."""
    from pyspark.sql import functions as F

    host = F.lower(F.regexp_extract(F.col(url), r"^[^/?#]*//([^/?#]*)", 1)) if url and anchor else F.lit("")
    own = (host == F.lit(anchor)) | host.endswith(f".{anchor}") if url and anchor else F.lit(False)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [page_of(x, bool(own)) for x, own in zip(b["html"], b["own"])]
            yield pd.DataFrame(out, columns=["text", "title", "published"]).assign(**{key: b[key].to_numpy()})[[key, "text", "title", "published"]]

    x = pages.select(key, F.col(html).alias("html"), F.coalesce(own, F.lit(False)).alias("own"))
    return x.mapInPandas(run, f"{key} {pages.schema[key].dataType.simpleString()}, text string, title string, published string")


def table_cells(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, table, row, column, text): a row for each cell of each table's grid."""
    schema = f"{key} {pages.schema[key].dataType.simpleString()}, table int, row int, column int, text string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(k, t, r, c, text) for k, x in zip(b[key], b[html]) for t, g in enumerate(tables_of(x)) for r, line in enumerate(g) for c, text in enumerate(line)]
            yield pd.DataFrame(out, columns=[key, "table", "row", "column", "text"])

    return pages.select(key, html).mapInPandas(run, schema)


def labelled_values(cells: DataFrame, key: str, labels: dict[str, str]) -> DataFrame:
    """(key, fields): a map from field names to values: the cell right of the first cell, in order, whose label is known."""
    from pyspark.sql import Window as W
    from pyspark.sql import functions as F

    names = F.create_map(*(x for k, v in labels.items() for x in (F.lit(k), F.lit(v))))
    w = W.partitionBy(key, "table", "row").orderBy("column")
    bare = F.regexp_replace(F.regexp_replace("text", r"^\s*(\d+[.)]|[-–])\s*", ""), r"[\s:ㆍ·]+", "")
    x = cells.withColumn("value", F.lead("text").over(w)).withColumn("field", names[bare]).filter("field IS NOT NULL AND value IS NOT NULL")
    one = x.groupBy(key, "field").agg(F.min_by("value", F.struct("table", "row", "column")).alias("value"))
    return one.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("field", "value")))).alias("fields"))
