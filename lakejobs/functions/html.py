"""Web page extraction: sections, paragraphs, lists, links and schedule tables.

Pages are parsed in place by a row function with the standard library's parser; one
page is one row, so the work spreads with the rows. Spark hands rows to it a hundred
at a time, so a Python worker holds that many pages, however long a partition is.
"""

from __future__ import annotations

import re
from collections.abc import Collection
from html.parser import HTMLParser
from urllib.parse import urljoin

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakejobs.functions.strings import part

VOID = {"br", "img", "hr", "meta", "link", "input", "source", "wbr", "col"}
BLOCKS = {"p", "li", "h1", "h2", "h3", "title", "td", "th", "tr", "div", "ul", "ol", "table", "section", "article"}
CLOSES = {"p": {"p", "div", "ul", "ol", "table", "h1", "h2", "h3", "section", "article"}, "li": {"li"},
          "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr"}}


class Elements(HTMLParser):
    """Flat list of (tag, attributes, text, depth, section number) in document order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[dict] = []
        self.found: list[dict] = []
        self.sections = 0

    def updatepos(self, i, j):
        """Line numbers are not asked for."""
        return j

    def handle_starttag(self, tag, attrs):
        while self.open and tag in CLOSES.get(self.open[-1]["tag"], ()):
            self.open.pop()
        values = dict(attrs)
        if "section" in (values.get("class") or "").split():
            self.sections += 1
        element = {"tag": tag, "attrs": values, "text": [], "section": self.sections}
        self.found.append(element)
        if tag not in VOID:
            self.open.append(element)

    def handle_endtag(self, tag):
        if any(e["tag"] == tag for e in self.open):
            while self.open.pop()["tag"] != tag:
                pass

    def handle_data(self, data):
        for element in self.open:
            if element["tag"] in ("script", "style"):
                return
        for element in self.open:
            element["text"].append(data)


def _text(element: dict) -> str:
    return " ".join("".join(element["text"]).split())


# Markup without references, comments, declarations or tags that change how text is read: its tags can be told by
# an expression. Lower-case names and double-quoted attributes only; all other pages go through the parser.
_TAG = r'<(/?)([a-z][a-z0-9]*+)((?: [a-z]++="[^"<>&]*+")*+)>'
PLAIN_PAGE = re.compile(rf"(?:[^<&]++|{_TAG})*+")
PLAIN_PART = re.compile(rf"([^<]++)|{_TAG}")
ATTRIBUTE = re.compile(r' ([a-z]++)="([^"]*+)"')
READ_OTHERWISE = {"script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext"}


def _parse_plain(html: str) -> list[dict] | None:
    """Elements of a page of plain markup, else None."""
    if not PLAIN_PAGE.fullmatch(html):
        return None
    parts = PLAIN_PART.findall(html)
    if any(tag in READ_OTHERWISE or closes and attributes for _, closes, tag, attributes in parts):
        return None
    reader = Elements()
    for text, closes, tag, attributes in parts:
        if text:
            reader.handle_data(text)
        elif closes:
            reader.handle_endtag(tag)
        else:
            reader.handle_starttag(tag, ATTRIBUTE.findall(attributes))
    return reader.found


def parse(html: str, references: Collection[str] | None = None) -> list[dict]:
    """Elements of a page. ``references`` names the character references that are read, each closed by a semicolon
    ("amp", "#39"); others stay as they are written. Without it all are read as a browser does."""
    if references is not None:
        html = re.sub(rf"&(?!(?:{'|'.join(map(re.escape, references))});)", "&amp;", html)
    plain = _parse_plain(html)
    if plain is not None:
        return plain
    reader = Elements()
    reader.feed(html)
    reader.close()
    return reader.found


def page_outline(
    url: str, html: str, references: Collection[str] | None = None
) -> tuple[str, list[str], list[str], list[str]]:
    """Title, paragraphs (text before 'See'), list items and absolute links without fragment."""
    found = parse(html, references)
    title = next((_text(e) for e in found if e["tag"] == "title"), "")
    paragraphs = [t for e in found if e["tag"] == "p" and (t := _text(e).split("See")[0].strip())]
    items = [t for e in found if e["tag"] == "li" and (t := _text(e))]
    links = [urljoin(url, h) for e in found if e["tag"] == "a" and (h := e["attrs"].get("href")) and "#" not in h]
    return title, paragraphs, items, links


def page_sections(url: str, html: str) -> list[tuple[str, str, list[str]]]:
    """(title, info, links) of each section after the first that has a heading and two paragraphs."""
    by_section: dict[int, list[dict]] = {}
    for e in parse(html):
        by_section.setdefault(e["section"], []).append(e)
    rows = []
    for number in sorted(n for n in by_section if n > 1):
        own = by_section[number]
        heading = next((_text(e) for e in own if e["tag"] == "h2"), None)
        paragraphs = [_text(e) for e in own if e["tag"] == "p"]
        if heading is None or len(paragraphs) < 2:
            continue
        info = paragraphs[1].split("See")[0].strip()
        items = [_text(e) for e in own if e["tag"] == "li"]
        if items:
            info = f"{info} {' '.join(items)}"
        links = [urljoin(url, h) for e in own if e["tag"] == "a" and (h := e["attrs"].get("href")) and "#" not in h]
        rows.append((heading, info, links))
    return rows


def table_cells(html: str) -> list[tuple[int, int, int, str]]:
    """(table, row, column, text) of body cells, with row spans carried down."""
    rows: list[tuple[int, int, int, str]] = []
    table = row = 0
    spans: dict[int, tuple[str, int]] = {}
    column = 0
    header = False

    def fill() -> None:
        nonlocal column
        while column in spans:
            text, left = spans[column]
            rows.append((table, row, column, text))
            if left > 1:
                spans[column] = (text, left - 1)
            else:
                del spans[column]
            column += 1

    # Tables inside comments are tables too.
    for e in parse(html.replace("<!--", " ").replace("-->", " ")):
        if e["tag"] == "table":
            table, row, spans, header = table + 1, 0, {}, False
        elif e["tag"] == "thead":
            header = True
        elif e["tag"] == "tbody":
            header = False
        elif e["tag"] == "tr":
            if row and not header:
                fill()
            row, column = (0, 0) if header else (row + 1, 0)
        elif e["tag"] in ("td", "th"):
            if not header:
                fill()
            text = _text(e)
            rows.append((table, row, column, text.lower() if header else text))
            span = e["attrs"].get("rowspan") or "1"
            if not header and span.isdigit() and int(span) > 1:
                spans[column] = (text, int(span) - 1)
            column += 1
    if row and not header:
        fill()
    return rows


def _per_page(pages: DataFrame, key: str, columns: str, one_page) -> DataFrame:
    """Rows of ``one_page(url, html)`` beside the page's key."""
    rows = F.udf(lambda url, html: one_page(url or "", html or ""), f"array<struct<{columns}>>", useArrow=False)
    return pages.select(key, F.inline(rows("url", "html")))


def outlines(pages: DataFrame, key: str, references: Collection[str] | None = None) -> DataFrame:
    return _per_page(
        pages, key, "title string, paragraphs array<string>, items array<string>, links array<string>",
        lambda url, html: [page_outline(url, html, references)])


def sections(pages: DataFrame, key: str) -> DataFrame:
    return _per_page(pages, key, "title string, info string, links array<string>", page_sections)


def schedules(pages: DataFrame, key: str) -> DataFrame:
    """Match rows of every schedule table: a table whose header names week, date, home and score."""
    names = {"wk": "wk", "day": "day", "date": "date", "time": "time", "home": "home", "score": "score", "away": "away",
             "attendance": "attendance", "att": "attendance", "venue": "venue", "referee": "referee"}

    fields = sorted(set(names.values()))

    def lines(_: str, html: str) -> list[tuple]:
        cells = table_cells(html)
        heads = {(t, c): names.get(text) for t, r, c, text in cells if r == 0}
        found: dict[tuple[int, int], dict[str, str]] = {}
        for t, r, c, text in cells:
            if r > 0 and (field := heads.get((t, c))):
                line = found.setdefault((t, r), {})
                line[field] = max(text, line.get(field, text))
        return [(t, r, *[line.get(f) for f in fields]) for (t, r), line in found.items()]

    wide = _per_page(pages, key, f"tab int, line int, {', '.join(f'{f} string' for f in fields)}", lines)
    needed = F.col("wk").isNotNull() & F.col("date").isNotNull() & F.col("score").isNotNull() & (F.col("home") != "")
    return schedule_fields(wide.where(needed))


def score_part(score: Column | str, index: int) -> Column:
    pieces = F.split(score, "-")
    return F.when(F.size(pieces) == 2, F.trim(F.get(pieces, F.lit(index))).try_cast("int"))


def schedule_fields(rows: DataFrame) -> DataFrame:
    """Week number, first clock time, goals and attendance from the cell texts."""
    return rows.withColumns({
        "wk": F.col("wk").try_cast("int"), "time": F.trim(part("time", r"\(", 0)),
        "home_goals": score_part("score", 0), "away_goals": score_part("score", 1),
        "attendance": F.replace("attendance", F.lit(","), F.lit("")).try_cast("int")})


def season_of(url: Column | str) -> Column:
    """'2023-2024' from an address that names it, else NULL."""
    return F.nullif(F.regexp_extract(url, r"(\d{4}-\d{4})", 1), F.lit(""))
