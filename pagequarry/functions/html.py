"""HTML to text as native expressions, plus a parser for malformed pages and nested containers."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from pagequarry.functions.text import let

INVISIBLE_PATTERN = r"(?is)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>"
TAG_PATTERN = r"</?[a-zA-Z!][^>]*>"
TITLE_PATTERN = r"<h1>(.*?)</h1>"

# Named and numeric entities with their characters. The
# ampersand is decoded last, so that "&amp;lt;" becomes "&lt;".
ENTITIES = (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&#x27;", "'"),
    ("&nbsp;", " "), ("&copy;", "©"), ("&reg;", "®"), ("&middot;", "·"),
    ("&laquo;", "«"), ("&raquo;", "»"), ("&ndash;", "–"), ("&mdash;", "—"),
    ("&lsquo;", "‘"), ("&rsquo;", "’"), ("&ldquo;", "“"), ("&rdquo;", "”"),
    ("&bull;", "•"), ("&hellip;", "…"), ("&rarr;", "→"), ("&amp;", "&"),
)


def drop_invisible(html: Column) -> Column:
    """Without comments, scripts and style sheets."""
    return F.regexp_replace(html, INVISIBLE_PATTERN, "")


def decode_entities(text: Column) -> Column:
    for entity, character in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(character))
    return text


def drop_tags(html: Column) -> Column:
    return decode_entities(F.regexp_replace(html, TAG_PATTERN, ""))


def html_to_text(html: Column) -> Column:
    return drop_tags(drop_invisible(html))


def page_title(html: Column) -> Column:
    """Text of the first plain ``<h1>``; empty when there is none."""
    return html_to_text(F.regexp_extract(html, TITLE_PATTERN, 1))


def element_content(html: Column, tag: str = "article") -> Column:
    """Inside of the first ``tag`` element, null when absent; for tags that do not nest."""
    end = f"</{tag}>"
    after_start = F.get(F.split(html, rf"<{tag}(?:\s[^>]*)?>", 2), F.lit(1))
    return let(after_start, lambda rest: F.when(F.contains(rest, F.lit(end)), F.substring_index(rest, end, 1)))


def sections(html: Column, tag: str = "h2") -> Column:
    """Plain text of the part before the first ``tag`` and of each part that starts at one."""
    return F.transform(F.split(drop_invisible(html), rf"(?=<{tag}[ >])"), drop_tags)


class _Text(HTMLParser):
    """Collects text outside scripts and style sheets."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hidden = 0
        self.found: list[str] = []

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style")

    def handle_endtag(self, tag):
        if tag in ("script", "style") and self.hidden:
            self.hidden -= 1

    def handle_data(self, data):
        if not self.hidden:
            self.found.append(data)


def _text(html: str | None) -> str | None:
    if html is None:
        return None
    parser = _Text()
    parser.feed(html)
    parser.close()
    return "".join(parser.found)


def parsed_text(html: Column) -> Column:
    """:func:`html_to_text` by a parser, for pages with broken tags or rare entities."""

    @F.pandas_udf("string")
    def parse(pages: pd.Series) -> pd.Series:
        return pages.map(_text)

    return parse(html)


class _Container(HTMLParser):
    """Finds the span of the first element with the wanted attribute."""

    def __init__(self, tag: str, attribute: str, value: str):
        super().__init__(convert_charrefs=False)
        self.wanted = (tag, attribute, value)
        self.depth = 0
        self.start: tuple[int, int] | None = None
        self.end: tuple[int, int] | None = None

    def handle_starttag(self, tag, attrs):
        name, attribute, value = self.wanted
        if tag != name or self.end is not None:
            return
        if self.start is not None:
            self.depth += 1
        elif dict(attrs).get(attribute) == value:
            self.start, self.depth = self.getpos(), 1

    def handle_endtag(self, tag):
        if tag == self.wanted[0] and self.start is not None and self.end is None:
            self.depth -= 1
            if self.depth == 0:
                self.end = self.getpos()


def _container(html: str | None, tag: str, attribute: str, value: str) -> str | None:
    if html is None:
        return None
    parser = _Container(tag, attribute, value)
    parser.feed(html)
    parser.close()
    if parser.start is None:
        return None
    line_starts = [0] + [m.end() for m in re.finditer("\n", html)]

    def offset(position: tuple[int, int]) -> int:
        return line_starts[position[0] - 1] + position[1]

    if parser.end is None:
        return html[offset(parser.start):].strip()
    stop = html.find(">", offset(parser.end)) + 1
    return html[offset(parser.start):stop or len(html)].strip()


def container_html(html: Column, tag: str = "div", attribute: str = "itemprop", value: str = "articleBody") -> Column:
    """The first ``tag`` element with ``attribute="value"``, nested ``tag`` elements included.

    Regular expressions cannot match nesting, so this one is a pandas UDF.
    """

    @F.pandas_udf("string")
    def find(pages: pd.Series) -> pd.Series:
        return pages.map(lambda page: _container(page, tag, attribute, value))

    return find(html)
