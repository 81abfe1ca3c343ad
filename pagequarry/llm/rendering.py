"""Layout-aware text of HTML pages: a small tree builder with implied tags, then visible text with its layout.

The builder adds the end tags that HTML lets authors leave out (paragraphs,
list items, table parts, options), so text lands in the element it belongs to.
Text and elements that stand in a table, but in none of its cells, move to
before the table, and a form between rows or cells is passed over, as in HTML.
Rendering leaves out what a reader does not see (head, scripts, styles, hidden
elements, closed details) and keeps what a reader does: block spacing, list
marks and indents, line breaks, preformatted text, and table cells aligned in
columns.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
_HIDDEN = frozenset(
    "head script style template iframe object noscript noembed noframes title datalist audio video canvas meta link "
    "desc metadata defs symbol clippath mask annotation annotation-xml".split()
)
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre search section summary table ul tr caption".split()
)
# Blocks with an empty line before and after.
_SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure article section".split())
# An opening tag ends these open elements, up to the nearest element of the second set.
_LISTS = frozenset(("ul", "ol", "menu", "dir"))
_TABLE = frozenset(("table",))
_ENDS: dict[str, tuple[frozenset[str], frozenset[str]]] = {
    "li": (frozenset(("li",)), _LISTS),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "tr": (frozenset(("tr", "td", "th", "caption")), _TABLE),
    "td": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "th": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "option": (frozenset(("option",)), frozenset(("select", "datalist"))),
    "optgroup": (frozenset(("option", "optgroup")), frozenset(("select", "datalist"))),
} | {part: (frozenset(("tr", "td", "th", "caption", "thead", "tbody", "tfoot")), _TABLE) for part in ("thead", "tbody", "tfoot")}
# Where only parts of a table may stand; anything else moves to before the table.
_SECTIONS = frozenset(("thead", "tbody", "tfoot"))
_STRUCTURE = _SECTIONS | {"table", "tr", "colgroup"}
_PARTS = _SECTIONS | {"tr", "td", "th", "caption", "colgroup", "col", "script", "style", "template"}
# The innermost of these open elements receives a part of a table, whatever else was opened within.
_RECEIVES = {part: _TABLE for part in (*_SECTIONS, "caption", "colgroup")} | {"tr": _SECTIONS | _TABLE} | {
    cell: _SECTIONS | {"tr", "table"} for cell in ("td", "th")
}
# Blocks that end an open paragraph.
_ENDS_PARAGRAPH = _BLOCK - frozenset(("html", "body", "tr", "caption", "legend", "summary", "dt", "dd", "li"))
_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.DOTALL)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NOT_SHOWN = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.IGNORECASE)
_BLANKS = re.compile(r"[ \t\n\r\f]+")
# Elements nested deeper than this are treated as belonging to this depth.
MAX_DEPTH = 200
_INDENT = "  "


@dataclass(slots=True)
class Node:
    """An element with its attributes; children are elements and texts."""

    tag: str
    attributes: dict[str, str] = field(default_factory=dict)
    children: list[Node | str] = field(default_factory=list)


def _attributes(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(source):
        found.setdefault(m[1].lower(), html.unescape(next((v for v in m.groups()[1:] if v is not None), "")))
    return found


def build_tree(source: str) -> Node:
    """The element tree of a page; unclosed and misnested tags are put right, unknown end tags ignored."""
    root = Node("#root")
    opened = [root]
    at = 0

    def close(to: int) -> None:
        del opened[to:]

    def nearest(tags: frozenset[str], until: frozenset[str]) -> int:
        """Place of the outermost open element of ``tags`` above the nearest one of ``until``; 0 if there is none."""
        found = 0
        for place in range(len(opened) - 1, 0, -1):
            if opened[place].tag in until:
                break
            if opened[place].tag in tags:
                found = place
        return found

    def innermost(tags: frozenset[str]) -> int:
        return next((p for p in range(len(opened) - 1, 0, -1) if opened[p].tag in tags), 0)

    def add(child: Node | str) -> None:
        """Append to the innermost open element, or before the table whose structure has no place for it."""
        table = innermost(_TABLE) if opened[-1].tag in _STRUCTURE else 0
        if table and (child.tag not in _PARTS if isinstance(child, Node) else child.strip()):
            before = opened[table - 1].children
            before.insert(len(before) - (before[-1] is opened[table]), child)
        else:
            opened[-1].children.append(child)

    def text(piece: str) -> None:
        if piece:
            add(html.unescape(piece) if "&" in piece else piece)

    while True:
        m = _MARKUP.search(source, at)
        if m is None:
            text(source[at:])
            return root
        text(source[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            place = next((p for p in range(len(opened) - 1, 0, -1) if opened[p].tag == tag), 0)
            # An inline end tag does not close the cell or table it stands in.
            if place and not ((tag not in _BLOCK or tag == "form") and tag not in ("td", "th") and any(n.tag in ("td", "th", "table") for n in opened[place + 1:])):
                close(place)
            elif tag == "p" and not place:
                add(Node("p"))
            elif tag == "br":
                add(Node("br"))
            continue
        if tag in _ENDS_PARAGRAPH:
            place = nearest(frozenset(("p",)), frozenset(("td", "th", "table", "button")))
            if place:
                close(place)
        if tag in _ENDS:
            place = nearest(*_ENDS[tag])
            if place:
                close(place)
        if tag in _RECEIVES:
            place = innermost(_RECEIVES[tag])
            # Not out of a cell, which has been closed above where it ends.
            if place and not any(n.tag in ("td", "th") for n in opened[place + 1:]):
                close(place + 1)
        if opened[-1].tag in _STRUCTURE and innermost(_TABLE):
            if tag == "table":
                close(innermost(_TABLE))
            elif tag == "form":
                continue
        if tag in ("td", "th") and opened[-1].tag in ("table", "thead", "tbody", "tfoot"):
            row = Node("tr")
            opened[-1].children.append(row)
            opened.append(row)
        node = Node(tag, _attributes(m[3]) if m[3] else {})
        add(node)
        if tag in _VOID or m[3].endswith("/") and tag not in _BLOCK:
            continue
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.IGNORECASE).search(source, at)
            node.children.append(source[at:end.start()] if end else source[at:])
            at = source.find(">", end.start()) + 1 if end else len(source)
            if end and at == 0:
                at = len(source)
        elif len(opened) < MAX_DEPTH:
            opened.append(node)


def visible(node: Node) -> bool:
    if node.tag in _HIDDEN or "hidden" in node.attributes:
        return False
    if node.tag == "input" or node.tag == "dialog" and "open" not in node.attributes:
        return False
    style = node.attributes.get("style")
    return not (style and _NOT_SHOWN.search(style))


class _Lines:
    """Lines of text under construction; blank lines between blocks never pile up."""

    def __init__(self) -> None:
        self.done: list[str] = []
        self.line = ""
        self.gap = False

    def words(self, piece: str) -> None:
        piece = _BLANKS.sub(" ", piece)
        if piece[:1] == " " and (not self.line or self.line[-1] == " "):
            piece = piece[1:]
        self.line += piece

    def exact(self, piece: str) -> None:
        first, *rest = piece.split("\n")
        self.line += first
        for line in rest:
            self.end(keep=True)
            self.line = line

    def end(self, keep: bool = False) -> None:
        line = self.line if keep else self.line.rstrip(" ")
        if line or keep:
            if self.gap and self.done:
                self.done.append("")
            self.gap = False
            self.done.append(line)
        self.line = ""

    def space(self) -> None:
        self.end()
        self.gap = True

    def result(self) -> list[str]:
        self.end()
        return self.done


def _hung(out: _Lines, lines: list[str], mark: str) -> None:
    """Add a block of lines, the first after ``mark`` and the others under it."""
    for k, line in enumerate(lines):
        if line:
            out.line = (mark if k == 0 else " " * len(mark)) + line
            out.end()
        else:
            out.end()
            out.gap = True


def _cells(node: Node) -> Iterator[list[list[str]]]:
    """Rows of a table, each a list of cells, each a list of lines; nested parts in document order."""
    for child in node.children:
        if isinstance(child, Node) and visible(child):
            if child.tag == "tr":
                yield [
                    cell
                    for inner in child.children if isinstance(inner, Node) and inner.tag in ("td", "th") and visible(inner)
                    for cell in [_block(inner), *[[]] * (_span(inner) - 1)]
                ]
            elif child.tag in ("thead", "tbody", "tfoot"):
                yield from _cells(child)


def _span(cell: Node) -> int:
    value = cell.attributes.get("colspan", "1")
    return min(max(int(value), 1), 100) if value.isdigit() and len(value) < 5 else 1


def _table(node: Node, out: _Lines) -> None:
    for child in node.children:
        if isinstance(child, Node) and child.tag not in ("tr", "thead", "tbody", "tfoot", "col", "colgroup"):
            _render(child, out)
        elif isinstance(child, str) and child.strip():
            out.words(child)
    out.end()
    rows = [row for row in _cells(node) if row]
    columns = max(map(len, rows), default=0)
    widths = [max((len(line) for row in rows if k < len(row) for line in row[k]), default=0) for k in range(columns)]
    for row in rows:
        for k in range(max(map(len, row), default=0)):
            pieces = [(cell[k] if k < len(cell) else "").ljust(width) for cell, width in zip(row, widths)]
            out.line = " | ".join(pieces).rstrip(" |") if any(p.strip() for p in pieces) else ""
            out.end()


def _render(node: Node | str, out: _Lines, exact: bool = False) -> None:
    if isinstance(node, str):
        out.exact(node) if exact else out.words(node)
        return
    tag = node.tag
    if not visible(node):
        return
    if tag == "br":
        if out.line or exact:
            out.end(keep=True)
        else:
            out.gap = True
    elif tag == "hr":
        out.space()
    elif tag == "img":
        out.words(node.attributes.get("alt", ""))
    elif tag == "textarea":
        out.words(html.unescape("".join(c for c in node.children if isinstance(c, str))))
    elif tag in ("option", "optgroup", "text"):  # text is an element of svg
        out.words(" ")
        if tag == "optgroup":
            out.words(node.attributes.get("label", "") + " ")
        for child in node.children:
            _render(child, out, exact)
        out.words(" ")
    elif tag in ("td", "th"):  # outside of a table
        out.words(" ".join(_block(node)) + " ")
    else:
        if tag in _SPACED:
            out.space()
        elif tag in _BLOCK:
            out.end()
        if tag == "table":
            _table(node, out)
        elif tag in _LISTS:
            _list(node, out)
        elif tag == "li":
            _hung(out, _block(node), "- ")
        elif tag in ("dd", "blockquote"):
            _hung(out, _block(node), _INDENT)
        elif tag == "details" and "open" not in node.attributes:
            for child in node.children:
                if isinstance(child, Node) and child.tag == "summary":
                    _render(child, out)
        else:
            for child in node.children:
                _render(child, out, exact or tag == "pre")
        if tag in _SPACED:
            out.space()
        elif tag in _BLOCK:
            out.end()


def _list(node: Node, out: _Lines) -> None:
    start = node.attributes.get("start", "1")
    number = int(start) if start.isdigit() and len(start) < 10 else 1
    for child in node.children:
        if isinstance(child, Node) and child.tag == "li" and visible(child):
            lines = _block(child) or [""]
            _hung(out, lines, f"{number}. " if node.tag == "ol" else "- ")
            number += 1
        elif isinstance(child, Node):
            _render(child, out)
        elif child.strip():
            out.words(child)


def _block(node: Node) -> list[str]:
    inner = _Lines()
    for child in node.children:
        _render(child, inner)
    return inner.result()


def rendered(source: str | None) -> str | None:
    """Visible text of a page; null for null."""
    return None if source is None else "\n".join(_block(build_tree(source))).strip("\n")


def visible_texts(pages: DataFrame) -> DataFrame:
    """``page_id, url, text`` for each row of ``pages`` (page_id, url, html), whole pages.

    Null html gives null text, an empty page or one without visible text an
    empty one. Repeated rows are rendered alike; other columns are not read. A
    page is worked on alone, so memory follows the longest page.
    """

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                texts = [rendered(source.as_py()) for source in part.column("html")]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(render, "page_id bigint, url string, text string")
