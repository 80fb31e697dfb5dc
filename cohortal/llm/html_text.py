"""HTML extraction by layout: a small tree builder and a renderer of visible text.

The tree builder knows void and raw-text elements, end tags that HTML lets authors leave
out (head, p, li, dt, dd, option, table parts) and end tags that close what is open inside.
The renderer leaves out what a browser does not show (head, script, style, template,
noscript and comments; ``hidden``, ``display:none``; closed dialogs and all but the summary
of closed details; text whose inherited ``visibility`` is not visible) and emits all other
text: blocks on lines of their own, paragraphs, headings, lists and tables set off by an
empty line, list items with bullets or numbers and indented, preformatted text as it is,
and table cells in aligned columns, which cells may span, as they may rows. List numbers
follow ``start``, ``reversed`` and ``value``.

Null and empty pages give an empty text. Malformed markup never fails: what is no tag is
text. Nesting depth is bounded by memory only. Repeated rows give the same text, and an
empty table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

TOKEN = re.compile(
    r"<!--(?s:.*?)(?:-->|\Z)|</(?P<end>[a-zA-Z][^\s/>]*)[^>]*>|<[!?][^>]*>|</(?![a-zA-Z])[^>]*>"
    r"|<(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?>[^>\"']+|\"[^\"]*\"|'[^']*'|[\"'])*+)>"
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
INVISIBLE_STYLE = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)
VISIBILITY = re.compile(
    r"(?:^|;)\s*visibility\s*:\s*(visible|initial|hidden|collapse|inherit|unset)\b"
    r"\s*(!\s*important)?",
    re.I,
)
SPACES = re.compile(r"[ \t\n\r\f]+")

VOID = frozenset(
    "area base basefont bgsound br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset(
    "head script style template noscript title meta link iframe noembed noframes "
    "datalist object audio video canvas rp".split()
)
# An open head ends at any other start tag, and at text that is not blank.
IN_HEAD = frozenset(
    "base basefont bgsound link meta noframes noscript script style template title".split()
)
SPACED = frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre xmp figure fieldset hr".split()
)
BLOCKS = SPACED | frozenset(
    "html body address article aside center details dialog dd div dt figcaption footer form "
    "header hgroup legend li main nav optgroup option section summary caption".split()
)
# End tags that close the blocks open inside, too.
CLOSERS = BLOCKS | {"head", "noscript", "template"}
ENDS_P = (BLOCKS - frozenset("html body optgroup option caption legend".split())) | {"hr"}
# A start tag ends the open elements on the left, as far as the barrier on the right.
ENDS = {
    "li": (("li",), ("ul", "ol")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select",)),
    "optgroup": (("option", "optgroup"), ("select",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tr": (("tr",), ("table",)),
    "thead": (("thead", "tbody", "tfoot", "caption"), ("table",)),
    "tbody": (("thead", "tbody", "tfoot", "caption"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot", "caption"), ("table",)),
}
P_BARRIER = ("td", "th", "table", "button", "caption", "object")
END_BARRIER = {"p": P_BARRIER, "li": ("ul", "ol", "table"), "td": ("table",), "tr": ("table",)}


class Node:
    __slots__ = ("name", "attrs", "children")

    def __init__(self, name: str, attrs: dict[str, str]):
        self.name, self.attrs, self.children = name, attrs, []


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, *values in ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), unescape(next((v for v in values if v), "")))
    return found


class Open:
    """The open elements, innermost last, and where those of each name are.

    An element closed from among others leaves a gap, so that places stay as they are.
    Every question is answered by the last places of a few names, however deep the page.
    """

    def __init__(self, root: Node):
        self.nodes: list[Node | None] = [root]
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    @property
    def top(self) -> Node:
        return self.nodes[-1]

    def push(self, node: Node) -> None:
        self.places.setdefault(node.name, []).append(len(self.nodes))
        if node.name in BLOCKS:
            self.blocks.append(len(self.nodes))
        self.nodes.append(node)

    def last(self, names: tuple[str, ...]) -> int:
        """Place of the innermost element of the names; the root's if none is open."""
        return max((at[-1] for n in names if (at := self.places.get(n))), default=0)

    def close_from(self, place: int) -> None:
        """Close an element and all inside it."""
        while len(self.nodes) > place or self.nodes[-1] is None:
            node = self.nodes.pop()
            if node is not None:
                self.places[node.name].pop()
                if node.name in BLOCKS:
                    self.blocks.pop()

    def close_outermost(self, names: tuple[str, ...], barrier: tuple[str, ...]) -> None:
        """Close the outermost open element that has one of the names, within the barrier."""
        wall = self.last(barrier)
        found = []
        for n in names:
            at = self.places.get(n, ())
            first = bisect_right(at, wall)
            found += at[first : first + 1]
        if found:
            self.close_from(min(found))

    def close_one(self, name: str, barrier: tuple[str, ...]) -> None:
        """Close the innermost element of that name and what is open inside it. An inline end
        tag closes no block: the blocks inside stay open."""
        place = self.last((name,))
        if not place or self.last(barrier) > place:
            return
        if name not in CLOSERS and self.blocks and self.blocks[-1] > place:
            self.nodes[place] = None
            self.places[name].pop()
        else:
            self.close_from(place)


def build(html: str) -> Node:
    """The element tree; text nodes are strings."""
    root = Node("", {})
    open_ = Open(root)
    last_end = html.rfind(">")
    at = 0
    while True:
        if at <= last_end:
            tag = TOKEN.search(html, at)
            stop = tag.start() if tag else len(html)
        else:
            # No tag ends here any more; only a comment that is not closed is no text.
            tag, stop = None, html.find("<!--", at)
        text = html[at : stop if stop >= 0 else len(html)]
        if text:
            text = unescape(text) if "&" in text else text
            if open_.top.name == "head" and text.strip(" \t\n\r\f"):
                open_.close_one("head", ())
            open_.top.children.append(text)
        if not tag:
            return root
        at = tag.end()
        name = tag["name"]
        if name is None:
            ended = (tag["end"] or "").lower()
            if ended == "br":
                if open_.top.name == "head":
                    open_.close_one("head", ())
                open_.top.children.append(Node("br", {}))
            elif ended:
                open_.close_one(ended, END_BARRIER.get(ended, ()))
            continue
        name = name.lower()
        if open_.top.name == "head" and name not in IN_HEAD:
            open_.close_one("head", ())
        if name in ENDS_P:
            open_.close_one("p", P_BARRIER)
        if name in ENDS:
            open_.close_outermost(*ENDS[name])
        node = Node(name, _attributes(tag["attrs"]) if tag["attrs"] else {})
        open_.top.children.append(node)
        if name in RAW:
            stop = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(html, at)
            inner = html[at : stop.start() if stop else len(html)]
            if name in ("textarea", "title"):
                node.children.append(unescape(inner))
            elif name == "xmp":
                node.children.append(inner)
            at = stop.end() if stop else len(html)
        elif name not in VOID:
            open_.push(node)


class Page:
    """Lines of text; text joins the open line, blanks collapse, blocks start new lines."""

    def __init__(self):
        self.lines: list[str] = []
        self.open: list[str] = []
        self.blank = False  # a blank is due before the next word
        self.gap = 0  # empty lines due before the next line
        self.indents: list[str] = []
        self.marker = ""

    def text(self, text: str) -> None:
        words = SPACES.sub(" ", text)
        if words[:1] == " ":
            self.blank = True
            words = words[1:]
        if not words:
            return
        if self.blank and self.open:
            self.open.append(" ")
        self.blank = words[-1] == " "
        self.open.append(words[:-1] if self.blank else words)

    def as_is(self, text: str) -> None:
        first, *rest = text.replace("\r\n", "\n").split("\n")
        self.open.append(first)
        for line in rest:
            self.end_line(even_empty=True)
            self.open.append(line)

    def end_line(self, even_empty: bool = False) -> None:
        line = "".join(self.open)
        self.open, self.blank = [], False
        if not line.strip() and not (even_empty and self.lines and not self.gap):
            return
        if self.gap and self.lines:
            self.lines.extend([""] * self.gap)
        self.gap = 0
        lead = "".join(self.indents)
        if self.marker:
            lead = lead[: len(lead) - len(self.marker)] + self.marker
            self.marker = ""
        self.lines.append((lead + line).rstrip())

    def block(self, spaced: bool) -> None:
        self.end_line()
        self.gap = max(self.gap, int(spaced))

    def finish(self) -> list[str]:
        self.end_line()
        return self.lines


# Lines of a cell, and the columns and rows that it spans.
Cell = tuple[list[str], int, int]
MOST_COLUMNS, MOST_ROWS = 1000, 65_534


def _number(attrs: dict[str, str], name: str) -> int | None:
    value = attrs.get(name, "").strip()
    return int(value) if re.fullmatch(r"[-+]?\d{1,9}", value) else None


def _span(attrs: dict[str, str], name: str, most: int) -> int:
    """Columns or rows of a cell; ``rowspan=0`` goes on to the table's end."""
    value = _number(attrs, name)
    if value == 0 and name == "rowspan":
        return most
    return 1 if value is None or value < 1 else min(value, most)


def _placed(rows: list[list[Cell]]) -> list[list[tuple[int, int, list[str]]]]:
    """(first column, number of columns, lines) of each cell. A cell that spans rows keeps
    its columns there; the cells of those rows go beside it."""
    out = []
    taken: dict[int, int] = {}  # rows that each column is still taken for
    for row in rows:
        column, line, more = 0, [], {}
        for lines, across, down in row:
            while column in taken:
                column += 1
            n = 1
            while n < across and column + n not in taken:
                n += 1
            line.append((column, n, lines))
            if down > 1:
                more.update(dict.fromkeys(range(column, column + n), down - 1))
            column += n
        taken = {c: k - 1 for c, k in taken.items() if k > 1} | more
        out.append(line)
    return out


def _aligned(rows: list[list[Cell]]) -> list[str]:
    """Rows of cells as lines with the columns under each other."""
    placed = _placed(rows)
    widths = [0] * max((c + n for row in placed for c, n, _ in row), default=0)
    wide = []
    for row in placed:
        for c, n, lines in row:
            need = max(map(len, lines), default=0)
            if n == 1:
                widths[c] = max(widths[c], need)
            else:
                wide.append((n, c, need))
    for n, c, need in sorted(wide):
        # The last of its columns makes room for what the others leave.
        widths[c + n - 1] += max(0, need - sum(widths[c : c + n]) - 2 * (n - 1))
    starts = [0]
    for w in widths:
        starts.append(starts[-1] + w + 2)
    out = []
    for row in placed:
        for k in range(max((len(lines) for _, _, lines in row), default=0)):
            text = ""
            for c, _, lines in row:
                if k < len(lines):
                    text = text.ljust(starts[c]) + lines[k]
            out.append(text.rstrip())
    return out


def _hidden(node: Node, parent: Node) -> bool:
    attrs = node.attrs
    if node.name in UNSEEN:
        return True
    if parent.name == "details" and "open" not in parent.attrs and node.name != "summary":
        return True
    if node.name == "dialog" and "open" not in attrs:
        return True
    return bool(attrs) and (
        "hidden" in attrs or bool(INVISIBLE_STYLE.search(attrs.get("style", "")))
    )


def _visible(node: Node, inherited: bool) -> bool:
    """Whether text directly in the element is visible, by its last visibility, important
    ones first; an element without one is as its parent."""
    found = VISIBILITY.findall(node.attrs.get("style", "")) if node.attrs else ()
    if not found:
        return inherited
    value = max(enumerate(found), key=lambda x: (bool(x[1][1]), x[0]))[1][0].lower()
    return inherited if value in ("inherit", "unset") else value in ("visible", "initial")


class Renderer:
    """Walks the tree without recursion; a table cell is a page of its own."""

    def __init__(self):
        self.pages = [Page()]
        self.tables: list[list[list[Cell]]] = []
        self.lists: list[list] = []  # [kind, next number, step]
        self.pre = 0

    def enter(self, node: Node) -> None:
        page, name = self.pages[-1], node.name
        if name == "br":
            page.end_line(even_empty=True)
        elif name == "table":
            page.block(True)
            self.tables.append([])
        elif name == "tr" and self.tables:
            self.tables[-1].append([])
        elif name in ("td", "th") and self.tables:
            self.pages.append(Page())
        elif name in BLOCKS:
            nested = name in ("ul", "ol") and bool(self.lists)
            page.block(name in SPACED and not nested)
        if name in ("ul", "ol"):
            backwards = name == "ol" and "reversed" in node.attrs
            start = _number(node.attrs, "start")
            if start is None:
                start = 1
                if backwards:
                    start = sum(isinstance(c, Node) and c.name == "li" for c in node.children)
            self.lists.append([name, start, -1 if backwards else 1])
        elif name == "li":
            marker = "- "
            if self.lists and self.lists[-1][0] == "ol":
                value = _number(node.attrs, "value")
                number = self.lists[-1][1] if value is None else value
                marker = f"{number}. "
                self.lists[-1][1] = number + self.lists[-1][2]
            page.indents.append(" " * len(marker))
            page.marker = marker
        elif name in ("dd", "blockquote"):
            page.indents.append("  ")
        elif name in ("pre", "xmp"):
            self.pre += 1

    def text(self, text: str) -> None:
        (self.pages[-1].as_is if self.pre else self.pages[-1].text)(text)

    def leave(self, node: Node) -> None:
        name = node.name
        if name in ("td", "th") and self.tables:
            cell = self.pages.pop().finish()
            if not self.tables[-1]:
                self.tables[-1].append([])
            across = _span(node.attrs, "colspan", MOST_COLUMNS)
            self.tables[-1][-1].append((cell, across, _span(node.attrs, "rowspan", MOST_ROWS)))
            return
        page = self.pages[-1]
        if name == "table":
            page.block(False)
            for line in _aligned(self.tables.pop()):
                page.open.append(line)
                page.end_line(even_empty=True)
            page.block(True)
        elif name in BLOCKS:
            nested = name in ("ul", "ol") and len(self.lists) > 1
            page.block(name in SPACED and not nested)
        if name in ("ul", "ol"):
            self.lists.pop()
        elif name in ("li", "dd", "blockquote"):
            page.indents.pop()
            page.marker = "" if name == "li" else page.marker
        elif name in ("pre", "xmp"):
            self.pre -= 1


def render(root: Node) -> str:
    """All visible text of the tree."""
    out = Renderer()
    todo: list[tuple[object, Node | None, bool]] = [(root, None, True)]
    while todo:
        node, parent, visible = todo.pop()
        if isinstance(node, str):
            closed = parent.name == "details" and "open" not in parent.attrs
            # Blanks between the parts of a table or list are no text.
            blank = parent.name in ("table", "tr", "ul", "ol") and not node.strip()
            if visible and not closed and not blank:
                out.text(node)
        elif parent is None and node is not root:
            out.leave(node)
        elif node is root or not _hidden(node, parent):
            visible = _visible(node, visible)
            out.enter(node)
            if node is not root:
                todo.append((node, None, visible))
            todo.extend((child, node, visible) for child in reversed(node.children))
    return "\n".join(out.pages[0].finish())


def visible_text(html: str | None) -> str:
    return render(build(html)) if html else ""


def extract(pages: DataFrame, *, html: str = "html", out: str = "text") -> DataFrame:
    """The rows of ``pages`` with the visible text in place of the markup.

    A column of ``pages`` that is named like the output is replaced.
    """
    kept = [c for c in pages.columns if c not in (html, out)]
    fields = [pages.schema[c] for c in kept] + [T.StructField(out, T.StringType())]
    schema = T.StructType(fields)

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [visible_text(v.as_py()) for v in batch.column(len(kept))]
            columns = [*batch.columns[:-1], pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return pages.select(*kept, html).mapInArrow(convert, schema)
