"""Visible text of HTML pages: a tree builder with implied tags, visibility rules, and a layout-aware renderer.

``TreeBuilder`` opens html, head and body where they are missing, closes
elements whose end tag may be left out (p before a block, li, dt, dd, option,
table rows and cells ...), opens tbody and tr, and ignores end tags without a
start.  ``render`` emits the text of every visible node: blocks on lines of
their own, paragraphs, headings, lists and tables with a blank line around
them, list items with a mark or number and indented by depth, ``br`` as a line
break, ``pre`` and ``textarea`` as they stand, the value or placeholder of an
input and the cells of a table in aligned columns.  A cell stands in the columns
that its ``colspan`` and the ``rowspan`` of cells above it give; widths are those
of a terminal (wide characters take two places, combining ones none).  An end
tag of an inline element closes no block that was opened in it.  White space
collapses within a line.

Invisible are the elements of ``INVISIBLE`` (head, title, script, style,
template, noscript, the fallback content of iframe, object, audio, video and
canvas, datalist, and elements that hold no text), comments, elements with
``hidden`` or an inline style of ``display: none`` or ``content-visibility:
hidden``, and inputs of type hidden.  ``visibility: hidden`` is inherited, and a
child may be ``visible`` again.  ``aria-hidden`` hides from screen readers only.
The text of svg and math is visible, but not what ``UNDRAWN`` names inside them
(titles, descriptions, definitions, annotations); in svg the display and
visibility attributes count as well, and each piece of text with a place of its
own is set off by a blank.

Defined results: a null page has a null text; an empty page, or one without
visible text, an empty text; markup of any nesting depth is rendered without
recursion; repeated rows are rendered row by row; an empty table gives an empty
result; other columns are kept, and a column named like the result is replaced.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import need
from .textkernel import text_slices

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
            "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
            "summary table tbody tfoot thead tr ul caption".split())
SPACED = set("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre hr fieldset figure".split())
HEAD_ONLY = set("base link meta title style script noscript template".split())
INVISIBLE = set("head script style template noscript title meta link base iframe object audio video canvas datalist "
                "col colgroup param source track".split())
#: Not drawn inside svg or math (tags in lower case, as the parser gives them).
UNDRAWN = set("title desc metadata defs symbol clippath mask pattern marker lineargradient radialgradient filter "
              "annotation annotation-xml mphantom".split())
FORMATTING = set("a b big code em font i nobr s small strike strong tt u".split())
#: Inputs that show no text.
TEXTLESS = set("hidden checkbox radio password file color range".split())
#: The most columns and rows that a cell spans, as the HTML standard has it.
SPANS = {"colspan": 1000, "rowspan": 65534}
LISTS = {"ul", "ol", "menu", "dir"}
#: A start tag closes the nearest of these if no boundary is nearer.
CLOSES = {
    **dict.fromkeys("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
                    "h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split(), ({"p"}, {"button", "td", "th", "table"})),
    "li": ({"li"}, {"ul", "ol", "menu", "dir", "table"}),
    "dt": ({"dt", "dd"}, {"dl", "table"}), "dd": ({"dt", "dd"}, {"dl", "table"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"optgroup", "option"}, {"select"}),
    "tr": ({"tr", "caption"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "caption"}, {"table"}), "thead": ({"tbody", "thead", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "caption"}, {"table"}),
}
_STYLES = re.compile(r"(?:^|;)\s*(display|visibility|content-visibility)\s*:\s*([a-z-]+)", re.I)
_BLANK = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict | None = None):
        self.tag, self.attrs, self.children = tag, attrs or {}, []

    def look(self, shown: bool, drawing: bool) -> tuple[bool, bool, bool]:
        """(in the layout, own text visible, inside svg or math), from the parent's visibility and place."""
        a, tag = self.attrs, self.tag
        if (tag in INVISIBLE or "hidden" in a or (drawing and tag in UNDRAWN)
                or (tag == "input" and (a.get("type") or "").lower() == "hidden")):
            return False, False, False
        drawing = (drawing or tag in ("svg", "math")) and tag != "foreignobject"
        styles = {k: (a.get(k) or "").strip().lower() for k in ("display", "visibility") if drawing and k in a}
        if a.get("style"):
            styles.update((k.lower(), v.lower()) for k, v in _STYLES.findall(a["style"]))
        if styles.get("display") == "none" or styles.get("content-visibility") == "hidden":
            return False, False, False
        given = styles.get("visibility")
        if given in ("hidden", "collapse"):
            shown = False
        elif given in ("visible", "initial"):
            shown = True
        return True, shown, drawing


class TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html")
        self.open = [self.root]
        self.count: dict[str, int] = {}     # open elements by tag
        self.body = False

    def _cut(self, at: int) -> None:
        """Close the open elements from a place on."""
        for node in self.open[at:]:
            self.count[node.tag] -= 1
        del self.open[at:]

    def _nearest(self, tags: set, bounds: set) -> int | None:
        """Place of the innermost open element of these, if no boundary is nearer."""
        if not any(self.count.get(t) for t in tags):
            return None
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in tags:
                return i
            if self.open[i].tag in bounds:
                return None
        return None

    def _close(self, tags: set, bounds: set) -> None:
        at = self._nearest(tags, bounds)
        if at is not None:
            self._cut(at)

    def _end_inline(self, at: int) -> None:
        """Close an inline element; the first block opened in it stays open beside it, with a copy of the element around
        what it holds so far and copies of the elements between around itself."""
        block = next((i for i in range(at + 1, len(self.open)) if self.open[i].tag in BLOCK), None)
        if block is None:
            self._cut(at)
            return
        ended, node, parent, between = self.open[at], self.open[block], self.open[at - 1], []
        self.open[block - 1].children.pop()
        for old in self.open[at + 1:block]:
            between.append(Node(old.tag, old.attrs))
            parent.children.append(between[-1])
            parent = between[-1]
        parent.children.append(node)
        if node.children:
            held = Node(ended.tag, ended.attrs)
            held.children, node.children = node.children, [held]
        self.open[at:block] = between
        self.count[ended.tag] -= 1

    def _push(self, tag: str, attrs: dict | None = None) -> None:
        node = Node(tag, attrs)
        self.open[-1].children.append(node)
        self.open.append(node)
        self.count[tag] = self.count.get(tag, 0) + 1

    def _enter_body(self) -> None:
        if not self.body:
            self._cut(1)
            self._push("body")
            self.body = True

    def handle_starttag(self, tag: str, attrs: list) -> None:
        given = dict(attrs)
        if tag == "html":
            self.root.attrs = given | self.root.attrs
            return
        if tag == "head":
            if not self.body and len(self.open) == 1:
                self._push("head", given)
            return
        if tag == "body":
            self._enter_body()
            self.open[1].attrs = given | self.open[1].attrs
            return
        if not self.body:
            if tag in HEAD_ONLY:
                if len(self.open) == 1:
                    self._push("head")
            else:
                self._enter_body()
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        if tag in ("tr", "td", "th") and self.open[-1].tag == "table":
            self._push("tbody")
        if tag in ("td", "th") and self.open[-1].tag in ("tbody", "thead", "tfoot"):
            self._push("tr")
        self._push(tag, given)
        if tag in VOID:
            self._cut(len(self.open) - 1)
        elif tag == "textarea" and not self._drawing():
            self.set_cdata_mode(tag)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if self.open[-1].tag == tag and self._drawing():
            self._cut(len(self.open) - 1)

    def _drawing(self) -> bool:
        """Whether the innermost open element is svg or math, or stands inside one."""
        if self.count.get("svg") or self.count.get("math"):
            for node in reversed(self.open):
                if node.tag in ("svg", "math"):
                    return True
                if node.tag == "foreignobject" and node is not self.open[-1]:
                    return False
        return False

    def handle_endtag(self, tag: str) -> None:
        if tag in ("html", "body"):
            return
        if tag == "p" and not self.count.get("p"):
            self._enter_body()
            self.open[-1].children.append(Node("p"))
            return
        if tag == "br":
            self.handle_starttag("br", [])
            return
        bounds = {"td", "th", "table"} if tag not in ("td", "th", "tr", "table", "tbody", "thead", "tfoot") else {"table"} - {tag}
        at = self._nearest({tag}, bounds - {tag})
        if at is not None:
            self._end_inline(at) if tag in FORMATTING else self._cut(at)

    def close(self) -> None:
        if self.cdata_elem == "textarea" and self.rawdata:  # never closed: the rest of the page is its text
            rest, self.rawdata = self.rawdata, ""
            self.handle_data(rest)
        super().close()

    def handle_data(self, data: str) -> None:
        if not self.body and self.open[-1].tag in ("html", "head"):
            if not data.strip():
                return
            self._enter_body()
        if self.cdata_elem == "textarea" and not hasattr(HTMLParser, "RCDATA_CONTENT_ELEMENTS"):
            data = unescape(data)
        self.open[-1].children.append(data)


def places(text: str) -> int:
    """Width of a text on a terminal."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) or unicodedata.category(c) == "Cf" else 1 + (unicodedata.east_asian_width(c) in "WF")
               for c in text)


def _span(node: Node, name: str) -> int:
    """Columns or rows of a cell; 0 rows are all that follow."""
    given = re.match(r"[ \t\n\f\r]*\+?([0-9]{1,9})", node.attrs.get(name) or "")
    n = int(given[1]) if given else 1
    return SPANS[name] if name == "rowspan" and n == 0 else min(max(n, 1), SPANS[name])


class _Flow:
    """Lines of text; ``gap`` is the number of line ends owed before the next word."""

    def __init__(self):
        self.lines, self.line, self.gap, self.blank, self.indent, self.mark = [], "", 0, False, "", ""

    def break_(self, n: int) -> None:
        if self.line:
            self.lines.append(self.line.rstrip())
            self.line, self.blank = "", False
            self.gap = max(self.gap, n - 1)
        elif self.lines:
            self.gap = max(self.gap, n - 1)
        self.blank = False

    def _open(self) -> None:
        if not self.line:
            if self.lines:
                self.lines.extend([""] * self.gap)
            self.gap = 0
            self.line = self.indent[:len(self.indent) - len(self.mark)] + self.mark if self.mark else self.indent
            self.mark = ""

    def text(self, data: str) -> None:
        words = _BLANK.sub(" ", data)
        bare = words.strip(" ")
        if not bare:
            self.blank = self.blank or bool(words and self.line)
            return
        if self.line and (self.blank or words[0] == " ") and not self.line.endswith(" "):
            self.line += " "
        self._open()
        self.line += bare
        self.blank = words[-1] == " "

    def raw(self, data: str) -> None:
        for i, part in enumerate(data.split("\n")):
            if i:
                self._open()
                self.lines.append(self.line.rstrip())
                self.line = ""
            if part:
                self._open()
                self.line += part

    def table(self, rows: list[list[tuple[str, int, int]]]) -> None:
        """Aligned cells (text, columns, rows); a cell goes to the first column that no cell from above still takes."""
        taken: dict[int, int] = {}          # column: rows that a cell from above still takes there
        placed: list[list[tuple[int, int, list[str]]]] = []
        for row in rows:
            line, at, below = [], 0, {c: n - 1 for c, n in taken.items() if n > 1}
            for text, across, down in row:
                while at in taken:
                    at += 1
                line.append((at, across, text.split("\n")))
                if down > 1:
                    below.update(dict.fromkeys(range(at, at + across), down - 1))
                at += across
            placed.append(line)
            taken = below
        widths = [0] * max((at + across for row in placed for at, across, _ in row), default=0)
        for at, across, lines in sorted((c for row in placed for c in row), key=lambda c: c[1]):
            have = sum(widths[at:at + across]) + 2 * (across - 1)
            widths[at + across - 1] += max(0, max(map(places, lines)) - have)
        starts = [0]
        for wide in widths:
            starts.append(starts[-1] + wide + 2)
        for row in placed:
            for k in range(max((len(lines) for _, _, lines in row), default=0)):
                line, end = "", 0
                for at, _, lines in row:
                    if k < len(lines) and lines[k]:
                        line += " " * (starts[at] - end) + lines[k]
                        end = starts[at] + places(lines[k])
                if line.strip():
                    self._open()
                    self.line += line.rstrip()
                    self.break_(1)

    def result(self) -> str:
        self.break_(1)
        return "\n".join(self.lines)


def _placed(node: Node) -> bool:
    """Whether an element of a drawing starts text at a place of its own."""
    return node.tag == "text" or (node.tag == "tspan" and not node.attrs.keys().isdisjoint(("x", "y", "dx", "dy")))


def render(root: Node) -> str:
    """Visible text of a tree; an explicit stack, so depth does not matter."""
    flow, pre = _Flow(), 0
    flows: list[_Flow] = []
    tables: list[list[list[tuple[str, int, int]]]] = []
    lists: list[list] = []
    stack: list = [("in", root, True, False)]
    while stack:
        step, node, shown, drawing = stack.pop()
        if step == "in":
            if isinstance(node, str):
                if shown:
                    flow.raw(node) if pre else flow.text(node)
                continue
            laid, shown, drawing = node.look(shown, drawing)
            if not laid:
                continue
            tag = node.tag
            if tag == "br":
                flow._open() if not flow.line and flow.lines and flow.gap == 0 else None
                flow.break_(1)
                continue
            if tag == "img":
                flow.text(node.attrs.get("alt") or "" if shown else "")
                continue
            if tag == "input":
                kind = (node.attrs.get("type") or "").lower()
                value = node.attrs.get("alt" if kind == "image" else "value") or node.attrs.get("placeholder")
                flow.text(f" {value} " if shown and value and kind not in TEXTLESS else "")
                continue
            if drawing and _placed(node):
                flow.text(" ")
            if tag in ("td", "th") and tables:
                flows.append(flow)
                flow = _Flow()
            elif tag == "table":
                flow.break_(2)
                tables.append([])
            elif tag == "tr" and tables:
                tables[-1].append([])
            elif tag == "caption" and tables:
                flow.break_(1)
            elif tag in BLOCK:
                nested = tag in LISTS and bool(lists)
                flow.break_(2 if tag in SPACED and not nested else 1)
            if tag in ("pre", "textarea"):
                pre += 1
            elif tag in LISTS:
                start = node.attrs.get("start") or ""
                lists.append([tag, int(start) if start.isdigit() and len(start) < 10 else 1])
                flow.indent += "   " if tag == "ol" else "  "
            elif tag == "li":
                kind = lists[-1] if lists else ["ul", 1]
                if not lists:
                    flow.indent += "  "
                if shown:
                    flow.mark = f"{kind[1]}. " if kind[0] == "ol" else "- "
                kind[1] += 1
            elif tag in ("blockquote", "dd"):
                flow.indent += "  "
            elif tag == "hr":
                flow.text("---" if shown else "")
                flow.break_(2)
            stack.append(("out", node, shown, drawing))
            stack.extend(("in", c, shown, drawing) for c in reversed(node.children))
            continue
        tag = node.tag
        if drawing and _placed(node):
            flow.text(" ")
        if tag in ("td", "th") and tables:
            if not tables[-1]:
                tables[-1].append([])
            cell, flow = flow.result(), flows.pop()
            tables[-1][-1].append((cell, _span(node, "colspan"), _span(node, "rowspan")))
        elif tag == "table":
            flow.table(tables.pop())
            flow.break_(2)
        elif tag in BLOCK and tag != "tr":
            nested = tag in LISTS and len(lists) > 1
            flow.break_(2 if tag in SPACED and not nested else 1)
        if tag in ("pre", "textarea"):
            pre -= 1
        elif tag in LISTS:
            flow.indent = flow.indent[:-3 if lists.pop()[0] == "ol" else -2]
        elif tag == "li":
            flow.mark = ""
            if not lists:
                flow.indent = flow.indent[:-2]
        elif tag in ("blockquote", "dd"):
            flow.indent = flow.indent[:-2]
    return flow.result()


def visible_text(html: str) -> str:
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    return render(builder.root)


def with_text(pages: DataFrame, html_col: str = "html", name: str = "text") -> DataFrame:
    """All columns of ``pages`` and the page's visible text as the last column ``name``."""
    need(pages, html_col)
    src = pages.drop(name) if name != html_col else pages
    schema = src.select("*", F.lit(None).cast("string").alias(name)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, html_col):
                texts = [None if h is None else visible_text(h) for h in part.column(html_col).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, name])

    return src.mapInArrow(run, schema)
