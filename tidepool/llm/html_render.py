"""Layout-aware HTML rendering: all visible text with its block structure.

A tokenizer feeds a tree builder that knows void elements, raw-text elements, implied end tags
(``<p>`` before a block, ``<li>`` before ``<li>``, table parts) and implied closing of whatever is
open inside a closed element. The tree is rendered with an explicit stack (nesting depth is not
limited): blocks on lines of their own, blank lines around paragraphs and headings, list items
with bullets or numbers and indentation, ``<pre>`` as it is, table cells aligned in columns.
Formulas give the text of their parts, drawings that of their labels, a text area its default text.
An input shows its value if its kind does (buttons and text fields), each option is a line.
Hidden: head, script, style, template, noscript, title, datalist, the fallback contents of
iframe, noembed, noframes, object, audio, video and canvas, annotations and phantoms of formulas, what
a drawing does not paint by itself (``defs``, ``symbol`` and the like), ``hidden`` attributes, ``display:none``, ``visibility:hidden`` (unless a descendant turns visible), closed ``details``.

Edge cases: null HTML gives null, empty HTML an empty text; markup that is cut off anywhere is
rendered as far as it goes; an unknown tag is inline; a stray end tag is ignored (found in constant
time); very long pages are rendered whole: no text is cut, while indentation, gaps, spans and the depth of
aligned tables are bounded, so time and output grow with the page; repeated rows
are rows of their own; an empty table gives an empty result; further columns are carried.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator, Sequence
from functools import partial
from html import unescape

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidepool.llm.common import packed_row

cloudpickle.register_pickle_by_value(sys.modules[__name__])

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
#: Elements without visible text.
UNSEEN = frozenset("head script style template noscript title iframe noembed noframes "
                   "datalist object audio video canvas".split())
#: The same inside svg and inside math.
UNDRAWN = frozenset("defs symbol clippath mask pattern marker metadata desc lineargradient radialgradient "
                    "filter".split())
UNSET = frozenset("annotation annotation-xml mphantom".split())
#: Start tags that end an open svg or math, and elements inside those that hold HTML.
BREAKOUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li "
                     "listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul "
                     "var".split())
HOLDS_HTML = frozenset("foreignobject desc title annotation-xml mtext mi mo mn ms".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset "
                  "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main "
                  "menu nav ol p pre section summary table ul caption tr thead tbody tfoot td th xmp".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure fieldset hr menu dir xmp".split())
#: Elements on lines of their own: blocks, text areas, labels of drawings.
LINES = BLOCK | frozenset(("textarea", "option", "optgroup", "#label"))
CELLS = frozenset(("td", "th"))
GROUPS = frozenset(("thead", "tbody", "tfoot"))
#: Start tags that end an open paragraph.
ENDS_P = BLOCK - frozenset("body html caption tr thead tbody tfoot td th legend summary dd dt li".split()) \
    | frozenset(("dd", "dt", "li"))
#: Start tags that leave an open head open.
IN_HEAD = frozenset("head title meta link base basefont bgsound script style template noscript noframes".split())
#: start tag -> (open elements it ends, elements that stop the search)
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select", "datalist")),
    "optgroup": (("option", "optgroup"), ("select",)),
    "tr": (("tr", "caption"), ("table",)),
    "td": (("td", "th"), ("table", "tr")),
    "th": (("td", "th"), ("table", "tr")),
    "thead": (("thead", "tbody", "tfoot", "caption"), ("table",)),
    "tbody": (("thead", "tbody", "tfoot", "caption"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot", "caption"), ("table",)),
}
#: An end tag does not close elements beyond these unless it names one of them.
SCOPES = frozenset(("table", "td", "th", "caption", "button", "body", "html"))

#: A quote opens a quoted value only directly after '='; elsewhere in a tag it is a character.
VALUE = r"\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"'][^\s>]*+"
MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)"
                    rf"((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:{VALUE})?)?)*+)>?", re.DOTALL)
ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"?|'([^']*+)'?|([^\s>\"'][^\s>]*+))?)?")
WHITE = re.compile(r"[ \t\n\r\f]+")
#: Widest cell that its column is padded to, widest gap before a cell, and widest indentation: beyond
#: them text is kept and only less far to the right, so a page's text stays in proportion to its words.
PAD_WIDTH = 60
GAP_WIDTH = 240
MAX_INDENT = 80
#: Largest colspan or rowspan that counts, and depth of tables in tables beyond which cells are lines.
MAX_SPAN = 100
MAX_TABLES = 8
#: Kinds of input whose value a browser shows.
SHOWN_INPUTS = frozenset(("submit", "button", "reset", "text", "search", "email", "url", "tel", "number"))


class Node:
    __slots__ = ("tag", "attrs", "items")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.items = tag, attrs, []


def attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(raw):
        value = next((g for g in m.groups()[1:] if g is not None), "")
        out.setdefault(m[1].lower(), unescape(value))
    return out


def build(html: str) -> Node:
    """Tree of nodes and text strings."""
    root = Node("#root", {})
    stack = [root]
    #: Depths of the open elements of a tag, of those that stop an end tag, and of those that hold HTML.
    open_at: dict[str, list[int]] = {}
    scopes: list[int] = []
    holders: list[int] = []

    def last(tag: str) -> int:
        held = open_at.get(tag)
        return held[-1] if held else 0

    def push(node: Node) -> None:
        depth = len(stack)
        stack.append(node)
        open_at.setdefault(node.tag, []).append(depth)
        if node.tag in SCOPES:
            scopes.append(depth)
        if node.tag in HOLDS_HTML or node.tag in BLOCK:
            holders.append(depth)

    def close_to(depth: int) -> None:
        """Close the element at ``depth`` and all inside it."""
        while len(stack) > depth:
            node = stack.pop()
            open_at[node.tag].pop()
            for held in (scopes, holders):
                if held and held[-1] == len(stack):
                    held.pop()

    def imply(names: Sequence[str], stops: Sequence[str]) -> None:
        stop = max((last(t) for t in stops), default=0)
        # a row's cells, a group's rows end with it, so go on outwards
        while (depth := max(last(n) for n in names)) > stop:
            close_to(depth)

    def close_p() -> None:
        depth = last("p")
        if depth and not (scopes and scopes[-1] > depth):
            close_to(depth)

    def leave_foreign() -> None:
        """Close an svg or math that a start tag of HTML stands in."""
        stop = holders[-1] if holders else 0
        while (depth := max(last("svg"), last("math"))) > stop:
            close_to(depth)

    def text(s: str) -> None:
        if stack[-1].tag == "head" and WHITE.sub("", s):
            close_to(len(stack) - 1)
        stack[-1].items.append(unescape(s))

    at, end, low = 0, len(html), None
    while at < end:
        m = MARKUP.search(html, at)
        if m is None:
            text(html[at:])
            break
        if m.start() > at:
            text(html[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            depth = last(tag)
            if depth and (not scopes or scopes[-1] <= depth or tag in SCOPES or tag in ("tr", *GROUPS)):
                close_to(depth)
            continue
        if tag == "body":
            imply(("head",), ())
        elif stack[-1].tag == "head" and tag not in IN_HEAD:
            close_to(len(stack) - 1)
        foreign = last("svg") or last("math")
        if foreign and tag in BREAKOUT:
            leave_foreign()
        elif foreign and m[3] and m[3].endswith("/"):
            stack[-1].items.append(Node(tag, attributes(m[3])))
            continue
        if tag in ENDS_P:
            close_p()
        if tag in IMPLIED:
            imply(*IMPLIED[tag])
        node = Node(tag, attributes(m[3]) if m[3] else {})
        stack[-1].items.append(node)
        if tag in RAW:
            if low is None:
                low = html.lower() if len(html.lower()) == len(html) else re.sub(
                    "[A-Z]", lambda c: c[0].lower(), html)
            stop = low.find(f"</{tag}", at)
            stop = end if stop < 0 else stop
            if tag == "xmp":
                node.items.append(html[at:stop])
            elif tag == "textarea":
                node.items.append(unescape(html[at:stop]))
            close = html.find(">", stop)
            at = end if close < 0 else close + 1
        elif tag not in VOID and not (m[3] and m[3].endswith("/") and tag not in BLOCK and tag not in ("a", "b", "i", "span")):
            push(node)
    return root


class Canvas:
    """Lines of text with collapsing white space and pending block spacing."""

    def __init__(self):
        self.lines: list[str] = []
        self.cur: list[str] = []
        self.space = False  # a collapsed space waits for the next word
        self.gap = 0  # blank lines due before the next text
        self.indent = 0
        self.bullet = ""

    def text(self, s: str) -> None:
        if not s:
            return
        words = WHITE.sub(" ", s)
        if words == " ":
            self.space = self.space or bool(self.cur)
            return
        lead = self.space or words[0] == " "
        body = words.strip(" ")
        if not self.cur:
            self._begin()
        elif lead:
            self.cur.append(" ")
        self.cur.append(body)
        self.space = words[-1] == " "

    def _begin(self) -> None:
        if self.lines and self.gap:
            self.lines.extend([""] * self.gap)
        self.gap = 0
        pad = " " * min(self.indent, MAX_INDENT)
        if self.bullet:
            pad = pad[:max(0, len(pad) - len(self.bullet))] + self.bullet
            self.bullet = ""
        self.cur.append(pad)

    def line_end(self, forced: bool = False) -> None:
        if self.cur:
            self.lines.append("".join(self.cur).rstrip(" "))
            self.cur = []
        elif forced and self.lines:
            self.gap += 1
        self.space = False

    def block(self, blank: bool) -> None:
        self.line_end()
        if blank:
            self.gap = max(self.gap, 1)

    def exact(self, s: str) -> None:
        """Preformatted text: its lines as they are."""
        for i, line in enumerate(s.split("\n")):
            if i:
                if not self.cur:
                    self._begin()
                self.lines.append("".join(self.cur).rstrip(" "))
                self.cur = []
            if line:
                if not self.cur:
                    self._begin()
                self.cur.append(line)

    def done(self) -> list[str]:
        self.line_end()
        return self.lines


def hides(node: Node) -> bool:
    style = node.attrs.get("style", "")
    return (node.tag in UNSEEN or "hidden" in node.attrs or bool(style) and "display:none" in WHITE.sub("", style.lower()))


def visibility(node: Node, inherited: bool) -> bool:
    style = node.attrs.get("style")
    if style:
        flat = WHITE.sub("", style.lower())
        if "visibility:hidden" in flat or "visibility:collapse" in flat:
            return False
        if "visibility:visible" in flat:
            return True
    return inherited


def number(text: str | None, default: int) -> int:
    try:
        return int((text or "").strip()[:12])
    except ValueError:
        return default


def span(text: str | None) -> int:
    return min(max(number(text, 1), 1), MAX_SPAN)


Cell = tuple[list[str], int, int]


def place_cells(rows: list[list[Cell]]) -> list[list[tuple[int, int, list[str]]]]:
    """(column, width in columns, lines) of every cell; a cell that spans rows keeps its columns in
    the rows below."""
    out, busy = [], []  # busy: [first column, end, rows left], by column
    for row in rows:
        placed, taken, at, column = [], [], 0, 0
        for lines, wide, high in row:
            while at < len(busy) and busy[at][0] <= column:
                column = max(column, busy[at][1])
                at += 1
            placed.append((column, wide, lines))
            if high > 1:
                taken.append([column, column + wide, high])
            column += wide
        busy = sorted([b[0], b[1], b[2] - 1] for b in [*([x for x in busy if x[2] > 1]), *taken] if b[2] > 1)
        out.append(placed)
    return out


def table_lines(rows: list[list[Cell]]) -> list[str]:
    """Cells side by side. A column is as wide as its widest cell of one column, up to ``PAD_WIDTH``; columns
    that no cell starts in take no room. What does not fit moves the rest of its row to the right."""
    grid = place_cells(rows)
    widths = {column: 0 for row in grid for column, _, _ in row}
    for row in grid:
        for column, wide, lines in row:
            if wide == 1:
                widths[column] = max(widths[column], min(max((len(x) for x in lines), default=0), PAD_WIDTH))
    begin, total = {}, 0
    for column in sorted(widths):
        begin[column], total = total, total + widths[column] + 2
    out = []
    for row in grid:
        for k in range(max((len(lines) for _, _, lines in row), default=0)):
            parts, end, shift = [], 0, 0
            for column, _, lines in row:
                if k >= len(lines) or not lines[k]:
                    continue
                start = max(begin[column] + shift, end + 2 if parts else 0)
                gap = min(start - end, GAP_WIDTH)
                parts.append(" " * gap + lines[k])
                end += gap + len(lines[k])
                shift = end - len(lines[k]) - begin[column]
            out.append("".join(parts).rstrip(" "))
    return out


def render(html: str | None) -> str | None:
    """Visible text of a page."""
    if html is None:
        return None
    canvas = Canvas()
    canvases, tables, lists = [canvas], [], []
    work: list[tuple] = [("node", build(html), True, False, "")]
    while work:
        # inside: "" in HTML, "svg" where a drawing has no text, "label" in its labels, "math"
        kind, node, seen, pre, inside = work.pop()
        canvas = canvases[-1]
        if kind == "text":
            if seen and inside != "svg":
                canvas.exact(node) if pre else canvas.text(node)
            continue
        if kind == "leave":
            _leave(node, canvases, tables, lists)
            continue
        if hides(node) or node.tag in UNDRAWN and inside in ("svg", "label") or node.tag in UNSET and inside == "math":
            continue
        tag, seen = node.tag, visibility(node, seen)
        if tag == "br":
            canvas.line_end(forced=True)
            continue
        if tag == "input":
            if seen and inside != "svg" and node.attrs.get("type", "text").strip().lower() in SHOWN_INPUTS:
                canvas.text(f" {node.attrs.get('value', '')} ")
            continue
        if tag in ("svg", "math"):
            inside = tag
        elif inside == "svg" and tag == "text":
            inside, node.tag = "label", "#label"
        elif inside == "svg" and tag == "foreignobject":
            inside, node.tag = "", "div"
        _enter(node, canvases, tables, lists)
        items = node.items
        if tag == "details" and "open" not in node.attrs:
            items = [x for x in items if isinstance(x, Node) and x.tag == "summary"][:1]
        pre = pre or tag in ("pre", "xmp", "textarea")
        if tag in ("pre", "textarea") and items and isinstance(items[0], str) and items[0].startswith("\n"):
            items = [items[0][1:], *items[1:]]
        work.append(("leave", node, seen, pre, inside))
        held = [("text" if isinstance(x, str) else "node", x, seen, pre, inside) for x in items]
        if tag in ("table", "tr", *GROUPS):  # white space between table parts is not text
            held = [w for w in held if w[0] == "node" or WHITE.sub("", w[1])]
        work.extend(reversed(held))
    return "\n".join(canvases[0].done())


def _enter(node: Node, canvases: list[Canvas], tables: list, lists: list) -> None:
    tag, canvas = node.tag, canvases[-1]
    if tag in CELLS and tables and tables[-1][1] == len(canvases) and tables[-1][0] is not None:
        if not tables[-1][0]:
            tables[-1][0].append([])
        canvases.append(Canvas())
        return
    if tag in LINES:
        canvas.block(tag in SPACED and not (tag in ("ul", "ol", "menu", "dir") and lists))
    if tag == "table":
        tables.append(([] if len(tables) < MAX_TABLES else None, len(canvases)))
    elif tag == "tr" and tables and tables[-1][0] is not None:
        tables[-1][0].append([])
    elif tag in ("ul", "ol", "menu", "dir"):
        lists.append([number(node.attrs.get("start"), 1) if tag == "ol" else None, canvas.indent])
    elif tag == "li":
        mark = "* "
        if lists and lists[-1][0] is not None:
            lists[-1][0] = number(node.attrs.get("value"), lists[-1][0])
            mark = f"{lists[-1][0]}. "
            lists[-1][0] += 1
        canvas.indent += max(2, len(mark))
        canvas.bullet = mark
        node.attrs["#indent"] = str(max(2, len(mark)))
    elif tag in ("blockquote", "dd"):
        canvas.indent += 2


def _leave(node: Node, canvases: list[Canvas], tables: list, lists: list) -> None:
    tag = node.tag
    if tag in CELLS and len(canvases) > 1 and tables and tables[-1][1] == len(canvases) - 1 \
            and tables[-1][0] is not None:
        cell = canvases.pop().done()
        tables[-1][0][-1].append((cell, span(node.attrs.get("colspan")), span(node.attrs.get("rowspan"))))
        return
    canvas = canvases[-1]
    if tag == "table":
        rows, _ = tables.pop()
        canvas.block(True)
        for line in table_lines([r for r in rows or [] if any(lines for lines, _, _ in r)]):
            if line:
                canvas.exact(line)
                canvas.line_end()
            else:
                canvas.lines.append("")
    elif tag in ("ul", "ol", "menu", "dir"):
        lists.pop()
    elif tag == "li":
        canvas.line_end()
        canvas.bullet = ""
        canvas.indent -= int(node.attrs["#indent"])
    elif tag in ("blockquote", "dd"):
        canvas.line_end()
        canvas.indent -= 2
    if tag in LINES:
        canvas.block(tag in SPACED and not (tag in ("ul", "ol", "menu", "dir") and lists))


def _render_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column("_row"), pa.array([render(h.as_py()) for h in batch.column("_html")], pa.string())],
            ["_row", "text"])


def render_pages(pages: DataFrame, html: str = "html", carry: Sequence[str] | None = None) -> DataFrame:
    """``carry`` columns (default: all others; one called ``text``, in any case, is replaced) with the
    visible ``text`` of each page."""
    carry = [c for c in pages.columns if c.lower() != html.lower()] if carry is None else list(carry)
    rows = pages.select(F.col(html).alias("_html"), packed_row(carry))
    done = rows.mapInArrow(_render_batches, StructType([rows.schema["_row"]]).add("text", "string"))
    return done.select(*[F.col("_row").getField(c).alias(c) for c in carry if c.lower() != "text"], "text")
