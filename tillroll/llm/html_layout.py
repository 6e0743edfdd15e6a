"""Visible text of HTML pages, laid out: blocks on lines of their own, lists, aligned table cells.

Python's tokenizer feeds a tree builder that keeps the open elements, adds the tags that HTML
implies (a paragraph ends where a block begins, a cell begins a row, ...) and closes what a page
leaves open.  Each element that makes lines has a box; closing it lays its lines into the box
around it.  So the tree is never held as a whole and nesting of any depth needs no recursion.

Visible is what a browser shows without scripts being run: not the head, scripts, styles, templates, closed
dialogs, closed details beyond their summary, nor what ``hidden``, ``display: none`` or
``visibility: hidden`` take away.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import extend

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
UNSEEN = frozenset("head title script style template noscript iframe object audio video canvas datalist".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu blockquote pre table figure hr".split())
TABLE = frozenset("table caption colgroup thead tbody tfoot tr td th".split())
BLOCKS = SPACED | TABLE | frozenset(
    "html body div section article aside nav header footer main address form fieldset legend li dt dd "
    "figcaption details summary dialog hgroup search center option optgroup".split())
LISTS = ("ul", "ol", "menu")
# tag: (what it ends, where the search for that stops)
_CELLS, _ROWS = ("td", "th"), ("tr", "td", "th")
IMPLIED_END = {
    "li": (("li",), LISTS), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "td": (_CELLS, ("table", "tr")), "th": (_CELLS, ("table", "tr")), "tr": (_ROWS, ("table",)),
    **dict.fromkeys(("thead", "tbody", "tfoot"), (("thead", "tbody", "tfoot", "caption", "colgroup", *_ROWS), ("table",))),
    "option": (("option",), ("select", "datalist")), "optgroup": (("option", "optgroup"), ("select",)),
    "body": (("head",), ("html",)),
}
# what may stand in a head; anything else ends it, also without </head> and <body>
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
PARAGRAPH_SCOPE = frozenset(("td", "th", "caption", "button", "table"))
_NO_SHOW = re.compile(r"display\s*:\s*none", re.I)
_VISIBILITY = re.compile(r"visibility\s*:\s*(hidden|collapse|visible)", re.I)
_GAPS = re.compile(r"[ \t\n\r\f]+")


class Box:
    """Lines made so far, the open line, and the blank line that the next block wants."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.open: list[str] = []
        self.space = False

    def write(self, text: str) -> None:
        if text == " " and (not self.open or self.open[-1].endswith(" ")):
            return
        if text[:1] == " " and (not self.open or self.open[-1].endswith(" ")):
            text = text[1:]
        self.open.append(text)

    def end_line(self, always: bool = False) -> None:
        line = "".join(self.open).rstrip(" ")
        if line or always:
            self._gap()
            self.lines.append(line)
        self.open = []

    def _gap(self) -> None:
        if self.space and self.lines and self.lines[-1]:
            self.lines.append("")
        self.space = False

    def block(self, lines: list[str], spaced: bool) -> None:
        """Lines of an inner block below what is there; a spaced one keeps a blank line around it."""
        self.end_line()
        if not lines:
            return
        self.space |= spaced
        self._gap()
        if self.lines:
            self.lines.extend(lines)
        else:
            self.lines = lines
        self.space = spaced


@dataclass
class Node:
    tag: str
    box: Box
    own: bool                   # the box is its own
    shown: bool                 # displayed
    visible: bool               # not hidden by visibility
    attrs: dict
    keep_gaps: bool = False     # inside pre
    rows: list = field(default_factory=list)     # of a table: rows of cells; of a row: cells
    count: int = 0              # of a list: items so far
    closed: int = 0             # of a table: rows whose group has ended


Cell = tuple[list[str], int, int]      # lines, columns spanned, rows spanned (0: the rest of its group)


def within_group(rows: list[list[Cell]]) -> list[list[Cell]]:
    """The rows of a group, none of whose cells reach below its last row."""
    return [[(lines, span, min(down or len(rows) - r, len(rows) - r)) for lines, span, down in row]
            for r, row in enumerate(rows)]


def table_lines(rows: list[list[Cell]]) -> list[str]:
    """Rows of cells as text in aligned columns, three spaces apart.

    A cell takes the first column that no cell above reaches into.  The lines of one that spans
    rows go on beside those rows; what is left over makes the last of them longer.
    """
    widths: list[int] = []
    free: list[int] = []                # per column the first row that no cell above reaches into
    heights = [0] * len(rows)
    placed: list[list[tuple[int, int, list[str]]]] = []
    spanning = []
    for r, row in enumerate(within_group(rows)):
        at = 0
        placed.append([])
        for lines, span, down in row:
            while at < len(free) and free[at] > r:
                at += 1
            new = [0] * (at + span - len(widths))
            widths += new
            free += new
            free[at : at + span] = [max(x, r + down) for x in free[at : at + span]]
            if span == 1:
                widths[at] = max(widths[at], max(map(len, lines), default=0))
            placed[r].append((at, span, lines))
            heights[r] = max(heights[r], len(lines) if down == 1 else min(1, len(lines)))
            if down > 1 and lines:
                spanning.append((r + down - 1, r, len(lines)))
            at += span
    for last, r, size in sorted(spanning):
        room = 0
        for k in range(r, last + 1):
            room += heights[k]
            if room >= size:
                break
        else:
            heights[last] += size - room
    out = []
    over: list[tuple[int, int, list[str]]] = []         # cells from above with lines left
    for height, starts in zip(heights, placed, strict=True):
        cells = sorted([*over, *starts], key=lambda c: c[0]) if over else starts
        for k in range(height):
            line, to = "", 0
            for at, span, lines in cells:
                if at > to:
                    line += " " * (sum(widths[to:at]) + 3 * (at - to))
                size = sum(widths[at : at + span]) + 3 * (span - 1)
                line += (lines[k] if k < len(lines) else "").ljust(size) + "   "
                to = at + span
            out.append(line.rstrip())
        over = [(at, span, lines[height:]) for at, span, lines in cells if len(lines) > height]
    return out


class Layout(HTMLParser):
    """Tree builder and renderer; ``text()`` ends the page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes = [Node("#page", Box(), True, True, True, {})]
        self.count = Counter()      # open elements by tag: most searches find nothing to close

    # tree building

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.nodes[-1].tag == "head" and tag not in IN_HEAD:
            if tag in ("html", "head"):
                return
            self._end(*IMPLIED_END["body"])
        if tag == "br":
            if self._seen():
                self.nodes[-1].box.end_line(always=True)
            return
        if tag in BLOCKS and tag not in TABLE - {"table"}:
            self._end(("p",), PARAGRAPH_SCOPE)
        if tag in IMPLIED_END:
            self._end(*IMPLIED_END[tag])
        if tag in _CELLS and self._nearest(("tr", "table")) == "table":
            self._open("tr", {})
        if tag in VOID:
            if tag == "hr" and self._seen():
                self.nodes[-1].box.block(["---"], True)
            return
        self._open(tag, {k: v or "" for k, v in attrs})

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.handle_starttag(tag, [])
        elif tag in TABLE:
            self._end((tag,), ("table",) if tag != "table" else ())
        else:
            self._end((tag,), ("td", "th", "caption"))

    def _nearest(self, tags: tuple) -> str | None:
        return next((n.tag for n in reversed(self.nodes) if n.tag in tags), None)

    def _end(self, tags, scope) -> None:
        """Close the nearest open element of ``tags`` that lies inside ``scope``, with all in it.

        For cells and rows the outermost of ``tags`` inside the scope is closed.
        """
        if not any(self.count[t] for t in tags):
            return
        found = None
        for k in range(len(self.nodes) - 1, 0, -1):
            if self.nodes[k].tag in tags:
                found = k
                if len(tags) == 1:
                    break
            elif self.nodes[k].tag in scope:
                break
        if found is not None:
            while len(self.nodes) > found:
                self._close()

    def _open(self, tag: str, attrs: dict) -> None:
        up = self.nodes[-1]
        style = attrs.get("style", "")
        shown = up.shown and tag not in UNSEEN and "hidden" not in attrs and not _NO_SHOW.search(style)
        shown = shown and (tag != "dialog" or "open" in attrs)
        if up.tag == "details" and "open" not in up.attrs and tag != "summary":
            shown = False
        said = _VISIBILITY.search(style)
        visible = said[1].lower() == "visible" if said else up.visible
        own = tag in BLOCKS
        if own and shown:
            up.box.end_line()
        self.count[tag] += 1
        self.nodes.append(Node(tag, Box() if own else up.box, own, shown, visible, attrs,
                               up.keep_gaps or tag in ("pre", "textarea")))

    # rendering

    def _seen(self) -> bool:
        node = self.nodes[-1]
        return node.shown and node.visible and not (node.tag == "details" and "open" not in node.attrs)

    def handle_data(self, data: str) -> None:
        if self.nodes[-1].tag == "head" and data.strip(" \t\n\r\f"):
            self._end(*IMPLIED_END["body"])
        if not self._seen():
            return
        node = self.nodes[-1]
        if node.tag in ("table", "thead", "tbody", "tfoot", "tr", "colgroup") and not data.strip():
            return
        if not node.keep_gaps:
            node.box.write(_GAPS.sub(" ", data))
            return
        first, *more = data.replace("\r\n", "\n").split("\n")
        node.box.open.append(first)
        for line in more:
            node.box.end_line(always=True)
            node.box.open.append(line)

    def _close(self) -> None:
        node = self.nodes.pop()
        self.count[node.tag] -= 1
        if not node.own or not node.shown:
            return
        node.box.end_line()
        up, lines = self.nodes[-1], node.box.lines
        if node.tag == "pre":
            while lines and not lines[0]:
                lines.pop(0)
            while lines and not lines[-1]:
                lines.pop()
        if node.tag in _CELLS and up.tag == "tr":
            span, down = (node.attrs.get(x, "").strip() for x in ("colspan", "rowspan"))
            up.rows.append((lines, min(1000, max(1, int(span))) if span.isdecimal() else 1,
                            min(65534, int(down)) if down.isdecimal() else 1))
            return
        if node.tag == "tr" and up.tag in ("table", "thead", "tbody", "tfoot"):
            up.rows.append(node.rows)
            up.box.block(lines, False)
            return
        if node.tag in ("thead", "tbody", "tfoot") and up.tag == "table":
            # rows outside a group end where one begins
            up.rows[up.closed :] = within_group(up.rows[up.closed :])
            up.rows += within_group(node.rows)
            up.closed = len(up.rows)
        elif node.rows:
            lines += table_lines(node.rows if node.tag != "tr" else [node.rows])
        if node.tag == "li":
            lines = self._item(node, lines)
        elif node.tag in ("blockquote", "dd"):
            lines = [f"  {x}" if x else x for x in lines]
        spaced = node.tag in SPACED and not (node.tag in LISTS and up.tag == "li")
        up.box.block(lines, spaced)

    def _item(self, node: Node, lines: list[str]) -> list[str]:
        holder = next((n for n in reversed(self.nodes) if n.tag in LISTS), None)
        mark = "- "
        if holder is not None and holder.tag == "ol":
            if not holder.count and holder.attrs.get("start", "").lstrip("-").isdecimal():
                holder.count = int(holder.attrs["start"]) - 1
            holder.count += 1
            if node.attrs.get("value", "").lstrip("-").isdecimal():
                holder.count = int(node.attrs["value"])
            mark = f"{holder.count}. "
        pad = " " * len(mark)
        return [(mark if not k else pad if x else "") + x for k, x in enumerate(lines)]

    def text(self) -> str:
        self.close()
        while len(self.nodes) > 1:
            self._close()
        self.nodes[0].box.end_line()
        return "\n".join(self.nodes[0].box.lines)


def render(html: str | None) -> str:
    """Visible text of a page, in lines; a null page has none."""
    layout = Layout()
    layout.feed(html or "")
    return layout.text()


def with_text(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns but ``html`` and ``text``) of each page, and its visible ``text``.

    A null or empty page, and one that shows nothing, has the empty text.  Broken markup is laid
    out as far as it goes.  Repeated rows get equal texts.  A column ``text`` of the input is replaced.
    """
    kept = [c for c in pages.columns if c.lower() not in ("html", "text")] if keep is None else keep
    rows = pages.select(*kept, F.col("html").cast("string").alias("html"))

    def compute(batch: pa.RecordBatch) -> list:
        return [[render(x) for x in batch.column(len(kept)).to_pylist()]]

    return extend(rows, "text string", compute, keep=kept)
