"""Page markup to laid-out text: a tree with implied end tags, then lines of blocks, lists and tables.

Lists are set in, level by level, with bullets or numbers. A table becomes a grid: two spaces between columns, every
column as wide as its widest cell (cells over WIDE aside), cells of several lines side by side, ``colspan`` and
``rowspan`` honoured, so that a row of the page is a row of the text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser
from itertools import accumulate

HIDDEN = {"head", "script", "style", "template", "title"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: Elements that may stand in a head; any other one, or text, ends a head that was not closed.
IN_HEAD = {"base", "link", "meta", "script", "style", "template", "noscript", "title"}
#: Elements that start lines of their own; MARGIN ones keep a blank line from their neighbours.
BLOCKS = set("address article aside blockquote body caption center dd details div dl dt fieldset figcaption footer form header hr html legend li main nav ol option section summary ul".split())
MARGIN = {"p", "figure", "h1", "h2", "h3", "h4", "h5", "h6"}
STARTS = BLOCKS | MARGIN | {"pre", "table"}
CELLS, PARTS = {"td", "th"}, {"thead", "tbody", "tfoot"}
#: What a start tag closes, and the elements beyond which it does not look.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "table"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    **dict.fromkeys(CELLS, (CELLS, {"table", "tr"})), "tr": ({"tr"}, {"table"}), **dict.fromkeys(PARTS, (PARTS, {"table"})),
}
BULLETS = "*+o-"
#: Elements inside each other that the tree keeps apart, columns or rows that a cell may span, and the widest cell that widens its column.
DEEP, SPAN, WIDE = 100, 100, 200
GAP = "  "
_SPACE = re.compile(r"[ \t\r\n\f]+")


@dataclass
class Node:
    tag: str
    attrs: dict[str, str | None] = field(default_factory=dict)
    children: list[Node | str] = field(default_factory=list)


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("html")
        self.open = [self.root]

    def _close(self, tags: set[str], until: set[str]) -> None:
        """End the innermost open element of ``tags``, unless one of ``until`` lies between."""
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag in tags:
                del self.open[k:]
                return
            if self.open[k].tag in until:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in IN_HEAD and tag != "head":
            self._close({"head"}, set())
        if tag in STARTS:
            self._close({"p"}, {"table", "li", "button", *CELLS})
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        node = Node(tag, dict(attrs))
        self.open[-1].children.append(node)
        if tag not in VOID and (len(self.open) < DEEP or tag in HIDDEN):
            self.open.append(node)

    def handle_endtag(self, tag: str) -> None:
        if tag not in ("html", "body"):  # what follows them is shown as well
            self._close({tag}, set() if tag == "table" else {"table"})

    def handle_data(self, data: str) -> None:
        if self.open[-1].tag == "head" and data.strip():
            self.open.pop()
        self.open[-1].children.append(data)


class _Flow:
    """Lines of one block: inline text gathers until something starts a line of its own."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.inline = ""
        self.gap = False

    def text(self, data: str) -> None:
        """Inline text: runs of white space are one space, and none begins a line; no-break spaces stay."""
        data = _SPACE.sub(" ", data)
        self.inline += data.lstrip(" ") if not self.inline or self.inline.endswith(" ") else data

    def put(self, lines: list[str]) -> None:
        if any(lines):
            if self.lines and self.gap:
                self.lines.append("")
            self.gap = False
            self.lines += lines

    def end(self, blank: bool = False) -> None:
        """End the line; with ``blank`` the next one keeps a blank line away."""
        line, self.inline = self.inline.rstrip(" "), ""
        self.put([line])
        self.gap |= blank


def _fill(flow: _Flow, node: Node, level: int) -> None:
    number = 0
    for child in node.children:
        if isinstance(child, str):
            flow.text(child)
        elif child.tag in HIDDEN:
            continue
        elif child.tag == "br":
            flow.end(blank=not flow.inline)
        elif child.tag == "pre":
            flow.end()
            flow.put([x.rstrip() for x in _raw(child).strip("\r\n").splitlines()])
        elif child.tag == "table":
            flow.end()
            flow.put(_table(child, level))
        elif child.tag == "li":
            flow.end()
            number += 1
            mark = GAP + (f"{number}. " if node.tag == "ol" else f"{BULLETS[max(level - 1, 0) % len(BULLETS)]} ")
            first, *rest = _lines(child, level) or [""]
            flow.put([mark + first, *((" " * len(mark) + x).rstrip() for x in rest)] if first else [])
        elif child.tag in BLOCKS | MARGIN:
            flow.end(blank=child.tag in MARGIN)
            _fill(flow, child, level + (child.tag in ("ul", "ol")))
            flow.end(blank=child.tag in MARGIN)
        else:
            _fill(flow, child, level)


def _lines(node: Node, level: int) -> list[str]:
    flow = _Flow()
    _fill(flow, node, level)
    flow.end()
    return flow.lines


def _raw(node: Node) -> str:
    return "".join(c if isinstance(c, str) else "\n" if c.tag == "br" else "" if c.tag in HIDDEN else _raw(c) for c in node.children)


# -- tables -----------------------------------------------------------------------------------------------------


def _rows(node: Node, rows: list[list[Node]], stray: Node) -> None:
    """A table's rows of cells; what stands outside cells joins ``stray``, which is shown before the table."""
    loose = None
    for child in node.children:
        tag = "" if isinstance(child, str) else child.tag
        if tag in CELLS:  # a cell without a row
            if loose is None:
                rows.append(loose := [])
            loose.append(child)
        elif tag == "tr":
            loose = None
            rows.append([c for c in child.children if not isinstance(c, str) and c.tag in CELLS])
            stray.children += [c for c in child.children if isinstance(c, str) or c.tag not in CELLS]
        elif tag in PARTS or tag == "form":
            _rows(child, rows, stray)
        elif tag not in ("col", "colgroup"):
            stray.children.append(child)


def _span(cell: Node, name: str) -> int:
    said = (cell.attrs.get(name) or "").strip()
    return min(max(int(said), 1), SPAN) if re.fullmatch("[0-9]{1,9}", said) else 1


def _table(table: Node, level: int) -> list[str]:
    rows: list[list[Node]] = []
    stray = Node("div")
    _rows(table, rows, stray)
    taken: set[tuple[int, int]] = set()
    cells: list[tuple[int, int, int, int, list[str]]] = []  # row, column, rows, columns, lines
    for r, row in enumerate(rows):
        c = 0
        for cell in row:
            while (r, c) in taken:
                c += 1
            high, broad = min(_span(cell, "rowspan"), len(rows) - r), _span(cell, "colspan")
            taken |= {(r + i, c + j) for i in range(high) for j in range(broad)}
            cells.append((r, c, high, broad, _lines(cell, level)))
            c += broad
    return _lines(stray, level) + _grid(cells, len(rows), 1 + max((c for _, c in taken), default=-1))


def _grid(cells: list[tuple[int, int, int, int, list[str]]], n_rows: int, n_columns: int) -> list[str]:
    """Cells as lines. Single columns and rows are measured first; a cell that spans some widens the last of them if need be."""
    widths, heights = [0] * n_columns, [0] * n_rows
    for r, c, high, broad, lines in sorted(cells, key=lambda x: (x[3], x[2])):
        widest = max((len(x) for x in lines if len(x) <= WIDE), default=1 if lines else 0)
        has = sum(widths[c : c + broad]) + len(GAP) * max(sum(w > 0 for w in widths[c : c + broad]) - 1, 0)
        if widest > has:
            end = c + broad - 1
            widths[end] += widest - has - (len(GAP) if has and not widths[end] and widest - has > len(GAP) else 0)
        if high == 1:
            heights[r] = max(heights[r], len(lines))
    for r, _, high, _, lines in cells:
        heights[r + high - 1] += max(0, len(lines) - sum(heights[r : r + high]))
    left = list(accumulate((w + len(GAP) if w else 0 for w in widths), initial=0))
    top = list(accumulate(heights, initial=0))
    canvas = [""] * top[-1]
    for r, c, _, _, lines in sorted(cells, key=lambda x: x[1]):
        for i, line in enumerate(lines, top[r]):
            if line:
                before = canvas[i]
                canvas[i] = (before.ljust(left[c]) if len(before) + len(GAP) <= left[c] or not before else before + GAP) + line
    return canvas


def layout(html: str | None) -> str:
    """The visible text of a page; empty for null or empty markup. Malformed markup gives what was read of it."""
    tree = _Tree()
    try:
        tree.feed(html or "")
        tree.close()
    except (AssertionError, ValueError):  # what the parser raises on some broken declarations
        pass
    kept: list[str] = []
    for line in _lines(tree.root, 0):
        if line.strip() or (kept and kept[-1]):
            kept.append(line if line.strip() else "")
    return "\n".join(kept).strip("\n")
