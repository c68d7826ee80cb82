"""Operator 10: the visible text of HTML pages, laid out.

A tokenizer (one regular expression) feeds a tree builder with implied tags:
block starts end an open paragraph, items end items, cells end cells and rows
end rows, a column group ends at whatever is not a column, a head at the first
text or tag of the body, a cell without a row gets one, a form between rows
holds nothing; end tags close what is open inside them, and unknown end tags
are ignored.  Rendering emits every visible text and nothing else:

* not visible: ``head`` (but see ``title``), ``script``, ``style``,
  ``template``, ``noscript``, ``textarea``, ``select``, ``svg`` and other
  non-text content; annotations of ``math`` (its symbols are text) and ``rp``; elements with ``hidden``,
  ``display:none`` or ``visibility:hidden`` (of several the last counts); a closed ``dialog``, and a closed
  ``details`` but for its summary; comments.  The title is not part of the page's body and is returned apart;
* white space collapses (not in ``pre``); ``br`` breaks a line; blocks start on
  a new line; paragraphs, headings, lists, tables and quotes are set off by one
  blank line; ``hr`` is a line of dashes;
* list items get ``- `` or their number and are indented by depth, quotes get
  ``> ``;
* a table is a grid: cells of a column are padded to its widest line, columns
  are separated by `` | ``, and ``colspan`` takes that many columns.  A cell
  with ``rowspan`` leaves its place blank in the further rows of its row group
  (adjoining blanks are one).  Captions and whatever else hangs between the
  rows come before the grid.  Tables inside cells are flattened to their text.

Defined cases: null or empty HTML gives an empty text and no title; broken
markup never fails; elements nested beyond ``DEPTH`` are laid out as part of
the one at that depth, and hidden ones stay hidden; a quote opens an attribute
value only after ``=``; a grid of more than ``GRID`` characters is padded to
200 a column at most, no text is cut; repeated rows are rendered each; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

DEPTH = 200
GRID = 1 << 24

# Element classes of the HTML standard.
_words = lambda s: frozenset(s.split())
VOID = _words("area base br col embed hr img input link meta param source track wbr")
HIDDEN = _words("head script style template noscript textarea select svg rp annotation "
                "annotation-xml object iframe video audio canvas datalist")
RAW = _words("script style textarea title noscript template iframe")
BLOCK = _words("address article aside blockquote body center dd details dialog div dl dt fieldset "
               "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li "
               "main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul "
               "caption")
APART = _words("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote article section figure hr")
#: start tag -> open elements it ends, and the elements that stop the search
ENDS = {
    "li": (_words("li p"), _words("ul ol menu")),
    "dt": (_words("dt dd p"), _words("dl")), "dd": (_words("dt dd p"), _words("dl")),
    "tr": (_words("tr td th caption p"), _words("table")),
    "td": (_words("td th caption p"), _words("tr table")),
    "th": (_words("td th caption p"), _words("tr table")),
    "tbody": (_words("tbody thead tfoot tr td th caption p"), _words("table")),
    "thead": (_words("tbody thead tfoot tr td th caption p"), _words("table")),
    "tfoot": (_words("tbody thead tfoot tr td th caption p"), _words("table")),
    "caption": (_words("tbody thead tfoot tr td th caption p"), _words("table")),
    "colgroup": (_words("tbody thead tfoot tr td th caption p"), _words("table")),
    "body": (_words("head"), _words("html")),
}
GROUPS = _words("tbody thead tfoot")
#: start tag -> the elements it can be a child of; others between are ended
PLACES = {"tr": GROUPS | {"table"}, "td": GROUPS | {"table", "tr"}, "th": GROUPS | {"table", "tr"},
          **{t: frozenset({"table"}) for t in [*GROUPS, "caption", "colgroup"]}}
#: elements ended by any text or tag but these
ONLY = {"head": _words("base basefont bgsound head link meta noframes noscript script style template title"),
        "colgroup": _words("col colgroup template")}
CLOSES_P = BLOCK - _words("html body td th tr tbody thead tfoot caption li dt dd")

#: One attribute as the standard's tokenizer reads it: a name may begin with
#: ``=`` or hold quotes, and a quote opens a value only right after ``=``.
_NAME = r"[^\s/>][^\s/>=]*"
_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)"
    rf"((?:[\s/]++|(?>{_NAME}"
    r"""(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>"'][^\s>]*|(?=>)))?))*+)(?:>|\Z)""", re.S)
_ATTR = re.compile(rf"({_NAME})" + r"""(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*)|(?=>)))?""")
_STYLE = re.compile(r"(?:^|[;{\s])(display|visibility)\s*:\s*([a-z-]+)", re.I)
_BLANK = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "kids", "seen", "span", "rows", "open")

    def __init__(self, tag: str, seen: bool = True, span: int = 1, rows: int = 1, open_: bool = False):
        self.tag, self.kids, self.seen, self.span, self.rows, self.open = tag, [], seen, span, rows, open_


def _attributes(raw: str) -> tuple[bool, int, int, bool]:
    """Whether the element is shown, its column span and its row span, and
    whether it is open.  Of several declarations the last one counts."""
    seen, span, rows, is_open = True, 1, 1, False
    low = raw.lower()
    if "hidden" in low or "style" in low or "span" in low or "open" in low:
        for m in _ATTR.finditer(raw):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name == "hidden":
                seen = False
            elif name == "open":
                is_open = True
            elif name == "style":
                last = {k.lower(): v.lower() for k, v in _STYLE.findall(value)}
                if last.get("display") == "none" or last.get("visibility") in ("hidden", "collapse"):
                    seen = False
            elif name == "colspan" and value.isdecimal():
                span = min(1000, max(1, int(value[:9])))
            elif name == "rowspan" and value.isdecimal():
                rows = min(65534, int(value[:9])) or 65534      # 0: all of the row group
    return seen, span, rows, is_open


def _shut(node: Node) -> bool:
    """A closed details element shows its summary only."""
    return node.tag == "details" and not node.open


def parse(page: str) -> tuple[Node, str]:
    """The tree and the title."""
    root = Node("#root")
    stack, title, at = [root], None, 0
    below: dict[str, int] = {}      # elements beyond DEPTH that are open, by tag
    unseen: list = []               # the hidden one of them: tag and depth of its own

    def text(raw: str) -> None:
        if raw and not unseen:
            while stack[-1].tag in ONLY and raw.strip(" \t\n\r\f"):
                stack.pop()
            if not _shut(stack[-1]):
                stack[-1].kids.append(html.unescape(raw) if "&" in raw else raw)

    def close(names: frozenset, stops: frozenset) -> None:
        """Ends the outermost of ``names`` above the nearest of ``stops``."""
        cut = 0
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in names:
                cut = k
            elif stack[k].tag in stops:
                break
        if cut:
            del stack[cut:]

    while (m := _TOKEN.search(page, at)) is not None:
        text(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if unseen:
            if tag == unseen[0] and not (m[3] and m[3].endswith("/") and tag not in BLOCK):
                unseen[1] += -1 if m[1] else 1
                if not unseen[1]:
                    unseen.clear()
            continue
        if below and len(stack) < DEPTH:
            below.clear()
        if m[1] and below.get(tag):
            below[tag] -= 1
            continue
        if m[1]:
            if tag == "br":
                stack[-1].kids.append(Node("br"))
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if stack[k].tag in ("table", "td", "th") and tag not in (
                        "table", "tr", "tbody", "thead", "tfoot", "body", "html"):
                    break           # an end tag does not reach out of its cell
            continue
        while stack[-1].tag in ONLY and tag not in ONLY[stack[-1].tag]:
            stack.pop()
        if tag in ENDS:
            close(*ENDS[tag])
            for k in range(len(stack) - 1, 0, -1) if tag in PLACES else ():
                if stack[k].tag in PLACES[tag]:
                    del stack[k + 1:]
                    break
            if tag in ("td", "th") and stack[-1].tag in PLACES["tr"] and len(stack) < DEPTH:
                row = Node("tr")
                stack[-1].kids.append(row)
                stack.append(row)
        elif tag in CLOSES_P:
            close(_words("p"), _words("table td th li dd button"))
        seen, span, rows, is_open = _attributes(m[3]) if m[3] else (True, 1, 1, False)
        if tag in HIDDEN or tag == "dialog" and not is_open or tag != "summary" and _shut(stack[-1]):
            seen = False
        node = Node(tag, seen, span, rows, is_open)
        stack[-1].kids.append(node)
        if tag in RAW and not m[3].rstrip().endswith("/"):
            end = re.compile(rf"</{tag}(?=[\s/>])|\Z", re.I).search(page, at)
            if tag == "title":
                node.seen = False
                if title is None:
                    title = _BLANK.sub(" ", html.unescape(page[at:end.start()])).strip()
            elif tag in ("textarea",):
                node.seen = False
            at = end.start()
            if at < len(page):
                at = (page.find(">", at) + 1) or len(page)
        elif tag == "form" and stack[-1].tag in PLACES["td"]:
            continue                # between rows or cells it holds nothing
        elif tag not in VOID and not (m[3] and m[3].endswith("/") and tag not in BLOCK):
            if len(stack) < DEPTH:
                stack.append(node)
            elif node.seen:
                below[tag] = below.get(tag, 0) + 1
            else:
                unseen[:] = [tag, 1]
    text(page[at:])
    return root, title or ""


class _Flow:
    """Lines of one block formatting context."""

    def __init__(self):
        self.lines: list[str] = []
        self.line = ""
        self.gap = False            # a collapsed space is pending
        self.apart = False          # a blank line is due before the next text

    def write(self, raw: str, pre: bool) -> None:
        if pre:
            head, *rest = raw.replace("\r\n", "\n").split("\n")
            self._put(head)
            for part in rest:
                self.newline(True)
                self._put(part)
            return
        words = _BLANK.sub(" ", raw)
        if words == " ":
            self.gap = self.gap or bool(self.line)
            return
        if words[:1] == " ":
            self.gap = self.gap or bool(self.line)
            words = words[1:]
        if not words:
            return
        tail = words[-1] == " "
        self._put((" " if self.gap and self.line else "") + words.rstrip(" "))
        self.gap = tail

    def _put(self, s: str) -> None:
        if s and not self.line and self.apart:
            if self.lines and self.lines[-1]:
                self.lines.append("")
            self.apart = False
        self.line += s

    def newline(self, keep: bool = False) -> None:
        """Ends the line; an empty one counts only if asked for."""
        if self.line or keep and self.lines:
            self.lines.append(self.line.rstrip(" "))
        self.line, self.gap = "", False

    def block(self, lines: list[str], apart: bool) -> None:
        self.newline()
        if not lines:
            return
        if (apart or self.apart) and self.lines and self.lines[-1]:
            self.lines.append("")
        self.lines += lines
        self.apart = apart

    def done(self) -> list[str]:
        self.newline()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


def _rows(node: Node):
    """Each row and whether it begins a row group."""
    loose = True
    for kid in node.kids:
        if isinstance(kid, Node) and kid.seen:
            if kid.tag == "tr":
                yield kid, loose
                loose = False
            elif kid.tag in GROUPS:
                loose = True
                yield from _rows(kid)


def _strays(node: Node):
    """What hangs between the rows, row groups' own content included."""
    for kid in node.kids:
        if isinstance(kid, str):
            yield kid
        elif kid.seen and kid.tag in GROUPS:
            yield from _strays(kid)
        elif kid.seen and kid.tag != "tr":
            yield kid


def _blank(cells: list, span: int) -> None:
    """Adds an empty cell, joined to an empty one before it."""
    if cells and cells[-1][0] is None:
        span += cells.pop()[1]
    cells.append((None, span))


def _grid(node: Node) -> list[list]:
    """Rows of ``(lines, span)``; the places of cells from rows above are blank."""
    grid, above = [], []            # above: (column, span, rows to come)
    for tr, begins in _rows(node):
        above = [] if begins else [(c, n, left - 1) for c, n, left in above if left]
        cells, c, new, at = [], 0, [], 0
        for kid in tr.kids:
            if isinstance(kid, Node) and kid.seen:
                lines, span, rows = [x for x in _render(kid) if x], kid.span, kid.rows
            elif isinstance(kid, str) and kid.strip():
                lines, span, rows = [_BLANK.sub(" ", kid).strip()], 1, 1
            else:
                continue
            while at < len(above) and above[at][0] <= c:
                if above[at][0] + above[at][1] > c:
                    room = above[at][0] + above[at][1] - c
                    _blank(cells, room)
                    c += room
                at += 1
            cells.append((lines, span))
            if rows > 1:
                new.append((c, span, rows - 1))
            c += span
        for start, span, _ in above[at:]:
            if start + span > c:
                _blank(cells, start + span - c)
                c = start + span
        above = sorted(above + new)
        if any(lines for lines, _ in cells):
            grid.append([(lines or [], span) for lines, span in cells])
    return grid


def _table(node: Node) -> list[str]:
    flow = _Flow()
    for kid in _strays(node):       # captions and stray content come first
        if isinstance(kid, str):
            flow.write(kid, False)
        else:
            flow.block(_render(kid), False)
    grid = _grid(node)
    width: dict[int, int] = {}
    for cells in grid:
        c = 0
        for lines, span in cells:
            if span == 1:
                width[c] = max([width.get(c, 0), *map(len, lines)])
            c += span
    out = flow.done()
    n_lines = sum(max((len(lines) for lines, _ in cells), default=0) for cells in grid)
    most = max(width.values(), default=0) if (sum(width.values()) + 3 * len(width)) * n_lines <= GRID else 200
    for cells in grid:
        for k in range(max(len(lines) for lines, _ in cells)):
            parts, c = [], 0
            for lines, span in cells:
                room = sum(min(width.get(i, 0), most) for i in range(c, c + span)) + 3 * (span - 1)
                parts.append((lines[k] if k < len(lines) else "").ljust(room))
                c += span
            out.append(" | ".join(parts).rstrip())
    return out


def _render(node: Node) -> list[str]:
    flow = _Flow()
    _into(node, flow, node.tag == "pre")
    return flow.done()


def _into(node: Node, flow: _Flow, pre: bool) -> None:
    number = 0
    for kid in node.kids:
        if isinstance(kid, str):
            flow.write(kid, pre)
        elif not kid.seen:
            continue
        elif kid.tag == "br":
            flow.newline(True)
        elif kid.tag == "hr":
            flow.block(["---"], True)
        elif kid.tag == "table":
            flow.block(_table(kid), True)
        elif kid.tag == "li":
            number += 1
            mark = f"{number}. " if node.tag == "ol" else "- "
            lines = _render(kid)
            flow.block([(mark if i == 0 else " " * len(mark)) + x if x else x
                        for i, x in enumerate(lines)], False)
        elif kid.tag == "blockquote":
            flow.block([("> " + x).rstrip() for x in _render(kid)], True)
        elif kid.tag in BLOCK:
            flow.block(_render(kid), kid.tag in APART and not (node.tag == "li" and kid.tag in (
                "ul", "ol")))
        else:
            _into(kid, flow, pre)


def render(page: str | None) -> tuple[str, str]:
    """Laid-out text and title of a page."""
    root, title = parse((page or "").replace("\x00", ""))
    return "\n".join(_render(root)), title


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``page_id, title, text, n_chars, n_lines``."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = [render(p) for p in batch.column(1).to_pylist()]
        text = [t for t, _ in got]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([t for _, t in got], pa.string()), pa.array(text, pa.string()),
             pa.array([len(t) for t in text], pa.int64()),
             pa.array([t.count("\n") + 1 if t else 0 for t in text], pa.int64())],
            names=["page_id", "title", "text", "n_chars", "n_lines"])

    return map_batches(pages.select(F.col(id_col).cast("long").alias("page_id"),
                                    F.col(html_col).cast("string").alias("html")),
                       run, "page_id long, title string, text string, n_chars long, n_lines long")
