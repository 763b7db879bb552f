"""Operator 10, HTML extraction: text as a reader sees the page.

A scanner and a tree builder with implied tags (an open paragraph, list item, cell, row or
option ends where the next begins; table parts and the body are implied, and the head ends
where something begins that can't be in it) and raw-text elements make a tree. Visibility
rules leave out head, scripts, styles, templates, comments, hidden elements and those
styled ``display: none``; the text of ``visibility: hidden`` goes too, but not that of
elements inside which are made visible again. Rendering puts blocks on lines of their own,
a blank line around paragraphs and headings, marks list items and indents them by depth
(up to ``INDENT`` columns), keeps preformatted white space, and aligns the cells of each
table by column, with ``colspan`` and ``rowspan``. A table that holds other tables is
layout: its cells are blocks. A select shows its chosen option (a list box all), math its
text, svg the text drawn in it, xmp its body as it stands, object what stands in for it.
Content for browsers that lack a feature (noscript, iframe, audio, video, canvas, noembed,
noframes) and datalists are left out. The rules are the same at any depth, and the work
is in proportion to the page.

Defined results: null or empty HTML gives empty text; unclosed tags, stray end tags and
broken references are taken as text or closed at the end (a tag without its ``>`` is text;
a quote that never ends is a plain character); of two attributes of one name the first
counts; repeated rows are alike; a null page_id stays null; other columns are not read.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

INDENT = 64
# Element sets of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template title noscript iframe noembed noframes datalist audio video canvas annotation annotation-xml".split())
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
#: Parts of a drawing that show text, and those that only define something.
DRAWN, DEFINED = frozenset("text foreignobject".split()), frozenset("defs desc metadata symbol clippath mask pattern marker".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup html hr legend li main menu nav ol optgroup option p pre section summary table ul".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure hr".split())
LISTS = frozenset("ul ol menu dir".split())
PARTS = frozenset("thead tbody tfoot".split())
#: An element that begins ends these open ones, looked for up to the given limits.
CLOSES = {
    "li": ("li", "ul ol menu dir"),
    "dt": ("dt dd", "dl"),
    "dd": ("dt dd", "dl"),
    "option": ("option", "select datalist"),
    "optgroup": ("option optgroup", "select datalist"),
    "tr": ("tr td th caption", "table"),
    "td": ("td th", "tr table"),
    "th": ("td th", "tr table"),
    "thead": ("thead tbody tfoot tr td th caption", "table"),
    "tbody": ("thead tbody tfoot tr td th caption", "table"),
    "tfoot": ("thead tbody tfoot tr td th caption", "table"),
    "body": ("head", "html"),
}
CLOSES = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in CLOSES.items()}
_P, _P_LIMITS = frozenset({"p"}), frozenset("table td th li dd button".split())
#: End tags that reach out of a cell or table; others stop there.
_OUTER = frozenset("table tr tbody thead tfoot body html td th".split())
_CELL = frozenset("td th table".split())

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"[\s/]*([^\s/>][^\s/>=]*)(\s*=\s*)?")
_VALUE = re.compile(r"[^\s>]*")
_GONE = re.compile(r"display\s*:\s*none", re.I)
_SIGHT = re.compile(r"visibility\s*:\s*(hidden|collapse|visible|initial)", re.I)
_NUMBER = re.compile(r"\s*([+-]?\d{1,9})")
_SPACE = re.compile(r"[ \t\n\r\f]+")


def _number(text: str, otherwise: int) -> int:
    m = _NUMBER.match(text)
    return int(m[1]) if m else otherwise


class Node:
    """An element: ``hidden`` is left out whole, ``seen`` tells whether its own text shows."""

    __slots__ = ("tag", "attrs", "children", "hidden", "seen", "layout")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None, parent: Node | None = None):
        self.tag, self.attrs, self.children, self.layout = tag, attrs or {}, [], False
        self.seen = parent.seen if parent else True
        self.hidden = tag in UNSEEN
        if attrs:
            style = attrs.get("style", "")
            self.hidden |= "hidden" in attrs or bool(style and _GONE.search(style))
            sight = _SIGHT.findall(style) if style else ()
            if sight:
                self.seen = sight[-1].lower() in ("visible", "initial")


class _Scanner:
    """The page's tags and text, each character looked at a bounded number of times."""

    def __init__(self, page: str):
        self.page, self.missing = page, set()

    def find(self, what: str, at: int) -> int:
        """As str.find; what was not found once is not looked for again, as places only grow."""
        if what in self.missing:
            return -1
        found = self.page.find(what, at)
        if found < 0:
            self.missing.add(what)
        return found

    def tag(self, at: int) -> tuple[str, dict[str, str], bool, int] | None:
        """Name, attributes, whether it closes itself, and the end of the tag whose name
        begins at ``at``; None if it never ends."""
        page = self.page
        close = self.find(">", at)
        if close < 0:
            return None
        m = _NAME.match(page, at)
        name, attrs, place = m[0].lower(), {}, m.end()
        while True:
            m = _ATTRIBUTE.match(page, place)
            if not m:  # nothing but space and slashes up to the end
                end = self.find(">", place)
                return (name, attrs, page[place:end].rstrip().endswith("/"), end + 1) if end >= 0 else (name, attrs, False, close + 1)
            key, place, value = m[1].lower(), m.end(), ""
            if m[2]:
                mark = page[place : place + 1]
                stop = self.find(mark, place + 1) if mark in ("'", '"') and mark else -1
                if stop >= 0:
                    value, place = page[place + 1 : stop], stop + 1
                elif mark in ("'", '"') and mark:
                    # The quote never ends: the tag does at its first bracket.
                    return name, attrs, False, close + 1
                else:
                    v = _VALUE.match(page, place)
                    value, place = v[0], v.end()
            attrs.setdefault(key, html.unescape(value) if "&" in value else value)


class _Open:
    """The stack of open elements, with the places of each tag's."""

    def __init__(self, root: Node):
        self.nodes, self.at = [root], {}

    def push(self, node: Node) -> None:
        self.at.setdefault(node.tag, []).append(len(self.nodes))
        self.nodes.append(node)

    def cut(self, length: int) -> None:
        while len(self.nodes) > length:
            self.at[self.nodes.pop().tag].pop()

    def last(self, tags) -> int:
        """The place of the innermost open element of these tags; 0 if there is none."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)


def build(page: str) -> Node:
    """The tree of a page."""
    root = Node("html")
    open_, scan, at = _Open(root), _Scanner(page), 0
    while True:
        begin = scan.find("<", at)
        if begin < 0:
            _text(open_, page[at:])
            return root
        after = page[begin + 1 : begin + 2]
        ends = after == "/"
        first = page[begin + 2 : begin + 3] if ends else after
        if first.isascii() and first.isalpha():
            found = scan.tag(begin + 1 + ends)
            if found is None:
                _text(open_, page[at:])
                return root
            _text(open_, page[at:begin])
            tag, attrs, closed, at = found
            if ends:
                _end(open_, tag)
            elif tag != "html":
                at = _begin(open_, scan, tag, attrs, closed, at)
        elif after in ("!", "?", "/") and after:
            _text(open_, page[at:begin])
            if page.startswith("<!--", begin):
                stop = scan.find("-->", begin + 2)
                at = stop + 3 if stop >= 0 else len(page)
            elif page.startswith("<![CDATA[", begin) and (stop := scan.find("]]>", begin)) >= 0:
                at = stop + 3
            else:
                stop = scan.find(">", begin)
                if stop < 0:
                    _text(open_, page[begin:])
                    return root
                at = stop + 1
        else:
            _text(open_, page[at : begin + 1])
            at = begin + 1


def _begin(open_: _Open, scan: _Scanner, tag: str, attrs: dict, closed: bool, at: int) -> int:
    """Opens an element; where to go on."""
    if tag not in IN_HEAD:
        _end_head(open_)
    _imply(open_, tag)
    node = Node(tag, attrs, open_.nodes[-1])
    open_.nodes[-1].children.append(node)
    if tag == "table" and open_.at.get("table"):
        open_.nodes[open_.at["table"][-1]].layout = True
    if tag in RAW:
        page = scan.page
        stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
        body, at = (page[at : stop.start()], stop.end()) if stop else (page[at:], len(page))
        if tag in ("textarea", "title"):
            node.children.append(html.unescape(body))
        elif tag == "xmp":
            node.children.append(body)
    elif tag not in VOID and not (closed and (tag in ("svg", "math") or open_.at.get("svg") or open_.at.get("math"))):
        open_.push(node)
    return at


def _text(open_: _Open, text: str) -> None:
    if text:
        if open_.at.get("head") and open_.nodes[-1].tag == "head" and text.strip():
            _end_head(open_)
        open_.nodes[-1].children.append(html.unescape(text) if "&" in text else text)


def _end_head(open_: _Open) -> None:
    """An open head ends if nothing but noscript is open in it."""
    head = open_.at.get("head")
    if head and all(n.tag == "noscript" for n in open_.nodes[head[-1] + 1 :][:2]) and len(open_.nodes) - head[-1] <= 2:
        open_.cut(head[-1])


def _imply(open_: _Open, tag: str) -> None:
    """Ends what the tag implies has ended, and begins the table parts it implies."""
    if tag in BLOCK and tag != "option":
        _close(open_, _P, _P_LIMITS)
    if tag in CLOSES:
        _close(open_, *CLOSES[tag])
    if tag in ("td", "th") and open_.nodes[-1].tag in ("table", "thead", "tbody", "tfoot"):
        row = Node("tr", None, open_.nodes[-1])
        open_.nodes[-1].children.append(row)
        open_.push(row)


def _close(open_: _Open, tags: frozenset, limits: frozenset) -> None:
    at = open_.last(tags)
    if at and at > open_.last(limits - tags):
        while at > 1 and open_.nodes[at - 1].tag in tags:
            at -= 1
        open_.cut(at)


def _end(open_: _Open, tag: str) -> None:
    at = open_.last((tag,))
    if at and (tag in _OUTER or at > open_.last(_CELL)):
        open_.cut(at)


class _Writer:
    """Lines of text: inline pieces join, blocks start lines, margins collapse."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.now: list[str] = []
        self.indent, self.blank = "", False
        self.mark, self.mark_indent, self.mark_blank = "", "", False
        self.lists = 0

    def inline(self, text: str) -> None:
        piece = _SPACE.sub(" ", text)
        if piece and not (piece == " " and (not self.now or self.now[-1].endswith(" "))):
            self.now.append(piece.lstrip(" ") if not self.now or self.now[-1].endswith(" ") else piece)

    def _put(self, text: str) -> None:
        """A line, after the blank one that is due, with the marks that wait."""
        if self.mark:
            if self.mark_blank and self.lines:
                self.lines.append("")
            self.lines.append((self.mark_indent + self.mark + text).rstrip())
            self.mark = ""
        else:
            if self.blank and self.lines and text:
                self.lines.append("")
            self.lines.append((self.indent + text).rstrip() if text else "")
        self.blank = self.blank and not text

    def line(self, keep: bool = False) -> None:
        """Ends the line; ``keep`` also ends an empty one."""
        text = "".join(self.now).strip(" ")
        self.now = []
        if text or keep:
            self._put(text)

    def margin(self) -> None:
        self.line()
        self.blank = True

    def raw(self, lines: list[str]) -> None:
        self.line()
        for x in lines:
            if x or self.mark:
                self._put(x)
            else:
                self.lines.append("")

    def item(self, mark: str) -> str:
        """Begins a list item; the indent to go back to."""
        self.line()
        before = self.indent
        if not self.mark:
            self.mark_indent, self.mark_blank = self.indent, self.blank
        self.mark += mark
        if len(self.indent) + len(mark) <= INDENT:
            self.indent += " " * len(mark)
        return before

    def end_item(self, before: str) -> None:
        self.line()
        if self.mark:
            self._put("")
        self.indent, self.blank = before, False


class Page:
    """A rendered page: text, and how many blocks, list items and cells it shows."""

    def __init__(self, source: str | None):
        self.blocks = self.items = self.cells = 0
        out = _Writer()
        if source:
            self._run(self._children(build(source), out))
        out.line()
        self.text = re.sub(r"\n{3,}", "\n\n", "\n".join(out.lines)).strip("\n")

    @staticmethod
    def _run(task) -> None:
        """Runs a rendering step and the steps that it yields, on a stack of our own: pages
        nest deeper than Python calls may."""
        stack = [task]
        while stack:
            step = next(stack[-1], None)
            if step is None:
                stack.pop()
            else:
                stack.append(step)

    def _children(self, node: Node, out: _Writer):
        for child in node.children:
            if isinstance(child, str):
                if node.seen:
                    out.inline(child)
            elif not child.hidden:
                yield self._node(child, out)

    def _node(self, node: Node, out: _Writer):
        tag = node.tag
        if tag == "br":
            out.line(keep=True)
        elif tag == "hr":
            out.margin()
            out.raw(["---"] if node.seen else [])
            out.margin()
        elif tag == "table" and not node.layout:
            out.margin()
            yield self._table(node, lines := [])
            out.raw(lines)
            out.margin()
        elif tag in LISTS:
            out.line() if out.lists else out.margin()
            out.lists += 1
            yield self._list(node, out)
            out.lists -= 1
            out.line() if out.lists else out.margin()
        elif tag in ("pre", "xmp"):
            out.margin()
            text = self._plain(node)
            out.raw(text.strip("\n").split("\n") if text.strip() else [])
            self.blocks += 1
            out.margin()
        elif tag in BLOCK:
            spaced = tag in SPACED
            out.margin() if spaced else out.line()
            self.blocks += 1
            before = out.indent
            if tag == "dd" and len(before) + 4 <= INDENT:
                out.indent += "    "
            yield self._layout(node, out) if tag == "table" else self._children(node, out)
            out.margin() if spaced else out.line()
            out.indent = before
        elif tag == "img":
            if node.seen and node.attrs.get("alt"):
                out.inline(node.attrs["alt"])
        elif tag == "input":
            return
        elif tag == "select":
            shown = self._options(node) if node.seen else []
            if _listed(node):
                for text in shown:
                    out.line()
                    out.inline(text)
                out.line()
            elif shown:
                out.inline(shown[0])
        elif tag == "svg":
            for part in self._drawn(node):
                out.inline(" ")
                yield self._children(part, out)
                out.inline(" ")
        else:
            if tag in ("td", "th"):
                out.inline(" ")
            yield self._children(node, out)

    def _layout(self, node: Node, out: _Writer):
        """The cells of a table that holds others, as blocks."""
        for child in node.children:
            if isinstance(child, str):
                if node.seen:
                    out.inline(child)
            elif child.hidden:
                continue
            elif child.tag in PARTS or child.tag == "tr":
                yield self._layout(child, out)
            elif child.tag in ("td", "th"):
                out.line()
                self.cells += 1
                yield self._children(child, out)
                out.line()
            else:
                yield self._node(child, out)

    def _list(self, node: Node, out: _Writer):
        number = _number(node.attrs.get("start", ""), 1)
        for child in node.children:
            if isinstance(child, str):
                if node.seen:
                    out.inline(child)
            elif child.hidden:
                continue
            elif child.tag == "li":
                self.items += 1
                begun = out.item((f"{number}. " if node.tag == "ol" else "- ") if child.seen else "")
                number += 1
                yield self._children(child, out)
                out.end_item(begun)
            else:
                yield self._node(child, out)

    def _options(self, node: Node) -> list[str]:
        """Labels that a select shows: all of a list box, else the chosen option (the last
        one marked, or the first)."""
        shown, chosen, stack, listed = [], None, list(reversed(node.children)), _listed(node)
        while stack:
            x = stack.pop()
            if isinstance(x, str) or x.hidden:
                continue
            if x.tag != "option":
                if x.tag == "optgroup" and listed and x.attrs.get("label"):
                    shown.append(x.attrs["label"])
                stack += reversed(x.children)
                continue
            shown.append(x.attrs.get("label") or _SPACE.sub(" ", self._plain(x)).strip(" "))
            if "selected" in x.attrs:
                chosen = shown[-1]
        return shown if listed or chosen is None else [chosen]

    def _drawn(self, node: Node) -> list[Node]:
        """The text elements of a drawing, in order."""
        found, stack = [], [node]
        while stack:
            x = stack.pop()
            if isinstance(x, str) or x.hidden or x.tag in DEFINED:
                continue
            if x.tag in DRAWN:
                found.append(x)
            else:
                stack += reversed(x.children)
        return found

    def _plain(self, node: Node) -> str:
        parts, stack = [], [(node, x) for x in reversed(node.children)]
        while stack:
            parent, x = stack.pop()
            if isinstance(x, str):
                if parent.seen:
                    parts.append(x)
            elif not x.hidden:
                if x.tag == "br":
                    parts.append("\n")
                stack += [(x, y) for y in reversed(x.children)]
        return "".join(parts).replace("\r\n", "\n")

    def _table(self, node: Node, lines: list[str]):
        """Adds the lines of a table without tables inside to the given ones."""
        rows: list[list[tuple[int, int, list[str]]]] = []  # first column, the one after the last, lines
        before: list[str] = []
        hanging: list[tuple[int, int, int]] = []  # columns that cells of earlier rows hold, and for how many rows
        stack = [(node, x) for x in reversed(node.children)]
        while stack:
            parent, x = stack.pop()
            if isinstance(x, str):
                if x.strip() and parent.seen:
                    before.append(_SPACE.sub(" ", x).strip())
            elif x.hidden:
                continue
            elif x.tag in PARTS:
                stack += [(x, y) for y in reversed(x.children)]
            elif x.tag == "tr":
                row, new, column, held = [], [], 0, 0
                for cell in x.children:
                    inner = _Writer()
                    if isinstance(cell, str):
                        if not cell.strip() or not x.seen:
                            continue
                        inner.inline(cell)
                        wide = tall = 1
                    elif cell.hidden:
                        continue
                    else:
                        yield self._children(cell, inner)
                        self.cells += cell.tag in ("td", "th")
                        wide = min(1000, max(1, _number(cell.attrs.get("colspan", ""), 1)))
                        tall = max(1, _number(cell.attrs.get("rowspan", ""), 1))
                    inner.line()
                    while held < len(hanging) and hanging[held][0] <= column:
                        column = max(column, hanging[held][1])
                        held += 1
                    row.append((column, column + wide, inner.lines or [""]))
                    if tall > 1:
                        new.append((column, column + wide, tall))
                    column += wide
                hanging = sorted([(a, b, n - 1) for a, b, n in hanging if n > 1] + [(a, b, n - 1) for a, b, n in new])
                if row:
                    rows.append(row)
            else:
                inner = _Writer()
                yield self._node(x, inner)
                inner.line()
                before += inner.lines
        lines += before
        _align(rows, lines)


def _align(rows: list[list[tuple[int, int, list[str]]]], lines: list[str]) -> None:
    """Adds rows of cells, aligned by the columns in which any cell begins."""
    firsts = sorted({a for row in rows for a, _, _ in row})
    rank = {a: i for i, a in enumerate(firsts)}
    rows = [[(rank[a], max(rank[a] + 1, bisect_left(firsts, b)), text) for a, b, text in row] for row in rows]
    width = [0] * len(firsts)
    for row in rows:
        for a, b, text in row:
            if b == a + 1:
                width[a] = max(width[a], *map(len, text))
    for row in rows:
        for a, b, text in row:
            if b > a + 1:  # what it needs beyond its columns goes to the last of them
                width[b - 1] += max(0, max(map(len, text)) - sum(width[a:b]) - 2 * (b - a - 1))
    place = [0]
    for w in width:
        place.append(place[-1] + w + 2)
    for row in rows:
        for k in range(max(len(text) for _, _, text in row)):
            line, length = [], 0
            for a, _, text in row:
                if k < len(text) and text[k]:
                    line += [" " * (place[a] - length), text[k]]
                    length = place[a] + len(text[k])
            lines.append("".join(line).rstrip())


def _listed(node: Node) -> bool:
    """Whether a select is a list box."""
    return "multiple" in node.attrs or _number(node.attrs.get("size", ""), 1) > 1


def extract(pages: DataFrame) -> DataFrame:
    """page_id, text, n_chars, n_blocks, n_items, n_cells."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("text"))

    def made(batches):
        for s in C.slices_of(batches, 4 << 20):
            done = [Page(x.as_py()) for x in s.column(1)]
            cols = [pa.array([p.text for p in done], pa.string()), *(pa.array([f(p) for p in done], pa.int64()) for f in (lambda p: len(p.text), lambda p: p.blocks, lambda p: p.items, lambda p: p.cells))]
            yield pa.RecordBatch.from_arrays([s.column(0), *cols], names=["page_id", "text", "n_chars", "n_blocks", "n_items", "n_cells"])

    return rows.mapInArrow(made, "page_id long, text string, n_chars long, n_blocks long, n_items long, n_cells long")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(C.shipped(spark).read.parquet(f"{sf_dir}/pages.parquet"))
