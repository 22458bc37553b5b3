"""HTML extraction by layout-aware rendering.

A tokenizer cuts the page into tags and text; a tree builder puts them into a tree, with the end tags that HTML lets authors
leave out (p, li, dt, dd, option, tr, td, th, thead, tbody, tfoot) implied; visibility rules drop what a browser doesn't
show; and a renderer lays out blocks: one line break between blocks, a blank line around paragraphs and headings,
markers and indentation for lists, and table rows with their cells aligned in columns, by the widths that characters are shown in.
All visible text is emitted, in document order.

Elements may be nested as deep as they like: the tree is built and walked with stacks of its own, and places of open tags are kept by
name, so that no tag searches the stack. Only layout is bounded, so that time and result don't grow with the square of the page:
boxes (list items, quotes, tables) beyond MAX_BOXES inside one another aren't indented or aligned any further, a table is
padded to no more than PADDING times its text, its widest columns getting less, and at most MAX_SPANS cells reach down into
later rows at a time. None of these hides or drops text.
"""

from __future__ import annotations

import html
import re
import unicodedata
from bisect import bisect_left, insort
from collections.abc import Generator, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import small_batches

# Fixed values from the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp plaintext".split())
UNSEEN = frozenset("head title script style template noscript iframe noembed noframes datalist audio video canvas object svg math".split()) - {"object", "svg", "math"}
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul caption select textarea".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure fieldset hr".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
LISTS = frozenset("ul ol menu dir".split())
#: tag -> the open tags it ends, and the tags beyond which it ends none.
IMPLIED = {
    "li": (frozenset(["li"]), LISTS),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist", "optgroup"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tr": (frozenset(["tr", "td", "th", "caption", "colgroup"]), frozenset(["table"])),
    "thead": (frozenset(["tr", "td", "th", "thead", "tbody", "tfoot", "caption", "colgroup"]), frozenset(["table"])),
    "body": (frozenset(["head"]), frozenset(["html"])),
}
IMPLIED["tbody"] = IMPLIED["tfoot"] = IMPLIED["thead"]

#: What ends the search for an open p, and for the end of an element from inside a table.
P_LIMITS = ("button", "td", "th", "table", "caption", "object", "body", "li", "div", "section", "article")
CELL_LIMITS = ("td", "th", "table", "caption")
OUT_OF_CELLS = frozenset("table tr tbody thead tfoot body html".split())

MAX_BOXES = 64
#: Blanks that pad a table's columns: this many for each character of its text, and FREE_PADDING for any table.
PADDING, FREE_PADDING = 16, 4096
MAX_SPANS = 64

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*?)(?:>|\Z)|<[!?/][^>]*>?", re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_BLANKS = re.compile(r"[ \t\n\r\f]+")
_HIDING = re.compile(r"display\s*:\s*none|content-visibility\s*:\s*hidden", re.I)
_VISIBILITY = re.compile(r"visibility\s*:\s*(hidden|collapse|visible)", re.I)


class Node:
    __slots__ = ("attributes", "children", "tag")

    def __init__(self, tag: str, attributes: dict | None = None):
        self.tag, self.attributes, self.children = tag, attributes or {}, []


class _Stack:
    """The open elements, and where those of each name are."""

    def __init__(self, root: Node):
        self.nodes: list[Node] = [root]
        self.places: dict[str, list[int]] = {}

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.nodes))
        self.nodes.append(node)

    def cut(self, at: int) -> None:
        """Closes the element at this place and all that are open in it."""
        while len(self.nodes) > at:
            self.places[self.nodes.pop().tag].pop()

    def last(self, tags) -> int:
        """The place of the innermost open element of these names; 0 if there is none."""
        places = self.places
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    def imply(self, tag: str) -> None:
        if tag in CLOSES_P and (at := self.last(("p",))) and at > self.last(P_LIMITS):
            self.cut(at)
        if tag in IMPLIED:
            ended, limits = IMPLIED[tag]
            while (at := self.last(ended)) and at > self.last(limits):
                self.cut(at)

    def end(self, tag: str) -> None:
        """Closes the innermost open element of that name; a cell or table is not left by an end tag from inside it for something outside."""
        at = self.last((tag,))
        if at and (tag in OUT_OF_CELLS or at >= self.last(CELL_LIMITS)):
            self.cut(at)


def parse(source: str) -> Node:
    """The page's tree: children are nodes and strings."""
    root = Node("#root")
    stack = _Stack(root)
    nodes = stack.nodes
    at, n = 0, len(source)
    lower = ""
    while at < n:
        cut = source.find("<", at)
        if cut < 0:
            cut = n
        if cut > at:
            nodes[-1].children.append(html.unescape(source[at:cut]))
        if cut == n:
            break
        m = _TOKEN.match(source, cut)
        if m is None:
            nodes[-1].children.append("<")
            at = cut + 1
            continue
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["end"]:
            if tag == "br":
                nodes[-1].children.append(Node("br"))
            stack.end(tag)
            continue
        stack.imply(tag)
        rest = m["rest"]
        node = Node(tag, {k.lower(): html.unescape(a or b or c) for k, a, b, c in reversed(_ATTRIBUTE.findall(rest))} if rest and not rest.isspace() else None)
        nodes[-1].children.append(node)
        if tag in VOID:
            continue
        if tag in RAW:
            lower = lower or source.lower()
            stop = lower.find(f"</{tag}", at) if tag != "plaintext" and len(lower) == n else _raw_end(source, tag, at)
            stop = n if stop < 0 else stop
            text = source[at:stop]
            node.children.append(html.unescape(text) if tag in ("textarea", "title") else text)
            at = stop
            if at < n and (m := _TOKEN.match(source, at)):
                at = m.end()
            continue
        if not (tag == "svg" and rest.rstrip().endswith("/")):
            stack.push(node)
    return root


def _raw_end(source: str, tag: str, at: int) -> int:
    if tag == "plaintext":
        return -1
    m = re.compile(f"</{re.escape(tag)}", re.I).search(source, at)
    return m.start() if m else -1


def _shown(node: Node) -> bool:
    a = node.attributes
    if node.tag in UNSEEN or node.tag == "dialog" and "open" not in a:
        return False
    if not a:
        return True
    if "hidden" in a and a["hidden"].lower() != "until-found" or node.tag == "input" and a.get("type", "").lower() == "hidden":
        return False
    return not ("style" in a and _HIDING.search(a["style"]))


def _seen(node: Node, inherited: bool) -> bool:
    if "style" in node.attributes and (m := _VISIBILITY.search(node.attributes["style"])):
        return m[1].lower() == "visible"
    return inherited


class _Lines:
    """Lines of a box. Runs of blanks are one; gap is the number of blank lines owed before the next text."""

    def __init__(self):
        self.lines: list[str] = []
        self.open: list[str] = []
        self.gap = 0
        self.blank = False

    def text(self, s: str, keep: bool) -> None:
        if keep:
            parts = s.replace("\r\n", "\n").split("\n")
            for i, p in enumerate(parts):
                if i:
                    self.line(True)
                if p:
                    self._put(p)
            return
        s = _BLANKS.sub(" ", s)
        if not s:
            return
        if s[0] == " ":
            self.blank = True
            s = s[1:]
        if not s:
            return
        if self.blank and self.open:
            self.open.append(" ")
        self.blank = s[-1] == " "
        self._put(s.rstrip(" ") if self.blank else s)

    def _put(self, s: str) -> None:
        if not self.open and self.gap and self.lines:
            self.lines.extend([""] * self.gap)
        self.gap = 0
        self.open.append(s)

    def line(self, forced: bool = False) -> None:
        if self.open:
            self.lines.append("".join(self.open))
            self.open = []
        elif forced and self.lines and self.gap == 0:
            self.lines.append("")
        self.blank = False

    def block(self, gap: int) -> None:
        self.line()
        self.gap = max(self.gap, gap)

    def box(self, lines: list[str], first: str, indent: str) -> None:
        self.line()
        for i, s in enumerate(lines):
            if i == 0:
                self._put(first + s)
                self.line()
            else:
                self.lines.append(indent + s if s else "")

    def done(self) -> list[str]:
        self.line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


def _number(s: str | None, default: int, low: int = 1, high: int = 1000) -> int:
    m = re.match(r"\s*(-?\d{1,9})", s or "")
    return min(high, max(low, int(m[1]))) if m else default


def _width(s: str) -> int:
    """Columns that a text takes on a screen: wide characters two, combining ones none."""
    if s.isascii():
        return len(s)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in s)


def _run(task: Generator):
    """Runs a task that yields the tasks it waits for, with a stack of its own."""
    tasks, value = [task], None
    while tasks:
        try:
            tasks.append(tasks[-1].send(value))
            value = None
        except StopIteration as done:
            tasks.pop()
            value = done.value
    return value


def _render(node: Node, out: _Lines, keep: bool, visible: bool, listed: bool, boxes: int) -> Generator:
    """Lays out the children of node. boxes: how many boxes it stands in."""
    ordered, count = node.tag == "ol", 0
    if node.tag in LISTS:
        count = _number(node.attributes.get("start"), 1, -(10**9), 10**9) - 1
    closed = node.tag == "details" and "open" not in node.attributes
    for child in node.children:
        if isinstance(child, str):
            if visible and not closed:
                out.text(child, keep)
            continue
        tag = child.tag
        if tag == "br":
            out.line(True)
            continue
        if not _shown(child) or closed and tag != "summary":
            continue
        seen = _seen(child, visible)
        kept = keep or tag in ("pre", "textarea", "xmp")
        boxed = boxes < MAX_BOXES
        if tag == "table" and boxed:
            lines = yield _table(child, seen, boxes + 1)
            out.block(1)
            out.box(lines, "", "")
            out.block(1)
        elif tag == "li":
            count = _number(child.attributes.get("value"), count + 1, -(10**9), 10**9) if ordered else count + 1
            mark = f"{count}. " if ordered else "- "
            if boxed:
                box = _Lines()
                yield _render(child, box, kept, seen, True, boxes + 1)
                if lines := box.done():
                    out.box(lines, mark, " " * len(mark))
            else:
                out.block(0)
                yield _render(child, out, kept, seen, True, boxes)
                out.block(0)
        elif tag in ("blockquote", "dd") and boxed:
            box = _Lines()
            yield _render(child, box, kept, seen, listed, boxes + 1)
            out.block(tag == "blockquote")
            out.box(box.done(), "  ", "  ")
            out.block(tag == "blockquote")
        elif tag in BLOCKS:
            gap = int(tag in SPACED and not (tag in LISTS and listed))
            out.block(gap)
            if child.children:
                yield _render(child, out, kept, seen, listed and tag not in SPACED or tag in LISTS, boxes)
            out.block(gap)
        elif child.children:
            yield _render(child, out, kept, seen, listed, boxes)


def _cells(table: Node, visible: bool) -> tuple[list, list]:
    """(rows of cells, what stands outside of cells), each with whether it is seen. Cells without a row are a row of their own."""
    rows, stray, loose = [], [], []

    def sort(children: list, seen: bool, sections: bool) -> None:
        nonlocal loose
        for child in children:
            if isinstance(child, str):
                if child.strip():
                    stray.append((child, seen))
                continue
            if not _shown(child):
                continue
            own = _seen(child, seen)
            if sections and child.tag in ("tbody", "thead", "tfoot"):
                sort(child.children, own, False)
            elif child.tag in ("td", "th"):
                loose.append((child, own))
            elif child.tag == "tr":
                if loose:
                    rows.append(loose)
                    loose = []
                cells = []
                for cell in child.children:
                    if isinstance(cell, str):
                        if cell.strip():
                            holder = Node("td")
                            holder.children = [cell]
                            cells.append((holder, own))
                    elif _shown(cell):
                        cells.append((cell, _seen(cell, own)))
                rows.append(cells)
            else:
                stray.append((child, own))

    sort(table.children, visible, True)
    return [*rows, loose] if loose else rows, stray


def _table(table: Node, visible: bool, boxes: int) -> Generator:
    """Rows of cells, padded to columns. What stands in a table outside its cells comes before the rows."""
    grouped, stray = _cells(table, visible)
    before = _Lines()
    for item, seen in stray:
        holder = Node("div")
        holder.children = [item]
        yield _render(holder, before, False, seen, False, boxes)
        before.block(0)
    rows: list[list[tuple[int, int, list[str]]]] = []
    reaching: list[tuple[int, int, int]] = []  # cells from earlier rows: first column, end, last row, by column
    for number, cells in enumerate(grouped):
        if reaching:
            reaching = [r for r in reaching if r[2] >= number]
        row, column, k, started = [], 0, 0, []
        for cell, seen in cells:
            wide = _number(cell.attributes.get("colspan"), 1)
            while k < len(reaching) and reaching[k][0] <= column:
                column = max(column, reaching[k][1])
                k += 1
            box = _Lines()
            yield _render(cell, box, False, seen, False, boxes)
            row.append((column, wide, box.done()))
            down = _number(cell.attributes.get("rowspan"), 1, 1, 65534)
            if down > 1 and len(reaching) + len(started) < MAX_SPANS:
                started.append((column, column + wide, number + down - 1))
            column += wide
        for r in started:
            insort(reaching, r)
        rows.append(row)
    widths: dict[int, int] = {}
    letters = 0
    for row in rows:
        for column, wide, lines in row:
            size = max(map(_width, lines), default=0)
            letters += sum(map(len, lines))
            if wide == 1:
                widths[column] = max(widths.get(column, 0), size)
    columns = sorted(widths)
    total, allowed = sum(len(max((c[2] for c in row), key=len, default=())) for row in rows), PADDING * letters + FREE_PADDING
    limit = max(widths.values(), default=0)
    while limit and sum(min(w, limit) + 2 for w in widths.values()) * total > allowed:
        limit //= 2
    starts, at = [], 0
    for c in columns:
        starts.append(at)
        at += min(widths[c], limit) + 2 if widths[c] else 0
    starts.append(at)
    out = before.done()
    for row in rows:
        for k in range(max((len(lines) for _, _, lines in row), default=0)):
            line, reach = [], 0
            for column, _, lines in row:
                if k < len(lines) and lines[k]:
                    blanks = starts[bisect_left(columns, column)] - reach
                    if reach:
                        blanks = max(blanks, 2)
                    line += [" " * blanks, lines[k]]
                    reach += blanks + _width(lines[k])
            out.append("".join(line))
    return out


def visible_text(source: str | None) -> str | None:
    """The text that a reader of the page sees. None for None."""
    if source is None:
        return None
    out = _Lines()
    _run(_render(parse(source), out, False, True, False, 0))
    return "\n".join(s.rstrip() for s in out.done())


def extract_text(pages: DataFrame, html_col: str = "html", text_col: str = "extracted", keep: tuple = ("page_id", "url")) -> DataFrame:
    """One row per row of pages: the columns in keep, and text_col.

    Null html gives null text; empty html, or a page with nothing to see, an empty text. Markup that ends in the middle is
    taken as far as it goes. Pages are parsed whole, one at a time; memory is bounded by the largest page. Repeated
    rows give repeated rows, an empty table an empty result. Other columns are not read, so they may have any names.
    """
    small_batches(pages.sparkSession)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in (pages.schema[c] for c in keep))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([visible_text(v.as_py()) for v in batch.column(batch.num_columns - 1)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], names=[*keep, text_col])

    return pages.select(*keep, html_col).mapInArrow(run, f"{fields}, `{text_col}` string")
