"""Visible text of web pages, laid out as a browser would place it.

A tolerant tree builder supplies the tags that authors leave out (ends of paragraphs, list items,
rows and cells, of the head, and rows around stray cells). Visibility follows the elements
themselves and their ``hidden`` and ``style`` attributes; style sheets are not read. All visible
text is emitted: blocks on lines of their own, paragraphs apart by an empty line, lists with
markers and indents, preformatted text as it is, and tables with aligned columns.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.llm.common import text_batches, whole_text

# Kinds of elements by HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noframes".split())
NEVER_SHOWN = frozenset(
    "head title script style template noscript iframe object audio video canvas datalist base link "
    "meta param source track noframes".split()
)
IN_HEAD = frozenset("base link meta title style script noscript template".split())
APART = frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol dl menu pre blockquote table figure hr fieldset xmp".split()
)  # an empty line before and after
BLOCK = APART | frozenset(
    "html body address article aside caption center dd details dialog dir div dt fieldset figcaption "
    "footer form header hgroup legend li main nav option search section summary tr tbody thead tfoot "
    "optgroup textarea".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = (BLOCK - frozenset("html body option optgroup textarea tr tbody thead tfoot caption legend".split()))
ROW_GROUPS = frozenset("tbody thead tfoot".split())
LISTS = frozenset("ul ol menu dir".split())
#: A start tag ends these open elements, looking no further out than the second set.
ENDS = {
    "li": (frozenset(["li"]), LISTS),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset(["select", "optgroup", "datalist"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
    "tr": (frozenset(["tr", "td", "th", "caption"]), frozenset(["table"]) | ROW_GROUPS),
    "td": (frozenset(["td", "th", "caption"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th", "caption"]), frozenset(["tr", "table"])),
    **{g: (frozenset(["tr", "td", "th", "caption", *ROW_GROUPS]), frozenset(["table"])) for g in ROW_GROUPS},
}
#: End tags of other elements do not reach out of these.
SCOPES = frozenset(["td", "th", "caption", "table", "html", "template"])
MAX_SPAN = 1000  # fixed value: the widest colspan of HTML
MAX_DEPTH = 512  # elements nested deeper lie side by side, as in browsers
NESTED_TABLES = 20  # tables nested deeper are laid out as plain blocks

_TAG_START = re.compile(r"<(?:(!--)|(/?)([a-zA-Z][^\s/>]*)|[!?/])")
_TAG_BREAK = re.compile(r"""[>"']""")
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
_SPACES = re.compile(r"[ \t\n\r\f]+")
_STYLE = re.compile(r"(display|visibility)\s*:\s*([a-z-]+)")
#: Attributes that the layout looks at; other tags' attributes are not parsed.
_TELLING = re.compile(r"hidden|style|span|start|open|type|value", re.I)


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str] | None = None) -> None:
        self.tag, self.attributes, self.children = tag, attributes or {}, []


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    if _TELLING.search(text):
        for name, a, b, c in _ATTRIBUTE.findall(text):
            found.setdefault(name.lower(), unescape(a or b or c))
    return found


def tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name or text, attributes) with kinds text, start, end; each byte is looked at a
    bounded number of times, whatever is left unclosed."""
    at, size, no_more = 0, len(html), set()
    while at < size:
        tag = _TAG_START.search(html, at)
        begin = tag.start() if tag else size
        if begin > at:
            yield "text", html[at:begin], ""
        if not tag:
            return
        at = tag.end()
        if tag[1]:  # a comment; "<!-->" is one too
            end = html.find("-->", at - 2)
            at = size if end < 0 else end + 3
            continue
        if not tag[3]:
            end = html.find(">", at)
            at = size if end < 0 else end + 1
            continue
        inside = at
        while True:
            mark = _TAG_BREAK.search(html, at)
            if not mark:
                return  # an unfinished tag at the end is no text
            at = mark.end()
            quote = mark[0]
            if quote == ">":
                break
            if html[inside : mark.start()].rstrip()[-1:] == "=" and quote not in no_more:
                end = html.find(quote, at)
                if end < 0:
                    no_more.add(quote)
                else:
                    at = inside = end + 1
        inside = tag.end()
        name, attributes = tag[3].lower(), html[inside : at - 1]
        if tag[2]:
            yield "end", name, ""
            continue
        yield "start", name, attributes
        if name in RAW:
            close = re.compile(f"</{name}(?=[\\s/>])", re.I).search(html, at)
            end = close.start() if close else size
            raw = html[at:end]
            yield "text", raw if name in ("script", "style", "xmp", "noframes") else unescape(raw), "raw"
            yield "end", name, ""
            end = html.find(">", end)
            at = size if end < 0 else end + 1


def build_tree(html: str) -> Node:
    root = Node("html")
    stack = [root]
    seen_body = False
    is_open: Counter = Counter()  # how many elements of a name lie on the stack

    def cut_to(size: int) -> None:
        is_open.subtract([node.tag for node in stack[size:]])
        del stack[size:]

    def close(tags: frozenset, barrier: frozenset) -> None:
        """End the outermost open element of ``tags`` inside the nearest of ``barrier``."""
        if not any(is_open[t] > 0 for t in tags):
            return
        cut = None
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in barrier:
                break
            if stack[i].tag in tags:
                cut = i
        if cut:
            cut_to(cut)

    def leave_head() -> None:
        if len(stack) > 1 and stack[1].tag == "head":
            cut_to(1)

    def open_(tag: str, attributes: dict | None = None) -> None:
        node = Node(tag, attributes)
        stack[-1].children.append(node)
        if len(stack) < MAX_DEPTH:
            stack.append(node)
            is_open[tag] += 1

    for kind, name, attributes in tokens(html):
        top = stack[-1]
        if kind == "text":
            if top.tag == "head" and not name.isspace():
                leave_head()
            if top.tag in ("table", "tr") or top.tag in ROW_GROUPS:
                if name.isspace():
                    continue  # blanks between cells are no content
            stack[-1].children.append(unescape(name) if attributes != "raw" and "&" in name else name)
        elif kind == "start":
            if name in ("html", "body"):
                leave_head()
                if name == "body" and not seen_body:
                    seen_body = True
                    root.children.append(Node("body", _attributes(attributes)))
                    cut_to(1)
                    stack.append(root.children[-1])
                continue
            if name == "head":
                if len(stack) == 1 and not seen_body:
                    open_("head")
                continue
            if name not in IN_HEAD:
                leave_head()
            if name in CLOSES_P:
                close(frozenset(["p"]), SCOPES | frozenset(["button"]))
            if name in HEADINGS and stack[-1].tag in HEADINGS:
                cut_to(len(stack) - 1)
            if name == "a":
                close(frozenset(["a"]), SCOPES | BLOCK)
            if name in ENDS:
                close(*ENDS[name])
            if name in ("td", "th") and stack[-1].tag != "tr":
                open_("tr")
            node_attributes = _attributes(attributes)
            if name in VOID:
                stack[-1].children.append(Node(name, node_attributes))
            else:
                open_(name, node_attributes)
        else:
            if name == "br":
                stack[-1].children.append(Node("br"))
                continue
            if name in ("html", "body") or is_open[name] <= 0:
                continue
            scope = SCOPES - {name} if name in SCOPES else SCOPES
            if name == "table":
                scope = frozenset(["html", "template"])
            elif name in ROW_GROUPS or name == "tr":
                scope = frozenset(["table", "html", "template"])
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == name:
                    cut_to(i)
                    break
                if stack[i].tag in scope:
                    break
    return root


def _shown(node: Node, visible: bool) -> tuple[bool, bool]:
    """(laid out at all, text visible) of an element under a parent's visibility."""
    if node.tag in NEVER_SHOWN:
        return False, False
    a = node.attributes
    if not a:
        return node.tag != "dialog", visible
    if "hidden" in a or (node.tag == "dialog" and "open" not in a):
        return False, False
    for rule, value in _STYLE.findall(a.get("style", "").lower()):
        if rule == "display" and value == "none":
            return False, False
        if rule == "visibility":
            visible = value == "visible" if value in ("visible", "hidden", "collapse") else visible
    return True, visible


class Flow:
    """Lines of one formatting context."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.parts: list[str] = []  # of the current line
        self.space = False  # a blank is due before the next word
        self.apart = False  # an empty line is due before the next line
        self.indent: list[str] = []
        self.marker: str | None = None

    def text(self, text: str) -> None:
        words = [w for w in _SPACES.split(text) if w]
        if not words:
            self.space = self.space or bool(text)
            return
        if self.parts and (self.space or text[0] in " \t\n\r\f"):
            self.parts.append(" ")
        self.parts.append(" ".join(words))
        self.space = text[-1] in " \t\n\r\f"

    def preformatted(self, text: str) -> None:
        first, *rest = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
        self.parts.append(first)
        for line in rest:
            self.end_line(keep=True)
            self.parts.append(line)

    def end_line(self, keep: bool = False) -> None:
        line = "".join(self.parts).rstrip()
        self.parts, self.space = [], False
        if not line and not keep:
            return
        if self.apart and self.lines:
            self.lines.append("")
        self.apart = False
        prefix = "".join(self.indent)
        if self.marker is not None:
            prefix = prefix[: len(prefix) - len(self.marker)] + self.marker
            self.marker = None
        self.lines.append((prefix + line).rstrip())

    def margin(self) -> None:
        self.end_line()
        self.apart = True

    def block(self, lines: list[str]) -> None:
        self.end_line()
        for line in lines:
            self.parts = [line]
            self.end_line(keep=True)

    def finish(self) -> list[str]:
        self.end_line()
        return self.lines


def _markers(node: Node) -> Iterator[str]:
    """Markers of a list's items, one after the other."""
    if node.tag != "ol":
        while True:
            yield "- "
    try:
        number = int(node.attributes.get("start", "1"))
    except ValueError:
        number = 1
    while True:
        yield f"{number}. "
        number += 1


def render(root: Node, visible: bool = True, nested: int = 0) -> list[str]:
    """Lines of the visible text below ``root``, without recursion but for tables in tables."""
    flow = Flow()
    pre = 0
    lists: list[Iterator[str]] = []
    stack: list = [("open", c, visible) for c in reversed(root.children)]
    while stack:
        step, node, visible = stack.pop()
        if step == "close":
            node()
            continue
        if isinstance(node, str):
            if visible:
                flow.preformatted(node) if pre else flow.text(node)
            continue
        tag = node.tag
        laid_out, visible = _shown(node, visible)
        if not laid_out:
            continue
        if tag == "br":
            flow.end_line(keep=True)
            continue
        if tag == "input":
            if visible and node.attributes.get("type", "").lower() in ("submit", "button", "reset"):
                flow.text(f" {node.attributes.get('value', '')} ")
            continue
        children = node.children
        if tag == "table" and nested < NESTED_TABLES:
            flow.margin()
            flow.block(_table_lines(node, visible, nested + 1))
            flow.margin()
            continue
        if tag in ("td", "th"):
            flow.text(" ")
        if tag == "details" and "open" not in node.attributes:
            children = [c for c in children if isinstance(c, Node) and c.tag == "summary"]
        ends = []
        if tag in BLOCK:
            # Lists inside lists stay together.
            edge = flow.margin if tag in APART and not (tag in LISTS and lists) else flow.end_line
            edge()
            ends.append(edge)
        if tag in ("pre", "xmp", "textarea"):
            pre += 1
            if children and isinstance(children[0], str) and children[0][:1] == "\n":
                children = [children[0][1:], *children[1:]]
            ends.append(lambda: None)
        if tag in LISTS:
            lists.append(_markers(node))
        elif tag == "li":
            marker = next(lists[-1]) if lists else "- "
            flow.indent.append(" " * len(marker))
            flow.marker = marker
        elif tag in ("dd", "blockquote"):
            flow.indent.append("    ")

        def leave(tag=tag, ends=tuple(ends)) -> None:
            nonlocal pre
            for end in ends:
                end()
            if tag in ("pre", "xmp", "textarea"):
                pre -= 1
            if tag in LISTS:
                lists.pop()
            elif tag == "li":
                flow.indent.pop()
                flow.marker = None
            elif tag in ("dd", "blockquote"):
                flow.indent.pop()

        stack.append(("close", leave, visible))
        stack += [("open", c, visible) for c in reversed(children)]
    return flow.finish()


def _span(cell: Node, name: str, most: int) -> int:
    try:
        return min(max(int(cell.attributes.get(name, "1")), 1), most)
    except ValueError:
        return 1


def _table_lines(table: Node, visible: bool, nested: int) -> list[str]:
    """Lines of a table: captions and stray content first, then rows of aligned cells."""
    above, rows, groups = Node("div"), [], [(table, visible)]
    while groups:
        group, shown = groups.pop(0)
        for child in group.children:
            if isinstance(child, str) or child.tag not in ("tr", *ROW_GROUPS):
                above.children.append(child)
                continue
            laid_out, own = _shown(child, shown)
            if laid_out and child.tag == "tr":
                rows.append((child, own))
            elif laid_out:
                rows += [(r, _shown(r, own)[1]) for r in child.children
                         if isinstance(r, Node) and r.tag == "tr" and _shown(r, own)[0]]
                above.children += [c for c in child.children if isinstance(c, str) or c.tag != "tr"]
    grid: list[list[tuple[int, int, list[str]]]] = []
    taken: dict[int, int] = {}  # columns held by a cell that spans rows, and for how many more
    for row, shown in rows:
        cells, column = [], 0
        blocked, taken = taken, {c: n - 1 for c, n in taken.items() if n > 1}
        for cell in row.children:
            if isinstance(cell, str) or cell.tag not in ("td", "th"):
                above.children.append(cell)
                continue
            laid_out, own = _shown(cell, shown)
            if not laid_out:
                continue
            while column in blocked:
                column += 1
            wide = _span(cell, "colspan", MAX_SPAN)
            high = _span(cell, "rowspan", len(rows))
            cells.append((column, wide, render(cell, own, nested)))
            if high > 1:
                taken.update({c: high - 1 for c in range(column, column + wide)})
            column += wide
        grid.append(cells)
    # Columns in which no cell begins take no room.
    used = sorted({column for cells in grid for column, _, _ in cells})
    place = {c: i for i, c in enumerate(used)}
    width = [0] * len(used)
    spanning = []
    for cells in grid:
        for column, wide, lines in cells:
            first = place[column]
            last = first + 1
            while last < len(used) and used[last] < column + wide:
                last += 1
            longest = max(map(len, lines), default=0)
            if last - first == 1:
                width[first] = max(width[first], longest)
            else:
                spanning.append((first, last, longest))
    for first, last, longest in spanning:
        have = sum(width[first:last]) + 2 * (last - first - 1)
        width[last - 1] += max(0, longest - have)
    begin, at = [], 0
    for w in width:
        begin.append(at)
        at += w + 2
    out = render(above, visible, nested)
    for cells in grid:
        for i in range(max((len(lines) for _, _, lines in cells), default=0)):
            line = ""
            for column, _, lines in cells:
                if i < len(lines) and lines[i]:
                    line = line.ljust(begin[place[column]]) + lines[i]
            out.append(line.rstrip())
    return out


def page_text(html: str) -> str:
    """Visible text of one page; no-break spaces become plain ones."""
    return "\n".join(render(build_tree(html))).replace("\xa0", " ").strip("\n")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, text) of every row of ``pages``.

    A null or empty page has an empty text; rows are neither merged nor dropped, and a null page_id
    stays null. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [page_text(h) for h in batch.column("_html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), pa.array(texts, pa.string())], ["page_id", "text"]
            )

    text_batches(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("bigint"), whole_text("html").alias("_html"))
    return rows.mapInArrow(run, "page_id bigint, text string")
