"""Visible text of a web page, laid out like a browser would in plain text.

A tokenizer feeds a tree builder that knows void elements and implied end tags (p, li, dt, dd,
option, table parts, a head before content of the body); a renderer walks the tree. Hidden are
script, style, template, noscript, head, title, values of input elements, datalist, iframe, object, audio,
video and canvas, comments, what svg and math do not draw (UNDRAWN), elements with the hidden attribute or
display:none in their style, and text whose nearest visibility in a style is hidden or collapse. (aria-hidden
hides nothing on a screen.) A select shows its selected option, or all if it is a list; the text of a textarea is
shown. Other text of svg and math is inline text; labels of an svg, cells of a matrix and the parts of a fraction
have a blank around them. White space collapses outside pre. Blocks stand on lines of their own; paragraphs,
headings, lists, tables, quotes and pre have an empty line around them. List items are marked with "- " or
their number and indented by level.

Cells of a table lie in a grid, with rowspan and colspan; a cell stands in the first row and column it covers.
Columns in which no cell begins take no room. A column is as wide as its longest line, at most WIDEST, and two
blanks apart from the next; a longer line moves what is right of it. A line gets at most PADDING blanks for
alignment; beyond them its cells are two blanks apart. So a page's text grows in proportion to the page. What
stands in a table or row outside its cells comes before them. A table of one cell alone is a block. A table within
DEEPEST others is not aligned, its cells are blocks; no text is lost.

Tags end at the first > outside quoted values. If that leaves a tag open to the end of the page, quotes protect
no > from there on; a tag without any > is text. A tree of n tags is built in time proportional to n.

Results in special cases: a null or empty page gives an empty text; tags that are never closed end
with their parent; a stray end tag is ignored; tables in cells are laid out within the cell; a
null page_id is carried on; repeated rows are rendered one by one.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict

from pyspark.sql import DataFrame, functions as F

from parcelake.llm import tables

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style template noscript head title datalist iframe object audio video canvas".split())
#: not drawn inside svg and math, and parts of them that are drawn apart from what is beside them
UNDRAWN = frozenset("annotation annotation-xml mphantom defs desc metadata symbol clippath mask pattern "
                    "marker".split())
APART = frozenset("text mtd".split())
FIELDS = frozenset("textarea select".split())
RAW = frozenset("script style textarea title iframe noscript".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure hr".split())
BLOCK = SPACED | frozenset(
    "html body div section article main header footer nav aside address form fieldset legend li dt dd "
    "figcaption details summary tr td th thead tbody tfoot caption center option".split())
#: start tag -> open elements it ends, and the elements it does not look beyond
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
}
IMPLIED["tbody"] = IMPLIED["tfoot"] = IMPLIED["thead"]
IMPLIED["body"] = ({"head"}, set())
# an open head ends where any other element or text begins
HEAD_CONTENT = frozenset("title meta link base script style noscript template".split())
# a paragraph ends where one of these begins
ENDS_P = frozenset("address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 "
                   "h4 h5 h6 header hr main nav ol p pre section table ul".split())
_SCOPE = frozenset("td th table body html caption button".split())
ROWS = frozenset("tr table tbody thead tfoot".split())

DEEPEST = 20        # tables of several cells around a table that is still aligned
WIDEST = 80         # characters of a column
PADDING = 400       # blanks that align one line

_MARKUP = re.compile(r"<(?:!--|[!?]|(/?)([a-zA-Z][^\s/>]*+))")
_BODY = re.compile(r"((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>")
_ATTRIBUTE = re.compile(r"([^\s=/\"']++)(?:\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s>]++))?+")
_SPACES = re.compile(r"[ \t\n\r\f]+")


class Node:
    """An element. `hidden`: it and all below it are not shown; `seen`: its own text is visible."""

    __slots__ = ("name", "attributes", "children", "hidden", "seen")

    def __init__(self, name: str, attributes: dict[str, str], seen: bool = True):
        self.name, self.attributes, self.seen = name, attributes, seen
        self.children: list[Node | str] = []
        self.hidden = name in HIDDEN or "hidden" in attributes
        if "style" in attributes:
            style = declarations(attributes["style"])
            self.hidden = self.hidden or style.get("display") == "none"
            if style.get("visibility") in ("visible", "hidden", "collapse"):
                self.seen = style["visibility"] == "visible"


def declarations(style: str) -> dict[str, str]:
    """Properties of a style attribute; the last of a name counts."""
    pairs = (part.partition(":") for part in style.lower().split(";"))
    return {name.strip(): value.replace("!important", "").strip() for name, _, value in pairs}


def attributes_of(text: str) -> dict[str, str]:
    if not text or text.isspace() or text == "/":
        return {}
    return {name.lower(): html.unescape(value.strip("\"'"))
            for name, value in _ATTRIBUTE.findall(text)}


def tags(source: str):
    """(text before, end tag?, name, attribute text, place behind) of each tag; a name of None: no tag, but a
    comment or the end. The caller may send a place to go on from, such as the end of a script."""
    last = source.rfind(">")
    quoted = True
    begun = at = 0
    while found := _MARKUP.search(source, at):
        at, name, body = found.end(), found[2], ""
        if name is None and found[0] == "<!--":
            stop = source.find("-->", found.start() + 2)
            stop = len(source) if stop < 0 else stop + 3
        elif at > last:
            continue                        # no > any more: text
        elif name is None:
            stop = source.index(">", at) + 1
        else:
            whole = _BODY.match(source, at) if quoted else None
            quoted = whole is not None
            stop = whole.end() if whole else source.index(">", at) + 1
            body = source[at:stop - 1]
        sent = yield source[begun:found.start()], bool(found[1]), name, body, stop
        begun = at = stop if sent is None else sent
    yield source[begun:], False, None, "", len(source)


def build(source: str) -> Node:
    """The tree of a page."""
    root = Node("#root", {})
    stack = [root]
    depths: dict[str, list[int]] = defaultdict(list)    # name -> its places on the stack

    def pop(depth: int) -> None:
        for node in stack[depth:]:
            depths[node.name].pop()
        del stack[depth:]

    def innermost(names) -> int:
        """Depth of the innermost open element of these names, 0 for none."""
        return max((depths[n][-1] for n in names if depths.get(n)), default=0)

    def close(names, barrier) -> None:
        """End the named elements up to the barrier: a cell, then its row."""
        while (depth := innermost(names)) > innermost(barrier):
            pop(depth)

    def put(text: str) -> None:
        text = html.unescape(text)
        if stack[-1].name == "head" and text.strip(" \t\n\r\f"):
            pop(len(stack) - 1)
        stack[-1].children.append(text if stack[-1].seen else _SPACES.search(text) and " " or "")

    found = tags(source)
    go_on = None
    while True:
        try:
            text, ends, name, body, at = found.send(go_on)
        except StopIteration:
            return root
        go_on = None
        if text:
            put(text)
        if name is None:
            continue
        name = name.lower()
        if ends:
            depth = innermost((name,))
            wall = innermost(("table",) if name in ROWS else ("table", "td", "th"))
            if depth and depth >= wall:
                pop(depth)
            elif name == "p" and not depth:
                stack[-1].children.append(Node("p", {}))
            continue
        if stack[-1].name == "head" and name not in HEAD_CONTENT:
            pop(len(stack) - 1)
        if name in ENDS_P:
            close({"p"}, _SCOPE)
        if name in IMPLIED:
            close(*IMPLIED[name])
        node = Node(name, attributes_of(body), stack[-1].seen)
        if depths["svg"] or depths["math"]:
            node.hidden = node.hidden or name in UNDRAWN
            if name in APART or stack[-1].name == "mfrac":
                node.attributes["#apart"] = ""
        if name in FIELDS:
            node.attributes["#apart"] = ""
        stack[-1].children.append(node)
        if name in VOID or body.endswith("/") and name not in BLOCK:
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*+>", re.IGNORECASE).search(source, at)
            if not node.hidden and node.seen:
                inner = source[at:end.start() if end else len(source)]
                node.children.append(html.unescape(inner) if name == "textarea" else inner)
            go_on = end.end() if end else len(source)
            continue
        depths[name].append(len(stack))
        stack.append(node)


class Page:
    """Lines under construction. `gap` is the number of line ends owed before the next text."""

    def __init__(self, depth: int = 0):
        self.depth = depth              # tables around this page
        self.done: list[str] = []
        self.line: list[str] = []
        self.gap = 0
        self.space = False
        self.indent = ""
        self.mark = ""

    def block(self, gap: int) -> None:
        if self.line:
            self.done.append("".join(self.line).rstrip())
            self.line = []
        self.gap = max(self.gap, gap)
        self.space = False

    def write(self, text: str) -> None:
        if not self.line:
            if self.done and self.gap > 1 and self.done[-1] != "":
                self.done.append("")
            self.gap = 0
            self.line.append((self.indent[:-len(self.mark)] + self.mark) if self.mark else self.indent)
            self.mark = ""
        self.line.append(text)

    def words(self, text: str) -> None:
        text = _SPACES.sub(" ", text)
        if text.startswith(" "):
            self.space = True
            text = text[1:]
        if not text:
            return
        if self.space and self.line:
            text = " " + text
        self.space = text.endswith(" ")
        self.write(text.rstrip(" "))

    def text(self) -> str:
        self.block(0)
        return "\n".join(self.done).strip("\n")


def render(node: Node, page: Page) -> None:
    """Append a node's visible content; nesting is walked with a stack of steps, not recursion."""
    steps: list = [node]
    while steps:
        step = steps.pop()
        if callable(step):
            step()
        elif isinstance(step, str):
            page.words(step)
        elif not step.hidden:
            begin(step, page, steps)


def begin(node: Node, page: Page, steps: list) -> None:
    name = node.name
    if name == "br":
        if page.line:
            page.block(1)
        else:
            page.gap = 2
        return
    if name == "pre":
        page.block(2)
        for k, line in enumerate(content(node).strip("\n").split("\n")):
            if k:
                page.block(1)
            page.write(line)
        page.block(2)
        return
    if name == "table":
        outside, rows = table_parts(node)
        page.block(2)
        if (outside or sum(map(len, rows)) > 1) and page.depth < DEEPEST:
            for line in table_lines(outside, rows, page.depth + 1):
                page.write(line)
                page.block(1)
            page.block(2)
        else:
            steps.append(lambda: page.block(2))
            steps.extend(cell for row in reversed(rows) for cell in reversed(row))
            for part in reversed(outside):
                steps += [lambda: page.block(1), part]
        return
    if name == "select":
        steps.append(lambda: setattr(page, "space", True))
        for option in reversed(shown_options(node)):
            steps.extend(reversed(option.children))
            steps.append(lambda: setattr(page, "space", True))
        return
    if name == "img" and node.attributes.get("alt") and node.seen:
        page.words(node.attributes["alt"])
        return
    if "#apart" in node.attributes:
        page.space = True
        steps.append(lambda: setattr(page, "space", True))
    if name not in BLOCK:
        steps.extend(reversed(node.children))
        return
    gap = 2 if name in SPACED and not (name in ("ul", "ol") and page.indent) else 1
    before = page.indent
    page.block(gap)
    if name in ("ul", "ol", "menu"):
        number = int(node.attributes["start"]) if node.attributes.get("start", "").isdigit() else 1
        for child in node.children:
            if isinstance(child, Node) and child.name == "li" and not child.hidden:
                child.attributes["#"] = f"{number}. " if name == "ol" else "- "
                number += 1
    if name == "li":
        page.mark = node.attributes.get("#", "- ")
        page.indent += " " * len(page.mark)
    if name in ("blockquote", "dd"):
        page.indent += "  "

    def end():
        page.block(gap)
        page.indent, page.mark = before, ""

    steps.append(end)
    steps.extend(reversed(node.children))


def content(node: Node) -> str:
    """All visible text below a node as it stands."""
    out, steps = [], [node]
    while steps:
        step = steps.pop()
        if isinstance(step, str):
            out.append(step.replace("\r\n", "\n"))
        elif step.name == "br":
            out.append("\n")
        elif not step.hidden:
            steps.extend(reversed(step.children))
    return "".join(out)


def row_parts(row: Node) -> tuple[list[Node], list[Node | str]]:
    """Cells of a row, also those inside other elements, and what else the row shows."""
    below, parents = [row], [0]
    for k, node in enumerate(below):        # grows while it is walked
        if k == 0 or node.name not in ("td", "th", "table"):
            inner = [c for c in node.children if isinstance(c, Node) and not c.hidden]
            below += inner
            parents += [k] * len(inner)
    holding = set()                         # elements that are or hold a cell
    for node, parent in zip(reversed(below), reversed(parents)):
        if node.name in ("td", "th") or id(node) in holding:
            holding |= {id(node), id(below[parent])}
    cells, rest = [], []
    steps = list(reversed(row.children))
    while steps:
        child = steps.pop()
        if isinstance(child, str):
            if not child.isspace():
                rest.append(child)
        elif child.hidden:
            pass
        elif child.name in ("td", "th"):
            cells.append(child)
        elif id(child) in holding:
            steps.extend(reversed(child.children))
        else:
            rest.append(child)
    return cells, rest


def shown_options(select: Node) -> list[Node]:
    """Options of a select that a page shows: all of a list, else the last selected or the first."""
    options, steps = [], list(reversed(select.children))
    while steps:
        child = steps.pop()
        if isinstance(child, Node) and not child.hidden:
            if child.name == "option":
                options.append(child)
            else:
                steps.extend(reversed(child.children))
    if "multiple" in select.attributes or select.attributes.get("size", "1") not in ("", "0", "1"):
        return options
    return ([o for o in options if "selected" in o.attributes] or options[:1])[-1:]


def table_parts(table: Node) -> tuple[list[Node | str], list[list[Node]]]:
    """What a table shows outside its cells, captions last, and the cells of its rows."""
    rows: list[list[Node]] = []
    captions, loose = [], []
    steps = list(reversed(table.children))
    while steps:
        child = steps.pop()
        if isinstance(child, str):
            if not child.isspace():
                loose.append(child)
        elif child.hidden:
            pass
        elif child.name in ("thead", "tbody", "tfoot"):
            steps.extend(reversed(child.children))
        elif child.name == "tr":
            cells, rest = row_parts(child)
            rows.append(cells)
            loose += rest
        elif child.name in ("td", "th"):
            rows.append([child])
        elif child.name == "caption":
            captions.append(child)
        elif child.name not in ("colgroup", "col"):
            loose.append(child)
    return [*loose, *captions], rows


def span(cell: Node, name: str, most: int) -> int:
    value = cell.attributes.get(name, "").strip()
    return min(max(int(value), 1), most) if value.isascii() and value.isdigit() and len(value) < 10 else 1


def placed(rows: list[list[Node]]) -> list[list[tuple[int, Node]]]:
    """Each row's cells with their columns; cells of earlier rows that reach down take their columns first.

    `below` holds such columns as sorted runs (first, behind, last row); runs that end alike are one."""
    grid, below = [], []
    for number, row in enumerate(rows):
        runs = []
        for first, behind, last in sorted(below):
            if last >= number:
                if runs and runs[-1][1] >= first and runs[-1][2] == last:
                    runs[-1] = (runs[-1][0], max(behind, runs[-1][1]), last)
                else:
                    runs.append((first, behind, last))
        below = list(runs)
        column = k = 0
        line = []
        for cell in row:
            while k < len(runs) and runs[k][0] <= column:
                column = max(column, runs[k][1])
                k += 1
            line.append((column, cell))
            wide, high = span(cell, "colspan", 1000), span(cell, "rowspan", 65534)
            if high > 1 and number + 1 < len(rows):
                below.append((column, column + wide, min(number + high, len(rows)) - 1))
            column += wide
        grid.append(line)
    return grid


def table_lines(outside: list[Node | str], rows: list[list[Node]], depth: int) -> list[str]:
    """Outside parts, then the rows with their cells aligned."""
    lines: list[str] = []
    for part in outside:
        page = Page(depth)
        render(part if isinstance(part, Node) else wrapped(part), page)
        lines += page.text().split("\n") if page.text() else []
    texts = []                              # per row: (column, lines) of its cells
    for row in placed(rows):
        texts.append([])
        for column, cell in row:
            page = Page(depth)
            for child in cell.children:
                render(child if isinstance(child, Node) else wrapped(child), page)
            texts[-1].append((column, page.text().split("\n")))
    widths: dict[int, int] = defaultdict(int)
    for row in texts:
        for column, cell in row:
            widths[column] = max(widths[column], min(WIDEST, max(map(len, cell))))
    starts, begin_at = {}, 0
    for column in sorted(widths):
        starts[column] = begin_at
        begin_at += widths[column] + 2
    for row in texts:
        if row:
            lines += row_lines([(starts[column], cell) for column, cell in row])
    return lines


def row_lines(cells: list[tuple[int, list[str]]]) -> list[str]:
    """Lines of a row from the cells' lines and the places where they should begin."""
    parts: list[list[tuple[int, str]]] = [[] for _ in range(max(len(cell) for _, cell in cells))]
    for start, cell in cells:
        for line, text in zip(parts, cell):
            if text:
                line.append((start, text))
    lines = []
    for line in parts:
        out, length, left = [], 0, PADDING
        for start, text in line:
            least = 2 if out else 0
            indent = len(text) - len(text.lstrip(" "))
            blanks = max(least, min(start - length, left - indent))
            left -= blanks + indent
            out += [" " * blanks, text]
            length += blanks + len(text)
        lines.append("".join(out).rstrip())
    return lines


def wrapped(text: str) -> Node:
    node = Node("#text", {})
    node.children.append(text)
    return node


def visible_text(source: str | None) -> str:
    """The laid-out text of one page."""
    if not source:
        return ""
    page = Page()
    render(build(source), page)
    return page.text()


def extract(pages: DataFrame) -> DataFrame:
    """page_id, text, n_chars, n_lines of every page."""
    def step(batch):
        texts = [visible_text(t) for t in batch.column("html").to_pylist()]
        return {"page_id": batch.column("page_id"), "text": texts, "n_chars": [len(t) for t in texts],
                "n_lines": [t.count("\n") + 1 if t else 0 for t in texts]}

    return tables.mapped(pages.select(F.col("page_id").cast("long").alias("page_id"), "html"), step,
                         "page_id long, text string, n_chars long, n_lines long")
