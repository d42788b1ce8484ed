"""Layout-aware text of HTML pages: a tree builder with implied tags, then a rendering of what is visible."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER_SHOWN = frozenset("head title script style template noscript iframe object audio video canvas svg math datalist".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main nav ol p pre section summary table tbody tfoot thead tr ul caption option select legend".split())
SPACED = frozenset("article blockquote dl figure h1 h2 h3 h4 h5 h6 ol p pre section table ul".split())
CLOSES_P = frozenset("address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul li dd dt".split())
#: An opening tag ends the nearest open one of these tags, if no tag of the second set lies between.
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "caption"}, {"table"}), "td": ({"td", "th", "caption"}, {"tr", "table"}), "th": ({"td", "th", "caption"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "caption"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot", "caption"}, {"table"}), "thead": ({"tbody", "thead", "tfoot", "caption"}, {"table"}),
    "body": ({"head"}, set()),
}
SCOPE = frozenset({"table", "td", "th", "html", "button", "caption"})

# Fixed values of the HTML standard: the most columns and rows that a cell spans.
MOST_COLUMNS, MOST_ROWS = 1000, 65534

#: Cells are padded to their column's width up to so many characters, so that one long cell doesn't pad a whole column.
CELL_WIDTH = 40
#: Cells are aligned over so many columns of a table; those further right follow unpadded, so that a row's text is bounded.
COLUMNS = 128
#: The indent of nested lists stops growing at so many characters, so that the text of deep lists grows with the page.
INDENT = 160
#: Tables nested deeper are rendered as plain blocks: their text stays, its columns don't, as every level indents all within.
NESTED_TABLES = 64
#: A tag, comment or declaration that the page ends in, and so never ends.
_UNFINISHED = re.compile(r"<(?:[a-zA-Z!?]|/[a-zA-Z])")
_NUMBER = re.compile(r"[ \t\n\r\f]*([+-]?[0-9]+)")
_SIMPLE = re.compile(r"[a-zA-Z][\w-]*|[.#][\w-]+")
_SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("attrs", "children", "tag")

    def __init__(self, tag: str, attrs: dict):
        self.tag, self.attrs, self.children = tag, attrs, []


class TreeBuilder(HTMLParser):
    """Nodes with implied end tags. Where every tag is open is known, so that no end is searched for in the open nodes."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", {})
        self.open = [self.root]
        self.at: defaultdict[str, list[int]] = defaultdict(list)
        self.styles: list[str] = []

    def last(self, tags: frozenset | set) -> int:
        return max((at[-1] for at in map(self.at.get, tags) if at), default=0)

    def end_until(self, tags: frozenset | set, scope: frozenset | set) -> None:
        k = self.last(tags)
        if k and k >= self.last(scope):
            for node in self.open[k:]:
                self.at[node.tag].pop()
            del self.open[k:]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in CLOSES_P:
            self.end_until({"p"}, SCOPE)
        if tag in IMPLIED_END:
            tags, scope = IMPLIED_END[tag]
            self.end_until(tags, scope)
        node = Node(tag, dict(attrs))
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.at[tag].append(len(self.open))
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.open[-1].children.append(Node("br", {}))
        elif tag not in VOID:
            self.end_until({tag}, SCOPE - {tag} if tag in BLOCKS and tag not in ("table", "html", "body") else {"table"} - {tag})

    def close(self) -> None:
        """What begins in the page's last unfinished tag or comment belongs to it and isn't shown, as in a browser; it isn't read again from every place in it."""
        if self.cdata_elem is None and _UNFINISHED.match(self.rawdata):
            self.rawdata = ""
        super().close()

    def handle_data(self, data: str) -> None:
        if self.open[-1].tag == "style":
            self.styles.append(data)
        else:
            self.open[-1].children.append(data)


class Shown(NamedTuple):
    """What a style says: whether the element is rendered at all, and whether its own text shows; None where it says nothing."""

    rendered: bool | None = None
    visible: bool | None = None

    def then(self, other: Shown) -> Shown:
        return Shown(*(a if b is None else b for a, b in zip(self, other, strict=True)))


def declared(style: str) -> Shown:
    rendered = visible = None
    for part in style.split(";"):
        name, _, value = part.partition(":")
        name, value = name.strip().lower(), value.partition("!")[0].strip().lower()
        if name == "display" and value:
            rendered = value != "none"
        elif name == "visibility" and value in ("visible", "hidden", "collapse"):
            visible = value == "visible"
    return Shown(rendered, visible)


def style_rules(styles: list[str]) -> dict[str, Shown]:
    """What the page's own style sheets say of tags, .classes and #ids; other selectors are ignored. Of equal selectors the later counts."""
    found: dict[str, Shown] = {}
    for chunk in " ".join(styles).split("}")[:-1]:
        before, brace, rules = chunk.rpartition("{")
        said = declared(rules)
        if brace and said != Shown():
            for selector in map(str.strip, before.rpartition("{")[2].split(",")):
                if _SIMPLE.fullmatch(selector):
                    found[selector] = found.get(selector, Shown()).then(said)
    return found


def shown(node: Node, rules: dict[str, Shown]) -> Shown:
    """rendered: False if neither the element nor anything in it is. visible: None if as its parent."""
    a, tag = node.attrs, node.tag
    if tag in NEVER_SHOWN or (tag == "input" and (a.get("type") or "").lower() == "hidden"):
        return Shown(False)
    out = Shown(False) if "hidden" in a or (tag == "dialog" and "open" not in a) else Shown()
    if rules:
        for selector in (tag, *(f".{c}" for c in (a.get("class") or "").split()), f"#{a.get('id')}"):
            if selector in rules:
                out = out.then(rules[selector])
    return out.then(declared(a["style"])) if a.get("style") else out


class Flow:
    """Lines of text under construction: white space collapses, blocks start lines, some leave a blank one."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.gap = 0
        self.indent, self.marker = "", ""

    def text(self, s: str, pre: bool) -> None:
        if pre:
            first, *more = s.split("\n")
            self.parts.append(first)
            for line in more:
                self.line(force=True)
                self.parts.append(line)
        else:
            self.parts.append(_SPACE.sub(" ", s))

    def line(self, force: bool = False, pre: bool = False) -> None:
        joined = "".join(self.parts)
        self.parts = []
        body = joined.rstrip() if pre or force else _SPACE.sub(" ", joined).strip(" ")
        if body:
            if self.gap > 1 and self.lines:
                self.lines.append("")
            self.lines.append(self.indent + self.marker + body)
            self.marker, self.gap = " " * len(self.marker), 0
        elif force:
            self.lines.append("")

    def block(self, spaced: bool) -> None:
        self.line()
        self.gap = max(self.gap, 2 if spaced else 1)


def render(root: Node, rules: dict[str, Shown], depth: int = 0, visible: bool = True) -> list[str]:
    """The visible lines below ``root``; nesting of any depth is walked without recursion, but for tables."""
    flow = Flow()
    pre = 0
    lists: list[list] = []
    todo: list = [(False, c, visible) for c in reversed(root.children)]
    while todo:
        leaving, node, visible = todo.pop()
        if isinstance(node, str):
            if visible:
                flow.text(node, pre > 0)
            continue
        tag = node.tag
        if leaving:
            flow.line(pre=pre > 0) if tag == "pre" else flow.block(tag in SPACED and not (lists and tag in ("ul", "ol", "p")))
            if tag == "pre":
                pre -= 1
                flow.block(True)
            elif tag in ("ul", "ol"):
                flow.indent, flow.marker = lists.pop()[2:]
                flow.block(not lists)
            elif tag == "li":
                flow.marker = ""
            continue
        said = shown(node, rules)
        if said.rendered is False:
            continue
        visible = visible if said.visible is None else said.visible
        if tag == "br":
            flow.line() if "".join(flow.parts).strip() else flow.block(False)
            continue
        if tag == "hr":
            flow.block(True)
            continue
        if tag == "img":
            continue
        if tag == "table" and depth < NESTED_TABLES:
            flow.block(True)
            for line in table_lines(node, rules, depth, visible):
                flow.parts.append(line)
                flow.line(pre=True)
            flow.block(True)
            continue
        children = node.children
        if tag == "details" and "open" not in node.attrs:
            children = [c for c in children if not isinstance(c, str) and c.tag == "summary"]
        if tag in BLOCKS:
            flow.block(tag in SPACED and not (lists and tag in ("ul", "ol", "p")))
            if tag in ("ul", "ol"):
                lists.append([tag, _number(node.attrs.get("start"), 1), flow.indent, flow.marker])
                flow.indent, flow.marker = (flow.indent + " " * len(flow.marker))[:INDENT], ""
            elif tag == "li":
                kind = lists[-1] if lists else ["ul", 0]
                flow.marker = f"{kind[1]}. " if kind[0] == "ol" else "- "
                kind[1] += 1
            elif tag == "pre":
                pre += 1
            todo.append((True, node, visible))
        elif tag in ("td", "th"):
            flow.text(" ", False)
        todo.extend((False, c, visible) for c in reversed(children))
    flow.line()
    return flow.lines


def _number(value: str | None, default: int) -> int:
    """The whole number that an attribute begins with, of whatever length."""
    found = _NUMBER.match(value or "")
    return max(-(1 << 31), min((1 << 31) - 1, int(found[1][:12]))) if found else default


def grid(rows: list[list[Node]]) -> list[list[tuple[int, int, Node]]]:
    """(first column, column behind the last, cell) of every row's cells: a cell that spans rows pushes later ones aside.

    ``until`` has for each column the first row in which it is free again.
    """
    out = []
    until, last = np.zeros(0, np.int32), 0
    for i, row in enumerate(rows):
        free = np.flatnonzero(until <= i) if last > i else None
        placed, column = [], 0
        for cell in row:
            if free is not None and column < len(until):
                k = int(np.searchsorted(free, column))
                column = int(free[k]) if k < len(free) else len(until)
            end = column + min(max(1, _number(cell.attrs.get("colspan"), 1)), MOST_COLUMNS)
            down = _number(cell.attrs.get("rowspan"), 1)
            down = 1 if down < 0 else min(down, MOST_ROWS)
            behind = min(i + down, len(rows)) if down else len(rows)
            placed.append((column, end, cell, behind))
            column = end
        for first, end, _, behind in placed:
            if behind > i + 1:
                if end > len(until):
                    until = np.concatenate([until, np.zeros(max(end - len(until), len(until)), np.int32)])
                np.maximum(until[first:end], behind, out=until[first:end])
                last = max(last, behind)
        out.append([p[:3] for p in placed])
    return out


def table_lines(table: Node, rules: dict[str, Shown], depth: int, visible: bool) -> list[str]:
    """Rows of cells padded to common widths; a caption comes first, stray content before the rows.

    Columns in which no cell begins take no room, and a cell that spans several is as wide as they are. Only the first COLUMNS
    columns are aligned.
    """
    rows: list[list[Node]] = []
    stray = Node("#stray", {})
    seen: dict[int, bool] = {}  # cells whose visibility isn't the table's
    todo = [(c, visible) for c in reversed(table.children)]
    while todo:
        node, above = todo.pop()
        if isinstance(node, str):
            if node.strip():
                stray.children.append(node)
            continue
        said = shown(node, rules)
        if said.rendered is False:
            continue
        above = above if said.visible is None else said.visible
        if node.tag == "tr":
            cells = []
            for c in node.children:
                if isinstance(c, str) or c.tag not in ("td", "th"):
                    if not isinstance(c, str) or c.strip():
                        stray.children.append(c)
                elif (own := shown(c, rules)).rendered is not False:
                    cells.append(c)
                    seen[id(c)] = above if own.visible is None else own.visible
            rows.append(cells)
        elif node.tag in ("thead", "tbody", "tfoot"):
            todo.extend((c, above) for c in reversed(node.children))
        elif node.tag in ("td", "th"):
            rows.append([node])
            seen[id(node)] = above
        else:
            stray.children.append(node)
    lines = render(stray, rules, depth + 1, visible) if stray.children else []
    placed = [[(a, b, render(c, rules, depth + 1, seen[id(c)])) for a, b, c in row] for row in grid(rows)]
    starts = sorted({a for row in placed for a, _, _ in row})
    widths = [0] * len(starts)
    column = lambda a: min(bisect_left(starts, a), COLUMNS)
    cells = [[(column(a), column(b), text) for a, b, text in row] for row in placed]
    for row in cells:
        for k, behind, text in row:
            if behind - k == 1:
                widths[k] = max(widths[k], min(CELL_WIDTH, max(map(len, text), default=0)))
    for row in cells:
        for n in range(max((len(text) for _, _, text in row), default=0)):
            parts, at = [], 0
            for k, behind, text in row:
                parts += [" " * w for w in widths[at:k]]
                parts.append((text[n] if n < len(text) else "").ljust(sum(widths[k:behind]) + 3 * (behind - k - 1)))
                at = behind
            lines.append(" | ".join(parts).rstrip())
    return lines


def page_text(html: str | None) -> str:
    """The visible text of a page."""
    builder = TreeBuilder()
    try:
        builder.feed(html or "")
        builder.close()
    except AssertionError:  # a malformed declaration: read it as text
        builder = TreeBuilder()
        builder.feed((html or "").replace("<!", "&lt;!"))
        builder.close()
    return "\n".join(render(builder.root, style_rules(builder.styles)))


def extract_text(pages: DataFrame, *, html: str = "html") -> DataFrame:
    """Every row of ``pages`` with the column text: what a reader of the page sees.

    Blocks start lines, paragraphs and the like are set off by a blank line, list items carry "- " or
    their number under their list's indent, table cells are padded to columns (up to CELL_WIDTH) and keep to them
    under cells that span rows or columns, and ``pre`` keeps its white space. Scripts, styles, hidden elements, closed
    dialogs and folded details aren't shown; text made visible inside an invisible element is.

    Null and empty pages have empty text. Text without tags comes out as it is, white space collapsed. Broken
    markup of any nesting is repaired by implied tags, never refused, in time that grows with the page; a tag or comment that
    the page ends in is dropped with all that follows its start. Lists indent by up to INDENT characters. Repeated rows
    are rendered each. Other columns pass through, whatever their names; those called text, in any case, are
    replaced. An empty table gives no rows.
    """
    at = pages.columns.index(html)
    passed = [k for k, c in enumerate(pages.columns) if c.lower() != "text"]
    shape = T.StructType([T.StructField(f"c{k}", pages.schema[k].dataType) for k in passed] + [T.StructField("text", T.StringType())])
    plain = pages.toDF(*(f"c{k}" for k in range(len(pages.columns))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                text = pa.array([page_text(h) for h in part.column(0).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns[1:], text], names=shape.names)

    rendered = plain.select(plain[f"c{at}"].cast("string").alias("html"), *(f"c{k}" for k in passed)).mapInArrow(run, shape)
    return rendered.toDF(*(pages.columns[k] for k in passed), "text")
