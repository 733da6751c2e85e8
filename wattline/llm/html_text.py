"""HTML extraction by layout-aware rendering.

A builder turns tags into a tree, with the end tags that HTML leaves out; a walk over the
tree emits what a reader would see: blocks on lines of their own, list items with markers,
table cells in aligned columns. Neither the builder nor the walk recurses, so deeply
nested pages are handled like any other.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements of the HTML standard by role.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
UNSEEN = set(
    "head title meta link script style template noscript iframe object audio video canvas datalist"
    # Of drawings and formulas: what describes them.
    " desc metadata defs annotation annotation-xml".split()
)
FOREIGN = {"svg", "math"}
#: Elements of a drawing whose text is drawn.
DRAWN = {"text", "foreignobject"}
PARAGRAPHS = set("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote figure hr".split())
BLOCKS = PARAGRAPHS | set(
    "html body address article aside details dialog dd div dt fieldset figcaption footer form header hgroup legend li"
    " main menu nav option section summary tr caption thead tbody tfoot center".split()
)
CELLS = {"td", "th"}
ROW_GROUPS = {"thead", "tbody", "tfoot"}
# Start tag -> open elements that it ends, and the elements at which the search stops.
IMPLIED_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "tr": ({"tr"}, {"table"}),
    "td": (CELLS, {"tr", "table"}),
    "th": (CELLS, {"tr", "table"}),
    **{g: (ROW_GROUPS | {"caption", "colgroup"}, {"table"}) for g in ROW_GROUPS},
}
ENDS_P = (BLOCKS - {"option", "tr", "caption", "thead", "tbody", "tfoot"}) | {"li", "dt", "dd"}
#: An end tag or an implied end doesn't reach out of these.
SCOPES = {"table", "td", "th", "caption", "button", "object"}
#: Decimal references of more digits than a character's number has, and zeros before it.
FAR_REFERENCE = re.compile(r"&#0*[1-9][0-9]{7,};?")
ZEROS = re.compile(r"(?<=&#)0{8,}")
HIDING = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.I)
SPACE = " \t\n\r\f\v"
INDENT = 2
GUTTER = "  "


class Node:
    __slots__ = ("tag", "attributes", "children", "parent")

    def __init__(self, tag: str, attributes: dict[str, str | None], parent: Node | None):
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.children: list[Node | str] = []


class Builder(HTMLParser):
    """Keeps the open elements as a path, and for each tag how deep it is open: no question walks the path."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("", {}, None)
        self.path = [self.root]
        self.depths: dict[str, list[int]] = {}

    def depth(self, tags: set[str]) -> int:
        """Place of the innermost open element among ``tags``, 0 if there is none."""
        return max((self.depths[t][-1] for t in tags if self.depths.get(t)), default=0)

    def close_to(self, tags: set[str], stops: set[str]) -> bool:
        """Ends the innermost open element among ``tags``, unless one of ``stops`` is in between."""
        at = self.depth(tags)
        if not at or self.depth(stops) > at:
            return False
        while len(self.path) > at:
            self.depths[self.path.pop().tag].pop()
        return True

    def open(self, tag: str, attributes: dict[str, str | None]) -> None:
        node = Node(tag, attributes, self.path[-1])
        self.path[-1].children.append(node)
        if tag not in VOID:
            self.depths.setdefault(tag, []).append(len(self.path))
            self.path.append(node)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ENDS_P:
            self.close_to({"p"}, SCOPES)
        if tag in IMPLIED_ENDS:
            self.close_to(*IMPLIED_ENDS[tag])
        # Parts of a table bring the parts around them along.
        if tag in CELLS and not self.inside({"tr"}, {"table"}):
            self.open("tr", {})
        if tag == "body" or (tag in BLOCKS and self.inside({"head"}, {"body"})):
            self.close_to({"head"}, set())
        self.open(tag, dict(attrs))

    def inside(self, tags: set[str], stops: set[str]) -> bool:
        return self.depth(tags) > self.depth(stops)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # The slash means nothing in HTML, except that foreign elements such as <path/> end there.
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.inside(FOREIGN, set()):
            self.close_to({tag}, set())

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.open("br", {})
        elif tag == "p" and not self.inside({"p"}, SCOPES):
            self.open("p", {})
            self.close_to({"p"}, set())
        elif tag not in VOID:
            self.close_to({tag}, set() if tag in SCOPES | {"html", "body"} else SCOPES - {tag})

    def handle_data(self, data: str) -> None:
        self.path[-1].children.append(data)

    def unknown_decl(self, data: str) -> None:
        pass


def parse(html: str) -> Node:
    # A reference to no character is the replacement character, however long its number is.
    html = FAR_REFERENCE.sub("\ufffd", ZEROS.sub("0", html))
    builder = Builder()
    try:
        builder.feed(html)
        builder.close()
    except AssertionError:  # a marked section that the parser has no rule for: its mark is text
        builder = Builder()
        builder.feed(html.replace("<![", "&lt;!["))
        builder.close()
    return builder.root


def visible(node: Node) -> bool:
    return not (
        node.tag in UNSEEN
        or "hidden" in node.attributes
        or HIDING.search(node.attributes.get("style") or "")
        or (node.tag == "dialog" and "open" not in node.attributes)
    )


class Page:
    """Lines of one flow of text: the page, or one table cell."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = False
        self.gap = 0
        self.indent = 0
        self.marker = ""

    def write(self, text: str, keep: bool) -> None:
        if keep:
            for i, part in enumerate(text.replace("\r\n", "\n").split("\n")):
                if i:
                    self.end_line(True)
                if part:
                    self.begin()
                    self.line.append(part)
            return
        words = text.split()
        if not words:
            self.space = self.space or bool(text)
            return
        self.begin()
        if self.line and (self.space or text[0] in SPACE or text[0].isspace()):
            self.line.append(" ")
        self.line.append(" ".join(words))
        self.space = text[-1].isspace()

    def begin(self) -> None:
        """Before text: the blank line that is due, the list marker, the indentation."""
        if self.line:
            return
        if self.gap > 1 and self.lines and self.lines[-1]:
            self.lines.append("")
        self.gap = 0
        self.line.append(" " * (self.indent - len(self.marker)) + self.marker)
        self.marker = ""
        self.space = False
        if not self.line[0]:
            self.line = [""]

    def end_line(self, always: bool = False) -> None:
        if self.line:
            self.lines.append("".join(self.line).rstrip())
        elif always:
            self.lines.append("")
        self.line, self.space = [], False

    def block(self, gap: int) -> None:
        self.end_line()
        self.gap = max(self.gap, gap)

    def text(self) -> str:
        self.end_line()
        return "\n".join(self.lines).strip("\n")


class Table:
    """Rows of cells (lines, columns, rows): a cell of several rows keeps its columns taken in those below."""

    def __init__(self) -> None:
        self.rows: list[list[tuple[list[str], int, int]]] = []

    def placed(self) -> list[list[tuple[list[str], int, int]]]:
        """Each row's cells as (lines, first column, columns)."""
        out, taken = [], {}
        for row in self.rows:
            at, cells = 0, []
            for cell, columns, rows in row:
                while taken.get(at, 0):
                    at += 1
                cells.append((cell, at, columns))
                for k in range(at, at + columns) if rows > 1 else ():
                    # The row itself counts, and is counted off with the others below.
                    taken[k] = max(taken.get(k, 0), rows)
                at += columns
            out.append(cells)
            taken = {k: n - 1 for k, n in taken.items() if n > 1}
        return out

    def lines(self) -> list[str]:
        """Cells of a column start at the same place; a cell of several lines fills several."""
        rows = self.placed()
        widths: dict[int, int] = {}
        for cell, at, columns in (c for row in rows for c in row):
            if columns == 1:
                widths[at] = max(widths.get(at, 0), *map(len, cell), 0)
        out = []
        for row in rows:
            last = max((at + columns for _, at, columns in row), default=0)
            starts = [0]
            for k in range(last):
                starts.append(starts[-1] + widths.get(k, 0) + len(GUTTER))
            for i in range(max((len(c) for c, _, _ in row), default=0)):
                line = ""
                for cell, at, _ in row:
                    if i < len(cell) and cell[i]:
                        # A wide cell that reaches beyond its columns pushes the next one on.
                        gap = GUTTER if line else ""
                        line = max(line + gap, line.ljust(starts[at]), key=len) + cell[i]
                out.append(line.rstrip())
        return [line for line in out if line.strip()]


def span_of(node: Node, name: str = "colspan") -> int:
    """How many columns or rows a cell takes, 1000 at most."""
    value = (node.attributes.get(name) or "1").strip(SPACE).lstrip("0")
    return min(int(value[:5]), 1000) if value.isascii() and value.isdigit() else 1


def shown(node: Node) -> list[Node | str]:
    """Children that are shown: of a closed ``details`` its summary, of a drawing its texts."""
    if node.tag == "details" and "open" not in node.attributes:
        return [c for c in node.children if isinstance(c, Node) and c.tag == "summary"][:1]
    if node.tag != "svg":
        return node.children
    found, steps = [], [*reversed(node.children)]
    while steps:
        child = steps.pop()
        if not isinstance(child, Node) or not visible(child):
            continue
        if child.tag in DRAWN:
            # Texts of a drawing stand apart.
            found += [" ", child, " "]
        else:
            steps.extend(reversed(child.children))
    return found


def render(html: str) -> str:
    """The visible text of a page."""
    pages, tables, counters = [Page()], [], []
    steps: list[tuple[Node | str, bool]] = [(parse(html), False)]
    pre = 0
    while steps:
        node, leaving = steps.pop()
        page = pages[-1]
        if isinstance(node, str):
            # Between the cells of a table there is nothing to see.
            page.write(node, pre > 0)
            continue
        tag = node.tag
        gap = 2 if tag in PARAGRAPHS else 1
        if not leaving:
            if not visible(node):
                continue
            if tag == "br":
                page.begin()
                page.end_line()
                continue
            if tag == "img":
                continue
            if tag in BLOCKS:
                nested = tag in ("ul", "ol") and counters
                page.block(1 if nested else gap)
            if tag in ("ul", "ol", "menu"):
                start = node.attributes.get("start") or "1"
                first = int(start) if re.fullmatch(r"-?[0-9]{1,9}", start) else 1
                counters.append(first if tag == "ol" else None)
                page.indent += INDENT if tag != "ol" else INDENT + 1
            elif tag == "li":
                number = counters[-1] if counters else None
                page.marker = "- " if number is None else f"{number}. "
                if number is not None:
                    counters[-1] += 1
            elif tag in ("blockquote", "dd"):
                page.indent += INDENT
            elif tag == "pre":
                pre += 1
            elif tag == "table":
                tables.append(Table())
            elif tag == "tr" and tables:
                tables[-1].rows.append([])
            elif tag in CELLS and tables:
                pages.append(Page())
            steps.append((node, True))
            steps.extend((child, False) for child in reversed(shown(node)))
            continue
        if tag in ("ul", "ol", "menu"):
            counters.pop()
            page.indent -= INDENT if tag != "ol" else INDENT + 1
        elif tag in ("blockquote", "dd"):
            page.indent -= INDENT
        elif tag == "li":
            page.end_line()
            page.marker = ""
        elif tag == "pre":
            pre -= 1
        elif tag in CELLS and tables:
            cell = pages.pop().text().split("\n")
            tables[-1].rows[-1].append((cell, span_of(node), span_of(node, "rowspan")))
            page = pages[-1]
        elif tag == "table":
            for line in tables.pop().lines():
                page.write(line, True)
                page.end_line()
        if tag in BLOCKS:
            page.block(1 if tag in ("ul", "ol") and counters else gap)
    return pages[0].text()


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """page_id and text, the visible text of every row's page.

    A null page has a null text, an empty one an empty text. Broken markup is read as far
    as it makes sense; nothing is cut off. Of drawings the texts are shown, of formulas all
    but their annotations, of a closed ``details`` its summary. Time grows with the page, however
    deep its elements nest. Repeated rows and null ids are ordinary rows;
    extra columns are left out; an empty table gives an empty result.
    """

    @F.pandas_udf("string")
    def rendered(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for html in batches:
            yield pd.Series([None if h is None else render(h) for h in html], dtype=object)

    return pages.select(F.col(f"`{id_col}`").alias("page_id"), rendered(F.col(f"`{html_col}`")).alias("text"))
