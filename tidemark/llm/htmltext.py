"""Visible text of HTML pages with block spacing, lists and aligned tables.

The standard library's tokenizer feeds a tree builder that supplies implied start and end tags; a renderer walks the
tree without recursion, leaves out what a browser would not show, and lays out blocks. Each page is worked
off by itself inside its partition: nothing is shuffled, and page size bounds the memory.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser
from itertools import zip_longest

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mapped

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset(
    "script style noscript template head title desc metadata defs symbol iframe canvas audio video datalist noframes".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu pre blockquote table hr figure form fieldset".split())
BLOCKS = SPACED | frozenset(
    "html body div section article aside header footer nav main address center details summary dialog li dt dd "
    "tr td th thead tbody tfoot caption figcaption legend option textarea".split()
)
LISTS = frozenset("ul ol menu".split())
TABLE_PARTS = frozenset("table thead tbody tfoot tr td th caption".split())
# Opening one of these ends the open elements of the second set, unless one of the third lies between.
_CELL, _ROW, _BODY = {"td", "th"}, {"tr", "td", "th"}, {"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}
IMPLIED_ENDS: dict[str, tuple[set[str], set[str]]] = {
    "li": ({"li"}, {"ul", "ol", "menu", "table", "td", "th"}),
    "dt": ({"dt", "dd"}, {"dl", "table", "td", "th"}),
    "dd": ({"dt", "dd"}, {"dl", "table", "td", "th"}),
    "option": ({"option"}, {"select"}),
    "td": (_CELL, {"table", "tr"}),
    "th": (_CELL, {"table", "tr"}),
    "tr": (_ROW, {"table", "thead", "tbody", "tfoot"}),
    **{tag: (_BODY, {"table"}) for tag in ("thead", "tbody", "tfoot")},
}
ENDS_PARAGRAPH = (SPACED | frozenset("div section article aside header footer nav main address center details li dt dd".split()))
PARAGRAPH_WALLS = frozenset("table td th caption button object".split())
DEPTH_LIMIT = 512
PAD_LIMIT = 60  # columns wider than this are not padded

_STYLE = re.compile(r"(?:^|;)\s*(display|visibility|white-space)\s*:\s*([a-z-]+)", re.I)
_SPACE = re.compile(r"[ \t\r\n\f]+")


@dataclass(slots=True)
class Node:
    tag: str
    attrs: dict[str, str | None] = field(default_factory=dict)
    children: list = field(default_factory=list)


def shown_options(select: Node) -> list[Node]:
    """The options that a closed list shows: the last selected one, else the first; all of a list box."""
    options, left = [], list(reversed(select.children))
    while left:
        node = left.pop()
        if isinstance(node, Node) and node.tag == "optgroup":
            left += reversed(node.children)
        elif isinstance(node, Node) and node.tag == "option":
            options.append(node)
    if "multiple" in select.attrs or _number(select, "size", 1) > 1:
        return options
    chosen = [o for o in options if "selected" in o.attrs]
    return chosen[-1:] or options[:1]


class TreeBuilder(HTMLParser):
    """Builds ``root`` from tokens; unknown end tags are ignored, open elements end with the page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("html")
        self.open = [self.root]

    def parse_html_declaration(self, i: int) -> int:
        if self.rawdata.startswith("<![", i):
            return self.parse_bogus_comment(i)
        return super().parse_html_declaration(i)

    def _end_implied(self, ends: set[str] | frozenset[str], walls: set[str] | frozenset[str]) -> None:
        last = None
        for place in range(len(self.open) - 1, 0, -1):
            tag = self.open[place].tag
            if tag in ends:
                last = place
            elif tag in walls:
                break
        if last is not None:
            del self.open[last:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("html", "body"):
            return
        if tag in ENDS_PARAGRAPH:
            self._end_implied({"p"}, PARAGRAPH_WALLS)
        if tag in IMPLIED_ENDS:
            self._end_implied(*IMPLIED_ENDS[tag])
        if self.open[-1].tag == "head" and tag not in ("title", "style", "script", "meta", "link", "base", "noscript", "template"):
            self.open.pop()
        if tag in ("td", "th") and self.open[-1].tag in ("table", "thead", "tbody", "tfoot"):
            self._push(Node("tr"))
        node = Node(tag, dict(attrs))
        if tag in VOID:
            self.open[-1].children.append(node)
        else:
            self._push(node)

    def _push(self, node: Node) -> None:
        if len(self.open) >= DEPTH_LIMIT:  # deeper elements become siblings, as in browsers
            self.open.pop()
        self.open[-1].children.append(node)
        self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # the slash means nothing in HTML

    def handle_endtag(self, tag: str) -> None:
        if tag in ("br", "p") and not any(n.tag == tag for n in self.open):
            self.open[-1].children.append(Node(tag))
            return
        for place in range(len(self.open) - 1, 0, -1):
            here = self.open[place].tag
            if here == tag:
                del self.open[place:]
                return
            if here in TABLE_PARTS and tag not in TABLE_PARTS or here in BLOCKS and tag not in BLOCKS:
                return

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)


class Flow:
    """Lines of one block context: the page, a list item, a quotation or a table cell."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = 0  # blank lines wanted before the next content

    def text(self, data: str, keep: bool) -> None:
        if keep:
            first, *rest = data.replace("\r\n", "\n").replace("\r", "\n").split("\n")
            self._add(first)
            for part in rest:
                self.end_line(True)
                self._add(part)
            return
        data = _SPACE.sub(" ", data)
        if data.startswith(" ") and (not self.line or self.line[-1].endswith(" ")):
            data = data[1:]
        self._add(data)

    def _add(self, data: str) -> None:
        if data:
            self.line.append(data)

    def end_line(self, forced: bool = False) -> None:
        line = "".join(self.line).rstrip(" ")
        self.line = []
        if line or forced:
            self.add_lines([line])

    def add_lines(self, lines: list[str]) -> None:
        if self.lines and self.gap:
            self.lines.append("")
        self.gap = 0
        self.lines += lines

    def block(self, gap: int) -> None:
        self.end_line()
        self.gap = max(self.gap, gap)

    def finish(self) -> list[str]:
        self.end_line()
        lines = self.lines
        while lines and not lines[0]:
            lines = lines[1:]
        while lines and not lines[-1]:
            lines.pop()
        return lines


def _number(node: Node, name: str, otherwise: int) -> int:
    try:
        return int(node.attrs.get(name) or otherwise)
    except ValueError:
        return otherwise


def table_lines(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    """Aligned lines of rows of cells (lines, colspan, rowspan); cells that are spanned stay blank."""
    most = max((len(r) for r in rows), default=0)
    grid: list[list[list[str]]] = []
    down: dict[int, int] = {}
    for row in rows:
        out: list[list[str]] = []

        def pass_spanned() -> None:
            while down.get(len(out), 0) > 0:
                down[len(out)] -= 1
                out.append([])

        for lines, across, below in row:
            pass_spanned()
            for i in range(max(1, min(across, most))):
                if below > 1:
                    down[len(out)] = below - 1
                out.append(lines if i == 0 else [])
        pass_spanned()
        grid.append(out)
    widths: dict[int, int] = {}
    for out in grid:
        for i, lines in enumerate(out):
            widths[i] = max([widths.get(i, 0), *map(len, lines)])
    result = []
    for out in grid:
        if not any(out):
            continue
        for parts in zip_longest(*(lines or [""] for lines in out), fillvalue=""):
            last = max((i for i, p in enumerate(parts) if p), default=0)
            padded = [p.ljust(min(widths[i], PAD_LIMIT)) for i, p in enumerate(parts[:last])]
            result.append(" | ".join([*padded, parts[last]]).rstrip(" "))
    return result


class Renderer:
    """Walks a tree with explicit enter and leave steps."""

    def __init__(self) -> None:
        self.flows = [Flow()]
        self.lists: list[int | None] = []  # next number of each open list, None for bullets
        self.tables: list[list[list[tuple[list[str], int, int]]]] = []

    def render(self, root: Node) -> str:
        steps: list[tuple[Node | str, bool, bool, bool]] = [(root, False, False, False)]
        while steps:
            node, leaving, veiled, keep = steps.pop()
            flow = self.flows[-1]
            if isinstance(node, str):
                if not veiled:
                    flow.text(node, keep)
            elif leaving:
                self.leave(node)
            elif self.shown(node):
                style = self.style(node)
                veiled = {"hidden": True, "collapse": True, "visible": False}.get(style.get("visibility", ""), veiled)
                space = style.get("white-space", "")
                keep = node.tag in ("pre", "textarea") or space.startswith("pre") or keep and not space
                self.enter(node)
                steps.append((node, True, veiled, keep))
                children = node.children
                if node.tag == "details" and "open" not in node.attrs:
                    children = [c for c in children if isinstance(c, Node) and c.tag == "summary"]
                if node.tag == "select":
                    children = shown_options(node)
                if node.tag == "pre" and children and isinstance(children[0], str):
                    children = [re.sub(r"^\r?\n", "", children[0]), *children[1:]]
                steps += [(c, False, veiled, keep) for c in reversed(children)]
        text = "\n".join(self.flows[0].finish())
        return text.replace("\xa0", " ")

    @staticmethod
    def style(node: Node) -> dict[str, str]:
        value = node.attrs.get("style")
        return {k.lower(): v.lower() for k, v in _STYLE.findall(value)} if value else {}

    def shown(self, node: Node) -> bool:
        if node.tag in HIDDEN or "hidden" in node.attrs or node.tag == "dialog" and "open" not in node.attrs:
            return False
        return self.style(node).get("display") != "none"

    def enter(self, node: Node) -> None:
        tag, flow = node.tag, self.flows[-1]
        if tag == "br":
            flow.end_line(True)
        elif tag in BLOCKS:
            flow.block(int(tag in SPACED and not (tag in LISTS and self.lists)))
        if tag in LISTS:
            self.lists.append(_number(node, "start", 1) if tag == "ol" else None)
        elif tag == "hr":
            flow.add_lines(["---"])
        elif tag == "table":
            self.tables.append([])
            self.flows.append(Flow())  # captions and stray content
        elif tag == "tr" and self.tables:
            self.tables[-1].append([])
        elif tag in ("li", "dd", "blockquote") or tag in ("td", "th") and self.tables:
            self.flows.append(Flow())
            if tag in ("td", "th"):
                self.lists.append(None)  # an item without a list in a cell gets a bullet

    def leave(self, node: Node) -> None:
        tag = node.tag
        if tag in ("td", "th") and self.tables:
            self.lists.pop()
            lines = self.flows.pop().finish()
            if not self.tables[-1]:
                self.tables[-1].append([])
            self.tables[-1][-1].append((lines, _number(node, "colspan", 1), _number(node, "rowspan", 1)))
        elif tag == "table":
            before = self.flows.pop().finish()
            self.flows[-1].add_lines(before + table_lines(self.tables.pop()))
        elif tag in ("li", "dd", "blockquote"):
            lines = self.flows.pop().finish()
            first = after = "> " if tag == "blockquote" else "    "
            if tag == "li":
                first = "- "
                if self.lists and self.lists[-1] is not None:
                    number = _number(node, "value", self.lists[-1])
                    first, self.lists[-1] = f"{number}. ", number + 1
                after = " " * len(first)
            if lines:
                self.flows[-1].add_lines([first + lines[0], *((after + x).rstrip(" ") for x in lines[1:])])
        if tag in LISTS:
            self.lists.pop()
        if tag in BLOCKS:
            self.flows[-1].block(int(tag in SPACED and not (tag in LISTS and self.lists)))


def visible_text(html: str) -> str:
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    return Renderer().render(builder.root)


def extract(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, text.

    Null html gives null text, empty or wholly hidden pages give empty text. Repeated rows are each extracted.
    """
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))

    def run(batch: pa.RecordBatch):
        texts = [None if h is None else visible_text(h) for h in batch.column(2).to_pylist()]
        yield [batch.column(0), batch.column(1), texts]

    return mapped(rows, run, "page_id long, url string, text string")
