"""Layout-aware text of web pages: a tree with implied tags, visibility, blocks, lists, tables."""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Generator, Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import batches_of

CHUNK_BYTES = 4 << 20
#: Elements without content, with hidden content, and those set apart by line breaks.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = frozenset(
    "head title style script noscript template iframe object canvas audio video datalist".split()
)
#: What may stand in a head; any other tag and any text close it.
IN_HEAD = frozenset("base basefont bgsound link meta title noscript noframes style script template".split())
#: In svg and math: elements that are not drawn, and those with HTML inside.
UNDRAWN = {
    "svg": frozenset(
        "title desc metadata defs symbol clippath mask marker pattern lineargradient radialgradient filter style"
        " script".split()
    ),
    "math": frozenset("annotation annotation-xml mphantom".split()),
}
HOLDS_HTML = {"svg": frozenset("foreignobject desc title".split()), "math": frozenset("mi mo mn ms mtext".split())}
#: The elements of svg whose own text is drawn, those of math whose parts stand apart.
SVG_TEXT = frozenset("text tspan textpath a".split())
MATH_PARTS = frozenset("mfrac mroot msup msub msubsup munder mover munderover mmultiscripts mtable mtr".split())
#: Tags that end svg and math.
LEAVES = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta"
    " nobr ol p pre ruby s small span strike strong sub sup table tt u ul var".split()
)
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol p pre section summary table ul".split()
)
#: Blocks with an empty line around them.
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 menu ol p pre table ul".split())
#: Lines of their own as well, but they leave a paragraph open.
OPTIONS = frozenset(("option", "optgroup"))
#: An opening tag closes these open elements, but not beyond the ones after the bar.
CLOSES = {
    "li": (("li",), ("ol", "ul", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th", "caption"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "thead": (("thead", "tbody", "tfoot", "tr", "td", "th", "caption"), ("table",)),
    "tbody": (("thead", "tbody", "tfoot", "tr", "td", "th", "caption"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot", "tr", "td", "th", "caption"), ("table",)),
    "option": (("option",), ("select",)),
    "optgroup": (("option", "optgroup"), ("select",)),
}
#: The parts of a table go into the innermost of these, and close what is open inside it.
SECTIONS = ("thead", "tbody", "tfoot")
INTO = {
    **dict.fromkeys(("td", "th"), ("tr", *SECTIONS, "table")),
    "tr": (*SECTIONS, "table"),
    "col": ("colgroup", "table"),
    **dict.fromkeys((*SECTIONS, "caption", "colgroup"), ("table",)),
}
_SPACES = re.compile(r"[ \t\n\r\f]+")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*(hidden|collapse)", re.I)


@dataclass
class Node:
    tag: str
    hidden: bool = False
    foreign: bool = False  # of svg or math
    inner: str = ""  # svg or math if its children are
    start: int = 1
    span: int = 1
    down: int = 1
    children: list = field(default_factory=list)  # Nodes and strings


class TreeBuilder(HTMLParser):
    """Builds the tree; what an author left out is implied, what is left open closed at the end."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root")
        self.open = [self.root]
        self.places: dict[str, list[int]] = defaultdict(list)  # where elements are open, by name
        self.headed = False  # a head is of no effect from here on

    def _last(self, *tags: str) -> int:
        """Where the innermost open element of these names is, 0 if none is open."""
        return max((self.places[x][-1] for x in tags if self.places[x]), default=0)

    def _close(self, tags: tuple[str, ...], beyond: tuple[str, ...]) -> None:
        if not self._last(*tags):
            return
        barrier, outer = self._last(*beyond, "template"), len(self.open)
        for open_at in map(self.places.__getitem__, tags):
            if (i := bisect_right(open_at, barrier)) < len(open_at):
                outer = min(outer, open_at[i])
        self._cut(outer)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        held = dict(reversed(attrs))  # the first of equal attributes counts
        unseen = "hidden" in held or bool(_UNSEEN.search(held.get("style") or ""))
        unseen |= (held.get("aria-hidden") or "").lower() == "true"
        if self.open[-1].inner and (tag in LEAVES or tag == "font" and held.keys() & {"color", "face", "size"}):
            while self.open[-1].inner:
                self._cut(-1)
        if self.open[-1].inner or tag in UNDRAWN:
            self._imply(tag)
            self._push_foreign(tag, unseen, held)
            return
        if tag == "head" and self.headed:
            return
        self._imply(tag)
        if tag in BLOCK or tag == "hr":
            self._close(("p",), ("table", "td", "th", "caption", "button", "object"))
        at = self._place(INTO[tag]) if tag in INTO else 0
        if at:
            self._cut(at + 1)
        elif tag in CLOSES:
            self._close(*CLOSES[tag])
        if at and tag in ("td", "th") and self.open[-1].tag != "tr":
            self._push(Node("tr"))
        node = Node(tag, unseen or tag in HIDDEN)
        node.start, node.span = _number(held.get("start"), 1), max(1, min(_number(held.get("colspan"), 1), 100))
        down = _number(held.get("rowspan"), 1)
        node.down = 1 if down < 0 else down or 1 << 16  # 0: to the end of the section
        self._push(node)
        if tag in VOID or tag == "form" and self.open[-2].tag in ("table", "tr", *SECTIONS):
            self._cut(-1)

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)  # the slash means nothing in HTML, but closes in svg and math
        if self.open[-1].foreign and self.open[-1].tag == tag:
            self._cut(-1)

    def _imply(self, tag: str) -> None:
        """Ends a head or group of columns before a tag that may not stand in one, and before text."""
        if tag not in IN_HEAD and tag != "html":
            self.headed = True
            if self.open[-1].tag == "head":
                self._cut(-1)
        if self.open[-1].tag == "colgroup" and tag not in ("col", "template"):
            self._cut(-1)

    def _push_foreign(self, tag: str, unseen: bool, held: dict[str, str | None]) -> None:
        kind = self.open[-1].inner or tag
        node = Node(tag, unseen or tag in UNDRAWN[kind], foreign=True)
        html = tag in HOLDS_HTML[kind] or tag == "annotation-xml" and "html" in (held.get("encoding") or "").lower()
        node.inner = "" if html else kind
        self._push(node)

    def _push(self, node: Node) -> None:
        self.open[-1].children.append(node)
        self.places[node.tag].append(len(self.open))
        self.open.append(node)

    def _cut(self, at: int) -> None:
        """Closes the elements from there on."""
        for node in reversed(self.open[at:]):
            self.places[node.tag].pop()
        del self.open[at:]

    def _place(self, parents: tuple[str, ...]) -> int:
        """Where the innermost of these is open in a table, 0 outside tables."""
        table = self._last("table")
        return self._last(*parents) if table > self._last("template") else 0

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.handle_starttag("br", [])
        else:
            parts = ("table", "caption", "thead", "tbody", "tfoot", "tr", "td", "th")
            beyond = ("table",) if tag in parts[1:] else () if tag in ("table", "template") else ("table", "td", "th")
            self._end(tag, beyond)

    def _end(self, tag: str, beyond: tuple[str, ...]) -> None:
        """Closes the innermost open element of that name, and what is open inside it."""
        at = self._last(tag)
        if at and at >= self._last(*beyond, "template"):
            self._cut(at)

    def handle_data(self, data: str) -> None:
        if data.strip(" \t\n\r\f"):
            self._imply("#text")
        if self.open[-1].inner != "svg" or self.open[-1].tag in SVG_TEXT:
            self.open[-1].children.append(data)


def _number(value: str | None, otherwise: int) -> int:
    found = re.match(r"\s*(-?\d{1,6})", value or "")
    return int(found[1]) if found else otherwise


class Lines:
    """Lines in the making: white space collapsed, breaks and empty lines never doubled."""

    def __init__(self):
        self.done: list[str] = []
        self.now: list[str] = []  # parts of the line
        self.size, self.inked = 0, False  # its length, whether it is more than spaces
        self.gap, self.blank, self.prefix = False, False, ""

    def text(self, data: str, keep: bool = False) -> None:
        if keep:
            for i, line in enumerate(data.replace("\r\n", "\n").split("\n")):
                if i:
                    self.feed()
                self.word(line)
            return
        for i, word in enumerate(_SPACES.split(data)):
            if i and self.size:
                self.gap = True
            if word:
                self.word(word)

    def word(self, word: str) -> None:
        if not self.size:
            if self.blank and self.done:
                self.done.append("")
            self.blank, self.now, self.size = False, [], 0
            self._add(self.prefix)
            self.prefix = " " * len(self.prefix)
        if self.gap and self.inked:
            self._add(" ")
        self._add(word)
        self.gap = False

    def _add(self, part: str) -> None:
        self.now.append(part)
        self.size += len(part)
        self.inked = self.inked or bool(part.strip())

    def feed(self) -> None:
        """A line break that is always there."""
        self.done.append("".join(self.now).rstrip())
        self.now, self.size, self.inked, self.gap = [], 0, False, False

    def end(self, spaced: bool = False) -> None:
        """The end of a block: breaks the line if it has begun."""
        if self.size:
            self.feed()
        self.blank |= spaced
        self.gap = False

    def lines(self) -> list[str]:
        self.end()
        return self.done


def width(text: str) -> int:
    """Columns that a text takes on a terminal."""
    if text.isascii():
        return len(text)
    return sum(
        0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text
    )


def _parts(table: Node) -> Iterator[tuple[Node | str, Node]]:
    """What stands in a table, its sections and groups of columns, each with its parent."""
    for child in table.children:
        if isinstance(child, Node) and child.tag in (*SECTIONS, "colgroup"):
            if not child.hidden:
                yield from ((part, child) for part in child.children)
        else:
            yield child, table


#: Lists indent and tables align their cells down to so many levels. Below them, list items and rows
#: take a line each and cells stand two spaces apart, so that the text stays about as long as the page.
LEVELS = 50
#: A step of rendering: it yields the steps that it waits for, and gets their results.
Step = Generator["Step", Any, Any]


def _run(step: Step) -> Any:
    """The result of a step. Steps within steps lie on a list, so pages may be of any depth."""
    waiting, result = [step], None
    while waiting:
        try:
            waiting.append(waiting[-1].send(result))
            result = None
        except StopIteration as end:
            waiting.pop()
            result = end.value
    return result


def _table(node: Node, tables: int) -> Step:
    """Cells padded to the width of their column, two spaces apart; a caption stands above.

    A cell over several rows has its text in the first of them and is blank in the others.
    """
    captions, rows, grid = [], [], []
    for child, parent in _parts(node):
        if isinstance(child, str) and not child.strip() or isinstance(child, Node) and child.hidden:
            continue
        if isinstance(child, Node) and child.tag == "tr":
            rows.append((child, parent))
        elif isinstance(child, Node) and child.tag == "caption":
            captions += yield _inner(child, tables)
        else:  # what does not belong into a table stands before it
            stray = Lines()
            yield _render(child, stray, tables)
            captions += stray.lines()
    section, taken = None, {}  # of columns: the rows that a cell from above still takes
    for row, parent in rows:
        if parent is not section:
            section, taken = parent, {}
        cells, started = [], {}
        for cell in row.children:
            if isinstance(cell, str) and not cell.strip():
                continue
            if isinstance(cell, Node) and cell.hidden:
                continue
            while taken.get(len(cells)):
                cells.append([])
            if isinstance(cell, Node):
                lines = yield _inner(cell, tables)
            else:
                lines = [" ".join(cell.split())]
            span, down = (cell.span, cell.down) if isinstance(cell, Node) else (1, 1)
            started |= dict.fromkeys(range(len(cells), len(cells) + span), down - 1)
            cells += [lines] + [[]] * (span - 1)
        taken = {at: n - 1 for at, n in taken.items() if n > 1} | {at: n for at, n in started.items() if n}
        if any(cells):
            grid.append(cells)
    wide = [0] * max(map(len, grid), default=0)
    for r in grid:
        for i, cell in enumerate(r):
            wide[i] = max(wide[i], *map(width, cell), 0)
    out = list(captions)
    for r in grid:
        for i in range(max(map(len, r))):
            parts = [cell[i] if i < len(cell) else "" for cell in r]
            padded = [p + " " * (w - width(p)) for p, w in zip(parts, wide, strict=False)]
            out.append("  ".join(padded).rstrip())
    return out


def _inner(node: Node, tables: int) -> Step:
    lines = Lines()
    for child in node.children if node.tag in ("td", "th", "caption") else [node]:
        if isinstance(child, str):
            lines.text(child)
        else:
            yield _render(child, lines, tables)
    return [x for x in lines.lines() if x]


def _render(
    node: Node | str, lines: Lines, tables: int = 0, pre: bool = False, bullets: tuple[int, list] | None = None
) -> Step:
    """Writes a node to ``lines``. ``tables``: those around it; ``bullets``: lists around it, the next mark."""
    if isinstance(node, str):
        lines.text(node, pre)
        return
    if node.hidden:
        return
    tag = node.tag
    if tag == "br":
        lines.feed()
        return
    if tag == "hr":
        lines.end(True)
        return
    apart = node.foreign and tag == "text"
    if apart:
        lines.text(" ")
    nested = bullets is not None
    spaced = tag in SPACED and not (nested and tag in ("ul", "ol", "menu"))
    deep = tables >= LEVELS
    own_lines = tag in BLOCK or tag in OPTIONS or deep and tag in ("tr", "caption")
    if own_lines:
        lines.end(spaced)
    if tag == "table" and not deep:
        for line in (yield _table(node, tables + 1)):
            lines.word(line)
            lines.feed()
    else:
        counter = [node.start] if tag == "ol" else ["-"] if tag in ("ul", "menu") else None
        level = bullets[0] if bullets else 0
        inner = bullets if counter is None else (level + 1, counter)
        outer = lines.prefix
        if tag == "li":
            own = bullets[1] if bullets else ["-"]
            mark = f"{own[0]}. " if isinstance(own[0], int) else "- "
            lines.prefix = "  " * (min(max(1, level), LEVELS) - 1) + mark
            if isinstance(own[0], int):
                own[0] += 1
        pre_inside = pre or tag in ("pre", "textarea")
        for child in node.children:
            if isinstance(child, str):
                lines.text(child, pre_inside)
                continue
            if child.tag in ("td", "th"):  # a cell outside any table, or too deep
                lines.text("  ", deep and lines.size > 0)
            elif tag in MATH_PARTS:
                lines.text(" ")
            yield _render(child, lines, tables, pre_inside, inner)
        if tag == "li":
            lines.end()
            lines.prefix = outer
    if own_lines:
        lines.end(spaced)
    if apart:
        lines.text(" ")


def page_text(html: str | None) -> str:
    """All visible text of a page in its layout; lines end without spaces, the text without lines.

    Visible are all text nodes but those under ``HIDDEN`` (a head, scripts, what stands in for objects and
    media that do not load), under elements hidden by ``hidden``, ``aria-hidden`` or their own style, and what svg
    and math do not draw (``UNDRAWN``, text of svg outside its text elements). All options of a select
    count. Nothing is left out by depth, but see ``LEVELS``. Attributes (alternative texts, labels, values) are not text, and style sheets are not applied.
    """
    builder = TreeBuilder()
    builder.feed(html or "")
    builder.close()
    lines = Lines()
    _run(_render(builder.root, lines))
    return "\n".join(lines.lines()).strip("\n")


def extract_text(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """Columns of ``pages`` without the html, plus its visible text and the number of its lines.

    NULL, empty and broken html give the text that can be read, at least an empty one.
    Rows are rendered one by one, so repeated rows and NULL ids pass through. Columns named as the results
    (``out_col``, ``n_lines``) are replaced. An empty table gives an empty table.
    """
    names = [c for c in pages.columns if c not in (html_col, out_col, "n_lines")]
    plain = pages.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{html_col}`").alias("__html"))
    own = plain.drop("__html").schema.fields
    schema = T.StructType([*own, *T.StructType.fromDDL(f"`{out_col}` string, n_lines long").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, "__html", CHUNK_BYTES):
            texts = [page_text(x) for x in batch.column("__html").to_pylist()]
            n_lines = [len(x.split("\n")) if x else 0 for x in texts]
            columns = [batch.column(c) for c in names]
            columns += [pa.array(texts, pa.string()), pa.array(n_lines, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, out_col, "n_lines"])

    return plain.mapInArrow(run, schema)
