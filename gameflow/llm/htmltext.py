"""Visible text of HTML pages, laid out as blocks, lists and aligned tables.

Tags go to a tree builder that opens and closes elements by HTML's rules for implied tags. As it
goes, visible elements write into a flow of lines: inline text is collapsed, blocks break lines,
list items carry markers and indents, and a table keeps the lines of its cells until it is closed
and its column widths are known. Nothing recurses, so depth is bounded by memory alone.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<close>/)?(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>?",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
HIDING_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
SPACES = re.compile(r"[ \t\n\r\f]+")

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup: up to their end tag, everything is text.
RAW = set("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = set("head script style template noscript title iframe noembed noframes object video audio canvas svg math "
             "datalist select meta link base".split())
#: Blocks and the blank lines around them.
BLOCKS = dict.fromkeys("html body div section article header footer nav main aside form fieldset address figcaption legend "
                       "details summary dialog search hgroup center li dt dd tr caption thead tbody tfoot option".split(), 0)
BLOCKS |= dict.fromkeys("p h1 h2 h3 h4 h5 h6 ul ol dl menu dir pre xmp blockquote figure table hr textarea".split(), 1)
LISTS = {"ul", "ol", "menu", "dir"}
CELLS = {"td", "th"}
SECTIONS = {"thead", "tbody", "tfoot"}
#: What an opening tag closes, and the elements beyond which it does not look.
CLOSES: dict[str, tuple[set[str], set[str]]] = {
    "li": ({"li"}, LISTS | {"table"}), "dt": ({"dt", "dd"}, {"dl", "table"}), "dd": ({"dt", "dd"}, {"dl", "table"}),
    "tr": ({"tr"} | CELLS | {"caption"}, {"table"}), "td": (CELLS | {"caption"}, {"table"}), "th": (CELLS | {"caption"}, {"table"}),
    "caption": ({"caption"}, {"table"}), "option": ({"option"}, {"select"}), "body": ({"head"}, {"table"}),
    **dict.fromkeys(SECTIONS, (SECTIONS | {"tr", "caption"} | CELLS, {"table"})),
}
#: Blocks that end an open paragraph.
ENDS_P = (set(BLOCKS) - {"tr", "caption", "option", "html", "body"} - SECTIONS) | {"table"}
SCOPE = CELLS | {"table", "caption", "button", "object", "template"}
#: The largest colspan and rowspan that HTML knows.
MAX_COLSPAN, MAX_ROWSPAN = 1000, 65_534
#: Columns are padded up to this width, so that a table with one very long cell does not become as
#: long as that cell times its rows; longer cells run over.
MAX_PAD = 60
GAP = "  "


class Flow:
    """Lines of one column of text."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = False
        self.blank = 0
        self.indents: list[str] = []
        self.marker = ""

    def text(self, data: str) -> None:
        parts = SPACES.split(data)
        if not parts[0]:
            self.space = True
        words = [p for p in parts if p]
        if not words:
            return
        if self.space and self.line:
            self.line.append(" ")
        self.line.append(" ".join(words))
        self.space = not parts[-1]

    def preformatted(self, data: str) -> None:
        first, *others = data.replace("\r\n", "\n").split("\n")
        if first:
            self.line.append(first)
        for other in others:
            self.end_line(True)
            if other:
                self.line.append(other)
        self.space = False

    def end_line(self, keep_empty: bool = False) -> None:
        """Finishes the line; an empty one counts only where a break asks for it."""
        if self.line or (keep_empty and self.lines and not self.blank):
            if self.blank and self.lines:
                self.lines.append("")
            self.blank = 0
            lead = "".join(self.indents)
            if self.marker:
                lead = lead[:len(lead) - len(self.marker)] + self.marker
                self.marker = ""
            self.lines.append((lead + "".join(self.line)).rstrip(" "))
            self.line = []
        self.space = False

    def block(self, blank: int) -> None:
        self.end_line()
        self.blank = max(self.blank, blank if self.lines else 0)

    def add_lines(self, lines: list[str]) -> None:
        for line in lines:
            self.line.append(line)
            if line:
                self.end_line()
            else:
                self.line = []
                self.end_line(True)

    def finished(self) -> list[str]:
        self.end_line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


class Table:
    """Cells of a table: lines, column, and how many columns and rows they span."""

    def __init__(self) -> None:
        self.rows: list[list[tuple[int, int, list[str]]]] = []
        self.taken: dict[int, int] = {}  # column -> rows that a cell from above still covers
        self.column = 0

    def row(self) -> None:
        self.rows.append([])
        self.column = 0
        self.taken = {c: n - 1 for c, n in self.taken.items() if n > 1}

    def cell(self, lines: list[str], columns: int, rows: int) -> None:
        while self.taken.get(self.column, 0) > 0 and self._from_above(self.column):
            self.column += 1
        self.rows[-1].append((self.column, columns, lines))
        for c in range(self.column, self.column + columns) if rows > 1 else ():
            self.taken[c] = rows
        self.column += columns

    def _from_above(self, column: int) -> bool:
        return not any(c <= column < c + n for c, n, _ in self.rows[-1])

    def laid_out(self) -> list[str]:
        width: dict[int, int] = {}
        for row in self.rows:
            for column, columns, lines in row:
                if columns == 1:
                    width[column] = max(width.get(column, 0), *map(len, lines), 0) if lines else width.get(column, 0)
        width = {c: min(w, MAX_PAD) for c, w in width.items()}
        start, at = {}, 0
        for c in range(max((c + n for row in self.rows for c, n, _ in row), default=0) + 1):
            start[c] = at
            at += width[c] + len(GAP) if width.get(c) else 0
        result = []
        for row in self.rows:
            for k in range(max((len(lines) for _, _, lines in row), default=0)):
                line = ""
                for column, _, lines in row:
                    if k < len(lines) and lines[k]:
                        line = line.ljust(start[column]) if len(line) <= start[column] else line + GAP
                        line += lines[k]
                result.append(line.rstrip(" "))
        return result


def _attributes(rest: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(rest)}


def _number(value: str | None, default: int, most: int) -> int:
    return min(max(int(value), 1), most) if value and value.isascii() and value.isdigit() and len(value) < 9 else default


class Builder:
    """Open elements and the flows they write to."""

    def __init__(self) -> None:
        self.open: list[tuple] = []  # name, hides, what to undo at the end, the nearest element that text depends on
        self.hidden = 0
        self.flows = [Flow()]
        self.tables: list[Table] = []
        self.lists: list[list] = []  # ordered, next number
        self.pre = 0
        self.at: dict[str, list[int]] = {}  # places of the open elements of a name

    def text(self, data: str) -> None:
        if self.hidden or not data:
            return
        in_table = self.open[-1][3] if self.open else ""
        flow = self.flows[-1]
        if in_table in SECTIONS | {"tr", "table"} and not data.strip():
            return  # between cells; other text there goes before the table
        flow.preformatted(data) if self.pre else flow.text(data)

    def start(self, name: str, rest: str) -> None:
        self._implied(name)
        interesting = rest and not rest.isspace()
        attributes = _attributes(rest) if interesting else {}
        hides = name in HIDDEN or "hidden" in attributes or (name == "dialog" and "open" not in attributes) or bool(
            "style" in attributes and HIDING_STYLE.search(attributes["style"]))
        flow = self.flows[-1]
        if name in VOID:
            if self.hidden or hides:
                return
            if name == "br":
                flow.end_line(True)
            elif name == "hr":
                flow.block(1)
            elif name == "wbr":
                pass
            elif name == "input" and attributes.get("type", "text").lower() in ("submit", "button", "reset", "text") and attributes.get("value"):
                flow.text(attributes["value"])
            return
        undo = None
        self.hidden += hides
        if not self.hidden:
            if name in BLOCKS and name not in SECTIONS and name != "tr":
                nested = name in LISTS and self.lists
                flow.block(0 if nested else BLOCKS[name])
            undo = self._begin(name, attributes, flow)
        scope = name if name in SCOPE or name in SECTIONS or name == "tr" else self.open[-1][3] if self.open else ""
        self.at.setdefault(name, []).append(len(self.open))
        self.open.append((name, hides, undo, scope))

    def _begin(self, name: str, attributes: dict[str, str], flow: Flow):
        if name in LISTS:
            first = attributes.get("start", "")
            self.lists.append([name == "ol", int(first) if re.fullmatch(r"-?\d{1,8}", first) else 1])
        elif name == "li":
            kind = self.lists[-1] if self.lists else [False, 1]
            if kind[0] and re.fullmatch(r"-?\d{1,8}", attributes.get("value", "")):
                kind[1] = int(attributes["value"])
            marker = f"{kind[1]}. " if kind[0] else "- "
            kind[1] += 1
            flow.indents.append(" " * len(marker))
            flow.marker = marker
        elif name in ("blockquote", "dd"):
            flow.indents.append("  ")
        elif name in ("pre", "textarea", "xmp"):
            self.pre += 1
        elif name == "table":
            self.tables.append(Table())
        elif name == "tr" and self.tables:
            self.tables[-1].row()
        elif name in CELLS and self.tables:
            self.flows.append(Flow())
            return _number(attributes.get("colspan"), 1, MAX_COLSPAN), _number(attributes.get("rowspan"), 1, MAX_ROWSPAN)
        elif name == "q":
            flow.text('"')
        return None

    def _implied(self, name: str) -> None:
        if name in ENDS_P and self.at.get("p") and name != "option":
            self._close({"p"}, SCOPE)
        if name in CLOSES:
            closing, limit = CLOSES[name]
            if any(self.at.get(c) for c in closing):
                while self._close(closing, limit):
                    pass
        if name in CELLS and self.tables and not self._inside("tr", "table"):
            self.start("tr", "")
        if name == "tr" and self.tables and not any(self._inside(s, "table") for s in SECTIONS):
            self.start("tbody", "")

    def _inside(self, name: str, limit: str) -> bool:
        return self._last({name}) > self._last({limit})

    def _last(self, names: set[str]) -> int:
        """Place of the innermost open element of ``names``, -1 if there is none."""
        return max((self.at[name][-1] for name in names if self.at.get(name)), default=-1)

    def _close(self, names: set[str], limit: set[str]) -> bool:
        """Closes the innermost of ``names`` with all in it, unless an element of ``limit`` is nearer."""
        k = self._last(names)
        if k < 0 or self._last(limit) > k:
            return False
        while len(self.open) > k:
            self._end()
        return True

    def end(self, name: str) -> None:
        if name == "br":
            return self.start("br", "")
        if not self.at.get(name):
            if name == "p" and not self.hidden:
                self.flows[-1].block(1)
            return None
        limit = set() if name in ("table", "html", "body") else {"table"} if name in SECTIONS | CELLS | {"tr", "caption"} else CELLS | {"table", "caption"}
        self._close({name}, limit)
        return None

    def _end(self) -> None:
        name, hides, undo, _ = self.open.pop()
        self.at[name].pop()
        if not self.hidden:
            if undo and len(self.flows) > 1:
                lines = self.flows.pop().finished()
                if not self.tables[-1].rows:
                    self.tables[-1].row()
                self.tables[-1].cell(lines, *undo)
            flow = self.flows[-1]
            if name == "table":
                flow.end_line()
                flow.add_lines(self.tables.pop().laid_out())
            if name in BLOCKS and name not in SECTIONS and name != "tr":
                flow.block(0 if name in LISTS and len(self.lists) > 1 else BLOCKS[name])
            if name in LISTS:
                self.lists.pop()
            elif name == "li":
                flow.indents.pop()
                flow.marker = ""
            elif name in ("blockquote", "dd"):
                flow.indents.pop()
            elif name in ("pre", "textarea", "xmp"):
                self.pre -= 1
            elif name == "q":
                flow.text('"')
        self.hidden -= hides

    def finished(self) -> str:
        while self.open:
            self._end()
        return "\n".join(self.flows[0].finished())


def render(page: str) -> str:
    """The visible text of a page."""
    builder, at = Builder(), 0
    while at < len(page):
        cut = page.find("<", at)
        if cut < 0:
            cut = len(page)
        tag = TAG.match(page, cut) if cut < len(page) else None
        if cut < len(page) and not tag:  # a lone "<" is text
            builder.text(html.unescape(page[at:cut]) + "<")
            at = cut + 1
            continue
        builder.text(html.unescape(page[at:cut]))
        if not tag:
            break
        at = tag.end()
        if not tag["name"]:
            continue
        name = tag["name"].lower()
        if tag["close"]:
            builder.end(name)
            continue
        builder.start(name, tag["rest"])
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            inside = page[at:end.start() if end else len(page)]
            builder.text(html.unescape(inside) if name in ("textarea", "title") else inside)
            builder.end(name)
            at = end.end() if end else len(page)
    return builder.finished()


def visible_text(pages: DataFrame) -> DataFrame:
    """``page_id`` and ``text`` of each row of ``pages(page_id, html)``.

    A null page gives null, an empty one an empty text. Repeated rows are rendered each; an empty
    table gives an empty result; other columns are not used. A page is rendered whole, however
    long or deep.
    """
    kind = dict(pages.dtypes)["page_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                texts = [None if page is None else render(page) for page in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["page_id", "text"])

    slim = pages.select("page_id", F.col("html").cast("string"))
    return slim.mapInArrow(run, f"page_id {kind}, text string")
