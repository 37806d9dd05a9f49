"""Layout-aware text of web pages.

A tree builder turns tags into properly nested opens and closes, with the end tags that HTML lets authors leave out,
and marks what is not shown. The layout then writes all visible text: white space is collapsed outside <pre>, blocks
are set apart by line breaks or blank lines, list items get markers and indents, and table cells are aligned.

Both work on one pass of events and keep their own stacks, so deep nesting and very long pages need no recursion, and
the work grows with the page. Pages are independent: no shuffle.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotledger.llm.common import slices, utf8

SLICE_BYTES = 4 << 20
INDENT_UP_TO = 60  # deeper lists are not indented further
WRAP_AT = 80  # cells are wrapped between words at this width; a longer word runs on, and only its own line is out of line
ALIGN_WITHIN = 500  # columns that begin further to the right follow two spaces apart, so that padding stays bounded


def _names(text: str) -> frozenset[str]:
    return frozenset(text.split())


# Names of elements by their part in HTML.
VOID = _names("area base br col embed hr img input link meta param source track wbr")
RAW = _names("script style textarea title xmp iframe noembed noframes")
HIDDEN = _names("head script style title template iframe noembed noframes object audio video canvas datalist map")
HIDDEN |= _names("svg:title svg:desc svg:metadata svg:defs svg:style svg:script svg:symbol svg:clippath svg:mask svg:pattern svg:marker")
HIDDEN |= _names("math:annotation math:annotation-xml")
BLANK_LINE = _names("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure hr menu")
OWN_LINE = _names(
    "html body div section article aside nav header footer main address form fieldset legend details summary dt dd li "
    "figcaption caption center tr tbody thead tfoot option optgroup dir"
)
CLOSES_P = (BLANK_LINE | _names("address article aside details div fieldset footer form header main nav section center dir")) - {"figcaption"}
LISTS = _names("ul ol menu dir")
IN_HEAD = _names("head title meta link base style script noscript template")
CLOSED_BY = {
    "li": _names("li"),
    "dt": _names("dt dd"),
    "dd": _names("dt dd"),
    "option": _names("option"),
    "optgroup": _names("option optgroup"),
    "td": _names("td th"),
    "th": _names("td th"),
    "tr": _names("td th tr"),
    "tbody": _names("td th tr tbody thead tfoot caption"),
    "thead": _names("td th tr tbody thead tfoot caption"),
    "tfoot": _names("td th tr tbody thead tfoot caption"),
}
STOPS = {"li": LISTS, "dt": _names("dl"), "dd": _names("dl"), "option": _names("select"), "optgroup": _names("select")}
TABLE_PARTS = _names("table caption tbody thead tfoot tr td th")
ROW_GROUPS = _names("tbody thead tfoot")
HTML_INSIDE = _names("svg:foreignobject math:annotation-xml")
LEAVES_FOREIGN = _names(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p "
    "pre ruby s small span strong strike sub sup table tt u ul var"
)
LABELS = _names("svg:text svg:foreignobject math:mtable math:mtr")
SIDE_BY_SIDE = _names("math:mfrac math:msub math:msup math:msubsup math:munder math:mover math:munderover math:mroot math:mtr")

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>")
_ANY_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_SPACES = re.compile(r"[ \t\n\r\f]+")
_HIDES = re.compile(r"\bhidden\b(?!\s*=\s*[\"']?until-found)|display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
_QUOTED = re.compile(r"=\s*(?:\"[^\"]*\"|'[^']*')")
_SPAN = re.compile(r"\bcolspan\s*=\s*[\"']?(\d{1,4})", re.I)
_ROWS = re.compile(r"\browspan\s*=\s*[\"']?(\d{1,5})", re.I)
_VALUE_WITH_SLASH = re.compile(r"=\s*[^\s\"'=>]+/$")
_SVG_HIDES = re.compile(r"\bdisplay\s*=\s*[\"']?none|\bvisibility\s*=\s*[\"']?(?:hidden|collapse)", re.I)
_START = re.compile(r"\bstart\s*=\s*[\"']?(-?\d{1,9})", re.I)
_STYLE = re.compile(r"\bstyle\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)


def _hides(tag: str, attributes: str) -> bool:
    if tag in HIDDEN or (attributes and tag.startswith("svg") and _SVG_HIDES.search(attributes)):
        return True
    if not attributes or not _HIDES.search(attributes):
        return False
    style = _STYLE.search(attributes)
    if style and re.search(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", style[1], re.I):
        return True
    return bool(re.search(r"(?:^|\s)hidden(?=[\s=/]|$)", _QUOTED.sub(" ", attributes), re.I))


def events(page: str) -> Iterator[tuple[str, str, str]]:
    """("text", text, ""), ("open", tag, attributes) and ("close", tag, "") of a properly nested tree.

    Elements of drawings and formulas are named after their root, as svg:text or math:mi, so that none is taken for an
    HTML element of that name.
    """
    stack: list[str] = []
    roots: list[tuple[int, str]] = []  # where in the stack a drawing or formula begins, or HTML within one
    # how many of each element are open, counted anew inside tables and cells, whose content cannot close what is outside
    scopes: list[Counter] = [Counter()]

    def push(tag: str) -> None:
        if tag in ("svg", "math") or tag in HTML_INSIDE:
            roots.append((len(stack), "" if tag in HTML_INSIDE else tag))
        stack.append(tag)
        scopes[-1][tag] += 1
        if tag in ("table", "td", "th", "caption"):
            scopes.append(Counter())

    def pop() -> str:
        tag = stack.pop()
        if tag in ("table", "td", "th", "caption"):
            scopes.pop()
        scopes[-1][tag] -= 1
        if roots and roots[-1][0] == len(stack):
            roots.pop()
        return tag

    def pop_to(tags: frozenset[str], stops: frozenset[str] = frozenset()) -> Iterator[tuple[str, str, str]]:
        """Close the innermost of ``tags`` and what is open in it, unless one of ``stops`` is nearer."""
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth] in tags:
                while len(stack) > depth:
                    yield "close", pop(), ""
                return
            if stack[depth] in stops:
                return

    def pop_row(tags: frozenset[str]) -> Iterator[tuple[str, str, str]]:
        """Close all of ``tags`` that are open in the current table."""
        lowest = None
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth] == "table":
                break
            if stack[depth] in tags:
                lowest = depth
        while lowest is not None and len(stack) > lowest:
            yield "close", pop(), ""

    def parts_open(tags: frozenset[str]) -> bool:
        return any(scopes[-1][t] for t in tags)

    position, end, last = 0, len(page), page.rfind(">")
    while position < end:
        start = page.find("<", position)
        if start < 0:
            start = end
        if start > position:
            if stack and stack[-1] == "head" and page[position:start].strip():
                yield "close", pop(), ""
            yield "text", page[position:start], ""
        if start == end:
            break
        if page.startswith("<!--", start):
            close = page.find("-->", start + 4)
            position = end if close < 0 else close + 3
            continue
        foreign = roots[-1][1] if roots else ""
        if foreign and page.startswith("<![CDATA[", start):
            close = page.find("]]>", start)
            position = end if close < 0 else close + 3
            yield "text", html.escape(page[start + 9 : end if close < 0 else close]), ""
            continue
        after = page[start + 1 : start + 2]
        if after in ("!", "?") or (after == "/" and not page[start + 2 : start + 3].isalpha()):
            close = page.find(">", start)
            position = end if close < 0 else close + 1
            continue
        if not ((after.isascii() and after.isalpha()) or after == "/"):
            yield "text", "<", ""
            position = start + 1
            continue
        match = (_TAG.match(page, start) or _ANY_TAG.match(page, start)) if start < last else None
        if not match:  # the page ends inside a tag
            break
        position = match.end()
        closing, tag, attributes = match[1], match[2].lower(), match[3]
        if closing:
            if foreign and scopes[-1][f"{foreign}:{tag}"]:
                yield from pop_to(frozenset((f"{foreign}:{tag}",)))
            elif not foreign and roots and tag in ("foreignobject", "annotation-xml"):
                yield from pop_to(HTML_INSIDE)
            elif tag == "p" and not scopes[-1]["p"]:
                yield "open", "p", ""
                yield "close", "p", ""
            elif tag in ("body", "html"):
                pass  # what follows still belongs to the page
            elif tag in TABLE_PARTS:
                if any(scope[tag] for scope in scopes[-3:]):
                    yield from pop_to(frozenset((tag,)), frozenset() if tag == "table" else frozenset(("table",)) - {tag})
            elif scopes[-1][tag]:
                yield from pop_to(frozenset((tag,)))
            elif tag == "br":
                yield "open", "br", ""
                yield "close", "br", ""
            continue
        if foreign and tag in LEAVES_FOREIGN:
            yield from pop_to(frozenset((foreign,)))
        elif foreign:
            tag = f"{foreign}:{tag}"
        if stack and stack[-1] == "head" and tag not in IN_HEAD:
            yield "close", pop(), ""
        if tag in ("html", "body") and scopes[0][tag]:
            continue
        if tag in CLOSES_P and scopes[-1]["p"]:
            yield from pop_to(frozenset(("p",)))
        if tag in ("td", "th", "tr", "tbody", "thead", "tfoot"):
            yield from pop_row(CLOSED_BY[tag])
            if tag in ("td", "th") and stack and stack[-1] in ("table", "tbody", "thead", "tfoot"):
                push("tr")
                yield "open", "tr", ""
        elif tag in CLOSED_BY and parts_open(CLOSED_BY[tag]):
            yield from pop_to(CLOSED_BY[tag], STOPS[tag] | _names("table td th caption"))
        yield "open", tag, attributes
        closed = attributes.endswith("/") and (":" in tag or tag in ("svg", "math")) and not _VALUE_WITH_SLASH.search(attributes)
        if tag in VOID or closed:
            yield "close", tag, ""
            continue
        push(tag)
        if tag in RAW:
            close = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(page, position)
            stop = close.start() if close else end
            if stop > position:
                yield "text", page[position:stop], ""
            position = stop
            if not close:
                break
    while stack:
        yield "close", pop(), ""


class _Flow:
    """Text that is being laid out: words and line breaks, at the indent of the current list."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.breaks = 0
        self.space = False
        self.indent = 0
        self.marker = ""
        self.colspan = self.rowspan = 1

    def block(self, breaks: int) -> None:
        self.breaks = max(self.breaks, breaks)
        self.space = False

    def _begin(self) -> None:
        if self.breaks or not self.parts:
            if self.parts:
                self.parts.append("\n" * self.breaks)
            self.parts.append(" " * max(0, min(self.indent, INDENT_UP_TO) - len(self.marker)) + self.marker)
            self.marker, self.breaks = "", 0
        elif self.marker:
            self.parts.append(self.marker)
            self.marker = ""
        elif self.space:
            self.parts.append(" ")
        self.space = False

    def words(self, text: str) -> None:
        plain = _SPACES.sub(" ", text)
        inner = plain.strip(" ")
        if not inner:
            self.space = self.space or (bool(plain) and bool(self.parts) and not self.breaks)
            return
        self.space = self.space or plain[0] == " "
        self._begin()
        self.parts.append(inner)
        self.space = plain[-1] == " "

    def kept(self, text: str) -> None:
        """Text whose white space counts."""
        for k, line in enumerate(text.replace("\r\n", "\n").replace("\r", "\n").split("\n")):
            if k:
                self.breaks = self.breaks + 1 if self.breaks and self.parts else 1
            if line:
                self.space = False
                self._begin()
                self.parts.append(line)

    def lines(self, lines: list[str]) -> None:
        for line in lines:
            self.block(1)
            self._begin()
            self.parts.append(line)

    def text(self) -> str:
        if self.marker:  # an item without text
            self._begin()
        return "".join(self.parts)


def _wrapped(text: str) -> list[str]:
    """The lines of a cell, broken between words where they get too wide."""
    out = []
    for line in text.split("\n"):
        while len(line) > WRAP_AT:
            cut = line.rfind(" ", len(line) - len(line.lstrip()), WRAP_AT + 1)
            if cut <= 0 or not line[:cut].strip():
                cut = line.find(" ", WRAP_AT)
            if cut < 0:
                break
            out.append(line[:cut])
            line = line[cut + 1 :]
        out.append(line)
    return out


class _Table:
    def __init__(self) -> None:
        self.rows: list[list[tuple[list[str], int, int]]] = []
        self.groups: set[int] = set()

    def group(self) -> None:
        """No cell reaches from one group of rows into the next."""
        self.groups.add(len(self.rows))

    def add(self, text: str, columns: int, rows: int) -> None:
        if not self.rows:
            self.rows.append([])
        self.rows[-1].append((_wrapped(text), columns, rows))

    def _placed(self) -> list[list[tuple[int, list[str], int]]]:
        """(column, lines, columns) of the cells of each row, beside the cells that reach down into it."""
        out = []
        reaching: list[tuple[int, int, float]] = []  # first column, column behind, first row that is free again
        for number, row in enumerate(self.rows):
            if number in self.groups:
                reaching = []
            placed, column, k = [], 0, 0
            if row:
                reaching = [r for r in reaching if r[2] > number]
            below = []
            for lines, columns, rows in row:
                while k < len(reaching) and reaching[k][0] <= column:
                    column = max(column, reaching[k][1])
                    k += 1
                placed.append((column, lines, columns))
                if rows != 1:
                    free = number + rows if rows else float("inf")
                    if below and below[-1][1:] == (column, free):
                        below[-1] = (below[-1][0], column + columns, free)
                    else:
                        below.append((column, column + columns, free))
                column += columns
            if below:
                reaching = sorted(reaching + below)
            out.append(placed)
        return out

    def lines(self) -> list[str]:
        """Rows of cells in columns two spaces apart; cells of several lines make their row higher.

        A cell over several rows is written in the first; its columns stay free in the others.
        """
        rows = self._placed()
        widths: dict[int, int] = {}  # of the columns in which cells begin
        for row in rows:
            for column, lines, columns in row:
                fit = max((len(line) for line in lines if len(line) <= WRAP_AT), default=0) if columns == 1 else 0
                widths[column] = max(widths.get(column, 0), fit)
        offsets, offset = {}, 0
        for column in sorted(widths):
            offsets[column] = offset
            offset += widths[column] + 2
        out = []
        for row in rows:
            for k in range(max((len(lines) for _, lines, _ in row), default=0)):
                pieces, length = [], 0
                for column, lines, _ in row:
                    if k < len(lines) and lines[k]:
                        start = offsets[column] if offsets[column] <= ALIGN_WITHIN else 0
                        gap = max(start - length, 2 if length else 0)
                        pieces.append(" " * gap + lines[k])
                        length += gap + len(lines[k])
                out.append("".join(pieces).rstrip())
        return [line for line in out if line]


def render(page: str) -> str:
    """All visible text of a page, laid out."""
    flows, tables, lists = [_Flow()], [], []
    hidden = pre = 0
    marks: list[tuple[str, int]] = []  # open elements: what closing them undoes
    for kind, name, attributes in events(page):
        flow = flows[-1]
        if kind == "text":
            if not hidden:
                text = html.unescape(name).replace("\xa0", " " if pre else "\x00")
                flow.kept(text) if pre else flow.words(text)
            continue
        if kind == "open":
            hides = _hides(name, attributes)
            hidden += hides
            marks.append((name, hides))
            if hidden:
                continue
            if name == "br":
                flow.breaks = flow.breaks + 1 if flow.breaks and flow.parts else 1
                flow.space = False
            elif name == "hr":
                flow.block(2)
            elif name == "table":
                flow.block(2)
                tables.append(_Table())
            elif name == "tr" and tables:
                tables[-1].rows.append([])
            elif name in ("td", "th") and tables:
                flows.append(_Flow())
                span = _SPAN.search(attributes)
                flows[-1].colspan = min(max(1, int(span[1])), 1000) if span else 1
                down = _ROWS.search(attributes)
                flows[-1].rowspan = min(int(down[1]), 65_534) if down else 1
            elif name == "caption" and tables:
                flows.append(_Flow())
            elif name in LISTS:
                flow.block(1 if lists else 2)
                start = _START.search(attributes) if attributes else None
                lists.append([name, (int(start[1]) if start else 1) - 1])
                flow.indent += 3 if name == "ol" else 2
            elif name == "li":
                flow.block(1)
                if lists:
                    lists[-1][1] += 1
                flow.marker = f"{lists[-1][1]}. " if lists and lists[-1][0] == "ol" else "- "
            elif name == "dd":
                flow.block(1)
                flow.indent += 4
            else:
                pre += name == "pre"
                if name in ROW_GROUPS and tables:
                    tables[-1].group()
                if name in BLANK_LINE:
                    flow.block(2)
                elif name in OWN_LINE or name in LABELS:
                    flow.block(1)
            continue
        name, hides = marks.pop()
        was_hidden, hidden = hidden, hidden - hides
        if was_hidden:
            continue
        if marks and marks[-1][0] in SIDE_BY_SIDE:
            flow.space = flow.space or (bool(flow.parts) and not flow.breaks)
        if name in ("td", "th") and tables:
            cell = flows.pop()
            tables[-1].add(cell.text(), cell.colspan, cell.rowspan)
        elif name == "caption" and tables:
            caption = flows.pop().text()
            flows[-1].lines(caption.split("\n") if caption else [])
        elif name == "table":
            flow.lines(tables.pop().lines())
            flow.block(2)
        elif name in LISTS:
            lists.pop()
            flow.indent -= 3 if name == "ol" else 2
            flow.block(1 if lists else 2)
        elif name == "li":
            if flow.marker:
                flow._begin()
            flow.block(1)
        elif name == "dd":
            flow.indent -= 4
            flow.block(1)
        elif name in BLANK_LINE:
            pre -= name == "pre"
            flow.block(2)
        elif name in OWN_LINE or name in LABELS:
            flow.block(1)
    text = flows[0].text().replace("\x00", " ")
    return "\n".join(line.rstrip() for line in text.split("\n")).strip("\n")


def _rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        offsets = utf8(batch.column(1))[1]
        for first, last in slices(offsets, SLICE_BYTES):
            pages = batch.column(1).slice(first, last - first).to_pylist()
            columns = [batch.column(0).slice(first, last - first), pa.array(list(map(render, pages)), pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "text"])


def page_text(pages: DataFrame) -> DataFrame:
    """page_id and the visible text of every page.

    Null and empty pages give empty text; unclosed, misnested and cut-off tags are repaired as browsers do; repeated
    pages are rendered one by one; further columns are not read; an empty table gives an empty one.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("html"), F.lit("")).alias("html"))
    return rows.mapInArrow(_rendered, "page_id long, text string")
