"""Layout-aware rendering of HTML pages as text."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from html import unescape as _unescape
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import lean, text_of

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())  #: their content has no tags
HIDDEN = frozenset("head script style title template noscript iframe noembed noframes object video audio canvas datalist svg math".split())
MARGIN = dict.fromkeys("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure fieldset hr menu".split(), 1) | dict.fromkeys(
    "html body div section article header footer nav main aside address form li dt dd tr caption summary details figcaption legend option optgroup center thead tbody tfoot td th hgroup search dir".split(), 0
)
CELL = frozenset(("td", "th"))
SPANS = {"colspan": 1000, "rowspan": 65534}
DEEP = 40  #: steps of indent
_TABLE = frozenset("tr table tbody thead tfoot td th body html".split())
#: An open element that a start tag of the key ends, and the elements that bound the search for it.
_P_ENDS = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th", "caption"), ("table", "thead", "tbody", "tfoot")), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "thead": (("caption", "thead", "tbody", "tfoot"), ("table",)), "tbody": (("caption", "thead", "tbody", "tfoot"), ("table",)), "tfoot": (("caption", "thead", "tbody", "tfoot"), ("table",)),
    "option": (("option",), ("select", "optgroup", "datalist")), "optgroup": (("option", "optgroup"), ("select",)), "body": (("head",), ("html",)),
}
_SCOPE = frozenset("table td th caption html template object button".split())  #: an end of p is not implied through these

#: An open tag's name and as much of its attributes as has no open quote; possessive, so it never steps back.
_TAG = re.compile(r"(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_DECLARED = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([a-z-]+)", re.I)
_SIMPLE = re.compile(r"([a-zA-Z][\w-]*|\*)?((?:[.#][\w-]+)*)")
_LONG_NUMBER = re.compile(r"(&#[0-9]{8})[0-9]+")
_SPACE = re.compile(r"[ \t\n\r\f]+")


def unescape(text: str) -> str:
    """Text with its character references resolved; numbers of any length are beyond Unicode alike."""
    return _unescape(_LONG_NUMBER.sub(r"\1", text) if "&#" in text else text)


class Node:
    __slots__ = ("attributes", "children", "tag")

    def __init__(self, tag: str, attributes: dict[str, str]) -> None:
        self.tag, self.attributes, self.children = tag, attributes, []

    def hidden(self) -> bool:
        """Whether the element and all in it are left out, whatever styles say of what is in it."""
        a = self.attributes
        return self.tag in HIDDEN or "hidden" in a or (self.tag == "input" and a.get("type", "").lower() == "hidden") or (self.tag == "dialog" and "open" not in a)


def _declared(source: str) -> dict[str, str]:
    """display and visibility of a list of declarations, the last of each."""
    return {k.lower(): v.lower() for k, v in _DECLARED.findall(source)} if ":" in source else {}


class Styles:
    """Rules of a page's style elements: those of type, class and id selectors without combinators, outside of at-rules.

    A rule with an id beats one with classes, that beats one with a type alone, then the later wins;
    the style attribute beats all.
    """

    def __init__(self) -> None:
        self.rules: dict[str, list[tuple[tuple[int, int, int, int], str, frozenset[str], dict[str, str]]]] = {}
        self.known: dict[tuple[str, str, str], dict[str, str]] = {}
        self.n = 0

    def add(self, css: str) -> None:
        css, depth, at = re.sub(r"/\*.*?(?:\*/|\Z)", " ", css, flags=re.S), 0, 0
        selectors = ""
        for m in re.finditer(r"[{}]", css):
            piece, at = css[at : m.start()], m.end()
            if m[0] == "{":
                depth += 1
                selectors = piece if depth == 1 else ""
            else:
                if depth == 1 and "@" not in selectors and (found := _declared(piece)):
                    for selector in selectors.rpartition(";")[2].split(","):
                        self._rule(selector.strip(), found)
                depth = max(0, depth - 1)

    def _rule(self, selector: str, found: dict[str, str]) -> None:
        m = _SIMPLE.fullmatch(selector)
        if not m or not selector:
            return
        tag, marks = (m[1] or "*").lower(), re.findall(r"[.#][\w-]+", m[2])
        self.n += 1
        ids = sum(x[0] == "#" for x in marks)
        rule = ((ids, len(marks) - ids, tag != "*", self.n), tag, frozenset(marks), found)
        self.rules.setdefault(marks[0] if marks else tag, []).append(rule)

    def of(self, node: Node) -> dict[str, str]:
        a = node.attributes
        key = (node.tag, a.get("class", ""), a.get("id", ""))
        out = self.known.get(key) if self.rules else {}
        if out is None:
            out = self.known[key] = {}
            marks = {"." + c for c in a.get("class", "").split()} | ({"#" + a["id"]} if a.get("id") else set())
            fit = [r for key in (*marks, node.tag, "*") for r in self.rules.get(key, ()) if r[1] in (node.tag, "*") and r[2] <= marks]
            for *_, found in sorted(fit, key=lambda r: r[0]):
                out.update(found)
        return out | _declared(a["style"]) if "style" in a else out


def _attributes(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    if source and not source.isspace():
        for name, a, b, c in _ATTRIBUTE.findall(source):
            out.setdefault(name.lower(), unescape(a or b or c))
    return out


class Open:
    """The open elements, with the places of each tag, so that looking for one takes no walk."""

    def __init__(self, root: Node) -> None:
        self.stack, self.places = [root], {}

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.stack))
        self.stack.append(node)

    def innermost(self, tags: Iterable[str]) -> int:
        """The place of the innermost open element of these tags; 0 if there is none."""
        return max((p[-1] for t in tags if (p := self.places.get(t))), default=0)

    def cut(self, place: int) -> None:
        """End the element at ``place`` and all in it."""
        while len(self.stack) > place:
            self.places[self.stack.pop().tag].pop()

    def close(self, names: Iterable[str], bounds: Iterable[str]) -> None:
        """End the outermost of the open elements ``names`` within the innermost of ``bounds``."""
        bound = self.innermost(bounds)
        inside = [p[i] for t in names if (p := self.places.get(t)) and (i := bisect_right(p, bound)) < len(p)]
        if inside:
            self.cut(min(inside))


def parse(html: str) -> tuple[Node, Styles]:
    """A tree from tag soup, and the page's style rules: implied ends, void and raw elements, ends without a start ignored.

    The page is read once from left to right and never again from an earlier place. An unclosed
    comment or tag takes in all the rest, as in browsers; a quote that nothing closes counts as an
    ordinary character of its tag.
    """
    root, styles = Node("#root", {}), Styles()
    up = Open(root)
    stack = up.stack
    at, n = 0, len(html)
    while at < n:
        start = html.find("<", at)
        while 0 <= start < n - 1 and not (html[start + 1].isascii() and (html[start + 1].isalpha() or html[start + 1] in "!?/")):
            start = html.find("<", start + 1)
        if start < 0 or start == n - 1:
            start = n
        if start > at:
            stack[-1].children.append(unescape(html[at:start]))
        if start == n:
            break
        at = start + 1
        if html.startswith("!--", at):
            short = html.startswith((">", "->"), at + 3)
            end = html.find(">", at + 3) + 1 if short else min((e + k for mark, k in (("-->", 3), ("--!>", 4)) if (e := html.find(mark, at + 3)) >= 0), default=0)
            at = end or n
            continue
        m = _TAG.match(html, at)
        if not m:  # a declaration, an instruction, or an end without a name
            at = html.find(">", at) + 1 or n
            continue
        at, attributes = m.end(), m[3]
        if at < n and html[at] != ">":  # a quote that nothing closes; at most one of a kind on a page
            end = html.find(">", at)
            attributes += html[at : end if end >= 0 else n]
            at = end if end >= 0 else n
        if at >= n:
            break
        at += 1
        tag = m[2].lower()
        if m[1]:
            if tag == "br":
                stack[-1].children.append(Node("br", {}))
            elif place := up.innermost((tag,)):
                # an end tag in a cell doesn't reach what is open around the table
                if tag in _TABLE or place >= up.innermost(CELL):
                    up.cut(place)
            continue
        if tag in IMPLIED:
            up.close(*IMPLIED[tag])
        if tag in _P_ENDS:
            up.close(("p",), _SCOPE)
        if tag in CELL and stack[-1].tag in ("table", "thead", "tbody", "tfoot"):
            row = Node("tr", {})
            stack[-1].children.append(row)
            up.push(row)
        node = Node(tag, _attributes(attributes))
        stack[-1].children.append(node)
        if tag in VOID:
            continue
        if tag in RAW:
            close_at = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
            body = html[at : close_at.start()] if close_at else html[at:]
            node.children.append(unescape(body) if tag in ("textarea", "title") else body)
            at = (html.find(">", close_at.end()) + 1 or n) if close_at else n
            if tag == "style":
                styles.add(body)
            continue
        up.push(node)
    return root, styles


class Lines:
    """Text with lines, gaps between blocks, and indents."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line = ""
        self.gap = 0
        self.space = False
        self.indent: list[str] = []
        self.marker = ""

    def write(self, text: str) -> None:
        words = _SPACE.sub(" ", text)
        if words == " " or not words:
            self.space |= bool(words)
            return
        if (self.space or words[0] == " ") and self.line:
            self.line += " "
        self.space = words[-1] == " "
        self.line += words.strip(" ")

    def flush(self) -> None:
        if self.line:
            self.put([self.line])
        self.line, self.space = "", False

    def put(self, lines: list[str]) -> None:
        if self.lines:
            self.lines += [""] * self.gap
        self.gap = 0
        for line in lines:
            lead = "".join(self.indent[:DEEP])
            if self.marker:
                lead, self.marker = lead[: max(0, len(lead) - len(self.marker))] + self.marker, ""
            self.lines.append((lead + line).rstrip(" ") if line else "")

    def block(self, margin: int) -> None:
        self.flush()
        self.gap = max(self.gap, margin)


def _number(node: Node, name: str, default: int) -> int:
    value = node.attributes.get(name, "").strip()
    return int(value) if re.fullmatch(r"-?[0-9]{1,9}", value) else default


def _span(node: Node, name: str) -> int:
    """colspan or rowspan, which the HTML standard clamps to 1..1000 and 1..65534."""
    return max(1, min(SPANS[name], _number(node, name, 1)))


def _table(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    """Rows of (lines, column span, row span) with columns aligned."""
    grid: list[dict[int, tuple[list[str], int]]] = []
    below: list[tuple[int, int, int]] = []  #: runs of columns (start, end) that cells from above take up to a row
    for number, row in enumerate(rows):
        placed, column, i = {}, 0, 0
        below = [run for run in below if run[2] > number]
        new = []
        for lines, wide, high in row:
            while i < len(below) and below[i][0] <= column:
                column = max(column, below[i][1])
                i += 1
            placed[column] = (lines, wide)
            if high > 1:
                if new and new[-1][1:] == (column, number + high):
                    new[-1] = (new[-1][0], column + wide, number + high)
                else:
                    new.append((column, column + wide, number + high))
            column += wide
        below = sorted(below + new) if new else below
        grid.append(placed)
    width: dict[int, int] = {}
    for placed in grid:
        for c, (lines, wide) in placed.items():
            if wide == 1:
                width[c] = max(width.get(c, 0), max(map(len, lines), default=0))
    out = []
    known = sorted(width)
    before = [0, *accumulate(width[c] + 2 for c in known)]
    for placed in grid:
        starts = {c: before[bisect_left(known, c)] for c in placed}
        height = max((len(lines) for lines, _ in placed.values()), default=0)
        for i in range(height):
            line = ""
            for c in sorted(placed):
                piece = placed[c][0][i] if i < len(placed[c][0]) else ""
                if piece:
                    line = line.ljust(starts[c]) if len(line) + 2 <= starts[c] or not line else line + "  "
                    line += piece
            out.append(line)
    return out


def render(html: str) -> str:
    """All visible text of a page.

    Blocks begin lines; paragraphs, headings, lists, tables and quotes have a blank line around
    them; list items have markers and indents, preformatted text keeps its spaces, table cells are
    aligned in columns (by code points), cells that span columns don't widen them. Indents grow to
    DEEP steps; what is nested deeper has that of its ancestor.

    Left out: elements that show no text (HIDDEN), those with the hidden attribute, closed dialogs,
    all but the summary of closed details, and what style rules or attributes don't display. What is
    made invisible is left out too, but not what is made visible again inside.
    """
    out, outs = Lines(), []
    lists: list[list] = []  # [ordered, next number]
    tables: list[list] = []
    pre = 0
    root, styles = parse(html)
    visible = True
    seen: list[bool] = []  #: visibility around the open elements
    todo: list[tuple[object, bool]] = [(root, False)]

    def enter(node: Node, shown: bool) -> None:
        nonlocal visible
        inside = node.children
        if node.tag == "details" and "open" not in node.attributes:
            inside = [c for c in inside if isinstance(c, Node) and c.tag == "summary"][:1]
        seen.append(visible)
        visible = shown
        todo.append((node, True))
        todo.extend((c, False) for c in reversed(inside))

    while todo:
        node, leaving = todo.pop()
        if isinstance(node, str):
            if not visible:
                continue
            if pre:
                first, *rest = node.replace("\r\n", "\n").expandtabs(8).split("\n")
                out.line += first
                for line in rest:
                    out.put([out.line])
                    out.line = line
            else:
                out.write(node)
            continue
        tag = node.tag
        margin = MARGIN.get(tag)
        if not leaving:
            style = styles.of(node)
            if node.hidden() or style.get("display") == "none":
                continue
            shown = style["visibility"] == "visible" if style.get("visibility") in ("visible", "hidden", "collapse") else visible
            if tag == "br":
                if out.line:
                    out.flush()
                elif out.lines and not out.gap:
                    out.put([""])
                continue
            if tag == "input" and node.attributes.get("type", "").lower() in ("submit", "button", "reset"):
                out.write(" " + node.attributes.get("value", "") * shown + " ")
                continue
            if tag == "wbr" or (tag in VOID and tag != "hr"):
                continue
            if margin is not None and tag not in CELL:
                out.block(margin if not (tag in ("ul", "ol", "menu", "dir") and lists) else 0)
            if tag in ("ul", "ol", "menu", "dir"):
                lists.append([tag == "ol", _number(node, "start", 1)])
            elif tag == "li":
                if not lists:
                    lists.append([False, 1])
                own = lists[-1]
                if own[0]:
                    own[1] = _number(node, "value", own[1])
                marker = f"{own[1]}. " if own[0] else "- "
                own[1] += 1
                out.indent.append(" " * len(marker))
                out.marker = marker if shown else ""
            elif tag in ("dd", "blockquote"):
                out.indent.append("    ")
            elif tag == "pre":
                pre += 1
                if node.children and isinstance(node.children[0], str):
                    node.children[0] = node.children[0].removeprefix("\n")
            elif tag == "table":
                tables.append([])
                outs.append((out, lists, pre))
                out, lists, pre = Lines(), [], 0
            elif tag == "tr" and tables:
                tables[-1].append([])
            elif tag in CELL and tables and tables[-1]:
                outs.append((out, lists, pre))
                out, lists, pre = Lines(), [], 0
                enter(node, shown)
                continue
            elif tag in CELL:
                out.write(" ")
            enter(node, shown)
            continue
        visible = seen.pop()
        if tag == "li":
            out.block(0)
            out.indent.pop()
            out.marker = ""
        elif tag in ("ul", "ol", "menu", "dir"):
            out.flush()
            lists.pop()
            out.block(0 if lists else 1)
        elif tag in ("dd", "blockquote"):
            out.flush()
            out.indent.pop()
        elif tag == "pre":
            pre -= 1
        elif tag in CELL and tables and tables[-1]:
            out.flush()
            cell = out.lines
            out, lists, pre = outs.pop()
            tables[-1][-1].append((cell, _span(node, "colspan"), _span(node, "rowspan")))
            continue
        elif tag == "table":
            out.flush()
            loose = out.lines  # captions, and text that is in no cell
            out, lists, pre = outs.pop()
            rows = _table([r for r in tables.pop() if r])
            if loose or rows:
                out.put([*loose, *rows])
        if margin is not None and tag not in CELL:
            out.block(margin if not (tag in ("ul", "ol", "menu", "dir") and lists) else 0)
    out.flush()
    return "\n".join(out.lines).strip("\n")


def html_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """page_id, n_chars and text of each row.

    Null and empty pages give an empty text; anything else, tag soup or plain text, is rendered
    whole. Nesting is followed without recursion. Null ids and repeated rows each give a row; an
    empty table none; other columns are not read.
    """
    rows = lean(pages).select(F.col(id_col).alias("page_id"), text_of(html_col).alias("html"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [render(h) for h in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(texts, pa.string())], names=["page_id", "n_chars", "text"])

    return rows.mapInArrow(run, f"page_id {dict(rows.dtypes)['page_id']}, n_chars long, text string")


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
