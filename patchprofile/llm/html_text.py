"""Layout-aware text of HTML: a tree with implied tags, visibility rules, and a renderer that keeps
block spacing, list markers and aligned table cells. All visible text comes out, menus included.

Tags are found in one pass forward: what has been looked at is never looked at again, so a page of unfinished tags, quotes or
comments costs no more than another of its size.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache
from html import unescape
from html.entities import html5

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style title template noscript meta link base datalist object iframe audio video canvas noembed noframes".split())
PARAGRAPH = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure hr fieldset".split())
BLOCK = PARAGRAPH | frozenset("html body div section article aside header footer nav main address form li dt dd tr caption figcaption legend details summary center menu dir option thead tbody tfoot".split())
#: An opening tag closes these open elements, up to the barrier that bounds the search.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
}
CLOSES["tbody"] = CLOSES["tfoot"] = CLOSES["thead"]
_ENDS_P = BLOCK - {"html", "body", "tr", "caption", "thead", "tbody", "tfoot", "option", "legend", "summary"}
_SCOPE = frozenset("table td th caption html body button object template".split())
#: Elements nested deeper hang on the same parent: their text stays, the tree stays shallow.
DEEPEST = 200
#: List items and table cells inside this many others are written without indentation or alignment.
DEEPEST_BOX = 24
#: A column is padded to at most this width, and a cell moved right by at most twice it; wider cells stand whole.
WIDEST = 200
#: Fixed value: the largest colspan of the HTML standard.
MOST_COLUMNS = 1000

#: A whole tag, no part of which is tried twice: the name, then attributes whose quoted values may hold anything.
_TAG = re.compile(r"<(/?+)([A-Za-z][^\s/>]*+)((?:[\s/]++|[^\s/>=][^\s/>=]*+(?:\s*+=(?:\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+))?+)?+|=)*+)>")
_COMMENT_END = re.compile(r"--!?>")
_ATTR = re.compile(r"([^\s=/>][^\s=/>]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>\"'][^\s>]*+)))?+")
_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*([a-z]+)", re.I)
_BLANK = re.compile(r"[ \t\n\r\f]+")


@dataclass
class Node:
    tag: str
    attrs: dict[str, str] = field(default_factory=dict)
    kids: list = field(default_factory=list)


def _attrs(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTR.finditer(text):
        out.setdefault(m[1].lower(), _value(m[2] if m[2] is not None else m[3] if m[3] is not None else m[4] or ""))
    return out


_ENTITY = re.compile(r"&(?:#(?:[xX][0-9A-Fa-f]++|[0-9]++);?|([A-Za-z][A-Za-z0-9]*+)(;?)(=?))")


def _value(s: str) -> str:
    """An attribute's value: a named entity without its semicolon stands for itself before a letter, a digit or ``=`` (so in addresses)."""
    if "&" not in s:
        return s
    return _ENTITY.sub(lambda m: unescape(m[0]) if m[1] is None or m[2] else m[0] if m[3] or m[1] not in html5 else unescape(m[0]), s)


def build(html: str) -> Node:
    """The tree of a page. Missing end tags are implied, stray end tags ignored; a tag cut off by the end of the page is dropped."""
    root = Node("html")
    stack = [root]
    opened: Counter[str] = Counter()  # names on the stack above the root
    at, n = 0, len(html)

    def text(s: str) -> None:
        if s:
            stack[-1].kids.append(unescape(s))

    def push(node: Node) -> None:
        stack.append(node)
        opened[node.tag] += 1

    def cut(i: int) -> None:
        for x in stack[i:]:
            opened[x.tag] -= 1
        del stack[i:]

    def close(names: set[str] | frozenset[str], barrier: set[str] | frozenset[str]) -> None:
        if not any(opened[x] for x in names):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in names:
                cut(i)
                return
            if stack[i].tag in barrier:
                return

    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            text(html[at:])
            break
        text(html[at:lt])
        following = html[lt + 1 : lt + 3]
        if following[:1] in ("!", "?") or (following[:1] == "/" and following[1:] and not _is_letter(following[1])):
            end = _comment(html, lt)
            if end < 0:
                break
            at = end
            continue
        if not (_is_letter(following[:1]) or (following[:1] == "/" and _is_letter(following[1:]))):
            text("<")
            at = lt + 1
            continue
        m = _TAG.match(html, lt)
        if not m:
            break  # no tag ends from here on
        at = m.end()
        tag = m[2].lower()
        if m[1]:
            if tag == "br":
                stack[-1].kids.append(Node("br"))
            elif tag == "p" and not opened["p"]:
                stack[-1].kids.append(Node("p"))
            elif tag not in ("html", "body"):
                limit = {"li": {"ul", "ol", "menu", "dir"}, "p": _SCOPE}.get(tag, {"table", "td", "th"} - {tag} if tag not in ("tr", "thead", "tbody", "tfoot", "table") else ({"table"} - {tag}))
                close({tag}, limit)
            continue
        if tag == "html" or (tag == "body" and opened["body"]):
            continue
        if tag not in UNSEEN and len(stack) > 1 and stack[1].tag == "head":
            cut(1)  # anything visible ends the head
        if tag in _ENDS_P:
            close({"p"}, _SCOPE)
        if tag in CLOSES:
            names, barrier = CLOSES[tag]
            while any(opened[x] for x in names) and any(x.tag in names for x in _above(stack, barrier)):
                close(names, barrier)
        if tag in _HEADINGS and stack[-1].tag in _HEADINGS:
            cut(len(stack) - 1)
        if tag in ("td", "th") and stack[-1].tag in ("table", "thead", "tbody", "tfoot"):
            stack[-1].kids.append(row := Node("tr"))
            push(row)
        node = Node(tag, _attrs(m[3]))
        stack[-1].kids.append(node)
        if tag in RAW:
            end = _raw_end(tag).search(html, at)
            body = html[at : end.start()] if end else html[at:]
            node.kids.append(unescape(body) if tag in ("title", "textarea") else body)
            close_at = html.find(">", end.end()) if end else -1
            at = close_at + 1 if close_at >= 0 else n
        elif tag not in VOID and len(stack) < DEEPEST:
            push(node)
    return root


_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


def _is_letter(c: str) -> bool:
    return c.isascii() and c.isalpha()


@cache
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}(?=[\s/>])", re.I)


def _comment(html: str, lt: int) -> int:
    """Where a comment or declaration that begins at ``lt`` ends; -1 if it does not."""
    if html.startswith("<!--", lt):
        if html.startswith(">", lt + 4):
            return lt + 5
        if html.startswith("->", lt + 4):
            return lt + 6
        m = _COMMENT_END.search(html, lt + 4)
        return m.end() if m else -1
    return html.find(">", lt) + 1 or -1


def tags(html: str) -> Iterator[tuple[str, str]]:
    """Name and attributes of every opening tag that stands outside of comments, scripts and other raw text."""
    at = 0
    while (lt := html.find("<", at)) >= 0:
        if (m := _TAG.match(html, lt)) is not None:
            at = m.end()
            tag = m[2].lower()
            if not m[1]:
                yield tag, m[3]
                if tag in RAW:
                    end = _raw_end(tag).search(html, at)
                    if not end:
                        return
                    at = end.end()
        elif html[lt + 1 : lt + 2] in ("!", "?"):
            at = _comment(html, lt)
            if at < 0:
                return
        elif _is_letter(html[lt + 1 : lt + 2]):
            return  # no tag ends from here on
        else:
            at = lt + 1


_REFRESH = re.compile(r"\s*+[\d.]++\s*+[;,]?\s*+(?:url\s*+=\s*+)?(?:\"([^\"]*+)\"?|'([^']*+)'?|(.*))", re.I | re.S)


def page_links(html: str) -> list[tuple[str | None, str]]:
    """(the page's base, target) of every canonical link and refresh redirect, as they are written, entities decoded."""
    base, out = None, []
    for tag, attrs in tags(html):
        if tag not in ("link", "meta", "base"):
            continue
        a = _attrs(attrs)
        if tag == "base":
            base = a["href"].strip() if base is None and "href" in a else base
        elif tag == "link":
            if "canonical" in a.get("rel", "").lower().split() and "href" in a:
                out.append(a["href"].strip())
        elif a.get("http-equiv", "").strip().lower() == "refresh":
            m = _REFRESH.match(a.get("content", ""))
            target = next((x for x in m.groups() if x is not None), "").strip() if m else ""
            if target:
                out.append(target)
    return [(base, x) for x in out]


def _above(stack: list[Node], barrier: set[str]) -> Iterator[Node]:
    for x in reversed(stack[1:]):
        if x.tag in barrier:
            return
        yield x


def seen(node: Node) -> bool:
    """Whether an element is laid out at all (``visibility`` only keeps its own text back)."""
    if node.tag in UNSEEN or "hidden" in node.attrs:
        return False
    if node.tag == "input" and node.attrs.get("type", "").lower() == "hidden":
        return False
    return not _DISPLAY.search(node.attrs.get("style", ""))


def _dark(node: Node, dark: bool) -> bool:
    """Whether an element's own text is kept back: its ``visibility``, else its parent's."""
    m = _VISIBILITY.search(node.attrs.get("style", ""))
    value = m[1].lower() if m else ""
    return True if value in ("hidden", "collapse") else False if value in ("visible", "initial") else dark


def _width(s: str) -> int:
    return sum(2 if unicodedata.east_asian_width(c) in "WF" else 0 if unicodedata.combining(c) else 1 for c in s)


class _Out:
    """Lines of text; ``gap`` is the number of line ends owed before the next text, ``now`` the parts of the line being written."""

    def __init__(self) -> None:
        self.done: list[str] = []
        self.now: list[str] = []
        self.gap = 0
        self.space = False

    def text(self, s: str) -> None:
        folded = _BLANK.sub(" ", s)
        body = folded.strip(" ")
        if not body:
            self.space = self.space or bool(folded)
            return
        self.owe()
        if self.now and (self.space or folded[0] == " "):
            self.now.append(" ")
        self.now.append(body)
        self.space = folded[-1] == " "

    def line(self) -> None:
        self.done.append("".join(self.now))
        self.now = []

    def owe(self) -> None:
        if self.gap:
            if self.done or self.now:
                for _ in range(self.gap):
                    self.line()
            self.space = False
        self.gap = 0

    def block(self, n: int) -> None:
        self.gap = max(self.gap, n)

    def raw(self, s: str) -> None:
        self.owe()
        first, *rest = s.split("\n")
        if first:
            self.now.append(first)
        for x in rest:
            self.line()
            if x:
                self.now.append(x)
        self.space = False

    def all(self) -> list[str]:
        return [*self.done, "".join(self.now)]


def _render(node: Node, out: _Out, pre: bool = False, depth: int = 0, dark: bool = False, box: int = 0) -> None:
    """``dark``: the element's own text is kept back (``visibility: hidden``); a child may show again. ``box``: list items and cells around it."""
    count = _number(node.attrs.get("start"), 1) - 1
    for at, kid in enumerate(node.kids):
        if isinstance(kid, str):
            if dark:
                continue
            if pre:
                # the line end right after <pre> is not part of it
                out.raw(kid[1:] if at == 0 and node.tag == "pre" and kid.startswith("\n") else kid)
            else:
                out.text(kid)
            continue
        if not seen(kid):
            continue
        tag, hides = kid.tag, _dark(kid, dark)
        if tag == "br":
            out.owe()
            out.line()
            out.space = False
        elif tag == "img":
            out.text("" if hides else kid.attrs.get("alt", ""))
        elif tag == "input":
            if not hides and kid.attrs.get("type", "text").lower() in ("submit", "button", "reset", "text", "search", "email", "url", "tel", "number"):
                out.text(kid.attrs.get("value", ""))
        elif tag == "select":
            for shown in () if hides else _chosen(kid):
                out.text(" " + " ".join(_lines(shown, box=DEEPEST_BOX)) + " ")
        elif tag == "svg":
            for label in _found(kid, "text"):
                out.text(" " + "".join(_strings(label, _dark(label, hides))) + " ")
        elif tag == "math":
            out.text("".join(_strings(kid, hides)))
        elif tag == "table" and box < DEEPEST_BOX:
            out.block(2)
            for k, line in enumerate(_table(kid, hides, box)):
                out.block(1 if k else 2)
                out.raw(line)
            out.block(2)
        elif tag == "li":
            out.block(1)
            count = _number(kid.attrs.get("value"), count + 1)
            mark = f"{count}. " if node.tag == "ol" else "- "
            if box >= DEEPEST_BOX:
                if not hides:
                    out.raw(mark)
                _render(kid, out, pre, depth + 1, hides, box)
                out.block(1)
                continue
            body = _lines(kid, depth + 1, hides, box + 1)
            if body or not hides:
                pad = " " * len(mark)
                out.raw("\n".join((mark if not i else pad if x else "") + x for i, x in enumerate(body)).rstrip() if body else mark.rstrip())
            out.block(1)
        else:
            nested = tag in ("ul", "ol") and depth > 0
            gap = 1 if nested else 2 if tag in PARAGRAPH else 1 if tag in BLOCK else 0
            out.block(gap)
            _render(kid, out, pre or tag == "pre", depth + (tag in ("ul", "ol")), hides, box)
            out.block(gap)


def _number(s: str | None, other: int) -> int:
    return int(s) if s is not None and re.fullmatch(r"\s*-?\d{1,9}\s*", s) else other


def _found(node: Node, tag: str) -> Iterator[Node]:
    """The outermost elements of one name below ``node`` that are laid out."""
    for kid in node.kids:
        if isinstance(kid, Node) and seen(kid):
            if kid.tag == tag:
                yield kid
            else:
                yield from _found(kid, tag)


def _strings(node: Node, dark: bool) -> Iterator[str]:
    """All text of an element whose children stand in one line; annotations of formulas are no part of what is shown."""
    for kid in node.kids:
        if isinstance(kid, str):
            if not dark:
                yield kid
        elif seen(kid) and kid.tag not in ("annotation", "annotation-xml", "desc"):
            yield from _strings(kid, _dark(kid, dark))


def _chosen(select: Node) -> list[Node]:
    """The options that a select shows: all of a list box, else the last selected one, else the first."""
    options = list(_found(select, "option"))
    if "multiple" in select.attrs or _number(select.attrs.get("size"), 1) > 1:
        return options
    picked = [x for x in options if "selected" in x.attrs]
    return picked[-1:] or options[:1]


def _lines(node: Node, depth: int = 0, dark: bool = False, box: int = 0) -> list[str]:
    out = _Out()
    _render(node, out, node.tag == "pre", depth, dark, box)
    lines = [x.rstrip(" ") for x in out.all()]
    while lines and not lines[-1]:
        lines.pop()
    first = next((i for i, x in enumerate(lines) if x), len(lines))
    return lines[first:]


@dataclass
class _Cell:
    lines: list[str]
    column: int
    span: int = 1


def _table(table: Node, dark: bool = False, box: int = 0) -> list[str]:
    """Rows of a table, each cell moved to the start of its column; cells of several lines stand beside each other.

    ``colspan`` and ``rowspan`` keep the columns behind and below them free.
    """
    caption: list[str] = []
    rows: list[list[_Cell]] = []
    until: dict[int, int] = {}  # column -> the last row that a cell above reaches into (of the first MOST_COLUMNS columns)
    row_no = solid = solid_until = 0  # the first ``solid`` columns are taken up to row ``solid_until``

    def add(cells: list[tuple[list[str], int, int]]) -> None:
        nonlocal row_no, solid, solid_until
        row_no += 1
        if row_no > solid_until:
            solid, solid_until = 0, row_no + 65_534
        row, column = [], solid
        for lines, across, down in cells:
            while until.get(column, 0) >= row_no:
                column += 1
            row.append(_Cell(lines, column, across))
            if down > 1:
                until.update(dict.fromkeys(range(column, min(column + across, MOST_COLUMNS)), row_no + down - 1))
            column += across
        while until.get(solid, 0) > row_no:
            solid_until = min(solid_until, until[solid])
            solid += 1
        if any(any(c.lines) for c in row):
            rows.append(row)

    def group() -> None:
        """A cell never reaches out of its row group."""
        nonlocal solid, solid_until
        until.clear()
        solid = solid_until = 0

    def alone(lines: list[str]) -> None:
        if any(lines):
            rows.append([_Cell(lines, 0, MOST_COLUMNS)])

    def walk(node: Node, dark: bool) -> None:
        for kid in node.kids:
            if isinstance(kid, str):
                if kid.strip() and not dark:  # text that stands outside of any cell
                    alone([_BLANK.sub(" ", kid).strip()])
                continue
            if not seen(kid):
                continue
            hides = _dark(kid, dark)
            if kid.tag == "caption":
                caption.extend(_lines(kid, 0, hides, box + 1))
            elif kid.tag == "tr":
                cells = []
                for x in kid.kids:
                    if isinstance(x, str):
                        if x.strip() and not hides:
                            cells.append(([_BLANK.sub(" ", x).strip()], 1, 1))
                    elif seen(x):
                        across = min(max(_number(x.attrs.get("colspan"), 1), 1), MOST_COLUMNS)
                        down = min(_number(x.attrs.get("rowspan"), 1), 65_534)
                        cells.append((_lines(x, 0, _dark(x, hides), box + 1) or [""], across, down if down > 0 else 65_534))
                add(cells)
            elif kid.tag in ("thead", "tbody", "tfoot"):
                group()
                walk(kid, hides)
                group()
            elif kid.tag not in ("col", "colgroup"):
                alone(_lines(kid, 0, hides, box + 1))

    walk(table, dark)
    starts = sorted({c.column for r in rows for c in r})
    wide = dict.fromkeys(starts, 0)
    for r in rows:
        for c in r[:-1]:
            if c.span == 1:
                wide[c.column] = max(wide[c.column], *(min(_width(x), WIDEST) for x in c.lines))
    place, at = {}, 0
    for column in starts:
        place[column] = at
        at += wide[column] + 3
    out = list(caption)
    for r in rows:
        for i in range(max(len(c.lines) for c in r)):
            parts, end = [], 0
            for k, c in enumerate(r):
                text = c.lines[i] if i < len(c.lines) else ""
                if k or place[c.column]:
                    parts.append(" " * min(max(place[c.column] - 3 - end, 0), 2 * WIDEST) + " | ")
                    end = max(end, min(place[c.column] - 3, end + 2 * WIDEST)) + 3
                parts.append(text)
                end += _width(text)
            out.append("".join(parts).rstrip())
    return out


def text_of(html: str | None) -> str:
    """The visible text. Null or empty: empty. More than one blank line in a row becomes one."""
    if not html:
        return ""
    out: list[str] = []
    for line in _lines(build(html)):
        if line or (out and out[-1]):
            out.append(line)
    return "\n".join(out)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, text, n_chars, n_lines`` for every row of ``pages`` (``page_id, html``); null html gives an empty text.

    Whole pages, map-only; repeated rows and other columns don't matter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 500):
                b = big.slice(at, 500)
                got = [text_of(x.as_py()) for x in b.column("html")]
                yield pa.RecordBatch.from_arrays([b.column("page_id"), pa.array(got, pa.string()), pa.array([len(t) for t in got], pa.int64()),
                                                  pa.array([t.count("\n") + 1 if t else 0 for t in got], pa.int64())], names=["page_id", "text", "n_chars", "n_lines"])

    return pages.select(F.col("page_id").cast("long"), "html").mapInArrow(run, "page_id bigint, text string, n_chars bigint, n_lines bigint")
