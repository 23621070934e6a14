"""Layout-aware rendering of HTML pages to text.

A tokeniser feeds a tree builder that opens and closes implied tags; the renderer walks the
finished tree, leaves out what a browser would not show, and lays out the rest: blocks with the
spacing of their kind, list items with markers, preformatted text as it is, table cells padded
to columns. Pages are independent, so Spark deals rows and each task renders its own.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tramlag.llm.common import extended, free, slices

TEXT_BYTES = 4 << 20

# Fixed values of the HTML standard: kinds of elements.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = set(
    "head script style template noscript title meta link base iframe noembed noframes object embed param source track "
    "area datalist svg math canvas audio video select rp".split()
)
BLOCK = set(
    "html body address article aside blockquote center dd details dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol optgroup option p pre search section summary table "
    "ul caption thead tbody tfoot tr".split()
)
#: Blocks that a blank line parts from their neighbours.
SPACED = set("p h1 h2 h3 h4 h5 h6 ul ol menu dir dl pre table blockquote figure article section fieldset hr".split())
#: An opening tag closes the first of these on the stack, unless a scope stands between.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "optgroup": {"option", "optgroup"},
    "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "rt": {"rt", "rp"}, "rp": {"rt", "rp"},
    "thead": {"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"},
    "tbody": {"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"},
    "tfoot": {"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"},
}
CLOSES_P = BLOCK - {"html", "body", "caption", "thead", "tbody", "tfoot", "tr", "option", "optgroup", "legend"}
SCOPES = {
    "li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select", "datalist"},
    "optgroup": {"select"}, "rt": {"ruby"}, "rp": {"ruby"},
} | dict.fromkeys(["tr", "td", "th", "thead", "tbody", "tfoot"], {"table"})
#: No end tag and no implied end reaches beyond these, but their own.
WALLS = {"table", "td", "th", "caption", "html", "body", "template", "button", "object"}
#: Lists and quotations within one another that indent their lines; browsers nest no deeper.
INDENTS = 512

#: Cells are padded to the width of their column as far as this place in a line, and lines wider than
#: that of a column do not widen it. Beyond, two blanks part cells, so that a page cannot blow up.
PADDED, WIDEST = 400, 120

ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPACE = re.compile(r"[ \t\n\f\r]+")
NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\s*(?:!important\s*)?(?:;|$)", re.I)
VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(hidden|collapse|visible)\s*(?:!important\s*)?(?=;|$)", re.I)
#: A tag without `<` in it. No part gives back what it has taken, so a failure costs no more than the way to the next `<`.
PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>\"'<]*+)(?=[\s/>])((?:[^>\"'<]++|\"[^\"<]*+\"|'[^'<]*+')*+)>")
NAME_END, TAG_MARK = re.compile(r"[\s/>]"), re.compile(r"[>\"']")


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes = tag, attributes
        self.children: list[Node | str] = []


def attributes_of(raw: str) -> dict[str, str]:
    found = {}
    for name, a, b, c in ATTRIBUTE.findall(raw):
        found.setdefault(name.lower(), html.unescape(a or b or c))
    return found


class Scanner:
    """Finds the tags of a page from left to right, in time linear in its length.

    Where a tag cannot end, since a quotation in it never does, the places that were passed are
    kept, and a later tag that comes to one of them is given up at once.
    """

    def __init__(self, page: str):
        self.page = page
        self.failed: set[int] = set()  # marks outside quotations from which no tag ends
        self.known: dict[object, tuple[int, int]] = {}  # what was sought -> (from, found), the last time

    def seek(self, what: str | re.Pattern, at: int) -> int:
        """Next place of a string or pattern, the length of the page if there is none."""
        begin, found = self.known.get(what, (0, -1))
        if not begin <= at <= found:
            if isinstance(what, str):
                found = self.page.find(what, at)
            else:
                found = hit.start() if (hit := what.search(self.page, at)) else -1
            found = len(self.page) if found < 0 else found
            self.known[what] = at, found
        return found

    def end_of_tag(self, at: int) -> int:
        """Place of the `>` that ends a tag, from a place behind its name; -1 if none does."""
        passed = []
        while True:
            mark = self.seek(TAG_MARK, at)
            if mark >= len(self.page) or mark in self.failed:
                break
            if self.page[mark] == ">":
                return mark
            passed.append(mark)
            closing = self.page.find(self.page[mark], mark + 1)
            if closing < 0:
                break
            at = closing + 1
        self.failed.update(passed)
        return -1

    def next(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """(begin, end, whether it closes, name, attributes) of the next tag; comments and declarations have no name."""
        page, size = self.page, len(self.page)
        while (at := page.find("<", at)) >= 0:
            if plain := PLAIN_TAG.match(page, at):
                return at, plain.end(), plain[1] == "/", plain[2].lower(), plain[3]
            follows = page[at + 1 : at + 2]
            if page.startswith("<!--", at):
                ends = (self.seek("-->", at + 4) + 3, self.seek("--!>", at + 4) + 4)
                return at, min(*ends, size), False, "", ""
            name = at + 1 + (follows == "/")
            if "a" <= page[name : name + 1].lower() <= "z" and page[name].isascii():
                behind = self.seek(NAME_END, name)
                end = self.end_of_tag(behind) if behind < size else -1
                if end >= 0:
                    return at, end + 1, follows == "/", page[name:behind].lower(), page[behind:end]
            if follows and follows in "!?/" and (end := self.seek(">", at + 2)) < size:
                return at, end + 1, False, "", ""
            at += 1
        return None


def parse(page: str) -> Node:
    """Tree of a page; whatever the input, there is one."""
    root = Node("html", {})
    stack = [root]
    places: dict[str, list[int]] = {}  # tag -> where it stands on the stack, so that deep pages need no search

    def last(tags: set[str]) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    def pop() -> None:
        places[stack.pop().tag].pop()

    def close(tags: set[str], walls: set[str]) -> None:
        place = last(tags)
        if place and place >= last(walls):
            while len(stack) > place:
                pop()

    def open_(tag: str, raw: str) -> None:
        if tag == "html" or tag == "body" and places.get(tag):
            return
        if tag in CLOSES_P:
            close({"p"}, WALLS)
        if tag in CLOSES:
            for _ in range(4):  # a cell, its row and their section may all end here
                size = len(stack)
                close(CLOSES[tag], SCOPES[tag])
                if len(stack) == size:
                    break
        if tag == "body" or (stack[-1].tag == "head" and tag not in HIDDEN):
            close({"head"}, set())
        if tag in ("td", "th") and stack[-1].tag in ("table", "thead", "tbody", "tfoot"):
            open_("tr", "")
        if tag == "a":
            close({"a"}, WALLS | BLOCK)
        node = Node(tag, attributes_of(raw) if raw and not raw.isspace() else {})
        stack[-1].children.append(node)
        if tag not in VOID:
            places.setdefault(tag, []).append(len(stack))
            stack.append(node)

    at, lower, scanner = 0, None, Scanner(page)
    while found := scanner.next(at):
        begin, end, closes, tag, raw = found
        if begin > at:
            stack[-1].children.append(html.unescape(page[at:begin]))
        at = end
        if not tag:
            continue
        if not closes:
            open_(tag, raw)
            if tag in RAW:
                lower = page.lower() if lower is None and len(page) == len(page.lower()) else lower
                end = (lower if lower is not None else page).find(f"</{tag}", at)
                end = len(page) if end < 0 else end
                stack[-1].children.append(page[at:end] if tag not in ("title", "textarea") else html.unescape(page[at:end]))
                at = end
        elif tag == "p" and not places.get("p"):
            open_("p", "")
            pop()
        elif tag == "br":
            stack[-1].children.append(Node("br", {}))
        elif tag in ("html", "body"):
            continue
        elif tag[0] == "h" and tag[1:] in set("123456"):
            close({f"h{i}" for i in range(1, 7)}, WALLS)
        else:
            close({tag}, (WALLS if tag not in ("table", "thead", "tbody", "tfoot", "tr") else {"table"}) - {tag})
    if at < len(page):
        rest = page[at:]
        cut = re.search(r"<[a-zA-Z/!?]", rest)  # a tag that never ends is dropped
        stack[-1].children.append(html.unescape(rest[: cut.start()] if cut else rest))
    return root


def displayed(node: Node) -> bool:
    """Whether a node has a place on the page, visible or not."""
    a = node.attributes
    if node.tag in HIDDEN or "hidden" in a and a["hidden"].lower() != "until-found":
        return False
    if node.tag == "dialog" and "open" not in a:
        return False
    if node.tag == "input" or a.get("aria-hidden", "").strip().lower() == "true" and not node.children:
        return False
    return not ("style" in a and NO_DISPLAY.search(a["style"]))


def visibility(node: Node) -> str:
    """What a node's style says of its visibility, the last word counting; empty if nothing."""
    found = VISIBILITY.findall(node.attributes.get("style", ""))
    return found[-1].lower() if found else ""


def shown(node: Node) -> bool:
    return displayed(node) and visibility(node) not in ("hidden", "collapse")


def revealed(node: Node) -> list[Node]:
    """Parts of an invisible node that are made visible again."""
    found, left = [], [node]
    while left:
        inner = left.pop()
        for child in reversed(inner.children):
            if not isinstance(child, str) and displayed(child):
                left.append(child)
        if inner is not node and visibility(inner) == "visible":
            found.append(inner)
            del left[len(left) - sum(not isinstance(c, str) and displayed(c) for c in inner.children) :]
    return found


def width(text: str) -> int:
    """Columns that a text takes in a fixed-width font."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class Canvas:
    """Lines of a block. Blank lines asked for before and after blocks collapse to the largest."""

    def __init__(self, level: int = 0) -> None:
        self.level = level  # lists and quotations around it
        self.lines: list[str] = []
        self.words: list[str] = []
        self.glue = False  # the next text joins the last word without a blank
        self.blank = 0

    def text(self, raw: str) -> None:
        parts = [p for p in SPACE.split(raw) if p]
        if not parts:
            self.glue = self.glue and not raw
            return
        if self.glue and self.words and raw[0] not in " \t\n\f\r":
            self.words[-1] += parts[0]
            parts = parts[1:]
        self.words += parts
        self.glue = raw[-1] not in " \t\n\f\r"

    def flush(self) -> None:
        if self.words:
            self.put(" ".join(self.words).replace("\xa0", " "))
        self.words, self.glue = [], False

    def put(self, line: str) -> None:
        if self.blank and self.lines:
            self.lines += [""] * self.blank
        self.blank = 0
        self.lines.append(line)

    def space(self, lines: int) -> None:
        self.flush()
        self.blank = max(self.blank, lines)


#: A step of rendering yields the steps within it, so that depth is bounded by no call stack.
Steps = Iterator["Steps"]


def done(steps: Steps) -> None:
    stack = [steps]
    while stack:
        inner = next(stack[-1], None)
        if inner is None:
            stack.pop()
        else:
            stack.append(inner)


def render(node: Node, canvas: Canvas, nested: int = 0) -> Steps:
    for child in node.children:
        if isinstance(child, str):
            canvas.text(child)
            continue
        tag = child.tag
        if not shown(child):
            if displayed(child):
                for part in revealed(child):
                    yield render_inline(part, canvas, nested)
            continue
        if tag == "br":
            if not canvas.words:
                canvas.put("")
            canvas.flush()
        elif tag == "img":
            canvas.text(child.attributes.get("alt", ""))
        elif tag == "hr":
            canvas.space(1)
            canvas.put("---")
            canvas.space(1)
        elif tag == "q":
            canvas.text('"')
            canvas.glue = True
            yield render(child, canvas, nested)
            canvas.glue = True
            canvas.text('"')
        elif tag in BLOCK or tag in ("td", "th"):
            yield block(child, canvas, nested)
        else:
            yield render(child, canvas, nested)


def block(node: Node, canvas: Canvas, nested: int) -> Steps:
    tag = node.tag
    space = 1 if tag in SPACED and not (nested and tag in ("ul", "ol", "menu", "dir")) else 0
    canvas.space(space)
    if tag == "pre":
        text = "".join(pieces(node)).replace("\r\n", "\n")
        for line in text.removeprefix("\n").rstrip("\n").split("\n") if text.strip() else []:
            canvas.put(line.rstrip())
    elif tag in ("ul", "ol", "menu", "dir"):
        yield listed(node, canvas, nested)
    elif tag == "table":
        yield table(node, canvas)
    elif tag in ("blockquote", "dd") and canvas.level < INDENTS:
        inner = Canvas(canvas.level + 1)
        yield render(node, inner, nested)
        inner.flush()
        for line in inner.lines:
            canvas.put(f"  {line}" if line else line)
    else:
        yield render(node, canvas, nested)
    canvas.space(space)


def pieces(node: Node) -> Iterator[str]:
    left = node.children[::-1]
    while left:
        child = left.pop()
        if isinstance(child, str):
            yield child
        elif child.tag == "br":
            yield "\n"
        elif shown(child):
            left += child.children[::-1]


def listed(node: Node, canvas: Canvas, nested: int) -> Steps:
    ordered = node.tag == "ol"
    start = node.attributes.get("start", "")
    number = int(start) if ordered and re.fullmatch(r"-?\d{1,9}", start) else 1
    for child in node.children:
        if isinstance(child, str) or child.tag != "li":
            rest = Node("div", {})
            rest.children = [child]
            yield render(rest, canvas, nested)
            continue
        if not shown(child):
            continue
        canvas.flush()
        value = child.attributes.get("value", "")
        number = int(value) if ordered and re.fullmatch(r"-?\d{1,9}", value) else number
        marker = f"{number}. " if ordered else "- "
        if canvas.level >= INDENTS:
            canvas.text(marker)
            yield render(child, canvas, nested + 1)
            canvas.flush()
            number += 1
            continue
        inner = Canvas(canvas.level + 1)
        yield render(child, inner, nested + 1)
        inner.flush()
        lines = inner.lines or [""]
        canvas.put((marker + lines[0]).rstrip())
        for line in lines[1:]:
            canvas.put(" " * len(marker) + line if line else line)
        number += 1
    canvas.flush()


def rows_of(node: Node) -> Iterator[Node]:
    for child in node.children:
        if not isinstance(child, str) and shown(child):
            if child.tag == "tr":
                yield child
            elif child.tag in ("thead", "tbody", "tfoot"):
                yield from rows_of(child)


def strays(node: Node) -> Iterator[Node | str]:
    """Children of a table, its sections and rows that are neither these nor cells."""
    for child in node.children:
        if isinstance(child, str):
            yield child
        elif child.tag in ("thead", "tbody", "tfoot", "tr"):
            if shown(child):
                yield from strays(child)
        elif child.tag not in ("td", "th", "colgroup", "col"):
            yield child


def table(node: Node, canvas: Canvas) -> Steps:
    """Rows with cells padded to their columns, within PADDED and WIDEST; a cell that spans columns or
    rows keeps its place."""
    grid: list[dict[int, list[str]]] = []
    held: dict[int, int] = {}  # column -> rows that a cell from above still covers
    for other in strays(node):  # what has no place in a table stands before it
        if isinstance(other, str):
            canvas.text(other)
        else:
            yield render_alone(other, canvas)
    canvas.flush()
    spans: list[tuple[int, int, int]] = []
    for row in rows_of(node):
        cells: dict[int, list[str]] = {}
        column = 0
        for cell in row.children:
            if isinstance(cell, str) or cell.tag not in ("td", "th") or not shown(cell):
                continue
            while held.get(column, 0) > 0:
                column += 1
            inner = Canvas(canvas.level)
            yield render(cell, inner)
            inner.flush()
            wide, deep = span(cell, "colspan", 1000), span(cell, "rowspan", 65_534)
            cells[column] = [line for line in inner.lines if line] or [""]
            spans.append((len(grid), column, wide))
            for k in range(column, column + wide):
                held[k] = max(held.get(k, 0), deep)
            column += wide
        for k in list(held):
            held[k] -= 1
            if held[k] <= 0:
                del held[k]
        grid.append(cells)
    single = {(r, c) for r, c, wide in spans if wide == 1}
    widths: dict[int, int] = {}
    for r, cells in enumerate(grid):
        for c, lines in cells.items():
            if (r, c) in single:
                widths[c] = max(widths.get(c, 0), *(w for w in map(width, lines) if w <= WIDEST), 0)
    order = sorted({c for cells in grid for c in cells} | set(widths))
    offset, at = {}, 0
    for c in order:
        offset[c] = at
        at += widths.get(c, 0) + (2 if widths.get(c, 0) else 0)
    for cells in grid:
        for k in range(max(map(len, cells.values()), default=0)):
            line = ""
            for c in sorted(cells):
                if k < len(cells[c]) and cells[c][k]:
                    gap = min(offset[c], PADDED) - width(line)
                    line += " " * max(gap, 2 if line else gap) + cells[c][k]
            canvas.put(line.rstrip())


def render_inline(node: Node, canvas: Canvas, nested: int) -> Steps:
    holder = Node("span", {})
    holder.children = [node]
    yield render(holder, canvas, nested)


def render_alone(node: Node, canvas: Canvas) -> Steps:
    holder = Node("div", {})
    holder.children = [node]
    yield render(holder, canvas)
    canvas.flush()


def span(cell: Node, name: str, most: int) -> int:
    """How many columns or rows a cell covers, within the standard's limits; 0 rows are all that follow."""
    value = cell.attributes.get(name, "1").strip()
    if not re.fullmatch(r"[0-9]{1,9}", value):
        return 1
    number = min(most, int(value))
    return number or (1 if name == "colspan" else most)


def text_of(page: str | None) -> str | None:
    """Visible text of a page; null for null."""
    if page is None:
        return None
    canvas = Canvas()
    done(render(parse(page.replace("\x00", "�")), canvas))
    canvas.flush()
    return "\n".join(canvas.lines).strip("\n")


def extract(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """All rows and columns of `pages` and a last column _text, the page's visible text; the name
    gets underscores behind it should `pages` have such a column.

    Null html gives null, empty html and pages without visible text an empty text. Broken markup
    is repaired as said above and never fails a row; a tag that never ends is dropped. Rows are
    independent: ids may be null or repeat. An empty table gives an empty result.
    """
    own, name = pages.columns, free(pages, "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, html_column, TEXT_BYTES):
            texts = [text_of(x) for x in part.column(html_column).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*own, name])

    return pages.mapInArrow(run, extended(pages, **{name: "string"}))
