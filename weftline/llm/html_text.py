"""HTML to visible text with its layout (operator 10).

A tree builder reads tags with implied ends (a block ends a paragraph, an item an
item, a cell a cell, what can't stand in it the head) and tolerates whatever isn't closed. The renderer walks the
tree without recursion and leaves out what isn't shown: head, scripts, styles,
templates, comments, `hidden`, `display:none`, `visibility:hidden` (but what is
visible again within it is shown), what stands in for frames, noscript, media and canvas, data lists, and in drawings all but
the text elements. Text in attributes isn't read, nor are the rules of style
sheets, those in the page's own `<style>` included. Text areas and options stand on
lines of their own. Blocks stand
on lines of their own, paragraphs and headings with an empty line between, list
items with markers and indents, the lines of table cells below each other and
padded to the width of their column (in a table of over PADDED characters then,
to NARROW at most).
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.common import read_table

# Fixed values of the HTML language: elements by how they are read and shown.
#: Numbers of lists have 32 bits, as browsers read them; others count as not given.
WHOLE = (-(1 << 31), (1 << 31) - 1)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
UNSEEN = frozenset("head script style template title noscript iframe noembed noframes object audio video canvas datalist".split())
#: Within svg, text shows in SVG_TEXT alone, and none of it in SVG_UNSEEN.
SVG_TEXT = frozenset("text foreignobject".split())
SVG_UNSEEN = frozenset("defs desc metadata symbol clippath mask pattern marker".split())
#: Not blocks, but on lines of their own; within PLAIN white space stands as written.
BOXES = frozenset("textarea option text".split())
PLAIN = frozenset("pre textarea".split())
BLOCK = frozenset("html body address article aside blockquote center details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section summary table ul caption tr td th thead tbody tfoot".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre table ul ol dl".split())
CLOSES_P = BLOCK - frozenset("html body td th tr thead tbody tfoot caption li dd dt".split())
#: A start tag ends these open elements, looking no further up than the scope.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "tr": (("tr",), ("table",)), "tbody": (("thead", "tbody", "tfoot"), ("table",)), "thead": (("thead", "tbody", "tfoot"), ("table",)), "tfoot": (("thead", "tbody", "tfoot"), ("table",)), "option": (("option",), ("select",)),
}
#: An open head ends at any other start tag, and at text that is not white space.
IN_HEAD = frozenset("title style script meta link base template noscript noframes".split())
#: A table that takes more characters than PADDED with its columns at full width has cells padded to NARROW at most; where
#: that takes more as well, cells stand two spaces apart. No text is left out. Indents of lists take INDENTED a page at most.
PADDED, NARROW, INDENTED = 64 << 20, 200, 64 << 20

_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_STOP = re.compile(r">|=\s*+[\"']")
_ATTRIBUTE = re.compile(r"([^\s=/>\"']++)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]++)))?")
_UNQUOTED = re.compile(r"=\s*[^\s\"'>]+/$")  # a slash that belongs to a value
_DISPLAY = re.compile(r"(?<![\w-])display\s*:\s*(none|contents|block|inline(?:-[a-z]+)?|flex|grid|flow-root|table(?:-[a-z-]+)?|list-item|initial|inherit|unset)(?![\w-])\s*(!\s*important)?", re.I)
_VISIBILITY = re.compile(r"(?<![\w-])visibility\s*:\s*(hidden|collapse|visible)", re.I)
_NUMBER = re.compile(r"[ \t\n\r\f]*([+-]?)0*([0-9]+)")
_SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []


class Open:
    """Open elements, the root first, and where those of each tag are, so that none has to be looked for."""

    __slots__ = ("nodes", "places")

    def __init__(self, root: Node):
        self.nodes, self.places = [root], defaultdict(list)

    def push(self, node: Node) -> None:
        self.places[node.tag].append(len(self.nodes))
        self.nodes.append(node)

    def cut(self, k: int) -> None:
        while len(self.nodes) > k:
            self.places[self.nodes.pop().tag].pop()

    def last(self, tags: tuple[str, ...]) -> int:
        """The place of the innermost of these, 0 where none is open."""
        return max((self.places[t][-1] for t in tags if self.places[t]), default=0)

    def leave_head(self) -> None:
        if self.nodes[-1].tag == "head":
            self.cut(len(self.nodes) - 1)

    def imply(self, tags: tuple[str, ...], scope: tuple[str, ...]) -> None:
        """End the innermost of `tags`, unless one of `scope` is open within it."""
        k = self.last(tags)
        if k > self.last(scope):
            self.cut(k)

    def close(self, tag: str) -> None:
        k = self.last((tag,))
        if k > (self.last(("table",)) if tag in ("p", "div", "li", "ul", "ol", "span", "b", "i", "a") else 0):
            self.cut(k)
        elif tag in ("p", "br"):  # an end without a start is an empty element
            self.nodes[-1].children.append(Node(tag, {}))


def build(source: str) -> Node:
    """The tree of a page; strings are its text, entities read."""
    root = Node("html", {})
    open_ = Open(root)
    at, n, none_left = 0, len(source), set()
    lowered = None
    while at < n:
        i = source.find("<", at)
        if i < 0:
            i = n
        if i > at:
            text = entities.unescape(source[at:i])
            if text.strip(" \t\n\r\f"):
                open_.leave_head()
            open_.nodes[-1].children.append(text)
        if i == n:
            break
        if source.startswith("<!--", i):
            j = source.find("-->", i + 4)
            at = n if j < 0 else j + 3
            continue
        closing = source.startswith("/", i + 1)
        m = _NAME.match(source, i + 1 + closing)
        if not m:
            if source[i + 1 : i + 2] in ("!", "?", "/"):  # declarations and the like
                j = source.find(">", i)
                at = n if j < 0 else j + 1
            else:
                open_.leave_head()
                open_.nodes[-1].children.append("<")
                at = i + 1
            continue
        at = _tag_end(source, m.end(), none_left)
        tag = m[0].lower()
        if closing:
            open_.close(tag)
            continue
        written = source[m.end() : at - 1]
        attributes = {a.lower(): entities.unescape(x or y or z) for a, x, y, z in _ATTRIBUTE.findall(written)} if written.strip("/ ") else {}
        if tag in ("html", "body"):
            root.attributes.update(attributes if tag == "html" else {})
            if tag == "body":
                open_.imply(("head",), ("html",))
                if _unshown(attributes) or _veiled(attributes) is not None:
                    node = Node("body", attributes)
                    open_.nodes[-1].children.append(node)
                    open_.push(node)
            continue
        if tag not in IN_HEAD:
            open_.leave_head()
        if tag in ENDS:
            open_.imply(*ENDS[tag])
        if tag in CLOSES_P:
            open_.imply(("p",), ("td", "th", "table", "button", "object", "foreignobject", "li", "div", "body"))
        node = Node(tag, attributes)
        open_.nodes[-1].children.append(node)
        if written.endswith("/") and tag not in VOID and not _UNQUOTED.search(written) and (tag == "svg" or open_.last(("svg",)) > open_.last(("foreignobject",))):  # a slash ends any element of a drawing
            continue
        if tag in RAW:
            lowered = source.lower() if lowered is None else lowered
            # Lower case may change the length of a few letters; then look in the text as it stands.
            where = lowered if len(lowered) == n else source
            j = where.find(f"</{tag}", at)
            if tag not in UNSEEN:
                text = entities.unescape(source[at : n if j < 0 else j])
                node.children.append(text.removeprefix("\n") if tag == "textarea" else text)
            at = n if j < 0 else _tag_end(source, j + 2 + len(tag), none_left)
        elif tag not in VOID:
            open_.push(node)
    return root


def _tag_end(source: str, at: int, none_left: set[str]) -> int:
    """Behind the > that ends a tag, not one within quotes; quotes that never close don't count."""
    while m := _STOP.search(source, at):
        if m[0] == ">":
            return m.end()
        quote = m[0][-1]
        j = -1 if quote in none_left else source.find(quote, m.end())
        if j < 0:
            none_left.add(quote)
        at = m.end() if j < 0 else j + 1
    return len(source)


def _unshown(attributes: dict[str, str]) -> bool:
    """Whether the element isn't displayed: by its last `display`, an important one first, else by `hidden`."""
    found = _DISPLAY.findall(attributes["style"]) if "style" in attributes else []
    if found:
        return ([v for v, important in found if important] or [v for v, _ in found])[-1].lower() == "none"
    return "hidden" in attributes


def _veiled(attributes: dict[str, str]) -> bool | None:
    """Whether the element's text is invisible; None: as around it."""
    found = _VISIBILITY.findall(attributes["style"]) if "style" in attributes else []
    return found[-1].lower() != "visible" if found else None


def _number(value: str, least: int, most: int) -> int | None:
    """The integer that an attribute begins with, if it is within bounds."""
    m = _NUMBER.match(value)
    if not m or len(m[2]) > 10:
        return None
    n = int(m[1] + m[2])
    return n if least <= n <= most else None


def _span(value: str, most: int) -> int:
    """Rows or columns of a cell; `most` is the limit of the HTML standard, which takes larger numbers as it."""
    m = _NUMBER.match(value)
    if not m or m[1] == "-":
        return 1
    return most if len(m[2]) > 9 else min(int(m[2]), most)


class Table:
    """Rows of a table under way: (column, lines) of each cell that has text."""

    __slots__ = ("rows", "at", "spans", "fresh", "passed")

    def __init__(self):
        self.rows: list[list[tuple[int, list[str]]]] = []
        self.end_group()

    def end_group(self) -> None:
        self.spans: list[tuple[int, int, float]] = []  # (first column, column behind, last row) of cells from rows above
        self.fresh: list[tuple[int, int, float]] = []
        self.at = self.passed = 0

    def row(self) -> None:
        self.rows.append([])
        self.spans = sorted(s for s in self.spans + self.fresh if s[2] >= len(self.rows))
        self.fresh = []
        self.at = self.passed = 0

    def cell(self, lines: list[str], across: int, down: int) -> None:
        if not self.rows:
            self.row()
        while self.passed < len(self.spans) and self.spans[self.passed][0] <= self.at:
            self.at = max(self.at, self.spans[self.passed][1])
            self.passed += 1
        if lines:
            self.rows[-1].append((self.at, lines))
        if down != 1:  # 0: to the end of the group
            self.fresh.append((self.at, self.at + max(across, 1), len(self.rows) + down - 1 if down else float("inf")))
        self.at += max(across, 1)


Entry = str | tuple[str, list]


def flat(entries: list[Entry]) -> list[str]:
    """Lines, with items (mark, entries) written out: the mark before the first line, an indent of its width before the others."""
    out: list[str] = []
    marks: list[str] = []  # that wait for their line
    used = 0
    work = [(iter(entries), 0)]
    while work:
        rest, indent = work[-1]
        entry = next(rest, None)
        if entry is None:
            work.pop()
        elif isinstance(entry, tuple):
            marks.append(entry[0] if marks else " " * (indent if used + indent <= INDENTED else 0) + entry[0])
            work.append((iter(entry[1]), indent + len(entry[0])))
        else:
            lead = "".join(marks) if marks else " " * indent if entry and used + indent <= INDENTED else ""
            used += len(lead)
            marks.clear()
            out.append(lead + entry)
    return out


class Lines:
    """Lines and list items of one block under way."""

    __slots__ = ("done", "text", "gap", "space")

    def __init__(self):
        self.done: list[Entry] = []
        self.text: list[str] = []
        self.gap = self.space = False

    def inline(self, text: str) -> None:
        flat = _SPACE.sub(" ", text)
        if not flat:
            return
        if flat == " ":
            self.space = True
            return
        if self.text and (self.space or flat[0] == " "):
            self.text.append(" ")
        self.text.append(flat.strip(" "))
        self.space = flat[-1] == " "

    def end_line(self) -> None:
        if self.text:
            self.add(["".join(self.text)])
            self.text = []
        self.space = False

    def add(self, lines: list[Entry]) -> None:
        if self.gap and self.done and lines:
            self.done.append("")
        if lines:
            self.gap = False
        self.done.extend(lines)

    def finish(self) -> list[Entry]:
        self.end_line()
        return self.done


def render(root: Node) -> str:
    """All visible text of the tree."""
    stack: list = [Lines()]  # buffers of the page, of list items and of cells
    lists: list[list] = []  # (ordered, next number)
    tables: list[Table] = []
    pre = 0
    muted: list[bool] = []  # by open drawing, or text in it
    veiled = [False]  # by open element that says whether it is visible
    work: list = [(root, False)]
    while work:
        node, leaving = work.pop()
        out = stack[-1]
        if isinstance(node, str):
            if veiled[-1] or (muted and muted[-1]):
                continue
            if pre:
                first, *rest = node.split("\n")
                out.text.append(first)
                for line in rest:
                    out.add(["".join(out.text)])
                    out.text = [line]
            else:
                out.inline(node)
            continue
        tag = node.tag
        if not leaving:
            if tag in UNSEEN or _unshown(node.attributes) or (muted and tag in SVG_UNSEEN):
                continue
            if tag == "svg" or (muted and tag in SVG_TEXT):
                muted.append(tag == "svg")
            if tag in BOXES and (tag != "text" or muted):
                out.end_line()
            if tag == "br":
                if out.text:
                    out.end_line()
                else:
                    out.add([""])
                continue
            if tag in BLOCK:
                out.end_line()
                out.gap = out.gap or (tag in SPACED and not (tag in ("ul", "ol") and lists))
            if tag == "hr":
                continue
            if tag in ("ul", "ol", "menu"):
                start = _number(node.attributes.get("start", ""), *WHOLE)
                lists.append([tag == "ol", 1 if start is None else start])
            elif tag in ("li", "td", "th"):
                stack.append(Lines())
                value = _number(node.attributes.get("value", ""), *WHOLE) if tag == "li" and lists else None
                if value is not None:
                    lists[-1][1] = value
            elif tag == "table":
                tables.append(Table())
            elif tag == "tr" and tables:
                tables[-1].row()
            elif tag in ("thead", "tbody", "tfoot") and tables:
                tables[-1].end_group()
            pre += tag in PLAIN
            if (veil := _veiled(node.attributes)) is not None:
                veiled.append(veil)
            work.append((node, True))
            work.extend((c, False) for c in reversed(node.children))
            continue
        if tag in BOXES and (tag != "text" or muted):
            out.end_line()
        if tag == "svg" or (muted and tag in SVG_TEXT):
            muted.pop()
        if tag in PLAIN:
            pre -= 1
        if tag == "li":
            lines = stack.pop().finish()
            out = stack[-1]
            ordered, number = lists[-1] if lists else (False, 1)
            mark = f"{number}. " if ordered else "- "
            if lists:
                lists[-1][1] += 1
            if lines or not veiled[-1]:
                out.add([(mark, lines)] if lines else [mark.rstrip()])
        elif tag in ("td", "th"):
            lines = flat(stack.pop().finish())
            if tables:
                tables[-1].cell(lines, _span(node.attributes.get("colspan", "1"), 1000), _span(node.attributes.get("rowspan", "1"), 65534))
            else:
                stack[-1].end_line()
                stack[-1].add(lines)
        elif tag == "table":
            rows = [r for r in tables.pop().rows if r]
            stack[-1].end_line()
            stack[-1].add(aligned(rows))
            stack[-1].gap = True
        elif tag in BLOCK:
            if tag in ("thead", "tbody", "tfoot") and tables:
                tables[-1].end_group()
            out.end_line()
            out.gap = out.gap or (tag in SPACED and not (tag in ("ul", "ol") and len(lists) > 1))
            if tag in ("ul", "ol", "menu") and lists:
                lists.pop()
        if len(veiled) > 1 and _veiled(node.attributes) is not None:
            veiled.pop()
    return "\n".join(line.rstrip() for line in flat(stack[0].finish())).strip("\n")


def aligned(rows: list[list[tuple[int, list[str]]]]) -> list[str]:
    """Rows of cells as lines, those of a cell below each other, each padded to the widest of its column; columns are two spaces apart."""
    widest: dict[int, int] = {}
    lines: list[list[tuple[int, str]]] = []
    for row in rows:
        first = len(lines)
        lines.extend([] for _ in range(max(len(cell) for _, cell in row)))
        for k, cell in row:
            for n, text in enumerate(cell):
                if text:
                    lines[first + n].append((k, text))
                    widest[k] = max(widest.get(k, 0), len(text))
    for most in (max(widest.values(), default=0), NARROW):
        begins, total = {}, 0
        for k in sorted(widest):
            begins[k] = total + 2 * k
            total += min(widest[k], most)
        if sum(begins[line[-1][0]] for line in lines if line) <= PADDED:
            break
    else:
        return ["  ".join(text for _, text in line).rstrip() for line in lines]
    out = []
    for line in lines:
        parts, length, behind = [], 0, 0
        for k, text in line:
            # What a cell longer than NARROW takes too much moves the cells behind it.
            gap = max(begins[k] + behind - length, 0)
            parts += " " * gap, text
            length += gap + len(text)
            behind += max(len(text) - most, 0)
        out.append("".join(parts).rstrip())
    return out


def visible_text(source: str | None) -> str | None:
    """Null stays null; an empty page gives an empty text."""
    return None if source is None else render(build(source))


def extract(pages: DataFrame) -> DataFrame:
    """Rows of `pages` (page_id, url, html) as page_id, url, text; rows are mapped where they are read.

    A null page has a null text, an empty page an empty one; ids and urls may be
    null. Repeated rows come each; there are no ties. An empty table stays empty.
    Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [visible_text(x.as_py()) for x in part.column(2)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html").mapInArrow(run, "page_id long, url string, text string")


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("bigint"))
