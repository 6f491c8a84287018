"""Visible text of HTML pages, laid out in lines.

A tree is built with the end and start tags that HTML implies, elements that are
not shown are left out, and the rest is rendered: blocks on lines of their own,
paragraphs and headings with a blank line between, list items with marks and
indents, table cells aligned in columns.

Shown is what a browser shows of the page as it stands, by attributes and inline styles.
Not read: style sheets (a ``<style>`` rule or a linked sheet may hide an element), pictures
and the text that stands in for them, and fields' values but for text areas and options.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
UNSEEN = frozenset(
    "head script style title template noscript iframe noembed noframes datalist audio video canvas object desc metadata "
    "annotation annotation-xml".split()
)
#: Text that a browser shows as it stands, tags too.
VERBATIM = frozenset("textarea xmp".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure fieldset".split())
BLOCKS = SPACED | frozenset(
    "html body div section article aside nav header footer main address form hr li dt dd figcaption details summary "
    "dialog center caption legend menu hgroup search option optgroup select textarea xmp tr thead tbody tfoot td th".split()
)
CELLS = ("td", "th")
SECTIONS = ("thead", "tbody", "tfoot")
#: Tag: the open elements that it ends, and those beyond which it does not look.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "body": ({"head"}, {"html"}),
} | {t: ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}) for t in SECTIONS}
ENDS_P = BLOCKS - {"html", "body", "tr", "td", "th", "thead", "tbody", "tfoot", "caption", "legend", "option"}
WALLS = frozenset(("table", "td", "th", "caption"))

_TAG = re.compile(
    r"<(?:!--.*?(?:--!?>|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)([^>\"']*+(?:\"[^\"]*+\"[^>\"']*+|'[^']*+'[^>\"']*+)*+>|[^>]*+(?:>|\Z)))",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]*)))?")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(\w+)", re.I)
_SPACE = re.compile(r"[ \t\n\f\r]+")

class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.attributes, self.children = tag, attributes, []

    def get(self, name: str) -> str | None:
        """Value of an attribute, '' if it has none, None if it is not there."""
        if name not in self.attributes.lower():
            return None
        for found in _ATTRIBUTE.finditer(self.attributes):
            if found[1].lower() == name:
                return found[2] or found[3] or found[4] or ""
        return None

    def number(self, name: str, default: int) -> int:
        found = re.match(r"\s*([+-]?\d{1,18})", self.get(name) or "")
        return int(found[1]) if found else default

    def displayed(self) -> bool:
        """Whether the element has a place on the page; one that is not visible keeps it."""
        if self.tag in UNSEEN:
            return False
        if not self.attributes:
            return self.tag != "dialog"
        if self.get("hidden") is not None or (self.tag == "dialog" and self.get("open") is None):
            return False
        return not _NO_DISPLAY.search(self.get("style") or "")

    def visible(self, around: bool) -> bool:
        """Whether its texts are visible; ``around``: those of its parent."""
        found = _VISIBILITY.findall(self.get("style") or "") if self.attributes else None
        return found[-1].lower() not in ("hidden", "collapse") if found else around


def parse(page: str) -> Node:
    """The tree of a page; texts are strings among the children."""
    root = Node("#root")
    stack, opened, at, size = [root], Counter(), 0, len(page)

    def cut(k: int) -> None:
        for n in stack[k:]:
            opened[n.tag] -= 1
        del stack[k:]

    def end(tags, walls) -> None:
        """End the outermost open element of these tags inside the walls."""
        if any(opened[t] > 0 for t in tags):
            found = None
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in tags:
                    found = k
                elif stack[k].tag in walls:
                    break
            if found:
                cut(found)

    while at < size:
        m = _TAG.search(page, at)
        text = page[at : m.start()] if m else page[at:]
        if text:
            stack[-1].children.append(html.unescape(text))
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag, attributes = m[2].lower(), m[3][:-1]
        if m[1]:
            if opened[tag] > 0:
                walls = () if tag in WALLS or tag in ("tr", *SECTIONS) else WALLS
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == tag:
                        cut(k)
                        break
                    if stack[k].tag in walls:
                        break
            continue
        if tag in IMPLIED:
            end(*IMPLIED[tag])
        if tag in ENDS_P:
            end(("p",), WALLS)
        if tag in CELLS and stack[-1].tag in ("table", *SECTIONS):
            row = Node("tr")
            stack[-1].children.append(row)
            stack.append(row)
            opened["tr"] += 1
        node = Node(tag, attributes)
        stack[-1].children.append(node)
        if tag in VOID:
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            if tag in VERBATIM:
                inside = page[at : close.start() if close else size].removeprefix("\n")
                node.children.append(html.unescape(inside) if tag == "textarea" else inside)
            at = page.find(">", close.end()) + 1 if close else size
            at = at or size
            continue
        stack.append(node)
        opened[tag] += 1
    return root


class Lines:
    """Lines of text as they are laid out."""

    def __init__(self):
        self.lines: list[str] = []
        self.now, self.gap, self.mark, self.indent = "", 0, "", [""]

    def text(self, s: str, kept: bool) -> None:
        if kept:
            first, *more = s.replace("\r\n", "\n").split("\n")
            self.now += first
            for part in more:
                self.end_line(True)
                self.now = part
            return
        s = _SPACE.sub(" ", s)
        if not self.now or self.now[-1] == " ":
            s = s.removeprefix(" ")
        self.now += s

    def end_line(self, empty_too: bool = False) -> None:
        line, self.now = self.now.rstrip(), ""
        if line.strip() or (empty_too and self.lines and not self.gap):
            if self.lines:
                self.lines += [""] * self.gap
            self.lines.append((self.indent[-1][: len(self.indent[-1]) - len(self.mark)] + self.mark + line).rstrip())
            self.gap, self.mark = 0, ""

    def block(self, gap: int) -> None:
        self.end_line()
        self.gap = max(self.gap, gap)

    def item(self, mark: str) -> None:
        self.block(0)
        self.mark = mark
        self.indent.append(self.indent[-1] + " " * len(mark))

    def item_end(self) -> None:
        self.block(0)
        self.indent.pop()
        self.mark = ""


def render(root: Node, visible: bool = True, tables: dict | None = None) -> list[str]:
    """Lines of the visible text below a node. ``tables``: lines of the tables inside, as they are known."""
    out, lists, kept = Lines(), [], 0
    todo: list = [(root, False, visible)]
    while todo:
        node, leaving, seen = todo.pop()
        if isinstance(node, str):
            if seen:
                out.text(node, kept > 0)
            continue
        tag = node.tag
        if leaving:
            if tag in ("ul", "ol", "menu") and lists:
                lists.pop()
            if tag in ("li", "dd", "blockquote"):
                out.item_end()
            kept -= tag == "pre" or tag in VERBATIM
            out.block(1 if tag in SPACED and not (lists and tag in ("ul", "ol")) else 0)
            continue
        if not node.displayed():
            continue
        seen = node.visible(seen)
        if tag == "br":
            out.end_line(True)
            continue
        if tag == "table":
            out.block(1)
            for line in tables[id(node), seen] if tables and (id(node), seen) in tables else laid_out(node, seen):
                out.now = line
                out.end_line()
            out.block(1)
            continue
        if tag in BLOCKS:
            out.block(1 if tag in SPACED and not (lists and tag in ("ul", "ol")) else 0)
            if tag in ("ul", "ol", "menu"):
                lists.append(node.number("start", 1) if tag == "ol" else None)
            elif tag == "li":
                number = lists[-1] if lists else None
                if number is not None:
                    number = node.number("value", number)
                    lists[-1] = number + 1
                out.item("- " if number is None else f"{number}. ")
            elif tag in ("dd", "blockquote"):
                out.item("  ")
            kept += tag == "pre" or tag in VERBATIM
            todo.append((node, True, seen))
        if tag == "details" and node.get("open") is None:
            summaries = [c for c in node.children if isinstance(c, Node) and c.tag == "summary"]
            todo += [(c, False, seen) for c in summaries[:1]]
        elif tag == "select" and node.get("multiple") is None and node.number("size", 1) <= 1:
            todo += [(c, False, seen) for c in _chosen(node)]
        else:
            todo += [(c, False, seen) for c in reversed(node.children)]
    out.end_line()
    return out.lines


def _chosen(select: Node) -> list[Node]:
    """The option that a closed list shows: the last one that is selected, else the first."""
    options, todo = [], list(reversed(select.children))
    while todo:
        node = todo.pop()
        if isinstance(node, Node):
            options += [node] * (node.tag == "option")
            todo += reversed(node.children)
    return [o for o in options if o.get("selected") is not None][-1:] or options[:1]


def laid_out(outer: Node, visible: bool) -> list[str]:
    """Lines of a table. Those inside it come first, however deep they nest, so that no call stands in another."""
    found, todo = [], [(outer, visible, visible)]
    while todo:
        node, around, _ = todo.pop()
        if isinstance(node, str) or not node.displayed():
            continue
        seen = node.visible(around)
        if node.tag == "table":
            found.append((node, seen if node is not outer else visible))
        todo += [(c, seen, seen) for c in node.children]
    known: dict = {}
    for node, seen in reversed(found):
        known[id(node), seen] = table(node, seen, known)
    return known[id(outer), visible]


def table(node: Node, visible: bool, known: dict) -> list[str]:
    """Lines of a table: captions, then a line per row with its cells in columns.

    A cell stands in its column beside cells that reach down from rows above (``rowspan``), whose
    text stands in their first row.
    """
    captions, rows, stray, section = [], [], [], 0
    todo = [(c, visible, 0) for c in reversed(node.children)]
    while todo:
        child, seen, of = todo.pop()
        if isinstance(child, str):
            stray.append((child, seen))
        elif not child.displayed():
            continue
        elif child.tag in SECTIONS:
            section += 1
            todo += [(c, child.visible(seen), section) for c in reversed(child.children)]
        elif child.tag == "tr":
            rows.append((_cells(child, child.visible(seen), known), of))
        elif child.tag == "caption":
            captions += render(child, seen, known)
        else:
            stray.append((child, seen))
    loose, lines = [], []
    for part, seen in stray:
        content = Node("#cell")
        content.children = [part]
        loose += render(content, seen, known)
    # Cells by row and column; reaching cells keep their columns until they or their section end.
    placed, longest, reach, before = [], {}, {}, 0
    for cells, of in rows:
        if of != before:
            reach, before = {}, of
        at, line, taken = 0, [], {c: n - 1 for c, n in reach.items() if n > 1}
        for text, across, down in cells:
            while at in reach:
                at += 1
            line.append((at, across, text))
            spans = longest.setdefault(at, {})
            spans[across] = max(spans.get(across, 0), len(text))
            if down != 1:
                taken |= {c: down - 1 if down > 0 else len(rows) for c in range(at, at + across)}
            at += across
        placed.append(line)
        reach = taken
    # Only columns that some cell starts in are looked at, not every number of a span. A column begins
    # two places after the longest text of those that end before it.
    columns = sorted(longest)
    starts, least = {}, [0] * (len(columns) + 1)
    for k, at in enumerate(columns):
        starts[at] = least[k]
        least[k + 1] = max(least[k + 1], least[k] + 2)
        for across, size in longest[at].items():
            after = bisect_left(columns, at + across)
            least[after] = max(least[after], least[k] + size + 2)
    for line in placed:
        now = ""
        for at, _, text in line:
            if text:
                now = now.ljust(starts[at]) + text
        if now.strip():
            lines.append(now.rstrip())
    return [*loose, *captions, *lines]


#: Most columns that a cell reaches over and most rows that it reaches down, as in the HTML standard.
MOST_ACROSS, MOST_DOWN = 1000, 65534


def _cells(row: Node, visible: bool, known: dict) -> list[tuple[str, int, int]]:
    """(text, columns, rows) of the cells of a row; other content is a cell of its own."""
    cells = []
    for c in row.children:
        own = isinstance(c, Node) and c.tag in CELLS
        content = Node("#cell")
        content.children = c.children if own else [c]
        if own and not c.displayed():
            continue
        seen = c.visible(visible) if own else visible
        text = " ".join(x.strip() for x in render(content, seen, known) if x)
        if own or text:
            across = min(max(c.number("colspan", 1), 1), MOST_ACROSS) if own else 1
            cells.append((text, across, min(max(c.number("rowspan", 1), 0), MOST_DOWN) if own else 1))
    return cells


def page_text(page: str | None) -> str:
    """Visible text of a page; empty for a null."""
    return "\n".join(render(parse(page or "")))


def html_texts(pages: DataFrame, key: str = "page_id", source: str = "html") -> DataFrame:
    """``key``, ``text`` and ``n_chars`` of each page.

    A narrow operation: each page is rendered where it is, in Arrow batches. A
    null or empty page, and one without visible text, has an empty text; broken
    markup is read as browsers do, as far as the rules above go. Repeated rows
    and null keys keep a row each. Other columns are ignored.
    """
    rows = pages.select(F.col(f"`{key}`").alias("key"), F.col(f"`{source}`").alias("html"))

    def rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in (batch.slice(k, 200) for k in range(0, batch.num_rows, 200)):
                texts = [page_text(x.as_py()) for x in some.column(1)]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(texts, pa.string())], ["key", "text"])

    out = rows.mapInArrow(rendered, f"key {rows.schema['key'].dataType.simpleString()}, text string")
    return out.select(F.col("key").alias(key), "text", F.length("text").cast("long").alias("n_chars"))
