"""Nodes of stored HTML pages.

The one place Python sees the data: each function below is an Arrow UDF from an HTML
column to small arrays of text nodes and links; everything after that is built-in
expressions. Pages are parsed leniently into the standard library's element tree.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator, Sequence
from html import unescape
from html.parser import HTMLParser
from itertools import accumulate, chain
from xml.etree.ElementTree import (
    Comment, Element, ProcessingInstruction, SubElement, TreeBuilder,
)

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements that never have content (fixed values).
VOID = frozenset(
    "area base br col embed frame hr img input link meta param source track wbr".split()
)
# How far an element reaches: an end tag never closes an element of a higher rank.
RANK = {
    "div": 1, "td": 2, "th": 2, "tr": 3, "tbody": 4, "thead": 4, "tfoot": 4,
    "table": 5, "body": 6, "html": 7,
}
# A start tag on the left closes an open element on the right, with all inside it,
# unless one of the listed containers lies between (fixed values).
IMPLIED_END = {
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
    "li": ({"li"}, {"ul", "ol"}),
    "option": ({"option"}, {"select"}),
}
# Elements that hold markup and text like any other: no script, style, title (fixed values).
PLAIN = frozenset(
    "a abbr article aside b big body br caption center code col dd div dl dt em figure font footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html i img li link main meta nav ol option p pre s section "
    "select small span strong sub sup table tbody td tfoot th thead tr u ul".split()
)
# What stands in a tag of one attribute at most, with complete references only in its value.
_TAG = re.compile(
    r'/([a-zA-Z][a-zA-Z0-9]*)|([a-zA-Z][a-zA-Z0-9]*)'
    r'(?: ([a-zA-Z]+)="([^"&<>]*(?:&(?:amp|lt|gt|quot|#39);[^"&<>]*)*)")?/?')
# End tag, start tag, what the start tag closes and whether it is void, by what stands in the tag.
_KNOWN = {tag + end: (None, tag, IMPLIED_END.get(tag), tag in VOID) for tag in PLAIN for end in ("", "/")}
_KNOWN |= {"/" + tag: (tag, None, None, False) for tag in PLAIN}


def plain_tree(html: str) -> Element | None:
    """The parser's tree, where simple tags and text are all there is; else None.

    Such a page is cut in one pass, which takes a fraction of the parser's time. Elements are put
    together here by the rules of the parser below: a call for each tag and text would take longer
    than all the rest.
    """
    first, *parts = html.split("<")
    page = last = Element("page")
    nodes, names = [page], ["page"]
    # Text is held until an element begins or ends: an end tag that ends nothing splits none.
    held, after = (unescape(first) if first else None), False
    for part in parts:
        inside, closed, text = part.partition(">")
        if not closed:
            return None
        attributes = None
        known = _KNOWN.get(inside)
        if known is None:
            found = _TAG.fullmatch(inside)
            if found is None:
                return None
            end, tag, name, value = found.groups()
            known = (end.lower(), None, None, False) if end is not None else _KNOWN.get(tag.lower())
            if known is None:
                return None
            if name:
                attributes = {name.lower(): unescape(value)}
        end, tag, implied, void = known
        # How deep the element lies that ends here, with all inside it; 0 if none does.
        depth = 0
        if end is not None:
            depth = len(names) - 1
            if names[depth] != end:
                rank = RANK.get(end, 0)
                while depth and names[depth] != end:
                    depth = depth - 1 if RANK.get(names[depth], 0) <= rank else 0
        elif implied is not None:
            closes, within = implied
            depth = len(names) - 1
            while depth and names[depth] not in closes:
                depth = depth - 1 if names[depth] not in within else 0
        elif tag == "p" and names[-1] == "p":
            depth = len(names) - 1
        if held is not None and (depth or end is None):
            if after:
                last.tail = held
            else:
                last.text = held
            held = None
        if depth:
            last, after = nodes[depth], True
            del nodes[depth:], names[depth:]
        if end is None:
            last = SubElement(nodes[-1], tag, attributes) if attributes else SubElement(nodes[-1], tag)
            after = void
            if not void:
                nodes.append(last)
                names.append(tag)
        if text:
            if "&" in text:
                text = unescape(text)
            held = text if held is None else held + text
    if held is not None:
        if after:
            last.tail = held
        else:
            last.text = held
    return page


class TreeParser(HTMLParser):
    """Builds an element tree; text nodes end at any tag that opens or closes something."""

    plain_tree = staticmethod(plain_tree)

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.builder = TreeBuilder(insert_comments=True, insert_pis=True)
        self.builder.start("page", {})
        self.open: list[str] = []

    def updatepos(self, i, j):
        return j  # nobody asks for line numbers, and counting them is slow

    def tree(self, html: str) -> Element:
        self.feed(html)
        self.close()
        return self._whole()

    def _whole(self) -> Element:
        self._close_to(0)
        self.builder.end("page")
        return self.builder.close()

    def _close_to(self, depth: int) -> None:
        while len(self.open) > depth:
            self.builder.end(self.open.pop())

    def _close_implied(self, tag: str) -> None:
        closes, within = IMPLIED_END[tag]
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth] in closes:
                self._close_to(depth)
                return
            if self.open[depth] in within:
                return

    def handle_starttag(self, tag, attrs):
        if tag in IMPLIED_END:
            self._close_implied(tag)
        elif tag == "p" and self.open and self.open[-1] == "p":
            self._close_to(len(self.open) - 1)
        first: dict[str, str] = {}
        for name, value in attrs:
            first.setdefault(name, value or "")
        self.builder.start(tag, first)
        if tag in VOID:
            self.builder.end(tag)
        else:
            self.open.append(tag)

    def handle_startendtag(self, tag, attrs):
        # HTML knows no self-closing elements: <b/> opens a b.
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        rank = RANK.get(tag, 0)
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth] == tag:
                self._close_to(depth)
                return
            if RANK.get(self.open[depth], 0) > rank:
                return

    def handle_data(self, data):
        self.builder.data(data)

    def handle_comment(self, data):
        self.builder.comment(data)

    def parse_marked_section(self, i, report=1):
        # A broken <![...] section is a comment, as browsers read it.
        return self.parse_bogus_comment(i)

    def handle_pi(self, data):
        self.builder.pi("pi", data)


def parse_page(html: str) -> Element | None:
    """Element tree of a page; None where even a lenient parse is impossible."""
    tree = plain_tree(html)
    if tree is not None:
        return tree
    try:
        return TreeParser().tree(html)
    except AssertionError:  # the parser's answer to some broken <![...] sections
        return None


def direct_text(element: Element) -> Iterator[str]:
    """The element's own text nodes, in order."""
    if element.text:
        yield element.text
    for child in element:
        if child.tail:
            yield child.tail


def first_text(element: Element) -> str | None:
    return element.text or next(direct_text(element), None)


def first_link(element: Element) -> str | None:
    return next((a.get("href") for a in element.findall("a") if a.get("href") is not None), None)


def links_at(page: Element, path: Sequence[str]) -> list[tuple]:
    """First text node and target of each element at the end of a child path."""
    found = page.iterfind(".//" + "/".join(path))
    return [(first_text(a), a.get("href")) for a in found]


def listing_cells(page: Element) -> list[tuple]:
    """Per table body row, the first cell's link and the first text node of every cell."""
    rows = []
    for table in page.iter("table"):
        for row in chain.from_iterable(body.findall("tr") for body in table.findall("tbody")):
            cells = list(row.iter("td"))
            rows.append((first_link(cells[0]) if cells else None, [first_text(c) for c in cells]))
    return rows


def detail_nodes(page: Element, css_class: str) -> tuple[list[str], list[str]]:
    """Text directly in the report areas, and the labels below them, in document order."""
    areas = [e for e in page.iter("div") if css_class in (e.get("class") or "")]
    if len(areas) < 2:
        labelled = [b for area in areas for b in area.iter("b")]
        if not any(map(len, labelled)):  # with nothing inside, their own order is the document's
            return (
                [t for area in areas for t in direct_text(area)],
                [b.text for b in labelled if b.text])
    texts: list[str] = []
    labels: list[str] = []
    # Stack entries: an element and whether it lies in an area, or a text node to take.
    todo: list[tuple] = [(page, False)]
    while todo:
        node, inside = todo.pop()
        if isinstance(node, str):
            (texts if inside else labels).append(node)
            continue
        area = node.tag == "div" and css_class in (node.get("class") or "")
        inside = inside or area
        pending: list[tuple] = []

        def take(text: str | None) -> None:
            if text and area:
                pending.append((text, True))
            elif text and inside and node.tag == "b":
                pending.append((text, False))

        take(node.text)
        for child in node:
            if child.tag not in (Comment, ProcessingInstruction):
                pending.append((child, inside))
            take(child.tail)
        todo.extend(reversed(pending))
    return texts, labels


def table_cells(page: Element) -> list[tuple]:
    """First bold text and first link of each cell of rows directly in a table."""
    return [
        (next((t for b in td.iterfind("b") for t in direct_text(b)), None), first_link(td))
        for td in page.iterfind(".//table/tr/td")
    ]


# Results go to Arrow column by column; one dict per node would cost as much as parsing.


def _strings(values: list) -> pa.Array:
    return pa.array(values, pa.string())


def _lists(lists: list[list], build: Callable[[list], pa.Array]) -> pa.Array:
    offsets = pa.array([0, *accumulate(map(len, lists))], pa.int32())
    return pa.ListArray.from_arrays(offsets, build(list(chain.from_iterable(lists))))


def _structs(rows: list[tuple], **fields: Callable[[list], pa.Array]) -> pa.Array:
    columns = list(zip(*rows)) or [()] * len(fields)
    arrays = [build(list(values)) for build, values in zip(fields.values(), columns)]
    return pa.StructArray.from_arrays(arrays, list(fields))


def _string_lists(lists: list[list]) -> pa.Array:
    return _lists(lists, _strings)


def _html_udf(
    html: Column,
    collect: Callable[[Element], object],
    empty: object,
    build: Callable[[list], pa.Array],
    ddl: str,
) -> Column:
    # Spark cuts the batches by size (spark.sql.execution.arrow.maxBytesPerBatch, 64 MB), so
    # long pages come few at a time.
    @F.arrow_udf(ddl)
    def nodes(pages: pa.Array) -> pa.Array:
        results = []
        for text in pages.to_pylist():
            tree = parse_page(text) if text is not None else None
            results.append(empty if tree is None else collect(tree))
        return build(results)

    return nodes(html)


def link_nodes(html: Column, path: Sequence[str]) -> Column:
    path = tuple(path)
    return _html_udf(
        html, lambda page: links_at(page, path), [],
        lambda pages: _lists(pages, lambda rows: _structs(rows, text=_strings, href=_strings)),
        "array<struct<text: string, href: string>>",
    )


def listing_nodes(html: Column) -> Column:
    return _html_udf(
        html, listing_cells, [],
        lambda pages: _lists(pages, lambda rows: _structs(rows, href=_strings, texts=_string_lists)),
        "array<struct<href: string, texts: array<string>>>",
    )


def detail_texts(html: Column, css_class: str) -> Column:
    return _html_udf(
        html, lambda page: detail_nodes(page, css_class), ([], []),
        lambda pages: _structs(pages, texts=_string_lists, labels=_string_lists),
        "struct<texts: array<string>, labels: array<string>>",
    )


def description_cells(html: Column) -> Column:
    return _html_udf(
        html, table_cells, [],
        lambda pages: _lists(pages, lambda rows: _structs(rows, bold=_strings, href=_strings)),
        "array<struct<bold: string, href: string>>",
    )


# The helpers travel with the UDF, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
