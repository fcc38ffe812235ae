"""HTML pages to rows of elements, in document order."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from html.parser import HTMLParser
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements without an end tag, and those whose content is no text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset(["script", "style", "template"])
#: Rows a batch.
BATCH = 20_000
_NODES = "seq int, parent int, depth int, tag string, text string, href string, src string, width double, height double"


def _number(text: str | None) -> float | None:
    try:
        return float((text or "").strip().removesuffix("px"))
    except ValueError:
        return None


class _Elements(HTMLParser):
    """Collects (parent, depth, tag, text, href, src, width, height); ends close up to their start."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[list] = []
        self.open: list[int] = []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        self.rows.append([self.open[-1] if self.open else None, len(self.open), tag, [], a.get("href"), a.get("src"), _number(a.get("width")), _number(a.get("height"))])
        if tag not in VOID:
            self.open.append(len(self.rows) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.open.pop()

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, -1, -1):
            if self.rows[self.open[i]][2] == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        if self.open and self.rows[self.open[-1]][2] not in SILENT and data.strip():
            self.rows[self.open[-1]][3].append(" ".join(data.split()))


def elements(html: str | None) -> list[list]:
    """The elements of a page; null and text without elements give none."""
    parser = _Elements()
    parser.feed(html or "")
    parser.close()
    return [[i, *r[:3], " ".join(r[3]) or None, *r[4:]] for i, r in enumerate(parser.rows)]


def element_batches(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Batches of elements of batches of a key and a page; the rows of many pages share one, and no more of them are held."""
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    for batch in batches:
        rows = ((i, *r) for i in range(batch.num_rows) for r in elements(batch.column(1)[i].as_py()))
        while part := list(islice(rows, BATCH)):
            at, *columns = zip(*part)
            made = [pa.array(c, t) for c, t in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), *made], names=[key, "seq", "parent", "depth", "tag", "text", "href", "src", "width", "height"])


def html_elements(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """``key, seq, parent, depth, tag, text, href, src, width, height`` of every element.

    ``text`` is the element's own text with white space joined. Malformed nesting is repaired as far
    as end tags close up to their start.
    """
    narrow = pages.select(F.col(key), F.col(html))
    kind = narrow.schema[0].dataType.simpleString()

    return narrow.mapInArrow(lambda batches: element_batches(batches, key), f"{key} {kind}, {_NODES}")


def text_blocks(nodes: DataFrame, key: str = "page_id") -> DataFrame:
    """``key, seq, type, lines``: each element with text as a block of one line."""
    return nodes.filter(F.col("text").isNotNull()).select(key, "seq", F.col("tag").alias("type"), F.array("text").alias("lines"))
