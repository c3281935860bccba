"""Tables in cells and lists in items: every table, row, cell, list and item of a page with its place.

One pass over a page's tags with a stack of open elements. A tag that HTML lets stand without an end (a cell, row or
item) ends where the next of its kind begins in the same table or list, or where that is closed. Text belongs to the
innermost open element, also where it follows a nested one. The pass is linear in the page; memory is one batch of
pages. It runs in Arrow batches, since array functions have no stack that grows and shrinks without being copied.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions.text import markup_text
from tallybook.sources.pages import visible_html

TAG = re.compile(r"<(/?)(table|tr|td|th|ul|ol|li)\b[^<>]*>", re.IGNORECASE)
KIND = {"table": "table", "tr": "row", "td": "cell", "th": "header", "ul": "list", "ol": "list", "li": "item"}
# What an element of this kind stands in: an open one of its own kind ends where the next begins, up to there.
INSIDE = {"row": ("table",), "cell": ("row", "table"), "header": ("row", "table"), "item": ("list",)}
BOUNDS = ("table", "list")
FIELDS = ["element_no", "parent_no", "kind", "depth", "position", "markup"]


def elements(page: str) -> list[tuple]:
    """(number, parent's number or 0, kind, depth among its kind, position in its parent, own markup) of each element."""
    found: list[list] = []  # [parent, kind, depth, position, pieces, children]
    stack: list[int] = []
    loose = 0  # elements without a parent
    at = 0
    for tag in TAG.finditer(page):
        if stack and tag.start() > at:
            found[stack[-1]][4].append(page[at:tag.start()])
        at = tag.end()
        kind = KIND[tag[2].lower()]
        if tag[1]:
            _close(found, stack, kind)
            continue
        stops = INSIDE.get(kind, ())
        if stops:
            at_stop = next((i for i in range(len(stack) - 1, -1, -1) if found[stack[i]][1] in (*stops, *BOUNDS)), -1)
            if at_stop < 0 or found[stack[at_stop]][1] in stops:
                del stack[at_stop + 1:]
        parent = stack[-1] if stack else -1
        if parent >= 0:
            found[parent][5] += 1
            found[parent][4].append(" ")
        else:
            loose += 1
        depth = 1 + next((found[i][2] for i in reversed(stack) if found[i][1] == kind), 0)
        found.append([parent, kind, depth, found[parent][5] if parent >= 0 else loose, [], 0])
        stack.append(len(found) - 1)
    if stack:
        found[stack[-1]][4].append(page[at:])
    return [(i + 1, f[0] + 1, f[1], f[2], f[3], "".join(f[4])) for i, f in enumerate(found)]


def _close(found: list[list], stack: list[int], kind: str) -> None:
    """Close the innermost open element of a kind; a table or list in between keeps what is outside it open."""
    for i in range(len(stack) - 1, -1, -1):
        here = found[stack[i]][1]
        if here == kind or {here, kind} == {"cell", "header"}:
            del stack[i:]
            return
        if here in BOUNDS and kind not in BOUNDS:
            return


def page_elements(pages: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """``keys, element_no, parent_no, kind, depth, position, text`` of every element of each page.

    Elements are numbered from 1 in the order in which they begin, parents stand before their children; 0 is no parent.
    ``depth`` counts open elements of the same kind, ``position`` the children of one parent from 1. ``text`` is the element's own:
    what is in nested elements is theirs. Pages that are null or have no such element give no rows.
    """
    import pyarrow as pa  # needed for these pages only

    schema = pages.select(*keys).schema
    for name, kind in zip(FIELDS, ("integer", "integer", "string", "integer", "integer", "string")):
        schema = schema.add(name, kind)
    kinds = [pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.string()]

    def read(batches: Iterable) -> Iterator:
        for batch in batches:
            for begin in range(0, len(batch), 256):
                part = batch.slice(begin, 256)
                rows = [(i, *e) for i, page in enumerate(part.column(len(keys)).to_pylist()) if page for e in elements(page)]
                own = pa.array([r[0] for r in rows], pa.int64())
                columns = [c.take(own) for c in part.columns[:len(keys)]]
                columns += [pa.array([r[n + 1] for r in rows], k) for n, k in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=[*keys, *FIELDS])

    seen = pages.select(*keys, visible_html(F.col(html)).alias("__html"))
    return seen.mapInArrow(read, schema).select(*keys, *FIELDS[:-1], markup_text(F.col("markup")).alias("text"))
