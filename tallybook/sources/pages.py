"""Tables and list items out of stored web pages, one row per page in, many rows out.

Elements are found by splitting at their opening tags and cutting each piece at the first tag that
ends it, so the work is linear in the page length, also where closing tags are missing. Tables
nested in a table are not taken apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallybook.functions.text import markup_text, markup_texts
from tallybook.operators.notices import watch

HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b.*?(?:</\1\s*>|\z)"
TABLE = r"(?is)<table\b[^<>]*>(.*?)(?:</table\s*>|\z)"
# What ends an element besides the next one of its kind, and all that follows.
ENDS = {
    "tr": r"(?is)</?(?:tr|thead|tbody|tfoot|table)\b.*",
    "td": r"(?is)</?(?:td|th|tr|thead|tbody|tfoot|table)\b.*",
    "th": r"(?is)</?(?:td|th|tr|thead|tbody|tfoot|table)\b.*",
    "li": r"(?is)</(?:li|ul|ol)\b.*",
}


def visible_html(html: Column) -> Column:
    """The page without comments, scripts and styles."""
    return F.regexp_replace(html, HIDDEN, "")


def _pieces(html: Column, tag: str) -> Column:
    return F.split(html, rf"(?i)<{tag}\b[^<>]*>")


def _after_first(array: Column) -> Column:
    return F.slice(array, F.lit(2), F.greatest(F.size(array) - 1, F.lit(0)))


def _all(html: Column, tag: str) -> Column:
    """Inner markup of every ``tag`` element."""
    end = ENDS.get(tag, rf"(?is)</{tag}\b.*")
    return F.transform(_after_first(_pieces(html, tag)), lambda piece: F.regexp_replace(piece, end, ""))


def _section(html: Column, section_id: str) -> Column:
    """Inner markup of the named section: up to the closing tag that leaves as many closed as opened.

    The rest of the page is cut at its section tags; each piece begins with the tag that it follows. The walk counts
    the pieces inside; they are joined once.
    """
    opening = rf"(?is)<section\b[^<>]*?\sid\s*=\s*[\"']?\Q{section_id}\E(?=[\"'\s>])[^<>]*>"
    rest = F.regexp_extract(html, opening + r"(.*)\z", 1)
    pieces = F.split(rest, r"(?i)(?=</?section\b[^<>]*>)")
    start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("inside"))

    def walk(state: Column, piece: Column) -> Column:
        step = F.when(piece.rlike(r"(?i)^</section"), -1).when(piece.rlike(r"(?i)^<section\b"), 1).otherwise(0)
        depth = F.when(state["depth"] > 0, state["depth"] + step).otherwise(F.lit(0))
        return F.struct(depth.alias("depth"), (state["inside"] + F.when(depth > 0, 1).otherwise(0)).alias("inside"))

    inside = F.aggregate(pieces, start, walk, lambda state: state["inside"])
    return F.array_join(F.slice(pieces, F.lit(1), inside), "")


def page_items(pages: DataFrame, keys: list[str], tag: str = "li", html: str = "html") -> DataFrame:
    """Text of every ``tag`` element with its position (from 1) on the page.

    An element's text ends where one of its kind begins or where it is closed. What follows a list
    nested in an item is not taken into it.
    """
    found = pages.select(*keys, F.posexplode(_all(visible_html(F.col(html)), tag)).alias("at", "item"))
    return found.select(*keys, (F.col("at") + 1).alias("position"), markup_text(F.col("item")).alias("item"))


def page_rows(pages: DataFrame, keys: list[str], section_id: str, html: str = "html") -> DataFrame:
    """All rows of the first table in a named section: ``keys, row_no, headers, cells, fits``.

    The first ``<tr>`` holds the headers; a blank header becomes ``Column_<i>``, the first one ``Narration``. ``fits``: the
    row has as many cells as there are headers.
    """
    table = F.regexp_extract(_section(visible_html(F.col(html)), section_id), TABLE, 1)
    headers = F.transform(
        markup_texts(_all(F.col("table"), "th")),
        lambda title, i: F.when(i == 0, F.lit("Narration"))
        .when(title == "", F.concat(F.lit("Column_"), i.cast("string"))).otherwise(title))
    body = _after_first(_all(F.col("table"), "tr"))
    rows = (pages.select(*keys, table.alias("table"))
            .select(*keys, headers.alias("headers"), body.alias("rows"))
            .select(*keys, "headers", F.posexplode("rows").alias("at", "row")))
    fits = F.size(_pieces(F.col("row"), "td")) - 1 == F.size("headers")
    return rows.select(*keys, (F.col("at") + 1).alias("row_no"), "headers", markup_texts(_all(F.col("row"), "td")).alias("cells"),
                       fits.alias("fits"))


def page_tables(pages: DataFrame, keys: list[str], section_id: str, html: str = "html",
                notices: Observation | str | None = None) -> DataFrame:
    """The rows of ``page_rows`` that fit: ``keys, row_no, headers, cells``. ``notices`` counts those of another width."""
    rows = watch(page_rows(pages, keys, section_id, html), notices, other_width=~F.col("fits"))
    return rows.filter("fits").drop("fits")


def wide_rows(tables: DataFrame, keys: list[str], headers: list[str], strict: bool = False) -> DataFrame:
    """One string column per header, as the page shows the table (no transposing, no cleaning).

    With ``strict`` a table with a header that is not wanted fails the job; else such columns are left out.

    ``headers`` may hold a name more than once: its n-th place takes the n-th column of that name,
    and the output column is called ``<name>_<n>`` from the second on.
    """
    def cell(at: int, header: str) -> Column:
        nth = headers[:at].count(header)
        places = F.filter(F.sequence(F.lit(1), F.size("headers")), lambda i: F.element_at("headers", i) == header)
        place = F.try_element_at(F.when(F.size("headers") > 0, places), F.lit(nth + 1))
        return F.when(place > 0, F.try_element_at("cells", place)).alias(f"{header}_{nth + 1}" if nth else header)

    if strict:
        others = F.array_except(F.slice("headers", F.lit(2), F.greatest(F.size("headers") - 1, F.lit(0))), F.lit(headers))
        sound = F.when(F.size(others) > 0, F.raise_error(F.concat(F.lit("no column for "), F.array_join(others, ", "))))
        tables = tables.where(sound.otherwise(F.lit(True)).cast("boolean"))
    return tables.select(*keys, "row_no", F.col("cells")[0].alias("Narration"), *[cell(i, h) for i, h in enumerate(headers)])


def table_cells(tables: DataFrame, keys: list[str]) -> DataFrame:
    """One row per cell: ``keys, row_no, col_no, label, period, value``; the shape a transpose starts from.

    ``col_no`` counts the columns after the labels from 1, so that columns with one header stay apart.
    """
    width = F.greatest(F.size("headers") - 1, F.lit(0))
    pairs = F.arrays_zip(F.slice("headers", F.lit(2), width).alias("period"),
                         F.slice("cells", F.lit(2), width).alias("value"))
    return (tables.select(*keys, "row_no", F.col("cells")[0].alias("label"), F.posexplode(pairs).alias("at", "cell"))
            .select(*keys, "row_no", (F.col("at") + 1).alias("col_no"), "label", F.col("cell.period").alias("period"),
                    F.col("cell.value").alias("value")))
