"""Page and reshape queries: list items, tables, transpose, union."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallybook.operators.statements import transpose, union_statements
from tallybook.plans.jobs import load_statements, load_with_notices, statement_cells
from tallybook.queries.inputs import hundredths, table
from tallybook.sources.nested import page_elements
from tallybook.sources.pages import page_items, page_tables, table_cells, wide_rows

#: The fiscal years and calendar years of the line items and orders.
YEARS = list(range(1995, 2003))
LABELS = {"profit-loss": ["sales", "sales_2", "sales_3", "units", "lines_percent", "tax_&_other", "unnamed", "unnamed_2"],
          "balance-sheet": ["total_assets", "debt_₹"]}
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def html_list_items(spark, sf_dir):
    return page_items(table(spark, sf_dir, "pages"), ["page_id"])


def _row(label: str, years, cell, more: str = "") -> list:
    return [F.lit(f'<tr class="row"><td class="text">{label}</td>'),
            F.array_join(F.transform(years, lambda y: F.concat(F.lit("<td> "), cell(y), F.lit("</td>"))), ""),
            F.lit(f"{more}</tr>")]


def statement_pages(spark, sf_dir):
    """A page per supplier with two statement tables, a column per fiscal year, from the line items."""
    year = F.year(F.add_months("l_shipdate", 9))
    sums = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", year.alias("year")).agg(
        (F.sum(hundredths("l_extendedprice")) / 100).alias("sales"), F.sum("l_quantity").alias("units"),
        F.count(F.lit(1)).alias("lines"))
    # One struct per fiscal year: the array stays as short as the calendar.
    suppliers = sums.groupBy("l_suppkey").agg(
        F.sort_array(F.collect_list(F.struct("year", "sales", "units", "lines"))).alias("years"))
    years = F.col("years")
    titles = F.array_join(F.transform(years, lambda y: F.concat(
        F.lit("<th data-x='1'>\n Mar "), y["year"].cast("string"), F.lit("</th>"))), "")

    def head(*more):
        return [F.lit("<thead><tr><th></th>"), titles, *map(F.lit, more), F.lit("</tr></thead><tbody>")]

    money_text = lambda c: lambda y: F.format_number(y[c], 2)
    again = "<td>7</td>"  # the column under the header that stands there twice
    profit = [
        *_row('<button>Sales<span>&plus;</span></button>', years, money_text("sales"), again),
        *_row("Units", years, money_text("units"), again),
        *_row("Lines %", years, lambda y: F.concat(y["lines"].cast("string"), F.lit("%")), again),
        *_row("Tax &amp Other", years, lambda y: F.lit(""), again),
        *_row("Sales", years, lambda y: F.lit("&#0000000000049;&eacute;"), again),
        *_row("", years, lambda y: F.lit("2"), again), *_row(" ", years, lambda y: F.lit("3"), again),
        *_row("Sales 2", years, lambda y: F.lit("n/a"), "<td>4</td>"),
        F.lit("<tr><td>short</td></tr>")]
    balance = [*_row("Total Assets", years, money_text("units")),
               *_row("Debt &#8377;", years, lambda y: F.concat(F.lit("-"), y["lines"].cast("string")))]
    html = F.concat(
        F.lit('<!DOCTYPE html><html><body><script>var t="<section id=\'profit-loss\'>";</script>'),
        F.lit('<section class="card" id="balance-sheet"><table>'), *head(), *balance,
        F.lit('</tbody></table></section><section id="profit-loss" class="card"><h2>P</h2><!-- <table> -->'),
        F.lit('<section class="note"><section>inner</section><p>note</p></section><div><TABLE class="data">'),
        *head("<th>Mar 2001</th>"), *profit,
        F.lit("</tbody></TABLE></div><table><tr><td>second</td></tr></table></section></body></html>"))
    return suppliers.select(F.concat(F.lit("company-"), F.col("l_suppkey").cast("string")).alias("company_name"),
                            html.alias("html"))


def html_table_rows(spark, sf_dir):
    tables = page_tables(statement_pages(spark, sf_dir), ["company_name"], "profit-loss")
    return table_cells(tables, ["company_name"])


def html_wide_rows(spark, sf_dir):
    tables = page_tables(statement_pages(spark, sf_dir), ["company_name"], "balance-sheet")
    return wide_rows(tables, ["company_name"], [f"Mar {y}" for y in YEARS], strict=True)


def html_statement_load(spark, sf_dir):
    return load_statements(statement_pages(spark, sf_dir), "profit-loss", LABELS["profit-loss"])


def html_statement_cells(spark, sf_dir):
    """The same table in long form, which takes no list of line items."""
    return statement_cells(statement_pages(spark, sf_dir), "profit-loss")


def html_balance_sheet_load(spark, sf_dir):
    return load_statements(statement_pages(spark, sf_dir), "balance-sheet", LABELS["balance-sheet"])


def load_notices(spark, sf_dir):
    """Per company what the load of the profit tables left out."""
    return load_with_notices(statement_pages(spark, sf_dir), "profit-loss", LABELS["profit-loss"])[1]


def nested_pages(spark, sf_dir):
    """A page per region: a table with the nations' suppliers in tables in its cells, and a list with lists in its items."""
    supplier = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(
        F.sort_array(F.collect_list(F.struct("s_suppkey", "s_name"))).alias("suppliers"))
    nation = table(spark, sf_dir, "nation").join(supplier, "n_nationkey", "left").groupBy("n_regionkey").agg(
        F.sort_array(F.collect_list(F.struct("n_name", F.coalesce("suppliers", F.array()).alias("s")))).alias("nations"))
    row = "concat('<tr><td>', s.s_suppkey, '</td><td>', s.s_name, '</td></tr>')"
    cell = f"concat('<tr><td>', n.n_name, '<table>', array_join(transform(n.s, s -> {row}), ''), '</table> &amp; after</td><td>x')"
    item = ("concat('<li>', n.n_name, '<ul><li>', array_join(transform(n.s, s -> s.s_name), '<li>'), '</ul> <b>after</b>')")
    html = F.concat(F.lit("<html><body><p>before</p><table><tr><th>Nation<th>X"), F.expr(f"array_join(transform(nations, n -> {cell}), '')"),
                    F.lit("</table><ol>"), F.expr(f"array_join(transform(nations, n -> {item}), '')"), F.lit("</ol></body></html>"))
    return nation.select("n_regionkey", html.alias("html"))


def html_nested(spark, sf_dir):
    """Cells and items with their depth, place, own text, and the text of the cell or item that they stand in."""
    found = page_elements(nested_pages(spark, sf_dir), ["n_regionkey"]).where("kind in ('cell', 'item', 'row', 'table', 'list')")
    up = found.select("n_regionkey", F.col("element_no").alias("parent_no"), F.col("parent_no").alias("next_no"), "kind", "text")
    # An item stands in a list in an item; a cell in a row in a table in a cell.
    link = {"item": 2, "cell": 3}
    parts = []
    for kind, steps in link.items():
        part = found.where(F.col("kind") == kind).select("n_regionkey", "kind", "depth", "position", "text", "parent_no")
        for step in range(steps):
            above = up.select("n_regionkey", "parent_no", F.col("next_no").alias("_next"), F.col("text").alias("inside"))
            part = part.drop("inside").join(above, ["n_regionkey", "parent_no"], "left").drop("parent_no") \
                .withColumnRenamed("_next", "parent_no")
        parts.append(part.drop("parent_no"))
    return parts[0].unionByName(parts[1])


def _known_year(year):
    """The year, which has to be one that the result has a column for."""
    return F.when(year.isin(YEARS), year).otherwise(F.raise_error(F.concat(F.lit("no column for "), year.cast("string"))).cast("int"))


def transpose_statement(spark, sf_dir):
    """Order values per nation, a row per priority and a text column per year, transposed and cleaned."""
    priority = F.concat(F.col("o_orderpriority"), F.lit(" Orders %"))
    totals = table(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderpriority",
                                                    _known_year(F.year("o_orderdate")).alias("year")) \
        .agg(F.sum(hundredths("o_totalprice")).alias("total"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    cells = [F.concat(F.format_number(F.sum(F.when(F.col("year") == y, F.col("total"))) / 100, 2), F.lit("%"))
             .alias(f"Mar {y}") for y in YEARS]
    wide = totals.join(customers, "o_custkey").groupBy("c_nationkey", priority.alias("Narration")).agg(*cells)
    labels = [p.lower().replace(" ", "_") + "_orders_percent" for p in PRIORITIES]
    return transpose(wide, ["c_nationkey"], "Narration", [f"Mar {y}" for y in YEARS], labels)


def union_schema_drift(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_custkey").alias("customer"))
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("supplier"))
    return union_statements([customers, suppliers])


QUERIES = {f.__name__: f for f in (html_list_items, html_table_rows, html_wide_rows, html_statement_load, html_statement_cells, load_notices, html_nested,
                                   html_balance_sheet_load, transpose_statement, union_schema_drift)}

_SUMS = """s AS (
SELECT l_suppkey, year(l_shipdate) + CASE WHEN month(l_shipdate) >= 4 THEN 1 ELSE 0 END AS year,
       sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS sales, sum(CAST(l_quantity AS DECIMAL(18,2))) AS units,
       count(*) AS lines
FROM lineitem GROUP BY 1, 2)"""
_TEXT = "format('{{:,.2f}}', CAST({} AS DOUBLE))".format
#: The cells of the first table as texts, and with column names and numbers.
_CELLS = f"""shown AS (
SELECT 'company-' || l_suppkey AS company_name, CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY year) AS INTEGER) AS col_no,
       'Mar ' || year AS period, {_TEXT('sales')} AS v1, {_TEXT('units')} AS v2, lines || '%' AS v3, '' AS v4, '1é' AS v5,
       '2' AS v6, '3' AS v7, 'n/a' AS v8 FROM s
UNION ALL
SELECT 'company-' || l_suppkey, CAST(count(*) + 1 AS INTEGER), 'Mar 2001', '7', '7', '7', '7', '7', '7', '7', '4'
FROM s GROUP BY l_suppkey),
cells AS (SELECT company_name, CAST(row_no AS INTEGER) AS row_no, col_no, label, period,
       CASE row_no WHEN 1 THEN v1 WHEN 2 THEN v2 WHEN 3 THEN v3 WHEN 4 THEN v4 WHEN 5 THEN v5 WHEN 6 THEN v6 WHEN 7 THEN v7 ELSE v8 END AS value
FROM shown, (VALUES (1, 'Sales+'), (2, 'Units'), (3, 'Lines %'), (4, 'Tax & Other'), (5, 'Sales'), (6, ''), (7, ''), (8, 'Sales 2')) r(row_no, label)),
named AS (SELECT company_name, row_no, col_no, period, TRY_CAST(replace(replace(value, ',', ''), '%', '') AS DOUBLE) AS number,
       CASE row_no WHEN 1 THEN 'sales' WHEN 2 THEN 'units' WHEN 3 THEN 'lines_percent' WHEN 4 THEN 'tax_&_other'
                   WHEN 5 THEN 'sales_3' WHEN 6 THEN 'unnamed' WHEN 7 THEN 'unnamed_2' ELSE 'sales_2' END AS name FROM cells)"""
_LABELS = [p.lower().replace(" ", "_") + "_orders_percent" for p in PRIORITIES]
_PRIORITY_SUMS = ",\n".join(
    f"""coalesce(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderpriority = '{p}') AS DOUBLE), 0)
    AS "{label}" """ for p, label in zip(PRIORITIES, _LABELS))
_YEAR_ROWS = ", ".join(f"({y})" for y in YEARS)


def _wide_cells(expression: str) -> str:
    return ", ".join(f"max(CASE WHEN year = {y} THEN {expression} END) AS \"Mar {y}\"" for y in YEARS)


ORACLE = {
    "html_list_items": r"""WITH v AS (
SELECT page_id, regexp_replace(html, '<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'gis') AS html
FROM pages),
i AS (SELECT page_id, unnest(regexp_extract_all(html, '<li\b[^>]*>(.*?)</li\s*>', 1, 'is')) AS item,
             unnest(range(1, 1 + len(regexp_extract_all(html, '<li\b[^>]*>(.*?)</li\s*>', 1, 'is')))) AS position
      FROM v)
SELECT page_id, CAST(position AS INTEGER) AS position,
       trim(replace(replace(replace(replace(replace(regexp_replace(item, '<[^>]*>', '', 'g'),
            '&copy;', '©'), '&middot;', '·'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')) AS item
FROM i""",
    "html_table_rows": f"""WITH {_SUMS}, {_CELLS}
SELECT company_name, row_no, col_no, label, period, value FROM cells""",
    "html_wide_rows": f"""WITH {_SUMS}
SELECT 'company-' || l_suppkey AS company_name, 1 AS row_no, 'Total Assets' AS "Narration",
       {_wide_cells(_TEXT('units'))} FROM s GROUP BY l_suppkey
UNION ALL
SELECT 'company-' || l_suppkey, 2, 'Debt ' || chr(8377), {_wide_cells("'-' || lines")} FROM s GROUP BY l_suppkey""",
    "html_statement_load": f"""WITH {_SUMS}, {_CELLS}
SELECT period AS date, {', '.join(f"""coalesce(max(number) FILTER (name = '{x}'), 0) AS "{x}" """ for x in LABELS["profit-loss"])},
       company_name FROM named GROUP BY company_name, col_no, period""",
    "html_statement_cells": f"""WITH {_SUMS}, {_CELLS}
SELECT company_name, period AS date, col_no, row_no, name AS label, number AS value FROM named""",
    "load_notices": f"""WITH {_SUMS}, {_CELLS}
SELECT company_name, CAST(9 AS BIGINT) AS table_rows, CAST(1 AS BIGINT) AS other_width,
       count(*) FILTER (value <> '' AND number IS NULL) AS no_number
FROM (SELECT c.company_name, c.value, TRY_CAST(replace(replace(c.value, ',', ''), '%', '') AS DOUBLE) AS number FROM cells c)
GROUP BY company_name""",
    "html_nested": """
WITH n AS (SELECT n_regionkey, n_nationkey, n_name, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_name) AS place FROM nation),
s AS (SELECT n.*, s_suppkey, s_name, row_number() OVER (PARTITION BY n_nationkey ORDER BY s_suppkey) AS nth
      FROM n JOIN supplier ON s_nationkey = n_nationkey),
all_rows AS (
SELECT n_regionkey, 'cell' AS kind, 1 AS depth, 1 AS position, n_name || '  & after' AS text, NULL AS inside FROM n
UNION ALL SELECT n_regionkey, 'cell', 1, 2, 'x', NULL FROM n
UNION ALL SELECT n_regionkey, 'cell', 2, 1, s_suppkey::VARCHAR, n_name || '  & after' FROM s
UNION ALL SELECT n_regionkey, 'cell', 2, 2, s_name, n_name || '  & after' FROM s
UNION ALL SELECT n_regionkey, 'item', 1, place, n_name || '  after', NULL FROM n
UNION ALL SELECT n_regionkey, 'item', 2, nth, s_name, n_name || '  after' FROM s
UNION ALL SELECT n_regionkey, 'item', 2, 1, '', n_name || '  after' FROM n WHERE n_nationkey NOT IN (SELECT n_nationkey FROM s))
SELECT n_regionkey, kind, CAST(depth AS INTEGER) AS depth, CAST(position AS INTEGER) AS position, text, inside FROM all_rows""",
    "html_balance_sheet_load": f"""WITH {_SUMS}
SELECT 'Mar ' || year AS date, CAST(units AS DOUBLE) AS total_assets, CAST(-lines AS DOUBLE) AS "debt_₹",
       'company-' || l_suppkey AS company_name FROM s""",
    "transpose_statement": f"""WITH n AS (
SELECT DISTINCT c_nationkey FROM orders JOIN customer ON c_custkey = o_custkey),
g AS (SELECT c_nationkey, year(o_orderdate) AS year, {_PRIORITY_SUMS}
      FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2)
SELECT 'Mar ' || y.year AS date, {', '.join(f'coalesce("{x}", 0) AS "{x}"' for x in _LABELS)}, n.c_nationkey
FROM n CROSS JOIN (VALUES {_YEAR_ROWS}) y(year)
LEFT JOIN g ON g.c_nationkey = n.c_nationkey AND g.year = y.year""",
    "union_schema_drift": """
SELECT c_name AS name, c_acctbal AS balance, c_custkey AS customer, 0::BIGINT AS supplier FROM customer
UNION ALL SELECT s_name, s_acctbal, 0, s_suppkey FROM supplier""",
}
