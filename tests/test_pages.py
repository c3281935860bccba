"""Page tables and reshaping on small pages."""

import random

import pytest
from pyspark.sql import functions as F

from tallybook.functions.text import clean_number, decode_references, normalise_label
from tallybook.operators.statements import clean_cells, melt_periods, pivot_cells, transpose, union_statements
from tallybook.plans.jobs import load_statements, statement_cells
from tallybook.sources.pages import page_items, page_tables, table_cells, wide_rows

PAGE = """<html><script>"<section id='profit-loss'><table>"</script>
<section id="other"><table><tr><th>x</th></tr><tr><td>no</td></tr></table></section>
<SECTION class="card" data-id='profit-loss' id='profit-loss'><!-- <table><tr></tr></table> -->
<table class="t"><thead><tr><th> </th><th>Mar 2020</th><th>TTM</th></tr></thead>
<tr><td><b>Sales&nbsp;<span>+</span></b></td><td>1,234</td><td> 1,500
</td></tr>
<tr><td>OPM %</td><td>12%</td><td>15%</td></tr>
<tr><td>Tax %</td><td></td><td>-3%</td></tr>
<tr><td>bad</td></tr></table>
<table><tr><th>second</th></tr></table></SECTION></html>"""


def pages(spark, *html):
    return spark.createDataFrame([(f"C{i}" if i else "ACME", h) for i, h in enumerate(html)],
                                 "company_name string, html string")


def test_statement_of_one_page(spark):
    out = load_statements(pages(spark, PAGE), "profit-loss", ["sales", "opm_percent", "tax_percent"]).orderBy("date").collect()
    assert [r.asDict() for r in out] == [
        {"date": "Mar 2020", "sales": 1234.0, "opm_percent": 12.0, "tax_percent": 0.0, "company_name": "ACME"},
        {"date": "TTM", "sales": 1500.0, "opm_percent": 15.0, "tax_percent": -3.0, "company_name": "ACME"}]


def test_rows_headers_and_width(spark):
    found = page_tables(pages(spark, PAGE), ["company_name"], "profit-loss").orderBy("row_no").collect()
    assert [r.headers for r in found] == [["Narration", "Mar 2020", "TTM"]] * 3
    assert [r.cells for r in found] == [["Sales +", "1,234", "1,500"], ["OPM %", "12%", "15%"], ["Tax %", "", "-3%"]]
    wide = wide_rows(page_tables(pages(spark, PAGE), ["company_name"], "profit-loss"), ["company_name"],
                     ["TTM", "Mar 1999"]).orderBy("row_no").collect()
    assert [tuple(r)[2:] for r in wide] == [("Sales +", "1,500", None), ("OPM %", "15%", None), ("Tax %", "-3%", None)]


def test_blank_headers_are_numbered(spark):
    html = ('<section id="s"><table><tr><th></th><th></th><th>B</th></tr>'
            "<tr><td>a</td><td>1</td><td>2</td></tr></table></section>")
    assert page_tables(pages(spark, html), ["company_name"], "s").collect()[0].headers == ["Narration", "Column_1", "B"]


@pytest.mark.parametrize("html", [None, "", "<p>no section</p>", '<section id="s"><p>no table</p></section>',
                                  '<section id="s"><table></table></section>',
                                  '<section id="s"><table><tr><th>h</th></tr></table></section>',
                                  '<section id="s"><table><tr><td>h</td></tr><tr><td>x</td></tr></table></section>'])
def test_pages_without_rows(spark, html):
    assert page_tables(pages(spark, html), ["company_name"], "s").count() == 0


def test_very_long_page(spark):
    """Patterns must not recurse: three megabytes of text around and inside the table."""
    filler = "lorem < ipsum & " * 200_000
    html = (f'<p>{filler}</p><section id="s"><table><tr><th>n</th><th>v</th></tr>'
            f"<tr><td>a</td><td>{filler}</td></tr></table></section>{filler}")
    row = page_tables(pages(spark, html), ["company_name"], "s").collect()[0]
    assert row.cells[0] == "a" and row.cells[1].startswith("lorem")
    items = "".join(f"<li>{i}</li>" for i in range(50_000))
    assert page_items(pages(spark, f"<ul>{items}</ul>"), ["company_name"]).count() == 50_000


def test_references(spark):
    def decoded(text):
        return spark.range(1).select(decode_references(F.lit(text)).alias("t")).collect()[0].t

    assert decoded("a &amp;lt; b &#8377;&#x20B9; &#0; &#55296; &#x110000; &#99999999999; &nope; & ;&") \
        == "a &lt; b \u20b9\u20b9 \ufffd \ufffd \ufffd \ufffd &nope; & ;&"
    assert decoded("&#0000000000065;&#x0000000000041;&eacute;&rarr;&Sigma;&#150;&amp&ampx;&copy2&notit;&#65 &verbar;&equals;") \
        == "AA\u00e9\u2192\u03a3\u2013&&x;\u00a92\u00acit;A |="
    assert decoded("&euro;5&nbsp;&ndash;&#38;amp;") == "\u20ac5\u00a0\u2013&amp;"


def test_numbers_and_labels(spark):
    texts = ["1,234.50", "12%", "-3", "+4", ".5", "5.", "1e3", "", " 7 ", "1f", "1.0d", "abc", "0x10", "--1",
             "1,23,456", "inf", None]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string") \
        .select("i", clean_number(F.col("t")).alias("n")).orderBy("i").collect()
    assert [r.n for r in got] == [1234.5, 12.0, -3.0, 4.0, 0.5, 5.0, 1000.0, None, 7.0, None, None, None, None, None,
                                  123456.0, float("inf"), None]
    labels = {"Sales +": "sales", "Sales +": "sales_", "OPM %": "opm_percent", " EPS in Rs": "_eps_in_rs",
              "Dividend Payout %": "dividend_payout_percent"}
    df = spark.createDataFrame([(k,) for k in labels], "t string").select("t", normalise_label(F.col("t")).alias("n"))
    assert {r.t: r.n for r in df.collect()} == labels


def test_transposing_twice_restores_the_table(spark):
    rng = random.Random(1)
    periods, items = [f"Mar {y}" for y in range(2001, 2006)], ["sales", "tax", "eps"]
    data = [(c, i, *[str(rng.randrange(1000)) for _ in periods]) for c in ("A", "B") for i in items]
    wide = spark.createDataFrame(data, ", ".join(f"`{n}` string" for n in ["company", "item", *periods]))
    tall = transpose(wide, ["company"], "item", periods, items)
    back = pivot_cells(melt_periods(tall, ["company"], "date", items), ["company"], periods)
    assert sorted((r.company, r.date, *[r[p] for p in periods]) for r in back.collect()) \
        == sorted((c, i, *map(float, v)) for c, i, *v in data)


def test_nothing_on_a_page_is_lost(spark):
    """Nested sections, two columns with one header, repeated and empty labels."""
    html = ('<section id="s"><section>x<section>y</section></section><p>note</p><table><tr><th></th><th>Mar 2020</th>'
            "<th>Mar 2020</th></tr><tr><td>Sales</td><td>1</td><td>2</td></tr><tr><td>Sales+</td><td>3</td><td>4</td></tr>"
            "<tr><td></td><td>5</td><td>6</td></tr></table></section><table><tr><th>n</th></tr></table>")
    cells = statement_cells(pages(spark, html), "s").orderBy("col_no", "row_no").collect()
    assert [(r.date, r.label, r.value) for r in cells] == [
        ("Mar 2020", "sales", 1.0), ("Mar 2020", "sales_2", 3.0), ("Mar 2020", "unnamed", 5.0),
        ("Mar 2020", "sales", 2.0), ("Mar 2020", "sales_2", 4.0), ("Mar 2020", "unnamed", 6.0)]
    wide = load_statements(pages(spark, html), "s", ["sales", "sales_2", "unnamed", "other"]).collect()
    assert sorted(tuple(r) for r in wide) == [("Mar 2020", 1.0, 3.0, 5.0, 0.0, "ACME"), ("Mar 2020", 2.0, 4.0, 6.0, 0.0, "ACME")]
    shown = wide_rows(page_tables(pages(spark, html), ["company_name"], "s"), ["company_name"], ["Mar 2020", "Mar 2020"])
    assert [tuple(r)[2:] for r in shown.orderBy("row_no").collect()] == [("Sales", "1", "2"), ("Sales+", "3", "4"), ("", "5", "6")]


def test_repeated_labels_without_positions(spark):
    cells = spark.createDataFrame([("A", 0, 1, "x", "p", "2"), ("A", 0, 1, "x", "p", "1")],
                                  "k string, row_no int, col_no int, label string, period string, value string")
    row = pivot_cells(clean_cells(cells, ["k"]), ["k"], ["x", "x_2"]).collect()[0]
    assert (row.x, row.x_2) == (1.0, 2.0)


def test_schema_drift(spark):
    a = spark.createDataFrame([("d1", 1.0)], "date string, a double")
    b = spark.createDataFrame([(2.0, "d2")], "b double, date string")
    assert sorted(tuple(r) for r in union_statements([a, b]).select("date", "a", "b").collect()) \
        == [("d1", 1.0, 0.0), ("d2", 0.0, 2.0)]
