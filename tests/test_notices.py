"""Counts of what a job leaves out, in batch and stream, and nested tables and lists."""

import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tallybook.operators.bars import fiscal_year_bars
from tallybook.operators.changes import flatten_changes
from tallybook.operators.notices import watch_changes, years_without_bars
from tallybook.operators.statements import clean_cells, pivot_cells
from tallybook.plans import jobs
from tallybook.schemas import BAR_SCHEMA, statement_schema
from tallybook.session import scratch_dir
from tallybook.sources.changes import cdc_source
from tallybook.sources.nested import elements, page_elements

KEYS = ["date", "company_name"]
LOG = ['{"payload": {"after": {"date": "Mar 2014", "company_name": "A", "sales": 1.0}, "source": {"ts_ms": 1}}}',
       '{"payload": {"before": {"date": "Mar 2014", "company_name": "A"}, "source": {"ts_ms": 2}}}', "garbage", "{}"]
PAGE = ("<section id='s'><table><tr><th></th><th>Mar 2020</th><th>TTM</th></tr><tr><td>Sales</td><td>1,234</td><td>n/a</td></tr>"
        "<tr><td>Tax %</td><td></td><td>-3%</td></tr><tr><td>bad</td></tr></table></section>")


def test_messages_are_counted_by_the_job_that_reads_them(spark):
    log, seen = spark.createDataFrame([(m,) for m in LOG], "value string"), Observation("log")
    nothing = spark.createDataFrame([], statement_schema(KEYS))
    assert jobs.statement_kpis(log, nothing, notices=seen).count() == 0
    assert seen.get == {"rows": 4, "upserts": 1, "deletes": 1, "unreadable": 2}


def test_messages_are_counted_per_batch_of_a_stream(spark):
    base = scratch_dir(spark, "watched")
    for part in (LOG[:1], LOG[1:]):
        spark.createDataFrame([(m,) for m in part], "value string").coalesce(1).write.mode("append").text(f"{base}/in")
    source = cdc_source(spark, "text", {"path": f"{base}/in", "maxFilesPerTrigger": "1"}, streaming=True)
    flat = watch_changes(flatten_changes(source, statement_schema(KEYS), KEYS), KEYS, "log")
    query = flat.writeStream.format("noop").option("checkpointLocation", f"{base}/c").trigger(availableNow=True).start()
    query.awaitTermination()
    counts = [p.observedMetrics["log"].asDict() for p in query.recentProgress if "log" in p.observedMetrics]
    assert sum(c["rows"] for c in counts) == 4 and sum(c["unreadable"] for c in counts) == 2 and len(counts) >= 2


def test_pages_are_counted_by_their_load(spark):
    pages, seen = spark.createDataFrame([("A", PAGE), ("B", "<p>none</p>"), ("C", None)], "company_name string, html string"), Observation("p")
    assert jobs.load_statements(pages, "s", ["sales"], notices=seen).count() == 2
    assert seen.get == {"rows": 3, "other_width": 1}
    loaded, notices = jobs.load_with_notices(pages, "s", ["sales", "tax_percent"])
    assert sorted((r.date, r.sales, r.tax_percent) for r in loaded.collect()) == [("Mar 2020", 1234.0, 0.0), ("TTM", 0.0, -3.0)]
    assert sorted(map(tuple, notices.collect())) == [("A", 3, 1, 1), ("B", 0, 0, 0), ("C", 0, 0, 0)]
    for df in (loaded, notices):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "table-rows" in plan and plan.count("regexp_extract") == 0 or df is notices


def test_years_without_bars(spark):
    rows = [("A", f"{y}-05-02", 1.0, 1.0, 1.0, 1.0, 1) for y in (2012, 2014)]
    bars = spark.createDataFrame(rows, "company string, date string, open double, high double, low double, close double, volume long") \
        .withColumn("date", F.to_date("date")).select(BAR_SCHEMA.names)
    names = spark.createDataFrame([("A",), ("B",)], "company string")
    yearly = fiscal_year_bars(bars, ["company"], "date", 2013, 2015)
    assert sorted(map(tuple, years_without_bars(yearly, names, ["company"], 2013, 2015).collect())) == [
        ("A", 2014), ("B", 2013), ("B", 2014), ("B", 2015)]


CELLS = "company string, row_no int, col_no int, label string, period string, value string"


def named(spark, *labels):
    rows = [("A", i, 1, label, "Mar 2020", str(i)) for i, label in enumerate(labels, 1)]
    return clean_cells(spark.createDataFrame(rows, CELLS), ["company"])


@pytest.mark.parametrize("labels, expected", [
    (["Sales", "Sales", "Sales 2"], ["sales", "sales_3", "sales_2"]),
    (["Sales 2", "Sales", "Sales", "Sales 2", "Sales"], ["sales_2", "sales", "sales_3", "sales_2_2", "sales_4"]),
    (["", "", "unnamed", "Unnamed 2"], ["unnamed", "unnamed_3", "unnamed_4", "unnamed_2"]),
    (["a", "a 2", "a 3", "a", "a", "a 2 2", "a 2"], ["a", "a_2", "a_3", "a_4", "a_5", "a_2_2", "a_2_3"]),
])
def test_no_two_cells_of_a_column_share_a_name(spark, labels, expected):
    assert [r.label for r in sorted(named(spark, *labels).collect(), key=lambda r: r.row_no)] == expected


def test_names_are_different_whatever_the_labels(spark):
    rng = random.Random(7)
    for _ in range(3):
        labels = [rng.choice(["a", "a 2", "a 3", "a 2 2", "b", "", "A+"]) for _ in range(40)]
        assert len({r.label for r in named(spark, *labels).collect()}) == 40


def test_a_label_that_stands_twice_fails_the_pivot(spark):
    cells = spark.createDataFrame([("A", 1, 1, "sales", "Mar 2020", 1.0), ("A", 2, 1, "sales", "Mar 2020", 2.0)],
                                  CELLS.replace("value string", "value double"))
    with pytest.raises(Exception, match="a label stands twice under Mar 2020"):
        pivot_cells(cells, ["company"], ["sales"]).collect()


def shown(html):
    return [(e[0], e[1], e[2], e[3], e[4], " ".join(e[5].split())) for e in elements(html)]


def test_tables_in_cells_and_lists_in_items():
    assert shown("<table><tr><td>a<table><tr><td>b</td></tr></table>c</td><td>d</td></tr></table>e") == [
        (1, 0, "table", 1, 1, ""), (2, 1, "row", 1, 1, ""), (3, 2, "cell", 1, 1, "a c"), (4, 3, "table", 2, 1, ""),
        (5, 4, "row", 2, 1, ""), (6, 5, "cell", 2, 1, "b"), (7, 2, "cell", 1, 2, "d")]
    assert shown("<ul><li>one<ol><li>two<li>three</ol>after<li>four</ul>") == [
        (1, 0, "list", 1, 1, ""), (2, 1, "item", 1, 1, "one after"), (3, 2, "list", 2, 1, ""), (4, 3, "item", 2, 1, "two"),
        (5, 3, "item", 2, 2, "three"), (6, 1, "item", 1, 2, "four")]


def test_missing_and_stray_ends():
    assert shown("<tr><td>x<td>y<tr><td>z") == [
        (1, 0, "row", 1, 1, ""), (2, 1, "cell", 1, 1, "x"), (3, 1, "cell", 1, 2, "y"), (4, 0, "row", 1, 2, ""), (5, 4, "cell", 1, 1, "z")]
    assert shown("</td><table><tr><td>a</table></tr></td><li>b</li></li></ul>")[-1] == (4, 0, "item", 1, 2, "b")
    # An item's end inside a table does not reach the list around it.
    assert shown("<ul><li>a<table><tr><td></li>b</td></tr></table>c</li></ul>")[1][5] == "a c"
    assert shown("") == [] and shown("plain") == []


def test_deep_and_long_pages_take_linear_time():
    deep = "<ul><li>" * 4000
    assert max(e[3] for e in elements(deep)) == 4000
    assert len(elements("<table>" + "<tr><td>x<td>y" * 50_000)) == 150_001


def test_elements_of_pages(spark):
    pages = spark.createDataFrame([(1, None, "k"), (2, "", "k"), (2, "<ul><li>&eacute;<!-- <li> --><b>b</b>", "k"), (None, "<li>x", "k")],
                                  "page_id int, html string, kind_ string")
    got = sorted(map(repr, map(tuple, page_elements(pages, ["page_id", "kind_"]).collect())))
    assert got == sorted(map(repr, [(2, "k", 1, 0, "list", 1, 1, ""), (2, "k", 2, 1, "item", 1, 1, "éb"), (None, "k", 1, 0, "item", 1, 1, "x")]))
    assert page_elements(pages.limit(0), ["page_id"]).count() == 0
