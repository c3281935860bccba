"""Ratios, growth, summary rows and bars on small fixtures."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallybook.functions.times import epoch_ms, fiscal_year, period_label, period_start
from tallybook.operators.bars import first_bar_from, fiscal_year_bars
from tallybook.operators.measures import (append_summary, complete_rows, summary_last, with_growth,
                                          with_previous, with_ratios)
from tallybook.schemas import BAR_SCHEMA, MEASURES, statement_schema

GROWTH = [("A", "Mar 2013", 10.0), ("A", "Mar 2014", 15.0), ("A", "Dec 2015", 30.0),
          ("B", "Mar 2014", 0.0), ("B", "Mar 2015", 5.0)]


def growth(spark, order):
    df = spark.createDataFrame(GROWTH, "company_name string, date string, sales double")
    out = with_growth(df, ["company_name"], order, {"g": "sales"})
    return {(r.company_name, r.date): r.g for r in out.collect()}


def test_growth_in_time_order(spark):
    assert growth(spark, [period_start(F.col("date")).asc_nulls_last()]) == {
        ("A", "Mar 2013"): None, ("A", "Mar 2014"): 50.0, ("A", "Dec 2015"): 100.0,
        ("B", "Mar 2014"): None, ("B", "Mar 2015"): None}


def test_growth_in_label_order(spark):
    got = growth(spark, [F.col("date")])
    assert [got["A", d] for d in ("Dec 2015", "Mar 2013", "Mar 2014")] == [None, -66.67, 50.0]


def test_bucketed_previous_row_equals_plain_window(spark):
    """One entity holds a third of the rows, another has gaps of whole buckets, one has a null name."""
    rng = random.Random(7)
    data = [("hot", d, rng.random()) for d in range(400)]
    data += [("gaps", d, rng.random()) for d in (3, 205, 206, 990)]
    data += [(None, d, rng.random()) for d in range(90, 120)]
    data += [(f"e{i}", d, rng.random()) for i in range(40) for d in rng.sample(range(400), 12)]
    df = spark.createDataFrame(data, "entity string, day int, v double")
    plain = with_previous(df, ["entity"], [F.col("day")], ["v"])
    cut = with_previous(df, ["entity"], [F.col("day")], ["v"], bucket=F.floor(F.col("day") / 50))
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, cut.collect()))


def test_ratios(spark):
    values = dict(zip(MEASURES, [0.0] * len(MEASURES)))
    values.update(sales=200.0, operating_profit=50.0, profit_before_tax=40.0, tax_percent=25.0, net_profit=30.0,
                  eps_in_rs=8.0, dividend_payout_percent=50.0)
    df = spark.createDataFrame([tuple(values[m] for m in MEASURES)], statement_schema([]))
    r = with_ratios(df).collect()[0]
    assert (r.net_profit_margin, r.operating_profit_margin, r.tax_amount, r.dividend_yield,
            r.interest_coverage_ratio) == (15.0, 25.0, 10.0, 4.0, None)


def test_summary_row(spark):
    df = spark.createDataFrame([("x", 10.0, 4.0), ("y", 20.0, None)], "date string, sales double, expenses double")
    columns = ["sales", "expenses"]
    out = summary_last(complete_rows(append_summary(df, "date", columns), ["date", *columns]))
    assert [tuple(r) for r in out.collect()] == [("x", 10.0, 4.0), ("Average", 15.0, 4.0)]
    empty = complete_rows(append_summary(df.limit(0), "date", columns), ["date", *columns])
    assert empty.count() == 0
    fine = spark.createDataFrame([("x", 0.014), ("y", 0.015)], "date string, sales double")
    assert append_summary(fine, "date", ["sales"]).filter("sort_key = 2").collect()[0].sales == 0.01


def test_complete_rows_keep_nan(spark):
    df = spark.createDataFrame([("x", float("nan")), ("y", None)], "date string, sales double")
    assert [r.date for r in complete_rows(df, ["date", "sales"]).collect()] == ["x"]


def bars(spark, data):
    rows = [("C", dt.date.fromisoformat(d), *map(float, p), v) for d, p, v in data]
    return spark.createDataFrame(rows, BAR_SCHEMA)


def test_fiscal_year_bars(spark):
    df = bars(spark, [("2012-04-02", (1, 5, 1, 4), 10), ("2012-12-31", (4, 9, 3, 8), 20),
                      ("2013-03-28", (8, 8, 2, 6), 30), ("2013-04-01", (6, 7, 6, 7), 40)])
    out = fiscal_year_bars(df, ["company"], "date").orderBy("date").collect()
    assert [tuple(r) for r in out] == [("Mar 2013", "C", 1.0, 9.0, 1.0, 6.0, 60), ("Mar 2014", "C", 6.0, 7.0, 6.0, 7.0, 40)]
    assert [r.date for r in fiscal_year_bars(df, ["company"], "date", 2014, 2014).collect()] == ["Mar 2014"]


def test_last_day_of_fiscal_year(spark):
    df = bars(spark, [("2013-03-31", (1, 1, 1, 1), 5), ("2013-03-30", (2, 2, 2, 2), 7)])
    assert fiscal_year_bars(df, ["company"], "date").collect()[0].volume == 12
    assert fiscal_year_bars(df, ["company"], "date", end_inclusive=False).collect()[0].volume == 7


def test_bars_without_ties_stay_in_hash_aggregation(spark):
    df = spark.createDataFrame([], BAR_SCHEMA)
    plan = fiscal_year_bars(df, ["company"], "date")._jdf.queryExecution().sparkPlan().toString()
    assert "SortAggregate" not in plan and plan.count("HashAggregate") == 2


def test_first_bar_from(spark):
    df = bars(spark, [("2013-02-27", (1, 1, 1, 1), 1), ("2013-03-04", (2, 2, 2, 2), 1), ("2014-04-02", (3, 3, 3, 3), 1)])
    out = first_bar_from(df, ["company"], "date", ["open"], 2013, 2015).orderBy("year").collect()
    assert [(r.year, str(r.bar_date), r.date, r.open) for r in out] == [
        (2013, "2013-03-04", "Mar 2013", 2.0), (2014, "2014-04-02", "Apr 2014", 3.0)]
    near = first_bar_from(df, ["company"], "date", ["open"], 2013, 2015, max_gap_days=10).collect()
    assert [r.year for r in near] == [2013]


def test_first_bar_against_brute_force(spark):
    rng = random.Random(3)
    days = {c: sorted(rng.sample(range(3000), n)) for c, n in (("A", 400), ("B", 3), ("C", 1), ("D", 40))}
    start = dt.date(2010, 1, 1)
    data = [(c, start + dt.timedelta(d), float(d), 0.0, 0.0, 0.0, 0) for c, ds in days.items() for d in ds]
    out = first_bar_from(spark.createDataFrame(data, BAR_SCHEMA), ["company"], "date", ["open"], 2010, 2020)
    expected = {}
    for c, ds in days.items():
        for year in range(2010, 2021):
            after = [start + dt.timedelta(d) for d in ds if start + dt.timedelta(d) >= dt.date(year, 3, 1)]
            if after:
                expected[c, year] = after[0]
    assert {(r.company, r.year): r.bar_date for r in out.collect()} == expected


def test_time_functions(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:07.179575' AS ts, DATE'2013-03-31' AS d")
    r = df.select(epoch_ms(F.col("ts")).alias("ms"), fiscal_year(F.col("d")).alias("fy"),
                  period_label(F.col("d")).alias("label"), period_start(F.lit("TTM")).alias("none"),
                  period_start(F.lit("Mar 2013")).alias("first")).collect()[0]
    assert (r.ms, r.fy, r.label, r.none, r.first) == (1704067207179, 2013, "Mar 2013", None, dt.date(2013, 3, 1))
