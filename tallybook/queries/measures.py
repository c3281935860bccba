"""Measure queries: summary row, complete rows, ratios, growth."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallybook.functions.times import period_label
from tallybook.operators.measures import (append_summary, complete_rows, summary_last, with_growth,
                                          with_ratios)
from tallybook.queries.inputs import hundredths, sql_ratio, sql_round, table

ORDER_MEASURES = ["orders", "total", "largest"]


def _customer_orders(spark, sf_dir):
    """Order measures of every customer; null for customers without orders."""
    sums = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).cast("double").alias("orders"),
        (F.sum(hundredths("o_totalprice")) / 100).alias("total"),
        F.max("o_totalprice").alias("largest"))
    names = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("date"))
    return names.join(sums, "c_custkey", "left").drop("c_custkey")


def summary_average_row(spark, sf_dir):
    summed = append_summary(_customer_orders(spark, sf_dir), "date", ORDER_MEASURES)
    return summary_last(complete_rows(summed, ["date", *ORDER_MEASURES]), F.col("date"))


def complete_rows_only(spark, sf_dir):
    """Users and customers side by side; only keys known to both with all measures stay."""
    events = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("id")).agg(
        F.count(F.lit(1)).alias("events"),
        F.max(F.when(F.col("event_type") == "purchase", F.col("value"))).alias("largest_purchase"))
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"))
    return complete_rows(events.join(customers, "id", "outer"), ["id", "events", "largest_purchase", "balance"])


def _yearly(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("supplier"), F.year("l_shipdate").alias("year"),
        hundredths("l_extendedprice").alias("price"), hundredths("l_discount").alias("discount"),
        hundredths("l_tax").alias("tax"), "l_quantity", "l_returnflag")
    price, discount, tax = F.col("price"), F.col("discount"), F.col("tax")
    returned = (F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 48)
    return lines.groupBy("supplier", "year").agg(
        (F.sum(price) / 100).alias("sales"),
        (F.sum(price * (100 - discount)) / 10000).alias("operating_profit"),
        (F.sum(price * tax) / 10000).alias("net_profit"),
        (F.sum(price * discount) / 10000).alias("profit_before_tax"),
        (F.sum(tax) / 100).alias("tax_percent"),
        (F.sum(discount) / 100).alias("dividend_payout_percent"),
        F.max("l_quantity").alias("eps_in_rs"),
        F.sum(F.when(returned, F.col("l_quantity")).otherwise(0.0)).alias("interest"))


def kpi_ratios(spark, sf_dir):
    return with_ratios(_yearly(spark, sf_dir))


def yoy_growth(spark, sf_dir):
    yearly = _yearly(spark, sf_dir).select("supplier", "year", "sales", "net_profit")
    return with_growth(yearly, ["supplier"], [F.col("year")],
                       {"yoy_sales_growth": "sales", "yoy_net_profit_growth": "net_profit"}) \
        .orderBy("supplier", "year")


def yoy_growth_label_order(spark, sf_dir):
    """Growth per supplier and month with the months in label order (April first)."""
    monthly = table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_suppkey").alias("supplier"), F.trunc("l_shipdate", "month").alias("month")) \
        .agg((F.sum(hundredths("l_extendedprice")) / 100).alias("sales"))
    labelled = monthly.select("supplier", period_label(F.col("month")).alias("date"), "sales")
    return with_growth(labelled, ["supplier"], [F.col("date")], {"sales_growth": "sales"})


def growth_by_day(spark, sf_dir):
    """Growth between a supplier's shipping days: long series, cut by year into separate groups."""
    daily = table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_suppkey").alias("supplier"), F.to_date("l_shipdate").alias("day")) \
        .agg((F.sum(hundredths("l_extendedprice")) / 100).alias("sales"))
    return with_growth(daily, ["supplier"], [F.col("day")], {"sales_growth": "sales"}, bucket=F.year("day"))


QUERIES = {f.__name__: f for f in (summary_average_row, complete_rows_only, kpi_ratios, yoy_growth,
                                   yoy_growth_label_order, growth_by_day)}

_P, _D, _T, _Q = (f"CAST(l_{c} AS DECIMAL(18,2))" for c in ("extendedprice", "discount", "tax", "quantity"))
_YEARLY = f"""y AS (
SELECT l_suppkey AS supplier, CAST(year(l_shipdate) AS INTEGER) AS year,
       CAST(sum({_P}) AS DOUBLE) AS sales,
       CAST(sum({_P} * (1 - {_D})) AS DOUBLE) AS operating_profit,
       CAST(sum({_P} * {_T}) AS DOUBLE) AS net_profit,
       CAST(sum({_P} * {_D}) AS DOUBLE) AS profit_before_tax,
       CAST(sum({_T}) AS DOUBLE) AS tax_percent,
       CAST(sum({_D}) AS DOUBLE) AS dividend_payout_percent,
       max(l_quantity) AS eps_in_rs,
       CAST(sum(CASE WHEN l_returnflag = 'R' AND l_quantity >= 48 THEN {_Q} ELSE 0 END) AS DOUBLE) AS interest
FROM lineitem GROUP BY 1, 2)"""


def _growth(measure: str, name: str, by: str, order: str) -> str:
    before = f"lag({measure}) OVER (PARTITION BY {by} ORDER BY {order})"
    return f"{sql_ratio(f'{measure} - {before}', before, ' * 100')} AS {name}"


def _average(measure: str) -> str:
    return f"{sql_round(f'avg({measure})')} AS {measure}"


ORACLE = {
    "summary_average_row": f"""WITH s AS (
SELECT o_custkey, CAST(count(*) AS DOUBLE) AS orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, max(o_totalprice) AS largest
FROM orders GROUP BY o_custkey),
d AS (SELECT c_name AS date, orders, total, largest FROM customer LEFT JOIN s ON c_custkey = o_custkey),
u AS (SELECT * FROM d UNION ALL
      SELECT 'Average', {', '.join(_average(m) for m in ORDER_MEASURES)} FROM d)
SELECT * FROM u WHERE date IS NOT NULL AND orders IS NOT NULL AND total IS NOT NULL AND largest IS NOT NULL""",
    "complete_rows_only": """
SELECT id, events, largest_purchase, c_acctbal AS balance
FROM (SELECT user_id AS id, count(*) AS events, max(value) FILTER (event_type = 'purchase') AS largest_purchase
      FROM events GROUP BY user_id) e
JOIN customer ON c_custkey = id
WHERE largest_purchase IS NOT NULL AND c_acctbal IS NOT NULL""",
    "kpi_ratios": f"""WITH {_YEARLY}
SELECT *, {sql_ratio('net_profit', 'sales', ' * 100')} AS net_profit_margin,
       {sql_ratio('operating_profit', 'sales', ' * 100')} AS operating_profit_margin,
       {sql_round('tax_percent * profit_before_tax / 100')} AS tax_amount,
       {sql_round('dividend_payout_percent * eps_in_rs / 100')} AS dividend_yield,
       {sql_ratio('operating_profit', 'interest')} AS interest_coverage_ratio
FROM y""",
    "yoy_growth": f"""WITH {_YEARLY}
SELECT supplier, year, sales, net_profit,
       {_growth('sales', 'yoy_sales_growth', 'supplier', 'year')},
       {_growth('net_profit', 'yoy_net_profit_growth', 'supplier', 'year')}
FROM y""",
    "yoy_growth_label_order": f"""WITH m AS (
SELECT l_suppkey AS supplier, strftime(l_shipdate, '%b %Y') AS date, CAST(sum({_P}) AS DOUBLE) AS sales
FROM lineitem GROUP BY 1, 2)
SELECT *, {_growth('sales', 'sales_growth', 'supplier', 'date')} FROM m""",
    "growth_by_day": f"""WITH m AS (
SELECT l_suppkey AS supplier, CAST(l_shipdate AS DATE) AS day, CAST(sum({_P}) AS DOUBLE) AS sales
FROM lineitem GROUP BY 1, 2)
SELECT *, {_growth('sales', 'sales_growth', 'supplier', 'day')} FROM m""",
}
