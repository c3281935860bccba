"""Bar queries: fiscal-year roll-up and forward as-of."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallybook.operators.bars import first_bar_from, fiscal_year_bars
from tallybook.plans.jobs import load_bars
from tallybook.queries.inputs import table

FIRST_YEAR, LAST_YEAR = 1996, 2001


def _daily_bars(spark, sf_dir):
    """A supplier's shipping day as a bar, each price by an aggregate of its own, without ties."""
    price, tax, cut = F.col("l_extendedprice"), F.col("l_tax"), F.col("l_discount")
    return table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_suppkey").alias("company"), F.col("l_shipdate").alias("day")).agg(
        F.min(price).alias("open"), F.max(price * (1 + tax)).alias("high"), F.min(price * (1 - cut)).alias("low"),
        F.max(price).alias("close"), F.sum("l_quantity").cast("long").alias("volume"))


def fy_ohlcv(spark, sf_dir):
    return fiscal_year_bars(_daily_bars(spark, sf_dir), ["company"], "day")


def fy_ohlcv_range_end_exclusive(spark, sf_dir):
    return fiscal_year_bars(_daily_bars(spark, sf_dir), ["company"], "day", FIRST_YEAR, LAST_YEAR, end_inclusive=False)


def fy_ohlcv_by_name(spark, sf_dir):
    bars = _daily_bars(spark, sf_dir).withColumnRenamed("day", "date")
    names = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("symbol"), F.col("s_name").alias("company"))
    return load_bars(bars, names=names)


def _asof(spark, sf_dir, **settings):
    """A customer's ordering day as a bar: first order and least value of the day."""
    days = table(spark, sf_dir, "orders").groupBy(
        F.col("o_custkey").alias("company"), F.col("o_orderdate").alias("day")).agg(
        F.min("o_orderkey").alias("o_orderkey"), F.min("o_totalprice").alias("price"))
    found = first_bar_from(days, ["company"], "day", ["o_orderkey", "price"], **settings)
    return found.withColumn("bar_date", F.to_date("bar_date"))


def asof_forward(spark, sf_dir):
    return _asof(spark, sf_dir)


def asof_forward_within_90_days(spark, sf_dir):
    return _asof(spark, sf_dir, max_gap_days=90)


QUERIES = {f.__name__: f for f in (fy_ohlcv, fy_ohlcv_range_end_exclusive, fy_ohlcv_by_name,
                                   asof_forward, asof_forward_within_90_days)}

_DAILY = """d AS (SELECT l_suppkey, l_shipdate, min(l_extendedprice) AS open, max(l_extendedprice * (1 + l_tax)) AS high,
       min(l_extendedprice * (1 - l_discount)) AS low, max(l_extendedprice) AS close, sum(l_quantity) AS volume
FROM lineitem GROUP BY 1, 2)"""


def _ohlcv(where: str) -> str:
    return f"""WITH {_DAILY}
SELECT 'Mar ' || (year(l_shipdate) + CASE WHEN month(l_shipdate) >= 4 THEN 1 ELSE 0 END) AS date,
       l_suppkey AS company, first(open ORDER BY l_shipdate) AS open, max(high) AS high, min(low) AS low,
       first(close ORDER BY l_shipdate DESC) AS close, CAST(sum(volume) AS BIGINT) AS volume
FROM d WHERE {where} GROUP BY 1, 2"""


def _asof_sql(where: str) -> str:
    return f"""WITH d AS (
SELECT o_custkey, o_orderdate, min(o_orderkey) AS o_orderkey, min(o_totalprice) AS price,
       year(o_orderdate) - CASE WHEN month(o_orderdate) < 3 THEN 1 ELSE 0 END AS ay
FROM orders GROUP BY o_custkey, o_orderdate),
c AS (SELECT o_custkey, min(ay) AS low, max(ay) AS high FROM d GROUP BY o_custkey),
a AS (SELECT o_custkey, CAST(unnest(range(low, high + 1)) AS INTEGER) AS year FROM c),
f AS (SELECT a.year, make_date(a.year, 3, 1) AS anchor, d.* FROM a JOIN d
        ON d.o_custkey = a.o_custkey AND d.o_orderdate >= make_date(a.year, 3, 1)
      QUALIFY row_number() OVER (PARTITION BY a.o_custkey, a.year ORDER BY o_orderdate) = 1)
SELECT strftime(o_orderdate, '%b %Y') AS date, o_custkey AS company, year,
       CAST(o_orderdate AS DATE) AS bar_date, o_orderkey, price
FROM f WHERE {where}"""


ORACLE = {
    "fy_ohlcv": _ohlcv("TRUE"),
    "fy_ohlcv_range_end_exclusive": _ohlcv(
        f"l_shipdate >= DATE '{FIRST_YEAR - 1}-04-01' AND l_shipdate < DATE '{LAST_YEAR}-04-01' "
        "AND NOT (month(l_shipdate) = 3 AND day(l_shipdate) = 31)"),
    "fy_ohlcv_by_name": f"""WITH b AS ({_ohlcv('TRUE')})
SELECT date, s_name AS company, open, high, low, close, volume FROM b JOIN supplier ON s_suppkey = company""",
    "asof_forward": _asof_sql("TRUE"),
    "asof_forward_within_90_days": _asof_sql("date_diff('day', anchor, CAST(o_orderdate AS DATE)) <= 90"),
}
