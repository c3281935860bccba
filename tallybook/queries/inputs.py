"""Inputs the queries derive from the given tables, and the same relations as SQL.

Entities, periods and change events have no table of their own here: an event is a change of the
statement of company ``user_id`` for month ``k`` (counted from January 1995; month 99 stands for the
trailing period), events of type ``error`` are deletes, and the statements a supplier already has are
its line items summed per shipping month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.functions.times import epoch_ms, period_label
from tallybook.schemas import MEASURES, TRAILING_LABEL

CUT_MS = 1705363200000  # 2024-01-16T00:00:00Z, between older and newer events
SOURCE_FIELDS = ["ts_ms", "lsn"]

EVENT_KEYS = ["user_id", "k"]
EVENT_ROW = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("k", T.IntegerType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hundredths(column: str) -> Column:
    """A stored two-decimal double as a whole number of hundredths: sums are exact in any row order."""
    return F.rint(F.col(column) * 100).cast("long")


def events_with_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("lsn"), epoch_ms(F.col("ts")).alias("ts_ms"), "user_id",
        F.get_json_object("props", "$.k").cast("int").alias("k"), "event_type", "value")


def as_envelopes(rows: DataFrame, keys: list[str], image: list[Column], gone: Column,
                 had_before: Column) -> DataFrame:
    """JSON envelopes: ``after`` is absent for deletes, ``before`` (the old key) for inserts."""
    payload = F.struct(F.when(had_before, F.struct(*keys)).alias("before"),
                       F.when(~gone, F.struct(*image)).alias("after"),
                       F.struct(*SOURCE_FIELDS).alias("source"))
    return rows.select(*SOURCE_FIELDS, F.to_json(F.struct(payload.alias("payload"))).alias("value"))


def event_envelopes(spark: SparkSession, sf_dir: str, known: Column | None = None) -> DataFrame:
    """Every event as an envelope keyed by user and ``k``; where ``known`` fails the value is null."""
    value = F.col("value") if known is None else F.when(known, F.col("value")).alias("value")
    image = [F.col("user_id"), F.col("k"), F.col("event_type"), value]
    kind = F.col("event_type")
    return as_envelopes(events_with_time(spark, sf_dir), EVENT_KEYS, image, kind == "error", kind != "signup")


EVENTS_SQL = """
ev AS (SELECT event_id AS lsn, epoch_us(ts) // 1000 AS ts_ms, user_id,
              CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, event_type,
              value, event_type = 'error' AS gone
       FROM events)"""


def month_label(k: Column) -> Column:
    month = period_label(F.add_months(F.lit("1995-01-01").cast("date"), k))
    return F.when(k == 99, F.lit(TRAILING_LABEL)).otherwise(month)


def company_label(key: Column) -> Column:
    return F.concat(F.lit("company-"), key.cast("string"))


# Each measure of a statement change as a multiple of the event value; sign-ups know sales only.
CHANGE_FACTORS = {
    "sales": 1000, "expenses": 600, "operating_profit": 400, "opm_percent": 1, "other_income": 25,
    "interest": 16, "depreciation": 8, "profit_before_tax": 376, "tax_percent": 2, "net_profit": 250,
    "eps_in_rs": 4, "dividend_payout_percent": 3,
}


def statement_envelopes(spark: SparkSession, sf_dir: str, keys: list[str]) -> DataFrame:
    """Every event as a change of a statement with all measures."""
    rows = events_with_time(spark, sf_dir).select(
        *SOURCE_FIELDS, "event_type", month_label(F.col("k")).alias("date"),
        company_label(F.col("user_id")).alias("company_name"),
        *[F.when((F.col("event_type") != "signup") | F.lit(m == "sales"), F.col("value") * factor).alias(m)
          for m, factor in CHANGE_FACTORS.items()])
    image = [F.col(c) for c in [*keys, *MEASURES]]
    kind = F.col("event_type")
    return as_envelopes(rows, keys, image, kind == "error", kind != "signup")


def line_statements(spark: SparkSession, sf_dir: str, keys: list[str], months_later: int = 0) -> DataFrame:
    """Line items summed to one statement per shipping month (and supplier), dated so many months later."""
    by = {"date": F.add_months(F.trunc("l_shipdate", "month"), months_later), "company_name": F.col("l_suppkey")}
    names = {"date": period_label(F.col("date")), "company_name": company_label(F.col("company_name"))}
    lines = table(spark, sf_dir, "lineitem").select(
        *[by[k].alias(k) for k in keys], hundredths("l_extendedprice").alias("price"),
        hundredths("l_discount").alias("discount"), hundredths("l_tax").alias("tax"),
        hundredths("l_quantity").alias("quantity"), "l_linenumber", "l_extendedprice", "l_returnflag")
    c = F.col
    sums = lines.groupBy(*keys).agg(
        F.sum("price").alias("price"), F.sum(c("price") * c("discount")).alias("discounts"),
        F.sum(c("price") * c("tax")).alias("taxes"), F.sum("quantity").alias("quantity"),
        F.sum(F.when(c("l_returnflag") == "R", c("quantity"))).alias("returned"),
        F.sum("l_linenumber").alias("lines"), F.sum("tax").alias("tax_rates"),
        F.max("l_extendedprice").alias("highest"), F.sum("discount").alias("discount_rates"))
    measures = {
        "sales": c("price") / 100, "expenses": c("discounts") / 10000,
        "operating_profit": (c("price") * 100 - c("discounts")) / 10000,
        "opm_percent": c("lines").cast("double"), "other_income": c("taxes") / 10000,
        "interest": c("quantity") / 100, "depreciation": c("returned") / 100,
        "profit_before_tax": (c("price") - c("quantity")) / 100, "tax_percent": c("tax_rates") / 100,
        "net_profit": (c("price") * 100 - c("discounts") - c("taxes")) / 10000,
        "eps_in_rs": c("highest"), "dividend_payout_percent": c("discount_rates") / 100,
    }
    return sums.select(*[names[k].alias(k) for k in keys], *[v.alias(m) for m, v in measures.items()])


def sql_round(expression: str, decimals: int = 2) -> str:
    """Round half up on the decimal text of a double, as Spark rounds."""
    return f"CAST(CAST(CAST(({expression}) AS VARCHAR) AS DECIMAL(38,{decimals})) AS DOUBLE)"


def sql_ratio(numerator: str, denominator: str, factor: str = "") -> str:
    return sql_round(f"({numerator}) / NULLIF({denominator}, 0){factor}")


def change_rows_sql(keys: list[str]) -> str:
    """CTE ``ch``: the events as statement changes, measures null where the event does not know them."""
    known = {m: "NOT gone" if m == "sales" else "NOT gone AND event_type <> 'signup'" for m in CHANGE_FACTORS}
    measures = ", ".join(f"CASE WHEN {known[m]} THEN value * {factor} END AS {m}" for m, factor in CHANGE_FACTORS.items())
    return f"""{EVENTS_SQL},
ch AS (SELECT lsn, ts_ms, gone, event_type,
              CASE WHEN k = 99 THEN 'TTM'
                   ELSE strftime(DATE '1995-01-01' + to_months(k), '%b %Y') END AS date,
              'company-' || user_id AS company_name, {measures} FROM ev)"""


def line_statements_sql(keys: list[str], months_later: int = 0) -> str:
    """CTE ``ex``: line items summed to statements."""
    d = "CAST(l_{} AS DECIMAL(18,2))".format
    price, cut, tax, qty = d("extendedprice"), d("discount"), d("tax"), d("quantity")
    month = f"date_trunc('month', l_shipdate) + to_months({months_later})"
    names = {"date": f"strftime({month}, '%b %Y')", "company_name": "'company-' || l_suppkey"}
    columns = ", ".join(f"{names[k]} AS {k}" for k in keys)
    measures = {
        "sales": f"sum({price})", "expenses": f"sum({price} * {cut})",
        "operating_profit": f"sum({price}) - sum({price} * {cut})", "opm_percent": "sum(l_linenumber)",
        "other_income": f"sum({price} * {tax})", "interest": f"sum({qty})",
        "depreciation": f"sum(CASE WHEN l_returnflag = 'R' THEN {qty} END)",
        "profit_before_tax": f"sum({price}) - sum({qty})", "tax_percent": f"sum({tax})",
        "net_profit": f"sum({price}) - sum({price} * {cut}) - sum({price} * {tax})",
        "eps_in_rs": "max(l_extendedprice)", "dividend_payout_percent": f"sum({cut})",
    }
    sums = ", ".join(f"CAST({v} AS DOUBLE) AS {m}" for m, v in measures.items())
    return f"ex AS (SELECT {columns}, {sums} FROM lineitem GROUP BY {', '.join(names[k] for k in keys)})"
