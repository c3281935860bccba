"""Schemas of change envelopes, statements and bars."""

from __future__ import annotations

from pyspark.sql import types as T

# Statement column names and order.
MEASURES = [
    "sales", "expenses", "operating_profit", "opm_percent", "other_income", "interest",
    "depreciation", "profit_before_tax", "tax_percent", "net_profit", "eps_in_rs",
    "dividend_payout_percent",
]
KPI_COLUMNS = [
    "net_profit_margin", "operating_profit_margin", "tax_amount", "dividend_yield",
    "interest_coverage_ratio", "yoy_sales_growth", "yoy_net_profit_growth",
]
TRAILING_LABEL = "TTM"
SUMMARY_LABEL = "Average"


def statement_schema(keys: list[str], measures: list[str] | None = None) -> T.StructType:
    """String keys followed by double measures."""
    fields = [T.StructField(k, T.StringType()) for k in keys]
    fields += [T.StructField(m, T.DoubleType()) for m in measures or MEASURES]
    return T.StructType(fields)


def kpi_schema() -> T.StructType:
    return statement_schema(["date", "company_name"], MEASURES + KPI_COLUMNS)


def envelope_schema(row: T.StructType, source_fields: list[str] | None = None,
                    before: list[str] | None = None) -> T.StructType:
    """``payload{before, after, source}``; the source fields are longs (``ts_ms``, log positions).

    ``before`` names the fields wanted from the image before the change, all if not given: fields
    outside the schema are skipped by the parser.
    """
    source = T.StructType([T.StructField(f, T.LongType()) for f in source_fields or ["ts_ms"]])
    old = row if before is None else T.StructType([row[f] for f in before])
    return T.StructType([T.StructField("payload", T.StructType([
        T.StructField("before", old),
        T.StructField("after", row),
        T.StructField("source", source),
    ]))])


BAR_SCHEMA = T.StructType([
    T.StructField("company", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.LongType()),
])
