"""Ratios, growth against the previous period, summary row and completeness filter."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallybook.schemas import SUMMARY_LABEL


def ratio(numerator: Column, denominator: Column, factor: int = 1) -> Column:
    """``round(n / d * factor, 2)``; null where the denominator is zero."""
    quotient = F.try_divide(numerator, denominator)
    return F.round(quotient * factor if factor != 1 else quotient, 2).cast("double")


def with_ratios(statements: DataFrame) -> DataFrame:
    """Margins, tax amount, dividend per share and interest coverage of each statement."""
    c = F.col
    return statements.withColumns({
        "net_profit_margin": ratio(c("net_profit"), c("sales"), 100),
        "operating_profit_margin": ratio(c("operating_profit"), c("sales"), 100),
        "tax_amount": F.round(c("tax_percent") * c("profit_before_tax") / 100, 2).cast("double"),
        "dividend_yield": F.round(c("dividend_payout_percent") * c("eps_in_rs") / 100, 2).cast("double"),
        "interest_coverage_ratio": ratio(c("operating_profit"), c("interest")),
    })


def with_previous(df: DataFrame, entity: list[str], order: list[Column], columns: list[str],
                  bucket: Column | None = None) -> DataFrame:
    """Add ``_previous``: a struct of ``columns`` as they were in the entity's preceding row.

    Without ``bucket`` an entity's rows share one task, which suits keyed statements (one row per
    period). For an entity with very many rows give ``bucket``, a value that never falls along
    ``order`` (a year, say): each bucket is then its own group, headed by a copy of the last row of
    the bucket before it. ``order`` must then be plain ascending columns.
    """
    row = F.struct(*columns)
    if bucket is None:
        return df.withColumn("_previous", F.lag(row).over(W.partitionBy(*entity).orderBy(*order)))
    cut = df.withColumn("_bucket", bucket)
    last = cut.groupBy(*entity, "_bucket").agg(F.max_by(row, F.struct(*order)).alias("_last"))
    before = F.lag("_last").over(W.partitionBy(*entity).orderBy("_bucket"))
    heads = last.select(*entity, "_bucket", before.alias("_row"), F.lit(False).alias("_own")) \
        .filter(F.col("_row").isNotNull())
    rows = cut.withColumns({"_row": row, "_own": F.lit(True)}).unionByName(heads, allowMissingColumns=True)
    within = W.partitionBy(*entity, "_bucket").orderBy("_own", *order)
    return rows.withColumn("_previous", F.lag("_row").over(within)).filter("_own") \
        .select(*df.columns, "_previous")


def with_growth(df: DataFrame, entity: list[str], order: list[Column], growth: dict[str, str],
                bucket: Column | None = None) -> DataFrame:
    """Percentage growth over the previous period; ``growth`` maps new column to measure."""
    previous = with_previous(df, entity, order, sorted(set(growth.values())), bucket)
    change = {}
    for name, measure in growth.items():
        before = F.col(f"_previous.{measure}")
        change[name] = ratio(F.col(measure) - before, before, 100)
    return previous.withColumns(change).drop("_previous")


def append_summary(detail: DataFrame, label: str, measures: list[str], name: str = SUMMARY_LABEL) -> DataFrame:
    """Detail rows plus one row of means (rounded to 2), with ``sort_key`` 2 for the summary and 1 for the rest.

    ``label`` is the key of ``detail``, so the rows and their means come out of one roll-up and ``detail``
    is evaluated once. A table without rows has no row of means.
    """
    rolled = detail.rollup(label).agg(
        F.grouping_id().alias("_total"), *[F.max(m).alias(m) for m in measures],
        *[F.round(F.avg(m), 2).alias(f"_mean_{m}") for m in measures])
    total = F.col("_total") == 1
    return rolled.select(
        F.when(total, F.lit(name)).otherwise(F.col(label)).alias(label),
        *[F.when(total, F.col(f"_mean_{m}")).otherwise(F.col(m)).alias(m) for m in measures],
        F.when(total | (F.col(label) == name), 2).otherwise(1).alias("sort_key"))


def complete_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows in which none of ``columns`` is null."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))


def summary_last(df: DataFrame, *then: Column) -> DataFrame:
    """Order by ``sort_key`` (detail first), then drop it."""
    return df.orderBy("sort_key", *then).drop("sort_key")
