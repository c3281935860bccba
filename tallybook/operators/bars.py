"""Fiscal-year bars and forward as-of lookup over daily price bars."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallybook.functions.times import anchor_year, fiscal_label, fiscal_year, period_label


def fiscal_year_bars(bars: DataFrame, entity: list[str], day: str, start_year: int | None = None,
                     end_year: int | None = None, end_inclusive: bool = True) -> DataFrame:
    """First open, highest high, lowest low, last close and total volume per entity and fiscal year.

    A fiscal year runs from April 1 to March 31 and is named after its last month. Years without
    bars give no row. The year range becomes a plain range on ``day``, which reaches the scan.
    Takes one bar per entity and day. ``end_inclusive=False`` leaves out each March 31. The aggregates
    are hash-based and combine on the map side, so an entity with very many bars sends one row per
    year and task.
    """
    kept = bars.filter(F.col(day).isNotNull())
    if start_year is not None:
        kept = kept.filter(F.col(day) >= F.lit(dt.date(start_year - 1, 4, 1)))
    if end_year is not None:
        kept = kept.filter(F.col(day) < F.lit(dt.date(end_year, 4, 1)))
    if not end_inclusive:
        kept = kept.filter((F.month(day) != 3) | (F.dayofmonth(day) != 31))
    opening, closing = F.min_by("open", day), F.max_by("close", day)
    return (kept.groupBy(*entity, fiscal_year(F.col(day)).alias("_year"))
            .agg(opening.alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
                 closing.alias("close"), F.sum("volume").alias("volume"))
            .select(fiscal_label(F.col("_year")).alias("date"), *entity,
                    "open", "high", "low", "close", "volume"))


def first_bar_from(bars: DataFrame, entity: list[str], day: str, values: list[str], start_year: int | None = None,
                   end_year: int | None = None, month: int = 3, day_of_month: int = 1,
                   max_gap_days: int | None = None) -> DataFrame:
    """For each entity and year, the first bar on or after the anchor date of that year.

    Takes one bar per entity and day. Without ``start_year`` an entity's years begin with that of its
    first bar, without ``end_year`` they end with that of its last.

    Bars are first reduced, on the map side too, to the earliest one between two anchors; what is
    left is at most one row per entity and year. A year without bars of its own takes the earliest
    bar of the next year that has some. ``year`` is the anchor's, the label is the found bar's.
    """
    year = anchor_year(F.col(day), month, day_of_month)
    if end_year is not None:
        year = F.least(year, F.lit(end_year))
    kept = bars.filter(F.col(day).isNotNull())
    if start_year is not None:
        kept = kept.filter(F.col(day) >= F.lit(dt.date(start_year, month, day_of_month)))
    earliest = (kept.groupBy(*entity, year.alias("_year"))
                .agg(F.min(day).alias("_day"), *[F.min_by(v, day).alias(v) for v in values]))
    before = F.lag("_year").over(W.partitionBy(*entity).orderBy("_year"))
    first = F.col("_year") if start_year is None else F.lit(start_year)
    anchors = F.sequence(F.coalesce(F.col("_before") + 1, first), F.col("_year"))
    found = (earliest.withColumn("_before", before)
             .select(*entity, F.explode(anchors).alias("year"), F.col("_day").alias(day), *values))
    if max_gap_days is not None:
        anchor = F.make_date(F.col("year"), F.lit(month), F.lit(day_of_month))
        found = found.filter(F.date_diff(F.col(day), anchor) <= max_gap_days)
    return found.select(period_label(F.col(day)).alias("date"), *entity, "year",
                        F.col(day).alias("bar_date"), *values)
