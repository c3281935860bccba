"""Period labels, fiscal years and time-zone-free epoch values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LABEL_FORMAT = "MMM yyyy"


def epoch_ms(ts: Column) -> Column:
    """Milliseconds since 1970 of a zone-less timestamp, whatever the session time zone."""
    whole = F.unix_date(F.to_date(ts)).cast("long") * 86_400_000 \
        + F.hour(ts) * 3_600_000 + F.minute(ts) * 60_000
    return (whole + F.floor(F.extract(F.lit("SECOND"), ts) * 1000)).cast("long")


def period_label(day: Column) -> Column:
    """``2013-03-04`` to ``Mar 2013``."""
    return F.date_format(day, LABEL_FORMAT)


def period_start(label: Column) -> Column:
    """``Mar 2013`` to its first day; labels that name no month give null."""
    return F.to_date(F.try_to_timestamp(label, F.lit(LABEL_FORMAT)))


def fiscal_year(day: Column) -> Column:
    """Year in which the April-March year holding ``day`` ends."""
    return F.year(F.add_months(day, 9))


def fiscal_label(year: Column) -> Column:
    """``2013`` to ``Mar 2013``, the closing month of an April-March year."""
    return F.concat(F.lit("Mar "), year.cast("string"))


def anchor_year(day: Column, month: int, day_of_month: int) -> Column:
    """Latest year whose anchor date (``month``/``day_of_month``) is not after ``day``."""
    on_or_after = (F.month(day) > month) | ((F.month(day) == month) & (F.dayofmonth(day) >= day_of_month))
    return F.year(day) - F.when(on_or_after, 0).otherwise(1)
