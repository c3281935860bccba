"""What a job left out, counted while it runs.

``watch`` hangs counters on a frame (``DataFrame.observe``): they are filled by the job that reads it anyhow, in batch (an
``Observation``) and per micro-batch of a stream (a name; the counts come with the query's progress). Counts per company
are an aggregate of their own and come from rows that were written once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallybook.functions.text import clean_number, strip
from tallybook.operators.changes import is_delete, is_upsert


def watch(df: DataFrame, notices: Observation | str | None, **conditions: Column) -> DataFrame:
    """``df`` with a counter ``rows`` and one for each condition; unchanged if no one listens."""
    if notices is None:
        return df
    return df.observe(notices, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in conditions.items()])


def watch_changes(flat: DataFrame, keys: list[str], notices: Observation | str | None) -> DataFrame:
    """Flattened changes with counters of upserts, deletes, and messages that are neither (unreadable or without a key)."""
    return watch(flat, notices, upserts=is_upsert(keys), deletes=is_delete(keys),
                 unreadable=~is_upsert(keys) & ~is_delete(keys))


def no_number(text: Column) -> Column:
    """Whether a cell's text is there but is no number."""
    return F.coalesce((strip(text) != "") & clean_number(text).isNull(), F.lit(False))


def page_notices(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of table rows (``sources.pages.page_rows``), per entity: rows, rows of another width, cells that are no number."""
    values = F.slice("cells", F.lit(2), F.greatest(F.size("cells") - 1, F.lit(0)))
    bad = F.when(F.col("fits"), F.size(F.filter(values, no_number))).otherwise(F.lit(0))
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("table_rows"), F.count_if(~F.col("fits")).alias("other_width"),
                                   F.sum(bad).alias("no_number"))


def years_without_bars(yearly: DataFrame, entities: DataFrame, entity: list[str], start_year: int, end_year: int) -> DataFrame:
    """``entity, year`` for each entity and fiscal year of the range without a row in ``yearly`` (its label is ``date``)."""
    every = entities.select(*entity).distinct().withColumn("year", F.explode(F.sequence(F.lit(start_year), F.lit(end_year))))
    found = yearly.select(*entity, F.substring_index("date", " ", -1).cast("int").alias("year"))
    return every.join(found, [*entity, "year"], "left_anti")
