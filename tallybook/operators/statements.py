"""Reshaping and cleaning statement tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallybook.functions.text import clean_number, normalise_label


UNNAMED = "unnamed"


def melt_periods(wide: DataFrame, keys: list[str], label: str, periods: list[str],
                 position: str | None = None) -> DataFrame:
    """Wide rows (one column per period) to ``keys, row_no, col_no, label, period, value``.

    ``position`` names the column that orders the rows of a table; without it repeated labels are
    told apart by their values.
    """
    row_no = F.col(position) if position else F.lit(0)
    tall = wide.select(*keys, row_no.alias("row_no"), F.col(label).alias("label"), *periods)
    numbers = F.array_position(F.lit(periods), F.col("period")).cast("int")
    return tall.unpivot([*keys, "row_no", "label"], periods, "period", "value").withColumn("col_no", numbers)


def clean_cells(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Labels to column names, texts to doubles. No cell is lost.

    An empty label is called ``unnamed``. Labels of one table column that come out the same get
    ``_2``, ``_3``, … in the order of their rows; a name that another row has by itself is skipped. A table's column is
    one group.
    """
    named = cells.withColumns({
        "label": F.coalesce(F.nullif(normalise_label(F.col("label")), F.lit("")), F.lit(UNNAMED)),
        "value": clean_number(F.col("value"))})
    column = W.partitionBy(*keys, "col_no")
    numbered = named.withColumns({
        "_nth": F.row_number().over(W.partitionBy(*keys, "col_no", "label").orderBy("row_no", "value")),
        "_given": F.collect_set("label").over(column)})
    free = F.filter(F.transform(F.sequence(F.lit(2), F.col("_nth") + F.size("_given")),
                                lambda n: F.concat("label", F.lit("_"), n.cast("string"))),
                    lambda name: ~F.array_contains("_given", name))
    label = F.when(F.col("_nth") == 1, F.col("label")).otherwise(F.element_at(free, F.col("_nth") - 1))
    return numbered.withColumn("label", label).drop("_nth", "_given")


def pivot_cells(cells: DataFrame, keys: list[str], labels: list[str]) -> DataFrame:
    """One row per table column (a period), one column per wanted line item.

    Columns with the same period stay rows of their own. One conditional aggregate per label needs a
    single shuffle with partial aggregation. A label that stands twice in a column fails the job, since one of its values
    would be lost (``clean_cells`` leaves none).
    """
    twice = reduce(lambda a, b: a | b, [F.count_if(F.col("label") == x) > 1 for x in labels], F.lit(False))
    values = [F.max(F.when(F.col("label") == x, F.col("value"))).alias(x) for x in labels]
    sound = F.when(F.col("_twice"), F.raise_error(F.concat(F.lit("a label stands twice under "), F.col("period"))))
    return (cells.groupBy(*keys, "col_no", "period").agg(*values, twice.alias("_twice"))
            .where(sound.otherwise(F.lit(True)).cast("boolean"))
            .select(F.col("period").alias("date"), *labels, *keys))


def transpose(wide: DataFrame, keys: list[str], label: str, periods: list[str], labels: list[str],
              position: str | None = None) -> DataFrame:
    """Line items x periods to periods x line items, cleaned, with gaps filled by 0."""
    cells = clean_cells(melt_periods(wide, keys, label, periods, position), keys)
    return pivot_cells(cells, keys, labels).fillna(0, subset=labels)


def union_statements(frames: list[DataFrame]) -> DataFrame:
    """Union by name; columns a frame lacks are 0."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames).fillna(0)
