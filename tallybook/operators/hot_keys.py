"""Joins on keys of which a few may hold a large share of the rows: the heavy ones are measured, and only they are split.

How often a key stands in a table comes from a count-min sketch: each row adds one to a counter in each of a few rows of
counters, chosen by a hash of the key; the least of a key's counters is never below its count and seldom far above. A
sketch is an aggregate of fixed size: tasks add up their own, the shuffle moves counters only, and sketches of parts of
a table add up to that of the whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.session import materialise

DEPTH = 3
PIECES = 8  # salted pieces of an average task's rows


def tasks_of(df: DataFrame) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)


def sketch_width(tasks: int) -> int:
    """Counters in a row of the sketch: sixteen for each task, so that a wrong count stays below a piece."""
    return 1 << max(16 * tasks - 1, 1).bit_length()


def _cell(row: int, keys: list[str], width: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(row), *keys), F.lit(width)).cast("int")


def key_sketch(df: DataFrame, keys: list[str], width: int) -> DataFrame:
    """The sketch as rows ``line, cell, n``; at most ``DEPTH * width`` of them, whatever the table."""
    cells = [F.struct(F.lit(i).alias("line"), _cell(i, keys, width).alias("cell")) for i in range(DEPTH)]
    return df.select(F.explode(F.array(*cells)).alias("c")).groupBy("c.line", "c.cell").agg(F.count(F.lit(1)).alias("n"))


class HotKeys:
    """The heavy values of ``keys`` in a table, and into how many pieces their rows are to be split.

    A value is heavy if it holds more than a quarter of an average shuffle task's rows; then it is split into pieces of an
    eighth of a task. There are at most four heavy values for each task, and that many cells are broadcast.
    """

    def __init__(self, df: DataFrame, keys: list[str], tasks: int | None = None):
        self.keys, tasks = keys, tasks or tasks_of(df)
        self.width = sketch_width(tasks)
        sketch = materialise(key_sketch(df, keys, self.width), "key-sketch")
        total = sketch.where("line = 0").agg(F.sum("n")).first()[0] or 0
        self.piece = max(total / (PIECES * tasks), 1.0)
        self.heavy = sketch.where(F.col("n") > 2 * self.piece)

    def with_pieces(self, df: DataFrame) -> DataFrame:
        """``df`` with ``_pieces``: the number of pieces of the row's key, 1 if it is not heavy."""
        for i in range(DEPTH):
            line = self.heavy.where(F.col("line") == i).select(F.col("cell").alias(f"_cell{i}"), F.col("n").alias(f"_n{i}"))
            df = df.withColumn(f"_cell{i}", _cell(i, self.keys, self.width)).join(F.broadcast(line), f"_cell{i}", "left")
        counts = [F.col(f"_n{i}") for i in range(DEPTH)]
        known = reduce(lambda a, b: a & b, [n.isNotNull() for n in counts])
        pieces = F.when(known, F.ceil(F.least(*counts) / F.lit(self.piece))).otherwise(F.lit(1)).cast("int")
        return df.withColumn("_pieces", pieces).drop(*[f"_{x}{i}" for x in ("cell", "n") for i in range(DEPTH)])

    def dealt(self, df: DataFrame, by: list[str] | None = None) -> DataFrame:
        """``df`` with ``_piece``: which of its key's pieces a row is in, by a hash of the row (of ``by``).

        The hash does not change when a task is run again. Rows that agree in all columns stay in one piece.
        """
        row = F.pmod(F.xxhash64(F.lit(DEPTH), *(by or df.columns)), F.col("_pieces")).cast("int")
        return self.with_pieces(df).withColumn("_piece", row).drop("_pieces")

    def repeated(self, df: DataFrame) -> DataFrame:
        """``df``, one row per key, once for each piece of the key."""
        every = F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1))
        return self.with_pieces(df).withColumn("_piece", every).drop("_pieces")
