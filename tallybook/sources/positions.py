"""Read positions: a pass reads what came after the pass before it, up to what is there when it starts.

Positions are the next offset of each partition, ``{"0": 17, "1": 4}``. They are committed with the rows that come of
them (the marks of a ``BucketTable``), never by themselves.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.sources.changes import cdc_source


def kafka_start(topic: str, start: dict[str, int]) -> str:
    """The reader's ``startingOffsets`` for positions; a topic not yet read starts from the earliest offset."""
    return json.dumps({topic: start}) if start else "earliest"


def read_after(spark: SparkSession, fmt: str, options: dict[str, str], start: dict[str, int]) -> DataFrame:
    """``value, partition, offset`` of the messages from ``start`` on, as a batch.

    ``fmt`` is ``kafka`` (``subscribe`` names one topic) or a file format whose tables have these three columns; there
    the positions become filters on the columns, which reach the scan. Partitions without a position are read whole
    (Kafka wants all partitions named: after partitions were added to a topic, give them 0 in the positions).
    """
    if fmt == "kafka":
        at = {**options, "startingOffsets": kafka_start(options["subscribe"], start)}
        return cdc_source(spark, fmt, at, keep_position=True)
    rows = spark.read.format(fmt).options(**options).load()
    if start:
        part, offset = F.col("partition"), F.col("offset")
        after = [(part == int(p)) & (offset >= n) for p, n in sorted(start.items())]
        rows = rows.where(reduce(lambda a, b: a | b, after) | ~part.isin([int(p) for p in start]))
    return rows.select(F.col("value").cast("string").alias("value"), "partition", "offset")


def positions_after(rows: DataFrame, start: dict[str, int]) -> dict[str, int]:
    """The positions behind these messages: one number per partition of the source."""
    ends = rows.groupBy("partition").agg((F.max("offset") + 1).alias("next")).collect()
    return {**start, **{str(r["partition"]): max(r["next"], start.get(str(r["partition"]), 0)) for r in ends}}
