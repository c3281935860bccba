"""Where change envelopes come from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def cdc_source(spark: SparkSession, fmt: str, options: dict[str, str] | None = None,
               streaming: bool = False, keep_position: bool = False) -> DataFrame:
    """Raw envelopes as one string column ``value``, in batch or as a stream.

    ``fmt`` is ``kafka`` or any file format with a ``value`` column (``text`` for JSON lines).
    Kafka starts from the earliest offset unless told otherwise. ``keep_position`` adds the
    Kafka partition and offset: messages of one key share a partition, so the offset settles
    which of two events with the same time came last.
    """
    settings = dict(options or {})
    if fmt == "kafka":
        settings.setdefault("startingOffsets", "earliest")
    reader = spark.readStream if streaming else spark.read
    raw = reader.format(fmt).options(**settings).load()
    position = ["partition", "offset"] if keep_position and fmt == "kafka" else []
    return raw.select(F.col("value").cast("string").alias("value"), *position)
