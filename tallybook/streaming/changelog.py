"""Streaming upserts.

Rewriting a whole snapshot for every micro-batch would cost the size of the table each time. Here a
batch adds its own newest rows to a tiered log (``sinks.buckets.TieredLog``), which folds runs together as they fill up,
and readers take the newest row of each key. The event time stays with each row and deletes stay as marked
rows: an old event that arrives late can then neither overwrite a newer row nor bring back a deleted one.

The log's version file names the last batch of each stream, so a repeated batch changes nothing. A stream is known by
the id that Spark keeps in its checkpoint: with a new checkpoint, at the same path or another one, it is a new stream,
which adds to the log and takes nothing away.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tallybook.operators.changes import latest_per_key
from tallybook.session import read_text
from tallybook.sinks.buckets import TieredLog


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the query with this checkpoint; Spark writes it there before the first batch."""
    text = read_text(spark, f"{checkpoint.rstrip('/')}/metadata")
    if text is None:
        raise FileNotFoundError(f"no query has started with the checkpoint {checkpoint}")
    return json.loads(text)["id"]


def _writer(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str,
            trigger: dict | None) -> DataStreamWriter:
    return (df.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "10 seconds"})))


def upsert_batches(versions: DataFrame, keys: list[str], order: list[str], log_path: str, checkpoint: str,
                   trigger: dict | None = None,
                   publish: Callable[[DataFrame, int], None] | None = None, **log) -> StreamingQuery:
    """Stateless form: each batch logs the newest version of the keys it holds.

    ``publish(changed, batch_id)`` runs after every batch with the batch's newest rows, to refresh what
    is derived from the log for the keys it touched. It may run again for a repeated batch, so it should
    replace or upsert, not append. ``log``: settings of a new ``TieredLog``.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        changed = latest_per_key(batch, keys, order)
        _take(changed, batch_id, TieredLog(batch.sparkSession, log_path, keys, order, **log), checkpoint, publish)

    return _writer(versions, sink, checkpoint, trigger).start()


def _take(changed: DataFrame, batch_id: int, log: TieredLog, checkpoint: str, publish: Callable | None) -> None:
    changed.persist()
    try:
        log.add(changed, stream_id(log.spark, checkpoint), batch_id)
        if publish:
            publish(changed, batch_id)
    finally:
        changed.unpersist()


def latest_state(versions: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Stateful form: newest version of each key so far, as a streaming aggregate."""
    rest = [c for c in versions.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return versions.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*versions.columns)


def keep_latest(versions: DataFrame, keys: list[str], order: list[str], log_path: str, checkpoint: str,
                trigger: dict | None = None,
                publish: Callable[[DataFrame, int], None] | None = None, **log) -> StreamingQuery:
    """Log the keys whose newest version changed in a batch; late events change nothing.

    ``publish`` and ``log`` as in ``upsert_batches``.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        _take(batch, batch_id, TieredLog(batch.sparkSession, log_path, keys, order, **log), checkpoint, publish)

    return _writer(latest_state(versions, keys, order), sink, checkpoint, trigger) \
        .outputMode("update").start()


def read_latest(spark: SparkSession, log_path: str, keys: list[str], order: list[str], with_deleted: bool = False,
                touched: DataFrame | None = None) -> DataFrame:
    """Current rows of a log; with ``touched`` only those of the buckets that its rows fall into are read.

    To get all rows of an entity that way, the log has to be made with ``bucket_by``, the entity's columns.
    """
    return TieredLog(spark, log_path, keys, order).newest(with_deleted, touched)


def keep_running(start: Callable[[], StreamingQuery], restarts: int = 3, pause_seconds: float = 5.0) -> None:
    """Wait for a query and start it again from its checkpoint after a failure.

    It gives up after ``restarts`` failures in a row without a finished batch in between.
    """
    failures = 0
    while True:
        query = start()
        try:
            query.awaitTermination()
            return
        except StreamingQueryException:
            failures = 1 if query.recentProgress else failures + 1
            if failures > restarts:
                raise
            time.sleep(pause_seconds)
