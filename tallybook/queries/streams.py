"""Streaming queries: the event log arrives as envelope files, the newer half first."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallybook.operators.changes import flatten_changes, versions
from tallybook.queries.changes import PAYLOAD
from tallybook.queries.inputs import (CUT_MS, EVENT_KEYS, EVENT_ROW, EVENTS_SQL, SOURCE_FIELDS,
                                      event_envelopes)
from tallybook.session import scratch_dir
from tallybook.sources.changes import cdc_source
from tallybook.streaming.changelog import keep_latest, keep_running, read_latest, upsert_batches


def _run_in_two_halves(spark, sf_dir, start):
    """Write half of the log, run the query over it, write the rest, and run again from the checkpoint."""
    base = scratch_dir(spark, "stream")
    log_path, checkpoint = f"{base}/log", f"{base}/checkpoint"
    envelopes = event_envelopes(spark, sf_dir)
    for half in (F.col("ts_ms") >= CUT_MS, F.col("ts_ms") < CUT_MS):
        envelopes.filter(half).select("value").write.mode("append").text(f"{base}/in")
        source = cdc_source(spark, "text", {"path": f"{base}/in"}, streaming=True)
        flat = flatten_changes(source, EVENT_ROW, EVENT_KEYS, SOURCE_FIELDS)
        events = versions(flat, EVENT_KEYS, PAYLOAD, SOURCE_FIELDS)
        keep_running(lambda: start(events, EVENT_KEYS, SOURCE_FIELDS, log_path, checkpoint,
                                   trigger={"availableNow": True}))
    return read_latest(spark, log_path, EVENT_KEYS, SOURCE_FIELDS)


def stream_latest_per_key(spark, sf_dir):
    return _run_in_two_halves(spark, sf_dir, keep_latest)


def stream_upsert_foreachbatch(spark, sf_dir):
    return _run_in_two_halves(spark, sf_dir, upsert_batches)


def stream_tiered_log(spark, sf_dir):
    """Four batches into a log with small levels, so that runs are folded; the third batch fails at its first attempt."""
    base, failed = scratch_dir(spark, "tiers"), []
    event_envelopes(spark, sf_dir).select("value").repartition(4).write.text(f"{base}/in")

    def publish(changed, batch_id):
        if batch_id == 2 and not failed:
            failed.append(batch_id)
            raise RuntimeError("the third batch fails after its commit")

    def start():
        source = cdc_source(spark, "text", {"path": f"{base}/in", "maxFilesPerTrigger": "1"}, streaming=True)
        events = versions(flatten_changes(source, EVENT_ROW, EVENT_KEYS, SOURCE_FIELDS), EVENT_KEYS, PAYLOAD, SOURCE_FIELDS)
        return upsert_batches(events, EVENT_KEYS, SOURCE_FIELDS, f"{base}/log", f"{base}/checkpoint", {"availableNow": True},
                              publish, buckets=8, first_rows=200, fan=4)

    keep_running(start, pause_seconds=0)
    return read_latest(spark, f"{base}/log", EVENT_KEYS, SOURCE_FIELDS)


QUERIES = {f.__name__: f for f in (stream_latest_per_key, stream_upsert_foreachbatch, stream_tiered_log)}

LATEST_SQL = f"""WITH {EVENTS_SQL}, l AS (
SELECT * FROM ev QUALIFY row_number() OVER (PARTITION BY user_id, k ORDER BY ts_ms DESC, lsn DESC) = 1)
SELECT user_id, k, event_type, value, ts_ms, lsn FROM l WHERE NOT gone"""
ORACLE = dict.fromkeys(QUERIES, LATEST_SQL)
