"""Repeated passes: what one pass leaves is what the next one starts from."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallybook.operators.changes import flatten_changes, latest_per_key, versions
from tallybook.plans import jobs
from tallybook.plans.passes import bounded_pass, kpi_pass, kpi_table, newest_rows
from tallybook.queries.changes import PAYLOAD
from tallybook.queries.inputs import (CUT_MS, EVENT_KEYS, EVENT_ROW, SOURCE_FIELDS, change_rows_sql, event_envelopes,
                                      line_statements, line_statements_sql, statement_envelopes)
from tallybook.queries.statements import IN_TIME, kpis_sql
from tallybook.queries.streams import LATEST_SQL
from tallybook.schemas import MEASURES
from tallybook.session import scratch_dir
from tallybook.sinks.buckets import Snapshot
from tallybook.sources.positions import read_after


def snapshot_two_passes(spark, sf_dir):
    """The KPI job twice: the statements and KPIs of the older half of the log are the snapshot of the newer half."""
    table = Snapshot(spark, scratch_dir(spark, "kpis"), jobs.MULTI_KEYS, ["company_name"], buckets=16)
    kpi_table(table, line_statements(spark, sf_dir, jobs.MULTI_KEYS))
    log = statement_envelopes(spark, sf_dir, jobs.MULTI_KEYS)
    for half in (F.col("ts_ms") < CUT_MS, F.col("ts_ms") >= CUT_MS):
        kpi_pass(table, log.where(half).select("value"), SOURCE_FIELDS)
    return table.read()


def event_messages(spark, sf_dir):
    """The event log as messages of four partitions; the event number serves as the offset."""
    return event_envelopes(spark, sf_dir).select(
        "value", F.pmod("lsn", F.lit(4)).cast("int").alias("partition"), F.col("lsn").alias("offset"))


def cdc_bounded_passes(spark, sf_dir):
    """Three passes over a growing table of messages; each reads what came after the positions of the one before.

    The table keeps event times and deleted rows, so that an event of a later pass that is older changes nothing.
    """
    base = scratch_dir(spark, "messages")
    table = Snapshot(spark, f"{base}/table", EVENT_KEYS, buckets=16)

    def resolve(messages):
        flat = flatten_changes(messages.select("value"), EVENT_ROW, EVENT_KEYS, SOURCE_FIELDS)
        return latest_per_key(versions(flat, EVENT_KEYS, PAYLOAD, SOURCE_FIELDS), EVENT_KEYS, SOURCE_FIELDS)

    messages = event_messages(spark, sf_dir)
    last = messages.agg(F.max("offset")).first()[0]
    table.load(resolve(messages.limit(0)))
    for turn in range(3):
        part = messages.where(F.floor(F.col("offset") * 3 / (last + 1)) == turn)
        part.write.mode("append").parquet(f"{base}/in")
        bounded_pass(table, "events", lambda start: read_after(spark, "parquet", {"path": f"{base}/in"}, start), resolve,
                     newest_rows(EVENT_KEYS, SOURCE_FIELDS))
    return table.read().where("not deleted").drop("deleted")


QUERIES = {f.__name__: f for f in (snapshot_two_passes, cdc_bounded_passes)}


def _pass_sql(before: str, half: str, name: str) -> str:
    """CTE ``name``: statements after a pass over one half of the log."""
    on = " AND ".join(f"n.{k} = o.{k}" for k in jobs.MULTI_KEYS)
    values = ", ".join(f"coalesce(n.{m}, o.{m}) AS {m}" for m in MEASURES)
    return f"""n_{name} AS (SELECT * FROM ch WHERE {half}
  QUALIFY row_number() OVER (PARTITION BY date, company_name ORDER BY ts_ms DESC, lsn DESC) = 1),
{name} AS (SELECT coalesce(n.date, o.date) AS date, coalesce(n.company_name, o.company_name) AS company_name, {values}
  FROM n_{name} n FULL JOIN (SELECT * FROM {before} WHERE date <> 'TTM') o ON {on}
  WHERE NOT coalesce(n.gone, FALSE))"""


ORACLE = {
    "snapshot_two_passes": kpis_sql(f"""{change_rows_sql(jobs.MULTI_KEYS)},
{line_statements_sql(jobs.MULTI_KEYS)},
{_pass_sql('ex', f'ts_ms < {CUT_MS}', 'one')},
{_pass_sql('one', f'ts_ms >= {CUT_MS}', 'm')}""", IN_TIME),
    "cdc_bounded_passes": LATEST_SQL,
}
