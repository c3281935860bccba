"""Change-log queries: flatten, latest, deletes, merge, upsert."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.operators.changes import (deleted_keys, flatten_changes, latest_per_key, resolve_changes,
                                         upserts)
from tallybook.operators.hot_keys import HotKeys
from tallybook.operators.keys import split_repeated
from tallybook.operators.merge import apply_deletes, exclude_prefix, merge_snapshot, upsert
from tallybook.queries.inputs import (CUT_MS, EVENT_KEYS, EVENT_ROW, EVENTS_SQL, SOURCE_FIELDS,
                                      event_envelopes, events_with_time, table)
from tallybook.session import materialise, scratch_dir
from tallybook.sinks.bucketed import merge_bucketed, write_bucketed

PAYLOAD = ["event_type", "value"]


def flat_events(spark, sf_dir, row=EVENT_ROW):
    envelopes = event_envelopes(spark, sf_dir).select("value")
    return flatten_changes(envelopes, row, EVENT_KEYS, SOURCE_FIELDS)


def cdc_flatten(spark, sf_dir):
    return flat_events(spark, sf_dir)


def cdc_latest_single_key(spark, sf_dir):
    return latest_per_key(upserts(flat_events(spark, sf_dir), EVENT_KEYS), ["user_id"], SOURCE_FIELDS)


def cdc_latest_composite_key(spark, sf_dir):
    return latest_per_key(upserts(flat_events(spark, sf_dir), EVENT_KEYS), EVENT_KEYS, SOURCE_FIELDS)


def cdc_deleted_keys(spark, sf_dir):
    keys_only = T.StructType([EVENT_ROW[k] for k in EVENT_KEYS])
    return deleted_keys(flat_events(spark, sf_dir, keys_only), EVENT_KEYS)


def cdc_resolve_by_time(spark, sf_dir):
    return resolve_changes(flat_events(spark, sf_dir), EVENT_KEYS, PAYLOAD, SOURCE_FIELDS, "by_time")


def cdc_resolve_sticky(spark, sf_dir):
    return resolve_changes(flat_events(spark, sf_dir), EVENT_KEYS, PAYLOAD, SOURCE_FIELDS, "sticky")


def _snapshot_and_changes(spark, sf_dir, keys):
    """The older events as a table with one row per key, the newer ones out of their envelopes."""
    older = events_with_time(spark, sf_dir).filter((F.col("ts_ms") < CUT_MS) & (F.col("event_type") != "error"))
    small = F.col("value") <= 100  # larger values are unknown: a null does not replace what was there
    known = older.withColumn("value", F.when(small, F.col("value")))
    newer = event_envelopes(spark, sf_dir, small).filter(F.col("ts_ms") >= CUT_MS).select("value")
    changes = flatten_changes(newer, EVENT_ROW, EVENT_KEYS, SOURCE_FIELDS)
    return [latest_per_key(part, keys, SOURCE_FIELDS) for part in (known, upserts(changes, EVENT_KEYS))]


def merge_incoming_wins(spark, sf_dir):
    existing, incoming = _snapshot_and_changes(spark, sf_dir, EVENT_KEYS)
    return merge_snapshot(existing, incoming, EVENT_KEYS, PAYLOAD, distinct=True)


def merge_incoming_wins_single_key(spark, sf_dir):
    existing, incoming = _snapshot_and_changes(spark, sf_dir, ["user_id"])
    return merge_snapshot(existing, incoming, ["user_id"], PAYLOAD, distinct=True)


def merge_keep_existing(spark, sf_dir):
    existing, incoming = _snapshot_and_changes(spark, sf_dir, EVENT_KEYS)
    return merge_snapshot(existing, incoming, EVENT_KEYS, PAYLOAD, keep_existing=True)


def apply_deletes_composite(spark, sf_dir):
    flat = materialise(flat_events(spark, sf_dir), "flat-events")  # parsed once, read by both sides
    latest = latest_per_key(upserts(flat, EVENT_KEYS), EVENT_KEYS, SOURCE_FIELDS)
    return apply_deletes(latest, deleted_keys(flat, EVENT_KEYS), EVENT_KEYS)


def apply_deletes_global(spark, sf_dir):
    """Deletes on part of the key: a delete in the log takes away all orders of its user."""
    keys_only = T.StructType([EVENT_ROW[k] for k in EVENT_KEYS])
    gone = deleted_keys(flat_events(spark, sf_dir, keys_only), EVENT_KEYS)
    orders = table(spark, sf_dir, "orders")
    return apply_deletes(orders, gone.withColumnRenamed("user_id", "o_custkey"), ["o_custkey"], HotKeys(orders, ["o_custkey"]))


def apply_deletes_skewed(spark, sf_dir):
    """Deletes by company where company 0 holds a third of all line items."""
    keys_only = T.StructType([EVENT_ROW[k] for k in EVENT_KEYS])
    gone = deleted_keys(flat_events(spark, sf_dir, keys_only), EVENT_KEYS).withColumnRenamed("user_id", "company")
    lines = table(spark, sf_dir, "lineitem").withColumn(
        "company", F.when(F.col("l_orderkey") % 3 == 0, 0).otherwise(F.col("l_partkey")))
    return apply_deletes(lines, gone.where("company <> 0"), ["company"], HotKeys(lines, ["company"]))


def prefix_filter(spark, sf_dir):
    return exclude_prefix(table(spark, sf_dir, "part"), "p_type", "PROMO")


def upsert_snapshot(spark, sf_dir):
    """Customers of segment BUILDING get a new balance; each supplier becomes a new customer key."""
    customer = table(spark, sf_dir, "customer")
    changed = customer.filter("c_mktsegment = 'BUILDING'").withColumn("c_acctbal", F.lit(0.0))
    added = table(spark, sf_dir, "supplier").select(
        (-1 - F.col("s_suppkey")).alias("c_custkey"), F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"), F.col("s_acctbal").alias("c_acctbal"),
        F.lit("SUPPLIER").alias("c_mktsegment"))
    return upsert(customer, changed.unionByName(added), ["c_custkey"])


def merge_bucketed_snapshot(spark, sf_dir):
    """The older events at rest in a bucketed table, the newer ones merged into it with their deletes."""
    flat = flat_events(spark, sf_dir)
    name = f"event_snapshot_{uuid.uuid4().hex}"
    older = resolve_changes(flat.where(F.col("ts_ms") < CUT_MS), EVENT_KEYS, PAYLOAD, SOURCE_FIELDS)
    write_bucketed(older.where("not deleted").drop("deleted"), name, EVENT_KEYS, 16, scratch_dir(spark, "bucketed"))
    newer = resolve_changes(flat.where(F.col("ts_ms") >= CUT_MS), EVENT_KEYS, PAYLOAD, SOURCE_FIELDS)
    return merge_bucketed(name, newer, EVENT_KEYS, PAYLOAD)


def key_quarantine(spark, sf_dir):
    """An upsert whose incoming side repeats some keys: those rows are set aside, the others go in."""
    customer = table(spark, sf_dir, "customer")
    incoming = customer.where("c_mktsegment = 'BUILDING'").unionByName(customer.where("c_custkey % 7 = 0")) \
        .withColumn("c_acctbal", F.lit(0.0))
    clean, aside = split_repeated(incoming, ["c_custkey"])
    return upsert(customer, clean, ["c_custkey"]).withColumn("set_aside", F.lit(False)) \
        .unionByName(aside.withColumn("set_aside", F.lit(True)))


QUERIES = {f.__name__: f for f in (
    cdc_flatten, cdc_latest_single_key, cdc_latest_composite_key, cdc_deleted_keys, cdc_resolve_by_time,
    cdc_resolve_sticky, merge_incoming_wins, merge_incoming_wins_single_key, merge_keep_existing,
    apply_deletes_global, apply_deletes_skewed, upsert_snapshot, key_quarantine)}
QUERIES.update({"apply_deletes": apply_deletes_composite, "exclude_prefix": prefix_filter,
                "merge_bucketed": merge_bucketed_snapshot})

_FLAT = f"""{EVENTS_SQL},
flat AS (SELECT CASE WHEN NOT gone THEN user_id END AS user_id, CASE WHEN NOT gone THEN k END AS k,
                CASE WHEN NOT gone THEN event_type END AS event_type, CASE WHEN NOT gone THEN value END AS value,
                ts_ms, lsn,
                CASE WHEN event_type <> 'signup' THEN user_id END AS before_user_id,
                CASE WHEN event_type <> 'signup' THEN k END AS before_k
         FROM ev)"""


def _latest(source: str, keys: str, where: str = "NOT gone") -> str:
    return (f"SELECT user_id, k, event_type, value, ts_ms, lsn, gone FROM {source} WHERE {where} "
            f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY ts_ms DESC, lsn DESC) = 1")


def _merge(keys: str, kind: str) -> str:
    on = " AND ".join(f"n.{k} = o.{k}" for k in keys.split(", "))
    out = ", ".join(f"coalesce(n.{k}, o.{k}) AS {k}" for k in keys.split(", "))
    return f"""WITH {EVENTS_SQL.replace("value,", "CASE WHEN value <= 100 THEN value END AS value,")},
o AS ({_latest('ev', keys, f'NOT gone AND ts_ms < {CUT_MS}')}),
n AS ({_latest('ev', keys, f'NOT gone AND ts_ms >= {CUT_MS}')})
SELECT {out}, coalesce(n.event_type, o.event_type) AS event_type, coalesce(n.value, o.value) AS value
FROM n {kind} JOIN o ON {on}"""


ORACLE = {
    "cdc_flatten": f"WITH {_FLAT} SELECT * FROM flat",
    "cdc_latest_single_key": f"WITH {EVENTS_SQL}, l AS ({_latest('ev', 'user_id')}) "
                             "SELECT user_id, k, event_type, value, ts_ms, lsn FROM l",
    "cdc_latest_composite_key": f"WITH {EVENTS_SQL}, l AS ({_latest('ev', 'user_id, k')}) "
                                "SELECT user_id, k, event_type, value, ts_ms, lsn FROM l",
    "cdc_deleted_keys": f"WITH {EVENTS_SQL} SELECT DISTINCT user_id, k FROM ev WHERE gone",
    "cdc_resolve_by_time": f"""WITH {EVENTS_SQL}, l AS ({_latest('ev', 'user_id, k', 'TRUE')})
SELECT user_id, k, CASE WHEN NOT gone THEN event_type END AS event_type,
       CASE WHEN NOT gone THEN value END AS value, gone AS deleted FROM l""",
    "cdc_resolve_sticky": f"""WITH {EVENTS_SQL}, l AS ({_latest('ev', 'user_id, k')}),
g AS (SELECT user_id, k, bool_or(gone) AS deleted FROM ev GROUP BY user_id, k)
SELECT g.user_id, g.k, l.event_type, l.value, g.deleted
FROM g LEFT JOIN l ON g.user_id = l.user_id AND g.k = l.k""",
    "merge_incoming_wins": _merge("user_id, k", "LEFT"),
    "merge_incoming_wins_single_key": _merge("user_id", "LEFT"),
    "merge_keep_existing": _merge("user_id, k", "FULL"),
    "apply_deletes": f"""WITH {EVENTS_SQL}, l AS ({_latest('ev', 'user_id, k')})
SELECT user_id, k, event_type, value, ts_ms, lsn FROM l
WHERE NOT EXISTS (SELECT 1 FROM ev WHERE ev.gone AND ev.user_id = l.user_id AND ev.k = l.k)""",
    "apply_deletes_global": """
SELECT * FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM events WHERE event_type = 'error')""",
    "apply_deletes_skewed": """
WITH l AS (SELECT *, CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_partkey END AS company FROM lineitem)
SELECT * FROM l WHERE company = 0 OR company NOT IN (SELECT user_id FROM events WHERE event_type = 'error')""",
    "exclude_prefix": "SELECT * FROM part WHERE NOT starts_with(p_type, 'PROMO')",
    "merge_bucketed": f"""WITH {EVENTS_SQL},
o AS (SELECT * FROM ({_latest('ev', 'user_id, k', f'ts_ms < {CUT_MS}')}) WHERE NOT gone),
n AS ({_latest('ev', 'user_id, k', f'ts_ms >= {CUT_MS}')})
SELECT coalesce(n.user_id, o.user_id) AS user_id, coalesce(n.k, o.k) AS k, coalesce(n.event_type, o.event_type) AS event_type,
       coalesce(n.value, o.value) AS value
FROM n FULL JOIN o ON n.user_id = o.user_id AND n.k = o.k WHERE NOT coalesce(n.gone, FALSE)""",
    "key_quarantine": """
WITH i AS (SELECT *, c_mktsegment = 'BUILDING' AS one, c_custkey % 7 = 0 AS two FROM customer)
SELECT c_custkey, c_name, c_nationkey, CASE WHEN one <> two THEN 0.0::DOUBLE ELSE c_acctbal END AS c_acctbal, c_mktsegment,
       FALSE AS set_aside FROM i
UNION ALL
SELECT c_custkey, c_name, c_nationkey, 0.0, c_mktsegment, TRUE FROM i, (VALUES (1), (2)) WHERE one AND two""",
    "upsert_snapshot": """
SELECT c_custkey, c_name, c_nationkey,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 0.0::DOUBLE ELSE c_acctbal END AS c_acctbal, c_mktsegment
FROM customer
UNION ALL
SELECT -1 - s_suppkey, s_name, s_nationkey, s_acctbal, 'SUPPLIER' FROM supplier""",
}
