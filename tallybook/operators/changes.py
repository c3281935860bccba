"""Change envelopes to keyed rows: flatten, split, and keep the newest version of each key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.schemas import envelope_schema


def flatten_changes(envelopes: DataFrame, row: T.StructType, keys: list[str],
                    source_fields: list[str] | None = None) -> DataFrame:
    """Parse ``value`` and lift ``after.*``, the source fields and ``before_<key>`` to the top.

    Unreadable messages give a row of nulls, which every later filter leaves out. The parsed message
    goes through ``explode`` of a one-element array: filters on its fields then stay above it, where
    otherwise each would be pushed below and parse the message again.
    """
    sources = source_fields or ["ts_ms"]
    others = [c for c in envelopes.columns if c != "value"]
    message = F.from_json("value", envelope_schema(row, sources, before=keys))
    parsed = envelopes.select(*others, F.explode(F.array(message)).alias("data"))
    return parsed.select(
        *others,
        *[F.col(f"data.payload.after.{c}").alias(c) for c in row.names],
        *[F.col(f"data.payload.source.{c}").alias(c) for c in sources],
        *[F.col(f"data.payload.before.{k}").alias(f"before_{k}") for k in keys],
    )


def is_upsert(keys: list[str]) -> Column:
    return F.col(keys[0]).isNotNull()


def is_delete(keys: list[str]) -> Column:
    return F.col(f"before_{keys[0]}").isNotNull() & F.col(keys[0]).isNull()


def upserts(flat: DataFrame, keys: list[str]) -> DataFrame:
    """Inserts and updates: events whose leading key is present after the change."""
    return flat.filter(is_upsert(keys)).drop(*[f"before_{k}" for k in keys])


def deleted_keys(flat: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys of delete events, taken from the image before the change."""
    return flat.filter(is_delete(keys)).select(*[F.col(f"before_{k}").alias(k) for k in keys]).distinct()


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Newest row of each key; ``order`` lists the time column first, then tie-breaks.

    Spark limits each group to one row before the shuffle as well as after it, so a key with
    a third of all rows sends one row per map task.
    """
    newest = W.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("_nth", F.row_number().over(newest)).filter("_nth = 1").drop("_nth")


def versions(flat: DataFrame, keys: list[str], columns: list[str], order: list[str]) -> DataFrame:
    """One row per usable event, deletes included: ``keys, columns, order, deleted``."""
    gone = is_delete(keys)
    return flat.filter(is_upsert(keys) | gone).select(
        *[F.when(gone, F.col(f"before_{k}")).otherwise(F.col(k)).alias(k) for k in keys],
        *columns, *order, gone.alias("deleted"))


def resolve_changes(flat: DataFrame, keys: list[str], columns: list[str], order: list[str],
                    deletes: str = "by_time") -> DataFrame:
    """Final state of each key in a change log: ``keys, columns, deleted``.

    ``by_time``: the newest event decides. ``sticky``: a key deleted once stays deleted, even if a
    later event brings it back. Either way the log is read and shuffled once.
    """
    events = versions(flat, keys, columns, order)
    if deletes == "by_time":
        return latest_per_key(events, keys, order).select(*keys, *columns, "deleted")
    if deletes != "sticky":
        raise ValueError(f"unknown delete rule: {deletes}")
    alive = ~F.col("deleted")
    return (events.groupBy(*keys)
            .agg(F.max_by(F.when(alive, F.struct(*columns)), F.when(alive, F.struct(*order))).alias("_row"),
                 F.bool_or("deleted").alias("deleted"))
            .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in columns], "deleted"))
