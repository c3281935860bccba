"""Merging a keyed snapshot with newer rows, removing keys, and upserting.

The merges expect one row per key on each side (see ``latest_per_key``), so no join key is hot.
Nothing is broadcast by hint: the planner and AQE broadcast a side only when its measured size allows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.operators.hot_keys import HotKeys
from tallybook.operators.keys import require_unique


def merge_snapshot(existing: DataFrame, incoming: DataFrame, keys: list[str], columns: list[str],
                   keep_existing: bool = False, distinct: bool = False) -> DataFrame:
    """Per column the incoming value, or the existing one where incoming is null.

    By default the result holds the incoming keys only; ``keep_existing`` also keeps the rows that
    exist on the old side alone.
    """
    new = incoming.select(*keys, *columns).alias("incoming")
    old = existing.select(*keys, *columns).alias("existing")
    merged = new.join(old, on=keys, how="outer" if keep_existing else "left").select(
        *keys, *[F.coalesce(F.col(f"incoming.{c}"), F.col(f"existing.{c}")).alias(c) for c in columns])
    return merged.distinct() if distinct else merged


def merge_changes(existing: DataFrame, resolved: DataFrame, keys: list[str], columns: list[str],
                  keep_existing: bool = True) -> DataFrame:
    """``merge_snapshot`` and the deletes of ``resolve_changes`` in a single join."""
    new = resolved.select(*keys, *columns, "deleted").alias("incoming")
    old = existing.select(*keys, *columns).alias("existing")
    merged = new.join(old, on=keys, how="outer" if keep_existing else "left")
    alive = merged.filter(~F.coalesce(F.col("incoming.deleted"), F.lit(False)))
    return alive.select(*keys, *[F.coalesce(F.col(f"incoming.{c}"), F.col(f"existing.{c}")).alias(c)
                                 for c in columns])


def apply_deletes(df: DataFrame, deleted: DataFrame, keys: list[str], hot: HotKeys | None = None) -> DataFrame:
    """Rows whose key is not among the deleted ones.

    ``keys`` may be part of the row key (a date deleted for every company); then one key value can
    hold a large share of ``df``. ``hot``, measured on ``df`` (``HotKeys(df, keys)``), splits the rows of such values
    over as many tasks as they fill and repeats the deleted key for each of them. (AQE does not
    split this join by itself, as the deleted side is an aggregate.)
    """
    gone = deleted.select(*keys).distinct()
    if hot is None:
        return df.join(gone, on=keys, how="left_anti").select(*df.columns)
    return hot.dealt(df).join(hot.repeated(gone), on=[*keys, "_piece"], how="left_anti").select(*df.columns)


def upsert(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows replace target rows of the same key, nulls included; new keys are added.

    A key that the incoming side repeats, or that holds a null, fails the job (``split_repeated`` sets such rows
    aside beforehand). Each side is read once; the check uses the join's own partitions.
    """
    rest = [c for c in target.columns if c not in keys]
    new = require_unique(incoming, keys).select(*keys, F.struct(*rest, F.lit(True).alias("_")).alias("_new"))
    old = target.select(*keys, F.struct(*rest).alias("_old"))
    newer = F.col("_new").isNotNull()
    return old.join(new, on=keys, how="full").select(*[
        F.col(c) if c in keys else F.when(newer, F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c)
        for c in target.columns])


def exclude_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """Drop rows whose text starts with ``prefix``; null text is dropped too."""
    return df.filter(~F.col(column).startswith(prefix))
