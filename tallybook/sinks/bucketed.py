"""Snapshots at rest in bucketed catalog tables: a merge moves the changes, not the snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallybook.operators.merge import merge_changes


def write_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int, location: str | None = None) -> None:
    """A new catalog table, dealt into ``buckets`` by ``keys`` and sorted by them in each; one file per bucket."""
    out = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
    if location:
        out = out.option("path", location)
    out.saveAsTable(table)


def merge_bucketed(table: str, resolved: DataFrame, keys: list[str], columns: list[str],
                   keep_existing: bool = True) -> DataFrame:
    """``merge_changes`` with a bucketed table: the changes are dealt into its buckets, its own rows stay where they are.

    Written with ``write_bucketed`` under a new name, with the same keys and buckets, the result is the next snapshot.
    """
    existing = resolved.sparkSession.table(table)
    return merge_changes(existing, resolved, keys, columns, keep_existing)
