"""Jobs that run again and again: each pass reads what is new and changes what the new rows touch.

The result of one pass is the snapshot of the next. Rows and read positions are committed in one version, so a pass that
fails anywhere before that is simply repeated, and one that finds nothing new changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.operators.changes import flatten_changes, latest_per_key, resolve_changes
from tallybook.operators.merge import merge_changes
from tallybook.plans.jobs import MULTI_KEYS, add_kpis
from tallybook.schemas import MEASURES, statement_schema
from tallybook.session import materialise
from tallybook.sinks.buckets import Snapshot, Version
from tallybook.sources.positions import positions_after


def bounded_pass(table: Snapshot, source: str, read: Callable[[dict], DataFrame],
                 resolve: Callable[[DataFrame], DataFrame],
                 combine: Callable[[DataFrame, DataFrame], DataFrame]) -> Version | None:
    """One pass: the messages after the positions that ``table`` holds for ``source``, merged into it.

    ``read(start)`` gives ``value, partition, offset``; ``resolve`` one row per changed key; ``combine(rows, changes)``
    what the touched buckets hold from now on. None if nothing is new. The new messages are written once, so rows and
    positions come from the same ones, whatever arrives meanwhile.
    """
    start = table.version().marks.get(source, {})
    new = materialise(read(start), "messages")
    end = positions_after(new, start)
    if end == start:
        return None
    return table.apply(resolve(new), combine, {source: end})


def newest_rows(keys: list[str], order: list[str]) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """``combine`` for tables that keep the order columns and deleted rows: the newest version of each key stands."""
    return lambda rows, changes: latest_per_key(rows.unionByName(changes), keys, order)


def kpi_table(table: Snapshot, statements: DataFrame, order: str = "time") -> Version:
    """Make ``statements`` with their ratios and growth the first version of a KPI snapshot.

    The table's buckets have to go by ``company_name``: growth looks at all statements of a company.
    """
    if table.bucket_by != ["company_name"]:
        raise ValueError("a KPI snapshot goes by company_name")
    return table.load(add_kpis(statements.select(*MULTI_KEYS, *MEASURES), order))


def kpi_pass(table: Snapshot, envelopes: DataFrame, source_fields: list[str] | None = None, order: str = "time",
             deletes: str = "by_time", marks: dict | None = None) -> Version:
    """Merge changes into a KPI snapshot: the statements of the touched companies are read, merged and measured anew."""
    sources = source_fields or ["ts_ms"]
    flat = flatten_changes(envelopes, statement_schema(MULTI_KEYS), MULTI_KEYS, sources)
    by = [*sources, *[c for c in ("offset",) if c in envelopes.columns]]
    resolved = resolve_changes(flat, MULTI_KEYS, MEASURES, by, deletes).where(F.col("company_name").isNotNull())

    def merged(rows: DataFrame, changes: DataFrame) -> DataFrame:
        return add_kpis(merge_changes(rows, changes, MULTI_KEYS, MEASURES, keep_existing=True), order)

    return table.apply(resolved, merged, marks)
