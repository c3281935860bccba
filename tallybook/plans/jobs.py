"""The complete jobs: change log to statements with measures, pages to statements, bars to years."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallybook.functions.times import period_start
from tallybook.operators.bars import fiscal_year_bars
from tallybook.operators.changes import (deleted_keys, flatten_changes, latest_per_key, resolve_changes,
                                         upserts)
from tallybook.operators.hot_keys import HotKeys
from tallybook.operators.measures import (append_summary, complete_rows, summary_last, with_growth,
                                          with_ratios)
from tallybook.operators.merge import apply_deletes, exclude_prefix, merge_changes, merge_snapshot
from tallybook.operators.notices import page_notices, watch_changes
from tallybook.operators.statements import clean_cells, pivot_cells
from tallybook.schemas import MEASURES, SUMMARY_LABEL, TRAILING_LABEL, statement_schema
from tallybook.session import materialise
from tallybook.sources.pages import page_rows, page_tables, table_cells

MULTI_KEYS = ["date", "company_name"]
LAST_DAY = "9999-12-31"  # stands in for periods that name no month


def merged_statements(envelopes: DataFrame, existing: DataFrame, keys: list[str], keep_existing: bool,
                      deletes: str = "by_time", source_fields: list[str] | None = None,
                      order: list[str] | None = None, delete_keys: list[str] | None = None,
                      notices: Observation | str | None = None) -> DataFrame:
    """Newest statements of a change log over an existing snapshot, deletes applied.

    ``order`` lists what decides between events of one key: source fields and columns that come with
    the envelopes, such as the offset; by default the source fields, then the offset if there is one.
    With ``delete_keys``, part of the keys, every delete in the log takes away all rows that agree with
    it on those, old and new (the log is then parsed once into the shared folder). ``notices`` counts upserts, deletes
    and messages that are neither.
    """
    sources = source_fields or ["ts_ms"]
    by = order or [*sources, *[c for c in ("offset",) if c in envelopes.columns]]
    flat = watch_changes(flatten_changes(envelopes, statement_schema(keys), keys, sources), keys, notices)
    if delete_keys:
        flat = materialise(flat, "flat-log")
        latest = latest_per_key(upserts(flat, keys), keys, by)
        merged = merge_snapshot(existing, latest, keys, MEASURES, keep_existing)
        merged = materialise(merged, "merged")  # measured, then filtered
        return apply_deletes(merged, deleted_keys(flat, keys), delete_keys, HotKeys(merged, delete_keys))
    resolved = resolve_changes(flat, keys, MEASURES, by, deletes)
    return merge_changes(existing, resolved, keys, MEASURES, keep_existing)


def statement_merge(envelopes: DataFrame, existing: DataFrame, **settings) -> DataFrame:
    """Statements of the changed keys of many companies, sorted, trailing periods left out."""
    merged = merged_statements(envelopes, existing, MULTI_KEYS, keep_existing=False, **settings)
    return exclude_prefix(merged, "date", TRAILING_LABEL).orderBy("company_name", "date") \
        .select("date", *MEASURES, "company_name")


def statement_summary(envelopes: DataFrame, existing: DataFrame, **settings) -> DataFrame:
    """Statements of one company with a closing row of means; incomplete rows left out.

    The means cover rows that are incomplete elsewhere too: they are taken before the filter.
    """
    merged = merged_statements(envelopes, existing, ["date"], keep_existing=False, **settings)
    summed = append_summary(exclude_prefix(merged, "date", TRAILING_LABEL), "date", MEASURES)
    return summary_last(complete_rows(summed, ["date", *MEASURES]), period_start(F.col("date")))


def add_kpis(merged: DataFrame, order: str = "time", split_companies: bool = False) -> DataFrame:
    """Ratios and growth of merged statements, trailing periods left out.

    Growth compares with the preceding period in time; ``order="label"`` compares in label order.
    The trailing period takes part last, so that it is never another period's predecessor.
    A company's statements share a task, which is fine for months or quarters; ``split_companies``
    cuts long series by calendar year first (the merged rows are then written once and read twice).
    """
    growth = {"yoy_sales_growth": "sales", "yoy_net_profit_growth": "net_profit"}
    source = materialise(merged, "merged-statements") if split_companies else merged
    dated = with_ratios(source).withColumn(
        "_start", F.coalesce(period_start(F.col("date")), F.lit(LAST_DAY).cast("date")))
    by = [F.col("_start"), F.col("date")] if order == "time" else [F.col("date")]
    bucket = None
    if split_companies:
        bucket = F.year("_start") if order == "time" else F.substring("date", 1, 3)
    grown = with_growth(dated, ["company_name"], by, growth, bucket).drop("_start")
    return exclude_prefix(grown, "date", TRAILING_LABEL)


def with_kpis(merged: DataFrame, order: str = "time", split_companies: bool = False) -> DataFrame:
    """``add_kpis``, sorted by company and period."""
    return add_kpis(merged, order, split_companies).orderBy("company_name", "date")


def statement_kpis(envelopes: DataFrame, existing: DataFrame, growth_order: str = "time",
                   split_companies: bool = False, **settings) -> DataFrame:
    """All statements of many companies, old and changed, with ratios and growth.

    ``growth_order="label", delete_keys=["date"]`` gives growth in label order, with a delete taking its
    period away from every company.
    """
    merged = merged_statements(envelopes, existing, MULTI_KEYS, keep_existing=True, **settings)
    return with_kpis(merged, growth_order, split_companies)


def statement_cells(pages: DataFrame, section_id: str, company: str = "company_name",
                    notices: Observation | str | None = None) -> DataFrame:
    """All cells of the statement tables, long: company, date, col_no, row_no, label, value.

    Needs no list of line items, however many the pages have. ``notices`` counts rows of another width.
    """
    cells = clean_cells(table_cells(page_tables(pages, [company], section_id, notices=notices), [company]), [company])
    return cells.select(company, F.col("period").alias("date"), "col_no", "row_no", "label", "value")


def load_statements(pages: DataFrame, section_id: str, labels: list[str], company: str = "company_name",
                    notices: Observation | str | None = None) -> DataFrame:
    """Statement tables of all pages as one table: a row per company and period, a column per wanted label."""
    cells = statement_cells(pages, section_id, company, notices).withColumnRenamed("date", "period")
    return pivot_cells(cells, [company], labels).fillna(0, subset=labels)


def load_with_notices(pages: DataFrame, section_id: str, labels: list[str],
                      company: str = "company_name") -> tuple[DataFrame, DataFrame]:
    """The statement tables, and per company what was left out: rows of another width, cells that are no number.

    The pages are parsed once; both come from the rows written then. Companies whose pages have no such table have 0 rows.
    """
    names = pages.select(company).distinct()
    rows = materialise(page_rows(pages, [company], section_id), "table-rows")
    cells = clean_cells(table_cells(rows.where("fits").drop("fits"), [company]), [company])
    notices = names.join(page_notices(rows, [company]), company, "left").fillna(0)
    return pivot_cells(cells, [company], labels).fillna(0, subset=labels), notices


def load_bars(bars: DataFrame, start_year: int | None = None, end_year: int | None = None,
              names: DataFrame | None = None, **settings) -> DataFrame:
    """Fiscal-year bars of all companies, of all years unless a range is given.

    ``names`` (``symbol, company``) turns the symbols that bars come under into company names; it is
    joined to the yearly rows, not to the daily ones. Symbols without a name are left out.
    """
    yearly = fiscal_year_bars(bars, ["company"], "date", start_year, end_year, **settings)
    if names is None:
        return yearly
    return yearly.withColumnRenamed("company", "symbol").join(names, "symbol") \
        .select("date", "company", "open", "high", "low", "close", "volume")


def without_summary(snapshot: DataFrame) -> DataFrame:
    """A snapshot without the row of means, ready to be merged again."""
    return snapshot.filter(F.col("date") != SUMMARY_LABEL)
