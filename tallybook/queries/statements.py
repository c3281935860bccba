"""The complete statement jobs over the event log and the line-item statements."""

from __future__ import annotations

from tallybook.plans import jobs
from tallybook.queries.inputs import (SOURCE_FIELDS, change_rows_sql, line_statements, line_statements_sql,
                                      sql_ratio, sql_round, statement_envelopes)
from tallybook.schemas import MEASURES


MONTHS_LATER = 48  # dates the existing statements past the last period that the log deletes


def _inputs(spark, sf_dir, keys, months_later=0):
    return (statement_envelopes(spark, sf_dir, keys).select("value"),
            line_statements(spark, sf_dir, keys, months_later))


def statement_kpis(spark, sf_dir):
    return jobs.statement_kpis(*_inputs(spark, sf_dir, jobs.MULTI_KEYS), source_fields=SOURCE_FIELDS)


def statement_kpis_label_order(spark, sf_dir):
    return jobs.statement_kpis(*_inputs(spark, sf_dir, jobs.MULTI_KEYS), growth_order="label",
                               deletes="sticky", source_fields=SOURCE_FIELDS)


def statement_kpis_global_deletes(spark, sf_dir):
    """A delete takes its period away from every company."""
    return jobs.statement_kpis(*_inputs(spark, sf_dir, jobs.MULTI_KEYS, MONTHS_LATER), growth_order="label",
                               delete_keys=["date"], source_fields=SOURCE_FIELDS)


def statement_merge(spark, sf_dir):
    return jobs.statement_merge(*_inputs(spark, sf_dir, jobs.MULTI_KEYS), source_fields=SOURCE_FIELDS)


def statement_merge_sticky_deletes(spark, sf_dir):
    return jobs.statement_merge(*_inputs(spark, sf_dir, jobs.MULTI_KEYS), deletes="sticky",
                                source_fields=SOURCE_FIELDS)


def statement_summary(spark, sf_dir):
    return jobs.statement_summary(*_inputs(spark, sf_dir, ["date"]), source_fields=SOURCE_FIELDS)


QUERIES = {f.__name__: f for f in (statement_kpis, statement_kpis_label_order, statement_kpis_global_deletes, statement_merge, statement_merge_sticky_deletes,
                                   statement_summary)}


def _merged(keys: list[str], join: str, sticky: bool = False, gone_by: list[str] | None = None,
            months_later: int = 0) -> str:
    """CTE ``m``: newest changes over existing statements."""
    names = ", ".join(keys)
    ranked = f"row_number() OVER (PARTITION BY {names} ORDER BY ts_ms DESC, lsn DESC) = 1"
    on = " AND ".join(f"n.{k} = ex.{k}" for k in keys)
    alive = f"""n AS (SELECT * FROM ch WHERE NOT gone QUALIFY {ranked}),
gone_keys AS (SELECT DISTINCT {', '.join(gone_by or keys)} FROM ch WHERE gone),""" if sticky else f"""n AS (SELECT * FROM ch QUALIFY {ranked}),
gone_keys AS (SELECT {names} FROM n WHERE gone),"""
    values = ", ".join(f"coalesce(n.{m}, ex.{m}) AS {m}" for m in MEASURES)
    names = ", ".join(gone_by or keys)
    return f"""{change_rows_sql(keys)},
{line_statements_sql(keys, months_later)},
{alive}
j AS (SELECT {', '.join(f'coalesce(n.{k}, ex.{k}) AS {k}' for k in keys)}, {values}
      FROM n {join} JOIN ex ON {on}),
m AS (SELECT j.* FROM j ANTI JOIN gone_keys USING ({names}))"""


def _growth(measure: str) -> str:
    before = f"lag({measure}) OVER period_order"
    return sql_ratio(f"{measure} - {before}", before, " * 100")


def _average(measure: str) -> str:
    return sql_round(f"avg({measure})")


_MERGE_SQL = "WITH {} SELECT date, company_name, " + ", ".join(MEASURES) + " FROM m WHERE NOT starts_with(date, 'TTM')"
IN_TIME = "CASE WHEN date <> 'TTM' THEN strptime('01 ' || date, '%d %b %Y') END NULLS LAST"


def kpis_sql(merged: str, order: str) -> str:
    return f"""WITH {merged},
g AS (SELECT m.*, {sql_ratio('net_profit', 'sales', ' * 100')} AS net_profit_margin,
       {sql_ratio('operating_profit', 'sales', ' * 100')} AS operating_profit_margin,
       {sql_round('tax_percent * profit_before_tax / 100')} AS tax_amount,
       {sql_round('dividend_payout_percent * eps_in_rs / 100')} AS dividend_yield,
       {sql_ratio('operating_profit', 'interest')} AS interest_coverage_ratio,
       {_growth('sales')} AS yoy_sales_growth, {_growth('net_profit')} AS yoy_net_profit_growth
      FROM m WINDOW period_order AS (PARTITION BY company_name ORDER BY {order}))
SELECT * FROM g WHERE NOT starts_with(date, 'TTM')"""


ORACLE = {
    "statement_kpis": kpis_sql(_merged(jobs.MULTI_KEYS, "FULL"), IN_TIME),
    "statement_kpis_label_order": kpis_sql(_merged(jobs.MULTI_KEYS, "FULL", sticky=True), "date"),
    "statement_kpis_global_deletes": kpis_sql(
        _merged(jobs.MULTI_KEYS, "FULL", sticky=True, gone_by=["date"], months_later=MONTHS_LATER), "date"),
    "statement_merge": _MERGE_SQL.format(_merged(jobs.MULTI_KEYS, "LEFT")),
    "statement_merge_sticky_deletes": _MERGE_SQL.format(_merged(jobs.MULTI_KEYS, "LEFT", sticky=True)),
    "statement_summary": f"""WITH {_merged(['date'], 'LEFT')},
d AS (SELECT date, {', '.join(MEASURES)} FROM m WHERE NOT starts_with(date, 'TTM')),
u AS (SELECT * FROM d UNION ALL SELECT 'Average', {', '.join(_average(m) for m in MEASURES)} FROM d)
SELECT * FROM u WHERE {' AND '.join(f'{c} IS NOT NULL' for c in ['date', *MEASURES])}""",
}
