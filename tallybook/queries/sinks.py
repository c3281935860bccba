"""Sink queries: what was written, read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallybook.operators.measures import append_summary, complete_rows, summary_last
from tallybook.queries.inputs import hundredths, sql_round, table
from tallybook.session import scratch_dir
from tallybook.sinks.files import preview, read_csv, write_csv
from tallybook.sinks.tables import append_table, create_table, replace_table


def sink_csv_roundtrip(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    path = scratch_dir(spark, "orders-csv")
    write_csv(orders, path)
    return read_csv(spark, path, orders.schema)


def sink_csv_single_file(spark, sf_dir):
    """Mean balance per nation and segment with a closing row of means, in one file."""
    sums = table(spark, sf_dir, "customer").groupBy("c_nationkey", "c_mktsegment").agg(
        (F.sum(hundredths("c_acctbal")) / 100).alias("balance"),
        F.count(F.lit(1)).cast("double").alias("customers"))
    named = sums.select(F.concat_ws(" ", F.col("c_nationkey").cast("string"), "c_mktsegment").alias("date"),
                        "balance", "customers")
    summed = append_summary(named, "date", ["balance", "customers"])
    report = summary_last(complete_rows(summed, ["date", "balance", "customers"]), F.col("date"))
    path = scratch_dir(spark, "report-csv")
    write_csv(report, path, files=1, ordered=True)
    return read_csv(spark, path, report.schema)


def sink_table_replace(spark, sf_dir):
    """Create the table, put suppliers in, then replace them with the customers."""
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("key"))
    name, path = f"accounts_{uuid.uuid4().hex}", scratch_dir(spark, "accounts")
    create_table(spark, name, customer.schema, path)
    create_table(spark, name, customer.schema, path)
    append_table(supplier, name)
    replace_table(customer, name, path)
    return spark.table(name)


def head_rows(spark, sf_dir):
    return preview(table(spark, sf_dir, "orders"), ["o_orderkey"], 5)


QUERIES = {f.__name__: f for f in (sink_csv_roundtrip, sink_csv_single_file, sink_table_replace, head_rows)}

ORACLE = {
    "sink_csv_roundtrip": "SELECT * REPLACE (CAST(o_orderdate AS DATE) AS o_orderdate) FROM orders",
    "sink_csv_single_file": f"""WITH d AS (
SELECT c_nationkey || ' ' || c_mktsegment AS date,
       CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance, CAST(count(*) AS DOUBLE) AS customers
FROM customer GROUP BY c_nationkey, c_mktsegment)
SELECT * FROM d
UNION ALL
SELECT 'Average', {sql_round('avg(balance)')}, {sql_round('avg(customers)')} FROM d""",
    "sink_table_replace": "SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance FROM customer",
    "head_rows": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5",
}
