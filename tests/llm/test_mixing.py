"""Mixing: less than one block of deviation in every slot, and no row lost."""

from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallybook.llm import queries
from tallybook.llm.mixing import in_mix_order, mix_sources, period_table, schedule_sql, whole_parts


def plain_schedule(parts):
    """Earliest deadline first, slot by slot."""
    period, done, out = sum(parts), [0] * len(parts), []
    for t in range(period):
        ready = [(-(-(k + 1) * period // p), i) for i, (k, p) in enumerate(zip(done, parts)) if k * period // p <= t and k < p]
        due, i = min(ready)
        assert due > t
        done[i] += 1
        out.append(i)
    return out


@given(st.lists(st.integers(1, 40), min_size=1, max_size=12))
@settings(max_examples=200, deadline=None)
def test_plain_schedule_stays_within_a_block(parts):
    period, done = sum(parts), [0] * len(parts)
    for t, i in enumerate(plain_schedule(parts)):
        done[i] += 1
        assert all(abs(d - p * (t + 1) / period) < 1 for d, p in zip(done, parts))


@pytest.mark.parametrize("parts", [[1], [3, 2, 5], [1, 1, 1, 1, 60], [7, 11, 13, 2, 2, 1]])
def test_sql_schedule_equals_plain(spark, parts):
    assert spark.range(1).select(F.expr(schedule_sql(parts))).first()[0] == plain_schedule(parts)


@given(st.dictionaries(st.text(max_size=3), st.floats(0, 1e6), min_size=1, max_size=30))
@settings(max_examples=100, deadline=None)
def test_whole_parts(weights):
    parts = whole_parts(weights, 100)
    assert set(parts) == {s for s, w in weights.items() if w > 0}
    assert not parts or sum(parts.values()) == 100 and min(parts.values()) >= 1


def docs_of(spark, sizes):
    rows = [(i * 100 + k, s) for i, (s, n) in enumerate(sizes.items()) for k in range(n)]
    return spark.createDataFrame(rows, "doc_id long, source string").withColumn("mix_slot", F.lit("clash"))


def test_shares_hold_until_a_source_runs_out(spark):
    weights = {"a": 5, "b": 3, "c": 2}
    mixed = mix_sources(docs_of(spark, {"a": 50, "b": 30, "c": 90}), weights, key=F.col("doc_id"), block_rows=1)
    order = [r.source for r in mixed.orderBy("mix_slot", "mix_offset").collect()]
    assert Counter(order) == {"a": 50, "b": 30, "c": 90}
    for n in range(1, 101):
        seen = Counter(order[:n])
        assert all(abs(seen[s] - w * n / 10) < 1 for s, w in weights.items())
    assert set(order[-60:]) == {"c"}


def test_nulls_unknown_sources_repeats_and_empty(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a"), (2, None), (3, "z"), (4, "z")], "doc_id long, source string")
    mixed = mix_sources(docs, {"a": 1.0, "": 1.0}, block_rows=2).orderBy("mix_slot", "mix_offset").collect()
    assert Counter((r.doc_id, r.source) for r in mixed) == Counter([(1, "a"), (1, "a"), (None, "a"), (2, None), (3, "z"), (4, "z")])
    assert [r.source for r in mixed[-2:]] == ["z", "z"]
    assert len({(r.source, r.mix_slot, r.mix_offset) for r in mixed}) == 6
    assert mix_sources(docs.limit(0)).count() == 0


def test_plan_has_no_python(spark):
    assert "Python" not in mix_sources(docs_of(spark, {"a": 3}), {"a": 1})._jdf.queryExecution().toString()


def test_query_against_plain_version(spark):
    folder = "/root/testdata/sf0.01"
    sizes = Counter(r.source for r in spark.read.parquet(f"{folder}/documents.parquet").collect())
    rows = queries.QUERIES["op6_mix_sources"](spark, folder).collect()
    assert Counter(r.source for r in rows) == sizes
    parts = whole_parts({s: n ** 0.5 for s, n in sizes.items()})
    names = sorted(parts)
    slots = {}
    for slot, i in enumerate(plain_schedule([parts[n] for n in names])):
        slots.setdefault(names[i], []).append(slot)
    for source, n in sizes.items():
        got = sorted((r.mix_block, r.mix_offset, r.mix_slot) for r in rows if r.source == source)
        assert got == [(k // 16, k % 16, k // 16 // parts[source] * 1000 + slots[source][k // 16 % parts[source]]) for k in range(n)]


def test_period_table_has_every_turn(spark):
    got = period_table(spark, {"a": 3, "b": 2}).collect()
    assert sorted((r.source, r.turn) for r in got) == [("a", 0), ("a", 1), ("a", 2), ("b", 0), ("b", 1)]


def rows_in_order(df, columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


@pytest.mark.parametrize("weights", [None, {"a": 3.0, "b": 1.0}, {}])
def test_documents_in_the_order_of_the_mix(spark, weights):
    rows = [(i, "a" if i % 3 else "b" if i % 2 else None, f"text {i}") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ordered = in_mix_order(docs, weights, key=F.col("doc_id"))
        assert ordered.columns == docs.columns and ordered.rdd.getNumPartitions() > 3
        got = rows_in_order(ordered, docs.columns)
        plan = ordered._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = mix_sources(docs, weights, key=F.col("doc_id")).orderBy("mix_slot", "mix_offset")
    assert got == rows_in_order(want, docs.columns)
    assert plan.count("Exchange") - plan.count("BroadcastExchange") - plan.count("REPARTITION") <= 2  # the slots' own, and this frame's


def test_order_of_the_mix_with_repeated_ids_nulls_and_no_rows(spark):
    rows = [(i % 40 if i % 7 else None, "a" if i % 2 else "b", f"t{i}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = rows_in_order(in_mix_order(docs, key=F.col("doc_id")), docs.columns)
    assert sorted(map(repr, got)) == sorted(map(repr, rows))
    assert in_mix_order(docs.limit(0), key=F.col("doc_id")).count() == 0
    assert in_mix_order(docs).count() == 600
