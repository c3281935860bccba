"""Change log: latest version, deletes, merge, upsert on small hand-written logs."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tallybook.operators.changes import (deleted_keys, flatten_changes, latest_per_key, resolve_changes,
                                         upserts)
from tallybook.operators.hot_keys import HotKeys, key_sketch, sketch_width
from tallybook.operators.merge import (apply_deletes, exclude_prefix, merge_changes, merge_snapshot, upsert)
from tallybook.schemas import statement_schema

ROW = statement_schema(["date"], ["sales"])
PAIR = statement_schema(["date", "company_name"], ["sales"])


def message(before, after, ts, names=("date", "sales")):
    def image(values):
        return None if values is None else dict(zip(names, values))
    return json.dumps({"payload": {"before": image(before), "after": image(after), "source": {"ts_ms": ts}}})


LOG = [
    message(None, ("Mar 2020", 10), 1),
    message(("Mar 2020", 10), ("Mar 2020", 12), 5),
    message(None, ("Mar 2020", 11), 3),
    message(None, ("Mar 2021", 20), 2),
    message(("Mar 2021", 20), None, 4),
    message(None, ("Mar 2022", 30), 1),
    message(("Mar 2022", 30), None, 2),
    message(None, ("Mar 2022", 33), 3),
    message(None, ("TTM", 99), 9),
    None,
    "not json",
]


def flat(spark, log=LOG, row=ROW, keys=("date",)):
    return flatten_changes(spark.createDataFrame([(m,) for m in log], "value string"), row, list(keys))


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_latest_and_deleted(spark):
    f = flat(spark)
    assert rows(latest_per_key(upserts(f, ["date"]), ["date"], ["ts_ms"]), "date", "sales") == [
        ("Mar 2020", 12.0), ("Mar 2021", 20.0), ("Mar 2022", 33.0), ("TTM", 99.0)]
    assert rows(deleted_keys(f, ["date"]), "date") == [("Mar 2021",), ("Mar 2022",)]


@pytest.mark.parametrize("rule, expected", [
    ("sticky", [("Mar 2020", 12.0)]),
    ("by_time", [("Mar 2020", 12.0), ("Mar 2022", 33.0)]),
])
def test_delete_rules(spark, rule, expected):
    final = resolve_changes(flat(spark), ["date"], ["sales"], ["ts_ms"], rule).filter("not deleted")
    assert rows(exclude_prefix(final, "date", "TTM"), "date", "sales") == expected


def test_unknown_delete_rule(spark):
    with pytest.raises(ValueError):
        resolve_changes(flat(spark), ["date"], ["sales"], ["ts_ms"], "never")


def test_sticky_rule_equals_separate_anti_join(spark):
    f = flat(spark)
    single_pass = resolve_changes(f, ["date"], ["sales"], ["ts_ms"], "sticky").filter("not deleted")
    two_steps = apply_deletes(latest_per_key(upserts(f, ["date"]), ["date"], ["ts_ms"]),
                              deleted_keys(f, ["date"]), ["date"])
    assert rows(single_pass, "date", "sales") == rows(two_steps, "date", "sales")


def test_order_of_arrival_does_not_matter(spark):
    expected = rows(resolve_changes(flat(spark), ["date"], ["sales"], ["ts_ms"]), "date", "sales", "deleted")
    for seed in range(3):
        log = LOG[:]
        random.Random(seed).shuffle(log)
        shuffled = resolve_changes(flat(spark, log), ["date"], ["sales"], ["ts_ms"])
        assert rows(shuffled, "date", "sales", "deleted") == expected


def test_composite_delete_uses_the_old_image(spark):
    names = ("date", "company_name", "sales")
    log = [message(None, ("d1", "A", 1), 1, names), message(None, ("d1", "B", 2), 1, names),
           message(("d1", "A", 1), None, 2, names)]
    f = flat(spark, log, PAIR, ("date", "company_name"))
    assert rows(deleted_keys(f, ["date", "company_name"]), "date", "company_name") == [("d1", "A")]
    latest = latest_per_key(upserts(f, ["date", "company_name"]), ["date", "company_name"], ["ts_ms"])
    gone = deleted_keys(f, ["date", "company_name"])
    assert rows(apply_deletes(latest, gone, ["date", "company_name"]), "company_name") == [("B",)]
    assert rows(apply_deletes(latest, gone, ["date"]), "company_name") == []


def test_a_message_is_parsed_once(spark):
    f = resolve_changes(flat(spark), ["date"], ["sales"], ["ts_ms"]).filter("not deleted")
    plan = exclude_prefix(f, "date", "TTM")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_hot_key_is_reduced_before_the_shuffle(spark):
    events = spark.range(60_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("date"),
        F.col("id").alias("ts_ms"))
    newest = latest_per_key(events, ["date"], ["ts_ms"])
    plan = newest._jdf.queryExecution().executedPlan().toString()
    shuffle = plan.index("Exchange hashpartitioning")
    assert plan.index("WindowGroupLimit", shuffle) > shuffle, "limited before the shuffle as well"
    assert newest.filter("date = 'hot'").collect()[0].ts_ms == 59_997
    assert newest.count() == 40_001


def snapshot(spark, data):
    return spark.createDataFrame(data, "date string, sales double")


def test_merge(spark):
    existing, incoming = snapshot(spark, [("d1", 1.0), ("d2", 2.0)]), snapshot(spark, [("d2", None), ("d3", 3.0)])
    assert rows(merge_snapshot(existing, incoming, ["date"], ["sales"]), "*") == [("d2", 2.0), ("d3", 3.0)]
    assert rows(merge_snapshot(existing, incoming, ["date"], ["sales"], keep_existing=True), "*") == [
        ("d1", 1.0), ("d2", 2.0), ("d3", 3.0)]


def test_merge_with_deletes_in_one_join(spark):
    existing = snapshot(spark, [("d1", 1.0), ("d2", 2.0), ("d4", 4.0)])
    resolved = spark.createDataFrame([("d2", None, False), ("d3", 3.0, False), ("d4", None, True)],
                                     "date string, sales double, deleted boolean")
    assert rows(merge_changes(existing, resolved, ["date"], ["sales"]), "*") == [
        ("d1", 1.0), ("d2", 2.0), ("d3", 3.0)]
    assert rows(merge_changes(existing, resolved, ["date"], ["sales"], keep_existing=False), "*") == [
        ("d2", 2.0), ("d3", 3.0)]


def test_upsert_twice_is_upsert_once(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    incoming = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    once = upsert(target, incoming, ["k"])
    assert rows(once, "*") == [(1, "a"), (2, "B"), (3, "c")]
    assert rows(upsert(once, incoming, ["k"]), "*") == rows(once, "*")


@pytest.fixture
def no_broadcast(spark):
    hint = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", hint)


def skewed(spark, rows=60_000):
    return spark.range(rows, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("date"), "id")


def test_hot_delete_key_is_spread(spark, no_broadcast):
    """A third of the rows share one date: it is found, its rows are spread, and nothing is lost."""
    data = skewed(spark)
    gone = spark.range(0, 60_000, 2).select(F.col("id").cast("string").alias("date"))
    for deleted in (gone, gone.union(spark.sql("select 'hot'"))):
        hot = HotKeys(data, ["date"], tasks=16)
        plain, split = apply_deletes(data, deleted, ["date"]), apply_deletes(data, deleted, ["date"], hot)
        assert split.columns == data.columns
        totals = [df.agg(F.count("*"), F.count_if(F.col("date") == "hot"), F.sum("id")).collect()[0] for df in (plain, split)]
        assert totals[0] == totals[1]
    assert "_piece" in split._jdf.queryExecution().executedPlan().toString()
    pieces = hot.with_pieces(data).groupBy("date").agg(F.max("_pieces").alias("n")).where("n > 1").collect()
    assert [(r.date, 40 <= r.n <= 48) for r in pieces] == [("hot", True)]
    sizes = hot.dealt(data).repartition(16, "date", "_piece").groupBy(F.spark_partition_id()).count().collect()
    sizes = sorted(r[1] for r in sizes)
    assert len(sizes) == 16 and sizes[-1] <= 2 * sizes[8]


def test_sketch_is_never_below_the_count_and_has_a_bound(spark):
    data = skewed(spark, 30_000)
    width = sketch_width(4)
    sketch = key_sketch(data, ["date"], width)
    assert sketch.count() <= 3 * width == 192
    halves = key_sketch(data.where("id < 9000"), ["date"], width).union(key_sketch(data.where("id >= 9000"), ["date"], width))
    whole = {(r.line, r.cell): r.n for r in sketch.collect()}
    assert whole == {(r.line, r.cell): r.n for r in halves.groupBy("line", "cell").agg(F.sum("n").alias("n")).collect()}
    assert max(whole.values()) >= 10_000


def test_hot_keys_of_an_empty_table_and_of_nulls(spark):
    nothing = spark.createDataFrame([], "date string, id long")
    assert apply_deletes(nothing, nothing, ["date"], HotKeys(nothing, ["date"])).count() == 0
    data = spark.range(100).select(F.lit(None).cast("string").alias("date"), "id").union(spark.sql("select 'x', 1L"))
    gone = spark.createDataFrame([(None,), ("x",)], "date string")
    assert apply_deletes(data, gone, ["date"], HotKeys(data, ["date"])).count() == 100, "null equals nothing"
