"""Files and tables: one ordered file by many tasks, replacement without a gap, keys that hold, merges at rest."""

import re
import threading
import uuid

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallybook.operators.keys import require_new, require_unique, split_repeated
from tallybook.operators.merge import upsert
from tallybook.queries import QUERIES
from tallybook.session import list_files, read_text, scratch_dir
from tallybook.sinks import files
from tallybook.sinks.bucketed import merge_bucketed, write_bucketed
from tallybook.sinks.files import header_line, read_csv, write_csv
from tallybook.sinks.tables import append_table, create_table, declared_keys, replace_table


def name():
    return f"t_{uuid.uuid4().hex}"


def failure(action):
    with pytest.raises((PySparkException, Py4JJavaError)) as caught:
        action()
    return str(caught.value)


@pytest.fixture
def wide_shuffles(spark):
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


@pytest.mark.parametrize("count", [1, 3])
def test_one_ordered_file_is_written_by_all_tasks(spark, monkeypatch, wide_shuffles, count):
    joined = []
    join = files.join_files
    monkeypatch.setattr(files, "join_files", lambda s, target, head, parts: (joined.append(len(parts)), join(s, target, head, parts)))
    df = spark.range(2000).selectExpr("id", "concat('a \"', id, '\", b') as `t,x`").repartition(5)
    path = scratch_dir(spark, "ordered")
    for _ in range(2):  # the second one replaces the first
        write_csv(df.orderBy(F.desc("id")), path, files=count, ordered=True)
    assert len(list_files(spark, path)) == count and sum(joined) == 2 * 8, "eight tasks sorted and wrote"
    back = read_csv(spark, path, df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    texts = [read_text(spark, f) for f in list_files(spark, path)]
    assert all(t.startswith('id,"t,x"\n') for t in texts)
    order = [int(x) for t in texts for x in re.findall(r"^(\d+),", t, re.M)]
    assert order == sorted(order, reverse=True) and len(order) == 2000


def test_an_ordered_file_without_rows(spark):
    path, df = scratch_dir(spark, "none"), spark.range(5).where("id > 9")
    write_csv(df.orderBy("id"), path, files=1, ordered=True)
    assert read_csv(spark, path, df.schema).count() == 0
    assert [read_text(spark, f) for f in list_files(spark, path)] == ["id\n"]
    assert header_line(['a"b', "c\nd", "e"]) == '"a""b","c\nd",e\n'


def test_a_reader_never_misses_the_table(spark):
    path, table = scratch_dir(spark, "switch"), name()
    create_table(spark, table, spark.range(1).schema, path)
    replace_table(spark.range(100), table, path)
    counts, failures, stop = [], [], threading.Event()

    def read():
        session = spark.newSession()
        while not stop.is_set():
            try:
                counts.append(session.table(table).count())
            except Exception as error:  # noqa: BLE001
                failures.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for n in (200, 300, 400):
        replace_table(spark.range(n), table, path, keep=9)
    stop.set()
    reader.join()
    assert not failures and set(counts) <= {100, 200, 300, 400} and counts
    assert spark.table(table).count() == 400


def test_replacements_keep_few_versions(spark):
    path, table = scratch_dir(spark, "versions"), name()
    for n in range(5):
        replace_table(spark.range(n).selectExpr("id", "id as more") if n > 2 else spark.range(n), table, path)
    assert spark.table(table).columns == ["id", "more"] and spark.table(table).count() == 4
    assert len(list_files(spark, path)) == 2
    replace_table(spark.sql("select 'x' as id"), table, path)
    assert [tuple(r) for r in spark.table(table).collect()] == [("x",)]


def test_a_failed_replacement_leaves_the_table(spark):
    path, table = scratch_dir(spark, "failed"), name()
    replace_table(spark.range(3), table, path)
    failure(lambda: replace_table(spark.range(9).selectExpr("raise_error('no') as id").selectExpr("cast(id as long) id"), table, path))
    assert spark.table(table).count() == 3


def test_declared_keys_hold(spark):
    path, table = scratch_dir(spark, "keys"), name()
    rows = spark.createDataFrame([("Mar 2014", "A", 1.0), ("Mar 2014", "B", 2.0)], "date string, company string, v double")
    create_table(spark, table, rows.schema, path, keys=["date", "company"])
    assert declared_keys(spark, table) == ["date", "company"]
    append_table(rows, table)
    assert "key is there already: date=Mar 2014, company=A" in failure(lambda: append_table(rows.limit(1), table))
    assert "key stands twice: date=Mar 2014, company=B" in failure(lambda: replace_table(rows.union(rows.where("v = 2")), table, path))
    assert "key holds a null: date=null, company=A" in failure(
        lambda: append_table(rows.limit(1).withColumn("date", F.lit(None).cast("string")), table))
    assert spark.table(table).count() == 2
    replace_table(rows.withColumn("v", F.col("v") + 1), table, path)
    assert sorted(r.v for r in spark.table(table).collect()) == [2.0, 3.0] and declared_keys(spark, table)


def test_upsert_names_a_repeated_key(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    assert "key stands twice: k=2" in failure(lambda: upsert(target, spark.createDataFrame([(2, "x"), (2, "y")], "k int, v string"), ["k"]).collect())
    nothing = target.limit(0)
    assert upsert(target, nothing, ["k"]).count() == 1 and upsert(nothing, target, ["k"]).count() == 1


def test_the_check_uses_the_partitions_of_the_join(spark):
    a, b = (spark.range(100).selectExpr("id % 50 as k", "id as v") for _ in range(2))
    hint = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = upsert(a, b, ["k"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", hint)
    assert plan.count("Exchange hashpartitioning") == 2


def test_repeated_keys_are_set_aside(spark):
    rows = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (1, "b", 3), (None, "c", 4), (2, None, 5), (2, None, 6)], "k int, l string, v int")
    clean, aside = split_repeated(rows, ["k", "l"])
    assert [r.v for r in clean.collect()] == [3] and sorted(r.v for r in aside.collect()) == [1, 2, 4, 5, 6]
    assert require_unique(clean, ["k", "l"]).count() == 1 and require_new(clean, rows.where("v = 1"), ["k", "l"]).count() == 1
    assert [d.count() for d in split_repeated(rows.limit(0), ["k"])] == [0, 0]


def test_a_bucketed_snapshot_stays_where_it_is(spark):
    hint = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table, after = name(), name()
        rows = spark.range(500).selectExpr("id % 10 as a", "id div 10 as b", "cast(id as double) as v")
        write_bucketed(rows, table, ["a", "b"], 12, scratch_dir(spark, "buckets"))
        changes = spark.range(20).selectExpr("id % 10 as a", "id + 45 as b", "-1.0D as v", "id = 3 as deleted")
        merged = merge_bucketed(table, changes, ["a", "b"], ["v"])
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1, "only the changes are dealt out"
        snapshot_side = plan[:plan.index("FileScan parquet")].rsplit("SortMergeJoin", 1)[1]
        assert "Exchange" not in snapshot_side.rsplit("+- ", 3)[-1] and "SelectedBucketsCount: 12 out of 12" in plan
        assert merged.count() == len({(r.a, r.b) for r in rows.union(changes.select("a", "b", "v")).collect()}) - 1
        write_bucketed(merged, after, ["a", "b"], 12, scratch_dir(spark, "buckets"))
        assert spark.table(after).count() == merged.count()
        again = merge_bucketed(after, changes, ["a", "b"], ["v"])
        assert sorted(map(tuple, again.collect())) == sorted(map(tuple, merged.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", hint)


def test_the_bucketed_query_moves_no_snapshot_rows(spark):
    plan = QUERIES["merge_bucketed"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "SelectedBucketsCount: 16 out of 16" in plan or "BroadcastHashJoin" in plan
