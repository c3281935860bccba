"""Bucket tables: what a change rewrites, what a reader sees, and passes that start where the last one ended."""

import random

import pytest
from pyspark.sql import functions as F

from tallybook.operators.changes import latest_per_key
from tallybook.plans.passes import bounded_pass, kpi_table, newest_rows
from tallybook.schemas import MEASURES, statement_schema
from tallybook.session import create_text, list_files, scratch_dir
from tallybook.sinks.buckets import Snapshot, TieredLog, VersionTaken
from tallybook.sources.positions import kafka_start, positions_after, read_after

ROWS = "k string, t long, v double, deleted boolean"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), ROWS)


def files(table, buckets=None):
    return {f for f in (table.read(buckets) if isinstance(table, Snapshot) else
                        table.stored(table.version(), buckets)).inputFiles()}


def scanned(df):
    """The folders that a plan's scan lists."""
    return {f.split("/runs/")[1].rsplit("/", 1)[0] for f in df.inputFiles()}


def test_log_equals_plain_latest_and_levels_bound_the_runs(spark):
    rng = random.Random(4)
    log = TieredLog(spark, scratch_dir(spark, "log"), ["k"], ["t"], buckets=4, first_rows=5, fan=3)
    everything = []
    for batch in range(14):
        rows = {f"k{rng.randrange(60)}": (rng.randrange(1000), float(batch), rng.random() < 0.2) for _ in range(rng.randrange(1, 40))}
        rows = [(k, *r) for k, r in rows.items()]
        everything += [(k, t, v, d, batch) for k, t, v, d in rows]
        log.add(frame(spark, *rows), "s", batch)
        for runs in log.version().files.values():
            levels = [level for _, level, _ in runs]
            assert levels == sorted(set(levels)), "one run per level, the lowest first"
            assert all(n <= 5 * 3 ** level for _, level, n in runs)
            assert len(runs) <= 5
    best = {}
    for k, t, v, d, batch in everything:
        best[k] = max(best.get(k, (-1,)), (t, batch, v, d))
    want = sorted((k, t, v) for k, (t, _, v, d) in best.items() if not d)
    assert sorted(tuple(r) for r in log.newest().collect()) == want
    per_key = log.stored(log.version()).groupBy("k").count().agg(F.max("count")).first()[0]
    assert per_key <= max(len(runs) for runs in log.version().files.values())


def test_publish_reads_the_touched_buckets_only(spark):
    log = TieredLog(spark, scratch_dir(spark, "log"), ["k", "n"], ["t"], ["k"], buckets=32, first_rows=1000)
    rows = spark.range(400).selectExpr("concat('k', id % 40) as k", "id as n", "id as t", "false as deleted")
    log.add(rows, "s", 0)
    log.add(rows.where("k in ('k3', 'k4')"), "s", 1)
    touched = rows.where("k = 'k3' and n < 50")
    part = log.newest(touched=touched)
    bucket = log.buckets_of(touched)
    assert len(bucket) == 1 and {p.rsplit("=", 1)[1] for p in scanned(part)} == {str(bucket[0])}
    assert part.where("k = 'k3'").count() == 10, "all rows of a touched entity are there"
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "InMemoryFileIndex(1 paths)" in plan
    assert len(scanned(log.newest())) > 20


def test_a_repeated_batch_and_one_of_another_stream(spark):
    log = TieredLog(spark, scratch_dir(spark, "log"), ["k"], ["t"], buckets=2)
    log.add(frame(spark, ("a", 1, 1.0, False)), "one", 0)
    log.add(frame(spark, ("a", 9, 9.0, False)), "one", 0)
    log.add(frame(spark, ("b", 1, 2.0, False)), "two", 0)
    log.add(frame(spark, ("c", 1, 3.0, False)).limit(0), "two", 1)
    assert sorted(r.k + str(r.v) for r in log.newest().collect()) == ["a1.0", "b2.0"]
    assert log.version().marks == {"one": 0, "two": 1}


def test_equal_times_go_to_the_later_batch_and_late_events_change_nothing(spark):
    log = TieredLog(spark, scratch_dir(spark, "log"), ["k"], ["t"], buckets=1, first_rows=1, fan=2)
    for batch, row in enumerate([("a", 5, 1.0, False), ("a", 5, 2.0, False), ("a", 4, 3.0, False), ("b", 7, 4.0, True),
                                 ("b", 6, 5.0, False), (None, 1, 6.0, False)]):
        log.add(frame(spark, row), "s", batch)
    assert sorted(map(repr, ((r.k, r.v) for r in log.newest().collect()))) == ["('a', 2.0)", "(None, 6.0)"]


def test_nothing_is_seen_of_a_change_that_failed(spark, monkeypatch):
    table = Snapshot(spark, scratch_dir(spark, "snapshot"), ["k"], buckets=4)
    combine = newest_rows(["k"], ["t"])
    table.load(frame(spark, ("a", 1, 1.0, False), ("b", 1, 1.0, False)))
    before = sorted(map(tuple, table.read().collect()))
    with monkeypatch.context() as patch:
        patch.setattr(Snapshot, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("crash")))
        with pytest.raises(RuntimeError):
            table.apply(frame(spark, ("a", 2, 2.0, False)), combine)
    assert sorted(map(tuple, table.read().collect())) == before
    create_text(spark, f"{table.path}/versions/{1:020d}.json", '{"number": 1, "fil')  # half a version file
    assert sorted(map(tuple, table.read().collect())) == before
    table.apply(frame(spark, ("a", 2, 2.0, False)), combine)
    assert sorted(map(tuple, table.read().collect())) == [("a", 2, 2.0, False), ("b", 1, 1.0, False)]


def test_two_writers_do_not_overwrite_each_other(spark):
    path = scratch_dir(spark, "writers")
    table = Snapshot(spark, path, ["k"], buckets=2)
    base = table.load(frame(spark, ("a", 1, 1.0, False)))
    table.apply(frame(spark, ("b", 1, 1.0, False)), newest_rows(["k"], ["t"]))
    with pytest.raises(VersionTaken):
        table.commit(base, table.read().schema, {}, {})
    assert table.read().count() == 2


def test_untouched_files_keep_their_names(spark):
    table = Snapshot(spark, scratch_dir(spark, "cow"), ["k"], buckets=16)
    table.load(spark.range(300).selectExpr("concat('k', id) as k", "0L as t", "1.0D as v", "false as deleted"))
    before = files(table)
    changes = frame(spark, ("k7", 5, 2.0, False), ("new", 1, 3.0, False))
    touched = table.buckets_of(changes)
    table.apply(changes, newest_rows(["k"], ["t"]))
    after = files(table)
    kept = {f for f in before if int(f.split("bucket_no=")[1].split("/")[0]) not in touched}
    assert kept == before & after and len(kept) == 16 - len(touched)
    assert {r.k: r.v for r in table.read().where("k in ('k7', 'new', 'k8')").collect()} == {"k7": 2.0, "k8": 1.0, "new": 3.0}
    assert table.apply(changes.limit(0), newest_rows(["k"], ["t"])).files == table.version().files


def test_buckets_in_several_files_and_a_combine_that_strays(spark):
    table = Snapshot(spark, scratch_dir(spark, "parts"), ["k"], buckets=2, files_per_bucket=3)
    rows = spark.range(300).selectExpr("concat('k', id) as k", "0L as t", "1.0D as v", "false as deleted")
    table.load(rows)
    assert table.read().count() == 300 and 2 < len(files(table)) <= 6
    other = Snapshot(spark, scratch_dir(spark, "strays"), ["k"], buckets=64)
    other.load(rows)
    with pytest.raises(ValueError, match="combine"):
        other.apply(frame(spark, ("k1", 1, 1.0, False)), lambda old, new: rows)


def test_old_versions_go_with_their_files(spark):
    table = Snapshot(spark, scratch_dir(spark, "expire"), ["k"], buckets=2, keep_versions=3)
    table.load(frame(spark, ("a", 0, 0.0, False), ("b", 0, 0.0, False), ("c", 0, 0.0, False)))
    for turn in range(1, 9):
        table.apply(frame(spark, ("a", turn, float(turn), False)), newest_rows(["k"], ["t"]))
    assert len(list_files(spark, f"{table.path}/versions")) == 3
    assert len(list_files(spark, f"{table.path}/runs")) <= 5
    assert sorted((r.k, r.v) for r in table.read().collect()) == [("a", 8.0), ("b", 0.0), ("c", 0.0)]


def messages(spark, *rows):
    return spark.createDataFrame(list(rows), "value string, partition int, offset long")


def test_positions(spark):
    assert kafka_start("t", {}) == "earliest" and kafka_start("t", {"0": 3}) == '{"t": {"0": 3}}'
    rows = messages(spark, ("a", 0, 4), ("b", 0, 9), ("c", 2, 1))
    assert positions_after(rows, {"0": 2, "1": 7}) == {"0": 10, "1": 7, "2": 2}
    assert positions_after(rows.limit(0), {"0": 2}) == {"0": 2}


def test_a_pass_reads_only_what_is_new(spark):
    base = scratch_dir(spark, "ledger")
    table = Snapshot(spark, f"{base}/table", ["k"], buckets=4)
    table.load(frame(spark).limit(0))
    seen = []

    def read(start):
        rows = read_after(spark, "parquet", {"path": f"{base}/in"}, start)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        seen.append((rows.count(), "GreaterThanOrEqual(offset" in plan))
        return rows

    def resolve(new):
        rows = new.selectExpr("value as k", "offset as t", "cast(partition as double) as v", "false as deleted")
        return latest_per_key(rows, ["k"], ["t"])

    def run():
        return bounded_pass(table, "in", read, resolve, newest_rows(["k"], ["t"]))

    messages(spark, ("a", 0, 0), ("b", 1, 0), ("a", 0, 1)).write.mode("append").parquet(f"{base}/in")
    run()
    messages(spark, ("a", 0, 2), ("c", 3, 0)).write.mode("append").parquet(f"{base}/in")
    commit, table.commit = table.commit, lambda *_: (_ for _ in ()).throw(RuntimeError("crash"))
    with pytest.raises(RuntimeError):
        run()
    table.commit = commit
    run()
    assert run() is None
    assert seen == [(3, False), (2, True), (2, True), (0, True)]
    assert sorted((r.k, r.t) for r in table.read().collect()) == [("a", 2), ("b", 0), ("c", 0)]
    assert table.version().marks == {"in": {"0": 3, "1": 1, "3": 1}}


def test_a_kpi_snapshot_goes_by_company(spark):
    rows = spark.createDataFrame([], statement_schema(["date", "company_name"]))
    with pytest.raises(ValueError):
        kpi_table(Snapshot(spark, scratch_dir(spark, "wrong"), ["date", "company_name"]), rows)
    table = Snapshot(spark, scratch_dir(spark, "right"), ["date", "company_name"], ["company_name"])
    kpi_table(table, rows)
    assert table.read().count() == 0 and set(MEASURES) < set(table.read().columns)
