"""The complete jobs, sinks and streams on small inputs."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.operators.changes import flatten_changes, resolve_changes, versions
from tallybook.plans import jobs
from tallybook.schemas import MEASURES, kpi_schema, statement_schema
from tallybook.session import (build_session, create_text, read_text, remove, scratch_dir, scratch_root,
                               shuffle_partitions)
from tallybook.sinks import jdbc
from tallybook.sinks.buckets import TieredLog
from tallybook.sinks.files import preview, read_csv, write_csv
from tallybook.sinks.tables import append_table, create_table, replace_table
from tallybook.sources.changes import cdc_source
from tallybook.sources.jdbc import hash_predicates, jdbc_options, read_jdbc
from tallybook.streaming.changelog import keep_latest, keep_running, read_latest, stream_id, upsert_batches

KEYS, ROW = ["date", "company_name"], statement_schema(["date", "company_name"])


def statement(date, company, sales):
    values = {m: sales / 2 for m in MEASURES}
    return {"date": date, "company_name": company, **values, "sales": sales, "interest": 0.0}


def envelope(after, ts, before=None):
    return json.dumps({"payload": {"before": before, "after": after, "source": {"ts_ms": ts}}})


def frame(spark, messages):
    return spark.createDataFrame([(m,) for m in messages], "value string")


@pytest.fixture
def log():
    old = statement("Mar 2013", "A", 5.0)
    return [envelope(statement("Mar 2014", "A", 15.0), 1), envelope(statement("Mar 2014", "A", 20.0), 2),
            envelope(statement("Dec 2015", "A", 30.0), 2), envelope(None, 3, old),
            envelope(statement("TTM", "A", 99.0), 4), envelope(statement("Mar 2014", "B", 1.0), 1), "garbage"]


@pytest.fixture
def existing(spark):
    rows = [statement("Mar 2012", "A", 10.0), statement("Mar 2013", "A", 11.0), statement("Mar 2010", "C", 7.0)]
    return spark.createDataFrame([tuple(r[c] for c in ROW.names) for r in rows], ROW)


def test_kpi_job(spark, log, existing):
    out = jobs.statement_kpis(frame(spark, log), existing)
    assert sorted(out.columns) == sorted(kpi_schema().names)
    got = [(r.company_name, r.date, r.sales, r.yoy_sales_growth, r.interest_coverage_ratio) for r in out.collect()]
    assert got == [("A", "Dec 2015", 30.0, 50.0, None), ("A", "Mar 2012", 10.0, None, None),
                   ("A", "Mar 2014", 20.0, 100.0, None), ("B", "Mar 2014", 1.0, None, None),
                   ("C", "Mar 2010", 7.0, None, None)]
    by_label = jobs.statement_kpis(frame(spark, log), existing, growth_order="label").filter("company_name = 'A'")
    assert [r.yoy_sales_growth for r in by_label.collect()] == [None, -66.67, 100.0]


@pytest.mark.parametrize("order", ["time", "label"])
def test_split_companies_give_the_same_kpis(spark, order):
    rng = random.Random(2)
    months = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()
    labels = [f"{m} {y}" for y in range(1990, 2000) for m in months] + ["TTM"]
    data = [statement(d, c, rng.random() * 100) for c, n in (("hot", 121), ("A", 20), ("B", 3), ("C", 1))
            for d in rng.sample(labels, n)]
    merged = spark.createDataFrame([tuple(r[c] for c in ROW.names) for r in data], ROW)
    plain, split = jobs.with_kpis(merged, order), jobs.with_kpis(merged, order, split_companies=True)
    assert plain.columns == split.columns
    assert [repr(r) for r in plain.collect()] == [repr(r) for r in split.collect()]


def test_merge_job_keeps_changed_keys_only(spark, log, existing):
    got = [(r.company_name, r.date, r.sales) for r in jobs.statement_merge(frame(spark, log), existing).collect()]
    assert got == [("A", "Dec 2015", 30.0), ("A", "Mar 2014", 20.0), ("B", "Mar 2014", 1.0)]


def test_summary_job(spark):
    names = statement_schema(["date"]).names
    full, partial = statement("Mar 2014", "", 10.0), statement("Mar 2015", "", 20.0)
    partial["expenses"] = None
    messages = [envelope({k: s[k] for k in names}, 1) for s in (full, partial, statement("TTM", "", 1000.0))]
    nothing = spark.createDataFrame([], statement_schema(["date"]))
    got = [(r.date, r.sales, r.expenses) for r in jobs.statement_summary(frame(spark, messages), nothing).collect()]
    assert got == [("Mar 2014", 10.0, 5.0), ("Average", 15.0, 5.0)]
    summary = jobs.statement_summary(frame(spark, messages), nothing)
    assert [r.date for r in jobs.without_summary(summary).collect()] == ["Mar 2014"]


def test_csv(spark):
    df = spark.createDataFrame([(1, 'a "b", c'), (2, "x\ny"), (3, None)], "k int, t string").repartition(3)
    for frame, settings, files in ((df, {}, 3), (df, {"files": 1}, 1), (df.orderBy("k"), {"files": 1, "ordered": True}, 1)):
        path = scratch_dir(spark, "csv")
        write_csv(frame, path, **settings)
        back = read_csv(spark, path, df.schema)
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
        assert len(back.inputFiles()) <= files
    assert [r.k for r in back.collect()] == [1, 2, 3]


def test_tables(spark):
    path, df = scratch_dir(spark, "table"), spark.createDataFrame([(1, "a")], "k int, t string")
    create_table(spark, "accounts_test", df.schema, path)
    append_table(df, "accounts_test")
    create_table(spark, "accounts_test", df.schema, path)
    assert spark.table("accounts_test").count() == 1
    replace_table(df.withColumn("more", F.lit(2)), "accounts_test", path)
    assert spark.table("accounts_test").columns == ["k", "t", "more"]
    assert preview(df, ["k"], 1).count() == 1


def test_jdbc_statements():
    assert jdbc.create_statement("sink", kpi_schema(), KEYS).startswith(
        'CREATE TABLE IF NOT EXISTS sink ("date" VARCHAR, "company_name" VARCHAR, "sales" DOUBLE PRECISION')
    assert jdbc.upsert_statement("t", "s", ["k"], ["k", "a", "b"]) == (
        'INSERT INTO t ("k", "a", "b") SELECT "k", "a", "b" FROM s '
        'ON CONFLICT ("k") DO UPDATE SET "a" = EXCLUDED."a", "b" = EXCLUDED."b"')
    assert jdbc.upsert_statement("t", "s", ["k"], ["k"]).endswith("DO NOTHING")


def test_jdbc_upsert_stages_then_runs_one_transaction(spark, monkeypatch):
    calls = []

    class Connection:
        def cursor(self):
            return self

        def execute(self, statement):
            calls.append(statement.split()[0])

        def commit(self):
            calls.append("commit")

        def close(self):
            calls.append("close")

    monkeypatch.setattr(jdbc, "replace_jdbc", lambda df, url, table, *rest: calls.append(table))
    jdbc.upsert_jdbc(spark.createDataFrame([(1, 2.0)], "k bigint, v double"), "jdbc:x", "t", ["k"], Connection)
    stage, *rest = calls
    assert stage.startswith("t_staging_") and len(stage) > 20
    assert rest == ["CREATE", "INSERT", "commit", "close", "DROP", "commit", "close"]


def test_jdbc_options():
    options = jdbc_options("jdbc:x", "t", user="u", partition_column="k", bounds=(0, 100), num_partitions=4)
    assert (options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("0", "100", "4")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", partition_column="k")
    parts = hash_predicates(["date", "company_name"], 3)
    assert len(set(parts)) == 3 and all('"date"' in p and '"company_name"' in p for p in parts)
    with pytest.raises(ValueError):
        read_jdbc(None, "jdbc:x", "t")


def test_jdbc_types():
    schema = T.StructType([T.StructField(n, t) for n, t in (
        ("a", T.TimestampType()), ("b", T.DecimalType(12, 3)), ("c", T.ShortType()), ("d", T.FloatType()), ("e", T.TimestampNTZType()))])
    assert jdbc.create_statement("t", schema) == (
        'CREATE TABLE IF NOT EXISTS t ("a" TIMESTAMP WITH TIME ZONE, "b" NUMERIC(12, 3), "c" SMALLINT, "d" REAL, "e" TIMESTAMP)')
    with pytest.raises(TypeError):
        jdbc.sql_type(T.ArrayType(T.LongType()))


def test_jdbc_writes_keep_the_parallelism_before_them(spark, monkeypatch):
    from pyspark.sql import DataFrameWriter

    seen = []
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, *a, **b: seen.append(self._df.rdd.getNumPartitions()))
    df = spark.range(100).repartition(6)
    jdbc.replace_jdbc(df, "jdbc:x", "t")
    jdbc.replace_jdbc(df, "jdbc:x", "t", connections=2)
    assert seen == [6, 2]


def _random_log(seed, events=300):
    rng = random.Random(seed)
    out = []
    for ts in range(events):
        key = (f"Mar {2000 + rng.randrange(8)}", rng.choice(["hot", "hot", "hot", "A", "B"]))
        image = statement(*key, float(ts))
        out.append(envelope(None, ts, image) if rng.random() < 0.25 else envelope(image, ts))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("start", [keep_latest, upsert_batches])
@pytest.mark.parametrize("files", [1, 4])
def test_stream_equals_batch_for_any_split(spark, start, files):
    log = _random_log(files)
    base = scratch_dir(spark, "stream-test")
    batch = resolve_changes(flatten_changes(frame(spark, log), ROW, KEYS), KEYS, ["sales"], ["ts_ms"])
    expected = sorted(tuple(r) for r in batch.filter("not deleted").select(*KEYS, "sales").collect())
    for i in range(files):
        frame(spark, log[i::files]).coalesce(1).write.mode("append").text(f"{base}/in")
    source = cdc_source(spark, "text", {"path": f"{base}/in", "maxFilesPerTrigger": "1"}, streaming=True)
    events = versions(flatten_changes(source, ROW, KEYS), KEYS, ["sales"], ["ts_ms"])
    keep_running(lambda: start(events, KEYS, ["ts_ms"], f"{base}/log", f"{base}/checkpoint",
                               trigger={"availableNow": True}))

    def current(path):
        return sorted(tuple(r) for r in read_latest(spark, path, KEYS, ["ts_ms"]).select(*KEYS, "sales").collect())

    assert current(f"{base}/log") == expected
    late = read_latest(spark, f"{base}/log", KEYS, ["ts_ms"], with_deleted=True) \
        .withColumns({"ts_ms": F.lit(-1).cast("long"), "sales": F.lit(0.0), "deleted": F.lit(False)})
    TieredLog(spark, f"{base}/log", KEYS, ["ts_ms"]).add(late, "late", 0)
    assert current(f"{base}/log") == expected, "late events change nothing, deleted keys stay deleted"


def test_kpis_are_published_after_every_batch(spark):
    base = scratch_dir(spark, "publish")
    log = _random_log(3)
    for i in range(2):
        frame(spark, log[i::2]).coalesce(1).write.mode("append").text(f"{base}/in")
    source = cdc_source(spark, "text", {"path": f"{base}/in", "maxFilesPerTrigger": "1"}, streaming=True)
    events = versions(flatten_changes(source, ROW, KEYS), KEYS, MEASURES, ["ts_ms"])
    published = []

    def publish(changed, batch_id):
        session, touched = changed.sparkSession, changed.select("company_name").distinct()
        current = read_latest(session, f"{base}/log", KEYS, ["ts_ms"]).drop("ts_ms")
        fresh = jobs.with_kpis(current.join(touched, "company_name", "left_semi").select(*current.columns))
        for company, rows in ((r.company_name, fresh.filter(F.col("company_name") == r.company_name)) for r in touched.collect()):
            write_csv(rows, f"{base}/kpis/{company}")
        published.append(batch_id)

    keep_running(lambda: upsert_batches(events, KEYS, ["ts_ms"], f"{base}/log", f"{base}/checkpoint",
                                        trigger={"availableNow": True}, publish=publish))
    nothing = spark.createDataFrame([], ROW)
    expected = jobs.statement_kpis(frame(spark, log), nothing)
    got = read_csv(spark, f"{base}/kpis/*", expected.schema)
    assert published == [0, 1]
    assert sorted(map(repr, got.collect())) == sorted(map(repr, expected.collect()))


def _stream(spark, base, publish=None, checkpoint="checkpoint"):
    source = cdc_source(spark, "text", {"path": f"{base}/in", "maxFilesPerTrigger": "1"}, streaming=True)
    events = versions(flatten_changes(source, ROW, KEYS), KEYS, ["sales"], ["ts_ms"])
    return upsert_batches(events, KEYS, ["ts_ms"], f"{base}/log", f"{base}/{checkpoint}", {"availableNow": True}, publish)


def _keys(spark, base):
    return sorted(r.company_name for r in read_latest(spark, f"{base}/log", KEYS, ["ts_ms"]).collect())


def test_a_failing_query_is_started_again(spark):
    base, seen = scratch_dir(spark, "restart"), []
    frame(spark, [envelope(statement("Mar 2014", k, 1.0), 1) for k in "abc"]).coalesce(1).write.text(f"{base}/in")

    def publish(changed, batch_id):
        seen.append((batch_id, changed.count()))
        if len(seen) == 1:
            raise RuntimeError("first attempt fails")

    keep_running(lambda: _stream(spark, base, publish), restarts=1, pause_seconds=0)
    assert _keys(spark, base) == ["a", "b", "c"] and seen == [(0, 3), (0, 3)]
    assert TieredLog(spark, f"{base}/log", KEYS, ["ts_ms"]).version().number == 0, "the repeated batch added nothing"


def test_a_lost_checkpoint_loses_no_rows(spark):
    base = scratch_dir(spark, "lost")
    frame(spark, [envelope(statement("Mar 2014", k, 1.0), 1) for k in "ab"]).coalesce(1).write.text(f"{base}/in")
    keep_running(lambda: _stream(spark, base))
    first = stream_id(spark, f"{base}/checkpoint")
    remove(spark, f"{base}/checkpoint")
    remove(spark, f"{base}/in")
    frame(spark, [envelope(statement("Mar 2014", "c", 1.0), 1)]).coalesce(1).write.text(f"{base}/in")
    keep_running(lambda: _stream(spark, base))
    assert _keys(spark, base) == ["a", "b", "c"] and stream_id(spark, f"{base}/checkpoint") != first


def test_a_new_checkpoint_keeps_the_old_rows(spark):
    base = scratch_dir(spark, "checkpoints")
    for run, key in (("one", "a"), ("two", "b")):
        image = statement("Mar 2014", key, 1.0)
        frame(spark, [envelope(image, 1)]).write.text(f"{base}/in-{run}")
        source = cdc_source(spark, "text", {"path": f"{base}/in-{run}"}, streaming=True)
        events = versions(flatten_changes(source, ROW, KEYS), KEYS, ["sales"], ["ts_ms"])
        keep_running(lambda: upsert_batches(events, KEYS, ["ts_ms"], f"{base}/log", f"{base}/{run}", trigger={"availableNow": True}))
    assert sorted(r.company_name for r in read_latest(spark, f"{base}/log", KEYS, ["ts_ms"]).collect()) == ["a", "b"]


def test_only_failures_in_a_row_end_a_stream(monkeypatch):
    from pyspark.errors import StreamingQueryException

    class Query:
        def __init__(self, progress, fails):
            self.recentProgress, self.fails = progress, fails

        def awaitTermination(self):
            if self.fails:
                raise StreamingQueryException("stopped")

    plan = [Query([1], True)] * 6 + [Query([], True), Query([1], True), Query([], False)]
    starts = iter(plan)
    keep_running(lambda: next(starts), restarts=2, pause_seconds=0)
    starts = iter([Query([], True)] * 9)
    with pytest.raises(StreamingQueryException):
        keep_running(lambda: next(starts), restarts=2, pause_seconds=0)
    assert len(list(starts)) == 6


def test_scratch_folder(spark):
    class Conf(dict):
        get = dict.get

    class Session:
        class sparkContext:
            applicationId, master = "x", "yarn"

    Session.conf = Conf({"spark.checkpoint.dir": "hdfs://shared/tmp/"})
    assert scratch_root(Session) == "hdfs://shared/tmp/x"
    Session.conf = Conf({"spark.sql.warehouse.dir": "hdfs://warehouse"})
    assert scratch_root(Session) == "hdfs://warehouse/_scratch/x"
    Session.conf = Conf({"spark.sql.warehouse.dir": "file:/home/user/spark-warehouse"})
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(Session)
    Session.sparkContext.master = "local[4]"
    assert scratch_root(Session) == "file:/home/user/spark-warehouse/_scratch/x"
    path = scratch_dir(spark, "small")
    assert read_text(spark, path) is None
    assert create_text(spark, path, "one é") and not create_text(spark, path, "two")
    assert read_text(spark, path) == "one é"
    remove(spark, path)
    assert read_text(spark, path) is None


def test_settings():
    assert shuffle_partitions(100 * 2**40) == 32_768 and shuffle_partitions(1) == 8 and shuffle_partitions(2**40) == 8192
    assert build_session("again", streaming=True).conf.get("spark.sql.shuffle.partitions") == "512"
    build_session("again", conf={"spark.sql.shuffle.partitions": "8"})


def test_global_deletes_and_offsets_in_the_job(spark, existing):
    log = spark.createDataFrame([
        (envelope(statement("Mar 2015", "A", 5.0), 1), 2), (envelope(statement("Mar 2015", "A", 6.0), 1), 1),
        (envelope(None, 1, statement("Mar 2013", "B", 1.0)), 3)], "value string, offset long")
    got = jobs.statement_kpis(log, existing, growth_order="label", delete_keys=["date"])
    assert [(r.company_name, r.date, r.sales) for r in got.collect()] == [
        ("A", "Mar 2012", 10.0), ("A", "Mar 2015", 5.0), ("C", "Mar 2010", 7.0)]
    by_time = jobs.statement_kpis(log, existing)
    assert ("A", "Mar 2015", 5.0) in [(r.company_name, r.date, r.sales) for r in by_time.collect()]
