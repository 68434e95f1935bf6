"""Streaming latest-per-key equals the batch operator; DQ checks fail on bad input."""
import os
import tempfile

from pyspark.sql import functions as F

from gaffer.operators.quality import Check, not_null, relationships, run_suite, unique
from gaffer.operators.snapshots import latest_per_key
from gaffer.streaming.latest import read_latest, start_stream_latest

EVENTS = "/root/testdata/sf0.001/events.parquet"


def test_stream_equals_batch_with_late_files(spark):
    ev = spark.read.parquet(EVENTS)
    src = tempfile.mkdtemp(prefix="gaffer-src-")
    # newest third first, then the older rows arrive late in two more files
    q = ev.approxQuantile("event_id", [0.33, 0.66], 0.0)
    parts = [ev.where(F.col("event_id") > q[1]), ev.where(F.col("event_id") <= q[0]),
             ev.where((F.col("event_id") > q[0]) & (F.col("event_id") <= q[1]))]
    for i, p in enumerate(parts):
        p.coalesce(1).write.parquet(os.path.join(src, f"batch{i}"))
    out = tempfile.mkdtemp(prefix="gaffer-out-")
    stream_src = os.path.join(src, "*")
    query = start_stream_latest(spark, stream_src, ev.schema, ["user_id"], ["ts", "event_id"],
                                ["event_type", "value"], os.path.join(out, "table"),
                                os.path.join(out, "ckpt"), max_files_per_trigger=1)
    query.awaitTermination()
    assert query.lastProgress is not None
    got = read_latest(spark, os.path.join(out, "table"), ["user_id"], ["ts", "event_id"]) \
        .select("user_id", "event_id").collect()
    want = latest_per_key(ev, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id").collect()
    assert sorted(got) == sorted(want)


def test_quality_checks_fail_on_bad_input(spark):
    child = spark.createDataFrame([(1, 10), (2, None), (3, 99), (3, 10)], "id int, parent int")
    parent = spark.createDataFrame([(10,), (None,)], "pid int")
    assert not_null(child, "parent").count() == 1
    assert unique(child, "id").collect()[0].id == 3
    assert [r.parent for r in relationships(child, "parent", parent, "pid").collect()] == [99]
    s = {(r.column_name, r.check_name): r.failures for r in run_suite([
        Check("child", "parent", "not_null", child), Check("child", "id", "unique", child),
        Check("child", "parent", "relationships", child, parent, "pid")]).collect()}
    assert s == {("parent", "not_null"): 1, ("id", "unique"): 1, ("parent", "relationships"): 1}


def test_json_array_check(spark):
    raw = spark.createDataFrame([('{"chips": []}',), ('{"chips": null}',), ('{"other": 1}',), ('{"chips": 3}',)],
                                "payload string")
    r = run_suite([Check("entry_history_snapshot", "payload", "json_array", raw, field="chips")]).collect()[0]
    assert r.failures == 3


def test_stream_compacts_its_epochs(spark):
    import glob
    import os
    import tempfile

    from gaffer.operators.snapshots import latest_per_key
    from gaffer.streaming.latest import read_latest, start_stream_latest
    d = tempfile.mkdtemp(prefix="gaffer-compact-")
    rows = [(i % 5, i, float(i)) for i in range(40)]
    for k in range(8):
        spark.createDataFrame(rows[5 * k:5 * k + 5], "user_id int, ts int, value double").coalesce(1) \
            .write.mode("append").parquet(os.path.join(d, "in"))
    schema = spark.read.parquet(os.path.join(d, "in")).schema
    q = start_stream_latest(spark, os.path.join(d, "in"), schema, ["user_id"], ["ts"], ["value"], os.path.join(d, "table"),
                            os.path.join(d, "ckpt"), max_files_per_trigger=1, compact_every=3)
    q.awaitTermination()
    left = sorted(os.path.basename(p) for p in glob.glob(os.path.join(d, "table", "*=*")))
    assert [x for x in left if x.startswith("upto")] == ["upto=5"] and "epoch=0" not in left and len(left) <= 4
    got = read_latest(spark, os.path.join(d, "table"), ["user_id"], ["ts"])
    want = latest_per_key(spark.read.parquet(os.path.join(d, "in")), ["user_id"], ["ts"])
    assert sorted(map(tuple, got.select("user_id", "ts", "value").collect())) == \
        sorted(map(tuple, want.select("user_id", "ts", "value").collect()))


def test_suite_counts_one_table_in_one_pass(spark):
    from gaffer.operators.quality import Check, run_suite
    child = spark.createDataFrame([(1, 10), (2, None), (None, 99), (1, 77)], "a int, b int")
    parent = spark.createDataFrame([(10,), (10,), (77,), (None,)], "k int")
    checks = [Check("t", "a", "not_null", child), Check("t", "b", "relationships", child, parent, "k"),
              Check("t", "a", "relationships", child, parent, "k"), Check("t", "a", "unique", child)]
    got = sorted((r.column_name, r.check_name, r.failures) for r in run_suite(checks).collect())
    assert got == [("a", "not_null", 1), ("a", "relationships", 3), ("a", "unique", 1), ("b", "relationships", 1)]


def test_newest_run_overall_and_per_key(spark):
    from gaffer.operators.snapshots import newest_run
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (2, 1, "d"), (None, 5, "e")], "k int, ts int, p string")
    assert sorted(r.p for r in newest_run(df, ["k"], ["ts"]).collect()) == ["b", "c", "d", "e"]
    assert [r.p for r in newest_run(df, [], ["ts"]).collect()] == ["e"]
    assert sorted(r.p for r in newest_run(df, ["k"], ["ts"], few=True).collect()) == ["b", "c", "d", "e"]


def test_archive_rows_are_not_gathered_by_season(spark):
    """Hashed by season, all rows of the archive sat in as many tasks as there are seasons."""
    from gaffer.plans.staging import stg_historical_players
    n = F.col("id")
    raw = spark.range(0, 4000, 1, 8).select(
        F.when(n % 2 == 0, "1999-00").otherwise("2000-01").alias("season"),
        F.when(n % 10 == 3, "2001-01-01").otherwise("2001-02-01").cast("timestamp").alias("fetched_at"),
        F.to_json(F.struct(n.cast("string").alias("id"), n.cast("string").alias("code"))).alias("payload"),
        F.lit("run").alias("run_id"))
    # as over a large archive, no size is small enough for a broadcast that was not asked for
    limits = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in limits}
    try:
        for k in limits:
            spark.conf.set(k, "-1")
        rows = stg_historical_players(raw)
        assert sorted(r.player_code for r in rows.collect()) == [i for i in range(4000) if i % 10 != 3]
        assert "SortMergeJoin" not in rows._jdf.queryExecution().executedPlan().toString()
        assert rows.select(F.spark_partition_id().alias("p")).distinct().count() == 8
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_written_archive_is_not_computed_again(spark, tmp_path):
    from types import SimpleNamespace
    from gaffer.plans.payloads import Payloads
    spark.createDataFrame([("1999-00", "a"), ("1999-00", "b"), ("2000-01", "c")], "season string, name string") \
        .write.parquet(str(tmp_path / "source"))
    payloads = Payloads(SimpleNamespace(spark=spark, materialize=False, tag="again"))
    landed = payloads._csv(spark.read.parquet(str(tmp_path / "source")), "rows")
    assert not [f for f in landed.inputFiles() if "/source/" in f]
    assert sorted((r.season, r.run_id, r.payload) for r in landed.collect()) == [
        ("1999-00", "run-1", "{}"), ("1999-00", "run-2", '{"name":"a"}'), ("1999-00", "run-2", '{"name":"b"}'),
        ("2000-01", "run-1", "{}"), ("2000-01", "run-2", '{"name":"c"}')]


def test_shared_folder_is_required_off_local_mode(monkeypatch):
    import pytest

    from gaffer import session

    class Conf:
        def get(self, _, default=None):
            return default

    class Fake:
        conf = Conf()

        class sparkContext:  # noqa: N801
            applicationId, master = "app-x", "spark://host:7077"

            @staticmethod
            def getConf():
                return Conf()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Fake())


def test_snapshot_changes_across_chunks(spark):
    import datetime as dt
    import random

    from gaffer.operators.snapshots import snapshot_changes
    rnd = random.Random(1)
    rows = [(rnd.choice([1, 1, 1, 2, None]), dt.datetime(2026, 1, 1) + dt.timedelta(hours=rnd.randrange(5000)), i,
             rnd.choice([None, 1.0, 2.0, 5.0])) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, ts timestamp, id int, v double")
    got = {r.id: (r.prev_v, r.delta_v) for r in snapshot_changes(df, ["k"], "ts", ["v"], tiebreak="id").collect()}
    last, want = {}, {}
    for k, t, i, v in sorted(rows, key=lambda r: (r[1], r[2])):
        p = last.get(k)
        want[i] = (p, None if p is None or v is None else v - p)
        last[k] = v
    assert got == want
