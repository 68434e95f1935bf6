"""Incremental landing, versioned publishing, clustered tables, validity intervals."""
import json
import os
import random
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from gaffer.operators.snapshots import latest_per_key, newest_run, snapshot_changes
from gaffer.operators.validity import as_of, validity_intervals
from gaffer.plans import staging
from gaffer.sources import incremental
from gaffer.sources.clustered import append_clustered, create_clustered
from gaffer.sources.landing import land_json
from gaffer.sources.versions import go_back, publish_version, read_version, versions


def drop(folder, name, payload, stamp=None):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(payload if isinstance(payload, str) else json.dumps(payload))
    if stamp:
        os.utime(path, (stamp, stamp))


def test_a_run_lands_only_new_files(spark):
    base = tempfile.mkdtemp(prefix="landing-")
    src, table, ckpt = (os.path.join(base, x) for x in ("in", "table", "ckpt"))

    def run():
        stream = incremental.json_files(spark, src, {"element_id": "int", "kind": "string"}, path_keys={"element_id": r"element_(\d+)"})
        return incremental.land_new(stream, table, ckpt)
    drop(src, "element_1.json", {"kind": "a"}, 1_000_000)
    drop(src, "element_2.json", {"kind": "b"}, 1_000_000)
    drop(os.path.join(src, "deep"), "other.json", "  \n")
    assert run() >= 2 and run() == 0
    drop(src, "element_1_later.json", {"kind": "c"}, 1_000_001)
    assert run() == 1
    rows = incremental.landed(spark, table).collect()
    assert sorted((r.element_id, r.kind) for r in rows) == [(1, "a"), (1, "c"), (2, "b")]
    assert len({r.run_id for r in rows}) == 2
    newest = newest_run(incremental.landed(spark, table), ["element_id"], incremental.NEWEST).collect()
    assert sorted((r.element_id, r.kind) for r in newest) == [(1, "c"), (2, "b")]


def test_a_killed_run_lands_nothing_twice(spark):
    base = tempfile.mkdtemp(prefix="landing-")
    src, table, ckpt = (os.path.join(base, x) for x in ("in", "table", "ckpt"))
    for k in range(6):
        drop(src, f"p_{k}.json", {"k": k})

    def run(fail):
        stream = incremental.json_files(spark, src, {"k": "int"}, files_per_batch=2)
        if fail:  # the third batch dies while it writes
            stream = stream.withColumn("k", F.when(F.col("k") == fail, F.raise_error(F.lit("killed"))).otherwise(F.col("k")))
        return incremental.land_new(stream, table, ckpt)
    with pytest.raises(Exception):
        run(fail=5)
    assert incremental.landed(spark, table).count() < 6
    run(fail=None)
    assert sorted(r.k for r in incremental.landed(spark, table).collect()) == list(range(6))
    assert run(fail=None) == 0


def test_csv_seasons_land_once(spark):
    base = tempfile.mkdtemp(prefix="landing-")
    for season in ("2023-24", "2024-25", "2025-26"):
        drop(f"{base}/in/season={season}", "players.csv", f"id,name\n1,x{season}\n2,\n")
    stream = lambda: incremental.csv_files(spark, f"{base}/in", ["id", "name"], seasons=["2023-24", "2025-26"])
    incremental.land_new(stream(), f"{base}/table", f"{base}/ckpt")
    assert incremental.land_new(stream(), f"{base}/table", f"{base}/ckpt") == 0
    rows = incremental.landed(spark, f"{base}/table").collect()
    assert sorted((r.season, json.loads(r.payload).get("name")) for r in rows if json.loads(r.payload)["id"] == "1") == [
        ("2023-24", "x2023-24"), ("2025-26", "x2025-26")]
    assert len(rows) == 4


def test_equal_stamps_do_not_double_staged_rows(spark):
    folder = tempfile.mkdtemp(prefix="bootstrap-")
    teams = [{"id": 1, "code": 11, "name": "A"}, {"id": 2, "code": 12, "name": "B"}]
    drop(folder, "a.json", {"teams": teams, "elements": []}, 1_000_000)
    drop(folder, "b.json", {"teams": [{**t, "name": t["name"] + "2"} for t in teams], "elements": []}, 1_000_000)
    raw = land_json(spark, folder + "/*.json", whole_file=True)
    assert sorted((r.team_id, r.team_name) for r in staging.stg_teams(raw).collect()) == [(1, "A2"), (2, "B2")]


def test_readers_see_whole_versions(spark):
    root = os.path.join(tempfile.mkdtemp(prefix="versions-"), "marts")
    a = lambda n: spark.range(n).toDF("x")
    with pytest.raises(ValueError):
        read_version(spark, root, "t")
    assert publish_version(spark, root, {"t": a(3), "u": a(1)}) == 1
    held = read_version(spark, root, "t")

    def during():
        assert read_version(spark, root, "t").count() == 3  # a reader during a rebuild
        return a(7)
    assert publish_version(spark, root, {"t": during}) == 2
    assert read_version(spark, root, "t").count() == 7 and read_version(spark, root, "u").count() == 1
    assert held.count() == 3  # a reader that is still at the version before

    def broken():
        raise RuntimeError("no rebuild")
    with pytest.raises(RuntimeError):
        publish_version(spark, root, {"t": a(0), "u": broken})
    assert read_version(spark, root, "t").count() == 7 and versions(spark, root) == [1, 2]
    assert publish_version(spark, root, {"t": a(8)}, keep=2) == 4
    assert versions(spark, root) == [2, 4] and read_version(spark, root, "t", 2).count() == 7
    assert read_version(spark, root, "u").count() == 1  # its folder is kept, though of version 1
    assert not os.path.exists(f"{root}/version=3")
    assert go_back(spark, root) == 2 and read_version(spark, root, "t").count() == 7


def test_clustered_latest_has_no_exchange(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice([None, *range(20)]), rnd.randint(0, 9), k) for k in range(400)]
    df = spark.createDataFrame(rows, "key int, ts int, id int")
    name = "clustered_" + uuid.uuid4().hex[:8]
    t = create_clustered(df.limit(300), name, tempfile.mkdtemp(prefix="clustered-") + "/t", ["key"], ["ts", "id"], 4)
    t = append_clustered(df.join(t, "id", "left_anti"), name)
    got = latest_per_key(t, ["key"], ["ts", "id"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    assert sorted(map(str, got.collect())) == sorted(map(str, latest_per_key(df, ["key"], ["ts", "id"]).collect()))
    spark.sql(f"DROP TABLE {name}")


def runs_of(history):
    """(value, from, to) of runs of equal values in a sorted history of (ts, id, value)."""
    out = []
    for ts, _, v in history:
        if not out or out[-1][0] != v:
            if out:
                out[-1][2] = ts
            out.append([v, ts, None])
    return [tuple(r) for r in out]


@pytest.mark.parametrize("parts", [1, 9])
def test_validity_intervals_and_as_of(spark, parts):
    rnd = random.Random(2)
    rows = [(rnd.choice([None, 1, 1, 1, 2]), rnd.choice([None, *range(40)]), k, rnd.choice(["a", "b", None])) for k in range(300)]
    df = spark.createDataFrame(rows, "key int, ts int, id int, state string")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        intervals = validity_intervals(df, ["key"], "ts", ["state"], "id")
        got = sorted([(r.key, r.state, r.valid_from, r.valid_to) for r in intervals.collect()], key=str)
        facts = spark.createDataFrame([(k, key, t) for k, (key, t) in enumerate(
            (key, t) for key in (None, 1, 2, 3) for t in (None, -1, 0, 5, 17, 39, 50))], "fact int, key int, at int")
        joined = {r.fact: (r.key, r.at, r.state, r.valid_from) for r in as_of(facts, intervals, ["key"], "at", ["state"]).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    low = lambda t: -10 ** 9 if t is None else t
    want, states = [], {}
    for key in (None, 1, 2):
        history = sorted(((t, i, v) for k, t, i, v in rows if k == key), key=lambda h: (low(h[0]), h[1]))
        states[key] = runs_of(history)
        want += [(key, *r[:1], r[1], r[2]) for r in states[key]]
    assert got == sorted(want, key=str)
    assert len(joined) == 28
    for key, at, state, since in joined.values():
        known = [r for r in states.get(key, []) if low(r[1]) <= low(at)]
        assert (state, since) == (known[-1][:2] if known else (None, None)), (key, at)


def test_validity_of_no_rows(spark):
    df = spark.createDataFrame([], "key int, ts timestamp, state string")
    intervals = validity_intervals(df, ["key"], "ts", ["state"])
    assert intervals.count() == 0
    facts = spark.createDataFrame([(1, 2)], "key int, x int").withColumn("at", F.current_timestamp())
    assert as_of(facts, intervals, ["key"], "at", ["state"]).collect()[0].state is None


def test_snapshot_changes_by_whole_numbers_are_cut_by_rows(spark):
    rows = [(1, k, float(k * k)) for k in range(200)] + [(2, 5, 1.0)]
    df = spark.createDataFrame(rows, "key int, ts int, value double")
    got = {(r.key, r.ts): r.prev_value for r in snapshot_changes(df, ["key"], "ts", ["value"]).collect()}
    assert got[1, 0] is None and got[2, 5] is None and len(got) == 201
    assert all(got[1, k] == float((k - 1) ** 2) for k in range(1, 200))


def test_one_parse_of_the_bootstrap_payload_gives_the_same_rows(spark):
    from gaffer.operators.nested import documents
    elements = [{"id": k, "code": 100 + k, "web_name": None if k == 2 else f"é{k}", "now_cost": 40 + k, "form": "1.5",
                 "status": "a", "selected_by_percent": 3.25, "news": {"odd": [1, "x"]} if k == 3 else ""} for k in range(1, 5)]
    good = json.dumps({"elements": elements, "teams": [{"id": 1, "name": "A", "strength": 3}, {"id": 2}], "events": [],
                       "element_types": [{"id": 1, "singular_name": "Goalkeeper"}]})
    twice = '{"teams": [{"id": 7, "name": "x", "name": "y"}], "elements": null}'
    for payload in (good, twice, "[]", "not json", None, '{"elements": 5, "teams": []}'):
        raw = spark.createDataFrame([(payload,)], "payload string").withColumn("fetched_at", F.current_timestamp())
        docs = staging.bootstrap_documents(raw)
        for model in (staging.stg_players, staging.stg_teams, staging.stg_gameweeks, staging.stg_positions):
            assert sorted(map(str, model(docs).collect())) == sorted(map(str, model(raw).collect())), (model, payload)
    kept = documents(spark.createDataFrame([("not json",), (good,)], "payload string")).collect()
    assert [(r.doc is None, r.payload) for r in kept] == [(True, "not json"), (False, None)]
