"""Landing sources/sinks, squad-state fallbacks, and plan-shape checks."""
import datetime as dt
import json
import os
import tempfile

from pyspark.sql import functions as F

from gaffer.operators.decisions import bank, current_squad, purchase_price
from gaffer.operators.snapshots import latest_per_key
from gaffer.plans.staging import stg_entries, stg_historical_teams
from gaffer.sources.landing import (
    append_snapshot, first_n, land_csv, land_json, publish, table,
)


def test_land_json_lines_and_missing_ok(spark):
    d = tempfile.mkdtemp(prefix="gaffer-land-")
    with open(os.path.join(d, "entries.jsonl"), "w") as f:
        for e, name in [(1, "a"), (2, "b"), (1, "c")]:
            f.write(json.dumps({"entry_id": e, "name": name}) + "\n")
    raw = land_json(spark, os.path.join(d, "entries.jsonl"), keys={"entry_id": "int"},
                    fetched_at="2026-08-01 10:00:00")
    assert raw.count() == 3 and set(raw.columns) == {"entry_id", "fetched_at", "payload", "run_id", "id"}
    raw = raw.drop("run_id")  # one payload per row: the landing id decides
    assert sorted(r.team_name for r in stg_entries(raw).collect()) == ["b", "c"]
    empty = land_json(spark, os.path.join(d, "nope.json"), keys={"entry_id": "int"}, missing_ok=True)
    assert empty.count() == 0 and "payload" in empty.columns


def test_land_csv_rows_and_cells_then_stage(spark):
    d = tempfile.mkdtemp(prefix="gaffer-csv-")
    os.makedirs(os.path.join(d, "season=2024-25"))
    with open(os.path.join(d, "season=2024-25", "teams.csv"), "w") as f:
        f.write("id,code,name,short_name,strength\n1,3,Reds,RED,4\n2,7,Claret,CLA,\n")
    rows = land_csv(spark, d, fetched_at="2026-08-01 00:00:00")
    assert rows.count() == 2 and rows.select("season").distinct().collect()[0].season == "2024-25"
    cells = land_csv(spark, d, fetched_at="2026-08-01 00:00:00", as_cell=True)
    staged = {r.team_code: r for r in stg_historical_teams(cells).collect()}
    assert staged[3].strength == 4 and staged[7].strength is None     # '' -> NULL


def _season_files(d, season, names):
    folder = os.path.join(d, f"season={season}")
    os.makedirs(folder, exist_ok=True)
    for k, part in enumerate(names):
        with open(os.path.join(folder, f"part-{k}.csv"), "w") as f:
            f.write("id,code,name\n" + "".join(f"{i},{i + 100},{n}\n" for i, n in part))


def test_every_row_of_the_newest_landing_run_is_staged(spark):
    """Rows, cells and files of one run all survive; an older run does not."""
    d = tempfile.mkdtemp(prefix="gaffer-runs-")
    _season_files(d, "2023-24", [[(i, f"a{i}") for i in range(7)], [(i, f"b{i}") for i in range(7, 10)]])
    _season_files(d, "2024-25", [[(i, f"c{i}") for i in range(4)]])
    old = tempfile.mkdtemp(prefix="gaffer-old-")
    _season_files(old, "2023-24", [[(1, "stale")]])
    for kw in ({}, {"as_cell": True}, {"as_cell": True, "cell_rows": 4}):
        stale = land_csv(spark, old, fetched_at="2026-08-01 00:00:00", **kw)
        fresh = land_csv(spark, d, fetched_at="2026-08-02 00:00:00", **kw)
        got = sorted((r.season, r.season_team_id, r.team_name)
                     for r in stg_historical_teams(stale.unionByName(fresh)).collect())
        assert len(got) == 14 and got[0] == ("2023-24", 0, "a0") and got[-1] == ("2024-25", 3, "c3")
    # equal times: the later run wins
    one = land_csv(spark, old, fetched_at="2026-08-02 00:00:00")
    two = land_csv(spark, d, fetched_at="2026-08-02 00:00:00")
    assert stg_historical_teams(one.unionByName(two)).where("season = '2023-24'").count() == 10
    # a path per season, a list of seasons
    by = land_csv(spark, {"2023-24": os.path.join(d, "season=2023-24"), "2024-25": os.path.join(d, "season=2024-25")},
                  seasons=["2023-24"])
    assert {(r.season, r.n) for r in stg_historical_teams(by).groupBy("season").agg(F.count("*").alias("n")).collect()} \
        == {("2023-24", 10)}


def test_snapshot_keys_from_the_path_and_globs(spark):
    d = tempfile.mkdtemp(prefix="gaffer-keys-")
    for i in (11, 12):
        with open(os.path.join(d, f"element_{i}.json"), "w") as f:
            json.dump({"history": [{"fixture": i, "round": 1}]}, f)
    pattern = os.path.join(d, "element_*.json")
    raw = land_json(spark, pattern, keys={"element_id": "int"}, path_keys={"element_id": r"element_(\d+)"},
                    whole_file=True, missing_ok=True)
    assert sorted(r.element_id for r in raw.collect()) == [11, 12]
    from gaffer.plans.staging import stg_player_gameweek_history
    assert sorted((r.player_id, r.fixture_id) for r in stg_player_gameweek_history(raw).collect()) == [(11, 11), (12, 12)]
    assert land_json(spark, os.path.join(d, "none_*.json"), missing_ok=True).count() == 0


def test_purchase_price_with_two_recommendation_runs(spark):
    squad = spark.createDataFrame([(1, 10), (1, 11)], "entry_id int, player_code int")
    runs = spark.createDataFrame(
        [(1, 10, 5.0, dt.datetime(2026, 8, 1)), (1, 11, 6.0, dt.datetime(2026, 8, 1)),
         (1, 10, 5.5, dt.datetime(2026, 8, 8)), (1, 11, 6.5, dt.datetime(2026, 8, 8))],
        "entry_id int, player_code int, price double, generated_at timestamp")
    same_time = spark.createDataFrame([(1, 11, 7.0, dt.datetime(2026, 8, 3)), (1, 11, 7.2, dt.datetime(2026, 8, 3))],
                                      "entry_id int, player_code int, cost double, transferred_at timestamp")
    current = spark.createDataFrame([(10, 5.6), (11, 6.6)], "player_code int, price double")
    got = sorted((r.player_code, r.purchase_price) for r in purchase_price(squad, same_time, runs, current).collect())
    assert got == [(10, 5.5), (11, 7.2)]


def test_first_n_include_and_skip(spark):
    df = spark.range(5).withColumnRenamed("id", "entry_id")
    assert [r.entry_id for r in first_n(df, "entry_id", 2, include=[4, 1, 3]).orderBy("entry_id").collect()] == [1, 3]
    assert first_n(df, "entry_id", skip=True).count() == 0


def test_sinks_append_publish_first_n(spark):
    d = tempfile.mkdtemp(prefix="gaffer-sink-")
    df = spark.createDataFrame([(1, dt.datetime(2026, 8, 1, 9), "{}"), (2, dt.datetime(2026, 8, 2, 9), "{}")],
                               "entry_id int, fetched_at timestamp, payload string")
    append_snapshot(df, os.path.join(d, "raw"))
    append_snapshot(df, os.path.join(d, "raw"))
    back = table(spark, os.path.join(d, "raw"))
    assert back.count() == 4 and "ingest_date" in back.columns
    publish(df, os.path.join(d, "mart"))
    publish(df, os.path.join(d, "mart"))
    assert table(spark, os.path.join(d, "mart")).count() == 2
    assert [r.entry_id for r in first_n(df, "entry_id", 1).collect()] == [1]


def test_current_squad_purchase_price_and_bank(spark):
    picks = spark.createDataFrame([(1, 1, 10), (1, 1, 11), (1, 2, 10), (1, 2, 12)],
                                  "entry_id int, gameweek_id int, player_code int")
    recs = spark.createDataFrame([(2, dt.datetime(2026, 8, 1), 20, 5.0), (2, dt.datetime(2026, 8, 2), 21, 6.0),
                                  (2, dt.datetime(2026, 8, 2), 22, 4.5)],
                                 "entry_id int, generated_at timestamp, player_code int, price double")
    sq = current_squad(picks, recs)
    got = sorted((r.entry_id, r.player_code, r.source) for r in sq.collect())
    assert got == [(1, 10, "picks"), (1, 12, "picks"), (2, 21, "recommendation"), (2, 22, "recommendation")]
    transfers = spark.createDataFrame([(1, 10, 5.5, dt.datetime(2026, 8, 1)), (1, 10, 6.0, dt.datetime(2026, 8, 3)),
                                       (1, 12, 7.0, None), (1, 12, 6.5, dt.datetime(2026, 8, 2))],
                                      "entry_id int, player_code int, cost double, transferred_at timestamp")
    current = spark.createDataFrame([(10, 6.2), (12, 7.3), (21, 6.1), (22, 4.4)], "player_code int, price double")
    pp = {(r.entry_id, r.player_code): r.purchase_price
          for r in purchase_price(sq.select("entry_id", "player_code"), transfers,
                                  recs.select("entry_id", "player_code", "price"), current).collect()}
    # latest transfer wins; a NULL time sorts first under desc (PostgreSQL order)
    assert pp == {(1, 10): 6.0, (1, 12): 7.0, (2, 21): 6.0, (2, 22): 4.5}
    b = {r.entry_id: r.bank_tenths for r in bank(purchase_price(sq.select("entry_id", "player_code"), transfers,
                                                                recs.select("entry_id", "player_code", "price"),
                                                                current)).collect()}
    assert b == {1: 1000 - 130, 2: 1000 - 105}


def test_latest_per_key_is_limited_map_side(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = latest_per_key(ev, ["user_id"], ["ts", "event_id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_scan_prunes_columns_and_pushes_filters(spark):
    from gaffer.plans.analogue import Analogue
    a = Analogue(spark, "/root/testdata/sf0.001", materialize=False)
    plan = a.source_teams._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<c_nationkey:int,c_acctbal:double>" in plan
    plan = a.source_historical_players._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate)" in plan
