"""The model DAG on small hand-made raw payloads in the reference's schema."""
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from gaffer.plans.warehouse import Warehouse

T0 = dt.datetime(2026, 8, 1, 12, 0, 0)


def raw(spark, rows, keys=()):
    """rows: list of (payload_obj, minutes_after_T0, id, key values...)."""
    data = [(*kv, T0 + dt.timedelta(minutes=m), json.dumps(p), i) for p, m, i, *kv in rows]
    schema = ", ".join([f"{k} {t}" for k, t in keys] + ["fetched_at timestamp", "payload string", "id long"])
    return spark.createDataFrame(data, schema)


def strengths(v):
    return {k: v for k in ["strength", "strength_overall_home", "strength_overall_away", "strength_attack_home",
                           "strength_attack_away", "strength_defence_home", "strength_defence_away"]}


def bootstrap(next_gw=2):
    teams = [{"id": 1, "code": 3, "name": "Reds", "short_name": "RED", **strengths(1200), "position": 1, "points": 0},
             {"id": 2, "code": 7, "name": "Claret", "short_name": "CLA", **strengths(0), "position": 2, "points": 0},
             {"id": 3, "code": 90, "name": "Promoted", "short_name": "PRO", **strengths(0), "position": 3, "points": 0}]
    elements = [
        {"id": 10, "code": 100, "web_name": "Striker", "team": 1, "element_type": 4, "now_cost": 75,
         "status": "a", "chance_of_playing_next_round": None, "news": ""},
        {"id": 11, "code": 101, "web_name": "Back", "team": 2, "element_type": 2, "now_cost": 45,
         "status": "i", "chance_of_playing_next_round": None, "news": "injured"},
        {"id": 12, "code": 102, "web_name": "Mid", "team": 3, "element_type": 3, "now_cost": "55",
         "status": "d", "chance_of_playing_next_round": 75},
    ]
    events = [{"id": g, "name": f"Gameweek {g}", "deadline_time": "2026-08-1%dT10:00:00Z" % g,
               "finished": g < next_gw if next_gw else True, "is_current": g == (next_gw or 4) - 1,
               "is_next": g == next_gw} for g in (1, 2, 3)]
    types = [{"id": i, "singular_name": n, "singular_name_short": n[:3].upper(), "squad_select": q,
              "squad_min_play": mn, "squad_max_play": mx}
             for i, n, q, mn, mx in [(1, "Goalkeeper", 2, 1, 1), (2, "Defender", 5, 3, 5),
                                     (3, "Midfielder", 5, 2, 5), (4, "Forward", 3, 1, 3)]]
    return {"elements": elements, "teams": teams, "events": events, "element_types": types}


def league(spark, next_gw=2):
    old = bootstrap(next_gw)
    old["elements"][0]["now_cost"] = 70
    b = raw(spark, [(old, 0, 1), (bootstrap(next_gw), 60, 2)])
    fixtures = [{"id": 201, "event": 2, "team_h": 1, "team_a": 2, "started": False, "finished": False},
                {"id": 202, "event": 2, "team_h": 3, "team_a": 1, "started": False, "finished": False},
                {"id": 203, "event": 3, "team_h": 2, "team_a": 3, "started": False, "finished": False}]
    fx = raw(spark, [(fixtures, 0, 1)])
    hist_new = {"history": [{"fixture": 101, "round": 1, "opponent_team": 2, "was_home": True,
                             "total_points": 8, "minutes": 90, "starts": 1, "goals_scored": 1,
                             "clean_sheets": 1, "value": 75}]}
    hist_old = {"history": []}
    es = raw(spark, [(hist_new, 30, 5, 10), (hist_old, 5, 6, 10)], keys=[("element_id", "int")])
    hp = [{"id": "5", "code": "100", "web_name": "Striker", "team": "1", "element_type": "4",
           "penalties_order": "None"},
          {"id": "6", "code": "200", "web_name": "Gone", "team": "2", "element_type": "3",
           "penalties_order": ""},
          {"id": "8", "code": "", "web_name": "NoCode", "team": "2", "element_type": "3",
           "penalties_order": "1"}]
    ht = [{"id": "1", "code": "3", "name": "Reds", "short_name": "RED", **{k: "1000" for k in strengths(0)}},
          {"id": "2", "code": "7", "name": "Claret", "short_name": "CLA", **{k: "1100" for k in strengths(0)}},
          {"id": "4", "code": "43", "name": "Sky", "short_name": "SKY", **{k: "1300" for k in strengths(0)}}]
    gw = [{"element": "5", "name": "Striker", "position": "FWD", "team": "Reds", "round": "1", "fixture": "11",
           "opponent_team": "2", "was_home": "True", "total_points": "2", "minutes": "45", "starts": "0",
           "goals_scored": "0", "clean_sheets": "0", "xP": "2.5", "value": "70"},
          {"element": "6", "name": "Gone", "position": "MID", "team": "Claret", "round": "", "fixture": "12",
           "opponent_team": "4", "was_home": "False", "total_points": "1", "minutes": "10"}]
    season = [("season", "string")]
    return {
        "bootstrap_static_snapshot": b, "fixtures_snapshot": fx, "element_summary_snapshot": es,
        "historical_players_snapshot": raw(spark, [(hp, 0, 1, "2025-26")], season),
        "historical_teams_snapshot": raw(spark, [(ht, 0, 1, "2025-26")], season),
        "historical_gw_stats_snapshot": raw(spark, [(gw, 0, 1, "2025-26")], season),
    }


@pytest.fixture(scope="module")
def wh(spark):
    return Warehouse(spark, league(spark), "2026-27")


def test_staging_latest_snapshot_and_types(wh):
    p = {r.player_code: r for r in wh.players.collect()}
    assert float(p[100].price) == 7.5          # newest bootstrap wins, tenths -> units
    assert float(p[102].price) == 5.5          # string leaf casts like a number
    assert p[100].news is None                 # '' -> NULL
    h = wh.history.collect()
    assert len(h) == 1 and h[0].fixture_id == 101   # the later snapshot has the rows


def test_sentinels_and_id_conformance(wh):
    hp = {r.season_player_id: r for r in wh.hist_players.collect()}
    assert hp[5].penalties_order is None and hp[6].penalties_order is None and hp[8].penalties_order == 1
    assert hp[8].player_code is None
    perf = wh.performance.collect()
    cur = [r for r in perf if r.season == "2026-27"]
    old = [r for r in perf if r.season == "2025-26"]
    assert [(r.player_code, r.team_code, r.opponent_team_code) for r in cur] == [(100, 3, 7)]
    assert sorted((r.player_code, r.team_code, r.opponent_team_code) for r in old) == [(100, 3, 7), (200, 7, 43)]


def test_dim_teams_fallbacks(wh):
    t = {r.team_code: r for r in wh.dim_teams.collect()}
    assert t[3].strength_attack_home == 1200       # published
    assert t[7].strength_attack_home == 1100       # most recent historical
    assert t[90].strength_attack_home == pytest.approx((1000 + 1100 + 1300) / 3)  # average
    assert t[43].is_in_current_season is False and t[43].current_team_id is None
    assert set(t) == {3, 7, 90, 43}


def test_dim_players_union(wh):
    d = {r.player_code: r for r in wh.dim_players.collect()}
    assert set(d) == {100, 101, 102, 200}
    assert d[200].is_in_current_season is False and d[200].current_price is None
    assert d[100].current_team_code == 3


def test_fixture_density_blank_and_double(wh):
    f = {(r.team_code, r.gameweek_id): r.fixture_count for r in wh.fct_team_gameweek_fixtures.collect()}
    assert f[(3, 1)] == 0 and f[(3, 2)] == 2 and f[(3, 3)] == 0
    assert f[(7, 2)] == 1 and f[(90, 3)] == 1


def test_expected_points(wh):
    nxt = {r.player_code: r for r in wh.fct_player_expected_points.collect()}
    # no defender has any history -> no baseline row for that position; the
    # baseline is an inner join, so the defender has no forecast (as in the reference)
    assert set(nxt) == {100, 102}
    assert nxt[100].gameweek_id == 2 and nxt[100].fixture_count == 2 and nxt[100].expected_points > 0
    assert nxt[102].fixture_count == 1
    byp = wh.fct_player_expected_points_by_gameweek.where(F.col("player_code") == 100) \
        .orderBy("gameweek_id").collect()
    assert [(r.gameweek_id, r.weeks_ahead, r.fixture_count) for r in byp] == [(2, 0, 2), (3, 1, 0)]
    hz = {r.player_code: r for r in wh.fct_player_expected_points_horizon.collect()}
    assert hz[100].horizon_expected_points == pytest.approx(byp[0].expected_points)
    assert hz[100].horizon_gameweeks == 2


def test_shrinkage_between_rate_and_baseline(wh):
    s = {r.player_code: r for r in wh.form_shrunk.collect()}
    base = {r.position_id: r for r in wh.positional_baseline.collect()}
    # player 102 has no history: pure baseline
    assert s[102].goals_per_90 == pytest.approx(base[3].goals_per_90)
    assert float(s[102].confidence_weight) == 0.0


def test_no_next_gameweek_gives_empty_forecast(spark):
    w = Warehouse(spark, league(spark, next_gw=None), "2026-27")
    assert w.fct_player_expected_points.count() == 0
    assert w.fct_player_expected_points_horizon.count() == 0


def test_entries_latest_with_tiebreak(spark):
    from gaffer.plans.staging import stg_entries
    rows = [({"name": "old"}, 0, 1, 9), ({"name": "tie-low"}, 10, 2, 9), ({"name": "tie-high"}, 10, 3, 9),
            ({"name": "late-arrival-older"}, 5, 4, 9)]
    e = stg_entries(raw(spark, rows, keys=[("entry_id", "int")])).collect()
    assert [r.team_name for r in e] == ["tie-high"]


def test_empty_missing_and_null_arrays_give_no_rows(spark):
    from gaffer.plans.staging import stg_entry_chips
    rows = [({"chips": []}, 0, 1, 1), ({"current": []}, 0, 2, 2), ({"chips": None}, 0, 3, 3),
            ({"chips": [{"name": "wildcard", "event": 3, "time": "2026-09-01T10:00:00Z"}]}, 0, 4, 4)]
    c = stg_entry_chips(raw(spark, rows, keys=[("entry_id", "int")])).collect()
    assert [(r.entry_id, r.chip_name, r.gameweek_id) for r in c] == [(4, "wildcard", 3)]


def test_player_snapshot_changes(wh):
    ch = {r.player_code: r for r in wh.player_snapshot_changes().collect() if r.prev_price is not None}
    assert float(ch[100].prev_price) == 7.0 and float(ch[100].delta_price) == 0.5


def test_views_and_publish(spark, wh):
    import tempfile
    from gaffer.sources.versions import read_version
    wh.register_views(["dim_teams", "fct_team_gameweek_fixtures"], prefix="t_")
    n = spark.sql("SELECT count(*) AS n FROM t_fct_team_gameweek_fixtures WHERE is_double_gameweek").collect()[0].n
    assert n == 1
    root = tempfile.mkdtemp(prefix="gaffer-marts-")
    wh.publish(root, ["dim_teams", "dim_players"])
    wh.publish(root, ["dim_teams"])                      # full rebuild, not append
    assert read_version(spark, root, "dim_teams").count() == 4
    assert read_version(spark, root, "dim_players").count() == 4   # as the version before has it


def test_data_tests_read_each_table_once_per_key(spark, wh):
    import re
    from gaffer.plans.warehouse import DATA_TESTS
    own = [t for t in DATA_TESTS if not {"entries", "fct_entry_picks", "fct_entry_gameweek_performance"} & {t[0], *t[3:4]}]
    df = wh.data_tests(own)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet", plan)) <= 26
    known = wh.data_tests([("dim_players", "player_code", "not_null"), ("dim_teams", "team_code", "not_null")])
    assert "FileScan" not in known._jdf.queryExecution().executedPlan().toString()  # counted as they were written
    assert {(r.table_name, r.failures) for r in known.collect()} == {("dim_players", 0), ("dim_teams", 0)}
