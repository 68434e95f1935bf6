"""The decision layer over real-format payloads for a generated 20-club league."""
import datetime as dt
import json
import random

import pytest

from gaffer.plans.warehouse import Warehouse
from tests.test_decisions import brute_transfer

T0 = dt.datetime(2026, 8, 20, 12, 0, 0)
QUOTA = {1: 2, 2: 5, 3: 5, 4: 3}


def _raw(spark, rows, keys=()):
    data = [(*kv, T0 + dt.timedelta(minutes=m), json.dumps(p), i) for p, m, i, *kv in rows]
    schema = ", ".join([f"{k} {t}" for k, t in keys] + ["fetched_at timestamp", "payload string", "id long"])
    return spark.createDataFrame(data, schema)


def league(spark, seed=5):
    rnd = random.Random(seed)
    teams = [{"id": t, "code": 100 + t, "name": f"Club{t}", "short_name": f"C{t}",
              **{k: 1000 + rnd.randrange(300) for k in [
                  "strength", "strength_overall_home", "strength_overall_away", "strength_attack_home",
                  "strength_attack_away", "strength_defence_home", "strength_defence_away"]}}
             for t in range(1, 21)]
    elements, pid = [], 0
    for t in range(1, 21):
        for pos, q in QUOTA.items():
            for _ in range(q + 1):
                pid += 1
                elements.append({"id": pid, "code": 5000 + pid, "web_name": f"P{pid}", "team": t,
                                 "element_type": pos, "now_cost": rnd.randrange(40, 120), "status": "a"})
    events = [{"id": g, "name": f"Gameweek {g}", "finished": g <= 2, "is_current": g == 2, "is_next": g == 3}
              for g in range(1, 7)]
    fixtures, fid = [], 0
    for g in range(1, 7):
        order = list(range(1, 21))
        rnd.shuffle(order)
        for h, a in zip(order[::2], order[1::2]):
            fid += 1
            fixtures.append({"id": fid, "event": g, "team_h": h, "team_a": a})
    summaries = []
    for e in elements:
        hist = [{"fixture": g * 100 + e["id"], "round": g, "opponent_team": 1 + (e["team"] % 20), "was_home": True,
                 "minutes": rnd.choice([0, 30, 90]), "starts": rnd.choice([0, 1]), "goals_scored": rnd.choice([0, 0, 1]),
                 "assists": rnd.choice([0, 0, 1]), "clean_sheets": rnd.choice([0, 1]), "total_points": rnd.randrange(10),
                 "goals_conceded": rnd.randrange(3), "saves": rnd.randrange(4), "bonus": rnd.choice([0, 0, 1, 3])}
                for g in (1, 2)]
        summaries.append(({"history": hist}, 0, e["id"], e["id"]))
    # two managers with real picks for gameweek 2 (2/5/5/3, at most 3 per club)
    picks_rows, transfer_rows, hist_rows = [], [], []
    for entry in (1, 2):
        chosen, clubs = [], {}
        for pos, q in QUOTA.items():
            cands = [e for e in elements if e["element_type"] == pos]
            rnd.shuffle(cands)
            for e in cands:
                if sum(1 for c in chosen if c["element_type"] == pos) == q:
                    break
                if clubs.get(e["team"], 0) < 3:
                    chosen.append(e)
                    clubs[e["team"]] = clubs.get(e["team"], 0) + 1
        picks = [{"element": e["id"], "position": i + 1, "multiplier": 1, "is_captain": i == 0,
                  "is_vice_captain": i == 1} for i, e in enumerate(chosen)]
        picks_rows.append(({"picks": picks, "active_chip": None,
                            "entry_history": {"bank": 35, "value": 1000}}, 0, entry, entry, 2))
        transfer_rows.append(([{"event": 2, "element_in": chosen[3]["id"], "element_in_cost": 50,
                                "element_out": 999, "element_out_cost": 50, "time": "2026-08-15T10:00:00Z"}],
                              0, entry, entry))
        hist_rows.append(({"current": [{"event": 2, "points": 50, "bank": 35, "value": 1000}]}, 0, entry, entry))
    season = [("season", "string")]
    empty_hist = [([], 0, 1, "2025-26")]
    raw = {
        "bootstrap_static_snapshot": _raw(spark, [({"elements": elements, "teams": teams, "events": events,
                                                    "element_types": []}, 0, 1)]),
        "fixtures_snapshot": _raw(spark, [(fixtures, 0, 1)]),
        "element_summary_snapshot": _raw(spark, summaries, [("element_id", "int")]),
        "entry_picks_snapshot": _raw(spark, picks_rows, [("entry_id", "int"), ("event_id", "int")]),
        "entry_transfers_snapshot": _raw(spark, transfer_rows, [("entry_id", "int")]),
        "entry_history_snapshot": _raw(spark, hist_rows, [("entry_id", "int")]),
        "historical_players_snapshot": _raw(spark, empty_hist, season),
        "historical_teams_snapshot": _raw(spark, empty_hist, season),
        "historical_gw_stats_snapshot": _raw(spark, empty_hist, season),
    }
    return raw, elements


@pytest.fixture(scope="module")
def setup(spark):
    raw, elements = league(spark)
    wh = Warehouse(spark, raw, "2026-27", horizon=4)
    squads = wh.current_squads()
    return wh, squads, elements


def test_lineups_and_chips_for_real_picks(setup):
    wh, squads, _ = setup
    assert squads.count() == 30
    lu = wh.lineups(squads).collect()
    per = {}
    for r in lu:
        per.setdefault((r.entry_id, r.gameweek_id), []).append(r)
    assert sorted({g for _, g in per}) == [3, 4, 5, 6]
    for rows in per.values():
        assert len(rows) == 15 and sum(r.squad_role == "starting" for r in rows) == 11
    chips = wh.chips(wh.lineups(squads)).collect()
    assert {(c.entry_id, c.chip_name) for c in chips if c.chip_rank == 1} == \
        {(e, c) for e in (1, 2) for c in ("bench_boost", "triple_captain")}


def test_transfers_use_real_prices_and_bank(setup):
    wh, squads, elements = setup
    pur = wh.purchases(squads)
    pp = {(r.entry_id, r.player_code): r for r in pur.collect()}
    banks = {r.entry_id: r.bank_tenths for r in wh.banks(pur).collect()}
    assert banks == {1: 35, 2: 35}                       # the real bank wins over 100 - purchases
    bought = [k for k, r in pp.items() if r.purchase_price == 5.0]
    assert len(bought) == 2                              # one real transfer-in per manager
    best = {r.entry_id: r for r in wh.transfers(squads, pur, wh.banks(pur)).collect()}
    pool = [(r.player_code, r.position_id, r.team_code, r.price_tenths, r.score)
            for r in wh.decision_pool.collect()]
    # brute force with sell values: owned players sell at sell value, not price
    from gaffer.functions.scalars import sell_value_tenths  # noqa: F401 (documented rule)
    by = {p[0]: p for p in pool}
    for e in (1, 2):
        squad = [c for (ee, c) in pp if ee == e]
        sells = {}
        for c in squad:
            cur, buy = by[c][3], round(pp[(e, c)].purchase_price * 10)
            sells[c] = buy + (cur - buy) // 2 if cur > buy else cur
        adj_pool = [(c, p, cl, (sells[c] if c in sells else pr), s) for c, p, cl, pr, s in pool]
        # brute_transfer charges the sold player's price from the pool entry; give it the sell value
        truth = brute_transfer(squad, adj_pool, banks[e])
        got = best.get(e)
        if truth is None:
            assert got is None
        else:
            assert (got.gain, -got.out_code, -got.in_code) == pytest.approx(truth)


def test_chip_report_has_four_rows_per_manager(setup):
    wh, squads, _ = setup
    lu = wh.lineups(squads)
    fh = wh.free_hit(lu)
    rows = fh.collect()
    assert len(rows) == 8 and all(r.free_hit_value is None or r.free_hit_value >= -1e-9 for r in rows)
    pur = wh.purchases(squads)
    b = wh.banks(pur)
    wc = wh.wildcard(pur, b, wh.transfer_plan(pur, b))
    for r in wc.collect():
        assert 0 <= r.gain_lower <= r.gain_upper <= 56 and r.ordinary_lower <= r.ordinary_upper + 1e-9
    report = wh.chip_report(lu, fh, wc).collect()
    assert sorted((r.entry_id, r.chip_name) for r in report) == sorted(
        (e, c) for e in (1, 2) for c in ("bench_boost", "triple_captain", "free_hit", "wildcard"))
    names = {r.web_name for r in wh.dim_players.collect()}
    assert all(r.detail in names for r in report if r.chip_name == "triple_captain")
    assert all(r.gameweek_id is None for r in report if r.chip_name == "wildcard")


def test_squad_member_without_a_score_counts_zero(spark, setup):
    from pyspark.sql import functions as F
    wh, squads, _ = setup
    stranger = squads.where("entry_id = 1 and position_id = 4").limit(1) \
        .withColumn("player_code", F.lit(999999).cast("int"))
    some = squads.where("entry_id = 1").join(
        squads.where("entry_id = 1 and position_id = 4").limit(1).select("player_code"), "player_code", "left_anti")
    lu = wh.lineups(some.unionByName(stranger.select(some.columns))).collect()
    assert len(lu) == 15 * 4
    lost = [r for r in lu if r.player_code == 999999]
    assert len(lost) == 4 and all(not r.scored and r.expected_points == 0 for r in lost)
