"""Decision operators against brute force on small random instances."""
import itertools
import random

import pytest
from pyspark.sql import functions as F

from gaffer.operators.decisions import (
    best_lineup, best_single_transfer, check_squad, net_points, squad_frontier,
)

QUOTA = {1: 2, 2: 5, 3: 5, 4: 3}
LO = {1: 1, 2: 3, 3: 2, 4: 1}
HI = {1: 1, 2: 5, 3: 5, 4: 3}


def brute_lineup(players):
    best = None
    for xi in itertools.combinations(players, 11):
        cnt = {p: sum(1 for x in xi if x[1] == p) for p in QUOTA}
        if all(LO[p] <= cnt[p] <= HI[p] for p in QUOTA):
            v = sum(x[2] for x in xi)
            best = v if best is None or v > best else best
    return best + max(x[2] for x in players)


def test_best_lineup_equals_brute_force(spark):
    rnd = random.Random(7)
    rows, truth = [], {}
    for e in range(25):
        players = []
        code = 0
        for pos, q in QUOTA.items():
            for _ in range(q):
                code += 1
                players.append((e * 100 + code, pos, round(rnd.uniform(-2, 9), 3)))
        truth[e] = brute_lineup(players)
        rows += [(e, 1, c, p, s) for c, p, s in players]
    df = spark.createDataFrame(rows, "entry_id int, gameweek_id int, player_code int, position_id int, "
                                     "expected_points double")
    out = best_lineup(df).collect()
    got = {r.entry_id: r.total_expected_points for r in out}
    for e, v in truth.items():
        assert got[e] == pytest.approx(v)
    for e in truth:
        mine = [r for r in out if r.entry_id == e]
        assert sum(r.squad_role == "starting" for r in mine) == 11
        assert sum(r.is_captain for r in mine) == 1 and sum(r.is_vice_captain for r in mine) == 1
        bench = sorted((r for r in mine if r.squad_role == "bench"), key=lambda r: r.bench_order)
        assert [r.bench_order for r in bench] == [1, 2, 3, 4]
        gk_last = [r.position_id == 1 for r in bench]
        assert gk_last == sorted(gk_last)          # goalkeeper after the outfield bench
        outfield = [r.expected_points for r in bench if r.position_id != 1]
        assert outfield == sorted(outfield, reverse=True)
        cap = [r for r in mine if r.is_captain][0]
        assert cap.expected_points == max(r.expected_points for r in mine)


def _instance(rnd, n_per_pos=9, clubs=4):
    pool, code = [], 0
    for pos in QUOTA:
        for _ in range(n_per_pos):
            code += 1
            pool.append((code, pos, rnd.randrange(clubs), rnd.randrange(40, 90), round(rnd.uniform(0, 60), 3)))
    return pool


def brute_transfer(squad, pool, bank_t):
    owned = {c for c in squad}
    by = {p[0]: p for p in pool}
    clubs = {}
    for c in squad:
        clubs[by[c][2]] = clubs.get(by[c][2], 0) + 1
    best = None
    for o in squad:
        oc, op, ocl, opr, osc = by[o]
        for ic, ip, icl, ipr, isc in pool:
            if ic in owned or ip != op or ipr > bank_t + opr:
                continue
            if clubs.get(icl, 0) - (1 if icl == ocl else 0) + 1 > 3:
                continue
            cand = (isc - osc, -o, -ic)
            best = cand if best is None or cand > best else best
    return best


def test_best_single_transfer_equals_brute_force(spark):
    rnd = random.Random(11)
    squads, pools, banks, truth = [], [], [], {}
    pool = _instance(rnd)
    for e in range(30):
        squad = []
        for pos, q in QUOTA.items():
            cands = [p[0] for p in pool if p[1] == pos]
            squad += rnd.sample(cands, q)
        bank_t = rnd.randrange(0, 40)
        truth[e] = brute_transfer(squad, pool, bank_t)
        squads += [(e, c, next(p[3] for p in pool if p[0] == c)) for c in squad]
        banks.append((e, bank_t))
    sq = spark.createDataFrame(squads, "entry_id int, player_code int, purchase_tenths int")
    pl = spark.createDataFrame(pool, "player_code int, position_id int, team_code int, price_tenths int, "
                                     "score double")
    bk = spark.createDataFrame(banks, "entry_id int, bank_tenths int")
    got = {r.entry_id: r for r in best_single_transfer(sq, pl, bk).collect()}
    for e, t in truth.items():
        if t is None:
            assert e not in got
        else:
            r = got[e]
            assert (r.gain, -r.out_code, -r.in_code) == pytest.approx(t)


def test_transfer_scenarios(spark):
    """The four prose scenarios: optimal squad keeps everyone; a clearly bad
    player is swapped for free; a marginal gain below the hit is declined."""
    pool = [(1, 4, 0, 60, 10.0), (2, 4, 1, 60, 9.0), (3, 4, 2, 60, 1.0), (4, 4, 3, 60, 8.0)]
    pl = spark.createDataFrame(pool, "player_code int, position_id int, team_code int, price_tenths int, "
                                     "score double")
    bk = spark.createDataFrame([(1, 0), (2, 0)], "entry_id int, bank_tenths int")
    sq = spark.createDataFrame([(1, 1, 60), (1, 2, 60), (1, 4, 60), (2, 1, 60), (2, 2, 60), (2, 3, 60)],
                               "entry_id int, player_code int, purchase_tenths int")
    r = {x.entry_id: x for x in best_single_transfer(sq, pl, bk).collect()}
    assert r[1].gain < 0                      # optimal squad: no improving swap
    assert (r[2].out_code, r[2].in_code, r[2].gain) == (3, 4, 7.0)   # bad player out, free
    df = spark.createDataFrame([(3.0, 1, 0), (7.0, 1, 1), (7.0, 2, 1)], "gain double, n int, free int")
    nets = [x.v for x in df.select(net_points(F.col("gain"), "n", "free").alias("v")).collect()]
    assert nets == [-1.0, 7.0, 3.0]           # a 3-point gain does not pay a 4-point hit


def brute_squad(pool, budget_t):
    by_pos = {p: [x for x in pool if x[1] == p] for p in QUOTA}
    best = None
    for g in itertools.combinations(by_pos[1], 2):
        for d in itertools.combinations(by_pos[2], 5):
            for m in itertools.combinations(by_pos[3], 5):
                for f in itertools.combinations(by_pos[4], 3):
                    sq = g + d + m + f
                    if sum(x[3] for x in sq) > budget_t:
                        continue
                    cl = {}
                    for x in sq:
                        cl[x[2]] = cl.get(x[2], 0) + 1
                    if max(cl.values()) > 3:
                        continue
                    v = sum(x[4] for x in sq)
                    best = v if best is None or v > best else best
    return best


def test_squad_frontier_bounds_hold(spark):
    rnd = random.Random(3)
    pool = []
    code = 0
    for pos, n in {1: 3, 2: 6, 3: 6, 4: 4}.items():
        for _ in range(n):
            code += 1
            pool.append((code, pos, rnd.randrange(8), rnd.randrange(40, 85), round(rnd.uniform(10, 80), 2)))
    budget = 1000
    opt = brute_squad(pool, budget)
    pl = spark.createDataFrame(pool, "player_code int, position_id int, team_code int, price_tenths int, "
                                     "score double")
    r = squad_frontier(pl, [x / 4 for x in range(0, 17)], budget).collect()[0]
    assert opt is not None
    assert r.upper_bound >= opt - 1e-9
    if r.feasible:
        assert r.lower_value <= opt + 1e-9 and r.squad_cost * 10 <= budget + 1e-9


def test_check_squad_flags(spark):
    sq = spark.createDataFrame([(1, c, p) for c, p in zip(range(15), [1, 1] + [2] * 5 + [3] * 5 + [4] * 3)]
                               + [(2, c, 2) for c in range(15)],
                               "entry_id int, player_code int, position_id int")
    prices = spark.createDataFrame([(c, c % 5, 6.5) for c in range(15)], "player_code int, team_code int, price double")
    r = {x.entry_id: x for x in check_squad(sq, prices).collect()}
    assert r[1].size_ok and r[1].positions_ok and r[1].clubs_ok and r[1].budget_ok
    assert not r[2].positions_ok


POOL_SCHEMA = "player_code int, position_id int, team_code int, price_tenths int, score double"
SQUAD_SCHEMA = "entry_id int, player_code int, purchase_tenths int"


def test_transfer_plan_scenarios(spark):
    from gaffer.operators.decisions import transfer_plan
    pool = [(1, 4, 0, 60, 10.0), (2, 4, 1, 60, 9.0), (3, 4, 2, 60, 1.0), (4, 4, 3, 60, 8.0),
            (5, 4, 4, 60, 2.0), (6, 4, 5, 60, 7.5), (7, 4, 6, 60, 2.5)]
    pl = spark.createDataFrame(pool, POOL_SCHEMA)
    bk = spark.createDataFrame([(1, 0), (2, 0), (3, 0)], "entry_id int, bank_tenths int")
    sq = spark.createDataFrame([(1, 1, 60), (1, 2, 60), (1, 4, 60),          # already optimal
                                (2, 1, 60), (2, 3, 60), (2, 5, 60),          # two bad players
                                (3, 1, 60), (3, 2, 60), (3, 7, 60)], SQUAD_SCHEMA)   # one bad player
    r = {x.entry_id: x for x in transfer_plan(sq, pl, bk, free_transfers=1).collect()}
    assert r[1].n_transfers == 0 and r[1].net_gain == 0.0 and r[1].out_codes == ""
    assert r[2].n_transfers == 2 and r[2].hit_cost == 4            # 8 + 6 - 4 beats 8 alone
    assert (r[2].out_codes, r[2].in_codes) == ("3,5", "2,4") and r[2].net_gain == 10.0
    assert r[3].n_transfers == 1 and r[3].hit_cost == 0            # a second move would not pay the hit
    assert all(x.gap >= -1e-9 for x in r.values())


def small_league(seed, n_squad=(2, 2), n_pool=5):
    """A two-position game small enough to enumerate every squad of a manager."""
    rnd = random.Random(seed)
    pool, code = [], 0
    for pos in (1, 2):
        for _ in range(n_pool):
            code += 1
            pool.append((code, pos, rnd.randrange(3), rnd.randrange(40, 60), float(rnd.randrange(4, 40))))
    squad = [p[0] for pos, k in zip((1, 2), n_squad) for p in rnd.sample([x for x in pool if x[1] == pos], k)]
    return pool, squad, rnd.randrange(0, 15)


def all_plans(pool, squad, bank_t):
    """(transfers, gross gain) of every legal squad within the budget."""
    by = {p[0]: p for p in pool}
    shape = [sum(by[c][1] == pos for c in squad) for pos in (1, 2)]
    worth = sum(by[c][3] for c in squad) + bank_t
    base = sum(by[c][4] for c in squad)
    out = []
    for a in itertools.combinations([p for p in pool if p[1] == 1], shape[0]):
        for b in itertools.combinations([p for p in pool if p[1] == 2], shape[1]):
            new = a + b
            clubs = [p[2] for p in new]
            if sum(p[3] for p in new) <= worth and max(clubs.count(c) for c in clubs) <= 3:
                out.append((len({p[0] for p in new} - set(squad)), sum(p[4] for p in new) - base))
    return out


def test_transfer_plan_is_bracketed_by_brute_force(spark):
    from gaffer.operators.decisions import transfer_plan
    squads, banks, pools, best, k2 = [], [], None, {}, {}
    rnd = random.Random(11)
    pool, _, _ = small_league(2, n_pool=6)
    for e in range(1, 13):
        squad = [p[0] for pos in (1, 2) for p in rnd.sample([x for x in pool if x[1] == pos], 2)]
        bank_t = rnd.randrange(0, 15)
        plans = all_plans(pool, squad, bank_t)
        net = {n: max(g for m, g in plans if m == n) - 4 * max(0, n - 1) for n in {m for m, _ in plans}}
        best[e], k2[e] = max([0.0, *net.values()]), max([0.0, *(v for n, v in net.items() if n <= 1)])
        squads += [(e, c, next(p[3] for p in pool if p[0] == c)) for c in squad]
        banks.append((e, bank_t))
    got = {r.entry_id: r for r in transfer_plan(
        spark.createDataFrame(squads, SQUAD_SCHEMA), spark.createDataFrame(pool, POOL_SCHEMA),
        spark.createDataFrame(banks, "entry_id int, bank_tenths int")).collect()}
    for e, r in got.items():
        assert k2[e] - 1e-9 <= r.net_gain <= best[e] + 1e-9 <= r.upper_net_gain + 2e-9


def test_wildcard_interval_holds_the_true_gain(spark, monkeypatch):
    """Brute force on a game of two positions: quotas 2 and 2, squads of four."""
    from gaffer.operators import decisions as D
    from gaffer.sources import seed as S
    quotas = spark.createDataFrame([(1, 2), (2, 2)], "position_id int, squad_quota int")
    monkeypatch.setattr(D, "squad_quotas", lambda _: quotas)
    monkeypatch.setattr(D, "SQUAD_SIZE", 4)
    assert S.SQUAD_SIZE == 15
    rnd = random.Random(5)
    pool, _, _ = small_league(4, n_pool=6)
    squads, banks, truth = [], [], {}
    for e in range(1, 11):
        squad = [p[0] for pos in (1, 2) for p in rnd.sample([x for x in pool if x[1] == pos], 2)]
        bank_t = rnd.randrange(0, 15)
        plans = all_plans(pool, squad, bank_t)
        ordinary = max([0.0, *(g - 4 * max(0, n - 1) for n, g in plans)])
        truth[e] = max([0.0, *(g for _, g in plans)]) - ordinary
        squads += [(e, c, next(p[3] for p in pool if p[0] == c)) for c in squad]
        banks.append((e, bank_t))
    sq, pl = spark.createDataFrame(squads, SQUAD_SCHEMA), spark.createDataFrame(pool, POOL_SCHEMA)
    bk = spark.createDataFrame(banks, "entry_id int, bank_tenths int")
    plan = D.transfer_plan(sq, pl, bk)
    got = {r.entry_id: r for r in D.wildcard_gain(sq, pl, bk, plan, [x / 4 for x in range(17)]).collect()}
    assert set(got) == set(truth)
    for e, r in got.items():
        assert 0.0 <= r.gain_lower <= truth[e] + 1e-9 and truth[e] <= r.gain_upper + 1e-9 <= 12.0 + 2e-9


def test_free_hit_leaves_the_captain_out_on_both_sides(spark):
    from gaffer.operators.decisions import best_lineup, free_hit
    shape = [1, 1] + [2] * 5 + [3] * 5 + [4] * 3
    pool = [(c, 1, shape[c % 15], c // 2, 50, float(10 + c)) for c in range(30)]  # two squads' worth, cheap
    own = [(7, 1, c, shape[c], float(10 + c)) for c in range(15)]
    lu = best_lineup(spark.createDataFrame(
        own, "entry_id int, gameweek_id int, player_code int, position_id int, expected_points double"))
    pp = spark.createDataFrame(pool, "player_code int, gameweek_id int, position_id int, team_code int, "
                                     "price_tenths int, expected_points double")
    r = free_hit(lu, pp, [0.0], 1000).collect()[0]
    # the best 15 are codes 15..29: each position scores 15 more than the own squad
    assert r.free_hit_value == 11 * 15.0 and r.own_xi == lu.first().xi_points


def test_prune_pool_equals_pairwise_dominance(spark):
    from gaffer.operators.decisions import prune_pool
    rnd = random.Random(21)
    pool = [(c, rnd.randrange(1, 5), rnd.randrange(20), rnd.randrange(40, 60), float(rnd.randrange(30)))
            for c in range(1, 301)]
    want = set()
    for c, p, cl, pr, s in pool:
        clubs = {ycl for yc, yp, ycl, ypr, ys in pool
                 if yp == p and yc != c and ypr <= pr and (ys > s or (ys == s and yc < c))}
        if len(clubs) < 4 + QUOTA[p]:
            want.add(c)
    pl = spark.createDataFrame(pool, "player_code int, position_id int, team_code int, price_tenths int, "
                                     "score double")
    got = {r.player_code for r in prune_pool(pl).collect()}
    assert got == want and 0 < len(got) < len(pool)


def test_lineup_takes_no_more_rows_than_players(spark):
    """One row per key until it is written out: no row per formation, no sort of such rows."""
    from gaffer.operators.decisions import best_lineup
    shape = [1, 1] + [2] * 5 + [3] * 5 + [4] * 3
    rows = spark.createDataFrame([(e, 1, c, shape[c], float(c + e)) for e in range(3) for c in range(15)],
                                 "entry_id int, gameweek_id int, player_code int, position_id int, expected_points double")
    out = best_lineup(rows)
    assert out.count() == 45 and out.where("is_captain").count() == 3
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" not in plan


def test_transfer_plan_stores_no_rounds(spark, monkeypatch):
    """A manager's swaps run in the task that holds the squad: nothing is joined or stored per swap."""
    from gaffer.operators import decisions as D
    stored = []
    monkeypatch.setattr(D, "materialized", lambda df, name, f=D.materialized: stored.append(name) or f(df, name))
    pool = [(c, 1 + c % 4, c % 9, 50, float(c)) for c in range(80)]
    mine = [[c for c in range(80) if 1 + c % 4 == q][:k] for q, k in QUOTA.items()]
    sq = spark.createDataFrame([(1, c, 50) for x in mine for c in x], SQUAD_SCHEMA)
    plan = D.transfer_plan(sq, spark.createDataFrame(pool, POOL_SCHEMA), spark.createDataFrame([(1, 0)], "entry_id int, bank_tenths int"))
    assert plan.first().n_transfers > 5 and len(stored) <= 2


def test_prune_pool_does_not_multiply_players(spark):
    from gaffer.operators.decisions import prune_pool
    pool = spark.createDataFrame([(c, 1 + c % 4, c % 9, 40 + c % 7, float(c)) for c in range(80)], POOL_SCHEMA)
    plan = prune_pool(pool)._jdf.queryExecution().optimizedPlan().toString()
    # players meet their price's list only: the one window over players is the ladder's own
    assert "Expand" not in plan and plan.count("Window [") <= 2


def test_tasks_follow_the_rows(spark, monkeypatch):
    from gaffer.plans import analogue
    monkeypatch.setattr(analogue, "TASK_ROWS", 100)
    assert analogue.tasks_for(spark.range(4001)) == 41 and analogue.tasks_for(spark.range(3)) == 8


def test_lineup_reckons_every_formation_once(spark):
    """A filter on the options was pushed below them, and all formations were reckoned twice."""
    from gaffer.operators.decisions import best_lineup, formation_shapes
    shape = {1: 2, 2: 5, 3: 5, 4: 3}
    rows = [(e, 1, q * 10 + i, q, float(q + i)) for e in (1, 2, 3) for q, n in shape.items() for i in range(n)
            if not (e == 2 and q == 1) and not (e == 3 and q == 3)]   # no keeper; too few midfielders
    squads = spark.createDataFrame(rows, "entry_id int, gameweek_id int, player_code int, position_id int, expected_points double")
    out = best_lineup(squads)
    assert {r.entry_id for r in out.collect()} == {1} and out.count() == 15
    assert out._jdf.queryExecution().optimizedPlan().toString().count("aggregate(") == len(list(formation_shapes()))
