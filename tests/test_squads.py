"""Squad searches against brute force on small pools."""
import itertools
import random

import numpy as np
import pytest

from gaffer.functions import scalars  # noqa: F401
from gaffer.operators import squads as S
from gaffer.operators.decisions import best_lineup
from gaffer.operators.squadsearch import LOW, Places, Players, fill, search, undominated, value_of

POOL = "player_code int, position_id int, team_code int, price_tenths int, score double"
QUOTAS = {1: 2, 2: 5, 3: 5, 4: 3}
SHAPES = [(d, m, f) for d in range(3, 6) for m in range(2, 6) for f in range(1, 4) if d + m + f == 10]


def brute_search(p, places, budget, caps):
    best = LOW
    lists = [list(itertools.combinations(np.flatnonzero(p.position == q), sum(places.of(q)))) for q in places.scored]
    for combo in itertools.product(*lists):
        c = [i for x in combo for i in x]
        if p.cost[c].sum() <= budget and (np.bincount(p.club[c], minlength=len(caps)) <= caps).all():
            best = max(best, value_of(p, c, places))
    return best


def test_search_bounds_hold_and_are_mostly_tight():
    rnd = np.random.default_rng(1)
    kinds = [Places({1: 1, 2: 2, 3: 1}), Places({1: 1, 2: 1, 3: 1}, {2: 1, 3: 1}), Places({1: 1, 2: 2, 3: 1}, {}, 1, 4.0),
             Places({1: 1, 2: 2, 3: 2}, {}, 2, 2.0)]
    tight = 0
    for trial in range(100):
        p = Players(rnd.integers(1, 4, 14), rnd.integers(0, 4, 14), rnd.integers(4, 12, 14),
                    np.round(rnd.random(14) * 10, 3), rnd.random(14) < .6)
        places, caps, budget = kinds[trial % 4], np.array([2, 2, 1, 2]), int(rnd.integers(15, 45))
        found, want = search(p, places, budget, caps), brute_search(p, places, budget, caps)
        assert found.value <= want + 1e-9
        assert want == LOW or found.upper[budget] >= want - 1e-9
        for b in range(0, budget + 1, 7):
            assert found.upper[b] >= brute_search(p, places, b, caps) - 1e-9 or brute_search(p, places, b, caps) == LOW
        tight += abs(found.value - want) < 1e-9
    assert tight >= 95


def test_fill_is_exact_for_every_budget_without_caps():
    rnd = np.random.default_rng(2)
    p = Players(rnd.integers(1, 3, 10), np.zeros(10, int), rnd.integers(1, 9, 10), rnd.random(10), rnd.random(10) < .5)
    for places in (Places({1: 1, 2: 2}), Places({1: 1, 2: 1}, {2: 1}), Places({1: 1, 2: 2}, {}, 2, .5)):
        total, squad = fill(p, np.zeros(10), places, 25)
        for b in range(26):
            want = brute_search(p, places, b, np.array([99]))
            assert total[b] == pytest.approx(want) if want > LOW else total[b] < LOW / 2
            if want > LOW:
                assert value_of(p, squad(b), places) == pytest.approx(want) and p.cost[squad(b)].sum() <= b
    assert len(undominated(p, np.zeros(10), Places({1: 1, 2: 2}))) < 10


def small_pool(seed, extra=2, clubs=6):
    rnd = random.Random(seed)
    rows, code = [], 1
    for q, n in QUOTAS.items():
        for _ in range(n + (1 if q != 2 else extra)):
            rows.append((code, q, rnd.randint(1, clubs), rnd.randint(40, 90), round(rnd.uniform(0, 30), 3)))
            code += 1
    return rows


def all_squads(rows, budget, cost=None):
    cost = cost or {}
    lists = [list(itertools.combinations([r for r in rows if r[1] == q], n)) for q, n in QUOTAS.items()]
    for combo in itertools.product(*lists):
        squad = [r for x in combo for r in x]
        clubs = [r[2] for r in squad]
        if sum(cost.get(r[0], r[3]) for r in squad) <= budget and max(map(clubs.count, clubs)) <= 3:
            yield squad


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_best_squad_and_curve_equal_brute_force(spark, seed):
    rows = small_pool(seed)
    pool = spark.createDataFrame(rows, POOL)
    budgets = [1400, 1000, 930, 860]
    best = {b: max((sum(r[4] for r in s) for s in all_squads(rows, b)), default=None) for b in budgets}
    curve = {r.budget_tenths: r for r in S.budget_curve(pool, budgets, steps=60).collect()}
    for b in budgets:
        r = S.best_squad(pool, b).collect()[0]
        if best[b] is None:
            assert not r.feasible and (b not in curve or curve[b].lower_value is None)
            continue
        assert r.lower_value <= best[b] + 1e-9 <= r.upper_bound + 2e-9
        assert r.lower_value == pytest.approx(best[b], abs=0.5) and r.squad_cost * 10 <= b + 1e-9
        assert curve[b].lower_value <= best[b] + 1e-9 and curve[b].upper_value >= best[b] - 1e-9
    lowers = [curve[b].lower_value for b in sorted(curve) if curve[b].lower_value is not None]
    assert lowers == sorted(lowers)


def brute_moves(own, money, pool, free, most=2, hit=4):
    """Best net of at most ``most`` moves; own: (code, position, club, score, sell)."""
    best = 0.0
    mine = {o[0] for o in own}
    for n in range(1, most + 1):
        for outs in itertools.combinations(own, n):
            rest = [o[2] for o in own if o not in outs]
            for ins in itertools.product(*[[p for p in pool if p[1] == o[1] and p[0] not in mine] for o in outs]):
                if len({p[0] for p in ins}) < n or money + sum(o[4] for o in outs) < sum(p[3] for p in ins):
                    continue
                clubs = rest + [p[2] for p in ins]
                if all(p[2] is None or clubs.count(p[2]) <= 3 for p in ins):
                    best = max(best, sum(p[4] for p in ins) - sum(o[3] for o in outs) - hit * max(0, n - free))
    return best


@pytest.mark.parametrize("free", [0, 1, 2])
def test_transfers_equal_brute_force(spark, free):
    rnd = random.Random(free)
    pool = [(c, 1 + c % 4, rnd.choice([1, 2, 3, 4, 5, None]), rnd.randint(40, 80), round(rnd.uniform(0, 12), 3)) for c in range(40)]
    squads, banks, want = [], [], {}
    for e in range(1, 7):
        own = [p for q in QUOTAS for p in rnd.sample([p for p in pool if p[1] == q], QUOTAS[q])]
        bought = {p[0]: p[3] - rnd.randint(-10, 10) for p in own}
        money = rnd.randint(-5, 15)
        squads += [(e, p[0], bought[p[0]]) for p in own] + [(e, 900 + e, 50)]  # one that the pool does not have
        banks.append((e, money))
        sell = lambda p: bought[p[0]] + (p[3] - bought[p[0]]) // 2 if p[3] > bought[p[0]] else p[3]
        want[e] = brute_moves([(p[0], p[1], p[2], p[4], sell(p)) for p in own], money, pool, free)
    sq = spark.createDataFrame(squads, "entry_id int, player_code int, purchase_tenths int")
    pl, bk = spark.createDataFrame(pool, POOL), spark.createDataFrame(banks, "entry_id int, bank_tenths int")
    two = {r.entry_id: r for r in S.transfers(sq, pl, bk, free, most_moves=2).collect()}
    many = {r.entry_id: r for r in S.transfers(sq, pl, bk, free).collect()}
    for e in want:
        assert two[e].net_gain == pytest.approx(want[e]), e
        assert many[e].net_gain >= two[e].net_gain - 1e-9 and many[e].upper_net_gain >= many[e].net_gain - 1e-9
        assert many[e].net_gain == pytest.approx(many[e].gross_gain - many[e].hit_cost)


def test_moves_that_pay_for_each_other(spark):
    own = [(c, q, c % 6, 50, 10.0) for c, q in enumerate([q for q, n in QUOTAS.items() for _ in range(n)])]
    pool = own + [(100, 2, 20, 30, 9.0), (101, 3, 21, 70, 20.0)]
    sq = spark.createDataFrame([(1, p[0], 50) for p in own], "entry_id int, player_code int, purchase_tenths int")
    r = S.transfers(sq, spark.createDataFrame(pool, POOL), spark.createDataFrame([(1, 0)], "entry_id int, bank_tenths int"),
                    free_transfers=2).collect()[0]
    assert (r.n_transfers, r.net_gain, r.in_codes, r.gap) == (2, 9.0, "100,101", pytest.approx(0, abs=1e-6))


@pytest.mark.parametrize("seed", [5, 6])
def test_free_hit_by_eleven_equals_brute_force(spark, seed):
    rows = small_pool(seed)
    pool = spark.createDataFrame([(*r, 7) for r in rows], POOL.replace("score", "expected_points") + ", gameweek_id int")
    for budget in (1400, 930):
        best, whole = None, None
        for squad in all_squads(rows, budget):
            per = {q: sorted((r[4] for r in squad if r[1] == q), reverse=True) for q in QUOTAS}
            xi = max(per[1][0] + sum(per[2][:d]) + sum(per[3][:m]) + sum(per[4][:f]) for d, m, f in SHAPES)
            best = max(xi, best or 0)
            whole = max((sum(r[4] for r in squad), xi), whole or (0, 0))
        mine = next(all_squads(rows, 10_000))
        own = spark.createDataFrame([(1, 7, r[0], r[1], r[4]) for r in mine],
                                    "entry_id int, gameweek_id int, player_code int, position_id int, expected_points double")
        r = S.free_hit_by_eleven(best_lineup(own), pool, budget).collect()[0]
        if best is None:
            assert r.free_hit_xi is None
            continue
        assert r.free_hit_xi <= best + 1e-9 and r.upper_value + r.own_xi >= best - 1e-9
        assert r.free_hit_xi == pytest.approx(best, abs=0.5) and r.free_hit_xi >= r.reference_xi - 1e-9
        assert r.reference_xi == pytest.approx(whole[1], abs=0.5)


def test_wildcard_interval_holds_the_gain(spark):
    for seed in (8, 9):  # nine clubs leave many legal squads
        rnd = random.Random(seed)
        rows = small_pool(seed, clubs=9)
        mine = rnd.choice(list(itertools.islice(all_squads(rows, 10_000), 200)))
        bought = {r[0]: r[3] - rnd.randint(0, 6) for r in mine}
        sell = {r[0]: bought[r[0]] + (r[3] - bought[r[0]]) // 2 if r[3] > bought[r[0]] else r[3] for r in mine}
        money = sum(sell.values()) + 20
        value = lambda s: sum(r[4] for r in s)
        squads = list(all_squads(rows, money, sell))
        ordinary = max(value(s) - 4 * max(0, sum(r not in mine for r in s) - 1) for s in squads)
        gain = max(map(value, squads)) - ordinary
        sq = spark.createDataFrame([(1, c, p) for c, p in bought.items()], "entry_id int, player_code int, purchase_tenths int")
        pl, bk = spark.createDataFrame(rows, POOL), spark.createDataFrame([(1, 20)], "entry_id int, bank_tenths int")
        plan = S.transfers(sq, pl, bk)
        r = S.wildcard_interval(sq, pl, bk, plan).collect()[0]
        assert r.gain_lower - 1e-9 <= gain <= r.gain_upper + 1e-9
        assert r.ordinary_lower <= ordinary + 1e-9 <= r.ordinary_upper + 2e-9


def test_candidates_keep_what_any_squad_may_need(spark):
    rnd = random.Random(4)
    rows = [(c, 1 + c % 4, rnd.choice([1, 1, 1, 2, 3, None]), rnd.choice([45, 50, 55]), float(rnd.randint(0, 5))) for c in range(600)]
    rows += [(700, 1, 1, None, 99.0), (701, 1, 1, 40, None)]
    kept = S.candidates(spark.createDataFrame(rows, POOL)).collect()
    assert len(kept) <= 4 * 3 * S.KEPT and len({r.player_code for r in kept}) == len(kept)
    codes = {r.player_code for r in kept}
    for c, q, t, p, s in rows[:600]:
        if c in codes:
            continue
        better = [r for r in rows[:600] if r[1] == q and r[3] <= p and (r[4] > s or (r[4] == s and r[0] < c))]
        own_club = sum(r[2] == t for r in better)
        assert own_club >= S.DEPTH or len(better) >= S.KEPT


def test_empty_and_odd_inputs(spark):
    pool = spark.createDataFrame(small_pool(1), POOL)
    sq = spark.createDataFrame([(1, 1, 50), (2, 999, None), (3, None, 5)], "entry_id int, player_code int, purchase_tenths int")
    bk = spark.createDataFrame([(1, 10), (2, -5), (3, 0), (4, None)], "entry_id int, bank_tenths int")
    got = {r.entry_id: r for r in S.transfers(sq, pool, bk).collect()}
    assert set(got) == {1, 2} and got[2].n_transfers == 0  # a manager without players has no row
    none = {r.entry_id: r.n_transfers for r in S.transfers(sq, pool.limit(0), bk).collect()}
    assert none == {1: 0, 2: 0}
    assert not S.best_squad(pool.limit(0), 1000).collect()[0].feasible
    assert not S.best_squad(pool, 100).collect()[0].feasible
    assert S.transfers(sq.limit(0), pool, bk).count() == 0


def test_search_for_one_budget_equals_the_curve_at_it():
    rnd = np.random.default_rng(5)
    for trial in range(60):
        m, free = int(rnd.integers(14, 60)), int(rnd.integers(0, 3))
        p = Players(rnd.integers(1, 5, m), rnd.integers(0, 6, m), rnd.integers(4, 40, m), np.round(rnd.random(m) * 20, 6), rnd.random(m) < .6)
        places, caps, budget = Places({1: 1, 2: 2, 3: 2, 4: 2}, {}, free, 4.0), rnd.integers(1, 4, 6), int(rnd.integers(60, 200))
        a, b = search(p, places, budget, caps, 25), search(p, places, budget, caps, 25, curve=False)
        assert b.value == pytest.approx(a.value, abs=1e-6) and b.upper[budget] == pytest.approx(a.upper[budget], abs=2e-6)


def test_a_manager_takes_few_programs(monkeypatch):
    """Of a large pool most players are in or out without a program over budgets."""
    from gaffer.operators import squadsearch
    rnd = np.random.default_rng(3)
    n, sizes = 1200, []
    pool = {"code": np.arange(n), "position": rnd.integers(1, 5, n), "club": rnd.integers(0, 20, n),
            "price": rnd.integers(40, 131, n), "score": np.round(rnd.random(n) * 40, 6)}
    mine = np.concatenate([np.flatnonzero(pool["position"] == q)[:k] for q, k in QUOTAS.items()])
    own = {k: pool[k][mine] for k in ("code", "position", "club", "score")} | {"sell": pool["price"][mine]}
    monkeypatch.setattr(squadsearch, "fill", lambda p, *a: sizes.append(len(p.cost)) or fill(p, *a))
    S.best_plan(own, 300, pool, 1, 4, 25)
    assert sum(sizes) < 10 * n


def test_searches_are_spread_over_tasks(spark):
    sq = spark.range(400).selectExpr("id % 80 AS entry_id", "id AS player_code").groupBy("entry_id").agg({"player_code": "max"})
    parts = S.dealt(sq, "entry_id").selectExpr("entry_id", "spark_partition_id() AS p").groupBy("p").count().collect()
    assert len(parts) >= spark.sparkContext.defaultParallelism and max(r["count"] for r in parts) < 40


def test_two_moves_say_how_far_any_plan_could_go(spark):
    own = [(c, q, c % 6, 50, 10.0) for c, q in enumerate([q for q, n in QUOTAS.items() for _ in range(n)])]
    pool = own + [(100 + k, 2, 20 + k, 50, 20.0 + k) for k in range(4)]
    sq = spark.createDataFrame([(1, p[0], 50) for p in own], "entry_id int, player_code int, purchase_tenths int")
    r = S.transfers(sq, spark.createDataFrame(pool, POOL), spark.createDataFrame([(1, 0)], "entry_id int, bank_tenths int"),
                    most_moves=2).collect()[0]
    # two of the four better ones are bought; all four would win 46 less three hits
    assert (r.n_transfers, r.net_gain, r.upper_net_gain, r.gap) == (2, 21.0, 34.0, 13.0)


def test_the_best_that_can_be_paid_is_read_off_the_clubs_best():
    """With fines and shut players it is what the general search finds; it says None where money or buys bind."""
    from gaffer.operators.squadsearch import Tops, best_at
    rnd, paid = np.random.default_rng(6), 0
    for trial in range(200):
        m, free = int(rnd.integers(14, 80)), int(rnd.integers(0, 3))
        p = Players(rnd.integers(1, 5, m), rnd.integers(0, 6, m), rnd.integers(4, 40, m), np.round(rnd.random(m) * 20, 6), rnd.random(m) < .6)
        places, mu, budget = Places({1: 1, 2: 2, 3: 2, 4: 2}, {}, free, 4.0), np.where(rnd.random(6) < .5, rnd.random(6) * 9, 0), int(rnd.integers(60, 260))
        tops, out = Tops(p, places), rnd.integers(0, 7)  # club 6: nobody is shut out
        left, need = np.flatnonzero(p.club != out), float(rnd.random() * 60)
        found = tops.best_at(mu, budget, need, tops.club == out)
        if found is not None:
            value, squad = best_at(p.take(left), (p.value - mu[p.club])[left], places, budget, need)
            assert found == (pytest.approx(value), [int(left[i]) for i in squad])
            paid += bool(squad)
    assert paid > 40


def test_a_rich_manager_takes_no_general_search(monkeypatch):
    """Where money does not bind, no step of the search weighs prices of the whole pool."""
    from gaffer.operators import squadsearch
    rnd = np.random.default_rng(4)
    n, calls = 1200, []
    pool = {"code": np.arange(n), "position": rnd.integers(1, 5, n), "club": rnd.integers(0, 20, n),
            "price": rnd.integers(40, 131, n), "score": np.round(rnd.random(n) * 40, 6)}
    pool["score"][pool["club"] == 3] += 20  # one club fills up: fines and mending are needed
    mine = np.concatenate([np.flatnonzero(pool["position"] == q)[:k] for q, k in QUOTAS.items()])
    own = {k: pool[k][mine] for k in ("code", "position", "club", "score")} | {"sell": pool["price"][mine]}
    general = squadsearch.best_at
    monkeypatch.setattr(squadsearch, "best_at", lambda *a: calls.append(1) or general(*a))
    net, outs, ins, upper = S.best_plan(own, 2000, pool, 1, 4, 25)
    assert not calls and len(outs) == len(ins) > 2 and upper >= net > 0


def test_one_pool_serves_managers_in_any_order():
    """What is kept of a pool between managers does not depend on them."""
    rnd = np.random.default_rng(8)
    n = 200
    pool = {"code": np.arange(n), "position": rnd.integers(1, 5, n), "club": rnd.integers(-1, 12, n),
            "price": rnd.integers(40, 131, n), "score": np.round(rnd.random(n) * 40, 1)}
    managers = []
    for _ in range(6):
        mine = rnd.choice(n, 15, replace=False)
        managers.append(({k: pool[k][mine] for k in ("code", "position", "club", "score")} | {"sell": pool["price"][mine] - 3}, int(rnd.integers(0, 60))))
    alone = [S.best_plan(own, bank, dict(pool), 1, 4, 25) for own, bank in managers]
    assert [S.best_plan(own, bank, pool, 1, 4, 25) for own, bank in managers[::-1]] == alone[::-1]
