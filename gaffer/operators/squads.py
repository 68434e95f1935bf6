"""Squad decisions close to the optimum: joint transfers (DEC-11), squad construction
(DEC-14), Free Hit by its eleven (DEC-18) and the Wildcard by a budget curve (DEC-19).

Spark prunes the pool, gathers each manager's at most few dozen rows and deals out
managers, periods and budgets; one task then searches one of them with numpy
(:mod:`gaffer.operators.squadsearch`). The pruned pool (:func:`candidates`) is all that is
broadcast: at most ``KEPT`` players per position and price level, whatever the pool's size.
"""
from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaffer.functions.scalars import sell_value_tenths
from gaffer.operators.decisions import HIT, best_lineup, transfer_upper_bound
from gaffer.operators.joins import bounded
from gaffer.operators.squadsearch import LOW, Places, Players, search, swaps, value_of
from gaffer.sources.landing import materialized
from gaffer.sources.seed import MAX_PER_CLUB, SQUAD_RULES, SQUAD_SIZE, formation_shapes

QUOTAS = {position: quota for position, quota, _, _ in SQUAD_RULES}
MAX_QUOTA = max(QUOTAS.values())
# A squad takes at most MAX_PER_CLUB of a club and a manager owns at most MAX_QUOTA of a position, so a
# club's DEPTH best within a price hold every one that may be wanted of it ...
DEPTH = MAX_PER_CLUB + MAX_QUOTA
# ... and with at most SQUAD_SIZE // MAX_PER_CLUB clubs full, so do a price's KEPT best of those.
KEPT = SQUAD_SIZE // MAX_PER_CLUB * DEPTH + 2 * MAX_QUOTA
UNCAPPED = SQUAD_SIZE


def candidates(pool: DataFrame, keys: Sequence[str] = (), score: str = "score", code: str = "player_code",
               position: str = "position_id", club: str = "team_code", price_t: str = "price_tenths") -> DataFrame:
    """DEC-15 for any decision: the players that a best squad, or a best set of buys for
    any squad, may need. For each price level the ``KEPT`` best of the clubs' ``DEPTH`` best
    within it; any other player can be exchanged for a better one that is no dearer. Hot
    clubs are cut by (club, price) before anything is spread over levels."""
    keys = list(keys)
    order = [F.col(score).desc(), F.col(code).asc()]
    rows = pool.where(F.col(price_t).isNotNull() & F.col(score).isNotNull()) \
        .select(*keys, code, position, club, F.col(price_t).cast("int").alias(price_t), F.col(score).cast("double").alias(score))

    def best(df, by, n):
        return df.withColumn("__r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))) \
            .where(F.col("__r") <= n).drop("__r")
    few = best(rows, [*keys, position, club, price_t], DEPTH)
    levels = rows.select(F.col(price_t).alias("level")).distinct().agg(F.sort_array(F.collect_list("level")).alias("__levels"))
    spread = few.crossJoin(bounded(levels)).withColumn(
        "level", F.explode(F.filter("__levels", lambda x: x >= F.col(price_t)))).drop("__levels")
    kept = best(best(spread, [*keys, position, club, "level"], DEPTH), [*keys, position, "level"], KEPT)
    return kept.drop("level").distinct()


class Pool:
    """The candidates as arrays, one set per key, in order of code."""

    def __init__(self, rows: DataFrame, keys: Sequence[str] = (), code: str = "player_code", position: str = "position_id",
                 club: str = "team_code", price_t: str = "price_tenths", score: str = "score"):
        self.sets: dict[tuple, dict[str, np.ndarray]] = {}
        grouped: dict[tuple, list] = {}
        for r in rows.select(*keys, code, position, club, price_t, score).collect():
            grouped.setdefault(tuple(r[:len(keys)]), []).append(tuple(r[len(keys):]))
        for key, players in grouped.items():
            players.sort()
            codes, positions, clubs, prices, scores = zip(*players)
            self.sets[key] = {"code": np.array(codes), "position": np.array(positions), "club": np.array(
                [-1 if c is None else c for c in clubs]), "price": np.array(prices), "score": np.array(scores)}


def numbered(clubs: np.ndarray, owned: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(clubs numbered from 0, cap of each); an unknown club has no cap, and one of which a
    manager owns more than the cap may keep as many."""
    names, index = np.unique(clubs, return_inverse=True)
    caps = np.full(len(names), MAX_PER_CLUB)
    if owned is not None:
        caps = np.maximum(caps, np.bincount(index[owned], minlength=len(names)))
    caps[names == -1] = UNCAPPED
    return index, caps


def dealt(rows: DataFrame, entity: str) -> DataFrame:
    """Searches are long and rows are few: spread them over all tasks. By a hash of its own, as rows that are
    grouped by the entity already would stay in the few tasks that their bytes ask for."""
    return rows.repartition(max(1, rows.sparkSession.sparkContext.defaultParallelism * 4), F.xxhash64(entity))


# ------------------------------------------------------------------ transfers
def best_moves(own: dict, bank: int, pool: dict, free: int, hit: float):
    """The exact best of no, one or two moves: (net, [(out, in), ...]) as indexes of own
    and pool. A club in which a player is bought has at most MAX_PER_CLUB afterwards. Ties go to
    fewer moves, then to the least codes sold, then bought."""
    unowned = ~np.isin(pool["code"], own["code"])
    shelf = shelves(pool)
    clubs, have, club_of, counts = _clubs(own, pool)
    best, moves = 0.0, []
    sellable = np.array([o for o in np.argsort(own["code"], kind="stable") if own["sell"][o] >= 0 and own["position"][o] in QUOTAS], int)
    if not len(sellable):
        return best, moves
    sell, score = own["sell"][sellable], own["score"][sellable]

    def buys(o, budget, left):
        i = shelf.by_position[own["position"][o]]
        return i[unowned[i] & (pool["price"][i] <= budget) & (left[club_of[i]] < MAX_PER_CLUB)]

    goods = shelf.index[own["position"][sellable] - 1]  # a row per player sold, the best buys first
    open_ = shelf.real[own["position"][sellable] - 1] & unowned[goods]
    first, any_ = _first_legal(pool["price"][goods], club_of[goods], open_, bank + sell, counts, have[sellable])
    if any_.any():
        charge = hit * max(0, 1 - free)
        gains = np.where(any_, np.round(pool["score"][goods[np.arange(len(sellable)), first]] - score - charge, 9), LOW)
        if gains.max() > best:
            o = int(sellable[gains.argmax()])
            left = counts.copy()
            left[have[o]] -= 1
            i = buys(o, bank + own["sell"][o], left)
            gain = np.round(pool["score"][i] - own["score"][o] - charge, 9)
            best, moves = float(gain.max()), [(o, int(i[gain.argmax()]))]
    # for every pair sold a bound of the gain: each place takes the best that the other's cheapest leaves money for
    charge = hit * max(0, 2 - free)
    budgets = bank + sell[:, None] + sell[None]
    tops = np.full(budgets.shape, LOW)
    positions = own["position"][sellable]
    cheapest = {q: int(pool["price"][i].min()) if len(i) else None for q in QUOTAS for i in [shelf.by_price[q][unowned[shelf.by_price[q]]]]}
    rest = np.array([np.nan if cheapest[q] is None else cheapest[q] for q in positions])
    for q in np.unique(positions):
        i = shelf.by_price[q][unowned[shelf.by_price[q]]]
        if not len(i):
            continue
        mine = np.flatnonzero(positions == q)
        so_far = np.concatenate([[LOW], np.maximum.accumulate(pool["score"][i])])
        money = np.where(np.isnan(rest), -np.inf, budgets[mine] - rest)
        tops[mine] = so_far[np.searchsorted(pool["price"][i], money, "right")]
    x, y = np.triu_indices(len(sellable), 1)
    bounds = -score[x] - score[y] - charge + tops[x, y] + tops[y, x]
    ties = []
    for k in np.argsort(-bounds, kind="stable"):
        if bounds[k] < best - 1e-6:
            break
        a, b = int(sellable[x[k]]), int(sellable[y[k]])
        budget = int(budgets[x[k], y[k]])
        left = counts.copy()
        left[have[a]] -= 1
        left[have[b]] -= 1
        i, j = buys(a, budget, left), buys(b, budget, left)
        if not len(i) or not len(j):
            continue
        # those that are too poor even with the best of the others can't reach what is known
        need = best + own["score"][a] + own["score"][b] + charge - 1e-6
        i, j = i[pool["score"][i] + pool["score"][j].max() >= need], j[pool["score"][j] + pool["score"][i].max() >= need]
        if not len(i) or not len(j):
            continue
        gain = np.round(pool["score"][i][:, None] + pool["score"][j][None] - own["score"][a] - own["score"][b] - charge, 9)
        same_club = club_of[i][:, None] == club_of[j][None]
        legal = pool["price"][i][:, None] + pool["price"][j][None] <= budget
        legal &= i[:, None] != j[None]
        legal &= ~(same_club & (left[club_of[i]][:, None] + 2 > MAX_PER_CLUB))
        gain[~legal] = LOW
        top = float(gain.max())
        if top > best or (ties and top == best):
            k_, m = np.unravel_index(int(gain.argmax()), gain.shape)
            found = [(a, int(i[k_])), (b, int(j[m]))]
            ties = [found] if top > best else [*ties, found]
            best = top
    if ties:
        moves = min(ties, key=lambda f: ([own["code"][o] for o, _ in f], [pool["code"][i] for _, i in f]))
    return best, moves


class Shelves:
    """What the moves of all managers read off one pool: per position its indexes by price, and those of
    all positions in rows of one width, best score first, ties by index (``real`` where a row has a player)."""

    def __init__(self, pool: dict):
        self.by_position = {q: np.flatnonzero(pool["position"] == q) for q in QUOTAS}
        self.by_price = {q: i[np.argsort(pool["price"][i], kind="stable")] for q, i in self.by_position.items()}
        self.index = np.zeros((max(QUOTAS), max([1, *map(len, self.by_position.values())])), int)
        self.real = np.zeros(self.index.shape, bool)
        for q, i in self.by_position.items():
            self.index[q - 1, :len(i)] = i[np.argsort(-pool["score"][i], kind="stable")]
            self.real[q - 1, :len(i)] = True


def shelves(pool: dict) -> Shelves:
    """The pool's shelves, made once for all managers of a task."""
    if "shelves" not in pool:
        pool["shelves"] = Shelves(pool)
    return pool["shelves"]


def _clubs(own: dict, pool: dict):
    """(clubs, number of each own player's, of each pool player's, own players by club); an unknown club never fills."""
    clubs = np.unique(np.concatenate([own["club"], pool["club"]]))
    have = np.searchsorted(clubs, own["club"])
    counts = np.bincount(have, minlength=len(clubs))
    counts[clubs == -1] = -UNCAPPED
    return clubs, have, np.searchsorted(clubs, pool["club"]), counts


def _first_legal(price, club, open_, money, counts, sold):
    """(first, found): of each row of goods the first that is open, within its money and whose club has room
    after the row's own player of club ``sold`` has left."""
    legal = (counts < MAX_PER_CLUB)[club]
    full = np.flatnonzero(counts[sold] == MAX_PER_CLUB)
    legal[full] |= club[full] == sold[full, None]
    legal &= open_ & (price <= money[:, None])
    first = legal.argmax(1)
    return first, legal[np.arange(len(first)), first]


def greedy_moves(own: dict, bank: int, pool: dict, free: int, hit: float):
    """Single best swaps one after the other while they gain, the best prefix of them:
    (net, codes of the squad). A start for :func:`search`."""
    code, sell, score = own["code"].copy(), own["sell"].copy(), own["score"].copy()
    _, club, club_of, counts = _clubs(own, pool)
    taken = np.isin(pool["code"], code)
    mine = np.flatnonzero(np.isin(own["position"], list(QUOTAS)))
    first_codes = own["code"].tolist()
    best, squad, gross = 0.0, first_codes, 0.0
    if not len(pool["code"]) or not len(mine):
        return best, squad
    shelf = shelves(pool)
    goods, real = shelf.index[own["position"][mine] - 1], shelf.real[own["position"][mine] - 1]
    price, clubs, rows = pool["price"][goods], club_of[goods], np.arange(len(mine))
    worth = pool["score"][goods]
    for _ in range(SQUAD_SIZE):
        first, found = _first_legal(price, clubs, real & ~taken[goods], bank + sell[mine], counts, club[mine])
        gains = np.where(found & (sell[mine] >= 0), worth[rows, first] - score[mine], LOW)
        k = int(gains.argmax())
        gain, o, i = float(gains[k]), int(mine[k]), int(goods[k, first[k]])
        if not gain > 1e-9:
            break
        bank += int(sell[o]) - int(pool["price"][i])
        taken |= pool["code"] == pool["code"][i]
        taken &= pool["code"] != code[o]
        counts[club[o]] -= 1
        counts[club_of[i]] += 1
        code[o], sell[o], club[o], score[o] = pool["code"][i], pool["price"][i], club_of[i], pool["score"][i]
        gross += gain
        held = code.tolist()
        now = set(held)
        net = gross - hit * max(0, sum(c not in now for c in first_codes) - free)
        if net > best + 1e-9:
            best, squad = net, held
    return best, squad


def best_plan(own: dict, bank: int, pool: dict, free: int, hit: float, steps: int):
    """(net, outs, ins, upper bound of the net) of a plan of any number of moves: the best
    of the exact two, of the greedy moves and of the search over whole squads."""
    net, moves = best_moves(own, bank, pool, free, hit)
    outs, ins = [int(own["code"][o]) for o, _ in moves], [int(pool["code"][i]) for _, i in moves]
    greedy, squad = greedy_moves(own, bank, pool, free, hit)
    if greedy > net + 1e-9:
        net, outs, ins = greedy, sorted(set(own["code"].tolist()) - set(squad)), sorted(set(squad) - set(own["code"].tolist()))
    fixed = (own["sell"] < 0) | ~np.isin(own["position"], list(QUOTAS))  # not in the pool: stays owned
    held = np.flatnonzero(~fixed)
    new = np.flatnonzero(~np.isin(pool["code"], own["code"]))
    n, total = len(held), float(own["score"][held].sum())
    club, caps = numbered(np.concatenate([own["club"][held], pool["club"][new], own["club"][fixed]]),
                          np.array([*range(n), *range(n + len(new), n + len(new) + int(fixed.sum()))], int))
    caps = caps - np.bincount(club[n + len(new):], minlength=len(caps))
    quotas = {q: int((own["position"][held] == q).sum()) for q in QUOTAS}
    players = Players(np.concatenate([own["position"][held], pool["position"][new]]), club[:n + len(new)],
                      np.concatenate([own["sell"][held], pool["price"][new]]).astype(int),
                      np.concatenate([own["score"][held], pool["score"][new] - hit]),
                      np.arange(n + len(new)) >= n)
    most = min(free, n)
    places = Places({q: k for q, k in quotas.items() if k}, {}, most, hit)
    budget = int(bank + own["sell"][held].sum())
    if not places.scored or budget < 0:
        return net, outs, ins, net
    start = total + net
    found = search(players, places, budget, caps, steps, start=(start, []), curve=False)
    # a club that holds too many already may keep them, not buy: check what was found
    if found.squad and found.value > start + 1e-9:
        chosen = np.array(found.squad)
        count = np.bincount(players.club[chosen], minlength=len(caps)) + np.bincount(club[n + len(new):], minlength=len(caps))
        bought = chosen[chosen >= n]
        named = np.concatenate([own["club"][held], pool["club"][new]])
        if all(named[i] == -1 or count[players.club[i]] <= MAX_PER_CLUB for i in bought):
            net = found.value - total
            outs = sorted(int(own["code"][held[k]]) for k in set(range(n)) - set(chosen.tolist()))
            ins = sorted(int(pool["code"][new[i - n]]) for i in bought)
    return net, outs, ins, max(net, float(found.upper[budget]) - total)


OWN = {"code": np.int64, "position": np.int64, "club": np.int64, "score": np.float64, "sell": np.int64}


def _own_arrays(rows: list[dict]) -> dict[str, np.ndarray]:
    return {k: np.array([r[k] for r in rows], t) for k, t in OWN.items()}


def manager_rows(squads: DataFrame, pool: DataFrame, bank_t: DataFrame, entity: str = "entry_id", score: str = "score",
                 code: str = "player_code", position: str = "position_id", club: str = "team_code",
                 price_t: str = "price_tenths") -> DataFrame:
    """entity, bank, own: a manager's bank and at most few dozen owned players with their
    sell values; a player that the pool or a price does not have can't be sold (sell -1, D2)."""
    known = pool.select(code, F.col(position).alias("__q"), F.col(club).alias("__c"), F.col(score).alias("__s"),
                        F.col(price_t).alias("__p"))
    own = squads.where(F.col(code).isNotNull()).select(entity, code, "purchase_tenths").join(known, code, "left")
    sell = F.coalesce(sell_value_tenths(F.col("__p"), F.col("purchase_tenths")), F.lit(-1)).cast("long")
    mine = F.struct(F.col(code).cast("long").alias("code"), F.coalesce("__q", F.lit(0)).cast("long").alias("position"),
                    F.coalesce("__c", F.lit(-1)).cast("long").alias("club"), F.coalesce("__s", F.lit(0.0)).cast("double").alias("score"),
                    F.when(F.col("__s").isNull(), F.lit(-1)).otherwise(sell).cast("long").alias("sell"))
    return own.groupBy(entity).agg(F.sort_array(F.collect_list(mine)).alias("own")).join(bank_t.where(
        F.col("bank_tenths").isNotNull()), entity).select(
            F.col(entity), F.col("bank_tenths").cast("long").alias("bank"), "own")


def swap_rounds(squads: DataFrame, pool: DataFrame, bank_t: DataFrame, ladder: DataFrame, rounds: int,
                entity: str = "entry_id", code: str = "player_code", price_t: str = "price_tenths", score: str = "score",
                position: str = "position_id") -> DataFrame:
    """entity, step, out_code, in_code, gain: every manager's best single swaps one after the other
    (:func:`~gaffer.operators.squadsearch.swaps`). The players of ``ladder`` are all that can be a best buy; their number is
    bounded by positions, clubs and prices, and they are all that is broadcast."""
    players = ladder.where(F.col(score).isNotNull()).select(code, position, "team_code", price_t, score).distinct()
    none = {k: np.zeros(0, t) for k, t in (("code", np.int64), ("position", np.int64), ("club", np.int64),
                                           ("price", np.int64), ("score", np.float64))}
    shared = squads.sparkSession.sparkContext.broadcast(Pool(players, (), code, position, "team_code", price_t, score).sets.get((), none))

    def run(batches):
        for b in batches:
            out = [(entry, step, *swap) for entry, money, own in zip(*(c.to_pylist() for c in b.columns))
                   for step, swap in enumerate(swaps(_own_arrays(own), money, shared.value, MAX_PER_CLUB, rounds), 1)]
            cols = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(
                cols, (b.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.float64()))],
                names=[entity, "step", "out_code", "in_code", "gain"])
    managers = manager_rows(squads, pool, bank_t, entity, score, code, position, "team_code", price_t)
    kind = managers.schema[entity].dataType.simpleString()
    return dealt(managers, entity).mapInArrow(run, f"{entity} {kind}, step int, out_code long, in_code long, gain double")


def transfers(squads: DataFrame, pool: DataFrame, bank_t: DataFrame, free_transfers: int = 1, hit: float = HIT,
              entity: str = "entry_id", most_moves: int = SQUAD_SIZE, steps: int = 25,
              pruned: DataFrame | None = None) -> DataFrame:
    """DEC-11 / DEC-13: the best transfers of every manager, moves that pay for each other
    included. Exact for at most two moves (``most_moves=2`` stops there); beyond, a plan
    that is never worse than that nor than greedy swaps. Both with an upper bound of any plan (for two moves
    :func:`~gaffer.operators.decisions.transfer_upper_bound`) and the gap. ``net_gain`` = points won - ``hit`` for each move beyond the free ones.

    Defined: no legal gaining move, an empty pool or a squad that is in debt give no
    transfer; nulls in bank leave the manager out; ties go to fewer moves, then lesser codes."""
    spark = squads.sparkSession
    rows = pruned if pruned is not None else materialized(candidates(pool), "candidates")
    shared = spark.sparkContext.broadcast(Pool(rows).sets.get((), {k: np.zeros(0, t) for k, t in (
        ("code", np.int64), ("position", np.int64), ("club", np.int64), ("price", np.int64), ("score", np.float64))}))

    def run(batches):
        pool_ = shared.value
        for b in batches:
            out = []
            for entry, money, rows_ in zip(*(c.to_pylist() for c in b.columns)):
                own = _own_arrays(rows_)
                if most_moves <= 2:
                    net, moves = best_moves(own, money, pool_, free_transfers, hit)
                    outs = [int(own["code"][o]) for o, _ in moves]
                    ins, upper = [int(pool_["code"][i]) for _, i in moves], None
                else:
                    net, outs, ins, upper = best_plan(own, money, pool_, free_transfers, hit, steps)
                cost = float(hit * max(0, len(outs) - free_transfers))
                out.append((entry, len(outs), sorted(outs), sorted(ins), net + cost, cost, net, upper))
            cols = list(zip(*out)) or [[]] * 8
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names=names)

    names = [entity, "n_transfers", "outs", "ins", "gross_gain", "hit_cost", "net_gain", "upper_net_gain"]
    managers = manager_rows(squads, pool, bank_t, entity)
    kind = managers.schema[entity].dataType
    types = [pa.int64() if kind.simpleString() == "bigint" else pa.int32() if kind.simpleString() == "int" else pa.string(),
             pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), *[pa.float64()] * 4]
    schema = f"{entity} {kind.simpleString()}, n_transfers int, outs array<long>, ins array<long>, gross_gain double, " \
             "hit_cost double, net_gain double, upper_net_gain double"
    found = dealt(managers, entity).mapInArrow(run, schema)
    out = found.select(entity, "n_transfers", F.array_join(F.col("outs").cast("array<string>"), ",").alias("out_codes"),
                       F.array_join(F.col("ins").cast("array<string>"), ",").alias("in_codes"),
                       "gross_gain", "hit_cost", "net_gain", "upper_net_gain")
    if most_moves <= 2:
        upper = transfer_upper_bound(squads, pool, free_transfers, hit, entity)
        out = out.drop("upper_net_gain").join(upper, entity, "left") \
            .withColumn("upper_net_gain", F.coalesce("upper_net_gain", F.lit(0.0)))
    return out.withColumn("gap", F.col("upper_net_gain") - F.col("net_gain"))


# ------------------------------------------------------------------ whole squads
CURVE = "kind string, budget_tenths int, value double, codes array<long>"


def budget_curve(pool: DataFrame, budgets: Sequence[int], steps: int = 30, pruned: DataFrame | None = None) -> DataFrame:
    """budget_tenths, lower_value, upper_value, codes: the value of the best legal squad as
    a function of the budget, one row per tenth up to the greatest of ``budgets`` at which a squad
    can be had. One task searches per budget given; each search bounds every budget at once,
    so between two of them the bounds still hold, only less tight. ``codes`` is the squad of
    the lower bound."""
    spark = pool.sparkSession
    rows = pruned if pruned is not None else materialized(candidates(pool), "candidates")
    shared = spark.sparkContext.broadcast(Pool(rows).sets.get((), None))
    places = Places(dict(QUOTAS))

    def run(batches):
        data = shared.value
        for b in batches:
            for budget in b.column(0).to_pylist():
                if data is None:
                    continue
                club, caps = numbered(data["club"])
                players = Players(data["position"], club, data["price"], data["score"], np.zeros(len(club), bool))
                found = search(players, places, budget, caps, steps)
                rows_ = [("upper", k, float(v), None) for k, v in enumerate(found.upper) if LOW / 2 < v < np.inf]
                if found.squad:
                    rows_.append(("lower", int(players.cost[found.squad].sum()), found.value,
                                  sorted(int(data["code"][i]) for i in found.squad)))
                rows_ += [("lower", cost, value, None) for cost, value in found.legal]
                cols = list(zip(*rows_)) or [[]] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.float64(), pa.list_(pa.int64())))],
                    names=["kind", "budget_tenths", "value", "codes"])
    wanted = sorted({int(x) for x in budgets})
    asked = spark.createDataFrame([(x,) for x in wanted], "budget int").repartition(max(1, min(len(wanted), 64)), "budget")
    found = materialized(asked.mapInArrow(run, CURVE), "curve")
    upper = found.where("kind = 'upper'").groupBy("budget_tenths").agg(F.min("value").alias("upper_value"))
    # the best squad of every cost, then the best of all costs within the budget: rows are at most the tenths of the budget
    lower = found.where("kind = 'lower'").groupBy("budget_tenths").agg(F.max(F.struct("value", "codes")).alias("best"))
    so_far = Window.orderBy("budget_tenths").rowsBetween(Window.unboundedPreceding, 0)
    return upper.join(lower, "budget_tenths", "left").withColumn("best", F.max("best").over(so_far)).select(
        "budget_tenths", F.col("best.value").alias("lower_value"), "upper_value", F.col("best.codes").alias("codes"))


def best_squad(pool: DataFrame, budget_tenths: int, steps: int = 200, pruned: DataFrame | None = None) -> DataFrame:
    """DEC-14: one row: budget, lower_value, upper_bound, gap, squad_cost, codes, feasible."""
    found = budget_curve(pool, [budget_tenths], steps, pruned).where(F.col("budget_tenths") == budget_tenths)
    cost = pool.select("player_code", "price_tenths", "score")
    members = found.select(F.explode("codes").alias("player_code")).join(cost, "player_code") \
        .agg(F.sum("price_tenths").alias("cost"))
    empty = pool.sparkSession.range(1).select(F.lit(budget_tenths / 10.0).alias("budget"))
    return empty.join(found, how="left").join(members, how="left").select(
        "budget", "lower_value", F.col("upper_value").alias("upper_bound"),
        (F.col("upper_value") - F.col("lower_value")).alias("gap"), (F.col("cost") / 10.0).alias("squad_cost"),
        F.array_join(F.col("codes").cast("array<string>"), ",").alias("codes"), F.col("lower_value").isNotNull().alias("feasible"))


def best_elevens(period_pool: DataFrame, budget_tenths: int = 1000, period: str = "gameweek_id",
                 score: str = "expected_points", steps: int = 40, pruned: DataFrame | None = None) -> DataFrame:
    """DEC-18 per period: free_hit_xi, the best eleven of any legal fifteen (the bench
    scores nothing, so it is the cheapest that leaves the eleven its money), its upper bound, the codes of that
    squad, and best_fifteen, the fifteen of the greatest total, whose eleven the reference takes.
    One task searches per period and formation, and one per period for the fifteen."""
    spark = period_pool.sparkSession
    rows = pruned if pruned is not None else materialized(candidates(period_pool, [period], score=score), "week-candidates")
    shared = spark.sparkContext.broadcast(Pool(rows, [period], score=score).sets)
    shapes = [None, *formation_shapes()]

    def run(batches):
        sets = shared.value
        for b in batches:
            out = []
            for week, shape in zip(*(c.to_pylist() for c in b.columns)):
                data = sets[(week,)]
                club, caps = numbered(data["club"])
                players = Players(data["position"], club, data["price"], data["score"], np.zeros(len(club), bool))
                starters = dict(zip(QUOTAS, (1, *shapes[shape]))) if shape else dict(QUOTAS)
                places = Places(starters, {q: QUOTAS[q] - n for q, n in starters.items()} if shape else {})
                found = search(players, places, budget_tenths, caps, steps)
                value = found.value if found.squad else None
                out.append((week, shape, value, float(found.upper[budget_tenths]),
                            sorted(int(data["code"][i]) for i in found.squad)))
            cols = list(zip(*out)) or [[]] * 5
            types = (pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)],
                                             names=[period, "shape", "value", "upper", "codes"])
    weeks = rows.select(F.col(period).cast("int").alias(period)).distinct()
    jobs = weeks.crossJoin(bounded(spark.createDataFrame([(k,) for k in range(len(shapes))], "shape int")))
    found = materialized(jobs.repartition(64, period, "shape").mapInArrow(
        run, f"{period} int, shape int, value double, upper double, codes array<long>"), "elevens")
    xi = found.where("shape > 0").groupBy(period).agg(F.max(F.struct(F.round("value", 9).alias("r"), -F.col("shape"), "value", "codes")).alias("best"),
                                                       F.max("upper").alias("upper_xi"))
    whole = found.where("shape = 0").select(period, F.col("codes").alias("best_fifteen"))
    return xi.join(whole, period, "left").select(
        period, F.col("best.value").alias("free_hit_xi"), "upper_xi", F.col("best.codes").alias("codes"), "best_fifteen")


def free_hit_by_eleven(own_lineup: DataFrame, period_pool: DataFrame, budget_tenths: int = 1000, entity: str = "entry_id",
                       period: str = "gameweek_id", score: str = "expected_points", steps: int = 40,
                       pruned: DataFrame | None = None) -> DataFrame:
    """DEC-18 for every (manager, period): own_xi, free_hit_xi and its value by the best
    eleven, its upper bound, and reference_xi and reference_value by the eleven of the best fifteen."""
    weeks = best_elevens(period_pool, budget_tenths, period, score, steps, pruned)
    pool = period_pool.select(period, "player_code", "position_id", score)
    fifteen = weeks.select(F.lit(0).alias("__e"), period, F.explode("best_fifteen").alias("player_code")) \
        .join(pool, [period, "player_code"])
    eleven = best_lineup(fifteen, ["__e", period], score).groupBy(period).agg(F.max("xi_points").alias("reference_xi"))
    both = weeks.join(eleven, period, "left").select(
        period, F.greatest("free_hit_xi", "reference_xi").alias("free_hit_xi"), "upper_xi", "reference_xi")
    own = own_lineup.groupBy(entity, period).agg(F.max("xi_points").alias("own_xi"))
    return own.join(both, period, "left").select(
        entity, period, "own_xi", "free_hit_xi", (F.col("free_hit_xi") - F.col("own_xi")).alias("free_hit_value"),
        (F.col("upper_xi") - F.col("own_xi")).alias("upper_value"), "reference_xi",
        (F.col("reference_xi") - F.col("own_xi")).alias("reference_value"))


def wildcard_interval(squads: DataFrame, pool: DataFrame, bank_t: DataFrame, plan: DataFrame, free_transfers: int = 1,
                      hit: float = HIT, entity: str = "entry_id", step_tenths: int = 5, steps: int = 30,
                      threshold: float = 4.0, pruned: DataFrame | None = None) -> DataFrame:
    """DEC-19: an interval of every manager's Wildcard gain, unlimited transfers against the
    ordinary plan ``plan`` (of :func:`transfers`), from one budget curve for all.

    The budget is the bank plus all sell values. The curve has market prices; a player kept
    costs the sell value only, so the curve's upper bound is read at the budget plus what the
    manager would save on all own players. The lower end is the curve at the budget or the
    squad after the ordinary plan, whose moves a Wildcard may make. The curve is searched at every
    ``step_tenths``-th tenth between the least and greatest budget of all managers."""
    known = pool.select("player_code", "price_tenths", "score")
    own = squads.select(entity, "player_code", "purchase_tenths").join(known, "player_code") \
        .withColumn("sell", sell_value_tenths(F.col("price_tenths"), F.col("purchase_tenths")))
    wealth = own.groupBy(entity).agg(F.sum("score").alias("squad_value"), F.sum("sell").alias("sold"),
                                     F.sum(F.col("price_tenths") - F.col("sell")).alias("saved")).join(bank_t, entity) \
        .select(entity, "squad_value", (F.col("bank_tenths") + F.col("sold")).cast("int").alias("budget_tenths"),
                F.greatest("saved", F.lit(0)).cast("int").alias("saved"))
    wealth = materialized(wealth, "wealth")
    low, high = wealth.agg(F.min("budget_tenths"), F.max(F.col("budget_tenths") + F.col("saved"))).first()
    rows = pruned if pruned is not None else materialized(candidates(pool), "candidates")
    # beyond the dearest squad more money buys nothing more
    dearest = rows.agg(F.coalesce(F.max("price_tenths"), F.lit(0))).first()[0] * SQUAD_SIZE
    top = max(0, min(high or 0, dearest))
    budgets = [*range(max(0, min(low or 0, top)), top, step_tenths), top]
    curve = materialized(budget_curve(pool, budgets, steps, rows), "wildcard-curve")
    at = curve.select(F.col("budget_tenths").alias("__b"), "lower_value", F.col("upper_value"))
    lower = at.select(F.col("__b").alias("__l"), "lower_value")
    upper = at.select(F.col("__b").alias("__u"), "upper_value")
    known = wealth.withColumn("__l", F.least("budget_tenths", F.lit(top))) \
        .withColumn("__u", F.least(F.col("budget_tenths") + F.col("saved"), F.lit(top))) \
        .join(bounded(lower), "__l", "left").join(bounded(upper), "__u", "left") \
        .join(plan.select(entity, "net_gain", "gross_gain", "upper_net_gain"), entity, "left")
    most = float(hit * max(0, SQUAD_SIZE - free_transfers))
    out = known.withColumn("ordinary_lower", F.col("squad_value") + F.col("net_gain")) \
        .withColumn("lower_value", F.greatest("lower_value", F.col("squad_value") + F.col("gross_gain"))) \
        .withColumn("upper_value", F.greatest("upper_value", "lower_value")) \
        .withColumn("ordinary_upper", F.least(F.col("squad_value") + F.col("upper_net_gain"), F.col("upper_value")))
    lo = F.least(F.greatest(F.col("lower_value") - F.col("ordinary_upper"), F.lit(0.0)), F.lit(most))
    hi = F.least(F.greatest(F.col("upper_value") - F.col("ordinary_lower"), F.lit(0.0)), F.lit(most))
    return out.select(entity, "ordinary_lower", "ordinary_upper", "lower_value", "upper_value",
                      lo.alias("gain_lower"), hi.alias("gain_upper"),
                      F.when(lo >= threshold, "play").when(hi < threshold, "hold").otherwise("uncertain").alias("verdict"))
