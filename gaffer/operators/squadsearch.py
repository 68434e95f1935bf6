"""One squad problem: fill positions within a budget, at most ``cap`` players a club.

The search behind the squad decisions of :mod:`gaffer.operators.squads`, for one key
in one task. Players come as arrays pruned to a size that the squad rules bound.

* :func:`fill` is an exact max-plus dynamic program over the budget in tenths. It fills
  position after position, so its last row is the best value for every budget at once. A
  position has scored places and, if wanted, unscored ones (a bench); a player may be marked
  as bought, the first ``free`` of which earn ``bonus`` each (free transfers).
* :func:`search` puts a multiplier on every club and adjusts them by subgradient steps:
  every step gives an upper bound, and its squad, mended where a club is over the cap, a
  lower one. Both bounds are valid whenever the steps stop.
* :func:`best_at` is :func:`fill` for one budget, when only squads better than a known one
  matter: a price weight bounds every squad with, and without, a player, so most players are
  out or in before the program runs. :func:`search` with ``curve=False`` uses it.
"""
from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

LOW = -1e15


@dataclass
class Players:
    """Arrays with one entry per player; ``club`` numbers clubs from 0."""
    position: np.ndarray
    club: np.ndarray
    cost: np.ndarray
    value: np.ndarray
    bought: np.ndarray

    def take(self, index):
        return Players(*(x[index] for x in (self.position, self.club, self.cost, self.value, self.bought)))


@dataclass
class Places:
    """Scored and unscored places per position, and what bought players earn."""
    scored: dict[int, int]
    unscored: dict[int, int] = field(default_factory=dict)
    free: int = 0
    bonus: float = 0.0

    def of(self, position):
        return self.scored[position], self.unscored.get(position, 0)


def undominated(p: Players, fine: np.ndarray, places: Places) -> np.ndarray:
    """Players that some best squad may need when ``fine`` is charged for each: fewer
    players of the position, equally bought, than it has places are no dearer, better and no more fined."""
    keep = []
    for position in places.scored:
        index = np.flatnonzero(p.position == position)
        cost, value, charge, bought = p.cost[index], (p.value - fine)[index], fine[index], p.bought[index]
        no_worse = (cost[None] <= cost[:, None]) & (value[None] >= value[:, None]) & (bought[None] == bought[:, None])
        if places.unscored:
            no_worse &= charge[None] <= charge[:, None]
        equal = no_worse & no_worse.T
        first = np.arange(len(index))
        beaten = no_worse & (~equal | (first[None] < first[:, None]))
        keep.append(index[beaten.sum(1) < sum(places.of(position))])
    return np.concatenate(keep) if keep else np.zeros(0, int)


def fill(p: Players, fine: np.ndarray, places: Places, budget: int):
    """(best value by budget 0..budget less the fines, function budget -> player indexes)."""
    index = undominated(p, fine, places)
    width = budget + 1
    best = np.full((places.free + 1, width), LOW)
    best[0] = 0.0
    stages = []
    for position in places.scored:
        scored, unscored = places.of(position)
        table = np.full((places.free + 1, scored + 1, unscored + 1, width), LOW)
        table[:, 0, 0] = best
        for i in index[p.position[index] == position]:
            cost = int(p.cost[i])
            if cost > budget:
                continue
            old = table.copy()
            stages.append((i, old))
            before = old[..., :width - cost]
            if p.bought[i] and places.free:
                before = np.concatenate([np.full_like(before[:1], LOW), before[:-1]])
                before[-1] = np.maximum(before[-1], old[-1, ..., :width - cost])
            if scored:
                np.maximum(table[:, 1:, :, cost:], before[:, :-1] + (p.value[i] - fine[i]), out=table[:, 1:, :, cost:])
            if unscored:
                np.maximum(table[:, :, 1:, cost:], before[:, :, :-1] - fine[i], out=table[:, :, 1:, cost:])
        stages.append((None, (scored, unscored)))
        best = table[:, scored, unscored].copy()
    bonus = places.bonus * np.arange(places.free + 1)[:, None]
    total = (best + bonus).max(0)

    def squad(b: int) -> list[int]:
        t = int((best[:, b] + bonus[:, 0]).argmax())
        value, chosen = best[t, b], []
        k = u = 0
        for i, old in reversed(stages):
            if i is None:
                k, u = old
                continue
            if old[t, k, u, b] == value:
                continue
            cost, from_t = int(p.cost[i]), [t]
            if p.bought[i] and places.free:
                from_t = [t - 1, t] if t == places.free else [t - 1]
            ways = [(s, k - 1, u, p.value[i] - fine[i]) for s in from_t if k] + [(s, k, u - 1, -fine[i]) for s in from_t if u]
            t, k, u, gain = next(w for w in ways if w[0] >= 0 and old[w[0], w[1], w[2], b - cost] + w[3] == value)
            b, value = b - cost, old[t, k, u, b - cost]
            chosen.append(int(i))
        return chosen[::-1]
    return total, squad


def best_at(p: Players, worth: np.ndarray, places: Places, budget: int, need: float):
    """(value, player indexes) of the best squad of ``worth`` (values less fines) within the
    budget, as :func:`fill` finds it, if it reaches ``need``; else (LOW, []). Scored places only.

    With a weight on the price, the best of every position gives ``bound`` for any squad. One with
    a player below the best, or without one of the best, is worse by their difference at least: if that
    takes it below ``need``, the player is left out, or in."""
    groups = []
    for position, k in places.scored.items():
        index = np.flatnonzero(p.position == position)
        if len(index) < k:
            return LOW, []
        groups.append((position, k, index, worth[index], p.cost[index].astype(float)))
    most = places.bonus * places.free
    best = np.concatenate([i[np.argsort(-w, kind="stable")[:k]] for _, k, i, w, _ in groups])
    if p.cost[best].sum() <= budget and p.bought[best].sum() >= places.free:
        # the best of every position can be paid: no program needed
        value = float(worth[best].sum()) + most
        return (value, best.tolist()) if value >= need - 1e-7 else (LOW, [])

    def weigh(weight):
        """(bound, cost of the best of each position)"""
        bound, cost = weight * budget + most, 0.0
        for _, k, _, w, c in groups:
            r = w - weight * c
            top = np.argpartition(r, len(r) - k)[len(r) - k:]
            bound, cost = bound + r[top].sum(), cost + c[top].sum()
        return float(bound), cost

    bound, cost = weigh(0.0)
    weight, low, high = 0.0, 0.0, 0.125
    if cost > budget:
        while True:
            at, cost = weigh(high)
            if at < bound:
                bound, weight = at, high
            if cost <= budget or high > 1e6:
                break
            low, high = high, 2 * high
        for _ in range(12):
            middle = (low + high) / 2
            at, cost = weigh(middle)
            if at < bound:
                bound, weight = at, middle
            low, high = (middle, high) if cost > budget else (low, middle)
    slack = bound - need + 1e-7
    if slack < 0:
        return LOW, []
    left, inside, scored = [], [], {}
    for position, k, index, w, c in groups:
        r = w - weight * c
        order = np.argsort(-r, kind="stable")
        kth, after = r[order[k - 1]], r[order[k]] if len(r) > k else LOW
        sure = np.zeros(len(r), bool)
        sure[order[:k]] = r[order[:k]] - after > slack
        inside.append(index[sure])
        left.append(index[(r >= kth - slack) & ~sure])
        if not sure.sum() == k:
            scored[position] = k - int(sure.sum())
    inside, left = np.concatenate(inside), np.concatenate(left)
    budget -= int(p.cost[inside].sum())
    counted = min(places.free, int(p.bought[inside].sum()))
    value, chosen = float(worth[inside].sum()) + places.bonus * counted, inside.tolist()
    if budget < 0:
        return LOW, []
    if scored:
        rest = p.take(left)
        dearest = sum(int(np.sort(rest.cost[rest.position == q])[-k:].sum()) for q, k in scored.items())
        budget = min(budget, dearest)
        total, squad = fill(rest, rest.value - worth[left], Places(scored, {}, places.free - counted, places.bonus), budget)
        if total[budget] < LOW / 2:
            return LOW, []
        value, chosen = value + float(total[budget]), chosen + [int(left[i]) for i in squad(budget)]
    return (value, chosen) if value >= need - 1e-7 else (LOW, [])


class Tops:
    """The players that can be the best of their position at any fines of the clubs, a position a row, in order
    of index: each club's best, as many as places, since a club's players are fined alike."""

    def __init__(self, p: Players, places: Places):
        by_worth = np.lexsort((-p.value, p.club))
        kept = []
        for position, k in places.scored.items():
            index = by_worth[p.position[by_worth] == position]
            club = p.club[index]
            kept.append(np.sort(index[:k] if len(index) <= k else index[
                np.r_[np.ones(k, bool), club[k:] != club[:-k]]]))
        width = max([k for k in places.scored.values()] + [len(x) for x in kept])
        self.index = np.zeros((len(kept), width), int)
        self.value = np.full((len(kept), width), -np.inf)
        for row, x in enumerate(kept):
            self.index[row, :len(x)], self.value[row, :len(x)] = x, p.value[x]
        self.club, self.cost, self.bought = p.club[self.index], p.cost, p.bought
        self.at = np.full(len(p.cost), -1)  # a player's place in the flattened rows
        for row, x in enumerate(kept):
            self.at[x] = row * width + np.arange(len(x))
        counts = list(places.scored.values())
        self.row = np.repeat(np.arange(len(counts)), counts)
        self.place = np.concatenate([np.arange(k) for k in counts])
        self.free, self.most = places.free, places.bonus * places.free

    def best_at(self, mu: np.ndarray, budget: int, need: float, shut: np.ndarray | None = None):
        """What :func:`best_at` gives for the values less the fines ``mu``, if the best of every position can
        be paid; else None. ``shut`` marks the places of ``index`` that are left out."""
        worth = mu[self.club] - self.value
        if shut is not None:
            worth[shut] = np.inf
        order = worth.argsort(axis=1, kind="stable")[self.row, self.place]
        best, top = self.index[self.row, order], -float(np.add.reduce(worth[self.row, order]))
        if top == -np.inf:
            return LOW, []
        if np.add.reduce(self.cost[best]) > budget or np.add.reduce(self.bought[best]) < self.free:
            return None
        value = top + self.most
        return (value, best.tolist()) if value >= need - 1e-7 else (LOW, [])


def swaps(own: dict, bank: int, pool: dict, cap: int, rounds: int) -> list[tuple[int, int, float]]:
    """(code sold, code bought, gain) of the best single swap, again and again on the squad and bank that the one before
    left, while it gains. A club bought in holds at most ``cap`` afterwards, an unknown one (-1) any number; a player whose
    sell value is below 0 stays. Ties go to the least code sold, then bought. ``pool`` is in order of code."""
    code, position, score, sell = (own[k].copy() for k in ("code", "position", "score", "sell"))
    names = np.unique(np.concatenate([own["club"], pool["club"]]))
    club, club_of = np.searchsorted(names, own["club"]), np.searchsorted(names, pool["club"])
    known = names != -1
    by_position = {int(q): np.flatnonzero(pool["position"] == q) for q in np.unique(position)}
    out = []
    for _ in range(rounds):
        count, best = np.bincount(club, minlength=len(names)), None
        for q, i in by_position.items():
            mine = np.flatnonzero((position == q) & (sell >= 0))
            if not len(mine) or not len(i):
                continue
            mine = mine[np.argsort(code[mine], kind="stable")]
            after = count[club_of[i]][None] - (club_of[i][None] == club[mine][:, None]) + 1
            legal = (pool["price"][i][None] <= bank + sell[mine][:, None]) & ((after <= cap) | ~known[club_of[i]][None])
            legal &= ~np.isin(pool["code"][i], code)[None]
            gain = np.where(legal, pool["score"][i][None] - score[mine][:, None], -np.inf)
            k, m = np.unravel_index(int(gain.argmax()), gain.shape)
            found = (float(gain[k, m]), -int(code[mine[k]]), int(mine[k]), int(i[m]))
            best = found if best is None or found[:2] > best[:2] else best
        if best is None or not round(best[0], 9) > 0:
            break
        gain, _, o, i = best
        out.append((int(code[o]), int(pool["code"][i]), gain))
        bank += int(sell[o]) - int(pool["price"][i])
        code[o], score[o], sell[o], club[o] = pool["code"][i], pool["score"][i], pool["price"][i], club_of[i]
    return out


def value_of(p: Players, chosen: list[int], places: Places) -> float:
    """A squad's value: its best scored players, and the bonus of bought ones."""
    out = places.bonus * min(places.free, int(p.bought[chosen].sum()))
    positions, values = p.position[chosen], p.value[chosen]
    for position in places.scored:
        out += np.sort(values[positions == position])[::-1][:places.scored[position]].sum()
    return float(out)


@dataclass
class Found:
    value: float            # of the best legal squad, LOW if none
    squad: list[int]
    upper: np.ndarray       # bound by budget
    legal: list[tuple[int, float]]  # (cost, value) of every legal squad met


def search(p: Players, places: Places, budget: int, caps: np.ndarray, steps: int = 40, enough: float = 1e-6,
           start: tuple[float, list[int]] | None = None, curve: bool = True) -> Found:
    """Bounds for every budget up to ``budget``, made tight for ``budget``. Without ``curve``
    bounds for ``budget`` alone, the same but sooner: squads no better than the best one met
    are not filled, nor are they in ``legal``; for scored places only."""
    # every place costs its position's least price at least: count from there on
    floors = {q: int(p.cost[p.position == q].min()) if (p.position == q).any() else 0 for q in places.scored}
    base = sum(floors[q] * sum(places.of(q)) for q in places.scored)
    free = budget - base
    upper = np.full(budget + 1, np.inf)
    upper[:max(0, min(base, budget + 1))] = LOW
    out = Found(*(start or (LOW, [])), upper, [])
    if free < 0:
        return out
    above = p.cost.astype(int)
    for q, least in floors.items():
        above[p.position == q] -= least
    p = Players(p.position, p.club, above, p.value, p.bought)
    mu, scale = np.zeros(len(caps)), 1.0

    def offer(chosen):
        cost, value = int(p.cost[chosen].sum()) + base, value_of(p, chosen, places)
        out.legal.append((cost, value))
        if value > out.value:
            out.value, out.squad = value, chosen

    size = sum(sum(places.of(q)) for q in places.scored)
    tops = None if curve else Tops(p, places)
    for _ in range(steps):
        if curve:
            total, squad = fill(p, mu[p.club], places, free)
            bounds = np.where(total > LOW / 2, total + float(mu @ caps), LOW)
            np.minimum(upper[base:], bounds, out=upper[base:])
            chosen = squad(free) if total[free] > LOW / 2 else []
        else:
            worth, need = p.value - mu[p.club], out.value - float(mu @ caps)
            top, chosen = tops.best_at(mu, free, need) or best_at(p, worth, places, free, need)
            upper[budget] = min(upper[budget], top + float(mu @ caps) if chosen else out.value)
        if len(chosen) < size:
            break
        count = np.bincount(p.club[chosen], minlength=len(caps))
        over = count - caps
        # mend: a club over its cap keeps its best members, the others are shut out
        mended, known, kept = np.array(chosen), not curve, []
        shut = np.zeros(tops.index.shape, bool) if known else None
        while len(mended) and (count > caps).any():
            clubs = p.club[mended]
            for c in np.flatnonzero(count > caps):
                members = mended[clubs == c]
                keep = members[np.argsort(-p.value[members], kind="stable")[:int(caps[c])]]
                kept.append((c, keep))
                if known:
                    places_kept = tops.at[keep]
                    known = bool((places_kept >= 0).all())
                    shut |= tops.club == c
                    shut.ravel()[places_kept] = False
            again = tops.best_at(mu, free, need, shut) if known else None
            if again:
                mended = np.array(again[1], int)
            else:
                out_of = np.zeros(len(p.cost), bool)
                for c, keep in kept:
                    out_of |= p.club == c
                    out_of[keep] = False
                left = np.flatnonzero(~out_of)
                if curve:
                    total, squad_of = fill(p.take(left), mu[p.club[left]], places, free)
                    again = squad_of(free) if total[free] > LOW / 2 else []
                else:
                    _, again = best_at(p.take(left), worth[left], places, free, need)
                mended = left[np.array(again, int)]
            count = np.bincount(p.club[mended], minlength=len(caps))
        if len(mended) == size:
            offer(mended.tolist())
        if upper[budget] - out.value <= enough or not (over > 0).any() and not mu.any():
            break
        slope = np.where((over > 0) | (mu > 0), over, 0).astype(float)
        if not slope.any():
            break
        gap = max(upper[budget] - max(out.value, upper[budget] - 50.0), 1e-3)
        mu = np.maximum(0.0, mu + scale * gap * slope / (slope @ slope))
        scale *= 0.95
    return out
