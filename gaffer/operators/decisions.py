"""Squad decisions for every manager at once (DEC-1..20), as joins, windows
and aggregates keyed by (manager, period) instead of one solver run per
manager.

Exactness:
* ``best_lineup``: exact. For a fixed formation the best XI is the top-k of
  each position, so the optimum is the best of the 8 legal formations.
  Captain = best starter (always the squad's best player, since every
  position has at least one starter); vice = second; bench outfield by score,
  goalkeeper last.
* ``best_single_transfer``: exact. Candidates are pruned with a per-club
  price ladder: at any budget, only the best players of each (position, club)
  priced within it, one more than a squad may own of the position, can be the
  best buy.
* ``transfer_plan``: greedy by exact best swaps, any number of moves up to the
  squad size, the best prefix taken; reported with an upper bound and the gap.
* ``squad_frontier``: a feasible lower bound and a Lagrangian upper bound
  over a grid of price weights; the gap is an output column.
* ``free_hit`` and ``wildcard_gain`` are built on these bounds and say so.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaffer.functions.scalars import in_tenths, sell_value_tenths
from gaffer.operators.joins import bounded
from gaffer.sources.landing import materialized
from gaffer.sources.seed import MAX_PER_CLUB, SQUAD_RULES, SQUAD_SIZE, XI_SIZE, formation_shapes, squad_quotas

GK = 1
# Bounds that follow from the squad rules.
MAX_QUOTA = max(q for _, q, _, _ in SQUAD_RULES)
# A legal squad owns at most MAX_QUOTA players of one position, so one more of a
# (position, club) within a budget always includes an unowned one.
CLUB_LADDER_DEPTH = MAX_QUOTA + 1
HIT = 4  # points charged for a transfer beyond the free ones


def _score_order(score: str, code: str):
    return [F.col(score).desc(), F.col(code).asc()]


def best_lineup(rows: DataFrame, keys: Sequence[str] = ("entry_id", "gameweek_id"),
                score: str = "expected_points", code: str = "player_code",
                position: str = "position_id") -> DataFrame:
    """DEC-1..4: starting XI, captain, vice-captain and bench order per key.

    ``rows``: one row per (key, squad player) with ``position`` and ``score``.
    Output: the input rows plus ``squad_role``, ``bench_order``,
    ``is_captain``, ``is_vice_captain``, ``formation``, ``xi_points`` and
    ``total_expected_points`` (XI + captain's score once more). A squad that
    fills no legal formation produces no rows (see ``check_squad``).
    """
    keys = list(keys)
    carried = [c for c in rows.columns if c not in keys]
    # One shuffle on the key, after which a key is one row with a list of at most few dozen players in order
    # of score (unknown ones last): formations, captain and bench are functions of that list.
    player = F.struct(F.col(score).isNull().alias("o1"), (-F.col(score)).alias("o2"), F.col(code).alias("o3"),
                      F.col(position).alias("q"), F.col(score).cast("double").alias("s"), F.struct(*carried).alias("row"))
    squads = rows.where(F.col(position).isin([q for q, _, _, _ in SQUAD_RULES])) \
        .groupBy(*keys).agg(F.sort_array(F.collect_list(player)).alias("__squad"))

    def of(q):
        return F.filter("__squad", lambda x: x["q"] == q)
    squads = squads.select(*keys, *[of(q).alias(f"__p{q}") for q, _, _, _ in SQUAD_RULES])

    def total(players):
        return F.aggregate(players, F.lit(None).cast("double"), lambda t, x: F.when(x["s"].isNull(), t).otherwise(
            F.coalesce(t, F.lit(0.0)) + x["s"]))
    options = []
    for number, shape in enumerate(formation_shapes(), 1):
        starters = F.concat(*[F.slice(f"__p{q}", 1, n) for q, n in zip((1, 2, 3, 4), (1, *shape))])
        full = F.lit(True)
        for q, n in zip((1, 2, 3, 4), (1, *shape)):
            full = full & (F.size(f"__p{q}") >= n)
        options.append(F.when(full, F.struct(
            F.lit(number).alias("id"), total(starters).alias("xi"), F.array(*map(F.lit, (1, *shape))).alias("n"),
            F.lit("-".join(map(str, shape))).alias("formation"))))
    # ties between formations compare on values rounded past float noise, so the choice does not depend
    # on the order of addition; an unknown total comes last
    ranked = squads.withColumn("__options", F.array_compact(F.array(*options))).withColumn("__best", F.array_min(F.transform(
        "__options", lambda x: F.struct(x["xi"].isNull().alias("o1"), (-F.round(x["xi"], 9)).alias("o2"), x["id"].alias("id"),
                                        x["xi"].alias("xi"), x["n"].alias("n"), x["formation"].alias("formation")))))
    # Without an option the best one is null, and so is all that follows from it: ``inline`` then gives no row.
    # A filter on the options would be pushed below their projection and reckon every formation twice.
    n = F.col("__best.n")
    in_xi = F.sort_array(F.concat(*[F.slice(F.col(f"__p{q}"), F.lit(1), n[q - 1]) for q in (1, 2, 3, 4)]))
    left = {q: F.slice(F.col(f"__p{q}"), n[q - 1] + 1, F.greatest(F.size(f"__p{q}"), F.lit(1))) for q in (1, 2, 3, 4)}
    best = ranked.withColumn("__xi", in_xi).withColumn(
        "__bench", F.concat(F.sort_array(F.concat(left[2], left[3], left[4])), left[GK])) \
        .withColumn("__cap", F.col("__xi")[0]["s"])

    def rows_of(players, first):
        return F.transform(players, lambda x, i: F.struct(x["row"].alias("r"), F.lit(first).alias("first"), i.alias("i")))
    out = best.select(*keys, F.col("__best.formation").alias("formation"), F.col("__best.xi").alias("xi_points"),
                      (F.col("__best.xi") + F.col("__cap")).alias("total_expected_points"),
                      F.inline(F.concat(rows_of("__xi", True), rows_of("__bench", False))))
    first = F.col("first")
    return out.select(
        *[F.col(c) if c in keys else F.col(f"r.{c}").alias(c) for c in rows.columns],
        F.when(first, "starting").otherwise("bench").alias("squad_role"),
        F.when(~first, F.col("i") + 1).cast("int").alias("bench_order"),
        (first & (F.col("i") == 0)).alias("is_captain"), (first & (F.col("i") == 1)).alias("is_vice_captain"),
        "formation", "xi_points", "total_expected_points")


def chip_values(lineup: DataFrame, keys: Sequence[str] = ("entry_id", "gameweek_id"),
                score: str = "expected_points") -> DataFrame:
    """DEC-16/17: per key, bench boost value (bench points, i.e. squad total
    minus XI total) and triple captain value (the captain's score)."""
    return lineup.groupBy(*keys).agg(
        F.sum(F.when(F.col("squad_role") == "bench", F.col(score)).otherwise(0.0)).alias("bench_boost_value"),
        F.max(F.when(F.col("is_captain"), F.col(score))).alias("triple_captain_value"),
        F.max(F.when(F.col("is_captain"), F.col("player_code"))).alias("triple_captain_code"))


def chip_candidates(values: DataFrame, entity: str = "entry_id", period: str = "gameweek_id",
                    chips: Sequence[str] = ("bench_boost_value", "triple_captain_value", "free_hit_value"),
                    k: int = 3) -> DataFrame:
    """DEC-20: the best ``k`` periods per (entity, chip), rank 1 = best."""
    parts = [values.select(entity, period, F.lit(c.replace("_value", "")).alias("chip_name"),
                           F.col(c).alias("opportunity_value")) for c in chips if c in values.columns]
    long = parts[0]
    for part in parts[1:]:
        long = long.unionByName(part)
    w = Window.partitionBy(entity, "chip_name").orderBy(F.round("opportunity_value", 9).desc(), F.col(period))
    return long.withColumn("chip_rank", F.row_number().over(w)).where(F.col("chip_rank") <= k)


def check_squad(squads: DataFrame, prices: DataFrame, entity: str = "entry_id",
                budget_tenths: int = 1000, code: str = "player_code",
                position: str = "position_id", club: str = "team_code",
                price: str = "price") -> DataFrame:
    """DEC-10: squad rules per manager: 15 players, 2/5/5/3 by position, at
    most 3 per club, cost within budget. Two-level aggregate (club counts
    first), no collection of the squad."""
    # one shuffle by manager: the per-(manager, club) and per-(manager,
    # position) counts and the final joins all reuse that partitioning
    s = squads.select(entity, code, position).join(prices.select(code, club, price), code, "left") \
        .repartition(entity)
    clubs = s.groupBy(entity, club).agg(F.count(F.lit(1)).alias("n_club")) \
        .groupBy(entity).agg(F.max("n_club").alias("max_per_club"))
    q = squad_quotas(squads.sparkSession)
    per_pos = s.groupBy(entity, position).agg(F.count(F.lit(1)).alias("n_pos")) \
        .join(bounded(q), position, "inner")
    pos_ok = per_pos.groupBy(entity).agg(
        F.sum(F.when(F.col("n_pos") == F.col("squad_quota"), 1).otherwise(0)).alias("n_pos_ok"))
    tot = s.groupBy(entity).agg(F.count(F.lit(1)).alias("n_players"),
                                F.sum(in_tenths(price)).alias("cost_tenths"),
                                F.count(price).alias("n_priced"))
    out = tot.join(clubs, entity, "left").join(pos_ok, entity, "left")
    return out.select(
        entity, "n_players", "max_per_club", (F.col("cost_tenths") / 10.0).alias("squad_cost"),
        (F.col("n_players") == SQUAD_SIZE).alias("size_ok"),
        (F.coalesce(F.col("n_pos_ok"), F.lit(0)) == 4).alias("positions_ok"),
        (F.col("max_per_club") <= MAX_PER_CLUB).alias("clubs_ok"),
        ((F.col("cost_tenths") <= budget_tenths) & (F.col("n_priced") == F.col("n_players"))).alias("budget_ok"))


def purchase_price(squad: DataFrame, transfers_in: DataFrame | None, recommended: DataFrame | None,
                   current: DataFrame, entity: str = "entry_id", code: str = "player_code") -> DataFrame:
    """DEC-8: last transfer-in cost, else the recommended price, else the
    current price; one row per squad row.

    ``transfers_in``: entity, code, cost, transferred_at. The latest wins, a NULL
    time first as in PostgreSQL ``desc``, equal times by cost. ``recommended``:
    entity, code, price and, when runs are appended, ``generated_at``: only the
    latest run's price counts, equal times by price."""
    s = squad.select(entity, code)

    def last(rows: DataFrame, order: list, value: str, alias: str) -> DataFrame:
        w = Window.partitionBy(entity, code).orderBy(*order, F.col(value).desc_nulls_last())
        return rows.withColumn("__n", F.row_number().over(w)).where(F.col("__n") == 1) \
            .select(entity, code, F.col(value).alias(alias))

    if transfers_in is not None:
        s = s.join(last(transfers_in, [F.col("transferred_at").desc_nulls_first()], "cost", "__t"),
                   [entity, code], "left")
    else:
        s = s.withColumn("__t", F.lit(None).cast("double"))
    if recommended is not None:
        run = [F.col("generated_at").desc_nulls_last()] if "generated_at" in recommended.columns else []
        s = s.join(last(recommended, run, "price", "__r"), [entity, code], "left")
    else:
        s = s.withColumn("__r", F.lit(None).cast("double"))
    s = s.join(current.select(code, F.col("price").alias("__c")), code, "left")
    return s.select(entity, code, F.coalesce("__t", "__r", "__c").cast("double").alias("purchase_price"),
                    F.col("__c").cast("double").alias("current_price"))


def bank(purchases: DataFrame, entity: str = "entry_id", budget_tenths: int = 1000,
         override: DataFrame | None = None) -> DataFrame:
    """DEC-9: ``budget - sum(purchase)`` in tenths unless a real bank is given."""
    b = purchases.groupBy(entity).agg(
        (F.lit(budget_tenths) - F.sum(in_tenths("purchase_price"))).alias("__bank_t"))
    if override is not None:
        b = b.join(override.select(entity, F.col("bank").alias("__o")), entity, "left") \
            .withColumn("__bank_t", F.coalesce(in_tenths("__o"), F.col("__bank_t")))
    return b.select(entity, F.col("__bank_t").alias("bank_tenths"))


def current_squad(picks: DataFrame, recommendations: DataFrame, entity: str = "entry_id",
                  period: str = "gameweek_id", run: str = "generated_at") -> DataFrame:
    """DEC-7: each manager's picks of their latest period; managers without
    picks fall back to their latest recommendation run."""
    wp = Window.partitionBy(entity).orderBy(F.col(period).desc())
    real = picks.withColumn("__r", F.rank().over(wp)).where(F.col("__r") == 1) \
        .select(entity, "player_code", F.lit("picks").alias("source"))
    wr = Window.partitionBy(entity).orderBy(F.col(run).desc())
    recs = recommendations.join(picks.select(entity).distinct(), entity, "left_anti") \
        .withColumn("__r", F.rank().over(wr)).where(F.col("__r") == 1) \
        .select(entity, "player_code", F.lit("recommendation").alias("source"))
    return real.unionByName(recs)


def price_levels(pool: DataFrame, price_t: str = "price_tenths") -> DataFrame:
    """The distinct prices of the pool: the only budgets that differ in what they buy."""
    return pool.where(F.col(price_t).isNotNull()).select(F.col(price_t).alias("level_tenths")).distinct()


def price_ladder(pool: DataFrame, score: str = "score", code: str = "player_code",
                 position: str = "position_id", club: str = "team_code",
                 price_t: str = "price_tenths", depth: int = CLUB_LADDER_DEPTH) -> DataFrame:
    """DEC-15 (exact pruning): for every (position, club, budget level) the
    ``depth`` best players priced within the level.

    First the ``depth`` best per (position, club, price) (a map-side group
    limit, so a hot club is cut before the shuffle), then each survivor is
    attached to the budget levels at or above its price and limited again.
    """
    order = [F.col(score).desc(), F.col(code).asc()]
    per_price = pool.withColumn("__r", F.row_number().over(
        Window.partitionBy(position, club, price_t).orderBy(*order))).where(F.col("__r") <= depth).drop("__r")
    all_levels = price_levels(pool, price_t).agg(F.sort_array(F.collect_list("level_tenths")).alias("__levels"))
    spread = per_price.crossJoin(bounded(all_levels)).withColumn(
        "level_tenths", F.explode(F.filter("__levels", lambda x: x >= F.col(price_t)))).drop("__levels")
    return spread.withColumn("ladder_rank", F.row_number().over(
        Window.partitionBy(position, club, "level_tenths").orderBy(*order))) \
        .where(F.col("ladder_rank") <= depth)


def prune_pool(pool: DataFrame, score: str = "score", code: str = "player_code",
               position: str = "position_id", club: str = "team_code",
               price_t: str = "price_tenths") -> DataFrame:
    """DEC-15: drop players dominated (same position, price <=, better score;
    ties by code) by players of at least ``floor((15 - 1) / 3) + quota``
    distinct clubs; no optimal squad needs them (at most 4 clubs can be full
    and quota - 1 dominators already chosen, so a legal swap remains).

    Exact without pairing players: a club dominates ``x`` iff its best player
    other than ``x`` at ``x``'s own price level does, and the price ladder
    gives each club's two best per level. A level's list is one row, so players are
    neither shuffled nor multiplied. Output: the kept players with ``dominating_clubs``.
    """
    spark = pool.sparkSession
    ladder = price_ladder(pool, score, code, position, club, price_t, depth=2)
    # one row per (position, price): two players per club, so positions, prices and clubs bound it
    rivals = ladder.where(F.col(club).isNotNull()).groupBy(position, F.col("level_tenths").alias(price_t)).agg(
        F.collect_list(F.struct(F.col(club).alias("c"), F.col(code).alias("y"), F.col(score).alias("s"))).alias("__rivals"))
    x = pool.select(position, code, club, price_t, score)

    def beats(r):
        return (r["y"] != F.col(code)) & ((r["s"] > F.col(score)) | ((r["s"] == F.col(score)) & (r["y"] < F.col(code))))
    clubs = F.array_distinct(F.transform(F.filter("__rivals", beats), lambda r: r["c"]))
    q = bounded(squad_quotas(spark))
    keep = x.join(bounded(rivals), [position, price_t], "left").join(q, position) \
        .withColumn("dominating_clubs", F.when(F.col("__rivals").isNull(), F.lit(0)).otherwise(F.size(clubs)).cast("bigint")) \
        .select(position, code, club, price_t, score, "dominating_clubs", "squad_quota")
    limit = F.lit((SQUAD_SIZE - 1) // MAX_PER_CLUB) + F.col("squad_quota")
    return keep.where(F.col("dominating_clubs") < limit).drop("squad_quota")


def best_single_transfer(squads: DataFrame, pool: DataFrame, bank_t: DataFrame,
                         entity: str = "entry_id", score: str = "score",
                         code: str = "player_code", position: str = "position_id",
                         club: str = "team_code", price_t: str = "price_tenths",
                         ladder: DataFrame | None = None) -> DataFrame:
    """DEC-11 (k = 1) / DEC-13: the best swap per manager.

    ``squads``: entity, code, purchase_tenths. ``pool``: code, position, club,
    price_tenths, score (every current player). ``bank_t``: entity,
    bank_tenths. Budget after the sale = bank + sell value (50% sell-on fee).
    ``ladder``: a stored :func:`price_ladder` of the pool, to reuse. Squad members
    absent from the pool cannot be sold but stay owned (D2).
    Output per manager: out/in codes, ``gain`` (score in - score out) and the
    bank after the swap; no row when no legal swap exists.
    """
    if ladder is None:
        ladder = price_ladder(pool, score, code, position, club, price_t)
    own = squads.join(pool, code, "left").join(bank_t, entity, "inner").repartition(entity)
    own = own.withColumn("budget_tenths", F.col("bank_tenths")
                         + sell_value_tenths(F.col(price_t), F.col("purchase_tenths")))
    # a budget buys what the dearest price level within it buys
    levels = price_levels(pool, price_t).agg(F.sort_array(F.collect_list("level_tenths")).alias("__levels"))
    own = own.crossJoin(bounded(levels)).withColumn("level_tenths", F.array_max(
        F.filter("__levels", lambda x: x <= F.col("budget_tenths")))).drop("__levels")
    # per-squad state, bounded by the squad size: owned codes and a club ->
    # count map, as window aggregates over the manager partitioning
    w_sq = Window.partitionBy(entity)
    own = own.withColumn("__owned", F.collect_list(code).over(w_sq)) \
        .withColumn("__clubs", F.collect_list(club).over(w_sq))
    clubs = F.array_compact(F.array_distinct("__clubs"))
    own = own.withColumn("__cmap", F.map_from_arrays(
        clubs, F.transform(clubs, lambda c: F.size(F.filter("__clubs", lambda x: x == c)))))
    o = own.where(F.col("level_tenths").isNotNull()).select(
        entity, F.col(code).alias("out_code"), F.col(position), F.col(club).alias("out_club"),
        F.col(score).alias("out_score"), "level_tenths", "budget_tenths", "__owned", "__cmap")
    cand = ladder.select(F.col(code).alias("in_code"), position, F.col(club).alias("in_club"),
                         F.col(score).alias("in_score"), F.col(price_t).alias("in_price"),
                         "level_tenths")
    # no hint: the planner broadcasts the ladder only if its size allows
    pairs = o.join(cand, [position, "level_tenths"], "inner")
    n_club = F.coalesce(F.col("__cmap")[F.col("in_club")], F.lit(0))
    after = n_club - F.when(F.col("in_club") == F.col("out_club"), 1).otherwise(0) + 1
    pairs = pairs.where(~F.array_contains("__owned", F.col("in_code")) & (after <= MAX_PER_CLUB))
    gain = F.col("in_score") - F.col("out_score")
    w = Window.partitionBy(entity).orderBy(gain.desc(), F.col("out_code"), F.col("in_code"))
    return pairs.withColumn("__b", F.row_number().over(w)).where(F.col("__b") == 1).select(
        entity, "out_code", "in_code", position, gain.alias("gain"),
        ((F.col("budget_tenths") - F.col("in_price")) / 10.0).alias("bank_after"))


def transfer_plan(squads: DataFrame, pool: DataFrame, bank_t: DataFrame, free_transfers: int = 1,
                  hit: int = HIT, entity: str = "entry_id", code: str = "player_code",
                  price_t: str = "price_tenths", score: str = "score", position: str = "position_id",
                  ladder: DataFrame | None = None, max_rounds: int = SQUAD_SIZE) -> DataFrame:
    """DEC-11 (any number of transfers) / DEC-13: a plan per manager. Greedy.

    Each round makes the exact best swap of every manager on the squad and bank
    that the rounds before left, while it gains anything, for at most as many
    rounds as a squad has players. Of all prefixes, including none, the one with
    the best net wins (fewer transfers on a tie): net = gross gain - ``hit`` for
    every original player gone beyond ``free_transfers``; a player bought and
    sold again costs nothing. The plan is feasible, at least as good as the best
    single swap, and a lower bound of the optimum; ``upper_net_gain`` bounds
    the optimum from above (see :func:`transfer_upper_bound`), ``gap`` is between.

    A manager's rounds depend on the own squad only: they run in the task that holds it, over
    the ladder's players, so no round is joined, sorted or stored.
    """
    if ladder is None:
        ladder = materialized(price_ladder(pool, score, code, price_t=price_t), "ladder")
    from gaffer.operators.squads import swap_rounds  # it builds on this module
    original = squads.select(entity, F.col(code).alias("in_code"), F.lit(True).alias("__back")).distinct()
    found = swap_rounds(squads, pool, bank_t, ladder, max_rounds, entity, code, price_t, score, position)
    moves = materialized(found.join(original, [entity, "in_code"], "left").withColumn(
        "__back", F.coalesce("__back", F.lit(False))), "plan-moves")
    start = bank_t.select(entity)
    # every move in order: state after each prefix, from the manager's few moves
    flat = moves.join(squads.select(entity, F.col(code).alias("out_code"), F.lit(1).alias("__own")),
                      [entity, "out_code"], "left")
    w = Window.partitionBy(entity).orderBy("step")
    gone = F.sum(F.coalesce("__own", F.lit(0)) - F.col("__back").cast("int")).over(w)
    steps = flat.withColumn("n", gone).withColumn("gross", F.sum("gain").over(w)) \
        .withColumn("cost", hit * F.greatest(F.col("n") - free_transfers, F.lit(0))) \
        .withColumn("net", F.col("gross") - F.col("cost"))
    best = steps.withColumn("__b", F.row_number().over(Window.partitionBy(entity).orderBy(
        F.round("net", 9).desc(), F.col("step")))).where((F.col("__b") == 1) & (F.round("net", 9) > 0)) \
        .select(entity, F.col("step").alias("rounds"), F.col("n").alias("n_transfers"), F.col("gross").alias("gross_gain"),
                F.col("cost").alias("hit_cost"), F.col("net").alias("net_gain"))
    taken = moves.join(best.select(entity, "rounds"), entity).where(F.col("step") <= F.col("rounds"))
    listed = taken.groupBy(entity).agg(F.sort_array(F.collect_list("out_code")).alias("__o"),
                                       F.sort_array(F.collect_list("in_code")).alias("__i")).select(
        entity, F.array_join(F.array_except("__o", "__i").cast("array<string>"), ",").alias("out_codes"),
        F.array_join(F.array_except("__i", "__o").cast("array<string>"), ",").alias("in_codes"))
    upper = transfer_upper_bound(squads, pool, free_transfers, hit, entity, code, score, position)
    zero = F.lit(0.0)
    return start.join(best, entity, "left").join(listed, entity, "left").join(upper, entity, "left").select(
        entity, F.coalesce("n_transfers", F.lit(0)).cast("int").alias("n_transfers"),
        F.coalesce("out_codes", F.lit("")).alias("out_codes"), F.coalesce("in_codes", F.lit("")).alias("in_codes"),
        F.coalesce("gross_gain", zero).alias("gross_gain"),
        F.coalesce("hit_cost", F.lit(0)).cast("double").alias("hit_cost"),
        F.coalesce("net_gain", zero).alias("net_gain"), "upper_net_gain",
        (F.col("upper_net_gain") - F.coalesce("net_gain", zero)).alias("gap"))


def transfer_upper_bound(squads: DataFrame, pool: DataFrame, free_transfers: int = 1, hit: int = HIT,
                         entity: str = "entry_id", code: str = "player_code", score: str = "score",
                         position: str = "position_id") -> DataFrame:
    """An upper bound of any transfer plan's net gain per manager, by leaving the
    budget and the club cap out: selling j players of a position gains at most the
    j best unowned minus the j worst owned, so the n-th best of these differences
    over all positions bounds the n-th transfer. ``upper_net_gain`` is the best
    total over n after hits. The best unowned of a position lie in its global top
    2 x MAX_QUOTA, a list bounded by the squad rules."""
    order = Window.partitionBy(position).orderBy(F.col(score).desc(), F.col(code))
    top = pool.withColumn("__r", F.row_number().over(order)).where(F.col("__r") <= 2 * MAX_QUOTA) \
        .groupBy(position).agg(F.sort_array(F.collect_list(F.struct(
            F.col(score).alias("s"), F.col(code).alias("c"))), asc=False).alias("__top"))
    own = squads.select(entity, code).join(pool.select(code, position, score), code) \
        .groupBy(entity, position).agg(F.sort_array(F.collect_list(score)).alias("__low"),
                                       F.collect_list(code).alias("__codes"))
    both = own.join(bounded(top), position, "left")
    free = F.transform(F.filter("__top", lambda t: ~F.array_contains("__codes", t["c"])), lambda t: t["s"])
    pairs = F.zip_with(free, F.col("__low"), lambda t, o: t - o)
    per = both.select(entity, F.filter(pairs, lambda d: d > 0).alias("__d"))
    gains = per.groupBy(entity).agg(F.sort_array(F.flatten(F.collect_list("__d")), asc=False).alias("__d"))
    n = F.size("__d")
    # prefix totals after hits, starting from no transfer
    totals = F.aggregate("__d", F.array(F.lit(0.0)), lambda acc, d: F.concat(acc, F.array(F.element_at(acc, -1) + d)))
    net = F.transform(totals, lambda t, i: t - hit * F.greatest(i - free_transfers, F.lit(0)))
    return gains.select(entity, F.when(n == 0, F.lit(0.0)).otherwise(F.array_max(net)).alias("upper_net_gain"))


def net_points(gain, n_transfers, free_transfers, hit: int = 4):
    """DEC-13: points after hits for transfers beyond the free ones."""
    return gain - F.lit(hit) * F.greatest(F.col(n_transfers) - F.col(free_transfers), F.lit(0))


def _weighted(pool: DataFrame, lambdas: Sequence[float], keys: Sequence[str], score: str, code: str,
              position: str, club: str, price_t: str) -> DataFrame:
    """The pool at every price weight: adj = score - weight * price."""
    spark = pool.sparkSession
    grid = bounded(spark.createDataFrame([(float(x),) for x in lambdas], "lam double"))
    adj = (F.col(score) - F.col("lam") * F.col(price_t) / 10.0)
    return pool.select(*keys, code, position, club, price_t, score).crossJoin(grid) \
        .withColumn("adj", adj).join(bounded(squad_quotas(spark)), position)


def _filled_squads(p: DataFrame, keys: Sequence[str], score: str, code: str, position: str, club: str,
                   price_t: str) -> DataFrame:
    """Per (keys, weight) a squad filled in order of adj, both limits checked as it
    fills: position quota and club cap. At most SQUAD_SIZE // MAX_PER_CLUB clubs
    can be full, so a position's picks lie in the best quota + SQUAD_SIZE of its
    clubs' best MAX_PER_CLUB: a list bounded by the squad rules, folded in a row."""
    order = [F.col("adj").desc(), F.col(code)]
    few = p.withColumn("__c", F.row_number().over(
        Window.partitionBy(*keys, "lam", position, club).orderBy(*order))).where(F.col("__c") <= MAX_PER_CLUB)
    few = few.withColumn("__r", F.row_number().over(Window.partitionBy(*keys, "lam", position).orderBy(*order))) \
        .where(F.col("__r") <= MAX_QUOTA + SQUAD_SIZE).where(F.col("__r") <= F.col("squad_quota") + SQUAD_SIZE)
    entry = F.struct((-F.col("adj")).alias("rank"), F.col(code).alias("code"), F.col(position).alias("position"),
                     F.col(club).alias("club"), F.col(price_t).cast("bigint").alias("price"),
                     F.col(score).cast("double").alias("score"), F.col("squad_quota").alias("quota"))
    lists = few.groupBy(*keys, "lam").agg(F.sort_array(F.collect_list(entry)).alias("cands"))

    def add(acc, x):
        open_position = F.size(F.filter(acc, lambda a: a["position"] == x["position"])) < x["quota"]
        open_club = F.size(F.filter(acc, lambda a: a["club"].eqNullSafe(x["club"]))) < MAX_PER_CLUB
        return F.when(open_position & open_club, F.concat(acc, F.array(x))).otherwise(acc)

    picked = lists.select(*keys, "lam", F.aggregate("cands", F.slice("cands", 1, 0), add).alias("squad"))
    return picked.select(
        *keys, "lam", "squad", F.size("squad").alias("n"),
        F.aggregate("squad", F.lit(0.0), lambda t, x: t + x["score"]).alias("value"),
        F.aggregate("squad", F.lit(0).cast("bigint"), lambda t, x: t + x["price"]).alias("cost_t"))


def squad_frontier(pool: DataFrame, lambdas: Sequence[float], budget_tenths: int,
                   score: str = "score", code: str = "player_code",
                   position: str = "position_id", club: str = "team_code",
                   price_t: str = "price_tenths", keys: Sequence[str] = (),
                   with_squad: bool = False):
    """DEC-14: squad construction under budget, quotas and the club cap.

    For each price weight ``l`` in the (bounded) grid, players are taken in
    order of ``score - l * price`` while their position and club have room; the
    best such squad within budget is the lower bound. Dropping the club cap
    gives the Lagrangian upper bound ``min_l (l * B + sum of top-quota(score -
    l * price))``; any grid gives valid bounds. One row per ``keys`` group (e.g.
    per period): ``lower_value``, ``upper_bound``, ``gap``, ``best_lambda``,
    ``squad_cost`` (NULLs and ``feasible`` false when no weight gives a legal
    squad within budget). ``with_squad`` also returns the chosen squad's rows.
    """
    keys = list(keys)
    p = _weighted(pool, lambdas, keys, score, code, position, club, price_t)
    squads = _filled_squads(p, keys, score, code, position, club, price_t)
    # Lagrangian relaxation of budget and club cap: top quota per position
    up = p.withColumn("__r", F.row_number().over(
        Window.partitionBy(*keys, "lam", position).orderBy(F.col("adj").desc(), F.col(code)))) \
        .where(F.col("__r") <= MAX_QUOTA).where(F.col("__r") <= F.col("squad_quota")) \
        .groupBy(*keys, "lam").agg(F.sum("adj").alias("adj_sum"))
    upper = up.groupBy(*keys).agg(F.min(F.col("lam") * budget_tenths / 10.0 + F.col("adj_sum"))
                                  .alias("upper_bound"))
    feas = squads.where((F.col("n") == SQUAD_SIZE) & (F.col("cost_t") <= budget_tenths))
    w = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1))
    best = feas.withColumn("__b", F.row_number().over(w.orderBy(F.round("value", 9).desc(), F.col("lam")))) \
        .where(F.col("__b") == 1)
    lower = best.select(*keys, F.col("value").alias("lower_value"), F.col("lam").alias("best_lambda"),
                        (F.col("cost_t") / 10.0).alias("squad_cost"))
    out = (upper.join(lower, keys, "left") if keys else upper.join(lower, how="left")).select(
        *keys, F.lit(budget_tenths / 10.0).alias("budget"), "lower_value", "upper_bound",
        (F.col("upper_bound") - F.col("lower_value")).alias("gap"), "best_lambda", "squad_cost",
        F.col("lower_value").isNotNull().alias("feasible"))
    if not with_squad:
        return out
    rows = best.select(*keys, F.explode("squad").alias("x")).select(
        *keys, F.col("x.code").alias(code), F.col("x.position").alias(position), F.col("x.club").alias(club),
        F.col("x.price").alias(price_t), F.col("x.score").alias(score))
    return out, rows


def free_hit(own_lineup: DataFrame, period_pool: DataFrame, lambdas: Sequence[float],
             budget_tenths: int = 1000, entity: str = "entry_id", period: str = "gameweek_id",
             score: str = "expected_points") -> DataFrame:
    """DEC-18: Free Hit value per (manager, period) = best XI of any legal 15 for
    that period - the manager's own best XI, the captain counted once on both
    sides. The 15 are DEC-14's feasible squad for the period, so ``free_hit_xi``
    and ``free_hit_value`` are lower bounds of the exact ones; computed once per
    period, then joined to every manager."""
    _, fh_squad = squad_frontier(period_pool.withColumnRenamed(score, "score"), lambdas, budget_tenths,
                                 keys=[period], with_squad=True)
    rows = fh_squad.select(F.lit(0).alias("__e"), period, "player_code", "position_id",
                           F.col("score").alias(score))
    fh = best_lineup(rows, keys=["__e", period], score=score) \
        .groupBy(period).agg(F.max("xi_points").alias("free_hit_xi"))
    own = own_lineup.groupBy(entity, period).agg(F.max("xi_points").alias("own_xi"))
    return own.join(fh, period, "left").select(
        entity, period, "own_xi", "free_hit_xi",
        (F.col("free_hit_xi") - F.col("own_xi")).alias("free_hit_value"))


def wildcard_gain(squads: DataFrame, pool: DataFrame, bank_t: DataFrame, plan: DataFrame,
                  lambdas: Sequence[float], free_transfers: int = 1, hit: int = HIT,
                  entity: str = "entry_id", score: str = "score",
                  code: str = "player_code", position: str = "position_id",
                  club: str = "team_code", price_t: str = "price_tenths",
                  threshold: float = 4.0) -> DataFrame:
    """DEC-19: an interval that holds the Wildcard gain of every manager.

    gain = value of the best squad with unlimited transfers - value of the best
    ordinary plan after hits. Both are bounded:
    * Wildcard: budget = bank + sum of sell values. Lower: the best DEC-14 grid
      squad (current prices) within it, or the ordinary plan before hits, which
      a Wildcard may copy. Upper: ``min_l (l * B + sum_pos top-quota adj)`` with
      the manager's own players priced at sell value; the top quota of a position
      lies in the global top quota + squad size of it plus the own players.
    * ordinary (``plan``, a :func:`transfer_plan`): lower = squad value +
      net_gain, upper = squad value + upper_net_gain, and no more than Wildcard's
      upper.
    ``gain_lower`` subtracts the ordinary upper bound, ``gain_upper`` the lower
    one. Copying the Wildcard squad costs at most ``hit`` for all transfers but
    the free ones, so the gain lies in [0, hit * (squad size - free_transfers)].
    verdict: 'play' when gain_lower >= threshold, 'hold' when gain_upper <
    threshold, else 'uncertain'.
    """
    p = _weighted(pool, lambdas, [], score, code, position, club, price_t)
    own = squads.join(pool.select(code, position, club, price_t, score), code, "inner") \
        .withColumn("sell_t", sell_value_tenths(F.col(price_t), F.col("purchase_tenths")))
    held = own.groupBy(entity).agg(
        F.sum(score).alias("squad_value"), F.sum("sell_t").alias("sell_sum"),
        F.collect_list(F.struct(F.col(code).alias("code"), F.col(position).alias("position"),
                                F.col(score).alias("score"), F.col("sell_t").alias("sell"))).alias("own"))
    held = held.join(bank_t, entity).withColumn("wc_budget", F.col("bank_tenths") + F.col("sell_sum")) \
        .join(plan.select(entity, "net_gain", "gross_gain", "upper_net_gain"), entity, "left")
    # grid squads and top lists: rows bounded by the grid and the squad rules
    grid = _filled_squads(p, [], score, code, position, club, price_t).where(F.col("n") == SQUAD_SIZE) \
        .agg(F.collect_list(F.struct("value", "cost_t")).alias("grid"))
    top = p.withColumn("__r", F.row_number().over(
        Window.partitionBy("lam", position).orderBy(F.col("adj").desc(), F.col(code)))) \
        .where(F.col("__r") <= MAX_QUOTA + SQUAD_SIZE).where(F.col("__r") <= F.col("squad_quota") + SQUAD_SIZE) \
        .groupBy("lam", F.col(position).alias("position"), F.col("squad_quota").alias("quota")) \
        .agg(F.collect_list(F.struct("adj", F.col(code).alias("code"))).alias("list")) \
        .groupBy("lam").agg(F.collect_list(F.struct("position", "quota", "list")).alias("tops")) \
        .agg(F.collect_list(F.struct("lam", "tops")).alias("weights"))
    rows = held.crossJoin(bounded(grid)).crossJoin(bounded(top)) \
        .withColumn("owned", F.transform("own", lambda x: x["code"]))

    def best_of(w, t):
        mine = F.transform(F.filter("own", lambda x: x["position"] == t["position"]),
                           lambda x: x["score"] - w["lam"] * x["sell"] / 10.0)
        others = F.transform(F.filter(t["list"], lambda y: ~F.array_contains("owned", y["code"])), lambda y: y["adj"])
        return F.aggregate(F.slice(F.sort_array(F.concat(mine, others), asc=False), 1, t["quota"]),
                           F.lit(0.0), lambda a, v: a + v)

    bounds = F.transform("weights", lambda w: w["lam"] * F.col("wc_budget") / 10.0 + F.aggregate(
        w["tops"], F.lit(0.0), lambda a, t: a + best_of(w, t)))
    affordable = F.transform(F.filter("grid", lambda g: g["cost_t"] <= F.col("wc_budget")), lambda g: g["value"])
    out = rows.withColumn("upper_value", F.array_min(bounds)) \
        .withColumn("lower_value", F.greatest(F.array_max(affordable), F.col("squad_value") + F.col("gross_gain"))) \
        .withColumn("ordinary_lower", F.col("squad_value") + F.col("net_gain")) \
        .withColumn("ordinary_upper", F.least(F.col("squad_value") + F.col("upper_net_gain"), F.col("upper_value")))
    most = float(hit * max(0, SQUAD_SIZE - free_transfers))
    lo = F.least(F.greatest(F.col("lower_value") - F.col("ordinary_upper"), F.lit(0.0)), F.lit(most))
    hi = F.least(F.greatest(F.col("upper_value") - F.col("ordinary_lower"), F.lit(0.0)), F.lit(most))
    return out.select(
        entity, "ordinary_lower", "ordinary_upper", "lower_value", "upper_value",
        lo.alias("gain_lower"), hi.alias("gain_upper"),
        F.when(lo >= threshold, "play").when(hi < threshold, "hold").otherwise("uncertain").alias("verdict"))


def recommendation_rows(lineup: DataFrame, players: DataFrame, keys=("entry_id", "gameweek_id")) -> DataFrame:
    """SNK-4: the rows of a squad recommendation batch (append with
    ``landing.append_batch`` to stamp one ``generated_at``)."""
    keys = list(keys)
    j = lineup.join(players.select("player_code", "web_name", F.col("current_team_code").alias("team_code"),
                                   F.col("current_price").cast("double").alias("price")),
                    "player_code", "left")
    tot = j.groupBy(*keys).agg(F.sum("price").alias("total_squad_cost"))
    return j.join(tot, keys).select(
        *keys, "player_code", "web_name", "position_id", "team_code", "price", "expected_points",
        "squad_role", "bench_order", "is_captain", "is_vice_captain", "total_squad_cost",
        "total_expected_points")


# The texts of the chip report.
HORIZON_DETAIL = "best candidate within visible horizon"
WILDCARD_DETAIL = "extra points vs. ordinary hit-costed transfers, if played now"


def chip_rows(candidates: DataFrame, values: DataFrame, wildcard: DataFrame, players: DataFrame,
              entity: str = "entry_id", period: str = "gameweek_id") -> DataFrame:
    """SNK-5: four rows per manager. Bench boost, triple captain and free hit with
    their best period, the captain's name in ``detail``; the wildcard has no
    period, and its value is the lower bound of its gain (DEC-19)."""
    names = values.select(entity, period, F.col("triple_captain_code").alias("player_code")) \
        .join(players.select("player_code", "web_name"), "player_code", "left").drop("player_code")
    best = candidates.where(F.col("chip_rank") == 1).join(names, [entity, period], "left").select(
        entity, "chip_name", F.col(period).cast("int").alias(period), "opportunity_value",
        F.when(F.col("chip_name") == "triple_captain", F.col("web_name")).otherwise(F.lit(HORIZON_DETAIL)).alias("detail"))
    wild = wildcard.select(entity, F.lit("wildcard").alias("chip_name"), F.lit(None).cast("int").alias(period),
                           F.col("gain_lower").alias("opportunity_value"), F.lit(WILDCARD_DETAIL).alias("detail"))
    return best.unionByName(wild)
