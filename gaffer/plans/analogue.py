"""Domain-shaped inputs derived from the driver's TPC-H-style tables.

The driver tables hold no sports data, so every operator is proven on an
analogue whose size grows with the tables:

=====================  =====================================================
domain                 analogue
=====================  =====================================================
season                 ``year(o_orderdate)``; current season = 2001
gameweek (period)      15-day period of the year, ``ceil(dayofyear / 15)``
player (stable code)   customer ``c_custkey``; season id = code + 1 +
                       (2001 - year) * 1,000,000 (a different id per season)
position               market segment (AUTOMOBILE 1, BUILDING 2, MACHINERY 4,
                       others 3)
team (club)            nation; current league = nations outside region 4,
                       code = nation + 100, season id shifts every season
performance row        one order, measures from its line items
fixture calendar       round robin over current clubs, round
                       ``(i + j) mod 25``; pairs ``j - i = 5`` rearranged
                       7 rounds later (blank and double periods)
manager squad          per supplier: the most recently served customers,
                       2 / 5 / 5 / 3 per position
=====================  =====================================================

Each function returns a lazy DataFrame; the same shapes feed the staging
plans of the real payload tables (``gaffer.plans.staging``).
"""

from __future__ import annotations

import hashlib
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaffer.functions.scalars import in_tenths, season_label, tenths
from gaffer.operators.decisions import (
    bank, best_lineup, best_single_transfer, check_squad, chip_candidates, chip_rows, chip_values, free_hit,
    price_ladder, prune_pool, purchase_price, squad_frontier, transfer_plan, wildcard_gain,
)
from gaffer.operators import squads
from gaffer.operators.forecast import target_periods
from gaffer.operators.windows import top_k
from gaffer.plans.materialize import mart
from gaffer.plans.payloads import Payloads
from gaffer.plans.warehouse import Warehouse
from gaffer.sources.landing import input_state
from gaffer.sources.seed import squad_quotas

# Fixed values of the analogue (run parameters, like the reference's vars).
CURRENT_YEAR = 2001
CURRENT_SEASON = "2001-02"
PERIOD_DAYS = 15
ROUNDS = 25
HORIZON = 8
SEASON_ID_STRIDE = 1_000_000
SQUAD_BUDGET_TENTHS = 1500        # the analogue's prices run 4.0 .. 13.0
FRONTIER_BUDGET_TENTHS = 1000
LAMBDAS = [x / 4 for x in range(0, 17)]   # price weights 0 .. 4 in steps of 0.25
SCORE_DIGITS = 6                  # scores as exact 6-digit values: sums of them never sit on a rounding half-point

TASK_ROWS = 500_000               # rows of a few columns that one task sorts or groups

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def period_of(ts) -> "F.Column":
    return F.ceil(F.dayofyear(ts) / F.lit(PERIOD_DAYS)).cast("int")


def position_of(segment) -> "F.Column":
    s = F.col(segment)
    return (F.when(s == "AUTOMOBILE", 1).when(s == "BUILDING", 2)
            .when(s == "MACHINERY", 4).otherwise(3)).cast("int")


def tasks_for(rows: DataFrame) -> int:
    """Shuffle partitions for ``rows``: as the session says, more where a task would hold over ``TASK_ROWS``."""
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // TASK_ROWS))


def _r(x) -> "F.Column":
    return F.round(x).cast("int")


class Analogue:
    """Frames over one scale-factor directory; marts are materialised."""

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.materialize = materialize
        # marts belong to one state of the input files: a name of its own for every
        # path, and another one when files change
        state = f"{self.sf_dir} {input_state(spark, self.sf_dir)}"
        self.tag = "analogue-" + hashlib.sha256(state.encode()).hexdigest()[:16]

    def t(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # ------------------------------------------------------------ staging
    @mart
    def source_teams(self) -> DataFrame:
        """Current clubs with (sometimes zero) strengths. The nations of region 4
        play no part in the current season, so that clubs of the archive are absent
        from it (a property of the modelled season, not a cut of the tables)."""
        cust = self.t("customer").groupBy("c_nationkey").agg(
            F.avg("c_acctbal").alias("avg_bal"), F.count(F.lit(1)).alias("n_cust"))
        n = self.t("nation").where(F.col("n_regionkey") != 4) \
            .join(cust, F.col("n_nationkey") == F.col("c_nationkey"), "left")
        k = F.col("n_nationkey")
        zero = (k % 6) == 0
        ah = F.lit(1000) + _r(F.coalesce(F.col("avg_bal"), F.lit(0.0)) / 10)
        dh = F.lit(1000) + (F.coalesce(F.col("n_cust"), F.lit(0)) % 150).cast("int")

        def z(c):
            return F.when(zero, F.lit(0)).otherwise(c).cast("int")
        return n.select(
            (k + 1).cast("int").alias("team_id"), (k + 100).cast("int").alias("team_code"),
            F.col("n_name").alias("team_name"), F.concat(F.lit("N"), k.cast("string")).alias("team_short_name"),
            z(F.lit(2) + k % 4).alias("strength"),
            z(_r((ah + dh) / 2)).alias("strength_overall_home"),
            z(_r((ah - 25 + dh - 15) / 2)).alias("strength_overall_away"),
            z(ah).alias("strength_attack_home"), z(ah - 25).alias("strength_attack_away"),
            z(dh).alias("strength_defence_home"), z(dh - 15).alias("strength_defence_away"),
            (k + 1).cast("int").alias("league_position"),
            (F.coalesce(F.col("n_cust"), F.lit(0)) % 60).cast("int").alias("points"))

    @mart
    def source_historical_teams(self) -> DataFrame:
        """STG-15 analogue: (season, club) rows from past seasons' orders;
        clubs ``k % 12 = 0, k > 0`` are newly promoted (no history) and
        club 23's code is missing in the archive (NULL code, T12)."""
        o = self.t("orders").where(F.year("o_orderdate") < CURRENT_YEAR) \
            .select(F.year("o_orderdate").alias("yr"), "o_custkey", "o_totalprice")
        c = self.t("customer").select("c_custkey", "c_nationkey")
        agg = o.join(c, F.col("o_custkey") == F.col("c_custkey")) \
            .groupBy("yr", "c_nationkey").agg(F.avg("o_totalprice").alias("avg_price"),
                                              F.count(F.lit(1)).alias("n_ord"))
        n = self.t("nation").where(~(((F.col("n_nationkey") % 12) == 0) & (F.col("n_nationkey") > 0)))
        j = agg.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        k, yr = F.col("n_nationkey"), F.col("yr")
        ah = F.lit(1000) + _r(F.col("avg_price") / 1000)
        dh = F.lit(1000) + (F.col("n_ord") % 150).cast("int")
        return j.select(
            season_label(yr).alias("season"),
            ((k + yr) % ROUNDS + 1).cast("int").alias("team_id"),
            F.when(k == 23, F.lit(None)).otherwise(k + 100).cast("int").alias("team_code"),
            F.col("n_name").alias("team_name"),
            F.concat(F.lit("N"), k.cast("string")).alias("team_short_name"),
            ((k + yr) % 4 + 2).cast("int").alias("strength"),
            _r((ah + dh) / 2).alias("strength_overall_home"),
            _r((ah - 25 + dh - 15) / 2).alias("strength_overall_away"),
            ah.cast("int").alias("strength_attack_home"), (ah - 25).cast("int").alias("strength_attack_away"),
            dh.cast("int").alias("strength_defence_home"), (dh - 15).cast("int").alias("strength_defence_away"))

    @mart
    def source_players(self) -> DataFrame:
        """STG-1 analogue: customers with an order in the current season."""
        cur = self.t("orders").where(F.year("o_orderdate") == CURRENT_YEAR).select(
            F.col("o_custkey").alias("c_custkey"))
        c = self.t("customer").join(cur, "c_custkey", "left_semi")
        key = F.col("c_custkey")
        status = F.when(key % 13 == 0, "i").when(key % 17 == 0, "d").otherwise("a")
        chance = F.when(key % 17 == 0, 75).when(key % 19 == 0, 50).cast("int")
        return c.select(
            (key + 1).alias("player_id"), key.alias("player_code"), F.col("c_name").alias("web_name"),
            (F.col("c_nationkey") + 1).cast("int").alias("team_id"),
            position_of("c_mktsegment").alias("position_id"),
            tenths(F.lit(40) + key % 91).alias("price"),
            status.alias("status"), chance.alias("chance_of_playing_next_round"))

    @mart
    def source_historical_players(self) -> DataFrame:
        """STG-14 analogue: one row per (past season, customer with orders);
        set-piece order arrives as text with ``''`` / ``'None'`` sentinels."""
        seen = self.t("orders").where(F.year("o_orderdate") < CURRENT_YEAR) \
            .select(F.year("o_orderdate").alias("yr"), F.col("o_custkey").alias("c_custkey")).distinct()
        c = self.t("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
        n = self.t("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
        j = seen.join(c, "c_custkey").join(n, "c_nationkey")
        key, yr = F.col("c_custkey"), F.col("yr")
        raw_order = F.when(key % 7 == 0, "").when(key % 11 == 0, "None") \
            .otherwise((key % 5 + 1).cast("string"))
        return j.select(
            season_label(yr).alias("season"),
            (key + 1 + (F.lit(CURRENT_YEAR) - yr) * SEASON_ID_STRIDE).alias("player_id"),
            key.alias("player_code"), F.col("c_name").alias("web_name"),
            position_of("c_mktsegment").alias("position_id"), F.col("n_name").alias("team_name"),
            raw_order.alias("raw_order"))

    @cached_property
    def order_measures(self) -> DataFrame:
        """Per-order measures from line items (one shuffle on the order key)."""
        li = self.t("lineitem")

        def cnt(cond):
            return F.sum(F.when(cond, 1).otherwise(0)).cast("int")
        g = li.groupBy("l_orderkey").agg(
            F.count(F.lit(1)).cast("int").alias("n_lines"),
            F.sum("l_quantity").alias("qty"),
            cnt(F.col("l_returnflag") == "R").alias("goals_scored"),
            cnt(F.col("l_returnflag") == "A").alias("assists"),
            cnt(F.col("l_linestatus") == "O").alias("goals_conceded"),
            cnt(F.col("l_discount") >= 0.095).alias("own_goals"),
            cnt(F.col("l_tax") >= 0.075).alias("penalties_missed"),
            cnt(F.col("l_discount") < 0.005).alias("penalties_saved"),
            cnt(F.col("l_tax") < 0.005).alias("yellow_cards"),
            cnt(F.col("l_quantity") >= 45).alias("saves"))
        minutes = F.least(F.col("qty"), F.lit(90.0)).cast("int")
        cs = F.when(F.col("goals_conceded") == 0, 1).otherwise(0)
        bonus = F.when(F.col("qty") >= 150, 3).when(F.col("qty") >= 100, 1).otherwise(0)
        red = F.when(F.col("n_lines") >= 7, 1).otherwise(0)
        pts = (F.when(minutes >= 60, 2).otherwise(1) + F.col("goals_scored") * 5 + F.col("assists") * 3
               + cs * 4 + bonus - F.col("yellow_cards") - red * 3)
        return g.select(
            "l_orderkey", minutes.alias("minutes"),
            F.when(F.col("n_lines") >= 3, 1).otherwise(0).alias("starts"),
            pts.cast("int").alias("total_points"), "goals_scored", "assists",
            cs.cast("int").alias("clean_sheets"), "goals_conceded", "own_goals",
            "penalties_missed", "penalties_saved", "yellow_cards",
            red.cast("int").alias("red_cards"), "saves", bonus.cast("int").alias("bonus"))

    @mart
    def source_performance(self) -> DataFrame:
        """One row per order with its measures, in season-specific ids."""
        o = self.t("orders").select(
            "o_orderkey", "o_custkey", F.year("o_orderdate").alias("yr"),
            period_of(F.col("o_orderdate")).alias("gameweek_id"))
        o = o.join(self.order_measures, F.col("o_orderkey") == F.col("l_orderkey")).drop("l_orderkey")
        measures = [c for c in self.order_measures.columns if c != "l_orderkey"]
        return o.select(
            season_label(F.col("yr")).alias("season"), (F.col("yr") == CURRENT_YEAR).alias("is_current"), "gameweek_id",
            (F.col("o_custkey") + 1 + (F.lit(CURRENT_YEAR) - F.col("yr")) * SEASON_ID_STRIDE).alias("element"),
            (F.col("o_orderkey") % ROUNDS + 1).cast("int").alias("opponent_id"),
            (F.col("o_orderkey") % 2 == 0).alias("was_home"), F.col("o_orderkey").alias("fixture_id"), *measures) \
            .where(F.col("yr") <= CURRENT_YEAR)

    @cached_property
    def source_manager_weeks(self) -> DataFrame:
        """Weeks of the current season per manager: a supplier's shipments per period."""
        li = self.t("lineitem").where(F.year("l_shipdate") == CURRENT_YEAR) \
            .select(F.col("l_suppkey").alias("entry_id"), period_of(F.col("l_shipdate")).alias("gameweek_id"),
                    "l_quantity", "l_orderkey")
        return li.groupBy("entry_id", "gameweek_id").agg(F.sum("l_quantity").cast("bigint").alias("points"),
                                                         F.countDistinct("l_orderkey").alias("transfers_made"))

    # ------------------------------------------------------------ the models, over landed payloads
    @cached_property
    def warehouse(self) -> Warehouse:
        payloads = Payloads(self)
        w = Warehouse(self.spark, payloads.raw, CURRENT_SEASON, HORIZON, materialize=self.materialize)
        w.tag, w.payloads = self.tag + "-warehouse", payloads
        return w

    @property
    def performance(self) -> DataFrame:
        """INT-1 / MRT-5."""
        return self.warehouse.performance

    @property
    def dim_teams(self) -> DataFrame:
        return self.warehouse.dim_teams

    @property
    def dim_players(self) -> DataFrame:
        return self.warehouse.dim_players

    @cached_property
    def source_gameweeks(self) -> DataFrame:
        """STG-3 analogue: the current season's periods seen in shipments;
        finished up to the last period with an order, next = the one after."""
        li = self.t("lineitem").where(F.year("l_shipdate") == CURRENT_YEAR) \
            .select(period_of(F.col("l_shipdate")).alias("gameweek_id")).distinct()
        last = self.t("orders").where(F.year("o_orderdate") == CURRENT_YEAR) \
            .agg(F.max(period_of(F.col("o_orderdate"))).alias("__last"))
        gw = F.col("gameweek_id")
        return li.crossJoin(F.broadcast(last)).select(
            "gameweek_id", F.concat(F.lit("Gameweek "), gw.cast("string")).alias("gameweek_name"),
            F.coalesce(gw <= F.col("__last"), F.lit(False)).alias("is_finished"),
            F.coalesce(gw == F.col("__last"), F.lit(False)).alias("is_current"),
            F.coalesce(gw == F.col("__last") + 1, F.lit(False)).alias("is_next"))

    @property
    def dim_gameweeks(self) -> DataFrame:
        return self.warehouse.dim_gameweeks

    @cached_property
    def source_fixtures(self) -> DataFrame:
        """STG-5 analogue: round robin over the current clubs (season ids)."""
        t = self.source_teams.select((F.col("team_id") - 1).alias("k"))
        a, b = t.alias("a"), t.alias("b")
        # bounded: the league has at most 25 clubs (nation table), <= 300 pairs
        pairs = a.join(b, F.col("a.k") < F.col("b.k")).select(
            F.col("a.k").alias("i"), F.col("b.k").alias("j"))
        i, j = F.col("i"), F.col("j")
        rnd = F.when(j - i == 5, (i + j + 7) % ROUNDS).otherwise((i + j) % ROUNDS) + 1
        home_first = (i + j) % 2 == 0
        return pairs.select(
            (i * 100 + j).cast("int").alias("fixture_id"), rnd.cast("int").alias("gameweek_id"),
            F.when(home_first, i + 1).otherwise(j + 1).cast("int").alias("home_team_id"),
            F.when(home_first, j + 1).otherwise(i + 1).cast("int").alias("away_team_id"))

    @property
    def fixtures(self) -> DataFrame:
        """MRT-6."""
        return self.warehouse.fct_fixtures

    @property
    def recent_form(self) -> DataFrame:
        return self.warehouse.recent_form

    @property
    def baseline(self) -> DataFrame:
        return self.warehouse.positional_baseline

    @property
    def shrunk(self) -> DataFrame:
        return self.warehouse.form_shrunk

    @mart
    def periods(self) -> DataFrame:
        return target_periods(self.dim_gameweeks, CURRENT_SEASON, HORIZON)

    @property
    def by_period(self) -> DataFrame:
        return self.warehouse.fct_player_expected_points_by_gameweek

    @property
    def next_period(self) -> DataFrame:
        return self.warehouse.fct_player_expected_points

    @property
    def horizon(self) -> DataFrame:
        return self.warehouse.fct_player_expected_points_horizon

    @property
    def density(self) -> DataFrame:
        return self.warehouse.fct_team_gameweek_fixtures

    # ------------------------------------------------------------ squads
    @mart
    def picks(self) -> DataFrame:
        """Manager squads: per supplier, the customers served most recently,
        ``quota`` per position (2/5/5/3), ties by customer key."""
        li = self.t("lineitem").select("l_orderkey", "l_suppkey", "l_shipdate")
        o = self.t("orders").select("o_orderkey", "o_custkey")
        # tables of few narrow columns shrink so well that tasks made up by bytes hold very many rows
        parts = tasks_for(li)
        served = li.repartition(parts, "l_orderkey").join(o.repartition(parts, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey")) \
            .select(F.col("l_suppkey").alias("entry_id"), F.col("o_custkey").alias("player_code"), "l_shipdate")
        # one shuffle by player for the join and the aggregate
        cand = served.repartition(parts, "player_code") \
            .join(self.source_players.select("player_code", "position_id"), "player_code") \
            .groupBy("entry_id", "player_code", "position_id").agg(F.max("l_shipdate").alias("last_served")) \
            .join(F.broadcast(squad_quotas(self.spark)), "position_id")
        ranked = top_k(cand, ["entry_id", "position_id"],
                       [F.col("last_served").desc(), F.col("player_code")], 5, "slot")
        return ranked.where(F.col("slot") <= F.col("squad_quota")) \
            .select("entry_id", "player_code", "position_id", "slot")


    @mart
    def pool(self) -> DataFrame:
        """Every current player with a horizon score and a price in tenths."""
        return self.horizon.select(
            "player_code", "position_id", F.col("current_team_code").alias("team_code"),
            in_tenths("current_price").alias("price_tenths"),
            F.col("current_price").cast("double").alias("price"),
            F.round("horizon_expected_points", SCORE_DIGITS).alias("score"))

    @cached_property
    def lineup_rows(self) -> DataFrame:
        ep = self.by_period.select("player_code", "gameweek_id",
                                   F.round("expected_points", SCORE_DIGITS).alias("expected_points"))
        return self.picks.select("entry_id", "player_code", "position_id").join(ep, "player_code")

    @mart
    def lineup(self) -> DataFrame:
        return best_lineup(self.lineup_rows)

    @cached_property
    def chips(self) -> DataFrame:
        return chip_values(self.lineup)

    @cached_property
    def chip_candidates(self) -> DataFrame:
        return chip_candidates(self.all_chips)

    @cached_property
    def squad_check(self) -> DataFrame:
        return check_squad(self.picks, self.pool, budget_tenths=SQUAD_BUDGET_TENTHS)

    @mart
    def purchases(self) -> DataFrame:
        cur = self.source_players.select("player_code", F.col("price").cast("double").alias("price"))
        return purchase_price(self.picks, None, None, cur)

    @mart
    def bank(self) -> DataFrame:
        return bank(self.purchases, budget_tenths=SQUAD_BUDGET_TENTHS)

    @mart
    def best_transfer(self) -> DataFrame:
        sq = self.purchases.select("entry_id", "player_code",
                                   in_tenths("purchase_price").alias("purchase_tenths"))
        return best_single_transfer(sq, self.pool, self.bank, ladder=self.ladder)

    @mart
    def ladder(self) -> DataFrame:
        return price_ladder(self.pool, "score")

    @cached_property
    def pruned_pool(self) -> DataFrame:
        return prune_pool(self.pool)

    @property
    def plan_squads(self) -> DataFrame:
        return self.purchases.select("entry_id", "player_code", in_tenths("purchase_price").alias("purchase_tenths"))

    @mart
    def transfer_plan(self) -> DataFrame:
        """DEC-11, any number of moves, one free transfer."""
        return transfer_plan(self.plan_squads, self.pool, self.bank, free_transfers=1, ladder=self.ladder)

    @mart
    def candidates(self) -> DataFrame:
        """DEC-15 for all squad searches."""
        return squads.candidates(self.pool)

    @cached_property
    def two_transfers(self) -> DataFrame:
        """DEC-11, exact for at most two moves."""
        return squads.transfers(self.plan_squads, self.pool, self.bank, most_moves=2, pruned=self.candidates)

    @mart
    def optimal_transfers(self) -> DataFrame:
        """DEC-11, any number of moves, with an upper bound."""
        return squads.transfers(self.plan_squads, self.pool, self.bank, pruned=self.candidates)

    @cached_property
    def best_squad(self) -> DataFrame:
        """DEC-14."""
        return squads.best_squad(self.pool, FRONTIER_BUDGET_TENTHS, pruned=self.candidates)

    @mart
    def budget_curve(self) -> DataFrame:
        """DEC-14 for every budget up to the squads' own."""
        return squads.budget_curve(self.pool, range(700, SQUAD_BUDGET_TENTHS + 1, 20), pruned=self.candidates)

    @cached_property
    def period_pool(self) -> DataFrame:
        return self.by_period.select(
            "player_code", "gameweek_id", "position_id", F.col("current_team_code").alias("team_code"),
            in_tenths("current_price").alias("price_tenths"),
            F.round("expected_points", SCORE_DIGITS).alias("expected_points"))

    @mart
    def free_hit_eleven(self) -> DataFrame:
        """DEC-18 by the best eleven, per (manager, period)."""
        return squads.free_hit_by_eleven(self.lineup, self.period_pool, FRONTIER_BUDGET_TENTHS)

    @mart
    def wildcard_interval(self) -> DataFrame:
        """DEC-19 against the optimal transfers."""
        return squads.wildcard_interval(self.plan_squads, self.pool, self.bank, self.optimal_transfers, pruned=self.candidates)

    @cached_property
    def frontier(self) -> DataFrame:
        return squad_frontier(self.pool, LAMBDAS, FRONTIER_BUDGET_TENTHS)


    @mart
    def free_hit(self) -> DataFrame:
        """DEC-18 per (manager, period)."""
        return free_hit(self.lineup, self.period_pool, LAMBDAS, FRONTIER_BUDGET_TENTHS)

    @mart
    def wildcard(self) -> DataFrame:
        """DEC-19 per manager."""
        return wildcard_gain(self.plan_squads, self.pool, self.bank, self.transfer_plan, LAMBDAS)

    @cached_property
    def all_chips(self) -> DataFrame:
        """The three per-period chips of every manager."""
        return self.chips.join(self.free_hit.select("entry_id", "gameweek_id", "free_hit_value"),
                               ["entry_id", "gameweek_id"], "left")

    @cached_property
    def chip_report(self) -> DataFrame:
        return chip_rows(self.chip_candidates, self.chips, self.wildcard, self.dim_players)


# Tables in the order of a rebuild: payloads, models, decisions.
PAYLOAD_MARTS = ["bootstrap", "fixtures", "element_summary", "entry", "entry_history", "entry_picks", "entry_transfers",
                 "historical_players", "historical_teams", "historical_stats"]
MODEL_MARTS = ["players", "teams", "history", "hist_players", "hist_teams", "hist_stats", "performance", "dim_teams",
               "dim_players", "dim_gameweeks", "fct_fixtures", "fct_entry_gameweek_performance", "fct_entry_picks",
               "fct_entry_transfers", "recent_form", "form_shrunk", "fct_player_expected_points",
               "fct_player_expected_points_by_gameweek", "fct_player_expected_points_horizon"]
DECISION_MARTS = ["pool", "picks", "lineup", "purchases", "bank", "ladder", "best_transfer", "transfer_plan", "free_hit",
                  "wildcard", "candidates", "optimal_transfers", "budget_curve", "free_hit_eleven", "wildcard_interval"]


def build_marts(spark: SparkSession, sf_dir: str):
    """(name, build) of every table, in order."""
    a = Analogue(spark, sf_dir)
    w = a.warehouse
    payloads = w.payloads
    for owner, group, names in ((payloads, "payload", PAYLOAD_MARTS), (w, "model", MODEL_MARTS), (a, "decision", DECISION_MARTS)):
        for name in names:
            yield f"{group}:{name}", lambda owner=owner, name=name: getattr(owner, name)
