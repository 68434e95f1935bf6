"""The full model DAG over raw snapshot tables (INT-1..4, MRT-1..13).

``Warehouse(raw, current_season)`` takes the ten raw snapshot tables (any
subset; models needing a missing one raise) and exposes every staging,
intermediate and mart model as a lazy DataFrame. Models read more than once
are memoised on the instance; ``publish`` writes marts as tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaffer.functions.scalars import in_tenths, typed_null
from gaffer.operators import squads
from gaffer.operators.decisions import (
    bank, best_lineup, best_single_transfer, chip_candidates, chip_rows, chip_values, current_squad,
    price_ladder, purchase_price,
)
from gaffer.operators.conform import dim_gameweeks, dim_players, dim_teams
from gaffer.operators.form import group_baseline_rates, recent_form, shrunk_form
from gaffer.operators.forecast import (
    expected_points_by_period, expected_points_horizon, expected_points_next, fixture_density,
    target_periods,
)
from gaffer.operators.joins import enrich_roles
from gaffer.operators.quality import Check, run_suite
from gaffer.operators.setops import union_current_historical
from gaffer.operators.snapshots import latest_per_key
from gaffer.plans import staging as stg
from gaffer.plans.materialize import mart
from gaffer.sources.landing import observed_nulls
from gaffer.sources.versions import publish_version
from gaffer.sources.seed import scoring_rules

RAW_TABLES = [
    "bootstrap_static_snapshot", "fixtures_snapshot", "element_summary_snapshot", "entry_snapshot",
    "entry_history_snapshot", "entry_picks_snapshot", "entry_transfers_snapshot",
    "historical_gw_stats_snapshot", "historical_players_snapshot", "historical_teams_snapshot",
]

PERF_MEASURES = [
    "total_points", "minutes", "starts", "goals_scored", "assists", "clean_sheets", "goals_conceded",
    "own_goals", "penalties_missed", "penalties_saved", "yellow_cards", "red_cards", "saves", "bonus",
    "bps", "influence", "creativity", "threat", "ict_index", "expected_goals", "expected_assists",
    "expected_goal_involvements", "expected_goals_conceded",
]
PERF_TAIL = ["price_at_gameweek", "selected_by_count", "transfers_in", "transfers_out"]


# The data tests declared on the models, (model, column, test[, parent, field]).
DATA_TESTS = [
    *[(m, c, t) for m, c in [
        ("players", "player_id"), ("teams", "team_id"), ("gameweeks", "gameweek_id"), ("positions", "position_id"),
        ("stg_fixtures", "fixture_id"), ("entries", "entry_id"), ("recent_form", "player_code"),
        ("positional_baseline", "position_id"), ("dim_players", "player_code"), ("dim_teams", "team_code"),
        ("dim_positions", "position_id"), ("fct_fixtures", "fixture_id")] for t in ("unique", "not_null")],
    *[(m, c, "not_null") for m, c in [
        ("performance", "player_code"), ("performance", "season"), ("performance", "gameweek_id"),
        ("dim_gameweeks", "season"), ("dim_gameweeks", "gameweek_id"),
        ("fct_entry_gameweek_performance", "entry_id"), ("fct_entry_gameweek_performance", "gameweek_id"),
        ("fct_team_gameweek_fixtures", "gameweek_id")]],
    *[(m, "player_code", "unique") for m in ("form_shrunk", "fct_player_expected_points", "fct_player_expected_points_horizon")],
    *[(m, "player_code", "relationships", "dim_players", "player_code") for m in (
        "form_shrunk", "performance", "fct_entry_picks", "fct_player_expected_points",
        "fct_player_expected_points_by_gameweek", "fct_player_expected_points_horizon")],
    ("fct_fixtures", "home_team_code", "relationships", "dim_teams", "team_code"),
    ("fct_fixtures", "away_team_code", "relationships", "dim_teams", "team_code"),
    ("fct_team_gameweek_fixtures", "team_code", "relationships", "dim_teams", "team_code"),
    ("players", "team_id", "relationships", "teams", "team_id"),
    ("players", "position_id", "relationships", "positions", "position_id"),
    ("history", "player_id", "relationships", "players", "player_id"),
]


def _watched() -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for model, column, kind, *_ in DATA_TESTS:
        if kind == "not_null":
            out.setdefault(model, []).append(column)
    return out


class Warehouse:
    WATCH = _watched()
    _seq = 0

    def __init__(self, spark: SparkSession, raw: dict[str, DataFrame], current_season: str,
                 horizon: int = 8, rules: DataFrame | None = None, materialize: bool = True,
                 partitions: int | None = None):
        Warehouse._seq += 1
        self.tag = f"warehouse-{Warehouse._seq}"
        self.materialize = materialize
        self.partitions = partitions  # spread players again when a payload is one cell
        self.spark = spark
        self.raw = raw
        self.season = current_season
        self.horizon_n = horizon
        self.rules = rules if rules is not None else scoring_rules(spark)

    # ---------------------------------------------------------------- staging
    @mart
    def bootstrap_documents(self):
        """The bootstrap payload, parsed once for all models that read it."""
        return stg.bootstrap_documents(self.raw["bootstrap_static_snapshot"])

    @mart
    def players(self):
        return stg.stg_players(self.bootstrap_documents, self.partitions)

    @mart
    def teams(self):
        return stg.stg_teams(self.bootstrap_documents)

    @mart
    def gameweeks(self):
        return stg.stg_gameweeks(self.bootstrap_documents)

    @mart
    def positions(self):
        return stg.stg_positions(self.bootstrap_documents)

    @mart
    def entries(self):
        return stg.stg_entries(self.raw["entry_snapshot"])

    @mart
    def stg_fixtures(self):
        return stg.stg_fixtures(self.raw["fixtures_snapshot"])

    @mart
    def history(self):
        return stg.stg_player_gameweek_history(self.raw["element_summary_snapshot"])

    @mart
    def hist_players(self):
        return stg.stg_historical_players(self.raw["historical_players_snapshot"])

    @mart
    def hist_teams(self):
        return stg.stg_historical_teams(self.raw["historical_teams_snapshot"])

    @mart
    def hist_stats(self):
        return stg.stg_historical_player_gameweek_stats(self.raw["historical_gw_stats_snapshot"])

    # ---------------------------------------------------------------- INT-1
    @mart
    def performance(self) -> DataFrame:
        """fct_player_gameweek_performance (grain: player x fixture)."""
        h = self.history.join(self.players.select("player_id", "player_code", "web_name", "position_id",
                                                  "team_id"), "player_id", "inner")
        h = enrich_roles(h, self.teams, "team_id", {"own": "team_id", "opp": "opponent_team_id"},
                         {"team_code": "code"})
        cur = h.select(F.lit(self.season).alias("season"), "gameweek_id", "player_code",
                       F.col("web_name").alias("player_name"), "position_id",
                       F.col("own_code").alias("team_code"), F.col("opp_code").alias("opponent_team_code"),
                       "was_home", "fixture_id", *PERF_MEASURES,
                       typed_null("double").alias("expected_points"), *PERF_TAIL)
        g = self.hist_stats.join(self.hist_players.select("season", "season_player_id", "player_code",
                                                          F.col("position_id").alias("hp_position_id")),
                                 ["season", "season_player_id"], "inner")
        ht = self.hist_teams
        g = g.join(ht.select("season", "team_name", F.col("team_code").alias("own_code")),
                   ["season", "team_name"], "left") \
            .join(ht.select("season", F.col("season_team_id").alias("opponent_team_id"),
                            F.col("team_code").alias("opp_code")), ["season", "opponent_team_id"], "left")
        hist = g.select("season", "gameweek_id", "player_code", "player_name",
                        F.col("hp_position_id").alias("position_id"), F.col("own_code").alias("team_code"),
                        F.col("opp_code").alias("opponent_team_code"), "was_home", "fixture_id",
                        *PERF_MEASURES, "expected_points", *PERF_TAIL)
        return union_current_historical(cur, hist)

    # ---------------------------------------------------------------- marts
    @mart
    def dim_teams(self) -> DataFrame:
        hist = self.hist_teams.select("season", "team_code", "team_name", "team_short_name",
                                      *[c for c in self.hist_teams.columns if c.startswith("strength")])
        return dim_teams(self.teams, hist)

    @mart
    def dim_players(self) -> DataFrame:
        cur = {c: c for c in ["player_code"]}
        cur.update({"current_player_id": "player_id", "first_name": "first_name",
                    "second_name": "second_name", "web_name": "web_name",
                    "current_team_code": "current_team_code", "position_id": "position_id",
                    "current_price": "price", "current_season_total_points": "total_points",
                    "form": "form", "selected_by_percent": "selected_by_percent", "status": "status",
                    "news": "news", "chance_of_playing_next_round": "chance_of_playing_next_round",
                    "chance_of_playing_this_round": "chance_of_playing_this_round",
                    "penalties_order": "penalties_order", "direct_freekicks_order": "direct_freekicks_order",
                    "corners_and_indirect_freekicks_order": "corners_and_indirect_freekicks_order"})
        hist = {k: k for k in ["player_code", "first_name", "second_name", "web_name", "position_id",
                               "penalties_order", "direct_freekicks_order",
                               "corners_and_indirect_freekicks_order"]}
        return dim_players(self.players, self.teams, self.hist_players, cur, hist)

    @mart
    def dim_positions(self) -> DataFrame:
        return self.positions.select("position_id", "position_name", "position_name_short",
                                     "squad_select", "squad_min_play", "squad_max_play")

    @mart
    def dim_gameweeks(self) -> DataFrame:
        return dim_gameweeks(self.gameweeks, self.hist_stats, self.season)

    @mart
    def fct_fixtures(self) -> DataFrame:
        f = enrich_roles(self.stg_fixtures, self.teams, "team_id",
                         {"home": "home_team_id", "away": "away_team_id"}, {"team_code": "team_code"})
        return f.select("fixture_id", F.lit(self.season).alias("season"), "gameweek_id", "home_team_code",
                        "away_team_code", "home_team_difficulty", "away_team_difficulty",
                        "home_team_score", "away_team_score", "kickoff_time", "is_started",
                        "is_finished", "is_finished_provisional")

    @mart
    def fct_team_gameweek_fixtures(self) -> DataFrame:
        return fixture_density(self.dim_teams, self.dim_gameweeks, self.fct_fixtures, self.season)

    @mart
    def fct_entry_gameweek_performance(self) -> DataFrame:
        h = stg.stg_entry_gameweek_history(self.raw["entry_history_snapshot"])
        ps = stg.stg_entry_picks_summary(self.raw["entry_picks_snapshot"]) \
            .select("entry_id", "gameweek_id", "active_chip")
        return h.join(ps, ["entry_id", "gameweek_id"], "left")

    @mart
    def fct_entry_picks(self) -> DataFrame:
        p = stg.stg_entry_picks(self.raw["entry_picks_snapshot"])
        return p.join(self.players.select("player_id", "player_code"), "player_id", "left").select(
            "entry_id", "gameweek_id", "player_code", "squad_position", "multiplier", "is_captain",
            "is_vice_captain")

    @mart
    def fct_entry_transfers(self) -> DataFrame:
        t = stg.stg_entry_transfers(self.raw["entry_transfers_snapshot"])
        t = enrich_roles(t, self.players, "player_id", {"player_in": "player_in_id",
                                                        "player_out": "player_out_id"},
                         {"player_code": "code"})
        return t.select("entry_id", "gameweek_id", "player_in_code", "player_in_cost", "player_out_code",
                        "player_out_cost", "transferred_at")

    @mart
    def recent_form(self) -> DataFrame:
        return recent_form(self.performance, self.season)

    @mart
    def positional_baseline(self) -> DataFrame:
        return group_baseline_rates(self.recent_form, self.dim_players)

    @mart
    def form_shrunk(self) -> DataFrame:
        return shrunk_form(self.dim_players, self.recent_form, self.positional_baseline)

    @mart
    def fct_player_expected_points(self) -> DataFrame:
        return expected_points_next(self.form_shrunk, self.dim_gameweeks, self.fct_fixtures,
                                    self.dim_teams, self.rules, self.season)

    @mart
    def fct_player_expected_points_by_gameweek(self) -> DataFrame:
        periods = target_periods(self.dim_gameweeks, self.season, self.horizon_n)
        return expected_points_by_period(self.form_shrunk, periods, self.fct_fixtures, self.dim_teams,
                                         self.rules)

    @mart
    def fct_player_expected_points_horizon(self) -> DataFrame:
        return expected_points_horizon(self.fct_player_expected_points_by_gameweek)

    def player_snapshot_changes(self, cols=("price", "selected_by_percent", "total_points")) -> DataFrame:
        """SEL-8: change of each player's price / ownership / points between
        consecutive bootstrap snapshots (every snapshot, not only the latest)."""
        from gaffer.operators.nested import unnest_json
        from gaffer.operators.snapshots import snapshot_changes
        from gaffer.sources import schemas as S
        raw = self.raw["bootstrap_static_snapshot"]
        tie = ["id"] if "id" in raw.columns else []
        spec = {k: v for k, v in S.PLAYERS.items() if k in ("player_code", *cols)}
        rows = unnest_json(raw, "payload", spec, path="elements", carry=["fetched_at", *tie])
        return snapshot_changes(rows, ["player_code"], "fetched_at", list(cols),
                                tiebreak=tie[0] if tie else None)

    # ---------------------------------------------------------------- decisions
    def current_squads(self, recommendations: DataFrame | None = None) -> DataFrame:
        """DEC-7 for every manager: latest real picks, else the latest
        recommendation run (``entry_id, generated_at, player_code, price``)."""
        if recommendations is None:
            recommendations = self.spark.createDataFrame(
                [], "entry_id int, generated_at timestamp, player_code int, price double")
        picks = self.fct_entry_picks.where(F.col("player_code").isNotNull())
        return current_squad(picks, recommendations).join(
            self.dim_players.select("player_code", "position_id"), "player_code", "left")

    @mart
    def decision_pool(self) -> DataFrame:
        """Every current player: horizon score, price in tenths, club."""
        return self.fct_player_expected_points_horizon.select(
            "player_code", "position_id", F.col("current_team_code").alias("team_code"),
            in_tenths("current_price").alias("price_tenths"),
            F.col("horizon_expected_points").alias("score"))

    @mart
    def player_scores(self) -> DataFrame:
        """JN-4: the players with both scores, over the horizon and in the next
        gameweek; a player without a next gameweek is left out, as in the reference."""
        nxt = self.fct_player_expected_points.select(
            "player_code", "gameweek_id", F.col("expected_points").alias("gw_expected_points"))
        return self.fct_player_expected_points_horizon.select(
            "player_code", "position_id", "current_team_code", "current_price", "horizon_expected_points") \
            .join(nxt, "player_code").join(self.dim_players.select("player_code", "web_name"), "player_code", "left")

    def lineups(self, squads: DataFrame) -> DataFrame:
        """DEC-1..5 for every (manager, period) of the horizon. A squad member
        without a score in a period counts 0 there (``scored`` false, D2)."""
        ep = self.fct_player_expected_points_by_gameweek.select("player_code", "gameweek_id", "expected_points")
        periods = ep.select("gameweek_id").distinct()  # at most the horizon
        grid = squads.select("entry_id", "player_code", "position_id").crossJoin(F.broadcast(periods))
        rows = grid.join(ep, ["player_code", "gameweek_id"], "left") \
            .withColumn("scored", F.col("expected_points").isNotNull()) \
            .withColumn("expected_points", F.coalesce("expected_points", F.lit(0.0)))
        return best_lineup(rows)

    def chips(self, lineups: DataFrame, free_hits: DataFrame | None = None) -> DataFrame:
        """DEC-16/17/18/20: the best 3 periods of each chip."""
        values = chip_values(lineups)
        if free_hits is not None:
            values = values.join(free_hits.select("entry_id", "gameweek_id", "free_hit_value"),
                                 ["entry_id", "gameweek_id"], "left")
        return chip_candidates(values)

    def chip_report(self, lineups: DataFrame, free_hits: DataFrame, wildcards: DataFrame) -> DataFrame:
        """SNK-5: four rows per manager, to append with ``landing.append_batch``."""
        return chip_rows(self.chips(lineups, free_hits), chip_values(lineups), wildcards, self.dim_players)

    def purchases(self, squads: DataFrame, recommendations: DataFrame | None = None) -> DataFrame:
        """DEC-8: last transfer-in cost, else the latest recommended price, else
        the current price."""
        tr = self.fct_entry_transfers.select(
            "entry_id", F.col("player_in_code").alias("player_code"),
            F.col("player_in_cost").cast("double").alias("cost"), "transferred_at")
        rec = None
        if recommendations is not None:
            run = [c for c in ("generated_at",) if c in recommendations.columns]
            rec = recommendations.select("entry_id", "player_code", "price", *run)
        cur = self.players.select("player_code", F.col("price").cast("double").alias("price"))
        return purchase_price(squads.select("entry_id", "player_code"), tr, rec, cur)

    def banks(self, purchases: DataFrame, budget_tenths: int = 1000) -> DataFrame:
        """DEC-9: the real bank of each manager's latest period when present
        (D3), else budget - purchases."""
        real = self.fct_entry_gameweek_performance.select("entry_id", "gameweek_id", "bank")
        real = latest_per_key(real, ["entry_id"], ["gameweek_id"]).select(
            "entry_id", F.col("bank").cast("double").alias("bank"))
        return bank(purchases, budget_tenths=budget_tenths, override=real)

    @mart
    def transfer_ladder(self) -> DataFrame:
        return price_ladder(self.decision_pool)

    @mart
    def squad_candidates(self) -> DataFrame:
        """DEC-15: all that a squad search may need of the pool."""
        return squads.candidates(self.decision_pool)

    @staticmethod
    def _owned(purchases: DataFrame) -> DataFrame:
        return purchases.select("entry_id", "player_code", in_tenths("purchase_price").alias("purchase_tenths"))

    def transfers(self, squads: DataFrame, purchases: DataFrame, banks: DataFrame) -> DataFrame:
        """DEC-11 (one transfer) for every manager."""
        return best_single_transfer(self._owned(purchases), self.decision_pool, banks, ladder=self.transfer_ladder)

    def transfer_plan(self, purchases: DataFrame, banks: DataFrame, free_transfers: int = 1) -> DataFrame:
        """DEC-11 / DEC-13: any number of moves that may pay for each other, hits beyond
        the free ones; exact for at most two moves, bounded from above beyond."""
        return squads.transfers(self._owned(purchases), self.decision_pool, banks, free_transfers,
                                pruned=self.squad_candidates)

    def best_squad(self, budget_tenths: int = 1000) -> DataFrame:
        """DEC-14: the best legal squad within a budget, with an upper bound."""
        return squads.best_squad(self.decision_pool, budget_tenths, pruned=self.squad_candidates)

    def free_hit(self, lineups: DataFrame, budget_tenths: int = 1000) -> DataFrame:
        """DEC-18 for every (manager, period): by the best eleven, and as the
        reference reckons it."""
        pp = self.fct_player_expected_points_by_gameweek.select(
            "player_code", "gameweek_id", "position_id", F.col("current_team_code").alias("team_code"),
            in_tenths("current_price").alias("price_tenths"), "expected_points")
        return squads.free_hit_by_eleven(lineups, pp, budget_tenths)

    def wildcard(self, purchases: DataFrame, banks: DataFrame, plan: DataFrame,
                 free_transfers: int = 1) -> DataFrame:
        """DEC-19 for every manager, against a :meth:`transfer_plan`."""
        return squads.wildcard_interval(self._owned(purchases), self.decision_pool, banks, plan, free_transfers,
                                        pruned=self.squad_candidates)

    MARTS = ["dim_players", "dim_teams", "dim_positions", "dim_gameweeks", "performance",
             "fct_fixtures", "fct_team_gameweek_fixtures", "fct_entry_gameweek_performance",
             "fct_entry_picks", "fct_entry_transfers", "fct_player_expected_points",
             "fct_player_expected_points_by_gameweek", "fct_player_expected_points_horizon"]

    def data_tests(self, tests=None) -> DataFrame:
        """DQ-4: failures of every declared data test. Nulls were counted as the tables were
        written; the other tests of one key share one pass."""
        checks = []
        for model, column, kind, *parent in tests or DATA_TESTS:
            of = (getattr(self, parent[0]), parent[1]) if parent else (None, None)
            checks.append(Check(model, column, kind, getattr(self, model), *of))
        nulls = {m: observed_nulls(self.spark, f"{self.tag}/{m}") for m in {c.table for c in checks}} if self.materialize else {}
        return run_suite(checks, nulls)

    def register_views(self, marts=None, prefix: str = "") -> None:
        """SNK-2: expose models as temp views (lazy, like view-materialised models)."""
        for m in marts or self.MARTS:
            getattr(self, m).createOrReplaceTempView(prefix + m)

    def publish(self, root: str, marts=None, keep: int = 3) -> int:
        """SNK-3: full rebuild of every mart as a new version under ``root``; read with
        ``versions.read_version``. Readers keep the version before until all are written."""
        names = marts or self.MARTS
        return publish_version(self.spark, root, {m: (lambda m=m: getattr(self, m)) for m in names}, keep)
