"""Raw snapshot tables in the payload schema, built from the driver tables.

The analogue's source frames (``analogue.py``) are written out as the payloads
that a crawler would land, so that the real model DAG (``warehouse.Warehouse``)
can be run and checked over whole driver tables:

* bootstrap and fixtures as bounded JSON-array cells of one landing run, with an
  older, wrong run beside it that staging must not read;
* per-player and per-manager payloads, one row per key, again with an older run;
* the historical archive as CSV files per season, landed by ``land_csv``: players
  as rows, clubs as small cells, statistics as rows from several files.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaffer.functions.scalars import in_tenths
from gaffer.operators.nested import pack_json
from gaffer.plans.materialize import mart
from gaffer.session import scratch_path
from gaffer.sources.landing import land_csv, new_run_id
from gaffer.sources.seed import SQUAD_RULES, scoring_rules

OLD, NEW = "2001-01-01 00:00:00", "2001-02-01 00:00:00"
CELL = 500  # array elements in one landed cell


def _landed(df: DataFrame, fetched_at: str, run: str) -> DataFrame:
    return df.withColumn("fetched_at", F.lit(fetched_at).cast("timestamp")).withColumn("run_id", F.lit(run))


def _renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(src).alias(key) for key, src in names.items()])


# Payload field -> source column, where the names differ from the source's.
STRENGTHS = ["strength", "strength_overall_home", "strength_overall_away", "strength_attack_home",
             "strength_attack_away", "strength_defence_home", "strength_defence_away"]
MEASURES = ["minutes", "starts", "total_points", "goals_scored", "assists", "clean_sheets", "goals_conceded",
            "own_goals", "penalties_missed", "penalties_saved", "yellow_cards", "red_cards", "saves", "bonus"]


class Payloads:
    """``raw`` is the dict of raw tables that ``Warehouse`` takes."""

    def __init__(self, analogue):
        self.a = analogue
        self.spark, self.materialize = analogue.spark, analogue.materialize
        self.tag = analogue.tag + "-payloads"
        self.run = {"old": "run-1", "new": "run-2"}

    def _cells(self, df: DataFrame, path: str | None, order: str) -> DataFrame:
        cols = [c for c in df.columns if c != "__order"]
        packed = pack_json(df.withColumn("__order", F.col(order)), [], cols, "__order", CELL, path)
        return _landed(packed.select("payload"), NEW, self.run["new"])

    @cached_property
    def elements(self) -> DataFrame:
        names = {"id": "player_id", "code": "player_code", "first_name": "first_name", "second_name": "second_name",
                 "web_name": "web_name", "team": "team_id", "element_type": "position_id", "now_cost": "now_cost",
                 "total_points": "total_points", "form": "form", "selected_by_percent": "selected_by_percent",
                 "status": "status", "news": "news", "chance_of_playing_next_round": "chance_of_playing_next_round",
                 "chance_of_playing_this_round": "chance_of_playing_this_round",
                 "penalties_order": "current_penalties_order", "direct_freekicks_order": "direct_freekicks_order",
                 "corners_and_indirect_freekicks_order": "corners_order"}
        key = F.col("player_code")
        rows = self.a.source_players.withColumns({
            "now_cost": in_tenths("price"),
            "first_name": F.concat(F.lit("F"), (key % 50).cast("string")),
            "second_name": F.concat(F.lit("S"), (key % 70).cast("string")),
            "total_points": key % 250, "form": ((key % 100) / 10).cast("string"),
            "selected_by_percent": ((key % 1000) / 10).cast("string"),
            "news": F.when(key % 3 == 0, "injured").otherwise(""),
            "chance_of_playing_this_round": F.when(key % 23 == 0, 25),
            "current_penalties_order": F.when(key % 29 == 0, 1),
            "direct_freekicks_order": F.when(key % 31 == 0, 2), "corners_order": F.when(key % 37 == 0, 3)})
        return _renamed(rows, names)

    @mart
    def bootstrap(self) -> DataFrame:
        teams = _renamed(self.a.source_teams, {"id": "team_id", "code": "team_code", "name": "team_name",
                                               "short_name": "team_short_name", **{c: c for c in STRENGTHS},
                                               "position": "league_position", "points": "points"})
        events = _renamed(self.a.source_gameweeks.withColumns({
            "deadline": F.date_format(F.expr("timestampadd(DAY, 15 * (gameweek_id - 1), timestamp'2001-01-01 10:00:00')"),
                                      "yyyy-MM-dd'T'HH:mm:ss'Z'"),
            "average": F.col("gameweek_id") * 3 % 70, "highest": F.col("gameweek_id") * 7 % 150}),
            {"id": "gameweek_id", "name": "gameweek_name", "deadline_time": "deadline", "finished": "is_finished",
             "is_current": "is_current", "is_next": "is_next", "average_entry_score": "average",
             "highest_score": "highest"})
        rules = self.spark.createDataFrame(SQUAD_RULES, "id int, squad_select int, squad_min_play int, squad_max_play int")
        types = scoring_rules(self.spark).select(F.col("position_id").alias("id"), F.col("position_name").alias("singular_name")) \
            .join(rules, "id").withColumn("singular_name_short", F.upper(F.substring("singular_name", 1, 3)))
        present = self.a.source_players.select(F.col("position_id").alias("id")).distinct()
        parts = [self._cells(self.elements, "elements", "id"), self._cells(teams, "teams", "id"),
                 self._cells(events, "events", "id"), self._cells(types.join(present, "id", "left_semi"), "element_types", "id")]
        wrong = _landed(pack_json(self.elements.withColumn("now_cost", F.lit(1)), [], ["id", "code", "now_cost"], "id",
                                  CELL, "elements").select("payload"), OLD, self.run["old"])
        out = wrong
        for p in parts:
            out = out.unionByName(p)
        return out

    @mart
    def fixtures(self) -> DataFrame:
        k = F.col("fixture_id")
        rows = _renamed(self.a.source_fixtures.withColumns({
            "home_difficulty": k % 5 + 1, "away_difficulty": k % 4 + 1,
            "home_score": F.when(k % 2 == 0, k % 4), "away_score": F.when(k % 2 == 0, k % 3),
            "kickoff": F.date_format(F.expr("timestampadd(DAY, 15 * (gameweek_id - 1), timestamp'2001-01-01 15:00:00')"),
                                     "yyyy-MM-dd'T'HH:mm:ss'Z'"),
            "is_started": k % 2 == 0, "is_finished": k % 4 == 0, "provisional": k % 2 == 0}),
            {"id": "fixture_id", "event": "gameweek_id", "team_h": "home_team_id", "team_a": "away_team_id",
             "team_h_difficulty": "home_difficulty", "team_a_difficulty": "away_difficulty",
             "team_h_score": "home_score", "team_a_score": "away_score", "kickoff_time": "kickoff",
             "started": "is_started", "finished": "is_finished", "finished_provisional": "provisional"})
        wrong = _landed(pack_json(rows.withColumn("event", F.lit(99)), [], ["id", "event"], "id", CELL).select("payload"),
                        OLD, self.run["old"])
        return wrong.unionByName(self._cells(rows, None, "id"))

    def _keyed(self, new: DataFrame, keys: list[str]) -> DataFrame:
        """One payload per key and an older one with an empty object."""
        old = new.select(*keys, F.lit("{}").alias("payload"))
        return _landed(old, OLD, self.run["old"]).unionByName(_landed(new, NEW, self.run["new"]))

    @mart
    def element_summary(self) -> DataFrame:
        """Every player's rows of the current season (bounded by a season's rounds)."""
        perf = self.a.source_performance.where(F.col("is_current"))
        row = F.struct(F.col("fixture_id").alias("fixture"), F.col("gameweek_id").alias("round"),
                       F.col("opponent_id").alias("opponent_team"), "was_home", *MEASURES,
                       (F.col("fixture_id") % 100000).alias("selected"), (F.col("fixture_id") % 130 + 40).alias("value"))
        new = perf.groupBy(F.col("element").cast("int").alias("element_id")).agg(F.collect_list(row).alias("history"))
        return self._keyed(new.select("element_id", F.to_json(F.struct("history")).alias("payload")), ["element_id"])

    # --- managers
    @cached_property
    def manager_weeks(self) -> DataFrame:
        """The current season's weeks of every manager (the payload holds one season)."""
        return self.a.source_manager_weeks

    @mart
    def entry(self) -> DataFrame:
        k = F.col("entry_id")
        s = self.a.t("supplier").select(F.col("s_suppkey").cast("int").alias("entry_id"), "s_name", "s_nationkey", "s_acctbal")
        new = s.select("entry_id", F.to_json(F.struct(
            F.concat(F.lit("M"), k.cast("string")).alias("player_first_name"), F.col("s_name").alias("player_last_name"),
            F.concat(F.lit("Team "), k.cast("string")).alias("name"), (F.col("s_nationkey") + 1).alias("favourite_team"),
            F.floor("s_acctbal").alias("summary_overall_points"), (k * 7919).alias("summary_overall_rank"),
            F.lit(15).alias("current_event"))).alias("payload"))
        return self._keyed(new, ["entry_id"])

    @mart
    def entry_history(self) -> DataFrame:
        week = F.struct(F.col("gameweek_id").alias("event"), "points", F.col("points").alias("total_points"),
                        (F.col("points") * 11).alias("rank"), (F.col("points") * 13).alias("overall_rank"),
                        (F.col("points") % 50).alias("bank"), (F.col("points") % 200 + 900).alias("value"),
                        F.col("transfers_made").alias("event_transfers"),
                        (F.col("transfers_made") * 4).alias("event_transfers_cost"),
                        (F.col("points") % 20).alias("points_on_bench"))
        k = F.col("entry_id")
        new = self.manager_weeks.groupBy("entry_id").agg(F.collect_list(week).alias("current")).select(
            F.col("entry_id").cast("int").alias("entry_id"), F.to_json(F.struct(
                "current", F.array(*[F.struct(F.lit(f"{y}/{(y + 1) % 100:02d}").alias("season_name"),
                                              (k * 3 + y).alias("total_points"), (k * 5 + y).alias("rank"))
                                     for y in (1999, 2000)]).alias("past"),
                F.array(F.struct(F.lit("wildcard").alias("name"), (k % 15 + 1).alias("event"),
                                 F.lit("2001-03-01T10:00:00Z").alias("time"))).alias("chips"))).alias("payload"))
        return self._keyed(new, ["entry_id"])

    @mart
    def entry_picks(self) -> DataFrame:
        """Two weeks of picks per manager: the latest real ones and a week before
        with one player less."""
        picks = self.a.picks.join(self.a.source_players.select("player_code", "player_id"), "player_code")
        pick = F.struct(F.col("player_id").alias("element"), F.col("slot").alias("position"),
                        F.when(F.col("slot") == 1, 2).otherwise(1).alias("multiplier"),
                        (F.col("slot") == 1).alias("is_captain"), (F.col("slot") == 2).alias("is_vice_captain"))
        summary = F.struct((F.col("entry_id") % 30).alias("bank"), (F.col("entry_id") % 90 + 950).alias("value"),
                           (F.col("entry_id") % 3).alias("event_transfers"), F.lit(0).alias("event_transfers_cost"),
                           (F.col("entry_id") % 25).alias("points_on_bench"), (F.col("entry_id") % 99).alias("points"),
                           (F.col("entry_id") * 2).alias("total_points"), (F.col("entry_id") * 17).alias("overall_rank"))

        def week(rows, event):
            return rows.groupBy("entry_id").agg(F.collect_list(pick).alias("picks")).select(
                F.col("entry_id").cast("int").alias("entry_id"), F.lit(event).alias("event_id"),
                F.to_json(F.struct("picks", F.when(F.col("entry_id") % 4 == 0, "bboost").alias("active_chip"),
                                   summary.alias("entry_history"))).alias("payload"))
        both = week(picks, 15).unionByName(week(picks.where("slot > 1"), 14))
        return self._keyed(both, ["entry_id", "event_id"])

    @mart
    def entry_transfers(self) -> DataFrame:
        picks = self.a.picks.join(self.a.source_players.select("player_code", "player_id", "price"), "player_code")
        ins = picks.where("slot = 1").select("entry_id", "position_id", F.col("player_id").alias("i"), in_tenths("price").alias("ic"))
        outs = picks.where("slot = 2").select("entry_id", "position_id", F.col("player_id").alias("o"), in_tenths("price").alias("oc"))
        row = F.struct((F.col("position_id") + 10).alias("event"), F.col("i").alias("element_in"),
                       (F.col("ic") - F.col("position_id")).alias("element_in_cost"), F.col("o").alias("element_out"),
                       F.col("oc").alias("element_out_cost"),
                       F.concat(F.lit("2001-05-0"), F.col("position_id").cast("string"), F.lit("T10:00:00Z")).alias("time"))
        new = ins.join(outs, ["entry_id", "position_id"]).groupBy("entry_id").agg(F.to_json(F.collect_list(row)).alias("payload"))
        return self._keyed(new.select(F.col("entry_id").cast("int").alias("entry_id"), "payload"), ["entry_id"])

    # --- archive files
    def _csv(self, df: DataFrame, name: str, **landing) -> DataFrame:
        """Written as CSV files per season (several each), landed from there; an
        older landing run of one row per season lies beside it."""
        path = scratch_path(self.spark, f"csv/{self.tag}/{name}-{new_run_id()}")
        df.write.partitionBy("season").csv(path, header=True)
        fresh = land_csv(self.spark, path, fetched_at=NEW, run_id=self.run["new"], **landing)
        # the seasons are the written folders': ``df`` is not computed again for them
        stale = fresh.groupBy("season").agg(F.lit("{}").alias("payload"))
        return fresh.unionByName(_landed(stale, OLD, self.run["old"]).select(fresh.columns))

    @mart
    def historical_players(self) -> DataFrame:
        rows = self.a.source_historical_players.withColumns({
            "position": F.col("position_id").cast("string"), "cost": (F.col("player_code") % 91 + 40).cast("string"),
            "first_name": F.concat(F.lit("F"), (F.col("player_code") % 50).cast("string")),
            "second_name": F.concat(F.lit("S"), (F.col("player_code") % 70).cast("string")),
            "points": F.when(F.col("player_code") % 5 == 0, "").otherwise((F.col("player_code") % 200).cast("string"))})
        named = rows.select(
            "season", F.col("player_id").alias("id"), F.col("player_code").alias("code"), "first_name", "second_name",
            "web_name", F.lit(1).alias("team"), F.col("position").alias("element_type"), F.col("cost").alias("now_cost"),
            F.col("points").alias("total_points"), F.col("raw_order").alias("penalties_order"))
        return self._csv(named, "players")

    @mart
    def historical_teams(self) -> DataFrame:
        rows = self.a.source_historical_teams.select(
            "season", F.col("team_id").alias("id"), F.col("team_code").alias("code"), F.col("team_name").alias("name"),
            F.col("team_short_name").alias("short_name"), *STRENGTHS)
        return self._csv(rows, "teams", as_cell=True, cell_rows=7)

    @mart
    def historical_stats(self) -> DataFrame:
        perf = self.a.source_performance.where(~F.col("is_current"))
        names = self.a.source_historical_players.select("season", F.col("player_id").alias("element"), "web_name", "team_name")
        rows = perf.join(names, ["season", "element"]).select(
            "season", "element", F.col("web_name").alias("name"), F.lit("MID").alias("position"),
            F.col("team_name").alias("team"), F.col("gameweek_id").alias("round"), F.col("fixture_id").alias("fixture"),
            F.col("opponent_id").alias("opponent_team"), "was_home", *MEASURES,
            (F.col("fixture_id") % 130 + 40).alias("value"), (F.col("fixture_id") % 100000).alias("selected"))
        return self._csv(rows, "stats")

    @cached_property
    def raw(self) -> Mapping[str, DataFrame]:
        return _Lazy({"bootstrap_static_snapshot": "bootstrap", "fixtures_snapshot": "fixtures",
                      "element_summary_snapshot": "element_summary", "entry_snapshot": "entry",
                      "entry_history_snapshot": "entry_history", "entry_picks_snapshot": "entry_picks",
                      "entry_transfers_snapshot": "entry_transfers",
                      "historical_gw_stats_snapshot": "historical_stats",
                      "historical_players_snapshot": "historical_players",
                      "historical_teams_snapshot": "historical_teams"}, self)


class _Lazy(Mapping):
    """Raw tables that are built when a model first asks for them."""

    def __init__(self, names: dict[str, str], owner: Payloads):
        self.names, self.owner = names, owner

    def __getitem__(self, key):
        return getattr(self.owner, self.names[key])

    def __iter__(self):
        return iter(self.names)

    def __len__(self):
        return len(self.names)
