"""Raw payload field specs for the staging models (schema-on-read).

Each spec maps output column -> (JSON path, type, cleaner). Types are Spark
SQL type names or a Column function (``PRICE`` = integer tenths -> decimal).
Leaves are read as STRING and cast, so numbers, strings and booleans in the
payload all land the same way; an absent key gives NULL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gaffer.functions.scalars import blank_to_null, sentinel_to_null


def PRICE(c):  # noqa: N802 - a type in the spec tables
    """Integer tenths (``55``) -> decimal units (``5.5``)."""
    return (c.cast("decimal(10,1)") / F.lit(10)).cast("decimal(6,1)")


B, S = blank_to_null, sentinel_to_null
I, L, D, T, BO, TS = "int", "bigint", "double", "string", "boolean", "timestamp"


def _spec(rows, cleaner=None):
    return {out: (path, typ, cl if cl is not None else cleaner) for path, typ, out, cl in rows}


# Payload field -> output column, per staging model.
PLAYERS = _spec([
    ("id", I, "player_id", None), ("code", I, "player_code", None),
    ("first_name", T, "first_name", None), ("second_name", T, "second_name", None),
    ("web_name", T, "web_name", None), ("team", I, "team_id", None),
    ("element_type", I, "position_id", None), ("now_cost", PRICE, "price", None),
    ("total_points", I, "total_points", None), ("points_per_game", D, "points_per_game", None),
    ("form", D, "form", None), ("selected_by_percent", D, "selected_by_percent", None),
    ("status", T, "status", None), ("news", T, "news", B),
    ("chance_of_playing_next_round", I, "chance_of_playing_next_round", None),
    ("chance_of_playing_this_round", I, "chance_of_playing_this_round", None),
    ("minutes", I, "minutes", None), ("goals_scored", I, "goals_scored", None),
    ("assists", I, "assists", None), ("clean_sheets", I, "clean_sheets", None),
    ("goals_conceded", I, "goals_conceded", None), ("own_goals", I, "own_goals", None),
    ("penalties_saved", I, "penalties_saved", None), ("penalties_missed", I, "penalties_missed", None),
    ("yellow_cards", I, "yellow_cards", None), ("red_cards", I, "red_cards", None),
    ("saves", I, "saves", None), ("bonus", I, "bonus", None), ("bps", I, "bps", None),
    ("influence", D, "influence", None), ("creativity", D, "creativity", None),
    ("threat", D, "threat", None), ("ict_index", D, "ict_index", None), ("starts", I, "starts", None),
    ("expected_goals", D, "expected_goals", None), ("expected_assists", D, "expected_assists", None),
    ("expected_goal_involvements", D, "expected_goal_involvements", None),
    ("expected_goals_conceded", D, "expected_goals_conceded", None),
    ("transfers_in_event", I, "transfers_in_event", None),
    ("transfers_out_event", I, "transfers_out_event", None),
    ("penalties_order", I, "penalties_order", None),
    ("direct_freekicks_order", I, "direct_freekicks_order", None),
    ("corners_and_indirect_freekicks_order", I, "corners_and_indirect_freekicks_order", None),
])

TEAMS = _spec([
    ("id", I, "team_id", None), ("code", I, "team_code", None), ("name", T, "team_name", None),
    ("short_name", T, "team_short_name", None), ("strength", I, "strength", None),
    ("strength_overall_home", I, "strength_overall_home", None),
    ("strength_overall_away", I, "strength_overall_away", None),
    ("strength_attack_home", I, "strength_attack_home", None),
    ("strength_attack_away", I, "strength_attack_away", None),
    ("strength_defence_home", I, "strength_defence_home", None),
    ("strength_defence_away", I, "strength_defence_away", None),
    ("played", I, "played", None), ("position", I, "league_position", None), ("points", I, "points", None),
])

GAMEWEEKS = _spec([
    ("id", I, "gameweek_id", None), ("name", T, "gameweek_name", None),
    ("deadline_time", TS, "deadline_time", None), ("finished", BO, "is_finished", None),
    ("is_current", BO, "is_current", None), ("is_next", BO, "is_next", None),
    ("average_entry_score", I, "average_entry_score", None), ("highest_score", I, "highest_score", None),
])

POSITIONS = _spec([
    ("id", I, "position_id", None), ("singular_name", T, "position_name", None),
    ("singular_name_short", T, "position_name_short", None), ("squad_select", I, "squad_select", None),
    ("squad_min_play", I, "squad_min_play", None), ("squad_max_play", I, "squad_max_play", None),
])

FIXTURES = _spec([
    ("id", I, "fixture_id", None), ("event", I, "gameweek_id", None), ("team_h", I, "home_team_id", None),
    ("team_a", I, "away_team_id", None), ("team_h_difficulty", I, "home_team_difficulty", None),
    ("team_a_difficulty", I, "away_team_difficulty", None), ("team_h_score", I, "home_team_score", None),
    ("team_a_score", I, "away_team_score", None), ("kickoff_time", TS, "kickoff_time", None),
    ("started", BO, "is_started", None), ("finished", BO, "is_finished", None),
    ("finished_provisional", BO, "is_finished_provisional", None),
])

_GW_STATS = [
    ("total_points", I, "total_points", None), ("minutes", I, "minutes", None), ("starts", I, "starts", None),
    ("goals_scored", I, "goals_scored", None), ("assists", I, "assists", None),
    ("clean_sheets", I, "clean_sheets", None), ("goals_conceded", I, "goals_conceded", None),
    ("own_goals", I, "own_goals", None), ("penalties_missed", I, "penalties_missed", None),
    ("penalties_saved", I, "penalties_saved", None), ("yellow_cards", I, "yellow_cards", None),
    ("red_cards", I, "red_cards", None), ("saves", I, "saves", None), ("bonus", I, "bonus", None),
    ("bps", I, "bps", None), ("influence", D, "influence", None), ("creativity", D, "creativity", None),
    ("threat", D, "threat", None), ("ict_index", D, "ict_index", None),
    ("expected_goals", D, "expected_goals", None), ("expected_assists", D, "expected_assists", None),
    ("expected_goal_involvements", D, "expected_goal_involvements", None),
    ("expected_goals_conceded", D, "expected_goals_conceded", None),
]

PLAYER_GAMEWEEK_HISTORY = _spec([
    ("fixture", I, "fixture_id", None), ("round", I, "gameweek_id", None),
    ("opponent_team", I, "opponent_team_id", None), ("was_home", BO, "was_home", None),
    *_GW_STATS,
    ("selected", L, "selected_by_count", None), ("transfers_in", I, "transfers_in", None),
    ("transfers_out", I, "transfers_out", None), ("value", PRICE, "price_at_gameweek", None),
])

ENTRIES = _spec([
    ("player_first_name", T, "manager_first_name", None), ("player_last_name", T, "manager_last_name", None),
    ("name", T, "team_name", None), ("favourite_team", I, "favourite_team_id", None),
    ("summary_overall_points", I, "overall_points", None), ("summary_overall_rank", L, "overall_rank", None),
    ("current_event", I, "current_event", None),
])

ENTRY_GAMEWEEK_HISTORY = _spec([
    ("event", I, "gameweek_id", None), ("points", I, "points", None), ("total_points", I, "total_points", None),
    ("rank", L, "gameweek_rank", None), ("overall_rank", L, "overall_rank", None),
    ("bank", PRICE, "bank", None), ("value", PRICE, "team_value", None),
    ("event_transfers", I, "transfers_made", None), ("event_transfers_cost", I, "transfers_cost", None),
    ("points_on_bench", I, "points_on_bench", None),
])

ENTRY_SEASON_HISTORY = _spec([
    ("season_name", T, "season_name", None), ("total_points", I, "total_points", None),
    ("rank", L, "season_rank", None),
])

ENTRY_CHIPS = _spec([("name", T, "chip_name", None), ("event", I, "gameweek_id", None),
                     ("time", TS, "played_at", None)])

ENTRY_PICKS = _spec([
    ("element", I, "player_id", None), ("position", I, "squad_position", None),
    ("multiplier", I, "multiplier", None), ("is_captain", BO, "is_captain", None),
    ("is_vice_captain", BO, "is_vice_captain", None),
])

ENTRY_PICKS_SUMMARY = _spec([
    ("active_chip", T, "active_chip", None), ("entry_history.bank", PRICE, "bank", None),
    ("entry_history.value", PRICE, "team_value", None),
    ("entry_history.event_transfers", I, "transfers_made", None),
    ("entry_history.event_transfers_cost", I, "transfers_cost", None),
    ("entry_history.points_on_bench", I, "points_on_bench", None),
    ("entry_history.points", I, "gameweek_points", None),
    ("entry_history.total_points", I, "total_points", None),
    ("entry_history.overall_rank", L, "overall_rank", None),
])

ENTRY_TRANSFERS = _spec([
    ("event", I, "gameweek_id", None), ("element_in", I, "player_in_id", None),
    ("element_in_cost", PRICE, "player_in_cost", None), ("element_out", I, "player_out_id", None),
    ("element_out_cost", PRICE, "player_out_cost", None), ("time", TS, "transferred_at", None),
])

HISTORICAL_PLAYERS = _spec([
    ("id", I, "season_player_id", None), ("code", I, "player_code", B),
    ("first_name", T, "first_name", None), ("second_name", T, "second_name", None),
    ("web_name", T, "web_name", None), ("team", I, "season_team_id", B),
    ("element_type", I, "position_id", B), ("now_cost", PRICE, "end_of_season_price", B),
    ("total_points", I, "total_points", B), ("minutes", I, "minutes", B),
    ("penalties_order", I, "penalties_order", S),
    ("direct_freekicks_order", I, "direct_freekicks_order", S),
    ("corners_and_indirect_freekicks_order", I, "corners_and_indirect_freekicks_order", S),
])

HISTORICAL_TEAMS = _spec([
    ("id", I, "season_team_id", None), ("code", I, "team_code", None), ("name", T, "team_name", None),
    ("short_name", T, "team_short_name", None), ("strength", I, "strength", B),
    ("strength_overall_home", I, "strength_overall_home", B),
    ("strength_overall_away", I, "strength_overall_away", B),
    ("strength_attack_home", I, "strength_attack_home", B),
    ("strength_attack_away", I, "strength_attack_away", B),
    ("strength_defence_home", I, "strength_defence_home", B),
    ("strength_defence_away", I, "strength_defence_away", B),
])

HISTORICAL_GW_STATS = _spec([
    ("element", I, "season_player_id", None), ("name", T, "player_name", None),
    ("position", T, "position_name", None), ("team", T, "team_name", None),
    ("round", I, "gameweek_id", B), ("fixture", I, "fixture_id", B),
    ("opponent_team", I, "opponent_team_id", B), ("was_home", BO, "was_home", B),
    ("kickoff_time", TS, "kickoff_time", B),
    *[(p, t, o, B) for p, t, o, _ in _GW_STATS],
    ("xP", D, "expected_points", B), ("value", PRICE, "price_at_gameweek", B),
    ("selected", L, "selected_by_count", B), ("transfers_in", I, "transfers_in", B),
    ("transfers_out", I, "transfers_out", B), ("transfers_balance", I, "transfers_balance", B),
])
