"""STG-1..16: latest snapshot -> unnested, typed staging frames.

Each raw table is ``(key columns..., fetched_at, payload)`` plus either

* ``run_id``: rows of one landing call share it. A payload may then be landed in
  any number of rows or cells; staging keeps ALL rows of each key's newest run
  (greatest ``fetched_at``, then ``run_id``); or
* ``id`` only (one payload per row): ``id`` is the declared tie-break for equal
  ``fetched_at`` (T1), and staging keeps that one row.

With neither, all rows of a key's greatest ``fetched_at`` are one run. Whole-file payloads
also have ``file``: a run may then hold several payloads of a key, of which staging keeps the one of the
greatest (``fetched_at``, ``run_id``, ``file``). A payload
that holds one whole array explodes inside one task; land it in cells, or pass
``partitions`` to spread its rows again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaffer.operators.nested import documents, parse_json, unnest_documents, unnest_json
from gaffer.operators.snapshots import latest, latest_per_key, newest_run
from gaffer.sources import schemas as S


def newest(raw: DataFrame, keys: Sequence[str] = (), few: bool = False) -> DataFrame:
    """The payload rows that staging reads: each key's newest run (``few``: see :func:`newest_run`)."""
    if "id" in raw.columns and "run_id" not in raw.columns:
        order = ["fetched_at", "id"]
        return latest_per_key(raw, list(keys), order) if keys else latest(raw, order)
    return newest_run(raw, list(keys), [c for c in ("fetched_at", "run_id", "file") if c in raw.columns], few)


def _spread(df: DataFrame, partitions: int | None) -> DataFrame:
    return df.repartition(partitions) if partitions else df


def bootstrap_documents(bootstrap: DataFrame) -> DataFrame:
    """The newest bootstrap payload parsed once, for the four models that read it."""
    return documents(newest(bootstrap))


def _bootstrap(bootstrap: DataFrame, fields: dict, path: str) -> DataFrame:
    """An array of the raw bootstrap table, or of its parsed documents."""
    if "doc" in bootstrap.columns:
        return unnest_documents(bootstrap, fields, path)
    return unnest_json(newest(bootstrap), "payload", fields, path=path)


def stg_players(bootstrap: DataFrame, partitions: int | None = None) -> DataFrame:
    return _spread(_bootstrap(bootstrap, S.PLAYERS, "elements"), partitions)


def stg_teams(bootstrap: DataFrame) -> DataFrame:
    return _bootstrap(bootstrap, S.TEAMS, "teams")


def stg_gameweeks(bootstrap: DataFrame) -> DataFrame:
    return _bootstrap(bootstrap, S.GAMEWEEKS, "events")


def stg_positions(bootstrap: DataFrame) -> DataFrame:
    return _bootstrap(bootstrap, S.POSITIONS, "element_types")


def stg_fixtures(fixtures: DataFrame) -> DataFrame:
    return unnest_json(newest(fixtures), "payload", S.FIXTURES)


def stg_player_gameweek_history(element_summary: DataFrame) -> DataFrame:
    snap = newest(element_summary, ["element_id"]) \
        .withColumn("player_id", F.col("element_id").cast("int"))
    return unnest_json(snap, "payload", S.PLAYER_GAMEWEEK_HISTORY, path="history", carry=["player_id"])


def stg_entries(entry: DataFrame) -> DataFrame:
    snap = newest(entry, ["entry_id"])
    return parse_json(snap, "payload", S.ENTRIES, carry=["entry_id", "fetched_at"])


def _entry_history(history: DataFrame, spec: dict, path: str) -> DataFrame:
    snap = newest(history, ["entry_id"])
    return unnest_json(snap, "payload", spec, path=path, carry=["entry_id"])


def stg_entry_gameweek_history(history: DataFrame) -> DataFrame:
    return _entry_history(history, S.ENTRY_GAMEWEEK_HISTORY, "current")


def stg_entry_season_history(history: DataFrame) -> DataFrame:
    return _entry_history(history, S.ENTRY_SEASON_HISTORY, "past")


def stg_entry_chips(history: DataFrame) -> DataFrame:
    return _entry_history(history, S.ENTRY_CHIPS, "chips")


def stg_entry_picks(picks: DataFrame) -> DataFrame:
    snap = newest(picks, ["entry_id", "event_id"]) \
        .withColumn("gameweek_id", F.col("event_id").cast("int"))
    return unnest_json(snap, "payload", S.ENTRY_PICKS, path="picks", carry=["entry_id", "gameweek_id"])


def stg_entry_picks_summary(picks: DataFrame) -> DataFrame:
    snap = newest(picks, ["entry_id", "event_id"]) \
        .withColumn("gameweek_id", F.col("event_id").cast("int"))
    return parse_json(snap, "payload", S.ENTRY_PICKS_SUMMARY, carry=["entry_id", "gameweek_id"])


def stg_entry_transfers(transfers: DataFrame) -> DataFrame:
    snap = newest(transfers, ["entry_id"])
    return unnest_json(snap, "payload", S.ENTRY_TRANSFERS, carry=["entry_id"])


def _by_season(raw: DataFrame, spec: dict) -> DataFrame:
    snap = newest(raw, ["season"], few=True)
    return unnest_json(snap, "payload", spec, carry=["season"])


def stg_historical_players(raw: DataFrame) -> DataFrame:
    return _by_season(raw, S.HISTORICAL_PLAYERS)


def stg_historical_teams(raw: DataFrame) -> DataFrame:
    return _by_season(raw, S.HISTORICAL_TEAMS)


def stg_historical_player_gameweek_stats(raw: DataFrame) -> DataFrame:
    return _by_season(raw, S.HISTORICAL_GW_STATS)
