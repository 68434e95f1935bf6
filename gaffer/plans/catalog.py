"""Registered queries: one per operator family of the inventory, each run
over whole driver tables, with its DuckDB oracle SQL.

``QUERIES[name] = (build(spark, sf_dir) -> DataFrame, oracle_sql | None)``.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaffer.functions.formulas import recency_weight
from gaffer.functions.scalars import (
    blank_to_null, safe_div, season_label, season_year, sell_value_tenths, sentinel_to_null,
    tenths, zero_to_null,
)
from gaffer.operators import nested, snapshots
from gaffer.plans import oracle as O
from gaffer.operators.decisions import HORIZON_DETAIL, WILDCARD_DETAIL
from gaffer.plans.analogue import CURRENT_YEAR, FRONTIER_BUDGET_TENTHS, LAMBDAS, Analogue, period_of
from gaffer.plans.normalize import normalize
from gaffer.plans.warehouse import DATA_TESTS
from gaffer.session import scratch_path

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = (lambda spark, d: normalize(fn(spark, d)), sql)
        return fn
    return deco


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


def _events_k(spark, d):
    ev = _t(spark, d, "events")
    return nested.parse_json(ev, "props", {"k": ("k", "int")},
                             carry=["event_id", "ts", "user_id", "event_type", "value"])


# ---------------------------------------------------------------- SEL
@register("latest_snapshot_overall", """
  SELECT event_id, user_id, event_type, round(value, 6) AS value,
    CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS BIGINT) AS k
  FROM events ORDER BY ts DESC, event_id DESC LIMIT 1""")
def q_latest_overall(spark, d):
    return snapshots.latest(_events_k(spark, d), ["ts", "event_id"]) \
        .select("event_id", "user_id", "event_type", "value", "k")


_LPK = """
  SELECT {keys}, event_id, event_type, round(value, 6) AS value,
    CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS BIGINT) AS k,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS fetched_at
  FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY ts DESC, event_id DESC) AS rn
        FROM events) WHERE rn = 1"""


@register("latest_snapshot_per_key", _LPK.format(keys="user_id"))
def q_latest_per_key(spark, d):
    df = snapshots.latest_per_key(_events_k(spark, d), ["user_id"], ["ts", "event_id"])
    return df.select("user_id", "event_id", "event_type", "value", "k", F.col("ts").alias("fetched_at"))


@register("latest_snapshot_composite_key",
          _LPK.format(keys="user_id, event_type").replace("event_id, event_type,", "event_id,", 1))
def q_latest_composite(spark, d):
    df = snapshots.latest_per_key(_events_k(spark, d), ["user_id", "event_type"], ["ts", "event_id"])
    return df.select("user_id", "event_type", "event_id", "value", "k", F.col("ts").alias("fetched_at"))


@register("latest_run_rows", """
  SELECT o_orderkey, o_custkey, round(o_totalprice, 6) AS o_totalprice FROM orders
  WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)""")
def q_latest_run(spark, d):
    return snapshots.latest_run(_t(spark, d, "orders"), "o_orderdate") \
        .select("o_orderkey", "o_custkey", "o_totalprice")


@register("latest_period_per_entity", f"""
  SELECT o_custkey, o_orderkey, period_key FROM (
    SELECT o_custkey, o_orderkey, year(o_orderdate) * 100 + {O.period_sql('o_orderdate')} AS period_key,
      rank() OVER (PARTITION BY o_custkey ORDER BY year(o_orderdate) * 100 + {O.period_sql('o_orderdate')} DESC) AS rk
    FROM orders) WHERE rk = 1""")
def q_latest_period(spark, d):
    o = _t(spark, d, "orders").select(
        "o_custkey", "o_orderkey",
        (F.year("o_orderdate") * 100 + period_of(F.col("o_orderdate"))).alias("period_key"))
    return snapshots.latest_period(o, ["o_custkey"], "period_key")


@register("last_event_lookup", """
  SELECT c.c_custkey, l.o_orderkey AS last_orderkey, round(l.o_totalprice, 6) AS last_price,
    round(coalesce(l.o_totalprice, c.c_acctbal), 6) AS price
  FROM customer c LEFT JOIN (
    SELECT * FROM (
      SELECT o_custkey, o_orderkey, o_totalprice,
        row_number() OVER (PARTITION BY o_custkey ORDER BY
          CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderdate END DESC NULLS FIRST, o_orderkey DESC) AS rn
      FROM orders) WHERE rn = 1) l ON c.c_custkey = l.o_custkey""")
def q_last_event(spark, d):
    o = _t(spark, d, "orders")
    ts = F.when(F.col("o_orderkey") % 97 == 0, F.lit(None)).otherwise(F.col("o_orderdate")).alias("ts")
    ev = o.select("o_custkey", "o_orderkey", "o_totalprice", ts)
    last = snapshots.last_event(ev, ["o_custkey"], [F.col("ts").desc_nulls_first(),
                                                    F.col("o_orderkey").desc()])
    c = _t(spark, d, "customer")
    j = c.join(last, c.c_custkey == last.o_custkey, "left")
    return j.select("c_custkey", F.col("o_orderkey").alias("last_orderkey"),
                    F.col("o_totalprice").alias("last_price"),
                    F.coalesce("o_totalprice", "c_acctbal").alias("price"))


@register("snapshot_changes", """
  SELECT event_id, user_id, round(value, 6) AS value, round(prev_value, 6) AS prev_value,
    round(value - prev_value, 6) AS delta_value
  FROM (SELECT event_id, user_id, value,
          lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_value FROM events)""")
def q_snapshot_changes(spark, d):
    ev = _t(spark, d, "events")
    return snapshots.snapshot_changes(ev, ["user_id"], "ts", ["value"], tiebreak="event_id") \
        .select("event_id", "user_id", "value", "prev_value", "delta_value")


# A user's state is the kind of the last event.
@register("validity_intervals", """
  SELECT user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS valid_from,
    strftime(lead(ts) OVER w, '%Y-%m-%d %H:%M:%S') AS valid_to
  FROM (SELECT * FROM events
        WINDOW w AS (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id)
        QUALIFY event_type IS DISTINCT FROM lag(event_type) OVER w OR row_number() OVER w = 1)
  WINDOW w AS (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id)""")
def q_validity_intervals(spark, d):
    """SEL-8: equal consecutive snapshots collapsed into intervals."""
    from gaffer.operators.validity import validity_intervals
    return validity_intervals(_t(spark, d, "events"), ["user_id"], "ts", ["event_type"], "event_id")


@register("state_as_of", """
  SELECT f.event_id, f.user_id, s.event_type, strftime(s.ts, '%Y-%m-%d %H:%M:%S') AS valid_from
  FROM (SELECT event_id, user_id, ts - INTERVAL 36 HOUR AS at FROM events) f
  ASOF LEFT JOIN (
    SELECT * FROM (SELECT * FROM events
      WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
      QUALIFY event_type IS DISTINCT FROM lag(event_type) OVER w OR row_number() OVER w = 1)
    QUALIFY ts IS DISTINCT FROM lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) s
  ON f.user_id = s.user_id AND f.at >= s.ts""")
def q_state_as_of(spark, d):
    """SEL-8: each event's user as of 36 hours before."""
    from gaffer.operators.validity import as_of, validity_intervals
    events = _t(spark, d, "events")
    intervals = validity_intervals(events, ["user_id"], "ts", ["event_type"], "event_id")
    facts = events.select("event_id", "user_id", (F.col("ts") - F.expr("INTERVAL 36 HOURS")).alias("at"))
    return as_of(facts, intervals, ["user_id"], "at", ["event_type"]).select("event_id", "user_id", "event_type", "valid_from")


@register("latest_clustered", _LPK.format(keys="user_id"))
def q_latest_clustered(spark, d):
    """SEL-2a on clustered storage: no exchange between the table and the latest rows."""
    from gaffer.sources.clustered import create_clustered
    name = "events_" + uuid.uuid4().hex[:12]
    table = create_clustered(_events_k(spark, d), name, scratch_path(spark, name), ["user_id"], ["ts", "event_id"], 8)
    return snapshots.latest_per_key(table, ["user_id"], ["ts", "event_id"]) \
        .select("user_id", "event_id", "event_type", "value", "k", F.col("ts").alias("fetched_at"))


@register("landed_incrementally", "SELECT conv_id, turn, role FROM conversations")
def q_landed_incrementally(spark, d):
    """SRC-1, SRC-6, SNK-1: two drops of JSON payloads, landed by a run each and once more
    with nothing new; the first drop holds an old state of every key."""
    from gaffer.sources import incremental
    conv = _t(spark, d, "conversations")
    base = scratch_path(spark, "landing-" + uuid.uuid4().hex)
    cell = F.floor(F.col("turn") / 64).alias("cell")
    new = conv.groupBy("conv_id", cell).agg(F.collect_list(F.struct("turn", "role")).alias("turns"))
    old = conv.select("conv_id", cell, F.array(F.struct(F.lit(0), F.lit("nobody"))).alias("turns")).distinct()

    def run():
        stream = incremental.json_files(spark, f"{base}/in", {"conv_id": "long", "cell": "long"}, whole_file=False, glob="*.json")
        return incremental.land_new(stream, f"{base}/table", f"{base}/checkpoint")
    for number, drop in enumerate((old, new)):
        drop.write.json(f"{base}/in/drop={number}")
        run()
    if run():
        raise RuntimeError("a run without new files landed rows")
    rows = snapshots.newest_run(incremental.landed(spark, f"{base}/table"), ["conv_id", "cell"], incremental.NEWEST)
    return nested.unnest_json(rows, "payload", {"turn": ("turn", "bigint"), "role": ("role", "string")}, path="turns",
                              carry=["conv_id"]).select("conv_id", "turn", "role")


# ---------------------------------------------------------------- JSN / SCL
@register("json_field_cast", """
  SELECT event_id, user_id, CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS BIGINT) AS k,
    CAST(json_extract_string(props, '$.k') AS INTEGER) / 10.0 AS k_tenths
  FROM events""")
def q_json_field_cast(spark, d):
    df = nested.parse_json(_t(spark, d, "events"), "props", {"k": ("k", "int")},
                           carry=["event_id", "user_id"])
    return df.select("event_id", "user_id", "k", tenths("k").alias("k_tenths"))


@register("json_array_unnest", "SELECT conv_id, turn, role, text FROM conversations")
def q_json_array_unnest(spark, d):
    conv = _t(spark, d, "conversations")
    cells = nested.pack_json(conv, ["conv_id"], ["turn", "role", "text"], "turn", path="turns")
    return nested.unnest_json(cells, "payload",
                              {"turn": ("turn", "bigint"), "role": ("role", "string"),
                               "text": ("text", "string")},
                              path="turns", carry=["conv_id"])


@register("json_root_array_unnest",
          "SELECT conv_id, turn, role, CAST(length(text) AS BIGINT) AS n_chars FROM conversations")
def q_json_root_unnest(spark, d):
    conv = _t(spark, d, "conversations")
    cells = nested.pack_json(conv, ["conv_id"], ["turn", "role", "text"], "turn")
    rows = nested.unnest_json(cells, "payload",
                              {"turn": ("turn", "bigint"), "role": ("role", "string"),
                               "text": ("text", "string")}, carry=["conv_id"])
    return rows.select("conv_id", "turn", "role", F.length("text").alias("n_chars"))


@register("landing_counts", """
  SELECT conv_id, cell, CAST(count(*) AS BIGINT) AS n_turns
  FROM (SELECT conv_id, CAST(floor(turn / 64) AS BIGINT) AS cell FROM conversations)
  GROUP BY conv_id, cell""")
def q_landing_counts(spark, d):
    conv = _t(spark, d, "conversations")
    cells = nested.pack_json(conv, ["conv_id"], ["turn", "role"], "turn", path="turns")
    return nested.array_sizes(cells, "payload", ["turns"]) \
        .select("conv_id", F.col("__cell").alias("cell"), F.col("n_turns"))


@register("json_nested_path", """
  SELECT event_id, CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS BIGINT) AS k,
    event_type AS type, user_id FROM events""")
def q_json_nested(spark, d):
    ev = _events_k(spark, d)
    packed = ev.select("event_id", F.to_json(F.struct(
        F.struct(F.col("k"), F.col("event_type").alias("type")).alias("meta"),
        F.col("user_id"))).alias("payload"))
    return nested.parse_json(packed, "payload",
                             {"k": ("meta.k", "int"), "type": ("meta.type", "string"),
                              "user_id": ("user_id", "bigint")}, carry=["event_id"])


@register("sentinel_cleaning", """
  SELECT o_orderkey,
    CAST(CAST(nullif(nullif(CASE WHEN o_orderkey % 7 = 0 THEN '' WHEN o_orderkey % 11 = 0 THEN 'None'
         ELSE substr(o_orderpriority, 1, 1) END, ''), 'None') AS INTEGER) AS BIGINT) AS priority_num,
    nullif(CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END, '') AS status,
    CAST(nullif(o_orderkey % 5, 0) AS BIGINT) AS bucket
  FROM orders""")
def q_sentinel(spark, d):
    o = _t(spark, d, "orders")
    k = F.col("o_orderkey")
    raw = F.when(k % 7 == 0, "").when(k % 11 == 0, "None").otherwise(F.substring("o_orderpriority", 1, 1))
    st = F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus"))
    return o.select("o_orderkey", sentinel_to_null(raw).cast("int").alias("priority_num"),
                    blank_to_null(st).alias("status"), zero_to_null(k % 5).alias("bucket"))


@register("fixed_point_prices", """
  SELECT p_partkey, cur AS price_tenths, cur / 10.0 AS price, buy / 10.0 AS buy_price,
    CAST(CASE WHEN cur > buy THEN buy + floor((cur - buy) / 2) ELSE cur END AS BIGINT) AS sell_tenths,
    CAST(CASE WHEN cur > buy THEN buy + floor((cur - buy) / 2) ELSE cur END AS DOUBLE) / 10 AS sell_price
  FROM (SELECT p_partkey, CAST(round(p_retailprice * 10) AS BIGINT) AS cur,
          CAST(round(p_retailprice * 10) AS BIGINT) - (p_partkey % 21 - 10) AS buy FROM part)""")
def q_fixed_point(spark, d):
    p = _t(spark, d, "part")
    cur = F.round(F.col("p_retailprice") * 10).cast("bigint")
    p = p.select("p_partkey", cur.alias("cur"), (cur - (F.col("p_partkey") % 21 - 10)).alias("buy"))
    sell = sell_value_tenths("cur", "buy")
    return p.select("p_partkey", F.col("cur").alias("price_tenths"), tenths("cur", 12).alias("price"),
                    tenths("buy", 12).alias("buy_price"), sell.alias("sell_tenths"),
                    (sell / F.lit(10.0)).alias("sell_price"))


@register("safe_ratio", """
  SELECT o_custkey, CAST(year(o_orderdate) AS BIGINT) AS yr,
    round(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END)
      / nullif(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END), 0), 6) AS urgent_per_filled
  FROM orders GROUP BY o_custkey, year(o_orderdate)""")
def q_safe_ratio(spark, d):
    o = _t(spark, d, "orders")
    g = o.groupBy("o_custkey", F.year("o_orderdate").alias("yr")).agg(
        F.sum(F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0)).alias("u"),
        F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).alias("f"))
    return g.select("o_custkey", "yr", safe_div("u", "f").alias("urgent_per_filled"))


@register("decay_weight", f"""
  SELECT o_orderkey, {O.season_sql('year(o_orderdate)')} AS season,
    CAST({O.CY} - year(o_orderdate) AS BIGINT) AS seasons_back,
    round(power(0.55, greatest({O.CY} - year(o_orderdate), 0)), 6) AS recency_weight
  FROM orders""")
def q_decay(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", season_label(F.year("o_orderdate")).alias("season"))
    back = (F.lit(CURRENT_YEAR) - season_year("season"))
    return o.select("o_orderkey", "season", back.alias("seasons_back"),
                    recency_weight(back).alias("recency_weight"))


# ---------------------------------------------------------------- conformance, dims
_PERF_COLS = ["season", "gameweek_id", "player_code", "team_code", "opponent_team_code", "was_home",
              "fixture_id"] + O.MEASURES


@register("id_conformance_union", O.chain() + "\n SELECT * FROM perf")
def q_id_conformance(spark, d):
    return Analogue(spark, d).performance.select(*_PERF_COLS)


@register("conformed_dimension", O.chain() + "\n SELECT * FROM dim_players")
def q_dim_players(spark, d):
    return Analogue(spark, d).dim_players


@register("strength_fallback", O.chain() + "\n SELECT * FROM dim_teams")
def q_dim_teams(spark, d):
    return Analogue(spark, d).dim_teams


@register("period_dimension", O.chain() + "\n SELECT * FROM dim_gameweeks")
def q_dim_gameweeks(spark, d):
    return Analogue(spark, d).dim_gameweeks


@register("role_playing_dims", O.chain() + "\n SELECT * FROM fct_fixtures")
def q_fixtures(spark, d):
    return Analogue(spark, d).fixtures


# ---------------------------------------------------------------- form
@register("recent_form", O.chain(O.FORM) + "\n SELECT * FROM recent_form")
def q_recent_form(spark, d):
    return Analogue(spark, d).recent_form


@register("group_baseline", O.chain(O.FORM) + "\n SELECT * FROM baseline")
def q_baseline(spark, d):
    return Analogue(spark, d).baseline


@register("shrunk_form", O.chain(O.FORM) + "\n SELECT * FROM shrunk")
def q_shrunk(spark, d):
    return Analogue(spark, d).shrunk


@register("availability", O.chain(O.FORM) + """
  SELECT player_code, status, chance_of_playing_next_round, availability_factor, confidence_weight,
    round(availability_factor * (start_rate * 90 + (1 - start_rate) * 15), 6) AS expected_minutes
  FROM shrunk""")
def q_availability(spark, d):
    from gaffer.functions.formulas import expected_minutes
    s = Analogue(spark, d).shrunk
    return s.select("player_code", "status", "chance_of_playing_next_round", "availability_factor",
                    "confidence_weight",
                    expected_minutes("availability_factor", "start_rate").alias("expected_minutes"))


# ---------------------------------------------------------------- forecast
@register("fixture_density", O.chain() + O.DENSITY)
def q_density(spark, d):
    return Analogue(spark, d).density


_BYP = """
  SELECT player_code, web_name, position_id, current_team_code, current_price, gameweek_id,
    weeks_ahead, fixture_count, expected_points FROM by_period"""


@register("expected_points_by_period", O.chain(O.FORM, O.forecast_sql(8)) + _BYP)
def q_by_period(spark, d):
    return Analogue(spark, d).by_period


@register("expected_points_next", O.chain(O.FORM, O.forecast_sql(1)) + """
  SELECT player_code, web_name, position_id, current_team_code, current_price, status,
    chance_of_playing_next_round, confidence_weight, gameweek_id, fixture_count, expected_points
  FROM by_period""")
def q_next(spark, d):
    return Analogue(spark, d).next_period


@register("expected_points_horizon", O.chain(O.FORM, O.forecast_sql(8)) + """
  SELECT player_code, web_name, position_id, current_team_code, current_price,
    sum(expected_points * power(0.95, weeks_ahead)) AS horizon_expected_points,
    sum(fixture_count) AS horizon_fixture_count, count(*) AS horizon_gameweeks
  FROM by_period GROUP BY player_code, web_name, position_id, current_team_code, current_price""")
def q_horizon(spark, d):
    return Analogue(spark, d).horizon


# ---------------------------------------------------------------- decisions
@register("entry_picks", O.decisions_chain() + "\n SELECT * FROM picks")
def q_picks(spark, d):
    return Analogue(spark, d).picks


@register("best_lineup", O.decisions_chain(O.LINEUP) + "\n SELECT * FROM lineup")
def q_best_lineup(spark, d):
    return Analogue(spark, d).lineup


@register("bench_boost_by_period", O.decisions_chain(O.LINEUP) +
          "\n SELECT entry_id, gameweek_id, bench_boost_value FROM chips")
def q_bench_boost(spark, d):
    return Analogue(spark, d).chips.select("entry_id", "gameweek_id", "bench_boost_value")


@register("triple_captain_by_period", O.decisions_chain(O.LINEUP) +
          "\n SELECT entry_id, gameweek_id, triple_captain_value, triple_captain_code FROM chips")
def q_triple_captain(spark, d):
    return Analogue(spark, d).chips.select("entry_id", "gameweek_id", "triple_captain_value",
                                           "triple_captain_code")


@register("squad_rule_check", O.decisions_chain() + """
  , s AS (SELECT k.entry_id, k.player_code, k.position_id, p.team_code, p.price
          FROM picks k LEFT JOIN pool p ON k.player_code = p.player_code),
  clubs AS (SELECT entry_id, max(n) AS max_per_club FROM
            (SELECT entry_id, team_code, count(*) AS n FROM s GROUP BY entry_id, team_code) GROUP BY entry_id),
  pos_ok AS (SELECT entry_id, sum(CASE WHEN n = squad_quota THEN 1 ELSE 0 END) AS n_pos_ok FROM
             (SELECT entry_id, position_id, count(*) AS n FROM s GROUP BY entry_id, position_id) x
             JOIN quotas q USING (position_id) GROUP BY entry_id),
  tot AS (SELECT entry_id, count(*) AS n_players, sum(CAST(round(price * 10) AS BIGINT)) AS cost_tenths,
          count(price) AS n_priced FROM s GROUP BY entry_id)
  SELECT t.entry_id, t.n_players, c.max_per_club, t.cost_tenths / 10.0 AS squad_cost,
    t.n_players = 15 AS size_ok, coalesce(p.n_pos_ok, 0) = 4 AS positions_ok,
    c.max_per_club <= 3 AS clubs_ok, (t.cost_tenths <= 1500 AND t.n_priced = t.n_players) AS budget_ok
  FROM tot t LEFT JOIN clubs c USING (entry_id) LEFT JOIN pos_ok p USING (entry_id)""")
def q_squad_check(spark, d):
    return Analogue(spark, d).squad_check


@register("bank", O.decisions_chain() + """
  SELECT k.entry_id, 1500 - sum(CAST(round(p.price * 10) AS BIGINT)) AS bank_tenths
  FROM picks k JOIN players p ON k.player_code = p.player_code GROUP BY k.entry_id""")
def q_bank(spark, d):
    return Analogue(spark, d).bank


_SQ = """
  , sq AS (SELECT k.entry_id, k.player_code, p.position_id, p.team_code, p.price_tenths, p.score
           FROM picks k JOIN pool p ON k.player_code = p.player_code),
  bank_t AS (SELECT k.entry_id, 1500 - sum(CAST(round(pl.price * 10) AS BIGINT)) AS bank_tenths
             FROM picks k JOIN players pl ON k.player_code = pl.player_code GROUP BY k.entry_id),
  club_n AS (SELECT entry_id, team_code, count(*) AS n_club FROM sq GROUP BY entry_id, team_code),
  swaps AS (
    SELECT o.entry_id, o.player_code AS out_code, i.player_code AS in_code, o.position_id,
      i.score - o.score AS gain, (b.bank_tenths + o.price_tenths - i.price_tenths) / 10.0 AS bank_after
    FROM sq o JOIN bank_t b ON o.entry_id = b.entry_id
    JOIN pool i ON i.position_id = o.position_id AND i.price_tenths <= b.bank_tenths + o.price_tenths
    LEFT JOIN club_n c ON c.entry_id = o.entry_id AND c.team_code = i.team_code
    WHERE NOT EXISTS (SELECT 1 FROM sq s WHERE s.entry_id = o.entry_id AND s.player_code = i.player_code)
      AND coalesce(c.n_club, 0) - (CASE WHEN i.team_code = o.team_code THEN 1 ELSE 0 END) + 1 <= 3
  ),
  best_swap AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entry_id ORDER BY gain DESC, out_code, in_code) AS rn
                   FROM swaps) WHERE rn = 1
  )"""


@register("best_single_transfer", O.decisions_chain() + _SQ + """
  SELECT entry_id, out_code, in_code, position_id, gain, bank_after FROM best_swap""")
def q_best_transfer(spark, d):
    return Analogue(spark, d).best_transfer


@register("transfer_diff", O.decisions_chain() + _SQ + """
  , after AS (
    SELECT entry_id, player_code, position_id FROM picks k
    WHERE NOT EXISTS (SELECT 1 FROM best_swap b WHERE b.entry_id = k.entry_id AND b.out_code = k.player_code)
    UNION ALL
    SELECT entry_id, in_code, position_id FROM best_swap),
  outs AS (SELECT entry_id, position_id, player_code FROM picks k
           WHERE NOT EXISTS (SELECT 1 FROM after a WHERE a.entry_id = k.entry_id AND a.player_code = k.player_code)),
  ins AS (SELECT entry_id, position_id, player_code FROM after a
          WHERE NOT EXISTS (SELECT 1 FROM picks k WHERE a.entry_id = k.entry_id AND a.player_code = k.player_code))
  SELECT coalesce(o.entry_id, i.entry_id) AS entry_id, coalesce(o.position_id, i.position_id) AS position_id,
    coalesce(o.pair, i.pair) AS pair, o.player_code AS player_code_out, i.player_code AS player_code_in
  FROM (SELECT *, row_number() OVER (PARTITION BY entry_id, position_id ORDER BY player_code) AS pair FROM outs) o
  FULL JOIN (SELECT *, row_number() OVER (PARTITION BY entry_id, position_id ORDER BY player_code) AS pair FROM ins) i
    ON o.entry_id = i.entry_id AND o.position_id = i.position_id AND o.pair = i.pair""")
def q_transfer_diff(spark, d):
    from gaffer.operators.setops import transfer_diff
    a = Analogue(spark, d)
    before = a.picks.select("entry_id", "player_code", "position_id")
    bt = a.best_transfer
    kept = before.join(bt.select("entry_id", F.col("out_code").alias("player_code")),
                       ["entry_id", "player_code"], "left_anti")
    after = kept.unionByName(bt.select("entry_id", F.col("in_code").alias("player_code"), "position_id"))
    return transfer_diff(before, after, ["entry_id"], "player_code", pair_by="position_id")


def _lam_values() -> str:
    return ", ".join(f"({x})" for x in LAMBDAS)


def _fold_sql(pool: str, key: str) -> str:
    """CTEs that fill a squad per (key, price weight) by walking ``pool`` in order
    of score - weight * price, one player a step, until 15 are in."""
    return f"""
  , weighed AS (SELECT x.*, x.{key} AS k, g.lam, q.squad_quota, x.score - g.lam * x.price_tenths / 10.0 AS adj
                FROM {pool} x CROSS JOIN grid g JOIN quotas q ON x.position_id = q.position_id),
  line AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY k, lam ORDER BY adj DESC, player_code) AS turn
                        FROM weighed),
  walk AS (
    SELECT k, lam, CAST(0 AS BIGINT) AS turn, CAST([] AS BIGINT[]) AS codes, CAST([] AS BIGINT[]) AS jobs,
      CAST([] AS BIGINT[]) AS clubs
    FROM (SELECT DISTINCT k, lam FROM line)
    UNION ALL
    SELECT w.k, w.lam, w.turn + 1,
      CASE WHEN fits THEN list_append(w.codes, CAST(l.player_code AS BIGINT)) ELSE w.codes END,
      CASE WHEN fits THEN list_append(w.jobs, CAST(l.position_id AS BIGINT)) ELSE w.jobs END,
      CASE WHEN fits THEN list_append(w.clubs, CAST(coalesce(l.team_code, -1) AS BIGINT)) ELSE w.clubs END
    FROM walk w JOIN line l ON l.k = w.k AND l.lam = w.lam AND l.turn = w.turn + 1,
      LATERAL (SELECT len(list_filter(w.jobs, lambda j: j = l.position_id)) < l.squad_quota
                 AND len(list_filter(w.clubs, lambda c: c = coalesce(l.team_code, -1))) < 3 AS fits)
    WHERE len(w.codes) < 15),
  done AS (SELECT * FROM walk WHERE len(codes) = 15),
  member AS (SELECT d.k, d.lam, l.player_code, l.position_id, l.score, l.price_tenths
             FROM (SELECT k, lam, unnest(codes) AS code FROM done) d
             JOIN line l ON l.k = d.k AND l.lam = d.lam AND l.player_code = d.code),
  filled AS (SELECT k, lam, sum(score) AS value, sum(price_tenths) AS cost_t FROM member GROUP BY k, lam)"""


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


def _frontier_sql() -> str:
    b = FRONTIER_BUDGET_TENTHS
    return _recursive(O.decisions_chain(f"grid(lam) AS (VALUES {_lam_values()})",
                                        "one_pool AS (SELECT *, 0 AS g FROM pool)") + _fold_sql("one_pool", "g")) + f"""
  , relaxed AS (SELECT lam, sum(adj) AS s FROM (
           SELECT *, row_number() OVER (PARTITION BY lam, position_id ORDER BY adj DESC, player_code) AS r FROM weighed)
         WHERE r <= squad_quota GROUP BY lam),
  upper_b AS (SELECT min(lam * {b} / 10.0 + s) AS upper_bound FROM relaxed),
  lower_b AS (SELECT value AS lower_value, lam AS best_lambda, cost_t / 10.0 AS squad_cost FROM filled
              WHERE cost_t <= {b} QUALIFY row_number() OVER (ORDER BY round(value, 9) DESC, lam) = 1)
  SELECT {b} / 10.0 AS budget, lower_value, upper_bound, upper_bound - lower_value AS gap, best_lambda,
    squad_cost, lower_value IS NOT NULL AS feasible
  FROM upper_b LEFT JOIN lower_b ON true"""


@register("squad_frontier", _frontier_sql())
def q_frontier(spark, d):
    return Analogue(spark, d).frontier


# ---------------------------------------------------------------- streaming
@register("stream_latest_per_key", _LPK.format(keys="user_id"))
def q_stream_latest(spark, d):
    from gaffer.streaming.latest import stream_latest
    ev = _t(spark, d, "events")
    out = stream_latest(spark, d, ev.schema, ["user_id"], ["ts", "event_id"],
                        ["event_type", "value", "props"], name="events-latest-" + d.strip("/").replace("/", "_"),
                        glob="events.parquet")
    k = nested.parse_json(out, "props", {"k": ("k", "int")}, carry=["user_id", "event_id", "event_type",
                                                                    "value", "ts"])
    return k.select("user_id", "event_id", "event_type", "value", "k", F.col("ts").alias("fetched_at"))


# ---------------------------------------------------------------- data quality
def _suite(a: Analogue):
    from gaffer.operators.quality import Check
    perf, dp, dt = a.performance, a.dim_players, a.dim_teams
    return [
        Check("dim_players", "player_code", "not_null", dp),
        Check("dim_players", "player_code", "unique", dp),
        Check("dim_teams", "team_code", "not_null", dt),
        Check("dim_teams", "team_code", "unique", dt),
        Check("dim_gameweeks", "gameweek_id", "not_null", a.dim_gameweeks),
        Check("fct_player_gameweek_performance", "player_code", "relationships", perf, dp, "player_code"),
        Check("fct_player_gameweek_performance", "team_code", "relationships", perf, dt, "team_code"),
        Check("fct_player_gameweek_performance", "opponent_team_code", "relationships", perf, dt, "team_code"),
        Check("fct_fixtures", "home_team_code", "relationships", a.fixtures, dt, "team_code"),
        Check("fct_fixtures", "away_team_code", "relationships", a.fixtures, dt, "team_code"),
        Check("int_player_form_shrunk", "player_code", "unique", a.shrunk),
        Check("fct_player_expected_points_by_gameweek", "player_code", "not_null", a.by_period),
    ]


_DQ_SQL = O.chain(O.FORM, O.forecast_sql(8)) + """
  SELECT 'dim_players' AS table_name, 'player_code' AS column_name, 'not_null' AS check_name,
    count(*) AS failures FROM dim_players WHERE player_code IS NULL
  UNION ALL SELECT 'dim_players', 'player_code', 'unique', count(*) FROM
    (SELECT player_code FROM dim_players WHERE player_code IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
  UNION ALL SELECT 'dim_teams', 'team_code', 'not_null', count(*) FROM dim_teams WHERE team_code IS NULL
  UNION ALL SELECT 'dim_teams', 'team_code', 'unique', count(*) FROM
    (SELECT team_code FROM dim_teams WHERE team_code IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
  UNION ALL SELECT 'dim_gameweeks', 'gameweek_id', 'not_null', count(*) FROM dim_gameweeks WHERE gameweek_id IS NULL
  UNION ALL SELECT 'fct_player_gameweek_performance', 'player_code', 'relationships', count(*) FROM perf
    WHERE player_code IS NOT NULL AND player_code NOT IN (SELECT player_code FROM dim_players WHERE player_code IS NOT NULL)
  UNION ALL SELECT 'fct_player_gameweek_performance', 'team_code', 'relationships', count(*) FROM perf
    WHERE team_code IS NOT NULL AND team_code NOT IN (SELECT team_code FROM dim_teams WHERE team_code IS NOT NULL)
  UNION ALL SELECT 'fct_player_gameweek_performance', 'opponent_team_code', 'relationships', count(*) FROM perf
    WHERE opponent_team_code IS NOT NULL
      AND opponent_team_code NOT IN (SELECT team_code FROM dim_teams WHERE team_code IS NOT NULL)
  UNION ALL SELECT 'fct_fixtures', 'home_team_code', 'relationships', count(*) FROM fct_fixtures
    WHERE home_team_code IS NOT NULL AND home_team_code NOT IN (SELECT team_code FROM dim_teams WHERE team_code IS NOT NULL)
  UNION ALL SELECT 'fct_fixtures', 'away_team_code', 'relationships', count(*) FROM fct_fixtures
    WHERE away_team_code IS NOT NULL AND away_team_code NOT IN (SELECT team_code FROM dim_teams WHERE team_code IS NOT NULL)
  UNION ALL SELECT 'int_player_form_shrunk', 'player_code', 'unique', count(*) FROM
    (SELECT player_code FROM shrunk WHERE player_code IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
  UNION ALL SELECT 'fct_player_expected_points_by_gameweek', 'player_code', 'not_null', count(*)
    FROM by_period WHERE player_code IS NULL"""


@register("dq_suite", _DQ_SQL)
def q_dq_suite(spark, d):
    from gaffer.operators.quality import run_suite
    return run_suite(_suite(Analogue(spark, d)))


@register("dq_not_null", O.chain() + """
  SELECT season, fixture_id, player_code FROM perf WHERE opponent_team_code IS NULL""")
def q_dq_not_null(spark, d):
    from gaffer.operators.quality import not_null
    return not_null(Analogue(spark, d).performance, "opponent_team_code") \
        .select("season", "fixture_id", "player_code")


@register("dq_unique", O.chain() + """
  SELECT gameweek_id, count(*) AS n FROM dim_gameweeks WHERE gameweek_id IS NOT NULL
  GROUP BY gameweek_id HAVING count(*) > 1""")
def q_dq_unique(spark, d):
    from gaffer.operators.quality import unique
    return unique(Analogue(spark, d).dim_gameweeks, "gameweek_id")


@register("dq_relationships", O.chain() + """
  SELECT p.season, p.fixture_id, p.team_code FROM perf p
  WHERE p.team_code IS NOT NULL AND NOT EXISTS (
    SELECT 1 FROM dim_teams t WHERE t.team_code = p.team_code AND t.is_in_current_season)""")
def q_dq_relationships(spark, d):
    from gaffer.operators.quality import relationships
    a = Analogue(spark, d)
    cur = a.dim_teams.where(F.col("is_in_current_season"))
    return relationships(a.performance, "team_code", cur, "team_code") \
        .select("season", "fixture_id", "team_code")


_FREE_HIT = _recursive(O.decisions_chain(O.LINEUP, f"grid(lam) AS (VALUES {_lam_values()})", """
  week_pool AS (SELECT player_code, gameweek_id, position_id, current_team_code AS team_code,
                  CAST(round(current_price * 10) AS BIGINT) AS price_tenths, round(expected_points, 6) AS score
                FROM by_period)""") + _fold_sql("week_pool", "gameweek_id")) + """
  , chosen AS (SELECT k, lam FROM filled WHERE cost_t <= 1000
               QUALIFY row_number() OVER (PARTITION BY k ORDER BY round(value, 9) DESC, lam) = 1),
  fifteen AS (SELECT m.*, row_number() OVER (PARTITION BY m.k, m.position_id ORDER BY m.score DESC, m.player_code) AS r
              FROM member m JOIN chosen c ON c.k = m.k AND c.lam = m.lam),
  eleven AS (SELECT x.k, f.formation_id, sum(x.score) AS xi FROM fifteen x
             JOIN formations f ON f.position_id = x.position_id AND x.r <= f.starters
             GROUP BY x.k, f.formation_id HAVING count(*) = 11),
  hit AS (SELECT k AS gameweek_id, max(xi) AS free_hit_xi FROM eleven GROUP BY k),
  own AS (SELECT entry_id, gameweek_id, max(xi_points) AS own_xi FROM lineup GROUP BY entry_id, gameweek_id),
  free_hits AS (SELECT o.entry_id, o.gameweek_id, o.own_xi, h.free_hit_xi, h.free_hit_xi - o.own_xi AS free_hit_value
                FROM own o LEFT JOIN hit h USING (gameweek_id))"""


@register("free_hit_bound", _FREE_HIT + "\n SELECT * FROM free_hits")
def q_free_hit(spark, d):
    return Analogue(spark, d).free_hit


# An upper bound of any plan: budget and club cap left out.
_CEILING = """  rest AS (SELECT b.entry_id, p.position_id, p.score,
             row_number() OVER (PARTITION BY b.entry_id, p.position_id ORDER BY p.score DESC) AS r
           FROM bank_t b CROSS JOIN pool p ANTI JOIN sq s ON s.entry_id = b.entry_id AND s.player_code = p.player_code),
  worst AS (SELECT entry_id, position_id, score, row_number() OVER (PARTITION BY entry_id, position_id ORDER BY score) AS r
            FROM sq),
  better AS (SELECT w.entry_id, x.score - w.score AS d FROM worst w JOIN rest x USING (entry_id, position_id, r)
             WHERE x.score > w.score),
  stacked AS (SELECT entry_id, sum(d) OVER (PARTITION BY entry_id ORDER BY d DESC ROWS UNBOUNDED PRECEDING)
                - 4 * (row_number() OVER (PARTITION BY entry_id ORDER BY d DESC) - 1) AS net FROM better),
  ceiling_of AS (SELECT entry_id, greatest(0.0, max(net)) AS upper_net_gain FROM stacked GROUP BY entry_id),
"""


def _plan_sql(rounds: int) -> str:
    """CTEs of the greedy transfer plan: one set per round (the exact best swap by
    brute force over squads x pool), then the best prefix and the upper bound."""
    sql = """
  , h0 AS (SELECT entry_id, player_code, position_id, team_code, price_tenths, score FROM sq),
  m0 AS (SELECT entry_id, bank_tenths FROM bank_t)"""
    for k in range(1, rounds + 1):
        sql += f"""
  , c{k} AS (SELECT entry_id, team_code, count(*) AS n FROM h{k - 1} GROUP BY entry_id, team_code),
  s{k} AS MATERIALIZED (
    SELECT * FROM (
      SELECT o.entry_id, {k} AS step, o.player_code AS out_code, i.player_code AS in_code, i.score - o.score AS gain,
        m.bank_tenths + o.price_tenths - i.price_tenths AS money
      FROM h{k - 1} o JOIN m{k - 1} m USING (entry_id)
      JOIN pool i ON i.position_id = o.position_id AND i.price_tenths <= m.bank_tenths + o.price_tenths
      ANTI JOIN h{k - 1} own ON own.entry_id = o.entry_id AND own.player_code = i.player_code
      LEFT JOIN c{k} c ON c.entry_id = o.entry_id AND c.team_code = i.team_code
      WHERE coalesce(c.n, 0) + CASE WHEN i.team_code = o.team_code THEN 0 ELSE 1 END <= 3
      QUALIFY row_number() OVER (PARTITION BY o.entry_id ORDER BY i.score - o.score DESC, o.player_code, i.player_code) = 1)
    WHERE round(gain, 9) > 0),
  h{k} AS MATERIALIZED (
    SELECT h.* FROM h{k - 1} h JOIN s{k} s ON s.entry_id = h.entry_id AND s.out_code <> h.player_code
    UNION ALL
    SELECT s.entry_id, p.player_code, p.position_id, p.team_code, p.price_tenths, p.score
    FROM s{k} s JOIN pool p ON p.player_code = s.in_code),
  m{k} AS (SELECT entry_id, money AS bank_tenths FROM s{k})"""
    moves = " UNION ALL ".join(f"SELECT entry_id, step, out_code, in_code, gain FROM s{k}" for k in range(1, rounds + 1))
    return sql + f"""
  , moves AS ({moves}),
  prefix AS (
    SELECT v.*, sum(gain) OVER w AS gross,
      sum((a.entry_id IS NOT NULL)::INT - (b.entry_id IS NOT NULL)::INT) OVER w AS n
    FROM moves v LEFT JOIN picks a ON a.entry_id = v.entry_id AND a.player_code = v.out_code
    LEFT JOIN picks b ON b.entry_id = v.entry_id AND b.player_code = v.in_code
    WINDOW w AS (PARTITION BY v.entry_id ORDER BY step)),
  taken AS (
    SELECT entry_id, step AS rounds, n, gross, 4 * greatest(n - 1, 0) AS hits FROM prefix
    QUALIFY row_number() OVER (PARTITION BY entry_id ORDER BY round(gross - 4 * greatest(n - 1, 0), 9) DESC, step) = 1),
  lists AS (
    SELECT v.entry_id, list(v.out_code) AS o, list(v.in_code) AS i FROM moves v
    JOIN taken t ON t.entry_id = v.entry_id AND v.step <= t.rounds AND round(t.gross - t.hits, 9) > 0 GROUP BY v.entry_id),
{_CEILING}  planned AS (
    SELECT b.entry_id, CASE WHEN l.entry_id IS NULL THEN 0 ELSE t.n END AS n_transfers,
      coalesce(array_to_string(list_sort(list_filter(l.o, lambda x: NOT list_contains(l.i, x))), ','), '') AS out_codes,
      coalesce(array_to_string(list_sort(list_filter(l.i, lambda x: NOT list_contains(l.o, x))), ','), '') AS in_codes,
      CASE WHEN l.entry_id IS NULL THEN 0.0 ELSE t.gross END AS gross_gain,
      CAST(CASE WHEN l.entry_id IS NULL THEN 0 ELSE t.hits END AS DOUBLE) AS hit_cost,
      CASE WHEN l.entry_id IS NULL THEN 0.0 ELSE t.gross - t.hits END AS net_gain,
      coalesce(c.upper_net_gain, 0.0) AS upper_net_gain
    FROM bank_t b LEFT JOIN taken t USING (entry_id) LEFT JOIN lists l USING (entry_id)
    LEFT JOIN ceiling_of c USING (entry_id))"""


@register("transfer_plan", O.decisions_chain() + _SQ + _plan_sql(15) +
          "\n SELECT *, upper_net_gain - net_gain AS gap FROM planned")
def q_transfer_plan(spark, d):
    return Analogue(spark, d).transfer_plan


# Every one and every two of a manager's players against all pairs of players that may be
# bought, and the upper bound of any plan; a player beaten by seven of the own club and position is
# never wanted (a manager owns five of them at most, and buys one other).
_TWO = """
  , fresh AS MATERIALIZED (
    SELECT x.* FROM pool x WHERE x.price_tenths IS NOT NULL AND (
      SELECT count(*) FROM pool y WHERE y.position_id = x.position_id AND y.team_code = x.team_code
        AND y.price_tenths <= x.price_tenths
        AND (y.score > x.score OR (y.score = x.score AND y.player_code < x.player_code))) < 7),
  buy AS MATERIALIZED (
    SELECT b.entry_id, f.*, coalesce(c.n_club, 0) AS n FROM bank_t b CROSS JOIN fresh f
    ANTI JOIN sq s ON s.entry_id = b.entry_id AND s.player_code = f.player_code
    LEFT JOIN club_n c ON c.entry_id = b.entry_id AND c.team_code = f.team_code),
  one AS (
    SELECT o.entry_id, 1 AS n, o.player_code AS o1, NULL AS o2, i.player_code AS i1, NULL AS i2, i.score - o.score AS gross
    FROM sq o JOIN bank_t b USING (entry_id)
    JOIN buy i ON i.entry_id = o.entry_id AND i.position_id = o.position_id
      AND i.price_tenths <= b.bank_tenths + o.price_tenths
      AND i.n - (i.team_code IS NOT DISTINCT FROM o.team_code)::INT + 1 <= 3),
  sold AS MATERIALIZED (
    SELECT x.entry_id, x.player_code AS o1, y.player_code AS o2, x.position_id AS p1, y.position_id AS p2,
      x.team_code AS t1, y.team_code AS t2, x.score + y.score AS lost,
      b.bank_tenths + x.price_tenths + y.price_tenths AS money
    FROM sq x JOIN sq y ON y.entry_id = x.entry_id AND y.player_code > x.player_code
    JOIN bank_t b ON b.entry_id = x.entry_id),
  two AS (
    SELECT s.entry_id, 2 AS n, s.o1, s.o2, i.player_code AS i1, j.player_code AS i2, i.score + j.score - s.lost AS gross
    FROM sold s JOIN buy i ON i.entry_id = s.entry_id AND i.position_id = s.p1
    JOIN buy j ON j.entry_id = s.entry_id AND j.position_id = s.p2
      AND i.price_tenths + j.price_tenths <= s.money AND i.player_code <> j.player_code
    WHERE i.n - (s.t1 IS NOT DISTINCT FROM i.team_code)::INT - (s.t2 IS NOT DISTINCT FROM i.team_code)::INT + 1 + (j.team_code IS NOT DISTINCT FROM i.team_code)::INT <= 3
      AND j.n - (s.t1 IS NOT DISTINCT FROM j.team_code)::INT - (s.t2 IS NOT DISTINCT FROM j.team_code)::INT + 1 + (j.team_code IS NOT DISTINCT FROM i.team_code)::INT <= 3),
  most AS MATERIALIZED (SELECT entry_id, max(gross) AS gross FROM two GROUP BY entry_id),
""" + _CEILING + """  tops AS (
    SELECT *, gross - 4 * (n - 1) AS net FROM (
      SELECT t.* FROM two t JOIN most m ON m.entry_id = t.entry_id AND t.gross >= m.gross - 1e-9
      UNION ALL SELECT * FROM one)
    WHERE round(gross - 4 * (n - 1), 9) > 0
    QUALIFY row_number() OVER (PARTITION BY entry_id ORDER BY round(gross - 4 * (n - 1), 9) DESC, n, o1, o2, i1, i2) = 1)
  SELECT b.entry_id, coalesce(t.n, 0) AS n_transfers,
    coalesce(array_to_string(list_sort([o1, o2]), ','), '') AS out_codes,
    coalesce(array_to_string(list_sort([i1, i2]), ','), '') AS in_codes,
    coalesce(t.net + 4.0 * (t.n - 1), 0.0) AS gross_gain, coalesce(4.0 * (t.n - 1), 0.0) AS hit_cost,
    coalesce(t.net, 0.0) AS net_gain, coalesce(u.upper_net_gain, 0.0) AS upper_net_gain,
    coalesce(u.upper_net_gain, 0.0) - coalesce(t.net, 0.0) AS gap
  FROM bank_t b LEFT JOIN tops t USING (entry_id) LEFT JOIN ceiling_of u USING (entry_id)"""


@register("best_two_transfers", O.decisions_chain() + _SQ + _TWO)
def q_two_transfers(spark, d):
    """DEC-11: exact for at most two moves, moves that pay for each other included."""
    return Analogue(spark, d).two_transfers


@register("optimal_transfers", None)
def q_optimal_transfers(spark, d):
    """DEC-11: any number of moves, with an upper bound of any plan."""
    return Analogue(spark, d).optimal_transfers


@register("best_squad", None)
def q_best_squad(spark, d):
    """DEC-14 within its bounds."""
    return Analogue(spark, d).best_squad


@register("budget_curve", None)
def q_budget_curve(spark, d):
    """DEC-14 for every budget."""
    return Analogue(spark, d).budget_curve.withColumn("codes", F.array_join(F.col("codes").cast("array<string>"), ","))


@register("free_hit_eleven", None)
def q_free_hit_eleven(spark, d):
    """DEC-18 by the best eleven, beside the reference's reckoning."""
    return Analogue(spark, d).free_hit_eleven


@register("wildcard_interval", None)
def q_wildcard_interval(spark, d):
    """DEC-19 by the budget curve."""
    return Analogue(spark, d).wildcard_interval


@register("player_scores", O.decisions_chain() + """
  SELECT h.player_code, h.position_id, h.current_team_code, h.current_price, h.horizon_expected_points,
    n.gameweek_id, n.expected_points AS gw_expected_points, d.web_name
  FROM horizon h JOIN (SELECT * FROM by_period QUALIFY gameweek_id = min(gameweek_id) OVER ()) n USING (player_code)
  LEFT JOIN dim_players d USING (player_code)""")
def q_player_scores(spark, d):
    """JN-4."""
    return Analogue(spark, d).warehouse.player_scores


def _wildcard_ctes() -> str:
    """Wildcard bounds against the plan's, by definition: the value of unlimited
    transfers lies in [lower_value, upper_value], that of ordinary ones in
    [ordinary_lower, ordinary_upper]."""
    return _SQ + _plan_sql(15) + """
  , one_pool AS (SELECT *, 0 AS g FROM pool)""" + _fold_sql("one_pool", "g") + """
  , mine AS (SELECT s.entry_id, s.player_code, s.position_id, s.score, s.price_tenths AS sell FROM sq s),
  wealth AS (SELECT v.entry_id, sum(v.score) AS squad_value, any_value(b.bank_tenths) + sum(v.sell) AS money
             FROM mine v JOIN bank_t b USING (entry_id) GROUP BY v.entry_id),
  cheap AS (SELECT w.entry_id, max(f.value) AS value FROM wealth w JOIN filled f ON f.cost_t <= w.money GROUP BY w.entry_id),
  option AS (
    SELECT w.entry_id, x.lam, x.position_id, x.squad_quota, x.adj FROM wealth w CROSS JOIN weighed x
    ANTI JOIN mine o ON o.entry_id = w.entry_id AND o.player_code = x.player_code
    UNION ALL
    SELECT o.entry_id, g.lam, o.position_id, q.squad_quota, o.score - g.lam * o.sell / 10.0
    FROM mine o CROSS JOIN grid g JOIN quotas q ON q.position_id = o.position_id),
  relaxed AS (
    SELECT entry_id, lam, sum(adj) AS s FROM (
      SELECT *, row_number() OVER (PARTITION BY entry_id, lam, position_id ORDER BY adj DESC) AS r FROM option)
    WHERE r <= squad_quota GROUP BY entry_id, lam),
  roof AS (SELECT r.entry_id, min(r.lam * w.money / 10.0 + r.s) AS value FROM relaxed r JOIN wealth w USING (entry_id)
           GROUP BY r.entry_id),
  judged AS (
    SELECT w.entry_id, w.squad_value + p.net_gain AS ordinary_lower,
      least(w.squad_value + p.upper_net_gain, u.value) AS ordinary_upper,
      greatest(c.value, w.squad_value + p.gross_gain) AS lower_value, u.value AS upper_value
    FROM wealth w JOIN planned p USING (entry_id) LEFT JOIN cheap c USING (entry_id) LEFT JOIN roof u USING (entry_id)),
  wildcards AS (
    SELECT *, least(greatest(lower_value - ordinary_upper, 0.0), 56.0) AS gain_lower,
      least(greatest(upper_value - ordinary_lower, 0.0), 56.0) AS gain_upper FROM judged)"""


@register("wildcard_gain_bound", _recursive(O.decisions_chain(f"grid(lam) AS (VALUES {_lam_values()})")
                                            + _wildcard_ctes()) + """
  SELECT *, CASE WHEN gain_lower >= 4 THEN 'play' WHEN gain_upper < 4 THEN 'hold' ELSE 'uncertain' END AS verdict
  FROM wildcards""")
def q_wildcard(spark, d):
    return Analogue(spark, d).wildcard


# ---------------------------------------------------------------- more marts and sinks
@register("dim_positions", O.chain() + """
  , rules(position_id, position_name, squad_select, squad_min_play, squad_max_play) AS (VALUES
      (1, 'Goalkeeper', 2, 1, 1), (2, 'Defender', 5, 3, 5), (3, 'Midfielder', 5, 2, 5), (4, 'Forward', 3, 1, 3))
  SELECT r.position_id, r.position_name, upper(left(r.position_name, 3)) AS position_name_short,
    r.squad_select, r.squad_min_play, r.squad_max_play
  FROM rules r WHERE r.position_id IN (SELECT DISTINCT position_id FROM players)""")
def q_dim_positions(spark, d):
    """MRT-3 / STG-4: the positions of the bootstrap payload (those that current
    players hold, with their squad rules)."""
    return Analogue(spark, d).warehouse.dim_positions


@register("recommendation_batch", O.decisions_chain(O.LINEUP) + """
  , j AS (SELECT l.*, d.web_name, d.current_team_code AS team_code, d.current_price AS price
          FROM lineup l LEFT JOIN dim_players d ON l.player_code = d.player_code
          WHERE l.gameweek_id = (SELECT min(gameweek_id) FROM lineup))
  SELECT j.entry_id, j.gameweek_id, j.player_code, j.web_name, j.position_id, j.team_code, j.price,
    j.expected_points, j.squad_role, j.bench_order, j.is_captain, j.is_vice_captain,
    t.total_squad_cost, j.total_expected_points
  FROM j JOIN (SELECT entry_id, gameweek_id, sum(price) AS total_squad_cost FROM j GROUP BY 1, 2) t
    ON j.entry_id = t.entry_id AND j.gameweek_id = t.gameweek_id""")
def q_recommendation_batch(spark, d):
    """SNK-4: the recommendation rows for the next period (append them with
    ``landing.append_batch`` to stamp one ``generated_at`` per run)."""
    from gaffer.operators.decisions import recommendation_rows
    a = Analogue(spark, d)
    nxt = a.lineup.join(a.periods.where(F.col("weeks_ahead") == 0).select("gameweek_id"), "gameweek_id")
    return recommendation_rows(nxt, a.dim_players)


_CHIPS = """
  , chip_long AS (
    SELECT entry_id, gameweek_id, 'bench_boost' AS chip_name, bench_boost_value AS opportunity_value FROM chips
    UNION ALL
    SELECT entry_id, gameweek_id, 'triple_captain', triple_captain_value FROM chips
    UNION ALL
    SELECT entry_id, gameweek_id, 'free_hit', free_hit_value FROM free_hits),
  chip_ranked AS (SELECT *, row_number() OVER (PARTITION BY entry_id, chip_name
                                               ORDER BY round(opportunity_value, 9) DESC, gameweek_id) AS chip_rank
                  FROM chip_long)"""


@register("chip_candidates", _FREE_HIT + _CHIPS + """
  SELECT * FROM chip_ranked WHERE chip_rank <= 3""")
def q_chip_candidates(spark, d):
    return Analogue(spark, d).chip_candidates


def _chip_report_sql() -> str:
    # two folds in one statement: the wildcard's names get a prefix of their own
    wild = _wildcard_ctes()
    for name in ("weighed", "line", "walk", "done", "member", "filled", "chosen", "relaxed"):
        wild = re.sub(rf"\b{name}\b", f"wild_{name}", wild)
    return _FREE_HIT + _CHIPS + wild + f"""
  SELECT r.entry_id, r.chip_name, r.gameweek_id, r.opportunity_value,
    CASE r.chip_name WHEN 'triple_captain' THEN d.web_name ELSE '{HORIZON_DETAIL}' END AS detail
  FROM chip_ranked r JOIN chips c USING (entry_id, gameweek_id)
  LEFT JOIN dim_players d ON d.player_code = c.triple_captain_code WHERE r.chip_rank = 1
  UNION ALL
  SELECT entry_id, 'wildcard', NULL, gain_lower, '{WILDCARD_DETAIL}' FROM wildcards"""


@register("chip_opportunities", _chip_report_sql())
def q_chip_opportunities(spark, d):
    """SNK-5: four chip rows per manager."""
    return Analogue(spark, d).chip_report


@register("pruned_pool", O.decisions_chain() + """
  SELECT x.player_code, x.position_id, x.team_code, x.price_tenths, x.score, d.dominating_clubs
  FROM pool x JOIN quotas q ON x.position_id = q.position_id
  JOIN (SELECT x2.player_code, (SELECT count(DISTINCT y.team_code) FROM pool y
                                WHERE y.position_id = x2.position_id AND y.price_tenths <= x2.price_tenths
                                  AND (y.score > x2.score OR (y.score = x2.score AND y.player_code < x2.player_code)))
                               AS dominating_clubs
        FROM pool x2) d ON x.player_code = d.player_code
  WHERE d.dominating_clubs < 4 + q.squad_quota""")
def q_pruned_pool(spark, d):
    return Analogue(spark, d).pruned_pool


# ---------------------------------------------------------------- the Warehouse's staging models and entry marts
def _wh(spark, d):
    return Analogue(spark, d).warehouse


_WEEKS = f"""
  WITH weeks AS (
    SELECT l_suppkey AS entry_id, {O.period_sql('l_shipdate')} AS gameweek_id,
      CAST(sum(l_quantity) AS BIGINT) AS points, count(DISTINCT l_orderkey) AS transfers
    FROM lineitem WHERE year(l_shipdate) = {O.CY} GROUP BY 1, 2),
  history AS (
    SELECT entry_id, gameweek_id, points, points AS total_points, points * 11 AS gameweek_rank,
      points * 13 AS overall_rank, (points % 50) / 10.0 AS bank, (points % 200 + 900) / 10.0 AS team_value,
      transfers AS transfers_made, transfers * 4 AS transfers_cost, points % 20 AS points_on_bench FROM weeks)"""


@register("stg_players", O.chain() + """
  SELECT player_id, player_code, first_name, second_name, web_name, team_id, position_id, price, total_points, form,
    selected_by_percent, status, news, chance_of_playing_next_round, chance_of_playing_this_round, penalties_order,
    direct_freekicks_order, corners_order AS corners_and_indirect_freekicks_order FROM players""")
def q_stg_players(spark, d):
    return _wh(spark, d).players.select(
        "player_id", "player_code", "first_name", "second_name", "web_name", "team_id", "position_id", "price",
        "total_points", "form", "selected_by_percent", "status", "news", "chance_of_playing_next_round",
        "chance_of_playing_this_round", "penalties_order", "direct_freekicks_order", "corners_and_indirect_freekicks_order")


@register("stg_teams", O.chain() + "\n SELECT team_id, team_code, team_name, team_short_name, "
          + ", ".join(O.STRENGTHS) + ", CAST(NULL AS INTEGER) AS played, league_position, points FROM teams")
def q_stg_teams(spark, d):
    return _wh(spark, d).teams


@register("stg_gameweeks", O.chain() + f"""
  SELECT gameweek_id, gameweek_name, deadline_time, is_finished, is_current, is_next, average_entry_score, highest_score
  FROM dim_gameweeks WHERE season = '{O.CS}'""")
def q_stg_gameweeks(spark, d):
    """Of the current season, the year 2001 of the tables."""
    return _wh(spark, d).gameweeks


@register("stg_fixtures", O.chain() + """
  SELECT s.fixture_id, s.gameweek_id, s.home_team_id, s.away_team_id, f.home_team_difficulty, f.away_team_difficulty,
    f.home_team_score, f.away_team_score, f.kickoff_time, f.is_started, f.is_finished, f.is_finished_provisional
  FROM stg_fixtures s JOIN fct_fixtures f USING (fixture_id)""")
def q_stg_fixtures(spark, d):
    return _wh(spark, d).stg_fixtures


_PLAYED = ", ".join(f"o.{m}" for m in O.MEASURES)


@register("stg_player_gameweek_history", O.chain() + f"""
  SELECT o.element AS player_id, o.o_orderkey AS fixture_id, o.gameweek_id, o.opponent_id AS opponent_team_id, o.was_home,
    {_PLAYED}, o.o_orderkey % 100000 AS selected_by_count, (o.o_orderkey % 130 + 40) / 10.0 AS price_at_gameweek
  FROM o WHERE o.yr = {O.CY}""")
def q_stg_history(spark, d):
    return _wh(spark, d).history.select("player_id", "fixture_id", "gameweek_id", "opponent_team_id", "was_home", *O.MEASURES,
                                        "selected_by_count", "price_at_gameweek")


@register("stg_entries", """
  SELECT s_suppkey AS entry_id, 'M' || s_suppkey AS manager_first_name, s_name AS manager_last_name,
    'Team ' || s_suppkey AS team_name, s_nationkey + 1 AS favourite_team_id,
    CAST(floor(s_acctbal) AS BIGINT) AS overall_points, s_suppkey * 7919 AS overall_rank, 15 AS current_event FROM supplier""")
def q_stg_entries(spark, d):
    from gaffer.plans import staging
    w = _wh(spark, d)
    return staging.stg_entries(w.raw["entry_snapshot"]).drop("fetched_at")


@register("stg_entry_gameweek_history", _WEEKS + "\n SELECT * FROM history")
def q_stg_entry_history(spark, d):
    """Of the current season, the year 2001 of the tables."""
    from gaffer.plans import staging
    return staging.stg_entry_gameweek_history(_wh(spark, d).raw["entry_history_snapshot"])


@register("stg_entry_season_history", _WEEKS + """
  SELECT e.entry_id, y || '/' || lpad(CAST((y + 1) % 100 AS VARCHAR), 2, '0') AS season_name,
    e.entry_id * 3 + y AS total_points, e.entry_id * 5 + y AS season_rank
  FROM (SELECT DISTINCT entry_id FROM weeks) e CROSS JOIN (VALUES (1999), (2000)) v(y)""")
def q_stg_entry_seasons(spark, d):
    from gaffer.plans import staging
    return staging.stg_entry_season_history(_wh(spark, d).raw["entry_history_snapshot"])


@register("stg_entry_chips", _WEEKS + """
  SELECT DISTINCT entry_id, 'wildcard' AS chip_name, entry_id % 15 + 1 AS gameweek_id,
    TIMESTAMP '2001-03-01 10:00:00' AS played_at FROM weeks""")
def q_stg_entry_chips(spark, d):
    from gaffer.plans import staging
    return staging.stg_entry_chips(_wh(spark, d).raw["entry_history_snapshot"])


_ENTRY_PICKS = O.decisions_chain() + """
  , weekly AS (SELECT p.*, 15 AS gameweek_id FROM picks p UNION ALL SELECT p.*, 14 FROM picks p WHERE slot > 1)"""


@register("stg_entry_picks", _ENTRY_PICKS + """
  SELECT w.entry_id, w.gameweek_id, pl.player_id, w.slot AS squad_position, CASE WHEN w.slot = 1 THEN 2 ELSE 1 END AS multiplier,
    w.slot = 1 AS is_captain, w.slot = 2 AS is_vice_captain FROM weekly w JOIN players pl USING (player_code)""")
def q_stg_entry_picks(spark, d):
    """Of the current season, the year 2001 of the tables."""
    from gaffer.plans import staging
    return staging.stg_entry_picks(_wh(spark, d).raw["entry_picks_snapshot"])


@register("stg_entry_picks_summary", _ENTRY_PICKS + """
  SELECT DISTINCT entry_id, gameweek_id, CASE WHEN entry_id % 4 = 0 THEN 'bboost' END AS active_chip,
    (entry_id % 30) / 10.0 AS bank, (entry_id % 90 + 950) / 10.0 AS team_value, entry_id % 3 AS transfers_made,
    0 AS transfers_cost, entry_id % 25 AS points_on_bench, entry_id % 99 AS gameweek_points, entry_id * 2 AS total_points,
    entry_id * 17 AS overall_rank FROM weekly""")
def q_stg_entry_picks_summary(spark, d):
    """Of the current season, the year 2001 of the tables."""
    from gaffer.plans import staging
    return staging.stg_entry_picks_summary(_wh(spark, d).raw["entry_picks_snapshot"])


_MOVES = O.decisions_chain() + """
  , moved AS (
    SELECT a.entry_id, a.position_id + 10 AS gameweek_id, pa.player_id AS player_in_id, a.player_code AS player_in_code,
      round(pa.price - a.position_id / 10, 1) AS player_in_cost, pb.player_id AS player_out_id,
      b.player_code AS player_out_code, pb.price AS player_out_cost,
      TIMESTAMP '2001-05-01 10:00:00' + to_days(CAST(a.position_id - 1 AS INTEGER)) AS transferred_at
    FROM picks a JOIN picks b ON b.entry_id = a.entry_id AND b.position_id = a.position_id AND b.slot = 2
    JOIN players pa ON pa.player_code = a.player_code JOIN players pb ON pb.player_code = b.player_code WHERE a.slot = 1)"""


@register("stg_entry_transfers", _MOVES + """
  SELECT entry_id, gameweek_id, player_in_id, player_in_cost, player_out_id, player_out_cost, transferred_at FROM moved""")
def q_stg_entry_transfers(spark, d):
    """Of the current season, the year 2001 of the tables."""
    from gaffer.plans import staging
    return staging.stg_entry_transfers(_wh(spark, d).raw["entry_transfers_snapshot"])


@register("stg_historical_players", O.chain() + """
  SELECT season, player_id AS season_player_id, player_code, 'F' || (player_code % 50) AS first_name,
    'S' || (player_code % 70) AS second_name, web_name, position_id, (player_code % 91 + 40) / 10.0 AS end_of_season_price,
    CASE WHEN player_code % 5 <> 0 THEN player_code % 200 END AS total_points, penalties_order FROM hplayers""")
def q_stg_hist_players(spark, d):
    """SRC-2 -> STG-14: CSV files per season, landed as rows."""
    return _wh(spark, d).hist_players.select(
        "season", "season_player_id", "player_code", "first_name", "second_name", "web_name", "position_id",
        "end_of_season_price", "total_points", "penalties_order")


@register("stg_historical_teams", O.chain() + "\n SELECT season, team_id AS season_team_id, team_code, team_name, "
          "team_short_name, " + ", ".join(O.STRENGTHS) + " FROM hteams")
def q_stg_hist_teams(spark, d):
    """SRC-2 -> STG-15: CSV files per season, landed as cells of a few rows."""
    return _wh(spark, d).hist_teams


@register("stg_historical_gw_stats", O.chain() + f"""
  SELECT o.season, o.element AS season_player_id, h.web_name AS player_name, h.team_name, o.gameweek_id,
    o.o_orderkey AS fixture_id, o.opponent_id AS opponent_team_id, o.was_home, {_PLAYED},
    (o.o_orderkey % 130 + 40) / 10.0 AS price_at_gameweek, o.o_orderkey % 100000 AS selected_by_count
  FROM o JOIN hplayers h ON h.season = o.season AND h.player_id = o.element WHERE o.yr < {O.CY}""")
def q_stg_hist_stats(spark, d):
    """SRC-2 -> STG-16: CSV files per season, several each, landed as rows."""
    return _wh(spark, d).hist_stats.select(
        "season", "season_player_id", "player_name", "team_name", "gameweek_id", "fixture_id", "opponent_team_id", "was_home",
        *O.MEASURES, "price_at_gameweek", "selected_by_count")


@register("entry_gameweek_performance", _WEEKS + """
  SELECT h.*, CASE WHEN h.entry_id % 4 = 0 AND h.gameweek_id IN (14, 15) THEN 'bboost' END AS active_chip
  FROM history h""")
def q_entry_gw_perf(spark, d):
    """MRT-8 / JN-8 over the landed payloads: weekly history left-joined to the
    picks summary on both keys (a payload holds one season; here 2001)."""
    return _wh(spark, d).fct_entry_gameweek_performance


@register("fct_entry_picks", _ENTRY_PICKS + """
  SELECT entry_id, gameweek_id, player_code, slot AS squad_position, CASE WHEN slot = 1 THEN 2 ELSE 1 END AS multiplier,
    slot = 1 AS is_captain, slot = 2 AS is_vice_captain FROM weekly""")
def q_fct_entry_picks(spark, d):
    """MRT-9, of the current season, the year 2001 of the tables."""
    return _wh(spark, d).fct_entry_picks


@register("fct_entry_transfers", _MOVES + """
  SELECT entry_id, gameweek_id, player_in_code, player_in_cost, player_out_code, player_out_cost, transferred_at FROM moved""")
def q_fct_entry_transfers(spark, d):
    """MRT-10, of the current season, the year 2001 of the tables."""
    return _wh(spark, d).fct_entry_transfers


@register("current_squad", O.decisions_chain() + """
  SELECT entry_id, player_code, 'picks' AS source FROM picks WHERE entry_id % 2 = 0
  UNION ALL
  SELECT entry_id, player_code, 'recommendation' FROM picks WHERE entry_id % 2 = 1 AND slot > 1""")
def q_current_squad(spark, d):
    """DEC-7: the latest real picks of even managers; odd ones have only two
    recommendation runs, the later without the first of each position."""
    from gaffer.operators.decisions import current_squad
    w = _wh(spark, d)
    real = w.fct_entry_picks.where("player_code is not null")
    odd = real.where("entry_id % 2 = 1 and gameweek_id = 15")

    def run(rows, ts):
        return rows.select("entry_id", F.lit(ts).cast("timestamp").alias("generated_at"), "player_code")
    runs = run(odd, "2001-06-01 00:00:00").unionByName(run(odd.where("squad_position > 1"), "2001-06-08 00:00:00"))
    return current_squad(real.where("entry_id % 2 = 0"), runs)


@register("purchase_price", _MOVES + """
  , runs AS (SELECT entry_id, player_code, pl.price + 0.2 AS price FROM picks JOIN players pl USING (player_code) WHERE slot < 4)
  SELECT k.entry_id, k.player_code, round(coalesce(m.player_in_cost, r.price, pl.price), 1) AS purchase_price,
    pl.price AS current_price
  FROM picks k JOIN players pl USING (player_code)
  LEFT JOIN moved m ON m.entry_id = k.entry_id AND m.player_in_code = k.player_code
  LEFT JOIN runs r ON r.entry_id = k.entry_id AND r.player_code = k.player_code""")
def q_purchase_price(spark, d):
    """DEC-8 with both sources: the managers' transfers, then two appended
    recommendation runs (the later, 0.2 dearer, for the first three of a position)."""
    a = Analogue(spark, d)
    priced = a.picks.join(a.source_players.select("player_code", "price"), "player_code").where("slot < 4")

    def run(extra, ts):
        return priced.select("entry_id", "player_code", (F.col("price").cast("double") + extra).alias("price"),
                             F.lit(ts).cast("timestamp").alias("generated_at"))
    runs = run(0.1, "2001-06-01 00:00:00").unionByName(run(0.2, "2001-06-08 00:00:00"))
    out = a.warehouse.purchases(a.picks, runs)
    return out.select("entry_id", "player_code", F.round("purchase_price", 1).alias("purchase_price"), "current_price")


# ---------------------------------------------------------------- declared data tests
_MODEL_SQL = {
    "players": "players", "teams": "teams", "gameweeks": f"(SELECT * FROM dim_gameweeks WHERE season = '{O.CS}')",
    "positions": "held_positions", "dim_positions": "held_positions", "stg_fixtures": "stg_fixtures",
    "entries": "(SELECT s_suppkey AS entry_id FROM supplier)", "recent_form": "recent_form",
    "positional_baseline": "baseline", "dim_players": "dim_players", "dim_teams": "dim_teams",
    "fct_fixtures": "fct_fixtures", "performance": "perf", "dim_gameweeks": "dim_gameweeks",
    "fct_entry_gameweek_performance": "weeks", "fct_team_gameweek_fixtures": "density", "form_shrunk": "shrunk",
    "fct_player_expected_points": "(SELECT * FROM by_period WHERE weeks_ahead = 0)",
    "fct_player_expected_points_horizon": "horizon", "fct_entry_picks": "weekly",
    "fct_player_expected_points_by_gameweek": "by_period",
    "history": f"(SELECT element AS player_id FROM o WHERE yr = {O.CY})",
}


def _data_test_sql(model, column, kind, parent=None, field=None) -> str:
    rows = {
        "not_null": f"SELECT 1 FROM {_MODEL_SQL[model]} m WHERE m.{column} IS NULL",
        "unique": f"SELECT {column} FROM {_MODEL_SQL[model]} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
        "relationships": f"SELECT 1 FROM {_MODEL_SQL[model]} m ANTI JOIN {_MODEL_SQL.get(parent)} p "
                         f"ON p.{field} = m.{column} WHERE m.{column} IS NOT NULL"}[kind]
    return f"SELECT '{model}' AS table_name, '{column}' AS column_name, '{kind}' AS check_name, count(*) AS failures FROM ({rows})"


@register("data_tests", _ENTRY_PICKS + ", " + _WEEKS.split("WITH", 1)[1] + """
  , held_positions AS (SELECT DISTINCT position_id FROM players), density AS (""" + O.DENSITY + ")\n"
          + " UNION ALL ".join(_data_test_sql(*t) for t in DATA_TESTS))
def q_data_tests(spark, d):
    """DQ-1..4: the data tests declared on the Warehouse models."""
    return _wh(spark, d).data_tests()


@register("landed_seasons", """
  SELECT CAST(year(o_orderdate) AS VARCHAR) AS season, count(*) AS n, sum(o_orderkey) AS keys,
    count(DISTINCT o_custkey) AS customers
  FROM orders WHERE year(o_orderdate) IN (1996, 1998) GROUP BY 1""")
def q_landed_seasons(spark, d):
    """SRC-3, SRC-5, SNK-1: CSV files per season, two seasons picked, appended to a
    landed table and read back by path."""
    from gaffer.sources.landing import append_snapshot, land_csv, table
    base = scratch_path(spark, "seasons-" + uuid.uuid4().hex)
    orders = _t(spark, d, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").cast("string").alias("season"))
    orders.write.partitionBy("season").option("header", "true").csv(f"{base}/csv")
    append_snapshot(land_csv(spark, f"{base}/csv", seasons=["1996", "1998"]), f"{base}/table")
    rows = nested.parse_json(table(spark, f"{base}/table"), "payload", {"key": ("o_orderkey", "bigint"),
                                                                         "cust": ("o_custkey", "bigint")}, carry=["season"])
    return rows.groupBy("season").agg(F.count(F.lit(1)).alias("n"), F.sum("key").alias("keys"),
                                      F.countDistinct("cust").alias("customers"))


@register("first_entities", "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 50")
def q_first_entities(spark, d):
    """SRC-7: the first entities by key (the limit is the feature)."""
    from gaffer.sources.landing import first_n
    return first_n(_t(spark, d, "customer").select("c_custkey", "c_name"), "c_custkey", 50)


@register("published_marts", O.chain() + """
  SELECT 'dim_teams' AS mart, count(*) AS n FROM dim_teams UNION ALL
  SELECT 'dim_players', count(*) FROM dim_players UNION ALL
  SELECT 'dim_gameweeks', count(*) FROM dim_gameweeks""")
def q_published_marts(spark, d):
    """SNK-2, SNK-3: marts published as two versions, a third rebuild that fails, and
    views on what readers see."""
    from gaffer.sources.versions import publish_version, read_version
    names = ["dim_teams", "dim_players", "dim_gameweeks"]
    wh = Analogue(spark, d).warehouse
    root = scratch_path(spark, "published-" + uuid.uuid4().hex)
    publish_version(spark, root, {m: getattr(wh, m).limit(0) for m in names})
    wh.publish(root, names)

    def broken():
        raise ValueError("a rebuild that fails")
    try:
        publish_version(spark, root, {"dim_teams": wh.dim_teams.limit(0), "dim_players": broken})
    except ValueError:
        pass
    for m in names:
        read_version(spark, root, m).createOrReplaceTempView(f"published_{m}")
    parts = [spark.table(f"published_{m}").agg(F.count(F.lit(1)).alias("n")).select(F.lit(m).alias("mart"), "n") for m in names]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
