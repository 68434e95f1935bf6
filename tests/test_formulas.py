"""Worked values computed by hand from the formulas (FIXTURES.md section 6)."""
import pytest
from pyspark.sql import functions as F

from gaffer.functions import formulas as FM
from gaffer.functions.scalars import sell_value, sentinel_to_null, blank_to_null, zero_to_null, safe_div
from gaffer.operators.form import recent_form
from gaffer.sources.seed import scoring_rules


def test_recent_form_worked_values(spark):
    cols = ["player_code", "season", "minutes", "starts", "clean_sheets", "total_points", "goals_scored",
            "assists", "goals_conceded", "own_goals", "penalties_missed", "penalties_saved",
            "yellow_cards", "red_cards", "saves", "bonus"]
    rows = [(1, "2026-27", 90, 1, 1, 0, 1, 0, 0, 0, 0, 0, 0, 0, 0, 0),
            (1, "2025-26", 45, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0)]
    f = recent_form(spark.createDataFrame(rows, cols), "2026-27").collect()[0]
    assert float(f.total_weight) == pytest.approx(1.55)
    assert f.goals_per_90 == pytest.approx(0.784314, abs=1e-6)
    assert f.start_rate == pytest.approx(0.645161, abs=1e-6)
    assert f.clean_sheet_rate_per_start == pytest.approx(1.0)
    assert f.has_current_season_minutes is True
    conf = spark.range(1).select(FM.confidence(F.lit(1.55)).alias("c"),
                                 FM.shrink(F.lit(0.784314), F.lit(0.1), FM.confidence(F.lit(1.55))).alias("s")).collect()[0]
    assert conf.c == pytest.approx(0.155)
    assert conf.s == pytest.approx(0.191834, abs=1e-6)


def _fixture_row(spark, position, rates):
    rules = scoring_rules(spark).where(F.col("position_id") == position)
    base = {"availability_factor": 1.0, "start_rate": 0.5, "fixture_id": 1, "is_home": True,
            "avg_defence_home": 1000.0, "avg_defence_away": 1200.0, "avg_attack_home": 1000.0,
            "avg_attack_away": 1100.0, "o_dh": 1000.0, "o_da": 1000.0, "o_ah": 1000.0, "o_aa": 1000.0}
    base.update({r: 0.0 for r in FM.SHRUNK_RATES if r != "start_rate"})
    base.update(rates)
    fid = base.pop("fixture_id")
    df = spark.createDataFrame([base]).withColumn("fixture_id", F.lit(fid).cast("int")).crossJoin(rules)
    xmin = FM.expected_minutes("availability_factor", "start_rate")
    att = FM.attack_multiplier("is_home", "avg_defence_home", "avg_defence_away", "o_dh", "o_da")
    dfn = FM.defence_multiplier("is_home", "avg_attack_home", "avg_attack_away", "o_ah", "o_aa")
    return df.select(xmin.alias("m"), att.alias("a"), dfn.alias("d"),
                     FM.fixture_points("fixture_id", xmin, att, dfn).alias("p")).collect()[0]


def test_fixture_points_forward_and_defender(spark):
    fw = _fixture_row(spark, 4, {"goals_per_90": 0.4, "assists_per_90": 0.2, "clean_sheet_rate_per_start": 0.3,
                                 "goals_conceded_per_90": 1.1, "bonus_per_90": 0.3, "yellow_cards_per_90": 0.2,
                                 "red_cards_per_90": 0.01})
    assert fw.m == pytest.approx(52.5)
    assert fw.a == pytest.approx(1.2) and fw.d == pytest.approx(1.1)
    assert fw.p == pytest.approx(2.7475, abs=1e-6)
    df = _fixture_row(spark, 2, {"goals_per_90": 0.05, "assists_per_90": 0.05, "clean_sheet_rate_per_start": 0.3,
                                 "goals_conceded_per_90": 1.1, "bonus_per_90": 0.2, "yellow_cards_per_90": 0.2,
                                 "red_cards_per_90": 0.01})
    assert df.p == pytest.approx(1.8325, abs=1e-6)


def test_no_fixture_scores_zero_and_unknown_opponent_is_null(spark):
    r = _fixture_row(spark, 4, {"fixture_id": None})
    assert r.p == 0.0
    r = _fixture_row(spark, 4, {"o_da": 0.0, "goals_per_90": 0.4})
    assert r.p is None


def test_horizon_discount(spark):
    v = spark.createDataFrame([(4.0, 0), (4.0, 1)], ["p", "w"]) \
        .agg(F.sum(F.col("p") * FM.horizon_discount("w")).alias("h")).collect()[0].h
    assert v == pytest.approx(7.8)


def test_sell_value_and_cleaners(spark):
    r = spark.createDataFrame([(5.5, 6.0), (5.5, 5.6), (5.5, 5.4)], ["buy", "now"]) \
        .select(sell_value("now", "buy").alias("s")).collect()
    assert [x.s for x in r] == [5.7, 5.5, 5.4]
    r = spark.createDataFrame([("",), ("None",), ("3",)], ["x"]).select(
        sentinel_to_null("x").cast("int").alias("a"), blank_to_null("x").alias("b")).collect()
    assert [x.a for x in r] == [None, None, 3]
    assert [x.b for x in r] == [None, "None", "3"]
    r = spark.createDataFrame([(0, 5), (4, 0)], ["a", "b"]).select(
        zero_to_null("a").alias("z"), safe_div("a", "b").alias("q")).collect()
    assert r[0].z is None and r[0].q == 0.0 and r[1].q is None


def test_availability(spark):
    r = spark.createDataFrame([("a", None), ("i", None), ("d", 75), ("a", 50)], "s string, c int") \
        .select(FM.availability("s", "c").alias("v")).collect()
    assert [x.v for x in r] == [1.0, 0.0, 0.75, 0.5]


def test_start_rate_with_unknown_starts(spark):
    cols = ["player_code", "season", "minutes", "starts", "clean_sheets", "total_points", "goals_scored",
            "assists", "goals_conceded", "own_goals", "penalties_missed", "penalties_saved",
            "yellow_cards", "red_cards", "saves", "bonus"]
    rows = [(1, "2026-27", 90, 1, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0),
            (1, "2026-27", 90, None, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0)]
    df = spark.createDataFrame(rows, "player_code int, season string, minutes int, starts int, " +
                               ", ".join(f"{c} int" for c in cols[4:]))
    assert recent_form(df, "2026-27").collect()[0].start_rate == pytest.approx(0.5)      # T7 kept
    assert recent_form(df, "2026-27", starts_known_only=True).collect()[0].start_rate == pytest.approx(1.0)


def test_fixture_against_itself_counts_once(spark):
    from gaffer.operators.joins import entity_fixtures
    fx = spark.createDataFrame([(1, 5, 3, 3), (2, 5, 3, 7)], "fixture_id int, gameweek_id int, h int, a int")
    rows = entity_fixtures(fx, "fixture_id", "h", "a", extra=["gameweek_id"]).collect()
    assert sorted((r.fixture_id, r.team, r.is_home) for r in rows) == [(1, 3, True), (2, 3, True), (2, 7, False)]


def test_recent_form_of_counts_equals_exact_decimals(spark):
    from gaffer.functions.formulas import PER90_MEASURES
    measures = ["minutes", "starts", "clean_sheets"] + [m for m, _ in PER90_MEASURES]
    rows = spark.range(0, 3000, 1, 4).select(
        (F.col("id") % 40).alias("player_code"),
        F.concat((F.lit(2026) - F.col("id") % 9).cast("string"), F.lit("-xx")).alias("season"),
        *[F.when((F.col("id") + i) % 11 > 0, (F.col("id") * (i + 3)) % 97 - 5).cast("int").alias(m) for i, m in enumerate(measures)])
    exact = rows.select("player_code", "season", *[F.col(m).cast("decimal(10,0)").alias(m) for m in measures])
    got, want = ({r.player_code: r for r in recent_form(df, "2026-27").collect()} for df in (rows, exact))
    assert len(got) == 40 and got == want
