"""Feature families against values computed by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pennant.plans import features as X

D = dt.date


def game_rows(spark, rows):
    return spark.createDataFrame(rows, "id long, retro_game_id string, season int, game_date date, game_number int, home_team_id long, away_team_id long, home_score int, away_score int, game_type string")


@pytest.fixture(scope="module")
def games(spark):
    return game_rows(spark, [
        (1, "G1", 2024, D(2024, 4, 1), 0, 10, 20, 5, 3, "regular"), (2, "G2", 2024, D(2024, 4, 3), None, 20, 10, 6, 2, "regular"),
        (3, "G3", 2024, D(2024, 4, 5), 1, 10, 20, None, None, "regular"), (4, "S1", 2024, D(2024, 3, 1), 0, 10, 20, 9, 9, "spring"),
    ])


def events(spark, rows):
    cols = ["game_id", "event_cd", "bat_home_id", "bat_event_fl", "ab_fl", "resp_pit_start_fl", "resp_pit_id", "event_outs_ct", "battedball_cd", "outs_ct", "pitch_seq_tx"]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))


def test_form_entering_third_game(games):
    rows = {(r.game, r.entity): r for r in X.team_form(games).collect()}
    third = rows[(3, 10)]
    assert (third.wins, third.losses, third.runs_for, third.runs_against, third.rest_days) == (1, 1, 3.5, 4.5, 2)
    x = 8**0.287
    assert third.pythagenpat == pytest.approx(7**x / (7**x + 9**x))
    assert rows[(1, 10)].win_pct is None and rows[(1, 10)].rest_days is None
    assert (4, 10) not in rows


def test_rates_and_their_gates(spark, games):
    """PA 10, H 2, BB 4, HBP 1, SO 1, AB 5: OBP .7, BB% .4, K% .1; SLG needs 8 AB; an event that isn't a batter's is left out."""
    codes = ["20", "20", "14", "14", "14", "14", "16", "3", "2", "2"]
    ab = {"20": "T", "3": "T", "2": "T"}
    rows = [("G1", c, "1", "T", ab.get(c, "F"), "T", "p1", "0", "", "0", None) for c in codes] + [("G1", "3", "1", "F", "F", "T", "p1", "0", "", "0", None)]
    rows += [("G2", "2", "0", "T", "T", "T", "p1", "1", "G", "0", None)]
    r = {(x.game, x.entity): x for x in X.batting_rates(X.counted(events(spark, rows), games, "batting")).collect()}
    second = r[(2, 10)]
    assert (second.pa, second.obp, second.bb_pct, second.k_pct) == (10, pytest.approx(0.7), pytest.approx(0.4), pytest.approx(0.1))
    assert second.slg is None and second.iso is None
    assert r[(1, 10)].obp is None and r[(1, 10)].woba is None


def test_woba_of_one_single(spark, games):
    rows = [("G1", "20", "1", "T", "T", "T", "p1", "0", "L", "0", None), ("G2", "2", "0", "T", "T", "T", "p1", "1", "G", "0", None)]
    r = {(x.game, x.entity): x.woba for x in X.batting_rates(X.counted(events(spark, rows), games, "batting")).collect()}
    assert r == {(1, 10): None, (2, 10): pytest.approx(0.878)}


def test_leverage_of_empty_bases(spark, games):
    rows = [("G1", "2", "1", "T", "T", "T", "p1", "1", "G", "0", "CBX")] * 30 + [("G2", "2", "1", "T", "T", "T", "p1", "1", "G", "0", None)]
    r = {(x.game, x.entity): x for x in X.pitching_rates(X.counted(events(spark, rows), games, "starter")).collect()}
    entering = r[(2, "p1")]
    assert entering.avg_li == pytest.approx(0.85)
    assert entering.csw_pct == pytest.approx(1 / 3) and entering.fstrike_pct == pytest.approx(1.0) and entering.gb_pct == pytest.approx(1.0)
    assert entering.fip == pytest.approx(3.10) and entering.xfip == pytest.approx(3.10)


def test_later_rows_change_nothing_before(spark, games):
    rows = [("G1", "20", "1", "T", "T", "T", "p1", "0", "L", "0", None), ("G2", "23", "0", "T", "T", "T", "p1", "0", "F", "0", None)]
    more = [*rows, ("G3", "23", "1", "T", "T", "T", "p1", "0", "F", "0", None)]
    old, new = ({(x.game, x.entity): tuple(x) for x in X.batting_rates(X.counted(events(spark, e), games, "batting")).collect()} for e in (rows, more))
    assert all(new[k] == v for k, v in old.items())


def test_sides_and_differences(games):
    form = X.team_form(games)
    wide = X.differences(X.sides(games, form, ["runs_for"]), ["runs_for"])
    third = wide.filter("id = 3").first()
    assert (third.home_runs_for, third.away_runs_for, third.runs_for_diff) == (3.5, 4.5, -1.0)


def test_run_expectancy_has_all_states(spark):
    rows = [("g", "1", "0", "2", "0", "a", "", None, "2", "0"), ("g", "1", "0", "10", "2", None, None, None, "0", "1"), ("g", "1", "0", "3", "0", "a", "b", None, "1", "0"), ("g", "1", "0", "1", "0", None, "", None, "0", "0")]
    df = spark.createDataFrame(rows, "game_id string, inn_ct string, bat_home_id string, event_id string, outs_ct string, base1_run_id string, base2_run_id string, base3_run_id string, event_outs_ct string, event_runs_ct string")
    got = {(r.outs, r.bases): r.expected for r in X.run_expectancy_matrix(df).collect()}
    assert got == {(0, "___"): 1.0, (0, "1__"): 1.0, (0, "12_"): 1.0, (2, "___"): 1.0}


def test_wrc_plus_of_an_average_team(spark):
    row = spark.range(1).select(X.wrc_plus(F.lit(0.32), F.lit(0.32), F.lit(100.0)).alias("w")).first()
    assert row.w == pytest.approx(100)


def test_targets_see_only_days_before(spark):
    """A target takes no figure of its own day; what was announced last, with a name, counts."""
    from pennant.plans import upcoming

    day = lambda d: dt.date(2024, 5, d)
    history = spark.createDataFrame([("p", day(1), 3, 1), ("p", day(1), 2, 0), ("p", day(9), 5, 0), ("p", day(10), 7, 1), ("q", day(2), 1, 1)], "k string, game_date date, outs long, started int")
    targets = spark.createDataFrame([(1, "p", day(1)), (2, "p", day(10)), (3, "p", day(11)), (4, "r", day(11)), (5, "p", day(31))], "game int, k string, game_date date")
    rows = upcoming.entering_targets(targets, history, ["k"], "game_date", ["outs"], {"week": ("outs", 7)}, {"rest": "started"})
    assert {r.game: (r.outs, r.week, r.rest) for r in rows.collect()} == {1: (None, None, None), 2: (10, 5, 9), 3: (17, 12, 1), 4: (None, None, None), 5: (17, None, 21)}
    said = spark.createDataFrame([(1, "a", "1"), (1, "b", "2"), (1, None, "3"), (2, None, "1")], "game int, pitcher string, at string")
    assert [tuple(r) for r in upcoming.latest_announced(said, ["game"], "pitcher", "at").collect()] == [(1, "b")]


def test_covered_games_without_relief_are_zeros(spark):
    from pennant.plans import upcoming

    games = spark.createDataFrame([(i, f"G{i}", 2024, dt.date(2024, 5, i), 0, 1, 2, 5, 4, "regular") for i in (1, 2, 3, 4)], "id int, retro_game_id string, season int, game_date date, game_number int, home_team_id int, away_team_id int, home_score int, away_score int, game_type string")
    play = lambda g, half, start, code, outs: (f"G{g}", half, start, code, "T", str(outs))
    events = [play(1, "0", "T", "3", 1), play(1, "0", "F", "3", 1), play(1, "0", "F", "14", 0), play(2, "1", "T", "2", 1), play(4, "0", "F", "23", 0)]
    events = spark.createDataFrame(events, "game_id string, bat_home_id string, resp_pit_start_fl string, event_cd string, bat_event_fl string, event_outs_ct string")
    rows = {(r.game, r.entity): (r.pa, r.so, r.k_pct, r.fatigue) for r in upcoming.covered_relief(games, events).collect()}
    assert rows == {(1, 1): (None, None, None, None), (1, 2): (None, None, None, None), (2, 1): (2, 1, 0.5, 1), (2, 2): (0, 0, None, 0), (4, 1): (2, 1, 0.5, 1), (4, 2): (0, 0, None, 0)}


def test_weighted_speed(spark):
    from pennant.plans import upcoming

    rows = spark.createDataFrame([(1, 30.0, 10), (1, 20.0, 30), (1, 99.0, 0), (2, 25.0, 0)], "team int, speed double, runs int")
    assert [tuple(r) for r in upcoming.weighted_season(rows, ["team"], "speed", "runs", "speed").collect()] == [(1, 22.5)]


def test_partitions_grow_with_the_events(spark, sf, monkeypatch):
    """A task joins and adds up no more events in a larger table."""
    from pennant.plans import fixtures
    from pennant.plans.registry import Tables

    t = Tables(spark, sf)
    n = fixtures.plays(t).count()
    monkeypatch.setattr(X, "EVENTS_A_TASK", n // 9)
    plan = X.counted(fixtures.plays(t), fixtures.games(t), "batting")._jdf.queryExecution().optimizedPlan().toString()
    assert any(f"RepartitionByExpression [game_id#{line.split('game_id#')[1].split(']')[0]}], {-(-n // (n // 9))}" in line for line in plan.split("\n") if "RepartitionByExpression" in line)
