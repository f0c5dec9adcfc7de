"""Event texts and the walk along a game against values worked out by hand."""

import pytest
from pyspark.sql import functions as F

from pennant.sources import plays, readers


def parsed(spark, texts):
    rows = plays.grammar(spark.createDataFrame([(t,) for t in texts], "event string")).collect()
    return {r.event: r for r in rows}


def test_grammar(spark):
    hand = {  # event code, batter, runners from 1, 2, 3, outs
        "S94/F89S": (20, 1, 1, 2, 3, 0), "D7/F78XD.2-H;1-3": (21, 2, 3, 4, 3, 0), "DGR9/L9LS.2-H": (21, 2, 1, 4, 3, 0), "T8": (22, 3, 1, 2, 3, 0), "HR/F89XD": (23, 4, 4, 4, 4, 0), "H9/L9": (23, 4, 4, 4, 4, 0),
        "W.1-2": (14, 1, 2, 2, 3, 0), "IW": (15, 1, 1, 2, 3, 0), "HP.1-2": (16, 1, 2, 2, 3, 0), "C/E2.1-2": (17, 1, 2, 2, 3, 0), "K": (3, 0, 1, 2, 3, 1), "K23": (3, 0, 1, 2, 3, 1), "K.BX1(23)": (3, 0, 1, 2, 3, 1),
        "K+WP.B-1": (3, 1, 1, 2, 3, 0), "K+CS2(26)/DP": (3, 0, 0, 2, 3, 2), "K+PO1(23)": (3, 0, 0, 2, 3, 2), "63/G6M-": (2, 0, 1, 2, 3, 1), "54(1)/FO/G56S.B-1": (2, 1, 0, 2, 3, 1), "6(1)3/GDP/G6MD+": (2, 0, 0, 2, 3, 2),
        "8(B)84(2)/LDP/L8": (2, 0, 1, 0, 3, 2), "5(2)4(1)3/GTP": (2, 0, 0, 0, 3, 3), "E8/L8D+.B-1": (18, 1, 1, 2, 3, 0), "6E3/G6.B-2": (18, 2, 1, 2, 3, 0), "FC5/G56.1X2(5E4);B-1": (19, 1, 2, 2, 3, 0),
        "FC6.3XH(62)": (19, 1, 1, 2, 0, 1), "SB2": (4, 0, 2, 2, 3, 0), "SBH;SB2": (4, 0, 2, 2, 4, 0), "CS2(26)": (6, 0, 0, 2, 3, 1), "CS2(2E4).1-3": (6, 0, 3, 2, 3, 0), "CSH(12)": (6, 0, 1, 2, 0, 1),
        "PO1(13)": (8, 0, 0, 2, 3, 1), "PO2(E1).2-3": (7, 0, 1, 3, 3, 0), "POCS2(1361)": (6, 0, 0, 2, 3, 1), "WP.3-H;2-3": (9, 0, 1, 3, 4, 0), "PB.1-2": (10, 0, 2, 2, 3, 0), "BK.3-H": (11, 0, 1, 2, 4, 0),
        "DI.1-2": (5, 0, 2, 2, 3, 0), "OA.2X3(25)": (12, 0, 1, 0, 3, 1), "FLE5/P5F": (13, 0, 1, 2, 3, 0), "NP": (1, 0, 1, 2, 3, 0), "": (0, 0, 1, 2, 3, 0), "??": (0, 0, 1, 2, 3, 0),
        "S7.1-3;2-H(UR);BX2(74)": (20, 0, 3, 5, 3, 1), "S7.2XH(7E2)(NR)": (20, 1, 1, 4, 3, 0), "D8.BX3(8E5/TH)(54)": (21, 0, 1, 2, 3, 1), "W+SB2.2-3": (14, 1, 2, 3, 3, 0), "K+SB2": (3, 0, 2, 2, 3, 1),
    }
    rows = parsed(spark, hand)
    got = {t: (r.event_cd, r.dest_b, r.dest_1, r.dest_2, r.dest_3, r.event_outs_ct) for t, r in rows.items()}
    assert got == hand


@pytest.mark.parametrize(
    "text,want",
    [
        ("6(1)3/GDP/G6MD+", {"battedball_cd": "G", "battedball_loc_tx": "6MD", "dp_fl": True, "fld_cd": 6, "po1_fld_cd": 6, "po2_fld_cd": 3, "ass1_fld_cd": 6}),
        ("64(1)3/GDP", {"battedball_cd": "G", "po1_fld_cd": 4, "po2_fld_cd": 3, "ass1_fld_cd": 6, "ass2_fld_cd": 4}),
        ("8/SF/F8XD.3-H", {"sf_fl": True, "ab_fl": False, "battedball_cd": "F", "battedball_loc_tx": "8XD", "po1_fld_cd": 8}),
        ("13/SH/BG15S.1-2", {"sh_fl": True, "bunt_fl": True, "battedball_cd": "G", "ab_fl": False, "po1_fld_cd": 3, "ass1_fld_cd": 1}),
        ("2/P2F/FL", {"foul_fl": True, "battedball_cd": "P", "battedball_loc_tx": "2F"}),
        ("S8.1X3(856/TH)", {"po1_fld_cd": 6, "ass1_fld_cd": 8, "ass2_fld_cd": 5, "h_cd": 1}),
        ("5E3/TH/G5.B-1", {"err_ct": 1, "err1_fld_cd": 3, "err1_cd": "T"}),
        ("S9.B-2(E9/TH);1-H(E9)(UR)(NR)", {"err_ct": 2, "err1_cd": "T", "err2_cd": "F", "err2_fld_cd": 9, "err3_cd": "N"}),
        ("K+WP.1-2", {"wp_fl": True, "po1_fld_cd": 2}),
        ("CS3(25)", {"run2_cs_fl": True, "run1_cs_fl": False, "po1_fld_cd": 5, "ass1_fld_cd": 2, "bat_event_fl": False}),
        ("POCS2(134)", {"run1_pk_fl": True, "run1_cs_fl": True, "po1_fld_cd": 4, "ass1_fld_cd": 1, "ass2_fld_cd": 3}),
    ],
)
def test_columns(spark, text, want):
    row = parsed(spark, [text])[text].asDict()
    assert {k: row[k] for k in want} == want


GAME = """id,AAA202405010
version,2
info,visteam,BBB
start,v001,"One, V",0,1,7
start,v002,"Two V",0,2,4
start,v003,"Three V",0,3,3
start,vp01,"Pitcher V",0,0,1
start,h001,"One H",1,1,8
start,h002,"Two H",1,2,6
start,hp01,"Pitcher H",1,0,1
play,1,0,v001,12,CBFX,S7/L7
play,1,0,v002,00,,NP
sub,v009,"Runner V",0,1,12
play,1,0,v002,01,S,SB2
play,1,0,v002,02,S.SC,K
play,1,0,v003,10,BX,D8/F8.2-H
play,1,0,v001,32,BBBCFB,IW
com,"a word"
sub,hp02,"Relief H",1,0,1
play,1,0,v002,00,X,54(1)/FO/G5.B-1
play,1,0,v003,11,BCX,3/L3
play,1,1,h001,00,X,HR/F7
play,1,1,h002,31,BBCBB,W
play,1,1,h001,00,1X,46(1)3/GDP/G4
play,1,1,h002,02,CFT,K
badj,h001,R
radj,v003,2
play,2,0,v001,00,X,E6/G6.2-H(UR)(NR);B-1
play,2,0,v002,00,H,HP.1-2
data,er,hp01,1
"""


def test_game(spark, tmp_path):
    (tmp_path / "2024AAA.EVA").write_text(GAME + GAME.replace("AAA2024", "CCC2024").replace("\n", "\r\n"))
    rows = plays.play_rows(readers.event_records(spark, str(tmp_path))).orderBy("game_id", "event_id").collect()
    assert [r.game_id for r in rows] == ["AAA202405010"] * 13 + ["CCC202405010"] * 13
    mine = rows[:13]
    assert [tuple(r)[1:] for r in mine] == [tuple(r)[1:] for r in rows[13:]]
    at = lambda *names: [tuple(r[n] for n in names) for r in mine]
    assert at("inn_ct", "bat_home_id", "outs_ct", "event_outs_ct") == [(1, 0, 0, 0), (1, 0, 0, 0), (1, 0, 0, 1), (1, 0, 1, 0), (1, 0, 1, 0), (1, 0, 1, 1), (1, 0, 2, 1), (1, 1, 0, 0), (1, 1, 0, 0), (1, 1, 0, 2), (1, 1, 2, 1), (2, 0, 0, 0), (2, 0, 0, 0)]
    assert at("base1_run_id", "base2_run_id", "base3_run_id") == [
        (None, None, None), ("v009", None, None), (None, "v009", None), (None, "v009", None), (None, "v003", None), ("v001", "v003", None), ("v002", "v003", None),
        (None, None, None), (None, None, None), ("h002", None, None), (None, None, None), (None, "v003", None), ("v001", None, None),
    ]
    assert at("away_score_ct", "home_score_ct", "event_runs_ct", "rbi_ct")[3:5] == [(0, 0, 1, 1), (1, 0, 0, 0)]
    assert at("away_score_ct", "home_score_ct", "event_runs_ct", "rbi_ct")[7:] == [(1, 0, 1, 1), (1, 1, 0, 0), (1, 1, 0, 0), (1, 1, 0, 0), (1, 1, 1, 0), (2, 1, 0, 0)]
    assert [r.pit_id for r in mine] == ["hp01"] * 5 + ["hp02"] * 2 + ["vp01"] * 4 + ["hp02"] * 2
    assert mine[6].run1_resp_pit_id == "hp02" and mine[6].run2_resp_pit_id == "hp01"
    assert at("bat_id", "bat_lineup_id", "bat_fld_cd")[:1] == [("v001", 1, 7)] and mine[0].pos6_fld_id == "h002" and mine[7].pos4_fld_id == "v002" and mine[7].pos2_fld_id is None
    assert at("start_bases_cd", "end_bases_cd")[:4] == [(0, 1), (1, 2), (2, 2), (2, 2)] and at("fate_runs_ct")[0] == (1,)
    assert [r.inn_new_fl for r in mine].count(True) == 3 and [r.game_end_fl for r in mine].index(True) == 12 and mine[1].leadoff_fl is False and mine[0].leadoff_fl
    assert (mine[4].balls_ct, mine[4].strikes_ct, mine[4].pa_ball_ct, mine[4].pa_called_strike_ct, mine[4].pa_foul_strike_ct) == (3, 2, 4, 1, 1)


def test_outs_and_runners_are_kept(spark):
    """Whoever was on base or at bat is after the play on base, in or out."""
    from pennant.plans.load_queries import EVENT_TEXTS
    from pennant.plans.registry import QUERIES

    df = QUERIES["src_play_columns"](spark, "/root/testdata/sf0.001")
    on = lambda c: F.bit_count(F.col(c))
    lost = df.filter("event_cd IN (14, 16, 20, 21, 22, 23)").filter(on("start_bases_cd") + 1 != on("end_bases_cd") + F.col("event_runs_ct"))
    assert lost.isEmpty() and len(EVENT_TEXTS) == 16


def test_nothing(spark, tmp_path):
    (tmp_path / "x.EVA").write_text("id,X\nversion,2\n")
    assert plays.play_rows(readers.event_records(spark, str(tmp_path))).collect() == []


def test_records_need_no_whole_file(spark, tmp_path):
    """Records of a file are neither one row nor one window: no exchange stands before those by game."""
    (tmp_path / "x.EVA").write_text(GAME)
    plan = readers.event_records(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan


def test_games_are_dealt_once(spark, tmp_path):
    """All windows, groups and sums of a game come behind one exchange over as many partitions as asked for, and give the same rows."""
    (tmp_path / "x.EVA").write_text(GAME)
    records = readers.event_records(spark, str(tmp_path))
    plan = plays.play_rows(records, 7)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "game_id" in plan.split("Exchange hashpartitioning(")[1].split(")")[0] and "Join" not in plan
    assert sorted(map(tuple, plays.play_rows(records, 7).collect()), key=repr) == sorted(map(tuple, plays.play_rows(records).collect()), key=repr)
