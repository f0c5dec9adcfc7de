"""Registered queries of the point-in-time feature families."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pennant.plans import features, upcoming
from pennant.plans.fixtures import GAMES_SQL, PLAYS_SQL, games, half_up, plays
from pennant.plans.registry import Tables, query

SIDES_SQL = """s AS (
  SELECT id AS game, season, game_date, game_number AS number, 'home' AS side, home_team_id AS entity, home_score AS rf, away_score AS ra FROM g WHERE game_type = 'regular'
  UNION ALL SELECT id, season, game_date, game_number, 'away', away_team_id, away_score, home_score FROM g WHERE game_type = 'regular')"""
FORM_SQL = f"""{GAMES_SQL}, {SIDES_SQL}, f AS (SELECT *, sum(won) OVER w AS wins, count(won) OVER w AS played, sum(rf) OVER w AS f, sum(ra) OVER w AS a,
    avg(won) OVER (PARTITION BY entity, season ORDER BY game_date, number, game ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS last10,
    date_diff('day', lag(game_date) OVER (PARTITION BY entity ORDER BY game_date, number, game), game_date) AS rest
  FROM (SELECT *, (rf > ra)::INT AS won FROM s) WINDOW w AS (PARTITION BY entity, season ORDER BY game_date, number, game ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
form AS (SELECT game, season, game_date, entity, side, wins::BIGINT AS wins, (played - wins)::BIGINT AS losses, round(wins / nullif(played, 0), 6) AS win_pct, round(last10, 6) AS win_pct_10,
  round(last10 - wins / nullif(played, 0), 6) AS trend, round(f / nullif(played, 0), 6) AS runs_for, round(a / nullif(played, 0), 6) AS runs_against,
  round(pow(f, pow((f + a) / played, 0.287)) / (pow(f, pow((f + a) / played, 0.287)) + pow(a, pow((f + a) / played, 0.287))), 6) AS pythagenpat, rest::BIGINT AS rest_days FROM f)"""
ROUNDED = ("win_pct", "win_pct_10", "trend", "runs_for", "runs_against", "pythagenpat")
FORM = ("game", "entity", "side", "wins", "losses", *ROUNDED, "rest_days")


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def team_form(t: Tables) -> DataFrame:
    return rounded(features.team_form(games(t)), *ROUNDED).select(*FORM)


@query(f"WITH {FORM_SQL} SELECT {', '.join(FORM)} FROM form")
def fea_team_form(t: Tables) -> DataFrame:
    """FEA-01, FEA-05, FEA-07: record, last ten, trend, runs and Pythagenpat of both teams entering each game."""
    return team_form(t)


@query(f"""WITH {FORM_SQL} SELECT g.id, h.win_pct AS home_win_pct, a.win_pct AS away_win_pct, h.runs_for AS home_runs_for, a.runs_for AS away_runs_for,
  h.win_pct - a.win_pct AS win_pct_diff, h.runs_for - a.runs_for AS runs_for_diff
FROM g LEFT JOIN form h ON h.game = g.id AND h.entity = g.home_team_id LEFT JOIN form a ON a.game = g.id AND a.entity = g.away_team_id""")
def fea_game_sides(t: Tables) -> DataFrame:
    """FEA-05, SNK-09: home and away columns of a tall table, and their differences."""
    wide = features.sides(games(t), team_form(t), ["win_pct", "runs_for"])
    out = features.differences(wide, ["win_pct", "runs_for"])
    return out.select("id", "home_win_pct", "away_win_pct", "home_runs_for", "away_runs_for", "win_pct_diff", "runs_for_diff")


@query(f"WITH {FORM_SQL} SELECT {', '.join(FORM)} FROM form WHERE game_date BETWEEN DATE '1997-03-01' AND DATE '1997-06-30'")
def fea_form_of_range(t: Tables) -> DataFrame:
    """FEA-23: rows of a date range alone, from all that lies before; equal to the whole rebuild."""
    return rounded(features.of_range(games(t), "1997-03-01", "1997-06-30", features.team_form), *ROUNDED).select(*FORM)


@query(f"""WITH {FORM_SQL} SELECT g.id AS game_id, g.season, g.game_date, g.home_team_id, g.away_team_id, (g.home_score > g.away_score) AS home_won,
  h.win_pct AS home_win_pct, a.win_pct AS away_win_pct, h.rest_days AS home_rest_days, a.rest_days AS away_rest_days
FROM g LEFT JOIN form h ON h.game = g.id AND h.entity = g.home_team_id LEFT JOIN form a ON a.game = g.id AND a.entity = g.away_team_id WHERE game_type = 'regular' AND home_score <> away_score""")
def fea_export(t: Tables) -> DataFrame:
    """FEA-25: the export view, one row per decided regular game with its label and the features of both sides."""
    return features.export_view(games(t), team_form(t), ["win_pct", "rest_days"])


def counts_sql(entity: str) -> str:
    """Relation c: counts by game and entity."""
    who = {
        "batting": "CASE WHEN bat_home_id = '1' THEN home_team_id ELSE away_team_id END", "bullpen": "CASE WHEN bat_home_id = '1' THEN away_team_id ELSE home_team_id END",
        "starter": "resp_pit_id",
    }[entity]
    only = {"batting": "", "bullpen": "AND resp_pit_start_fl = 'F'", "starter": "AND resp_pit_start_fl = 'T'"}[entity]
    pa = "bat_event_fl = 'T'"
    n = lambda condition, name: f"count(*) FILTER ({condition}) AS {name}"
    coded = [n(f"{pa} AND event_cd = '{c}'", k) for k, c in (("ubb", 14), ("ibb", 15), ("hbp", 16), ("b1", 20), ("b2", 21), ("b3", 22), ("hr", 23), ("so", 3))]
    homer, bare = "(event_cd = '23' OR h_cd = '4')", "battedball_cd = ''"
    contact = [
        *[n(f"battedball_cd = '{b}'", k) for b, k in (("G", "gb"), ("L", "ld"), ("P", "pu"))], n(f"battedball_cd = 'F' OR ({homer} AND {bare})", "fb"), n(homer, "hr_hit"),
        n(f"battedball_cd <> '' OR ({homer} AND {bare})", "bip"), n("battedball_cd = 'L' OR event_cd = '23' OR h_cd IN ('2', '3', '4')", "hard"),
        n(f"(battedball_cd = 'L' AND event_cd IN ('21', '22', '23')) OR {homer}", "barrel"), n(f"event_cd = '3' OR battedball_cd <> '' OR ({homer} AND {bare})", "x_ab"),
    ]
    value = lambda v: f"sum(CASE WHEN NOT ({pa}) THEN 0.0 WHEN {homer} THEN {v[0]} WHEN battedball_cd = 'L' THEN {v[1]} WHEN battedball_cd = 'F' THEN {v[2]} WHEN battedball_cd = 'G' THEN {v[3]} WHEN battedball_cd = 'P' THEN {v[4]} ELSE 0.0 END::DECIMAL(12, 3))"
    state = "concat(CASE WHEN coalesce(base1_run_id, '') <> '' THEN '1' ELSE '_' END, CASE WHEN coalesce(base2_run_id, '') <> '' THEN '2' ELSE '_' END, CASE WHEN coalesce(base3_run_id, '') <> '' THEN '3' ELSE '_' END)"
    cells = """WHEN '0___' THEN 0.85 WHEN '01__' THEN 1.15 WHEN '0_2_' THEN 1.25 WHEN '0__3' THEN 1.45 WHEN '012_' THEN 1.55 WHEN '01_3' THEN 1.65 WHEN '0_23' THEN 1.80 WHEN '0123' THEN 2.10
      WHEN '1___' THEN 0.70 WHEN '11__' THEN 1.05 WHEN '1_2_' THEN 1.20 WHEN '1__3' THEN 1.40 WHEN '112_' THEN 1.50 WHEN '11_3' THEN 1.60 WHEN '1_23' THEN 1.75 WHEN '1123' THEN 2.05
      WHEN '2___' THEN 0.50 WHEN '21__' THEN 0.85 WHEN '2_2_' THEN 1.05 WHEN '2__3' THEN 1.25 WHEN '212_' THEN 1.35 WHEN '21_3' THEN 1.45 WHEN '2_23' THEN 1.60 WHEN '2123' THEN 1.90"""
    pitched = "regexp_replace(pitch_seq_tx, '[^BCFKLMOPSTUVWXI]', '', 'g')"
    kind = lambda members: f"length(regexp_replace({pitched}, '[^{members}]', '', 'g'))"
    seen = [
        f"sum(length({pitched})) AS pitches", f"sum({kind('CSM')}) AS csw", f"sum({kind('SM')}) AS whiffs", f"sum({kind('SMFLTOX')}) AS swings",
        n(f"regexp_matches({pitched}, '^[CSFKTMLOX]')", "fstrikes"), n(f"length({pitched}) > 0 AND {pa}", "seen_pa"),
    ]
    rest = [
        n(pa, "pa"), n("ab_fl = 'T'", "ab"), n("sf_fl = 'T'", "sf"), n("run1_sb_fl = 'T'", "sb"), n("run1_cs_fl = 'T'", "cs"), "sum(event_outs_ct::INT) AS outs", "sum(event_runs_ct::INT) AS runs",
        *[f"{value(v)} AS {k}" for k, v in (("xba", (1.000, 0.685, 0.210, 0.235, 0.020)), ("xslg", (4.000, 0.880, 0.560, 0.260, 0.020)), ("xwoba", (2.100, 0.650, 0.320, 0.220, 0.020)))], f"sum(CASE WHEN {pa} THEN CASE concat(outs_ct, {state}) {cells} END ELSE 0.0 END::DECIMAL(12, 3)) AS li",
    ]
    return f"""{GAMES_SQL}, {PLAYS_SQL}, c AS (SELECT g.id AS game, season, game_date, game_number AS number, {who} AS entity, {', '.join([*coded, *contact, *seen, *rest])}
  FROM e JOIN g ON e.game_id = g.retro_game_id WHERE game_type = 'regular' {only} GROUP BY ALL)"""


COUNTED = "ubb ibb hbp b1 b2 b3 hr so ab sf sb cs pa runs outs gb ld pu fb hr_hit bip hard barrel x_ab xba xslg xwoba li pitches csw whiffs swings fstrikes seen_pa".split()
PRIOR_SQL = f"""p AS (SELECT game, entity, season, game_date, {', '.join(f'sum({c}) OVER w AS {c}' for c in COUNTED)} FROM c
  WINDOW w AS (PARTITION BY entity, season ORDER BY game_date, number, game ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""
_WOBA = lambda x: f"(0.690::DOUBLE * {x}ubb + 0.722::DOUBLE * {x}hbp + 0.878::DOUBLE * {x}b1 + 1.242::DOUBLE * {x}b2 + 1.569::DOUBLE * {x}b3 + 2.015::DOUBLE * {x}hr) / nullif({x}ab + {x}ubb + {x}sf + {x}hbp, 0)"
_LEAGUE = ("sb", "cs", "b1", "ubb", "hbp", "ab", "sf", "b2", "b3", "hr")
BATTING = ("obp", "slg", "iso", "babip", "bb_pct", "k_pct", "woba", "league_woba", "wsb", "re24_proxy")


@query(half_up(f"""WITH {counts_sql('batting')}, {PRIOR_SQL},
l AS (SELECT season, game_date, {', '.join(f'sum({c}) OVER (PARTITION BY season ORDER BY game_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l_{c}' for c in _LEAGUE)}
  FROM (SELECT season, game_date, {', '.join(f'sum({c}) AS {c}' for c in _LEAGUE)} FROM c GROUP BY ALL)),
x AS (SELECT *, ab + ubb + ibb + sf + hbp AS n, b1 + b2 + b3 + hr AS h, b1 + 2 * b2 + 3 * b3 + 4 * hr AS tb, ab - so - hr + sf AS balls,
  (0.2::DOUBLE * l_sb - 0.42::DOUBLE * l_cs) / nullif(l_b1 + l_ubb + l_hbp, 0) AS lw FROM p JOIN l USING (season, game_date))
SELECT game, entity, n::BIGINT AS pa, round(CASE WHEN n >= 10 THEN (h + ubb + ibb + hbp) / n END, 6) AS obp, round(CASE WHEN ab >= 8 THEN tb / ab END, 6) AS slg, round(CASE WHEN ab >= 8 THEN (tb - h) / ab END, 6) AS iso,
  round(CASE WHEN balls >= 8 THEN (h - hr) / balls END, 6) AS babip, round(CASE WHEN n >= 10 THEN (ubb + ibb) / n END, 6) AS bb_pct, round(CASE WHEN n >= 10 THEN so / n END, 6) AS k_pct,
  round({_WOBA('')}, 6) AS woba, round({_WOBA('l_')}, 6) AS league_woba, round(CASE WHEN sb + cs >= 5 THEN 0.2::DOUBLE * sb - 0.42::DOUBLE * cs - lw * (b1 + ubb + hbp) END, 6) AS wsb,
  round(CASE WHEN x.pa >= 50 THEN runs - 0.12::DOUBLE * x.pa END, 4) AS re24_proxy FROM x"""))
def fea_batting(t: Tables) -> DataFrame:
    """FEA-06, FEA-08, FEA-09: team rates, wSB and wOBA entering each game."""
    rates = features.batting_rates(features.counted(plays(t), games(t), "batting"))
    return rounded(rates, *BATTING).select("game", "entity", "pa", *BATTING)


@query(half_up(f"""WITH {counts_sql('batting')}, {PRIOR_SQL},
l AS (SELECT season, game_date, {', '.join(f'sum({c}) OVER (PARTITION BY season ORDER BY game_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l_{c}' for c in _LEAGUE)}
  FROM (SELECT season, game_date, {', '.join(f'sum({c}) AS {c}' for c in _LEAGUE)} FROM c GROUP BY ALL))
SELECT game, entity, round((({_WOBA('')} - {_WOBA('l_')}) / 1.2 + 1) / ((90 + entity) / 100) * 100, 4) AS wrc_plus FROM p JOIN l USING (season, game_date)"""))
def fea_wrc_plus(t: Tables) -> DataFrame:
    """FEA-10: wOBA against the league's, corrected by the park (here 90 to 119 by team)."""
    rates = features.batting_rates(features.counted(plays(t), games(t), "batting"))
    return rates.select("game", "entity", F.round(features.wrc_plus(F.col("woba"), F.col("league_woba"), F.lit(90.0) + F.col("entity")), 4).alias("wrc_plus"))


PITCHING = "fip xfip siera k_pct bb_pct hr_pct csw_pct whiff_pct fstrike_pct gb_pct fb_pct ld_pct hr_fb avg_li re24_proxy hard_hit_pct barrel_pct xba xslg xwoba".split()
_FIP = lambda homers: f"(13 * {homers} + 3 * (ubb + ibb + hbp) - 2 * so) / (outs / 3) + 3.10"
_SHARE = lambda part, whole, least, name: f"round(CASE WHEN {whole} >= {least} THEN ({part}) / ({whole}) END, 6) AS {name}"
PITCHING_SQL = half_up(f"""SELECT game, entity, pa::BIGINT AS pa, round(CASE WHEN outs > 0 THEN {_FIP('hr')} END, 6) AS fip, round(CASE WHEN pa >= 30 AND outs >= 9 THEN {_FIP('(0.105::DOUBLE * fb)')} END, 4) AS xfip,
  round(CASE WHEN pa >= 30 THEN 6.145 - 16.984 * (so / pa) + 11.434 * ((ubb + ibb) / pa) - 1.858 * ((gb - fb - pu) / pa) + 7.653 * (so / pa) * (so / pa) + 6.664 * (gb / pa) * (gb / pa)
    - 9.096 * (so / pa) * (gb / pa) - 3.037 * ((ubb + ibb) / pa) * (gb / pa) END, 4) AS siera,
  {_SHARE('so', 'pa', 1, 'k_pct')}, {_SHARE('ubb + ibb', 'pa', 1, 'bb_pct')}, {_SHARE('hr', 'pa', 1, 'hr_pct')}, {_SHARE('csw', 'pitches', 20, 'csw_pct')}, {_SHARE('whiffs', 'swings', 10, 'whiff_pct')}, {_SHARE('fstrikes', 'seen_pa', 5, 'fstrike_pct')},
  {_SHARE('gb', 'gb + fb + ld + pu', 10, 'gb_pct')}, {_SHARE('fb', 'gb + fb + ld + pu', 10, 'fb_pct')}, {_SHARE('ld', 'gb + fb + ld + pu', 10, 'ld_pct')}, {_SHARE('hr_hit', 'fb', 5, 'hr_fb')},
  round(CASE WHEN pa >= 30 THEN li / pa END, 4) AS avg_li, round(CASE WHEN pa >= 30 THEN 0.12::DOUBLE * pa - runs END, 4) AS re24_proxy,
  {_SHARE('hard', 'bip', 5, 'hard_hit_pct')}, {_SHARE('barrel', 'bip', 5, 'barrel_pct')}, {_SHARE('xba', 'x_ab', 10, 'xba')}, {_SHARE('xslg', 'x_ab', 10, 'xslg')},
  round(CASE WHEN pa >= 10 THEN (xwoba::DOUBLE + 0.69::DOUBLE * (ubb + ibb) + 0.722::DOUBLE * hbp) / pa END, 6) AS xwoba FROM p""")


def pitching(t: Tables, entity: str) -> DataFrame:
    rates = features.pitching_rates(features.counted(plays(t), games(t), entity))
    return rounded(rates, *PITCHING).select("game", "entity", "pa", *PITCHING)


@query(f"WITH {counts_sql('starter')}, {PRIOR_SQL} {PITCHING_SQL}")
def fea_starter(t: Tables) -> DataFrame:
    """FEA-11, FEA-15, FEA-16, FEA-17, FEA-19, FEA-20: starters entering each game."""
    return pitching(t, "starter")


@query(f"WITH {counts_sql('bullpen')}, {PRIOR_SQL} {PITCHING_SQL}")
def fea_bullpen(t: Tables) -> DataFrame:
    """FEA-14: quality of each team's relief entering each game."""
    return pitching(t, "bullpen")


_LOAD = lambda n: f"""d AS (SELECT entity, game_date, sum(outs) AS outs, sum(pitches) AS pitches FROM c GROUP BY ALL),
  q AS (SELECT entity, game_date, sum(outs) OVER w AS outs, sum(pitches) OVER w AS pitches FROM d WINDOW w AS (PARTITION BY entity ORDER BY game_date RANGE BETWEEN INTERVAL {n} DAY PRECEDING AND INTERVAL 1 DAY PRECEDING))"""  # noqa: E731


@query(f"WITH {counts_sql('bullpen')}, {_LOAD(3)} SELECT c.game, c.entity, q.outs::BIGINT AS outs_3d, q.pitches::BIGINT AS pitches_3d FROM c JOIN q USING (entity, game_date)")
def fea_bullpen_fatigue(t: Tables) -> DataFrame:
    """FEA-14: relief outs and pitches of the three days before."""
    return features.fatigue(features.counted(plays(t), games(t), "bullpen")).select("game", "entity", "outs_3d", "pitches_3d")


@query(f"""WITH {counts_sql('starter')}, {_LOAD(7)}, r AS (SELECT game, entity, game_date, date_diff('day', lag(game_date) OVER w, game_date) AS rest_days, count(*) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS career_starts
  FROM c WINDOW w AS (PARTITION BY entity ORDER BY game_date, number, game)) SELECT r.game, r.entity, r.rest_days::BIGINT AS rest_days, r.career_starts, q.outs::BIGINT AS outs_7d FROM r JOIN q USING (entity, game_date)""")
def fea_starter_workload(t: Tables) -> DataFrame:
    """FEA-12, FEA-13: starts so far, days of rest, outs of the week before."""
    return features.starter_rest(features.counted(plays(t), games(t), "starter")).select("game", "entity", "rest_days", "career_starts", "outs_7d")


@query(f"""WITH {GAMES_SQL}, v AS (SELECT o_custkey % 30 AS team_id, year(o_orderdate) AS season, max(o_totalprice) AS oaa, count(*) AS war FROM orders GROUP BY ALL)
SELECT g.id, h.oaa AS home_oaa, a.oaa AS away_oaa, h.war AS home_war, a.war AS away_war FROM g LEFT JOIN v h ON h.team_id = home_team_id AND h.season = g.season - 1 LEFT JOIN v a ON a.team_id = away_team_id AND a.season = g.season - 1""")
def fea_prior_season(t: Tables) -> DataFrame:
    """FEA-21: values of each side's season before."""
    seasons = t.orders.groupBy((F.col("o_custkey") % 30).alias("team_id"), F.year("o_orderdate").alias("season")).agg(F.max("o_totalprice").alias("oaa"), F.count("*").alias("war"))
    return features.prior_season(games(t), seasons, ["oaa", "war"]).select("id", "home_oaa", "away_oaa", "home_war", "away_war")


@query(f"""WITH {GAMES_SQL} SELECT id AS game, concat('market-', CASE WHEN id % 3 = 0 THEN 'a' ELSE 'b' END) AS model, (id % 100) / 100.0 AS p, (home_score > away_score) AS home_won
FROM g WHERE id % 100 <> 7 AND home_score <> away_score
UNION ALL SELECT id, concat('market-', CASE WHEN id % 3 = 0 THEN 'a' ELSE 'b' END), (id % 100) / 100.0, NULL FROM g WHERE id % 100 <> 7 AND home_score = away_score""")
def fea_market_predictions(t: Tables) -> DataFrame:
    """FEA-22, FEA-24: the market's probability as a prediction, with the outcome where it is decided."""
    side = lambda team: F.struct(F.col(team).alias("team_id"), (F.col("id") % 100 / 100.0).alias("implied_probability"))
    markets = games(t).select(F.col("id").alias("game"), "home_team_id", F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"), F.lit("2024-01-01").alias("as_of"), F.explode(F.array(side("home_team_id"), side("away_team_id"))).alias("s"))
    markets = markets.select("game", "home_team_id", "source", "as_of", "s.team_id", F.when(F.col("game") % 100 != 7, F.col("s.implied_probability")).alias("implied_probability"))
    return features.outcomes(features.market_predictions(markets), games(t)).select("game", "model", "p", "home_won")


#: Games from this day on count as not yet played.
TODAY = "2001-05-01"


def games_so_far(t: Tables) -> DataFrame:
    """The games, those from TODAY on without a result."""
    open_ = F.col("game_date") >= F.lit(TODAY).cast("date")
    return games(t).withColumns({c: F.when(~open_, F.col(c)) for c in ("home_score", "away_score")})


#: Games to come (u), plays of those that were played (x), in twins that write every constant out.
SO_FAR_SQL = f"""{GAMES_SQL}, {PLAYS_SQL}, u AS (SELECT id AS game, season, game_date, home_team_id, away_team_id FROM g WHERE game_type = 'regular' AND game_date >= DATE '{TODAY}'),
s AS (SELECT game, season, game_date, 'home' AS side, home_team_id AS entity FROM u UNION ALL SELECT game, season, game_date, 'away', away_team_id FROM u),
x AS (SELECT e.*, id AS game, season, game_date, home_team_id, away_team_id FROM e JOIN g ON e.game_id = g.retro_game_id WHERE game_type = 'regular' AND game_date < DATE '{TODAY}')"""
PITCHED_SQL = """count(*) FILTER (bat_event_fl = 'T') AS pa, count(*) FILTER (bat_event_fl = 'T' AND event_cd = '3') AS so, count(*) FILTER (bat_event_fl = 'T' AND event_cd IN ('14', '15')) AS bb,
count(*) FILTER (bat_event_fl = 'T' AND event_cd = '16') AS hbp, count(*) FILTER (bat_event_fl = 'T' AND event_cd = '23') AS hr, sum(event_outs_ct::INT) AS outs"""
LIVE_SQL = """round(CASE WHEN sum(pa) > 0 THEN sum(so) / sum(pa) END, 6) AS k_pct, round(CASE WHEN sum(pa) > 0 THEN sum(bb) / sum(pa) END, 6) AS bb_pct,
round(CASE WHEN sum(outs) > 0 THEN (13 * sum(hr) + 3 * sum(bb) - 2 * sum(so)) / (sum(outs) / 3) + 3.10 END, 6) AS fip"""


@query(half_up(f"""WITH {SO_FAR_SQL},
n AS (SELECT game, season, game_date, side, concat('P', (game + CASE side WHEN 'home' THEN 0 ELSE 3 END + CASE WHEN game % 5 = 0 THEN 7 ELSE 0 END) % 40) AS pitcher FROM s WHERE game % 11 <> 0),
c AS (SELECT resp_pit_id AS pitcher, season, game_date, bool_or(resp_pit_start_fl = 'T') AS started, {PITCHED_SQL} FROM x GROUP BY ALL)
SELECT n.game, n.side, n.pitcher, {LIVE_SQL}, round(CASE WHEN sum(pa) > 0 THEN sum(hr) / sum(pa) END, 6) AS hr_pct, (n.game_date - max(c.game_date) FILTER (started))::BIGINT AS rest_days,
  (sum(outs) FILTER (c.game_date >= n.game_date - 7))::BIGINT AS outs_7d, round(CASE WHEN substr(n.pitcher, 2)::INT % 7 > 0 THEN date_diff('day', DATE '1970-01-01' + substr(n.pitcher, 2)::INT * 97, n.game_date) / 365.25 END, 6) AS age
FROM n LEFT JOIN c ON c.pitcher = n.pitcher AND c.season = n.season AND c.game_date < n.game_date GROUP BY n.game, n.side, n.pitcher, n.game_date"""))
def fea_starter_to_come(t: Tables) -> DataFrame:
    """FEA-11, FEA-12, FEA-13: quality, rest, load and age of announced starters of games to come; a later announcement wins, one without a name doesn't."""
    side = lambda n, k: F.struct(F.lit(n).alias("side"), F.lit(k).alias("k"))
    named = games_so_far(t).filter("home_score is null and id % 11 <> 0").select(F.col("id").alias("game"), F.explode(F.array(side("home", 0), side("away", 3))).alias("s")).select("game", "s.*")
    first = named.select("game", "side", F.concat(F.lit("P"), (F.col("game") + F.col("k") + 7) % 40).alias("pitcher"), F.lit("2001-01-01").alias("captured_at"))
    then = named.select("game", "side", F.when(F.col("game") % 5 != 0, F.concat(F.lit("P"), (F.col("game") + F.col("k")) % 40)).alias("pitcher"), F.lit("2001-02-01").alias("captured_at"))
    said = first.unionByName(then)
    born = said.filter("pitcher is not null").select("pitcher").distinct().withColumn("_k", F.substring("pitcher", 2, 9).cast("int"))
    born = born.select("pitcher", F.when(F.col("_k") % 7 != 0, F.date_add(F.lit("1970-01-01").cast("date"), F.col("_k") * 97)).alias("birth_date"))
    rows = upcoming.starters_to_come(games_so_far(t), said, plays(t), born)
    return rounded(rows, "k_pct", "bb_pct", "fip", "hr_pct", "age").select("game", "side", F.col("entity").alias("pitcher"), "k_pct", "bb_pct", "fip", "hr_pct", F.col("rest_days").cast("long").alias("rest_days"), "outs_7d", "age")


@query(half_up(f"""WITH {SO_FAR_SQL},
c AS (SELECT CASE WHEN bat_home_id = '0' THEN home_team_id ELSE away_team_id END AS entity, season, game_date, {PITCHED_SQL} FROM x WHERE resp_pit_start_fl = 'F' GROUP BY ALL)
SELECT s.game, s.side, s.entity, {LIVE_SQL}, (sum(outs) FILTER (c.game_date >= s.game_date - 3))::BIGINT AS fatigue
FROM s LEFT JOIN c ON c.entity = s.entity AND c.season = s.season AND c.game_date < s.game_date GROUP BY s.game, s.side, s.entity"""))
def fea_bullpen_to_come(t: Tables) -> DataFrame:
    """FEA-14: relief of both teams of games to come."""
    rows = upcoming.relief_to_come(games_so_far(t), plays(t))
    return rounded(rows, "k_pct", "bb_pct", "fip").select("game", "side", "entity", "k_pct", "bb_pct", "fip", "fatigue")


@query(half_up(f"""WITH {GAMES_SQL}, {PLAYS_SQL}, v AS (SELECT * FROM e WHERE substr(game_id, 2)::BIGINT % 9 <> 4),
b AS (SELECT id AS game, season, game_date, game_number AS number, home_team_id AS entity, 'home' AS side FROM g WHERE game_type = 'regular' AND retro_game_id IN (SELECT game_id FROM v)
  UNION ALL SELECT id, season, game_date, game_number, away_team_id, 'away' FROM g WHERE game_type = 'regular' AND retro_game_id IN (SELECT game_id FROM v)),
c AS (SELECT g.id AS game, CASE WHEN bat_home_id = '0' THEN home_team_id ELSE away_team_id END AS entity, {PITCHED_SQL} FROM v JOIN g ON v.game_id = g.retro_game_id WHERE resp_pit_start_fl = 'F' GROUP BY ALL),
z AS (SELECT b.*, coalesce(pa, 0) AS pa, coalesce(so, 0) AS so, coalesce(bb, 0) AS bb, coalesce(hbp, 0) AS hbp, coalesce(hr, 0) AS hr, coalesce(outs, 0) AS outs FROM b LEFT JOIN c USING (game, entity)),
p AS (SELECT game, entity, side, game_date, sum(pa) OVER w AS pa, sum(so) OVER w AS so, sum(bb) OVER w AS bb, sum(hbp) OVER w AS hbp, sum(hr) OVER w AS hr, sum(outs) OVER w AS outs FROM z
  WINDOW w AS (PARTITION BY entity, season ORDER BY game_date, number, game ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
d AS (SELECT entity, game_date, sum(outs) OVER (PARTITION BY entity ORDER BY game_date RANGE BETWEEN INTERVAL 3 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING) AS fatigue FROM (SELECT entity, game_date, sum(outs) AS outs FROM z GROUP BY ALL))
SELECT game, entity, side, round(CASE WHEN pa > 0 THEN so / pa END, 6) AS k_pct, round(CASE WHEN pa > 0 THEN bb / pa END, 6) AS bb_pct, round(CASE WHEN outs > 0 THEN (13 * hr + 3 * (bb + hbp) - 2 * so) / (outs / 3) + 3.10 END, 6) AS fip, fatigue::BIGINT AS fatigue
FROM p JOIN d USING (entity, game_date)"""))
def fea_bullpen_covered(t: Tables) -> DataFrame:
    """FEA-14: relief entering each game that has events, games without a reliever counting as zeros and games without events not at all."""
    rows = upcoming.covered_relief(games(t), plays(t).filter(F.substring("game_id", 2, 20).cast("long") % 9 != 4))
    return rounded(rows, "k_pct", "bb_pct", "fip").select("game", "entity", "side", "k_pct", "bb_pct", "fip", "fatigue")


@query(half_up(f"""WITH {SO_FAR_SQL},
c AS (SELECT CASE WHEN bat_home_id = '1' THEN home_team_id ELSE away_team_id END AS entity, season, game_date, count(*) FILTER (bat_event_fl = 'T' AND event_cd = '14') AS ubb, count(*) FILTER (bat_event_fl = 'T' AND event_cd = '16') AS hbp,
  count(*) FILTER (bat_event_fl = 'T' AND event_cd = '20') AS b1, count(*) FILTER (bat_event_fl = 'T' AND event_cd = '21') AS b2, count(*) FILTER (bat_event_fl = 'T' AND event_cd = '22') AS b3, count(*) FILTER (bat_event_fl = 'T' AND event_cd = '23') AS hr,
  count(*) FILTER (ab_fl = 'T') AS ab, count(*) FILTER (sf_fl = 'T') AS sf FROM x GROUP BY ALL),
o AS (SELECT s.game, s.side, s.entity, s.season, s.game_date, (0.69 * sum(ubb) + 0.722 * sum(hbp) + 0.878 * sum(b1) + 1.242 * sum(b2) + 1.569 * sum(b3) + 2.015 * sum(hr))::DOUBLE / nullif(sum(ab) + sum(ubb) + sum(sf) + sum(hbp), 0) AS woba
  FROM s LEFT JOIN c ON c.entity = s.entity AND c.season = s.season AND c.game_date < s.game_date GROUP BY ALL),
l AS (SELECT d.season, d.game_date, (0.69 * sum(ubb) + 0.722 * sum(hbp) + 0.878 * sum(b1) + 1.242 * sum(b2) + 1.569 * sum(b3) + 2.015 * sum(hr))::DOUBLE / nullif(sum(ab) + sum(ubb) + sum(sf) + sum(hbp), 0) AS league
  FROM (SELECT DISTINCT season, game_date FROM s) d JOIN c ON c.season = d.season AND c.game_date < d.game_date GROUP BY ALL),
k AS (SELECT home_team_id AS entity, season, home_score + away_score AS total, TRUE AS home FROM g WHERE game_type = 'regular' AND game_date < DATE '{TODAY}' UNION ALL SELECT away_team_id, season, home_score + away_score, FALSE FROM g WHERE game_type = 'regular' AND game_date < DATE '{TODAY}'),
r AS (SELECT entity, season, avg(total) FILTER (home) / nullif(avg(total) FILTER (NOT home), 0) * 100 AS ratio FROM k GROUP BY ALL),
f AS (SELECT d.entity, d.season, avg(ratio) AS park FROM (SELECT DISTINCT entity, season FROM s) d JOIN r ON r.entity = d.entity AND r.season BETWEEN d.season - 3 AND d.season - 1 GROUP BY ALL)
SELECT game, side, o.entity, round(woba, 6) AS woba, round(league, 6) AS league_woba, round(park, 4) AS park_factor, round(((woba - league) / 1.2 + 1) / (coalesce(park, 100) / 100) * 100, 4) AS wrc_plus
FROM o LEFT JOIN l USING (season, game_date) LEFT JOIN f ON f.entity = o.entity AND f.season = o.season"""))
def fea_offense_to_come(t: Tables) -> DataFrame:
    """FEA-09, FEA-10: wOBA and wRC+ of both teams of games to come, by the park of up to three seasons before."""
    rows = upcoming.offense_to_come(games_so_far(t), plays(t))
    rows = rows.withColumns({"woba": F.round("woba", 6), "league_woba": F.round("league_woba", 6), "park_factor": F.round("park_factor", 4), "wrc_plus": F.round("wrc_plus", 4)})
    return rows.select("game", "side", "entity", "woba", "league_woba", "park_factor", "wrc_plus")


_HAND = lambda h: f"""count(*) FILTER (bat_hand_cd = '{h}') AS pa_{h}, count(*) FILTER (bat_hand_cd = '{h}' AND event_cd = '3') AS so_{h}, (0.69 * count(*) FILTER (bat_hand_cd = '{h}' AND event_cd = '14') + 0.72 * count(*) FILTER (bat_hand_cd = '{h}' AND event_cd = '16')
  + 0.89 * count(*) FILTER (bat_hand_cd = '{h}' AND event_cd = '20') + 1.27 * count(*) FILTER (bat_hand_cd = '{h}' AND event_cd = '21') + 1.62 * count(*) FILTER (bat_hand_cd = '{h}' AND event_cd = '22') + 2.10 * count(*) FILTER (bat_hand_cd = '{h}' AND (event_cd = '23' OR h_cd = '4'))) AS w_{h}"""  # noqa: E731


@query(half_up(f"""WITH {GAMES_SQL}, {PLAYS_SQL}, c AS (SELECT g.id AS game, season, game_date, game_number AS number, resp_pit_id AS entity, {_HAND('L')}, {_HAND('R')} FROM e JOIN g ON e.game_id = g.retro_game_id
  WHERE game_type = 'regular' AND resp_pit_start_fl = 'T' AND bat_event_fl = 'T' GROUP BY ALL),
p AS (SELECT game, entity, {', '.join(f'sum({n}_{h}) OVER w AS {n}_{h}' for h in 'LR' for n in ('pa', 'so', 'w'))} FROM c WINDOW w AS (PARTITION BY entity, season ORDER BY game_date, number, game ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT game, entity, {', '.join(f"round(CASE WHEN pa_{h} >= 15 THEN so_{h} / pa_{h} END, 6) AS vs_{n}_k_pct, round(CASE WHEN pa_{h} >= 15 THEN w_{h}::DOUBLE / pa_{h} END, 6) AS vs_{n}_woba" for h, n in (('L', 'lhb'), ('R', 'rhb')))} FROM p"""))
def fea_platoon(t: Tables) -> DataFrame:
    """FEA-19: starters against left- and right-handed batters entering each game."""
    names = [f"vs_{h}_{v}" for h in ("lhb", "rhb") for v in ("k_pct", "woba")]
    return rounded(upcoming.platoon(plays(t), games(t)), *names).select("game", "entity", *names)


@query(half_up(f"""WITH {GAMES_SQL}, m AS (SELECT o_custkey % 30 AS team_id, year(o_orderdate) AS season, sum((20 + o_custkey % 13) * (o_orderkey % 5)) / sum(o_orderkey % 5) AS speed FROM orders WHERE o_orderkey % 5 > 0 GROUP BY ALL),
w AS (SELECT DISTINCT o_custkey AS player, year(o_orderdate) AS season, concat('T', o_custkey % 30) AS code, o_custkey % 4 = 0 AS is_pitcher FROM orders),
q AS (SELECT o_custkey AS player, year(o_orderdate) AS season, count(*) AS runs FROM orders WHERE o_custkey % 3 <> 2 GROUP BY ALL),
r AS (SELECT substr(code, 2)::INT AS team_id, season, sum(runs) AS framing FROM q JOIN w USING (player, season) WHERE NOT is_pitcher AND (substr(code, 2)::INT <> 5 OR season <= 1999) GROUP BY ALL)
SELECT g.id, round(hs.speed, 6) AS home_speed, round(aw.speed, 6) AS away_speed, hf.framing::BIGINT AS home_framing, af.framing::BIGINT AS away_framing FROM g
LEFT JOIN m hs ON hs.team_id = home_team_id AND hs.season = g.season - 1 LEFT JOIN m aw ON aw.team_id = away_team_id AND aw.season = g.season - 1
LEFT JOIN r hf ON hf.team_id = home_team_id AND hf.season = g.season - 1 LEFT JOIN r af ON af.team_id = away_team_id AND af.season = g.season - 1"""))
def fea_speed_framing(t: Tables) -> DataFrame:
    """FEA-21: weighted sprint speed and catchers' framing of each side's season before."""
    o = t.orders.withColumn("season", F.year("o_orderdate"))
    speed = upcoming.weighted_season(o.select((F.col("o_custkey") % 30).alias("team_id"), "season", (20 + F.col("o_custkey") % 13).alias("speed"), (F.col("o_orderkey") % 5).alias("runs")), ["team_id", "season"], "speed", "runs", "speed")
    clubs = o.select(F.col("o_custkey").alias("player"), "season", F.concat(F.lit("T"), F.col("o_custkey") % 30).alias("code"), (F.col("o_custkey") % 4 == 0).alias("is_pitcher")).distinct()
    catchers = o.filter("o_custkey % 3 <> 2").groupBy(F.col("o_custkey").alias("player"), "season").agg(F.count("*").alias("runs"))
    teams = clubs.select("code").distinct().select("code", F.substring("code", 2, 9).cast("int").alias("team_id"), F.lit(1900).alias("first_year"), F.when(F.col("code") == "T5", 1999).otherwise(9999).alias("last_year"))
    seasons = speed.join(upcoming.framing(catchers, clubs, teams), ["team_id", "season"], "full_outer")
    rows = features.prior_season(games(t), seasons, ["speed", "framing"])
    return rows.select("id", F.round("home_speed", 6).alias("home_speed"), F.round("away_speed", 6).alias("away_speed"), "home_framing", "away_framing")
