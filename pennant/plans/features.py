"""Point-in-time features of games, from play-by-play events.

Every family is counts by game and entity, their sums over the entity's earlier
games of the season, and formulas over these sums with a least sample. All
counts of one kind of entity come from one pass and one window, so families
share the shuffle. `sides` turns the tall result into home_ and away_ columns.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pennant.functions import clean
from pennant.operators import aggregates, windows
from pennant.sources.sinks import update_from

#: Event codes, linear weights and constants of the published formulas.
STRIKEOUT, WALK, INTENTIONAL, HIT_BY_PITCH, SINGLE, DOUBLE, TRIPLE, HOMER = "3", "14", "15", "16", "20", "21", "22", "23"
WOBA = {"ubb": 0.690, "hbp": 0.722, "b1": 0.878, "b2": 1.242, "b3": 1.569, "hr": 2.015}
PLATOON_WOBA = {"ubb": 0.69, "hbp": 0.72, "b1": 0.89, "b2": 1.27, "b3": 1.62, "hr": 2.10}
WOBA_SCALE, FIP_CONSTANT, HR_PER_FLY, RUNS_PER_PA, PYTHAGENPAT = 1.20, 3.10, 0.105, 0.12, 0.287
RUN_SB, RUN_CS = 0.2, -0.42
#: Leverage by outs, for bases ___, 1__, _2_, __3, 12_, 1_3, _23, 123.
LEVERAGE = {
    0: (0.85, 1.15, 1.25, 1.45, 1.55, 1.65, 1.80, 2.10),
    1: (0.70, 1.05, 1.20, 1.40, 1.50, 1.60, 1.75, 2.05),
    2: (0.50, 0.85, 1.05, 1.25, 1.35, 1.45, 1.60, 1.90),
}
BASES = ("___", "1__", "_2_", "__3", "12_", "1_3", "_23", "123")
#: Expected average, slugging and wOBA by trajectory: homer, line, fly, ground, popup.
EXPECTED = {"xba": (1.000, 0.685, 0.210, 0.235, 0.020), "xslg": (4.000, 0.880, 0.560, 0.260, 0.020), "xwoba": (2.100, 0.650, 0.320, 0.220, 0.020)}
PITCHES, CALLED_OR_SWINGING, WHIFF, SWING, FIRST_STRIKE = "BCFKLMOPSTUVWXI", "CSM", "SM", "SMFLTOX", "CSFKTMLOX"


def _code(*codes: str) -> Column:
    return F.col("event_cd").isin(*codes)


def _is(name: str) -> Column:
    return F.col(name) == "T"


def plate_flags() -> dict[str, Column]:
    """What a plate appearance counts for."""
    pa = _is("bat_event_fl")
    codes = {"ubb": WALK, "ibb": INTENTIONAL, "hbp": HIT_BY_PITCH, "b1": SINGLE, "b2": DOUBLE, "b3": TRIPLE, "hr": HOMER, "so": STRIKEOUT}
    return {"pa": pa, **{n: pa & _code(c) for n, c in codes.items()}, "ab": _is("ab_fl"), "sf": _is("sf_fl")}


def contact_flags() -> dict[str, Column]:
    ball, bare = F.col("battedball_cd"), clean.empty_to_null(F.col("battedball_cd")).isNull()
    homer = _code(HOMER) | (F.coalesce(F.col("h_cd"), F.lit("")) == "4")
    fly = (ball == "F") | (homer & bare)
    bip = ball.isin("G", "F", "L", "P") | (homer & bare)
    return {
        "gb": ball == "G", "fb": fly, "ld": ball == "L", "pu": ball == "P", "hr_hit": homer, "bip": bip,
        "hard": (ball == "L") | _code(HOMER) | F.col("h_cd").isin("2", "3", "4"), "barrel": ((ball == "L") & _code(DOUBLE, TRIPLE, HOMER)) | homer,
        "x_ab": _code(STRIKEOUT) | bip,
    }


def steal_flags() -> dict[str, list[Column]]:
    return {"sb": [_is(f"run{k}_sb_fl") for k in (1, 2, 3)], "cs": [_is(f"run{k}_cs_fl") for k in (1, 2, 3)]}


def expected_value(kind: str) -> Column:
    homer, line, fly, ground, popup = EXPECTED[kind]
    ball = F.col("battedball_cd")
    return F.coalesce(clean.by_cases([(_code(HOMER) | (F.col("h_cd") == "4"), homer), (ball == "L", line), (ball == "F", fly), (ball == "G", ground), (ball == "P", popup)]), F.lit(0.0))


def leverage() -> Column:
    """Leverage of the state before a play, from the 24-cell table."""
    cells = [F.lit(v) for outs in LEVERAGE for pair in zip(BASES, LEVERAGE[outs], strict=True) for v in (f"{outs}{pair[0]}", pair[1])]
    state = F.concat(F.least(F.col("outs_ct").try_cast("int"), F.lit(2)).cast("string"), clean.base_state(F.col("base1_run_id"), F.col("base2_run_id"), F.col("base3_run_id")))
    return F.try_element_at(F.create_map(*cells), state)


def discipline() -> dict[str, Column]:
    pitches = F.regexp_replace("pitch_seq_tx", f"[^{PITCHES}]", "")
    return {
        "pitches": F.length(pitches), "csw": clean.count_class(pitches, CALLED_OR_SWINGING), "whiffs": clean.count_class(pitches, WHIFF), "swings": clean.count_class(pitches, SWING),
        "fstrikes": clean.flag((F.length(pitches) > 0) & clean.first_in_class(pitches, FIRST_STRIKE)), "seen_pa": clean.flag((F.length(pitches) > 0) & _is("bat_event_fl")),
    }


def event_measures() -> dict[str, Column]:
    """All counts by name as numbers per event."""
    measures = {n: clean.flag(c) for n, c in {**plate_flags(), **contact_flags()}.items()}
    measures |= {n: sum((clean.flag(c) for c in parts), F.lit(0)) for n, parts in steal_flags().items()}
    # Weights are added up as decimals, so their sums don't depend on the order of rows.
    exact = lambda c: F.when(_is("bat_event_fl"), c).otherwise(F.lit(0.0)).cast("decimal(12,3)")
    measures |= {n: exact(expected_value(n)) for n in EXPECTED}
    number = lambda c: F.coalesce(F.col(c).try_cast("long"), F.lit(0))
    measures |= {"outs": number("event_outs_ct"), "runs": number("event_runs_ct"), "li": exact(leverage())}
    return measures | {n: F.coalesce(c, F.lit(0)) for n, c in discipline().items()}


EVENTS_A_TASK = 200_000
EVENT_COLUMNS = (
    "game_id event_cd bat_home_id bat_event_fl ab_fl sf_fl battedball_cd h_cd outs_ct base1_run_id base2_run_id base3_run_id event_outs_ct event_runs_ct resp_pit_id resp_pit_start_fl pitch_seq_tx "
    "run1_sb_fl run2_sb_fl run3_sb_fl run1_cs_fl run2_cs_fl run3_cs_fl bat_hand_cd"
).split()


def complete(events: DataFrame) -> DataFrame:
    """Events with every column the families read; absent ones are null."""
    return events.select(*[F.col(c).cast("string").alias(c) if c in events.columns else F.lit(None).cast("string").alias(c) for c in EVENT_COLUMNS])


def counted(events: DataFrame, games: DataFrame, entity: str) -> DataFrame:
    """Counts by game and entity: "batting", "pitching", "bullpen" (teams) or "starter" (pitchers)."""
    home = F.col("bat_home_id") == "1"
    who = {
        "batting": F.when(home, F.col("home_team_id")).otherwise(F.col("away_team_id")), "pitching": F.when(home, F.col("away_team_id")).otherwise(F.col("home_team_id")),
        "bullpen": F.when(home, F.col("away_team_id")).otherwise(F.col("home_team_id")), "starter": F.col("resp_pit_id"),
    }[entity]
    g = games.select(F.col("id").alias("_g"), F.col("retro_game_id").alias("_r"), "season", "game_date", "game_number", "home_team_id", "away_team_id", "game_type").filter("game_type = 'regular'")
    # A task joins and adds up the games of some EVENTS_A_TASK events, however many there are.
    parts = max(int(events.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-events.count() // EVENTS_A_TASK))
    rows = complete(events).repartition(parts, "game_id").join(g, F.col("game_id") == F.col("_r"))
    if entity in ("bullpen", "starter"):
        rows = rows.filter(F.col("resp_pit_start_fl") == ("T" if entity == "starter" else "F"))
    keys = [F.col("_g").alias("game"), "season", "game_date", F.coalesce(F.col("game_number").cast("long"), F.lit(0)).alias("number"), who.alias("entity")]
    return rows.groupBy(*keys).agg(*[F.sum(m).alias(n) for n, m in event_measures().items()])


def entering(counts: DataFrame, names: Sequence[str], career: bool = False) -> DataFrame:
    """Sums over the entity's games before, by its name; null in the first one."""
    keys = ["entity"] if career else ["entity", "season"]
    out = windows.prior(counts, keys, ["game_date", "number", "game"], {f"p_{n}": n for n in names})
    return out.withColumns({f"p_{n}": F.col(f"p_{n}").cast("double") for n in names if n in (*EXPECTED, "li")})


def _p(name: str) -> Column:
    return F.col(f"p_{name}")


def _sum(*names: str) -> Column:
    return sum((_p(n) for n in names[1:]), _p(names[0]))


def batting_rates(counts: DataFrame, min_pa: int = 10, min_ab: int = 8, min_bip: int = 8, min_attempts: int = 5) -> DataFrame:
    """OBP, SLG, ISO, BABIP, BB%, K%, wOBA, wSB and RE24 proxy of each team entering each game."""
    df = entering(counts, ["ubb", "ibb", "hbp", "b1", "b2", "b3", "hr", "so", "ab", "sf", "sb", "cs", "pa", "runs"])
    hits, bases = _sum("b1", "b2", "b3", "hr"), _p("b1") + 2 * _p("b2") + 3 * _p("b3") + 4 * _p("hr")
    pa, in_play = _sum("ab", "ubb", "ibb", "sf", "hbp"), _p("ab") - _p("so") - _p("hr") + _p("sf")
    # The league's sums are joined once, by day.
    df = windows.prior_of_all(df, "season", "game_date", {f"l_{n}": n for n in ("sb", "cs", "b1", "ubb", "hbp", "pa", "ab", "sf", "b2", "b3", "hr")})
    steals = lambda sb, cs: F.coalesce(sb, F.lit(0)) * RUN_SB + F.coalesce(cs, F.lit(0)) * RUN_CS
    chances = F.col("l_b1") + F.col("l_ubb") + F.col("l_hbp")
    rate = F.when(chances > 0, steals(F.col("l_sb"), F.col("l_cs")) / chances)
    woba = sum((_p(n) * w for n, w in WOBA.items()), F.lit(0.0)) / F.nullif(_sum("ab", "ubb", "sf", "hbp").cast("double"), F.lit(0.0))
    l_woba = sum((F.col(f"l_{n}") * w for n, w in WOBA.items()), F.lit(0.0)) / F.nullif((F.col("l_ab") + F.col("l_ubb") + F.col("l_sf") + F.col("l_hbp")).cast("double"), F.lit(0.0))
    attempts = F.coalesce(_p("sb"), F.lit(0)) + F.coalesce(_p("cs"), F.lit(0))
    return df.select(
        "game", "entity", pa.alias("pa"), clean.rate(hits + _sum("ubb", "ibb", "hbp"), pa, min_pa).alias("obp"), clean.rate(bases, _p("ab"), min_ab).alias("slg"),
        clean.rate(bases - hits, _p("ab"), min_ab).alias("iso"), clean.rate(hits - _p("hr"), in_play, min_bip).alias("babip"), clean.rate(_sum("ubb", "ibb"), pa, min_pa).alias("bb_pct"),
        clean.rate(_p("so"), pa, min_pa).alias("k_pct"), woba.alias("woba"), l_woba.alias("league_woba"), _p("sb").alias("sb"), _p("cs").alias("cs"),
        F.when(attempts >= min_attempts, steals(_p("sb"), _p("cs")) - rate * _sum("b1", "ubb", "hbp")).alias("wsb"),
        F.when(_p("pa") >= 50, F.round(_p("runs") - RUNS_PER_PA * _p("pa"), 4)).alias("re24_proxy"),
    )


def wrc_plus(woba: Column, league_woba: Column, park_factor: Column) -> Column:
    return ((woba - league_woba) / WOBA_SCALE + 1) / (park_factor / 100) * 100


def pitching_rates(counts: DataFrame, min_pa: int = 30, min_pitches: int = 20, min_swings: int = 10, min_first: int = 5, min_balls: int = 10, min_flies: int = 5, career: bool = False) -> DataFrame:
    """FIP, xFIP, SIERA, discipline, batted balls, leverage and expected metrics entering each game."""
    names = ["pa", "so", "ubb", "ibb", "hbp", "hr", "outs", "gb", "fb", "ld", "pu", "hr_hit", "bip", "hard", "barrel", "x_ab", "xba", "xslg", "xwoba", "li", "runs", "pitches", "csw", "whiffs", "swings", "fstrikes", "seen_pa"]
    df = entering(counts, names, career)
    walks, innings = _sum("ubb", "ibb"), _p("outs") / 3.0
    share = lambda n: _p(n) / F.nullif(_p("pa").cast("double"), F.lit(0.0))
    k, bb, gb = share("so"), walks / F.nullif(_p("pa").cast("double"), F.lit(0.0)), share("gb")
    siera = (
        6.145 - 16.984 * k + 11.434 * bb - 1.858 * ((_p("gb") - _p("fb") - _p("pu")) / F.nullif(_p("pa").cast("double"), F.lit(0.0))) + 7.653 * k * k + 6.664 * gb * gb - 9.096 * k * gb - 3.037 * bb * gb
    )
    fip = lambda homers: (13 * homers + 3 * (walks + _p("hbp")) - 2 * _p("so")) / innings + FIP_CONSTANT
    balls = _sum("gb", "fb", "ld", "pu")
    return df.select(
        "game", "entity", _p("pa").alias("pa"), F.when(_p("outs") > 0, fip(_p("hr"))).alias("fip"), F.when((_p("pa") >= min_pa) & (_p("outs") >= 9), F.round(fip(HR_PER_FLY * _p("fb")), 4)).alias("xfip"),
        F.when(_p("pa") >= min_pa, F.round(siera, 4)).alias("siera"), clean.rate(_p("so"), _p("pa")).alias("k_pct"), clean.rate(walks, _p("pa")).alias("bb_pct"), clean.rate(_p("hr"), _p("pa")).alias("hr_pct"),
        clean.rate(_p("csw"), _p("pitches"), min_pitches).alias("csw_pct"), clean.rate(_p("whiffs"), _p("swings"), min_swings).alias("whiff_pct"), clean.rate(_p("fstrikes"), _p("seen_pa"), min_first).alias("fstrike_pct"),
        clean.rate(_p("gb"), balls, min_balls).alias("gb_pct"), clean.rate(_p("fb"), balls, min_balls).alias("fb_pct"), clean.rate(_p("ld"), balls, min_balls).alias("ld_pct"), clean.rate(_p("hr_hit"), _p("fb"), min_flies).alias("hr_fb"),
        F.when(_p("pa") >= min_pa, F.round(_p("li") / _p("pa"), 4)).alias("avg_li"), F.when(_p("pa") >= min_pa, F.round(RUNS_PER_PA * _p("pa") - _p("runs"), 4)).alias("re24_proxy"),
        clean.rate(_p("hard"), _p("bip"), 5).alias("hard_hit_pct"), clean.rate(_p("barrel"), _p("bip"), 5).alias("barrel_pct"), clean.rate(_p("xba"), _p("x_ab"), 10).alias("xba"), clean.rate(_p("xslg"), _p("x_ab"), 10).alias("xslg"),
        F.when(_p("pa") >= 10, (_p("xwoba") + WOBA["ubb"] * walks + WOBA["hbp"] * _p("hbp")) / _p("pa")).alias("xwoba"),
    )


def fatigue(counts: DataFrame, days: int = 3) -> DataFrame:
    """Outs and pitches of the days before, across seasons; doubleheader games share a day's value."""
    rows = windows.trailing_days(counts, ["entity"], "game_date", {"outs": "outs", "pitches": "pitches"}, days)
    load = rows.select("entity", "game_date", F.col("prior_outs").alias(f"outs_{days}d"), F.col("prior_pitches").alias(f"pitches_{days}d"))
    return counts.select("game", "entity", "game_date").join(load, ["entity", "game_date"])


def starter_rest(counts: DataFrame) -> DataFrame:
    """Days since the start before, outs of the week before, and starts so far."""
    order = ["game_date", "number", "game"]
    df = windows.rest_days(counts, ["entity"], order, "game_date")
    df = windows.prior(df, ["entity"], order, {"career_starts": F.lit(1)}, how="count")
    week = fatigue(counts, 7).select("game", "entity", "outs_7d")
    return df.select("game", "entity", "rest_days", "career_starts").join(week, ["game", "entity"])


def team_games(games: DataFrame) -> DataFrame:
    """Two rows per regular game: the side's team, runs for and against, and whether it won; games to come have nulls."""
    side = lambda s, o: F.struct(F.lit(s).alias("side"), F.col(f"{s}_team_id").alias("entity"), F.col(f"{s}_score").alias("rf"), F.col(f"{o}_score").alias("ra"))
    rows = games.filter("game_type = 'regular'").select(F.col("id").alias("game"), "season", "game_date", F.coalesce(F.col("game_number").cast("long"), F.lit(0)).alias("number"), F.explode(F.array(side("home", "away"), side("away", "home"))).alias("s"))
    return rows.select("game", "season", "game_date", "number", "s.*", (F.col("s.rf") > F.col("s.ra")).cast("int").alias("won"))


def team_form(games: DataFrame) -> DataFrame:
    """Wins, losses, win share, last ten, runs, Pythagenpat and rest of each team entering each game."""
    order, keys = ["game_date", "number", "game"], ["entity", "season"]
    df = windows.prior(team_games(games), keys, order, {"wins": "won", "runs_for": "rf", "runs_against": "ra"})
    df = windows.prior(df, keys, order, {"played": "won"}, how="count")
    df = windows.prior(df, keys, order, {"win_pct_10": "won"}, rows=10, how="avg")
    df = windows.rest_days(df, ["entity"], order, "game_date")
    per_game = (F.col("runs_for") + F.col("runs_against")) / F.nullif(F.col("played").cast("double"), F.lit(0.0))
    x = F.pow(per_game, F.lit(PYTHAGENPAT))
    f, a = F.pow(F.col("runs_for").cast("double"), x), F.pow(F.col("runs_against").cast("double"), x)
    return df.select(
        "game", "entity", "side", "wins", (F.col("played") - F.col("wins")).alias("losses"), clean.rate(F.col("wins"), F.col("played")).alias("win_pct"), "win_pct_10",
        (F.col("win_pct_10") - clean.rate(F.col("wins"), F.col("played"))).alias("trend"), clean.rate(F.col("runs_for"), F.col("played")).alias("runs_for"), clean.rate(F.col("runs_against"), F.col("played")).alias("runs_against"),
        F.when(f + a > 0, f / (f + a)).alias("pythagenpat"), "rest_days",
    )


def sides(games: DataFrame, tall: DataFrame, values: Sequence[str], prefix: str = "") -> DataFrame:
    """games with home_ and away_ columns of a tall table by team."""
    named = tall.select(F.col("game").alias("id"), F.col("entity").alias("team_id"), *[F.col(v).alias(f"{prefix}{v}") for v in values])
    return update_from(games, named, "id", "team_id", ["home", "away"], [f"{prefix}{v}" for v in values])


def of_range(games: DataFrame, first: str, last: str, family: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A family's rows of the games from first to last, built from these and what lies before; later games aren't read."""
    mine = games.filter(F.col("game_date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))).select(F.col("id").alias("game"))
    return family(games.filter(F.col("game_date") <= F.lit(last).cast("date"))).join(mine, "game", "left_semi")


def export_view(games: DataFrame, tall: DataFrame, values: Sequence[str]) -> DataFrame:
    """Decided regular games with their label and both sides' values."""
    rows = sides(games.filter("game_type = 'regular' and home_score <> away_score"), tall, values)
    names = [f"{side}_{v}" for v in values for side in ("home", "away")]
    return rows.select(F.col("id").alias("game_id"), "season", "game_date", "home_team_id", "away_team_id", (F.col("home_score") > F.col("away_score")).alias("home_won"), *names)


def differences(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumns({f"{n}_diff": F.col(f"home_{n}") - F.col(f"away_{n}") for n in names})


def prior_season(games: DataFrame, seasons: DataFrame, values: Sequence[str]) -> DataFrame:
    """home_ and away_ values of each team's season before (fielding, speed, framing, WAR)."""
    for side in ("home", "away"):
        past = seasons.select(F.col("team_id").alias(f"{side}_team_id"), (F.col("season") + 1).alias("season"), *[F.col(v).alias(f"{side}_{v}") for v in values])
        games = games.join(past, [f"{side}_team_id", "season"], "left")
    return games


def run_expectancy_matrix(events: DataFrame) -> DataFrame:
    """Mean runs to the end of the inning by outs and bases, from complete innings; all 24 cells."""
    half = ["game_id", "inn_ct", "bat_home_id"]
    rows = events.select(*half, F.col("event_id").try_cast("int").alias("event_id"), F.col("outs_ct").try_cast("int").alias("outs"), clean.base_state(F.col("base1_run_id"), F.col("base2_run_id"), F.col("base3_run_id")).alias("bases"), F.col("event_runs_ct").try_cast("int").alias("runs"), F.col("event_outs_ct").try_cast("int").alias("made"))
    whole = rows.withColumn("_all", F.sum("made").over(Window.partitionBy(*half))).filter("_all = 3")
    return aggregates.rest_expectancy(whole, half, ["event_id"], "runs", ["outs", "bases"])


def outcomes(predictions: DataFrame, games: DataFrame) -> DataFrame:
    """Predictions with what happened, where it is known."""
    known = games.filter("home_score is not null and away_score is not null and home_score <> away_score").select(F.col("id").alias("game"), (F.col("home_score") > F.col("away_score")).alias("_won"))
    return predictions.join(known, "game", "left").withColumn("home_won", F.coalesce(*(["home_won"] if "home_won" in predictions.columns else []), "_won")).drop("_won")


def market_predictions(markets: DataFrame, home: Mapping[str, str] | None = None) -> DataFrame:
    """The home side's implied probability as a prediction of its source."""
    return markets.filter("team_id = home_team_id and implied_probability is not null").select("game", F.concat(F.lit("market-"), "source").alias("model"), F.col("implied_probability").alias("p"), "as_of")
