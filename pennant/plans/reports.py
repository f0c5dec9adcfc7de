"""Season marts: players, teams, divisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pennant.functions import clean
from pennant.operators import aggregates, joins
from pennant.operators.sets import stacked
from pennant.plans.features import WOBA, wrc_plus


def player_season(batting: DataFrame, pitching: DataFrame, players: DataFrame, war: DataFrame) -> DataFrame:
    """Batting and pitching lines by player and season with summed WAR."""
    number = lambda df, names: [F.sum(clean.number(F.col(c), "long")).alias(c) for c in names if c in df.columns]
    lines = []
    for kind, df, names in (("bat", batting, ("ab", "h", "hr", "bb", "so")), ("pitch", pitching, ("w", "l", "er", "so", "outs"))):
        lines.append(df.groupBy("player_key", F.col("season").try_cast("int").alias("season")).agg(*number(df, names)).withColumn("role", F.lit(kind)))
    total = war.groupBy("player_key", F.col("season").try_cast("int").alias("season"), F.when(F.col("is_pitcher"), "pitch").otherwise("bat").alias("role")).agg(F.sum(clean.number(F.col("war"))).alias("war"), F.sum(clean.number(F.col("waa"))).alias("waa"))
    return stacked(lines).join(players.select("player_key", "name"), "player_key").join(total, ["player_key", "season", "role"], "left")


def team_season(totals: DataFrame, eras: DataFrame) -> DataFrame:
    """Team totals with their era; a team and year that comes twice is left out altogether."""
    return joins.era_join(joins.only_unambiguous(totals, ["team_code", "season"]), eras, ["team_code"], "season", "first_year", "last_year")


def park_factors(games: DataFrame) -> DataFrame:
    """Per team and season: runs per game at home against away, mean of the three seasons before."""
    rows = joins.either_side(games, {"home": "home_team_id", "away": "away_team_id"}, "team_id", ["season", "home_score", "away_score"])
    rows = rows.withColumn("runs", F.col("home_score") + F.col("away_score"))
    return aggregates.park_factor(rows, "team_id", "season", F.col("side") == "home", "runs")


def team_offense(events: DataFrame, factors: DataFrame | None = None) -> DataFrame:
    """Full-season wOBA of each team against its league, and wRC+. Every event counts, whatever its batter flag."""
    codes = {"ubb": "14", "hbp": "16", "b1": "20", "b2": "21", "b3": "22", "hr": "23"}
    conditions = {n: F.col("event_cd") == c for n, c in codes.items()} | {"ab": F.col("ab_fl") == "T", "sf": F.col("sf_fl") == "T"}
    counts = aggregates.count_where(events, ["season", "team_id"], conditions)
    rows = aggregates.with_league(counts, ["season", "team_id"], ["season"], list(conditions))
    whole = ("ab", "ubb", "sf", "hbp")
    league = aggregates.linear_weights({f"league_{n}": w for n, w in WOBA.items()}, [f"league_{n}" for n in whole])
    rows = rows.select("season", "team_id", aggregates.linear_weights(WOBA, whole).alias("woba"), league.alias("league_woba"))
    if factors is None:
        return rows
    rows = rows.join(factors.select("season", "team_id", "park_factor"), ["season", "team_id"], "left")
    return rows.withColumn("wrc_plus", wrc_plus(F.col("woba"), F.col("league_woba"), F.coalesce("park_factor", F.lit(100.0))))


def team_war(war: DataFrame, codes: dict[str, str]) -> DataFrame:
    """WAR by team and season, through a map of team codes."""
    named = war.withColumn("team_code", clean.recode(F.col("team_code"), codes, F.col("team_code")))
    return named.groupBy("team_code", "season").agg(F.sum(clean.number(F.col("war"))).alias("war"))


def division_standing(standings: DataFrame, teams: DataFrame) -> DataFrame:
    """Standings with names and a win share where games were played."""
    rows = standings.join(teams.select(F.col("id").alias("team_id"), "city", "nickname", "division"), "team_id")
    played = F.col("wins") + F.col("losses")
    return rows.select("season", "division", "team_id", clean.display_name(F.col("city"), F.col("nickname")).alias("name"), "wins", "losses", "rank", "games_back", clean.rate(F.col("wins"), played).alias("win_pct"))


def health(marts: dict[str, tuple[DataFrame, DataFrame, Column, float]]) -> DataFrame:
    """mart, n, joined, coverage, status of marts (facts, dimension, condition, least coverage): EMPTY, FAIL, or PASS. More joined rows than facts fail."""
    out = None
    for name, (facts, side, on, least) in marts.items():
        n, joined = facts.agg(F.count("*").alias("n")), facts.join(side, on).agg(F.count("*").alias("joined"))
        coverage = F.col("joined") / F.nullif(F.col("n").cast("double"), F.lit(0.0))
        status = F.when(F.col("n") == 0, "EMPTY").when((coverage < least) | (coverage > 1), "FAIL").otherwise("PASS")
        one = n.join(F.broadcast(joined)).select(F.lit(name).alias("mart"), "n", "joined", F.round(coverage, 6).alias("coverage"), status.alias("status"))
        out = one if out is None else out.unionByName(one)
    return out
