"""Features of games that haven't been played, and the families that go with them: covered relief, platoon splits, age, weighted season values.

A game to come is a target: a key and a day. Targets and the days of the history
stand in one sequence by key and day, and a target takes sums over the days
before its own, so nothing is joined on `<` and nothing of its own day leaks in,
however many days ahead it was announced.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pennant.functions import clean
from pennant.operators import windows
from pennant.plans import features
from pennant.plans.features import FIP_CONSTANT, PLATOON_WOBA, WOBA

DAYS = "_day"


def entering_targets(targets: DataFrame, history: DataFrame, keys: Sequence[str], day: str, sums: Sequence[str], trailing: Mapping[str, tuple[str, int]] | None = None, last: Mapping[str, str] | None = None) -> DataFrame:
    """targets (with keys and day) and, over the history's days strictly before: sums under their names, sums of the last n days, days since a flag (name -> flag column) was last set.

    A target without history has nulls, and so has a trailing sum without a day in its range.
    """
    number = F.datediff(F.col(day), F.lit("1970-01-01").cast("date")).alias(DAYS)
    flags = dict(last or {})
    used = list(dict.fromkeys([*sums, *(c for c, _ in (trailing or {}).values())]))
    past = history.groupBy(*keys, number).agg(*[F.sum(c).alias(f"_s_{c}") for c in used], *[F.max(F.col(c).cast("int")).alias(f"_f_{c}") for c in flags.values()])
    rows = targets.select(*keys, number, F.struct(*targets.columns).alias("_t")).unionByName(past, allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(DAYS)
    before = w.rangeBetween(Window.unboundedPreceding, -1)
    made = {c: F.sum(f"_s_{c}").over(before) for c in sums}
    made |= {n: F.sum(f"_s_{c}").over(w.rangeBetween(-days, -1)) for n, (c, days) in (trailing or {}).items()}
    made |= {n: F.col(DAYS) - F.max(F.when(F.col(f"_f_{c}") == 1, F.col(DAYS))).over(before) for n, c in flags.items()}
    return rows.select("_t", *[c.alias(n) for n, c in made.items()]).filter("_t is not null").select("_t.*", *made)


def latest_announced(snapshots: DataFrame, keys: Sequence[str], value: str, at: str) -> DataFrame:
    """The value of each key's latest snapshot that has one."""
    best = F.max(F.struct(F.col(at), F.col(value))).alias("_b")
    return snapshots.filter(F.col(value).isNotNull()).groupBy(*keys).agg(best).select(*keys, F.col(f"_b.{value}").alias(value))


def appearances(events: DataFrame, games: DataFrame, who: Column, only: Column | None = None) -> DataFrame:
    """Counts of pitching by game and entity over decided regular games, and whether the entity started."""
    g = games.filter("game_type = 'regular' and home_score is not null").select(F.col("id").alias("_g"), F.col("retro_game_id").alias("_r"), "season", "game_date", "home_team_id", "away_team_id")
    rows = features.complete(events).join(g, F.col("game_id") == F.col("_r"))
    measures = features.event_measures()
    rows = rows if only is None else rows.filter(only)
    return rows.groupBy(F.col("_g").alias("game"), "season", "game_date", who.alias("entity")).agg(
        *[F.sum(measures[n]).alias(n) for n in ("pa", "so", "ubb", "ibb", "hbp", "hr", "outs", "b1", "b2", "b3", "ab", "sf")], F.max((F.col("resp_pit_start_fl") == "T").cast("int")).alias("started")
    )


def pitched(hit_batters: bool) -> dict[str, Column]:
    """Rates of sums: strikeouts, walks, homers, FIP (with hit batters where they are known)."""
    walks = F.col("ubb") + F.col("ibb")
    free = walks + F.col("hbp") if hit_batters else walks
    rate = lambda c: F.when(F.col("pa") > 0, c / F.col("pa"))
    return {"k_pct": rate(F.col("so")), "bb_pct": rate(walks), "hr_pct": rate(F.col("hr")), "fip": F.when(F.col("outs") > 0, (13 * F.col("hr") + 3 * free - 2 * F.col("so")) / (F.col("outs") / 3.0) + FIP_CONSTANT)}


def _to_come(games: DataFrame, sides: Column) -> DataFrame:
    rows = games.filter("game_type = 'regular' and home_score is null")
    return rows.select(F.col("id").alias("game"), "season", "game_date", F.explode(sides).alias("_s")).select("game", "season", "game_date", "_s.*")


def _teams() -> Column:
    return F.array(*[F.struct(F.lit(s).alias("side"), F.col(f"{s}_team_id").alias("entity")) for s in ("home", "away")])


def starters_to_come(games: DataFrame, announced: DataFrame, events: DataFrame, born: DataFrame) -> DataFrame:
    """Quality, rest, load and age of announced starters. announced: game, side, pitcher, captured_at; born: pitcher, birth_date."""
    named = latest_announced(announced, ["game", "side"], "pitcher", "captured_at")
    sides = F.array(*[F.struct(F.lit(s).alias("side")) for s in ("home", "away")])
    targets = _to_come(games, sides).join(named, ["game", "side"]).withColumnRenamed("pitcher", "entity")
    rows = entering_targets(targets, appearances(events, games, F.col("resp_pit_id")), ["entity", "season"], "game_date", ["pa", "so", "ubb", "ibb", "hbp", "hr", "outs"], {"outs_7d": ("outs", 7)}, {"rest_days": "started"})
    rows = rows.join(born.select(F.col("pitcher").alias("entity"), "birth_date"), "entity", "left")
    return rows.withColumns({**pitched(hit_batters=False), "age": age(F.col("game_date"), F.col("birth_date"))})


def age(day: Column, birth: Column) -> Column:
    """Years as a number, a year being 365.25 days."""
    return F.datediff(day, birth) / 365.25


def relief_to_come(games: DataFrame, events: DataFrame, days: int = 3) -> DataFrame:
    """Relief quality and outs of the days before of both teams of games to come."""
    team = F.when(F.col("bat_home_id") == "0", F.col("home_team_id")).otherwise(F.col("away_team_id"))
    history = appearances(events, games, team, F.col("resp_pit_start_fl") == "F")
    rows = entering_targets(_to_come(games, _teams()), history, ["entity", "season"], "game_date", ["pa", "so", "ubb", "ibb", "hbp", "hr", "outs"], {"fatigue": ("outs", days)})
    return rows.withColumns(pitched(hit_batters=False))


def covered_relief(games: DataFrame, events: DataFrame, days: int = 3) -> DataFrame:
    """Relief quality and fatigue of both teams entering every game that has events; a team that used no reliever has a game of zeros, a game without events is no game at all."""
    team = F.when(F.col("bat_home_id") == "0", F.col("home_team_id")).otherwise(F.col("away_team_id"))
    covered = events.select("game_id").distinct()
    backbone = games.filter("game_type = 'regular'").join(covered, F.col("retro_game_id") == F.col("game_id"), "left_semi")
    backbone = backbone.select(F.col("id").alias("game"), "season", "game_date", F.coalesce(F.col("game_number").cast("long"), F.lit(0)).alias("number"), F.explode(_teams()).alias("_s")).select("game", "season", "game_date", "number", "_s.*")
    names = ["pa", "so", "ubb", "ibb", "hbp", "hr", "outs"]
    used = appearances(events, games, team, F.col("resp_pit_start_fl") == "F").select("game", "entity", *names)
    rows = backbone.join(used, ["game", "entity"], "left").fillna(0, names)
    loads = windows.trailing_days(rows, ["entity"], "game_date", {"outs": "outs"}, days).select("entity", "game_date", F.col("prior_outs").alias("fatigue"))
    sums = windows.prior(rows, ["entity", "season"], ["game_date", "number", "game"], {f"_p_{n}": n for n in names})
    sums = sums.select("game", "entity", "side", "game_date", *[F.col(f"_p_{n}").alias(n) for n in names]).withColumns(pitched(hit_batters=True))
    return sums.join(loads, ["entity", "game_date"])


def offense_to_come(games: DataFrame, events: DataFrame) -> DataFrame:
    """wOBA, the league's, and wRC+ by the park of the seasons before, of both teams of games to come."""
    names = ["ubb", "hbp", "b1", "b2", "b3", "hr", "ab", "sf"]
    bats = F.when(F.col("bat_home_id") == "1", F.col("home_team_id")).otherwise(F.col("away_team_id"))
    history = appearances(events, games, bats)
    targets = _to_come(games, _teams())
    own = entering_targets(targets, history, ["entity", "season"], "game_date", names)
    # The league's sums are those of its days, so one season isn't sorted game by game in one task.
    league = entering_targets(targets.select("season", "game_date").distinct(), history.groupBy("season", "game_date").agg(*[F.sum(n).alias(n) for n in names]), ["season"], "game_date", names)
    league = league.select("season", "game_date", *[F.col(n).alias(f"l_{n}") for n in names])
    decided = features.team_games(games.filter("home_score is not null")).withColumn("total", F.col("rf") + F.col("ra"))
    rates = decided.groupBy("entity", "season").agg(*[F.avg(F.when(F.col("side") == s, F.col("total"))).alias(s) for s in ("home", "away")]).withColumn("ratio", F.col("home") / F.nullif(F.col("away"), F.lit(0.0)) * 100)
    park = targets.select("entity", "season").distinct().join(rates.select("entity", F.col("season").alias("_past"), "ratio"), "entity").filter("_past between season - 3 and season - 1").groupBy("entity", "season").agg(F.avg("ratio").alias("park_factor"))
    woba = lambda p: sum((F.col(f"{p}{n}") * v for n, v in WOBA.items() if n != "ibb"), F.lit(0.0)) / F.nullif((F.col(f"{p}ab") + F.col(f"{p}ubb") + F.col(f"{p}sf") + F.col(f"{p}hbp")).cast("double"), F.lit(0.0))
    rows = own.join(league, ["season", "game_date"], "left").join(park, ["entity", "season"], "left").withColumns({"woba": woba(""), "league_woba": woba("l_")})
    return rows.withColumn("wrc_plus", features.wrc_plus(F.col("woba"), F.col("league_woba"), F.coalesce("park_factor", F.lit(100.0))))


def platoon(events: DataFrame, games: DataFrame, least: int = 15) -> DataFrame:
    """Strikeout rate and wOBA against left- and right-handed batters of each starter entering each game."""
    g = games.filter("game_type = 'regular'").select(F.col("id").alias("game"), F.col("retro_game_id").alias("_r"), "season", "game_date", F.coalesce(F.col("game_number").cast("long"), F.lit(0)).alias("number"))
    rows = features.complete(events).join(g, F.col("game_id") == F.col("_r")).filter("resp_pit_start_fl = 'T' and bat_event_fl = 'T'")
    flags = features.plate_flags() | {"hr": (F.col("event_cd") == features.HOMER) | (F.coalesce("h_cd", F.lit("")) == "4")}
    names = ["pa", "so", *PLATOON_WOBA]
    sums = [F.sum(((F.col("bat_hand_cd") == hand) & flags[n]).cast("int")).alias(f"{n}_{hand}") for hand in "LR" for n in names]
    counts = rows.groupBy("game", "season", "game_date", "number", F.col("resp_pit_id").alias("entity")).agg(*sums)
    prior = windows.prior(counts, ["entity", "season"], ["game_date", "number", "game"], {f"p_{n}_{h}": f"{n}_{h}" for h in "LR" for n in names})
    out = []
    for hand, name in (("L", "lhb"), ("R", "rhb")):
        p = lambda n, hand=hand: F.col(f"p_{n}_{hand}")
        out += [clean.rate(p("so"), p("pa"), least).alias(f"vs_{name}_k_pct"), clean.rate(sum(p(n) * F.lit(Decimal(str(w))) for n, w in PLATOON_WOBA.items()).cast("double"), p("pa"), least).alias(f"vs_{name}_woba")]
    return prior.select("game", "entity", *out)


def weighted_season(rows: DataFrame, keys: Sequence[str], value: str, weight: str, name: str) -> DataFrame:
    """Mean of a value by its weight for each key; weights of 0 and less don't count."""
    w, v = F.col(weight).cast("double"), F.col(value).cast("double")
    return rows.filter(w > 0).groupBy(*keys).agg((F.sum(v * w) / F.sum(w)).alias(name))


def framing(catchers: DataFrame, clubs: DataFrame, teams: DataFrame) -> DataFrame:
    """Framing runs of each team and season: catchers (player, season, runs) by the club they played for (clubs: player, season, code, is_pitcher), whose code had a team in that era (teams: code, team_id, first_year, last_year)."""
    held = catchers.join(clubs.filter(~F.col("is_pitcher")).select("player", "season", "code"), ["player", "season"])
    found = held.join(teams, "code").filter(F.col("season").between(F.col("first_year"), F.col("last_year")))
    return found.groupBy("team_id", "season").agg(F.sum("runs").alias("framing"))


