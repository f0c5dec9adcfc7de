"""Sequential models: Elo ratings, log5, Markov chains of base and out states, seeded simulation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the rating system.
HOME_EDGE, K, START, REVERT = 24.0, 4.0, 1500.0, 0.25
OUTS = 3
#: Rows of a chain that are solved or drawn from in one process.
MOST_CELLS = 10_000


def expected(home: float, away: float) -> float:
    """Probability that the home side wins."""
    return 1 / (1 + 10 ** (-(home + HOME_EDGE - away) / 400))


def rate_game(home: float, away: float, home_score: int, away_score: int) -> tuple[float, float]:
    """Ratings after a decided game."""
    p, margin = expected(home, away), home_score - away_score
    won = 1.0 if margin > 0 else 0.0
    lead = (home + HOME_EDGE - away) * (1 if margin > 0 else -1)
    move = K * (abs(margin) + 3) ** 0.8 / (7.5 + 0.006 * max(lead, 0)) * (won - p)
    return home + move, away - move


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leagues one after the other, each with its ratings so far and then its season in order; what is held is one league's ratings."""
    league, held, fresh = None, {}, set()
    names = ("league", "game", "home_elo", "away_elo", "team", "rating")

    def now(team):
        # A team moves towards the mean when it first plays in a season.
        if team not in fresh:
            held[team] = held[team] + REVERT * (START - held[team]) if team in held else START
            fresh.add(team)
        return held[team]

    def left(league):
        return [(league[0], None, None, None, team, rating) for team, rating in sorted(held.items())] if league else []

    def as_batch(rows):
        kinds = (pa.string(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.float64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 6, kinds, strict=True)], names=names)

    for batch in batches:
        out = []
        for name, team, rating, game, home_team, away_team, home_score, away_score in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if league != (name,):
                out += left(league)
                league, held, fresh = (name,), {}, set()
            if game is None:
                held[team] = rating
                continue
            home, away = now(home_team), now(away_team)
            out.append((name, game, home, away, None, None))
            if home_score is not None and away_score is not None and home_score != away_score:
                held[home_team], held[away_team] = rate_game(home, away, home_score, away_score)
        yield as_batch(out)
    yield as_batch(left(league))


def elo(games: DataFrame, materialize) -> DataFrame:
    """games: game, league, season, day, number, home, away, home_score, away_score. Ratings before each game.

    Ratings depend on all games before, so seasons follow each other; within one
    a task walks a season of one league in batches of its sorted rows, so time
    grows with a league's season but memory doesn't. `materialize` writes a frame
    between seasons.
    """
    spark = games.sparkSession
    ratings = spark.createDataFrame([], "league string, team long, rating double")
    done = None
    for row in games.select("season").distinct().orderBy("season").collect():
        season = games.filter(F.col("season") == row["season"]).select("game", "league", "day", "number", "home", "away", "home_score", "away_score")
        rows = ratings.unionByName(season, allowMissingColumns=True).repartition("league")
        order = [F.col("game").isNotNull(), *[F.col(c).asc_nulls_last() for c in ("day", "number", "game")]]
        rows = rows.sortWithinPartitions("league", *order).select("league", "team", "rating", "game", "home", "away", "home_score", "away_score")
        walked = rows.mapInArrow(_walk, "league string, game long, home_elo double, away_elo double, team long, rating double")
        walked = materialize(walked, "elo")
        ratings = walked.filter("team is not null").select("league", "team", "rating")
        part = walked.filter("game is not null").select("game", "home_elo", "away_elo")
        done = part if done is None else done.unionByName(part)
    return done


def log5(a: Column, b: Column, even: float | None = 0.5) -> Column:
    """Chance that a side of strength a beats one of strength b; `even` where that is 0/0 (None: null)."""
    top, other = a * (1 - b), b * (1 - a)
    return F.when(top + other == 0, F.lit(even).cast("double")).otherwise(top / F.nullif(top + other, F.lit(0.0)))


def _all_cells(cells: DataFrame) -> list:
    """All rows of a chain; an error where they are more than one process should hold."""
    rows = cells.limit(MOST_CELLS + 1).collect()
    if len(rows) > MOST_CELLS:
        raise ValueError(f"more than {MOST_CELLS} transitions: states are too fine to be solved on the driver")
    return rows


def run_expectancy(cells: DataFrame, end: str = "END") -> DataFrame:
    """cells: pre, post, runs, n. state, expected: runs from a state to the end of the half.

    Solves (I - Q) x = r. The table has a row per pair of states and runs, which
    the states bound (24 and the end), so it is solved on the driver.
    """
    rows = _all_cells(cells.groupBy("pre", "post").agg(F.sum("n").alias("n"), F.sum(F.col("runs") * F.col("n")).alias("runs")))
    states = sorted({r["pre"] for r in rows} | {r["post"] for r in rows} - {end})
    at = {s: k for k, s in enumerate(states)}
    q, r, total = np.zeros((len(states), len(states))), np.zeros(len(states)), np.zeros(len(states))
    for x in rows:
        total[at[x["pre"]]] += x["n"]
        r[at[x["pre"]]] += x["runs"]
        if x["post"] != end:
            q[at[x["pre"]], at[x["post"]]] += x["n"]
    seen = np.maximum(total, 1)
    solved = np.linalg.solve(np.eye(len(states)) - q / seen[:, None], r / seen)
    return cells.sparkSession.createDataFrame([(s, float(v)) for s, v in zip(states, solved, strict=True)], "state string, expected double")


def conservation(plays: DataFrame) -> DataFrame:
    """plays: before (runners), after, outs, runs. Plays that don't add up: runners and the batter are on base, out or in."""
    return plays.filter(F.col("before") + 1 != F.col("after") + F.col("outs") + F.col("runs"))


def simulate_games(spark: SparkSession, cells: DataFrame, n: int, start: str, end: str = "END", seed: int = 1, innings: int = 9, most: int = 30, partitions: int = 8) -> DataFrame:
    """n games of two sides with the same chances: game, home_runs, away_runs, innings.

    The home side doesn't bat in the last inning when ahead, and stops when it
    goes ahead there; ties go on, `most` innings at most. Each game draws from
    its own number, so a task run again gives the same games.
    """
    table: dict[str, tuple[list, np.ndarray]] = {}
    for r in _all_cells(cells):
        table.setdefault(r["pre"], ([], []))
        table[r["pre"]][0].append((r["post"], r["runs"]))
        table[r["pre"]][1].append(r["n"])
    table = {s: (to, np.cumsum(w) / sum(w)) for s, (to, w) in table.items()}

    def half(rng, need=None):
        runs, state = 0, start
        while state != end and state in table:
            to, upto = table[state]
            state, scored = to[min(int(np.searchsorted(upto, rng.random(), side="right")), len(to) - 1)]
            runs += scored
            if need is not None and runs > need:
                break
        return runs

    def play(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for game in batch.column(0).to_pylist():
                rng, home, away, inning = np.random.default_rng([seed, game]), 0, 0, 0
                while inning < innings or (home == away and inning < most):
                    inning += 1
                    away += half(rng)
                    if inning < innings:
                        home += half(rng)
                    elif home <= away:
                        home += half(rng, away - home)
                out.append((game, home, away, inning))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [[]] * 4)], names=["game", "home_runs", "away_runs", "innings"])

    return spark.range(0, n, 1, partitions).mapInArrow(play, "game long, home_runs long, away_runs long, innings long")


def runners_kept(plays: DataFrame, by: str) -> DataFrame:
    """by, n, broken, runs, outs: plays whose runners before, with the batter where he ends his turn, aren't those on base, out and in after it. Needs start_bases_cd, end_bases_cd (bits), bat_event codes, outs and runs of each play."""
    batter = F.col("event_cd").isin(2, 3, 14, 15, 16, 17, 18, 19, 20, 21, 22, 23).cast("int")
    before, after = F.bit_count("start_bases_cd") + batter, F.bit_count("end_bases_cd") + F.col("event_outs_ct") + F.col("event_runs_ct")
    return plays.groupBy(by).agg(F.count("*").alias("n"), F.count_if(before != after).alias("broken"), F.sum("event_runs_ct").alias("runs"), F.sum("event_outs_ct").alias("outs"))
