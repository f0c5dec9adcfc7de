import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from pennant.operators import learn, sequence


def test_elo_by_hand(spark):
    rows = [(1, "A", 2023, dt.date(2023, 4, 1), 0, 1, 2, 5, 3), (2, "A", 2023, dt.date(2023, 4, 2), 0, 2, 1, None, None), (3, "A", 2024, dt.date(2024, 4, 1), 0, 1, 2, 1, 0), (4, "B", 2023, dt.date(2023, 4, 1), 0, 8, 9, 2, 2)]
    df = spark.createDataFrame(rows, "game long, league string, season int, day date, number long, home long, away long, home_score long, away_score long")
    got = {r.game: r for r in sequence.elo(df, lambda x, _: x.cache()).collect()}
    assert (got[1].home_elo, got[1].away_elo) == (1500, 1500)
    assert got[2].home_elo == pytest.approx(1499.1172, abs=1e-4) and got[2].away_elo == pytest.approx(1500.8828, abs=1e-4)
    assert got[3].home_elo == pytest.approx(1500 + 0.75 * 0.8828, abs=1e-4)
    assert got[4].home_elo == 1500


def test_log5_identities(spark):
    rows = spark.createDataFrame([(0.3, 0.5), (0.0, 0.0), (1.0, 1.0), (0.6, 0.4)], "a double, b double").select(sequence.log5(F.col("a"), F.col("b")).alias("p"), sequence.log5(F.col("a"), F.col("b"), None).alias("q")).collect()
    assert [round(r.p, 6) for r in rows] == [0.3, 0.5, 0.5, round(0.36 / 0.52, 6)] and rows[1].q is None


def test_expectancy_of_a_coin(spark):
    """From H half of the time one more run and H again, else the end: 1 run expected."""
    cells = spark.createDataFrame([("H", "H", 1, 5), ("H", "END", 0, 5)], "pre string, post string, runs int, n long")
    assert sequence.run_expectancy(cells).first().expected == pytest.approx(1.0)


def test_simulation_rules_and_seed(spark):
    cells = spark.createDataFrame([("S", "S", 1, 3), ("S", "END", 0, 7)], "pre string, post string, runs int, n long")
    a, b = (sorted(map(tuple, sequence.simulate_games(spark, cells, 200, "S", seed=3, partitions=p).collect())) for p in (2, 5))
    assert a == b
    assert all(i >= 9 and (h != w or i == 30) for _, h, w, i in a)
    assert all(h - w <= 1 for _, h, w, i in a if i > 9 and h > w)
    assert np.mean([i for *_, i in a]) < 13


def test_conservation(spark):
    plays = spark.createDataFrame([(1, 0, 0, 2), (0, 1, 0, 0), (1, 0, 1, 0)], "before int, after int, outs int, runs int")
    assert sequence.conservation(plays).count() == 1


def test_folds_never_look_ahead():
    assert learn.folds([2003, 2001, 2002]) == [([2001], 2002), ([2001, 2002], 2003)]


def test_cutoff_is_checked(spark):
    df = spark.createDataFrame([(1, 2), (3, 3)], "known int, at int")
    learn.check_cutoff(df.limit(1), "known", "at")
    with pytest.raises(ValueError):
        learn.check_cutoff(df, "known", "at")


def test_signal_is_found_and_noise_is_not(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((400, 2))
    y = (x[:, 0] + 0.3 * rng.standard_normal(400) > 0).astype(int)
    df = spark.createDataFrame([(i, 2000 + i % 2, float(a), float(b), int(c)) for i, ((a, b), c) in enumerate(zip(x, y, strict=True))], "id long, season int, signal double, noise double, y int")
    fitted = learn.model(learn.CLASSIFIERS["logistic"](), ["signal", "noise"], "y").fit(learn.with_flags(df.withColumn("y", F.col("y").cast("double")), ["signal", "noise"]))
    rise = dict(learn.permutation_importance(fitted, df, ["signal", "noise"], "y"))
    assert rise["signal"] > 0.3 > abs(rise["noise"])
    found = learn.walk_forward(df, "season", ["signal", "noise"], "y", learn.CLASSIFIERS["logistic"], ["id"])
    assert found.count() == 200 and learn.classification_metrics(found, [], "y", "p").first().accuracy > 0.85


def test_stepwise_stops():
    gain = {"a": 0.3, "b": 0.1, "c": 0.0}
    assert learn.stepwise(lambda fs: 1 - sum(gain[f] for f in fs), list(gain), margin=0.05) == ["a", "b"]


def test_registry_has_one_champion(spark):
    registry = spark.createDataFrame([("m", "1", "champion"), ("m", "2", "candidate"), ("n", "3", "champion")], "name string, model_id string, status string")
    assert {r.model_id: r.status for r in learn.promote(registry, "m", "2").collect()} == {"1": "retired", "2": "champion", "3": "champion"}
    assert learn.promoted(0.677, [0.680, 0.69]) and not learn.promoted(0.679, [0.680])
    assert learn.model_id({"a": 1, "b": 2}) == learn.model_id({"b": 2, "a": 1})


def test_chains_are_never_cut(spark):
    """Up to 10,000 transitions all count; beyond, an error and no wrong figures."""
    cells = lambda n: spark.range(n).selectExpr("cast(id as string) as pre", "'END' as post", "1 as runs", "1L as n")
    for run in (sequence.run_expectancy, lambda c: sequence.simulate_games(spark, c, 1, "0")):
        with pytest.raises(ValueError, match="transitions"):
            run(cells(10_001))
    assert sequence.simulate_games(spark, cells(10_000), 1, "0").first().away_runs == 30


def test_stack_learns_which_base_to_trust(spark):
    rng = np.random.default_rng(2)
    y = (rng.random(500) < 0.5).astype(int)
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), 0.8 if v else 0.2, float(rng.random()) if i % 3 else None, int(v)) for i, v in enumerate(y)]
    df = spark.createDataFrame(rows, "id long, at timestamp, good double, idle double, y int")
    found = learn.stack(df, ["good", "idle"], "y", "at", ["id"]).collect()
    assert min(r.id for r in found) == 400 and len(found) == 100
    assert all((r.p > 0.5) == bool(r.y) for r in found)


def test_nested_stepwise(spark):
    """The signal is chosen, noise isn't, and the last season is judged from the seasons before."""
    df = spark.range(900).selectExpr("id % 3 as season", "(id * 7919) % 101 as signal", "(id * 104729) % 97 as noise", "cast((id * 7919) % 101 > 50 as int) as y")
    chosen, found = learn.nested_stepwise(df, "season", ["signal", "noise"], "y", learn.CLASSIFIERS["logistic"], margin=0.02)
    assert chosen == ["signal"] and found < 0.3
    assert learn.nested_stepwise(df, "season", ["noise"], "y", learn.CLASSIFIERS["logistic"], margin=0.02)[0] == []
    with pytest.raises(ValueError):
        learn.nested_stepwise(df.filter("season < 2"), "season", ["noise"], "y", learn.CLASSIFIERS["logistic"])


def test_one_champion_a_model(spark):
    runs = [("a", 1, 0.70, 0.69), ("a", 2, 0.68, 0.69), ("a", 3, 0.679, 0.69), ("a", 4, 0.60, 0.69), ("a", 5, None, 0.69), ("b", 1, 0.688, 0.69), ("c", 1, 0.6885, 0.69), ("d", 2, 0.5, 0.69), ("d", 1, 0.6, None)]
    df = spark.createDataFrame(runs, "name string, version int, loss double, base double")
    got = {(r.name, r.version): r.status for r in learn.promotions(df, ["name"], "version", "loss", "base").collect()}
    assert got == {("a", 1): "candidate", ("a", 2): "retired", ("a", 3): "candidate", ("a", 4): "champion", ("a", 5): "candidate", ("b", 1): "champion", ("c", 1): "candidate", ("d", 2): "champion", ("d", 1): "candidate"}


def test_a_season_is_walked_in_batches(spark):
    """Ratings don't depend on how many rows of a season reach the walk at once; leagues without a name and games without a day included."""
    games = [(k, None if k % 3 == 0 else f"L{k % 3}", 1990 + k // 40, None if k % 11 == 0 else k % 13, k % 2, k % 4, (k + 1 + k % 3) % 4, k % 5 if k % 7 else None, k % 3) for k in range(80)]
    df = spark.createDataFrame(games, "game long, league string, season int, day int, number long, home long, away long, home_score long, away_score long")
    want, held = {}, {}
    for season in (1990, 1991):
        fresh = set()
        for g in sorted((g for g in games if g[2] == season), key=lambda g: (g[3] is None, g[3] or 0, g[4], g[0])):
            for side in (g[5], g[6]):
                if (g[1], side) not in fresh:
                    fresh.add((g[1], side))
                    held[g[1], side] = held[g[1], side] + sequence.REVERT * (sequence.START - held[g[1], side]) if (g[1], side) in held else sequence.START
            home, away = held[g[1], g[5]], held[g[1], g[6]]
            want[g[0]] = (home, away)
            if g[7] is not None and g[7] != g[8]:
                held[g[1], g[5]], held[g[1], g[6]] = sequence.rate_game(home, away, g[7], g[8])
    name, before = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in ("10000", "3"):
            spark.conf.set(name, size)
            found = {r.game: (r.home_elo, r.away_elo) for r in sequence.elo(df, lambda x, _: x.localCheckpoint()).collect()}
            assert found == want
    finally:
        spark.conf.set(name, before)


def test_models_join_their_rows_once(spark, sf):
    """Rows that a model passes over many times are read, not joined."""
    from pennant.plans import model_queries
    from pennant.plans.registry import Tables

    assert "Join" not in model_queries.orders_of_customers(Tables(spark, sf))._jdf.queryExecution().optimizedPlan().toString()


def test_stepwise_reads_all_years(spark, sf, monkeypatch):
    """Every order with its customer takes part, whatever its year."""
    from pennant.plans import model_queries
    from pennant.plans.registry import Tables

    t, seen = Tables(spark, sf), []
    monkeypatch.setattr(learn, "nested_stepwise", lambda df, *a, **k: seen.extend(r[0] for r in df.select("o_orderkey").collect()) or (["half_price"], 0.5))
    model_queries.ml_stepwise(t).collect()
    own = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    assert sorted(seen) == sorted(r[0] for r in own.select("o_orderkey").collect()) and own.filter("year(o_orderdate) < 1998").count()


def test_nested_stepwise_leaves_out_rows_without_a_season(spark):
    df = spark.range(900).selectExpr("if(id < 30, null, id % 3) as season", "(id * 7919) % 101 as signal", "cast((id * 7919) % 101 > 50 as int) as y")
    chosen, found = learn.nested_stepwise(df, "season", ["signal"], "y", learn.CLASSIFIERS["logistic"], margin=0.02)
    assert chosen == ["signal"] and found < 0.3


def test_walk_forward_is_judged_beside_baselines(spark, sf):
    """Every season has the model and all baselines, whose shares also know the seasons that are only learnt from."""
    from pennant.plans import model_queries
    from pennant.plans.registry import Tables

    t = Tables(spark, sf)
    seasons = {}
    for r in t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(F.year("o_orderdate").alias("s"), (F.col("o_totalprice") > 200000).alias("y")).collect():
        seasons.setdefault(r.s, []).append(float(r.y))
    ordered, want = sorted(seasons), {}
    for k in range(4, len(ordered)):
        own, past = seasons[ordered[k]], [y for s in ordered[:k] for y in seasons[s]]
        for name, p in (("home_rate", np.mean(past)), ("zero", 0.0), ("season_average", np.mean(seasons[ordered[k - 1]]))):
            q = min(1 - learn.EPS, max(learn.EPS, p))
            want[ordered[k], name] = (len(own), np.mean([-(y * np.log(q) + (1 - y) * np.log(1 - q)) for y in own]), np.mean([(p - y) ** 2 for y in own]), np.mean([(p >= 0.5) == y for y in own]))
    got = {(r.season, r.model): r for r in model_queries.ml_walk_forward(t).collect()}
    assert set(got) == set(want) | {(s, "logistic") for s in ordered[4:]} and len(want) == 3 * len(ordered[4:]) > 0
    for key, (n, *figures) in want.items():
        assert got[key].n == n and np.allclose([got[key].log_loss, got[key].brier, got[key].accuracy], figures)
    assert all(got[s, "logistic"].n == len(seasons[s]) and got[s, "logistic"].log_loss > 0 for s in ordered[4:])
