"""Sums, solvers and trees against numpy, and exact quantiles against a sort."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pennant.operators import learn, linear, quantile, trees


def ring(spark, n=1200, parts=4):
    """A label that no line can tell: inside or outside of a ring."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, 2))
    y = ((x**2).sum(axis=1) < 1.4).astype(int)
    rows = [(float(a) if i % 50 else None, float(b), int(c)) for i, ((a, b), c) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "a double, b double, y int").repartition(parts)


@pytest.mark.parametrize("values", [[3.0], [1.0, 1.0, 1.0], [-1e308, 1e308, 0.0, 1e-300, -1e-300], [math.inf, -math.inf, 2.0, 2.0], np.random.default_rng(1).lognormal(0, 9, 3000).tolist(), [float(i % 7) for i in range(2000)], [None, float("nan"), 4.0, 5.0]])
def test_quantiles(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    known = sorted(v for v in values if v is not None and not math.isnan(v))
    shares = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    between, nearest = quantile.quantiles(df, "v", shares, shares)
    assert nearest == [known[max(0, math.ceil(round(q * len(known), 9)) - 1)] for q in shares]
    if all(map(math.isfinite, known)) and max(map(abs, known)) < 1e300:
        assert np.allclose(between, np.quantile(known, shares), rtol=1e-12)


def test_no_values(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert quantile.quantiles(df, "v", [0.5], [0.5]) == ([None], [None])


def test_design_and_gram(spark):
    df = ring(spark)
    pdf = df.toPandas()
    for kind in ("plain", "spline", "fourier"):
        made = linear.design(df, ["a", "b"], kind, waves=8)
        x = np.concatenate([made(pdf), pdf[["y"]].to_numpy(float)], axis=1)
        for parts in (1, 8):
            assert np.allclose(linear.gram(df.repartition(parts), made, "y"), x.T @ x, rtol=1e-9, atol=1e-9)
    basis = linear.b_splines(np.linspace(-2, 2, 101), np.array([-1.0, 0.0, 0.5, 1.0]))
    assert basis.shape == (101, 5) and (basis >= -1e-12).all() and (basis.sum(axis=1) <= 1 + 1e-12).all() and np.allclose(basis[-1], [0, 0, 0, 0, 1])


def test_bayesian_ridge(spark, sf):
    """Against the evidence iterations written out with inverses on all rows in memory."""
    df = spark.read.parquet(f"{sf}/lineitem.parquet").withColumn("y", F.col("l_extendedprice") / 1000 + F.col("l_quantity") - 40 * F.col("l_tax"))
    made = linear.design(df, ["l_quantity", "l_discount", "l_tax"])
    fitted = linear.bayesian_ridge(df, made, "y")
    pdf = df.toPandas()
    x, y = made(pdf)[:, 1:], pdf["y"].to_numpy()
    xc, yc = x - x.mean(axis=0), y - y.mean()
    alpha, lam = 1 / yc.var(), 1.0
    for _ in range(500):
        s = np.linalg.inv(alpha * xc.T @ xc + lam * np.eye(3))
        m = alpha * s @ xc.T @ yc
        known = 3 - lam * np.trace(s)
        lam, alpha = known / (m @ m), (len(y) - known) / ((yc - xc @ m) ** 2).sum()
    assert np.allclose(fitted.weights[1:], m, rtol=1e-5) and math.isclose(fitted.weights[0], y.mean() - x.mean(axis=0) @ m, rel_tol=1e-6)
    assert math.isclose(fitted.noise, 1 / alpha, rel_tol=1e-5)
    row = fitted.predict(df.limit(1)).first()
    assert row.p_sd >= math.sqrt(fitted.noise) and math.isclose(row.p, float((made(df.limit(1).toPandas()) @ fitted.weights)[0]), rel_tol=1e-6)


@pytest.mark.parametrize("loss", ["logistic", "hinge", "insensitive"])
def test_newton_ends_where_the_slope_is_zero(spark, loss):
    df = ring(spark)
    made = linear.design(df, ["a", "b"], "fourier", waves=6)
    fitted = linear.newton(df, made, "y", loss, penalty=0.5, epsilon=0.1)
    pdf = df.toPandas()
    x, y = made(pdf), pdf["y"].to_numpy(float)

    def total(w):
        f = x @ w
        value = {"logistic": np.logaddexp(0, f) - y * f, "hinge": np.maximum(1 - (2 * y - 1) * f, 0) ** 2 / 2, "insensitive": np.maximum(np.abs(f - y) - 0.1, 0) ** 2 / 2}[loss]
        return value.sum() + 0.25 * (w[1:] ** 2).sum()

    slope = [(total(fitted.weights + d) - total(fitted.weights - d)) / 2e-5 for d in np.eye(len(fitted.weights)) * 1e-5]
    assert np.abs(slope).max() < 2e-2 < total(np.zeros(x.shape[1]))


def test_families_learn_a_ring(spark):
    df = ring(spark)
    base = learn.classification_metrics(df.withColumn("p", F.lit(df.agg(F.avg("y")).first()[0])), [], "y", "p").first().log_loss
    line = linear.newton(df, linear.design(df, ["a", "b"]), "y")
    found = {"line": line, "gam": linear.newton(df, linear.design(df, ["a", "b"], "spline"), "y", penalty=0.1), "svm": linear.machine(df, ["a", "b"], "y"), "trees": trees.extra_trees(df, ["a", "b"], "y", trees=24, depth=6)}
    loss = {n: learn.classification_metrics(m.predict(df), [], "y", "p").first().log_loss for n, m in found.items()}
    assert loss["line"] > base - 0.02 and max(loss["gam"], loss["svm"], loss["trees"]) < base - 0.2


def test_trees_do_not_depend_on_partitions(spark):
    one, other = (trees.extra_trees(ring(spark, parts=p), ["a", "b"], "y", trees=6, depth=4) for p in (1, 8))
    assert (one.feature == other.feature).all() and (one.threshold == other.threshold).all() and np.allclose(one.value, other.value)
    share = trees.importance(one)
    assert math.isclose(sum(share.values()), 1) and min(share.values()) > 0.2


def test_trees_edges(spark):
    flat = spark.createDataFrame([(1.0, 1), (1.0, 0), (1.0, 1)], "a double, y int")
    forest = trees.extra_trees(flat, ["a"], "y", trees=2)
    assert (forest.feature == -1).all() and {round(r.p, 6) for r in forest.predict(flat).collect()} == {0.666667}
    with pytest.raises(ValueError):
        trees.extra_trees(flat.limit(0), ["a"], "y")


def test_stability(spark):
    df = ring(spark).withColumn("season", F.pmod(F.xxhash64("b"), F.lit(3))).withColumn("noise", F.rand(5))
    found = {f: (share, won, of) for f, share, won, of in trees.stability(df, "season", ["a", "b"], "y", "noise", trees=8, depth=4)}
    assert found["a"][1:] == found["b"][1:] == (2, 2) and found["noise"][1] == 0


def test_calibration_line_and_deciles(spark):
    rng = np.random.default_rng(9)
    z = rng.normal(size=4000)
    y = rng.random(4000) < 1 / (1 + np.exp(-(0.3 + 0.5 * z)))
    df = spark.createDataFrame([(float(1 / (1 + math.exp(-a))), int(b)) for a, b in zip(z, y, strict=True)], "p double, y int")
    slope, intercept = linear.calibration_line(df, "y", "p")
    assert abs(slope - 0.5) < 0.1 and abs(intercept - 0.3) < 0.1
    rows = linear.decile_residuals(df, "y", "p").collect()
    assert sorted(r.part for r in rows) == list(range(10)) and all(r.n == 400 for r in rows) and all(math.isclose(r.residual, r.mean_y - r.mean_p, abs_tol=1e-9) for r in rows)


def test_bootstrap_against_all_draws(spark):
    rows = [(i, "ab"[i % 2] if i % 11 else None, float(i % 13), i % 3) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, k string, v double, j int").repartition(5)
    import hashlib

    def draws(i, r):
        a, b = (1_103_515_245 * r + 12_345) % learn.PRIME, (69_069 * r + 362_437) % learn.PRIME
        u = ((int(hashlib.md5(str(i).encode()).hexdigest()[:7], 16) + 1) * a + b) % learn.PRIME
        return sum(math.floor(c * learn.PRIME) <= u for c in learn.POISSON)

    want = {}
    for k in ("a", "b", None):
        own = [(i, v) for i, g, v, _ in rows if g == k]
        m = sorted(sum(draws(i, r) * v for i, v in own) / sum(draws(i, r) for i, _ in own) for r in range(40))
        want[k] = (m[int(0.025 * 39)], sum(m) / 40, m[int(0.975 * 39)])
    got = {r.k: (r.lo, r.mean, r.hi) for r in learn.bootstrap(df, ["k"], "id", F.col("v"), 40).collect()}
    assert got.keys() == want.keys() and all(np.allclose(got[k], want[k]) for k in want)
    assert learn.bootstrap(df, [], "id", F.col("v"), 40).count() == 1 and learn.bootstrap(df.limit(0), ["k"], "id", F.col("v"), 40).count() == 0


def test_values_are_dealt_over_all_rows(spark):
    df = spark.range(500).selectExpr("id", "cast(id as double) as a", "cast(id % 3 as double) as b")
    moved = learn.dealt(df, "a", ["a", "b"]).collect()
    assert sorted(r.a for r in moved) == [float(i) for i in range(500)] and sum(r.a == r.id for r in moved) < 10
    ranks = sorted(r.n for r in learn.ranked(df, F.xxhash64("id"), "n").collect())
    assert ranks == list(range(500))


def test_missing_features_count_as_the_mean():
    made = linear.Design(["a"], np.array([5.0]), np.array([2.0]))
    assert made(pd.DataFrame({"a": [None, 7.0]})).tolist() == [[1.0, 0.0], [1.0, 1.0]]


def test_rows_go_down_grown_levels_only():
    """Leaves are the same however many more steps there could be; a level of growing costs its own depth."""
    forest = trees.Forest(["a"], np.array([[-1, 0, -1, 0, -1, -1, -1, -1]]), np.array([[0, 0.5, 0, 0.8, 0, 0, 0, 0]]), np.zeros((1, 8)))
    x = np.array([[0.1], [0.6], [0.9], [np.nan]])
    assert forest.leaves(x).tolist() == forest.leaves(x, 2).tolist() == forest.leaves(x, 5).tolist() == [[2], [6], [7], [2]]
    assert forest.leaves(x, 0).tolist() == [[1]] * 4 and forest.leaves(x, 1).tolist() == [[2], [3], [3], [2]]
