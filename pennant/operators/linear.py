"""Models whose training is a sum over rows: linear, Bayesian ridge, logistic, machines with hinge losses, on plain, spline or random Fourier features.

A design turns a row's features into columns inside the task. Each pass sums what
a solver needs (Gram matrix, gradient, loss) per task in numpy, adds the tasks'
sums in one aggregate, and solves on the driver; what travels is of the size of
the design's columns squared, never of the rows. Missing features count as the
mean the design was made with. Sums of a pass are the same for any partitioning
up to rounding.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pennant.operators import quantile


@dataclass
class Design:
    """Features standardised by mean and scale, then expanded. kind: plain, spline or fourier."""

    features: list[str]
    mean: np.ndarray
    scale: np.ndarray
    kind: str = "plain"
    knots: list[np.ndarray] = field(default_factory=list)
    waves: np.ndarray | None = None
    phase: np.ndarray | None = None

    def __call__(self, frame: pd.DataFrame) -> np.ndarray:
        x = frame[self.features].to_numpy(dtype=float, na_value=np.nan)
        x = (np.where(np.isnan(x), self.mean, x) - self.mean) / self.scale
        if self.kind == "spline":
            x = np.concatenate([b_splines(x[:, k], t) for k, t in enumerate(self.knots)], axis=1) if self.knots else x
        elif self.kind == "fourier":
            x = np.sqrt(2 / len(self.phase)) * np.cos(x @ self.waves + self.phase)
        return np.concatenate([np.ones((len(x), 1)), x], axis=1)


def b_splines(x: np.ndarray, knots: np.ndarray, degree: int = 3) -> np.ndarray:
    """B-spline basis of the inner knots' range without its first column (the rest sums to 1 with it); values outside count as the range's ends."""
    t = np.concatenate([np.repeat(knots[0], degree), knots, np.repeat(knots[-1], degree)])
    x = np.clip(x, knots[0], knots[-1])
    last = np.searchsorted(t, knots[-1], side="left") - 1
    basis = np.array([(x >= t[i]) & ((x < t[i + 1]) | ((i == last) & (x == t[i + 1]))) for i in range(len(t) - 1)], float).T
    for d in range(1, degree + 1):
        left, right = t[d:-1] - t[: -d - 1], t[d + 1 :] - t[1:-d]
        a = np.divide(x[:, None] - t[: -d - 1], left, out=np.zeros((len(x), len(left))), where=left > 0)
        b = np.divide(t[d + 1 :] - x[:, None], right, out=np.zeros((len(x), len(right))), where=right > 0)
        basis = a * basis[:, :-1] + b * basis[:, 1:]
    return basis[:, 1:]


def design(df: DataFrame, features: Sequence[str], kind: str = "plain", knots: int = 5, waves: int = 64, gamma: float | None = None, seed: int = 1) -> Design:
    """A design from the rows' means, deviations and, for splines, exact quantiles as knots. gamma: of the kernel exp(-gamma |x-y|^2), 1/features by default."""
    names = list(features)
    facts = df.agg(*[f(F.col(c).cast("double")) for c in names for f in (F.avg, F.stddev_pop)]).first()
    mean = np.array([facts[2 * k] or 0.0 for k in range(len(names))])
    scale = np.array([facts[2 * k + 1] or 1.0 for k in range(len(names))])
    made = Design(names, mean, scale, kind)
    if kind == "spline":
        shares = [k / (knots - 1) for k in range(knots)]
        for k, c in enumerate(names):
            cuts = np.unique([(v - mean[k]) / scale[k] for v in quantile.quantiles(df, c, shares)[0] if v is not None])
            made.knots.append(cuts if len(cuts) > 1 else np.array([-1.0, 1.0]))
    elif kind == "fourier":
        rng = np.random.default_rng(seed)
        made.waves = rng.normal(scale=np.sqrt(2 * (gamma or 1 / len(names))), size=(len(names), waves))
        made.phase = rng.uniform(0, 2 * np.pi, waves)
    return made


def summed(df: DataFrame, columns: Sequence[str], sums: Callable[[pd.DataFrame], np.ndarray]) -> np.ndarray:
    """Sum over all rows of an array that sums(frame) gives for a batch: one row per element leaves a task."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for frame in frames:
            if len(frame):
                part = sums(frame)
                total = part if total is None else total + part
        if total is not None:
            yield pd.DataFrame({"i": np.arange(total.size), "v": total.ravel()})

    rows = df.select(*[F.col(c).cast("double").alias(c) for c in dict.fromkeys(columns)]).mapInPandas(work, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(max((r["i"] for r in rows), default=-1) + 1)
    for r in rows:
        out[r["i"]] = r["v"]
    return out


def gram(df: DataFrame, make: Design, label: str) -> np.ndarray:
    """Gram matrix of the design's columns and the label (last), over rows with a label."""

    def sums(frame: pd.DataFrame) -> np.ndarray:
        x = np.concatenate([make(frame), frame[[label]].to_numpy(dtype=float)], axis=1)
        return x.T @ x

    flat = summed(df.filter(F.col(label).isNotNull()), [*make.features, label], sums)
    n = int(np.sqrt(flat.size))
    return flat.reshape(n, n)


@dataclass
class Linear:
    """A fitted model: prediction is link(design @ weights)."""

    design: Design
    weights: np.ndarray
    link: str = "identity"
    platt: tuple[float, float] | None = None
    covariance: np.ndarray | None = None
    noise: float = 0.0

    def score(self, frame: pd.DataFrame) -> np.ndarray:
        f = self.design(frame) @ self.weights
        if self.platt is not None:
            f = self.platt[0] + self.platt[1] * f
        return 1 / (1 + np.exp(-np.clip(f, -700, 700))) if self.link == "logit" else f

    def predict(self, df: DataFrame, name: str = "p") -> DataFrame:
        """df with the prediction; deviation of it beside where the model knows one (Bayesian ridge)."""
        schema = f"{name} double" + (f", {name}_sd double" if self.covariance is not None else "")

        @F.pandas_udf(f"struct<{schema.replace(' double', ':double')}>")
        def run(*columns: pd.Series) -> pd.DataFrame:
            frame = pd.concat(columns, axis=1, keys=self.design.features)
            out = {name: self.score(frame)}
            if self.covariance is not None:
                x = self.design(frame)
                out[f"{name}_sd"] = np.sqrt(self.noise + np.einsum("ij,jk,ik->i", x, self.covariance, x))
            return pd.DataFrame(out)

        fields = [name, *([f"{name}_sd"] if self.covariance is not None else [])]
        return df.withColumn("_m", run(*[F.col(c).cast("double") for c in self.design.features])).select(*df.columns, *[f"_m.{c}" for c in fields])


def ridge(df: DataFrame, make: Design, label: str, penalty: float = 1.0) -> Linear:
    """Least squares with a penalty on all weights but the first."""
    g = gram(df, make, label)
    keep = np.eye(len(g) - 1) * penalty
    keep[0, 0] = 0
    return Linear(make, np.linalg.solve(g[:-1, :-1] + keep, g[:-1, -1]))


def bayesian_ridge(df: DataFrame, make: Design, label: str, rounds: int = 300, tol: float = 1e-6) -> Linear:
    """Ridge whose noise and weight precisions maximise the evidence; needs one pass.

    The label and the columns are centred, so the first weight has no prior.
    """
    g = gram(df, make, label)
    n, mean = g[0, 0], g[0, 1:] / g[0, 0]
    centred = g[1:, 1:] - n * np.outer(mean, mean)
    a, b, yy = centred[:-1, :-1], centred[:-1, -1], centred[-1, -1]
    values, vectors = np.linalg.eigh(a)
    values, rotated = np.maximum(values, 0), vectors.T @ b
    alpha, lam = 1 / max(yy / n, 1e-12), 1.0
    for _ in range(rounds):
        own = alpha * rotated / (alpha * values + lam)
        known = float((alpha * values / (alpha * values + lam)).sum())
        left = max(yy - 2 * own @ rotated + (own * own) @ values, 1e-12)
        new_lam, new_alpha = known / max(own @ own, 1e-12), max(n - known, 1e-12) / left
        done = abs(np.log(new_lam / lam)) + abs(np.log(new_alpha / alpha)) < tol
        alpha, lam = new_alpha, new_lam
        if done:
            break
    w = vectors @ (alpha * rotated / (alpha * values + lam))
    cov = vectors @ np.diag(1 / (alpha * values + lam)) @ vectors.T
    # Covariance of (intercept, weights): the intercept is the label's mean less that of the columns' part.
    shift = np.concatenate([-mean[None, :-1], np.eye(len(w))], axis=0)
    full = shift @ cov @ shift.T
    full[0, 0] += 1 / (alpha * n)
    return Linear(make, np.concatenate([[mean[-1] - mean[:-1] @ w], w]), covariance=full, noise=1 / alpha)


def newton(df: DataFrame, make: Design, label: str, loss: str = "logistic", penalty: float = 1e-6, epsilon: float = 0.1, rounds: int = 30, tol: float = 1e-8) -> Linear:
    """Weights that minimise the sum of a loss and penalty/2 |w|^2 (all but the first), one pass over the rows a step.

    loss: logistic, hinge (squared, label 0/1) or insensitive (squared beyond epsilon).
    Steps are halved while the loss rises, which costs a pass each.
    """
    rows = df.filter(F.col(label).isNotNull())
    size = len(make(pd.DataFrame({c: [np.nan] for c in make.features})).T)
    free = np.full(size, penalty)
    free[0] = 1e-12

    def facts(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        def sums(frame: pd.DataFrame) -> np.ndarray:
            x, y = make(frame), frame[label].to_numpy(dtype=float)
            f = x @ w
            if loss == "logistic":
                p = 1 / (1 + np.exp(-np.clip(f, -700, 700)))
                value, slope, curve = np.logaddexp(0, f) - y * f, p - y, np.maximum(p * (1 - p), 1e-12)
            elif loss == "hinge":
                s = 2 * y - 1
                gap = np.maximum(1 - s * f, 0)
                value, slope, curve = gap**2 / 2, -s * gap, (gap > 0).astype(float)
            else:
                e = f - y
                gap = np.sign(e) * np.maximum(np.abs(e) - epsilon, 0)
                value, slope, curve = gap**2 / 2, gap, (gap != 0).astype(float)
            return np.concatenate([[value.sum()], x.T @ slope, ((x * curve[:, None]).T @ x).ravel()])

        flat = summed(rows, [*make.features, label], sums)
        if not flat.size:
            raise ValueError("there are no rows with a label")
        return flat[0] + 0.5 * float(free @ (w * w)), flat[1 : size + 1] + free * w, flat[size + 1 :].reshape(size, size) + np.diag(free)

    w = np.zeros(size)
    value, slope, curve = facts(w)
    for _ in range(rounds):
        step = np.linalg.lstsq(curve, slope, rcond=None)[0]
        if float(slope @ step) <= tol * (1 + abs(value)):
            break
        for k in range(12):
            new = facts(w - step / 2**k)
            if new[0] < value:
                break
        else:
            break
        w, (value, slope, curve) = w - step / 2**k, new
    return Linear(make, w, "logit" if loss == "logistic" else "identity")


def machine(df: DataFrame, features: Sequence[str], label: str, penalty: float = 1.0, waves: int = 64, seed: int = 1) -> Linear:
    """A classifier with an RBF kernel by random Fourier features and a squared hinge loss; its scores are mapped to probabilities by a logistic fit."""
    fitted = newton(df, design(df, features, "fourier", waves=waves, seed=seed), label, "hinge", penalty)
    slope, intercept = calibration_line(fitted.predict(df, "_f"), label, "_f", logits=True)
    fitted.link, fitted.platt = "logit", (intercept, slope)
    return fitted


def calibration_line(df: DataFrame, label: str, p: str, logits: bool = False) -> tuple[float, float]:
    """Slope and intercept of a logistic fit of the label on the predictions' log odds (1 and 0 where they are calibrated)."""
    q = F.least(F.lit(1 - 1e-6), F.greatest(F.lit(1e-6), F.col(p).cast("double")))
    rows = df.select((F.col(p).cast("double") if logits else F.ln(q / (1 - q))).alias("z"), F.col(label).cast("double").alias("y"))
    line = newton(rows, Design(["z"], np.zeros(1), np.ones(1)), "y", penalty=1e-12, tol=1e-16)
    return float(line.weights[1]), float(line.weights[0])


def decile_residuals(df: DataFrame, label: str, p: str, parts: int = 10) -> DataFrame:
    """part, n, mean_p, mean_y, mean residual by parts of equal numbers of rows in order of the prediction; equal predictions stay together."""
    cuts = quantile.quantiles(df.filter(F.col(p).isNotNull()), p, nearest=[k / parts for k in range(1, parts)])[1]
    part = sum((F.col(p) > F.lit(c)).cast("long") for c in cuts) if cuts and cuts[0] is not None else F.lit(0).cast("long")
    return df.filter(F.col(p).isNotNull() & F.col(label).isNotNull()).groupBy(part.alias("part")).agg(
        F.count("*").alias("n"), F.avg(p).alias("mean_p"), F.avg(F.col(label).cast("double")).alias("mean_y"), F.avg(F.col(label).cast("double") - F.col(p)).alias("residual")
    )
