"""Walk-forward models, metrics, calibration, bootstrap, selection and a model registry."""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, MultilayerPerceptronClassifier, NaiveBayes, RandomForestClassifier
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pennant.operators import quantile

EPS = 1e-6
#: Families with a pyspark.ml estimator; operators.linear and operators.trees have RBF machines, extra trees, splines and Bayesian ridge.
CLASSIFIERS = {
    "gbt": lambda: GBTClassifier(maxIter=20, maxDepth=3, stepSize=0.05, seed=1), "logistic": lambda: LogisticRegression(maxIter=50), "forest": lambda: RandomForestClassifier(numTrees=20, maxDepth=5, seed=1),
    "bayes": lambda: NaiveBayes(modelType="gaussian"), "svm": lambda: LinearSVC(maxIter=20), "mlp": lambda: MultilayerPerceptronClassifier(maxIter=30, seed=1),
}
REGRESSORS = {"gbt": lambda: GBTRegressor(maxIter=20, maxDepth=3, stepSize=0.05, seed=1), "linear": lambda: LinearRegression(), "elastic": lambda: LinearRegression(elasticNetParam=0.5, regParam=0.01), "forest": lambda: RandomForestRegressor(numTrees=20, maxDepth=5, seed=1)}


def folds(seasons: Sequence[int], first: int = 1) -> list[tuple[list[int], int]]:
    """Train seasons before each test season; the first `first` seasons are only trained on."""
    ordered = sorted(seasons)
    return [(ordered[:k], ordered[k]) for k in range(first, len(ordered))]


def check_cutoff(df: DataFrame, known_at: str, happens_at: str) -> DataFrame:
    """df, if no feature is known later than the event it describes."""
    if not df.filter(F.col(known_at) >= F.col(happens_at)).isEmpty():
        raise ValueError(f"{known_at} isn't before {happens_at}")
    return df


def model(estimator, features: Sequence[str], label: str) -> Pipeline:
    """Mean imputation, a flag for each feature that was missing, and the estimator."""
    filled = [f"{f}__filled" for f in features]
    flags = [f"{f}__missing" for f in features]
    if isinstance(estimator, MultilayerPerceptronClassifier):
        estimator = estimator.copy().setLayers([2 * len(features), 8, 2])
    return Pipeline(stages=[Imputer(inputCols=list(features), outputCols=filled), VectorAssembler(inputCols=[*filled, *flags], outputCol="features"), estimator.setLabelCol(label)])


def with_flags(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.withColumns({**{f: F.col(f).cast("double") for f in features}, **{f"{f}__missing": F.col(f).isNull().cast("double") for f in features}})


def walk_forward(df: DataFrame, season: str, features: Sequence[str], label: str, make: Callable, keys: Sequence[str], first: int = 1) -> DataFrame:
    """Predictions for each season from a model of the seasons before."""
    rows = with_flags(df.withColumn(label, F.col(label).cast("double")), features)
    out = None
    for train, test in folds([r[0] for r in rows.select(season).distinct().collect()], first):
        fitted = model(make(), features, label).fit(rows.filter(F.col(season).isin(train)))
        found = fitted.transform(rows.filter(F.col(season) == test))
        p = vector_to_array("probability")[1] if "probability" in found.columns else F.col("prediction")
        part = found.select(*keys, season, label, p.alias("p"))
        out = part if out is None else out.unionByName(part)
    return out


def baselines(df: DataFrame, season: str, label: str, known: DataFrame | None = None) -> DataFrame:
    """Adds p_home (share of label 1 in the seasons before), p_zero and p_season (mean of the season before). known: the rows of all seasons, if df lacks some."""
    totals = (df if known is None else known).groupBy(season).agg(F.sum(F.col(label).cast("double")).alias("_s"), F.count(label).alias("_n"))
    w = Window.orderBy(season).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(season, (F.sum("_s").over(w) / F.sum("_n").over(w)).alias("p_home"), F.lag(F.col("_s") / F.col("_n")).over(Window.orderBy(season)).alias("p_season"), F.lit(0.0).alias("p_zero"))
    return df.join(F.broadcast(totals), season, "left")


def classification_metrics(df: DataFrame, keys: Sequence[str], label: str, p: str) -> DataFrame:
    y, q = F.col(label).cast("double"), F.least(F.lit(1 - EPS), F.greatest(F.lit(EPS), F.col(p)))
    return df.groupBy(*keys).agg(
        F.count("*").alias("n"), F.avg(-(y * F.ln(q) + (1 - y) * F.ln(1 - q))).alias("log_loss"), F.avg(F.pow(F.col(p) - y, F.lit(2.0))).alias("brier"),
        F.avg(((F.col(p) >= 0.5).cast("double") == y).cast("double")).alias("accuracy"),
    )


def regression_metrics(df: DataFrame, keys: Sequence[str], label: str, p: str) -> DataFrame:
    e = F.col(p) - F.col(label)
    return df.groupBy(*keys).agg(F.count("*").alias("n"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(e).alias("bias"))


def calibration(df: DataFrame, keys: Sequence[str], label: str, p: str, bins: int = 10) -> DataFrame:
    """Mean prediction and outcome in bins of equal width."""
    bin_ = F.least(F.floor(F.col(p) * bins), F.lit(bins - 1)).cast("long").alias("bin")
    return df.groupBy(*keys, bin_).agg(F.count("*").alias("n"), F.avg(p).alias("mean_p"), F.avg(F.col(label).cast("double")).alias("mean_y"))


#: Modulus of the draws, and the shares below which a Poisson(1) number is at most 0, 1, 2, ...
PRIME = (1 << 31) - 1
POISSON = [sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)) for k in range(11)]


def bootstrap(df: DataFrame, keys: Sequence[str], identity: str, value: Column, replicates: int = 200) -> DataFrame:
    """95 % interval of the mean of value: lo, mean, hi at indexes int(.025 (n-1)) and int(.975 (n-1)) of the sorted replicates.

    Every row comes a Poisson(1) number of times in a replicate, drawn from a hash
    of its identity: the first 28 bits of its md5 plus one, times a multiplier of
    the replicate plus another, modulo 2**31-1. So the draw needs no total and no
    order, and one pass suffices: a task sums all replicates of its rows as arrays
    and hands on one row for each key and replicate. Rows without a value or an
    identity are left out.
    """
    rows = df.select(*keys, F.conv(F.substring(F.md5(F.col(identity).cast("string")), 1, 7), 16, 10).cast("long").alias("_i"), value.cast("double").alias("_v")).filter("_v IS NOT NULL AND _i IS NOT NULL")
    names = [f"_k{k}" for k in range(len(keys))]
    rows = rows.select(*[F.col(c).alias(n) for c, n in zip(keys, names, strict=True)], "_i", "_v")
    times, plus = (np.array([(a * r + b) % PRIME for r in range(replicates)], np.int64) for a, b in ((1_103_515_245, 12_345), (69_069, 362_437)))
    ends = np.floor(np.array(POISSON) * PRIME)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}
        kinds: dict[str, pa.DataType] = {}
        for batch in batches:
            kinds = {name: batch.schema.field(name).type for name in names}
            table = pa.Table.from_batches([batch])
            groups = table.select(names).to_pylist() if names else [{}] * batch.num_rows
            of: dict[tuple, list[int]] = {}
            for i, g in enumerate(groups):
                of.setdefault(tuple(g.values()), []).append(i)
            seed, v = batch.column("_i").to_numpy() + 1, batch.column("_v").to_numpy()
            for key, own in of.items():
                n, s = held.setdefault(key, (np.zeros(replicates, np.int64), np.zeros(replicates)))
                for at in range(0, len(own), 4096):
                    part = own[at : at + 4096]
                    drawn = np.searchsorted(ends, (seed[part][:, None] * times + plus) % PRIME, side="right")
                    n += drawn.sum(axis=0)
                    s += v[part] @ drawn
        for key, (n, s) in held.items():
            columns = {name: pa.array([k] * replicates, kinds[name]) for name, k in zip(names, key, strict=True)}
            yield pa.RecordBatch.from_pydict(columns | {"_r": pa.array(np.arange(replicates)), "_n": pa.array(n), "_s": pa.array(s)})

    schema = rows.select(*names).schema.add("_r", "long").add("_n", "long").add("_s", "double")
    means = rows.mapInArrow(sums, schema).groupBy(*names, "_r").agg((F.sum("_s") / F.nullif(F.sum("_n"), F.lit(0))).alias("_m"))
    ordered = means.groupBy(*names).agg(F.array_sort(F.collect_list("_m")).alias("_all"), F.avg("_m").alias("mean"))
    at = lambda share: F.get("_all", F.floor(F.lit(share) * (F.size("_all") - 1)).cast("int"))
    return ordered.select(*[F.col(n).alias(c) for c, n in zip(keys, names, strict=True)], at(0.025).alias("lo"), "mean", at(0.975).alias("hi"))


def common_sample(df: DataFrame, keys: Sequence[str], name: str, names: Sequence[str]) -> DataFrame:
    """Rows whose key has a prediction of every one of the models."""
    full = df.filter(F.col(name).isin(*names)).groupBy(*keys).agg(F.countDistinct(name).alias("_n")).filter(F.col("_n") == len(names)).drop("_n")
    return df.filter(F.col(name).isin(*names)).join(full, list(keys), "left_semi")


def at_cutoff(df: DataFrame, keys: Sequence[str], made_at: str, starts_at: str, hours: float) -> DataFrame:
    """The latest prediction of each key made at least `hours` before the start."""
    ahead = (F.unix_micros(F.col(starts_at).cast("timestamp")) - F.unix_micros(F.col(made_at).cast("timestamp"))) / 3.6e9
    w = Window.partitionBy(*keys).orderBy(F.col(made_at).desc())
    return df.filter(ahead >= hours).withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def fold_weighted(df: DataFrame, keys: Sequence[str], metrics: Sequence[str], n: str = "n") -> DataFrame:
    """Metrics of folds averaged by their rows."""
    return df.groupBy(*keys).agg(F.sum(n).alias(n), *[(F.sum(F.col(m) * F.col(n)) / F.sum(n)).alias(m) for m in metrics])


def promoted(candidate: float, baselines: Sequence[float], gain: float = 0.002) -> bool:
    """A candidate's log-loss must beat every baseline by the gain."""
    return all(b - candidate >= gain for b in baselines)


def ranked(df: DataFrame, order: Column, name: str) -> DataFrame:
    """df with the rank (from 0) of each row in the order of a hash value; counts of ranges of the hash stand before ranks inside of them, so no task sorts all rows."""
    rows = df.withColumn("_h", order).withColumn("_q", F.shiftrightunsigned(F.col("_h"), 52))
    before = rows.groupBy("_q").agg(F.count("*").alias("_c")).select("_q", (F.sum("_c").over(Window.orderBy("_q")) - F.col("_c")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_q").orderBy("_h", *[c for c in df.columns]))
    return rows.withColumn("_in", inside).join(F.broadcast(before), "_q").withColumn(name, F.col("_before") + F.col("_in") - 1).drop("_h", "_q", "_in", "_before")


def dealt(rows: DataFrame, feature: str, features: Sequence[str], seed: int = 1) -> DataFrame:
    """rows with a feature's values dealt anew over all rows: the row of rank r in one hashed order gets the value of rank r in another."""
    key = lambda s: F.xxhash64(*[F.col(f) for f in features], F.lit(s))
    numbered = ranked(rows, key(seed), "_to")
    values = ranked(rows.select(*features), key(seed + 1_000_003), "_from").select("_from", F.col(feature).alias("_v"))
    return numbered.join(values, F.col("_to") == F.col("_from")).withColumn(feature, F.col("_v")).drop("_v", "_to", "_from")


def loss(fitted, data: DataFrame, label: str) -> float:
    """Log-loss of a fitted model."""
    scored = fitted.transform(data).withColumn("_p", vector_to_array("probability")[1])
    return classification_metrics(scored, [], label, "_p").first()["log_loss"]


def permutation_importance(fitted, df: DataFrame, features: Sequence[str], label: str, seed: int = 1) -> Iterator[tuple[str, float]]:
    """Rise of log-loss when a feature's values are dealt anew; a noise column shows what chance gives."""
    rows = with_flags(df.withColumn(label, F.col(label).cast("double")), features)
    base = loss(fitted, rows, label)
    for feature in features:
        yield feature, loss(fitted, dealt(rows, feature, features, seed), label) - base


def stepwise(score: Callable[[Sequence[str]], float], features: Sequence[str], margin: float = 0.0) -> list[str]:
    """Forward selection: add the feature that lowers the score most, while it does by more than the margin."""
    chosen, best = [], score([])
    while len(chosen) < len(features):
        found = min(((score([*chosen, f]), f) for f in features if f not in chosen))
        if best - found[0] <= margin:
            break
        best, chosen = found[0], [*chosen, found[1]]
    return chosen


def nested_stepwise(df: DataFrame, season: str, features: Sequence[str], label: str, make: Callable, margin: float = 0.0) -> tuple[list[str], float]:
    """Forward selection inside the seasons before the last one; the features chosen, and their log-loss on the last.

    The inner split learns from all but the last of the earlier seasons and scores
    on that one. A feature counts by what it gains over itself with its values
    dealt anew in the learning rows, so a column of noise gains about nothing.
    Rows without a season are on no side of a split and left out.
    """
    rows = with_flags(df.filter(F.col(season).isNotNull()).withColumn(label, F.col(label).cast("double")), features)
    seasons = sorted(r[0] for r in rows.select(season).distinct().collect())
    if len(seasons) < 3:
        raise ValueError("nested selection needs three seasons")
    learnt, inner = rows.filter(F.col(season) < seasons[-2]), rows.filter(F.col(season) == seasons[-2])
    chosen: list[str] = []
    while len(chosen) < len(features):
        gains = {}
        for f in (f for f in features if f not in chosen):
            real, shuffled = (loss(model(make(), [*chosen, f], label).fit(x), inner, label) for x in (learnt, dealt(learnt, f, features)))
            gains[f] = shuffled - real
        best = max(gains, key=gains.get)
        if gains[best] <= margin:
            break
        chosen.append(best)
    if not chosen:
        return [], float("nan")
    fitted = model(make(), chosen, label).fit(rows.filter(F.col(season) < seasons[-1]))
    return chosen, loss(fitted, rows.filter(F.col(season) == seasons[-1]), label)


def model_id(spec: Mapping) -> str:
    """Content hash of a model or experiment; equal specifications are one."""
    return hashlib.sha256(json.dumps(spec, sort_keys=True, default=str, separators=(",", ":")).encode()).hexdigest()


def promote(registry: DataFrame, name: str, model: str) -> DataFrame:
    """registry: name, model_id, status. The model becomes the name's only champion; the one before retires."""
    mine = F.col("name") == name
    status = F.when(mine & (F.col("model_id") == model), "champion").when(mine & (F.col("status") == "champion"), "retired").otherwise(F.col("status"))
    return registry.withColumn("status", status)


def promotions(runs: DataFrame, names: Sequence[str], order: str, loss: str, baseline: str, gain: float = 0.002) -> DataFrame:
    """status of every run of a model, its versions in order: a run becomes champion if its loss beats the baseline and the champion before by the gain; that one retires, all others stay candidates.

    So a model has one champion at most. Runs without a loss stay candidates. The
    versions of one model stand in one row meanwhile.
    """
    steps = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(loss).cast("double").alias("l"), F.col(baseline).cast("double").alias("b"))))
    kind = dict(runs.dtypes)[order]

    def step(held: Column, x: Column) -> Column:
        better = (x["b"] - x["l"] >= gain) & F.coalesce(held["l"] - x["l"] >= gain, held["l"].isNull())
        wins = F.coalesce(better, F.lit(False))
        return F.struct(F.when(wins, x["l"]).otherwise(held["l"]).alias("l"), F.when(wins, F.array_append(held["won"], x["o"])).otherwise(held["won"]).alias("won"))

    state = f"struct<l:double,won:array<{kind}>>"
    first = F.struct(F.lit(None).cast("double").alias("l"), F.array().cast(f"array<{kind}>").alias("won")).cast(state)
    won = runs.groupBy(*names).agg(F.aggregate(steps, first, lambda held, x: step(held, x).cast(state), lambda held: held["won"]).alias("_won"))
    place = F.array_position("_won", F.col(order))
    status = F.when(place == 0, "candidate").when(place == F.size("_won"), "champion").otherwise("retired")
    return runs.join(won, list(names)).withColumn("status", status).drop("_won")


def stack(df: DataFrame, inputs: Sequence[str], label: str, order: str, keys: Sequence[str], share: float = 0.8) -> DataFrame:
    """A logistic model over base predictions, learnt from the first `share` of rows by `order`; predictions of the rest.

    A missing base prediction counts as .5 beside a flag of its absence. Rows with
    one value of `order` stay on one side of the cut.
    """
    filled = {f"{c}__given": F.coalesce(F.col(c).cast("double"), F.lit(0.5)) for c in inputs}
    flags = {f"{c}__there": F.col(c).isNotNull().cast("double") for c in inputs}
    rows = df.withColumns({**filled, **flags, label: F.col(label).cast("double")})
    cut = quantile.quantiles(rows.select(F.unix_micros(F.col(order).cast("timestamp")).alias("_t")), "_t", [share])[0][0]
    early = F.unix_micros(F.col(order).cast("timestamp")) < F.lit(cut)
    fitted = Pipeline(stages=[VectorAssembler(inputCols=[*filled, *flags], outputCol="features"), LogisticRegression(maxIter=50, labelCol=label)]).fit(rows.filter(early))
    return fitted.transform(rows.filter(~early)).select(*keys, label, vector_to_array("probability")[1].alias("p"))
