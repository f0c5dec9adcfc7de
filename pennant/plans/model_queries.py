"""Queries on models, ratings and metrics over the driver's tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pennant.operators import learn, linear, sequence, trees
from pennant.operators.sets import stacked
from pennant.plans import features, fixtures
from pennant.plans.join_queries import games
from pennant.plans.registry import Tables, query
from pennant.streaming import snapshots


def written(t: Tables):
    """A function that writes a frame in the shared folder and reads it back."""
    return snapshots.kept


def scored(t: Tables) -> DataFrame:
    """Events with a deterministic score of being a purchase."""
    p = 1 / (1 + F.exp(-(F.col("value") - 20) / 15))
    return t.events.withColumns({"p": p, "y": (F.col("event_type") == "purchase").cast("int"), "fold": F.dayofmonth("ts").cast("long")})


SCORED_SQL = "s AS (SELECT *, 1 / (1 + exp(-(value - 20) / 15)) AS p, (event_type = 'purchase')::INTEGER AS y, day(ts) AS fold FROM events)"
METRICS_SQL = """count(*) AS n, round(avg(-(y * ln(least(1 - 1e-6, greatest(1e-6, p))) + (1 - y) * ln(1 - least(1 - 1e-6, greatest(1e-6, p))))), 8) AS log_loss,
round(avg(power(p - y, 2)), 8) AS brier, round(avg(((p >= 0.5)::INTEGER = y)::INTEGER), 8) AS accuracy"""


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 8) for n in names})


@query(f"WITH {SCORED_SQL} SELECT fold, {METRICS_SQL} FROM s GROUP BY 1")
def ml_metrics(t: Tables) -> DataFrame:
    """ML-08: log-loss, Brier score and accuracy by fold."""
    return _rounded(learn.classification_metrics(scored(t), ["fold"], "y", "p"), "log_loss", "brier", "accuracy")


@query(f"WITH {SCORED_SQL} SELECT least(floor(p * 10), 9)::BIGINT AS bin, count(*) AS n, round(avg(p), 8) AS mean_p, round(avg(y), 8) AS mean_y FROM s GROUP BY 1")
def ml_calibration(t: Tables) -> DataFrame:
    """ML-09: calibration in ten bins."""
    return _rounded(learn.calibration(scored(t), [], "y", "p"), "mean_p", "mean_y")


@query(f"WITH {SCORED_SQL}, m AS (SELECT fold, {METRICS_SQL} FROM s GROUP BY 1) SELECT sum(n)::BIGINT AS n, round(sum(log_loss * n) / sum(n), 6) AS log_loss, round(sum(brier * n) / sum(n), 6) AS brier FROM m")
def ml_fold_weighted(t: Tables) -> DataFrame:
    """ML-14: metrics of folds by their rows."""
    rows = _rounded(learn.classification_metrics(scored(t), ["fold"], "y", "p"), "log_loss", "brier")
    return learn.fold_weighted(rows, [], ["log_loss", "brier"]).withColumns({n: F.round(n, 6) for n in ("log_loss", "brier")})


@query("""WITH p AS (SELECT o_orderkey AS k, o_orderstatus AS model, o_custkey AS game, o_orderdate AS made_at FROM orders),
c AS (SELECT * FROM p WHERE date_diff('hour', made_at, TIMESTAMP '1999-01-01') >= 24 QUALIFY row_number() OVER (PARTITION BY game, model ORDER BY made_at DESC, k DESC) = 1),
f AS (SELECT game FROM c WHERE model IN ('F', 'P') GROUP BY 1 HAVING count(DISTINCT model) = 2)
SELECT game, model, made_at::DATE AS day FROM c WHERE model IN ('F', 'P') AND game IN (SELECT game FROM f)""")
def ml_common_sample(t: Tables) -> DataFrame:
    """ML-11: latest predictions at a cutoff, restricted to what all models have."""
    p = t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("model"), F.col("o_custkey").alias("game"), F.col("o_orderdate").cast("timestamp").alias("made_at"), F.lit("1999-01-01").cast("timestamp").alias("starts_at"))
    latest = learn.at_cutoff(p, ["game", "model"], "made_at", "starts_at", 24)
    return learn.common_sample(latest, ["game"], "model", ["F", "P"]).select("game", "model", F.to_date("made_at").alias("day"))


@query(f"""WITH {SCORED_SQL}, r AS (SELECT i AS r, (1103515245 * i + 12345) % 2147483647 AS a, (69069 * i + 362437) % 2147483647 AS b FROM range(200) t(i)),
q(k, upto) AS (SELECT k, floor(sum(exp(-1) / CASE k WHEN 0 THEN 1 ELSE factorial(k::INTEGER) END) OVER (ORDER BY k) * 2147483647) FROM range(11) t(k)),
d AS (SELECT event_type, r, power(p - y, 2) AS v, ((('0x' || substr(md5(event_id::VARCHAR), 1, 7))::BIGINT + 1) * a + b) % 2147483647 AS u FROM s, r),
n AS (SELECT event_type, r, v, (SELECT count(*) FROM q WHERE upto <= u) AS times FROM d),
m AS (SELECT event_type, r, sum(v * times) / nullif(sum(times), 0) AS m FROM n GROUP BY 1, 2),
o AS (SELECT event_type, list_sort(list(m)) AS l, avg(m) AS mean FROM m GROUP BY 1)
SELECT event_type, round(l[1 + floor(0.025 * (len(l) - 1))::INT], 9) AS lo, round(mean, 9) AS mean, round(l[1 + floor(0.975 * (len(l) - 1))::INT], 9) AS hi FROM o""")
def ml_bootstrap(t: Tables) -> DataFrame:
    """ML-10: intervals of the Brier score, all replicates summed in one pass."""
    found = learn.bootstrap(scored(t), ["event_type"], "event_id", F.pow(F.col("p") - F.col("y"), F.lit(2.0)), 200)
    return found.withColumns({n: F.round(n, 9) for n in ("lo", "mean", "hi")})


@query(f"""WITH {SCORED_SQL}, c AS (SELECT quantile_disc(p, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS cuts FROM s),
d AS (SELECT p, y, len(list_filter(cuts, lambda x: x < p)) AS part FROM s, c)
SELECT part, count(*) AS n, round(avg(p), 8) AS mean_p, round(avg(y), 8) AS mean_y, round(avg(y - p), 8) AS residual FROM d GROUP BY 1""")
def ml_deciles(t: Tables) -> DataFrame:
    """ML-09: residuals by tenths of the prediction, cut at exact quantiles."""
    return _rounded(linear.decile_residuals(scored(t), "y", "p"), "mean_p", "mean_y", "residual")


@query(f"""WITH RECURSIVE {SCORED_SQL}, z AS MATERIALIZED (SELECT ln(q / (1 - q)) AS z, y FROM (SELECT least(1 - 1e-6, greatest(1e-6, p)) AS q, y FROM s)),
it(k, a, b) AS (SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE UNION ALL
  SELECT k + 1, a + (h22 * g1 - h12 * g2) / (h11 * h22 - h12 * h12), b + (h11 * g2 - h12 * g1) / (h11 * h22 - h12 * h12)
  FROM (SELECT k, a, b, sum(y - e) AS g1, sum((y - e) * z) AS g2, sum(e * (1 - e)) AS h11, sum(e * (1 - e) * z) AS h12, sum(e * (1 - e) * z * z) AS h22
        FROM (SELECT it.k, it.a, it.b, z.z, z.y, 1 / (1 + exp(-(it.a + it.b * z.z))) AS e FROM it, z WHERE it.k < 25) GROUP BY k, a, b))
SELECT round(b, 5) AS slope, round(a, 5) AS intercept FROM it WHERE k = 25""")
def ml_calibration_line(t: Tables) -> DataFrame:
    """ML-09: slope and intercept of the labels on the predictions' log odds, by Newton steps on sums."""
    slope, intercept = linear.calibration_line(scored(t), "y", "p")
    return t.spark.createDataFrame([(round(slope, 5), round(intercept, 5))], "slope double, intercept double")


@query("""WITH x AS (SELECT 1.0 AS x0, l_quantity / 50 AS x1, l_discount * 10 AS x2, l_tax * 10 AS x3, l_extendedprice / 100000 AS x4 FROM lineitem),
u AS (SELECT i, j FROM range(5) a(i), range(5) b(j))
SELECT i, j, round(CASE i WHEN 0 THEN CASE j WHEN 0 THEN s00 WHEN 1 THEN s01 WHEN 2 THEN s02 WHEN 3 THEN s03 ELSE s04 END WHEN 1 THEN CASE j WHEN 0 THEN s01 WHEN 1 THEN s11 WHEN 2 THEN s12 WHEN 3 THEN s13 ELSE s14 END
  WHEN 2 THEN CASE j WHEN 0 THEN s02 WHEN 1 THEN s12 WHEN 2 THEN s22 WHEN 3 THEN s23 ELSE s24 END WHEN 3 THEN CASE j WHEN 0 THEN s03 WHEN 1 THEN s13 WHEN 2 THEN s23 WHEN 3 THEN s33 ELSE s34 END
  ELSE CASE j WHEN 0 THEN s04 WHEN 1 THEN s14 WHEN 2 THEN s24 WHEN 3 THEN s34 ELSE s44 END END, 8) AS v
FROM u, (SELECT avg(x0*x0) s00, avg(x0*x1) s01, avg(x0*x2) s02, avg(x0*x3) s03, avg(x0*x4) s04, avg(x1*x1) s11, avg(x1*x2) s12, avg(x1*x3) s13, avg(x1*x4) s14, avg(x2*x2) s22, avg(x2*x3) s23, avg(x2*x4) s24, avg(x3*x3) s33, avg(x3*x4) s34, avg(x4*x4) s44 FROM x)""")
def ml_gram(t: Tables) -> DataFrame:
    """ML-06: the sums of products that closed-form models are solved from, for each row of lineitem on average."""
    made = linear.Design(["l_quantity", "l_discount", "l_tax"], np.zeros(3), np.array([50.0, 0.1, 0.1]))
    g = linear.gram(t.lineitem.withColumn("label", F.col("l_extendedprice") / 100000), made, "label")
    g = g / g[0, 0]
    return t.spark.createDataFrame([(i, j, round(float(g[i, j]), 8)) for i in range(5) for j in range(5)], "i long, j long, v double")


def _split(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Line items of earlier and of later orders: what is known of an item, and whether it is returned."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("quantity"), F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit"), F.col("l_extendedprice").alias("price"), (F.col("l_returnflag") == "R").cast("int").alias("y"))
    return rows.filter("l_orderkey % 4 <> 3"), rows.filter("l_orderkey % 4 = 3")


FEATURES = ("quantity", "discount", "tax", "unit")


@query()
def ml_families(t: Tables) -> DataFrame:
    """ML-06: classifiers by spline basis, random Fourier machine and extra trees, on the later fourth of the orders, beside the share of the label."""
    early, late = _split(t)
    share = early.agg(F.avg("y")).first()[0]
    models = {"gam": linear.newton(early, linear.design(early, FEATURES, "spline"), "y", penalty=1.0), "svm": linear.machine(early, FEATURES, "y"), "extra_trees": trees.extra_trees(early, FEATURES, "y", trees=16)}
    found = [m.predict(late).select("y", "p", F.lit(n).alias("family")) for n, m in models.items()]
    rows = stacked([*found, late.select("y", F.lit(share).alias("p"), F.lit("share").alias("family"))])
    return learn.classification_metrics(rows, ["family"], "y", "p")


@query()
def ml_regressors(t: Tables) -> DataFrame:
    """ML-06: regressors of the price by Bayesian ridge, splines, random Fourier features and extra trees, on the later fourth, beside the mean."""
    early, late = (x.withColumn("label", F.col("price") / 1000) for x in _split(t))
    names, mean = ("quantity", "discount", "unit"), early.agg(F.avg("label")).first()[0]
    plain, spline, waves = (linear.design(early, names, k) for k in ("plain", "spline", "fourier"))
    models = {"bayesian": linear.bayesian_ridge(early, plain, "label"), "ridge": linear.ridge(early, plain, "label"), "gam": linear.ridge(early, spline, "label"), "svm": linear.newton(early, waves, "label", "insensitive", 1.0), "extra_trees": trees.extra_trees(early, names, "label", trees=16)}
    found = [m.predict(late).select("label", "p", F.lit(n).alias("family")) for n, m in models.items()]
    rows = stacked([*found, late.select("label", F.lit(mean).alias("p"), F.lit("mean").alias("family"))])
    return learn.regression_metrics(rows, ["family"], "label", "p")


@query()
def ml_stability(t: Tables) -> DataFrame:
    """ML-12: what splits on each feature gained in forests of the seasons before each season, and in how many of them it beat a column of noise."""
    rows = orders_of_customers(t).withColumn("noise", F.xxhash64("o_orderkey") % 1000)
    found = trees.stability(rows, "season", ["o_totalprice", "c_acctbal", "c_nationkey"], "y", "noise", first=3, trees=8, depth=4)
    return t.spark.createDataFrame(found, "feature string, importance double, folds_over_noise long, folds long")


@query()
def ml_walk_forward(t: Tables) -> DataFrame:
    """ML-05, ML-06, ML-07: models of earlier seasons on each season, with what the baselines lose there."""
    o = orders_of_customers(t)
    found = learn.walk_forward(o, "season", ["c_acctbal", "c_nationkey", "month"], "y", learn.CLASSIFIERS["logistic"], ["o_orderkey"], first=4)
    rows = learn.baselines(found, "season", "y", o)
    named = F.explode(F.array(*[F.struct(F.lit(n).alias("model"), F.col(c).alias("q")) for n, c in (("logistic", "p"), ("home_rate", "p_home"), ("zero", "p_zero"), ("season_average", "p_season"))])).alias("m")
    return learn.classification_metrics(rows.select("season", "y", named).select("season", "y", "m.*"), ["season", "model"], "y", "q")


def orders_of_customers(t: Tables) -> DataFrame:
    """Orders with what is known of their customer before, joined once: a model passes over its rows many times, and a join in each pass would send the customers to the driver each time."""
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    rows = o.select("o_orderkey", "o_orderdate", "o_totalprice", F.year("o_orderdate").alias("season"), "c_acctbal", "c_nationkey", F.month("o_orderdate").alias("month"), (F.col("o_totalprice") > 200000).cast("int").alias("y"))
    return snapshots.kept(rows, "orders")


@query()
def ml_importance(t: Tables) -> DataFrame:
    """ML-12: what each feature is worth to a model, beside a column of noise."""
    rows = orders_of_customers(t).withColumn("noise", F.xxhash64("o_orderkey") % 1000)
    names = ["o_totalprice", "c_acctbal", "noise"]
    fitted = learn.model(learn.CLASSIFIERS["logistic"](), names, "y").fit(learn.with_flags(rows.withColumn("y", F.col("y").cast("double")), names))
    return t.spark.createDataFrame(list(learn.permutation_importance(fitted, rows, names, "y")), "feature string, rise double")


@query()
def ml_stepwise(t: Tables) -> DataFrame:
    """ML-13: forward selection inside the earlier years, all of them, each feature against itself dealt anew; judged on the last year."""
    rows = orders_of_customers(t).withColumn("half_price", F.col("o_totalprice") / 2 + F.xxhash64("o_orderkey") % 20000)
    chosen, found = learn.nested_stepwise(rows, "season", ["half_price", "c_acctbal"], "y", learn.CLASSIFIERS["logistic"], margin=0.01)
    return t.spark.createDataFrame([(k, f, found) for k, f in enumerate(chosen)], "step long, feature string, log_loss double")


@query()
def ml_boosted(t: Tables) -> DataFrame:
    """ML-01: boosted trees learnt up to 1999 and judged on later seasons, with what the baselines lose there."""
    o = orders_of_customers(t).withColumn("part", F.when(F.col("season") <= 1999, 0).otherwise(1))
    found = learn.walk_forward(o, "part", ["c_acctbal", "c_nationkey", "month"], "y", learn.CLASSIFIERS["gbt"], ["o_orderkey"])
    rows = learn.baselines(found.unionByName(o.filter("part = 0").select("o_orderkey", "part", F.col("y").cast("double").alias("y"), F.lit(None).cast("double").alias("p"))), "part", "y").filter("part = 1")
    named = F.explode(F.array(*[F.struct(F.lit(n).alias("model"), F.col(c).alias("q")) for n, c in (("gbt", "p"), ("home_rate", "p_home"), ("zero", "p_zero"))])).alias("m")
    return learn.classification_metrics(rows.select("y", named).select("y", "m.*"), ["model"], "y", "q")


@query()
def ml_total(t: Tables) -> DataFrame:
    """ML-02: boosted regression of totals on each late season, beside the mean of the season before."""
    o = orders_of_customers(t).filter("season >= 1999").withColumn("total", F.col("o_totalprice") / 1000)
    found = learn.walk_forward(o, "season", ["c_acctbal", "c_nationkey", "month"], "total", learn.REGRESSORS["gbt"], ["o_orderkey"])
    rows = learn.baselines(found, "season", "total").filter("p_season is not null")
    model, base = (learn.regression_metrics(rows, ["season"], "total", p).withColumn("model", F.lit(n)) for n, p in (("gbt", "p"), ("season_average", "p_season")))
    return model.unionByName(base)


@query()
def ml_stack(t: Tables) -> DataFrame:
    """ML-03: a logistic model over two base predictions, one of them not always there, on the last fifth of the events."""
    rows = scored(t).withColumn("other", F.when(F.col("event_id") % 3 != 0, 1 / (1 + F.exp(-(F.col("value") - 30) / 5))))
    return learn.classification_metrics(learn.stack(rows, ["p", "other"], "y", "ts", ["event_id"]), [], "y", "p")


@query(f"""WITH RECURSIVE {SCORED_SQL}, v AS (SELECT user_id % 5 AS model, k AS version, y, CASE k WHEN 0 THEN 0.5 WHEN 1 THEN least(1 - 1e-6, greatest(1e-6, p)) WHEN 2 THEN 0.3 WHEN 3 THEN 0.25 ELSE 0.2 END AS p FROM s, range(5) t(k)),
b AS (SELECT model, avg(y) AS share FROM v WHERE version = 0 GROUP BY 1), m AS (SELECT model, version, avg(-(y * ln(p) + (1 - y) * ln(1 - p))) AS loss, avg(-(y * ln(share) + (1 - y) * ln(1 - share))) + 0.1 AS baseline FROM v JOIN b USING (model) GROUP BY ALL),
w(model, version, held, won) AS (SELECT model, -1::BIGINT, NULL::DOUBLE, -1::BIGINT FROM b UNION ALL
  SELECT m.model, m.version, CASE WHEN ok THEN loss ELSE held END, CASE WHEN ok THEN m.version ELSE won END FROM (SELECT m.*, w.held, w.won, baseline - loss >= 0.002 AND (held IS NULL OR held - loss >= 0.002) AS ok FROM w JOIN m ON m.model = w.model AND m.version = w.version + 1) m),
l AS (SELECT model, arg_max(won, version) AS champion FROM w GROUP BY 1)
SELECT m.model, m.version, round(loss, 8) AS loss, CASE WHEN m.version = champion THEN 'champion' WHEN w.won = m.version THEN 'retired' ELSE 'candidate' END AS status FROM m JOIN w ON w.model = m.model AND w.version = m.version JOIN l ON l.model = m.model""")
def ml_registry(t: Tables) -> DataFrame:
    """ML-15: versions of five models judged against the label's share and the champion before, one champion each."""
    p = F.when(F.col("version") == 1, F.col("p")).otherwise(F.get(F.array(*map(F.lit, (0.5, 0.0, 0.3, 0.25, 0.2))), F.col("version").cast("int")))
    rows = scored(t).select((F.col("user_id") % 5).alias("model"), "y", "p", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(4).cast("long"))).alias("version")).withColumn("p", p)
    share = rows.filter("version = 0").groupBy("model").agg(F.avg("y").alias("share"))
    rows = rows.join(F.broadcast(share), "model")
    found = learn.classification_metrics(rows, ["model", "version"], "y", "p").select("model", "version", F.col("log_loss").alias("loss"))
    base = learn.classification_metrics(rows.filter("version = 0"), ["model"], "y", "share").select("model", (F.col("log_loss") + 0.1).alias("baseline"))
    return learn.promotions(found.join(base, "model"), ["model"], "version", "loss", "baseline").select("model", "version", F.round("loss", 8).alias("loss"), "status")


@query("""WITH c AS (SELECT c_nationkey AS n, avg((o_orderstatus = 'F')::INTEGER) AS w FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)
SELECT a.n AS home, b.n AS away, round(CASE WHEN a.w * (1 - b.w) + b.w * (1 - a.w) = 0 THEN 0.5 ELSE a.w * (1 - b.w) / (a.w * (1 - b.w) + b.w * (1 - a.w)) END, 8) AS p FROM c a JOIN c b ON b.n = a.n + 1""")
def seq_log5(t: Tables) -> DataFrame:
    """SEQ-02: chances of neighbouring nations against each other."""
    c = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_nationkey").alias("n")).agg(F.avg((F.col("o_orderstatus") == "F").cast("int")).alias("w"))
    b = c.select((F.col("n") - 1).alias("n"), F.col("n").alias("away"), F.col("w").alias("v"))
    return c.join(b, "n").select(F.col("n").alias("home"), "away", F.round(sequence.log5(F.col("w"), F.col("v")), 8).alias("p"))


def event_cells(t: Tables) -> DataFrame:
    """Transitions of event types within a user's day, with purchases as runs."""
    from pyspark.sql import Window

    w = Window.partitionBy("user_id", F.to_date("ts")).orderBy("ts", "event_id")
    steps = t.events.select(F.col("event_type").alias("pre"), F.coalesce(F.lead("event_type").over(w), F.lit("END")).alias("post"))
    return steps.groupBy("pre", "post", (F.col("post") == "purchase").cast("int").alias("runs")).agg(F.count("*").alias("n"))


@query()
def seq_expectancy(t: Tables) -> DataFrame:
    """SEQ-04: expected purchases to the end of the day, by state."""
    return sequence.run_expectancy(event_cells(t))


@query()
def seq_simulation(t: Tables) -> DataFrame:
    """SEQ-06: seeded games of the chain."""
    return sequence.simulate_games(t.spark, event_cells(t), 500, "view", seed=7).groupBy("innings").agg(F.count("*").alias("n"), F.avg("home_runs").alias("home_runs"))


@query()
def seq_elo(t: Tables) -> DataFrame:
    """SEQ-01: ratings of nations before each order, home against away, by region and year."""
    g = games(t).filter("home <> away").join(t.orders.select("o_orderkey", "o_orderdate", "o_totalprice"), F.col("l_orderkey") == F.col("o_orderkey")).join(t.nation, F.col("home") == F.col("n_nationkey"))
    rows = g.select(
        F.col("l_orderkey").alias("game"), F.col("n_regionkey").cast("string").alias("league"), F.year("o_orderdate").alias("season"), F.to_date("o_orderdate").alias("day"), F.lit(0).cast("long").alias("number"),
        F.col("home").cast("long").alias("home"), F.col("away").cast("long").alias("away"), F.pmod(F.floor("o_totalprice"), F.lit(9)).cast("long").alias("home_score"), (F.col("n") % 8).cast("long").alias("away_score"),
    )
    write = written(t)
    return sequence.elo(write(rows, "games"), write)


@query()
def ml_opponents(t: Tables) -> DataFrame:
    """ML-01: boosted trees on the form of both teams, learnt up to 1999 and judged on later games beside log5, Elo and the home rate; promoted if they beat every one of them by .002."""
    write, g = written(t), fixtures.games(t)
    rows = write(features.export_view(g, features.team_form(g), ["win_pct", "pythagenpat", "runs_for", "runs_against"]), "export")
    rows = rows.withColumns({"y": F.col("home_won").cast("int"), "part": (F.col("season") > 1999).cast("int")})
    played = g.filter("game_type = 'regular'").select(
        F.col("id").cast("long").alias("game"), F.lit("all").alias("league"), F.col("season").cast("int").alias("season"), F.col("game_date").alias("day"), F.col("game_number").cast("long").alias("number"),
        F.col("home_team_id").cast("long").alias("home"), F.col("away_team_id").cast("long").alias("away"), F.col("home_score").cast("long").alias("home_score"), F.col("away_score").cast("long").alias("away_score"),
    )
    elo = sequence.elo(write(played, "played"), write).select(F.col("game").alias("game_id"), (1 / (1 + F.pow(F.lit(10.0), -(F.col("home_elo") + sequence.HOME_EDGE - F.col("away_elo")) / 400))).alias("elo"))
    names = [f"{side}_{v}" for side in ("home", "away") for v in ("win_pct", "pythagenpat", "runs_for", "runs_against")]
    gbt = learn.walk_forward(rows, "part", names, "y", learn.CLASSIFIERS["gbt"], ["game_id"]).select("game_id", F.col("p").alias("gbt"))
    share = rows.filter("part = 0").agg(F.avg("y").alias("home_rate"))
    late = rows.filter("part = 1").join(gbt, "game_id").join(elo, "game_id").crossJoin(F.broadcast(share)).withColumn("log5", F.coalesce(sequence.log5(F.col("home_win_pct"), F.col("away_win_pct")), F.lit(0.5)))
    models = ("gbt", "log5", "elo", "home_rate")
    found = learn.classification_metrics(late.select("y", F.explode(F.array(*[F.struct(F.lit(n).alias("model"), F.col(n).alias("p")) for n in models])).alias("m")).select("y", "m.*"), ["model"], "y", "p").collect()
    loss = {r["model"]: r["log_loss"] for r in found}
    won = learn.promoted(loss["gbt"], [loss[n] for n in models[1:]])
    return t.spark.createDataFrame([(*r, won if r["model"] == "gbt" else None) for r in found], "model string, n long, log_loss double, brier double, accuracy double, promoted boolean")
