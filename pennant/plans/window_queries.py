"""Queries on window operators: form, rest, workload, league context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pennant.functions import clean
from pennant.operators import aggregates, windows
from pennant.plans.registry import Tables, query



def day() -> Column:
    return F.to_date("ts")



def user_days(t: Tables) -> DataFrame:
    """Events by user and day."""
    return aggregates.count_where(
        t.events.withColumn("day", day()), ["user_id", "day"], {"n_purchase": F.col("event_type") == "purchase", "n_error": F.col("event_type") == "error"},
        n_events=F.count("*"), total=F.sum("value"),
    )


DAYS_SQL = """days AS (SELECT user_id, ts::DATE AS day, count(*) AS n_events, sum(value) AS total,
  count(*) FILTER (event_type = 'purchase') AS n_purchase, count(*) FILTER (event_type = 'error') AS n_error FROM events GROUP BY ALL)"""


@query(f"""WITH {DAYS_SQL}, w AS (SELECT *,
  sum(n_events) OVER e AS prior_events, sum(total) OVER e AS prior_total, sum(n_purchase) OVER e AS prior_purchases,
  sum(total) OVER (PARTITION BY user_id ORDER BY day RANGE BETWEEN INTERVAL 3 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING) AS load_3d,
  date_diff('day', lag(day) OVER (PARTITION BY user_id ORDER BY day), day) AS rest_days
  FROM days WINDOW e AS (PARTITION BY user_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT user_id, day, prior_events::BIGINT AS prior_events, round(prior_total, 4) AS prior_total, round(load_3d, 4) AS load_3d, rest_days::BIGINT AS rest_days,
  CASE WHEN prior_events >= 5 THEN round(prior_purchases::DOUBLE / prior_events, 6) END AS purchase_rate FROM w""")
def win_user_form(t: Tables) -> DataFrame:
    """WIN-01, WIN-05, WIN-06: what is known of a user before each day."""
    days = windows.prior(user_days(t), ["user_id"], ["day"], {"prior_events": "n_events", "prior_total": "total", "prior_purchases": "n_purchase"})
    load = windows.trailing_days(user_days(t), ["user_id"], "day", {"total": "total"}, 3).select("user_id", "day", "prior_total").withColumnRenamed("prior_total", "load_3d")
    days = windows.rest_days(days, ["user_id"], ["day"], "day").join(load, ["user_id", "day"])
    return days.select(
        "user_id", "day", "prior_events", F.round("prior_total", 4).alias("prior_total"), F.round("load_3d", 4).alias("load_3d"), "rest_days",
        F.round(clean.rate(F.col("prior_purchases"), F.col("prior_events"), 5), 6).alias("purchase_rate"),
    )


def customer_orders(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.to_date("o_orderdate").alias("day"), F.year("o_orderdate").alias("season"))


ORDERS_SQL = "o AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate::DATE AS day, year(o_orderdate) AS season FROM orders)"


@query(f"""WITH {ORDERS_SQL} SELECT o_orderkey, season::BIGINT AS season,
  round(sum(o_totalprice) OVER s, 4) AS season_total, (count(*) OVER s)::BIGINT AS season_orders, round(sum(o_totalprice) OVER c, 4) AS career_total,
  round(avg(o_totalprice) OVER t, 4) AS last10_mean FROM o
WINDOW s AS (PARTITION BY o_custkey, season ORDER BY day, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
  c AS (PARTITION BY o_custkey ORDER BY day, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
  t AS (PARTITION BY o_custkey ORDER BY day, o_orderkey ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)""")
def win_order_history(t: Tables) -> DataFrame:
    """WIN-01, WIN-02, WIN-03, WIN-13: season, career and last-ten windows of one sequence."""
    order = ["day", "o_orderkey"]
    df = windows.prior(customer_orders(t), ["o_custkey", "season"], order, {"season_total": "o_totalprice"})
    df = windows.prior(df, ["o_custkey", "season"], order, {"season_orders": F.lit(1)}, how="count")
    df = windows.prior(df, ["o_custkey"], order, {"career_total": "o_totalprice"})
    df = windows.prior(df, ["o_custkey"], order, {"last10_mean": "o_totalprice"}, rows=10, how="avg")
    rounded = [F.round(c, 4).alias(c) for c in ("season_total", "career_total", "last10_mean")]
    return df.select("o_orderkey", F.col("season").cast("long").alias("season"), "season_orders", *rounded)


@query(f"""WITH {DAYS_SQL}, l AS (SELECT month(day) AS season, day, sum(n_purchase) AS p, sum(n_events) AS e FROM days GROUP BY ALL),
w AS (SELECT season, day, sum(p) OVER x AS lp, sum(e) OVER x AS le FROM l WINDOW x AS (PARTITION BY season ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
u AS (SELECT user_id, day, month(day) AS season, sum(n_purchase) OVER y AS up, sum(n_events) OVER y AS ue FROM days
  WINDOW y AS (PARTITION BY user_id, month(day) ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT user_id, day, CASE WHEN ue >= 3 AND lp > 0 THEN round(100.0 * (up::DOUBLE / ue) / (lp::DOUBLE / le), 4) END AS index_to_league FROM u JOIN w USING (season, day)""")
def win_league_index(t: Tables) -> DataFrame:
    """WIN-04: a user's prior rate against everybody's, from day totals."""
    days = user_days(t).withColumn("season", F.month("day"))
    days = windows.prior(days, ["user_id", "season"], ["day"], {"up": "n_purchase", "ue": "n_events"})
    days = windows.prior_of_all(days, "season", "day", {"lp": "n_purchase", "le": "n_events"})
    index = F.lit(100.0) * (F.col("up") / F.col("ue")) / (F.col("lp") / F.col("le"))
    return days.select("user_id", "day", F.when((F.col("ue") >= 3) & (F.col("lp") > 0), F.round(index, 4)).alias("index_to_league"))


@query(f"""WITH {DAYS_SQL} SELECT user_id, day, round(total, 4) AS total,
 round(sum(total) OVER (PARTITION BY user_id ORDER BY day RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING), 4) AS load_7d,
 (sum(n_events) OVER (PARTITION BY user_id ORDER BY day RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING))::BIGINT AS events_7d FROM days""")
def win_workload(t: Tables) -> DataFrame:
    """WIN-05: load of the seven days before."""
    days = windows.trailing_days(t.events.withColumns({"day": day(), "one": F.lit(1)}), ["user_id"], "day", {"total": "value", "n": "one"}, 7)
    return days.select("user_id", "day", F.round("total", 4).alias("total"), F.round("prior_total", 4).alias("load_7d"), F.col("prior_n").alias("events_7d"))


@query("""WITH e AS (SELECT user_id, ts::DATE AS day, ts, event_id, event_type, value FROM events)
SELECT event_id, round(sum(value) OVER (PARTITION BY user_id, day ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 4) AS rest_value FROM e""")
def win_rest_of_day(t: Tables) -> DataFrame:
    """WIN-07: what the day still brings, from each event on."""
    e = t.events.withColumn("day", day())
    return windows.rest_of(e, ["user_id", "day"], ["ts", "event_id"], "value", "rest").select("event_id", F.round("rest", 4).alias("rest_value"))


@query("""WITH c AS (SELECT user_id, event_id, ts, event_id AS counter FROM events)
SELECT event_id, (counter - lag(counter, 1, 0) OVER (PARTITION BY user_id ORDER BY ts, event_id))::BIGINT AS step FROM c""")
def win_counter_step(t: Tables) -> DataFrame:
    """WIN-08: change of a cumulative counter, from 0."""
    e = t.events.withColumn("counter", F.col("event_id"))
    return windows.step(e, ["user_id"], ["ts", "event_id"], "counter", "step").select("event_id", F.col("step").cast("long").alias("step"))


@query("""SELECT event_id, CASE WHEN count(*) OVER w > 0 THEN round((count(*) FILTER (event_type = 'purchase') OVER w)::DOUBLE / count(*) OVER w, 6) END AS win_share
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def win_prior_share(t: Tables) -> DataFrame:
    """WIN-09: filtered count over a window, null without history."""
    e = windows.prior_share(t.events, ["user_id"], ["ts", "event_id"], F.col("event_type") == "purchase", "s")
    return e.select("event_id", F.round("s", 6).alias("win_share"))


@query("""SELECT event_id, max(value) FILTER (event_type = 'purchase') OVER (PARTITION BY user_id) AS top_purchase FROM events""")
def win_pick_over(t: Tables) -> DataFrame:
    """WIN-10: one row's value on all rows of its partition."""
    return windows.pick_over(t.events, ["user_id"], "value", F.col("event_type") == "purchase", "top_purchase").select("event_id", "top_purchase")


@query(f"""WITH {ORDERS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey
  ORDER BY CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'P' THEN 1 ELSE 2 END, day DESC NULLS LAST, o_orderkey) AS n FROM o)
SELECT o_custkey, o_orderkey, o_orderstatus, day FROM r WHERE n = 1""")
def win_distinct_on(t: Tables) -> DataFrame:
    """WIN-11, WIN-14: the latest order of each customer, by status first."""
    priority = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "P", 1).otherwise(2)
    return windows.first_by(customer_orders(t), ["o_custkey"], [priority, F.col("day").desc_nulls_last(), F.col("o_orderkey")]).select("o_custkey", "o_orderkey", "o_orderstatus", "day")


@query("SELECT user_id, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC NULLS LAST, event_id) <= 2")
def win_top_two(t: Tables) -> DataFrame:
    """WIN-15: the two largest of each group."""
    return windows.first_by(t.events, ["user_id"], [F.col("value").desc_nulls_last(), F.col("event_id")], 2).select("user_id", "event_id", "value")


@query(f"""WITH {ORDERS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY day, o_orderkey) AS n FROM o)
SELECT season::BIGINT AS season, count(*) AS n_eligible FROM r WHERE n > 1 GROUP BY season""")
def win_eligible(t: Tables) -> DataFrame:
    """WIN-12: rows with history, by season."""
    rows = windows.with_history(customer_orders(t), ["o_custkey"], ["day", "o_orderkey"])
    return rows.groupBy(F.col("season").cast("long").alias("season")).agg(F.count("*").alias("n_eligible"))


@query("""WITH c AS (SELECT event_id, user_id, event_type, lag(event_type) OVER w AS l, row_number() OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, user_id, event_type FROM c WHERE n = 1 OR event_type IS DISTINCT FROM l""")
def str_changes(t: Tables) -> DataFrame:
    """STR-02: rows that change a key's value (batch form of the stream)."""
    return windows.changes(t.events, ["user_id"], ["ts", "event_id"], "event_type").select("event_id", "user_id", "event_type")


@query("""WITH e AS (SELECT c_nationkey AS k, min(year(o_orderdate)) AS first_year, max(year(o_orderdate)) AS last_year FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)
SELECT k AS nation, first_year::BIGINT AS first_year, CASE WHEN last_year = max(last_year) OVER () THEN 9999 ELSE last_year END::BIGINT AS last_year FROM e""")
def agg_open_era(t: Tables) -> DataFrame:
    """AGG-15: eras that reach the latest year are open."""
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    eras = o.groupBy(F.col("c_nationkey").alias("nation")).agg(F.min(F.year("o_orderdate")).cast("long").alias("first_year"), F.max(F.year("o_orderdate")).cast("long").alias("last_year"))
    return windows.open_era(eras, "last_year").withColumn("last_year", F.col("last_year").cast("long"))
